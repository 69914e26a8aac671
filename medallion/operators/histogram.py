"""Equal-width histograms: ``n`` bins over [min, max], the last bin closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.enrich import null_safe


def _edges(low: Column, high: Column) -> tuple[Column, Column]:
    """A single-valued range is widened on both sides: by half a unit, or for numbers too
    large to tell by a 2**-40th of their size.  An infinite range is an error."""
    flat = low == high
    half = F.greatest(F.lit(0.5), F.abs(low) * F.lit(2.0 ** -40))
    endless = F.abs(low).isin(float("inf")) | F.abs(high).isin(float("inf"))
    failed = F.raise_error(F.lit("a histogram's range must be finite")).cast("double")
    return (F.when(endless, failed).when(flat, low - half).otherwise(low),
            F.when(endless, failed).when(flat, high + half).otherwise(high))


def _bin_of(x: Column, low: Column, width: Column, bins: int) -> Column:
    """Bin such that ``low + bin*width <= x < low + (bin+1)*width``."""
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1))
    return (guess
            - F.when(x < low + guess * width, 1).otherwise(0)
            + F.when((x >= low + (guess + 1) * width) & (guess < bins - 1), 1).otherwise(0))


def _number(value: str) -> Column:
    """The value as DOUBLE; NaN is a missing value."""
    return F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Columns ``bin, bin_start, bin_end, frequency``; empty bins are kept."""
    x = _number(value)
    span = df.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    low, high = _edges(F.col("_span.lo"), F.col("_span.hi"))
    width = (high - low) / bins

    rows = df.where(x.isNotNull()).select(x.alias("_x"), span.alias("_span"))
    counts = (rows.select(_bin_of(F.col("_x"), low, width, bins).cast("bigint").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("frequency")))
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"), span.alias("_span"))
    all_bins = frame.where(F.col("_span.lo").isNotNull()).select(
        "bin", (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"))
    return all_bins.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end",
        F.coalesce("frequency", F.lit(0)).cast("bigint").alias("frequency"))


def histogram_by(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """One histogram per group, each over the group's own range.

    Equal values are counted first, so a group holding most rows shrinks on the
    map side.  How the ranges are joined is left to Spark, which knows their size
    at run time.
    """
    pairs = (df.where(F.col(group).isNotNull() & _number(value).isNotNull())
             .groupBy(group, _number(value).alias("_x"))
             .agg(F.count(F.lit(1)).alias("_n")))
    ranges = pairs.groupBy(group).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    low, high = _edges(F.col("_lo"), F.col("_hi"))
    ranges = ranges.select(
        group, low.alias("_low"), ((high - low) / bins).alias("_width"))
    counts = (pairs.join(ranges, group)
              .select(group, _bin_of(F.col("_x"), F.col("_low"), F.col("_width"), bins)
                      .cast("bigint").alias("bin"), "_n")
              .groupBy(group, "bin").agg(F.sum("_n").alias("_freq")))
    frame = ranges.select("*", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    return frame.join(counts, null_safe(frame, counts, [group, "bin"]), "left").select(
        frame[group], frame["bin"],
        (F.col("_low") + frame["bin"] * F.col("_width")).alias("bin_start"),
        (F.col("_low") + (frame["bin"] + 1) * F.col("_width")).alias("bin_end"),
        F.coalesce("_freq", F.lit(0)).cast("bigint").alias("frequency"))

"""Pivot grids and wide-to-long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_long(df: DataFrame, index: str, columns: str, out: str, agg: Column) -> DataFrame:
    """The cells of a grid, one row each; cells with a NULL label are not drawn."""
    labelled = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
    return labelled.groupBy(index, columns).agg(agg.alias(out))


def pivot_grid(df: DataFrame, index: str, columns: str, agg: Column,
               values: Sequence[object] | None = None, most: int = 2_000) -> DataFrame:
    """The same grid with one column per value.

    Without ``values`` the headers, one per distinct value, are looked up first; more than
    ``most`` of them are an error, since no grid of that width can be drawn.
    """
    labelled = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
    if values is None:
        found = labelled.select(columns).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{columns} has more than {most} values; give the wanted ones")
        values = sorted(r[0] for r in found)
    names = [str(v) for v in values]
    wide = labelled.groupBy(index).pivot(columns, list(values)).agg(agg)
    return wide.toDF(index, *names)


def to_long(df: DataFrame, ids: Sequence[str], labels: Mapping[str, str],
            name: str, value: str) -> DataFrame:
    """Unpivot the columns in ``labels`` and rename each to its label."""
    long = df.unpivot(list(ids), list(labels), name, value)
    recode = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return long.withColumn(name, recode[F.col(name)])

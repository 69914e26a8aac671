"""Writes small Avro files for tests and queries where Spark's Avro module is absent.

A fixture, not part of the library: it exists so that the Avro reader has files to read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.sources import storage, writers
from medallion.sources.avro import has_avro_module, stringify_all


def write_one(df: DataFrame, path: str, fmt: str) -> None:
    """``writers.write_one``, with Avro in any session."""
    if fmt == "avro" and not has_avro_module(df.sparkSession):
        write_avro_files(df, path)
    else:
        writers.write_one(df, path, fmt)


def write_avro_files(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    text = stringify_all(df)
    if storage.exists(spark, path):
        raise FileExistsError(path)
    staging = storage.qualified(spark, f"{path}/_temporary")
    storage.make_folder(spark, staging)
    # tasks write under unique names; files of attempts whose result arrived are moved
    records = text.select(_record(text.columns).alias("record"))
    done = records.mapInPandas(_part_writer(staging, text.columns), "file string").collect()
    for row in done:
        storage.move(spark, f"{staging}/{row.file}", f"{path}/{row.file}")


def _length(n: Column) -> Column:
    """Avro's variable-length code of a byte count: low seven bits first."""
    z = n.cast("bigint") * 2
    last = F.ceil(F.length(F.bin(z)) / 7).cast("int") - 1

    def byte(i: Column) -> Column:
        bits = F.call_function("shiftright", z, i * 7).bitwiseAND(F.lit(127))
        return F.lpad(F.hex(bits + F.when(i < last, 128).otherwise(0)), 2, "0")

    longer = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), last), byte), ""))
    return F.when(z < 128, F.char(z).cast("binary")).otherwise(longer)


def _record(columns: list[str]) -> Column:
    """One record of nullable strings: per field a branch number, then the text."""
    def field(name: str) -> Column:
        c = F.col(f"`{name}`")
        some = F.concat(F.unhex(F.lit("02")), _length(F.octet_length(c)), c.cast("binary"))
        return F.when(c.isNull(), F.unhex(F.lit("00"))).otherwise(some)
    return F.concat(*(field(c) for c in columns))


def _part_writer(folder: str, columns: list[str], block_rows: int = 4096):
    """Task function writing one partition.  Self-contained: it is shipped by value."""
    schema = json.dumps({"type": "record", "name": "Record", "fields": [
        {"name": c, "type": ["null", "string"]} for c in columns]})

    def write(batches):
        import zlib

        import pandas as pd
        from pyarrow import fs as arrow_fs

        def number(n: int) -> bytes:
            n, out = n << 1, bytearray()
            while n > 0x7F:
                out.append((n & 0x7F) | 0x80)
                n >>= 7
            out.append(n)
            return bytes(out)

        def text(s: str) -> bytes:
            raw = s.encode("utf-8")
            return number(len(raw)) + raw

        name = f"part-{uuid.uuid4().hex}.avro"
        marker = uuid.uuid4().bytes
        system, base = arrow_fs.FileSystem.from_uri(folder)
        with system.open_output_stream(f"{base}/{name}") as sink:
            sink.write(b"Obj\x01" + number(2)
                       + text("avro.schema") + text(schema)
                       + text("avro.codec") + text("deflate")
                       + number(0) + marker)
            for batch in batches:
                for start in range(0, len(batch), block_rows):
                    block = batch["record"].iloc[start:start + block_rows]
                    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                    body = packer.compress(b"".join(block)) + packer.flush()
                    sink.write(number(len(block)) + number(len(body)) + body + marker)
        yield pd.DataFrame({"file": [name]})

    return write

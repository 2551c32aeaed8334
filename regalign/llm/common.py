"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.session import materialize, scratch_path

#: A word is a run of anything but the ASCII blanks (space and U+0009-U+000D).  ``bytes.split()``
#: splits on exactly these six bytes.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

#: A table of at most this many rows may be broadcast (after counting it).
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of words of a text as a long (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS, salts: int = 32, rows: int | None = None) -> DataFrame:
    """Join ``df`` with a table that is expected to be small, null-safe on ``keys``.

    ``small`` is counted first (unless ``rows`` bounds it already).  Up to ``max_rows`` rows it is broadcast, so no key of ``df``
    is shuffled however hot it is; beyond that its rows are copied to ``salts`` salt values and
    the rows of ``df`` are spread over them, so a hot key is shared by that many tasks.
    """
    on = [F.col(f"_a_{k}") for k in keys]
    side = small.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    if (small.count() if rows is None else rows) <= max_rows:
        cond = [F.col(k).eqNullSafe(o) for k, o in zip(keys, on)]
        return df.join(F.broadcast(side), cond, how).drop(*[f"_a_{k}" for k in keys])
    if salts == 1:
        return df.join(side, [F.col(k).eqNullSafe(o) for k, o in zip(keys, on)], how).drop(*[f"_a_{k}" for k in keys])
    side = side.withColumn("_a_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(df)]), F.lit(salts)).cast("int"))
    cond = [F.col(k).eqNullSafe(o) for k, o in zip(keys, on)] + [F.col("_salt") == F.col("_a_salt")]
    return df.join(side, cond, how).drop("_salt", "_a_salt", *[f"_a_{k}" for k in keys])


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` if it is a Parquet scan (with filters or projections), else a copy written to the shared folder."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if "Relation" in node.nodeName():
        try:
            docs.select("_metadata.row_index")
            return docs
        except AnalysisException:  # not Parquet
            pass
    return materialize(docs, "scan")


def _key() -> list[Column]:
    return [F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r")]


def keyed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a ``scan`` plus a row key (``_f``, ``_r``) that is the same in every evaluation.

    The key is the Parquet file and the row's index in it.  It doesn't depend on how files are
    packed into tasks, so it stays valid when executors come and go between two passes, and rows
    with equal or null ids keep apart.
    """
    return docs.select(*columns, *_key())


def with_row_key(docs: DataFrame) -> DataFrame:
    """(_row, _f, _r) of a ``scan``: the whole row as one struct, so that no name can clash, and its key."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *_key())


def unpack(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of the ``_row`` struct."""
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])


def binary_list(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batch: pa.RecordBatch, text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose text column holds about ``limit`` bytes (a longer text is a piece of its own)."""
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), dtype=np.int64)
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(n)
    if at < batch.num_rows:
        yield batch.slice(at)


def sampled(df: DataFrame, key: str, rows: int, total: int, seed: int = 17) -> DataFrame:
    """All of ``df`` if it has at most ``rows`` rows (``total``), else about ``rows`` of them by a hash of ``key``."""
    if total <= rows:
        return df
    cut = math.floor(rows / total * 2**31)
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(2**31)) < F.lit(cut))


__all__ = ["BLANKS", "BROADCAST_ROWS", "WORD", "attach", "binary_list", "keyed", "materialize",
           "read_table", "sampled", "scan", "scratch_path", "slices", "unpack", "with_row_key", "word_count"]

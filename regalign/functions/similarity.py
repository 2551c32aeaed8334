"""Fuzzy name similarity as DataFrame operations.

Definitions (all ratios are integers 0..100):

* ``ratio(x, y)``: 100 if x == y, 0 if either is empty, else the indel ratio
  ``round_half_even(100 * (1 - (|x| + |y| - 2 * LCS(x, y)) / (|x| + |y|)))``.
* token processing of a name: drop characters U+0080..U+00FF, map non-word characters
  to spaces, lower-case, strip, split on whitespace.
* ``token_sort``: ratio of the sorted tokens joined by one space.
* ``token_set``: with I = sorted common distinct tokens, A = I + rest of the first,
  B = I + rest of the second: max(ratio(I, A), ratio(I, B), ratio(A, B));
  0 if either processed name is empty.
* ``similarity``: 0.0 if either name is empty, else ``w_r * R/100 + w_s * S/100 + w_t * T/100``
  (default weights 0.3, 0.4, 0.3), evaluated left to right.

Per-name derived strings are computed once per *distinct name* (``name_features``); per
pair only the token-set pieces and three LCS lengths are needed: LCS(a, b),
LCS(sorted a, sorted b) and LCS(A, B).  ``ratio(I, A)`` needs no LCS because I is a
prefix of A.  The LCS lengths come from the Arrow-batch kernel in ``lcs.py`` through
``mapInArrow``; everything else is JVM-side column arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regalign.functions.lcs import lcs_lengths
from regalign.functions.text import WORD_CHARS
from regalign.session import parallelism

DEFAULT_WEIGHTS = (0.3, 0.4, 0.3)


def processed(name: Column) -> Column:
    """Token processing: drop U+0080..U+00FF, non-word -> space, lower-case, strip."""
    out = F.regexp_replace(F.coalesce(name, F.lit("")), "[\\x{80}-\\x{FF}]", "")
    out = F.regexp_replace(out, f"[^{WORD_CHARS}]", " ")
    return F.trim(F.lower(out))


def tokens(name: Column) -> Column:
    return F.filter(F.split(processed(name), " ", -1), lambda t: t != F.lit(""))


def name_features(df: DataFrame, name_col: str, prefix: str) -> DataFrame:
    """Add the per-name strings the pair scorer needs, named ``{prefix}_...``.

    Call on a table of distinct names so the work is done once per name.
    """
    toks = tokens(F.col(name_col))
    return (
        df.withColumn(f"{prefix}_tokens", toks)
        .withColumn(f"{prefix}_sorted", F.array_join(F.array_sort(F.col(f"{prefix}_tokens")), " "))
        .withColumn(f"{prefix}_set", F.array_sort(F.array_distinct(F.col(f"{prefix}_tokens"))))
        .withColumn(f"{prefix}_plen", F.length(F.array_join(F.col(f"{prefix}_tokens"), "")))
        .drop(f"{prefix}_tokens")
    )


def ratio_from_lcs(x: Column, y: Column, lcs: Column) -> Column:
    """Integer indel ratio given the LCS length (equal -> 100, any empty -> 0)."""
    return ratio_from_sizes(F.length(x), F.length(y), x == y, lcs)


def ratio_from_sizes(lx: Column, ly: Column, equal: Column, lcs: Column) -> Column:
    """``ratio_from_lcs`` from the two lengths and the equality flag (no strings needed)."""
    total = lx + ly
    raw = F.lit(100.0) * (F.lit(1.0) - (total - F.lit(2) * lcs).cast("double") / total.cast("double"))
    return (
        F.when(equal, F.lit(100))
        .when((lx == 0) | (ly == 0), F.lit(0))
        .otherwise(F.bround(raw, 0).cast("int"))
    )


_LCS_COLS = ("_lcs_raw", "_lcs_sort", "_lcs_set")
_PAIR_INPUTS = (("_a", "_b"), ("_sa", "_sb"), ("_ca", "_cb"))
# strings the kernel reads but the JVM side no longer needs (their lengths and equality
# flags were computed before the Arrow step), so they are not sent back
_KERNEL_ONLY = ("_sa", "_sb", "_ca", "_cb")


def _upper(lx: np.ndarray, ly: np.ndarray, lcs: np.ndarray | None = None) -> np.ndarray:
    """Largest percentage the ratio of two strings can round to, from their lengths and their LCS if known."""
    total = np.maximum(lx + ly, 1)
    best = np.minimum(lx, ly) if lcs is None else lcs
    return np.where((lx + ly) == 0, 100.0, np.minimum(100.0, 200.0 * best / total + 0.5))


def _kernel(threshold: float | None, weights: tuple[float, float, float]):
    """The Arrow step: adds the three LCS lengths and, with a threshold, leaves out the pairs that can't reach it.

    The parts are worked out one after the other, and after each a pair goes whose score is below
    the threshold even if the parts still missing were as large as the lengths allow.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = []
            sizes = ("r", "s", "c")
            for step in range(3):
                at = batch.schema.names
                if threshold is not None and batch.num_rows:
                    best = np.zeros(batch.num_rows)
                    for i, tag in enumerate(sizes):
                        lx, ly = (batch.column(at.index(f"_l{tag}{x}")).to_numpy(zero_copy_only=False).astype(np.int64)
                                  for x in "xy")
                        part = _upper(lx, ly, found[i] if i < step else None)
                        if tag == "c":  # token_set also has the ratios of the common words with either side
                            li = batch.column(at.index("_li")).to_numpy(zero_copy_only=False).astype(np.int64)
                            part = np.maximum(part, np.maximum(_upper(li, lx, np.minimum(li, lx)),
                                                               _upper(li, ly, np.minimum(li, ly))))
                        best += weights[i] * part / 100.0
                    keep = np.flatnonzero(best >= threshold - 1e-9)
                    if len(keep) < batch.num_rows:
                        batch = batch.take(pa.array(keep))
                        found = [x[keep] for x in found]
                xa, xb = _PAIR_INPUTS[step]
                found.append(lcs_lengths(batch.column(at.index(xa)), batch.column(at.index(xb))))
            names = [n for n in batch.schema.names if n not in _KERNEL_ONLY]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.names.index(n)) for n in names] + [pa.array(x, type=pa.int64()) for x in found],
                names=names + list(_LCS_COLS))

    return run


def score_name_pairs(
    pairs: DataFrame,
    left: str = "l",
    right: str = "r",
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS,
    keep: list[str] | None = None,
    respread: bool = True,
    threshold: float | None = None,
) -> DataFrame:
    """Score pairs of names.

    ``pairs`` must carry, for each side ``p`` in (left, right), the columns produced by
    ``name_features``: ``{p}_name``, ``{p}_sorted``, ``{p}_set``, ``{p}_plen``.
    Returns ``{left}_name``, ``{right}_name``, the ``keep`` columns, ``ratio``,
    ``token_sort``, ``token_set`` (int) and ``similarity_score`` (double).  Six strings
    cross into Python; only the two names and integers come back.

    ``respread``: hash-spread the pairs over the cluster first (scoring is CPU-bound).
    Pass False when the pairs already come out of a join spread over enough partitions,
    which saves shuffling the pairs.

    ``threshold``: return the pairs that score at least that much; the others are dropped inside
    the kernel as soon as their bounds show it.
    """
    l, r = left, right
    if respread:
        # an explicit partition count is not coalesced away by AQE
        pairs = pairs.repartition(parallelism(pairs.sparkSession), F.col(f"{l}_name"), F.col(f"{r}_name"))
    sect = F.array_intersect(F.col(f"{l}_set"), F.col(f"{r}_set"))
    d1 = F.array_except(F.col(f"{l}_set"), F.col(f"{r}_set"))
    d2 = F.array_except(F.col(f"{r}_set"), F.col(f"{l}_set"))
    sect_s = F.array_join(sect, " ")
    strings = pairs.select(
        *(keep or []),
        F.coalesce(F.col(f"{l}_name"), F.lit("")).alias("_a"),
        F.coalesce(F.col(f"{r}_name"), F.lit("")).alias("_b"),
        F.col(f"{l}_sorted").alias("_sa"),
        F.col(f"{r}_sorted").alias("_sb"),
        sect_s.alias("_sect"),
        F.trim(F.concat_ws(" ", sect_s, F.array_join(d1, " "))).alias("_ca"),
        F.trim(F.concat_ws(" ", sect_s, F.array_join(d2, " "))).alias("_cb"),
        ((F.col(f"{l}_plen") == 0) | (F.col(f"{r}_plen") == 0)).alias("_no_tokens"),
    )

    def sizes(x: str, y: str, tag: str) -> list[Column]:
        return [F.length(x).alias(f"_l{tag}x"), F.length(y).alias(f"_l{tag}y"), (F.col(x) == F.col(y)).alias(f"_e{tag}")]

    # lengths and equality flags JVM-side, so only integers return from the kernel
    prepared = strings.select(
        *(keep or []), "_a", "_b", "_sa", "_sb", "_ca", "_cb", "_no_tokens",
        *sizes("_a", "_b", "r"), *sizes("_sa", "_sb", "s"), *sizes("_ca", "_cb", "c"),
        F.length("_sect").alias("_li"),
        (F.col("_sect") == F.col("_ca")).alias("_eia"), (F.col("_sect") == F.col("_cb")).alias("_eib"),
    )
    out_fields = [f for f in prepared.schema.fields if f.name not in _KERNEL_ONLY]
    out_schema = T.StructType(out_fields + [T.StructField(c, T.LongType(), False) for c in _LCS_COLS])
    bounded = threshold is not None and min(weights) >= 0
    with_lcs = prepared.mapInArrow(_kernel(float(threshold) if bounded else None, tuple(map(float, weights))), out_schema)

    c = F.col
    r_raw = ratio_from_sizes(c("_lrx"), c("_lry"), c("_er"), c("_lcs_raw"))
    r_sort = ratio_from_sizes(c("_lsx"), c("_lsy"), c("_es"), c("_lcs_sort"))
    r_set = F.when(c("_no_tokens"), F.lit(0)).otherwise(
        F.greatest(
            # the intersection string is a prefix of both others, so it is their LCS
            ratio_from_sizes(c("_li"), c("_lcx"), c("_eia"), c("_li")),
            ratio_from_sizes(c("_li"), c("_lcy"), c("_eib"), c("_li")),
            ratio_from_sizes(c("_lcx"), c("_lcy"), c("_ec"), c("_lcs_set")),
        )
    )
    w_r, w_s, w_t = (float(w) for w in weights)
    scored = with_lcs.select(
        c("_a").alias(f"{l}_name"), c("_b").alias(f"{r}_name"), *(keep or []),
        r_raw.alias("ratio"), r_sort.alias("token_sort"), r_set.alias("token_set"))
    sim = (
        c("ratio") / F.lit(100.0) * F.lit(w_r)
        + c("token_sort") / F.lit(100.0) * F.lit(w_s)
        + c("token_set") / F.lit(100.0) * F.lit(w_t)
    )
    empty = (c(f"{l}_name") == "") | (c(f"{r}_name") == "")
    scored = scored.withColumn("similarity_score", F.when(empty, F.lit(0.0)).otherwise(sim))
    return scored if threshold is None else scored.where(F.col("similarity_score") >= F.lit(float(threshold)))


def similarity_frame(df: DataFrame, a: str, b: str, weights=DEFAULT_WEIGHTS) -> DataFrame:
    """Convenience: score two name columns of any frame (features computed per row)."""
    base = df.withColumn("l_name", F.col(a)).withColumn("r_name", F.col(b))
    base = name_features(base, "l_name", "l")
    base = name_features(base, "r_name", "r")
    return score_name_pairs(base, "l", "r", weights, keep=[c for c in df.columns])

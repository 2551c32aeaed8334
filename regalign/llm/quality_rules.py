"""Quality rules: an ordered decision list learned from labelled text statistics by sequential covering."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import BLANKS, materialize, sampled, slices, unpack

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
          "n_digits", "n_punct"]
#: Features of the rules: name -> (numerator, denominator) over the counts, or one count.
FEATURES = {
    "n_words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "punct_share": ("n_punct", "word_chars"),
    "words_per_line": ("n_words", "n_lines"),
}
_CLASSES = [list(map(ord, c)) for c in (BLANKS, SYMBOLS, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:!?")]
FIT_ROWS = 50_000     # labelled rows the list is learned from, at most (about)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def repeated_words(words: list) -> int:
    """Words inside a 3-word window that occurs twice or more in the text (the first occurrence included)."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    n = Counter(grams)
    last, total = -1, 0
    for i, g in enumerate(grams):
        if n[g] > 1:
            total += i + 2 - max(last, i - 1)
            last = i + 2
    return total


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one whole text (null: empty)."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    blanks, symbols, upper, digits, punct = (int(seen[c].sum()) for c in _CLASSES)
    return (len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(set(words)), upper, digits, punct)


def statistics(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """(doc_id, counts...) for every row of ``docs`` (doc_id, text), over its whole text (null text: zeros).

    With ``whole_rows`` the rows are carried along as a struct ``_row``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] * whole_rows)
    carried = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n = np.array([text_counts(t) for t in part.column("text").to_pylist()],
                             dtype=np.int64).reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], *[pa.array(n[:, i]) for i in range(len(COUNTS))]],
                    [*carried, *COUNTS])

    schema = rows.select(*carried).schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    return rows.mapInArrow(run, schema)


def feature_columns() -> dict[str, Column]:
    """The features as column expressions over the counts (a zero denominator gives 0)."""
    out = {}
    for name, (a, b) in FEATURES.items():
        out[name] = F.col(a).cast("double") if b is None else F.when(
            F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(0.0)
    return out


@dataclass(frozen=True)
class Rule:
    """Reject if every (feature, '<=' or '>', threshold) holds; with its precision on the pruning rows."""

    tests: tuple[tuple[str, str, float], ...]
    precision: float

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, cut in self.tests:
            out = out & (features[name] <= cut if op == "<=" else features[name] > cut)
        return out

    def mask(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for name, op, cut in self.tests:
            v = x[:, names.index(name)]
            out &= v <= cut if op == "<=" else v > cut
        return out


def grow(x: np.ndarray, y: np.ndarray, names: list[str], cuts: list[np.ndarray], max_tests: int) -> list:
    """Add the test with the largest information gain for the rejects until none is gained or all covered are rejects."""
    tests: list = []
    on = np.ones(len(y), dtype=bool)
    while len(tests) < max_tests:
        p0, n0 = y[on].sum(), (~y[on]).sum()
        if p0 == 0 or n0 == 0:
            break
        best = None
        for j, name in enumerate(names):
            v = x[on, j]
            if not len(cuts[j]):
                continue
            at = np.searchsorted(cuts[j], v, side="left")      # v <= cuts[k] exactly for k >= at
            pos = np.cumsum(np.bincount(at[y[on]], minlength=len(cuts[j]) + 1))[:-1]
            neg = np.cumsum(np.bincount(at[~y[on]], minlength=len(cuts[j]) + 1))[:-1]
            for op, p, n in (("<=", pos, neg), (">", p0 - pos, n0 - neg)):
                gain = p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2(p0 / (p0 + n0)))
                k = int(np.argmax(gain))
                if p[k] > 0 and (best is None or gain[k] > best[0] + 1e-12):
                    best = (gain[k], (name, op, float(cuts[j][k])))
        if best is None or best[0] <= 1e-9:
            break
        name, op, cut = best[1]
        v = x[on, names.index(name)]
        low, high = v[v <= cut], v[v > cut]
        if len(low) and len(high):  # halfway between the rows on either side
            cut = float((low.max() + high.min()) / 2)
        tests.append((name, op, cut))
        on &= Rule(((name, op, cut),), 0).mask(x, names)
    return tests


def learn_list(x: np.ndarray, reject: np.ndarray, names: list[str], min_precision: float = 0.75,
               min_support: int = 5, max_rules: int = 12, max_tests: int = 4, bins: int = 64,
               seed: int = 3) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds, prune it on the rest, drop what it covers, repeat.

    A rule is pruned to the prefix of its tests with the best (p - n) / (p + n) on the pruning
    rows.  It joins the list if it covers at least ``min_support`` rejects there with a precision
    of ``min_precision``; the first rule that doesn't ends the list.  Thresholds come from
    ``bins`` quantiles of each feature (and of the rejects alone).
    """
    rules: list[Rule] = []
    if not len(reject):
        return rules
    order = np.random.default_rng(seed).permutation(len(reject))
    x, y = x[order], reject[order].astype(bool)
    held = np.arange(len(y)) % 3 == 2
    q = np.linspace(0, 1, bins + 1)
    while len(rules) < max_rules and y[~held].sum() >= min_support:
        g = ~held
        cuts = [np.unique(np.concatenate([np.quantile(x[g, j], q), np.quantile(x[g & y, j], q)])) for j in range(len(names))]
        tests = grow(x[g], y[g], names, cuts, max_tests)
        best = None
        for k in range(1, len(tests) + 1):
            on = Rule(tuple(tests[:k]), 0).mask(x[held], names)
            p, n = int(y[held][on].sum()), int((~y[held])[on].sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if best is None or worth > best[0] + 1e-12:
                best = (worth, k, p, n)
        if best is None or best[2] < min_support or best[2] / (best[2] + best[3]) < min_precision:
            break
        rule = Rule(tuple(tests[: best[1]]), best[2] / (best[2] + best[3]))
        rules.append(rule)
        rest = ~rule.mask(x, names)
        x, y, held = x[rest], y[rest], held[rest]
    return rules


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **params) -> list[Rule]:
    """The decision list learned from the rows of ``labels`` (doc_id, quality; 0: reject) that have statistics.

    At most about ``fit_rows`` labelled rows are used, chosen by a hash of doc_id, and where ids
    have many rows by a hash of the row; equal rows and equal labels of an id count once.  Null
    labels and ids are left out.  No labelled rows, or one class only: an empty list, which keeps all.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias("reject")).distinct()
    marked = sampled(marked, "doc_id", fit_rows, marked.count())
    features = feature_columns()
    rows = stats.where(F.col("doc_id").isNotNull()).join(marked, "doc_id").select(
        "doc_id", "reject", *[c.alias(f"f_{n}") for n, c in features.items()])
    names = [f"f_{n}" for n in features]
    rows = rows.withColumn("_row", F.xxhash64("doc_id", *names))
    rows = sampled(rows, "_row", fit_rows, rows.count(), seed=19).drop("_row").distinct()
    got = rows.orderBy("doc_id", "reject", *names).toPandas()
    return learn_list(got[names].to_numpy(dtype=np.float64), got["reject"].to_numpy(dtype=bool),
                      list(features), **params)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """The list as ordered conditional expressions: (keep as boolean, number of the first rule that fires or null)."""
    features = feature_columns()
    keep, fired = F.lit(True), F.lit(None).cast("int")
    if rules:
        keep = fired = None
        for i, rule in enumerate(rules):
            cond = rule.column(features)
            keep = F.when(cond, F.lit(False)) if keep is None else keep.when(cond, F.lit(False))
            fired = F.when(cond, F.lit(i + 1)) if fired is None else fired.when(cond, F.lit(i + 1))
        keep = keep.otherwise(F.lit(True))
    return keep, fired


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated 3-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **params) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the rule that fired, for every row of ``docs`` (doc_id, text).

    ``kept`` is false where the base rules fail, else what the learned list says (no rule fires:
    kept).  The list is learned from labelled rows that pass the base rules, the only ones it
    judges.  Null and empty texts count as empty and fail the base rules; repeated rows keep their
    rows; null ids are scored but never matched to a label; an empty table gives no rows; other
    columns aren't read.
    """
    stats = materialize(statistics(docs).withColumn("base_failed", base_failed()), "statistics")
    keep, fired = verdict(fit(stats.where(~F.col("base_failed")), labels, fit_rows, **params))
    return stats.withColumn("rule", fired).withColumn("kept", ~F.col("base_failed") & keep)


def good_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **params) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``quality_rules`` keeps; texts are never shuffled."""
    marked = labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id")).distinct()
    stats = statistics(docs.select("doc_id", "text")).where(~base_failed())
    stats = materialize(stats.join(marked, F.col("doc_id") == F.col("_id"), "left_semi"), "statistics")
    keep, _ = verdict(fit(stats, labels, fit_rows, **params))
    return unpack(statistics(docs, whole_rows=True).where(~base_failed() & keep), docs.columns)

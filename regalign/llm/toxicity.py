"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts is the unlabelled mixture.  With
class prior p and logistic loss l, a linear classifier g minimises

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]),

where a negative bracket (overfitting) turns the step round instead of being followed.  Several
numpy classifiers are fitted, each on a bounded bag of rows in a task of its own, and averaged.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import materialize, slices

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 6, 7, 8)  # leading letters of longer words, so that inflected and compound forms share a feature
BAGS = 6                 # classifiers
BAG_POSITIVES = 1_500    # rows a bag is fitted on, at most (about)
BAG_UNLABELLED = 3_000
FEATURES = 1_000         # of one classifier
MIN_GAP = 4.0            # standard errors by which a feature must be more frequent among positives
MIN_POSITIVES = 5        # positive texts a feature must occur in


def words_of(text: str | None) -> set[str]:
    """The distinct lower-cased words (runs of letters) of a whole text."""
    return set(TOKEN.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words and their prefixes (marked with ^)."""
    return words | {f"^{w[:k]}" for w in words for k in PREFIXES if len(w) > k}


def choose(pos: list[set[str]], unl: list[set[str]], size: int = FEATURES, least: int = MIN_POSITIVES) -> list[str]:
    """Features more frequent among the positives, by how far above their share among the unlabelled they are.

    What clean texts have more of says little about a text that also has an insult, and a long
    text has a lot of it, so such features are not used.
    """
    a, b = (Counter(f for s in rows for f in features_of(s)) for rows in (pos, unl))
    n, m = len(pos), len(unl)
    least = min(least, max(1, n // 20))
    gap = {}
    for f in a:
        if a[f] >= least:
            pooled = (a[f] + b[f]) / (n + m)
            z = (a[f] / n - b[f] / m) / np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m) + 1e-12)
            if z >= MIN_GAP:
                gap[f] = z
    return sorted(gap, key=lambda f: (-gap[f], f))[:size]


class Rows:
    """Presence of the chosen features in each row, as row and feature numbers."""

    def __init__(self, rows: list[set[str]], features: list[str]):
        at = {f: i for i, f in enumerate(features)}
        found = [sorted(at[f] for f in features_of(s) if f in at) for s in rows]
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in found])
        self.col = np.array([i for x in found for i in x], dtype=np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        """Gradient of the weights and, last, the bias, for a mean over the rows."""
        return np.append(np.bincount(self.col, weights=g[self.row], minlength=size), g.sum()) / self.n


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def nn_pu(pos: Rows, unl: Rows, size: int, prior: float, steps: int = 300, rate: float = 0.05,
          decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the non-negative risk with logistic loss, by Adam."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        zp, zu = pos.times(w[:-1]) + w[-1], unl.times(w[:-1]) + w[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        # risk of the unlabelled as negatives, less the positives' share of it
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        negative = unl.back(su, size) - prior * pos.back(sp, size)
        grad = prior * pos.back(sp - 1, size) + negative if rest >= 0 else -negative
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_bag(bag: pd.DataFrame, prior: float) -> pd.DataFrame:
    """(bag, feature, weight): a classifier of one bag, its bias under the empty feature."""
    rows = [words_of(t) for t in bag["text"]]
    y = bag["toxic"].to_numpy(dtype=bool)
    pos, unl = [r for r, k in zip(rows, y) if k], [r for r, k in zip(rows, y) if not k]
    if not pos or not unl:
        return pd.DataFrame({"bag": pd.Series(dtype="int32"), "feature": pd.Series(dtype="str"),
                             "weight": pd.Series(dtype="float64")})
    chosen = choose(pos, unl)
    w, b = nn_pu(Rows(pos, chosen), Rows(unl, chosen), len(chosen), prior)
    return pd.DataFrame({"bag": int(bag["bag"].iloc[0]), "feature": ["", *chosen], "weight": [b, *w.tolist()]})


def bag_rows(docs: DataFrame, chosen: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """(bag, toxic, doc_id, text): the distinct rows of the ``chosen`` (doc_id, toxic, bag), a bounded table.

    A bag with more than the given numbers of rows (ids may have any number) is thinned out to
    about them by a hash of id and text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = materialize(rows.select("bag", "toxic", "doc_id", "text").distinct(), "bag_rows")
    most = F.when(F.col("toxic"), F.lit(positives)).otherwise(F.lit(unlabelled))
    rates = rows.groupBy("bag", "toxic").agg((F.max(most) / F.count(F.lit(1))).alias("rate"))  # two rows a bag
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(37)), F.lit(2**31)) / F.lit(float(2**31))
    return rows.join(F.broadcast(rates), ["bag", "toxic"]).where(draw < F.col("rate")).drop("rate")


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, bags: int = BAGS,
        positives: int = BAG_POSITIVES, unlabelled: int = BAG_UNLABELLED) -> dict[str, float]:
    """Averaged feature weights ('' holds the bias) learned from ``docs`` and the confirmed rows of ``labels``.

    Only label 1 is used as a label, and the share of 1 among the labelled rows as the class prior
    unless ``prior`` is given.  Bags are filled by a hash of doc_id with at most about the given
    numbers of rows; where ids have many rows, rows are drawn by a hash of id and text, and equal
    rows count once.  Without positives the model is empty and scores every text 0.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
    marked = marked.groupBy("doc_id").agg(F.bool_or("toxic").alias("toxic"))
    n, k = marked.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    total = docs.count()
    if not k or not total:
        return {}
    prior = min(0.95, max(0.005, prior if prior is not None else k / n))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(2**31)) / F.lit(float(2**31))
    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    unl = ids.where(draw < bags * unlabelled / total).withColumn("toxic", F.lit(False))
    pos = ids.join(marked.where("toxic"), "doc_id").where(draw < bags * positives / k)
    chosen = pos.unionByName(unl).withColumn("bag", F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(bags)).cast("int"))
    chosen = materialize(chosen, "bags")
    rows = bag_rows(docs, chosen, positives, unlabelled)

    def one(bag: pd.DataFrame) -> pd.DataFrame:
        return fit_bag(bag.sort_values(["doc_id", "toxic", "text"], na_position="first"), prior)

    got = rows.groupBy("bag").applyInPandas(one, "bag int, feature string, weight double").toPandas()
    fitted = got["bag"].nunique()
    got = got.sort_values(["feature", "bag"])
    mean = got.groupby("feature")["weight"].sum() / max(1, fitted)
    return {f: float(x) for f, x in mean.items() if abs(x) > 1e-3 or not f}


def scores(docs: DataFrame, model: dict[str, float]) -> DataFrame:
    """(doc_id, score) of every whole text: the logistic of its features' weights; empty texts included."""
    bias = model.get("", -60.0)
    weights = {f: x for f, x in model.items() if f}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                z = [bias + sum(weights[f] for f in sorted(f for f in features_of(words_of(t)) if f in weights))
                     for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(np.array(z)))],
                                                 ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, score double")


def held_out_part(doc_id, parts: int, part: int):
    """Whether crc32 of the id as text falls into the given remainder (null id: not)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Learns from rows whose crc32(doc_id) mod ``parts`` is not ``part``, and scores all.  Null and
    empty texts get the score of a text without words; null ids are scored and never learned from;
    repeated rows keep their rows; an empty table gives no rows; other columns are not read.
    """
    model = fit(docs.where(~held_out_part("doc_id", parts, part)), labels.where(~held_out_part("doc_id", parts, part)),
                **params)
    out = scores(docs, model)
    return out.select("doc_id", held_out_part("doc_id", parts, part).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

"""Language identification with a string kernel.

The blended-spectrum presence kernel of two texts counts the character n-grams (n = 1..3) both
hold, over the root of the product of their own counts.  A bounded sample of landmark texts gives
Nystroem features phi(x) = k(x, landmarks) K^(-1/2); one-versus-rest kernel ridge regression is
solved on the sums phi'phi and phi'y gathered from a bounded training sample.  Landmarks, Nystroem
map and regression fold into one matrix of n-grams by languages; texts are scored by batched
products of their presence matrix with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regalign.llm.common import materialize, slices
from regalign.llm.toxicity import held_out_part

LANDMARKS = 48            # per language
ALL_LANDMARKS = 2_400     # of all languages together: with more than 50 languages each has fewer
TRAIN_ROWS = 1_500        # per language, at most (about)
BATCH = 64                # texts scored in one matrix product
MAX_LANGUAGES = 400       # languages learned, the most frequent first
RIDGE = 1e-2
UNKNOWN = "und"
_BITS = 21                # of a code point; three fill 63 bits


def symbols(text: str) -> np.ndarray:
    """Lower-cased code points with every run of non-letters as one blank, blanks at both ends."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    x = np.where(_letters(x), x, 32)
    x = np.concatenate([[32], x, [32]])
    return x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]


_table: list[np.ndarray] = []


def _letters(x: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter or a mark."""
    if not _table:
        _table.append(np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)]))
    return _table[0][x]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Grams:
    """n-gram numbers over whole code points, and their place in a sorted vocabulary.

    A number is the n-gram's code points side by side, so no two n-grams share one.  With an
    ``alphabet``, all symbols outside it are one more; without, every symbol is told apart.
    """

    def __init__(self, alphabet: list[int] | None = None, vocabulary: np.ndarray | None = None):
        self.alphabet = None if alphabet is None else np.array(sorted(alphabet), dtype=np.uint32)
        self.vocabulary = np.zeros(0, dtype=np.int64) if vocabulary is None else vocabulary
        self.width = len(self.vocabulary)

    def numbers(self, text: str) -> np.ndarray:
        x = symbols(text)
        c = (x if self.alphabet is None else np.where(np.isin(x, self.alphabet), x, 0)).astype(np.int64)
        two = c[:-1] << _BITS | c[1:]
        three = two[:-1] << _BITS | c[2:]
        return np.concatenate([c, two, three])

    def places(self, text: str) -> np.ndarray:
        """Sorted places of the text's distinct n-grams that are in the vocabulary."""
        if not self.width:
            return np.zeros(0, dtype=np.int64)
        x = np.unique(self.numbers(text))
        at = np.searchsorted(self.vocabulary, x)
        at[at == self.width] = 0
        return at[self.vocabulary[at] == x]

    def presence(self, texts: list[str]) -> np.ndarray:
        """0/1 matrix of texts by vocabulary, each row over its root (a row without n-grams is 0)."""
        out = np.zeros((len(texts), self.width), dtype=np.float32)
        for i, t in enumerate(texts):
            at = self.places(t)
            out[i, at] = 1 / np.sqrt(max(1, len(at)))
        return out


class Landmarks:
    """The kernel of texts with the landmarks, from the list of landmarks that hold each n-gram."""

    def __init__(self, texts: list[str]):
        self.vocabulary = np.unique(np.concatenate([np.unique(Grams().numbers(t)) for t in texts]))
        grams = Grams(vocabulary=self.vocabulary)
        self.held = [grams.places(t) for t in texts]
        sizes = np.array([len(x) for x in self.held])
        self.scale = 1 / np.sqrt(np.maximum(1, sizes))
        at = np.concatenate(self.held)
        self.who = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[np.argsort(at, kind="stable")]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(self.vocabulary)))])

    def kernel(self, held: list[np.ndarray]) -> np.ndarray:
        """k(text, landmark); the texts are given by their places."""
        out = np.zeros((len(held), len(self.scale)))
        for i, at in enumerate(held):
            n = self.start[at + 1] - self.start[at]
            if n.sum():
                each = np.arange(n.sum()) + np.repeat(self.start[at] - np.cumsum(n) + n, n)
                out[i] = np.bincount(self.who[each], minlength=len(self.scale)) * self.scale / np.sqrt(len(at))
        return out

    def weights(self, beta: np.ndarray) -> np.ndarray:
        """n-grams by languages, so that presence @ weights = kernel @ beta."""
        out = np.zeros((len(self.vocabulary), beta.shape[1]), dtype=np.float32)
        for at, row in zip(self.held, self.scale[:, None] * beta):
            out[at] += row.astype(np.float32)
        return out


class Model:
    """Scores are presence @ weights: the landmarks, the Nystroem map and the regression in one matrix."""

    def __init__(self, vocabulary: np.ndarray, weights: np.ndarray, languages: list[str]):
        self.vocabulary, self.weights, self.languages = vocabulary, weights, languages

    def predict(self, texts: list[str], grams: Grams) -> tuple[list[str], np.ndarray]:
        held = [grams.places(t) for t in texts]
        sizes = np.array([len(x) for x in held])
        used, column = np.unique(np.concatenate(held), return_inverse=True)  # the batch's part of the vocabulary
        presence = np.zeros((len(texts), len(used)))
        presence[np.repeat(np.arange(len(texts)), sizes), column] = np.repeat(1 / np.sqrt(np.maximum(1, sizes)), sizes)
        z = presence @ self.weights[used].astype(np.float64)
        best = z.argmax(axis=1)
        e = np.exp(8 * (z - z.max(axis=1, keepdims=True)))
        return [self.languages[i] for i in best], (e.max(axis=1) / e.sum(axis=1)).astype(float)


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS, most: int = MAX_LANGUAGES) -> DataFrame:
    """(doc_id, text, lang, draw): up to about ``rows`` texts per language, by a hash of id and text.

    Rows that share an id, or have none, are drawn each on its own; equal rows count once.  So the
    bound holds whatever the ids are.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(13)), F.lit(2**31)) / F.lit(float(2**31))
    at = known.withColumn("draw", draw).join(F.broadcast(counts), "lang")  # at most ``most`` rows
    return at.where(F.col("draw") * F.col("n") < rows).select("doc_id", "text", "lang", "draw").distinct()


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model learned from text and non-null lang of ``docs``; none without such rows."""
    train = materialize(training_rows(docs, rows), "train")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))  # of the bounded sample
    marks = train.withColumn("k", first).where(F.col("k") <= landmarks).orderBy("lang", "k").select("text", "lang").toPandas()
    marks = marks[[has_letter(t) for t in marks["text"]]]
    if not len(marks):
        return None
    marks = marks.groupby("lang").head(max(1, ALL_LANDMARKS // marks["lang"].nunique()))
    texts, languages = marks["text"].tolist(), sorted(set(marks["lang"]))
    base = Landmarks(texts)
    kernel = base.kernel(base.held)
    value, vector = np.linalg.eigh(kernel)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    size = root.shape[1]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(vocabulary=base.vocabulary)
        at = {x: i for i, x in enumerate(languages)}
        gram, cross = np.zeros((size, size)), np.zeros((size, len(languages)))
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                phi = base.kernel([grams.places(t) for t in part.column("text").to_pylist()]) @ root
                y = np.full((len(phi), len(languages)), -1.0)
                for i, x in enumerate(part.column("lang").to_pylist()):
                    if x in at:
                        y[i, at[x]] = 1
                gram += phi.T @ phi
                cross += phi.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([cross.tobytes()])], ["gram", "cross"])

    # the sample is bounded, so a few tasks are enough and so are their sums
    sums = train.select("text", "lang").coalesce(8).mapInArrow(gather, "gram binary, cross binary").collect()
    gram = np.sum([np.frombuffer(r["gram"]).reshape(size, size) for r in sums], axis=0)
    cross = np.sum([np.frombuffer(r["cross"]).reshape(size, -1) for r in sums], axis=0)
    beta = np.linalg.solve(gram + ridge * np.trace(gram) / size * np.eye(size), cross)
    return Model(base.vocabulary, base.weights(root @ beta), languages)


def language(docs: DataFrame, parts: int = 4, part: int = 2, **params) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang).

    Learns from rows whose crc32(doc_id) mod ``parts`` is not ``part``; predictions see the text
    alone.  Null texts and texts without a letter, and all texts if nothing could be learned, get
    ``und`` with score 0.  Repeated rows and null ids keep their rows (a null id counts as learnable);
    an empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.where(~held_out_part("doc_id", parts, part)), **params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(vocabulary=model.vocabulary) if model else None
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                texts = piece.column("text").to_pylist()
                name, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                on = [i for i, t in enumerate(texts) if model and has_letter(t)]
                for at in range(0, len(on), BATCH):
                    some = on[at:at + BATCH]
                    found, p = model.predict([texts[i] for i in some], grams)
                    score[some] = p
                    for i, x in zip(some, found):
                        name[i] = x
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(name), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out_part("doc_id", parts, part).alias("held_out"), "lang_pred", "score")

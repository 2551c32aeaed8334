"""Token counts as a rollup that is maintained by deltas.

Documents are tokenised once, when they arrive.  Inserts, deletes and revised counts become signed
rows, which are summed by source, language and tokenizer version and written as one small Parquet
folder per batch.  Totals are the sum over all committed batches.  A batch counts once however
often it is sent: its folder is complete when the writer's success marker is there, a complete
batch is never written again, and an interrupted one is replaced as a whole.  Compaction folds all
batches into one and keeps their names, so none of them counts again in the compacted rollup.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.llm.common import slices, word_count

#: Fixed value: the pre-tokenizer pattern published with the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_words"]


def count_tokens(docs: DataFrame, vocabulary: str, version: str, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_words) for every whole text (null text: 0).

    ``vocabulary`` is a file of ranks, read where the driver runs and shipped to the tasks;
    ``version`` names it in the totals.  Repeated rows and null ids are rows of their own; null
    sources and languages are keys like any other; an empty table gives no rows; other columns are
    not read, whatever their names.
    """
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=shipped.value, special_tokens={}).encode_ordinary
        for batch in batches:
            for part in slices(batch, "text"):
                n = [len(encode(t)) if t else 0 for t in part.column("text").to_pylist()]
                keep = [part.column(c) for c in ("doc_id", "source", "lang", "n_words")]
                yield pa.RecordBatch.from_arrays([*keep[:3], pa.array(n, pa.int64()), keep[3]],
                                                 ["doc_id", "source", "lang", "n_tokens", "n_words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), "text", word_count(F.col("text")).alias("n_words"))
    out = rows.mapInArrow(run, "doc_id long, source string, lang string, n_tokens long, n_words long")
    return out.withColumn("tokenizer", F.lit(version))


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add the counted documents."""
    return _signed(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take the counted documents away."""
    return _signed(counts, -1)


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that replace counts: the old rows leave and the new ones come (source, language or tokenizer may differ)."""
    return _signed(old, -1).unionByName(_signed(new, 1))


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"),
                         *[(F.lit(sign) * F.col(c)).cast("long").alias(c) for c in SUMS[1:]])


class Rollup:
    """Additive totals in a folder on shared storage, one subfolder per committed batch.

    One writer at a time.  Changes are taken as they come: taking away what was never added makes a
    total negative, which ``totals`` shows and ``below_zero`` lists.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._folded: set[str] | None = None

    def _path(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch) or batch.startswith((".", "_")):
            raise ValueError(f"batch names are letters, digits, dots and dashes: {batch!r}")
        return f"{self.root}/batch={batch}"

    def _files(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _written(self, batch: str) -> bool:
        p, fs = self._files(f"{self._path(batch)}/_SUCCESS")
        return fs.exists(p)

    def folded(self) -> set[str]:
        """Names of the batches that were folded into this rollup's first one."""
        if self._folded is None:
            p, fs = self._files(f"{self.root}/folded/_SUCCESS")
            rows = self.spark.read.schema("name string").parquet(f"{self.root}/folded").collect() if fs.exists(p) else []
            self._folded = {r["name"] for r in rows}
        return self._folded

    def committed(self, batch: str) -> bool:
        return self._written(batch) or batch in self.folded()

    def batches(self) -> list[str]:
        """Names of the batches that have a folder here."""
        p, fs = self._files(self.root)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n[6:] for n in names if n.startswith("batch=") and self._written(n[6:]))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add the sums of ``changes`` (keys and signed sums) as ``batch``; False if it was there already."""
        if self.committed(batch):
            return False
        sums = changes.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._path(batch))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens, n_words) over all committed batches, without groups that are all zero."""
        paths = [self._path(b) for b in self.batches()]
        schema = ", ".join([f"{c} string" for c in KEYS] + [f"{c} long" for c in SUMS])
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        out = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return out.where(" OR ".join(f"{c} <> 0" for c in SUMS))

    def below_zero(self) -> DataFrame:
        """Totals of groups that lost more than they had."""
        return self.totals().where(" OR ".join(f"{c} < 0" for c in SUMS))

    def compact(self, name: str) -> Rollup:
        """Fold all batches into the one batch ``name`` of a new rollup beside this one, and return it.

        The names of the folded batches go with it (first, so that an interrupted compaction never
        yields totals without them): sending one again changes nothing there either.
        """
        other = Rollup(self.spark, f"{self.root}-{name}")
        if not other.committed(name):
            names = sorted({*self.batches(), *self.folded()})
            self.spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("overwrite").parquet(f"{other.root}/folded")
            other._folded = None
            other.commit(name, self.totals())
        return other

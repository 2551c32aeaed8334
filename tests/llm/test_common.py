import pyarrow as pa
from pyspark.sql import functions as F

from regalign.llm.common import attach, keyed, sampled, scan, slices, unpack, with_row_key, word_count


def test_attach_gives_the_same_rows_each_way(spark):
    left = spark.createDataFrame([("hot", i) for i in range(200)] + [(None, 1), ("b", 2), ("x", 3)], "k string, v int")
    small = spark.createDataFrame([("hot", 1.0), (None, 2.0), ("b", 3.0)], "k string, w double")
    ways = [{}, {"max_rows": 0, "salts": 4}, {"max_rows": 0, "salts": 1}, {"rows": 3}]
    for how in ("left", "inner"):
        got = [sorted(map(tuple, attach(left, small, ["k"], how, **w).select("k", "v", "w").collect()), key=repr) for w in ways]
        assert all(g == got[0] for g in got) and len(got[0]) == (203 if how == "left" else 202)
    assert (None, 1, 2.0) in got[0]


def test_row_keys_tell_equal_rows_apart_and_stay(write):
    docs = write([(1, "a")] * 30 + [(None, None)] * 5, "doc_id long, text string")
    assert scan(docs) is docs and scan(docs.where("doc_id = 1")).count() == 30
    keys = keyed(docs, ["doc_id"])
    assert keys.select("_f", "_r").distinct().count() == 35
    again = keyed(docs, ["doc_id"])
    assert keys.join(again.drop("doc_id"), ["_f", "_r"]).count() == 35
    joined = docs.crossJoin(docs.limit(2).select(F.lit(1).alias("one")))  # rows of a file twice: not a scan
    fixed = scan(joined)
    assert fixed is not joined and keyed(fixed, ["doc_id"]).select("_f", "_r").distinct().count() == 70
    assert unpack(with_row_key(docs), docs.columns).exceptAll(docs).isEmpty()


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["x" * 10, None, "y" * 100, "", "z"])})
    parts = list(slices(batch, "text", 20))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist() and len(parts) == 3


def test_sampled_and_words(spark):
    df = spark.range(10_000).toDF("id")
    assert sampled(df, "id", 20_000, 10_000).count() == 10_000 and 800 < sampled(df, "id", 1000, 10_000).count() < 1200
    texts = spark.createDataFrame([(None,), ("",), (" a\x0bb c\td ",)], "t string")
    assert [r.n for r in texts.select(word_count(F.col("t")).alias("n")).collect()] == [0, 0, 3]

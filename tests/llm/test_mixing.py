import re

import pytest
from pyspark.sql import functions as F

from regalign.llm.mixing import mix, mixed, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    rest, left, out = share * sum(sizes.values()), set(names), {}
    while left:
        total = sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * rest / total > 2 * sizes[s]]
        if not over:
            return {**out, **{s: weight[s] * rest / total for s in left}}
        for s in over:
            out[s] = 2 * sizes[s]
            left.discard(s)
        rest -= sum(2 * sizes[s] for s in over)
    return out


def test_targets_against_brute_force(spark):
    sizes = {"b": 10, "a": 1000, "é": 5, "Z": 300, None: 77, "zz": 0, "c": 4000}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_of_the_corpus(docs, corpus, wide):
    rows = mix(docs).collect()
    assert len(rows) == len(corpus)
    size, taken, target, ids = {}, {}, {}, []
    for r in rows:
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
        ids.append((r.doc_id, r.size))
    assert sorted(ids, key=repr) == sorted(((x[0], len(WORD.findall(x[1] or ""))) for x in corpus), key=repr)
    assert target == pytest.approx(brute_targets(size))
    assert all(r.source_size == size[r.source] for r in rows)
    # a source is short by a few words, or no document that has a copy left fits
    for s in size:
        spare = [r.size for r in rows if r.source == s and r.copies < 2 and 0 < r.size <= target[s] - taken[s]]
        assert taken[s] <= target[s] + 1e-6
        assert target[s] - taken[s] < max(2, 0.01 * target[s]) or not spare
    again = mix(docs).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
    out = mixed(wide)
    assert out.columns == [*wide.columns, "_copy"]
    assert out.count() == sum(r.copies for r in rows)


def test_rates_are_the_tilted_solution(write):
    rows = [(i, "w " * (1 + i * 7 % 50), "s" if i % 4 else "t") for i in range(400)]
    out = mix(write(rows, "doc_id long, text string, source string"))
    got = out.groupBy("source").agg(F.sum(F.col("rate") * F.col("size")).alias("words"), F.first("target").alias("target"),
                                    F.first("source_size").alias("n")).collect()
    for r in got:
        assert r.words == pytest.approx(r.target, rel=1e-6)
    # ln(w / (2 - w)) is proportional to the size within a source
    open_rows = out.where("rate > 0 and rate < 1.999999 and size > 0")
    spread = open_rows.groupBy("source").agg(F.min(F.expr("ln(rate / (2 - rate)) / size")).alias("a"),
                                             F.max(F.expr("ln(rate / (2 - rate)) / size")).alias("b")).collect()
    assert spread and all(r.a == pytest.approx(r.b, rel=1e-6, abs=1e-9) for r in spread)


def test_blank_and_empty_tables(write, empty):
    assert mix(empty).count() == 0 and mixed(empty).count() == 0
    blank = mix(write([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0), (0.0, 0)]


def test_rows_without_id_are_drawn_one_by_one(write):
    rows = [(None, "w " * 40, "a")] * 1000 + [(None, f"x{i} " * 40, "b") for i in range(1000)]
    rows += [(i, "v " * (1 + i % 30), s) for i in range(500) for s in "ab"]
    got = mix(write(rows, "doc_id long, text string, source string")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("words")).collect()
    assert len(got) == 2
    for r in got:
        assert 0 < r.target <= 2 * r.words and 0 <= r.target - r.taken < 40


def test_a_pass_joins_one_table_of_sources_however_many_decisions(docs):
    """All decisions are columns of one table: rows meet it and the repeated rows, nothing for each decision."""
    plan = mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Join ") for line in plan.splitlines()) == 2


def test_one_word_documents_and_many_sources_fill_their_targets(write):
    rows = [(i, "w " * (i % 3), f"s{i % 40}" if i % 41 else None) for i in range(1200)]
    got = mix(write(rows, "doc_id long, text string, source string"))
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                    F.sum(F.when(F.col("copies") < 2, F.col("size"))).alias("spare")).collect()
    assert len(per) == 41
    for r in per:
        assert r.taken <= r.target + 1e-6 and (r.target - r.taken < 2 or not r.spare)

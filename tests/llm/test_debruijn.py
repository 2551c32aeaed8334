import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from prose import prose

from regalign.llm.debruijn import Segments, bit_filter, compact, in_filter, inner_size, remove_repeats


def brute(texts, k):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k", [35, 5])
def test_whole_table_against_brute_force(docs, corpus, k):
    want = sorted(((r[0], *b) for r, b in zip(corpus, brute([r[1] for r in corpus], k))), key=repr)
    assert result(remove_repeats(docs, k)) == want


def test_edited_copies_overlaps_and_periods(write):
    rng = random.Random(9)
    base = prose(rng, 400).split()
    texts = [" ".join(base)]
    for _ in range(12):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 2)] = prose(rng, rng.randint(0, 2)).split()
        texts.append(" ".join(w[rng.randint(0, 50):]))
    texts += ["p q r " * 40, "z " * 36, "z " * 35, " ".join(base[100:135]), " ".join(base[200:234])]
    docs = write(list(enumerate(texts)), "doc_id long, text string")
    assert result(remove_repeats(docs, 35)) == sorted(((i, *b) for i, b in enumerate(brute(texts, 35))), key=repr)


def test_a_full_filter_changes_nothing():
    table = np.full(4, 2**64 - 1, dtype=np.uint64)
    assert in_filter(table, np.array([1, 2**63], dtype=np.uint64)).all()


def test_filter_keeps_every_value(spark):
    values = np.random.default_rng(1).integers(-2**63, 2**63, 500)
    table = bit_filter(spark.createDataFrame([(int(v),) for v in values], "m long"), 1 << 12)
    assert in_filter(table, values.view(np.uint64)).all()


def test_segments_cover_every_window_once():
    rng = random.Random(3)
    texts = [prose(rng, n).encode() for n in (10, 35, 36, 200)] + [None, b""]
    s = Segments(texts, 35)
    windows = sorted((int(d), int(a - s.first[d]) + i) for d, a, n in zip(s.doc, s.at, s.windows) for i in range(n))
    assert windows == [(1, 0), (2, 0), (2, 1), *[(3, i) for i in range(166)]]
    assert s.windows.max() <= 35 - inner_size(35) + 1


def test_paths_join_through_unbranched_nodes_only(spark):
    # 1 -> 2 -> 3 -> {4, 5}; 6 -> 7 -> 6 is a ring
    rows = [(m, 0, 1, 0, 0, 1, h, t) for m, (h, t) in enumerate([(1, 2), (2, 3), (3, 4), (3, 5), (6, 7), (7, 6)])]
    pieces = spark.createDataFrame(rows, "m long, o int, n int, c long, i int, j int, head long, tail long")
    path = {r.m: r.path for r in compact(pieces).collect()}
    assert path[0] == path[1] and len({path[1], path[2], path[3], path[4], path[5]}) == 5


def test_kept_text_empty_table_and_other_columns(docs, wide, empty):
    assert result(remove_repeats(wide)) == result(remove_repeats(docs))
    got = remove_repeats(docs, with_text=True).collect()
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == r.kept_sha256 for r in got)
    assert remove_repeats(empty).count() == 0

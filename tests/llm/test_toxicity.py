import random
import zlib

import numpy as np
from prose import prose

from regalign.llm.toxicity import Rows, bag_rows, features_of, nn_pu, toxicity, words_of

INSULTS = ["gromph", "vexling", "skarn", "blithwad", "zontag"]


def rows(n=900, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words, toxic = prose(rng, rng.randint(5, 120)).split(), rng.random() < 0.2
        for _ in range(rng.randint(2, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS).upper() + rng.choice(["", ",", "!"]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_accuracy_and_nulls(write):
    data = rows()
    extra = [(5000, None, "a"), (5001, "", "b"), (None, "gromph skarn vexling", "c"), (5002, "1 2 3", None), (5002, "1 2 3", None)]
    docs = write([(i, t, "s") for i, t, _ in data] + extra, "doc_id long, text string, score string")
    labels = write([(i, None, y) for i, _, y in data if i % 3] + [(None, 1, 1), (7, None, None)],
                   "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(data) + len(extra)
    by = {r.doc_id: r for r in got}
    for i in by:
        assert by[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= by[i].score <= 1 and by[i].predicted == int(by[i].score >= 0.5)
    held = [(by[i].predicted, y) for i, _, y in data if by[i].held_out]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) > 0.95
    assert by[None].predicted == 1 and by[5000].predicted == by[5001].predicted == 0
    assert toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {float(1 / (1 + np.exp(60.0)))}


def test_non_negative_risk_separates_unlabelled_positives():
    rng = random.Random(2)
    pos = [{"bad", rng.choice("abc")} for _ in range(60)]
    unl = [{rng.choice("abc")} | ({"bad"} if i % 5 == 0 else set()) for i in range(300)]
    names = ["a", "b", "bad", "c"]
    w, b = nn_pu(Rows(pos, names), Rows(unl, names), 4, 0.2)
    assert w[2] + b > 0 > max(w[0], w[1], w[3]) + b


def test_features_are_words_and_prefixes():
    assert words_of("Ab1cd, É_x ab") == {"ab", "cd", "é", "x"} and words_of(None) == set()
    assert features_of({"abcdefg"}) == {"abcdefg", "^abcde", "^abcdef"}


def test_bags_are_bounded_by_rows_not_ids(write):
    """One id holds most rows, some of them equal: its bag stays near its bound, small bags stay whole."""
    docs = write([(1, f"text {i}") for i in range(6000)] + [(1, "same")] * 3000 + [(i, "other") for i in range(2, 40)],
                 "doc_id long, text string")
    chosen = write([(1, True, 0), *[(i, False, i % 2) for i in range(1, 40)]], "doc_id long, toxic boolean, bag int")
    got = {(r.bag, r.toxic): r["count"] for r in bag_rows(docs, chosen, 300, 500).groupBy("bag", "toxic").count().collect()}
    assert 200 < got[0, True] < 400 and 400 < got[1, False] < 600 and got[0, False] == 19

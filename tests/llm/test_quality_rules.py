import random

import numpy as np

from regalign.llm.quality_rules import COUNTS, good_documents, learn_list, quality_rules, repeated_words, text_counts


def brute(text):
    blanks = " \t\n\x0b\x0c\r"
    text = text or ""
    cut = text
    for c in blanks:
        cut = cut.replace(c, " ")
    words = [w for w in cut.split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(blanks)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)} if len(grams) < 2000 else None
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), None if hit is None else len(hit))


def test_counts_against_brute_force(corpus):
    for r in corpus:
        got, want = text_counts(r[1])[:5], brute(r[1])
        assert all(w is None or g == w for g, w in zip(got, want)), r[1]
    assert text_counts("#a b\n#a b\n\n \n#a b")[:5] == (6, 9, 3, 2, 6)


def test_overlapping_repeats_are_counted_once():
    assert repeated_words(list("aaaa")) == 4 and repeated_words(list("abcabc")) == 6
    assert repeated_words(list("abcxabcyabc")) == 9 and repeated_words([]) == 0


def noisy(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    reject = (x[:, 0] > 0.8) & (x[:, 1] <= 0.5) | (x[:, 2] < 0.1)
    return x, reject


def test_covering_finds_planted_conjunctions():
    x, y = noisy(4000)
    rules = learn_list(x, y, ["a", "b", "c"])
    test_x, test_y = noisy(4000, 1)
    said = np.zeros(len(test_y), dtype=bool)
    for r in rules:
        said |= r.mask(test_x, ["a", "b", "c"])
    assert (said == test_y).mean() > 0.97 and 2 <= len(rules) <= 12


def test_no_rule_without_both_classes():
    x, _ = noisy(100)
    assert learn_list(x, np.zeros(100), ["a", "b", "c"]) == [] and learn_list(x[:0], np.zeros(0), ["a", "b", "c"]) == []


def labelled(write):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(300):
        good = i % 3 > 0
        text = " ".join(rng.sample(words, rng.randint(60, 120)))
        rows.append((i, text if good else text.replace(" ", " ### "), int(good)))
    docs = write([r[:2] for r in rows], "doc_id long, text string")
    labels = write([(i, q, 0) for i, _, q in rows if i < 240] + [(None, 0, 1), (5, None, None)],
                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_learned_list_on_held_out_rows(write):
    rows, docs, labels = labelled(write)
    kept = {r.doc_id: r.kept for r in quality_rules(docs, labels).collect()}
    assert all(kept[i] == bool(q) for i, _, q in rows)
    assert {r.doc_id for r in good_documents(docs, labels).collect()} == {i for i, k in kept.items() if k}


def test_base_rules_nulls_and_clashing_names(docs, wide, corpus, write, empty):
    labels = write([], "doc_id long, quality int, toxic int")
    got = quality_rules(docs, labels)
    rows = got.collect()
    assert len(rows) == len(corpus)
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert sum(r.n_words for r in rows) == sum(brute(r[1])[0] for r in corpus)
    assert set(COUNTS) < set(got.columns)
    kept = good_documents(wide, labels)
    assert kept.columns == wide.columns and kept.count() == sum(r.kept for r in rows)
    assert quality_rules(empty, labels).count() == 0 and good_documents(empty, labels).count() == 0


def test_rows_learned_from_are_bounded_when_ids_and_labels_repeat(write, monkeypatch):
    import regalign.llm.quality_rules as module

    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    docs = write([(1, " ".join(rng.sample(words, rng.randint(60, 200)))) for _ in range(900)] + [(2, "a " * 80)] * 900,
                 "doc_id long, text string")
    labels = write([(1, i % 2, 0) for i in range(200)] + [(2, 1, 0)] * 200, "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(module, "learn_list", lambda x, y, names, **params: seen.append(len(x)) or [])
    assert quality_rules(docs, labels, fit_rows=400).count() == 1800
    assert 0 < seen[0] < 500

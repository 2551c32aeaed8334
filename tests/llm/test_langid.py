import random
import zlib

import numpy as np

from regalign.llm.langid import Grams, Model, fit, language, symbols, training_rows

SOUNDS = {"aa": "ka to mi ra so na".split(), "bb": "sch ung ein keit zu ge".split(), "cc": "éau què tion ment oi la".split()}


def sample(lang, rng, n):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy_and_undetermined(write):
    rng = random.Random(6)
    rows = [(i, sample(lang := rng.choice(list(SOUNDS)), rng, rng.randint(3, 60)), lang) for i in range(500)]
    extra = [(900, None, "aa"), (901, "", "bb"), (902, "12 -- 34", "cc"), (903, sample("bb", rng, 20).upper(), None),
             (None, sample("cc", rng, 20), None), (904, sample("aa", rng, 20000), None), (904, "東京 東京", None)]
    docs = write([(*r, "x") for r in rows + extra], "doc_id long, text string, lang string, score string")
    got = language(docs, rows=200, landmarks=12).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: lang for i, _, lang in rows}
    held = []
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {*SOUNDS, "und"}
        if r.held_out and r.doc_id in truth:
            held.append(r.lang_pred == truth[r.doc_id])
    assert len(held) > 80 and np.mean(held) > 0.97
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id != 904}
    assert [by[i] for i in (900, 901, 902)] == ["und"] * 3 and by[903] == "bb" and by[None] == "cc"
    assert language(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in language(docs.withColumn("lang", docs.lang.substr(9, 0)).where("doc_id = 901")).collect()} == {"und"}


def test_presence_kernel_against_brute_force():
    texts = ["Abc, abd!", "bcd  bcd", "", "x1y"]

    def grams(t):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        s = " " + " ".join(s.split()) + " " if s.split() else " "
        return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    alphabet = sorted({ord(c) for t in texts for c in t.lower() if c.isalpha()} | {32})
    vocabulary = np.unique(np.concatenate([Grams(alphabet).numbers(t) for t in texts]))
    x = Grams(alphabet, vocabulary).presence(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            want = len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
            assert abs(float(x[i] @ x[j]) - want) < 1e-5
    assert symbols("A  b").tolist() == [32, 97, 32, 98, 32]


def test_scripts_with_many_symbols_are_told_apart(write):
    rng = random.Random(7)
    first = {"en": 0x61, "ru": 0x430, "zh": 0x4E00, "ja": 0x3041, "ko": 0xAC00, "th": 0xE01}
    signs = {k: [chr(at + i) for i in range({"en": 26, "ru": 32, "ja": 80, "th": 46}.get(k, 150))] for k, at in first.items()}

    def words(lang):
        n = 60 if lang in ("en", "ru") else 12
        return " ".join("".join(rng.choices(signs[lang], k=rng.randint(1, 4))) for _ in range(n))

    rows = [(i, words(lang := list(first)[i % 6]), lang) for i in range(480)]
    got = language(write(rows, "doc_id long, text string, lang string"), rows=200, landmarks=12).collect()
    held = [(r.lang_pred, rows[r.doc_id][2]) for r in got if r.held_out]
    assert len(held) > 80 and {a for _, a in held} == set(first)
    assert all(np.mean([p == a for p, a in held if a == lang]) > 0.95 for lang in first)


def test_samples_are_bounded_by_rows_not_ids(write):
    """Null and repeated ids draw row by row, equal rows count once, so no language is lost and none overflows."""
    rng = random.Random(8)
    rows = [(None if i % 2 else 7, sample(lang := rng.choice(list(SOUNDS)), rng, 20), lang) for i in range(3000)]
    docs = write(rows + [(7, "ka to mi", "aa")] * 2000, "doc_id long, text string, lang string")
    got = {r.lang: r["count"] for r in training_rows(docs, 200).groupBy("lang").count().collect()}
    assert set(got) == set(SOUNDS) and all(20 < n < 260 for n in got.values())
    assert {r.lang_pred for r in language(docs, rows=200, landmarks=12).collect()} == set(SOUNDS)


def test_batched_products_score_like_single_texts(write):
    rng = random.Random(9)
    docs = write([(i, sample(lang := list(SOUNDS)[i % 3], rng, 15), lang) for i in range(90)],
                 "doc_id long, text string, lang string")
    model = fit(docs, rows=200, landmarks=5)
    assert isinstance(model, Model)
    grams = Grams(vocabulary=model.vocabulary)
    texts = [sample(rng.choice(list(SOUNDS)), rng, rng.randint(1, 80)) for _ in range(70)] + ["Ω"]
    names, score = model.predict(texts, grams)
    for t, name, p in zip(texts, names, score):
        at = grams.places(t)
        z = model.weights[at].astype(float).sum(axis=0) / np.sqrt(max(1, len(at)))
        e = np.exp(8 * (z - z.max()))
        assert name == model.languages[int(z.argmax())] and abs(p - e.max() / e.sum()) < 1e-9

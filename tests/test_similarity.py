"""LCS kernel against a dynamic-programming brute force; ratios and the weighted score."""

import random
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regalign.functions.lcs import lcs_lengths, lcs_python
from regalign.functions.similarity import similarity_frame


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_lcs_batch_matches_dp():
    rng = random.Random(7)
    a, b = [], []
    for _ in range(2000):
        a.append("".join(rng.choice("ab cd") for _ in range(rng.randint(0, 90))))
        b.append("".join(rng.choice("ab cd") for _ in range(rng.randint(0, 90))))
    a += ["héllo wörld", None, "", "x" * 70, "日本語テキスト"]
    b += ["hello world", "abc", "", "x" * 65, "日本テキスト"]
    got = lcs_lengths(pa.array(a), pa.array(b))
    assert list(got) == [lcs_dp(x or "", y or "") for x, y in zip(a, b)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.text(max_size=80))
def test_lcs_python_property(a, b):
    assert lcs_python(a, b) == lcs_dp(a, b)
    assert lcs_lengths(pa.array([a]), pa.array([b]))[0] == lcs_dp(a, b)


def _scores(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return {(r.a, r.b): r for r in similarity_frame(df, "a", "b").collect()}


def test_reference_bounds(spark):
    s = _scores(spark, [("acme corp", "acme corp"), ("acme corporation", "acme corp"),
                        ("acme corp", "techglobal inc"), ("acme corporation", "acme corporaton"),
                        ("", ""), ("acme", ""), ("", "acme")])
    assert s[("acme corp", "acme corp")].similarity_score == 1.0
    assert s[("acme corporation", "acme corp")].similarity_score > 0.7
    assert s[("acme corp", "techglobal inc")].similarity_score < 0.5
    assert s[("acme corporation", "acme corporaton")].similarity_score > 0.8
    for k in [("", ""), ("acme", ""), ("", "acme")]:
        assert s[k].similarity_score == 0.0


def test_known_component_scores(spark):
    s = _scores(spark, [("media entertainment group", "media entertainment"), ("techglobal", "tech global"),
                        ("finserv group", "financial services group"), ("smart home technologies", "smart home tech")])
    got = {k: (r.ratio, r.token_sort, r.token_set) for k, r in s.items()}
    assert got[("media entertainment group", "media entertainment")] == (86, 86, 100)
    assert got[("techglobal", "tech global")] == (95, 57, 57)
    assert got[("finserv group", "financial services group")] == (70, 49, 70)
    assert got[("smart home technologies", "smart home tech")] == (79, 79, 80)
    assert s[("media entertainment group", "media entertainment")].similarity_score == pytest.approx(0.902)


def _ratio(x, y):
    if x == y:
        return 100
    if not x or not y:
        return 0
    v = 100 * (1.0 - (len(x) + len(y) - 2 * lcs_dp(x, y)) / (len(x) + len(y)))
    return int(round(v))


def _tokens(s):
    import re
    s = "".join(ch for ch in s if not (0x80 <= ord(ch) <= 0xFF))
    return re.sub(r"(?u)\W", " ", s).lower().strip().split()


def brute_similarity(a, b):
    if not a or not b:
        return 0.0
    r = _ratio(a, b)
    ta, tb = _tokens(a), _tokens(b)
    s = _ratio(" ".join(sorted(ta)), " ".join(sorted(tb)))
    if not ta or not tb:
        t = 0
    else:
        sa, sb = set(ta), set(tb)
        sect = " ".join(sorted(sa & sb))
        c1 = (sect + " " + " ".join(sorted(sa - sb))).strip()
        c2 = (sect + " " + " ".join(sorted(sb - sa))).strip()
        t = max(_ratio(sect, c1), _ratio(sect, c2), _ratio(c1, c2))
    return r / 100.0 * 0.3 + s / 100.0 * 0.4 + t / 100.0 * 0.3


def test_weighted_score_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["acme", "global", "tech", "group", "é", "co", "data", "ab", "a", "zz9"]
    pairs = []
    for _ in range(300):
        pairs.append((" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))),
                      " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))))
    s = _scores(spark, list(set(pairs)))
    for (a, b), r in s.items():
        assert r.similarity_score == brute_similarity(a, b), (a, b)


def test_long_patterns_take_several_words():
    rng = random.Random(11)
    pairs = [("".join(rng.choices("abcé世", k=rng.randint(0, 300))), "".join(rng.choices("abcé世", k=rng.randint(0, 300))))
             for _ in range(60)]
    pairs += [("a" * 64, "a" * 65), ("a" * 128, "ab" * 128), ("", "x" * 200)]
    got = lcs_lengths(pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs])).tolist()
    assert got == [lcs_dp(*p) for p in pairs]


@pytest.mark.parametrize("outlier", [False, True])
def test_kernel_memory_is_bounded(outlier):
    import tracemalloc

    rng = random.Random(1)
    hangul = [chr(0xAC00 + i) for i in range(11172)]
    names = ["".join(rng.choices(hangul, k=8)) for _ in range(10_000)]
    other = ["".join(rng.choices(hangul, k=8)) for _ in range(10_000)]
    if outlier:
        names[17], other[17] = "ab" * 1000, "ba" * 1000
    a, b = pa.array(names), pa.array(other)
    tracemalloc.start()
    lcs_lengths(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


PROBES = ["cafe\u0301 noir", "\u0915\u094d\u0937 \u0926\u0947\u0935\u0928\u093e\u0917\u0930\u0940", "\u0e01\u0e33 \u0e17\u0e35\u0e48",
          "\u0645\u06cc\u200c\u062e\u0648\u0627\u0647\u0645", "\u0130stanbul Ltd", "a\u00b2b Inc", "x\u203fy Co", "a\x1cb\x1f Corp",
          "Gro\u00dfe & S\u00f6hne GmbH", "\u2167 \u00bd \u0663", "_under score_"]


def test_names_and_tokens_follow_python_classes_in_every_script(spark):
    import re

    from regalign.functions.similarity import processed
    from regalign.functions.text import SUFFIX_PATTERNS, normalize_name
    from pyspark.sql import functions as F

    rng = random.Random(5)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x400, 0x500), (0x5D0, 0x5F0), (0x620, 0x6D0), (0x905, 0x970),
              (0xE01, 0xE5C), (0x2000, 0x2070), (0x2150, 0x2190), (0x3041, 0x30FF), (0x4E00, 0x4E80), (0xAC00, 0xAC40)]
    names = PROBES + ["".join(chr(rng.randint(*rng.choice(ranges)) ) for _ in range(rng.randint(1, 12))) for _ in range(300)]

    def python_name(x):
        x = x.lower()
        for p in SUFFIX_PATTERNS:
            x = re.sub(p, "", x)
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", x)).strip()

    def python_tokens(x):
        x = re.sub("[\x80-\xff]", "", x)
        return re.sub(r"\W", " ", x).lower().strip(" ")

    rows = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, x string").select(
        "i", normalize_name("x").alias("n"), processed(F.col("x")).alias("p")).collect()
    known = lambda x: all(unicodedata.category(c) != "Cn" for c in x)
    bad = [(names[r.i], r.n, r.p) for r in rows if known(names[r.i]) and (
        r.n != python_name(names[r.i]) or r.p != python_tokens(names[r.i]))]
    assert not bad, bad[:5]


SCRIPTS = ["abc de", "xyz  q12 678", "äöü ß é", "日本語 テキスト", "한국어 이름", "Ωμέγα ж", "😀a𝒳b", "ab-c_d"]


def _random_names(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = [rng.choice(rng.choice(SCRIPTS)) for _ in range(rng.randint(0, longest))]
        other = [c for c in base if rng.random() > 0.2] + [rng.choice(rng.choice(SCRIPTS)) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.3:
            rng.shuffle(other)
        out.append(("".join(base), "".join(other)))
    return out


def test_expression_equals_the_kernel_in_every_script(spark):
    from pyspark.sql import functions as F

    from regalign.functions import lcs_expr as X

    pairs = _random_names(11, 600, 55) + [("", ""), ("a", ""), (None, "a"), (None, None), ("x" * 62, "x" * 61 + "y"), ("ab" * 200, "ba" * 31)]
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame([p for p in pairs if min(len(p[0] or ""), len(p[1] or "")) <= X.MAX_PATTERN], "a string, b string")
    got = df.select("a", "b", X.lcs_length(a, b).alias("lcs"), X.indel_ratio(a, b).alias("r"), X.token_sort_ratio(a, b).alias("s"),
                    X.token_set_ratio(a, b).alias("t"), X.name_similarity(a, b).alias("w"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = {(r.a, r.b): r for r in similarity_frame(df, "a", "b").collect()}
    for r in got.collect():
        k = want[(r.a, r.b)]
        assert r.lcs == lcs_dp(r.a or "", r.b or "")
        assert (r.r, r.s, r.t) == (k.ratio, k.token_sort, k.token_set) and r.w == pytest.approx(k.similarity_score, abs=1e-12)
    kept = df.select("a", "b", X.char_masks(b).alias("m")).where("m is not null").select("a", "b", X.lcs_with_masks(a, F.col("m"), F.length("b")).alias("n"))
    assert all(r.n == lcs_dp(r.a or "", r.b) for r in kept.where("b is not null and a is not null").collect())


def test_expression_is_null_beyond_its_length(spark):
    from pyspark.sql import functions as F

    from regalign.functions import lcs_expr as X

    df = spark.createDataFrame([("x" * 63 + "a", "x" * 63 + "b")], "a string, b string")
    row = df.select(X.lcs_length(F.col("a"), F.col("b")).alias("n"), X.token_set_ratio(F.col("a"), F.col("b")).alias("t")).first()
    assert row.n is None and row.t is None


def test_bags_bound_the_lcs(spark):
    from pyspark.sql import functions as F

    from regalign.functions import bags

    pairs = _random_names(12, 1500, 90) + [("a" * 300, "a" * 200 + "b"), ("z" * 40, "z" * 7), ("", "abc"), ("e" * 6 + "f" * 9, "f" * 8 + "e" * 7)]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.select("a", "b", bags.counts("a").alias("ca"), bags.counts("b").alias("cb"))
    df = df.select("a", "b", *[w.alias(f"{p}{i}") for p, c in (("x", "ca"), ("y", "cb")) for i, w in enumerate(bags.bag(c))])
    words = [[F.col(f"{p}{i}") for i in range(bags.WIDTH)] for p in "xy"]
    out = df.select("a", "b", bags.common(*words).alias("n"), bags.most_percent(bags.common(*words), F.length("a"), F.length("b")).alias("p"))
    tight = 0
    for r in out.collect():
        lcs = lcs_dp(r.a, r.b)
        assert r.n >= lcs
        total = len(r.a) + len(r.b)
        ratio = 100 if r.a == r.b else 0 if not r.a or not r.b else round(100 * (1 - (total - 2 * lcs) / total))
        assert r.p >= ratio or ratio == 100 == r.p
        tight += r.n <= min(len(r.a), len(r.b))
    assert tight > 1400

import random

import regex
from prose import prose
from pyspark.sql import functions as F

from regalign.llm.decontaminate import LITERAL, UNITS, contaminated, decontaminate, marked_words

ITEMS = [
    (1, "Alice has 12 apples and gives 5 apples to Bob . How many apples does Alice have left after meeting Bob at noon ?"),
    (2, "A train runs 120 km in 2 hours along the river before it stops for 15 minutes near the old stone bridge ."),
    (3, "too short"), (4, None), (5, ""), (6, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"),
    (7, "the slow ferry to the northern islands took 40 minutes on the way out and it was raining all day while the fast one back "
        "took 40 minutes as well because the captain had to wait for a tide that never came in time"),
    (8, "what is 34 + 57 - 12 + 9 ?"), (9, "she has 3 apples and 7 pears in the basket on the table"),
    (10, "then Anna Berger , Carl Dorn , Emil Frank and Gerda Hahn met Ida Jung near Kiel"),
    (11, "the walk takes 2 hours and covers 2 km of the path along the lake"),
]


def brute_words(text):
    t = (text or "").replace("<", " ").replace(">", " ")
    t = regex.sub(r"(?<=\p{Nd})[.,:/](?=\p{Nd})", "p", t)
    t = regex.sub(r"(?<=[^.!?:\s]\s)\p{Lu}\p{L}*\p{Ll}\p{L}*", lambda m: f" <name{m.group()}> ", t)
    t = regex.sub(r"(?<![\p{L}\p{N}])\p{Nd}(?:p?\p{Nd})*+", lambda m: f" <num{m.group()}> ", t).lower()
    units = "|".join(sorted(map(regex.escape, UNITS), key=len, reverse=True))
    t = regex.sub(rf"(<num[^>]*>)\s*({units})(?![\p{{L}}\p{{N}}])", r"\1 <unit\2> ", t)
    for i, u in enumerate(u for u in UNITS if not u.isalpha()):
        t = t.replace(f"<unit{u}>", f"<unitsign{i}>")
    return [w for w in regex.split(r"[^\p{L}\p{N}\p{M}<>]+", t) if w]


def kind(w):
    return next((f"<{k}>" for k in ("name", "num", "unit") if w.startswith(f"<{k}")), w)


def bare(w):
    return regex.sub("^<(?:name|num|unit)|>$", "", w) if w.startswith("<") else w


def brute(docs, items, n=5, coverage=0.8, run=13):
    """(doc_id, item_id) of all pairs, by looking at every diagonal of every pair and every stretch of it."""
    out = []
    for doc_id, text in docs:
        d = brute_words(text)
        for item_id, item in items:
            q = brute_words(item)
            if len(q) < n:
                if q and list(map(bare, q)) == list(map(bare, d)):
                    out.append((doc_id, item_id))
                continue
            rich = {i for i in range(len(q) - n + 1) if sum(kind(w) == w for w in q[i:i + n]) >= LITERAL}
            name = [w + q[j + 1] if w.startswith("<num") and q[j + 1:j + 2] and q[j + 1].startswith("<unit") else w for j, w in enumerate(q)]
            found, longest = set(), 0
            for shift in range(-len(q), len(d)):
                def same(i):
                    a, b = q[i:i + n], d[i + shift:i + shift + n]
                    return list(map(bare, a)) == list(map(bare, b)) or (i in rich and list(map(kind, a)) == list(map(kind, b)))

                def agree(first, last):  # no value of the item stands for two words of the document
                    pairs = {(name[j], bare(d[j + shift])) for j in range(first, last + n) if kind(q[j]) != q[j]}
                    return len({a for a, _ in pairs}) == len(pairs)

                hit = [i for i in range(len(q) - n + 1) if 0 <= i + shift <= len(d) - n and same(i)]
                found |= {i for i in hit if agree(i, i)}
                for i in hit:
                    j = i
                    while j in hit and agree(i, j):
                        longest, j = max(longest, j - i + n), j + 1
            share = max(len(found) / (len(q) - n + 1), len(found & rich) / len(rich) if rich else 0)
            if found and (share >= coverage or longest >= run):
                out.append((doc_id, item_id))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    a, b = ITEMS[0][1], ITEMS[1][1]
    changed = a.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "30").replace(" 5 ", " 7 ")
    mixed_up = a.replace("to Bob", "to Dan").replace("does Alice", "does Eve")  # a name stands for two
    units = b.replace("120 km", "75 miles").replace("15 minutes", "40 seconds").replace("2 hours", "3 days")
    rows = [f"{prose(rng, 20)} . {x} {prose(rng, 20)}" for x in (a, b, changed, mixed_up, units, a.upper(), a[:40], b[30:])]
    twice = ITEMS[6][1]
    rows += [a.lower(), ITEMS[5][1], "Too Short", "it is too short", ITEMS[7][1], f"{prose(rng, 9)} {ITEMS[7][1]} {prose(rng, 9)}",
             twice.replace("took 40 minutes", "took 45 minutes"), ITEMS[8][1].replace("3", "5").replace("7", "5"), ITEMS[9][1], ITEMS[9][1].lower(),
             ITEMS[10][1].replace("2 hours", "3 hours").replace("2 km", "5 km")]
    rows += [f"{changed} {prose(rng, 5)} {a}", "9 8 7 6 5 4 3 2 1 0 11 12 13 14", prose(rng, 300), "", None,
             a.replace("5", "five"), "<num> <name> " + a]
    return [(100 + i, t) for i, t in enumerate(rows)]


def test_pairs_against_brute_force(write):
    rows = [*cases(), (None, cases()[0][1]), cases()[1], cases()[1]]
    docs = write([(i, t, "x", "y", "z", "w") for i, t in rows],
                 "doc_id long, text string, item string, words string, h string, _f string")
    items = write(ITEMS, "item_id long, text string")
    got = contaminated(docs, items).collect()
    want = brute(rows, ITEMS)
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == want
    by = {(r.doc_id, r.item_id): r for r in got}
    assert by[100, 1].changed == 0 and by[102, 1].changed >= 4 and by[104, 2].changed >= 3
    # copies with one of two equal numbers changed, without literal words, of names alone, in lower case; values that merge or part
    text = dict(cases())
    for item in (7, 8, 9, 10, 11):
        assert [i for i, j in by if j == item], item
    assert {text[i] for i, j in by if j == 10} == {ITEMS[9][1], ITEMS[9][1].lower()} and by[108, 1].changed == 0
    assert {text[i] for i, j in by if j == 3} == {"Too Short"} and {i for i, j in by if j == 6} >= {109}
    kept = decontaminate(docs, items)
    bad = {i for i, _ in want}
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in rows if i not in bad), key=repr)


def test_words_against_brute_force(spark, corpus):
    texts = [r[1] for r in corpus] + [t for _, t in cases()] + ["5kg 3.5% 12:30 a1b2 $5 7°", "Dr. Who met Élan Vital. The End"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", marked_words(F.col("text")).alias("words")).collect()
    assert all(list(r.words) == brute_words(texts[r.i]) for r in rows)




def test_empty_tables(docs, empty, write):
    items = write(ITEMS, "item_id long, text string")
    assert contaminated(empty, items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()

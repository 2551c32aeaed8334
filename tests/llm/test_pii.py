import hashlib
import random
import re

from prose import prose

from regalign.llm.pii import TAGS, personal_data, sanitise

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, value):
    d = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
            "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute(text):
    spans = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "")
             if valid(k, m.group())]
    return sorted(spans)


HARD = [
    "a@b.c%x@y.com a@b.com-x@y.org a@b a@b. .@-.- x@y.z.@q.w", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 1.2.3.400",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0000000000000 5", "+1 (555) 123-4567. +1(((( +12 +1-2-3-4-5-6-7-8-9-",
    "é😀 a@b.io 😀 10.0.0.1é", "+4111 1111 1111 1111", "1" * 4000 + "@", "a" * 20000 + " a@b.co", "+1" + "(" * 5000 + "2", "@@@...+++---",
    "x 12-34 5678 9012 3456 7890 1234 y",
]


def fuzz(n=400):
    rng = random.Random(8)
    return ["".join(rng.choices("aB1. 0259@+-()%é_", k=rng.randint(0, 60))) for _ in range(n)]


def test_base_spans_against_brute_force(write, corpus):
    texts = HARD + fuzz() + [r[1] for r in corpus]
    docs = write([(i, t, "s", "v") for i, t in enumerate(texts)], "doc_id long, text string, spans string, value string")
    rows = personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        listed = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)], texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), texts[r.doc_id]
        assert r.n_terms == 0 and r.spans == listed
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    for i, t in enumerate(texts):
        out, at = "", 0
        for a, k, b in brute(t):
            if b > at:
                out += (t or "")[at:max(a, at)] + TAGS[PATTERNS[k][0]]
                at = b
        assert clean[i] == (None if t is None else out + t[at:]), t


def test_revealing_terms_are_found_and_copies_prove_nothing(write):
    rng = random.Random(1)
    mail = "kay.doe@mail.example.com"
    rows = [prose(rng, 40) for _ in range(300)]
    rows += [f"{prose(rng, 25)} zyxgard {prose(rng, 3)} {mail} {prose(rng, 25)}" for _ in range(6)]
    passage = f"{prose(rng, 12)} other@mail.example.com {prose(rng, 12)}"
    rows += [f"{prose(rng, 4)} {passage} {prose(rng, 4)}" for _ in range(9)]
    rows += [f"{prose(rng, 20)} the +1 555 123 4567 {prose(rng, 20)} the the"] * 5 + ["the " + prose(rng, 30)] * 60
    docs = write(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data(docs).collect()}
    for i in range(300, 306):
        at = rows[i].index("zyxgard")
        assert f"remove:{at}:{at + 7}" in got[i].spans.split(",") and got[i].n_terms == 1
    assert sum(r.n_terms for r in got.values()) == 6
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert all("zyxgard" not in clean[i] and mail not in clean[i] and "<EMAIL>" in clean[i] for i in range(300, 306))
    assert all(clean[i] == rows[i] for i in range(300))


def test_other_columns_and_empty_table(wide, docs, empty, corpus):
    out = sanitise(wide)
    assert out.columns == wide.columns and out.count() == len(corpus)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) or r.n_chars is None for r in out.collect())
    assert personal_data(empty).count() == 0 and sanitise(empty).count() == 0


def test_signature_is_found_and_edited_copies_are_one_context(write):
    rng = random.Random(2)
    sign = "Kay Doe Senior Analyst Northwind Traders Rotterdam Office"
    rows = [prose(rng, 40) for _ in range(300)]
    rows += [f"{prose(rng, 25)} {sign} kay.doe@mail.example.com {prose(rng, 25)}" for _ in range(14)]
    near = [f"quarble{chr(97 + i)}" for i in range(16)]
    for i in range(14):
        words = [w if j not in (i, (i * 5 + 3) % 16) else f"edit{chr(97 + i)}x" for j, w in enumerate(near)]
        rows.append(" ".join([prose(rng, 20), *words[:8], "other@mail.example.com", *words[8:], prose(rng, 20)]))
    docs = write(list(enumerate(rows)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert all(w not in clean[i].split() for i in range(300, 314) for w in sign.split())
    assert all(clean[i] == rows[i].replace("other@mail.example.com", TAGS["email"]) for i in range(314, 328))


def test_spellings_of_a_term_count_once_a_document(write):
    rng = random.Random(3)
    rows = [prose(rng, 40) for _ in range(300)]
    rows += [f"zyxgard, {prose(rng, 20)} zyxgard {prose(rng, 3)} a.b@mail.example.com {prose(rng, 20)} zyxgard." for _ in range(6)]
    docs = write(list(enumerate(rows)), "doc_id long, text string")
    spans = {r.doc_id: r.spans.split(",") for r in personal_data(docs).collect()}
    assert all(sum(x.startswith("remove:") for x in spans[i]) == 3 for i in range(300, 306))

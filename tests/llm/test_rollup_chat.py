import base64

import pytest
import tiktoken

from regalign.llm.chat import rotate
from regalign.llm.queries import op3_token_rollup
from regalign.llm.token_rollup import PATTERN, Rollup, count_tokens, deletes, inserts, revisions

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

COUNTS = "source string, lang string, tokenizer string, n_tokens long, n_words long"


def as_dict(df):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_words) for r in df.collect()}


def test_token_counts_against_the_library(docs, corpus, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    got = sorted(((r.doc_id, r.source, r.lang, r.n_tokens, r.n_words) for r in count_tokens(docs, VOCABULARY, "v1").collect()), key=repr)
    want = [(r[0], r[3], r[2], len(encode(r[1] or "")), len((r[1] or "").encode().split())) for r in corpus]
    assert got == sorted(want, key=repr)
    assert count_tokens(empty, VOCABULARY, "v1").count() == 0


def test_signed_batches_commit_once(spark, tmp_path):
    a = spark.createDataFrame([("s", "en", "v1", 10, 5), ("s", "en", "v1", 7, 3), (None, None, "v1", 1, 1)], COUNTS)
    r = Rollup(spark, str(tmp_path / "r"))
    assert r.totals().count() == 0 and r.batches() == []
    assert r.commit("b1", inserts(a)) and not r.commit("b1", inserts(a))
    assert as_dict(r.totals()) == {("s", "en", "v1"): (2, 17, 8), (None, None, "v1"): (1, 1, 1)}
    r.commit("b2", deletes(a.where("n_tokens = 7")))
    r.commit("b3", revisions(a.where("source is null"), spark.createDataFrame([("t", None, "v2", 4, 1)], COUNTS)))
    assert as_dict(r.totals()) == {("s", "en", "v1"): (1, 10, 5), ("t", None, "v2"): (1, 4, 1)}
    r.commit("b4", inserts(a.limit(0)))
    assert r.batches() == ["b1", "b2", "b3", "b4"]
    other = r.compact("c")
    assert other.root == f"{r.root}-c" and other.batches() == ["c"] and as_dict(other.totals()) == as_dict(r.totals())
    # names survive the fold, and a second one
    again = Rollup(spark, other.compact("d").root)
    assert not other.commit("b1", inserts(a)) and not again.commit("b2", inserts(a)) and not again.commit("c", inserts(a))
    assert as_dict(again.totals()) == as_dict(r.totals()) and again.compact("e").commit("b5", inserts(a))
    assert r.below_zero().count() == 0
    r.commit("b6", deletes(a))
    assert r.below_zero().count() == 2
    with pytest.raises(ValueError):
        r.commit("../x", inserts(a))


def test_the_query_against_plain_counting(spark, tmp_path, corpus):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tokenizer string, n_tokens string"
    spark.createDataFrame([(*r, "a", "b") for r in corpus], schema).write.parquet(str(tmp_path / "documents.parquet"))
    encode = {}
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"/opt/tokenizers/{name}.tiktoken", "rb"))}
        encode[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    want = {}
    for _, text, lang, source, _ in corpus:
        words = len((text or "").encode().split())
        name = "byte_bpe_50k" if lang == "en" else "byte_bpe_multi_50k"
        if words:
            n, t, w = want.get((source, lang, name), (0, 0, 0))
            want[source, lang, name] = (n + 1, t + len(encode[name](text)), w + words)
    assert as_dict(op3_token_rollup(spark, str(tmp_path))) == want


def test_an_interrupted_batch_is_written_again(spark, tmp_path):
    a = spark.createDataFrame([("s", "en", "v1", 10, 5)], COUNTS)
    r = Rollup(spark, str(tmp_path / "r"))
    r.commit("b1", inserts(a))
    (tmp_path / "r" / "batch=b1" / "_SUCCESS").unlink()
    assert r.totals().count() == 0
    assert r.commit("b1", inserts(a)) and as_dict(r.totals()) == {("s", "en", "v1"): (1, 10, 5)}


def brute_views(rows, turns):
    rows = [(c, t, (r if r is not None else "unknown"), (x or "").replace("<|", "< |").replace("|>", "| >")) for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        opening = []
        for m in mine[:turns]:
            if m[1] != "system":
                break
            opening.append(m)
        for who in {m[1] for m in mine} - {"system"}:
            for part in range(-(-len(mine) // turns)):
                text, mask = "", []
                own = mine[part * turns:(part + 1) * turns]
                for _, role, body in (opening if part else []) + own:
                    name = "assistant" if role == who else "system" if role == "system" else f"user name={role}"
                    text += f"<|{name}|>\n"
                    if role == who:
                        mask.append(f"{len(text)}:{len(text) + len(body) + 8}")
                    text += f"{body}<|end|>\n"
                out[conv, part, who] = (len(own), sum(m[1] == who for m in own), text, ",".join(mask))
    return out


def test_views_against_brute_force(write):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|> 😀"), (1, 2, "bob", "yo"), (1, 3, "ann", "x"), (1, 2, "cy", None),
            (1, 2, "bob", "yo"), (2, 0, "system", "alone"), (None, None, None, "who"), (None, 1, "ann", "me"),
            *[(3, t, "ann" if t % 2 else "bob", f"m{t}") for t in range(25)], (4, 0, "user", ""), (4, None, "assistant", "é" * 5000),
            (5, 0, "system", "rule one"), (5, 0, "system", "rule two"), *[(5, None if t % 3 else 7, "ann" if t % 2 else "bob", f"same {t % 4}") for t in range(40)]]
    table = write([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, speaker string, part string")
    for turns in (2, 10, 512):
        got = {(r.conv_id, r.part, r.speaker): (r.n_turns, r.n_own, r.rendered, r["mask"]) for r in rotate(table, turns).collect()}
        assert got == brute_views(rows, turns)
    assert rotate(table.limit(0)).count() == 0

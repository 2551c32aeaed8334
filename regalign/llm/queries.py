"""Driver queries of the training-data operators: name -> f(spark, sf_dir), and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regalign.llm.chat import rotate
from regalign.llm.common import materialize, read_table, scratch_path
from regalign.llm.conv_repair import damaged, repair
from regalign.llm.debruijn import remove_repeats
from regalign.llm.decontaminate import contaminated
from regalign.llm.int8_tiles import near_vectors
from regalign.llm.langid import language
from regalign.llm.mixing import mix
from regalign.llm.pii import personal_data
from regalign.llm.ptolemy import cluster
from regalign.llm.quality_rules import quality_rules
from regalign.llm.simhash import near_duplicates
from regalign.llm.token_rollup import Rollup, count_tokens, deletes, inserts, revisions
from regalign.llm.toxicity import toxicity


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "item_windows", "found", "share", "run", "slots", "changed")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op3_token_rollup(spark: SparkSession, sf_dir: str, tokenizers: str = "/opt/tokenizers") -> DataFrame:
    """Totals after a life of commits: all documents, the same batch sent again, the blank ones deleted, the
    documents in other languages recounted with a multilingual vocabulary, all folded into one, and the first sent again."""
    docs = read_table(spark, sf_dir, "documents")
    foreign = "coalesce(lang, '') <> 'en'"
    counts = materialize(count_tokens(docs, f"{tokenizers}/byte_bpe_50k.tiktoken", "byte_bpe_50k"), "counts")
    again = count_tokens(docs.where(foreign), f"{tokenizers}/byte_bpe_multi_50k.tiktoken", "byte_bpe_multi_50k")
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("load", inserts(counts))
    rollup.commit("load", inserts(counts))
    rollup.commit("blank", deletes(counts.where("n_words = 0")))
    rollup.commit("recount", revisions(counts.where(foreign).where("n_words > 0"), again.where("n_words > 0")))
    folded = rollup.compact("folded")
    folded.commit("load", inserts(counts))
    return folded.totals()


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", "fingerprint", "component_id")


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read_table(spark, sf_dir, "conversations"))


OP8_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') AS role,
         replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM m),
o AS (SELECT conv_id, min(i) FILTER (role <> 'system') AS other, max(i) // 512 AS last FROM n GROUP BY conv_id),
w AS (
  SELECT conv_id, i // 512 AS part, i, role, text, TRUE AS here FROM n
  UNION ALL
  SELECT n.conv_id, part, i, role, text, FALSE
  FROM n JOIN o ON o.conv_id IS NOT DISTINCT FROM n.conv_id, unnest(generate_series(1, last)) AS s(part)
  WHERE i < other AND i < 512),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
x AS (
  SELECT w.conv_id, part, speaker, i, here, role = speaker AS own, text || '<|end|>' || chr(10) AS body,
         '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
                      ELSE 'user name=' || role END || '|>' || chr(10) AS head
  FROM w JOIN p ON w.conv_id IS NOT DISTINCT FROM p.conv_id),
y AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part, speaker ORDER BY i)::BIGINT AS stop FROM x)
SELECT conv_id, part, speaker, count(*) FILTER (here) AS n_turns, count(*) FILTER (own AND here) AS n_own,
       string_agg(head || body, '' ORDER BY i) AS rendered,
       coalesce(string_agg((stop - length(body))::VARCHAR || ':' || stop::VARCHAR, ',' ORDER BY i) FILTER (own), '') AS mask
FROM y GROUP BY conv_id, part, speaker
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "rule")


def op10_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), k=35)


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
win AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS j FROM win WHERE h IN (SELECT h FROM rep)),
per AS (SELECT r, list(j) AS js FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, generate_series(1, len(w))), lambda x: NOT list_contains(js, x[2])),
                        lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN per USING (r)
"""



def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS good
  FROM embeddings),
g AS (SELECT r, CAST(embedding AS DOUBLE[]) AS x FROM v WHERE good),
l AS (
  SELECT a.r, b.r AS s FROM g a JOIN g b ON a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.9),
reach(r, s) AS (SELECT r, r FROM v UNION SELECT reach.r, l.s FROM reach JOIN l ON l.r = reach.s),
c AS (SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
n AS (SELECT r, count(*) AS n FROM l GROUP BY r)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)


#: crc32 bit by bit; then the edits as a recursion over rows that carries the least (cost, audit) of each state.
OP12_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(k) + 1),
      lambda i: [ascii(k[i])::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END),
      4294967295::BIGINT) % 20 AS d FROM c),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS n
  FROM h WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, n) AS i FROM rows_),
f AS (
  SELECT *, left(role, 1) AS r,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed),
stat AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last FROM f GROUP BY conv_id),
ins(s, t, price, letters, lines) AS (VALUES
  (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
  (2, 2, 4, 'II', ['assistant:', 'user:']), (3, 3, 4, 'II', ['user:', 'assistant:'])),
act(letter, r, s, t, price) AS (VALUES
  ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
  ('R', '', 0, 2, 2), ('R', '', 1, 2, 2), ('R', '', 3, 2, 2), ('R', '', 2, 3, 2),
  ('D', '', 0, 0, 3), ('D', '', 1, 1, 3), ('D', '', 2, 2, 3), ('D', '', 3, 3, 3)),
path(conv_id, i, s, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} FROM stat
  UNION ALL
  SELECT p.conv_id, p.i + 1, act.t,
         min({'cost': p.best.cost + ins.price + act.price + CASE WHEN f.fault = 3 AND act.letter <> 'D' THEN 1 ELSE 0 END,
              'audit': p.best.audit || ins.letters || act.letter,
              'lines': list_concat(p.best.lines, ins.lines, CASE act.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text]
                ELSE [CASE act.t WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text] END)})
  FROM path p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN ins ON ins.s = p.s
  JOIN act ON act.s = ins.t AND (act.letter <> 'K' OR act.r = f.r) AND (act.letter = 'D' OR f.fault NOT IN (1, 2))
  GROUP BY p.conv_id, p.i, act.t),
done AS (
  SELECT st.conv_id, min({'cost': p.best.cost + ins.price, 'audit': p.best.audit || ins.letters, 'lines': list_concat(p.best.lines, ins.lines)}) AS best
  FROM path p JOIN stat st ON st.conv_id IS NOT DISTINCT FROM p.conv_id AND st.last = p.i JOIN ins ON ins.s = p.s
  WHERE ins.t IN (0, 3) GROUP BY st.conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def op13_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(read_table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64)
    return out.drop("checked")  # the pairs the bounds left are no part of the result


def _op13_sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64) -> str:
    """Plain Lloyd rounds: one row per vector and component, all distances worked out."""
    parts = [f"""v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < {(1 << 27) / scale})) = {dim}),
x AS (SELECT r, unnest(generate_series(1, {dim})) AS j, unnest(w) AS a FROM v),
c0 AS (
  SELECT k, unnest(generate_series(1, {dim})) AS j, unnest(w) AS b
  FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, w) - 1 AS k, w FROM v) WHERE k < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT r, k, CAST(sum((a - b) * (a - b)) AS BIGINT) AS d FROM x JOIN c{i} USING (j) GROUP BY r, k),
a{i} AS (SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS o FROM d{i}) WHERE o = 1)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT k, j, sum(a) AS t, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY k, j),
c{i + 1} AS (
  SELECT c.k, c.j, CASE WHEN n IS NULL THEN b ELSE CAST(t // n - CASE WHEN t % n < 0 THEN 1 ELSE 0 END AS BIGINT) END AS b
  FROM c{i} c LEFT JOIN s{i} s ON s.k = c.k AND s.j = c.j)""")
    return "WITH " + ",\n".join(parts) + f""",
h AS (SELECT k, sha256(string_agg(CAST(b AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN h ON h.k = a.k
"""


OP13_SQL = _op13_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_mix_sources, op3_token_rollup, op4_language_id, op5_toxicity, op6_personal_data,
        op7_simhash_dedup, op8_chat_rotation, op9_quality_rules, op10_debruijn_dedup,
        op11_embedding_dedup, op12_conversation_repair, op13_ptolemaic_clusters)
}

ORACLES: dict[str, str] = {"op8_chat_rotation": OP8_SQL, "op10_debruijn_dedup": OP10_SQL,
                           "op11_embedding_dedup": OP11_SQL, "op12_conversation_repair": OP12_SQL,
                           "op13_ptolemaic_clusters": OP13_SQL}

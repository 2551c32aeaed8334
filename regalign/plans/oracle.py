"""SQL twins of the driver queries, for DuckDB (the correctness oracle).

The SQL is written independently of the Spark plans: names are normalised with RE2
regexes (ASCII classes; the driver tables are ASCII), LCS is the same bit-parallel
recurrence written with ``list_reduce`` over characters, and the token-set LCS uses
the common-prefix identity LCS(P+x, P+y) = |P| + LCS(x, y) instead of the direct
computation the Spark side does, so the two sides check each other.
"""

from __future__ import annotations

from regalign.functions.text import SUFFIX_PATTERNS
from regalign.plans.views import NAME_SUFFIXES

THRESHOLD = 0.85
W_R, W_S, W_T = 0.3, 0.4, 0.3


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize_sql(x: str) -> str:
    out = f"lower({x})"
    for p in SUFFIX_PATTERNS:
        out = f"regexp_replace({out}, {q(p)}, '')"
    out = f"regexp_replace({out}, '[^\\w\\s]', ' ', 'g')"
    out = f"regexp_replace({out}, '\\s+', ' ', 'g')"
    out = f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"
    return f"coalesce({out}, '')"


def list_size_sql(x: str) -> str:
    return f"CAST(CASE WHEN {x} IS NULL THEN -1 ELSE len(string_split({x}, ';')) END AS INTEGER)"


def format_id_sql(rank: str, width: int = 6) -> str:
    d = f"CAST({rank} AS VARCHAR)"
    return f"'CORP_' || (CASE WHEN length({d}) >= {width} THEN {d} ELSE lpad({d}, {width}, '0') END)"


# ---------------------------------------------------------------- views
SUPPLY = f"""
SELECT p_partkey AS row_id,
       (CASE WHEN p_partkey % 13 = 0 THEN 'X' ELSE '' END) || p_name || ' ' || p_brand || (CASE p_partkey % 9 {' '.join(f'WHEN {i} THEN {q(s)}' for i, s in enumerate(NAME_SUFFIXES))} END) AS corporate_name_s1,
       CAST(p_size AS VARCHAR) || ' ' || lower(p_type) || ' street, ' || n_name || ', zip ' || CAST(p_partkey AS VARCHAR) AS address,
       lower(p_type) || ';' || n_name AS activity_places,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE concat_ws(';', 'Supplier' || CAST(p_partkey % 7 AS VARCHAR),
            'Supplier' || CAST(p_size % 5 AS VARCHAR),
            CASE WHEN p_size % 2 = 0 THEN 'Supplier' || CAST(p_size % 3 AS VARCHAR) END) END AS top_suppliers
FROM part JOIN nation ON n_nationkey = p_partkey % 25
"""

FINANCE = """
SELECT k AS row_id,
       CASE k % 5
         WHEN 0 THEN p_brand || ' ' || p_name
         WHEN 1 THEN substr(p_name, 1, 3) || substr(p_name, 5) || ' ' || p_brand
         WHEN 2 THEN p_name || ' ' || p_brand || ' Inc.'
         WHEN 3 THEN upper(p_name) || ' ' || p_brand || ' Corporation'
         ELSE p_name || ' ' || p_brand END AS corporate_name_s2,
       CASE WHEN n_lines % 7 = 0 THEN NULL
            ELSE concat_ws(';', 'Retail', CASE WHEN n_lines % 2 = 0 THEN 'Wholesale' END,
                           CASE WHEN n_lines % 3 = 0 THEN 'Online' END) END AS main_customers,
       CAST(revenue AS BIGINT) AS revenue, CAST(profit AS BIGINT) AS profit
FROM (
  SELECT p_name, p_brand, min(p_partkey) AS k, sum(n_lines) AS n_lines, sum(rev) AS revenue, sum(prof) AS profit
  FROM part JOIN (
    SELECT l_partkey, count(*) AS n_lines,
           sum(CAST(round(l_extendedprice) AS BIGINT)) AS rev,
           sum(CAST(round(l_extendedprice * (0.1 - l_discount)) AS BIGINT)) AS prof
    FROM lineitem GROUP BY l_partkey) s ON s.l_partkey = p_partkey
  GROUP BY p_name, p_brand) g
"""

SUPPLIER_FINANCE = """
SELECT s_suppkey, s_name, CAST(revenue AS BIGINT) AS revenue, CAST(profit AS BIGINT) AS profit
FROM supplier LEFT JOIN (
  SELECT l_suppkey, sum(CAST(round(l_extendedprice) AS BIGINT)) AS revenue,
         sum(CAST(round(l_extendedprice * (0.1 - l_discount)) AS BIGINT)) AS profit
  FROM lineitem GROUP BY l_suppkey) a ON a.l_suppkey = s_suppkey
"""

CUSTOMER_REGISTRY = f"""
SELECT {format_id_sql('c_custkey', 9)} AS corporate_id, c_name AS corporate_name,
       CAST(revenue AS BIGINT) AS revenue, CAST(profit AS BIGINT) AS profit,
       CAST(supplier_count AS INTEGER) AS supplier_count,
       CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE n_prio END AS INTEGER) AS customer_count
FROM customer LEFT JOIN (
  SELECT o_custkey, sum(CAST(round(o_totalprice) AS BIGINT)) AS revenue,
         sum(CAST(round(o_totalprice * 0.5) AS BIGINT)) AS profit,
         count(*) AS supplier_count, count(DISTINCT o_orderpriority) AS n_prio
  FROM orders GROUP BY o_custkey) a ON a.o_custkey = c_custkey
"""

# ---------------------------------------------------------------- matching
_PROC = "trim(lower(regexp_replace(regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g'), '\\W', ' ', 'g')))"


def _features(prefix: str, name: str) -> str:
    toks = f"list_filter(string_split({_PROC.format(x=name)}, ' '), lambda t: t <> '')"
    return (f"substr({name}, 1, 3) AS {prefix}_block, "
            f"array_to_string(list_sort({toks}), ' ') AS {prefix}_sorted, "
            f"list_sort(list_distinct({toks})) AS {prefix}_set, "
            f"length(array_to_string({toks}, '')) AS {prefix}_plen")


def _masks(s: str) -> str:
    """Per-string table of 128 position masks, indexed by ASCII code + 1."""
    return (f"list_transform(range(128), lambda c: CAST(coalesce(list_sum(list_transform(range(length({s})), "
            f"lambda j: CASE WHEN ascii(substr({s}, j + 1, 1)) = c THEN (1::BIGINT << j) ELSE 0::BIGINT END)), 0) "
            f"AS BIGINT))")


def _lcs_with_masks(a: str, b_len: str, masks: str) -> str:
    full = f"((1::BIGINT << {b_len}) - 1)"
    return (f"({b_len} - bit_count(list_reduce(list_transform(string_split({a}, ''), "
            f"lambda ch: coalesce({masks}[ascii(ch) + 1], 0::BIGINT)), "
            f"lambda v, m: ((v + (v & m)) | (v & ~m)) & {full}, {full})))")


def _lcs_direct(a: str, b: str) -> str:
    full = f"((1::BIGINT << length({b})) - 1)"
    mask = (f"CAST(coalesce(list_sum(list_transform(range(length({b})), lambda j: "
            f"CASE WHEN substr({b}, j + 1, 1) = ch THEN (1::BIGINT << j) ELSE 0::BIGINT END)), 0) AS BIGINT)")
    return (f"(length({b}) - bit_count(list_reduce(list_transform(string_split({a}, ''), lambda ch: {mask}), "
            f"lambda v, m: ((v + (v & m)) | (v & ~m)) & {full}, {full})))")


def _ratio(x: str, y: str, lcs: str) -> str:
    tot = f"(length({x}) + length({y}))"
    return (f"(CASE WHEN {x} = {y} THEN 100 WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 "
            f"ELSE CAST(round_even(100.0::DOUBLE * (1.0::DOUBLE - CAST({tot} - 2 * {lcs} AS DOUBLE) / "
            f"CAST({tot} AS DOUBLE)), 0) AS INTEGER) END)")


#: All pairs of a block: the oracle prunes nothing.
BLOCK_PAIRS = "SELECT ln.*, rn.* FROM ln JOIN rn ON l_block = r_block"
#: Each part's own finance name.
OWN = f"""
SELECT s.row_id, s.normalized_name AS l_name, f.normalized_name AS r_name
FROM left_p s JOIN part ON p_partkey = s.row_id
JOIN (SELECT p_name, p_brand, min(p_partkey) AS k FROM part GROUP BY 1, 2) o USING (p_name, p_brand)
JOIN right_p f ON f.row_id = o.k
"""


def matching_ctes(threshold: float = THRESHOLD, pairs: str = BLOCK_PAIRS) -> str:
    return f"""
supply AS ({SUPPLY}),
finance AS ({FINANCE}),
left_p AS (SELECT *, {normalize_sql('corporate_name_s1')} AS normalized_name,
                  {list_size_sql('top_suppliers')} AS supplier_count FROM supply),
right_p AS (SELECT *, {normalize_sql('corporate_name_s2')} AS normalized_name,
                   {list_size_sql('main_customers')} AS customer_count FROM finance),
ln AS (SELECT l_name, {_features('l', 'l_name')}
       FROM (SELECT DISTINCT normalized_name AS l_name FROM left_p WHERE normalized_name <> '')),
rn0 AS (SELECT r_name, {_features('r', 'r_name')}
        FROM (SELECT DISTINCT normalized_name AS r_name FROM right_p WHERE normalized_name <> '')),
rn AS (SELECT *, {_masks('r_name')} AS r_masks, {_masks('r_sorted')} AS r_smasks FROM rn0),
own AS ({OWN}),
cand AS ({pairs}),
pieces AS (
  SELECT l_name, r_name, l_sorted, r_sorted, l_plen, r_plen,
         {_lcs_with_masks('l_name', 'length(r_name)', 'r_masks')} AS lcs_raw,
         {_lcs_with_masks('l_sorted', 'length(r_sorted)', 'r_smasks')} AS lcs_sort,
         array_to_string(list_sort(list_intersect(l_set, r_set)), ' ') AS sect,
         array_to_string(list_filter(l_set, lambda x: NOT list_contains(r_set, x)), ' ') AS d1,
         array_to_string(list_filter(r_set, lambda x: NOT list_contains(l_set, x)), ' ') AS d2
  FROM cand),
pieces2 AS (
  SELECT *, trim(concat_ws(' ', sect, d1)) AS ca, trim(concat_ws(' ', sect, d2)) AS cb,
         CASE WHEN length(sect) = 0 THEN {_lcs_direct('d1', 'd2')}
              WHEN length(d1) = 0 OR length(d2) = 0 THEN length(sect)
              ELSE length(sect) + 1 + {_lcs_direct('d1', 'd2')} END AS lcs_set
  FROM pieces),
scored0 AS (
  SELECT l_name, r_name,
         {_ratio('l_name', 'r_name', 'lcs_raw')} AS ratio,
         {_ratio('l_sorted', 'r_sorted', 'lcs_sort')} AS token_sort,
         CASE WHEN l_plen = 0 OR r_plen = 0 THEN 0 ELSE greatest(
             {_ratio('sect', 'ca', 'length(sect)')}, {_ratio('sect', 'cb', 'length(sect)')},
             {_ratio('ca', 'cb', 'lcs_set')}) END AS token_set
  FROM pieces2),
scored AS (
  SELECT *, CASE WHEN l_name = '' OR r_name = '' THEN 0.0::DOUBLE ELSE
         ((CAST(ratio AS DOUBLE) / 100.0::DOUBLE * {W_R!r}::DOUBLE
           + CAST(token_sort AS DOUBLE) / 100.0::DOUBLE * {W_S!r}::DOUBLE)
           + CAST(token_set AS DOUBLE) / 100.0::DOUBLE * {W_T!r}::DOUBLE) END AS similarity_score
  FROM scored0),
matches AS (SELECT l_name, r_name, similarity_score FROM scored WHERE similarity_score >= {threshold!r}::DOUBLE),
ids AS (SELECT l_name, {format_id_sql('dense_rank() OVER (ORDER BY l_name)')} AS corporate_id
        FROM (SELECT DISTINCT l_name FROM matches)),
nids AS (SELECT count(*) AS n FROM ids),
matched AS (
  SELECT i.corporate_id, coalesce(s1.corporate_name_s1, s2.corporate_name_s2) AS corporate_name,
         s1.normalized_name, s1.address, s1.activity_places, s1.top_suppliers, s1.supplier_count,
         s2.main_customers, s2.customer_count, s2.revenue, s2.profit, m.similarity_score
  FROM left_p s1 JOIN matches m ON s1.normalized_name = m.l_name
  JOIN ids i ON i.l_name = m.l_name
  JOIN right_p s2 ON s2.normalized_name = m.r_name),
unmatched AS (
  SELECT {format_id_sql('row_number() OVER (ORDER BY corporate_name_s1 NULLS FIRST, address NULLS FIRST, activity_places NULLS FIRST, top_suppliers NULLS FIRST) + (SELECT n FROM nids) + 1')} AS corporate_id,
         corporate_name_s1 AS corporate_name, normalized_name, address, activity_places, top_suppliers,
         supplier_count, CAST(NULL AS VARCHAR) AS main_customers, 0 AS customer_count,
         CAST(NULL AS BIGINT) AS revenue, CAST(NULL AS BIGINT) AS profit, 0.0::DOUBLE AS similarity_score
  FROM left_p l
  WHERE l.corporate_name_s1 IS NULL OR NOT EXISTS (
      SELECT 1 FROM left_p x JOIN ids ON x.normalized_name = ids.l_name
      WHERE x.corporate_name_s1 = l.corporate_name_s1)),
harmonized AS (SELECT * FROM matched UNION ALL SELECT * FROM unmatched)
"""


def with_matching(select: str, threshold: float = THRESHOLD, pairs: str = BLOCK_PAIRS) -> str:
    return "WITH " + matching_ctes(threshold, pairs).strip() + "\n" + select


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out["normalize_names"] = (
        f"SELECT row_id, corporate_name_s1, {normalize_sql('corporate_name_s1')} AS normalized_name FROM ({SUPPLY})")
    out["normalize_finance_names"] = (
        f"SELECT row_id, corporate_name_s2, {normalize_sql('corporate_name_s2')} AS normalized_name FROM ({FINANCE})")
    addr = ("CASE WHEN s_suppkey % 4 = 0 THEN 'PO Box ' || CAST(s_suppkey AS VARCHAR) "
            "ELSE CAST(s_suppkey AS VARCHAR) || ' Main Street, ' || n_name || ', ST ' || CAST(s_nationkey AS VARCHAR) END")
    out["extract_city"] = (
        f"SELECT s_suppkey, address, coalesce(lower(trim(string_split(address, ',')[2])), '') AS city "
        f"FROM (SELECT s_suppkey, {addr} AS address FROM supplier JOIN nation ON n_nationkey = s_nationkey)")
    out["list_sizes"] = (
        f"SELECT doc_id, {list_size_sql('text')} AS n_items, {list_size_sql('source')} AS n_sources FROM documents")
    out["supplier_counts"] = (
        f"SELECT row_id, {list_size_sql('top_suppliers')} AS supplier_count, "
        f"{list_size_sql('activity_places')} AS place_count FROM ({SUPPLY})")
    out["null_profile_events"] = (
        "SELECT count(*) AS n_rows, " + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
            for c in ("event_id", "ts", "user_id", "event_type", "value", "props")) + " FROM events")
    out["null_profile_orders"] = (
        "SELECT count(*) AS n_rows, " + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
            for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")) + " FROM orders")
    out["block_stats"] = with_matching(
        "SELECT l.block_key, l.left_names, r.right_names, l.left_names * r.right_names AS block_pairs FROM "
        "(SELECT l_block AS block_key, count(*) AS left_names FROM ln GROUP BY 1) l JOIN "
        "(SELECT r_block AS block_key, count(*) AS right_names FROM rn0 GROUP BY 1) r USING (block_key)")
    out["contract_check"] = (
        "SELECT 'l_shipdate' AS \"column\", 'type' AS problem, 'timestamp' AS expected, 'timestamp_ntz' AS actual, "
        "CAST(NULL AS BIGINT) AS null_rows UNION ALL " + " UNION ALL ".join(
            f"SELECT '{c}', 'nulls', 'not null', 'nullable', count(*) FROM lineitem WHERE {c} IS NULL HAVING count(*) > 0"
            for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")))
    out["name_similarity"] = with_matching(
        "SELECT row_id, l_name, r_name, ratio, token_sort, token_set, similarity_score "
        "FROM own JOIN scored USING (l_name, r_name)",
        pairs="SELECT ln.*, rn.* FROM (SELECT DISTINCT l_name, r_name FROM own) JOIN ln USING (l_name) JOIN rn USING (r_name)")
    out["name_similarity_expr"] = out["name_similarity"]
    out["matches"] = with_matching("SELECT l_name, r_name, similarity_score FROM matches")
    out["assign_ids"] = with_matching(
        "SELECT l_name, corporate_id, CAST(string_split(corporate_id, '_')[2] AS BIGINT) AS id_number FROM ids")
    out["unmatched"] = with_matching(
        "SELECT corporate_id, corporate_name, normalized_name, address, activity_places, top_suppliers, "
        "supplier_count FROM unmatched")
    out["harmonize"] = with_matching("SELECT * FROM harmonized")
    out["registry_roundtrip"] = out["harmonize"]
    out["registry_count"] = with_matching("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_before FROM harmonized")
    out["csv_roundtrip"] = (
        "SELECT CASE WHEN row_id % 4 = 0 THEN 'The \"' || corporate_name_s2 || '\", Inc' ELSE corporate_name_s2 END "
        f"AS corporate_name_s2, main_customers, revenue, profit, 'source2' AS source FROM ({FINANCE})")
    out["ingest_sources"] = (
        f"SELECT corporate_name_s1 AS name, top_suppliers AS items, 'source1' AS source FROM ({SUPPLY}) UNION ALL "
        f"SELECT corporate_name_s2, main_customers, 'source2' FROM ({FINANCE})")
    out["collapse_by_id"] = with_matching(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY corporate_id ORDER BY "
        "similarity_score DESC NULLS LAST, revenue DESC NULLS LAST, corporate_name ASC NULLS LAST, "
        "profit DESC NULLS LAST, normalized_name, address, activity_places, top_suppliers, supplier_count, "
        "main_customers, customer_count) AS rn FROM harmonized) WHERE rn = 1")
    out["collapse_after_harmonize"] = out["collapse_by_id"]
    out["pipeline_two_commits"] = f"SELECT * REPLACE (revenue * 2 AS revenue, profit * 2 AS profit) FROM ({out['collapse_by_id']})"
    out["pipeline_commit_stats"] = with_matching(
        ", n AS (SELECT count(DISTINCT corporate_id) AS n FROM harmonized) "
        "SELECT 1::BIGINT AS snapshot_id, 0::BIGINT AS before_rows, n AS source_rows, n AS inserted_keys, 0::BIGINT AS updated_keys, "
        "0::BIGINT AS unchanged_rows, n AS after_rows FROM n UNION ALL SELECT 2, n, n, 0, n, 0, n FROM n")
    out["sample_rows"] = with_matching(
        "SELECT * FROM harmonized ORDER BY corporate_id, corporate_name NULLS FIRST, address NULLS FIRST, "
        "revenue DESC NULLS LAST, main_customers NULLS FIRST LIMIT 5")
    out["ids_per_entity"] = with_matching(
        "SELECT corporate_id, count(*) AS n FROM harmonized GROUP BY corporate_id")
    out["entity_summary"] = with_matching(
        "SELECT count(*) AS n_rows, count(DISTINCT corporate_id) AS n_entities, "
        "count(*) FILTER (WHERE revenue IS NULL) AS n_unmatched FROM harmonized")

    # ---- upsert on orders: target = orders up to 1999, source = orders from 1998 with new prices
    tgt = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
    src = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.1::DOUBLE AS o_totalprice, "
           "o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
    out["merge_upsert"] = (
        f"WITH t AS ({tgt}), s AS ({src}) SELECT * FROM s UNION ALL "
        f"SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)")
    narrow = "o_orderkey, o_orderstatus, o_totalprice, o_orderdate"
    out["merge_wide"] = (
        f"WITH t AS ({tgt}), s AS (SELECT {narrow} FROM ({src})) "
        "SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderpriority, " + ", ".join(
            f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
            for c in ("o_orderstatus", "o_totalprice", "o_orderdate")) +
        " FROM t FULL OUTER JOIN s ON s.o_orderkey = t.o_orderkey")
    out["registry_metadata"] = (
        f"WITH c AS (SELECT o_orderkey FROM ({tgt}) UNION ALL SELECT o_orderkey FROM ({src})) "
        "SELECT CAST(8 AS INTEGER) AS n_columns, count(DISTINCT o_orderkey) AS current_rows, count(*) AS history_rows, "
        "CAST(2 AS BIGINT) AS snapshot_count, count(DISTINCT o_orderkey) AS record_count FROM c")
    out["merge_stats"] = (
        f"WITH t AS ({tgt}), s AS ({src}), tk AS (SELECT o_orderkey, count(*) AS n FROM t GROUP BY 1), "
        f"sk AS (SELECT o_orderkey, count(*) AS n FROM s GROUP BY 1), "
        f"j AS (SELECT tk.n AS tn, sk.n AS sn FROM tk FULL OUTER JOIN sk USING (o_orderkey)) "
        f"SELECT CAST(coalesce(sum(tn), 0) AS BIGINT) AS before_rows, CAST(coalesce(sum(sn), 0) AS BIGINT) AS source_rows, "
        f"count(*) FILTER (WHERE tn IS NULL) AS inserted_keys, "
        f"count(*) FILTER (WHERE tn IS NOT NULL AND sn IS NOT NULL) AS updated_keys, "
        f"CAST(coalesce(sum(CASE WHEN sn IS NULL THEN tn END), 0) AS BIGINT) AS unchanged_rows, "
        f"CAST(coalesce(sum(CASE WHEN sn IS NULL THEN tn END), 0) + coalesce(sum(sn), 0) AS BIGINT) AS after_rows FROM j")
    out["compact_orders"] = "SELECT * FROM orders"
    out["compact_joined"] = ("SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderdate, TRUE AS files_fit "
                             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    out["compact_folders"] = ("SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_rows, TRUE AS files_fit "
                              "FROM orders GROUP BY 1")
    out["merge_bucketed"] = out["merge_upsert"]
    out["merge_bucketed_stats"] = out["merge_stats"]
    out["merge_sql_view"] = (
        f"WITH t AS ({tgt}), s AS ({src}) SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS last_updated FROM s UNION ALL "
        "SELECT *, NULL FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)")

    # ---- events as a change log keyed by user_id: one snapshot per day
    chg = ("SELECT user_id, event_id, ts, event_type, value, props, "
           "CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS snapshot_id, ts AS committed_at FROM events")
    latest = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
              "snapshot_id DESC, committed_at DESC, event_id DESC) AS rn FROM ({inner})) WHERE rn = 1")
    out["as_of_version"] = latest.format(inner=f"SELECT * FROM ({chg}) WHERE snapshot_id <= 20240115")
    out["as_of_timestamp"] = latest.format(
        inner=f"SELECT * FROM ({chg}) WHERE committed_at <= TIMESTAMP '2024-01-10 12:00:00'")
    out["as_of_log"] = (f"SELECT *, 'version' AS asked FROM ({out['as_of_version']}) UNION ALL "
                        f"SELECT *, 'timestamp' AS asked FROM ({out['as_of_timestamp']})")
    out["snapshot_files"] = (
        f"SELECT snapshot_id, count(*) AS n_rows, count(DISTINCT CAST(committed_at AS DATE)) AS n_days, TRUE AS file_per_day, "
        f"TRUE AS has_bytes, TRUE AS written_before_now FROM ({chg}) GROUP BY snapshot_id")
    out["current_state"] = latest.format(inner=chg)
    out["snapshot_log"] = (
        f"SELECT snapshot_id, max(committed_at) AS committed_at, count(*) AS changed_rows, "
        f"count(DISTINCT user_id) AS changed_keys FROM ({chg}) GROUP BY snapshot_id")
    out["expire"] = (
        f"SELECT * FROM ({latest.format(inner=f'SELECT * FROM ({chg}) WHERE committed_at < TIMESTAMP ' + q('2024-01-20 00:00:00'))}) "
        f"UNION ALL SELECT * FROM ({chg}) WHERE committed_at >= TIMESTAMP '2024-01-20 00:00:00'")

    # ---- reports over supplier finance
    out["high_profit"] = (
        f"SELECT s_suppkey, s_name, revenue, profit FROM ({SUPPLIER_FINANCE}) "
        f"WHERE profit > 1000000 AND revenue IS NOT NULL")
    out["top_revenue"] = (
        f"SELECT s_suppkey, s_name, revenue FROM ({SUPPLIER_FINANCE}) WHERE revenue IS NOT NULL "
        f"ORDER BY revenue DESC, s_suppkey LIMIT 10")
    out["profit_category"] = (
        f"SELECT s_suppkey, CASE WHEN profit > 1000000 THEN 'High' ELSE 'Low' END AS category "
        f"FROM ({SUPPLIER_FINANCE})")
    out["category_counts"] = (
        f"SELECT CASE WHEN profit > 1000000 THEN 'High' ELSE 'Low' END AS category, count(*) AS n "
        f"FROM ({SUPPLIER_FINANCE}) GROUP BY 1")

    # ---- training data
    prep = (f"SELECT revenue, supplier_count, coalesce(customer_count, 0) AS customer_count, "
            f"CASE WHEN profit > 1000000 THEN 1 ELSE 0 END AS high_profit, corporate_id, corporate_name "
            f"FROM ({CUSTOMER_REGISTRY}) WHERE revenue IS NOT NULL AND profit IS NOT NULL "
            f"AND supplier_count IS NOT NULL")
    out["prepare_training"] = prep
    out["class_distribution"] = f"SELECT high_profit, count(*) AS n FROM ({prep}) GROUP BY 1"
    out["scaled_features"] = (
        f"SELECT corporate_id, " + ", ".join(
            f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_scaled"
            for c in ("revenue", "supplier_count", "customer_count")) + f" FROM ({prep})")
    out["hash_split"] = (
        f"SELECT corporate_id, CAST(('0x' || substr(md5('42:' || corporate_id), 1, 8)) AS BIGINT) "
        f"/ 4294967296.0 < 0.2 AS is_test FROM ({prep})")

    test = "CAST(('0x' || substr(md5('42:' || {k}), 1, 8)) AS BIGINT) / 4294967296.0 < 0.2"
    out["feature_contract"] = f"SELECT count(*) AS n_rows, 'n_employees' AS missing FROM ({prep})"
    out["split_complete"] = (
        f"SELECT c_custkey, o_orderkey, coalesce({test.format(k='CAST(o_orderkey AS VARCHAR)')}, FALSE) AS is_test "
        "FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
    out["random_split"] = f"SELECT count(*) AS n_rows, TRUE AS no_row_twice, TRUE AS share_near FROM ({prep})"
    out["train_and_evaluate"] = ("SELECT m AS metric, TRUE AS in_range FROM (VALUES ('accuracy'), ('weighted_precision'), "
                                 "('weighted_recall'), ('weighted_f1'), ('auc')) v(m)")
    out["train_score"] = (f"SELECT corporate_id, high_profit, TRUE AS prediction_follows_p1, TRUE AS loaded_as_fitted "
                          f"FROM ({prep}) WHERE {test.format(k='corporate_id')}")
    out["coefficients"] = (
        "SELECT CAST(i AS INTEGER) AS position, f AS feature, TRUE AS optimal FROM (VALUES (0, 'revenue'), "
        "(1, 'supplier_count'), (2, 'customer_count'), (3, 'intercept')) v(i, f)")
    out["model_metrics"] = (f"SELECT count(*) AS n, TRUE AS recall_is_accuracy, TRUE AS auc_as_evaluator, "
                            f"TRUE AS accuracy_in_range FROM ({prep}) WHERE {test.format(k='corporate_id')}")

    # ---- metrics on labels with a rule prediction
    pred = ("SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS label, "
            "CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1000.0) AS p1, "
            "CASE WHEN d.n_chars > 1000 THEN 1.0 ELSE 0.0 END AS prediction "
            "FROM labels l JOIN documents d ON d.doc_id = l.doc_id")
    out["metrics_confusion"] = (
        f"WITH p AS ({pred}), cells AS (SELECT label AS y, prediction AS yhat, count(*) AS n FROM p GROUP BY 1, 2), "
        f"actual AS (SELECT y, sum(n) AS a, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS tp FROM cells GROUP BY y), "
        f"predicted AS (SELECT yhat AS y, sum(n) AS pr FROM cells GROUP BY yhat), "
        f"per AS (SELECT actual.y, a, tp, coalesce(pr, 0) AS pr, "
        f"CASE WHEN coalesce(pr, 0) > 0 THEN tp / pr ELSE 0.0 END AS prec, tp / a AS rec "
        f"FROM actual LEFT JOIN predicted ON actual.y = predicted.y), "
        f"per2 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM per) "
        f"SELECT CAST(sum(a) AS BIGINT) AS n, sum(tp) / sum(a) AS accuracy, round(sum(prec * a) / sum(a), 12) AS weighted_precision, "
        f"round(sum(rec * a) / sum(a), 12) AS weighted_recall, round(sum(f1 * a) / sum(a), 12) AS weighted_f1 FROM per2")
    out["metrics_auc"] = (
        f"WITH p AS ({pred}), s AS (SELECT p1, count(*) FILTER (WHERE label = 1) AS pos, "
        f"count(*) FILTER (WHERE label <> 1) AS neg FROM p GROUP BY p1), "
        f"c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s) "
        f"SELECT sum(pos * (nb + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc FROM c")
    return out

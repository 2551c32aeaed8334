"""Entity resolution: prepare, block, score, assign ids, harmonise, collapse.

Plan shape (see README "Matching at scale"):

1. ``prepare_left`` / ``prepare_right`` add normalised names and list counts (column
   expressions, no UDF).
2. ``distinct_names`` reduces each side to its distinct normalised names (partial
   aggregation before the shuffle), with per-name token features computed once.
3. ``candidate_pairs`` joins the two name tables on the block key *and* a length class:
   a pair can only reach the threshold if its lengths are close enough.  Pairs that cannot
   pass are never produced.  Empty names are dropped (they score 0).
4. ``score_pairs`` scores candidate name pairs (LCS kernel over Arrow batches) and
   returns only those at or above the threshold.
5. ``assign_ids`` ranks the matched left names with the distributed dense rank.
6. ``harmonize`` joins matched names back to rows (equi-joins on the name), adds the
   unmatched left rows with ids after the matched ones, and unions both.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regalign.functions.bags import WIDTH, bag, common, counts, most_percent
from regalign.functions.similarity import DEFAULT_WEIGHTS, name_features, score_name_pairs
from regalign.functions.text import block_key, extract_city, format_id, list_size, normalize_name
from regalign.operators.joins import DEFAULT_MAX_PAIRS, balanced_join
from regalign.operators.ranking import dense_rank_global, first_per_key, row_number_global
from regalign.session import materialize, parallelism, together


@dataclass(frozen=True)
class MatchConfig:
    threshold: float = 0.85
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS
    block_chars: int = 3
    id_prefix: str = "CORP_"
    id_width: int = 6
    list_sep: str = ";"
    null_list_size: int | None = -1


def prepare_left(df: DataFrame, name: str = "corporate_name_s1", address: str = "address",
                 suppliers: str = "top_suppliers", cfg: MatchConfig = MatchConfig()) -> DataFrame:
    return (
        df.withColumn("normalized_name", normalize_name(name))
        .withColumn("city", extract_city(address))
        .withColumn("supplier_count", list_size(suppliers, cfg.list_sep, cfg.null_list_size))
    )


def prepare_right(df: DataFrame, name: str = "corporate_name_s2", customers: str = "main_customers",
                  cfg: MatchConfig = MatchConfig()) -> DataFrame:
    return df.withColumn("normalized_name", normalize_name(name)).withColumn(
        "customer_count", list_size(customers, cfg.list_sep, cfg.null_list_size)
    )


ROW_ID = "_row_id"

#: The harmonised columns that come from each side; the right ones with type and value when unmatched.
LEFT_COLUMNS = ["normalized_name", "address", "activity_places", "top_suppliers", "supplier_count"]
RIGHT_COLUMNS = {"main_customers": ("string", None), "customer_count": ("int", 0), "revenue": ("long", None), "profit": ("long", None)}
HARMONISED = ["corporate_id", "corporate_name", *LEFT_COLUMNS, *RIGHT_COLUMNS, "similarity_score", "harmonization_timestamp"]


def with_row_id(prepared: DataFrame, name: str) -> DataFrame:
    """``prepared`` written once to the shared folder with a row id.

    The id is fixed by the write.  It tells equal rows apart, so that copies of a row spread over
    the cells of a balanced join and over the ranges of a ranking.
    """
    return materialize(row_numbered(prepared), name)


def row_numbered(prepared: DataFrame) -> DataFrame:
    """``prepared`` with the row id, for a caller that writes it."""
    return prepared.withColumn(ROW_ID, F.monotonically_increasing_id())


def distinct_names(prepared: DataFrame, prefix: str, block_chars: int = 3, name_col: str = "normalized_name",
                   materialize: bool = False) -> DataFrame:
    """Distinct non-empty names of one side with block key, row count and token features.

    One aggregate (partial before the shuffle).  ``{prefix}_rows`` is the number of rows
    per name, used later to size the row-pair joins without another pass over the rows.
    With ``materialize`` the table (bounded by distinct names, not rows) is checkpointed
    so its several consumers do not re-scan and re-normalise the source.
    """
    names = (
        prepared.where(F.col(name_col) != "")
        .groupBy(F.col(name_col).alias(f"{prefix}_name"))
        .agg(F.count(F.lit(1)).alias(f"{prefix}_rows"))
    )
    names = names.withColumn(f"{prefix}_block", block_key(f"{prefix}_name", block_chars))
    names = with_bags(name_features(names, f"{prefix}_name", prefix), prefix)
    return names.checkpoint(eager=True) if materialize else names


def length_factor(threshold: float, weights=DEFAULT_WEIGHTS) -> float | None:
    """Largest length ratio max/min a pair can have and still reach ``threshold``.

    ``ratio`` and ``token_sort`` are both at most 2*min/(m+n) of their strings' lengths
    and ``token_set`` is at most 1, so a passing pair needs
    max(ratio, token_sort) >= c = (t - w_t) / (w_r + w_s); rounding to whole percents
    can add 0.005.  None when no length bound follows (c <= 0).
    """
    w_r, w_s, w_t = weights
    if w_r + w_s <= 0:
        return None
    c = (threshold - w_t) / (w_r + w_s) - 0.005 - 1e-9
    if c <= 0:
        return None
    return (2.0 - c) / c * (1 + 1e-12)


# grid cells per scoring task when the candidate join is spread over the cluster: with
# several cells per task, hashing cells to tasks evens out the pair work
CELLS_PER_TASK = 8


def candidate_pairs(left_names: DataFrame, right_names: DataFrame, threshold: float | None,
                    weights=DEFAULT_WEIGHTS, max_pairs_per_cell: int = DEFAULT_MAX_PAIRS,
                    num_partitions: int | None = None) -> DataFrame:
    """Blocked name pairs that can reach ``threshold``; all pairs of a block without one.

    For a plan that ends in the threshold filter.  Each name has two lengths: its own (for
    ``ratio``) and that of its sorted token string (for ``token_sort``, never longer).  A left
    name can match lengths in ``[sorted_len / f, len * f]``, a right name has those in
    ``[sorted_len, len]``.  The join key is the block and a length class (powers of f, so a name
    has two or three); the pair is kept once, in the smallest class both have, if the two ranges
    meet.

    A pair that meets is also held against its character bags (``functions.bags``) before it leaves
    the join, so only pairs with enough characters in common are handed to the LCS kernel.

    The join is a ``balanced_join``: a (block, length) key that would produce more than
    ``max_pairs_per_cell`` pairs is spread over a grid of tasks (a hot block is small in
    bytes but quadratic in pairs, which input-size skew handling cannot see).

    ``num_partitions`` (e.g. the cluster's cores): the name tables are shuffled into that
    many partitions by (key, cell) so the pairs come out spread and can be scored in the
    same stage (``score_pairs(..., respread=False)``); the pairs themselves, by far the
    largest intermediate, are never shuffled.  The cell budget is then sized to the
    cluster (about ``CELLS_PER_TASK`` cells per task, never above ``max_pairs_per_cell``).
    """
    f = None if threshold is None else length_factor(threshold, weights)
    bounded = threshold is not None and min(weights) >= 0
    if bounded:
        left_names, right_names = with_bags(left_names, "l"), with_bags(right_names, "r")
    else:
        left_names, right_names = left_names.drop(*bag_columns("l")), right_names.drop(*bag_columns("r"))
    if f is None:
        out = balanced_join(left_names, right_names, ["l_block"], max_pairs_per_cell, right_keys=["r_block"],
                            num_partitions=num_partitions, cells_per_partition=CELLS_PER_TASK)
        out = out.withColumn("r_block", F.col("l_block"))
        return within_reach(out, threshold, weights) if bounded else out
    step = math.log(max(f, 1.25))

    def length_class(n):
        return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.lit(step)).cast("int")

    lo = F.ceil(F.length("l_sorted") / F.lit(f) - F.lit(1e-9)).cast("int")
    hi = F.floor(F.length("l_name") * F.lit(f) + F.lit(1e-9)).cast("int")
    left = left_names.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_lc", length_class(lo))
    left = left.withColumn("_l_len", F.explode(F.sequence(F.col("_lc"), length_class(hi))))
    right = right_names.withColumn("_rlo", F.length("r_sorted")).withColumn("_rhi", F.length("r_name")).withColumn(
        "_rc", length_class(F.length("r_sorted")))
    right = right.withColumn("_r_len", F.explode(F.sequence(F.col("_rc"), length_class(F.length("r_name")))))
    lc = left.groupBy("l_block", "_l_len").agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(F.col("r_block").alias("l_block"), F.col("_r_len").alias("_l_len")).agg(
        F.count(F.lit(1)).alias("_nr"))
    joined = balanced_join(left, right, ["l_block", "_l_len"], max_pairs_per_cell, right_keys=["r_block", "_r_len"],
                           left_counts=lc, right_counts=rc, num_partitions=num_partitions,
                           cells_per_partition=CELLS_PER_TASK)
    meet = F.greatest("_lo", "_rlo") <= F.least("_hi", "_rhi")
    out = joined.where((F.col("_l_len") == F.greatest("_lc", "_rc")) & meet).withColumn(
        "r_block", F.col("l_block")).drop("_lo", "_hi", "_lc", "_rlo", "_rhi", "_rc", "_l_len")
    return within_reach(out, threshold, weights)


def bag_columns(prefix: str) -> list[str]:
    return [f"_{prefix}{tag}{i}" for tag in "ns" for i in range(WIDTH)]


def with_bags(names: DataFrame, prefix: str) -> DataFrame:
    """Names with the character bags of the name and of its sorted tokens (fixed width, once per name)."""
    if set(bag_columns(prefix)) <= set(names.columns):
        return names
    counted = names.select("*", counts(f"{prefix}_name").alias("_cn"), counts(f"{prefix}_sorted").alias("_cs"))
    return counted.select(*names.columns, *[w.alias(c) for w, c in zip(bag("_cn") + bag("_cs"), bag_columns(prefix))])


def within_reach(pairs: DataFrame, threshold: float, weights=DEFAULT_WEIGHTS) -> DataFrame:
    """Pairs whose score can reach ``threshold``: the character bags bound ``ratio`` and ``token_sort``,
    ``token_set`` is taken as 1.  Drops the bags."""
    w_r, w_s, w_t = weights

    def words(prefix: str, tag: str) -> list:
        return [F.col(f"_{prefix}{tag}{i}") for i in range(WIDTH)]

    def part(tag: str, column: str):
        return most_percent(common(words("l", tag), words("r", tag)), F.length(f"l_{column}"), F.length(f"r_{column}"))

    best = F.lit(w_r / 100.0) * part("n", "name") + F.lit(w_s / 100.0) * part("s", "sorted") + F.lit(float(w_t))
    return pairs.where(best >= F.lit(threshold - 1e-9)).drop(*bag_columns("l"), *bag_columns("r"))


def score_pairs(candidates: DataFrame, threshold: float | None, weights=DEFAULT_WEIGHTS,
                respread: bool = True) -> DataFrame:
    """Scores of candidate name pairs; keeps ``similarity_score >= threshold`` unless None.

    ``respread=False`` when the candidates already come out spread over the cluster
    (``candidate_pairs(..., num_partitions=n)``), so they are scored where they are made.
    """
    return score_name_pairs(candidates, "l", "r", weights, respread=respread, threshold=threshold)


def matched_names(left_prepared: DataFrame, right_prepared: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """(l_name, r_name, similarity_score) for distinct name pairs at or above the threshold."""
    ln, rn = together(left_prepared.sparkSession, *[
        lambda df=df, p=p: distinct_names(df, p, cfg.block_chars, materialize=True)
        for df, p in ((left_prepared, "l"), (right_prepared, "r"))])
    cands = candidate_pairs(ln, rn, cfg.threshold, cfg.weights, num_partitions=parallelism(left_prepared.sparkSession))
    return score_pairs(cands, cfg.threshold, cfg.weights, respread=False).select(
        "l_name", "r_name", "similarity_score")


def assign_ids(names: DataFrame, name_col: str = "l_name", cfg: MatchConfig = MatchConfig(),
               out: str = "corporate_id", names_are_distinct: bool = False) -> DataFrame:
    """Equal names get equal ids: ``prefix + lpad(dense_rank over name)``."""
    ranked = dense_rank_global(names, [name_col], "_id_rank", keys_are_distinct=names_are_distinct)
    return ranked.withColumn(out, format_id("_id_rank", cfg.id_prefix, cfg.id_width))


def unmatched_left(left_prepared: DataFrame, matched_names: DataFrame) -> DataFrame:
    """Left rows whose normalised name is not among ``matched_names`` (``l_name``, distinct).

    Equal raw names have equal normalised names, so this is the anti join on the raw name, against
    the small table of names; rows without a name never match and are kept.
    """
    names = matched_names.select(F.col("l_name").alias("_mn"))
    return left_prepared.join(names, left_prepared["normalized_name"] == names["_mn"], "left_anti")


def harmonize(
    left_prepared: DataFrame,
    right_prepared: DataFrame,
    matches: DataFrame,
    cfg: MatchConfig = MatchConfig(),
    ts=None,
    left_name: str = "corporate_name_s1",
    right_name: str = "corporate_name_s2",
    left_order: list[str] | None = None,
    collapsed: bool = False,
    part: str = "all",
    matches_materialized: bool = False,
    max_pairs_per_cell: int = DEFAULT_MAX_PAIRS,
    left_names: DataFrame | None = None,
    right_names: DataFrame | None = None,
) -> DataFrame:
    """One row per matched (left row, right row) pair plus one per unmatched left row.

    With ``collapsed=True`` the result has one row per id instead, equal to
    ``collapse_by_id(harmonize(...))`` but computed without forming the pairs: the
    preference order splits into criteria of the right row (similarity, revenue, profit,
    customers) and of the left row (name, address, ...), so the best pair is the best
    right row per name next to the best left row per name, two partial aggregates joined
    one-to-one.  A name held by many rows on both sides never multiplies.

    ``part``: "all", "matched" or "unmatched" (the left rows without a match, with ids).
    ``matches_materialized``: the caller already checkpointed ``matches``.
    ``left_names`` / ``right_names``: the ``distinct_names`` tables (with row counts), if
    the caller has them; they size the row-pair joins without another pass over the rows.

    ``matches`` is (l_name, r_name, similarity_score) over normalised names.  Matched ids
    are the dense rank of the left normalised name; unmatched left rows are numbered by
    raw name (ties broken by ``left_order``) starting at (number of matched ids) + 2,
    i.e. max id + 1 + row_number, or 2 when nothing matched.  Right rows without a match
    are not kept.
    """
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    # matched name pairs feed three branches; fix them once (bounded by distinct-name pairs)
    # with a reliable checkpoint in the shared folder so scoring is not repeated
    if not matches_materialized:
        matches = matches.checkpoint(eager=True)
    matched_names = matches.select("l_name").distinct()
    rest = unmatched_left(left_prepared, matched_names).drop("city")
    # One distributed numbering for both id ranges: matched names first (dense rank =
    # row number over distinct names), then the unmatched rows by raw name with tie-breaks.
    # The reference leaves one id unused between the two ranges (K8), hence the +1.
    tie = list(left_order or [c for c in ("address", "activity_places", "top_suppliers") if c in left_prepared.columns])
    order_keys = [left_name] + tie + [c for c in (ROW_ID,) if c in left_prepared.columns]
    # the names stand in the rows' own name column, so no sort key is carried twice
    numbered_all = row_number_global(
        matched_names.select(F.lit(0).alias("_grp"), F.col("l_name").alias(left_name)).unionByName(
            rest.withColumn("_grp", F.lit(1)), allowMissingColumns=True), ["_grp", *order_keys], "_rn")
    ids = numbered_all.where(F.col("_grp") == 0).select(
        F.col(left_name).alias("l_name"), format_id("_rn", cfg.id_prefix, cfg.id_width).alias("corporate_id"))
    numbered = numbered_all.where(F.col("_grp") == 1).withColumn("_rn", F.col("_rn") + F.lit(1))
    if collapsed:
        matched = _best_pair_per_id(left_prepared, right_prepared, matches, ids, stamp, left_name)
    else:
        # row pairs per matched name: both joins are balanced by pair count, so a name held
        # by many rows on both sides is spread over many tasks
        m = matches.join(ids, "l_name")
        rp = right_prepared.select(*[F.col(c).alias(f"s2__{c}") for c in right_prepared.columns])
        lp = left_prepared.select(*[F.col(c).alias(f"s1__{c}") for c in left_prepared.columns])
        m_counts = r_counts = l_counts = mr_counts = None
        if left_names is not None and right_names is not None:
            m_counts = m.groupBy("r_name").agg(F.count(F.lit(1)).alias("_nl"))
            r_counts = right_names.select("r_name", F.col("r_rows").alias("_nr"))
            l_counts = left_names.select(F.col("l_name").alias("s1__normalized_name"), F.col("l_rows").alias("_nl"))
            mr_counts = m.join(right_names.select("r_name", "r_rows"), "r_name").groupBy(
                F.col("l_name").alias("s1__normalized_name")).agg(F.sum("r_rows").alias("_nr"))
        mr = balanced_join(m, rp, ["r_name"], max_pairs_per_cell, right_keys=["s2__normalized_name"],
                           left_counts=m_counts, right_counts=r_counts)
        pairs = balanced_join(lp, mr, ["s1__normalized_name"], max_pairs_per_cell, right_keys=["l_name"],
                              left_counts=l_counts, right_counts=mr_counts)
        matched = pairs.select(
            "corporate_id", F.coalesce(F.col(f"s1__{left_name}"), F.col(f"s2__{right_name}")).alias("corporate_name"),
            *[F.col(f"s1__{c}").alias(c) for c in LEFT_COLUMNS], *[F.col(f"s2__{c}").cast(t).alias(c) for c, (t, _) in RIGHT_COLUMNS.items()],
            "similarity_score", stamp.alias("harmonization_timestamp"))
    unmatched = numbered.select(
        format_id(F.col("_rn"), cfg.id_prefix, cfg.id_width).alias("corporate_id"), F.col(left_name).alias("corporate_name"),
        *LEFT_COLUMNS, *[F.lit(none).cast(t).alias(c) for c, (t, none) in RIGHT_COLUMNS.items()],
        F.lit(0.0).alias("similarity_score"), stamp.alias("harmonization_timestamp"))
    if part == "matched":
        return matched
    if part == "unmatched":
        return unmatched
    return matched.unionByName(unmatched)


def _best_pair_per_id(left_prepared: DataFrame, right_prepared: DataFrame, matches: DataFrame, ids: DataFrame,
                      stamp, left_name: str) -> DataFrame:
    """The row ``collapse_by_id`` would keep for each matched id, without the pair product.

    The best right row of a right name doesn't depend on the left name, so both sides are reduced to
    one row per name before they meet the matches; then each left name keeps its best partner.
    """
    r_order = [F.col("revenue").desc_nulls_last(), F.col("profit").desc_nulls_last(), F.col("main_customers"), F.col("customer_count")]
    best_r = first_per_key(right_prepared.select(F.col("normalized_name").alias("r_name"), "main_customers", "customer_count", "revenue", "profit"),
                           ["r_name"], r_order)
    partner = first_per_key(matches.join(best_r, "r_name"), ["l_name"], [F.col("similarity_score").desc_nulls_last(), *r_order, F.col("r_name")])
    l_payload = ["address", "activity_places", "top_suppliers", "supplier_count"]
    best_l = first_per_key(left_prepared.select(left_name, "normalized_name", *l_payload), ["normalized_name"],
                           [F.col(left_name).asc_nulls_last(), *[F.col(c) for c in l_payload]])
    both = best_l.join(partner.join(ids, "l_name"), F.col("normalized_name") == F.col("l_name"))
    return both.select("corporate_id", F.col(left_name).alias("corporate_name"), *HARMONISED[2:-1], stamp.alias("harmonization_timestamp"))


def resolve_entities(left: DataFrame, right: DataFrame, cfg: MatchConfig = MatchConfig(), ts=None,
                     collapsed: bool = False) -> DataFrame:
    """Prepare both sides, block, score, assign ids and harmonise (one row per id if ``collapsed``)."""
    # each prepared side is read by the name table, the anti join and the row-pair joins
    lp, rp = together(left.sparkSession, lambda: with_row_id(prepare_left(left, cfg=cfg), "left-prepared"),
                      lambda: with_row_id(prepare_right(right, cfg=cfg), "right-prepared"))
    matches = matched_names(lp, rp, cfg)
    return harmonize(lp, rp, matches, cfg, ts, collapsed=collapsed)


def collapse_by_id(df: DataFrame, key: str = "corporate_id") -> DataFrame:
    """One row per id: best similarity, then greatest revenue, then names (deterministic).

    Every task keeps its own best row of an id before the shuffle, so a hot id is one row per task.
    """
    payload = [c for c in df.columns if c != key]
    best = [F.col("similarity_score").desc_nulls_last(), F.col("revenue").desc_nulls_last(), F.col("corporate_name").asc_nulls_last(),
            F.col("profit").desc_nulls_last(), *[F.col(c) for c in payload]]
    return first_per_key(df, [key], best).select(key, *payload)


def block_stats(left_names: DataFrame, right_names: DataFrame) -> DataFrame:
    """Per block key: distinct names on each side and the all-pairs count the block implies."""
    lc = left_names.groupBy(F.col("l_block").alias("block_key")).agg(F.count(F.lit(1)).alias("left_names"))
    rc = right_names.groupBy(F.col("r_block").alias("block_key")).agg(F.count(F.lit(1)).alias("right_names"))
    return lc.join(rc, "block_key", "inner").withColumn(
        "block_pairs", F.col("left_names").cast("long") * F.col("right_names").cast("long")
    )

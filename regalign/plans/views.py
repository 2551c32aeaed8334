"""Company-style inputs derived from the driver tables (whole tables, no row subsets).

* ``supply_view`` (source-1 shape): one row per part.  The name is the part name, its
  brand and a legal suffix (every 13th with a typo in its first letters, so it has no
  partner in its block); the address has a city from the nation table.
* ``finance_view`` (source-2 shape): one row per (part name, brand) that has sales;
  revenue and profit are whole-unit sums over ``lineitem``; the name is a variant
  (suffix, upper case, a dropped letter, or brand first).
* ``customer_registry``: registry-shaped rows per customer from ``orders`` for the
  training queries.
* ``supplier_finance``: revenue and profit per supplier from ``lineitem``.

Each view has an SQL twin in ``oracle.py``; both must describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.functions.text import format_id

# Legal suffixes appended to part names, chosen by p_partkey % 9.
NAME_SUFFIXES = ["", " Inc", " Inc.", " Corp", " Corporation", " Ltd", " Limited", " LLC", " Co"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def supply_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")  # 25 rows: a fixed dimension table
    suffix = F.element_at(F.array(*[F.lit(s) for s in NAME_SUFFIXES]), (F.col("p_partkey") % 9 + 1).cast("int"))
    # every 13th name carries a typo in its first letters, so it lands in a block of its own
    typo = F.when(F.col("p_partkey") % 13 == 0, F.lit("X")).otherwise(F.lit(""))
    joined = part.join(F.broadcast(nation), nation.n_nationkey == part.p_partkey % 25)
    return joined.select(
        F.col("p_partkey").alias("row_id"),
        F.concat(typo, F.col("p_name"), F.lit(" "), F.col("p_brand"), suffix).alias("corporate_name_s1"),
        F.concat(_s("p_size"), F.lit(" "), F.lower("p_type"), F.lit(" street, "), F.col("n_name"),
                 F.lit(", zip "), _s("p_partkey")).alias("address"),
        F.concat(F.lower("p_type"), F.lit(";"), F.col("n_name")).alias("activity_places"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string")).otherwise(
            F.concat_ws(";", F.concat(F.lit("Supplier"), _s(F.col("p_partkey") % 7)),
                        F.concat(F.lit("Supplier"), _s(F.col("p_size") % 5)),
                        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Supplier"), _s(F.col("p_size") % 3))))
        ).alias("top_suppliers"),
    )


def part_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.round("l_extendedprice").cast("long")).alias("rev"),
        F.sum(F.round(F.col("l_extendedprice") * (F.lit(0.1) - F.col("l_discount"))).cast("long")).alias("prof"),
    )


def finance_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    sales = part_sales(spark, sf_dir)
    grp = part.join(sales, sales.l_partkey == part.p_partkey).groupBy("p_name", "p_brand").agg(
        F.min("p_partkey").alias("k"), F.sum("n_lines").alias("n_lines"),
        F.sum("rev").alias("revenue"), F.sum("prof").alias("profit"))
    k5 = F.col("k") % 5
    name = (
        F.when(k5 == 0, F.concat_ws(" ", "p_brand", "p_name"))
        .when(k5 == 1, F.concat(F.substring("p_name", 1, 3), F.expr("substring(p_name, 5)"), F.lit(" "), F.col("p_brand")))
        .when(k5 == 2, F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" Inc.")))
        .when(k5 == 3, F.concat(F.upper("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" Corporation")))
        .otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    )
    n = F.col("n_lines")
    customers = F.when(n % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(";", F.lit("Retail"), F.when(n % 2 == 0, F.lit("Wholesale")), F.when(n % 3 == 0, F.lit("Online"))))
    return grp.select(
        F.col("k").alias("row_id"),
        name.alias("corporate_name_s2"),
        customers.alias("main_customers"),
        F.col("revenue").cast("long").alias("revenue"),
        F.col("profit").cast("long").alias("profit"),
    )


def supplier_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier")
    agg = li.groupBy("l_suppkey").agg(
        F.sum(F.round("l_extendedprice").cast("long")).alias("revenue"),
        F.sum(F.round(F.col("l_extendedprice") * (F.lit(0.1) - F.col("l_discount"))).cast("long")).alias("profit"),
    )
    return sup.join(agg, sup.s_suppkey == agg.l_suppkey, "left").select("s_suppkey", "s_name", "revenue", "profit")


def customer_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry-shaped rows per customer: revenue/profit from orders (null without orders)."""
    cust = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    agg = orders.groupBy("o_custkey").agg(
        F.sum(F.round("o_totalprice").cast("long")).alias("revenue"),
        F.sum(F.round(F.col("o_totalprice") * F.lit(0.5)).cast("long")).alias("profit"),
        F.count(F.lit(1)).cast("int").alias("supplier_count"),
        F.count_distinct("o_orderpriority").cast("int").alias("n_prio"),
    )
    j = cust.join(agg, cust.c_custkey == agg.o_custkey, "left")
    return j.select(
        format_id(F.col("c_custkey"), "CORP_", 9).alias("corporate_id"),
        F.col("c_name").alias("corporate_name"),
        F.col("revenue"),
        F.col("profit"),
        F.col("supplier_count"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("int")).otherwise(F.col("n_prio"))
        .alias("customer_count"),
    )

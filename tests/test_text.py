"""Scalar name, address, list and id functions."""

import pytest
from pyspark.sql import functions as F

from regalign.functions.text import (block_key, categorize, extract_city, format_id, list_size, normalize_name,
                                     parse_id)


def _one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("name,expected", [
    ("Juniper Corporation", "juniper"), ("JUNIPER Corp", "juniper"), ("Juniper Inc.", "juniper"),
    ("Juniper Incorporated", "juniper"), ("Blue-Heron, Inc.", "blue heron"), ("B&Q&R Corporation", "b q r"),
    ("7 Oaks Company", "7 oaks"), ("Company Ltd", "company"), ("Mill Corp.", "mill"), ("Quarry Ltd", "quarry"),
    ("Harbour LLC", "harbour"), ("Ferry Limited", "ferry"), ("", ""), (None, ""),
    # order of the suffix rules matters and each applies once
    ("Oak Co Inc", "oak"), ("Oak Inc Co", "oak inc"), ("Inc", "inc"), ("  Wide \t Gap  ", "wide gap"),
    ("Bäcker GmbH & Co", "bäcker gmbh"), ("Last Inc\n", "last"),
])
def test_normalize_name(spark, name, expected):
    assert _one(spark, normalize_name, name) == expected


@pytest.mark.parametrize("address,expected", [
    ("9 Canal Walk, Little Haven, ZZ 00112", "little haven"), ("Unit 4, Ostby, North Quay", "ostby"),
    ("", ""), (None, ""), ("one part only", ""), ("a,", ""), ("a,\tTab City\t,x", "tab city"),
])
def test_extract_city(spark, address, expected):
    assert _one(spark, extract_city, address) == expected


@pytest.mark.parametrize("value,expected", [("a;b;c", 3), ("", 1), (None, -1), ("a;b;", 3), ("x", 1)])
def test_list_size(spark, value, expected):
    assert _one(spark, lambda c: list_size(c), value) == expected


def test_list_size_null_rule_independent_of_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            assert _one(spark, lambda c: list_size(c), None) == -1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_block_key(spark):
    assert _one(spark, block_key, "acme") == "acm"
    assert _one(spark, block_key, "ab") == "ab"


def test_format_and_parse_id(spark):
    assert _one(spark, lambda c: format_id(c), 17, "long") == "CORP_000017"
    assert _one(spark, lambda c: parse_id(c), "CORP_000123") == 123
    assert _one(spark, lambda c: parse_id(c), "bad") is None


def test_format_id_never_truncates(spark):
    # past 999,999 entities the reference's lpad would cut digits and ids would collide
    assert _one(spark, lambda c: format_id(c), 1234567, "long") == "CORP_1234567"
    assert _one(spark, lambda c: format_id(c), 999999, "long") == "CORP_999999"


def test_categorize(spark):
    assert _one(spark, lambda c: categorize(c, 1_000_000), 2_000_000, "long") == "High"
    assert _one(spark, lambda c: categorize(c, 1_000_000), 1_000_000, "long") == "Low"
    assert _one(spark, lambda c: categorize(c, 1_000_000), None, "long") == "Low"

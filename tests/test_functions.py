"""Scalar functions: exact decimals, sentinel, truncation, dates, receipts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from credlake.functions import numeric as N
from credlake.functions.dates import date_parts
from credlake.functions.payload import is_valid_json_object
from credlake.functions.text import extract_amount, id_prefix, is_numeric_id, truncate, document_file_name


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_years_floor_and_round(spark):
    assert one(spark, N.days_to_years_floor(F.col("v")), "-9461") == Decimal("25.0")   # 25.9 -> floor 25
    assert one(spark, N.days_to_years_round1(F.col("v")), "-3648.0") == Decimal("10.0")  # 9.98768 -> 10.0
    assert one(spark, N.days_to_years_round1(F.col("v")), "-1200") == Decimal("3.3")
    assert one(spark, N.days_to_years_round1(F.col("v")), "0") == Decimal("0.0")
    assert one(spark, N.days_to_years_round1(F.col("v")), None) is None


def test_round_half_away_from_zero(spark):
    # 36.525 days = 0.1 years exactly half of 0.1 steps? use a direct decimal check
    assert one(spark, F.round(F.col("v").cast("decimal(10,3)"), 1), "0.250") == Decimal("0.3")
    assert one(spark, F.round(F.col("v").cast("decimal(10,3)"), 1), "-0.250") == Decimal("-0.3")


def test_sentinel_rules(spark):
    assert one(spark, N.sentinel_to_null(F.col("v").cast("int")), "365243") is None
    assert one(spark, N.sentinel_to_null(F.col("v").cast("int")), "-10") == -10
    assert one(spark, N.tenure_years(F.col("v")), "365243") == Decimal("0.0")
    assert one(spark, N.tenure_years(F.col("v")), None) is None


def test_guarded_ratio(spark):
    df = spark.createDataFrame([("100.00", "3.00"), ("5.00", "0.00"), ("5.00", "-1.00"), (None, "2.00")], "n string, d string")
    out = [r["r"] for r in df.select(N.guarded_ratio(N.to_money(F.col("n")), N.to_money(F.col("d"))).alias("r")).collect()]
    assert out == [Decimal("33.3333"), None, None, None]


def test_ratio_overflow_raises_like_numeric_10_4(spark):
    df = spark.createDataFrame([("500000.00", "0.10")], "n string, d string")
    with pytest.raises(Exception):
        df.select(N.guarded_ratio(N.to_money(F.col("n")), N.to_money(F.col("d")))).collect()


def test_bad_text_cast_raises(spark):
    with pytest.raises(Exception):
        one(spark, N.to_smallint(F.col("v")), "1.0")


def test_truncate_50(spark):
    assert one(spark, truncate(F.col("v")), "x" * 72) == "x" * 50
    assert one(spark, truncate(F.col("v")), "short") == "short"


def test_date_parts_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 13),)], "d date")
    rows = df.select(*date_parts(F.col("d"))).collect()
    assert [r["dia_semana"] for r in rows] == [0, 6]
    assert (rows[0]["anio"], rows[0]["mes"], rows[0]["trimestre"]) == (2024, 1, 1)


def test_amount_pattern_parity_and_strict(spark):
    texts = ["BOLETA\nNETO A PAGAR S/\n\n1,130.63 ref 1.00", "neto a pagar s/ 1130.63", "sin monto", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["a"] for r in df.select(extract_amount(F.col("t")).alias("a")).collect()]
    assert got == [1130.63, 130.63, None, None]  # ungrouped amount loses a digit, as in the original
    strict = [r["a"] for r in df.select(extract_amount(F.col("t"), strict=True).alias("a")).collect()]
    assert strict[:2] == [1130.63, 1130.63]


def test_file_name_rules(spark):
    df = spark.createDataFrame([("100002_boleta.jpg",), ("x_boleta.jpg",), ("²_a.jpg",), ("123.jpg",)], "n string")
    rows = df.select(id_prefix(F.col("n")).alias("i"), is_numeric_id(id_prefix(F.col("n"))).alias("ok")).collect()
    assert [(r["i"], r["ok"]) for r in rows] == [("100002", True), ("x", False), ("²", False), ("123.jpg", False)]


def test_document_file_name(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 6, 15, 2, 4, 56),)], "ts timestamp_ntz")
    assert df.select(document_file_name(F.col("ts")).alias("n")).first()["n"] == "idp_boleta_20260615_020456.json"
    assert df.select(document_file_name(F.col("ts"), F.lit(7)).alias("n")).first()["n"] == \
        "idp_boleta_20260615_020456_7.json"


def test_json_validity(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{bad",), ("[1,2]",), (None,)], "v string")
    assert [r["ok"] for r in df.select(is_valid_json_object(F.col("v")).alias("ok")).collect()] == \
        [True, False, False, False]

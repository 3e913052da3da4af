"""Golden values of the row-local cleaners (hand-traced expectations)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paysheaf.functions import text as X
from paysheaf.operators.quality import fold_club
from paysheaf.sources.links import detect_format, extract_year


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("raw,expected", [
    ("$1,234.56", Decimal("1234.56")), ("1234.56$", Decimal("1234.56")), ("$", None),
    ("-", None), ("$-5.00", Decimal("-5.00")), ("", None), (None, None), ("1.2.3", None),
    ("1_000", None), ("nan", None), ("inf", None), ("1e5", None), ("5d", None),
    ("  $ 1,000 ", Decimal("1000.00")), (".5", Decimal("0.50")), ("+7", Decimal("7.00")),
])
def test_clean_money(spark, raw, expected):
    assert one(spark, X.clean_money, raw) == expected


@pytest.mark.parametrize("raw,expected", [(" m-f ", "M-F"), (None, ""), ("", ""), ("\tgk\n", "GK")])
def test_clean_code(spark, raw, expected):
    assert one(spark, X.clean_code, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    (' "O\'Neil" ', "O'Neil"), ("'Doe'", "Doe"), (None, ""), ('"\'x\'"', "x"), ('\'"x"\'', '"x"'),
])
def test_clean_name(spark, raw, expected):
    assert one(spark, X.clean_name, raw) == expected


def test_collapse_and_blank(spark):
    assert one(spark, X.collapse_ws, " a \t  b ") == "a b"
    assert one(spark, X.collapse_ws, "  ") == ""
    assert one(spark, X.blank_to_null, "  ") is None
    assert one(spark, X.blank_to_null, None) is None
    # Unicode spaces count as whitespace, as in Python's str.strip().
    assert one(spark, X.collapse_ws, " a　 b ") == "a b"
    assert one(spark, X.strip, "\t a \n") == "a"


@pytest.mark.parametrize("raw,expected", [("#10", "10"), ("No. 7 / 8", "7"), ("--", None), (None, None)])
def test_first_digits(spark, raw, expected):
    assert one(spark, X.first_digits, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Ht. (cm)", "ht_cm"), ("Date of  Birth:", "date_of_birth"), ("Größe", "größe"), ("  ", ""),
])
def test_normalize_key(spark, raw, expected):
    assert one(spark, X.normalize_key, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("M", True), ("M-F", True), ("D/M", True), ("Kim", True), ("Smith", False), ("M1", False),
    ("", False), ("-", False), ("Él", True),
])
def test_looks_like_code(spark, raw, expected):
    assert one(spark, X.looks_like_code, raw) == expected


def test_strip_if_set(spark):
    assert one(spark, X.strip_if_set, None) is None
    assert one(spark, X.strip_if_set, "") is None
    assert one(spark, X.strip_if_set, "   ") == ""
    assert one(spark, X.strip_if_set, " D ") == "D"


def test_money_positions(spark):
    df = spark.createDataFrame([(["SEA", "Doe", "$5", "1,000", "123", "12.34", "2$"],)], "t array<string>")
    assert df.select(X.money_positions(F.col("t")).alias("p")).collect()[0]["p"] == [2, 3, 5, 6]


def test_split_names(spark):
    df = spark.createDataFrame([([],), (["Doe"],), (["Doe", "Jane", "Ann"],)], "t array<string>")
    lf = [tuple(r) for r in df.select(X.split_names(F.col("t"), F.lit(True)).alias("s"))
          .select("s.*").collect()]
    assert lf == [("", ""), ("", "Doe"), ("Jane Ann", "Doe")]
    fl = [tuple(r) for r in df.select(X.split_names(F.col("t"), F.lit(False)).alias("s"))
          .select("s.*").collect()]
    assert fl == [("", ""), ("", "Doe"), ("Doe", "Jane Ann")]


def test_map_prefix_select(spark):
    df = spark.createDataFrame([({"profile_height": " 1.80  m ", "profile_x": "", "other": "1"},)],
                               "m map<string,string>")
    got = df.select(X.map_prefix_select(F.col("m"), "profile_").alias("r")).collect()[0]["r"]
    assert got == {"height": "1.80 m"}


@pytest.mark.parametrize("text,href,expected", [
    ("Fall 2023 guide", "/x", 2023), ("2051", "/x", None), ("1999", "/x", None),
    ("guide", "/files/2019-list.csv", 2019), ("2024 and 2025", "/x", 2024),
])
def test_extract_year(spark, text, href, expected):
    df = spark.createDataFrame([(text, href)], "text string, href string")
    assert df.select(extract_year(F.col("text"), F.col("href")).alias("y")).collect()[0]["y"] == expected


@pytest.mark.parametrize("url,expected", [
    ("a.CSV?x=1", "csv"), ("a.pdf", "pdf"), ("a.csv.pdf", "csv"), ("a.html", None),
])
def test_detect_format(spark, url, expected):
    assert one(spark, detect_format, url) == expected


def test_fold_club(spark):
    assert one(spark, fold_club, "CF Montréal") == "montreal"
    assert one(spark, fold_club, "D.C. United") == "dc united"
    assert one(spark, fold_club, "Seattle Sounders FC") == "seattle sounders"

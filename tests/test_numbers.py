"""Adversarial cells: what parses, what must not, and in which unit it ends up."""

from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions import numbers as N

NBSP, THIN, NARROW = " ", " ", " "
GOOD = [
    ("368,000", "en_GB", "368000"), ("1,234,567.89", "en_US", "1234567.89"), ("13.6", "en_GB", "13.6"), ("(1,234)", "en_US", "-1234"),
    ("£1,234", "en_GB", "1234"), ("13.6¹", "en_GB", "13.6"), ("13.6²", "en_GB", "13.6"), ("13.6*", "en_GB", "13.6"), ("13.6%¹", "en_GB", "13.6"),
    (" 42 ", "en_GB", "42"), (NBSP + "42" + NBSP, "en_GB", "42"), ("-5", "en_GB", "-5"), ("13.61", "en_GB", "13.61"), ("$1,234.56", "en_US", "1234.56"),
    ("EUR 1.234.567,89", "de_DE", "1234567.89"), ("+5", "en_GB", "5"), ("368.000", "de_DE", "368000"), ("13,6", "de_DE", "13.6"), ("(1.234)", "de_DE", "-1234"),
    ("13,6 %", "de_DE", "13.6"), ("1.234.567,89", "de_CH", "1234567.89"), ("368 000", "fr_FR", "368000"), (f"368{NBSP}000", "fr_FR", "368000"),
    (f"368{THIN}000", "fr_FR", "368000"), (f"1{NARROW}368{NARROW}000,5", "fr_FR", "1368000.5"), ("1.234", "en_US", "1.234"), ("1.234", "de_DE", "1234"),
    ("1,234.5", "ja_JP", "1234.5"), ("1.234,5", "es_ES", "1234.5"), ("1.234,5", "it_IT", "1234.5"), ("1.234,5", "nl_NL", "1234.5"), ("1,234", "en_CA", "1234"),
    # Order of cleaning: signs inside parentheses toggle twice, a currency sign may precede a sign.
    ("(-5)", "en_GB", "5"), ("£-5", "en_GB", "-5"), (".5", "en_GB", "0.5"), ("5.", "en_GB", "5"), ("1234567", "en_GB", "1234567"), ("(.5)", "en_GB", "-0.5"), ("( 7 )", "en_GB", "-7"), ("usd 9", "en_US", "9"),
]
BAD = [
    ("", "en_GB", "empty"), ("  ", "en_GB", "empty"), (None, "en_GB", "empty"), ("-", "en_GB", "placeholder"), ("–", "en_GB", "placeholder"), ("—", "en_GB", "placeholder"),
    ("n/a", "en_GB", "placeholder"), ("N/A", "en_GB", "placeholder"), ("na", "en_GB", "placeholder"), ("1.234.56", "en_US", "separators"), ("12,34,56", "en_US", "grouping"),
    ("abc", "en_GB", "residue"), ("12.3.4", "de_DE", "grouping"), ("1,2,3", "de_DE", "separators"), ("£", "en_GB", "no_digits"), ("()", "en_GB", "no_digits"), ("%", "en_GB", "no_digits"),
    ("-£5", "en_GB", "residue"), ("$(1,234)", "en_US", "grouping"), ("(5)¹", "en_GB", "residue"), ("−5", "en_GB", "residue"), ("1234,567", "en_GB", "grouping"),
    ("1,234", "zz_ZZ", "unknown_locale"), ("1,234", None, "unknown_locale"), ("(1.2bn)", "en_GB", "residue"), ("٣", "en_GB", "residue"), ("1" * 30, "en_GB", "too_long"), (".", "en_GB", "no_digits"), ("1 234", "en_GB", "residue"),
    ("1.234 567", "fr_FR", "grouping"), ("1.234", "fr_FR", "residue"), ("1 2345", "fr_FR", "grouping"), ("1,2,3", "fr_FR", "separators"), ("1'234", "de_CH", "residue"), ("1\x01", "en_GB", "residue"), ("\x02", "en_GB", "residue"), ("-", "zz_ZZ", "unknown_locale"), ("(-)", "en_GB", "no_digits"),
]


def test_parse_decimal(spark):
    df = spark.createDataFrame([(i, r, loc) for i, (r, loc, _) in enumerate(GOOD + BAD)], "i int, raw string, loc string")
    got = {r["i"]: r["p"] for r in N.parse_decimal(df, "p", F.col("raw"), F.col("loc")).collect()}
    for i, (raw, loc, want) in enumerate(GOOD):
        assert got[i]["error"] is None and got[i]["value"] == D(want), (raw, loc, got[i])
    for i, (raw, loc, want) in enumerate(BAD, len(GOOD)):
        assert got[i]["value"] is None and got[i]["error"] == want, (raw, loc, got[i])


def test_scale_words(spark):
    cases = [("1.2bn", 10**9), ("3.4 billion", 10**9), ("500m", 10**6), ("500 mn", 10**6), ("7 million", 10**6), ("8k", 1000), ("9 thousand", 1000), ("368,000", 1), ("13.6%", 1), ("summit", 1)]
    rows = spark.createDataFrame(cases, "raw string, want bigint").select("raw", "want", N.detect_scale(F.col("raw")).alias("got")).collect()
    assert [(r["raw"], int(r["got"])) for r in rows] == cases


UNITS = [
    ("13.6%", "en_US", "PERCENT", "millions", "13.6"), ("13,6 %", "de_DE", "PERCENT", "millions", "13.6"), ("13.6", "en_US", "PERCENT", "millions", "13.6"),
    ("0.136", "en_US", "RATIO", "millions", "0.136"), ("13.6%", "en_US", "RATIO", "millions", "0.136"), ("1.2bn", "en_US", "EUR_M", "millions", "1200"), ("500m", "en_US", "EUR_M", "millions", "500"),
    ("368,000", "en_US", "EUR_M", "millions", "368000"), ("1.234.567,89", "de_DE", "GBP_M", "millions", "1234567.89"), ("1,234", "en_US", "COUNT", "millions", "1234"), ("42", "en_US", "NONE", "millions", "42"),
    ("124.0", "en_GB", "USD_M", "billions", "124000"), ("2,947.0", "en_GB", "USD_M", "billions", "2947000"), ("368,000", "en_US", "EUR_M", "thousands", "368"), ("1.2bn", "en_US", "EUR_M", "billions", "1200"), ("500m", "en_US", "EUR_M", "billions", "500"),
    ("14%", "en_US", "GBP_M", "millions", "!percent"), ("14%", "en_US", "COUNT", "millions", "!percent"), ("1000", "en_US", "PERCENT", "millions", "1000"), ("1001", "en_US", "PERCENT", "millions", "!band"), ("-100", "en_US", "PERCENT", "millions", "-100"), ("13.6", "en_US", "RATIO", "millions", "!band"), ("5m¹", "en_US", "EUR_M", "millions", "!residue"),
]


def test_normalise(spark):
    df = spark.createDataFrame([(i, *u) for i, u in enumerate(UNITS)], "i int, raw string, loc string, unit string, scale string, want string")
    for r in N.normalise(df, "p", F.col("raw"), F.col("loc"), F.col("unit"), F.col("scale")).collect():
        if r["want"][0] == "!":
            assert r["p"]["error"] == r["want"][1:] and r["p"]["value"] is None, r
        else:
            assert r["p"]["value"] == D(r["want"]) and r["p"]["error"] is None, r


def test_configuration_faults_raise(spark):
    one = spark.range(1)
    with pytest.raises(PySparkException, match="unknown monetary scale"):
        one.select(N.scale_multiplier(F.lit("zillions"))).collect()
    with pytest.raises(PySparkException, match="no monetary unit"):
        one.select(N.unit_for(F.lit("MONETARY"), F.lit("CAD"))).collect()
    assert one.select(N.unit_for(F.lit("PERCENT"), F.lit("CAD")), N.unit_for(F.lit("MONETARY"), F.lit("GBP"))).first()[:] == ("PERCENT", "GBP_M")


def test_canonical(spark):
    cases = [("50000", "50000"), (" 0.136 ", "0.136"), ("-1.5", "-1.5"), ("+2", "2"), ("1e3", None), ("1,000", None), ("", None), (None, None), (".5", None)]
    for r in spark.createDataFrame(cases, "raw string, want string").select("want", N.parse_canonical(F.col("raw")).alias("got")).collect():
        assert r["got"] == (None if r["want"] is None else D(r["want"]))

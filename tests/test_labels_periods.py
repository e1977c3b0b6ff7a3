from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline.functions import labels, periods


def test_labels(spark):
    cases = [("  Total   CAPITAL ", "total capital"), ("1 CET1 capital", "cet1 capital"), ("1a Tier", "tier"), ("UK 7a Total", "total"), ("1. Total", "total"), ("(1) Total", "total"), ("14.8", "14.8"), ("Total capital 1", "total capital"), ("LCR (%) 12", "lcr (%)"), ("of which 123", "of which 123"), ("Tier 1", "tier"), (" Total own funds", "total own funds"), ("", ""), ("7", ""), ("( 1) Total", "total"), ("(UK 7a) Total", "total"), ("uk", "uk"), ("UK total", "uk total"), ("1 7", "7"), ("1 of 7", "of"), (". Total", ". total"), ("1ab Total", "1ab total")]
    rows = labels.norm_label(spark.createDataFrame(cases, "t string, want string"), "got", F.col("t")).withColumn("is", labels.is_label(F.col("got"))).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    assert [r["is"] for r in rows] == [any(c.isalpha() for c in w) for _, w in cases]


def test_period_labels(spark):
    rows = spark.createDataFrame([("2025Q4",), ("2025FY",), ("2025Q5",), ("x2025Q1",), (None,)], "p string").select("p", periods.is_period(F.col("p")).alias("ok"), periods.period_ord(F.col("p")).alias("o")).collect()
    assert [(r["ok"], r["o"]) for r in rows] == [(True, 20254), (True, 20255), (False, None), (False, None), (False, None)]
    assert spark.range(1).select(periods.period_label(F.lit(2025), F.lit(3)), periods.period_label(F.lit(2025), F.lit(None).cast("int"))).first()[:] == ("2025Q3", "2025FY")


TEXTS = [
    ("Disclosures for Q4 2025.", "2025Q4"), ("Results for the fourth quarter 2025.", "2025Q4"), ("the fourth quarter of 2025", "2025Q4"), ("Annual report FY2025.", "2025FY"),
    ("for the full year 2025", "2025FY"), ("2025 Q4 results", "2025Q4"), ("as at 31/12/2025", "2025Q4"), ("as at 31.12.2025", "2025Q4"), ("date 2025-12-31", "2025Q4"), ("ended 30 September 2025", "2025Q3"),
    ("As at 30 June 2025", "2025Q2"), ("31st Mar. 2025", "2025Q1"), ("on 15 May 2025", None), ("Q1 1850", None), ("Q1 99990", None), ("only 2025", None), ("", None), (None, None), ("Q1 2024 and Q3 2025", "2025Q3"), ("FY2025 and Q4 2025", "2025FY"),
    ("Q3 2024 Q4 2025", "2025Q4"), ("2024 Q4 2025", "2024Q4"), ("Q42025", "2025Q4"), ("Q4FY2025", "2025Q4"), ("131 December 2025", "2025Q4"), ("31December 2025", None), ("31 Decemberish 2025", None), ("31-12.2025", "2025Q4"), ("12025-12-31", "2025Q4"), ("2025-12-311", None), ("FAQ2 2025", "2025Q2"), ("2025 Q45", "2025Q4"), ("AFY 2025", None), ("full - year 2025", "2025FY"), ("financial-year 2025", None), ("FY2025b", None), ("as at\n30 june\t2025", "2025Q2"),
]


def test_period_resolution(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "doc_id int, text string")
    found = periods.period_candidates(df)
    got = {r["doc_id"]: r["period"] for r in periods.resolve_latest(found).collect()}
    assert got == {i: w for i, (_, w) in enumerate(TEXTS)}
    quarter = {r["doc_id"]: r["period"] for r in periods.resolve_latest(found, "quarter_end").collect()}
    assert quarter[19] == "2025Q4" and quarter[3] is None


def test_phrases_of_one_kind_do_not_overlap():
    at = lambda text: [(y, q, evidence) for y, q, evidence, *_ in periods.scan_periods(text)]
    assert at("Q3 2024 Q4 2025") == [(2024, 3, "Q3 2024"), (2025, 4, "Q4 2025")]
    assert at("2024 Q4 2025") == [(2024, 4, "2024 Q4")]
    assert at("2025 Q45 x") == [(2025, 4, "2025 Q4")]
    assert at("as of at 31 March 2025") == [(2025, 1, "as of at 31 March 2025")]
    assert at("as at 131 March 2025") == [(2025, 1, "31 March 2025")]
    assert at("Q4 FY2025") == [(2025, 4, "Q4 FY2025"), (2025, None, "FY2025")]
    scores = lambda text: [float(c[3]) for c in periods.scan_periods(text)]
    assert scores("as at Q4 2025") == [0.9] and scores("format 31/12/2025") == [0.55] and scores("OV1 " + "x" * 78 + " Q1 2025") == [0.7] and scores("OV1, as at Q1 2025") == [0.99]


def test_period_confidence_and_ties(spark):
    df = spark.createDataFrame([(0, "Key metrics (KM1) as at 31 December 2025"), (1, "at 31 December 2025"), (2, "Q4 2025, FY2025"), (3, "Q4 2025, Q1 2024")], "doc_id int, text string")
    found = periods.explain(periods.period_candidates(df))
    rows = {(r["doc_id"], r["period"]): r for r in found.collect()}
    assert rows[0, "2025Q4"]["confidence"] == D("0.95") and rows[0, "2025Q4"]["evidence"].startswith("Key metrics")
    assert rows[1, "2025Q4"]["confidence"] == D("0.70") and rows[1, "2025Q4"]["explanation"].endswith("(chars[0:19])")
    assert {r["doc_id"]: r["ambiguous"] for r in periods.ambiguous(found).collect()} == {0: False, 1: False, 2: True, 3: False}

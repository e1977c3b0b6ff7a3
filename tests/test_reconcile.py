from decimal import Decimal as D

import pytest

from ledgerline.errors import BasisError
from ledgerline.operators import reconcile as R
from ledgerline.plans.pipeline import format_results, reconcile_values
from ledgerline.sources import config

from .helpers import KM1, results, values


def outcomes(row):
    return [(c["check_type"], c["outcome"]) for c in row["checks"]]


def test_clean_filing_passes(spark):
    got = results(spark, values(spark, KM1))
    assert {r["status"] for r in got.values()} == {"AUTO_PASSED"}
    assert {r["confidence"] for r in got.values()} == {D("0.97")}
    assert got["KM1.4"]["validation_basis"] == ["RATIO_IDENTITY"]
    assert outcomes(got["KM1.5"]) == [("RATIO_IDENTITY", "PASS"), ("TWO_ENGINE", "SKIP"), ("MAGNITUDE_SANITY", "PASS")]


def test_tampered_ratio_flags_its_operands(spark):
    got = results(spark, values(spark, KM1 | {"KM1.5": "15.0"}))
    assert {c for c, r in got.items() if r["status"] == "FLAGGED"} == {"KM1.1", "KM1.4", "KM1.5"}
    assert got["KM1.5"]["confidence"] == 0


@pytest.mark.parametrize("ratio, outcome", [("10.1", "PASS"), ("9.9", "PASS"), ("10.100001", "FAIL"), ("9.899999", "FAIL")])
def test_ratio_tolerance_is_inclusive(spark, ratio, outcome):
    vals = values(spark, {"KM1.1": "10000", "KM1.4": "100000", "KM1.5": ratio})
    row = R.ratio_identity(vals, config.identity_operands(spark), config.load_tolerances()).filter("check_id like '%/0'").first()
    assert row["outcome"] == outcome and row["expected"] == 10 and row["actual"] == D(ratio)


def test_missing_operand_and_zero_denominator_skip(spark):
    ops, tol = config.identity_operands(spark), config.load_tolerances()
    rows = R.ratio_identity(values(spark, {"KM1.1": "1", "KM1.4": "0", "KM1.5": "1"}), ops, tol).orderBy("check_id").collect()
    assert [r["outcome"] for r in rows] == ["SKIP"] * 3 and rows[0]["detail"] == "denominator is zero" and rows[1]["detail"] == "missing KM1.6,KM1.2"


def test_basis_rules(spark):
    ops, tol = config.identity_operands(spark), config.load_tolerances()
    off = {"KM1.1": {"ecl_basis": "FULLY_LOADED"}}
    full = values(spark, {"KM1.1": "10000", "KM1.4": "100000", "KM1.5": "10"}, **off)
    assert R.ratio_identity(full, ops, tol).filter("check_id like '%/0'").first()["outcome"] == "ERROR"
    part = values(spark, {"KM1.1": "10000", "KM1.4": "100000"}, **off)
    assert R.ratio_identity(part, ops, tol).filter("check_id like '%/0'").first()["outcome"] == "SKIP"
    foot = values(spark, {"OV1.29": "10", "OV1.1": "1"}, "OV1", **{"OV1.1": {"floor_basis": "PRE_FLOOR"}})
    assert R.cross_foot(foot, ops, tol).first()["outcome"] == "ERROR"
    with pytest.raises(BasisError, match="barclays 2025Q4 KM1"):
        reconcile_values(spark, full)
    got = results(spark, full, "quarantine")
    assert got["KM1.1"]["status"] == "FLAGGED" and got["KM1.1"]["confidence"] == 0


@pytest.mark.parametrize("total, outcome", [("243000", "PASS"), ("242757.24", "FAIL"), ("242757.25", "PASS"), ("243243.243", "PASS"), ("243243.244", "FAIL")])
def test_cross_foot(spark, total, outcome):
    """The tolerance is a thousandth of the total as stated."""
    figures = {"OV1.1": "171000", "OV1.6": "18500", "OV1.15": "90", "OV1.16": "4400", "OV1.20": "12700", "OV1.23": "36310", "OV1.29": total}
    row = R.cross_foot(values(spark, figures, "OV1"), config.identity_operands(spark), config.load_tolerances()).first()
    assert row["outcome"] == outcome and row["expected"] == 243000


@pytest.mark.parametrize("other, outcome", [("100050", "PASS"), ("100050.000001", "FAIL"), ("99950", "PASS")])
def test_two_engine(spark, other, outcome):
    vals = values(spark, {"KM1.4": "100000"}, second={"KM1.4": other})
    assert R.two_engine(vals, config.load_tolerances()).first()["outcome"] == outcome


def test_two_engine_agreement_alone_accepts(spark):
    got = results(spark, values(spark, {"KM1.15": "301000"}, second={"KM1.15": "301000"}))["KM1.15"]
    assert got["status"] == "AUTO_PASSED" and got["confidence"] == 1 and got["validation_basis"] == ["TWO_ENGINE"]


def test_two_skips_flag_and_unchecked_weight(spark):
    got = results(spark, values(spark, {k: v for k, v in KM1.items() if k not in ("KM1.7", "KM1.3")}))
    assert got["KM1.4"]["confidence"] == D("0.9409") and got["KM1.4"]["status"] == "FLAGGED"
    alone = results(spark, values(spark, {"KM1.15": "301000"}))["KM1.15"]
    assert alone["confidence"] == D("0.9") and alone["status"] == "FLAGGED" and alone["validation_basis"] == []


def test_fourth_power_of_skip_is_exact(spark):
    vals = values(spark, {"KM1.4": "100000"}, second={"KM1.4": "200000"})
    assert results(spark, vals)["KM1.4"]["confidence"] == D("0.4563365")


@pytest.mark.parametrize("value, outcome", [("10000", "PASS"), ("9999.999999", "FAIL"), ("100000000", "PASS"), ("100000000.000001", "FAIL")])
def test_magnitude_band(spark, value, outcome):
    assert R.magnitude_sanity(values(spark, {"KM1.4": value}), config.magnitude_bands(spark)).first()["outcome"] == outcome


def test_magnitude_vetoes(spark):
    small = {k: str(D(v) / 1000) if D(v) > 1000 else v for k, v in KM1.items()}
    got = results(spark, values(spark, small))
    assert got["KM1.1"]["confidence"] == 0 and got["KM1.1"]["status"] == "FLAGGED"
    assert got["KM1.1"]["checks"][0]["outcome"] == "PASS" and got["KM1.5"]["status"] == "AUTO_PASSED"


def test_line(spark):
    line = format_results(reconcile_values(spark, values(spark, KM1))).filter("field_code = 'KM1.5'").first()["line"]
    assert line == "KM1.5 Common Equity Tier 1 ratio (%) = 15.1% [ecl=NA floor=FINAL] | RATIO_IDENTITY PASS, TWO_ENGINE SKIP, MAGNITUDE_SANITY PASS | page 1 bbox(1,2,3,4) | map=RULE | AUTO_PASSED"

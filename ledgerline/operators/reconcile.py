"""Checks, confidence and routing of whole corpora of filings at once.

Checks are one relation: (filing, check_id, check_type, outcome, field_codes,
expected, actual, tolerance, detail). Identities are evaluated by
cross-multiplication, so no quotient is ever rounded before it is judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import BasisError
from ..functions.numbers import let
from ..plans import schema as S
from ..sources.config import AUTO_ACCEPT, Tolerances, Weights

_CHECK = ["check_id", "check_type", "outcome", "field_codes", "expected", "actual", "tolerance", "detail"]
#: Order of check types in a field's list of checks.
ORDER = {"RATIO_IDENTITY": 0, "CROSS_FOOT": 1, "TWO_ENGINE": 2, "MAGNITUDE_SANITY": 3}


def _dec(x: object, kind: str = S.COMPUTE) -> Column:
    return F.lit(str(x)).cast(kind)


def _check(check_id: Column, kind: str, outcome: Column, codes: Column, expected: Column, actual: Column, tolerance: Column, detail: Column) -> Column:
    """One check as a struct whose order is that of a field's list of checks."""
    figures = [c.cast(S.WIDE).alias(n) for n, c in (("expected", expected), ("actual", actual), ("tolerance", tolerance))]
    return F.struct(F.lit(ORDER[kind]).alias("ord"), check_id.alias("check_id"), F.lit(kind).alias("check_type"), outcome.alias("outcome"), codes.alias("field_codes"), *figures, detail.alias("detail"))


def _identities(operands: DataFrame) -> DataFrame:
    """(template, __identities): each template's identities with their operands in order. A few rows of configuration."""
    rank = F.when(F.col("role").isin("ratio", "total"), 0).when(F.col("role").isin("numerator", "components"), 1).otherwise(2)
    one = operands.coalesce(1).groupBy("template", "identity", "kind").agg(F.max("factor").alias("factor"), F.array_sort(F.collect_list(F.struct(rank.alias("o"), "operand_ord", "code", "role", "ecl", "floor"))).alias("operands"))
    return one.groupBy("template").agg(F.array_sort(F.collect_list(F.struct("identity", "kind", "factor", "operands"))).alias("__identities"))


def _figures(identity: Column, have: Column) -> Column:
    """An identity's operands with their figures (``value`` null: missing) and
    whether a present one is on another basis. Of repeated codes the largest figure counts."""

    def figure(o: Column, found: Column) -> Column:
        off = found["value"].isNotNull() & ((found["ecl_basis"] != o["ecl"]) | (found["floor_basis"] != o["floor"]))
        return F.struct(o["code"].alias("code"), o["role"].alias("role"), found["value"].alias("value"), F.coalesce(off, F.lit(False)).alias("off"))

    largest = lambda o: F.array_max(F.filter(have, lambda h: h["code"] == o["code"]))
    return F.transform(identity["operands"], lambda o: let(largest(o), lambda found: figure(o, found)))


def _have(rows: Column) -> Column:
    """What identities need of a filing's field values."""
    return F.transform(rows, lambda v: F.struct(v["field_code"].alias("code"), v["value"].alias("value"), v["ecl_basis"].alias("ecl_basis"), v["floor_basis"].alias("floor_basis")))


def _codes(ops: Column) -> Column:
    return F.transform(ops, lambda x: x["code"])


def _missing(ops: Column) -> Column:
    return F.filter(ops, lambda x: x["value"].isNull())


def _absent(ops: Column) -> Column:
    return F.concat(F.lit("missing "), F.array_join(_codes(_missing(ops)), ","))


def _off(ops: Column) -> Column:
    return F.exists(ops, lambda x: x["off"])


def _role(ops: Column, role: str) -> Column:
    return F.get(F.filter(ops, lambda x: x["role"] == role), F.lit(0))["value"]


def _judge_ratio(identity: Column, ops: Column, tolerances: Tolerances) -> Column:
    tol, k = _dec(tolerances.ratio_bp / 100), identity["factor"]
    wide = lambda c: c.cast("decimal(38,12)")  # noqa: E731  products of two compute decimals, exact

    def judge(x: Column) -> Column:
        r, n, d, none, off = x["r"], x["n"], x["d"], x["none"], x["off"]
        fits = F.abs(wide(r * d) - wide(n * k)) <= wide(tol * F.abs(d))
        outcome = F.when(none, "SKIP").when(off, "ERROR").when(d == 0, "SKIP").when(fits, "PASS").otherwise("FAIL")
        detail = F.when(none, _absent(ops)).when(off, F.lit("operand on another basis")).when(d == 0, F.lit("denominator is zero")).otherwise(F.lit(""))
        quotient = F.try_divide(n.cast("decimal(20,6)") * k.cast("decimal(10,0)"), d.cast("decimal(18,6)"))
        fired = lambda o, c: F.when(o.isin("PASS", "FAIL"), c)
        return let(outcome, lambda o: _check(identity["identity"], "RATIO_IDENTITY", o, _codes(ops), fired(o, quotient), fired(o, r), tol, detail))

    return let(F.struct(_role(ops, "ratio").alias("r"), _role(ops, "numerator").alias("n"), _role(ops, "denominator").alias("d"), (F.size(_missing(ops)) > 0).alias("none"), _off(ops).alias("off")), judge)


def _judge_foot(identity: Column, ops: Column, tolerances: Tolerances) -> Column:
    sum_ = F.aggregate(F.filter(ops, lambda x: x["role"] == "components"), F.lit(0).cast("decimal(28,6)"), lambda a, x: (a + F.coalesce(x["value"], F.lit(0).cast(S.COMPUTE))).cast("decimal(28,6)"))

    def judge(x: Column) -> Column:
        s, t, none, off = x["s"], x["t"], x["none"], x["off"]
        tol = F.greatest(_dec(tolerances.foot_abs, "decimal(38,12)"), (_dec(tolerances.foot_rel) * F.abs(t)).cast("decimal(38,12)"))
        outcome = F.when(off, "ERROR").when(none, "SKIP").when(F.abs(s - t) <= tol, "PASS").otherwise("FAIL")
        detail = F.when(off, F.lit("operand on another basis")).when(none, _absent(ops)).otherwise(F.lit(""))
        fired = lambda o, c: F.when(o.isin("PASS", "FAIL"), c)
        return let(outcome, lambda o: _check(identity["identity"], "CROSS_FOOT", o, _codes(ops), fired(o, s), fired(o, t), fired(o, tol), detail))

    return let(F.struct(sum_.alias("s"), _role(ops, "total").alias("t"), (F.size(_missing(ops)) > 0).alias("none"), _off(ops).alias("off")), judge)


def _identity_checks(identities: Column, have: Column, tolerances: Tolerances) -> Column:
    """The identity checks of one filing."""
    judge = lambda i, ops: F.when(i["kind"] == "RATIO_IDENTITY", _judge_ratio(i, ops, tolerances)).otherwise(_judge_foot(i, ops, tolerances))
    return F.transform(identities, lambda i: let(_figures(i, have), lambda ops: judge(i, ops)))


def _identity_rows(values: DataFrame, operands: DataFrame, tolerances: Tolerances) -> DataFrame:
    filings = values.groupBy(*S.FILING).agg(F.collect_list(F.struct("field_code", "value", "ecl_basis", "floor_basis")).alias("__f"))
    judged = filings.join(F.broadcast(_identities(operands)), "template").withColumn("__checks", _identity_checks(F.col("__identities"), _have(F.col("__f")), tolerances))
    return judged.select(*S.FILING, F.explode("__checks").alias("c")).select(*S.FILING, *[F.col(f"c.{c}").alias(c) for c in _CHECK])


def ratio_identity(values: DataFrame, operands: DataFrame, tolerances: Tolerances) -> DataFrame:
    """|ratio - numerator / denominator * factor| within the tolerance, limits included.

    SKIP if an operand is missing or the denominator is zero; a present
    operand on another basis is an ERROR, but only if none is missing.
    """
    return _identity_rows(values, operands.filter("kind = 'RATIO_IDENTITY'"), tolerances)


def cross_foot(values: DataFrame, operands: DataFrame, tolerances: Tolerances) -> DataFrame:
    """|sum of components - total| within max(abs, rel * |total|), limits included.

    A present operand on another basis is an ERROR even if others are missing.
    """
    return _identity_rows(values, operands.filter("kind = 'CROSS_FOOT'"), tolerances)


def _judge_engines(tolerances: Tolerances) -> Column:
    """The check of a field value's row against its other engines."""
    value, code = F.col("value"), F.col("field_code")
    others = F.filter(F.map_entries("engine_values"), lambda e: e["key"] != F.col("engine"))
    tol = F.greatest(_dec(tolerances.engine_abs, "decimal(38,12)"), (_dec(tolerances.engine_rel) * F.abs(value)).cast("decimal(38,12)"))

    def judge(x: Column) -> Column:
        agree = F.forall(x, lambda e: F.abs(e["value"] - value) <= tol)
        none = F.size(x) == 0
        worst = F.array_max(F.transform(x, lambda e: F.struct(F.abs(e["value"] - value).alias("gap"), e["value"].alias("value"))))["value"]
        outcome = F.when(none, "SKIP").when(agree, "PASS").otherwise("FAIL")
        detail = F.when(none, F.lit("one engine only")).otherwise(F.array_join(F.array_sort(F.transform(x, lambda e: F.concat(e["key"], F.lit("="), S.plain_number(e["value"])))), ","))
        return _check(F.concat(F.lit("TWO_ENGINE/"), code), "TWO_ENGINE", outcome, F.array(code), value, worst, F.when(~none, tol), detail)

    return let(others, judge)


def two_engine(values: DataFrame, tolerances: Tolerances) -> DataFrame:
    """All other engines within max(abs, rel * |value|) of the primary; SKIP if there is none."""
    rows = values.select(*S.FILING, _judge_engines(tolerances).alias("c"))
    return rows.select(*S.FILING, *[F.col(f"c.{c}").alias(c) for c in _CHECK])


def unit_class(unit: Column) -> Column:
    return F.when(unit.isin(S.MONETARY_UNITS), "monetary").when(unit == "PERCENT", "percent").when(unit == "RATIO", "ratio")


def _with_band(values: DataFrame, bands: DataFrame) -> DataFrame:
    bands = bands.select("template", "unit_class", F.col("low").alias("__low"), F.col("high").alias("__high"))
    return values.withColumn("unit_class", unit_class(F.col("unit"))).join(F.broadcast(bands), ["template", "unit_class"], "left")


def _judge_magnitude() -> Column:
    value, code, low, high = F.col("value"), F.col("field_code"), F.col("__low"), F.col("__high")
    outcome = F.when(low.isNull(), "SKIP").when(value.between(low, high), "PASS").otherwise("FAIL")
    detail = F.when(low.isNull(), F.lit("no band")).otherwise(F.concat(F.lit("band "), S.plain_number(low), F.lit(" to "), S.plain_number(high)))
    return _check(F.concat(F.lit("MAGNITUDE_SANITY/"), code), "MAGNITUDE_SANITY", outcome, F.array(code), F.lit(None), value, F.lit(None), detail)


def magnitude_sanity(values: DataFrame, bands: DataFrame) -> DataFrame:
    """Value within its unit class's band, limits included; SKIP if there is no band."""
    rows = _with_band(values, bands).select(*S.FILING, _judge_magnitude().alias("c"))
    return rows.select(*S.FILING, *[F.col(f"c.{c}").alias(c) for c in _CHECK])


def _require_basis(identities: DataFrame) -> None:
    S.require(identities, F.col("outcome") == "ERROR", BasisError, F.concat_ws(" ", "bank", "period", "check_id", "detail"))


def confidence(outcomes: Column, weights: Weights) -> Column:
    """Product of the weights of (check_type, outcome) pairs, within [0, 1];
    without a PASS or FAIL the unchecked weight. Magnitude is left out here."""
    kind = "decimal(38,12)"
    counted = F.filter(outcomes, lambda c: c["check_type"] != "MAGNITUDE_SANITY")
    fail = lambda t: F.when(t == "RATIO_IDENTITY", _dec(weights.ratio_identity_fail, kind)).when(t == "CROSS_FOOT", _dec(weights.cross_foot_fail, kind)).otherwise(_dec(weights.two_engine_fail, kind))
    weight = lambda c: F.when(c["outcome"] == "PASS", _dec(weights.passed, kind)).when(c["outcome"] == "SKIP", _dec(weights.skip, kind)).otherwise(fail(c["check_type"]))
    narrow = lambda x: x.cast("decimal(18,12)")
    product = F.aggregate(counted, narrow(F.lit("1").cast(kind)), lambda a, c: narrow(a * narrow(weight(c))))
    fired = F.exists(counted, lambda c: c["outcome"] != "SKIP")
    return F.when(fired, F.greatest(_dec(0, kind), F.least(_dec(1, kind), product.cast(kind)))).otherwise(_dec(weights.unchecked, kind))


def _score(joined: DataFrame, columns: list[str], weights: Weights, threshold) -> DataFrame:
    """Values with ``checks``, ``confidence``, ``validation_basis`` and
    ``status``, from each field's list of checks ``__c``.

    AUTO_PASSED: confident enough, nothing failed, and some check passed. A
    magnitude failure vetoes. A basis error in quarantine flags its fields.
    """
    error = F.exists("__c", lambda c: c["outcome"] == "ERROR")
    insane = F.exists("__c", lambda c: (c["check_type"] == "MAGNITUDE_SANITY") & (c["outcome"] == "FAIL"))
    failed = F.exists("__c", lambda c: c["outcome"] == "FAIL")
    basis = F.array_distinct(F.transform(F.filter("__c", lambda c: c["outcome"].isin("PASS", "FAIL") & (c["check_type"] != "MAGNITUDE_SANITY")), lambda c: c["check_type"]))
    conf = F.when(error, _dec(0, "decimal(38,12)")).when(insane, F.least(confidence(F.col("__c"), weights), _dec(weights.magnitude_sanity_fail, "decimal(38,12)"))).otherwise(confidence(F.col("__c"), weights))
    scored = joined.withColumns({"confidence": conf, "validation_basis": basis, "__bad": failed | error})
    passed = (F.col("confidence") >= _dec(threshold, "decimal(38,12)")) & ~F.col("__bad") & (F.size("validation_basis") > 0)
    checks_out = F.transform("__c", lambda c: F.struct(*[c[f].alias(f) for f in ("check_type", "outcome", "field_codes", "expected", "actual", "tolerance", "detail")]))
    return scored.withColumn("status", F.when(passed, "AUTO_PASSED").otherwise("FLAGGED")).withColumn("checks", checks_out).select(*columns, "checks", "confidence", "validation_basis", "status")


def reconcile(values: DataFrame, operands: DataFrame, bands: DataFrame, tolerances: Tolerances, weights: Weights, on_basis_error: str = "raise", threshold=AUTO_ACCEPT) -> DataFrame:
    """Checks and routing in one grouping.

    A filing has no more rows than its template has fields, so each filing is
    gathered once, checked as one row and taken apart again: values are read
    once and shuffled once, and configuration is all that is joined. Only
    ``on_basis_error='raise'`` reads the values a second time, to raise before
    anything is returned.
    """
    if on_basis_error not in ("raise", "quarantine"):
        raise ValueError(f"on_basis_error: {on_basis_error}")
    if on_basis_error == "raise":
        _require_basis(_identity_rows(values, operands, tolerances))
    own = F.array(_judge_engines(tolerances), _judge_magnitude()).alias("__own")
    rest = [c for c in values.columns if c not in S.FILING]
    marked = _with_band(values, bands).select(*S.FILING, *rest, own)
    filings = marked.groupBy(*S.FILING).agg(F.collect_list(F.struct(*rest, "__own")).alias("__f")).join(F.broadcast(_identities(operands)), "template", "left")
    none = F.array().cast(f"array<struct<ord:int,check_id:string,check_type:string,outcome:string,field_codes:array<string>,expected:{S.WIDE},actual:{S.WIDE},tolerance:{S.WIDE},detail:string>>")
    checks = F.coalesce(_identity_checks(F.col("__identities"), _have(F.col("__f")), tolerances), none)
    checked = filings.withColumn("__checks", checks)  # before the explode, whose analysis strips names inside structs
    fields = checked.select(*S.FILING, "__checks", F.explode("__f").alias("__v"))
    mine = F.array_sort(F.concat(F.filter("__checks", lambda c: F.array_contains(c["field_codes"], F.col("__v.field_code"))), F.col("__v.__own")))
    joined = fields.select(*S.FILING, *[F.col(f"__v.{c}").alias(c) for c in rest], mine.alias("__c"))
    return _score(joined, values.columns, weights, threshold)

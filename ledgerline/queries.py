"""Driver queries: the library's operators over the TPC-H-like tables, which
are first projected into its relations, and the same results in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import labels, numbers, periods
from .operators import analytics, golden, mapping, reconcile
from .plans import pipeline
from .plans import schema as S
from .sources import cells as shapes
from .sources import config, files, registry, review, store, structured

Query = Callable[[SparkSession, str], DataFrame]
CODES = ["KM1.1", "KM1.2", "KM1.4", "KM1.5", "KM1.6"]
_ALIAS = {c: next(f["aliases"][0] for f in config.load_template("KM1") if f["code"] == c) for c in CODES}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _double(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare whatever the scale."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else f.name for f in df.schema.fields])


# ---- projections ------------------------------------------------------------

def _orders(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = _t(spark, sf, "orders"), _t(spark, sf, "customer"), _t(spark, sf, "nation")
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint")
    # The customer side has no bound: Spark broadcasts it only below its size threshold.
    placed = o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return placed.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("cents", cents)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation and year: v1, v2, v4 money, v5, v6 disclosed ratios (v6 sometimes missing), e4 another engine's v4."""
    year = F.year("o_orderdate")
    some = lambda *s: F.sum(F.when(F.col("o_orderstatus").isin(*s), F.col("cents")).otherwise(0))
    g = _orders(spark, sf).groupBy("n_nationkey", "n_name", year.alias("y")).agg(some("F").alias("c1"), some("F", "O").alias("c2"), F.sum("cents").alias("c4"))
    money = lambda c: (F.col(c).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(S.COMPUTE)
    ratio = lambda c: ((F.expr(f"{c} * 1000 div c4") + F.when(F.col("n_nationkey") % 5 == 0, 15).otherwise(0)).cast("decimal(12,0)") * F.lit("0.1").cast("decimal(2,1)")).cast(S.COMPUTE)
    e4 = F.when(F.col("n_nationkey") % 7 == 0, money("c4") + 100000).when(F.col("n_nationkey") % 11 != 0, money("c4"))
    return g.select(F.trim("n_name").alias("bank"), F.concat(F.col("y").cast("string"), F.lit("FY")).alias("period"), "n_nationkey", "y", money("c1").alias("v1"), money("c2").alias("v2"), money("c4").alias("v4"), ratio("c1").alias("v5"), F.when(F.col("n_nationkey") % 7 != 3, ratio("c2")).alias("v6"), e4.cast(S.COMPUTE).alias("e4"))


_WIDE = """o AS (SELECT n_nationkey, trim(n_name) AS bank, year(o_orderdate) AS y, o_orderstatus AS s, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT n_nationkey, bank, y, CAST(sum(CASE WHEN s = 'F' THEN cents ELSE 0 END) AS BIGINT) AS c1, CAST(sum(CASE WHEN s IN ('F', 'O') THEN cents ELSE 0 END) AS BIGINT) AS c2, CAST(sum(cents) AS BIGINT) AS c4 FROM o GROUP BY ALL),
w AS (SELECT bank, y || 'FY' AS period, n_nationkey AS k, c1, c2, c4, c1 * 1000 // c4 + CASE WHEN n_nationkey % 5 = 0 THEN 15 ELSE 0 END AS r5,
  CASE WHEN n_nationkey % 7 <> 3 THEN c2 * 1000 // c4 + CASE WHEN n_nationkey % 5 = 0 THEN 15 ELSE 0 END END AS r6,
  CASE WHEN n_nationkey % 7 = 0 THEN c4 + 10000000 WHEN n_nationkey % 11 <> 0 THEN c4 END AS e4 FROM g)"""
# r5, r6 are tenths of a percent, money is in cents: |r/10 * c4 - c * 100| <= 0.1 * c4, all times 10.
_CHECKS = f"""{_WIDE},
k AS (SELECT *, CASE WHEN abs(r5 * c4 - c1 * 1000) <= c4 THEN 'PASS' ELSE 'FAIL' END AS i5, CASE WHEN r6 IS NULL THEN 'SKIP' WHEN abs(r6 * c4 - c2 * 1000) <= c4 THEN 'PASS' ELSE 'FAIL' END AS i6,
  CASE WHEN e4 IS NULL THEN 'SKIP' WHEN abs(e4 - c4) <= greatest(100, 0.0005 * c4) THEN 'PASS' ELSE 'FAIL' END AS te FROM w),
f AS (
  SELECT bank, period, 'KM1.1' AS field_code, c1 AS v, 100 AS unit, [i5, 'SKIP'] AS o, 'SKIP' AS te FROM k UNION ALL SELECT bank, period, 'KM1.2', c2, 100, [i6, 'SKIP'], 'SKIP' FROM k
  UNION ALL SELECT bank, period, 'KM1.4', c4, 100, [i5, i6, 'SKIP', CASE WHEN te = 'FAIL' THEN 'HALF' ELSE te END], te FROM k UNION ALL SELECT bank, period, 'KM1.5', r5, 10, [i5, 'SKIP'], 'SKIP' FROM k
  UNION ALL SELECT bank, period, 'KM1.6', r6, 10, [i6, 'SKIP'], 'SKIP' FROM k WHERE r6 IS NOT NULL
),
m AS (SELECT *, CASE WHEN unit = 100 THEN v BETWEEN 1000000 AND 10000000000 ELSE v BETWEEN 0 AND 10000 END AS sane,
  len(list_filter(o, lambda x: x = 'SKIP')) AS n_skip, len(list_filter(o, lambda x: x = 'FAIL')) AS n_fail, len(list_filter(o, lambda x: x = 'HALF')) AS n_half, len(o) AS n FROM f),
c AS (SELECT *, CASE WHEN NOT sane THEN 0 WHEN n_skip = n THEN 0.9 WHEN n_fail > 0 THEN 0 ELSE
  (CASE n_skip WHEN 0 THEN 1.0 WHEN 1 THEN 0.97 WHEN 2 THEN 0.9409 WHEN 3 THEN 0.912673 ELSE 0.88529281 END) * (CASE WHEN n_half > 0 THEN 0.5 ELSE 1.0 END) END AS conf FROM m),
routed AS (SELECT bank, period, field_code, CAST(v AS DOUBLE) / unit AS value, CAST(conf AS DOUBLE) AS confidence, CASE WHEN conf >= 0.95 AND n_fail + n_half = 0 AND sane AND n_skip < n THEN 'AUTO_PASSED' ELSE 'FLAGGED' END AS status FROM c)"""


def _values(spark: SparkSession, sf: str) -> DataFrame:
    """The wide filings as field values."""
    w = _wide(spark, sf)
    spec = {f["code"]: f for f in config.load_template("KM1")}
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field_code"), F.col(f"v{c[-1]}").alias("value"), F.lit("USD_M" if spec[c]["kind"] == "MONETARY" else "PERCENT").alias("unit"), F.lit(spec[c]["ecl"]).alias("ecl_basis"), F.lit(spec[c]["floor"]).alias("floor_basis")) for c in CODES])).alias("c")
    rows = w.select("bank", "period", "e4", cells).select("bank", "period", "e4", "c.*").filter("value is not null")
    both = (F.col("field_code") == "KM1.4") & F.col("e4").isNotNull()
    engines = F.when(both, F.create_map(F.lit("DOCLING"), F.col("value"), F.lit("CAMELOT"), F.col("e4"))).otherwise(F.create_map(F.lit("DOCLING"), F.col("value")))
    fixed = {"template": "KM1", "engine": "DOCLING", "source_kind": "PDF", "source_url": "x", "monetary_scale": "millions"}
    full = rows.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumns({"doc_id": F.concat_ws("/", "bank", "period"), "bbox": F.lit(None), "mapping": F.lit(None), "raw_text": F.col("value").cast("string"), "engine_values": engines})
    return full.select(*[F.col(f.name).cast(f.dataType) for f in S.FIELD_VALUES.fields])


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.reconcile_values(spark, _values(spark, sf), "quarantine")


def _filings(spark: SparkSession, sf: str) -> DataFrame:
    """Store-like rows: total per nation and quarter."""
    q = F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    g = _orders(spark, sf).groupBy(F.trim("n_name").alias("bank"), "n_nationkey", q.alias("period")).agg(F.sum("cents").alias("cents"))
    value = (F.col("cents").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(S.STORED)
    status = F.when(F.col("n_nationkey") % 6 == 0, "FLAGGED").when(F.col("n_nationkey") % 6 == 1, "HUMAN_CONFIRMED").otherwise("AUTO_PASSED")
    return g.select("bank", "period", F.lit("KM1.4").alias("field"), value.alias("value"), F.lit("USD_M").alias("unit"), status.alias("status"), F.lit("t").alias("extracted_at"), F.lit("r").alias("run_id"))


_FILINGS = """o AS (SELECT trim(n_name) AS bank, n_nationkey AS k, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT bank, period, 'KM1.4' AS field, CAST(sum(cents) AS BIGINT) AS cents, CASE k % 6 WHEN 0 THEN 'FLAGGED' WHEN 1 THEN 'HUMAN_CONFIRMED' ELSE 'AUTO_PASSED' END AS status FROM o GROUP BY bank, k, period)"""


# ---- queries ----------------------------------------------------------------

def reconcile_route(spark, sf):
    return _double(_routed(spark, sf).select("bank", "period", "field_code", "value", "confidence", "status"))


def ratio_identity(spark, sf):
    rows = reconcile.ratio_identity(_values(spark, sf), config.identity_operands(spark), config.load_tolerances())
    return rows.select("bank", "period", "check_id", "outcome", F.size("field_codes").alias("n_fields"))


def cross_foot(spark, sf):
    """Order totals of a year by priority against the year's total, misstated in odd years."""
    parts = dict(zip(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["OV1.1", "OV1.6", "OV1.15", "OV1.16", "OV1.20"]))
    code = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("o_orderpriority"))
    year = F.year("o_orderdate").cast("string")
    o = _t(spark, sf, "orders").select(F.concat(year, F.lit("FY")).alias("period"), code.alias("field_code"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"), (F.year("o_orderdate") % 2).alias("odd"))
    comps = o.groupBy("period", "field_code").agg(F.sum("p").cast(S.COMPUTE).alias("value"))
    total = o.groupBy("period", "odd").agg(F.sum("p").cast("decimal(18,2)").alias("t")).select("period", F.lit("OV1.29").alias("field_code"), (F.col("t") + F.when(F.col("odd") == 1, (F.col("t") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")).otherwise(F.lit("0.50").cast("decimal(3,2)"))).cast(S.COMPUTE).alias("value"))
    nil = o.select("period").distinct().select("period", F.lit("OV1.23").alias("field_code"), F.lit(0).cast(S.COMPUTE).alias("value"))
    rows = comps.unionByName(total).unionByName(nil)
    vals = rows.select(F.lit("all").alias("bank"), "period", F.lit("OV1").alias("template"), F.col("period").alias("doc_id"), "field_code", "value", F.lit("NA").alias("ecl_basis"), F.lit("FINAL").alias("floor_basis"))
    return reconcile.cross_foot(vals, config.identity_operands(spark), config.load_tolerances()).select("period", "outcome", F.col("expected").cast("double").alias("expected"), F.round(F.col("actual").cast("double"), 2).alias("actual"))


def two_engine(spark, sf):
    return reconcile.two_engine(_values(spark, sf), config.load_tolerances()).filter("check_id = 'TWO_ENGINE/KM1.4'").select("bank", "period", "outcome")


def magnitude_sanity(spark, sf):
    return reconcile.magnitude_sanity(_values(spark, sf), config.magnitude_bands(spark)).select("bank", "period", "check_id", "outcome")


def confidence_product(spark, sf):
    return _double(_routed(spark, sf).groupBy("confidence", "status").agg(F.count(F.lit(1)).alias("n")))


def peer_compare(spark, sf):
    return _double(analytics.peer_compare(_filings(spark, sf), "KM1.4", "1995Q1").select("bank", "value", "rank"))


def trend_delta(spark, sf):
    return _double(analytics.trend(_filings(spark, sf), None, "KM1.4").select("bank", "period", "value", "delta", "period_ord"))


def _golden(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderstatus").alias("bank"), F.concat(F.year("o_orderdate").cast("string"), F.lit("FY")).alias("period"), F.lit("KM1").alias("template"), F.col("o_orderkey").cast("string").alias("field_code"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"), "o_orderkey")
    truth = o.filter("o_orderkey % 13 <> 0").select("bank", "period", "template", "field_code", F.col("p").cast(S.COMPUTE).alias("golden"))
    read = o.filter("o_orderkey % 11 <> 0").select("bank", "period", "template", "field_code", (F.col("p") + F.when(F.col("o_orderkey") % 7 == 0, F.lit("0.01").cast("decimal(3,2)")).otherwise(F.lit("0.00").cast("decimal(3,2)"))).cast(S.COMPUTE).alias("value"), F.when(F.col("o_orderkey") % 2 == 0, "DOCLING").otherwise("CAMELOT").alias("engine"))
    return truth, read


_GOLDEN = """o AS (SELECT o_orderstatus AS bank, year(o_orderdate) || 'FY' AS period, CAST(o_orderkey AS VARCHAR) AS field_code, o_orderkey AS k,
  CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'EXTRA' WHEN o_orderkey % 11 = 0 THEN 'MISSING' WHEN o_orderkey % 7 = 0 THEN 'MISMATCH' ELSE 'CORRECT' END AS outcome FROM orders)"""


def golden_compare(spark, sf):
    return golden.compare(*_golden(spark, sf)).select("bank", "period", "field_code", "outcome")


def golden_accuracy(spark, sf):
    return _double(golden.accuracy(golden.compare(*_golden(spark, sf))).select("bank", "period", "n_correct", "n_mismatch", "n_missing", "n_extra"))


def exact_match_score(spark, sf):
    truth, read = _golden(spark, sf)
    return golden.exact_match(read, truth, "period").select("period", "matches", "n")


def bootstrap_interval(spark, sf):
    truth, read = _golden(spark, sf)
    r = golden.exact_match(read, truth, "template").first()
    low, high = golden.bootstrap_ci(r["matches"], r["n"])
    return spark.createDataFrame([(low, high)], "low double, high double")


def registry_dedupe(spark, sf):
    docs = _t(spark, sf, "documents")
    incoming = docs.select(F.col("text").cast("binary").alias("content"), F.col("source").alias("bank_id"), F.lit("2025Q4").alias("period"), F.lit(None).cast("string").alias("template"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"), F.lit("PDF").alias("source_kind"))
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in registry.MANIFEST))
    return registry.register(none, incoming, "/store", "t").select("bank_id", "url", "sha256", "local_path", "status")


def _rendered(spark, sf, style: str):
    text = F.format_number("l_extendedprice", 2)
    return F.translate(text, ",.", style)


def _lines(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_suppkey")


def normalise_en(spark, sf):
    cells = _lines(spark, sf).withColumn("raw", F.format_number("l_extendedprice", 2))
    raw = F.when(F.col("l_linenumber") % 4 == 1, F.concat(F.lit("("), F.col("raw"), F.lit(")"))).when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit("£"), F.col("raw"), F.lit("¹"))).when(F.col("l_linenumber") % 4 == 3, F.concat(F.lit(" USD "), F.col("raw"), F.lit("* "))).otherwise(F.col("raw"))
    parsed = numbers.parse_decimal(cells, "p", raw, F.lit("en_GB"))
    return _double(parsed.select("l_orderkey", "l_linenumber", F.col("p.value").alias("value"), F.col("p.error").alias("error")))


def normalise_locales(spark, sf):
    cells = _lines(spark, sf).withColumn("loc", F.element_at(F.array(F.lit("en_US"), F.lit("de_DE"), F.lit("fr_FR")), (F.col("l_suppkey") % 3 + 1).cast("int")))
    raw = F.when(F.col("loc") == "en_US", F.format_number("l_extendedprice", 2)).when(F.col("loc") == "de_DE", _rendered(spark, sf, ".,")).otherwise(_rendered(spark, sf, " ,"))
    parsed = numbers.parse_decimal(cells, "p", raw, F.col("loc"))
    return _double(parsed.select("l_orderkey", "l_linenumber", "loc", F.col("p.value").alias("value"), F.col("p.error").alias("error")))


def normalise_reject_reasons(spark, sf):
    bad = ["", "n/a", "1,2,3", "12,34", "1.2.3", "abc", "£", "7"]
    cells = _lines(spark, sf).withColumn("raw", F.element_at(F.array(*[F.lit(b) for b in bad]), (F.col("l_orderkey") % 8 + 1).cast("int")))
    parsed = numbers.parse_decimal(cells, "p", F.col("raw"), F.lit("en_GB"))
    return parsed.groupBy(F.coalesce("p.error", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def scale_lift(spark, sf):
    cells = _lines(spark, sf).withColumn("word", F.element_at(F.array(F.lit(""), F.lit("m"), F.lit(" bn"), F.lit("k")), (F.col("l_suppkey") % 4 + 1).cast("int")))
    raw = F.concat(F.format_number("l_extendedprice", 2), F.col("word"))
    parsed = numbers.normalise(cells, "p", raw, F.lit("en_US"), F.lit("USD_M"), F.lit("billions"))
    return parsed.select("l_orderkey", "l_linenumber", (F.col("p.value") * 100000).cast("bigint").alias("value_e5"), F.col("p.error").alias("error"))


def structured_ingest(spark, sf):
    o = _t(spark, sf, "orders")
    point = F.concat(F.lit("eba_dpm:km1.r00"), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("0"))
    value = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    rows = o.select(F.col("o_orderkey").cast("string").alias("doc_id"), point.alias("datapoint"), value.alias("value"))
    of = o.select(F.col("o_orderkey").cast("string").alias("doc_id"), F.lit("b").alias("bank"), F.lit("2025Q4").alias("period"), F.lit("EUR").alias("reporting_currency"), F.lit("x").alias("source_url"))
    out = structured.field_values(rows, config.datapoint_map(spark), config.template_fields(spark, "KM1"), of)
    return _double(out.select("doc_id", "field_code", "value", "unit"))


def _grids(spark, sf):
    """Two tables per filing: a decoy of two rows, and the template's rows."""
    w = _wide(spark, sf)
    text = lambda c: F.format_number(F.col(c).cast("double"), 2)
    row = lambda t, i, label, value: F.struct(F.lit(t).alias("t"), F.lit(i).alias("i"), label.alias("label"), value.alias("value"))
    rows = [row(0, 0, F.lit("Total capital"), F.lit("1")), row(0, 1, F.lit("Tier 1 capital"), F.lit("2"))]
    rows += [row(1, i, F.concat(F.lit(f"UK {i + 1}a "), F.lit(_ALIAS[c]), F.lit(" 1")), F.coalesce(text(f"v{c[-1]}"), F.lit("n/a"))) for i, c in enumerate(CODES)]
    flat = w.select(F.concat_ws("/", "bank", "period").alias("doc_id"), "bank", "period", F.explode(F.array(*rows)).alias("r"))
    cell = lambda j, text: F.struct(F.lit(j).alias("j"), text.alias("text"))
    cells = flat.select("doc_id", "r.t", "r.i", F.explode(F.array(cell(0, F.col("r.label")), cell(1, F.lit("–")), cell(2, F.col("r.value")))).alias("c"))
    box = F.struct(F.lit(1).alias("page"), *[F.lit(0.0).alias(x) for x in ("x0", "y0", "x1", "y1")])
    made = cells.select("doc_id", F.lit("DOCLING").alias("engine"), F.col("t").alias("table_idx"), F.col("i").alias("row_idx"), F.col("c.j").alias("col_idx"), "c.text", box.alias("bbox"), F.lit(None).alias("row_label"), F.lit(None).alias("col_label"))
    docs = w.select(F.concat_ws("/", "bank", "period").alias("doc_id"), "bank", "period", F.lit("KM1").alias("template"), F.lit("x").alias("source_url"), F.lit("en_GB").alias("number_locale"), F.lit("USD").alias("reporting_currency"), F.lit("millions").alias("monetary_scale"))
    return made.select(*[F.col(f.name).cast(f.dataType) for f in S.CELLS.fields]), docs


def classify_table(spark, sf):
    cells, docs = _grids(spark, sf)
    return mapping.classify(cells, config.template_fields(spark, "KM1"), docs).select("doc_id", "table_idx", "score")


def map_fields(spark, sf):
    cells, docs = _grids(spark, sf)
    return _double(mapping.map_fields(cells, config.template_fields(spark, "KM1"), docs)[0].select("doc_id", "field_code", "value", "unit"))


def map_all_tables(spark, sf):
    """The template's rows over two tables, as of reports that turn the page."""
    cells, docs = _grids(spark, sf)
    turned = cells.filter("table_idx = 1").withColumn("table_idx", F.when(F.col("row_idx") < 3, 1).otherwise(2))
    values = mapping.map_fields(turned.unionByName(cells.filter("table_idx = 0")), config.template_fields(spark, "KM1"), docs, tables="all")[0]
    return _double(values.select("doc_id", "field_code", "value", "unit"))


def unmatched_fields(spark, sf):
    cells, docs = _grids(spark, sf)
    return mapping.map_fields(cells, config.template_fields(spark, "KM1"), docs)[1].groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def merge_engines(spark, sf):
    first = _values(spark, sf).withColumn("engine_values", F.create_map("engine", "value"))
    w = _wide(spark, sf).filter("e4 is not null").select("bank", "period", "e4")
    second = first.filter("field_code = 'KM1.4'").join(w, ["bank", "period"]).withColumns({"engine": F.lit("CAMELOT"), "value": F.col("e4")}).select(*first.columns)
    merged = mapping.merge_engines(first, second)
    return _double(merged.select("bank", "period", "field_code", "value", F.col("engine_values")["CAMELOT"].alias("second")))


def engine_coverage(spark, sf):
    vals = _values(spark, sf)
    return mapping.coverage(vals.filter("field_code <> 'KM1.1'"), vals.filter("field_code <> 'KM1.4'")).groupBy("field_code", "only_in").agg(F.count(F.lit(1)).alias("n"))


def period_parse(spark, sf):
    o = _t(spark, sf, "orders")
    label = F.concat(F.year("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 4 == 0, "FY").when(F.col("o_orderkey") % 9 == 0, "Q7").otherwise(F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"))))
    return o.select(label.alias("period"), periods.is_period(label).alias("valid"), periods.period_ord(label).alias("ord")).groupBy("period", "valid", "ord").agg(F.count(F.lit(1)).alias("n"))


def period_candidates(spark, sf):
    text = F.concat(F.lit("Key metrics as at "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit("."))
    rows = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))
    return _double(periods.period_candidates(rows).select("doc_id", "period", "confidence"))


def label_normalise(spark, sf):
    p = _t(spark, sf, "part")
    raw = F.concat(F.lit("  "), (F.col("p_size")).cast("string"), F.lit("a.  "), F.upper("p_name"), F.lit("  "), (F.col("p_partkey") % 100).cast("string"))
    return labels.norm_label(p, "label", raw).select("p_partkey", "label")


def review_latest(spark, sf):
    items = _routed(spark, sf).filter("status = 'FLAGGED'").select(F.lit("r").alias("run_id"), "bank", "period", "field_code", S.plain_number(F.col("value")).alias("value"), "status", F.lit("").alias("note"))
    ev = _wide(spark, sf).select(F.lit("r").alias("run_id"), "bank", "period", F.lit("KM1.4").alias("field_code"), F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(v).cast("string").alias("corrected_value"), F.lit(t).alias("resolved_at")) for a, v, t in (("confirm", None, "1"), ("correct", "42.5", "2"))])).alias("e"), F.lit("seen").alias("note")).select("run_id", "bank", "period", "field_code", "e.*", "note")
    return review.resolved(items, ev).select("bank", "period", "field_code", F.col("value").cast("double").alias("value"), "status", "note")


def sweep_summary(spark, sf):
    return analytics.tallies(_routed(spark, sf)).select("bank", "n_auto_passed", "n_flagged")


def status_assertion(spark, sf):
    rows = _filings(spark, sf)
    analytics.assert_known_statuses(rows)
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status").isin(S.VALIDATED)).alias("n_validated"))


def store_rows(spark, sf):
    banks = _wide(spark, sf).select("bank").distinct().withColumn("jurisdiction", F.lit("US"))
    rows = store.to_stored(store.flatten(_routed(spark, sf), banks, "run", "t"))
    return _double(rows.select("bank", "period", "jurisdiction", "field", "value", "confidence", "status", F.array_join("validation_basis", ",").alias("basis")))


def newest_version(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("bank_id"), F.concat(F.lit("202"), (F.col("doc_id") % 5).cast("string"), F.lit("Q1")).alias("period"), F.col("lang").alias("template"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("fetched_at"), F.lit("x").alias("sha256"), F.lit("fetched").alias("status"))
    return pipeline.newest_version(d).select("bank_id", "period", "template", "fetched_at")


def event_windows(spark, sf):
    """The batch form of the stream's windowed activity."""
    from .streaming.ingest import windowed_activity

    rows = windowed_activity(_t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return rows.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


# ---- periods in varied phrases ----------------------------------------------

def _phrases(spark, sf):
    """A text per order, of eight kinds of phrase; years are moved into the resolver's range."""
    y, q = (F.year("o_orderdate") + 10).cast("string"), F.quarter("o_orderdate").cast("string")
    before = (F.year("o_orderdate") + 9).cast("string")
    kinds = [
        F.concat(F.lit("Results for Q"), q, F.lit(" "), y, F.lit(".")),
        F.concat(y, F.lit(" Q"), q, F.lit(" report")),
        F.concat(F.lit("the third quarter of "), y, F.lit(", Q4 "), y),
        F.concat(F.lit("FY"), y, F.lit(" and Q"), q, F.lit(" "), before),
        F.concat(F.lit("Key metrics as at 31st Dec. "), y),
        F.concat(F.lit("dated 30/06/"), y, F.lit(" or 15/06/"), y),
        F.concat(y, F.lit("-09-30 at 31 March "), y),
        F.concat(F.lit("no period on page "), y),
    ]
    text = F.element_at(F.array(*kinds), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return _t(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


def period_phrases(spark, sf):
    found = periods.period_candidates(_phrases(spark, sf))
    return _double(found.groupBy("period", "confidence").agg(F.count(F.lit(1)).alias("n")))


def resolve_latest(spark, sf):
    return _double(periods.resolve_latest(periods.period_candidates(_phrases(spark, sf))).select("doc_id", "period", "confidence"))


def resolve_quarter_end(spark, sf):
    return periods.resolve_latest(periods.period_candidates(_phrases(spark, sf)), "quarter_end").select("doc_id", "period")


def period_ambiguous(spark, sf):
    return periods.ambiguous(periods.period_candidates(_phrases(spark, sf))).groupBy("ambiguous").agg(F.count(F.lit(1)).alias("n"))


_PHRASES = """p AS (SELECT o_orderkey AS doc_id, o_orderkey % 8 AS k, year(o_orderdate) + 10 AS y, quarter(o_orderdate) AS q FROM orders),
found AS (
  SELECT doc_id, y, q, 0.70 AS confidence FROM p WHERE k IN (0, 1) UNION ALL SELECT doc_id, y, 3, 0.70 FROM p WHERE k = 2 UNION ALL SELECT doc_id, y, 4, 0.70 FROM p WHERE k = 2
  UNION ALL SELECT doc_id, y, NULL, 0.70 FROM p WHERE k = 3 UNION ALL SELECT doc_id, y - 1, q, 0.70 FROM p WHERE k = 3 UNION ALL SELECT doc_id, y, 4, 0.95 FROM p WHERE k = 4
  UNION ALL SELECT doc_id, y, 2, 0.55 FROM p WHERE k = 5 UNION ALL SELECT doc_id, y, 3, 0.55 FROM p WHERE k = 6 UNION ALL SELECT doc_id, y, 1, 0.70 FROM p WHERE k = 6
),
c AS (SELECT p.doc_id, CASE WHEN f.y IS NOT NULL THEN f.y || coalesce('Q' || f.q, 'FY') END AS period, f.y, f.q, CAST(f.confidence AS DOUBLE) AS confidence FROM p LEFT JOIN found f ON f.doc_id = p.doc_id)"""


# ---- mapping, in its finer rules --------------------------------------------

def first_wins(spark, sf):
    """Each figure twice, by rule and as picked by a mapper: the rule's stays."""
    base = _values(spark, sf)
    rule = lambda name: F.struct(F.lit(name).alias("method"), *[F.lit(None).cast("string").alias(c) for c in ("model", "prompt_sha", "prompt_version", "matched_alias")], F.lit(1.0).alias("confidence"))
    twice = base.withColumn("mapping", rule("LLM")).withColumn("value", (F.col("value") + 1).cast(S.COMPUTE)).unionByName(base.withColumn("mapping", rule("RULE")))
    kept, dropped = mapping.first_wins(twice)
    both = kept.select(F.lit("kept").alias("side"), "field_code", "value").unionByName(dropped.select(F.lit("dropped").alias("side"), "field_code", "value"))
    return both.groupBy("side", "field_code").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


def _fallback(spark, sf):
    cells, docs = _grids(spark, sf)
    fields = config.template_fields(spark, "KM1")
    return cells, docs, fields, mapping.map_fields(cells, fields, docs)[1]


def unused_rows(spark, sf):
    cells, _, fields, unmatched = _fallback(spark, sf)
    return mapping.unused_rows(cells, unmatched, fields).select("doc_id", "table_idx", "row_idx", "label_col")


def fallback_prompts(spark, sf):
    cells, _, fields, unmatched = _fallback(spark, sf)
    made = mapping.fallback_prompts(cells, unmatched, fields)
    return made.select("doc_id", F.size(F.split("prompt", "\n")).alias("n_lines"), (F.col("prompt_sha") == F.sha2("prompt", 256)).alias("sealed"))


def map_unmatched(spark, sf):
    """Answers of a mapper: to a row without a number, to a field not asked for, to none, and too sure."""
    cells, docs, fields, unmatched = _fallback(spark, sf)
    answer = lambda code, label, sure: F.struct(F.lit(code).alias("code"), F.lit(label).cast("string").alias("label"), F.lit(sure).alias("confidence"))
    answers = F.explode(F.array(answer("KM1.7", _ALIAS["KM1.6"], 0.9), answer("KM1.1", _ALIAS["KM1.6"], 0.9), answer("KM1.13", None, 0.5), answer("KM1.14", _ALIAS["KM1.6"], 1.5)))
    said = docs.select("doc_id", F.lit("DOCLING").alias("engine"), F.lit(1).alias("table_idx"), answers.alias("a")).select("doc_id", "engine", "table_idx", "a.*")
    decisions = said.withColumns({c: F.lit("x") for c in ("model", "prompt_sha", "prompt_version")})
    return mapping.map_unmatched(cells, unmatched, fields, docs, decisions)[1].groupBy("code", "reason").agg(F.count(F.lit(1)).alias("n"))


def last_opinion_wins(spark, sf):
    """Two opinions of the second engine on each total; the later counts."""
    first = _values(spark, sf).filter("field_code = 'KM1.4'").withColumn("engine_values", F.create_map("engine", "value"))
    second = first.withColumn("engine", F.lit("CAMELOT")).withColumn("step", F.explode(F.array(F.lit(2), F.lit(1))))
    second = second.withColumn("value", (F.col("value") + F.col("step")).cast(S.COMPUTE))
    merged = mapping.merge_engines(first, second, "step")
    return _double(merged.select("bank", "period", "value", F.col("engine_values")["CAMELOT"].alias("second")))


def extract_errors(spark, sf):
    """Documents without cells, and one of whose rows holds a number."""
    cells, docs = _grids(spark, sf)
    absent = docs.withColumn("doc_id", F.concat(F.lit("absent/"), "doc_id"))
    bare = docs.withColumn("doc_id", F.concat(F.lit("bare/"), "doc_id"))
    blank = cells.filter("table_idx = 1").withColumn("doc_id", F.concat(F.lit("bare/"), "doc_id")).withColumn("text", F.when(F.col("col_idx") == 0, F.col("text")).otherwise("n/a"))
    _, errors = pipeline.extract_template(spark, cells.unionByName(blank), docs.unionByName(absent).unionByName(bare))
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def known_documents(spark, sf):
    bank = F.element_at(F.array(*[F.lit(b) for b in ("barclays", "hsbc", "nobody", "unknown_bank")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    period = F.concat(F.year("o_orderdate").cast("string"), F.lit("q"), F.quarter("o_orderdate").cast("string"))
    names = _t(spark, sf, "orders").select(F.concat(F.lit("in/"), F.col("o_orderkey").cast("string"), F.lit("/"), bank, F.lit("_"), period, F.when(F.col("o_orderkey") % 3 == 0, "_OV1.pdf").otherwise("_km1.csv")).alias("path"))
    good, bad = pipeline.known_documents(names, config.banks(spark), "KM1", "1996Q2")
    none = F.lit(None).cast("string")
    return good.select("doc_id", "bank", "period", "reporting_currency", none.alias("error")).unionByName(bad.select("doc_id", "bank", "period", none.alias("reporting_currency"), "error"))


# ---- numbers in other units, and basis errors -------------------------------

def normalise_units(spark, sf):
    """Percentages, ratios and counts, with and without their sign."""
    plain = F.regexp_replace(F.format_number(F.col("l_discount") * 100, 2), ",", "")
    k = F.col("l_linenumber") % 6
    raw = F.when(k == 0, F.concat(plain, F.lit("%"))).when(k == 1, F.concat(plain, F.lit(" %¹"))).when(k == 2, F.format_number("l_discount", 4)).when(k == 3, F.concat(plain, F.lit("%"))).when(k == 4, F.format_number("l_extendedprice", 2)).otherwise(F.lit("1,001"))
    unit = F.element_at(F.array(*[F.lit(u) for u in ("PERCENT", "RATIO", "RATIO", "GBP_M", "COUNT", "PERCENT")]), (k + 1).cast("int"))
    cells = _lines(spark, sf).withColumns({"raw": raw, "unit": unit})
    parsed = numbers.normalise(cells, "p", F.col("raw"), F.lit("en_GB"), F.col("unit"), F.lit("millions"))
    return parsed.select("l_orderkey", "l_linenumber", "unit", F.round(F.col("p.value").cast("double"), 6).alias("value"), F.col("p.error").alias("error"))


def basis_errors(spark, sf):
    """Own funds of odd years on another basis: an error where the ratio's operands are there, quarantined."""
    odd = (F.col("field_code") == "KM1.1") & (F.left("period", F.lit(4)).cast("int") % 2 == 1)
    vals = _values(spark, sf).withColumn("ecl_basis", F.when(odd, "FULLY_LOADED").otherwise(F.col("ecl_basis")))
    routed = pipeline.reconcile_values(spark, vals, "quarantine")
    first = F.filter("checks", lambda c: F.array_contains(c["field_codes"], "KM1.1"))[0]["outcome"]
    return _double(routed.filter("field_code = 'KM1.1'").select("bank", "period", first.alias("outcome"), "status", "confidence"))


# ---- tables on disk, written and read back ----------------------------------

def store_round_trip(spark, sf):
    path = files.scratch_folder(spark, "store")
    banks = _wide(spark, sf).select("bank").distinct().withColumn("jurisdiction", F.lit("US"))
    store.append(store.flatten(_routed(spark, sf), banks, "run", "t"), path, partition=True)
    return store.scan(spark, path).groupBy("template", "field", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


def queue_round_trip(spark, sf):
    path = files.scratch_folder(spark, "queue")
    review.enqueue(_routed(spark, sf), path, "r")
    items = review.load(spark, path)
    return items.select("run_id", "bank", "period", "field_code", F.col("value").cast("double").alias("value"), F.col("confidence").cast("double").alias("confidence"), "status", "note")


def review_cards(spark, sf):
    items = _routed(spark, sf).filter("status = 'FLAGGED'")
    queue = review.queue_items(items, "r").select(F.from_json("value", review.ITEM).alias("i")).select("i.*")
    return review.render(queue).select(F.substring_index("card", "\n", 1).alias("head"), F.size(F.split("card", "\n    - ")).alias("n_parts"))


def write_back(spark, sf):
    routed = _routed(spark, sf)
    banks = _wide(spark, sf).select("bank").distinct().withColumn("jurisdiction", F.lit("US"))
    dataset = store.flatten(routed, banks, "r", "t").withColumns({"value": F.col("value").cast(S.STORED)})
    settled = routed.filter("status = 'FLAGGED' and field_code = 'KM1.4'").select(F.lit("r").alias("run_id"), "bank", "period", "field_code", F.lit("42.5").alias("value"), F.lit("HUMAN_CORRECTED").alias("status"))
    return _double(review.write_back(dataset, settled).select("bank", "period", "field", "value", "status"))


def _incoming(spark, sf):
    docs = _t(spark, sf, "documents")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content"), F.col("source").alias("bank_id"), F.lit("2025Q4").alias("period"), F.lit(None).cast("string").alias("template"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"), F.lit("PDF").alias("source_kind"))


def registry_against_ledger(spark, sf):
    """Documents against a ledger on disk that holds those of even ids."""
    path = files.scratch_folder(spark, "ledger")
    incoming = _incoming(spark, sf)
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in registry.MANIFEST))
    registry.append(registry.register(none, incoming.filter("doc_id % 2 = 0").drop("doc_id"), "/store", "t"), path)
    return registry.register(registry.scan(spark, path), incoming.drop("doc_id"), "/store", "u").select("bank_id", "url", "sha256", "status")


def raw_store(spark, sf):
    """Bytes that the registry keeps, read back under their digests."""
    folder = files.scratch_folder(spark, "raw")
    registry.ingest(_incoming(spark, sf).drop("doc_id"), files.scratch_folder(spark, "ledger"), folder, "t")
    kept = spark.read.format("binaryFile").load(folder).select("path", "content", "length")
    named = F.regexp_extract("path", r"([0-9a-f]{64})\.pdf$", 1) == F.sha2("content", 256)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.count_if(named).alias("n_named"))


def structured_files(spark, sf):
    """Filings written as CSV files and read by their header names."""
    path = files.scratch_folder(spark, "filings")
    o = _t(spark, sf, "orders")
    point = F.concat(F.lit("eba_dpm:km1.r00"), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("0"))
    o.select(F.col("o_totalprice").cast("decimal(18,2)").alias("value"), F.col("o_orderpriority").alias("note, quoted"), point.alias("datapoint")).write.option("header", True).csv(path)
    found = structured.read_filings(spark, path)
    return found.groupBy("datapoint").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


# ---- cells of extractors ----------------------------------------------------

def _boxes(spark, sf):
    x, y = F.col("l_linenumber").cast("double"), (F.col("l_suppkey") % 50).cast("double")
    return _t(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit("CAMELOT").alias("engine"), F.lit(0).alias("table_idx"), F.col("l_linenumber").cast("int").alias("row_idx"), F.lit(0).alias("col_idx"), F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("text"), (F.col("l_orderkey") % 3 + 1).cast("int").alias("page"), x.alias("x1"), y.alias("y1"), (x + 1).alias("x2"), (y + 2).alias("y2"), F.lit(100.0).alias("page_height"))


def cells_bottom_up(spark, sf):
    made = shapes.from_bottom_up(_boxes(spark, sf), [1, 2])
    return made.select("doc_id", "row_idx", "text", F.col("bbox.page").alias("page"), F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"))


def cells_ragged(spark, sf):
    """Every third cell is a gap without a box."""
    b = _boxes(spark, sf)
    gaps = [F.when(F.col("row_idx") % 3 != 0, F.col(c)).alias(n) for c, n in (("x1", "x0"), ("y1", "y0"), ("x2", "x1"), ("y2", "y1"))]
    made = shapes.flatten(shapes.from_ragged(b.select("doc_id", "engine", "table_idx", "row_idx", "col_idx", "text", "page", *gaps)))
    return made.groupBy("row_idx", "text").agg(F.count(F.lit(1)).alias("n"))


def secondary_engine(spark, sf):
    flavour = F.element_at(F.array(*[F.lit(f) for f in shapes.PRIORITY]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    tables = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("doc_id"), flavour.alias("flavour"), (F.col("o_orderkey") % 2 + 1).cast("int").alias("page"), F.col("o_orderkey").alias("table_idx"))
    return shapes.pick_secondary(tables)


# ---- analytics ---------------------------------------------------------------

def latest_run(spark, sf):
    """Two runs of every filing; the later one's figures stay."""
    rows = _filings(spark, sf).withColumn("template", F.lit("KM1"))
    later = rows.withColumns({"extracted_at": F.lit("u"), "value": (F.col("value") + 1).cast(S.STORED)})
    return _double(analytics.latest_run_only(rows.unionByName(later)).select("bank", "period", "value", "extracted_at"))


def engine_scores(spark, sf):
    truth, read = _golden(spark, sf)
    rows = golden.compare_engines(read, truth)
    return spark.createDataFrame([(r["engine"], r["matches"], r["n"], r["n_docs"], r["rate"], r["too_few"]) for r in rows], "engine string, matches bigint, n bigint, n_docs bigint, rate double, too_few boolean")


def sheet_titles(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", analytics.safe_title(F.concat(F.lit("a/b["), F.col("p_partkey").cast("string"), F.lit("]:*?"), F.col("p_name"))).alias("title"))


def queries() -> dict[str, Query]:
    named = [
        reconcile_route, ratio_identity, cross_foot, two_engine, magnitude_sanity, confidence_product, peer_compare, trend_delta, golden_compare, golden_accuracy, exact_match_score, bootstrap_interval, registry_dedupe, normalise_en, normalise_locales, normalise_reject_reasons, scale_lift, structured_ingest, classify_table, map_fields, map_all_tables, unmatched_fields, merge_engines, engine_coverage, period_parse, period_candidates, label_normalise, review_latest, sweep_summary, status_assertion, store_rows, newest_version, event_windows,
        period_phrases, resolve_latest, resolve_quarter_end, period_ambiguous, first_wins, unused_rows, fallback_prompts, map_unmatched, last_opinion_wins, extract_errors, known_documents, normalise_units, basis_errors,
        store_round_trip, queue_round_trip, review_cards, write_back, registry_against_ledger, raw_store, structured_files, cells_bottom_up, cells_ragged, secondary_engine, latest_run, engine_scores, sheet_titles,
    ]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    price = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)"
    codes = "CASE WHEN i = 0 THEN 'KM1.1' WHEN i = 1 THEN 'KM1.2' WHEN i = 2 THEN 'KM1.4' WHEN i = 3 THEN 'KM1.5' ELSE 'KM1.6' END"
    sql = {
        "reconcile_route": f"WITH {_CHECKS} SELECT bank, period, field_code, value, confidence, status FROM routed",
        "ratio_identity": f"WITH {_CHECKS} SELECT bank, period, 'KM1/ratio_identities/0' AS check_id, i5 AS outcome, 3 AS n_fields FROM k UNION ALL SELECT bank, period, 'KM1/ratio_identities/1', i6, 3 FROM k UNION ALL SELECT bank, period, 'KM1/ratio_identities/2', 'SKIP', 3 FROM k",
        "cross_foot": "SELECT year(o_orderdate) || 'FY' AS period, CASE WHEN year(o_orderdate) % 2 = 1 THEN 'FAIL' ELSE 'PASS' END AS outcome, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS expected, round(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) + CASE WHEN year(o_orderdate) % 2 = 1 THEN CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) ELSE 0.50 END AS DOUBLE), 2) AS actual FROM orders GROUP BY year(o_orderdate)",
        "two_engine": f"WITH {_CHECKS} SELECT bank, period, te AS outcome FROM k",
        "magnitude_sanity": f"WITH {_CHECKS} SELECT bank, period, 'MAGNITUDE_SANITY/' || field_code AS check_id, CASE WHEN sane THEN 'PASS' ELSE 'FAIL' END AS outcome FROM c",
        "confidence_product": f"WITH {_CHECKS} SELECT confidence, status, count(*) AS n FROM routed GROUP BY ALL",
        "peer_compare": f"WITH {_FILINGS} SELECT bank, CAST(cents AS DOUBLE) / 100 AS value, rank() OVER (ORDER BY cents DESC) AS rank FROM s WHERE status <> 'FLAGGED' AND period = '1995Q1'",
        "trend_delta": f"WITH {_FILINGS} SELECT bank, period, CAST(cents AS DOUBLE) / 100 AS value, CAST(cents - lag(cents) OVER (PARTITION BY bank ORDER BY period) AS DOUBLE) / 100 AS delta, CAST(left(period, 4) || right(period, 1) AS INTEGER) AS period_ord FROM s WHERE status <> 'FLAGGED'",
        "golden_compare": f"WITH {_GOLDEN} SELECT bank, period, field_code, outcome FROM o WHERE outcome IS NOT NULL",
        "golden_accuracy": f"WITH {_GOLDEN} SELECT bank, period, count(*) FILTER (outcome = 'CORRECT') AS n_correct, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'EXTRA') AS n_extra FROM o WHERE outcome IS NOT NULL GROUP BY bank, period",
        "exact_match_score": f"WITH {_GOLDEN} SELECT period, count(*) FILTER (outcome = 'CORRECT') AS matches, count(*) AS n FROM o WHERE k % 13 <> 0 GROUP BY period",
        "registry_dedupe": "WITH d AS (SELECT source AS bank_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url, sha256(text) AS sha256 FROM documents) SELECT bank_id, url, sha256, '/store/' || sha256 || '.pdf' AS local_path, CASE WHEN row_number() OVER (PARTITION BY sha256 ORDER BY bank_id, url) = 1 THEN 'fetched' ELSE 'skipped_dup' END AS status FROM d",
        "normalise_en": f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 1 THEN -{price} ELSE {price} END AS value, CAST(NULL AS VARCHAR) AS error FROM lineitem",
        "normalise_locales": f"SELECT l_orderkey, l_linenumber, CASE l_suppkey % 3 WHEN 0 THEN 'en_US' WHEN 1 THEN 'de_DE' ELSE 'fr_FR' END AS loc, {price} AS value, CAST(NULL AS VARCHAR) AS error FROM lineitem",
        "normalise_reject_reasons": "SELECT CASE l_orderkey % 8 WHEN 0 THEN 'empty' WHEN 1 THEN 'placeholder' WHEN 2 THEN 'grouping' WHEN 3 THEN 'grouping' WHEN 4 THEN 'separators' WHEN 5 THEN 'residue' WHEN 6 THEN 'no_digits' ELSE 'ok' END AS reason, count(*) AS n FROM lineitem GROUP BY ALL",
        "scale_lift": f"SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) * CASE l_suppkey % 4 WHEN 0 THEN 1000000 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 1 END AS value_e5, CAST(NULL AS VARCHAR) AS error FROM lineitem",
        "structured_ingest": "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'KM1.' || (o_orderkey % 9 + 1) AS field_code, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 9 IN (4, 5) THEN 100 ELSE 1 END AS DOUBLE) AS value, CASE WHEN o_orderkey % 9 < 4 THEN 'EUR_M' ELSE 'PERCENT' END AS unit FROM orders WHERE o_orderkey % 9 < 7 AND o_orderkey % 10 <> 0",
        "classify_table": f"WITH {_WIDE} SELECT bank || '/' || period AS doc_id, 1 AS table_idx, 5 AS score FROM w",
        "map_fields": f"WITH {_WIDE}, i AS (SELECT unnest([0, 1, 2, 3, 4]) AS i), x AS (SELECT bank || '/' || period AS doc_id, {codes} AS field_code, CASE i WHEN 0 THEN c1 / 100.0 WHEN 1 THEN c2 / 100.0 WHEN 2 THEN c4 / 100.0 WHEN 3 THEN r5 / 10.0 ELSE r6 / 10.0 END AS value, CASE WHEN i < 3 THEN 'USD_M' ELSE 'PERCENT' END AS unit FROM w, i) SELECT doc_id, field_code, CAST(value AS DOUBLE) AS value, unit FROM x WHERE value IS NOT NULL",
        "unmatched_fields": f"WITH {_WIDE}, c AS (SELECT unnest(['KM1.3', 'KM1.7', 'KM1.13', 'KM1.14', 'KM1.15', 'KM1.16', 'KM1.17', 'KM1.18', 'KM1.19', 'KM1.20']) AS code) SELECT code, count(*) AS n FROM w, c GROUP BY code UNION ALL SELECT 'KM1.6', count(*) FROM w WHERE r6 IS NULL HAVING count(*) > 0",
        "merge_engines": f"WITH {_CHECKS} SELECT f.bank, f.period, field_code, CAST(v AS DOUBLE) / unit AS value, CASE WHEN field_code = 'KM1.4' THEN CAST(e4 AS DOUBLE) / 100 END AS second FROM f JOIN w ON f.bank = w.bank AND f.period = w.period",
        "engine_coverage": f"WITH {_WIDE} SELECT 'KM1.4' AS field_code, 'primary' AS only_in, count(*) AS n FROM w UNION ALL SELECT 'KM1.1', 'secondary', count(*) FROM w",
        "period_parse": "WITH p AS (SELECT year(o_orderdate) AS y, CASE WHEN o_orderkey % 4 = 0 THEN 'FY' WHEN o_orderkey % 9 = 0 THEN 'Q7' ELSE 'Q' || quarter(o_orderdate) END AS q FROM orders) SELECT y || q AS period, q <> 'Q7' AS valid, CAST(CASE q WHEN 'Q7' THEN NULL WHEN 'FY' THEN y * 10 + 5 ELSE y * 10 + CAST(right(q, 1) AS INTEGER) END AS INTEGER) AS ord, count(*) AS n FROM p GROUP BY ALL",
        "period_candidates": "WITH p AS (SELECT o_orderkey AS doc_id, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders), q AS (SELECT *, y >= 2000 AND ((m IN (3, 12) AND d = 31) OR (m IN (6, 9) AND d = 30)) AS hit FROM p) SELECT doc_id, CASE WHEN hit THEN y || 'Q' || (m // 3) END AS period, CAST(CASE WHEN hit THEN 0.95 END AS DOUBLE) AS confidence FROM q",
        "label_normalise": "SELECT p_partkey, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS label FROM part",
        "review_latest": f"WITH {_CHECKS} SELECT bank, period, field_code, CASE WHEN field_code = 'KM1.4' THEN 42.5 ELSE value END AS value, CASE WHEN field_code = 'KM1.4' THEN 'HUMAN_CORRECTED' ELSE status END AS status, CASE WHEN field_code = 'KM1.4' THEN 'seen' ELSE '' END AS note FROM routed WHERE status = 'FLAGGED'",
        "sweep_summary": f"WITH {_CHECKS} SELECT bank, count(*) FILTER (status = 'AUTO_PASSED') AS n_auto_passed, count(*) FILTER (status = 'FLAGGED') AS n_flagged FROM routed GROUP BY bank",
        "status_assertion": f"WITH {_FILINGS} SELECT status, count(*) AS n, count(*) FILTER (status <> 'FLAGGED') AS n_validated FROM s GROUP BY status",
        "store_rows": f"WITH {_CHECKS} SELECT r.bank, r.period, 'US' AS jurisdiction, r.field_code AS field, r.value, r.confidence, r.status, concat_ws(',', CASE WHEN list_contains(c.o[1:CASE WHEN c.field_code = 'KM1.4' THEN 2 ELSE 1 END], 'PASS') OR list_contains(c.o[1:CASE WHEN c.field_code = 'KM1.4' THEN 2 ELSE 1 END], 'FAIL') THEN 'RATIO_IDENTITY' END, CASE WHEN c.te <> 'SKIP' THEN 'TWO_ENGINE' END) AS basis FROM routed r JOIN c ON r.bank = c.bank AND r.period = c.period AND r.field_code = c.field_code",
        "newest_version": "SELECT source AS bank_id, '202' || (doc_id % 5) || 'Q1' AS period, lang AS template, lpad(CAST(max(doc_id) AS VARCHAR), 12, '0') AS fetched_at FROM documents GROUP BY source, doc_id % 5, lang",
        "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
        }
    return sql | {"map_all_tables": sql["map_fields"] + " UNION ALL SELECT bank || '/' || period, 'KM1.3', 1.0, 'USD_M' FROM w"} | _more_sql()


def _more_sql() -> dict[str, str]:
    latest = "SELECT doc_id, period, confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y * 10 + coalesce(q, 5) DESC) AS n FROM c{}) WHERE n = 1"
    return {
        "period_phrases": f"WITH {_PHRASES} SELECT period, confidence, count(*) AS n FROM c GROUP BY ALL",
        "resolve_latest": f"WITH {_PHRASES} {latest.format('')}",
        "resolve_quarter_end": f"WITH {_PHRASES} SELECT doc_id, period FROM ({latest.format(' WHERE y IS NULL OR q IS NOT NULL')})",
        "period_ambiguous": "SELECT o_orderkey % 8 = 2 AS ambiguous, count(*) AS n FROM orders GROUP BY ALL",
        "first_wins": f"WITH {_CHECKS} SELECT side, field_code, count(*) AS n, CAST(sum(v + CASE side WHEN 'kept' THEN 0 ELSE unit END) AS DOUBLE) / any_value(unit) AS total FROM f, (SELECT unnest(['kept', 'dropped']) AS side) GROUP BY ALL",
        "unused_rows": f"WITH {_WIDE} SELECT bank || '/' || period AS doc_id, 1 AS table_idx, 4 AS row_idx, 0 AS label_col FROM w WHERE r6 IS NULL",
        "fallback_prompts": f"WITH {_WIDE} SELECT bank || '/' || period AS doc_id, CASE WHEN r6 IS NULL THEN 15 ELSE 14 END AS n_lines, true AS sealed FROM w",
        "map_unmatched": f"WITH {_WIDE} SELECT 'KM1.7' AS code, CASE WHEN r6 IS NULL THEN 'no_number' ELSE 'unknown_row' END AS reason, count(*) AS n FROM w GROUP BY ALL UNION ALL SELECT 'KM1.1', 'out_of_scope', count(*) FROM w UNION ALL SELECT 'KM1.13', 'no_row', count(*) FROM w UNION ALL SELECT 'KM1.14', 'bad_confidence', count(*) FROM w",
        "last_opinion_wins": f"WITH {_WIDE} SELECT bank, period, CAST(c4 AS DOUBLE) / 100 AS value, CAST(c4 + 200 AS DOUBLE) / 100 AS second FROM w",
        "extract_errors": f"WITH {_WIDE} SELECT 'no table matches the template' AS error, count(*) AS n FROM w UNION ALL SELECT 'no field could be mapped', count(*) FROM w",
        "known_documents": """WITH n AS (SELECT o_orderkey AS k, ['barclays', 'hsbc', 'nobody', 'unknown_bank'][o_orderkey % 4 + 1] AS bank, year(o_orderdate) || 'q' || quarter(o_orderdate) AS period FROM orders)
SELECT 'in/' || k || '/' || bank || '_' || period || '_km1.csv' AS doc_id, bank, '1996Q2' AS period, CASE bank WHEN 'barclays' THEN 'GBP' WHEN 'hsbc' THEN 'USD' END AS reporting_currency, CASE WHEN k % 4 > 1 THEN 'unknown bank ' || bank END AS error FROM n WHERE period = '1996q2' AND k % 3 <> 0""",
        "normalise_units": """WITH l AS (SELECT l_orderkey, l_linenumber, l_linenumber % 6 AS k, CAST(l_discount AS DECIMAL(18,2)) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, ['PERCENT', 'RATIO', 'RATIO', 'GBP_M', 'COUNT', 'PERCENT'][k + 1] AS unit,
  CAST(CASE k WHEN 0 THEN d * 100 WHEN 1 THEN d WHEN 2 THEN d WHEN 4 THEN p END AS DOUBLE) AS value, CASE k WHEN 3 THEN 'percent' WHEN 5 THEN 'band' END AS error FROM l""",
        "basis_errors": f"WITH {_CHECKS} SELECT r.bank, r.period, CASE WHEN k.odd THEN 'ERROR' ELSE k.i5 END AS outcome, CASE WHEN k.odd THEN 'FLAGGED' ELSE r.status END AS status, CASE WHEN k.odd THEN 0.0 ELSE r.confidence END AS confidence FROM routed r JOIN (SELECT *, CAST(left(period, 4) AS INTEGER) % 2 = 1 AS odd FROM k) k ON k.bank = r.bank AND k.period = r.period WHERE r.field_code = 'KM1.1'",
        "store_round_trip": f"WITH {_CHECKS} SELECT 'KM1' AS template, r.field_code AS field, status, count(*) AS n, CAST(sum(v) AS DOUBLE) / any_value(unit) AS total FROM routed r JOIN f ON f.bank = r.bank AND f.period = r.period AND f.field_code = r.field_code GROUP BY ALL",
        "queue_round_trip": f"WITH {_CHECKS} SELECT 'r' AS run_id, bank, period, field_code, value, confidence, status, '' AS note FROM routed WHERE status = 'FLAGGED'",
        "review_cards": f"WITH {_CHECKS} SELECT '[FLAGGED] ' || r.bank || ' / ' || r.period || ' / ' || r.field_code || ' / r' AS head, len(c.o) + CASE WHEN r.field_code = 'KM1.4' THEN 2 ELSE 2 END AS n_parts FROM routed r JOIN c ON c.bank = r.bank AND c.period = r.period AND c.field_code = r.field_code WHERE r.status = 'FLAGGED'",
        "write_back": f"WITH {_CHECKS} SELECT bank, period, field_code AS field, CASE WHEN field_code = 'KM1.4' AND status = 'FLAGGED' THEN 42.5 ELSE value END AS value, CASE WHEN field_code = 'KM1.4' AND status = 'FLAGGED' THEN 'HUMAN_CORRECTED' ELSE status END AS status FROM routed",
        "registry_against_ledger": """WITH d AS (SELECT doc_id, source AS bank_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url, sha256(coalesce(text, '')) AS sha256 FROM documents)
SELECT bank_id, url, sha256, CASE WHEN sha256 IN (SELECT sha256 FROM d WHERE doc_id % 2 = 0) OR row_number() OVER (PARTITION BY sha256 ORDER BY bank_id, url) > 1 THEN 'skipped_dup' ELSE 'fetched' END AS status FROM d""",
        "raw_store": "SELECT count(*) AS n, CAST(sum(octet_length(encode(t))) AS BIGINT) AS bytes, count(*) AS n_named FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents)",
        "structured_files": "SELECT 'eba_dpm:km1.r00' || (o_orderkey % 9 + 1) || '0' AS datapoint, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL",
        "cells_bottom_up": "SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, CAST(l_linenumber AS INTEGER) AS row_idx, CASE WHEN l_linenumber > 1 THEN l_returnflag ELSE '' END AS text, CAST(l_orderkey % 3 + 1 AS INTEGER) AS page, CAST(l_linenumber AS DOUBLE) AS x0, CAST(98 - l_suppkey % 50 AS DOUBLE) AS y0, CAST(l_linenumber + 1 AS DOUBLE) AS x1, CAST(100 - l_suppkey % 50 AS DOUBLE) AS y1 FROM lineitem WHERE l_orderkey % 3 < 2",
        "cells_ragged": "SELECT CAST(l_linenumber AS INTEGER) AS row_idx, CASE WHEN l_linenumber > 1 THEN l_returnflag ELSE '' END AS text, count(*) AS n FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY ALL",
        "secondary_engine": """WITH t AS (SELECT CAST(o_custkey AS VARCHAR) AS doc_id, o_orderkey % 3 AS rank, count(*) FILTER (o_orderkey % 2 = 0) AS n FROM orders GROUP BY ALL)
SELECT doc_id, ['lattice', 'stream', 'pdfplumber'][min(rank) + 1] AS flavour FROM t WHERE n > 0 OR rank = 2 GROUP BY doc_id""",
        "latest_run": f"WITH {_FILINGS} SELECT bank, period, CAST(cents + 100 AS DOUBLE) / 100 AS value, 'u' AS extracted_at FROM s",
        "engine_scores": """WITH t AS (SELECT * FROM orders WHERE o_orderkey % 13 <> 0)
SELECT engine, matches, n, n_docs, CAST(matches AS DOUBLE) / n AS rate, n_docs < 5 AS too_few FROM (
  SELECT 'DOCLING' AS engine, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0) AS matches, count(*) AS n, count(DISTINCT (o_orderstatus, year(o_orderdate))) AS n_docs FROM t
  UNION ALL SELECT 'CAMELOT', count(*) FILTER (o_orderkey % 2 = 1 AND o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0), count(*), count(DISTINCT (o_orderstatus, year(o_orderdate))) FROM t)""",
        "sheet_titles": "SELECT p_partkey, left(translate('a/b[' || p_partkey || ']:*?' || p_name, '[]:*?/' || chr(92), '_______'), 31) AS title FROM part",
    }

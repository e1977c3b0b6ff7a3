"""Whole runs: from cells or structured filings to the store and the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import NoTemplateTableError
from ..operators import analytics, mapping, reconcile
from ..sources import config, review, store, structured
from . import schema as S


def format_results(results: DataFrame) -> DataFrame:
    """One auditable ``line`` per result: field, value, bases, checks, source cell, mapping, status."""
    value = F.when(F.col("unit") == "PERCENT", F.concat(S.plain_number(F.col("value")), F.lit("%"))).otherwise(F.concat_ws(" ", S.plain_number(F.col("value")), "unit"))
    checks = F.when(F.size("checks") == 0, "NO_CHECKS").otherwise(F.array_join(F.transform("checks", lambda c: F.concat_ws(" ", c["check_type"], c["outcome"])), ", "))
    b = F.col("bbox")
    num = lambda x: F.regexp_replace(F.call_function("format_number", x, F.lit("0.####")), r"\.0+$", "")
    place = F.when(b.isNull(), "page NA bbox(NA)").otherwise(F.concat(F.lit("page "), b["page"].cast("string"), F.lit(" bbox("), F.concat_ws(",", *[num(b[c]) for c in ("x0", "y0", "x1", "y1")]), F.lit(")")))
    head = F.concat(F.concat_ws(" ", "field_code", "mapping.matched_alias"), F.lit(" = "), value, F.lit(" [ecl="), F.col("ecl_basis"), F.lit(" floor="), F.col("floor_basis"), F.lit("]"))
    return results.withColumn("line", F.concat_ws(" | ", head, checks, place, F.concat(F.lit("map="), F.col("mapping.method")), "status"))


def reconcile_values(spark: SparkSession, values: DataFrame, on_basis_error: str = "raise", tolerances: config.Tolerances | None = None, weights: config.Weights | None = None, bands: DataFrame | None = None) -> DataFrame:
    return reconcile.reconcile(values, config.identity_operands(spark), config.magnitude_bands(spark) if bands is None else bands, tolerances or config.load_tolerances(), weights or config.load_weights(), on_basis_error)


def extract_template(spark: SparkSession, cells: DataFrame, docs: DataFrame, secondary: DataFrame | None = None, decisions: DataFrame | None = None, strict: bool = False, tables: str = "best") -> tuple[DataFrame, DataFrame]:
    """(field values, errors) of all documents: classified, mapped, completed
    by a mapper's decisions, crossed with a second engine's cells, first
    mapping of each field kept. ``strict``: any document without a table or a
    mapped field raises instead of becoming an error row. ``tables``: see
    ``mapping.map_fields``."""
    fields = config.template_fields(spark, *[r[0] for r in docs.select("template").distinct().collect()])
    values, unmatched, errors = mapping.map_fields(cells, fields, docs, tables=tables)
    if decisions is not None:
        more, _ = mapping.map_unmatched(cells, unmatched, fields, docs, decisions)
        values = values.unionByName(more)
    values, _ = mapping.first_wins(values)
    if secondary is not None:
        other, _, _ = mapping.map_fields(secondary, fields, docs, tables=tables)
        values = mapping.merge_engines(values, other)
    empty = docs.select("doc_id", "bank", "period", "template").join(values.select("doc_id").distinct(), "doc_id", "left_anti").join(errors.select("doc_id"), "doc_id", "left_anti").withColumn("error", F.lit("no field could be mapped"))
    errors = errors.select("doc_id", "bank", "period", "template", "error").unionByName(empty)
    if strict:
        S.require(errors, F.lit(True), NoTemplateTableError, F.concat_ws(" ", "doc_id", "error"))
    return values, errors


def known_documents(names: DataFrame, banks: DataFrame, template: str, period: str) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of files named bank_PERIOD_TEMPLATE.ext: other
    periods and templates are left out, unknown banks are errors."""
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    part = lambda i: F.regexp_extract(stem, r"^(.+)_([^_]*)_([^_]*)$", i)
    named = names.select(F.col("path").alias("doc_id"), part(1).alias("bank"), part(2).alias("period"), F.upper(part(3)).alias("template"))
    wanted = named.filter((F.upper("period") == period.upper()) & (F.col("template") == template)).withColumn("period", F.lit(period))
    joined = wanted.join(F.broadcast(banks), "bank", "left").withColumn("source_url", F.col("doc_id"))
    bad = joined.filter("name is null").select("doc_id", "bank", "period", "template", F.concat(F.lit("unknown bank "), F.col("bank")).alias("error"))
    good = joined.filter("name is not null").select("doc_id", "bank", "period", "template", "source_url", "number_locale", "reporting_currency", "monetary_scale")
    return good, bad


def structured_values(spark: SparkSession, filings: DataFrame, docs: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(field values, errors) of structured filings (see
    ``structured.read_filings(on_error="rows")``): a file that cannot be read
    or maps to nothing is an error row, or raises with ``strict``."""
    fields = config.template_fields(spark, *[r[0] for r in docs.select("template").distinct().collect()])
    known = docs.select("doc_id", "bank", "period", "reporting_currency", "source_url")
    values = structured.field_values(filings.filter("error is null").drop("error"), config.datapoint_map(spark), fields, known)
    broken = filings.filter("error is not null").select("doc_id", "error").dropDuplicates(["doc_id"])
    named = docs.select("doc_id", "bank", "period", "template")
    errors = named.join(broken, "doc_id")
    empty = named.join(broken.select("doc_id").unionByName(values.select("doc_id").distinct()), "doc_id", "left_anti").withColumn("error", F.lit("no field could be mapped"))
    errors = errors.unionByName(empty)
    if strict:
        S.require(errors, F.lit(True), NoTemplateTableError, F.concat_ws(" ", "doc_id", "error"))
    return values, errors


def sweep(spark: SparkSession, cells: DataFrame | None, docs: DataFrame, banks: DataFrame, run_id: str, extracted_at: str, store_path: str, queue_path: str, secondary: DataFrame | None = None, decisions: DataFrame | None = None, errors: DataFrame | None = None, filings: DataFrame | None = None, tables: str = "best") -> DataFrame:
    """All documents in one job: extract from ``cells`` (or take structured
    ``filings``), reconcile, store, enqueue; returns the tally per bank. A
    document that fails is an error row, never the end of the sweep. Results
    are written to the store first, then the queue."""
    values, bad = extract_template(spark, cells, docs, secondary, decisions, tables=tables) if filings is None else structured_values(spark, filings, docs)
    values = values.persist()  # results and errors both read them
    results = reconcile_values(spark, values, "quarantine").persist()
    try:
        store.append(store.flatten(results, banks, run_id, extracted_at), store_path, quantise_confidence=True)
        review.enqueue(results, queue_path, run_id)
        all_bad = bad if errors is None else bad.unionByName(errors)
        rows = analytics.tallies(results, all_bad).collect()  # one row per bank
    finally:
        results.unpersist()
        values.unpersist()
    return spark.createDataFrame(rows, "bank string, n_auto_passed bigint, n_flagged bigint, error string")


def summary_lines(tally: DataFrame) -> DataFrame:
    """Printable lines of a sweep's tally, by bank."""
    line = F.when(F.col("error").isNotNull(), F.concat("bank", F.lit(": SKIPPED ("), "error", F.lit(")"))).otherwise(F.format_string("%s: %d AUTO_PASSED / %d FLAGGED", "bank", "n_auto_passed", "n_flagged"))
    return tally.select("bank", line.alias("line")).orderBy("bank")


def newest_version(manifest: DataFrame) -> DataFrame:
    """Of each bank, period and template the document fetched last."""
    w = Window.partitionBy("bank_id", "period", "template").orderBy(F.desc("fetched_at"), "sha256")
    return manifest.filter("status = 'fetched'").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")

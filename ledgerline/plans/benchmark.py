"""Extractors against verified filings: cells of any number of engines, paired
with truth files by name."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConfigError
from ..operators import golden, mapping
from ..plans import schema as S
from ..sources import config


def truth_files(folder: str, template: str) -> dict[str, str]:
    """Stem of a document: its truth file ``<stem>_<template>.yaml``."""
    ending = f"_{template.lower()}.yaml"
    return {p.name.removesuffix(ending): str(p) for p in sorted(Path(folder).glob(f"*{ending}"))}


def score_engines(spark: SparkSession, cells: DataFrame, folder: str, template: str, banks: DataFrame | None = None) -> tuple[list[dict], list[str]]:
    """(one row per engine, names of documents without truth).

    Every document whose file stem has a truth file is mapped from each
    engine's cells, by rules alone, and compared field by field with what was
    verified. Rows: engine, n_docs, n_fields, hits, rate, ci, too_few. No pair
    at all raises: a rate over nothing would say something.
    """
    files = truth_files(folder, template)
    docs = cells.select("doc_id").distinct().withColumn("stem", F.regexp_extract("doc_id", r"([^/]+?)(?:\.[^./]*)?$", 1))
    known = spark.createDataFrame([(s,) for s in files], "stem string")
    unpaired = [r[0] for r in docs.join(known, "stem", "left_anti").select("doc_id").orderBy("doc_id").collect()]
    truth = None
    for stem, path in files.items():  # truth files are written by people: some dozens
        one = golden.load_golden(spark, path).withColumn("stem", F.lit(stem))
        truth = one if truth is None else truth.unionByName(one)
    if truth is None or docs.join(known, "stem", "left_semi").isEmpty():
        raise ConfigError(f"no document has a file <stem>_{template.lower()}.yaml under {folder}")
    banks = config.banks(spark) if banks is None else banks
    expected = docs.join(truth, "stem").select("doc_id", "bank", "period", "template", "field_code", "golden").persist()
    filings = expected.select("doc_id", "bank", "period", "template").distinct().join(banks, "bank").withColumn("source_url", F.col("ir_url"))
    filings = filings.select("doc_id", "bank", "period", "template", "source_url", "number_locale", "reporting_currency", "monetary_scale")
    values, _, _ = mapping.map_fields(cells.join(filings.select("doc_id"), "doc_id", "left_semi"), config.template_fields(spark, template), filings)
    kept, _ = mapping.first_wins(values)
    engines = cells.select("engine").distinct()
    joined = expected.crossJoin(F.broadcast(engines)).join(kept.select("doc_id", "engine", "field_code", "value"), ["doc_id", "engine", "field_code"], "left")  # a handful of engines
    rows = joined.groupBy("engine").agg(F.count_if(F.col("golden") == F.col("value").cast(S.COMPUTE)).alias("hits"), F.count(F.lit(1)).alias("n_fields"), F.count_distinct("doc_id").alias("n_docs")).orderBy("engine").collect()
    expected.unpersist()
    return [{**r.asDict(), "rate": r["hits"] / r["n_fields"], "ci": golden.bootstrap_ci(r["hits"], r["n_fields"]), "too_few": r["n_docs"] < golden.CREDIBLE_DOCS} for r in rows], unpaired

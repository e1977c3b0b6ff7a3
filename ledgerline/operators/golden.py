"""Accuracy against human-verified truth: comparison, scores and confidence intervals."""

from __future__ import annotations

import json
from decimal import Decimal
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConfigError
from ..functions.numbers import SCALES
from ..plans import schema as S

#: Documents below which a comparison of engines says little.
CREDIBLE_DOCS = 5
#: Resampled fields held at once.
DRAWS = 1 << 20
_KEY = ["bank", "period", "template"]


def load_golden(spark: SparkSession, *paths: str) -> DataFrame:
    """(bank, period, template, field_code, golden, unit, ecl_basis, floor_basis, page).
    Figures must be quoted, so that YAML does not read them as floats."""
    rows = []
    for p in paths:
        data = yaml.safe_load(Path(p).read_text(encoding="utf-8"))
        if not data.get("values"):
            raise ConfigError(f"{p}: no values")
        for code, v in data["values"].items():
            if not isinstance(v.get("value"), str):
                raise ConfigError(f"{p} {code}: quote the value")
            rows.append((data["bank"], data["period"], data["template"], code, Decimal(v["value"]), v.get("unit"), v.get("ecl_basis"), v.get("floor_basis"), v.get("page")))
    return spark.createDataFrame(rows, f"bank string, period string, template string, field_code string, golden {S.COMPUTE}, unit string, ecl_basis string, floor_basis string, page int")


def load_fixture(spark: SparkSession, *paths: str) -> DataFrame:
    """Frozen extracted cells as field values; decimals are strings, an unknown scale is an error."""
    raw = spark.read.schema(
        "bank string, period string, template string, source_url string, sha256 string, engine string, cells array<struct<field_code:string,value:string,unit:string,ecl_basis:string,floor_basis:string,raw_text:string,page:int,bbox:array<double>,monetary_scale:string>>"
    ).option("multiLine", True).json(list(paths))
    cells = raw.select("bank", "period", "template", "source_url", "sha256", "engine", F.explode("cells").alias("c"))
    scale = F.coalesce("c.monetary_scale", F.lit("millions"))
    S.require(cells, ~scale.isin(list(SCALES)), ConfigError, F.concat("c.field_code", F.lit(": unknown scale "), scale))
    value = F.col("c.value").cast(S.COMPUTE)
    rule = F.struct(F.lit("RULE").alias("method"), *[F.lit(None).cast("string").alias(n) for n in ("model", "prompt_sha", "prompt_version", "matched_alias")], F.lit(1.0).alias("confidence"))
    box = F.struct(F.col("c.page").alias("page"), *[F.col("c.bbox")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
    out = cells.select("bank", "period", "template", F.col("sha256").alias("doc_id"), "c.field_code", value.alias("value"), "c.unit", "c.ecl_basis", "c.floor_basis", "engine", F.lit("PDF").alias("source_kind"), "source_url", box.alias("bbox"), scale.alias("monetary_scale"), rule.alias("mapping"), "c.raw_text", F.create_map("engine", value).alias("engine_values"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.FIELD_VALUES.fields])


def write_fixture(values: DataFrame, path: str) -> None:
    """One filing's values as a fixture file (driver side; a filing is some dozen cells)."""
    S.require(values, F.col("bbox").isNull(), ConfigError, F.concat("field_code", F.lit(": no box")))
    rows = values.orderBy("field_code").collect()
    if not rows:
        raise ConfigError("no values")
    head = rows[0]
    plain = lambda d: format(d.normalize(), "f")
    cells = [{"field_code": r["field_code"], "value": plain(r["value"]), "unit": r["unit"], "ecl_basis": r["ecl_basis"], "floor_basis": r["floor_basis"], "raw_text": r["raw_text"], "page": r["bbox"]["page"], "bbox": [r["bbox"][c] for c in ("x0", "y0", "x1", "y1")], "monetary_scale": r["monetary_scale"]} for r in rows]
    Path(path).write_text(json.dumps({"bank": head["bank"], "period": head["period"], "template": head["template"], "source_url": head["source_url"], "sha256": head["doc_id"], "engine": head["engine"], "cells": cells}, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")


def compare(golden: DataFrame, extracted: DataFrame) -> DataFrame:
    """(bank, period, template, field_code, golden, extracted, outcome):
    CORRECT, MISMATCH, MISSING or EXTRA per field. An empty truth raises."""
    if golden.isEmpty():
        raise ConfigError("golden truth is empty")
    key = [*_KEY, "field_code"]
    joined = golden.select(*key, "golden").join(extracted.select(*key, F.col("value").alias("extracted")), key, "full")
    outcome = F.when(F.col("golden").isNull(), "EXTRA").when(F.col("extracted").isNull(), "MISSING").when(F.col("golden") == F.col("extracted"), "CORRECT").otherwise("MISMATCH")
    return joined.withColumn("outcome", outcome)


def accuracy(compared: DataFrame, *by: str) -> DataFrame:
    """Counts of each outcome and correct over (correct + mismatch + missing)."""
    n = {o: F.count_if(F.col("outcome") == o).alias(f"n_{o.lower()}") for o in S.CELL_OUTCOMES}
    out = compared.groupBy(*(by or _KEY)).agg(*n.values())
    whole = F.col("n_correct") + F.col("n_mismatch") + F.col("n_missing")
    return out.withColumn("n_golden", whole).withColumn("accuracy", F.try_divide(F.col("n_correct").cast("decimal(18,0)"), whole.cast("decimal(18,0)")))


def exact_match(extracted: DataFrame, expected: DataFrame, *by: str) -> DataFrame:
    """(matches, n): expected fields whose figure was extracted exactly; extra ones do not count."""
    key = [*_KEY, "field_code"]
    joined = expected.select(*key, F.col("golden").alias("want")).join(extracted.select(*key, "value", *[b for b in by if b not in key]), key, "left")
    return joined.groupBy(*(by or _KEY)).agg(F.count_if(F.col("want") == F.col("value")).alias("matches"), F.count(F.lit(1)).alias("n"))


def bootstrap_ci(hits: int, n: int, iters: int = 2000, alpha: float = 0.05, seed: int = 0) -> tuple[float, float]:
    """Percentile interval of a hit rate, resampled on the driver (two numbers
    per engine go in). All ``n`` fields are drawn ``iters`` times; draws are
    counted in pieces of ``DRAWS``, which leaves the random stream as it is."""
    import numpy as np

    if not 0 <= hits <= n:
        raise ValueError(f"{hits} hits of {n}")
    if n == 0:
        return 0.0, 0.0
    rng = np.random.default_rng(seed)
    rates = np.zeros(iters)
    if n <= DRAWS:
        rows = DRAWS // n
        for i in range(0, iters, rows):
            rates[i : i + rows] = np.count_nonzero(rng.integers(0, n, size=(min(rows, iters - i), n)) < hits, axis=1) / n
    else:
        for i in range(iters):
            rates[i] = sum(np.count_nonzero(rng.integers(0, n, size=min(DRAWS, n - k)) < hits) for k in range(0, n, DRAWS)) / n
    low, high = np.percentile(rates, [100 * alpha / 2, 100 * (1 - alpha / 2)])
    return float(low), float(high)


def compare_engines(extracted: DataFrame, expected: DataFrame) -> list[dict]:
    """One row per engine of ``extracted``: matches, fields, rate, interval, and whether documents are too few."""
    key = [*_KEY, "field_code"]
    engines = extracted.select("engine").distinct()
    wanted = expected.select(*key, "golden").crossJoin(F.broadcast(engines))  # a handful of engines
    joined = wanted.join(extracted.select(*key, "engine", "value"), [*key, "engine"], "left")
    docs = F.count_distinct(*_KEY)
    rows = joined.groupBy("engine").agg(F.count_if(F.col("golden") == F.col("value")).alias("matches"), F.count(F.lit(1)).alias("n"), docs.alias("n_docs")).orderBy("engine").collect()
    return [{**r.asDict(), "rate": r["matches"] / r["n"], "ci": bootstrap_ci(r["matches"], r["n"]), "too_few": r["n_docs"] < CREDIBLE_DOCS} for r in rows]

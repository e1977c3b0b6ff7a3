"""The exact-decimal, append-only store of reconciled figures, and its audit table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StoreError
from ..plans import schema as S


def flatten(results: DataFrame, jurisdictions: DataFrame, run_id: str, extracted_at: str) -> DataFrame:
    """Results as rows of the store. ``jurisdictions``: (bank, jurisdiction).
    run_id and extracted_at are given, never taken from a clock inside the plan."""
    joined = results.join(F.broadcast(jurisdictions.select("bank", "jurisdiction")), "bank", "left")
    box = F.col("bbox")
    return joined.select(
        "bank", "period", "jurisdiction", "template", F.col("field_code").alias("field"), "value", "unit", "ecl_basis", "floor_basis", "source_url",
        box["page"].alias("page"), box["x0"].alias("bbox_x0"), box["y0"].alias("bbox_y0"), box["x1"].alias("bbox_x1"), box["y1"].alias("bbox_y1"),
        "confidence", "validation_basis", "status", F.lit(extracted_at).alias("extracted_at"), F.lit(run_id).alias("run_id"),
    )


def inexact(value: Column) -> Column:
    """Whether a decimal would lose digits at the store's scale (Spark's cast would round in silence)."""
    # Both sides in one wide type: a comparison of (38,12) with (38,6) would itself round first.
    return value.isNotNull() & (value.cast(S.WIDE) != value.cast(S.STORED).cast(S.WIDE))


def to_stored(rows: DataFrame, quantise_confidence: bool = False) -> DataFrame:
    """Rows in the store's exact types. A figure with more than six decimals
    raises; a confidence too, unless ``quantise_confidence`` rounds it."""
    if quantise_confidence:
        rows = rows.withColumn("confidence", F.round("confidence", 6))
    lost = [F.when(inexact(F.col(n)), F.concat(F.lit(f"{n} "), F.col(n).cast("string"))) for n in ("value", "confidence")]
    what = F.concat_ws(", ", *lost)
    S.require(rows, what != "", StoreError, F.concat(what, F.lit(" has more than 6 decimals: "), F.concat_ws(" ", "bank", "period", "field")))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in S.DATASET.fields])


def exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def append(rows: DataFrame, path: str, partition: bool = False, quantise_confidence: bool = False) -> int:
    """Add rows to the store and return their number; nothing is deduplicated.

    A table on disk with another schema is an error (Spark would append in
    silence). No rows: nothing is written, not even an empty table.
    ``partition``: lay the table out by template and period, so that analytics
    prune what they do not ask for.
    """
    spark = rows.sparkSession
    rows = rows.persist()  # checked, counted and written
    try:
        stored = to_stored(rows, quantise_confidence)
        if exists(spark, path):
            found = spark.read.parquet(path).schema
            layout = sorted(S.DATASET.fields, key=lambda f: f.name) if partition else S.DATASET.fields
            now = sorted(found.fields, key=lambda f: f.name) if partition else found.fields
            if [(f.name, f.dataType.simpleString()) for f in now] != [(f.name, f.dataType.simpleString()) for f in layout]:
                raise StoreError(f"{path}: schema on disk is not the store's")
        n = stored.count()
        if n:
            writer = stored.write.mode("append")
            (writer.partitionBy("template", "period") if partition else writer).parquet(path)
        return n
    finally:
        rows.unpersist()


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The store; a missing one is an error, which an empty one is not."""
    try:
        return spark.read.schema(S.DATASET).parquet(path).select(*S.DATASET.names)
    except AnalysisException as e:
        raise FileNotFoundError(path) from e


def append_audit(results: DataFrame, path: str, run_id: str) -> None:
    """What the flat store leaves out: verbatim cell, mapping decision, engine values and every check."""
    results.select(*S.FILING, "field_code", "raw_text", "mapping", "engine_values", "checks", F.lit(run_id).alias("run_id")).write.mode("append").parquet(path)

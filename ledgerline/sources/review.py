"""The human review queue: flagged figures as JSON lines by run, resolutions
as events, and the latest state as a view over both."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ReviewError
from ..plans import schema as S

_TRIPLES = "array<array<string>>"
ITEM = f"bank string, period string, template string, field_code string, value string, unit string, raw_text string, engine_values map<string,string>, source_url string, page int, bbox struct<x0:double,y0:double,x1:double,y1:double>, checks {_TRIPLES}, status string, confidence string, run_id string, note string"
_DECIMAL = r"^-?[0-9]+(\.[0-9]+)?$"


def queue_items(results: DataFrame, run_id: str) -> DataFrame:
    """Flagged results as queue items; decimals are strings, so none passes through a float."""
    box = F.col("bbox")
    flagged = results.filter("status = 'FLAGGED'")
    item = F.struct(
        "bank", "period", "template", "field_code", S.plain_number(F.col("value")).alias("value"), "unit", "raw_text",
        F.transform_values("engine_values", lambda k, v: S.plain_number(v)).alias("engine_values"), "source_url", box["page"].alias("page"),
        F.when(box.isNotNull(), F.struct(box["x0"].alias("x0"), box["y0"].alias("y0"), box["x1"].alias("x1"), box["y1"].alias("y1"))).alias("bbox"),
        F.transform("checks", lambda c: F.array(c["check_type"], c["outcome"], c["detail"])).alias("checks"), "status",
        S.plain_number(F.col("confidence")).alias("confidence"), F.lit(run_id).alias("run_id"), F.lit("").alias("note"),
    )
    return flagged.select(F.to_json(item, {"ignoreNullFields": "false"}).alias("value"), F.lit(run_id).alias("run_id"))


def enqueue(results: DataFrame, path: str, run_id: str) -> int:
    """Append a run's flagged figures; without any, no file is written."""
    items = queue_items(results, run_id).persist()  # counted and written
    try:
        n = items.count()
        if n:
            items.write.mode("append").partitionBy("run_id").text(path)
        return n
    finally:
        items.unpersist()


def load(spark: SparkSession, path: str) -> DataFrame:
    """Every queued item with its file's time (newest first when ordered by
    it). A bare JSON number where a decimal string belongs is an error:
    ``from_json`` alone would take it."""
    try:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_modification_time").alias("queued_at"))
    except AnalysisException:
        return spark.createDataFrame([], ITEM + ", queued_at timestamp")
    variant = F.try_parse_json("value")
    kind = lambda p: F.coalesce(F.schema_of_variant(F.try_variant_get(variant, p, "variant")), F.lit("STRING"))
    engines = F.coalesce(F.schema_of_variant(F.try_variant_get(variant, "$.engine_values", "variant")), F.lit(""))
    bad = variant.isNull() | (kind("$.value") != "STRING") | (kind("$.confidence") != "STRING") | engines.rlike(r"(DECIMAL|BIGINT|DOUBLE)")
    S.require(lines, bad, ReviewError, F.concat(F.lit("not a queue item with decimal strings: "), F.left("value", F.lit(120))))
    items = lines.select(F.from_json("value", ITEM).alias("i"), "queued_at").select("i.*", "queued_at")
    return S.require(items, ~F.coalesce(F.col("value").rlike(_DECIMAL), F.lit(False)), ReviewError, F.concat(F.lit("value is not a decimal: "), F.coalesce("value", F.lit("null"))))


EVENT = "run_id string, bank string, period string, field_code string, action string, corrected_value string, note string, resolved_at string"
KEY = ["run_id", "bank", "period", "field_code"]


def resolutions(spark: SparkSession, rows: list[dict], items: DataFrame | None = None) -> DataFrame:
    """Resolution events (run_id, bank, period, field_code, action confirm or
    correct, corrected_value, note, resolved_at). A correction needs a decimal
    value; a confirmation must not have one. ``items``: the queue, in which
    each event's run and field must stand."""
    for r in rows:
        if r["action"] not in ("confirm", "correct"):
            raise ReviewError(f"{r['field_code']}: unknown action {r['action']}")
        if (r["action"] == "correct") != (r.get("corrected_value") is not None):
            raise ReviewError(f"{r['field_code']}: a correction needs a value, a confirmation none")
    names = [c.split()[0] for c in EVENT.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], EVENT)
    if items is not None:
        S.require(df.join(items.select(*KEY).distinct(), KEY, "left_anti"), F.lit(True), ReviewError, F.concat(F.lit("not in the queue: "), F.concat_ws(" ", *KEY)))
    return S.require(df, F.col("corrected_value").isNotNull() & ~F.col("corrected_value").rlike(_DECIMAL), ReviewError, F.concat(F.lit("not a decimal: "), "corrected_value"))


def load_events(spark: SparkSession, path: str | None) -> DataFrame:
    """The resolution events under a path; a missing one has none."""
    try:
        return spark.read.schema(EVENT).parquet(path) if path else spark.createDataFrame([], EVENT)
    except AnalysisException:
        return spark.createDataFrame([], EVENT)


def resolved(items: DataFrame, events: DataFrame) -> DataFrame:
    """Items under their latest resolution: confirmed ones keep their value,
    corrected ones take the new one; unresolved ones stay flagged."""
    last = events.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("resolved_at"), F.desc("action")))).filter("__n = 1")
    joined = items.join(last.select(*KEY, "action", "corrected_value", F.col("note").alias("__note")), KEY, "left")
    status = F.when(F.col("action") == "confirm", "HUMAN_CONFIRMED").when(F.col("action") == "correct", "HUMAN_CORRECTED").otherwise(F.col("status"))
    return joined.withColumns({"status": status, "value": F.coalesce("corrected_value", "value"), "note": F.coalesce("__note", "note")}).drop("action", "corrected_value", "__note")


def write_back(dataset: DataFrame, settled: DataFrame) -> DataFrame:
    """The store's rows with human resolutions in place of flagged figures of
    the same run, so that analytics see them."""
    key = ["run_id", "bank", "period", F.col("field_code").alias("field")]
    human = settled.filter("status like 'HUMAN%'").select(*key, F.col("value").cast(S.STORED).alias("__v"), F.col("status").alias("__s"))
    joined = dataset.join(human, ["run_id", "bank", "period", "field"], "left")
    flagged = (F.col("status") == "FLAGGED") & F.col("__s").isNotNull()
    return joined.withColumns({"value": F.when(flagged, F.col("__v")).otherwise(F.col("value")), "status": F.when(flagged, F.col("__s")).otherwise(F.col("status"))}).select(*dataset.columns)


def _short(x: Column) -> Column:
    """A double as short as it reads."""
    return F.regexp_replace(F.call_function("format_number", x, F.lit("0.######")), r"\.0+$", "")


def render(items: DataFrame) -> DataFrame:
    """A ``card`` per item: what is doubted, why, and where to look."""
    b, entries = F.col("bbox"), F.map_entries("engine_values")
    readings = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(" "), e["value"])), " | ")
    differ = F.size(F.array_distinct(F.map_values("engine_values"))) > 1
    told = lambda c: F.concat_ws(": ", F.concat_ws(" ", c[0], c[1]), F.when(c[2] != "", c[2]))
    corner = lambda x, y: F.concat(F.lit("("), _short(b[x]), F.lit(", "), _short(b[y]), F.lit(")"))
    area = F.when(b.isNull(), F.lit("no box")).otherwise(F.concat(corner("x0", "y0"), F.lit(" to "), corner("x1", "y1")))
    lines = [
        F.concat(F.lit("["), F.col("status"), F.lit("] "), F.concat_ws(" / ", "bank", "period", "field_code", "run_id")),
        F.concat(F.lit("    "), F.concat_ws(" ", "value", "unit"), F.lit(" at confidence "), F.col("confidence"), F.lit(", from the cell '"), F.coalesce("raw_text", F.lit("")), F.lit("'")),
        F.concat(F.lit("    "), F.coalesce(F.concat(F.lit("page "), F.col("page").cast("string")), F.lit("no page")), F.lit(", "), area, F.lit(", "), F.coalesce("source_url", F.lit("no source"))),
        F.concat(F.lit("    read as "), F.when(F.size("engine_values") > 0, readings).otherwise("nothing by any engine"), F.when(differ, F.lit(" -- engines differ")).otherwise("")),
        F.array_join(F.transform("checks", lambda c: F.concat(F.lit("    - "), told(c))), "\n"),
        F.when(F.coalesce("note", F.lit("")) != "", F.concat(F.lit("    note: "), F.col("note"))),
    ]
    return items.withColumn("card", F.concat_ws("\n", *[F.when(line != "", line) for line in lines]))

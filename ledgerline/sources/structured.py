"""Structured filings (XBRL-CSV): datapoint and value by header name."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ExtractionError
from ..functions.numbers import parse_canonical, strip, to_canonical, unit_for
from ..plans import schema as S


def parse_filing(content: bytes) -> list[tuple[str | None, str | None, str | None]]:
    """(datapoint, value, error) rows of one CSV file; a file that breaks the
    contract is one row with its error."""
    import csv
    import io

    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return [(None, None, "not UTF-8")]
    rows = csv.reader(io.StringIO(text, newline=""))
    head = [h.strip() for h in next(rows, [])]
    if "datapoint" not in head or "value" not in head:
        return [(None, None, "header needs datapoint and value")]
    point, value = head.index("datapoint"), head.index("value")
    cell = lambda row, i: row[i] if i < len(row) and row[i] != "" else None
    out = [(cell(row, point), cell(row, value), None) for row in rows if row]
    return [(None, None, "blank datapoint")] if any(p is None or not p.strip() for p, _, _ in out) else out


def read_filings(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """(doc_id, datapoint, value) of every CSV file under ``path``, all text.

    Files must be UTF-8 with a header that names datapoint and value, in any
    order, and no blank datapoint. Each file is opened once, by the task it
    falls to. ``on_error``: 'raise' fails the job when the broken file is read,
    naming it; 'rows' adds a column ``error`` and a row for it. Spark's reader
    skips files without a byte if others are not empty.
    """
    if on_error not in ("raise", "rows"):
        raise ValueError(f"on_error: {on_error}")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string()] * 4
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(name, *r) for r in parse_filing(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=["doc_id", "datapoint", "value", "error"])

    found = files.mapInArrow(run, "doc_id string, datapoint string, value string, error string")
    if files.isEmpty():
        raise ExtractionError(f"{path}: no header, nothing but empty files")
    if on_error == "rows":
        return found
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("doc_id", F.lit(": "), "error"))).otherwise(F.col("doc_id"))
    return found.select(sound.alias("doc_id"), "datapoint", "value")


def field_values(filings: DataFrame, datapoints: DataFrame, template_fields: DataFrame, filing_of: DataFrame) -> DataFrame:
    """Canonical field values of filings (doc_id, datapoint, value).

    ``filing_of``: (doc_id, bank, period, reporting_currency, source_url). A
    blank datapoint raises when its row is read; an unmapped one is ignored; a value that is not a
    plain number leaves its field absent; a mapped field that the template
    lacks raises. Fractions become percentages.
    """
    spec = template_fields.select("template", F.col("code").alias("field_code"), "kind", F.col("ecl").alias("ecl_basis"), F.col("floor").alias("floor_basis"))
    known = datapoints.join(spec, ["template", "field_code"], "left")
    S.require(known, F.col("kind").isNull(), ExtractionError, F.concat("field_code", F.lit(": mapped, but not in the template")))
    blank = F.col("datapoint").isNull() | (strip(F.col("datapoint")) == "")
    point = F.when(blank, F.raise_error(F.concat("doc_id", F.lit(": blank datapoint")))).otherwise(strip(F.col("datapoint")))
    named = filings.withColumn("datapoint", point).join(F.broadcast(known), "datapoint")  # the map is configuration
    parsed = named.withColumn("__v", to_canonical(parse_canonical(F.col("value")), F.col("stored_as"))).filter("__v is not null")
    joined = parsed.join(filing_of, "doc_id")
    rule = F.struct(F.lit("RULE").alias("method"), *[F.lit(None).cast("string").alias(c) for c in ("model", "prompt_sha", "prompt_version")], F.col("datapoint").alias("matched_alias"), F.lit(1.0).alias("confidence"))
    out = joined.select(
        "bank", "period", "template", "doc_id", "field_code",
        F.col("__v").cast(S.COMPUTE).alias("value"),
        unit_for(F.col("kind"), F.col("reporting_currency")).alias("unit"),
        "ecl_basis", "floor_basis",
        F.lit("P3DH").alias("engine"), F.lit("XBRL_CSV").alias("source_kind"), "source_url",
        F.lit(None).cast(S.BBOX).alias("bbox"), F.lit("millions").alias("monetary_scale"),
        rule.alias("mapping"), F.col("value").alias("raw_text"),
        F.create_map(F.lit("P3DH"), F.col("__v").cast(S.COMPUTE)).alias("engine_values"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.FIELD_VALUES.fields])

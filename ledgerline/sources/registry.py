"""Content-addressed registry of fetched documents: a fully quoted CSV ledger
keyed by the content's SHA-256, and the raw files under their digests. The same
content is registered once; another document for the same bank and period is a
new version."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import RegistryError
from ..functions.periods import is_period
from ..plans import schema as S
from .files import write_atomically

MANIFEST = ["bank_id", "period", "template", "url", "sha256", "source_kind", "local_path", "status", "fetched_at"]


def extension(source_kind: Column, url: Column) -> Column:
    suffix = F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]{1,5})(?:[?#].*)?$", 1))
    return F.when(source_kind == "PDF", "pdf").when(source_kind == "XBRL_CSV", "csv").when(suffix != "", suffix).otherwise("bin")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; a missing one is empty, a malformed line an error."""
    ddl = ", ".join(f"{c} string" for c in MANIFEST)
    try:
        raw = spark.read.schema(ddl + ", _bad string").option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    except AnalysisException:
        return spark.createDataFrame([], ddl)
    S.require(raw, F.col("_bad").isNotNull() | ~is_period(F.col("period")) | F.col("sha256").isNull(), RegistryError, F.concat(F.lit("malformed ledger line: "), F.coalesce("_bad", F.concat_ws(",", "bank_id", "period", "url"))))
    return raw.drop("_bad")


def register(manifest: DataFrame, incoming: DataFrame, store_dir: str, fetched_at: str) -> DataFrame:
    """Ledger rows for (content, bank_id, period, template, url, source_kind),
    with status ``fetched`` for new content and ``skipped_dup`` for content
    that the ledger (whatever its status there) or an earlier row (by bank,
    period, url) holds; the latter carry the path of the first. Nothing is
    written: see ``ingest``."""
    named = incoming.withColumn("sha256", F.sha2("content", 256)).drop("content")
    placed = named.withColumn("local_path", F.concat(F.lit(store_dir.rstrip("/") + "/"), F.col("sha256"), F.lit("."), extension(F.col("source_kind"), F.col("url"))))
    known = manifest.groupBy("sha256").agg(F.min("local_path").alias("__have"))
    same = Window.partitionBy("sha256").orderBy("bank_id", "period", "url")
    joined = placed.join(known, "sha256", "left").withColumn("__n", F.row_number().over(same)).withColumn("__first", F.first("local_path").over(same))
    new = F.col("__have").isNull() & (F.col("__n") == 1)
    return joined.select("bank_id", "period", "template", "url", "sha256", "source_kind", F.coalesce("__have", "__first").alias("local_path"), F.when(new, "fetched").otherwise("skipped_dup").alias("status"), F.lit(fetched_at).alias("fetched_at")).select(*MANIFEST)


def fresh(incoming: DataFrame, rows: DataFrame) -> DataFrame:
    """The incoming documents that ``rows`` registers as new, with sha256 and local_path."""
    new = rows.filter("status = 'fetched'").select(*[F.col(c).alias(f"__{c}") for c in ("sha256", "bank_id", "period", "url")], "local_path")
    marked = incoming.withColumn("sha256", F.sha2("content", 256))
    same = marked["sha256"] == new["__sha256"]
    for c in ("bank_id", "period", "url"):
        same = same & marked[c].eqNullSafe(new[f"__{c}"])
    # Rows equal in all four are one document.
    return marked.join(new, same).drop("__sha256", "__bank_id", "__period", "__url").dropDuplicates(["sha256"])


def store_content(documents: DataFrame) -> int:
    """Write each document's content to its local_path, where the documents
    lie; returns their number. Content under a digest never changes, so a
    second write of a path is the same file."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = [write_atomically(path, iter([content.as_py()])) for path, content in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["bytes"])

    return documents.select("local_path", "content").mapInArrow(run, "bytes bigint").count()


def append(rows: DataFrame, path: str) -> None:
    """Add new content's rows to the ledger; repeats leave it as it is."""
    fetched = rows.filter("status = 'fetched'").select(*[F.coalesce(c, F.lit("")).alias(c) if c == "template" else c for c in MANIFEST])
    if not fetched.isEmpty():
        fetched.write.mode("append").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def ingest(incoming: DataFrame, manifest_path: str, store_dir: str, fetched_at: str) -> DataFrame:
    """Register documents, keep their bytes under ``store_dir`` and add them to
    the ledger; returns the ledger rows. Bytes are written before the ledger
    names them, so a failure between the two leaves no dangling row."""
    spark = incoming.sparkSession
    rows = register(scan(spark, manifest_path), incoming, store_dir, fetched_at)
    done = rows.collect()  # one narrow row per document of the batch
    settled = spark.createDataFrame(done, rows.schema)
    store_content(fresh(incoming, settled))
    append(settled, manifest_path)
    return settled


def rewrite(rows: DataFrame, path: str) -> None:
    """Replace the ledger under the job commit protocol."""
    rows.select(*MANIFEST).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def incoming_files(spark: SparkSession, path: str, bank_id: str, period: str, template: str | None, source_kind: str) -> DataFrame:
    """Files as rows to register, the path as their url."""
    lit = lambda x: F.lit(x).cast("string")
    return spark.read.format("binaryFile").load(path).select("content", lit(bank_id).alias("bank_id"), lit(period).alias("period"), lit(template).alias("template"), F.col("path").alias("url"), lit(source_kind).alias("source_kind"))

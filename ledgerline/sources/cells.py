"""The cell contract: what table extractors hand over, one row per cell.

Extractors are driver- or worker-side libraries outside Spark's scope; any of
them fits that yields the relation ``schema.CELLS``. Here are the checked
conversions from the three usual shapes of extractor output.
"""

from __future__ import annotations

import importlib.util
import shutil
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ExtractionError
from ..plans import schema as S

#: Second engines in the order in which they are preferred.
PRIORITY = ["lattice", "stream", "pdfplumber"]


def finite(*values: Column) -> Column:
    out = F.lit(True)
    for v in values:
        out = out & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return out


def _checked(cells: DataFrame) -> DataFrame:
    b = F.col("bbox")
    return S.require(cells, ~finite(b["x0"], b["y0"], b["x1"], b["y1"]), ExtractionError, F.format_string("cell (%d,%d) of %s has no finite box", "row_idx", "col_idx", "doc_id"))


def _as_cells(df: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.withColumns({"row_label": none, "col_label": none}).select(*[F.col(f.name).cast(f.dataType) for f in S.CELLS.fields])


def from_boxed(df: DataFrame, pages: Iterable[int] | None = None) -> DataFrame:
    """Cells whose boxes have a top-left origin (doc_id, engine, table_idx,
    row_idx, col_idx, text, page, x0, y0, x1, y1). A missing or non-finite
    coordinate raises; ``pages``: a 1-based subset; no cells at all raise."""
    kept = df if pages is None else df.filter(F.col("page").isin(list(pages)))
    cells = _as_cells(kept.withColumn("bbox", F.struct("page", "x0", "y0", "x1", "y1")).withColumn("text", F.coalesce("text", F.lit(""))))
    if cells.isEmpty():
        raise ExtractionError("no tables")
    return _checked(cells)


def from_bottom_up(df: DataFrame, pages: Iterable[int] | None = None) -> DataFrame:
    """Cells with a bottom-left origin (x1, y1, x2, y2, page_height): turned upside down."""
    h = F.col("page_height")
    turned = df.select("doc_id", "engine", "table_idx", "row_idx", "col_idx", "text", "page", F.col("x1").alias("x0"), (h - F.col("y2")).alias("y0"), F.col("x2").alias("x1"), (h - F.col("y1")).alias("y1"))
    return from_boxed(turned, pages)


def from_ragged(df: DataFrame, pages: Iterable[int] | None = None) -> DataFrame:
    """Cells of ragged tables: those without a box are gaps and left out; null texts are empty."""
    return from_boxed(df.filter(F.col("x0").isNotNull()), pages)


def flatten(cells: DataFrame) -> DataFrame:
    """All tables' cells as one group."""
    return cells.drop("table_idx")


def pick_secondary(tables: DataFrame) -> DataFrame:
    """(doc_id, flavour): of (doc_id, flavour, page, table_idx) the preferred
    second engine that finds a table on page 1, the last resort otherwise."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("flavour")), F.lit(99))
    found = tables.groupBy("doc_id", "flavour").agg(F.count_distinct(F.when(F.col("page") == 1, F.col("table_idx"))).alias("n"))
    usable = found.filter((F.col("n") > 0) | (F.col("flavour") == PRIORITY[-1]))
    first = Window.partitionBy("doc_id").orderBy(rank)
    return usable.withColumn("__n", F.row_number().over(first)).filter("__n = 1").select("doc_id", "flavour")


def available_engines() -> dict[str, bool]:
    """Which extractor libraries this Python has; lattice tables also need Ghostscript."""
    has = lambda m: importlib.util.find_spec(m) is not None
    return {"docling": has("docling"), "lattice": has("camelot") and shutil.which("gs") is not None, "stream": has("camelot"), "pdfplumber": has("pdfplumber")}


def extract(spark: SparkSession, path: str, engine: Callable[[str, bytes], Iterable[dict]]) -> DataFrame:
    """Run an injected extractor over files where they lie. ``engine`` takes
    (path, content) and yields rows of the cell relation."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = list(engine(name, bytes(content)))
                if rows:
                    yield pd.DataFrame(rows, columns=[f.name for f in S.CELLS.fields])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, S.CELLS)

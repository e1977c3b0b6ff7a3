"""Peer rankings, trends and sweeps' tallies over the store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import StoreError
from ..functions.periods import period_ord
from ..plans import schema as S
from ..sources import xlsx


def assert_known_statuses(dataset: DataFrame) -> None:
    """Every row of the store, whatever is asked for, must have a known status."""
    S.require(dataset, F.col("status").isNull() | ~F.col("status").isin(S.STATUSES), StoreError, F.concat(F.lit("unknown status "), F.coalesce("status", F.lit("null"))))


def _validated(dataset: DataFrame, statuses: Iterable[str]) -> DataFrame:
    assert_known_statuses(dataset)
    return dataset.filter(F.col("status").isin(list(statuses)))


def latest_run_only(dataset: DataFrame) -> DataFrame:
    """Of repeated figures of a bank and period those of the latest run."""
    w = Window.partitionBy("bank", "period", "template", "field").orderBy(F.desc("extracted_at"), F.desc("run_id"))
    return dataset.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def peer_compare(dataset: DataFrame, field: str, period: str, statuses: Iterable[str] = tuple(S.VALIDATED)) -> DataFrame:
    """Banks by value, largest first, ties by bank; with their rank."""
    rows = _validated(dataset, statuses).filter((F.col("field") == field) & (F.col("period") == period))
    ranked = rows.select("bank", "period", "field", "value", "unit", "status", F.rank().over(Window.partitionBy("field", "period").orderBy(F.desc("value"))).alias("rank"))
    return ranked.orderBy(F.desc("value"), "bank")


def trend(dataset: DataFrame, bank: str | None, field: str, statuses: Iterable[str] = tuple(S.VALIDATED)) -> DataFrame:
    """A field over time with the change from the previous validated period;
    a quarter left out by its status is spanned. ``bank=None``: all banks.
    Rows of one period keep the order of their runs."""
    rows = _validated(dataset, statuses).filter(F.col("field") == field)
    rows = rows if bank is None else rows.filter(F.col("bank") == bank)
    w = Window.partitionBy("bank", "field").orderBy(period_ord(F.col("period")), "extracted_at", "run_id")
    return rows.select("bank", "field", "period", "value", "unit", "status", (F.col("value") - F.lag("value").over(w)).alias("delta"), period_ord(F.col("period")).alias("period_ord")).orderBy("bank", "period_ord")


def tallies(results: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(bank, n_auto_passed, n_flagged, error): a sweep's outcome per filing bank; failed files are rows with an error."""
    good = results.groupBy("bank").agg(F.count_if(F.col("status") == "AUTO_PASSED").alias("n_auto_passed"), F.count_if(F.col("status") == "FLAGGED").alias("n_flagged")).withColumn("error", F.lit(None).cast("string"))
    if errors is None:
        return good
    zero = F.lit(0).cast("bigint")
    return good.unionByName(errors.select("bank", zero.alias("n_auto_passed"), zero.alias("n_flagged"), "error"))


def safe_title(text):
    """A sheet title: characters that sheets forbid become underscores, 31 at most."""
    return F.left(F.translate(text, r"[]:*?/" + "\\", "_______"), F.lit(31))


def sheet_name(code: str) -> str:
    """``safe_title`` of one name on the driver."""
    return "".join("_" if c in "[]:*?/\\" else c for c in code)[:31]


def export(rows: dict[str, DataFrame], path: str) -> list[str]:
    """Write one table per field code for display: a workbook if the path ends
    in .xlsx, else a CSV folder per code. No codes: an error; no rows: a header."""
    if not rows:
        raise ValueError("no field codes to export")
    if path.endswith(".xlsx"):
        xlsx.write(path, [(sheet_name(code), df.columns, df.toLocalIterator()) for code, df in rows.items()])
        return [path]
    out = []
    for code, df in rows.items():
        target = f"{path.rstrip('/')}/{sheet_name(code)}"
        shown = df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else f.name for f in df.schema.fields])
        shown.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
        out.append(target)
    return out

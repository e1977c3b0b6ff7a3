"""Documents by address: fetched by tasks, held against a pinned digest."""

from __future__ import annotations

import hashlib
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMEOUT_SECONDS = 60
AGENT = "ledgerline"


def download(url: str, pinned: str | None) -> tuple[bytes | None, str | None]:
    """(content, error) of one address."""
    try:
        request = urllib.request.Request(url, headers={"User-Agent": AGENT})
        with urllib.request.urlopen(request, timeout=TIMEOUT_SECONDS) as answer:  # http, https and file addresses
            content = answer.read()
    except (OSError, ValueError) as e:  # URLError and timeouts are OSErrors
        return None, f"not fetched: {e}"
    found = hashlib.sha256(content).hexdigest()
    if pinned is not None and found != pinned.lower():
        return None, f"sha256 is {found}, not {pinned.lower()}"
    return content, None


def fetch(requests: DataFrame, parallel: int = 8) -> DataFrame:
    """``requests`` (url, sha256 pinned or null, and any other columns but
    content and error) with ``content`` and ``error``, of which one is null.

    Each address is fetched by the task that it falls to, ``parallel`` at a
    time. A document that differs from its pinned digest is an error, never
    content. The result is lazy: write it, or hand it to ``registry.ingest``,
    once.
    """
    other = [c for c in requests.columns if c not in ("url", "sha256", "content", "error")]
    source = requests.select("url", F.col("sha256").cast("string").alias("sha256"), *other).repartition(parallel)
    schema = T.StructType([*source.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):  # one document in memory at a time
                content, error = download(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([content], pa.binary()), pa.array([error], pa.string())], names=[*batch.schema.names, "content", "error"])

    return source.mapInArrow(run, schema)

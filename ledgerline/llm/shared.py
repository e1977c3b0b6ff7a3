"""What the operators of this subpackage share: the shared folder, scratch
tables, checked lookups and raw file access from executors.

Executors may vanish at any time and do not see each other's disks, so
lineage is cut only through tables in the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import filesystem, write_atomically  # noqa: F401  shared with the operators

#: A lookup side with at most this many rows is broadcast; a larger one is joined by exchange.
LOOKUP_ROWS = 50_000

_local_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a purely local session (tests) may lack the setting; it then gets a
    temporary folder, removed at its end. On a cluster a missing setting is an error, as a
    machine-local folder would lose data there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        folder = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_root[app] = "file://" + folder
    return _local_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the application ends."""
    path = f"{shared_root(spark)}/ledgerline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and
    gives later plans a side of known size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that very long texts do not pile up by the
    thousand. Results are evaluated after an operator has returned, so the two
    settings stay in the session; limits that are already tighter are left."""
    for name, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def equal_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys: a null key is a group like any other."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def lookup_join(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left", limit: int = LOOKUP_ROWS) -> DataFrame:
    """Join ``df`` to a materialised lookup ``table``, null-safe on ``keys``.

    The table is broadcast only if it has at most ``limit`` rows (counted, and
    counted no further than that); beyond, Spark's exchange join takes over,
    whose hot keys adaptive execution splits.
    """
    few = table.limit(limit + 1).count() <= limit
    renamed = table.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    on = reduce(lambda a, b: a & b, (df[k].eqNullSafe(renamed[f"__key_{k}"]) for k in keys))
    joined = df.join(F.broadcast(renamed) if few else renamed, on, how)
    return joined.drop(*[f"__key_{k}" for k in keys])


def replace_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns that an operator is about to define itself."""
    clash = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in clash])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under column names that clash with nothing, and the new name of
    each old one."""
    held = [f"__col_{i}" for i in range(len(df.columns))]
    return df.toDF(*held), dict(zip(df.columns, held))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

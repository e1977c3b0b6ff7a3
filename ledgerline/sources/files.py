"""Raw files of a shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator


def filesystem(uri: str):
    """A pyarrow file system and path for a URI of the shared folder (local
    paths, hdfs://, s3://, gs:// as far as pyarrow is built with them)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_atomically(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file under a private name and rename it, so that a retried or
    speculative task leaves either nothing or a whole file. Returns its bytes.

    A name that exists already holds what another attempt of the same task
    wrote from the same rows: it is replaced where the file system replaces on
    rename, and left where it refuses. The private file is removed whatever
    happens, unless the executor is lost.
    """
    store, path = filesystem(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    tmp, n = f"{path}.{uuid.uuid4().hex}.part", 0
    try:
        with store.open_output_stream(tmp) as out:
            for chunk in chunks:
                out.write(chunk)
                n += len(chunk)
        try:
            store.move(tmp, path)
        except OSError:
            if not is_file(store, path):
                raise
    finally:
        if is_file(store, tmp):
            store.delete_file(tmp)
    return n


def is_file(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type == fs.FileType.File


def scratch_folder(spark, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, deleted when the application
    ends. Only a purely local session may lack the setting: a machine-local
    folder would lose data on a cluster."""
    import tempfile

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.gettempdir()
    path = f"{root.rstrip('/')}/ledgerline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path

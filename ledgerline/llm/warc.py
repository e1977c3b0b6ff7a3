"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of some hundred KB. A bundle ends
with two skippable frames: an index that maps record identifiers to frame and
frame-relative offset, and the seek table of the seekable format (compressed
and decompressed size of every frame, then the number of frames and the magic
number), so a reader finds any record with two small reads at the end and the
decompression of one frame, and any Zstandard tool still reads the whole.

Payloads that repeat are stored once, as the response record with the largest
page id; the others are revisit records that refer to it. Record identifiers
are UUIDs of page, payload and place; a response that may be referred to has
that of page and payload alone, so rows equal in both are one record, written
twice. The page id has a header of its own.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filesystem, lookup_join, materialise, replace_columns, scratch_path, small_batches, write_atomically

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 1 << 30
#: Payloads below this many bytes are always stored whole.
REVISIT_BYTES = 1000
#: Date of records whose table has none: fixed, so that archives are the same in every run.
DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:ledgerline:warc")

#: Fixed by the Zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_INDEX_MAGIC = b"LLWARCIX"
_NONE = -(1 << 63)


def record_types(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``payload`` (UTF-8; null: empty), ``payload_digest`` (SHA-1),
    ``record_type`` and ``refers_to``.

    Rows that repeat the largest identifier of a payload are all responses; a
    null identifier is smaller than any other. Columns named like the results
    are replaced. Payloads are taken whole, however long.
    """
    pages = replace_columns(pages, ["payload", "payload_digest", "record_type", "refers_to", "__keeper"])
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    digest, size = F.sha1(payload), F.octet_length(payload)
    groups = pages.select(F.col(id_col).cast("bigint").alias("id"), digest.alias("payload_digest"), size.alias("n")).filter(F.col("n") >= least)
    kept = groups.groupBy("payload_digest").agg(F.max("id").alias("__keeper"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    kept = materialise(kept, "warc-repeats")
    marked = lookup_join(pages.withColumns({"payload": payload, "payload_digest": digest}), kept, ["payload_digest"])
    revisit = F.coalesce((F.octet_length("payload") >= least) & F.col("__keeper").isNotNull() & ~F.col(id_col).cast("bigint").eqNullSafe(F.col("__keeper")), F.lit(False))
    return marked.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("__keeper"))}).drop("__keeper")


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(map(str, parts)))}>"


def _lines(fields: list[tuple[str, object]]) -> bytes:
    return "\r\n".join(["WARC/1.1", *[f"{k}: {v}" for k, v in fields], "", ""]).encode()


def _record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers: int | None, place: str = "", date: str = DATE, least: int = REVISIT_BYTES) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload if kind == "response" else http + b"\r\n"
    own = _urn(page, digest) if kind == "response" and len(payload) >= least else _urn(page, digest, kind, place)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c not in "\r\n" else f"%{ord(c):02X}" for c in url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload))]
    if page is not None:
        fields.append(("X-Page-ID", page))
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(refers, digest)), ("X-Refers-To-Page-ID", refers)]
    return _lines([*fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def _warcinfo(place: str, date: str) -> bytes:
    block = b"software: ledgerline\r\nformat: WARC File Format 1.1\r\n"
    return _lines([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn("warcinfo", place)), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class BundleWriter:
    """Chunks of one bundle's bytes as records come in, after ``head``."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, head: bytes = b""):
        import zstandard

        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.frame_bytes = frame_bytes
        self.open, self.open_size, self.frames, self.places, self.written = [head], len(head), [], [], 0

    def add(self, page: int | None, record: bytes) -> bytes:
        self.places.append((_NONE if page is None else page, len(self.frames), self.open_size, len(record)))
        self.open.append(record)
        self.open_size += len(record)
        return self._close() if self.open_size >= self.frame_bytes else b""

    def _close(self) -> bytes:
        if not self.open_size:
            return b""
        frame = self.zstd.compress(b"".join(self.open))
        self.frames.append((len(frame), self.open_size))
        self.open, self.open_size = [], 0
        self.written += len(frame)
        return frame

    def finish(self) -> bytes:
        """The last frame and the footer."""
        last = self._close()
        places = sorted(self.places)
        body = _INDEX_MAGIC + struct.pack("<Q", len(places)) + b"".join(struct.pack("<qIQQ", *p) for p in places)
        index = _skippable(SKIPPABLE_INDEX, body)
        table = b"".join(struct.pack("<II", *f) for f in [*self.frames, (len(index), 0)])
        return last + index + _skippable(SKIPPABLE_SEEK, table + struct.pack("<IBI", len(self.frames) + 1, 0, SEEK_MAGIC))


class Bundle:
    """Random access to a bundle through its footer."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        self.uri, self.file = uri, store.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{uri}: no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, plain))
            at += packed

    def index(self) -> list[tuple[int, int, int, int]]:
        """(identifier, frame, offset in the frame, bytes), by identifier."""
        at, packed, _ = self.frames[-1]
        body = self.file.read_at(packed, at)[8:]
        if body[:8] != _INDEX_MAGIC:
            raise ValueError(f"{self.uri}: no record index")
        return list(struct.iter_unpack("<qIQQ", body[16:]))

    def frame(self, k: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=max(plain, 1))

    def get(self, page: int | None) -> list[dict]:
        """All records of an identifier."""
        from bisect import bisect_left

        places, key = self.index(), _NONE if page is None else page
        i, out = bisect_left(places, (key,)), []
        while i < len(places) and places[i][0] == key:
            _, k, offset, n = places[i]
            out.append(parse(self.frame(k)[offset : offset + n]))
            i += 1
        return out


def parse(record: bytes) -> dict:
    """A record's headers as the table needs them, and its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    number = lambda x: None if x is None else int(x)
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest, n = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if payload is not None and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    return {"record_id": fields["WARC-Record-ID"], "page_id": number(fields.get("X-Page-ID")), "url": fields.get("WARC-Target-URI"), "payload": payload, "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("X-Refers-To-Page-ID")), "refers_to_record": fields.get("WARC-Refers-To")}


def write(pages: DataFrame, uri: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write every page's record into bundles below ``uri`` (default: the
    shared folder) where the pages lie, and return the manifest (path,
    n_records). Each bundle begins with a warcinfo record, which n_records
    leaves out. An empty table makes no bundle."""
    small_batches(pages.sparkSession)
    uri = uri or scratch_path(pages.sparkSession, "warc")
    marked = record_types(pages, id_col, html_col).select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), "payload", "payload_digest", "record_type", "refers_to")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(6)]))
        row, k = next(rows, None), 0
        while row is not None:
            place = f"part-{part:06d}-{k:04d}"
            bundle = BundleWriter(frame_bytes, _warcinfo(place, date))

            def chunks() -> Iterator[bytes]:
                nonlocal row
                while row is not None and bundle.written < bundle_bytes:
                    yield bundle.add(row[0], _record(*row, f"{place}/{len(bundle.places)}", date))
                    row = next(rows, None)
                yield bundle.finish()

            path = f"{uri}/{place}.warc.zst"
            write_atomically(path, chunks())
            k += 1
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(bundle.places)], pa.int64())], names=["path", "n_records"])

    return materialise(marked.mapInArrow(run, "path string, n_records bigint"), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every page's record of the bundles, found through their footers:
    (record_id, page_id, url, payload (null for revisits), payload_bytes,
    payload_digest, record_type, refers_to, refers_to_record)."""
    small_batches(manifest.sparkSession)
    bundles = manifest.select("path").repartition(max(1, manifest.count()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_to_record", pa.string())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                bundle = Bundle(path)
                by_frame: dict[int, list] = {}
                for _, k, offset, n in bundle.index():
                    by_frame.setdefault(k, []).append((offset, n))
                for k, places in sorted(by_frame.items()):
                    data = bundle.frame(k)
                    yield pa.RecordBatch.from_pylist([parse(data[o : o + n]) for o, n in sorted(places)], schema=schema)

    return bundles.mapInArrow(run, "record_id string, page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, refers_to_record string")

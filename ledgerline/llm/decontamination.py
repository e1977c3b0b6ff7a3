"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: each segment (some MB of text) holds a
dictionary of its words and, per word, the ascending list of slots at which
it occurs (positions in the segment's word stream). It is stored as a table
in the shared folder and serves any number of benchmarks.

A search writes the benchmark's windows into files of bounded size in the
shared folder, which every task streams past its segments one at a time: the
driver holds their paths only, a task one file, and the index is read once
however many there are. Within a segment only windows all of whose words occur
there are looked at. Each starts from its rarest word: that word's slots minus
its offset are candidate starts, which are intersected with the
offset-adjusted lists of the other words, rarest first. What remains is an
exact phrase match; with ``slop`` > 0 a word may lie that many words off its
place, a proximity match. No posting and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filesystem, materialise, numbered, scratch_path, small_batches, write_atomically

WINDOW = 13
#: Text bytes a segment gathers before it is indexed; a longer document is a segment by itself.
SEGMENT_BYTES = 8 << 20
#: Text bytes of benchmark items in one file (or one item); more items make more files.
BLOCK_BYTES = 16 << 20
SLOP = 2

#: A-Z to a-z; digits, letters and all bytes of non-ASCII characters kept; all else parts words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_INDEX_SCHEMA = "segment string, doc_ids array<bigint>, hashes array<bigint>, n_words array<int>, terms binary, term_ends binary, counts binary, postings binary"


def tokens(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def _pack(values) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, kind: str):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _segment(name: str, ids: list, hashes: list, texts: list) -> list:
    """One index row."""
    import numpy as np
    import pyarrow as pa

    words, lengths = [], []
    for t in texts:
        w = tokens(t)
        words.extend(w)
        lengths.append(len(w))
    coded = pa.array(words, pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    terms = coded.dictionary.to_pylist()
    slots = np.argsort(code, kind="stable").astype(np.int32)
    counts = np.bincount(code, minlength=len(terms)).astype(np.int32)
    starts = np.cumsum(counts) - counts
    gaps = np.diff(slots, prepend=np.int32(0)).astype(np.int32)
    gaps[starts] = slots[starts]  # each list starts anew
    ends = np.cumsum([len(t) for t in terms], dtype=np.int64) if terms else np.zeros(0, np.int64)
    return [name, ids, hashes, lengths, _pack(np.frombuffer(b"".join(terms), np.uint8)), _pack(ends), _pack(counts), _pack(gaps)]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored index of all documents, one row per segment. Null and
    wordless texts are in it with no words; null ids are kept as null."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col)), F.col(text_col).cast("binary"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 4]
        names = ["segment", "doc_ids", "hashes", "n_words", "terms", "term_ends", "counts", "postings"]

        def row(ids, hashes, texts):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(_segment(f"{part}-{k}", ids, hashes, texts), kinds)], names=names)

        ids, hashes, texts, size = [], [], [], 0
        for batch in batches:
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                t = t.as_py()
                if ids and size + len(t or b"") > segment_bytes:
                    yield row(ids, hashes, texts)
                    ids, hashes, texts, size, k = [], [], [], 0, k + 1
                ids.append(i)
                hashes.append(h)
                texts.append(t)
                size += len(t or b"")
        if ids:
            yield row(ids, hashes, texts)

    return materialise(source.mapInArrow(run, _INDEX_SCHEMA), "postings")


def windows_of(text: bytes | None, width: int = WINDOW) -> list[list[bytes]]:
    """Runs of ``width`` words; an item of fewer, but not none, is one window."""
    w = tokens(text)
    return [w[i : i + width] for i in range(max(1, len(w) - width + 1))] if w else []


def _block_bytes(items: list[tuple[int | None, bytes | None]]) -> bytes:
    """A file of items: their ids and lengths, their words by number, and the words."""
    import numpy as np
    import pyarrow as pa

    split = [tokens(text) for _, text in items]
    coded = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
    table = {
        "ids": pa.array([[i for i, _ in items]], pa.list_(pa.int64())),
        "sizes": pa.array([[len(w) for w in split]], pa.list_(pa.int64())),
        "codes": pa.array([coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)], pa.list_(pa.int32())),
        "terms": pa.array([coded.dictionary.to_pylist()], pa.list_(pa.binary())),
    }
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(table)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Queries:
    """The windows of a file as arrays: words by number, per window its words and its items."""

    def __init__(self, data: bytes, width: int):
        import numpy as np
        import pyarrow as pa

        row = pa.ipc.open_stream(data).read_next_batch()
        column = lambda name: row.column(name).values
        self.terms = column("terms").cast(pa.large_binary())
        sizes, codes = column("sizes").to_numpy(), column("codes").to_numpy().astype(np.int64)
        self.width = width
        begins = np.cumsum(sizes) - sizes
        per = np.where(sizes > 0, np.maximum(1, sizes - width + 1), 0)  # windows of each item
        owner = np.repeat(np.arange(len(sizes)), per)
        at = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + np.repeat(begins, per)
        lengths = np.minimum(sizes[owner], width)
        place = at[:, None] + np.arange(width)
        inside = np.arange(width) < lengths[:, None]
        words = np.where(inside, np.append(codes, -1)[np.where(inside, place, -1)], -1)
        self.words, which = np.unique(words, axis=0, return_inverse=True) if len(words) else (words, np.zeros(0, np.int64))
        self.lengths = (self.words >= 0).sum(axis=1)
        ids = column("ids").to_pylist()
        self.items: list[set] = [set() for _ in self.lengths]
        for w, o in zip(which.ravel().tolist(), owner.tolist()):
            if ids[o] is not None:
                self.items[w].add(ids[o])


#: The file read last in this Python process: of a benchmark of one file every task parses it once per worker.
_last: dict[tuple, _Queries] = {}


def _queries(uri: str, width: int) -> _Queries:
    if (uri, width) not in _last:
        store, path = filesystem(uri)
        with store.open_input_stream(path) as f:
            found = _Queries(f.read(), width)
        _last.clear()
        _last[uri, width] = found
    return _last[uri, width]


def store_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Write the benchmark into files of at most ``block_bytes`` of text (or one item); their paths."""
    small_batches(items.sparkSession)
    folder = scratch_path(items.sparkSession, "benchmark")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, k, block, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            path = f"{folder}/items-{part:06d}-{k:06d}"
            write_atomically(path, iter([_block_bytes(block)]))
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if block and size + len(text or b"") > block_bytes:
                    yield close()
                    block, size, k = [], 0, k + 1
                block.append((i, text))
                size += len(text or b"")
        if block:
            yield close()

    source = items.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary"))
    return sorted(r["path"] for r in materialise(source.mapInArrow(run, "path string"), "benchmark-files").collect())


class _Segment:
    """One index row, decoded."""

    def __init__(self, row: dict):
        import numpy as np
        import pyarrow as pa

        lengths = np.array(row["n_words"], np.int64)
        self.doc_end = np.cumsum(lengths)
        self.doc_start = self.doc_end - lengths
        ends = _unpack(row["term_ends"], "<i8")
        self.counts, self.gaps = _unpack(row["counts"], "<i4"), _unpack(row["postings"], "<i4")
        self.first = np.cumsum(self.counts, dtype=np.int64) - self.counts
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        self.terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(_unpack(row["terms"], "u1"))])
        self.lists: dict[int, object] = {}

    def slots(self, term: int):
        """The ascending slots of a word of this segment."""
        import numpy as np

        if term not in self.lists:
            at = self.first[term]
            self.lists[term] = np.cumsum(self.gaps[at : at + self.counts[term]], dtype=np.int64)
        return self.lists[term]


def _near(segment: _Segment, terms, order, n: int, reach: int):
    """(start, document) of each place at which all words of a window lie at
    most ``reach`` words off theirs."""
    import numpy as np

    doc_start, doc_end, start = segment.doc_start, segment.doc_end, None
    for j in order:
        s = segment.slots(int(terms[j]))
        if start is None:
            # The rarest word may itself be off its place.
            off = np.arange(-reach, reach + 1)
            start = (s[:, None] - j + off).ravel()
            doc = np.repeat(np.searchsorted(doc_end, s, "right"), len(off))
            # An exact window lies in one document; a near one may be anchored off its ends.
            ok = (start >= doc_start[doc]) & (start + n <= doc_end[doc]) if not reach else np.ones(len(start), bool)
        else:
            low = start + j - reach if not reach else np.maximum(start + j - reach, doc_start[doc])
            at = np.searchsorted(s, low)
            got = s[np.minimum(at, len(s) - 1)]
            ok = (at < len(s)) & (got <= np.minimum(start + j + reach, doc_end[doc] - 1))
        start, doc = start[ok], doc[ok]
        if not len(start):
            break
    return start, doc


def _search_segment(row: dict, blocks: Iterator[_Queries], slop: int):
    """Per document: merged hit spans (word offsets), items with an exact
    window, items with a window within ``slop``."""
    import numpy as np
    import pyarrow.compute as pc

    segment = _Segment(row)
    doc_start, doc_end = segment.doc_start, segment.doc_end
    n_docs = len(doc_end)
    spans: list[list] = [[] for _ in range(n_docs)]
    exact: list[set] = [set() for _ in range(n_docs)]
    close: list[set] = [set() for _ in range(n_docs)]
    if not len(segment.terms):
        return spans, exact, close
    hit, some = np.zeros(int(doc_end[-1]) + 1, np.int64), False
    for q in blocks:
        if not len(q.lengths):
            continue
        local = pc.index_in(q.terms, value_set=segment.terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        often = np.where(local >= 0, segment.counts[local], 0).astype(np.int64)
        rarity = np.where(q.words >= 0, often[q.words], np.iinfo(np.int64).max)
        order = np.argsort(rarity, axis=1, kind="stable")
        for w in np.flatnonzero(rarity.min(axis=1) > 0):
            n, terms = int(q.lengths[w]), local[q.words[w]]
            for reach in {0, slop}:
                start, doc = _near(segment, terms, order[w, :n], n, reach)
                for d in np.unique(doc):
                    close[d] |= q.items[w]
                    if not reach:
                        exact[d] |= q.items[w]
                if not reach and len(start):
                    np.add.at(hit, start, 1)
                    np.add.at(hit, start + n, -1)
                    some = True
    if some:
        on = np.cumsum(hit) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2], edge[1::2]):  # a span may run over into the next document: cut it
            d = int(np.searchsorted(doc_end, a, "right"))
            while a < b:
                e = min(b, int(doc_end[d]))
                if e > a:
                    spans[d].append((int(a - doc_start[d]), int(e - doc_start[d])))
                a, d = max(a, e), d + 1
    return spans, exact, close


_FOUND = "segment string, at int, doc_id bigint, text_hash bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<bigint>, near_items array<bigint>"


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW, slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per indexed document: ``segment``, ``at`` (its place there),
    ``doc_id``, ``text_hash``, ``n_words``, ``spans`` (merged runs of words
    inside exact occurrences), ``items`` (ids with an exact window),
    ``near_items`` (ids with a window within ``slop``; exact ones included).

    Items with a null id hit words but cannot be listed; repeated items count
    once. No items: nothing is hit.
    """
    paths = store_items(items, id_col, text_col, block_bytes)
    small_batches(index.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                spans, exact, close = _search_segment(row, (_queries(p, width) for p in paths), slop)
                n = len(spans)
                spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
                columns = [[row["segment"]] * n, range(n), row["doc_ids"], row["hashes"], row["n_words"], spans, [sorted(x) for x in exact], [sorted(x) for x in close]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names=["segment", "at", "doc_id", "text_hash", "n_words", "spans", "items", "near_items"])

    return index.mapInArrow(run, _FOUND)


def verdicts(found: DataFrame) -> DataFrame:
    """Counts and the contamination verdict per document: contaminated if any
    word is hit and hit words are at least a twentieth of all."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    digest = lambda ids: F.sha2(F.array_join(F.array_sort(F.transform(ids, lambda x: x.cast("string"))), ","), 256)
    out = found.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), digest("items").alias("items_sha256"),
        F.size("near_items").cast("bigint").alias("n_near_items"), digest("near_items").alias("near_items_sha256"), "near_items",
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, columns as they were, whatever
    they are called. Rows are told apart by id and text, so repeated ids are
    judged by their texts. Null, empty and wordless texts stay. The rule
    counts words of exact occurrences, so proximity is not searched here."""
    held, name = numbered(docs)
    found = verdicts(search(build_index(held, name[id_col], name[text_col]), items, slop=0))
    bad = materialise(found.filter("contaminated").select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct(), "contaminated")
    same = held[name[id_col]].cast("bigint").eqNullSafe(bad["__bad_id"]) & (F.xxhash64(held[name[text_col]]) == bad["__bad_hash"])
    return held.join(bad, same, "left_anti").toDF(*docs.columns)

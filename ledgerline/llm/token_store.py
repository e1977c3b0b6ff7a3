"""Token ids in binary shards with a minimal perfect hash index.

Documents are encoded where they lie; only ids move, once, to shards of
near-equal text bytes in ascending key order. Each shard is two files in the
shared folder: raw ids, and an index. The index maps a document key to its
place by a minimal perfect hash (levels of collision-free bits, Limasset et
al. 2017): a key's rank among the set bits is its slot, and the slot holds a
fingerprint of the key, the offset of its ids, their number, and the place of
the document. Bits are stored in lines of 64 bytes that begin with the rank of
their first bit, so an access to a shard of any size reads its head, one line
per level asked (1.6 on average), one slot, one key and the ids.

Repeated keys stand next to each other; the slot holds the first and how many
there are. Null keys come first in the payload and are not indexed.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharding import _bins, find_splitters, keyed
from .shared import filesystem, materialise, scratch_path, shuffle_width, small_batches, write_atomically

END_ID = 1
SHARD_BYTES = 64 << 20
#: Shards at most: beyond, shards grow (6 GB of text each at 100 TB); payloads are streamed, so only a shard's index is in memory.
MAX_SHARDS = 16_384
MAGIC_IDS, MAGIC_INDEX = b"LLIDS001", b"LLMPH002"
GAMMA = 2.0
#: A line of hash bits: the rank of its first bit (8 bytes), then 448 bits.
LINE_BYTES, LINE_BITS = 64, 448
#: A slot: fingerprint of the key, offset and number of the first document's ids, number of documents, place of the first.
SLOT = [("print", "<u4"), ("offset", "<u8"), ("count", "<u8"), ("run", "<u8"), ("head", "<u8")]
HEAD = struct.Struct("<8sIQQI")
#: Ids that a bulk reader takes from the payload at once, in bytes.
READ_BYTES = 4 << 20
_MASK = (1 << 64) - 1


# ---- encoding -------------------------------------------------------------

class WordEncoder:
    """Encodes whole texts through the tokenizers library, each different
    piece once.

    For a tokenizer that drops white space and parts letters and digits from
    punctuation, a text's ids are those of its white-space separated words one
    after another, and those of a word are its core's and then its closing
    punctuation's. Words of ASCII alone are looked up in lower case, which this
    tokenizer takes anyway; others keep their case, as lower-casing before the
    library composes accents could change its result (nor may < begin a special token
    that the text did not have).
    """

    #: Pieces remembered per Python worker: the first ones, so the frequent ones. Others are encoded anew in each batch.
    PIECES = 600_000
    #: Closing punctuation that may be parted; none of it ends a special token or begins a contraction.
    CLOSING = b".,;:!?#$%&*)"

    def __init__(self, path: str):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.places: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0
        self.ends = np.zeros(self.PIECES + 1, np.int64)
        bytes_ = np.arange(256)
        self.blank = np.isin(bytes_, [9, 10, 11, 12, 13, 32])
        self.lower = np.where((bytes_ >= 65) & (bytes_ <= 90), bytes_ + 32, bytes_).astype(np.uint8)
        self.closing = np.isin(bytes_, list(self.CLOSING))
        self.plain = np.isin(bytes_, list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def _pieces(self, data, starts):
        """Pieces of texts that begin at ``starts`` of one buffer: their bytes
        and offsets, and how many pieces each text has."""
        import numpy as np

        solid = ~self.blank[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = starts[starts < len(data)]
        first[inner] = solid[inner]  # a word ends with its text
        place = np.cumsum(solid) - solid  # of each byte among the solid ones
        words = place[np.flatnonzero(first)]
        body = data[solid]
        sizes = np.diff(words, append=len(body))
        wide = np.add.reduceat(((body >= 128) | (body == ord("<"))).astype(np.int32), words) > 0
        body = np.where(np.repeat(wide, sizes), body, self.lower[body])
        core = np.maximum.accumulate(np.where(self.closing[body], -1, np.arange(len(body))))[words + sizes - 1]
        parted = core[(core >= words) & (core < words + sizes - 1)]
        parted = parted[self.plain[body[parted]]] + 1
        offsets = np.sort(np.concatenate([words, parted]))
        before = np.searchsorted(offsets, np.append(place, len(body))[np.minimum(starts, len(data))])
        return body, np.append(offsets, len(body)), np.diff(before, append=len(offsets))

    def encode(self, texts):
        """(ids, lengths): the ids of all texts of an Arrow binary array, and how many each has."""
        import numpy as np
        import pyarrow as pa

        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        if not len(data) or self.blank[data].all():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        body, offsets, counts = self._pieces(data, bounds[:-1] - bounds[0])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))])
        coded = pieces.dictionary_encode()
        unique = coded.dictionary.to_pylist()
        place = np.array([self.places.get(p, -1) for p in unique], np.int64)
        new = np.flatnonzero(place < 0)
        found = [e.ids for e in self.library.encode_batch_fast([unique[i].decode() for i in new], add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum()))
        # Ids of new pieces follow the remembered ones; as many as there is room for stay.
        at, room = self.used, max(0, min(len(new), self.PIECES - len(self.places)))
        lengths = np.zeros(len(unique), np.int64)
        starts = np.zeros(len(unique), np.int64)
        old = place >= 0
        starts[old], lengths[old] = self.ends[place[old]], self.ends[place[old] + 1] - self.ends[place[old]]
        ends = at + np.cumsum(sizes)
        starts[new], lengths[new] = ends - sizes, sizes
        if at + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[:at], np.zeros(at + 2 * len(flat), np.int32)])
        self.ids[at : at + len(flat)] = flat
        n = len(self.places)
        self.ends[n + 1 : n + 1 + room] = ends[:room]
        self.places.update(zip((unique[i] for i in new[:room]), range(n, n + room)))
        self.used = int(self.ends[len(self.places)])
        code = coded.indices.to_numpy(zero_copy_only=False)
        s, m = starts[code], lengths[code]
        ends = np.cumsum(m)
        out = self.ids[np.repeat(s - (ends - m), m) + np.arange(int(ends[-1]))]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return out, np.diff(cuts)


class PlainEncoder:
    """Encodes whole texts through the tokenizers library as they are."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)

    def encode(self, texts):
        import numpy as np

        found = [e.ids for e in self.library.encode_batch_fast([(t.as_py() or b"").decode() for t in texts], add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.int32), np.array([len(x) for x in found], np.int64)


#: Encoders of this Python process: Spark's workers serve many tasks.
_encoders: dict[tuple, object] = {}


def encoder_of(kind: Callable, path: str):
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]


# ---- minimal perfect hash -------------------------------------------------

def _mix(x, seed: int):
    """splitmix64 finaliser of uint64 arrays."""
    import numpy as np

    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _probe(keys, level: int, lines: int):
    """Line and bit within it of each key at a level."""
    import numpy as np

    at = _mix(keys, level) % np.uint64(lines * LINE_BITS)
    return (at // np.uint64(LINE_BITS)).astype(np.int64), (at % np.uint64(LINE_BITS)).astype(np.int64)


def _rank(lines, bit):
    """(whether the bit is set, its rank) of one line per row, uint8 rows of LINE_BYTES."""
    import numpy as np

    base = np.ascontiguousarray(lines[:, :8]).view("<u8")[:, 0].astype(np.int64)
    bits = np.unpackbits(lines[:, 8:], axis=1, bitorder="little").astype(bool)
    below = np.arange(LINE_BITS) < bit[:, None]
    return bits[np.arange(len(bit)), bit], base + (bits & below).sum(axis=1)


class PerfectHash:
    """Slots 0 to n-1 for n distinct int64 keys. ``levels``: per level its
    lines as rows of LINE_BYTES."""

    def __init__(self, levels: list["object"], n: int):
        self.levels, self.n = levels, n

    @classmethod
    def build(cls, keys) -> "PerfectHash":
        import numpy as np

        left, levels, base = keys.astype(np.int64).view(np.uint64), [], 0
        while len(left):
            n = max(1, -(-int(GAMMA * len(left)) // LINE_BITS))
            line, bit = _probe(left, len(levels), n)
            at = line * LINE_BITS + bit
            alone = np.bincount(at, minlength=n * LINE_BITS) == 1
            ones = alone.reshape(n, LINE_BITS)
            lines = np.zeros((n, LINE_BYTES), np.uint8)
            counts = ones.sum(axis=1)
            lines[:, :8] = (base + np.cumsum(counts) - counts).astype("<u8").view(np.uint8).reshape(n, 8)
            lines[:, 8:] = np.packbits(ones, axis=1, bitorder="little")
            levels.append(lines)
            base += int(counts.sum())
            left = left[~alone[at]]
        return cls(levels, base)

    def slots(self, keys):
        """Slot per key; -1 or any slot for a key that was not built in."""
        import numpy as np

        k = keys.astype(np.int64).view(np.uint64)
        out, open_ = np.full(len(k), -1, np.int64), np.arange(len(k))
        for level, lines in enumerate(self.levels):
            left = []
            for some in np.array_split(open_, max(1, len(open_) >> 16)):  # 64k lines at a time
                line, bit = _probe(k[some], level, len(lines))
                hit, rank = _rank(lines[line], bit)
                out[some[hit]] = rank[hit]
                left.append(some[~hit])
            open_ = np.concatenate(left) if left else open_[:0]
        return out


def key_fingerprint(keys):
    import numpy as np

    return (_mix(keys.astype(np.int64).view(np.uint64), 1000) >> np.uint64(32)).astype(np.uint32)


# ---- files ----------------------------------------------------------------

def _index_bytes(keys, nulls, lengths, width: int) -> bytes:
    """The index file of a shard: head, number of lines of each level, lines,
    slots, then the documents in order: keys, null bits, numbers of ids."""
    import numpy as np

    offsets = np.cumsum(lengths) - lengths
    own = np.flatnonzero(~nulls)
    heads = own[np.flatnonzero(np.concatenate([[True], keys[own][1:] != keys[own][:-1]]))] if len(own) else own
    runs = np.diff(np.concatenate([np.searchsorted(own, heads), [len(own)]])) if len(own) else own
    hashed = PerfectHash.build(keys[heads])
    slots = np.zeros(hashed.n, SLOT)
    at = hashed.slots(keys[heads])
    for name, values in (("print", key_fingerprint(keys[heads])), ("offset", offsets[heads]), ("count", lengths[heads]), ("run", runs), ("head", heads)):
        slots[name][at] = values
    levels = [struct.pack("<Q", len(x)) for x in hashed.levels]
    documents = [keys.astype("<i8").tobytes(), np.packbits(nulls, bitorder="little").tobytes(), lengths.astype("<i8").tobytes()]
    return HEAD.pack(MAGIC_INDEX, width, len(keys), hashed.n, len(levels)) + b"".join([*levels, *[x.tobytes() for x in hashed.levels], slots.tobytes(), *documents])


class Shard:
    """Keyed access to one shard. Opening reads the index's head only; nothing is kept but that."""

    def __init__(self, uri: str):
        import numpy as np

        store, path = filesystem(uri)
        self.index, self.payload = store.open_input_file(f"{path}.mph"), store.open_input_file(f"{path}.ids")
        magic, self.width, self.n, self.distinct, levels = HEAD.unpack(self.index.read_at(HEAD.size, 0))
        if magic != MAGIC_INDEX:
            raise ValueError(f"{uri}: no index")
        self.lines = np.frombuffer(self.index.read_at(8 * levels, HEAD.size), "<u8").astype(np.int64).tolist()
        self.first_line = HEAD.size + 8 * levels
        self.first_slot = self.first_line + LINE_BYTES * sum(self.lines)
        self.first_key = self.first_slot + np.dtype(SLOT).itemsize * self.distinct
        self.first_null = self.first_key + 8 * self.n
        self.first_length = self.first_null + -(-self.n // 8)

    def _take(self, kind, at: int, count: int):
        import numpy as np

        kind = np.dtype(kind)
        if not count:
            return np.zeros(0, kind)
        return np.frombuffer(self.index.read_at(kind.itemsize * count, at), kind, count)

    def find(self, key: int):
        """The slot of a key; none where its fingerprint shows that it is not here."""
        import numpy as np

        keys, at = np.array([key], np.int64), self.first_line
        for level, lines in enumerate(self.lines):
            line, bit = _probe(keys.view(np.uint64), level, lines)
            hit, rank = _rank(self._take("u1", at + LINE_BYTES * int(line[0]), LINE_BYTES).reshape(1, -1), bit)
            if hit[0]:
                slot = self._take(SLOT, self.first_slot + np.dtype(SLOT).itemsize * int(rank[0]), 1)[0]
                return slot if slot["print"] == key_fingerprint(keys)[0] else None
            at += LINE_BYTES * lines
        return None

    def ids(self, offset: int, count: int):
        """Ids at an offset of the payload, as unsigned 32-bit numbers."""
        import numpy as np

        raw = self.payload.read_at(count * self.width, 12 + offset * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def get(self, key: int) -> list["object"]:
        """The ids of every document with this key; none if there is none."""
        slot = self.find(key)
        if slot is None or self._take("<i8", self.first_key + 8 * int(slot["head"]), 1)[0] != key:
            return []
        lengths = self._take("<i8", self.first_length + 8 * int(slot["head"]), int(slot["run"]))
        out, offset = [], int(slot["offset"])
        for n in lengths.tolist():
            out.append(self.ids(offset, n))
            offset += n
        return out

    def documents(self):
        """(keys, nulls, offsets, lengths) of all documents in order, each key
        found through the hash: what a reader of the whole shard needs."""
        import numpy as np

        keys, lengths = self._take("<i8", self.first_key, self.n), self._take("<i8", self.first_length, self.n)
        nulls = np.unpackbits(self._take("u1", self.first_null, -(-self.n // 8)), count=self.n, bitorder="little").astype(bool)
        levels, at = [], self.first_line
        for lines in self.lines:
            levels.append(self._take("u1", at, LINE_BYTES * lines).reshape(lines, LINE_BYTES))
            at += LINE_BYTES * lines
        slots = self._take(SLOT, self.first_slot, self.distinct)
        fresh = ~nulls & np.concatenate([[True], (keys[1:] != keys[:-1]) | nulls[:-1]]) if self.n else nulls
        at = PerfectHash(levels, self.distinct).slots(keys[fresh])
        good = at >= 0
        good[good] = slots["print"][at[good]] == key_fingerprint(keys[fresh][good])
        if not good.all():
            raise ValueError(f"key {keys[fresh][~good][0]} is not in the index")
        # Null keys and repeats follow in order; heads stand where their slots say.
        sizes = lengths.copy()
        sizes[fresh] = slots["count"][at].astype(np.int64)
        offsets = np.cumsum(sizes) - sizes
        if (offsets[fresh] != slots["offset"][at].astype(np.int64)).any():
            raise ValueError("slots and documents differ")
        return keys, nulls, offsets, sizes


# ---- writing and reading tables -------------------------------------------

#: How a tokenizer's file must split words for ``WordEncoder``, whose rule for closing punctuation follows from it. Fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def suits_words(path: str) -> bool:
    """Whether ``WordEncoder`` may stand for a tokenizer: its file says that it
    composes, drops white space and lower-cases, splits by ``WORD_PATTERN``,
    and closes each piece with a mark of its own."""
    import json

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    steps = [x.get("type") for x in (told.get("normalizer") or {}).get("normalizers") or []]
    splits = [(x.get("pattern") or {}).get("Regex") for x in (told.get("pre_tokenizer") or {}).get("pretokenizers") or []]
    return steps == ["NFC", "Replace", "Lowercase"] and splits[:1] == [WORD_PATTERN] and bool((told.get("model") or {}).get("end_of_word_suffix"))


def encoder_for(path: str) -> Callable:
    """``WordEncoder`` where it suits the tokenizer's file, else ``PlainEncoder``."""
    return WordEncoder if suits_words(path) else PlainEncoder


def write(docs: DataFrame, tokenizer_path: str, uri: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, encoder: Callable | None = None) -> DataFrame:
    """Encode all texts (null: empty), append ``end_id`` to each, write the
    shards below ``uri`` (default: the shared folder) and return their
    manifest: (shard, path, first_key, last_key, n_docs, n_ids, start), where
    start counts the ids of all shards before.

    ``encoder``: WordEncoder or PlainEncoder, which suits any tokenizer; by
    default chosen from the tokenizer's file. Ids take 2 bytes where the
    vocabulary fits, else 4. Other columns, whatever they are called, are left
    alone. Repeated keys and rows are each stored; an empty table makes no shard.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    encoder = encoder or encoder_for(tokenizer_path)
    uri = uri or scratch_path(spark, "token-ids")
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    placed = keyed(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    sizes = materialise(placed.select(F.col("__key").alias("key"), F.col("__tie").alias("tie"), F.col("__size").alias("size")), "token-sizes")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n = max(1, min(rows, MAX_SHARDS, max(-(-total // shard_bytes), shuffle_width(spark))))
    points = [s[0] for s in find_splitters(sizes, [total * i // n for i in range(1, n)], [total / n / 20] * (n - 1), total)]

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        tool = encoder_of(encoder, tokenizer_path)
        for batch in batches:
            texts, at = batch.column(3), 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            shard = _bins(batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False), points).astype(np.int32)
            while at < len(texts):  # about 4 MB of text at a time, one text at least
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (4 << 20), "right")))
                ids, lengths = tool.encode(texts.slice(at, upto - at))
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * width
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(at, upto - at) for i in range(3)], pa.array(shard[at:upto]), packed], names=["doc_id", "key", "tie", "shard", "ids"])
                at = upto

    encoded = placed.select("doc_id", "__key", "__tie", F.col("text").cast("binary")).mapInArrow(encode, "doc_id bigint, key bigint, tie bigint, shard int, ids binary")
    dealt = encoded.repartitionById(n, "shard").sortWithinPartitions("key", "tie").select("doc_id", "shard", "ids")

    def store(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        keys, lengths, shard = [], [], None

        def payload() -> Iterator[bytes]:
            nonlocal shard
            yield MAGIC_IDS + struct.pack("<I", width)
            for batch in batches:
                if batch.num_rows:
                    shard = batch.column(1)[0].as_py()
                    keys.extend(batch.column(0).to_pylist())
                    some = batch.column(2).to_pylist()
                    lengths.extend(len(x) // width for x in some)
                    yield b"".join(some)

        chunks = payload()
        head = next(chunks)
        first = next(chunks, None)
        if first is None:
            return
        path = f"{uri}/shard-{shard:06d}"

        def all_chunks() -> Iterator[bytes]:
            yield head
            yield first
            yield from chunks

        write_atomically(f"{path}.ids", all_chunks())
        nulls = np.array([k is None for k in keys])
        numbers = np.array([k or 0 for k in keys], np.int64)
        write_atomically(f"{path}.mph", iter([_index_bytes(numbers, nulls, np.array(lengths, np.int64), width)]))
        own = numbers[~nulls]
        row = [[shard], [path], [int(own[0]) if len(own) else None], [int(own[-1]) if len(own) else None], [len(keys)], [sum(lengths)]]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["shard", "path", "first_key", "last_key", "n_docs", "n_ids"])

    manifest = materialise(dealt.mapInArrow(store, "shard int, path string, first_key bigint, last_key bigint, n_docs bigint, n_ids bigint"), "token-manifest")
    # One row per shard of many MB: a single ordered pass over them is small.
    return manifest.withColumn("start", F.expr("coalesce(sum(n_ids) over (order by shard rows between unbounded preceding and 1 preceding), 0L)"))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, read from the files
    through their index. ids: little-endian unsigned 32-bit numbers."""
    spark = manifest.sparkSession
    small_batches(spark)
    n = max(1, manifest.count())
    shards = manifest.select("path", "start", "shard").repartition(n, "shard")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                keys, nulls, offsets, lengths = shard.documents()
                ends, at = np.cumsum(lengths), 0
                while at < shard.n:  # runs of documents, one at least
                    upto = max(at + 1, int(np.searchsorted(ends, int(offsets[at]) + READ_BYTES // shard.width, "right")))
                    ids = shard.ids(int(offsets[at]), int(ends[upto - 1] - offsets[at]))
                    bounds = 4 * np.append(offsets[at:upto] - offsets[at], len(ids))
                    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), upto - at, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                    columns = [pa.array(keys[at:upto], pa.int64(), mask=nulls[at:upto]), pa.array(start + offsets[at:upto]), pa.array(lengths[at:upto]), packed]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])
                    at = upto

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def lookup(manifest: DataFrame, key: int) -> list["object"]:
    """Driver-side keyed access: ids of all documents with ``key``."""
    out = []
    for r in manifest.filter((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("shard").collect():
        out += Shard(r["path"]).get(key)
    return out


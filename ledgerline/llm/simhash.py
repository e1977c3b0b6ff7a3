"""SimHash near-duplicates through a byte-position inverted index.

Fingerprint: 64 majority bits over the XXH64 (seed 42) of word shingles.
Two fingerprints that differ in at most ``max_bits`` bits differ in at most as
many of their eight bytes, so they share at least 8 - ``max_bits`` positional
bytes: the guaranteed minimum that the count filter asks for (six at two bits).

Posting lists of one byte each would hold 1/256 of all fingerprints and emit a
quadratic number of pairs to be tallied. The carrier is therefore one list per
choice of that many positions out of eight (28 choices at two bits), with the
values of these bytes: two fingerprints meet in some list exactly if their
tally reaches the minimum. Within a list the shared positional bytes of each
pair are tallied, pairs below the minimum dropped, and the others verified bit
by bit. Long lists are first parted by pieces of the bytes left out, of which
near fingerprints share one. Links are joined to runs inside the list, so a
list emits a link per member, not per pair. Connected components over these
links are exact.

A fingerprint of shingles moves by many bits when a few words change: of copies
with a five-word shingle similarity of 0.8 and more, few stay within two bits.
``deduplicate(word_bits=...)`` therefore indexes fingerprints of a text's *set of
words* (two of them, of independent hashes), which move little, and verifies
each pair by its shingle fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import lookup_join, materialise, numbered, small_batches

MAX_BITS = 2
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints of a text's set of words, the bits by which one of them may differ, and the bits by which the shingle
#: fingerprints then may. Random texts of one language differ by about 25 of 64 bits in the former, 30 in the latter.
WORD_SETS, WORD_BITS, VERIFY_BITS = 2, 5, 12
#: Members from which a list is parted by pieces before its pairs are compared.
LONG = 256


def _majority(hashes, counts):
    """Fingerprints of texts from their features' hashes, one text after another."""
    import numpy as np

    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    ends = np.cumsum(counts[some])
    starts = ends - counts[some]
    # Sums of up to 255 one-bit lanes fit a byte: cut each document's run into pieces of 255.
    pieces = (counts[some] + 254) // 255
    first = np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(int(pieces.sum())) - first)
    piece_starts = np.cumsum(pieces) - pieces
    bits = np.zeros((len(some), 64), bool)
    lanes = np.uint64(0x0101010101010101)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, cuts)
        per_doc = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), piece_starts, axis=0)
        bits[:, k::8] = 2 * per_doc > counts[some][:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _simhash(texts: list[list[bytes]], width: int):
    """Shingle fingerprints of texts given as words."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, words in enumerate(texts):
        n = len(words)
        if n > width:
            joined, ends, at = b" ".join(words), [], -1
            for w in words:
                at += len(w) + 1
                ends.append(at)
            hashes.extend([digest(joined[s:e], SEED) for s, e in zip([0, *[x + 1 for x in ends]], ends[width - 1 :])])
            counts[i] = n - width + 1
        elif n:
            hashes.append(digest(b" ".join(words), SEED))
            counts[i] = 1
    return _majority(np.array(hashes, np.uint64), counts)


def _word_sets(texts: list[list[bytes]], n: int) -> list:
    """``n`` fingerprints of each text's set of words."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    coded = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    unique = np.array([xxhash.xxh64_intdigest(w, SEED) for w in coded.dictionary.to_pylist()], np.uint64)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    pairs = np.unique(owner * max(1, len(unique)) + code)
    counts = np.bincount(pairs // max(1, len(unique)), minlength=len(texts))
    hashes = unique[pairs % max(1, len(unique))]
    out = []
    for _ in range(n):
        out.append(_majority(hashes, counts))
        with np.errstate(over="ignore"):  # the next hash: splitmix64
            hashes = hashes + np.uint64(0x9E3779B97F4A7C15)
            hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            hashes = hashes ^ (hashes >> np.uint64(31))
    return out


def _word_columns(n: int) -> list[str]:
    return [f"words_{k}" for k in range(n)]


def fingerprints(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, width: int = SHINGLE_WORDS, word_sets: int = 0) -> DataFrame:
    """``carry`` columns (default: all but the text) plus ``fp`` (bigint, the
    fingerprint's bits) and ``words_0``, ... (fingerprints of the set of
    words). Null, empty and blank texts have fingerprint zero."""
    small_batches(docs.sparkSession)
    carry = [c for c in docs.columns if c != text_col] if carry is None else carry
    source = docs.select(*carry, F.col(text_col).cast("binary").alias("__text"))
    made = ["fp", *_word_columns(word_sets)]
    schema = ", ".join([*(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in carry), *(f"{c} bigint" for c in made)])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(len(carry))
            parts, at = [[np.zeros(0, np.uint64)] for _ in made], 0
            while at < len(texts):  # about 4 MB of text at a time
                upto, size, words = at, 0, []
                while upto < len(texts) and size < 4 << 20:
                    text = texts[upto].as_py()
                    words.append(text.translate(_LOWER).split() if text else [])
                    size += len(text or b"")
                    upto += 1
                for part, found in zip(parts, [_simhash(words, width), *(_word_sets(words, word_sets) if word_sets else [])]):
                    part.append(found)
                at = upto
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(carry))], *[pa.array(np.concatenate(p).view(np.int64)) for p in parts]], names=[*carry, *made])

    return source.mapInArrow(run, schema)


def left_out(max_bits: int) -> list[tuple[int, ...]]:
    """The byte positions that each posting list leaves out."""
    if not 0 <= max_bits <= 7:
        raise ValueError("a shared byte is guaranteed for at most seven differing bits")
    return list(combinations(range(8), max_bits))


def _masks(max_bits: int) -> list[int]:
    """Bit masks of the kept bytes, as signed 64-bit numbers."""
    out = []
    for skipped in left_out(max_bits):
        mask = (1 << 64) - 1
        for b in skipped:
            mask &= ~(255 << 8 * b)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _join(label, i, j) -> None:
    """Join the runs of members i and j: labels are positions of smallest members."""
    import numpy as np

    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _compare(order, run, fp, node, max_bits: int, node_bits: int, label) -> None:
    """Link the pairs within runs of ``order``: tally shared positional bytes,
    drop pairs below the guaranteed minimum, verify the others."""
    import numpy as np

    at, step = np.arange(len(order)), 1
    while True:
        at = at[at + step < len(order)]
        at = at[run[at] == run[at + step]]
        if not len(at):
            return
        i, j = order[at], order[at + step]
        apart = fp[i] ^ fp[j]
        shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = np.flatnonzero(shared >= 8 - max_bits)
        near = near[np.bitwise_count(apart[near]) <= max_bits]
        near = near[np.bitwise_count(node[i[near]] ^ node[j[near]]) <= node_bits]
        _join(label, i[near], j[near])
        step += 1


def _link(lists, skip, fp, node, max_bits: int, node_bits: int):
    """(smaller, larger) member of each link of whole lists, given as sorted
    rows with the number of their list."""
    import numpy as np

    u, v = fp.view(np.uint64), node.view(np.uint64)
    label = np.arange(len(u))
    size = np.bincount(lists)[lists]
    short = np.flatnonzero((size > 1) & (size <= LONG))
    _compare(short, lists[short], u, v, max_bits, node_bits, label)
    long = np.flatnonzero(size > LONG)
    if len(long):
        places = np.array(left_out(max_bits), np.uint64).reshape(-1, max_bits)[skip[long]]
        rest = np.zeros(len(long), np.uint64)
        for k in range(max_bits):
            rest |= ((u[long] >> (np.uint64(8) * places[:, k])) & np.uint64(255)) << np.uint64(8 * k)
        edges = [8 * max_bits * k // (max_bits + 1) for k in range(max_bits + 2)]
        for low, high in zip(edges, edges[1:]):
            piece = (rest >> np.uint64(low)) & np.uint64((1 << high - low) - 1)
            by = np.lexsort((piece, lists[long]))
            new = (np.diff(piece[by], prepend=piece[by][:1]) != 0) | (np.diff(lists[long][by], prepend=lists[long][by][:1]) != 0)
            _compare(long[by], np.cumsum(new), u, v, max_bits, node_bits, label)
    tied = np.flatnonzero(label != np.arange(len(u)))
    ends = np.stack([node[label[tied]], node[tied]])
    return ends[:, ends[0] != ends[1]]


def links(rows: DataFrame, indexed: list[str] | None = None, node: str = "fp", max_bits: int = MAX_BITS, node_bits: int = 64) -> DataFrame:
    """Links (a, b), a < b, between values of ``node``, whose connected
    components equal those of the full graph of pairs of rows that differ by
    at most ``max_bits`` bits in some column of ``indexed`` (default: the node
    itself) and by at most ``node_bits`` in the node.

    A list holds the fingerprints that share 8 - ``max_bits`` bytes: at two
    bits at most 65,536, whatever the corpus; at five bits a 2**24th of an
    evenly spread corpus.
    """
    small_batches(rows.sparkSession)
    indexed = indexed or [node]
    masks, n = _masks(max_bits), len(left_out(max_bits))
    columns = F.array(*[F.col(c) for c in indexed])
    spread = rows.select(F.col(node).alias("node"), F.posexplode(columns).alias("which", "fp")).select("node", "fp", "which", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("skip"))
    tagged = spread.select((F.col("which") * n + F.col("skip")).alias("tag"), "fp", "node")
    # The shared bytes follow from tag and fingerprint: they partition and sort the rows but are not shipped.
    shared = F.col("fp").bitwiseAND(F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("tag") % n + 1))
    lists = tagged.repartition("tag", shared).sortWithinPartitions("tag", shared, "fp", "node")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        mask, tail = np.array(masks, np.int64), None

        def out(rows):
            tag, fp, node = rows
            shared = fp & mask[tag % n]
            number = np.cumsum((np.diff(tag, prepend=tag[:1]) != 0) | (np.diff(shared, prepend=shared[:1]) != 0))
            found = _link(number, tag % n, fp, node, max_bits, node_bits)
            return pa.RecordBatch.from_arrays([pa.array(found.min(axis=0)), pa.array(found.max(axis=0))], names=["a", "b"])

        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            if tail is not None:
                rows = [np.concatenate(x) for x in zip(tail, rows)]
            tag, shared = rows[0], rows[1] & mask[rows[0] % n]
            new = np.flatnonzero((tag[1:] != tag[:-1]) | (shared[1:] != shared[:-1])) + 1
            last = int(new[-1]) if len(new) else 0  # a list's rows may go on in the next batch
            if last:
                yield out([x[:last] for x in rows])
            tail = [x[last:] for x in rows]
        if tail is not None and len(tail[0]) > 1:
            yield out(tail)

    found = lists.mapInArrow(run, "a bigint, b bigint")
    # A member of many lists hangs on another smallest member in each: keep its link to the least of these and link the
    # others to that one, so that a crowd of near copies leaves about a link per member. There is one per list at most.
    held = found.groupBy("b").agg(F.collect_set("a").alias("roots")).withColumn("a", F.array_min("roots"))
    ends = F.concat(F.array("b"), F.array_remove("roots", F.col("a")))
    return held.select("a", F.explode(ends).alias("b")).distinct()


def near_duplicate_classes(fps: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS, word_bits: int | None = None, verify_bits: int = VERIFY_BITS) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of a
    materialised table. root: the component's smallest fingerprint.
    component_id: the smallest id in it; null only if all its ids are null.

    Fingerprints link within ``max_bits``. With ``word_bits`` they link
    instead if some fingerprint of the word sets (columns ``words_k`` of
    ``fps``) is within ``word_bits`` and they themselves within ``verify_bits``.
    """
    classes = materialise(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-classes")
    if word_bits is None:
        near = links(classes, max_bits=max_bits)
    else:
        words = [c for c in fps.columns if c.startswith("words_")]
        near = links(fps.select("fp", *words).distinct(), words, "fp", word_bits, verify_bits)
    roots = connected_components(near)
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", "root")
    # Only components of several classes need a lookup; a crowd's many rows meet its one row there.
    several = materialise(joined.filter("root is not null").groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    found = lookup_join(joined.withColumn("alone", F.col("root").isNull()), several, ["root"])
    return materialise(found.select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("alone"), F.col("least")).otherwise(F.col("component_id")).alias("component_id")), "simhash-components")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: ``id_col``, ``fp``, ``component_id``.

    Every row is answered for, repeated rows and null ids too; null, empty and
    blank texts have fingerprint zero; texts are taken whole, however long. An
    empty table gives an empty result.
    """
    fps = materialise(fingerprints(docs.select(id_col, text_col), text_col, [id_col], width), "simhash-fps")
    classes = near_duplicate_classes(fps, id_col, max_bits)
    return fps.join(classes, "fp", "left").select(id_col, "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, width: int = SHINGLE_WORDS, word_bits: int | None = None, verify_bits: int = VERIFY_BITS) -> DataFrame:
    """Keep one document of each component (see ``near_duplicate_classes``),
    that with the smallest id, with all its columns, whatever they are called.
    Of rows that repeat that id, the one with the smallest text hash stays, and
    of equal rows one. Null, empty and blank texts are one component."""
    key = ["__id", "__hash"]
    held, name = numbered(docs)
    id_, text = F.col(name[id_col]), F.col(name[text_col])
    keyed = held.withColumns({"__id": id_, "__hash": F.xxhash64(text)})
    fps = materialise(fingerprints(keyed.select(*key, name[text_col]), name[text_col], key, width, 0 if word_bits is None else WORD_SETS), "simhash-fps")
    classes = near_duplicate_classes(fps, "__id", max_bits, word_bits, verify_bits)
    owned = fps.groupBy(*key, "fp").agg(F.count(F.lit(1)).alias("copies")).join(classes, "fp")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__hash", "copies")).alias("w")
    winners = materialise(owned.groupBy("root").agg(first).select("w.__id", "w.__hash", "w.copies"), "simhash-winners")
    once, more = winners.filter("copies = 1"), winners.filter("copies > 1")
    kept = keyed.join(once, keyed["__id"].eqNullSafe(once["__id"]) & keyed["__hash"].eqNullSafe(once["__hash"]), "left_semi")
    if not more.isEmpty():
        again = keyed.join(more, keyed["__id"].eqNullSafe(more["__id"]) & keyed["__hash"].eqNullSafe(more["__hash"]), "left_semi")
        kept = kept.unionByName(again.dropDuplicates(key))
    return kept.drop(*key).toDF(*docs.columns)

"""Histogram sort: shards of near-equal bytes with one exchange.

Rows are ordered by a key; splitters are sought by counting exact bytes below
probe keys over all partitions at once, narrowing the interval around every
wanted byte mark until a splitter is within ``tolerance`` of its mark or no
key lies between (then the nearer end of the row that straddles the mark is
taken). Only then do the texts move, once, straight to their range.

Order is by (key, tie): the tie hashes the row, so that rows of one key can
be parted however many they are. Rows equal in every column are parted by
their place in the input; this asks for an input that reads the same way
twice (a table does).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, replace_columns, small_batches

SHARDS = 24
#: Probes per open splitter and round; a round reads only the narrow table of keys and sizes.
PROBES = 64
#: Bytes that one task of the exchange should receive; a shard of more is dealt as several ranges.
RANGE_BYTES = 256 << 20
#: Ranges of one shard at most: beyond, ranges grow (16 GB each at 100 TB in 24 shards, sorted with spill).
SHARD_RANGES = 256
#: Points of one round at most, whatever the number of splitters sought.
ROUND_POINTS = 1 << 16
OVERHEAD_BYTES = 8

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
Point = tuple[int, int]


def _bins(key, tie, points: list[Point]):
    """Number of points at or below each (key, tie)."""
    import numpy as np

    pk, pt = (np.array([p[i] for p in points], np.int64) for i in (0, 1))
    low, high = np.searchsorted(pk, key, "left"), np.searchsorted(pk, key, "right")
    out = low.copy()
    met = low < high
    for k in np.unique(key[met]):
        rows = key == k
        a, b = np.searchsorted(pk, k, "left"), np.searchsorted(pk, k, "right")
        out[rows] = a + np.searchsorted(pt[a:b], tie[rows], "right")
    return out


def _histogram(sizes: DataFrame, points: list[Point]) -> list[tuple[int, int]]:
    """(bytes, rows) below each point. At most one row per point and task leaves the executors."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total, rows = np.zeros(len(points) + 1, np.int64), np.zeros(len(points) + 1, np.int64)
        for b in batches:
            at = _bins(b.column(0).to_numpy(), b.column(1).to_numpy(), points)
            np.add.at(total, at, b.column(2).to_numpy())
            rows += np.bincount(at, minlength=len(points) + 1)
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some]), pa.array(rows[some])], names=["bin", "bytes", "n"])

    found = sizes.mapInArrow(run, "bin bigint, bytes bigint, n bigint").groupBy("bin").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    by = {r["bin"]: (r["bytes"], r["n"]) for r in found}
    out, b, n = [], 0, 0
    for i in range(len(points)):
        x = by.get(i, (0, 0))
        b, n = b + x[0], n + x[1]
        out.append((b, n))
    return out


def _between(low: Point, high: Point, probes: int) -> list[Point]:
    """Points strictly between two points: over keys while there are keys
    between, then over ties of the lower point's key."""
    (k1, t1), (k2, t2) = low, high
    if k2 - k1 > 1 or (k2 - k1 == 1 and t2 > _LOW):
        step = max(1, -(-(k2 - k1 + (t2 > _LOW)) // (probes + 1)))
        return [(k, _LOW) for k in range(k1 + step, k2 + (t2 > _LOW), step)]
    end = t2 if k2 == k1 else _HIGH + 1
    step = max(1, -(-(end - t1) // (probes + 1)))
    return [(k1, t) for t in range(t1 + step, end, step)]


def _probes(lo: tuple, hi: tuple, mark, probes: int) -> list[Point]:
    """Probes of an interval: half of them evenly spread, which halves it at
    least; the others close in on the place where the mark would lie if bytes
    were spread evenly over the keys, which mostly ends the search in few rounds."""
    spread = _between(lo[0], hi[0], max(1, probes // 2))
    (k1, _), (k2, _) = lo[0], hi[0]
    if k2 - k1 < 4 or hi[1] <= lo[1] or len(spread) < probes // 2:
        return _between(lo[0], hi[0], probes)
    guess = k1 + int((k2 - k1) * (mark - lo[1]) / (hi[1] - lo[1]))
    near, reach = set(), (k2 - k1) // 4
    for i in range(max(1, probes // 4)):
        near |= {guess - (reach >> 2 * i), guess + (reach >> 2 * i)}
    return sorted({*spread, *((k, _LOW) for k in near if k1 < k < k2)})


def find_splitters(sizes: DataFrame, marks: list[int], tolerances: list[float], total: int, probes: int = PROBES) -> list[tuple[Point, int, int]]:
    """For each byte mark a splitter point with the exact bytes and rows below
    it, as near to the mark as its tolerance asks or rows allow.

    ``sizes``: a materialised table (key, tie, size). A row that straddles
    its mark goes to the side that holds the larger part of it; in a draw it
    stays below.
    """
    ends = sizes.agg(F.min("key"), F.max("key"), F.count(F.lit(1))).first()
    if not ends[2]:
        return [((_LOW, _LOW), 0, 0) for _ in marks]
    first, last = (ends[0], _LOW), (ends[1] + 1, _LOW) if ends[1] < _HIGH else (_HIGH, _HIGH)
    # Open intervals: (point, bytes below, rows below) on either side of each mark.
    state = [((first, 0, 0), (last, total, ends[2])) for _ in marks]
    done: list[tuple[Point, int, int] | None] = [None] * len(marks)
    while True:
        wanted: set[Point] = set()
        share = max(2, min(probes, ROUND_POINTS // max(1, done.count(None))))
        for i, (lo, hi) in enumerate(state):
            if done[i] is not None:
                continue
            near = min((lo, hi), key=lambda x: (abs(x[1] - marks[i]), -x[1]))
            mids = _probes(lo, hi, marks[i], share) if hi[2] - lo[2] > 1 else []
            if abs(near[1] - marks[i]) <= tolerances[i] or not mids:
                done[i] = near
            wanted.update(mids if done[i] is None else ())
        if not wanted:
            return done  # type: ignore[return-value]
        points = sorted(wanted)
        below = _histogram(sizes, points)
        amounts = [b for b, _ in below]
        for i, (lo, hi) in enumerate(state):
            if done[i] is None:
                a, z = bisect_right(points, lo[0]), bisect_left(points, hi[0])
                m = bisect_right(amounts, marks[i], a, z)  # the first point past the mark
                lo, hi = (points[m - 1], *below[m - 1]) if m > a else lo, (points[m], *below[m]) if m < z else hi
                state[i] = (lo, hi)


def size_of(text_col: str = "text"):
    """UTF-8 bytes of the text (null: none) plus a fixed overhead."""
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint") + F.lit(OVERHEAD_BYTES)


def keyed(docs: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``docs`` with their order (``__key``, ``__tie``) and ``__size``. The tie's
    upper half hashes the row's content, its lower half its place."""
    content = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFFFFFF))
    key = F.coalesce(F.col(key_col).cast("bigint"), F.lit(_LOW))
    return docs.withColumns({"__key": key, "__tie": F.shiftleft(content, 32).bitwiseOR(place), "__size": size_of(text_col)})


def shard_by_bytes(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = 0.0, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All rows with ``shard`` (0 to shards-1, in key order, sizes near equal)
    and ``slot`` (gapless from 0 within the shard, in key order).

    ``tolerance``: share of a shard's bytes by which a splitter may miss its
    mark; 0 takes the best that whole rows allow, so shards differ by less
    than the largest document. Null keys sort first. Columns named shard or
    slot are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = replace_columns(docs, ["shard", "slot"])
    placed = keyed(docs, key_col, text_col)
    sizes = materialise(placed.select(F.col("__key").alias("key"), F.col("__tie").alias("tie"), F.col("__size").alias("size")), "shard-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    per = max(1, min(SHARD_RANGES, -(-total // (shards * range_bytes))))
    # Shard borders are sought to the tolerance, borders of ranges within a shard to a tenth of a range.
    n = shards * per
    marks = [Fraction(total * i, n) for i in range(1, n)]
    loose = total / n / 10
    splitters = find_splitters(sizes, marks, [tolerance * total / shards if i % per == 0 else loose for i in range(1, n)], total)
    points = [s[0] for s in splitters]
    rows_below = [0, *[s[2] for s in splitters]]

    offsets = [rows_below[i] - rows_below[i - i % per] for i in range(n)]

    @F.pandas_udf("range int, base bigint")
    def range_of(key, tie):
        import numpy as np
        import pandas as pd

        at = _bins(key.to_numpy(), tie.to_numpy(), points).astype("int32")
        return pd.DataFrame({"range": at, "base": np.array(offsets, np.int64)[at]})

    dealt = placed.withColumn("__at", range_of("__key", "__tie")).withColumns({"__range": F.col("__at.range"), "__base": F.col("__at.base")})
    dealt = dealt.repartitionById(n, "__range").sortWithinPartitions("__key", "__tie")
    # A range is one partition, sorted: the place within it is the id's low part.
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.select(*[f"`{c}`" for c in docs.columns], F.floor(F.col("__range") / per).cast("int").alias("shard"), (F.col("__base") + at).alias("slot"))


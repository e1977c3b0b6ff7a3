"""Mixing sources to target weights by Poisson replication, in DataFrame and
SQL functions only.

A source's rate is its target share of all text bytes over its actual share:
the mean number of copies of each of its documents. The count of a document
inverts the Poisson distribution of that mean at a uniform number hashed from
seed and document, so it is the same in every run and on every partition.
Documents are exploded by their counts and shuffled globally by hashed
position. A mean above ``PIECE`` is drawn as a sum of Poisson numbers of
smaller, equal means, which has the same distribution.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lookup_join, materialise, replace_columns, shuffle_width

SEED = 17
#: Largest mean inverted at once.
PIECE = 16.0
#: Copies of one document that one task makes; of more, the rest are made by others.
CHUNK = 64
#: Terms of the distribution: beyond them the tail of a mean of PIECE is far below the 2**-52 steps of the uniform numbers, so none is cut off.
TERMS = 96

_ADDED = ["rate", "copies", "copy", "position"]


def uniform(*parts: Column) -> Column:
    """52 hashed bits as a number in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: Mapping[str, float] | None = None, total: float = 1.0) -> DataFrame:
    """(source, rate, pieces, cdf) per source. ``weights``: target share of
    each source (scaled to sum to one; sources not named get weight zero);
    None asks for equal shares. ``total``: bytes wanted over bytes present.
    Weights that name no present source, or zeros only, give every source rate zero."""
    sizes = docs.groupBy(F.col(source_col).alias("__source")).agg(F.sum(F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(1)).alias("bytes"))
    sizes = materialise(sizes, "mix-sizes")
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        named = F.lit(0.0)
        for name, w in weights.items():
            named = F.when(F.col("__source").cast("string").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(named)
        weighted = sizes.withColumn("weight", named)
    sums = weighted.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    joined = weighted.join(F.broadcast(sums))  # one row
    rate = F.when(F.col("all_weight") > 0, F.lit(float(total)) * F.col("weight") / F.nullif("all_weight", F.lit(0.0)) * F.col("all_bytes") / F.col("bytes")).otherwise(F.lit(0.0))
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("bigint")
    # Probabilities add up term by term: p(k) = p(k-1) * mean / k.
    cdf = F.expr(
        f"aggregate(sequence(1, {TERMS}), named_struct('p', exp(-mean), 'c', array(exp(-mean))), "
        "(a, k) -> named_struct('p', a.p * mean / k, 'c', concat(a.c, array(element_at(a.c, -1) + a.p * mean / k))), a -> a.c)"
    )
    out = joined.select("__source", rate.alias("rate")).withColumn("pieces", pieces).withColumn("mean", F.col("rate") / F.col("pieces"))
    return materialise(out.select("__source", "rate", "pieces", cdf.alias("cdf")), "mix-rates")


def replicate(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Mapping[str, float] | None = None, total: float = 1.0, seed: int = SEED) -> DataFrame:
    """Every document as often as its count says (none to many), in a global
    random order, with ``rate`` (its source's mean), ``copies`` (its count),
    ``copy`` (0 to copies-1) and ``position`` (the hashed place; rows of a
    partition are ascending in it).

    The id alone decides a row's draw, so rows that repeat an id are drawn
    alike; a null id is drawn by its text. A null source is a source. Columns
    named like the results are replaced. Null and empty texts count one byte,
    so no source is empty; texts of any length move once. Without a weighted
    source, and of an empty table, there are no rows.
    """
    spark = docs.sparkSession
    docs = replace_columns(docs, [*_ADDED, "__source", "pieces", "cdf", "__from"])
    table = rates(docs, source_col, text_col, weights, total)
    known = lookup_join(docs.withColumn("__source", F.col(source_col)), table, ["__source"])
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    # The uniform number is bound once per draw, not hashed again for every term it is compared to.
    below = lambda u: F.size(F.filter("cdf", lambda c: c <= u)).cast("bigint")
    inverted = lambda piece: F.transform(F.array(uniform(F.lit(str(seed)), piece.cast("string"), name)), below)[0]
    count = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("pieces")), F.lit(0).cast("bigint"), lambda a, k: a + inverted(k))
    counted = known.withColumn("copies", count).drop("__source", "pieces", "cdf").filter("copies > 0")
    zero = F.lit(0).cast("bigint")
    if (table.agg(F.max("rate")).first()[0] or 0) > CHUNK:
        # Documents of a rare source repeat without bound: deal pieces of their copies to other tasks first.
        pieces = counted.withColumn("__from", F.explode(F.sequence(zero, F.col("copies") - 1, F.lit(CHUNK).cast("bigint"))))
        spread = pieces.repartition(shuffle_width(spark), F.xxhash64(name, "__from"))
        copies = spread.withColumn("copy", F.explode(F.sequence("__from", F.least(F.col("__from") + CHUNK, F.col("copies")) - 1))).drop("__from")
    else:
        copies = counted.withColumn("copy", F.explode(F.sequence(zero, F.col("copies") - 1)))
    placed = copies.withColumn("position", F.md5(F.concat_ws(":", F.lit(f"place {seed}"), F.col("copy").cast("string"), name)))
    return placed.repartition(shuffle_width(spark), "position").sortWithinPartitions("position")

"""Quality rules with adaptive thresholds, in DataFrame and SQL functions only.

Each measure's distribution over the documents that pass the base rules is
sketched per language and source by counts in log-linear buckets (relative
error 1/32). Such sketches merge by adding counts, in any order and with the
same result: those of sources add up to their language's, and these to that of
all documents. A threshold is a high (or low) quantile of the group's own
sketch with a relative margin. A quantile is weighed with that of the parent
by numbers of documents (``PRIOR_ROWS`` stands for the parent), at every group
size alike, so a small group leans on its language and a language on all.
Documents are then joined to their group's thresholds and filtered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lookup_join, materialise, numbered, replace_columns


@dataclass(frozen=True)
class Rule:
    """A document fails above ``margin`` percent of the ``level`` percent
    quantile; if ``both``, also below the (100 - ``level``) percent quantile
    over the margin. ``forgiven`` occurrences are not counted."""

    level: int
    margin: int
    both: bool = False
    forgiven: int = 0


#: Documents that the parent's quantile counts for.
PRIOR_ROWS = 100
#: Chosen on the half of the labels of the 0.1 table whose crc32 of doc_id is even; the README's figures are of the other half.
#: Ratios in 1/10000, word length in 1/100 character.
MEASURES = {"symbols": Rule(75, 400, forgiven=3), "word_length": Rule(90, 120, both=True), "dup_lines": Rule(99, 200), "repeats": Rule(99, 200)}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_BLANK = "' ' || char(9) || char(10) || char(11) || char(12) || char(13)"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str, hashes: str) -> str:
    """Words covered by three-word windows found twice or more.

    Windows sort by hash with their place in the low bits; equal neighbours
    are compared word by word, and a text with a false match takes the way
    that sorts the windows themselves.
    """
    same = "get(w, cast(get(s, k) & m as int)) = get(w, cast(get(s, k - 1) & m as int)) and get(w, cast(get(s, k) & m as int) + 1) = get(w, cast(get(s, k - 1) & m as int) + 1) and get(w, cast(get(s, k) & m as int) + 2) = get(w, cast(get(s, k - 1) & m as int) + 2)"
    joined = "(get(s, k) & ~m) = (get(s, k - 1) & ~m)"
    sorted_windows = "sort_array(transform(sequence(0, size(w) - 3), i -> (xxhash64(get(h, i), get(h, i + 1), get(h, i + 2)) & ~m) | cast(i as bigint)))"
    by_hash = "array_distinct(flatten(transform(pairs, k -> array(get(s, k - 1) & m, get(s, k) & m))))"
    strings = "sort_array(transform(sequence(0, size(w) - 3), i -> named_struct('t', array(get(w, i), get(w, i + 1), get(w, i + 2)), 'i', cast(i as bigint))))"
    by_text = _let(strings, "z", "array_distinct(flatten(transform(filter(sequence(1, size(z) - 1), k -> get(z, k).t = get(z, k - 1).t), k -> array(get(z, k - 1).i, get(z, k).i))))")
    covered = "aggregate(sort_array(found), named_struct('last', -3L, 'n', 0L), (a, x) -> named_struct('last', x, 'n', a.n + least(3L, x - a.last)), a -> a.n)"
    picked = f"if(exists(pairs, k -> not ({same})), {by_text}, {by_hash})"
    pairs = f"filter(sequence(1, size(s) - 1), k -> {joined})"
    count = _let(pairs, "pairs", f"if(size(pairs) = 0, 0L, {_let(picked, 'found', covered)})")
    inner = _let("shiftleft(1L, length(bin(size(w)))) - 1L", "m", _let(sorted_windows, "s", count))
    return f"if(size({words}) < 4, 0L, {_let(words, 'w', _let(hashes, 'h', inner))})"


def measures(text_col: str = "text") -> Column:
    """A struct of counts for a text: n_words, word_chars, n_symbols, n_lines
    (with a word), n_dup_lines, n_repeat_words. Null, empty and blank texts
    count nothing."""
    text = f"coalesce(`{text_col}`, '')"
    bare = f"trim(BOTH {_BLANK} FROM {text})"
    words = f"if(length({bare}) = 0, cast(array() as array<string>), split({bare}, '[\\\\x20\\\\x09-\\\\x0D]+'))"
    lines = f"filter(split({text}, '\\\\n'), l -> length(trim(BOTH {_BLANK} FROM l)) > 0)"
    hashes = "transform(words, x -> xxhash64(x))"
    repeat = _repeat_words("words", hashes)
    fields = (
        "named_struct('n_words', cast(size(words) as bigint), "
        f"'word_chars', cast(length({text}) - regexp_count({text}, '[\\\\x20\\\\x09-\\\\x0D]') as bigint), "
        f"'n_symbols', cast(regexp_count({text}, '[#*$%&|<>]') as bigint), "
        "'n_lines', cast(size(lines) as bigint), "
        "'n_dup_lines', cast(size(lines) - size(array_distinct(lines)) as bigint), "
        f"'n_repeat_words', {repeat})"
    )
    return F.expr(_let(words, "words", _let(lines, "lines", fields)))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_RATES = {"symbols": (10000, "n_symbols", "word_chars"), "word_length": (100, "word_chars", "n_words"), "dup_lines": (10000, "n_dup_lines", "n_lines"), "repeats": (10000, "n_repeat_words", "n_words")}


def bounds_of(rules: dict[str, Rule]) -> list[str]:
    """Names of the threshold columns."""
    return [f"{m}_{end}" for m, r in rules.items() for end in (["low"] if r.both else []) + ["high"]]


def _rates(rules: dict[str, Rule]) -> dict[str, Column]:
    def rate(name: str) -> Column:
        scale, part, whole = _RATES[name]
        counted = F.greatest(F.col(part) - rules[name].forgiven, F.lit(0))
        return F.floor(scale * counted / F.greatest(F.col(whole), F.lit(1))).cast("bigint")  # far below 2**53: exact

    return {name: rate(name) for name in rules}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bucket_of(value: Column) -> Column:
    """Log-linear bucket of a whole number from 0: exact below 64, then 32 to each power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32 + F.call_function("shiftright", value, shift)).cast("int")


def bucket_top(bucket: Column) -> Column:
    """The largest whole number in a bucket."""
    shift = F.greatest(F.floor(bucket / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (bucket - 32 * shift + 1).cast("bigint"), shift) - 1


def sketch(measured: DataFrame, lang_col: str, source_col: str, rules: dict[str, Rule] = MEASURES) -> DataFrame:
    """Mergeable sketches of the documents that pass the base rules: rows
    (level, lang, source, measure, bucket, n) for each language and source
    (level 0), language (1) and all (2)."""
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket_of(v).alias("bucket")) for k, v in _rates(rules).items()])).alias("e")
    fine = measured.filter(~base_failed()).select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), stacked).groupBy("lang", "source", "e.measure", "e.bucket").agg(F.count(F.lit(1)).alias("n"))
    fine = materialise(fine, "quality-sketch")
    none = F.lit(None).cast(fine.schema["source"].dataType)
    coarse = lambda level, lang, source: fine.groupBy(lang.alias("lang"), source.alias("source"), "measure", "bucket").agg(F.sum("n").alias("n")).withColumn("level", F.lit(level))
    return fine.withColumn("level", F.lit(0)).unionByName(coarse(1, F.col("lang"), none)).unionByName(coarse(2, F.lit(None).cast(fine.schema["lang"].dataType), none))


def thresholds(sketches: DataFrame, rules: dict[str, Rule] = MEASURES, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """(lang, source, group_rows) with ``<measure>_high`` (and ``_low``) for
    every group that has a document past the base rules."""
    group = ["level", "lang", "source", "measure"]
    marks = sketches.withColumn("seen", F.expr("sum(n) over (partition by level, lang, source, measure order by bucket)")).withColumn("all", F.expr("sum(n) over (partition by level, lang, source, measure)"))
    of = lambda f: F.element_at(F.create_map(*[F.lit(x) for k, r in rules.items() for x in (k, f(r))]), F.col("measure"))
    at = lambda percent: F.min(F.when(100 * F.col("seen") >= percent * F.col("all"), bucket_top(F.col("bucket"))))
    found = marks.groupBy(*group).agg(at(of(lambda r: 100 - r.level)).alias("low"), at(of(lambda r: r.level)).alias("high"), F.max("all").alias("n"))
    ends = [F.first(c).alias(c) for c in ("low", "high", "n")]
    wide = materialise(found.groupBy("level", "lang", "source").pivot("measure", list(rules)).agg(*ends), "quality-levels")
    first = next(iter(rules))
    names = [f"{m}_{end}" for m in rules for end in ("low", "high")]
    everything = wide.filter("level = 2").select(*[F.col(c).alias(f"a_{c}") for c in names])
    langs = wide.filter("level = 1").select(F.col("lang").alias("l_lang"), F.col(f"{first}_n").alias("l_n"), *[F.col(c).alias(f"l_{c}") for c in names])
    own = wide.filter("level = 0")
    # Whole numbers throughout, so thresholds do not hang on the order of sums.
    blend = lambda n, value, parent: F.floor((n * value + prior_rows * parent) / (n + prior_rows)).cast("bigint")
    joined = own.join(langs, own["lang"].eqNullSafe(langs["l_lang"])).join(F.broadcast(everything))  # one row
    level = {c: blend(F.col(f"{first}_n"), F.col(c), blend(F.col("l_n"), F.col(f"l_{c}"), F.col(f"a_{c}"))) for c in names}
    bound = {f"{m}_high": F.floor(level[f"{m}_high"] * r.margin / 100).cast("bigint") for m, r in rules.items()}
    bound |= {f"{m}_low": F.floor(level[f"{m}_low"] * 100 / r.margin).cast("bigint") for m, r in rules.items() if r.both}
    return joined.select("lang", "source", F.col(f"{first}_n").alias("group_rows"), *[bound[c].alias(c) for c in bounds_of(rules)])


def _measured(docs: DataFrame, text_col: str, lang_col: str, source_col: str, carry: list[str]) -> DataFrame:
    quoted = [f"`{c}`" for c in carry]
    # A filter on counts stops at a generator; pushed into a projection it would measure every text a second time.
    keyed = docs.select(*quoted, F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"), F.explode(F.array(measures(text_col))).alias("__m"))
    return keyed.select(*quoted, "__lang", "__source", *[F.col(f"__m.{c}").alias(c) for c in _COUNTS])


def _judged(measured: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Materialised counts with their group's thresholds and the verdict."""
    bounds = materialise(thresholds(sketch(measured, "__lang", "__source", rules), rules), "quality-thresholds").withColumnsRenamed({"lang": "__lang", "source": "__source"})
    judged = lookup_join(measured, bounds, ["__lang", "__source"])
    fine = F.lit(True)
    for name, rate in _rates(rules).items():
        fine = fine & (rate <= F.col(f"{name}_high"))
        if rules[name].both:
            fine = fine & (rate >= F.col(f"{name}_low"))
    return judged.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & F.coalesce(fine, F.lit(False))})


def assess(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: list[str] | None = None, rules: dict[str, Rule] = MEASURES) -> DataFrame:
    """``carry`` columns (default: all) with the counts, ``base_failed``,
    ``kept``, ``group_rows`` (documents of the group past the base rules) and
    the group's thresholds. Null languages and sources are groups of their
    own; a group whose documents all fail the base rules has null thresholds.
    Columns named like the results are replaced. Null, empty and blank texts
    have no words and fail the base rules; texts are counted whole, however
    long. Repeated rows are each answered. An empty table gives an empty result.

    base_failed: fewer than 50 words, or over half of them in repeated
    three-word windows. kept: not base_failed and every rate within its
    group's thresholds.
    """
    out = [*_COUNTS, "base_failed", "kept", "group_rows", *bounds_of(rules)]
    plain = replace_columns(docs, [*out, "__lang", "__source", "__m"])
    carry = [c for c in (plain.columns if carry is None else carry) if c in plain.columns]
    measured = materialise(_measured(plain, text_col, lang_col, source_col, carry), "quality-measured")
    return _judged(measured, rules).select(*[f"`{c}`" for c in carry], *out)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", rules: dict[str, Rule] = MEASURES) -> DataFrame:
    """The documents whose verdict is ``kept``, all columns as they were,
    whatever they are called. Documents that fail the base rules are left out
    before anything is written, and the others written once with their counts:
    joining verdicts back to texts would shuffle the texts instead."""
    held, name = numbered(docs)
    counted = _measured(held, name[text_col], name[lang_col], name[source_col], held.columns)
    judged = _judged(materialise(counted.filter(~base_failed()), "quality-measured"), rules)
    return judged.filter("kept").select(*[F.col(h).alias(c) for h, c in zip(held.columns, docs.columns)])

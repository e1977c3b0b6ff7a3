"""Row labels: cleaned to the form in which labels and aliases are compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import BLANK, strip

#: A row's number as one word, after brackets or points: 1, 1a, 1., (1), 7b:
_NUMBER = r"[0-9]+[a-z]?[.):]?"


def norm_label(df: DataFrame, out: str, text: Column, keep_tail: Column | None = None) -> DataFrame:
    """``df`` with ``out``: the text in lower case, with single blanks, without
    the row's number in front (1, 1a, UK 7a, 1., (1)) and without a closing
    footnote number of one or two digits.

    The text is split into words; the number is the first word that is not
    brackets or points alone, or the one after "uk"; the footnote is the last
    word, if others are left. ``keep_tail``: where true, the closing number
    stays. By default it goes everywhere, so an alias that itself ends in a
    number loses it too. Names beginning with ``__lab_`` are taken meanwhile.
    """
    plain = F.array_join(F.split(F.lower(strip(text)), rf"{BLANK}+"), " ")
    split = df.withColumn("__lab_plain", plain).withColumn("__lab_words", F.split(F.regexp_replace("__lab_plain", r"^(?:[.()]+ )+", ""), " "))
    words = F.col("__lab_words")
    numbered = F.get(words, F.lit(0)).rlike(rf"^[.()]*{_NUMBER}$")
    after_uk = F.get(words, F.lit(0)).rlike(r"^[.()]*uk$") & F.coalesce(F.get(words, F.lit(1)).rlike(rf"^{_NUMBER}$"), F.lit(False))
    drop = F.when(numbered, 1).when(after_uk, 2).otherwise(0)
    cut = split.withColumn("__lab_drop", drop).withColumn("__lab_rest", F.when(F.col("__lab_drop") > 0, F.slice(words, F.col("__lab_drop") + 1, F.size(words))).otherwise(F.split("__lab_plain", " ")))
    rest = F.col("__lab_rest")
    footnote = (F.size(rest) > 1) & F.coalesce(F.get(rest, F.size(rest) - 1).rlike(r"^[0-9]{1,2}$"), F.lit(False))
    tail = cut.withColumn("__lab_cut", footnote if keep_tail is None else footnote & ~keep_tail)
    kept = F.when(F.col("__lab_cut"), F.slice(rest, F.lit(1), F.greatest(F.size(rest) - 1, F.lit(0)))).otherwise(rest)
    return tail.withColumn(out, F.array_join(kept, " ")).drop("__lab_plain", "__lab_words", "__lab_drop", "__lab_rest", "__lab_cut")


def is_label(label: Column) -> Column:
    """Whether letters are left in a cleaned label."""
    return F.coalesce(label.rlike(r"\p{L}"), F.lit(False))

"""Locale-aware number normalisation: a cell is an unambiguous number or an
error, never a guess.

``parse_decimal`` and ``normalise`` add a column to a DataFrame in steps: the
cell is bound once, cleaned once and written in one common style before it is
judged, each step a projection that later ones refer to. All of it is built-in
string functions, so the steps compile into one generated loop. Results are
struct<value, error>; exactly one of the two is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.schema import CURRENCY_UNITS, MONETARY_UNITS, WIDE

#: Decimal and thousands separators by locale. Fixed values.
LOCALES = {
    "en_GB": (".", ","),
    "en_US": (".", ","),
    "en_CA": (".", ","),
    "ja_JP": (".", ","),
    "de_DE": (",", "."),
    "de_CH": (",", "."),
    "es_ES": (",", "."),
    "it_IT": (",", "."),
    "nl_NL": (",", "."),
    "fr_FR": (",", "    "),
}
#: Multiplier of each disclosure scale and of each scale word in a cell. Fixed values.
SCALES = {"thousands": 10**3, "millions": 10**6, "billions": 10**9}
SCALE_WORDS = {"k": 10**3, "thousand": 10**3, "m": 10**6, "mn": 10**6, "million": 10**6, "bn": 10**9, "billion": 10**9}
PERCENT_BAND = (-100, 1000)

#: Unicode white space: Java's \s and trim know ASCII only.
BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
_FOOTNOTES = "[¹²³⁰-⁹*†‡]"
_SCALE = rf"(?i){BLANK}*(thousand|million|billion|bn|mn|k|m){BLANK}*$"
#: Marks a negative number while it is cleaned; cells that hold it are not numbers.
_MINUS, _PLUS = "\x01", "\x02"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def _clean(bare: Column) -> Column:
    """Digits and separators of a stripped cell, preceded by a mark if
    negative. Parentheses come off first, then one currency symbol, one
    currency code, footnotes, one percent sign and one sign, in this order."""
    s = F.translate(bare, _MINUS + _PLUS, "??")
    s = F.regexp_replace(s, rf"(?s)^\({BLANK}*(.*?){BLANK}*\)$", f"{_MINUS}$1")
    s = F.regexp_replace(s, rf"^({_MINUS}?)[€£$¥]{BLANK}*", "$1")
    s = F.regexp_replace(s, rf"(?i)^({_MINUS}?)(?:EUR|GBP|USD|CHF|JPY|CAD){BLANK}*", "$1")
    s = F.regexp_replace(s, rf"(?:{_FOOTNOTES}+{BLANK}*|{BLANK}+)$", "")
    s = F.regexp_replace(s, rf"{BLANK}+$", "")
    s = F.regexp_replace(s, rf"%{BLANK}*$", "")
    s = F.regexp_replace(s, rf"{BLANK}+$", "")
    s = F.regexp_replace(s, rf"^({_MINUS}?)\+{BLANK}*", "$1")
    s = F.regexp_replace(s, rf"^{_MINUS}-{BLANK}*", _PLUS)
    s = F.regexp_replace(s, rf"^-{BLANK}*", _MINUS)
    return F.regexp_replace(s, f"^{_PLUS}", "")


def _number(value: Column, error: Column) -> Column:
    return F.struct(F.when(error.isNull(), value).cast(WIDE).alias("value"), error.alias("error"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, where it is a member of an
    array (else a projected column does it): lambdas are interpreted."""
    return F.transform(F.array(value), body)[0]


def _styles() -> dict[tuple[str, str], list[str]]:
    styles: dict[tuple[str, str], list[str]] = {}
    for name, style in LOCALES.items():
        styles.setdefault(style, []).append(name)
    return styles


def _common(core: Column, locale: Column) -> Column:
    """A cleaned cell with decimal points and thousands commas, whatever its
    locale's; characters that are separators elsewhere become foreign ones.
    Null for an unknown locale."""
    out = F.lit(None).cast("string")
    for (dec, thousands), names in _styles().items():
        foreign = "".join(c for c in ".," if c not in dec + thousands)
        there = dec + thousands + foreign
        here = "." + "," * len(thousands) + "?" * len(foreign)
        same = core if there == here else F.translate(core, there, here)
        out = F.when(locale.isin(names), same).otherwise(out)
    return out


def parse_decimal(df: DataFrame, out: str, raw: Column, locale: Column) -> DataFrame:
    """``df`` with ``out``: struct<value, error> of a verbatim cell. Errors:
    unknown_locale, empty, placeholder, separators (more than one decimal one),
    grouping, residue (not digits), no_digits, too_long (beyond the decimal
    type). Names beginning with ``__num_`` are taken meanwhile."""
    bound = df.withColumns({"__num_bare": strip(raw), "__num_locale": locale})
    bare = F.col("__num_bare")
    # A cell of digits and separators alone has nothing to come off.
    core = F.when(bare.rlike(r"^[0-9][0-9.,]*$"), bare).otherwise(_clean(bare))
    cleaned = bound.withColumn("__num_core", core).withColumn("__num_text", _common(F.col("__num_core"), F.col("__num_locale")))
    text = F.col("__num_text")
    grouped = text.contains(",") & text.rlike(rf"^{_MINUS}?[^.]*,") & ~text.rlike(rf"^{_MINUS}?[0-9]{{1,3}}(?:,[0-9]{{3}})+(?:\.|$)")
    judged = cleaned.withColumns({
        "__num_value": F.translate(text, _MINUS + ",", "-").try_cast(WIDE),
        "__num_error": F.when(text.isNull() & F.col("__num_core").isNotNull(), "unknown_locale")
        .when(F.col("__num_locale").isNull() | ~F.col("__num_locale").isin(list(LOCALES)), "unknown_locale")
        .when(bare.isNull() | (bare == ""), "empty")
        .when(bare.rlike(r"^(?:[-–—]|(?i:n/a|na))$"), "placeholder")
        .when(F.col("__num_core").isin("", _MINUS), "no_digits")
        .when(F.length(text) - F.length(F.replace(text, F.lit("."))) > 1, "separators")
        .when(grouped, "grouping")
        .when(~text.rlike(rf"^{_MINUS}?[0-9,]*(?:\.[0-9]*)?$"), "residue")
        .when(~text.rlike("[0-9]"), "no_digits"),
    })
    error = F.coalesce("__num_error", F.when(F.col("__num_value").isNull(), "too_long"))
    done = judged.withColumn("__num_error", error).withColumn(out, _number(F.col("__num_value"), F.col("__num_error")))
    return done.drop("__num_bare", "__num_locale", "__num_core", "__num_text", "__num_value", "__num_error")


def _multiplier(word: Column) -> Column:
    out = F.lit(1)
    for name, mult in SCALE_WORDS.items():
        out = F.when(word == name, F.lit(mult)).otherwise(out)
    return out.cast("decimal(18,0)")


def detect_scale(raw: Column) -> Column:
    """Multiplier of the scale word that ends a cell, else 1."""
    return _multiplier(F.lower(F.regexp_extract(raw, _SCALE, 1)))


def scale_multiplier(name: Column) -> Column:
    """Multiplier of a disclosure's scale; an unknown one is a configuration error and raises."""
    out = F.raise_error(F.concat(F.lit("unknown monetary scale: "), F.coalesce(name, F.lit("null")))).cast("decimal(18,0)")
    for known, mult in SCALES.items():
        out = F.when(name == known, F.lit(mult).cast("decimal(18,0)")).otherwise(out)
    return out


def unit_for(kind: Column, currency: Column) -> Column:
    """Unit of a field kind in a currency; a currency without a unit raises."""
    out = F.raise_error(F.concat(F.lit("no monetary unit for currency "), F.coalesce(currency, F.lit("null")))).cast("string")
    for code, unit in CURRENCY_UNITS.items():
        out = F.when(currency == code, F.lit(unit)).otherwise(out)
    return F.when(kind.isin("PERCENT", "RATIO", "COUNT"), kind).otherwise(out)


def normalise(df: DataFrame, out: str, raw: Column, locale: Column, unit: Column, monetary_scale: Column | None = None, band: tuple = PERCENT_BAND) -> DataFrame:
    """``df`` with ``out``: struct<value, error> in the field's unit: percent
    as such, a ratio as a fraction, money in millions (a scale word in the cell
    overrides the disclosure's scale), counts as they are. More errors: band (a
    percentage outside it), percent (a percent sign on another unit). Names
    beginning with ``__nrm_`` are taken meanwhile."""
    scale = scale_multiplier(monetary_scale) if monetary_scale is not None else F.lit(10**6).cast("decimal(18,0)")
    bound = df.withColumns({"__nrm_raw": raw, "__nrm_unit": unit, "__nrm_locale": locale}).withColumn("__nrm_word", F.lower(F.regexp_extract("__nrm_raw", _SCALE, 1)))
    money, ratio = F.col("__nrm_unit").isin(MONETARY_UNITS), F.col("__nrm_unit") == "RATIO"
    worded = bound.withColumn("__nrm_own", _multiplier(F.col("__nrm_word")))
    cell = F.when(money & (F.col("__nrm_word") != ""), F.regexp_replace("__nrm_raw", _SCALE, "")).otherwise(F.col("__nrm_raw"))
    parsed = parse_decimal(worded, "__nrm_parsed", cell, F.col("__nrm_locale"))
    value, own, sign = F.col("__nrm_parsed.value"), F.col("__nrm_own"), F.col("__nrm_raw").contains("%")
    # Powers of ten only, by multiplication: exact in decimals.
    in_millions = value * (F.when(own != 1, own).otherwise(scale) * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(12,6)")
    fraction = F.when(sign, value * F.lit("0.01").cast("decimal(3,2)")).otherwise(value)
    percent = F.when(ratio & ~sign, value * 100).otherwise(value)
    rate = F.col("__nrm_unit").isin("PERCENT", "RATIO")
    outside = rate & ~percent.between(*(F.lit(b).cast("decimal(10,0)") for b in band))
    fault = F.when(~rate & sign, "percent").when(F.col("__nrm_parsed.error").isNotNull(), F.col("__nrm_parsed.error")).when(outside, "band")
    final = F.when(money, in_millions.cast(WIDE)).when(ratio, fraction.cast(WIDE)).otherwise(value)
    done = parsed.withColumn("__nrm_fault", fault).withColumn(out, _number(final, F.col("__nrm_fault")))
    return done.drop("__nrm_raw", "__nrm_unit", "__nrm_locale", "__nrm_word", "__nrm_own", "__nrm_parsed", "__nrm_fault")


def parse_canonical(raw: Column) -> Column:
    """A plain number ``[+-]digits[.digits]`` with blanks around, else null."""
    bare = strip(raw)
    return F.when(bare.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), bare.try_cast(WIDE))


def to_canonical(value: Column, stored_as: Column) -> Column:
    """Fractions become percentages; amounts and percentages stay."""
    return F.when(stored_as == "FRACTION", (value * 100).cast(WIDE)).otherwise(value)

"""Reporting periods: labels, and their resolution from free text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = r"^[0-9]{4}(Q[1-4]|FY)$"


def is_period(label: Column) -> Column:
    return F.coalesce(label.rlike(PERIOD), F.lit(False))


def period_year(label: Column) -> Column:
    return F.when(is_period(label), F.left(label, F.lit(4)).cast("int"))


def period_quarter(label: Column) -> Column:
    return F.when(is_period(label) & ~label.endswith("FY"), F.right(label, F.lit(1)).cast("int"))


def period_ord(label: Column) -> Column:
    """Sort key: quarters in order, a full year after its fourth quarter."""
    return period_year(label) * 10 + F.coalesce(period_quarter(label), F.lit(5))


def period_label(year: Column, quarter: Column) -> Column:
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.coalesce(F.concat(F.lit("Q"), quarter.cast("string")), F.lit("FY")))


# ---- periods in free text ---------------------------------------------------
#
# A text is cut once into words and numbers. Readers then try to recognise one
# phrase each, beginning at a given token; every kind of phrase is read from
# left to right without overlap.

#: Weights of the signals and the limits of the search. Fixed values.
LONG_DATE, NUMERIC_DATE, TOKEN = Decimal("0.60"), Decimal("0.55"), Decimal("0.70")
AS_AT, AT, HEADING, MOST = Decimal("0.20"), Decimal("0.10"), Decimal("0.15"), Decimal("0.99")
YEARS, HEADING_CHARS, NEAR_TIE = (2000, 2099), 80, Decimal("0.05")
QUARTER_ENDS = {(31, 3): 1, (30, 6): 2, (30, 9): 3, (31, 12): 4}
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4}
HEADINGS = ["key prudential metrics", "prudential metrics", "key metrics", "km1", "ov1"]

_PIECE = re.compile(r"[^\W\d_]+|\d+")


class Token(NamedTuple):
    """A run of letters (in lower case) or of digits, and what stands before it."""

    text: str
    start: int
    end: int
    gap: str
    free: bool  # no letter, digit or underscore touches its front
    open: bool  # nor its back
    number: bool


class Phrase(NamedTuple):
    """A recognised period (quarter 0: a date that ends none), its characters and its last token."""

    year: int
    quarter: int | None
    start: int
    end: int
    last: int


def tokens(text: str) -> list[Token]:
    out, at, padded = [], 0, f" {text} "
    for m in _PIECE.finditer(text):
        start, end = m.span()
        before, after, piece = padded[start], padded[end + 1], m.group().lower()
        out.append(Token(piece, start, end, text[at:start], not (before.isalnum() or before == "_"), not (after.isalnum() or after == "_"), piece[0].isdecimal()))
        at = end
    return out


def _blank(token: Token, least: int = 1) -> bool:
    """Whether only white space (at least so much) stands before a token."""
    return len(token.gap) >= least and (not token.gap or token.gap.isspace())


def _is_year(token: Token) -> bool:
    return token.number and len(token.text) == 4


def _day(token: Token) -> tuple[int, int]:
    """The last two digits of a number, and where they begin."""
    return int(token.text[-2:]), max(token.start, token.end - 2)


def _quarter_of(day: int, month: int | None) -> int:
    """0: not the end of a quarter."""
    return QUARTER_ENDS.get((day, month), 0) if month else 0


def _long_date(t: list[Token], i: int) -> Phrase | None:
    """31 December 2025, 31st Dec. 2025"""
    if not t[i].number:
        return None
    k = i + 1
    if k < len(t) and t[k].text in ("st", "nd", "rd", "th") and not t[k].gap:
        k += 1
    if k + 1 >= len(t) or t[k].text not in MONTHS or not _blank(t[k]) or not t[k].open or not _is_year(t[k + 1]):
        return None
    if not (t[k + 1].gap.removeprefix(".") or "x").isspace():
        return None
    day, start = _day(t[i])
    return Phrase(int(t[k + 1].text), _quarter_of(day, MONTHS[t[k].text]), start, t[k + 1].end, k + 1)


def _day_first(t: list[Token], i: int) -> Phrase | None:
    """31/12/2025, with points or hyphens too"""
    if i + 2 >= len(t) or not (t[i].number and t[i + 1].number and len(t[i + 1].text) <= 2 and _is_year(t[i + 2])):
        return None
    if any(x.gap not in ("/", ".", "-") for x in t[i + 1 : i + 3]):
        return None
    day, start = _day(t[i])
    return Phrase(int(t[i + 2].text), _quarter_of(day, int(t[i + 1].text)), start, t[i + 2].end, i + 2)


def _year_first(t: list[Token], i: int) -> Phrase | None:
    """2025-12-31"""
    if i + 2 >= len(t) or not (t[i].number and len(t[i].text) >= 4) or any(x.gap != "-" or not x.number or len(x.text) != 2 for x in t[i + 1 : i + 3]):
        return None
    return Phrase(int(t[i].text[-4:]), _quarter_of(int(t[i + 2].text), int(t[i + 1].text)), t[i].end - 4, t[i + 2].end, i + 2)


def _quarter_token(t: list[Token], i: int) -> Phrase | None:
    """Q4 2025, Q4 FY2025, Q42025, 2025 Q4"""
    if i + 1 >= len(t):
        return None
    after = t[i + 1]
    if t[i].number:
        q = t[i + 2] if i + 2 < len(t) else None
        if len(t[i].text) < 4 or after.text != "q" or not _blank(after, 0) or q is None or not q.number or q.gap or q.text[0] not in "1234":
            return None
        return Phrase(int(t[i].text[-4:]), int(q.text[0]), t[i].end - 4, q.start + 1, i + 2)
    if not t[i].text.endswith("q") or not after.number or after.gap or after.text[0] not in "1234":
        return None
    start, quarter = t[i].end - 1, int(after.text[0])
    if len(after.text) == 5:
        return Phrase(int(after.text[1:]), quarter, start, after.end, i + 1)
    k = i + 2
    if k < len(t) and t[k].text == "fy" and _blank(t[k], 0):
        k += 1
    if len(after.text) > 1 or k >= len(t) or not _is_year(t[k]) or not _blank(t[k], 0):
        return None
    return Phrase(int(t[k].text), quarter, start, t[k].end, k)


def _quarter_in_words(t: list[Token], i: int) -> Phrase | None:
    """fourth quarter 2025, fourth quarter of 2025"""
    which = next((o for o in ORDINALS if t[i].text.endswith(o)), None)
    if which is None or i + 2 >= len(t) or t[i + 1].text != "quarter" or not _blank(t[i + 1]):
        return None
    k = i + 3 if t[i + 2].text == "of" and _blank(t[i + 2]) else i + 2
    if k >= len(t) or not _is_year(t[k]) or not _blank(t[k]):
        return None
    return Phrase(int(t[k].text), ORDINALS[which], t[i].end - len(which), t[k].end, k)


def _annual(t: list[Token], i: int) -> Phrase | None:
    """FY2025, full year 2025, financial year 2025, fiscal year 2025"""
    if not t[i].free:
        return None
    k, least = i + 1, 0
    if t[i].text in ("full", "financial", "fiscal"):
        between = t[k].gap.replace("-", " ") if k < len(t) and t[i].text == "full" else t[k].gap if k < len(t) else ""
        if k >= len(t) or t[k].text != "year" or not between.isspace():
            return None
        k, least = i + 2, 1
    elif t[i].text != "fy":
        return None
    if k >= len(t) or not _is_year(t[k]) or not _blank(t[k], least) or not t[k].open:
        return None
    return Phrase(int(t[k].text), None, t[i].start, t[k].end, k)


#: Readers with the weight of what they find, whether "as at", "as of" or "at" may lead it in, and which tokens may begin it.
_READERS = [
    (_long_date, LONG_DATE, True, lambda t: t.number),
    (_day_first, NUMERIC_DATE, True, lambda t: t.number),
    (_year_first, NUMERIC_DATE, True, lambda t: t.number),
    (_quarter_token, TOKEN, True, lambda t: t.number or t.text[-1] == "q"),
    (_quarter_in_words, TOKEN, False, lambda t: t.text.endswith(tuple(ORDINALS))),
    (_annual, TOKEN, False, lambda t: t.text in ("fy", "full", "financial", "fiscal")),
]


def _lead_in(t: list[Token], i: int, start: int) -> tuple[Decimal, int]:
    """The bonus of the words before a phrase and where they begin."""
    if start != t[i].start or not _blank(t[i]):
        return Decimal(0), start
    bonus, k = Decimal(0), i
    if k and t[k - 1].text == "at" and t[k - 1].free:
        bonus, k, start = AT, k - 1, t[k - 1].start
    for end in {k, i}:  # "as of at" leads in as a whole, "as at" by its own "at"
        if end >= 2 and t[end - 1].text in ("at", "of") and t[end - 2].text == "as" and t[end - 2].free and _blank(t[end - 1]) and _blank(t[end]):
            return AS_AT, t[end - 2].start
    return bonus, start


#: Headings by their first word: the words and what stands between them.
_HEADING_WORDS: dict[str, list[tuple[list[str], list[str]]]] = {}
for _heading in HEADINGS:
    _cut = tokens(_heading)
    _HEADING_WORDS.setdefault(_cut[0].text, []).append(([x.text for x in _cut], [x.gap for x in _cut[1:]]))


def _headings(t: list[Token]) -> list[tuple[int, int]]:
    """(start, end) of each heading keyword."""
    out = []
    for i, token in enumerate(t):
        for words, gaps in _HEADING_WORDS.get(token.text, ()) if token.free else ():
            run = t[i : i + len(words)]
            if [x.text for x in run] == words and [x.gap for x in run[1:]] == gaps and run[-1].open:
                out.append((token.start, run[-1].end))
    return out


def scan_periods(text: str | None) -> Iterator[tuple]:
    """(year, quarter or None, evidence, confidence, start, end, seq) of every signal, unranked."""
    t, headings, seq = tokens(text or ""), None, 0
    for read, weight, led, begins in _READERS:
        free = 0
        for i in [i for i, token in enumerate(t) if begins(token)]:
            found = read(t, i) if i >= free else None
            if found is None:
                continue
            free = found.last + 1
            if found.quarter == 0 or not YEARS[0] <= found.year <= YEARS[1]:
                continue
            bonus, start = _lead_in(t, i, found.start) if led else (Decimal(0), found.start)
            headings = _headings(t) if headings is None else headings
            before = [h for h in headings if h[0] >= start - HEADING_CHARS and h[1] <= start]
            if before:
                bonus, start = bonus + HEADING, before[0][0]
            yield found.year, found.quarter, text[start : found.end], min(weight + bonus, MOST), start, found.end, seq
            seq += 1


_SIGNAL = "year int, quarter int, evidence string, confidence decimal(3,2), start int, end int, seq int"


def period_candidates(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Best candidate of each period of each text (most confident, then first
    seen), with ``period``; texts without any keep a row of nulls. A bare year
    is no signal. Texts without four digits in a row do not leave the JVM;
    every row is answered for itself, so nothing is shuffled."""
    source = texts.select(F.col(id_col).alias("doc_id"), F.when(F.col(text_col).rlike(r"\p{Nd}{4}"), F.col(text_col)).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int32(), pa.int32(), pa.string(), pa.decimal128(3, 2), pa.int32(), pa.int32(), pa.int32()]
        names = [c.split()[0] for c in _SIGNAL.split(", ")]
        for batch in batches:
            place, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                best: dict[tuple, tuple] = {}
                for c in scan_periods(text):
                    if c[:2] not in best or c[3] > best[c[:2]][3]:
                        best[c[:2]] = c
                found = list(best.values()) or [(None,) * 7]
                place += [k] * len(found)
                rows += found
            columns = [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place, pa.int64())), *columns], names=["doc_id", *names])

    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {_SIGNAL}"
    return source.mapInArrow(run, schema).withColumn("period", F.when(F.col("year").isNotNull(), period_label(F.col("year"), F.col("quarter"))))


def _ranked(candidates: DataFrame) -> DataFrame:
    order = [F.desc_nulls_last(F.col("year") * 10 + F.coalesce("quarter", F.lit(5))), F.desc("confidence"), "seq"]
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))


def resolve_latest(candidates: DataFrame, prefer: str | None = None) -> DataFrame:
    """The latest period of each text. ``prefer='quarter_end'`` leaves annual candidates out."""
    if prefer not in (None, "quarter_end"):
        raise ValueError(f"unknown preference {prefer}")
    pool = candidates.filter(F.col("year").isNull() | F.col("quarter").isNotNull()) if prefer else candidates
    best = _ranked(pool).filter("rank = 1").drop("rank")
    return candidates.select("doc_id").distinct().join(best, "doc_id", "left")


def ambiguous(candidates: DataFrame, delta: Decimal = NEAR_TIE) -> DataFrame:
    """(doc_id, ambiguous): whether the two best periods are of one year and nearly as confident."""
    top = _ranked(candidates.filter("year is not null")).filter("rank <= 2")
    pair = top.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("a"), F.max("year").alias("b"), (F.max("confidence") - F.min("confidence")).alias("gap"))
    flag = (F.col("n") == 2) & (F.col("a") == F.col("b")) & (F.col("gap") <= F.lit(delta))
    return candidates.select("doc_id").distinct().join(pair.select("doc_id", flag.alias("ambiguous")), "doc_id", "left").withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False)))


def explain(candidates: DataFrame) -> DataFrame:
    """One audit line per candidate."""
    line = F.format_string("period=%s confidence=%s evidence='%s' (chars[%d:%d])", "period", F.col("confidence").cast("string"), "evidence", "start", "end")
    return candidates.withColumn("explanation", F.when(F.col("year").isNotNull(), line))

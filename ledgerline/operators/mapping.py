"""From cell grids to canonical field values: classification, label matching,
the bounded fallback and the merge of two engines' opinions.

All documents are mapped in one job. ``docs`` gives each document's filing:
(doc_id, bank, period, template, source_url, number_locale,
reporting_currency, monetary_scale).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import is_label, norm_label
from ..functions.numbers import normalise, unit_for
from ..plans import schema as S

TABLE = ["doc_id", "engine", "table_idx"]
MIN_MATCHES = 2


def aliases_of(template_fields: DataFrame, strict_footnotes: bool = False) -> DataFrame:
    """(template, code, field_ord, kind, ecl, floor, alias, alias_ord, label).

    ``strict_footnotes``: an alias that ends in a number keeps it, and so
    matches only labels that keep theirs.
    """
    rows = template_fields.select("*", F.posexplode("aliases").alias("alias_ord", "alias")).drop("aliases").withColumn("keeps_tail", F.col("alias").rlike(r" [0-9]{1,2}$") & F.lit(strict_footnotes))
    return norm_label(rows, "label", F.col("alias"), F.col("keeps_tail"))


def label_index(cells: DataFrame) -> DataFrame:
    """(table, label, label_text, row_idx, label_col, collides, cells): each
    row's leftmost cell with letters and the row's cells; of rows with the same
    label the topmost.

    Cells are dealt by document once; every further grouping of a document's
    tables, rows, labels and fields finds them in place. Documents and tables
    are bounded by their pages.
    """
    dealt = cells.select(*TABLE, "row_idx", "col_idx", "text", "bbox").repartition("doc_id")
    named = norm_label(dealt, "label", F.col("text"))
    # Conditions stand in the aggregate: a filter would be pushed below the steps and repeat them.
    first = F.min_by(F.struct("label", F.col("text").alias("label_text"), F.col("col_idx").alias("label_col")), F.when(is_label(F.col("label")), F.col("col_idx")))
    rows = named.groupBy(*TABLE, "row_idx").agg(first.alias("l"), F.collect_list(F.struct("col_idx", "text", "bbox")).alias("cells")).filter("l is not null")
    top = F.min_by(F.struct("row_idx", "l.label_text", "l.label_col", "cells"), "row_idx")
    return rows.groupBy(*TABLE, F.col("l.label").alias("label")).agg(top.alias("r"), (F.count(F.lit(1)) > 1).alias("collides")).select(*TABLE, "label", "r.*", "collides")


def match_rows(index: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows claimed by each field: its first alias, in the template's order, that is a label of the table."""
    joined = index.join(F.broadcast(aliases.filter(~F.col("keeps_tail"))), "label")  # aliases are configuration
    return joined.groupBy(*TABLE, "template", "code").agg(F.min_by(F.struct("alias", "alias_ord", "row_idx", "label", "label_text", "label_col", "cells", "kind", "ecl", "floor", "field_ord"), "alias_ord").alias("m")).select(*TABLE, "template", "code", "m.*")


def _claims(cells: DataFrame, template_fields: DataFrame, docs: DataFrame, min_matches: int, strict_footnotes: bool, tables: str = "best") -> DataFrame:
    """Rows claimed in the chosen table (``tables="all"``: in every table with
    enough matches) of each document and engine, with the document's filing and
    the table's ``score``."""
    if tables not in ("best", "all"):
        raise ValueError(f"tables: {tables}")
    matched = match_rows(label_index(cells), aliases_of(template_fields, strict_footnotes)).join(docs, ["doc_id", "template"])
    scored = matched.withColumn("score", F.count("code").over(Window.partitionBy("doc_id", "template", "engine", "table_idx")))
    if tables == "all":
        return scored.filter(F.col("score") >= min_matches)
    place = F.struct("score", (-F.col("table_idx")).alias("t"))
    best = scored.withColumn("__best", F.max(place).over(Window.partitionBy("doc_id", "template", "engine")))
    return best.filter((F.col("__best.score") == F.col("score")) & (F.col("__best.t") == -F.col("table_idx")) & (F.col("score") >= min_matches)).drop("__best")


def classify(cells: DataFrame, template_fields: DataFrame, docs: DataFrame, min_matches: int = MIN_MATCHES, strict_footnotes: bool = False) -> DataFrame:
    """(doc_id, engine, template, table_idx, score): the table of each document
    that matches most of its template's fields, at least ``min_matches``; ties
    go to the first table."""
    claims = _claims(cells, template_fields, docs, min_matches, strict_footnotes)
    return claims.groupBy("doc_id", "engine", "template", "table_idx").agg(F.max("score").alias("score"))


def _first_values(claims: DataFrame) -> DataFrame:
    """The claims with ``v``: the first cell right of each claimed row's label
    that is a number in the field's unit, null if there is none."""
    keep = [c for c in claims.columns if c != "cells"]
    right = claims.select(*keep, F.explode_outer(F.filter("cells", lambda c: c["col_idx"] > F.col("label_col"))).alias("c"))
    placed = right.withColumn("unit", unit_for(F.col("kind"), F.col("reporting_currency")))
    parsed = normalise(placed, "__p", F.col("c.text"), F.col("number_locale"), F.col("unit"), F.col("monetary_scale"))
    found = F.struct(F.col("c.text").alias("raw_text"), F.col("c.bbox").alias("bbox"), F.col("__p.value").alias("wide"), "unit")
    first = F.min_by(found, F.when(F.col("__p.value").isNotNull(), F.col("c.col_idx")))
    key = ["doc_id", "template", "engine", "table_idx", "code"]
    return parsed.groupBy(*key).agg(first.alias("v"), *[F.first(c).alias(c) for c in keep if c not in key])


def _as_values(found: DataFrame, mapping: Column) -> DataFrame:
    """Claims that found a number, as field values."""
    value = F.col("wide").cast(S.COMPUTE)
    out = found.filter("v is not null").select("*", "v.*").select(
        "bank", "period", "template", "doc_id", F.col("code").alias("field_code"), value.alias("value"), "unit",
        F.col("ecl").alias("ecl_basis"), F.col("floor").alias("floor_basis"), "engine", F.lit("PDF").alias("source_kind"),
        "source_url", "bbox", "monetary_scale", mapping.alias("mapping"), "raw_text", F.create_map(F.col("engine"), value).alias("engine_values"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.FIELD_VALUES.fields])


def _none(*names: str) -> list[Column]:
    return [F.lit(None).cast("string").alias(n) for n in names]


def map_fields(cells: DataFrame, template_fields: DataFrame, docs: DataFrame, min_matches: int = MIN_MATCHES, strict_footnotes: bool = False, tables: str = "best") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(field values, unmatched fields, documents without a usable table).

    ``tables``: 'best' reads the table that matches most fields; 'all' reads
    every table with enough matches, for templates that run over pages: a field
    then comes from the fullest table that gives it a number (ties: the first).
    Unmatched: (doc_id, engine, template, table_idx, code, field_ord) of the
    template's fields that no row gave a number, under the fullest table.
    """
    found = _first_values(_claims(cells, template_fields, docs, min_matches, strict_footnotes, tables))
    if tables == "all":
        order = [F.col("v").isNull(), F.desc("score"), "table_idx"]
        found = found.withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "template", "engine", "code").orderBy(*order))).filter("__n = 1").drop("__n")
    rule = F.struct(F.lit("RULE").alias("method"), *_none("model", "prompt_sha", "prompt_version"), F.col("alias").alias("matched_alias"), F.lit(1.0).alias("confidence"))
    values = _as_values(found, rule)
    fullest = F.max(F.struct("score", (-F.col("table_idx")).alias("t"))).alias("b")
    have = found.groupBy("doc_id", "template", "engine").agg(fullest, F.collect_set(F.when(F.col("v").isNotNull(), F.col("code"))).alias("have"))
    wanted = template_fields.groupBy("template").agg(F.collect_list(F.struct("code", "field_ord")).alias("fields"))
    missing = have.join(F.broadcast(wanted), "template").select("doc_id", "engine", "template", (-F.col("b.t")).cast("int").alias("table_idx"), F.explode(F.filter("fields", lambda f: ~F.array_contains("have", f["code"]))).alias("f"))
    unmatched = missing.select("doc_id", "engine", "template", "table_idx", "f.code", "f.field_ord")
    chosen = have.select("doc_id", "template")
    without = docs.select("doc_id", "bank", "period", "template").join(chosen, ["doc_id", "template"], "left_anti").withColumn("error", F.lit("no table matches the template"))
    return values, unmatched, without


def unused_rows(cells: DataFrame, unmatched: DataFrame, template_fields: DataFrame) -> DataFrame:
    """(table, label, label_text, row_idx, label_col, cells) of rows that no
    matched field claims: candidates of the fallback."""
    tables = unmatched.select(*TABLE, "template").distinct()
    index = label_index(cells.join(tables.drop("template").distinct(), TABLE, "left_semi")).drop("collides")
    claims = match_rows(index, aliases_of(template_fields)).join(tables, [*TABLE, "template"], "left_semi")
    owned = claims.join(unmatched.select(*TABLE, "template", "code"), [*TABLE, "template", "code"], "left_anti")
    return index.join(owned.select(*TABLE, "label").distinct(), [*TABLE, "label"], "left_anti")


def fallback_prompts(cells: DataFrame, unmatched: DataFrame, template_fields: DataFrame) -> DataFrame:
    """(table, template, prompt, prompt_sha): the question to a mapper per
    table, with fields in the template's order and candidate rows from the top,
    so that equal inputs give equal texts."""
    line = F.concat(F.lit("- "), F.col("code"), F.lit(": "), F.array_join("aliases", " | "))
    fields = unmatched.join(F.broadcast(template_fields.drop("field_ord")), ["template", "code"]).groupBy(*TABLE, "template").agg(F.array_sort(F.collect_list(F.struct("field_ord", line.alias("line")))).alias("f"))
    rows = unused_rows(cells, unmatched, template_fields).groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("row_idx", F.concat(F.lit("- "), F.col("label_text")).alias("line")))).alias("r"))
    joined = fields.join(rows, TABLE, "left")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Which row of the table, if any, states each field of "), F.col("template"), F.lit("? Answer with a row's label as written, or null. Never answer with a number.")),
        F.lit("Fields:"), F.array_join(F.transform("f", lambda x: x["line"]), "\n"),
        F.lit("Rows:"), F.array_join(F.transform(F.coalesce("r", F.array().cast("array<struct<row_idx:int,line:string>>")), lambda x: x["line"]), "\n"),
    )
    return joined.select(*TABLE, "template", text.alias("prompt")).withColumn("prompt_sha", F.sha2("prompt", 256))


def map_unmatched(cells: DataFrame, unmatched: DataFrame, template_fields: DataFrame, docs: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(field values, audit) from a mapper's ``decisions``: (doc_id, engine,
    table_idx, code, label, confidence, model, prompt_sha, prompt_version).

    The mapper only picks a row; digits always come from the grid. Audit: every
    decision with its ``reason``: mapped, no_row (null answer), out_of_scope (a
    field not asked for), bad_confidence, unknown_row, no_number.
    """
    rows = unused_rows(cells, unmatched, template_fields)
    asked = unmatched.select(*TABLE, "template", "code", F.lit(True).alias("asked"))
    spec = template_fields.select("template", "code", "kind", "ecl", "floor", "field_ord")
    seen = norm_label(decisions, "label_key", F.col("label")).join(asked, [*TABLE, "code"], "left")
    placed = seen.join(rows.withColumnRenamed("label", "label_key"), [*TABLE, "label_key"], "left")
    sure = F.col("confidence").between(0, 1) & ~F.isnan("confidence")
    reason = F.when(F.col("asked").isNull(), "out_of_scope").when(~F.coalesce(sure, F.lit(False)), "bad_confidence").when(F.col("label").isNull(), "no_row").when(F.col("row_idx").isNull(), "unknown_row")
    judged = placed.withColumn("reason", reason)
    claims = judged.filter("reason is null").join(F.broadcast(spec), ["template", "code"]).join(docs, ["doc_id", "template"])  # the spec is configuration
    found = _first_values(claims)
    picked = F.struct(F.lit("LLM").alias("method"), "model", "prompt_sha", "prompt_version", F.col("label_text").alias("matched_alias"), F.col("confidence").cast("double").alias("confidence"))
    mapped = found.filter("v is not null").select(*TABLE, "code", F.lit("mapped").alias("ok"))
    audit = judged.join(mapped, [*TABLE, "code"], "left").select(*TABLE, "code", "label", "confidence", F.coalesce("reason", "ok", F.lit("no_number")).alias("reason"))
    return _as_values(found, picked), audit


def first_wins(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): of repeated fields of a filing, rule-mapped ones come before picked ones, then the topmost."""
    order = [F.when(F.col("mapping.method") == "RULE", 0).otherwise(1), F.col("bbox.page").asc_nulls_last(), F.col("bbox.y0").asc_nulls_last(), F.col("raw_text")]
    ranked = values.withColumn("__n", F.row_number().over(Window.partitionBy(*S.FILING, "engine", "field_code").orderBy(*order)))
    return ranked.filter("__n = 1").drop("__n"), ranked.filter("__n > 1").drop("__n")


def merge_engines(primary: DataFrame, secondary: DataFrame, seq_col: str | None = None) -> DataFrame:
    """Primary values with the second engine's opinion in ``engine_values``;
    of repeated opinions the last (by ``seq_col``, else by place) counts.
    Fields that only the second engine found are not added (see ``coverage``)."""
    last = F.col(seq_col) if seq_col else F.struct(F.coalesce(F.col("bbox.page"), F.lit(0)), F.coalesce(F.col("bbox.y0"), F.lit(0.0)), "value")
    opinion = secondary.groupBy(*S.FILING, "field_code").agg(F.max_by(F.struct("engine", "value"), last).alias("__o"))
    other = F.filter(F.map_entries("engine_values"), lambda e: e["key"] != F.col("__o.engine"))
    merged = F.when(F.col("__o").isNull(), F.col("engine_values")).otherwise(F.map_from_entries(F.concat(other, F.array(F.struct(F.col("__o.engine").alias("key"), F.col("__o.value").alias("value"))))))
    return primary.join(opinion, [*S.FILING, "field_code"], "left").withColumn("engine_values", merged).drop("__o").select(*primary.columns)


def coverage(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """(filing, field_code, only_in): fields that one engine alone found."""
    key = [*S.FILING, "field_code"]
    a, b = primary.select(*key).distinct(), secondary.select(*key).distinct()
    return a.join(b, key, "left_anti").withColumn("only_in", F.lit("primary")).unionByName(b.join(a, key, "left_anti").withColumn("only_in", F.lit("secondary")))

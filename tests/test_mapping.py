from decimal import Decimal as D

import pytest

from ledgerline.errors import ExtractionError, NoTemplateTableError
from ledgerline.operators import mapping
from ledgerline.plans import pipeline
from ledgerline.sources import cells as C
from ledgerline.sources import config

from .helpers import KM1, KM1_GRID, OV1_GRID, docs, grid, results


def mapped(spark, cells, template="KM1", **kw):
    return mapping.map_fields(cells, config.template_fields(spark, template), docs(spark, template, **kw))


def figures(df):
    return {r["field_code"]: r["value"] for r in df.collect()}


def test_grid_to_values(spark):
    vals, unmatched, without = mapped(spark, grid(spark, KM1_GRID))
    assert figures(vals) == {k: D(v) for k, v in KM1.items()}
    assert {r["code"] for r in unmatched.collect()} == {"KM1.13", "KM1.14", "KM1.15", "KM1.16", "KM1.17", "KM1.18", "KM1.19", "KM1.20"}
    assert without.isEmpty()
    row = vals.filter("field_code = 'KM1.1'").first()
    assert row["mapping"]["matched_alias"] == "Common Equity Tier 1 (CET1) capital" and row["unit"] == "GBP_M" and row["raw_text"] == "36,800"


def test_ov1_and_sweep_result(spark):
    vals, _, _ = mapped(spark, grid(spark, OV1_GRID), "OV1")
    assert len(figures(vals)) == 7
    got = results(spark, vals)
    assert {r["status"] for r in got.values()} == {"AUTO_PASSED"} and {r["confidence"] for r in got.values()} == {D("0.97")}


def test_best_table_wins_and_ties_go_first(spark):
    decoy = grid(spark, KM1_GRID[:3], table=0)
    vals, _, _ = mapped(spark, decoy.unionByName(grid(spark, KM1_GRID, table=1)).unionByName(grid(spark, [[r[0], "1"] for r in KM1_GRID], table=2)))
    assert figures(vals)["KM1.4"] == 243500
    _, _, without = mapped(spark, grid(spark, [["Total capital", "5"], ["something", "6"]]))
    assert without.first()["error"] == "no table matches the template"


def test_templates_over_several_tables(spark):
    first, second = grid(spark, KM1_GRID[:4], table=0), grid(spark, [["Tier 1 capital", "n/a"], *KM1_GRID[4:]], table=3)
    both = first.unionByName(second).unionByName(grid(spark, [["Total capital", "9"], ["something", "6"]], table=1))
    vals, unmatched, _ = mapped(spark, both)
    assert len(figures(vals)) == 3 and {r["table_idx"] for r in unmatched.collect()} == {3}
    vals, unmatched, without = mapping.map_fields(both, config.template_fields(spark, "KM1"), docs(spark), tables="all")
    assert figures(vals) == {k: D(v) for k, v in KM1.items() if k != "KM1.2"} and without.isEmpty()  # the topmost row of a label counts
    assert {r["table_idx"] for r in unmatched.collect()} == {3} and "KM1.2" in {r["code"] for r in unmatched.collect()}
    again = both.unionByName(grid(spark, [["Tier 1 capital", "41,900"], ["Total capital", "1"]], table=4))
    vals, _, _ = mapping.map_fields(again, config.template_fields(spark, "KM1"), docs(spark), tables="all")
    assert figures(vals) == {k: D(v) for k, v in KM1.items()}


def test_first_number_right_of_label_topmost_label_first_alias(spark):
    rows = [["Tier 1 capital", "n/a", "–", "41,900"], ["Tier 1 capital", "9", "9", "9"], ["Total own funds", "1"], ["Total capital", "2"], ["CET1 capital", "abc"]]
    vals, unmatched, _ = mapped(spark, grid(spark, rows))
    assert figures(vals) == {"KM1.2": D(41900), "KM1.3": D(2)}
    assert "KM1.1" in {r["code"] for r in unmatched.collect()}


def test_tier_label_quirk_and_strict_mode(spark):
    rows = [["Tier 2", "3.3"], ["CET1 capital", "1"], ["Total capital", "2"]]
    fields = config.template_fields(spark, "KM1")
    assert figures(mapping.map_fields(grid(spark, rows), fields, docs(spark))[0])["KM1.6"] == D("3.3")
    assert "KM1.6" not in figures(mapping.map_fields(grid(spark, rows), fields, docs(spark), strict_footnotes=True)[0])


def test_disclosure_scale(spark):
    rows = [[a, b.replace(",", "")[:3] + ".0" if "," in b else b] for a, b, *_ in KM1_GRID[1:]]
    assert figures(mapped(spark, grid(spark, rows), scale="billions", currency="USD")[0])["KM1.4"] == 243000


def test_merge_and_coverage(spark):
    first, _, _ = mapped(spark, grid(spark, KM1_GRID))
    second, _, _ = mapped(spark, grid(spark, KM1_GRID[1:7] + [["Total HQLA", "5"]], engine="CAMELOT"))
    merged = mapping.merge_engines(first, second)
    assert {r["field_code"]: dict(r["engine_values"]) for r in merged.collect()}["KM1.4"] == {"DOCLING": D(243500), "CAMELOT": D(243500)}
    assert {(r["field_code"], r["only_in"]) for r in mapping.coverage(first, second).collect()} == {("KM1.7", "primary"), ("KM1.15", "secondary")}
    got = results(spark, merged)
    assert got["KM1.5"]["confidence"] == 1 and got["KM1.7"]["confidence"] == D("0.97")


def test_fallback_decisions(spark):
    cells = grid(spark, KM1_GRID[:7] + [["Own funds over exposure", "20.1", "19.9"], ["Blank row", "n/a"]])
    fields, d = config.template_fields(spark, "KM1"), docs(spark)
    _, unmatched, _ = mapping.map_fields(cells, fields, d)
    prompt = mapping.fallback_prompts(cells, unmatched, fields).first()
    assert "- Own funds over exposure\n- Blank row" in prompt["prompt"] and "Tier 1 capital\n" not in prompt["prompt"].split("Rows:")[1]
    assert prompt["prompt_sha"] == mapping.fallback_prompts(cells.repartition(3), unmatched, fields).first()["prompt_sha"]
    t = ("d", "DOCLING", 0)
    answers = [(*t, "KM1.7", "own funds over exposure", 0.8), (*t, "KM1.1", "Blank row", 0.9), (*t, "KM1.13", None, 0.9), (*t, "KM1.14", "nowhere", 0.9), (*t, "KM1.15", "Blank row", 0.9), (*t, "KM1.16", "Blank row", float("nan")), (*t, "KM1.17", "Blank row", 1.5), (*t, "KM1.18", "Tier 1 capital", 0.9)]
    decisions = spark.createDataFrame([(*a, "m", "sha", "1") for a in answers], "doc_id string, engine string, table_idx int, code string, label string, confidence double, model string, prompt_sha string, prompt_version string")
    more, audit = mapping.map_unmatched(cells, unmatched, fields, d, decisions)
    row = more.first()
    assert more.count() == 1 and row["field_code"] == "KM1.7" and row["value"] == D("20.1") and row["mapping"]["method"] == "LLM" and row["mapping"]["confidence"] == 0.8
    assert {r["code"]: r["reason"] for r in audit.collect()} == {"KM1.7": "mapped", "KM1.1": "out_of_scope", "KM1.13": "no_row", "KM1.14": "unknown_row", "KM1.15": "no_number", "KM1.16": "bad_confidence", "KM1.17": "bad_confidence", "KM1.18": "unknown_row"}


def test_extract_template_errors_are_rows(spark):
    cells = grid(spark, KM1_GRID).unionByName(grid(spark, [["x", "1"]], doc="e")).unionByName(grid(spark, [["Tier 1 capital", "n/a"], ["Total capital", "-"]], doc="f"))
    d = docs(spark).unionByName(docs(spark, doc="e")).unionByName(docs(spark, doc="f"))
    vals, errors = pipeline.extract_template(spark, cells, d)
    assert vals.count() == 7 and {r["doc_id"]: r["error"] for r in errors.collect()} == {"e": "no table matches the template", "f": "no field could be mapped"}
    with pytest.raises(NoTemplateTableError):
        pipeline.extract_template(spark, cells, d, strict=True)


def test_cell_contract(spark):
    ddl = "doc_id string, engine string, table_idx int, row_idx int, col_idx int, text string, page int, x0 double, y0 double, x1 double, y1 double"
    ok = spark.createDataFrame([("d", "DOCLING", 0, 0, 0, None, 1, 1.0, 2.0, 3.0, 4.0), ("d", "DOCLING", 0, 0, 1, "a", 2, 1.0, 2.0, 3.0, 4.0)], ddl)
    assert [r["text"] for r in C.from_boxed(ok).orderBy("col_idx").collect()] == ["", "a"] and C.from_boxed(ok, [2]).count() == 1
    with pytest.raises(ExtractionError, match="no tables"):
        C.from_boxed(ok, [9])
    with pytest.raises(ExtractionError, match="no finite box"):
        C.from_boxed(spark.createDataFrame([("d", "DOCLING", 0, 0, 0, "a", 1, float("nan"), 2.0, 3.0, 4.0)], ddl))
    up = spark.createDataFrame([("d", "CAMELOT", 0, 0, 0, "a", 1, 10.0, 20.0, 30.0, 40.0, 100.0)], ddl.replace("x0 double, y0 double, x1 double, y1 double", "x1 double, y1 double, x2 double, y2 double, page_height double"))
    assert C.from_bottom_up(up).first()["bbox"][:] == (1, 10.0, 60.0, 30.0, 80.0)
    gap = spark.createDataFrame([("d", "PDFPLUMBER", 0, 0, 0, "a", 1, None, None, None, None), ("d", "PDFPLUMBER", 0, 0, 1, None, 1, 1.0, 1.0, 2.0, 2.0)], ddl)
    assert C.from_ragged(gap).count() == 1
    assert "table_idx" not in C.flatten(C.from_boxed(ok)).columns
    tables = spark.createDataFrame([("a", "stream", 1, 0), ("a", "pdfplumber", 1, 0), ("b", "lattice", 2, 0), ("b", "pdfplumber", 2, 0), ("c", "lattice", 1, 0), ("c", "stream", 1, 0)], "doc_id string, flavour string, page int, table_idx int")
    assert {r["doc_id"]: r["flavour"] for r in C.pick_secondary(tables).collect()} == {"a": "stream", "b": "pdfplumber", "c": "lattice"}


def test_duplicate_values_first_wins(spark):
    first, _, _ = mapped(spark, grid(spark, KM1_GRID))
    kept, dropped = mapping.first_wins(first.unionByName(first))
    assert kept.count() == 7 and dropped.count() == 7

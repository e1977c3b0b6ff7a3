"""Relations of the library and the values their columns may take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What each coded column may hold.
JURISDICTIONS = ["UK", "US", "EU", "CH", "JP", "CA"]
TEMPLATES = ["KM1", "OV1", "CMS1", "CMS2", "CR6", "CCR1", "MR1", "CVA1", "OR1", "LR1", "LIQ1"]
UNITS = ["EUR_M", "GBP_M", "USD_M", "CHF_M", "JPY_M", "PERCENT", "RATIO", "COUNT", "NONE"]
KINDS = ["MONETARY", "PERCENT", "RATIO", "COUNT"]
SOURCE_KINDS = ["PDF", "XBRL_CSV"]
ENGINES = ["DOCLING", "CAMELOT", "PDFPLUMBER", "P3DH", "FFIEC101"]
CHECK_TYPES = ["RATIO_IDENTITY", "CROSS_FOOT", "TWO_ENGINE", "MAGNITUDE_SANITY", "PERIOD_SANITY", "UNIT_SANITY"]
OUTCOMES = ["PASS", "FAIL", "SKIP"]
STATUSES = ["AUTO_PASSED", "FLAGGED", "HUMAN_CONFIRMED", "HUMAN_CORRECTED"]
VALIDATED = ["AUTO_PASSED", "HUMAN_CONFIRMED", "HUMAN_CORRECTED"]
ECL_BASES = ["TRANSITIONAL", "FULLY_LOADED", "NA"]
FLOOR_BASES = ["FINAL", "PRE_FLOOR", "NA"]
METHODS = ["RULE", "LLM"]
STORED_AS = ["AMOUNT", "FRACTION", "PERCENT"]
CELL_OUTCOMES = ["CORRECT", "MISMATCH", "MISSING", "EXTRA"]

#: Money of each currency the units know, in millions. Fixed values.
CURRENCY_UNITS = {"EUR": "EUR_M", "GBP": "GBP_M", "USD": "USD_M", "CHF": "CHF_M", "JPY": "JPY_M"}
MONETARY_UNITS = list(CURRENCY_UNITS.values())

#: Figures are computed in COMPUTE, whose products are exact, and stored in STORED.
COMPUTE, STORED, WIDE = "decimal(18,6)", "decimal(38,6)", "decimal(38,18)"

FILING = ["bank", "period", "template", "doc_id"]



def _parts(text: str, at: str) -> list[str]:
    """Split at a character outside brackets."""
    out, depth = [""], 0
    for c in text:
        depth += (c in "<(") - (c in ">)")
        if c == at and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def _type(text: str) -> T.DataType:
    head, _, inner = text.partition("<")
    inner = inner[:-1]
    if head == "struct":
        return T.StructType([T.StructField(n, _type(t)) for n, t in (_parts(f, ":") for f in _parts(inner, ","))])
    if head == "array":
        return T.ArrayType(_type(inner))
    if head == "map":
        return T.MapType(*[_type(t) for t in _parts(inner, ",")])
    if head.startswith("decimal"):
        return T.DecimalType(*map(int, head[8:-1].split(",")))
    return {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "bigint": T.LongType()}[head]


def relation(ddl: str) -> T.StructType:
    """A schema from its DDL, without a session (modules define relations on import)."""
    return T.StructType([T.StructField(n, _type(t)) for n, _, t in (f.partition(" ") for f in _parts(ddl, ","))])


BBOX = "struct<page:int,x0:double,y0:double,x1:double,y1:double>"
CELLS = relation(f"doc_id string, engine string, table_idx int, row_idx int, col_idx int, text string, bbox {BBOX}, row_label string, col_label string")
MAPPING = "struct<method:string,model:string,prompt_sha:string,prompt_version:string,matched_alias:string,confidence:double>"
FIELD_VALUES = relation(
    f"bank string, period string, template string, doc_id string, field_code string, value {COMPUTE}, unit string, ecl_basis string, floor_basis string, engine string, source_kind string, "
    f"source_url string, bbox {BBOX}, monetary_scale string, mapping {MAPPING}, raw_text string, engine_values map<string,{COMPUTE}>"
)
CHECK = f"struct<check_type:string,outcome:string,field_codes:array<string>,expected:{WIDE},actual:{WIDE},tolerance:{WIDE},detail:string>"

#: The store's columns, in this order. Fixed values.
DATASET = relation(
    f"bank string, period string, jurisdiction string, template string, field string, value {STORED}, unit string, ecl_basis string, floor_basis string, source_url string, page int, "
    f"bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double, confidence {STORED}, validation_basis array<string>, status string, extracted_at string, run_id string"
)


def require(df: DataFrame, broken: Column, error: type[Exception], what: Column | str) -> DataFrame:
    """Raise ``error`` naming up to five offenders if any row is ``broken``.

    An action of its own: an assertion carried as an unused column would be
    pruned from the plan and never fire.
    """
    named = what if isinstance(what, Column) else F.lit(what)
    found = [r[0] for r in df.filter(F.coalesce(broken, F.lit(False))).select(named).limit(5).collect()]
    if found:
        raise error("; ".join(map(str, found)))
    return df


def plain_number(value: Column) -> Column:
    """A decimal as text without trailing zeros."""
    text = value.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)

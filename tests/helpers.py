"""Small builders of the library's relations."""

from decimal import Decimal

from ledgerline.plans import schema as S
from ledgerline.sources import config

UNIT = {"MONETARY": "GBP_M", "PERCENT": "PERCENT"}


def spec(template):
    return {f["code"]: f for f in config.load_template(template)}


def values(spark, figures, template="KM1", bank="barclays", period="2025Q4", doc="d", engine="DOCLING", second=None, **over):
    """Field values of one filing from {code: figure}. second: the other engine's figures."""
    fields, rows = spec(template), []
    for code, v in figures.items():
        f = fields[code]
        engines = {engine: Decimal(v)} | ({"CAMELOT": Decimal(second[code])} if second and code in second else {})
        row = (bank, period, template, doc, code, Decimal(v), UNIT[f["kind"]], f["ecl"], f["floor"], engine, "PDF", "http://x", (1, 1.0, 2.0, 3.0, 4.0), "millions", ("RULE", None, None, None, f["aliases"][0], 1.0), str(v), engines)
        names = [c.name for c in S.FIELD_VALUES.fields]
        rows.append(tuple(over.get(code, {}).get(n, x) for n, x in zip(names, row)))
    return spark.createDataFrame(rows, S.FIELD_VALUES)


def results(spark, vals, mode="raise"):
    from ledgerline.plans.pipeline import reconcile_values

    return {r["field_code"]: r for r in reconcile_values(spark, vals.persist(), mode).collect()}


def grid(spark, rows, doc="d", engine="DOCLING", table=0):
    """Cells of one table from rows of texts."""
    out = [(doc, engine, table, i, j, t, (1, float(j), float(i), j + 1.0, i + 1.0), None, None) for i, r in enumerate(rows) for j, t in enumerate(r) if t is not None]
    return spark.createDataFrame(out, S.CELLS)


#: Invented figures of one filing.
KM1 = {"KM1.1": "36800", "KM1.2": "41900", "KM1.3": "49000", "KM1.4": "243500", "KM1.5": "15.1", "KM1.6": "17.2", "KM1.7": "20.1"}
KM1_GRID = [
    ["", "this quarter", "last quarter"],
    ["4 Total risk-weighted exposure amount", "243,500", "238,000"],
    ["1 Common Equity Tier 1 (CET1) capital", "36,800", "35,100"],
    ["UK 5a Common Equity Tier 1 ratio (%)", "15.1", "14.7"],
    ["2 Tier 1 capital", "41,900", "40,200"],
    ["6 Tier 1 ratio (%)", "17.2%", "16.9"],
    ["3 Total capital 1", "49,000", "47,300"],
    ["7 Total capital ratio (%)", "20.1", "19.9"],
]
OV1_GRID = [
    ["Market risk", "12,700"],
    ["Operational risk", "36,310"],
    ["Credit risk (excluding CCR)", "171,000"],
    ["of which the standardised approach", "62,000"],
    ["Counterparty credit risk", "18,500"],
    ["Securitisation exposures in the non-trading book", "4,400"],
    ["Settlement risk", "90"],
    ["Total", "243,000"],
]


def docs(spark, template="KM1", doc="d", bank="barclays", scale="millions", currency="GBP"):
    return spark.createDataFrame([(doc, bank, "2025Q4", template, "http://x", "en_GB", currency, scale)], "doc_id string, bank string, period string, template string, source_url string, number_locale string, reporting_currency string, monetary_scale string")

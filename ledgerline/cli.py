"""Command line: run and run-all over tables of extracted cells or folders of
structured filings; review list, resolve and apply; register."""

from __future__ import annotations

import argparse
import uuid
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .errors import ConfigError
from .functions.periods import PERIOD
from .plans import pipeline
from .plans import schema as S
from .sources import config, registry, review, store, structured


def find_bank(bank: str) -> dict:
    known = {b["bank"]: b for b in config.load_banks()}
    if bank not in known:
        raise ConfigError(f"unknown bank {bank} (known: {', '.join(sorted(known))})")
    return known[bank]


def parser() -> argparse.ArgumentParser:
    import re

    def period(text: str) -> str:
        if not re.match(PERIOD, text):
            raise argparse.ArgumentTypeError(f"{text}: YYYYQn or YYYYFY is expected")
        return text

    p = argparse.ArgumentParser(prog="ledgerline", description="Reconcile disclosed figures")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "run-all"):
        c = sub.add_parser(name)
        c.add_argument("--template", required=True, choices=S.TEMPLATES, type=str.upper)
        c.add_argument("--period", required=True, type=period)
        source = c.add_mutually_exclusive_group(required=True)
        source.add_argument("--cells", help="Parquet table of extracted cells")
        source.add_argument("--filings", help="folder of structured filings named bank_PERIOD_TEMPLATE.csv")
        c.add_argument("--second-cells", help="the same from a second engine")
        c.add_argument("--decisions", help="Parquet table of a mapper's answers")
        c.add_argument("--all-tables", action="store_true", help="the template may run over several tables")
        c.add_argument("--store", required=True)
        c.add_argument("--queue", required=True)
        if name == "run":
            c.add_argument("--bank", required=True)
    r = sub.add_parser("review").add_subparsers(dest="action", required=True)
    ls = r.add_parser("list", help="queued figures under their latest resolutions")
    ls.add_argument("--queue", required=True)
    ls.add_argument("--events")
    ls.add_argument("--open", action="store_true", help="only what is still flagged")
    rs = r.add_parser("resolve")
    for flag in ("--queue", "--events", "--run", "--bank", "--period", "--field"):
        rs.add_argument(flag, required=True)
    how = rs.add_mutually_exclusive_group(required=True)
    how.add_argument("--confirm", action="store_true")
    how.add_argument("--value")
    rs.add_argument("--note", default="")
    ap = r.add_parser("apply", help="write the store anew with resolutions in place of flagged figures")
    for flag in ("--queue", "--events", "--store", "--out"):
        ap.add_argument(flag, required=True)
    reg = sub.add_parser("register", help="keep documents and add them to the ledger")
    for flag in ("--files", "--bank", "--manifest", "--raw"):
        reg.add_argument(flag, required=True)
    reg.add_argument("--period", required=True, type=period)
    reg.add_argument("--template", choices=S.TEMPLATES, type=str.upper)
    reg.add_argument("--kind", required=True, choices=S.SOURCE_KINDS)
    return p


def review_command(spark: SparkSession, args: argparse.Namespace, now: str) -> int:
    items = review.load(spark, args.queue)
    if args.action == "resolve":
        event = {"run_id": args.run, "bank": args.bank, "period": args.period, "field_code": args.field, "action": "confirm" if args.confirm else "correct", "corrected_value": args.value, "note": args.note, "resolved_at": now}
        review.resolutions(spark, [event], items).write.mode("append").parquet(args.events)
        return 0
    settled = review.resolved(items, review.load_events(spark, args.events))
    if args.action == "apply":
        review.write_back(store.scan(spark, args.store), settled).write.mode("errorifexists").parquet(args.out)
        return 0
    shown = settled.filter("status = 'FLAGGED'") if args.open else settled
    for row in review.render(shown).orderBy(F.desc("queued_at"), "field_code").select("card").toLocalIterator():
        print(row["card"])
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("ledgerline").getOrCreate()
    now = datetime.now(UTC).isoformat()
    if args.command == "review":
        return review_command(spark, args, now)
    if args.command == "register":
        find_bank(args.bank)
        incoming = registry.incoming_files(spark, args.files, args.bank, args.period, args.template, args.kind)
        for row in registry.ingest(incoming, args.manifest, args.raw, now).orderBy("url").toLocalIterator():
            print(row["status"], row["sha256"], row["local_path"])
        return 0
    cells = spark.read.parquet(args.cells) if args.cells else None
    filings = structured.read_filings(spark, args.filings, "rows").persist() if args.filings else None
    second = spark.read.parquet(args.second_cells) if args.second_cells else None
    decisions = spark.read.parquet(args.decisions) if args.decisions else None
    banks, run_id, tables = config.banks(spark), uuid.uuid4().hex, "all" if args.all_tables else "best"
    names = (cells if filings is None else filings).select(F.col("doc_id").alias("path")).distinct()
    docs, bad = pipeline.known_documents(names, banks, args.template, args.period)
    if args.command == "run":
        find_bank(args.bank)
        docs = docs.filter(F.col("bank") == args.bank)
        values, _ = pipeline.extract_template(spark, cells, docs, second, decisions, strict=True, tables=tables) if filings is None else pipeline.structured_values(spark, filings, docs, strict=True)
        results = pipeline.reconcile_values(spark, values.persist()).persist()
        for row in pipeline.format_results(results).orderBy("field_code").select("line").toLocalIterator():
            print(row["line"])
        store.append(store.flatten(results, banks, run_id, now), args.store)
        review.enqueue(results, args.queue, run_id)
        return 0
    tally = pipeline.sweep(spark, cells, docs, banks, run_id, now, args.store, args.queue, second, decisions, bad, filings, tables)
    for row in pipeline.summary_lines(tally).toLocalIterator():
        print(row["line"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

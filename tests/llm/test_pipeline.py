"""The pipeline against a brute-force version of its five stages."""

from collections import Counter

import corpus_pipeline
from ledgerline.llm import quality, queries

from . import brute
from .conftest import SF
from .test_simhash import near_copies


def test_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {q.split("_")[0] + "_" for q in queries.queries() if q != "pipeline"}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in quality.assess(spark.read.parquet(f"{SF}/documents.parquet")).filter("kept").collect()}  # itself held against SQL and brute-force counts
    docs = sorted((r for r in rows if r["doc_id"] in good), key=lambda r: r["doc_id"])
    assert all(brute.counts(r["text"])[0] >= 50 for r in docs)
    roots = near_copies([r["text"] for r in docs])
    docs = [r for i, r in enumerate(docs) if roots[i] == i]
    clean = []
    for r in docs:
        words, hit, _ = brute.contamination(r["text"], items)
        if not (hit and 20 * hit >= words):
            clean.append(r)
    assert len(clean) < len(docs) < len(rows)
    sizes = Counter()
    for r in clean:
        sizes[r["source"]] += len(r["text"].encode()) + 1
    mean = {s: 1 / len(sizes) * sum(sizes.values()) / n for s, n in sizes.items()}
    mixed = [r for r in clean for _ in range(brute.copies(r["doc_id"], mean[r["source"]]))]
    mixed.sort(key=lambda r: r["doc_id"])
    total, below, want = sum(len(r["text"].encode()) + 8 for r in mixed), 0, Counter()
    for r in mixed:
        n = len(r["text"].encode()) + 8
        want[r["doc_id"], sum(12 * (2 * below + n) > i * total for i in range(1, 24))] += 1
        below += n
    got = Counter((r["doc_id"], r["shard"]) for r in corpus_pipeline.run(spark, SF).select("doc_id", "shard").collect())
    assert got == want

"""Proximity matches of the registered query, over the 0.1 table with inserted words."""

from pyspark.sql import functions as F

from ledgerline.llm import decontamination as D
from ledgerline.llm import queries

from . import brute


def test_query_finds_items_with_inserted_words(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    bodies = [(r["item_id"], [w.decode() for w in D.tokens(r["text"].encode())]) for r in items.collect() if r["text"]]
    planted = []
    for k, (item, w) in enumerate(x for x in bodies if len(x[1]) >= 13):
        extra, cut = (0, 1, 2, 5)[k % 4], 3 + k % 8  # words that go in; a start may lie off by SLOP either way, so 5 are too many
        planted.append((-1 - k, item, extra, " ".join(["lead in"] * 9 + w[:cut] + [f"zz{k}"] * extra + w[cut:13] + ["way out"] * 9)))
    assert len(planted) > 20
    made = spark.createDataFrame([(p[0], p[3]) for p in planted], "doc_id bigint, text string")
    docs.unionByName(made).write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    index = D.build_index(spark.read.parquet(str(tmp_path / "documents.parquet")))
    found = D.verdicts(D.search(index, items)).cache()
    query = queries.op1_decontamination(spark, str(tmp_path))
    assert query.columns[-2:] == ["n_near_items", "near_items_sha256"]
    assert found.select(*query.columns).exceptAll(query).isEmpty() and found.count() == docs.count() + len(planted)
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    got = {r["doc_id"]: r for r in found.filter("doc_id < 0").collect()}
    for doc, item, extra, text in planted:
        assert (item in got[doc]["near_items"]) == (extra <= D.SLOP) and got[doc]["n_near_items"] == len(got[doc]["near_items"])
        assert extra == 0 or got[doc]["n_items"] == 0
    for doc, _, _, text in planted[:4]:
        assert got[doc]["near_items"] == sorted(i for i, body in texts if brute.near(text, body, D.SLOP))
    assert found.filter(F.col("n_near_items") < F.col("n_items")).isEmpty()

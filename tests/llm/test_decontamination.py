import hashlib
import random

from ledgerline.llm import decontamination as D

from . import brute

ITEM = "item_id bigint, text string"


def make(spark, seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 2, 5, 13, 14, 20])))) for i in range(12)] + [(3, "w1 w2"), (None, "Zed zed ZED"), (50, None), (51, "...")]
    docs = []
    for i in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 2)):
            b = rnd.choice(items)[1] or ""
            w[rnd.randint(0, len(w)) : 0] = b.upper().split()
        docs.append((i if i != 7 else None, "! ".join(w)))
    docs += [(100, None), (101, ""), (102, "zed, zed; zed... zed"), (102, "zed, zed; zed... zed")]
    return items, docs


def test_exact_matches_equal_brute_force_in_any_blocks(spark):
    items, docs = make(spark)
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM)
    want = sorted([(i, *brute.contamination(t, items)) for i, t in docs], key=str)
    for segment, block in ((1 << 20, 1 << 20), (200, 1 << 20), (400, 60)):
        found = D.search(D.build_index(d, segment_bytes=segment), b, block_bytes=block)
        got = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"])) for r in found.collect()]
        assert sorted(got, key=str) == want
    verdict = D.verdicts(found).filter("doc_id = 102").first()
    assert verdict["contaminated"] and verdict["n_items"] == 0 and verdict["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_proximity_equals_brute_force(spark):
    items = [(0, "alpha beta gamma delta epsilon"), (1, "one two three")]
    docs = [(0, "alpha x beta gamma delta epsilon"), (1, "beta alpha gamma epsilon delta"), (2, "alpha y y y beta gamma delta epsilon"), (3, "one two"), (4, "three two one"), (5, "one two three"), (6, "two three")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM)
    index = D.build_index(d)
    for slop in (0, 1, 2, 3):
        got = {r["doc_id"]: list(r["near_items"]) for r in D.search(index, b, slop=slop).collect()}
        assert got == {i: [k for k, body in items if brute.near(t, body, slop)] for i, t in docs}


def test_stage_keeps_clean_rows_and_columns(spark, odd, none):
    items = spark.createDataFrame([(1, "same text here twice")], ITEM)
    kept = D.decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert D.decontaminate(none, items).count() == 0
    assert D.decontaminate(odd, spark.createDataFrame([], ITEM)).count() == odd.count()

"""The registered queries over a whole small table, against plain Python."""

import hashlib
import zlib

import numpy as np
import pytest

from ledgerline.llm import licenses, queries

from . import brute
from .conftest import SF
from .test_files import brute_licenses


@pytest.fixture
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def test_op1(spark, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in queries.op1_decontamination(spark, SF).collect()}
    assert set(got) == set(texts)
    digest = lambda ids: hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
    for i, text in texts.items():
        n, hit, found = brute.contamination(text, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(found), digest(found), hit > 0 and 20 * hit >= n)
        assert r["n_near_items"] >= r["n_items"]
    assert any(r["contaminated"] for r in got.values())
    for i in sorted(texts, key=lambda i: -got[i]["n_near_items"])[:8]:
        near = [item for item, body in items if brute.near(texts[i], body, 2)]
        assert (got[i]["n_near_items"], got[i]["near_items_sha256"]) == (len(near), digest(near))


def test_op3(spark, texts):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = {r["doc_id"]: r for r in queries.op3_token_output(spark, SF).collect()}, 0
    assert set(got) == set(texts)
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op6(spark, texts):
    ids = sorted(texts)
    fps = [brute.fingerprint(texts[i]) for i in ids]
    want = {i: (f"{f:016x}", ids[root]) for i, f, root in zip(ids, fps, brute.components(fps))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, SF).collect()} == want


def test_op8(spark, texts):
    want = {i: brute_licenses(t) for i, t in texts.items()}
    got = {r["doc_id"]: (r["n_licenses"], r["licenses"]) for r in queries.op8_license_scan(spark, SF).collect()}
    assert got == {i: (len(x), ",".join(x)) for i, x in want.items()} and any(want.values())
    assert set(licenses.NOTICES) < set(licenses.TEMPLATES)

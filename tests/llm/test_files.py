"""Sharding, token shards, WARC bundles and licence scans."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import licenses, sharding, token_store, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def shards(df, **kw):
    out = sharding.shard_by_bytes(df, **kw)
    rows = out.select("doc_id", "shard", "slot", sharding.size_of("text").alias("size")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    return out, {s: sum(r["size"] for r in p) for s, p in by.items()}, by


def test_shards_are_even_ordered_and_whole(spark, docs):
    out, sizes, by = shards(docs)
    largest = docs.select(F.max(sharding.size_of("text"))).first()[0]
    assert out.count() == docs.count() and max(sizes.values()) - min(sizes.values()) <= largest
    firsts = [(min(r["doc_id"] for r in by[s]), max(r["doc_id"] for r in by[s])) for s in sorted(by)]
    assert all(a[1] < b[0] for a, b in zip(firsts, firsts[1:]))


def test_one_key_and_equal_rows_are_parted(spark, odd, none):
    same = spark.range(960).selectExpr("cast(5 as bigint) doc_id", "'equal text' text")
    _, sizes, _ = shards(same, shards=8)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 18 * 2
    one = spark.range(960).selectExpr("cast(5 as bigint) doc_id", "concat('text ', id) text")
    _, sizes, _ = shards(one, shards=8)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 40
    out, _, _ = shards(odd, shards=4)
    assert out.count() == odd.count() and dict(out.dtypes)["shard"] == "int"
    assert sharding.shard_by_bytes(none).count() == 0


def test_ranges_within_a_shard_keep_slots(spark, docs):
    a = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_by_bytes(docs, shards=5).select("doc_id", "shard", "slot").collect()}
    b = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_by_bytes(docs, shards=5, range_bytes=20_000).select("doc_id", "shard", "slot").collect()}
    assert a == b


def test_splitters_within_tolerance(spark):
    sizes = spark.range(5000).selectExpr("id * id * 1000003 as key", "id as tie", "cast(1 + id % 97 as bigint) as size")
    total = sizes.agg(F.sum("size")).first()[0]
    for (_, below, _), mark in zip(sharding.find_splitters(sizes, [total // 3, total // 2], [50.0, 0.0], total, probes=3), (total // 3, total // 2)):
        assert abs(below - mark) <= 97


def test_few_rounds_find_splitters_of_any_spread(spark, monkeypatch):
    """Even, skewed and clustered keys: exact splitters, and few passes over the keys."""
    rounds, count = [], sharding._histogram
    monkeypatch.setattr(sharding, "_histogram", lambda *a: rounds.append(1) or count(*a))
    for key, most in (("id", 2), ("id * id * 1000003", 4), ("if(id % 2 = 0, id, (1L << 60) + id * 7)", 12)):
        sizes = spark.range(5000).selectExpr(f"{key} as key", "id as tie", "cast(1 + id % 97 as bigint) as size")
        rows = sizes.orderBy("key", "tie").collect()
        total = sum(r["size"] for r in rows)
        marks = [total * i // 24 for i in range(1, 24)]
        ends = np.cumsum([r["size"] for r in rows])
        rounds.clear()
        for (_, below, n), mark in zip(sharding.find_splitters(sizes, marks, [0.0] * 23, total), marks):
            best = min(range(len(ends) + 1), key=lambda i: (abs((int(ends[i - 1]) if i else 0) - mark), -i))  # noqa: B023
            assert (below, n) == (int(ends[best - 1]) if best else 0, best)
        assert len(rounds) <= most, (key, len(rounds))


def test_words_encode_as_whole_texts(docs):
    odd = [None, b"", b"  ", b"a", b".", b"...", b"It's fine. 'S it'S. don't!!", b"<|endoftext|>x. y<|endoftext|>. <|ENDOFTEXT|>. <|startoftext|>.", "H̱a. …. Åx. Å ẞ. ΣΣ. İİ é. é!".encode(), b"x y", b"z.", b"a\x00b\xc2\xa0c. 12.3.4, 5%% (x)) 7.", b" lead", b"trail ", b"\n", b"q" * 500]
    texts = odd + [r["text"].encode() for r in docs.select("text").collect()]
    whole = token_store.PlainEncoder(TOKENIZER).encode(pa.array(texts, pa.binary()))
    tool = token_store.WordEncoder(TOKENIZER)
    for room in (600_000, 50):  # with and without room to remember pieces
        tool.PIECES = room
        ids, lengths = tool.encode(pa.array([b"skip"] + texts, pa.binary()).slice(1))
        assert (lengths == whole[1]).all() and (ids == whole[0]).all()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000))
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.slots(keys)) == list(range(len(keys)))
    assert token_store.PerfectHash.build(np.zeros(0, np.int64)).n == 0


def test_encoder_is_chosen_by_the_tokenizers_file():
    assert token_store.encoder_for(TOKENIZER) is token_store.WordEncoder
    assert token_store.encoder_for(public_tokenizers.path("byte_bpe_50k.json")) is token_store.PlainEncoder


def test_an_access_reads_the_same_few_bytes_at_any_size(tmp_path):
    class Counted:
        def __init__(self, file):
            self.file, self.sizes = file, []

        def read_at(self, n, at):
            self.sizes.append(n)
            return self.file.read_at(n, at)

    read = {}
    for n in (500, 200_000):
        keys = np.sort(np.random.default_rng(n).choice(1 << 40, n, replace=False))
        lengths = np.arange(n) % 3
        path = f"{tmp_path}/shard-{n}"
        ids = np.repeat(keys % 1000, lengths).astype("<u2")
        with open(f"{path}.ids", "wb") as f:
            f.write(token_store.MAGIC_IDS + (2).to_bytes(4, "little") + ids.tobytes())
        with open(f"{path}.mph", "wb") as f:
            f.write(token_store._index_bytes(keys, np.zeros(n, bool), lengths, 2))
        shard = token_store.Shard(path)
        shard.index = Counted(shard.index)
        some = np.random.default_rng(1).choice(n, 300)
        for i in some:
            assert [x.tolist() for x in shard.get(int(keys[i]))] == [[int(keys[i]) % 1000] * int(lengths[i])]
        assert max(shard.index.sizes) <= token_store.LINE_BYTES
        read[n] = sum(shard.index.sizes) / len(some)
        assert shard.get(1 << 41) == []
        assert (shard.documents()[3] == lengths).all()
    assert read[200_000] < 1.2 * read[500] < 300


def test_token_shards_ignore_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x", b"y"), (2, "c", 8, "z", b"")], "doc_id bigint, text string, shard int, `key` string, ids binary")
    rows = token_store.read(token_store.write(df, TOKENIZER)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in rows] == [(1, 0, 3), (2, 3, 2)]


def test_token_shards_round_trip(spark, docs, odd, none, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    for df in (docs, odd):
        manifest = token_store.write(df, TOKENIZER, shard_bytes=20_000)
        got = [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in token_store.read(manifest).orderBy("start").collect()]
        assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda k: (k is not None, k))
        at = 0
        for g in got:
            assert g[1] == at and len(g[3]) == 4 * g[2]
            at += g[2]
        want = sorted((r["doc_id"], np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in df.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text").collect())
        assert sorted((-1 if g[0] is None else g[0], g[3]) for g in got) == want
    assert [x.tolist() for x in token_store.lookup(manifest, 9)] == [np.frombuffer(w, "<u4").tolist() for k, w in want if k == 9]
    assert token_store.lookup(manifest, 123456) == []
    assert token_store.read(token_store.write(none, TOKENIZER)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>é</p>" * 200, "<b>x</b>" * 300
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (2, "u\r\nX: y", other), (7, "u", "small"), (8, "u", "small"), (9, None, None), (10, "", ""), (None, "n", other), (None, "n2", "a\r\n\r\nWARC/1.1\r\n"), (5, "http://a/5", big)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    manifest = warc.write(pages, frame_bytes=2000, bundle_bytes=600)
    back = {(r["page_id"], r["url"]): r for r in warc.read(manifest).collect()}
    assert warc.read(manifest).count() == len(rows)
    assert {k[0]: (r["record_type"], r["refers_to"]) for k, r in back.items() if r["payload_bytes"] == len(big.encode())} == {1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None)}
    assert back[None, "n"]["record_type"] == "revisit" and back[None, "n"]["refers_to"] == 2 and back[7, "u"]["record_type"] == "response"
    assert bytes(back[None, "n2"]["payload"]) == b"a\r\n\r\nWARC/1.1\r\n" and back[9, None]["payload_bytes"] == 0 and back[2, "u%0D%0AX: y"]["payload_bytes"] == len(other)
    import zstandard

    for r in manifest.collect():
        bundle = warc.Bundle(r["path"])
        for page, *_ in bundle.index():
            found = bundle.get(None if page == warc._NONE else page)
            assert found and all(f["page_id"] == (None if page == warc._NONE else page) for f in found)
        with open(r["path"].removeprefix("file://"), "rb") as f:  # any Zstandard tool reads the whole
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().count(b"WARC-Type") == r["n_records"] + 1
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    ids = {}
    for r in warc.read(manifest).collect():
        ids.setdefault(r["record_id"], []).append((r["page_id"], r["payload_digest"]))
        assert r["record_id"].startswith("<urn:uuid:")
    assert all(len(set(x)) == 1 for x in ids.values()) and len(ids) == len(rows) - 1  # page 5 stands there twice
    assert all(r["refers_to_record"] in ids and ids[r["refers_to_record"]][0][0] == r["refers_to"] for r in warc.read(manifest).collect() if r["record_type"] == "revisit")
    clash = pages.selectExpr("page_id", "url", "html", "'mine' as payload", "7 as record_type")
    assert warc.read(warc.write(clash)).filter("record_type = 'revisit'").count() == 3


def test_a_second_write_of_one_name(tmp_path):
    from ledgerline.llm.shared import write_atomically

    path = f"{tmp_path}/folder/file"
    assert write_atomically(path, iter([b"ab", b"c"])) == 3 and write_atomically("file://" + path, iter([b"abc"])) == 3

    def broken():
        yield b"a"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_atomically(path, broken())
    assert [p.name for p in (tmp_path / "folder").iterdir()] == ["file"] and (tmp_path / "folder" / "file").read_bytes() == b"abc"


def brute_licenses(text, templates=licenses.TEMPLATES):
    """Slides over every position, with no windows, bands or blocks."""
    w = licenses.words_of((text or "").encode())
    grams, out = licenses.shingles_of(w), set()
    for name, (stride, wanted) in licenses.template_table(templates).items():
        places = [i for i, g in enumerate(grams) if g in wanted]
        if any(len({grams[j] for j in places if i <= j < i + 2 * stride}) / len(wanted) >= 0.8 for i in places):
            out.add(name)
    return sorted(out)


def test_license_classes():
    strides = sorted({licenses.stride_of(n) for n in range(1, 20000)})
    assert strides[:6] == [1, 2, 3, 4, 8, 12] and all(s % 4 == 0 for s in strides[3:])
    assert all(licenses.stride_of(n) >= n for n in range(1, 20000)) and all(licenses.stride_of(n) <= 1.25 * n for n in range(17, 20000))


def test_licenses_equal_brute_force(spark, odd, none, docs):
    rnd, texts = random.Random(2), [None, "", "MIT", "licensed under the apache license version"]
    filler = lambda n: " ".join(f"f{rnd.randrange(50)}" for _ in range(n))
    short = {k: v for k, v in licenses.TEMPLATES.items() if len(v) < 3000}
    assert set(short) - set(licenses.NOTICES) >= {"mit", "isc", "zlib", "unlicense", "bsd-3-clause"}
    for body in short.values():
        texts += [body, filler(rnd.randrange(90)) + " " + body.upper() + " " + filler(30)]
        w = body.split()
        for k in range(6):
            cut = list(w)
            for _ in range(rnd.randint(1, 3)):
                cut[rnd.randrange(len(cut))] = "zzz"
            at = rnd.randrange(len(cut))
            cut[at:at] = filler([0, 0, 3, 12, 30, 200][k]).split()
            texts.append(filler(rnd.randrange(200)) + " " + " ".join(cut) + " " + filler(20))
    texts += [r["text"] for r in docs.select("text").collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = {i: brute_licenses(t, short) for i, t in enumerate(texts)}
    for group_bytes in (licenses.GROUP_BYTES, 1500):
        got = {r["doc_id"]: r["matches"] for r in licenses.scan(df, short, group_bytes=group_bytes).collect()}
        assert {i: sorted({m["template"] for m in v}) for i, v in got.items()} == want
    m = got[4][0]
    assert m["template"] == "mit-line" and (m["start"], m["end"], m["containment"]) == (0, 5, 1.0)
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        licenses.template_table({"x": "too short"})


def test_whole_texts_in_documents_not_made_from_them(spark):
    """Files as projects carry them: other line breaks, filled-in names, comment marks, and a text cut short."""
    t = licenses.TEMPLATES
    commented = "\n".join("# " + line for line in t["apache-2.0"].splitlines())
    wrapped = "Copyright (c) 2031 Example Makers, Oslo\n\n" + " ".join(t["bsd-3-clause"].split()).replace("the University", "Example Makers").replace("THE REGENTS", "THE COPYRIGHT HOLDERS").replace("The Regents", "Makers")
    both = "We use two parts.\n" + t["mit"] + "\nThe other part:\n" + t["zlib"].upper()
    half = t["gpl-3.0"][: len(t["gpl-3.0"]) // 2]
    html = "<p>" + t["mpl-2.0"].replace("\n\n", "</p><p>") + "</p>"
    rows = list(enumerate([commented, wrapped, both, half, html, "In this text, permission is hereby granted to read on."]))
    got = {r["doc_id"]: sorted({m["template"] for m in r["matches"]}) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert "apache-2.0" in got[0] and "bsd-3-clause" in got[1] and {"mit", "mit-grant", "zlib"} <= set(got[2]) and "mpl-2.0" in got[4] and got[5] == []
    assert "gpl-3.0" not in got[3]  # half is not 80 %
    for i, text in rows:
        assert got[i] == brute_licenses(text)


def test_crc_is_unsigned(spark):
    assert spark.range(1).select(F.crc32(F.lit("abc").cast("binary"))).first()[0] == zlib.crc32(b"abc")

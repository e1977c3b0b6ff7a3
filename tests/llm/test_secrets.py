"""Secret candidates, their features and the query against plain Python."""

import hashlib
import re
from collections import Counter

from ledgerline.llm import queries, secrets

COMMIT, KEY, OTHER = "9fceb02d0ae598e95dc970b74767f19372d61af8", "Zx81kLq09PmR7tVb33WnY5cE", "aB3dE5fG7hJ9kL1mN2pQ4rS6"


def found(spark, *texts):
    docs = spark.createDataFrame([(i, t, "web") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    return secrets.candidates(docs).orderBy("doc_id", "nth")


def test_every_candidate_of_a_word(spark):
    texts = [f'so {{"commit":"{COMMIT}","api_key":"{KEY}"}} end', f"1,{KEY},x,{OTHER} then {COMMIT}", f"alone {KEY}; next"]
    got = [tuple(r) for r in found(spark, *texts).select("doc_id", "nth", "value", "before", "after").collect()]
    assert got == [
        (0, 0, COMMIT, 'so {"commit":"', '","api_key":"'),
        (0, 1, KEY, f'so {{"commit":"{COMMIT}","api_key":"', "end"),
        (1, 0, KEY, " 1,", ",x,"),
        (1, 1, OTHER, f" 1,{KEY},x,", "then"),
        (1, 2, COMMIT, f"1,{KEY},x,{OTHER} then ", ""),
        (2, 0, KEY, "alone ", "next"),
    ]
    docs = spark.createDataFrame([(0, texts[0], "web")], "doc_id bigint, text string, source string")
    assert {r["value"]: r["is_secret"] for r in secrets.scan(docs).collect()} == {COMMIT: False, KEY: True}


def test_contexts_of_a_long_word_stay_bounded(spark):
    rows = found(spark, "first words here " + ";".join(f"{KEY}{i:04d}" for i in range(2000))).collect()
    assert [r["value"] for r in rows] == [f"{KEY}{i:04d}" for i in range(2000)] and [r["nth"] for r in rows] == list(range(2000))
    assert rows[3]["before"].startswith("first words here ") and max(len(r["before"]) for r in rows) < 200


def test_digitless_runs_where_a_key_is_asked_for_and_whole_long_runs(spark):
    late = "a" * 85 + "7" + "b" * 3000
    texts = ["password = correct-horse-battery-staple", "see the correct-horse-battery-staple", "token=abcdefghijklmnopqrst;x", f"value {late}", f"secret: abcdefghijklmnop,{KEY}"]
    assert [(r["doc_id"], r["nth"], r["value"]) for r in found(spark, *texts).collect()] == [(0, 0, "correct-horse-battery-staple"), (2, 0, "token=abcdefghijklmnopqrst"), (3, 0, late), (4, 0, "abcdefghijklmnop"), (4, 1, KEY)]


def plain_candidates(text):
    """(value, before, after) by Python's own regular expressions, word by word."""
    run, some, asks = re.compile(secrets._RUN), re.compile(secrets.CANDIDATE), re.compile(secrets._ASKS)
    words, out = re.split(r"[\x20\x09-\x0D]+", text or ""), []
    for i, w in enumerate(words):
        pattern = run if asks.search(" ".join(words[max(0, i - 3) : i + 1])) else some
        found = list(pattern.finditer(w))
        for k, m in enumerate(found):
            since = found[k - secrets.CONTEXT - 1].end() if k > secrets.CONTEXT else 0
            lead = [] if k > secrets.CONTEXT else [" ".join(words[max(0, i - 3) : i])]
            after = w[m.end() : found[k + 1].start()] if k + 1 < len(found) else (words[i + 1] if i + 1 < len(words) else "")
            out.append((m.group(), " ".join([*lead, w[since : m.start()]]), after))
    return out


def plain_features(value, before, after, path, words):
    n, kind = len(value), lambda c: "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-"
    rest = re.sub("|".join(sorted(words, key=lambda w: (-len(w), w))), "", value.lower())
    context = " ".join([before, *([after] if re.search(r"^\w+\W?$", after) else [])])
    return [
        n, sum(kind(a) != kind(b) and kind(a) + kind(b) != "Aa" for a, b in zip(value, value[1:])) / n, sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n, len(set(value)) / n,
        len(re.findall(r"(?i)(?<=[aeiou])[b-df-hj-np-tv-z](?=[aeiou])", value)) / n, 1 - len(rest) / n, sum(a == b for a, b in zip(value, value[1:])) / n,
        bool(re.search(secrets._ASKS, before)), bool(re.search(secrets._DENIES, context)), bool(re.search(secrets._TRIAL, path or "")), bool(re.search(r"[=:][ \"']*$", before)),
    ]


def test_candidates_and_features_equal_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    extra = [(-1, f"a {KEY};{OTHER};{KEY}x;{OTHER}y;{KEY}z end", "tests/readme"), (-2, f"sha256: {COMMIT} password = correct-horse-battery-staple", None), (-3, None, "x")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, source string")).cache()
    words = secrets.dictionary(docs)
    counts = Counter(w for r in docs.collect() for w in re.findall(r"(?<![a-z0-9+/_=\-])[a-z]{4,12}(?![a-z0-9+/_=\-])", (r["text"] or "").lower()))
    common = sorted(counts, key=lambda w: (-counts[w], w))[: secrets.COUNTED_WORDS]
    assert len(counts) > secrets.COUNTED_WORDS and words == sorted({*secrets.DICTIONARY, *common})
    got = secrets.features(secrets.candidates(docs), words).orderBy("doc_id", "nth").collect()
    want = [(r["doc_id"], k, *c, r["source"]) for r in docs.orderBy("doc_id").collect() for k, c in enumerate(plain_candidates(r["text"]))]
    assert len(want) > 40 and [tuple(r[c] for c in ("doc_id", "nth", "value", "before", "after", "path")) for r in got] == want
    for r in got:
        for name, a, b in zip(secrets.FEATURES, [r[f] for f in secrets.FEATURES], plain_features(r["value"], r["before"], r["after"], r["path"], words)):
            assert abs(a - b) < 1e-9, (name, a, b, r["value"])


def test_query_scans_whole_tables(spark):
    """Candidates of the registered query are those of plain Python, scored by one forest."""
    rows = queries.op9_secret_scan(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {(r["doc_id"], k, hashlib.sha256(v.encode()).hexdigest(), len(v)) for r in docs for k, (v, _, _) in enumerate(plain_candidates(r["text"]))}
    assert {(r["doc_id"], r["nth"], r["value_sha256"], r["value_chars"]) for r in rows} == want
    assert all(0 <= r["score"] <= 1 and r["is_secret"] == (r["score"] >= secrets.THRESHOLD) for r in rows)


def test_no_path_column_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, f'api_key = "{KEY}"', 7, "mine")], "doc_id bigint, text string, score int, f string")
    row = secrets.scan(docs, path_col=None).first()
    assert row["value"] == KEY and row["path"] is None and row["is_secret"]

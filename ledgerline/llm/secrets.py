"""Secret scans, in DataFrame and SQL functions only.

Candidates are long runs of key-like characters, found in whole texts: with a
digit, or where their word or the words before ask for a key. A random forest then removes false positives, from a candidate's
length, its character transitions, how much of it dictionary words cover, its
path and its neighbouring words. The dictionary is the words that names are
made of and the most frequent words of the scanned texts, counted over all of
them. The forest is trained from labelled findings; without a table of such,
from generated ones (``TRAIN_ROWS``), which hold real-looking keys in key-like
places and the usual false alarms: commit and checksum digests, identifiers,
placeholders, repeats and versions.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bound on labelled findings that a forest is trained from.
TRAIN_ROWS = 6000
TREES, DEPTH, SEED = 24, 7, 9
THRESHOLD = 0.5
#: Candidates back to which the text of a word is a candidate's context, so that contexts of a long word stay in proportion to it.
CONTEXT = 3

#: A whole run of at least 16 key-like characters; the start of a run is tried once, so long runs are read in proportion.
_RUN = r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}+"
#: A run with a digit in it.
CANDIDATE = r"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z+/_=\-]*+[0-9])[A-Za-z0-9+/_=\-]{16,}+"

#: Most frequent words of the texts that join the dictionary; a bound on a feature's size, not on what is scanned.
COUNTED_WORDS = 1000
#: Words that names in code are made of. Fixed values.
DICTIONARY = ["access", "account", "admin", "aggregate", "alpha", "application", "array", "backend", "beta", "build", "cache", "change", "class", "client", "config", "connection", "container", "content", "controller", "default", "demo", "document", "dummy", "example", "factory", "field", "file", "function", "handler", "here", "image", "index", "insert", "instance", "internal", "key", "manager", "message", "method", "module", "name", "number", "object", "option", "page", "password", "placeholder", "process", "project", "release", "replace", "request", "response", "sample", "secret", "server", "service", "session", "string", "system", "table", "template", "test", "token", "update", "user", "value", "version", "window", "your"]
_ASKS = r"(?i)(token|secret|passw|passphrase|api.?key|apikey|access.?key|private.?key|auth|bearer|credential)"
_DENIES = r"(?i)(?<![a-z])(commit|sha-?1|sha-?256|md5|checksum|digest|hash|uuid|guid|revision|etag|example|sample|placeholder|dummy|version|class|import)(?![a-z])"
_TRIAL = r"(?i)(test|example|sample|fixture|mock|docs?/|readme|demo)"

FEATURES = ["f_length", "f_turns", "f_digits", "f_upper", "f_distinct", "f_vowel_pairs", "f_covered", "f_repeat", "f_asks", "f_denies", "f_trial", "f_assigned"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, nth, value, before, after, path): every candidate, also of
    several in one word. ``before`` has up to three words before the
    candidate's word and what precedes it there, back to the third candidate
    before it; ``after`` the text up to the word's next candidate, or the word
    after. ``nth`` counts a document's candidates from 0."""
    text = F.col(text_col)
    pattern = lambda i: F.when(F.concat_ws(" ", *[F.get("__w", i - k) for k in (3, 2, 1, 0)]).rlike(_ASKS), F.lit(_RUN)).otherwise(F.lit(CANDIDATE))
    some = docs.filter(text.rlike(CANDIDATE) | text.rlike(_ASKS) & text.rlike(_RUN)).select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.split(text, r"[\x20\x09-\x0D]+").alias("__w"))
    at = F.filter(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: F.get("__w", i).rlike(_RUN) & F.regexp_like(F.get("__w", i), pattern(i)))
    word = lambda i: F.struct(
        F.regexp_extract_all(F.get("__w", i), pattern(i), F.lit(0)).alias("runs"),
        F.split(F.get("__w", i), pattern(i), -1).alias("gaps"),
        F.concat_ws(" ", F.get("__w", i - 3), F.get("__w", i - 2), F.get("__w", i - 1)).alias("words_before"),
        F.coalesce(F.get("__w", i + 1), F.lit("")).alias("after"),
    )

    def run(w, k):
        since = F.greatest(k - CONTEXT, F.lit(0))
        own = F.zip_with(F.slice(w["gaps"], since + 1, k - since), F.slice(w["runs"], since + 1, k - since), lambda gap, value: F.concat(gap, value))
        return F.struct(
            F.get(w["runs"], k).alias("value"),
            F.concat_ws(" ", F.when(since == 0, w["words_before"]), F.concat(F.array_join(own, ""), F.get(w["gaps"], k))).alias("before"),
            F.when(k + 1 < F.size(w["runs"]), F.get(w["gaps"], k + 1)).otherwise(w["after"]).alias("after"),
        )

    runs = F.transform(F.transform(at, word), lambda w: F.transform(F.sequence(F.lit(0), F.size(w["runs"]) - 1), lambda k: run(w, k)))
    return some.select("doc_id", "path", F.posexplode(F.flatten(runs)).alias("nth", "c")).select("doc_id", "nth", "c.value", "c.before", "c.after", "path")


def dictionary(docs: DataFrame, text_col: str = "text", words: int = COUNTED_WORDS) -> list[str]:
    """``DICTIONARY`` and the most frequent words of four to twelve letters of
    all texts, counted whole; of equally frequent ones the first by alphabet."""
    plain = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![a-z0-9+/_=\-])[a-z]{4,12}(?![a-z0-9+/_=\-])"), F.lit(0)))
    counted = docs.select(plain.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return sorted({*DICTIONARY, *(r["word"] for r in counted.collect())})


def features(found: DataFrame, words: list[str] = DICTIONARY) -> DataFrame:
    """Adds the forest's features to (value, before, after, path). ``words``:
    the dictionary; longer words are looked for first."""
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    # The word after counts if it is a plain word: addresses and links say little about what stands before them.
    context = F.concat_ws(" ", "before", F.when(F.col("after").rlike(r"^\w+\W?$"), F.col("after")))
    flag = lambda c, pattern: F.coalesce(c.rlike(pattern), F.lit(False)).cast("double")
    # Between classes of characters: letter to digit, lower to upper and so on.
    turns = r"(?<=[a-z])(?=[A-Z0-9+/_=\-])|(?<=[A-Z])(?=[0-9+/_=\-])|(?<=[0-9])(?=[A-Za-z+/_=\-])|(?<=[+/_=\-])(?=[A-Za-z0-9])"
    rest = F.length(F.regexp_replace(F.lower(v), "|".join(sorted(words, key=lambda w: (-len(w), w))), ""))
    return found.withColumns({
        "f_length": n,
        "f_turns": share(turns),
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "f_vowel_pairs": share("(?i)(?<=[aeiou])[b-df-hj-np-tv-z](?=[aeiou])"),
        "f_covered": 1 - rest / n,
        "f_repeat": share(r"(.)(?=\1)"),
        "f_asks": flag(F.col("before"), _ASKS),
        "f_denies": flag(context, _DENIES),
        "f_trial": flag(F.col("path"), _TRIAL),
        "f_assigned": flag(F.col("before"), r"[=:][ \"']*$"),
    })


def generated_findings(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled findings (value, before, after, path, label), the same in every run."""
    pick = lambda tag, *options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64(F.lit(tag), "id"), F.lit(len(options))) + 1).cast("int"))
    hexes = lambda tag: F.sha2(F.concat(F.lit(tag), F.col("id").cast("string")), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(hexes("b"))), r"[+/=]", "")
    length = lambda low, high: (F.lit(low) + F.pmod(F.xxhash64(F.lit("n"), "id"), F.lit(high - low + 1))).cast("int")
    word = lambda tag: pick(tag, *DICTIONARY)
    digits = F.pmod(F.xxhash64(F.lit("d"), "id"), F.lit(900)).cast("string")
    asked = pick("ask", "token = \"", "the api_key: ", "export SECRET=", "password = '", "Authorization: Bearer ", "access_key = \"", "auth_token: \"", "credential \"")
    plain = pick("plain", "see ", "in the ", "value ", "", "of the and ", "set to ", "re ea then ")
    denied = pick("deny", "commit ", "sha256: ", "md5 checksum ", "etag ", "revision ", "uuid ", "digest = ")
    path = pick("path", "src0", "web", "crawl", "src/app/config.py", "deploy/prod.env", "books", "forum")
    trial = pick("trial", "tests/fixtures/auth.py", "docs/readme", "examples/demo.txt", "mock/data")
    upper = lambda c: F.when(F.pmod(F.xxhash64(F.lit("u"), "id"), F.lit(5)) == 0, F.upper(c)).otherwise(c)
    kinds = [
        # value, before, path, label
        (upper(hexes("h").substr(F.lit(1), length(24, 48))), upper(asked), path, 1),
        (base64.substr(F.lit(1), length(20, 42)), asked, path, 1),
        (F.concat(pick("prefix", "AKIA", "ghp_", "sk-live-", "xoxb-", "glpat-"), base64.substr(F.lit(1), length(16, 36))), pick("either", "token = \"", "key ", "use ", "secret: "), path, 1),
        (hexes("c").substr(F.lit(1), pick("len", 32, 40, 64)), denied, path, 0),
        (hexes("p").substr(F.lit(1), length(24, 40)), plain, path, 0),
        (F.concat_ws("_", word("w1"), word("w2"), word("w3"), digits), plain, path, 0),
        (F.concat(word("x1"), F.initcap(word("x2")), F.initcap(word("x3")), digits), pick("a2", "token = ", "call ", "the "), path, 0),
        (F.concat(pick("verb", "get", "set", "make", "load", "new", "on", "is"), F.initcap(word("v1")), F.initcap(word("v2")), F.initcap(word("v3")), F.substring(digits, 1, 1)), pick("a3", "call ", "the ", "use ", "= "), path, 0),
        (F.concat(pick("ph", "your-api-key-here-", "example-token-value-", "placeholder-secret-", "replace-password-"), digits), asked, path, 0),
        (F.concat(F.repeat(pick("rep", "x", "0", "a", "1"), 20), digits), asked, path, 0),
        (hexes("t").substr(F.lit(1), length(24, 40)), F.concat(F.lit("example "), asked), trial, 0),
        (F.rpad(F.abs(F.xxhash64(F.lit("card"), "id")).cast("string"), 16, "4").substr(F.lit(1), F.lit(16)), F.concat(F.when(F.pmod(F.xxhash64(F.lit("m"), "id"), F.lit(4)) == 0, F.lit("token = ")).otherwise(F.lit("")), plain), path, 0),
    ]
    kind = F.pmod(F.col("id"), F.lit(len(kinds)))
    chosen = None
    for i, (value, before, place, label) in enumerate(kinds):
        row = F.struct(value.alias("value"), before.alias("before"), F.lit("").alias("after"), place.alias("path"), F.lit(label).cast("double").alias("label"))
        chosen = F.when(kind == i, row) if chosen is None else chosen.when(kind == i, row)
    return spark.range(0, rows, 1, 1).select(chosen.alias("r")).select("r.*").filter(F.length("value") >= 16)


def train(findings: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED, words: list[str] = DICTIONARY) -> RandomForestClassificationModel:
    """A forest from labelled findings (value, before, after, path, label 0/1);
    of more than ``rows`` those with the smallest hashes are taken. ``words``
    must be the dictionary that ``scan`` is given."""
    bounded = findings.filter("label is not null and value is not null").orderBy(F.xxhash64("value", "before", "path"), "value", "label").limit(rows).coalesce(1)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="f").transform(features(bounded, words)).select("f", "label")
    return RandomForestClassifier(featuresCol="f", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird").fit(vectors)


def scan(docs: DataFrame, model: RandomForestClassificationModel | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD, findings: DataFrame | None = None, words: list[str] | None = None) -> DataFrame:
    """Every candidate with the forest's ``score`` and ``is_secret``: (doc_id,
    nth, value, before, after, path, score, is_secret).

    ``model`` and its ``words``: a trained forest; else one is trained here,
    from ``findings`` or generated ones, with a dictionary counted from the
    texts. Null, empty and blank texts and empty tables have no candidates;
    texts are scanned whole, however long; a null path, or no path column
    (``None``), has no trial words; repeated rows are each answered; columns of
    any other name are left alone.
    """
    if path_col is None:
        docs, path_col = docs.select(id_col, text_col, F.lit(None).cast("string").alias("__path")), "__path"
    if model is None:
        words = dictionary(docs, text_col) if words is None else words
        model = train(generated_findings(docs.sparkSession) if findings is None else findings, words=words)
    seen = features(candidates(docs, id_col, text_col, path_col), DICTIONARY if words is None else words)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="__f", handleInvalid="keep").transform(seen).withColumnRenamed("__f", "f"))
    score = F.round(vector_to_array("probability")[1], 6)
    return scored.select("doc_id", "nth", "value", "before", "after", "path", score.alias("score"), (score >= threshold).alias("is_secret"))

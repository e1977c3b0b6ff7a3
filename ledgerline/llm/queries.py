"""The registered queries opN_<name> and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, licenses, mixing, quality, secrets, sharding, simhash, token_store, warc

#: Folder of public tokenizer files; None: that of the installed ``public_tokenizers``.
TOKENIZERS: str | None = None
TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches, then the items with a window within ``decontamination.SLOP``."""
    index = decontamination.build_index(_table(spark, sf_dir, "documents"))
    found = decontamination.verdicts(decontamination.search(index, _table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items", "near_items_sha256")


#: Layouts that a conversation of certain roles may take; any other: the first two.
_LAYOUTS = {
    ("user", "assistant"): ["messages", "conversations", "prompt-response", "prompt-completion", "instruction-output", "question-answer"],
    ("system", "user", "assistant"): ["messages", "conversations", "prompt-response"],
    ("user", "user", "assistant"): ["messages", "conversations", "instruction-output"],
}
_FLAT = {
    "prompt-response": {"system": "system", "user": "prompt", "assistant": "response"},
    "prompt-completion": {"user": "prompt", "assistant": "completion"},
    "instruction-output": {"user": "instruction", "input": "input", "assistant": "output"},
    "question-answer": {"user": "question", "assistant": "answer"},
}


def _unlike_records(rows: DataFrame) -> DataFrame:
    """Conversations as records of all six layouts, dealt by their ids."""
    listed = chat.records_from_rows(rows)
    roles = F.transform("messages", lambda m: m["role"])
    k = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(6))
    renamed = F.coalesce(F.exists("messages", lambda m: m["role"].isin("human", "gpt")), F.lit(False))
    choice = F.when(~renamed & (k % 2 == 1), "conversations").otherwise("messages")
    for shape, layouts in _LAYOUTS.items():
        same = F.coalesce(roles == F.array(*[F.lit(r) for r in shape]), F.lit(False))
        choice = F.when(same, F.element_at(F.array(*[F.lit(x) for x in layouts]), (k % len(layouts) + 1).cast("int"))).otherwise(choice)
    dealt = listed.withColumn("__layout", choice)
    is_ = lambda name: F.col("__layout") == name
    outer = {"user": "human", "assistant": "gpt"}
    renamed_role = lambda r: F.coalesce(*[F.when(r == a, b) for a, b in outer.items()], r)
    said = {
        "messages": F.when(is_("messages"), F.col("messages")),
        "conversations": F.when(is_("conversations"), F.transform("messages", lambda m: F.struct(renamed_role(m["role"]).alias("from"), m["content"].alias("value")))),
    }
    two_users = F.size("messages") == 3
    for name, columns in _FLAT.items():
        for role, column in columns.items():
            place = {"system": F.when(two_users, 0), "input": F.when(two_users, 1), "assistant": F.size("messages") - 1}.get(role, F.when(F.lit(name == "instruction-output"), 0).otherwise(F.size("messages") - 2))
            text = F.when(is_(name), F.get("messages", place)["content"])
            said[column] = F.coalesce(said[column], text) if column in said else text
    return dealt.select("conv_id", *[v.alias(c) for c, v in said.items()])


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unlike_records(_table(spark, sf_dir, "conversations"))
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(said).alias("prompt"), F.lit(said).alias("response"))
    records = rows.unionByName(extra, allowMissingColumns=True)
    made = chat.format_turns(chat.canonical_turns(records, ["conv_id"]))
    back = made.select("conv_id", "layout", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "layout",
    )


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    if TOKENIZERS is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    else:
        path = f"{TOKENIZERS}/{TOKENIZER}"
    stored = token_store.write(_table(spark, sf_dir, "documents"), path)
    return token_store.read(stored).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality.assess(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", *counts, "base_failed", "kept", "group_rows", *quality.bounds_of(quality.MEASURES))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return dealt.select("doc_id", sharding.size_of("text").alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["template"])))
    return found.select("doc_id", F.size(names).cast("bigint").alias("n_licenses"), F.array_join(names, ",").alias("licenses"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "nth", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("value_chars"), "score", "is_secret")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(_table(spark, sf_dir, "documents")).select("doc_id", "text", "lang", "source", "n_chars", "copies", "copy", "position")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_decontamination, op2_chat_formatting, op3_token_output, op4_quality_rules, op5_sharding, op6_simhash, op7_warc, op8_license_scan, op9_secret_scan, op10_source_mixing]
    return {f.__name__: f for f in named} | {"pipeline": pipeline}


# ---- SQL ------------------------------------------------------------------

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_decontamination() -> str:
    def words(table: str, key: str) -> str:
        return f"SELECT {key}, regexp_extract_all({_ASCII_LOWER.format('coalesce(text, chr(32))')}, '{_ALNUM}') AS w FROM {table}"

    return f"""
WITH d AS ({words('documents', 'doc_id')}), b AS ({words('benchmark', 'item_id')}),
win AS (
  SELECT item_id, array_to_string(CASE WHEN len(w) < 13 THEN w ELSE w[s:s + 12] END, ' ') AS gram, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
),
found AS (SELECT g.doc_id, g.s, g.n, win.item_id FROM grams g JOIN win ON g.gram = win.gram AND g.n = win.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list FROM found GROUP BY doc_id),
seek AS (SELECT item_id, s, least(len(w), 13) AS n, CASE WHEN len(w) < 13 THEN w ELSE w[s:s + 12] END AS ws FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM b WHERE len(w) > 0 AND item_id IS NOT NULL)),
word AS (SELECT item_id, s, n, unnest(ws) AS x, unnest(range(len(ws))) AS j FROM seek),
pos AS (SELECT doc_id, x, p FROM (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM d) WHERE x IN (SELECT x FROM word)),
freq AS (SELECT x, count(*) AS often FROM pos GROUP BY x),
rare AS (SELECT item_id, s, n, arg_min(x, (often, j)) AS x, arg_min(j, (often, j)) AS j FROM word JOIN freq USING (x) GROUP BY item_id, s, n HAVING count(*) = n),
starts AS (SELECT DISTINCT doc_id, item_id, s, n, unnest(generate_series(p - j - {decontamination.SLOP}, p - j + {decontamination.SLOP})) AS place FROM rare JOIN pos USING (x)),
close AS (
  SELECT DISTINCT doc_id, item_id FROM (
    SELECT starts.doc_id, starts.item_id, starts.s, starts.n, place, count(DISTINCT j) AS c
    FROM starts JOIN word ON word.item_id = starts.item_id AND word.s = starts.s JOIN pos ON pos.doc_id = starts.doc_id AND pos.x = word.x
    WHERE abs(pos.p - place - j) <= {decontamination.SLOP} GROUP BY ALL
  ) WHERE c = n
),
near AS (SELECT doc_id, count(*) AS n_near, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS near_list FROM close GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near_list, '')) AS near_items_sha256
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN near USING (doc_id)"""


def _sql_chat() -> str:
    rest = lambda c: "|".join(x[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for x in chat.CONTROLS if x[0] == c)
    escaped = f"regexp_replace(regexp_replace(text, '(<\\\\*)({rest('<')})', '\\1\\\\\\2', 'g'), '(\\[\\\\*)({rest('[')})', '\\1\\\\\\2', 'g')"
    frame = len(chat.START) + len(chat.END) + 2
    shapes = " ".join(f"WHEN roles = {list(shape)} THEN {layouts}[k % {len(layouts)} + 1]" for shape, layouts in _LAYOUTS.items())
    return f"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
c AS (
  SELECT conv_id, (coalesce(conv_id, 0) % 6 + 6) % 6 AS k, list(role ORDER BY turn, role, text) AS roles, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({frame} + length(role) + length({escaped})) AS BIGINT) AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
  CASE WHEN conv_id = -7 THEN 'prompt-response' {shapes} WHEN k % 2 = 1 AND NOT list_has_any(roles, ['human', 'gpt']) THEN 'conversations' ELSE 'messages' END AS layout
FROM c"""


def _sql_quality() -> str:
    bucket = "(CASE WHEN v < 64 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END)"
    top = "(CASE WHEN bucket < 64 THEN bucket ELSE ((bucket - 32 * (bucket // 32 - 1) + 1) << (bucket // 32 - 1)) - 1 END)"
    rules = quality.MEASURES
    case = lambda f: "CASE measure " + " ".join(f"WHEN '{k}' THEN {f(r)}" for k, r in rules.items()) + " END"
    sketched = ", ".join(f"{scale} * greatest({part} - {rules[k].forgiven}, 0) // greatest({whole}, 1)" for k, (scale, part, whole) in quality._RATES.items())
    wide = lambda tag, end: ", ".join(f"any_value({end}) FILTER (measure = '{k}') AS {tag}{k}_{end}" for k in rules)
    blend = lambda k, end: f"(g.n * g.{k}_{end} + {quality.PRIOR_ROWS} * ((l.n * l.{k}_{end} + {quality.PRIOR_ROWS} * a.{k}_{end}) // (l.n + {quality.PRIOR_ROWS}))) // (g.n + {quality.PRIOR_ROWS})"
    ends = [f"{blend(k, 'high')} * {r.margin} // 100 AS {k}_high" for k, r in rules.items()] + [f"{blend(k, 'low')} * 100 // {r.margin} AS {k}_low" for k, r in rules.items() if r.both]
    fine = [f"v_{k} <= {k}_high" for k in rules] + [f"v_{k} >= {k}_low" for k, r in rules.items() if r.both]
    values = ", ".join(f"{scale} * greatest({part} - {rules[k].forgiven}, 0) // greatest({whole}, 1) AS v_{k}" for k, (scale, part, whole) in quality._RATES.items())
    return f"""
WITH w AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT row, s, w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] AS g FROM (SELECT row, w, unnest(generate_series(1, len(w) - 2)) AS s FROM w WHERE len(w) >= 3)),
twice AS (SELECT row, s FROM (SELECT row, s, count(*) OVER (PARTITION BY row, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([s, s + 1, s + 2]) AS p FROM twice) GROUP BY row),
lines AS (SELECT row, count(*) AS n, count(DISTINCT l) AS u FROM (SELECT row, unnest(string_split(text, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY row),
m AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM (
    SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(text) - length(regexp_replace(text, '[^\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_lines, CAST(coalesce(lines.n - lines.u, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN repeats ON w.row = repeats.row LEFT JOIN lines ON w.row = lines.row)
),
r AS (SELECT lang, source, measure, v, {bucket} AS bucket FROM (SELECT lang, source, unnest([{', '.join(f"'{k}'" for k in rules)}]) AS measure, unnest([{sketched}]) AS v FROM m WHERE NOT base_failed)),
levels AS (SELECT 0 AS level, lang, source, measure, bucket FROM r UNION ALL SELECT 1, lang, NULL, measure, bucket FROM r UNION ALL SELECT 2, NULL, NULL, measure, bucket FROM r),
counted AS (SELECT level, lang, source, measure, bucket, count(*) AS n FROM levels GROUP BY ALL),
marks AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY level, lang, source, measure) AS everything FROM counted),
q AS (
  SELECT level, lang, source, measure, CAST(max(everything) AS BIGINT) AS n, CAST(min({top}) FILTER (100 * seen >= everything * (100 - {case(lambda r: r.level)})) AS BIGINT) AS low, CAST(min({top}) FILTER (100 * seen >= everything * {case(lambda r: r.level)}) AS BIGINT) AS high
  FROM marks GROUP BY ALL
),
p AS (SELECT level, lang, source, any_value(n) AS n, {wide('', 'low')}, {wide('', 'high')} FROM q GROUP BY level, lang, source),
t AS (
  SELECT g.lang, g.source, g.n AS group_rows, {', '.join(ends)}
  FROM p g JOIN p l ON g.level = 0 AND l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang JOIN p a ON a.level = 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(fine)} AS kept, group_rows, {', '.join(quality.bounds_of(rules))}
FROM (SELECT *, {values} FROM m) m LEFT JOIN t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source"""


def _sql_licenses() -> str:
    words = lambda text: f"regexp_extract_all({_ASCII_LOWER.format(text)}, '{_ALNUM}')"
    table = licenses.template_table(licenses.TEMPLATES)
    rows = ", ".join(f"('{name}', {table[name][0]}, '{text.replace(chr(39), chr(39) * 2)}')" for name, text in licenses.TEMPLATES.items())
    return f"""
WITH t(template, stride, text) AS (VALUES {rows}),
tg AS (SELECT DISTINCT template, stride, array_to_string(w[s:s + 4], ' ') AS g FROM (SELECT template, stride, w, unnest(generate_series(1, len(w) - 4)) AS s FROM (SELECT template, stride, {words('text')} AS w FROM t))),
ts AS (SELECT template, count(*) AS n FROM tg GROUP BY template),
d AS (SELECT row_number() OVER () AS row, doc_id, {words('coalesce(text, chr(32))')} AS w FROM documents),
grams AS (SELECT row, s, array_to_string(w[s:s + 4], ' ') AS g FROM (SELECT row, w, unnest(generate_series(1, len(w) - 4)) AS s FROM d WHERE len(w) >= 5)),
met AS (SELECT row, template, stride, s, g FROM grams JOIN tg USING (g)),
runs AS (SELECT a.row, a.template, a.s, count(DISTINCT b.g) AS c FROM met a JOIN met b ON a.row = b.row AND a.template = b.template AND b.s >= a.s AND b.s < a.s + 2 * a.stride GROUP BY ALL),
found AS (SELECT DISTINCT row, template FROM runs JOIN ts USING (template) WHERE 5 * c >= 4 * n)
SELECT any_value(doc_id) AS doc_id, count(template) AS n_licenses, coalesce(string_agg(template, ',' ORDER BY template), '') AS licenses
FROM d LEFT JOIN found ON d.row = found.row GROUP BY d.row"""


def _sql_mixing() -> str:
    sources = "SELECT source, sum(coalesce(octet_length(encode(text)), 0) + 1) AS bytes FROM documents GROUP BY source"
    name = "coalesce(CAST(d.doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))"
    return f"""
WITH RECURSIVE s AS ({sources}),
r AS (SELECT source, CAST(1.0 AS DOUBLE) * 1.0 / (SELECT count(*) FROM s) * (SELECT sum(bytes) FROM s) / bytes AS rate FROM s),
p AS (SELECT source, CAST(greatest(ceil(rate / {mixing.PIECE}), 1) AS BIGINT) AS pieces, rate / greatest(ceil(rate / {mixing.PIECE}), 1) AS mean FROM r),
terms AS (
  SELECT source, pieces, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM p
  UNION ALL SELECT source, pieces, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM terms WHERE k < {mixing.TERMS}
),
cdf AS (SELECT source, any_value(pieces) AS pieces, list(c ORDER BY k) AS cdf FROM terms GROUP BY source),
drawn AS (
  SELECT d.*, {name} AS name, cdf, unnest(generate_series(1, pieces)) AS piece FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
),
counted AS (
  SELECT doc_id, text, lang, source, n_chars, name, CAST(sum(len(list_filter(cdf, lambda c: c <= CAST('0x' || substr(md5('{mixing.SEED}:' || piece || ':' || name), 1, 13) AS BIGINT) / 4503599627370496.0))) AS BIGINT) AS copies
  FROM drawn GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, copies, copy, md5('place {mixing.SEED}:' || copy || ':' || name) AS position
FROM (SELECT *, unnest(generate_series(0, copies - 1)) AS copy FROM counted WHERE copies > 0)"""


def _sql_sharding() -> str:
    # A row lies right of a byte mark if the larger part of it does.
    crc_table = "list_transform(generate_series(0, 255), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"
    return f"""
WITH table256 AS (SELECT {crc_table} AS t),
d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size FROM documents),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(size) OVER () AS total FROM d),
s AS (SELECT *, CAST(least(23, (12 * (2 * below + size) - 1) // total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor((c >> 8), t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s, table256"""


def _sql_warc() -> str:
    return f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> keeper THEN keeper END AS refers_to FROM k"""


def oracle_sql() -> dict[str, str]:
    """op3 needs the tokenizer, op6 XXH64 and a transitive closure, op9 a trained forest: they are tested against brute force and held-out findings."""
    return {
        "op1_decontamination": _sql_decontamination(),
        "op2_chat_formatting": _sql_chat(),
        "op4_quality_rules": _sql_quality(),
        "op5_sharding": _sql_sharding(),
        "op7_warc": _sql_warc(),
        "op8_license_scan": _sql_licenses(),
        "op10_source_mixing": _sql_mixing(),
    }

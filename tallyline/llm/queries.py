"""The queries opN_<name>: each applies one operator, with production
parameters, to its whole table. SQL holds the DuckDB text of those that SQL can
express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontamination, near_dedup, packing, pii, quality, secret_scan, toxicity, url_filter, warc
from .common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public vocabulary file on this machine; workers have the same one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("findings")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), 4)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.find(documents, pii.fit(documents))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.sql("SELECT -7L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role, '' AS text FROM range(2)").withColumn("text", F.lit(said))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(rows))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_urls": op4_urls,
    "op5_quality": op5_quality,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_chat": op9_chat,
    "op10_packing": op10_packing,
}

_URL = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    hosts, name, verdict = [], [], []
    for r in sorted(url_filter.HOST_RULES, key=lambda r: (-len(r.name), r.name)):
        fits = f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
        name.append(f"WHEN {fits} THEN '{r.name}'")
        verdict.append(f"WHEN {fits} THEN '{r.verdict}'")
        hosts.append(fits)
    blocks = sorted((r for r in url_filter.PATTERN_RULES if r.verdict == "block"), key=lambda r: r.name)
    first = " ".join(f"WHEN regexp_matches(lu, '{r.regex}') THEN '{r.name}'" for r in blocks)
    return f"""
WITH u AS (
  SELECT page_id, {_URL} AS lu,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), j AS (
  SELECT *, CASE {' '.join(name)} END AS rule, CASE {' '.join(verdict)} END AS by_host, CASE {first} END AS hit FROM u
)
SELECT page_id, host, path, rule, coalesce(by_host, CASE WHEN hit IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN rule IS NULL THEN hit END AS pattern
FROM j"""


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') , lambda x: x <> '')"
#: Every window that starts at a shingle of the item, compared in full.
_LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT doc_id, len(w) - 4 AS n, unnest(range(len(w) - 4)) AS p, w FROM d WHERE len(w) >= 5),
dsh AS (SELECT doc_id, n, p, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM ds),
ish AS (SELECT item_id, m, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM (SELECT item_id, len(w) - 4 AS m, unnest(range(len(w) - 4)) AS p, w FROM i WHERE len(w) >= 5)),
ic AS (SELECT item_id, m, s, count(*) AS c FROM ish GROUP BY ALL),
starts AS (SELECT DISTINCT doc_id, item_id, m, greatest(least(p, n - m), 0) AS start FROM dsh JOIN ic USING (s)),
wc AS (SELECT doc_id, item_id, start, m, s, count(*) AS c FROM starts JOIN dsh USING (doc_id) WHERE p BETWEEN start AND start + m - 1 GROUP BY ALL),
o AS (SELECT doc_id, item_id, start, any_value(wc.m) AS m, sum(wc.c) AS size, sum(least(wc.c, coalesce(ic.c, 0))) AS common FROM wc LEFT JOIN ic USING (item_id, s) GROUP BY ALL),
r AS (SELECT doc_id, item_id, start, common::DOUBLE / (m + size - common) AS similarity FROM o)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_min(start, (-similarity, start)) AS start FROM r WHERE similarity >= 0.8 GROUP BY ALL"""
#: All pairs that share a shingle, and their components.
_NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY ALL),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
sym AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT reach.doc_id, sym.y FROM reach JOIN sym ON sym.x = reach.to_id),
c AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""
#: What the archives must hold.
_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages), d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)"""
_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)),
f AS (SELECT *, CASE WHEN contains(text, '###') OR contains(text, '</turn>') THEN regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') ELSE text END AS body FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || role || '|0: ' || body || '</turn>') + 1) AS formatted_chars
FROM f GROUP BY conv_id"""
SQL = {"op3_near_duplicates": _NEAR, "op4_urls": _url_sql(), "op7_decontamination": _LEAKS, "op8_warc": _WARC, "op9_chat": _CHAT}

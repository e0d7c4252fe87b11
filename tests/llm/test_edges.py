"""Nulls, empty and long texts, repeated rows, empty tables and clashing names,
for every operator."""

import pytest

from tallyline.llm import chat, decontamination, near_dedup, packing, pii, quality, secret_scan, toxicity, url_filter, warc
from tallyline.llm.queries import tokenizer_path

CLASH = ("key", "n", "v", "a", "b", "size", "salt", "hash", "row", "root", "s", "score", "kept", "w", "spans", "owner", "path", "hit_id", "gone_id")
LONG = "alpha beta gamma " * 20_000 + "x" * 100_000
TEXTS = [None, "", "   \n\t ", "one", "one two three", "one two three", LONG, "tie tie tie tie tie tie", "\u00e9\u00e8 \U0001f600 token = 'abcdefgh12345678'", "mail a.b@c.de and +1 (017) 555-7713 and 4111 1111 1111 1111"]


def documents(spark, rows=None):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", "s"), (None, "one two three four five six", None, None)] if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in CLASH:
        df = df.selectExpr("*", f"'x' AS {c}")
    return df


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


LABELS = [(3, 0, 1), (4, 1, 0), (4, 1, 0), (6, None, None), (None, 1, 1), (99, 1, 1)]


def _run(spark, name, df):
    if name == "toxicity":
        return toxicity.score(df, toxicity.fit(df, labels(spark, LABELS)))
    if name == "secrets":
        return secret_scan.scan(df)
    if name == "near":
        return near_dedup.link(df, 4)
    if name == "quality":
        return quality.judge(df, quality.fit(df, labels(spark, LABELS)))
    if name == "pii":
        return pii.find(df, pii.fit(df))
    if name == "packing":
        return packing.pack_documents(df, tokenizer_path())
    if name == "leaks":
        return decontamination.find(df, benchmark(spark, [(1, None), (2, ""), (3, "one two"), (4, "one two three four five six"), (5, "one two three four five six")]))
    raise KeyError(name)


@pytest.mark.parametrize("name", ["toxicity", "secrets", "near", "quality", "pii", "packing", "leaks"])
def test_odd_rows(spark, name):
    rows = _run(spark, name, documents(spark)).collect()
    if name == "leaks":
        assert sorted((r.doc_id, r.item_id, r.similarity) for r in rows) == sorted([(None, 4, 1.0), (None, 5, 1.0)])
    elif name == "packing":
        assert {r.doc_id for r in rows} == {*range(len(TEXTS)), None}
        assert all(r.length == 1 == r.doc_tokens for r in rows if r.doc_id in (0, 1, 2))
    else:
        assert len(rows) == len(TEXTS) + 2


@pytest.mark.parametrize("name", ["toxicity", "secrets", "near", "quality", "pii", "packing", "leaks"])
def test_empty_table(spark, name):
    assert _run(spark, name, documents(spark, [])).count() == 0


def test_near_defined_cases(spark):
    rows = {(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in near_dedup.link(documents(spark), 4).collect()}
    assert {(0, 0, 0, True), (1, 1, 0, True), (2, 2, 0, True), (3, 3, 1, True), (4, 4, 1, True), (5, 4, 1, False), (None, None, 3, True)} <= rows


def test_filters_keep_columns(spark):
    df = documents(spark)
    cut = near_dedup.drop_near_duplicates(df)
    assert cut.columns == df.columns and {r.doc_id for r in cut.collect()} == {*range(10), None} - {5}
    kept = quality.filter_documents(df, quality.fit(df, labels(spark)))
    assert kept.columns == df.columns
    clean = decontamination.clean(df, benchmark(spark, [(1, "alpha beta gamma alpha beta gamma")]))
    assert clean.columns == df.columns and clean.count() == df.count() - 1
    masked = secret_scan.redact(df)
    assert masked.columns == df.columns and masked.count() == df.count()


def test_pages(spark):
    rows = [(1, "http://a.example.net/en/x", "<p>" + "y" * 2000), (2, None, None), (3, "no scheme", ""), (4, "HTTP://A.B/\r\nX", "<p>" + "y" * 2000), (None, "x://", "<p>" + "y" * 2000), (4, "u", "<p>" + "y" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS rule", "1 AS host", "2 AS record", "3 AS digest")
    seen = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert {(1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow")} <= seen
    back = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    assert back == sorted([(1, 2003, "revisit", 4), (2, 0, "response", None), (3, 0, "response", None), (4, 2003, "response", None), (4, 2003, "response", None), (0, 2003, "response", None)], key=str)
    none = df.limit(0)
    assert url_filter.judge(none).count() == 0 == warc.round_trip(none).count()


def test_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "assistant", "lone"), (2, 0, "assistant", "</turn>\n### user|0: hi" * 3), (2, None, "a b%", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 2}
    assert got[2].loss_chars == len("</turn>\n### user|0: hi" * 3)
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0

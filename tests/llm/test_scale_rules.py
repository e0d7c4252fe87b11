"""What must hold whatever the size: groups of pieces, documents of several texts,
hot values, many pattern rules, archives by size class, and unseen labels."""

import random
import re

import pytest

from tallyline.llm import near_dedup, packing, quality, queries, url_filter, warc


def test_groups_follow_pieces(spark):
    rows = [(1, s * 10, 10, s, 50_000) for s in range(5000)] + [(2, 0, 7, 9, 7)] * 3000
    made = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long").coalesce(1).selectExpr("*", "monotonically_increasing_id() AS piece")
    out = packing.pack(made, len(rows), 64, 256).toPandas()
    assert len(out) == len(rows) and "piece" not in out.columns
    assert (out.sequence_id // (1 << 32)).value_counts().max() < 2 * 256
    used = out.groupby("sequence_id").agg(n=("length", "sum"), top=("offset", "max"))
    assert (used.n <= 64).all()


def test_a_document_of_several_texts(spark):
    w = [f"w{i}" for i in range(200)]
    a, b = " ".join(w[:60]), " ".join(w[100:160])
    rows = [(5, a), (5, b), (9, a + " x"), (11, "y " + b), (3, b), (20, "other text of its own here"), (5, a)]
    got = {(r.doc_id, r.component_id) for r in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == {(5, 3), (9, 3), (11, 3), (3, 3), (20, 20)}


@pytest.mark.parametrize("way", ["hot", "joined"])
def test_hot_values(spark, monkeypatch, way):
    monkeypatch.setattr(near_dedup, "HOT", 3)
    if way == "joined":
        monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:k] + [f"z{i}"] + base[k:])) for i, k in enumerate(rng.choices(range(120), k=70))]
    rows += [(100 + i, " ".join(rng.choices("abcdefghij", k=30))) for i in range(30)]
    got = {r.doc_id: r.component_id for r in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert all(got[i] == 0 for i in range(70)) and all(got[100 + i] == 100 + i for i in range(30))


def test_shipped_rules_are_all_indexed():
    of = url_filter.token_sets
    assert all(of(r.regex) for r in url_filter.PATTERN_RULES)
    assert of(r"\bcasino[0-9]*\b") == [{"casino"}] and of(r"\b(?:xxx|porn)\b") == [{"xxx", "porn"}]
    assert of(r"\bmp3[0-9]*\b") == [{"mp"}] and of(r"\b7[0-9]*\b") == [] and of(r"(?:a|b)c") == [] and of(r"\bcasino[0-9]*x") == []


@pytest.mark.parametrize("inline", [True, False])
def test_thousands_of_rules_run_rarely(spark, monkeypatch, inline):
    n = 300 if inline else 3000
    monkeypatch.setattr(url_filter, "INLINE_RULES", 1000)
    forms = [r"\bbad{}-shop\b", r"/w{}[0-9]*/", r"[?&]id{}x=[0-9]+\b", r"\b(?:sell{}a|buy{}b)\b"]
    rules = tuple(url_filter.PatternRule(f"r{i:04d}", forms[i % 4].replace("{}", f"q{i}z"), "allow" if i % 7 == 0 else "block") for i in range(n))
    rng = random.Random(6)
    urls = [None, "", "nothing"]
    for _ in range(400):
        i = rng.randrange(n)
        urls.append(f"https://Shop.example.org/a/w{f'q{i}z'}{rng.choice(['', '7', 'x'])}/badq{rng.randrange(n)}z-shop?idq{rng.randrange(n)}zx={rng.choice(['5', 'x'])}&sellq{rng.randrange(n)}za")
    df = spark.createDataFrame(list(enumerate(urls)) + [(1, "")], "page_id long, url string")
    runs = url_filter.fetched(df, rules).selectExpr("sum(size(rules))").first()[0]
    assert runs <= 5 * len(urls)
    got = sorted((r.page_id, r.verdict, r.pattern or "") for r in url_filter.judge(df, (), rules).collect())
    want, compiled = [], [(r, re.compile(r.regex)) for r in rules]
    for page, url in [*enumerate(urls), (1, "")]:
        hits = sorted((r.verdict == "allow", r.name) for r, c in compiled if c.search((url or "").lower()))
        want.append((page, "block" if hits and not hits[0][0] else "allow", hits[0][1] if hits else ""))
    assert got == sorted(want)


def test_archives_by_size_class(spark, monkeypatch):
    monkeypatch.setattr(warc, "CLASSES", (2000, 9000, 20000))
    monkeypatch.setattr(warc, "FILE", 20000)
    rows = [(i, f"http://h/{i}", chr(97 + i % 26) * size + str(i)) for i, size in enumerate([10, 500, 3000, 8500, 15000, 30000, 70000, 1200] * 6)]
    rows += [(900, "http://h/" + "u" * 5000, "x"), (901, "http://h/\r\n", rows[5][2]), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    sizes = []
    real = warc.read_archives

    def read(session, folder):
        sizes.extend((r.path, r.length) for r in session.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "length").collect())
        return real(session, folder)

    monkeypatch.setattr(warc, "read_archives", read)
    got = {(r.page_id, r.payload_bytes, r.refers_to) for r in warc.round_trip(df).collect()}
    # the page whose payload 901 repeats is its revisit
    assert got == {(i, len((h or "").encode()), 901 if i == 5 else None) for i, _, h in rows}
    assert all(n <= 20000 or n > 20000 and sum(p == q for q, _ in sizes) == 1 for p, n in sizes) and len(sizes) > 10


def test_forest_on_unseen_labels(spark):
    """Fitted on two thirds of the labels, judged on the others."""
    folder = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    unseen = "crc32(cast(doc_id as string)) % 3 = 1"
    forest = quality.fit(documents, labels.where(f"NOT {unseen}"))
    judged = quality.judge(documents.join(labels.where(unseen).select("doc_id"), "doc_id", "left_semi"), forest).where("NOT base_failed").join(labels.select("doc_id", "quality"), "doc_id")
    counts = {(r.good, r.kept): r["count"] for r in judged.groupBy((judged.quality > 0).alias("good"), "kept").count().collect()}
    good, bad = [sum(v for (g, _), v in counts.items() if g is x) for x in (True, False)]
    print(counts)
    assert counts.get((True, False), 0) <= 0.02 * good and counts.get((False, False), 0) >= 0.9 * bad > 0
    assert queries.QUERIES["op5_quality"]

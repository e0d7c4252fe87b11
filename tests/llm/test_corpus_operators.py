"""Operators that compare documents, against plain versions."""

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest

from tallyline.llm import decontamination, near_dedup, queries, url_filter, warc
from tallyline.llm.components import components


def plain_components(texts, size):
    """doc to (set size, least connected doc), all pairs compared."""
    sets = {}
    for doc, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    above = {d: d for d in texts}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    docs = sorted(texts)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                above[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in docs}


def planted(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts, base = {}, [word() for _ in range(150)]
    for i in range(150):  # a large group: from no edits to too many
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            w[rng.randrange(len(w))] = word()
        texts[i] = " ".join(w)
    for i in range(150, 230):  # different texts that share a passage
        texts[i] = " ".join([word() for _ in range(90)] + passage)
    for i in range(230, 250):
        texts[i] = " ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 20])))
    for i in range(250, 270):  # copies, of short texts too
        texts[i] = texts[rng.randrange(250)].upper() + " \n"
    return texts | {270: "", 271: None}


def test_near_duplicates_planted(spark):
    texts = planted()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.link(docs, size).collect()}
        assert got == plain_components(texts, size)


def test_near_duplicate_query(spark, small):
    d = pd.read_parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_near_duplicates(spark, small).collect()}
    assert got == plain_components(dict(zip(d.doc_id, d.text, strict=True)), 4)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 51), (52, 51), (60, 60), (None, 3), (51, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 51: 50, 52: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_leaks(docs, items):
    out = {}
    words = lambda t: [w for w in (t or "").encode().lower().split()]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    for item, text in items.items():
        want = grams(words(text))
        c = Counter(want)
        for doc, t in docs.items():
            g = grams(words(t))
            for s in range(max(1, len(g) - len(want) + 1) if g and want else 0):
                common = sum((Counter(g[s : s + len(want)]) & c).values())
                j = common / (len(want) + len(g[s : s + len(want)]) - common)
                if j >= 0.8:
                    out[doc, item] = max(out.get((doc, item), 0), j)
    return out


def test_leaks_planted(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    items = {i: " ".join(word() for _ in range(rng.choice([4, 5, 9, 30, 55]))) for i in range(12)} | {20: "same same same same same same same same"}
    docs = {}
    for d in range(80):
        w = [word() for _ in range(rng.choice([0, 3, 30, 100]))]
        own = items[rng.choice(list(items))].split()
        if d % 3 == 0:
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = word()
            if d % 2:
                own.insert(rng.randrange(len(own)), word())
            at = rng.randrange(len(w) + 1)
            w[at:at] = own
        docs[d] = " ".join(w)
    docs[90] = "same " * 40
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.find(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    want = plain_leaks(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and want


def test_simhash_is_a_majority(spark):
    rng = random.Random(2)
    rows = [([rng.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 5, 40)]
    df = spark.createDataFrame(rows, "s array<long>")
    for r in df.select("s", decontamination.simhash(df.s).alias("h")).collect():
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r.s) > len(r.s))
        assert r.h % (1 << 64) == want


def test_literal_tokens():
    of = url_filter.literal_tokens
    assert of(r"\bspam-farm\b") == ["spam", "farm"] and of(r"/wp-login\.php\b") == ["wp", "login", "php"]
    assert of(r"\bcasino[0-9]*\b") == [] and of(r"a|b") == [] and of(r"\bab?c\b") == []
    assert of(r"[?&]aff_id=[0-9]+\b") == ["aff_id"]


def test_url_rules_beyond_the_plan(spark, monkeypatch):
    rows = [(i, f"https://h{i}.example.org/p/spam-farm/{i}" if i % 3 else f"https://h{i}.example.org/x/{i}.exe") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    inline = sorted(map(tuple, url_filter.judge(df).select("page_id", "verdict", "pattern").collect()))
    monkeypatch.setattr(url_filter, "INLINE_RULES", 0)
    assert sorted(map(tuple, url_filter.judge(df).select("page_id", "verdict", "pattern").collect())) == inline
    assert {v for _, v, _ in inline} == {"block"}


def test_warc_rejects_magic_in_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:66>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", fake * 3), (2, "u", "x" * 9_000_000 + fake), (3, "u", "<p>end"), (4, "u", fake * 3 + "y" * 1000), (5, "u", fake * 3 + "y" * 1000)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    for page, _, html in rows:
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(html), hashlib.sha1(html.encode()).hexdigest())
    assert got[4].record_type == "revisit" and got[4].refers_to == 5


def test_warc_chain_over_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 200)
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n"
    payloads = ["a" * 10, "b" * 700, head.format(9, 5) + "zzzzz", "", "c" * 150]
    raw = "".join(head.format(i, len(p)) + p + "\r\n\r\n" for i, p in enumerate(payloads)).encode()
    bases = range(0, len(raw), 200)
    found = {s: x for b in bases for s, _, _, x, _ in warc.boundaries(raw[b : b + 200 + 400], b)}
    entries, at = {0}, 0
    while found.get(at, len(raw)) < len(raw):
        at = found[at]
        entries.add(at)
    stream, rows = warc._Stream(), []
    for b in bases:
        rows += stream.read("p", len(raw), b, raw[b : b + 200 + 400], sorted(entries))
    assert [(r["page_id"], r["payload_digest"]) for r in rows] == [(i, hashlib.sha1(p.encode()).hexdigest()) for i, p in enumerate(payloads)]
    cut = raw[:-30]
    stream, rows = warc._Stream(), []
    for b in range(0, len(cut), 200):
        rows += stream.read("p", len(cut), b, cut[b : b + 200 + 400], sorted(entries))
    assert [r["page_id"] for r in rows] == [0, 1, 2, 3]


def test_warc_long_urls(spark, tmp_path):
    rows = [(i, "u" * (200_000 + i if i % 2 == 0 else 9) + "WARC/1.1", "<p>" + "ab" * i) for i in range(90)]  # more than two chunks
    rows += [(90, "u" * (2 * warc.CHUNK + 5), "x"), (91, "v", "WARC/1.1\r\na: " * 50_000), (92, "w", "y" * 1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.round_trip(pages).collect()}
    assert got == {i: (len(h), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows}
    warc.write_archives(pages.where("page_id < 5 OR page_id > 91"), f"{tmp_path}/x")
    (part,) = (tmp_path / "x").glob("part-*")
    whole = part.read_bytes()
    assert warc.read_archives(spark, f"{tmp_path}/x").count() == 6
    for damaged in (whole[:-30], b"z" + whole, whole[:-1000] + b"y" * 10 + whole[-1000:]):
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(damaged)
        with pytest.raises(Exception, match="chain of records"):
            warc.read_archives(spark, f"{tmp_path}/x").collect()


def test_open_headers_are_carried(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 200)
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nWARC-Target-URI: {}\r\nContent-Length: {}\r\n\r\n"
    for size in range(0, 900, 7):
        raw = "".join(head.format(i, "u" * (size * (i % 2)), 9) + f"payload-{i}\r\n\r\n" for i in range(5)).encode()
        headers = warc._Headers()
        found = {s: n for b in range(0, len(raw), 200) for s, _, n, _, _ in headers.boundaries("p", raw[b : b + 230], b)}
        assert found[0] == sorted(found)[1] and [*found.values()] == [*sorted(found)[1:], len(raw)]
        stream, rows = warc._Stream(), []
        for b in range(0, len(raw), 200):
            rows += stream.read("p", len(raw), b, raw[b : b + 230], [0])
        assert [r["payload_digest"] for r in rows] == [hashlib.sha1(f"payload-{i}".encode()).hexdigest() for i in range(5)] and stream.expected == len(raw)


def test_pointer_jumping_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 100)
    chains = {"a": list(range(0, 4000, 90)), "b": [0], "c": list(range(0, 950, 50)), "d": [0, 130, 260]}
    rows = []
    for path, starts in chains.items():
        size = starts[-1] + 40
        follow = dict(zip(starts, [*starts[1:], size], strict=True))
        if path == "d":
            follow[130] = 255  # a broken chain: nothing starts there
        for s in starts:
            x = follow[s]
            while x in follow and x < (s // 100 + 1) * 100:
                x = follow[x]
            rows.append((path, size, s, x))
        rows.append((path, size, 7, 63))  # magic inside a payload
    found = spark.createDataFrame(rows, "path string, size long, start long, exit long")
    entries = {(r.path, r.start) for r in warc.reachable(found).collect()} & {(p, s) for p, _, s, _ in rows}
    want = set()
    for path, size, *_ in {r[:2] for r in rows}:
        at, leads = 0, {s: x for p, _, s, x in rows if p == path}
        while at in leads:
            want.add((path, at))
            at = leads[at]
    assert entries == want and ("d", 260) not in entries and len(entries) > 40


def test_warc_query(spark, small):
    p = pd.read_parquet(f"{small}/pages.parquet")
    raw = p.html.fillna("").map(str.encode)
    p["digest"], p["bytes"] = raw.map(lambda x: hashlib.sha1(x).hexdigest()), raw.map(len)
    last = p[p.bytes >= 1000].groupby("digest").page_id.max()
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op8_warc(spark, small).collect()}
    for r in p.itertuples():
        to = int(last[r.digest]) if r.bytes >= 1000 and last[r.digest] != r.page_id else None
        assert got.pop(r.page_id) == (r.bytes, r.digest, "revisit" if to is not None else "response", to)
    assert not got

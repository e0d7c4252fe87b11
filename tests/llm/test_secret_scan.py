"""Secrets: the whole result against a plain count of owners and repositories, and
both ways of redacting."""

import random
import re
from collections import defaultdict

import pytest

from tallyline.llm import secret_scan

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    out = [(m.start(), 0, "assign", m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def plain_live(rows, value_of):
    """Values that are not copied examples."""
    owners, repositories = defaultdict(set), defaultdict(set)
    for doc, text, source in rows:
        for v in value_of(text or ""):
            owners[v].add(source or "")
            repositories[v].add((source or "", "" if doc is None else doc))
    return {v for v in owners if len(owners[v]) < secret_scan.EXAMPLE_OWNERS and len(repositories[v]) < secret_scan.EXAMPLE_REPOSITORIES}


def key(rng):
    return "".join(rng.choice("0123456789abcdef") for _ in range(40))


def corpus():
    rng = random.Random(3)
    shared, spread, twice = key(rng), key(rng), key(rng)
    rows = [(i, f'say token = "{shared}" here', f"s{i}") for i in range(5)]  # five owners
    rows += [(100 + i, f'x secret: {spread}', "one") for i in range(secret_scan.EXAMPLE_REPOSITORIES)]  # one owner, many repositories
    rows += [(200, f"{twice} and {twice}", "a"), (201, twice, "b")]
    rows += [(300 + i, f"é password={key(rng)} AKIA{key(rng).upper()[:16]}", f"s{i % 3}") for i in range(10)]
    rows += [(400, "token = changeme1234", "a"), (401, None, None), (402, "", "a"), (None, f"api_key='{key(rng)}'", None), (None, f"none {shared}", "z"), (200, "another text", "a")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' AS live_id", "'y' AS live_hashes", "1 AS own0", "2 AS of_key", "length(text) AS n_chars")


def test_spans_and_counts(spark):
    rows = corpus()
    live = plain_live(rows, lambda t: {v for *_, v in plain_spans(t)})
    assert len(live) > 20
    want = []
    for doc, text, _ in rows:
        base = plain_spans(text or "")
        mine = [x for x in base if x[4] in live and secret_scan._random_looking(x[4])]
        added = {(e - len(v), 5, "live", e) for _, _, _, e, v in mine}
        spans = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted([x[:4] for x in base] + list(added)))
        want.append((doc or -1, spans, len(mine), len(base) - len(mine)))
    got = [(r.doc_id or -1, r.spans, r.n_live, r.n_example) for r in secret_scan.scan(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    assert any(n for *_, n, _ in want) and any(n for *_, n in want)


@pytest.mark.parametrize("way", ["broadcast", "joined"])
def test_redact(spark, monkeypatch, way):
    if way == "joined":
        monkeypatch.setattr(secret_scan, "BROADCAST_HASHES", 0)
    rows = corpus()
    live = plain_live(rows, lambda t: {v for *_, v in plain_spans(t)})
    df = frame(spark, rows)
    out = secret_scan.redact(df)
    assert out.columns == df.columns
    want = []
    for doc, text, _ in rows:
        spans = [(s, e) for s, _, _, e, v in plain_spans(text or "") if v in live and secret_scan._random_looking(v)]
        masked = secret_scan.mask(text, spans)
        want.append((doc or -1, masked or "", len(masked or "")))
    got = out.collect()
    assert sorted((r.doc_id or -1, r.text or "", r.n_chars or 0) for r in got) == sorted(want)
    assert sum(secret_scan.MASK in (r.text or "") for r in got) >= 12


def test_one_owner_in_many_repositories_is_an_example(spark):
    rows = [(i, "see tOkEnA1b2C3d4E5f6G7h8I9j0K1l2 end", "one") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.n_live for r in secret_scan.scan(df, repository=df.doc_id % 50).collect()} == {0}
    assert {r.n_live for r in secret_scan.scan(df, repository=df.doc_id % 3).collect()} == {1}

"""Decontamination held against every window of every text, on both ways to join."""

import random
from collections import Counter

import pytest

from tallyline.llm import decontamination


def grams(text):
    w = (text or "").lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def plain(docs, items):
    """(doc, item) to (similarity, start) over all windows that start at one of the
    item's shingles (or at the last place), the earliest of the best."""
    out = {}
    for item, t in items:
        want = Counter(grams(t))
        m = sum(want.values())
        for doc, d in docs:
            g = grams(d)
            for p in range(len(g) if m else 0):
                if g[p] in want:
                    start = max(0, min(p, len(g) - m))
                    own = g[start : start + m]
                    common = sum((Counter(own) & want).values())
                    j = common / (m + len(own) - common)
                    if j >= 0.8:
                        out[doc, item] = max(out.get((doc, item), (0, 0)), (j, -start))
    return {k: (j, -start) for k, (j, start) in out.items()}


def found(spark, docs, items):
    got = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id): (r.similarity, r.start) for r in got.collect()}


def words(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


def test_items_that_overlap(spark):
    docs = [(1, f"zz yy {words(0, 29)} q1 q2 q3 q4")]
    items = [(1, words(0, 20)), (2, words(10, 30))]
    got = found(spark, docs, items)
    assert got == plain(docs, items) and abs(got[1, 2][0] - 15 / 17) < 1e-9


@pytest.mark.parametrize("way", ["broadcast", "shuffle"])
def test_every_window(spark, monkeypatch, way):
    if way == "shuffle":
        for bound in ("BROADCAST_ROWS", "BROADCAST_WORDS", "BROADCAST_STARTS"):
            monkeypatch.setattr(decontamination, bound, 0)
    rng = random.Random(11)
    line = [f"w{i}" for i in range(400)]
    items = []
    for i in range(40):  # of three sizes, cut from one line, so that many overlap
        size = rng.choice([9, 24, 40])
        at = rng.randrange(0, 300)
        items.append((i, " ".join(line[at : at + size])))
    items += [(90, "same " * 12), (91, "a b c d e a b c d e a b c d e a b"), (92, "one two three")]
    docs = []
    for d in range(60):
        at, size = rng.randrange(0, 300), rng.choice([8, 30, 60, 90])
        own = line[at : at + size]
        for _ in range(rng.choice([0, 0, 1, 2])):
            own[rng.randrange(len(own))] = "other"
        around = [f"x{rng.randrange(50)}" for _ in range(rng.choice([0, 5, 40]))]
        cut = rng.randrange(len(around) + 1)
        docs.append((d, " ".join(around[:cut] + own + around[cut:])))
    docs += [(70, "same " * 40), (71, "x y " + "a b c d e " * 6), (72, None), (73, "")]
    got, want = found(spark, docs, items), plain(docs, items)
    assert got.keys() == want.keys() and len(want) > 30
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_clean_judges_rows_by_their_text(spark):
    rows = [(None, words(0, 12)), (None, "clean text of no item at all, and more"), (4, words(0, 12)), (4, "a clean text with the same id as the other"), (5, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, hit_key string, key long")
    kept = decontamination.clean(df, spark.createDataFrame([(1, words(0, 12))], "item_id long, text string"))
    assert kept.columns == df.columns and {(r.doc_id, r.text) for r in kept.collect()} == {rows[1], rows[3], rows[4]}


def test_simhash_of_many_shingles(spark):
    df = spark.sql("SELECT array_repeat(-1L, 70000) AS s UNION ALL SELECT array_repeat(5L, 32768) UNION ALL SELECT concat(array_repeat(3L, 20000), array_repeat(1L, 20000), array(2L))")
    assert [r.h for r in df.select(decontamination.simhash(df.s).alias("h")).collect()] == [-1, 5, 3]

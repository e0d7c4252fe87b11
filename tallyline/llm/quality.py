"""Quality rules: an isolation forest over rule statistics.

Every document is reduced to a few statistics (how long its words are, how much
of it repeats, how many symbols it holds ...). A forest of random splits gives
each document the mean length of the path that isolates it; short paths mark
anomalies. All labelled rows make the model: their extremes bound the splits, the
rows in each leaf are counted over all good ones, and the threshold is set by the
scores of all. Only where a tree stops to split is decided on SAMPLE rows, which is
the method's own; they are drawn from all good rows.

The forest is a bounded object (TREES trees of at most 2 * SAMPLE nodes), so it
travels inside the task closure. All documents are scored in one scan with no
shuffle.

Defined cases: null and empty texts have no words, all counts are 0 and they
fail the base rules; repeated rows are judged one by one; without usable labels
(empty table, one class only) the forest rejects nothing; other columns of the
input are ignored by `judge` and kept by `filter_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BATCH_ROWS, bound_batches, by_batch, claim, hashed_sample, written

#: Forest size, and rows that one tree sees.
TREES, SAMPLE = 200, 256
#: Rows that the trees' samples are drawn from (all good ones while they are no
#: more), and scores that the driver holds at once.
DRAWN_ROWS, HELD_SCORES = TREES * SAMPLE, 10_000
#: Share of good labelled rows that the threshold may reject.
GOOD_REJECTED = 0.002
SYMBOLS = b"#*$%&|<>"
FEATURES = ("word_length", "symbols", "dup_lines", "repeated", "distinct", "top_word", "line_words", "digits")
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The five counts of STATS, and FEATURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, sum(raw.count(bytes([c])) for c in SYMBOLS), 0, 0), (0.0,) * len(FEATURES)
    spaces = sum(raw.count(bytes([c])) for c in b"\x20\x09\x0a\x0b\x0c\x0d")
    chars = len(text) - spaces
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeat = repeated_words(ids, len(number))
    counts = np.bincount(ids)
    digits = sum(raw.count(bytes([c])) for c in b"0123456789")
    return (n, chars, symbols, dup, repeat), (
        min(chars / n, 40.0),
        symbols / n,
        dup / len(lines),
        repeat / n,
        len(number) / n**0.75,
        float(counts.max()) / n,
        np.log1p(n / len(lines)),
        digits / max(chars, 1),
    )


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    if kinds < 2_000_000:  # three numbers fit one 64-bit key
        keys = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * kinds + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= twice
    return int(inside.sum())


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < 50 or 100 * n_repeat > 50 * n_words


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: feature (-1 at a leaf), split, left child (the
    right one follows it), and path length at leaves."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    unit: float
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies."""
        if not len(self.roots) or not len(x):
            return np.zeros(len(x))
        return 2.0 ** (-self.path[self.leaves(x)].mean(1) / self.unit)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        node = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[node]
            if (f < 0).all():
                return node
            right = x[rows, np.maximum(f, 0)] >= self.split[node]
            node = np.where(f < 0, node, self.child[node] + right)


def _expected(n: int) -> float:
    """Mean path of an unsuccessful search in a tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest:
    """An isolation forest over the rows of x; without rows it has no trees.

    Cuts fall anywhere in a node's box, the first being low to high, and not
    only between the rows that it holds: what lies outside the rows' own range
    is then cut off early."""
    rng = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    roots: list[int] = []
    deepest = 2 * int(np.ceil(np.log2(max(2, min(sample, len(x))))))
    varied = np.flatnonzero(high > low)
    for _ in range(trees if len(x) and len(varied) else 0):
        rows = rng.choice(len(x), min(sample, len(x)), replace=False)
        roots.append(len(nodes))
        nodes.append([-1, 0, 0, 0])
        todo = [(roots[-1], rows, 0, low, high)]
        while todo:
            at, rows, depth, lo, hi = todo.pop()
            if len(rows) < 2 or depth >= deepest:
                nodes[at] = [-1, 0, 0, depth + _expected(len(rows))]
                continue
            f = int(rng.choice(varied))
            cut = rng.uniform(lo[f], hi[f])
            right = x[rows, f] >= cut
            nodes[at] = [f, cut, len(nodes), 0]
            below, above = hi.copy(), lo.copy()
            below[f] = above[f] = cut
            todo += [(len(nodes), rows[~right], depth + 1, lo, below), (len(nodes) + 1, rows[right], depth + 1, above, hi)]
            nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
    a = np.array(nodes or [[-1, 0, 0, 0]])
    return Forest(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3], np.array(roots, int), _expected(min(sample, max(2, len(x)))), 2.0)


def calibrated(forest: Forest, x: np.ndarray, good: np.ndarray) -> Forest:
    """With a threshold that rejects at most GOOD_REJECTED of the good rows and,
    where most bad rows lie above that, half-way to the next bad one; without
    rows of both classes it rejects nothing."""
    if not len(x) or good.all() or not good.any():
        return forest
    scores = forest.score(x)
    clean = np.sort(scores[good])
    least = float(clean[int(np.ceil((1 - GOOD_REJECTED) * len(clean))) - 1])
    above = scores[~good & (scores > least)]
    return replace(forest, threshold=(least + float(above.min())) / 2 if len(above) else least)


def fit(documents: DataFrame, labels: DataFrame) -> Forest:
    """From all labelled rows: the trees hold good rows alone, so what is unlike
    them is isolated early; both classes set the threshold."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("good"))
    # statistics come before the join, so that no text is dealt out
    stats = _stats(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), [])
    passed = stats.where("NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)").select("doc_id", "features")
    rows = written(passed.join(known, "doc_id").select("doc_id", "good", "features"), "labelled")
    each = [F.col("features")[i] for i in range(len(FEATURES))]
    total = rows.agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.array(*map(F.min, each)).alias("low"), F.array(*map(F.max, each)).alias("high")).first()
    if not total.good:
        return grow(np.zeros((0, len(FEATURES))), *np.zeros((2, len(FEATURES))))
    good = rows.where("good")
    drawn = good if total.good <= DRAWN_ROWS else hashed_sample(good, "doc_id", DRAWN_ROWS, total.good)
    x = np.array(sorted(r.features for r in drawn.select("features").collect()))
    forest = grow(x, np.array(total.low), np.array(total.high))
    forest = weighed(forest, _masses(good, forest), total.good)
    return forest if total.good == total.n else _calibrated(rows, forest, total.good)


def weighed(forest: Forest, masses: np.ndarray, rows: int) -> Forest:
    """With paths from the numbers of all good rows in each leaf, brought to the
    scale of a tree's sample."""
    size = min(SAMPLE, max(2, rows))
    depth = np.zeros(len(forest.feature))
    for at in np.flatnonzero(forest.feature >= 0):  # children follow their parents
        depth[forest.child[at]] = depth[forest.child[at] + 1] = depth[at] + 1
    share = masses * size / rows
    below = np.interp(share, np.arange(size + 1), [_expected(n) for n in range(size + 1)])
    return replace(forest, path=np.where(forest.feature < 0, depth + below, 0.0))


def _masses(good: DataFrame, forest: Forest) -> np.ndarray:
    """How many of the rows come to each leaf: one pass, a sum a task."""
    size = len(forest.feature)

    def run(batches):
        found = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows and len(forest.roots):
                found += np.bincount(forest.leaves(np.array(batch["features"].to_pylist())).ravel(), minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], ["leaf", "n"])

    bound_batches(good.sparkSession)
    masses = np.zeros(size)
    for r in good.select("features").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        masses[r.leaf] = r.n
    return masses


def _calibrated(rows: DataFrame, forest: Forest, n_good: int) -> Forest:
    """`calibrated` with the scores of all rows, which stay in a table: an order
    statistic of the good ones is found by counting, the bad ones have a minimum."""

    def make():
        return lambda batch: {"good": batch["good"], "score": forest.score(np.array(batch["features"].to_pylist())).tolist()}

    scores = written(by_batch(rows.select("good", "features"), make, "good boolean, score double"), "scores")
    least = ranked(scores.where("good"), int(np.ceil((1 - GOOD_REJECTED) * n_good)) - 1)
    above = scores.where(~F.col("good") & (F.col("score") > least)).agg(F.min("score")).first()[0]
    return replace(forest, threshold=least if above is None else (least + above) / 2)


def ranked(scores: DataFrame, place: int) -> float:
    """The score at a place (from 0) of all in order: what holds it is narrowed by
    counts of 1000 equal ranges, until the driver can sort the rest."""
    part = scores.select("score")
    while True:
        n, low, high = part.agg(F.count("*"), F.min("score"), F.max("score")).first()
        if low == high:
            return float(low)
        if n <= HELD_SCORES:
            return float(sorted(r.score for r in part.collect())[place])
        at = F.least(F.floor((F.col("score") - low) / ((high - low) / 1000)), F.lit(999))
        for r in part.groupBy(at.alias("at")).count().orderBy("at").collect():
            if place < r["count"]:
                part = part.where(at == r["at"])
                break
            place -= r["count"]


def _stats(df: DataFrame, keep: list[str]) -> DataFrame:
    def make():
        def step(batch):
            found = [statistics(t) for t in batch["text"].to_pylist()]
            cols = dict(zip([c.split()[0] for c in STATS.split(", ")], zip(*(a for a, _ in found)), strict=True))
            return cols | {"doc_id": batch["doc_id"], "features": [list(map(float, b)) for _, b in found]} | {k: batch[k] for k in keep}

        return step

    extra = "".join(f", {k} {df.schema[k].dataType.simpleString()}" for k in keep)
    return by_batch(df.select("doc_id", "text", *keep), make, f"doc_id long{extra}, {STATS}, features array<double>")


def judge(documents: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, STATS, base_failed, anomaly (the forest's score), kept."""

    def make():
        def step(batch):
            found = [statistics(t) for t in batch["text"].to_pylist()]
            cols = dict(zip([c.split()[0] for c in STATS.split(", ")], zip(*(a for a, _ in found)), strict=True))
            score = forest.score(np.array([b for _, b in found]))
            failed = [base_failed(a[0], a[4]) for a, _ in found]
            return cols | {
                "doc_id": batch["doc_id"],
                "base_failed": failed,
                "anomaly": score.tolist(),
                "kept": [bool(not f and s <= forest.threshold) for f, s in zip(failed, score, strict=True)],
            }

        return step

    assert BATCH_ROWS * len(forest.roots) < 10_000_000  # paths of a batch
    return by_batch(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        f"doc_id long, {STATS}, base_failed boolean, anomaly double, kept boolean",
    )


def filter_documents(documents: DataFrame, forest: Forest) -> DataFrame:
    """The rows that `judge` keeps, with all their columns."""

    def run(batches):
        claim(__name__)
        for batch in batches:
            found = [statistics(t) for t in batch["text"].to_pylist()]
            if not found:
                continue
            score = forest.score(np.array([b for _, b in found]))
            yield batch.filter(pa.array([bool(not base_failed(a[0], a[4]) and s <= forest.threshold) for (a, _), s in zip(found, score, strict=True)]))

    bound_batches(documents.sparkSession)
    return documents.mapInArrow(run, documents.schema)

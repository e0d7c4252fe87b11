"""Near duplicates: bottom-k sketches from one hash function.

Words are lower-cased (A-Z) and split at white space; a document's set holds its
distinct shingles; shorter texts are one shingle; texts without words have an
empty set and are linked with nothing. Two documents are linked if
100 * intersection >= 80 * union of their full sets.

1. Texts with the same words are one class; only its least doc_id goes on, as a
   node of its own: a doc_id with several texts has several nodes.
2. A sketch is the K least hashes of a set. Inverted lists of the retained
   values give overlaps. Linked sets retain at least NEEDED of the same values
   (at a similarity of 0.8 fewer about once in 10**8; sets of up to 51 shingles
   are retained whole and the bound is exact), so two such sketches share one of
   the K - NEEDED + 1 values that the fewest sketches retain. A document emits
   only those, less the ones no other sketch retains: a document that merely
   quotes a common passage has many values of its own and emits nothing.
3. A short list gives its pairs. A list longer than LIST gives a star around its
   most central member (the one with most widely retained values).
4. The union sketch estimates each pair's similarity; clear misses go. Exact
   Jaccard on the full sets verifies the rest, and stars around verified pairs
   make components.
5. Long lists may hold links that no star found. Members outside the largest
   component of their group of overlapping long lists are compared with the
   whole group on full sets, in blocks of at most BLOCK shingles; a task returns
   only links that join components. Members of the largest component need no
   comparison with each other. Nothing is capped.

Result: a row a document with the least doc_id that it is connected to.

Scale: texts are scanned once for sketches (at most K + 4 longs a document
move), and the texts of candidates a second time. Copies collapse in a partial
aggregate before anything is shuffled by text; joins to large classes are
salted; values that more than HOT sketches retain meet their counts in a
broadcast table of at most HOT_VALUES rows. All loops write their state to the shared folder.

Defined cases: null and empty texts have n_shingles 0 and stay; repeated rows
share a class; rows with the same doc_id and different texts are one document,
linked with all that any of its texts is linked with; a null doc_id is linked with
nothing, keeps its row, and has a null component; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_batch, cached_by, written
from .components import components

K, NEEDED = 64, 32
#: Shingles of sets that, with all their partners, are retained whole.
WHOLE = 51
#: Members of a list that gives all its pairs.
LIST = 48
#: Estimates below this are clear misses: NEEDED of K.
ESTIMATE = 0.5
#: A value's count is broadcast from HOT rows of it on, or from more where HOT_VALUES
#: values could have so many.
HOT, HOT_VALUES = 1000, 200_000
BLOCK = 500_000
#: Smaller groups give up to SPREAD blocks of at least PIECE shingles.
SPREAD, PIECE = 16, 50_000
SALTS = 16
#: Ids of candidate documents that are broadcast.
BROADCAST_IDS = 1_000_000
_KNOWN = 500_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Words(dict):
    """Hash of a word, computed once."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_WORDS = _Words()
cached_by(__name__, _WORDS.clear)


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The sorted distinct 63-bit hashes of the shingles."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    size = min(size, n)
    x = np.full(n - size + 1, size, np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for k in range(size):
        x += h[k : n - size + 1 + k] * _ODD[k]
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.unique(x >> np.uint64(1)).astype(np.int64)


def _words(text: str | None) -> list[bytes]:
    if len(_WORDS) > _KNOWN:
        _WORDS.clear()
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, key (a digest of the words), n (size of the set), sketch."""

    def make():
        def step(batch):
            key, n, sketch = [], [], []
            for text in batch["text"].to_pylist():
                words = _words(text)
                found = shingle_set(words, size)
                key.append(_digest(words))
                n.append(len(found))
                sketch.append(found[:K])
            return {"doc_id": batch["doc_id"], "key": key, "n": n, "sketch": sketch}

        return step

    return by_batch(_plain(documents), make, "doc_id long, key binary, n long, sketch array<long>")


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def full_sets(documents: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """doc_id (the node), s (the full set) of nodes(node, doc_id, key)."""
    few = nodes.count() <= BROADCAST_IDS
    ids = nodes.select("doc_id").distinct()

    def make():
        def step(batch):
            key, s = [], []
            for text in batch["text"].to_pylist():
                words = _words(text)
                key.append(_digest(words))
                s.append(shingle_set(words, size))
            return {"doc_id": batch["doc_id"], "key": key, "s": s}

        return step

    own = by_batch(_plain(documents).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), make, "doc_id long, key binary, s array<long>").dropDuplicates(["doc_id", "key"])
    # own is dealt by these columns already
    return own.join(nodes, ["doc_id", "key"]).select(F.col("node").alias("doc_id"), "s")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(of: str) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(SALTS)).cast("int")


def _with_counts(df: DataFrame, size: str, *more: Column) -> DataFrame:
    """df(v, ...) with the number of rows of each v (and what else is aggregated),
    of those with two or more. Rows of a hot v stay where they are: of all rows at
    most total / bound values have more than bound, so what is broadcast is bounded."""
    counts = written(df.groupBy("v").agg(F.count("*").alias(size), *more).where(F.col(size) > 1), "counts")
    total = counts.agg(F.sum(size)).first()[0] or 0
    bound = max(HOT, total // HOT_VALUES)
    tagged = df.join(F.broadcast(counts.where(F.col(size) > bound)), "v", "left")
    cold = tagged.where(F.col(size).isNull()).select(*df.columns).join(counts.where(F.col(size) <= bound), "v")
    return tagged.where(F.col(size).isNotNull()).unionByName(cold)


def inverted_lists(reps: DataFrame) -> DataFrame:
    """v, doc_id, n, central, size, and doc2 and n2, the list's most central member:
    the lists of two or more members."""
    values = reps.select("doc_id", "n", F.explode("sketch").alias("v"))
    ranked = _with_counts(values, "df").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("r"))
    kept = F.least(F.col("n"), F.lit(K))
    needed = F.when(F.col("n") <= WHOLE, F.ceil(F.col("n") * 0.8)).otherwise(NEEDED)
    # the prefix, less the values that no other sketch retains, which rank first
    emitted = (kept - needed + 1 - (kept - F.size("r"))).cast("int")
    central = F.size(F.filter("r", lambda x: x.df > LIST)) / kept
    each = ranked.where(emitted > 0).select("doc_id", "n", central.alias("central"), F.explode(F.slice("r", F.lit(1), emitted)).alias("x")).select("x.v", "doc_id", "n", "central")
    each = written(each, "emitted")
    most = F.min(F.struct((-F.col("central")).alias("c"), "doc_id", "n")).alias("p")
    lists = _with_counts(each, "size", most)
    return written(lists.select("v", "doc_id", "n", "central", "size", F.col("p.doc_id").alias("doc2"), F.col("p.n").alias("n2")), "lists")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def candidate_pairs(lists: DataFrame, reps: DataFrame) -> DataFrame:
    """a, b, exact: pairs that the union sketch doesn't rule out. exact: both
    sets are retained whole, and the sketches have decided."""
    short = lists.where(F.col("size") <= LIST)
    like = (F.least("n", "n2") * 5 >= F.greatest("n", "n2") * 4)
    own = short.select("v", "doc_id", "n").join(short.select("v", F.col("doc_id").alias("doc2"), F.col("n").alias("n2")), "v").where((F.col("doc_id") < F.col("doc2")) & like)
    stars = lists.where((F.col("size") > LIST) & (F.col("doc_id") != F.col("doc2")) & like)
    both = own.select(*_pair(F.col("doc_id"), F.col("doc2"))).unionByName(stars.select(*_pair(F.col("doc_id"), F.col("doc2")))).distinct()
    a = reps.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = reps.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    met = both.join(a, "a").join(b, "b")
    whole = (F.col("na") <= K) & (F.col("nb") <= K)
    union = F.array_sort(F.array_union("sa", "sb"))
    met = met.withColumn("u", F.when(whole, union).otherwise(F.slice(union, 1, K)))
    met = met.withColumn("shared", F.size(F.array_intersect(F.array_intersect("u", "sa"), F.col("sb"))))
    kept = F.when(whole, F.col("shared") * 100 >= F.size("u") * 80).otherwise(F.col("shared") >= F.size("u") * ESTIMATE)
    return met.where(kept).select("a", "b", whole.alias("exact"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("i") * 100 >= (F.size("sa") + F.size("sb") - F.col("i")) * 80).select("a", "b")


def joining_links(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """a, b: links between left and right that join components, on full sets."""
    right = right.rename(columns=lambda c: c.removesuffix("_right"))
    values = np.concatenate([*right["s"], np.zeros(0, np.int64)])
    sizes = right["s"].map(len).to_numpy(np.int64)
    owner = np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    ids, labels, out = right["doc_id"].tolist(), right["c"].tolist(), []
    for doc, label, s in zip(left["doc_id"], left["c"], left["s"], strict=True):
        s = np.asarray(s)
        lo, hi = np.searchsorted(values, s), np.searchsorted(values, s, "right")
        spans = hi - lo
        at = np.repeat(hi - np.cumsum(spans), spans) + np.arange(spans.sum())
        shared = np.bincount(owner[at], minlength=len(ids))
        for j in np.flatnonzero(shared * 100 >= (sizes + len(s) - shared) * 80):
            x, y = root(label), root(labels[j])
            if x != y:
                above[max(x, y)] = min(x, y)
                out.append((doc, ids[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def remaining_links(lists: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Links inside long lists that join different components of links."""
    long = lists.where(F.col("size") > LIST)
    groups = components(long.select(F.col("doc_id").alias("a"), F.col("doc2").alias("b")))
    own = components(links).withColumnRenamed("node", "doc_id")
    member = groups.withColumnRenamed("node", "doc_id").withColumnRenamed("root", "g").join(own, "doc_id", "left").select("doc_id", "g", F.coalesce("root", "doc_id").alias("c"))
    member = written(member.join(sets, "doc_id").withColumn("n", F.size("s")), "members")
    # of each group the largest component, and the blocks of all and of the others
    sizes = member.groupBy("g", "c").agg(F.count("*").alias("k"), F.sum("n").alias("w")).groupBy("g").agg(F.max(F.struct("k", "c", "w")).alias("m"), F.sum("w").alias("w"))
    blocks = lambda w: F.greatest(F.ceil(w / BLOCK), F.least(F.lit(SPREAD), F.ceil(w / PIECE))).cast("int")
    about = written(sizes.select("g", F.col("m.c").alias("main"), blocks(F.col("w")).alias("all"), blocks(F.col("w") - F.col("m.w")).alias("left")).where("left > 0"), "groups")
    # a group's rows stay where they are: what is known of it comes to them
    member = member.join(F.broadcast(about) if about.count() <= BROADCAST_IDS else about, "g")
    rest = F.col("c") != F.col("main")
    member = member.select("g", "doc_id", "c", "s", "main", "all", "left", F.pmod(F.xxhash64("doc_id"), "all").cast("int").alias("j"), F.pmod(F.xxhash64("doc_id"), "left").cast("int").alias("i"))
    left = member.where(rest).select("g", "i", F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"), "doc_id", "c", "s")
    right = member.select("g", F.explode(F.sequence(F.lit(0), F.col("left") - 1)).alias("i"), "j", "doc_id", "c", "s")
    right = right.select(*[F.col(c).alias(f"{c}_right") for c in right.columns])
    return left.groupBy("g", "i", "j").cogroup(right.groupBy("g_right", "i_right", "j_right")).applyInPandas(joining_links, "a long, b long")


def link(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for shingles of size words."""
    every = written(sketches(documents, size), "sketches")
    some = every.where("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    many = written(classes.where("copies > 1").select("key", "rep"), "classes")
    reps = some.withColumn("salt", _salt("doc_id")).join(_salted(many), ["key", "salt"], "left")
    reps = reps.where("rep IS NULL OR rep = doc_id").select("key", "doc_id", "n", "sketch").dropDuplicates(["key", "doc_id"])
    reps = written(reps.withColumn("node", F.monotonically_increasing_id()), "representatives")
    nodes = reps.select(F.col("node").alias("doc_id"), "n", "sketch")

    lists = inverted_lists(nodes)
    pairs = written(candidate_pairs(lists, nodes), "pairs")
    long = lists.where(F.col("size") > LIST)
    unsure = pairs.where("NOT exact")
    ids = unsure.select(F.explode(F.array("a", "b")).alias("node")).unionByName(long.select(F.col("doc_id").alias("node"))).distinct()
    sets = written(full_sets(documents, written(reps.select("node", "doc_id", "key").join(ids, "node"), "candidates"), size), "sets")
    links = written(pairs.where("exact").select("a", "b").unionByName(verified(unsure, sets)), "links")
    if not long.isEmpty():
        links = written(links.unionByName(remaining_links(lists, sets, links)), "links")

    of = reps.select(F.col("node").alias("a"), F.col("doc_id").alias("x"))
    links = links.join(of, "a").join(of.select(F.col("a").alias("b"), F.col("x").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    # a document of several texts joins their classes
    several = written(some.groupBy("doc_id").agg(F.min(F.xxhash64("key")).alias("low"), F.max(F.xxhash64("key")).alias("high")).where("low < high").select("doc_id"), "several")
    if not several.isEmpty():
        links = links.unionByName(some.select("doc_id", "key").join(several, "doc_id", "left_semi").join(many, "key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))

    # what a key's documents are connected to, where that isn't a document itself
    roots = components(links)
    of_rep = reps.select("key", "doc_id").join(roots, F.col("doc_id") == F.col("node")).select("key", "root")
    moved = many.join(of_rep, "key", "full").select("key", F.coalesce("root", "rep").alias("root"))
    moved = moved.groupBy("key").agg(F.min("root").alias("root"))
    out = every.select("doc_id", "key", F.col("n").alias("n_shingles")).withColumn("salt", _salt("doc_id")).join(_salted(moved), ["key", "salt"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(documents: DataFrame, size: int = 5) -> DataFrame:
    """The documents that `link` keeps, with all their columns. Repeated rows of
    a kept doc_id are that document and stay."""
    gone = link(documents, size).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return documents.join(gone, documents["doc_id"].cast("long") == gone["gone_id"], "left_anti")

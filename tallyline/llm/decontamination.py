"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks.

Native: DataFrame and SQL functions only.

Texts are lower-cased (A-Z) and split into words at white space; shingles are
SHINGLE words. A window of a document has as many shingles as an item. Moving a
window's start to the right past a shingle that the item lacks never lowers their
similarity, so windows start at shingles that an item of their size holds (hits).
A window is skipped if the one that starts a shingle earlier is at least as
similar to every item of that size: it starts at a hit, too, and the shingle that
it lacks at its end is one of no item of that size.

A window and an item get 64-bit SimHashes of their shingles, each counted as
often as it occurs. BLOCKS blocks of the fingerprints are compared: by the
pigeonhole principle, two fingerprints within RADIUS bits differ by at most
RADIUS // BLOCKS in one block, and all block values so near to an item's are in
the index. What the index finds within RADIUS is verified by the exact weighted
similarity: the sum of the smaller counts over the sum of the larger ones.

RADIUS: at a similarity of 0.8 each bit differs with probability 0.15, so more
than 23 of 64 bits differ about once in 100,000 such windows, and less often
the more similar they are. So wide a radius makes each block a weak filter (37 of
256 values); the Hamming distance, compared before any array is touched, leaves
about 2 % of unlike pairs of one size.

Scale: hits are narrow rows (document, window size, place), met by a join of
exploded shingles with the benchmark's, and reduced to window starts by one
aggregate; only documents with a start are read again, for their windows. Of the
benchmark's tables, those with at most BROADCAST_ROWS rows (and items of at most
BROADCAST_WORDS words together) are broadcast; larger ones are salted and joined by shuffle, so a
shingle that a third of the documents share meets SALTS tasks. Windows are
pre-aggregated to the best one of a document and item.

Defined cases: null and empty texts match nothing, nor do documents or items
of fewer than SHINGLE words; equal items are each reported; rows with the same
doc_id (null is one, too) report the best of all in `find`, and are judged each
by their own text in `clean`; other columns are ignored; empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import written

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 23, 8
#: Rows of at most 50 bytes of a table that is broadcast, and words (8 bytes each)
#: of the items that are.
BROADCAST_ROWS = 2_000_000
BROADCAST_WORDS = 8_000_000
SALTS = 16
#: Places of a text that are handled together.
PART = 2048
#: Window starts that are broadcast, with the id of their document.
BROADCAST_STARTS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.split(F.btrim(lowered, F.lit(SPACES)), r"[\x20\x09-\x0D]+")


def _shingles(text: Column) -> Column:
    """Hashes of the text's shingles in order; empty for fewer words."""
    five = [F.lit(k) for k in range(SHINGLE)]

    def of(w: Column) -> Column:  # a lambda's variable: the words are split once
        last = F.size(w) - SHINGLE
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in five]))
        return F.when(last >= 0, each).otherwise(F.expr("cast(array() AS array<bigint>)"))

    return F.get(F.transform(F.array(_words(text)), of), F.lit(0))


def simhash(s: Column) -> Column:
    """Bit b is set where more than half of the hashes have it. For each half
    byte, the counts of its four bits lie in four 16-bit lanes of a long, and a
    table spreads the half byte over the lanes; of 32,768 hashes or more, for each
    two bits in two 31-bit lanes."""
    found = F.get(F.transform(F.array(s), lambda v: F.when(F.size(v) < 1 << 15, _simhash(v, 4, 16)).otherwise(_simhash(v, 2, 31))), F.lit(0))
    return F.coalesce(found, F.lit(0).cast("long"))  # never null: else the optimizer asks twice


def _simhash(s: Column, bits: int, lane: int) -> Column:
    """`bits` bits at a time, counted in lanes of `lane` bits."""
    spread = F.array(*[F.lit(sum(1 << lane * k for k in range(bits) if n >> k & 1)).cast("long") for n in range(1 << bits)])
    half = F.size(s) / 2

    def part(place: Column) -> Column:
        def add(lanes: Column, h: Column) -> Column:
            return lanes + F.get(spread, F.call_function("shiftrightunsigned", h, place).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))

        def majority(lanes: Column) -> Column:
            out = F.lit(0)
            for k in range(bits):
                out = out + F.when(F.shiftrightunsigned(lanes, lane * k).bitwiseAND(F.lit((1 << lane) - 1)) > half, 1 << k).otherwise(0)
            return F.call_function("shiftleft", out.cast("long"), place)

        return F.aggregate(s, F.lit(0).cast("long"), add, majority)

    places = F.array(*map(F.lit, range(0, 64, bits)))
    return F.aggregate(F.transform(places, part), F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))


def _block(h: str, i: int | str) -> Column:
    return F.expr(f"coalesce(cast(shiftrightunsigned({h}, {64 // BLOCKS} * {i}) & {(1 << 64 // BLOCKS) - 1} AS int), 0)")


def _around(block: Column) -> Column:
    """All values within RADIUS // BLOCKS bits of a block's."""
    near = [x for x in range(1 << 64 // BLOCKS) if x.bit_count() <= RADIUS // BLOCKS]
    return F.transform(F.array(*map(F.lit, near)), lambda x: block.bitwiseXOR(x))


def similarity(a: Column, b: Column) -> Column:
    """Sum of smaller counts over sum of larger counts, of two arrays."""
    count = lambda x, v: F.size(F.filter(x, lambda y: y == v))
    both = F.array_intersect(a, b)
    repeated = (F.size(F.array_distinct(a)) < F.size(a)) & (F.size(F.array_distinct(b)) < F.size(b))
    common = F.when(repeated, F.aggregate(both, F.lit(0), lambda n, v: n + F.least(count(a, v), count(b, v)))).otherwise(F.size(both))
    return common.cast("double") / (F.size(a) + F.size(b) - common)


def _texts(documents: DataFrame) -> DataFrame:
    """doc_id, key (a hash that tells the texts of a doc_id apart) and text."""
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0).cast("long")).alias("key"), text.alias("text"))


def _joined(rows: DataFrame, held: DataFrame, on: list[str], small: bool) -> DataFrame:
    """rows with what a benchmark's table holds under `on`."""
    if small:
        return rows.join(F.broadcast(held), on)
    salt = F.pmod(F.xxhash64("doc_id", "key"), F.lit(SALTS)).cast("int")
    held = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(held, [*on, "salt"]).drop("salt")


def _starts(texts: DataFrame, items: DataFrame, small: bool) -> DataFrame:
    """doc_id, key, m, at: the hits whose windows are compared."""
    known = items.select("m", F.explode("item").alias("shingle")).groupBy("shingle").agg(F.collect_set("m").alias("sizes"))
    each = texts.select("doc_id", "key", F.posexplode_outer(_shingles(F.col("text"))).alias("at", "shingle"))
    hits = _joined(each, known, ["shingle"], small).select("doc_id", "key", F.explode("sizes").alias("m"), "at")
    # what a hit says of three starts: of its own; that the one a shingle later
    # may be skipped; that the one whose window ends with it may not
    says = [F.struct(at.cast("int").alias("at"), F.lit(n).alias("says")) for at, n in ((F.col("at"), 1), (F.col("at") + 1, 2), (F.col("at") - F.col("m") + 1, 4))]
    said = hits.select("doc_id", "key", "m", F.explode(F.array(*says)).alias("x")).groupBy("doc_id", "key", "m", F.col("x.at").alias("at")).agg(F.bit_or("x.says").alias("says"))
    return said.where("says in (1, 5, 7)").select("doc_id", "key", "m", "at")


def _windows(texts: DataFrame, starts: DataFrame) -> DataFrame:
    """doc_id, key, m, start, room (how much later a window may start), h, and
    ahead: the window's shingles and as many after them. Texts are cut into parts of
    PART starts, so that no row holds a long text beside each of its windows."""
    few = starts.count() <= BROADCAST_STARTS
    parts = starts.groupBy("doc_id", "key", F.floor(F.col("at") / PART).cast("int").alias("part")).agg(F.collect_list(F.struct("m", "at")).alias("of"), F.max("m").alias("most"))
    own = parts.groupBy("doc_id", "key").agg(F.collect_list(F.struct("part", "of", "most")).alias("parts")).withColumnsRenamed({"doc_id": "own_id", "key": "own_key"})
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    met = texts.join(F.broadcast(own) if few else own, same)

    def cut(s: Column) -> Column:
        def part(x: Column) -> Column:
            low = F.greatest(F.least(x.part * PART, F.size(s) - x.most), F.lit(0))
            return F.struct(x.of.alias("of"), low.alias("low"), F.size(s).alias("n"), F.slice(s, low + 1, 2 * x.most + PART).alias("s"))

        return F.transform("parts", part)

    each = met.select("doc_id", "key", F.explode(F.get(F.transform(F.array(_shingles(F.col("text"))), cut), F.lit(0))).alias("p"))
    each = each.select("doc_id", "key", "p.low", "p.n", "p.s", F.explode("p.of").alias("x")).select("doc_id", "key", "low", "n", "s", "x.m", "x.at")
    last = F.greatest(F.col("n") - F.col("m"), F.lit(0))
    first = F.least(F.col("at"), last)
    at = first - F.col("low") + 1
    return each.select("doc_id", "key", "m", first.alias("start"), (last - first).alias("room"), F.slice("s", at, 2 * F.col("m")).alias("ahead"), simhash(F.slice("s", at, F.col("m"))).alias("h"))


def _matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key, item_id, best (similarity, -start) of every text and item with
    a window of SIMILARITY or more."""
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _shingles(F.col("text")).alias("item"))
    items = written(own.where(F.size("item") > 0).select("item_id", "item", F.size("item").alias("m"), simhash(F.col("item")).alias("item_h")), "benchmark-items")
    values = sum(x.bit_count() <= RADIUS // BLOCKS for x in range(1 << 64 // BLOCKS)) * BLOCKS
    n, words = items.agg(F.count("*"), F.coalesce(F.sum("m"), F.lit(0))).first()
    texts = _texts(documents)
    starts = written(_starts(texts, items, words <= BROADCAST_ROWS), "starts")
    windows = _windows(texts, starts)

    numbers = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    probes = windows.select("*", numbers).withColumn("value", _block("h", "block"))
    index = items.select("item_id", "m", "item_h", numbers).select("*", F.explode(_around(_block("item_h", "block"))).alias("value"))
    found = _joined(probes, index, ["m", "block", "value"], n * values <= BROADCAST_ROWS).withColumn("apart", F.expr("h ^ item_h"))
    # a pair that several blocks find is kept at the first of them
    before = F.lit(False)
    for i in range(BLOCKS):
        before = before | ((F.col("block") > i) & (F.bit_count(_block("apart", i)) <= RADIUS // BLOCKS))
    found = found.where(~before & (F.bit_count("apart") <= RADIUS)).select("doc_id", "key", "item_id", "m", "start", "room", "ahead")
    # the window's start moves on to the item's first shingle in it
    met = _joined(found, items.select("item_id", "item"), ["item_id"], words <= BROADCAST_WORDS)
    shared = F.get(F.array_intersect(F.slice("ahead", 1, F.col("m")), F.col("item")), F.lit(0))
    met = met.withColumn("moved", F.least(F.greatest(F.coalesce(F.array_position("ahead", shared), F.lit(1)) - 1, F.lit(0)), F.col("room")).cast("int"))
    scored = met.select("doc_id", "key", "item_id", (F.col("start") + F.col("moved")).alias("start"), similarity(F.slice("ahead", F.col("moved") + 1, F.col("m")), F.col("item")).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("place"))).alias("best")
    return scored.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "key", "item_id").agg(best)


def find(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity (the best window's), start (its first word):
    a row for each document and item with a window of SIMILARITY or more."""
    best = _matches(documents, benchmark).groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.place")).cast("long").alias("start"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in whose text `find` finds no item, with all their columns."""
    hit = _matches(documents, benchmark).select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")).distinct()
    key = F.coalesce(F.xxhash64(documents["text"].cast("string")), F.lit(0).cast("long"))
    return documents.join(hit, documents["doc_id"].cast("long").eqNullSafe(hit["hit_id"]) & (key == hit["hit_key"]), "left_anti")

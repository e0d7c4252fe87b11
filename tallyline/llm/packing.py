"""Packing: first-fit decreasing over a tournament tree of bin capacities.

Documents become token ids and an end id, and are cut into pieces of at most
LENGTH. Pieces are dealt at random (by a hash of document and place) to groups
of about GROUP pieces. In each group, pieces are placed longest first into the
first sequence that still has room; a tournament tree, whose inner nodes hold
the largest room below them, finds it in log2(bins) steps.

Scale: tokenizing is one scan, whose pieces are written, numbered and counted.
What shuffles is a narrow row a piece (the ids stay behind as a checksum;
`with_ids` carries them). The number of groups follows that of pieces, and each
piece is dealt by its own number, so groups are independent and of bounded
expected size, whatever the length of one document or the number of equal rows.

Tokenizing: the vocabulary drops white space and never merges across it, so a
text's ids are the ids of its space-separated chunks in order. Chunks repeat;
each worker keeps a bounded table of those it has met and only gives new ones to
the tokenizer.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed each; a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import by_batch, cached_by, written

LENGTH, END_ID = 4096, 2
GROUP = 8192
#: Chunks that a worker remembers.
KNOWN = 2_000_000
#: A word, and marks other than an apostrophe: one or two words to the tokenizer.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+([!-&(-/:-@\\[-`{-~]+)?")


class Encoder:
    """Token ids of texts; chunks between spaces are encoded once.

    Their ids lie in one pool; known maps a chunk to its number. Chunks of plain
    words, the great majority, go to the tokenizer many at a time, and are told
    apart by the word ends in what it returns."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        suffix = model.get("end_of_word_suffix")
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.ends = np.zeros(size, bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.plain = PLAIN if suffix else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, new: list[str]) -> None:
        match = self.plain.fullmatch if self.plain else lambda chunk: None
        found = list(map(match, new))
        plain = [m[0] for m in found if m]
        words = [1 if m.end(1) < 0 else 2 for m in found if m]
        other = [c for c, m in zip(new, found, strict=True) if not m]
        parts, sizes = [], []
        joined = [" ".join(plain[i : i + 512]) for i in range(0, len(plain), 512)]
        for i, made in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False) if joined else ()):
            ids = np.array(made.ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(words[512 * i : 512 * (i + 1)]) - 1
            if len(stops) != last[-1] + 1:
                raise AssertionError("words and word ends differ")
            parts.append(ids)
            sizes.append(np.diff(stops[last], prepend=0))
        for made in self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else ():
            parts.append(np.array(made.ids, np.uint32))
            sizes.append(np.array([len(made.ids)]))
        self.known.update(zip(plain + other, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.pool = np.concatenate([self.pool, *parts])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, and END_ID after them."""
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > KNOWN:
            self.forget()
        new = set(chain.from_iterable(chunks)).difference(self.known)
        if new:
            self.learn(list(new))
        if not texts:
            return []
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(chunks)), np.int64)
        sizes = self.starts[number + 1] - self.starts[number]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[number] - (ends - sizes), sizes) + np.arange(ends[-1])]
        stops = ends[np.cumsum([len(c) for c in chunks]) - 1]
        return [np.append(x, np.uint32(END_ID)) for x in np.split(ids, stops[:-1])]


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, over all its tasks."""
    return Encoder(path)


cached_by(__name__, encoder.cache_clear)


def pieces(documents: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for."""

    def make():
        encode = encoder(tokenizer).encode

        def step(batch):
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for doc, ids in zip(batch["doc_id"].to_pylist(), encode([t or "" for t in batch["text"].to_pylist()]), strict=True):
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.astype("<u4").tobytes()))
                    out["doc_tokens"].append(len(ids))
                    out["ids"].append(piece.astype(np.int32) if with_ids else None)
            return out

        return step

    made = by_batch(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        make,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>",
    )
    return made if with_ids else made.drop("ids")


class Tournament:
    """Bins in a row; the leaves hold their room, inner nodes the larger of the
    two below."""

    def __init__(self, bins: int, room: int) -> None:
        self.width = 1 << max(0, bins - 1).bit_length()
        self.tree = [room] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """The first bin with room for size, and the offset there."""
        tree, at = self.tree, 1
        while at < self.width:
            at *= 2
            if tree[at] < size:
                at += 1
        left = tree[at]
        tree[at] = left - size
        node = at >> 1
        while node:
            best = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        return at - self.width, left


def first_fit_decreasing(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; equal lengths are taken in order."""
    tree = Tournament(len(lengths), room)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i], left = tree.place(lengths[i])
        offsets[i] = room - left
    return bins, offsets


def pack(pieces: DataFrame, n_pieces: int, length: int = LENGTH, group: int = GROUP, seed: int = 17) -> DataFrame:
    """The pieces, with sequence_id and offset. n_pieces sets the number of groups;
    a column piece, if there is one, tells equal rows apart and goes."""
    groups = max(1, -(-n_pieces // group))
    told = [c for c in ("doc_id", "start", "ids_crc32", "piece") if c in pieces.columns]
    place = F.pmod(F.xxhash64(F.lit(seed), *told), F.lit(groups))
    fields = [f for f in pieces.schema if f.name != "piece"]
    names = [f.name for f in fields]

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        bins, offsets = first_fit_decreasing(frame["length"].tolist(), length)
        return frame[names].assign(sequence_id=np.array(bins, np.int64) + (int(key[0]) << 32), offset=np.array(offsets, np.int64))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return pieces.withColumn("pack_group", place).drop("piece").groupBy("pack_group").applyInPandas(one, f"{schema}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset."""
    made = written(pieces(documents, tokenizer, length, with_ids).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    return pack(made, made.count(), length)


def padding(lengths: Iterator[int], length: int = LENGTH) -> int:
    """Pad ids of sequences that hold so many: none at a power of two."""
    return sum(0 if n & (n - 1) == 0 else length - n for n in lengths)

"""WARC archives: writing records, and reading them by boundary-chain verification.

Writing. A page becomes one record whose block is its payload. Of records with
equal payloads of REVISIT_BYTES or more, the one with the largest page_id is the
response and the others are revisits of it. Equal payloads are found on (id,
digest) rows alone; digests are pre-aggregated, and the join back is salted, so
a payload that a third of the pages share meets many tasks. Records are written
through Spark's own writer, to any store, in files by size class: a file holds at
most FILE bytes, or a single record that is longer.

Reading. An archive is cut into chunks. Each task emits the places in its chunk
where a record may start (the magic, followed by a header that parses) with the
offset where that record's successor must start, and follows such links inside
its chunk: every candidate gets its exit, the first link that leaves the chunk.
Pointer jumping over the exits, from offset 0 of every file, keeps the reachable
chunk entries in log2(chunks of a file) rounds; the candidates that lie on the
chain from a reachable entry are the records. Magic inside a payload is a
candidate, but no link from the file's start leads to it. Payloads are hashed by
a stream over the chunks in order: no payload is held whole. A header that is still
open where its chunk ends is carried into the next chunk, whatever its length.

Defined cases: null html is an empty payload; null urls are empty; line ends in
a url are percent-encoded; a null page_id is its own response; rows with the
same page_id and payload are alike; an empty table gives no rows. A chain that
ends before or beyond its file's end (a damaged archive) raises an error.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, dropped, new_folder, written

REVISIT_BYTES = 1000
CHUNK = 4 << 20
#: Bytes after a chunk that are read with it; longer headers are carried.
HEADER = 64 << 10
#: Bytes of a file, and of the records that share one, by class.
FILE, CLASSES = 128 << 20, (16 << 10, 256 << 10, 4 << 20, 64 << 20)
SALTS = 16
#: Rows of about 100 bytes that are broadcast.
BROADCAST_REVISITS = 500_000
#: Chunk entries (8 bytes each, and a path a file) that are broadcast.
BROADCAST_ENTRIES = 1_000_000
MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def records(pages: DataFrame) -> DataFrame:
    """page_id, bytes, digest, refers_to, record (text without its final END)."""
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    p = p.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    large = p.where((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    groups = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    again = large.withColumn("salt", salt).join(salted, ["digest", "salt"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    again = written(again, "warc-revisits")
    if again.count() <= BROADCAST_REVISITS:  # else the pages move to them
        again = F.broadcast(again)
    p = p.join(again, ["page_id", "digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(MAGIC.decode()),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Bytes: "), F.col("bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, "0").otherwise(F.col("bytes").cast("string")),
        F.lit(END.decode()),
    )
    return p.select("page_id", "bytes", "digest", "refers_to", F.when(revisit, head).otherwise(F.concat(head, "payload")).alias("record"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Archives under folder: plain concatenated records."""
    # a line end of a url becomes three bytes; the other fields are short
    length = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long")
    most = length("html") + 3 * length("url") + 1024
    longest, total = pages.agg(F.coalesce(F.max(most), F.lit(0)), F.coalesce(F.sum(most), F.lit(0))).first()
    # where all records fit one file, any file will do
    top = sum(longest > c for c in CLASSES) if total > FILE else 0
    out = records(pages).withColumn("size", F.octet_length("record").cast("long") + len(END))
    for i in range(top + 1):
        own = out.where(F.col("size") > (CLASSES[i - 1] if i else 0))
        if i < top:
            own = own.where(F.col("size") <= CLASSES[i])
        records_a_file = 0 if total <= FILE else FILE // CLASSES[i] if i < len(CLASSES) else 1
        own.select(F.col("record").alias("value")).write.mode("append").option("lineSep", END.decode()).option("maxRecordsPerFile", records_a_file).text(folder)


def parse_lines(raw: bytes, at: int, stop: int) -> tuple[int, dict[str, tuple[int, str]]]:
    """Of the lines from at to the END at stop: where the last one starts that is
    no field (-1: none), and by name the last field with its place."""
    bad, fields = -1, {}
    while at <= stop:
        end = raw.find(b"\r\n", at, stop + 2)
        name, colon, value = raw[at:end].partition(b":")
        if colon and re.fullmatch(rb"[A-Za-z0-9-]+", name):
            fields[name.decode().lower()] = at, value.strip().decode("utf-8", "replace")
        else:
            bad = at
        at = end + 2
    return bad, fields


def parse_header(bad: int, lines: dict[str, tuple[int, str]], at: int, stop: int) -> dict[str, str] | None:
    """The fields of a header whose lines start at `at`; None if it isn't one."""
    if not bad < at <= stop:
        return None
    fields = {k: v for k, (place, v) in lines.items() if place >= at}
    return fields if re.fullmatch(r"[0-9]{1,15}", fields.get("content-length", "")) and fields.get("warc-type") else None


class _Headers:
    """Takes the chunks of a file in order; holds what an open header began with."""

    def __init__(self) -> None:
        self.path: str | None = None
        self.held = b""

    def boundaries(self, path: str, chunk: bytes, base: int) -> list[tuple[int, int, int, int, dict]]:
        """(start, payload start, successor, exit, fields) of every candidate whose
        magic starts in this chunk or in what is held, and whose header ends."""
        if path != self.path:
            self.path, self.held = path, b""
        searched, end = max(0, len(self.held) - len(END)), base + CHUNK
        chunk, base = self.held + chunk, base - len(self.held)
        found, self.held, stop = [], b"", -1
        at = chunk.find(MAGIC)
        while 0 <= at < end - base:
            if stop < at:
                stop = chunk.find(END, max(at, searched))
                if stop < 0:  # nor does any later header end
                    self.held = chunk[at : end - base]
                    break
                bad, lines = parse_lines(chunk, at + len(MAGIC), stop)
            fields = parse_header(bad, lines, at + len(MAGIC), stop)
            if fields:
                body = base + stop + len(END)
                found.append((base + at, body, body + int(fields["content-length"]) + len(END), fields))
            at = chunk.find(MAGIC, at + 1)
        leads: dict[int, int] = {}
        for start, _, successor, _ in reversed(found):
            leads[start] = leads.get(successor, successor) if successor < end else successor
        return [(s, b, n, leads[s], f) for s, b, n, f in found]


def boundaries(chunk: bytes, base: int) -> list[tuple[int, int, int, int, dict]]:
    """The candidates of a chunk alone. base: the chunk's offset in its file."""
    return _Headers().boundaries("", chunk, base)


_CANDIDATE = "path string, size long, start long, exit long"


def chunks(spark, folder: str, beside: DataFrame | None = None) -> DataFrame:
    """path, size, base, content: CHUNK bytes from base on, and HEADER more;
    and the columns of beside, a table by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", F.col("length").alias("size"), "content")
    if beside is not None:
        files = files.join(beside, "path", "left")
    cut = files.select("*", F.explode(F.expr(f"sequence(0L, size, {CHUNK}L)")).alias("base")).where("base < size")
    return cut.withColumn("content", F.expr(f"substring(content, cast(base + 1 as int), {CHUNK + HEADER})"))


def candidates(spark, folder: str) -> DataFrame:
    """_CANDIDATE of every place where a record may start."""
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _CANDIDATE.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headers = _Headers()  # a file's chunks follow each other in its task
        for batch in batches:
            for row in zip(*(batch[c] for c in ("path", "size", "base", "content")), strict=True):
                path, size, base, content = (x.as_py() for x in row)
                rows = [{"path": path, "size": size, "start": s, "exit": x} for s, _, _, x, _ in headers.boundaries(path, content, base)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return written(chunks(spark, folder).mapInArrow(run, _CANDIDATE), "warc-candidates")


def reachable(found: DataFrame) -> DataFrame:
    """Pointer jumping: (path, start) of the chunk entries that offset 0 leads
    to. Before round k, the first 2**k entries of each file are known and every
    jump spans 2**k of them."""
    jump = found.select("path", "start", "exit")
    known = jump.where("start = 0").select("path", "start")
    # an exit leaves its chunk, or leads to a header of it that ends in a later one
    within = F.col("exit") < (F.floor(F.col("start") / CHUNK) + 1) * CHUNK
    most, again = found.agg(F.max(F.ceil(F.col("size") / CHUNK)), F.max(within)).first()
    most = (most or 0) * (2 if again else 1)
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        beyond = known.join(jump, ["path", "start"]).select("path", F.col("exit").alias("start"))
        known, old = written(known.unionByName(beyond).distinct(), "warc-known"), known
        there = jump.select("path", F.col("start").alias("exit"), F.col("exit").alias("beyond"))
        jump, last = written(jump.join(there, ["path", "exit"], "left").select("path", "start", F.coalesce("beyond", "exit").alias("exit")), "warc-jump"), jump
        dropped(old)
        dropped(last)
    return known


_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record on the chain; digests are those of the payloads as read, for revisits
    the header's."""
    entries = reachable(candidates(spark, folder))
    few = entries.count() <= BROADCAST_ENTRIES
    entries = entries.groupBy("path").agg(F.collect_list("start").alias("entries"))
    # a file's chunks follow each other in its task; where they are joined by
    # shuffle they are sorted again
    joined = chunks(spark, folder, F.broadcast(entries) if few else entries)
    if not few:
        joined = joined.repartition("path").sortWithinPartitions("path", "base")
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _RECORD.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream()
        for batch in batches:
            for row in zip(*(batch[c] for c in ("path", "size", "base", "content", "entries")), strict=True):
                path, size, base, content, starts = (x.as_py() for x in row)
                done = stream.read(path, size, base, content, starts or [])
                if base + CHUNK >= size and stream.expected != size:
                    raise ValueError(f"{path}: the chain of records leads to {stream.expected}, the file ends at {size}")
                if done:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)

    return joined.mapInArrow(run, _RECORD)


class _Stream:
    """Takes the chunks of a file in order. On the chain is a candidate that is
    an entry, or the successor of the one before."""

    def __init__(self) -> None:
        self.path: str | None = None
        self.expected = -1
        self.headers = _Headers()
        self.open: list[dict] = []

    def read(self, path: str, size: int, base: int, content: bytes, entries: list[int]) -> list[dict]:
        if path != self.path:
            self.path, self.expected, self.open = path, -1, []
        known = set(entries)
        for start, body, successor, _, fields in self.headers.boundaries(path, content, base):
            if start == self.expected or start in known:
                self.expected = successor
                if successor <= size:
                    self.open.append({"body": body, "stop": successor - len(END), "fields": fields, "sha1": hashlib.sha1()})
        own, done, rest = content[:CHUNK], [], []
        for x in self.open:
            x["sha1"].update(own[max(0, x["body"] - base) : max(0, x["stop"] - base)])
            if x["stop"] <= base + len(own):
                done.append(_row(x))
            else:
                rest.append(x)
        self.open = rest
        return done


def _number(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(m[1]) if m else None


def _row(x: dict) -> dict:
    fields = x["fields"]
    response = fields["warc-type"] == "response"
    stated = fields.get("x-payload-bytes", "")
    return {
        "page_id": _number(fields.get("warc-record-id")),
        "payload_bytes": x["stop"] - x["body"] if response else int(stated) if stated.isdigit() else None,
        "payload_digest": x["sha1"].hexdigest() if response else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "record_type": fields["warc-type"],
        "refers_to": None if response else _number(fields.get("warc-refers-to")),
    }


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives to the shared folder and reads them back."""
    bound_batches(pages.sparkSession)
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)

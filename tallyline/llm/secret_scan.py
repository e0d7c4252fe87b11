"""Secret scan: corpus-wide ownership frequency of candidate hashes.

Each text is scanned once for candidates: the base kinds (assignments, access
keys, long hex runs), which are always reported, and wider generic ones (vendor
prefixes, signed web tokens, private key headers, mixed runs of high entropy).
Only a hash of each candidate's value leaves the scan. The hashes are counted
over distinct repositories and owners across the whole corpus: values that
EXAMPLE_OWNERS owners or EXAMPLE_REPOSITORIES repositories hold are copied
examples; other values that look random are live. The value of every live
candidate, base or generic, becomes an extra `live` span.

An owner is a row's source; where no column names a repository, each document is
one of its owner's.

Scale: the scan is one pass over the text; what shuffles are 8-byte hashes of
candidates. Counts are aggregated by (hash, owner, repository) first, so a hash
that a third of the rows hold is one row for each of its repositories, and the
counts of a hash are added up in two steps, by owner and then over owners. The
join back is salted by document: each hash is met by SALTS tasks.

Defined cases: null texts are empty; a null source is an owner of its own;
repeated rows are reported each; a document without candidates has counts 0, an
empty `spans`, and the digest of the empty string. `redact` masks a row by its own
text, whatever its doc_id, and ignores what its other columns are called.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import bound_batches, by_batch, claim, written

BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GENERIC = re.compile(
    r"(?:gh[pousr]_|github_pat_|glpat-|sk-|xox[abpr]-|AIza|ya29\.|npm_|hf_)[A-Za-z0-9_-]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
    r"|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
    r"|[A-Za-z0-9+/_=-]{24,}"
)
#: Bits a character that a run needs to look random.
ENTROPY = 3.0
#: From so many distinct owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: ... and from so many distinct repositories on.
EXAMPLE_REPOSITORIES = 20
SALTS = 16
#: Live hashes (8 bytes) that are broadcast.
BROADCAST_HASHES = 1_000_000


def entropy(value: str) -> float:
    """Bits a character of the value's own distribution."""
    counts = np.unique(np.frombuffer(value.encode("utf-32-le"), np.uint32), return_counts=True)[1] if value else np.ones(1)
    share = counts / counts.sum()
    return float(-(share * np.log2(share)).sum())


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, value) by start, then in the order of BASE."""
    found = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), "hex", m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], BASE.index(x[1])))


def _random_looking(value: str) -> bool:
    known = value[:6].startswith(("gh", "glpat-", "sk-", "xox", "AIza", "ya29.", "npm_", "hf_", "eyJ", "-----B"))
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return (known or mixed) and entropy(value) >= ENTROPY


def generic_spans(text: str, base: list[tuple[int, str, int, str]]) -> list[tuple[int, str, int, str]]:
    """Random-looking runs that no base span touches."""
    out, at = [], 0
    for m in GENERIC.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if not any(b[0] < m.end() and m.start() < b[2] for b in base[at : at + 4]) and _random_looking(m[0]):
            out.append((m.start(), "generic", m.end(), m[0]))
    return out


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _key(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text.cast("string")), F.lit(0).cast("long"))


def candidates(documents: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """One row a document: doc_id, key (a hash of the text), owner, repository,
    counts, base_sha256 and found, an array of (kind, start, stop, size of the value
    that ends there, hash, random) by start."""
    owner = F.coalesce((F.col("source") if owner is None else owner).cast("string"), F.lit(""))
    repository = F.coalesce((F.col("doc_id") if repository is None else repository).cast("string"), F.lit(""))

    def make():
        def step(batch):
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "found")}
            for text in batch["text"].to_pylist():
                base = base_spans(text or "")
                for k in BASE:
                    out[f"n_{k}"].append(sum(b[1] == k for b in base))
                joined = ",".join(f"{k}:{s}:{e}" for s, k, e, _ in base)
                out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                spans = base + generic_spans(text or "", base)
                out["found"].append([{"kind": k, "start": s, "stop": e, "size": len(v), "hash": _hash(v), "random": k == "generic" or _random_looking(v)} for s, k, e, v in spans])
            return out | {k: batch[k] for k in ("doc_id", "key", "owner", "repository")}

        return step

    return by_batch(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("text")).alias("key"), "text", owner.alias("owner"), repository.alias("repository")),
        make,
        "doc_id long, key long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string,"
        " found array<struct<kind:string,start:long,stop:long,size:long,hash:long,random:boolean>>",
    )


def ownership(found: DataFrame) -> DataFrame:
    """hash, repositories, owners, uses, example of every candidate of the corpus."""
    each = found.select("owner", "repository", F.explode("found.hash").alias("hash"))
    return (
        each.groupBy("hash", "owner", "repository")
        .agg(F.count("*").alias("uses"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
        .groupBy("hash")
        .agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.sum("uses").alias("uses"))
        .withColumn("example", (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES))
    )


_COUNTS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def scan(documents: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example
    and findings, an array of (start, kind, stop, owners, repositories, live)."""
    found = written(candidates(documents, owner, repository).withColumn("row", F.monotonically_increasing_id()), "secrets")
    kind = "array<struct<start:long,rank:int,kind:string,stop:long,size:long,owners:long,repositories:long,live:boolean>>"
    none = found.where("size(found) = 0").select(*_COUNTS, F.expr(f"cast(array() as {kind})").alias("findings"))
    some = found.where("size(found) > 0")
    counted = ownership(some).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    each = some.select("row", *_COUNTS, salt.alias("salt"), F.explode("found").alias("f")).select("row", *_COUNTS, "salt", "f.*")
    each = each.join(counted.hint("merge"), ["hash", "salt"])
    rank = F.array_position(F.array(*map(F.lit, (*BASE, "generic"))), F.col("kind")).cast("int")
    judged = F.struct("start", rank.alias("rank"), "kind", "stop", "size", "owners", "repositories", (F.col("random") & ~F.col("example")).alias("live"))
    merged = each.groupBy("row").agg(*[F.first(c).alias(c) for c in _COUNTS], F.array_sort(F.collect_list(judged)).alias("findings"))
    rows = merged.drop("row").unionByName(none)
    base = F.transform(F.filter("findings", lambda x: x.kind != "generic"), lambda x: F.struct(x.start.alias("start"), x["rank"].alias("rank"), x.kind.alias("kind"), x.stop.alias("stop")))
    live = F.transform(F.filter("findings", lambda x: x.live), lambda x: F.struct((x.stop - x["size"]).alias("start"), F.lit(len(BASE) + 1).alias("rank"), F.lit("live").alias("kind"), x.stop.alias("stop")))
    shown = F.array_sort(F.concat(base, F.array_distinct(live)))
    return rows.select(
        *_COUNTS,
        F.array_join(F.transform(shown, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.stop.cast("string"))), ",").alias("spans"),
        F.size(F.filter("findings", lambda x: x.live)).cast("long").alias("n_live"),
        F.size(F.filter("findings", lambda x: ~x.live)).cast("long").alias("n_example"),
        F.transform("findings", lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.stop.alias("stop"), x.owners.alias("owners"), x.repositories.alias("repositories"), x.live.alias("live"))).alias("findings"),
    )


#: What stands in place of a redacted secret.
MASK = "[secret]"


def mask(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """text with MASK in place of the spans; spans that touch become one."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for start, stop in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """The documents with their live secrets masked; n_chars, where there is
    such a column, follows the text.

    Texts are scanned again while they are rewritten, so that only the hashes of
    live values move: they are broadcast if there are at most BROADCAST_HASHES;
    beyond that, each text meets those of its own candidates."""
    spark = documents.sparkSession
    found = written(candidates(documents, owner, repository).select("doc_id", "key", "owner", "repository", "found"), "secrets").where("size(found) > 0")
    random = found.select(F.explode("found").alias("f")).where("f.random").select("f.hash").distinct()
    live = written(ownership(found).where("NOT example").select("hash").join(random, "hash", "left_semi"), "live")
    names, schema = documents.columns, documents.schema
    bound_batches(spark)
    if live.count() <= BROADCAST_HASHES:
        shared = spark.sparkContext.broadcast(frozenset(r.hash for r in live.collect()))

        def rewrite(batches):
            claim(__name__)
            for batch in batches:
                texts = [_redacted(t, shared.value) for t in batch["text"].to_pylist()]
                yield _replaced(batch, names, texts)

        return documents.mapInArrow(rewrite, schema)
    each = found.select("doc_id", "key", F.explode("found.hash").alias("hash")).distinct().join(live, "hash").groupBy("doc_id", "key").agg(F.collect_list("hash").alias("own"))
    own = next(x for x in map("own{}".format, range(len(names) + 1)) if x not in names)
    each = each.select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), F.col("own").alias(own))
    same = documents["doc_id"].cast("long").eqNullSafe(each["of_id"]) & (_key(documents["text"]) == each["of_key"])
    joined = documents.join(each, same, "left").select(*[documents[c] for c in names], each[own])

    def rewrite_joined(batches):
        claim(__name__)
        for batch in batches:
            hashes = batch[own].to_pylist()
            texts = [_redacted(t, set(h or ())) for t, h in zip(batch["text"].to_pylist(), hashes, strict=True)]
            yield _replaced(batch.select(names), names, texts)

    return joined.mapInArrow(rewrite_joined, schema)


def _redacted(text: str | None, live) -> str | None:
    if not text:
        return text
    base = base_spans(text)
    every = base + generic_spans(text, base)
    return mask(text, [(s, e) for s, k, e, v in every if _hash(v) in live and (k == "generic" or _random_looking(v))])


def _replaced(batch: pa.RecordBatch, names: list[str], texts: list[str | None]) -> pa.RecordBatch:
    columns = {n: batch[n] for n in names}
    columns["text"] = pa.array(texts, columns["text"].type)
    if "n_chars" in columns:
        old = columns["n_chars"].to_pylist()
        before = batch["text"].to_pylist()
        columns["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in zip(old, before, texts, strict=True)], columns["n_chars"].type)
    return pa.RecordBatch.from_arrays([columns[n] for n in names], names)

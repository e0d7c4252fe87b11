r"""Personal data: a skip-chain conditional random field with loopy messages.

The base kinds (email, ip, card, phone) are found by their patterns and always
reported. The field labels the tokens that could be personal data beyond them:
a text's candidate tokens (runs with an "@" or a spelt-out one, of DIGITS digits or
more, or of four short groups of digits) form a chain, each with the word before
it; tokens that are equal, or whose digits or groups of digits are, or end alike,
are joined by skip edges, however far apart. Labels are O and the base kinds. Sum-
product messages pass along chain and skip edges until they settle, so a token
that no pattern accepts takes the label of the same token elsewhere: a card
number under another grouping, a phone number without its country, an address
with hyphens, an email with "(at)".

The weights of token features and of edges (for each type and label) are learned
together, by pseudo-likelihood, from a bounded sample of texts with candidates
(ROWS, in hash order, TOKENS candidates each). Base spans label the candidates.
As no text says which other tokens are personal data, each sampled text is
followed by disguised repeats of some of its own candidates, with their labels
(O as well): what is learned is how far a repeat's label follows its original's.

Scale: one scan; only texts that hold a digit or an "@" reach the field, and
messages pass inside one text. Skip edges join each token to the one before
with the same key, so a token that occurs n times has n - 1 edges, not n
squared. The sample is drawn on ids alone; the texts of the chosen ids are read
after that.

Defined cases: null and empty texts have no spans, counts 0 and the digest of
the empty string; repeated rows are reported each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import by_batch, hashed_sample, written

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A run that may be personal data: digits with marks between, or around an "@".
_LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = re.compile(r"[A-Za-z0-9._%+-]{0,64}@[A-Za-z0-9.-]+|\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*")
#: Four short groups of digits.
GROUPS = re.compile(r"[0-9]{1,3}(?:[\x20.-]{1,3}[0-9]{1,3}){3}")
#: A spelt-out "@", and what may follow one.
AT = re.compile(r"\x20?(?:\(at\)|\[at\]|\{at\})\x20?|\x20at\x20", re.I)
DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,8}", re.I)
HINT = re.compile(r"@|[0-9]|[(\[{]at[)\]}]", re.I)
#: Texts that weights are learned from, at most, candidates of each, and the share
#: of them that is repeated in disguise.
ROWS, TOKENS, REPEATED = 2000, 400, 0.5
#: Rounds of messages, and what they settle to.
ROUNDS, SETTLED = 60, 1e-4
#: A label needs this probability, and the token so many digits, at least and at
#: most.
CERTAIN, DIGITS, MOST_DIGITS = 0.8, 7, 19
FEATURES = 2048
#: Types of edges, and the potentials of equal labels that learning starts from.
CHAIN, SAME, DIGITS_ALIKE, END_ALIKE = range(4)
PRIOR = (0.2, 6.0, 6.0, 6.0)


@dataclass(frozen=True)
class Field:
    """token: weight of (feature, label); edge: potential of (type, label) where
    both ends have the label."""

    token: np.ndarray
    edge: np.ndarray


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then in the order of KINDS."""
    found = []
    if "@" in text:
        found += [(m.start(), "email", m.end()) for m in _emails(text)]
    if "." in text:
        found += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), "card", m.end()))
    if "+" in text:
        found += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _emails(text: str):
    """The matches of EMAIL, found from each "@": searching from the left tries
    every start of a long run of local characters."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCALS:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _spelt(text: str):
    """Spans of emails with a spelt-out "@", found from that."""
    done = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > done and m.start() - start < 64 and text[start - 1] in _LOCALS:
            start -= 1
        after = DOMAIN.match(text, m.end()) if start < m.start() else None
        if after:
            yield start, after.end()
            done = after.end()


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, word before) of the candidates. A run of more digits than
    any kind has is taken part by part."""
    spans = []
    for m in TOKEN.finditer(text):
        parts = [m.span()]
        if "@" not in m[0] and len(_digits(m[0])) > MOST_DIGITS:
            parts = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"\S+", m[0])]
        for start, end in parts:
            token = text[start:end]
            if "@" in token or len(_digits(token)) >= DIGITS or GROUPS.fullmatch(token):
                spans.append((start, end))
    spelt = [*_spelt(text)] if "at" in text or "AT" in text or "At" in text else []
    if spelt:
        spans = sorted(spelt + [x for x in spans if not any(x[0] < e and s < x[1] for s, e in spelt)])
    out = []
    for start, end in spans:
        before = text[max(0, start - 24) : start].split()
        out.append((start, end, before[-1].lower() if before else ""))
    return out


def features(token: str, before: str) -> list[int]:
    """Numbers of a token's features: its shape, length, digits, marks, and the
    word before it."""
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", token))[:24]
    digits = _digits(token)
    said = [f"shape={shape}", f"digits={min(len(digits), 20)}", f"marks={''.join(sorted(set(re.sub('[A-Za-z0-9]', '', token))))}",
            f"luhn={len(digits) >= 14 and luhn(digits)}", f"at={'@' in token}", f"plus={token[:1] == '+'}", f"dots={min(token.count('.'), 4)}", f"before={before}", "bias"]
    return [int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "big") % FEATURES for s in said]


def _address(token: str) -> str:
    """An email's letters, with a spelt-out "@" and "." as they are meant."""
    token = re.sub(r"\x20?[(\[{]at[)\]}]\x20?|\x20at\x20", "@", token.lower())
    return re.sub(r"\x20?[(\[]dot[)\]]\x20?|\x20dot\x20|\x20?\.\x20?", ".", token).strip(".")


def keys(token: str) -> list[tuple[int, str]]:
    """(type of edge, key): tokens with a common key are alike. They are the same
    but for case and spelling, or have the same groups of digits, the same digits,
    or the same last seven digits."""
    digits = _digits(token)
    address = _address(token)
    if "@" in address:
        return [(SAME, address)]
    out = [(SAME, "=" + token.lower())]
    if GROUPS.fullmatch(token):
        out.append((DIGITS_ALIKE, ".".join(str(int(x)) for x in re.findall("[0-9]+", token))))
    if len(digits) >= DIGITS:
        out += [(DIGITS_ALIKE, "d" + digits), (END_ALIKE, "e" + digits[-7:])]
    return out


def edges(found: list[str]) -> list[tuple[int, int, int]]:
    """(i, j, type): the chain, and skips to the last token alike."""
    out = [(i - 1, i, CHAIN) for i in range(1, len(found))]
    last: dict[str, int] = {}
    for i, token in enumerate(found):
        met = set()
        for kind, k in keys(token):
            j = last.get(k)
            if j is not None and j not in met:
                met.add(j)
                out.append((j, i, kind))
            last[k] = i
    return out


def messages(unary: np.ndarray, links: list[tuple]) -> np.ndarray:
    """Marginals by loopy sum-product with damping. unary: log potentials; links:
    (i, j, potential of equal labels: one, or one a label)."""
    n, labels = unary.shape
    if not links:
        p = np.exp(unary - unary.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    source = np.array([x for i, j, _ in links for x in (i, j)])
    target = np.array([x for i, j, _ in links for x in (j, i)])
    weight = np.exp(np.repeat([w for *_, w in links], 2, 0).reshape(len(source), -1)) - 1
    back = np.arange(len(source)) ^ 1
    sent = np.zeros((len(source), labels))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, sent)
        rest = belief[source] - sent[back]
        p = np.exp(rest - rest.max(1, keepdims=True))
        new = np.log(p.sum(1, keepdims=True) + weight * p)
        new -= np.log(np.exp(new).sum(1, keepdims=True))
        moved = np.abs(new - sent).max()
        sent = 0.5 * sent + 0.5 * new
        if moved < SETTLED:
            break
    belief = unary.copy()
    np.add.at(belief, target, sent)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def disguised(token: str, label: int, rng: random.Random) -> str:
    """The token as a writer might repeat it so that no pattern accepts it."""
    kind = KINDS[label - 1] if label else ""
    if kind == "email":
        name, _, host = token.partition("@")
        return name + rng.choice(["(at)", " at ", " [at] "]) + host
    groups = re.findall("[0-9]+", token)
    if kind == "ip":
        return rng.choice(["-", " . ", " "]).join(groups)
    digits = "".join(groups)
    if kind == "phone" and len(digits) > 9 and rng.random() < 0.7:
        digits = digits[rng.choice([1, 2, 3]) :]  # without its country
    size, mark = rng.choice([3, 4, 5]), rng.choice([".", " ", "-", ""])
    return mark.join(digits[i : i + size] for i in range(0, len(digits), size))


def _touching(found: list[tuple], base: list[tuple[int, str, int]]):
    """For each (start, end, ...) of found, in order, the base spans that touch it."""
    at, near = 0, []
    for start, end, *_ in found:
        while at < len(base) and base[at][0] < end:
            near.append(base[at])
            at += 1
        near = [b for b in near if b[2] > start]
        yield near


def _labelled(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int, str, int]]:
    """(start, end, word before, label) of the candidates; label: 1 + the place
    in KINDS of a base span that covers most of the candidate, else 0."""
    found, out = tokens(text), []
    for (start, end, before), near in zip(found, _touching(found, base), strict=True):
        most = [kind for s, kind, e in near if min(e, end) - max(s, start) > (end - start) / 2]
        out.append((start, end, before, 1 + KINDS.index(most[0]) if most else 0))
    return out


def learn(rows: list[tuple[list[int], int]], near: np.ndarray | None = None, steps: int = 300, rate: float = 1.0, ridge: float = 1e-3) -> Field:
    """Token and edge weights together, by pseudo-likelihood: each token's label
    given its features and the labels of its neighbours. near[i, t, y]: how many of
    token i's neighbours by an edge of type t have label y. Edges start from PRIOR,
    and stay there for what no row shows."""
    labels = 1 + len(KINDS)
    w, start = np.zeros((FEATURES, labels)), np.repeat(np.array(PRIOR)[:, None], labels, 1)
    edge = start.copy()
    if not rows:
        return Field(w, edge)
    x = np.array([f for f, _ in rows])
    y = np.eye(labels)[[label for _, label in rows]]
    near = np.zeros((len(x), len(PRIOR), labels)) if near is None else near
    for _ in range(steps):
        z = w[x].sum(1) + (near * edge).sum(1)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = (y - p) / len(x)
        g = np.zeros_like(w)
        np.add.at(g, x, miss[:, None, :])
        w += rate * (g - ridge * w)
        edge += rate * ((near * miss[:, None, :]).sum(0) - ridge * (edge - start))
    return Field(w, edge)


def lesson(text: str, seed: int) -> tuple[list[dict], list[dict]]:
    """A text's candidates and disguised repeats of some: features and label of
    each token, and for each edge its type and the tokens it joins. Tokens that no
    pattern accepts but that are like one that is accepted teach nothing: whether
    they are personal data is what the field is to say."""
    rng = random.Random(seed)
    found = [(text[s:e], b, y) for s, e, b, y in _labelled(text, base_spans(text))[:TOKENS]]
    accepted = {k for t, _, y in found if y for k in keys(t)}
    found = [x for x in found if x[2] or accepted.isdisjoint(keys(x[0]))]
    again = [(disguised(t, y, rng), b if rng.random() < 0.5 else "", y) for t, b, y in found if rng.random() < REPEATED]
    again = [x for x in again if len(_digits(x[0])) >= DIGITS or GROUPS.fullmatch(x[0]) or x[2] == 1]
    found += again
    own = [{"f": features(t, b), "y": y} for t, b, y in found]
    return own, [{"i": i, "j": j, "t": t} for i, j, t in edges([t for t, *_ in found])]


def fit(documents: DataFrame) -> Field:
    """Weights from the base spans of at most ROWS texts."""

    def make():
        def step(batch):
            made = [lesson(text or "", 0 if doc is None else doc) for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)]
            return {"doc_id": batch["doc_id"], "t": [a for a, _ in made], "e": [b for _, b in made]}

        return step

    plain = _plain(documents)
    some = written(plain.where(F.col("text").rlike(r"@|[0-9][0-9 ().-]{6}")).select("doc_id").where("doc_id IS NOT NULL").distinct(), "pii-ids")
    chosen = hashed_sample(some, "doc_id", ROWS, some.count())
    sample = plain.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = by_batch(sample, make, "doc_id long, t array<struct<f:array<int>,y:int>>, e array<struct<i:int,j:int,t:int>>").collect()
    rows.sort(key=lambda r: r.doc_id)
    near = np.zeros((sum(len(r.t) for r in rows), len(PRIOR), 1 + len(KINDS)))
    at = 0
    for r in rows:
        for x in r.e:
            near[at + x.i, x.t, r.t[x.j].y] += 1
            near[at + x.j, x.t, r.t[x.i].y] += 1
        at += len(r.t)
    return learn([(x.f, x.y) for r in rows for x in r.t], near)


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def added_spans(text: str, base: list[tuple[int, str, int]], field: Field) -> list[tuple[int, str, int]]:
    """Candidates outside the base spans that the field labels."""
    found = _labelled(text, base)
    if all(label for *_, label in found):
        return []
    words = [text[s:e] for s, e, *_ in found]
    unary = np.array([field.token[features(t, b)].sum(0) for t, (_, _, b, _) in zip(words, found, strict=True)])
    for i, (*_, label) in enumerate(found):
        if label:  # what a pattern accepts is certain
            unary[i] = -8.0
            unary[i, label] = 8.0
    p = messages(unary, [(i, j, field.edge[t]) for i, j, t in edges(words)])
    out = []
    for (s, e, _, label), q, near in zip(found, p, _touching(found, base), strict=True):
        best = int(q.argmax())
        if not label and best and q[best] >= CERTAIN and not near:
            out.append((s, KINDS[best - 1], e))
    return out


def find(documents: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and
    n_found, the number of all spans."""

    def make():
        join = lambda x: ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(x, key=lambda x: (x[0], KINDS.index(x[1]))))

        def step(batch):
            out = {k: [] for k in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_found")}
            for text in batch["text"].to_pylist():
                base = base_spans(text or "")
                added = added_spans(text, base, field) if text and HINT.search(text) else []
                for k in KINDS:
                    out[f"n_{k}"].append(sum(b[1] == k for b in base))
                out["base_sha256"].append(hashlib.sha256(join(base).encode()).hexdigest())
                out["spans"].append(join(base + added))
                out["n_added"].append(len(added))
                out["n_found"].append(len(base) + len(added))
            return out | {"doc_id": batch["doc_id"]}

        return step

    return by_batch(_plain(documents), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_found long")

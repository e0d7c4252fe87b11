"""Toxicity: noisy-channel deobfuscation, then scoring of the restored text.

A writer's word went through a channel that swaps letters for look-alikes,
repeats them, and puts marks or spaces between them. `Decoder` undoes it: what
is unusual about a token spans a lattice of readings, and Viterbi's algorithm
finds the likeliest one under a character language model (ORDER symbols, counted
over all texts of the corpus). Where the lattice has a single reading (letters
without doubled ones, accents taken off, between marks that are no look-alikes),
that is the word. The letters as written stay evidence beside the restored word. A run of spaced
characters is one lattice, in which every white space ends a word or is dropped.

The classifier looks at restored words. Words and word beginnings that labelled
toxic documents hold far more often than clean ones are evidence, weighted by
their log odds; a logistic regression turns a document's evidence into a score.

Scale: one scan counts symbols; a task adds its counts to a table of fixed size
(SYMBOLS ** ORDER cells), which bounds what is shuffled, collected and sent to
the tasks, whatever the corpus. Labelled rows are a bounded sample (ROWS of each
class, in hash order); pieces are counted and compared in tables, and all that
pass are evidence. A last scan scores every whole text.

Defined cases: null and empty texts score as texts without evidence; without
labelled rows of both classes every score is 0; repeated rows are scored each;
other columns, labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bound_batches, by_batch, hashed_sample

#: Space, 26 letters, anything else.
SYMBOLS, ORDER, OTHER = 28, 4, 27
#: Labelled rows of a class that are learned from, at most.
ROWS = 4000
#: Toxic documents that must hold a piece of evidence, its least log odds ratio
#: and the least G statistic of its counts.
HELD_BY, RATIO, STATISTIC = 3, 2.0, 22.0
PREFIXES = (3, 4, 5, 6, 7)
THRESHOLD = 0.7
#: What the regression sees of a document (`Scorer.inputs`).
INPUTS = 4
#: Tokens that a task remembers.
KNOWN = 1_000_000

# Fixed values of the channel: look-alikes, and costs in nats.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "€": "e", "£": "l", "¡": "i",
}
SWAPPED, REPEATED, DROPPED, HIDDEN, KEPT, JOINED = 0.7, 0.7, 1.0, 4.0, 3.0, 0.1
MARKS = "*.-_~'`^,:;\"?!&%#=/\\()[]{}<>+|$@"

#: Letters between marks, and such tokens whose marks have no other reading.
LETTERS = re.compile(r"[^\w]*([^\W\d_]+)[^\w]*")
_SURE = rf"[^\w*{re.escape(''.join(LOOKS))}]*"
WRAPPED = re.compile(rf"{_SURE}([^\W\d_]+){_SURE}")
DOUBLED = re.compile(r"([^\W\d_])\1")
#: Distinct runs of marks at tokens' ends that a decoder remembers.
ENDINGS = 64
#: States from which on a hidden letter is looked for in all states at once.
MANY = 100
#: A short token: single characters with marks around and between them. A run of
#: three or more, with any white space, is one lattice; white space in it is an
#: arc that is dropped or kept as the end of a word.
SHORT = r"(?:_|[^\w\s]){0,3}(?:[^\W_](?:(?:_|[^\w\s]){1,2}[^\W_])*)?(?:_|[^\w\s]){0,3}(?!\S)"
RUN = re.compile(rf"(?<!\S)(?=\S){SHORT}(?:\s+(?=\S){SHORT}){{2,}}")
READ = re.compile(rf"[^\W_]|[{re.escape(''.join(LOOKS))}]")


def _symbol_table() -> np.ndarray:
    """Symbols of the code points below 0x250; accents are taken off."""
    table = np.full(0x251, OTHER, np.uint8)
    for c in range(0x250):
        base = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        table[c] = ord(base) - 96 if "a" <= base <= "z" else 0 if chr(c).isspace() else OTHER
    return table


_TABLE = _symbol_table()
_POWERS = SYMBOLS ** np.arange(ORDER)[::-1]


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(points, 0x250)].astype(np.int64)


def grams(text: str) -> np.ndarray:
    """Numbers of the text's runs of ORDER symbols; it starts after spaces."""
    s = np.concatenate([np.zeros(ORDER - 1, np.int64), symbols(text), np.zeros(1, np.int64)])
    n = len(s) - ORDER + 1
    return sum(s[k : k + n] * _POWERS[k] for k in range(ORDER))


def count_grams(documents: DataFrame) -> np.ndarray:
    """How often each run of ORDER symbols occurs in all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**ORDER, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                if text:
                    np.add.at(counts, grams(text), 1)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["gram", "n"])

    bound_batches(documents.sparkSession)
    rows = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**ORDER)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return counts


def language_model(counts: np.ndarray, prior: float = 20.0) -> np.ndarray:
    """Log probability of the last symbol of each run after those before it,
    every order smoothed by the one below."""
    shape = (SYMBOLS,) * ORDER
    c = counts.reshape(shape)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = c.sum(axis=tuple(range(ORDER - order))) if order < ORDER else c
        p = (n + prior * p) / (n.sum(-1, keepdims=True) + prior)
    return np.log(np.broadcast_to(p, shape)).astype(np.float32).ravel()


class Decoder:
    """Restored words of tokens."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.endings: dict[str, tuple[np.ndarray, list]] = {}
        states = np.arange(SYMBOLS ** (ORDER - 1))
        # a word that has ended needs no other end
        self.ends = np.where((states % SYMBOLS == 0) & (states > 0), 0, model[states * SYMBOLS]).astype(np.float32)

    def ending(self, marks: str) -> tuple[np.ndarray, list]:
        """Of every state, the value of the best reading of marks up to the
        token's end; and for each mark the symbol read there (0: none)."""
        if marks not in self.endings:
            if len(self.endings) >= ENDINGS:
                self.endings.clear()
            value, chosen, states = self.ends, [], np.arange(len(self.ends))
            for i in range(len(marks) - 1, -1, -1):
                c = marks[i]
                if chosen and c == marks[i + 1] and not any_read and i and marks[i - 1] == c:
                    # no state reads a letter here, so none does one mark before
                    value, chosen = value - REPEATED, [*chosen, chosen[-1]]
                    continue
                arcs = [*self._arcs(c)] + [("", REPEATED)] * (i > 0 and marks[i - 1] == c)
                found, read = np.full(len(states), -np.inf, np.float32), np.zeros(len(states), np.int8)
                for letter, cost in arcs:
                    n = ord(letter) - 96 if letter else 0
                    gram = states * SYMBOLS + n
                    v = self.model[gram] + value[gram % len(states)] - cost if n else value - cost
                    read = np.where(v > found, n, read).astype(np.int8)
                    found = np.maximum(v, found)
                any_read = bool(read.any())
                value = found
                chosen.append(read)
            self.endings[marks] = value, chosen[::-1]
        return self.endings[marks]

    def viterbi(self, token: str) -> str:
        """The likeliest reading; a state is the last ORDER - 1 symbols. Outputs
        are linked (last symbol, those before), so long tokens cost no copies."""
        best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        wrap, before = SYMBOLS ** (ORDER - 1), ""
        core = token
        if "*" in token:
            n = len(token)
            while n and not (token[n - 1].isalnum() or token[n - 1] in "_ "):
                n -= 1
            core = token[:n] if "*" in token[n:] else token
        rest, chosen = self.ending(token[len(core) :]) if core != token else (self.ends, [])
        for c in core:
            arcs = [*self._arcs(c)]
            if c == before:
                arcs.append(("", REPEATED))
            if c != " ":
                before = c
            if c == "*" and len(best) > MANY:
                best = self._hidden(best, arcs[-1][1])
                continue
            after = {}
            for state, (score, out) in best.items():
                for letter, cost in arcs if c != " " or state % SYMBOLS else (("", 0.0),):
                    if letter:
                        s = 0 if letter == " " else ord(letter) - 96 if letter.isascii() else OTHER
                        gram = state * SYMBOLS + s
                        value, to, text = score - cost + float(self.model[gram]), gram % wrap, (letter, out)
                    else:
                        value, to, text = score - cost, state, out
                    if to not in after or value > after[to][0]:
                        after[to] = (value, text)
            best = after
        _, state, out = max(((score + float(rest[state]), state, out) for state, (score, out) in best.items()), key=lambda x: x[0])
        read = []
        while out is not None:
            letter, out = out
            read.append(letter)
        read.reverse()
        for symbol in chosen:
            if n := int(symbol[state]):
                read.append(chr(96 + n))
                state = (state * SYMBOLS + n) % wrap
        return "".join(read).rstrip()

    def _hidden(self, best: dict, drop: float) -> dict:
        """The step of viterbi for a mark that may hide any letter."""
        scores = np.full(len(self.ends), -np.inf)
        scores[[*best]] = [score for score, _ in best.values()]
        v = scores[:, None] + self.model.reshape(-1, SYMBOLS)[:, 1:27] - HIDDEN
        v = v.reshape(SYMBOLS, -1, 26)
        come, v = v.argmax(0), v.max(0)
        after = {state: (score - drop, out) for state, (score, out) in best.items()}
        shorter = SYMBOLS ** (ORDER - 2)
        for n, k in np.argwhere(v > -np.inf).tolist():
            value, to = float(v[n, k]), n * SYMBOLS + k + 1
            if to not in after or value > after[to][0]:
                after[to] = (value, (chr(97 + k), best[int(come[n, k]) * shorter + n][1]))
        return after

    @staticmethod
    def _arcs(c: str) -> Iterator[tuple[str, float]]:
        base = unicodedata.normalize("NFKD", c)[:1]
        if "a" <= base <= "z":
            yield base, 0.0
            return
        if c == " ":
            yield " ", 0.0
            yield "", JOINED
            return
        for letter in LOOKS.get(c, ""):
            yield letter, SWAPPED
        if c == "*":
            for letter in "abcdefghijklmnopqrstuvwxyz":
                yield letter, HIDDEN
        if c in MARKS:
            yield "", DROPPED
        elif c.isalpha():
            yield c, 0.0
        else:
            yield "", KEPT

    @classmethod
    def folded(cls, letters: str) -> str:
        """Letters as they are in the lattice: without accents."""
        return letters if letters.isascii() else "".join(next(cls._arcs(c))[0] for c in letters)

    def word(self, token: str) -> str:
        """The restored word of a lower-case token."""
        m = WRAPPED.fullmatch(token)
        if m and not DOUBLED.search(m[1]):
            return self.folded(m[1])
        return self.viterbi(token)

    def readings(self, token: str) -> tuple[str, ...]:
        """The restored word, and the letters as they are written."""
        if token.isascii() and token.isalpha() and not DOUBLED.search(token):
            return (token,)
        word, m = self.word(token), LETTERS.fullmatch(token)
        return (word, m[1]) if m and m[1] != word else (word,)

    def run(self, run: str) -> str | None:
        """The words that a run of short tokens spells; None if too few of its
        tokens can be letters."""
        tokens = run.split()
        if len(tokens) > 2 and sum(READ.search(t) is not None for t in tokens) > 1 and sum("*" in t or READ.search(t) is not None for t in tokens) > 2:
            return self.viterbi(" ".join(tokens))
        return None

    def tokens(self, text: str) -> tuple[set[str], set[str], int]:
        """The distinct lower-case tokens, the words that runs of short tokens
        spell, and the number of tokens."""
        lower = text.lower()
        each = lower.split()
        spaced = {w for r in {m[0] for m in RUN.finditer(lower)} for w in (self.run(r) or "").split()}
        return set(each), spaced, len(each)

    def restore(self, text: str) -> str:
        """The whole text, lower-case, with every token restored."""

        def words(part: str) -> str:
            return re.sub(r"\S+", lambda m: self.word(m[0]), part)

        lower, done, parts = text.lower(), 0, []
        for m in RUN.finditer(lower):
            spelt = self.run(m[0])
            parts += [words(lower[done : m.start()]), words(m[0]) if spelt is None else spelt]
            done = m.end()
        return "".join([*parts, words(lower[done:])])


def pieces(word: str) -> Iterator[str]:
    """What may be evidence of a word: itself, and how it begins."""
    if len(word) >= 3:
        yield "=" + word
        for n in PREFIXES:
            if n < len(word):
                yield word[:n]


@dataclass(frozen=True)
class Model:
    """language: the character model; evidence: weight of a piece; bias and
    slopes of the regression; trained: whether there were labelled rows."""

    language: np.ndarray
    evidence: dict[str, float]
    slopes: tuple[float, ...]
    trained: bool


class _Weights(dict):
    """Weight of a token: that of its strongest piece."""

    def __init__(self, decoder: Decoder, evidence: dict[str, float]) -> None:
        self.decoder, self.evidence = decoder, evidence

    def __missing__(self, token: str) -> float:
        get = self.evidence.get
        found = 0.0
        for word in self.decoder.readings(token):
            size = len(word)
            if size >= 3:  # pieces(word), spelt out
                found = max(found, get("=" + word, 0.0))
                for n in PREFIXES:
                    if n >= size:
                        break
                    found = max(found, get(word[:n], 0.0))
        self[token] = found
        return found


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.decoder = Decoder(model.language)
        self.weights = _Weights(self.decoder, model.evidence)

    def inputs(self, text: str | None) -> tuple[float, ...]:
        """Evidence of the distinct tokens: in sum, a hundred tokens, at its
        strongest, and the number of tokens that hold some."""
        if len(self.weights) > KNOWN:
            self.weights.clear()
        each, spaced, n = self.decoder.tokens(text or "")
        found = [w for w in map(self.weights.__getitem__, each | spaced) if w]
        total = sum(found)
        return math.log1p(total), math.log1p(100 * total / max(n, 20)), max(found, default=0.0), math.log1p(len(found))

    def score(self, text: str | None) -> float:
        if not self.model.trained:
            return 0.0
        z = self.model.slopes[0] + sum(a * x for a, x in zip(self.model.slopes[1:], self.inputs(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def regression(x: np.ndarray, y: np.ndarray, toxic: float, ridge: float = 0.02) -> np.ndarray:
    """Bias and slopes by Newton's method; toxic: the share that this class has
    among all labelled rows."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.where(y, toxic / max(y.mean(), 1e-9), (1 - toxic) / max(1 - y.mean(), 1e-9))
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x / len(x) + keep / 10, x.T @ (share * (y - p)) / len(x) - keep @ w / 10)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _counted(rows: DataFrame, make_words) -> DataFrame:
    """piece, n: labelled documents that hold it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = make_words(), Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                counts.update({p for w in words(text) for p in pieces(w)})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["piece", "n"])

    return rows.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def fit(documents: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """The language model from all texts; the classifier from at most `rows`
    labelled rows of each class, none of them held out."""
    language = language_model(count_grams(documents))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    of_class = [known.where(c).select("doc_id") for c in ("toxic > 0", "toxic <= 0")]
    chosen = [F.broadcast(hashed_sample(c, "doc_id", rows, c.count())) for c in of_class]
    texts = [documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(c, "doc_id", "left_semi") for c in chosen]
    sizes = [max(0, t.count()) for t in texts]
    if not all(sizes):
        return Model(language, {}, (), False)

    def make_words():
        decoder, memo = Decoder(language), {}

        def words(text):
            each, spaced, _ = decoder.tokens(text or "")
            for t in each | spaced:
                if t not in memo:
                    memo[t] = decoder.readings(t)
            return {w for t in each | spaced for w in memo[t]}

        return words

    toxic = _counted(texts[0], make_words).where(F.col("n") >= HELD_BY).withColumnRenamed("n", "a")
    both = toxic.join(_counted(texts[1], make_words).withColumnRenamed("n", "b"), "piece", "left").select("piece", "a", F.coalesce("b", F.lit(0)).alias("b"))
    ratio = F.log((F.col("a") + 0.5) / (sizes[0] + 1)) - F.log((F.col("b") + 0.5) / (sizes[1] + 1))
    rate = (F.col("a") + F.col("b")) / sum(sizes)
    g = sum(F.when(F.col(c) > 0, 2 * F.col(c) * F.log(F.col(c) / (rate * n))).otherwise(0) for c, n in (("a", sizes[0]), ("b", sizes[1])))
    told = both.select("piece", ratio.alias("ratio")).where((F.col("ratio") >= RATIO) & (g >= STATISTIC))
    evidence = {r.piece: r.ratio for r in told.orderBy(F.desc("ratio"), "piece").collect()}
    first = Model(language, evidence, (), True)
    x = [np.array([r.x for r in _inputs(t, first).collect()]).reshape(-1, INPUTS) for t in texts]
    share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    slopes = regression(np.concatenate(x), np.repeat([True, False], [len(x[0]), len(x[1])]), share)
    return Model(language, evidence, tuple(map(float, slopes)), True)


def _inputs(rows: DataFrame, model: Model) -> DataFrame:
    def make():
        scorer = Scorer(model)
        return lambda batch: {"x": [list(scorer.inputs(t)) for t in batch["text"].to_pylist()]}

    return by_batch(rows.select("text"), make, "x array<double>")


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def step(batch):
            found = [scorer.score(t) for t in batch["text"].to_pylist()]
            return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": found, "predicted": [int(s >= THRESHOLD) for s in found]}

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return by_batch(rows, make, "doc_id long, held_out boolean, score double, predicted int")


def restored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, restored: the whole texts after decoding."""
    shared = documents.sparkSession.sparkContext.broadcast(model.language)

    def make():
        decoder = Decoder(shared.value)
        return lambda batch: {"doc_id": batch["doc_id"], "restored": [None if t is None else decoder.restore(t) for t in batch["text"].to_pylist()]}

    return by_batch(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, "doc_id long, restored string")

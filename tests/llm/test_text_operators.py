"""Operators on single texts against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from tallyline.llm import chat, packing, pii, quality, queries, secret_scan, toxicity

SPACE = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(SPACE, text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b#|\u00e9\u2003\U0001f600", max_size=60))
def test_quality_counts(text):
    assert quality.statistics(text)[0] == plain_counts(text)


def test_forest_isolates():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (1000, 8))
    bad = rng.normal(0, 1, (50, 8)) + np.eye(8)[1] * 12
    x = np.concatenate([good, bad])
    is_good = np.arange(len(x)) < 1000
    forest = quality.calibrated(quality.grow(good, x.min(0), x.max(0)), x, is_good)
    over = forest.score(x) > forest.threshold
    assert over[~is_good].mean() > 0.95 and over[is_good].mean() <= 0.003


def test_quality_query(spark, small):
    rows = queries.op5_quality(spark, small).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{small}/documents.parquet")
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        r = rows.loc[doc]
        n, chars, symbols, dup, repeat = plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n) and not (r.base_failed and r.kept)


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8 and m[0].isascii()]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_secret_query(spark, small):
    rows = queries.op2_secrets(spark, small).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{small}/documents.parquet")
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        want = plain_secrets(text or "")
        assert rows.loc[doc].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(rows.loc[doc].spans.split(","))


def test_secret_ownership(spark):
    own, copied = "tOkEnA1b2C3d4E5f6G7h8I9j0K1l2", "eXaMpLeA1b2C3d4E5f6G7h8I9j0Zz"
    rows = [(0, f"see {own} end", "s0")] + [(i, f"see {copied} end", f"s{i}") for i in range(1, 5)] + [(9, "", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.spans, r.n_live, r.n_example) for r in secret_scan.scan(docs).collect()}
    assert got[0] == (f"live:4:{4 + len(own)}", 1, 0) and got[1] == ("", 0, 1) and got[9] == ("", 0, 0)
    texts = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert texts[0] == f"see {secret_scan.MASK} end" and copied in texts[1]


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(d):
    x = [int(c) for c in d][::-1]
    return sum(x[0::2] + [sum(divmod(2 * c, 10)) for c in x[1::2]]) % 10 == 0


def plain_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            bad = (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))) or (kind == "card" and not (14 <= len(d) <= 19 and plain_luhn(d))) or (kind == "phone" and not 10 <= len(d) <= 15)
            if not bad:
                out.append((m.start(), k, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", "@x.y", ".", "1", "25", "256", "4111", "-", " ", "+1", "(", ")", "555", "\u00e9", "1111"]), max_size=25).map("".join))
def test_pii_base(text):
    assert pii.base_spans(text) == plain_pii(text)


def test_pii_skip_edges_carry_labels():
    full, tail = "+1 (017) 555-7713", "017 555-7713"
    text = f"call {full} now. " + "word " * 50 + f"again {tail} end"
    base = pii.base_spans(text)
    weights = pii.learn([(pii.features(full, "call"), 4), (pii.features("2024000000", "year"), 0)])
    assert [(k, text[s:e]) for s, k, e in pii.added_spans(text, base, weights)] == [("phone", tail)]


def test_loopy_messages_match_enumeration():
    rng = np.random.default_rng(1)
    unary, links = rng.normal(size=(3, 3)), [(0, 1, 0.7), (1, 2, 1.1)]  # a chain: messages are exact
    p = np.zeros((3, 3))
    for a in range(3):
        for b in range(3):
            for c in range(3):
                w = np.exp(unary[0, a] + unary[1, b] + unary[2, c] + 0.7 * (a == b) + 1.1 * (b == c))
                p[0, a] += w
                p[1, b] += w
                p[2, c] += w
    assert np.abs(pii.messages(unary, links) - p / p.sum(1, keepdims=True)).max() < 1e-3


def test_pii_query(spark, small):
    rows = queries.op6_pii(spark, small).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{small}/documents.parquet")
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        want = plain_pii(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, k, e in want)
        assert rows.loc[doc].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(rows.loc[doc].spans.split(","))


@pytest.fixture(scope="module")
def decoder():
    words = ["the", "and", "that", "idiot", "loser", "stupid", "trash", "of", "with", "thing", "scum"]
    counts = np.zeros(toxicity.SYMBOLS**toxicity.ORDER)
    for i in range(400):
        np.add.at(counts, toxicity.grams(" ".join(words[(i * 7 + k * k) % len(words)] for k in range(12))), 1)
    return toxicity.Decoder(toxicity.language_model(counts))


def test_deobfuscation(decoder):
    for raw, word in {"1d10t": "idiot", "!d!ot": "idiot", "looooser": "loser", "5tup1d": "stupid", "tr@sh": "trash", "s.t.u.p.i.d": "stupid", "scum***": "scum", "st*pid": "stupid", "the,": "the"}.items():
        assert decoder.word(raw) == word, raw
    assert decoder.restore("That i d i o t and tr@sh") == "that idiot and trash"


def test_every_unsure_token_is_decoded():
    words = "the and that idiot moron trash dumbass hat tall with all see".split()
    counts = np.zeros(toxicity.SYMBOLS**toxicity.ORDER)
    for i in range(400):
        np.add.at(counts, toxicity.grams(" ".join(words[(i * 7 + k * k + k) % len(words)] for k in range(12))), 1)
    d = toxicity.Decoder(toxicity.language_model(counts))
    for raw, word in {"iddiot": "idiot", "morron": "moron", "trrash": "trash", "\u00efd\u00ef\u00f6t": "idiot", "idio+": "idiot", "tras#": "trash", "dumba$$": "dumbass", "|diot": "idiot", "(idiot)": "idiot", "idiot!!": "idiot", "all": "all", "see,": "see", "idio*": "idiot", "trash***": "trash"}.items():
        assert d.word(raw) == word, raw
    assert d.readings("all!") == ("all",) and d.readings("iddiot") == ("idiot", "iddiot")
    weights = toxicity._Weights(d, {"=idiot": 2.0, "mor": 1.0, "=t\u00ebx": 3.0})
    assert [weights[t] for t in ("iddiot", "morrons", "idio+", "t\u00ebx", "hat")] == [2.0, 1.0, 2.0, 3.0, 0.0]
    assert len(d.word("*" * 5000)) < 4 and len(d.word("*" * 300 + "a")) < 6


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("adit1$!.**"), max_size=5).map("".join))
def test_endings_are_the_lattice(decoder, token):
    def ways(i, state, before):
        if i == len(token):
            return float(decoder.ends[state])
        arcs = [*decoder._arcs(token[i])] + [("", toxicity.REPEATED)] * (token[i] == before)
        best = -np.inf
        for letter, cost in arcs:
            gram = state * toxicity.SYMBOLS + (ord(letter) - 96 if letter else 0)
            step = float(decoder.model[gram]) if letter else 0.0
            to = gram % toxicity.SYMBOLS ** (toxicity.ORDER - 1) if letter else state
            key = i + 1, to, token[i]
            if key not in known:
                known[key] = ways(*key)
            best = max(best, step - cost + known[key])
        return best

    known = {}
    want = ways(0, 0, "")  # the value of what is read reaches the best of all ways
    assert abs(value_of(decoder, token, decoder.viterbi(token)) - want) < 1e-3


def value_of(decoder, token, read):
    """The best value of the ways in which token is read so."""
    best = {(0, 0): 0.0}
    for k, c in enumerate(token):
        arcs = [*decoder._arcs(c)] + [("", toxicity.REPEATED)] * (token[k - 1 : k] == c)
        after = {}
        for (n, state), v in best.items():
            for letter, cost in arcs:
                if letter and read[n : n + 1] != letter:
                    continue
                gram = state * toxicity.SYMBOLS + (ord(letter) - 96 if letter else 0)
                key = (n + 1, gram % toxicity.SYMBOLS ** (toxicity.ORDER - 1)) if letter else (n, state)
                after[key] = max(after.get(key, -np.inf), v - cost + (float(decoder.model[gram]) if letter else 0.0))
        best = after
    return max((v + float(decoder.ends[state]) for (n, state), v in best.items() if n == len(read)), default=-np.inf)


def test_spaced_runs():
    words = "the you are say now that moron idiot a i and trash with".split()
    counts = np.zeros(toxicity.SYMBOLS**toxicity.ORDER)
    for i in range(400):
        np.add.at(counts, toxicity.grams(" ".join(words[(i * 7 + k * k + k) % len(words)] for k in range(12))), 1)
    d = toxicity.Decoder(toxicity.language_model(counts))
    for raw, word in {
        "m o r o n": "moron",
        "i d i o t.": "idiot",
        "a i d i o t.": "a idiot",
        "a i d i o t now": "a idiot now",
        "a m o r o n i say": "a moron i say",
        "y o u i d i o t": "you idiot",
        "i   d   i   o   t": "idiot",
        "i\td\ti\to\tt": "idiot",
        "i\nd\r\ni\no\nt": "idiot",
        "1 d ! 0 t !": "idiot",
        "i - d - i - o - t": "idiot",
        "i.d i.o t": "idiot",
        "- - - now": "- - - now".replace("-", ""),
    }.items():
        assert d.restore(raw).split() == word.split(), raw
        assert {w for w in word.split() if len(w) > 3} <= set().union(*d.tokens(raw)[:2]), raw
    assert d.restore("i d i o t " * 20_000).split() == ["idiot"] * 20_000


def test_language_model_sums_to_one(decoder):
    p = np.exp(decoder.model.astype(float)).reshape(-1, toxicity.SYMBOLS).sum(1)
    assert np.abs(p - 1).max() < 1e-4


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    m = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id").merge(pd.read_parquet(f"{sf}/documents.parquet")[["doc_id", "lang"]], on="doc_id")
    assert (m[m.predicted == 1].toxic == 1).mean() >= 0.9
    assert (m[(m.toxic == 1) & (m.lang == "en")].predicted == 1).mean() >= 0.8


def test_toxicity_learns_no_held_out_row(spark):
    rows = [(i, "rare words here " + ("zzgrr" if i % 2 else "calm") + f" {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows if held(i)], "doc_id long, toxic int")
    assert not toxicity.fit(docs, labels).trained


def test_samples_reach_their_bounds(spark, monkeypatch):
    sizes, real = [], toxicity.hashed_sample

    def counted(*args):
        sizes.append(real(*args).count())
        return real(*args)

    for module in (toxicity, pii):
        monkeypatch.setattr(module, "hashed_sample", counted)
    monkeypatch.setattr(pii, "ROWS", 10)
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 60 = 0 THEN 'call +1 (017) 555-7713' ELSE 'calm words' END AS text")
    toxicity.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 60 = 0) AS toxic"), 10)
    pii.fit(docs)
    assert sizes == [10, 10, 10]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab%_ ", max_size=5), st.lists(st.sampled_from(["###", "</turn>", "\\", "\n", "a", "### user|0: ", "\u00e9"]), max_size=6).map("".join)), max_size=4))
def test_chat_round_trip(turns):
    assert list(chat.parse("".join(chat.format_turn(r, t) for r, t in turns))) == turns


def test_chat_rejects():
    for text in ("x", "### user|0: a", "### user|2: a</turn>\n", "### user|0: ### a</turn>\n", "### user|0: a</turn>"):
        with pytest.raises(chat.Malformed):
            list(chat.parse(text))


def test_chat_query(spark, small):
    c = pd.read_parquet(f"{small}/conversations.parquet")[["conv_id", "turn", "role", "text"]]
    said = r"\### Assistant: </turn> ok"
    c = pd.concat([c, pd.DataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns=c.columns)])
    got = queries.op9_chat(spark, small).toPandas().set_index("conv_id")
    assert len(got) == c.conv_id.nunique()
    for conv, g in c.sort_values(["conv_id", "turn"]).groupby("conv_id"):
        every = "".join(f"{r}\n{t or ''}\n" for r, t in zip(g.role, g.text, strict=True))
        loss = "".join(t or "" for r, t in zip(g.role, g.text, strict=True) if r == "assistant")
        r = got.loc[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(g), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def plain_first_fit(lengths, room):
    bins, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for b, used in enumerate(bins):
            if used + lengths[i] <= room:
                break
        else:
            b, used = len(bins), 0
            bins.append(0)
        out[i] = (b, used)
        bins[b] += lengths[i]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_tournament_is_first_fit(lengths):
    bins, offsets = packing.first_fit_decreasing(lengths, 20)
    assert dict(enumerate(zip(bins, offsets, strict=True))) == plain_first_fit(lengths, 20)


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t = Tokenizer.from_file(path)
    texts = ["", " ", "The cat's toy, don't!", "x<|endoftext|> y", "\u00c1b\u0301 \u0301c \ud55c\uad6d 12,5", "a\n\nb  c\t\x1cd\u2003e", "LOUD!! a$$$ *** -- |x|"]
    for text, ids in zip(texts, packing.Encoder(path).encode(texts), strict=True):
        assert ids.tolist() == [*t.encode(text, add_special_tokens=False).ids, 2]


def test_packing_query(spark, small):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    docs = pd.read_parquet(f"{small}/documents.parquet")
    got = queries.op10_packing(spark, small).toPandas()
    for doc, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        own = got[got.doc_id == doc].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        for r in own.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 4096
    used = got.groupby("sequence_id").length.sum()
    assert packing.padding(used) <= 0.03 * used.sum() + 4096

"""The skip-chain field: marginals against enumeration, and disguised repeats that
are planted in texts."""

import itertools
import random

import numpy as np
import pytest

from tallyline.llm import pii


def enumerated(unary, links):
    n, labels = unary.shape
    p = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(e[y[i]] for i, j, e in links if y[i] == y[j]))
        for i in range(n):
            p[i, y[i]] += w
    return p / p.sum(1, keepdims=True)


def test_messages_match_enumeration():
    rng = np.random.default_rng(4)
    tree = [(0, 1), (1, 2), (1, 3), (3, 4)]
    for _ in range(5):
        unary, links = rng.normal(size=(5, 3)), [(i, j, rng.normal(size=3)) for i, j in tree]
        assert np.abs(pii.messages(unary, links) - enumerated(unary, links)).max() < 1e-3
    for _ in range(20):  # a loop: a skip edge over a chain
        unary = rng.normal(size=(5, 3)) * 2
        links = [(i, i + 1, np.full(3, 0.2)) for i in range(4)] + [(0, 4, np.full(3, 3.0)), (1, 3, np.full(3, 3.0))]
        got, want = pii.messages(unary, links), enumerated(unary, links)
        assert np.abs(got - want).max() < 0.1


def luhn_card(rng):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def planted(rng):
    """(text, spans that only the field can find, numbers that are no personal data)"""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    own, repeats, others = [], [], []
    for kind in rng.sample(["email", "ip", "card", "phone"], 2):
        if kind == "email":
            a = f"{word()}.{word()}@{word()}.example.com"
            b = a.replace("@", rng.choice(["(at)", " at ", " [at] "]))
        elif kind == "ip":
            x = [str(rng.randint(0, 255)) for _ in range(4)]
            a, b = ".".join(x), "-".join(x)
        elif kind == "card":
            d = luhn_card(rng)
            a, b = " ".join(d[i : i + 4] for i in range(0, 16, 4)), ".".join(d[i : i + 4] for i in range(0, 16, 4))
        else:
            d = "".join(rng.choice("23456789") for _ in range(9))
            a, b = f"+4{rng.randint(0, 9)} {d[:3]} {d[3:6]} {d[6:]}", f"0{d[:3]}.{d[3:6]}.{d[6:]}"
        own.append(a)
        repeats.append((kind, b))
    for _ in range(3):
        others.append("".join(rng.choice("0123456789") for _ in range(rng.choice([8, 10, 13]))))
    others = [x for x in others if not pii.base_spans(x)]
    parts = own + others + [b for _, b in repeats]
    text, spans = "", []
    for x in parts:
        text += " ".join(word() for _ in range(rng.randint(3, 30))) + " "
        spans += [(len(text), kind, len(text) + len(x)) for kind, b in repeats if b is x]
        text += x + " "
    return text + word(), spans


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(8)
    rows = [(i, planted(rng)[0]) for i in range(400)] + [(None, None), (1000, "")]
    return pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))


def test_disguised_repeats_are_found(field):
    rng = random.Random(99)
    hit = wanted = said = 0
    for _ in range(300):
        text, spans = planted(rng)
        got = pii.added_spans(text, pii.base_spans(text), field)
        # a span may be found with a mark more or less at its ends
        near = [g for g in got if any(g[1] == k and g[0] < e and s < g[2] and min(g[2], e) - max(g[0], s) > 0.8 * (e - s) for s, k, e in spans)]
        hit, wanted, said = hit + len(near), wanted + len(spans), said + len(got)
    assert hit >= 0.9 * wanted and hit >= 0.95 * said, (hit, wanted, said)


def test_edges_are_learned(field):
    start = np.repeat(np.array(pii.PRIOR)[:, None], 5, 1)
    assert field.edge.shape == start.shape and np.abs(field.edge - start).max() > 0.01 and np.abs(field.token).max() > 0.1


def test_short_addresses_are_candidates(field):
    text = "from 10.0.0.1 word word, later 10-0-0-1 and a 7 8 9"
    assert [text[s:e] for s, e, _ in pii.tokens(text)] == ["10.0.0.1", "10-0-0-1"]
    assert [(k, text[s:e]) for s, k, e in pii.added_spans(text, pii.base_spans(text), field)] == [("ip", "10-0-0-1")]


def test_a_lone_number_is_left_alone(field):
    for text in ("in 1234567 cases of 20240101", "order 12345678901 and again 12345678901", "meet at noon, look at example.com"):
        assert pii.added_spans(text, pii.base_spans(text), field) == []

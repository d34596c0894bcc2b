"""Linked secrets and restored words, against plain enumeration."""

import itertools
import random
import re

import numpy as np
from cases import documents

from cityweave.llm import secret_scan, toxicity

PIECES = [
    "password=abc123", 'secret: "x1"', "API_KEY='Zz9/+=-_.0'", "AKIA" + "Q7" * 9, "AKIA" + "B" * 3, "0a" * 13, "f" * 23, "user: bob.smith", "client_id=app-42",
    "Ab3" * 12 + "==", "A" * 40, "https://x.example/p?q=1", "ftp://é.host", "token = https://a.b/c", "🙂", "Wörter", "\n\n", "account_id=" + "0a" * 14,
]


def _plain_spans(text):
    """Base spans, then weak spans that overlap no base one and have a part of another role in scope."""
    spans = []
    for m in re.finditer(secret_scan.ASSIGN + "(" + secret_scan.VALUE + ")", text):
        spans += [(m.start(), 0, m.end())] if len(m[1]) >= secret_scan.LEAST_VALUE else []
    patterns = [(1, secret_scan.ACCESS), (2, secret_scan.HEX), (3, secret_scan.IDENT), (4, secret_scan.MATERIAL), (5, secret_scan.ENDPOINT)]
    found = {kind: [(m.start(), kind, m.end()) for m in re.finditer(p, text, re.ASCII)] for kind, p in patterns}
    base = sorted(spans + found[1] + found[2])
    weak = [w for kind in (3, 4, 5) for w in found[kind] if all(w[0] >= b[2] or b[0] >= w[2] for b in base)]
    role = lambda span: secret_scan.ROLE[secret_scan.KINDS[span[1]]]
    scope = secret_scan.SCOPE
    near = lambda w, p: role(w) != role(p) and p[0] < w[2] + scope and w[0] - scope < p[2]
    return base, sorted(base + [w for w in weak if any(near(w, p) for p in base + weak)])


def test_linked_spans_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(150):
        gaps = ["x" * rng.choice([1, 30, 180, 199, 200, 201, 420]) for _ in range(5)]
        texts.append(" ".join(p for pair in zip(rng.choices(PIECES, k=5), gaps, strict=True) for p in pair))
    rows = secret_scan.scan(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    got = {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in rows}
    want = {i: _plain_spans(t) for i, t in enumerate(texts)}
    assert got == want
    linked = [len(spans) - len(base) for base, spans in want.values()]
    assert min(linked) == 0 and max(linked) > 1


def _readings(token):
    """Every reading of a token with the cost of its signs, from what a sign may stand for."""
    apart = len(token) > 2 and all((c in toxicity.SEPARATORS) == (n % 2 == 1) for n, c in enumerate(token))
    choices = []
    for sign, run in itertools.groupby(token):
        length = len(list(run))
        if sign == " ":
            choices.append([("", toxicity.LEFT_OUT), (" ", toxicity.LEFT_OUT)])
        elif apart and sign in toxicity.SEPARATORS:
            choices.append([("", toxicity.LEFT_OUT)])
        else:
            once = [(sign, 0.0), *[(c, toxicity.SIGN) for c in toxicity.LEET.get(sign, "")]]
            twice = [(c + c, cost + (toxicity.DOUBLE if length > 2 else 0.0)) for c, cost in once] if length > 1 else []
            choices.append(once + twice)
    for picked in itertools.product(*choices):
        yield "".join(s for s, _ in picked), sum(c for _, c in picked)


def test_the_restored_word_is_the_cheapest_of_all_readings():
    rng = random.Random(3)
    for _ in range(150):
        costs = np.random.default_rng(rng.randrange(1 << 30)).random((toxicity.CLASSES,) * 3) * 5
        token = "".join(rng.choice("ab01!s5ii  é") * rng.choice([1, 1, 2, 3]) for _ in range(rng.randrange(1, 7)))
        token = rng.choice([token, ".".join("s1lly"), "-".join("ab!"), token])

        def cost(read, extra, costs=costs):
            marks = [toxicity.NONE, toxicity.NONE, *[toxicity.letter_class(c) for c in read], toxicity.NONE]
            return extra + sum(costs[marks[k], marks[k + 1], marks[k + 2]] for k in range(len(marks) - 2))

        every = {}
        for read, extra in _readings(token):
            every[read] = min(cost(read, extra), every.get(read, float("inf")))
        assert abs(every[toxicity.restore(token, costs)] - min(every.values())) < 1e-9, token

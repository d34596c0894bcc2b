"""Fill-in-the-middle, conversation repair and repeated passages, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import CLASHING, documents, rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cityweave.llm import fill_middle, suffix_dedup, turn_repair
from cityweave.llm.queries import REGISTRY, damaged

TEXTS = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abZ <PSM>é🙂中.\n")), max_size=60)


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def plain_middle(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    n, text = len(units), text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-99, 99)), TEXTS), min_size=1, max_size=6))
def test_cuts(data):
    ids, texts = zip(*data, strict=True)
    got = list(fill_middle.cut_texts(list(ids), [t.encode() for t in texts], 1, 10, 20))
    assert [(*g[:4], g[4].decode()) for g in got] == [plain_middle(i, t) for i, t in data]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_exception_index_both_ways(text):
    index = fill_middle.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:k].encode()) for k in chars])
    assert index.to_bytes(chars).tolist() == cuts.tolist()
    assert index.to_chars(cuts).tolist() == chars.tolist()


def test_middles_of_awkward_rows(spark):
    out = fill_middle.transform(documents(spark, extra=CLASHING)).withColumn("back", fill_middle.restored())
    got = sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in out.collect())
    assert got == sorted((str(i), *(str(x) if k in (2, 3) else x for k, x in enumerate(plain_middle(i, t))), t or "") for i, t, *_ in rows())


# --- conversations


def plain_repair(own):
    """Cheapest edits by looking at every row, state and continuation, from the end; ``own`` are (role, text) in order."""
    white = "\x20\x09\x0a\x0b\x0c\x0d"
    seen, faults = set(), []
    for role, text in own:
        bare = text.strip(white)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {state: (0, "", ()) if state in ("", "a") else (10**9, "~", ()) for state in ("", "s", "u", "a")}

    def with_inserts(table):
        for _ in range(3):
            for state in table:
                for role in "ua":
                    to = step.get((state, role))
                    if to is not None:
                        cost, audit, out = table[to]
                        turn = ({"u": "user", "a": "assistant"}[role], "")
                        table[state] = min(table[state], (cost + 3, "I" + audit, (turn, *out)))
        return table

    best = with_inserts(best)
    for (role, text), fault in zip(reversed(own), reversed(faults), strict=True):
        new = {}
        for state in best:
            cost, audit, out = best[state]
            options = [(cost + 4, "D" + audit, out)]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for initial, price, name, given_role in ((role[:1], 0, "K", role), ("u", 3, "R", "user"), ("a", 3, "R", "assistant")):
                    to = step.get((state, initial)) if initial else None
                    if to is not None:
                        cost, audit, out = best[to]
                        options.append((cost + price + extra, name + audit, ((given_role, text), *out)))
            new[state] = min(options)
        best = with_inserts(new)
    initials = [role[:1] for role, _ in own]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    cost, audit, out = best[""]
    return (*counts, illegal, cost, audit, out)


def plain_damage(data):
    out = []
    for conv, turn, role, text in data:
        show = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_conversations(data):
    kept = defaultdict(list)
    for conv, turn, role, text in plain_damage(data):
        kept[conv].append((turn, role, text))
    result = []
    for conv in {row[0] for row in data}:
        own = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        *rest, out = plain_repair([(r, t) for _, r, t in own])
        result.append((str(conv), gaps, *rest, sha("\n".join(f"{r}:{t}" for r, t in out))))
    return sorted(result)


def conversation_rows(rng, n):
    data = []
    for conv in range(n):
        for turn in range(rng.randrange(0, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "Why?", "and then", "", " \t", None, "ok!  \n", words(rng, 3) + "."])
            data.append((conv, turn if rng.random() < 0.95 else rng.choice([None, 0, 1, 40]), role, text))
    return [*data, (None, 0, "user", "lost."), (None, None, "assistant", "row")]


def as_frame(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def run_repair(spark, tmp_path, data):
    as_frame(spark, data).withColumn("rows", F.lit(1)).withColumn("fault", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    order = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = REGISTRY["op12_turn_repair"](spark, str(tmp_path)).select(*order).collect()
    return sorted((str(r[0]), *r[1:]) for r in got)


def test_repairs_are_the_cheapest(spark, tmp_path):
    data = conversation_rows(random.Random(3), 400)
    assert run_repair(spark, tmp_path, data) == plain_conversations(data)


def test_repairs_of_the_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted((str(r.conv_id), r.cost, r.audit) for r in REGISTRY["op12_turn_repair"](spark, sf_dir).collect())
    assert got == [(r[0], r[6], r[7]) for r in plain_conversations([tuple(r) for r in table.collect()])]


def test_no_conversations(spark, tmp_path):
    assert run_repair(spark, tmp_path, []) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("suaxSUAX-", max_size=14), min_size=1, max_size=8))
def test_rules_expand_to_their_sequences_and_their_matrices_agree(sequences):
    grammar = turn_repair.Grammar()
    sides = {name: pair for pair, name in grammar.rules.items()}
    packed = grammar.compress(sequences)
    sides = {name: pair for pair, name in grammar.rules.items()}
    expand = lambda s: turn_repair.SYMBOLS[s] if s not in sides else expand(sides[s][0]) + expand(sides[s][1])
    assert ["".join(map(expand, p)) for p in packed] == sequences
    pairs = [p for s in packed for p in zip(s, s[1:], strict=False)]
    assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)
    one_by_one = []
    for s in sequences:
        way = [[(0, turn_repair.Rope()), None, None, None]]
        for c in s:
            way = turn_repair.times(way, turn_repair.symbol_matrix(c))
        ends = turn_repair.times(way, turn_repair.INSERTIONS)[0]
        one_by_one.append(min((e[0], str(e[1])) for e in (ends[0], ends[3]) if e))
    assert [(c, str(r)) for c, r in turn_repair.Grammar().repair(sequences)] == one_by_one


def test_one_long_conversation(spark):
    rng = random.Random(8)
    data = [(1, t, rng.choice(["user", "assistant"]), f"row {t}" + rng.choice([".", ""])) for t in range(3000)]
    got = turn_repair.repair(as_frame(spark, data)).first()
    want = plain_repair([(r, t) for _, _, r, t in data])
    assert (got.truncated, got.illegal, got.cost, got.audit) == want[2:6]
    assert [(t.role, t.text) for t in got.repaired] == list(want[6])


def test_damage(spark):
    data = conversation_rows(random.Random(4), 60)
    got = sorted(map(repr, (tuple(r) for r in damaged(as_frame(spark, data)).collect())))
    assert got == sorted(map(repr, plain_damage(data)))


# --- repeats


def plain_repeats(data, least, keep_first=False):
    """(id, bytes, removed, runs, what stays) by looking up every window of every text; ids ascend."""
    holders = defaultdict(list)
    texts = [(i, (t or "").encode()) for i, t in data]
    for k, (_, t) in enumerate(texts):
        for at in range(len(t) - least + 1):
            holders[t[at : at + least]].append((k, at))
    cover = [np.zeros(len(t) + 1, bool) for _, t in texts]
    for places in holders.values():
        if len(places) > 1:
            for k, at in places[1:] if keep_first else places:
                cover[k][at : at + least] = True
    out = []
    for (i, t), own in zip(texts, cover, strict=True):
        own = own[:-1]
        runs = int((np.diff(np.concatenate([[False], own]).astype(int)) == 1).sum())
        out.append((str(i), len(t), int(own.sum()), runs, sha(np.frombuffer(t, np.uint8)[~own].tobytes())))
    return sorted(out)


def repeated_texts():
    rng = random.Random(21)
    passages = [words(rng, n) for n in (70, 90, 120, 400)]
    lines = [words(rng, 25) for _ in range(4)]
    data = [(0, None), (1, ""), (2, "a" * 1500), (3, "ab" * 500), (4, "é🙂" * 300), (5, "x" * 399), (6, "x" * 400)]
    for k in range(60):
        parts = [words(rng, rng.randrange(1, 120)) for _ in range(rng.randrange(1, 5))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        for _ in range(rng.randrange(0, 4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(lines))
        data.append((10 + k, " ".join(parts)))
    data += [(100 + k, data[30 + k][1]) for k in range(6)]
    changed = list(passages[3])
    for k in range(8):
        changed[rng.randrange(len(changed))] = "Z"
        data.append((200 + k, "".join(changed)))
    return data


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("most_kinds", [suffix_dedup.MOST_KINDS, 8, 1])
def test_repeats(spark, keep_first, most_kinds):
    data = repeated_texts()
    docs = documents(spark, [(i, t, "en", "a") for i, t in data], extra=["mark", "doc", "begin", "anchor"])
    out = suffix_dedup.remove_repeats(docs, keep_first, most_kinds)
    got = sorted((str(r[0]), r[1], r[2], r[3], sha(bytes(r[4]))) for r in out.collect())
    assert got == plain_repeats(data, suffix_dedup.LEAST, keep_first)


def test_repeats_of_the_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = sorted((str(r[0]), *r[1:]) for r in REGISTRY["op13_suffix_dedup"](spark, sf_dir).collect())
    assert got == plain_repeats([tuple(r) for r in table.collect()], 400)


def test_repeats_across_pieces(spark, monkeypatch):
    rng = random.Random(2)
    long = words(rng, 300)
    texts = [(long + words(rng, 900) + long).encode(), long.encode()]
    whole = [tuple(map(np.concatenate, zip(*suffix_dedup.segments(texts), strict=True)))]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    pieces = [tuple(map(np.concatenate, zip(*suffix_dedup.segments(texts), strict=True)))]
    covered = lambda found: {(n, b + k) for n, b, w in zip(*(found[0][j].tolist() for j in range(3)), strict=True) for k in range(w)}
    assert covered(whole) == covered(pieces) == {(n, k) for n, t in enumerate(texts) for k in range(len(t) - 399)}


def test_rows_that_repeat(spark):
    rng = random.Random(6)
    text, other = words(rng, 200), words(rng, 150)
    docs = documents(spark, [(1, text, "", ""), (1, text, "", ""), (1, other, "", ""), (None, other, "", ""), (None, "short", "", "")])
    got = sorted((str(r[0]), r[1], r[2]) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == sorted([("1", len(text), len(text))] * 2 + [(str(i), len(other), len(other)) for i in (1, None)] + [("None", 5, 0)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=40))
def test_nearest_smaller(values):
    want = [max((j for j in range(i) if values[j] < v), default=-1) for i, v in enumerate(values)]
    distinct = np.array(values) * 100 + np.arange(len(values))  # the values in use are positions, which differ
    want = [max((j for j in range(i) if distinct[j] < v), default=-1) for i, v in enumerate(distinct)]
    assert suffix_dedup.previous_smaller(distinct).tolist() == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b"abcabcabd" * 9, b"a" * 50, b"x" * 450]), max_size=12))
def test_factors(parts):
    data = b"".join(parts)
    if not data:
        return

    def common(i, j):
        n = 0
        while n < suffix_dedup.LEAST and j + n < len(data) and data[i + n] == data[j + n]:
            n += 1
        return n

    step = max(1, len(data) // 120)
    starts = np.arange(0, len(data), step)
    before, after = suffix_dedup.longest_factors(np.frombuffer(data, np.uint8), starts)
    place = starts.tolist()
    assert before.tolist() == [max((common(j, i) for j in place[:k]), default=0) for k, i in enumerate(place)]
    assert after.tolist() == [max((common(i, j) for j in place[k + 1 :]), default=0) for k, i in enumerate(place)]

"""Toxicity of texts whose words may be disguised.

1. A character model is counted over all documents: which letter follows which two, among 26 letters, other letters and
   what is no letter.
2. A disguised token (digits or signs between letters, a letter doubled or drawn out, letters set apart by white
   space or dots) is read as a noisy channel: each sign becomes a column of a lattice with the letters it may
   stand for and their costs, a run of one letter may have been one or two, a sign between single letters may be
   nothing, and white space between them nothing or the end of a word. The cheapest path under the character model is the restored word.
3. Words and their beginnings of 4 to 6 letters are evidence. A bounded sample of labelled rows gives,
   for each, the documents of either label that hold it; rules are chosen one by one, each for the toxic documents
   that no rule before it explains, then those that are certain by themselves. A beginning that several different words
   of a text share, and no other text's, is a sign by itself, so that few labels are enough for it.
4. A text's score is the chance that at least one of its rules is right, over the rate at which texts
   without any are toxic.

The fit reads at most ``MOST_LABELLED`` labelled rows of either label, those whose id hashes lowest. Rows
held out are never among them.

Edge cases: a null or empty text scores the base rate. Labels of unknown documents and null labels are left
out; without labels of both kinds every text scores 0. Rows that repeat an id are scored each. An
empty table gives an empty one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from cityweave.llm.common import id_text, short_batches, slices, stored, text_of, tidy

#: Labelled rows that the fit reads, at most, of either label.
MOST_LABELLED = 4000
#: A rule needs so many toxic documents, and so many that no other rule explains.
LEAST_DOCUMENTS, LEAST_NEW = 3, 2
#: Or one, if so many different words of a toxic document begin with it on average.
BURST = 4
#: Share of toxic documents among those that hold a rule, at least.
LEAST_PRECISION = 0.9
#: From this score on a text is rejected.
LIMIT = 0.7
BEGINNINGS = (4, 5, 6)
#: Tokens that a process remembers; it starts anew beyond.
MOST_TOKENS = 400_000

#: Fixed: letters that a sign is used for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~/"
#: Costs, as minus the logarithm of a chance: a sign for a letter, a doubled letter, a sign left out.
SIGN, DOUBLE, LEFT_OUT = 1.0, 1.0, 0.5

LETTERS, OTHER, NONE = 26, 26, 27
CLASSES = 28

_EDGE = re.compile(r"^[^\w@$€£]+|[^\w@$!€£+]+$")
_SIGNS = "".join(re.escape(c) for c in LEET)
_DISGUISED = re.compile(rf"[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]|(.)\1\1|^(?:\S[{re.escape(SEPARATORS)}])+\S$")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_APART = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")


def letter_class(sign: str) -> int:
    if "a" <= sign <= "z":
        return ord(sign) - 97
    return OTHER if sign.isalpha() else NONE


def _class_table() -> np.ndarray:
    """Class of each code point of the basic plane; those beyond count as no letter."""
    return np.array([letter_class(chr(c)) if not 0xD800 <= c < 0xE000 else NONE for c in range(1 << 16)], dtype=np.int32)


def count_letters(docs: DataFrame) -> np.ndarray:
    """Counts of three classes in a row over all texts; a task sends a row per combination at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = _class_table(), np.zeros(CLASSES**3, dtype=np.int64)
        for piece in slices(batches, most=1 << 20):
            for text in piece.column("text").to_pylist():
                points = np.frombuffer(f" {text} ".lower().encode("utf-32-le"), "<u4")
                row = classes[np.where(points < 1 << 16, points, 0)]
                total += np.bincount((row[:-2] * CLASSES + row[1:-1]) * CLASSES + row[2:], minlength=CLASSES**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["gram", "n"])

    grams = short_batches(docs).select(text_of().alias("text")).mapInArrow(tidy(run), "gram bigint, n bigint")
    out = np.zeros(CLASSES**3)
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most 28 ** 3 rows
        out[row.gram] = row.n
    return out.reshape(CLASSES, CLASSES, CLASSES)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Minus the logarithm of the chance of a class after two others, smoothed by shorter contexts."""
    single = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + CLASSES)
    pairs = counts.sum(axis=0)
    double = (pairs + 20 * single) / (pairs.sum(axis=1, keepdims=True) + 20)
    triple = (counts + 20 * double[None]) / (counts.sum(axis=2, keepdims=True) + 20)
    return -np.log(triple)


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """Columns of what each run of a sign may stand for, with costs; a blank is nothing or ends a word."""
    apart = len(token) > 2 and all((c in SEPARATORS) == bool(n % 2) for n, c in enumerate(token))
    columns = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        sign, length = run[1], len(run[0])
        if sign == " ":
            columns.append([("", LEFT_OUT), (" ", LEFT_OUT)])
            continue
        if apart and sign in SEPARATORS:
            columns.append([("", LEFT_OUT)])
            continue
        read = [(sign, 0.0)] + [(c, SIGN) for c in LEET.get(sign, "")]
        column = [(c, cost) for c, cost in read]
        if length > 1:
            column += [(2 * c, cost + (0 if length == 2 else DOUBLE)) for c, cost in read]
        columns.append(column)
    return columns


def restore(token: str, costs: np.ndarray) -> str:
    """The cheapest reading of a token, by Viterbi over the last two letters."""
    best = {(NONE, NONE): (0.0, "")}
    for column in _lattice(token):
        nxt: dict[tuple[int, int], tuple[float, str]] = {}
        for state, (cost, read) in best.items():
            for signs, extra in column:
                (a, b), total = state, cost + extra
                for sign in signs:
                    c = letter_class(sign)
                    total += costs[a, b, c]
                    a, b = b, c
                known = nxt.get((a, b))
                if known is None or (total, read + signs) < known:
                    nxt[a, b] = (total, read + signs)
        best = nxt
    return min((cost + costs[a, b, NONE], read) for (a, b), (cost, read) in best.items())[1]


def words_of(token: str, costs: np.ndarray) -> list[str]:
    """The word or words that a lower-case token may be: itself without signs around, and as restored."""
    core = _EDGE.sub("", token.replace(" ", "."))
    out = [core] if core else []
    if core and _DISGUISED.search(core):
        read = restore(core, costs)
        out += [read] if read != core else []
    return out


def tokens(text: str) -> set[str]:
    """Distinct lower-case tokens, and runs of letters that are set apart by white space as one, with a blank between two."""
    low = text.lower()
    return set(low.split()) | {" ".join(m[0].split()) for m in _APART.finditer(low)}


def evidence(word: str) -> list[str]:
    """The word itself, marked by a blank at its end, and its beginnings."""
    return [word + " ", *{word[:n] for n in BEGINNINGS if len(word) >= n}] if len(word) >= 3 else []


def hidden(token: str, costs: np.ndarray) -> set[str]:
    """Evidence beside that of ``words_of``: a letter doubled, and words in a run of letters set apart by white space.

    Nothing tells where a word of such a run begins, so beginnings count from each of its letters, whole words where the
    character model sees them.
    """
    core = _EDGE.sub("", token)
    read = restore(core.replace(" ", "."), costs) if " " in core else core
    reads = [read]
    if _DOUBLED.search(read) and not _DISGUISED.search(read):
        reads.append(restore(read, costs))
    if " " not in core:
        return {e for w in reads[1:] if w != core for e in evidence(w)}
    out = {w[k : k + n] for w in reads for n in BEGINNINGS for k in range(len(w) - n + 1)}
    return out | {e for w in restore(core, costs).split() for e in evidence(w)}


@dataclass
class Model:
    """Rules with the chance that a text that holds one is toxic, the rate without any, and the character model."""

    rules: dict[str, float]
    base: float
    costs: np.ndarray
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def _matched(self, token: str) -> tuple[str, ...]:
        found = {e for w in words_of(token, self.costs) for e in evidence(w)} | hidden(token, self.costs)
        out = found & self.rules.keys()
        if len(self.known) > MOST_TOKENS:
            self.known.clear()
        self.known[token] = tuple(out)
        return self.known[token]

    def matched(self, text: str) -> set[str]:
        out: set[str] = set()
        for token in tokens(text):
            found = self.known.get(token)
            out.update(found if found is not None else self._matched(token))
        return out

    def score(self, text: str) -> float:
        clean = 1 - self.base
        for rule in sorted(self.matched(text)):
            clean *= 1 - self.rules[rule]
        return 1 - clean


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(id_text(column)), F.lit(3)) == 1


def _sample(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of either label, none held out, those whose id hashes lowest."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("lot", F.xxhash64("doc_id"))
    lots = [rows.where(F.col("toxic") == k).orderBy("lot", "doc_id").limit(most) for k in (0, 1)]
    return stored(lots[0].unionByName(lots[1]).select("doc_id", "toxic"), "labelled")


@dataclass(frozen=True)
class Candidate:
    """What speaks for a rule: the toxic documents that hold it, their words that match it, and the number of other documents."""

    documents: frozenset
    words: int
    others: float

    @property
    def bursts(self) -> bool:
        return self.words >= BURST * len(self.documents)

    @property
    def precision(self) -> float:
        return (len(self.documents) + 0.5) / (len(self.documents) + self.others + 1)

    @property
    def good(self) -> bool:
        n = len(self.documents)
        return n > 0 and (n >= LEAST_DOCUMENTS or self.bursts) and n >= LEAST_PRECISION * (n + self.others)


def choose(candidates: dict[str, Candidate], toxic: set) -> dict[str, float]:
    """Rules with the chance that a text that holds one is toxic."""
    left, rules = set(toxic), {}

    def rank(name: str) -> tuple:
        c = candidates[name]
        return (c.others - len(c.documents & left), -c.words, len(name), name)

    # A rank only ever gets worse, so one that is still the same when it comes up is the best of all.
    heap = [rank(name) for name, c in candidates.items() if c.good]
    heapq.heapify(heap)
    while left and heap:
        name = heap[0][-1]
        c = candidates[name]
        if len(c.documents & left) < (1 if c.bursts else LEAST_NEW):
            heapq.heappop(heap)
        elif (now := rank(name)) != heap[0]:
            heapq.heapreplace(heap, now)
        else:
            heapq.heappop(heap)
            rules[name] = c.precision
            left -= c.documents
    sure = max(8, math.ceil(0.02 * len(toxic)))
    for name, c in sorted(candidates.items(), key=lambda x: (len(x[0]), x[0])):
        begun = name in rules or any(name[:n] in rules for n in BEGINNINGS if not name[:n].endswith(" "))
        if c.good and len(c.documents) >= sure and not c.others and not begun:
            rules[name] = c.precision
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """A model from all documents' letters and a bounded sample of labelled rows."""
    costs = letter_costs(count_letters(docs))
    sample = _sample(labels, most)
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * most rows at most
    texts = stored(texts.select("doc_id", "toxic", "text"), "labelled-texts")
    sizes = {row.toxic: row.n for row in texts.groupBy("toxic").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, 0.0, costs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            seen: list[Counter] = [Counter(), Counter(), Counter()]  # other documents, toxic ones, words of toxic ones
            for toxic, text in zip(piece.column("toxic").to_pylist(), piece.column("text").to_pylist(), strict=True):
                found = tokens(text)
                own = Counter(e for w in {w for t in found for w in words_of(t, costs)} for e in evidence(w))
                own |= Counter({e for t in found for e in hidden(t, costs)})  # no words of their own
                seen[toxic].update(own.keys())
                if toxic:
                    seen[2].update(own)
            names = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in (seen[1], seen[0], seen[2])]]
            yield pa.RecordBatch.from_arrays(columns, ["candidate", "toxic", "other", "words"])

    # The share of either label among all labelled rows that aren't held out.
    full = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("toxic").count()
    full = {row["toxic"]: row["count"] for row in full.collect()}
    weight = full[0] / full[1] * sizes[1] / sizes[0]
    counted = texts.select("toxic", "text").mapInArrow(tidy(count), "candidate string, toxic bigint, other bigint, words bigint")
    counted = counted.groupBy("candidate").agg(*[F.sum(c).alias(c) for c in ("toxic", "other", "words")])
    held = (F.col("toxic") >= LEAST_DOCUMENTS) | (F.col("words") >= BURST * F.col("toxic"))
    likely = held & (F.col("toxic") > 0) & (F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + weight * F.col("other")))
    best = counted.where(likely).collect()  # words of the sample's toxic documents
    numbers = {row.candidate: n for n, row in enumerate(best)}
    finder = Model({row.candidate: 0.0 for row in best}, 0.0, costs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            found = [sorted(numbers[e] for e in finder.matched(t)) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "found"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.where("toxic = 1").select("doc_id", "text").mapInArrow(tidy(find), f"doc_id {kind}, found array<int>").collect()  # the sample's
    hits: list[set] = [set() for _ in best]
    for row in rows:
        for n in row.found:
            hits[n].add(row.doc_id)
    rules = choose({r.candidate: Candidate(frozenset(own), r.words, weight * r.other) for r, own in zip(best, hits, strict=True)}, {row.doc_id for row in rows})
    chosen = {numbers[name] for name in rules}
    missed = sum(1 for row in rows if chosen.isdisjoint(row.found)) / len(rows)
    odds = (missed * full[1] + 0.5) / (full[0] + full[1] + 1)
    return Model(rules, min(odds, LIMIT / 2), costs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents' rows with ``score`` and ``predicted``; input columns of these names are replaced."""
    own = Model(model.rules, model.base, model.costs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            scores = [own.score(t or "") for t in piece.column("text").to_pylist()]
            columns = [*[piece.column(c) for c in names], pa.array(scores, pa.float64()), pa.array([int(s >= LIMIT) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted"])

    rows = short_batches(docs).drop("score", "predicted")
    names = rows.columns
    return rows.mapInArrow(tidy(run), StructType([*rows.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """The documents that aren't rejected, all input columns. Only the text goes to Python, and a number comes back."""
    model = fit(docs, labels, most)

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(model.rules, model.base, model.costs)
        for batch in batches:
            yield pa.array([own.score(t.as_py() or "") for t in batch], pa.float64())

    chance = F.arrow_udf(DoubleType())(tidy(scored))
    return short_batches(docs).where(chance(F.col("text").cast("string")) < LIMIT)

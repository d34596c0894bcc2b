"""Repair of a conversation's structure: the cheapest edits that give roles of the form ``(s?(ua)+)?``.

Each row of a conversation becomes one symbol, its role's initial and its first fault: blank (white space only), duplicate
(role and text seen earlier), truncated (the last character isn't one of ``.!?``). Keeping a row is free, a new role,
user or assistant, costs 3, deleting 4, an empty turn put in anywhere 3. Blank and duplicate rows have to go, and a
truncated one that stays costs 3 more.

1. The symbol sequences of a batch are compressed by Re-Pair: the most frequent pair of neighbours becomes a rule,
   until no pair occurs twice. Rules are shared by all conversations that a worker sees.
2. Every symbol has a min-plus transfer matrix over the states of the grammar of roles: cost and audit of the cheapest
   way from one state to another. A rule's matrix is the product of its two sides' matrices, evaluated once, bottom-up.
   An audit is a rope, a leaf or the two ropes it was joined from, so no rule copies its text.
3. A conversation is a row vector times the matrices of its compressed sequence, then the turns put in at its end.

Of equally cheap audits the one that comes first in ASCII order counts. Matrices may settle that choice early: two audits of the
same rows and the same cost are never one the beginning of the other, since what is longer puts more turns in and costs more, so whatever
follows keeps their order. Ropes carry a hash and a length, and are compared by going down to where they differ.

Edge cases: a null turn comes first, a null role or text is the empty one, a null ``conv_id`` is a conversation of its
own. Rows of one turn go by role, then text. A role with another initial than s, u, a can't be kept. Very long texts stay
in the JVM; only symbols, one character a row, go to Python. A conversation is one row of the result, so the longest has to
fit a task. An empty table gives an empty one; other columns aren't read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

#: Fixed costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user's, after an assistant's. The first and the last accept.
STATES = 4
ACCEPTING = (0, 3)
#: State that each role leads to from each state, None where the grammar forbids it.
STEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: Symbols: the initial of a sound row (x for other roles), in upper case if it is truncated, ``-`` if it has to go.
SYMBOLS = "suaxSUAX-"
#: Rules that a worker keeps.
MOST_RULES = 1 << 17

_PRIME = (1 << 61) - 1
_BASE = 1_000_003


class Rope:
    """An audit: a single edit, or two ropes in a row."""

    __slots__ = ("hash", "left", "length", "right", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.length, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * _BASE + ord(c)) % _PRIME
        else:
            self.length = left.length + right.length
            self.hash = (left.hash * pow(_BASE, right.length, _PRIME) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.length:
            return other
        return Rope(left=self, right=other) if other.length else self

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                todo += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """Order of the texts; equal subtrees in equal places are skipped by their hashes."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x.length == y.length and x.hash == y.hash:
                continue
            if x.left is None and y.left is None:
                n = min(x.length, y.length)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                a += [Rope(x.text[n:])] * (x.length > n)
                b += [Rope(y.text[n:])] * (y.length > n)
            elif y.left is None or (x.left is not None and x.length >= y.length):
                a += [x.right, x.left]
                b.append(y)
            else:
                a.append(x)
                b += [y.right, y.left]
        return bool(b)


Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]


def _better(a: Entry | None, b: Entry | None) -> Entry | None:
    if a is None or b is None:
        return a or b
    return a if a[0] < b[0] or (a[0] == b[0] and not b[1] < a[1]) else b


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: cheapest way through both, audits joined."""
    out: Matrix = [[None] * len(b[0]) for _ in a]
    for row, made in zip(a, out, strict=True):
        for j, first in enumerate(row):
            if first is None:
                continue
            for k, second in enumerate(b[j]):
                if second is None:
                    continue
                cost = first[0] + second[0]
                if made[k] is None or cost <= made[k][0]:
                    made[k] = _better(made[k], (cost, first[1] + second[1]))
    return out


def _insertions() -> Matrix:
    """Any number of turns put in, up to the two that the grammar can ask for between rows."""
    none: Matrix = [[(0, Rope()) if i == j else None for j in range(STATES)] for i in range(STATES)]
    one: Matrix = [[None] * STATES for _ in range(STATES)]
    for role in "ua":
        for i, j in enumerate(STEPS[role]):
            if j is not None:
                one[i][j] = (INSERT, Rope("I"))
    out = none
    for _ in range(2):
        step = times(out, one)
        out = [[_better(out[i][j], step[i][j]) for j in range(STATES)] for i in range(STATES)]
    return out


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """Turns put in before a row, then its own edit."""
    edit: Matrix = [[(DELETE, Rope("D")) if i == j else None for j in range(STATES)] for i in range(STATES)]
    more = TRUNCATED if symbol.isupper() else 0
    for initial, cost, name in (("u", REROLE, "R"), ("a", REROLE, "R"), (symbol.lower(), 0, "K")):
        if symbol != "-" and initial in STEPS:
            for i, j in enumerate(STEPS[initial]):
                if j is not None:
                    edit[i][j] = _better(edit[i][j], (cost + more, Rope(name)))
    return times(INSERTIONS, edit)


class Grammar:
    """Rules that Re-Pair makes, each with its transfer matrix."""

    def __init__(self) -> None:
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices: list[Matrix] = [symbol_matrix(s) for s in SYMBOLS]

    def rule(self, pair: tuple[int, int]) -> int:
        if pair not in self.rules:
            self.rules[pair] = len(self.matrices)
            self.matrices.append(times(self.matrices[pair[0]], self.matrices[pair[1]]))
        return self.rules[pair]

    def compress(self, sequences: list[str]) -> list[list[int]]:
        """Re-Pair over all sequences at once; pairs never reach across two of them."""
        at: list[int] = []
        for s in sequences:
            at += [SYMBOLS.index(c) for c in s]
            at.append(-1)
        n = len(at)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        places: dict[tuple[int, int], set[int]] = {}

        def pair(k: int) -> tuple[int, int] | None:
            if k < 0 or at[k] < 0 or right[k] >= n or at[right[k]] < 0:
                return None
            return at[k], at[right[k]]

        def note(k: int) -> None:
            found = pair(k)
            if found:
                own = places.setdefault(found, set())
                own.add(k)
                if len(own) > 1:
                    heapq.heappush(heap, (-len(own), found))

        def forget(k: int) -> None:
            found = pair(k)
            if found in places:
                places[found].discard(k)

        heap: list[tuple[int, tuple[int, int]]] = []
        for k in range(n):
            found = pair(k)
            if found:
                places.setdefault(found, set()).add(k)
        heap = [(-len(own), found) for found, own in places.items() if len(own) > 1]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            count, best = heapq.heappop(heap)
            own = places.get(best, ())
            if len(own) != -count:  # an older entry; the pair has a newer one if it still counts
                if 1 < len(own) < -count:
                    heapq.heappush(heap, (-len(own), best))
                continue
            name = self.rule(best)
            for k in sorted(own):
                if gone[k] or pair(k) != best:
                    continue  # overlapped by the occurrence before it
                other = right[k]
                for near in (left[k], k, other):
                    forget(near)
                gone[other] = True
                at[k], right[k] = name, right[other]
                if right[k] < n:
                    left[right[k]] = k
                note(left[k])
                note(k)
            places.pop(best, None)
        out: list[list[int]] = [[]]
        for k in range(n):
            if at[k] < 0:
                out.append([])
            elif not gone[k]:
                out[-1].append(at[k])
        return out[:-1]

    def repair(self, sequences: list[str]) -> list[Entry]:
        """Cost and audit of each sequence."""
        out = []
        for sequence in self.compress(sequences):
            way: Matrix = [[(0, Rope()), *[None] * (STATES - 1)]]
            for symbol in sequence:
                way = times(way, self.matrices[symbol])
            ends = times(way, INSERTIONS)[0]
            best = None
            for state in ACCEPTING:
                best = _better(best, ends[state])
            out.append(best)
        return out


def _picks(audit: str, symbols: str) -> list[dict]:
    """Row and new role of every turn of the repaired conversation; no row for a turn put in, no role for a kept one."""
    turns = sum(c != "D" for c in audit)
    out, row, odd = [], 0, turns % 2
    for c in audit:
        if c != "D":
            role = "user" if (len(out) + odd) % 2 == 0 else "assistant"
            out.append({"row": None if c == "I" else row, "role": None if c == "K" else role})
        row += c != "I"
    return out


_PICK = StructType([StructField("row", IntegerType()), StructField("role", StringType())])
_RESULT = StructType([StructField("cost", LongType()), StructField("audit", StringType()), StructField("picks", ArrayType(_PICK))])


@F.pandas_udf(_RESULT)
def _repaired(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    grammar = Grammar()
    for symbols in batches:
        if len(grammar.matrices) > MOST_RULES:
            grammar = Grammar()
        distinct = symbols.unique().tolist()
        known = {}
        for sequence, (cost, rope) in zip(distinct, grammar.repair(distinct), strict=True):
            audit = str(rope)
            known[sequence] = (cost, audit, _picks(audit, sequence))
        yield pd.DataFrame([known[s] for s in symbols], columns=["cost", "audit", "picks"])


_WHITE = r"[\x20\x09-\x0D]"


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation.

    Columns: ``conv_id``, ``n_turns``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, and
    ``repaired``, the turns as ``role`` and ``text``. Counts and gaps describe the rows as they came.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?]{_WHITE}*\z"), "truncated")
        .otherwise("")
    )
    initial = _initial(F.col("role"))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    row = F.struct("turn", "role", "text", "nth", "fault", "symbol")
    grouped = rows.withColumn("fault", fault).withColumn("symbol", symbol).groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    count = lambda f: F.size(F.filter("rows", lambda r: r["fault"] == f)).cast("bigint")
    turns = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    gaps = F.when(F.size(turns) == 0, 0).otherwise(F.array_max(turns) - F.array_min(turns) + 1 - F.size(F.array_distinct(turns)))
    initials = F.transform("rows", lambda r: _initial(r["role"]))
    pairs = F.zip_with(F.slice(initials, F.lit(1), F.size("rows") - 1), F.slice(initials, 2, F.size("rows")), lambda a, b: F.concat(a, b))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("bigint")
    found = grouped.withColumn("found", _repaired(F.array_join(F.transform("rows", lambda r: r["symbol"]), "")))

    def turn(pick: Column) -> Column:
        source = F.get(F.col("rows"), pick["row"])
        return F.struct(F.coalesce(pick["role"], source["role"]).alias("role"), F.coalesce(source["text"], F.lit("")).alias("text"))

    return found.select(
        "conv_id",
        F.size("rows").cast("bigint").alias("n_turns"),
        gaps.cast("bigint").alias("gaps"),
        *[count(f).alias(f) for f in ("blank", "duplicate", "truncated")],
        illegal.alias("illegal"),
        "found.cost",
        "found.audit",
        F.transform("found.picks", turn).alias("repaired"),
    )

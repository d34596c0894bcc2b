"""Exact quantiles of many columns at any size.

The built-in exact ``percentile`` gathers every distinct value of a column in one task. Here each
wanted rank is fenced in: an approximate quantile names two values around the rank, one pass counts the rows below, at and between them,
and the search goes on inside the part that holds the rank, which is some thousand times smaller.
A part of at most ``exact_rows`` rows is sorted. The counts decide, not the sketch, so the result is
exact. One job serves all columns and ranks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import number

# Up to this many rows a fence is read off.
EXACT_ROWS = 100_000
ACCURACY = 2_000


@dataclass
class _Fence:
    """The rows of a column strictly between ``low`` and ``high``, and the ranks sought there.

    ``below`` rows come before them; ``inside`` rows are between, None as long as unknown.
    """

    column: str
    wanted: list  # ranks among all rows; shares 0..1 before the rows are counted
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int | None = None

    def value(self, df: DataFrame) -> Column:
        """The column where it lies between the fences, else null."""
        value = number(df, self.column)
        keep = F.lit(True)
        if self.low is not None:
            keep = keep & (value > self.low)
        if self.high is not None:
            keep = keep & (value < self.high)
        return F.when(keep, value)

    def shares(self) -> list[float]:
        if self.inside is None:
            return self.wanted
        return [(rank - self.below) / max(self.inside - 1, 1) for rank in self.wanted]


def _cuts(df: DataFrame, open_fences: list[_Fence]) -> list[tuple[int, list[float]]]:
    """For each fence, its rows, and values close to and around each rank sought."""
    margin = 2.0 / ACCURACY
    guesses = [F.count(fence.value(df)).alias(f"n{i}") for i, fence in enumerate(open_fences)]
    for i, fence in enumerate(open_fences):
        ends = sorted({min(1.0, max(0.0, s + m)) for s in fence.shares() for m in (-margin, margin)})
        guesses.append(F.percentile_approx(fence.value(df), ends, ACCURACY).alias(f"g{i}"))
    row = df.agg(*guesses).first()
    return [(row[i], sorted(set(row[len(open_fences) + i] or []))) for i in range(len(open_fences))]


def _counts(df: DataFrame, open_fences: list[_Fence], cuts: list[list[float]]) -> list[dict[int, int]]:
    """Rows per region: 0 before the first cut, 1 at it, 2 between it and the second, and so on."""
    # Values first, comparisons after: a short expression per comparison keeps the code small.
    values = df.select(*[fence.value(df).alias(f"v{i}") for i, fence in enumerate(open_fences)])
    regions = []
    for i, at in enumerate(cuts):
        value = F.col(f"v{i}")
        region = F.when(value.isNull(), -1)
        for j, cut in enumerate(at):
            region = region.when(value < cut, 2 * j).when(value == cut, 2 * j + 1)
        regions.append(region.otherwise(2 * len(at)).alias(f"r{i}"))
    # Fences are counted in threes, so a task sends on at most some thousand combinations of regions.
    names = [f"r{i}" for i in range(len(cuts))]
    threes = [names[i : i + 3] for i in range(0, len(names), 3)]
    packed = F.array(
        *[
            F.struct(F.lit(3 * t).alias("first"), *[F.col(n).alias(p) for n, p in zip(three, "abc")],
                     *[F.lit(-1).alias(p) for p in "abc"[len(three) :]])
            for t, three in enumerate(threes)
        ]
    )
    combined = values.select(*regions).select(F.inline(packed)).groupBy("first", "a", "b", "c").count()
    each = F.array(*[F.struct((F.col("first") + i).alias("fence"), F.col(p).alias("region")) for i, p in enumerate("abc")])
    rows = (
        combined.select(F.inline(each), "count").where("region >= 0").groupBy("fence", "region").agg(F.sum("count")).collect()
    )
    counted: list[dict[int, int]] = [{} for _ in open_fences]
    for fence, region, count in rows:
        counted[fence][region] = count
    return counted


def _settle(fence: _Fence, at: list[float], counted: dict[int, int], found: dict) -> list[_Fence]:
    """Ranks that fall on a cut are found; the others go on between two cuts."""
    narrower: dict[int, _Fence] = {}
    for rank in fence.wanted:
        before = fence.below
        for region in sorted(counted):
            if rank < before + counted[region]:
                break
            before += counted[region]
        if region % 2:
            found[fence.column, rank] = at[region // 2]
            continue
        if region not in narrower:
            low = at[region // 2 - 1] if region else fence.low
            high = at[region // 2] if region // 2 < len(at) else fence.high
            narrower[region] = _Fence(fence.column, [], low, high, before, counted[region])
        narrower[region].wanted.append(rank)
    return list(narrower.values())


def _read_off(df: DataFrame, narrow: list[_Fence], found: dict) -> None:
    """Few rows are left in each fence: sort them, each fence by itself."""
    values = F.array(*[F.struct(F.lit(i).alias("fence"), fence.value(df).alias("x")) for i, fence in enumerate(narrow)])
    kept = df.select(F.inline(values)).where(F.col("x").isNotNull()).groupBy("fence").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    places = F.create_map(
        *[y for i, f in enumerate(narrow) for y in (F.lit(i), F.array(*[F.lit(rank - f.below) for rank in f.wanted]))]
    )
    picked = kept.select("fence", F.transform(places[F.col("fence")], lambda at: F.get("xs", at.cast("int"))).alias("picked"))
    for row in picked.collect():
        for rank, value in zip(narrow[row.fence].wanted, row.picked, strict=True):
            found[narrow[row.fence].column, rank] = value


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact_rows: int = EXACT_ROWS
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; missing values are left out."""
    columns, probs = list(columns), list(probs)
    if not columns:
        return {}
    df = df.select(*[number(df, c).alias(c) for c in columns])
    found: dict[tuple[str, int], float] = {}
    sizes: dict[str, int] = {}
    todo = [_Fence(c, probs) for c in columns]
    narrow: list[_Fence] = []
    while todo:
        cuts = []
        for fence, (rows, at) in zip(todo, _cuts(df, todo), strict=True):
            if fence.inside is None:
                sizes[fence.column] = fence.inside = rows
                places = [(rows - 1) * p for p in probs if rows]
                fence.wanted = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})
            cuts.append(at)
        # A whole column may be few rows already.
        narrow += [f for f in todo if f.wanted and f.inside <= exact_rows]
        wide = [(f, at) for f, at in zip(todo, cuts, strict=True) if f.wanted and f.inside > exact_rows]
        ahead = []
        if wide:
            todo, cuts = map(list, zip(*wide, strict=True))
            for fence, at, counted in zip(todo, cuts, _counts(df, todo, cuts), strict=True):
                ahead += _settle(fence, at, counted, found)
        narrow += [f for f in ahead if f.inside <= exact_rows]
        todo = [f for f in ahead if f.inside > exact_rows]
    if narrow:
        _read_off(df, narrow, found)

    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = [None] * len(probs)
        for i, p in enumerate(probs if sizes[c] else []):
            place = (sizes[c] - 1) * p
            low, high = found[c, math.floor(place)], found[c, math.ceil(place)]
            result[c][i] = low + (high - low) * (place - math.floor(place))
    return result


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], approximate: bool = False
) -> dict[str, list[float | None]]:
    """Quantiles as scalars for use in later plans; ``approximate`` is one pass, error 1/2000 of the rows."""
    if not approximate:
        return exact_quantiles(df, columns, probs)
    if not columns:
        return {}
    row = df.agg(
        *[F.percentile_approx(number(df, c), list(probs), ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(columns)}


def fences(quartile_1: float, quartile_3: float) -> tuple[float, float]:
    reach = 1.5 * (quartile_3 - quartile_1)
    return quartile_1 - reach, quartile_3 + reach

"""Mixing sources to target weights by Poisson replication.

Every document of a source gets the same mean number of copies, so that the source has its share of
the result on average. The number of copies of one document is drawn by inverting the Poisson
distribution at a number that only the seed and the document's id decide: runs repeat, and a
document keeps its copies when others come or go at the same rate.

Edge cases: a null source is a source of its own, as is an empty one. A null id draws as the empty
text. Rows that repeat an id draw the same number each. A null or empty text is a document like
any other. Sources without a weight get ``other``. An empty table gives an empty one. Input columns
named like an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import id_text, small_side, stored, unit_draw

#: Up to so many sources, the table of distributions is sent to every task.
MOST_BROADCAST = 2000
ADDED = ("copy", "copies", "shuffle_key")


def _distribution(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, until what is left is below a double's last place.

    Terms are taken through logarithms, so that high rates don't underflow.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")

    def step(state: Column, k: Column) -> Column:
        term = state["term"] + F.log(rate / k)
        total = state["total"] + F.exp(term)
        return F.struct(term.alias("term"), total.alias("total"), F.concat(state["sums"], F.array(total)).alias("sums"))

    first = F.exp(-rate)
    start = F.struct((-rate).alias("term"), first.alias("total"), F.array(first).alias("sums"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["sums"])


def mean_copies(
    docs: DataFrame, weights: Mapping[str, float] | None = None, other: float = 0.0, total_rows: int | None = None
) -> DataFrame:
    """One row per source: its rows, its weight and the mean copies of each of its documents.

    Without ``weights`` all sources weigh the same. ``total_rows`` is the wanted size of the result,
    by default that of the input.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("source_rows"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]) if weights else None
        weight = F.coalesce(given[F.col("source")], F.lit(float(other))) if weights else F.lit(float(other))
    counts = counts.withColumn("weight", weight)
    all_rows, all_weight = counts.agg(F.sum("source_rows"), F.sum("weight")).first()
    target = float((all_rows or 0) if total_rows is None else total_rows)
    share = F.col("weight") / F.lit(float(all_weight)) if all_weight else F.lit(0.0)
    return counts.select("source", "source_rows", "weight", (F.lit(target) * share / F.col("source_rows")).alias("rate"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    other: float = 0.0,
    total_rows: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The documents, each as often as drawn, in one global random order.

    Adds ``copy`` (1 to ``copies``), ``copies`` and ``shuffle_key``, by which the result is sorted.
    """
    docs = docs.drop(*ADDED)
    rates = mean_copies(docs, weights, other, total_rows)
    rates = stored(rates.select("source", _distribution(F.col("rate")).alias("sums")), "mix-rates")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(small_side(rates, MOST_BROADCAST), F.col("row.source").eqNullSafe(F.col("source")))
    drawn = joined.withColumn("draw", unit_draw(F.lit(f"copies-{seed}"), id_text("row.doc_id")))
    drawn = drawn.withColumn("copies", F.size(F.filter("sums", lambda x: x <= F.col("draw"))))
    copied = drawn.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat_ws(":", F.lit(f"order-{seed}"), id_text("row.doc_id"), F.col("copy").cast("string")))
    return copied.select("row.*", "copy", "copies", key.alias("shuffle_key")).orderBy("shuffle_key", "copy")

"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard. At each level every child draws a number from the
document's id and the child's name; minus its logarithm, over the child's weight, is the child's
bid, and the lowest bid wins. A child wins in proportion to its weight, and a change of one weight
moves documents only into or out of that child: movement is confined to the subtrees whose weights change.

The law of the result is ``key``: id and shard count decide. Shards beyond the first layout come as
regions of their own, so one more shard takes rows only into itself.

Edge cases: a null id draws as the empty text. Rows that repeat an id share a shard and get slots of
their own. A null text has no bytes. An empty table gives an empty one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.llm.common import id_text, text_of, unit_draw

RACKS, SHARDS = 2, 5
#: Shards of the first layout; each later shard is a region of its own.
LAYOUT = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Parts that a shard is numbered in.
CHUNKS = 256

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def tree(shards: int, layout: int = LAYOUT) -> dict[str, dict[str, dict[int, float]]]:
    """Region, rack and shard with weight: racks of five, regions of two racks, then single shards."""
    out: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        region, rack = (f"r{shard // (RACKS * SHARDS)}", f"k{shard // SHARDS}") if shard < layout else (f"s{shard}", f"s{shard}")
        out.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return out


def _descend(children: Mapping[str, Mapping[str, float]], node: Column) -> Column:
    """The child of ``node`` with the lowest bid; ``children`` has the weights of each node's children by name."""
    pair = lambda name, weight: F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"))
    listed = [(k, F.array(*[pair(n, w) for n, w in sorted(v.items())])) for k, v in sorted(children.items())]
    below = F.create_map(*[x for k, v in listed for x in (F.lit(k), v)])[node]
    bid = lambda c: -F.log(F.lit(1.0) - unit_draw(c["name"], id_text())) / c["weight"]
    return F.array_min(F.transform(below, lambda c: F.struct(bid(c).alias("bid"), c["name"].alias("name"))))["name"]


def shard_of(layout: Tree) -> Column:
    """The shard of ``doc_id``: three descents, with draws only among the children of one node each."""
    regions: dict[str, dict[str, float]] = {"": {}}
    racks: dict[str, dict[str, float]] = {}
    shards: dict[str, dict[str, float]] = {}
    for region, inner in layout.items():
        for rack, leaves in inner.items():
            own = {f"{region}/{rack}/{n}": float(w) for n, w in leaves.items() if w > 0}
            if own:
                shards[f"{region}/{rack}"] = own
                racks.setdefault(region, {})[f"{region}/{rack}"] = sum(own.values())
        if region in racks:
            regions[""][region] = sum(racks[region].values())
    rack = _descend(racks, _descend(regions, F.lit("")))
    return F.element_at(F.split(_descend(shards, rack), "/"), -1).cast("int")


def place(docs: DataFrame, shards: int = LAYOUT, chunks: int = CHUNKS) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``slot`` numbers the rows of a shard from 0 without gaps. A shard is numbered in ``chunks`` parts by
    a hash of the id, size and checksum, so that no task holds a whole shard, nor all rows that repeat an id or lack one.
    """
    rows = docs.select("doc_id", F.octet_length(text_of()).cast("bigint").alias("bytes"), F.crc32(text_of()).alias("text_crc32"))
    rows = rows.select(
        "doc_id",
        (F.col("bytes") + ROW_BYTES).alias("size"),
        "text_crc32",
        F.lit("key").alias("law"),
        shard_of(tree(shards)).alias("shard"),
        shard_of(tree(shards + 1)).alias("grown_shard"),
        F.pmod(F.xxhash64(id_text(), F.col("bytes"), F.col("text_crc32")), F.lit(chunks)).cast("int").alias("chunk"),
    )
    # A row per shard and chunk: bounded by the arguments.
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("shard").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_slot")
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    placed = numbered.join(F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("chunk") == F.col("c")))
    slot = (F.col("first_slot") + F.col("place")).alias("slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", slot, "grown_shard")

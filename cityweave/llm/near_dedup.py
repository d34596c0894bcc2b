"""Near duplicates: one-permutation MinHash, banded buckets, star edges, exact links.

1. A text's words are hashed from prefix sums over its bytes, five words in a row to a 64-bit shingle. Texts with
   the same set of shingles are one class, represented by its smallest id; copies end here.
2. One permutation: the range of the hash is cut into ``BINS``, and each bin keeps its smallest shingle.
   An empty bin takes the value of the first filled one in a random order of its own (optimal
   densification). ``ROWS`` bins make a band, and a class lies in one bucket per band. Two sets with a
   similarity of 0.85 share no bucket with a probability of 3e-7.
3. In every bucket one class is the centre: the one that shares its buckets with most others, which
   is the least changed of a family. Each other member gets a candidate edge to the centre only, so a bucket gives
   fewer pairs than it has members.
4. Candidates whose minima agree in at least ``FAMILY`` of all bins join families, and so a pair that lies beyond
   the limit with the centre but within it with each other is in one family. A member that agrees with the
   centre in at least ``SETTLED`` needs no more: all that agrees with it in ``CLOSE`` is near enough to the centre to
   be in the family too. Of the other members of a bucket, those outside of the family that most of
   them have are compared with all, in blocks of bounded size, and join families from ``CLOSE`` on. So any
   two classes that share a bucket and agree in ``CLOSE`` are in one family, however crowded the bucket is. Two
   sets with a similarity of 0.85 agree in less with a probability of about 1e-7.
5. Links are confirmed inside families, on full sets of shingles: members are dealt into blocks of
   bounded size, each with the family's hub, and compared by products of incidence matrices. Only a
   spanning set of links leaves a task. Members that aren't linked with the hub's component are then
   compared with all blocks of their family, also in bounded blocks; the others needn't be, since
   they are linked already.

No bucket, family or candidate list is cut off. The work of step 4 grows with the square of the members of a bucket
that are only half alike, which is what documents assembled from the same frequent lines cost. The work of step 5 grows with the family's size times the
number of members left over, which is the price of not losing a link between them.

Edge cases: a null, empty or white text has no shingles and is linked with nothing, as is a null id; such
rows are components of their own. Fewer than five words are one shingle. Rows that repeat an id
are one document with the links of all of them. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cityweave.llm.common import give_back, short_batches, slices, small_side, stored, text_of, tidy
from cityweave.llm.components import components

WORDS = 5
BANDS, ROWS = 32, 6
BINS = BANDS * ROWS
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Share of agreeing bins from which a candidate belongs to the family.
FAMILY = 0.6
#: Share from which two members of a bucket belong to one family, whatever its centre is.
CLOSE = 0.7
#: Share with the centre from which whatever is close to a member agrees with the centre in ``FAMILY``.
SETTLED = FAMILY + 1 - CLOSE
#: Members, and shingles in all, of a block.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Shingles from which on a block's memory is given back at once.
LARGE = 1 << 18
#: Rows of ids, 40 bytes each at most, that are broadcast.
SMALL = 500_000
#: Members of a block of a bucket.
BUCKET_BLOCK = 2048

_random = np.random.default_rng(20240229)
_odd = lambda n: _random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = _odd(256)
_BASE = int(_odd(1)[0])
_BACK = pow(_BASE, -1, 1 << 64)
_PLACES = _odd(max(WORDS, ROWS))
_BAND_SALT = _odd(BANDS)
_EDGES = np.array([(b << 64) // BINS for b in range(BINS)], dtype=np.uint64)
#: For each bin, the order in which it looks for a filled one.
_ORDERS = np.array([_random.permutation(BINS) for _ in range(BINS)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    white = _WHITE[data]
    begins = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    stops = np.flatnonzero(white & np.concatenate([[False], ~white[:-1]]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[_LOWER[data]] * _powers(_BASE, len(data)), dtype=np.uint64)])
    words = _mix((sums[stops] - sums[begins]) * _powers(_BACK, len(data) + 1)[begins])
    rows = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
    for k in range(WORDS):
        rows += words[k : k + len(rows)] * _PLACES[k]
    rows = _mix(rows)
    cuts = np.searchsorted(begins, ends)
    out, first = [], 0
    for cut in cuts:
        n = cut - first
        if n >= WORDS:
            out.append(np.unique(rows[first : cut - WORDS + 1]))
        else:
            short = words[first:cut] * _PLACES[:n]
            out.append(_mix(np.array([short.sum(dtype=np.uint64) + np.uint64(n)], dtype=np.uint64)) if n else np.zeros(0, np.uint64))
        first = cut
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest shingle of each bin, empty bins filled; ``shingles`` is sorted and not empty."""
    at = np.searchsorted(shingles, _EDGES)
    filled = at < np.append(at[1:], len(shingles))
    out = shingles[np.minimum(at, len(shingles) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        orders = _ORDERS[empty]
        source = orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]
        out[empty] = out[source]
    return out


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set, ``buckets`` (a key per band), ``marks`` (a byte per bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            sets = shingle_sets(piece.column("text").to_pylist())
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            found = [minima(s) for s in sets if len(s)]
            low = np.array(found, dtype=np.uint64).reshape(-1, BINS)
            keys = _mix((low.reshape(-1, BANDS, ROWS) * _PLACES[:ROWS]).sum(axis=2, dtype=np.uint64) + _BAND_SALT).view(np.int64)
            own = iter(zip(keys, low.astype(np.uint8), strict=True))
            pairs = [next(own) if len(s) else (None, None) for s in sets]
            columns = [
                piece.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([k for k, _ in pairs], pa.list_(pa.int64())),
                pa.array([None if m is None else m.tobytes() for _, m in pairs], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "buckets", "marks"])

    rows = short_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, n_shingles bigint, digest binary, buckets array<bigint>, marks binary")


def star_edges(classes: DataFrame) -> DataFrame:
    """Candidate edges ``a``, ``b`` and their ``bucket``: each member with the bucket's centre."""
    rows = classes.select("id", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(rows.hint("merge").join(shared, "bucket"), "buckets")
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = shared.hint("merge").join(weight, "id")
    centre = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("most"))
    pairs = shared.select("bucket", "id").hint("merge").join(centre, "bucket").select("bucket", F.col("id").alias("a"), (-F.col("most.minus")).alias("b"))
    return stored(pairs.where("a <> b"), "stars")


@F.pandas_udf(DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, BINS) for x in (a, b))
    return pd.Series((left == right).mean(axis=1))


# A filter on its result would else be pushed below it and work it out once more, in a second Python process per core.
_agreement = _agreement.asNondeterministic()


def _met(block: pa.Table) -> pa.Table:
    """Edges that connect what is close among the rest of a block, and between it and the others."""
    ids, family = block.column("id").to_numpy(), block.column("family").to_numpy()
    marks = np.frombuffer(b"".join(block.column("marks").to_pylist()), np.uint8).reshape(-1, BINS)
    rest = np.asarray(block.column("rest").to_pylist(), dtype=bool)
    own, other = np.flatnonzero(rest), np.flatnonzero(~rest)
    rows, columns = [own[:0]], [own[:0]]
    for k in own:
        found = other[((marks[other] == marks[k]).sum(axis=1) >= CLOSE * BINS) & (family[other] != family[k])]
        rows.append(np.full(len(found), k))
        columns.append(found)
    return _spanning(ids, np.concatenate(rows), np.concatenate(columns))


def crowded_edges(stars: DataFrame, near: DataFrame, family: DataFrame, marks: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` between close members of a bucket that neither its centre nor their families bring together."""
    settled = near.where(F.col("agreement") >= SETTLED).select("a", "b")
    left = stars.hint("merge").join(settled, ["a", "b"], "left_anti").select("bucket", F.col("a").alias("id"))
    left = left.hint("merge").join(family, "id", "left").withColumn("family", F.coalesce("family", "id"))
    left = stored(left, "unsettled")
    counted = left.groupBy("bucket", "family").agg(F.count("*").alias("n"))
    whole = counted.groupBy("bucket").agg(F.max(F.struct("n", "family")).alias("most"), F.sum("n").alias("all"))
    blocks, rests = F.ceil(F.col("all") / BUCKET_BLOCK), F.ceil((F.col("all") - F.col("most.n")) / BUCKET_BLOCK)
    whole = whole.select("bucket", F.col("most.family").alias("main"), blocks.alias("blocks"), rests.alias("rests")).where("rests > 0")
    met = left.hint("merge").join(whole, "bucket").withColumn("left", F.col("family") != F.col("main"))
    met = stored(met.select("bucket", "id", "family", "left", "blocks", "rests").hint("merge").join(marks, "id"), "crowds")
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    every = met.withColumn("block", _dealt("id", "blocks", 2)).withColumn("other", F.explode(upto("rests"))).withColumn("rest", F.lit(False))
    rest = met.where("left").withColumn("other", _dealt("id", "rests", 3)).withColumn("block", F.explode(upto("blocks"))).withColumn("rest", F.lit(True))
    columns = ["bucket", "block", "other", "id", "family", "rest", "marks"]
    found = every.select(*columns).unionByName(rest.select(*columns)).groupBy("bucket", "block", "other").applyInArrow(_met, "a bigint, b bigint")
    return stored(found.distinct(), "crowded")


def families(classes: DataFrame, stars: DataFrame) -> DataFrame:
    """``id``, ``family`` and ``degree`` (candidates near it) of every class that is near another."""
    marks = classes.select("id", "marks")
    both = stars.select("a", "b").distinct().hint("merge").join(marks.select(F.col("id").alias("a"), F.col("marks").alias("marks_a")), "a")
    both = both.hint("merge").join(marks.select(F.col("id").alias("b"), F.col("marks").alias("marks_b")), "b")
    near = both.select("a", "b", _agreement("marks_a", "marks_b").alias("agreement")).where(F.col("agreement") >= FAMILY)
    near = stored(near, "candidates")
    found = components(near, "a", "b").withColumnRenamed("component", "family")
    met = crowded_edges(stars, near, found, marks)
    near = near.select("a", "b")
    if not met.isEmpty():
        near = near.unionByName(met)
        found = components(near, "a", "b").withColumnRenamed("component", "family")
    degree = near.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return found.hint("merge").join(degree, "id")


def _similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of the two lists are linked, from intersections counted by matrix products."""
    sets = [*left, *right]
    lengths = np.array([len(s) for s in sets])
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), lengths)
    both = np.zeros((len(left), len(right)), dtype=np.float64)
    order = np.argsort(places, kind="stable")
    places, owner = places[order], owner[order]
    step = 4096
    for low in range(0, len(values), step):
        cut = slice(*np.searchsorted(places, [low, low + step]))
        seen = np.zeros((len(sets), step), dtype=np.float32)
        seen[owner[cut], places[cut] - low] = 1
        both += seen[: len(left)] @ seen[len(left) :].T
    union = lengths[: len(left), None] + lengths[None, len(left) :] - both
    if len(owner) > LARGE:
        del places, owner, order, values, seen
        give_back()
    return 100 * both >= percent * union


def _spanning(ids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> pa.Table:
    """Links that connect what the given ones connect, one fewer than members at most per component."""
    parent = np.arange(len(ids))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for a, b in zip(rows.tolist(), columns.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((ids[a], ids[b]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in column.to_pylist()]


def _inside(percent: int):
    def run(block: pa.Table) -> pa.Table:
        sets = _sets(block.column("shingles"))
        linked = np.triu(_similar(sets, sets, percent), 1)
        return _spanning(block.column("id").to_numpy(), *np.nonzero(linked))

    return run


def _across(percent: int):
    def run(block: pa.Table) -> pa.Table:
        left = np.asarray(block.column("rest").to_pylist(), dtype=bool)
        ids, sets = block.column("id").to_numpy(), _sets(block.column("shingles"))
        own, other = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(own) or not len(other):
            return _spanning(ids, own[:0], own[:0])
        rows, columns = np.nonzero(_similar([sets[k] for k in own], [sets[k] for k in other], percent))
        return _spanning(ids, own[rows], other[columns])

    return run


def _dealt(key: str, parts: str, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.col(parts))


def links(docs: DataFrame, classes: DataFrame, family: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Confirmed links ``a``, ``b`` that connect each component of each family."""
    members = family.hint("merge").join(classes.select("id", "n_shingles"), "id")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    most = F.max(F.struct("degree", (-F.col("id")).alias("minus")))
    whole = members.groupBy("family").agg(blocks.alias("blocks"), most.alias("most"))
    placed = members.hint("merge").join(stored(whole, "families-whole"), "family")
    placed = placed.select("family", "id", "blocks", (F.col("id") == -F.col("most.minus")).alias("hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            sets = [s.astype("<u8").tobytes() for s in shingle_sets(piece.column("text").to_pylist())]
            names = ["family", "id", "blocks", "hub"]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in names], pa.array(sets, pa.binary())], [*names, "shingles"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_of().alias("text"))
    # Few documents have a near one, so that the ids usually go to the texts; beyond the bound both are shuffled.
    found = texts.join(small_side(stored(placed, "placed"), SMALL), "id").select("family", "id", "blocks", "hub", "text")
    sets = stored(found.mapInArrow(tidy(run), "family bigint, id bigint, blocks bigint, hub boolean, shingles binary"), "shingles")

    every_block = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    own_block = _dealt("id", "blocks", 0)
    starred = sets.withColumn("block", F.explode(F.when(F.col("hub"), every_block).otherwise(F.array(own_block))))
    schema = "a bigint, b bigint"
    inside = stored(starred.groupBy("family", "block").applyInArrow(_inside(percent), schema), "links-inside")

    # Families of several blocks: what isn't linked with the largest component so far meets every block.
    large = sets.where("blocks > 1")
    ids = large.select("family", "id").distinct()
    known = components(inside.hint("merge").join(ids.select(F.col("id").alias("a")), "a", "left_semi"), "a", "b")
    labelled = ids.hint("merge").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    counted = labelled.groupBy("family", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("family").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all"))
    rests = F.ceil((F.col("all") - F.col("most.n")) / BLOCK).alias("rests")
    main = main.select("family", F.col("most.component").alias("main"), rests).where("rests > 0")
    marked = labelled.hint("merge").join(main, "family").select("id", (F.col("component") != F.col("main")).alias("rest"), "rests")
    large = stored(large.drop("hub").hint("merge").join(marked, "id"), "shingles-left")
    every = large.withColumn("block", own_block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rests") - 1)))
    every = every.withColumn("rest", F.lit(False))
    rest = large.where("rest").withColumn("other", _dealt("id", "rests", 1)).withColumn("block", F.explode(every_block))
    columns = ["family", "block", "other", "id", "rest", "shingles"]
    met = every.select(*columns).unionByName(rest.select(*columns))
    across = met.groupBy("family", "block", "other").applyInArrow(_across(percent), schema)
    return inside.unionByName(stored(across, "links-across"))


def find_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    rows = stored(profiles(docs), "profiles")
    some = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    first = some.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "buckets", "marks")).alias("c"))
    classes = stored(first.select("digest", F.col("c.doc_id").alias("id"), "c.n_shingles", "c.buckets", "c.marks"), "classes")
    family = stored(families(classes, star_edges(classes)), "families")
    linked = components(links(docs, classes, family, percent), "a", "b")
    own = classes.select("digest", "id").hint("merge").join(linked, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    plain = rows.select("doc_id", "n_shingles", "digest")
    out = plain.hint("merge").join(own, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: the one with the smallest id of each component, all input columns."""
    gone = find_components(docs, percent).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    gone = small_side(stored(gone, "gone"), SMALL)
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")

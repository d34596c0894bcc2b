"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when they are identical after every run of white space has become one blank.

1. *Directory.* A text's key is a 64-bit hash. The leading bits name a slot of the directory, and a bucket that holds more keys
   than its capacity is split on the next bit, which doubles the directory where needed, down to ``MAX_DEPTH`` bits; a bucket that is
   still overfull there just stays larger. Buckets in a row are dealt to owners by the bytes of their texts.
2. *Inserts.* Each row looks up its slot, goes to the owner of its bucket, and is put into the chain of its key: texts that
   share a hash are sorted by their bytes, and only equal bytes share a place in the chain. A key with more rows than a bucket has room, and more
   than one row in ``SHARE`` of the table, is hot: its texts are brought down to one row each inside every task before they move.
3. *Index.* An entry per bucket, key and place in the chain, with the smallest id and the number of rows, is written to the shared folder.
4. *Lookups.* Every row finds its entry by bucket, key and place.

Edge cases: a null text is the empty text. Rows that repeat an id are judged by their texts; rows that
repeat both are the same document, flagged alike by ``find_copies`` and left as one row by ``drop_copies``.
A null id is larger than any other; a group with null ids only keeps those. Very long texts are compared as a whole, by sorting that
spills. An empty table gives an empty one. Columns other than ``doc_id`` and ``text`` are never read by ``find_copies`` and carried
through by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.llm.common import small_side, stored, text_of

#: Runs of blank, tab, line feed, vertical tab, form feed and carriage return.
WHITE = r"[\x20\x09-\x0D]+"
#: Bits of the largest directory, which bounds it to 65,536 slots.
MAX_DEPTH = 16
#: Keys in a bucket before it is split.
CAPACITY = 1024
#: A hot key has more than one row in so many, so there are no more hot keys than that.
SHARE = 10_000
#: Bytes of text in the buckets of one owner, unless one bucket has more.
OWNED = 8 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def key_of(norm: Column, hash_bits: int = 64) -> Column:
    """The key of a normalised text; fewer bits put different texts in one chain."""
    hashed = F.xxhash64(norm)
    return hashed if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(hashed, 64 - hash_bits), 64 - hash_bits)


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, owned: int = OWNED) -> DataFrame:
    """The bucket of each slot: ``slot``, ``bucket_depth``, ``bucket``, ``owner`` from distinct ``hash`` keys with the ``bytes`` of their texts.

    A prefix is a bucket when it holds at most ``capacity`` keys, or can't be split further, and the
    prefix one bit shorter was overfull. Only prefixes that hold keys get slots. Owners are numbered along the hash.
    """
    slots = keys.select(F.shiftrightunsigned("hash", 64 - max_depth).alias("slot"), "bytes").groupBy("slot")
    slots = slots.agg(F.count("*").alias("keys"), F.sum("bytes").alias("bytes"))
    levels = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
    prefix = F.expr(f"shiftright(slot, {max_depth} - depth)")
    levels = levels.withColumn("prefix", prefix).groupBy("depth", "prefix").agg(F.sum("keys").alias("keys"), F.sum("bytes").alias("bytes"))
    parents = levels.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"), F.col("keys").alias("parent_keys"))
    first = F.expr(f"shiftleft(prefix, {max_depth} - depth)")
    buckets = (
        levels.withColumn("parent", F.shiftright("prefix", 1))
        .join(parents, ["depth", "parent"], "left")
        .where((F.col("keys") <= capacity) | (F.col("depth") == max_depth))
        .where(F.col("parent_keys").isNull() | (F.col("parent_keys") > capacity))
        .withColumn("first", first)
    )
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket, 2 ** max_depth at most
    owner = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / owned).alias("owner")
    last = F.expr(f"shiftleft(prefix + 1, {max_depth} - depth) - 1")
    owners = buckets.select("first", last.alias("last"), F.col("depth").alias("bucket_depth"), F.col("prefix").alias("bucket"), owner)
    return owners.select(F.explode(F.sequence("first", "last")).alias("slot"), "bucket_depth", "bucket", "owner")


class Index:
    """A table's directory, its hot keys, and the rows dealt to the owners of their buckets."""

    def __init__(self, docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, hash_bits: int = 64, share: int = SHARE) -> None:
        self.docs, self.max_depth, self.hash_bits = docs, max_depth, hash_bits
        key = key_of(normalised(text_of()), hash_bits).alias("hash")
        self.keys = stored(docs.select("doc_id", key, F.octet_length(text_of()).alias("bytes")), "dedup-keys")
        counts = stored(self.keys.groupBy("hash").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")), "dedup-counts")
        total = self.keys.count()
        hot = counts.where(F.col("rows") > max(capacity, total / share))
        self.hot = stored(hot.select("hash"), "dedup-hot")  # ``share`` rows at most
        cold = counts.select("hash", F.when(F.col("rows") > max(capacity, total / share), 0).otherwise(F.col("bytes")).alias("bytes"))
        self.slots = stored(directory(cold, capacity, max_depth), "dedup-directory")  # 2 ** max_depth rows at most
        self.owners = 1 + (self.slots.agg(F.max("owner")).first()[0] or 0)

    def looked_up(self, rows: DataFrame) -> DataFrame:
        """Rows with the bucket that the directory names for their ``hash``."""
        slotted = rows.withColumn("slot", F.shiftrightunsigned("hash", 64 - self.max_depth))
        return slotted.join(F.broadcast(self.slots), "slot").drop("slot")

    def _hashed(self, payload: Column) -> DataFrame:
        rows = self.docs.select(payload.alias("row"), text_of().alias("text"), F.col("doc_id").alias("id"))
        return rows.withColumn("hash", key_of(normalised(F.col("text")), self.hash_bits))

    def inserted(self, payload: Column) -> DataFrame:
        """The rows of all keys but the hot ones at the owners of their buckets, with their place in the chain of their key.

        Columns: ``row`` (the payload), ``id``, ``norm``, ``hash``, ``bucket_depth``, ``bucket``, ``owner``, ``chain``.
        """
        rows = self._hashed(payload).join(F.broadcast(self.hot), "hash", "left_anti")
        placed = self.looked_up(rows).repartition(self.owners, "owner").withColumn("norm", normalised(F.col("text"))).drop("text")
        return placed.withColumn("chain", F.dense_rank().over(Window.partitionBy("owner", "bucket", "hash").orderBy("norm")))

    def inserted_hot(self, payload: Column) -> DataFrame:
        """A row per text of a hot key: the payload of its first row and the number of its rows."""
        rows = self._hashed(payload).join(F.broadcast(self.hot), "hash").withColumn("norm", normalised(F.col("text")))
        first = F.min_by("row", F.struct(F.col("id").isNull(), "id")).alias("row")
        texts = rows.groupBy("hash", "norm").agg(first, F.min("id").alias("id"), F.count("*").alias("rows"))
        chain = F.dense_rank().over(Window.partitionBy("hash").orderBy("norm"))
        return self.looked_up(stored(texts, "dedup-hot-texts")).withColumn("chain", chain)


_ENTRY = ["bucket_depth", "bucket", "hash", "chain"]


def build_index(index: Index) -> tuple[DataFrame, DataFrame]:
    """The stored entries, and for each row the entry that it was put into.

    Entries: ``bucket_depth``, ``bucket``, ``hash``, ``chain``, ``keep_id``, ``group_size``, ``sha256``. Rows: ``doc_id`` and the first four.
    """
    nothing = F.lit(None).cast("boolean")
    sha256 = F.unhex(F.sha2("norm", 256)).alias("sha256")
    put = stored(index.inserted(nothing).select("id", *_ENTRY, sha256), "dedup-inserted")
    hot = stored(index.inserted_hot(nothing).select("id", "rows", "norm", *_ENTRY, sha256), "dedup-inserted-hot")
    own = put.groupBy(*_ENTRY).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"), F.first("sha256").alias("sha256"))
    entries = stored(own.unionByName(hot.select(*_ENTRY, F.col("id").alias("keep_id"), F.col("rows").alias("group_size"), "sha256")), "dedup-index")
    # All rows of a hot key are of one text unless several are in its chain; only then do their bytes have to be looked at again.
    several = hot.groupBy("hash").agg(F.count("*").alias("texts"))
    alone = hot.join(several.where("texts = 1"), "hash").select(*_ENTRY)
    found = index.keys.join(F.broadcast(alone), "hash").select(F.col("doc_id").alias("id"), *_ENTRY)
    shared = stored(hot.join(several.where("texts > 1"), "hash").select("norm", *_ENTRY), "dedup-hot-chains")
    rows = put.select("id", *_ENTRY).unionByName(found)
    if not shared.isEmpty():
        hashes = F.broadcast(shared.select("hash").distinct())  # hot keys
        again = index._hashed(nothing).join(hashes, "hash", "left_semi").select("id", "hash", normalised(F.col("text")).alias("norm"))
        rows = rows.unionByName(again.join(small_side(shared, SHARE), ["hash", "norm"]).select("id", *_ENTRY))
    return entries, rows.withColumnRenamed("id", "doc_id")


def find_copies(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, hash_bits: int = 64, share: int = SHARE) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    index = Index(docs, capacity, max_depth, hash_bits, share)
    entries, rows = build_index(index)
    big = entries.join(F.broadcast(index.hot), "hash")  # hot keys
    small = entries.join(F.broadcast(index.hot), "hash", "left_anti")
    hot = rows.join(F.broadcast(index.hot), "hash").join(small_side(big, SHARE), _ENTRY)
    found = rows.join(F.broadcast(index.hot), "hash", "left_anti").hint("merge").join(small, _ENTRY)
    columns = ["doc_id", "keep_id", "group_size", "sha256"]
    out = found.select(*columns).unionByName(hot.select(*columns))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return out.select("doc_id", "keep_id", "group_size", kept, F.lower(F.hex("sha256")).alias("text_sha256"))


def drop_copies(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, hash_bits: int = 64, share: int = SHARE) -> DataFrame:
    """The documents without copies, one row per distinct text, all input columns; rows move once, to the owners of their buckets."""
    index = Index(docs, capacity, max_depth, hash_bits, share)
    payload = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    place = Window.partitionBy("owner", "bucket", "hash", "chain").orderBy(F.col("id").asc_nulls_last())
    first = index.inserted(payload).withColumn("place", F.row_number().over(place)).where("place = 1")
    return first.select("row").unionByName(index.inserted_hot(payload).select("row")).select("row.*")

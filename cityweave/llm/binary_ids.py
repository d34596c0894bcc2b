"""Token ids as compact binary blocks, in the order of the documents.

Ids are replaced by their rank of frequency in this corpus, so that the 256 most frequent take one byte.
A rank takes 1 to 4 whole bytes; its length is not among the data but in a control byte that holds two
bits for each of four values. The reader takes the lengths of four values from a table by their control byte.

Blocks lie in Parquet files, control and data as columns of their own, so that Spark's committer makes
them whole or absent on any file system, also when executors are lost. A block holds whole documents, about
``BLOCK`` ids; a longer document is a block of its own. Documents go by ascending id.

Words are encoded once per process and looked up after that: the tokenizer drops white space, so a text's
ids are those of its words in turn. Only ASCII white space is cut at; the tokenizer sees any other.

Edge cases: a null or empty text is the end id alone. A null id comes first. Rows that repeat an id
follow each other in the order of their ids' bytes. An empty table gives an empty one. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityweave.llm.common import short_batches, slices, stored, text_of, tidy
from cityweave.llm.prefix_bpe import byte_signs

END_ID = 1
#: Ids of a block.
BLOCK = 1 << 16
#: Words that a process remembers, and longer ones; it starts anew beyond.
MOST_WORDS, MOST_LONG = 1_000_000, 50_000
#: Words that the smaller table of the index holds before they go to the larger one.
RECENT = 150_000

#: ASCII signs that are neither letters nor digits, but for the apostrophe, which may begin a suffix.
_TAIL = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: Letters before this one are single signs in lower case, too, and are composed.
_PLAIN = "\u0130"
_SIGNS = {b: sign for sign, b in byte_signs().items()}
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Index:
    """Words by the hash of what tells them apart, as two sorted tables, of which the smaller takes what is new.

    Rows: hash, first bytes, last bytes, and an entry, which holds the word's length in its lowest byte.
    """

    def __init__(self):
        self.tables = [np.zeros((4, 0), np.uint64), np.zeros((4, 0), np.uint64)]

    def __len__(self) -> int:
        return sum(t.shape[1] for t in self.tables)

    @staticmethod
    def _merged(table: np.ndarray, more: np.ndarray) -> np.ndarray:
        return np.insert(table, np.searchsorted(table[0], more[0]), more, axis=1)

    def find(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The entry of each word, 0 where there is none."""
        out = np.zeros(len(hashes), np.uint64)
        for table in self.tables:
            if table.shape[1]:
                at = np.minimum(np.searchsorted(table[0], hashes), table.shape[1] - 1)
                entry = table[3][at]
                same = (table[0][at] == hashes) & (table[1][at] == first) & (table[2][at] == last)
                out = np.where(same & ((entry & np.uint64(255)) == lengths), entry, out)
        return out

    def add(self, words: np.ndarray) -> None:
        """Takes words that ``find`` didn't know, sorted by hash."""
        self.tables[1] = self._merged(self.tables[1], words)
        if self.tables[1].shape[1] > RECENT:
            self.tables = [self._merged(*self.tables), np.zeros((4, 0), np.uint64)]


class Words:
    """Ids of texts by way of their words, each of which is encoded once.

    A word of up to 16 bytes is known by its length and its first and last eight bytes, which is all of it; a longer one by a number.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.index = Index()
        self.pool, self.used = np.zeros(1 << 20, self.kind), 0
        self.long: dict[bytes, int] = {}
        self.tails: dict[str, list[int]] = {}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> list[list[int]]:
        """Ids of words. One of plain letters, with other ASCII signs after them at most, is a single piece and its signs."""
        out: list = [None] * len(new)
        odd = []
        tokenize, tails = self.tokenizer.model.tokenize, self.tails
        for k, raw in enumerate(new):
            word = raw.decode()
            core = word.rstrip(_TAIL)
            if not core.isalpha():
                odd.append(k)
                continue
            if core.isascii():
                ids = [t.id for t in tokenize(core.lower())]
            elif max(core) < _PLAIN:
                ids = [t.id for t in tokenize(core.lower().encode().decode("latin-1").translate(_SIGNS))]
            else:
                odd.append(k)
                continue
            if len(core) < len(word):
                tail = word[len(core) :]
                if tail not in tails:
                    tails[tail] = self._whole([tail])[0]
                ids += tails[tail]
            out[k] = ids
        for k, ids in zip(odd, self._whole([new[k].decode() for k in odd]), strict=True):
            out[k] = ids
        return out

    def _stored(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Puts the ids of words into the pool; where each word's begin, and how many they are."""
        counts = np.array([len(x) for x in ids], np.int64)
        total = int(counts.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), self.kind, total)
        self.used += total
        return self.used - total + np.cumsum(counts) - counts, counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.index) > MOST_WORDS or len(self.long) > MOST_LONG:
            self.clear()
        raw = [text.encode() for text in texts]
        gap = b" " * 8
        joined = gap + b" ".join(raw) + gap
        data = np.frombuffer(joined, np.uint8)
        white = _WHITE[data]
        flips = np.flatnonzero(white[1:] != white[:-1]) + 1
        begins, stops = flips[0::2], flips[1::2]
        if not len(begins):
            return [np.zeros(0, self.kind) for _ in texts]
        lengths = np.minimum(stops - begins, 17).astype(np.uint64)
        eight = np.ndarray((len(data) - 7,), "<u8", joined, strides=(1,))
        first = eight[begins] & _KEEP[np.minimum(lengths, np.uint64(8))]
        last = np.where(lengths > 8, eight[stops - 8], np.uint64(0))
        for k in np.flatnonzero(lengths > 16).tolist():
            first[k], last[k] = self.long.setdefault(joined[begins[k] : stops[k]], len(self.long)), 0
        hashes = _mix(_mix(first ^ (lengths << np.uint64(56))) + last)
        found, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        own = [first[at], last[at], lengths[at]]
        if not all((x == y[which]).all() for x, y in zip((first, last, lengths), own, strict=True)):
            return [np.array(ids, self.kind) for ids in self._whole(texts)]  # two words of one hash
        entries = self.index.find(found, *own)
        new = np.flatnonzero(entries == 0)
        if len(new):
            begin, count = self._stored(self._learn([joined[begins[k] : stops[k]] for k in at[new].tolist()]))
            entries[new] = (begin.astype(np.uint64) << np.uint64(32)) | (count.astype(np.uint64) << np.uint64(8)) | own[2][new]
            self.index.add(np.stack([found[new], own[0][new], own[1][new], entries[new]]))
        begin, count = (entries >> np.uint64(32)).astype(np.int64), (entries >> np.uint64(8) & np.uint64(0xFFFFFF)).astype(np.int64)
        sizes = count[which]
        ends = np.cumsum(sizes)
        flat = self.pool[np.repeat(begin[which] - (ends - sizes), sizes) + np.arange(ends[-1])]
        upto = np.append(0, ends)[np.searchsorted(begins, 8 + np.cumsum([len(r) + 1 for r in raw]))]
        return np.split(flat, upto[:-1])


@lru_cache(maxsize=1)
def words(path: str) -> Words:
    return Words(path)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = lengths - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = raw[: len(raw) - 3].astype(np.uint32)
    for k in (1, 2, 3):
        four |= raw[k : len(raw) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    return four[ends - lengths] & _MASKS[lengths]


def squeeze(ids: np.ndarray) -> bytes:
    """Ids on their way to the blocks: first bytes, second bytes and so on, compressed."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(squeezed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(squeezed, 4 * count, codec="zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the document's ids with the end id, squeezed.

    Each task ends with a row of its own, whose ``used`` has the number of times it used each id.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("used", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, used = words(tokenizer), np.zeros(0, np.int64)
        for piece in slices(batches, most=1 << 20):
            ids = [np.append(x, encoder.kind(end_id)) for x in encoder.encode(piece.column("text").to_pylist())]
            own = np.bincount(np.concatenate(ids), minlength=len(used))
            own[: len(used)] += used
            used = own
            sizes, squeezed = pa.array(map(len, ids), pa.int64()), pa.array(map(squeeze, ids), pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), sizes, squeezed, pa.nulls(len(ids), schema.field("used").type)], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([None], [None], [None], [used]), schema, strict=True)], schema=schema)

    rows = short_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, n_tokens bigint, ids binary, used array<bigint>")


def frequencies(encoded: DataFrame) -> DataFrame:
    """``id`` and ``n`` over all documents, from the tasks' counts."""
    each = encoded.where("used IS NOT NULL").select(F.posexplode("used").alias("id", "n")).where("n > 0")
    return each.groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block: int = BLOCK) -> tuple[DataFrame, list[int]]:
    """Writes the blocks; gives them as a stored table, and the ids in the order of their ranks.

    The list has a number per id that occurs, so the tokenizer's vocabulary bounds it. Columns: ``part`` and ``seq``
    order the blocks, ``first`` counts the ids before a block in its part, then ``doc_ids``,
    ``counts`` (ids per document), ``control`` and ``data``.
    """
    encoded = stored(encode(docs, tokenizer, end_id), "token-ids")
    ranked = [row.id for row in frequencies(encoded).orderBy(F.desc("n"), "id").collect()]
    rank = np.zeros(max(ranked, default=0) + 1, dtype=np.uint32)
    rank[ranked] = np.arange(len(ranked))
    schema = "part int, seq int, first bigint, doc_ids array<bigint>, counts array<bigint>, control binary, data binary"
    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("seq", pa.int32()),
            ("first", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int64())),
            ("control", pa.binary()),
            ("data", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, first, size, held, doc_ids, counts = None, 0, 0, 0, [], [], []

        def closed() -> pa.RecordBatch:
            control, data = pack(rank[np.concatenate(held)])
            row = [part, seq, first, doc_ids, counts, control, data]
            return pa.RecordBatch.from_arrays([pa.array([x], field.type) for x, field in zip(row, arrow, strict=True)], schema=arrow)

        for piece in slices(batches, "n_tokens", most=1 << 21):
            part = piece.column("part")[0].as_py()
            for doc_id, n, ids in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids")), strict=True):
                if held and size + n > block:
                    yield closed()
                    seq, first, size = seq + 1, first + size, 0
                    held, doc_ids, counts = [], [], []
                held.append(unsqueeze(ids, n))
                doc_ids.append(doc_id)
                counts.append(n)
                size += n
        if held:
            yield closed()

    documents = encoded.where("used IS NULL").drop("used")
    ordered = documents.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids")
    blocks = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(tidy(run), schema)
    return stored(blocks, "token-blocks"), ranked


def _read(blocks: DataFrame, ranked: list[int], finish: Callable[[np.ndarray], object], name: str, kind: str, arrow: pa.DataType) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and what ``finish`` makes of each document's ids."""
    # A row per part: as many as there are tasks.
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    placed = blocks.join(F.broadcast(starts), "part").select((F.col("part_start") + F.col("first")).alias("start"), "doc_ids", "counts", "control", "data")
    ids_of = np.array(ranked, dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, doc_ids, counts, control, data = (batch.column(c)[row].as_py() for c in range(5))
                ids = ids_of[unpack(control, data, sum(counts))]
                ends = np.cumsum(counts)
                made = [finish(ids[e - n : e]) for e, n in zip(ends, counts, strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(made, arrow)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", name])

    return placed.mapInArrow(tidy(run), f"doc_id bigint, start bigint, n_tokens bigint, {name} {kind}")


def read(blocks: DataFrame, ranked: list[int]) -> DataFrame:
    """Reads blocks back: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` as 32-bit integers."""
    return _read(blocks, ranked, np.ndarray.tobytes, "ids", "binary", pa.binary())


def read_checksums(blocks: DataFrame, ranked: list[int]) -> DataFrame:
    """Reads blocks back, with ``ids_crc32`` of the ids as 32-bit integers in place of the ids."""
    return _read(blocks, ranked, zlib.crc32, "ids_crc32", "bigint", pa.int64())

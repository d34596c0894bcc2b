"""Fingerprints of documents: a Merkle tree over paragraphs and sections.

A text is cut into paragraphs at line ends, a paragraph into pieces where the bytes before a place say
so, about 64 bytes each, so that an edit changes the pieces it touches and no others. Paragraphs
are gathered into sections that end at paragraphs whose digest says so. A section's digest is over its
paragraphs' digests and the root's over the sections', so equal roots mean equal texts, and a walk down the
branches that differ leads to the edited paragraphs. Texts of less than ``SHORT`` characters carry a second row of
finer pieces, about 4 bytes each, as they have too few of the others to compare.

A fingerprint is written as ``root:section=paragraph.pieces,paragraph.pieces;section=...``, digests in
hex, with ``~pieces`` at the end for the finer ones. The likeness of two is the share of pieces that they have in common.

``edited`` pairs each document with the next by id. The rows are dealt out by ranges of the id, and the first row of
each range goes to the range before it as well.

Edge cases: a null or empty text has a root over nothing; two empty texts are alike, an empty and another are not.
Null ids come first, rows that repeat an id go by their texts. A single document is followed by itself.
An empty table gives an empty one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType

from cityweave.llm.common import slices, text_of

#: Bytes that decide about a cut; zeros of this number stand between texts that are hashed together.
WINDOW = 8
#: A piece ends at one place in so many.
PIECE, FINE = 64, 4
#: A piece is at most so many times as long as one is on average.
LONGEST = 4
#: Characters under which a text carries finer pieces.
SHORT = 512
#: A section ends after one paragraph in so many.
SECTION = 4

_random = np.random.default_rng(7)
_BYTES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Print:
    """One text's tree: paragraphs as (digest, pieces), and the finer pieces of a short text."""

    __slots__ = ("written", "pieces", "fine")

    def __init__(self, paragraphs: list[tuple[bytes, bytes]], fine: bytes | None):
        sections, open_section = [], []
        for n, (digest, pieces) in enumerate(paragraphs):
            open_section.append((digest, pieces))
            if digest[0] % SECTION == 0 or n == len(paragraphs) - 1:
                sections.append((_digest(b"".join(d for d, _ in open_section)), open_section))
                open_section = []
        root = _digest(b"".join(d for d, _ in sections), 16).hex()
        branch = lambda d, inner: f"{d.hex()}=" + ",".join(f"{p.hex()}.{leaves.hex()}" for p, leaves in inner)
        self.written = f"{root}:" + ";".join(branch(d, inner) for d, inner in sections) + (f"~{fine.hex()}" if fine is not None else "")
        self.pieces, self.fine = b"".join(leaves for _, leaves in paragraphs), fine


def _digest(data: bytes, size: int = 8) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def _ends(cut: np.ndarray, begin: int, end: int, longest: int) -> np.ndarray:
    """Ends of the pieces from ``begin`` to ``end``: after the places in ``cut``, at the end, and where one gets too long."""
    ends = np.append(cut + 1, end) if not len(cut) or cut[-1] + 1 < end else cut + 1
    begins = np.append(begin, ends[:-1])
    long = np.flatnonzero(ends - begins > longest)
    return np.sort(np.concatenate([ends, *[np.arange(begins[k] + longest, ends[k], longest) for k in long]])) if len(long) else ends


def _pieces(sums, back, ends: np.ndarray, begin: int) -> np.ndarray:
    """Hashes of the pieces that end at ``ends``, the first from ``begin``."""
    begins = np.append(begin, ends[:-1])
    value = (sums[ends] - sums[begins]) * back[begins] + (ends - begins).astype(np.uint64)
    return (_mix(value) >> np.uint64(32)).astype(">u4")


def prints(texts: list[str]) -> list[Print]:
    """The trees of some texts, hashed together."""
    gap = bytes(WINDOW)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(gap + gap.join(raw) + gap, np.uint8)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), dtype=np.uint64)])
    back = _powers(_BACK, len(data) + 1)
    seen = np.zeros(len(data), dtype=np.uint64)
    seen[WINDOW - 1 :] = _mix((sums[WINDOW:] - sums[:-WINDOW]) * back[: len(sums) - WINDOW]) >> np.uint64(40)
    line = data == 10
    coarse = np.flatnonzero((seen % np.uint64(PIECE) == 0) | line)
    fine = np.flatnonzero(seen % np.uint64(FINE) == 0)
    lines = np.flatnonzero(line)
    out, begin = [], WINDOW
    for text, own in zip(texts, raw, strict=True):
        end = begin + len(own)
        paragraphs = []
        if own:
            stops = lines[slice(*np.searchsorted(lines, [begin, end]))] + 1
            stops = stops if len(stops) and stops[-1] == end else np.append(stops, end)
            cuts = coarse[slice(*np.searchsorted(coarse, [begin, end]))]
            ends = _ends(cuts, begin, end, LONGEST * PIECE)
            leaves = _pieces(sums, back, ends, begin)
            counts = np.searchsorted(ends, stops, side="left") + 1
            start, first = begin, 0
            for stop, upto in zip(stops.tolist(), counts.tolist(), strict=True):
                paragraphs.append((_digest(own[start - begin : stop - begin]), leaves[first:upto].tobytes()))
                start, first = stop, upto
        few = None
        if len(text) < SHORT:
            places = fine[slice(*np.searchsorted(fine, [begin, end]))]
            few = _pieces(sums, back, _ends(places, begin, end, LONGEST * FINE), begin).tobytes() if own else b""
        out.append(Print(paragraphs, few))
        begin = end + WINDOW
    return out


def _share(a: bytes, b: bytes) -> float:
    left, right = (Counter(np.frombuffer(x, ">u4").tolist()) for x in (a, b))
    total = left.total() + right.total()
    return 2 * (left & right).total() / total if total else 1.0


def _likeness(a: Print, b: Print) -> float:
    if a.written == b.written:
        return 1.0
    return _share(a.pieces, b.pieces) if a.fine is None or b.fine is None else _share(a.fine, b.fine)


def _branches(written: str) -> list[tuple[str, list[tuple[str, str]]]]:
    body = written.partition(":")[2].partition("~")[0]
    sections = (s.partition("=") for s in body.split(";") if s)
    return [(d, [(p.partition(".")[0], p.partition(".")[2]) for p in inner.split(",")]) for d, _, inner in sections]


def likeness(a: str, b: str) -> float:
    """The share of pieces that two written fingerprints have in common, 0 to 1; equal roots give 1."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    rows = [x.partition("~") for x in (a, b)]
    if all(mark for _, mark, _ in rows):
        return _share(*(bytes.fromhex(fine) for _, _, fine in rows))
    return _share(*(bytes.fromhex("".join(leaves for _, inner in _branches(x) for _, leaves in inner)) for x in (a, b)))


def edited_paragraphs(before: str, after: str) -> list[int]:
    """Positions of the paragraphs of ``after`` that ``before`` lacks, found along differing branches only."""
    if before.partition(":")[0] == after.partition(":")[0]:
        return []
    old = _branches(before)
    sections, paragraphs = {d for d, _ in old}, {p for _, inner in old for p, _ in inner}
    out, at = [], 0
    for digest, inner in _branches(after):
        if digest not in sections:
            out += [at + n for n, (p, _) in enumerate(inner) if p not in paragraphs]
        at += len(inner)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 19):
            written = [p.written for p in prints(piece.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(written, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
#: Ranges of ids for each shuffle partition, so that the partitions come out even.
RANGES = 4
#: Sorts before any id.
_NULL = -(1 << 63)


def _compared(ids: list, texts: list[str], following: list[str], own: list[Print], then: list[Print]) -> pa.RecordBatch:
    """The result's rows for documents, the documents that follow them, and the trees of both."""
    cut = [len(t) - len(t) // 2 for t in texts]
    edited = [t[:c] + n[: len(t) - c] for t, n, c in zip(texts, following, cut, strict=True)]
    changed = prints(edited)
    columns = [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        [p.written for p in own],
        [p.written for p in changed],
        [_likeness(p, q) for p, q in zip(own, changed, strict=True)],
        [_likeness(p, q) for p, q in zip(own, then, strict=True)],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _followed(docs: DataFrame) -> DataFrame:
    """The documents by ranges of ids, each range sorted and ended by a copy of the document that follows it.

    Columns: ``key`` (the id, null as the smallest number), ``text``, ``range``, ``extra`` (for the copies).
    The ends of the ranges are quantiles of the ids; their number depends on the setting for shuffles alone.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL)).alias("key"), text_of().alias("text"))
    shares = [k / (RANGES * parts) for k in range(RANGES * parts)]
    least, found = rows.agg(F.min("key"), F.percentile_approx("key", shares, 100 * len(shares))).first()
    firsts = np.array(sorted({least, *(found or [])}) if least is not None else [_NULL], dtype=np.int64)

    @F.pandas_udf(LongType())
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, key.to_numpy(), side="right") - 1)

    @F.pandas_udf(BooleanType())
    def begins(key: pd.Series) -> pd.Series:
        return pd.Series(firsts[np.searchsorted(firsts, key.to_numpy(), side="right") - 1] == key.to_numpy())

    last = len(firsts) - 1
    placed = rows.select("key", "text", place("key").alias("own"), begins("key").alias("begins"))
    before = F.when(F.col("own") > 0, F.col("own") - 1).otherwise(last)
    at = lambda r, extra: F.struct(r.alias("range"), F.lit(extra).alias("extra"))
    ranges = F.when(F.col("begins"), F.array(at(F.col("own"), False), at(before, True))).otherwise(F.array(at(F.col("own"), False)))
    dealt = placed.select("key", "text", F.inline(ranges)).repartition(parts, "range")
    return dealt.sortWithinPartitions("range", "extra", "key", "text")


def edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text, whose second half is the beginning of the next document.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last document, as long as it waits for the one that follows it
        for piece in slices(batches, most=1 << 19):
            rows = list(zip(*(piece.column(c).to_pylist() for c in ("range", "extra", "key", "text")), strict=True))
            rows = [*held, *[(*row, p) for row, p in zip(rows, prints([r[3] for r in rows]), strict=True)]]
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]]
            held = [rows[-1]]
            if pairs:
                firsts, seconds = zip(*pairs, strict=True)
                ids = [None if r[2] == _NULL else r[2] for r in firsts]
                columns = [[r[3] for r in firsts], [r[3] for r in seconds], [r[4] for r in firsts], [r[4] for r in seconds]]
                yield _compared(ids, *columns)

    return _followed(docs).select("range", "extra", "key", "text").mapInArrow(run, _RESULT)

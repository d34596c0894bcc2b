"""Repeated passages, found by longest-previous-factor arrays over suffix order.

A window is any string of ``LEAST`` bytes. A window that also starts elsewhere, in the same document or another, is a repeat, and the
bytes that repeats cover are spans to remove: all of them, or all but those of the first occurrence in the order of the ids.

1. *Anchors.* Every window has an anchor, its leftmost smallest hash of ``GRAM`` bytes. Equal windows have equal anchors at equal
   places, so two equal windows always meet under one anchor. Windows in a row that share an anchor are a
   *segment*, about a hundred windows; a document becomes rows of some 40 bytes for each hundred of its own.
2. Anchors that occur once are dropped, after counts that are reduced before the shuffle.
3. Segments with equal bytes are one *kind*, with its number of occurrences and its first. What several share is a repeat
   as a whole, and no text is needed for it.
4. *Suffix order.* Under an anchor with several kinds, as at the ends of a shared passage, one segment of each kind is cut from
   its text. Anchors are dealt into blocks of bounded size. A block sorts its suffixes up to ``LEAST`` bytes by doubling; the previous and
   next smaller positions in that order give each window's longest previous factor, and, mirrored, its longest next one. A window whose
   factor reaches ``LEAST`` is a repeat.
5. An anchor with too many kinds for a block is cut by the places of its windows into steps of ``STEP``, keyed by the bytes that all windows of a
   step have in common; what is still too many is told apart window by window, by counting digests. No group is cut off.

Equal segments and single windows are recognised by 128 bits of hashes, all others by their bytes.

Edge cases: a null text is empty. A text shorter than a window has none. Rows that repeat an id are documents of
their own; rows that repeat the text as well are copies of each other, and count as two occurrences; where the first is kept, it is
kept in each of them. A null id is ordered as 0. Text of one repeated letter gives a segment per byte. Very long texts are read in
pieces of ``PIECE`` bytes for anchors and whole for cutting. An empty table gives an empty one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import meet, short_batches, slices, stored, text_of, tidy

#: Bytes of a window and of an anchor; an anchor fits a window at PLACES places.
LEAST, GRAM = 400, 192
PLACES = LEAST - GRAM + 1
#: Bytes of text whose anchors are found at once.
PIECE = 1 << 20
#: Bytes of segments in a block, and kinds under an anchor that still go into one block.
BLOCK_BYTES, MOST_KINDS = 1 << 19, 512
#: Windows of a step.
STEP = 16

_random = np.random.default_rng(20240413)
_odd = lambda n: _random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = _odd(256)
_BYTES_2 = _odd(256)
_BASE = int(_odd(1)[0])
_BACK = pow(_BASE, -1, 1 << 64)
_powers_of: dict[int, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    known = _powers_of.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE + LEAST), base, dtype=np.uint64)
        known[0] = 1
        known = _powers_of[base] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def _sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    terms = values[data] * _powers(_BASE, len(data))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each run of ``width`` values, from minima running both ways in blocks."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    index = np.arange(len(padded)).reshape(-1, width)
    blocks = padded.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1)
    new = np.concatenate([np.ones((len(blocks), 1), bool), forth[:, 1:] < forth[:, :-1]], axis=1)
    forth_at = np.maximum.accumulate(np.where(new, index, 0), axis=1).ravel()
    turned = blocks[:, ::-1]
    back = np.minimum.accumulate(turned, axis=1)
    new = turned == back
    back_at = np.minimum.accumulate(np.where(new, index[:, ::-1], len(padded)), axis=1)[:, ::-1].ravel()
    begins = np.arange(n - width + 1)
    left, right = back_at[begins], forth_at[begins + width - 1]
    return np.where(padded[left] <= padded[right], left, right)


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of the texts' segments: text number, begin, windows, place of the anchor in the first window, hash, digest."""
    pieces, size = [], 0
    for number, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - LEAST + 1), PIECE):
            piece = text[begin : begin + PIECE + LEAST - 1]
            if len(piece) < LEAST:
                continue
            if pieces and size + len(piece) > PIECE:
                yield _piece_segments(pieces)
                pieces, size = [], 0
            pieces.append((number, begin, piece))
            size += len(piece)
    if pieces:
        yield _piece_segments(pieces)


def _piece_segments(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    lengths = np.array([len(p) for _, _, p in pieces])
    firsts = np.cumsum(lengths) - lengths
    sums = _sums(data, _BYTES)
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * _powers(_BACK, len(sums) - GRAM))
    anchors = leftmost_minima(grams, PLACES)
    windows = np.concatenate([np.arange(f, f + n - LEAST + 1) for f, n in zip(firsts, lengths, strict=True)])
    own = np.repeat(np.arange(len(pieces)), lengths - LEAST + 1)
    anchor = anchors[windows]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(windows)))
    begin, owner = windows[at], own[at]
    second = _sums(data, _BYTES_2)
    digest = (second[begin + counts + LEAST - 1] - second[begin]) * _powers(_BACK, len(data) + 1)[begin]
    digest = _mix(digest + counts.astype(np.uint64) * np.uint64(_BASE))
    numbers = np.array([n for n, _, _ in pieces])[owner]
    inside = begin - firsts[owner] + np.array([b for _, b, _ in pieces])[owner]
    return numbers, inside, counts, anchor[at] - begin, grams[anchor[at]].view(np.int64), digest.view(np.int64)


_OCCURRENCE = "doc bigint, mark bigint, begin bigint, windows int, lead int, anchor bigint, digest bigint"


def _key(docs: DataFrame) -> DataFrame:
    """``doc`` and ``mark`` tell rows apart whose ids repeat or are missing, unless their texts are the same as well."""
    doc = F.col("doc_id").cast("bigint")
    texts = short_batches(docs).select(doc.alias("id"), text_of().alias("text"))
    return texts.withColumn("doc", F.coalesce("id", F.lit(0))).withColumn("mark", F.xxhash64("text", F.col("id").isNull()))


def occurrences(keyed: DataFrame) -> DataFrame:
    """All segments of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=4 << 20):
            doc, mark = part.column("doc").to_numpy(), part.column("mark").to_numpy()
            texts = [t.as_py() for t in part.column("text").cast(pa.binary())]
            for number, begin, windows, lead, anchor, digest in segments(texts):
                columns = [doc[number], mark[number], begin, windows.astype(np.int32), lead.astype(np.int32), anchor, digest]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "mark", "begin", "windows", "lead", "anchor", "digest"])

    return keyed.select("doc", "mark", "text").mapInArrow(tidy(run), _OCCURRENCE)


def suffix_ranks(data: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Ranks of all positions by their next 8, 16, ..., 256 and ``LEAST`` bytes, in the order of the bytes; doubled from length to length."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | padded[k : n + k]
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int32)
    out, length = [(8, rank)], 8
    while length < LEAST:
        step = min(length, LEAST - length)
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * np.int64(n + 1) + ahead, return_inverse=True)[1].astype(np.int32)
        length += step
        out.append((length, rank))
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest one to the left that holds a smaller value, or -1; pointers jump over pointers."""
    before = np.arange(-1, len(values) - 1)
    open_at = np.flatnonzero((before >= 0) & (values[before] > values))
    while len(open_at):
        before[open_at] = before[before[open_at]]
        to = before[open_at]
        open_at = open_at[(to >= 0) & (values[to] > values[open_at])]
    return before


def common_prefix(ranks: list[tuple[int, np.ndarray]], data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of pairs of suffixes, ``LEAST`` at most."""
    n = len(data)
    off = np.where(ranks[-1][1][a] == ranks[-1][1][b], LEAST, 0)
    for length, rank in ranks[-2::-1]:
        inside = (off < LEAST) & (a + off + length <= n) & (b + off + length <= n)
        x, y = np.where(inside, a + off, 0), np.where(inside, b + off, 0)
        off = off + np.where(inside & (rank[x] == rank[y]), length, 0)
    for _ in range(7):
        inside = (off < LEAST) & (a + off < n) & (b + off < n)
        x, y = np.where(inside, a + off, 0), np.where(inside, b + off, 0)
        off = off + np.where(inside & (data[x] == data[y]), 1, 0)
    return off


def longest_factors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor at each start, counted up to ``LEAST`` bytes.

    ``starts`` ascend; only matches between starts count. In suffix order the best earlier match of a position is its previous or its
    next entry with a smaller position, so two arrays of nearest smaller values give all of them; mirrored positions give the later ones.
    """
    ranks = suffix_ranks(data)
    order = starts[np.lexsort((starts, ranks[-1][1][starts]))]

    def factors(positions: np.ndarray) -> np.ndarray:
        best = np.zeros(len(positions), np.int64)
        for turned in (False, True):
            values, places = (positions[::-1], order[::-1]) if turned else (positions, order)
            near = previous_smaller(values)
            found = near >= 0
            length = np.zeros(len(values), np.int64)
            length[found] = common_prefix(ranks, data, places[found], places[near[found]])
            best = np.maximum(best, length[::-1] if turned else length)
        out = np.zeros(len(data), np.int64)
        out[order] = best
        return out[starts]

    return factors(order), factors(-order)


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and number of each run of set flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    yield from zip(np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1)).tolist(), strict=True)


_SPAN = "doc bigint, mark bigint, begin bigint, stop bigint"
_SEGMENT = ["anchor", "digest", "doc", "mark", "begin", "windows", "lead", "bytes"]


def _compare(keep_first: bool):
    def run(block: pa.Table) -> pa.Table:
        """Spans that the repeats of a block cover; segments go in the order of their documents."""
        block = block.sort_by([("doc", "ascending"), ("mark", "ascending"), ("begin", "ascending")])
        out: list[tuple] = []
        doc, mark, begin = (block.column(c).to_pylist() for c in ("doc", "mark", "begin"))
        windows = block.column("windows").to_numpy()
        raw = block.column("bytes").to_pylist()
        # Rows that repeat both id and text give the same segment twice.
        first = {}
        own = [k for k in range(len(raw)) if first.setdefault((doc[k], mark[k], begin[k]), k) == k]
        lengths = np.array([len(raw[k]) for k in own])
        data = np.frombuffer(b"".join(raw[k] for k in own), np.uint8)
        at = np.cumsum(lengths) - lengths
        counts = windows[own].astype(np.int64)
        starts = np.repeat(at - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        previous, following = longest_factors(data, starts)
        hit = previous >= LEAST if keep_first else np.maximum(previous, following) >= LEAST
        ends = np.cumsum(counts)
        for k, end, n in zip(own, ends.tolist(), counts.tolist(), strict=True):
            for run_at, length in _runs(hit[end - n : end]):
                out.append((doc[k], mark[k], begin[k] + run_at, begin[k] + run_at + length - 1 + LEAST))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("doc", "mark", "begin", "stop"), columns, strict=True)})

    return run


def _cut(keyed: DataFrame, kinds: DataFrame) -> DataFrame:
    """The bytes of one segment of each kind."""
    part = F.struct("begin", "windows", "lead", "anchor", "digest")
    wanted = kinds.groupBy("doc", "mark").agg(F.collect_list(part).alias("parts"))
    schema = "anchor bigint, digest bigint, doc bigint, mark bigint, begin bigint, windows int, lead int, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            texts = piece.column("text").cast(pa.binary())
            for doc, mark, text, parts in zip(*(piece.column(c).to_pylist() for c in ("doc", "mark")), texts, piece.column("parts").to_pylist(), strict=True):
                text = text.as_py()
                for low in range(0, len(parts), 4096):
                    some = parts[low : low + 4096]
                    rows = [{**p, "doc": doc, "mark": mark, "bytes": text[p["begin"] : p["begin"] + p["windows"] + LEAST - 1]} for p in some]
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow_segment)

    return keyed.select("doc", "mark", "text").hint("merge").join(wanted, ["doc", "mark"]).mapInArrow(tidy(run), schema)


_arrow_segment = pa.schema(
    [("anchor", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("begin", pa.int64()), ("windows", pa.int32()), ("lead", pa.int32()), ("bytes", pa.binary())]
)


def _hash_of(data: bytes, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=salt.to_bytes(4, "little")).digest(), "little", signed=True)


def _steps(crowded: DataFrame) -> DataFrame:
    """Segments cut where their windows' places pass a multiple of STEP, under the bytes that all windows of a step have in common."""
    schema = "anchor bigint, digest bigint, doc bigint, mark bigint, begin bigint, windows int, lead int, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, data, lead, at = [], row["bytes"], row["lead"], 0
                while at < row["windows"]:
                    # The anchor lies ``lead - at`` bytes into window ``at``; places fall from window to window.
                    place = lead - at
                    lowest = place // STEP * STEP
                    n = min(place - lowest + 1, row["windows"] - at)
                    core = data[lead - lowest : lead - lowest - STEP + 1 + LEAST]
                    piece = data[at : at + n + LEAST - 1]
                    own = {**row, "anchor": _hash_of(core, lowest), "begin": row["begin"] + at, "windows": n, "lead": place, "bytes": piece}
                    rows.append({**own, "digest": _hash_of(piece, 1 << 20)})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow_segment)

    return crowded.select(*_SEGMENT).mapInArrow(tidy(run), schema)


def _alone(crowded: DataFrame, keep_first: bool) -> DataFrame:
    """Spans of single windows that occur more than once, by counting their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for k in range(row["windows"]):
                    window = hashlib.blake2b(row["bytes"][k : k + LEAST], digest_size=16).digest()
                    rows.append({"window": window, "doc": row["doc"], "mark": row["mark"], "begin": row["begin"] + k})
                yield pa.RecordBatch.from_pylist(rows)

    found = crowded.select(*_SEGMENT).mapInArrow(tidy(run), "window binary, doc bigint, mark bigint, begin bigint")
    found = stored(found.distinct(), "windows-alone")
    place = F.struct("doc", "mark", "begin")
    counted = found.groupBy("window").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    both = meet(found, stored(counted, "windows-repeated"), ["window"], "n", found.count())
    if keep_first:
        both = both.where(place != F.col("first"))
    return both.select("doc", "mark", "begin", (F.col("begin") + LEAST).alias("stop"))


def _blocked(cut: DataFrame, keep_first: bool, most_kinds: int) -> tuple[DataFrame, DataFrame]:
    """Spans from the anchors that fit a block, and the segments of the others."""
    rows, total = cut.agg(F.count("*"), F.sum(F.octet_length("bytes"))).first()
    sizes = stored(cut.groupBy("anchor").agg(F.count("*").alias("kinds")), "anchors")
    sized = meet(cut, sizes, ["anchor"], "kinds", rows)
    parts = max(1, -(-(total or 0) // BLOCK_BYTES))
    fits = sized.where(F.col("kinds") <= most_kinds).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
    spans = fits.select(*_SEGMENT, "block").repartition(parts, "block").groupBy("block").applyInArrow(_compare(keep_first), _SPAN)
    return spans, sized.where(F.col("kinds") > most_kinds).select(*_SEGMENT)


def repeats(docs: DataFrame, keep_first: bool = False, most_kinds: int = MOST_KINDS) -> DataFrame:
    """Spans ``begin`` to ``stop``, in bytes, that repeats cover in a document, named by ``doc`` and ``mark``; spans may overlap."""
    keyed = _key(docs)
    found = stored(occurrences(keyed), "segments")
    place = F.struct("doc", "mark", "begin")
    earliest = [F.min(place).alias("first")] if keep_first else []
    shared = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), *earliest)
    shared = stored(shared.where("n > 1").withColumn("mixed", F.col("low") != F.col("high")).drop("low", "high"), "shared-anchors")
    held = stored(meet(found, shared, ["anchor"], "n", found.count()).drop("n"), "shared-segments")
    # Several kinds under an anchor: what occurs several times is a repeat, and one segment of each is compared by its bytes.
    mixed = held.where("mixed").drop("first")
    kinds = mixed.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc", "mark", "begin", "windows", "lead")).alias("first"))
    kinds = stored(kinds, "kinds")
    several = kinds.where("n > 1").select("anchor", "digest", "n", *[F.struct("first.doc", "first.mark", "first.begin").alias("first")] * keep_first)
    copied = meet(mixed, several, ["anchor", "digest"], "n", mixed.count())
    # One kind: all of its occurrences are repeats.
    columns = ["doc", "mark", "begin", "windows", *["first"] * keep_first]
    whole = held.where("NOT mixed").select(*columns).unionByName(copied.select(*columns))
    if keep_first:
        whole = whole.where(place != F.col("first"))
    out = whole.select("doc", "mark", "begin", (F.col("begin") + F.col("windows") - 1 + LEAST).alias("stop"))
    cut = stored(_cut(keyed, kinds.select("anchor", "digest", "first.*")), "cut-segments")
    spans, crowded = _blocked(cut, keep_first, most_kinds)
    out = out.unionByName(stored(spans, "spans"))
    steps = stored(_steps(crowded), "cut-steps")
    if not steps.isEmpty():
        spans, crowded = _blocked(steps, keep_first, most_kinds)
        out = out.unionByName(stored(spans, "spans")).unionByName(_alone(crowded, keep_first))
    return out


def _without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without its spans, the bytes removed, and the number of maximal runs."""
    kept, at, removed, runs = [], 0, 0, 0
    for begin, stop in sorted(spans):
        if begin > at or not runs:
            kept.append(text[at:begin])
            runs += 1
            removed += stop - begin
        elif stop > at:
            removed += stop - at
        at = max(at, stop)
    kept.append(text[at:])
    return b"".join(kept), removed, runs


def remove_repeats(docs: DataFrame, keep_first: bool = False, most_kinds: int = MOST_KINDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, and ``kept``, the bytes that stay.

    What stays may begin or end inside of a character, so it is binary.
    """
    keyed = _key(docs)
    spans = repeats(docs, keep_first, most_kinds).groupBy("doc", "mark").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            texts = [t.as_py() for t in piece.column("text").cast(pa.binary())]
            spans = [[(s["begin"], s["stop"]) for s in own or ()] for own in piece.column("spans").to_pylist()]
            done = [_without(t, s) for t, s in zip(texts, spans, strict=True)]
            columns = [pa.array([len(t) for t in texts], pa.int64()), *[pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]]
            yield pa.RecordBatch.from_arrays([piece.column("id"), *columns, pa.array([d[0] for d in done], pa.binary())], names)

    both = keyed.hint("merge").join(spans, ["doc", "mark"], "left").select("id", "text", "spans")
    return both.mapInArrow(tidy(run), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

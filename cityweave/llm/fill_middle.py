"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, and the parts are written in another order.

A text is a row of units: a run of letters ``A-Z a-z``, or any other code point. Two hashed draws name the units after
which the prefix and the middle end, so parts begin and end between units and never inside a word.

Work goes over the UTF-8 bytes of many texts at once. Units begin where a flag is set, so a cut is the place of the
n-th flag, in bytes. Lengths in code points come from a sparse exception index: for each character of several bytes, and
for no other, its place and the bytes it takes beyond one. ``searchsorted`` finds how many exceptions lie before a
cut, and the running sum of their excess is the difference between the two counts; a text of ASCII has no
exceptions, and both counts are the same.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, ``plain``
is the text. A text that holds a marker stays plain, so a marker in an output is never part of the text:
a marker begins with ``<`` and has no other, so none arises where two parts meet.

Edge cases: a null text is empty, and an empty text is plain with no units. A null id draws like an empty id. Rows that repeat
an id draw alike, each with its own text. Equal draws give an empty middle. Very long texts are cut in one piece, alone in
a batch; memory is a small multiple of the longest text. An empty table gives an empty one. Only ``doc_id`` and ``text``
are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import slices, text_of

#: Fixed markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKERS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
#: Of 100 texts, those that stay plain, and of 100 others, those in suffix-first form.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes beyond the first that a character takes, by its first byte.
_EXCESS = np.zeros(256, dtype=np.int64)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class ExceptionIndex:
    """Places of the characters of several bytes in ``data``, and their excess bytes as a running sum."""

    def __init__(self, data: np.ndarray) -> None:
        self.bytes_at = np.flatnonzero(data >= 0xC0)
        excess = _EXCESS[data[self.bytes_at]]
        self.excess = np.concatenate([np.zeros(1, np.int64), np.cumsum(excess)])
        self.chars_at = self.bytes_at - self.excess[:-1]

    def to_chars(self, cut: np.ndarray) -> np.ndarray:
        """Code points before byte cuts that lie between characters."""
        return cut - self.excess[np.searchsorted(self.bytes_at, cut)]

    def to_bytes(self, cut: np.ndarray) -> np.ndarray:
        """Bytes before code-point cuts."""
        return cut + self.excess[np.searchsorted(self.chars_at, cut)]


def unit_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places in ``data`` where units begin; a text's first byte always begins one."""
    letter = _LETTER[data]
    before = np.concatenate([[False], letter[:-1]])
    before[begins[begins < len(data)]] = False
    return np.flatnonzero((letter & ~before) | (~letter & ((data & 0xC0) != 0x80)))


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def cut_texts(ids: list[int | None], texts: list[bytes], seed: int, plain_percent: int, spm_percent: int) -> Iterator[tuple]:
    """For each text: units, form, code points of prefix and middle, output."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = unit_starts(data, begins)
    first, last = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
    exceptions = ExceptionIndex(data)
    drawn = [draws(i, seed) for i in ids]
    units = last - first
    two = np.array([[h[0], h[1]] for h in drawn], dtype=np.int64).reshape(-1, 2) % (units[:, None] + 1)
    two.sort(axis=1)
    places = np.append(starts, len(data))
    cuts = np.where(two == units[:, None], ends[:, None], places[np.minimum(first[:, None] + two, len(starts))])
    chars = exceptions.to_chars(np.column_stack([begins, cuts]))
    for k, (text, h) in enumerate(zip(texts, drawn, strict=True)):
        if not text or h[2] % 100 >= 100 - plain_percent or any(m in text for m in _MARKERS):
            yield int(units[k]), "plain", None, None, text
            continue
        a, b = (cuts[k] - begins[k]).tolist()
        before, middle, after = text[:a], text[a:b], text[b:]
        p, s, m = _MARKERS
        spm = h[3] % 100 < spm_percent
        out = b"".join([s, after, p, before, m, middle] if spm else [p, before, s, after, m, middle])
        yield int(units[k]), "spm" if spm else "psm", int(chars[k, 1] - chars[k, 0]), int(chars[k, 2] - chars[k, 1]), out


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=1 << 20):
            texts = [t.as_py() for t in piece.column("text").cast(pa.binary())]
            found = list(zip(*cut_texts(piece.column("doc_id").to_pylist(), texts, seed, plain_percent, spm_percent), strict=True))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(values, kind) for values, kind in zip(found[:4], types, strict=True)]
            output = pa.array(found[4], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns, output], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda k: F.get(parts, F.lit(k))
    psm = F.concat(part(1), part(3), part(2))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", F.concat(part(2), part(3), part(1))).otherwise(F.col(output))

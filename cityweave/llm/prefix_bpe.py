"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word, its encoding ends in exactly one token. A token that ends at some place is
that one if the token before it, the last of the shorter prefix, may stand beside it: two
tokens may when no merge that is older than theirs would have joined across their border. All tokens that end at
a place come from an automaton with suffix links over the vocabulary. The last token of each prefix is a
back-pointer; following them from the end gives the ids, with no merging at all.

Ids have to be numbered in the order of the merges, single bytes first, as they are in byte-level files.

The pre-tokenizer cuts a text into words with one blank before them at most. A process remembers
what it has encoded by such units.

Edge cases: a null or empty text has no ids and decodes to the empty text. The strings of special
tokens in a text become those tokens. Rows that repeat an id are encoded each. An empty table gives
an empty one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import short_batches, slices, text_of, tidy

#: Fixed: Unicode's white space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed: the byte-level pre-tokenizer's pattern.
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
UNIT = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Units, pieces and pairs that a process remembers; it starts anew beyond.
MOST_UNITS = 200_000
MOST_PIECES = 100_000
MOST_PAIRS = 200_000


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + n): b for n, b in enumerate(rest)}


class Pool:
    """Short byte strings by number, looked up many at a time."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begins[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.data[at].tobytes()


class PrefixEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs = byte_signs()
        vocabulary = {token: n for token, n in spec["model"]["vocab"].items()}
        size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for token, n in vocabulary.items():
            self.bytes_of[n] = bytes(signs[c] for c in token)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, n in special.items():
            self.bytes_of[n] = token.encode()
        self.special = {token: np.array([n], dtype="<u4").tobytes() for token, n in special.items()}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merged = {(vocabulary[a], vocabulary[b]): vocabulary[a + b] for a, b in merges}
        self.halves = {n: pair for pair, n in self.merged.items()}
        if list(self.merged.values()) != sorted(self.merged.values()) or len(self.halves) < len(merges):
            raise ValueError("ids aren't in the order of the merges")
        self.automaton = ahocorasick.Automaton()
        self.lengths = [len(b) for b in self.bytes_of]
        for token, n in vocabulary.items():
            if n in self.halves or len(self.bytes_of[n]) == 1:
                self.automaton.add_word(self.bytes_of[n].decode("latin-1"), n)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.spelled = Pool(self.bytes_of)
        self.decimal = Pool([b"%d," % n for n in range(size)])

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when the bytes of both are encoded together."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right, len(self.bytes_of))
        return known

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Takes the younger of the two tokens at the border apart, again and again.

        At each step the two stood side by side at some time before ``until``, the merge that ended it.
        If a merge joins them and is older than that, it would have come first.
        """
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < until:
                return False
            if left in self.halves and (left > right or right not in self.halves):
                until, left = left, self.halves[left][1]
            elif right in self.halves:
                until, right = right + 1, self.halves[right][0]
            else:
                return True

    def stands(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        known = self.whole.get(token)
        if known is None:
            pair = self.halves.get(token)
            known = self.whole[token] = pair is None or self.stands(pair[0]) and self.stands(pair[1]) and self._apart(*pair, token)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece of the pre-tokenizer."""
        last = [-1] * (len(piece) + 1)
        lengths, pairs = self.lengths, self.pairs
        for at, token in self.automaton.iter(piece.decode("latin-1")):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - lengths[token]
            if start:
                known = pairs.get((last[start], token))
                if known if known is not None else self.compatible(last[start], token):
                    last[end] = token
            elif self.stands(token):
                last[end] = token
        out, end = [], len(piece)
        while end:
            out.append(last[end])
            end -= lengths[last[end]]
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        out, pieces = b"", PIECE.findall(unit)
        for piece in pieces:
            known = self.pieces.get(piece)
            if known is None:
                known = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
                if len(pieces) > 1:  # a unit of a single piece is remembered as a unit
                    if len(self.pieces) > MOST_PIECES:
                        self.pieces.clear()
                    self.pieces[piece] = known
            out += known
        self.units[unit] = out
        return out

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special_cut and any(s in text for s in self.special):
            return b"".join([self.special.get(p) or self.encode_bytes(p) for p in self.special_cut.split(text)])
        if len(self.units) > MOST_UNITS:
            self.units.clear()
        known = self.units
        return b"".join([known.get(u) or self._unit(u) for u in UNIT.findall(text)])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become replacement signs."""
        return self.spelled.joined(ids).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> PrefixEncoder:
    """The process's encoder; a task drops it at its end, as the process may wait for long and building it takes a third of a second."""
    return PrefixEncoder(path)


def _rows(docs: DataFrame) -> DataFrame:
    return short_batches(docs).select("doc_id", text_of().alias("text"))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids``, an array of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for piece in slices(batches, most=1 << 20):
            ids = pa.array([own.encode(t).astype(np.int32) for t in piece.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids], ["doc_id", "ids"])
        encoder.cache_clear()

    rows = _rows(docs)
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            texts = [own.decode(np.asarray(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
        encoder.cache_clear()

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encodes and decodes each text: ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256``."""
    sha256 = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for piece in slices(batches, most=1 << 20):
            counts, ids, texts = [], [], []
            for text in piece.column("text").to_pylist():
                numbers = own.encode(text)
                counts.append(len(numbers))
                ids.append(sha256(own.decimal.joined(numbers)[:-1]))
                texts.append(sha256(own.decode(numbers).encode()))
            columns = [piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.cache_clear()

    rows = _rows(docs)
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

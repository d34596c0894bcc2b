"""Small tables with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns named like those that operators add or use inside.
CLASHING = ["copy", "copies", "shuffle_key", "hash", "norm", "id", "row", "sha256", "score", "predicted", "size", "shard", "slot", "__source"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghilmnoprst") for _ in range(rng.randrange(1, 8))) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(11)
    base = words(rng, 120)
    out = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n ", None, None), (4, "one", "de", ""), (5, "Zwei  Wörter", "de", "b"),
        (6, "zwei wörter", "de", "b"), (6, "zwei wörter", "de", "b"), (7, "x" * 30_000, "en", "a"), (8, words(rng, 9000), "en", "a"),
        (None, "a row without an id", "en", "c"), (None, None, None, None), (9, "\\### x </turn> <|endoftext|> 🙂 é", "fr", "b"),
        (10, "the The THE\tthe\n\nthe the", "en", "c"), (11, "the the the the the the", "en", "c"),
    ]
    near = base.split()
    for k in range(12):  # near and exact copies
        own = near[:]
        for _ in range(k // 2):
            own[rng.randrange(len(own))] = words(rng, 1)
        out.append((20 + k, " ".join(own), "en", "a"))
    out += [(40 + k, words(rng, rng.randrange(1, 60)), "en", rng.choice("abc")) for k in range(20)]
    return out


def documents(spark, data=None, extra=()):
    fields = [StructField("doc_id", LongType()), *[StructField(c, StringType()) for c in ("text", "lang", "source")], StructField("n_chars", LongType())]
    data = rows() if data is None else data
    data = [(i, t, lang, source, None if t is None else len(t), *["x"] * len(extra)) for i, t, lang, source in data]
    return spark.createDataFrame(data, StructType([*fields, *[StructField(c, StringType()) for c in extra]]))


def as_table(tmp_path, spark, docs, **others) -> str:
    """A folder of tables as the queries read them."""
    for name, df in {"documents": docs, **others}.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
_WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text: str | None) -> set:
    own = _WORD.findall((text or "").translate(_LOWER))
    return {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()


def near_groups(data: list[tuple[int, str]], percent: int = 85) -> dict[int, tuple[int, int]]:
    """Shingles and smallest reachable id of each document, from all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in data}
    holders = defaultdict(list)
    for i, own in sorted(sets.items()):
        for s in own:
            holders[s].append(i)
    common = Counter((a, b) for ids in holders.values() for n, b in enumerate(ids) for a in ids[:n])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}

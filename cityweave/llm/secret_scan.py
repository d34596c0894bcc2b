"""Secrets in text: patterns that stand alone, and weak parts that count only together.

Base kinds are ``assign``, ``access`` and ``hex``, leftmost non-overlapping matches of each. Weak kinds
are reported only if a part of another role is less than ``SCOPE`` code points away, since a credential is
made of an identifier, a secret and the endpoint it opens:

    ident      an account or key id that is assigned          identifier
    material   32 or more base64 signs with letters and digits  secret
    endpoint   an address with a scheme                       endpoint

``access`` counts as an identifier, ``assign`` and ``hex`` as secrets. A weak match that overlaps a base
one is not reported. Parts and scopes are joined on bins of the scope's width, so a part only meets what
is near it; matches of one kind don't overlap, which bounds what a bin holds.

Positions are code points, end exclusive. They come from the pieces between the matches: a match
begins where the lengths of the pieces and matches before it add up to.

Edge cases: a null or empty text has no spans. Rows that repeat an id are told apart by their
texts; rows that repeat both have the same spans each. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import id_text, stored, text_of

#: Fixed patterns of the base kinds, and the least length of what counts (for ``assign``, of its value).
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
IDENT = r"""(?i:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}"""
MATERIAL = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[0-9+/]*[A-Za-z])[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""\b[a-z][a-z0-9+]{1,15}://[^\x00-\x20"'<>]+"""
#: Kinds in the order that ties go by.
KINDS = ("assign", "access", "hex", "ident", "material", "endpoint")
BASE = KINDS[:3]
ROLE = {"access": "identifier", "ident": "identifier", "assign": "secret", "hex": "secret", "material": "secret", "endpoint": "endpoint"}
SCOPE = 200

SPAN = "struct<start:int,kind:int,stop:int>"


def matches(kind: str, text: Column, pattern: str, counts=None) -> Column:
    """Spans of all leftmost non-overlapping matches; ``counts`` tells from a match whether it is kept."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("before"), found.alias("match"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["before"])
        stop = start + F.char_length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), stop.alias("stop"))
        more = F.concat(state["spans"], F.array(span))
        spans = more if counts is None else F.when(counts(pair["match"]), more).otherwise(state["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(none)


def _scan(docs: DataFrame) -> DataFrame:
    """Base and weak spans of each row, stored without the texts."""
    text = F.col("scanned")
    value = lambda match: F.char_length(F.regexp_replace(match, "^" + ASSIGN, "")) >= LEAST_VALUE
    base = F.array_sort(F.concat(matches("assign", text, ASSIGN + VALUE, value), matches("access", text, ACCESS), matches("hex", text, HEX)))
    weak = F.concat(matches("ident", text, IDENT), matches("material", text, MATERIAL), matches("endpoint", text, ENDPOINT))
    rows = docs.select("doc_id", text_of().alias("scanned"))
    key = F.concat_ws(":", id_text(), F.xxhash64("scanned").cast("string"))
    rows = rows.select("doc_id", key.alias("row_key"), base.alias("base"), weak.alias("weak"))
    clear = F.filter("weak", lambda w: ~F.exists("base", lambda b: (w["start"] < b["stop"]) & (b["start"] < w["stop"])))
    return stored(rows.withColumn("weak", clear), "secret-spans")


def _role(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for at, name in enumerate(KINDS):
        out = F.when(kind == at, ROLE[name]).otherwise(out)
    return out


def _bins(start: Column, stop: Column) -> Column:
    """The bins that an interval touches."""
    return F.explode(F.sequence(F.floor(F.greatest(start, F.lit(0)) / SCOPE).cast("int"), F.floor((stop - 1) / SCOPE).cast("int")))


def linked(spans: DataFrame) -> DataFrame:
    """Weak spans with a complementary part in scope: ``row_key``, ``span``, each once."""
    some = spans.where(F.size("weak") > 0)
    weak = some.select("row_key", F.explode("weak").alias("span")).distinct()
    weak = weak.select(
        "row_key", "span", _role(F.col("span.kind")).alias("role"), (F.col("span.start") - SCOPE).alias("low"), (F.col("span.stop") + SCOPE).alias("high")
    ).withColumn("bin", _bins(F.col("low"), F.col("high")))
    parts = some.select("row_key", F.explode(F.concat("base", "weak")).alias("part")).distinct()
    parts = parts.select(
        "row_key", _role(F.col("part.kind")).alias("part_role"), F.col("part.start").alias("begin"), F.col("part.stop").alias("end")
    ).withColumn("bin", _bins(F.col("begin"), F.col("end")))
    near = (F.col("role") != F.col("part_role")) & (F.col("begin") < F.col("high")) & (F.col("low") < F.col("end"))
    met = weak.alias("w").join(parts.alias("p"), (F.col("w.row_key") == F.col("p.row_key")) & (F.col("w.bin") == F.col("p.bin")) & near, "left_semi")
    return met.select("row_key", "span").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans``, sorted arrays of ``(start, kind, stop)``.

    ``kind`` is a position in ``KINDS``; ``spans`` holds the base spans and the linked weak ones.
    """
    rows = _scan(docs)
    more = linked(rows).groupBy("row_key").agg(F.collect_list("span").alias("more"))
    joined = rows.join(more, "row_key", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))))
    return joined.select("doc_id", "base", spans.alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")

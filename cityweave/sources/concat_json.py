"""Files of JSON objects written one after the other without a line end: ``{...}{...}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityweave.operators.clean import parse_records, without_strings

# Signs that JSON text can't hold as they are: stand-ins for escapes, and the cut between objects.
_BACKSLASH, _QUOTE, _CUT = "\x01", "\x02", "\x03"
# Where a large file is cut: between two objects, the second of which has a key.
_SEPARATOR = '}{"'


def cut_objects(text: Column) -> Column:
    """The objects of a text. Between two of them a ``}`` meets a ``{``, which no quoted string is searched for."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    cut = F.transform(
        F.split(plain, '"', -1),  # by turns outside and inside of strings
        lambda part, n: F.when(n % 2 == 0, F.regexp_replace(part, r"\}\s*\{", "}" + _CUT + "{")).otherwise(part),
    )
    joined = F.array_join(cut, '"')
    return F.split(F.replace(F.replace(joined, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\")), _CUT, -1)


def split_objects(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row per object; what isn't whole objects comes out as it is and fails to parse."""
    return texts.select(F.explode(cut_objects(F.col(column))).alias(column)).where(~F.regexp_like(column, F.lit(r"^\s*$")))


def read_concat_json(
    spark: SparkSession, path: str, schema: StructType, whole_files: bool = True, streaming: bool = False
) -> DataFrame:
    """Records of ``schema`` plus ``_corrupt_record``; every object of every file is in one or the other.

    ``whole_files`` holds a file in one row, which suits the files of a delivery stream (some
    megabytes). Without it the reader itself cuts at ``}{"``, so that one huge file is shared out among
    tasks. What stands between two such places may hold any number of objects, blanks and line ends. Only a
    string that ends in ``}{`` is cut in two there, and both halves are rejected.
    """
    reader = spark.readStream if streaming else spark.read
    if whole_files:
        return parse_records(split_objects(reader.option("wholetext", "true").text(path)), schema)
    pieces = reader.option("lineSep", _SEPARATOR).text(path)
    # A piece lost what the separator holds, but for the ends of a file.
    value = F.col("value")
    opened = F.when(F.regexp_like(value, F.lit(r"^\s*(\{|$)")), value).otherwise(F.concat(F.lit('{"'), value))
    bare = without_strings(F.col("value"))
    surplus = F.length(F.regexp_replace(bare, r"[^{]", "")) - F.length(F.regexp_replace(bare, r"[^}]", ""))
    closed = F.when(surplus == 1, F.concat("value", F.lit("}"))).otherwise(value)
    whole = pieces.select(opened.alias("value")).select(closed.alias("value"))
    return parse_records(split_objects(whole), schema)

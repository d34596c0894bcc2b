"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.session import work_path

#: One hex digit is four bits; 13 of them fit a double without loss.
UNIT_DIGITS = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hex_number(digest: Column, digits: int = UNIT_DIGITS) -> Column:
    """The first hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def unit_draw(*parts: Column) -> Column:
    """A number from 0 up to 1 that only depends on the parts; ``md5`` so that SQL can repeat it."""
    return hex_number(F.md5(F.concat_ws(":", *parts))) / F.lit(float(16**UNIT_DIGITS))


def id_text(column: str = "doc_id") -> Column:
    """An id as text; a null id is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """Marks a stored table for broadcast if it has at most so many rows; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


#: A key is hot when it holds more than one row in so many; there are no more hot keys than that.
HOT_SHARE = 10_000


def meet(many: DataFrame, one: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """Inner join with a stored table of one row per key, whose column ``rows`` counts the key's rows among ``total``.

    Hot keys are at most ``HOT_SHARE``, so their side is broadcast and their rows stay where they are; all others meet by a shuffle.
    """
    hot = F.col(rows) > total / HOT_SHARE
    few, rest = F.broadcast(one.where(hot)), one.where(~hot)
    others = many.join(few.select(*keys), keys, "left_anti")
    return many.join(few, keys).unionByName(others.hint("merge").join(rest, keys))


#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 2000


def short_batches(df: DataFrame) -> DataFrame:
    """The rows themselves; lowers the session's rows per Arrow batch to ``BATCH_ROWS``, as both ends of the way to Python hold whole batches."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def give_back() -> None:
    """Returns freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives freed memory back to the system at its end.

    Python processes wait for the next task of any stage, and what they hold meanwhile counts for their executor.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of one piece come to about ``most`` bytes; a longer text is alone.

    A column of numbers holds the sizes itself.
    """
    for batch in batches:
        values = batch.column(column)
        lengths = (values if pa.types.is_integer(values.type) else pa.compute.binary_length(values)).to_pylist()
        begin, size = 0, 0
        for at, length in enumerate(lengths):
            if at > begin and size + (length or 0) > most:
                yield batch.slice(begin, at - begin)
                begin, size = at, 0
            size += length or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)

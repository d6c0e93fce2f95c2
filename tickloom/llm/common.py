"""What several operators share: inputs by position, bounded Arrow batches, per-process caches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, which separates words.
SPACES = r"[\x20\x09-\x0D]+"
#: Rows of an output batch and bytes of text worked on at a time in a Python task.
BATCH_ROWS, BATCH_BYTES = 2_000, 4_000_000


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is empty."""
    return df.select(
        column(df, id_col).alias("doc_id"), F.coalesce(column(df, text_col).cast("string"), F.lit("")).alias("text")
    )


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters that holds."""
    return df["`" + name.replace("`", "``") + "`"]


def text_key(df: DataFrame, text_col: str) -> Column:
    """Hash of a row's text; with the row's id it names the text."""
    return F.xxhash64(F.coalesce(column(df, text_col).cast("string"), F.lit("")))


def words_of(text: Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def process_cache(key: object, make: Callable[[], object]) -> object:
    """A value made once per Python worker; functions travel by value, so modules cannot hold it."""
    held = sys.modules.setdefault("_loom_held", types.ModuleType("_loom_held")).__dict__.setdefault("values", {})
    if key not in held:
        held[key] = make()
    return held[key]


def give_back() -> None:
    """Returns memory that is free again to the system. A Python worker keeps it otherwise, for as long as
    it lives: beside the workers of later steps that is most of what idle ones hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], sized: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of few rows and, unless one row is larger, few bytes of column ``sized``."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(sized)).fill_null(0).to_pylist()
        begin = size = 0
        for i, n in enumerate(lengths):
            if i > begin and (size + n > BATCH_BYTES or i - begin >= BATCH_ROWS):
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if begin < batch.num_rows:
            yield batch.slice(begin)
    give_back()


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()

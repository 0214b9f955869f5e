"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.session import shared_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python step works on and hands on together.
SLICE_ROWS = 512


def release_memory() -> None:
    """Give back what Arrow and the C library hold for later: a worker outlives its task and stands beside others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def copied(values):
    """An Arrow array or batch on its own; a slice keeps the whole batch in memory that it was read with."""
    return values.take(pa.array(np.arange(len(values))))


def handing_back(steps: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function for ``mapInArrow``; when it ends, the worker gives back the memory that it took."""

    def apply(batches):
        yield from steps(batches)
        release_memory()

    return apply


def in_slices(step: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that works on a few rows at a time and hands its memory back."""

    def steps(batches):
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                yield copied(step(batch.slice(at, SLICE_ROWS)))

    return handing_back(steps)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` as a table in the folder all executors share: computed once, and safe when executors are lost."""
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def count_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def row_key(id_col: str = "doc_id", text: str = "text") -> Column:
    """A 128-bit key of id and text, as hexadecimal digits; rows that agree in it are repeated rows."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(text_or_empty(text))))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*(F.col("`" + name.replace("`", "``") + "`") for name in docs.columns))


def only_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose ``row_key`` is among ``keys``, one of each, with the columns of ``docs``.

    The join and the removal of repeated rows use one key, so that the texts are shuffled once.
    """
    rows = docs.select(whole_row(docs).alias("the_row"), row_key(id_col, text).alias("the_key"))
    wanted = keys.select(F.col("row_key").alias("the_key")).distinct()
    return rows.join(wanted, "the_key", "left_semi").dropDuplicates(["the_key"]).select("the_row.*")

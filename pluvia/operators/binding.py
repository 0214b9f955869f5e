"""From the text of station files to rows whose columns are found by header name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import is_blank, parse_decimal, split_cells, split_key_value
from ..schemas import METADATA_KEYS, METADATA_LINES, NUMERIC_METADATA


def _typed(values: Mapping[str, Column], numeric: Sequence[str]) -> list[Column]:
    return [
        (parse_decimal(value) if name in numeric else value).alias(name) for name, value in values.items()
    ]


def read_file_metadata(
    files: DataFrame,
    keys: Mapping[str, str] = METADATA_KEYS,
    numeric: Sequence[str] = NUMERIC_METADATA,
    metadata_lines: int = METADATA_LINES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(file, lines)`` -> one row per file: its metadata, ``header`` cells and ``body`` lines.

    A key that is missing or spelt differently is NULL; of a repeated key the last value counts.  Blank
    lines below the metadata are skipped.
    """
    pairs = F.transform(F.slice("lines", 1, metadata_lines), split_key_value)
    below = F.filter(
        F.slice("lines", F.lit(metadata_lines + 1), F.greatest(F.size("lines"), F.lit(0))),
        lambda line: ~is_blank(line),
    )
    parts = files.select("file", *keep, pairs.alias("_pairs"), below.alias("_below"))

    def value_of(key: str) -> Column:
        matches = F.filter("_pairs", lambda pair: pair["key"] == key)
        return F.get(F.reverse(matches), F.lit(0))["value"]

    return parts.select(
        "file",
        *keep,
        *_typed({name: value_of(key) for key, name in keys.items()}, numeric),
        split_cells(F.get("_below", F.lit(0))).alias("header"),
        F.slice("_below", F.lit(2), F.greatest(F.size("_below"), F.lit(0))).alias("body"),
    )


def read_line_metadata(
    lines: DataFrame,
    keys: Mapping[str, str] = METADATA_KEYS,
    numeric: Sequence[str] = NUMERIC_METADATA,
    metadata_lines: int = METADATA_LINES,
) -> DataFrame:
    """``read_file_metadata`` for ``(file, number, line)`` rows: one row per file, without ``body``.

    ``number`` counts a file's lines from 1; only as many lines need one as reach to the header.  The result
    has ``header_number`` in place of the body.
    """
    number, line = F.col("number"), F.col("line")
    described = lines.where(number.isNotNull()).select(
        "file", "number", "line", F.when(number <= metadata_lines, split_key_value(line)).alias("pair")
    )
    below = F.when((number > metadata_lines) & ~is_blank(line), number)
    values = [
        F.max_by(F.when(F.col("pair.key") == key, F.col("pair.value")), F.when(F.col("pair.key") == key, number)).alias(name)
        for key, name in keys.items()
    ]
    grouped = described.groupBy("file").agg(
        *values, F.min_by("line", below).alias("header"), F.min(below).alias("header_number")
    )
    return grouped.select(
        "file",
        *_typed({name: F.col(name) for name in keys.values()}, numeric),
        split_cells(F.col("header")).alias("header"),
        "header_number",
    )


def attach_metadata(rows: DataFrame, metadata: DataFrame, on: str | Sequence[str] = "file") -> DataFrame:
    """Left join: rows without a record keep NULLs.

    Spark broadcasts the metadata by its bytes; where it shuffles, AQE splits the rows of an outsized file.
    """
    return rows.join(metadata, on, "left")


def header_positions(header: Column, names: Sequence[str]) -> Column:
    """Where each of ``names`` stands in a header, counted from 0; -1 where it is absent."""
    return F.array(*[F.array_position(header, F.lit(name)).cast("int") - 1 for name in names])


def unknown_headers(header: Column, known: Sequence[str]) -> Column:
    """``struct(name, position)`` of the headers outside ``known``; unnamed ones do not count."""
    names = F.array_distinct(
        F.filter(header, lambda name: ~name.isin("", *known) & ~F.startswith(name, F.lit("Unnamed")))
    )
    return F.transform(
        names,
        lambda name: F.struct(
            name.alias("name"), (F.array_position(header, name).cast("int") - 1).alias("position")
        ),
    )


def _text_at(cells: Column, position: Column) -> Column:
    # get() is NULL for -1 and past the end of a short row.
    return F.nullif(F.get(cells, position), F.lit(""))


def bind_cells(
    rows: DataFrame, columns: Sequence[str], positions: str = "positions", cells: str = "cells"
) -> DataFrame:
    """Add one text column per entry of ``positions``; an empty cell is NULL."""
    bound = {
        column: _text_at(F.col(cells), F.get(positions, F.lit(index)))
        for index, column in enumerate(columns)
    }
    return rows.withColumns(bound)


def bind_columns_by_name(
    rows: DataFrame, names: Mapping[str, str], header: str = "header", cells: str = "cells"
) -> DataFrame:
    """Add one text column per ``header name -> column``, wherever each file has it, else NULL.

    Cells under an empty header (a trailing ``;``) bind to nothing.
    """
    placed = rows.withColumn("_positions", header_positions(F.col(header), list(names)))
    return bind_cells(placed, list(names.values()), "_positions", cells).drop("_positions")


def extra_cells(unknown: Column, cells: Column) -> Column:
    """map(header name -> cell) of ``unknown_headers``, NULL where there are none."""
    entries = F.transform(unknown, lambda u: F.struct(u["name"], _text_at(cells, u["position"])))
    return F.when(F.size(unknown) > 0, F.map_from_entries(entries))

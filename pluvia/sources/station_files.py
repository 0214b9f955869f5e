"""Scan of raw station files: ``<raw>/<year>/*.CSV``, Latin-1, one station and year per file.

A station-year is about a megabyte, and its first lines describe all the others.  Small files are
therefore read whole, one row per file: metadata, header and line numbers are at hand in the task, and
exploding the lines needs neither a join nor a shuffle.  A file above ``whole_file_limit`` is never held
whole: it is cut into ranges of bytes, each read by itself together with the file's own head, and what a
range gives is a small file again (see ``byte_ranges``).  Only on file systems that Python cannot open is
such a file read as splittable lines, and the metadata joined back.

Either way position decides what a line is: the first eight are metadata, the first one below that is not
blank is the header, and whatever follows is data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.binding import (
    attach_metadata,
    header_positions,
    read_file_metadata,
    read_line_metadata,
    unknown_headers,
)
from ..functions.parsing import is_blank
from ..schemas import DATE_HEADER, HOUR_HEADER, MEASURE_HEADERS
from ..session import qualified
from .byte_ranges import RANGE_BYTES, read_ranges, readable
from .tables import read_or_empty

ENCODING = "ISO-8859-1"
# Any spelling of the suffix, in any folder below the year's.
FILE_GLOB = "*.[cC][sS][vV]"
WHOLE_FILE_LIMIT = 16 << 20
RANGES_PER_TASK = 16
#: What opening a file is worth, in bytes read.
OPEN_BYTES = 64 << 10
#: As the listing has it: a condition on it is decided before there are tasks.
FILE_SIZE = "_metadata.file_size"
HEADERS = (DATE_HEADER, HOUR_HEADER, *MEASURE_HEADERS)


def _year_of(path: Column) -> Column:
    """The landing folder's year, the last numeric folder of the path; NULL where there is none."""
    return F.regexp_extract(path, "/([0-9]+)/(?:[^/]*[^/0-9][^/]*/)*[^/]+$", 1).try_cast("int")


def _locate_columns(described: DataFrame, strict: bool = False) -> DataFrame:
    """Replace ``header`` by where the known headers stand and which others there are.

    Done once per file: its rows then carry a few numbers in place of the header's texts.  With ``strict`` a
    file without the columns of the time fails here, even if it has no rows.
    """
    header = F.col("header")
    positions = header_positions(header, HEADERS)
    if strict:
        failure = F.raise_error(F.concat(F.lit("no date or hour column in "), F.col("file")))
        timed = F.array_contains(header, F.lit(DATE_HEADER)) & F.array_contains(header, F.lit(HOUR_HEADER))
        positions = F.when(timed, positions).otherwise(failure.cast("array<int>"))
    located = {"positions": positions, "unknown": unknown_headers(header, HEADERS)}
    return described.withColumns(located).drop("header")


def _folders(raw_root: str, years: Iterable[int]) -> list[str]:
    return [f"{raw_root.rstrip('/')}/{year}" for year in years]


def _listing(spark: SparkSession, folders: list[str], glob: str) -> DataFrame:
    """``(path, modificationTime, length, content)``; content is read only where it is selected."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return scan.load(folders)


def file_lines(files: DataFrame, encoding: str = ENCODING) -> DataFrame:
    """``(file, ano, content)`` -> ``(file, ano, lines array<string>)``; other columns stay."""
    text = F.decode("content", encoding)
    # Every kind of line break becomes a newline first: splitting by one character needs no regex.
    for line_break in ("\r\n", "\r"):
        text = F.replace(text, F.lit(line_break), F.lit("\n"))
    kept = [name for name in files.columns if name != "content"]
    return files.select(*kept, F.split(text, "\n").alias("lines"))


def rows_from_files(files: DataFrame, strict: bool = False) -> DataFrame:
    """``(file, ano, content)`` -> a row per data line: ``(file, ano, <metadata>, positions, unknown, number, line)``.

    ``number`` tells the lines of a file apart; a column ``base`` is added to it, for files that come in parts.
    """
    kept = [name for name in files.columns if name not in ("file", "content")]
    described = _locate_columns(read_file_metadata(file_lines(files), keep=kept), strict)
    # The outer form, because for the inner one Spark derives a filter on the array and evaluates the
    # whole decoding again for it, below.  A file without rows gives one NULL line.
    rows = described.select(*[c for c in described.columns if c != "body"], F.posexplode_outer("body").alias("number", "line"))
    number = F.col("number").cast("long")
    if "base" in kept:
        number = number + F.col("base")
    return rows.where(F.col("line").isNotNull()).withColumn("number", number).drop("base")


def rows_from_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The same rows from ``(file, ano, number, line)``, for files whose lines are spread over many tasks.

    ``number`` counts the lines of a file from 1, and is NULL for lines known to lie below the header; an
    optional column ``id`` then tells them apart.
    """
    ids = F.col("id") if "id" in lines.columns else F.col("number")
    described = _locate_columns(read_line_metadata(lines), strict)
    data = attach_metadata(lines.withColumn("id", ids).where(~is_blank(F.col("line"))), described)
    below = F.col("number").isNull() | (F.col("number") > F.col("header_number"))
    return data.where(below).drop("number", "header_number").withColumnRenamed("id", "number")


def scan_small_files(
    spark: SparkSession,
    raw_root: str,
    years: Iterable[int],
    limit: int = WHOLE_FILE_LIMIT,
    glob: str = FILE_GLOB,
    strict: bool = False,
) -> DataFrame:
    """Rows of the files up to ``limit`` bytes, each read by one task."""
    return _rows_of_listing(_listing(spark, _folders(raw_root, years), glob), limit, strict)


def _rows_of_listing(listing: DataFrame, limit: int, strict: bool) -> DataFrame:
    path = F.col("path")
    # The size in the listing keeps the other files out of the tasks, the length keeps them from being read.
    small = listing.where((F.col(FILE_SIZE) <= limit) & (F.col("length") <= limit))
    return rows_from_files(small.select(path.alias("file"), _year_of(path).alias("ano"), "content"), strict)


def scan_large_files(
    spark: SparkSession,
    raw_root: str,
    years: Iterable[int],
    limit: int = WHOLE_FILE_LIMIT,
    glob: str = FILE_GLOB,
    strict: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Rows of the files above ``limit`` bytes, each split over many tasks and read once."""
    folders = _folders(raw_root, years)
    if not readable(qualified(spark, raw_root)):
        return _rows_of_lines(spark, folders, limit, glob, strict)
    listing = _listing(spark, folders, glob)
    return _rows_of_ranges(listing, limit, strict, range_bytes, _tasks(listing, limit, range_bytes))


def _large(listing: DataFrame, limit: int) -> DataFrame:
    return listing.where((F.col(FILE_SIZE) > limit) & (F.col("length") > limit))


def _tasks(listing: DataFrame, limit: int, range_bytes: int) -> int:
    """How many tasks the ranges of the files above ``limit`` are worth; 0 if there is no such file.

    From the listing alone: no file is read for it, and where all are small none reaches a task.  It goes by bytes, with
    some more for each file: going by ranges, a folder of small files would get a task for every few of them, and a shuffle
    of as many blocks as the square of that.
    """
    length = F.col("length")
    found = _large(listing, limit).agg(F.sum(F.ceil(length / range_bytes)), F.sum(length + OPEN_BYTES)).first()
    if not found[0]:
        return 0
    parallel = listing.sparkSession.sparkContext.defaultParallelism
    return min(found[0], max(parallel, -(-found[1] // (RANGES_PER_TASK * range_bytes))))


def _rows_of_ranges(listing: DataFrame, limit: int, strict: bool, range_bytes: int, tasks: int) -> DataFrame:
    path, length = F.col("path"), F.col("length")
    offsets = F.sequence(F.lit(0).cast("long"), length - 1, F.lit(range_bytes).cast("long"))
    ranges = _large(listing, limit).coalesce(tasks).select(
        path.alias("file"), _year_of(path).alias("ano"), "length", F.explode(offsets).alias("offset")
    )
    # A number of tasks of our own: by the bytes of this list of ranges, which say nothing, they would become one.
    return rows_from_files(read_ranges(ranges.repartition(tasks), range_bytes), strict)


def _rows_of_lines(spark: SparkSession, folders: list[str], limit: int, glob: str, strict: bool) -> DataFrame:
    """The same by Spark's own reader of text, which every file system of Spark's will do for; reads large files thrice.

    Lines are numbered within the block a file begins with, which holds metadata and header; ids grow in
    steps of one within a block.
    """
    scan = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(folders)
        .where(F.col("_metadata.file_size") > limit)
        .select(
            F.col("_metadata.file_path").alias("file"),
            (F.col("_metadata.file_block_start") == 0).alias("first_block"),
            F.decode(F.col("value").cast("binary"), ENCODING).alias("line"),
            F.monotonically_increasing_id().alias("id"),
        )
    )
    begins = scan.where("first_block").groupBy("file").agg(F.min("id").alias("begin"))
    number = F.when(F.col("first_block"), F.col("id") - F.col("begin") + 1)
    lines = scan.join(begins, "file", "left").select(
        "file", _year_of(F.col("file")).alias("ano"), number.alias("number"), "line", "id"
    )
    return rows_from_lines(lines, strict)


def scan_station_files(
    spark: SparkSession,
    raw_root: str,
    years: Iterable[int],
    limit: int = WHOLE_FILE_LIMIT,
    glob: str = FILE_GLOB,
    strict: bool = False,
) -> DataFrame:
    """Every data row of the years' station files, whatever the file sizes."""
    years = list(years)
    listing = _listing(spark, _folders(raw_root, years), glob)
    small = _rows_of_listing(listing, limit, strict)
    tasks = _tasks(listing, limit, RANGE_BYTES)
    if not tasks:
        return small
    if readable(qualified(spark, raw_root)):
        return small.unionByName(_rows_of_ranges(listing, limit, strict, RANGE_BYTES, tasks))
    return small.unionByName(_rows_of_lines(spark, _folders(raw_root, years), limit, glob, strict))


def _landed(spark: SparkSession, raw_root: str, glob: str = "*") -> DataFrame:
    """``ano`` of every file in a landing folder; lists the folders, reads no file."""
    files = read_or_empty(
        spark, "path string", lambda: _listing(spark, [f"{raw_root.rstrip('/')}/*"], glob)
    )
    return files.select(_year_of(F.col("path")).alias("ano")).where(F.col("ano").isNotNull())


#: Below the landing folders; hidden from reads of them.
MARKS = "_landed"


def mark_landed(spark: SparkSession, raw_root: str, year: int, files: int) -> None:
    """Note that all members of the year's archive are in its folder.  Written last."""
    mark = spark.createDataFrame([(files, year)], "arquivos long, ano int").coalesce(1)
    (
        mark.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ano")
        .parquet(f"{raw_root.rstrip('/')}/{MARKS}")
    )


def landed_years(spark: SparkSession, raw_root: str) -> DataFrame:
    """``ano`` of every year that has landed completely."""
    schema = "arquivos long, ano int"
    marks = read_or_empty(
        spark, schema, lambda: spark.read.schema(schema).parquet(f"{raw_root.rstrip('/')}/{MARKS}")
    )
    return marks.select("ano").distinct()


def landed_files(
    spark: SparkSession, raw_root: str, years: Iterable[int], glob: str = FILE_GLOB
) -> DataFrame:
    """``(ano, arquivos)``: number of station files of each of the years."""
    files = _landed(spark, raw_root, glob).where(F.col("ano").isin(list(years)))
    return files.groupBy("ano").agg(F.count(F.lit(1)).alias("arquivos"))


def pending_years(requested: DataFrame, landed: DataFrame, year: str = "ano") -> DataFrame:
    """The requested years that have not landed yet."""
    return requested.join(landed.select(year).distinct(), year, "left_anti")

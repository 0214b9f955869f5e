"""Token counts from flat token files without an index, by a scan for the end-of-document id.

A token file is nothing but ids, little-endian numbers of one width, each document ended by the end id.  Files are cut
into blocks at fixed offsets and every block is searched by one vectorised comparison, wherever documents begin or end.
What crosses block boundaries is stitched by a prefix scan over one thin row per block: the ends seen before a block
number its documents, and the last end before it is where its first document starts.  The scan runs within groups of
blocks and then over the groups, so that one enormous file is not one task either.

Blocks are read by byte range from the folder all executors share, through pyarrow's file systems; a file is written
under another name and then renamed, so that a task that runs twice replaces it by the same bytes.

Defined cases: a file without ids has no documents; ids after the last end id are a document that is not ``ended``; two
end ids in a row enclose a document of no ids; a file whose size is not a multiple of the width is an error; null texts
count as empty; rows are written in the order they are read, repeated ones too; an empty table gives no documents;
other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvia.session import shared_dir

from .common import written
from .tokens import encoder

#: Bytes of a block.
BLOCK = 4 << 20
#: Blocks of a group in the prefix scan.
GROUP = 1024


def storage(uri: str):
    """pyarrow's file system and the path in it; Spark writes local paths as ``file:/...``."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _write(tokenizer: str, end_id: int, folder: str):
    names = ["file", "number", "doc_id"]

    def apply(batches):
        tool = encoder(tokenizer)
        end = np.array([end_id], tool.dtype).tobytes()
        name = f"part-{TaskContext.get().partitionId():06d}.tok"
        system, root = storage(folder)
        draft = f"{root}/.{name}.{uuid.uuid4().hex}"
        number = 0
        with system.open_output_stream(draft) as out:
            for batch in batches:
                for at, ids, counts in tool.encode_groups(batch.column(1)):
                    some = batch.slice(at, len(counts))
                    stops = np.cumsum(counts)
                    for start, stop in zip(stops - counts, stops):
                        out.write(ids[start:stop].tobytes() + end)
                    numbers = pa.array(np.arange(number, number + len(some)))
                    number += len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), numbers, some.column(0)], names=names
                    )
        system.move(draft, f"{root}/{name}")

    return apply


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text"
) -> tuple[str, DataFrame]:
    """Encode the texts into flat files, one per task; returns the folder, and (file, number, doc_id) of what went where."""
    folder = shared_dir(docs.sparkSession, "token-files")
    system, root = storage(folder)
    system.create_dir(root, recursive=True)
    chosen = docs.select(F.col(id_col).cast("long"), F.col(text))
    placed = chosen.mapInArrow(_write(tokenizer, end_id, folder), "file string, number long, doc_id long")
    return folder, written(placed, "token-files-placed")


def _search(end_id: int, width: int):
    dtype = np.dtype(f"<u{width}")
    schema = pa.schema(
        [
            ("file", pa.string()),
            ("block", pa.int64()),
            ("n_ends", pa.int64()),
            ("last_end", pa.int64()),
            ("stop", pa.int64()),
            ("ends", pa.list_(pa.int64())),
            ("behind", pa.list_(pa.int64())),  # the end before each, null for the first
        ]
    )

    def apply(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = storage(row["path"])
                with system.open_input_file(path) as file:
                    ids = np.frombuffer(file.read_at(row["bytes"], row["offset"]), dtype)
                ends = np.flatnonzero(ids == end_id) + row["offset"] // width
                columns = [
                    [path.rsplit("/", 1)[-1]],
                    [row["block"]],
                    [len(ends)],
                    [int(ends[-1]) if len(ends) else None],
                    [row["offset"] // width + len(ids)],
                    [ends],
                    [pa.array([None, *ends[:-1]] if len(ends) else [], pa.int64())],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return apply


def _scanned(blocks: DataFrame, group: int) -> DataFrame:
    """(file, block, n_ends, last_end) -> with the ends ``before`` the block and the last of them, ``previous``."""
    grouped = blocks.withColumn("group", F.floor(F.col("block") / group))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("file", "group").agg(
        F.sum("n_ends").alias("group_ends"), F.max("last_end").alias("group_last")
    )
    groups = groups.select(
        "file",
        "group",
        F.coalesce(F.sum("group_ends").over(across), F.lit(0)).alias("earlier"),
        F.max("group_last").over(across).alias("earlier_last"),
    )
    return (
        grouped.withColumn("own", F.coalesce(F.sum("n_ends").over(inside), F.lit(0)))
        .withColumn("own_last", F.max("last_end").over(inside))
        .join(groups, ["file", "group"])
        .select(
            "file",
            "block",
            (F.col("earlier") + F.col("own")).alias("before"),
            F.coalesce("own_last", "earlier_last", F.lit(-1)).alias("previous"),
        )
    )


def scan_token_files(
    spark: SparkSession, folder: str, end_id: int, width: int, block_bytes: int = BLOCK, group: int = GROUP
) -> DataFrame:
    """Per document of the files: file, number in it, start, n_tokens (without the end id), ended."""
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "length")
    length = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number of ids: "), F.col("path")))
    )
    blocks = (
        files.select("path", length.alias("length"))
        .where("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / block_bytes))).alias("block"))
        .select("path", "block", (F.col("block") * block_bytes).alias("offset"), "length")
        .withColumn("bytes", F.least(F.lit(block_bytes), F.col("length") - F.col("offset")))
        .repartition("path", "block")
    )
    found = written(
        blocks.mapInArrow(
            _search(end_id, width),
            "file string, block long, n_ends long, last_end long, stop long, ends array<long>, behind array<long>",
        ),
        "token-ends",
    )
    scanned = written(_scanned(found.select("file", "block", "n_ends", "last_end"), group), "token-scan")
    # Within a block a document starts behind the end before it; the first one of a block, behind ``previous``.
    inner = found.select("file", "block", F.posexplode(F.arrays_zip("ends", "behind")).alias("at", "pair")).select(
        "file", "block", "at", F.col("pair.ends").alias("end"), F.col("pair.behind").alias("behind")
    )
    closed = inner.join(scanned, ["file", "block"]).select(
        "file",
        (F.col("before") + F.col("at")).alias("number"),
        (F.coalesce("behind", "previous") + 1).alias("start"),
        (F.col("end") - F.coalesce("behind", "previous") - 1).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    totals = found.groupBy("file").agg(
        F.max("stop").alias("stop"), F.sum("n_ends").alias("number"), F.max("last_end").alias("last")
    )
    start = F.coalesce(F.col("last"), F.lit(-1)) + 1
    tail = totals.where(F.col("stop") > start).select(
        "file", "number", start.alias("start"), (F.col("stop") - start).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return closed.unionByName(tail)

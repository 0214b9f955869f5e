"""Exact dedup by block naming: every text gets one integer such that two texts share it only if they are equal.

Texts are cut into blocks of ``BLOCK`` UTF-8 bytes.  Level 0 sorts the blocks by content and names each distinct block
by an integer, the number of its smallest occurrence; then adjacent names are paired and the pairs named in the same
way, until every document is down to one name.  A name stands for exactly one sequence of bytes (a short last block and
an odd last name are told from any other by their content), so no hash decides equality.

How it is distributed: a task keeps each distinct block of a batch of documents once, so that a text copied a million
times leaves one block per batch, and only those are shuffled by content and sorted.  Pairs of names are reduced by a
partial aggregate before their shuffle and joined back, where Spark may split a hot pair.  Blocks and every level are
written tables: a lost executor costs some tasks, not the recursion.

Defined cases: a null text counts as empty, and all empty texts are equal (they have one block, the empty one); in a
group the row with the largest id stays, a null id counting as smallest; of several rows with that id one stays; empty
tables give empty results; other columns of the input are not looked at, and may have any name.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import handing_back, only_rows, row_key, written

#: Bytes of a block.
BLOCK = 4096
#: Bytes of distinct blocks and of references to them in a batch; one longer text is a batch of its own.
BATCH_BYTES = 8 << 20

_BLOCKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),  # number of the document: that of its first block
        ("n_bytes", pa.int64()),
        ("text_sha256", pa.string()),  # on the first block only
        ("row_key", pa.string()),
        ("n_blocks", pa.int64()),
        ("position", pa.int64()),
        ("number", pa.int64()),  # of this block, unique in the table
        ("home", pa.int64()),  # number of the first equal block of the batch
        ("block", pa.binary()),  # only if this is that block
    ]
)


def _cut(block_bytes: int, batch_bytes: int):
    def cut(batches):
        number = TaskContext.get().partitionId() << 40
        homes: dict[bytes, int] = {}
        rows: list[tuple] = []
        size = 0

        def table():
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, _BLOCKS)], schema=_BLOCKS
            )

        for batch in batches:
            for doc_id, text, key in zip(*batch.columns):
                data = (text.as_py() or "").encode()
                first, count = number, max(1, -(-len(data) // block_bytes))
                for position in range(count):
                    block = data[position * block_bytes : (position + 1) * block_bytes]
                    home = homes.setdefault(block, number)
                    rows.append(
                        (
                            doc_id.as_py(),
                            first,
                            len(data),
                            None if position else hashlib.sha256(data).hexdigest(),
                            None if position else key.as_py(),
                            count,
                            position,
                            number,
                            home,
                            block if home == number else None,
                        )
                    )
                    size += 64 + (len(block) if home == number else 0)
                    number += 1
                if size >= batch_bytes:
                    yield table()
                    homes, rows, size = {}, [], 0
        if rows:
            yield table()

    return handing_back(cut)


def block_table(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", block_bytes: int = BLOCK, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """A row for each block of each document; its bytes where it is the first equal one of its batch."""
    schema = (
        "doc_id long, row long, n_bytes long, text_sha256 string, row_key string, n_blocks long, position long, "
        "number long, home long, block binary"
    )
    chosen = docs.select(F.col(id_col).cast("long"), F.col(text), row_key(id_col, text))
    cut = chosen.mapInArrow(_cut(block_bytes, batch_bytes), schema)
    return written(cut, "exact-blocks")


def text_names(blocks: DataFrame) -> DataFrame:
    """(row, level, name): ``(level, name)`` is equal for two documents exactly if their texts are."""
    firsts = blocks.where("block is not null").select("home", "block")
    named = firsts.select("home", F.min("home").over(Window.partitionBy("block")).alias("name"))
    current = written(
        blocks.select("row", "position", "n_blocks", "number", "home")
        .join(named, "home")
        .select("row", "position", "n_blocks", "number", "name"),
        "exact-names",
    )
    finished = []
    level = 0
    while True:
        finished.append(current.where("n_blocks = 1").select("row", F.lit(level).alias("level"), "name"))
        left, right = F.col("position") % 2 == 0, F.col("position") % 2 == 1
        open_rows = current.where("n_blocks > 1")
        if open_rows.isEmpty():
            return reduce(DataFrame.union, finished)
        pairs = written(
            open_rows.groupBy("row", F.floor(F.col("position") / 2).alias("position")).agg(
                F.first("n_blocks").alias("n_blocks"),
                F.min("number").alias("number"),
                F.max(F.when(left, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(right, F.col("name"))), F.lit(-1)).alias("b"),
            ),
            "exact-pairs",
        )
        names = pairs.groupBy("a", "b").agg(F.min("number").alias("name"))
        current = pairs.join(names, ["a", "b"]).select(
            "row", "position", F.ceil(F.col("n_blocks") / 2).alias("n_blocks"), "number", "name"
        )
        level += 1


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, text_sha256, keep_id, group_size, kept, row_key."""
    blocks = block_table(docs, id_col, text, **sizes)
    rows = blocks.where("position = 0").select("doc_id", "row", "n_bytes", "text_sha256", "row_key")
    named = rows.join(text_names(blocks), "row")
    groups = named.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keeper")
    )
    # As a table of its own, the groups leave Spark free to split the rows of a hot one in the join.
    groups = written(groups, "exact-groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        "text_sha256",
        "n_bytes",
        "row_key",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, the one with the largest id, with the columns of ``docs``."""
    return only_rows(docs, exact_groups(docs, id_col, text).where("kept"), id_col, text)


#: The same result on DuckDB.
SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256, octet_length(encode(t))::BIGINT AS n_bytes
FROM d WINDOW w AS (PARTITION BY t)
"""

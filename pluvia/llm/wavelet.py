"""Token ids as one compressed wavelet matrix per shard: access, counting and occurrence lookup without unpacking.

A wavelet matrix over ids of ``bits`` bits has one plane of single bits per level, highest bit first.  Level by level
the ids are split stably by the bit, zeros in front; a plane holds the bits in the order of its level.  With the number
of ones before every ``STEP`` bits, ``rank`` needs one directory entry and the bits behind it, and ``select`` a binary
search in the directory.

A shard is one Parquet file of one row, compressed by zstd: planes, directories, and the ids and lengths of the
documents it holds.  Shards follow each other in ascending order of the document id; each holds ``SHARD`` ids, more
only for one longer document, and no document is divided.  Memory of a task is bounded by some ten bytes per id of the
largest shard.  Files are written by Spark's committer, so that lost tasks leave nothing behind.

Defined cases: null texts count as empty and have the end id alone; rows without an id come first; rows that share an
id are ordered by a hash of their text; an empty table gives no shard and no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvia.session import shared_dir

from .tokens import encoder

#: Bits between two entries of a directory.
STEP = 512
#: Ids of a shard.
SHARD = 1 << 22


@dataclass(frozen=True)
class WaveletMatrix:
    """``planes[level]`` are packed bits, ``ones[level]`` the ones before every ``STEP`` bits, ``zeros[level]`` all zeros."""

    size: int
    planes: list[np.ndarray]
    ones: list[np.ndarray]
    zeros: list[int]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ones, zeros = [], [], []
        current = np.ascontiguousarray(ids)
        for level in reversed(range(bits)):
            set_bits = (current >> current.dtype.type(level)) & current.dtype.type(1) != 0
            plane = np.packbits(set_bits, bitorder="little")
            padded = np.zeros(-(-len(ids) // STEP) * STEP // 8, np.uint8)
            padded[: len(plane)] = plane
            per_step = np.bitwise_count(padded).reshape(-1, STEP // 8).sum(1, dtype=np.uint32)
            planes.append(plane)
            ones.append(np.concatenate((np.zeros(1, np.uint32), np.cumsum(per_step, dtype=np.uint32))))
            current = np.concatenate((current[~set_bits], current[set_bits]))
            zeros.append(len(ids) - int(ones[-1][-1]))
        return cls(len(ids), planes, ones, zeros)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.size, bitorder="little").view(bool)

    def _rank1(self, level: int, places: np.ndarray) -> np.ndarray:
        """Number of set bits before each place."""
        start = places // STEP
        found = self.ones[level][start].astype(np.int64)
        width = STEP // 8
        plane = self.planes[level]
        # Whole bytes behind the directory entry, and the bits of the last one.
        lanes = start[:, None] * width + np.arange(width)
        held = plane[np.minimum(lanes, max(0, len(plane) - 1))] if len(plane) else np.zeros(lanes.shape, np.uint8)
        left = np.clip(places[:, None] - lanes * 8, 0, 8)
        masks = ((1 << left) - 1).astype(np.uint8)
        return found + np.bitwise_count(held & masks).sum(1, dtype=np.int64)

    def access(self, places) -> np.ndarray:
        """The ids at the places."""
        places = np.asarray(places, np.int64)
        ids = np.zeros(len(places), np.int64)
        for level in range(len(self.planes)):
            bit = (self.planes[level][places // 8] >> (places % 8).astype(np.uint8)) & 1
            before = self._rank1(level, places)
            places = np.where(bit == 1, self.zeros[level] + before, places - before)
            ids = ids * 2 + bit
        return ids

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``symbol`` before ``end`` stand after the last level."""
        low, high = 0, end
        bits = len(self.planes)
        for level in range(bits):
            before = self._rank1(level, np.array([low, high]))
            if symbol >> (bits - 1 - level) & 1:
                low, high = (int(x) + self.zeros[level] for x in before)
            else:
                low, high = low - int(before[0]), high - int(before[1])
        return low, high

    def count(self, symbol: int, end: int | None = None) -> int:
        """How often ``symbol`` stands before ``end``."""
        if symbol >> len(self.planes):
            return 0
        low, high = self._range(symbol, self.size if end is None else end)
        return high - low

    def _select(self, level: int, bit: int, number: int) -> int:
        """Place of the ``number``-th (from 0) bit of that value."""
        ones = self.ones[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * STEP - ones
        start = int(np.searchsorted(before, number, "right")) - 1
        part = self.planes[level][start * STEP // 8 : (start + 1) * STEP // 8]
        inside = np.flatnonzero(np.unpackbits(part, bitorder="little") == bit)
        return start * STEP + int(inside[number - before[start]])

    def select(self, symbol: int, number: int) -> int:
        """Place of the ``number``-th occurrence (from 0) of ``symbol``."""
        low, high = self._range(symbol, self.size)
        if not 0 <= number < high - low:
            raise IndexError(number)
        place, bits = low + number, len(self.planes)
        for level in reversed(range(bits)):
            bit = symbol >> (bits - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, i) for i in range(self.count(symbol))]

    def ids(self, dtype=np.uint32) -> np.ndarray:
        """All ids, level by level from the last."""
        current = np.zeros(self.size, dtype)
        bits = len(self.planes)
        for level in reversed(range(bits)):
            set_bits, zeros = self._bits(level), self.zeros[level]
            back = np.empty(self.size, dtype)
            back[~set_bits] = current[:zeros]
            back[set_bits] = current[zeros:] | dtype(1 << (bits - 1 - level))
            current = back
        return current


_SHARD = pa.schema(
    [
        ("shard", pa.int64()),
        ("n_ids", pa.int64()),
        ("planes", pa.list_(pa.binary())),
        ("ones", pa.list_(pa.binary())),
        ("zeros", pa.list_(pa.int64())),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)
_SHARD_DDL = (
    "shard long, n_ids long, planes array<binary>, ones array<binary>, zeros array<long>, "
    "doc_ids array<long>, lengths array<long>"
)


def _shards(path: str, end_id: int, size: int, special_as_text: bool):
    def apply(batches):
        tool = encoder(path, special_as_text)
        bits = max(tool.tokenizer.get_vocab_size() - 1, end_id).bit_length()
        number = TaskContext.get().partitionId() << 32
        doc_ids: list = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        held = 0

        def shard():
            ids = np.concatenate(parts)
            matrix = WaveletMatrix.build(ids, bits)
            columns = [
                [number],
                [len(ids)],
                [[plane.tobytes() for plane in matrix.planes]],
                [[ones.tobytes() for ones in matrix.ones]],
                [matrix.zeros],
                [doc_ids],
                [lengths],
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SHARD)], schema=_SHARD
            )

        end = np.array([end_id], tool.dtype)
        for batch in batches:
            for at, ids, counts in tool.encode_groups(batch.column(1)):
                stops = np.cumsum(counts)
                some = batch.column(0).slice(at, len(counts))
                for doc_id, start, stop in zip(some.to_pylist(), (stops - counts).tolist(), stops.tolist()):
                    if held and held + stop - start + 1 > size:
                        yield shard()
                        number, doc_ids, parts, lengths, held = number + 1, [], [], [], 0
                    doc_ids.append(doc_id)
                    parts += [ids[start:stop], end]
                    lengths.append(stop - start + 1)
                    held += lengths[-1]
        if doc_ids:
            yield shard()

    return apply


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    shard_ids: int = SHARD,
    special_as_text: bool = True,
) -> str:
    """Encode the texts in ascending order of their ids and write a file for each shard; returns the folder.

    ``special_as_text``: whether a special token's string in a text is ordinary text, or its id.
    """
    path = path or shared_dir(docs.sparkSession, "wavelet")
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    ordered = ordered.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    shards = ordered.drop("hash").mapInArrow(_shards(tokenizer, end_id, shard_ids, special_as_text), _SHARD_DDL)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)
    return path


def open_shard(row) -> WaveletMatrix:
    """The matrix of one row of the files, ``row`` being a mapping of its columns."""
    return WaveletMatrix(
        row["n_ids"],
        [np.frombuffer(plane, np.uint8) for plane in row["planes"]],
        [np.frombuffer(ones, np.uint32) for ones in row["ones"]],
        list(row["zeros"]),
    )


def _documents(batches):
    schema = pa.schema([(n, pa.int64()) for n in ("shard", "number", "doc_id", "before", "n_tokens", "ids_crc32")])
    for batch in batches:
        for row in batch.to_pylist():
            ids = open_shard(row).ids()
            stops = np.cumsum(row["lengths"])
            starts = stops - row["lengths"]
            sums = [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(starts, stops)]
            columns = [[row["shard"]] * len(sums), range(len(sums)), row["doc_ids"], starts, row["lengths"], sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = spark.read.schema(_SHARD_DDL).parquet(path)
    found = shards.mapInArrow(
        _documents, "shard long, number long, doc_id long, before long, n_tokens long, ids_crc32 long"
    )
    # One thin row per shard.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("offset"))
    return found.join(offsets, "shard").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def find(spark: SparkSession, path: str, symbol: int) -> DataFrame:
    """Per shard that holds ``symbol``: how often, and the place of its first occurrence in the shard."""

    def apply(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                matrix = open_shard(row)
                if number := matrix.count(symbol):
                    rows.append((row["shard"], number, matrix.select(symbol, 0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["shard", "n", "first"]
            )

    return spark.read.schema(_SHARD_DDL).parquet(path).mapInArrow(apply, "shard long, n long, first long")

"""SimHash near-dedup: fingerprints of word shingles, linked within a Hamming radius, grouped into components.

Fingerprints are compared exactly, in tiles.  Distinct fingerprints are sorted by the bit counts of their parts
(``PARTS`` equal parts of the 64 bits) and cut into tiles; a tile is a packed array, and its box holds the least and the
largest count of each part.  Two fingerprints within the radius differ by at most the radius in the sum of their parts'
counts, so tile pairs whose boxes are farther apart are skipped.  The others meet in one task, where numpy compares them
by exclusive-or and bit counts, once more in small blocks with boxes of their own.

A task does not return all links of its pair of tiles but a spanning forest of them: as many components, and never more
edges than fingerprints.  Copies share a fingerprint and enter as one.

Defined cases: text without words (null, empty, blank) has fingerprint zero and is linked like any other; fewer words
than a shingle form one shingle; a component is named by its smallest id, null if none of its rows has an id; repeated
rows get the same answer each; empty tables give empty results; other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, only_rows, row_key, written
from .components import connected

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile and of a block inside it.
TILE = 1 << 16
BLOCK = 256
#: Parts of a fingerprint whose bits are counted apart.
PARTS = 4
#: Shingles hashed at a time; bounds the memory for a very long text.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 majority bits over the XXH64 of all word shingles, repeats included."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and the white space x20 and x09-x0D.
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(token) + 1 for token in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(line[i:j], seed) for i, j in spans], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(words: int):
    def step(batch):
        values = [fingerprint(text.as_py(), words) for text in batch.column(1)]
        signed = np.array(values, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(signed)], names=["doc_id", "row_key", "simhash"]
        )

    return in_slices(step)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row_key, simhash): the 64 bits as a signed long."""
    chosen = docs.select(F.col(id_col).cast("long"), F.col(text), row_key(id_col, text))
    return chosen.mapInArrow(_fingerprints(words), "doc_id long, row_key string, simhash long")


def part_counts(values: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """(n, parts) numbers of set bits."""
    width = np.uint64(64 // parts)
    mask = np.uint64((1 << int(width)) - 1)
    return np.stack(
        [np.bitwise_count((values >> (np.uint64(i) * width)) & mask).astype(np.int16) for i in range(parts)], axis=1
    )


def _gap(low_a, high_a, low_b, high_b):
    """Least possible sum of the parts' differences in bit counts, between all boxes a and all boxes b."""
    apart = np.maximum(low_a[:, None] - high_b[None], low_b[None] - high_a[:, None])
    return np.maximum(apart, 0).sum(2)


def _blocks(values: np.ndarray, parts: int):
    counts = part_counts(values, parts)
    at = np.arange(0, len(values), BLOCK)
    return np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int, parts: int = PARTS):
    """Index pairs (i in a, j in b) within the radius, block by block; within ``a`` alone if ``b`` is None."""
    other = a if b is None else b
    gaps = _gap(*_blocks(a, parts), *_blocks(other, parts))
    for p, q in zip(*np.nonzero(gaps <= radius)):
        if b is None and q < p:
            continue
        left, right = a[p * BLOCK : (p + 1) * BLOCK], other[q * BLOCK : (q + 1) * BLOCK]
        i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
        i, j = i + p * BLOCK, j + q * BLOCK
        if b is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def _forest(size: int, links) -> np.ndarray:
    """Label per index: the smallest index it is linked to, over all index pairs in ``links``."""
    parent = np.arange(size)
    for i, j in links:
        while len(i):
            # Hang the larger root below the smaller, then look again at the pairs that are still apart.
            i, j = parent[i], parent[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
    return parent


def _tiles(size: int, parts: int):
    schema = pa.schema(
        [("tile", pa.int64()), ("values", pa.binary()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))]
    )

    def apply(batches):
        number, kept = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64)

        def tile(values):
            counts = part_counts(values, parts)
            columns = [[number], [values.tobytes()], [counts.min(0).tolist()], [counts.max(0).tolist()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            kept = np.concatenate((kept, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            while len(kept) >= size:
                yield tile(kept[:size])
                number, kept = number + 1, kept[size:]
        if len(kept):
            yield tile(kept)

    return apply


def _compare(radius: int, parts: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def apply(table: pa.Table) -> pa.Table:
        """The one or two tiles of a pair -> a star of links per component."""
        tiles = [np.frombuffer(values.as_py(), np.uint64) for values in table.column("values")]
        a, b = tiles[0], tiles[1] if len(tiles) > 1 else None
        both = np.concatenate(tiles)
        shift = 0 if b is None else len(a)
        roots = _forest(len(both), ((i, j + shift) for i, j in tile_links(a, b, radius, parts)))
        linked = np.nonzero(roots != np.arange(len(both)))[0]
        signed = both.view(np.int64)
        return pa.table([pa.array(signed[linked]), pa.array(signed[roots[linked]])], schema=schema)

    return apply


def links(values: DataFrame, radius: int = RADIUS, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """Distinct ``simhash`` values -> (u, v) links that connect whatever is connected within the radius."""
    width = 64 // parts
    counts = [
        F.bit_count(F.shiftrightunsigned("simhash", i * width).bitwiseAND(F.lit((1 << width) - 1))) for i in range(parts)
    ]
    ordered = values.select("simhash", F.array(*counts).alias("order"))
    ordered = ordered.repartitionByRange("order", "simhash").sortWithinPartitions("order", "simhash")
    tiles = written(
        ordered.select("simhash").mapInArrow(
            _tiles(tile, parts), "tile long, values binary, low array<int>, high array<int>"
        ),
        "simhash-tiles",
    )
    # Boxes meet on the bit count of the first part, widened by the radius on one side.
    boxes = tiles.select("tile", "low", "high")
    first = boxes.select(
        *(F.col(c).alias(f"{c}_a") for c in boxes.columns),
        F.explode(F.sequence(F.col("low")[0] - radius, F.col("high")[0] + radius)).alias("count"),
    )
    second = boxes.select(
        *(F.col(c).alias(f"{c}_b") for c in boxes.columns),
        F.explode(F.sequence(F.col("low")[0], F.col("high")[0])).alias("count"),
    )
    apart = sum(
        F.greatest(
            F.lit(0), F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i]
        )
        for i in range(parts)
    )
    pairs = (
        first.join(second, "count")
        .where((F.col("tile_a") <= F.col("tile_b")) & (apart <= radius))
        .select("tile_a", "tile_b")
        .distinct()
    )
    members = pairs.select(
        "tile_a",
        "tile_b",
        F.explode(F.array_distinct(F.array("tile_a", "tile_b"))).alias("tile"),
    )
    meet = members.join(tiles.select("tile", "values"), "tile").select("tile_a", "tile_b", "values")
    return meet.groupBy("tile_a", "tile_b").applyInArrow(_compare(radius, parts), "u long, v long")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: doc_id, simhash, component_id (the smallest id that can be reached), kept, row_key."""
    marks = written(fingerprints(docs, id_col, text, words), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    values = marks.groupBy("simhash").agg(F.min(place).alias("first"))
    labels = connected(links(values.select("simhash"), radius, tile))
    named = values.join(labels, F.col("simhash") == F.col("node"), "left").select(
        "simhash", "first", F.coalesce("label", "simhash").alias("label")
    )
    least = named.groupBy("label").agg(F.min("first").alias("least"))
    classes = written(named.join(least, "label").select("simhash", "least"), "simhash-classes")
    return marks.join(classes, "simhash").select(
        "doc_id",
        "simhash",
        F.col("least.doc_id").alias("component_id"),
        (F.col("row_key") == F.col("least.row_key")).alias("kept"),
        "row_key",
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row of each group, that with the smallest id, with the columns of ``docs``."""
    return only_rows(docs, near_groups(docs, id_col, text, words, radius).where("kept"), id_col, text)

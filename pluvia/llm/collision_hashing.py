"""Approximate nearest neighbours by counting collisions of query-centred windows on single projections.

Every vector is scaled to length one, which makes nearness by cosine nearness by distance, and projected on ``LINES``
random lines.  The index is cut into shards of a bounded size; a shard holds its vectors and, for each line, their
projections in sorted order.  Nothing is put into buckets beforehand: a query opens a window around its own projection on
every line, and widening the windows is all that rehashing at a larger radius takes (virtual rehashing).  At radius r the
window reaches ``REACH`` * r to either side.  A vector collides on a line if it lies in that line's window; one at distance
r does so on half of the lines, one farther off on fewer.  Whoever collides on ``THRESHOLD`` lines or more is verified:
its cosine with the query is computed in double precision.  Windows widen until the K-th best verified vector is within r,
that is until whatever could still be nearer has most likely been verified; or until they cover the shard.

The threshold is set by the binomial distribution: a vector at distance r misses it with probability ``MISS`` at most, one
nearer than r more rarely; only the last of the K best lie near r.  Shards and blocks of queries meet in tiles, one task each, of which every query takes its K
best; then its best over all tiles are taken.  No cap on candidates: all that pass the threshold are verified.

A query meets its own row in one tile, as the candidate with its id and its components, and that goes at the end, once: of
several equal rows the others stay.  Shards are sorted where they are searched: that costs far less than the search, and
nothing but vectors is shuffled, each to every block of queries (one, until the queries exceed ``BLOCK_BYTES``).

Defined cases: vectors that are null, empty, zero or hold a null or a component that is not finite take no part, neither as
queries nor as candidates; vectors with different numbers of components are not compared; a row is no candidate for its own
query, but another row with the same id is; equal scores go by the smaller id, null last; rows that share an id are queries
each; an empty table has no rows; other columns are not looked at.  Values of any size are scaled by a power of two, which
changes no digit.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
LINES = 64
SEED = 42
#: Half a window's width at radius one: a normal variable is within it in half of the cases.
REACH = 0.6744897501960817
#: Chance that a vector at the distance of the radius is not verified.
MISS = 0.1
#: Radii grow by this factor, from the first to the diameter of the sphere.
GROWTH, FIRST, DIAMETER = 1.2, 0.05, 2.0
#: Radii passed over at a time while fewer than K vectors have been verified: about a doubling.
STRIDE = 4
#: Bytes of vectors in a shard: a share of all, within these bounds.
SHARDS, LEAST_BYTES, MOST_BYTES = 64, 2 << 20, 32 << 20
#: Bytes of queries in a block.
BLOCK_BYTES = 16 << 20
#: Queries whose window ends are held at a time.
GROUP = 128

_FOUND = "query_row long, query_id long, vec_id long, score double, same boolean"


def threshold(lines: int = LINES, miss: float = MISS) -> int:
    """The most collisions that a vector at the distance of the radius reaches but with probability ``miss``."""
    chance, below, count = erf(REACH / sqrt(2)), 0.0, 0
    while below + (now := comb(lines, count) * chance**count * (1 - chance) ** (lines - count)) <= miss:
        below, count = below + now, count + 1
    return max(1, count)


def radii() -> np.ndarray:
    steps = int(np.ceil(np.log(DIAMETER / FIRST) / np.log(GROWTH)))
    return FIRST * GROWTH ** np.arange(steps + 1)


def directions(dim: int, lines: int = LINES, seed: int = SEED) -> np.ndarray:
    """Random lines through the origin; the same for all shards."""
    return np.random.default_rng([seed, dim]).standard_normal((lines, dim))


def whole(vector: str = "embedding") -> Column:
    """Vectors that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows times powers of two, so that no square overflows or vanishes."""
    chunks = [np.asarray(chunk.flatten(), float) for chunk in column.chunks]
    matrix = np.concatenate(chunks).reshape(len(column), -1)
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1))[1][:, None])


def _dots(matrix: np.ndarray, other: np.ndarray) -> np.ndarray:
    # Row by row in the same order of additions, so that equal vectors have equal scores.
    return (matrix * other).sum(axis=1)


class Shard:
    """Vectors, with their projections on each line in order."""

    def __init__(self, ids: pa.ChunkedArray, vectors: pa.ChunkedArray, lines: int = LINES, seed: int = SEED):
        self.absent = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0))
        self.vectors = _matrix(vectors)
        self.norms = np.sqrt(_dots(self.vectors, self.vectors))
        shadows = directions(self.vectors.shape[1], lines, seed) @ (self.vectors / self.norms[:, None]).T
        self.places = np.argsort(shadows, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(shadows, self.places, axis=1)

    def windows(self, shadows: np.ndarray, reaches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where queries' windows begin and end on each line: (query, radius, line), given (line, query)."""
        ends = []
        for sign, side in ((-1, "left"), (1, "right")):
            edges = shadows[:, :, None] + sign * reaches
            ends.append(np.stack([np.searchsorted(v, e.ravel(), side).reshape(e.shape) for v, e in zip(self.values, edges)], -1))
        return ends[0], ends[1]

    def search(
        self, vector: np.ndarray, begins: np.ndarray, stops: np.ndarray, steps: np.ndarray, least: int, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best candidates of a query, whose windows begin and end so at each radius."""
        size, norm = len(self.ids), np.sqrt((vector * vector).sum())
        counts, tested = np.zeros(size, np.int64), np.zeros(size, bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        low = high = None

        def verify(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            tested[fresh] = True
            found = _dots(self.vectors[fresh], vector) / (self.norms[fresh] * norm)
            all_places, values = np.concatenate((places, fresh)), np.concatenate((scores, found))
            if len(values) > 4 * k:  # no need to sort what is worse than the k-th, equals excepted
                good = values >= np.partition(values, -k)[-k]
                all_places, values = all_places[good], values[good]
            best = np.lexsort((self.ids[all_places], self.absent[all_places], -values))[:k]
            return all_places[best], values[best]

        at = 0
        while at < len(steps):
            begin, stop = begins[at], stops[at]
            if low is None:
                low = high = begin
            # What a wider window adds on either side.
            spans = [line[i:j] for line, i, j in zip(self.places, begin.tolist(), low.tolist()) if i < j]
            spans += [line[i:j] for line, i, j in zip(self.places, high.tolist(), stop.tolist()) if i < j]
            low, high = begin, stop
            if spans:
                counts += np.bincount(np.concatenate(spans), minlength=size)
                fresh = np.flatnonzero((counts >= least) & ~tested)
                if len(fresh):
                    places, scores = verify(fresh)
            # The squared distance of unit vectors follows from their cosine.
            if len(scores) == k and 2 - 2 * scores[-1] <= steps[at] ** 2:
                break
            at += 1 if len(scores) == k or at + STRIDE >= len(steps) else STRIDE
        if len(scores) < k:  # few vectors, some of them on the other side of the sphere
            places, scores = verify(np.flatnonzero(~tested))
        return places, scores


def _tile(k: int, lines: int, seed: int, miss: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    least, steps = threshold(lines, miss), radii()

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        rows: list[pa.Table] = []
        if held.num_rows and asked.num_rows:
            shard, queries = Shard(held["id"], held["vector"], lines, seed), _matrix(asked["vector"])
            lengths = np.sqrt(_dots(queries, queries))
            shadows = directions(queries.shape[1], lines, seed) @ (queries / lengths[:, None]).T
            query_ids, query_rows = asked["id"].to_numpy(), asked["row"].to_numpy()
            for at in range(0, len(queries), GROUP):
                ends = shard.windows(shadows[:, at : at + GROUP], REACH * steps)
                for i, (begins, stops) in enumerate(zip(*ends), at):
                    # One more than asked for, since the query itself may be among them.
                    places, scores = shard.search(queries[i], begins, stops, steps, least, k + 1)
                    ids, absent = shard.ids[places], shard.absent[places]
                    same = (ids == query_ids[i]) & ~absent & (shard.vectors[places] == queries[i]).all(axis=1)
                    columns = [
                        np.full(len(places), query_rows[i]), np.full(len(places), query_ids[i]),
                        pa.array(ids, pa.int64(), mask=absent), scores, same,
                    ]
                    rows.append(pa.table(columns, names=_NAMES))
        return pa.concat_tables(rows) if rows else _NONE

    return search


_NAMES = ["query_row", "query_id", "vec_id", "score", "same"]
_NONE = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())], names=_NAMES)


def search(
    vectors: DataFrame,
    chosen: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    lines: int = LINES,
    seed: int = SEED,
    miss: float = MISS,
    shard_bytes: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of all other vectors to each ``chosen`` one that has an id."""
    taken = vectors.where(whole(vector)).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.size(vector).alias("dim"), F.col(vector).alias("vector"), (chosen & F.col(id_col).isNotNull()).alias("chosen"),
    )
    width = 8 if dict(taken.dtypes)["vector"] == "array<double>" else 4
    asked = F.when(F.col("chosen"), F.col("dim"))
    sums = taken.agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)) for c in (F.col("dim"), asked))).first()
    all_bytes, asked_bytes = (width * total for total in sums)
    size = shard_bytes or min(MOST_BYTES, max(LEAST_BYTES, all_bytes // SHARDS))
    shards, parts = max(1, -(-all_bytes // size)), max(1, -(-asked_bytes // block_bytes))

    def dealt(groups: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(groups))

    def every(groups: int) -> Column:
        return F.explode(F.expr(f"sequence(0L, {groups - 1}L)"))

    # A shard goes to every block of queries and a block to every shard.
    key = ["dim", "shard", "part"]
    held = taken.select("id", "dim", "vector", dealt(shards).alias("shard"), every(parts).alias("part"))
    queries = taken.where("chosen").select(
        "row", "id", "dim", "vector", dealt(parts).alias("part"), every(shards).alias("shard")
    )
    tiles = held.groupBy(*key).cogroup(queries.groupBy(*key))
    found = tiles.applyInArrow(_tile(k, lines, seed, miss), _FOUND)
    order = [F.desc("score"), F.col("vec_id").asc_nulls_last()]
    best = Window.partitionBy("query_row").orderBy(*order)
    near = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    own = F.min(F.when(F.col("same"), F.col("place"))).over(Window.partitionBy("query_row"))
    others = near.withColumn("own", F.coalesce(own, F.lit(k + 1))).where(F.col("place") != F.col("own"))
    rank = F.col("place") - (F.col("place") > F.col("own")).cast("int")
    return others.select("query_id", rank.alias("rank"), "vec_id", "score")

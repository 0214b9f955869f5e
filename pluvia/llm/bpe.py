"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition.

Every match of the split pattern is a word.  A word that is a token gets its rank.  Any other starts as rows (word,
position, byte token, position of the neighbour after it); in each step of a recursive query the rows join their
neighbours and the table of merges, and each word contracts its pair of least rank, the leftmost of equal ones, until no pair can be merged.  Decoding joins
the ids of many documents with the vocabulary, in order of position; a document's bytes are a stretch of those found.

DuckDB runs inside the task, with one thread and bounded memory.  Texts are cut on their bytes and a worker keeps the ids of
the pieces and words it has met, up to a bound of bytes (``tokens``), so that a query gets few words but new ones.
Recursion writes a row per position and step, half the square of a word's length: a word of more than ``LONG_WORD``
bytes is contracted by the same rule with a heap instead.

Defined cases: null and empty texts have no ids and decode to nothing; special tokens in a text are ordinary text;
repeated rows are encoded each; an id outside the vocabulary is an error in decoding; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import base64
import heapq
import tempfile
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import copied, handing_back
from .tokens import KnownPieces, PieceEncoder, whole_words

#: Bytes of a word beyond which recursion would write too many rows.
LONG_WORD = 256
#: The usual pattern, by which words of letters and the pieces of ``tokens.cuts`` are known; other texts are cut at spaces only.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: New words in a query, and ids decoded in one.
QUERY_WORDS, DECODED_IDS = 20_000, 1 << 19
MEMORY = "128MB"

CONTRACT = """
WITH RECURSIVE step(word, pos, token, after, busy) AS (
  SELECT word, pos, token, after, true FROM start_rows
  UNION ALL
  (WITH pairs AS (
     SELECT l.word, r.after, (m.merged::BIGINT << 40) | (l.pos::BIGINT << 20) | l.after AS key
     FROM step l JOIN step r ON r.word = l.word AND r.pos = l.after JOIN merges m ON m.lhs = l.token AND m.rhs = r.token
     WHERE l.busy AND r.busy),
   best AS (SELECT word, min(key) AS key, arg_min(after, key) AS after FROM pairs GROUP BY word)
   SELECT s.word, s.pos, CASE WHEN s.pos = (b.key >> 20) & 1048575 THEN (b.key >> 40)::INTEGER ELSE s.token END,
     CASE WHEN s.pos = (b.key >> 20) & 1048575 THEN b.after ELSE s.after END, b.key IS NOT NULL
   FROM step s LEFT JOIN best b ON b.word = s.word WHERE s.busy AND (b.key IS NULL OR s.pos <> b.key & 1048575)))
SELECT word, token FROM step WHERE NOT busy ORDER BY word, pos
"""

DECODE = "SELECT v.bytes FROM id_rows i JOIN vocabulary v ON v.id = i.id ORDER BY i.pos"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class RecursiveBpe(PieceEncoder):
    """Ids by a rank file and a split pattern."""

    # The vocabulary's tables stand beside what a group takes, and stages of other memory before this one.
    at_once = 1
    #: So many times less than ``remembered`` is kept of pieces, and of words as many times less again.
    share = 4

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern, self.spaces_only = regex.compile(pattern), pattern != USUAL
        super().__init__(np.dtype("<u2" if max(self.ranks.values()) < 1 << 16 else "<u4"), self.share)
        # The words of pieces; a piece of several ones is split by the pattern.
        self.words = KnownPieces(self.known.most // self.share, self.dtype)
        self.known_ids = np.zeros(max(self.ranks.values()) + 2, bool)
        self.known_ids[list(self.ranks.values())] = True
        self.bytes_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.gettempdir()}
        )
        # Every way to put a token together from two tokens.
        merges = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        ]
        lhs, rhs, merged = zip(*merges) if merges else ((), (), ())
        self._table("merges", lhs=lhs, rhs=rhs, merged=merged)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._table("vocabulary", id=self.ranks.values(), bytes=self.ranks)

    def _table(self, name: str, **columns) -> None:
        kinds = {"bytes": pa.binary()}
        rows = pa.table({key: pa.array(list(values), kinds.get(key, pa.int32())) for key, values in columns.items()})
        self.db.register(f"{name}_rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
        self.db.unregister(f"{name}_rows")

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Token ids of words, none empty, by recursion in DuckDB; as bytes of numbers."""
        lengths = np.array([len(word) for word in words])
        number = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(number)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        after = np.where(place + 1 < lengths[number], place + 1, -1)
        rows = pa.table(
            {
                "word": pa.array(number, pa.int32()),
                "pos": pa.array(place, pa.int32()),
                "token": pa.array(self.bytes_ids[np.frombuffer(b"".join(words), np.uint8)], pa.int32()),
                "after": pa.array(after, pa.int32()),
            }
        )
        found = self._query("start_rows", rows, CONTRACT)
        number, tokens = found.column("word").to_numpy(), found.column("token").to_numpy()
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1, [len(number)])) * self.dtype.itemsize
        data, bounds = tokens.astype(self.dtype).tobytes(), bounds.tolist()
        return [data[i:j] for i, j in zip(bounds, bounds[1:])]

    def contract_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with a heap of the pairs that can be merged."""
        tokens = self.bytes_ids[np.frombuffer(word, np.uint8)].tolist()
        behind = list(range(1, len(tokens))) + [-1]
        before = list(range(-1, len(tokens) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at):
            if at >= 0 and behind[at] >= 0:
                pair = tokens[at], tokens[behind[at]]
                merged = self.ranks.get(self.tokens[pair[0]] + self.tokens[pair[1]])
                if merged is not None:
                    heapq.heappush(heap, (merged, at, *pair))

        for at in range(len(tokens) - 1):
            offer(at)
        while heap:
            merged, at, left, right = heapq.heappop(heap)
            then = behind[at]
            if tokens[at] != left or then < 0 or tokens[then] != right:
                continue  # an outdated pair
            tokens[at], tokens[then], behind[at] = merged, -1, behind[then]
            if behind[at] >= 0:
                before[behind[at]] = at
            offer(before[at])
            offer(at)
        return np.array([token for token in tokens if token >= 0], np.int32)

    def _new_words(self, words: pa.Array) -> pa.Array:
        """The ids of words that nobody remembers."""
        texts = words.to_pylist()
        ids: list = list(map(self.ranks.get, texts))
        plain: list[int] = []
        for at, (text, rank) in enumerate(zip(texts, ids)):
            if rank is not None:
                ids[at] = rank.to_bytes(self.dtype.itemsize, "little")
            elif len(text) > LONG_WORD:
                ids[at] = self.contract_long(text).astype(self.dtype).tobytes()
            else:
                plain.append(at)
        for at in range(0, len(plain), QUERY_WORDS):
            some = plain[at : at + QUERY_WORDS]
            for place, found in zip(some, self.contract([texts[i] for i in some])):
                ids[place] = found
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // self.dtype.itemsize
        return _lists(np.frombuffer(b"".join(ids), self.dtype), np.concatenate(([0], ends)))

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of each piece, word by word."""
        whole = np.zeros(len(pieces), bool) if self.spaces_only else whole_words(pieces)[2]
        words = [
            [text] if one else [word.encode() for word in self.pattern.findall(text.decode())]
            for text, one in zip(pieces.to_pylist(), whole.tolist())
        ]
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))
        ids, begins = self.words.spell(pa.array(chain.from_iterable(words), pa.binary()), self._new_words)
        return _lists(ids, begins[bounds])

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of documents, given all their ids and the number of ids of each."""
        if not self.known_ids[np.minimum(ids, len(self.known_ids) - 1)].all():
            raise ValueError("an id outside the vocabulary")
        parts, sizes = [], [np.zeros(1, np.int64)]
        for at in range(0, len(ids), DECODED_IDS):
            part = ids[at : at + DECODED_IDS]
            rows = pa.table(
                {"pos": pa.array(np.arange(len(part)), pa.int32()), "id": pa.array(part.astype(np.int32))}
            )
            found = self._query("id_rows", rows, DECODE).column("bytes").combine_chunks().cast(pa.large_binary())
            parts.append(_content(found))
            sizes.append(pc.binary_length(found).to_numpy())
        bounds = np.cumsum(np.concatenate(sizes))[np.concatenate(([0], np.cumsum(counts)))]
        return _binaries(np.concatenate([np.zeros(0, np.uint8), *parts]), bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The same as a list."""
        return self.decoded(ids, counts).to_pylist()


_encoders: dict[tuple[str, str], RecursiveBpe] = {}


def encoder(path: str, pattern: str) -> RecursiveBpe:
    """The worker's encoder for a rank file; it lives as long as the worker."""
    key = path, pattern
    if key not in _encoders:
        _encoders[key] = RecursiveBpe(path, pattern)
    return _encoders[key]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _content(values: pa.Array) -> np.ndarray:
    """All bytes of large binary values, none of them null."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def _binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that lie between ``bounds`` in the bytes of ``data``."""
    buffers = [None, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).cast(pa.binary())


def _round_trip(ranks: str, pattern: str):
    def apply(batches):
        tool = encoder(ranks, pattern)
        for batch in batches:
            for at, ids, counts in tool.encode_groups(batch.column(1)):
                columns = [
                    copied(batch.column(0).slice(at, len(counts))),
                    pa.array(counts, pa.int64()),
                    _binaries(ids.astype("<u4").view(np.uint8), np.concatenate(([0], np.cumsum(counts))) * 4),
                    tool.decoded(ids, counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    return handing_back(apply)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit numbers, and the bytes they decode to."""

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text))
    return chosen.mapInArrow(_round_trip(ranks, pattern), "doc_id long, n_tokens long, ids binary, decoded binary")

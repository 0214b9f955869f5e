"""Encoders, token files, wavelet matrices, BPE and the pipeline against the public libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import product

import duckdb
import llm_cases as cases
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer
from llm_cases import empty, tables  # noqa: F401

import corpus_pipeline
from pluvia.llm import bpe, mixing, simhash, token_scan, tokens, toxicity, wavelet
from pluvia.llm.common import SLICE_ROWS, in_slices, read
from pluvia.llm.queries import QUERIES, toxicity_model

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
AWKWARD = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　​'sab1 . é🙂 日本 <|endoftext|>"


@pytest.fixture(scope="module")
def library():
    tool = Tokenizer.from_file(VOCABULARY)
    tool.encode_special_tokens = True
    return lambda texts: [e.ids for e in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def rank_library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )


def texts():
    source = random.Random(1)
    some = ["".join(source.choice(AWKWARD) for _ in range(source.randint(0, 40))) for _ in range(3000)]
    own = [t for _, t, _ in cases.ROWS]
    return some + own + [" ", " a", "a ", "\n ", " \n", "a  b", "don't  it's", "a" * 1000, " " * 300, "!?" * 400, "ab" * 999]


def split(ids, counts):
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("group, remembered", [(tokens.GROUP, tokens.PieceEncoder.remembered), (50, 10)])
def test_encoder(library, monkeypatch, group, remembered):
    monkeypatch.setattr(tokens, "GROUP", group)
    monkeypatch.setattr(tokens.PieceEncoder, "remembered", remembered)
    held = texts()[-400:] if group == 50 else texts()
    assert split(*tokens.Encoder(VOCABULARY).encode(pa.array(held, pa.string()))) == library(held)


def word_texts():
    """Words with marks, line breaks and letters of two bytes on either side of every cut."""
    source = random.Random(6)
    parts = [" ", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'", "'s", "?!", "$", "a", "The", "né", "É", "×", "÷", "e\u0301", "\u00a0", "\u3000", "…", "日", "я", "7", "🙂"]
    return ["".join(source.choice(parts) for _ in range(source.randint(0, 14))) for _ in range(20_000)]


@pytest.mark.parametrize("remembered", [tokens.PieceEncoder.remembered, 5000])
def test_words_between_marks(library, monkeypatch, remembered):
    monkeypatch.setattr(tokens.PieceEncoder, "remembered", remembered)
    tool, held = tokens.Encoder(VOCABULARY), word_texts()
    expected = library(held)
    for start in range(0, len(held), 4000):
        some = pa.array(held[start : start + 4000])
        assert split(*tool.encode(some)) == expected[start : start + 4000]


def test_a_word_is_learnt_once_whatever_stands_behind_it():
    tool = tokens.Encoder(VOCABULARY)
    words = [" " + "".join(word) for word in product("abcdé", repeat=4)]
    seen, learn = [], tool._learn

    def spied(pieces):
        seen.extend(pieces.to_pylist())
        return learn(pieces)

    tool._learn = spied
    tool.encode(pa.array(["x" + mark.join(words) for mark in ("", ",", ".\nSo", "!")] * 2))
    assert len(seen) == len(set(seen)) <= len(words) + 10


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens.PieceEncoder, "remembered", 50_000)
    tool = tokens.Encoder(VOCABULARY)
    for start in range(0, 3000, 300):
        tool.encode(pa.array([" often " + " ".join(f"w{i}" for i in range(start, start + 300))]))
        assert len(tool.known.pieces) == len(tool.known.ids) == len(tool.known.seen) <= 500
    assert b" often" in tool.known.pieces.to_pylist()


def test_bpe(rank_library, monkeypatch):
    held = texts()
    tool = bpe.RecursiveBpe(RANKS, public_tokenizers.PATTERN)
    ids, counts = tool.encode(pa.array(held, pa.string()))
    assert split(ids, counts) == [rank_library.encode_ordinary(t or "") for t in held]
    assert tool.decode(ids, counts) == [(t or "").encode() for t in held]
    monkeypatch.setattr(bpe, "DECODED_IDS", 50)
    assert tool.decode(ids, counts) == [(t or "").encode() for t in held]
    with pytest.raises(ValueError):
        tool.decode(np.array([60_000], np.uint32), np.array([1]))


def test_bpe_splits_no_word_again_for_what_stands_behind_it(rank_library):
    tool = bpe.RecursiveBpe(RANKS, public_tokenizers.PATTERN)
    words = [" " + "".join(word) for word in product("abcdé", repeat=4)]
    held = ["x" + mark.join(words) for mark in ("", ",", ".\nSo", "!")] * 2
    split_pieces, contracted, findall, contract = [], [], tool.pattern.findall, tool.contract

    class Spied:
        @staticmethod
        def findall(piece):
            split_pieces.append(piece)
            return findall(piece)

    def spied(words):
        contracted.extend(words)
        return contract(words)

    tool.pattern, tool.contract = Spied, spied
    ids, counts = tool.encode(pa.array(held))
    assert split(ids, counts) == [rank_library.encode_ordinary(text) for text in held]
    assert len(split_pieces) <= 10
    assert len(contracted) == len(set(contracted)) <= len(words) + 10


@pytest.mark.parametrize("remembered", [tokens.PieceEncoder.remembered, 5000])
def test_bpe_of_words_between_marks(rank_library, monkeypatch, remembered):
    monkeypatch.setattr(tokens.PieceEncoder, "remembered", remembered)
    tool, held = bpe.RecursiveBpe(RANKS, public_tokenizers.PATTERN), word_texts()
    assert not tool.spaces_only
    for start in range(0, len(held), 4000):
        ids, counts = tool.encode(pa.array(held[start : start + 4000]))
        assert split(ids, counts) == rank_library.encode_ordinary_batch(held[start : start + 4000])
        assert tool.decode(ids, counts) == [text.encode() for text in held[start : start + 4000]]


def test_bpe_by_another_pattern():
    pattern = r"[^\r\n\p{L}\p{N}]?\p{Lu}?\p{Ll}+|\p{L}|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    whole = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    held = word_texts()[:5000] + ["end.\nNext oneWord twoWORDS 12345", "a,b.c", " thisIs"]
    ids, counts = bpe.RecursiveBpe(RANKS, pattern).encode(pa.array(held))
    assert split(ids, counts) == whole.encode_ordinary_batch(held)


def test_bpe_of_batches_of_several_groups(spark, rank_library):
    size = tokens.GROUP * bpe.RecursiveBpe.at_once // 12
    held = [(i, f"word{i}, " * (size // 8) if i % 7 else None if i else "") for i in range(30)]
    docs = spark.createDataFrame(held, "doc_id long, text string").coalesce(1)
    found = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).selectExpr("doc_id", "n_tokens", "sha1(ids)", "sha1(decoded)")
    expected = []
    for doc_id, text in held:
        ids = np.array(rank_library.encode_ordinary(text or ""), "<u4")
        expected.append((doc_id, len(ids), hashlib.sha1(ids.tobytes()).hexdigest(), hashlib.sha1((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found.collect())) == expected


def random_words(rows, words):
    source = random.Random(3)
    return [" ".join("".join(source.choice("abcdefghij") for _ in range(9)) for _ in range(words)) for _ in range(rows)]


def as_read(**columns):
    """A batch as a worker reads it: its columns are parts of one buffer."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    yield from pa.ipc.open_stream(bytes(sink.getvalue()))


def test_words_of_bpe_take_a_part_of_the_bytes_remembered(monkeypatch):
    monkeypatch.setattr(tokens.PieceEncoder, "remembered", 400_000)
    tool = bpe.RecursiveBpe(RANKS, public_tokenizers.PATTERN)
    for text in random_words(4, 800):  # new words of some 120 bytes an entry
        tool.encode(pa.array([text]))
    assert 0 < len(tool.known.pieces) <= 1000 and 0 < len(tool.words.pieces) <= 250


@pytest.mark.parametrize(
    "step, more",
    [(simhash._fingerprints(3), {"key": "x"}), (in_slices(lambda b: b.filter(pa.array([True] * len(b)))), {}),
     (bpe._round_trip(RANKS, public_tokenizers.PATTERN), {})],
)
def test_a_last_output_does_not_hold_the_texts(step, more):
    rows = 3 * SLICE_ROWS + 1
    held = [" words" * 500] * (rows - 1) + ["last"]
    bpe.encoder(RANKS, public_tokenizers.PATTERN)
    before, last, count = pa.total_allocated_bytes(), None, 0
    batches = as_read(doc_id=list(range(rows)), text=held, **{k: [v] * rows for k, v in more.items()})
    for last in step(batches):
        count += len(last)
    assert count == rows and last.column(0)[-1].as_py() == rows - 1
    del batches
    # A few rows, or the end of the texts' last group; not the batch as read, whose text alone is 4.6 MB.
    assert pa.total_allocated_bytes() - before < 2 << 20


def test_rows_of_words_are_made_a_few_at_a_time():
    rows = 3 * SLICE_ROWS + 1
    held = random_words(rows, 20)
    made = list(in_slices(toxicity._word_rows)(as_read(doc_id=list(range(rows)), positive=[True] * rows, text=held)))
    assert max(map(len, made)) <= SLICE_ROWS
    assert [row["words"] for out in made for row in out.to_pylist()] == [sorted(set(text.split())) for text in held]


def test_long_words_follow_the_same_rule():
    tool = bpe.RecursiveBpe(RANKS, public_tokenizers.PATTERN)
    source = random.Random(2)
    words = ["".join(source.choice("thenationsé") for _ in range(n)).encode() for n in range(2, 60)]
    short = tool.contract(words)
    assert short == [tool.contract_long(w).astype(tool.dtype).tobytes() for w in words]


def test_op10(spark, tables, rank_library):
    found = QUERIES["op10_byte_bpe"](spark, tables[0])
    ids = [(i, rank_library.encode_ordinary(t or ""), t) for i, t, _ in cases.ROWS]
    expected = [
        (
            doc_id,
            len(numbers),
            hashlib.sha256(np.array(numbers, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )
        for doc_id, numbers, text in ids
    ]
    assert cases.as_tuples(found) == sorted(expected, key=repr)


def test_op1(spark, tables, library):
    found = QUERIES["op1_token_counts"](spark, tables[0]).collect()
    counts = [len(ids) for ids in library([t for _, t, _ in cases.ROWS])]
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found if r["doc_id"] is not None) == sorted(
        (i, n) for (i, _, _), n in zip(cases.ROWS, counts) if i is not None
    )
    assert len(found) == len(cases.ROWS) and all(r["ended"] for r in found)


@pytest.mark.parametrize("block, group", [(8, 2), (16, 1), (1 << 20, 1024)])
def test_scan_of_files(spark, tmp_path, block, group):
    contents = {"a": [5, 0, 0, 7, 7, 7, 7, 7, 7, 7, 7, 7, 0, 3], "b": [0], "c": [1, 2], "d": [9] * 17 + [0]}
    for name, ids in contents.items():
        (tmp_path / f"{name}.tok").write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "empty.tok").write_bytes(b"")
    found = token_scan.scan_token_files(spark, f"file://{tmp_path}", 0, 2, block_bytes=block, group=group)
    expected = []
    for name, ids in contents.items():
        start, number = 0, 0
        for at, value in enumerate(ids):
            if value == 0:
                expected.append((f"{name}.tok", number, start, at - start, True))
                start, number = at + 1, number + 1
        if start < len(ids):
            expected.append((f"{name}.tok", number, start, len(ids) - start, False))
    assert cases.as_tuples(found.select("file", "number", "start", "n_tokens", "ended")) == sorted(expected, key=repr)


def test_a_torn_file_is_an_error(spark, tmp_path):
    (tmp_path / "a.tok").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of ids"):
        token_scan.scan_token_files(spark, f"file://{tmp_path}", 0, 2).collect()


def test_wavelet_matrix():
    source = np.random.default_rng(0)
    for size in (0, 1, 8, 511, 512, 513, 3000):
        ids = source.integers(0, 50257, size).astype("<u2")
        ids[source.random(size) < 0.3] = 2
        matrix = wavelet.WaveletMatrix.build(ids, 16)
        assert (matrix.ids() == ids).all()
        places = source.integers(0, size, min(size, 50)) if size else np.zeros(0, int)
        assert (matrix.access(places) == ids[places]).all()
        for symbol in (2, 50256, 1 << 20):
            assert matrix.count(symbol) == (ids == symbol).sum()
            assert matrix.count(symbol, size // 2) == (ids[: size // 2] == symbol).sum()
            assert matrix.occurrences(symbol) == np.flatnonzero(ids == symbol).tolist()
        with pytest.raises(IndexError):
            matrix.select(2, size)


@pytest.mark.parametrize("shard", [wavelet.SHARD, 100])
def test_wavelet_files(spark, library, shard):
    docs = cases.documents(spark)
    path = wavelet.write_shards(docs, VOCABULARY, 2, shard_ids=shard)
    found = wavelet.read_documents(spark, path).collect()
    key = {i: ids + [2] for (i, _, _), ids in zip(cases.ROWS, library([t for _, t, _ in cases.ROWS]))}
    assert len(found) == len(cases.ROWS)
    start = 0
    for row in sorted(found, key=lambda r: r["start"]):
        assert row["start"] == start
        start += row["n_tokens"]
    ids_in_order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids_in_order == sorted(ids_in_order, key=lambda i: (i is not None, i or 0))
    once = [r for r in found if r["doc_id"] not in (None, 7)]
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in once} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in key.items() if i not in (None, 7)
    }
    total = sum(ids.count(2) for ids in library([t for _, t, _ in cases.ROWS])) + len(cases.ROWS)
    assert sum(r["n"] for r in wavelet.find(spark, path, 2).collect()) == total


def special_texts():
    source = random.Random(3)
    parts = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "\t", "a", " b", "é", "don't", "123"]
    some = ["".join(source.choice(parts) for _ in range(source.randint(1, 14))) for _ in range(2000)]
    return some + [t for _, t, _ in cases.ROWS] + ["a <|endoftext|> b", "x  <|endoftext|>  y z ", "<|endoftext|>", "w " * 99]


def test_special_tokens_as_the_library_has_them():
    as_it_comes, held = Tokenizer.from_file(VOCABULARY), special_texts()
    expected = [e.ids for e in as_it_comes.encode_batch([t or "" for t in held], add_special_tokens=False)]
    assert [64, 220, 50256, 275] in expected
    tool = tokens.encoder(VOCABULARY, special_as_text=False)
    assert split(*tool.encode(pa.array(held, pa.string()))) == expected
    assert tokens.encoder(VOCABULARY) is not tool and tokens.encoder(VOCABULARY, special_as_text=False) is tool


def test_op9(spark, tmp_path):
    as_it_comes = Tokenizer.from_file(VOCABULARY)
    held = special_texts()[:300] + ["a <|endoftext|> b"]
    cases.documents(spark, [(i, t, "s") for i, t in enumerate(held)]).write.parquet(str(tmp_path / "documents.parquet"))
    expected, start = [], 0
    for i, text in enumerate(held):
        ids = [*as_it_comes.encode(text, add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op9_wavelet_files"](spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected


def test_empty_tables(spark, empty):
    assert bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert wavelet.read_documents(spark, wavelet.write_shards(empty, VOCABULARY, 2)).count() == 0
    folder, placed = token_scan.write_token_files(empty, VOCABULARY, 50256)
    assert placed.count() == 0
    assert token_scan.scan_token_files(spark, folder, 50256, 2).count() == 0


def test_pipeline(spark, tables, rank_library):
    """Every stage but the classifier's training by plain Python or SQL."""
    for folder in ("/root/testdata/sf0.001", tables[0]):
        docs = read(spark, folder, "documents")
        score = toxicity_model(spark, folder, docs).score
        rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if score(r["text"]) < 0.7]
        equal = defaultdict(list)
        for row in rows:
            equal[row[1] or ""].append(row)
        rows = [max(group, key=lambda r: (r[0] is not None, r[0] or 0)) for group in equal.values()]
        label = cases.components([cases.simhash(t) for _, t, _ in rows], 3)
        near = defaultdict(list)
        for row, at in zip(rows, label):
            near[at].append(row)
        rows = [min(group, key=lambda r: (r[0] is None, r[0] or 0)) for group in near.values()]
        connection = duckdb.connect()
        connection.register("documents", pa.table({n: [r[i] for r in rows] for i, n in enumerate(("doc_id", "text", "source"))}))
        connection.register("labels", read(spark, folder, "labels").toArrow())
        copies = dict(connection.sql(f"SELECT row_key, copies FROM ({mixing.SQL})").fetchall())
        expected = []
        for doc_id, text, _ in rows:
            key = hashlib.md5(f"{'' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}".encode())
            ids = rank_library.encode_ordinary(text or "")
            row = (doc_id, len(ids), bytearray(np.array(ids, "<u4").tobytes()), hashlib.sha256((text or "").encode()).hexdigest())
            expected += [row] * copies[key.hexdigest()]
        assert cases.as_tuples(corpus_pipeline.run(spark, folder)) == sorted(expected, key=repr)


def test_stages_keep_the_columns(spark, tables, empty):
    docs = cases.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables[0]).columns == docs.columns
        assert stage(spark, empty, tables[0]).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, tables[0]).count() == 0

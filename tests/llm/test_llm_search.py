"""Nearest neighbours, spelling variants and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import llm_cases as cases
import numpy as np
import pytest
from llm_cases import empty, tables  # noqa: F401
from pyspark.sql import functions as F

from pluvia.llm import collision_hashing, merkle, spelling
from pluvia.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- nearest neighbours ------------------------------------------------------------------------


def nearest(rows, asked, k=5):
    """(query_id, rank, vec_id) by comparing all rows."""
    valid = [
        (i, np.array(v, float)) for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for at, (query, v) in enumerate(valid):
        if query is None or not asked(query):
            continue
        scored = []
        for other, (i, w) in enumerate(valid):
            if other != at and len(w) == len(v):
                a, b = v / np.abs(v).max(), w / np.abs(w).max()
                scored.append((-round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12), i is None, i or 0, i))
        out += [(query, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(frame, chosen, **options):
    found = collision_hashing.search(frame, chosen, **options).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in found), key=repr)


def test_neighbours_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0, 2.0]), (1, [1.0, 2.0, 2.5]), (2, [2.0, 4.0, 4.0]), (3, [2.0, 4.0, 4.0]), (None, [2.0, 4.0, 4.0]),
        (50, [-1.0, -2.0, -2.0]), (4, None), (100, []), (150, [0.0, 0.0, 0.0]), (200, [1.0, None, 2.0]),
        (250, [float("nan"), 1.0, 1.0]), (300, [float("inf"), 1.0, 1.0]), (350, [1.0, 2.0]), (5, [2.0, 1.0]),
        (400, [1e300, 2e300, 1e300]), (450, [1e-300, 3e-300, 1e-300]), (500, [3.0, 1.0, 1.0]), (500, [3.0, 1.0, 1.0]),
        (500, [1.0, 0.0, 0.0]), (550, [7.0]),
    ]
    frame = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], "vec_id long, embedding array<double>, row int, part int, same int")
    expected = nearest(rows, lambda i: i % 50 == 0)
    chosen = F.col("vec_id") % 50 == 0
    assert searched(frame.repartition(3), chosen) == expected
    assert searched(frame, chosen, shard_bytes=48, block_bytes=48) == expected
    assert searched(frame.limit(0), chosen) == []
    assert searched(frame, F.lit(False)) == []


def test_neighbours_recall(spark):
    source = np.random.default_rng(1)
    near = source.standard_normal((40, 24))
    vectors = np.concatenate([source.standard_normal((1500, 24)), near, near + 0.05 * source.standard_normal((40, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = nearest(rows, lambda i: i % 20 == 0)
    for options in ({}, {"shard_bytes": 40_000, "block_bytes": 2000}):
        found = searched(frame, F.col("vec_id") % 20 == 0, **options)
        assert len(found) == len(expected)
        pairs = {row[::2] for row in found}
        assert sum(row[::2] in pairs for row in expected) >= 0.95 * len(expected)
        scores = {(q, i): s for q, _, i, s in expected}
        assert all(abs(scores[q, i] - s) < 1e-9 for q, _, i, s in found if (q, i) in scores)


def test_a_third_of_the_vectors_are_one(spark):
    source = random.Random(2)
    rows = [(i, [1.0, 1.0, 0.5]) if i % 3 == 0 else (i, [source.gauss(0, 1) for _ in range(3)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = searched(frame, F.col("vec_id") == 300, shard_bytes=600)
    assert [(rank, i, score) for _, rank, i, score in found] == [(n + 1, 3 * n, 1.0) for n in range(5)]


def test_threshold():
    # Half of the lines in the mean; fewer than the threshold as rarely as asked, and no rarer than need be.
    draws = np.random.default_rng(3).binomial(collision_hashing.LINES, 0.5, 200_000)
    for miss in (collision_hashing.MISS, 0.02):
        least = collision_hashing.threshold(miss=miss)
        assert (draws < least).mean() <= miss * 1.05 and (draws < least + 1).mean() > miss * 0.95


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_registered_neighbours(spark):
    found = QUERIES["op11_collision_neighbours"](spark, SF_DIR)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = nearest(rows, lambda i: i % 50 == 0)
    pairs = {(r.query_id, r.vec_id) for r in found.collect()}
    assert len(pairs) == len(expected)
    assert sum((q, i) in pairs for q, _, i, _ in expected) >= 0.9 * len(expected)


# --- spelling variants -------------------------------------------------------------------------


def spelled(rows, least=6, often=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {word: count for word, count in counts.items() if len(word) >= least and count >= often}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {word: [other for other in n if one_edit(word, other)] for word in n}
    form = {}
    for word, others in near.items():
        if others and n[best := min(others, key=lambda o: (-n[o], o))] >= 5 * n[word]:
            form[word] = best
    out = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n[word], len(near[word]), n[form[word]] if word in form else None))
    return sorted(out, key=repr)


def variants(docs, **options):
    return cases.as_tuples(spelling.variants(docs, **options).select("word", "form", "root", "n", "n_near", "form_n"))


@pytest.mark.parametrize("crowd", [spelling.CROWD, 1])
def test_variants(spark, crowd):
    source = random.Random(4)
    stems = ["ababab", "bababa", "çédille", "zzzzzzzz", "thirteen", "x" * 700]
    texts = []
    for i in range(120):
        chosen = []
        for _ in range(40):
            word = list(source.choice(stems))
            for _ in range(source.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                at = source.randrange(len(word))
                word[at : at + source.choice([0, 1])] = source.choice(["", "a", "B", "ÿ"])
            chosen.append("".join(word))
        texts.append((None if i % 17 == 0 else i // 2, " ".join(chosen), "a"))
    rows = texts + [(None, None, None), (5, "", "b"), (6, "thirteen" * 3000, "b"), *[(9, "thirteen Thirteen", "c")] * 30]
    expected = spelled([row[:2] for row in rows])
    assert sum(row[1] is not None for row in expected) > 30
    assert variants(cases.documents(spark, rows), crowd=crowd) == expected


def test_chain_of_forms(spark):
    """Each word five times as frequent as the one before it: the root is the last."""
    words = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdewyx", "abcdvwyx"]
    rows = [(None, " ".join([word] * 5 * 5**i), "a") for i, word in enumerate(words)]
    found = {row[0]: row for row in variants(cases.documents(spark, rows))}
    assert [found[word][1] for word in words] == [*words[1:], None]
    assert {row[2] for row in found.values()} == {words[-1]}


def test_words_that_share_a_chunk_in_great_numbers(spark):
    """A third of all words begin alike; the pairs that are compared stay few and none is lost."""
    source = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {"prefix" + "".join(source.choices(letters, k=4)) for _ in range(800)}
    words |= {word[:-1] + source.choice(letters) for word in list(words)[:100]}
    words |= {"".join(source.choices(letters, k=8)) for _ in range(800)}
    frame = spark.createDataFrame([(word, 5) for word in words], "word string, n long")
    found = {frozenset(row) for row in spelling.near_pairs(frame, 64).select("longer", "shorter").collect()}
    expected = set()
    held = sorted(words)
    for i, a in enumerate(held):
        for b in held[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and edits(a, b) == 1:
                expected.add(frozenset((a, b)))
    assert found == expected and expected


def edits(a, b):
    """0, 1 or 2 for more edits than one."""
    if a == b:
        return 0
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return 1 if (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]) else 2


def test_variants_of_nothing(spark, empty):  # noqa: F811
    assert variants(empty) == []
    assert variants(cases.documents(spark, [(1, None, "a"), (2, "short words only", "b")])) == []


# --- Merkle manifest ---------------------------------------------------------------------------


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def manifest(rows, arity=16):
    """Rows are (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return hashed(*map(field, row))

    def order(row):
        return row[0] is not None, row[0] or 0, leaf(row)

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([hashed(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            start = i // arity * arity
            out.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + arity])))
            i //= arity
        return out

    sources = sorted({row[1] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted((row for row in rows if row[1] == s), key=order) for s in sources}
    trees = {s: tree([leaf(row) for row in held[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, row in enumerate(held[s]):
            steps, node = path(trees[s], i) + path(top, k), leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf((*row[:4], None if row[4] is None else row[4].translate(LOWER)))
            for before, after in steps:
                node = hashed(before, node, after)
            proof, root = hashed(*(b + a for b, a in steps)), top[-1][0]
            out.append((row[0], leaf(row), trees[s][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def proven(docs, **options):
    return cases.as_tuples(merkle.check_tampering(docs, merkle.every_fifth(), **options))


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_manifest(spark, arity):
    docs = cases.documents(spark)
    rows = [tuple(row) for row in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert proven(docs, arity=arity) == manifest(rows, arity)


def test_manifest_with_a_hot_source(spark):
    source = random.Random(6)
    rows = [
        (source.choice([i, i, i, 7, None]), f"Text {i % 90}", source.choice(["hot", "hot", "", None, "-", "é", "a", f"s{i % 40}"]))
        for i in range(900)
    ]
    docs = cases.documents(spark, rows)
    plain = [tuple(row) for row in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = proven(docs)
    assert found == manifest(plain)
    assert {row[-1] for row in found} == {True, False}


@pytest.mark.parametrize("size", [0, 1, 16, 17, 257])
def test_manifest_of_one_source(spark, size):
    docs = cases.documents(spark, [(i, f"T{i}", "a") for i in range(size)]) if size else cases.documents(spark).limit(0)
    plain = [tuple(row) for row in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert proven(docs) == (manifest(plain) if size else [])


def test_every_change_shows(spark):
    """A change of any field of any row changes the root; the proof of that row no longer leads to the old one."""
    docs = cases.documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    root = proven(docs)[0][3]
    for name, value in (("text", "!"), ("lang", None), ("n_chars", 0), ("source", "other")):
        kind = docs.schema[name].dataType
        changed = docs.withColumn(name, F.when(F.col("doc_id") == 13, F.lit(value).cast(kind)).otherwise(F.col(name)))
        assert {row[3] for row in proven(changed)} != {root}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_manifest_sql(spark, tables):  # noqa: F811
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    for folder, held in ((SF_DIR, connection), tables):
        found = QUERIES["op13_merkle_manifest"](spark, folder)
        expected = held.execute(ORACLE["op13_merkle_manifest"]).to_arrow_table()
        assert expected.column_names == found.columns
        assert cases.as_tuples(found) == sorted((tuple(row.values()) for row in expected.to_pylist()), key=repr)

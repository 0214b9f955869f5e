"""Licences, mixing, toxicity and winnowing against SQL, brute force and held-out labels."""

from __future__ import annotations

import hashlib
import random as random_numbers
from collections import Counter, defaultdict

import duckdb
import llm_cases as cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from llm_cases import empty, tables  # noqa: F401

from pluvia.llm import licences, mixing, toxicity, winnowing
from pluvia.llm.queries import ORACLE, QUERIES

MASK = (1 << 64) - 1


def native(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, tables, name):
    folder, connection = tables
    found = QUERIES[name](spark, folder)
    assert native(found) or name == "op7_exact_dedup"
    columns = sorted(found.columns)
    expected = connection.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    assert cases.as_tuples(found.select(columns)) == sorted(
        expected.select(*columns).fetchall(), key=repr
    )


def test_licence_rules(spark):
    sentences = licences.SENTENCES
    texts = {
        "MIT": "Copyright Someone\n\n" + "\n".join(sentences[i] for i in (1, 2, 3, 4)),
        "GPL-3.0-or-later": " ".join(sentences[i] for i in (14, 15, 18, 19, 20)).replace(" the ", "\nthe  "),
        "MIT,MIT": "First\nReleased under the MIT License.\nReleased under the MIT license!!",
        "Apache-2.0": " ".join(sentences[i] for i in (5, 6, 7)) + "\n\n  http://x.org/L-2.0\n\n" + sentences[8] + " " + sentences[9],
        "BSD-3-Clause,CC-BY-4.0": " ".join(sentences[i] for i in (10, 11, 12, 13)) + "\nblah.\n" + sentences[25],
        "": sentences[2] + " " + sentences[1],
    }
    found = licences.scan_licences(spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string"))
    rows = sorted(found.collect())
    assert [row["licences"] for row in rows] == list(texts)
    assert [row["incomplete"] for row in rows] == [False] * 5 + [True]
    assert native(found)


BSD = """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def commented(text, mark):
    return "".join((f"{mark} {line}".rstrip() if line else mark) + "\n" for line in text.splitlines())


def test_licences_as_published(spark):
    two = BSD.split("3. ")[0] + BSD.split("permission.\n\n")[1]
    texts = []
    for text, name in ((BSD, "BSD-3-Clause"), (two, "BSD-2-Clause"), (APACHE, "Apache-2.0")):
        texts += [(text, name), (text.replace("\n", "\r\n"), name)]
        texts += [(commented(text, mark) + "code();\n", name) for mark in ("#", "//", ";;", "--", "dnl", "REM", "!")]
        texts += [("/*\n" + commented(text, " *") + " */\ncode();\n", name)]
    texts += [(BSD.replace(". Re", ") Re").replace("3. N", "3) N"), "BSD-3-Clause")]
    texts += [(BSD.replace("1. R", "* R").replace("2. R", "* R").replace("3. N", "* N"), "BSD-3-Clause")]
    texts += [("This work is licensed under the GNU General Public License, version\n3. And more.", "GPL-3.0")]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(texts)], "doc_id long, text string")
    rows = sorted(licences.scan_licences(frame).collect())
    assert [(row["licences"], row["incomplete"]) for row in rows] == [(name, False) for _, name in texts]


GPL_LINES = """{} free software{} you can redistribute it and/or modify
it under the terms of the GNU {}General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

{} distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {}General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND SOMEONE ELSE DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL SOMEONE ELSE BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""


def gpl(kind, version, before=("This program is", ":", ",")):
    name, colon, comma = before
    return GPL_LINES.format(name, colon, kind, comma, version, name, kind)


def notices():
    """(text, licences, incomplete): names in the notices, far sentences, identifiers."""
    named = BSD.replace("the copyright holder nor", "the University of California, Berkeley nor")
    gap = licences.GAP
    sentences = licences.SENTENCES
    return [
        (named, "BSD-3-Clause", False),
        (named.replace("California, Berkeley", "Foo Inc."), "BSD-3-Clause", False),
        (BSD.replace("3. N", "3. All advertising materials mentioning features or use of this software must display the "
                     "following acknowledgement:\n   This product includes Foo.\n\n4. N"), "BSD-4-Clause", False),
        ("\n".join(sentences[i] for i in (1, 2, 3, 4)).replace("THE AUTHORS OR COPYRIGHT HOLDERS", "FOO"), "MIT", False),
        (sentences[10] + " " + sentences[11] + " x.\n" * gap + sentences[12], "BSD-2-Clause", False),
        (sentences[10] + " " + sentences[11] + " x.\n" * (gap + 1) + sentences[12], "", True),
        (sentences[14] + "\n" + "Another paragraph.\n\n" * 500 + sentences[15], "GPL-3.0-or-later", True),
        (gpl("", 3), "GPL-3.0-or-later", False),
        (gpl("", 2, ("This program is", ";", ";")), "GPL-2.0-or-later", False),
        (gpl("", 3, ("This program is", ";", ";")), "GPL-3.0-or-later", False),
        (commented(gpl("", 3, ("GNU Foo is", ":", ",")), " *"), "GPL-3.0-or-later", False),
        (gpl("Lesser ", "2.1", ("This library is", ";", ";")), "LGPL-2.1-or-later", False),
        (gpl("Lesser ", 3), "LGPL-3.0-or-later", False),
        (commented(gpl("Affero ", 3), "#"), "AGPL-3.0-or-later", False),
        (MPL, "MPL-2.0", False),
        ("/* " + MPL.replace("\n", "\n * ") + "*/", "MPL-2.0", False),
        (ISC, "ISC", False),
        (ISC.replace(", provided that the above\ncopyright notice and this permission notice appear in all copies", ""),
         "0BSD", False),
        (ZLIB, "Zlib", False),
        (commented(ZLIB, "//").replace("\n", "\r\n"), "Zlib", False),
        ("Distributed under the Boost Software License, Version 1.0. (See x)", "BSL-1.0", False),
        ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License "
         "2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0",
         "EPL-2.0,EPL-2.0", False),
        ("#!/bin/sh\n# SPDX-License-Identifier: MIT\necho 1: 2", "MIT", False),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */\nint x;", "GPL-2.0-or-later", False),
        ("// SPDX-License-Identifier: MIT OR Apache-2.0\n", "", True),
        ("SPDX-License-Identifier:", "", False),
        (" may be used to endorse or promote products derived from this software without specific prior written "
         "permission", "", False),
        ("é\u2028# dnl rem\u0085* x)\n\r\rREM\n dnlx\n#\n1) i) \x0b.\x0b\x0c\n? ok:\n", "", False),
    ]


def test_names_gaps_and_identifiers_in_both_engines(spark, tmp_path):
    cased = notices()
    frame = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(cased)], "doc_id long, text string")
    found = licences.scan_licences(frame)
    assert native(found)
    rows = sorted(found.collect())
    assert [(row["licences"], row["incomplete"]) for row in rows] == [tuple(rest) for _, *rest in cased]
    texts = [text for text, *_ in cased]
    texts += [a + glue + b for glue in ("", " ", "\n", "\n\n") for a, b in zip(texts, texts[1:] + texts[:1])]
    texts += [text[: len(text) * part // 7] for text in texts for part in range(1, 7)] + ["", None, BSD, APACHE]
    frame = spark.createDataFrame([(i % 300, text) for i, text in enumerate(texts)], "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    columns = ["doc_id", "known", "licences", "n_licences", "incomplete"]
    with duckdb.connect() as connection:
        connection.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = connection.sql(licences.SQL).select(*columns).fetchall()
    assert cases.as_tuples(licences.scan_licences(frame).select(columns)) == sorted(expected, key=repr)


def test_targets(spark):
    sizes = {"a": 100, "b": 10, "c": 1000, "d": 1, "e": 0, None: 300}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row["source"]: row["target"] for row in mixing.source_targets(frame).collect()}
    weights = dict(zip(sizes, (5, 2, 1, 5, 2, 1)))
    # Share by weight, stop at three times the size, share the excess again.
    target, open_sources, rest = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while rest > 1e-9 and open_sources:
        total = sum(weights[s] for s in open_sources)
        for s in open_sources:
            target[s] += rest * weights[s] / total
        rest = sum(max(0.0, target[s] - 3 * sizes[s]) for s in open_sources)
        for s in [s for s in open_sources if target[s] >= 3 * sizes[s]]:
            target[s] = 3.0 * sizes[s]
            open_sources.discard(s)
    assert found == pytest.approx(target)


def mixed(spark, rows):
    draws = mixing.with_quality(mixing.with_draws(cases.documents(spark, rows)), cases.labels(spark))
    return mixing.mix(draws, buckets=8)


def test_mix(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 5 * (i % 3 > 0)}") for i in range(300)] + [(None, None, None)]
    found = mixed(spark, rows).collect()
    assert len(found) == len(rows)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for row in found:
        taken[row["source"]] += row["taken"]
        target[row["source"]] = row["target"]
        largest[row["source"]] = max(largest[row["source"]], row["size"])
        assert row["taken"] == row["copies"] * row["size"] <= 3 * row["size"]
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)
    assert cases.as_tuples(mixed(spark, rows)) == sorted(map(tuple, found), key=repr)
    docs = cases.documents(spark, rows)
    copied = mixing.take_copies(docs, mixed(spark, rows))
    assert copied.columns == docs.columns
    counts = Counter(row["doc_id"] for row in copied.collect())
    assert counts == Counter({row["doc_id"]: row["copies"] for row in found if row["copies"]})


def test_good_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.col("id").cast("string").alias("x"))
    docs = docs.withColumn("source", F.lit("s"))
    quality = F.when(F.col("doc_id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.25))
    found = mixing.mix(mixing.with_draws(docs).withColumn("quality", quality), share=0.3).where("copies > 0")
    even, odd = (found.where(f"doc_id % 2 = {i}").count() for i in (0, 1))
    assert even + odd == 1200 and even > 2.5 * odd


def test_toxicity_on_held_out_labels(spark):
    rows = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = rows.join(labels, "doc_id").where("held_out").toPandas()
    toxic, called = found["toxic"] == 1, found["predicted"] == 1
    ranks = found["score"].rank()
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.93
    assert called[toxic].mean() > 0.7 and called[~toxic].mean() < 0.01


def test_non_negative_risk_finds_the_positive_words():
    random = np.random.default_rng(0)
    noise = [np.unique(random.integers(2, 200, 30)).astype(np.int32) for _ in range(3000)]
    positive = [np.union1d(n, [0]).astype(np.int32) for n in noise[:300]]
    unlabelled = noise[600:] + [np.union1d(n, [0]).astype(np.int32) for n in noise[300:600]]
    weights, intercept = toxicity.train_one(positive, unlabelled, 300 / 2700, 200, 0)
    assert weights[0] > 3 and abs(weights[2:]).max() < weights[0] / 2 and intercept < -1


def test_toxicity_cases(spark, tables, empty):
    folder, _ = tables
    found = QUERIES["op6_toxicity"](spark, folder)
    assert found.count() == len(cases.ROWS)
    docs, none = cases.documents(spark), cases.labels(spark).limit(0)
    everything = F.lit(True)
    assert toxicity.fit(docs, none, everything).score("x") < 1e-6
    clean = cases.labels(spark, [(1, 1, 0), (2, 1, 0)])
    assert toxicity.fit(docs, clean, everything).score(None) < 1e-6
    half = toxicity.fit(empty, cases.labels(spark, [(1, 1, 0), (2, 1, 1)]), everything)
    assert half.score("") == pytest.approx(0.5)
    kept = toxicity.reject_toxic(docs, half)
    assert kept.columns == docs.columns and kept.count() == len(cases.ROWS)
    assert toxicity.score(empty, half).count() == 0


def chained(values):
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), seed)
    return seed


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def winnowed(text):
    import re

    pieces = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % winnowing.PIECE, text)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    if len(hashes) >= winnowing.GRAM:
        grams = [signed(chained(hashes[i : i + winnowing.GRAM])) for i in range(len(hashes) - winnowing.GRAM + 1)]
    else:
        grams = [signed(chained(hashes))] if hashes else []
    width = min(winnowing.WINDOW, len(grams))
    chosen = set()
    for at in range(len(grams) - width + 1 if grams else 0):
        chosen.add(max((p for p in range(at, at + width) if grams[p] == min(grams[at : at + width]))))
    return [(grams[p], p) for p in sorted(chosen)]


def test_winnowing(spark):
    texts = [t or "" for _, t, _ in cases.ROWS] + ["a b c a b c a b c a b c a b c", "a a a a a a a a a a a"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    found = sorted(winnowing.with_fingerprint(frame, "text", "marks").select("n", "marks").collect())
    for row in found:
        assert [tuple(mark) for mark in row["marks"]] == winnowed(texts[row["n"]])


def test_stretches_of_texts(spark):
    """Texts that end about the end of a stretch, with equal hashes on both sides of it."""
    random, near = random_numbers.Random(8), winnowing.STRETCH
    texts = ["".join(random.choice("ab🙂") for _ in range(near * k + more)) for k in (0, 1, 2) for more in range(0, 30)]
    texts += ["a" * (near + 40), " a\n" * (2 * near)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "n long, text string, span int")
    found = winnowing.with_marks(frame.repartition("span"), "span", "text").collect()
    assert len(found) == len(texts)
    for row in found:
        assert list(zip(row["hash"], row["position"])) == winnowed(texts[row["n"]])


def test_a_shared_passage_is_found_at_every_offset(spark):
    passage = "".join(chr(0x4E00 + i * 7919 % 5000) for i in range(200))
    texts = [passage] + ["甲乙丙丁戊"[:offset] + passage for offset in (1, 2, 3, 4, 5)] + ["a\u00a0b" + passage.upper()]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    rows = sorted(winnowing.with_fingerprint(frame, "text", "marks").select("n", "marks.hash").collect())
    first = set(rows[0]["hash"])
    assert len(first) > 20
    assert all(len(first & set(row["hash"])) >= len(first) - 2 for row in rows)
    # Whatever surrounds it, a passage as long as a gram and a window, less one, shares a hash.
    size = winnowing.GRAM + winnowing.WINDOW - 1
    short = [passage[50 : 50 + size], *("x" * i + passage[50 : 50 + size] + "y" * 40 for i in range(5))]
    marks = winnowing.with_fingerprint(spark.createDataFrame([(t,) for t in short], "text string"), "text", "marks")
    found = [set(row["hash"]) for row in marks.select("marks.hash").collect()]
    assert all(found[0] & other for other in found)


@pytest.mark.parametrize("bits, top", [(winnowing.SPAN_BITS, winnowing.TOP), (2, 3)])
def test_next_documents(spark, tmp_path, monkeypatch, bits, top):
    monkeypatch.setattr(winnowing, "SPAN_BITS", bits)
    monkeypatch.setattr(winnowing, "TOP", top)
    cases.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op8_winnowing"](spark, str(tmp_path))
    assert native(found)
    rows = sorted(((i, t or "") for i, t, _ in cases.ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = [{h for h, _ in winnowed(t)} for t in (text, edited, after)]
        near = [len(marks[0] & m) / len(marks[0] | m) if marks[0] | m else 1.0 for m in marks[1:]]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    columns = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    assert cases.as_tuples(found.select(columns)) == sorted(expected, key=repr)
    prints = {row["fingerprint"] for row in found.collect() if row["doc_id"] in (1, 2)}
    assert len(prints) == 1


def test_empty_tables(spark, empty):
    assert licences.scan_licences(empty).count() == 0
    draws = mixing.with_quality(mixing.with_draws(empty), cases.labels(spark).limit(0))
    assert mixing.take_copies(empty, mixing.mix(draws)).count() == 0
    assert winnowing.compare_with_next(empty).count() == 0


def test_copies_are_taken_by_source(spark):
    """One id and text in two sources: each source takes its own number of copies."""
    docs = cases.documents(spark, [(1, "the same text", "a"), (1, "the same text", "b"), (1, "the same text", None)])
    mixed = spark.createDataFrame(
        [(source, copies) for source, copies in (("a", 3), ("b", 1), (None, 2))], "source string, copies long"
    ).withColumn("row_key", F.lit(hashlib.md5(f"1|{hashlib.md5(b'the same text').hexdigest()}".encode()).hexdigest()))
    taken = mixing.take_copies(docs, mixed).groupBy("source").count()
    assert cases.as_tuples(taken) == [("a", 3), ("b", 1), (None, 2)]

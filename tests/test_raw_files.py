"""The station files that the queries about files read."""

from __future__ import annotations

from pluvia.parity import queries

SF_DIR = "/root/testdata/sf0.001"


def test_files_of_all_years_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    passes = []
    build = queries._station_files
    monkeypatch.setattr(queries, "_lineitem", lambda *args, real=queries._lineitem: (passes.append(1), real(*args))[1])
    monkeypatch.setattr(queries, "_built", {})
    folder = queries.raw_files(spark, SF_DIR)
    assert len(passes) == 1
    expected = {
        (row.ano, row.l_suppkey): row.content for row in build(spark, SF_DIR).where("ano is not null").collect()
    }
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    assert len(found) == len(expected)
    for row in found:
        year, name = row.path.split("/")[-2:]
        text = bytes(row.content).decode("latin-1")
        assert text.endswith("\n")
        lines, wanted = text[:-1].split("\r\n"), expected[int(year), int(name.split("-")[1])].split("\r\n")
        assert lines[:9] == wanted[:9] and sorted(lines[9:]) == sorted(wanted[9:])

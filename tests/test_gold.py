"""Gold from the monthly state: refreshes against full builds, publication at once, what is read."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pluvia.errors import PublishError
from pluvia.operators import dim_date, dim_station, monthly_mean, monthly_state, union_by_name
from pluvia.plans import gold_tables, silver_to_gold
from pluvia.plans import silver_to_gold as job_module  # noqa: F401
from pluvia.plans.silver_to_gold import parted_fact, small_tables
from pluvia.schemas import FACT, GOLD_SCHEMAS, SILVER_SCHEMA, STATE, STATE_SCHEMA
from pluvia.sources import current, publish, read_gold_table, read_silver, silver_years, write_silver
from pluvia.sources.publishing import Folder, read_published


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def rounded(frame):
    """Rows with their means rounded: sums of doubles depend on their order."""
    means = [name for name, kind in frame.dtypes if name.endswith(("_mm", "_c")) and "media" in name]
    return rows(frame.withColumns({name: F.round(name, 9) for name in means}))


def readings(spark, rng, year, n):
    """Readings of a landing year, some of the neighbouring years', some without a time."""
    start = datetime(year, 1, 1) - timedelta(days=3)
    data = []
    for _ in range(n):
        at = start + timedelta(hours=rng.randrange(24 * 371)) if rng.random() > 0.03 else None
        data.append(
            (
                at, rng.choice([None, rng.randrange(80) / 4]), rng.choice([None, rng.randrange(-40, 160) / 4]),
                "hot" if rng.random() < 0.4 else rng.choice(["A1", "A2", None]), rng.choice(["X", "Y"]),
                rng.choice(["SP", "RJ", None]), rng.choice(["SE", "S"]), rng.choice([None, -1.5]), year,
            )
        )
    names = "datetime timestamp_ntz, precipitacao_mm double, temperatura_c double, estacao_codigo string, estacao_nome string, uf string, regiao string, latitude double, ano int"
    return union_by_name(spark.createDataFrame([], SILVER_SCHEMA), spark.createDataFrame(data, names))


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("silver", "gold", "other", "log")}


def everything(spark, root):
    return {name: rounded(read_gold_table(spark, root, name)) for name in GOLD_SCHEMAS}


def test_state_gives_what_the_readings_give(spark):
    rng = random.Random(1)
    silver = readings(spark, rng, 2020, 400).unionByName(readings(spark, rng, 2021, 300)).repartition(5)
    found = small_tables(monthly_state(silver))
    assert rows(found["dim_estacao"]) == rows(dim_station(silver))
    assert rows(found["dim_data"]) == rows(dim_date(silver))
    for name, key, measure in (("chuva_mensal_por_regiao", "regiao", "precipitacao"), ("temperatura_mensal_por_uf", "uf", "temperatura")):
        column, mean = ("precipitacao_mm", "precipitacao_media_mm") if measure[0] == "p" else ("temperatura_c", "temperatura_media_c")
        assert rounded(found[name]) == rounded(monthly_mean(silver, key, column, mean))
        assert found[name].dtypes == [(f.name, f.dataType.simpleString()) for f in GOLD_SCHEMAS[name]]
    state = monthly_state(silver)
    assert state.dtypes == [(f.name, f.dataType.simpleString()) for f in STATE_SCHEMA]
    assert state.agg(F.sum("linhas")).first()[0] == 700
    assert state.count() <= 2 * 13 * 40


@pytest.mark.parametrize("seed", range(2))
def test_refreshes_equal_a_full_build(spark, paths, seed):
    """Years come, change, lose months and go; a refresh always leaves what building anew gives."""
    rng = random.Random(seed)
    for year in (2019, 2020, 2021):
        write_silver(readings(spark, rng, year, 200), paths["silver"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    for step in range(3):
        year = rng.choice([2019, 2020, 2021, 2022])
        changed = readings(spark, rng, year, 150).where(f"datetime is null or month(datetime) % 4 <> {step}")
        write_silver(changed, paths["silver"])
        if step == 1:
            Folder(spark, paths["silver"]).remove("ano=2019")
            write_silver(readings(spark, rng, 2021, 50), paths["silver"])  # changed, but not asked for
        counts = silver_to_gold(spark, paths["silver"], paths["gold"], [year] if year in silver_years(spark, paths["silver"]) else [2021])
        silver_to_gold(spark, paths["silver"], paths["other"])
        found = everything(spark, paths["gold"])
        assert found == everything(spark, paths["other"])
        assert {name: len(table) for name, table in found.items() if name != FACT} == {
            name: n for name, n in counts.items() if name != FACT
        }
        whole = {name: rounded(frame) for name, frame in gold_tables(read_silver(spark, paths["silver"])).items()}
        assert found == whole


def test_a_refresh_reads_its_year_and_the_state(spark, paths):
    rng = random.Random(3)
    for year in (2020, 2021):
        write_silver(readings(spark, rng, year, 100), paths["silver"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    before = current(spark, paths["gold"])
    write_silver(readings(spark, rng, 2021, 100).where("datetime < '2021-07-01'"), paths["silver"])
    counts = silver_to_gold(spark, paths["silver"], paths["gold"], [2021])
    after = current(spark, paths["gold"])
    # The other year's parts are the same folders as before, the changed one's are new; the vanished months are in neither.
    for name in (STATE, FACT):
        kept = set(before.tables[name]) & set(after.tables[name])
        assert [folder.rpartition("=")[2] for folder in kept] == ["2020"]
    year = read_silver(spark, paths["silver"], [2021])
    assert counts[FACT] == year.count()
    assert read_gold_table(spark, paths["gold"], FACT).where("ano = 2021 and mes > 7 and mes < 12").isEmpty()

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    scan = plan(monthly_state(year))
    assert scan.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(ano" in scan
    assert "ReadSchema: struct<datetime:timestamp_ntz,precipitacao_mm:double,temperatura_c:double,regiao:string,uf:string" in scan
    assert plan(parted_fact(year)).count("FileScan parquet") == 1
    state = read_published(spark, paths["gold"], STATE, STATE_SCHEMA)
    for name, frame in small_tables(state).items():
        assert plan(frame).count("FileScan") == 1 and "/silver" not in plan(frame), name


@pytest.mark.parametrize("failing", ["chuva_mensal_por_regiao", "temperatura_mensal_por_uf", "publish"])
def test_a_job_that_fails_leaves_gold_as_it_was(spark, paths, monkeypatch, failing):
    import sys

    module = sys.modules["pluvia.plans.silver_to_gold"]
    rng = random.Random(4)
    write_silver(readings(spark, rng, 2020, 100), paths["silver"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    before, folders = everything(spark, paths["gold"]), _folders(spark, paths["gold"])
    write_silver(readings(spark, rng, 2020, 120), paths["silver"])

    def broken(df, root, name="publish", *rest):
        if failing in ("publish", str(name).partition("/")[0]):
            raise OSError("no space left")
        return original(df, root, name, *rest)

    target = "publish" if failing == "publish" else "write_aggregate"
    original = getattr(module, target)
    monkeypatch.setattr(module, target, broken)
    for years in (None, [2020]):
        with pytest.raises(OSError):
            silver_to_gold(spark, paths["silver"], paths["gold"], years, paths["log"])
    assert everything(spark, paths["gold"]) == before
    assert _folders(spark, paths["gold"]) == folders  # nothing of the failed job is left
    monkeypatch.undo()
    silver_to_gold(spark, paths["silver"], paths["gold"], [2020])
    assert len(everything(spark, paths["gold"])[FACT]) == 120


def _folders(spark, root):
    return {f"{name}/{part}" for name in Folder(spark, root).names() for part in Folder(spark, f"{root}/{name}").names()}


def test_a_reader_keeps_its_tables_while_a_job_publishes(spark, paths):
    rng = random.Random(5)
    write_silver(readings(spark, rng, 2020, 60), paths["silver"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    reader, old = read_gold_table(spark, paths["gold"], FACT), current(spark, paths["gold"])
    write_silver(readings(spark, rng, 2020, 70), paths["silver"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    assert reader.count() == 60 and read_gold_table(spark, paths["gold"], FACT).count() == 70
    assert read_gold_table(spark, paths["gold"], FACT, old).count() == 60
    # Two publications later the old folders are gone, the new ones are all there is.
    silver_to_gold(spark, paths["silver"], paths["gold"])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    held = _folders(spark, paths["gold"])
    assert not any(folder.rpartition("/origem")[0] in held or folder in held for folder in old.folders())
    assert len([f for f in held if f.startswith("_manifestos")]) == 2


def test_of_two_jobs_one_publishes(spark, paths):
    first = publish(spark, paths["gold"], None, {"t": ["t/versao=1"]}, {})
    with pytest.raises(PublishError):
        publish(spark, paths["gold"], None, {"t": ["t/versao=2"]}, {})
    assert current(spark, paths["gold"]) == first
    assert publish(spark, paths["gold"], first, {"t": ["t/versao=3"]}, {"2020": "x"}).number == 2


def test_years_come_from_folders(spark, paths):
    assert silver_years(spark, paths["silver"]) == {}
    rng = random.Random(6)
    write_silver(readings(spark, rng, 2020, 10).unionByName(readings(spark, rng, 2022, 10)), paths["silver"])
    first = silver_years(spark, paths["silver"])
    assert list(first) == [2020, 2022]
    write_silver(readings(spark, rng, 2022, 10), paths["silver"])
    again = silver_years(spark, paths["silver"])
    assert again[2020] == first[2020] and again[2022] != first[2022]

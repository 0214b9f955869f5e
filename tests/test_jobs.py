"""Files to Gold on small hand-made station files."""

from __future__ import annotations

import json
import random
import zipfile
from datetime import datetime

import pytest
from conftest import RAIN, STATION_FILES, TEMPERATURE, metadata, station_file, write_raw
from pyspark.sql import functions as F

from pluvia.errors import EmptyInputError, LandingError
from pluvia.plans import (
    bronze_to_silver,
    check_gold,
    ingest,
    mean_rain_by_region,
    mean_temperature_by_uf,
    parse_readings,
    read_run_log,
    run_stage,
    run_summary,
    silver_readings,
    silver_to_gold,
    stations_with_most_rain,
    year_label,
)
from pluvia.schemas import GOLD_SCHEMAS, MEASURES, SILVER_SCHEMA
from pluvia.sources import (
    available_years,
    land_archives,
    read_gold_fact,
    read_gold_table,
    read_silver,
    scan_station_files,
    staging_views,
)

HEADER = f"Data;Hora UTC;{RAIN};{TEMPERATURE};"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def types(frame_or_schema):
    schema = getattr(frame_or_schema, "schema", frame_or_schema)
    return [(field.name, field.dataType.simpleString()) for field in schema]


def one_station(*lines, code="A001", header=HEADER, uf="DF"):
    return station_file(metadata("CO", uf, "X", code, "-15,5", "-47,5", "1"), header, lines)


def core(frame):
    return rows(frame.select("estacao_codigo", "datetime", "precipitacao_mm", "temperatura_c"))


EXPECTED_SILVER = [
    ("A001", datetime(2023, 1, 31, 23), 0.8, 20.5),
    ("A001", datetime(2023, 2, 1, 0), None, 21.0),
    ("A001", datetime(2023, 2, 1, 1), 1.2, None),
    ("A002", datetime(2023, 1, 31, 23), 0.0, 25.0),
    ("A002", datetime(2023, 2, 1, 0), 2.4, 27.5),
    ("S003", datetime(2023, 2, 1, 0), -9999.0, 60.0),
]


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "silver", "gold", "log", "archives")}


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
@pytest.mark.parametrize("limit", [1 << 25, 0, 420])
def test_silver_is_the_same_whole_or_split(spark, raw_root, zone, limit):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        silver = silver_readings(spark, str(raw_root), [2023], whole_file_limit=limit)
        assert core(silver) == EXPECTED_SILVER
        assert rows(silver.select("estacao_nome", "altitude", "uf", "regiao", "ano").distinct()) == sorted(
            [
                ("BRASÍLIA", 1160.96, "DF", "CO", 2023),
                ("GOIÂNIA", None, "GO", "CO", 2023),
                ("PORTO ALEGRE", None, "RS", "S", 2023),
            ],
            key=repr,
        )
        absent = [name for name in MEASURES if name not in ("precipitacao_mm", "temperatura_c")]
        assert silver.where(F.coalesce(*absent).isNotNull()).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_pipeline(spark, raw_root, paths):
    report = bronze_to_silver(spark, str(raw_root), paths["silver"], [2023], paths["log"])
    assert report == {2023: {"linhas": 6, "invalid_numbers": 0, "invalid_times": 0}}
    silver = read_silver(spark, paths["silver"])
    assert core(silver) == EXPECTED_SILVER
    assert types(spark.read.parquet(paths["silver"])) == types(SILVER_SCHEMA)

    for _ in range(2):
        counts = silver_to_gold(spark, paths["silver"], paths["gold"], log_dir=paths["log"])
    assert counts == {
        "dim_estacao": 3,
        "dim_data": 2,
        "fato_leitura_climatica": 6,
        "chuva_mensal_por_regiao": 3,
        "temperatura_mensal_por_uf": 5,
    }
    gold = {name: read_gold_table(spark, paths["gold"], name) for name in GOLD_SCHEMAS}
    for name, schema in GOLD_SCHEMAS.items():
        written = [name for name in types(spark.read.parquet(f"{paths['gold']}/{name}")) if name[0] not in ("versao", "origem")]
        assert written == types(schema)
    assert [tuple(r) for r in gold["dim_data"].orderBy("data").select("dia", "trimestre", "estacao_do_ano").collect()] == [
        (31, 1, "verao"), (1, 1, "verao"),
    ]
    rain = [tuple(row) for row in gold["chuva_mensal_por_regiao"].collect()]
    assert [row[:3] for row in rain] == [("CO", 2023, 1), ("CO", 2023, 2), ("S", 2023, 2)]
    assert [row[3] for row in rain] == pytest.approx([0.4, 1.8, -9999])
    assert [tuple(row) for row in gold["temperatura_mensal_por_uf"].collect()] == [
        ("DF", 2023, 1, 20.5), ("DF", 2023, 2, 21.0), ("GO", 2023, 1, 25.0), ("GO", 2023, 2, 27.5), ("RS", 2023, 2, 60.0),
    ]
    fact, dim = gold["fato_leitura_climatica"], gold["dim_estacao"]
    assert rows(fact.groupBy("ano", "mes").count()) == [(2023, 1, 2), (2023, 2, 4)]
    assert [tuple(row) for row in stations_with_most_rain(fact, dim, 2023, 2, 2).collect()] == [
        ("A002", "GOIÂNIA", "GO", 2.4), ("A001", "BRASÍLIA", "DF", 1.2),
    ]
    assert rows(mean_temperature_by_uf(gold["temperatura_mensal_por_uf"], "df", 2023, 1)) == [("DF", 2023, 1, 20.5)]
    assert rows(mean_rain_by_region(gold["chuva_mensal_por_regiao"], "co", 2023, 2)) == [("CO", 2023, 2, 1.8)]

    quality = {
        (r.table, r.column, r.check): (r.severity, r.failures) for r in check_gold(spark, paths["gold"]).collect()
    }
    assert quality.pop(("fato_leitura_climatica", "temperatura_c", "accepted_range")) == ("warn", 1)
    assert len(quality) == 6 and set(quality.values()) == {("error", 0)}

    assert staging_views(spark, paths["gold"]) == ["stg_dim_estacao", "stg_fato_leitura_climatica"]
    assert spark.sql("select count(*) from stg_fato_leitura_climatica where mes = 2").first()[0] == 4
    by_month = spark.sql(
        "select sum(precipitacao_mm) from stg_fato_leitura_climatica where ano = :ano and mes = :mes",
        args={"ano": 2023, "mes": 1},
    )
    assert by_month.first()[0] == pytest.approx(0.8)

    log = read_run_log(spark, paths["log"])
    assert rows(log.select("etapa", "ano", "status", "linhas", "erro")) == sorted(
        [("transformacao_silver", "2023", "sucesso", 6, None)] + [("modelagem_gold", "2023", "sucesso", 6, None)] * 2
    )
    assert rows(run_summary(log).select("etapa", "runs", "linhas")) == [
        ("modelagem_gold", 2, 12), ("transformacao_silver", 1, 6),
    ]


def test_rerun_replaces_its_year_only(spark, raw_root, paths):
    write_raw(raw_root, 2024, {"A.CSV": one_station("2024/01/01;0000 UTC;1;2;")})
    for _ in range(2):
        bronze_to_silver(spark, str(raw_root), paths["silver"], [2023, 2024])
    assert read_silver(spark, paths["silver"]).count() == 7
    write_raw(raw_root, 2024, {"A.CSV": one_station("2024/01/01;0000 UTC;5;2;", "2024/01/01;0100 UTC;1;2;")})
    bronze_to_silver(spark, str(raw_root), paths["silver"], [2024])
    silver = read_silver(spark, paths["silver"])
    assert core(silver.where("ano = 2023")) == EXPECTED_SILVER
    assert core(read_silver(spark, paths["silver"], [2024])) == [
        ("A001", datetime(2024, 1, 1, 0), 5.0, 2.0), ("A001", datetime(2024, 1, 1, 1), 1.0, 2.0),
    ]
    assert [row.ano for row in available_years(silver).collect()] == [2023, 2024]


def test_duplicates_over_files_and_unknown_columns(spark, tmp_path):
    header = f'Data;Hora UTC;"Nota; livre";{TEMPERATURE};Unnamed: 3;'
    files = {
        "A.CSV": one_station("2023/01/01;0000 UTC;1;20;", "2023/01/01;0100 UTC;1;20;"),
        "B.CSV": one_station("2023/01/01;0000 UTC;1;20;"),
        "C.CSV": one_station('2023/01/01;0000 UTC;"a;b";7;z;', "2023/01/01;0100 UTC;;8", code="A002", header=header),
        "d.csv": one_station("2023/01/01;0000 UTC;1;20;", code="A009"),
    }
    write_raw(tmp_path, 2023, files)
    for limit in (1 << 25, 0):
        silver = silver_readings(spark, str(tmp_path), [2023], whole_file_limit=limit)
        assert core(silver) == [
            ("A001", datetime(2023, 1, 1, 0), 1.0, 20.0),
            ("A001", datetime(2023, 1, 1, 1), 1.0, 20.0),
            ("A002", datetime(2023, 1, 1, 0), None, 7.0),
            ("A002", datetime(2023, 1, 1, 1), None, 8.0),
            ("A009", datetime(2023, 1, 1, 0), 1.0, 20.0),
        ]
        extras = silver.where("estacao_codigo = 'A002'").orderBy("datetime").select("extras").collect()
        assert [row.extras for row in extras] == [{"Nota; livre": "a;b"}, {"Nota; livre": None}]
        assert silver.where("estacao_codigo = 'A001' and extras is not null").count() == 0


def test_unreadable_texts_are_counted_or_fail(spark, tmp_path, paths):
    lines = ["2023/01/01;0000 UTC;x;1.234,5;", "2023/01/01;2400 UTC;1;2;", ";0100 UTC;3;4;", "2023/01/01;0200 UTC;NA;"]
    write_raw(tmp_path / "raw", 2023, {"A.CSV": one_station(*lines)})
    with pytest.raises(Exception, match="not a UTC date and hour: 2023/01/01 2400"):
        bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], paths["log"])
    report = bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], paths["log"], strict=False)
    assert report[2023] == {"linhas": 4, "invalid_numbers": 2, "invalid_times": 1}
    log = read_run_log(spark, paths["log"]).orderBy("fim").collect()
    assert [(row.status, row.linhas) for row in log] == [("falha", 0), ("sucesso", 4)]
    assert "2400" in log[0].erro and log[0].duracao_s >= 0
    counts = silver_to_gold(spark, paths["silver"], paths["gold"])
    assert counts["dim_data"] == 2
    assert rows(read_gold_table(spark, paths["gold"], "dim_data").where("data is null").select("estacao_do_ano")) == [
        ("primavera",)
    ]


def test_every_unreadable_text_counts(spark, tmp_path, paths):
    odd = '2023/01/01;0200 UTC;"1;2;'
    bad = ["2023/01/01;9900 UTC;1;2;"] * 20 + [odd] + ["2023/01/01;0100 UTC;x;2;"] * 5
    write_raw(tmp_path / "raw", 2023, {"A.CSV": one_station(*bad), "sub/b.csv": one_station(*bad, code="A002")})
    for limit in (1 << 25, 0):
        report = bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], strict=False, whole_file_limit=limit)
        assert report == {2023: {"linhas": 44, "invalid_numbers": 12, "invalid_times": 40}}


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_unreadable_texts_take_no_second_read(spark, tmp_path, paths, monkeypatch, limit):
    """The counts come with the rows: one scan, one shuffle of readings, and they are taken above it."""
    import sys

    module, plans = sys.modules["pluvia.plans.bronze_to_silver"], []
    write, scan = module.write_silver, module.scan_station_files
    scans = []
    monkeypatch.setattr(module, "write_silver", lambda df, root: (plans.append(df), write(df, root)))
    monkeypatch.setattr(module, "scan_station_files", lambda *args: (scans.append(args), scan(*args))[1])
    hot = ["2023/01/01;0000 UTC;x;y;"] * 500 + ["2023/01/01;0000 UTC;1;y;"]
    write_raw(tmp_path / "raw", 2023, {f"{n}.CSV": one_station(*hot, "2023/02/30;0000 UTC;1;2;") for n in range(3)})
    report = bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], strict=False, whole_file_limit=limit)
    assert report == {2023: {"linhas": 4, "invalid_numbers": 3003, "invalid_times": 3}}
    assert len(scans) == len(plans) == 1
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(ano") == 1 and plan.index("CollectMetrics") < plan.index("Exchange hashpartitioning(ano")
    assert core(read_silver(spark, paths["silver"]).where("datetime is not null")) == [("A001", datetime(2023, 1, 1), 1.0, None)]


@pytest.mark.parametrize("seed", range(3))
def test_a_file_means_the_same_whatever_its_size(spark, tmp_path, seed):
    """Repeated keys, too few or many metadata lines, other headers, odd dates, late metadata and header lines."""
    rng = random.Random(seed)
    files = {}
    for n in range(12):
        head = [f"{k}:;{rng.choice('ABC')}{n}" for k in ("REGIAO", "UF", "ESTACAO", "CODIGO (WMO)", "UF", "X", "LATITUDE", "Y", "Z")]
        names = ["Data", "Hora UTC", RAIN, TEMPERATURE]
        rng.shuffle(names)
        cells = {"Data": "2023/01/01", "Hora UTC": "0000 UTC", RAIN: "1", TEMPERATURE: "2"}
        lines = [";".join(cells[name] for name in names)] * 2
        lines += ["2023/01/01:;0000 UTC;1;2", "UF;x", ";".join(names), "", " ", "UF:;late", ";".join(names)]
        rng.shuffle(lines)
        text = head[: rng.choice([7, 8, 8, 9])] + [""] * rng.randint(0, 2) + [";".join(names)] + lines[: rng.randint(0, 9)]
        files[f"{n}.CSV"] = "\r\n".join(text).encode("latin-1")
    write_raw(tmp_path, 2023, files)
    found = []
    for limit in (1 << 25, 0):
        scanned = scan_station_files(spark, str(tmp_path), [2023], limit)
        parsed = parse_readings(scanned, strict=False).drop("file", "number")
        found.append(rows(parsed.withColumn("extras", F.to_json("extras"))))
    assert found[0] == found[1] and len(found[0]) > 10


def test_strict_fails_for_a_file_without_rows(spark, tmp_path, paths):
    short = one_station("2023/01/01;0000 UTC;1;2;").split(b"\r\n")
    write_raw(tmp_path / "raw", 2023, {"A.CSV": b"\r\n".join(short[:3] + short[4:]), "B.CSV": STATION_FILES["B.CSV"]})
    for limit in (1 << 25, 0):
        with pytest.raises(Exception, match="no date or hour column in .*A.CSV"):
            bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], whole_file_limit=limit)


def test_sentinels(spark, raw_root):
    silver = silver_readings(spark, str(raw_root), [2023], sentinels=[-9999])
    assert silver.where("precipitacao_mm < 0").count() == 0 and silver.count() == 6


def test_empty_input_is_an_error_and_logged(spark, tmp_path, paths):
    (tmp_path / "raw" / "2020").mkdir(parents=True)
    for year in (2020, 2021):
        with pytest.raises(EmptyInputError):
            bronze_to_silver(spark, paths["raw"], paths["silver"], [year], paths["log"])
    with pytest.raises(EmptyInputError):
        silver_to_gold(spark, paths["silver"], paths["gold"], log_dir=paths["log"])
    with pytest.raises(EmptyInputError):
        silver_to_gold(spark, paths["silver"], paths["gold"], [2019], paths["log"])
    log = read_run_log(spark, paths["log"])
    assert rows(log.groupBy("etapa", "status").count()) == [
        ("modelagem_gold", "falha", 2), ("transformacao_silver", "falha", 2),
    ]


def _month_counts(spark, paths):
    return rows(read_gold_fact(spark, paths["gold"]).groupBy("ano", "mes").count())


def test_refreshing_one_year_keeps_the_others(spark, tmp_path, paths):
    raw = tmp_path / "raw"
    # The 2023 folder also holds the first hour of 2024.
    write_raw(raw, 2023, {"A.CSV": one_station("2023/12/31;2300 UTC;1;1;", "2024/01/01;0000 UTC;1;1;")})
    write_raw(raw, 2024, {"A.CSV": one_station("2024/01/01;0100 UTC;1;1;", "2024/02/01;0000 UTC;1;1;")})
    bronze_to_silver(spark, paths["raw"], paths["silver"], [2023, 2024])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    full = [(2023, 12, 1), (2024, 1, 2), (2024, 2, 1)]
    assert _month_counts(spark, paths) == full

    counts = silver_to_gold(spark, paths["silver"], paths["gold"], [2023], paths["log"])
    # The year's own two readings are written again, not its neighbour's of the same month.
    assert counts["fato_leitura_climatica"] == 2 and counts["dim_data"] == 3
    assert _month_counts(spark, paths) == full
    assert rows(read_gold_table(spark, paths["gold"], "temperatura_mensal_por_uf").select("ano", "mes")) == [
        (2023, 12), (2024, 1), (2024, 2),
    ]

    write_raw(raw, 2024, {"A.CSV": one_station("2024/01/01;0100 UTC;1;1;", "2024/03/01;0000 UTC;1;1;")})
    bronze_to_silver(spark, paths["raw"], paths["silver"], [2024])
    silver_to_gold(spark, paths["silver"], paths["gold"], [2024], paths["log"])
    # February has vanished from the readings, so it must vanish from the fact.
    assert _month_counts(spark, paths) == [(2023, 12, 1), (2024, 1, 2), (2024, 3, 1)]
    assert rows(read_run_log(spark, paths["log"]).select("ano")) == [("2023",), ("2024",)]


def test_refresh_without_an_earlier_gold(spark, raw_root, paths):
    bronze_to_silver(spark, str(raw_root), paths["silver"], [2023])
    assert silver_to_gold(spark, paths["silver"], paths["gold"], [2023])["fato_leitura_climatica"] == 6


def test_fact_filter_prunes_partitions(spark, raw_root, paths):
    bronze_to_silver(spark, str(raw_root), paths["silver"], [2023])
    silver_to_gold(spark, paths["silver"], paths["gold"])
    top = stations_with_most_rain(
        read_gold_fact(spark, paths["gold"]), read_gold_table(spark, paths["gold"], "dim_estacao"), 2023, 1
    )
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<estacao_codigo:string,precipitacao_mm:double>" in plan


def _archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)


def test_ingest(spark, tmp_path, paths):
    archives, raw = tmp_path / "archives", tmp_path / "raw"
    _archive(archives / "2023.zip", STATION_FILES | {"sub/D.CSV": b"x", "../E.txt": b"y", "folder/": b""})
    _archive(archives / "2024.zip", {"F.CSV": STATION_FILES["A.CSV"]})
    assert ingest(spark, str(archives), str(raw), [2023], paths["log"]) == {2023: 4}
    assert {str(p.relative_to(raw)) for p in raw.rglob("*") if p.is_file() and "_landed" not in p.parts} == {
        "2023/A.CSV", "2023/B.CSV", "2023/C.CSV", "2023/sub/D.CSV", "2023/E.txt",
    }
    for name, content in STATION_FILES.items():
        assert (raw / "2023" / name).read_bytes() == content
    # A landed year is left alone, a new one is added.
    (raw / "2023" / "A.CSV").write_bytes(b"kept")
    assert ingest(spark, str(archives), str(raw), [2023, 2024], paths["log"]) == {2023: 4, 2024: 1}
    assert (raw / "2023" / "A.CSV").read_bytes() == b"kept"
    with pytest.raises(EmptyInputError):
        ingest(spark, str(archives), str(raw), [2025], paths["log"])
    log = read_run_log(spark, paths["log"]).orderBy("fim").collect()
    assert [(r.etapa, r.ano, r.status, r.linhas) for r in log] == [
        ("ingestao_bronze", "2023", "sucesso", 4),
        ("ingestao_bronze", "2023", "sucesso", 4),
        ("ingestao_bronze", "2024", "sucesso", 1),
        ("ingestao_bronze", "2025", "falha", 0),
    ]


def test_a_broken_archive_fails_its_year(spark, tmp_path, paths):
    archives = tmp_path / "archives"
    archives.mkdir()
    (archives / "2023.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="archives/2023.zip: "):
        ingest(spark, str(archives), paths["raw"], [2023], paths["log"])
    assert rows(read_run_log(spark, paths["log"]).select("ano", "status", "linhas")) == [("2023", "falha", 0)]


def test_a_broken_archive_fails_only_its_year_and_is_tried_again(spark, tmp_path, paths):
    many = {f"{i}.CSV": STATION_FILES["A.CSV"] for i in range(33)}
    _archive(tmp_path / "archives" / "2022.zip", many)
    _archive(tmp_path / "archives" / "2023.zip", many)
    broken = tmp_path / "archives" / "2023.zip"
    whole = broken.read_bytes()
    at = len(whole) // 2
    broken.write_bytes(whole[:at] + bytes(b ^ 255 for b in whole[at : at + 40]) + whole[at + 40 :])
    for _ in range(2):
        with pytest.raises(LandingError, match="2023.zip"):
            ingest(spark, paths["archives"], paths["raw"], [2022, 2023], paths["log"])
    broken.write_bytes(whole)
    assert ingest(spark, paths["archives"], paths["raw"], [2022, 2023], paths["log"]) == {2022: 33, 2023: 33}
    log = read_run_log(spark, paths["log"]).orderBy("fim").select("ano", "status", "linhas").collect()
    failed, landed = [("2022", "sucesso", 33), ("2023", "falha", 0)], [("2022", "sucesso", 33), ("2023", "sucesso", 33)]
    assert [tuple(row) for row in log] == failed * 2 + landed


def test_landing_again_completes_a_folder(spark, tmp_path, paths):
    _archive(tmp_path / "archives" / "2023.zip", STATION_FILES)
    raw = tmp_path / "raw"
    for _ in range(2):
        landed = land_archives(spark, paths["archives"], paths["raw"])
        assert {(r.ano, r.member) for r in landed.collect()} == {(2023, name) for name in STATION_FILES}
        assert {p.name for p in (raw / "2023").iterdir() if not p.name.startswith(".")} == set(STATION_FILES)
        (raw / "2023" / "A.CSV").write_bytes(STATION_FILES["A.CSV"][::-1])
    list(land_archives(spark, paths["archives"], paths["raw"]).collect())
    assert (raw / "2023" / "A.CSV").read_bytes() == STATION_FILES["A.CSV"]


def test_a_file_without_time_columns_fails(spark, tmp_path, paths):
    renamed = HEADER.replace("Data;", "DATA (YYYY-MM-DD);")
    write_raw(tmp_path / "raw", 2023, {"A.CSV": one_station("2023/01/01;0000 UTC;1;2;", header=renamed)})
    with pytest.raises(Exception, match="no date or hour column in .*A.CSV"):
        bronze_to_silver(spark, paths["raw"], paths["silver"], [2023])
    report = bronze_to_silver(spark, paths["raw"], paths["silver"], [2023], strict=False)
    assert report[2023]["invalid_times"] == 1
    extras = read_silver(spark, paths["silver"]).first().extras
    assert extras == {"DATA (YYYY-MM-DD)": "2023/01/01"}


def test_reading_some_years_prunes_folders(spark, raw_root, paths):
    bronze_to_silver(spark, str(raw_root), paths["silver"], [2023])
    plan = read_silver(spark, paths["silver"], [2023]).select("uf")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "ReadSchema: struct<uf:string>" in plan


def test_one_hot_key_and_one_hot_station(spark, tmp_path, paths):
    """Most rows share one key; the result does not depend on how they are spread."""
    hot = ["2023/01/01;0000 UTC;5;1;"] * 3000 + ["2023/01/01;0000 UTC;4;9;"]
    cold = [f"2023/01/{day:02d};0000 UTC;1;2;" for day in range(2, 30)]
    write_raw(tmp_path / "raw", 2023, {f"{i}.CSV": one_station(*hot, *cold) for i in range(3)})
    for limit in (1 << 25, 1000):
        silver = silver_readings(spark, paths["raw"], [2023], whole_file_limit=limit)
        assert silver.count() == 29
        assert rows(silver.where("day(datetime) = 1").select("precipitacao_mm", "temperatura_c")) == [(4.0, 9.0)]


def test_years_side_by_side(spark, tmp_path, paths):
    """Five years at once, one of them empty: the others are written, each has its record."""
    for year in range(2018, 2023):
        lines = [f"{year}/01/01;0{h}00 UTC;{h};2;" for h in range(year - 2016)] if year != 2020 else []
        write_raw(tmp_path / "raw", year, {"A.CSV": one_station(*lines)})
    with pytest.raises(EmptyInputError, match="2020"):
        bronze_to_silver(spark, paths["raw"], paths["silver"], range(2018, 2023), paths["log"])
    assert rows(read_silver(spark, paths["silver"]).groupBy("ano").count()) == [(2018, 2), (2019, 3), (2021, 5), (2022, 6)]
    log = read_run_log(spark, paths["log"]).select("ano", "status", "linhas")
    assert rows(log) == [
        ("2018", "sucesso", 2), ("2019", "sucesso", 3), ("2020", "falha", 0), ("2021", "sucesso", 5), ("2022", "sucesso", 6),
    ]


def test_run_log_records(spark, paths):
    with pytest.raises(RuntimeError):
        with run_stage(spark, paths["log"], "etapa", "2020-2023") as run:
            run.linhas = 5
            raise RuntimeError("não deu")
    with run_stage(spark, paths["log"], "etapa", 2023) as run:
        run.linhas = 7
    text = spark.read.text(paths["log"]).collect()
    records = sorted((json.loads(row.value) for row in text), key=lambda r: r["status"])
    assert [list(r) for r in records] == [["etapa", "ano", "status", "linhas", "inicio", "fim", "duracao_s", "erro"]] * 2
    assert [(r["ano"], r["status"], r["linhas"], r["erro"]) for r in records] == [
        ("2020-2023", "falha", 0, "não deu"), ("2023", "sucesso", 7, None),
    ]
    assert all(datetime.fromisoformat(r["fim"]).utcoffset().total_seconds() == 0 for r in records)


def test_year_label():
    assert [year_label(y) for y in ([2023], [2021, 2020, 2023], [2023, 2023], [])] == ["2023", "2020-2023", "2023", ""]

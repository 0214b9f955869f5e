from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pluvia.session import build_session  # noqa: E402

RAIN = "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"
TEMPERATURE = "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "pluvia-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def station_file(metadata, header, rows):
    lines = [f"{key}:;{value}" for key, value in metadata] + [header, *rows]
    return "".join(f"{line}\r\n" for line in lines).encode("latin-1")


def metadata(regiao, uf, nome, codigo, lat, lon, alt, altitude_key="ALTITUDE"):
    return [
        ("REGIAO", regiao),
        ("UF", uf),
        ("ESTACAO", nome),
        ("CODIGO (WMO)", codigo),
        ("LATITUDE", lat),
        ("LONGITUDE", lon),
        (altitude_key, alt),
        ("DATA DE FUNDACAO", "07/05/00"),
    ]


STATION_FILES = {
    "A.CSV": station_file(
        metadata("CO", "DF", "BRASÍLIA", "A001", "-15,78944444", "-47,92583332", "1160,96"),
        f"Data;Hora UTC;{RAIN};{TEMPERATURE};",
        [
            "2023/01/31;2300 UTC;,8;20,5;",
            "2023/02/01;0000 UTC;;21;",
            "2023/02/01;0000 UTC;;21;",
            "2023/02/01;0100 UTC;1,2;;",
        ],
    ),
    "B.CSV": station_file(
        metadata("CO", "GO", "GOIÂNIA", "A002", "-16,64", "-49,22", "NULL"),
        f"Data;Hora UTC;{TEMPERATURE};{RAIN};",
        ["2023/01/31;2300 UTC;25;0;", "2023/02/01;0000 UTC;27,5;2,4;"],
    ),
    "C.CSV": station_file(
        metadata("S", "RS", "PORTO ALEGRE", "S003", "-30,05", "-51,17", "10", "ALTITUDE (m)"),
        f"Data;Hora UTC;{RAIN};{TEMPERATURE};",
        ["2023/02/01;0000 UTC;-9999;60;"],
    ),
}


def write_raw(root, year, files):
    folder = root / str(year)
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    write_raw(root, 2023, STATION_FILES)
    return root

"""Every operator on the relational tables.

A line item plays the reading (station ``l_suppkey``, time ``l_shipdate``), a supplier the station; its
nation is the state and its region the region.  Names of the columns are arguments of the operators.

Joins carry no broadcast hint: Spark broadcasts a side while its files are small and shuffles it beyond.
Where a query only needs totals, line items are reduced per station before they meet the suppliers.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyInputError
from ..functions import month_span, month_window, parse_measure, parse_utc_timestamp, split_cells
from ..operators import (
    accepted_range,
    attach_metadata,
    bind_columns_by_name,
    check_accepted_range,
    check_not_null,
    check_unique,
    dedup_readings,
    dim_date,
    dim_station,
    monthly_mean,
    not_null,
    project_fact,
    quality_report,
    read_file_metadata,
    read_line_metadata,
    row_counts,
    union_by_name,
    unique,
    value_counts,
)
from ..operators.quality import GOLD_RULES
from ..plans import (
    bronze_to_silver,
    mean_rain_by_region,
    mean_temperature_by_uf,
    parse_readings,
    read_run_log,
    run_summary,
    silver_to_gold,
    stations_with_most_rain,
)
from ..schemas import DIM_DATE, DIM_STATION, FACT, MEASURE_HEADERS, RAIN_BY_REGION, SILVER_SCHEMA, TEMPERATURE_BY_UF
from ..session import qualified, shared_dir
from ..sources import (
    available_years,
    pending_years,
    read_gold_fact,
    read_gold_table,
    read_silver,
    read_years,
    scan_station_files,
    staging_views,
    write_silver,
)
from ..sources.archives import filesystem_of
from ..sources.byte_ranges import readable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIME, STATION = "l_shipdate", "l_suppkey"


# Given, so that no job has to open the files for their schema first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz
    """,
    "events": """
        event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string
    """,
}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers with the names of their nation and region."""
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return _table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").alias(STATION),
        F.col("s_name").alias("nome"),
        F.col("n_name").alias("uf"),
        F.col("r_name").alias("regiao"),
        F.col("s_acctbal").alias("altitude"),
    )


def _with_comma(number: str) -> Column:
    return F.replace(F.col(number).cast("string"), F.lit("."), F.lit(","))


# -- text to values -----------------------------------------------------------------------------------


@query("parse_decimal")
def decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 10
    text = (
        F.when(kind == 0, F.lit("NULL"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("x"))
        .otherwise(F.concat(F.lit(" "), _with_comma("s_acctbal")))
    )
    return _table(spark, sf_dir, "supplier").select("s_suppkey", parse_measure(text).alias("v"))


def _utc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("ts").cast("string")
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit("/")).alias("date"),
        F.concat(F.substring(text, 12, 2), F.substring(text, 15, 2), F.lit(" UTC")).alias("hour"),
    )


@query("parse_utc_timestamp")
def parse_utc_timestamp_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = parse_utc_timestamp(F.col("date"), F.col("hour"))
    return _utc_texts(spark, sf_dir).select("event_id", time.alias("t"))


@query("parse_utc_timestamp_permissive")
def parse_utc_timestamp_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("event_id") % 5 == 0, F.lit("2400 UTC")).otherwise(F.col("hour"))
    time = parse_utc_timestamp(F.col("date"), odd, strict=False)
    return _utc_texts(spark, sf_dir).select("event_id", time.alias("t"))


# -- station files ------------------------------------------------------------------------------------


def _metadata_lines(*more: Column) -> Column:
    def line(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"{key}:;"), value)

    return F.array(
        line("REGIAO", F.col("regiao")),
        line("UF", F.col("uf")),
        line("ESTACAO", F.col("nome")),
        line("CODIGO (WMO)", F.col(STATION).cast("string")),
        line("LATITUDE", F.lit("-15,5")),
        line("LONGITUDE", F.lit("NULL")),
        line("ALTITUDE", _with_comma("altitude")),
        line("DATA DE FUNDACAO", F.lit("07/05/00")),
        *more,
    )


def _described(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        F.col("estacao_codigo").cast("bigint").alias("s_suppkey"),
        F.col("estacao_nome").alias("nome"),
        "uf",
        "regiao",
        "altitude",
    )


@query("read_file_metadata")
def read_file_metadata_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _stations(spark, sf_dir).select(
        F.col(STATION).cast("string").alias("file"), _metadata_lines(F.lit("Data;")).alias("lines")
    )
    return _described(read_file_metadata(files))


@query("read_line_metadata")
def read_file_metadata_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _stations(spark, sf_dir).select(
        F.col(STATION).cast("string").alias("file"),
        F.posexplode(_metadata_lines(F.lit("Data;"))).alias("number", "line"),
    )
    return _described(read_line_metadata(lines.withColumn("number", F.col("number") + 1)))


@query("attach_metadata")
def attach_metadata_to_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", STATION, "l_quantity")
    return attach_metadata(readings, _stations(spark, sf_dir).drop("altitude"), STATION)


@query("bind_columns_by_name")
def bind_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, nation = _with_comma("s_acctbal"), F.col("s_nationkey").cast("string")
    even = F.col("s_suppkey") % 2 == 0
    files = _table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(even, F.lit("A;B;")).otherwise(F.lit("B;A;")).alias("head"),
        F.when(even, F.concat_ws(";", balance, nation, F.lit("")))
        .otherwise(F.concat_ws(";", nation, balance, F.lit("")))
        .alias("line"),
    )
    rows = files.select(
        "s_suppkey",
        split_cells(F.col("head")).alias("header"),
        split_cells(F.col("line")).alias("cells"),
    )
    names = ("a", "b", "c")
    bound = bind_columns_by_name(rows, {name.upper(): name for name in names})
    return bound.select("s_suppkey", *[parse_measure(F.col(name)).alias(name) for name in names])


@query("dedup_readings")
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [
        F.desc(TIME), STATION, "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    unique_rows = dedup_readings(_lineitem(spark, sf_dir), ["l_orderkey", "l_linenumber"], order)
    return unique_rows.select(
        "l_orderkey", "l_linenumber", STATION, "l_partkey", "l_quantity", "l_extendedprice", TIME
    )


@query("union_by_name")
def union_columns_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "value")
    others = events.where("event_type <> 'click' or event_type is null").select("user_id", "event_id")
    return union_by_name(clicks, others)


# -- years --------------------------------------------------------------------------------------------


def _years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem(spark, sf_dir).select(F.year(TIME).alias("ano"))


@query("available_years")
def years_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_years(_years(spark, sf_dir))


@query("pending_years")
def years_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = spark.range(1990, 2011).select(F.col("id").cast("int").alias("ano"))
    return pending_years(requested, _years(spark, sf_dir))


@query("read_years")
def years_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (1996, 1998)
    # The table is not partitioned by year: ranges of the time let the scan skip row groups.
    ranges = reduce(or_, (month_span(F.col(TIME), year * 12, year * 12 + 11) for year in wanted))
    readings = _lineitem(spark, sf_dir).where(ranges).select(F.year(TIME).alias("ano"))
    return read_years(readings, wanted).groupBy("ano").agg(F.count(F.lit(1)).alias("n"))


# -- star schema --------------------------------------------------------------------------------------


def _station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _lineitem(spark, sf_dir).groupBy(STATION).agg(F.max(TIME).alias(TIME))
    attributes = ["nome", "uf", "regiao", "altitude"]
    return dim_station(seen.join(_stations(spark, sf_dir), STATION), STATION, attributes, TIME)


@query("dim_station")
def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _station_dimension(spark, sf_dir).withColumnRenamed(STATION, "s_suppkey")


@query("dim_date")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_date(_lineitem(spark, sf_dir), TIME)


def _fact(readings: DataFrame) -> DataFrame:
    return project_fact(readings, TIME, STATION, ["l_quantity", "l_extendedprice"])


@query("project_fact")
def fact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(_lineitem(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str, key: str, measure: str, *window: int) -> DataFrame:
    readings = _lineitem(spark, sf_dir)
    if window:
        readings = readings.where(month_window(F.col(TIME), *window))
    return monthly_mean(
        readings, key, measure, "media", TIME, 2, _stations(spark, sf_dir), STATION
    )


@query("monthly_rain_by_region")
def monthly_rain_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "regiao", "l_quantity").orderBy("regiao", "ano", "mes")


@query("monthly_temp_by_uf")
def monthly_temp_by_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "uf", "l_extendedprice").orderBy("uf", "ano", "mes")


# -- lookups ------------------------------------------------------------------------------------------


@query("mean_temperature_by_uf")
def lookup_temperature_by_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _monthly(spark, sf_dir, "uf", "l_extendedprice", 1998, 1)
    return mean_temperature_by_uf(table, "nation_3", 1998, 1, measure="media")


@query("mean_rain_by_region")
def lookup_rain_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _monthly(spark, sf_dir, "regiao", "l_quantity", 1998, 1)
    return mean_rain_by_region(table, "asia", 1998, 1, measure="media")


@query("stations_with_most_rain")
def top_stations_by_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(_lineitem(spark, sf_dir).where(month_window(F.col(TIME), 1998, 1)))
    return stations_with_most_rain(
        fact, _stations(spark, sf_dir), 1998, 1, 5, STATION, ("nome", "uf"), "l_quantity", "total"
    )


# -- quality ------------------------------------------------------------------------------------------


@query("check_unique")
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(_lineitem(spark, sf_dir), "l_orderkey", "l_linenumber")


@query("check_not_null")
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    asia = _table(spark, sf_dir, "region").where("r_name = 'ASIA'")
    nations = _table(spark, sf_dir, "nation").join(asia, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    described = _table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    return check_not_null(described, "r_name")


@query("check_accepted_range")
def quality_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_accepted_range(_lineitem(spark, sf_dir), "l_quantity", 5, 45)


@query("quality_report")
def quality_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        unique("l_orderkey", "l_linenumber"),
        not_null(STATION),
        accepted_range("l_quantity", 5, 45, severity="warn"),
    ]
    report = quality_report(_lineitem(spark, sf_dir), rules, "lineitem")
    return report.select(F.col("check").alias("chk"), "severity", "failures", "passed")


# -- observability ------------------------------------------------------------------------------------


@query("row_counts")
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of three tables that are the distinct values of some columns of one: counted in one scan."""
    readings = _lineitem(spark, sf_dir).select(STATION, F.to_date(TIME).alias("data"))
    return value_counts(readings, {"dim_station": [STATION], "dim_date": ["data"], "fact": []})


@query("row_counts_tables")
def separate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of tables that have nothing in common, each counted by itself."""
    readings = _lineitem(spark, sf_dir)
    return row_counts(
        {
            "dim_station": _station_dimension(spark, sf_dir),
            "dim_date": dim_date(readings, TIME),
            "fact": _fact(readings),
        }
    )


@query("run_summary")
def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("etapa"),
        F.when(F.col("user_id") % 7 == 0, "falha").otherwise("sucesso").alias("status"),
        F.col("event_id").alias("linhas"),
        F.col("ts").alias("fim"),
        F.col("event_id").cast("double").alias("duracao_s"),
    )
    return run_summary(log)


# -- whole jobs ---------------------------------------------------------------------------------------

# The columns that stand in for measures, and the order their headers get in the files.
_MEASURED = {
    "precipitacao_mm": "l_quantity",
    "pressao_mb": "l_discount",
    "temperatura_c": "l_extendedprice",
    "umidade_pct": "l_tax",
}


def _station_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ano, l_suppkey, content)``: the line items as station files, one per supplier and year; some discounts are no numbers."""
    headers = {name: header for header, name in MEASURE_HEADERS.items()}
    header = ";".join(["Data", "Hora UTC", *(headers[name] for name in _MEASURED), "Pedido", ""])
    day = F.replace(F.substring(F.col(TIME).cast("string"), 1, 10), F.lit("-"), F.lit("/"))
    hour = F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit("00 UTC"))
    measured = {name: _with_comma(column) for name, column in _MEASURED.items()}
    measured["pressao_mb"] = F.when(F.expr(_UNREADABLE), "não lido").otherwise(measured["pressao_mb"])
    cells = [day, hour, *measured.values(), F.col("l_orderkey").cast("string"), F.lit("")]
    # A station-year is about a megabyte: as much as one row of a file's text may hold.
    years = (
        _lineitem(spark, sf_dir)
        .groupBy(F.year(TIME).alias("ano"), STATION)
        .agg(F.collect_list(F.concat_ws(";", *cells)).alias("rows"))
        .join(_stations(spark, sf_dir), STATION)
    )
    lines = F.concat(_metadata_lines(F.lit(header)), F.col("rows"))
    return years.select("ano", STATION, F.array_join(lines, "\r\n").alias("content"))


def _file_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write ``(ano, station, content)`` as ``<folder>/<ano>/part-<station>-<number>`` and say how many files that made.

    A name depends on nothing but the row, and a file gets it when it is whole: a task that runs again writes the same.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = filesystem_of(folder)
        made: Counter[tuple[int, int]] = Counter()
        folders: set[int] = set()
        for batch in batches:
            for year, station, content in zip(*(column.to_pylist() for column in batch.columns)):
                if year not in folders:
                    filesystem.create_dir(f"{root}/{year}", recursive=True)
                    folders.add(year)
                name = f"part-{station}-{made[year, station]}"
                made[year, station] += 1
                partial = f"{root}/{year}/.{name}.{uuid.uuid4().hex}"
                with filesystem.open_output_stream(partial) as sink:
                    sink.write(content + b"\n")
                filesystem.move(partial, f"{root}/{year}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["files"])

    return write


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the station files, written as they come: Latin-1, one file each, a folder per year."""

    def build(path: str) -> None:
        latin = F.encode("content", "ISO-8859-1")
        files, folder = _station_files(spark, sf_dir), qualified(spark, path)
        if readable(folder):
            # Some hundred thousand small files: tasks write those of all years in one pass over the line items.
            rows = files.where("ano is not null").select("ano", STATION, latin.alias("content"))
            rows.mapInArrow(_file_writer(folder), "files bigint").agg(F.sum("files")).collect()
            return
        # Bytes in the form of a string: the writer of texts passes them on.
        text = latin.cast("string").alias("value")
        for year in landing_years(spark, sf_dir):
            files.where(F.col("ano") == year).select(text).write.option("maxRecordsPerFile", 1).text(f"{path}/{year}")

    return _once(spark, sf_dir, "raw", build)


def landing_years(spark: SparkSession, sf_dir: str) -> list[int]:
    years = _lineitem(spark, sf_dir).select(F.year(TIME).alias("ano")).where("ano is not null")
    return [row.ano for row in available_years(years).collect()]


_UNREADABLE = "l_linenumber = 4 and l_partkey % 5 = 0"
#: Names of the files, by whichever way they are written.
FILES = "part-*"


def silver_of_files(spark: SparkSession, sf_dir: str) -> str:
    """Silver as the job makes it of the files, with the job's counts beside it."""

    def build(path: str) -> None:
        years = landing_years(spark, sf_dir)
        counts = bronze_to_silver(spark, raw_files(spark, sf_dir), path, years, f"{path}_log", glob=FILES)
        rows = [(year, found["linhas"], found["invalid_numbers"], found["invalid_times"]) for year, found in counts.items()]
        names = "ano int, linhas bigint, invalid_numbers bigint, invalid_times bigint"
        spark.createDataFrame(rows, names).write.parquet(f"{path}_counts")

    return _once(spark, sf_dir, "silver-of-files", build)


def _typed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings without the way through text, for the queries about what comes after."""
    time = F.col(TIME) + F.make_dt_interval(hours=F.col("l_linenumber"))
    readings = _lineitem(spark, sf_dir).select(
        time.alias("datetime"),
        F.year(TIME).alias("ano"),
        F.col(STATION),
        *[F.col(source).alias(name) for name, source in _MEASURED.items()],
    )
    described = dedup_readings(readings, ["ano", STATION, "datetime"]).join(_stations(spark, sf_dir), STATION)
    named = described.withColumn("estacao_codigo", F.col(STATION).cast("string")).withColumnRenamed(
        "nome", "estacao_nome"
    )
    # Known to be empty before it is planned: the union goes, and with it what would forget the order of the rows.
    absent = spark.createDataFrame([], SILVER_SCHEMA).where(F.lit(False))
    return union_by_name(absent, named.drop(STATION))


_built: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]) -> str:
    """Path of a table that is built on first use in an application; the driver removes it at its end."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _built:
        path = shared_dir(spark, name)
        build(path)
        _built[key] = path
    return _built[key]


def _written_silver(spark: SparkSession, sf_dir: str) -> str:
    # The deduplication leaves its rows spread by key and sorted by year first, as the write needs them: a second shuffle,
    # of rows three times as wide, would only make the files fewer.
    return _once(spark, sf_dir, "silver", lambda path: write_silver(_typed_silver(spark, sf_dir), path))


def _log(spark: SparkSession, sf_dir: str) -> str:
    """The run log of the Gold job and of one that fails."""

    def build(path: str) -> None:
        silver_to_gold(spark, _written_silver(spark, sf_dir), shared_dir(spark, "gold"), log_dir=path)
        with suppress(EmptyInputError):
            silver_to_gold(spark, _written_silver(spark, sf_dir), shared_dir(spark, "gold"), [1900], path)

    return _once(spark, sf_dir, "log", build)


def _written_gold(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "gold", lambda path: silver_to_gold(spark, _written_silver(spark, sf_dir), path))


@query("scan_station_files")
def scanned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of written station files: of some years read whole, of the others in ranges of bytes."""
    raw, years = raw_files(spark, sf_dir), landing_years(spark, sf_dir)
    whole = scan_station_files(spark, raw, years[::2], glob=FILES)
    parts = scan_station_files(spark, raw, years[1::2], limit=0, glob=FILES)
    return parse_readings(whole.unionByName(parts)).select(
        "estacao_codigo", "estacao_nome", "uf", "regiao", "altitude", "datetime", "ano", *_MEASURED,
        F.col("extras")["Pedido"].cast("bigint").alias("pedido"), "invalid_numbers", "invalid_times",
    )


@query("bronze_to_silver")
def files_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the job makes of written station files."""
    return read_silver(spark, silver_of_files(spark, sf_dir)).select(
        "estacao_codigo", "estacao_nome", "uf", "regiao", "altitude", "datetime", "ano",
        *_MEASURED, "vento_direcao_gr", F.col("extras")["Pedido"].cast("bigint").alias("pedido"),
    )


@query("bronze_to_silver_counts")
def files_to_silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job returns and logs per year: rows written, and unreadable texts, those of duplicates included."""
    path = silver_of_files(spark, sf_dir)
    log = read_run_log(spark, f"{path}_log").select(F.col("ano").cast("int"), "etapa", "status", F.col("linhas").alias("no_log"))
    return spark.read.parquet(f"{path}_counts").join(log, "ano")


@query("read_silver")
def silver_table_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written Silver table, read back for two years."""
    silver = read_silver(spark, _written_silver(spark, sf_dir), [1996, 1998])
    return silver.select("estacao_codigo", "uf", "datetime", "ano", *_MEASURED)


@query("read_gold_fact")
def gold_fact_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written fact, read back for one month."""
    fact = read_gold_fact(spark, _written_gold(spark, sf_dir)).where("ano = 1998 and mes = 1")
    return fact.select("data", "datetime", "estacao_codigo", "temperatura_c", "precipitacao_mm", "ano", "mes")


@query("read_gold_table")
def gold_rain_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written monthly means."""
    return read_gold_table(spark, _written_gold(spark, sf_dir), RAIN_BY_REGION)


@query("silver_to_gold")
def gold_whole_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole written fact with the attributes of its stations."""
    root = _written_gold(spark, sf_dir)
    dim = read_gold_table(spark, root, DIM_STATION).select("estacao_codigo", "estacao_nome", "uf", "regiao")
    fact = read_gold_table(spark, root, FACT).select(
        "data", "datetime", "estacao_codigo", "temperatura_c", "precipitacao_mm", "pressao_mb", "umidade_pct", "ano", "mes"
    )
    return fact.join(dim, "estacao_codigo")


@query("stations_with_most_rain_gold")
def gold_top_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k over the written fact and station dimension."""
    root = _written_gold(spark, sf_dir)
    return stations_with_most_rain(
        read_gold_table(spark, root, FACT), read_gold_table(spark, root, "dim_estacao"), 1998, 1, 10
    )


@query("write_fact")
def refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold built once and then refreshed for two of its years: the months, their rows and what they add up to."""

    def build(path: str) -> None:
        for years in (None, [1996, 1998]):
            silver_to_gold(spark, _written_silver(spark, sf_dir), path, years)

    gold = _once(spark, sf_dir, "refreshed-gold", build)
    rain = F.sum(F.col("precipitacao_mm").cast("decimal(18,2)")).cast("double").alias("chuva")
    return read_gold_fact(spark, gold).groupBy("ano", "mes").agg(F.count(F.lit(1)).alias("linhas"), rain)


@query("staging_views")
def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with named arguments over the views of the written tables."""
    dim, fact = staging_views(spark, _written_gold(spark, sf_dir))
    return spark.sql(
        f"""
        select uf, ano, count(*) as leituras, max(temperatura_c) as maxima
        from {fact} join {dim} using (estacao_codigo) where ano >= :ano group by uf, ano
        """,
        args={"ano": 1992},
    )


@query("append_run_log")
def logged_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's record of a Gold job."""
    log = read_run_log(spark, _log(spark, sf_dir)).where("status = 'sucesso'")
    return log.select("etapa", "ano", "status", "linhas", "erro", *_timed())


@query("run_stage_failure")
def logged_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's record of a Gold job for a year that Silver does not hold."""
    log = read_run_log(spark, _log(spark, sf_dir)).where("status = 'falha'")
    return log.select("etapa", "ano", "status", "linhas", F.col("erro").isNotNull().alias("com_erro"), *_timed())


def _timed() -> list[Column]:
    seconds = F.col("fim").cast("double") - F.col("inicio").cast("double")
    return [
        (F.col("duracao_s") >= 0).alias("duracao_positiva"),
        (F.abs(seconds - F.col("duracao_s")) < 0.001).alias("duracao_confere"),
    ]


@query("read_gold_temperature")
def gold_temperature_by_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written monthly means of temperature.

    Rounded, since sums of doubles depend on their order, and shifted a little so that none lies on a tie.
    """
    table = read_gold_table(spark, _written_gold(spark, sf_dir), TEMPERATURE_BY_UF)
    return table.withColumn("temperatura_media_c", F.round(F.col("temperatura_media_c") + 1e-6, 4))


@query("read_gold_dates")
def gold_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written date dimension."""
    return read_gold_table(spark, _written_gold(spark, sf_dir), DIM_DATE)


@query("read_gold_stations")
def gold_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written station dimension."""
    table = read_gold_table(spark, _written_gold(spark, sf_dir), DIM_STATION)
    return table.select("estacao_codigo", "estacao_nome", "uf", "regiao", "altitude")


@query("check_gold")
def gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the written Gold tables, of which positions are missing by design here."""
    root = _written_gold(spark, sf_dir)
    reports = [
        quality_report(read_gold_table(spark, root, name), rules, name) for name, rules in GOLD_RULES.items()
    ]
    report = reduce(DataFrame.unionByName, reports)
    return report.select("table", "column", F.col("check").alias("chk"), "severity", "failures", "passed")

"""The SQL of each parity query, for any engine that reads the same tables."""

from __future__ import annotations

_STATIONS = """
    select s_suppkey, s_name as nome, n_name as uf, r_name as regiao, s_acctbal as altitude
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

_DATED = """
    cast(year(l_shipdate) as int) as ano, cast(month(l_shipdate) as int) as mes
"""


def _monthly(key: str, measure: str, where: str = "true") -> str:
    return f"""
        select {key}, {_DATED},
               cast(sum(cast({measure} as decimal(18,2))) as double) / count({measure}) as media
        from lineitem join ({_STATIONS}) s on l_suppkey = s_suppkey
        where {where}
        group by 1, 2, 3
    """


# The line items as station files: one reading per supplier, year and time, the least one surviving.
_SILVER = f"""
    select cast(l_suppkey as varchar) as estacao_codigo, nome as estacao_nome, uf, regiao, altitude,
           datetime, cast(year(l_shipdate) as int) as ano,
           l_quantity as precipitacao_mm, l_discount as pressao_mb,
           l_extendedprice as temperatura_c, l_tax as umidade_pct
    from (
        select *, row_number() over (
            partition by l_suppkey, datetime order by l_quantity, l_discount, l_extendedprice, l_tax
        ) as rn
        from (select *, l_shipdate + l_linenumber * interval 1 hour as datetime from lineitem) t
    ) r join ({_STATIONS}) s on l_suppkey = s_suppkey
    where rn = 1
"""

# The same as files hold them, where some discounts are no numbers: of equal times the row with most values survives.
_LINES = f"""
    select cast(l_suppkey as varchar) as estacao_codigo, nome as estacao_nome, uf, regiao, altitude,
           l_shipdate + l_linenumber * interval 1 hour as datetime, cast(year(l_shipdate) as int) as ano,
           l_quantity as precipitacao_mm, case when bad then null else l_discount end as pressao_mb,
           l_extendedprice as temperatura_c, l_tax as umidade_pct, l_orderkey as pedido,
           cast(bad as int) as invalid_numbers, cast(0 as int) as invalid_times
    from (select *, l_linenumber = 4 and l_partkey % 5 = 0 as bad from lineitem) t join ({_STATIONS}) s on l_suppkey = s_suppkey
"""
_SILVER_OF_FILES = f"""
    select * from ({_LINES}) l
    qualify row_number() over (
        partition by estacao_codigo, datetime
        order by invalid_numbers, precipitacao_mm, pressao_mb, temperatura_c, umidade_pct, '{{"Pedido":"' || pedido || '"}}') = 1
"""

_REPORT = """
    select 'unique' as chk, 'error' as severity,
           (select count(*) from (
                select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) a) as failures
    union all
    select 'not_null', 'error', (select count(*) from lineitem where l_suppkey is null)
    union all
    select 'accepted_range', 'warn',
           (select count(*) from lineitem where not (l_quantity >= 5 and l_quantity <= 45))
"""

ORACLE: dict[str, str] = {
    "parse_decimal": """
        select s_suppkey, case when s_suppkey % 10 in (0, 1, 2) then null else s_acctbal end as v
        from supplier
    """,
    "parse_utc_timestamp": "select event_id, date_trunc('minute', ts) as t from events",
    "parse_utc_timestamp_permissive": """
        select event_id, case when event_id % 5 = 0 then null else date_trunc('minute', ts) end as t
        from events
    """,
    "read_file_metadata": _STATIONS,
    "read_line_metadata": _STATIONS,
    "attach_metadata": f"""
        select l_orderkey, l_linenumber, l_suppkey, l_quantity, nome, uf, regiao
        from lineitem left join ({_STATIONS}) s on l_suppkey = s_suppkey
    """,
    "bind_columns_by_name": """
        select s_suppkey, s_acctbal as a, cast(s_nationkey as double) as b, cast(null as double) as c
        from supplier
    """,
    "dedup_readings": """
        select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_shipdate
        from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount,
                         l_tax, l_returnflag, l_linestatus
            ) as rn
            from lineitem
        ) z
        where rn = 1
    """,
    "union_by_name": """
        select event_id, user_id, value from events where event_type = 'click'
        union all
        select event_id, user_id, cast(null as double) as value from events
        where event_type is distinct from 'click'
    """,
    "available_years": "select distinct cast(year(l_shipdate) as int) as ano from lineitem",
    "pending_years": """
        select cast(y as int) as ano from (select unnest(range(1990, 2011)) as y) r
        where y not in (select year(l_shipdate) from lineitem)
    """,
    "read_years": """
        select cast(year(l_shipdate) as int) as ano, count(*) as n from lineitem
        where year(l_shipdate) in (1996, 1998) group by 1
    """,
    "dim_station": f"""
        select * from ({_STATIONS}) s where s_suppkey in (select l_suppkey from lineitem)
    """,
    "dim_date": """
        select data, cast(year(data) as int) as ano, cast(month(data) as int) as mes,
               cast(day(data) as int) as dia, cast(quarter(data) as int) as trimestre,
               case when month(data) in (12, 1, 2) then 'verao'
                    when month(data) in (3, 4, 5) then 'outono'
                    when month(data) in (6, 7, 8) then 'inverno'
                    else 'primavera' end as estacao_do_ano
        from (select distinct cast(l_shipdate as date) as data from lineitem) z
    """,
    "project_fact": f"""
        select cast(l_shipdate as date) as data, {_DATED}, l_shipdate, l_suppkey, l_quantity,
               l_extendedprice
        from lineitem
    """,
    "monthly_rain_by_region": _monthly("regiao", "l_quantity"),
    "monthly_temp_by_uf": _monthly("uf", "l_extendedprice"),
    "mean_temperature_by_uf": f"""
        select uf, ano, mes, round(media, 2) as media from ({_monthly("uf", "l_extendedprice")}) m
        where uf = upper('nation_3') and ano = 1998 and mes = 1
    """,
    "mean_rain_by_region": f"""
        select regiao, ano, mes, round(media, 4) as media from ({_monthly("regiao", "l_quantity")}) m
        where regiao = upper('asia') and ano = 1998 and mes = 1
    """,
    "stations_with_most_rain": f"""
        select l_suppkey, nome, uf, round(sum(l_quantity), 1) as total
        from lineitem join ({_STATIONS}) s on l_suppkey = s_suppkey
        where year(l_shipdate) = 1998 and month(l_shipdate) = 1
        group by 1, 2, 3 order by total desc, l_suppkey limit 5
    """,
    "check_unique": """
        select count(*) as failures from (
            select l_orderkey, l_linenumber from lineitem
            where l_orderkey is not null and l_linenumber is not null
            group by 1, 2 having count(*) > 1) z
    """,
    "check_not_null": """
        select count(*) as failures from supplier left join nation on s_nationkey = n_nationkey
        left join (select * from region where r_name = 'ASIA') r on n_regionkey = r_regionkey
        where r_name is null
    """,
    "check_accepted_range": """
        select count(*) as failures from lineitem where not (l_quantity >= 5 and l_quantity <= 45)
    """,
    "quality_report": f"select *, failures = 0 as passed from ({_REPORT}) r",
    "row_counts": """
        select 'dim_station' as tabela, count(distinct l_suppkey) as linhas from lineitem
        union all select 'dim_date', count(distinct cast(l_shipdate as date)) from lineitem
        union all select 'fact', count(*) from lineitem
    """,
    "row_counts_tables": """
        select 'dim_station' as tabela, count(distinct l_suppkey) as linhas from lineitem
        union all select 'dim_date', count(distinct cast(l_shipdate as date)) from lineitem
        union all select 'fact', count(*) from lineitem
    """,
    "run_summary": """
        select event_type as etapa, case when user_id % 7 = 0 then 'falha' else 'sucesso' end as status,
               count(*) as runs, cast(sum(event_id) as bigint) as linhas, max(ts) as fim,
               cast(sum(event_id) as double) / count(*) as duracao_media_s
        from events group by 1, 2
    """,
    "scan_station_files": _LINES,
    "bronze_to_silver": f"""
        select * exclude (invalid_numbers, invalid_times), cast(null as double) as vento_direcao_gr
        from ({_SILVER_OF_FILES}) s
    """,
    "bronze_to_silver_counts": f"""
        select ano, s.linhas, cast(invalid_numbers as bigint) as invalid_numbers, cast(0 as bigint) as invalid_times,
               'transformacao_silver' as etapa, 'sucesso' as status, s.linhas as no_log
        from (select ano, sum(invalid_numbers) as invalid_numbers from ({_LINES}) l group by 1) l
        join (select ano, count(*) as linhas from ({_SILVER_OF_FILES}) f group by 1) s using (ano)
    """,
    "read_silver": f"""
        select estacao_codigo, uf, datetime, ano, precipitacao_mm, pressao_mb, temperatura_c, umidade_pct
        from ({_SILVER}) s where ano in (1996, 1998)
    """,
    "read_gold_fact": f"""
        select cast(datetime as date) as data, datetime, estacao_codigo, temperatura_c, precipitacao_mm,
               cast(year(datetime) as int) as ano, cast(month(datetime) as int) as mes
        from ({_SILVER}) s where year(datetime) = 1998 and month(datetime) = 1
    """,
    "read_gold_table": f"""
        select regiao, cast(year(datetime) as int) as ano, cast(month(datetime) as int) as mes,
               avg(precipitacao_mm) as precipitacao_media_mm
        from ({_SILVER}) s group by 1, 2, 3
    """,
    "silver_to_gold": f"""
        select cast(datetime as date) as data, datetime, estacao_codigo, temperatura_c, precipitacao_mm, pressao_mb,
               umidade_pct, cast(year(datetime) as int) as ano, cast(month(datetime) as int) as mes, estacao_nome, uf, regiao
        from ({_SILVER}) s
    """,
    "stations_with_most_rain_gold": f"""
        select estacao_codigo, estacao_nome, uf, round(sum(precipitacao_mm), 1) as chuva_total_mm
        from ({_SILVER}) s where year(datetime) = 1998 and month(datetime) = 1
        group by 1, 2, 3 order by chuva_total_mm desc, estacao_codigo limit 10
    """,
    "write_fact": f"""
        select cast(year(datetime) as int) as ano, cast(month(datetime) as int) as mes, count(*) as linhas,
               cast(sum(cast(precipitacao_mm as decimal(18,2))) as double) as chuva
        from ({_SILVER}) s group by 1, 2
    """,
    "staging_views": f"""
        select uf, cast(year(datetime) as int) as ano, count(*) as leituras, max(temperatura_c) as maxima
        from ({_SILVER}) s group by 1, 2
    """,
    "append_run_log": f"""
        select 'modelagem_gold' as etapa, min(ano) || '-' || max(ano) as ano, 'sucesso' as status,
               count(*) as linhas, cast(null as varchar) as erro, true as duracao_positiva,
               true as duracao_confere
        from ({_SILVER}) s
    """,
    "run_stage_failure": f"""
        select 'modelagem_gold' as etapa, '1900' as ano, 'falha' as status,
               count(*) filter (where ano = 1900) as linhas, true as com_erro, true as duracao_positiva,
               true as duracao_confere
        from ({_SILVER}) s
    """,
    "read_gold_temperature": f"""
        select uf, cast(year(datetime) as int) as ano, cast(month(datetime) as int) as mes,
               round(avg(temperatura_c) + 1e-6, 4) as temperatura_media_c
        from ({_SILVER}) s group by 1, 2, 3
    """,
    "read_gold_dates": f"""
        select data, cast(year(data) as int) as ano, cast(month(data) as int) as mes,
               cast(day(data) as int) as dia, cast(quarter(data) as int) as trimestre,
               case when month(data) in (12, 1, 2) then 'verao'
                    when month(data) in (3, 4, 5) then 'outono'
                    when month(data) in (6, 7, 8) then 'inverno'
                    else 'primavera' end as estacao_do_ano
        from (select distinct cast(datetime as date) as data from ({_SILVER}) s) z
    """,
    "read_gold_stations": f"select distinct estacao_codigo, estacao_nome, uf, regiao, altitude from ({_SILVER}) s",
    "check_gold": f"""
        with s as ({_SILVER}), n as (select count(distinct estacao_codigo) as stations from s),
        r as (
            select 'dim_estacao' as "table", 'estacao_codigo' as "column", 'unique' as chk, 'error' as severity,
                   cast(0 as bigint) as failures
            union all select 'dim_estacao', 'estacao_codigo', 'not_null', 'error', 0
            union all select 'dim_estacao', 'latitude', 'not_null', 'error', stations from n
            union all select 'dim_estacao', 'longitude', 'not_null', 'error', stations from n
            union all select 'fato_leitura_climatica', 'estacao_codigo', 'not_null', 'error',
                             (select count(*) from s where estacao_codigo is null)
            union all select 'fato_leitura_climatica', 'datetime', 'not_null', 'error',
                             (select count(*) from s where datetime is null)
            union all select 'fato_leitura_climatica', 'temperatura_c', 'accepted_range', 'warn',
                             (select count(*) from s where temperatura_c < -20 or temperatura_c > 55))
        select *, failures = 0 as passed from r
    """,
}

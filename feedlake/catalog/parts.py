"""Parts of the SQL twins: the feeds and what is derived from them, as named subqueries."""

from __future__ import annotations

PANEL_RAW = """panel_raw as (
  select cast(l_suppkey % 20 as varchar) as dep,
    case l_returnflag when 'A' then '0' when 'R' then '1' else '2' end as sexe,
    cast(cast(l_shipdate as date) as varchar) as jour,
    case when l_linenumber = 7 and l_quantity > 45 then 'n/a'
      else cast(l_quantity as varchar) end as hosp,
    case when l_linenumber = 7 then '' else cast(l_linenumber as varchar) end as rea,
    cast(l_partkey % 100 as varchar) as rad,
    case when l_linenumber = 7 then 'x' else cast(l_orderkey % 10 as varchar) end as dc
  from lineitem)"""

PANEL_TYPED = """panel_typed as (
  select dep as department_code,
    case sexe when '0' then 'ALL' when '1' then 'M' when '2' then 'F' else sexe end as sex,
    try_cast(regexp_split_to_array(jour, '[T ]')[1] as date) as date,
    cast(trunc(try_cast(hosp as double)) as integer) as hospitalizations,
    cast(trunc(try_cast(rea as double)) as integer) as icu_patients,
    cast(trunc(try_cast(rad as double)) as integer) as returned_home,
    cast(trunc(try_cast(dc as double)) as integer) as deaths,
    'PANEL' as country
  from panel_raw)"""

PANEL_FORMAT = """panel_format as (
  select * from panel_typed
  where hospitalizations is not null or icu_patients is not null or deaths is not null)"""


def _panel_sums(name: str, condition: str, rows: str = "panel_format") -> str:
    return f"""{name} as (
  select date, country,
    cast(sum(hospitalizations) as bigint) as total_hospitalizations,
    cast(sum(icu_patients) as bigint) as total_icu,
    cast(sum(deaths) as bigint) as total_deaths,
    cast(sum(returned_home) as bigint) as total_recovered,
    count(distinct department_code) as regions_count
  from {rows} where date is not null and {condition}
  group by date, country)"""


PANEL_DAILY = _panel_sums("panel_daily", "sex in ('ALL', '0')")
PANEL_DAILY_ALL = _panel_sums("panel_daily_all", "true", "panel_typed")

LINELIST_RAW = """linelist_raw as (
  select case when o_orderkey % 97 = 0 then 'unknown'
      when o_orderkey % 2 = 0
        then concat(cast(cast(o_orderdate as date) as varchar), ' 00:00:00')
      else concat(cast(cast(o_orderdate as date) as varchar), 'T00:00:00.000')
      end as fecha_reporte_web,
    cast(o_orderkey as varchar) as id_de_caso,
    cast(n_nationkey as varchar) as departamento,
    n_name as departamento_nom,
    case when o_orderkey % 89 = 0 then 'N/A' else cast(o_orderkey % 130 as varchar) end as edad,
    case when o_custkey % 2 = 0 then ' m ' else 'F' end as sexo,
    case when o_orderstatus = 'F' then 'Fallecido' when o_orderstatus = 'O' then 'Activo'
      when o_custkey % 5 = 0 then 'N/A' when o_custkey % 7 = 0 then 'Leve'
      else 'Recuperado' end as estado
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

LINELIST_TYPED = """linelist_typed as (
  select try_cast(regexp_split_to_array(fecha_reporte_web, '[T ]')[1] as date) as report_date,
    id_de_caso as case_id,
    departamento as department_code,
    departamento_nom as department_name,
    cast(trunc(try_cast(edad as double)) as integer) as age,
    upper(trim(sexo)) as sex,
    case estado when 'Recuperado' then 'RECOVERED' when 'Fallecido' then 'DECEASED'
      when 'Activo' then 'ACTIVE' when 'N/A' then 'UNKNOWN' else estado end as status,
    'LINELIST' as country
  from linelist_raw)"""

LINELIST_FORMAT = """linelist_format as (
  select * from linelist_typed where report_date is not null)"""

LINELIST_DAILY = """linelist_daily as (
  select report_date as date, country,
    count(*) as total_cases,
    count(*) filter (where status = 'DECEASED') as total_deaths,
    count(*) filter (where status = 'RECOVERED') as total_recovered,
    count(*) filter (where status = 'ACTIVE') as active_cases,
    count(distinct department_name) as regions_count,
    avg(age) as avg_age
  from linelist_format group by report_date, country)"""

COMBINE_DAILY = """combine_daily as (
  select *,
    case when total_cases > 0 then round(total_deaths / total_cases * 100, 2) end
      as mortality_rate,
    case when total_cases > 0 then round(total_recovered / total_cases * 100, 2) end
      as recovery_rate
  from (
    select date, country, cast(null as bigint) as total_cases, total_hospitalizations,
      total_icu, total_deaths, total_recovered, cast(null as bigint) as active_cases,
      regions_count, cast(null as double) as avg_age
    from panel_daily
    union all
    select date, country, total_cases, null, null, total_deaths, total_recovered,
      active_cases, regions_count, avg_age
    from linelist_daily))"""

TREND_FEATURES = """trend_features as (
  select date, cast(day_number as integer) as day_number, label from (
    select date, date_diff('day', min(date) over (), date) as day_number,
      cast(total_hospitalizations as double) as label
    from panel_daily)
  where label is not null)"""

TREND_FIT = """trend_fit as (
  select regr_slope(label, day_number) as slope, regr_intercept(label, day_number) as intercept
  from trend_features where day_number % 5 <> 0)"""

PANEL = [PANEL_RAW, PANEL_TYPED, PANEL_FORMAT]
LINELIST = [LINELIST_RAW, LINELIST_TYPED, LINELIST_FORMAT]
COMBINED = [*PANEL, PANEL_DAILY, *LINELIST, LINELIST_DAILY, COMBINE_DAILY]
TREND = [*PANEL, PANEL_DAILY, TREND_FEATURES]
FITTED = [*TREND, TREND_FIT]


def with_parts(parts: list[str], final: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + final


COMBINED_ROWS = with_parts(COMBINED, "select * from combine_daily")

"""SQL twins of the queries over repeated, partial and broken deliveries."""

from __future__ import annotations

from feedlake.catalog.parts import (
    COMBINED,
    COMBINED_ROWS,
    LINELIST,
    LINELIST_RAW,
    PANEL,
    PANEL_RAW,
    PANEL_TYPED,
    with_parts,
)

MONTH_DAYS = with_parts(
    COMBINED,
    """select cast(year(date) as integer) as year, cast(month(date) as integer) as month,
  count(*) as days
from combine_daily group by 1, 2""",
)

SOUND = "rad not in ('7', '8', '9', '10')"
LINE = "concat_ws(';', dep, sexe, jour, hosp, rea, rad, dc)"

LARGE = """large as (
  select * replace (total_deaths * 100000000 as total_deaths) from combine_daily)"""
REFUSED = "total_deaths > 2147483647"

CLEANED = [
    LINELIST_RAW,
    """twice as (
  select * from linelist_raw
  union all
  select * from linelist_raw where cast(id_de_caso as bigint) % 10 = 0)""",
    """typed as (
  select try_cast(regexp_split_to_array(fecha_reporte_web, '[T ]')[1] as date) as report_date,
    id_de_caso as case_id, departamento as department_code,
    departamento_nom as department_name,
    cast(trunc(try_cast(edad as double)) as integer) as age,
    upper(trim(sexo)) as sex,
    case estado when 'Recuperado' then 'RECOVERED' when 'Fallecido' then 'DECEASED'
      when 'Activo' then 'ACTIVE' when 'N/A' then 'UNKNOWN' else estado end as status,
    'LINELIST' as country
  from twice)""",
    "formatted as (select * from typed where report_date is not null)",
    "ranged as (select * from formatted where age is null or age between 0 and 120)",
    "present as (select * from ranged where age is not null and status is not null)",
    "cleaned as (select distinct * from present)",
]


def _types() -> str:
    kinds = {
        "key": "int", "wide": "bigint", "real": "double", "day": "date", "moment": "timestamp",
        "truth": "boolean", "mixed": "string", "gaps": "int", "empty": "string",
    }
    present = {"gaps": "count(*) filter (where o_orderkey % 3 <> 0)", "empty": "count(*) filter (where false)"}
    return " union all ".join(
        f"select '{column}' as \"column\", '{kind}' as type, "
        f"{present.get(column, 'count(*)')} as present from orders"
        for column, kind in kinds.items()
    )


def _regions(rows: str, day: str, region: str) -> str:
    return f"""select cast(date_trunc('month', {day}) as date) as month, country,
    count(distinct {region}) as regions
  from {rows} where {day} is not null group by 1, 2
  union all
  select null, country, count(distinct {region}) from {rows} where {day} is not null
  group by country"""


DELIVERY_TWINS = {
    "append_batches": MONTH_DAYS,
    "append_ledger": with_parts(
        COMBINED,
        """select case when year(date) <= 1997 then 'early' else 'late' end as batch,
  count(*) as rows
from combine_daily group by 1""",
    ),
    "daily_refresh": COMBINED_ROWS,
    "refresh_months": with_parts(
        COMBINED,
        """select strftime(date, '%Y-%m') as month, count(*) as days
from combine_daily where strftime(date, '%Y-%m') in ('1996-03', '1997-07') group by 1""",
    ),
    "regions_by_month": with_parts(
        [*PANEL, *LINELIST, "total as (select * from panel_format where sex in ('ALL', '0'))"],
        f"""select month, country, regions, true as within_error from (
  {_regions("total", "date", "department_code")}
  union all
  {_regions("linelist_format", "report_date", "department_name")})""",
    ),
    "source_cap_ties": """select event_id, event_type from events
order by event_type nulls first, event_id nulls first limit 700""",
    "source_cap_ranges": """select cast(l_shipdate as date) as l_shipdate, l_orderkey,
  l_linenumber
from lineitem order by l_shipdate nulls first, l_orderkey, l_linenumber limit 4000""",
    "quarantine_rows": with_parts(
        [
            PANEL_RAW.replace("panel_raw as (", "all_rows as ("),
            f"""panel_raw as (
  select * replace (case when rad = '11' then '1;1' else dep end as dep)
  from all_rows where {SOUND})""",
            *[part for part in PANEL if part != PANEL_RAW],
        ],
        """select department_code, sex, date, hospitalizations, icu_patients, returned_home, deaths,
  country from panel_format""",
    ),
    "quarantine_lines": with_parts(
        [PANEL_RAW],
        f"""select line, reason, count(*) as n from (
  select case rad when '7' then {LINE} || ';more'
      when '8' then concat_ws(';', dep, sexe, jour, hosp, rea)
      when '9' then '"' || {LINE}
      else concat_ws(';', dep, sexe, jour, hosp, rea, rad, '"open') end as line,
    case rad when '7' then 'surplus cells' when '8' then 'missing cells'
      else 'unclosed quote' end as reason
  from panel_raw where not ({SOUND}))
group by line, reason""",
    ),
    "rejected_documents": with_parts(
        [*COMBINED, LARGE],
        f"""select country, cast(date as varchar) as date,
  'total_deaths is no 32-bit integer' as problems
from large where {REFUSED}""",
    ),
    "accepted_documents": with_parts(
        [*COMBINED, LARGE],
        f"""select country, count(*) filter (where not coalesce({REFUSED}, false)) as written,
  count(*) filter (where {REFUSED}) as rejected
from large group by country""",
    ),
    "sink_fingerprint": with_parts(
        COMBINED,
        """select country, count(*) as rows_source, count(*) as rows_target, true as ok,
  country <> 'PANEL' as values_equal
from combine_daily group by country""",
    ),
    "inferred_types": _types(),
    "inferred_rows": """select cast(o_orderkey as integer) as key,
  o_orderkey + 5000000000 as wide, o_orderkey / 4 as real, cast(o_orderdate as date) as day,
  o_orderkey % 2 = 0 as truth,
  case when o_orderkey % 50 = 0 then 'n/a' else cast(o_orderkey as varchar) end as mixed,
  case when o_orderkey % 3 <> 0 then cast(o_orderkey as integer) end as gaps
from orders""",
    "cleaned_rows": with_parts(CLEANED, "select * from cleaned"),
    "cleaning_counts": with_parts(
        CLEANED,
        """select 'rows_in' as rule, count(*) as rows from twice
union all select 'rows_out', count(*) from cleaned
union all select 'out_of_range_age',
  (select count(*) from formatted) - (select count(*) from ranged)
union all select 'null', (select count(*) from ranged) - (select count(*) from present)
union all select 'duplicates',
  (select count(*) from present) - (select count(*) from cleaned)""",
    ),
    "inputs_exist": with_parts(
        [PANEL_RAW],
        """select 'raw panel' as input, count(*) > 0 as present, count(*) > 0 as has_data
from panel_raw
union all select 'raw line list', false, false
union all select 'formatted panel', false, false""",
    ),
}

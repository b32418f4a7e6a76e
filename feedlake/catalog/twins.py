"""SQL twins of the registered queries, for an independent engine on the same tables.

Written against the meaning of each operator, not generated from its plan.
"""

from __future__ import annotations

import json

from feedlake.catalog.delivery_twins import DELIVERY_TWINS
from feedlake.catalog.parts import (
    COMBINED,
    COMBINED_ROWS,
    FITTED,
    LINELIST,
    LINELIST_DAILY,
    LINELIST_RAW,
    LINELIST_TYPED,
    PANEL,
    PANEL_DAILY,
    PANEL_DAILY_ALL,
    PANEL_RAW,
    PANEL_TYPED,
    TREND,
    with_parts,
)
from feedlake.sinks import index_mapping

PANEL_FORMAT_ROWS = with_parts(
    PANEL,
    """select department_code, sex, date, hospitalizations, icu_patients, returned_home, deaths,
  country from panel_format""",
)
LINELIST_FORMAT_ROWS = with_parts(LINELIST, "select * from linelist_format")

SUMMARY_ROWS = with_parts(
    COMBINED,
    """select country, min(date) as first_date, max(date) as last_date, count(*) as total_days,
  cast(sum(total_cases) as bigint) as cumulative_cases,
  cast(sum(total_deaths) as bigint) as cumulative_deaths,
  cast(sum(total_recovered) as bigint) as cumulative_recovered,
  max(total_hospitalizations) as peak_hospitalizations,
  max(total_icu) as peak_icu,
  cast(sum(cast(mortality_rate as decimal(18, 2))) as double) / count(mortality_rate)
    as avg_mortality_rate,
  cast(sum(cast(recovery_rate as decimal(18, 2))) as double) / count(recovery_rate)
    as avg_recovery_rate,
  arg_max_null(total_deaths, date) as latest_deaths,
  arg_max_null(total_recovered, date) as latest_recovered,
  case when sum(total_cases) > 0
    then round(cast(sum(total_deaths) as bigint) / cast(sum(total_cases) as bigint) * 100, 2)
    end as overall_mortality_rate
from combine_daily group by country""",
)


def _document(absent: str | None = None) -> str:
    def cell(column: str) -> str:
        return f"'{column}', " + (f"coalesce({column}, {absent})" if absent else column)

    measures = (
        "total_cases",
        "total_hospitalizations",
        "total_icu",
        "total_deaths",
        "total_recovered",
        "active_cases",
        "regions_count",
        "avg_age",
        "mortality_rate",
        "recovery_rate",
    )
    cells = ["'date', cast(date as varchar)", "'country', country", *map(cell, measures)]
    return f"cast(json_object({', '.join(cells)}) as varchar)"


COMBINED_ZERO = [*PANEL, PANEL_DAILY_ALL, *LINELIST, LINELIST_DAILY]
ZERO_ROWS = """select strftime(date, '%Y-%m-%d') as date, country, cast(0 as bigint) as total_cases,
  coalesce(total_hospitalizations, 0) as total_hospitalizations,
  coalesce(total_icu, 0) as total_icu, coalesce(total_deaths, 0) as total_deaths,
  coalesce(total_recovered, 0) as total_recovered, regions_count,
  cast(0 as double) as avg_age
from panel_daily_all
union all
select strftime(date, '%Y-%m-%d'), country, total_cases, 0, 0, total_deaths, total_recovered,
  regions_count, avg_age
from linelist_daily"""


def _stage_rows() -> str:
    counts = {
        "land_panel": "select count(*) from panel_raw",
        "land_linelist": "select count(*) from linelist_raw",
        "format_panel": "select count(*) from panel_format",
        "format_linelist": "select count(*) from linelist_format",
        "combine": "select count(*) from combine_daily",
        "model_trend": "select cast(null as bigint)",
        "index": "select count(*) from combine_daily",
    }
    return " union all ".join(
        f"select cast({k} as integer) as position, '{stage}' as stage, true as ok, "
        f"({count}) as counted"
        for k, (stage, count) in enumerate(counts.items())
    )


def _header_rows() -> str:
    outcomes = (
        ("panel", "accepted", "panel_raw"),
        ("panel without rea", "panel lacks the columns rea", "panel_raw"),
        ("cases", "accepted", "linelist_raw"),
        ("cases without dates", "linelist has no date column", "linelist_raw"),
        ("cases without places", "linelist has no location column", "linelist_raw"),
    )
    return " union all ".join(
        f"select '{feed}' as feed, '{outcome}' as outcome, true as as_expected, "
        f"count(*) as rows from {rows}"
        for feed, outcome, rows in outcomes
    )


CASE_COLUMNS = {
    "report_date": "date",
    "case_id": "string",
    "department_code": "string",
    "department_name": "string",
    "age": "int",
    "sex": "string",
    "status": "string",
    "country": "string",
}
ZERO_DOCUMENT = """cast(json_object('date', date, 'country', country,
  'total_cases', cast(total_cases as double),
  'total_hospitalizations', cast(total_hospitalizations as double),
  'total_icu', cast(total_icu as double), 'total_deaths', cast(total_deaths as double),
  'total_recovered', cast(total_recovered as double), 'regions_count', regions_count,
  'avg_age', coalesce(avg_age, 0)) as varchar)"""

TWINS = {
    "panel_format": PANEL_FORMAT_ROWS,
    "linelist_format": LINELIST_FORMAT_ROWS,
    "panel_daily": with_parts([*PANEL, PANEL_DAILY], "select * from panel_daily"),
    "panel_daily_all": with_parts([*PANEL, PANEL_DAILY_ALL], "select * from panel_daily_all"),
    "panel_daily_brief": with_parts(
        PANEL,
        """select date, country,
  cast(sum(hospitalizations) as bigint) as total_hospitalizations,
  cast(sum(icu_patients) as bigint) as total_icu,
  cast(sum(deaths) as bigint) as total_deaths
from panel_format where sex = 'ALL' and date is not null group by date, country""",
    ),
    "linelist_daily": with_parts([*LINELIST, LINELIST_DAILY], "select * from linelist_daily"),
    "linelist_daily_join": with_parts(
        LINELIST,
        """select t.date, t.total_cases, r.regions_count, a.avg_age,
  coalesce(d.n, 0) as total_deaths, coalesce(c.n, 0) as total_recovered
from (select report_date as date, count(*) as total_cases
    from linelist_format group by report_date) t
join (select report_date as date, count(distinct department_name) as regions_count
    from linelist_format group by report_date) r on t.date = r.date
join (select report_date as date, avg(age) as avg_age
    from linelist_format group by report_date) a on t.date = a.date
left join (select report_date as date, count(*) as n
    from linelist_format where status = 'DECEASED' group by report_date) d on t.date = d.date
left join (select report_date as date, count(*) as n
    from linelist_format where status = 'RECOVERED' group by report_date) c
  on t.date = c.date""",
    ),
    "combine_daily": COMBINED_ROWS,
    "combine_rates": with_parts(
        COMBINED,
        """select date, country, mortality_rate, recovery_rate,
  case when total_cases > 0 then round(total_hospitalizations / total_cases * 100, 2) end
    as hospitalization_rate,
  case when total_hospitalizations > 0
    then round(total_icu / total_hospitalizations * 100, 2) end as icu_rate
from combine_daily""",
    ),
    "combine_daily_zero": with_parts(COMBINED_ZERO, ZERO_ROWS),
    "summary_stats": SUMMARY_ROWS,
    "country_stats": with_parts(
        COMBINED,
        """select country, count(*) as records,
  round(count(*) * 100.0::double / sum(count(*)) over (), 2) as share_pct,
  min(date) as first_date, max(date) as last_date,
  max(total_hospitalizations) as max_hospitalizations,
  cast(median(total_hospitalizations) as double) as median_hospitalizations,
  max(total_icu) as max_icu,
  cast(median(total_deaths) as double) as median_deaths
from combine_daily group by country""",
    ),
    "monthly_totals": with_parts(
        COMBINED,
        """select country, cast(date_trunc('month', date) as date) as month,
  cast(sum(total_hospitalizations) as bigint) as total_hospitalizations,
  cast(sum(total_deaths) as bigint) as total_deaths,
  cast(sum(total_icu) as bigint) as total_icu,
  cast(sum(total_recovered) as bigint) as total_recovered
from combine_daily group by 1, 2""",
    ),
    "series_by_country": with_parts(
        COMBINED,
        """select date,
  cast(sum(total_deaths) filter (where country = 'PANEL') as bigint) as panel_deaths,
  cast(sum(total_deaths) filter (where country = 'LINELIST') as bigint) as linelist_deaths,
  cast(sum(total_cases) filter (where country = 'PANEL') as bigint) as panel_cases,
  cast(sum(total_cases) filter (where country = 'LINELIST') as bigint) as linelist_cases
from combine_daily group by date""",
    ),
    "current_stats": with_parts(
        COMBINED,
        """select country, date, total_hospitalizations, total_icu, total_deaths
from combine_daily c
where date = (select max(date) from combine_daily m where m.country = c.country)""",
    ),
    "region_totals": with_parts(
        LINELIST,
        """select department_name, count(*) as total_cases,
  count(*) filter (where status = 'DECEASED') as total_deaths
from linelist_format group by department_name""",
    ),
    "daily_sample": with_parts(
        COMBINED,
        "select date, country, total_deaths from combine_daily order by date, country limit 10",
    ),
    "quality_report": with_parts(
        [PANEL_RAW, PANEL_TYPED, LINELIST_RAW, LINELIST_TYPED],
        """select feed, rows_in, rows_out, rows_in - rows_out as rows_dropped, null_keys,
  rows_out = 0 as is_empty
from (
  select 'panel' as feed, count(*) as rows_in,
    count(*) filter (where hospitalizations is not null or icu_patients is not null
      or deaths is not null) as rows_out,
    count(*) filter (where department_code is null or sex is null or date is null)
      as null_keys
  from panel_typed
  union all
  select 'linelist', count(*), count(*) filter (where report_date is not null),
    count(*) filter (where report_date is null)
  from linelist_typed)""",
    ),
    "null_counts": with_parts(
        LINELIST,
        """select count(*) filter (where report_date is null) as report_date,
  count(*) filter (where case_id is null) as case_id,
  count(*) filter (where age is null) as age
from linelist_format""",
    ),
    "dedupe_rows": """select distinct o_orderkey, o_custkey, o_orderstatus from (
  select * from orders union all select * from orders where o_orderkey % 10 = 0)""",
    "range_filter": with_parts(
        LINELIST,
        "select case_id, age from linelist_format where age between 0 and 120 or age is null",
    ),
    "null_fill": with_parts(
        LINELIST,
        """select case_id, coalesce(age, 0) as age, coalesce(status, 'UNKNOWN') as status
from linelist_format""",
    ),
    "null_drop": with_parts(
        LINELIST,
        "select case_id, age from linelist_format where case_id is not null and age is not null",
    ),
    "date_multiformat": """select o_orderkey,
  cast(coalesce(try_strptime(written, '%Y-%m-%d'), try_strptime(written, '%d/%m/%Y'),
    try_strptime(written, '%Y/%m/%d')) as date) as parsed_date
from (
  select o_orderkey, case o_orderkey % 4
      when 0 then strftime(o_orderdate, '%Y-%m-%d')
      when 1 then strftime(o_orderdate, '%d/%m/%Y')
      when 2 then strftime(o_orderdate, '%Y/%m/%d')
      else 'not a date' end as written
  from orders)""",
    "source_cap": "select event_id, event_type from events order by event_id limit 100",
    "snapshot_latest": """select o_orderkey,
  cast(date_trunc('month', o_orderdate) as date) as snapshot
from orders
where date_trunc('month', o_orderdate) =
  (select max(date_trunc('month', o_orderdate)) from orders)""",
    "panel_scan": PANEL_FORMAT_ROWS,
    "linelist_scan": LINELIST_FORMAT_ROWS,
    "usage_csv": COMBINED_ROWS,
    "partitioned_usage": with_parts(
        COMBINED,
        """select cast(year(date) as integer) as year, cast(month(date) as integer) as month,
  count(*) as days
from combine_daily group by 1, 2""",
    ),
    "pipeline_summary": SUMMARY_ROWS,
    "index_documents": with_parts(
        COMBINED, f"select country, date, {_document()} as document from combine_daily"
    ),
    "index_documents_zero": with_parts(
        COMBINED, f"select country, date, {_document('0')} as document from combine_daily"
    ),
    "bulk_index": with_parts(
        COMBINED,
        f"""select '{{"index":{{"_index":"daily-comparison"}}}}' || chr(10) || {_document()}
  as lines
from combine_daily""",
    ),
    "sink_reconcile": with_parts(
        COMBINED,
        """select country, count(*) as rows_source, count(*) as rows_target, true as ok
from combine_daily group by country""",
    ),
    "trend_features": with_parts(TREND, "select * from trend_features"),
    "trend_split": with_parts(
        TREND,
        """select case when day_number % 5 = 0 then 'test' else 'train' end as part,
  count(*) as n, min(day_number) as min_day, max(day_number) as max_day
from trend_features group by 1""",
    ),
    "trend_fit": with_parts(
        FITTED,
        "select round(slope, 6) as slope, round(intercept, 6) as intercept from trend_fit",
    ),
    "trend_metrics": with_parts(
        FITTED,
        """select round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
  round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) as r2
from (
  select label as y,
    (select intercept from trend_fit) + (select slope from trend_fit) * day_number as p
  from trend_features where day_number % 5 = 0)""",
    ),
    "trend_forecast": with_parts(
        FITTED,
        """select cast(d as integer) as day_number,
  round((select intercept from trend_fit) + (select slope from trend_fit) * d, 0) as predicted
from (
  select unnest(generate_series(m + 1, m + 30)) as d
  from (select max(day_number) as m from trend_features))""",
    ),
    "overall_stats": with_parts(
        COMBINED,
        """select count(*) as records, count(distinct country) as countries,
  min(date) as first_date, max(date) as last_date
from combine_daily""",
    ),
    "feed_sample": with_parts(
        LINELIST,
        """select report_date, department_name, age, sex, status, country
from linelist_format order by report_date, case_id limit 5""",
    ),
    "feed_schema": with_parts(
        LINELIST,
        " union all ".join(
            f"select '{column}' as \"column\", '{kind}' as type, count({column}) as present "
            "from linelist_format"
            for column, kind in CASE_COLUMNS.items()
        ),
    ),
    "index_documents_dag": with_parts(
        [*COMBINED_ZERO, f"zero_daily as ({ZERO_ROWS})"],
        f"select country, date, {ZERO_DOCUMENT} as document from zero_daily",
    ),
    "snapshot_fallback": with_parts(
        [PANEL_RAW],
        "select sexe, dep, count(*) as rows_read from panel_raw where sexe = '0' group by sexe, dep",
    ),
    "landing_lines": with_parts(
        [PANEL_RAW],
        """select case when sexe = '0' then dep || chr(8232) || 'end' else dep end as dep, jour, hosp
from panel_raw""",
    ),
    "summary_csv": SUMMARY_ROWS,
    "bulk_files": with_parts(
        COMBINED,
        f"""select value, count(*) as n from (
  select {_document()} as value from combine_daily
  union all
  select '{{"index":{{"_index":"daily-comparison"}}}}' from combine_daily
  union all
  select '{json.dumps(index_mapping())}')
group by value""",
    ),
    "pipeline_index": with_parts(
        COMBINED, "select country, count(*) as documents from combine_daily group by country"
    ),
    "stage_results": with_parts(COMBINED, _stage_rows()),
    "header_checks": with_parts([PANEL_RAW, LINELIST_RAW], _header_rows()),
    "encoded_scan": with_parts(
        [LINELIST_RAW],
        "select id_de_caso, departamento_nom || ' á' as departamento_nom from linelist_raw",
    ),
    "fallback_scan": """select cast(o_orderkey as varchar) as order_key, o_orderstatus as status
from orders""",
    "inferred_scan": with_parts(
        COMBINED,
        """select date, country, total_deaths, mortality_rate, 'int' as inferred_as
from combine_daily""",
    ),
    "stamped": with_parts(
        COMBINED,
        """select '2024-01-31' as stamp, count(*) as n from linelist_format
union all
select '2024-01-31 12:00:00', count(*) from combine_daily""",
    ),
    "partitioned_append": with_parts(
        COMBINED,
        """select cast(year(date) as integer) as year, cast(month(date) as integer) as month,
  count(*) filter (where year(date) <> 1995 or country = 'PANEL')
    * (case when year(date) = 1994 then 2 else 1 end) as days
from combine_daily group by year(date), month(date)""",
    ),
    "sorted_csv": with_parts(
        COMBINED, "select count(*) as rows, true as in_order from combine_daily"
    ),
}
# The same results, read back from where a sink or a job left them.
TWINS["metrics_file"] = TWINS["trend_metrics"]
TWINS["pipeline_trend"] = TWINS["trend_forecast"]
TWINS |= DELIVERY_TWINS

"""Raw feeds derived from the supplied tables, with the dirt that real feeds bring along.

Every row of the table becomes a row of its feed. Tables are read with their known schemas, so no
job runs to look into their files before the query itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PANEL_COUNTRY = "PANEL"
LINE_LIST_COUNTRY = "LINELIST"

# The columns used of each supplied table.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a panel: supplier region, return flag as category, ship day."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_suppkey % 20) as dep",
        "case l_returnflag when 'A' then '0' when 'R' then '1' else '2' end as sexe",
        "string(date(l_shipdate)) as jour",
        "if(l_linenumber = 7 and l_quantity > 45, 'n/a', string(l_quantity)) as hosp",
        "if(l_linenumber = 7, '', string(l_linenumber)) as rea",
        "string(l_partkey % 100) as rad",
        "if(l_linenumber = 7, 'x', string(l_orderkey % 10)) as dc",
    )


def linelist_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases: order day in two notations, customer's nation, status in provider terms.

    The customer side is left to the planner: it broadcasts below its size limit and otherwise
    sorts and merges, with skewed keys split at run time.
    """
    located = (
        table(spark, sf_dir, "orders")
        .withColumnRenamed("o_custkey", "c_custkey")
        .join(table(spark, sf_dir, "customer"), "c_custkey")
        .withColumnRenamed("c_nationkey", "n_nationkey")
        .join(table(spark, sf_dir, "nation"), "n_nationkey")
    )
    return located.selectExpr(
        "case when o_orderkey % 97 = 0 then 'unknown' "
        "when o_orderkey % 2 = 0 then concat(string(date(o_orderdate)), ' 00:00:00') "
        "else concat(string(date(o_orderdate)), 'T00:00:00.000') end as fecha_reporte_web",
        "string(o_orderkey) as id_de_caso",
        "string(n_nationkey) as departamento",
        "n_name as departamento_nom",
        "if(o_orderkey % 89 = 0, 'N/A', string(o_orderkey % 130)) as edad",
        "if(c_custkey % 2 = 0, ' m ', 'F') as sexo",
        "case when o_orderstatus = 'F' then 'Fallecido' when o_orderstatus = 'O' then 'Activo' "
        "when c_custkey % 5 = 0 then 'N/A' when c_custkey % 7 = 0 then 'Leve' "
        "else 'Recuperado' end as estado",
    )

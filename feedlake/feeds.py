"""Contracts of the two feed shapes and of the tables built from them.

A *panel* feed carries counts per region, category and day, with an explicit total category.
A *line list* carries one row per case. Both arrive as text with provider-specific headers.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    """What the formatter and the checks need to know about one feed."""

    name: str
    renames: Mapping[str, str]
    """Raw header to formatted column, in table order."""
    dates: tuple[str, ...]
    ints: tuple[str, ...] = ()
    tidied: tuple[str, ...] = ()
    """Columns trimmed and put in upper case."""
    codes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    keep_any: tuple[str, ...] = ()
    """A row stays when at least one of these is present."""
    keys: tuple[str, ...] = ()
    """Columns that should never be NULL once formatted."""
    required: tuple[str, ...] = ()
    """Raw headers without which a snapshot is refused."""
    required_tokens: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    """Per need, word parts of which some raw header must contain one."""
    expected: tuple[str, ...] = ()
    """Formatted columns whose absence is worth a warning."""
    display: tuple[str, ...] = ()

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(raw, T.StringType()) for raw in self.renames])

    @property
    def formatted_schema(self) -> T.StructType:
        def kind(column: str) -> T.DataType:
            if column in self.dates:
                return T.DateType()
            return T.IntegerType() if column in self.ints else T.StringType()

        columns = [
            T.StructField(c, kind(c), nullable=c not in self.keys) for c in self.renames.values()
        ]
        return T.StructType(
            columns
            + [
                T.StructField("country", T.StringType(), nullable=False),
                T.StructField("ingestion_date", T.DateType(), nullable=False),
            ]
        )


# Provider headers, codes and column names.
PANEL = Feed(
    name="panel",
    renames={
        "dep": "department_code",
        "sexe": "sex",
        "jour": "date",
        "hosp": "hospitalizations",
        "rea": "icu_patients",
        "HospConv": "conventional_hosp",
        "SSR_USLD": "ssr_usld",
        "autres": "other",
        "rad": "returned_home",
        "dc": "deaths",
    },
    dates=("date",),
    ints=(
        "hospitalizations",
        "icu_patients",
        "conventional_hosp",
        "ssr_usld",
        "other",
        "returned_home",
        "deaths",
    ),
    codes={"sex": {"0": "ALL", "1": "M", "2": "F"}},
    keep_any=("hospitalizations", "icu_patients", "deaths"),
    keys=("department_code", "sex", "date"),
    required=("dep", "sexe", "jour", "hosp", "rea", "dc", "rad"),
    expected=("department_code", "date", "country"),
)

LINE_LIST = Feed(
    name="linelist",
    renames={
        "fecha_reporte_web": "report_date",
        "id_de_caso": "case_id",
        "fecha_de_notificaci_n": "notification_date",
        "departamento": "department_code",
        "departamento_nom": "department_name",
        "ciudad_municipio": "city_code",
        "ciudad_municipio_nom": "city_name",
        "edad": "age",
        "sexo": "sex",
        "tipo_recuperacion": "recovery_type",
        "estado": "status",
        "fecha_muerte": "death_date",
        "fecha_recuperado": "recovery_date",
    },
    dates=("report_date", "notification_date", "death_date", "recovery_date"),
    ints=("age",),
    tidied=("sex",),
    codes={
        "status": {
            "Recuperado": "RECOVERED",
            "Fallecido": "DECEASED",
            "Activo": "ACTIVE",
            "N/A": "UNKNOWN",
        }
    },
    keep_any=("report_date",),
    keys=("report_date",),
    required_tokens={
        "date": ("fecha", "date"),
        "location": ("departamento", "ciudad", "municipio"),
    },
    display=("report_date", "department_name", "city_name", "age", "sex", "status", "country"),
)

# Tables derived from the feeds.
COMBINED_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("total_cases", T.LongType()),
        T.StructField("total_hospitalizations", T.LongType()),
        T.StructField("total_icu", T.LongType()),
        T.StructField("total_deaths", T.LongType()),
        T.StructField("total_recovered", T.LongType()),
        T.StructField("active_cases", T.LongType()),
        T.StructField("regions_count", T.LongType()),
        T.StructField("avg_age", T.DoubleType()),
        T.StructField("mortality_rate", T.DoubleType()),
        T.StructField("recovery_rate", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

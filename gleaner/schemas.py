"""Fixed table schemas (column lists and Spark types)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, LongType, MapType, StringType, StructField, StructType,
)

S, L = StringType(), LongType()


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# The column lists of the four parquet-sourced package tables,
# in their published order. fact, fact_resource and issue carry no
# start/end date.
PACKAGE_COLUMNS = {
    "entity": [
        "dataset", "end_date", "entity", "entry_date", "geometry",
        "json", "name", "organisation_entity", "point", "prefix", "quality",
        "reference", "start_date", "typology",
    ],
    "fact": [
        "entity", "fact", "field", "entry_date", "priority", "reference_entity", "value",
    ],
    "fact_resource": [
        "fact", "entry_date", "entry_number", "priority", "resource",
    ],
    "issue": [
        "entity", "entry_date", "entry_number", "field", "issue_type",
        "line_number", "dataset", "resource", "value", "message",
    ],
}

# The three CSV-sourced package tables.
CSV_TABLES = ["dataset_resource", "column_field", "old_entity"]

_LONG_COLUMNS = {"entity", "priority", "entry_number", "line_number"}


def package_schema(table: str) -> StructType:
    """Spark schema of a parquet-sourced package table."""
    return _struct(*[(c, L if c in _LONG_COLUMNS else S) for c in PACKAGE_COLUMNS[table]])


ENTITY = package_schema("entity")
FACT = package_schema("fact")
FACT_RESOURCE = package_schema("fact_resource")
ISSUE = package_schema("issue")

# CSV-sourced tables (all text as read; casts happen inside operators).
CSV_COLUMNS = {
    "dataset_resource": ["dataset", "resource", "code_version", "config_hash",
                         "specification_hash", "entry_date"],
    "column_field": ["dataset", "resource", "column", "field"],
    "old_entity": ["old_entity", "entity", "status"],
}


def csv_schema(table: str) -> StructType:
    return _struct(*[(c, S) for c in CSV_COLUMNS[table]])


PAIR = _struct(("dataset", S), ("resource", S))
OLD_RESOURCE = _struct(("seq", L), ("old_resource", S), ("resource", S), ("status", S))
LOG = _struct(("endpoint", S), ("resource", S), ("entry_date", DateType()), ("status", S))
SOURCE = _struct(("source", S), ("organisation", S), ("endpoint", S),
                 ("collection", S), ("pipelines", S))
ENDPOINT = _struct(("endpoint", S), ("endpoint_url", S))
RESOURCE_INDEX = _struct(("resource", S), ("start_date", DateType()), ("end_date", DateType()),
                         ("endpoints", ArrayType(S)), ("organisations", ArrayType(S)))
STATE = StructType([StructField("transform_resources", MapType(S, ArrayType(S)), True)])
SPEC_DATASET = _struct(("dataset", S), ("collection", S),
                       ("entity_minimum", L), ("entity_maximum", L))
ISSUE_FIELDS = ["entity", "entry_date", "entry_number", "field", "issue_type",
                "line_number", "dataset", "resource", "value", "message"]

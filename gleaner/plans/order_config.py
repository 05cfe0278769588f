"""Phase configuration for the order stand-in (raw rows from ``orders``).

These are the small per-dataset config tables a collection would keep as
CSV files; here they are stated once and turned into both a Spark frame and
a SQL VALUES list, so the Spark job and its oracle read the same config.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import literal_df
from gleaner.sources import standins as ST

DATASETS = ["order-f", "order-o", "order-p"]

CONFIG: dict[str, tuple[list[str], list[tuple]]] = {
    "column": (["dataset", "column", "field"],
               [(d, c, f) for d in DATASETS for c, f in [
                   ("OrderKey", "reference"), ("Customer", "customer"), ("Status", "status"),
                   ("Priority", "priority_text"), ("OrderDate", "start_date")]]
               + [("order-o", "Status", "state")]),
    "skip": (["dataset", "pattern"], [("order-p", "7,[0-9]+,P,")]),
    # several rules on one field, applied in order: the second sees the first's result
    "patch": (["dataset", "field", "pattern", "replacement", "seq"],
              [(d, "priority_text", "^4-NOT SPECIFIED$", "4-UNSPECIFIED", "1") for d in DATASETS]
              + [("order-f", "priority_text", "UNSPECIFIED$", "NONE", "2"),
                 ("order-f", "priority_text", "^5-", "5/", "3"),
                 ("order-o", "priority_text", "-UNSPEC", "-unspec", "3")]),
    "filter": (["dataset", "field", "pattern"], [("order-o", "priority_text", "^[1-3]-")]),
    "concat": (["dataset", "field", "fields", "separator"],
               [(d, "name", "status;priority_text", " / ") for d in DATASETS]),
    "default": (["dataset", "field", "default_field"], [("order-f", "end_date", "start_date")]),
    "default_value": (["dataset", "field", "value"],
                      [(d, "typology", "order") for d in DATASETS] + [("order-o", "quality", "draft")]),
    "transform": (["dataset", "field", "replacement_field"],
                  [(d, "total", "amount") for d in DATASETS]),
    "prefix": (["dataset", "prefix"], [(d, "order") for d in DATASETS]),
}


def config_df(spark: SparkSession, name: str) -> DataFrame:
    cols, rows = CONFIG[name]
    return literal_df(spark, rows, ", ".join(f"`{c}` string" for c in cols))


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def config_sql(name: str, alias: str | None = None) -> str:
    """``(VALUES ...) alias(cols)`` for the SQL oracle."""
    cols, rows = CONFIG[name]
    vals = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(f'"{c}"' for c in cols)
    return f"(VALUES {vals}) {alias or name}({names})"


def concat_parts_sql() -> str:
    """The concat config exploded to one row per source field with its
    position (what ``posexplode(split(fields, ';'))`` yields in Spark)."""
    _cols, rows = CONFIG["concat"]
    out = []
    for d, target, fields, sep in rows:
        for i, f in enumerate(fields.split(";")):
            out.append(f"({_lit(d)}, {_lit(target)}, {i}, {_lit(f)}, {_lit(sep)})")
    return f"(VALUES {', '.join(out)}) cp(dataset, target, pos, field, separator)"


def order_old_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """old-entity rows for order entities: low-priority fulfilled orders are
    redirected (301) to a new entity, or retired (410) above a price. Every
    fifth one has an earlier row that says otherwise; the last row counts."""
    o = ST.table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus",
                 "o_totalprice")
    big = F.col("o_totalprice") > 400000
    low = o.where((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"))
    earlier = low.where(F.col("o_orderkey") % 5 == 0).select(
        (F.col("o_orderkey") * 2).alias("seq"),
        (F.col("o_orderkey") + ST.ORDER_ENTITY_BASE).cast("string").alias("old_entity"),
        F.when(big, "1").otherwise("").alias("entity"), F.when(big, "301").otherwise("410").alias("status"))
    return (low.select((F.col("o_orderkey") * 2 + 1).alias("seq"), (F.col("o_orderkey") + ST.ORDER_ENTITY_BASE).cast("string").alias("old_entity"),
                    F.when(big, F.lit("")).otherwise(
                        (F.col("o_orderkey") + ST.ORDER_ENTITY_BASE + 1_000_000).cast("string"))
                    .alias("entity"),
                    F.when(big, "410").otherwise("301").alias("status")).unionByName(earlier))


ORDER_OLD_ENTITY_SQL = """oold AS (
  SELECT o_orderkey * 2 + 1 AS seq, CAST(o_orderkey + 3000000 AS VARCHAR) AS old_entity,
         CASE WHEN o_totalprice > 400000 THEN '' ELSE CAST(o_orderkey + 4000000 AS VARCHAR) END AS entity,
         CASE WHEN o_totalprice > 400000 THEN '410' ELSE '301' END AS status
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey * 2, CAST(o_orderkey + 3000000 AS VARCHAR),
         CASE WHEN o_totalprice > 400000 THEN '1' ELSE '' END,
         CASE WHEN o_totalprice > 400000 THEN '301' ELSE '410' END
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AND o_orderkey % 5 = 0),
oldlast AS (
  SELECT TRY_CAST(old_entity AS BIGINT) AS old, arg_max(entity, seq) AS entity, arg_max(status, seq) AS status
  FROM oold WHERE TRY_CAST(old_entity AS BIGINT) IS NOT NULL GROUP BY ALL)"""

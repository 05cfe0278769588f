"""The transform job (W6) over the order stand-in: raw rows of every
resource of the batch -> phases -> transformed rows, issues and logs.

One lazy plan over one row per entry: the configs are folded to one row
per dataset and joined once (broadcast when Spark's size check finds them
small); the lookup is the only join that can be large (shuffle on
(prefix, reference)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import phases as PH
from gleaner.plans.order_config import CONFIG, config_df, order_old_entity
from gleaner.sources import standins as ST


def order_raw(spark, d) -> DataFrame:
    return ST.raw_order_rows(spark, d)


def order_config(spark) -> DataFrame:
    return PH.dataset_config(spark, {name: config_df(spark, name) for name in CONFIG})


# phase order of the job
STAGES = ["entries", "columns", "patch", "filter", "concat", "default", "default_value",
          "transform", "lookup", "old_entity"]


def staged(spark, d, upto: str = "old_entity", log: bool = True) -> DataFrame:
    """Entries after the phases up to and including ``upto``. ``log`` = False
    is for facts, which list no issues: those of the phases before the lookup are
    not carried through its joins."""
    e = PH.to_entries(order_raw(spark, d), ST.RAW_ORDER_COLUMNS, order_config(spark))
    steps = {
        "columns": PH.map_columns,
        "patch": PH.patch_values,
        "filter": PH.filter_entries,
        "concat": PH.concat_fields,
        "default": PH.default_fields,
        "default_value": PH.default_values,
        "transform": PH.rename_fields,
        "lookup": lambda x: PH.assign_entities(x if log else PH.without_log(x), ST.order_lookup(spark, d)),
        "old_entity": lambda x: PH.redirect_entities(x, order_old_entity(spark, d)),
    }
    for name in STAGES[1:STAGES.index(upto) + 1]:
        e = steps[name](e)
    return e


def rows(spark, d) -> DataFrame:
    """Long rows with entity."""
    return PH.entry_rows(staged(spark, d), with_entity=True)


def issues(spark, d) -> DataFrame:
    """Issue log."""
    return PH.entry_issues(staged(spark, d))


def facts_entries(spark, d) -> DataFrame:
    """Entries shaped for fact creation."""
    priority = F.when(F.col("dataset") == "order-f", 1).otherwise(2)
    return PH.facts_entries(staged(spark, d, log=False), priority)

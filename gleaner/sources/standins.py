"""Reference-shaped tables derived from the driver's parquet tables.

The driver data has none of the collection tables, so each one is derived
from a driver table with the same shape and the same corner cases (see
FIXTURES.md part C). Every derivation is a lazy DataFrame over the whole
input table, so its work grows with the data. The SQL twins used by the
correctness oracle live in :mod:`gleaner.plans.oracle`.

Texts are hashed before they are joined or shuffled: only 64-character
hashes cross the network, never document bodies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The versions the current run would record in its
# dataset-resource log (code version, config hash, specification hash).
CODE_VERSION = "0.1.0"
CONFIG_HASH = "config-1"
SPECIFICATION_HASH = "specification-1"

# Width of the entity range each synthetic "part-<k>" dataset owns, and the
# number of part entities each supplier organisation owns.
PART_DATASET_WIDTH = 1000
SUPPLIER_ENTITY_WIDTH = 20
# Entities allocated to orders start here.
ORDER_ENTITY_BASE = 3_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *cols) -> DataFrame:
    """A driver table, projected to ``cols`` (names or expressions) right at
    the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def docs(spark, sf_dir) -> DataFrame:
    """documents with the text replaced by its sha256 (the resource id)."""
    return table(spark, sf_dir, "documents",
                 "doc_id", "source", "lang", F.sha2("text", 256).alias("resource"))


def dataset_resource_map(spark, sf_dir) -> DataFrame:
    """The long form of dataset -> [resource]: one row per distinct pair."""
    return docs(spark, sf_dir).select(
        F.col("source").alias("dataset"), "resource").distinct()


def old_resource(spark, sf_dir) -> DataFrame:
    """old-resource entries (seq, old_resource, resource, status).

    toxic documents are removed (status 410, empty target: '' for English,
    NULL otherwise, as an empty CSV cell reads); low-quality ones are
    redirected (301) to the first document of their source. Equal texts give
    duplicate keys, so "last entry wins" is exercised.
    """
    d = docs(spark, sf_dir)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    first = d.groupBy("source").agg(F.min_by("resource", "doc_id").alias("first_resource"))
    return (
        d.join(labels, "doc_id")
        .where((F.col("toxic") == 1) | (F.col("quality") == 0))
        .join(first, "source")
        .select(
            F.col("doc_id").alias("seq"),
            F.col("resource").alias("old_resource"),
            F.when(F.col("toxic") == 1,
                   F.when(F.col("lang") == "en", F.lit("")).otherwise(F.lit(None).cast("string")))
            .otherwise(F.col("first_resource")).alias("resource"),
            F.when(F.col("toxic") == 1, "410").otherwise("301").alias("status"),
        )
    )


def dataset_resource_log(spark, sf_dir) -> DataFrame:
    """The dataset-resource version log of earlier runs (labelled documents).

    In the last run, German rows carry a stale config hash, Spanish rows a
    NULL code version; every third document has an older run with the current
    versions, every fifth one with stale versions. Unlabelled documents have
    no log at all.
    """
    d = docs(spark, sf_dir)
    labels = table(spark, sf_dir, "labels", "doc_id")
    runs = F.array(F.lit(0), F.when(F.col("doc_id") % 3 == 0, 1), F.when(F.col("doc_id") % 5 == 0, 2))
    each = d.join(labels, "doc_id").select("*", F.explode(runs).alias("_run")).where("_run is not null")
    last = F.col("_run") == 0
    return each.select(
        F.col("source").alias("dataset"), "resource",
        F.when(last & (F.col("lang") == "es"), F.lit(None).cast("string"))
        .otherwise(F.lit(CODE_VERSION)).alias("code_version"),
        F.when((last & (F.col("lang") == "de")) | (F.col("_run") == 2), F.lit("stale"))
        .otherwise(F.lit(CONFIG_HASH)).alias("config_hash"),
        F.lit(SPECIFICATION_HASH).alias("specification_hash"),
        F.when(last, F.lit("2024-03-01")).when(F.col("_run") == 1, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).alias("entry_date"),
    )


def collection_log(spark, sf_dir) -> DataFrame:
    """Collector log (endpoint, resource, entry_date, status) from events.

    Event ``i`` fetched document ``i``'s resource; error events fetched
    nothing (status 500, no resource).
    """
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    d = docs(spark, sf_dir).select("doc_id", "resource")
    is_error = F.col("event_type") == "error"
    return ev.join(d, ev.event_id == d.doc_id, "left").select(
        F.concat(F.lit("ep-"), F.col("user_id").cast("string")).alias("endpoint"),
        F.when(is_error, F.lit(None).cast("string")).otherwise(F.col("resource")).alias("resource"),
        F.col("ts").cast("date").alias("entry_date"),
        F.when(is_error, "500").otherwise("200").alias("status"),
    )


def source_table(spark, sf_dir) -> DataFrame:
    """Collection source table from customer: one endpoint per customer."""
    return table(spark, sf_dir, "customer",
        F.concat(F.lit("src-"), F.col("c_custkey").cast("string")).alias("source"),
        F.concat(F.lit("org-"), F.col("c_nationkey").cast("string")).alias("organisation"),
        F.concat(F.lit("ep-"), F.col("c_custkey").cast("string")).alias("endpoint"),
        F.lower("c_mktsegment").alias("collection"),
        F.concat(F.lower("c_mktsegment"), F.when(F.col("c_custkey") % 3 == 0, ";common").otherwise(""))
        .alias("pipelines"),
    )


def specification_dataset(spark, sf_dir) -> DataFrame:
    """Specification dataset table: each ``part-<k>`` dataset owns the
    inclusive entity range [k*W, k*W + W - 1]."""
    w = PART_DATASET_WIDTH
    k = F.floor(F.col("p_partkey") / w).cast("bigint")
    return (table(spark, sf_dir, "part", k.alias("k")).distinct()
            .select(F.concat(F.lit("part-"), F.col("k").cast("string")).alias("dataset"),
                    F.lit("part").alias("collection"),
                    (F.col("k") * w).alias("entity_minimum"),
                    (F.col("k") * w + (w - 1)).alias("entity_maximum")))


def entity_organisation(spark, sf_dir) -> DataFrame:
    """entity-organisation config: supplier ``s`` owns part entities
    [s*V, s*V + V - 1]."""
    v = SUPPLIER_ENTITY_WIDTH
    return table(spark, sf_dir, "supplier",
        (F.col("s_suppkey") * v).alias("entity_minimum"),
        (F.col("s_suppkey") * v + (v - 1)).alias("entity_maximum"),
        F.concat(F.lit("org-"), F.col("s_nationkey").cast("string")).alias("organisation"),
    )


def old_entity(spark, sf_dir) -> DataFrame:
    """old-entity config rows (all text): customer keys as numeric ids,
    building customers by name (not a number), machinery customers above
    2**31 (out of 32-bit range). Negative balance -> retired (410) else
    redirected (301) to the next key."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    seg = F.col("c_mktsegment")
    key = F.col("c_custkey")
    retired = F.col("c_acctbal") < 0
    return c.select(
        F.when(seg == "BUILDING", F.col("c_name"))
        .when(seg == "MACHINERY", (key + 5_000_000_000).cast("string"))
        .otherwise(key.cast("string")).alias("old_entity"),
        F.when(retired, F.lit("")).otherwise((key + 1).cast("string")).alias("entity"),
        F.when(retired, "410").otherwise("301").alias("status"),
    )


def transformed_entries(spark, sf_dir) -> DataFrame:
    """Transformed entries, one per line item, its fields as an array: the
    records a pipeline run leaves for dataset-create.

    Each order is a resource; each line describes part entity ``l_partkey``
    of dataset ``part-<k>``. Some orders carry dates far off, before 1970,
    missing or not of the usual form, and high or missing priorities. Fields: name, reference, organisation_entity,
    quantity, status (the last two are not entity columns and end in json).
    """
    li = table(spark, sf_dir, "lineitem",
               "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_returnflag", "l_linestatus", "l_shipdate")
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    w = PART_DATASET_WIDTH
    kind = F.col("l_orderkey") % 40
    day = F.col("l_shipdate").cast("date").cast("string")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        F.concat(F.lit("part-"), F.floor(F.col("p_partkey") / w).cast("bigint").cast("string"))
        .alias("dataset"),
        F.col("p_partkey").alias("entity"),
        F.sha2(F.col("l_orderkey").cast("string"), 256).alias("resource"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("entry_number"),
        F.when(kind == 0, "9999-12-31").when(kind == 1, "1960-05-05").when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, F.substring(day, 1, 4)).when(kind == 4, F.concat(day, F.lit("T10:00:00")))
        .otherwise(day).alias("entry_date"),
        F.when(F.col("l_returnflag") == "R", 1).when(kind == 5, 901).when(kind == 6, 5000)
        .when(kind == 7, F.lit(None).cast("int")).otherwise(2).cast("bigint").alias("priority"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("reference"),
        F.col("l_suppkey").cast("string").alias("organisation_entity"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        F.concat("l_returnflag", "l_linestatus").alias("status"),
    )
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))
                       for c in ("name", "reference", "organisation_entity", "quantity", "status")])
    return rows.select("dataset", "entity", "resource", "entry_number", "entry_date", "priority", fields.alias("fields"))


def transformed_facts_input(spark, sf_dir) -> DataFrame:
    """The same as long rows, one per (line item, field)."""
    return transformed_entries(spark, sf_dir).select(
        "dataset", "entity", "resource", "entry_number", "entry_date", "priority", F.inline("fields"))


def raw_order_rows(spark, sf_dir) -> DataFrame:
    """Collected raw rows (all text, source column names) from orders.

    Each customer publishes one resource; ``entry_number`` is the order key
    + 1 (so it is unique and needs no window). Dataset by order status.
    """
    return table(
        spark, sf_dir, "orders",
        F.concat(F.lit("order-"), F.lower("o_orderstatus")).alias("dataset"),
        F.sha2(F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")), 256).alias("resource"),
        (F.col("o_orderkey") + 1).alias("entry_number"),
        F.col("o_orderkey").cast("string").alias("OrderKey"),
        F.col("o_custkey").cast("string").alias("Customer"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("Priority"),
        F.col("o_orderdate").cast("date").cast("string").alias("OrderDate"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("Total"),
    )


RAW_ORDER_COLUMNS = ["OrderKey", "Customer", "Status", "Priority", "OrderDate", "Total"]


def order_lookup(spark, sf_dir) -> DataFrame:
    """lookup config (prefix, reference, entity): every order that has line
    items is a known entity. Orders carry no organisation, so the table has
    no organisation column (all its rows are prefix-wide)."""
    return (table(spark, sf_dir, "lineitem", "l_orderkey").distinct()
            .select(F.lit("order").alias("prefix"),
                    F.col("l_orderkey").cast("string").alias("reference"),
                    (F.col("l_orderkey") + ORDER_ENTITY_BASE).alias("entity")))

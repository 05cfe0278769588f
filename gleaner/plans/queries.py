"""Registered queries: one per operator/job, each with its SQL twin.

``QUERIES[name] = (spark_fn, sql)``; ``spark_fn(spark, sf_dir)`` returns a
lazy DataFrame over the whole driver tables; ``sql`` (or None when the
operator is not expressible in SQL) is the DuckDB oracle over the same
tables. Column names and types agree between the two.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import scalar as X
from gleaner.operators import collection as C
from gleaner.operators import selection as SEL
from gleaner.plans.oracle import with_ctes
from gleaner.session import stored_once
from gleaner.sources import raw as RAW
from gleaner.sources import standins as ST

QUERIES: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _versions() -> SEL.Versions:
    return SEL.Versions(ST.CODE_VERSION, ST.CONFIG_HASH, ST.SPECIFICATION_HASH)


# slice used by the slicing queries (the feature under test)
SLICE_OFFSET, SLICE_LIMIT = 10, 200


# ----------------------------------------------------------------- selection

@register("build_pairs", with_ctes(["pair"], "SELECT dataset, resource FROM pair"))
def q_build_pairs(spark, d):
    return SEL.build_pairs(ST.dataset_resource_map(spark, d))


@register("build_pairs_for_dataset",
          with_ctes(["pair"], "SELECT dataset, resource FROM pair WHERE dataset = 'src3'"))
def q_build_pairs_for_dataset(spark, d):
    return SEL.build_pairs(ST.dataset_resource_map(spark, d), dataset="src3")


@register("build_pairs_unknown_dataset",
          with_ctes(["pair"], "SELECT dataset, resource FROM pair WHERE dataset = 'no-such-dataset'"))
def q_build_pairs_unknown(spark, d):
    return SEL.build_pairs(ST.dataset_resource_map(spark, d), dataset="no-such-dataset")


@register("stable_position", with_ctes(["pair"], """
SELECT dataset, resource,
       CAST(row_number() OVER (ORDER BY dataset, resource) - 1 AS BIGINT) AS position
FROM pair"""))
def q_stable_position(spark, d):
    positioned, _ = SEL.number_rows(ST.dataset_resource_map(spark, d), ["dataset", "resource"])
    return positioned


@register("slice_pairs", with_ctes(["pair"], f"""
SELECT * FROM (
  SELECT dataset, resource,
         CAST(row_number() OVER (ORDER BY dataset, resource) - 1 AS BIGINT) AS position
  FROM pair)
WHERE position >= {SLICE_OFFSET} AND position < {SLICE_OFFSET + SLICE_LIMIT}"""))
def q_slice_pairs(spark, d):
    return SEL.slice_pairs(ST.dataset_resource_map(spark, d), SLICE_OFFSET, SLICE_LIMIT)


@register("anti_up_to_date", with_ctes(["pair", "current"], """
SELECT p.dataset, p.resource FROM pair p
WHERE NOT EXISTS (SELECT 1 FROM current_pairs c
                  WHERE c.dataset = p.dataset AND c.resource = p.resource)"""))
def q_anti_up_to_date(spark, d):
    return SEL.anti_up_to_date(ST.dataset_resource_map(spark, d),
                               ST.dataset_resource_log(spark, d), _versions())


@register("skip_counts", with_ctes(["pair", "current"], """
SELECT CAST(count(*) AS BIGINT) AS before,
       CAST(count(c.resource) AS BIGINT) AS skipped,
       CAST(count(*) - count(c.resource) AS BIGINT) AS remaining
FROM pair p LEFT JOIN current_pairs c ON c.dataset = p.dataset AND c.resource = p.resource"""))
def q_skip_counts(spark, d):
    marked = SEL.mark_up_to_date(ST.dataset_resource_map(spark, d),
                                 ST.dataset_resource_log(spark, d), _versions())
    return SEL.skip_counts(marked)


@register("select_work", with_ctes(["pair", "current"], f"""
SELECT s.dataset, s.resource, s.position FROM (
  SELECT dataset, resource,
         CAST(row_number() OVER (ORDER BY dataset, resource) - 1 AS BIGINT) AS position
  FROM pair) s
WHERE s.position >= {SLICE_OFFSET} AND s.position < {SLICE_OFFSET + SLICE_LIMIT}
  AND NOT EXISTS (SELECT 1 FROM current_pairs c
                  WHERE c.dataset = s.dataset AND c.resource = s.resource)"""))
def q_select_work(spark, d):
    return SEL.select_work(ST.dataset_resource_map(spark, d),
                           version_log=ST.dataset_resource_log(spark, d), versions=_versions(),
                           offset=SLICE_OFFSET, limit=SLICE_LIMIT)


@register("redirect_map", with_ctes(["rmap"], "SELECT old_resource, target FROM rmap"))
def q_redirect_map(spark, d):
    return SEL.redirect_map(ST.old_resource(spark, d)).select("old_resource", "target")


@register("resolve_redirect", with_ctes(["resolved"],
          "SELECT dataset, old_resource, resource, removed FROM resolved"))
def q_resolve_redirect(spark, d):
    return SEL.resolve_redirect(ST.dataset_resource_map(spark, d), ST.old_resource(spark, d)) \
        .select("dataset", "old_resource", "resource", "removed")


@register("filter_removed", with_ctes(["resolved"],
          "SELECT dataset, old_resource, resource FROM resolved WHERE NOT removed"))
def q_filter_removed(spark, d):
    r = SEL.resolve_redirect(ST.dataset_resource_map(spark, d), ST.old_resource(spark, d))
    return SEL.filter_removed(r).select("dataset", "old_resource", "resource")


@register("retired_resources", with_ctes(["old_resource"],
          "SELECT DISTINCT old_resource FROM old_resource WHERE status = '410'"))
def q_retired(spark, d):
    return SEL.retired_resources(ST.old_resource(spark, d))


@register("anti_retired", with_ctes(["pair", "old_resource"], """
SELECT p.dataset, p.resource FROM pair p
WHERE p.resource NOT IN (SELECT old_resource FROM old_resource WHERE status = '410')"""))
def q_anti_retired(spark, d):
    return SEL.anti_retired(ST.dataset_resource_map(spark, d), ST.old_resource(spark, d))


@register("distinct_resources", with_ctes(["pair"], "SELECT DISTINCT resource FROM pair"))
def q_distinct_resources(spark, d):
    return SEL.distinct_resources(ST.dataset_resource_map(spark, d))


def _tasks(spark, d):
    """W1 core without a slice: pairs not up to date, redirected, removed
    dropped, enriched by the listed (old) id."""
    work = SEL.select_work(ST.dataset_resource_map(spark, d),
                           version_log=ST.dataset_resource_log(spark, d), versions=_versions())
    resolved = SEL.filter_removed(SEL.resolve_redirect(work, ST.old_resource(spark, d)))
    enrich = C.resource_enrichment(ST.collection_log(spark, d), ST.source_table(spark, d))
    tasks = C.enrich_pairs(resolved, enrich)
    return tasks.select(
        "old_resource", "dataset", "resource",
        F.concat(F.lit("collection/resource/"), "resource").alias("path"),
        "endpoints", "organisations", "entry_date")


@register("plan_transform", with_ctes(["tasks"], """
SELECT old_resource, dataset, resource, path, endpoints, organisations, entry_date FROM tasks"""))
def q_plan_transform(spark, d):
    return _tasks(spark, d)


@register("resource_enrichment", with_ctes(["enrich"], """
SELECT resource, start_date, coalesce(endpoints, '') AS endpoints,
       coalesce(organisations, '') AS organisations FROM enrich"""))
def q_resource_enrichment(spark, d):
    e = C.resource_enrichment(ST.collection_log(spark, d), ST.source_table(spark, d))
    return e.select("resource", "start_date", F.coalesce("endpoints", F.lit("")).alias("endpoints"),
                    F.coalesce("organisations", F.lit("")).alias("organisations"))


@register("dataset_resource_map", with_ctes(["clog", "srcd"], """
SELECT DISTINCT s.dataset, c.resource
FROM (SELECT DISTINCT endpoint, resource FROM clog WHERE resource IS NOT NULL) c
JOIN srcd s ON s.endpoint = c.endpoint"""))
def q_dataset_resource_map(spark, d):
    return C.dataset_resource_map(ST.collection_log(spark, d), ST.source_table(spark, d))


@register("resource_lists", with_ctes(["clog", "srcd"], """
SELECT dataset, CAST(row_number() OVER (PARTITION BY dataset ORDER BY resource) - 1 AS BIGINT) AS pos,
       resource
FROM (SELECT DISTINCT s.dataset, c.resource
      FROM (SELECT DISTINCT endpoint, resource FROM clog WHERE resource IS NOT NULL) c
      JOIN srcd s ON s.endpoint = c.endpoint)"""))
def q_resource_lists(spark, d):
    return C.resource_lists(C.dataset_resource_map(ST.collection_log(spark, d),
                                                   ST.source_table(spark, d)))


@register("resource_index", with_ctes(["clog", "srcd"], """
SELECT f.resource, f.start_date, f.end_date, p.endpoints, p.organisations, p.datasets
FROM (SELECT resource, min(entry_date) AS start_date, max(entry_date) AS end_date
      FROM clog WHERE resource IS NOT NULL GROUP BY resource) f
JOIN (SELECT c.resource,
             string_agg(DISTINCT c.endpoint, ';' ORDER BY c.endpoint) AS endpoints,
             string_agg(DISTINCT s.organisation, ';' ORDER BY s.organisation) AS organisations,
             string_agg(DISTINCT s.dataset, ';' ORDER BY s.dataset) AS datasets
      FROM (SELECT DISTINCT resource, endpoint FROM clog WHERE resource IS NOT NULL) c
      LEFT JOIN srcd s ON s.endpoint = c.endpoint
      GROUP BY c.resource) p ON p.resource = f.resource"""))
def q_resource_index(spark, d):
    return C.resource_index(ST.collection_log(spark, d), ST.source_table(spark, d))


@register("missing_resources", with_ctes(["tasks", "clog"], """
SELECT t.old_resource, t.dataset, t.path,
       printf('Resource file not found for %s (dataset=%s): %s', t.old_resource, t.dataset, t.path)
         AS error
FROM tasks t
WHERE t.resource NOT IN (SELECT resource FROM clog WHERE resource IS NOT NULL)"""))
def q_missing_resources(spark, d):
    present = ST.collection_log(spark, d).where(F.col("resource").isNotNull()).select("resource")
    return SEL.missing_resources(_tasks(spark, d), present)


@register("detect_new", with_ctes(["docs"], """
SELECT DISTINCT regexp_extract('collection/resource/' || l.resource, 'resource/([a-f0-9]+)', 1)
         AS resource
FROM (SELECT DISTINCT d.resource, x.n_chars AS size
      FROM docs d JOIN documents x ON x.doc_id = d.doc_id) l
WHERE NOT EXISTS (
  SELECT 1 FROM docs d2 JOIN documents x2 ON x2.doc_id = d2.doc_id
  JOIN labels lb ON lb.doc_id = d2.doc_id
  WHERE d2.resource = l.resource
    AND (CASE WHEN lb.quality = 0 THEN x2.n_chars + 1 ELSE x2.n_chars END) = l.size)"""))
def q_detect_new(spark, d):
    docs = ST.table(spark, d, "documents",
                    "doc_id", F.sha2("text", 256).alias("resource"), F.col("n_chars").alias("size"))
    local = docs.select("resource", "size").distinct()
    labels = ST.table(spark, d, "labels", "doc_id", "quality")
    remote = docs.join(labels, "doc_id").select(
        "resource", F.when(F.col("quality") == 0, F.col("size") + 1)
        .otherwise(F.col("size")).alias("size"))
    new = SEL.detect_new(local, remote)
    return new.select(X.hash_from_path(F.concat(F.lit("collection/resource/"), "resource"))
                      .alias("resource")).distinct()


# ----------------------------------------------------------------- manifests

from gleaner.operators import manifest as M  # noqa: E402

COLLECTION = "demo"
BASE_URL = "https://files.example.org//"
BUCKET = "collection-data"


@register("plan_resource_fetch", with_ctes(["pair", "current", "rmap"], """
SELECT url, max(path) AS path FROM (
  SELECT 'https://files.example.org/demo-collection/collection/resource/' || resource AS url,
         'collection/resource/' || resource AS path
  FROM (SELECT CASE WHEN m.old_resource IS NOT NULL THEN m.target ELSE w.resource END AS resource,
               (m.old_resource IS NOT NULL AND (m.target IS NULL OR m.target = '')) AS removed
        FROM (SELECT DISTINCT p.resource FROM pair p
              WHERE NOT EXISTS (SELECT 1 FROM current_pairs c
                                WHERE c.dataset = p.dataset AND c.resource = p.resource)) w
        LEFT JOIN rmap m ON m.old_resource = w.resource)
  WHERE NOT removed)
GROUP BY url"""))
def q_plan_resource_fetch(spark, d):
    work = SEL.select_work(ST.dataset_resource_map(spark, d),
                           version_log=ST.dataset_resource_log(spark, d), versions=_versions())
    res = SEL.filter_removed(SEL.resolve_redirect(SEL.distinct_resources(work),
                                                  ST.old_resource(spark, d)))
    return M.dedup_manifest(M.resource_manifest(res, COLLECTION, base_url=BASE_URL))


_ARTEFACT_VALUES = """(VALUES (0, 'transformed', 'transformed/', 'parquet'),
        (1, 'issue', 'issue/', 'csv'),
        (2, 'column_field', 'var/column-field/', 'csv'),
        (3, 'dataset_resource', 'var/dataset-resource/', 'csv'),
        (4, 'converted_resource', 'var/converted-resource/', 'csv')) a(ordinal, family, dir, ext)"""

_SLICED_NOT_RETIRED = f"""sliced AS (
  SELECT dataset, resource FROM (
    SELECT dataset, resource, row_number() OVER (ORDER BY dataset, resource) - 1 AS position
    FROM pair)
  WHERE position >= {SLICE_OFFSET} AND position < {SLICE_OFFSET + SLICE_LIMIT}
    AND resource NOT IN (SELECT old_resource FROM old_resource WHERE status = '410'))"""


@register("plan_artefact_fetch", with_ctes(["pair", "old_resource"], f"""
, {_SLICED_NOT_RETIRED}
SELECT s.dataset, s.resource, a.family,
       's3://collection-data/demo-collection/' || a.dir || s.dataset || '/' || s.resource || '.' || a.ext
         AS url,
       a.dir || s.dataset || '/' || s.resource || '.' || a.ext AS path
FROM sliced s, {_ARTEFACT_VALUES}""").replace("\n, sliced", ",\nsliced"))
def q_plan_artefact_fetch(spark, d):
    sliced = SEL.slice_pairs(ST.dataset_resource_map(spark, d), SLICE_OFFSET, SLICE_LIMIT)
    live = SEL.anti_retired(sliced.select("dataset", "resource"), ST.old_resource(spark, d))
    return M.artefact_manifest(live, COLLECTION, bucket=BUCKET)


@register("files_per_task", with_ctes(["pair", "old_resource"], f"""
, {_SLICED_NOT_RETIRED}
SELECT CAST(5 * count(*) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_tasks,
       CAST(CASE WHEN count(*) > 0 THEN (5 * count(*)) // count(*) ELSE 0 END AS BIGINT)
         AS files_per_task
FROM sliced""").replace("\n, sliced", ",\nsliced"))
def q_files_per_task(spark, d):
    sliced = SEL.slice_pairs(ST.dataset_resource_map(spark, d), SLICE_OFFSET, SLICE_LIMIT)
    live = SEL.anti_retired(sliced.select("dataset", "resource"), ST.old_resource(spark, d))
    man = M.dedup_manifest(M.artefact_manifest(live, COLLECTION, bucket=BUCKET))
    return M.files_per_task(man, live)


@register("reconcile_log_manifest", with_ctes(["pair", "version_log"], """
SELECT p.dataset, p.resource,
       's3://collection-data/demo-collection/var/dataset-resource/' || p.dataset || '/' || p.resource
         || '.csv' AS url,
       'var/dataset-resource/' || p.dataset || '/' || p.resource || '.csv' AS path,
       EXISTS (SELECT 1 FROM version_log v WHERE v.dataset = p.dataset AND v.resource = p.resource)
         AS present
FROM pair p"""))
def q_reconcile_log_manifest(spark, d):
    expected = M.log_manifest(ST.dataset_resource_map(spark, d), COLLECTION, bucket=BUCKET)
    stored = M.log_manifest(ST.dataset_resource_log(spark, d).select("dataset", "resource"),
                            COLLECTION, bucket=BUCKET)
    return M.reconcile_manifest(expected, stored)


@register("summarise_log_manifest", with_ctes(["pair", "version_log"], """
SELECT CAST(count(*) FILTER (WHERE present) AS BIGINT) AS downloaded,
       CAST(count(*) FILTER (WHERE NOT present) AS BIGINT) AS not_found
FROM (SELECT EXISTS (SELECT 1 FROM version_log v
                     WHERE v.dataset = p.dataset AND v.resource = p.resource) AS present
      FROM pair p)"""))
def q_summarise_log_manifest(spark, d):
    return M.summarise_manifest(q_reconcile_log_manifest(spark, d))


@register("failed_downloads", with_ctes(["pair", "current", "rmap", "clog"], """
SELECT url FROM (
  SELECT DISTINCT 'https://files.example.org/demo-collection/collection/resource/' || resource AS url,
         resource
  FROM (SELECT CASE WHEN m.old_resource IS NOT NULL THEN m.target ELSE w.resource END AS resource,
               (m.old_resource IS NOT NULL AND (m.target IS NULL OR m.target = '')) AS removed
        FROM (SELECT DISTINCT p.resource FROM pair p
              WHERE NOT EXISTS (SELECT 1 FROM current_pairs c
                                WHERE c.dataset = p.dataset AND c.resource = p.resource)) w
        LEFT JOIN rmap m ON m.old_resource = w.resource)
  WHERE NOT removed)
WHERE resource NOT IN (SELECT resource FROM clog WHERE resource IS NOT NULL AND status = '200')"""))
def q_failed_downloads(spark, d):
    manifest = q_plan_resource_fetch(spark, d)
    log = ST.collection_log(spark, d).where((F.col("status") == "200") & F.col("resource").isNotNull())
    arrived = M.resource_manifest(log.select("resource").distinct(), COLLECTION, base_url=BASE_URL)
    return M.failed_downloads(M.reconcile_manifest(manifest, arrived))


@register("split_s3_url", with_ctes(["pair"], """
SELECT url, 'collection-data' AS bucket,
       'demo-collection/var/dataset-resource/' || dataset || '/' || resource || '.csv' AS key
FROM (SELECT dataset, resource,
             's3://collection-data/demo-collection/var/dataset-resource/' || dataset || '/'
               || resource || '.csv' AS url FROM pair)"""))
def q_split_s3_url(spark, d):
    man = M.log_manifest(ST.dataset_resource_map(spark, d), COLLECTION, bucket=BUCKET)
    return man.select("url", X.split_s3_url("url").alias("p")).select("url", "p.bucket", "p.key")


@register("path_parts", with_ctes(["pair"], f"""
SELECT a.dir || p.dataset || '/' || p.resource || '.' || a.ext AS path,
       p.resource || '.' || a.ext AS base_name, p.dataset AS dataset
FROM pair p, {_ARTEFACT_VALUES}"""))
def q_path_parts(spark, d):
    paths = M.artefact_paths(ST.dataset_resource_map(spark, d))
    return paths.select(F.col("remote_path").alias("path"),
                        X.base_name("remote_path").alias("base_name"),
                        X.dataset_from_path("remote_path").alias("dataset"))


@register("split_words", with_ctes(["enrich"], """
SELECT resource, CAST(CASE WHEN endpoints IS NULL OR trim(endpoints) = '' THEN 0
                      ELSE len(string_split_regex(trim(endpoints), '\\s+')) END AS BIGINT) AS n_endpoints,
       CAST(CASE WHEN organisations IS NULL OR trim(organisations) = '' THEN 0
            ELSE len(string_split_regex(trim(organisations), '\\s+')) END AS BIGINT) AS n_organisations
FROM enrich"""))
def q_split_words(spark, d):
    e = C.resource_enrichment(ST.collection_log(spark, d), ST.source_table(spark, d))
    return e.select("resource", F.size(X.split_words("endpoints")).cast("bigint").alias("n_endpoints"),
                    F.size(X.split_words("organisations")).cast("bigint").alias("n_organisations"))


@register("collection_names", with_ctes(["src"], """
SELECT DISTINCT collection || '-collection' AS repository,
       regexp_replace(collection || '-collection', '-collection$', '') AS collection,
       replace(collection || '-data', '-', '_') AS underscored,
       replace(replace(collection || '-data', '-', '_'), '_', '-') AS hyphenated
FROM src"""))
def q_collection_names(spark, d):
    s = ST.source_table(spark, d).select(F.concat("collection", F.lit("-collection")).alias("repository"),
                                         F.concat("collection", F.lit("-data")).alias("_n"))
    return s.select("repository", X.strip_collection_suffix("repository").alias("collection"),
                    X.underscore("_n").alias("underscored"),
                    X.hyphenate(X.underscore("_n")).alias("hyphenated")).distinct()


# ----------------------------------------------------------------- facts / entities

from gleaner.operators import facts as FA  # noqa: E402
from gleaner.operators.joins import range_join  # noqa: E402


@register("make_facts", with_ctes(["tfact"], """
SELECT max(entity) AS entity, fact, max(field) AS field, max(entry_date) AS entry_date,
       min(priority) AS priority,
       CASE WHEN max(field) = 'organisation_entity' THEN max(value) END AS reference_entity,
       max(value) AS value
FROM tfact GROUP BY fact"""))
def q_make_facts(spark, d):
    return FA.make_facts(ST.transformed_entries(spark, d))


@register("make_fact_resources", with_ctes(["tfact"], """
SELECT DISTINCT fact, entry_date, entry_number, priority, resource FROM tfact"""))
def q_make_fact_resources(spark, d):
    t = ST.transformed_entries(spark, d)
    return FA.make_fact_resources(t, ranks=FA.rank_dates(t))


@register("resolve_fields", with_ctes(["rfields"],
          "SELECT dataset, entity, field, value, entry_date, fact FROM rfields"))
def q_resolve_fields(spark, d):
    return FA.resolve_fields(ST.transformed_entries(spark, d))


@register("resolve_entities", with_ctes(["ents"], "SELECT * FROM ents"))
def q_resolve_entities(spark, d):
    return FA.resolve_entities(ST.transformed_entries(spark, d))


@register("flatten_entities", with_ctes(["ents"], """
SELECT dataset, end_date, entity, entry_date, geometry, name, organisation_entity, point, prefix,
       quality, reference, start_date, typology,
       json_extract_string(json, '$.quantity') AS quantity,
       json_extract_string(json, '$.status') AS status
FROM ents"""))
def q_flatten_entities(spark, d):
    t = ST.transformed_facts_input(spark, d)
    return FA.flatten_entities(FA.resolve_entities(t), FA.json_fields(t))


@register("fact_provenance", with_ctes(["tfact"], """
SELECT f.fact, f.entity, f.field, f.value, r.resource, r.entry_date AS resource_entry_date,
       r.entry_number
FROM (SELECT fact, max(entity) AS entity, max(field) AS field, max(value) AS value
      FROM tfact GROUP BY fact) f
JOIN (SELECT DISTINCT fact, entry_date, entry_number, priority, resource FROM tfact) r
  ON r.fact = f.fact"""))
def q_fact_provenance(spark, d):
    t = ST.transformed_entries(spark, d)
    ranks = FA.rank_dates(t)
    return FA.fact_provenance(FA.make_facts(t, ranked=False, size=ranks.rows, keep_place=True),
                              FA.make_fact_resources(t, ranks=ranks, keep_place=True))


@register("update_entities", with_ctes(["ents"], "SELECT * FROM ents"))
def q_update_entities(spark, d):
    t = ST.transformed_facts_input(spark, d)
    late = F.coalesce(F.col("entry_date") >= "1998-01-01", F.lit(False))
    old, new = t.where(~late), t.where(late)
    return FA.update_entities(FA.resolve_entities(old), old, new)


@register("table_checksum", with_ctes(["tfact"], """
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CAST(('0x' || substr(md5(concat_ws(chr(1),
           coalesce(fact, chr(2)), coalesce(entry_date, chr(2)),
           coalesce(CAST(entry_number AS VARCHAR), chr(2)),
           coalesce(CAST(priority AS VARCHAR), chr(2)), coalesce(resource, chr(2)))), 1, 15))
         AS BIGINT)) AS DECIMAL(38,0)) AS checksum
FROM (SELECT DISTINCT fact, entry_date, entry_number, priority, resource FROM tfact)"""))
def q_table_checksum(spark, d):
    t = ST.transformed_entries(spark, d)
    fr = FA.make_fact_resources(t, ranks=FA.rank_dates(t))
    return FA.table_checksum(fr, ["fact", "entry_date", "entry_number", "priority", "resource"])


@register("entity_organisation", with_ctes(["eorg"], """
SELECT p.p_partkey AS entity, e.organisation
FROM part p LEFT JOIN eorg e ON p.p_partkey BETWEEN e.entity_minimum AND e.entity_maximum"""))
def q_entity_organisation(spark, d):
    ents = ST.table(spark, d, "part", F.col("p_partkey").alias("entity"))
    return range_join(ents, "entity", ST.entity_organisation(spark, d), how="left") \
        .select("entity", "organisation")


@register("old_entity_by_dataset", with_ctes(["spec", "old_entity"], """
SELECT s.dataset, o.old_entity, o.entity, o.status
FROM old_entity o JOIN spec s
  ON TRY_CAST(o.old_entity AS BIGINT) BETWEEN s.entity_minimum AND s.entity_maximum"""))
def q_old_entity_by_dataset(spark, d):
    oe = ST.old_entity(spark, d).withColumn("_k", X.to_bigint(F.col("old_entity")))
    return range_join(oe, "_k", ST.specification_dataset(spark, d)) \
        .select("dataset", "old_entity", "entity", "status")


# ----------------------------------------------------------------- transform phases

from gleaner.operators import phases as PH  # noqa: E402
from gleaner.plans import order_config as OC  # noqa: E402
from gleaner.plans import transform_job as TJ  # noqa: E402

_NORM = "lower(regexp_replace({c}, '[^A-Za-z0-9]+', '_', 'g'))"
_ENTRY = "dataset, resource, entry_number"
_ISSUE_COLS = ("entity, entry_date, entry_number, field, issue_type, line_number, dataset, "
               "resource, value, message")

_PHASE_CTES = [
    """oraw AS (
  SELECT 'order-' || lower(o_orderstatus) AS dataset,
         sha256('customer-' || CAST(o_custkey AS VARCHAR)) AS resource,
         o_orderkey + 1 AS entry_number,
         CAST(o_orderkey AS VARCHAR) AS "OrderKey", CAST(o_custkey AS VARCHAR) AS "Customer",
         o_orderstatus AS "Status", o_orderpriority AS "Priority",
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "OrderDate",
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS "Total"
  FROM orders)""",
    f"""oskip AS (
  SELECT r.* FROM oraw r
  WHERE NOT EXISTS (SELECT 1 FROM {OC.config_sql('skip', 's')}
                    WHERE s.dataset = r.dataset AND regexp_matches(concat_ws(',',
                      coalesce("OrderKey", ''), coalesce("Customer", ''), coalesce("Status", ''),
                      coalesce("Priority", ''), coalesce("OrderDate", ''), coalesce("Total", '')),
                      s.pattern)))""",
    """olong AS (
  SELECT * FROM (
    SELECT dataset, resource, entry_number, 'OrderKey' AS "column", "OrderKey" AS value FROM oskip
    UNION ALL SELECT dataset, resource, entry_number, 'Customer', "Customer" FROM oskip
    UNION ALL SELECT dataset, resource, entry_number, 'Status', "Status" FROM oskip
    UNION ALL SELECT dataset, resource, entry_number, 'Priority', "Priority" FROM oskip
    UNION ALL SELECT dataset, resource, entry_number, 'OrderDate', "OrderDate" FROM oskip
    UNION ALL SELECT dataset, resource, entry_number, 'Total', "Total" FROM oskip)
  WHERE value IS NOT NULL AND trim(value) <> '')""",
    f"""omapc AS (
  SELECT l.dataset, l.resource, l.entry_number, l."column",
         coalesce(c.field, {_NORM.format(c='l."column"')}) AS field, l.value
  FROM olong l LEFT JOIN {OC.config_sql('column', 'c')}
    ON c.dataset = l.dataset AND c."column" = l."column")""",
    "omap AS (SELECT dataset, resource, entry_number, field, value FROM omapc)",
    *[f"""opatchx{k} AS (
  SELECT m.dataset, m.resource, m.entry_number, m.field, m.value AS old,
         (p.pattern IS NOT NULL AND regexp_matches(m.value, p.pattern)) AS hit,
         CASE WHEN p.pattern IS NOT NULL AND regexp_matches(m.value, p.pattern)
              THEN regexp_replace(m.value, p.pattern, p.replacement, 'g') ELSE m.value END AS value
  FROM {"omap" if k == 1 else f"opatchx{k - 1}"} m LEFT JOIN {OC.config_sql('patch', 'p')}
    ON p.dataset = m.dataset AND p.field = m.field AND p.seq = '{k}')""" for k in (1, 2, 3)],
    "opatch AS (SELECT dataset, resource, entry_number, field, value FROM opatchx3)",
    f"""ofilter AS (
  SELECT o.* FROM opatch o
  WHERE NOT EXISTS (
    SELECT 1 FROM opatch x JOIN {OC.config_sql('filter', 'f')}
      ON f.dataset = x.dataset AND f.field = x.field
    WHERE x.dataset = o.dataset AND x.resource = o.resource AND x.entry_number = o.entry_number
      AND NOT regexp_matches(x.value, f.pattern)))""",
    f"""obuilt AS (
  SELECT r.dataset, r.resource, r.entry_number, cp.target AS field,
         string_agg(r.value, ' / ' ORDER BY cp.pos) AS value
  FROM ofilter r JOIN {OC.concat_parts_sql()} ON cp.dataset = r.dataset AND cp.field = r.field
  GROUP BY r.dataset, r.resource, r.entry_number, cp.target)""",
    """oconcat AS (
  SELECT * FROM ofilter o WHERE NOT EXISTS (
    SELECT 1 FROM obuilt b WHERE b.dataset = o.dataset AND b.resource = o.resource
      AND b.entry_number = o.entry_number AND b.field = o.field)
  UNION ALL SELECT * FROM obuilt)""",
    f"""odefadd AS (
  SELECT r.dataset, r.resource, r.entry_number, c.field, r.value
  FROM oconcat r JOIN {OC.config_sql('default', 'c')}
    ON c.dataset = r.dataset AND c.default_field = r.field
  WHERE NOT EXISTS (SELECT 1 FROM oconcat x WHERE x.dataset = r.dataset AND x.resource = r.resource
                      AND x.entry_number = r.entry_number AND x.field = c.field))""",
    "odefault AS (SELECT * FROM oconcat UNION ALL SELECT * FROM odefadd)",
    f"""ovaladd AS (
  SELECT e.dataset, e.resource, e.entry_number, c.field, c.value
  FROM (SELECT DISTINCT dataset, resource, entry_number FROM odefault) e
  JOIN {OC.config_sql('default_value', 'c')} ON c.dataset = e.dataset
  WHERE NOT EXISTS (SELECT 1 FROM odefault x WHERE x.dataset = e.dataset AND x.resource = e.resource
                      AND x.entry_number = e.entry_number AND x.field = c.field))""",
    "odefval AS (SELECT * FROM odefault UNION ALL SELECT * FROM ovaladd)",
    f"""orename AS (
  SELECT r.dataset, r.resource, r.entry_number, coalesce(t.replacement_field, r.field) AS field,
         r.value
  FROM odefval r LEFT JOIN {OC.config_sql('transform', 't')}
    ON t.dataset = r.dataset AND t.field = r.field)""",
    f"""orefs AS (
  SELECT r.dataset, r.resource, r.entry_number, p.prefix, r.value AS reference, k.entity
  FROM orename r JOIN {OC.config_sql('prefix', 'p')} ON p.dataset = r.dataset
  LEFT JOIN (SELECT DISTINCT 'order' AS prefix, CAST(l_orderkey AS VARCHAR) AS reference,
                    l_orderkey + 3000000 AS entity FROM lineitem) k
    ON k.prefix = p.prefix AND k.reference = r.value
  WHERE r.field = 'reference')""",
    """olookup AS (
  SELECT r.*, f.entity FROM orename r LEFT JOIN orefs f
    ON f.dataset = r.dataset AND f.resource = r.resource AND f.entry_number = r.entry_number)""",
    OC.ORDER_OLD_ENTITY_SQL,
    """oent AS (
  SELECT r.dataset, r.resource, r.entry_number, r.field, r.value,
         CASE WHEN o.status = '301' THEN TRY_CAST(o.entity AS BIGINT) ELSE r.entity END AS entity
  FROM olookup r LEFT JOIN oldlast o
    ON o.old = r.entity
  WHERE o.status IS NULL OR o.status <> '410')""",
    """oentity AS (
  SELECT f.dataset, f.resource, f.entry_number,
         CASE WHEN o.status = '301' THEN TRY_CAST(o.entity AS BIGINT) ELSE f.entity END AS entity
  FROM orefs f LEFT JOIN oldlast o ON o.old = f.entity)""",
    f"""oissues0 AS (
  SELECT NULL::VARCHAR AS entry_date, entry_number, field,
         'patch' AS issue_type, entry_number + 1 AS line_number, dataset, resource, old AS value,
         'value patched' AS message
  FROM (SELECT * FROM opatchx1 WHERE hit UNION ALL SELECT * FROM opatchx2 WHERE hit
        UNION ALL SELECT * FROM opatchx3 WHERE hit)
  UNION ALL
  SELECT NULL::VARCHAR, entry_number, field, 'default-field', entry_number + 1,
         dataset, resource, value, 'value taken from another field' FROM odefadd
  UNION ALL
  SELECT NULL::VARCHAR, entry_number, field, 'default-value', entry_number + 1,
         dataset, resource, value, 'default value used' FROM ovaladd
  UNION ALL
  SELECT NULL::VARCHAR, entry_number, 'reference', 'unknown-entity', entry_number + 1,
         dataset, resource, reference, 'no entity for this reference' FROM orefs
  WHERE entity IS NULL)""",
    """oissues AS (
  SELECT e.entity, i.* FROM oissues0 i LEFT JOIN oentity e
    ON e.dataset = i.dataset AND e.resource = i.resource AND e.entry_number = i.entry_number)""",
    """ofacts AS (
  SELECT r.dataset, r.entity, r.resource, r.entry_number, s.value AS entry_date,
         CAST(CASE WHEN r.dataset = 'order-f' THEN 1 ELSE 2 END AS BIGINT) AS priority,
         r.field, r.value
  FROM oent r LEFT JOIN (SELECT dataset, resource, entry_number, value FROM oent
                         WHERE field = 'start_date') s
    ON s.dataset = r.dataset AND s.resource = r.resource AND s.entry_number = r.entry_number
  WHERE r.entity IS NOT NULL)""",
]


def _phase_sql(body: str) -> str:
    return "WITH " + ",\n".join(_PHASE_CTES) + "\n" + body


def _rows(spark, d, upto, with_entity=False):
    return PH.entry_rows(TJ.staged(spark, d, upto), with_entity)


@register("skip_rows", _phase_sql(f"SELECT {_ENTRY} FROM oskip"))
def q_skip_rows(spark, d):
    return TJ.staged(spark, d, "entries").select(*PH.ENTRY)


@register("map_columns", _phase_sql(f"SELECT {_ENTRY}, field, value FROM omap"))
def q_map_columns(spark, d):
    return _rows(spark, d, "columns")


@register("column_field_log", _phase_sql(
    'SELECT DISTINCT dataset, resource, "column", field FROM omapc'))
def q_column_field_log(spark, d):
    return PH.column_field_log(TJ.staged(spark, d, "columns"))


@register("patch_values", _phase_sql(f"SELECT {_ENTRY}, field, value FROM opatch"))
def q_patch_values(spark, d):
    return _rows(spark, d, "patch")


@register("filter_entries", _phase_sql(f"SELECT {_ENTRY}, field, value FROM ofilter"))
def q_filter_entries(spark, d):
    return _rows(spark, d, "filter")


@register("concat_fields", _phase_sql(f"SELECT {_ENTRY}, field, value FROM oconcat"))
def q_concat_fields(spark, d):
    return _rows(spark, d, "concat")


@register("default_fields", _phase_sql(f"SELECT {_ENTRY}, field, value FROM odefault"))
def q_default_fields(spark, d):
    return _rows(spark, d, "default")


@register("default_values", _phase_sql(f"SELECT {_ENTRY}, field, value FROM ovaladd"))
def q_default_values(spark, d):
    iss = PH.entry_issues(TJ.staged(spark, d, "default_value"))
    return iss.where(F.col("issue_type") == "default-value").select(*PH.ENTRY, "field", "value")


@register("rename_fields", _phase_sql(f"SELECT {_ENTRY}, field, value FROM orename"))
def q_rename_fields(spark, d):
    return _rows(spark, d, "transform")


@register("assign_entities", _phase_sql(f"SELECT {_ENTRY}, field, value, entity FROM olookup"))
def q_assign_entities(spark, d):
    return _rows(spark, d, "lookup", with_entity=True)


@register("redirect_entities", _phase_sql(f"SELECT {_ENTRY}, field, value, entity FROM oent"))
def q_redirect_entities(spark, d):
    return TJ.rows(spark, d)


@register("transform_issues", _phase_sql(f"SELECT {_ISSUE_COLS} FROM oissues"))
def q_transform_issues(spark, d):
    return TJ.issues(spark, d)


@register("stack_issues", _phase_sql(f"SELECT {_ISSUE_COLS} FROM oissues"))
def q_stack_issues(spark, d):
    log = stored_once(TJ.issues(spark, d))  # read twice; the phases run once
    late = F.col("issue_type") == "unknown-entity"
    # a frame without the columns that are empty is stacked by name
    return PH.stack_issues(log.where(~late).drop("entry_date"), log.where(late))


@register("merge_issues", _phase_sql(f"SELECT {_ISSUE_COLS} FROM oissues"))
def q_merge_issues(spark, d):
    from gleaner.operators import package as PK
    log = stored_once(TJ.issues(spark, d))  # read three times; the phases run once
    patched = F.col("issue_type") == "patch"
    return PK.merge_issues(log.where(patched), log.where(~patched).drop("entry_date")).select(*PK.PACKAGE_COLUMNS["issue"])


@register("issue_counts", _phase_sql("""
SELECT dataset, issue_type, CAST(count(*) AS BIGINT) AS issues FROM oissues
GROUP BY dataset, issue_type"""))
def q_issue_counts(spark, d):
    return TJ.issues(spark, d).groupBy("dataset", "issue_type") \
        .agg(F.count(F.lit(1)).alias("issues"))


@register("transformed_facts", _phase_sql(f"""
SELECT DISTINCT sha256(CAST(entity AS VARCHAR) || '|' || field || '|' || value) AS fact,
       entry_date, entry_number, priority, resource FROM ofacts"""))
def q_transformed_facts(spark, d):
    return FA.make_fact_resources(TJ.facts_entries(spark, d), size=TJ.order_raw(spark, d).count())


@register("order_entities", _phase_sql("""
SELECT dataset, entity, max(CASE WHEN field = 'name' THEN value END) AS name,
       max(CASE WHEN field = 'typology' THEN value END) AS typology,
       max(CASE WHEN field = 'start_date' THEN value END) AS start_date
FROM (SELECT *, row_number() OVER (PARTITION BY dataset, entity, field
               ORDER BY priority, entry_date DESC, entry_number DESC,
                        sha256(CAST(entity AS VARCHAR) || '|' || field || '|' || value)) AS rn
      FROM ofacts) WHERE rn = 1
GROUP BY dataset, entity"""))
def q_order_entities(spark, d):
    # the phases are dearer than a sort by dates: they run once
    ents = FA.resolve_entities(TJ.facts_entries(spark, d), ranked=False)
    return ents.select("dataset", "entity", "name", "typology", "start_date")


@register("combine_values", with_ctes(["tin", "spec"], """
SELECT dataset, entity, 'status' AS field,
       string_agg(DISTINCT status, ';' ORDER BY status) AS value
FROM tin GROUP BY dataset, entity"""))
def q_combine_values(spark, d):
    cfg = ST.specification_dataset(spark, d).select(
        "dataset", F.lit("status").alias("field"), F.lit(";").alias("separator"))
    return PH.combine_values(ST.transformed_facts_input(spark, d), cfg)


# ----------------------------------------------------------------- expectations

from gleaner.operators import expectations as EX  # noqa: E402

ENTITY_EXPECTATIONS = [
    ("entities have a name", "name IS NULL", 0, 0),
    ("references are P-prefixed", "reference NOT LIKE 'P%'", 0, 0),
    ("entities carry json", "json IS NOT NULL", 1, None),
    ("organisation set", "organisation_entity IS NULL", 0, 0),
    ("few big parts", "name LIKE '%bolt%'", None, 10),
]


def _expectation_sql() -> str:
    parts = []
    for name, cond, lo, hi in ENTITY_EXPECTATIONS:
        lo_s = "NULL" if lo is None else str(lo)
        hi_s = "NULL" if hi is None else str(hi)
        m = f"CAST(count(*) FILTER (WHERE coalesce(({cond}), false)) AS BIGINT)"
        passed = (f"(({lo_s} IS NULL OR {m} >= {lo_s}) AND ({hi_s} IS NULL OR {m} <= {hi_s}))")
        cond_lit = cond.replace("'", "''")
        parts.append(f"SELECT '{name}' AS name, '{cond_lit}' AS condition, {m} AS matched, "
                     f"CAST({lo_s} AS BIGINT) AS min_count, CAST({hi_s} AS BIGINT) AS max_count, "
                     f"{passed} AS passed FROM ents")
    return "\nUNION ALL\n".join(parts)


@register("check_expectations", with_ctes(["ents"], _expectation_sql()))
def q_check_expectations(spark, d):
    ents = FA.resolve_entities(ST.transformed_entries(spark, d))
    return EX.check_expectations(ents, EX.expectations_table(spark, ENTITY_EXPECTATIONS))


@register("project_fixed", with_ctes(["tfact"], """
SELECT max(entity) AS entity, fact, max(field) AS field, max(entry_date) AS entry_date, min(priority) AS priority,
       CASE WHEN max(field) = 'organisation_entity' THEN max(value) END AS reference_entity, max(value) AS value
FROM tfact GROUP BY fact"""))
def q_project_fixed(spark, d):
    from gleaner.operators import package as PK
    wide = FA.make_facts(ST.transformed_entries(spark, d), keep_dataset=True)
    return PK.project_fixed(wide.withColumn("unused", F.lit(1)), "fact")


@register("summarise_results", with_ctes(["tasks", "clog"], """
SELECT CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS successful, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS failed
FROM (SELECT t.resource IN (SELECT resource FROM clog WHERE resource IS NOT NULL) AS ok FROM tasks t)"""))
def q_summarise_results(spark, d):
    from gleaner.operators.batch import summarise_results
    present = ST.collection_log(spark, d).where(F.col("resource").isNotNull()).select("resource")
    missing = SEL.missing_resources(_tasks(spark, d), present).select("old_resource", "dataset", "error")
    results = _tasks(spark, d).join(missing, ["old_resource", "dataset"], "left")
    return summarise_results(results.select(F.col("old_resource").alias("resource"), F.col("error").isNull().alias("ok")))


@register("dedup_manifest", with_ctes(["docs"], """
SELECT 'https://files.example.org/' || source AS url, arg_max('doc/' || CAST(doc_id AS VARCHAR), doc_id) AS path
FROM docs GROUP BY source"""))
def q_dedup_manifest(spark, d):
    man = ST.docs(spark, d).select(
        F.concat(F.lit("https://files.example.org/"), "source").alias("url"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), "doc_id")
    return M.dedup_manifest(man, "doc_id")


@register("table_counts", with_ctes(["ents", "tfact"], """
SELECT 'entity' AS "table", CAST(count(*) AS BIGINT) AS rows FROM ents
UNION ALL SELECT 'fact', CAST(count(DISTINCT fact) AS BIGINT) FROM tfact
UNION ALL SELECT 'fact_resource', CAST(count(*) AS BIGINT)
  FROM (SELECT DISTINCT fact, entry_date, entry_number, priority, resource FROM tfact)"""))
def q_table_counts(spark, d):
    from gleaner.operators import package as PK
    t = ST.transformed_entries(spark, d)
    ranks = FA.rank_dates(t)
    return PK.table_counts({"entity": FA.resolve_entities(t, ranks), "fact": FA.make_facts(t, ranks=ranks),
                            "fact_resource": FA.make_fact_resources(t, ranks=ranks)})


# ----------------------------------------------------------------- collection config, logs

@register("collection_datasets", with_ctes(["spec"],
          "SELECT DISTINCT dataset FROM spec WHERE collection = 'part'"))
def q_collection_datasets(spark, d):
    return C.collection_datasets(ST.specification_dataset(spark, d), "part")


@register("refill_today", with_ctes(["clog"], """
SELECT endpoint, resource, entry_date, status FROM clog
WHERE entry_date <= (SELECT max(entry_date) FROM clog)"""))
def q_refill_today(spark, d):
    # the stored index holds a stale copy of the last day; refilling replaces
    # it with that day's fresh rows, giving back the whole log
    log = ST.collection_log(spark, d)
    today = log.agg(F.max("entry_date").alias("t")).first()["t"]
    stale = log.where(F.col("entry_date") == F.lit(today)).withColumn("status", F.lit("stale"))
    stored = log.where(F.col("entry_date") < F.lit(today)).unionByName(stale)
    todays = log.where(F.col("entry_date") == F.lit(today))
    return C.refill_today(stored, todays, str(today))


@register("provenance_log", with_ctes(["tasks"], """
SELECT DISTINCT dataset, old_resource AS resource, '0.1.0' AS code_version,
       'config-1' AS config_hash, 'specification-1' AS specification_hash,
       '2024-02-01' AS entry_date
FROM tasks"""))
def q_provenance_log(spark, d):
    tasks = _tasks(spark, d).select("dataset", F.col("old_resource").alias("resource")).distinct()
    return PH.provenance_log(tasks, ST.CODE_VERSION, ST.CONFIG_HASH, ST.SPECIFICATION_HASH,
                             "2024-02-01")


# ----------------------------------------------------------------- raw formats

_RAW_JSON = """
SELECT o_orderkey + 1 AS entry_number, unnest(['OrderKey', 'Customer', 'Status', 'Priority']) AS "column",
       unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority]) AS value
FROM orders"""


def _json_records(spark, d):
    rows = ST.raw_order_rows(spark, d)
    return rows.select("entry_number", F.to_json(F.struct("OrderKey", "Customer", "Status", "Priority")).alias("record"))


@register("raw_json_cells", f"""
SELECT * FROM ({_RAW_JSON}) WHERE entry_number % 11 <> 0
UNION ALL SELECT o_orderkey + 1, NULL, 'not a JSON object' FROM orders WHERE (o_orderkey + 1) % 11 = 0""")
def q_raw_json_cells(spark, d):
    # every eleventh line is cut off in its midst
    record = F.when(F.col("entry_number") % 11 == 0, F.expr("left(record, length(record) - 3)")).otherwise(F.col("record"))
    lines = _json_records(spark, d).select("entry_number", RAW.json_cells(record).alias("cells"))
    rejected = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit("not a JSON object").alias("value")))
    return lines.select("entry_number", F.explode(F.coalesce("cells", rejected)).alias("c")).select("entry_number", "c.*")


@register("raw_json_documents", f"""
SELECT entry_number, 'features' AS form, CAST(1 AS BIGINT) AS place, "column", value FROM ({_RAW_JSON})
UNION ALL SELECT o_orderkey + 1, 'features', 1, 'geometry', '{{"type":"Point","coordinates":[' || o_custkey || ',1]}}' FROM orders
UNION ALL SELECT entry_number, 'array', 2, "column", value FROM ({_RAW_JSON})
UNION ALL SELECT o_orderkey + 1, 'array', 1, NULL, NULL FROM orders""")
def q_raw_json_documents(spark, d):
    # each order as a feature collection, and as an array whose first element is no object
    records = _json_records(spark, d)
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.get_json_object("record", "$.Customer"), F.lit(",1]}"))
    features = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":'), "record",
                        F.lit(',"geometry":'), point, F.lit("}]}"))
    docs = records.select("entry_number", F.explode(F.array(
        F.struct(F.lit("features").alias("form"), features.alias("text")),
        F.struct(F.lit("array").alias("form"), F.concat(F.lit("[5, "), "record", F.lit("]")).alias("text")))).alias("d"))
    each = docs.select("entry_number", "d.form", F.posexplode(RAW.json_document_cells(F.col("d.text"))).alias("_at", "cells"))
    return each.select("entry_number", "form", (F.col("_at") + 1).cast("bigint").alias("place"), F.explode_outer("cells").alias("c")).select(
        "entry_number", "form", "place", "c.*")

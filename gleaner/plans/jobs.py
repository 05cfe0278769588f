"""End-to-end jobs (W1-W9) composed from the operators, over real inputs.

Each job is a function of DataFrames (and paths for writers); nothing here
is specific to the driver's stand-in tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import collection as C
from gleaner.operators import expectations as EX
from gleaner.operators import facts as FA
from gleaner.operators import manifest as M
from gleaner.operators import package as PK
from gleaner.operators import phases as PH
from gleaner.operators import selection as SEL
from gleaner.operators.joins import range_join
from gleaner.session import reliable_checkpoint


def plan_transform(dataset_resources: DataFrame, old_resource: DataFrame, log: DataFrame,
                   source: DataFrame, *, version_log: DataFrame | None = None,
                   versions: SEL.Versions | None = None, dataset: str | None = None,
                   offset: int | None = None, limit: int | None = None,
                   reprocess: bool = False, state: DataFrame | None = None,
                   collection_dir: str = "collection") -> DataFrame:
    """The task list (old_resource, dataset, resource, path, endpoints,
    organisations, entry_date)."""
    work = SEL.select_work(dataset_resources, version_log=version_log, versions=versions,
                           dataset=dataset, offset=offset, limit=limit, reprocess=reprocess,
                           state=state)
    resolved = SEL.filter_removed(SEL.resolve_redirect(work, old_resource))
    # only the log rows of the listed resources are aggregated
    listed = work.select("resource").distinct()
    tasks = C.enrich_pairs(resolved, C.resource_enrichment(log.join(listed, "resource", "left_semi"), source))
    return tasks.select("old_resource", "dataset", "resource",
                        F.concat(F.lit(collection_dir.rstrip("/") + "/resource/"), "resource")
                        .alias("path"), "endpoints", "organisations", "entry_date")


def plan_resource_fetch(dataset_resources: DataFrame, old_resource: DataFrame, collection: str,
                        *, bucket: str | None = None, base_url: str | None = None,
                        **select_kwargs) -> DataFrame:
    """Raw resources to fetch (url, path), each once."""
    work = SEL.select_work(dataset_resources, **select_kwargs)
    res = SEL.filter_removed(SEL.resolve_redirect(SEL.distinct_resources(work), old_resource))
    return M.dedup_manifest(M.resource_manifest(res, collection, bucket, base_url))


def plan_artefact_fetch(dataset_resources: DataFrame, old_resource: DataFrame, collection: str,
                        *, bucket: str | None = None, base_url: str | None = None,
                        dataset: str | None = None, offset: int | None = None,
                        limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Artefacts to fetch for a slice of pairs (retired ones dropped
    after slicing) and the files-per-task figure."""
    if not bucket and not base_url:
        raise ValueError("Either bucket or base_url must be provided")
    pairs = SEL.slice_pairs(SEL.build_pairs(dataset_resources, dataset), offset, limit, dataset)
    live = SEL.anti_retired(pairs.select("dataset", "resource"), old_resource)
    manifest = M.dedup_manifest(M.artefact_manifest(live, collection, bucket, base_url))
    return manifest, M.files_per_task(manifest, live)


def plan_log_fetch(dataset_resources: DataFrame, stored_logs: DataFrame, collection: str, *,
                   bucket: str | None = None, base_url: str | None = None,
                   dataset: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Version logs per pair, reconciled with what is stored; returns
    (reconciled manifest, downloaded/not_found counts)."""
    pairs = SEL.build_pairs(dataset_resources, dataset)
    expected = M.log_manifest(pairs, collection, bucket, base_url)
    stored = M.log_manifest(stored_logs.select("dataset", "resource"), collection, bucket, base_url)
    rec = M.reconcile_manifest(expected, stored)
    return rec, M.summarise_manifest(rec)


def build_package(spark: SparkSession, dataset: str, parquet_root: str, out_root: str,
                  collection_root: str | None = None, collection: str | None = None,
                  spec_dataset: DataFrame | None = None) -> DataFrame:
    """Read the seven tables of a dataset and write its package;
    returns the row counts."""
    from gleaner.sources.files import dataset_entity_range
    rng = dataset_entity_range(spec_dataset, dataset) if spec_dataset is not None else None
    tables = PK.build_package(spark, dataset, parquet_root, collection_root, collection, rng)
    return PK.write_package(tables, out_root, dataset)


def fill_organisations(entities: DataFrame, entity_organisation: DataFrame) -> DataFrame:
    """Entities without an organisation get the one whose entity range
    (dataset, entity_minimum, entity_maximum, organisation; a dataset column
    is optional) holds them; of several, the least name."""
    ranges = entity_organisation.select(
        *(["dataset"] if "dataset" in entity_organisation.columns else []),
        F.col("entity_minimum").try_cast("bigint").alias("entity_minimum"),
        F.col("entity_maximum").try_cast("bigint").alias("entity_maximum"), F.col("organisation").alias("_org"))
    ranges = ranges.where("entity_minimum <= entity_maximum")
    keys = entities.where(F.col("organisation_entity").isNull()).select("dataset", "entity")
    found = range_join(keys, "entity", ranges.withColumnRenamed("dataset", "_d") if "dataset" in ranges.columns else ranges)
    if "_d" in found.columns:
        found = found.where("_d = '' or _d is null or _d = dataset")
    found = found.groupBy("dataset", "entity").agg(F.min("_org").alias("_org"))
    return (entities.join(found, ["dataset", "entity"], "left")
            .withColumn("organisation_entity", F.coalesce("organisation_entity", "_org")).select(*entities.columns))


class Assembled(NamedTuple):
    entity: DataFrame
    fact: DataFrame
    fact_resource: DataFrame
    flattened: DataFrame
    expectations: DataFrame


def assemble(transformed: DataFrame, expectations: DataFrame | None = None,
             flatten_keys: list[str] | None = None,
             entity_organisation: DataFrame | None = None) -> Assembled:
    """Transformed rows -> facts, fact_resource, resolved entities,
    flattened entities and expectation results. Write the outputs with
    :mod:`gleaner.operators.package` (persist ``entity`` first when all
    outputs are written in one run)."""
    ranks = FA.rank_dates(transformed)
    ent = FA.resolve_entities(transformed, ranks)
    if entity_organisation is not None:
        ent = fill_organisations(ent, entity_organisation)
    exp = EX.check_expectations(ent, expectations) if expectations is not None else None
    return Assembled(ent, FA.make_facts(transformed, ranks=ranks), FA.make_fact_resources(transformed, ranks=ranks),
                     FA.flatten_entities(ent, flatten_keys), exp)


def update_built(transformed: DataFrame, done: DataFrame, stored: dict[str, DataFrame],
                 entity_organisation: DataFrame | None = None) -> dict[str, DataFrame]:
    """The built tables after a batch, all of the batch's datasets.

    ``transformed``: the rows of those datasets, the batch's included; ``done``:
    the batch's (dataset, resource) pairs; ``stored``: the ``entity``, ``fact``
    and ``fact_resource`` rows of those datasets before the batch. Touched are
    the entities that the pairs' rows name now and those that their stored facts
    named before. Only these are resolved anew, from all their rows; the others
    keep their stored rows."""
    before = (stored["fact"].join(stored["fact_resource"].join(done, ["dataset", "resource"], "left_semi").select("dataset", "fact"),
                                  ["dataset", "fact"], "left_semi").select("dataset", "entity"))
    touched = reliable_checkpoint(transformed.join(done, ["dataset", "resource"], "left_semi").select("dataset", "entity").unionByName(before).distinct())
    rows = transformed.join(touched, ["dataset", "entity"], "left_semi")
    ranks = FA.rank_dates(rows)
    entity = FA.resolve_entities(rows, ranks)
    if entity_organisation is not None:
        entity = fill_organisations(entity, entity_organisation)
    stale = stored["fact"].join(touched, ["dataset", "entity"], "left_semi").select("dataset", "fact").distinct()
    new = {"entity": (entity, touched, ["dataset", "entity"]), "fact": (FA.make_facts(rows, keep_dataset=True, ranks=ranks), touched, ["dataset", "entity"]),
           "fact_resource": (FA.make_fact_resources(rows, keep_dataset=True, ranks=ranks), stale, ["dataset", "fact"])}
    return {name: stored[name].join(gone, keys, "left_anti").select(*df.columns).unionByName(df) for name, (df, gone, keys) in new.items()}


def collect_index(log: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resource index and dataset -> resource table from the log."""
    return C.resource_index(log, source), C.dataset_resource_map(log, source)


def task_rows(raw: DataFrame, tasks: DataFrame) -> DataFrame:
    """Raw rows of the resources a task list names, one copy per task.

    ``raw`` is keyed by the stored (redirect target) resource id; the rows
    come back under the task's dataset and keyed by the *listed* (old)
    resource id, so every output of a redirected resource is filed under the
    id the work list used. A resource used by several datasets is read once
    and fanned out by the join."""
    t = tasks.select(F.col("resource").alias("_stored"), "dataset",
                     F.col("old_resource").alias("_listed")).distinct()
    return (raw.join(t, raw["resource"] == t["_stored"])
            .drop("resource", "_stored").withColumnRenamed("_listed", "resource"))


class Transformed(NamedTuple):
    rows: DataFrame          # long rows with entity (kept entries)
    issues: DataFrame        # issue log of the batch
    column_field: DataFrame  # column -> field log
    facts_input: DataFrame   # rows for fact creation


def transform(raw: DataFrame, columns: list[str], configs: dict[str, DataFrame],
              lookup: DataFrame, old_entity: DataFrame, priority=None,
              combine: DataFrame | None = None) -> Transformed:
    """Every resource of a batch through the phases at once.

    ``raw``: (dataset, resource, entry_number, <columns>) text rows;
    ``configs``: the long config tables by name (see
    :mod:`gleaner.operators.phases`); ``lookup``: (prefix, reference,
    entity); ``old_entity``: (old_entity, entity, status)."""
    cfg = PH.dataset_config(raw.sparkSession, configs)
    return transform_entries(PH.to_entries(raw, columns, cfg), lookup, old_entity, priority, combine)


def transform_cells(cells: DataFrame, configs: dict[str, DataFrame], lookup: DataFrame,
                    old_entity: DataFrame, priority=None, combine: DataFrame | None = None,
                    store=None) -> Transformed:
    """W6 over rows of (dataset, resource, entry_number, cells), e.g. raw
    resources with differing headers read by
    :func:`gleaner.sources.files.scan_raw_cells` and :func:`task_rows`."""
    cfg = PH.dataset_config(cells.sparkSession, configs)
    return transform_entries(PH.cells_to_entries(cells, cfg), lookup, old_entity, priority, combine, store)


def transform_entries(e: DataFrame, lookup: DataFrame, old_entity: DataFrame,
                      priority=None, combine: DataFrame | None = None, store=None) -> Transformed:
    """The phases in order. ``combine`` (dataset, field, separator) merges the
    values that several entries of a resource give one (entity, field).
    ``store`` (a function of a DataFrame that writes it and reads it back)
    materialises the staged entries once, for callers that write several of
    the outputs."""
    for step in (PH.map_columns, PH.patch_values, PH.filter_entries, PH.concat_fields, PH.default_fields,
                 PH.default_values, PH.rename_fields):
        e = step(e)
        if step is PH.map_columns:  # the log shows the fields as mapped
            e = e.withColumn("mapped", F.expr("transform(st.fields, x -> struct(x.column, x.field))"))
    e = PH.redirect_entities(PH.assign_entities(e, lookup), old_entity)
    e = e.select(*PH.ENTRY, "entity", "st", "mapped")
    if store is not None:
        e = store(e)
    prio = priority if priority is not None else F.lit(1)
    facts = PH.facts_input(e, prio)
    if combine is not None:
        facts = PH.combine_facts(facts, combine)
    column_field = e.select("dataset", "resource", F.explode("mapped").alias("m")).select("dataset", "resource", "m.*").distinct()
    return Transformed(PH.entry_rows(e, with_entity=True), PH.entry_issues(e), column_field, facts)


def nightly(log: DataFrame, source: DataFrame, old_resource: DataFrame, raw: DataFrame,
            columns: list[str], configs: dict[str, DataFrame], lookup: DataFrame,
            old_entity: DataFrame, *, version_log: DataFrame | None = None,
            versions: SEL.Versions | None = None, reprocess: bool = False,
            expectations: DataFrame | None = None, combine: DataFrame | None = None,
            entity_organisation: DataFrame | None = None) -> dict[str, DataFrame]:
    """Collect index -> work selection -> transform of the selected
    resources' raw rows -> assembled dataset tables. ``raw`` is keyed by the
    stored resource; a redirected resource's rows are those of its target,
    filed under the listed id. All lazy; the caller writes what it needs."""
    index, ds_res = collect_index(log, source)
    tasks = plan_transform(ds_res, old_resource, log, source, version_log=version_log,
                           versions=versions, reprocess=reprocess)
    if "dataset" in raw.columns:  # a resource's rows are the same for all its datasets
        raw = raw.drop("dataset").dropDuplicates(["resource", "entry_number"])
    t = transform(task_rows(raw, tasks), columns, configs, lookup, old_entity, combine=combine)
    a = assemble(t.facts_input, expectations, entity_organisation=entity_organisation)
    return {"resource_index": index, "tasks": tasks, "issues": t.issues,
            "column_field": t.column_field, "entity": a.entity, "fact": a.fact,
            "fact_resource": a.fact_resource, "flattened": a.flattened,
            **({"expectations": a.expectations} if a.expectations is not None else {})}

"""Transform phases over every resource of a batch at once.

An *entry* (one raw row of one resource) travels as one row:

    dataset, resource, entry_number, cfg_* (its dataset's config), entity,
    st = struct(fields ARRAY<STRUCT<column, field, value>>,
                issues ARRAY<STRUCT<field, issue_type, value, message>>,
                keep BOOLEAN)

Each phase is a column expression over that row (Spark higher-order
functions, JVM-side), driven by the dataset's config, which is joined once
per entry from a small per-dataset table (one row per dataset; Spark
broadcasts it when its size estimate or AQE's runtime size is under the
broadcast threshold). No phase re-reads its input, so chaining phases never
duplicates the plan, and an entry is bounded by its column count, so no
group can grow with the data. Issues are appended to the entry and
exploded once at the end; entries dropped by a filter keep the issues
raised before the filter (``keep`` = false).

Config tables (long, as stored in CSV; each may also carry a ``resource``
column scoping a row to one resource):
  column(dataset, column, field)          skip(dataset, pattern)
  patch(dataset, field, pattern, replacement)
  filter(dataset, field, pattern)         concat(dataset, field, fields ';', separator)
  default(dataset, field, default_field)  default_value(dataset, field, value)
  transform(dataset, field, replacement_field)   prefix(dataset, prefix)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.facts import _packed_id, _unpacked_id
from gleaner.schemas import ISSUE_FIELDS

ENTRY = ["dataset", "resource", "entry_number"]
_FIELD_T = "struct<column:string,field:string,value:string>"
_ISSUE_T = "struct<field:string,issue_type:string,value:string,message:string>"


# -------------------------------------------------------------- config

# Config columns read per phase, besides ``dataset`` and two optional ones:
# ``resource`` (rows with a resource apply to that resource only; for keyed
# configs they take precedence over the dataset-wide rows of the same key)
# and ``seq`` (a number that orders a phase's rows; rows without one follow
# in order of their values).
_CFG_SHAPES = {
    "column": ["column", "field"],
    "skip": ["pattern"],
    "patch": ["field", "pattern", "replacement"],
    "filter": ["field", "pattern"],
    "concat": ["field", "fields", "separator"],
    "default": ["field", "default_field"],
    "default_value": ["field", "value"],
    "transform": ["field", "replacement_field"],
    "prefix": ["prefix"],
}

# configs looked up by one key per entry field become maps: key
# "<resource>\x01<key>" ('' for dataset-wide rows) -> the ordered list of all
# rows of the key (equal rows once).
_KEYED = {
    "column": ("column", "field"),
    "patch": ("field", ["pattern", "replacement"]),
    "transform": ("field", "replacement_field"),
}

_CFG_TYPES = {
    "column": "map<string,array<string>>",
    "skip": "array<struct<resource:string,pattern:string>>",
    "patch": "map<string,array<struct<pattern:string,replacement:string>>>",
    "filter": "array<struct<resource:string,field:string,pattern:string>>",
    "concat": "array<struct<resource:string,field:string,parts:array<string>,separator:string>>",
    "default": "array<struct<resource:string,field:string,default_field:string>>",
    "default_value": "array<struct<resource:string,field:string,value:string>>",
    "transform": "map<string,array<string>>",
    "prefix": "string",
}


def dataset_config(spark, configs: dict[str, DataFrame]) -> DataFrame:
    """Fold the long config tables into one row per dataset holding an array
    or map per phase (``cfg_<name>``) and the dataset's prefix: one union,
    one aggregation. The result is as small as the configs."""
    width, text = 3, "string"
    payload = [f"_c{i}" for i in range(width)]
    list_t = "array<struct<_c0:string,_c1:string>>"
    rows = []
    for name, df in configs.items():
        shape = _CFG_SHAPES[name]
        res = F.coalesce(F.trim(F.col("resource")), F.lit("")) if "resource" in df.columns \
            else F.lit("")
        seq = F.coalesce(F.col("seq").try_cast("bigint"), F.lit((1 << 63) - 1)) if "seq" in df.columns \
            else F.lit((1 << 63) - 1)
        cols = [F.col(c).cast(text) if c in df.columns else F.lit(None).cast(text) for c in shape]
        kind = F.lit(name).alias("_kind")
        if name in _KEYED:
            key = F.concat(res, F.lit("\u0001"), cols[0])
            values = (cols[1:] + [F.lit(None).cast(text)])[:2]
            d = df.select("dataset", key.alias("_key"), F.struct(
                seq.alias("_seq"), values[0].alias("_c0"), values[1].alias("_c1")).alias("_v"))
            d = d.where(F.col("_key").isNotNull()).groupBy("dataset", "_key").agg(F.array_sort(F.collect_list("_v")).alias("_v"))
            listed = F.array_distinct(F.transform("_v", lambda v: F.struct(v["_c0"].alias("_c0"), v["_c1"].alias("_c1"))))
            rows.append(d.select("dataset", kind, F.lit("").alias("_res"), "_key", F.lit(0).cast("bigint").alias("_seq"),
                                 listed.alias("_list"), *[F.lit(None).cast(text).alias(c) for c in payload]))
        else:
            cols += [F.lit(None).cast(text)] * (width - len(cols))
            rows.append(df.select("dataset", kind, res.alias("_res"), F.lit(None).cast(text).alias("_key"),
                                  seq.cast("bigint").alias("_seq"), F.lit(None).cast(list_t).alias("_list"),
                                  *[c.alias(n) for c, n in zip(cols, payload)]))
    u = reduce(lambda a, b: a.unionByName(b), rows)
    aggs = []
    for name in configs:
        shape = _CFG_SHAPES[name]
        is_kind = F.col("_kind") == name
        if name == "prefix":
            aggs.append(F.max(F.when(is_kind, F.col("_c0"))).alias("cfg_prefix"))
        elif name in _KEYED:
            v = F.transform("_list", lambda x: x["_c0"]) if len(shape) == 2 else F.transform(
                "_list", lambda x: F.struct(x["_c0"].alias("pattern"), x["_c1"].alias("replacement")))
            aggs.append(F.map_from_entries(F.collect_list(F.when(is_kind, F.struct(F.col("_key"), v))))
                        .alias(f"cfg_{name}"))
        else:
            ordered = F.array_sort(F.collect_list(F.when(is_kind, F.struct("_seq", "_res", *payload))))
            aggs.append(_listed(ordered, name).alias(f"cfg_{name}"))
    out = u.groupBy("dataset").agg(*aggs)
    for name, t in _CFG_TYPES.items():
        if f"cfg_{name}" not in out.columns:
            out = out.withColumn(f"cfg_{name}", F.lit(None).cast(t))
    return out


# Phases whose config holds patterns, and the most config rows with patterns.
_PATTERNS = ("skip", "patch", "filter")
MAX_PATTERNS = 100_000


def invalid_patterns(spark, configs: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(dataset, resource or '', message) of the config rows whose pattern is
    no regular expression. Patterns are a bounded config, compiled here once;
    left in a phase, one of them would fail every resource of the batch."""
    found = []
    for name in _PATTERNS:
        if name not in configs:
            continue
        df = configs[name]
        res = F.coalesce(F.trim(F.col("resource")), F.lit("")) if "resource" in df.columns else F.lit("")
        rows = df.where("pattern is not null").select("dataset", res.alias("resource"), "pattern").distinct().limit(MAX_PATTERNS + 1).collect()
        if len(rows) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} patterns in the {name} config")
        for r in rows:
            try:
                spark._jvm.java.util.regex.Pattern.compile(r["pattern"])
            except Exception:  # noqa: BLE001 - any refusal of the JVM
                found.append((r["dataset"], r["resource"], f"{name}: invalid pattern {r['pattern']}"))
    return sorted(set(found), key=str)


def _listed(ordered: Column, name: str) -> Column:
    """Ordered payload structs -> the phase's own structs."""
    def row(v: Column) -> Column:
        if name == "concat":
            return F.struct(v["_res"].alias("resource"), v["_c0"].alias("field"),
                            F.split(v["_c1"], ";").alias("parts"), v["_c2"].alias("separator"))
        return F.struct(v["_res"].alias("resource"),
                        *[v[f"_c{i}"].alias(c) for i, c in enumerate(_CFG_SHAPES[name])])
    return F.transform(ordered, row)


def attach_config(entries: DataFrame, cfg: DataFrame) -> DataFrame:
    return entries.join(cfg, "dataset", "left")


# -------------------------------------------------------------- entry state
#
# The entry state ``st`` = struct(fields, issues, keep). Each phase rewrites
# it through ``element_at(transform(array(st), s -> ...), 1)``: the previous
# state is referenced once and bound to the lambda variable ``s``, so the
# optimizer never copies a phase's expression into several places of the
# next one (which would double the per-row work at every phase).

_EMPTY_FIELDS = f"cast(array() as array<{_FIELD_T}>)"
_EMPTY_ISSUES = f"cast(array() as array<{_ISSUE_T}>)"


def _cfg(name: str) -> str:
    return f"coalesce(cfg_{name}, array())"


def _lookup(name: str, key: str) -> str:
    """All config rows of ``key``, in order: the entry's resource-specific
    ones, else the dataset-wide ones, else NULL."""
    return (f"coalesce(try_element_at(cfg_{name}, concat(resource, '\\u0001', {key})), "
            f"try_element_at(cfg_{name}, concat('\\u0001', {key})))")


def _applies(var: str) -> str:
    """A config row applies to the entry: dataset-wide or for its resource."""
    return f"({var}.resource = '' OR {var}.resource = resource)"


def _let(expr: str, var: str, body: str) -> str:
    return f"element_at(transform(array({expr}), {var} -> {body}), 1)"


def _phase(e: DataFrame, body: str) -> DataFrame:
    """st <- body(s) with ``s`` bound to the current state."""
    return e.withColumn("st", F.expr(_let("st", "s", body)))


def _state(fields: str = "s.fields", issues: str = "s.issues", keep: str = "s.keep") -> str:
    return f"named_struct('fields', {fields}, 'issues', {issues}, 'keep', {keep})"


def _value_of(fields: str, field: str) -> str:
    return f"try_element_at(filter({fields}, x -> x.field = {field}), 1).value"


def _issues_for(arr: str, issue_type: str, message: str) -> str:
    return (f"transform({arr}, a -> named_struct('field', a.field, 'issue_type', '{issue_type}', "
            f"'value', a.value, 'message', '{message}'))")


# -------------------------------------------------------------- T1 skip + entries

def to_entries(raw: DataFrame, columns: list[str], cfg: DataFrame) -> DataFrame:
    """Raw wide rows -> entries with their dataset config attached; rows
    matching a skip pattern of their dataset are dropped; empty cells are
    no value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                      for c in columns])
    return cells_to_entries(raw.select(*ENTRY, cells.alias("cells")), cfg)


def cells_to_entries(df: DataFrame, cfg: DataFrame) -> DataFrame:
    """Rows of (dataset, resource, entry_number, cells ARRAY<STRUCT<column,
    value>>) -> entries (see :func:`gleaner.sources.files.scan_raw_cells`
    for resources whose headers differ)."""
    line = F.array_join(F.transform("cells", lambda c: F.coalesce(c["value"], F.lit(""))), ",")
    e = attach_config(df.select(*ENTRY, line.alias("_line"), F.col("cells").alias("_f")), cfg)
    e = e.where(F.expr(f"NOT exists({_cfg('skip')}, k -> {_applies('k')} AND _line rlike k.pattern)"))
    kept = F.transform(F.filter("_f", lambda x: x["value"].isNotNull() & (F.trim(x["value"]) != "")),
                       lambda x: F.struct(x["column"].alias("column"),
                                          F.lit(None).cast("string").alias("field"),
                                          x["value"].alias("value")))
    st = F.struct(kept.alias("fields"), F.expr(_EMPTY_ISSUES).alias("issues"),
                  F.lit(True).alias("keep"))
    return e.withColumn("st", st).drop("_line", "_f")


# -------------------------------------------------------------- T2 column map

def map_columns(e: DataFrame) -> DataFrame:
    """column -> field by the dataset's column config (a column named in
    several rows fills several fields); unmapped columns keep their
    normalised name (lowercase, each run of non-alphanumerics becomes one
    underscore)."""
    mapped = (f"flatten(transform(s.fields, x -> transform(coalesce({_lookup('column', 'x.column')}, "
              f"array(lower(regexp_replace(x.column, '[^A-Za-z0-9]+', '_')))), "
              f"f -> named_struct('column', x.column, 'field', f, 'value', x.value))))")
    return _phase(e, _state(fields=mapped))


# -------------------------------------------------------------- T5 patch

def patch_values(e: DataFrame) -> DataFrame:
    """Rewrite values by the field's patch rules, in order: each rule whose
    pattern the value (as the rules before left it) matches; an issue for
    every rule that matched."""
    patched = (f"aggregate(coalesce({_lookup('patch', 'x.field')}, array()), "
               f"named_struct('v', x.value, 'old', cast(array() as array<string>)), "
               f"(a, p) -> CASE WHEN a.v rlike p.pattern THEN named_struct("
               f"'v', regexp_replace(a.v, p.pattern, p.replacement), 'old', concat(a.old, array(a.v))) ELSE a END)")
    pf = f"transform(s.fields, x -> named_struct('x', x, 'r', {patched}))"
    fields = ("transform(pf, y -> named_struct('column', y.x.column, 'field', y.x.field, 'value', y.r.v))")
    new = ("flatten(transform(pf, y -> transform(y.r.old, o -> named_struct('field', y.x.field, "
           "'issue_type', 'patch', 'value', o, 'message', 'value patched'))))")
    issues = f"CASE WHEN s.keep THEN concat(s.issues, {new}) ELSE s.issues END"
    return _phase(e, _let(pf, "pf", _state(fields=fields, issues=issues)))


# -------------------------------------------------------------- T4 filter

def filter_entries(e: DataFrame) -> DataFrame:
    """An entry whose value of a filtered field does not match the pattern
    is dropped (``keep`` = false; the issues raised before stay)."""
    keep = (f"s.keep AND NOT exists({_cfg('filter')}, f -> {_applies('f')} AND exists(s.fields, "
            f"x -> x.field = f.field AND NOT (x.value rlike f.pattern)))")
    body = _let(keep, "k", _state(fields=f"CASE WHEN k THEN s.fields ELSE {_EMPTY_FIELDS} END",
                                  keep="k"))
    return _phase(e, body)


# -------------------------------------------------------------- T3 concat

def concat_fields(e: DataFrame) -> DataFrame:
    """A field built by joining other fields' values (configured order,
    absent ones skipped) with a separator; it replaces an existing value."""
    built = (f"filter(transform(filter({_cfg('concat')}, c -> {_applies('c')}), c -> named_struct("
             f"'column', CAST(NULL AS STRING), 'field', c.field, "
             f"'value', CASE WHEN exists(c.parts, p -> exists(s.fields, x -> x.field = p)) "
             f"THEN array_join(filter(transform(c.parts, p -> {_value_of('s.fields', 'p')}), "
             f"v -> v IS NOT NULL), c.separator) END)), b -> b.value IS NOT NULL)")
    fields = "concat(filter(s.fields, x -> NOT exists(b, z -> z.field = x.field)), b)"
    return _phase(e, _let(built, "b", _state(fields=fields)))


# -------------------------------------------------------------- T6 / T7 defaults

def _add_fields(e: DataFrame, added: str, issue_type: str, message: str) -> DataFrame:
    fields = "CASE WHEN s.keep THEN concat(s.fields, a) ELSE s.fields END"
    issues = f"CASE WHEN s.keep THEN concat(s.issues, {_issues_for('a', issue_type, message)}) ELSE s.issues END"
    return _phase(e, _let(added, "a", _state(fields=fields, issues=issues)))


def default_fields(e: DataFrame) -> DataFrame:
    """An entry without a field takes the value of another of its fields."""
    added = (f"transform(filter({_cfg('default')}, d -> {_applies('d')} AND "
             f"NOT exists(s.fields, x -> x.field = d.field)"
             f" AND exists(s.fields, x -> x.field = d.default_field)), d -> named_struct("
             f"'column', CAST(NULL AS STRING), 'field', d.field, "
             f"'value', {_value_of('s.fields', 'd.default_field')}))")
    return _add_fields(e, added, "default-field", "value taken from another field")


def default_values(e: DataFrame) -> DataFrame:
    """An entry without a field takes a constant."""
    added = (f"transform(filter({_cfg('default_value')}, d -> {_applies('d')} AND NOT exists(s.fields, "
             f"x -> x.field = d.field)), d -> named_struct('column', CAST(NULL AS STRING), "
             f"'field', d.field, 'value', d.value))")
    return _add_fields(e, added, "default-value", "default value used")


# -------------------------------------------------------------- T11 field map

def rename_fields(e: DataFrame) -> DataFrame:
    fields = (f"flatten(transform(s.fields, x -> transform(coalesce({_lookup('transform', 'x.field')}, "
              f"array(x.field)), f -> named_struct('column', x.column, 'field', f, 'value', x.value))))")
    return _phase(e, _state(fields=fields))


# -------------------------------------------------------------- T8 lookup

def assign_entities(e: DataFrame, lookup: DataFrame, reference_field: str = "reference",
                    organisation_field: str = "organisation") -> DataFrame:
    """(dataset prefix, organisation, reference) -> entity through the lookup
    table: a row for the entry's organisation beats a prefix-wide row (empty
    organisation). Each is a left join on its key (a shuffle join when the
    lookup is large; repeated rows are reduced to the smallest entity first,
    so entries are never duplicated). Entries with a reference but no match
    keep a NULL entity and raise an 'unknown-entity' issue."""
    # both keys read from the state through one binding (one evaluation)
    keys = _let("st", "s", f"named_struct('r', {_value_of('s.fields', repr(reference_field))}, "
                           f"'o', {_value_of('s.fields', repr(organisation_field))})")
    e = e.withColumn("_k2", F.expr(keys))
    e = e.withColumn("_ref", F.col("_k2.r")).withColumn("_org", F.col("_k2.o")).drop("_k2")
    org = F.coalesce(F.trim(F.col("organisation")), F.lit("")) if "organisation" in lookup.columns \
        else F.lit("")
    lk = lookup.select("prefix", "reference", org.alias("_o"), "entity")
    general = (lk.where(F.col("_o") == "").groupBy("prefix", "reference")
               .agg(F.min("entity").alias("_ge"))
               .select(F.col("prefix").alias("_gp"), F.col("reference").alias("_gr"), "_ge"))
    j = e.join(general, (e["cfg_prefix"] == general["_gp"]) & (e["_ref"] == general["_gr"]), "left")
    if "organisation" in lookup.columns:
        specific = (lk.where(F.col("_o") != "").groupBy("prefix", "_o", "reference")
                    .agg(F.min("entity").alias("_se"))
                    .select(F.col("prefix").alias("_sp"), F.col("_o").alias("_so"),
                            F.col("reference").alias("_sr"), "_se"))
        j = j.join(specific, (j["cfg_prefix"] == specific["_sp"]) & (j["_org"] == specific["_so"])
                   & (j["_ref"] == specific["_sr"]), "left")
        j = j.withColumn("entity", F.coalesce("_se", "_ge")).drop("_sp", "_so", "_sr", "_se")
    else:
        j = j.withColumn("entity", F.col("_ge"))
    j = j.drop("_gp", "_gr", "_ge")
    unknown = (f"CASE WHEN s.keep AND _ref IS NOT NULL AND cfg_prefix IS NOT NULL AND entity IS NULL "
               f"THEN concat(s.issues, array(named_struct('field', '{reference_field}', "
               f"'issue_type', 'unknown-entity', 'value', _ref, "
               f"'message', 'no entity for this reference'))) ELSE s.issues END")
    return _phase(j, _state(issues=unknown)).drop("_ref", "_org")


# -------------------------------------------------------------- T9 old entity

def redirect_entities(e: DataFrame, old_entity: DataFrame) -> DataFrame:
    """301 entries move to the new entity; 410 entries are dropped. Keys are
    text in the config; bad numbers never match. Of several rows of one old
    entity the last (greatest ``seq``, where that column exists) counts."""
    order = (F.col("seq").cast("bigint") if "seq" in old_entity.columns else F.lit(0).cast("bigint")).alias("_seq")
    oe = old_entity.select(F.col("old_entity").try_cast("bigint").alias("_old"),
                           F.col("entity").try_cast("bigint").alias("_new"),
                           F.col("status").alias("_st"), order).where(F.col("_old").isNotNull())
    # one rule per old entity (repeated rows never duplicate entries): the last
    oe = oe.groupBy("_old").agg(F.max(F.struct("_seq", "_st", "_new")).alias("_r")) \
        .select("_old", F.col("_r._new").alias("_new"), F.col("_r._st").alias("_st"))
    j = e.join(oe, e["entity"] == F.col("_old"), "left")
    j = _phase(j, _state(keep="s.keep AND (_st IS NULL OR _st <> '410')"))
    return (j.withColumn("entity", F.when(F.col("_st") == "301", F.col("_new"))
                         .otherwise(F.col("entity")))
            .drop("_old", "_new", "_st"))


# -------------------------------------------------------------- outputs
#
# Outputs read the state through one reference as well: a filter on
# ``st.keep`` next to an explode of ``st.fields`` would make the optimizer
# copy the whole phase chain into the filter and evaluate it twice.

def _explode_state(body: str) -> Column:
    return F.explode(F.expr(_let("st", "s", body)))


def entry_rows(e: DataFrame, with_entity: bool = False) -> DataFrame:
    """Kept entries exploded to long rows (dataset, resource, entry_number,
    field, value[, entity])."""
    extra = ["entity"] if with_entity else []
    rows = _explode_state(f"CASE WHEN s.keep THEN s.fields ELSE {_EMPTY_FIELDS} END")
    return e.select(*ENTRY, *extra, rows.alias("f")).select(*ENTRY, "f.field", "f.value", *extra)


def column_field_log(e: DataFrame) -> DataFrame:
    return e.select("dataset", "resource", F.explode("st.fields").alias("f")) \
        .select("dataset", "resource", "f.column", "f.field").distinct()


def entry_issues(e: DataFrame) -> DataFrame:
    """The issue log: every entry's issues, exploded once."""
    ent = F.col("entity") if "entity" in e.columns else F.lit(None)
    return e.select(*ENTRY, ent.cast("bigint").alias("entity"),
                    F.explode("st.issues").alias("i")).select(
        "entity", F.lit(None).cast("string").alias("entry_date"),
        F.col("entry_number").cast("bigint").alias("entry_number"),
        F.col("i.field").alias("field"), F.col("i.issue_type").alias("issue_type"),
        (F.col("entry_number") + 1).cast("bigint").alias("line_number"),
        "dataset", "resource", F.col("i.value").alias("value"), F.col("i.message").alias("message"))


def stack_issues(*frames: DataFrame) -> DataFrame:
    """Union of issue frames (no de-duplication)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) \
        .select(*ISSUE_FIELDS)


def facts_entries(e: DataFrame, priority: Column) -> DataFrame:
    """Entries shaped for fact creation: each kept one with an entity, its
    start date as entry date and its ``fields`` as (field, value)."""
    body = (f"CASE WHEN s.keep AND entity IS NOT NULL THEN array(named_struct("
            f"'entry_date', {_value_of('s.fields', repr('start_date'))}, "
            f"'fields', transform(s.fields, x -> named_struct('field', x.field, 'value', x.value)))) END")
    resource = _unpacked_id("resource") if "_resource_raw" in e.columns else F.col("resource")
    return e.select("dataset", "entity", resource, "entry_number",
                    priority.cast("bigint").alias("priority"), _explode_state(body).alias("f")) \
        .select("dataset", "entity", "resource", "entry_number", F.col("f.entry_date").alias("entry_date"),
                "priority", F.col("f.fields").alias("fields"))


def facts_input(e: DataFrame, priority: Column) -> DataFrame:
    """The same as rows of one field each."""
    rows = facts_entries(e, priority)
    return rows.select(*[c for c in rows.columns if c != "fields"], F.inline("fields"))


def without_log(e: DataFrame) -> DataFrame:
    """Entries without the issues raised so far and without source columns, and
    with resources as bytes, for :func:`facts_entries`, which lists neither: a
    join that follows sends less. No phase with a config may follow."""
    fields = "transform(s.fields, x -> named_struct('field', x.field, 'value', x.value))"
    slim = _phase(e, _state(fields=fields, issues=_EMPTY_ISSUES))
    return slim.select(*[c for c in slim.columns if c != "resource"], *_packed_id("resource"))


# -------------------------------------------------------------- T10 combine

def combine_values(rows: DataFrame, combine_cfg: DataFrame) -> DataFrame:
    """Values of one (dataset, entity, field) across entries merged into one,
    sorted, distinct, joined by the separator (config: dataset, field,
    separator). Distinct values are formed first, so a hot entity shuffles
    each value once."""
    cfg = combine_cfg.select("dataset", "field", "separator")
    vals = rows.join(cfg, ["dataset", "field"]).select(
        "dataset", "entity", "field", "separator", "value").distinct()
    return vals.groupBy("dataset", "entity", "field", "separator").agg(
        F.sort_array(F.collect_list("value")).alias("_v")) \
        .select("dataset", "entity", "field", F.expr("array_join(_v, separator)").alias("value"))


def combine_facts(facts: DataFrame, combine_cfg: DataFrame) -> DataFrame:
    """Fact input with the values that several entries of one resource give a
    configured (dataset, field) of an entity merged into one: sorted,
    distinct, joined by the separator, dated as the latest of them. Distinct
    values are formed first, so what is gathered is a resource's own values
    of one entity and field."""
    cfg = combine_cfg.groupBy("dataset", "field").agg(F.min("separator").alias("separator"))
    keyed = facts.join(cfg, ["dataset", "field"], "left")
    plain = keyed.where(F.col("separator").isNull()).select(facts.columns)
    group = ["dataset", "entity", "resource", "field", "separator"]
    once = keyed.where(F.col("separator").isNotNull()).groupBy(*group, "value").agg(
        F.max("entry_number").alias("entry_number"), F.max("entry_date").alias("entry_date"), F.min("priority").alias("priority"))
    merged = once.groupBy(*group).agg(
        F.max("entry_number").alias("entry_number"), F.max("entry_date").alias("entry_date"), F.min("priority").alias("priority"),
        F.array_sort(F.collect_list("value")).alias("_v"))
    return plain.unionByName(merged.withColumn("value", F.expr("array_join(_v, separator)")).select(facts.columns))


# -------------------------------------------------------------- T18 provenance log

def provenance_log(pairs: DataFrame, code_version: str, config_hash: str,
                   specification_hash: str, entry_date: str) -> DataFrame:
    """dataset_resource rows recording the versions a pair was built with."""
    return pairs.select("dataset", "resource",
                        F.lit(code_version).alias("code_version"),
                        F.lit(config_hash).alias("config_hash"),
                        F.lit(specification_hash).alias("specification_hash"),
                        F.lit(entry_date).alias("entry_date"))

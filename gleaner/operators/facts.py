"""Facts and entities: transformed rows -> fact / fact_resource -> one
resolved ``entity`` row per entity, plus flattening, provenance and
incremental update.

Resolution is an aggregation, not a window: the winning observation of an
(entity, field) is a ``max``. Observations of one entity are dealt to one
partition first, in the columns that the aggregation reads. Hardly two rows of
a task are equal in their keys, so a table of groups on the map side would
fill the memory and spill without making the shuffle smaller; the rows of one
entry, which follow each other, compress well instead, and every later
aggregation by entity finds its rows in place.

Transformed rows come one per field (columns ``field`` and ``value``) or one per
entry (``fields``, an array of such structs). Entries are dealt whole and taken
apart where they are compared, so what an entry's rows share crosses the network
once. Steps that know how many there are deal them to as many parts as keep a
task's rows in memory, however many shuffle partitions the session has.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.selection import number_rows
from gleaner.schemas import PACKAGE_COLUMNS

# Entity-table columns that a field can fill directly; every other field goes
# into the entity's ``json``.
ENTITY_FIELD_COLUMNS = [c for c in PACKAGE_COLUMNS["entity"]
                        if c not in ("dataset", "entity", "json", "entry_date")]


def fact_id(entity, field, value) -> Column:
    """Content id of a fact: sha256 of ``entity|field|value``."""
    return F.sha2(F.concat_ws("|", F.col(entity).cast("string"), F.col(field), F.col(value)), 256)


def _packed_id(text: str) -> list[Column]:
    """A hex id as bytes, or as it is where it is no lower-case hex: two
    columns, from which :func:`_unpacked_id` gives the same text. Half the
    size, and ids do not compress."""
    raw = F.unhex(text)
    plain = F.lower(F.hex(raw)) == F.col(text)
    return [F.when(plain, raw).alias(f"_{text}_raw"), F.when(plain, None).otherwise(F.col(text)).alias(f"_{text}_text")]


def _unpacked_id(text: str) -> Column:
    return F.coalesce(f"_{text}_text", F.lower(F.hex(f"_{text}_raw"))).alias(text)


# Entries, or rows of one field each, that a part holds about.
ENTRIES_PER_PART = 200_000
ROWS_PER_PART = 1_000_000


def _payload(transformed: DataFrame) -> list[str | Column]:
    """What a deal sends of the fields: names and values of an entry apart, as
    names repeat from entry to entry and then compress to next to nothing."""
    if "fields" not in transformed.columns:
        return ["field", "value"]
    return [F.col("fields")["field"].alias("_names"), F.col("fields")["value"].alias("_values")]


def explode_fields(entries: DataFrame) -> DataFrame:
    """Entries as rows of one field each; rows of one field stay as they are."""
    kept = [c for c in entries.columns if c not in ("fields", "_names", "_values")]
    if "fields" in entries.columns:
        return entries.select(*kept, F.inline("fields"))
    if "_names" in entries.columns:
        return entries.select(*kept, F.inline(F.arrays_zip("_names", "_values")).alias("field", "value"))
    return entries


def _parts(transformed: DataFrame, size: int | None) -> int | None:
    """Parts for ``size`` rows or entries, where the session's shuffle
    partitions are too few for them."""
    each = ENTRIES_PER_PART if {"fields", "_names"} & set(transformed.columns) else ROWS_PER_PART
    parts = -(-(size or 0) // each)
    return parts if parts > int(transformed.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _deal(rows: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows of equal ``keys`` in one part."""
    return rows.repartition(*([parts] if parts else []), *keys)


def _placed(transformed: DataFrame) -> DataFrame:
    """Rows of one field with ``_place``, a hash of the text of the fact's id:
    rows of one fact share it, few others do."""
    text = F.concat_ws("|", F.col("entity").cast("string"), "field", "value")
    return explode_fields(transformed).withColumn("_place", F.hash(text))


# Bytes that a table of ranked entry dates may hold to be broadcast; a larger
# one is not used, dates are then compared as text.
MAX_RANKED_BYTES = 64 << 20


class DateRanks(NamedTuple):
    """The distinct entry dates of a table, numbered in the order of their
    texts (none first), the ranges of its priorities and entry numbers, and
    how many rows (or entries) it has."""
    table: DataFrame
    count: int
    text_bytes: int
    priorities: tuple[int, int] | None
    numbers: tuple[int, int] | None
    rows: int | None = None

    @property
    def small(self) -> bool:
        return self.text_bytes + 32 * self.count <= MAX_RANKED_BYTES

    @property
    def widths(self) -> tuple[int, int, int]:
        """Bits that hold a priority, a date rank and an entry number; the
        first and the last have a code for none beside those of their range."""
        span = [0 if r is None else r[1] - r[0] + 1 for r in (self.priorities, self.numbers)]
        return span[0].bit_length(), max(self.count - 1, 0).bit_length(), span[1].bit_length()

    @property
    def packs(self) -> bool:
        """A priority, a date rank and an entry number fit into one BIGINT."""
        return self.small and sum(self.widths) <= 63

    def encode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_rank``; a date that the ranks do not know is an error."""
        ranked = rows.join(F.broadcast(self.table), F.col("entry_date").eqNullSafe(F.col("_date")), "left")
        unknown = F.raise_error(F.lit("entry date without a rank")).cast("bigint")
        return ranked.withColumn("_rank", F.coalesce("_rank", unknown)).drop("_date")

    def decode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the ``entry_date`` of their ``_rank``."""
        return rows.join(F.broadcast(self.table), "_rank").withColumnRenamed("_date", "entry_date")


def rank_dates(transformed: DataFrame) -> DateRanks:
    """Number the entry dates of ``transformed``: one pass over three columns,
    then one row per distinct date. Ranks are exact for any text, and an
    aggregation over them is hash-based, which one over texts is not. Runs at
    once; the same ranks serve :func:`make_facts` and :func:`resolve_fields`."""
    seen = transformed.groupBy(F.col("entry_date").alias("_date")).agg(
        F.min("priority").alias("_p0"), F.max("priority").alias("_p1"),
        F.min("entry_number").alias("_n0"), F.max("entry_number").alias("_n1"), F.count(F.lit(1)).alias("_rows"))
    numbered, count = number_rows(seen, ["_date"], "_rank")
    r = numbered.agg(F.sum(F.octet_length("_date")), F.min("_p0"), F.max("_p1"),
                     F.min("_n0"), F.max("_n1"), F.sum("_rows")).first()
    return DateRanks(numbered.select("_date", "_rank"), count, r[0] or 0,
                     None if r[1] is None else (r[1], r[2]), None if r[3] is None else (r[3], r[4]), r[5] or 0)


def make_facts(transformed: DataFrame, keep_dataset: bool = False,
               ranks: DateRanks | None = None, ranked: bool = True, size: int | None = None,
               keep_place: bool = False) -> DataFrame:
    """fact table: one row per fact, with the best (lowest) priority and
    the latest entry date of its observations. ``reference_entity`` carries
    the value of ``organisation_entity`` facts (a pointer to another
    entity; ``keep_dataset`` adds the dataset, for a table partitioned by
    it). Entry dates are text and stay as they are: the latest is the
    greatest text, found by its rank. A fact is determined by (entity, field,
    value), so those are the grouping keys and the sha256 id is computed once
    per fact. ``ranked`` = False spares the pass for ranks, where dates are not
    read afterwards; ``size`` is then the number of rows or entries, where it is
    known. ``keep_place`` deals by ``_place`` and adds it, for
    :func:`fact_provenance`."""
    if ranks is None and ranked:
        ranks = rank_dates(transformed)
    parts = _parts(transformed, ranks.rows if ranks else size)
    if keep_place:
        transformed = _placed(transformed)
    shared = (["_place"] if keep_place else []) + (["dataset"] if keep_dataset else []) + ["entity"]
    keys, at = [*shared, "field", "value"], "_place" if keep_place else "entity"
    priority = F.min("priority").alias("priority")
    rows = transformed.select(*shared, "entry_date", "priority", *_payload(transformed))
    payload = rows.columns[len(shared) + 2:]
    if ranks is not None and ranks.small:
        rows = explode_fields(_deal(ranks.encode(rows).select(*shared, "_rank", "priority", *payload), parts, at))
        agg = ranks.decode(rows.groupBy(*keys).agg(F.max("_rank").alias("_rank"), priority))
    else:
        rows = explode_fields(_deal(rows, parts, at))
        agg = rows.groupBy(*keys).agg(F.max("entry_date").alias("entry_date"), priority)
    return agg.select(
        *shared, fact_id("entity", "field", "value").alias("fact"), "field",
        "entry_date", "priority",
        F.when(F.col("field") == "organisation_entity", F.col("value")).alias("reference_entity"),
        "value")


def _packed_merit(ranks: DateRanks) -> Column:
    """The same order as one BIGINT: the priority's distance from the worst
    one, the date's rank and the entry number side by side."""
    _, date_bits, number_bits = ranks.widths
    none = F.lit(0).cast("bigint")
    p = none if ranks.priorities is None else F.coalesce(F.lit(ranks.priorities[1]) - F.col("priority") + 1, none)
    n = none if ranks.numbers is None else F.coalesce(F.col("entry_number") - F.lit(ranks.numbers[0]) + 1, none)
    return (F.shiftleft(F.shiftleft(p.cast("bigint"), date_bits).bitwiseOR(F.col("_rank")), number_bits)
            .bitwiseOR(n.cast("bigint")))


def _unpacked_merit(ranks: DateRanks) -> tuple[Column, Column, Column]:
    """Priority, date rank and entry number of a ``_m`` that
    :func:`_packed_merit` made."""
    _, date_bits, number_bits = ranks.widths
    m = F.col("_m")
    p, n = F.shiftright(m, date_bits + number_bits), m.bitwiseAND(F.lit((1 << number_bits) - 1))
    none = F.lit(None).cast("bigint")
    return (none if ranks.priorities is None else F.when(p != 0, F.lit(ranks.priorities[1] + 1) - p),
            F.shiftright(m, number_bits).bitwiseAND(F.lit((1 << date_bits) - 1)),
            none if ranks.numbers is None else F.when(n != 0, n + F.lit(ranks.numbers[0] - 1)))


def make_fact_resources(transformed: DataFrame, keep_dataset: bool = False, ranks: DateRanks | None = None,
                        size: int | None = None, keep_place: bool = False) -> DataFrame:
    """fact_resource table: each (fact, resource, entry) observation once;
    de-duplicated on the fact's content, id computed afterwards.
    ``keep_dataset`` adds the dataset (for a table partitioned by it),
    ``keep_place`` deals by ``_place`` and adds it, for :func:`fact_provenance`.
    With ``ranks``, priority, date and entry number are compared as one number.
    ``size`` is the number of rows or entries, where it is known without ranks.

    Rows are dealt by entry before they are compared: those of one entry stay
    together, so its resource and dates cross the network about once. Entries
    that come whole are dealt by entity and put in its order: rows that repeat a
    fact are stored near each other, and its id, which does not compress, once."""
    parts = _parts(transformed, ranks.rows if ranks else size)
    if keep_place:
        transformed = _placed(transformed)
    kept = (["_place"] if keep_place else []) + (["dataset"] if keep_dataset else [])
    packed = ranks is not None and ranks.packs
    merit = [_packed_merit(ranks).alias("_m")] if packed else ["entry_number", "priority", "entry_date"]
    # what rows of an entry share comes first: fewer bytes
    obs = (ranks.encode(transformed) if packed else transformed).select(
        *kept, "entity", *merit, *_packed_id("resource"), *_payload(transformed))
    if keep_place:
        obs = _deal(obs, parts, "_place")
    elif "_names" in obs.columns:
        obs = _deal(obs, parts, "entity").sortWithinPartitions("entity")
    else:
        obs = _deal(obs, parts, "entity", *([] if packed else ["entry_number"]), "_resource_raw", "_resource_text")
    obs = explode_fields(obs).distinct()
    if packed:
        types = transformed.schema
        priority, rank, number = _unpacked_merit(ranks)
        obs = ranks.decode(obs.select("*", priority.cast(types["priority"].dataType).alias("priority"), rank.alias("_rank"),
                                      number.cast(types["entry_number"].dataType).alias("entry_number")))
    return obs.select(*kept, fact_id("entity", "field", "value").alias("fact"), "entry_date",
                      "entry_number", "priority", _unpacked_id("resource"))


def _merit() -> Column:
    """What ranks an observation, the greatest first: the lowest priority
    (none is worst), then the latest entry date (text; none is worst), then
    the latest entry number. The columns themselves are compared, so any
    date text, number or priority ranks as it stands."""
    return F.struct(F.bitwise_not("priority").alias("p"), F.col("entry_date").alias("d"),
                    F.col("entry_number").alias("n"))


def resolve_fields(transformed: DataFrame, ranks: DateRanks | None = None, ranked: bool = True,
                   deal: Callable[[DataFrame], DataFrame] | None = None, marks: tuple[str, ...] = ()) -> DataFrame:
    """(dataset, entity, field) -> winning value, its entry date and fact.

    Rows are dealt by (dataset, entity) once; two aggregations follow where
    they are: rows collapse to one per (entity, field, value) with that value's
    best observation; the field's winner is the value with the best of those,
    on a tie the one with the smallest fact id. The sha256 fact id is computed
    once per value rather than once per row.

    Observations are compared by a number packed from priority, date rank and
    entry number, so the first aggregation, over all rows, is hash-based. If
    the ranges at hand need over 63 bits, or there are too many dates to
    broadcast, the columns themselves are compared: the same result, by sorting.
    Ranking reads the rows once before; ``ranked`` = False spares that where
    they are dear to make, and compares the columns.

    ``deal`` puts the rows of a (dataset, entity) into one partition; it may
    leave rows out by ``marks``, columns of ``transformed`` that it gets too.
    """
    g = ["dataset", "entity", "field"]
    if ranks is None and ranked:
        ranks = rank_dates(transformed)
    packed = ranks is not None and ranks.packs
    if deal is None:
        def deal(rows: DataFrame) -> DataFrame:
            return _deal(rows, _parts(rows, ranks and ranks.rows), "dataset", "entity")
    columns = transformed.select("dataset", "entity", "entry_date", "priority", "entry_number", *marks, *_payload(transformed))
    payload = columns.columns[len(marks) + 5:]
    if packed:
        # turned round, as the smallest fact id wins a tie
        rows = deal(ranks.encode(columns).select("dataset", "entity", _packed_merit(ranks).alias("_m"), *marks, *payload))
        per_value = explode_fields(rows).groupBy(*g, "value").agg(F.max("_m").alias("m"))
        cand = per_value.withColumn("m", F.bitwise_not("m")).withColumn("fact", fact_id("entity", "field", "value"))
        w = cand.groupBy(*g).agg(F.min(F.struct("m", "fact", "value")).alias("w"))
        _, date_bits, number_bits = ranks.widths
        rank = F.shiftright(F.bitwise_not(F.col("w.m")), number_bits).bitwiseAND(F.lit((1 << date_bits) - 1))
        w = ranks.decode(w.withColumn("_rank", rank))
        return w.select(*g, F.col("w.value").alias("value"), "entry_date", F.col("w.fact").alias("fact"))
    per_value = explode_fields(deal(columns)).groupBy(*g, "value").agg(F.max(_merit()).alias("m"))
    cand = per_value.withColumn("fact", fact_id("entity", "field", "value"))
    # digits turned round, so that the greatest stands for the smallest id
    turned = F.translate("fact", "0123456789abcdef", "fedcba9876543210")
    w = cand.groupBy(*g).agg(F.max(F.struct("m", turned.alias("t"), "fact", "value")).alias("w"))
    return w.select(*g, F.col("w.value").alias("value"), F.col("w.m.d").alias("entry_date"),
                    F.col("w.fact").alias("fact"))


def entities_from_fields(resolved: DataFrame, columns=ENTITY_FIELD_COLUMNS) -> DataFrame:
    """Wide entity rows: one column per entity field (a fixed list, so no
    extra pass to discover pivot values), other fields as a json object with
    sorted keys, entry_date = latest winning entry date."""
    cols = list(columns)
    extra = F.when(~F.col("field").isin(cols), F.struct("field", "value"))
    agg = [F.max(F.when(F.col("field") == c, F.col("value"))).alias(c) for c in cols]
    agg += [F.array_sort(F.collect_list(extra)).alias("_extra"),
            F.max("entry_date").alias("entry_date")]
    wide = resolved.groupBy("dataset", "entity").agg(*agg)
    json = F.when(F.size("_extra") > 0, F.to_json(F.map_from_entries("_extra")))
    return wide.withColumn("json", json).select(*PACKAGE_COLUMNS["entity"])


def resolve_entities(transformed: DataFrame, ranks: DateRanks | None = None, ranked: bool = True) -> DataFrame:
    return entities_from_fields(resolve_fields(transformed, ranks, ranked))


# Columns that a flattened table may have at most.
MAX_FLATTENED = 10_000


def _bounded_names(names: DataFrame) -> list[str]:
    found = [r[0] for r in names.distinct().limit(MAX_FLATTENED + 1).collect()]
    if len(found) > MAX_FLATTENED:
        raise ValueError(f"more than {MAX_FLATTENED} field names; pass the specification's field list")
    return sorted(found)


def flatten_entities(entities: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Entity rows with their json keys as columns; an explicit column wins
    over a json key of the same name. ``keys`` is the specification's field
    list; without one, the distinct json keys are read first, and a table
    with more than ``MAX_FLATTENED`` of them is an error (unmapped raw
    headers become fields, so their number is not bounded by itself)."""
    m = F.from_json("json", "map<string,string>")
    if keys is None:
        keys = _bounded_names(entities.select(F.explode(F.map_keys(m)).alias("k")))
    base = [c for c in entities.columns if c != "json"]
    extra = [F.element_at(m, k).alias(k) for k in keys if k not in base]
    return entities.select(*base, *extra)


def json_fields(transformed: DataFrame, columns=ENTITY_FIELD_COLUMNS) -> list[str]:
    """Field names that end up as json keys (fields without an entity
    column), at most ``MAX_FLATTENED``; pass the specification's field list
    to :func:`flatten_entities` instead where there is one."""
    return _bounded_names(explode_fields(transformed).select("field").where(~F.col("field").isin(list(columns))))


def fact_provenance(facts: DataFrame, fact_resources: DataFrame) -> DataFrame:
    """fact joined with every resource that stated it (both sides large).
    Tables that were both made with ``keep_place`` lie alike already and are
    joined where they are; otherwise it is a shuffle join on ``fact``, in which
    ids cross the network as bytes."""
    if "_place" in facts.columns and "_place" in fact_resources.columns:
        fr = fact_resources.select("_place", F.col("fact").alias("_fact"), "resource",
                                   F.col("entry_date").alias("resource_entry_date"), "entry_number")
        # the same fact, in a form that is no second key: a join on other keys than those dealt by would shuffle
        same = (facts["_place"] == fr["_place"]) & (F.col("fact") <= F.col("_fact")) & (F.col("fact") >= F.col("_fact"))
        # facts second: of that side the rows of one place are held, a fact's resources may be many
        return fr.join(facts, same).select("fact", "entity", "field", "value", "resource", "resource_entry_date", "entry_number")

    def keyed(rows: DataFrame, *cols: Column | str) -> DataFrame:
        raw, text = _packed_id("fact")
        none = F.coalesce(raw, F.lit(b"")).alias("_fact_raw"), F.coalesce(text, F.lit("")).alias("_fact_text")
        return rows.where(F.col("fact").isNotNull()).select(*none, *cols)

    fr = keyed(fact_resources, *_packed_id("resource"), F.col("entry_date").alias("resource_entry_date"), "entry_number")
    fact = F.when(F.length("_fact_raw") > 0, F.lower(F.hex("_fact_raw"))).otherwise(F.col("_fact_text")).alias("fact")
    return (keyed(facts, "entity", "field", "value").join(fr, ["_fact_raw", "_fact_text"])
            .select(fact, "entity", "field", "value", _unpacked_id("resource"), "resource_entry_date", "entry_number"))


def update_entities(existing_entities: DataFrame, existing_transformed: DataFrame,
                    new_transformed: DataFrame) -> DataFrame:
    """Add new transformed rows to a built dataset: only entities the new
    rows touch are re-resolved (from old and new rows); the others keep their
    stored rows.

    Old and new rows are dealt by entity together, marked, and the old rows of
    untouched entities are left out there, so old rows are shuffled once."""
    touched = new_transformed.select("dataset", "entity").distinct()

    def touched_rows(rows: DataFrame) -> DataFrame:
        mark = touched.withColumn("_touched", F.lit(True)).hint("shuffle_hash")  # rows of one partition need no sort
        found = rows.repartition("dataset", "entity").join(mark, ["dataset", "entity"], "left")
        return found.where(F.col("_new") | F.col("_touched")).drop("_new", "_touched")

    both = (existing_transformed.withColumn("_new", F.lit(False))
            .unionByName(new_transformed.withColumn("_new", F.lit(True))))
    redone = entities_from_fields(resolve_fields(both, deal=touched_rows, marks=("_new",)))
    kept = existing_entities.join(touched, ["dataset", "entity"], "left_anti")
    return kept.unionByName(redone).select(*PACKAGE_COLUMNS["entity"])


def table_checksum(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-insensitive checksum: row count and the sum of a 60-bit md5
    prefix of each row (as DECIMAL(38,0), so the sum cannot overflow).
    A sum, not an xor, so equal rows do not cancel."""
    cols = cols or df.columns
    row = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002"))
                                  for c in cols])
    h = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("decimal(38,0)").alias("checksum"))

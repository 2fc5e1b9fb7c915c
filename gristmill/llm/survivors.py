"""Problem 3: one surviving record for each group of records of the same thing.

The survivor is the best row by completeness, confidence, date and id. Beside it stands the most current value of each
field. Where dates are missing, values are ordered by what followed what elsewhere: transitions between values of dated
rows of all groups give a precedence, and of a group's undated values the topologically latest is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gristmill.functions.joins import split_join
from gristmill.functions.values import BLANK_IDENTIFIER, NO_VALUE, date_of, has_identifier, has_number, has_text, plain_key, shared_identifiers, spelled
from gristmill.sources.tables import cut

#: v comes before w if w followed v at least this many times, and this share of the times that one followed the other.
LEAST_TIMES, LEAST_SHARE = 5, 0.6
#: The four fields of procurement records.
FIELDS = {"employee_count": has_number, "region_code": has_number, "compliance_flag": has_text, "registration_number": has_identifier}


def vendors(keys: DataFrame, key: str = "key") -> DataFrame:
    """key, vendor: each distinct plain key with the key it is a spelling of, at most one wrong character away.

    A key goes to its most frequent neighbour if that is three times as frequent or it stands only once or twice itself.
    Neighbours meet through keys with one place masked; each mask keeps only its most frequent key, so no pairs are built.
    """
    counted = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    masks = counted.select("key", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda i: F.concat(F.substring("key", F.lit(1), i - 1), F.lit("*"), F.substring("key", i + 1, F.length("key"))))).alias("mask"))
    masks = masks.where(F.length("key") > 1)
    best = masks.groupBy("mask").agg(F.max(F.struct("n", "key")).alias("best"))
    to = masks.join(best, "mask").groupBy("key", "n").agg(F.max("best").alias("best"))
    to = to.select("key", F.when((F.col("best.n") >= 3 * F.col("n")) | (F.col("n") <= 2), F.col("best.key")).otherwise(F.col("key")).alias("vendor"))
    again = to.select(F.col("key").alias("vendor"), F.col("vendor").alias("further"))
    found = to.join(again, "vendor", "left").select("key", F.coalesce("further", "vendor").alias("vendor"))
    return counted.select("key").join(found, "key", "left").select("key", F.coalesce("vendor", "key").alias("vendor"))


def held_values(long: DataFrame, *more: Column) -> DataFrame:
    """grp, field, value, n, dated (rows with a date), first, at (last date), weight of each different value of a group: all that currency needs, summed up before anything else. long: grp, field, value, at, weight."""
    return long.groupBy("grp", "field", "value").agg(F.count("*").alias("n"), F.count("at").alias("dated"), F.min("at").alias("first"), F.max("at").alias("at"), F.max("weight").alias("weight"), *more)


def precedence(held: DataFrame) -> DataFrame:
    """field, before, after, n: values of which one follows the other in dated rows, n times. held: as held_values gives it.

    Each group and value counts by its first date, so a group of any size gives at most as many transitions as it has
    different values.
    """
    dated = held.where("dated > 0 and value is not null")
    order = W.partitionBy("grp", "field").orderBy("first", "value")
    steps = dated.withColumn("next", F.lead("value").over(order)).withColumn("later", F.lead("first").over(order)).where("next is not null and later > first")
    n = cut(steps.groupBy("field", F.col("value").alias("before"), F.col("next").alias("after")).agg(F.count("*").alias("n")))
    back = n.select("field", F.col("before").alias("after"), F.col("after").alias("before"), F.col("n").alias("n_back"))
    both = n.where(F.col("n") >= LEAST_TIMES).join(back, ["field", "before", "after"], "left").fillna(0, ["n_back"])
    return both.where(F.col("n") >= LEAST_SHARE * (F.col("n") + F.col("n_back"))).select("field", "before", "after", "n")


def closure(edges: DataFrame) -> DataFrame:
    """field, before, after of all pairs that a chain of edges leads through; each round doubles the chains' length."""
    reach = cut(edges.select("field", "before", "after").distinct())
    n = reach.count()
    while n:
        further = reach.join(reach.select("field", F.col("before").alias("after"), F.col("after").alias("last")), ["field", "after"]).select("field", "before", F.col("last").alias("after"))
        reach, known = cut(reach.union(further).distinct()), n
        n = reach.count()
        if n == known:
            break
    return reach


def topological(edges: DataFrame) -> DataFrame:
    """field, before, after: the strict order that the edges give, also through values between. edges: as precedence gives them.

    Edges on cycles stay only where they lead from a value with less net arrivals over such edges to one with more, which
    no cycle can do all around; a cycle without a slope orders nothing.
    """
    edges = cut(edges)
    reach = closure(edges)
    back = reach.select("field", F.col("before").alias("after"), F.col("after").alias("before"))
    cyclic = cut(edges.join(back, ["field", "before", "after"], "left_semi"))
    if cyclic.isEmpty():
        return reach
    ends = cyclic.select("field", F.col("after").alias("value"), "n").unionByName(cyclic.select("field", F.col("before").alias("value"), (-F.col("n")).alias("n")))
    net = ends.groupBy("field", "value").agg(F.sum("n").alias("net"))
    sloped = cyclic.join(net.select("field", F.col("value").alias("before"), F.col("net").alias("low")), ["field", "before"]).join(net.select("field", F.col("value").alias("after"), F.col("net").alias("high")), ["field", "after"])
    return closure(edges.join(cyclic, ["field", "before", "after"], "left_anti").select("field", "before", "after").unionByName(sloped.where("low < high").select("field", "before", "after")))


def current_values(held: DataFrame) -> DataFrame:
    """grp, field, current_value, current_by: the most current value of each group and field. held: as held_values gives it.

    current_by is `date` for the value of the latest dated row, `precedence` where no row is dated and a value has no
    successor, near or far, among the group's values while others have, `weight` for the heaviest, then greatest value
    otherwise. Null values never stand for a group; a group without values has no row.
    """
    held = held.where("value is not null")
    heaviest = F.struct("weight", F.col("value"))
    groups = held.groupBy("grp", "field").agg(F.max_by("value", F.when(F.col("at").isNotNull(), F.struct("at", "value"))).alias("by_date"), F.max("at").alias("at"), F.max_by("value", heaviest).alias("by_weight"), F.count("*").alias("values"))
    by = F.when(F.col("at").isNotNull(), "date")
    open_ = cut(held.join(groups.where("at is null and values > 1").select("grp", "field"), ["grp", "field"], "left_semi").select("grp", "field", "value", "weight"))
    if open_.isEmpty():  # dates decide everywhere, or there is nothing to choose from
        return groups.select("grp", "field", F.coalesce("by_date", "by_weight").alias("current_value"), F.coalesce(by, F.lit("weight")).alias("current_by"))
    order = topological(precedence(held).join(open_.select("field").distinct(), "field", "left_semi"))
    # a value is earlier if one of those that it comes before is also held by its group
    later = open_.join(order.withColumnRenamed("before", "value"), ["field", "value"]).select("grp", "field", "value", "after")
    earlier = later.join(open_.select("grp", "field", F.col("value").alias("after")), ["grp", "field", "after"], "left_semi").select("grp", "field", "value").distinct()
    marked = open_.join(earlier.withColumn("earlier", F.lit(True)), ["grp", "field", "value"], "left")
    placed = marked.groupBy("grp", "field").agg(F.max_by("value", F.when(F.col("earlier").isNull(), heaviest)).alias("last"), F.count("earlier").alias("n_earlier")).where("n_earlier > 0")
    found = groups.join(placed, ["grp", "field"], "left")
    by = by.when(F.col("last").isNotNull(), "precedence").otherwise("weight")
    return found.select("grp", "field", F.coalesce("by_date", "last", "by_weight").alias("current_value"), by.alias("current_by"))


def usable(field: Column, value: Column) -> Column:
    """A usable value; `unknown` is one of liability_cap_status only, blank digits none of registration_number."""
    s = spelled(value)
    blank = (field == "registration_number") & s.rlike(BLANK_IDENTIFIER)
    return F.coalesce((~s.isin(*NO_VALUE) & ~blank) | ((field == "liability_cap_status") & (s == "unknown")), F.lit(False))


def field_survivors(fields: DataFrame) -> DataFrame:
    """vendor, field_name, n_rows, row_key, value, current_value, current_by of each group of two or more rows of extracted_field.

    A group is a vendor under any spelling of its key and a field name; rows without a key or field name form none. First
    goes a usable value, then higher confidence, later extracted_at (null earliest), smaller id. All by one aggregation
    with partial sums, so no group is ever held by one task.
    """
    rows = fields.select("id", "field_name", "value", "confidence", "extracted_at", plain_key(F.col("entity_key")).alias("key"))
    rows = split_join(rows.where("key is not null and field_name is not null"), cut(vendors(rows.select("key"))), "key", "inner")
    ok = usable(F.col("field_name"), F.col("value"))
    order = F.struct((~ok).cast("int"), -F.coalesce(F.col("confidence").cast("double"), F.lit(-1.0)), -F.coalesce(F.unix_micros(F.col("extracted_at").cast("timestamp")), F.lit(-(1 << 62))), "id", F.col("value").alias("raw"))
    long = rows.select(
        F.struct("vendor").alias("grp"), F.col("field_name").alias("field"), F.when(ok, spelled(F.col("value"))).alias("value"), F.col("extracted_at").cast("timestamp").alias("at"), F.col("confidence").cast("double").alias("weight"), order.alias("order")
    )
    held = cut(held_values(long, F.min("order").alias("best")))
    best = held.groupBy("grp", "field").agg(F.sum("n").alias("n_rows"), F.min("best").alias("b")).where("n_rows >= 2")
    found = best.join(current_values(held), ["grp", "field"], "left")
    return found.select(F.col("grp.vendor").alias("vendor"), F.col("field").alias("field_name"), "n_rows", F.col("b.id").alias("row_key"), F.col("b.raw").alias("value"), "current_value", "current_by")


def record_survivors(records: DataFrame) -> DataFrame:
    """file_id, entity_key, n_rows, row_key, the four fields, current: the survivor of each load and vendor key, as written, with two or more rows.

    First goes the row with most values among the four fields, then the later updated_at (null earliest), then the smaller
    record_id. current maps each field that has a value to its most current one. Rows without a load or key form no group.
    """
    shared = shared_identifiers(records, "registration_number", "entity_key")
    fields = {c: has(F.col(c), shared) if has is has_identifier else has(F.col(c)) for c, has in FIELDS.items()}
    rows = records.where("file_id is not null and entity_key is not null").select("file_id", "entity_key", F.concat_ws("\u0001", "file_id", "entity_key").alias("k"), "record_id", date_of(F.col("updated_at")).alias("day"), *FIELDS)
    n = sum((ok.cast("int") for ok in fields.values()), F.lit(0))
    order = F.struct(-n, -F.coalesce(F.unix_date("day"), F.lit(-(1 << 30))), "record_id")
    best = cut(rows.groupBy("file_id", "entity_key").agg(F.count("*").alias("n_rows"), F.min_by(F.struct("record_id", *FIELDS), order).alias("b")).where("n_rows >= 2"))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.when(ok, spelled(F.col(c))).alias("value")) for c, ok in fields.items())))
    long = split_join(rows, best.select(F.concat_ws("\u0001", "file_id", "entity_key").alias("k")), "k", "left_semi")
    long = long.select(F.struct("file_id", "entity_key").alias("grp"), "day", cells.alias("c")).select("grp", F.col("c.field").alias("field"), F.col("c.value").alias("value"), F.col("day").cast("timestamp").alias("at"), F.lit(1.0).alias("weight"))
    now = current_values(cut(held_values(long))).groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("current_value", "current_by")))).alias("current"))
    now = now.select("grp.file_id", "grp.entity_key", "current")
    return best.join(now, ["file_id", "entity_key"], "left").select("file_id", "entity_key", "n_rows", F.col("b.record_id").cast("string").alias("row_key"), *(F.col(f"b.{c}").alias(c) for c in FIELDS), "current")


def current_records(records: DataFrame) -> DataFrame:
    """file_id, vendor (entity_key as written), field_name, n_rows, row_key, value, current_value, current_by: four rows for each group of record_survivors, the survivor's cell beside the most current value."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")) for c in FIELDS)))
    now = F.try_element_at("current", F.col("c.field_name"))
    return record_survivors(records).select("*", cells.alias("c")).select("file_id", F.col("entity_key").alias("vendor"), "c.field_name", "n_rows", "row_key", "c.value", now["current_value"].alias("current_value"), now["current_by"].alias("current_by"))


def current(fields: DataFrame, records: DataFrame) -> DataFrame:
    """table_name, file_id (null for extracted_field), vendor, field_name, n_rows, row_key, value, current_value, current_by of the survivors of both tables."""
    columns = ["table_name", "file_id", "vendor", "field_name", "n_rows", "row_key", "value", "current_value", "current_by"]
    of_fields = field_survivors(fields).withColumns({"table_name": F.lit("extracted_field"), "file_id": F.lit(None).cast("string")})
    return of_fields.select(*columns).unionByName(current_records(records).withColumn("table_name", F.lit("procurement_export_batch1")).select(*columns))


def survivors(fields: DataFrame, records: DataFrame) -> DataFrame:
    """table_name, row_key of the survivors of both tables."""
    return field_survivors(fields).select(F.lit("extracted_field").alias("table_name"), "row_key").unionByName(
        record_survivors(records).select(F.lit("procurement_export_batch1").alias("table_name"), "row_key")
    )

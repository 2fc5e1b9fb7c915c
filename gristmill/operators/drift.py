"""Problem 2: files whose columns drift, read into one table, with a report of each change.

Lines of all files are parted by their own header. A target schema is enforced cell by cell: what it doesn't know, or
can't cast, goes to a rescue column as JSON. Renames found in the report become approved aliases; replaying the rescue
column with them puts rescued values into typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gristmill.functions.joins import split_join
from gristmill.functions.values import NO_VALUE, date_of, spelled
from gristmill.sources.tables import cut

#: The target schema of vendor feeds, for rows of any file.
TARGET = {
    "entity_key": "string", "source_system": "string", "employee_count": "bigint", "region_code": "bigint", "compliance_flag": "string", "registration_number": "string", "updated_at": "date",
    "contract_tier": "string", "onboarded_on": "date", "risk_score": "bigint", "invoice_channel": "string", "credit_limit": "double", "cost_center": "string", "payment_days": "bigint",
}
#: What a vendor key looks like: rows of two files are the same vendor's if they share one.
KEY = r"^(?i)VEN[-_ ]?[A-Z0-9]{6}$"
#: Share of common rows whose values must agree for a rename, and of values that decide a column's type.
SAME, TYPED = 0.6, 0.9
#: Days that the typical age of a date column may move between two files of a feed.
AGE_DAYS = 12

DATE = r"^(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}(?:[T ]\d{2}:\d{2}(?::\d{2})?Z?)?|\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{1,2} [A-Za-z]{3,9} \d{4})$"


def feed(c: Column) -> Column:
    """A source system however it is spelled."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_")


def files(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """file_id, feed, received_at, headers, previous (file_id of the feed's file before, null for its first)."""
    heads = lines.where("line_no = 0 and content is not null").groupBy("file_id").agg(F.split(F.min("content"), ",", -1).alias("headers"))
    known = registry.groupBy(F.col("id").alias("file_id")).agg(F.min("received_at").alias("received_at"), F.min(feed(F.col("source_system"))).alias("feed"))
    order = W.partitionBy("feed").orderBy(F.col("received_at"), F.col("file_id"))
    return heads.join(known, "file_id", "left").withColumn("previous", F.when(F.col("feed").isNotNull(), F.lag("file_id").over(order)))


def as_written(c: Column, kind_of: str) -> Column:
    """A typed value as a file would write it in that type's own form."""
    return c if kind_of == "string" else c.cast("string")


def cells(table: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """file_id, line_no, row_key, header, value: the cells that the lines of a table made by ingest had, as they were written. Cells beyond the header have none and stay in the rescue column."""
    target = TARGET if target is None else target
    rows = table.select("file_id", "line_no", *target, F.coalesce(F.from_json("_rescued", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("__m"))
    kept = F.array(*(F.struct(F.lit(n).alias("header"), F.when(~F.map_contains_key("__m", F.lit(n)), as_written(F.col(n), t)).alias("value")) for n, t in target.items()))
    rest = F.transform(F.map_entries(F.map_filter("__m", lambda k, v: k != "_beyond")), lambda e: F.struct(e["key"].alias("header"), e["value"].alias("value")))
    body = rows.select("file_id", "line_no", F.explode(F.array(F.filter(F.concat(kept, rest), lambda c: c["value"].isNotNull()))).alias("__c"))
    key = F.regexp_replace(F.get(F.filter("__c", lambda c: c["value"].rlike(KEY)), F.lit(0))["value"], r"[^A-Za-z0-9]", "")
    return body.select("file_id", "line_no", F.upper(key).alias("row_key"), F.explode("__c").alias("c")).select("file_id", "line_no", "row_key", "c.header", "c.value")


def kind(v: Column) -> Column:
    return (
        F.when(v.rlike(r"^[-+]?\d+$"), "whole").when(v.rlike(r"^[-+]?\d*[.]\d+(?:[eE][-+]?\d+)?$"), "decimal").when(v.rlike(DATE), "date").when(F.lower(v).isin("true", "false"), "true_false").otherwise("text")
    )


def column_types(cell_table: DataFrame) -> DataFrame:
    """file_id, header, type, age: the type that nearly all values of a column have, and for dates (also in seconds since 1970) the median date.

    Whole and decimal numbers together are decimal; any other mixture is text.
    """
    day = F.when(F.col("value").rlike(r"^(?:9|1\d|2[01])\d{8}$"), F.timestamp_seconds(F.col("value").try_cast("bigint")).cast("date")).when(F.col("value").rlike(DATE), date_of(F.col("value")))
    n = cell_table.withColumn("kind", kind(F.col("value"))).groupBy("file_id", "header").agg(
        F.count("*").alias("n"), *(F.count_if(F.col("kind") == k).alias(k) for k in ("whole", "decimal", "date", "true_false")), F.percentile_approx(F.unix_date(day), F.lit(0.5)).alias("day"), F.count(day).alias("days")
    )
    t = (
        F.when(F.col("date") >= TYPED * F.col("n"), "date").when(F.col("true_false") >= TYPED * F.col("n"), "true_false")
        .when((F.col("whole") + F.col("decimal") >= TYPED * F.col("n")) & (F.col("decimal") > 0), "decimal").when(F.col("whole") >= TYPED * F.col("n"), "whole").otherwise("text")
    )
    return n.select("file_id", "header", t.alias("type"), F.when(F.col("days") >= TYPED * F.col("n"), F.col("day")).alias("day"))


def changes(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """What changes_of finds in lines of files as they come."""
    f = cut(files(lines, registry))
    return changes_of(cut(ingest(lines, f)), f)


def changes_of(table: DataFrame, f: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """file_id, field_name, change_kind, was: each change of a file's columns against the feed's file before.

    change_kind is added, removed, renamed or retyped; was is the header before (renamed) or the type before (retyped). A
    removed and an added column are one renamed column if, over the vendors in both files, most values agree, or if both
    hold dates of about the same age; each column is in one pair at most, the best. Files without a known feed, and first
    files, have no changes. Moved columns are none. A column without any value has no type.

    table: the files as ingest made them. Its typed columns and its rescue column together hold each cell as it was
    written: unknown headers and cells out of type are what was rescued. f: as files gives it.
    """
    all_cells = cut(cells(table, target))
    types = cut(column_types(all_cells))
    pairs = f.where("previous is not null").select("file_id", "previous", "received_at", "headers")
    before = f.select(F.col("file_id").alias("previous"), F.col("headers").alias("old"), F.col("received_at").alias("old_received"))
    pairs = pairs.join(before, "previous")
    gone = pairs.select("file_id", "previous", "received_at", "old_received", F.explode(F.array_except("old", "headers")).alias("old_header"))
    new = pairs.select("file_id", F.explode(F.array_except("headers", "old")).alias("header"))

    per_row = all_cells.where("row_key is not null and row_key <> ''").groupBy("file_id", "header", "row_key").agg(F.min(F.lower("value")).alias("value"))
    old_cells = gone.select("file_id", "previous", "old_header").join(per_row.select(F.col("file_id").alias("previous"), F.col("header").alias("old_header"), "row_key", F.col("value").alias("old_value")), ["previous", "old_header"])
    new_cells = new.join(per_row, ["file_id", "header"])
    # numbers with decimals may move in their last places from file to file
    a, b = F.col("value").try_cast("double"), F.col("old_value").try_cast("double")
    near = (F.contains("value", F.lit(".")) | F.contains("old_value", F.lit("."))) & (F.abs(a - b) <= F.greatest(F.lit(1.0), F.abs(a) / 100))
    agrees = (F.col("value") == F.col("old_value")) | F.coalesce(near, F.lit(False))
    agree = old_cells.join(new_cells, ["file_id", "row_key"]).groupBy("file_id", "old_header", "header").agg(F.count("*").alias("both"), F.avg(agrees.cast("double")).alias("same"))

    old_types = types.select(F.col("file_id").alias("previous"), F.col("header").alias("old_header"), F.col("type").alias("old_type"), F.col("day").alias("old_day"))
    dated = gone.join(old_types, ["previous", "old_header"]).where("old_day is not null").join(new.join(types, ["file_id", "header"]).where("day is not null"), "file_id")
    age = F.abs((F.unix_date(F.to_date("received_at")) - F.col("day")) - (F.unix_date(F.to_date("old_received")) - F.col("old_day")))
    aged = dated.where((age <= AGE_DAYS) & (F.col("type") == F.col("old_type"))).select("file_id", "old_header", "header", age.alias("age"))

    linked = agree.where((F.col("same") >= SAME) & (F.col("both") >= 2)).join(aged, ["file_id", "old_header", "header"], "full")
    score = F.coalesce("same", F.lit(0.0)) + F.when(F.col("age").isNotNull(), 0.5 - F.col("age") / 100).otherwise(0.0)
    linked = cut(linked.withColumn("score", score))
    one = W.partitionBy("file_id", "header").orderBy(F.desc("score"), "old_header")
    other = W.partitionBy("file_id", "old_header").orderBy(F.desc("score"), "header")
    renamed = linked.withColumn("a", F.row_number().over(one)).withColumn("b", F.row_number().over(other)).where("a = 1 and b = 1").select("file_id", "header", "old_header")
    renamed = cut(renamed)

    was = types.select(F.col("file_id").alias("previous"), "header", F.col("type").alias("was"))
    retyped = pairs.select("file_id", "previous").join(types.select("file_id", "header", "type"), "file_id").join(was, ["previous", "header"]).where("type <> was")
    return (
        renamed.select("file_id", F.col("header").alias("field_name"), F.lit("renamed").alias("change_kind"), F.col("old_header").alias("was"))
        .unionByName(new.join(renamed, ["file_id", "header"], "left_anti").select("file_id", F.col("header").alias("field_name"), F.lit("added").alias("change_kind"), F.lit(None).cast("string").alias("was")))
        .unionByName(gone.join(renamed, ["file_id", "old_header"], "left_anti").select("file_id", F.col("old_header").alias("field_name"), F.lit("removed").alias("change_kind"), F.lit(None).cast("string").alias("was")))
        .unionByName(retyped.select("file_id", F.col("header").alias("field_name"), F.lit("retyped").alias("change_kind"), "was"))
        .distinct()
    )


def aliases(report: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """alias, field: headers that renames join to a field of the target schema, in either direction and over any number of steps.

    The fewest steps count, then the field that the most renames lead to. Each round finds a header at least, so there are
    at most as many as headers.
    """
    renames = cut(report.where("change_kind = 'renamed'").select("field_name", "was"))
    names = list(target)
    either = renames.select(F.col("field_name").alias("alias"), F.col("was").alias("other")).unionByName(renames.select(F.col("was").alias("alias"), F.col("field_name").alias("other")))
    steps = cut(either.where(~F.col("alias").isin(names)).groupBy("alias", "other").agg(F.count("*").alias("n")))

    def nearest(linked: DataFrame) -> DataFrame:
        return cut(linked.groupBy("alias", "field").agg(F.sum("n").alias("n")).groupBy("alias").agg(F.max_by("field", F.struct("n", "field")).alias("field")))

    newest = found = nearest(steps.where(F.col("other").isin(names)).select("alias", F.col("other").alias("field"), "n"))
    while not newest.isEmpty():
        further = steps.join(newest.select(F.col("alias").alias("other"), "field"), "other").join(found, "alias", "left_anti")
        newest = nearest(further.select("alias", "field", "n"))
        found = cut(found.unionByName(newest))
    return found


def enforced(field: Column, kind_of: str) -> Column:
    if kind_of == "date":
        return F.coalesce(date_of(field), F.when(field.rlike(r"^(?:9|1\d|2[01])\d{8}$"), F.timestamp_seconds(field.try_cast("bigint")).cast("date")))
    return field.try_cast(kind_of)


def named(name: str):
    return lambda x: x["h"] == name


def ingest(lines: DataFrame, file_table: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """file_id, line_no, the target's columns and _rescued: one row for each line but headers.

    _rescued is JSON of the cells whose header the target doesn't know, or whose value doesn't cast or isn't written in its
    type's own form, so that nothing a file said is lost; under `_beyond` those without a header; null if there are none.
    Cells that stand for no value are null and not rescued. Of two columns of one name the first counts.
    """
    body = lines.where("line_no > 0 and content is not null").select("file_id", "line_no", F.split("content", ",", -1).alias("__v"))
    body = split_join(body, file_table.select("file_id", F.col("headers").alias("__h")), "file_id", "left")
    zipped = F.filter(F.arrays_zip(F.coalesce("__h", F.array().cast("array<string>")).alias("h"), F.transform("__v", lambda v: F.trim(v)).alias("v")), lambda x: x["v"].isNotNull() & ~spelled(x["v"]).isin(*NO_VALUE))
    # explode(array(...)) keeps Catalyst from writing these arrays out again wherever they are used
    body = body.select("file_id", "line_no", F.explode(F.array(F.coalesce(zipped, F.array().cast("array<struct<h:string,v:string>>")))).alias("__c"))
    raw = F.struct(*(F.get(F.transform(F.filter("__c", named(name)), lambda x: x["v"]), F.lit(0)).alias(name) for name in target))
    body = body.select("*", F.explode(F.array(raw)).alias("__w"))
    typed = F.struct(*(enforced(F.col("__w")[name], t).alias(name) for name, t in target.items()))
    body = body.select("*", F.explode(F.array(typed)).alias("__t"))
    taken = F.array_compact(F.array(*(F.when(as_written(F.col("__t")[name], t) == F.col("__w")[name], F.lit(name)) for name, t in target.items())))
    body = body.select("file_id", "line_no", "__t", "__c", F.explode(F.array(taken)).alias("__taken"))
    left = F.transform(F.filter("__c", lambda x: x["h"].isNull() | ~F.array_contains("__taken", x["h"])), lambda x: F.struct(F.coalesce(x["h"], F.lit("_beyond")).alias("key"), x["v"].alias("value")))
    body = body.select("file_id", "line_no", "__t", F.explode(F.array(left)).alias("__left"))
    keys = F.array_distinct(F.transform("__left", lambda x: x["key"]))
    values = F.transform(keys, lambda k: F.array_join(F.transform(F.filter("__left", lambda x: x["key"] == k), lambda x: x["value"]), ","))
    return body.select("file_id", "line_no", "__t.*", F.when(F.size("__left") > 0, F.to_json(F.map_from_arrays(keys, values))).alias("_rescued"))


def from_table(df: DataFrame, target: dict[str, str] = TARGET, load: str = "file_id", row: str = "record_id") -> DataFrame:
    """The rows of a table whose columns drifted, as ingest gives lines: file_id, line_no (its row number), the target's columns and _rescued.

    Whole numbers of floating columns count as whole. Cells that stand for no value, and NaN, are null and not rescued.
    """
    types, texts = dict(df.dtypes), {}
    for c in df.columns:
        if c in {load, row}:
            continue
        v = F.col(c)
        if types[c] in {"double", "float"}:
            text = F.when((v == F.floor(v)) & (F.abs(v) < 1e15), v.cast("bigint").cast("string")).when(~F.isnan(v), v.cast("string"))
        else:
            text = F.trim(v.cast("string"))
        texts[c] = F.when(~spelled(text).isin(*NO_VALUE), text)
    rows = df.select(F.col(load).alias("file_id"), F.col(row).cast("bigint").alias("line_no"), F.explode(F.array(F.struct(*(t.alias(c) for c, t in texts.items())))).alias("__w"))
    typed = F.struct(*((enforced(F.col("__w")[n], t) if n in texts else F.lit(None).cast(t)).alias(n) for n, t in target.items()))
    rows = rows.select("*", F.explode(F.array(typed)).alias("__t"))
    left = F.map_filter(F.create_map(*(x for c in texts for x in (F.lit(c), F.when(F.col("__t")[c].isNull(), F.col("__w")[c]) if c in target else F.col("__w")[c]))), lambda k, v: v.isNotNull())
    return rows.select("file_id", "line_no", "__t.*", F.when(F.size(left) > 0, F.to_json(left)).alias("_rescued"))


def table_changes(old: DataFrame, new: DataFrame, name: str, key: str = "entity_key") -> DataFrame:
    """file_id (`name`), field_name, change_kind, was: the changes of a table's columns against an earlier table.

    A column that is gone and a new one are one renamed column if most keys in both hold a common value, each in one pair
    at most, the best. Values are summed up by key before they meet, so a hot key weighs no more than its values.
    """
    before, after = dict(old.dtypes), dict(new.dtypes)
    gone, added = [c for c in old.columns if c not in after], [c for c in new.columns if c not in before]
    kinds = {"bigint": "whole", "int": "whole", "double": "decimal", "float": "decimal", "date": "date", "boolean": "true_false"}
    rows = [(name, c, "retyped", kinds.get(before[c], "text")) for c in after if c in before and kinds.get(before[c], "text") != kinds.get(after[c], "text")]
    pairs: list[tuple[float, str, str]] = []
    if gone and added:

        def held(df: DataFrame, columns: list[str], as_: str) -> DataFrame:
            cell = F.explode(F.array(*(F.struct(F.lit(c).alias(as_), spelled(F.col(c)).alias("v")) for c in columns))).alias("c")
            return df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), cell).select("k", "c.*").where(F.col("v").isNotNull() & ~F.col("v").isin(*NO_VALUE)).distinct()

        a, b = cut(held(old, gone, "o")), cut(held(new, added, "n"))
        both = a.select("k", "o").distinct().join(b.select("k", "n").distinct(), "k").groupBy("o", "n").agg(F.count("*").alias("both"))
        same = a.join(b, ["k", "v"]).select("k", "o", "n").distinct().groupBy("o", "n").agg(F.count("*").alias("same"))
        found = both.join(same, ["o", "n"]).where(F.col("same") >= SAME * F.col("both")).collect()  # at most a row for each pair of columns
        pairs = sorted(((r.same / r.both, r.o, r.n) for r in found), reverse=True)
    renamed: dict[str, str] = {}
    for _, o, n in pairs:
        if n not in renamed and o not in renamed.values():
            renamed[n] = o
    rows += [(name, n, "renamed", o) for n, o in renamed.items()] + [(name, n, "added", None) for n in added if n not in renamed] + [(name, o, "removed", None) for o in gone if o not in renamed.values()]
    return old.sparkSession.createDataFrame(rows, "file_id string, field_name string, change_kind string, was string")


def replay(table: DataFrame, approved: DataFrame, target: dict[str, str] = TARGET, held: int = 10_000) -> DataFrame:
    """`table` with rescued values of approved aliases put into their typed columns, where these are null. What stands in a typed column leaves _rescued.

    `approved` (alias, field) is one row for each alias a person or rule approved; a schema has few, and more than `held`
    raise an error instead of being left out.
    """
    pairs = approved.select("alias", "field").limit(held + 1).collect()
    if len(pairs) > held:
        raise ValueError(f"more than {held} aliases")
    of = {name: [name, *sorted(a for a, f in pairs if f == name)] for name in target}
    # explode(array(...)) keeps Catalyst from writing these values out again wherever they are used
    out = table.select("*", F.explode(F.array(F.coalesce(F.from_json("_rescued", "map<string,string>"), F.create_map().cast("map<string,string>")))).alias("__m"))
    new = F.struct(*(F.coalesce(F.col(name), *(enforced(F.try_element_at("__m", F.lit(a)), target[name]) for a in known[1:])).alias(name) for name, known in of.items()))
    out = out.select("*", F.explode(F.array(new)).alias("__new"))
    # an alias leaves where it gave the value, the column's own header where it has one
    placed = F.flatten(F.array_compact(F.array(*(
        F.when(F.col("__new")[name].isNotNull(), F.array(*(F.when(F.lit(a == name) | F.col(name).isNull(), F.lit(a)).otherwise(F.lit("")) for a in known))) for name, known in of.items()))))
    out = out.select("*", F.explode(F.array(placed)).alias("__placed"))
    rest = F.map_filter("__m", lambda k, v: ~F.array_contains("__placed", k))
    out = out.withColumns({"_rescued": F.when(F.size(rest) > 0, F.to_json(rest)), **{name: F.col("__new")[name] for name in of}})
    return out.drop("__m", "__new", "__placed")


def consistent(lines: DataFrame, registry: DataFrame, old: DataFrame, new: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """table_name, file_id, line_no, the target's columns, _rescued: all lines of all files, and the rows of the tables `old` and `new`, as one table, with renames found and replayed."""
    f = cut(files(lines, registry))
    landed = cut(ingest(lines, f, target))
    found = changes_of(landed, f, target).unionByName(table_changes(old, new, "procurement_export_batch2"))
    parts = [landed.withColumn("line_no", F.col("line_no").cast("bigint")).select(F.lit("raw_line").alias("table_name"), "*")]
    parts += [from_table(df, target).select(F.lit(name).alias("table_name"), "*") for df, name in ((old, "procurement_export_batch1"), (new, "procurement_export_batch2"))]
    return replay(parts[0].unionByName(parts[1]).unionByName(parts[2]), aliases(cut(found), target), target)


def version_report(report: DataFrame, f: DataFrame, registry: DataFrame) -> DataFrame:
    """file_id, feed, stored_version, version, n_changes, agrees: the version each file has by its changes (the first 1, one more for each file with a change), beside the stored schema_version. f: as files gives it. A file without a feed has no version."""
    n = report.groupBy("file_id").agg(F.count("*").alias("n"))
    stored = registry.groupBy(F.col("id").alias("file_id")).agg(F.max("schema_version").alias("stored_version"))
    rows = f.where("feed is not null").select("file_id", "feed", "received_at").join(n, "file_id", "left").join(stored, "file_id", "left").withColumn("n_changes", F.coalesce("n", F.lit(0)))
    order = W.partitionBy("feed").orderBy("received_at", "file_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    version = (1 + F.sum((F.col("n_changes") > 0).cast("int")).over(order)).cast("bigint")
    return rows.withColumn("version", version).select("file_id", "feed", F.col("stored_version").cast("bigint").alias("stored_version"), "version", "n_changes", F.coalesce(F.col("stored_version") == F.col("version"), F.lit(False)).alias("agrees"))

"""Problem 1: filling missing cells from similar records.

Records are clustered by K-prototypes over the features that they show: distance is squared on standardised numbers and
counts mismatches on categories, over the features that both sides have. A missing cell gets the median or mode of its
vendor's records in its own cluster; parents step in where that is empty: all records of the vendor, the cluster in the
quarter, the cluster, all records. Each filled cell names its method.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.joins import split_join
from gristmill.functions.values import date_of, has_identifier, has_number, has_text, shared_identifiers, spelled
from gristmill.sources.tables import cut, spread

METHODS = ("vendor_cluster", "vendor", "cluster_quarter", "cluster", "all", "none")
#: Methods whose donors are the vendor's own records.
OWN = METHODS[:2]
UNDATED = "1970-01-01"


@dataclass(frozen=True)
class Fields:
    """Columns to fill and features to cluster by. Identifiers are filled from the vendor's own records only: another's would be false."""

    table: str
    numbers: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()  # categories written as numbers: filled by the mode
    categories: tuple[str, ...] = ()
    identifiers: tuple[str, ...] = ()
    features: tuple[str, ...] = ()  # codes that are never filled but tell vendors apart
    row: str = "record_id"
    key: str = "entity_key"
    time: str = "updated_at"

    @property
    def filled(self) -> tuple[str, ...]:
        return (*self.numbers, *self.codes, *self.categories, *self.identifiers)


PROCUREMENT = Fields("procurement_export_batch1", ("employee_count",), ("region_code",), ("compliance_flag",), ("registration_number",))
FINANCE = Fields("finance_extract", identifiers=("registration_number",), features=("region_code",))


def cell(fields: Fields, c: str, shared: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The usable value of a column as text, null where it is missing. Categories are compared without case and blanks at the ends."""
    if c in fields.numbers or c in fields.codes or c in fields.features:
        return F.when(has_number(F.col(c)), F.col(c).cast("double").cast("string"))
    if c in fields.identifiers:
        return F.when(has_identifier(F.col(c), (shared or {}).get(c, ())), F.trim(F.col(c)))
    return F.when(has_text(F.col(c)), spelled(F.col(c)))


def copy_of(fields: Fields) -> Column:
    """A hash of all cells of a row that its fills depend on."""
    return F.xxhash64(*(F.col(c) for c in (fields.key, fields.time, *fields.filled, *fields.features)))


def k_prototypes(points: DataFrame, numbers: tuple[str, ...], categories: tuple[str, ...], k: int = 12, rounds: int = 6, gamma: float = 0.8) -> Callable[[DataFrame], DataFrame]:
    """A function that adds `cluster`, 0 .. k - 1, to rows that have the columns of `points`: their nearest prototype; null for a row without any feature.

    points: numbers (double), categories (string) and n, how many records show them. Numbers count by their logarithm,
    standardised; a missing feature adds nothing to a distance. The first prototypes are the k points whose hash is least,
    so the result is the same in every run. Only prototypes, at most k rows of features, come to the driver.
    """
    logs = {c: F.log1p(F.abs(F.col(c))) for c in numbers}
    weight = {c: F.when(F.col(c).isNotNull(), F.col("n")) for c in numbers}
    moments = [m for c in numbers for m in (F.sum(weight[c]), F.sum(logs[c] * weight[c]), F.sum(logs[c] * logs[c] * weight[c]))]
    found, columns = points.agg(F.count("*"), *moments).first(), []
    for i, c in enumerate(numbers):
        n, total, squares = (found[1 + 3 * i + j] or 0 for j in range(3))
        mean = total / n if n else 0.0
        spread = max(squares / n - mean * mean, 0.0) ** 0.5 if n else 0.0
        columns.append((logs[c] - F.lit(mean)) / F.lit(spread or 1.0))
    columns += [F.col(c) for c in categories]
    if not found[0] or not columns:
        return lambda df: df.withColumn("cluster", F.lit(None).cast("int"))
    names = [f"__f{i}" for i in range(len(columns))]
    shown = points.select("n", *(c.alias(f) for f, c in zip(names, columns)))
    first = shown.select(*names).dropDuplicates().orderBy(F.xxhash64(*names), *names).limit(k).collect()
    prototypes = [list(r) for r in first]

    def assign(df: DataFrame) -> DataFrame:
        kind = ", ".join(f"{f}: {'double' if i < len(numbers) else 'string'}" for i, f in enumerate(names))
        held = F.array(*(F.struct(F.lit(i).alias("i"), *(F.lit(v).alias(f) for f, v in zip(names, p))).cast(f"struct<i: int, {kind}>") for i, p in enumerate(prototypes)))

        def distance(p: Column) -> Column:
            parts = [F.pow(F.col(f) - p[f], 2) if i < len(numbers) else F.when(F.col(f) != p[f], gamma) for i, f in enumerate(names)]
            return F.struct(sum((F.coalesce(d, F.lit(0.0)) for d in parts), F.lit(0.0)).alias("d"), p["i"].alias("i"))

        any_ = F.coalesce(*(F.col(f).cast("string") for f in names)).isNotNull()
        return df.withColumn("cluster", F.when(any_, F.array_min(F.transform(held, distance))["i"]))

    values = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), (F.col(f) if i < len(numbers) else F.lit(None)).cast("double").alias("x"), (F.lit(None) if i < len(numbers) else F.col(f)).cast("string").alias("v")) for i, f in enumerate(names))))
    for _ in range(rounds):
        # sums for each value first, so that a cluster's centre comes from as many rows as it has different values
        sums = assign(shown).select("cluster", "n", values.alias("s")).where("s.x is not null or s.v is not null").groupBy("cluster", "s.f", "s.v").agg(F.sum("n").alias("n"), F.sum(F.col("s.x") * F.col("n")).alias("x"))
        moved = [list(p) for p in prototypes]
        for r in sums.groupBy("cluster", "f").agg((F.sum("x") / F.sum("n")).alias("x"), F.min_by("v", F.struct(-F.col("n"), "v")).alias("v")).collect():
            moved[r.cluster][r.f] = r.x if r.f < len(numbers) else r.v
        if moved == prototypes:
            break
        prototypes = moved
    return lambda df: assign(df.withColumns(dict(zip(names, columns)))).drop(*names)


def central(counted: DataFrame, fields: Fields, *by: str) -> DataFrame:
    """by, field_name, value: the median of the records for numbers, else the most frequent value, of equals the smallest. counted: by, field_name, value, n."""
    numeric = F.col("field_name").isin(*fields.numbers) if fields.numbers else F.lit(False)
    per_value = counted.groupBy(*by, "field_name", "value").agg(F.sum("n").alias("n"))
    median = F.percentile(F.when(numeric, F.col("value").try_cast("double")), 0.5, F.col("n")).cast("string")
    return per_value.groupBy(*by, "field_name").agg(F.coalesce(median, F.min_by("value", F.struct(-F.col("n"), "value"))).alias("value"))


def fills(df: DataFrame, fields: Fields, k: int = 12, own_only: bool = False) -> DataFrame:
    """row (as long), copy, field_name, filled_value (string), method of each missing cell; with `own_only`, of those that the vendor's own records fill.

    method is one of METHODS: `none` where no donor exists. A cell is missing if it is null, NaN, or only stands for no
    value; what an identifier column holds for far too many vendors stands for none. Numbers get the median of the records,
    all else the most frequent value, ties the smallest. Vendors go by their key exactly as written; rows without a key
    take part in no vendor but in the fallback over clusters and all records. Rows without a date share one quarter.
    copy is copy_of() the row: rows of one id, or of none, that differ are told apart by it.
    """
    texts = {c: cell(fields, c) for c in (*fields.filled, *fields.features)}
    rows = df.select(
        F.col(fields.row).cast("long").alias("row"), copy_of(fields).alias("copy"), F.col(fields.key).alias("key"), F.coalesce(F.date_trunc("quarter", date_of(F.col(fields.time))).cast("date"), F.lit(UNDATED).cast("date")).alias("quarter"),
        *(texts[c].cast("double" if c in fields.numbers else "string").alias(c) for c in texts),
    )
    kinds = (*fields.codes, *fields.features, *fields.categories)
    points = cut(spread(rows.groupBy(*fields.numbers, *kinds).agg(F.count("*").alias("n"))))
    rows = k_prototypes(points, fields.numbers, kinds, k)(rows)
    cells = rows.select("key", "cluster", "quarter", F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")) for c in fields.filled))).alias("c")).select("key", "cluster", "quarter", "c.*")
    # one count for each value of a vendor, cluster and quarter: all that donors need, summed up before anything is compared
    counted = cut(cells.where("value is not null").groupBy("key", "cluster", "quarter", "field_name", "value").agg(F.count("*").alias("n")))
    shared = {c: shared_identifiers(counted.where(F.col("field_name") == c), "value", "key") for c in fields.identifiers}
    for c, values in shared.items():
        if values:
            counted = counted.where(~((F.col("field_name") == c) & spelled(F.col("value")).isin(*values)))

    own = counted.where("key is not null")
    donors = central(own, fields, "key").select("key", F.col("field_name").alias("name"), "value").unionByName(central(own.where("cluster is not null"), fields, "key", "cluster").select("key", F.concat("cluster", F.lit("|"), "field_name").alias("name"), "value"))
    donors = donors.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("own"))  # (k + 1) entries a field at most
    gone = F.array_compact(F.array(*(F.when(F.col(c).isNull() | (spelled(F.col(c)).isin(*shared[c]) if shared.get(c) else F.lit(False)), F.lit(c)) for c in fields.filled)))
    missing = cut(rows.select("row", "copy", "key", "cluster", "quarter", gone.alias("fields")).where(F.size("fields") > 0))
    found = split_join(missing, donors, "key").select("row", "copy", "cluster", "quarter", "own", F.explode("fields").alias("field_name"))
    like, any_ = F.try_element_at("own", F.concat("cluster", F.lit("|"), "field_name")), F.try_element_at("own", F.col("field_name"))
    found = found.select("row", "copy", "cluster", "quarter", "field_name", F.coalesce(like, any_).alias("filled_value"), F.when(like.isNotNull(), OWN[0]).when(any_.isNotNull(), OWN[1]).alias("method"))
    if own_only:
        return found.where("method is not null").select("row", "copy", "field_name", "filled_value", "method")

    others = counted.where(~F.col("field_name").isin(*fields.identifiers)) if fields.identifiers else counted
    others = cut(others.groupBy("cluster", "quarter", "field_name", "value").agg(F.sum("n").alias("n")))
    # clusters are at most k, quarters as many as the covered years have: these tables are bounded by k times the quarters
    found = found.join(F.broadcast(central(others, fields, "cluster", "quarter").withColumnRenamed("value", "v0")), ["cluster", "quarter", "field_name"], "left")
    found = found.join(F.broadcast(central(others, fields, "cluster").withColumnRenamed("value", "v1")), ["cluster", "field_name"], "left")
    found = found.join(F.broadcast(central(others, fields).withColumnRenamed("value", "v2")), ["field_name"], "left")
    method = F.coalesce("method", *(F.when(F.col(f"v{i}").isNotNull(), F.lit(m)) for i, m in enumerate(METHODS[2:5])), F.lit(METHODS[5]))
    return found.select("row", "copy", "field_name", F.coalesce("filled_value", "v0", "v1", "v2").alias("filled_value"), method.alias("method"))


def fill_missing(df: DataFrame, fields: Fields, k: int = 12) -> DataFrame:
    """The same records with missing cells filled, each column in its own type, and `<column>_method` for each: null where the cell had a value.

    Rows that share an id, or have none, are filled each by its own cells; rows that repeat come out as often as they came in.
    """
    held = F.array_sort(F.collect_set(F.struct("field_name", "filled_value", "method")))  # of repeated rows one entry a field
    wide = fills(df, fields, k).groupBy(F.col("row").alias("__row"), F.col("copy").alias("__copy")).agg(F.map_from_entries(F.transform(held, lambda x: F.struct(x["field_name"], F.struct(x["filled_value"].alias("filled_value"), x["method"].alias("method"))))).alias("__f"))
    out = df.join(wide, F.col(fields.row).cast("long").eqNullSafe(F.col("__row")) & (copy_of(fields) == F.col("__copy")), "left")
    types = dict(df.dtypes)
    for c in fields.filled:
        f = F.try_element_at("__f", F.lit(c))
        value = f["filled_value"] if types[c] == "string" else F.round(f["filled_value"].try_cast("double")).cast(types[c])
        out = out.withColumn(f"{c}_method", f["method"]).withColumn(c, F.when(f.isNotNull(), value).otherwise(F.col(c)))
    return out.drop("__row", "__copy", "__f")


def fillable(procurement: DataFrame, finance: DataFrame) -> DataFrame:
    """table_name, record_id, field_name of the cells that the vendor's own records fill."""
    parts = [fills(df, f, own_only=True).select(F.lit(f.table).alias("table_name"), F.col("row").alias("record_id"), "field_name") for df, f in ((procurement, PROCUREMENT), (finance, FINANCE))]
    return parts[0].unionByName(parts[1])

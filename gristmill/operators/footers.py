"""Problem 7: column profiles from Parquet footers, with a scan of only what the footers can't tell.

Tasks read footers: exact null counts, extrema, encodings. A text column of a file whose row groups hold one load each
needs no values: nulls and extrema come from the footer, and its dictionary has the candidates for distinct values, of
which those count that a row holds. Whole tables have nulls and extrema from footers alone. What is left, file by file and column
by column, is scanned by Spark, with only those columns read. All parts are summed up for each load and column.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.values import has_number, has_text, spelled
from gristmill.sources.tables import cut, spread

FOOTER = "path string, row_group int, column string, rows long, nulls long, low string, high string, exact boolean, all_dictionary boolean, load_low string, load_high string, type string, stored string"
PART = "load string, column string, type string, rows long, nulls long, nan long, low string, high string, value string, read string"
#: Columns that only key a row: the record and its load. Profiles have them where they are asked for.
KEYS = ("record_id", "file_id")
#: A text extremum of this length may have been cut off by its writer, unless the footer says it is exact.
CUT_FROM = 64
#: Shifts: a load departs if its distance from the pooled distribution exceeds the loads' median distance by FAR typical deviations and by LEAST.
FAR, LEAST = 7.0, 0.07


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length of each Parquet file under `path`, listed by Spark without reading any."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")


def opened(path: str, dictionary: tuple[str, ...] = ()):
    """A Parquet file on a local or shared file system, by pyarrow; columns in `dictionary` keep their dictionaries."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    if path.startswith("file:"):
        return pq.ParquetFile(path.removeprefix("file:").replace("///", "/"), read_dictionary=list(dictionary))
    system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return pq.ParquetFile(system.open_input_file(place), read_dictionary=list(dictionary))


def footers(spark: SparkSession, path: str, load: str = "file_id") -> DataFrame:
    """A row for each chunk: nulls and extrema as the footer has them, null where it doesn't or where a cut-off extremum isn't exact; stored is the type as the file has it, all_dictionary whether it is text with a dictionary."""

    def whole(s) -> bool:
        """Whether both extrema are what the chunk holds: as the footer says, else by their length."""
        if not s.has_min_max:
            return False
        said = [getattr(s, f"is_{x}_value_exact", None) for x in ("min", "max")]
        return all(e if e is not None else not isinstance(v, (str, bytes)) or len(v) < CUT_FROM for e, v in zip(said, (s.min, s.max)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file in pdf["path"]:
                meta, rows = opened(file).metadata, []
                logical = {c.path: c.logical_type for c in (meta.schema.column(i) for i in range(meta.num_columns))}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    chunks = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
                    s = chunks[load].statistics if load in chunks else None
                    span = (str(s.min), str(s.max)) if s is not None and whole(s) and s.has_null_count and not s.null_count else (None, None)
                    for name, c in chunks.items():
                        s = c.statistics
                        known, ends = s is not None and s.has_null_count, s is not None and s.has_min_max
                        exact = s is not None and whole(s)
                        pages = "RLE_DICTIONARY" in c.encodings or "PLAIN_DICTIONARY" in c.encodings
                        kind = "numeric" if c.physical_type in {"INT32", "INT64", "FLOAT", "DOUBLE"} else "boolean" if c.physical_type == "BOOLEAN" else "text"
                        text = c.physical_type == "BYTE_ARRAY" and logical[name].type == "STRING"
                        rows.append((file, g, name, group.num_rows, s.null_count if known else None, str(s.min) if ends else None, str(s.max) if ends else None, exact, text and pages and c.has_dictionary_page, *span, kind, f"{c.physical_type} {logical[name]}"))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOOTER.split(", ")])

    return spread(parquet_files(spark, path), "path").mapInPandas(run, FOOTER)


def table_profile(spark: SparkSession, path: str) -> DataFrame:
    """column, type, rows, nulls, low, high, from_footers of the whole table from its footers alone.

    nulls, low and high are null if any chunk lacks them, and from_footers is false; NaN isn't null to a footer. An empty
    table has no chunks and no rows.
    """
    f = footers(spark, path)
    number = F.col("type") == "numeric"
    low = F.when(F.first(number), F.min(F.expr("try_cast(low AS double)")).cast("string")).otherwise(F.min("low"))
    high = F.when(F.first(number), F.max(F.expr("try_cast(high AS double)")).cast("string")).otherwise(F.max("high"))
    whole = F.bool_and(F.coalesce(F.col("nulls").isNotNull() & (F.col("exact") | (F.col("nulls") == F.col("rows"))), F.lit(False)))
    return f.groupBy("column").agg(
        F.first("type").alias("type"), F.sum("rows").alias("rows"), F.when(F.bool_and(F.col("nulls").isNotNull()), F.sum("nulls")).alias("nulls"), F.when(whole, low).alias("low"), F.when(whole, high).alias("high"), whole.alias("from_footers")
    )


def scanned(df: DataFrame, columns: list[str], load: str) -> DataFrame:
    """Rows of PART from values: one for each load, column and different value, with how often it stands there."""
    types = dict(df.dtypes)

    def kind(c: str) -> str:
        return "text" if types[c] == "string" else "boolean" if types[c] == "boolean" else "numeric"

    def cell(c: str) -> Column:
        nan = F.isnan(c) if types[c] in {"double", "float"} else F.lit(False)
        return F.struct(F.lit(c).alias("column"), F.lit(kind(c)).alias("type"), F.when(~nan, F.col(c)).cast("string").alias("value"), F.coalesce(nan, F.lit(False)).alias("nan"))

    cells = df.select(F.col(load).cast("string").alias("load"), F.explode(F.array(*map(cell, columns))).alias("c")).select("load", "c.*")
    n = cells.groupBy("load", "column", "type", "value", "nan").agg(F.count("*").alias("rows"))
    zero = F.lit(0).cast("bigint")
    return n.select(
        "load", "column", "type", "rows", F.when(F.col("value").isNull() & ~F.col("nan"), F.col("rows")).otherwise(zero).alias("nulls"), F.when(F.col("nan"), F.col("rows")).otherwise(zero).alias("nan"),
        F.col("value").alias("low"), F.col("value").alias("high"), "value", F.lit("chunk").alias("read"),
    )


def parts(spark: SparkSession, path: str, load: str = "file_id", skip: tuple[str, ...] | None = None) -> DataFrame:
    """Counts and extrema of each load and column in parts, and a row for each different value.

    read tells where a part came from: `dictionary` for a chunk whose values came from its dictionary and counts from its
    footer, `chunk` for what Spark scanned. Only text columns have dictionaries that can be read alone; a file's column is
    scanned if any of its row groups holds several loads or rows without one, has plain pages or lacks statistics, and
    numbers are, because different values are counted. Columns in `skip` have no parts: if it is None, the load and
    record_id; with () all columns have them. Files may differ in columns and types, and may lack the load.
    """
    skip = ("record_id", load) if skip is None else skip
    wanted = ~F.col("column").isin(*skip)
    f = cut(footers(spark, path, load))
    one = F.coalesce((F.col("load_low") == F.col("load_high")) & F.col("nulls").isNotNull() & F.col("all_dictionary") & (F.col("type") == "text"), F.lit(False))
    enough = f.groupBy("path", "column").agg(F.bool_and(one).alias("enough"), F.first("stored").alias("stored"))
    known = f.where(wanted).join(enough.where("enough"), ["path", "column"], "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        names = [c.split()[0] for c in PART.split(", ")]
        for pdf in batches:
            for row in pdf.itertuples():
                held = opened(row.path, (row.column,)).read_row_group(row.row_group, columns=[row.column]).column(0)
                used = [k.dictionary.take(k.indices.unique().drop_null()) for k in held.chunks]  # a writer may have put in what no row holds
                values = [v for v in pa.concat_arrays(used).unique().to_pylist() if v is not None] if used else []
                low, high = (row.low, row.high) if row.exact or not values else (min(values), max(values))
                out = [(row.load_low, row.column, row.type, row.rows, row.nulls, 0, low, high, None, "dictionary")]
                yield pd.DataFrame(out + [(row.load_low, row.column, row.type, 0, 0, 0, None, None, v, "dictionary") for v in values], columns=names)

    found = spread(known, "path", "row_group", "column").mapInPandas(run, PART)
    # files whose columns need the same scan, of the same types, are read together; paths are what the driver has listed anyway
    sets = enough.groupBy("path").agg(
        F.array_sort(F.collect_list(F.when(wanted & ~F.col("enough"), F.struct("column", "stored")))).alias("columns"), F.max(F.when(F.col("column") == load, F.col("stored"))).alias("load")
    ).where(F.size("columns") > 0)
    for r in sets.groupBy("columns", "load").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect():
        columns = [c.column for c in r.columns]
        df = spark.read.parquet(*r.paths)
        found = found.unionByName(scanned(df if r.load else df.withColumn(load, F.lit(None).cast("string")), columns, load))
    return found


def load_profiles(spark: SparkSession, path: str, load: str = "file_id", skip: tuple[str, ...] | None = None) -> DataFrame:
    """file_id, column_name, rows, null_rate (nulls and NaN over rows, four decimals), distinct_count (without those), inferred_type, low, high of each load and column.

    Rows without a load form a load of their own, null. An empty table gives no rows. `skip` is that of parts().
    """
    p = parts(spark, path, load, skip)
    per_value = p.groupBy("load", "column", "value").agg(
        F.first("type").alias("type"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("nan").alias("nan"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min(F.expr("try_cast(low AS double)")).alias("low_n"), F.max(F.expr("try_cast(high AS double)")).alias("high_n"),
    )
    number = F.first("type") == "numeric"
    return per_value.groupBy(F.col("load").alias("file_id"), F.col("column").alias("column_name")).agg(
        F.sum("rows").alias("rows"), F.round((F.sum("nulls") + F.sum("nan")).cast("decimal(20,0)") / F.sum("rows"), 4).cast("decimal(5,4)").alias("null_rate"), F.count("value").alias("distinct_count"), F.first("type").alias("inferred_type"),
        F.when(number, F.min("low_n").cast("string")).otherwise(F.min("low")).alias("low"), F.when(number, F.max("high_n").cast("string")).otherwise(F.max("high")).alias("high"),
    )


def all_profiles(spark: SparkSession, folder: str, skip: tuple[str, ...] = KEYS) -> DataFrame:
    """table_name and what load_profiles gives, of every column, but those in `skip`, of every load of the three TABLES."""
    found = [load_profiles(spark, f"{folder}/{t}.parquet", skip=skip).withColumn("table_name", F.lit(t)) for t in TABLES]
    return reduce(DataFrame.unionByName, found).select("table_name", "file_id", "column_name", "rows", "null_rate", "distinct_count", "inferred_type", "low", "high")


def table_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """table_name and what table_profile gives, of every column of the three TABLES."""
    found = [table_profile(spark, f"{folder}/{t}.parquet").withColumn("table_name", F.lit(t)) for t in TABLES]
    return reduce(DataFrame.unionByName, found).select("table_name", F.col("column").alias("column_name"), F.col("type").alias("inferred_type"), "rows", "nulls", "low", "high", "from_footers")


def wrong_rows(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """file_id, column_name of stored profile rows that differ from their load: in null_rate by more than rounding, in distinct_count or inferred_type.

    A row about a column that its load doesn't have is wrong; rows about files that are no load of these tables are left out.
    """
    loads = computed.select("file_id").distinct()
    c = computed.select("file_id", "column_name", F.col("null_rate").alias("r"), F.col("distinct_count").alias("d"), F.col("inferred_type").alias("t"))
    both = stored.join(loads, "file_id", "left_semi").join(c, ["file_id", "column_name"], "left")
    same = (F.abs(F.col("null_rate").cast("double") - F.col("r").cast("double")) < 0.00015) & (F.col("distinct_count") == F.col("d")) & (F.lower("inferred_type") == F.col("t"))
    return both.where(~F.coalesce(same, F.lit(False))).select("file_id", "column_name").distinct()


def shifted(df: DataFrame, numbers: tuple[str, ...], categories: tuple[str, ...], identifiers: tuple[str, ...], load: str = "file_id") -> DataFrame:
    """file_id, column_name, aspect, distance of loads that plainly depart from the others.

    Aspects are the share of missing cells, the range (tenths of all values, and how round they are), the mix of values,
    and the way of writing. A load's distance is the total variation between its shares and those of all loads together;
    it departs if that is far outside what the loads usually have. Fewer than four loads give no departures.
    """
    bounds = {c: df.where(has_number(F.col(c))).approxQuantile(c, [i / 10 for i in range(1, 10)], 0.001) for c in numbers}
    seen = []
    for c in (*numbers, *categories, *identifiers):
        ok = has_number(F.col(c)) if c in numbers else has_text(F.col(c))
        gone = F.when(F.col(c).isNull(), "null").when(~ok, "stands for none").otherwise("value")
        aspects = [("missing", gone, F.lit(True))]
        if c in numbers:
            value = F.col(c).cast("double")
            tenth = sum(((value > b).cast("int") for b in bounds[c]), F.lit(0))
            round_to = F.when(value % 100 == 0, "100").when(value % 10 == 0, "10").otherwise("1")
            aspects += [("range", tenth.cast("string"), ok), ("writing", round_to, ok)]
        else:
            shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(c), r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), r"\p{N}+", "9")
            aspects.append(("writing", shape, ok))
            if c in categories:
                aspects.append(("mix", spelled(F.col(c)), ok))
        seen += [F.when(when, F.struct(F.lit(c).alias("column_name"), F.lit(a).alias("aspect"), v.alias("kind"))) for a, v, when in aspects]
    n = df.where(F.col(load).isNotNull()).select(F.col(load).alias("file_id"), F.explode(F.array_compact(F.array(*seen))).alias("s")).groupBy("file_id", "s.column_name", "s.aspect", "s.kind").agg(F.count("*").alias("n"))
    n = cut(n)
    total = n.groupBy("file_id", "column_name", "aspect").agg(F.sum("n").alias("all"))
    pooled = n.groupBy("column_name", "aspect", "kind").agg(F.sum("n").alias("pn")).join(n.groupBy("column_name", "aspect").agg(F.sum("n").alias("pall")), ["column_name", "aspect"])
    pooled = pooled.withColumn("q", F.col("pn") / F.col("pall"))
    # total variation: half the sum of differences; kinds that a load lacks add up to 1 less its kinds' pooled shares
    near = n.join(total, ["file_id", "column_name", "aspect"]).join(pooled, ["column_name", "aspect", "kind"])
    near = near.groupBy("file_id", "column_name", "aspect").agg(F.sum(F.abs(F.col("n") / F.col("all") - F.col("q"))).alias("d"), F.sum("q").alias("covered"))
    near = near.withColumn("distance", (F.col("d") + 1 - F.col("covered")) / 2)
    middle = near.groupBy("column_name", "aspect").agg(F.percentile("distance", 0.5).alias("mid"), F.count("*").alias("loads"))
    off = near.join(middle, ["column_name", "aspect"]).withColumn("off", F.abs(F.col("distance") - F.col("mid")))
    typical = off.groupBy("column_name", "aspect").agg((F.percentile("off", 0.5) * 1.4826).alias("typical"))
    far = (F.col("distance") > F.col("mid") + FAR * F.col("typical")) & (F.col("distance") > F.col("mid") + LEAST) & (F.col("loads") >= 4)
    return off.join(typical, ["column_name", "aspect"]).where(far).select("file_id", "column_name", "aspect", "distance")


TABLES = ("procurement_export_batch1", "procurement_export_batch2", "finance_extract")


def wrong_and_shifted(spark: SparkSession, folder: str) -> DataFrame:
    """file_id, column_name, kind: `stored` for wrong stored profile rows, `shifted` for departing loads of batch 1."""
    stored = spark.read.parquet(f"{folder}/column_profile.parquet")
    # stored rows may be about keys too; keys that none is about decide no row here
    named = {r.column_name for r in stored.where(F.col("column_name").isin(*KEYS)).select("column_name").distinct().collect()}
    computed = cut(all_profiles(spark, folder, tuple(k for k in KEYS if k not in named)).select("file_id", "column_name", "null_rate", "distinct_count", "inferred_type"))
    batch1 = spark.read.parquet(f"{folder}/{TABLES[0]}.parquet")
    off = shifted(batch1, ("employee_count", "region_code"), ("compliance_flag",), ("registration_number",))
    return wrong_rows(stored, computed).withColumn("kind", F.lit("stored")).unionByName(off.select("file_id", "column_name", F.lit("shifted").alias("kind")).distinct())

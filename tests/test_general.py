"""Problems 1, 2 and 7: small fixtures, brute force, empty tables, clashing columns."""

import datetime as dt

from pyspark.sql import functions as F

from gristmill.functions.joins import hot_keys, split_join
from gristmill.functions.values import date_of, shared_identifiers
from gristmill.operators import drift, fill, footers
from gristmill.plans import problems

B1 = "record_id bigint, file_id string, entity_key string, source_system string, employee_count bigint, region_code double, compliance_flag string, registration_number string, updated_at string, cluster string, row string"


def test_dates(spark):
    texts = ["2026-01-02", "2026/01/02", "02.01.2026", "2 Jan 2026", "2026-01-02T00:00:00", "x", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(date_of(F.col("t"))).collect()]
    assert got == [dt.date(2026, 1, 2)] * 5 + [None, None]


def test_split_join_equals_join(spark):
    big = spark.createDataFrame([("h", i) for i in range(3000)] + [(f"k{i % 50}", i) for i in range(500)] + [(None, 1)], "k string, i bigint")
    small = spark.createDataFrame([("h", "x"), ("k1", "y"), ("z", "z")], "k string, v string")
    assert hot_keys(big, "k") == ["h"]
    assert sorted(map(str, split_join(big, small, "k").collect())) == sorted(map(str, big.join(small, "k", "left").collect()))


def test_fill(spark):
    data = [
        (1, "f", "A", "s", 10, 5.0, "clear", "REG-1", "2026-01-01", "c", "r"), (2, "f", "A", "s", -1, float("nan"), "N/A", " ", "01.02.2026", "c", "r"), (3, "f", "A", "s", 10, 7.0, "CLEAR ", None, None, "c", "r"),
        (4, "f", "B", "s", None, 5.0, None, "unknown", "2026-01-05", "c", "r"), (5, "f", None, "s", None, 0.0, "?", None, "2026-01-05", "c", "r"), (6, "f", "a", "s", 3, 1.0, "flagged", "REG-2", "2026-01-05", "c", "r"),
    ]
    df = spark.createDataFrame(data, B1)
    got = {(r.row, r.field_name): (r.filled_value, r.method) for r in fill.fills(df, fill.PROCUREMENT, k=2).collect()}
    assert {got[2, c][0] for c in ("employee_count", "compliance_flag", "registration_number")} == {"10.0", "clear", "REG-1"} and all(got[r, c][1] in fill.OWN for r, c in ((2, "employee_count"), (2, "compliance_flag"), (2, "registration_number"), (3, "registration_number")))
    assert got[4, "employee_count"][1] in {"cluster_quarter", "cluster"} and got[4, "registration_number"] == (None, "none")
    assert got[5, "employee_count"][1] == "all" and len(got) == 12
    wide = {r.record_id: r for r in fill.fill_missing(df, fill.PROCUREMENT, k=2).collect()}
    assert len(wide) == 6 and wide[2].employee_count == 10 and wide[1].employee_count_method is None and wide[2].cluster == "c" and wide[1].registration_number == "REG-1"
    assert fill.fills(df.where("false"), fill.PROCUREMENT).count() == 0
    finance = df.select("record_id", "entity_key", "registration_number", "updated_at", df.region_code.try_cast("bigint").alias("region_code"))
    found = {tuple(r) for r in fill.fillable(df, finance).collect()}
    assert ("finance_extract", 2, "registration_number") in found and ("procurement_export_batch1", 4, "employee_count") not in found


def test_repeated_rows_and_rows_without_id_are_filled_by_their_own_cells(spark):
    kind = "record_id long, file_id string, entity_key string, source_system string, employee_count long, region_code double, compliance_flag string, registration_number string, updated_at string"
    full = (1, "f", "VENAAAAAA", "s", 7, 2.0, "Y", "REG-123456", "2024-01-05")
    gap = (1, "f", "VENAAAAAA", "s", None, 2.0, None, "REG-123456", "2024-01-05")
    other = (1, "f", "VENBBBBBB", "s", 90, 4.0, "N", None, "2024-01-05")
    rows = [full, gap, gap, other, (None, *gap[1:])]
    out = fill.fill_missing(spark.createDataFrame(rows, kind), fill.PROCUREMENT).collect()
    assert len(out) == len(rows)
    assert sorted((r.entity_key, r.employee_count, r.employee_count_method is not None) for r in out) == [("VENAAAAAA", 7, False), *[("VENAAAAAA", 7, True)] * 3, ("VENBBBBBB", 90, False)]
    assert [r.registration_number_method for r in out if r.entity_key == "VENBBBBBB"] == ["none"]
    assert all(r.compliance_flag.upper() == "Y" for r in out if r.entity_key == "VENAAAAAA")


def test_fill_takes_the_median_of_records(spark):
    held = [10] * 7 + [900, 950]  # of the different values, the median is 900
    data = [(i, "f", "A", "s", v, 1.0, "clear", None, "2026-01-01", "c", "r") for i, v in enumerate(held)]
    data += [(20, "f", "A", "s", None, 1.0, "clear", None, "2026-01-01", "c", "r"), (21, "f", "N", "s", None, None, None, None, "2026-01-01", "c", "r")]
    data += [(30 + i, "f", "E", "s", 10, v, "clear", None, "2026-01-01", "c", "r") for i, v in enumerate((3.0, 3.0, 7.0, 7.0, None))]  # codes are not averaged
    got = {(r.row, r.field_name): (r.filled_value, r.method) for r in fill.fills(spark.createDataFrame(data, B1), fill.PROCUREMENT, k=1).collect()}
    assert got[20, "employee_count"] == ("10.0", "vendor_cluster") and got[21, "employee_count"] == ("10.0", "all") and got[34, "region_code"] == ("3.0", "vendor_cluster")


def test_fill_takes_like_records_of_the_vendor_first(spark):
    data = [(i, "f", "A", "s", 2 + i % 2, 1.0, "clear", "REG-1", "2026-01-01", "c", "r") for i in range(6)] + [(10 + i, "f", "A", "s", 4000 + i % 2, 2.0, "flagged", "REG-2", "2026-01-01", "c", "r") for i in range(4)]
    data += [(20, "f", "A", "s", None, 2.0, "flagged", "REG-000000", "2026-01-01", "c", "r"), (21, "f", "B", "s", 5, 1.0, None, "REG-XXXXXX", None, "c", "r")]
    got = {(r.row, r.field_name): (r.filled_value, r.method) for r in fill.fills(spark.createDataFrame(data, B1), fill.PROCUREMENT, k=2).collect()}
    assert got[20, "employee_count"] == ("4000.5", "vendor_cluster") and got[20, "registration_number"] == ("REG-2", "vendor_cluster")
    assert got[21, "registration_number"] == (None, "none") and got[21, "compliance_flag"] == ("clear", "cluster")


def test_identifiers_of_many_vendors_stand_for_none(spark):
    data = [(f"V{i}", "reg-777777 " if i % 2 else f"REG-{i:06d}") for i in range(200)] + [("V1", "REG-123456"), ("V2", None), (None, "REG-777777"), ("V3", "n/a")]
    assert shared_identifiers(spark.createDataFrame(data, "k string, v string"), "v", "k") == ("reg-777777",)
    assert shared_identifiers(spark.createDataFrame([], "k string, v string"), "v", "k") == ()


def test_finance_comes_out_filled(spark, tmp_path):
    data = [(1, "f", "A", "s", 1, "REG-1", "2026-01-01"), (2, "f", "A", "s", 1, None, "2026-01-02"), (3, "f", "B", "s", 2, "n/a", None), (4, "f", None, "s", 2, "REG-9", None)]
    spark.createDataFrame(data, "record_id bigint, file_id string, entity_key string, source_system string, region_code bigint, registration_number string, updated_at string").write.parquet(str(tmp_path / "finance_extract.parquet"))
    got = {r.record_id: (r.registration_number, r.registration_number_method) for r in problems.QUERIES["p1_filled_finance"](spark, str(tmp_path)).collect()}
    assert got == {1: ("REG-1", None), 2: ("REG-1", "vendor_cluster"), 3: (None, "none"), 4: ("REG-9", None)}


def feed(spark):
    lines = [
        ("f1", 0, "entity_key,updated_at,n,flag,due"), ("f1", 1, "VENAAAAA1,2026-01-01,1,clear,14"), ("f1", 2, "VENAAAAA2,2026-01-02,2,flagged,30"), ("f1", 3, "VENAAAAA3,2026-01-02,NULL,clear,60"),
        ("f2", 0, "Vendor,as_of,flag,n"), ("f2", 1, "VENAAAAA1,2026-02-01,clear,1-4"), ("f2", 2, "VENAAAAA2,2026-02-02,flagged,20+"), ("f2", 3, "VENAAAAA4,2026-02-02,N/A,5-9"),
        ("f3", 0, "Vendor,as_of,flag,n,score"), ("f3", 1, "VENAAAAA1,2026-03-01,true,1-4,3.5"), ("f3", 2, "VENAAAAA2,2026-03-02,false,20+,4"), ("x", 1, "no header"), ("f2", 4, None),
    ]
    registry = [("f1", "A_Feed", dt.datetime(2026, 1, 3)), ("f2", "a feed", dt.datetime(2026, 2, 3)), ("f3", "a_feed", dt.datetime(2026, 3, 3))]
    return spark.createDataFrame(lines, "file_id string, line_no int, content string"), spark.createDataFrame(registry, "id string, source_system string, received_at timestamp")


def test_drift(spark):
    lines, registry = feed(spark)
    got = {(r.file_id, r.field_name, r.change_kind) for r in drift.changes(lines, registry).collect()}
    assert got == {("f2", "Vendor", "renamed"), ("f2", "as_of", "renamed"), ("f2", "due", "removed"), ("f2", "n", "retyped"), ("f3", "score", "added"), ("f3", "flag", "retyped")}
    assert drift.changes(lines.where("false"), registry.where("false")).count() == 0


def test_rescue_and_replay(spark):
    lines, registry = feed(spark)
    target = {"entity_key": "string", "updated_at": "date", "n": "bigint"}
    table = drift.ingest(lines, drift.files(lines, registry), target)
    got = {(r.file_id, r.line_no): r for r in table.collect()}
    assert got["f1", 1].n == 1 and got["f1", 1]._rescued == '{"flag":"clear","due":"14"}'
    assert got["f2", 1].n is None and '"n":"1-4"' in got["f2", 1]._rescued and got["x", 1]._rescued == '{"_beyond":"no header"}'
    approved = spark.createDataFrame([("Vendor", "entity_key"), ("as_of", "updated_at")], "alias string, field string")
    after = {(r.file_id, r.line_no): r for r in drift.replay(table, approved, target).collect()}
    assert after["f2", 1].entity_key == "VENAAAAA1" and after["f2", 1].updated_at == dt.date(2026, 2, 1) and "as_of" not in after["f2", 1]._rescued and '"n":"1-4"' in after["f2", 1]._rescued
    assert {r.alias: r.field for r in drift.aliases(drift.changes(lines, registry), target).collect()} == {"Vendor": "entity_key", "as_of": "updated_at"}


def test_rescue_keeps_cells_as_written(spark):
    lines = spark.createDataFrame([("f", 0, "entity_key,employee_count,credit_limit,updated_at,odd"), ("f", 1, "VENAAAAA1,007,5,01.02.2026,x"), ("f", 2, "VENAAAAA2,12,2.5,2026-02-01,N/A")], "file_id string, line_no int, content string")
    registry = spark.createDataFrame([("f", "s", None, 3)], "id string, source_system string, received_at timestamp, schema_version int")
    f = drift.files(lines, registry)
    got = {(r.line_no, r.header): (r.row_key, r.value) for r in drift.cells(drift.ingest(lines, f)).collect()}
    assert got == {(1, h): ("VENAAAAA1", v) for h, v in zip("entity_key employee_count credit_limit updated_at odd".split(), ("VENAAAAA1", "007", "5", "01.02.2026", "x"))} | {(2, h): ("VENAAAAA2", v) for h, v in zip("entity_key employee_count credit_limit updated_at".split(), ("VENAAAAA2", "12", "2.5", "2026-02-01"))}
    settled = {r.line_no: r for r in drift.replay(drift.ingest(lines, f), spark.createDataFrame([], "alias string, field string")).collect()}
    assert settled[1].employee_count == 7 and settled[1].updated_at == dt.date(2026, 2, 1) and settled[1]._rescued == '{"odd":"x"}' and settled[2]._rescued is None
    versions = drift.version_report(drift.changes(lines, registry), f, registry).collect()
    assert [(r.file_id, r.stored_version, r.version, r.n_changes, r.agrees) for r in versions] == [("f", 3, 1, 0, False)]


def test_tables_that_drift(spark):
    old = spark.createDataFrame([(i, "a", f"V{i % 9}", float(i) if i % 2 else None, f"REG-{i % 9}") for i in range(40)], "record_id bigint, file_id string, entity_key string, region_code double, registration_number string")
    new = spark.createDataFrame([(i, "b", f"V{i % 9}", i, f"reg-{i % 9} ", "gold" if i else "n/a") for i in range(30)], "record_id bigint, file_id string, entity_key string, region_code bigint, registration_no string, contract_tier string")
    report = drift.table_changes(old, new, "t")
    assert {tuple(r)[1:] for r in report.collect()} == {("region_code", "retyped", "decimal"), ("registration_no", "renamed", "registration_number"), ("contract_tier", "added", None)}
    both = drift.replay(drift.from_table(old).unionByName(drift.from_table(new)), drift.aliases(report)).collect()
    assert len(both) == 70 and all(r.registration_number and r._rescued is None for r in both) and sum(r.contract_tier is None for r in both) == 41 and sum(r.region_code is None for r in both) == 20
    assert drift.table_changes(old.where("false"), new.where("false"), "t").count() == 4


def test_aliases_of_any_distance_and_direction(spark):
    renames = [("a1", "updated_at"), ("a2", "a1"), ("a3", "a2"), ("a4", "a3"), ("a5", "a4"), ("n", "headcount"), ("headcount", "staff"), ("a1", "n"), ("x", "y")]
    report = spark.createDataFrame([("f", new, "renamed", old) for new, old in renames] + [("f", "z", "added", None)], "file_id string, field_name string, change_kind string, was string")
    got = {r.alias: r.field for r in drift.aliases(report, {"updated_at": "date", "n": "bigint"}).collect()}
    assert got == {"a1": "updated_at", "a2": "updated_at", "a3": "updated_at", "a4": "updated_at", "a5": "updated_at", "headcount": "n", "staff": "n"}
    assert drift.aliases(report.where("false")).count() == 0


def test_footer_profile_equals_scan(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    data = {"record_id": list(range(12)), "file_id": ["a"] * 5 + ["b"] * 5 + ["c"] * 2, "x": [1.0, None, float("nan"), 2.0, 2.0, 3.0, 3.0, None, None, 4.0, None, None], "s": ["p", "q", None, "p", "P", "x", "x", "x", "", " ", None, None], "n": [1, 2, 3, None, 1, 5, 5, 5, 5, 5, 9, 9]}
    for size in (5, 4):
        path = str(tmp_path / f"t{size}.parquet")
        pq.write_table(pa.table(data), path, row_group_size=size)
        got = {(r.file_id, r.column_name): (r.rows, float(r.null_rate), r.distinct_count, r.inferred_type) for r in footers.load_profiles(spark, path).collect()}
        assert got["a", "x"] == (5, 0.4, 2, "numeric") and got["a", "s"] == (5, 0.2, 3, "text") and got["b", "s"] == (5, 0.0, 3, "text") and got["c", "x"] == (2, 1.0, 0, "numeric") and got["b", "n"] == (5, 0.0, 1, "numeric")
        read = {r.read for r in footers.parts(spark, path).select("read").distinct().collect()}
        assert read == ({"chunk", "dictionary"} if size == 5 else read) and "chunk" in read
        whole = {r.column: r for r in footers.table_profile(spark, path).collect()}
        assert (whole["n"].nulls, whole["n"].low, whole["n"].high, whole["s"].nulls) == (1, "1.0", "9.0", 3)
    loose = str(tmp_path / "n.parquet")
    pq.write_table(pa.table({"file_id": ["a", None, "a"], "s": ["x", "y", None]}), loose)
    assert {(r.file_id, r.rows, r.distinct_count) for r in footers.load_profiles(spark, loose).collect()} == {("a", 2, 1), (None, 1, 1)}
    empty = str(tmp_path / "e.parquet")
    pq.write_table(pa.table(data).slice(0, 0), empty)
    assert footers.load_profiles(spark, empty).count() == 0


def test_only_columns_that_footers_leave_open_are_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"file_id": ["a", "a", "b", "b"], "s": ["x", None, "y", "y"], "n": [1, 2, 2, 2]}), str(tmp_path / "one.parquet"), row_group_size=2)
    found = footers.parts(spark, str(tmp_path / "one.parquet"))
    assert "ReadSchema: struct<file_id:string,n:bigint>" in found._jdf.queryExecution().toString()
    assert {(r.load, r.column, r.value) for r in found.where("value is not null and read = 'dictionary'").collect()} == {("a", "s", "x"), ("b", "s", "y")}
    # two loads whose names are alike up to where a writer cuts them off aren't one
    long = "l" * 100
    pq.write_table(pa.table({"file_id": [long + "a", long + "b"], "s": ["x", "y"]}), str(tmp_path / "two.parquet"))
    assert footers.load_profiles(spark, str(tmp_path / "two.parquet")).count() == 2


def test_profiles_of_all_tables_with_ranges(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for t in footers.TABLES:
        pq.write_table(pa.table({"record_id": [1, 2, 3, 4], "file_id": ["a", "a", "b", "b"], "region_code": [float("nan"), None, 3.0, float("nan")], "n": [7, 12, None, None], "updated_at": ["x" * 5000 + "b", "x" * 5000 + "a", "q", None]}), str(tmp_path / f"{t}.parquet"), row_group_size=2)
    got = {(r.table_name, r.file_id, r.column_name): (r.low, r.high, r.distinct_count) for r in problems.QUERIES["p7_profiles"](spark, str(tmp_path)).collect()}
    assert len(got) == 3 * 2 * 3
    for t in footers.TABLES:
        assert got[t, "a", "region_code"] == (None, None, 0) and got[t, "b", "region_code"] == ("3.0", "3.0", 1) and got[t, "a", "n"] == ("7.0", "12.0", 2) and got[t, "b", "n"] == (None, None, 0)
        assert got[t, "a", "updated_at"] == ("x" * 5000 + "a", "x" * 5000 + "b", 2)
    whole = {(r.table_name, r.column_name): (r.rows, r.nulls, r.low, r.high, r.from_footers) for r in problems.QUERIES["p7_tables"](spark, str(tmp_path)).collect()}
    assert len(whole) == 3 * 5 and all(whole[t, "n"] == (4, 2, "7.0", "12.0", True) for t in footers.TABLES)


def test_no_column_load_or_type_is_left_out_of_profiles(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    profile = lambda path, **k: {(r.file_id, r.column_name): (r.rows, float(r.null_rate), r.distinct_count) for r in footers.load_profiles(spark, str(path), **k).collect()}
    # every column of every load, keys too; stored rows about keys are judged by their loads
    for t in footers.TABLES:
        pq.write_table(pa.table({"record_id": [1, 2, 2, 4], "file_id": [f"{t}/a", f"{t}/a", f"{t}/b", f"{t}/b"], "employee_count": [7, None, 3, 3], "region_code": [1.0] * 4, "compliance_flag": ["x"] * 4, "registration_number": ["y"] * 4}), str(tmp_path / f"{t}.parquet"), row_group_size=2)
    rows = {(r.file_id, r.column_name): (r.rows, r.distinct_count, r.inferred_type) for r in problems.QUERIES["p7_columns"](spark, str(tmp_path)).collect()}
    assert len(rows) == 3 * 2 * 6 and all(rows[f"{t}/a", "record_id"] == (2, 2, "numeric") and rows[f"{t}/b", "file_id"] == (2, 1, "text") for t in footers.TABLES)
    a, b = (f"{footers.TABLES[1]}/{x}" for x in "ab")
    stored = [(a, "record_id", 0.0, 2, "numeric"), (b, "record_id", 0.0, 1, "numeric"), (a, "file_id", 0.0, 1, "text"), (b, "file_id", 0.5, 1, "text"), (a, "employee_count", 0.5, 1, "numeric")]
    for some in (stored, stored[2:]):
        spark.createDataFrame(some, "file_id string, column_name string, null_rate double, distinct_count bigint, inferred_type string").write.mode("overwrite").parquet(str(tmp_path / "column_profile.parquet"))
        got = {tuple(r) for r in footers.wrong_and_shifted(spark, str(tmp_path)).collect()}
        assert got == {(b, c, "stored") for _, c, *_ in some if c != "employee_count"}
    # entries of a dictionary that no row holds
    pq.write_table(pa.table({"file_id": ["a"] * 4, "s": pa.DictionaryArray.from_arrays(pa.array([0, 0, None, 1]), pa.array(["x", "y", "unused", "zz"]))}), str(tmp_path / "dictionary.parquet"))
    assert profile(tmp_path / "dictionary.parquet") == {("a", "s"): (4, 0.25, 2)}
    # a file without the load, and one of another type, beside others
    (tmp_path / "mixed").mkdir()
    for i, data in enumerate(({"n": [1, 2]}, {"file_id": ["a", "b"], "n": [3, 3]}, {"file_id": ["b", "b"], "n": [3.5, None]})):
        pq.write_table(pa.table(data), str(tmp_path / "mixed" / f"{i}.parquet"))
    assert profile(tmp_path / "mixed") == {(None, "n"): (2, 0.0, 2), ("a", "n"): (1, 0.0, 1), ("b", "n"): (3, 0.3333, 2)}
    # no text, so without a dictionary of text
    pq.write_table(pa.table({"file_id": ["a", "a"], "x": pa.array([1, None], pa.decimal128(25, 4))}), str(tmp_path / "decimal.parquet"))
    assert profile(tmp_path / "decimal.parquet", skip=()) == {("a", "x"): (2, 0.5, 1), ("a", "file_id"): (2, 0.0, 1)}


def test_wrong_rows(spark):
    computed = spark.createDataFrame([("a", "x", 0.25, 3, "text"), ("a", "y", 0.0, 1, "numeric")], "file_id string, column_name string, null_rate double, distinct_count bigint, inferred_type string")
    stored = spark.createDataFrame([("a", "x", 0.25, 3, "text"), ("a", "y", 0.0, 2, "numeric"), ("a", "z", 0.0, 2, "text"), ("other", "x", 0.0, 1, "text"), ("a", "x", None, None, None)], computed.schema)
    assert {r.column_name for r in footers.wrong_rows(stored, computed).collect()} == {"x", "y", "z"}


def test_shifted(spark):
    data = [(f"load{i}", None if i == 3 and j % 2 else j % 7 + 1 + (100 if i == 5 else 0), "clear" if j % 3 else "flagged", f"{'HR/' if i == 2 else 'REG-'}{j:06d}") for i in range(12) for j in range(200)]
    df = spark.createDataFrame(data, "file_id string, employee_count bigint, compliance_flag string, registration_number string")
    got = {(r.file_id, r.column_name) for r in footers.shifted(df, ("employee_count",), ("compliance_flag",), ("registration_number",)).collect()}
    assert got == {("load3", "employee_count"), ("load5", "employee_count"), ("load2", "registration_number")}

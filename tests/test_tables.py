from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import storage
from tidemark.operators import ids, tables, watermark
from tidemark.operators.tables import KeyedTable, create_or_upsert
from tidemark.plans import extracts, lakehouse, star
from tidemark.plans.lakehouse import LAKE_TABLES, upsert_lake_table
from tidemark.sinks import files as sinks
from tidemark.sources import database, files

ORDERS = "order_id int, order_timestamp timestamp, total double"


def orders(spark, *listed):
    return spark.createDataFrame([(i, datetime.fromisoformat(t), v) for i, t, v in listed], ORDERS)


def test_upsert_rewrites_touched_dates_only_and_rows_may_move(spark, tmp_path):
    lake = KeyedTable(spark, str(tmp_path / "lake"))
    layout = LAKE_TABLES["orders"]
    upsert_lake_table(lake, orders(
        spark, (1, "2024-01-01T01:00", 1.0), (2, "2024-01-02T01:00", 2.0), (3, "2024-01-03T01:00", 3.0)
    ), layout)
    before = lake._published()["slices"]
    upsert_lake_table(lake, orders(spark, (2, "2024-01-05T01:00", 20.0), (4, "2024-01-01T02:00", 4.0)), layout)
    after = lake._published()["slices"]
    assert [(r[0], r["order_date"], r["total"]) for r in lake.read().orderBy("order_id").collect()] == [
        (1, date(2024, 1, 1), 1.0), (2, date(2024, 1, 5), 20.0), (3, date(2024, 1, 3), 3.0), (4, date(2024, 1, 1), 4.0),
    ]
    assert after["order_date=2024-01-03"] == before["order_date=2024-01-03"]
    assert "order_date=2024-01-02" not in after
    assert after["order_date=2024-01-01"] != before["order_date=2024-01-01"]


def test_rows_without_a_date_have_a_folder_too(spark, tmp_path):
    lake = KeyedTable(spark, str(tmp_path / "lake"))
    df = spark.createDataFrame([(1, None), (2, date(2024, 1, 1))], "k int, d date")
    lake.create(df, "d")
    lake.upsert(spark.createDataFrame([(1, date(2024, 1, 1))], "k int, d date"), ["k"])
    assert rows(lake.read()) == [(1, date(2024, 1, 1)), (2, date(2024, 1, 1))]
    assert list(lake._published()["slices"]) == ["d=2024-01-01"]


def test_reading_some_dates_opens_their_folders_only(spark, tmp_path):
    lake = KeyedTable(spark, str(tmp_path / "lake"))
    lake.create(spark.createDataFrame([(i, date(2024, 1, i)) for i in range(1, 6)], "k int, d date"), "d")
    some = lake.read([date(2024, 1, 2), date(2024, 2, 1)])
    assert rows(some) == [(2, date(2024, 1, 2))]
    assert all("d=2024-01-02" in f for f in some.inputFiles())
    assert lake.read([]).count() == 0


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(1, "x")], "k int, v string"))
    twice = spark.createDataFrame([(1, "y"), (1, "z")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        held.upsert(twice, ["k"])
    assert held.version() == 1 and rows(held.read()) == [(1, "x")]


def test_two_writers_of_one_version_do_not_mix(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(1, "x")], "k int, v string"))
    late = KeyedTable(spark, held.root)
    late.version = lambda: 1  # saw the table before the other writer published
    held.upsert(spark.createDataFrame([(2, "first")], "k int, v string"), ["k"])
    with pytest.raises(FileExistsError):
        late.replace(spark.createDataFrame([(3, "second")], "k int, v string"))
    assert rows(KeyedTable(spark, held.root).read()) == [(1, "x"), (2, "first")]


def test_a_batch_counts_once(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(1, 1)], "k int, v int"))

    def add(batch):
        held.upsert(
            spark.createDataFrame([(1, 0)], "k int, v int"), ["k"], feed="f", batch=batch,
            merge=lambda t, s, keys: t.withColumn("v", F.col("v") + 1),
        )

    for batch in (0, 0, 1, 1, 0):
        add(batch)
    assert rows(held.read()) == [(1, 3)]


def test_readers_of_an_older_version_are_not_disturbed(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(1, "x")], "k int, v string"))
    old = held.read()
    held.upsert(spark.createDataFrame([(1, "y")], "k int, v string"), ["k"])
    assert rows(old) == [(1, "x")] and rows(held.read()) == [(1, "y")]


def test_missing_table_is_created_with_unique_keys(spark, tmp_path):
    twice = spark.createDataFrame([(1, "y"), (1, "z")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        create_or_upsert(KeyedTable(spark, str(tmp_path / "a")), twice, ["k"])
    kept = create_or_upsert(KeyedTable(spark, str(tmp_path / "b")), twice, ["k"], on_duplicate="latest", order_by=["v"])
    assert rows(kept.read()) == [(1, "z")]
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "c")).read()


def test_staging_load_keeps_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('x,y\n1,"two\nlines, one text"\n2,plain\n')
    schema = "id int, body string"
    table = KeyedTable(spark, str(tmp_path / "stage"))
    staged = files.load_staging(spark, str(tmp_path / "in.csv"), schema, table, multi_line=True)
    assert rows(staged) == [(1, "two\nlines, one text"), (2, "plain")]


PRODUCTS = "product_id long, department_id int, department string"


def test_a_changed_product_rewrites_one_bucket(spark, tmp_path):
    lake, layout = KeyedTable(spark, str(tmp_path / "lake")), LAKE_TABLES["products"]
    held = [(i, 1, f"d{i}") for i in range(200)] + [(None, 2, "no key")]
    upsert_lake_table(lake, spark.createDataFrame(held, PRODUCTS), layout)
    before = lake._published()["slices"]
    assert len(before) == lakehouse.BUCKETS
    # Keys of another whole-number type find the same bucket.
    change = spark.createDataFrame([(7, 3, "new")], PRODUCTS.replace("product_id long", "product_id int"))
    upsert_lake_table(lake, change, layout)
    after = lake._published()["slices"]
    assert sum(after[f] != before[f] for f in before) == 1
    assert set(rows(lake.read())) == {h for h in held if h[0] != 7} | {(7, 3, "new")}
    assert len(lake.read(lake.touched_dates(change, ["product_id"])).inputFiles()) == 1


def test_buckets_with_new_null_and_no_keys(spark, tmp_path):
    lake = KeyedTable(spark, str(tmp_path / "lake"))
    frame = lambda *r: spark.createDataFrame(list(r), "a int, b string, v int")
    create_or_upsert(lake, frame((1, "x", 1), (2, None, 2)), ["a", "b"], buckets=4)
    lake.upsert(frame(), ["a", "b"])
    lake.upsert(frame((2, None, 3), (3, "z", 4)), ["b", "a"])
    assert rows(lake.read()) == [(1, "x", 1), (2, None, 2), (2, None, 3), (3, "z", 4)]
    # Other keys than those of the buckets: the whole table is read.
    lake.upsert(frame((1, "moved", 5)), ["a"])
    want = [(1, "moved", 5), (2, None, 2), (2, None, 3), (3, "z", 4)]
    assert rows(lake.read()) == want
    lake.rebucket(2)
    assert rows(lake.read()) == want and len(lake._published()["slices"]) <= 2
    lake.upsert(frame((3, "z", 6)), ["a", "b"])
    assert (3, "z", 6) in rows(lake.read()) and lake.read().count() == 4
    for bad in ({"buckets": 0, "keys": ["a"]}, {"buckets": 2}):
        with pytest.raises(ValueError):
            KeyedTable(spark, str(tmp_path / "bad")).create(frame(), **bad)
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "plain")).create(frame()).rebucket(2)


def test_layout_keys_are_lists():
    assert all(isinstance(t.keys, list) for t in lakehouse.LAKE_TABLES.values())


# -- ids ----------------------------------------------------------------------

def test_ids_follow_the_order_without_gaps_even_when_values_repeat(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id")
    out = ids.assign_ids(df, "n", ["v"], start=10).orderBy("n").collect()
    assert [r["n"] for r in out] == list(range(10, 5010))
    assert [r["v"] for r in out] == sorted(r["v"] for r in out)
    assert sorted(r["id"] for r in out) == list(range(5000))


def test_ids_of_nothing(spark):
    nothing = spark.createDataFrame([], "v int")
    assert ids.assign_ids(nothing, "n", ["v"]).count() == 0
    assert ids.next_id(spark.createDataFrame([], "n bigint"), "n") == 1


# -- marks ----------------------------------------------------------------------

def test_marks_move_after_the_load_and_stay_on_an_empty_extract(spark, tmp_path):
    store = watermark.seed_marks(KeyedTable(spark, str(tmp_path / "marks")), [("t", "v", None), ("u", None, None)])
    source = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c")], "v int, w string")
    seen = []

    def take(df):
        seen.append(rows(df))

    assert extracts.incremental_load(source, "t", store, take) == "3"
    assert extracts.incremental_load(source, "t", store, take) == "3"
    assert len(seen) == 1 and len(seen[0]) == 3
    more = source.union(spark.createDataFrame([(3, "late"), (12, "d")], "v int, w string"))

    def fail(df):
        raise RuntimeError("landing failed")

    with pytest.raises(RuntimeError):
        extracts.incremental_load(more, "t", store, fail)
    assert watermark.get_hwm(store, "t") == ("v", "3")
    assert extracts.incremental_load(more, "t", store, take) == "12"
    assert seen[1] == [(12, "d")]
    with pytest.raises(LookupError):
        watermark.get_hwm(store, "u")


def test_date_slice_is_a_range_the_scan_can_use(spark, tmp_path, settings):
    settings(maxMetadataStringLength="2000")
    path = str(tmp_path / "e")
    orders(spark, (1, "2024-01-01T23:59:59", 1.0), (2, "2024-01-02T00:00:00", 2.0), (3, "2024-01-03T00:00:00", 3.0)
           ).write.parquet(path)
    day = watermark.extract_date_slice(spark.read.parquet(path), "order_timestamp", date(2024, 1, 2))
    assert [r[0] for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_timestamp" in plan and "LessThan(order_timestamp" in plan


def test_target_mark_of_an_empty_table(spark):
    nothing = spark.createDataFrame([], "viewed_at timestamp")
    assert str(watermark.target_watermark(nothing, "viewed_at").first()[0]) == "1970-01-01 00:00:00"


# -- star ------------------------------------------------------------------------

def test_two_users_viewing_at_once_are_two_facts(spark):
    viewed = datetime(2024, 1, 1)
    viewings = spark.createDataFrame(
        [(1, 10, viewed, "Y", "call"), (2, 10, viewed, None, "mail"), (1, 99, viewed, "N", "call")],
        "user_id int, apartment_id bigint, viewed_at timestamp, is_wishlisted string, call_to_action string",
    )
    homes = spark.createDataFrame([(10, "t", 5.0, "USD")], "id bigint, title string, price double, currency string")
    fees = spark.createDataFrame([(10, 1.0)], "id bigint, fee double")
    fact = spark.createDataFrame(
        [], "viewing_id bigint, apartment_id bigint, user_id int, viewed_at timestamp, is_wishlisted boolean, "
        "call_to_action string, price double, fee double, currency string"
    )
    merged = star.merge_fact_viewings(fact, star.stage_fact_viewings(viewings, homes, fees, fact))
    assert [tuple(r) for r in merged.select("viewing_id", "user_id", "is_wishlisted").orderBy("viewing_id").collect()] == [
        (1, 1, True), (2, 2, None)
    ]
    held = merged.cache()
    again = star.merge_fact_viewings(held, star.stage_fact_viewings(viewings, homes, fees, held))
    assert rows(again) == rows(held)


# -- files -------------------------------------------------------------------------

def test_extract_export_is_header_and_lines(spark, tmp_path):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([(1, "Test Apartment", 1200)], "id int, name string, price int").coalesce(1)
    assert sinks.write_extract(df, path) is True
    assert sinks.write_extract(df.filter("id > 5"), path) is False
    (part,) = [e for e in storage.listing(spark, path) if e.name.endswith(".csv")]
    assert storage.read_text(spark, part.path) == "id,name,price\n1,Test Apartment,1200\n"


def test_csv_header_is_not_a_row_and_quotes_survive(spark, tmp_path):
    (tmp_path / "a.csv").write_text('location_id,location_name\n1,"Jackson, ""J"" and Sons"\n')
    df = files.read_csv(spark, str(tmp_path / "a.csv"), "location_id int, location_name string")
    assert rows(df) == [(1, 'Jackson, "J" and Sons')]


def test_files_of_one_dataset_are_taken_by_column_name(spark, tmp_path):
    from tidemark.schemas import columns

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "1.csv").write_text("k,v\n1,x\n")
    (tmp_path / "b" / "1.csv").write_text("v,extra,k\ny,0,2\n")
    out = files.read_many(spark, [str(tmp_path / "a"), str(tmp_path / "b")], columns("k int, v string, w int"))
    assert rows(out) == [(1, "x", None), (2, "y", None)]


def test_newest_snapshot_with_all_its_parts(spark, tmp_path):
    import os

    for run, at, parts in (("old", 1000, 3), ("new", 2000, 2)):
        (tmp_path / run).mkdir()
        for i in range(parts):
            file = tmp_path / run / f"{i}.csv"
            file.write_text(f"v\n{run}{i}\n")
            os.utime(file, (at, at))
    assert rows(files.read_latest_snapshot(spark, str(tmp_path), "v string")) == [("new0",), ("new1",)]


def test_split_read_needs_all_its_parts():
    assert database.split_options(None, None, None, None) == {}
    assert database.split_options("id", 0, 9, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        database.split_options("id", 0, None, 4)


def test_run_merge_and_staging_leave_no_table_behind(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(1, "x")], "k int, v string"))
    tables.run_merge(held, lambda: spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string"), ["k"])
    assert rows(held.read()) == [(1, "y"), (2, "z")]
    assert sorted(e.name for e in storage.listing(spark, held.root)) == ["data", "published"]


def test_csv_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,extra,a\n1,x,2\n")
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), "a int, b int")) == [(2, 1)]
    with pytest.raises(ValueError, match="lacks the columns c"):
        files.read_csv(spark, str(tmp_path / "a.csv"), "a int, c int")
    (tmp_path / "b.csv").write_text("a,extra,b\n1,x,2\n")
    with pytest.raises(Exception):  # headers differ between the files
        files.read_csv(spark, str(tmp_path / "*.csv"), "a int, b int").collect()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "c.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path / "none"), "a int").count() == 0


def test_line_breaks_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, None), (3, "one")], "id int, body string")
    sinks.write_csv(df, str(tmp_path / "out"), multi_line=True)
    assert rows(files.read_csv(spark, str(tmp_path / "out"), df.schema, multi_line=True)) == rows(df)
    with pytest.raises(Exception, match="line break"):
        sinks.write_csv(df, str(tmp_path / "other"))


def test_parallel_writers_all_land(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    table = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([], "k int, v string"))
    frames = [spark.createDataFrame([(10 * w + i, f"w{w}") for i in range(3)], "k int, v string") for w in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda df: table.upsert(df, ["k"]), frames))
    assert sorted(r["k"] for r in table.read().collect()) == sorted(10 * w + i for w in range(4) for i in range(3))
    assert table.version() == 5


def test_old_versions_are_removed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([(0, "a")], "k int, v string"))
    for i in range(1, 5):
        table.upsert(spark.createDataFrame([(i, "a")], "k int, v string"), ["k"])
    table.retain(2)
    assert len(list((tmp_path / "t" / "published").glob("*.json"))) == 2
    assert len(list((tmp_path / "t" / "data").glob("commit=*"))) == 2
    assert table.read().count() == 5 and table.read(version=4).count() == 4

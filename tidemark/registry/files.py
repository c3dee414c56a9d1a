"""File sources and sinks, and the checks on landing files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..operators.tables import KeyedTable
from ..plans import trips
from ..schemas import COMMERCE_ORDERS, FILE_CONTRACTS, SONGS, columns
from ..session import scratch_path
from ..sinks import files as sinks
from ..sources import files as sources
from . import bindings as b
from .core import day, query, table, ts
from .kpis import FARES_SQL

LANDED_ORDERS = columns("order_id bigint, user_id bigint, status string, ordered_at timestamp, amount double")
_LANDED = f"o_orderkey as order_id, o_custkey as user_id, o_orderstatus as status, {ts('o_orderdate')} as ordered_at"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        F.col("o_totalprice").alias("amount"),
    )


@query("csv_scan", f"select {_LANDED}, o_totalprice as amount from orders")
def csv_scan(spark, sf):
    """Rows written as CSV, overwritten once, and read with a schema."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(_orders(spark, sf).filter("status = 'F'"), path)
    sinks.write_csv(_orders(spark, sf), path)
    return sources.read_csv(spark, path, LANDED_ORDERS)


@query("csv_song_catalogue", """
select cast(p_partkey as varchar) as track_id, p_brand as artists, p_name || ', "live"' as track_name,
  cast(p_size * 1000 as bigint) as duration_ms, p_size > 25 as explicit, p_retailprice as tempo,
  p_type as track_genre from part""")
def csv_song_catalogue(spark, sf):
    """The 21 columns of a catalogue; names with commas and quotes come back whole."""
    part = table(spark, sf, "part")
    given = {
        "id": F.col("p_partkey"), "track_id": F.col("p_partkey"), "artists": F.col("p_brand"),
        "track_name": F.concat("p_name", F.lit(', "live"')), "duration_ms": F.col("p_size") * 1000,
        "explicit": F.col("p_size") > 25, "tempo": F.col("p_retailprice"), "track_genre": F.col("p_type"),
    }
    path = scratch_path(spark, "songs")
    sinks.write_csv(part.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SONGS
    ]), path)
    return sources.read_csv(spark, path, SONGS).select(
        "track_id", "artists", "track_name", "duration_ms", "explicit", "tempo", "track_genre"
    )


@query("multi_file_concat", f"""
select {_LANDED}, case when o_orderstatus <> 'P' then o_totalprice end as amount from orders""")
def multi_file_concat(spark, sf):
    """One dataset from three folders; columns differ in order, and one lacks one."""
    root = scratch_path(spark, "many")
    orders = _orders(spark, sf)
    for status, names in {
        "F": orders.columns, "O": orders.columns[::-1], "P": orders.columns[:-1],
    }.items():
        sinks.write_csv(orders.filter(F.col("status") == status).select(*names), f"{root}/{status}")
    return sources.read_many(spark, [f"{root}/{s}" for s in "FOP"], LANDED_ORDERS)


@query("staging_load", f"select {_LANDED}, o_totalprice as amount from orders")
def staging_load(spark, sf):
    """Bulk load by position: the names of the header do not count."""
    path = scratch_path(spark, "stage-in")
    sinks.write_csv(_orders(spark, sf).toDF("id", "customer", "state", "at", "total"), path)
    staged = KeyedTable(spark, scratch_path(spark, "stage"))
    return sources.load_staging(spark, path, LANDED_ORDERS, staged)


@query("latest_snapshot", f"select {_LANDED}, o_totalprice as amount from orders where o_orderstatus = 'O'")
def latest_snapshot(spark, sf):
    """Of two snapshots every part of the newer one."""
    root = scratch_path(spark, "snapshots")
    for run, status in (("run=1", "F"), ("run=2", "O")):
        sinks.write_csv(_orders(spark, sf).filter(F.col("status") == status), f"{root}/{run}")
    return sources.read_latest_snapshot(spark, root, LANDED_ORDERS)


@query("csv_extract_export", f"select {_LANDED}, o_totalprice as amount from orders")
def csv_extract_export(spark, sf):
    """An export; the empty extract that follows leaves it in place."""
    path = scratch_path(spark, "export")
    orders = _orders(spark, sf)
    sinks.write_extract(orders, path)
    sinks.write_extract(orders.filter("status = 'X'"), path)
    return sources.read_csv(spark, path, LANDED_ORDERS)


@query("parquet_overwrite", f"select {_LANDED}, o_totalprice as amount from orders")
def parquet_overwrite(spark, sf):
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(_orders(spark, sf).filter("status = 'F'"), path)
    sinks.write_parquet(_orders(spark, sf), path)
    return spark.read.schema(LANDED_ORDERS).parquet(path)


@query("table_by_date", f"""
select event_id, event_type, {ts('ts')} as at, {day('ts')} as event_date from events
where cast(ts as date) between date '2024-01-10' and date '2024-01-12'""")
def table_by_date(spark, sf):
    """First write of a table by date; three of its dates are read, the others are not opened."""
    from datetime import date

    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").alias("at"))
    held = sinks.create_table(KeyedTable(spark, scratch_path(spark, "by-date")), events, "at", "event_date")
    return held.read([date(2024, 1, d) for d in (10, 11, 12)])


@query("daily_fares_json", f"select date, count_trips, total_fare from ({FARES_SQL})")
def daily_fares_json(spark, sf):
    """Fares per date as JSON objects keyed by the date."""
    ends = b.trip_ends(spark, sf).drop("trip_id")
    fares = trips.daily_fares(b.trip_starts(spark, sf).join(ends, "sequence", "left"))
    path = sinks.write_json(fares, scratch_path(spark, "fares"), "20240101000000", "date")
    kind = "map<string, struct<total_fare: decimal(28,2), count_trips: bigint>>"
    return spark.read.text(path).select(F.explode(F.from_json("value", kind)).alias("date", "v")).select(
        "date", "v.count_trips", "v.total_fare"
    )


# -- checks on landing files ---------------------------------------------------------

def _landing(spark, sf) -> dict[str, str]:
    """CSV copies of three datasets; some files of two of them break the contract."""
    root = scratch_path(spark, "landing")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("created_at"),
        F.lit(1).alias("num_of_item"),
    )
    sinks.write_csv(orders.filter("status = 'F'"), f"{root}/orders/good")
    sinks.write_csv(orders.filter("status = 'O'").drop("user_id", "num_of_item"), f"{root}/orders/short")
    gaps = orders.filter("status = 'P'").withColumn("num_of_item", F.lit(None).cast("int"))
    sinks.write_csv(gaps, f"{root}/orders/gaps")
    items = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("product_id"),
        F.lit("not a time").alias("created_at"),
    )
    sinks.write_csv(items, f"{root}/order_items")
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.lit("sku").alias("sku"), F.lit("free").alias("cost"),
        F.col("p_brand").alias("category"), F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("retail_price"), F.lit("d").alias("department"),
    )
    sinks.write_csv(products, f"{root}/products")
    return {d: f"{root}/{d}" for d in FILE_CONTRACTS}


def _outcomes(report):
    """Outcomes without those of files that hold a header only: a task that has
    no rows may write one."""
    return report.filter(~F.col("problem").eqNullSafe(quality.NO_ROWS)).select("dataset", "valid", "problem").distinct()


@query("file_format_report", """
select * from (values ('order_items', true, null), ('orders', true, null),
  ('orders', false, 'missing columns: user_id, num_of_item'), ('orders', false, 'num_of_item: expected int'),
  ('products', false, 'cost: expected float')) as t(dataset, valid, problem)""")
def file_format_report(spark, sf):
    """Outcomes over all files of three datasets."""
    return _outcomes(quality.check_datasets(spark, _landing(spark, sf), FILE_CONTRACTS))


@query("file_format_report_strict", """
select * from (values ('order_items', false, 'created_at: expected timestamp'), ('orders', true, null),
  ('orders', false, 'missing columns: user_id, num_of_item'), ('orders', false, 'num_of_item: expected int'),
  ('products', false, 'cost: expected float')) as t(dataset, valid, problem)""")
def file_format_report_strict(spark, sf):
    """Unreadable timestamps count as wrong."""
    return _outcomes(quality.check_datasets(spark, _landing(spark, sf), FILE_CONTRACTS, strict=True))


@query("validated_rows", """
select o_orderkey as order_id, o_custkey as user_id, o_orderstatus as status,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' as created_at from orders where o_orderstatus = 'F'""")
def validated_rows(spark, sf):
    """Rows of the files that pass, after their promotion to the ready folder."""
    paths = _landing(spark, sf)
    report = quality.check_format(spark, "orders", paths["orders"], FILE_CONTRACTS["orders"])
    ready = scratch_path(spark, "ready")
    quality.promote_valid_files(spark, report, {"orders": ready})
    return sources.read_csv(spark, ready, COMMERCE_ORDERS).select("order_id", "user_id", "status", "created_at")


@query("valid_rows_in_place", """
select o_orderkey as order_id, o_custkey as user_id, o_orderstatus as status,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' as created_at from orders where o_orderstatus = 'F'""")
def valid_rows_in_place(spark, sf):
    """The same rows without moving or listing a file."""
    path = _landing(spark, sf)["orders"]
    report = quality.check_format(spark, "orders", path, FILE_CONTRACTS["orders"])
    return quality.read_valid_rows(spark, report, "orders", path, COMMERCE_ORDERS).select(
        "order_id", "user_id", "status", "created_at")


@query("file_value_counts", """
select 'orders' as dataset, count(*) as n_rows,
  count(*) filter (o_orderstatus = 'P') + 2 * count(*) filter (o_orderstatus = 'O') as bad_values from orders
union all select 'order_items', count(*), 0 from lineitem union all select 'products', count(*), count(*) from part""")
def file_value_counts(spark, sf):
    """Rows and values of the wrong kind over all files of three datasets."""
    parts = [quality.check_format(spark, d, p, FILE_CONTRACTS[d], counts=True) for d, p in _landing(spark, sf).items()]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("dataset").agg(F.sum("rows").alias("n_rows"), F.sum("bad_values").alias("bad_values"))


@query("readiness_gates", """
select * from (values ('columns: orders', false), ('columns: order_items', true), ('columns: products', true),
  ('inputs present', true), ('inputs present, one missing', false), ('one valid file of each', false))
  as t(gate, passed)""")
def readiness_gates(spark, sf):
    paths = _landing(spark, sf)
    required = {d: list(c) for d, c in FILE_CONTRACTS.items()}
    rows = [
        (f"columns: {d}", ok) for d, ok in quality.required_columns_present(spark, paths, required).items()
    ]
    rows.append(("inputs present", quality.inputs_present(spark, list(paths.values()))))
    rows.append((
        "inputs present, one missing",
        quality.inputs_present(spark, [*paths.values(), scratch_path(spark, "nothing-here")]),
    ))
    report = quality.check_datasets(spark, paths, FILE_CONTRACTS)
    rows.append(("one valid file of each", quality.is_ready(report, list(FILE_CONTRACTS))))
    return spark.createDataFrame(rows, "gate string, passed boolean")

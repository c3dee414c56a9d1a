"""Queries over keyed tables: merges, the star schema, lake tables, extracts, reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.numbers import to_money
from ..operators import ids, merge, tables, watermark
from ..operators.staging import staged
from ..plans import commerce, extracts, lakehouse, listening, reports, star
from ..session import scratch_path
from ..sources.files import read_keyed
from . import bindings as b
from .core import day, money, query, ratio, table, ts
from .kpis import GENRE_SQL, HOURLY_SQL, N_PARTS, SHOP, TOP_SONGS

# -- merges on orders ---------------------------------------------------------------
# The target holds the orders that are filled or part-filled, with amounts that
# are out of date; the source holds those that are filled or open.
AMOUNT = money("o_totalprice")


def _held(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "P")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        (to_money(F.col("o_totalprice")) - 1).cast("decimal(18,2)").alias("amount"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("ordered_at"),
    )


def _incoming(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("order_id"), F.lit("new").alias("status"),
        to_money(F.col("o_totalprice")).alias("amount"),
        F.lit("normal").alias("priority"), F.col("o_orderdate").alias("ordered_at"),
    )


_COLUMNS = "order_id, status, amount, priority, ordered_at"
_SAME = f"cast(amount as double) as amount, priority, {ts('ordered_at')} as ordered_at"
_SIDES = f"""
with held as (select o_orderkey order_id, o_orderstatus status, {AMOUNT} - 1 amount, o_orderpriority priority,
  o_orderdate ordered_at from orders where o_orderstatus in ('F', 'P')),
incoming as (select o_orderkey order_id, 'new' status, {AMOUNT} amount, 'normal' priority,
  o_orderdate ordered_at from orders where o_orderstatus in ('F', 'O'))
"""


@query("merge_update_all", f"""{_SIDES}
select order_id, status, {_SAME} from incoming union all
select order_id, status, {_SAME} from held where order_id not in (select order_id from incoming)""")
def merge_update_all(spark, sf):
    return merge.merge_all(_held(spark, sf), _incoming(spark, sf), ["order_id"])


_SUBSET = f"""{_SIDES}
select coalesce(h.order_id, i.order_id) as order_id,
  case when i.order_id is null then h.status else i.status end as status,
  cast(case when i.order_id is null then h.amount else i.amount end as double) as amount,
  h.priority as priority, %s as ordered_at
from held h full outer join incoming i on h.order_id = i.order_id"""


@query("merge_column_subset", _SUBSET % ts("coalesce(h.ordered_at, i.ordered_at)"))
def merge_column_subset(spark, sf):
    return merge.merge_columns(
        _held(spark, sf), _incoming(spark, sf), ["order_id"],
        update=["status", "amount"], insert=["status", "amount", "ordered_at"],
    )


@query("merge_with_load_time", _SUBSET % ts(
    "case when i.order_id is null then h.ordered_at else timestamp '2024-06-01 12:00:00' end"
))
def merge_with_load_time(spark, sf):
    return merge.merge_columns(
        _held(spark, sf), _incoming(spark, sf), ["order_id"], update=["status", "amount"],
        insert=["status", "amount"], stamp={"ordered_at": F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")},
    )


@query("delete_then_insert", f"""
with lines as (select l_orderkey, l_linenumber, l_returnflag, {money('l_extendedprice')} price from lineitem)
select l_orderkey as order_id, 'new' as flag, cast(price as double) as price from lines where l_returnflag = 'R'
union all
select l_orderkey, l_returnflag, cast(price as double) from lines where l_returnflag <> 'R'
  and l_orderkey not in (select l_orderkey from lines where l_returnflag = 'R')""")
def delete_then_insert(spark, sf):
    """Lines of an order are replaced together; repeated keys are kept."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("flag"),
        to_money(F.col("l_extendedprice")).alias("price"),
    )
    source = lines.filter(F.col("flag") == "R").withColumn("flag", F.lit("new"))
    return merge.replace_by_key(lines.filter(F.col("flag") != "R"), source, ["order_id"])


@query("put_latest_items", f"""
with latest as (select *, row_number() over (partition by user_id order by ts desc) r from events)
select user_id, event_type as last_type, cast(value as double) as last_value, {ts('ts')} as seen_at
from latest where r = 1
union all
select c_custkey, 'none', 0, '2023-01-01 00:00:00.000000' from customer
where c_custkey not in (select user_id from events)""")
def put_latest_items(spark, sf):
    """The newest event of each user replaces the user's item."""
    known = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit("none").alias("last_type"),
        F.lit(0.0).alias("last_value"), F.lit("2023-01-01 00:00:00").cast("timestamp_ntz").alias("seen_at"),
    )
    seen = table(spark, sf, "events").select(
        "user_id", F.col("event_type").alias("last_type"), F.col("value").alias("last_value"),
        F.col("ts").alias("seen_at"),
    )
    return merge.put_items(known, seen, ["user_id"], ["seen_at"])


_PATCHES = f"""
with clicks as (select user_id u, arg_max(value, ts) v from events where event_type = 'click' group by 1),
buys as (select user_id u, arg_max(value, ts) v from events where event_type = 'purchase' group by 1),
seen as (select distinct user_id u from events)
"""


def _patches(spark, sf):
    """Each event sets one attribute of its user, or none."""
    def value_of(kind):
        return F.when(F.col("event_type") == kind, F.col("value"))

    return table(spark, sf, "events").select(
        "user_id", "ts", value_of("click").alias("last_click"), value_of("purchase").alias("last_purchase")
    )


def _profiles(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
        F.lit(-1.0).alias("last_click"), F.lit(-2.0).alias("last_purchase"),
    )


@query("patch_attributes", f"""{_PATCHES},
known as (select c_custkey u, c_mktsegment s from customer where c_mktsegment <> 'BUILDING')
select coalesce(known.u, seen.u) as user_id, s as segment,
  coalesce(clicks.v, case when known.u is not null then -1 end) as last_click,
  coalesce(buys.v, case when known.u is not null then -2 end) as last_purchase
from known full outer join seen on seen.u = known.u
left join clicks on clicks.u = seen.u left join buys on buys.u = seen.u""")
def patch_attributes(spark, sf):
    return merge.patch_items(_profiles(spark, sf), _patches(spark, sf), ["user_id"], ["ts"])


@query("patch_existing_only", f"""{_PATCHES},
known as (select c_custkey u, c_mktsegment s from customer where c_mktsegment <> 'BUILDING')
select known.u as user_id, s as segment, coalesce(clicks.v, -1) as last_click,
  coalesce(buys.v, -2) as last_purchase
from known left join clicks on clicks.u = known.u left join buys on buys.u = known.u""")
def patch_existing_only(spark, sf):
    return merge.patch_items(_profiles(spark, sf), _patches(spark, sf), ["user_id"], ["ts"], insert=False)


@query("unmatched_source_rows", """
select distinct user_id from events
where user_id not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""")
def unmatched_source_rows(spark, sf):
    """Rows a patch without insert skips."""
    return merge.unmatched(_patches(spark, sf), _profiles(spark, sf), ["user_id"]).select("user_id").distinct()


@query("generated_ids", f"""
select row_number() over (order by o_orderdate, o_orderkey) + 99 as row_id, o_orderkey as order_id,
  {ts('o_orderdate')} as ordered_at from orders""")
def generated_ids(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ordered_at")
    )
    return ids.assign_ids(rows, "row_id", ["ordered_at", "order_id"], start=100)


@query("staged_merge", f"""{_SIDES}
select order_id, status, {_SAME} from incoming union all
select order_id, status, {_SAME} from held where order_id not in (select order_id from incoming)""")
def staged_merge(spark, sf):
    """Stage, merge and publish a table; the published version is read back."""
    held = tables.KeyedTable(spark, scratch_path(spark, "staged")).create(_held(spark, sf))
    return tables.run_merge(held, lambda: _incoming(spark, sf), ["order_id"]).read()


@query("keyed_table_scan", "select o_orderkey as order_id, o_custkey as user_id, o_orderstatus as status from orders")
def keyed_table_scan(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
    )
    return read_keyed(tables.KeyedTable(spark, scratch_path(spark, "keyed")).create(rows))


# -- lake tables ---------------------------------------------------------------------

def _lake_orders(spark, sf, kinds, shift):
    """Orders of a lake table, laid out by the first day of their month."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin(*kinds))
    moved = F.when(
        (F.col("o_orderpriority") == "1-URGENT") & F.lit(shift),
        F.col("o_orderdate") + F.expr("INTERVAL 1 YEAR"),
    ).otherwise(F.col("o_orderdate"))
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.date_trunc("month", moved).cast("timestamp_ntz").alias("order_timestamp"),
        (to_money(F.col("o_totalprice")) - (0 if shift else 1)).cast("decimal(18,2)").alias("total_amount"),
    )


@query("lakehouse_orders", f"""
with held as (select o_orderkey k, o_custkey u, date_trunc('month', o_orderdate) t, {AMOUNT} - 1 a
  from orders where o_orderstatus in ('F', 'P')),
incoming as (select o_orderkey k, o_custkey u, date_trunc('month', case when o_orderpriority = '1-URGENT'
  then o_orderdate + interval 1 year else o_orderdate end) t, {AMOUNT} a
  from orders where o_orderstatus in ('F', 'O')),
merged as (select * from incoming union all select * from held where k not in (select k from incoming))
select k as order_id, u as user_id, {ts('t')} as order_timestamp, cast(a as double) as total_amount,
  {day('t')} as order_date from merged""")
def lakehouse_orders(spark, sf):
    """Create a table by date, then upsert; rows of urgent orders change dates."""
    layout = lakehouse.LAKE_TABLES["orders"]
    lake = tables.KeyedTable(spark, scratch_path(spark, "lake-orders"))
    lakehouse.upsert_lake_table(lake, _lake_orders(spark, sf, ("F", "P"), False), layout)
    return lakehouse.upsert_lake_table(lake, _lake_orders(spark, sf, ("F", "O"), True), layout).read()


@query("lakehouse_products", """
select p_partkey as product_id, cast(p_size as bigint) as department_id,
  case when p_size > 10 then upper(p_type) else p_type end as department, p_name as product_name from part""")
def lakehouse_products(spark, sf):
    """A table without dates."""
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("department_id"),
        F.col("p_type").alias("department"), F.col("p_name").alias("product_name"),
    )
    layout = lakehouse.LAKE_TABLES["products"]
    lake = tables.KeyedTable(spark, scratch_path(spark, "lake-products"))
    lakehouse.upsert_lake_table(lake, rows, layout)
    changed = rows.filter(F.col("department_id") > 10).withColumn("department", F.upper("department"))
    return lakehouse.upsert_lake_table(lake, changed, layout).read()


def _lake(spark, name: str, held, incoming):
    """Create a lake table from one frame and merge another into it."""
    layout = lakehouse.LAKE_TABLES[name]
    lake = tables.KeyedTable(spark, scratch_path(spark, f"lake-{name}"))
    lakehouse.upsert_lake_table(lake, held, layout)
    return lakehouse.upsert_lake_table(lake, incoming, layout).read()


def _flights(spark, sf, statuses, changed, *columns):
    """Orders as flights; those that come in again bring new values."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin(*statuses))
    return orders.select(
        F.col("o_orderkey").alias("flight_id"),
        F.concat(F.lit("new " if changed else "old "), F.col("o_orderpriority")).alias("status"),
        (to_money(F.col("o_totalprice")) - (0 if changed else 1)).cast("decimal(18,2)").alias("amount"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("created_at"),
    ).select("flight_id", *columns)


_FLIGHT = """(case when o_orderstatus = 'P' then 'old ' else 'new ' end) || o_orderpriority"""


@query("lakehouse_flights", f"""
select o_orderkey as flight_id, {_FLIGHT} as status, {ts("date_trunc('month', o_orderdate)")} as created_at,
  {day("date_trunc('month', o_orderdate)")} as flight_date from orders where o_orderstatus in ('F', 'P', 'O')""")
def lakehouse_flights(spark, sf):
    """A table by date whose rows keep their dates."""
    return _lake(spark, "flights", _flights(spark, sf, ("F", "P"), False, "status", "created_at"),
                 _flights(spark, sf, ("F", "O"), True, "status", "created_at"))


@query("lakehouse_flight_logistics", f"""
select o_orderkey as flight_id, {_FLIGHT} as status from orders where o_orderstatus in ('F', 'P', 'O')""")
def lakehouse_flight_logistics(spark, sf):
    return _lake(spark, "flight_logistics", _flights(spark, sf, ("F", "P"), False, "status"),
                 _flights(spark, sf, ("F", "O"), True, "status"))


@query("lakehouse_passenger_experience", f"""
select o_orderkey as flight_id, cast({AMOUNT} - case when o_orderstatus = 'P' then 1 else 0 end as double) as amount
from orders where o_orderstatus in ('F', 'P', 'O')""")
def lakehouse_passenger_experience(spark, sf):
    return _lake(spark, "passenger_experience", _flights(spark, sf, ("F", "P"), False, "amount"),
                 _flights(spark, sf, ("F", "O"), True, "amount"))


@query("lakehouse_order_items", f"""
with items as (select l_orderkey o, l_linenumber n, sum({money('l_extendedprice')}) a, max(l_returnflag) f,
  date_trunc('month', min(l_shipdate)) t from lineitem group by 1, 2)
select o as order_id, cast(n as bigint) as id, cast(a + case when f <> 'R' then 1 else 0 end as double) as amount,
  {ts('t')} as order_timestamp, {day('t')} as order_date from items""")
def lakehouse_order_items(spark, sf):
    """Two key columns, by date: all items, then new amounts for those not returned."""
    items = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("id")
    ).agg(
        F.sum(to_money(F.col("l_extendedprice"))).alias("amount"), F.max("l_returnflag").alias("flag"),
        F.date_trunc("month", F.min("l_shipdate")).cast("timestamp_ntz").alias("order_timestamp"),
    )
    items = staged(items, "order-items")
    kept = ["order_id", "id", F.col("amount").cast("decimal(18,2)").alias("amount"), "order_timestamp"]
    raised = items.filter("flag <> 'R'").withColumn("amount", F.col("amount") + 1)
    return _lake(spark, "order_items", items.select(*kept), raised.select(*kept))


# -- extracts and marks -----------------------------------------------------------------
_ORDER = f"o_orderkey, {ts('o_orderdate')} as o_orderdate, o_totalprice"
_FIELDS = ["o_orderkey", "o_orderdate", "o_totalprice"]


@query("full_extract", f"select {_ORDER} from orders")
def full_extract(spark, sf):
    return watermark.extract_full(table(spark, sf, "orders")).select(*_FIELDS)


@query("incremental_extract", f"select {_ORDER} from orders where o_orderdate > timestamp '1998-06-30 00:00:00'")
def incremental_extract(spark, sf):
    return watermark.extract_incremental(
        table(spark, sf, "orders"), "o_orderdate", "1998-06-30 00:00:00"
    ).select(*_FIELDS)


@query("date_slice_extract", f"select event_id, {ts('ts')} as ts from events where cast(ts as date) = date '2024-01-15'")
def date_slice_extract(spark, sf):
    return watermark.extract_date_slice(table(spark, sf, "events"), "ts", date(2024, 1, 15)).select("event_id", "ts")


@query("high_water_mark_load", f"""
select o_orderkey as order_id, {ts('o_orderdate')} as ordered_at,
  case when o_orderdate <= timestamp '1998-06-30 00:00:00' then 'run 1' else 'run 2' end as loaded_by,
  (select strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') from orders) as mark
from orders""")
def high_water_mark_load(spark, sf):
    """Two runs against a source that has grown in between."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ordered_at")
    )
    store = watermark.seed_marks(
        tables.KeyedTable(spark, scratch_path(spark, "marks")), [("orders", "ordered_at", None)]
    )
    loaded = tables.KeyedTable(spark, scratch_path(spark, "loaded"))

    def land(run):
        def apply(extract):
            tables.create_or_upsert(loaded, extract.withColumn("loaded_by", F.lit(run)), ["order_id"])
        return apply

    extracts.incremental_load(
        orders.filter(F.col("ordered_at") <= F.lit("1998-06-30").cast("timestamp_ntz")), "orders", store, land("run 1")
    )
    mark = extracts.incremental_load(orders, "orders", store, land("run 2"))
    return loaded.read().withColumn("mark", F.lit(mark))


@query("target_watermark", f"""
select {ts("max(ts)")} as watermark from events where event_type = 'purchase'
union all select '1970-01-01 00:00:00.000000'""")
def target_watermark(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_type")
    bought = events.filter(F.col("event_type") == "purchase")
    nothing = events.filter(F.col("event_type") == "no such type")
    return watermark.target_watermark(bought, "ts").unionByName(watermark.target_watermark(nothing, "ts"))


# -- star schema -----------------------------------------------------------------------

_DIM = """p_partkey as apartment_id, p_name as title, p_type as category, 'About ' || p_name as body,
  'Parking,Gym' as amenities, cast(p_size % 6 as double) as bedrooms, cast(p_size % 4 as double) as bathrooms,
  cast(p_size * 100 as bigint) as square_feet, p_size || ' Main St' as address, p_brand as cityname, 'NY' as state,
  p_size / 2 as latitude, -p_size / 4 as longitude,
  case when p_size > 25 then 'Yes' else 'Thumbnail' end as has_photo, 'Cats' as pets_allowed,
  '$' || p_size as price_display, 'Monthly' as price_type"""


@query("dim_apartments", f"select {_DIM} from part")
def dim_apartments(spark, sf):
    """A dimension with stale rows for large apartments gains the others."""
    homes, described = b.apartments(spark, sf), b.apartment_attributes(spark, sf)
    stale = star.stage_dim_apartments(homes, described.filter(F.col("square_feet") > 2000))
    stale = stale.withColumn("title", F.lit("old")).withColumn("latitude", F.lit(None).cast("decimal(10,7)"))
    return star.merge_dim_apartments(stale, homes, described)


@query("dim_users", "select distinct user_id from events")
def dim_users(spark, sf):
    seen = b.viewings(spark, sf)
    known = seen.filter(F.col("is_wishlisted") == "Y").select("user_id").distinct()
    return star.merge_dim_users(known, seen)


_FACT = f"""
with priced as (select e.user_id, p_partkey apartment_id, ts viewed_at, event_type = 'purchase' is_wishlisted,
  event_type call_to_action, cast(p_retailprice as decimal(10,2)) price, p_size * 10 fee, 'USD' currency
  from events e join part on p_partkey = event_id % {N_PARTS})
"""


@query("fact_apartment_viewings", f"""{_FACT}
select cast(row_number() over (order by viewed_at, apartment_id, user_id) as bigint) as viewing_id,
  apartment_id, user_id, {ts('viewed_at')} as viewed_at,
  is_wishlisted, case when viewed_at < timestamp '2024-01-16' and viewed_at <
    (select max(viewed_at) from priced where viewed_at < timestamp '2024-01-16') then 'old' else call_to_action end
  as call_to_action,
  cast(price as double) as price, cast(fee as double) as fee, currency from priced""")
def fact_apartment_viewings(spark, sf):
    """A first load up to a day, then the incremental merge.

    Facts before the mark stay as first loaded; the one at the mark is updated
    and keeps its id; later ones are numbered on.
    """
    homes, described = b.apartments(spark, sf), b.apartment_attributes(spark, sf)
    seen = b.viewings(spark, sf)
    early = seen.filter(F.col("viewed_at") < F.lit("2024-01-16").cast("timestamp")).withColumn(
        "call_to_action", F.lit("old")
    )
    schema = ("viewing_id bigint, apartment_id bigint, user_id int, viewed_at timestamp, is_wishlisted boolean, "
              "call_to_action string, price decimal(10,2), fee decimal(10,2), currency string")
    nothing = spark.createDataFrame([], schema)
    first = star.merge_fact_viewings(nothing, star.stage_fact_viewings(early, homes, described, nothing))
    facts = tables.KeyedTable(spark, scratch_path(spark, "facts")).create(first)
    held = facts.read()
    merged = star.merge_fact_viewings(held, star.stage_fact_viewings(seen, homes, described, held))
    return facts.replace(merged).read()


@query("raw_apartments", f"""
select p_partkey as id, p_name as title, p_brand as source, cast(cast(p_retailprice as decimal(10,2)) as double) as price,
  'USD' as currency, '2024-01-01 00:00:00.000000' as listing_created_on, p_size > 10 as is_active,
  case when p_type = 'ECONOMY' then '2024-01-02 00:00:00.000000' else '2024-06-01 12:00:00.000000' end
  as last_modified_timestamp from part""")
def raw_apartments(spark, sf):
    rows = b.apartments(spark, sf)
    economy = F.col("id").isNotNull() & F.col("__type").eqNullSafe("ECONOMY")
    typed = rows.join(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("__type")), "id")
    target = typed.filter(economy | (F.col("__type") == "STANDARD")).withColumn(
        "title", F.when(economy, F.col("title")).otherwise(F.lit("old"))
    ).drop("__type")
    staged = typed.filter(~economy).drop("__type")
    return star.merge_raw_apartments(target, staged, F.lit("2024-06-01 12:00:00").cast("timestamp"))


@query("raw_attributes", """
select p_partkey as id, p_type as category, 'About ' || p_name as body,
  cast(p_size * 10 as double) as fee, cast(p_size * 100 as bigint) as square_feet, p_size / 2 as latitude from part""")
def raw_attributes(spark, sf):
    rows = b.apartment_attributes(spark, sf)
    target = rows.filter(F.col("square_feet") > 2000).withColumn("body", F.lit("old"))
    merged = star.merge_raw_attributes(target, rows)
    return merged.select("id", "category", "body", "fee", "square_feet", "latitude")


@query("raw_viewings", f"""
select user_id, event_id % {N_PARTS} as apartment_id, {ts('ts')} as viewed_at,
  case when event_type = 'purchase' then 'Y' else 'N' end as is_wishlisted, event_type as call_to_action
from events""")
def raw_viewings(spark, sf):
    rows = b.viewings(spark, sf)
    target = rows.filter(F.col("call_to_action") == "click").withColumn("is_wishlisted", F.lit("Y"))
    return star.merge_raw_viewings(target, rows)


# -- report tables -----------------------------------------------------------------------

@query("genre_report_upsert", f"""
with kpis as ({GENRE_SQL})
select * from kpis union all select '1990-01-01', 'ECONOMY', 1, 1.0, 1.0, 0""")
def genre_report_upsert(spark, sf):
    """The KPIs replace earlier rows of the report; a row of another day stays."""
    kpis = listening.genre_daily_kpis(b.line_streams(spark, sf), b.songs(spark, sf))
    older = spark.sql("select date'1990-01-01', 'ECONOMY', 1L, 1.0D, 1.0D, 0L").toDF(*kpis.columns)
    stale = kpis.filter(F.col("track_genre") == "PROMO").withColumn("listen_count", F.lit(-1).cast("bigint"))
    report = tables.KeyedTable(spark, scratch_path(spark, "genre-report"))
    reports.publish_report(report, stale.unionByName(older), "genre_level_kpis")
    return reports.publish_report(report, kpis, "genre_level_kpis").read()


@query("hourly_report_upsert", f"""
with kpis as ({HOURLY_SQL}) select * from kpis""")
def hourly_report_upsert(spark, sf):
    kpis = listening.hourly_kpis(b.event_streams(spark, sf), b.songs(spark, sf), b.listeners(spark, sf))
    stale = kpis.filter(F.col("listen_hour") < 12).withColumn("top_artist", F.lit("old"))
    return reports.replace_report(stale, kpis, "hourly_kpis")


@query("track_report_patch", f"""{TOP_SONGS},
rows as (select distinct t, d, n, total, c from best where gr <= 5)
select t as track_id, {day('d')} as report_date, n as total_listens, cast(total as bigint) as total_listening_time,
  {ratio('total', 'c')} as avg_listening_time_per_user,
  case when n > 1 then 'kept' end as note from rows""")
def track_report_patch(spark, sf):
    """Reports of tracks heard more than once exist and carry a note, which stays."""
    best = staged(listening.top_songs(b.line_streams(spark, sf), b.songs(spark, sf)), "best")
    rows = reports.track_report_rows(best)
    target = rows.filter(F.col("total_listens") > 1).withColumn("total_listens", F.lit(-1).cast("bigint")).withColumn(
        "unique_users", F.lit(None).cast("bigint")
    ).withColumn("note", F.lit("kept"))
    return reports.patch_track_reports(target, best).drop("unique_users")


@query("category_report_put", f"""{SHOP},
kpis as (select d, category, sum(price * items) r, sum(price) p, count(price) c,
  count(distinct case when returned then o end) back, count(distinct o) n from df group by d, category)
select category, {day('d')} as order_date, cast(r as double) as daily_revenue,
  cast(cast({ratio('p', 'c')} as decimal(18,6)) as double) as avg_order_value,
  cast(cast({ratio('back', 'n')} as decimal(18,6)) as double) as avg_return_rate from kpis""")
def category_report_put(spark, sf):
    kpis = commerce.category_wise_summary(
        b.shop_orders(spark, sf), b.shop_items(spark, sf), b.shop_products(spark, sf)
    )
    rows = reports.category_report_rows(kpis)
    stale = rows.filter(F.col("category") == "Brand#1").withColumn("daily_revenue", F.lit(None).cast("decimal(18,2)"))
    return reports.put_report(stale, rows, "category_wise_summary")


@query("order_report_put", f"""{SHOP},
kpis as (select d, sum(price * items) r, sum(items) i, count(distinct u) users,
  count(distinct case when returned then o end) back, count(distinct o) n from df group by d)
select {day('d')} as order_date, n as total_orders, cast(r as double) as total_revenue,
  cast(i as bigint) as total_items_sold,
  cast(cast({ratio('back', 'n')} as decimal(18,6)) as double) as return_rate, users as unique_customers from kpis""")
def order_report_put(spark, sf):
    kpis = commerce.daily_order_summary(
        b.shop_orders(spark, sf), b.shop_items(spark, sf), b.shop_products(spark, sf)
    )
    rows = reports.order_report_rows(kpis)
    stale = rows.filter(F.col("order_date") < "1997").withColumn("total_orders", F.lit(-1).cast("bigint"))
    return reports.put_report(stale, rows, "daily_order_summary")

"""Single operators: projections, joins, aggregates, ranks and functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import aggregates, encoding, labels, numbers, times
from ..operators import joins
from ..sinks.split import split_ok_failed
from .core import day, money, query, ratio, table, ts

# -- projections and filters -----------------------------------------------------


@query("renamed_projection", f"select o_custkey as user_id, o_orderkey as order_id, {ts('o_orderdate')} as created_at from orders")
def renamed_projection(spark, sf):
    renamed = table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "user_id", "o_orderdate": "created_at"}
    )
    return renamed.select("user_id", "order_id", "created_at")


@query("derived_columns", f"""
select l_orderkey, l_linenumber::bigint as l_linenumber, {day('l_shipdate')} as report_date,
  cast({money('l_extendedprice')} * cast(l_quantity as integer) as double) as worth from lineitem""")
def derived_columns(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("report_date"),
        (numbers.to_money(F.col("l_extendedprice")) * F.col("l_quantity").cast("int")).alias("worth"),
    )


@query("non_null_keys", """
select event_id, case when event_type <> 'error' then user_id end as user_id from events where event_type <> 'error'""")
def non_null_keys(spark, sf):
    keyed = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    )
    return keyed.filter(F.col("user_id").isNotNull())


@query("threshold_filter", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and trunc(o_totalprice) > 250000")
def threshold_filter(spark, sf):
    spent = numbers.whole_part_above(F.col("o_totalprice"), 250000)
    return table(spark, sf, "orders").filter((F.col("o_orderstatus") == "F") & spent).select("o_orderkey", "o_totalprice")


@query("field_defaults", """
select event_id, case when event_type = 'click' then '' else event_type end as kind,
  case when event_type = 'click' then 0 else value end as fare from events""")
def field_defaults(spark, sf):
    click = F.col("event_type") == "click"
    sparse = table(spark, sf, "events").select(
        "event_id", F.when(~click, F.col("event_type")).alias("kind"), F.when(~click, F.col("value")).alias("fare")
    )
    return sparse.select(
        "event_id", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("fare", F.lit(0.0)).alias("fare")
    )


@query("distinct_projection", "select distinct l_suppkey, l_returnflag from lineitem")
def distinct_projection(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("split_ok_failed", """
select event_id, case when value > 100 then 'ok' else 'failed' end as side from events""")
def split_sides(spark, sf):
    ok, failed = split_ok_failed(table(spark, sf, "events").select("event_id", "value"), F.col("value") > 100)
    return ok.select("event_id", F.lit("ok").alias("side")).unionByName(
        failed.select("event_id", F.lit("failed").alias("side"))
    )


@query("union_all_parts", "select event_id, event_type from events")
def union_all_parts(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    errors, others = events.filter("event_type = 'error'"), events.filter("event_type <> 'error'")
    return errors.unionByName(others.select("event_type", "event_id"))


# -- joins ---------------------------------------------------------------------

@query("same_key_join", """
select event_id, user_id, c_mktsegment as segment from events join customer on c_custkey = user_id""")
def same_key_join(spark, sf):
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return table(spark, sf, "events").join(users, "user_id").select("event_id", "user_id", "segment")


@query("star_join", """
select s_suppkey as location_id, p_type as vehicle_type, count(*) as n from lineitem
join supplier on s_suppkey = l_suppkey join part on p_partkey = l_partkey group by 1, 2""")
def star_join(spark, sf):
    """Fact rows are counted per pair of keys before they meet the dimensions."""
    pairs = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    places, kinds = table(spark, sf, "supplier"), table(spark, sf, "part")
    return (
        pairs.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(kinds, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("s_suppkey").alias("location_id"), F.col("p_type").alias("vehicle_type"))
        .agg(F.sum("n").alias("n"))
    )


@query("left_outer_enrich", """
select o_orderkey as order_id, c_name as user_name from orders
left join customer on c_custkey = o_custkey and c_mktsegment = 'BUILDING'""")
def left_outer_enrich(spark, sf):
    users = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("user_name")
    )
    return table(spark, sf, "orders").join(users, "o_custkey", "left").select(
        F.col("o_orderkey").alias("order_id"), "user_name"
    )


@query("suffixed_join", """
select o_orderkey as order_id, o_orderstatus as status_order, l_linestatus as status_item,
  l_linenumber::bigint as number_item from orders join lineitem on l_orderkey = o_orderkey""")
def suffixed_join(spark, sf):
    """Columns of the same name on both sides get the suffix of their side."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linestatus").alias("status"), F.col("l_linenumber").alias("number")
    )
    return joins.suffixed(orders, "_order", ["order_id"]).join(joins.suffixed(items, "_item", ["order_id"]), "order_id")


@query("semi_and_anti_join", """
select c_custkey as user_id, c_custkey in (select user_id from events) as seen from customer""")
def semi_and_anti_join(spark, sf):
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    events = table(spark, sf, "events").select("user_id")
    return users.join(events, "user_id", "left_semi").withColumn("seen", F.lit(True)).unionByName(
        users.join(events, "user_id", "left_anti").withColumn("seen", F.lit(False))
    )


@query("salted_join", """
select l_orderkey, l_partkey, l_linenumber::bigint as l_linenumber, p_type from lineitem
join part on p_partkey = l_partkey""")
def salted_join(spark, sf):
    """The join a stream uses when its static side is too large to broadcast."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    kinds = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return joins.salted_join(lines, kinds, ["l_partkey"]).drop("l_shipdate")


HOT_SHARE = 1 / 64


@query("hot_join_keys", f"""
select lang, source, count(*) as n from documents group by 1, 2
having count(*) > (select count(*) from documents) * {HOT_SHARE}""")
def hot_join_keys(spark, sf):
    """Keys that hold more than a share of the rows, found by a sketch."""
    return joins.hot_key_counts(table(spark, sf, "documents"), ["lang", "source"], HOT_SHARE)


@query("hot_key_join", """
with groups as (select lang, source, count(*) as documents from documents group by 1, 2)
select d.doc_id, d.lang, d.source, g.documents from documents d
join groups g on g.lang = d.lang and g.source = d.source""")
def hot_key_join(spark, sf):
    """Only the keys that the sketch names are spread, and only their rows of the other side are copied."""
    key = ["lang", "source"]
    docs = table(spark, sf, "documents").select("doc_id", *key)
    groups = docs.groupBy(*key).agg(F.count("*").alias("documents"))
    return joins.salted_join(docs, groups, key, hot=joins.hot_keys(docs, key, HOT_SHARE))


@query("recombined_aggregates", f"""
select c_mktsegment as segment, count(*) as customers, {ratio("sum(cast(c_acctbal as decimal(18,2)))", "count(*)")} as mean_balance,
  cast(max({money('c_acctbal')}) as double) as top_balance from customer group by 1""")
def recombined_aggregates(spark, sf):
    """Several metrics of one group in one pass, where they need no join."""
    balance = numbers.to_money(F.col("c_acctbal"))
    return table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("customers"), aggregates.mean(balance).alias("mean_balance"),
        F.max(balance).alias("top_balance"),
    )


# -- aggregates ------------------------------------------------------------------

@query("aggregate_basics", f"""
select {day('ts')} as date, hour(ts) as hour, count(*) as n, count(case when event_type = 'click' then 1 end) as clicks,
  cast(sum({money('value')}) as double) as total, {ratio(f"sum({money('value')})", 'count(value)')} as mean,
  cast(min(value) as double) as low, cast(max(value) as double) as high,
  cast(sum({money('value')} * user_id) as double) as weighted from events group by 1, 2""")
def aggregate_basics(spark, sf):
    value = numbers.to_money(F.col("value"))
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"),
        F.sum(value).alias("total"), aggregates.mean(value).alias("mean"),
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.sum(value * F.col("user_id").cast("int")).alias("weighted"),
    )


@query("daily_window_counts", f"""
select {ts("date_trunc('day', ts)")} as window_start, count(*) as n from events group by 1""")
def daily_window_counts(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "n"
    )


@query("distinct_counts", """
select event_type, count(distinct user_id) as users, true as approx_close from events group by 1""")
def distinct_counts(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.approx_count_distinct("user_id").alias("approx")
    )
    close = F.abs(F.col("approx") - F.col("users")) <= F.greatest(F.lit(1), F.col("users") * 0.15)
    return counts.select("event_type", "users", close.alias("approx_close"))


@query("distinct_ratios", f"""
select o_orderpriority as priority,
  {ratio("count(distinct case when o_orderstatus = 'F' then o_custkey end)", 'count(distinct o_custkey)')} as returned_share,
  {ratio('count(distinct o_custkey)', 'count(o_custkey)')} as diversity from orders group by 1""")
def distinct_ratios(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        aggregates.distinct_share(F.col("o_custkey"), F.col("o_orderstatus") == "F").alias("returned_share"),
        aggregates.diversity(F.col("o_custkey")).alias("diversity"),
    )


@query("share_of_total", f"""
select {day('d')} as date, event_type, {ratio('n', 'sum(n) over (partition by d)')} as share
from (select cast(ts as date) d, event_type, count(*) n from events group by 1, 2)""")
def share_of_total(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("date"))
    return counts.select("date", "event_type", aggregates.quotient(F.col("n"), total).alias("share"))


@query("two_level_average", f"""
select event_type, {ratio('sum(active)', 'count(*)')} as mean_days
from (select event_type, user_id, count(distinct cast(ts as date)) active from events group by 1, 2) group by 1""")
def two_level_average(spark, sf):
    per_user = table(spark, sf, "events").groupBy("event_type", "user_id").agg(
        F.count_distinct(F.to_date("ts")).alias("days")
    )
    return per_user.groupBy("event_type").agg(aggregates.mean(F.col("days")).alias("mean_days"))


@query("most_frequent_label", """
select l_suppkey, l_partkey as top_part, n from (
  select *, row_number() over (partition by l_suppkey order by n desc, l_partkey) r
  from (select l_suppkey, l_partkey, count(*) n from lineitem group by 1, 2)) where r = 1""")
def most_frequent_label(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    return counts.groupBy("l_suppkey").agg(
        aggregates.most_frequent(F.col("l_partkey"), F.col("n")).alias("top_part"), F.max("n").alias("n")
    )


# -- ranks -------------------------------------------------------------------------

@query("rank_within_group", """
select * from (select c_nationkey::bigint as c_nationkey, c_custkey, rank() over (partition by c_nationkey order by c_acctbal desc) as place
  from customer) where place <= 3""")
def rank_within_group(spark, sf):
    """Ties keep their rank; each task drops what cannot be among the first three."""
    best = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))
    return table(spark, sf, "customer").withColumn("place", F.rank().over(best)).filter("place <= 3").select(
        "c_nationkey", "c_custkey", "place"
    )


@query("first_per_key", f"""
select user_id, event_id, {ts('ts')} as ts from (
  select *, row_number() over (partition by user_id order by value desc, event_id) r from events) where r = 1""")
def first_per_key(spark, sf):
    order = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return table(spark, sf, "events").withColumn("r", F.row_number().over(order)).filter("r = 1").select(
        "user_id", "event_id", "ts"
    )


# -- scalar functions ------------------------------------------------------------------

@query("time_functions", f"""
select event_id, {day('ts')} as date, strftime(ts, '%Y-%m-%d') as date_text, hour(ts) as hour,
  strftime(ts, '%H') as hour_label,
  {ts("date_trunc('second', ts)")} as parsed, null::varchar as unparsed,
  {ts("timestamp '2023-01-01 00:00:00' + (date_trunc('second', ts) - date_trunc('day', ts))")} as clock,
  (epoch(date_trunc('second', ts)) - epoch(timestamp '2024-01-01 00:00:00')) / 3600 as hours,
  event_id / 1000 as seconds from events""")
def time_functions(spark, sf):
    text = F.date_format("ts", times.SECOND_PATTERN)
    parsed = times.parse_timestamp(times.strip_utc(F.concat(text, F.lit(" UTC"))))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), times.date_text(text).alias("date_text"),
        F.hour("ts").alias("hour"), times.hour_label(F.col("ts")).alias("hour_label"),
        parsed.alias("parsed"), times.parse_timestamp(F.concat(F.lit("x"), text)).alias("unparsed"),
        times.clock_time_on("2023-01-01", F.date_format("ts", "HH:mm:ss")).alias("clock"),
        times.hours_between(start, F.col("ts").cast("timestamp")).alias("hours"),
        times.ms_to_seconds(F.col("event_id")).alias("seconds"),
    )


@query("label_functions", """
select event_id, case when user_id > 0 and user_id <= 25 then '18-25' when user_id > 25 and user_id <= 35 then '26-35'
  when user_id > 35 and user_id <= 45 then '36-45' when user_id > 45 and user_id <= 55 then '46-55'
  when user_id > 55 and user_id <= 65 then '56-65' when user_id > 65 and user_id <= 100 then '66+' end as band,
  case when event_type = 'view' then 'Yes' else 'No' end as mobile,
  case event_type when 'click' then 'Social Media' when 'signup' then 'Email' when 'purchase' then 'Search Engine'
  else 'Direct' end as category, event_type = 'error' as flagged from events""")
def label_functions(spark, sf):
    kind = F.col("event_type")
    browser = F.when(kind == "view", "on an iPad").otherwise("on an ipad")
    source = (
        F.when(kind == "click", "YouTube Email").when(kind == "signup", "Email")
        .when(kind == "purchase", "Facebook Bing").otherwise("google")
    )
    return table(spark, sf, "events").select(
        "event_id", labels.age_band(F.col("user_id")).alias("band"),
        labels.yes_no(labels.is_mobile_browser(browser)).alias("mobile"),
        labels.traffic_source_category(source).alias("category"),
        labels.flag_to_boolean(F.when(kind == "error", "Y").otherwise("N")).alias("flagged"),
    )


@query("number_functions", f"""
select event_id, cast(cast(value as decimal(18,2)) as double) as amount,
  cast(cast(event_id / 7.0 as decimal(18,6)) as double) as part, null::double as no_number,
  round(cast(value as decimal(18,2)), 1)::double as rounded, trunc(value) > 100 as large from events""")
def number_functions(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", numbers.to_money(value.cast("string")).alias("amount"),
        numbers.to_ratio(F.col("event_id") / 7.0).alias("part"),
        numbers.lenient_double(F.col("event_type")).alias("no_number"),
        F.round(numbers.to_money(value), 1).alias("rounded"),
        numbers.whole_part_above(value, 100).alias("large"),
    )


@query("encoding_functions", """
select event_id, event_type as decoded, null::varchar as broken, user_id || '-' || event_type as key,
  '"' || event_id || '","a ""b"", c ",""' || chr(10) as line,
  to_base64(encode(event_type)) as encoded, '{"user_id":' || user_id || '}' as json from events""")
def encoding_functions(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id", encoding.decode_text(encoding.encode_text(kind)).alias("decoded"),
        encoding.decode_text(F.concat(F.lit("!"), kind)).alias("broken"),
        encoding.compound_key(F.col("user_id").cast("string"), kind).alias("key"),
        encoding.csv_line(
            F.col("event_id").cast("string").alias("a"), F.lit('a "b", c ').alias("b"), F.lit("").alias("c")
        ).alias("line"),
        encoding.encode_text(kind).alias("encoded"),
        F.to_json(F.struct("user_id")).alias("json"),
    )

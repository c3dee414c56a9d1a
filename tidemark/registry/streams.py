"""Streaming queries: each runs over all events until it has caught up and
reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import decode_text
from ..operators.staging import staged
from ..operators.tables import KeyedTable
from ..plans import clickstream, discounts
from ..schemas import MOBILE_LOG, STREAMS, columns
from ..session import scratch_path
from ..sinks.compaction import CompactedFeed
from ..sinks.streams import UNTIL_CAUGHT_UP, await_all, emit_events, ingest_new_files, start_parquet_sink
from ..sources.envelope import decode_envelope, parse_envelope
from ..sources.streams import read_event_stream
from ..streaming import lifecycle, mobile, music, serve, state, trips
from . import bindings as b
from .core import day, money, query, ratio, table, ts
from .kpis import CLICKS, LINE, N_PARTS, SPENDING_LIMIT


def as_json_stream(df: DataFrame, schema, label: str) -> DataFrame:
    """The rows as a stream of JSON lines."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-in")
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return read_event_stream(spark, "text", {"path": path}, schema)


def as_record_stream(df: DataFrame, label: str) -> DataFrame:
    """The rows as a stream of records."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-in")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def caught_up(df: DataFrame, label: str, partition_by: list[str] = ()) -> DataFrame:
    """Run the stream to its end into files and read them."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    run = start_parquet_sink(df, f"{path}/out", f"{path}/checkpoint", partition_by, UNTIL_CAUGHT_UP)
    await_all(spark, [run])
    return spark.read.schema(df.schema).parquet(f"{path}/out").select(*df.columns)


# -- sources --------------------------------------------------------------------

def _plays(spark: SparkSession, sf: str) -> DataFrame:
    return b.event_streams(spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("track_id").cast("string").alias("track_id"),
        F.date_format("listen_time", "yyyy-MM-dd HH:mm:ss").alias("listen_time"),
    )


@query("event_stream_source", f"""
select cast(user_id as varchar) as user_id, cast(event_id % {N_PARTS} as varchar) as track_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as listen_time from events""")
def event_stream_source(spark, sf):
    return caught_up(as_json_stream(_plays(spark, sf), STREAMS, "plays"), "event-stream")


# -- windows over plays -----------------------------------------------------------

_MUSIC = f"""
with plays as (select date_trunc('second', ts) t, user_id, event_id % {N_PARTS} k from events),
mark as (select max(t) - interval 10 minute m from plays),
w as (select time_bucket(interval 30 minute, t) s, plays.*, p_brand, p_type, p_size * 1000 ms
  from plays join part on p_partkey = k)
select {ts('s')} as window_start, {ts('s + interval 30 minute')} as window_end, cast(k as varchar) as track_id,
  p_brand as artists, p_type as album_name, count(user_id) as total_listens,
  {ratio('sum(ms)', 'count(ms)')} as average_listen_duration, true as users_ok
from w where s + interval 30 minute <= (select m from mark) group by s, k, p_brand, p_type"""


@query("music_metrics", _MUSIC)
def music_metrics(spark, sf):
    """The approximate user count is held against the exact one of the window."""
    landed = _plays(spark, sf)
    plays = music.with_listen_time(as_json_stream(landed, STREAMS, "plays"))
    catalogue = b.songs(spark, sf).withColumn("track_id", F.col("track_id").cast("string"))
    windows = caught_up(music.music_metrics(plays, catalogue, landed), "music")
    exact = (
        music.with_listen_time(_plays(spark, sf)).groupBy(F.window("timestamp", music.WINDOW), "track_id")
        .agg(F.count_distinct("user_id").alias("exact_users"))
        .select(F.col("window.start").alias("window_start"), "track_id", "exact_users")
    )
    close = F.abs(F.col("unique_users") - F.col("exact_users")) <= F.greatest(F.lit(1), F.col("exact_users") * 0.15)
    return windows.join(exact, ["window_start", "track_id"]).withColumn("users_ok", close).drop("unique_users", "exact_users")


# -- mobile metrics ----------------------------------------------------------------

_PROVIDER = "case user_id % 3 when 0 then 'gps' when 1 then 'network' else 'fused' end"
_LOGS = f"""
with logs as (select timestamp '2023-01-01 00:00:00' + (date_trunc('second', ts) - date_trunc('day', ts)) t,
  value, event_type, cast(user_id % 10 as varchar) postal, {_PROVIDER} provider,
  cast(json_extract_string(props, '$.k') as double) sats from events),
mark as (select max(t) - interval 10 minute m from logs),
w as (select time_bucket(interval 2 minute, t) s, logs.* from logs),
done as (select * from w where s + interval 2 minute <= (select m from mark))
"""
_WINDOW = f"{ts('s')} as window_start, {ts('s + interval 2 minute')} as window_end"
_HOUR = "strftime(s, '%H') as partition_hour"
_SIGNAL = "select s, postal, event_type, avg(value) v from done group by s, postal, event_type"
_GPS = "select s, provider, avg(value) p, avg(sats) k from done group by s, provider"
_STATUS = "select s, postal, event_type, count(*) n from done group by s, postal, event_type"


def _logs(spark, sf):
    wide = b.mobile_logs(spark, sf)
    return mobile.with_log_time(as_json_stream(wide, MOBILE_LOG, "logs"))


def _metric(spark, sf, name):
    return caught_up(mobile.metric_files(_logs(spark, sf), name), name, mobile.PARTITIONS[name])


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query("signal_strength_by_operator", f"""{_LOGS} select {_WINDOW}, postal as postal_code, event_type as operator,
  {_HOUR}, round(v, 9) as average_signal from ({_SIGNAL})""")
def signal_strength_by_operator(spark, sf):
    return _rounded(_metric(spark, sf, "signal_strength_by_operator"), "average_signal")


@query("gps_precision_by_provider", f"""{_LOGS} select {_WINDOW}, provider, {_HOUR},
  round(p, 9) as average_precision, round(k, 9) as average_satellites from ({_GPS})""")
def gps_precision_by_provider(spark, sf):
    return _rounded(_metric(spark, sf, "gps_precision_by_provider"), "average_precision", "average_satellites")


@query("status_count", f"""{_LOGS} select {_WINDOW}, postal as postal_code, event_type as status,
  {_HOUR}, n as status_count from ({_STATUS})""")
def status_count(spark, sf):
    return _metric(spark, sf, "status_count")


@query("mobile_metrics_together", f"""{_LOGS}
select 'signal_strength_by_operator' as metric, count(*) as windows from ({_SIGNAL}) union all
select 'gps_precision_by_provider', count(*) from ({_GPS}) union all
select 'status_count', count(*) from ({_STATUS})""")
def mobile_metrics_together(spark, sf):
    """Three queries over one source at the same time."""
    path = scratch_path(spark, "mobile")
    await_all(spark, mobile.start_metrics(
        _logs(spark, sf), f"{path}/out", f"{path}/checkpoint", UNTIL_CAUGHT_UP
    ))
    counts = [
        mobile.read_metric(spark, f"{path}/out", name).agg(F.count("*").alias("windows"))
        .select(F.lit(name).alias("metric"), "windows") for name in mobile.METRICS
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_KEYS = ["window_start", "window_end", "postal_code", "status", "partition_hour"]


@query("open_windows", f"""{_LOGS} select {_WINDOW}, postal as postal_code, event_type as status,
  {_HOUR}, count(*) as status_count from w where s + interval 2 minute > (select m from mark)
group by s, postal, event_type""")
def open_windows(spark, sf):
    """Windows that the stream holds back after all logs, from its state."""
    path = scratch_path(spark, "held-back")
    logs = mobile.metric_files(_logs(spark, sf), "status_count")
    await_all(spark, [start_parquet_sink(
        logs, f"{path}/out", f"{path}/checkpoint", mobile.PARTITIONS["status_count"], UNTIL_CAUGHT_UP)])
    return state.open_windows(spark, f"{path}/checkpoint").select(*_KEYS, F.col("partial.count").alias("status_count"))


@query("late_rows_per_window", f"""{_LOGS},
counted as (select s, postal, event_type, count(*) as landed, count(*) filter (
  t < timestamp '2023-01-01 12:00:00' and s + interval 2 minute <= (select m from mark)) as late,
  s + interval 2 minute <= (select m from mark) as closed from w group by s, postal, event_type)
select {_WINDOW}, postal as postal_code, event_type as status, {_HOUR}, landed,
  case when closed then landed - late else 0 end as finished, case when closed then 0 else landed end as open, late
from counted""")
def late_rows_per_window(spark, sf):
    """The logs of the morning land after those of the afternoon: every row is in
    a finished window, in an open one, or counted as late."""
    path = scratch_path(spark, "late")
    wide = b.mobile_logs(spark, sf)
    for half in ("hour >= '12'", "hour < '12'"):
        wide.filter(half).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(f"{path}/in")
        logs = mobile.with_log_time(read_event_stream(spark, "text", {"path": f"{path}/in"}, MOBILE_LOG))
        await_all(spark, [start_parquet_sink(
            mobile.metric_files(logs, "status_count"), f"{path}/out/status_count", f"{path}/checkpoint",
            mobile.PARTITIONS["status_count"], UNTIL_CAUGHT_UP)])
    landed = mobile.status_count(mobile.with_log_time(wide))
    held = state.open_windows(spark, f"{path}/checkpoint").withColumn("status_count", F.col("partial.count"))
    return state.late_rows(landed, mobile.read_metric(spark, f"{path}/out", "status_count"), held, _KEYS, "status_count")


@query("compacted_stream", f"""select event_id, event_type, value, {ts('ts')} as at,
  {day('ts')} as event_date from events""")
def compacted_stream(spark, sf):
    """A stream's folder, compacted twice and folded while the stream goes on: every event once."""
    path = scratch_path(spark, "compacted")
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.col("ts").alias("at"), F.date_format("ts", "yyyy-MM-dd").alias("event_date"))
    feed = CompactedFeed(spark, f"{path}/out", f"{path}/compacted", events.schema, ["event_date"], fan_in=2)
    for landing in range(3):
        events.filter(F.pmod("event_id", F.lit(3)) == landing).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        await_all(spark, [start_parquet_sink(stream, f"{path}/out", f"{path}/checkpoint", ["event_date"], UNTIL_CAUGHT_UP)])
        if landing < 2:
            feed.compact()
    feed.fold()
    return feed.read()


def _recent(spark, sf, name):
    """The metric written by its stream, of which the newest folders are read."""
    path = scratch_path(spark, f"{name}-served")
    run = start_parquet_sink(
        mobile.metric_files(_logs(spark, sf), name), f"{path}/{name}", f"{path}/checkpoint",
        mobile.PARTITIONS[name], UNTIL_CAUGHT_UP,
    )
    await_all(spark, [run])
    return serve.read_recent(spark, path, name)


def _r(expr, places):
    """Round half up, as over decimal text."""
    return f"cast(round(cast({expr} as decimal(20,9)), {places}) as double)"


@query("latest_signal_strength", f"""{_LOGS}
select event_type as operator, {_r('v', 0)} as average_signal, {_HOUR}, postal as postal_code, {_WINDOW}
from ({_SIGNAL}) order by s desc, event_type, average_signal, postal limit 10""")
def latest_signal_strength(spark, sf):
    return serve.latest_signal_strength(_rounded(_recent(spark, sf, "signal_strength_by_operator"), "average_signal"))


@query("latest_gps_precision", f"""{_LOGS}
select provider, {_r('p', 2)} as average_precision, {_r('k', 2)} as average_satellites, {_HOUR}, {_WINDOW}
from ({_GPS}) order by s desc, provider limit 10""")
def latest_gps_precision(spark, sf):
    recent = _recent(spark, sf, "gps_precision_by_provider")
    return serve.latest_gps_precision(_rounded(recent, "average_precision", "average_satellites"))


@query("latest_status_count", f"""{_LOGS}
select event_type as status, n as status_count, {_HOUR}, postal as postal_code, {_WINDOW}
from ({_STATUS}) order by s desc, event_type, n, postal limit 10""")
def latest_status_count(spark, sf):
    return serve.latest_status_count(_recent(spark, sf, "status_count"))


# -- enrichment and lookups ------------------------------------------------------------

@query("clickstream_stream", f"""{CLICKS}
select id as "recordId", case when fails then 'ProcessingFailed' else 'Ok' end as result,
  case when not fails then {LINE} || chr(10) end as line from enriched""")
def clickstream_stream(spark, sf):
    """Enrichment of a stream of records; the CSV line of all fields is shown decoded."""
    records = as_record_stream(b.click_records(spark, sf), "clicks")
    out = caught_up(clickstream.transform_records(records), "clicks")
    return out.select(
        "recordId", "result", F.when(F.col("result") == clickstream.OK, decode_text(F.col("data"))).alias("line")
    )


@query("envelope_decode", """
select cast(event_id as varchar) as sequence, cast(user_id as varchar) as user_id, 'ok' as side from events
where event_type <> 'error' union all
select cast(event_id as varchar), null, 'failed' from events where event_type = 'error'""")
def envelope_decode(spark, sf):
    """Events as records, of which those of one type are cut short."""
    whole = b.enveloped(
        table(spark, sf, "events").select(F.col("event_id").cast("string").alias("sequence"), "user_id", "event_type"),
        ["user_id", "event_type"], ["sequence", "event_type"],
    )
    cut = F.when(F.col("event_type") == "error", F.substring("data", 1, 8)).otherwise(F.col("data"))
    ok, failed = decode_envelope(
        whole.select("sequence", cut.alias("data")), columns("user_id string, event_type string")
    )
    return ok.select("sequence", "user_id", F.lit("ok").alias("side")).unionByName(
        failed.select("sequence", F.lit(None).cast("string").alias("user_id"), F.lit("failed").alias("side"))
    )


@query("derived_event_emit", f"""
with spenders as (select o_custkey u from orders group by 1
  having trunc(sum({money('o_totalprice')})) > {SPENDING_LIMIT})
select cast(user_id as varchar) as key,
  '{{"user_id":"' || user_id || '","discount_percentage":30}}' as value
from events where user_id in (select u from spenders)""")
def derived_event_emit(spark, sf):
    """Discounts from a stream of enveloped cart events, sent on as messages."""
    carts = b.cart_events(spark, sf).withColumn("user_id", F.col("user_id").cast("string"))
    records = b.enveloped(carts, ["user_id"], ["event_id"])
    events, _failed = decode_envelope(as_record_stream(records, "carts"), columns("user_id string"))
    history = staged(
        b.purchase_history(spark, sf).withColumn("user_id", F.col("user_id").cast("string")), "purchase-history"
    )
    found = discounts.user_discounts(events, history, SPENDING_LIMIT, seen=carts)
    path = scratch_path(spark, "discounts")
    run = emit_events(
        found, "user_id", "parquet", {"path": f"{path}/out"}, f"{path}/checkpoint", UNTIL_CAUGHT_UP
    )
    await_all(spark, [run])
    return spark.read.schema("key string, value string").parquet(f"{path}/out")


# -- trips ------------------------------------------------------------------------------

_TRIPS = f"""
with ends as (select l_orderkey k, sum({money('l_extendedprice')}) fare, sum({money('l_tax')}) tip
  from lineitem group by 1),
trips as (select * from orders left join ends on k = o_orderkey where o_orderpriority <> '1-URGENT')
"""


def trip_records(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Starts and ends, each with a field that is not declared."""
    starts = b.enveloped(
        b.known_trip_starts(spark, sf).withColumn("vendor", F.concat(F.lit("v"), F.col("trip_id"))),
        ["trip_id", "pickup_datetime", "estimated_fare_amount", "vendor"], ["sequence"],
    )
    ends = b.enveloped(
        b.trip_ends(spark, sf).withColumn("payment", F.when(F.col("tip_amount") > 0, "card").otherwise("cash")),
        ["trip_id", "fare_amount", "tip_amount", "total_amount", "payment"], ["sequence"],
    )
    return starts, ends


def run_trips(spark, sf, report: str | None = None, aside: str | None = None) -> KeyedTable:
    """Both streams at once; ends that came before their start are applied when both have caught up."""
    aside = aside or scratch_path(spark, "trips-aside")
    trip_table = trips.create_trip_table(KeyedTable(spark, scratch_path(spark, "trips")))
    starts, ends = trip_records(spark, sf)
    await_all(spark, [
        trips.start_lifecycle(
            as_record_stream(records, kind), trip_table, scratch_path(spark, f"{kind}-checkpoint"), kind,
            UNTIL_CAUGHT_UP, report, "month", aside,
        ) for kind, records in (("starts", starts), ("ends", ends))
    ])
    trips.replay_skipped(trip_table, aside, report)
    return trip_table


_TRIP_ROWS = f"""{_TRIPS}
select cast(o_orderkey as varchar) as trip_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as pickup_datetime,
  cast({money('o_totalprice')} as double) as estimated_fare_amount, cast(fare as double) as fare_amount,
  cast(tip as double) as tip_amount, cast(fare + tip as double) as total_amount, 'v' || o_orderkey as vendor,
  case when tip > 0 then 'card' when tip is not null then 'cash' end as payment from trips"""


@query("trip_lifecycle", _TRIP_ROWS)
def trip_lifecycle(spark, sf):
    """Starts create trips, ends patch the ones that are known; fields of either that are not declared stay."""
    held = run_trips(spark, sf).read()
    return held.select(
        *[c for c in held.columns if c not in (trips.LAYOUT, trips.ATTRIBUTES, trips.APPLIED)],
        trips.attribute("vendor"), trips.attribute("payment"))


def run_trip_log(spark, sf) -> tuple[str, str]:
    """Both feeds into the state of each trip; folders of the log and of the checkpoint."""
    path = scratch_path(spark, "trip-log")
    starts, ends = (as_record_stream(records, kind) for kind, records in zip(("starts", "ends"), trip_records(spark, sf)))
    pages = -(-b.number_of(spark, sf, "orders") // lifecycle.PAGE_TRIPS)
    await_all(spark, [lifecycle.start_trip_log(
        starts, ends, f"{path}/log", f"{path}/checkpoint", trigger=UNTIL_CAUGHT_UP, pages=max(1, pages))])
    return f"{path}/log", f"{path}/checkpoint"


@query("trip_state_lifecycle", _TRIP_ROWS)
def trip_state_lifecycle(spark, sf):
    """The trips of ``trip_lifecycle`` from keyed state: no replay, no folder written twice."""
    held = lifecycle.trip_table(spark, run_trip_log(spark, sf)[0])
    return held.select(*[c for c in held.columns if c != trips.ATTRIBUTES],
                       *[F.col(trips.ATTRIBUTES)[name].alias(name) for name in ("vendor", "payment")])


@query("trip_ends_waiting", """
select distinct cast(l_orderkey as varchar) as trip_id, l_orderkey as sequence from lineitem join orders on o_orderkey = l_orderkey
where o_orderpriority = '1-URGENT'""")
def trip_ends_waiting(spark, sf):
    """Ends of trips that have not started, listed from the state of the stream."""
    return lifecycle.waiting_ends(spark, run_trip_log(spark, sf)[1]).select("trip_id", "sequence")


@query("trip_outcomes", """
with ends as (select distinct l_orderkey k, l_orderkey % 10 = 0 as cut, o_orderpriority <> '1-URGENT' as known
  from lineitem join orders on o_orderkey = l_orderkey)
select count(*) filter (not cut and known) as processed, count(*) filter (cut) as errors,
  count(*) filter (not cut and not known) as skipped, count(*) filter (not cut and known) as triggered from ends""")
def trip_outcomes(spark, sf):
    """Outcomes of all batches of ends, observed as they are applied; every tenth record is cut short."""
    held = trips.create_trip_table(KeyedTable(spark, scratch_path(spark, "trips")))
    path = scratch_path(spark, "trip-outcomes")
    starts, ends = trip_records(spark, sf)
    trips.apply_start_records(held, starts, grain="month")
    cut = ends.select("sequence", F.when(F.col("sequence") % 10 == 0, F.substring("data", 1, 8)).otherwise(F.col("data")).alias("data"))
    await_all(spark, [trips.start_lifecycle(
        as_record_stream(cut, "ends"), held, f"{path}/checkpoint", "ends", UNTIL_CAUGHT_UP, grain="month", counts=f"{path}/counts")])
    return trips.outcome_counts(spark, f"{path}/counts", trips.OUTCOMES)


@query("trip_records_aside", """
select 'failed' as reason, cast(o_orderkey as varchar) as sequence from orders where o_orderpriority = '1-URGENT'
union all
select distinct 'skipped', cast(l_orderkey as varchar) from lineitem join orders on o_orderkey = l_orderkey
where o_orderpriority = '1-URGENT'""")
def trip_records_aside(spark, sf):
    """Starts of urgent orders are cut short and fail; their ends find no trip."""
    aside = scratch_path(spark, "aside")
    held = trips.create_trip_table(KeyedTable(spark, scratch_path(spark, "trips")))
    starts = b.enveloped(b.trip_starts(spark, sf), ["trip_id", "pickup_datetime", "estimated_fare_amount"], ["sequence"])
    known = b.known_trip_starts(spark, sf).select("sequence", F.lit(True).alias("known"))
    broken = starts.join(known, "sequence", "left").select(
        "sequence", F.when(F.col("known"), F.col("data")).otherwise(F.substring("data", 1, 8)).alias("data"))
    ends = b.enveloped(b.trip_ends(spark, sf), ["trip_id", "fare_amount", "tip_amount", "total_amount"], ["sequence"])
    for kind, records in (("starts", broken), ("ends", ends)):
        await_all(spark, [trips.start_lifecycle(
            as_record_stream(records, kind), held, scratch_path(spark, f"{kind}-checkpoint"), kind, UNTIL_CAUGHT_UP,
            grain="month", aside=aside)])
    return trips.read_put_aside(spark, aside).select("reason", "sequence")


@query("skipped_trip_ends", """
select distinct cast(l_orderkey as varchar) as trip_id from lineitem
join orders on o_orderkey = l_orderkey where o_orderpriority = '1-URGENT'""")
def skipped_trip_ends(spark, sf):
    from ..plans.trips import skipped_ends

    return skipped_ends(b.known_trip_starts(spark, sf), b.trip_ends(spark, sf)).select("trip_id")


@query("daily_fares_report", f"""{_TRIPS}
select strftime(o_orderdate, '%Y-%m-%d') as date, cast(sum(coalesce(fare, 0)) as double) as total_fare,
  count(*) as count_trips from trips group by 1""")
def daily_fares_report(spark, sf):
    """JSON result files written by the run over the trips that have ended."""
    folder = scratch_path(spark, "fares")
    run_trips(spark, sf, folder)
    return trips.latest_fares(spark, folder).select("date", "v.total_fare", "v.count_trips")


def _pairs(bound: str) -> str:
    return f"""
with starts as (select o_orderkey k, o_orderdate s from orders),
ends as (select l_orderkey k, min(l_shipdate) e from lineitem group by 1),
pairs as (select ends.k, e, starts.s from ends left join starts on starts.k = ends.k and s <= e {bound})
"""


def _trip_events(spark, sf):
    starts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_orderdate").cast("timestamp").alias("started_at")
    )
    ends = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("trip_id")).agg(
        F.min("l_shipdate").cast("timestamp").alias("ended_at")
    )
    return starts, ends


@query("trip_correlation", f"""{_pairs("")}
select k as trip_id, {ts('e')} as ended_at, {ts('s')} as started_at from pairs""")
def trip_correlation(spark, sf):
    """Ends with their start; an end whose start does not fit keeps a null."""
    starts, ends = _trip_events(spark, sf)
    return trips.correlate_trips(starts, ends).select("trip_id", "ended_at", "started_at")


@query("trip_correlation_stream", f"""{_pairs("and e <= s + interval 400 day")}
select k as trip_id, {ts('e')} as ended_at, {ts('s')} as started_at from pairs where s is not null""")
def trip_correlation_stream(spark, sf):
    """Two streams joined; the pairs found."""
    starts, ends = _trip_events(spark, sf)
    both = trips.correlate_trips(
        as_record_stream(starts, "starts"), as_record_stream(ends, "ends"), "400 days"
    )
    pairs = both.filter(F.col("start_trip_id").isNotNull()).select("trip_id", "ended_at", "started_at")
    return caught_up(pairs, "pairs")


@query("batch_outcome_counts", f"""{CLICKS}
select count(case when not fails then 1 end) as processed, count(case when fails then 1 end) as errors
from (select event_type, user_id, (event_type = 'error' and cast(user_id as bigint) % 3 in (0, 1))
  or user_id = '12' as fails from clicks)""")
def batch_outcome_counts(spark, sf):
    """Processed and failed records, counted by the stream as it runs by."""
    parsed = parse_envelope(as_record_stream(b.click_records(spark, sf), "counted"), columns("id string"))
    path = scratch_path(spark, "counted")
    await_all(spark, [trips.start_outcome_counts(parsed, f"{path}/out", f"{path}/checkpoint", UNTIL_CAUGHT_UP)])
    return trips.outcome_counts(spark, f"{path}/out")


# -- file lifecycle ------------------------------------------------------------------------

@query("stream_parquet_append", "select event_type, count(*) as n from events group by 1")
def stream_parquet_append(spark, sf):
    """All events appended to files laid out by type."""
    events = as_record_stream(table(spark, sf, "events").select("event_id", "event_type"), "append")
    return caught_up(events, "append", ["event_type"]).groupBy("event_type").agg(F.count("*").alias("n"))


@query("ingest_and_archive", f"""
select o_orderkey as order_id, o_custkey as user_id, {ts('o_orderdate')} as ordered_at from orders""")
def ingest_and_archive(spark, sf):
    """Landing files go into a keyed table once, in two runs, and then to the archive."""
    root = scratch_path(spark, "landing")
    schema = columns("order_id bigint, user_id bigint, ordered_at timestamp")
    held = KeyedTable(spark, f"{root}/table").create(spark.createDataFrame([], schema))
    orders = table(spark, sf, "orders")

    def land(statuses):
        orders.filter(F.col("o_orderstatus").isin(*statuses)).select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        ).write.mode("append").option("header", True).csv(f"{root}/new")

    def apply(batch, batch_id):
        held.upsert(batch, ["order_id"], feed="landing", batch=batch_id)

    for statuses in (("F", "P"), ("O",)):
        land(statuses)
        await_all(spark, [ingest_new_files(
            spark, f"{root}/new", f"{root}/archive", f"{root}/checkpoint", schema, apply, header="true"
        )])
    return held.read()

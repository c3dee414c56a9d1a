"""KPIs against plain loops over small hand-made data."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.ranking import within_rank
from tidemark.operators.tables import KeyedTable
from tidemark.plans import commerce, discounts, listening, rental, reports, rollups, trips

T0 = datetime(2024, 1, 1)


def band(age):
    for low, high, name in ((0, 25, "18-25"), (25, 35, "26-35"), (35, 45, "36-45"), (45, 55, "46-55"),
                            (55, 65, "56-65"), (65, 100, "66+")):
        if age is not None and low < age <= high:
            return name


def first_best(counter):
    return min(counter, key=lambda label: (-counter[label], label))


@pytest.fixture(scope="module")
def music(spark):
    rnd = random.Random(5)
    # t1 sits in two genres, t4 has no genre and no length, t9 is not in the catalogue.
    songs = [("t1", "a", "one", 1000, "pop"), ("t1", "a", "one", 3000, "rock"), ("t2", "b", "two", 2500, "pop"),
             ("t3", "b", "three", 4000, "rock"), ("t4", "c", "four", None, None), ("t5", None, "five", 100, "pop")]
    users = [("u1", 25), ("u2", 26), ("u3", 101), ("u4", 0), ("u5", None), ("u6", 60)]
    plays = []
    for _ in range(400):
        at = T0 + timedelta(hours=rnd.randint(0, 30), minutes=rnd.choice([0, 15]))
        track = rnd.choice(["t1", "t1", "t1", "t2", "t3", "t4", "t5", "t9", None])
        plays.append((rnd.choice([*[u for u, _ in users], "u9", None]), track, at.strftime("%Y-%m-%d %H:%M:%S")))
    # An hour in which every listener falls outside the bands.
    plays += [("u3", "t2", "2024-03-01 10:00:00"), ("u4", "t2", "2024-03-01 10:30:00")]
    return (
        spark.createDataFrame(plays, "user_id string, track_id string, listen_time string"),
        spark.createDataFrame(songs, "track_id string, artists string, track_name string, duration_ms int, track_genre string"),
        spark.createDataFrame(users, "user_id string, user_age int"),
        plays, songs, users,
    )


def test_genre_kpis(music):
    streams, songs_df, _users_df, plays, songs, _ = music
    merged = []
    for _user, track, at in plays:
        found = [s for s in songs if s[0] == track] or [(None, None, None, None, None)]
        merged += [(at[:10], s[4], track, s[3]) for s in found]
    total = Counter(d for d, *_ in merged)
    want = []
    for d, g in {(d, g) for d, g, *_ in merged if g is not None}:
        part = [m for m in merged if m[:2] == (d, g)]
        times = [m[3] for m in part if m[3] is not None]
        want.append((date.fromisoformat(d), g, len(part), len(part) / total[d], sum(times) / len(times) / 1000,
                     first_best(Counter(m[2] for m in part))))
    got = rows(listening.genre_daily_kpis(streams, songs_df))
    assert [g[:3] + g[5:] for g in got] == [w[:3] + w[5:] for w in sorted(want, key=lambda r: tuple(map(str, r)))]
    for g, w in zip(got, sorted(want, key=lambda r: tuple(map(str, r)))):
        assert g[3:5] == pytest.approx(w[3:5])


def test_hourly_kpis(music):
    streams, songs_df, users_df, plays, songs, users = music
    ages = dict(users)
    hours = defaultdict(list)
    for user, track, at in plays:
        if user in ages:
            hours[(at[:10], int(at[11:13]))] += [(user, track, at, s[1]) for s in songs if s[0] == track]
    want = {}
    for hour, full in hours.items():
        artists = Counter(f[3] for f in full if f[3] is not None)
        if not artists:
            continue
        users_ = {f[0] for f in full}
        sessions = {(f[0], f[2]) for f in full}
        bands = Counter(band(ages[f[0]]) for f in full if band(ages[f[0]]))
        top = first_best(artists)
        want[hour] = (len(users_), artists[top], top, len(sessions) / len(users_),
                      len({f[1] for f in full}) / len(full), first_best(bands) if bands else "18-25")
    got = {(str(r[0]), r[1]): tuple(r)[2:] for r in listening.hourly_kpis(streams, songs_df, users_df).collect()}
    assert got == want
    assert got[("2024-03-01", 10)][-1] == "18-25"


def test_top_songs_keep_ties(music):
    streams, songs_df, _u, plays, songs, _ = music
    days = Counter((at[:10], t) for _user, t, at in plays if t is not None)
    detailed = [(d, s[4], t, n) for (d, t), n in days.items() for s in songs if s[0] == t]

    def rank(group, n):
        return 1 + sum(1 for g in group if g[3] > n)

    best = [r for r in detailed if rank([x for x in detailed if x[:2] == r[:2]], r[3]) <= 1]
    want = [r for r in best if rank([x for x in best if x[0] == r[0]], r[3]) <= 2]
    got = listening.top_songs(streams, songs_df, per_genre=1, per_day=2).select(
        F.col("report_date").cast("string"), "track_genre", "track_id", "total_listens"
    )
    assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_within_rank_equals_a_window_rank(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), rnd.randint(0, 9), i) for i in range(300)]
    data += [("tied", 1, i) for i in range(300, 400)]
    df = spark.createDataFrame(data, "g string, v int, id int").cache()
    for k in (1, 3, 40):
        want = [r for r in data if 1 + sum(1 for x in data if x[0] == r[0] and x[1] > r[1]) <= k]
        assert rows(within_rank(df, ["g"], "v", k)) == sorted(
            want, key=lambda r: tuple((v is None, str(v)) for v in r)
        )


def test_rental_metrics(spark):
    rnd = random.Random(2)
    listed = []
    for i in range(300):
        start = T0 + timedelta(hours=rnd.randint(0, 60))
        end = start + timedelta(minutes=rnd.randint(-90, 600)) if rnd.random() > 0.1 else None
        amount = Decimal(rnd.randint(1, 9999)) / 100 if rnd.random() > 0.1 else None
        # One user and one vehicle hold most of the rows.
        listed.append((rnd.choice([1, 1, 1, 1, 2, 3, 9, None]), rnd.choice([7, 7, 7, 8, None]),
                       rnd.choice([70, 71, 79]), start, end, amount))
    schema = ("user_id int, vehicle_id int, pickup_location int, rental_start_time timestamp, "
              "rental_end_time timestamp, total_amount decimal(18,2)")
    df = spark.createDataFrame(listed, schema)
    users = spark.createDataFrame([(u,) for u in (1, 2, 3)], "user_id int")
    places = spark.createDataFrame([(70, "x"), (71, "y")], "location_id int, location_name string")
    kinds = spark.createDataFrame([(7, "car"), (8, "van")], "vehicle_id int, vehicle_type string")

    def hours(r):
        return None if r[4] is None else (r[4] - r[3]).total_seconds() / 3600

    def stats(part):
        money = [r[5] for r in part if r[5] is not None]
        span = [hours(r) for r in part if r[4] is not None]
        return len(part), sum(money), float(sum(money)) / len(money), max(money), min(money), span

    got = {r["user_id"]: r for r in rental.user_metrics(df, users).collect()}
    assert set(got) == {1, 2, 3}
    for u, r in got.items():
        n, total, mean, high, low, span = stats([x for x in listed if x[0] == u])
        assert (r["total_user_transactions"], r["user_total_revenue"], r["max_user_spending"], r["min_user_spending"]) == (n, total, high, low)
        assert (r["average_user_spending"], r["total_user_rental_hours"]) == pytest.approx((mean, sum(span)))

    got = {r["rental_date"].date(): r for r in rental.transaction_metrics(df, users).collect()}
    for d in {x[3].date() for x in listed if x[0] in (1, 2, 3)}:
        n, total, mean, _h, _l, span = stats([x for x in listed if x[3].date() == d and x[0] in (1, 2, 3)])
        r = got.pop(d)
        assert (r["total_transactions"], r["total_revenue"]) == (n, total)
        assert (r["average_transaction_value"], r["max_rental_duration"], r["min_rental_duration"], r["avg_rental_duration"]
                ) == pytest.approx((mean, max(span), min(span), sum(span) / len(span)))
    assert not got

    known = [x for x in listed if x[1] in (7, 8) and x[2] in (70, 71)]
    got = {r["location_id"]: r for r in rental.location_performance(df, places, kinds).collect()}
    for p in (70, 71):
        part = [x for x in known if x[2] == p]
        n, total, mean, high, low, _ = stats(part)
        r = got[p]
        assert tuple(r)[1:3] + tuple(r)[4:] == (total, n, high, low, len({x[1] for x in part}))
        assert r[3] == pytest.approx(mean)
    got = {r["vehicle_type"]: r for r in rental.vehicle_type_performance(df, places, kinds).collect()}
    for v, name in ((7, "car"), (8, "van")):
        n, total, mean, high, low, span = stats([x for x in known if x[1] == v])
        r = got[name]
        assert (r[1], r[2], r[4], r[5]) == (total, n, high, low)
        assert (r[3], r[6]) == pytest.approx((mean, sum(span) / len(span)))


def test_order_kpis(spark):
    orders = [(1, 10, "Returned", "2024-01-01 10:00:00 UTC", 2), (2, 10, "Complete", "2024-01-01 11:00:00 UTC", 1),
              (3, 11, "Returned", "2024-01-02 00:00:00", 3), (4, 12, "Returned", "yesterday", 9),
              (5, 12, None, "2024-01-02 23:59:59 UTC", 1), (6, 13, "Complete", "2024-01-03 00:00:00 UTC", 1)]
    items = [(1, 100, 5.0), (1, 100, 7.0), (1, 101, 1.0), (2, 100, None), (3, 101, 2.0), (4, 100, 3.0),
             (5, 102, 4.0), (5, 199, 4.0), (9, 100, 1.0), (None, 100, 1.0)]
    products = [(100, "toys"), (101, "food"), (102, None)]
    o = spark.createDataFrame(orders, "order_id long, user_id long, status string, created_at string, num_of_item long")
    i = spark.createDataFrame(items, "order_id long, product_id long, sale_price double")
    p = spark.createDataFrame(products, "id long, category string")
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    assert rows(commerce.category_wise_summary(o, i, p)) == [
        (d1, "food", 2.0, 1.0, 1.0), (d1, "toys", 24.0, 6.0, 0.5), (d2, "food", 6.0, 2.0, 1.0),
    ]
    assert rows(commerce.daily_order_summary(o, i, p)) == [(d1, 2, 26.0, 7, 0.5, 1), (d2, 2, 10.0, 4, 0.5, 2)]


def test_daily_fares_count_missing_fares_as_zero(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", 5.0), ("b", "2024-01-01 11:00:00", None), ("c", "2024-01-02 00:00:00", -1.0)],
        "trip_id string, pickup_datetime string, fare_amount double",
    )
    assert rows(trips.daily_fares(df)) == [("2024-01-01", 5.0, 2, 5.0, 0.0, 2.5), ("2024-01-02", -1.0, 1, -1.0, -1.0, -1.0)]


def test_discount_per_event(spark):
    events = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",), (None,)], "user_id string")
    history = spark.createDataFrame(
        [("a", 101.0), ("b", 100.99), ("c", 100.0), (None, 500.0)], "user_id string, total_amount_spent double",
    )
    assert rows(discounts.user_discounts(events, history)) == [("a", 30), ("a", 30)]


def test_users_listed_twice_need_an_order(spark):
    events = spark.createDataFrame([("a",), ("b",)], "user_id string")
    history = spark.createDataFrame(
        [("a", 150.0, 1), ("a", 50.0, 2), ("b", 50.0, 1), ("b", 150.0, 2)],
        "user_id string, total_amount_spent double, row int",
    )
    assert rows(discounts.user_discounts(events, history, order_by="row")) == [("b", 30)]
    with pytest.raises(Exception, match="several spending rows"):
        discounts.user_discounts(events, history).collect()


def test_track_report_patch_keeps_other_attributes(spark):
    best = spark.createDataFrame(
        [(date(2024, 1, 1), "t1", "one", "a", g, 4, 2, 10, 2.5) for g in ("pop", "rock")],
        "report_date date, track_id string, track_name string, artists string, track_genre string, "
        "total_listens long, unique_users long, total_listening_time long, avg_listening_time_per_user double",
    )
    target = spark.createDataFrame(
        [("t1", date(2024, 1, 1), 1, None, None, None, "kept")],
        "track_id string, report_date date, total_listens long, unique_users long, total_listening_time long, "
        "avg_listening_time_per_user decimal(18,6), note string",
    )
    assert rows(reports.patch_track_reports(target, best)) == [
        ("t1", date(2024, 1, 1), 4, 2, 10, Decimal("2.500000"), "kept")
    ]


def test_exact_sums_do_not_depend_on_row_order(spark):
    df = spark.range(20000).select(
        (F.col("id") % 7).alias("user_id"), F.lit(T0).alias("rental_start_time"), F.lit(T0).alias("rental_end_time"),
        (F.rand(1) * 1e6).cast("decimal(18,2)").alias("total_amount"),
    )
    users = spark.range(7).toDF("user_id")
    one = rows(rental.user_metrics(df.orderBy("total_amount"), users))
    assert one == rows(rental.user_metrics(df.orderBy(F.desc("total_amount")).repartition(13), users))


# -- roll-ups ------------------------------------------------------------------

def heard(spark, *listed):
    return spark.createDataFrame(listed, "user_id long, listen_time string")


def test_bitmaps_of_hours_add_up_to_days_and_months(spark):
    rnd = random.Random(3)
    ids = [0, -5, 32768, 32769, 10**12, *range(1, 40)]
    plays = [(rnd.choice(ids), f"2024-0{rnd.randint(1, 2)}-{rnd.randint(1, 3):02d} {rnd.randint(0, 23):02d}:10:00")
             for _ in range(600)]
    plays += [(None, "2024-01-01 00:00:00"), (3, None)]
    cut = 250
    hours = rollups.add_bitmaps(*[rollups.listener_bitmaps(heard(spark, *p)) for p in (plays[:cut], plays[cut:], plays[cut:])])
    for level, width in (("day", 10), ("month", 7)):
        users = defaultdict(set)
        for user, at in plays:
            if user is not None and at is not None:
                users[at[:width]].add(user)
        got = rollups.unique_listeners(hours, p=F.date_format("listen_date", "yyyy-MM-dd"[:width]))
        assert rows(got) == sorted((p, len(u)) for p, u in users.items())
    assert rollups.unique_listeners(rollups.listener_bitmaps(heard(spark, (1, "2024-01-01 00:00:00")).limit(0)), p=F.col("listen_date")).count() == 0


def test_song_days_of_batches_give_the_report_of_all_plays(spark, music, tmp_path):
    streams, songs_df, *_ = music
    early = streams.filter("listen_time < '2024-01-01 12:00:00'")
    late = streams.filter("listen_time >= '2024-01-01 12:00:00'")
    table = KeyedTable(spark, str(tmp_path / "days"))
    for batch, part in enumerate((early, late)):
        rollups.keep_song_days(table, part, "plays", batch)
    before = table._published()["slices"]
    rollups.keep_song_days(table, late, "plays", 1)
    assert table._published()["slices"] == before
    got = listening.top_of_song_days(rollups.with_user_estimate(table.read()), songs_df)
    want = listening.top_songs(streams, songs_df)
    # Few users: both estimates are exact.
    assert rows(got.select(*want.columns)) == rows(want)
    # A batch of another day leaves the first days alone.
    march = spark.createDataFrame([("u1", "t1", "2024-03-05 10:00:00")], streams.schema)
    rollups.keep_song_days(table, march, "plays", 2)
    after = table._published()["slices"]
    assert {f: after[f] for f in before} == before and set(after) - set(before) == {"report_date=2024-03-05"}

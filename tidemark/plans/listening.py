"""Listening KPIs: per genre and day, per hour, and the daily top songs.

``streams``: user_id, track_id, listen_time. ``songs``: track_id, artists,
track_name, duration_ms, track_genre (a track may sit in several genres).
``users``: user_id, user_age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import most_frequent, quotient
from ..functions.labels import AGE_BANDS, age_band
from ..functions.times import ms_to_seconds
from ..operators.ranking import N, at_or_above, counts_within_rank, cut_offs, value_counts
from ..operators.staging import staged


def genre_daily_kpis(streams: DataFrame, songs: DataFrame) -> DataFrame:
    """Listens, share of the day's listens, mean duration and top track.

    Streams are counted per track and day before they meet the catalogue, so a
    track with a large share of all streams is one row per task in the shuffle.
    Streams whose track has no genre count in the day's total only.
    """
    plays = (
        streams.groupBy(F.to_date("listen_time").alias("listen_date"), "track_id")
        .agg(F.count("*").alias("plays"))
        .filter(F.col("listen_date").isNotNull())
    )
    catalogue = songs.groupBy("track_id", "track_genre").agg(
        F.count("*").alias("copies"),
        F.sum(F.col("duration_ms").cast("bigint")).alias("ms"),
        F.count("duration_ms").alias("timed"),
    )
    per_track = plays.join(catalogue, "track_id", "left").withColumn(
        "listens", F.col("plays") * F.coalesce("copies", F.lit(1))
    )
    per_genre = per_track.groupBy("listen_date", "track_genre").agg(
        F.sum("listens").alias("listen_count"),
        F.sum(F.col("plays") * F.col("ms")).alias("ms"),
        F.sum(F.col("plays") * F.col("timed")).alias("timed"),
        most_frequent(F.col("track_id"), F.col("listens")).alias("most_popular_track_id"),
    )
    # One row per genre and day is left, so a day is a small group here.
    day_total = F.sum("listen_count").over(Window.partitionBy("listen_date"))
    return (
        per_genre.withColumn("day_total", day_total)
        .filter(F.col("track_genre").isNotNull())
        .select(
            "listen_date",
            "track_genre",
            "listen_count",
            quotient(F.col("listen_count"), F.col("day_total")).alias("popularity_index"),
            ms_to_seconds(quotient(F.col("ms"), F.col("timed"))).alias("average_duration"),
            "most_popular_track_id",
        )
    )


def hourly_kpis(streams: DataFrame, songs: DataFrame, users: DataFrame) -> DataFrame:
    """Listeners, top artist, sessions per user, track diversity and age group.

    A session is a user at one listen time. Plays are counted per hour, user
    and track before they meet the songs and users; every facet is added up
    from these counts. Only the sessions go back to single plays, of which
    they need the hour, user and time.
    """
    hour = ["listen_date", "listen_hour"]
    heard = streams.select(
        F.to_date("listen_time").alias("listen_date"),
        F.hour("listen_time").alias("listen_hour"),
        "user_id", "track_id", "listen_time",
    ).filter(F.col("listen_date").isNotNull())
    cells = staged(
        heard.groupBy(*hour, "user_id", "track_id").agg(F.count("*").alias("plays"))
        .join(songs.select("track_id", "artists"), "track_id")
        .join(users.select("user_id", age_band(F.col("user_age")).alias("age_group")), "user_id"),
        "hour-cells",
    )

    def added(column: str) -> DataFrame:
        return cells.groupBy(*hour, column).agg(F.sum("plays").alias("plays"))

    artists, ages = (added(c).filter(F.col(c).isNotNull()) for c in ("artists", "age_group"))
    listeners = cells.select(*hour, "user_id").distinct()
    sessions = (
        heard.join(songs.select("track_id"), "track_id", "left_semi")
        .groupBy(*hour, "user_id").agg(F.count_distinct("listen_time").alias("sessions"))
        .join(listeners, [*hour, "user_id"], "left_semi")
    )
    # From here on a row per hour.
    per_hour = (
        artists.groupBy(*hour).agg(
            F.max("plays").alias("listen_counts"), most_frequent(F.col("artists"), F.col("plays")).alias("top_artist"))
        .join(sessions.groupBy(*hour).agg(F.count("*").alias("unique_listeners"), F.sum("sessions").alias("sessions")), hour)
        .join(added("track_id").groupBy(*hour).agg(F.count("*").alias("tracks"), F.sum("plays").alias("plays")), hour)
        .join(ages.groupBy(*hour).agg(most_frequent(F.col("age_group"), F.col("plays")).alias("age_group")), hour, "left")
    )
    return per_hour.filter(F.col("top_artist").isNotNull()).select(
        *hour,
        "unique_listeners",
        "listen_counts",
        "top_artist",
        quotient(F.col("sessions"), F.col("unique_listeners")).alias("avg_sessions_per_user"),
        quotient(F.col("tracks"), F.col("plays")).alias("diversity_index"),
        # An hour whose listeners all fall outside the bands keeps the first band.
        F.coalesce("age_group", F.lit(AGE_BANDS[0][2])).alias("most_engaged_age_group"),
    )


def top_songs(
    streams: DataFrame, songs: DataFrame, per_genre: int = 3, per_day: int = 5
) -> DataFrame:
    """Per day, the songs ranked up to ``per_day`` among each genre's best.

    Ties keep all songs of a rank. total_listening_time and
    avg_listening_time_per_user are the sum and mean of the listen times as
    epoch seconds; unique_users is approximate. Days on which most songs tie
    are common, so both ranks are taken over listen counts and not over rows.
    """
    song_day = staged(
        streams.filter(F.col("track_id").isNotNull())
        .withColumn("report_date", F.to_date("listen_time"))
        .withColumn("epoch", F.unix_timestamp("listen_time"))
        .groupBy("track_id", "report_date")
        .agg(
            F.count("*").alias("total_listens"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.sum("epoch").alias("total_listening_time"),
            F.count("epoch").alias("timed"),
        ),
        "song-day",
    )
    return top_of_song_days(song_day, songs, per_genre, per_day)


def top_of_song_days(song_day: DataFrame, songs: DataFrame, per_genre: int = 3, per_day: int = 5) -> DataFrame:
    """As ``top_songs``, from one row per track and day: total_listens,
    unique_users, total_listening_time and timed. It is read twice."""
    catalogue = songs.filter(F.col("track_id").isNotNull())
    genre_day, day = ["report_date", "track_genre"], ["report_date"]
    listens = value_counts(
        song_day.select("track_id", "report_date", "total_listens")
        .join(catalogue.select("track_id", "track_genre"), "track_id"),
        genre_day, "total_listens",
    )
    best_of_genre = counts_within_rank(listens, genre_day, "total_listens", per_genre)
    of_day = best_of_genre.groupBy("report_date", "total_listens").agg(F.sum(N).alias(N))
    best_of_day = cut_offs(counts_within_rank(of_day, day, "total_listens", per_day), day, "total_listens")
    # Small: a row per genre and day.
    cuts = cut_offs(at_or_above(best_of_genre, best_of_day, day, "total_listens"), genre_day, "total_listens")
    detailed = song_day.join(
        catalogue.select("track_id", "track_name", "artists", "track_genre"), "track_id"
    )
    return at_or_above(detailed, cuts, genre_day, "total_listens").select(
        "report_date", "track_id", "track_name", "artists", "track_genre",
        "total_listens", "unique_users", "total_listening_time",
        quotient(F.col("total_listening_time"), F.col("timed")).alias("avg_listening_time_per_user"),
    )

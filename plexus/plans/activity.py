"""Engagement KPIs, action mixes and activity time series over the edge list.

Every function is ``DataFrame -> DataFrame``; aggregations are partial
(map-side combine) so a hot user or a hot day never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.functions.columns import calendar_columns, resolve_time_column, safe_ratio


def timeline(edges: DataFrame) -> DataFrame:
    """Edge rows with a resolved ``timestamp`` and the calendar columns."""
    return calendar_columns(resolve_time_column(edges))


def kpi_summary(edges: DataFrame) -> DataFrame:
    """Total events, likes, shares, comments, engagement rate and distinct users, one pass.

    Each edge is expanded to its two endpoints so the distinct-user count rides
    along the same aggregation (side 0 carries the per-event counters).
    """
    ends = edges.select(
        "action",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("user_from").alias("u")),
            F.struct(F.lit(1).alias("side"), F.col("user_to").alias("u")),
        )).alias("e"))
    first = F.col("e.side") == 0
    a = F.col("action")
    agg = ends.agg(
        F.count_if(first).alias("total_events"),
        F.count_if(first & (a == "LIKE")).alias("likes"),
        F.count_if(first & (a == "SHARE")).alias("shares"),
        F.count_if(first & (a == "COMMENT")).alias("comments"),
        F.countDistinct("e.u").alias("n_users"),
    )
    rate = safe_ratio(F.col("likes") + F.col("shares"), F.col("total_events"))
    return agg.select("total_events", "likes", "shares", "comments",
                      rate.alias("engagement_rate"), (rate * 100).alias("engagement_pct"), "n_users")


def action_distribution(edges: DataFrame) -> DataFrame:
    return (edges.groupBy("action").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("action")))


def daily_volume(edges: DataFrame) -> DataFrame:
    """Events per day: non-null actions and all rows."""
    return (timeline(edges).groupBy("date")
            .agg(F.count("action").alias("events"), F.count(F.lit(1)).alias("rows"))
            .orderBy("date"))


def hourly_by_date(edges: DataFrame) -> DataFrame:
    return (timeline(edges).groupBy("date", "hour")
            .agg(F.count("action").alias("events")).orderBy("date", "hour"))


def hourly_mean(edges: DataFrame) -> DataFrame:
    """Mean events per hour of day over the dates that have that hour."""
    return (hourly_by_date(edges).groupBy("hour")
            .agg(F.avg("events").alias("mean_events"), F.count(F.lit(1)).alias("n_dates"))
            .orderBy("hour"))


def hourly_volume(edges: DataFrame) -> DataFrame:
    return timeline(edges).groupBy("hour").agg(F.count(F.lit(1)).alias("count")).orderBy("hour")


def weekday_volume(edges: DataFrame) -> DataFrame:
    """Events per weekday, Monday first, only days present."""
    return (timeline(edges).groupBy("day_name", "weekday")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("weekday"))


def daily_active_users(edges: DataFrame) -> DataFrame:
    return (timeline(edges).groupBy("date")
            .agg(F.count("action").alias("interactions"),
                 F.countDistinct("user_from").alias("active_users"))
            .orderBy("date"))


def action_by_date(edges: DataFrame) -> DataFrame:
    """Long form action x date counts (the scalable form of the pivot)."""
    return (edges.where(F.col("event_time").isNotNull())
            .groupBy("action", F.to_date("event_time").alias("date"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("date", "action"))


def action_date_pivot(edges: DataFrame, dates: list) -> DataFrame:
    """Action x date matrix of the given dates, zero-filled, one column a date, and ``other``
    with the events of all other days, so that a row adds up to its action's events; actions
    without an event on any of the dates keep a row of zeros. One aggregation."""
    day = F.to_date("event_time")
    given = day.isin([F.lit(str(d)).cast("date") for d in dates]) if dates else F.lit(False)
    return (edges.where(F.col("event_time").isNotNull()).groupBy("action")
            .agg(*[F.count_if(day == F.lit(d)).alias(str(d)) for d in dates], F.count_if(~given).alias("other")).orderBy("action"))


def event_dates(edges: DataFrame) -> list:
    """The days that occur, ascending: the columns of a whole pivot (one value a day)."""
    return [r.d for r in edges.select(F.to_date("event_time").alias("d")).where("d is not null").distinct().orderBy("d").collect()]


def user_out_edges(edges: DataFrame, user: str) -> DataFrame:
    t = resolve_time_column(edges)
    return t.where(F.col("user_from") == user).select("user_to", "action", "timestamp")


def user_in_edges(edges: DataFrame, user: str) -> DataFrame:
    t = resolve_time_column(edges)
    return t.where(F.col("user_to") == user).select("user_from", "action", "timestamp")


def user_action_mix(edges: DataFrame, user: str) -> DataFrame:
    """One user's out/in interaction counts per action, in one scan."""
    outs = edges.where(F.col("user_from") == user).select(F.lit("out").alias("direction"), "action")
    ins = edges.where(F.col("user_to") == user).select(F.lit("in").alias("direction"), "action")
    return (outs.unionByName(ins).groupBy("direction", "action")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("direction", F.desc("count"), "action"))


def ego_size(edges: DataFrame, user: str) -> DataFrame:
    """Number of distinct users this user interacts with, either direction."""
    outs = edges.where(F.col("user_from") == user).select(F.col("user_to").alias("other"))
    ins = edges.where(F.col("user_to") == user).select(F.col("user_from").alias("other"))
    return (outs.union(ins).distinct()
            .agg(F.count(F.lit(1)).alias("ego_size"))
            .select(F.lit(user).alias("user"), "ego_size"))

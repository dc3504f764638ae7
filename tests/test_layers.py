"""Bronze parsing, Silver cleaning, Gold/metrics sinks and sources on hand-made dirty input."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.columns import calendar_columns, resolve_time_column
from plexus.operators import gold, silver
from plexus.plans import activity, rankings
from plexus.session import scratch_path
from plexus.sources import tables
from plexus.sources.messages import parse_messages

GOOD = '{"user_from":"a","user_to":"b","action":"like","timestamp":"2025-01-01 10:00:00"}'
DIRTY = [
    GOOD,
    GOOD,                                                                        # exact duplicate
    GOOD.replace('"like"', '"LIKE"'),                                            # kept: dedup before upper
    "{bad",                                                                      # malformed
    "[]",                                                                        # array
    None,                                                                        # null message
    '{"user_from":"a","x":1}',                                                   # missing fields
    GOOD.replace("2025-01-01 10:00:00", "bad"),                                  # bad time
    GOOD.replace("2025-01-01 10:00:00", "2025-01-01"),                           # date only: no match
    GOOD.replace('"like"', '"POKE"').replace("10:00:00", "11:00:00"),            # unknown action
    GOOD.replace('"user_from":"a"', '"user_from":""').replace("10:00:00", "12:00:00"),  # empty user
    GOOD.replace('"user_to":"b"', '"user_to":"a"').replace("10:00:00", "13:00:00"),     # self-loop
    GOOD.replace("2025-01-01 10:00:00", "2025-01-05 00:00:00"),                  # midnight, Sunday
]


@pytest.fixture(scope="module")
def messages(spark):
    schema = T.StructType([T.StructField("value", T.BinaryType(), True)])
    return spark.createDataFrame([(None if m is None else bytearray(m.encode()),) for m in DIRTY], schema)


def test_parse_keeps_bad_messages_as_null_rows(messages):
    bronze = parse_messages(messages)
    assert bronze.count() == len(DIRTY)
    nulls = bronze.where(F.col("user_from").isNull() & F.col("user_to").isNull()
                         & F.col("action").isNull() & F.col("timestamp").isNull()).count()
    assert nulls == 3
    assert bronze.where("user_from = 'a' AND user_to IS NULL").count() == 1


def test_silver_rules(messages):
    s = silver.clean(parse_messages(messages)).toPandas()
    # a date without a time does not match the full pattern and is dropped like a bad time
    assert len(s) == 6
    assert not (s.timestamp == "2025-01-01").any()
    assert sorted(s.action.unique()) == ["LIKE", "POKE"]
    ten = s[s.timestamp == "2025-01-01 10:00:00"]
    assert len(ten) == 2  # 'like' and 'LIKE' both survive
    assert "" in set(s.user_from)
    assert ((s.user_from == "a") & (s.user_to == "a")).sum() == 1
    mid = s[s.timestamp == "2025-01-05 00:00:00"].iloc[0]
    assert (mid.event_hour, mid.event_date) == ("00", "2025-01-05")


def test_silver_normalise_first_option(messages):
    s = silver.clean(parse_messages(messages), normalise_first=True)
    assert s.where("timestamp = '2025-01-01 10:00:00'").count() == 1


def test_calendar_and_time_resolution(spark, messages):
    e = gold.edges(silver.clean(parse_messages(messages)))
    t = calendar_columns(resolve_time_column(e))
    row = t.where("event_date = '2025-01-05'").first()
    assert (row["day_name"], row["weekday"], row["hour"]) == ("Sunday", 6, 0)
    raw = spark.createDataFrame([(" x ", "2025-01-01 10:00:00"), ("y", "nope")], ["user", "eventTime"])
    out = resolve_time_column(raw)
    assert out.count() == 1 and "timestamp" in out.columns
    with pytest.raises(ValueError):
        resolve_time_column(spark.createDataFrame([(1,)], ["x"]))


def test_empty_bronze_gives_zero_kpis(spark):
    from plexus.schemas import EVENT
    empty = spark.createDataFrame([], EVENT)
    e = gold.edges(silver.clean(empty))
    k = activity.kpi_summary(e).first()
    assert (k["total_events"], k["likes"], k["engagement_rate"], k["n_users"]) == (0, 0, 0.0, 0)
    assert activity.daily_volume(e).count() == 0


def test_gold_csv_round_trip(spark, golden_edges):
    path = scratch_path(spark, "test-csv")
    tables.write_edges_csv(golden_edges, path)
    back = tables.read_edges_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, golden_edges.collect()))


def test_gold_csv_keeps_odd_ids(spark):
    from plexus.schemas import EDGE
    ids = ["", " a ", "a", "x\ny", 'q"q', "c,d", "\\", "null", None]
    rows = [(u, "t", "LIKE", None, "2025-01-01", "10") for u in ids]
    path = scratch_path(spark, "test-odd-csv")
    tables.write_edges_csv(spark.createDataFrame(rows, EDGE), path)
    back = [r.user_from for r in tables.read_edges_csv(spark, path).collect()]
    assert sorted(map(repr, back)) == sorted(map(repr, ids))


def test_edge_folder_without_csv_is_an_error(spark, golden_edges):
    path = scratch_path(spark, "test-no-csv")
    golden_edges.write.parquet(path)
    with pytest.raises(FileNotFoundError):
        tables.read_edges_csv(spark, path)


def test_csv_row_that_does_not_fit_is_an_error(spark):
    path = scratch_path(spark, "test-bad-csv")
    spark.createDataFrame([("a", "b", "LIKE", "no time", "2025-01-01", "10")],
                          "user_from string, user_to string, action string, event_time string, event_date string, event_hour string"
                          ).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        tables.read_edges_csv(spark, path).collect()


def test_failed_overwrite_keeps_the_old_table(spark, golden_edges):
    path = scratch_path(spark, "test-atomic")
    tables.write_table(golden_edges, path)
    broken = golden_edges.withColumn("action", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(broken, path)
    assert tables.read_table(spark, path).count() == 44


def test_padded_column_name_is_found(spark):
    df = spark.createDataFrame([("2025-01-01 10:00:00", "a")], [" event_time ", " user "])
    out = resolve_time_column(df)
    assert out.count() == 1 and set(out.columns) == {"event_time", "user", "timestamp"}


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    m = spark.createDataFrame([("a", nan, 1.0, 1), ("b", 0.5, nan, 2), ("c", 0.25, 3.0, None), ("d", None, None, 4)],
                              "user string, pagerank double, betweenness double, community_louvain long")
    assert [r["user"] for r in rankings.top_by(m, "pagerank", 4).collect()] == ["b", "c", "a", "d"]
    p = rankings.metric_stats(m).where("metric = 'pagerank'").first()
    assert (p["min"], p["max"], p["avg"]) == (0.25, 0.5, 0.375)
    ranks = {r["user"]: r["rank"] for r in rankings.user_rank(m).collect()}
    assert ranks == {"b": 1, "c": 2, "a": 3, "d": 3}
    for u in "abcd":
        assert rankings.user_profile(m, u).first()["rank"] == ranks[u]
    assert rankings.top_n_stats(m, "pagerank", 2).first()["top_user"] == "b"
    assert {r["user"] for r in rankings.users_missing_metrics(m).collect()} == {"a", "b", "d"}
    assert [r["user"] for r in rankings.metric_pairs(m).collect()] == ["c"]


def test_metrics_csv_defaults(spark):
    path = scratch_path(spark, "test-metrics")
    spark.createDataFrame([("u1", "0.5")], ["user", "pagerank"]).write.option("header", True).csv(path)
    m = tables.read_metrics_csv(spark, path).first()
    assert (m["user"], m["pagerank"], m["betweenness"], m["community_louvain"]) == ("u1", 0.5, 0.0, -1)
    bad = scratch_path(spark, "test-metrics-bad")
    spark.createDataFrame([("u1", "0.5")], ["name", "pagerank"]).write.option("header", True).csv(bad)
    with pytest.raises(ValueError):
        tables.read_metrics_csv(spark, bad)


def test_overwrite_is_idempotent(spark, golden_edges):
    path = scratch_path(spark, "test-overwrite")
    tables.write_table(golden_edges, path, partition_by=["event_date"])
    tables.write_table(golden_edges, path, partition_by=["event_date"])
    assert tables.read_table(spark, path).count() == 44


def test_top_k_per_group_is_exact(spark):
    from plexus.functions.ranking import top_k_per_group
    rows = [("hot", f"u{i:03d}", float(i % 17)) for i in range(300)] + [("cold", "v1", 1.0)]
    df = spark.createDataFrame(rows, ["g", "user", "pagerank"])
    got = top_k_per_group(df, "g", [F.desc("pagerank"), F.asc("user")], 5, salt=8).collect()
    hot = sorted([r for r in rows if r[0] == "hot"], key=lambda r: (-r[2], r[1]))[:5]
    assert [r["user"] for r in sorted(got, key=lambda r: (r["g"], r["rank"])) if r["g"] == "hot"] == [h[1] for h in hot]
    assert len(got) == 6


def test_average_rank_matches_pandas(spark):
    import pandas as pd
    vals = [3.0, 1.0, 3.0, 2.0, 2.0, 2.0, 5.0, None]
    pdf = pd.DataFrame({"user": [f"u{i}" for i in range(len(vals))], "pagerank": vals})
    got = {r["user"]: r["rank"] for r in rankings.user_rank(spark.createDataFrame(pdf)).collect()}
    want = pdf.pagerank.rank(ascending=False)
    for u, w in zip(pdf.user, want):
        if w == w:
            assert got[u] == int(w)

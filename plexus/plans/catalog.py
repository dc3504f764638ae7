"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each builds the layers from the ``events`` table (Bronze adapter -> Silver ->
Gold -> graph). Graph tables and algorithm results are written to the shared
checkpoint folder once per session and table folder and reused by later
queries, like materialised views; ``clear_cache()`` forgets them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.functions.columns import calendar_columns, resolve_time_column
from plexus.operators import communities, gold, increments, paths, silver, triangles
from plexus.operators.graph import Graph, build_graph, degrees, graph_counts, graph_stats, undirected_pattern
from plexus.operators.pagerank import pagerank_run
from plexus.plans import activity, rankings
from plexus.plans.oracle import CENTER, COMMUNITY, INFLUENCER_MIN, PATH_TO, PIVOT_DATES, TOP_N
from plexus.schemas import EVENT
from plexus.session import at_once, file_identity, materialize, observation, prepare, scratch_path
from plexus.sources import quarantine, tables
from plexus.sources.events_adapter import events_path, interactions
from plexus.sources.messages import parse_messages, to_messages
from plexus.streaming import compaction, counters, windows
from plexus.streaming import silver as silver_streaming
from plexus.streaming.bronze import idempotent_batch_writer, run_bronze_stream, start_bronze, write_message_files

R = rankings.ROUND
_CACHE: dict = {}


def clear_cache() -> None:
    _CACHE.clear()


def _key(spark: SparkSession, sf_dir: str, name: str):
    # the files' identity: overwritten input is a new key
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), file_identity(spark, events_path(sf_dir)), name)


def _memo(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    k = _key(spark, sf_dir, name)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


# ---------------------------------------------------------------- layers

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return interactions(spark, sf_dir)


def silver_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver layer, written once."""
    return _memo(spark, sf_dir, "silver", lambda: materialize(silver.clean(bronze(spark, sf_dir)), "silver"))


def edges_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.edges(silver_df(spark, sf_dir))


def graph_of(spark: SparkSession, sf_dir: str) -> Graph:
    return _memo(spark, sf_dir, "graph", lambda: build_graph(edges_df(spark, sf_dir)))


def _pagerank(spark, sf_dir):
    def run():
        g = graph_of(spark, sf_dir)
        scores, summary = pagerank_run(g)
        return scores, summary
    return _memo(spark, sf_dir, "pagerank", run)


def _betweenness(spark, sf_dir):
    return _memo(spark, sf_dir, "betweenness", lambda: paths.betweenness_run(graph_of(spark, sf_dir)))


def _louvain(spark, sf_dir):
    return _memo(spark, sf_dir, "louvain", lambda: communities.louvain_run(graph_of(spark, sf_dir)))


def _lpa(spark, sf_dir):
    return _memo(spark, sf_dir, "lpa", lambda: communities.label_propagation_run(graph_of(spark, sf_dir)))


def metrics_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, pagerank, betweenness, community_louvain) from the graph algorithms. The
    community is label propagation's, whose labels SQL can restate; a caller of
    ``rankings.user_metrics`` passes Louvain's in the same place."""
    g = graph_of(spark, sf_dir)
    (pr, _), (bc, _), (labels, _) = at_once(
        spark, *[partial(run, spark, sf_dir) for run in (_pagerank, _betweenness, _lpa)])
    return rankings.user_metrics(g, pr, bc, labels.select("vid", F.col("label").alias("community_louvain")))


def pagerank_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, pagerank): all that the PageRank queries need."""
    scores, _ = _pagerank(spark, sf_dir)
    return graph_of(spark, sf_dir).user_names(scores).select("user", "pagerank")


def metrics_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.metrics_fixed(graph_of(spark, sf_dir))


def metrics_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed metrics with gaps: pagerank null for every third user, betweenness NaN for
    every seventh, no community for every eleventh (by the number in the user id)."""
    num = F.regexp_extract("user", r"(\d+)$", 1).try_cast("long")
    return metrics_fixed(spark, sf_dir).select(
        "user", F.when(num % 3 != 0, F.col("pagerank")).alias("pagerank"),
        F.when(num % 7 == 0, F.lit(float("nan"))).otherwise(F.col("betweenness")).alias("betweenness"),
        F.when(num % 11 != 0, F.col("community_louvain")).alias("community_louvain"))


# ---------------------------------------------------------------- sources and sinks

def q_bronze_parse(spark, sf_dir):
    return parse_messages(to_messages(bronze(spark, sf_dir)))


def q_bronze_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    tables.write_table(bronze(spark, sf_dir), path)
    return tables.read_table(spark, path, schema=EVENT)


def q_stream_bronze(spark, sf_dir):
    src = write_message_files(bronze(spark, sf_dir), scratch_path(spark, "messages"))
    out = run_bronze_stream(spark, src, scratch_path(spark, "bronze-stream"),
                            scratch_path(spark, "bronze-stream-ckpt"), source_format="text")
    return out


# ---------------------------------------------------------------- streams with state

CHUNKS = 3  # parts of the time range that are delivered one after the other, with a restart between them


def _delivered(spark: SparkSession, sf_dir: str, held_back: bool = False) -> DataFrame:
    """Silver edges as Bronze rows with ``chunk``, the delivery that brings them: their third of the
    time range, or with ``held_back`` the last for one minute in ten."""
    e = edges_df(spark, sf_dir)
    second = F.unix_timestamp("event_time")
    low, high = e.agg(F.min(second), F.max(second)).first()  # one row
    chunk = F.least(F.lit(CHUNKS - 1), F.floor((second - F.lit(low or 0)) * CHUNKS / F.lit(max(1, (high or 0) - (low or 0)))))
    if held_back:
        chunk = F.when(F.minute("event_time") % 10 == 7, CHUNKS - 1).otherwise(chunk)
    return e.select("user_from", "user_to", "action", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                    chunk.cast("int").alias("chunk"))


def _run_in_chunks(spark: SparkSession, rows: DataFrame, start: Callable) -> None:
    """Deliver the chunks; after each, ``start(source path)`` goes on from the checkpoint and ends."""
    root = scratch_path(spark, "messages")
    for c in range(CHUNKS):
        write_message_files(rows.where(F.col("chunk") == c).drop("chunk"), f"{root}/part{c}")
        start(f"{root}/*").awaitTermination()


def _windows(spark: SparkSession, sf_dir: str, aggregate: Callable, held_back: bool = False) -> tuple[str, str]:
    """(sink, checkpoint) of a windowed stream over all deliveries."""
    sink, ckpt = scratch_path(spark, "windows"), scratch_path(spark, "windows-ckpt")
    _run_in_chunks(spark, _delivered(spark, sf_dir, held_back), lambda src: windows.start_windows(
        spark, aggregate, src, sink, ckpt, available_now=True))
    return sink, ckpt


def _hourly_windows(spark, sf_dir):
    return _memo(spark, sf_dir, "hourly-windows", lambda: _windows(
        spark, sf_dir, lambda e: windows.counts(e, F.window(windows.TIME, "1 hour")), held_back=True))


def q_stream_hourly_windows(spark, sf_dir):
    """Tumbling hours, closed and open, after deliveries some of whose rows were late."""
    return windows.live_windows(spark, *_hourly_windows(spark, sf_dir)).select(
        "window_start", "window_end", "action", "events", "closed")


def q_stream_late_rows(spark, sf_dir):
    """Rows delivered, rows in a window, rows that were late."""
    counted = windows.live_windows(spark, *_hourly_windows(spark, sf_dir)).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("in_windows"))
    rows = edges_df(spark, sf_dir).agg(F.count(F.lit(1)).alias("delivered"))
    return rows.crossJoin(counted).select("delivered", "in_windows", (F.col("delivered") - F.col("in_windows")).alias("late"))  # one row each


def q_stream_sliding_windows(spark, sf_dir):
    """Days that begin every six hours; the closed ones."""
    sink, _ = _windows(spark, sf_dir, lambda e: windows.counts(e, F.window(windows.TIME, "1 day", "6 hours")))
    return spark.read.parquet(sink).select("window_start", "window_end", "action", "events")


def q_stream_session_windows(spark, sf_dir):
    """Each user's sessions (no gap of six hours); the closed ones."""
    sink, _ = _windows(spark, sf_dir, lambda e: windows.counts(
        e, F.session_window(windows.TIME, "6 hours"), keys=("user_from",)))
    return spark.read.parquet(sink).select("window_start", "window_end", "user_from", "events")


def q_stream_daily_active(spark, sf_dir):
    """Interactions and active users of the closed days."""
    sink, _ = _windows(spark, sf_dir, windows.active_users)
    return spark.read.parquet(sink).select("window_start", "window_end", "interactions", "active_users")


def q_stream_silver(spark, sf_dir):
    """Silver from the stream; each delivery but the first repeats rows of the one before it."""
    raw = bronze(spark, sf_dir)
    at = F.to_date("timestamp")
    low, high = raw.agg(F.min(at), F.max(at)).first()  # one row
    day = F.datediff(at, F.lit(low))
    chunk = F.floor(day * CHUNKS / ((high - low).days + 1 if low else 1)).cast("int")
    rows = materialize(raw.withColumn("chunk", chunk), "bronze-chunks")
    again = rows.where((F.col("chunk") < CHUNKS - 1) & (F.dayofmonth("timestamp") % 2 == 0)).withColumn("chunk", F.col("chunk") + 1)
    sink, ckpt = scratch_path(spark, "silver-stream"), scratch_path(spark, "silver-stream-ckpt")
    _run_in_chunks(spark, rows.unionByName(again), lambda src: silver_streaming.start_silver(
        spark, src, sink, ckpt, available_now=True))
    return silver_streaming.read_silver(spark, sink)


def q_stream_counters(spark, sf_dir):
    """Rows in, rejected and written, summed over the stream's batches (as the listener stored
    them), beside the rows of the Bronze table."""
    path, sink, ckpt = (scratch_path(spark, n) for n in ("counters", "counted-bronze", "counted-ckpt"))
    listener = counters.CounterListener(spark, path, "counted")
    spark.streams.addListener(listener)

    def start(src):
        q = start_bronze(spark, "text", sink, ckpt, source_path=src, available_now=True, transform=counters.observed, name="counted")
        q.awaitTermination()
        listener.ended.wait(60)
        return q

    try:
        _run_in_chunks(spark, _damaged(_delivered(spark, sf_dir)), start)
    finally:
        spark.streams.removeListener(listener)
    sums = counters.read_counters(spark, path).agg(*[F.sum(m).alias(m) for m in counters.METRICS])
    table = spark.read.schema(EVENT).parquet(sink).agg(F.count(F.lit(1)).alias("bronze_rows"))
    return sums.crossJoin(table)  # one row each


def q_stream_compacted(spark, sf_dir):
    """Bronze of a stream that was compacted between its deliveries."""
    root, ckpt = scratch_path(spark, "compacted"), scratch_path(spark, "compacted-ckpt")

    def start(src):
        q = start_bronze(spark, "text", root, ckpt, source_path=src, available_now=True,
                         batch_writer=idempotent_batch_writer(compaction.data_path(root)))
        q.awaitTermination()
        compaction.compact(spark, root, ckpt, EVENT)
        return q

    _run_in_chunks(spark, _delivered(spark, sf_dir), start)
    return compaction.read_batches(spark, root, EVENT)


# ---------------------------------------------------------------- increments and rejects

def _damaged(rows: DataFrame) -> DataFrame:
    """Bronze rows, those of one minute in thirty without any value."""
    bad = F.minute("timestamp") % 30 == 13
    return rows.select(*[F.when(~bad, F.col(c)).alias(c) if c in EVENT.fieldNames() else F.col(c) for c in rows.columns])


def q_quarantine_messages(spark, sf_dir):
    """Messages by what became of them: one minute in thirty is cut, one an array, one null, one without fields."""
    minute = F.minute("timestamp") % 30
    text = F.to_json(F.struct(*EVENT.fieldNames()))
    sent = bronze(spark, sf_dir).select(
        F.when(minute == 3, F.substring(text, 1, 20)).when(minute == 4, F.concat(F.lit("["), text, F.lit("]")))
        .when(minute == 6, F.lit('{"x":1}')).when(minute != 5, text).cast("binary").alias("value"))
    checked = materialize(quarantine.checked_messages(sent), "checked")
    good = F.col("reason").isNull()
    return checked.groupBy(F.coalesce("reason", F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(good & F.col("user_from").isNotNull()).alias("with_user"),
        F.count("raw").alias("with_text"))


def q_quarantine_csv(spark, sf_dir):
    """Edge CSV with misfit lines (one minute in thirty has a field too many, one a bad time): the good
    rows, and each bad line as it was."""
    path = scratch_path(spark, "misfit-csv")
    minute = F.minute("event_time") % 30
    e = edges_df(spark, sf_dir)
    quoted = [F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in e.columns]
    time = F.when(minute == 9, F.lit('"noon"')).otherwise(F.concat(F.lit('"'), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), F.lit('"')))
    line = F.concat_ws(",", *quoted[:3], time, *quoted[4:], F.when(minute == 8, F.lit('"more"')))
    tables.write_lines_csv(e.select(line.alias("value")), ",".join(e.columns), path)
    good, bad = quarantine.read_edges_csv_checked(spark, path)
    return good.select("user_from", "user_to", "action", "event_time", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.lit(None).cast("string").alias("user_from"), F.lit(None).cast("string").alias("user_to"),
                   F.regexp_extract("raw", '"(LIKE|SHARE|COMMENT|[A-Z_]+)"', 1).alias("action"),
                   F.lit(None).cast("timestamp").alias("event_time"), "reason"))


def q_silver_incremental(spark, sf_dir):
    """Silver of the first half of the days, then of all but the last two, then those two, the last one twice."""
    path = scratch_path(spark, "silver-days")
    raw = materialize(bronze(spark, sf_dir).withColumn("day", F.substring("timestamp", 1, 10)), "bronze-days")
    days = [r.day for r in raw.select("day").where("day is not null").distinct().orderBy("day").collect()]  # one row a day
    half = days[:len(days) // 2]
    increments.write_silver(raw.where(F.col("day").isin(half)).drop("day"), path)
    for some in (days[len(half):-2], days[-2:], days[-1:]):
        increments.refresh_silver(raw.where(F.col("day").isin(some)).drop("day"), path, some)
    return increments.read_silver(spark, path)


def _graph_store(spark, sf_dir):
    def build():
        store = increments.GraphStore(spark, scratch_path(spark, "graph-store"))
        e = edges_df(spark, sf_dir)
        at = F.unix_timestamp("event_time")
        low, high = e.agg(F.min(at), F.max(at)).first()  # one row
        load = F.least(F.lit(4), F.floor((at - F.lit(low or 0)) * 5 / F.lit(max(1, (high or 0) - (low or 0)))))
        for n in range(5):
            store.append(e.where(load == n), n)
            if n == 2:
                store.merge()
        return store
    return _memo(spark, sf_dir, "graph-store", build)


def q_graph_incremental(spark, sf_dir):
    """The weighted projection after five loads."""
    g = _graph_store(spark, sf_dir).graph()
    return g.user_names(g.user_names(g.projection, "src", "source"), "dst", "target").select("source", "target", "w")


def q_silver_clean(spark, sf_dir):
    return silver.clean(bronze(spark, sf_dir)).select("user_from", "user_to", "action", "timestamp", "event_time",
                                           "event_date", "event_hour")


def q_silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    df = silver.clean(bronze(spark, sf_dir))
    tables.write_table(df, path)
    tables.write_table(df, path)  # full refresh twice: the re-run is idempotent
    return tables.read_table(spark, path).select(*df.columns)


def q_gold_edges(spark, sf_dir):
    return edges_df(spark, sf_dir)


def q_gold_edges_csv(spark, sf_dir):
    path = scratch_path(spark, "gold-edges-csv")
    tables.write_edges_csv(edges_df(spark, sf_dir), path)
    return tables.read_edges_csv(spark, path)


def q_metrics_with_defaults(spark, sf_dir):
    path = scratch_path(spark, "metrics-csv")
    tables.write_metrics_csv(metrics_fixed(spark, sf_dir).select("user", "pagerank"), path)
    return tables.read_metrics_csv(spark, path)


def q_resolve_time_col(spark, sf_dir):
    return resolve_time_column(edges_df(spark, sf_dir)).select("user_from", "user_to", "action", "timestamp")


def q_calendar_columns(spark, sf_dir):
    return (calendar_columns(resolve_time_column(edges_df(spark, sf_dir)))
            .select("user_from", "user_to", "action", "timestamp", "date", "hour", "day_name", "weekday"))


def q_stage_counts(spark, sf_dir):
    """Rows of every layer, observed on one write of the last."""
    n = F.count(F.lit(1)).alias("n")
    seen = {stage: observation(stage) for stage in ("bronze", "silver", "gold")}
    rows = silver.clean(bronze(spark, sf_dir).observe(seen["bronze"], n)).observe(seen["silver"], n)
    materialize(gold.edges(rows).observe(seen["gold"], n), "gold")
    return spark.createDataFrame([(stage, int(o.get["n"])) for stage, o in seen.items()], "stage string, rows long")


def q_gold_preview(spark, sf_dir):
    return edges_df(spark, sf_dir).orderBy("user_from", "user_to", "event_time", "action").limit(5)


def q_graph_vertices(spark, sf_dir):
    return graph_of(spark, sf_dir).vertices.select("user", "vid")


def q_graph_edges(spark, sf_dir):
    return graph_of(spark, sf_dir).edges.select("user_from", "user_to", "action", "event_time", "src", "dst")


def q_graph_projection(spark, sf_dir):
    return graph_of(spark, sf_dir).projection.select("src", "dst", "w")


def q_dq_unique_users(spark, sf_dir):
    """Uniqueness of the user key, on the raw ends of all events (with repeats and nulls)
    beside the vertex table."""
    ends = bronze(spark, sf_dir).select(F.explode(F.array("user_from", "user_to")).alias("user"))
    raw = ends.groupBy("user").agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum("c").alias("mentions"), F.count("user").alias("distinct_ids"),
        F.count_if((F.col("c") > 1) & F.col("user").isNotNull()).alias("repeated_ids"))
    keys = graph_of(spark, sf_dir).vertices.groupBy("user").agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum("c").alias("vertices"), F.count_if(F.col("c") > 1).alias("duplicated_vertices"))
    return raw.crossJoin(F.broadcast(keys))  # one row each


def q_user_list(spark, sf_dir):
    return graph_of(spark, sf_dir).vertices.select("user").orderBy("user")


def q_edge_export(spark, sf_dir):
    return rankings.edge_export(edges_df(spark, sf_dir))


def q_pattern_one_hop(spark, sf_dir):
    return rankings.one_hop(edges_df(spark, sf_dir), metrics_fixed(spark, sf_dir))


def q_pattern_has_community(spark, sf_dir):
    return rankings.one_hop(edges_df(spark, sf_dir), metrics_fixed(spark, sf_dir), with_community=True)


def q_top_influencer_subgraph(spark, sf_dir):
    scores, _ = _pagerank(spark, sf_dir)
    sub = undirected_pattern(graph_of(spark, sf_dir), scores, "pagerank", INFLUENCER_MIN)
    return sub.select("u", F.round("u_pagerank", R).alias("u_pagerank"), "action", "event_time",
                      "u2", F.round("u2_pagerank", R).alias("u2_pagerank"))


# ---------------------------------------------------------------- activity

def _edges_q(fn):
    return lambda spark, sf_dir: fn(edges_df(spark, sf_dir))


def q_hourly_mean(spark, sf_dir):
    return activity.hourly_mean(edges_df(spark, sf_dir)).select(
        "hour", F.round("mean_events", R).alias("mean_events"), "n_dates")


def q_action_date_pivot(spark, sf_dir):
    return activity.action_date_pivot(edges_df(spark, sf_dir), PIVOT_DATES)


def q_top_out(spark, sf_dir):
    e = edges_df(spark, sf_dir)
    return (e.groupBy(F.col("user_from").alias("user")).agg(F.count(F.lit(1)).alias("interactions_out"))
            .orderBy(F.desc("interactions_out"), "user").limit(10))


def q_top_in(spark, sf_dir):
    e = edges_df(spark, sf_dir)
    return (e.groupBy(F.col("user_to").alias("user")).agg(F.count(F.lit(1)).alias("interactions_in"))
            .orderBy(F.desc("interactions_in"), "user").limit(10))


def q_degrees(spark, sf_dir):
    return (degrees(graph_of(spark, sf_dir)).orderBy(F.desc("total_degree"), "user").limit(20)
            .select("user", "out_degree", "in_degree", "total_degree"))


def q_graph_counts(spark, sf_dir):
    return graph_counts(graph_of(spark, sf_dir))


def q_graph_stats(spark, sf_dir):
    s = graph_stats(graph_of(spark, sf_dir))
    return s.select("nodes", "edges", F.round("density", R).alias("density"),
                    F.round("mean_degree", R).alias("mean_degree"))


def q_ego_network(spark, sf_dir):
    return paths.ego_network(edges_df(spark, sf_dir), CENTER)


# ---------------------------------------------------------------- graph algorithms

def q_pagerank(spark, sf_dir):
    g = graph_of(spark, sf_dir)
    scores, _ = _pagerank(spark, sf_dir)
    return g.user_names(scores).select("user", F.round("pagerank", R).alias("pagerank"))


def q_pagerank_summary(spark, sf_dir):
    _, s = _pagerank(spark, sf_dir)
    return graph_of(spark, sf_dir).vertices.agg(
        F.count(F.lit(1)).alias("node_properties_written"), F.lit(s["ran_iterations"]).alias("ran_iterations"))


def q_top_influencers(spark, sf_dir):
    return rankings.top_by(pagerank_users(spark, sf_dir), "pagerank", 10)


def q_betweenness(spark, sf_dir):
    g = graph_of(spark, sf_dir)
    scores, _ = _betweenness(spark, sf_dir)
    return g.user_names(scores).select("user", F.round("betweenness", R).alias("betweenness"))


def q_top_n_betweenness(spark, sf_dir):
    return rankings.top_by(metrics_real(spark, sf_dir), "betweenness", TOP_N, ["betweenness", "pagerank"])


def q_closeness(spark, sf_dir):
    c = paths.closeness(graph_of(spark, sf_dir))
    return c.select("user", F.round("closeness", R).alias("closeness"))


def q_shortest_path(spark, sf_dir):
    return paths.shortest_path(graph_of(spark, sf_dir), CENTER, PATH_TO)


def q_triangle_count(spark, sf_dir):
    return triangles.triangle_count(graph_of(spark, sf_dir)).select("user", "triangle_count")


def q_label_propagation(spark, sf_dir):
    g = graph_of(spark, sf_dir)
    labels, _ = _lpa(spark, sf_dir)
    return (g.user_names(labels).select("user", F.col("label").alias("community_lp"))
            .orderBy("community_lp", "user"))


def q_lpa_summary(spark, sf_dir):
    labels, s = _lpa(spark, sf_dir)
    return labels.agg(F.lit(s["ran_iterations"]).alias("ran_iterations"),
                      F.countDistinct("label").alias("community_count"))


def louvain_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, community_louvain), ordered by community. SQL cannot restate the labels;
    the registered queries return facts about them that it can."""
    labels, _ = _louvain(spark, sf_dir)
    return (graph_of(spark, sf_dir).user_names(labels).select("user", F.col("community").alias("community_louvain"))
            .orderBy("community_louvain", "user"))


def q_louvain(spark, sf_dir):
    """Facts about the labelling: users labelled, labels that are not the smallest member
    of their community, vertices without a label, labels of what is no vertex."""
    labels, _ = _louvain(spark, sf_dir)
    low = labels.groupBy("community").agg(F.min("vid").alias("low"), F.count(F.lit(1)).alias("size"))
    facts = low.agg(F.sum("size").alias("users_labelled"),
                    F.count_if(F.col("low") != F.col("community")).alias("label_violations"))
    known = graph_of(spark, sf_dir).vertices.select(F.col("vid"), F.lit(1).alias("vertex"))
    both = known.join(labels.select("vid", F.lit(1).alias("label")), "vid", "full")
    left_over = both.agg(F.count_if(F.col("label").isNull()).alias("vertices_without_label"),
                         F.count_if(F.col("vertex").isNull()).alias("labels_without_vertex"))
    return facts.crossJoin(left_over)  # one row each


def q_louvain_summary(spark, sf_dir):
    """Facts about the run: it converged, the reported modularity is the one recomputed
    from the labels, above that of single users and of label propagation."""
    g = graph_of(spark, sf_dir)
    labels, s = _louvain(spark, sf_dir)
    lpa, _ = _lpa(spark, sf_dir)
    sym = communities.undirected(g.projection)
    single = g.vertices.select("vid", F.col("vid").alias("c"))

    def q(lab, name):
        return communities.modularity_of(sym, lab).select(F.col("modularity").alias(name))

    row = (q(labels.select("vid", F.col("community").alias("c")), "q")
           .crossJoin(q(single, "q_single")).crossJoin(q(lpa.select("vid", F.col("label").alias("c")), "q_lpa")))  # one row each
    qs = s["modularities"]
    return row.select(F.lit(s["converged"]).alias("converged"),
                      (F.abs(F.col("q") - F.lit(float(s["modularity"]))) < 1e-9).alias("reported_is_recomputed"),
                      (F.col("q") > F.col("q_single")).alias("above_single_users"),
                      (F.col("q") >= F.col("q_lpa") - 1e-9).alias("not_below_label_propagation"),
                      F.lit(qs == sorted(qs)).alias("levels_rise"),
                      F.round("q_single", R).alias("single_user_modularity"))


def q_modularity(spark, sf_dir):
    g = graph_of(spark, sf_dir)
    q = communities.partition_modularity(g, metrics_fixed(spark, sf_dir))
    return q.select(F.round("modularity", R).alias("modularity"))


def q_louvain_community_stats(spark, sf_dir):
    """Totals over Louvain's communities, which no labelling changes."""
    g = graph_of(spark, sf_dir)
    pr, _ = _pagerank(spark, sf_dir)
    labels, _ = _louvain(spark, sf_dir)
    m = rankings.user_metrics(g, pr, None, labels.select("vid", F.col("community").alias("community_louvain")))
    stats = rankings.community_stats(m.withColumn("betweenness", F.lit(0.0)))
    missing = m.agg(F.count_if(F.col("community_louvain").isNull()).alias("users_without_community"))
    return stats.agg(F.sum("size").alias("users"), F.round(F.sum("sum_pagerank"), 3).alias("sum_pagerank")).crossJoin(missing)  # one row each


def q_user_metrics_export(spark, sf_dir):
    """Written as CSV and read back."""
    path = scratch_path(spark, "user-metrics-csv")
    tables.write_metrics_csv(rankings.export_metrics(metrics_real(spark, sf_dir)), path)
    return tables.read_metrics_csv(spark, path).select(
        "user", F.round("pagerank", R).alias("pagerank"), F.round("betweenness", R).alias("betweenness"), "community_louvain")


def q_node_export(spark, sf_dir):
    return rankings.node_export(metrics_real(spark, sf_dir))


# ---------------------------------------------------------------- metrics-based

def _real(fn):
    return lambda spark, sf_dir: fn(metrics_real(spark, sf_dir))


def _fixed(fn):
    return lambda spark, sf_dir: fn(metrics_fixed(spark, sf_dir))


def q_user_rank(spark, sf_dir):
    return rankings.user_rank(pagerank_users(spark, sf_dir))


def q_top_n_stats(spark, sf_dir):
    return rankings.top_n_stats(pagerank_users(spark, sf_dir), "pagerank", TOP_N)


def q_community_top10(spark, sf_dir):
    return rankings.community_top_members(metrics_fixed(spark, sf_dir), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks / layers
    "bronze_parse": q_bronze_parse,
    "bronze_scan": q_bronze_scan,
    "stream_bronze": q_stream_bronze,
    "stream_hourly_windows": q_stream_hourly_windows,
    "stream_late_rows": q_stream_late_rows,
    "stream_sliding_windows": q_stream_sliding_windows,
    "stream_session_windows": q_stream_session_windows,
    "stream_daily_active": q_stream_daily_active,
    "stream_silver": q_stream_silver,
    "stream_counters": q_stream_counters,
    "stream_compacted": q_stream_compacted,
    "quarantine_messages": q_quarantine_messages,
    "quarantine_csv": q_quarantine_csv,
    "silver_incremental": q_silver_incremental,
    "graph_incremental": q_graph_incremental,
    "silver_clean": q_silver_clean,
    "silver_roundtrip": q_silver_roundtrip,
    "gold_edges": q_gold_edges,
    "gold_edges_csv": q_gold_edges_csv,
    "metrics_with_defaults": q_metrics_with_defaults,
    "resolve_time_col": q_resolve_time_col,
    "calendar_columns": q_calendar_columns,
    "stage_counts": q_stage_counts,
    "gold_preview": q_gold_preview,
    "graph_vertices": q_graph_vertices,
    "graph_edges": q_graph_edges,
    "graph_projection": q_graph_projection,
    "dq_unique_users": q_dq_unique_users,
    "user_list": q_user_list,
    "edge_export": q_edge_export,
    "pattern_one_hop": q_pattern_one_hop,
    "pattern_has_community": q_pattern_has_community,
    "top_influencer_subgraph": q_top_influencer_subgraph,
    # KPI and activity
    "kpi_summary": _edges_q(activity.kpi_summary),
    "action_distribution": _edges_q(activity.action_distribution),
    "daily_volume": _edges_q(activity.daily_volume),
    "hourly_by_date": _edges_q(activity.hourly_by_date),
    "hourly_mean": q_hourly_mean,
    "hourly_volume": _edges_q(activity.hourly_volume),
    "weekday_volume": _edges_q(activity.weekday_volume),
    "daily_active_users": _edges_q(activity.daily_active_users),
    "action_by_date": _edges_q(activity.action_by_date),
    "action_date_pivot": q_action_date_pivot,
    "user_out_edges": lambda s, d: activity.user_out_edges(edges_df(s, d), CENTER),
    "user_in_edges": lambda s, d: activity.user_in_edges(edges_df(s, d), CENTER),
    "user_action_mix": lambda s, d: activity.user_action_mix(edges_df(s, d), CENTER),
    "ego_size": lambda s, d: activity.ego_size(edges_df(s, d), CENTER),
    "top_out": q_top_out,
    "top_in": q_top_in,
    "degrees": q_degrees,
    "graph_counts": q_graph_counts,
    "graph_stats": q_graph_stats,
    "ego_network": q_ego_network,
    # graph algorithms
    "pagerank": q_pagerank,
    "pagerank_summary": q_pagerank_summary,
    "top_influencers": q_top_influencers,
    "betweenness": q_betweenness,
    "top_n_betweenness": q_top_n_betweenness,
    "closeness": q_closeness,
    "shortest_path": q_shortest_path,
    "triangle_count": q_triangle_count,
    "label_propagation": q_label_propagation,
    "lpa_summary": q_lpa_summary,
    "louvain": q_louvain,
    "louvain_summary": q_louvain_summary,
    "modularity": q_modularity,
    # metrics-based
    "influence_score": _real(lambda m: rankings.influence_score(m, TOP_N)),
    "user_rank": q_user_rank,
    "user_profile": _real(lambda m: rankings.user_profile(m, CENTER)),
    "metric_stats": _real(rankings.metric_stats),
    "top_n_stats": q_top_n_stats,
    "metric_coverage": lambda s, d: rankings.metric_coverage(metrics_sparse(s, d)),
    "users_missing_metrics": lambda s, d: rankings.users_missing_metrics(metrics_sparse(s, d)),
    "sparse_metric_stats": lambda s, d: rankings.metric_stats(metrics_sparse(s, d)),
    "sparse_user_rank": lambda s, d: rankings.user_rank(metrics_sparse(s, d)),
    "metric_correlation": _real(rankings.metric_correlation),
    "metric_pairs": _real(rankings.metric_pairs),
    "user_metrics_export": q_user_metrics_export,
    "node_export": q_node_export,
    "louvain_community_stats": q_louvain_community_stats,
    # communities on the fixed metrics view
    "community_stats": _fixed(rankings.community_stats),
    "community_summary": _fixed(rankings.community_summary),
    "community_top15": _fixed(lambda m: rankings.community_top(m, 15)),
    "community_top10": q_community_top10,
    "community_members": _fixed(lambda m: rankings.community_members(m, COMMUNITY)),
}

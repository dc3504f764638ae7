"""DuckDB SQL text of every checked query, over the driver's pre-registered tables.

The SQL restates each query independently: Silver/Gold/graph CTEs, PageRank as
20 unrolled delta steps, breadth-first searches as ``USING KEY`` recursive CTEs
(one row per (source, node), level-synchronous), label propagation as 10
unrolled rounds. Column names match the Spark results exactly.
"""

from __future__ import annotations

from plexus.sources.events_adapter import BRONZE_SQL

DAMPING = 0.85
PR_STEPS = 20
PR_TOL = 1e-7
LPA_ROUNDS = 10

BASE = f"""
bronze AS ({BRONZE_SQL}),
silver AS (
  SELECT user_from, user_to, upper(action) AS action, "timestamp", event_time,
         strftime(event_time, '%Y-%m-%d') AS event_date, strftime(event_time, '%H') AS event_hour
  FROM (SELECT d.*, try_strptime(d."timestamp", '%Y-%m-%d %H:%M:%S') AS event_time
        FROM (SELECT DISTINCT user_from, user_to, action, "timestamp" FROM bronze) d) x
  WHERE user_from IS NOT NULL AND user_to IS NOT NULL AND action IS NOT NULL AND event_time IS NOT NULL
),
edges AS (SELECT user_from, user_to, action, event_time, event_date, event_hour FROM silver),
vertices AS (
  SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS BIGINT) AS vid
  FROM (SELECT user_from AS "user" FROM edges UNION SELECT user_to FROM edges) u
),
proj AS (SELECT user_from AS src, user_to AS dst, count(*) AS w FROM edges GROUP BY user_from, user_to),
deg AS (
  SELECT v."user", v.vid, coalesce(o.c, 0) AS out_degree, coalesce(i.c, 0) AS in_degree,
         coalesce(o.c, 0) + coalesce(i.c, 0) AS total_degree
  FROM vertices v
  LEFT JOIN (SELECT user_from AS u, count(*) AS c FROM edges GROUP BY user_from) o ON o.u = v."user"
  LEFT JOIN (SELECT user_to AS u, count(*) AS c FROM edges GROUP BY user_to) i ON i.u = v."user"
),
mfix AS (
  SELECT "user", out_degree / CAST((SELECT count(*) FROM edges) AS DOUBLE) AS pagerank,
         CAST(in_degree AS DOUBLE) AS betweenness,
         TRY_CAST(regexp_extract("user", '(\\d+)$', 1) AS BIGINT) % 7 - 1 AS community_louvain
  FROM deg
),
timeline AS (
  SELECT *, event_time AS "timestamp", CAST(event_time AS DATE) AS date, hour(event_time) AS hour,
         strftime(event_time, '%A') AS day_name, isodow(event_time) - 1 AS weekday
  FROM edges WHERE event_time IS NOT NULL
)"""


def _pagerank_ctes() -> str:
    steps = [f"""
pr_t AS MATERIALIZED (
  SELECT p.src, p.dst, p.w / CAST(o.outdeg AS DOUBLE) AS c
  FROM proj p JOIN (SELECT src, sum(w) AS outdeg FROM proj GROUP BY src) o USING (src)
),
pr0 AS MATERIALIZED (SELECT "user" AS u, CAST({1 - DAMPING} AS DOUBLE) AS p, CAST({1 - DAMPING} AS DOUBLE) AS d FROM vertices)"""]
    for k in range(1, PR_STEPS + 1):
        steps.append(f"""
pr{k} AS MATERIALIZED (
  SELECT v.u, v.p + {DAMPING} * coalesce(m.m, 0.0) AS p, {DAMPING} * coalesce(m.m, 0.0) AS d
  FROM pr{k - 1} v LEFT JOIN (
    SELECT t.dst, sum(a.d * t.c) AS m FROM pr_t t JOIN pr{k - 1} a ON a.u = t.src AND a.d > {PR_TOL}
    GROUP BY t.dst) m ON m.dst = v.u
)""")
    steps.append(f"""
pagerank AS (SELECT u AS "user", p AS pagerank FROM pr{PR_STEPS})""")
    return ",".join(steps)


BFS = """
bfs(s, v, d, sigma) USING KEY (s, v) AS (
  SELECT "user", "user", 0, CAST(1.0 AS DOUBLE) FROM vertices
  UNION
  SELECT f.s, p.dst, max(f.d) + 1, sum(f.sigma * p.w)
  FROM bfs f JOIN proj p ON p.src = f.v
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.s = f.s AND r.v = p.dst)
  GROUP BY f.s, p.dst
)"""

BETWEENNESS = """
bc AS (
  SELECT a.v AS "user", sum(a.sigma * b.sigma / c.sigma) AS b
  FROM bfs a JOIN bfs b ON b.s = a.v JOIN bfs c ON c.s = a.s AND c.v = b.v
  WHERE a.s <> a.v AND b.v <> a.v AND a.s <> b.v AND a.d + b.d = c.d
  GROUP BY a.v
),
betweenness AS (
  SELECT v."user", coalesce(bc.b, 0.0) AS betweenness FROM vertices v LEFT JOIN bc ON bc."user" = v."user"
)"""

METRICS_REAL = """
mreal AS (
  SELECT v."user", pr.pagerank, bt.betweenness, lp.label AS community_louvain
  FROM vertices v JOIN pagerank pr ON pr."user" = v."user" JOIN betweenness bt ON bt."user" = v."user"
  JOIN lp10 lp ON lp.vid = v.vid
)"""


def _lpa_ctes() -> str:
    parts = ["""
sym AS (
  SELECT src, dst, sum(w) AS w FROM (
    SELECT vs.vid AS src, vd.vid AS dst, p.w FROM proj p
      JOIN vertices vs ON vs."user" = p.src JOIN vertices vd ON vd."user" = p.dst
    UNION ALL
    SELECT vd.vid, vs.vid, p.w FROM proj p
      JOIN vertices vs ON vs."user" = p.src JOIN vertices vd ON vd."user" = p.dst) x
  WHERE src <> dst GROUP BY src, dst
),
lp0 AS MATERIALIZED (SELECT vid, vid AS label FROM vertices)"""]
    for k in range(1, LPA_ROUNDS + 1):
        parts.append(f"""
lp{k} AS MATERIALIZED (
  SELECT l.vid, coalesce(b.label, l.label) AS label,
         b.label IS NOT NULL AND b.label <> l.label AS changed
  FROM lp{k - 1} l LEFT JOIN (
    SELECT src, label FROM (
      SELECT src, label, row_number() OVER (PARTITION BY src ORDER BY score DESC, label ASC) AS rn
      FROM (SELECT s.src, n.label, sum(s.w) AS score FROM sym s JOIN lp{k - 1} n ON n.vid = s.dst
            GROUP BY s.src, n.label) sc) r
    WHERE rn = 1) b ON b.src = l.vid
)""")
    return ",".join(parts)


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


def q(select: str, *extra: str) -> str:
    return _with(BASE, *extra) + "\n" + select


def q_pr(select: str) -> str:
    return q(select, _pagerank_ctes())


def q_real(select: str) -> str:
    return q(select, _pagerank_ctes(), BFS, BETWEENNESS, _lpa_ctes(), METRICS_REAL)


R = 6  # display rounding, same as the Spark side

# The days of the driver's events table (fixed: one column a day in the pivot).
PIVOT_DATES = [f"2024-01-{d:02d}" for d in range(1, 31)]

CENTER = "user1"
PATH_TO = "user10"
COMMUNITY = 0
TOP_N = 20
INFLUENCER_MIN = 0.01  # pagerank threshold at both ends of the influencer pattern

BRONZE_COLS = 'SELECT user_from, user_to, action, "timestamp" FROM bronze'
SILVER_COLS = ('SELECT user_from, user_to, action, "timestamp", event_time, event_date, event_hour '
               'FROM silver')
EDGE_COLS = "SELECT user_from, user_to, action, event_time, event_date, event_hour FROM edges"


def _community_stats(src: str) -> str:
    return f"""SELECT community_louvain AS community, count("user") AS size,
  round(avg(pagerank), {R}) AS avg_pagerank, round(sum(pagerank), {R}) AS sum_pagerank,
  round(avg(betweenness), {R}) AS avg_betweenness
FROM {src} WHERE community_louvain >= 0 GROUP BY community_louvain"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    # ---- sources, sinks, layers
    o["bronze_parse"] = q(BRONZE_COLS)
    o["bronze_scan"] = q(BRONZE_COLS)
    o["stream_bronze"] = q(BRONZE_COLS)
    o["silver_clean"] = q(SILVER_COLS)
    o["silver_roundtrip"] = q(SILVER_COLS)
    o["stream_silver"] = q(SILVER_COLS)
    o["silver_incremental"] = q(SILVER_COLS)
    o["graph_incremental"] = q("SELECT src AS source, dst AS target, w FROM proj")
    o["stream_compacted"] = q("SELECT user_from, user_to, action, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" FROM edges")
    o["stream_counters"] = q("""SELECT count(*) AS rows_in, count(*) FILTER (WHERE minute(event_time) % 30 = 13) AS rejected,
  count(*) FILTER (WHERE minute(event_time) % 30 <> 13) AS written, count(*) AS bronze_rows FROM edges""")
    live = """
bounds AS (SELECT min(epoch(event_time))::BIGINT AS low, max(epoch(event_time))::BIGINT AS high FROM edges),
sent AS (SELECT e.*, CASE WHEN {held} THEN 2 ELSE least(2, (epoch(event_time)::BIGINT - low) * 3 // greatest(1, high - low)) END AS chunk
  FROM edges e, bounds),
mark AS (SELECT max(event_time) - INTERVAL 1 DAY AS final, max(event_time) FILTER (WHERE chunk < 2) - INTERVAL 1 DAY AS before_last FROM sent)"""
    plain, held = live.format(held="false"), live.format(held="minute(event_time) % 10 = 7")
    hours = """
hours AS (SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, action
  FROM sent, mark WHERE chunk < 2 OR date_trunc('hour', event_time) + INTERVAL 1 HOUR > before_last)"""
    o["stream_hourly_windows"] = q("""SELECT window_start, window_end, action, count(*) AS events, bool_and(window_end <= final) AS closed
FROM hours, mark GROUP BY 1, 2, 3""", held, hours)
    o["stream_late_rows"] = q("""SELECT (SELECT count(*) FROM edges) AS delivered, count(*) AS in_windows,
  (SELECT count(*) FROM edges) - count(*) AS late FROM hours""", held, hours)
    o["stream_sliding_windows"] = q("""SELECT s - to_hours(6 * i) AS window_start, s - to_hours(6 * i) + INTERVAL 1 DAY AS window_end,
  action, count(*) AS events
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, event_time) AS s FROM edges), range(4) r(i), mark
WHERE s - to_hours(6 * i) + INTERVAL 1 DAY <= final GROUP BY 1, 2, 3""", plain)
    o["stream_session_windows"] = q("""SELECT min(event_time) AS window_start, max(event_time) + INTERVAL 6 HOUR AS window_end, user_from,
  count(*) AS events FROM (
    SELECT *, sum(CASE WHEN event_time < before + INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (
      PARTITION BY user_from ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS session
    FROM (SELECT *, lag(event_time) OVER (PARTITION BY user_from ORDER BY event_time) AS before FROM edges)), mark
GROUP BY user_from, session, final HAVING max(event_time) + INTERVAL 6 HOUR <= final""", plain)
    o["stream_daily_active"] = q("""SELECT date_trunc('day', event_time) AS window_start, date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end,
  count(action) AS interactions, count(DISTINCT user_from) AS active_users
FROM edges, mark WHERE date_trunc('day', event_time) + INTERVAL 1 DAY <= final GROUP BY 1, 2""", plain)
    o["quarantine_messages"] = q("""SELECT CASE minute(CAST("timestamp" AS TIMESTAMP)) % 30 WHEN 3 THEN 'not a JSON object' WHEN 4 THEN 'not a JSON object'
    WHEN 5 THEN 'null message' WHEN 6 THEN 'no known field' ELSE 'good' END AS outcome, count(*) AS rows,
  count(*) FILTER (WHERE user_from IS NOT NULL AND minute(CAST("timestamp" AS TIMESTAMP)) % 30 NOT IN (3, 4, 5, 6)) AS with_user,
  count(*) FILTER (WHERE minute(CAST("timestamp" AS TIMESTAMP)) % 30 <> 5) AS with_text FROM bronze GROUP BY 1""")
    o["quarantine_csv"] = q("""SELECT CASE WHEN good THEN user_from END AS user_from, CASE WHEN good THEN user_to END AS user_to, action,
  CASE WHEN good THEN event_time END AS event_time, CASE WHEN NOT good THEN 'does not fit the schema' END AS reason
FROM (SELECT *, minute(event_time) % 30 NOT IN (8, 9) AS good FROM edges)""")
    o["gold_edges"] = q(EDGE_COLS)
    o["gold_edges_csv"] = q(EDGE_COLS)
    o["resolve_time_col"] = q('SELECT user_from, user_to, action, "timestamp" FROM timeline')
    o["calendar_columns"] = q('SELECT user_from, user_to, action, "timestamp", date, hour, day_name, weekday '
                              'FROM timeline')
    o["stage_counts"] = q("""SELECT 'bronze' AS stage, count(*) AS "rows" FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM edges""")
    o["metrics_with_defaults"] = q("""SELECT "user", pagerank, CAST(0.0 AS DOUBLE) AS betweenness,
CAST(-1 AS BIGINT) AS community_louvain FROM mfix""")
    o["graph_vertices"] = q('SELECT "user", vid FROM vertices')
    o["graph_edges"] = q("""SELECT e.user_from, e.user_to, e.action, e.event_time, vs.vid AS src, vd.vid AS dst
FROM edges e JOIN vertices vs ON vs."user" = e.user_from JOIN vertices vd ON vd."user" = e.user_to""")
    o["graph_projection"] = q("""SELECT vs.vid AS src, vd.vid AS dst, p.w FROM proj p
JOIN vertices vs ON vs."user" = p.src JOIN vertices vd ON vd."user" = p.dst""")
    o["dq_unique_users"] = q("""
, ends AS (SELECT user_from AS "user" FROM bronze UNION ALL SELECT user_to FROM bronze),
per AS (SELECT "user", count(*) AS c FROM ends GROUP BY "user")
SELECT sum(c)::BIGINT AS mentions, count("user") AS distinct_ids,
  count(*) FILTER (WHERE c > 1 AND "user" IS NOT NULL) AS repeated_ids,
  (SELECT count(*) FROM vertices) AS vertices,
  (SELECT count(*) FROM (SELECT "user" FROM vertices GROUP BY "user" HAVING count(*) > 1) d) AS duplicated_vertices
FROM per""")
    o["gold_preview"] = q(EDGE_COLS + " ORDER BY user_from, user_to, event_time, action LIMIT 5")
    o["user_list"] = q('SELECT "user" FROM vertices')
    o["edge_export"] = q("""SELECT user_from AS source, user_to AS target, action, event_time AS "timestamp"
FROM edges""")
    one_hop = f"""SELECT e.user_from AS u, round(a.pagerank, {R}) AS u_pagerank, round(a.betweenness, {R}) AS u_betweenness,
  a.community_louvain AS u_community, e.action, e.event_time, e.user_to AS u2, round(b.pagerank, {R}) AS u2_pagerank,
  round(b.betweenness, {R}) AS u2_betweenness, b.community_louvain AS u2_community
FROM edges e JOIN mfix a ON a."user" = e.user_from JOIN mfix b ON b."user" = e.user_to"""
    o["pattern_one_hop"] = q(one_hop)
    o["pattern_has_community"] = q(one_hop + " WHERE a.community_louvain >= 0 AND b.community_louvain >= 0")
    o["top_influencer_subgraph"] = q_pr(f"""SELECT x.u, round(pu.pagerank, {R}) AS u_pagerank, x.action,
x.event_time, x.u2, round(pv.pagerank, {R}) AS u2_pagerank
FROM (SELECT user_from AS u, user_to AS u2, action, event_time FROM edges
      UNION ALL
      SELECT user_to, user_from, action, event_time FROM edges WHERE user_from <> user_to) x
JOIN pagerank pu ON pu."user" = x.u JOIN pagerank pv ON pv."user" = x.u2
WHERE pu.pagerank > {INFLUENCER_MIN} AND pv.pagerank > {INFLUENCER_MIN}""")
    # ---- KPI and activity
    o["kpi_summary"] = q("""SELECT count(*) AS total_events,
  count(*) FILTER (WHERE action = 'LIKE') AS likes, count(*) FILTER (WHERE action = 'SHARE') AS shares,
  count(*) FILTER (WHERE action = 'COMMENT') AS comments,
  CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE action IN ('LIKE', 'SHARE')) AS DOUBLE) / count(*)
       ELSE 0.0 END AS engagement_rate,
  CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE action IN ('LIKE', 'SHARE')) AS DOUBLE) / count(*)
       ELSE 0.0 END * 100 AS engagement_pct,
  (SELECT count(*) FROM vertices) AS n_users
FROM edges""")
    o["action_distribution"] = q("SELECT action, count(*) AS count FROM edges GROUP BY action")
    o["daily_volume"] = q('SELECT date, count(action) AS events, count(*) AS "rows" FROM timeline GROUP BY date')
    o["hourly_by_date"] = q("SELECT date, hour, count(action) AS events FROM timeline GROUP BY date, hour")
    o["hourly_mean"] = q(f"""SELECT hour, round(avg(events), {R}) AS mean_events, count(*) AS n_dates FROM
(SELECT date, hour, count(action) AS events FROM timeline GROUP BY date, hour) t GROUP BY hour""")
    o["hourly_volume"] = q("SELECT hour, count(*) AS count FROM timeline GROUP BY hour")
    o["weekday_volume"] = q("SELECT day_name, weekday, count(*) AS count FROM timeline GROUP BY day_name, weekday")
    o["daily_active_users"] = q("""SELECT date, count(action) AS interactions,
count(DISTINCT user_from) AS active_users FROM timeline GROUP BY date""")
    o["action_by_date"] = q("""SELECT action, CAST(event_time AS DATE) AS date, count(*) AS count
FROM edges WHERE event_time IS NOT NULL GROUP BY action, CAST(event_time AS DATE)""")
    o["action_date_pivot"] = q("SELECT action, " + ", ".join(
        f"""count(*) FILTER (WHERE CAST(event_time AS DATE) = DATE '{d}') AS "{d}\"""" for d in PIVOT_DATES)
        + ", count(*) FILTER (WHERE CAST(event_time AS DATE) NOT IN ("
        + ", ".join(f"DATE '{d}'" for d in PIVOT_DATES)
        + ")) AS other FROM edges WHERE event_time IS NOT NULL GROUP BY action")
    o["user_out_edges"] = q(f"""SELECT user_to, action, "timestamp" FROM timeline WHERE user_from = '{CENTER}'""")
    o["user_in_edges"] = q(f"""SELECT user_from, action, "timestamp" FROM timeline WHERE user_to = '{CENTER}'""")
    o["user_action_mix"] = q(f"""SELECT direction, action, count(*) AS count FROM (
  SELECT 'out' AS direction, action FROM edges WHERE user_from = '{CENTER}'
  UNION ALL SELECT 'in', action FROM edges WHERE user_to = '{CENTER}') t GROUP BY direction, action""")
    o["ego_size"] = q(f"""SELECT '{CENTER}' AS "user", count(*) AS ego_size FROM (
  SELECT user_to AS o FROM edges WHERE user_from = '{CENTER}'
  UNION SELECT user_from FROM edges WHERE user_to = '{CENTER}') t""")
    o["top_out"] = q("""SELECT user_from AS "user", count(*) AS interactions_out FROM edges
GROUP BY user_from ORDER BY interactions_out DESC, "user" LIMIT 10""")
    o["top_in"] = q("""SELECT user_to AS "user", count(*) AS interactions_in FROM edges
GROUP BY user_to ORDER BY interactions_in DESC, "user" LIMIT 10""")
    o["degrees"] = q("""SELECT "user", out_degree, in_degree, total_degree FROM deg
ORDER BY total_degree DESC, "user" LIMIT 20""")
    o["graph_counts"] = q("""SELECT (SELECT count(*) FROM vertices) AS total_nodes, count(*) AS total_relationships,
(SELECT count(*) FROM vertices) AS projected_nodes, count(*) AS projected_relationships,
(SELECT count(*) FROM proj) AS distinct_pairs FROM edges""")
    o["graph_stats"] = q(f"""SELECT n AS nodes, m AS edges,
  round(CASE WHEN n > 1 THEN m / (CAST(n AS DOUBLE) * (n - 1)) ELSE 0.0 END, {R}) AS density,
  round(CASE WHEN n > 0 THEN 2 * m / CAST(n AS DOUBLE) END, {R}) AS mean_degree
FROM (SELECT (SELECT count(*) FROM vertices) AS n, (SELECT count(*) FROM proj) AS m) t""")
    o["ego_network"] = q(f"""
, ekey AS (SELECT user_from, user_to, action, event_time,
            row_number() OVER (PARTITION BY user_from, user_to, action, event_time) AS dup_no FROM edges),
ori AS (SELECT user_from AS a, user_to AS b, * FROM ekey
        UNION ALL SELECT user_to, user_from, * FROM ekey WHERE user_from <> user_to)
SELECT '{CENTER}' AS center, 1 AS hops, CAST(NULL AS VARCHAR) AS via, r1.b AS other,
  r1.user_from AS r1_user_from, r1.user_to AS r1_user_to, r1.action AS r1_action, r1.event_time AS r1_event_time,
  CAST(NULL AS VARCHAR) AS r2_user_from, CAST(NULL AS VARCHAR) AS r2_user_to, CAST(NULL AS VARCHAR) AS r2_action,
  CAST(NULL AS TIMESTAMP) AS r2_event_time
FROM ori r1 WHERE r1.a = '{CENTER}'
UNION ALL
SELECT '{CENTER}', 2, r1.b, r2.b, r1.user_from, r1.user_to, r1.action, r1.event_time,
  r2.user_from, r2.user_to, r2.action, r2.event_time
FROM ori r1 JOIN ori r2 ON r2.a = r1.b
WHERE r1.a = '{CENTER}' AND NOT (r1.user_from = r2.user_from AND r1.user_to = r2.user_to
  AND r1.action = r2.action AND r1.event_time = r2.event_time AND r1.dup_no = r2.dup_no)""")
    # ---- graph algorithms
    o["pagerank"] = q_pr(f'SELECT "user", round(pagerank, {R}) AS pagerank FROM pagerank')
    o["pagerank_summary"] = q_pr(
        "SELECT (SELECT count(*) FROM vertices) AS node_properties_written, coalesce(min(k), "
        f"{PR_STEPS}) AS ran_iterations FROM (" + " UNION ALL ".join(
            f"SELECT {k} AS k FROM pr{k} HAVING count(*) FILTER (WHERE d > {PR_TOL}) = 0"
            for k in range(1, PR_STEPS + 1)) + ") s")
    o["top_influencers"] = q_pr(f"""SELECT "user", round(pagerank, {R}) AS pagerank FROM pagerank
ORDER BY pagerank DESC, "user" LIMIT 10""")
    o["betweenness"] = q(f'SELECT "user", round(betweenness, {R}) AS betweenness FROM betweenness', BFS,
                         BETWEENNESS)
    o["top_n_betweenness"] = q_real(f"""SELECT "user", round(betweenness, {R}) AS betweenness,
round(pagerank, {R}) AS pagerank FROM mreal ORDER BY betweenness DESC, "user" LIMIT {TOP_N}""")
    o["closeness"] = q(f"""SELECT v."user", round(CASE WHEN c.far > 0 THEN c.n / CAST(c.far AS DOUBLE)
ELSE 0.0 END, {R}) AS closeness FROM vertices v LEFT JOIN
(SELECT s, count(*) AS n, sum(d) AS far FROM bfs WHERE s <> v GROUP BY s) c ON c.s = v."user" """, BFS)
    o["shortest_path"] = q(f"""
, nb AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM proj UNION ALL SELECT dst, src FROM proj) x),
sp(node, path) USING KEY (node) AS (
  SELECT '{CENTER}', ['{CENTER}']
  UNION
  SELECT n.dst, list_append(min(f.path), n.dst) FROM sp f JOIN nb n ON n.src = f.node
  WHERE NOT EXISTS (SELECT 1 FROM recurring.sp r WHERE r.node = n.dst)
  GROUP BY n.dst
)
SELECT '{CENTER}' AS source, '{PATH_TO}' AS target, CAST(len(path) - 1 AS INTEGER) AS length, path
FROM sp WHERE node = '{PATH_TO}'""")
    o["triangle_count"] = q("""
, und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM proj WHERE src <> dst),
tri AS (SELECT e1.a AS x, e1.b AS y, e2.b AS z FROM und e1 JOIN und e2 ON e2.a = e1.b
        JOIN und e3 ON e3.a = e1.a AND e3.b = e2.b),
corner AS (SELECT x AS u FROM tri UNION ALL SELECT y FROM tri UNION ALL SELECT z FROM tri)
SELECT v."user", coalesce(c.n, 0) AS triangle_count FROM vertices v
LEFT JOIN (SELECT u, count(*) AS n FROM corner GROUP BY u) c ON c.u = v."user" """)
    o["label_propagation"] = q(f"""SELECT v."user", l.label AS community_lp
FROM lp{LPA_ROUNDS} l JOIN vertices v ON v.vid = l.vid""", _lpa_ctes())
    o["lpa_summary"] = q(
        f"SELECT coalesce(min(k), {LPA_ROUNDS}) AS ran_iterations, (SELECT count(DISTINCT label) FROM "
        f"lp{LPA_ROUNDS}) AS community_count FROM (" + " UNION ALL ".join(
            f"SELECT {k} AS k FROM lp{k} HAVING count(*) FILTER (WHERE changed) = 0"
            for k in range(1, LPA_ROUNDS + 1)) + ") s", _lpa_ctes())
    o["modularity"] = q(f"""
, lab AS (SELECT "user", CASE WHEN community_louvain >= 0 THEN 'c' || CAST(community_louvain AS VARCHAR)
                          ELSE 'u' || "user" END AS c FROM mfix),
sym AS (SELECT src, dst, w FROM proj UNION ALL SELECT dst, src, w FROM proj),
per AS (SELECT a.c, sum(CASE WHEN a.c = b.c THEN s.w ELSE 0 END) AS in_c, sum(s.w) AS tot_c
        FROM sym s JOIN lab a ON a."user" = s.src JOIN lab b ON b."user" = s.dst GROUP BY a.c)
SELECT round(CASE WHEN sum(tot_c) > 0 THEN sum(in_c) / CAST(sum(tot_c) AS DOUBLE)
  - sum(CAST(tot_c AS DOUBLE) * tot_c) / (CAST(sum(tot_c) AS DOUBLE) * sum(tot_c)) ELSE 0.0 END, {R})
  AS modularity FROM per""")
    # ---- metrics-based queries on the real PageRank / betweenness
    o["influence_score"] = q_real(f"""SELECT "user", round(pagerank, {R}) AS pagerank,
round(betweenness, {R}) AS betweenness, community_louvain, round(pagerank + betweenness / 1000, {R}) AS influence_score
FROM mreal WHERE pagerank IS NOT NULL AND betweenness IS NOT NULL
ORDER BY pagerank + betweenness / 1000 DESC, "user" LIMIT {TOP_N}""")
    o["user_rank"] = q_pr(f"""SELECT "user", round(pagerank, {R}) AS pagerank,
CAST(floor(rank() OVER (ORDER BY pagerank DESC)
  + (count(*) OVER (PARTITION BY pagerank) - 1) / 2.0) AS BIGINT) AS rank FROM pagerank""")
    o["user_profile"] = q_real(f"""SELECT m."user", round(m.pagerank, {R}) AS pagerank,
round(m.betweenness, {R}) AS betweenness, m.community_louvain,
CAST(floor(1 + (SELECT count(*) FROM mreal x WHERE x.pagerank > m.pagerank)
  + ((SELECT count(*) FROM mreal x WHERE x.pagerank = m.pagerank) - 1) / 2.0) AS BIGINT) AS rank
FROM mreal m WHERE m."user" = '{CENTER}'""")
    o["metric_stats"] = q_real(f"""SELECT 'pagerank' AS metric, round(min(pagerank), {R}) AS "min",
round(max(pagerank), {R}) AS "max", round(avg(pagerank), {R}) AS "avg", round(stddev_samp(pagerank), {R}) AS std
FROM mreal UNION ALL
SELECT 'betweenness', round(min(betweenness), {R}), round(max(betweenness), {R}), round(avg(betweenness), {R}),
round(stddev_samp(betweenness), {R}) FROM mreal""")
    o["top_n_stats"] = q_pr(f"""SELECT arg_min("user", pagerank) AS top_user, round(avg(pagerank), {R}) AS mean,
round(stddev_samp(pagerank), {R}) AS std, count(*) AS n FROM
(SELECT * FROM pagerank ORDER BY pagerank DESC, "user" LIMIT {TOP_N}) t""").replace(
        'arg_min("user", pagerank)', "(SELECT \"user\" FROM pagerank ORDER BY pagerank DESC, \"user\" LIMIT 1)")
    sparse = """
, num AS (SELECT *, TRY_CAST(regexp_extract("user", '(\\d+)$', 1) AS BIGINT) AS n FROM mfix),
sparse AS (SELECT "user", CASE WHEN n % 3 <> 0 THEN pagerank END AS pagerank,
  CASE WHEN n % 7 = 0 THEN NULL ELSE betweenness END AS betweenness,
  CASE WHEN n % 11 <> 0 THEN community_louvain END AS community_louvain FROM num)
"""
    o["metric_coverage"] = q(sparse + """SELECT count(pagerank) AS users_with_pagerank,
count(betweenness) AS users_with_betweenness, count(community_louvain) AS users_with_community FROM sparse""")
    o["users_missing_metrics"] = q(sparse + """SELECT "user", pagerank, betweenness FROM sparse
WHERE pagerank IS NULL OR betweenness IS NULL""")
    o["sparse_metric_stats"] = q(sparse + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(min({m}), {R}) AS "min", round(max({m}), {R}) AS "max",
round(avg({m}), {R}) AS "avg", round(stddev_samp({m}), {R}) AS std FROM sparse""" for m in ("pagerank", "betweenness")))
    o["sparse_user_rank"] = q(sparse + f"""SELECT "user", round(pagerank, {R}) AS pagerank,
CAST(floor(rank() OVER (ORDER BY pagerank DESC NULLS LAST)
  + (count(*) OVER (PARTITION BY pagerank) - 1) / 2.0) AS BIGINT) AS rank FROM sparse""")
    o["metric_pairs"] = q_real(f"""SELECT "user", round(pagerank, {R}) AS pagerank,
round(betweenness, {R}) AS betweenness FROM mreal""")
    o["user_metrics_export"] = q_real(f"""SELECT "user", round(pagerank, {R}) AS pagerank,
round(betweenness, {R}) AS betweenness, community_louvain FROM mreal""")
    o["node_export"] = q_real(f"""SELECT "user" AS id, round(pagerank, {R}) AS pagerank, community_louvain AS community,
round(pagerank * 1000 + 10, {R}) AS size, community_louvain AS color FROM mreal""")
    o["louvain"] = q("""SELECT count(*) AS users_labelled, CAST(0 AS BIGINT) AS label_violations,
CAST(0 AS BIGINT) AS vertices_without_label, CAST(0 AS BIGINT) AS labels_without_vertex FROM vertices""")
    o["louvain_summary"] = q(f"""
, sym AS (SELECT src, dst, w FROM proj UNION ALL SELECT dst, src, w FROM proj),
per AS (SELECT src, sum(CASE WHEN src = dst THEN w ELSE 0 END) AS in_c, sum(w) AS tot_c FROM sym GROUP BY src)
SELECT true AS converged, true AS reported_is_recomputed, true AS above_single_users,
  true AS not_below_label_propagation, true AS levels_rise,
  round(sum(in_c) / CAST(sum(tot_c) AS DOUBLE)
    - sum(CAST(tot_c AS DOUBLE) * tot_c) / (CAST(sum(tot_c) AS DOUBLE) * sum(tot_c)), {R}) AS single_user_modularity
FROM per""")
    o["louvain_community_stats"] = q_pr("""SELECT count(*) AS users, round(sum(pagerank), 3) AS sum_pagerank,
CAST(0 AS BIGINT) AS users_without_community FROM pagerank""")
    o["metric_correlation"] = q_real(f"""SELECT count(*) AS n, round(corr(pagerank, betweenness), {R}) AS pearson
FROM mreal""")
    # ---- community queries on the fixed metrics view
    o["community_stats"] = q(_community_stats("mfix"))
    o["community_summary"] = q(f"""SELECT count(*) AS n_communities, coalesce(max(size), 0) AS largest,
coalesce(min(size), 0) AS smallest, coalesce(round(avg(size), {R}), 0.0) AS mean_size FROM
(SELECT community_louvain, count("user") AS size FROM mfix WHERE community_louvain >= 0
 GROUP BY community_louvain) s""")
    o["community_top15"] = q(f"SELECT * FROM ({_community_stats('mfix')}) s ORDER BY size DESC, community LIMIT 15")
    o["community_top10"] = q(f"""SELECT community, rank, "user", round(pagerank, {R}) AS pagerank FROM (
  SELECT community_louvain AS community, "user", pagerank,
         row_number() OVER (PARTITION BY community_louvain ORDER BY pagerank DESC, "user") AS rank
  FROM mfix WHERE community_louvain >= 0) t WHERE rank <= 10""")
    o["community_members"] = q(f"""SELECT "user", round(pagerank, {R}) AS pagerank,
round(betweenness, {R}) AS betweenness FROM mfix WHERE community_louvain = {COMMUNITY}""")
    return o

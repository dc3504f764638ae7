"""Incremental layers: a day of Silver, a load of the graph, without a full refresh.

``GraphStore`` keeps the graph as loads: new users, resolved edges and weights of each.
A user keeps the id of the load that first had them, so results of earlier loads
stay valid. A load reads its own edges and the dictionary of users; only its new
users are sorted. Repeating the last load replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators import silver
from plexus.operators.graph import Graph, dense_index, resolve_edges, vertex_ids, weighted_projection
from plexus.schemas import EDGE, SILVER
from plexus.session import delete_path, folders, materialize, observation, written_bytes
from plexus.sources import tables

LONG = T.LongType()
VERTEX = T.StructType([T.StructField("user", T.StringType()), T.StructField("vid", LONG)])
RESOLVED = T.StructType([*EDGE.fields, T.StructField("src", LONG), T.StructField("dst", LONG)])
PAIR = T.StructType([T.StructField(c, LONG) for c in ("src", "dst", "w")])


def write_silver(bronze: DataFrame, path: str) -> None:
    """Full refresh of the Silver table, partitioned by ``event_date``."""
    tables.write_table(silver.clean(bronze), path, partition_by=["event_date"])


def refresh_silver(bronze: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Reload days of Silver from all their Bronze rows: the partitions of these days are
    replaced, the files of other days are not touched. Repeats of a row are of one day, so
    cleaning a day alone gives what cleaning everything gives. ``dates`` (``yyyy-MM-dd``)
    keeps other days' rows out; without it every day that ``bronze`` has is replaced."""
    rows = silver.clean(bronze)
    if dates is not None:
        rows = rows.where(F.col("event_date").isin(dates))
    tables.refresh_partitions(rows, path, ["event_date"])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path, schema=SILVER).select(*SILVER.fieldNames())


class GraphStore:
    """vertices, edges and projection under ``path``, a folder a load (``load=N``), and
    ``merged/upto=N``: the projection of all loads up to N."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def loads(self) -> list[int]:
        """The complete loads: the projection is written last."""
        return folders(self.spark, f"{self.path}/projection", "load")

    def _read(self, table: str, loads: list[int], schema: T.StructType) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{table}/load={n}" for n in loads])

    def _write(self, df: DataFrame, table: str, load: int, *metrics):
        obs = observation(table)
        df.observe(obs, *metrics).write.mode("overwrite").parquet(f"{self.path}/{table}/load={load}")
        return obs.get

    def append(self, edges: DataFrame, load: int) -> dict:
        """Add the edges of one load (a written table). ``load`` is greater than any before, or
        equals the last, which is then replaced. Returns the counts of the load."""
        before = [n for n in self.loads() if n != load]
        if before and load < before[-1]:
            raise ValueError(f"load {load} comes after load {before[-1]}: later ids build on it")
        rows = F.count(F.lit(1)).alias("n")
        known = self._read("vertices", before, VERTEX)
        first = known.agg(F.coalesce(F.max("vid") + 1, F.lit(0))).first()[0]
        new = dense_index(vertex_ids(edges).join(known, "user", "left_anti"), "user").select(
            "user", (F.col("vid") + F.lit(first)).alias("vid"))
        users = self._write(new, "vertices", load, rows)
        resolved = resolve_edges(edges, self._read("vertices", [*before, load], VERTEX)).select(*RESOLVED.fieldNames())
        kept = self._write(resolved, "edges", load, rows)
        pairs = self._write(weighted_projection(self._read("edges", [load], RESOLVED)), "projection", load, rows)
        return {"new_users": users["n"], "edges": kept["n"], "pairs": pairs["n"]}

    def projection(self) -> DataFrame:
        """(src, dst, w) of all loads: the newest merged table and the weights of the loads after it."""
        merged = folders(self.spark, f"{self.path}/merged", "upto")
        upto = merged[-1] if merged else None
        deltas = self._read("projection", [n for n in self.loads() if upto is None or n > upto], PAIR)
        if upto is not None:
            deltas = deltas.unionByName(self.spark.read.schema(PAIR).parquet(f"{self.path}/merged/upto={upto}"))
        return deltas.groupBy("src", "dst").agg(F.sum("w").alias("w"))

    def merge(self) -> None:
        """Write the weights of all loads but the last (which may be replaced) as one table. Readers of
        the table before it may still be at work, so that one goes at the next merge."""
        loads = self.loads()[:-1]
        old = folders(self.spark, f"{self.path}/merged", "upto")
        if not loads or old and old[-1] >= loads[-1]:
            return
        upto = old[-1] if old else None
        parts = self._read("projection", [n for n in loads if upto is None or n > upto], PAIR)
        if upto is not None:
            parts = parts.unionByName(self.spark.read.schema(PAIR).parquet(f"{self.path}/merged/upto={upto}"))
        parts.groupBy("src", "dst").agg(F.sum("w").alias("w")).write.mode("overwrite").parquet(
            f"{self.path}/merged/upto={loads[-1]}")
        for n in old[:-1]:
            delete_path(self.spark, f"{self.path}/merged/upto={n}")

    def graph(self) -> Graph:
        """The graph of all loads, for every algorithm of the library."""
        loads = self.loads()
        rows = F.count(F.lit(1)).alias("n")
        vertices, v = materialize(self._read("vertices", loads, VERTEX), "vertices", (observation("vertices"), rows))
        projection, p = materialize(self.projection(), "projection", (observation("pairs"), rows, F.sum("w").alias("w")))
        size = sum(written_bytes(self.spark, f.rsplit("/", 1)[0]) for f in vertices.inputFiles()[:1])
        return Graph(vertices=vertices, resolved=lambda: self._read("edges", loads, RESOLVED), projection=projection,
                     n_vertices=int(v["n"]), n_pairs=int(p["n"]), n_edges=int(p["w"] or 0), vertex_bytes=size)

"""Spark session helpers: one place for the runtime settings the library relies on."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

# Settings every job of the library assumes. AQE re-plans joins at run time
# (broadcast when a side turns out small, splits skewed partitions) and
# coalesces the many small shuffle partitions of the iterative graph jobs.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

MANY_FILES = 50  # partitions of a shuffle, each a file of every map task

# Launch-time settings for sessions this library creates (tests, bench). Graph
# loops run many small jobs: keep the status store small. (Round tables are
# deleted by the loops themselves, see ``drop_table``.)
LAUNCH_CONF = {
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "50",
    "spark.ui.retainedStages": "50",
    "spark.ui.retainedTasks": "2000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "plexus",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings and the UI off."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in {**LAUNCH_CONF, **RUNTIME_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere (e.g. by a driver)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    _one_file_a_task(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _one_file_a_task(spark: SparkSession) -> None:
    """A map task opens a file for each partition of its shuffle if these are at most
    ``spark.shuffle.sort.bypassMergeThreshold``, 200 as is their number if nobody sets it; the graph loops
    spend more time on such files than on their rows. With one partition more a task writes one
    file, and AQE coalesces the partitions as before. A number that someone set is left alone."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    many = MANY_FILES <= int(spark.conf.get("spark.sql.shuffle.partitions")) <= most
    now = spark.conf.get(initial, None)
    if many and now is None:
        spark.conf.set(initial, str(most + 1))
    elif not many and now == str(most + 1):  # set here, for another number of partitions
        spark.conf.unset(initial)


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it on their path anyway."""
    root = Path(__file__).resolve().parents[1]
    paths = [*os.environ.get("PYTHONPATH", "").split(":"), os.getcwd()]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or any(p and Path(p).resolve() == root for p in paths):
        return
    file = os.path.join(tempfile.mkdtemp(prefix="plexus-ship-"), "plexus.zip")
    with zipfile.ZipFile(file, "w") as z:
        for f in sorted((root / "plexus").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(file)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent *and* the session runs in local mode (tests,
    laptops) is a private folder created; on a cluster a missing setting is an
    error, because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="plexus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/plexus-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, observe: tuple | None = None):
    """Write ``df`` as parquet in the shared checkpoint folder and read it back.

    This cuts the lineage of iterative jobs (an executor loss re-reads the table
    instead of replaying every round) and gives AQE exact sizes for the next round.
    ``observe`` = (Observation, *metric columns) collects aggregate metrics during
    the same write job, so a convergence test costs no extra scan.
    Returns the re-read DataFrame (and the metrics dict when ``observe`` is given).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if observe:
        obs, *metrics = observe
        df = df.observe(obs, *metrics)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer scan or inference
    out = spark.read.schema(df.schema).parquet(path)
    if observe:
        return out, observe[0].get
    return out


_OBS_IDS = itertools.count()


def observation(prefix: str) -> Observation:
    """An Observation with a name unique in this process (names must not repeat)."""
    return Observation(f"{prefix}-{next(_OBS_IDS)}-{uuid.uuid4().hex[:8]}")


def at_once(spark: SparkSession, *runs: Callable) -> list:
    """What each of ``runs``, called without arguments, returns. Their jobs run side by side: a round
    of one leaves most cores idle, and none reads what another makes."""
    with ThreadPoolExecutor(len(runs)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(run)) for run in runs]
    return [b.result() for b in begun]


def checkpoint(df: DataFrame, name: str = "round") -> DataFrame:
    """Cut lineage with a table written into the shared checkpoint folder (never a
    local checkpoint): the result survives executor loss and the next round starts
    from a one-node plan.

    A written table rather than ``Dataset.checkpoint``: a checkpointed RDD keeps
    the size estimate of the plan it replaced, and inner-join estimates are
    products, so in an iterative loop the estimate's digit count multiplies every
    round until planning itself takes minutes. A parquet scan is estimated from
    its real file sizes, which also lets AQE and the broadcast check see true
    sizes. One write job, observed metrics included."""
    return materialize(df, name)


def written_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path`` (a listing; no file is opened)."""
    fs, p = _file_system(spark, path)
    return int(fs.getContentSummary(p).getLength())


def file_identity(spark: SparkSession, path: str) -> tuple:
    """(files, bytes, newest change) of a table, so that results kept by path notice new input."""
    fs, p = _file_system(spark, path)
    files = [(f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)]
    return len(files), sum(n for n, _ in files), max((t for _, t in files), default=0)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a round table written by ``checkpoint`` once a loop no
    longer needs it (a superseded round), so an iterative job does not leave one
    edge-sized table per round in the shared folder. Any other DataFrame
    (a source table, a named materialised table) is left alone."""
    files = df.inputFiles()
    if not files:
        return
    folder = files[0].rsplit("/", 1)[0]
    if folder.rsplit("/", 1)[-1].startswith("plexus-round-"):
        delete_path(df.sparkSession, folder)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Hadoop's file system (PySpark has no call of its own)."""
    fs, p = _file_system(spark, path)
    return bool(fs.delete(p, True))


def folders(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers N of the complete folders ``key=N`` under ``path``, ascending: those a write
    job has finished (``_SUCCESS``) or, below a partitioned table, those with files."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    found = [f.getPath() for f in fs.listStatus(p) if f.isDirectory() and f.getPath().getName().startswith(f"{key}=")]
    whole = _exists(spark, f"{path}/_SUCCESS")
    return sorted(int(f.getName().split("=", 1)[1]) for f in found if whole or _exists(spark, f"{f.toString()}/_SUCCESS"))


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a stream's checkpoint has committed, -1 if there is none."""
    path = f"{checkpoint.rstrip('/')}/commits"
    if not _exists(spark, path):
        return -1
    fs, p = _file_system(spark, path)
    return max((int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()), default=-1)


def switch_path(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``; what stood there goes
    only after the switch, and comes back if the switch fails."""
    fs, target = _file_system(spark, path)
    _, source = _file_system(spark, new)
    _, aside = _file_system(spark, f"{path.rstrip('/')}__old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(aside, True)

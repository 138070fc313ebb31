"""Session construction and the shared scratch location.

Scratch data (stream logs, sinks, checkpoints, materialised tables written
by the registered queries) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent *and* Spark runs
in local mode do we create a private folder and register it, as tests do.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults chosen for scale: AQE re-plans joins and partition counts
# from runtime statistics; the shuffle width is an upper bound that AQE
# coalesces down for small stages.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime broadcast only for build sides AQE has measured below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings for a large cluster (pass as ``build_session(conf=...)``).

    AQE can merge shuffle partitions but never split them (except skewed
    join sides), so the shuffle starts wide: a few partitions per core, at
    least enough for 100 TB / 128 MB of pre-aggregated shuffle data in the
    widest stage. With ``parallelismFirst`` off, AQE then coalesces to the
    128 MB advisory size rather than to the core count, so small stages
    (the gold state, dimensions, reports) end up with few partitions.
    """
    initial = max(4 * total_cores, 8192)
    return {
        "spark.sql.shuffle.partitions": str(2 * total_cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.files.openCostInBytes": "8m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(
    master: str | None = None,
    app_name: str = "meterlake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the engine's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Meter times are UTC instants; zone-less values are UTC wall clock.

    The casts between TIMESTAMP and TIMESTAMP_NTZ keep values only under a
    UTC session, so sessions built elsewhere are switched to UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder, registered with the SparkContext if needed."""
    base = _checkpoint_base(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def _checkpoint_base(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        if base.startswith("file:") and not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is {base}: executors of a cluster do not share a file: folder")
        return base
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder"
        )
    base = tempfile.mkdtemp(prefix="meterlake-ckpt-")
    spark.sparkContext.setCheckpointDir(base)
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path in the cluster's shared checkpoint folder.

    With ``unique`` a fresh sub-folder is returned so that repeated runs
    never share stream checkpoints or half-written tables.
    """
    base = _checkpoint_base(spark).rstrip("/")
    path = "/".join([base, "meterlake", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
        at_session_end(spark, lambda: _delete(spark, path))
    return path


_ENDINGS: dict[int, list] = {}


def at_session_end(spark: SparkSession, action) -> None:
    """Run ``action`` when the Python driver ends, while its session still runs.

    Scratch folders and tables live as long as the session that made them: a
    later action may still read them, nothing after it does."""
    key = id(spark.sparkContext)
    if key not in _ENDINGS:
        _ENDINGS[key] = []
        atexit.register(_end, spark, key)
    _ENDINGS[key].append(action)


def _end(spark: SparkSession, key: int) -> None:
    actions = _ENDINGS.pop(key, [])
    if getattr(spark.sparkContext, "_jsc", None) is None:
        return  # stopped before: nothing can be reached any more
    for action in reversed(actions):
        with contextlib.suppress(Exception):  # a folder may be gone already
            action()


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

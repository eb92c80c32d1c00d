"""Session helpers.

Library code never creates a session; it receives one.  ``local_session`` is
for tests and the bench.  ``shared_dir`` resolves the cluster-wide folder named
by ``spark.checkpoint.dir`` (a tests-only default is set when it is missing).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # streaming state (one row per reward key) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# What the same jobs expect on a cluster (set by the deployment, not by the
# library): the keys above plus partition sizing for ~100 TB inputs.
CLUSTER_CONF = dict(_BASE_CONF, **{
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
})


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rewardloom", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("REWARDLOOM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``, else the context's
    checkpoint dir).  Only a session on this one machine (``local[...]``) gets
    a temporary folder when nothing is configured; on a cluster that would
    scatter tables over the machines' own disks, so it is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the conf is all there is
        sc = None
    if sc is not None:
        cur = sc.getCheckpointDir()
        if cur:
            return cur
        if not conf and not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all machines share")
        if not conf:
            conf = tempfile.mkdtemp(prefix="rewardloom-ckpt-")   # one machine, nothing configured
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not conf:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder (never a machine-local temp dir)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/rewardloom/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage: write ``df`` once as parquet under the shared folder and
    return a DataFrame reading it (one computation, survives executor loss)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: list = []


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, once a session, unless they find it by path (PYTHONPATH or a working folder).
    Whatever runs the package's own functions inside tasks calls it first."""
    root = Path(__file__).resolve().parents[1]
    found = [Path(p or ".").resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    if root in found or (os.environ.get("PYTHONPATH") and (Path.cwd() / "rewardloom").exists()) or spark in _SHIPPED:
        return
    at = tempfile.mkdtemp(prefix="rewardloom-ship-")      # on the driver; Spark copies the file to every executor
    spark.sparkContext.addPyFile(shutil.make_archive(f"{at}/rewardloom", "zip", root, "rewardloom"))
    _SHIPPED.append(spark)


def _fs(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``: the store that Spark itself reads and writes."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at))


def file_state(spark: SparkSession, path: str) -> str:
    """Number, total size and newest change time of the files at ``path``, on any file system."""
    fs, at = _fs(spark, path)
    files, n, size, newest = fs.listFiles(at, True), 0, 0, 0
    while files.hasNext():
        f = files.next()
        n, size, newest = n + 1, size + f.getLen(), max(newest, f.getModificationTime())
    return f"{n}:{size}:{newest}"


def staged_path(spark: SparkSession, name: str, fingerprint: str, build) -> str:
    """Folder of a table derived once from given inputs and then read like a
    source.  ``fingerprint`` identifies the inputs and their state.  The table
    is written to a folder of its own and renamed when complete, so readers of
    a finished table are never disturbed; whoever is second uses the first's.
    Its files follow the data: as many as the write has partitions."""
    import hashlib

    digest = hashlib.sha1(fingerprint.encode()).hexdigest()[:16]
    path = f"{shared_dir(spark).rstrip('/')}/rewardloom/staged/{name}-{digest}"
    if not path_exists(spark, path):
        own = scratch_path(spark, f"staging-{name}")
        build().write.parquet(own)
        fs, at = _fs(spark, path)
        fs.mkdirs(at.getParent())
        if not fs.rename(_fs(spark, own)[1], at) and not fs.exists(at):
            raise RuntimeError(f"could not put {own} in place at {path}")
    return path


def staged(spark: SparkSession, name: str, fingerprint: str, build):
    return spark.read.parquet(staged_path(spark, name, fingerprint, build))


def release(spark: SparkSession, df) -> None:
    """Deletes the folders that ``materialize`` wrote for ``df``; it can't be read again."""
    base = f"{shared_dir(spark).rstrip('/')}/rewardloom/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/rewardloom/" in folder and folder.split(":", 1)[-1].lstrip("/").startswith(base.split(":", 1)[-1].lstrip("/")):
            fs, at = _fs(spark, folder)
            fs.delete(at, True)

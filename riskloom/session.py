"""Session helpers: a tuned local session for tests/bench and the shared
scratch folder used to cut lineage or hold round-trip files."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskloom", extra: dict | None = None) -> SparkSession:
    """Session for local runs. On a cluster, pass the cluster's own session
    to the operators instead; nothing here is required by them."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.scheduler.mode", "FAIR")   # fits submitted side by side share the cores
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         # checkpoint files of intermediate tables are removed once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is read from the
    session and left alone. Only where it is unset (local tests) a folder of
    our own is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it."""
    import zipfile

    import riskloom
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(riskloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskloom-ship-"), "riskloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("riskloom", os.path.relpath(full, root)))
    sc.addPyFile(path)  # the driver serves it; executors keep their own copy
    sc._riskloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster) for round-trip files and written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"riskloom-{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, spread: bool = True):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used before multi-pass reports: every later pass (and a recomputation after
    a lost executor) scans the files, with its own columns only, instead of
    re-running the joins behind them. The files go when the session ends.

    A result with fewer files than cores (a small table, or one derived from a
    single file) is dealt evenly and written again, so the passes that fan it
    out (unpivot × features) use every core.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    delete_on_exit(spark, path)
    if spread and len(out.inputFiles()) < target:
        spread = scratch_path(spark, "table")
        out.repartition(target).write.parquet(spread)
        out = spark.read.schema(df.schema).parquet(spread)
        delete_path(spark, path)
        delete_on_exit(spark, spread)
    return out


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing will read again."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete a scratch folder when the session ends."""
    fs, p = _hadoop_path(spark, path)
    fs.deleteOnExit(p)

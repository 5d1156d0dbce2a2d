"""Session helpers: building a local session for tests/bench and finding the
shared scratch folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Arrow batch size bound for the page walk (bytes).
ARROW_BATCH_BYTES = 64 * 1024 * 1024


def job_session(app: str) -> SparkSession:
    """Session for a submitted job: the cluster's settings plus the byte bound
    on Arrow batches the page walk needs."""
    spark = (SparkSession.builder.appName(app)
             .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def build_session(app: str = "shelfscan", cpus: int | str = "*",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings this library is tuned for.

    On a cluster the session comes from the launcher; only the SQL options
    below matter there and are safe to set per job.
    """
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Pages are heavy rows (tens to hundreds of KB): bound Arrow batches
        # by bytes, not only by rows.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
        .config("spark.driver.memory", "16g")
        # checkpoints written by the ordering / quantile operators are removed
        # once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names a shared folder (HDFS/S3/ABFS) in ``spark.checkpoint.dir``;
    we never replace it.  Only a local session (tests, a laptop) without one
    gets a local folder; on a cluster executors could not read it, so an unset
    value is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="shelfscan-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfscan`` importable in the Python workers of this application.

    The page walk and the page-fact UDFs run library functions inside tasks;
    workers import them by module name.  The package's ``.py`` files are zipped
    once per application and added with ``addPyFile`` (Spark distributes the
    file to every executor).  A package installed on the cluster makes this a
    harmless no-op duplicate.
    """
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: ship as a session artifact
        sc = None
    key = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="shelfscan-pkg-"), "shelfscan.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)


def default_parallelism(spark: SparkSession) -> int:
    """Cluster parallelism (cores); shuffle partitions where it is not visible."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SCRATCH: list[tuple[SparkSession, str]] = []


def _remove_scratch() -> None:
    """At exit: scratch tables are removed while their session still lives."""
    for spark, path in _SCRATCH:
        try:
            sc = spark.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session has ended: nothing can be removed any more
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables,
    removed when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base}/shelfscan-{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, path))
    return path

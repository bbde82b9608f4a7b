"""Session helpers: scratch locations and a local session for tests/bench."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Spark registers that setting as the context's checkpoint directory; it is
    read from there. Only when nothing is configured (local tests) is a folder
    chosen here, and then it is registered with ``setCheckpointDir`` so
    checkpoints and later lookups agree. A cluster without the setting is an
    error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder"
            )
        root = tempfile.mkdtemp(prefix="tabml-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in this application's own folder under the shared
    checkpoint folder. That folder goes when Python exits in the ordinary way;
    results read from it have to be consumed or written elsewhere by then."""
    sc = spark.sparkContext
    folder = _SCRATCH.get(sc.applicationId)
    if folder is None:
        folder = _SCRATCH[sc.applicationId] = f"{checkpoint_root(spark)}/tabml/{sc.applicationId}-{uuid.uuid4().hex[:12]}"
        atexit.register(_discard, sc, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def _discard(sc, folder: str) -> None:
    """Deletes the application's scratch folder, through the store that holds it."""
    if sc._jsc is None:  # stopped before: nothing to ask any more
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cpus: int | None = None, app: str = "tabml") -> SparkSession:
    """A local session sized like the tests and bench expect (UI off)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABML_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark

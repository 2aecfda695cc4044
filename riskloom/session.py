"""Session helpers: a local session for tests/bench and a shared scratch folder.

On a cluster the scratch folder lives under ``spark.checkpoint.dir`` (a shared
file system named by the cluster).  Only when that setting is absent (local
tests) do we pick a fresh temporary folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "riskloom") -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, UTC, Arrow on."""
    parts = os.environ.get("RISKLOOM_SHUFFLE_PARTITIONS", "8")
    # Python workers inherit this: hides a pandas FutureWarning raised inside
    # PySpark's own state serializer.
    os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


class SharedFolderMissing(RuntimeError):
    """A cluster session names no shared folder for written intermediate tables."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  Only a local session (tests) may
    have none: it gets a temporary one.  On a cluster a folder of one
    machine would give partial reads, so there the setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif not sc.master.startswith("local[") and sc.master != "local":
        raise SharedFolderMissing(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder and reading it back.

    One computation of ``df`` (an eager RDD checkpoint computes an
    unpersisted plan twice: once to count, once to write), and later reads
    get column pruning and filter pushdown.  Survives executor loss: the
    table is on the shared file system, not on executor disks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riskloom`` importable in every Python worker.

    Functions run by ``mapInPandas`` / ``applyInPandas`` / pandas UDFs refer
    to this package's modules, so executors need it: it is zipped once per
    application into the shared checkpoint folder and added with
    ``addPyFile`` (Spark then serves it to every executor).
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.join("riskloom", os.path.relpath(full, root)))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    base = ensure_checkpoint_dir(spark)
    folder = base[len("file:"):] if base.startswith("file:") else base
    path = f"{folder.rstrip('/')}/riskloom-{digest}.zip"
    if "://" in path:  # remote shared storage: write through Spark's Hadoop FS
        jvm = sc._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(p, True)
        out.write(bytearray(data))
        out.close()
    else:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(app)

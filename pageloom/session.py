"""Session helpers.

Library code never builds its own session: every job takes the caller's
``SparkSession``.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pageloom") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC,
    ANSI, no UI).  Only for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by the cluster (``spark.checkpoint.dir``,
    or the context's checkpoint folder).  Only when none is named and the
    master is local (tests) is a scratch folder chosen; on a cluster a
    missing setting is an error, never a machine-local folder."""
    current = None
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 -- no classic context (e.g. Spark Connect)
        pass
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        master = spark.sparkContext.master or ""
    except Exception:  # noqa: BLE001
        master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs need a shared "
            "checkpoint folder on a cluster")
    global _LOCAL_SCRATCH
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="pageloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_SCRATCH


_LOCAL_SCRATCH: str | None = None


def materialize(df, tag: str = "step", slot: str | None = None):
    """Cut the lineage of ``df``: write it as a parquet table under the
    shared checkpoint folder and read it back.  One job computes and writes
    (``DataFrame.checkpoint()`` would compute twice unless cached), and a
    lost executor only re-reads files.

    Iterative jobs pass ``slot`` (``"<run id>-<round % 2>"``): the two slots
    of a run alternate, so a round overwrites only the table of two rounds
    back -- which nothing reads any more -- and storage stays at two rounds
    instead of growing with their number."""
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    if slot is None:
        path = f"{base}/pageloom-{tag}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
    else:
        path = f"{base}/pageloom-{tag}-{slot}"
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df, keys, tag: str = "step", together: bool = False):
    """As :func:`materialize`, in hash buckets of the columns ``keys`` (as
    many as the session's shuffle partitions): joins and aggregates on them
    read the buckets as they lie, without an exchange.  ``together`` says that
    the plan leaves the rows of a bucket together already (a join or an
    aggregate on ``keys``); otherwise they are shuffled.

    Buckets need a catalogue entry to be written.  It is dropped again; the
    files stay, and the returned DataFrame keeps the layout."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"pageloom_{tag}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    rows = df if together else df.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).format("parquet").option("path", path).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return table


def new_run_id() -> str:
    return uuid.uuid4().hex


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, as
    ``--py-files`` would: zip it once per application on the driver and hand
    it to ``addPyFile``, which distributes it to every executor.  Needed by
    the Arrow-batched Python steps (``mapInPandas``, ``pandas_udf``)."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 -- Spark Connect: artifacts instead of addPyFile
        sc, app = None, spark.conf.get("spark.app.id", "connect")
    if app in _SHIPPED:
        return
    import zipfile

    import pageloom
    root = os.path.dirname(os.path.dirname(os.path.abspath(pageloom.__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="pageloom-pyfiles-"), "pageloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(os.path.join(root, "pageloom")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)

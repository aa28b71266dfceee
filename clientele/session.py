"""Session helpers: a local session for tests/bench and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clientele", driver_memory: str = "16g") -> SparkSession:
    """A local[*] session configured the way the tests and bench expect.

    On a cluster, build the session with the cluster's own settings instead;
    nothing in the library depends on this function.
    """
    builder = (
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
        .config("spark.driver.memory", driver_memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory named by the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it.
    Only a local-mode session with no setting gets a private scratch folder
    (tests); on a cluster an unset directory is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss")
    scratch = tempfile.mkdtemp(prefix="clientele-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clientele`` importable in the Python workers.

    Pandas UDFs and ``mapInPandas`` stages refer to functions of this
    package, so executors must be able to import it.  The package is zipped
    once and added with ``addPyFile`` (Spark's own distribution mechanism,
    the same as ``--py-files``); nothing is done twice per SparkContext.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="clientele-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            if "__pycache__" in folder:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable (eager) checkpoint into the session's checkpoint directory.

    Used where a plan must be evaluated exactly once (values that depend on
    partition layout, iterative fits) and where recomputation after an
    executor loss must not re-run a long lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the checkpoint folder and read back, without
    lineage; ``discard`` deletes it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``staged`` returned."""
    at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._staged_path)
    at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)

"""Session helpers: local sessions for tests, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the JIT compiler gives up on longer methods; wide projections then run faster uncollapsed
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # recording the Python call site of every column costs more than planning the queries
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    A session on one machine without one, as in tests, gets a folder of the warehouse, which the session names too.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder, for a written table or a stream's log."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and return the stored copy.

    Survives the loss of executors, and fixes values such as partition ids that
    a recomputation could change.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return a reader of it.

    For a costly table that several steps read: each then scans just the columns it needs.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a written table, when nothing reads it any more."""
    sc = df.sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

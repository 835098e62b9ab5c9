"""Session settings for local runs and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "larder") -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter makes it."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by spark.checkpoint.dir.

    Only a local master, where one machine is the whole cluster, may fall back
    to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="larder-checkpoint-")
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame: Parquet in the shared folder, of which later reads take only the columns they need."""
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/larder-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discarded(df: DataFrame) -> None:
    """Delete the files of a checkpointed frame that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

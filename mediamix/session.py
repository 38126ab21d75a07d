"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "mediamix", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def is_local(master: str | None) -> bool:
    """Whether driver and executors are one process and share its folders."""
    return bool(master) and (master == "local" or master.startswith("local["))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.

    Without one, a local session gets a fresh temporary folder. On a cluster that folder
    would be another one on each machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="mediamix-checkpoint-")
    context.setCheckpointDir(path)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back from there.

    A Parquet table and not an RDD checkpoint: it is computed once, read by column, and
    its size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._cut_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that no later plan reads; others stay."""
    for table in tables:
        path = getattr(table, "_cut_path", None)
        if path:
            jvm = table.sparkSession.sparkContext._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)

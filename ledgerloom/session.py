"""The folder that a cluster shares, and tables written there to end a lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one is
    made on one machine, as in tests; a cluster has to name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", path)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/ledgerloom/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage ends here and an
    executor that is lost later takes nothing with it."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for table in tables:
        spark, files = table.sparkSession, table.inputFiles()
        own = f"{shared_dir(spark)}/ledgerloom/".split(":")[-1].lstrip("/")
        if files and own in files[0]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

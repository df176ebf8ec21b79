"""Session helpers: a tuned session for tests and benches, and the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
BATCH = 2 << 20


def local_session(cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName("webloom")
    base = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": _own("warehouse"),
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _own(name: str) -> str:
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="webloom-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return f"file://{_OWN[0]}/{name}"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset a local session gets a
    folder of its own; a cluster must name one that all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own("shared")


def written(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage and
    survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/webloom/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def page_batches(df: DataFrame) -> DataFrame:
    """``df`` ready for the functions of pages: batches of bounded bytes for the workers,
    where the session sets no bound of its own, and at least a partition for each core (a
    small file is one partition, whatever its pages cost)."""
    spark = df.sparkSession
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None or int(spark.conf.get(name)) > 64 << 20:
        spark.conf.set(name, str(BATCH))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

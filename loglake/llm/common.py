"""What the operators of this subpackage share: tables, materialisation, folds."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a local session (tests) may leave it unset; it then gets a folder in /tmp.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "/tmp/checkpoints"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    return path


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that nothing refers to any more: it learns that from the JVM's collector."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows go to reliable storage once and are read back from there."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    _release(df.sparkSession)
    return out


def written(df: DataFrame) -> DataFrame:
    """As settle(), but as a Parquet table in the shared folder: for wide rows of which later steps read some columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loglake/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _release(spark)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table of written() that no later step reads."""
    spark = df.sparkSession
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def matched(rows: DataFrame, keys: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """rows joined with keys, which has each key once and, as weight, about how many rows it has; the weight goes.

    Keys with more than a thousandth of the whole weight, fewer than 1,000 therefore, are broadcast, so that no task
    gets all rows of one; the others are joined as usual. rows is read twice.
    """
    heavy = F.col(weight) > (keys.agg(F.sum(weight)).first()[0] or 0) / 1000
    hot, cold = F.broadcast(keys.where(heavy).drop(weight)), keys.where(~heavy).drop(weight)
    return rows.join(hot, on, how).unionByName(rows.join(F.broadcast(keys.where(heavy).select(*on)), on, "left_anti").join(cold, on, how))


def small_batches(spark: SparkSession, rows: int = 128) -> None:
    """Arrow batches of whole texts: a bounded number of rows, so that a batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal id, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def sample_ids(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` distinct keys, those whose hash is smallest: the same ones however the rows are laid out.

    Only the keys are read and moved: each task keeps its smallest ones.
    """
    h = F.xxhash64(F.col(key))
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(h, key).limit(bound)


def sample_rows(df: DataFrame, key: str, bound: int) -> DataFrame:
    """The rows of sample_ids(), one for each key; the bounded key set is broadcast."""
    return df.join(F.broadcast(sample_ids(df, key, bound)), key, "left_semi").dropDuplicates([key])

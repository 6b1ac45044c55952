"""Tables of the stream: archive, normalized, quarantine and the ledger of done ids.

Each is a folder of Parquet, partitioned by batch; archive and ledger also by the hour of
their time, above the batch. A batch writes its own partitions and replaces them if it
runs again, so a restart never doubles rows. Readers of ledger and archive name the hours
that they need, so the scan lists and reads these alone. prune() drops hours that are
over, compact() makes one batch of an hour's small files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig

LEDGER = "event_id string, done_at string, hour string, batch_id long"
ARCHIVE = "event_id string, received_at string, format string, source string, payload string, hour string, batch_id long"
#: The batch that compact() writes; the stream's own count from 0.
COMPACTED = -1


def hour_of(time: Column) -> Column:
    """The UTC hour of an RFC 3339 time as yyyy-MM-dd-HH, `unknown` if it isn't one. It sorts by time."""
    return F.coalesce(F.date_format(F.to_utc_timestamp(F.try_to_timestamp(time), F.current_timezone()), "yyyy-MM-dd-HH"), F.lit("unknown"))


@dataclass(frozen=True)
class Stores:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, rows: DataFrame, batch_id: int, time: str | None = None) -> None:
        """Replace a batch's rows; time: the column that gives the hour, for tables that are partitioned by it too."""
        if time is None:
            rows.write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch_id}")
            return
        rows = rows.withColumn("hour", hour_of(F.col(time))).withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#event_id", "true")
        writer.partitionBy("hour", "batch_id").parquet(self.path(name))

    def read(self, spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
        """A table; an empty one of the schema if nothing was written yet."""
        try:
            reader = spark.read.schema(schema) if schema else spark.read
            return reader.parquet(self.path(name))
        except AnalysisException:
            if schema is None:
                raise
            return spark.createDataFrame([], schema)

    def ledger(self, spark: SparkSession, but: int | None = None, since: str | None = None) -> DataFrame:
        """Ids that batches other than `but` have done, in the hours from `since` (RFC 3339) on; both prune partitions."""
        done = self.read(spark, "ledger", LEDGER)
        if since is not None:
            done = done.where(F.col("hour") >= self._hour(spark, since))
        return done if but is None else done.where(F.col("batch_id") != but)

    def mark_done(self, rows: DataFrame, batch_id: int, cfg: EngineConfig) -> None:
        self.write("ledger", rows.where("coalesce(event_id, '') <> ''").select("event_id", F.lit(cfg.now).alias("done_at")), batch_id, "done_at")

    def archived(self, spark: SparkSession, event_id: str, received_at: str | None = None) -> DataFrame:
        """The untouched raw event of an id. With the time of its receipt one hour is read; without, the filters of all files are asked."""
        rows = self.read(spark, "archive", ARCHIVE)
        if received_at is not None:
            rows = rows.where(F.col("hour") == self._hour(spark, received_at))
        return rows.where(F.col("event_id") == event_id).select(*schemas.RAW.names)

    def forget(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Delete a batch's rows of a table that only this batch needed."""
        self._delete(spark, f"{self.path(name)}/batch_id={batch_id}")

    def prune(self, spark: SparkSession, name: str, before: str) -> int:
        """Delete a table's hours that ended before that time; how many."""
        gone = [h for h in self._hours(spark, name) if h < self._hour(spark, before) and h != "unknown"]
        for h in gone:
            self._delete(spark, f"{self.path(name)}/hour={h}")
        return len(gone)

    def compact(self, spark: SparkSession, name: str, hour: str) -> None:
        """Make one batch of a past hour's batches. To be run while no stream writes that hour."""
        folder = f"{self.path(name)}/hour={hour}"
        spark.read.option("basePath", folder).parquet(folder).drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{self.path(name)}/.compacted-{hour}")
        for batch in self._names(spark, folder):
            self._delete(spark, f"{folder}/{batch}")
        files, path = self._files(spark, folder)
        files.rename(path(f"{self.path(name)}/.compacted-{hour}"), path(f"{folder}/batch_id={COMPACTED}"))

    @staticmethod
    def _hour(spark: SparkSession, time: str) -> str:
        return spark.range(1).select(hour_of(F.lit(time))).first()[0]

    def _hours(self, spark: SparkSession, name: str) -> list[str]:
        return [n.partition("=")[2] for n in self._names(spark, self.path(name)) if n.startswith("hour=")]

    @staticmethod
    def _files(spark: SparkSession, folder: str):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        files, path = self._files(spark, folder)
        return [f.getPath().getName() for f in files.listStatus(path(folder))] if files.exists(path(folder)) else []

    def _delete(self, spark: SparkSession, folder: str) -> None:
        files, path = self._files(spark, folder)
        files.delete(path(folder), True)

"""Where the jobs keep their tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra import schemas
from attestra.sources.tables import read_or_empty


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        return read_or_empty(spark, self.path(table), ddl)

    def snapshot(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        """The newest snapshot of a table that is kept as a series of snapshots."""
        rows = read_or_empty(spark, self.path(table), f"{ddl}, snapshot string")
        newest = rows.agg(F.max("snapshot").alias("s")).first()["s"]
        if newest is None:
            return spark.createDataFrame([], ddl)
        return rows.where(F.col("snapshot") == newest).drop("snapshot")

    def add_snapshot(self, df: DataFrame, table: str, name: str) -> None:
        (
            df.withColumn("snapshot", F.lit(name))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot")
            .parquet(self.path(table))
        )

    def silver(self, spark: SparkSession) -> DataFrame:
        """Silver with the place of each row (null in a table that is not stored by place)."""
        return spark.read.schema(f"{schemas.SILVER}, {schemas.SILVER_PLACE}").parquet(self.path("silver"))

    def runs(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "runs", schemas.RUNS)

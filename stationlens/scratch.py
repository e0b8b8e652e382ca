"""Scratch tables in the shared folder, given back as soon as they are no longer read."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from stationlens.session import scratch_path


class Scratch:
    """Compressed tables of one run of an operator.

    ``put`` writes a table and reads it back, which cuts lineage without tying rows to the life of
    an executor; ``bucketed`` does so with the rows of a key in one bucket, sorted, so that a join
    on that key does not move them again; ``drop`` deletes tables that later steps do not read.

    With ``partitions`` the tables are read in a session of their own, whose plans are fixed up
    front at that many shuffle partitions. That suits loops of many small jobs over tables of
    counted size, where planning anew after each shuffle is most of the work, and leaves the
    settings of the caller's session alone; ``give`` hands a result back to that session.
    """

    def __init__(self, spark: SparkSession, name: str, partitions: int = None):
        self.spark, self.outer, self.name, self._held = spark, spark, name, {}
        if partitions:
            self.spark = spark.newSession()
            self.spark.conf.set("spark.sql.adaptive.enabled", "false")
            self.spark.conf.set("spark.sql.shuffle.partitions", str(partitions))

    def path(self, name: str) -> str:
        return scratch_path(self.spark, f"{self.name}-{name}")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._held[id(table)] = (table, path, None)
        return table

    def bucketed(self, name: str, df: DataFrame, buckets: int, *keys: str) -> DataFrame:
        path, known = self.path(name), f"{self.name}_{name}_{uuid.uuid4().hex}"
        rows = df.repartition(buckets, *keys)
        rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(known)
        table = self.spark.table(known)
        self._held[id(table)] = (table, path, known)
        return table

    def give(self, table: DataFrame) -> DataFrame:
        """A table for the caller's session; the scratch no longer holds it."""
        table, path, known = self._held.pop(id(table))
        return self.outer.read.schema(table.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if table is not None and id(table) in self._held:
                _, path, known = self._held.pop(id(table))
                if known:
                    self.spark.sql(f"DROP TABLE IF EXISTS {known}")
                delete(self.spark, path)

    def close(self, *kept: DataFrame) -> None:
        """Drop all tables but ``kept``."""
        self.drop(*[t for t, _, _ in list(self._held.values()) if not any(t is k for k in kept)])


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark can write to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partitions_for(rows: int, rows_per_task: int = 100_000, least: int = 4, most: int = 20_000) -> int:
    """Shuffle partitions for tables of ``rows`` rows."""
    return int(min(most, max(least, rows // rows_per_task)))

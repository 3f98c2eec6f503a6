"""Keys of earlier runs, kept in a table that later runs join in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import first_per_key
from feedloom.session import staged


class KeyHistory:
    """A table of all keys that runs have taken, cut into buckets by key and sorted in them.

    New records are dealt by key into as many partitions as there are buckets; each then meets its bucket, and
    the history is neither shuffled nor sorted as a whole. What a run adds is a partition of its own in the same
    buckets, so a run that is repeated replaces what it added before. The table lies at ``path`` under
    ``name`` in the session's catalog, and is found again there by a later session.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, key: str, key_type: str = "string", buckets: int = 64
    ):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        if not spark.catalog.tableExists(name):
            # Makes the folder where there is none.
            none = spark.range(0).select(F.lit("").cast(key_type).alias(key), F.col("id").alias("run"))
            none.write.mode("ignore").partitionBy("run").parquet(path)
            spark.sql(
                f"CREATE TABLE {name} (`{key}` {key_type}, run BIGINT) USING parquet PARTITIONED BY (run) "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
            spark.catalog.recoverPartitions(name)

    def keys(self, before: int) -> DataFrame:
        """The keys of the runs before this one."""
        return self.spark.table(self.name).where(F.col("run") < before).select(self.key)

    def unseen(self, records: DataFrame, run: int, seq: str = "seq") -> DataFrame:
        """The first record of each key that no run before this one has taken.

        Records without a key are left out.
        """
        known = records.where(F.col(self.key).isNotNull())
        dealt = first_per_key(known, self.key, seq).repartition(self.buckets, self.key)
        # An outer join, as an anti-join would be moved below the dealing out and shuffle both sides.
        kept = self.keys(run).withColumn("_kept", F.lit(True)).hint("merge")
        return dealt.join(kept, self.key, "left").where("_kept IS NULL").select(*records.columns)

    def add(self, records: DataFrame, run: int) -> None:
        """Keep the keys of a run; they replace those of the same run."""
        # Written first, as what is new was found by reading the table it goes to.
        new = staged(records.select(self.key).distinct(), "keys").repartition(self.buckets, self.key)
        new.sortWithinPartitions(self.key).createOrReplaceTempView(view := f"{self.name}_new")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (run = {int(run)}) SELECT `{self.key}` FROM {view}"
        )
        self.spark.catalog.dropTempView(view)

"""Where layers are kept: stage as views, core and mart as Parquet datasets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.rowfilter import restrict_rows
from ledgerline.sources.raw import REFUSED, accepted, refused

LAYERS = ("landing", "raw", "rejects", "stage", "snapshots", "core", "mart", "ledger")


@dataclass(frozen=True)
class Store:
    """Datasets below one root folder, addressed by layer and name."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def materialize(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Stage becomes a view (always current); other layers are replaced as a whole.

        Rows are written by the tasks that made them, each a file per batch it holds: a batch much
        larger than the rest is spread over tasks, and no row is shuffled again only to be written.
        """
        if layer == "stage":
            df.createOrReplaceTempView(f"stage_{name}")
            return df
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(layer, name))
        return self.load(layer, name)

    def write_batch(self, df: DataFrame, layer: str, name: str, batch_id: int, column: str = BATCH) -> None:
        """Replace exactly one batch; doing it twice leaves the same data.

        Writing into the folder of the batch also clears it when the new load is empty.
        """
        target = f"{self.path(layer, name)}/{column}={batch_id}"
        df.filter(df[column] == batch_id).drop(column).write.mode("overwrite").parquet(target)

    def replace_batches(self, df: DataFrame, layer: str, name: str, batches: Iterable[int], column: str = BATCH) -> None:
        """Replace the named batches by their rows in ``df``, in one write; others stay as they are.

        A batch without rows is emptied as well.
        """
        batches = sorted(batches)
        if not batches:
            return
        seen = Observation()
        rows = df.filter(F.col(column).isin(*batches)).observe(seen, F.collect_set(column).alias("batches"))
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(column).parquet(self.path(layer, name))
        )
        for batch_id in set(batches) - set(seen.get.get("batches") or ()):
            self.write_batch(df.limit(0), layer, name, batch_id, column)

    def write_landing(self, lines: DataFrame, name: str, batch_id: int, counts: dict[str, Column]) -> list[int]:
        """Replace the lines of one batch, rows and rejects side by side, in one write.

        Returns the values of the aggregates, which are taken of the rows as they are written.
        """
        target = f"{self.path('landing', name)}/{BATCH}={batch_id}"
        seen = Observation()
        watched = lines.observe(seen, F.count(F.lit(1)).alias("lines"), *[c.alias(n) for n, c in counts.items()])
        watched.drop(BATCH).write.mode("overwrite").partitionBy(REFUSED).parquet(target)
        if not seen.get.get("lines"):  # nothing was written; the columns are kept all the same
            lines.limit(0).drop(BATCH, REFUSED).write.mode("overwrite").parquet(f"{target}/{REFUSED}=0")
        return [seen.get.get(n) or 0 for n in counts]

    def load(self, layer: str, name: str) -> DataFrame:
        """The dataset; columns that only some batches carry are merged in."""
        if layer == "stage":
            return self.spark.table(f"stage_{name}")
        if layer in ("raw", "rejects") and not self.exists(layer, name) and self.exists("landing", name):
            lines = self.spark.read.option("mergeSchema", True).parquet(self.path("landing", name))
            return accepted(lines) if layer == "raw" else refused(lines)
        return self.spark.read.option("mergeSchema", layer == "raw").parquet(self.path(layer, name))

    def exists(self, layer: str, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(layer, name))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def mart(self, name: str, users: DataFrame, user: str | None = None) -> DataFrame:
        """A mart as ``user`` may see it; the one way reports read marts."""
        return restrict_rows(self.load("mart", name), user, users)

"""Intermediate tables of one operator run, in the shared checkpoint folder.

Every operator that needs a table twice writes it here as Parquet: the folder is the one the
session names in ``spark.checkpoint.dir``, so the table survives the loss of any executor, and
reading it again recomputes nothing.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import checkpoint_dir


class Scratch:
    """Tables of one run; ``free`` deletes one as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        self._keep = getattr(self, "_keep", []) + [out]
        return out

    def free(self, *frames: DataFrame) -> None:
        """Delete stored tables, and let Spark's cleaner drop the shuffles behind them."""
        conf = self.spark._jsc.hadoopConfiguration()
        for f in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(f)))
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()


def rename_clear(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the wanted columns under our own names, so extra columns with clashing names can't meet ours.

    ``wanted`` maps our name to the column name (or expression) of the input.
    """
    from pyspark.sql import functions as F
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in wanted.items()])

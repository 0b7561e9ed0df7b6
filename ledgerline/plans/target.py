"""The target as a table of the session catalog (K2, K4-K7): Parquet, bucketed by the key, partitioned by the bucket.

``CREATE TABLE ... USING parquet PARTITIONED BY (_part) CLUSTERED BY (key) INTO n BUCKETS``: a row's partition is
its bucket number, ``pmod(hash(key), n)``. So a join by key reads the table bucket by bucket and never shuffles it, and
``INSERT OVERWRITE`` with dynamic partitions replaces the buckets that a load has changed rows in, and no others:

* rows with new keys are appended (``INSERT INTO``): nothing that is stored is read but the key column, or rewritten;
* buckets in which the batch updates rows are merged and overwritten, new rows of theirs included.

Spark writes a statement's files aside and moves them in when its job commits, so a statement that fails leaves the table
as it was. A load that both updates and appends elsewhere is two statements, updates first; if the second fails, the same
batch can be loaded again. Versions, conflicts between writers and row-level MERGE are left to the table formats that
have them: a table of such a provider gets one ``MERGE INTO`` statement instead.

``target`` is the name of a table (``db.operaciones``, a managed table) or a folder (an external table, registered under a
name made of the folder's path; ``MSCK REPAIR`` finds its partitions in a new session). The number of buckets is fixed at
creation and stands in the catalog, and for a folder in its name (``buckets-<n>``).
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import upsert as U
from ledgerline.plans.keyjoin import Stored, bucket_count, materialize_by, observed
from ledgerline.session import broadcast_limit
from ledgerline.sources.parquet import footer_aggregates

PART = "_part"
ROW_LEVEL = ("delta", "iceberg", "hudi")          # providers whose tables take MERGE INTO
SORTED = 256 << 20          # measured bytes of a bucket's new rows that one task may sort
LEAST_PARTS = 16            # buckets of a new table, if none are asked for
FEW = 32                    # buckets whose files stay large if every task writes to all of them


class NullInRequiredColumn(ValueError):
    """A row to load has no value in a column that must have one."""


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class TargetTable:
    """``parts``: buckets of a new table, by default as many as its first load takes to sort one in memory; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, target: str, key: str = S.KEY_COLUMN, parts: int | None = None):
        if parts is not None and parts < 1:
            raise ValueError("parts must be at least 1")
        self.spark, self.key, self._asked, self._new_parts = spark, key, parts, parts or LEAST_PARTS
        self.folder = target.rstrip("/") if "/" in target else None
        self.name = f"ledgerline_{hashlib.md5(self.folder.encode()).hexdigest()[:20]}" if self.folder else target

    # -- catalog ---------------------------------------------------------------------------------
    def _folder(self, place: str):
        """(file system, path) of a folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _stored_parts(self) -> int | None:
        """The number of buckets that an external table's folder was made with."""
        fs, path = self._folder(self.folder)
        found = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return next((int(n.removeprefix("buckets-")) for n in found if n.startswith("buckets-")), None)

    def _create(self, parts: int) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in S.TARGET_SCHEMA)
        place = f" LOCATION '{self.folder}/buckets-{parts}'" if self.folder else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
                       f"CLUSTERED BY (`{self.key}`) INTO {parts} BUCKETS{place}")

    def exists(self) -> bool:
        """Whether the catalog has the table, or its folder does and so the catalog does from now on."""
        if self.spark.catalog.tableExists(self.name):
            return True
        parts = self._stored_parts() if self.folder else None
        if parts is not None:
            self._create(parts)
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return parts is not None

    def create(self) -> DataFrame:
        """K2: create the table with the fixed target schema if it does not exist."""
        if not self.exists():
            self._create(self._new_parts)
        return self.current()

    def drop(self) -> None:
        """K7: drop the table, and the folder of an external one."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if self.folder:
            fs, path = self._folder(self.folder)
            fs.delete(path, True)

    def _described(self) -> dict[str, str]:
        return {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {self.name}").collect()}

    def part_count(self) -> int:
        return int(self._described()["Num Buckets"]) if self.exists() else self._new_parts

    def parts_for(self, rows: DataFrame) -> int:
        """The buckets of the table, or those that it is to get if these rows are its first."""
        if self.exists():
            return self.part_count()
        self._new_parts = self._asked or max(LEAST_PARTS, bucket_count(rows))
        return self._new_parts

    @property
    def root(self) -> str:
        """The folder of the table; its runs' CSV copies go beside it."""
        return self.folder or (self.create() and self._described()["Location"].rstrip("/"))

    # -- rows ------------------------------------------------------------------------------------
    def current(self, parts: list[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets; None when it was never created."""
        if not self.exists():
            return None
        rows = self.spark.table(self.name)
        return (rows if parts is None else rows.filter(F.col(PART).isin(parts))).drop(PART)

    def keys(self) -> DataFrame:
        """The key column of the table; an empty frame when it does not exist."""
        rows = self.current()
        return (self.spark.createDataFrame([], S.TARGET_SCHEMA) if rows is None else rows).select(self.key)

    def max_id(self) -> int | None:
        """Largest surrogate id, from the files' footers alone (0 without rows, None without a table)."""
        if not self.exists():
            return None
        place = self._described()["Location"]
        fs, path = self._folder(place)
        if not fs.exists(path):
            return 0                                     # an external table that nothing was written to
        return footer_aggregates(self.spark, place, S.TARGET_SCHEMA, F.max("id").alias("m")).first()["m"] or 0

    def _part_of(self, parts: int) -> Column:
        return F.pmod(F.hash(self.key), F.lit(parts)).cast("int").alias(PART)

    def _write(self, rows: DataFrame, parts: int, overwrite: bool, deal: bool) -> None:
        out = rows.select(*[f.name for f in S.TARGET_SCHEMA], self._part_of(parts))
        out = out.hint("rebalance", PART) if deal else out          # the rows of a bucket go together: few files
        with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            out.write.insertInto(self.name, overwrite=overwrite)

    def _append(self, rows: DataFrame, parts: int, stored: Stored) -> None:
        """Append rows of a stored table. If it is dealt into the buckets, none is shuffled: they are read bucket by bucket, a file each, or,
        where that would be much to sort, file by file."""
        small = stored.bytes <= SORTED * parts
        with _setting(self.spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false" if small else "true"):
            self._write(rows, parts, overwrite=False, deal=not (stored.dealt and (small or parts <= FEW)))

    @staticmethod
    def _required(rows: DataFrame, proven: Iterable[str] = ()) -> list[str]:
        """Required columns that may lack a value; fails if one isn't there at all."""
        required = [f.name for f in S.TARGET_SCHEMA if not f.nullable and f.name != "id"]
        absent = [c for c in required if c not in rows.columns]
        if absent:
            raise NullInRequiredColumn(f"no value in required columns {absent}")
        return [c for c in required if c not in set(proven)]

    def _stored(self, rows: DataFrame, required: list[str], parts: int) -> Stored:
        """The rows, written to the checkpoint folder in the table's buckets; fails if a required column lacks a value."""
        if not required:
            return materialize_by(rows, self.key, parts, unique=True)
        nulls = Observation(f"required_{uuid.uuid4().hex}")
        stored = materialize_by(rows.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required]), self.key, parts, unique=True)
        found = observed(nulls, **dict.fromkeys(required, 0))
        missing = [c for c in required if found[c]]
        if missing:
            raise NullInRequiredColumn(f"no value in required columns {missing}")
        return stored

    def insert(self, rows: DataFrame) -> None:
        """Append rows of the whole target schema as they are (an initial load); their keys must be new and unique."""
        parts = self.parts_for(rows)
        self.create()
        stored = self._stored(rows, [*self._required(rows), "id"], parts)
        self._append(stored.frame, parts, stored)

    def load(self, batch: DataFrame, load_time=None, check_keys: bool = True, update: bool = True, strategy: str = "auto",
             stored: Stored | None = None, proven: Iterable[str] = ()) -> dict:
        """K4-K6: insert the rows with new keys and, with ``update``, update the others; returns {"inserted", "updated"}.

        The batch is written once to the checkpoint folder, which fixes the ids of new rows; nothing is changed if one of its
        keys repeats (``check_keys``) or a required column lacks a value. ``stored``: the table that holds a batch stored with its
        rows numbered (``__seq``), which isn't written again. ``proven``: columns known to have values.
        """
        fresh = not self.exists()
        self.parts_for(batch)
        target, described = self.create(), self._described()
        parts = int(described.get("Num Buckets", 1))
        columns = [f.name for f in S.TARGET_SCHEMA]
        required = self._required(batch, proven)
        src = U.shape_batch(target, batch, self.key, load_time).withColumn(PART, self._part_of(parts))
        if not (stored and U.SEQ in batch.columns and not required):
            stored = self._stored(src, required, parts)
            src = stored.frame
        total, nbytes = stored.rows, stored.bytes
        if check_keys:
            U.check_unique_batch(src, self.key)
        if described.get("Provider", "parquet").lower() in ROW_LEVEL:
            return self._merge_into(src)
        base_id = (0 if fresh else self.max_id() or 0) + 1
        matched = {} if fresh else self._matched(src)
        touched, known = sorted(matched), sum(matched.values())
        if not update:
            src = src.join(target.select(self.key), self.key, "left_anti") if known else src
        elif touched:
            every = len(touched) == parts
            mine = src if every else src.filter(F.col(PART).isin(touched))
            merged = U.merge_staged(self.current(None if every else touched), mine.drop(PART), self.key, columns, base_id, nbytes,
                                    broadcast_limit(self.spark), strategy)
            self._write(merged, parts, overwrite=True, deal=False)
            src = None if every else src.filter(~F.col(PART).isin(touched))
        if src is not None and total > known:
            new = src.withColumn("id", F.lit(base_id) + F.col(U.SEQ))
            self._append(new, parts, stored)
        return {"inserted": total - known, "updated": known if update else 0}

    def _matched(self, src: DataFrame) -> dict[int, int]:
        """{bucket: keys of the batch that the table has there}: a join of key columns that doesn't shuffle the table."""
        own = self.spark.table(self.name).select(self.key)
        found = own.join(src.select(self.key, PART), self.key).groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
        return {r[PART]: r["n"] for r in found.collect()}

    def merge_sql(self, stage: str) -> str:
        """One MERGE INTO of a staged batch, for tables that take it: matched rows updated, others inserted."""
        columns = [f.name for f in S.TARGET_SCHEMA]
        updated = [c for c in columns if c not in ("id", self.key, "is_duplicate")]
        return (f"MERGE INTO {self.name} AS t USING {stage} AS s ON t.`{self.key}` = s.`{self.key}` "
                f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.`{c}` = s.`{c}`' for c in updated)} "
                f"WHEN NOT MATCHED THEN INSERT ({', '.join(f'`{c}`' for c in [*columns, PART])}) "
                f"VALUES ({', '.join(f's.`{c}`' for c in [*columns, PART])})")

    def _merge_into(self, src: DataFrame) -> dict:
        base_id = (self.spark.table(self.name).agg(F.max("id")).first()[0] or 0) + 1
        known = sum(self._matched(src).values())
        stage = f"{self.name.replace('.', '_')}_stage"
        src.withColumn("id", F.lit(base_id) + F.col(U.SEQ)).createOrReplaceTempView(stage)
        try:
            self.spark.sql(self.merge_sql(stage))
        finally:
            self.spark.catalog.dropTempView(stage)
        return {"inserted": src.count() - known, "updated": known}

"""Snapshots that are carried on: what is new, changed, gone or the same; only new and changed rows are processed.

In one batch snapshot_merge unites carried and processed rows. As a stream each micro-batch has rows that
came up, changed or went; its outcome is a folder named by its epoch, which a batch that
runs again after a failure replaces, and which counts once Spark has marked it as whole. So a run that
was killed and started again equals one run. Every so many epochs the folders up to then are one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructType

from ..session import written

#: Epochs after which the folders before become one.
COMPACT = 10

Process = Callable[[DataFrame], DataFrame]


def snapshot_diff(current: DataFrame, previous: DataFrame, key: str, sha: str = "body_sha") -> DataFrame:
    """key, change (new, changed, same, gone): three ways, null keys equal; a row without a hash is like another without one."""
    a = current.select(F.col(key).alias("_ka"), F.col(sha).alias("_ha"), F.lit(True).alias("_a"))
    b = previous.select(F.col(key).alias("_kb"), F.col(sha).alias("_hb"), F.lit(True).alias("_b"))
    both = a.join(b, F.col("_ka").eqNullSafe(F.col("_kb")), "full")
    change = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "gone").when(F.col("_ha").eqNullSafe(F.col("_hb")), "same").otherwise("changed")
    return both.select(F.when(F.col("_a").isNotNull(), F.col("_ka")).otherwise(F.col("_kb")).alias(key), change.alias("change"))


def snapshot_merge(current: DataFrame, previous: DataFrame, process: Process, key: str, sha: str = "body_sha", force: bool = False) -> DataFrame:
    """The next snapshot: rows of `previous` whose hash is the same as they were, and process(new and changed rows of current); `carried` tells which.

    Both tables have each key once. Rows that are gone are left out. The process gives the columns of
    `previous`, key and hash among them.
    """
    change = written(snapshot_diff(current, previous, key, sha))
    of = lambda *kinds: change.filter(F.col("change").isin(*kinds)).select(F.col(key).alias("_k"))
    there = lambda df, kinds: df.join(of(*kinds), F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    todo = current if force else there(current, ("new", "changed"))
    done = process(todo).select(*previous.columns).withColumn("carried", F.lit(False))
    return done if force else there(previous, ("same",)).withColumn("carried", F.lit(True)).unionByName(done)


class Epochs:
    """Folders of one stream's outcomes: delta/epoch=N of a batch, base/epoch=N of all up to one."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str) -> None:
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = StructType(list(schema.fields)).add("_gone", BooleanType()).add("_epoch", LongType())

    def whole(self, kind: str) -> list[int]:
        """Epochs whose folder Spark has marked as whole."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        store = top.getFileSystem(conf)
        if not store.exists(top):
            return []
        folders = [x.getPath() for x in store.listStatus(top)]
        return sorted(int(f.getName().partition("=")[2]) for f in folders if store.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))

    def before(self, epoch: int) -> DataFrame:
        """All rows as they stood before an epoch, gone ones too: of each key the last one."""
        base = max((b for b in self.whole("base") if b < epoch), default=None)
        paths = [f"{self.root}/delta/epoch={e}" for e in self.whole("delta") if e < epoch and (base is None or e > base)]
        paths += [f"{self.root}/base/epoch={base}"] if base is not None else []
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        cols = [c for c in self.schema.names if c != self.key]
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*cols), "_epoch").alias("_r")).select(self.key, "_r.*").select(*self.schema.names)

    def put(self, epoch: int, rows: DataFrame, compact: int) -> None:
        rows.withColumn("_epoch", F.lit(epoch).cast("bigint")).select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/delta/epoch={epoch}")
        if compact and epoch % compact == compact - 1:
            self.before(epoch + 1).filter(~F.col("_gone")).write.mode("overwrite").parquet(f"{self.root}/base/epoch={epoch}")

    def now(self) -> DataFrame:
        return self.before(1 << 62).filter(~F.col("_gone")).drop("_gone", "_epoch")


def run_snapshots(spark: SparkSession, source: str, schema: StructType, process: Process, out: StructType, root: str, checkpoint: str, key: str = "lesson_id", sha: str = "body_sha", order: str = "seq", gone: str = "gone", files: int | None = None, compact: int = COMPACT) -> StreamingQuery:
    """Process what has come up in `source` (Parquet) since the last run, and stop; now_of() reads the outcome.

    source rows: key, hash, `gone` (true: the key is no more), `order` (of rows of one key in one
    batch the last counts) and what `process` needs, which gives the columns of `out`. Rows whose hash is
    that of their key's last outcome are not processed. One checkpoint belongs to one root.
    """
    epochs = Epochs(spark, root, out, key)

    def batch(rows: DataFrame, epoch: int) -> None:
        cols = [c for c in rows.columns if c != key]
        last = written(rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(F.col(order))).alias("_r")).select(key, "_r.*"))
        held = epochs.before(epoch).filter(~F.col("_gone")).select(F.col(key).alias("_k"), F.col(sha).alias("_h"), F.lit(True).alias("_there"))
        known = last.join(held, F.col(key).eqNullSafe(F.col("_k")), "left")
        is_gone = F.coalesce(F.col(gone), F.lit(False))
        todo = known.filter(~is_gone & ~(F.col("_there").isNotNull() & F.col(sha).eqNullSafe(F.col("_h")))).select(*rows.columns)
        went = known.filter(is_gone & F.col("_there").isNotNull()).select(F.col(key).alias("_k"))
        ended = epochs.before(epoch).join(went, F.col(key).eqNullSafe(F.col("_k")), "left_semi").withColumn("_gone", F.lit(True))
        made = process(todo).select(*out.names).withColumns({"_gone": F.lit(False), "_epoch": F.lit(epoch).cast("bigint")})
        epochs.put(epoch, made.unionByName(ended), compact)

    stream = spark.readStream.schema(schema)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    query = stream.parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def now_of(spark: SparkSession, root: str, out: StructType, key: str = "lesson_id") -> DataFrame:
    """All rows of a stream's outcomes as they stand."""
    return Epochs(spark, root, out, key).now()

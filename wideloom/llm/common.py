"""Helpers shared by the operators: scratch tables in the shared folder, row keys, global order.

Lineage is cut by writing a Parquet table under ``spark.checkpoint.dir`` (see
``wideloom.session.scratch_dir``), never with a local checkpoint, so a lost executor costs the
recomputation of one job's own tasks only. Ids made by ``monotonically_increasing_id`` are always
stored before two plans refer to them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wideloom.session import scratch_dir

# The ASCII white space that all contracts name, [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Scratch:
    """One run's folder of intermediate tables below the shared scratch folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/wideloom-llm/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it read back (its schema is kept, also when it has no row)."""
        df.write.parquet(self.path(name))          # a name is used once; a second use is an error
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, _UPPER, _UPPER.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed_rows(scratch: Scratch, docs: DataFrame, name: str = "staged") -> DataFrame:
    """``docs`` as (row, rec struct of all its columns): a key that is unique also for repeated or
    null ids, and a record that cannot clash with the columns of an operator.

    A whole table read from Parquet files is keyed by the scan (hash of the file's path, row in the
    file), so no copy of its texts is stored. Any other frame is stored once and keyed by a number.
    """
    rec = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec")
    row = _scan_row(docs)
    if row is not None:
        return docs.select(row.alias("row"), rec)
    return scratch.table(docs.select(F.monotonically_increasing_id().alias("row"), rec), name)


def _scan_row(docs: DataFrame) -> Column | None:
    """Key of a row by its place in its file, or None unless ``docs`` is each row of its files once
    (one small row per file: its indexes must be 0, 1, ..., and path hashes must not repeat)."""
    try:
        meta = docs.metadataColumn("_metadata")
        row = F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at"))
        at = docs.select(meta["file_path"].alias("path"), row["at"].cast("decimal(19,0)").alias("at"))
    except AnalysisException:                        # not a scan of Parquet files
        return None
    n = F.count("*").cast("decimal(19,0)")
    files = at.groupBy("path").agg(
        (F.max("at") + 1 == n) & (F.sum("at") * 2 == n * (n - 1)) & (F.count("at") == F.count("*")))
    files = files.toDF("path", "whole")
    ok = files.agg(F.count("*"), F.count_distinct(F.xxhash64("path")), F.bool_and("whole")).first()
    return row if ok[0] == ok[1] and ok[2] is not False else None


def global_order(scratch: Scratch, df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``at`` (long): 0, 1, 2, ... in the given order, without one task for all rows.

    A range-partitioned sort is stored with the partition and position of each row; the offsets
    are running sums over one row per partition (bounded by the shuffle partitions, so broadcast).
    """
    mid = F.monotonically_increasing_id()
    kept = scratch.table(df.orderBy(*order).withColumn("at", mid), name)
    part = F.shiftright("at", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # one struct array of one row per partition, folded into offsets
    offsets = sizes.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("a")).select(
        F.explode(F.transform("a", lambda x, i: F.struct(
            x["part"].alias("part"),
            F.aggregate(F.slice("a", 1, i), F.lit(0).cast("bigint"), lambda s, y: s + y["n"])
            .alias("before")))).alias("o")).select("o.part", "o.before")
    return (kept.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("at", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "before"))

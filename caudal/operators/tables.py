"""Tables laid out by partition, and loads that read and rewrite only the partitions a batch touches (LOAD1, LOAD3, ST1, SP5).

The partition columns follow from a row's id: parts of the natural key (a day, a code), or ``id_bucket`` where the key has
none that fits. A row with an id can then lie in one partition only, so a batch needs no other to know what it holds.
A batch is staged once (written to the shared folder), so its rows are not computed again for each use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators.load import insert_if_absent, last_per_id, upsert
from caudal.session import scratch_path

#: Partitions of a batch that are named in a filter; a batch of more reads the table through a semi-join.
MAX_NAMED = 2000


def id_bucket(id_col: str = "id", buckets: int = 256) -> Column:
    """Bucket of an id, for tables whose key has no column to lay it out by."""
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def stage(rows: DataFrame, name: str = "batch") -> DataFrame:
    """The rows, written to the shared folder and read back."""
    path = scratch_path(rows.sparkSession, f"staged/{name}-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append(rows: DataFrame, path: str, partition: list[str]) -> None:
    """Append rows to a table, a file per partition and task."""
    rows.write.mode("append").partitionBy(*partition).parquet(path)


def read_touched(table: DataFrame, batch: DataFrame, partition: list[str]) -> DataFrame:
    """Rows of ``table`` in the partitions that ``batch`` (staged) has rows in.

    The batch's partitions are named in a filter on the partition columns, so the scan lists and opens no other.
    """
    touched = batch.select(*partition).distinct().limit(MAX_NAMED + 1).collect()
    if len(touched) > MAX_NAMED:
        return table.join(batch.select(*partition).distinct(), partition, "left_semi")
    kinds = {c: batch.schema[c].dataType for c in partition}
    for c in partition:  # each column alone prunes; the row test below is exact for several
        values = {r[c] for r in touched}
        known = [F.lit(v).cast(kinds[c]) for v in values if v is not None]
        test = F.col(c).isin(known) if known else F.lit(False)
        table = table.where(test | F.col(c).isNull() if None in values else test)
    if len(partition) > 1:
        table = table.join(F.broadcast(batch.sparkSession.createDataFrame(touched, batch.select(*partition).schema)), partition, "left_semi")
    return table


def new_rows(batch: DataFrame, table: DataFrame, partition: list[str], id_col: str = "id", order_col: str = "pos") -> DataFrame:
    """LOAD1: rows of a staged batch to append: the first of each id that the table does not hold."""
    known = read_touched(table, batch, partition).select(id_col)
    return insert_if_absent(batch, known, id_col, order_col)


def load_new(rows: DataFrame, path: str, partition: list[str], id_col: str = "id", order_col: str = "pos") -> None:
    """LOAD1 into the table at ``path`` (which exists): a repeated load of the same rows adds nothing."""
    batch = stage(rows)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    append(new_rows(batch, table, partition, id_col, order_col), path, partition)


def merge_last(spark: SparkSession, path: str, updates: DataFrame, partition: list[str], id_col: str = "id",
               order_col: str | None = None) -> None:
    """LOAD3: the last row of each id among ``updates`` (by ``order_col``, or as they come) replaces or joins the table's.

    Only the partitions that hold a changed id are read and written again (dynamic partition overwrite). The merged
    partitions are staged first: if the overwrite fails, nothing of them is lost.
    """
    table = spark.read.parquet(path)
    batch = stage(last_per_id(updates, id_col, order_col), "updates")
    merged = stage(upsert(read_touched(table, batch, partition), batch, id_col), "merged")
    (merged.repartition(*partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition).parquet(path))

"""Stored tables kept current by keyed merge.

Below a table's path stand ``rows/`` (Parquet, partitioned by a function of the key), ``merged/`` (what the last
batch turned its partitions into, partitioned alike) and ``state/`` (how far that batch got). A batch reads and rewrites
only the partitions it touches. Their new content is written out in full, once, before any stored one is replaced by it, so
a run that dies between the two steps is finished by ``resume`` from what is on disk.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sharefold.feeds import FeedSpec
from sharefold.operators.merge import FIRST, LAST, fold_by_key, upsert

MERGED, APPLIED = "merged", "applied"

# A first load is counted by partition and this many cells of the key's hash. A cell of more than CELL_ROWS rows collapses
# before it is dealt; a task gets no more than about TASK_ROWS rows of one partition.
CELLS, CELL_ROWS, TASK_ROWS = 64, 1_000_000, 500_000


def is_there(spark: SparkSession, path: str) -> bool:
    """Is there anything below ``path``, on whatever file system it names?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(place) and files.listStatus(place).__len__() > 0


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The files at ``path``, None when there are none yet; a known schema saves the job that reads it."""
    if not is_there(spark, path):
        return None
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as missing:
        # A folder with a mark of success and no rows.
        if missing.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_stored(spark: SparkSession, path: str, hidden: bool = False) -> DataFrame | None:
    """The stored table, or None when nothing was stored yet."""
    rows = read_if_there(spark, f"{path}/rows")
    if rows is None:
        # A first batch without good rows leaves no partition to read the columns from.
        merged = read_if_there(spark, f"{path}/merged")
        rows = None if merged is None else merged.where(F.lit(False))
    return rows if rows is None or hidden else rows.drop(FIRST, LAST)


def _note(spark: SparkSession, path: str, step: str) -> None:
    spark.range(1).select(F.lit(step).alias("step")).write.mode("overwrite").parquet(f"{path}/state")


def _apply(spark: SparkSession, path: str, partition: str) -> None:
    """Puts the merged partition folders in the place of the stored ones. Each is renamed, so its rows are not written again;
    a run that dies here finds the folders that are still to move where they were."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    merged, rows = make(f"{path}/merged"), make(f"{path}/rows")
    files = merged.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(rows)
    for status in files.listStatus(merged):
        folder = status.getPath()
        if status.isDirectory() and folder.getName().startswith(f"{partition}="):
            old = make(rows, folder.getName())
            files.delete(old, True)
            if not files.rename(folder, old):
                raise OSError(f"{folder} could not be moved to {old}")
    _note(spark, path, APPLIED)


def resume(spark: SparkSession, path: str, partition: str) -> bool:
    """Finishes a batch that was merged but not applied; tells whether there was one."""
    state = read_if_there(spark, f"{path}/state", T.StructType([T.StructField("step", T.StringType())]))
    left = None if state is None else state.head()
    if left is None or left.step != MERGED:
        return False
    _apply(spark, path, partition)
    return True


def pin(small: DataFrame, path: str, **options: str) -> DataFrame:
    """A look-up written out and read back, so that Spark knows its size when it plans a join with it: it
    broadcasts the look-up only below the session's threshold, and shuffles otherwise."""
    small.write.mode("overwrite").options(**options).parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def touched_partitions(incoming: DataFrame, partition: str, path: str) -> DataFrame:
    """The partitions that ``incoming`` touches, with its rows in each. Written out: one row per partition folder."""
    return pin(incoming.groupBy(partition).agg(F.count(F.lit(1)).alias("rows")), f"{path}/touched")


def stored_in(stored: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Stored rows of exactly the partitions in ``touched``, NULL among them.

    The list joins the stored table on its partition column by plain equality, so dynamic partition pruning skips every
    other folder before it is opened. A null never equals another: where the list has it, its folder is a branch of its own.
    """
    listed = touched.where(F.col("rows") > 0).select(F.col(partition).alias("_touched"))
    known = stored.join(listed, F.col(partition) == F.col("_touched"), "left_semi")
    if touched.where(F.col(partition).isNull()).isEmpty():
        return known
    return known.unionByName(stored.where(F.col(partition).isNull()))


def _changes(stored: DataFrame, incoming: DataFrame, key: tuple[str, ...], sticky: tuple[str, ...]) -> DataFrame:
    """Rows of ``incoming``, one per key, that are new or differ from the stored row in a column that can change."""
    arrived = fold_by_key(incoming, key, sticky)
    compared = [c for c in arrived.columns if c not in {*sticky, FIRST, LAST}]
    known = stored.select(*[F.col(c).alias(f"_known_{c}") for c in compared])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in compared]
    return arrived.join(known, same, "left_anti")


def fold_dealt(incoming: DataFrame, key: tuple[str, ...], sticky: tuple[str, ...], partition: str, path: str) -> DataFrame:
    """One row per key, as ``fold_by_key`` gives it, with the rows of a partition together in few tasks: ready to be written.

    Rows move once: they are dealt by partition and a part of the key's hash, and fold where they arrive. A key with very
    many rows would make a long task of that; the cells such keys lie in collapse before they move and are dealt after.
    """
    marked = incoming.withColumn("_cell", F.pmod(F.xxhash64(*key), F.lit(CELLS)).cast("int"))
    cells = pin(marked.groupBy(partition, "_cell").agg(F.count(F.lit(1)).alias("rows")), f"{path}/cells")
    most = cells.groupBy(partition).agg(F.sum("rows").alias("rows")).agg(F.max("rows")).head()[0] or 0
    parts = max(1, min(CELLS, -(-most // TASK_ROWS)))
    full = cells.where(F.col("rows") > CELL_ROWS).select(F.col(partition).alias("_full"), F.col("_cell").alias("_full_cell"))
    inside = F.col(partition).eqNullSafe(F.col("_full")) & (F.col("_cell") == F.col("_full_cell"))
    crowded = not full.isEmpty()
    few = marked.join(full, inside, "left_anti") if crowded else marked
    dealt = few.withColumn("_part", F.col("_cell") % parts).drop("_cell").repartition(partition, "_part")
    # Both are functions of the key. In front, they keep the rows of a partition side by side.
    folded = fold_by_key(dealt, (partition, "_part", *[k for k in key if k != partition]), sticky).drop("_part")
    if not crowded:
        return folded
    many = fold_by_key(marked.join(full, inside, "left_semi").drop("_cell"), key, sticky)
    return folded.unionByName(many.hint("rebalance", partition))


def merge_into_table(
    incoming: DataFrame,
    path: str,
    key: tuple[str, ...],
    sticky: tuple[str, ...],
    partition: str,
    only_changes: bool = False,
    watch: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Folds a batch into the table at ``path``; one writer at a time.

    ``incoming`` carries arrivals (``with_arrival``), which makes a repeated batch harmless, and is read twice:
    pass a written table. ``partition`` must be a function of ``key``, else a key could live in two places.

    ``only_changes`` leaves rows out that say what is stored already, so that partitions without a change are read
    but not rewritten. Such a row does not count as the newest arrival of its key: batches must then come in order.

    ``watch`` names aggregates over the merged rows, arrivals among their columns. They are taken while the rows are
    written and returned.
    """
    spark = incoming.sparkSession
    resume(spark, path, partition)
    stored = read_if_there(spark, f"{path}/rows", incoming.schema)
    if stored is not None:
        everything = stored.select(*incoming.columns)
        stored = stored_in(everything, touched_partitions(incoming, partition, path), partition)
        if only_changes:
            incoming = pin(_changes(stored, incoming, key, sticky), f"{path}/changed")
            stored = stored_in(everything, touched_partitions(incoming, partition, path), partition)
    seen = Observation()
    # Rows of one partition come together here, a large one in several tasks, so writing needs no further shuffle.
    if stored is None:
        dealt = fold_dealt(incoming, key, sticky, partition, path)
    else:
        dealt = upsert(stored, incoming, key, sticky).hint("rebalance", partition)
    schema = dealt.schema
    # Observed last: what stands below an exchange is lost from the plan when no row passes it.
    dealt = dealt.observe(seen, *[total.alias(name) for name, total in watch.items()]) if watch else dealt
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(partition).parquet(f"{path}/merged")
    _note(spark, path, MERGED)
    _apply(spark, path, partition)
    if not is_there(spark, f"{path}/rows"):
        # Without a row there is no folder; the columns are kept for who reads the table.
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/merged")
    return seen.get if watch else {}


def merge_feed(
    incoming: DataFrame,
    path: str,
    spec: FeedSpec,
    extra_keys: tuple[str, ...] = (),
    only_changes: bool = False,
    watch: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """``merge_into_table`` with a feed's key. ``extra_keys`` splits keys further, such as by holder."""
    sticky = tuple(c for c in spec.sticky if c not in extra_keys)
    return merge_into_table(incoming, path, (*spec.key, *extra_keys), sticky, spec.partition, only_changes, watch)

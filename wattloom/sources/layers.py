"""Layered table storage, incremental append, upsert by key and schema alignment."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import store

LAYERS = ("bronze", "silver", "gold", "ops")


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def balanced(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Spread rows for a partitioned write: few files per value, and a value with very many rows split."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_full(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full-refresh materialization."""
    balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, name))


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table in the union of its files' layouts; None only where the path is absent or holds no file yet, any other fault is raised."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def high_water(target: DataFrame | None, column: str, partition_column: str | None = None):
    """Highest value of ``column``; with a partition column that rises with it, from the last partition only."""
    if target is None:
        return None
    if partition_column:
        last = target.agg(F.max(partition_column)).first()[0]
        target = target.where(F.col(partition_column) == F.lit(last))
    return target.agg(F.max(column)).first()[0]


def after_high_water(source: DataFrame, target: DataFrame | None, column: str, floor: str = "1900-01-01",
                     partition_column: str | None = None, inclusive: bool = False) -> DataFrame:
    """Source rows whose ``column`` lies after the highest value in the target.

    The mark is one value, read first, so the comparison reaches the scan as a pushed filter. An empty
    or absent target counts as ``floor``.
    """
    mark = high_water(target, column, partition_column)
    edge = F.lit(mark if mark is not None else floor).cast(source.schema[column].dataType)
    return source.where(F.col(column) >= edge if inclusive else F.col(column) > edge)


def late_rows(source: DataFrame, target: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Rows at or below the high-water mark that the target never saw: what a plain append would lose."""
    mark = target.agg(F.max(column)).first()[0]
    kind = source.schema[column].dataType
    behind = source.where(F.col(column) <= F.lit(mark).cast(kind))
    return behind.join(target.select(*keys), keys, "left_anti")


def unseen_rows(source: DataFrame, target: DataFrame | None, keys: list[str], partition_column: str) -> DataFrame:
    """Source rows whose key the target does not hold, however old they are.

    Only the target's partitions that the source touches are read; ``partition_column`` must follow from the key.
    """
    if target is None:
        return source
    touched = target.join(source.select(partition_column).distinct(), partition_column, "left_semi")
    return source.join(touched.select(*keys), keys, "left_anti")


def align_to(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Give ``df`` the columns of ``wanted``: new ones as NULL, removed ones dropped."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.schema])


def merge_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target with matching keys replaced and the rest inserted, in the layout of ``updates``."""
    kept = align_to(target.join(updates.select(*keys), keys, "left_anti"), updates)
    return updates.unionByName(kept)


def newest_rows(df: DataFrame, keys: list[str], newest_by: str) -> DataFrame:
    """One row per key: the one with the highest ``newest_by``."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest_by).alias("newest"))
            .select(*keys, "newest.*").select(*df.columns))


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; of several, the one with the greatest values, so that a re-run keeps the same one."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("kept")).select(*keys, "kept.*").select(*df.columns)


def upsert_partitions(updates: DataFrame, path: str, keys: list[str], partition_column: str,
                      newest_by: str | None = None, listed_partitions: int = 10_000) -> None:
    """Upsert into a partitioned table, rewriting only the partitions that the updates touch.

    ``partition_column`` must follow from the key (the day of a key timestamp), so a key never moves
    between partitions. The touched partitions are listed, so that the others are not even opened; a
    list beyond ``listed_partitions`` turns into a semi join. The merged rows go through the scratch
    folder, because a table cannot be read and overwritten in one job.

    Updates win over stored rows. With ``newest_by`` the row with the higher value wins instead, so an
    update that arrives late does not undo a newer one; the updates may then repeat a key. Without it, updates that repeat a key raise ValueError,
    as nothing says which one counts.
    """
    spark = updates.sparkSession
    if newest_by:
        updates = newest_rows(updates, keys, newest_by)
    target = read_if_present(spark, path)
    updates = store(updates, "updates")
    if not newest_by and not updates.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"updates repeat a key {keys}; name the column that tells the newest")
    if target is None:
        write_full(updates, path, (partition_column,))
        return
    touched = updates.select(partition_column).distinct()
    listed = [row[0] for row in touched.limit(listed_partitions + 1).collect()]
    if not listed:
        return
    if len(listed) <= listed_partitions:
        target = target.where(F.col(partition_column).isin(listed))
    else:
        target = target.join(touched, partition_column, "left_semi")
    if newest_by:
        rows = newest_rows(updates.unionByName(align_to(target, updates)), keys, newest_by)
    else:
        rows = merge_rows(target, updates, keys)
    merged = balanced(store(rows, "merged"), (partition_column,))
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_column).parquet(path))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one scan each."""
    counts = None
    for name, df in tables.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        counts = part if counts is None else counts.unionByName(part)
    return counts.orderBy("table_name")

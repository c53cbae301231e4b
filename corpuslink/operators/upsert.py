"""Duplicate policies, ids and constraint checks (O-10..O-19).

First/last-wins use ``min_by``/``max_by`` aggregates instead of a window: the
partial aggregate runs before the shuffle, so a key holding a third of all rows
is reduced map-side instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPY_BLOCK = 65_536     # copies of one row written out at a time


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _pick_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                  last: bool) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.select(*keys).distinct()
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in rest])
    return (batch.groupBy(*keys).agg(pick(row, _order_struct(order)).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of every key under ``order`` (first wins)."""
    return _pick_per_key(batch, keys, order, last=False)


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of every key under ``order`` (last wins)."""
    return _pick_per_key(batch, keys, order, last=True)


def with_default(df: DataFrame, col: str, value) -> DataFrame:
    """O-17: a missing value takes the column default (votes = 0)."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """O-10: insert-or-ignore. Returns (new target, inserted rows).

    Rows whose key is already in the target, or that repeat a key earlier in
    the batch, are ignored. ``inserted.count()`` is the reference's rowcount.
    """
    firsts = first_per_key(batch, keys, order)
    inserted = firsts.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(inserted.select(*target.columns)), inserted


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
           id_col: str | None = None) -> DataFrame:
    """O-11: insert-or-replace (last wins). With ``id_col`` a replaced key keeps
    the target's id (D5) instead of receiving a new one."""
    lasts = last_per_key(batch, keys, order)
    if id_col:
        old = target.select(*keys, F.col(id_col).alias("_old_id"))
        lasts = (lasts.join(old, list(keys), "left")
                 .withColumn(id_col, F.coalesce("_old_id", id_col)).drop("_old_id"))
    kept = target.join(lasts.select(*keys), list(keys), "left_anti")
    return kept.unionByName(lasts.select(*target.columns))


def insert_strict(batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """O-12: the first row per key is kept, every other row is a reject, so kept and
    rejects together are the batch. Rows that tie in ``order`` are ordered by all their
    columns; of equal rows one is kept.

    Equal rows are counted before the shuffle and rejects come from a join against the
    one-row-per-key firsts (AQE splits a hot key on the batch side) rather than a window
    over the whole key.
    """
    cols = list(batch.columns)
    whole = F.struct(*cols)
    counted = batch.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    firsts = batch.groupBy(*keys).agg(F.min(F.struct(_order_struct(order).alias("o"),
                                                     whole.alias("row")))["row"].alias("_first"))
    mark = firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    same_key = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    left = counted.join(mark, same_key).withColumn(
        "_n", F.col("_n") - whole.eqNullSafe(F.col("_first")).cast("long")).filter("_n > 0")
    # the copies in blocks: no row ever holds an array as long as a hot key
    blocks = left.withColumn("_b", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1)
                                                                         / COPY_BLOCK))))
    rejects = blocks.withColumn("_c", F.explode(F.sequence(F.lit(1), F.least(
        F.col("_n") - F.col("_b") * COPY_BLOCK, F.lit(COPY_BLOCK))))).select(*cols)
    return firsts.select(*[F.col("_first")[c].alias(c) for c in cols]), rejects


def assign_ids(df: DataFrame, order: Sequence[str], id_col: str = "id",
               num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """O-13: dense ids 1..N following ``order`` (which must be a total order).

    A global ``row_number`` would run in one task. Instead: range-partition on
    the order, number rows inside each partition, and add the row count of all
    earlier partitions.

    The range bounds come from a sample seeded by the RDD id, so two plans over
    the same input may cut it differently. The numbered partitions are
    therefore written once with a reliable ``checkpoint()`` (into the shared
    ``spark.checkpoint.dir``) and both the counts and the ids read that copy.
    """
    from corpuslink.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    # Offsets: one row per partition, a proven bound (n rows), so broadcast.
    sizes = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                       F.min("_mid").alias("_first_mid"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (parted.join(F.broadcast(offsets.select("_pid", "_off", "_first_mid")), "_pid")
            .withColumn(id_col, (F.col("_off") + F.col("_mid") - F.col("_first_mid")
                                 + F.lit(start)).cast("long"))
            .drop("_pid", "_mid", "_off", "_first_mid"))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """O-14: keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-15: NULL count of every column in one pass (one row)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def check_domain(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """O-16: rows whose value is outside the allowed set (NULL is left to O-15)."""
    return df.filter(~F.col(col).isin(list(values)))


def resolve_key(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                value_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """O-18: look up ids by name; returns (resolved rows, rows whose key is unknown)."""
    on = [on] if isinstance(on, str) else list(on)
    d = dim.select(*on, *value_cols)
    return df.join(d, on, "inner"), df.join(d.select(*on), on, "left_anti")


def check_fk(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
             parent_cols: Sequence[str]) -> DataFrame:
    """O-19: child rows whose reference has no parent."""
    cond = [child[c] == parent[p] for c, p in zip(child_cols, parent_cols)]
    return child.join(parent, cond, "left_anti")

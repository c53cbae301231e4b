"""Resharding by minimum-cost flow.

Old shards are stored as blocks: files of about ``block_bytes``. From the bytes of the
old shards and the capacities of the new ones, a minimum-cost flow (cost 0 for a byte
that stays, 1 or a given price for one that moves) says how many bytes go from where to
where; it runs on shard totals alone, so its size is the number of shards, never of
rows. Whole blocks are dealt to the flow in order; only blocks that a boundary cuts are
split, between documents, largest document first, so that a cut falls between small
ones. Blocks that stay whole in their shard are not rewritten.

Nulls, empties, ties: a null text counts 1 byte and stays null. A null shard key belongs
to old shard 0. Equal rows are ordered by id and then arbitrarily, since they are
interchangeable. Extra columns pass through under their names, those with one of the operator's
own (``OWN``) with ``_own`` behind it. An empty table gives empty shards.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from corpuslink.llm.scratch import new_folder, written

BLOCK_BYTES = 32 << 20
MAX_BROADCAST_BLOCKS = 50_000                 # some 5 MB of block rows
BLOCK = ("_rs_shard", "_rs_block")
OWN = (*BLOCK, "_rs_new", "_rs_slot", "_rs_before", "_rs_to", "_rs_size", "_rs_mid", "_rs_base",
       "_rs_row")


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]
                  ) -> list[list[int]]:
    """Bytes from each old to each new shard, all supply placed, least total cost, by
    successive shortest paths with potentials. Costs must not be negative."""
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards are too small")
    m, n = len(supply), len(capacity)
    flow = [[0] * n for _ in range(m)]
    left, room = list(supply), list(capacity)
    height = [0] * (m + n)                    # potentials of old, then new shards
    while any(left):
        best = [None] * (m + n)
        came = [-1] * (m + n)
        heap = [(0, i) for i in range(m) if left[i]]
        dist = {i: 0 for _, i in heap}
        while heap:
            d, v = heapq.heappop(heap)
            if best[v] is not None:
                continue
            best[v] = d
            if v < m:
                steps = [(m + j, cost[v][j]) for j in range(n)]
            else:
                steps = [(i, -cost[i][v - m]) for i in range(m) if flow[i][v - m]]
            for w, c in steps:
                to = d + c + height[v] - height[w]
                if best[w] is None and to < dist.get(w, to + 1):
                    dist[w] = to
                    came[w] = v
                    heapq.heappush(heap, (to, w))
        end = min((m + j for j in range(n) if room[j] and best[m + j] is not None),
                  key=lambda v: best[v] + height[v])
        far = best[end]
        height = [h + (far if b is None else min(b, far)) for h, b in zip(height, best)]
        path, v = [end], end
        while came[v] >= 0:
            v = came[v]
            path.append(v)
        path.reverse()
        moved = min([left[path[0]], room[end - m]] + [
            flow[w][v - m] for v, w in zip(path, path[1:]) if v >= m])
        for v, w in zip(path, path[1:]):
            if v < m:
                flow[v][w - m] += moved
            else:
                flow[w][v - m] -= moved
        left[path[0]] -= moved
        room[end - m] -= moved
    return flow


def text_bytes(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 1


def stored(name: str) -> str:
    """The name under which a column is kept."""
    return f"{name}_own" if name in OWN else name


def write_blocks(docs: DataFrame, shard: Column, n_shards: int, path: str, *,
                 id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> None:
    """Store ``docs`` as old shards: folders ``_rs_shard=i/_rs_block=b``."""
    sized = docs.select(*[F.col(f"`{c}`").alias(stored(c)) for c in docs.columns], F.coalesce(
        F.pmod(shard, F.lit(n_shards)), F.lit(0)).cast("int").alias("_rs_shard"))
    bytes_of = {r[0]: r[1] for r in sized.groupBy("_rs_shard").agg(
        F.sum(text_bytes(text_col))).collect()}              # a row per old shard
    blocks = F.create_map(*[F.lit(x) for i in range(n_shards)
                            for x in (i, max(1, -(-bytes_of.get(i, 1) // block_bytes)))])
    sized.withColumn("_rs_block", F.pmod(F.xxhash64(f"`{id_col}`", f"`{text_col}`"),
                                         blocks[F.col("_rs_shard")]).cast("int")).repartition(
        "_rs_shard", "_rs_block").write.partitionBy("_rs_shard", "_rs_block").option(
        "compression", "zstd").parquet(path)


def transfers(totals: dict[int, int], n_new: int, capacity: list[int] | None = None,
              cost: list[list[int]] | None = None) -> list[tuple[int, int, int, int]]:
    """(old, new, from, to): byte ranges of each old shard's order that go to a new one;
    the range that stays comes first."""
    m = max([*totals, n_new - 1]) + 1
    supply = [totals.get(i, 0) for i in range(m)]
    total = sum(supply)
    if capacity is None:
        capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    if cost is None:
        cost = [[int(i != j) for j in range(n_new)] for i in range(m)]
    out = []
    for i, row in enumerate(min_cost_flow(supply, capacity, cost)):
        at = 0
        for j in sorted(range(n_new), key=lambda j: (j != i, j)):
            if row[j]:
                out.append((i, j, at, at + row[j]))
                at += row[j]
    return out


def reshard(spark: SparkSession, path: str, out_path: str, schema: StructType, n_new: int, *,
            id_col: str = "doc_id", text_col: str = "text",
            capacity: list[int] | None = None, cost: list[list[int]] | None = None) -> DataFrame:
    """Move documents (``schema``: their columns) to the new shards. Returns all rows with
    ``_rs_new`` (the shard) and ``_rs_shard``, ``_rs_block`` (the block they came from).

    Rows of blocks that stay are read where they are; only blocks that move or are split
    are written again, under ``out_path``.
    """
    names = [stored(c) for c in schema.names]
    fields = [StructField(stored(f.name), f.dataType) for f in schema.fields]
    whole = StructType([*fields, *(StructField(c, IntegerType()) for c in BLOCK)])
    old = spark.read.schema(whole).parquet(path)
    blocks = written(old.groupBy(*BLOCK).agg(F.sum(text_bytes(text_col)).alias("bytes")), "blocks")
    totals = {r[0]: r[1] for r in blocks.groupBy("_rs_shard").agg(F.sum("bytes")).collect()}
    ranges = spark.createDataFrame(transfers(totals, n_new, capacity, cost),
                                   "shard int, _rs_new int, low long, high long")
    # a row per block: a window of one old shard's blocks, not of its documents
    order = Window.partitionBy("_rs_shard").orderBy("_rs_block")
    placed = blocks.withColumn("_rs_before", F.sum("bytes").over(order) - F.col("bytes"))
    dealt = placed.join(F.broadcast(ranges), (F.col("_rs_shard") == F.col("shard"))
                        & (F.col("_rs_before") < F.col("high"))
                        & (F.col("_rs_before") + F.col("bytes") > F.col("low")))
    share = written(dealt.groupBy(*BLOCK, "_rs_before").agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "_rs_new"))).alias("_rs_to")), "transfers")
    first = F.col("_rs_to")[0]["_rs_new"]
    one = F.size("_rs_to") == 1
    stays, moves = one & (first == F.col("_rs_shard")), one & (first != F.col("_rs_shard"))

    def rows_of(which: Column) -> DataFrame:
        """The documents of some blocks. Blocks are files, so their rows are few; only
        beyond that does the join shuffle documents."""
        some = share.where(which)
        return old.join(F.broadcast(some) if some.count() <= MAX_BROADCAST_BLOCKS else some,
                        list(BLOCK))

    # documents of split blocks: a window of one block at a time
    inside = Window.partitionBy(*BLOCK).orderBy(F.col("_rs_size").desc(), F.col(f"`{id_col}`"))
    cut = rows_of(~one).withColumn("_rs_size", text_bytes(text_col)).withColumn(
        "_rs_mid", F.col("_rs_before") + F.sum("_rs_size").over(inside) - F.col("_rs_size") / 2)
    target = F.coalesce(F.get(F.filter("_rs_to", lambda t: (t["low"] <= F.col("_rs_mid"))
                                       & (F.col("_rs_mid") < t["high"])), F.lit(0)),
                        F.element_at("_rs_to", -1))["_rs_new"]
    out = [*(f"`{c}`" for c in names), *BLOCK, "_rs_new"]
    cut.withColumn("_rs_new", target).select(*out).unionByName(
        rows_of(moves).withColumn("_rs_new", first).select(*out)
    ).write.option("compression", "zstd").parquet(out_path)
    again = spark.read.schema(StructType([*whole.fields, StructField("_rs_new", IntegerType())])
                              ).parquet(out_path)
    return rows_of(stays).withColumn("_rs_new", first).select(*out).unionByName(again.select(*out))


def with_slots(rows: DataFrame, id_col: str) -> DataFrame:
    """Adds ``_rs_slot``, gapless from 0 within each new shard: the rows of the shard's
    earlier pieces (a piece: what one old block gave it) and the place within the piece."""
    piece = ["_rs_new", *BLOCK]
    sizes = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("_rs_new").orderBy(*BLOCK)
    base = sizes.select(*piece, (F.sum("n").over(order) - F.col("n")).alias("_rs_base"))
    number = F.row_number().over(Window.partitionBy(*piece).orderBy(f"`{id_col}`")) - 1
    return rows.withColumn("_rs_row", number).join(base, piece).withColumn(
        "_rs_slot", F.col("_rs_base") + F.col("_rs_row")).drop("_rs_row", "_rs_base")


def rebalance(docs: DataFrame, shard: Column, n_shards: int, *, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """Store ``docs`` in old shards and move them to ``n_shards`` shards of equal bytes."""
    spark = docs.sparkSession
    path = new_folder(spark, "shards")
    write_blocks(docs, shard, n_shards, f"{path}/old", id_col=id_col, text_col=text_col)
    return reshard(spark, f"{path}/old", f"{path}/new", docs.schema, n_shards, id_col=id_col,
                   text_col=text_col, **options)


def digests(placed: DataFrame) -> DataFrame:
    rows = placed.select("doc_id", text_bytes("text").alias("size"),
                         F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                         "_rs_new", *BLOCK)
    return with_slots(rows, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("_rs_new").alias("shard"), F.col("_rs_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

"""Merkle manifest of a dataset: a digest and a proof for every row, nested and emitted in Spark.

Every row is a leaf, the digest of its length-prefixed fields. Within a group (a language,
say) the leaves ascend by id; every ``FAN`` consecutive nodes become one node until one is
left, the group's subroot; the subroots, in the order of their groups, become the root in
the same way. A proof lists, level by level, what stands left and right of a node's path in
its run of siblings; with it the root can be folded from the leaf alone.

Method: a leaf's rank in its group, written to the base ``FAN``, gives one digit column a
level. The lowest digits are grouped away one after another, each grouping nesting the
structs of the one before, until a row holds a block of ``FAN ** DEPTH`` leaves with all
nodes between; the blocks' nodes are ranked by their block number already and are folded in
the same way, a stage for every ``DEPTH`` levels. All groupings of a stage are clustered by
(group, block), so they cost one exchange together, and no row ever holds more than a block.
Then, from the last stage back to the first, the path of a block is united with its nested
row (one grouping by block number) and three rounds of transform and explode hand it down,
longer by a level each, to its leaves. No join carries proofs.

Ranks do not put a group on one task: rows are range partitioned by (group, id, leaf) and
written once, positions inside a task follow from the row order, and the offsets of a group's
pieces (a row for each task and group) meet them on (task, group).

Defined results: a null field is ``-``; a null group is a group of its own and comes first;
groups order bytewise. Rows of equal id order by leaf; rows that are equal in all fields are
leaves of their own next to each other, and their proofs may be swapped. Null ids come
first. An empty table has no leaves, no root and no rows. Very long texts are hashed where they
are read and travel no further. Columns not named as fields take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written
from .sqltext import crc32_sql

FAN = 8
DEPTH = 3                       # levels nested in one row: blocks of FAN ** DEPTH leaves
BLOCK = FAN ** DEPTH
PLAIN = "uncompressed"           # digests do not compress; codecs hold memory outside the heap
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """sha256 (lowercase hex) of the fields, each ``-`` or byte count, ``:`` and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                                F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _levels(n: Column) -> Column:
    """How often ``n`` nodes are folded until one is left."""
    powers = F.array(*[F.lit(FAN ** k) for k in range(21)])
    return F.size(F.filter(powers, lambda p: p < n))


def _ranked(leaves: DataFrame, name: str) -> DataFrame:
    """``leaves`` (g, key.., node, ..) with ``idx``, the rank in g by the columns after g, and
    ``levels``, the height of g's tree."""
    order = leaves.columns
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("_pid", F.spark_partition_id())
                  .withColumn("_mid", F.monotonically_increasing_id()), name, PLAIN)
    pieces = cut.groupBy("g", "_pid").agg(F.min("_mid").alias("_first"),
                                          F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "g", "_pid", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_o"),
        _levels(F.sum("_n").over(whole)).alias("levels"))
    return cut.join(pieces, ["g", "_pid"]).withColumn("idx", F.col("_mid") + F.col("_o")).drop(
        "_pid", "_mid", "_o")


def _nested(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Blocks of ``BLOCK`` nodes: (g, block, levels, node, kids), children nested in order."""
    digits = [(F.floor(F.col("idx") / (FAN ** k)) % FAN).alias(f"d{k}") for k in range(DEPTH)]
    rows = nodes.select("g", "levels", F.floor(F.col("idx") / BLOCK).alias("block"),
                        *digits, "node", *payload).repartition("g", "block")
    held = ["node", *payload]
    for k in range(DEPTH):
        keys = ["g", "levels", "block", *[f"d{j}" for j in range(k + 1, DEPTH)]]
        kids = F.array_sort(F.collect_list(F.struct(f"d{k}", *held)))
        run = F.array_join(F.transform("kids", lambda c: c["node"]), "")
        rows = rows.groupBy(*keys).agg(kids.alias("kids")).withColumn(
            "node", F.when(F.col("levels") > k, F.sha2(run.cast("binary"), 256))
            .otherwise(F.col("kids")[0]["node"]))
        held = ["node", "kids"]
    return rows


def _tree(leaves: DataFrame, payload: Sequence[str], name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(g, node) of every group's top, and the written blocks of every stage, lowest first."""
    stages = [written(_nested(_ranked(leaves, f"{name}-ranks"), payload), f"{name}-blocks", PLAIN)]
    while (stages[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = stages[-1].select("g", F.col("block").alias("idx"), F.greatest(
            F.col("levels") - DEPTH, F.lit(0)).alias("levels"), "node")
        stages.append(written(_nested(above, ()), f"{name}-blocks", PLAIN))
    return stages[-1].select("g", "node"), stages


def _beside(child: Column, i: Column) -> Column:
    """A child of ``kids`` and the digests of its siblings on each side."""
    nodes = F.transform("kids", lambda c: c["node"])
    return F.struct(child.alias("child"), F.struct(
        F.array_join(F.slice(nodes, F.lit(1), i), "").alias("left"),
        F.array_join(F.slice(nodes, i + 2, F.lit(FAN)), "").alias("right")).alias("step"))


def _handed_down(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The children of every block: (g, idx, node, payload.., path, top); ``paths`` holds
    (g, block, path, top) of every block, ``path`` from the block up."""
    kind = blocks.schema["kids"].dataType.simpleString()
    both = blocks.select("g", "block", "levels", "kids", F.lit(None).cast(
        paths.schema["path"].dataType).alias("path"), F.lit(None).cast("string").alias("top")
    ).unionByName(paths.select("g", "block", F.lit(None).cast("int").alias("levels"),
                               F.lit(None).cast(kind).alias("kids"), "path", "top"))
    rows = both.groupBy("g", "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", "top")]
    ).withColumn("idx", F.col("block"))
    for k in reversed(range(DEPTH)):
        rows = rows.select("g", "idx", "levels", "path", "top",
                           F.explode(F.transform("kids", _beside)).alias("c"))
        fields = rows.schema["c"].dataType["child"].dataType.names[1:]
        rows = rows.select(
            "g", (F.col("idx") * FAN + F.col(f"c.child.d{k}")).alias("idx"), "levels", "top",
            F.when(F.col("levels") > k, F.concat(F.array("c.step"), "path"))
            .otherwise(F.col("path")).alias("path"), *[F.col(f"c.child.{f}") for f in fields])
    return rows.drop("levels")


def _emitted(stages: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The leaves of a tree with their paths; ``paths`` holds those of its tops."""
    paths = paths.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(stages[1:]):
        paths = _handed_down(blocks, paths).select(
            "g", F.col("idx").alias("block"), "path", "top")
    return _handed_down(stages[0], paths)


def proofs(docs: DataFrame, *, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
           group_col: str = "lang", changed: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, claimed, subroot, root, path) of every row.

    ``changed`` replaces fields by what a receiver holds; ``claimed`` is the leaf of that.
    ``path`` lists (left, right) from the leaf's run up: digests of the siblings on each side.
    """
    leaf = leaf_digest([F.col(f"`{f}`") for f in fields])
    claimed = leaf_digest([(changed or {}).get(f, F.col(f"`{f}`")) for f in fields]) \
        if changed else leaf
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("g"),
        F.col(f"`{id_col}`").alias("id"), leaf.alias("node"), claimed.alias("claimed"))
    tops, stages = _tree(leaves, ("id", "claimed"), "leaves")
    # a row a group; the groups' names are the ids of the upper tree
    upper = tops.select(F.lit("").alias("g"), F.col("g").alias("id"), "node")
    root, upper_stages = _tree(upper, ("id",), "groups")
    start = root.select("g", F.col("node").alias("top"),
                        F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    groups = _emitted(upper_stages, start).select(
        F.col("id").alias("g"), "path", F.col("node").alias("top"))
    out = _emitted(stages, groups)
    return out.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "claimed",
                      F.col("top").alias("subroot"),
                      root.select("node").scalar().alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(
        F.concat(step["left"], acc, step["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
                  .cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns; rows whose id's crc32 is divisible by 3 are tampered with."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    out = proofs(docs, changed={"text": text})
    return out.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("claimed"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        _field_sql(text if f == "text" else f) for f in FIELDS) + ")"


ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {_leaf_sql('text')} AS leaf,
         {_leaf_sql(f"CASE WHEN {crc32_sql('doc_id')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END")}
         AS claimed FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf, claimed) - 1 AS idx
           FROM leaves),
nodes(lvl, g, idx, node) AS (
  SELECT 0, g, idx, leaf FROM ranked
  UNION ALL
  SELECT lvl + 1, g, idx // {FAN}, sha256(string_agg(node, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM nodes) WHERE c > 1
  GROUP BY lvl, g, idx // {FAN}),
subs AS (SELECT g, lvl AS height, node AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx
         FROM nodes n WHERE lvl = (SELECT max(lvl) FROM nodes m WHERE m.g = n.g)),
tops(lvl, idx, node) AS (
  SELECT 0, idx, subroot FROM subs
  UNION ALL
  SELECT lvl + 1, idx // {FAN}, sha256(string_agg(node, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS c FROM tops) WHERE c > 1
  GROUP BY lvl, idx // {FAN}),
root AS (SELECT max_by(node, lvl) AS root, max(lvl) AS height FROM tops),
lower_steps AS (
  SELECT a.g, a.lvl, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '')
         AS l, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.g = b.g AND a.lvl = b.lvl AND a.idx // {FAN} = b.idx // {FAN}
  JOIN subs s ON s.g = a.g AND a.lvl < s.height GROUP BY a.g, a.lvl, a.idx),
upper_steps AS (
  SELECT a.lvl, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '')
         AS l, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // {FAN} = b.idx // {FAN}
  WHERE a.lvl < (SELECT height FROM root) GROUP BY a.lvl, a.idx),
steps AS (
  SELECT k.g, k.idx, list(struct_pack(l := t.l, r := t.r) ORDER BY t.lvl) AS path FROM ranked k
  JOIN lower_steps t ON t.g = k.g AND t.idx = k.idx // ({FAN} ** t.lvl)::BIGINT
  GROUP BY k.g, k.idx),
top_steps AS (
  SELECT s.g, list(struct_pack(l := t.l, r := t.r) ORDER BY t.lvl) AS path FROM subs s
  JOIN upper_steps t ON t.idx = s.idx // ({FAN} ** t.lvl)::BIGINT GROUP BY s.g),
paths AS (
  SELECT k.doc_id, k.leaf, k.claimed, s.subroot,
         list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path
  FROM ranked k JOIN subs s ON s.g = k.g
  LEFT JOIN steps p ON p.g = k.g AND p.idx = k.idx LEFT JOIN top_steps u ON u.g = k.g)
SELECT doc_id, leaf, subroot, root,
       sha256(list_reduce(list_prepend('', list_transform(path, lambda s: s.l || s.r)),
                          lambda a, b: a || b)) AS proof_sha256,
       list_reduce(list_prepend(claimed, list_transform(path, lambda s: s.l || ' ' || s.r)),
                   lambda a, s: sha256(string_split(s, ' ')[1] || a || string_split(s, ' ')[2]))
         AS folded_root,
       folded_root = root AS verified
FROM paths, root
"""

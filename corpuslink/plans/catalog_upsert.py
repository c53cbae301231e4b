"""Duplicate policies, ids and constraints (O-10..O-19) over ``events`` and TPC-H tables.

Upsert stand-in: key (user_id, event_type), arrival order event_id. The
"existing table" is the first-wins load of the events up to the midpoint of
the event time range; the later events are the incoming batch. Every event
is processed by one side or the other.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.operators import upsert as U
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register

KEYS = ["user_id", "event_type"]
ORDER = ["event_id"]
COLS = ["user_id", "event_type", "event_id", "value"]

SPLIT_SQL = """
WITH c AS (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * 500 // 1000 AS cut
           FROM events),
ev AS (SELECT e.user_id, e.event_type, e.event_id, e.value, epoch_us(e.ts) <= c.cut AS old
       FROM events e, c),
tgt AS (SELECT user_id, event_type, event_id, value FROM ev WHERE old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1)
"""


def _split(spark, sf_dir, per_mille: int = 500):
    """(first-wins table of the events up to ``per_mille``/1000 of the time range,
    the later events as the batch)."""
    # Microseconds of the TIMESTAMP_NTZ, independent of the session time zone.
    ev = S.table(spark, sf_dir, "events").withColumn(
        "_us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    # A global aggregate is one row: attached as a scalar subquery.
    cut = ev.agg(F.expr(f"min(_us) + (max(_us) - min(_us)) * {per_mille} div 1000")
                 .alias("_cut")).scalar()
    tagged = ev.withColumn("_old", F.col("_us") <= cut)
    old = tagged.filter("_old").select(*COLS)
    new = tagged.filter(~F.col("_old")).select(*COLS)
    return U.first_per_key(old, KEYS, ORDER).select(*COLS), new


@register("insert_ignore", oracle=SPLIT_SQL + """,
bat AS (SELECT user_id, event_type, event_id, value FROM ev WHERE NOT old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1)
SELECT * FROM tgt
UNION ALL
SELECT * FROM bat b WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.user_id = b.user_id AND t.event_type = b.event_type)
""")
def q_insert_ignore(spark, sf_dir):
    """O-10: insert-or-ignore of the later batch into the first-wins table."""
    target, batch = _split(spark, sf_dir)
    return U.insert_ignore(target, batch, KEYS, ORDER)[0]


@register("insert_ignore_new", oracle=SPLIT_SQL.replace("* 500 // 1000", "* 50 // 1000") + """,
bat AS (SELECT user_id, event_type, event_id, value FROM ev WHERE NOT old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1)
SELECT * FROM bat b WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.user_id = b.user_id AND t.event_type = b.event_type)
""")
def q_insert_ignore_new(spark, sf_dir):
    """O-10: the rows the batch actually inserted (the reference's rowcount)."""
    target, batch = _split(spark, sf_dir, per_mille=50)
    return U.insert_ignore(target, batch, KEYS, ORDER)[1].select(*COLS)


@register("insert_strict_ties", oracle="""
WITH e AS (SELECT user_id, event_type, event_id // 50 AS slot, event_id, value FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                ORDER BY slot, user_id, event_type, event_id, value) AS n FROM e)
SELECT user_id, event_type, event_id, CASE WHEN n = 1 THEN 'kept' ELSE 'reject' END AS origin
FROM r
""")
def q_insert_strict_ties(spark, sf_dir):
    """O-12 where the order ties (fifty events share a slot): every row is kept or rejected."""
    ev = S.table(spark, sf_dir, "events").select("user_id", "event_type", F.floor(
        F.col("event_id") / 50).alias("slot"), "event_id", "value")
    kept, rejects = U.insert_strict(ev, KEYS, ["slot"])
    cols = ["user_id", "event_type", "event_id"]
    return kept.select(*cols, F.lit("kept").alias("origin")).union(
        rejects.select(*cols, F.lit("reject").alias("origin")))


@register("insert_ignore_early", oracle="""
WITH c AS (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * 50 // 1000 AS cut
           FROM events),
ev AS (SELECT e.user_id, e.event_type, e.event_id, e.value, epoch_us(e.ts) <= c.cut AS old
       FROM events e, c),
tgt AS (SELECT user_id, event_type, event_id, value FROM ev WHERE old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1),
bat AS (SELECT user_id, event_type, event_id, value FROM ev WHERE NOT old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1)
SELECT *, 'kept' AS origin FROM tgt
UNION ALL
SELECT *, 'inserted' FROM bat b WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.user_id = b.user_id AND t.event_type = b.event_type)
""")
def q_insert_ignore_early(spark, sf_dir):
    """O-10 with an early load (first 5% of the time range): many batch keys are new."""
    target, batch = _split(spark, sf_dir, per_mille=50)
    new_target, inserted = U.insert_ignore(target, batch, KEYS, ORDER)
    return (target.withColumn("origin", F.lit("kept"))
            .unionByName(inserted.select(*COLS).withColumn("origin", F.lit("inserted"))))


@register("upsert_last", oracle=SPLIT_SQL + """,
bat AS (SELECT user_id, event_type, event_id, value FROM ev WHERE NOT old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
SELECT t.user_id, t.event_type, t.event_id AS id, t.event_id, t.value FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM bat b WHERE t.user_id = b.user_id AND t.event_type = b.event_type)
UNION ALL
SELECT b.user_id, b.event_type, coalesce(t.event_id, b.event_id) AS id, b.event_id, b.value
FROM bat b LEFT JOIN tgt t ON t.user_id = b.user_id AND t.event_type = b.event_type
""")
def q_upsert_last(spark, sf_dir):
    """O-11 + D5: insert-or-replace, last wins; a replaced key keeps its id."""
    target, batch = _split(spark, sf_dir)
    target = target.withColumn("id", F.col("event_id")).select("user_id", "event_type", "id",
                                                              "event_id", "value")
    batch = batch.withColumn("id", F.col("event_id"))
    return U.upsert(target, batch, KEYS, ORDER, id_col="id")


@register("insert_strict_rejects", oracle="""
SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1
""")
def q_insert_strict_rejects(spark, sf_dir):
    """O-12: every later duplicate of a key is a reject."""
    ev = S.table(spark, sf_dir, "events").select(*COLS)
    return U.insert_strict(ev, KEYS, ORDER)[1].select("user_id", "event_type", "event_id")


@register("insert_strict_rows", oracle="""
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
""")
def q_insert_strict_rows(spark, sf_dir):
    """O-12: the kept rows (first per key)."""
    ev = S.table(spark, sf_dir, "events").select(*COLS)
    return U.insert_strict(ev, KEYS, ORDER)[0].select(*COLS)


@register("dense_ids", oracle="""
SELECT doc_id, CAST(row_number() OVER (ORDER BY source, doc_id) AS BIGINT) AS dense_id
FROM documents
""")
def q_dense_ids(spark, sf_dir):
    """O-13: dense ids in (source, doc_id) order without a single-task window."""
    d = S.table(spark, sf_dir, "documents").select("doc_id", "source")
    return U.assign_ids(d, ["source", "doc_id"], "dense_id").select("doc_id", "dense_id")


@register("check_unique", oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_check_unique(spark, sf_dir):
    """O-14: (l_orderkey, l_linenumber) is not unique in the test data."""
    return U.check_unique(S.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("check_nulls", oracle="SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in LI_COLS) + " FROM lineitem")
def q_check_nulls(spark, sf_dir):
    """O-15: NULL counts of every lineitem column in one pass."""
    return U.check_not_null(S.table(spark, sf_dir, "lineitem"), LI_COLS)


@register("check_domain", oracle="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
""")
def q_check_domain(spark, sf_dir):
    """O-16: order status outside {F, O}."""
    return U.check_domain(S.table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"]) \
        .select("o_orderkey", "o_orderstatus")


# References made from another column: some of them have no parent.
NATION_REF = "c_custkey % 30"


@register("resolve_keys", oracle=f"""
SELECT c.c_custkey, n.n_name FROM customer c
JOIN nation n ON n.n_nationkey = {NATION_REF}
""")
def q_resolve_keys(spark, sf_dir):
    """O-18: resolve a name/key against a dimension (resolved rows)."""
    nat = S.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    cust = S.table(spark, sf_dir, "customer").withColumn("c_nationkey", F.expr(NATION_REF))
    return U.resolve_key(cust, nat, "c_nationkey", ["n_name"])[0].select("c_custkey", "n_name")


@register("unknown_keys", oracle=f"""
SELECT c_custkey, {NATION_REF} AS c_nationkey FROM customer
WHERE {NATION_REF} NOT IN (SELECT n_nationkey FROM nation)
""")
def q_unknown_keys(spark, sf_dir):
    """O-18: references that do not resolve."""
    nat = S.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    cust = S.table(spark, sf_dir, "customer").withColumn("c_nationkey", F.expr(NATION_REF))
    return U.resolve_key(cust, nat, "c_nationkey", ["n_name"])[1].select("c_custkey",
                                                                        "c_nationkey")


@register("check_fk", oracle="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey + l.l_linenumber)
""")
def q_check_fk(spark, sf_dir):
    """O-19: line items that refer to a part (their own plus the line number) that is not
    there."""
    li = S.table(spark, sf_dir, "lineitem").withColumn(
        "ref", F.col("l_partkey") + F.col("l_linenumber"))
    return U.check_fk(li, S.table(spark, sf_dir, "part"), ["ref"], ["p_partkey"]) \
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

"""Line dedup and resharding against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslink.llm import linededup as L
from corpuslink.llm import resharding as R

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANK).translate(LOWER)
    for i, t, *_ in rows:
        if i is not None and t:
            for line in t.split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 20 or len(holders[key(x)]) < 3
                or max(holders[key(x)]) == i]
        out.append((i if i is not None else -1, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_dropped, r.kept_sha256)
                  for r in L.digests(df).collect())


def test_lines_equal_brute_force(docs, rows, none):
    out = L.dedup_lines(docs)
    assert result(out) == brute_lines(rows)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert L.dedup_lines(docs, counts=False).columns == docs.columns
    assert L.dedup_lines(none).count() == 0


def test_many_shards_and_salts(docs, rows, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 1)
    assert result(L.dedup_lines(docs)) == brute_lines(rows)


def test_a_hot_line_is_spread_whatever_the_shards(spark, monkeypatch):
    """One line in all documents, with more shards than partitions."""
    monkeypatch.setattr(L, "SHARD_KEYS", 1)
    drops, real = [], L.drop_lines
    monkeypatch.setattr(L, "drop_lines", lambda d, x, *a: drops.append(x) or real(d, x, *a))
    hot = "the same line stands in every one of these documents"
    rows = [(i, f"{hot}\nanother line that stands in some documents {i % 100}\nown line {i} "
                "which stands in this document only") for i in range(400)]
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(hot in r.text for r in out.collect()) == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in drops[0].where("_pos = 0").groupBy(
            F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 399 and len(sizes) > 1


def test_deleting_undoes_inserting(spark, docs, rows):
    state = L.LineState(spark)
    old, new = docs.where("doc_id < 40"), docs.where("doc_id >= 40")
    state.insert(old, "a")
    before = sorted(map(tuple, state.references().collect()))
    state.insert(new, "b")
    state.insert(new, "b")                               # a repeated batch changes nothing
    both = sorted(map(tuple, state.references().collect()))
    assert both == sorted(map(tuple, L.references(L.postings(L.line_keys(docs))).collect()))
    state.delete(new, "c")
    assert sorted(map(tuple, state.references().collect())) == before
    # new documents against the state
    got = L.dedup_lines(new, held=state.postings())
    want = [r for r in brute_lines([r for r in rows if r[0] is not None]) if r[0] >= 40]
    assert result(got) == want


def test_filters_take_insertions_and_deletions(spark, docs):
    refs = L.references(L.postings(L.line_keys(docs)))
    often, twice = refs.where("n_docs >= 3"), refs.where("n_docs >= 2")
    shards = L.shard_rows(often, 2)
    more = L.update_shards(shards, twice.where("n_docs < 3"), twice.where("false"), 2)
    less = L.update_shards(more, twice.where("false"), twice.where("n_docs < 3"), 2)

    def tables(df):
        out = {}
        for r in df.collect():
            docs = np.frombuffer(r.last_docs, "<i8").tolist()
            keys = [bytes(r["keys"][16 * i:16 * i + 16]) for i in range(len(docs))]
            found = L.CuckooFilter.from_bytes(bytes(r["filter"]))
            assert found.contains(L._halves(keys)).all()
            out.update(zip(keys, docs))
        return out

    assert tables(shards) == tables(less)
    assert tables(more) == {bytes(r[0]): r[2] for r in twice.collect()}


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2 ** 63, 5000).astype(np.uint64)
    f = L.CuckooFilter.of(keys)
    assert f.contains(keys).all()
    assert f.contains(rng.integers(0, 2 ** 63, 20000).astype(np.uint64)).mean() < 0.01
    gone, rest = keys[:2000], keys[2000:]
    assert all(f.delete(k) for k in gone)
    assert f.contains(rest).all() and f.contains(gone).mean() < 0.01
    assert L.CuckooFilter.from_bytes(f.to_bytes()).contains(rest).all()


def brute_flow(supply, capacity, cost):
    """Least cost over all integer flows of a tiny instance."""
    from functools import lru_cache

    @lru_cache(None)
    def go(i, room):
        if i == len(supply):
            return 0
        best = None

        def deal(j, left, room, spent):
            nonlocal best
            if j == len(room):
                if left == 0:
                    rest = go(i + 1, room)
                    if rest is not None and (best is None or spent + rest < best):
                        best = spent + rest
                return
            for x in range(min(left, room[j]) + 1):
                deal(j + 1, left - x, room[:j] + (room[j] - x,) + room[j + 1:],
                     spent + x * cost[i][j])

        deal(0, supply[i], room, 0)
        return best

    return go(0, tuple(capacity))


def test_flow_is_cheapest():
    rng = random.Random(4)
    for _ in range(40):
        m, n = rng.randrange(1, 4), rng.randrange(1, 4)
        supply = [rng.randrange(5) for _ in range(m)]
        capacity = [rng.randrange(6) for _ in range(n)]
        cost = [[rng.randrange(5) for _ in range(n)] for _ in range(m)]
        if sum(supply) > sum(capacity):
            with pytest.raises(ValueError):
                R.min_cost_flow(supply, capacity, cost)
            continue
        flow = R.min_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(r[j] for r in flow) <= capacity[j] for j in range(n))
        assert sum(f * c for a, b in zip(flow, cost) for f, c in zip(a, b)) == brute_flow(
            tuple(supply), capacity, cost)


def test_resharding_moves_the_fewest_bytes(spark, docs, rows, none):
    placed = R.rebalance(docs, F.crc32("source"), 4).cache()
    sizes = [len((t or "").encode()) + 1 for _, t, *_ in rows]
    got = R.with_slots(placed.withColumn("size", R.text_bytes("text")), "doc_id").collect()
    assert sorted(str((r.doc_id, r.text, r.n_words, r.shard, r.before)) for r in got) == sorted(
        str((r[0], r[1], r[6], r[5], r[9])) for r in rows)
    old, new, slots = defaultdict(int), defaultdict(int), defaultdict(list)
    moved = 0
    for r in got:
        old[r._rs_shard] += r.size
        new[r._rs_new] += r.size
        slots[r._rs_new].append(r._rs_slot)
        moved += r.size * (r._rs_shard != r._rs_new)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    fair, big = sum(sizes) / 4, max(sizes)
    assert max(abs(new[j] - fair) for j in range(4)) <= big
    least = sum(max(0, old[i] - fair) for i in range(4))
    assert moved <= least + 4 * big
    assert R.rebalance(none, F.crc32("source"), 4).count() == 0


def test_resharding_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "t" * i, i % 2, f"n{i}", i, -i) for i in range(40)],
                                 "`id.x` long, text string, s int, _rs_note string, _rs_new int, "
                                 "`a.b` int")
    got = R.rebalance(docs, F.col("s"), 3, id_col="id.x").collect()
    assert sorted((r["id.x"], r["_rs_note"], r["_rs_new_own"], r["a.b"]) for r in got) == [
        (i, f"n{i}", i, -i) for i in range(40)]
    assert {r["_rs_new"] for r in got} == {0, 1, 2}


def test_capacities_prices_and_kept_files(spark):
    docs = spark.createDataFrame([(i, "t" * (i % 50), i % 3) for i in range(900)],
                                 "doc_id long, text string, s int")
    placed = R.rebalance(docs, F.col("s"), 3, capacity=[40_000, 0, 1_000]).collect()
    assert len(placed) == 900 and {r._rs_new for r in placed} <= {0, 2}
    assert sum(len(r.text) + 1 for r in placed if r._rs_new == 2) <= 1_050
    digest = R.digests(R.rebalance(docs.select("doc_id", "text", "s"), F.col("s"), 3))
    r = digest.where("doc_id = 7").first()
    assert (r.text_crc32, r["size"], r.law, r.grown_shard) == (zlib.crc32(b"t" * 7), 8, "bytes",
                                                            None)

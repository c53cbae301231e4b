"""Jaccard join, quality rules, decontamination and license scan against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslink.llm import components, decontam, jaccard, licenses, quality
from corpuslink.llm.shingles import shingle_sets

from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_classes(rows):
    """(id, set size, least id reachable) of each (id, text)."""
    sets = [brute_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted((i if i is not None else -1, len(sets[k]),
                   i if not sets[k] else least.get(top(k))) for k, (i, _) in enumerate(rows))


def classes(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id)
                  for r in jaccard.link_classes(df).collect())


def test_shingle_sets():
    texts = ["a b c d e f", "A  B\tC\nd e F", "a b", None, "", " ", "a b c d e", "x " * 50,
             "é b c d e", "É b c d e", "w" * 9000 + " b c d e"]
    values, sizes = shingle_sets(pa.array(texts))
    sets = [set(x.tolist()) for x in np.split(values, np.cumsum(sizes)[:-1])]
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(sets[i] & sets[j]) == len(brute_set(a) & brute_set(b))


def test_linked_sets_share_a_signature():
    """Sets just within the threshold, of all small and some large sizes."""
    rng = np.random.default_rng(0)
    starts = jaccard.band_starts(5000)
    for size in [*range(1, 60), 200, 777, 2500]:
        for _ in range(30 if size < 60 else 4):
            a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
            out = rng.integers(0, len(a) // 5 + 1)
            b = np.setdiff1d(a, rng.choice(a, out, replace=False))
            more = int(len(b) * 5 / 4) - len(a)
            if more > 0:
                b = np.union1d(b, rng.integers(0, 2 ** 63, rng.integers(0, more + 1))
                               .astype(np.uint64))
            both = len(np.intersect1d(a, b))
            if 5 * both < 4 * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            assert len(np.intersect1d(jaccard.signatures(a, starts),
                                      jaccard.signatures(b, starts))), (len(a), len(b))


def test_sparse_sets_are_not_lost(monkeypatch):
    monkeypatch.setattr(jaccard, "SALTS", 1)             # straight to single elements
    rng = np.random.default_rng(1)
    starts = jaccard.band_starts(100)
    for _ in range(500):
        a = np.unique(rng.integers(0, 2 ** 63, 10).astype(np.uint64))
        b = np.append(a[:-1], np.uint64(5))
        assert len(np.intersect1d(jaccard.signatures(a, starts),
                                  jaccard.signatures(np.sort(b), starts)))


def test_classes_equal_brute_force(docs, rows, none):
    assert classes(docs) == brute_classes([r[:2] for r in rows])
    assert jaccard.link_classes(none).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    want = sorted({(i, c) for i, n, c in brute_classes([r[:2] for r in rows])
                   if n and i == c} | {(i, i) for i, n, _ in brute_classes([r[:2] for r in rows])
                                       if not n})
    assert got == sorted([i if i is not None else -1 for i, _ in want] + [-1])


@pytest.mark.parametrize("block", [2048, 3])
def test_chains_and_common_passages(spark, monkeypatch, block):
    """Chains link only neighbours; a passage most documents share links none."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(3)
    base = words(rng, 100).split(" ")
    rows = []
    for k in range(25):
        base = base[:]
        for _ in range(2):
            base[rng.randrange(100)] = f"new{k}x{rng.random()}"
        rows.append((k, " ".join(base)))
    passage = words(rng, 60)
    rows += [(100 + k, passage + " " + words(rng, rng.randrange(20, 40))) for k in range(40)]
    rows += [(200 + k, words(rng, 5 + k % 4, 12)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df) == brute_classes(rows)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    edges += [(k, k + 1) for k in range(1000, 1100)]
    up = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for e in edges if e[0] != e[1] for x in e}


def test_quality_numbers(spark, docs, rows, none):
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.word_chars, r.n_symbols,
                  r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                 for r in quality.judge(docs, labels).collect())
    want = []
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n = Counter(zip(w, w[1:], w[2:]))
        held = {k for p in range(len(w) - 2) if n[tuple(w[p:p + 3])] > 1 for k in (p, p + 1, p + 2)}
        failed = len(w) < 50 or 100 * len(held) > 50 * len(w)
        want.append((i if i is not None else -1, len(w), sum(map(len, w)),
                     len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(held),
                     failed, not failed))
    assert got == sorted(want)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(x[-1] for x in want)
    assert quality.judge(none, labels).count() == 0


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 40, 300, 5000) for k in range(0, min(n, int(n * 0.02) + 3))]
    got = spark.createDataFrame(cases, "k long, n long").select(
        "k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        p = sum(math.comb(r.n, j) * 0.02 ** j * 0.98 ** (r.n - j) for j in range(r.k + 1))
        assert math.isclose(r.p, 1.0 if r.k >= r.n * 0.02 else p, rel_tol=1e-9), r
    big = spark.createDataFrame([(19_000_000, 10 ** 9)], "k long, n long").select(
        quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).first().p
    assert 0 <= big < 1e-50


def test_cutoffs_keep_the_risk_and_find_bad_text(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(3000):
        w = words(rng, 80, 3000).split(" ")
        bad = i % 10 == 0
        if bad:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), None if i % 50 == 2 else "en"))
        if i % 2 == 0:
            labels.append((i, int(not bad)))
    labels += [(0, None), (None, 1), (10 ** 9, 1), (2, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = spark.createDataFrame(labels, "doc_id long, quality long")
    out = quality.judge(docs, given).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert not any(kept[i] for i in range(0, 3000, 10))
    lost = [i for i in range(3000) if i % 10 and not kept[i]]
    assert len(lost) <= 0.02 * 2700
    assert all(kept[i] for i in range(2, 3000, 50))       # too few labels: nothing is rejected
    feats = quality.features(docs, "doc_id", "text", "lang")
    chosen = {r.stratum: r for r in quality.choose_cutoffs(feats, given).collect()}
    assert chosen["en"].level > 0 and chosen[None].level == 0
    for r in chosen.values():
        for t in r.tests[:r.level]:
            assert t.p <= 0.05 / len(chosen)


def test_small_strata_share_cutoffs(spark):
    """Three languages too small to pass alone, next to a large one; bad text is full of
    marks, which one of the eight rules sees."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3600):
        lang = "en" if i % 2 else ("de", "fr", "es")[i // 2 % 3]
        bad = i // 6 % 10 == 0
        w = words(rng, 60, 3000).split(" ")
        rows.append((i, " ".join(x + "#" if bad else x for x in w), lang))
        if i % 5 < 3:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = spark.createDataFrame(labels, "doc_id long, quality long")
    chosen = {r.stratum: r for r in quality.choose_cutoffs(
        quality.features(docs, "doc_id", "text", "lang"), given).collect()}
    assert all(chosen[x].level > 0 for x in ("en", "de", "fr", "es"))
    assert chosen["de"].tests == chosen["fr"].tests == chosen["es"].tests != chosen["en"].tests
    assert all(t.p <= 0.05 / 2 for r in chosen.values() for t in r.tests[:r.level])
    kept = {r.doc_id: r.kept for r in quality.judge(docs, given).collect()}
    assert not any(kept[i] for i in range(3600) if i // 6 % 10 == 0)
    good = [kept[i] for i in range(3600) if i // 6 % 10]
    assert sum(good) >= 0.98 * len(good)


def test_leaks(spark, none):
    rng = random.Random(5)
    items = [(k, words(rng, 30, 5000) + ".") for k in range(6)]
    items.append((6, "A train leaves Springfield at 9 and needs 40 km of track before it passes "
                     "Oakdale at 11 with 9 cars"))
    items.append((7, "too short"))
    plain = lambda n: words(rng, n, 5000)
    moved = ("A train leaves Riverton at 7 and needs 55 km of track before it passes Hilltop at 12 "
             "with 7 cars")
    mixed = moved.replace("with 7", "with 8")             # 9 stands for 7 and for 8
    rows = [(0, plain(50)), (1, plain(20) + "\n" + items[0][1] + "\n" + plain(30)),
            (2, items[1][1].upper()), (3, "so it is. " + moved + ". " + plain(20)),
            (4, "so it is. " + mixed + ". " + plain(20)), (5, items[6][1]), (6, None), (7, ""),
            (8, " ".join(items[2][1].split(" ")[:18]) + " " + plain(40)),
            (9, " ".join(items[2][1].split(" ")[:9]) + " " + plain(40)),
            (10, items[3][1] + " " + items[4][1] + " " + items[3][1]),
            (1, plain(20) + "\n" + items[0][1]), (None, items[5][1])]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows],
                                 "doc_id long, text string, item_id long, at int, window string")
    bench = spark.createDataFrame(items + [(9, None)], "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.kind)
                 for r in decontam.find_leaks(docs, bench).collect())
    assert got == [(-1, 5, "exact"), (1, 0, "exact"), (2, 1, "exact"), (3, 6, "reworded"),
                   (5, 6, "exact"), (8, 2, "exact"), (10, 3, "exact"), (10, 4, "exact")]
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4, 6, 7, 9]
    assert sorted(r.item_id for r in decontam.short_items(bench).collect()) == [7, 9]
    assert decontam.find_leaks(none, bench).count() == 0
    assert decontam.drop_leaks(docs, bench.where("false")).count() == len(rows)


def test_leaks_without_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    item = words(rng, 25, 5000)
    docs = spark.createDataFrame([(1, "x " + item), (2, words(rng, 25, 5000))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(decontam, "MAX_BROADCAST", 0)
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()] == [(1, 1)]


def brute_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split(" ")
        for i in range(len(w)):
            if w[i:i + len(p)] == p:
                at.append(i)
                base.add(label)
    found, best = set(), 0.0
    for s in range(0, len(w), licenses.STRIDE):
        block = set(w[s:s + licenses.BLOCK_WORDS])
        for name, t in licenses.TEMPLATES.items():
            t = set(t.split())
            if len(t & block) >= licenses.THRESHOLD * len(t) - 1e-9:
                found.add(name)
                best = max(best, len(t & block) / len(t))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if at else best)


def test_licenses_equal_brute_force(spark, rows, docs, none):
    rng = random.Random(8)
    notices = list(licenses.TEMPLATES.values())
    texts = [t for _, t, *_ in rows]
    for k in range(40):
        notice = rng.choice(notices).split(" ")
        cut = notice[:rng.randrange(len(notice) // 2, len(notice) + 1)]
        texts.append(words(rng, rng.randrange(80)) + "\n" + "\n".join(cut).title() + " "
                     + words(rng, rng.randrange(80)))
    texts += ["apache license apache license", "CC-BY cc by", "the MIT License.", "mit", "apache"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(df).collect()}
    assert got == {i: brute_scan(t) for i, t in enumerate(texts)}
    assert licenses.scan(docs).count() == len(rows)
    assert licenses.scan(none).count() == 0

"""WARC archives, periodic runs and Merkle proofs against brute force and odd rows."""

import base64
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpuslink.llm import merkle, runs, warc

# --- op 11 ---------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, type string, file string, first int, key int"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    texts = [None, "", "<p>Été 中文</p>", "x" * 300_000, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"]
    texts += ["".join(rng.choice("ab<>\r\n ") for _ in range(rng.randrange(200))) for _ in range(20)]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 5 else None, texts[k % 13] if k < 60 else
             texts[13 + k % 12], "t", "f", 1, 2) for k in range(100)]
    rows += [(3, None, rows[3][2], "t", "f", 1, 2), (None, "u", "only here", "t", "f", 1, 2),
             (None, "u", rows[7][2], "t", "f", 1, 2), (-5, "u", rows[9][2], "t", "f", 1, 2)]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def told(pages, min_bytes=0):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, body in rows:
        if i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, body in rows:
        f = first.get(body)
        again = f is not None and f != i and len(body) >= min_bytes
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("gz", [False, True])
@pytest.mark.parametrize("hot", [1, 1000])
@pytest.mark.parametrize("min_bytes", [0, 60])
def test_archive_round_trip(spark, pages, tmp_path, monkeypatch, gz, hot, min_bytes):
    monkeypatch.setattr(warc, "HOT_SHARE", hot)              # all digests by shuffle, or by broadcast
    path = str(tmp_path / "w")
    warc.write_archive(pages, path, gz=gz, min_bytes=min_bytes, file_bytes=200_000)
    found = warc.read_archive(spark, path)
    assert warc.gaps(found).count() == 0
    got = warc.records(found)
    assert sorted(map(tuple, got.select("id", "payload_bytes", "payload_digest", "type",
                                        "refers_to").collect()), key=str) == told(pages, min_bytes)
    full = {r.page_id: (r.html or "").encode() for r in pages.collect() if r.page_id is not None}
    for r in got.where("type = 'response' and id is not null").collect():
        assert bytes(r.payload) == full[r.id]
        assert r.url is None or "\n" not in r.url


def test_archive_of_nothing(spark, pages, tmp_path):
    warc.write_archive(pages.limit(0), str(tmp_path / "w"))
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 0


def archive(gz, n=12):
    rng = random.Random(5)
    parts = []
    for k in range(n):
        record = warc.render(str(k), f"http://h/{k}", bytes(rng.randrange(256) for _ in range(400)),
                             None, "2024-01-01T00:00:00Z") + warc.END
        parts.append(warc.member(record) if gz else record)
    return parts


def read(data):
    rows = list(warc.salvage(data))
    return ([int(r["id"]) if r["id"].isdigit() else r["id"] for r in rows
             if r["kind"] == "record"],
            [(r["offset"], r["length"]) for r in rows if r["kind"] == "gap"])


@pytest.mark.parametrize("gz", [False, True])
def test_salvage(gz):
    """Whatever is done to some records, the others come back and the gaps are the damage."""
    parts = archive(gz)
    ends = [sum(map(len, parts[:k])) for k in range(len(parts) + 1)]
    whole = b"".join(parts)
    assert read(whole) == (list(range(12)), [])
    rng = random.Random(8)
    for _ in range(60):
        hit = rng.randrange(12)
        at = rng.randrange(ends[hit], ends[hit + 1])
        broken = whole[:at] + bytes([whole[at] ^ (1 << rng.randrange(8))]) + whole[at + 1:]
        ids, gaps = read(broken)
        # a flipped bit may lie in a field that no digest covers; then nothing is lost
        assert ids == [k for k in range(12) if k != hit] and gaps == [
            (ends[hit], ends[hit + 1] - ends[hit])] or len(ids) == 12 and not gaps
    for hit in (0, 5, 11):                                   # bytes cut out, and put in
        cut = whole[:ends[hit] + 100] + whole[ends[hit] + 150:]
        assert read(cut) == ([k for k in range(12) if k != hit],
                             [(ends[hit], len(parts[hit]) - 50)])
        noise = whole[:ends[hit]] + b"noise\x1f\x8b\x08WARC/9" + whole[ends[hit]:]
        assert read(noise) == (list(range(12)), [(ends[hit], 14)])
    assert read(whole[:-30]) == (list(range(11)), [(ends[11], len(parts[11]) - 30)])
    assert read(b"no archive at all") == ([], [(0, 17)]) and read(b"") == ([], [])
    assert read(b"".join(parts[:2]) + warc.EMPTY_MEMBER + parts[2]) == ([0, 1, 2], [])


def test_salvage_through_spark(spark, tmp_path):
    parts = archive(True)
    parts[4] = parts[4][:60] + bytes(20) + parts[4][80:]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    (tmp_path / "b.warc").write_bytes(b"".join(archive(False, 3)))
    found = warc.read_archive(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in warc.gaps(found).select("file", "offset", "length").collect()] == \
        [(sum(map(len, parts[:4])), len(parts[4]))]
    assert warc.records(found).groupBy("file").count().orderBy("count").select(
        "count").collect() == [(3,), (11,)]


# --- op 12 ---------------------------------------------------------------------------------

def brute_runs(w, least=6):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, 4 * q):
                out.setdefault((s, i - s + q), q)
    return [(s, n, q) for s, q, n in sorted((s, q, n) for (s, n), q in out.items())]


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for least in (4, 6, 9):
        for _ in range(60):
            texts = []
            for _ in range(15):
                n, k = rng.randrange(70), rng.choice([1, 2, 2, 3, 5])
                w = [b"%d" % rng.randrange(k) for _ in range(n)]
                if n and rng.random() < 0.5:
                    p, a = rng.randrange(1, 9), rng.randrange(n)
                    w = [x if i < a else w[a + (i - a) % min(p, n - a)] for i, x in enumerate(w)]
                texts.append(w)
            assert runs.text_runs(texts, least) == [brute_runs(w, least) for w in texts]


def test_long_periodic_texts_are_quick():
    """No step is quadratic in the copies of a word, a period or a phrase."""
    n = 60_000
    fib, word = [b"a"], [b"a", b"b"]
    while len(word) < n:
        fib, word = word, word + fib
    phrase = [x for k in range(n // 8) for x in (b"%d" % (k * 7919), *b"so it goes on and on".split())]
    one, many, fibs, phrases = runs.text_runs([[b"a"] * n, [b"a", b"b", b"c"] * (n // 3), word, phrase])
    assert one == [(0, n, 1)] and many == [(0, n // 3 * 3, 3)] and not phrases
    assert fibs == [] or all(length >= 4 * q for _, length, q in fibs)


def test_runs_query(spark, docs, rows):
    got = {(r.doc_id, r.collapsed_sha256): r for r in runs.digests(docs).collect()}
    for i, text, *_ in rows:
        words = runs.planted(i, (text or "").encode().split())
        found = brute_runs(words) if len(words) < 4000 else runs.text_runs([words])[0]
        kept = [w for k, w in enumerate(words)
                if not any(s + q <= k < s + n for s, n, q in found)]
        sha = hashlib.sha256(b" ".join(kept)).hexdigest()
        r = got[i, sha]
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256(
            "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 3
    kept = runs.find_runs(docs, keep={"runs": F.col("h"), "n_words": F.col("score")})
    assert kept.columns[-2:] == ["runs", "n_words"] and kept.drop("runs").count() == len(rows)


# --- op 13 ---------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    i, _, lang, source, n_chars = row[:5]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}"
                 for v in (i, source, lang, n_chars, text)])


def fold_up(nodes):
    """The levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        out.append(("".join(run[:at % 8]), "".join(run[at % 8 + 1:])))
        at //= 8
    return out


def brute_proofs(rows):
    groups = {}
    for row in rows:
        i, text = row[0], row[1]
        held = text
        if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
            held = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        key = b"" if row[2] is None else b"1" + row[2].encode()
        groups.setdefault(key, []).append((
            (i is not None, i), leaf_of(row, text), leaf_of(row, held), i))
    trees = {}
    for key, leaves in groups.items():
        leaves.sort()
        trees[key] = fold_up([x[1] for x in leaves])
    names = sorted(groups)
    top = fold_up([trees[k][-1][0] for k in names])
    out = []
    for g, key in enumerate(names):
        for at, (_, leaf, claimed, i) in enumerate(groups[key]):
            path = steps(trees[key], at) + steps(top, g)
            folded = claimed
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((i, leaf, trees[key][-1][0], top[-1][0], sha(*[x for p in path for x in p]),
                        folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got_proofs(df):
    return sorted(map(tuple, merkle.digests(df).collect()), key=str)


def test_proofs_of_odd_rows(docs, rows):
    assert got_proofs(docs) == brute_proofs(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600])
def test_proofs_by_size(spark, n):
    rows = [(k * 3 - 5, f"Text {k}", "en" if k % 3 else None, "s", k) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got_proofs(df) == brute_proofs(rows)


def test_proofs_with_more_stages_and_many_groups(spark, monkeypatch):
    """Blocks of one level each: many stages above each other, for leaves and for groups."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(k, f"T{k}", f"l{k % 11}", None, None) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got_proofs(df) == brute_proofs(rows)


def test_proofs_general(spark, none):
    assert merkle.digests(none).count() == 0
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "`id.x` int, node string, g string")
    got = merkle.proofs(df, fields=("node", "id.x"), id_col="id.x", group_col="g").collect()
    assert {r[0]: r.leaf for r in got} == {1: sha("1:a", "1:1"), 2: sha("-", "1:2")}
    assert len({r.root for r in got}) == 1 and all(r.claimed == r.leaf for r in got)

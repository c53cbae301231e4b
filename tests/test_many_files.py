"""Link ends, fits, payload files and trees that grow with the input (findings of round 4)."""

import os

import pytest
from pyspark.sql import functions as F


# ------------------------------------------------------------- link ends ---

def test_link_ends_alone_are_not_written(spark, monkeypatch):
    """resolve_refs: one output, read once, so no copy of its rows is written first."""
    from corpuslink.operators import links as L
    from tests.test_semantics import LINES, UNITS
    from corpuslink.sources.linkdump import parse_link_lines
    lines = spark.createDataFrame([*LINES, ("b.sql", None, LINES[0][2])],
                                  "file string, line_no int, value string")
    units = spark.createDataFrame(UNITS, "unit_id long, book string, chapter long, verse long")
    whole = L.import_links(parse_link_lines(lines), units)["resolved"]
    wanted = sorted(map(str, whole.collect()))
    monkeypatch.setattr(L, "written", lambda *a: pytest.fail("written"))
    alone = L.import_links(parse_link_lines(lines), units, only_resolved=True)["resolved"]
    assert alone.columns == whole.columns and sorted(map(str, alone.collect())) == wanted
    assert wanted and alone.where("to_id IS NULL").count()


# ------------------------------------------------------------ many files ---

def test_files_listed_by_tasks_are_those_spark_reads(spark, tmp_dir):
    """quarantine: same files, names, bytes and reasons as Spark's reader, none listed by it."""
    from corpuslink.sources.files import list_files, read_files
    from corpuslink.sources.payloads import quarantined_payloads, read_payloads
    top = tmp_dir + "/la nd"
    for name, body in (("book_number=1/chapter=2/p.txt", b'[{"verse": 1, "text": "a"}]'),
                       ("1_3.json", b"[\xff"), ("a b/e %20 日<>\"`|^;+&.json", b"{}"),
                       ("_h.json", b"x"), (".k.json", b"x"), ("_a=b.json", b"x"), ("c._COPYING_", b"x"),
                       ("_d/1_4.json", b"x"), ("_e=f/1_5.json", b"x"), ("g/1_6.json", b""),
                       ("_d/1_7.json", b""), ("deep/er/and/1_8.json", b"\xef\xbb\xbf[]")):
        os.makedirs(os.path.dirname(f"{top}/{name}"), exist_ok=True)
        with open(f"{top}/{name}", "wb") as f:
            f.write(body)
    theirs = spark.read.option("recursiveFileLookup", True).text(top, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.hex("value"))
    ours = read_files(list_files(spark, top)).select("file", F.hex("value"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    rows = read_payloads(spark, top)
    assert [tuple(r) for r in rows.collect()] == [(1, 2, 1, "a")]
    assert not any("/la" in f for f in rows.inputFiles())
    lost = {os.path.basename(r.file): r.reason for r in quarantined_payloads(spark, top).collect()}
    assert lost["1_6.json"] == lost["1_7.json"] == "empty file" and lost["1_3.json"] == "broken JSON"
    assert len(lost) == 7
    pattern = read_files(list_files(spark, tmp_dir + "/la*/1_*.json"))
    assert [r.value for r in pattern.select(F.hex("value").alias("value")).collect()] == ["5BFF"]
    os.makedirs(tmp_dir + "/none")
    assert read_payloads(spark, tmp_dir + "/none").count() == 0


def test_stream_of_noted_files_goes_on_oldest_first(spark, tmp_dir):
    """quarantine: the stream's batches are the oldest files first, each file in one batch, also
    over several runs, and the stream's own source holds notes, not files."""
    from corpuslink.streaming import ingest as G
    keys = ["book_number", "chapter", "verse"]

    def land(n, text, at):
        os.makedirs(tmp_dir + "/in", exist_ok=True)
        with open(f"{tmp_dir}/in/{text}_1_{n}.json", "w") as f:
            f.write('[{"verse": 1, "text": "%s"}]' % text)
        os.utime(f.name, (at, at))

    def run(**how):
        G.stream_payloads(spark, tmp_dir + "/in", tmp_dir + "/t", tmp_dir + "/c", **how) \
            .awaitTermination()
        rows = G.read_table(spark, tmp_dir + "/t", G.PAYLOAD_ROWS, keys, ["text"])
        return {r.chapter: r.text for r in rows.collect()}

    for n in range(5):
        land(n, "b", 2000 + n)
        land(n, "a", 3000 + n)
    assert run(max_files=2) == {n: "b" for n in range(5)}          # the older file wins
    assert len(os.listdir(tmp_dir + "/t/batches")) == 5
    land(9, "c", 1000)
    land(0, "c", 1000)
    assert run() == {**{n: "b" for n in range(5)}, 9: "c"}
    assert len(os.listdir(tmp_dir + "/t/batches")) == 6
    assert run(max_files=1) == {**{n: "b" for n in range(5)}, 9: "c"}
    assert len(os.listdir(tmp_dir + "/t/batches")) == 6 and os.listdir(tmp_dir + "/c/landed")
    with pytest.raises(ValueError, match="available_now"):
        run(available_now=False)


def test_tree_is_listed_read_and_patched_by_tasks(spark, tmp_dir):
    """patch_tree: names of any kind as Spark's partitions have them, no file listed by the driver,
    a patch of the same documents by the tasks, over files of other names too."""
    from corpuslink.sources.sinks import patch_tree, read_tree, tree_files, write_tree

    def blocks(names, n, text):
        return spark.createDataFrame([(b, c, s, f"{text} {s}\n") for b, c in names for s in range(n)],
                                     "book_name string, chapter string, seq long, block string")
    names = [("007", "1"), ("a+b %2B é", "2"), ("x=y/z", "3"), (None, "4"), ("A B", "5")]
    top = tmp_dir + "/t"
    write_tree(blocks(names, 3, "old"), top)
    tree = read_tree(spark, top)
    folders = {(b or "", f"Chapter_{c}.md") for b, c in names}
    assert {(r.folder, r.document) for r in tree.collect()} == folders
    assert not any("document=" in f for f in tree.inputFiles() + tree_files(spark, top).inputFiles())
    place = f"{top}/folder=A B/document=Chapter_5.md"
    os.rename(f"{place}/part-00000.txt", f"{place}/part-00007-x.c000.txt")
    files = {r.folder: (r.file, r.modified) for r in tree_files(spark, top).collect()}
    for _ in range(2):
        patch_tree(blocks([names[1], names[4], ("New", "1")], 2, "new"), top, style="vault")
        got = {r.folder: (r.content, r.n_files) for r in read_tree(spark, top).collect()}
        now = {r.folder: (r.file, r.modified) for r in tree_files(spark, top).collect()}
        old, new = ("".join(f"{w} {i}\n" for i in range(n)) for w, n in (("old", 3), ("new", 2)))
        assert got == {"007": (old, 1), "x=y/z": (old, 1), "": (old, 1), "a+b %2B é": (new, 1),
                       "A B": (new, 1), "New": (new, 1)}
        assert {k for k in now if now[k] != files.get(k)} == {"a+b %2B é", "A B", "New"}
    assert os.listdir(tmp_dir) == ["t"]
    patch_tree(blocks(names, 1, "none").limit(0), top)
    assert {r.folder: (r.file, r.modified) for r in tree_files(spark, top).collect()} == now


def test_patch_tree_opens_each_payload_file_once(spark, monkeypatch):
    from corpuslink.plans import catalog_io
    from corpuslink.session import written
    kept = []
    monkeypatch.setattr(catalog_io, "written", lambda df, name: kept.append(name) or written(df, name))
    assert catalog_io.q_patch_tree(spark, "/root/testdata/sf0.001").count() and kept == ["payload-rows"]


# ---------------------------------------------------- encoder and search ---

def test_learned_encode_encodes_the_documents_once(spark, monkeypatch):
    """learned_encode: one encoding of all documents a model, for the search and the norms."""
    from corpuslink.plans import catalog_vectors
    from corpuslink.session import written
    kept = []
    monkeypatch.setattr(catalog_vectors, "written", lambda df, name: kept.append(
        (name, df.columns)) or written(df, name))
    out = catalog_vectors.q_learned_encode(spark, "/root/testdata/sf0.001").first()
    assert out.learned_finds_more and out.unit_length and out.n_queries > 0
    assert kept == [("encoded", ["verse_id", "vec"])] * 2


def test_words_by_table_are_those_of_the_pattern():
    import numpy as np
    from corpuslink.operators import learned
    texts = ["".join(map(chr, range(128))), "It's 1,200 under_score A-B\x1cc\td", "Grüße, ÉTÉ_x 日本", "",
             "K İx", "a" * 9]
    assert [learned.tokens(t) for t in texts] == [learned.TOKEN.findall(t.lower()) for t in texts]
    learned_words = {"a": 0, "b": 1}
    idf = np.array([1.0, 2.0, 1.5, 1.5, 1.5])
    sizes, found, weights = learned.weighted_rows(["b a a zz", "", "?"], learned_words, idf)
    assert sizes.tolist() == [3, 0, 0] and found[:2].tolist() == [0, 1] and found[2] >= 2
    raw = np.array([1 + np.log(2), 2.0, 1.5])
    assert np.allclose(weights, raw / np.linalg.norm(raw))
    assert [len(x) for x in learned.weighted_rows([], learned_words, idf)] == [0, 0, 0]


def test_single_precision_tiles_give_the_double_ones_pairs(monkeypatch):
    """learned_encode's search: the same pairs and scores as products in double precision, also
    where thousands of scores lie within a single's rounding, and none by it where it overflows."""
    import numpy as np
    from corpuslink.operators import grid
    rng = np.random.default_rng(5)
    kinds = []
    real = grid.products
    monkeypatch.setattr(grid, "products", lambda q, v: kinds.append(q.dtype) or real(q, v))
    monkeypatch.setattr(grid, "TILE_QUERIES", 16)
    monkeypatch.setattr(grid, "TILE_VECTORS", 300)
    base = rng.normal(size=24)
    near = base + rng.normal(size=(900, 24)) * 1e-6
    for vectors, scale in ((rng.normal(size=(2000, 24)), 1), (near, 1), (np.vstack([near[:1]] * 800), 1),
                           (np.vstack([near, rng.normal(size=(900, 24))]), 1),
                           (rng.normal(size=(900, 24)), 1e18)):
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        queries = np.vstack([unit[:30], rng.normal(size=(10, 24)) / 5, np.zeros((1, 24))]) * scale
        order = rng.permutation(len(unit))
        score = np.round(queries @ unit.T, 6)
        for k in (1, 7):
            kinds.clear()
            q, row, found = grid.best_pairs(queries, unit, order, k)
            for i in range(len(queries)):
                best = np.lexsort((order, -score[i]))[:k]
                assert row[q == i].tolist() == best.tolist()
                assert np.allclose(found[q == i], score[i][best], rtol=1e-12, atol=0)
            assert (np.dtype(np.float32) in kinds) == (scale == 1)

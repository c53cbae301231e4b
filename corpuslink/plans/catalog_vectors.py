"""Vector queries over ``embeddings`` (O-42, O-43, O-64..O-81).

The stored vectors are scaled copies of the embeddings (times a factor from the id),
so every score here is a cosine only if the operators normalise. Query vectors come from the data: the normalised mean vector of each label
(label 3 for the single-query demos). They are one-row (or one-per-label)
aggregates, so their broadcast has a proven or checked bound.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.functions.vectors import l2_norm, l2_normalize
from corpuslink.operators import lsh as L
from corpuslink.operators import qa as QA
from corpuslink.operators import themes as T
from corpuslink.operators import vector as V
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import EDGES, VECTORS, with_
from corpuslink.session import written

QUERY_LABEL = 3
SIMILAR_TO = 7
QUESTION = "What lies near the centre of book3?"

Q1 = f"""
q AS (SELECT qv FROM centn WHERE qid = {QUERY_LABEL}),
scored AS (SELECT v.*, list_dot_product(v.unit, q.qv) AS raw,
                  round(list_dot_product(v.unit, q.qv), 6) AS score FROM vecs v, q)
"""


def _vecs(spark, sf_dir):
    return S.vector_units(spark, sf_dir)


def _query(vecs):
    return V.query_vector(vecs.filter(F.col("chapter") == QUERY_LABEL).select("vec"))


def _label_queries(vecs):
    return V.centroids(vecs, "chapter").select(
        F.col("chapter").alias("qid"), l2_normalize("centroid").alias("qvec"))


@register("vec_topk", oracle=with_(VECTORS, Q1) + """
SELECT verse_id, reference, score FROM scored WHERE raw >= 0.0
ORDER BY score DESC, verse_id LIMIT 10
""")
def q_vec_topk(spark, sf_dir):
    """O-65 + O-70: exact top-10 for one query vector."""
    v = _vecs(spark, sf_dir)
    return V.search(v, _query(v), k=10).select("verse_id", "reference", "score")


@register("vec_topk_batch", oracle=with_(VECTORS) + """
SELECT qid, CAST(rank AS INTEGER) AS rank, verse_id, score FROM (
  SELECT c.qid, v.verse_id, round(list_dot_product(v.unit, c.qv), 6) AS score,
         row_number() OVER (PARTITION BY c.qid
                            ORDER BY round(list_dot_product(v.unit, c.qv), 6) DESC, v.verse_id)
           AS rank
  FROM vecs v, centn c)
WHERE rank <= 5
""")
def q_vec_topk_batch(spark, sf_dir):
    """O-65: top-5 for a set of queries (one per label)."""
    v = _vecs(spark, sf_dir)
    return V.topk_exact(v, _label_queries(v), 5)


@register("vec_topk_batch_blas", oracle=with_(VECTORS) + """
SELECT qid, CAST(rank AS INTEGER) AS rank, verse_id, score FROM (
  SELECT c.qid, v.verse_id, round(list_dot_product(v.unit, c.qv), 6) AS score,
         row_number() OVER (PARTITION BY c.qid
                            ORDER BY round(list_dot_product(v.unit, c.qv), 6) DESC, v.verse_id)
           AS rank
  FROM vecs v, centn c)
WHERE rank <= 5
""")
def q_vec_topk_batch_blas(spark, sf_dir):
    """O-65 with the queries walked in several small blocks: the same answer."""
    v = _vecs(spark, sf_dir)
    return V.topk_exact(v, _label_queries(v), 5, block_bytes=1500)


@register("vec_filtered", oracle=with_(VECTORS, Q1) + """
SELECT verse_id, reference, score FROM scored
WHERE testament = 'Old' AND book_name IN ('book1', 'book3') AND raw >= 0.0
ORDER BY score DESC, verse_id LIMIT 10
""")
def q_vec_filtered(spark, sf_dir):
    """O-70 pre-filter mode with testament and book filters (O-42)."""
    v = _vecs(spark, sf_dir)
    return V.search(v, _query(v), k=10, testament="Old", books=["book1", "book3"]) \
        .select("verse_id", "reference", "score")


@register("vec_overfetch", oracle=with_(VECTORS, Q1) + """
SELECT verse_id, reference, score FROM (
  SELECT * FROM scored ORDER BY score DESC, verse_id LIMIT 100)
WHERE testament = 'New' AND raw >= 0.0
ORDER BY score DESC, verse_id LIMIT 10
""")
def q_vec_overfetch(spark, sf_dir):
    """O-70 parity mode (D11): rank, keep 10k, filter, keep k."""
    v = _vecs(spark, sf_dir)
    return V.search(v, _query(v), k=10, testament="New", mode="overfetch") \
        .select("verse_id", "reference", "score")


@register("vec_min_score", oracle=with_(VECTORS, Q1) + """
SELECT verse_id, score FROM scored WHERE raw >= 0.2
ORDER BY score DESC, verse_id LIMIT 100
""")
def q_vec_min_score(spark, sf_dir):
    """O-43: the score threshold cuts the result."""
    v = _vecs(spark, sf_dir)
    return V.search(v, _query(v), k=100, min_score=0.2).select("verse_id", "score")


@register("vec_similar", oracle=with_(VECTORS) + f"""
, me AS (SELECT list_transform(vec, lambda x: x / sqrt(list_sum(list_transform(vec, lambda y: y * y))))
           AS qv FROM vecs WHERE verse_id = {SIMILAR_TO})
SELECT v.verse_id, round(list_dot_product(v.unit, me.qv), 6) AS score
FROM vecs v, me WHERE v.verse_id <> {SIMILAR_TO}
ORDER BY score DESC, v.verse_id LIMIT 10
""")
def q_vec_similar(spark, sf_dir):
    """O-71: the 10 units most similar to a given unit, excluding itself by id."""
    v = _vecs(spark, sf_dir)
    return V.find_similar(v, F.col("verse_id") == SIMILAR_TO, 10).select("verse_id", "score")


@register("vec_norms", oracle=with_(VECTORS) + """
SELECT verse_id, round(sqrt(list_sum(list_transform(vec, lambda y: y * y))), 6) AS norm,
       round(sqrt(list_sum(list_transform(
         list_transform(vec, lambda x: x / sqrt(list_sum(list_transform(vec, lambda y: y * y)))),
         lambda y: y * y))), 6) AS unit_norm
FROM vecs
""")
def q_vec_norms(spark, sf_dir):
    """O-64: norms before and after L2 normalisation."""
    v = _vecs(spark, sf_dir)
    return v.select("verse_id", F.round(l2_norm("vec"), 6).alias("norm"),
                    F.round(l2_norm(l2_normalize("vec")), 6).alias("unit_norm"))


def _hits(spark, sf_dir, k):
    """The top-k search result, materialised once (k rows, reliable checkpoint)
    because the Q&A plans read it in several branches."""
    from corpuslink.session import checkpoint_dir
    checkpoint_dir(spark)
    v = S.vector_units(spark, sf_dir, with_text=True)
    return V.search(v, _query(v), k=k).select("verse_id", "reference", "text", "score") \
        .checkpoint(eager=True)


LINKED = f"""
hits AS (SELECT verse_id, reference, text, score FROM scored WHERE raw >= 0.0
         ORDER BY score DESC, verse_id LIMIT 5),
hl AS (
  SELECT h.verse_id, h.reference, p.p_brand || ' ' || CAST(p.p_size AS VARCHAR) || ':' ||
         CAST(p.p_partkey AS VARCHAR) AS to_ref, e.votes,
         row_number() OVER (PARTITION BY h.verse_id ORDER BY e.votes DESC, e.to_id) AS rank
  FROM hits h JOIN edges e ON e.from_id = h.verse_id JOIN part p ON p.p_partkey = e.to_id)
"""


@register("search_with_links", oracle=with_(VECTORS, EDGES, Q1, LINKED) + """
SELECT h.verse_id, h.score,
       coalesce((SELECT string_agg(to_ref || ' (' || CAST(votes AS VARCHAR) || ')', '; '
                                   ORDER BY rank)
                 FROM hl WHERE hl.verse_id = h.verse_id AND rank <= 5), '') AS links
FROM hits h
""")
def q_search_with_links(spark, sf_dir):
    """O-72: top-5 hits, each with up to 5 links (empty when it has none)."""
    r = QA.search_with_links(_hits(spark, sf_dir, 5), S.link_edges(spark, sf_dir),
                             S.part_units(spark, sf_dir), 5)
    return r.select("verse_id", "score", F.array_join(F.transform(
        "links", lambda s: F.concat(s["to_ref"], F.lit(" ("), s["votes"].cast("string"),
                                    F.lit(")"))), "; ").alias("links"))


@register("links_for", oracle=with_(VECTORS, EDGES, Q1, LINKED) + """
SELECT reference, CAST(rank AS INTEGER) AS rank, to_ref FROM hl WHERE rank <= 5
""")
def q_links_for(spark, sf_dir):
    """O-74: link references of a result set, one join for all hits."""
    return QA.links_for(_hits(spark, sf_dir, 5), S.link_edges(spark, sf_dir),
                        S.part_units(spark, sf_dir), 5)


@register("answer", oracle=with_(VECTORS, EDGES, Q1, LINKED) + f"""
, nums AS (SELECT *, row_number() OVER (ORDER BY score DESC, verse_id) AS i FROM hits)
SELECT '{QUESTION}' AS question,
       string_agg(CAST(i AS VARCHAR) || '. ' || reference || ': "' || text || '" (relevance: '
                  || printf('%.2f', score) || ')', chr(10) || chr(10) ORDER BY i) AS answer,
       round(avg(score), 6) AS confidence,
       count(*) AS num_verses,
       (SELECT string_agg(reference || ' -> ' || refs, '; ' ORDER BY reference) FROM (
          SELECT reference, string_agg(to_ref, ', ' ORDER BY rank) AS refs
          FROM hl WHERE rank <= 5 GROUP BY reference)) AS cross_references
FROM nums
""")
def q_answer(spark, sf_dir):
    """O-73 (+O-53): numbered answer text, mean-score confidence, links per hit."""
    a = QA.answer(QUESTION, _hits(spark, sf_dir, 5), S.link_edges(spark, sf_dir),
                  S.part_units(spark, sf_dir), 5)
    entries = F.array_sort(F.map_entries("cross_references"))
    return a.select(
        "question", "answer", F.round("confidence", 6).alias("confidence"), "num_verses",
        F.array_join(F.transform(entries, lambda e: F.concat(
            e["key"], F.lit(" -> "), F.array_join(e["value"], ", "))), "; ")
        .alias("cross_references"))


ASSIGN = """
assign AS (
  SELECT verse_id, qid AS cluster FROM (
    SELECT v.verse_id, c.qid,
           row_number() OVER (PARTITION BY v.verse_id
                              ORDER BY list_dot_product(v.unit, c.qv) DESC, c.qid) AS r
    FROM vecs v, centn c) WHERE r = 1),
members AS (SELECT v.*, a.cluster FROM vecs v JOIN assign a USING (verse_id)),
reps AS (
  SELECT * FROM (
    SELECT m.cluster, m.verse_id, m.book_name,
           round(list_dot_product(list_transform(m.vec, lambda x: x / sqrt(list_sum(
             list_transform(m.vec, lambda y: y * y)))), c.qv), 6) AS score,
           row_number() OVER (PARTITION BY m.cluster ORDER BY round(list_dot_product(
             list_transform(m.vec, lambda x: x / sqrt(list_sum(
             list_transform(m.vec, lambda y: y * y)))), c.qv), 6) DESC, m.verse_id) AS rank
    FROM members m JOIN centn c ON c.qid = m.cluster)
  WHERE rank <= 5),
profile AS (
  SELECT cluster, count(*) AS num_verses, count(*) FILTER (WHERE testament = 'Old') AS n_old,
         count(*) - count(*) FILTER (WHERE testament = 'Old') AS n_new
  FROM members GROUP BY cluster),
labels AS (
  SELECT cluster, 'Theme from ' || array_to_string(list_slice(b, 1, 3), ', ') ||
         CASE WHEN len(b) > 3 THEN ', etc.' ELSE '' END AS description
  FROM (SELECT cluster, list_sort(list_distinct(list(book_name))) AS b FROM reps
        GROUP BY cluster))
"""


def _assigned(spark, sf_dir):
    v = _vecs(spark, sf_dir)
    cents = V.centroids(v, "chapter").withColumnRenamed("chapter", "cluster")
    return V.nearest_centroid(v, cents, "cluster"), cents


@register("centroid_assign", oracle=with_(VECTORS, ASSIGN) + """
SELECT verse_id, CAST(cluster AS BIGINT) AS cluster FROM assign
""")
def q_centroid_assign(spark, sf_dir):
    """One assignment pass against fixed centroids (the label means)."""
    return _assigned(spark, sf_dir)[0].select("verse_id", "cluster")


@register("representatives", oracle=with_(VECTORS, ASSIGN) + """
SELECT CAST(cluster AS BIGINT) AS cluster, CAST(rank AS INTEGER) AS rank, verse_id, score
FROM reps
""")
def q_representatives(spark, sf_dir):
    """O-76: 5 members closest to their normalised centroid."""
    a, c = _assigned(spark, sf_dir)
    return T.representatives(a, c.withColumn("cluster", F.col("cluster").cast("long")), 5) \
        .select("cluster", "rank", "verse_id", "score")


@register("cluster_profile", oracle=with_(VECTORS, ASSIGN) + """
SELECT CAST(cluster AS BIGINT) AS cluster, num_verses, n_old, n_new FROM profile
""")
def q_cluster_profile(spark, sf_dir):
    """O-77: cluster size with its Old / New split."""
    return T.cluster_profile(_assigned(spark, sf_dir)[0])


@register("theme_label", oracle=with_(VECTORS, ASSIGN) + """
SELECT CAST(cluster AS BIGINT) AS cluster, description FROM labels
""")
def q_theme_label(spark, sf_dir):
    """O-78: theme text from the representatives' books."""
    a, c = _assigned(spark, sf_dir)
    reps = T.representatives(a, c.withColumn("cluster", F.col("cluster").cast("long")), 5)
    return T.theme_label(reps)


@register("themes", oracle=with_(VECTORS, ASSIGN) + """
SELECT CAST(p.cluster AS BIGINT) AS theme_id, p.num_verses, p.n_old, p.n_new, l.description,
       CAST(row_number() OVER (ORDER BY p.num_verses DESC, p.cluster) AS INTEGER) AS theme_rank
FROM profile p LEFT JOIN labels l USING (cluster)
""")
def q_themes(spark, sf_dir):
    """O-79: themes ranked by size."""
    a, c = _assigned(spark, sf_dir)
    reps = T.representatives(a, c.withColumn("cluster", F.col("cluster").cast("long")), 5)
    return T.themes(T.cluster_profile(a), T.theme_label(reps))


@register("kmeans_sizes", oracle="""
SELECT count(*) AS n_vectors, 10 AS n_clusters, CAST(0 AS BIGINT) AS n_elsewhere FROM embeddings
""")
def q_kmeans_sizes(spark, sf_dir):
    """O-75: k-means (k=10, seed 42, 10 restarts). No engine repeats the random fit, so
    its properties are compared: sizes sum to the vectors, no cluster is empty, and every
    vector is with its nearest centre."""
    v = _vecs(spark, sf_dir).select("verse_id", "vec")
    fit = T.cluster(v, k=10, seed=42, n_init=10)
    sizes = T.cluster_sizes(fit["assigned"]).agg(
        F.sum("num_verses").alias("n_vectors"), F.count(F.lit(1)).cast("int").alias("n_clusters"))
    elsewhere = _distances(fit).agg(F.count_if(F.col("own") > F.col("least") + 1e-9)).scalar()
    return sizes.withColumn("n_elsewhere", elsewhere)


@register("themes_discovered", oracle="""
SELECT count(*) AS n_verses, 10 AS n_themes, CAST(55 AS BIGINT) AS ranks,
       count(*) FILTER (WHERE label < 5) AS n_old, true AS labelled
FROM embeddings
""")
def q_themes_discovered(spark, sf_dir):
    """O-75..O-79 end to end from the fit; its sums compare (ranks 1..10 sum to 55)."""
    t = T.discover(_vecs(spark, sf_dir), k=10, n=5, n_init=2)
    return t.agg(F.sum("num_verses").alias("n_verses"), F.count(F.lit(1)).cast("int").alias(
        "n_themes"), F.sum("theme_rank").alias("ranks"), F.sum("n_old").alias("n_old"),
        F.bool_and(F.col("description").startswith("Theme from ")
                   & F.size("representatives").between(1, 5)).alias("labelled"))


@register("vec_ann_allcells", oracle=with_(VECTORS) + """
SELECT qid, CAST(rank AS INTEGER) AS rank, verse_id, score FROM (
  SELECT c.qid, v.verse_id, round(list_dot_product(v.unit, c.qv), 6) AS score,
         row_number() OVER (PARTITION BY c.qid
                            ORDER BY round(list_dot_product(v.unit, c.qv), 6) DESC, v.verse_id)
           AS rank
  FROM vecs v, centn c)
WHERE rank <= 5
""")
def q_vec_ann_allcells(spark, sf_dir):
    """O-67: IVF search probing every cell equals exact search."""
    v = _vecs(spark, sf_dir)
    idx = V.build_ivf(v.select("verse_id", "vec"), nlist=8, target_recall=None)
    return V.topk_ann(idx, _label_queries(v), 5, nprobe=8)


@register("cluster_units", oracle="""
SELECT vec_id AS verse_id, true AS in_range, true AS is_nearest FROM embeddings
""")
def q_cluster_units(spark, sf_dir):
    """O-80: every vector with its k-means cluster (k=50), once, in 0..49, and no centre nearer
    than its own (recomputed from the centres, apart from the assignment)."""
    fit = T.cluster(_vecs(spark, sf_dir).select("verse_id", "vec"), k=50, n_init=1)
    return _distances(fit).select("verse_id", F.col("cluster").between(0, 49).alias("in_range"),
                                  (F.col("own") <= F.col("least") + 1e-9).alias("is_nearest"))


def _distances(fit):
    """(verse_id, cluster, own, least): squared distances from the own and the nearest centre."""
    all_ = fit["centroids"].agg(F.collect_list(F.struct("cluster", "centroid"))).scalar()  # k rows
    gaps = fit["assigned"].select("verse_id", "cluster", l2_normalize("vec").alias("u"),
                                  all_.alias("_c")).withColumn("gaps", F.transform(
        "_c", lambda c: F.struct(c["cluster"].alias("other"), F.aggregate(F.zip_with(
            "u", c["centroid"], lambda x, y: (x - y) * (x - y)), F.lit(0.0),
            lambda a, x: a + x).alias("d"))))
    return gaps.select("verse_id", "cluster", F.array_min(F.transform("gaps", lambda g: g["d"])).alias(
        "least"), F.filter("gaps", lambda g: g["other"] == F.col("cluster"))[0]["d"].alias("own"))


# The raw vectors and their unit vectors; queries are the ids divisible by 20.
RAW = """
raw AS (
  SELECT vec_id AS verse_id, label, list_transform(vec, lambda x: x / sqrt(list_sum(list_transform(
         vec, lambda y: y * y)))) AS unit
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)),
exact AS (
  SELECT qid, verse_id FROM (
    SELECT q.verse_id AS qid, v.verse_id, row_number() OVER (PARTITION BY q.verse_id ORDER BY
           round(list_dot_product(q.unit, v.unit), 6) DESC, v.verse_id) AS r
    FROM raw q, raw v) WHERE r <= 10)
"""


def _raw_vectors(spark, sf_dir):
    return S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("verse_id"), "label",
        F.col("embedding").cast("array<double>").alias("vec"))


def _twentieth(vecs):
    return vecs.where(F.col("verse_id") % 20 == 0).select(
        F.col("verse_id").alias("qid"), F.col("vec").alias("qvec"))


@register("ann_recall", oracle=with_(RAW, """
cells AS (SELECT label AS cell, list(m ORDER BY i) AS c FROM (
  SELECT label, i, avg(x) AS m FROM (
    SELECT label, unnest(unit) AS x, unnest(range(1, len(unit) + 1)) AS i FROM raw)
  GROUP BY label, i) GROUP BY label),
near AS (SELECT verse_id, cell, list_dot_product(unit, c) / sqrt(list_dot_product(c, c)) AS s
         FROM raw, cells),
dealt AS (SELECT verse_id, arg_max(cell, s) AS cell FROM near GROUP BY verse_id),
probed AS (SELECT verse_id AS qid, cell, row_number() OVER (
             PARTITION BY verse_id ORDER BY round(s, 6) DESC, cell) AS place FROM near),
hits AS (SELECT qid, verse_id, place FROM exact JOIN dealt USING (verse_id)
         JOIN probed USING (qid, cell)),
chosen AS (SELECT min(place) AS nprobe FROM (
  SELECT place, sum(count(*)) OVER (ORDER BY place) AS seen FROM hits GROUP BY place)
  WHERE seen >= 0.9 * (SELECT count(*) FROM hits))
""") + """
SELECT nprobe, (SELECT count(*) FROM cells) AS n_cells, count(*) AS n_exact,
       count(*) FILTER (WHERE place <= nprobe) AS n_hit,
       count(*) FILTER (WHERE place <= nprobe) / count(*) AS recall
FROM hits, chosen WHERE qid % 20 = 0 GROUP BY nprobe
""")
def q_ann_recall(spark, sf_dir):
    """O-81: recall@10 of IVF against exact search, the queries being every twentieth vector.
    The cells are the labels' centroids; how many are probed the index finds itself: the
    least that hold nine tenths of all vectors' nearest neighbours."""
    v = _raw_vectors(spark, sf_dir)
    cells = V.centroids(V.normalize(v), "label").select(
        F.col("label").cast("long").alias("cell"), "centroid")
    index = V.ivf_from_cells(v.select("verse_id", "vec"), cells, 0.9, 10, sample=None)
    q = _twentieth(v)
    out = V.recall_at_k(V.topk_ann(index, q, 10), V.topk_exact(v, q, 10))
    return out.withColumns({"nprobe": F.lit(index["nprobe"]).cast("long"),
                            "n_cells": cells.agg(F.count(F.lit(1))).scalar()})


@register("lsh_recall", oracle=with_(RAW, f"""
plane AS (SELECT p, list(sign ORDER BY d) AS w FROM (
  SELECT p, d, CASE WHEN (bit_count((p % 64) & d) + (strpos('89abcdef', md5((p // 64) || ':' || d)[1])
         > 0)::INT) % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign
  FROM range({L.BITS * L.TABLES}) AS a(p), range(64) AS b(d)) GROUP BY p),
same AS (SELECT min(verse_id) AS rep, unit FROM raw GROUP BY unit),
side AS (SELECT rep, p // {L.BITS} AS tbl, p % {L.BITS} AS b, list_dot_product(unit, w) AS far
         FROM same, plane),
code AS (SELECT rep, tbl, sum(CASE WHEN far > 0 THEN 1 << b ELSE 0 END)::BIGINT AS code
         FROM side GROUP BY rep, tbl),
asked AS (SELECT r.verse_id AS qid, s.rep FROM raw r JOIN same s USING (unit)
          WHERE r.verse_id % 20 = 0),
cost AS (SELECT rep, tbl, m, round(sum(CASE WHEN (m >> b) & 1 = 1 THEN far * far ELSE 0 END), 9) AS c
         FROM side, (SELECT range AS m FROM range({1 << L.BITS}) WHERE bit_count(range) <= {L.MAX_FLIPS})
         WHERE rep IN (SELECT rep FROM asked) GROUP BY rep, tbl, m),
probe AS (SELECT rep, tbl, m FROM (SELECT *, row_number() OVER (
            PARTITION BY rep, tbl ORDER BY c, m) AS r FROM cost) WHERE r <= {L.PROBES}),
cand AS (SELECT DISTINCT a.qid, c.rep FROM asked a JOIN probe p ON p.rep = a.rep
         JOIN code q ON q.rep = a.rep AND q.tbl = p.tbl
         JOIN code c ON c.tbl = p.tbl AND c.code = xor(q.code, p.m)),
got AS (SELECT qid, verse_id FROM (
  SELECT c.qid, v.verse_id, row_number() OVER (PARTITION BY c.qid ORDER BY
         round(list_dot_product(q.unit, v.unit), 6) DESC, v.verse_id) AS r
  FROM cand c JOIN same s ON s.rep = c.rep JOIN raw v ON v.unit = s.unit
  JOIN raw q ON q.verse_id = c.qid) WHERE r <= 10),
wanted AS (SELECT * FROM exact WHERE qid % 20 = 0)
""") + """
SELECT count(*) AS n_exact, count(g.qid) AS n_hit, count(g.qid) / count(*) AS recall,
       (SELECT count(*) FROM cand) / ((SELECT count(*) FROM asked) * (SELECT count(*) FROM same))
         AS scored
FROM wanted w LEFT JOIN got g ON g.qid = w.qid AND g.verse_id = w.verse_id
""")
def q_lsh_recall(spark, sf_dir):
    """O-67 by hyperplane signatures: recall@10 for every twentieth vector against exact search
    over all, and the share of pairs that were scored."""
    v = _raw_vectors(spark, sf_dir).select("verse_id", "vec")
    return L.search_report(L.build_lsh(v), v, _twentieth(v), 10)


ENCODED = 512                   # texts that learned_encode's models are handed at a time


@register("learned_encode", oracle="""
SELECT count(*) AS n_queries, true AS learned_finds_more, true AS unit_length
FROM documents WHERE doc_id % 20 = 0
""")
def q_learned_encode(spark, sf_dir):
    """O-62, O-92: an encoder fitted on all documents against feature hashing of the same size:
    from the later half of its words, every twentieth document is sought among all. The fit is
    random, so what must hold is compared: vectors of length one, and no fewer documents found
    first than by hashing."""
    from corpuslink.operators import embed as E
    from corpuslink.operators import learned
    docs = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("verse_id"), "text")
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    halves = docs.where(F.col("verse_id") % 20 == 0).select(
        F.col("verse_id").alias("qid"), "text", F.coalesce(F.array_join(F.slice(
            words, F.floor(F.size(words) / 2).cast("int") + 1, F.size(words) + 1), " "),
            F.lit("")).alias("half"))

    def first(encoder, dim):
        # encoded once, read by the search and the norms
        vecs = written(E.encode(docs, encoder, dim, ENCODED).select("verse_id", "vec"), "encoded")
        asked = E.encode(halves.select("qid", F.col("half").alias("text")), encoder, dim)
        top = V.topk_exact(vecs, asked.select("qid", F.col("vec").alias("qvec")), 1)
        # an exact copy of the document is as good as itself
        hit = top.join(docs, "verse_id").join(halves.select("qid", F.col("text").alias("own")), "qid") \
            .agg(F.count_if(F.col("text") == F.col("own")))
        return vecs, hit

    vecs, found = first(learned.svd_model(spark, learned.fit(docs)), 128)
    _, hashed = first(None, 128)
    norms = vecs.agg(F.bool_and((F.abs(l2_norm("vec") - 1) < 1e-5) | (l2_norm("vec") == 0)))
    return halves.agg(F.count(F.lit(1)).alias("n_queries")).select(
        "n_queries", (found.scalar() >= hashed.scalar()).alias("learned_finds_more"),
        norms.scalar().alias("unit_length"))

"""Link queries: views, top-k per source, nesting, degree (O-36, O-40, O-50..O-52)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.operators.links import (
    links_by_key, links_view, out_degree, top_links, top_links_readable,
)
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import EDGES, ENDS, ref, with_

TOP_ALL_SQL = with_(EDGES, ENDS, """
ranked AS (
  SELECT e.from_id, e.to_id, e.votes, t.to_book, t.to_chapter, t.to_verse,
         row_number() OVER (PARTITION BY e.from_id ORDER BY e.votes DESC, e.to_id) AS rank
  FROM edges e JOIN to_units t ON t.to_id = e.to_id)
""") + f"""
SELECT r.from_id, CAST(r.rank AS INTEGER) AS rank, r.to_id,
       {ref('f.from_book', 'f.from_chapter', 'f.from_verse')} AS from_ref,
       {ref('r.to_book', 'r.to_chapter', 'r.to_verse')} AS to_ref,
       r.votes
FROM ranked r JOIN from_units f ON f.from_id = r.from_id
WHERE r.rank <= {{n}}
"""


def top_links_n(spark, sf_dir, n):
    return top_links_readable(S.link_edges(spark, sf_dir), S.order_units(spark, sf_dir),
                              S.part_units(spark, sf_dir), n)


@register("top_links_all", oracle=TOP_ALL_SQL.format(n=10))
def q_top_links_all(spark, sf_dir):
    """O-51 + O-86: the 10 best links of every source, readable."""
    return top_links_n(spark, sf_dir, 10)


@register("top5_links_readable", oracle=TOP_ALL_SQL.format(n=5))
def q_top5_links(spark, sf_dir):
    """Flagship: top-5 links of every source with readable references."""
    return top_links_n(spark, sf_dir, 5)


def _view(spark, sf_dir):
    return links_view(S.link_edges(spark, sf_dir), S.order_units(spark, sf_dir),
                      S.part_units(spark, sf_dir))


@register("links_view", oracle=with_(EDGES, ENDS) + """
SELECT e.from_id, e.to_id, f.from_book, f.from_chapter, f.from_verse,
       t.to_book, t.to_chapter, t.to_verse, e.votes
FROM edges e JOIN from_units f ON f.from_id = e.from_id JOIN to_units t ON t.to_id = e.to_id
""")
def q_links_view(spark, sf_dir):
    """O-36: every link with both ends readable."""
    return _view(spark, sf_dir)


# The single source asked for by the point query (a query parameter, as in the
# reference's demo): order 7.
ONE_SOURCE = 7


@register("top_links_one", oracle=with_(EDGES, ENDS) + f"""
SELECT f.from_book, f.from_chapter, f.from_verse, t.to_book, t.to_chapter, t.to_verse, e.votes
FROM edges e JOIN from_units f ON f.from_id = e.from_id JOIN to_units t ON t.to_id = e.to_id
WHERE f.from_verse = {ONE_SOURCE}
ORDER BY e.votes DESC, e.to_id LIMIT 5
""")
def q_top_links_one(spark, sf_dir):
    """O-40: top-5 links of one source by votes (the source is given by its key)."""
    return top_links(_view(spark, sf_dir), verse=ONE_SOURCE, k=5).select("from_book", "from_chapter", "from_verse", "to_book", "to_chapter",
                "to_verse", "votes")


RANKED_SQL = with_(EDGES, ENDS, """
ranked AS (
  SELECT e.from_id, e.to_id, e.votes, t.to_book, t.to_chapter, t.to_verse,
         row_number() OVER (PARTITION BY e.from_id ORDER BY e.votes DESC, e.to_id) AS rank
  FROM edges e JOIN to_units t ON t.to_id = e.to_id)
""")


@register("links_nested", oracle=RANKED_SQL + f"""
SELECT r.from_id,
       string_agg({ref('r.to_book', 'r.to_chapter', 'r.to_verse')} || ' (' ||
                  CAST(r.votes AS VARCHAR) || ')', '; ' ORDER BY r.rank) AS links
FROM ranked r JOIN from_units f ON f.from_id = r.from_id
WHERE r.rank <= 10
GROUP BY r.from_id
""")
def q_links_nested(spark, sf_dir):
    """O-52: each source's retained links as one nested list (shown as text)."""
    nested = links_by_key(top_links_n(spark, sf_dir, 10), "from_id", ("to_ref", "votes"))
    return nested.select("from_id", F.array_join(F.transform(
        "links", lambda s: F.concat(s["to_ref"], F.lit(" ("), s["votes"].cast("string"),
                                    F.lit(")"))), "; ").alias("links"))


@register("out_degree", oracle=with_(EDGES) + """
SELECT from_id, count(*) AS out_degree FROM edges GROUP BY from_id
""")
def q_out_degree(spark, sf_dir):
    """O-50: links per source."""
    return out_degree(S.link_edges(spark, sf_dir))

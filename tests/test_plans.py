"""Plan guardrails: properties the physical plans must keep at any scale."""

import pytest

from corpuslink.plans.registry import load_all
from tests.conftest import SF_SMALL

# Queries whose builders run jobs (writes, ML fits, checkpoints) are left out.
RUNS_JOBS = {"payload_ingest", "payload_backfill", "stream_ingest", "table_roundtrip",
             "embedding_sink", "document_sink", "index_roundtrip", "kmeans_sizes",
             "vec_ann_allcells", "ann_recall", "canonical_order", "dense_ids",
             "cluster_units", "themes_discovered", "document_tree", "backfill_render",
             "book_table", "text_query_search", "dump_parse", "range_expand", "resolve_refs",
             "edge_import", "import_report", "reject_sample", "vec_topk_batch_blas",
             "centroid_assign", "representatives", "cluster_profile", "theme_label", "themes"}
NAMES = sorted(n for n in load_all() if n not in RUNS_JOBS)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_products(spark, name):
    plan = physical(load_all()[name][0](spark, SF_SMALL))
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("name", ["top_links_all", "links_nested", "vec_topk_batch",
                                  "render_linked"])
def test_topk_is_limited_before_the_shuffle(spark, name):
    plan = physical(load_all()[name][0](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan, name


def test_flagship_prunes_columns_and_pushes_filters(spark):
    import __spark_entry__ as E
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint," \
           "l_linenumber:int,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_partkey), IsNotNull(l_orderkey)]" in plan


@pytest.mark.parametrize("name,pushed", [
    ("top_links_one", "EqualTo(l_orderkey,7)"),   # through the join and the dedupe key
    ("unit_lookup", "EqualTo(doc_id,3)"),
    ("chapter_head", "EqualTo(doc_id,5)"),
])
def test_point_lookups_reach_the_scan(spark, name, pushed):
    plan = physical(load_all()[name][0](spark, SF_SMALL))
    assert pushed in plan, name

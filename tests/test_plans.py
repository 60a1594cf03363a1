"""Plan shapes that the scale design relies on."""

import pytest

import __spark_entry__ as E
from conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frontier_prunes_columns_and_combines_map_side(spark):
    p = plan(E.queries()["crawl_frontier"](spark, SMOKE))
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p or \
        "struct<page_id:bigint,url:string,html:string>" in p
    # the first-occurrence pick is a partial aggregate below the shuffle on url
    assert "partial_min" in p


def test_scan_pushes_filter_and_projection(spark):
    p = plan(E.queries()["seed_scan"](spark, SMOKE))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in p


@pytest.mark.parametrize("name", ["allowed_domain_links", "strip_tags", "html_blocks", "url_path_tokens",
                                  "label_value_fields", "product_cards"])
def test_per_page_jobs_do_not_join(spark, name):
    p = plan(E.queries()[name](spark, SMOKE))
    assert "Join" not in p, name

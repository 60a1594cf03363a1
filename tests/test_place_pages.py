"""Place pages at size: rows are dealt out before they become pages, and tidy
markup, cut by a pattern, gives what the folds give."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pageloom.functions import html as H

NAMES = ["label_value_fields", "label_value_fallback", "page_kind_branch"]


@pytest.mark.parametrize("name", NAMES)
def test_a_file_of_one_split_is_dealt_out(spark, tmp_path, name):
    rows = [(i, f"Customer {i}", i % 25, i / 4, "BUILDING" if i % 2 else "MACHINERY") for i in range(400)]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1) \
        .write.parquet(f"{tmp_path}/customer.parquet")
    found = E.queries()[name](spark, str(tmp_path))
    held = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sum(r["count"] for r in held) == 400
    assert len(held) >= 8 and max(r["count"] for r in held) <= 200


TABLE = '<table width="1" bgcolor="c"><tr><td><b>k</b>: v<br>w</td> <td><table><tr><td>in</td></tr></table></td></tr><tr></tr></table>'


@pytest.mark.parametrize("fragment, cut, n", [
    (TABLE + TABLE, lambda c: H.elements(c, H.Element("tr"), level=1), 4),
    ("<tr><td>a</td><td>" + TABLE.replace("<td><table><tr><td>in</td></tr></table></td>", "") + "</td></tr>", lambda c: H.elements(c, H.Element("td"), level=0), 2),
    ("<td><table><tr><td>a</td></tr></table>x</td><td></td>", lambda c: H.elements(c, H.Element("table"), level=0), 1),
    ("x" + TABLE + "<i>y</i>" + TABLE, lambda c: H.children(c, "table"), 2),
    ("<td><strong>k</strong>a&amp;b<br>c</td><td>d</td>", lambda c: H.direct_texts(c, level=1), 3)])
def test_patterns_and_folds_agree(spark, fragment, cut, n):
    # a comment makes markup untidy, and is no part of what is cut here
    tidy, folded = (r.found for r in spark.createDataFrame([(1, fragment), (2, fragment + "<!-- -->")], "k int, f string")
                    .select("k", cut("f").alias("found")).orderBy("k").collect())
    assert tidy == folded and len(tidy) == n


def test_the_open_elements_of_the_fold(spark):
    fragment = "<ul><li>a<p>b<div>c</div><li>d<table><tr><td>e<td>f</table></li></ul><dl><dt>h<dd>i</dd></dl><a>j<a>k</a></b>l"
    row = spark.createDataFrame([(fragment,)], "f string").select(
        H.children("f", "li", level=1).alias("li"), H.direct_texts("f").alias("own"), H.children("f", "a").alias("a"),
        H.children("f", "dd", level=1).alias("dd")).first()
    assert row.li == ["<li>a<p>b<div>c</div>", "<li>d<table><tr><td>e<td>f</table></li>"]
    assert row.own == ["l"] and row.a == ["<a>j", "<a>k</a>"] and row.dd == ["<dd>i</dd>"]

"""Hierarchy paths on dirty data and against a brute-force walk."""

import random

from pyspark.sql import functions as F

from pageloom.operators import hierarchy as HI
from pageloom.operators import frontier as FR
from pageloom.operators.frontier import crawl_to_fixpoint


def brute(nodes):
    parent = dict(nodes)
    out = {}
    for i in parent:
        path, seen, k, status = [i], {i}, parent[i], "ok"
        while k:
            if k not in parent:
                status = "orphan"
                break
            if k in seen:
                status = "cycle"
                break
            path.insert(0, k)
            seen.add(k)
            k = parent[k]
        if status == "cycle":
            out[i] = (None, None, "cycle")
        else:
            out[i] = ("|".join(map(str, path)), len(path), status)
    # a node whose chain runs into a cycle is a cycle row as well
    return out


def run(spark, nodes):
    df = spark.createDataFrame(nodes, "id bigint, pid bigint")
    rows = HI.hierarchy_paths(df).collect()
    return {r["id"]: (r["path"], r["level"], r["status"]) for r in rows}


def test_dirty_tree(spark):
    nodes = [(1, None), (2, 1), (3, 2), (4, 0), (5, 99), (6, 5), (7, 7), (8, 9), (9, 8),
             (10, 11), (11, 12), (12, 10), (13, 10), (14, 13)]
    got = run(spark, nodes)
    assert got[1] == ("1", 1, "ok")
    assert got[3] == ("1|2|3", 3, "ok")
    assert got[4] == ("4", 1, "ok")
    assert got[5] == ("5", 1, "orphan")
    assert got[6] == ("5|6", 2, "orphan")
    for i in (7, 8, 9, 10, 11, 12, 13, 14):
        assert got[i] == (None, None, "cycle"), i


def test_random_forests_match_brute_force(spark):
    rnd = random.Random(7)
    for _ in range(3):
        n = 300
        nodes = []
        for i in range(1, n + 1):
            r = rnd.random()
            pid = 0 if r < 0.05 else (None if r < 0.07 else rnd.randint(1, n + 20))
            nodes.append((i, pid))
        assert run(spark, nodes) == brute(nodes)


def test_tree_stats_root_row_and_levels(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 2), (5, None)], "id bigint, pid bigint")
    rows = sorted(tuple(r) for r in HI.tree_stats(df).collect())
    assert rows == [(1, "", 1), (2, "|1", 2), (3, "|1|2", 1), (3, "|1|3", 0), (4, "|1|2|4", 0)]
    lines = [r[0] for r in HI.stat_lines(HI.tree_stats(df)).collect()]
    assert lines[0] == "1\t\t1"


def test_fixpoint_depth(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (9, 10)], "src bigint, dst bigint")
    seeds = spark.createDataFrame([(1,)], "node bigint")
    got = {r["node"]: r["depth"] for r in crawl_to_fixpoint(edges, seeds).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3}


def test_path_names_reports_missing(spark):
    rows = spark.createDataFrame([("c1", "1|2"), ("c2", "1|9")], "city_id string, path string")
    names = spark.createDataFrame([("1", "A"), ("2", "B")], "city_id string, city_name string")
    got = {r["city_id"]: (r["name_path"], r["missing"]) for r in HI.path_names(rows, names).collect()}
    assert got == {"c1": (["A", "B"], 0), "c2": (None, 1)}


def test_children_long_form(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id bigint, pid bigint")
    got = sorted(tuple(r) for r in HI.children(df).select("pid", "id", "n_children").collect())
    assert got == [(0, 1, 1), (1, 2, 2), (1, 3, 2)]
    assert F is not None


def test_path_names_numeric_tokens(spark):
    rows = spark.createDataFrame([(1, "01|2"), (2, "1|x")], "city_id bigint, path string")
    names = spark.createDataFrame([(1, "A"), (2, "B")], "id bigint, name string")
    got = {r["city_id"]: (r["name_path"], r["missing"]) for r in
           HI.path_names(rows, names, id_col="id", name_col="name", numeric_ids=True).collect()}
    assert got == {1: (["A", "B"], 0), 2: (None, 1)}


def test_pointer_doubling_equals_recursive_cte(spark):
    from conftest import SMOKE
    from pageloom.sources.tables import read_table
    part = read_table(spark, SMOKE, "part")
    nodes = part.select((F.col("p_partkey") + 1).alias("id"), ((F.col("p_partkey") + 1) / 2).cast("bigint").alias("pid"))
    nodes.createOrReplaceTempView("heap_nodes")
    cte = spark.sql("""
        WITH RECURSIVE walk(id, path, level) AS (
          SELECT id, CAST(id AS STRING), 1 FROM heap_nodes WHERE pid = 0 OR pid IS NULL
          UNION ALL
          SELECT n.id, concat(w.path, '|', CAST(n.id AS STRING)), w.level + 1
          FROM walk w JOIN heap_nodes n ON n.pid = w.id)
        SELECT id, path, level FROM walk""")
    want = {r["id"]: (r["path"], r["level"]) for r in cte.collect()}
    got = {r["id"]: (r["path"], r["level"]) for r in HI.hierarchy_paths(nodes).collect()}
    assert got == want and len(got) == nodes.count()


def test_fixpoint_long_chain_with_compaction(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(5, 0)], "src bigint, dst bigint")
    seeds = spark.createDataFrame([(0,)], "node bigint")
    got = {r["node"]: r["depth"] for r in crawl_to_fixpoint(edges, seeds, compact_every=4).collect()}
    assert got == {i: i for i in range(41)}


def test_fixpoint_of_a_hub_equals_brute_force(spark):
    rnd = random.Random(8)
    links = [(7, 100 + i) for i in range(300)] + [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(500)]
    edges = spark.createDataFrame(links + links[:50] + [(None, 3), (7, None)], "src bigint, dst bigint")
    depths, new = {0: 0, 3: 0}, {0, 3}
    while new:
        new = {d for s, d in links if s in new} - set(depths)
        depths |= dict.fromkeys(new, max(depths.values()) + 1)
    seeds = spark.createDataFrame([(0,), (3,), (3,)], "node bigint")
    got = [tuple(r) for r in crawl_to_fixpoint(edges, seeds, compact_every=2).collect()]
    assert len(got) == len(dict(got)) and dict(got) == depths


def test_a_round_shuffles_neither_edges_nor_seen_nodes(spark):
    links = spark.createDataFrame([(7, i) for i in range(90)] + [(i, i + 1) for i in range(90)], "src bigint, dst bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        parted, hubs = FR._spread(links, 8)
        assert [r["hub"] for r in hubs.collect()] == [7] and parted.where("src = 7").select("part").distinct().count() == 9
        edges = FR.materialize_bucketed(parted, ["src", "part"], "edges")
        seen = [FR.materialize_bucketed(spark.range(i, i + 3).select(F.col("id").alias("node")), ["node"], "round") for i in (0, 5)]
        plan = FR._not_in(FR._links_from(seen[-1], edges, hubs).distinct(), seen)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["node"] for r in plan.collect()) == [n for n in range(90) if n not in (0, 1, 2, 5, 6, 7)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the frontier moves to the edges, what it reaches to the seen nodes
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Bucketed: true") == 4

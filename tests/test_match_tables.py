"""Fuzzy match against brute force; table-maintenance semantics."""

import random

from pyspark.sql import functions as F

from pageloom.operators import match as MA
from pageloom.operators import tables as TB
from pageloom.operators.windows import first_by, first_by_window


def brute_match(left, right):
    out = {}
    for sid, a in left:
        best = None
        for cid, b in right:
            if len(a) == len(b) and all(x.find(y) >= 0 or y.find(x) >= 0 for x, y in zip(a, b)):
                best = cid if best is None else min(best, cid)
        out[sid] = best
    return out


def test_fuzzy_match_brute_force(spark):
    rnd = random.Random(3)
    words = ["", "a", "ab", "abc", "b", "bc", "NATION_1", "NATION_10", "x", "xa"]
    left = [(i, [rnd.choice(words) for _ in range(rnd.randint(1, 3))]) for i in range(60)]
    right = [(f"c{i:03d}", [rnd.choice(words) for _ in range(rnd.randint(1, 3))]) for i in range(60)]
    L = spark.createDataFrame(left, "sid int, names array<string>")
    R = spark.createDataFrame(right, "city_id string, names array<string>")
    got = {r["sid"]: r["city_id"] for r in MA.fuzzy_path_match(L, R).collect()}
    assert got == brute_match(left, right)


def test_fuzzy_match_of_any_piece_length(spark):
    rnd = random.Random(11)
    words = ["", "a", "ab", "bab", "abab", "ababab", "é", "aé漢", "漢字の名", "x漢字の名y", "Springfield", "Springfield Park", "field P"]
    names = [[rnd.choice(words) for _ in range(rnd.randint(1, 4))] for _ in range(80)] + [[], None, ["a", None]]
    known = [(i, n) for i, n in enumerate(names)]
    L = spark.createDataFrame(known[::2] + known[-3:], "sid int, names array<string>")
    R = spark.createDataFrame([(f"c{i:03d}", n) for i, n in known[1::2] + known[:1]], "city_id string, names array<string>")
    whole = lambda rows: [(i, n) for i, n in rows if n is not None and None not in n]
    want = dict.fromkeys([r["sid"] for r in L.collect()]) | brute_match(
        whole([tuple(r) for r in L.collect()]), whole([tuple(r) for r in R.collect()]))
    for gram in (1, 3, 4):
        assert {r["sid"]: r["city_id"] for r in MA.fuzzy_path_match(L, R, gram=gram).collect()} == want, gram


def test_a_common_name_does_not_meet_all_others(spark):
    """One name on a third of the paths of both sides: what is compared
    grows with the paths, not with their square."""
    def compared(n):
        paths = [[f"land {i % 3}", "Springfield" if i % 3 == 0 else f"town {i:05d} of many", f"street {i * 7919 % 100003:06d}"]
                 for i in range(n)]
        L = spark.createDataFrame([(p, [True] * 3) for p in paths], "lnames array<string>, lform array<boolean>")
        R = spark.createDataFrame([(p, f"c{i:05d}", [True] * 3) for i, p in enumerate(paths)],
                                  "rnames array<string>, rk string, rform array<boolean>")
        shared = spark.createDataFrame([([True] * 3, [True] * 3, [0, 1, 2])],
                                       "lform array<boolean>, rform array<boolean>, levels array<int>")
        idx = MA.index(R, 4)
        chosen = MA.cheapest_levels(L, shared, idx, 4)
        return MA.candidates(chosen, idx, 4).count()

    assert compared(300) == 300 and compared(1200) == 1200


def test_first_by_equals_window(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 5), i, rnd.randint(0, 3), f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, i int, o int, v string")
    a = sorted(tuple(r) for r in first_by(df, ["k"], ["o", "i"], ["v"]).select("k", "o", "i", "v").collect())
    b = sorted(tuple(r) for r in first_by_window(df, ["k"], ["o", "i"]).select("k", "o", "i", "v").collect())
    assert a == b


def test_insert_ignore(spark):
    old = spark.createDataFrame([("u1", 1, "stored")], "url string, pos int, t string")
    new = spark.createDataFrame([("u1", 0, "x"), ("u2", 5, "late"), ("u2", 2, "early")], "url string, pos int, t string")
    got = sorted(tuple(r) for r in TB.insert_ignore(old, new, ["url"], ["pos"]).collect())
    assert got == [("u1", 1, "stored"), ("u2", 2, "early")]


def test_upsert_absent_vs_empty(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, c1 string, c2 string")
    new = spark.createDataFrame([(1, None, ""), (3, "c", None)], "k int, c1 string, c2 string")
    got = sorted(tuple(r) for r in TB.upsert(old, new, ["k"]).collect())
    assert got == [(1, "a", ""), (2, "b", "y"), (3, "c", None)]


def test_keyed_update_ignores_unknown_keys(spark):
    old = spark.createDataFrame([(1, "init"), (2, "init")], "id int, flag string")
    ch = spark.createDataFrame([(2, "succ"), (5, "succ")], "id int, flag string")
    got = sorted(tuple(r) for r in TB.keyed_update(old, ch, ["id"]).collect())
    assert got == [(1, "init"), (2, "succ")]


def test_fuzzy_match_copies_and_empty_paths(spark):
    """Exact copies of a path (a third of the rows) and all-empty paths."""
    left = [(i, ["R", "N1", "X"]) for i in range(30)] + [(100, ["", ""]), (101, ["R", "N10", "X"]),
                                                         (102, ["R", "N2", "Y"])]
    right = [(f"c{i:03d}", ["R", "N1", "X"]) for i in range(20, 40)] + [("c000", ["R", "N10", "XX"]),
                                                                        ("c500", ["Q", "Z"])]
    L = spark.createDataFrame(left, "sid int, names array<string>")
    R = spark.createDataFrame(right, "city_id string, names array<string>")
    got = {r["sid"]: r["city_id"] for r in MA.fuzzy_path_match(L, R).collect()}
    assert got == brute_match(left, right)
    assert got[0] == "c000" and got[100] == "c500" and got[102] is None


def test_insert_ignore_partial_columns(spark):
    old = spark.createDataFrame([("u1", 1, "init", "blk")], "url string, pid int, flag string, area string")
    new = spark.createDataFrame([("u1", 9), ("u2", 7)], "url string, pid int")
    got = sorted(tuple(r) for r in TB.insert_ignore(old, new, ["url"], ["pid"]).collect())
    assert got == [("u1", 1, "init", "blk"), ("u2", 7, None, None)]


def test_first_by_hot_key_third_of_rows(spark):
    """One key holds a third of all rows; the partial-aggregate pick equals
    the window pick and the plan combines map-side before the shuffle."""
    from pyspark.sql import functions as F
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("url"), (F.col("id") * 7 % 30011).alias("page_id"), (F.col("id") % 13).alias("pos"),
        F.col("id").cast("string").alias("anchor_text"))
    a = first_by(df, ["url"], ["page_id", "pos"], ["anchor_text"])
    b = first_by_window(df, ["url"], ["page_id", "pos"]).select(*a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_top_k_equals_ordered_limit(spark):
    from conftest import SMOKE
    from pageloom.operators.sorts import top_k
    from pageloom.sources.tables import read_table
    li = read_table(spark, SMOKE, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for k in (1, 777, 4000, 10_000):
        order = ["l_orderkey", "l_linenumber", "l_quantity"]   # total order (key pairs repeat here)
        want = [tuple(r) for r in li.orderBy(*order).limit(k).collect()]
        got = [tuple(r) for r in top_k(li, order, k).orderBy(*order).collect()]
        assert got == want, k


def test_top_k_of_odd_keys(spark):
    """NULL, NaN, infinite, negative, tiny and far-off keys, ties, times."""
    import datetime as dt

    from pageloom.operators.sorts import top_k
    rnd = random.Random(7)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 5e-324]
    rows = []
    for i in range(400):
        day = dt.datetime(2024, 10, 27) + dt.timedelta(minutes=rnd.randint(0, 600), microseconds=rnd.randint(0, 5))
        rows.append((i, rnd.choice(odd) if i % 4 == 0 else rnd.gauss(0, 1) * 10 ** rnd.randint(-9, 9),
                     rnd.choice([None, 1 << 62, -(1 << 63), (1 << 63) - 1, rnd.randint(-50, 50)]), day, day, day.date()))
    df = spark.createDataFrame(rows, "i int, x double, n bigint, t timestamp, l timestamp_ntz, d date")
    df = df.withColumn("c", (F.col("i") - 200).cast("decimal(10,2)"))
    for lead in ("x", "n", "t", "l", "d", "c"):
        for k in (1, 37, 200, 1000):
            want = [r["i"] for r in df.orderBy(lead, "i").limit(k).collect()]
            assert [r["i"] for r in top_k(df, [lead, "i"], k).orderBy(lead, "i").collect()] == want, (lead, k)
    assert top_k(df.limit(0), ["x"], 5).count() == 0


def test_top_k_orders_few_rows_whatever_the_outlier(spark):
    from pageloom.operators import sorts
    df = spark.range(200_000).select(F.when(F.col("id") == 7, 10 ** 18).otherwise(F.col("id") * 3).alias("v"))
    key = sorts.rank_key(F.col("v"), df.schema["v"].dataType)
    cut = sorts._kth(df.select(key.alias("key")), 500).first()["cut"]
    assert df.where(key <= cut).count() == 500

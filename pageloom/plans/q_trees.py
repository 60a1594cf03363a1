"""Hierarchy queries: path/level, statistics, name paths, fuzzy match."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import hierarchy as HI
from pageloom.operators import match as MA
from pageloom.operators import tables as TB
from pageloom.plans.registry import register
from pageloom.sources.tables import read_table

# Level offsets that keep the ids of the four geo levels apart.
GEO = 1_000_000_000_000


def heap_tree(spark, sf):
    """part as a binary heap: id = p_partkey + 1, pid = id div 2."""
    p = read_table(spark, sf, "part")
    return p.select((F.col("p_partkey") + 1).alias("id"), ((F.col("p_partkey") + 1) / 2).cast("bigint").alias("pid"),
                    F.col("p_name").alias("name"))


def dirty_tree(spark, sf):
    """part with a scrambled parent pointer: NULL and 0 roots by size,
    otherwise ``id * 7919 mod 2003`` -- a functional graph with cycles,
    self-loops, tails into cycles and orphans (parents 2001, 2002 absent at
    small scale)."""
    p = read_table(spark, sf, "part")
    id_ = F.col("p_partkey") + 1
    pid = F.when(F.col("p_size") == 1, F.lit(None)).when(F.col("p_size") == 2, F.lit(0)).otherwise((id_ * 7919) % 2003)
    return p.select(id_.alias("id"), pid.cast("bigint").alias("pid"), F.col("p_name").alias("name"))


def geo_tree(spark, sf, levels: int = 4):
    """region -> nation -> customer -> orders, one id space per level."""
    r = read_table(spark, sf, "region").select(
        (F.lit(GEO) + F.col("r_regionkey")).alias("id"), F.lit(0).cast("bigint").alias("pid"), F.col("r_name").alias("name"))
    n = read_table(spark, sf, "nation").select(
        (F.lit(2 * GEO) + F.col("n_nationkey")).alias("id"), (F.lit(GEO) + F.col("n_regionkey")).alias("pid"),
        F.col("n_name").alias("name"))
    c = read_table(spark, sf, "customer").select(
        (F.lit(3 * GEO) + F.col("c_custkey")).alias("id"), (F.lit(2 * GEO) + F.col("c_nationkey")).alias("pid"),
        F.col("c_name").alias("name"))
    o = read_table(spark, sf, "orders").select(
        (F.lit(4 * GEO) + F.col("o_orderkey")).alias("id"), (F.lit(3 * GEO) + F.col("o_custkey")).alias("pid"),
        F.col("o_orderpriority").alias("name"))
    out = r
    for d in [n, c, o][: levels - 1]:
        out = out.unionByName(d)
    return out.select(F.col("id").cast("bigint").alias("id"), F.col("pid").cast("bigint").alias("pid"), "name")


HEAP_SQL = "SELECT p_partkey + 1 AS id, CAST((p_partkey + 1) // 2 AS BIGINT) AS pid, p_name AS name FROM part"
DIRTY_SQL = ("SELECT p_partkey + 1 AS id, CAST(CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN 0 "
             "ELSE ((p_partkey + 1) * 7919) % 2003 END AS BIGINT) AS pid, p_name AS name FROM part")
GEO_SQL = f"""
  SELECT CAST({GEO} + r_regionkey AS BIGINT) AS id, CAST(0 AS BIGINT) AS pid, r_name AS name FROM region
  UNION ALL SELECT CAST({2 * GEO} + n_nationkey AS BIGINT), CAST({GEO} + n_regionkey AS BIGINT), n_name FROM nation
  UNION ALL SELECT CAST({3 * GEO} + c_custkey AS BIGINT), CAST({2 * GEO} + c_nationkey AS BIGINT), c_name FROM customer
  UNION ALL SELECT CAST({4 * GEO} + o_orderkey AS BIGINT), CAST({3 * GEO} + o_custkey AS BIGINT), o_orderpriority FROM orders
"""


def hier_sql(tree_sql: str) -> str:
    """Top-down recursive walk from roots and from orphan tops; whatever is
    never reached sits on or below a cycle."""
    return f"""
WITH RECURSIVE n AS ({tree_sql}),
tops AS (
  SELECT id, pid, [id] AS path,
         CASE WHEN pid IS NULL OR pid = 0 THEN 'ok' ELSE 'orphan' END AS status,
         CASE WHEN pid IS NULL OR pid = 0 THEN pid END AS root_pid
  FROM n WHERE pid IS NULL OR pid = 0 OR pid NOT IN (SELECT id FROM n)),
walk AS (
  SELECT id, pid, path, status, root_pid FROM tops
  UNION ALL
  SELECT c.id, c.pid, list_append(w.path, c.id), w.status, w.root_pid
  FROM walk w JOIN n c ON c.pid = w.id WHERE c.pid IS NOT NULL AND c.pid <> 0)
SELECT n.id, n.pid, array_to_string(w.path, '|') AS path, CAST(len(w.path) AS INTEGER) AS level,
       coalesce(w.status, 'cycle') AS status
FROM n LEFT JOIN walk w ON n.id = w.id
"""


def _paths(nodes):
    return HI.hierarchy_paths(nodes).select("id", "pid", "path", "level", "status")


@register("hierarchy_paths", hier_sql(HEAP_SQL))
def q_hierarchy_paths(spark, sf):
    """HIER-1 on the part heap tree."""
    return _paths(heap_tree(spark, sf))


@register("hierarchy_geo", hier_sql(GEO_SQL))
def q_hierarchy_geo(spark, sf):
    """HIER-1 on region -> nation -> customer -> orders (orphan orders included)."""
    return _paths(geo_tree(spark, sf))


@register("hierarchy_dirty", hier_sql(DIRTY_SQL))
def q_hierarchy_dirty(spark, sf):
    """HIER-1 on a scrambled tree: NULL/0 roots, orphans, self-loops, cycles, tails."""
    return _paths(dirty_tree(spark, sf))


def stats_sql(tree_sql: str) -> str:
    return f"""
WITH h AS ({hier_sql(tree_sql).replace("coalesce(w.status, 'cycle') AS status", "coalesce(w.status, 'cycle') AS status, w.root_pid")}),
c AS (SELECT pid, count(*) AS sub_count FROM ({tree_sql}) WHERE pid IS NOT NULL GROUP BY pid)
SELECT CAST(h.level + 1 AS INTEGER) AS level, '|' || h.path AS path, CAST(coalesce(c.sub_count, 0) AS BIGINT) AS sub_count
FROM h LEFT JOIN c ON c.pid = h.id WHERE h.status = 'ok' AND h.root_pid = 0
UNION ALL
SELECT 1, '', CAST(coalesce((SELECT sub_count FROM c WHERE pid = 0), 0) AS BIGINT)
"""


@register("tree_stats", stats_sql(HEAP_SQL))
def q_tree_stats(spark, sf):
    """AGG-5 / HIER-2 on the heap tree."""
    return HI.tree_stats(heap_tree(spark, sf))


@register("tree_stats_dirty", stats_sql(DIRTY_SQL))
def q_tree_stats_dirty(spark, sf):
    """AGG-5 on the scrambled tree (only nodes reachable from 0)."""
    return HI.tree_stats(dirty_tree(spark, sf))


@register("tree_stats_sorted", f"""
SELECT level, path, sub_count FROM ({stats_sql(HEAP_SQL)}) ORDER BY level, path
""")
def q_tree_stats_sorted(spark, sf):
    """SRT-1: stat rows ordered by numeric level, then path."""
    return HI.tree_stats(heap_tree(spark, sf)).orderBy("level", "path")


@register("tree_stat_lines", f"""
SELECT printf('%d\t%s\t%d', level, path, sub_count) AS line FROM ({stats_sql(HEAP_SQL)})
""")
def q_tree_stat_lines(spark, sf):
    """SNK-5: stat rows as tab-separated lines."""
    return HI.stat_lines(HI.tree_stats(heap_tree(spark, sf)))


@register("children_lists", f"""
WITH n AS ({HEAP_SQL})
SELECT n.pid, n.id, c.n_children FROM n JOIN (SELECT pid, count(*) AS n_children FROM n GROUP BY pid) c
  ON n.pid = c.pid
""")
def q_children_lists(spark, sf):
    """AGG-4: children per parent in long form with counts."""
    return HI.children(heap_tree(spark, sf))


@register("path_names", f"""
WITH h AS ({hier_sql(GEO_SQL)}),
names AS (SELECT CAST(id AS VARCHAR) AS tok, name FROM ({GEO_SQL}) WHERE id < {4 * GEO}),
ex AS (SELECT h.id AS city_id, unnest(string_split(h.path, '|')) AS tok,
              generate_subscripts(string_split(h.path, '|'), 1) AS pos FROM h WHERE h.path IS NOT NULL),
j AS (SELECT ex.city_id, ex.pos, names.name FROM ex LEFT JOIN names ON ex.tok = names.tok)
SELECT city_id,
       CASE WHEN count(*) FILTER (WHERE name IS NULL) = 0
            THEN array_to_string(list(name ORDER BY pos), '|') END AS name_path,
       CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) AS missing
FROM j GROUP BY city_id
""")
def q_path_names(spark, sf):
    """JOIN-6 / S-23: names of every id of a path, missing ids reported."""
    geo = geo_tree(spark, sf)
    cities = HI.hierarchy_paths(geo).where(F.col("path").isNotNull()).select(F.col("id").alias("city_id"), "path")
    names = geo.where(F.col("id") < 4 * GEO).select(F.col("id").alias("nid"), F.col("name"))
    out = HI.path_names(cities, names, key_col="city_id", id_col="nid", name_col="name", numeric_ids=True)
    return out.select("city_id", F.array_join("name_path", "|").alias("name_path"), "missing")


def _cust_paths(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf, "region").select("r_regionkey", "r_name")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])


CUST_PATHS_SQL = ("SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey "
                  "JOIN region ON n_regionkey = r_regionkey")


def _fuzzy_sql(left: str, right: str) -> str:
    return f"""
WITH l AS ({left}), r AS ({right}),
m AS (SELECT l.sid, min(r.city_id) AS winner FROM l JOIN r ON len(l.names) = len(r.names)
        AND list_bool_and(list_transform(range(1, len(l.names) + 1),
              lambda i: contains(l.names[i], r.names[i]) OR contains(r.names[i], l.names[i])))
      GROUP BY l.sid)
SELECT l.sid, m.winner AS city_id, m.winner IS NOT NULL AS matched FROM l LEFT JOIN m ON l.sid = m.sid
"""


@register("fuzzy_path_match", _fuzzy_sql(
    f"SELECT c_custkey AS sid, [r_name, n_name, c_name] AS names FROM ({CUST_PATHS_SQL})",
    f"SELECT printf('C%09d', c_custkey) AS city_id, [r_name, n_name, right(c_name, 3)] AS names FROM ({CUST_PATHS_SQL})"))
def q_fuzzy_path_match(spark, sf):
    """Place paths (region, nation, customer) from the geo hierarchy against
    a city list whose leaf is the customer number's last three digits."""
    geo = geo_tree(spark, sf, levels=3)
    h = HI.hierarchy_paths(geo, name_col="name")
    left = h.where((F.col("status") == "ok") & (F.col("level") == 3)) \
        .select((F.col("id") - 3 * GEO).alias("sid"), F.col("name_path").alias("names"))
    cp = _cust_paths(spark, sf)
    right = cp.select(F.format_string("C%09d", "c_custkey").alias("city_id"),
                      F.array("r_name", "n_name", F.right("c_name", F.lit(3))).alias("names"))
    return MA.fuzzy_path_match(left, right)


NATION_PATHS_SQL = ("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")


@register("first_match", _fuzzy_sql(
    f"SELECT n_nationkey AS sid, [r_name, n_name] AS names FROM ({NATION_PATHS_SQL})",
    f"SELECT CAST(n_nationkey AS VARCHAR) AS city_id, [r_name, n_name] AS names FROM ({NATION_PATHS_SQL})"))
def q_first_match(spark, sf):
    """WIN-1 / JOIN-7: nation paths matched against themselves; smallest id wins."""
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    np_ = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    left = np_.select(F.col("n_nationkey").alias("sid"), F.array("r_name", "n_name").alias("names"))
    right = np_.select(F.col("n_nationkey").cast("string").alias("city_id"), F.array("r_name", "n_name").alias("names"))
    return MA.fuzzy_path_match(left, right)


_CITY_RIGHT_SQL = (f"SELECT printf('C%09d', c_custkey) AS city_id, [r_name, n_name, right(c_name, 3)] AS names "
                   f"FROM ({CUST_PATHS_SQL})")


@register("place_city_update", f"""
WITH m AS ({_fuzzy_sql(f"SELECT c_custkey AS sid, [r_name, n_name, c_name] AS names FROM ({CUST_PATHS_SQL})",
                       _CITY_RIGHT_SQL)})
SELECT c.c_custkey AS sid,
       CAST({GEO} + r_regionkey AS VARCHAR) || '|' || CAST({2 * GEO} + n_nationkey AS VARCHAR) || '|'
         || CAST({3 * GEO} + c_custkey AS VARCHAR) AS ext_path,
       3 AS ext_level, m.city_id AS ext_city_id
FROM ({CUST_PATHS_SQL}) c JOIN m ON m.sid = c.c_custkey
""")
def q_place_city_update(spark, sf):
    """The batch-match flow end to end: place paths and levels (HIER-1,
    stored with SNK-4), name paths, fuzzy match against the city list
    (JOIN-7, WIN-1), and the keyed update of ``ext_city_id`` (SNK-4); places
    without a match keep NULL."""
    geo = geo_tree(spark, sf, levels=3)
    h = HI.hierarchy_paths(geo, name_col="name")
    places = h.where((F.col("status") == "ok") & (F.col("level") == 3)).select(
        (F.col("id") - 3 * GEO).alias("sid"), F.col("path").alias("ext_path"), F.col("level").alias("ext_level"),
        F.lit(None).cast("string").alias("ext_city_id"), F.col("name_path").alias("names"))
    cp = _cust_paths(spark, sf)
    cities = cp.select(F.format_string("C%09d", "c_custkey").alias("city_id"),
                       F.array("r_name", "n_name", F.right("c_name", F.lit(3))).alias("names"))
    matches = MA.fuzzy_path_match(places.select("sid", "names"), cities) \
        .where("matched").select("sid", F.col("city_id").alias("ext_city_id"))
    return TB.keyed_update(places.drop("names"), matches, ["sid"], unique=True)  # one winner per place

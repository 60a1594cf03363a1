"""Queries over the catalogue-like tables: scans, filters, aggregates,
sorts, joins and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import text as TX
from pageloom.functions import urls as U
from pageloom.operators import aggregates as AG
from pageloom.operators import frontier as FR
from pageloom.operators import sorts as SO
from pageloom.operators import tables as TB
from pageloom.operators.windows import first_by
from pageloom.plans import duck as D
from pageloom.plans.registry import register
from pageloom.sources.tables import read_table, scan


def _t(spark, sf, name):
    return read_table(spark, sf, name)


@register("seed_scan", "SELECT o_orderkey AS id, o_custkey AS pid FROM orders WHERE o_orderstatus = 'P'")
def q_seed_scan(spark, sf):
    """SRC-1: projection and predicate reach the scan."""
    return scan(spark, sf, "orders", [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pid")],
                F.col("o_orderstatus") == "P")


@register("filter_level_suffix", """
SELECT p_partkey, p_name FROM part
WHERE p_size IN (2, 3) AND p_brand <> '' AND NOT p_name LIKE '%ring'
""")
def q_filter_level_suffix(spark, sf):
    """FLT-1: IN, non-empty and NOT LIKE suffix combined."""
    p = _t(spark, sf, "part")
    return p.where(F.col("p_size").isin(2, 3) & (F.col("p_brand") != "") & ~F.col("p_name").endswith("ring")) \
        .select("p_partkey", "p_name")


@register("filter_numeric", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 3 AND l_discount <= 0.05
""")
def q_filter_numeric(spark, sf):
    """FLT-2: numeric comparisons."""
    li = _t(spark, sf, "lineitem")
    return li.where((F.col("l_quantity") > 3) & (F.col("l_discount") <= 0.05)) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_prefix_type", """
SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderstatus = 'F'
""")
def q_filter_prefix_type(spark, sf):
    """FLT-3: prefix and type combined; both reach the scan."""
    o = _t(spark, sf, "orders")
    return (o.where(F.col("o_orderpriority").startswith("1") & (F.col("o_orderstatus") == "F"))
            .select(F.col("o_orderkey").alias("id"), "o_custkey"))


@register("queue_pending", """
SELECT o_orderkey AS id, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
""")
def q_queue_pending(spark, sf):
    """FLT-5: queue pick by status and priority."""
    o = _t(spark, sf, "orders")
    return o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")) \
        .select(F.col("o_orderkey").alias("id"), "o_orderdate")


@register("length_gate", """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes
FROM documents WHERE length(text) > 100 AND octet_length(encode(text)) > 20
""")
def q_length_gate(spark, sf):
    """FLT-9: character and byte length thresholds."""
    d = _t(spark, sf, "documents")
    nb = F.octet_length(F.encode("text", "UTF-8"))
    return d.where((F.length("text") > 100) & (nb > 20)) \
        .select("doc_id", F.length("text").alias("n_chars"), nb.cast("int").alias("n_bytes"))


@register("count_by_key", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def q_count_by_key(spark, sf):
    """AGG-1: one count per key."""
    return AG.count_by_key(_t(spark, sf, "events"), ["user_id"])


@register("distinct_groups", "SELECT DISTINCT p_type, p_brand FROM part")
def q_distinct_groups(spark, sf):
    """AGG-3: DISTINCT over two columns."""
    return AG.distinct_rows(_t(spark, sf, "part"), ["p_type", "p_brand"])


@register("batch_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q_batch_counts(spark, sf):
    """AGG-6: per-status counts; the batch total is observed on the way."""
    o, _obs = AG.observed(_t(spark, sf, "orders"), "orders_batch")
    return AG.count_by_key(o, ["o_orderstatus"])


@register("limited_seeds", "SELECT o_orderkey AS id, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def q_limited_seeds(spark, sf):
    """SRT-2: ordered limit."""
    o = _t(spark, sf, "orders")
    return SO.top_k(o.select(F.col("o_orderkey").alias("id"), "o_custkey"), ["id"], 1000)


@register("sample_n", """
SELECT c_custkey, c_name FROM customer ORDER BY md5('17:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 1000
""")
def q_sample_n(spark, sf):
    """SRT-3: a repeatable sample of 1000 customers: order by a seeded hash
    of the key (``TakeOrderedAndProject``: each task keeps only its own top
    1000 before the final merge)."""
    c = _t(spark, sf, "customer")
    key = F.md5(F.concat(F.lit("17:"), F.col("c_custkey").cast("string")))
    return c.select("c_custkey", "c_name").orderBy(key, "c_custkey").limit(1000)


@register("new_only_anti", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def q_new_only_anti(spark, sf):
    """Customers not yet in the urgent-order store (anti join)."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    o = _t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return FR.unseen(c, o, key="c_custkey")


@register("id_by_url", """
SELECT c.c_custkey, n.n_nationkey AS nation_id
FROM customer c JOIN nation n ON n.n_name = 'NATION_' || CAST(c.c_nationkey AS VARCHAR)
""")
def q_id_by_url(spark, sf):
    """JOIN-4: look up the catalogue id by its natural key (inner join;
    ``unmatched_links`` reports the rows that such a lookup drops)."""
    c = _t(spark, sf, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("nk"))
    n = _t(spark, sf, "nation").select(F.col("n_name").alias("nk"), F.col("n_nationkey").alias("nation_id"))
    return c.join(n, "nk").select("c_custkey", "nation_id")


@register("append_rows", """
SELECT event_id, event_type FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type <> 'click' OR event_type IS NULL
""")
def q_append_rows(spark, sf):
    """SNK-1: append by column name."""
    e = _t(spark, sf, "events").select("event_id", "event_type")
    clicks = e.where(F.col("event_type") == "click")
    rest = e.where((F.col("event_type") != "click") | F.col("event_type").isNull())
    return TB.append(clicks, rest)


@register("insert_ignore", """
WITH firsts AS (
  SELECT user_id, event_id, ts, event_type, coalesce(event_type = 'signup', false) AS stored,
         row_number() OVER (PARTITION BY user_id, coalesce(event_type = 'signup', false) ORDER BY ts, event_id) AS rn
  FROM events),
old AS (SELECT user_id, event_id, ts, event_type FROM firsts WHERE stored AND rn = 1)
SELECT * FROM old
UNION ALL SELECT user_id, event_id, ts, event_type FROM firsts f WHERE NOT stored AND rn = 1
  AND NOT EXISTS (SELECT 1 FROM old WHERE old.user_id = f.user_id)
""")
def q_insert_ignore(spark, sf):
    """User registry keyed by user_id: the first signup of a user is stored,
    all other events arrive as a batch."""
    e = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    signup = F.coalesce(F.col("event_type") == "signup", F.lit(False))
    old = first_by(e.where(signup), ["user_id"], ["ts", "event_id"], ["event_type"]) \
        .select("user_id", "event_id", "ts", "event_type")
    return TB.insert_ignore(old, e.where(~signup), ["user_id"], ["ts", "event_id"])


@register("upsert_by_key", """
WITH n AS (
  SELECT c_custkey, c_acctbal + 100 AS c_acctbal, CAST(NULL AS VARCHAR) AS c_name, '' AS c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey + 1000000000, c_acctbal, c_name || '-copy', c_mktsegment FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
       o.c_nationkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal,
       coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment
FROM customer o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey
""")
def q_upsert_by_key(spark, sf):
    """Changes: BUILDING customers get a new balance and an explicitly empty
    segment (name absent, so kept); AUTOMOBILE customers are copied under
    new keys (inserts)."""
    c = _t(spark, sf, "customer")
    upd = c.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", (F.col("c_acctbal") + 100).alias("c_acctbal"), F.lit(None).cast("string").alias("c_name"),
        F.lit("").alias("c_mktsegment"))
    ins = c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_acctbal",
        F.concat("c_name", F.lit("-copy")).alias("c_name"), "c_mktsegment")
    return TB.upsert(c, upd.unionByName(ins), ["c_custkey"])


@register("keyed_update", """
SELECT o.o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, o.o_orderpriority
FROM orders o LEFT JOIN (SELECT o_custkey + 0 AS o_orderkey, 'done' AS o_orderstatus FROM orders
                         WHERE o_totalprice > 400000 GROUP BY o_custkey) n ON o.o_orderkey = n.o_orderkey
""")
def q_keyed_update(spark, sf):
    """Mark as done the orders whose key equals a customer with a large
    order (a change set keyed on a different column than it came from)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    ch = _t(spark, sf, "orders").where(F.col("o_totalprice") > 400000) \
        .select(F.col("o_custkey").alias("o_orderkey"), F.lit("done").alias("o_orderstatus"))
    return TB.keyed_update(o, ch, ["o_orderkey"])


@register("line_list", f"""
SELECT doc_id, pos, {D.ws_strip('line')} AS line FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS pos FROM documents)
""")
def q_line_list(spark, sf):
    """SRC-4 over stored text: every line of every document, stripped."""
    d = _t(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
        .select("doc_id", (F.col("pos") + 1).cast("int").alias("pos"), TX.ws_strip("line").alias("line"))


@register("ws_strip", f"SELECT doc_id, {D.ws_strip('text')} AS stripped FROM documents")
def q_ws_strip(spark, sf):
    """S-2: Unicode whitespace strip over whole documents."""
    return _t(spark, sf, "documents").select("doc_id", TX.ws_strip("text").alias("stripped"))


@register("collapse_ws", f"SELECT doc_id, {D.collapse_ws('text')} AS collapsed FROM documents")
def q_collapse_ws(spark, sf):
    """S-4: whitespace runs collapsed over whole documents."""
    return _t(spark, sf, "documents").select("doc_id", TX.collapse_ws("text").alias("collapsed"))


@register("mutual_contains", """
SELECT p_partkey, contains(p_name, p_type) OR contains(p_type, p_name) AS name_type,
       contains(lower(p_name), split_part(p_name, ' ', 2)) OR contains(split_part(p_name, ' ', 2), lower(p_name)) AS name_word
FROM part
""")
def q_mutual_contains(spark, sf):
    """S-24: mutual containment."""
    p = _t(spark, sf, "part")
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    return p.select("p_partkey", TX.mutual_contains("p_name", "p_type").alias("name_type"),
                    TX.mutual_contains(F.lower("p_name"), word).alias("name_word"))


@register("arrays_match", """
SELECT p_partkey, len(a) = len(b) AND list_bool_and(list_transform(range(1, len(a) + 1),
         lambda i: contains(a[i], b[i]) OR contains(b[i], a[i]))) AS matched
FROM (SELECT p_partkey, string_split(p_name, ' ') AS a, [lower(p_type), split_part(p_name, ' ', 2)] AS b FROM part)
""")
def q_arrays_match(spark, sf):
    """S-25: equal length and containment at every position."""
    p = _t(spark, sf, "part")
    a = F.split("p_name", " ", -1)
    b = F.array(F.lower("p_type"), F.split_part("p_name", F.lit(" "), F.lit(2)))
    return p.select("p_partkey", TX.arrays_match(a, b).alias("matched"))


@register("encode_url", f"SELECT p_partkey, 'http://wiki.example.org/wiki/' || {D.url_quote('p_name')} AS url FROM part")
def q_encode_url(spark, sf):
    """S-14: names percent-encoded into page URLs."""
    p = _t(spark, sf, "part")
    return p.select("p_partkey", F.concat(F.lit("http://wiki.example.org/wiki/"), U.url_quote("p_name")).alias("url"))

"""Queries over rendered page fixtures.  The oracle reads the expected
values from the source tables directly (round trip)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.urls import url_quote
from pageloom.operators import binary as BI
from pageloom.operators import cards as CA
from pageloom.operators import content as CO
from pageloom.operators import ids as ID
from pageloom.plans import duck as D
from pageloom.plans import fixtures as FX
from pageloom.plans.registry import register
from pageloom.session import checkpoint_dir, materialize, new_run_id
from pageloom.sources.tables import read_table

SITE = "http://www.example.com"


@register("table_rows", """
SELECT CAST(n_regionkey AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) AS pos,
       n_name AS anchor_text, 'http://geo.example.org/' || n_name || '.html' AS url FROM nation
UNION ALL
SELECT CAST(r_regionkey AS BIGINT), CAST(coalesce(c.cnt, 0) + 1 AS INTEGER), '', ''
FROM region r LEFT JOIN (SELECT n_regionkey, count(*) AS cnt FROM nation GROUP BY n_regionkey) c
  ON r.r_regionkey = c.n_regionkey
""")
def q_table_rows(spark, sf):
    """EXT-5: listing rows below the header, from rendered nation pages."""
    return CA.table_rows(FX.nation_table_pages(spark, sf))


_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in
                   ["population_dencity", "license_prefix", "admin_level", "tele_prefix", "post_code", "idcard_prefix"])
PROVINCE_SQL = f"""
SELECT c_custkey AS page_id, c_name AS title, c_name || ' line' || chr(10) || c_mktsegment || ' line' AS description,
       c_mktsegment AS short_name, printf('%.1f', c_acctbal * 2) AS area, ' ' || CAST(c_nationkey AS VARCHAR) AS population,
       CAST(NULL AS VARCHAR) AS admin_code, ' Street ' || CAST(c_custkey AS VARCHAR) AS address, {_NULLS}
FROM customer
"""
SUB_SQL = f"""
SELECT c_custkey AS page_id, c_name AS title, c_name || ' f14' || chr(10) || 'second' AS description,
       c_mktsegment || ' f12' AS f12, CAST(NULL AS VARCHAR) AS short_name, CAST(NULL AS VARCHAR) AS area,
       ' ' || CAST(c_nationkey AS VARCHAR) || chr(10) || '万' AS population, CAST(c_custkey AS VARCHAR) AS admin_code,
       CAST(NULL AS VARCHAR) AS address, {_NULLS}
FROM customer
"""


@register("label_value_fields", PROVINCE_SQL)
def q_label_value_fields(spark, sf):
    """EXT-6 / S-19: province info boxes, from rendered customer pages."""
    return CA.province_info(spark, FX.province_pages(spark, sf))



@register("label_value_fallback", SUB_SQL)
def q_label_value_fallback(spark, sf):
    """EXT-7 / SET-3: sub-page info boxes with the table fallback."""
    return CA.sub_info(spark, FX.sub_pages(spark, sf))


@register("page_kind_branch", f"""
SELECT p.*, CAST(NULL AS VARCHAR) AS f12 FROM ({PROVINCE_SQL}) p JOIN customer c ON c.c_custkey = p.page_id
WHERE c.c_mktsegment = 'BUILDING'
UNION ALL BY NAME
SELECT s.* FROM ({SUB_SQL}) s JOIN customer c ON c.c_custkey = s.page_id WHERE c.c_mktsegment <> 'BUILDING'
""")
def q_page_kind_branch(spark, sf):
    """EXT-8: layout chosen by page kind, branches unioned."""
    return CA.page_kind_branch(spark, FX.mixed_place_pages(spark, sf))


@register("title_price_rows", """
SELECT CAST(p_partkey // 10 AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS INTEGER) AS pos,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_name END AS title,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE printf('%.2f', p_retailprice) END AS price
FROM part
""")
def q_title_price_rows(spark, sf):
    """EXT-10: title and price per row, either may be missing."""
    return CA.title_price_rows(FX.price_table_pages(spark, sf))


KIND_SQL = """
  SELECT *, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'A' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'B'
                 ELSE 'N' END AS kind, p_partkey // 10 AS b FROM part
"""


@register("layout_fallback", f"""
WITH g AS (SELECT *, min(p_partkey) OVER (PARTITION BY kind, b) AS page_id,
                  row_number() OVER (PARTITION BY kind, b ORDER BY p_partkey) AS pos FROM ({KIND_SQL}))
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN kind = 'A' THEN '/a/' ELSE '/b/' END || CAST(p_partkey AS VARCHAR) AS href, p_name AS title,
       CASE WHEN kind = 'A' THEN p_type || ' ' || p_brand ELSE p_brand END AS description
FROM g WHERE kind <> 'N'
""")
def q_layout_fallback(spark, sf):
    """EXT-11 / SET-3: attraction cards, layout A else B per page."""
    return CA.attraction_cards(FX.attraction_pages(spark, sf))


@register("pager_links", f"""
WITH g AS (SELECT kind, b, min(p_partkey) AS page_id FROM ({KIND_SQL}) GROUP BY kind, b)
SELECT CAST(page_id AS BIGINT) AS parent_id, 1 AS pos, '{SITE}/list/' || CAST(page_id AS VARCHAR) || '-2' AS href FROM g
UNION ALL
SELECT CAST(page_id AS BIGINT), 2, '{SITE}/list/' || CAST(page_id AS VARCHAR) || '-3' FROM g
""")
def q_pager_links(spark, sf):
    """EXT-12: links of the first pager only."""
    return CA.pager_links(FX.attraction_pages(spark, sf), SITE)


@register("unseen_pager_links", f"""
WITH g AS (SELECT kind, b, min(p_partkey) AS page_id FROM ({KIND_SQL}) GROUP BY kind, b),
l AS (SELECT page_id, '{SITE}/list/' || CAST(page_id AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS href
      FROM g, (SELECT unnest([2, 3]) AS n))
SELECT href, CAST(page_id AS BIGINT) AS pid FROM l
WHERE page_id % 2 = 0 AND href NOT IN (SELECT '{SITE}/list/' || CAST(p_partkey AS VARCHAR) || '-3' FROM part WHERE p_size > 25)
""")
def q_unseen_pager_links(spark, sf):
    """EXT-12: pager links of first pages (those of even id) that are not stored yet (the third pages of large parts are)."""
    stored = read_table(spark, sf, "part").where(F.col("p_size") > 25).select(
        F.concat(F.lit(f"{SITE}/list/"), F.col("p_partkey").cast("string"), F.lit("-3")).alias("href"))
    return CA.new_pager_links(FX.attraction_pages(spark, sf), stored, SITE, F.col("page_id") % 2 == 0)


@register("product_cards", """
SELECT CAST(p_partkey // 10 AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) AS INTEGER) AS pos,
       '/t/' || CAST(p_partkey AS VARCHAR) AS href, p_name AS title, p_type AS description, p_brand AS location,
       'USD ' || printf('%.2f', p_retailprice) || '.from ' || CAST(p_size AS VARCHAR) AS price
FROM part WHERE p_type <> 'PROMO'
""")
def q_product_cards(spark, sf):
    """EXT-13: product cards with joined, cleaned prices."""
    return CA.product_cards(FX.product_pages(spark, sf))


def _best_sql() -> str:
    whole = D.strip_tags("'<p>' || text || '</p>'")
    short = D.strip_tags("'<p>' || source || '</p>'")
    section = D.strip_tags("source || '</div>' || text")
    return f"""
SELECT doc_id AS page_id, CASE
  WHEN lang = 'en' THEN CASE WHEN source = 'src0' THEN '' ELSE {whole} END
  WHEN lang = 'fr' THEN CASE WHEN length({whole}) > 100 THEN {whole} ELSE {section} END
  WHEN lang = 'es' THEN CASE WHEN length({short}) > 100 THEN {short} ELSE {section} END
  ELSE '' END AS description
FROM documents
"""


@register("best_description", _best_sql())
def q_best_description(spark, sf):
    """EXT-9: best-description cascade (regular-expression route)."""
    return CA.best_description(FX.article_pages(spark, sf))



@register("enrich_from_pages", f"""
WITH poi AS (SELECT p_partkey AS id FROM part
             WHERE (CASE WHEN p_size > 10 THEN 'init' ELSE 'done' END) LIKE 'init%' AND p_type = 'ECONOMY'),
bd AS ({_best_sql()}),
j AS (SELECT poi.id, coalesce(bd.description, '') AS d FROM poi LEFT JOIN bd ON bd.page_id = poi.id)
SELECT id, CASE WHEN length(d) > 10 THEN d END AS description,
       CASE WHEN length(d) > 10 THEN 'succ' ELSE 'failed' END AS flag FROM j
""")
def q_enrich_from_pages(spark, sf):
    """ENR-1: points of interest (FLT-3 pick) -> page URL from the name
    (S-14) -> page (JOIN-9, left: a missing page reads as empty) -> best
    description (EXT-9) -> ``succ`` with the text when longer than 10
    characters, else ``failed`` (S-21)."""
    p = read_table(spark, sf, "part")
    poi = p.select(F.col("p_partkey").alias("id"), F.concat(F.lit("doc "), F.col("p_partkey").cast("string")).alias("name"),
                   F.col("p_type").alias("type"),
                   F.when(F.col("p_size") > 10, "init").otherwise("done").alias("flag"))
    pick = poi.where(F.col("flag").startswith("init") & (F.col("type") == "ECONOMY"))
    req = pick.select("id", F.concat(F.lit(FX.WIKI), url_quote("name")).alias("url"))
    desc = CA.best_description(FX.article_pages(spark, sf), keep=("url",))
    d = F.coalesce(F.col("description"), F.lit(""))
    return (req.join(desc.select("url", "description"), "url", "left")
            .select("id", F.when(F.length(d) > 10, d).alias("description"),
                    F.when(F.length(d) > 10, "succ").otherwise("failed").alias("flag")))


@register("nested_list_links", f"""
WITH g AS (SELECT *, row_number() OVER (ORDER BY n_regionkey, n_nationkey) AS id FROM nation),
s AS (SELECT *, unnest(['day', 'night']) AS part, unnest([1, 2]) AS k FROM g)
SELECT '{SITE}/' || n_name || '-tours/d' || CAST(n_regionkey AS VARCHAR) || '-g' || CAST(n_nationkey AS VARCHAR) AS href,
       n_name AS anchor_text, CAST(id AS BIGINT) AS id, CAST(NULL AS BIGINT) AS pid FROM g
UNION ALL
SELECT '{SITE}/' || n_name || '-tours/' || part || '/d' || CAST(n_nationkey AS VARCHAR) || '-g' || CAST(k AS VARCHAR),
       n_name || ' ' || part, CAST((SELECT count(*) FROM g) + row_number() OVER (ORDER BY id, k) AS BIGINT), CAST(id AS BIGINT) FROM s
""")
def q_nested_list_links(spark, sf):
    """EXT-14 / JOIN-4: nested group links stored with ids and parent ids, from an empty table on."""
    links = CA.nested_list_links(FX.region_list_pages(spark, sf), SITE)
    return ID.store_groups(links, spark.createDataFrame([], "href string, anchor_text string, id bigint, pid bigint"))


_LANG = "regexp_extract(url, '\\A[a-z]+://[^/]*/([a-z]{2})/', 1)"
BODIES_SQL = f"""
  SELECT page_id, url, (CASE lang WHEN 'en' THEN unhex('{FX.JPEG}') WHEN 'fr' THEN unhex('{FX.PNG}')
                         WHEN 'es' THEN unhex('{FX.GIF}') WHEN 'de' THEN unhex('{FX.BMP}') ELSE unhex('') END)
                        || encode(CASE WHEN ends_with(url, '#top') THEN lang ELSE html END) AS body
  FROM (SELECT *, {_LANG} AS lang FROM pages)
"""
KIND_OF = """CASE WHEN starts_with(hex(body), '52494646') AND substr(hex(body), 17, 8) = '57454250' THEN 'webp'
  WHEN starts_with(hex(body), 'FFD8FF') THEN 'jpeg' WHEN starts_with(hex(body), '89504E470D0A1A0A') THEN 'png'
  WHEN starts_with(hex(body), '474946383761') OR starts_with(hex(body), '474946383961') THEN 'gif'
  WHEN starts_with(hex(body), '424D') THEN 'bmp' END"""


@register("image_signature", f"""
SELECT page_id, kind, n_bytes FROM (
  SELECT page_id, {KIND_OF} AS kind, CAST(octet_length(body) AS INTEGER) AS n_bytes FROM ({BODIES_SQL}))
WHERE n_bytes > 20 AND kind IS NOT NULL
""")
def q_image_signature(spark, sf):
    """EXT-16: bodies kept when longer than 20 bytes with an image signature."""
    return BI.image_signature(FX.page_bodies(spark, sf))


@register("content_store", f"""
WITH b AS ({BODIES_SQL}),
want AS (SELECT DISTINCT url AS source_url FROM pages
         WHERE starts_with(url, 'http://') AND (CASE WHEN ends_with(url, '#top') THEN 1 ELSE 0 END) <= 0),
fresh AS (SELECT * FROM want w WHERE NOT EXISTS (SELECT 1 FROM pages s WHERE contains(s.url, '/fr/') AND s.url = w.source_url))
SELECT f.source_url, 'page' AS category, md5(b.body) AS md5, CAST(octet_length(b.body) AS INTEGER) AS n_bytes
FROM fresh f JOIN b ON b.url = f.source_url
WHERE octet_length(b.body) > 20 AND ({KIND_OF}) IS NOT NULL
""")
def q_content_store(spark, sf):
    """IMG-1, SNK-6: image URLs of rows without an image id ('#top' pages have
    one), minus those already stored (the French pages, by an earlier run),
    fetched from the derived bodies, checked and stored; what the store holds
    of them is read back and signed anew."""
    pages = read_table(spark, sf, "pages").select("page_id", "url", "html")
    tours = pages.select(F.col("url").alias("head_image"),
                         F.when(F.col("url").endswith("#top"), 1).otherwise(0).alias("image_id"))
    bodies = materialize(FX.page_bodies(spark, sf), "bodies")  # the crawled bodies, as a table
    root = f"{checkpoint_dir(spark).rstrip('/')}/content-{new_run_id()}"
    french = pages.where(F.col("url").contains("/fr/")).select(F.col("url").alias("source_url"))
    CO.store_images(french, bodies, root, "earlier")
    CO.store_images(CO.wanted_images(tours), bodies, root, "page")
    return CO.read_back(spark, root).where(F.col("category") == "page")


@register("decode_body", """
SELECT CAST(n_nationkey AS BIGINT) AS page_id,
       CASE WHEN n_regionkey = 0 THEN '<html><body><h1>简称' || n_name || '</h1><p>人' || chr(65533)
            ELSE '<html><body><h1>简称' || n_name || '</h1><p>人口</p></body></html>' END AS html
FROM nation
""")
def q_decode_body(spark, sf):
    """SRC-5: GB2312 bodies rendered from nation rows (the region-0 ones cut
    in the middle of their last two-byte character, which decodes to
    U+FFFD) decoded before parsing."""
    n = read_table(spark, sf, "nation")
    text = F.concat(F.lit("<html><body><h1>简称"), F.col("n_name"), F.lit("</h1><p>人口</p></body></html>"))
    raw = BI.encode_bodies(n.select(F.col("n_nationkey").cast("bigint").alias("page_id"), "n_regionkey",
                                    text.alias("text")), "text")
    cut = F.when(F.col("n_regionkey") == 0, F.substring("body", 1, F.octet_length("body") - 19)).otherwise(F.col("body"))
    return BI.decode_bodies(raw.select("page_id", cut.alias("body"))).select("page_id", "html")

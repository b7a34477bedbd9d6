"""Page-table queries: link harvest, list cards, meta description, URL dates,
two-level null-fill, body extraction and backfill (S14-S21, J04, O06, F08-F16,
A19, A21-A23, J07, K06, O05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import body_text as BT
from presslens.functions import html as H
from presslens.functions import text as T
from presslens.functions import urls as U
from presslens.functions.timefmt import round_half_up, round_half_up_sql
from presslens.operators import backfill as B
from presslens.operators.dedup import first_by_key
from presslens.plans.registry import register
from presslens.schemas import conform_article
from presslens.sources import pages as PG
from presslens.sources import plugin as PL
from presslens.sources import tables as S

# Homepage link rule for the driver pages: root-level links made of ASCII letters.
LINK_RULE = r"^/[A-Za-z]+$"
ITEM_RULE = r"(?is)<li\b[^>]*>.*?</li>"
CARD_RULE = r"(?is)<div\b[^>]*\bclass=\"[^\"]*\bcard\b[^\"]*\"[^>]*>.*?</div>"
RUN_AT = "2024-02-01 00:00:00"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def anchor_text_sql(x: str) -> str:
    t = f"regexp_replace({x}, '\\s*<[A-Za-z/!?][^>]*>\\s*', '', 'g')"
    t = f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
    return H.decode_entities_sql(t)


def join_url_sql(base: str, href: str) -> str:
    origin = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    scheme = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    bdir = f"coalesce(nullif(regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)', 1), ''), {origin} || '/')"
    return (f"(CASE WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {origin} || {href} "
            f"ELSE {bdir} || {href} END)")


ANCHORS_SQL = f"""
SELECT page_id, url AS page_url, a, pos,
       regexp_extract(a, {_q(PG.HREF_RE)}, 1) AS href,
       {anchor_text_sql('a')} AS text,
       regexp_matches(a, '(?is)^<a\\b[^>]*?\\bhref\\s*=') AS has_href
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, {_q(PG.ANCHOR_RE)}, 0)) AS a,
             generate_subscripts(regexp_extract_all(html, {_q(PG.ANCHOR_RE)}, 0), 1) - 1 AS pos
      FROM pages)
"""


@register("page_links", ids=("S20", "O06"), oracle=f"""
WITH a AS ({ANCHORS_SQL}),
m AS (SELECT * FROM a WHERE has_href AND regexp_matches(href, {_q(LINK_RULE)})),
f AS (SELECT page_id, href, MIN(pos) AS first_pos FROM m GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY first_pos) AS rank FROM f),
t AS (SELECT page_id, href, arg_min(text, pos) AS title FROM m WHERE text <> '' GROUP BY 1, 2)
SELECT r.page_id, r.href AS url, t.title, r.rank FROM r LEFT JOIN t USING (page_id, href)
""")
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Homepage link harvest over every page: matching anchors, one row per
    URL in first-seen order with its first non-empty anchor text."""
    return PG.harvest_links(S.table(spark, sf_dir, "pages"), LINK_RULE)


def _items_sql(items_expr: str, after: int | None) -> str:
    body = f"""
WITH ex AS (
  SELECT page_id, url AS page_url, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos
  FROM (SELECT page_id, url, {items_expr} AS items FROM pages)),
r AS (
  SELECT page_id, pos,
         nullif({anchor_text_sql("regexp_replace(item, '(?is)^<[^>]*>|</[^>]*>$', '', 'g')")}, '') AS title,
         regexp_extract(regexp_extract(item, '(?is)(<a\\b[^>]*>.*?</a>)', 1), {_q(PG.HREF_RE)}, 1) AS href,
         page_url
  FROM ex),
k AS (
  SELECT page_id, pos, title, CASE WHEN href <> '' THEN {join_url_sql('page_url', 'href')} END AS url
  FROM r)
SELECT page_id, pos, title, url, '' AS summary FROM k
WHERE title IS NOT NULL AND url IS NOT NULL"""
    if after:
        body += f"\nQUALIFY ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY pos) <= {after}"
    return body


@register("list_cards", ids=("S15", "O06"), oracle=_items_sql(
    f"regexp_extract_all(html, {_q(ITEM_RULE)}, 0)", None))
def q_list_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic list-page extraction: every list item of a page with its title
    and its first link resolved against the page URL."""
    return PG.list_items(S.table(spark, sf_dir, "pages"), ITEM_RULE, before_filter=None)


@register("promo_cards", ids=("S14", "O06"), oracle=_items_sql(
    f"CASE WHEN len(regexp_extract_all(html, {_q(CARD_RULE)}, 0)) > 0 "
    f"THEN regexp_extract_all(html, {_q(CARD_RULE)}, 0) ELSE regexp_extract_all(html, {_q(ITEM_RULE)}, 0) END",
    None))
def q_promo_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card extraction with a fallback rule when a page has no primary cards; every valid card."""
    return PG.list_items(S.table(spark, sf_dir, "pages"), CARD_RULE, fallback_re=ITEM_RULE, before_filter=None)


def _meta_sql(x: str) -> str:
    def meta(attr, name):
        a = (f"regexp_extract({x}, '(?is)<meta\\b[^>]*\\b{attr}\\s*=\\s*[\"'']{name}[\"''][^>]*"
             f"\\bcontent\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)")
        b = (f"regexp_extract({x}, '(?is)<meta\\b[^>]*\\bcontent\\s*=\\s*[\"'']([^\"'']*)[\"''][^>]*"
             f"\\b{attr}\\s*=\\s*[\"'']{name}[\"'']', 1)")
        return f"nullif(regexp_replace(coalesce(nullif({a}, ''), {b}), '^\\s+|\\s+$', '', 'g'), '')"
    return f"coalesce({meta('name', 'description')}, {meta('property', 'og:description')})"


@register("meta_description", ids=("S21",), oracle=f"""
SELECT page_id, url, {_meta_sql('html')} AS summary FROM pages
""")
def q_meta_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article summary from <meta name=description>, else og:description, else NULL."""
    p = S.table(spark, sf_dir, "pages")
    return p.select("page_id", "url", H.meta_description(F.col("html")).alias("summary"))


@register("url_dates", ids=("S19", "S18"), oracle=f"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, {_q(PG.ANCHOR_RE)}, 0)) AS a FROM pages),
u AS (SELECT page_id, url FROM pages UNION ALL
      SELECT page_id, regexp_extract(a, {_q(PG.HREF_RE)}, 1) FROM l)
SELECT page_id, url,
       CASE WHEN regexp_extract(url, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 1) <> '' THEN
         CAST(try_strptime(regexp_extract(url, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 1) || '-' ||
                           regexp_extract(url, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 2) || '-' ||
                           regexp_extract(url, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 3), '%Y-%m-%d') AS TIMESTAMP) END
         AS published_at
FROM u
""")
def q_url_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication date from a /YYYY/MM/DD/ URL path (UTC midnight) for page
    URLs and every anchor href; NULL when absent or invalid."""
    p = S.table(spark, sf_dir, "pages")
    links = (p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(PG.ANCHOR_RE), 0)).alias("a"))
             .select("page_id", F.regexp_extract("a", PG.HREF_RE, 1).alias("url")))
    u = p.select("page_id", "url").unionByName(links)
    return u.select("page_id", "url", U.date_from_url(F.col("url")).alias("published_at"))


def _article_pages(spark, sf_dir):
    """Article-page fields keyed by url (first page per url)."""
    p = S.page_articles(spark, sf_dir)
    a = p.select("url", "page_id", "title", H.strip_html(F.col("summary")).alias("summary"))
    return first_by_key(a, "url", ["page_id"]).drop("page_id")


@register("null_fill", ids=("S17", "J04"), oracle=f"""
WITH p AS ({S.PAGES_SQL}),
home AS (
  SELECT page_id, 'homepage' AS source, sourcecountry AS country_target, url,
         CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN '' ELSE
           {anchor_text_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} END AS title,
         CAST(NULL AS VARCHAR) AS summary
  FROM p),
art AS (
  SELECT url, title AS a_title, {H.strip_html_sql('summary')} AS a_summary
  FROM p QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY page_id) = 1)
SELECT page_id, source, country_target, url, coalesce(title, a_title) AS title,
       coalesce(summary, a_summary) AS summary, TIMESTAMP '{RUN_AT}' AS extracted_at
FROM home LEFT JOIN art USING (url) WHERE url IS NOT NULL
""")
def q_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level scrape: homepage partial rows (title NULL / '' / <h1> text in
    rotation, no summary) filled from their article page; NULL is filled, ''
    is kept; one extracted_at for the whole run."""
    p = S.table(spark, sf_dir, "pages").select(
        "page_id", F.col("url"), "html", F.regexp_extract("url", S.COUNTRY_FROM_PATH, 1).alias("country_target"))
    h1 = PG.anchor_text(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    home = p.select("page_id", F.lit("homepage").alias("source"), "country_target", "url",
                    F.when(F.col("page_id") % 3 == 0, F.lit(None).cast("string"))
                    .when(F.col("page_id") % 3 == 1, F.lit("")).otherwise(h1).alias("title"),
                    F.lit(None).cast("string").alias("summary"))
    filled = PG.fill_from_articles(home, _article_pages(spark, sf_dir))
    return filled.withColumn("extracted_at", F.lit(RUN_AT).cast("timestamp_ntz"))


# ------------------------------------------------------------------ bodies
def _bodies_sql() -> str:
    """Main text per page by counting how deep each piece of a page lies, which needs
    well-nested regions: the SQL has no stack of open elements."""
    raw = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style"))
    piece = f"(?is)<!--.*?-->|{raw}|<[A-Za-z/!?][^>]*>|(?:[^<]|<[^A-Za-z/!?]|<$)+"
    hidden = T.sql_list(sorted(BT.HIDDEN - BT.RAW))
    step = "CASE WHEN ends THEN -1 ELSE 1 END"
    depth = ", ".join(f"sum(CASE WHEN {test} THEN {step} ELSE 0 END) OVER w AS {name}"
                      for name, test in [(f"in_{r}", f"name = '{r}'") for r in BT.REGIONS if r] + [("hidden", f"name IN ({hidden})")])
    texts = ", ".join(f"string_agg(piece, '' ORDER BY pos) FILTER (hidden = 0 AND {test}) AS t{i}"
                      for i, test in enumerate(f"in_{r} > 0" if r else "true" for r in BT.REGIONS))
    lines = [f"nullif(trim(regexp_replace(regexp_replace(replace({H.decode_entities_sql(f't{i}')}, chr(160), ' '), "
             f"'[ \t\r\f\x0b]+', ' ', 'g'), '\\s*\\n\\s*', chr(10), 'g'), ' ' || chr(10)), '')" for i in range(len(BT.REGIONS))]
    return f"""
SELECT page_id, url, coalesce({", ".join(lines)}) AS body FROM pages LEFT JOIN (
  SELECT page_id, {texts} FROM (
    SELECT page_id, pos, {depth},
           CASE WHEN is_text THEN p WHEN name IN ({T.sql_list(sorted(BT.LINES))}) THEN chr(10) ELSE '' END AS piece
    FROM (SELECT *, starts_with(p, '</') AS ends, NOT regexp_matches(p, '^<[A-Za-z/!?]') AS is_text,
                 CASE WHEN NOT regexp_matches(p, '(?i)^<(script|style)') THEN lower(regexp_extract(p, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) END AS name
          FROM (SELECT page_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS pos
                FROM (SELECT page_id, regexp_extract_all(html, {_q(piece)}) AS ps FROM pages)))
    WINDOW w AS (PARTITION BY page_id ORDER BY pos))
  GROUP BY 1) USING (page_id)
"""


BODY_SQL = _bodies_sql()


@register("body_extract", ids=("F14", "F16"), oracle=f"""
SELECT page_id, url, body, substr(body, 1, 250) AS head FROM ({BODY_SQL})
""")
def q_body_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (article region, boilerplate dropped, whole) and its 250-char head."""
    p = S.table(spark, sf_dir, "pages")
    body = BT.extract_body(F.col("html"))
    return p.select("page_id", "url", body.alias("body")).withColumn("head", F.substring("body", 1, 250))


def article_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a (so far empty) body column: page articles and document articles."""
    p = S.page_articles(spark, sf_dir).select(
        F.col("domain").alias("source"), F.col("sourcecountry").alias("country_target"), "title",
        H.strip_html(F.col("summary")).alias("summary"), "url")
    d = S.document_articles(spark, sf_dir).select(
        "source", F.col("sourcecountry").alias("country_target"), "title", "url")
    both = conform_article(p).unionByName(conform_article(d))
    return both.withColumn("body", F.lit(None).cast("string"))


ARTICLE_TABLE_SQL = f"""
SELECT domain AS source, sourcecountry AS country_target, title, {H.strip_html_sql('summary')} AS summary, url,
       NULL::TIMESTAMP AS published_at, NULL::TIMESTAMP AS extracted_at, NULL::VARCHAR AS body
FROM ({S.PAGES_SQL})
UNION ALL
SELECT source, sourcecountry, title, NULL::VARCHAR, url, NULL::TIMESTAMP, NULL::TIMESTAMP, NULL::VARCHAR
FROM ({S.DOCS_SQL})
"""
BODIES_SQL = f"""
SELECT url, body FROM ({BODY_SQL})
QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY page_id) = 1
"""
MISSING_SQL = f"SELECT * FROM t WHERE (body IS NULL OR body = '') AND NOT {U.should_skip_sql('url')}"
FILLED_SQL = f"""
SELECT m.source, m.country_target, m.title, m.summary, m.url, m.published_at, m.extracted_at,
       CASE WHEN {U.should_skip_sql('m.url')} THEN NULL ELSE b.body END AS body
FROM missing m LEFT JOIN bodies b USING (url)
"""
MERGED_SQL = """
SELECT t.source, t.country_target, t.title, t.summary, t.url, t.published_at, t.extracted_at,
       coalesce(n.body, t.body) AS body
FROM t LEFT JOIN (SELECT url, MIN(body) AS body FROM filled WHERE body IS NOT NULL GROUP BY 1) n USING (url)
"""


def _backfill_sql(final: str) -> str:
    return (f"WITH t AS ({ARTICLE_TABLE_SQL}), bodies AS ({BODIES_SQL}), missing AS ({MISSING_SQL}), "
            f"filled AS ({FILLED_SQL}), merged AS ({MERGED_SQL})\n{final}")


def _missing(spark, sf_dir):
    return B.missing_body(article_table(spark, sf_dir))


def _filled(spark, sf_dir):
    return B.enrich(_missing(spark, sf_dir), B.page_bodies(S.table(spark, sf_dir, "pages")))


def _merged(spark, sf_dir):
    return B.fill_bodies(article_table(spark, sf_dir), B.page_bodies(S.table(spark, sf_dir, "pages")))


@register("missing_body", ids=("F08", "F09", "F13"), oracle=_backfill_sql(
    "SELECT source, country_target, url FROM missing"))
def q_missing_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles still without a body whose URL is fetchable (skip hosts excluded)."""
    return _missing(spark, sf_dir).select("source", "country_target", "url")


@register("body_enrich", ids=("F15", "F14"), oracle=_backfill_sql(
    "SELECT url, country_target, body FROM filled"))
def q_body_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-body articles joined to their page's extracted body (skip hosts short-circuit to NULL)."""
    return _filled(spark, sf_dir).select("url", "country_target", "body")


@register("backfill_merge", ids=("K06", "J07"), oracle=_backfill_sql("SELECT * FROM merged"))
def q_backfill_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article table after merging the backfilled bodies (coalesce(new, old), other columns unchanged)."""
    return _merged(spark, sf_dir)


@register("fill_counters", ids=("A19",), oracle=_backfill_sql("""
SELECT coalesce(country_target, '?') AS country, COUNT(*) AS attempts,
       COUNT(*) FILTER (WHERE body IS NOT NULL) AS filled
FROM filled GROUP BY 1"""))
def q_fill_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-country attempts and fills of the backfill run."""
    return B.fill_counters(_filled(spark, sf_dir))


@register("body_coverage", ids=("A22",), oracle=_backfill_sql(f"""
SELECT country_target, COUNT(*) AS total,
       COUNT(*) FILTER (WHERE body IS NOT NULL AND body <> '') AS with_body,
       {round_half_up_sql("100.0 * COUNT(*) FILTER (WHERE body IS NOT NULL AND body <> '') / COUNT(*)", 1)} AS pct,
       round(AVG(LENGTH(body)) FILTER (WHERE body IS NOT NULL AND body <> ''), 3) AS avg_body_len
FROM merged GROUP BY 1"""))
def q_body_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body coverage per country after the backfill: total, with body, %, mean body length."""
    c = B.coverage(_merged(spark, sf_dir))
    return c.select("country_target", "total", "with_body",
                    round_half_up(F.lit(100.0) * F.col("with_body") / F.col("total"), 1).alias("pct"),
                    F.round("avg_body_len", 3).alias("avg_body_len"))


@register("body_coverage_overall", ids=("A23",), oracle=_backfill_sql("""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE body IS NOT NULL AND body <> '') AS with_body FROM merged"""))
def q_body_coverage_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall body coverage after the backfill."""
    m = _merged(spark, sf_dir)
    has = F.col("body").isNotNull() & (F.col("body") != "")
    return m.agg(F.count(F.lit(1)).alias("total"), F.count_if(has).alias("with_body"))


@register("method_tally", ids=("A21", "F13"), oracle=f"""
WITH b AS ({BODY_SQL}),
r AS (SELECT page_id, url, {U.canonical_url_sql('url')} AS canonical FROM pages),
m AS (
  SELECT page_id, 'main_text' AS method, body IS NOT NULL AS ok FROM b
  UNION ALL
  SELECT page_id, 'visible_text', {H.strip_html_sql('html')} IS NOT NULL FROM pages
  UNION ALL
  SELECT page_id, 'meta_description', {_meta_sql('html')} IS NOT NULL FROM pages
  UNION ALL
  SELECT page_id, 'resolved_page', canonical IN (SELECT url FROM b WHERE body IS NOT NULL) FROM r WHERE canonical <> url)
SELECT method, COUNT(*) FILTER (WHERE ok) AS succeeded, COUNT(*) AS eligible FROM m GROUP BY 1
""")
def q_method_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction comparison: per method, pages with a non-empty result out of eligible pages.

    Three methods read the page itself (one array of results per page, one scan).
    The fourth resolves the page's address to its canonical form and asks for the
    main text of the page there; only pages with another address are eligible.
    """
    p = S.table(spark, sf_dir, "pages")
    body = BT.extract_body(F.col("html"))
    read = p.select(
        "url", U.canonical_url(F.col("url")).alias("canonical"), body.isNotNull().alias("main_text"),
        H.strip_html(F.col("html")).isNotNull().alias("visible_text"), H.meta_description(F.col("html")).isNotNull().alias("meta_description"))
    own = ("main_text", "visible_text", "meta_description")
    results = F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("ok")) for m in own])
    with_text = read.filter("main_text").select(F.col("url").alias("canonical"), F.lit(True).alias("there")).distinct()
    resolved = read.filter("canonical <> url").select("canonical").join(with_text, "canonical", "left")
    resolved = resolved.select(F.lit("resolved_page").alias("method"), F.coalesce("there", F.lit(False)).alias("ok"))
    long = read.select(F.inline(results)).unionByName(resolved)
    return long.groupBy("method").agg(F.count_if("ok").alias("succeeded"), F.count(F.lit(1)).alias("eligible"))


@register("plugin_articles", ids=("X01", "F14"), oracle=f"SELECT page_id, url, body FROM ({BODY_SQL})")
def q_plugin_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pages read by a source plug-in that turns them into articles."""
    spark.dataSource.register(PL.ArticlePages)
    return spark.read.format(PL.ArticlePages.name()).option("path", f"{sf_dir.rstrip('/')}/pages.parquet").load()


@register("outlet_rules", ids=("X02", "S15"), oracle=f"""
SELECT i.page_id, {U.url_host_sql('p.url')} AS source, pos, title, i.url, summary
FROM ({_items_sql(f"regexp_extract_all(html, {_q(ITEM_RULE)}, 0)", None)}) i JOIN pages p USING (page_id)
""")
def q_outlet_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items of every outlet's pages by the outlet's own rule: a table of rules, one per host, joined to the pages."""
    p = S.table(spark, sf_dir, "pages")
    nothing = F.lit(None)
    rules = p.select(U.url_host(F.col("url")).alias("host")).filter("host IS NOT NULL").distinct().select(
        "host", F.col("host").alias("source"), F.lit("").alias("country_target"), F.lit(CARD_RULE).alias("item_re"),
        F.lit(ITEM_RULE).alias("fallback_re"), nothing.cast("string").alias("heading_re"), nothing.cast("int").alias("before_filter"),
        nothing.cast("int").alias("after_filter"))
    return PG.extract_by_rules(p, rules).select("page_id", "source", "pos", "title", "url", "summary")

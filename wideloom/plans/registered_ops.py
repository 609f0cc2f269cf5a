"""Registered operator-level queries (names, typing, union/dedupe, manifest, links, sheets,
scalars, CSV ingest, combined refresh) over inputs derived from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import axis_label, humanise
from ..functions.text import title_case
from ..operators import links as L
from ..operators import manifest as M
from ..operators.columns import coalesce_dates, coalesce_drifted, name_collisions, normalise_names
from ..operators.reshape import horizontal_sum, month_columns
from ..operators.sniff import sniff
from ..operators.union import dedupe, dedupe_by_digest, reconcile_union
from ..session import scratch_dir
from ..sources.csv import parse_csv, resource_kind
from ..sources.sheets import CELL_GRID_SCHEMA, stack_sheets
from . import ingest as I
from . import shapes as S
from .registered import _BASE, _CURRENT_CUT, _DASH, register

# ── names (N1) ────────────────────────────────────────────────────────────────────────────────

# Messy published headers for the customer columns, in table order.
MESSY_CUSTOMER_HEADERS = (" C CustKey ", "C-Name", "Nation/Key", "Acct.Bal", "Mkt (Segment)")


@register("n01_normalise_names", """
SELECT c_custkey, c_name, c_nationkey AS nation_key, c_acctbal AS acct_bal,
       c_mktsegment AS mkt_segment FROM customer""")
def n01(spark, sf_dir):
    return normalise_names(S.table(spark, sf_dir, "customer").toDF(*MESSY_CUSTOMER_HEADERS))


@register("n02_name_collisions", r"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1)) AS header FROM pages),
n AS (SELECT page_id % 20 AS file, header, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        lower(trim(regexp_replace(header, '[^ -~]', '', 'g'))), '[ \-/.]', '_', 'g'), '[()]', '', 'g'), '_{2,}', '_', 'g'), '^_+|_+$', '', 'g') AS normalised FROM h)
SELECT file, normalised, array_to_string(list_sort(list(DISTINCT regexp_replace(header, '[^ -~]', '', 'g'))), '|') AS headers
FROM n GROUP BY file, normalised
HAVING count(DISTINCT regexp_replace(header, '[^ -~]', '', 'g')) > 1 OR normalised = ''""")
def n02(spark, sf_dir):
    """Links of twenty shelves of pages as the headers of twenty files: names that clash once normalised."""
    heads = L.extract_links(S.table(spark, sf_dir, "pages"), "html", keep=["page_id"], extensions=None, base=F.col("url"))
    heads = heads.select((F.col("page_id") % 20).alias("file"), F.regexp_replace("href", "[^ -~]", "").alias("header"))
    return name_collisions(heads, ["file"], "header").withColumn("headers", F.array_join("headers", "|"))


# ── typing (N5) ───────────────────────────────────────────────────────────────────────────────

def events_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("event_id"),
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                     F.col("user_id").cast("string").alias("user_id"), "event_type",
                     F.col("value").cast("string").alias("value"), "props")


_EVENTS_TYPED = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
FROM events"""


@register("n05_sniff_text_events", _EVENTS_TYPED)
def n05(spark, sf_dir):
    return sniff(events_as_text(spark, sf_dir))[0]


# ── union and dedupe (N6, N7, N11) ────────────────────────────────────────────────────────────

# Snapshot bounds in SQL: the same integer microsecond arithmetic as shapes.snapshot_bounds.
_SPANS = S.SNAPSHOT_SPANS
_BOUNDS = "(SELECT " + ", ".join(
    f"lo + w * {a} // 100 AS s{i}, lo + w * {b} // 100 AS e{i}" for i, (a, b) in enumerate(_SPANS)
) + " FROM (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) - epoch_us(min(ts)) + 1 AS w FROM events))"


def _in(i: int) -> str:
    return f"epoch_us(ts) >= (SELECT s{i} FROM {_BOUNDS}) AND epoch_us(ts) < (SELECT e{i} FROM {_BOUNDS})"


_SNAP_SQL = f"""
SELECT event_id, ts, user_id, event_type, regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') AS value, props,
       NULL::VARCHAR AS eventtype, NULL::VARCHAR AS channel
FROM events WHERE {_in(0)}
UNION ALL
SELECT event_id, ts, user_id, event_type, regexp_replace(CAST(value AS VARCHAR), '\\.0$', ''), props, NULL, NULL
FROM events WHERE {_in(1)}
UNION ALL
SELECT event_id, ts, user_id, NULL, CAST(value AS VARCHAR), props, event_type, upper(event_type)
FROM events WHERE {_in(2)}"""


@register("n06_snapshot_union", _SNAP_SQL)
def n06(spark, sf_dir):
    return reconcile_union(S.event_snapshots(spark, sf_dir))


@register("n07_snapshot_dedupe", f"SELECT DISTINCT * FROM ({_SNAP_SQL})")
def n07(spark, sf_dir):
    return dedupe(reconcile_union(S.event_snapshots(spark, sf_dir)))


@register("n07b_digest_dedupe", f"SELECT DISTINCT * FROM ({_SNAP_SQL})")
def n07b(spark, sf_dir):
    """The rows of ``n07``, found by shuffling digests."""
    return dedupe_by_digest(reconcile_union(S.event_snapshots(spark, sf_dir)))


@register("n08_numbers_as_text", """
WITH w AS (SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) * 1000 AS n, round(o_totalprice, 2) * 1000 AS x FROM orders)
SELECT DISTINCT * FROM (
  SELECT k, CAST(n AS VARCHAR) AS n FROM w UNION ALL SELECT k, CAST(n AS VARCHAR) FROM w)
UNION ALL
SELECT -1 - k, CAST(CAST(round(x * 100) AS BIGINT) // 100 AS VARCHAR)
       || CASE WHEN CAST(round(x * 100) AS BIGINT) % 100 = 0 THEN ''
               ELSE rtrim('.' || lpad(CAST(CAST(round(x * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0'), '0') END FROM w""")
def n08(spark, sf_dir):
    """One count as a whole number in one snapshot and as a double in the other, above 1e7 too: the text of
    both is the same, so each order is one row."""
    w = S.table(spark, sf_dir, "orders")
    n = F.round("o_totalprice").cast("bigint") * 1000
    key = F.col("o_orderkey").alias("k")
    x = F.round(F.round("o_totalprice", 2) * 1000, 2)
    return dedupe(reconcile_union([w.select(key, n.alias("n")), w.select(key, n.cast("double").alias("n")),
                                   w.select((-1 - F.col("o_orderkey")).alias("k"), x.alias("n"))]))


@register("n11b_coalesced_dates", """
SELECT event_id, CAST(ts AS DATE) AS day FROM events""")
def n11b(spark, sf_dir):
    """A date spelled ``dd/MM/yyyy`` in newer rows and ``yyyy-MM-dd`` in older ones, in columns of two names."""
    ev = S.table(spark, sf_dir, "events")
    newer = F.col("event_id") % 2 == 0
    drifted = ev.select("event_id", F.when(newer, F.date_format("ts", "dd/MM/yyyy")).alias("stopdate"),
                        F.when(~newer, F.date_format("ts", "yyyy-MM-dd")).alias("date"))
    return coalesce_dates(drifted, "day", {"stopdate": "dd/MM/yyyy", "date": "yyyy-MM-dd"}).select("event_id", "day")


@register("n11_coalesced_event_kinds", f"""
SELECT coalesce(event_type, eventtype) AS event_kind, COUNT(*) AS n_rows
FROM (SELECT DISTINCT * FROM ({_SNAP_SQL})) GROUP BY 1""")
def n11(spark, sf_dir):
    combined = dedupe(reconcile_union(S.event_snapshots(spark, sf_dir)))
    return (coalesce_drifted(combined, "event_kind", "event_type", "eventtype")
            .groupBy("event_kind").agg(F.count(F.lit(1)).alias("n_rows")))


# ── wide-table row totals (A5) ────────────────────────────────────────────────────────────────

@register("a05_row_totals", """
SELECT p.p_type AS majortext, p.p_name AS minortext, n.n_name AS boroughname,
       CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY ALL""")
def a05(spark, sf_dir):
    wide = S.crime_wide(spark, sf_dir)
    return wide.select("majortext", "minortext", "boroughname",
                       horizontal_sum(month_columns(wide)).cast("bigint").alias("total"))


# ── manifest selection (M1-M4) over pages as published resources ──────────────────────────────

# The registry used against the pages manifest
# (key, short_id, name hint, prefer_historical, combine_resources, combine_stride).
PAGE_REGISTRY = [
    ("com-latest", "com", "/en/", False, False, 1),
    ("com-historical", "com", "", True, False, 1),
    ("net-all", "net", "EXAMPLE", False, True, 4),
    ("org-all", "org", "", False, True, 22),
    ("missing", "zz", "", False, False, 1),
]
_REG_SCHEMA = ("key string, short_id string, resource_name_contains string, "
               "prefer_historical boolean, combine_resources boolean, combine_stride int")


def pages_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as portal resources: short_id = top-level domain, pos = page id, French pages carry
    the historical marker, English pages get a ``.csv`` URL, ``https`` pages declare CSV."""
    p = S.table(spark, sf_dir, "pages")
    url = F.col("url")
    return p.select(
        F.regexp_extract(url, r"\.example\.([a-z]+)", 1).alias("short_id"),
        F.col("page_id").cast("int").alias("pos"),
        F.when(url.contains("/fr/"), F.concat(url, F.lit(" (Historical)"))).otherwise(url).alias("name"),
        F.when(url.contains("/en/"), F.concat(url, F.lit(".csv"))).otherwise(url).alias("url"),
        F.when(url.startswith("https:"), F.lit("CSV")).otherwise(F.lit("HTML")).alias("format"))


def page_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAGE_REGISTRY, _REG_SCHEMA)


_REG_VALUES = ", ".join(f"('{k}', '{s}', '{h}', {str(p).upper()}, {str(c).upper()}, {n})"
                        for k, s, h, p, c, n in PAGE_REGISTRY)
_MATCH_SQL = f"""
WITH man AS (
  SELECT regexp_extract(url, '\\.example\\.([a-z]+)', 1) AS short_id, CAST(page_id AS INTEGER) AS pos,
         CASE WHEN contains(url, '/fr/') THEN url || ' (Historical)' ELSE url END AS name,
         CASE WHEN contains(url, '/en/') THEN url || '.csv' ELSE url END AS url,
         CASE WHEN starts_with(url, 'https:') THEN 'CSV' ELSE 'HTML' END AS format
  FROM pages),
reg AS (SELECT * FROM (VALUES {_REG_VALUES}) t(key, short_id, hint, hist, combine_resources, combine_stride)),
matches AS (
  SELECT r.key, r.combine_resources, r.combine_stride, m.short_id, m.pos, m.name, m.url, m.format
  FROM man m JOIN reg r ON m.short_id = r.short_id
  WHERE (lower(m.url) LIKE '%.csv' OR lower(m.url) LIKE '%.xlsx' OR lower(m.url) LIKE '%.xls'
         OR lower(m.format) IN ('csv', 'xlsx', 'xls'))
    AND (r.hint = '' OR contains(lower(m.name), lower(r.hint)))
    AND contains(m.name, '(Historical)') = r.hist)"""


@register("m01_match_resources", _MATCH_SQL + " SELECT * FROM matches")
def m01(spark, sf_dir):
    return M.match_resources(pages_manifest(spark, sf_dir), page_registry(spark))


@register("m02_pick_resources", _MATCH_SQL + """,
picked AS (SELECT key, pos, name, url, format FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS rn FROM matches) WHERE rn = 1)
SELECT r.key, p.pos, p.name, p.url, p.format FROM reg r LEFT JOIN picked p ON p.key = r.key""")
def m02(spark, sf_dir):
    reg = page_registry(spark)
    return M.pick_resources(M.match_resources(pages_manifest(spark, sf_dir), reg), reg)


_STRIDE_SQL = _MATCH_SQL + """,
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY pos) - 1 AS INTEGER) AS rn,
                  count(*) OVER (PARTITION BY key) AS n FROM matches)"""


@register("m03_stride_sample", _STRIDE_SQL + """
SELECT key, combine_resources, combine_stride, short_id, pos, name, url, format, rn FROM ranked
WHERE rn % combine_stride = 0 OR rn = n - 1""")
def m03(spark, sf_dir):
    return M.stride_sample(M.match_resources(pages_manifest(spark, sf_dir), page_registry(spark)))


@register("m04_plan_refresh", _STRIDE_SQL + """
SELECT key, 0 AS rn, pos, name, url, format, FALSE AS combine_resources FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS r1 FROM matches
  WHERE NOT combine_resources) WHERE r1 = 1
UNION ALL
SELECT key, rn, pos, name, url, format, combine_resources FROM ranked
WHERE combine_resources AND (rn % combine_stride = 0 OR rn = n - 1)""")
def m04(spark, sf_dir):
    return M.plan_refresh(pages_manifest(spark, sf_dir), page_registry(spark))


# ── links (M7, M8) ────────────────────────────────────────────────────────────────────────────

_RESOLVE_SQL = """
p AS (SELECT *, regexp_extract(href, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)', 0) AS scheme,
             regexp_extract(href, '^//[^/?#]*', 0) AS host, regexp_extract(href, '^[^?#]*', 0) AS path,
             regexp_extract(href, '[?#].*$', 0) AS tail,
             regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) AS b_scheme,
             regexp_extract(base, '^[^/]*//[^/?#]*', 0) AS b_root,
             regexp_extract(base, '^[^/]*//[^/?#]*([^?#]*)', 1) AS b_path,
             regexp_extract(base, '^[^#]*', 0) AS b_whole FROM u),
m AS (SELECT *, string_split(CASE WHEN starts_with(path, '/') THEN path ELSE regexp_replace(
             regexp_replace(CASE WHEN b_path = '' THEN '/' ELSE b_path END, '[^/]*$', '') || path, '/{2,}', '/', 'g') END, '/') AS parts
      FROM p),
d AS (SELECT *, list_reduce(list_transform(parts, lambda x: [x]), lambda s, x:
             CASE WHEN x[1] = '.' THEN s WHEN x[1] = '..' THEN s[1:greatest(len(s) - 1, 1)] ELSE list_concat(s, x) END) AS stack
      FROM m)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
       CASE WHEN scheme <> '' THEN href WHEN host <> '' THEN b_scheme || href
            WHEN path <> '' THEN b_root || array_to_string(
              CASE WHEN parts[-1] IN ('.', '..') OR len(stack) = 1 THEN list_append(stack, '') ELSE stack END, '/') || tail
            WHEN starts_with(tail, '?') THEN b_root || b_path || tail
            ELSE b_whole || tail END AS url
FROM d"""


@register("m07_page_links", r"""
WITH l AS (SELECT page_id, url AS base, regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1) AS hrefs FROM pages),
u AS (SELECT page_id, base, unnest(hrefs) AS href, unnest(generate_series(0, len(hrefs) - 1)) AS pos FROM l),""" + _RESOLVE_SQL)
def m07(spark, sf_dir):
    """Every link of every page, resolved against the page's own URL."""
    pages = S.table(spark, sf_dir, "pages")
    return L.extract_links(pages, "html", keep=["page_id"], extensions=None, base=F.col("url"))


# The kinds of references that the pages' own links are turned into, by page number; the
# place of the link's own text is marked {}.
LINK_KINDS = ("/{}.csv", "../{}.csv", "./{}.xlsx", "a/../{}.zip", "{}/../../../b.xls", "?file={}.csv", "#{}.zip",
              "mailto:{}.xls", "//cdn.example.net/{}/./x.csv", "HTTPS://example.org/d/../{}.zip", "../..//{}.xlsx", "{}.csv")


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` whose links to ``/text`` are references of all kinds to files."""
    pages = S.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = F.element_at(F.array(*[F.lit(k.replace("{}", "$1")) for k in LINK_KINDS]),
                        (F.col("page_id") % len(LINK_KINDS) + 1).cast("int"))
    html = F.regexp_replace(F.col("html"), F.lit("""href="/([^"'?#:]*)["]"""),
                            F.concat(F.lit('href="'), kind, F.lit('"')))
    return pages.withColumn("html", html)


_KINDS_SQL = "[" + ", ".join("'" + k.replace("{}", "\\1") + "'" for k in LINK_KINDS) + "]"


@register("m07b_file_links", rf"""
WITH h AS (SELECT page_id, url AS base, regexp_replace(html, 'href="/([^"''?#:]*)["]',
             'href="' || ({_KINDS_SQL})[CAST(page_id % {len(LINK_KINDS)} AS INTEGER) + 1] || '"', 'g') AS html FROM pages),
l AS (SELECT page_id, base, list_concat(list_concat(
        regexp_extract_all(html, 'href=["'']([^"'']+\.csv)["'']', 1), regexp_extract_all(html, 'href=["'']([^"'']+\.xlsx)["'']', 1)),
        list_concat(regexp_extract_all(html, 'href=["'']([^"'']+\.xls)["'']', 1),
                    regexp_extract_all(html, 'href=["'']([^"'']+\.zip)["'']', 1))) AS hrefs FROM h),
u AS (SELECT page_id, base, unnest(hrefs) AS href, unnest(generate_series(0, len(hrefs) - 1)) AS pos FROM l),""" + _RESOLVE_SQL)
def m07b(spark, sf_dir):
    """The links to files of the published kinds, kind by kind, resolved against the page's own URL."""
    return L.extract_links(linked_pages(spark, sf_dir), "html", keep=["page_id"], base=F.col("url"))


@register("s03_resource_kinds", rf"""
WITH h AS (SELECT page_id, regexp_replace(html, 'href="/([^"''?#:]*)["]',
             'href="' || ({_KINDS_SQL})[CAST(page_id % {len(LINK_KINDS)} AS INTEGER) + 1] || '"', 'g') AS html FROM pages),
u AS (SELECT unnest(regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1)) AS href FROM h)
SELECT CASE WHEN regexp_matches(lower(href), '\.xlsx?$') THEN 'sheets' ELSE 'csv' END AS kind, count(*) AS n FROM u GROUP BY 1""")
def s03(spark, sf_dir):
    """How the linked files would be read."""
    links = L.extract_links(linked_pages(spark, sf_dir), "html", extensions=None, base=F.col("url"))
    return links.groupBy(resource_kind(F.col("href")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("s09_dataset_pages", """
WITH k AS (SELECT lower(regexp_replace(p_type, '[^A-Za-z]+', '-', 'g')) AS key, COUNT(*) AS n FROM part GROUP BY 1)
SELECT key, 'https://data.example.org/dataset/' || key AS page_url, 1 AS combine_stride, '' AS resource_name_contains, n FROM k""")
def s09(spark, sf_dir):
    """A registry made from the kinds of parts: the defaults of what it leaves open, and its page map."""
    from ..sources.registry import dataset_pages
    key = F.lower(F.regexp_replace("p_type", "[^A-Za-z]+", "-"))
    reg = S.table(spark, sf_dir, "part").groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    for name, kind in (("combine_stride", "int"), ("resource_name_contains", "string"), ("prefer_historical", "boolean"),
                       ("combine_resources", "boolean")):
        reg = reg.withColumn(name, F.lit(None).cast(kind))
    reg = reg.withColumn("short_id", F.col("key"))
    filled = M.with_defaults(reg).select("key", "combine_stride", "resource_name_contains")
    return filled.join(dataset_pages(reg, "https://data.example.org/dataset/"), "key").join(reg.select("key", "n"), "key")


# The "extensions" searched for in the serialised page records.
JSON_URL_ENDINGS = (".net", "/en")


@register("m08_json_urls", """
WITH b AS (SELECT page_id, to_json({'page_id': page_id, 'url': url, 'mirrors': [url, url]}) AS body
           FROM pages),
l AS (SELECT page_id, list_concat(regexp_extract_all(body, 'https?://[^\\s"''<>]+\\.net', 0),
                                  regexp_extract_all(body, 'https?://[^\\s"''<>]+/en', 0)) AS lst FROM b),
u AS (SELECT page_id, unnest(lst) AS url, unnest(generate_series(1, len(lst))) AS i FROM l),
f AS (SELECT page_id, url, min(i) AS i FROM u GROUP BY ALL)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, url
FROM f""")
def m08(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    body = F.to_json(F.struct("page_id", "url", F.array("url", "url").alias("mirrors")))
    return L.extract_urls(pages.select("page_id", body.alias("body")), "body", keep=["page_id"],
                          extensions=JSON_URL_ENDINGS)


# ── sheets (S2) ───────────────────────────────────────────────────────────────────────────────

# The header rows of the two sheets (a trailing blank header cell on the first).
CUSTOMER_HEADER = ["C Custkey", "C Name", "C Acctbal", "C Mktsegment", None]
SUPPLIER_HEADER = ["S Suppkey", "S Name", "S Nationkey", "S Acctbal"]


def customer_supplier_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-sheet workbook as a cell grid: customers then suppliers, each under a header row;
    sheet row = key + 1 (row 0 is the header)."""
    heads = spark.createDataFrame([("wb", 0, "customer", 0, CUSTOMER_HEADER),
                                   ("wb", 1, "supplier", 0, SUPPLIER_HEADER)], CELL_GRID_SCHEMA)
    c = S.table(spark, sf_dir, "customer").select(
        F.lit("wb").alias("file"), F.lit(0).alias("sheet_pos"), F.lit("customer").alias("sheet"),
        (F.col("c_custkey") + 1).cast("int").alias("row_idx"),
        F.array(F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"),
                "c_mktsegment").alias("cells"))
    su = S.table(spark, sf_dir, "supplier").select(
        F.lit("wb").alias("file"), F.lit(1).alias("sheet_pos"), F.lit("supplier").alias("sheet"),
        (F.col("s_suppkey") + 1).cast("int").alias("row_idx"),
        F.array(F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"),
                F.col("s_acctbal").cast("string")).alias("cells"))
    return heads.unionByName(c).unionByName(su)


@register("s02_sheets_workbook", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_acctbal, c_mktsegment, NULL::VARCHAR AS col_4,
       'customer' AS sheet, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name,
       NULL::BIGINT AS s_nationkey, NULL::DOUBLE AS s_acctbal
FROM customer
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 'supplier', CAST(s_suppkey AS BIGINT), s_name,
       CAST(s_nationkey AS BIGINT), s_acctbal FROM supplier""")
def s02(spark, sf_dir):
    return I.normalise(stack_sheets(customer_supplier_grid(spark, sf_dir)))[0]


# ── scalars (F8, F12, F13) ────────────────────────────────────────────────────────────────────

@register("f08_title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
                                                 lambda x: upper(x[1]) || x[2:]), ' ') AS label
FROM part""")
def f08(spark, sf_dir):
    return S.table(spark, sf_dir, "part").select("p_partkey", title_case("p_name").alias("label"))


@register("f08b_title_case_runs", """
SELECT page_id, array_to_string(list_transform(regexp_extract_all(lower(regexp_replace(url, '[^ -~]', '', 'g')), '[a-z]+|[^a-z]+'),
                                               lambda x: upper(x[1]) || x[2:]), '') AS label
FROM pages""")
def f08b(spark, sf_dir):
    """Words that begin after digits, dots, hyphens and slashes."""
    return S.table(spark, sf_dir, "pages").select("page_id", title_case(F.regexp_replace("url", "[^ -~]", "")).alias("label"))


@register("f12b_humanise_large_totals", """
WITH g AS (SELECT 'supplier ' || l_suppkey AS k, l_quantity AS q FROM lineitem UNION ALL SELECT 'flag ' || l_returnflag, l_quantity FROM lineitem
           UNION ALL SELECT 'all', l_quantity FROM lineitem UNION ALL SELECT 'tenfold', l_quantity * 10 FROM lineitem),
t AS (SELECT k, CAST(SUM(CAST(q AS BIGINT)) AS BIGINT) AS total FROM g GROUP BY k)
SELECT k, total,
  CASE WHEN total >= 1000000 THEN printf('%.1f', round(total / 1e6, 1)) || 'M'
       WHEN total >= 1000 THEN CAST(CAST(round(total / 1e3) AS BIGINT) AS VARCHAR) || 'K'
       ELSE CAST(total AS VARCHAR) END AS label,
  CASE WHEN total >= 1000000 THEN printf('%.1f', round(total / 1e6, 1)) || 'M'
       WHEN total >= 10000 THEN CAST(CAST(round(total / 1e3) AS BIGINT) AS VARCHAR) || 'K'
       WHEN total >= 1000 THEN printf('%.1f', round(total / 1e3, 1)) || 'K'
       ELSE CAST(total AS VARCHAR) END AS axis
FROM t""")
def f12b(spark, sf_dir):
    """Labels past 1e4 and 1e6: totals of suppliers, of return flags and of everything."""
    li = S.table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    keys = F.array(F.struct(F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("k"), F.col("q").alias("q")),
                   F.struct(F.concat(F.lit("flag "), "l_returnflag").alias("k"), F.col("q").alias("q")),
                   F.struct(F.lit("all").alias("k"), F.col("q").alias("q")), F.struct(F.lit("tenfold").alias("k"), (F.col("q") * 10).alias("q")))
    t = li.select(F.inline(keys)).groupBy("k").agg(F.sum("q").alias("total"))
    return t.select("k", "total", humanise("total").alias("label"), axis_label("total").alias("axis"))


@register("f12_humanise_totals", """
WITH t AS (SELECT l_partkey, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total
           FROM lineitem GROUP BY l_partkey)
SELECT l_partkey, total,
  CASE WHEN total >= 1000000 THEN printf('%.1f', round(total / 1e6, 1)) || 'M'
       WHEN total >= 1000 THEN CAST(CAST(round(total / 1e3) AS BIGINT) AS VARCHAR) || 'K'
       ELSE CAST(total AS VARCHAR) END AS label,
  CASE WHEN total >= 1000000 THEN printf('%.1f', round(total / 1e6, 1)) || 'M'
       WHEN total >= 10000 THEN CAST(CAST(round(total / 1e3) AS BIGINT) AS VARCHAR) || 'K'
       WHEN total >= 1000 THEN printf('%.1f', round(total / 1e3, 1)) || 'K'
       ELSE CAST(total AS VARCHAR) END AS axis
FROM t""")
def f12(spark, sf_dir):
    t = (S.table(spark, sf_dir, "lineitem").groupBy("l_partkey")
         .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total")))
    return t.select("l_partkey", "total", humanise("total").alias("label"),
                    axis_label("total").alias("axis"))


# ── CSV ingest (S1, S1a, S1b) and combined refresh (M6) ───────────────────────────────────────

def _stage_csv(df: DataFrame, path: str) -> str:
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", False).csv(path))
    return path


@register("s01_csv_roundtrip_events", _EVENTS_TYPED)
def s01(spark, sf_dir):
    path = _stage_csv(events_as_text(spark, sf_dir),
                      f"{scratch_dir(spark)}/csv-events-{uuid.uuid4().hex}")
    return I.normalise(parse_csv(spark, path)[0], numeric=False)[0]


@register("s01b_messy_csv_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s01b(spark, sf_dir):
    """Texts with line breaks, quotes and outer spaces written as CSV and read back: records that span
    lines are put together by many tasks."""
    path = f"{scratch_dir(spark)}/csv-documents-{uuid.uuid4().hex}"
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    return I.normalise(parse_csv(spark, path)[0], numeric=False)[0]


@register("s01c_latin1_and_utf8_files", """
SELECT c_custkey, c_name || ' äöü é' AS c_name, c_mktsegment FROM customer""")
def s01c(spark, sf_dir):
    """Files of two encodings under one path, told apart file by file."""
    path = f"{scratch_dir(spark)}/csv-encodings-{uuid.uuid4().hex}"
    c = S.table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" äöü é")).alias("c_name"), "c_mktsegment")
    for encoding, part in (("ISO-8859-1", c.filter("c_custkey % 2 = 0")), ("UTF-8", c.filter("c_custkey % 2 = 1"))):
        part.write.mode("append").option("header", True).option("encoding", encoding).csv(path)
    return I.normalise(parse_csv(spark, path)[0], numeric=False)[0]


@register("s06_catalog", "WITH" + _BASE + "," + _DASH + f",\nsnap AS (SELECT DISTINCT * FROM ({_SNAP_SQL}))" + """
SELECT 'recorded-crime-borough' AS key, (SELECT COUNT(*) FROM (SELECT DISTINCT majortext, minortext, boroughname FROM base
  WHERE ym >= """ + _CURRENT_CUT + """)) AS n_rows, 27 AS n_columns
UNION ALL SELECT 'recorded-crime-borough-historical', (SELECT COUNT(*) FROM (SELECT DISTINCT majortext, minortext, boroughname FROM base
  WHERE ym < """ + _CURRENT_CUT + """)), 3 + (SELECT CAST(COUNT(DISTINCT ym) AS INTEGER) FROM base WHERE ym < """ + _CURRENT_CUT + """)
UNION ALL SELECT 'monthly-crime-dashboard', (SELECT COUNT(*) FROM dash), 7
UNION ALL SELECT 'stop-search', (SELECT COUNT(*) FROM events), 6
UNION ALL SELECT 'vawg-offences', (SELECT COUNT(*) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey), 3
UNION ALL SELECT 'thorough-searches', (SELECT COUNT(*) FROM snap), 8""")
def s06(spark, sf_dir):
    """Datasets saved, then opened by their loaders: rows from the files' footers, columns from the schema."""
    from ..sources.catalog import Catalog
    root = f"{scratch_dir(spark)}/catalog-{uuid.uuid4().hex}"
    keys = S.stage_catalog(spark, sf_dir, root)
    cat = Catalog(spark, root)
    rows = [(k, cat.row_count(k), len(cat.load(k).columns)) for k in keys]
    return spark.createDataFrame(rows, "key string, n_rows bigint, n_columns int")


_SNAP_CSV_SQL = f"""
SELECT DISTINCT * FROM (
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props,
       NULL::VARCHAR AS eventtype, NULL::VARCHAR AS channel
FROM events WHERE {_in(0)}
UNION ALL
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), user_id, event_type, value, props, NULL, NULL
FROM events WHERE {_in(1)}
UNION ALL
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), user_id, NULL, value, props, event_type,
       upper(event_type)
FROM events WHERE {_in(2)})"""


def staged_snapshots(spark: SparkSession, sf_dir: str, root: str) -> list[tuple]:
    """The three event snapshots staged as CSV resources: manifest rows, newest first."""
    rows = []
    for i, snap in enumerate(reversed(S.event_snapshots(spark, sf_dir))):
        text = snap.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "ts"
                             else F.col(c).cast("string").alias(c) for c in snap.columns])
        url = _stage_csv(text, f"{root}/in/LDS_Extract_{i}.csv")
        rows.append(("events", i, f"LDS_Extract snapshot {i}", url, "csv"))
    return rows


# Settings of the staged datasets (key, short id, name hint, all snapshots).
_EVENT_SOURCES = (("events-combined", "events", "LDS_Extract", True), ("events-newest", "events", "lds_extract", False),
                  ("broken", "broken", "", False), ("unmatched", "events", "no such name", True))


def event_sources(keys: tuple[str, ...]) -> list[dict]:
    return [{"key": k, "short_id": s, "resource_name_contains": h, "prefer_historical": False, "combine_resources": c,
             "combine_stride": 1, "output": f"{k}.parquet"} for k, s, h, c in _EVENT_SOURCES if k in keys]


@register("m06_combined_refresh", _SNAP_CSV_SQL)
def m06(spark, sf_dir):
    """Stage the three event snapshots as CSV resources, list them in a manifest (newest
    first), and run the combined refresh (stride 1) end to end; returns the written dataset."""
    root = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    manifest = spark.createDataFrame(staged_snapshots(spark, sf_dir, root), M.MANIFEST_SCHEMA)
    report = I.refresh_source(spark, event_sources(("events-combined",))[0], manifest, f"{root}/out")
    out = spark.read.parquet(report.path)
    # newest snapshot is read first, so restore the documented column order
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props", "eventtype", "channel"]
    return out.select(*[c for c in cols if c in out.columns])


@register("m05_batch_refresh", f"""
WITH r AS (
  SELECT 'events-combined' AS key, 'ok' AS status, (SELECT count(*) FROM ({_SNAP_CSV_SQL})) AS n_rows, 3 AS used, 0 AS skipped
  UNION ALL SELECT 'events-newest', 'ok', (SELECT count(*) FROM events WHERE {_in(2)}), 1, 0
  UNION ALL SELECT 'broken', 'failed', 0, 0, 0
  UNION ALL SELECT 'unmatched', 'no-match', 0, 0, 0)
SELECT key, status, n_rows, used, skipped, CAST(NULL AS BIGINT) AS files, CAST(NULL AS VARCHAR) AS failed FROM r
UNION ALL
SELECT '(all)', NULL, sum(n_rows)::BIGINT, sum(used)::INTEGER, sum(skipped)::INTEGER, count(*) FILTER (status = 'ok'),
       string_agg(key, ',') FILTER (status = 'failed') FROM r""")
def m05(spark, sf_dir):
    """Four datasets refreshed from one manifest: two good ones, one whose file is missing, one without a
    match; the report and its totals (A10)."""
    root = f"{scratch_dir(spark)}/batch-{uuid.uuid4().hex}"
    rows = staged_snapshots(spark, sf_dir, root) + [("broken", 0, "missing file", f"{root}/in/missing.csv", "csv")]
    report = I.refresh(spark, event_sources(tuple(k for k, *_ in _EVENT_SOURCES)),
                       spark.createDataFrame(rows, M.MANIFEST_SCHEMA), f"{root}/out", parallel=4)
    lines = report.select("key", "status", F.col("rows").alias("n_rows"), F.size("used").alias("used"),
                          F.size("skipped").alias("skipped"))
    total = I.summarise(report).select("files", F.array_join("failed", ",").alias("failed"))
    whole = lines.agg(F.lit("(all)").alias("key"), F.lit(None).cast("string").alias("status"), F.sum("n_rows").alias("n_rows"),
                      F.sum("used").cast("int").alias("used"), F.sum("skipped").cast("int").alias("skipped"))
    return lines.withColumns({"files": F.lit(None).cast("bigint"), "failed": F.lit(None).cast("string")}) \
        .unionByName(whole.withColumns({"files": F.lit(total.first().files), "failed": F.lit(total.first().failed)}))


# ── column labels (F7) and chart payloads (S8) ────────────────────────────────────────────────

@register("f07_month_labels", """
SELECT ym AS month, strftime(strptime(ym, '%Y%m'), '%b %Y') AS label
FROM (SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS ym FROM lineitem)""")
def f07(spark, sf_dir):
    from ..functions.dates import column_label
    months = (S.table(spark, sf_dir, "lineitem")
              .select(F.date_format("l_shipdate", "yyyyMM").alias("month")).distinct())
    return months.select("month", column_label("month").alias("label"))


@register("s08_by_borough_payload", """
WITH t AS (SELECT boroughname, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
           JOIN supplier s ON l.l_suppkey = s.s_suppkey
           JOIN (SELECT n_nationkey, n_name AS boroughname FROM nation) n ON s.s_nationkey = n.n_nationkey
           GROUP BY boroughname)
SELECT CAST(to_json({'labels': list(boroughname ORDER BY total DESC, boroughname),
                     'values': list(total ORDER BY total DESC, boroughname)}) AS VARCHAR) AS json
FROM t""")
def s08(spark, sf_dir):
    from ..sources.sinks import chart_payload
    from . import analyses as A
    by = A.by_borough(S.crime_wide(spark, sf_dir))
    return chart_payload(by, "boroughname", "total", order=["-total", "boroughname"])


# ── text and number defaults (F19, F20) and notebook tick labels (F14) ────────────────────────

@register("f19_text_and_number_defaults", "WITH" + """
rec AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'Unknown'
              ELSE event_type END AS ethnicappearance,
         CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k') END AS legislation
  FROM events)
SELECT event_id, coalesce(ethnicappearance, '') AS ethnicity_text,
       coalesce(nullif(legislation, ''), '--') AS legislation_label,
       CAST(coalesce(length(legislation), 0) AS INTEGER) AS legislation_len
FROM rec""")
def f19(spark, sf_dir):
    from ..functions.numbers import zero_if_null
    from ..functions.text import default_if_blank, empty_if_null
    rec = S.stop_records(spark, sf_dir)
    return rec.select("event_id", empty_if_null("ethnicappearance").alias("ethnicity_text"),
                      default_if_blank("legislation", "--").alias("legislation_label"),
                      zero_if_null(F.length("legislation")).alias("legislation_len"))


@register("f14_tick_labels", """
SELECT l_partkey, CAST(CAST(round(SUM(CAST(l_quantity AS BIGINT)) / 1e3) AS BIGINT) AS VARCHAR) || 'K'
       AS tick
FROM lineitem GROUP BY l_partkey""")
def f14(spark, sf_dir):
    from ..functions.numbers import thousands_label
    t = (S.table(spark, sf_dir, "lineitem").groupBy("l_partkey")
         .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total")))
    return t.select("l_partkey", thousands_label("total").alias("tick"))

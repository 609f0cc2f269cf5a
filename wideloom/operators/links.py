"""Link discovery over page and API text (M7, M8), one row per link, fully in Spark.

* M7: ``href="..."`` / ``href='...'`` links ending in one of the extensions, extension-major
  (all ``.csv`` links of a page before its ``.xlsx`` links), page order inside an extension,
  then resolved against a base: the site's root or the page's own URL (see
  :func:`wideloom.functions.urls.url_join`).
* M8: ``http(s)://`` URLs ending in one of the extensions inside arbitrary text (the serialised
  API response), extension-major, first-seen duplicates removed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import find_all, ordered_distinct
from ..functions.urls import url_join

# The file extensions searched for and the URL body grammar.
LINK_EXTENSIONS = (".csv", ".xlsx", ".xls", ".zip")
URL_BODY = r"""https?://[^\s"'<>]+"""
HREF_BODY = r"""[^"']+"""


def href_pattern(ext: str | None) -> str:
    tail = re.escape(ext) if ext else ""
    return r"""href=["'](""" + HREF_BODY + tail + r""")["']"""


def extract_links(df: DataFrame, html: str, *, keep: Sequence[str] = (),
                  extensions: Sequence[str] | None = LINK_EXTENSIONS,
                  base: str | Column = "") -> DataFrame:
    """M7: rows ``(*keep, pos, href, url)``; ``extensions=None`` takes every href. ``base`` is one URL
    for all pages or a column of each page's own URL."""
    exts = list(extensions) if extensions else [None]
    per_ext = [find_all(html, href_pattern(e), 1) for e in exts]
    found = F.flatten(F.array(*per_ext)) if len(per_ext) > 1 else per_ext[0]
    base_col = base if isinstance(base, Column) else F.lit(base)
    out = df.select(*keep, base_col.alias("_base"), F.posexplode(found).alias("pos", "href"))
    return out.select(*keep, "pos", "href", url_join(F.col("_base"), F.col("href")).alias("url"))


def extract_urls(df: DataFrame, text: Column | str, *, keep: Sequence[str] = (),
                 extensions: Sequence[str] = LINK_EXTENSIONS) -> DataFrame:
    """M8: rows ``(*keep, pos, url)``, duplicates within a text removed, first seen kept."""
    t = text if isinstance(text, Column) else F.col(text)
    per_ext = [find_all(t, URL_BODY + re.escape(e), 0) for e in extensions]
    found = ordered_distinct(F.flatten(F.array(*per_ext)) if len(per_ext) > 1 else per_ext[0])
    return df.select(*keep, F.posexplode(found).alias("pos", "url"))

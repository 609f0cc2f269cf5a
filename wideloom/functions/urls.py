"""URL references (F17): a link made absolute against the page or site it was found on.

The general syntax of URLs is split with one pattern into scheme, authority, path, query and fragment;
a reference that has no scheme or authority takes them from the base, its path is merged with the base's
directory, and the segments ``.`` and ``..`` are taken out with an array fold that serves as a stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generic URL syntax (scheme, authority, path, query, fragment).
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_PARTS = rf"(?s)^(?:({_SCHEME}):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(c: Column, k: int) -> Column:
    return F.regexp_extract(c, _PARTS, k)


def remove_dot_segments(path: Column) -> Column:
    """``/a/./b/../c`` -> ``/a/c``; ``..`` never leaves the root; a path that ends in ``.`` or ``..``
    names a folder and ends in ``/``."""
    parts = F.split(path, "/")
    floor = F.when(path.startswith("/"), F.lit(1)).otherwise(F.lit(0))       # the empty part before the root
    stack = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda s, x: F.when(x == ".", s)
                      .when(x == "..", F.slice(s, 1, F.greatest(F.size(s) - 1, F.least(F.size(s), floor))))
                      .otherwise(F.concat(s, F.array(x))))
    folder = F.element_at(parts, -1).isin(".", "..")
    joined = F.array_join(stack, "/")
    return F.when(folder & ~joined.endswith("/") | (joined == "") & path.startswith("/"),
                  F.concat(joined, F.lit("/"))).otherwise(joined)


def url_join(base: str | Column, ref: str | Column) -> Column:
    """``ref`` resolved against ``base`` (a page's URL, or a site's ``https://host``).

    * with a scheme (``https://...``, ``mailto:...``, ``javascript:...``): unchanged;
    * ``//host/path``: the base's scheme is put before it;
    * empty: the base without its fragment; ``#part`` and ``?query`` keep the base's path (``#part`` its
      query too);
    * ``/path``: from the root of the base's host; any other path: from the folder of the base's path,
      empty segments inside a merged path removed; both without ``.`` and ``..`` segments.

    White space around a reference is ignored. A null reference gives null; a null base counts as empty,
    so only references that need nothing of it come out absolute.
    """
    ref = F.regexp_replace(ref if isinstance(ref, Column) else F.col(ref), r"^\s+|\s+$", "")
    base = F.coalesce(base if isinstance(base, Column) else F.lit(base), F.lit(""))
    scheme, host, path, query, fragment = (_part(ref, k) for k in range(1, 6))
    b_scheme, b_host, b_path, b_query = (_part(base, k) for k in range(1, 5))
    start = F.when(b_scheme == "", F.lit("")).otherwise(F.concat(b_scheme, F.lit(":")))
    folder = F.when((b_host != "") & (b_path == ""), F.lit("/")).otherwise(F.regexp_replace(b_path, "[^/]*$", ""))
    merged = F.regexp_replace(F.concat(folder, path), "(?<=.)/{2,}", "/")
    whole = remove_dot_segments(F.when(path.startswith("/"), path).otherwise(merged))
    return (F.when(scheme != "", ref)
             .when(host != "", F.concat(start, ref))
             .when(path != "", F.concat(start, b_host, whole, query, fragment))
             .when(query != "", F.concat(start, b_host, b_path, query, fragment))
             .otherwise(F.concat(start, b_host, b_path, b_query, fragment)))

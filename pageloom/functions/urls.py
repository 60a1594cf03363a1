"""URL column functions (S-8 to S-18, S-22, S-23).

Hosts are taken with one regular expression instead of ``parse_url``:
``parse_url`` throws on malformed input under ANSI mode, and generated link
URLs may hold non-ASCII characters.  The same pattern drives the DuckDB
oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.util import col_of

# netloc (userinfo, host, port) of an absolute URL, as urlparse would cut it
AUTHORITY_RE = r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
HTTP_PREFIX_RE = r"\Ahttps?:"
HTTP_SCHEME_RE = r"\Ahttps?://"


def host(url) -> Column:
    """S-13: ``urlparse(u).netloc``; ``''`` for a relative URL."""
    return F.regexp_extract(col_of(url), AUTHORITY_RE, 1)


def hostname(url) -> Column:
    """Host without userinfo and port, lower-cased (for domain rules)."""
    auth = host(url)
    no_user = F.regexp_replace(auth, r"\A[^@]*@", "")
    return F.lower(F.regexp_replace(no_user, r":[0-9]*\z", ""))


def absolutize(href, page_url) -> Column:
    """S-9: keep ``http(s):`` links, otherwise prefix ``http://`` + the
    source page's netloc."""
    h = col_of(href)
    return F.when(h.rlike(HTTP_PREFIX_RE), h).otherwise(
        F.concat(F.lit("http://"), host(page_url), h))


def absolutize_rooted(href, page_url) -> Column:
    """S-10: as :func:`absolutize`, but a bare relative link gets a leading
    ``/`` first."""
    h = col_of(href)
    rooted = F.when(h.rlike(HTTP_PREFIX_RE) | h.startswith("/"), h).otherwise(F.concat(F.lit("/"), h))
    return absolutize(rooted, page_url)


def default_scheme(url) -> Column:
    """S-12: add ``http://`` unless the URL already has an http(s) scheme."""
    u = col_of(url)
    return F.when(u.rlike(HTTP_SCHEME_RE), u).otherwise(F.concat(F.lit("http://"), u))


def url_quote(c) -> Column:
    """S-14: percent-encode a name for a URL path the way ``urllib.quote``
    does (``/`` kept, space as ``%20``, ``*`` and ``~`` encoded)."""
    e = F.url_encode(col_of(c))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def first_capture(c, pattern: str, default: str | None = None) -> Column:
    """S-15: first capture of ``pattern``; NULL (or ``default``) when it
    does not match."""
    v = F.nullif(F.regexp_extract(col_of(c), pattern, 1), F.lit(""))
    return F.coalesce(v, F.lit(default)) if default is not None else v


def path_token(c, index: int, sep: str = "/") -> Column:
    """S-16: ``s.split(sep)[index]`` with Python indexing (negative from the
    end); NULL when out of range."""
    parts = F.split(col_of(c), _re_quote(sep), -1)
    idx = index + 1 if index >= 0 else index
    return F.try_element_at(parts, F.lit(idx))


def remove_all(c, piece: str) -> Column:
    """S-17: remove a substring everywhere."""
    return F.replace(col_of(c), F.lit(piece), F.lit(""))


def _re_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)

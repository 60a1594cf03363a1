"""SQL text for the DuckDB oracle, built from the same pattern constants as
the Spark column functions.  Each helper takes SQL expressions (strings)
and returns an SQL expression string.

DuckDB's ``regexp_replace`` replaces only the first match unless given the
``'g'`` option; it is always passed here.
"""

from __future__ import annotations

from pageloom.functions import text as T
from pageloom.functions import urls as U

# the oracle's own statement of an anchor and its link (quoted values)
ANCHOR_RULE = r"(?i)<a\b[^>]*>(?:[^<]|<[^a/]|</[^a]|<a[^\t\n\f\r >]|</a[^\t\n\f\r >])*"
HREF_RULE = r"(?i)\shref\s*=\s*[\"']([^\"']*)[\"']"


# elements that are text's siblings in the pages: read without their text
INLINE_RULES = [rf"(?is)<{t}\b[^>]*>.*?</{t}>" for t in ("b", "strong", "span", "i", "em", "font")]


def block_rule(tag: str, attr: str | None = None, value: str | None = None, prefix: bool = False) -> str:
    """The first ``<tag ...>...</tag>``; the given pages nest no block in one of its name."""
    rest = "" if attr is None else rf'[^>]*\b{attr}\s*=\s*"{value}' + ('[^"]*"' if prefix else '"')
    return rf"(?is)<{tag}\b{rest}[^>]*>(.*?)</{tag}>"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ws_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(T.WS_STRIP_RE)}, '', 'g')"


def collapse_ws(x: str) -> str:
    return ws_strip(f"regexp_replace({x}, {lit(T.WS_RUN_RE)}, ' ', 'g')")


def first_text(x: str) -> str:
    return f"coalesce({ws_strip(f'replace({x}, chr(10), chr(32))')}, '')"


def strip_tags(x: str) -> str:
    s = f"regexp_replace({x}, {lit(T.SCRIPT_RE)}, '', 'g')"
    s = f"regexp_replace({s}, {lit(T.TAG_RE)}, '', 'g')"
    s = f"regexp_replace({s}, {lit(T.LEAD_TO_GT_RE)}, '', 'g')"
    return (f"CASE WHEN strpos({s}, '<') > 1 THEN substr({s}, 1, strpos({s}, '<') - 1) "
            f"ELSE {s} END")


def unescape(x: str) -> str:
    s = x
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
                    ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        s = f"replace({s}, {lit(ent)}, {lit(ch)})"
    return s


def host(x: str) -> str:
    return f"regexp_extract({x}, {lit(U.AUTHORITY_RE)}, 1)"


def absolutize(h: str, page_url: str) -> str:
    return (f"CASE WHEN regexp_matches({h}, {lit(U.HTTP_PREFIX_RE)}) THEN {h} "
            f"ELSE 'http://' || {host(page_url)} || {h} END")


def block(html: str, tag: str, attr=None, value=None, prefix=False, inner=False) -> str:
    return f"regexp_extract({html}, {lit(block_rule(tag, attr, value, prefix))}, {1 if inner else 0})"


def blocks(html: str, tag: str, attr=None, value=None, prefix=False, inner=True) -> str:
    return f"regexp_extract_all({html}, {lit(block_rule(tag, attr, value, prefix))}, {1 if inner else 0})"


def first_direct_text(x: str) -> str:
    s = x
    for rx in INLINE_RULES:
        s = f"regexp_replace({s}, {lit(rx)}, chr(1), 'g')"
    parts = f"string_split(regexp_replace({s}, '<[^>]*>', chr(1), 'g'), chr(1))"
    return f"coalesce(list_filter({parts}, lambda t: length(t) > 0)[1], '')"


def anchors(frag: str) -> str:
    """list of struct(href, text), same rule as ``functions.html.anchors``."""
    href = unescape(f"regexp_extract(split_part(m, '>', 1), {lit(HREF_RULE)}, 1)")
    text = unescape(first_direct_text("substr(m, strpos(m, '>') + 1)"))
    return (f"list_transform(regexp_extract_all({frag}, {lit(ANCHOR_RULE)}, 0), "
            f"lambda m: {{'href': {href}, 'text': {text}}})")


def url_quote(x: str) -> str:
    return f"replace(replace(url_encode({x}), '%2F', '/'), '~', '%7E')"


def path_token(x: str, index: int, sep: str = "/") -> str:
    idx = index + 1 if index >= 0 else index
    return f"string_split({x}, {lit(sep)})[{idx}]"


def first_group(x: str, pattern: str) -> str:
    return f"regexp_extract({x}, {lit(pattern)}, 1)"

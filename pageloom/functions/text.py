"""Text column functions (S-1 to S-7, S-24, S-25).

All are compositions of native Spark expressions, so they stay inside
whole-stage codegen.  Regular expressions are kept in the subset that Java
and RE2 read the same way, so the DuckDB oracle can use the very same
pattern strings (``pageloom.plans.duck``).
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.util import applied, bound, col_of, map_of, quoted

# Whitespace as Python's unicode ``str.strip()`` sees it.  Neither Spark's
# ``trim`` (spaces only) nor ``\s`` (differs between Java and RE2, misses
# U+3000) is that set, so it is spelled out.
WS_CLASS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}"
            r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_STRIP_RE = rf"\A{WS_CLASS}+|{WS_CLASS}+\z"
WS_RUN_RE = rf"{WS_CLASS}+"

# strip_tags steps; `[^\n]` instead of `.` keeps Python's newline rule
# (Java's `.` would also stop at \r, U+0085, U+2028, U+2029).
SCRIPT_RE = r"(?i)<script[^>]*?>[^\n]*?</script>"
TAG_RE = r"<[^>]*?>"
LEAD_TO_GT_RE = r"\A[^>]*>"
# cut at the first '<' only when it is not the first character
CUT_AT_LT_RE = r"(?s)\A([^<]+)<.*\z"


# the same set as characters, for btrim (which walks in from both ends
# instead of scanning the whole text)
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def ws_strip(c) -> Column:
    """S-2: strip Unicode whitespace at both ends."""
    return F.btrim(col_of(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """S-4: ``' '.join(s.split())`` -- runs of whitespace to one space,
    both ends stripped."""
    return ws_strip(F.regexp_replace(col_of(c), WS_RUN_RE, " "))


def first_text(c) -> Column:
    """S-3: newlines to spaces, stripped, ``''`` when absent."""
    return F.coalesce(ws_strip(F.replace(col_of(c), F.lit("\n"), F.lit(" "))), F.lit(""))


def strip_chars(c, chars: str) -> Column:
    """S-7: strip the given characters from both ends (``v.strip(':')``)."""
    return F.btrim(col_of(c), F.lit(chars))


def strip_tags(c) -> Column:
    """S-1: drop scripts, drop tags, cut up to a leftover ``>``, cut from a
    leftover ``<`` unless it is the first character."""
    s = F.regexp_replace(col_of(c), SCRIPT_RE, "")
    s = F.regexp_replace(s, TAG_RE, "")
    s = F.regexp_replace(s, LEAD_TO_GT_RE, "")
    return F.regexp_replace(s, CUT_AT_LT_RE, "$1")


def between_markers(c, former: str, latter: str, pos: int = 0,
                    strip_flag: bool = False) -> Column:
    """S-5: text between two markers from a 0-based start offset, as
    ``struct<text string, end_pos int>``; ``('', -1)`` when a marker is
    missing.  Empty ``former`` means from 0, empty ``latter`` to the end;
    ``strip_flag`` drops the markers from the text."""
    s = col_of(c)
    lf, ll = len(former), len(latter)
    if former:
        start = F.locate(former, s, pos + 1) - 1          # 0-based, -1 if missing
    else:
        start = F.lit(0)
    if latter:
        idx = F.instr(F.substr(s, start + lf + 1), latter)     # 1-based in the rest
        stop = F.when((start >= 0) & (idx > 0), idx - 1 + start + lf).otherwise(-1)  # 0-based
        end_pos = stop + ll
    else:
        stop = F.length(s)
        end_pos = stop
    ok = (start >= 0) & (stop >= 0)
    if strip_flag:
        text = F.substring(s, start + lf + 1, end_pos - ll - (start + lf))
    else:
        text = F.substring(s, start + 1, end_pos - start)
    return F.when(s.isNull(), F.lit(None)).otherwise(F.struct(
        F.when(ok, text).otherwise(F.lit("")).alias("text"),
        F.when(ok, end_pos).otherwise(F.lit(-1)).cast("int").alias("end_pos")))


def join_lines(arr, sep: str = "\n") -> Column:
    """S-6: join a list of strings."""
    return F.array_join(col_of(arr), sep)


def mutual_contains(a, b) -> Column:
    """S-24: one string contains the other (an empty string matches all)."""
    a, b = col_of(a), col_of(b)
    return F.contains(a, b) | F.contains(b, a)


def arrays_match(a, b) -> Column:
    """S-25: equal length and mutual containment at every position."""
    a, b = col_of(a), col_of(b)
    return (F.size(a) == F.size(b)) & F.forall(
        F.arrays_zip(a.alias("x"), b.alias("y")),
        lambda p: F.contains(p["x"], p["y"]) | F.contains(p["y"], p["x"]))


#: Named entities (the set of the standard library), and what the numbers
#: 128 to 159 stand for: the Windows letters where there are some.
_NAMED = {f"&{name};": chr(code) for name, code in sorted(name2codepoint.items())} | {"&apos;": "'"}
_LATIN = {str(n): bytes([n]).decode("cp1252", "replace") for n in range(128, 160)}
_HEX_RE, _DEC_RE = "([0-9A-Fa-f]+);", "([0-9]+);"
_REFERENCE_RE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]++|&"


def unescape_sql(x: str) -> str:
    """SQL of :func:`html_unescape`; ``x`` is a name."""
    def number(digits: str) -> str:
        none = "(n = 0 or n between 55296 and 57343 or n > 1114111)"
        letter = f"decode(unhex(lpad(hex(if({none}, 65533, n)), 8, '0')), 'UTF-32')"
        return bound(f"cast({digits} as int)", "n", f"coalesce(try_element_at({map_of(_LATIN.items())}, cast(n as string)), {letter})")

    decoded = (f"case when rlike(part, {quoted('^&#[xX]')}) then {number(f'conv(regexp_extract(part, {quoted(_HEX_RE)}, 1), 16, 10)')}"
               f" when rlike(part, {quoted('^&#[0-9]')}) then {number(f'regexp_extract(part, {quoted(_DEC_RE)}, 1)')}"
               f" when startswith(part, '&') then coalesce(try_element_at({map_of(_NAMED.items())}, part), part) else part end")
    parts = f"regexp_extract_all({x}, {quoted(_REFERENCE_RE)}, 0)"
    return f"if(contains({x}, '&'), array_join(transform({parts}, part -> {decoded}), ''), {x})"


def html_unescape(c) -> Column:
    """Decode named and numeric entities, each once, as an HTML parser's text
    nodes would; an unknown name stays as it is, a number that is no
    character becomes U+FFFD."""
    return applied(col_of(c), "escaped", unescape_sql("escaped"))

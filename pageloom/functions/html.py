"""HTML record extraction as native column expressions.

A page is a string column.  One pattern reads it as a sequence of comments,
script and style elements, tags (quote-aware, so a ``>`` or ``href=`` inside a
value is part of the value) and text.  An element is cut balanced: the text is
taken apart at the tags that can end the element, and a fold over these few
pieces follows the nesting depth (``regexp_extract_all`` + ``aggregate``).
Records become arrays and are exploded afterwards.  All of it stays in the
JVM; every repeated group is possessive, which the regular-expression engine
runs in a loop, so long inputs neither recurse nor backtrack.

Attribute and element names are read in any case; attributes count in any
order and quoting, the first of a name wins.  An element that no end tag
closes ends with its parent, a list item, cell, row or paragraph also before
the next one; what is left open ends with the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.text import unescape_sql
from pageloom.functions.util import applied, bound, col_of, quoted, texts_of

# --- patterns ----------------------------------------------------------------

# a "<" outside quotes ends a tag that has no ">": what begins there is read anew,
# so that every character is looked at a bounded number of times
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s<>]++)?+"""
_ATTR = rf"(?:=?+[^\s/<>=]++|=)(?:\s*+=\s*+{_VALUE})?+"
_REST = rf"(?:[\s/]++|{_ATTR})*+>"
_NAME = r"[A-Za-z][^\s/<>]*+"
_TAG = rf"</?{_NAME}{_REST}"
_COMMENT = r"<!--(?:[\s\S]*?-->|[\s\S]*+)"
_RAW = rf"<(script|style|textarea|title)(?=[\s/>]){_REST}(?:[\s\S]*?(?=</\1[\s/>])|[\s\S]*+)"
_OTHER = r"<[!?][^>]*+>?+|</(?![A-Za-z])[^>]*+>?+"
_TEXT = r"(?:[^<]++|<(?![A-Za-z!?/]))++"
TOKEN_RE = rf"(?i){_COMMENT}|{_RAW}|{_TAG}|{_OTHER}|{_TEXT}|<"
START_TAG_RE = rf"(?i)\A<{_NAME}{_REST}"

#: Elements without content (fixed values of the language).
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
_BLOCKS = ("address", "article", "aside", "blockquote", "dd", "div", "dl", "dt", "fieldset", "footer", "form", "h1", "h2", "h3",
           "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "pre", "section", "table", "tbody", "td", "th", "tr", "ul")
#: Elements whose end tag may be left out: tag -> (what holds them, what else ends them).
_IMPLIED = {"li": (("ul", "ol"), ()), "td": (("table",), ("th", "tr")), "th": (("table",), ("td", "tr")),
            "tr": (("table",), ("tbody", "thead", "tfoot")), "dt": (("dl",), ("dd",)), "dd": (("dl",), ("dt",)), "p": ((), _BLOCKS)}

# first text node of the first heading / of each paragraph
H1_TEXT_RE = r"(?i)<h1\b[^>]*>([^<]*)"
P_TEXT_RE = r"(?i)<p\b[^>]*>([^<]*)"


# --- attributes --------------------------------------------------------------

def _up_to(attr: str) -> str:
    """Pattern of the attributes before the first one named ``attr``."""
    return rf"(?:[\s/]++|(?!{attr}[\s/>=]){_ATTR})*+{attr}"


def _attribute_re(name: str) -> str:
    value = r"""["']?+((?<=")[^"]*+|(?<=')[^']*+|[^\s<>]*+)"""
    return rf"(?i)\A<{_NAME}{_up_to(name)}\s*+=\s*+{value}"


def attribute(tag, name: str) -> Column:
    """Value of an attribute of the start tag that ``tag`` begins with, as
    written; ``''`` when it has none."""
    return F.regexp_extract(col_of(tag), _attribute_re(name), 1)


@dataclass(frozen=True)
class Element:
    """Which elements are meant: a tag (``*``: any) and what its attributes
    must be: ``("class", "x")`` equal, ``("class^", "x")`` beginning so."""
    tag: str
    where: tuple[tuple[str, str], ...] = ()

    def pattern(self) -> str:
        """Matches, without reading it, a start tag that is meant."""
        name = _NAME if self.tag == "*" else rf"{self.tag}(?=[\s/>])"
        tests = "".join(
            rf"(?=<{name}{_up_to(a.rstrip('^'))}\s*+=\s*+" + (
                rf"(?:[\"']?(?-i:\Q{v}\E)))" if a.endswith("^") else
                rf"(?:\"(?-i:\Q{v}\E)\"|'(?-i:\Q{v}\E)'|(?-i:\Q{v}\E)(?=[\s>])))") for a, v in self.where)
        return rf"{tests}(?=<{name}{_REST})"


# --- tidy markup ---------------------------------------------------------------

# Elements that hold text alone and, with it, end nothing unsaid; all tags closed,
# attributes in double quotes.  Tables of rows of such cells, one inside another at
# most, are cut by a pattern; all other markup by the folds, with the same result.
_QUOTED = r"""(?:\s++[A-Za-z][A-Za-z0-9_-]*+="[^"<>]*+")*+\s*+>"""
_INLINE = ("a", "b", "em", "font", "i", "small", "span", "strong", "sub", "sup", "u")
_PLAIN = rf"<br{_QUOTED}|<(?:{'|'.join(rf'{n}{_QUOTED}[^<]*+</{n}' for n in _INLINE)})>"


def _tidy_table(inside: str) -> tuple[str, str, str]:
    """Patterns of a cell that holds text, plain elements and ``inside``, of a row, of a table."""
    cell = rf"<td{_QUOTED}(?:[^<]++|{_PLAIN}{inside})*+</td>"
    row = rf"<tr{_QUOTED}\s*+(?:{cell}\s*+)*+</tr>"
    return cell, row, rf"<table{_QUOTED}\s*+(?:{row}\s*+)*+</table>"


_CELL, _ROW, _TABLE = _tidy_table("|" + _tidy_table("")[2])
#: What is asked of a fragment: (the parts it must consist of, the parts to cut).
_TIDY_ELEMENTS = {("tr", 1): (rf"{_TABLE}|\s++", _ROW), ("td", 0): (rf"{_ROW}|\s++", _CELL), ("table", 0): (rf"{_CELL}|\s++", _TABLE)}
_TIDY_CHILDREN = {("table", 0): (rf"[^<]++|{_PLAIN}|{_TABLE}", _TABLE)}


def _tidy(fragment: str, patterns: tuple[str, str] | None, found: str) -> str:
    if patterns is None:
        return found
    parts, cut = patterns
    return (f"if(rlike({fragment}, {quoted(rf'(?i)\A(?:{parts})*+\z')}), "
            f"regexp_extract_all({fragment}, {quoted(rf'(?i){cut}')}, 0), {found})")


# --- elements ----------------------------------------------------------------

_HEAD_RE = r"\A<(/?[A-Za-z][^\s/>]*)"


def _pieces(html: str, names: str) -> str:
    """The text cut before every tag whose name is one of ``names`` (SQL of
    names joined by ``|``); all pieces together are the text."""
    tag = f"{quoted('</?(?:')}, {names}, {quoted(rf')(?=[\s/>]){_REST}')}"
    rest = quoted(rf")(?:{_RAW}|{_TAG})|{_OTHER}|{_TEXT}|(?!")
    return (f"regexp_extract_all({html}, concat({quoted('(?i)(?:')}, {tag}, {quoted(rf')?+(?:{_COMMENT}|(?!')}, {tag}, {rest}, {tag}, "
            f"{quoted(')<)*+')}), 0)")


def _head(piece: str) -> str:
    """``/li`` of a piece that begins with ``</LI ...>``; ``''`` without a tag."""
    return f"lower(regexp_extract({piece}, {quoted(_HEAD_RE)}, 1))"


def _note(at: str, stop: str, tail: str = "0", level: str = "0") -> str:
    """A found span as text: a fold appends to a text cheaply, to an array not."""
    return f"concat(lpad(cast({at} as string), 10, '0'), ',', {stop}, ',', cast({tail} as int), ',', {level}, ';')"


def _noted(notes: str) -> str:
    """The spans of :func:`_note`, by their begin."""
    fields = ", ".join(f"'{c}', cast(cells[{i}] as int)" for i, c in enumerate(("at", "stop", "tail", "level")))
    rows = f"sort_array(filter(split({notes}, ';'), note -> note <> ''))"
    return f"transform(transform({rows}, note -> split(note, ',')), cells -> named_struct({fields}))"


def _spans(pieces: str, element: Element, tag: str, known: str | None) -> str:
    """Where the elements that are meant begin and stop, in pieces; ``tail``:
    their end tag begins the piece where they stop."""
    holders, others = _IMPLIED.get(known, ((), ()))
    implied = known in _IMPLIED
    opens = f"array_contains({texts_of(holders or ('-',))}, h)" if implied else f"h = {tag}"
    leaves = f"array_contains({texts_of(['/' + x for x in holders] or ['-'])}, h)" if implied else f"h = concat('/', {tag})"
    parts = f"(h = {tag} or array_contains({texts_of([x + o for o in others for x in ('', '/')] or ['-'])}, h))" if implied else "false"
    kind = bound(_head("p"), "h", f"named_struct('meant', h = {tag} and rlike(p, {quoted(rf'(?i)\A{element.pattern()}')}), "
                 f"'ends', h = concat('/', {tag}), 'holds', {opens}, 'leaves', {leaves}, 'parts', {parts})")
    inside = "cast(case when k.holds then acc.level + 1 when k.leaves then greatest(acc.level - 1, 0) else acc.level end as int)"
    # what is open at this depth ends here, unless this only opens something inside it
    stops = "(k.leaves or k.ends or k.parts)"
    done = f"array_join(transform(filter(acc.open, e -> e.level >= acc.level), e -> {_note('e.at', 'acc.i', 'k.ends', 'e.level')}), '')"
    still = f"if({stops}, filter(acc.open, e -> e.level < acc.level), acc.open)"
    state = "struct<i:int,level:int,open:array<struct<level:int,at:int>>,done:string>"
    step = (f"named_struct('i', acc.i + 1, 'level', {inside}, 'open', "
            f"if(k.meant, concat({still}, array(named_struct('level', {inside}, 'at', acc.i))), {still}), "
            f"'done', if({stops}, concat(acc.done, {done}), acc.done))")
    rest = f"array_join(transform(acc.open, e -> {_note('e.at', 'acc.i', '0', 'e.level')}), '')"
    return (f"aggregate(transform({pieces}, p -> {kind}), cast(named_struct('i', 0, 'level', 0, 'open', array(), 'done', '') as {state}), "
            f"(acc, k) -> cast({step} as {state}), acc -> {_noted(f'concat(acc.done, {rest})')})")


def _cut(html: str, element: Element, tag: str, known: str | None) -> str:
    """SQL of ``array<struct<html, level>>`` of all elements that are meant, in
    order; ``known`` is the tag's name where it doesn't depend on the row."""
    holders, others = _IMPLIED.get(known, ((), ()))
    names = quoted("|".join((known, *holders, *others))) if known else tag
    end = f"if(s.tail = 1, regexp_extract(pieces[s.stop], {quoted(r'\A</[^>]*+>')}, 0), '')"
    found = (f"transform({_spans('pieces', element, tag, known)}, s -> named_struct('html', "
             f"concat(array_join(slice(pieces, s.at + 1, s.stop - s.at), ''), {end}), 'level', s.level - {0 if known in _IMPLIED else 1}))")
    return bound(_pieces(html, names), "pieces", found)


def elements(html, element: Element, level: int | None = None) -> Column:
    """``array<string>``: every element that is meant, from its start tag to
    its end tag, in the order of the start tags; with ``level`` only those
    inside so many elements of the kind that holds them (tables around rows
    and cells, lists around items, others of its tag around any other)."""
    found = _cut("html", element, quoted(element.tag), element.tag)
    if level is not None:
        found = f"filter({found}, found -> found.level = {level})"
    found = f"transform({found}, found -> found.html)"
    if element.where:
        # a page without the values has no such element
        values = " and ".join(f"contains(html, {quoted(v)})" for _, v in element.where)
        found = f"if(not ({values}), cast(array() as array<string>), {found})"
    else:
        found = _tidy("html", _TIDY_ELEMENTS.get((element.tag, level)), found)
    return applied(col_of(html), "html", found)


def whole(found: Column) -> Column:
    """Elements one after the other, as one fragment: so those inside all of
    them are read at once, at a level one deeper."""
    return F.array_join(found, "")


def block(html, tag: str, attr: str | None = None, value: str | None = None, prefix: bool = False, inner: bool = False) -> Column:
    """EXT-3: raw HTML of the first matching element (markup kept), nested
    ones of its tag included; ``''`` when there is none.  ``tag`` may be
    ``*``.  ``inner`` returns the content without the tag itself."""
    where = () if attr is None else ((attr + ("^" if prefix else ""), value),)
    return first_element(html, Element(tag, where), inner)


def first_element(html, element: Element, inner: bool = False) -> Column:
    """The first element that is meant (``''``: none)."""
    if element.tag == "*":
        # the first start tag that is meant names the tag whose nesting counts
        start = element.pattern()
        skipped = rf"(?i)\A(?:{_COMMENT}|(?!{start})(?:{_RAW}|{_TAG})|{_OTHER}|{_TEXT}|(?!{start})<)*+"
        name = f"lower(regexp_extract(html, {quoted(r'\A<([A-Za-z][A-Za-z0-9:_-]*)')}, 1))"
        rest = f"substr(page, length(regexp_extract(page, {quoted(skipped)}, 0)) + 1)"
        found = bound(rest, "html", bound(name, "tag", f"try_element_at({_cut('html', element, 'tag', None)}, 1).html"))
    else:
        found = bound("page", "html", f"try_element_at({_cut('html', element, quoted(element.tag), element.tag)}, 1).html")
    found = f"coalesce({found}, if(page is not null, '', null))"
    return applied(col_of(html), "page", bound(found, "whole", _content("whole")) if inner else found)


def _content(e: str) -> str:
    name = f"lower(regexp_extract({e}, {quoted(r'\A<([A-Za-z][^\s/>]*)')}, 1))"
    last = f"lower(regexp_extract({e}, {quoted(r'</([A-Za-z][^\s/>]*+)[^<>]*+>\z')}, 1))"
    inside = f"regexp_replace({e}, {quoted(START_TAG_RE)}, '')"
    return f"if({name} <> '' and {name} = {last}, regexp_replace({inside}, {quoted(r'</[A-Za-z][^<>]*+>\z')}, ''), {inside})"


def content(element) -> Column:
    """What an element has between its start tag and its end tag."""
    return applied(col_of(element), "whole", _content("whole"))


# --- children ----------------------------------------------------------------

def _walk(fragment: str, start: str, kept: str, step: str, finish: str) -> str:
    """SQL of a fold over the tokens of a fragment.  ``step`` makes the new
    ``acc.out`` from the token ``k`` (``text``, ``head``, ``words``: whether it
    is text), its place ``acc.i`` and the depths around it, ``before`` and
    ``after``: 0 is the fragment's own level.  ``finish`` makes the result
    from ``acc.out`` and ``tokens``; ``kept`` is the type of ``out``.

    The open elements are one text (``>table>tr>``), not an array: most tokens
    leave it as it is, and a fold copies a text faster."""
    empty = quoted(r"""[\s"']/>\z|\A<[A-Za-z0-9]+/>\z""")

    def one_of(names: tuple[str, ...]) -> str:
        return f"h in ({', '.join(map(quoted, names))})"

    opens = f"h <> '' and not startswith(h, '/') and not ({one_of(VOID)}) and not (endswith(t, '/>') and rlike(t, {empty}))"
    kind = bound(f"if(startswith(t, '<'), {_head('t')}, '')", "h", f"named_struct('text', t, 'head', h, 'closes', startswith(h, '/'), 'opens', {opens}, "
                 f"'block', {one_of((*_BLOCKS, 'p'))}, 'words', not startswith(t, '<') or rlike(t, {quoted(r'\A<(?![A-Za-z!?/])')}))")

    def unless_held(own: str, holders: str) -> str:
        """Place of the innermost open ``own`` unless one of ``holders`` is open inside it."""
        held = quoted(rf"(?s)>(?:{own})>(?!(?:[^>]*>)*?(?:{holders})>)")
        above = f"regexp_extract(acc.stack, {quoted(rf'(?s)\A(.*>)(?:{own})>')}, 1)"
        return f"if(rlike(acc.stack, {held}), {_names(above)}, acc.depth)"

    # what a tag ends that has no end tag of its own; an end tag ends what is inside its element
    before = (f"cast(case when k.closes or not k.opens and not k.block then acc.depth when k.head = 'li' then {unless_held('li', 'ul|ol')} "
              f"when k.head in ('td', 'th') then {unless_held('td|th', 'table')} when k.head = 'tr' then {unless_held('tr', 'table')} "
              f"when k.head in ('dt', 'dd') then {unless_held('dt|dd', 'dl')} "
              f"when endswith(acc.stack, '>p>') and k.block or endswith(acc.stack, '>a>') and k.head = 'a' then acc.depth - 1 else acc.depth end as int)")
    inside = "substring_index(acc.stack, concat('>', substr(k.head, 2), '>'), -1)"
    after = (f"cast(case when k.opens then before + 1 when not k.closes then before "
             f"when contains(acc.stack, concat('>', substr(k.head, 2), '>')) then acc.depth - 2 - {_names(inside)} else acc.depth end as int)")
    below = "if({0} = acc.depth, acc.stack, concat(substring_index(acc.stack, '>', {0} + 1), '>'))"
    stack = f"if(k.opens, concat({below.format('before')}, k.head, '>'), {below.format('after')})"
    state = f"struct<i:int,depth:int,stack:string,out:{kept}>"
    merged = f"cast(named_struct('i', acc.i + 1, 'depth', after, 'stack', {stack}, 'out', {step}) as {state})"
    fold = (f"aggregate(tokens, cast(named_struct('i', 0, 'depth', 0, 'stack', '>', 'out', {start}) as {state}), "
            f"(acc, k) -> {bound(before, 'before', bound(after, 'after', merged))}, acc -> {finish})")
    return bound(f"transform(regexp_extract_all({fragment}, {quoted(TOKEN_RE)}, 0), t -> {kind})", "tokens", fold)


def _names(stack: str) -> str:
    """How many names a part of the open elements' text that begins with ``>`` holds."""
    return f"(length({stack}) - length(replace({stack}, '>', '')) - 1)"


def children(fragment, tag: str, level: int = 0) -> Column:
    """``array<string>``: the elements ``tag`` on the fragment's own level,
    whole, or on one so many elements deeper."""
    begins = f"(before = {level} and k.head = {quoted(tag)})"
    # an open one stops before what begins on its level, or with its end tag
    cut_off, closed = f"(acc.out.at >= 0 and before <= {level})", f"((acc.out.at >= 0 or {begins}) and after <= {level})"
    noted = (f"case when {cut_off} then concat(acc.out.done, {_note('acc.out.at', 'acc.i')}) "
             f"when {closed} then concat(acc.out.done, {_note(f'if({begins}, acc.i, acc.out.at)', 'acc.i + 1')}) else acc.out.done end")
    left = f"case when {begins} and after > {level} then acc.i when {cut_off} or {closed} then -1 else acc.out.at end"
    rest = f"if(acc.out.at >= 0, {_note('acc.out.at', 'size(tokens)')}, '')"
    finish = (f"transform({_noted(f'concat(acc.out.done, {rest})')}, "
              "s -> array_join(transform(slice(tokens, s.at + 1, s.stop - s.at), token -> token.text), ''))")
    found = _walk("fragment", "named_struct('at', -1, 'done', '')", "struct<at:int,done:string>",
                  f"named_struct('at', {left}, 'done', {noted})", finish)
    return applied(col_of(fragment), "fragment", _tidy("fragment", _TIDY_CHILDREN.get((tag, level)), found))


#: Elements whose own texts are told by a pattern where nothing but plain elements is among them.
_OUTER = ("td", "th", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6")


def _plain_re(level: int) -> str:
    """Fragments whose direct texts on a level (0, 1) need no account of what is open."""
    texts = rf"(?:[^<]++|{_PLAIN})*+"
    return rf"(?i)\A{texts}\z" if level == 0 else rf"(?i)\A(?:<(?:{'|'.join(rf'{n}{_QUOTED}{texts}</{n}' for n in _OUTER)})>)*+\z"


def _direct_texts(fragment: str, level: int) -> str:
    step = f"if(before = {level} and k.words, concat(acc.out, acc.i, ' '), acc.out)"
    finish = "transform(filter(split(acc.out, ' '), place -> place <> ''), place -> tokens[cast(place as int)].text)"
    found = _walk(fragment, "''", "string", step, finish)
    if level < 2:
        texts = f"filter(regexp_extract_all({fragment}, {quoted(rf'(?i)([^<]++)|{_PLAIN}|<[^>]*+>')}, 1), text -> text <> '')"
        found = f"if(rlike({fragment}, {quoted(_plain_re(level))}), {texts}, {found})"
    return f"transform({found}, text -> {unescape_sql('text')})"


def direct_texts(fragment, level: int = 0) -> Column:
    """``array<string>``: the text nodes on the fragment's own level (or so
    many elements deeper), entities decoded; the text of elements on that
    level is not among them."""
    return applied(col_of(fragment), "fragment", _direct_texts("fragment", level))


def _first_direct_text(f: str) -> str:
    return f"if(contains({f}, '<'), coalesce(try_element_at({_direct_texts(f, 0)}, 1), ''), {unescape_sql(f)})"


def first_direct_text(fragment) -> Column:
    """First direct text node of an element's content (``text()[1]``),
    entities decoded; ``''`` when there is none."""
    return applied(col_of(fragment), "fragment", _first_direct_text("fragment"))


def anchors(fragment) -> Column:
    """EXT-1: every ``<a>`` of a fragment as ``array<struct<href,text>>``: the
    ``href`` attribute and the first direct text node (``''`` when absent),
    entities decoded.  Anchors do not nest: one that is not closed ends at the
    next."""
    found = f"filter({_pieces('html', quoted('a'))}, piece -> rlike(piece, {quoted(rf'(?i)\A<a(?=[\s/>]){_REST}')}))"
    href = bound(f"regexp_extract(piece, {quoted(_attribute_re('href'))}, 1)", "href", unescape_sql("href"))
    text = bound(f"regexp_replace(piece, {quoted(START_TAG_RE)}, '')", "said", _first_direct_text("said"))
    return applied(col_of(fragment), "html", f"transform({found}, piece -> named_struct('href', {href}, 'text', {text}))")


def first_group(fragment, pattern: str) -> Column:
    """First capture of a pattern, ``''`` when absent."""
    return F.regexp_extract(col_of(fragment), pattern, 1)


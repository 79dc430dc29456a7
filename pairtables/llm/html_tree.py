"""HTML as a stream of tags and texts, and union-free expressions over its elements."""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style template noscript iframe svg math textarea title".split())
#: Elements that hold no main text.
OUTSIDE = RAW | frozenset("head nav header footer aside form button select menu dialog".split())
#: Parts of a class or id of a container that say so by themselves.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comments consent cookie cookies disqus "
    "masthead modal nav navbar navigation newsletter popup promo sidebar sponsored subscribe toolbar widget".split()
)
#: Those that say so as a whole class, or before or after one of the second list, as in ``share-bar``.
OUTSIDE_NAMES = frozenset(
    "comment footer header menu notice related reply replies respond share sharing social sponsor".split()
)
STRUCTURE = frozenset(
    "area bar block body box buttons container form icons item links list main page section site thread top wrapper".split()
)
#: Text elements hold main text unless a whole class is one of these, alone or before one of the list above.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption".split())
OUTSIDE_TEXTS = frozenset("ad ads advert adverts advertisement sponsored cookie consent newsletter promo".split())
#: Elements whose class and id say nothing on that; of an article only that it is a reader's.
WHOLE = frozenset("html body main".split())
READERS = frozenset("comment comments reply replies response comment-body comment-item comment-content".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A start tag of the second kind closes an open element of the first inside the same parent.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
#: Where the search for an element to close ends.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
MAX_DEPTH = 60

#: A quote opens a value only after an equals sign.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?", re.S)
#: White space of any script, line breaks of any kind and no-break spaces.
_SPACE = re.compile(r"\s+")


def _is_outside(name: str, value: str) -> bool:
    """Whether a class or id of an element names it as something else than main text."""
    if name in WHOLE:
        return False
    for whole in value.split():
        if name == "article":
            if whole in READERS:
                return True
            continue
        parts = re.split(r"[^a-z0-9]+", whole)
        known = OUTSIDE_TEXTS if name in TEXTS else OUTSIDE_NAMES
        if whole in known or len(parts) == 2 and (parts[0] in known and parts[1] in STRUCTURE | {"notice", "banner"}):
            return True
        if name in TEXTS:
            continue
        if OUTSIDE_WORDS.intersection(parts) or len(parts) == 2 and parts[1] in known and parts[0] in STRUCTURE:
            return True
    return False


class Element:
    __slots__ = ("name", "key", "outside")

    def __init__(self, name: str, rest: str):
        self.name, self.key = name, name
        self.outside = name in OUTSIDE
        for m in _ATTRIBUTE.finditer(rest) if rest and "=" in rest else ():
            kind = m[1].lower()
            if kind not in ("class", "id", "role"):
                continue
            value = (m[2] or m[3] or m[4] or "").lower()
            if kind == "role":
                self.outside = self.outside or value in OUTSIDE_ROLES
                self.key += "@main" if value == "main" else ""
            else:
                self.outside = self.outside or _is_outside(name, value)
                if not any(c.isdigit() for c in value):
                    self.key += "." + ".".join(sorted(value.split()))


def stream(html: str | None) -> Iterator[tuple[str, list[Element], str]]:
    """(kind, open elements, text) with kind ``open``, ``close`` or ``text``. What a page leaves
    open is closed at its end; an end tag without a start is passed over."""
    html, at, stack = html or "", 0, []
    while True:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            yield "text", stack, entities.unescape(text)
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            if any(e.name == name for e in stack):
                while True:
                    yield "close", stack, ""
                    if stack.pop().name == name:
                        break
            continue
        yield from _implied(stack, name)
        stack.append(Element(name, m["rest"]))
        yield "open", stack, ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else len(html)
        elif name in VOID or m["rest"].rstrip().endswith("/") and name not in ("p", "div"):
            yield "close", stack, ""
            stack.pop()
    while stack:
        yield "close", stack, ""
        stack.pop()


def _implied(stack: list[Element], name: str) -> Iterator[tuple[str, list[Element], str]]:
    closes = []
    if name not in INLINE and name not in VOID - {"hr"}:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name == "p":
                closes.append(i)
                break
            if stack[i].name not in INLINE:
                break
    for own, by in CLOSED_BY.items():
        if name in by:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == own:
                    closes.append(i)
                    break
                if stack[i].name in SCOPES[own]:
                    break
    if closes:
        while len(stack) > min(closes):
            yield "close", stack, ""
            stack.pop()


# Expressions: [key, times, parts]; times is 1, ?, + or *; a text slot has the key "#". On a page
# that names no main element a slot has two more entries: the names of its texts, and how many
# distinct pages they are on, all of them.


def _text_name(text: str) -> int:
    return zlib.crc32(_SPACE.sub(" ", text).strip().encode("utf-8", "surrogatepass"))


def expression(html: str | None) -> str:
    """A page's element structure with its repeated groups folded, as JSON."""
    top: list = ["", "1", []]
    path, depth, named, slots = [top], 0, False, []
    for kind, stack, text in stream(html):
        if kind == "text":
            last = path[-1][2][-1] if path[-1][2] else None
            if last is not None and last[0] == "#":
                last[3].append(text)
            elif text.strip():
                path[-1][2].append(["#", "1", [], [text], 1])
                slots.append(path[-1][2][-1])
        elif stack[-1].name in INLINE or stack[-1].name in RAW:
            continue
        elif kind == "open":
            depth += 1
            named = named or _is_main(stack[-1].key) > 0
            if depth <= MAX_DEPTH:
                part = [stack[-1].key, "1", []]
                path[-1][2].append(part)
                path.append(part)
        else:
            if depth <= MAX_DEPTH:
                path.pop()
            depth -= 1
    for slot in slots:  # constant text is kept only where it may have to choose the main text
        slot[3:] = [] if named else [[_text_name("".join(slot[3]))], 1]
    _fold_all(top)
    return json.dumps(top[2], separators=(",", ":"), ensure_ascii=False)


def _fold_all(top: list) -> None:
    """Fold the parts of every element, inner ones first."""
    order = [top]
    for part in order:
        order += part[2]
    for part in reversed(order):
        part[2] = _folded(part[2])


def _times(a: str, b: str) -> str:
    some, many = "?" in a + b or "*" in a + b, "+" in a + b or "*" in a + b
    return "*" if some and many else "+" if many else "?" if some else "1"


def _more(times: str) -> str:
    return "*" if times in "?*" else "+"


def _maybe(part: list) -> list:
    return [part[0], _times(part[1], "?"), *part[2:]]


def _merged(a: list, b: list, pages: bool = False) -> list:
    """One part for two: of one page (a repeat, which has the texts of both), or of different ones
    (a constant text is on all of them)."""
    out = [a[0], _times(a[1], b[1]), aligned(a[2], b[2], pages)]
    if len(a) > 3 and len(b) > 3:
        both = set(a[3]) & set(b[3]) if pages else set(a[3]) | set(b[3])
        return [*out, sorted(both), a[4] + b[4] if pages else max(a[4], b[4])]
    return [*out, *(a[3:] or b[3:])]


def _folded(parts: list) -> list:
    """Turn adjacent equal elements, and adjacent equal runs of two or three, into repeats."""
    out: list = []
    for part in parts:
        if out and out[-1][0] == part[0]:
            last = _merged(out[-1], part)
            out[-1] = [last[0], _more(last[1]), *last[2:]]
        else:
            out.append(part)
    for width in (2, 3):
        i, kept = 0, []
        while i < len(out):
            run, n = out[i : i + width], 1
            keys = [p[0] for p in run]
            while len(run) == width and [p[0] for p in out[i + n * width : i + (n + 1) * width]] == keys:
                run = [_merged(a, b) for a, b in zip(run, out[i + n * width : i + (n + 1) * width])]
                n += 1
            if n > 1:
                kept.append(["(" + "|".join(keys) + ")", "+", run])
                i += n * width
            else:
                kept.append(out[i])
                i += 1
        out = kept
    return out


def aligned(a: list, b: list, pages: bool = False) -> list:
    """One union-free expression for both: what is in one of them only becomes optional."""
    ka, kb, out = [p[0] for p in a], [p[0] for p in b], []
    if ka == kb:
        return [_merged(x, y, pages) for x, y in zip(a, b)]
    for op, i, j, k, m in SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes():
        if op == "equal":
            out += [_merged(x, y, pages) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [_maybe(p) for p in a[i:j]] + [_maybe(p) for p in b[k:m]]
    return _folded(out)


def align_all(expressions: list[str]) -> str:
    """Align one after another, in a fixed order."""
    wrapper: list | None = None
    for text in sorted(expressions):
        other = json.loads(text)
        wrapper = other if wrapper is None else aligned(wrapper, other, pages=True)
    return json.dumps(wrapper or [], separators=(",", ":"), ensure_ascii=False)


def _is_main(key: str) -> int:
    name = key.split(".")[0]
    if name == "article":
        return 3
    if name == "main" or "@main" in key:
        return 2
    words = set(re.split(r"[^a-z0-9]+", key.partition(".")[2]))
    return 1 if words & {"article", "content", "entry", "main", "post", "story"} else 0


def _outside_key(key: str) -> bool:
    name, _, words = key.partition(".")
    return name in OUTSIDE or _is_outside(name, words.replace(".", " "))


def constants(wrapper: str) -> list[str]:
    """Texts that are no slots: ``path#name`` of those that two distinct pages or more have at a
    place, all that have the place. They are template text where pages name no main element."""
    found = set()
    stack = [(p, "") for p in json.loads(wrapper)]
    while stack:
        part, above = stack.pop()
        if part[0] == "#":
            if len(part) > 3 and part[4] > 1:
                found |= {f"{above}#{name}" for name in part[3]}
            continue
        path = above if part[0].startswith("(") else f"{above}/{part[0]}"
        stack += [(p, path) for p in part[2]]
    return sorted(found)


def main_paths(wrapper: str) -> list[str]:
    """Where the wrapper has its main text: paths (keys joined by ``/``) of the elements of each
    kind (article, main, an element named for content) with a text slot in them, best kind first."""
    found: set[tuple[int, str]] = set()

    def slots(part: list) -> bool:
        return part[0] == "#" or not _outside_key(part[0]) and any(slots(p) for p in part[2])

    stack = [(p, "") for p in reversed(json.loads(wrapper))]
    while stack:
        part, above = stack.pop()
        if part[0] == "#" or not part[0].startswith("(") and _outside_key(part[0]):
            continue
        path = above if part[0].startswith("(") else f"{above}/{part[0]}"
        kind = 0 if part[0].startswith("(") else _is_main(part[0])
        if kind and slots(part):
            found.add((-kind, path))
        stack += [(p, path) for p in reversed(part[2])]
    # Of nested ones of a kind the outer.
    outer = [(k, p) for k, p in found if not any(k == j and p.startswith(q + "/") for j, q in found)]
    return [p for _, p in sorted(outer)]


def main_text(html: str | None, paths: list[str], fixed: list[str] | tuple = ()) -> str:
    """The blocks of the elements at ``paths`` of the best kind that the page reaches, or, where
    the page has none of them, of the page less ``fixed``, its host's constant texts. A main
    element that holds all of the page's articles counts before them: what follows an article in
    it is main text too. Elements below ``MAX_DEPTH``, which no path tells, are known by their own
    name."""
    wanted, best, apart = set(paths), 0, False
    blocks: dict[int, list[tuple[str, str]]] = {}
    block: dict[int, list[str]] = {}
    place = ""

    def end() -> None:
        for k, own in block.items():
            blocks.setdefault(k, []).append((place, "".join(own)))

    for kind, stack, text in stream(html):
        if kind == "text":
            if not any(e.outside for e in stack):
                kinds, path = _reached(stack, wanted)
                if text.strip():
                    best = max(best, *kinds)
                    apart = apart or 3 in kinds and 2 not in kinds
                for k in kinds:
                    block.setdefault(k, []).append(text)
                place = path
        elif stack[-1].name == "br":
            for own in block.values():
                own.append(" ")
        elif stack[-1].name not in INLINE:
            end()
            block = {}
    end()
    if best == 3 and not apart:
        best = 2
    texts = [(at, _SPACE.sub(" ", b).strip()) for at, b in blocks.get(best, ())]
    known = set(fixed) if not best else ()
    return "\n\n".join(t for at, t in texts if t and not (known and f"{at}#{_text_name(t)}" in known))


def _reached(stack: list[Element], wanted: set[str]) -> tuple[set[int], str]:
    """Kinds of the main elements around a text, and 0 for the page; and the text's path."""
    path, depth, kinds = "", 0, {0}
    for e in stack:
        if e.name not in INLINE:
            path, depth = f"{path}/{e.key}" if depth < MAX_DEPTH else path, depth + 1
            if depth > MAX_DEPTH or path in wanted:
                kinds.add(_is_main(e.key))
    return kinds, path

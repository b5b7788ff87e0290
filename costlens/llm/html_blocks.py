"""HTML pages as a sequence of text blocks with their tag paths."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

# Elements whose content is raw text up to their end tag and no text of the page.
_RAW = frozenset("script style textarea title iframe".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in _RAW}
# Elements that do not end a block.
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr "
    # Formulas are read as part of their line.
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split())
# Elements that stand in a line; they end a block only where text is in them.
_IN_LINE = frozenset("svg object canvas video audio select noscript template".split())
# Elements of svg whose content is HTML again.
_HTML_IN_SVG = frozenset("foreignobject desc".split())
# Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end an open element of the same kind.
_SIBLINGS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
             "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Elements that an open paragraph cannot hold.
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "pre section table ul".split())
# Elements that cannot be inside of svg.
_ENDS_SVG = _ENDS_P | frozenset("body p li dt dd tr td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^\"'<>]|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(?P<odd>/?[a-zA-Z][a-zA-Z0-9:-]*)[^<>]*>", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|data-y)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)


# Slots of the tag-path vector.
PATH_DIM = 256


def _slot(word: str) -> int:
    return 1 << zlib.crc32(word.encode("utf-8", "surrogatepass")) % PATH_DIM


@lru_cache(maxsize=1 << 14)
def _own_slots(names: str) -> tuple[int, int]:
    """Slots, as bits, of an element's tag and words, and of its tag as the innermost one."""
    tag, *rest = names.split(" ")
    own = _slot("<" + tag)
    for w in rest:
        own |= _slot(w)
    return own, _slot("<<" + tag)


class Path:
    """An element with a link to the one around it, so that blocks share what their paths have in common.

    ``slots`` are the slots of all elements of the path, as bits; ``depth``
    elements long paths take no more room than short ones.
    """

    __slots__ = ("parent", "names", "slots")

    def __init__(self, parent: Path | None, names: str):
        self.parent, self.names = parent, names
        self.slots = _own_slots(names)[0] | (parent.slots if parent else 0)

    def vector_bits(self) -> int:
        """Set positions of the path: every element's tag, the innermost one's again, and all class, id and role words."""
        return self.slots | _own_slots(self.names)[1]

    def elements(self) -> tuple[str, ...]:
        out, at = [], self
        while at:
            out.append(at.names)
            at = at.parent
        return tuple(reversed(out))


@dataclass
class Block:
    """One run of text: its innermost element, the words, how many of its characters are link text, and a label."""

    within: Path | None
    text: str
    linked: int
    label: int = 0
    tags: int = field(default=0)

    @property
    def path(self) -> tuple[str, ...]:
        return self.within.elements() if self.within else ()


def _names(tag: str, attrs: str, marked: bool) -> tuple[str, int | None]:
    """Tag with its class, id and role words, and the training label if the page is ``marked`` and one is set."""
    label, words = None, [tag]
    for name, value in _ATTR.findall(attrs) if attrs else ():
        value = value.strip("\"'").lower()
        if name.lower() == "data-y":
            if marked and value in ("0", "1"):
                label = int(value)
        else:
            words += re.split(r"[^a-z0-9]+", value)
    return " ".join(x for x in words if x), label


def blocks(page: str | None, marked: bool = True) -> list[Block]:
    """The text blocks of a page in order; character references decoded, white space turned into single spaces.

    Null and empty pages have none. Elements that are not closed end with
    their parent; stray end tags are passed over. Raw text (scripts, styles,
    titles, text fields, frames) is left out up to its end tag, or to the
    page's end as browsers do; text in any other element is kept with its path.
    The training marks data-y=0 and data-y=1 are read only where ``marked``,
    which is for composed pages. Time and memory grow with the page, however
    deep its elements are nested.
    """
    out: list[Block] = []
    stack: list[tuple[str, Path, int, bool]] = []  # tag, path, label, whether it stands in a line
    opened: dict[str, int] = {}  # open elements by tag
    context: list[int] = []  # places of open svg elements and of those in them that hold HTML
    owner: tuple | None = None  # the element of the text that waits
    path: Path | None = None
    text: list[str] = []
    linked = tags = in_link = 0
    page = page or ""

    def flush():
        nonlocal linked, tags
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            out.append(Block(path, joined, linked, owner[2] if owner else 0, tags))
        text.clear()
        linked = tags = 0

    def add(piece: str):
        nonlocal linked, owner, path
        top = stack[-1] if stack else None
        if not piece.isspace() and (not text or owner is not top):
            if owner is not top:
                if any(not x.isspace() for x in text):
                    flush()
                owner = top
            path = top[1] if top else None
        text.append(piece)
        linked += in_link * len(piece)

    def cut(at: int):
        for x in stack[at:]:
            opened[x[0]] -= 1
        while context and context[-1] >= at:
            context.pop()
        del stack[at:]

    def close(at: int):
        nonlocal in_link
        flush()
        cut(at)
        in_link = 0

    def in_svg() -> bool:
        return bool(context) and stack[context[-1]][0] == "svg"

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["odd"]
        if tag is None:
            continue
        tag = tag.lower()
        closed = m["tag"] is not None and m["attrs"].endswith("/")
        if tag in _RAW and not m["end"]:
            if not (closed and in_svg()):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if m["tag"] is None:
            continue
        if tag in _INLINE:
            tags += 1
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = 0 if m["end"] else 1
            continue
        if m["end"]:
            if not opened.get(tag):
                flush()
                continue
            i = len(stack) - 1
            while stack[i][0] != tag:
                i -= 1
            cut(i) if stack[i][3] else close(i)
            continue
        if tag in _VOID:
            flush()
            continue
        while tag in _ENDS_SVG and in_svg():
            close(context[-1])
        in_line = tag in _IN_LINE or in_svg()
        if in_line and closed and (tag == "svg" or in_svg()):
            continue
        if not in_line:
            ends = _SIBLINGS.get(tag, ()) + (("p",) if tag in _ENDS_P or tag in _SIBLINGS else ())
            while stack and stack[-1][0] in ends:
                close(len(stack) - 1)
            flush()
        names, label = _names(tag, m["attrs"], marked)
        opened[tag] = opened.get(tag, 0) + 1
        if tag == "svg" or (tag in _HTML_IN_SVG and opened.get("svg")):
            context.append(len(stack))
        stack.append((tag, Path(stack[-1][1] if stack else None, names), (stack[-1][2] if stack else 0) if label is None else label, in_line))
    if at < len(page):
        add(page[at:])
    flush()
    return out

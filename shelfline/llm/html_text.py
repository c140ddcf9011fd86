"""Main text of HTML pages by two passes of block rules.

The page is cut into blocks at block-level tags. The first pass looks at each block alone: its length,
its share of stop words, the share of its characters inside links, and the elements it stands in. It
decides for good or bad or leaves the block open. In the second pass open blocks, mostly short ones, take
the label of the nearest decided neighbours. Elements that a page marks as navigation, notices, adverts,
forms or comments are bad as a whole; where a page marks its article, open blocks are judged by their
neighbours inside it, and what stands outside is not part of the text.

Defined cases: a NULL or empty page has the empty text; broken markup is read as far as it goes, tags that
are not closed end with their parent, embedded elements at the next block, and a tag without its ``>`` ends the page; an empty table gives an
empty result. Only id, url and html are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import arrays

SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.1, 0.2
#: With a smaller share of stop words in its longer blocks a page is in a language whose stop words are not known.
NO_STOPS = 0.03
SOME_LINKS, MANY_LINKS = 0.2, 0.5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its "
    "more no not of on one or she so that the their them there they this to was we were what when which who will with you "
    "als am auf aus bei das dass dem den der des die durch ein eine einem einen einer es für hat ich im ist mit nach nicht "
    "noch oder sich sie sind über um und von vor war wie wird zu zum zur "
    "au aux avec ce ces dans de du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour qu que qui "
    "sa se ses son sont sur un une vous y "
    "al como con del el ella entre era esta este fue ha hay las lo los más me mi muy o para pero por porque se si sin sobre "
    "su sus también todo una uno ya".split()
)
# Words in class and id names of what is not the article.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "copyright disclaimer discussion disqus footer gdpr legal login menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Elements of HTML.
BAD_TAGS = frozenset("aside button dialog footer form menu nav select".split())
RAW_TAGS = frozenset("script style textarea title".split())
# Elements without text of the article; without an end tag they reach to the next block.
EMBEDDED_TAGS = frozenset("iframe math noscript object svg template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*>|[^>]*\Z)",
    re.S,
)
_MARKED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PARTS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Block:
    __slots__ = ("text", "linked", "bad", "main", "heading", "label")

    def __init__(self, text: str, linked: int, bad: bool, main: int, heading: bool) -> None:
        self.text, self.linked, self.bad, self.main, self.heading = text, linked, bad, main, heading
        self.label: bool | None = None


def _marked(name: str, rest: str, whole: bool) -> bool:
    """Whether an element's attributes say that it is not part of the article.

    ``whole``: a class or id must be such a word, not only hold one, as ``with-sidebar`` does.
    """
    for key, value in _MARKED.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            words = set(value.split() if whole else _PARTS.findall(value))
            if words & MARKS or ("header" in words and name not in ("header", "h1", "h2", "h3") and words & {"site", "page", "top"}):
                return True
        elif key == "role":
            if value in ROLES:
                return True
        elif key == "style":
            if _HIDDEN.search(value):
                return True
        elif key == "hidden" or value == "true":
            return True
    return False


def _ends(html: str, name: str) -> dict[int, int]:
    """Where elements of a name end, by the ends of their start tags; those without an end tag are left out."""
    open_, out = [], {}
    tags = rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b.*?</\1\b|<(?P<close>/?){name}(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    for tag in re.finditer(tags, html, re.I | re.S):
        if tag["close"] == "":
            if not tag[0].endswith("/>"):
                open_.append(tag.end())
        elif tag["close"] and open_:
            out[open_.pop()] = tag.end()
    return out


def blocks(html: str) -> list[Block]:
    """Blocks of a page in order. ``main``: the number of the article that a block stands in, 0 outside."""
    out: list[Block] = []
    # open elements: name, bad, article number, inside a link
    stack: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]
    pieces: list[str] = []
    linked = articles = at = 0
    ends: dict[str, dict[int, int]] = {}
    mute = False

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            _, bad, main, _ = stack[-1]
            heading = any(s[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for s in stack[-4:])
            out.append(Block(text, linked, bad, main, heading))
        pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if mute:
            return
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if stack[-1][3]:
            linked += len("".join(text.split()))

    def close(name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                if any(s[0] in BLOCK_TAGS for s in stack[i:]):
                    end_block()
                del stack[i:]
                return
            if name not in BLOCK_TAGS and stack[i][0] in BLOCK_TAGS:
                return

    while found := _TOKEN.search(html, at):
        if found.start() > at:
            add(html[at: found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if not found["rest"].endswith(">"):
            break
        if name in BLOCK_TAGS:
            mute = False
        if found["close"]:
            if name in BLOCK_TAGS:
                end_block()
            close(name)
            continue
        if name == "br":
            pieces.append(" ")
        if name in RAW_TAGS and not found["rest"].endswith("/>"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in EMBEDDED_TAGS and not found["rest"].endswith("/>"):
            if name not in ends:
                ends[name] = _ends(html, name)
            mute = mute or at not in ends[name]
            at = ends[name].get(at, at)
            continue
        if name in VOID_TAGS or found["rest"].endswith("/>"):
            if name in BLOCK_TAGS:
                end_block()
            continue
        if name in BLOCK_TAGS:
            end_block()
            if any(s[0] == "p" for s in stack[-8:]):
                close("p")
            if name == "li" and stack[-1][0] == "li":
                close("li")
        _, bad, main, link = stack[-1]
        if name in ("html", "body"):
            marked = False
        else:
            outermost = name in ("article", "main") and not bad and not main
            marked = name in BAD_TAGS or (name == "header" and not main) or _marked(name, found["rest"], outermost)
        if name in ("article", "main") and not marked:
            # an advert or menu that was never closed does not reach into the article
            if not any(s[0] in ("article", "main") and s[1] for s in stack):
                bad = False
            if not bad:
                articles += 1
                main = main or articles
        stack.append((name, bad or marked, main, link or name == "a"))
    else:
        add(html[at:])
    end_block()
    return out


def judge(page: list[Block]) -> None:
    """First pass: labels of the blocks that can be told by themselves."""
    marked = any(b.main and not b.bad for b in page)
    known = total = 0
    for b in page:
        if not b.bad and len(b.text) >= SHORT and b.linked <= SOME_LINKS * len(b.text):
            words = [w.strip(".,;:!?\"'()#*$%&|").lower() for w in b.text.split()]
            known, total = known + sum(w in STOP_WORDS for w in words), total + len(words)
    foreign = known < NO_STOPS * total
    for b in page:
        size = len(b.text)
        words = [w.strip(".,;:!?\"'()#*$%&|").lower() for w in b.text.split()]
        stops = sum(w in STOP_WORDS for w in words) / len(words)
        links = b.linked / max(1, size - len(words) + 1)
        if b.bad or links > MANY_LINKS or (marked and not b.main):
            b.label = False
        elif size < SHORT:
            if links > SOME_LINKS or (not b.main and "©" in b.text):
                b.label = False
        elif (stops >= MANY_STOPS or foreign) and size > LONG:
            b.label = True
        elif stops < FEW_STOPS and not b.main and not foreign:
            b.label = False


def inherit(page: list[Block]) -> None:
    """Second pass: open blocks take the label of the nearest decided blocks before and after them."""
    decided = [b.label for b in page]
    scope = [b.main for b in page]
    # an article's own menus and adverts say nothing about its paragraphs
    seen = [label is not None and not page[i].bad for i, label in enumerate(decided)]
    before: list[tuple[int, bool] | None] = []
    last: dict[int, tuple[int, bool]] = {}
    for i, label in enumerate(decided):
        before.append(last.get(scope[i]))
        if seen[i]:
            last[scope[i]] = (i, label)
    last.clear()
    for i in range(len(page) - 1, -1, -1):
        if decided[i] is None:
            near = [x for x in (before[i], last.get(scope[i])) if x]
            if not near:
                # nothing is decided here: the article's text, or a page of short paragraphs
                page[i].label = bool(scope[i]) or not any(decided)
            else:
                least = min(abs(i - k) for k, _ in near)
                labels = {label for k, label in near if abs(i - k) == least}
                # between good and bad, a heading goes with what follows
                page[i].label = labels.pop() if len(labels) == 1 else bool(scope[i]) or (page[i].heading and near[-1][1])
        elif seen[i]:
            last[scope[i]] = (i, decided[i])


def main_text(html: str | None) -> str:
    page = blocks(html or "")
    judge(page)
    inherit(page)
    return " ".join(b.text for b in page if b.label)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "html"):
            texts = [main_text(html) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type, url_type = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return rows.mapInArrow(run, f"page_id {id_type}, url {url_type}, text string, n_chars long")

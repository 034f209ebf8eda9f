"""Main text of web pages from flat blocks and a decision tree (operator 10).

A page is read once as a flat row of text blocks. Each block has its number of words and its link density, those of
the blocks before and after it, and marks of the containers around it. A decision tree, trained on the small labelled
table below, says which blocks are main text. Pages are independent, so the work is one pass of Arrow batches.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, table

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)
                        |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>
                        |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>
                        |<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

#: Fixed values of the markup language: elements inside a line of text, elements without text to read, elements that
#: group blocks, and elements that never have an end tag.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
SKIPPED = frozenset("script style noscript template title textarea select option button svg math iframe object "
                    "audio video canvas head".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GROUPS = frozenset("nav header footer aside form article main section div ul ol dl menu table figure details dialog "
                   "fieldset".split())
CONTENT, OUTSIDE = frozenset("article main".split()), frozenset("nav aside form footer menu dialog fieldset".split())
#: Names in class, id and role attributes of what stands around the main text.
SIDE_NAMES = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie "
                       "cookies consent disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter "
                       "notice notices popup promo promoted promotion related reply replies respond search share sharing "
                       "sidebar signup social sponsor sponsored subscribe toolbar topbar widget alert complementary "
                       "contentinfo discussion disqus recommended".split())
NOT_ITSELF = frozenset("with has no without is show hide".split())
STATES = frozenset("active aware disabled enabled hidden loaded off on open ready supported visible".split())
MAIN_NAMES = frozenset("article content entry main post story articlebody".split())

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside_main", "at_side")
#: The labelled table: FEATURES of a block (links: share of its words inside links) and whether it is main text.
LABELLED = (
    # inside the article: headings, paragraphs of any length, list items, quotations; links in running text
    ((9, 0.0, 6, 1.0, 40, 0.0, 1, 0), 1), ((6, 0.0, 3, 0.0, 80, 0.02, 1, 0), 1), ((1, 0.0, 9, 0.0, 60, 0.0, 1, 0), 1),
    ((2, 0.0, 120, 0.0, 70, 0.1, 1, 0), 1), ((60, 0.0, 9, 0.0, 90, 0.0, 1, 0), 1), ((150, 0.05, 60, 0.0, 2, 0.0, 1, 0), 1),
    ((300, 0.0, 80, 0.1, 12, 0.4, 1, 0), 1), ((25, 0.2, 40, 0.0, 30, 0.1, 1, 0), 1), ((8, 0.3, 20, 0.0, 9, 0.2, 1, 0), 1),
    ((12, 0.5, 60, 0.0, 80, 0.0, 1, 0), 1), ((5, 1.0, 90, 0.0, 70, 0.0, 1, 0), 1), ((4, 0.0, 5, 0.0, 6, 0.0, 1, 0), 1),
    ((3, 0.0, 0, 0.0, 4, 0.0, 1, 0), 1), ((40, 0.0, 0, 0.0, 0, 0.0, 1, 0), 1), ((1, 0.0, 0, 0.0, 0, 0.0, 1, 0), 1),
    ((70, 0.0, 5, 1.0, 7, 0.0, 1, 0), 1), ((20, 0.0, 6, 0.0, 8, 1.0, 1, 0), 1), ((6, 1.0, 30, 0.0, 40, 0.2, 1, 0), 1),
    # inside the article, short blocks beside short blocks, links or the page's edge
    ((1, 0.0, 8, 0.0, 1, 0.0, 1, 0), 1), ((2, 0.0, 2, 0.0, 2, 0.0, 1, 0), 1), ((3, 0.0, 1, 1.0, 2, 1.0, 1, 0), 1),
    ((4, 0.0, 7, 1.0, 3, 0.0, 1, 0), 1), ((5, 0.0, 4, 0.0, 6, 1.0, 1, 0), 1), ((6, 0.0, 40, 0.0, 1, 0.0, 1, 0), 1),
    ((7, 0.0, 3, 0.0, 9, 0.0, 1, 0), 1), ((8, 0.0, 12, 0.0, 0, 0.0, 1, 0), 1), ((2, 0.0, 30, 0.0, 5, 1.0, 1, 0), 1),
    ((9, 0.0, 8, 1.0, 7, 0.0, 1, 0), 1), ((11, 0.0, 2, 0.0, 4, 1.0, 1, 0), 1), ((1, 0.0, 1, 0.0, 0, 0.0, 1, 0), 1),
    ((3, 0.0, 5, 0.0, 3, 0.0, 1, 0), 1), ((7, 0.1, 6, 1.0, 3, 0.0, 1, 0), 1), ((6, 0.0, 4, 0.0, 2, 0.0, 1, 0), 1),
    ((2, 0.5, 3, 0.0, 4, 0.0, 1, 0), 1), ((4, 0.0, 5, 0.0, 3, 1.0, 1, 0), 1), ((14, 0.6, 3, 0.0, 5, 1.0, 1, 0), 1),
    ((3, 1.0, 6, 0.0, 4, 0.0, 1, 0), 1), ((2, 1.0, 20, 0.0, 0, 0.0, 1, 0), 1), ((50, 0.0, 5, 1.0, 4, 1.0, 1, 0), 1),
    ((90, 0.1, 3, 1.0, 6, 1.0, 1, 0), 1), ((4, 1.0, 70, 0.0, 6, 1.0, 1, 0), 1), ((5, 1.0, 6, 1.0, 80, 0.0, 1, 0), 1),
    # inside the article, but lists of links: related stories, tags
    ((3, 1.0, 2, 1.0, 3, 1.0, 1, 0), 0), ((5, 1.0, 4, 1.0, 6, 1.0, 1, 0), 0), ((2, 1.0, 3, 1.0, 2, 1.0, 1, 0), 0),
    ((8, 1.0, 7, 1.0, 9, 0.95, 1, 0), 0), ((12, 1.0, 11, 1.0, 10, 1.0, 1, 0), 0),
    # at the side: menus, adverts, notices, forms, footers and comments, whatever their length
    ((1, 1.0, 0, 0.0, 1, 1.0, 0, 1), 0), ((2, 1.0, 1, 1.0, 7, 0.0, 0, 1), 0), ((8, 0.0, 1, 1.0, 9, 0.0, 0, 1), 0),
    ((12, 0.0, 2, 1.0, 40, 0.0, 0, 1), 0), ((60, 0.0, 10, 0.0, 50, 0.0, 0, 1), 0), ((150, 0.0, 90, 0.0, 30, 0.0, 0, 1), 0),
    ((7, 0.1, 120, 0.0, 0, 0.0, 0, 1), 0), ((30, 0.2, 80, 0.0, 5, 1.0, 0, 1), 0), ((45, 0.0, 60, 0.0, 35, 0.0, 1, 1), 0),
    ((80, 0.0, 45, 0.0, 20, 0.0, 1, 1), 0), ((4, 0.5, 50, 0.0, 45, 0.0, 1, 1), 0), ((10, 0.0, 9, 0.0, 60, 0.0, 1, 1), 0),
    # no mark at all: long text with few links, and headings beside it, are main text
    ((60, 0.0, 8, 0.0, 70, 0.0, 0, 0), 1), ((120, 0.05, 60, 0.0, 90, 0.0, 0, 0), 1), ((35, 0.1, 90, 0.0, 40, 0.0, 0, 0), 1),
    ((25, 0.0, 40, 0.0, 8, 0.0, 0, 0), 1), ((18, 0.0, 70, 0.0, 60, 0.1, 0, 0), 1), ((9, 0.0, 3, 1.0, 80, 0.0, 0, 0), 1),
    ((6, 0.0, 90, 0.0, 110, 0.0, 0, 0), 1), ((30, 0.0, 2, 1.0, 45, 0.0, 0, 0), 1), ((80, 0.0, 0, 0.0, 0, 0.0, 0, 0), 1),
    ((20, 0.0, 0, 0.0, 0, 0.0, 0, 0), 1), ((5, 0.0, 0, 0.0, 0, 0.0, 0, 0), 1), ((4, 0.0, 50, 0.0, 60, 0.0, 0, 0), 1),
    # no mark: links, and short scraps among short scraps or links, are not
    ((2, 0.0, 2, 0.0, 2, 0.0, 0, 0), 0), ((5, 0.0, 4, 0.0, 6, 1.0, 0, 0), 0), ((7, 0.0, 3, 0.0, 6, 0.0, 0, 0), 0),
    ((1, 0.0, 5, 0.0, 1, 0.0, 0, 0), 0), ((3, 0.0, 1, 1.0, 2, 1.0, 0, 0), 0), ((6, 0.0, 4, 0.0, 2, 0.0, 0, 0), 0),
    ((2, 1.0, 3, 1.0, 2, 1.0, 0, 0), 0), ((5, 1.0, 60, 0.0, 4, 1.0, 0, 0), 0), ((8, 0.8, 6, 1.0, 70, 0.0, 0, 0), 0),
    ((20, 0.7, 5, 1.0, 6, 1.0, 0, 0), 0), ((3, 0.0, 2, 1.0, 4, 1.0, 0, 0), 0), ((4, 0.0, 5, 0.0, 3, 1.0, 0, 0), 0),
    ((6, 0.0, 4, 0.0, 0, 0.0, 0, 0), 0), ((7, 0.1, 6, 1.0, 3, 0.0, 0, 0), 0), ((3, 0.0, 4, 0.0, 5, 0.0, 0, 0), 0),
    ((40, 0.9, 10, 1.0, 12, 1.0, 0, 0), 0),
)


# ------------------------------------------------------------------------------------------------ blocks

def _side_or_main(name: str, attributes: str, in_main: bool) -> str:
    """What a group says about the blocks inside it: "side", "main" or nothing."""
    names = set()
    for key, *value in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = "".join(value)
        if key.lower() in ("class", "id", "role"):
            for word in value.lower().split():
                parts = [x for x in re.split(r"[-_:]+", word) if x] or [word]
                if len(parts) > 1 and parts[-1] in STATES:           # "share-enabled" says how a page is, not what
                    continue
                names.update((word, parts[0]))                       # "ad-slot" is an ad, "post-comments" holds comments,
                if parts[0] not in NOT_ITSELF:                       # "with-sidebar" is no sidebar
                    names.add(parts[-1])
        elif key.lower() == "style" and re.search(r"display\s*:\s*none", value.lower()):
            return "side"
    if re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes or "")):
        return "side"
    if name in OUTSIDE or ((name == "header" or "header" in names) and not in_main) or names & SIDE_NAMES:
        return "side"
    return "main" if name in CONTENT or names & MAIN_NAMES else ""


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """Texts of the blocks of a page, in page order, and their FEATURES."""
    texts: list[str] = []
    own: list[tuple[int, int, int, int]] = []                        # words, words in links, inside_main, at_side
    stack: list[tuple[str, str]] = []
    now: list[str] = []
    linked, in_link, at, size = [], 0, 0, len(page)
    marks = (0, 0)

    def close() -> None:
        words = "".join(now).split()
        if words:
            texts.append(" ".join(words))
            own.append((len(words), min(len(words), len("".join(linked).split())), *marks))
        now.clear(), linked.clear()

    def note() -> tuple[int, int]:
        kinds = [k for _, k in stack]
        return int("main" in kinds), int("side" in kinds)

    def read(text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        now.append(text)
        if in_link:
            linked.append(text)

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            read(page[at:])
            break
        if found.start() > at:
            read(page[at:found.start()])
        at = found.end()
        name = found["name"] or found["name2"]
        if name is None:
            if found["raw"] is not None:
                read(found["raw"])
            continue
        name, ended = name.lower(), bool(found["end"] or found["end2"])
        rest = found["rest"] if found["name"] else found["rest2"]
        if name in INLINE:
            if name == "a":
                in_link = 0 if ended else 1
                linked.append(" ")
            continue
        if name == "br":
            now.append(" ")
            linked.append(" ")
            continue
        close()
        if name in SKIPPED and not ended:
            if not (rest or "").endswith("/"):
                at = _skip(page, at, name)
        elif name in GROUPS or (name not in ("p", "html", "body", "hr", "input", "meta", "link") and rest and not ended
                                and _side_or_main(name, rest, bool(marks[0]))):
            if ended:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            else:
                stack.append((name, _side_or_main(name, rest, bool(marks[0]))))
                in_link = 0
            marks = note()
        elif ended:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    marks = note()
                    break
                if stack[i][0] in GROUPS:
                    break
    close()
    made = np.array(own, float).reshape(-1, 4)
    words, links = made[:, 0], made[:, 1] / np.maximum(made[:, 0], 1)
    before = lambda x: np.concatenate([[0.0], x[:-1]]) if len(x) else x
    after = lambda x: np.concatenate([x[1:], [0.0]]) if len(x) else x
    return texts, np.stack([words, links, before(words), before(links), after(words), after(links), made[:, 2], made[:, 3]], 1)


def _skip(page: str, at: int, name: str) -> int:
    """The place after a skipped element whose start tag ends at ``at``.

    Raw ones end at the first end tag of theirs. Others may nest; one without its end tag ends where an element around
    it does, or where an article, a main part or (after an option) the next option begins.
    """
    if name in RAW or name == "head":
        tag = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
        return tag.end() if tag else len(page) if name != "head" else at
    inside = [name]
    while True:
        tag = _TOKEN.search(page, at)
        if not tag:
            return len(page)
        at = tag.end()
        found = (tag["name"] or tag["name2"] or "").lower()
        if not found:
            continue
        if tag["end"] or tag["end2"]:
            if found in inside:
                while inside.pop() != found:
                    pass
                if not inside:
                    return at
            elif found not in INLINE:
                return tag.start()
        elif found in CONTENT or found == name == "option":
            return tag.start()
        elif found in RAW:
            at = _skip(page, at, found)
        elif found not in VOID and not (tag["rest"] or tag["rest2"] or "").endswith("/"):
            inside.append(found)


# ------------------------------------------------------------------------------------------------ tree

def train_tree(rows=LABELLED, depth: int = 7):
    """A decision tree as nested tuples (feature, cut, below or at it, above it); leaves are 0 or 1.

    Each node takes the split with the least Gini impurity; the cut lies midway between neighbouring values."""
    x, y = np.array([r for r, _ in rows], float), np.array([c for _, c in rows])

    def grow(x, y, depth):
        if not depth or y.min() == y.max():
            return int(2 * y.sum() > len(y))
        best = None
        for k in range(x.shape[1]):
            values = np.unique(x[:, k])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, k] <= cut
                impurity = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (low, ~low))
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, k, float(cut)
        if best is None:
            return int(2 * y.sum() > len(y))
        low = x[:, best[1]] <= best[2]
        return best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)

    return grow(x, y, depth)


def classify(tree, features: np.ndarray) -> np.ndarray:
    out = np.zeros(len(features), bool)

    def walk(node, rows):
        if not isinstance(node, tuple):
            out[rows] = bool(node)
            return
        low = features[rows, node[0]] <= node[1]
        walk(node[2], rows[low]), walk(node[3], rows[~low])

    walk(tree, np.arange(len(features)))
    return out


def main_text(page: str | None, tree) -> str:
    texts, features = blocks(page or "")
    return " ".join(t for t, keep in zip(texts, classify(tree, features)) if keep)


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text and n_chars (code points) per row of ``pages`` (page_id, url, html).

    Whole pages are read; null or empty html has the empty text, and so has a page without main text. Character
    references are decoded, white space inside a block becomes one space, blocks are joined in page order by one space.
    Broken markup (unclosed or cut-off tags, stray end tags) is read as far as it goes. Null ids and urls pass through,
    repeated rows stay, other columns are ignored, an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    tree = tree if tree is not None else train_tree()

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                texts = [main_text(p.as_py(), tree) for p in piece.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))

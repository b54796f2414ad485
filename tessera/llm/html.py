"""Main-text extraction from HTML by block rules in two passes.

First pass, each block by itself: what lies in menus, forms, adverts and the like, or is
mostly links, is bad; long blocks with many stop words are good; the rest is undecided. Where
a page's prose has next to none of the known stop words, its language is taken as unknown, and
length and link density decide alone. Second pass: an undecided block takes the label of the
nearest decided block, before or after it; headings go with what follows.

Class, id and role names mark an element only by a whole token, or by a compound all of whose
parts are known. A compound, or a form, that holds most of the page's prose marks nothing,
and neither does a whole token where such an element also holds the title or the article.
Pages are read row by row inside Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import sliced, text_of

SHORT, LONG = 70, 200  # characters; one of a script without spaces or with syllable blocks counts three times
LINK_DENSITY, LINKED_WHOLLY = 0.3, 0.8
STOP_LOW, STOP_HIGH = 0.15, 0.28  # share of words
STOP_KNOWN = 0.08  # below it, the page's language is not among those of the stop words
MOST = 0.5  # of the page's prose
ARTICLE_SHARE = 0.1  # an article with less of it does not stand for the page
GOOD, BAD, OPEN = 1, 0, -1
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his in is it not of on or she that the their they this to was
    were which who will with you
    aber als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit
    nach nicht noch oder sich sie sind über um und von vor war was werden wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas plus pour qu que
    qui sa se ses son sont sur un une
    al como con cuando de del el ella en entre era es esta este ha hay la las lo los más no o para pero por que se ser sin
    sobre su sus también un una y""".split()
)
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead
    tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("nav footer aside header menu dialog button select label fieldset head form".split())
SAME_CLOSES = frozenset("li dd dt tr td th option p".split())
HEADING = re.compile(r"h[1-6]")
TEXTUAL = frozenset("p pre blockquote figcaption caption dd dt td th h1 h2 h3 h4 h5 h6".split())  # never bad for lack of stop words
# Names of classes, ids and roles that mark what is not the article, and words that may stand beside them in a compound.
UNWANTED = frozenset(
    """ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs captcha comment comments
    complementary consent contentinfo cookie cookies copyright dialog disqus footer form gdpr header login masthead menu menubar
    modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommendations
    recommended related replies respond search share sharing sidebar sidenav signup skip social sponsor sponsored sponsors
    subscribe subscription tags toolbar widget widgets""".split()
)
BESIDE = frozenset(
    """area bar block body bottom box button buttons center col column container content global group inner item items left link
    links list main message middle outer page panel primary right secondary section site slot text thread title top wrap wrapper""".split()
)
ABOUT = frozenset("article entry main post story".split())  # an article's own header is part of it; its footer, comments and the like are not
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
MARKED = re.compile(r"""(?:\bclass|\bid|\brole)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
LINK = re.compile(r"\bhref\s*=", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
WIDE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
SENTENCE_END = re.compile("[.!?\u2026\u3002\uff01\uff1f\u0964\u061f\u06d4\u1362\u104b:;][\"'\u2019\u201d\u00bb)\\]\u300d]*$")
OWNER = re.compile(r"(?:©|\(c\)|copyright\b)", re.IGNORECASE)
RAW_TEXT = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())  # plain text up to their end tag, or to the page's end
OBJECTS = frozenset("template svg math object canvas".split())  # left out with all they hold, if they end
# Attributes as the HTML standard reads them: quotes count only where a value begins, an unquoted value runs to a blank or >.
REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))*+"""
TAG = re.compile(rf"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>{REST})>")
COMMENT_END = re.compile("--!?>")
FIRM, TOKEN, COMPOUND = 3, 2, 1  # how surely an element is not the article


def marked_by(rest: str, in_article: bool) -> int:
    """How surely a tag's names say that its element is not the article; 0 if they don't."""
    if "=" not in rest and "hidden" not in rest:
        return 0
    if HIDDEN.search(rest):
        return FIRM
    found = 0
    for a, b, c in MARKED.findall(rest):
        for token in (a or b or c).split():
            parts = [x.lower() for x in NAME_PARTS.findall(token)]
            bad = [x for x in parts if x in UNWANTED and not (in_article and x == "header")]
            if not bad:
                continue
            if len(parts) == 1:
                found = max(found, TOKEN)
            elif all(x in UNWANTED or x in BESIDE or x in ABOUT for x in parts) and not (bad == ["header"] and ABOUT.intersection(parts)):
                found = max(found, COMPOUND)
    return found


class Mark:
    """An element that may not be the article, and the mark around it: how surely, how much prose it holds and whether the title or an article is in it."""

    def __init__(self, sure: int, parent: Mark | None):
        self.sure, self.parent, self.prose, self.titled = sure, parent, 0, False
        self.firm = sure == FIRM or bool(parent and parent.firm)
        self.skips = False


class Block:
    """A stretch of text between block tags: characters within links, its tag, the innermost mark around it, whether it is in an article."""

    def __init__(self, text: str, linked: int, tag: str, mark: Mark | None, article: bool, heading: bool):
        self.text, self.linked, self.tag, self.mark, self.article, self.heading = text, linked, tag, mark, article, heading
        self.size = len(text) + 2 * len(WIDE.findall(text))
        self.skipped, self.label = False, OPEN


def tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it ends an element, rest) of each tag, by the standard's states; what is no text for a reader has no name.

    Comments, declarations, raw text and objects are one nameless piece each. A tag that the page's end cuts off runs to the end, but
    one with a quote that is never closed ends at its first >. Time is linear: what has no end further on is not looked for again.
    """
    at, size = 0, len(html)
    endless: set[str] = set()

    def end_of(name: str, start: int) -> int:
        """Behind the element's end tag, or -1."""
        if name in endless:
            return -1
        m = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, start)
        if m is None:
            endless.add(name)
            return -1
        stop = html.find(">", m.end())
        return size if stop < 0 else stop + 1

    while (at := html.find("<", at)) >= 0:
        mark = html[at + 1 : at + 2]
        if mark == "!" or mark == "?" or mark == "/" and not html[at + 2 : at + 3].isalpha():
            if html.startswith("<!--", at):
                if html.startswith(">", at + 4) or html.startswith("->", at + 4):
                    stop = html.index(">", at) + 1
                else:
                    m = COMMENT_END.search(html, at + 4)
                    stop = m.end() if m else size
            else:
                stop = html.find(">", at) + 1 or size
            yield at, stop, "", False, ""
            at = stop
        elif not (mark.isascii() and mark.isalpha()) and mark != "/":
            at += 1  # a plain sign
        else:
            m = TAG.match(html, at)
            if m:
                name, ends, rest, stop = m["name"].lower(), bool(m["end"]), m["rest"], m.end()
            else:
                stop = html.find(">", at) + 1
                if not stop:
                    yield at, size, "", False, ""
                    return
                name, _, rest = html[at + 1 : stop - 1].replace("/", " ", mark == "/").strip().partition(" ")
                name, ends = name.lower(), mark == "/"
            if not ends and name in RAW_TEXT:
                after = end_of(name, stop)
                stop, name = size if after < 0 else after, ""
            elif not ends and name in OBJECTS:
                after = -1 if rest.endswith("/") else end_of(name, stop)
                stop, name = max(stop, after), ""
            yield at, stop, name, ends, rest
            at = stop


def blocks(html: str) -> list[Block]:
    """The non-empty blocks of a page, in order, with character references decoded and white space collapsed."""
    found: list[Block] = []
    # tag; the innermost mark, whether it is in an article, whether it is muted, the innermost block tag
    stack: list[tuple[str, Mark | None, bool, bool, str]] = []
    opened: Counter = Counter()
    parts: list[str] = []
    linked: list[str] = []
    links = 0  # one more than the depth of the open link
    around = ("", None, False, False, "")

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            _, mark, article, _, tag = stack[-1] if stack else around
            heading = any(HEADING.fullmatch(x[0]) for x in stack[-3:])
            found.append(Block(text, len(" ".join(unescape("".join(linked)).split())), tag, mark, article, heading))
        parts.clear()
        linked.clear()

    def add(piece: str) -> None:
        if piece and not (stack and stack[-1][3]):
            parts.append(piece)
            if links:
                linked.append(piece)

    def leave() -> None:
        opened[stack.pop()[0]] -= 1

    at = 0
    for start, stop, name, ends, rest in tags(html):
        add(html[at:start])
        at = stop
        if not name:
            continue
        if name == "br":
            add(" ")
            continue
        if name == "a":
            links = 0 if ends or not LINK.search(rest) else len(stack) + 1
        if name in BLOCK:
            close()
        if ends:
            if opened[name]:
                while stack[-1][0] != name:
                    leave()
                leave()
                if len(stack) < links - 1:  # a link that was never closed ends with what it was opened in
                    links = 0
            continue
        if name in VOID or rest.endswith("/"):
            continue
        if name in BLOCK and stack and stack[-1][0] == "p" or name in SAME_CLOSES and stack and stack[-1][0] == name:
            leave()
        _, mark, article, muted, block = stack[-1] if stack else around
        sure = 0 if name in ("html", "body") else marked_by(rest, article)
        if name in SKIPPED and not (name == "header" and article):
            sure = max(sure, COMPOUND if name == "form" else FIRM)
        if name in ("h1", "article", "main") and mark:
            mark.titled = True
        if sure and name not in BLOCK:
            muted = muted or sure > COMPOUND  # part of a line: its text goes, the line stays one block
        elif sure:
            mark = Mark(sure, mark)
        if name != "a" or muted:
            stack.append((name, mark, article or name in ("article", "main"), muted, name if name in BLOCK else block))
            opened[name] += 1
    add(html[at:])
    close()
    return found


def unlinked(found: list[Block]) -> int:
    return sum(b.size for b in found if b.size > 2 * b.linked)


def settle_marks(found: list[Block]) -> None:
    """Which blocks are in elements that are not the article, once it is known how much of the page's prose these hold."""
    prose = [b for b in found if not (b.mark and b.mark.firm)]
    for b in prose:
        if b.mark:
            b.mark.prose += b.size if b.size > 2 * b.linked else 0
    order: list[Mark] = []  # outer marks before inner ones
    known: set[int] = set()
    for b in found:
        chain, mark = [], b.mark
        while mark and id(mark) not in known:
            known.add(id(mark))
            chain.append(mark)
            mark = mark.parent
        order += reversed(chain)
    for mark in reversed(order):
        if mark.parent:
            mark.parent.prose += mark.prose
            mark.parent.titled |= mark.titled
    most = MOST * max(1, unlinked(prose))
    for mark in order:
        mark.skips = mark.sure == FIRM or mark.prose < most or mark.sure == TOKEN and not mark.titled or bool(mark.parent and mark.parent.skips)
    for b in found:
        b.skipped = bool(b.mark and b.mark.skips)


def stop_share(text: str) -> tuple[int, int]:
    """Stop words and words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), len(words)


def first_pass(block: Block, known: bool) -> int:
    """``known``: the page's language has stop words here."""
    size = block.size
    if block.skipped or OWNER.match(block.text):
        return BAD
    share = block.linked / len(block.text)
    if share > (LINKED_WHOLLY if block.article or len(block.text) - block.linked >= SHORT else LINK_DENSITY) and not (block.heading or block.article and block.tag in TEXTUAL and size >= SHORT):
        return BAD
    if size < SHORT:
        return OPEN
    ended = bool(SENTENCE_END.search(block.text))
    if not known:
        return GOOD if size > LONG or ended else OPEN
    stops, words = stop_share(block.text)
    if stops >= STOP_HIGH * words and size > LONG or block.article and stops >= STOP_LOW * words:
        return GOOD
    return OPEN if stops >= STOP_LOW * words or block.article or ended or block.tag in TEXTUAL else BAD


def classified(found: list[Block]) -> list[Block]:
    """Both passes. Where the page marks an article, only its blocks can be good, and neighbours are looked for within it.

    Where no block is good, undecided ones with whole sentences or some length are, or else all undecided ones.
    """
    settle_marks(found)
    free = [b for b in found if not b.skipped]
    inside = [b for b in free if b.article]
    if unlinked(inside) < ARTICLE_SHARE * unlinked(free):
        inside = []
    pool = [b for b in found if b.article] if inside else found
    counts = [stop_share(b.text) for b in (inside or free) if b.size > 2 * b.linked]
    known = sum(x for x, _ in counts) >= STOP_KNOWN * sum(x for _, x in counts)
    decided = [first_pass(b, known) for b in pool]
    if GOOD not in decided:
        sure = [GOOD if x == OPEN and (b.size >= SHORT or SENTENCE_END.search(b.text)) else x for x, b in zip(decided, pool, strict=True)]
        decided = sure if GOOD in sure else [GOOD if x == OPEN else x for x in decided]
    n = len(pool)
    before, after = [None] * n, [None] * n  # the nearest decided block on either side
    for k in range(n):
        before[k] = k if decided[k] != OPEN else before[k - 1] if k else None
    for k in range(n - 1, -1, -1):
        after[k] = k if decided[k] != OPEN else after[k + 1] if k < n - 1 else None
    for b in found:
        b.label = BAD
    for k, b in enumerate(pool):
        near = [j for j in (after[k], before[k]) if j is not None]
        if decided[k] != OPEN:
            b.label = decided[k]
        elif b.heading and near:
            b.label = decided[near[0]]
        else:  # the nearer one decides, at equal distance the good one
            least = min((abs(j - k) for j in near), default=0)
            b.label = max((decided[j] for j in near if abs(j - k) == least), default=BAD)
    return found


def main_text(html: str) -> str:
    return "\n".join(b.text for b in classified(blocks(html)) if b.label == GOOD)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text``, a row per input row; null or empty html gives an empty text.

    Repeated rows give a row each, an empty table gives none, null ids and URLs stay null, and
    other columns are left out. Pages are read whole, however long; of blocks at equal distance
    from a good and a bad one, the good one decides.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = pa.array([main_text(x) for x in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    return slim.mapInArrow(read, "page_id long, url string, text string")


def labelled_blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A row per block: ``page_id, block, text, link_density, good``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("block", pa.int32()), ("text", pa.string()), ("link_density", pa.float64()), ("good", pa.bool_())])
        for batch in sliced(batches):
            rows = [
                {"page_id": page, "block": k, "text": b.text, "link_density": b.linked / len(b.text), "good": b.label == GOOD}
                for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True)
                for k, b in enumerate(classified(blocks(html)))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), text_of(html_col).alias("html"))
    return slim.mapInArrow(read, "page_id long, block int, text string, link_density double, good boolean")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by two passes of rules over their blocks."""

from __future__ import annotations

import html
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import ship, small_batches

# Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset(
    """
    a all an and are as at be but by can for from has have he her his i if in into is it its more
    not of on one or she so that the their there they this to was we were which will with you
    au aux avec ce ces dans de des du elle en est et il je la le les mais ne nous ont ou outre par
    pas plus pour qu que qui sa se ses son sont sur un une vous
    aber als am auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für
    hat ich im ist mit nach nicht noch oder sich sie sind so über um und vom von war wie wird zu
    zum zur
    al como con del el ella entre era es esta este ha hasta la las lo los más me muy no o para pero
    por que se si sin sobre su sus también un una y ya
    """.split()
)
# Elements whose text is no text of the page.
SILENT = frozenset("button datalist head iframe noscript object script select style svg template textarea title".split())
# Elements that hold menus, headers, footers, sidebars, notices and forms.
FURNITURE = frozenset("aside dialog fieldset footer form header menu nav".split())
# Elements inside a line of text; all others begin and end a block.
INLINE = frozenset(
    """
    a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q
    rp rt ruby s samp small span strike strong sub sup time tt u var wbr
    """.split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of a class, id or role that name furniture.
FURNITURE_NAMES = frozenset(
    """
    ad ads adslot advert advertisement adverts alert banner breadcrumb breadcrumbs comment
    commentlist comments complementary consent contentinfo cookie cookies disclaimer discussion
    disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice
    notification pager pagination popup promo promoted promotion reactions recommended related
    replies reply respond search share sharing sidebar signup skip social sponsor sponsored
    subscribe subscription teaser toolbar widget
    """.split()
)
# Elements whose names are looked at; wrappers of whole pages are not among them.
NAMED = frozenset("article details div dl figure li ol p section table td tr ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_EDGES = string.punctuation + "¡¿«»“”„‘’…–—"

GOOD, SHORT, BAD = 1, 0, -1


@dataclass
class Block:
    """A run of text between the borders of block elements, white space turned into spaces."""

    text: str
    linked: int  # characters inside links
    furniture: bool  # lies in an element that by its kind or name is no part of an article
    article: int  # number of the article it lies in, less than 0 for a main element, 0 outside
    holder: int  # number of the element that holds it, paragraphs and headings set aside


@dataclass(frozen=True)
class Rules:
    """Thresholds of the first pass."""

    long_words: int = 12  # a block of fewer words says too little about itself
    stop_share: float = 0.12  # of the words, in running text
    link_share: float = 0.5  # of the characters, in lists of links


def _named_furniture(tag: str, rest: str) -> bool:
    if tag not in NAMED or "=" not in rest:
        return False
    for found in _NAMES.finditer(rest):
        value = found.group(1) or found.group(2) or found.group(3) or ""
        for name in value.lower().split():
            # "comment-list" names its first word's thing, "has-sidebar" does not. An article may
            # be said to have such things, so it is furniture by a whole name only.
            first = name if tag == "article" else re.split(r"[-_]", name, maxsplit=1)[0]
            if name in FURNITURE_NAMES or first in FURNITURE_NAMES:
                return True
    return False


def read_blocks(page: str, names: bool = True) -> list[Block]:
    """The blocks of a page in page order; ``names=False`` passes over classes, ids and roles.

    Elements that are left open end with the element around them, an open paragraph ends where
    the next block begins, and a silent element ends at its own end tag only.
    """
    blocks: list[Block] = []
    words: list[str] = []
    linked: list[str] = []
    # Open elements: tag, furniture, article, holder. The first is the page itself.
    stack: list[tuple[str, bool, int, int]] = [("", False, 0, 0)]
    open_tags: Counter[str] = Counter()
    made = links = 0

    def text(piece: str) -> None:
        if piece:
            words.append(piece)
            if links:
                linked.append(piece)

    def close() -> None:
        if words:
            joined = " ".join(html.unescape("".join(words)).split())
            if joined:
                n_linked = len(" ".join(html.unescape("".join(linked)).split())) if linked else 0
                blocks.append(Block(joined, n_linked, *stack[-1][1:]))
            words.clear()
            linked.clear()

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if not token:
            text(page[at:])
            break
        text(page[at : token.start()])
        at = token.end()
        if not token["tag"]:
            continue
        tag = token["tag"].lower()
        if tag == "a":
            links = 0 if token["end"] else 1
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in SILENT and not token["end"]:
            if tag != "head" and not token["rest"].endswith("/"):
                ending = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if tag in ("title", "script", "style", "textarea", "svg", "iframe", "noscript", "template"):
                    at = ending.end() if ending else end
                elif ending:
                    at = ending.end()
            continue
        if tag in INLINE:
            continue
        close()
        links = 0
        if tag in VOID:
            continue
        if token["end"]:
            while open_tags[tag]:
                ended = stack.pop()[0]
                open_tags[ended] -= 1
                if ended == tag:
                    break
            continue
        if stack[-1][0] == "p":
            stack.pop()
            open_tags["p"] -= 1
        _, furniture, article, holder = stack[-1]
        made += 1
        if tag in ("article", "main"):
            # A menu or a page header that was left open does not swallow the article.
            if any(open_tags[t] for t in ("nav", "menu", "header")) or (tag == "main" and furniture):
                del stack[1:]
                open_tags.clear()
                furniture = False
            if article <= 0:
                article = made if tag == "article" else article or -made
        if tag in FURNITURE and not (tag == "header" and article):
            furniture = True
        if names and _named_furniture(tag, token["rest"]):
            furniture = True
        if tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"):
            holder = made
        stack.append((tag, furniture, article, holder))
        open_tags[tag] += 1
    close()
    return blocks


def label(block: Block, rules: Rules) -> int:
    """First pass: what a block says about itself.

    Furniture, lists of links and short lines with a copyright sign are bad, running text is
    good; what is short, or long without the words running text is made of, is left open.
    """
    if block.furniture or block.linked > rules.link_share * len(block.text):
        return BAD
    words = block.text.split(" ")
    if len(words) < rules.long_words:
        return BAD if "\u00a9" in block.text and not block.article else SHORT
    stops = sum(w.strip(_EDGES).lower() in STOP_WORDS for w in words)
    return GOOD if stops >= rules.stop_share * len(words) else SHORT


def inherit(blocks: list[Block], labels: list[int], inside: list[bool]) -> list[bool]:
    """Second pass: an open block takes the label of its nearest decided neighbour.

    Neighbours in the same element come first, then all in page order; of two as near the good
    one wins. What is ``inside`` an article has the article itself for a neighbour, which is
    good. Where no block of a page is good, the open blocks of one element are: the element
    with most characters in them, the first of several.
    """

    def nearest(group: list[int], taken: dict[int, int]) -> None:
        last = None
        ahead: dict[int, tuple[int, int]] = {}
        for k in reversed(group):
            if labels[k] != SHORT:
                last = k
            elif last is not None:
                ahead[k] = (last - k, labels[last])
        last = None
        for k in group:
            if labels[k] != SHORT:
                last = k
            elif k not in taken:
                sides = [(k - last, labels[last])] if last is not None else []
                sides += [ahead[k]] if k in ahead else []
                if sides:
                    taken[k] = min(sides, key=lambda s: (s[0], -s[1]))[1]

    taken: dict[int, int] = {}
    holders: dict[int, list[int]] = {}
    for k, block in enumerate(blocks):
        if inside[k] and labels[k] == SHORT:
            taken[k] = GOOD
        holders.setdefault(block.holder, []).append(k)
    if GOOD not in labels and not taken and SHORT in labels:
        size = {h: sum(len(blocks[k].text) for k in g if labels[k] == SHORT) for h, g in holders.items()}
        taken = {k: GOOD for k in holders[max(size, key=size.get)] if labels[k] == SHORT}
    if len(taken) < labels.count(SHORT):
        for group in holders.values():
            nearest(group, taken)
        nearest(list(range(len(blocks))), taken)
    return [(taken.get(k, BAD) if labels[k] == SHORT else labels[k]) == GOOD for k in range(len(blocks))]


def main_text(page: str, rules: Rules = Rules()) -> tuple[str, int, int]:
    """The main text of one page, its number of blocks, and how many of them are in the text.

    If names of classes would take everything away (a wrapper of the page has such a name, or
    an element was left open), the page is read again without them.
    """
    for names in (True, False):
        blocks = read_blocks(page, names)
        labels = [label(b, rules) for b in blocks]
        # An article element says more than a main element, which may hold sidebars too.
        own = [b.article for b in blocks if not b.furniture]
        articles = any(a > 0 for a in own)
        inside = [b.article > 0 if articles else b.article < 0 for b in blocks]
        if any(own):
            # The article is known: running text elsewhere is a notice, a teaser or an advert.
            labels = [one if here else BAD for one, here in zip(labels, inside, strict=True)]
        kept = [b.text for b, keep in zip(blocks, inherit(blocks, labels, inside), strict=True) if keep]
        if kept:
            return " ".join(kept), len(blocks), len(kept)
    return "", len(blocks), 0


def extract_main_text(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    source: str = "html",
    rules: Rules = Rules(),
) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept``, one row a row of the input.

    A page is a row and is read whole by one task, so nothing is shuffled and a lost executor
    costs the pages it was reading. A null or empty page, and a page without an article, has an
    empty text. Repeated rows come out as often as they went in; an empty table gives an empty
    result. Other columns are not read, whatever their names.
    """
    ship(pages.sparkSession)
    taken = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("html"),
    )
    types = {f.name: f.dataType.simpleString() for f in taken.schema}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            found = [main_text(page, rules) for page in batch.column("html").to_pylist()]
            texts, n_blocks, n_kept = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(n_blocks, pa.int64()),
                    pa.array(n_kept, pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
            )

    result = "text string, n_chars long, n_blocks long, n_kept long"
    return taken.mapInArrow(read, f"page_id {types['page_id']}, url {types['url']}, {result}")

"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block tags. Subtrees that are no article by their tag, role, class or id
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments) give no blocks. The
first pass labels blocks by length, link density and stop-word density; inside ``article`` or ``main``
fewer stop words are asked for, and where a page has such a part, blocks outside it are bad. Short
blocks, and middling ones, stay undecided. The second pass gives each undecided block the label of
its nearest decided neighbours: good if either is good inside the article part, or if both are good
elsewhere, or if nothing is decided inside the article part.

Each page is parsed by itself, in one pass over its tags, so memory is bounded by the largest page. Tags
that are never closed are text, but for the last, which a page may be cut off in.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH_LOW = 70
LENGTH_HIGH = 200
LINKS_HIGH = 0.2
STOP_LOW = 0.15
STOP_HIGH = 0.30
# Inside the article part.
ARTICLE_LINKS_HIGH = 0.6

# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i if in is it its no not of on or she so that "
        "the their them there they this to was we were what when which who will with would you your "
        "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas pour qui que "
        "sa se ses son sont sur un une vous "
        "aber als am auch auf aus bei bin bis das dass dem den der die du ein eine einem einen einer er es für hat ich "
        "im ist mit nach nicht noch nur oder sich sie sind so und von vor war wie wir zu zum zur "
        "al como con del el ella ellos era es esta este ha hay lo los las más me mi muy no para pero por si sin sobre su "
        "sus también y ya"
    ).split()
)

BLOCKS = frozenset(
    (
        "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
        "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
        "tfoot th thead tr ul"
    ).split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup; it ends at their own end tag.
RAW = frozenset("script style title textarea noscript noframes iframe xmp svg math template object".split())
DROPPED = frozenset("nav header footer aside form button select menu dialog".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav "
        "navbar navigation navi breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notification "
        "popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
        "recommendations comment comments disqus reply replies respond widget widgets toolbar pagination pager login "
        "search form"
    ).split()
)

_OPEN = re.compile(r"<[!?/A-Za-z]")
# Where a ``>`` follows. A value in quotes may hold both brackets if an attribute or the end follows it.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"'<=]++|=\s*+\"[^\"]*+\"(?=[\s/>])|=\s*+'[^']*+'(?=[\s/>])|="
    r"|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
# Where none follows: the page ends within a comment or a tag.
_CUT_OFF = re.compile(r"<!--.*\Z|<!\[CDATA\[.*\Z|<[!?/A-Za-z][^<>]*\Z", re.S)
_RAW_END = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    links: int
    inside: bool


def _dropped(name: str, attributes: str, inside: bool) -> bool:
    if name in DROPPED:
        # An article's own header may hold its headline; only that is kept of it.
        return not (name == "header" and inside)
    if not attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value in DROPPED_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body", "article", "main"):
            if not DROPPED_WORDS.isdisjoint(_NAME_PARTS.findall(value)):
                return True
        if key in ("class", "id") and name in ("article", "main") and "comment" in value:
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The page's blocks of text, in order, without dropped subtrees."""
    found: list[Block] = []
    pieces: list[str] = []
    links = 0
    open_tags: list[str] = []
    n_open: Counter[str] = Counter()
    dropped_at = 0  # depth of the outermost dropped element, 0 if none is open
    last_end = page.rfind(">")

    def next_tag(start: int) -> re.Match | None:
        opened = _OPEN.search(page, start)
        return opened and (_TAG if opened.start() < last_end else _CUT_OFF).search(page, opened.start())

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text and not (n_open["header"] and not any(n_open[h] for h in ("h1", "h2", "h3", "h4", "h5", "h6"))):
            found.append(Block(text, links, n_open["article"] + n_open["main"] > 0))
        pieces.clear()
        links = 0

    def close_to(name: str) -> None:
        nonlocal dropped_at
        while open_tags:
            last = open_tags.pop()
            n_open[last] -= 1
            if dropped_at > len(open_tags):
                dropped_at = 0
            if last == name:
                return

    at = 0
    while True:
        tag = next_tag(at)
        if not dropped_at:
            text = page[at : tag.start() if tag else len(page)]
            if text:
                pieces.append(text)
                if n_open["a"]:
                    links += len(text)
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower() if tag.re is _TAG else ""
        if not name:
            if tag[0].startswith("<![CDATA[") and not dropped_at:
                pieces.append(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            pieces.append(" ")
        if tag[1]:
            if n_open[name] > 0:
                close_to(name)
            continue
        if name in VOID:
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        # A block ends an open paragraph, a list item ends the one before it.
        if name in BLOCKS and n_open["p"] > 0 and not _between(open_tags, "p", BLOCKS):
            close_to("p")
        if name == "li" and n_open["li"] > 0 and not _between(open_tags, "li", ("ul", "ol")):
            close_to("li")
        if tag[3].endswith("/"):
            continue
        inside = n_open["article"] + n_open["main"] > 0
        open_tags.append(name)
        n_open[name] += 1
        if not dropped_at and _dropped(name, tag[3], inside):
            dropped_at = len(open_tags)
    flush()
    return found


def _between(open_tags: list[str], name: str, barriers) -> bool:
    """Whether a barrier was opened since the last ``name``."""
    for tag in reversed(open_tags):
        if tag == name:
            return False
        if tag in barriers:
            return True
    return True


def _decide(block: Block, has_article: bool) -> bool | None:
    """First pass: good, bad, or None for undecided."""
    length = len(block.text)
    density = block.links / length
    if block.inside:
        if density > ARTICLE_LINKS_HIGH:
            return False if length >= LENGTH_LOW else None
        return None if length < LENGTH_LOW else True
    if has_article or density > LINKS_HIGH:
        return False
    if length < LENGTH_LOW:
        return False if block.links else None
    words = block.text.lower().split()
    stops = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words)
    if stops >= STOP_HIGH:
        return True if length > LENGTH_HIGH else None
    return None if stops >= STOP_LOW else False


def main_text(page: str) -> str:
    """Good blocks in page order, one line each."""
    found = blocks(page)
    has_article = any(b.inside for b in found)
    first = [_decide(b, has_article) for b in found]
    before: list[bool | None] = []
    last = None
    for label in first:
        before.append(last)
        last = label if label is not None else last
    after: list[bool | None] = []
    last = None
    for label in reversed(first):
        after.append(last)
        last = label if label is not None else last
    after.reverse()

    def final(i: int) -> bool:
        if first[i] is not None:
            return first[i]
        around = [x for x in (before[i], after[i]) if x is not None]
        if found[i].inside:
            return any(around) or not around
        return bool(around) and all(around)

    return "\n".join(b.text for i, b in enumerate(found) if final(i))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page = batch.schema.get_field_index("_html")
        texts = pa.array([main_text(t) for t in batch.column(page).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(batch.num_columns) if i != page), texts],
            [*(n for n in batch.schema.names if n != "_html"), "main_text"],
        )


def extract_main(pages: DataFrame) -> DataFrame:
    """The rows of ``pages`` with ``main_text`` in place of ``html``; empty where there is none.

    A null page is an empty one. Cut-off pages are read as far as they go. An existing column
    ``main_text`` is replaced, other columns pass through.
    """
    own = [c for c in pages.columns if c not in ("html", "main_text")]
    rows = pages.select(*own, text_of("html").alias("_html"))
    schema = rows.drop("_html").withColumn("main_text", F.lit("")).schema
    return rows.mapInArrow(_extract, schema)


@query("op10_block_rules")
def op10_block_rules(spark, sf_dir):
    """Main text of every page and its length."""
    pages = extract_main(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars")
    )

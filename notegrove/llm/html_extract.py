"""Main text of web pages, without what a site repeats on its pages.

Each page is read once. Every block or container element gets a hash of its whole subtree
(tag, text and children), and so does a line of text beside other blocks in one element.
Spark counts each hash per host, over pages of different content, so that copies of one page
count once. The counts decide on every block of text of every page, by one rule for hosts of
any size: a subtree is a template on ``TEMPLATE_SHARE`` of its host's pages and a few
(``TEMPLATE_MORE``) more, so a heading or table that articles have in common stays whatever
their number, and on too few pages to tell everything stays. Beside an article or main element
the bar is lower (``BESIDE_SHARE``, ``BESIDE_MORE``).

Markup that says what it is (navigation, adverts, notices, comments ...) is left out by its
name already. But a form or a word of a class or id never drops what is around an article or
main element (around an h1, on a page without them), nor all text of a page: there the counts
decide. Of several articles, those with such a word of their own (comments, cards) count only
if no other is there.

Defined results: null or empty html gives the empty text; an article or main element without
text counts as none; a null or odd url is a host of its own kind (the empty one);
pages that repeat give the same text each; an empty table gives an empty result. Other
columns of the input are never read.
"""

from __future__ import annotations

import hashlib
import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

# A subtree on this share of a host's pages, of different content, and as many pages more is
# a template; beside an article it takes less.
TEMPLATE_SHARE, TEMPLATE_MORE = 0.2, 3
BESIDE_SHARE, BESIDE_MORE = 0.01, 2
# Where a block stands: on a page without an article, in an article, beside one.
PLAIN, IN_ARTICLE, BESIDE = 0, 1, 2

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>""", re.S
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

RAW = frozenset("script style textarea title noscript xmp iframe template svg noframes noembed".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption td th address summary legend option".split())
CONTAINERS = frozenset(
    "html body div section article main header footer nav aside ul ol dl table thead tbody tfoot tr form fieldset figure details dialog menu center hgroup".split()
)
# Elements, roles and words of class or id that are no part of an article.
NO_TEXT = frozenset("head nav footer aside button select datalist dialog menu object audio video canvas label annotation annotation-xml".split())
NO_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NO_WORDS = frozenset(
    """ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup popover modal overlay
    newsletter subscribe subscription signup login share sharing social sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager
    footer masthead toolbar related recommended recommendations comment comments disqus respond replies skip copyright""".split()
)
# With one of these, a word of a class tells of the page's state ("has-sidebar", "menu-open").
STATES = frozenset("has no not with without open opened close closed collapsed hide off on".split())
CLOSES_P = BLOCKS - {"dt", "dd", "td", "th", "li", "option", "legend", "summary", "caption", "figcaption"} | CONTAINERS | {"hr"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select article main body html".split())


def unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the markup itself says that an element and all in it are no part of an article."""
    if tag in NO_TEXT or tag == "header" and not in_article:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in NO_ROLES:
            return True
    return False


def doubtful(tag: str, attributes: str) -> bool:
    """Whether the element is a form, or its class or id holds a word of ``NO_WORDS``."""
    if tag == "form":
        return True
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        if name.lower() in ("class", "id"):
            for token in "".join(values).split():
                words = {w.lower() for w in _NAME_WORDS.findall(token)}
                if not NO_WORDS.isdisjoint(words) and STATES.isdisjoint(words):
                    return True
    return False


class Block(NamedTuple):
    """A line of text, the hash of the closest subtree around it, that of the closest
    container around it inside an article, and where it stands. (Wherever a wider subtree
    recurs, the closest one recurs with it.)"""

    text: str
    cover: int
    box: int | None
    kind: int


class _Element:
    __slots__ = ("box", "doubt", "drop", "inside", "parts", "place", "solid", "tag")

    def __init__(self, tag: str, drop: bool, inside: bool, place: int, solid: int, box: int, doubt: int):
        self.tag, self.drop, self.inside, self.place, self.solid, self.box, self.doubt = tag, drop, inside, place, solid, box, doubt
        self.parts: list[bytes] = []


def _hash(tag: str, parts) -> bytes:
    return hashlib.blake2b(b"\0".join([tag.encode(), *parts]), digest_size=8).digest()


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def read_page(page: str | None) -> tuple[list[int], list[Block]]:
    """The hashes of a page's subtrees and its blocks of text in page order."""
    page = page or ""
    # ``place``: the element's own number in ``hashes`` (-1 without one); ``solid``: that of the
    # closest block or container, 0 being the page; ``mixed``: it holds more than one line.
    root = _Element("", False, False, 0, 0, -1, -1)
    stack, hashes, tags, mixed, open_tags = [root], [0], [""], [True], Counter()
    lines: list[tuple[str, _Element]] = []
    # Doubtful elements: the one around each, and the least rank of content in it (0 an article
    # or main element, 1 one that is doubtful itself, 2 an h1, 3 none).
    outer: list[int] = []
    holds: list[int] = []
    best = 3
    seen: set[int] = set()
    line: list[str] = []
    line_at = root

    def flush() -> None:
        if line:
            text = " ".join("".join(line).split())
            if text:
                at = line_at.solid
                mixed[at] = mixed[at] or at in seen
                seen.add(at)
                lines.append((text, line_at))
            line.clear()

    def text(raw: str) -> None:
        nonlocal line_at
        at = stack[-1]
        if not raw or at.tag in ("html", "head") and not raw.strip():
            return
        if "&" in raw:
            raw = markup.unescape(raw)
        at.parts.append(" ".join(raw.split()).encode(errors="replace"))
        if not at.drop:
            if not line:
                line_at = at
            line.append(raw)

    def close() -> None:
        at = stack.pop()
        open_tags[at.tag] -= 1
        if at.tag in BLOCKS or at.tag in CONTAINERS:
            flush()
        digest = _hash(at.tag, filter(None, at.parts))
        stack[-1].parts.append(digest)
        if at.place >= 0:
            hashes[at.place] = _number(digest)

    def close_to(names, stop=frozenset()) -> bool:
        if not any(open_tags[t] for t in names):
            return False
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                while len(stack) > k:
                    close()
                return True
            if stack[k].tag in stop:
                return False
        return False

    pos, size = 0, len(page)
    while pos < size:
        found = _TAG.search(page, pos)
        if not found:
            text(page[pos:])
            break
        text(page[pos : found.start()])
        pos = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            close_to({tag})
            continue
        attributes = found[3] if found[2] else found[6] or ""
        if tag in RAW:
            if tag == "svg" and attributes.rstrip().endswith("/"):
                continue
            end = re.compile(rf"</{tag}[^>]*>", re.I).search(page, pos)
            if tag == "svg" and not end:
                continue
            pos = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in CLOSES_P:
            close_to({"p"}, SCOPE)
        if tag in SAME:
            close_to(SAME[tag], SCOPE - {"table"} if tag == "tr" else SCOPE)
        above = stack[-1]
        solid = tag in BLOCKS or tag in CONTAINERS
        if solid:
            flush()
        content = tag in ("article", "main") or "main" in attributes and bool(re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I))
        inside = above.inside or content and not above.drop
        drop = above.drop or unwanted(tag, attributes, above.inside)
        unsure = not drop and tag not in ("html", "body") and doubtful(tag, attributes)
        doubt = above.doubt
        if (content or tag == "h1") and not drop:
            rank = int(unsure) if content else 2
            best = min(best, rank)
            while doubt >= 0 and holds[doubt] > rank:
                holds[doubt], doubt = rank, outer[doubt]
            doubt = above.doubt
        if unsure and not content:
            outer.append(doubt)
            holds.append(3)
            doubt = len(outer) - 1
        place, near, box = -1, above.solid, above.box
        if solid:
            mixed[near] = True
            place = near = len(hashes)
            hashes.append(0)
            tags.append(tag)
            mixed.append(tag in ("html", "body"))
            if content:
                box = -1
            elif inside and tag in CONTAINERS:
                box = place
        stack.append(_Element(tag, drop, inside, place, near, box, doubt))
        open_tags[tag] += 1
        if attributes.rstrip().endswith("/") and not solid:
            close()
    while len(stack) > 1:
        close()
    flush()
    # How many doubtful elements are around, those around the content aside.
    doubts = [0]
    for around, rank in zip(outer, holds):
        doubts.append(doubts[around + 1] + (rank > best or rank == 3))
    least = min((doubts[at.doubt + 1] for _, at in lines), default=0)
    lines = [(found, at) for found, at in lines if doubts[at.doubt + 1] == least]
    article = any(at.inside for _, at in lines)
    blocks = []
    for found, at in lines:
        cover = _number(_hash(tags[at.solid], [found.encode(errors="replace")])) if mixed[at.solid] else hashes[at.solid]
        # Inside a doubtful element an article has no higher bar.
        kind = (IN_ARTICLE if at.doubt < 0 else PLAIN) if at.inside else BESIDE if article else PLAIN
        blocks.append(Block(found, cover, hashes[at.box] if at.box >= 0 else None, kind))
    return hashes[1:] + [b.cover for b in blocks], blocks


ROWS = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("content", pa.int64()), ("subtrees", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("text", pa.string()), ("cover", pa.int64()), ("box", pa.int64()), ("kind", pa.int8())]))),
    ]
)
ROWS_SQL = "page_id long, url string, content long, subtrees array<long>, blocks array<struct<text:string,cover:long,box:long,kind:byte>>"


def pages_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the hash of its text, its distinct subtree hashes, its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, subtrees, blocks = [], [], []
            for page in batch.column(2):
                hashes, found = read_page(page.as_py())
                whole = hashlib.blake2b("\n".join(b.text for b in found).encode(errors="replace"), digest_size=8).digest()
                content.append(int.from_bytes(whole, "little", signed=True))
                subtrees.append(sorted(set(hashes)))
                blocks.append([b._asdict() for b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.string()), *(pa.array(x, ROWS.field(i + 2).type) for i, x in enumerate((content, subtrees, blocks)))], schema=ROWS
            )

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col)).mapInArrow(run, ROWS_SQL)


def counts(read: DataFrame) -> DataFrame:
    """The subtrees (host, hash) that stand on two pages of a host or more, the number ``n`` of
    these pages, pages of equal content counted once. Rows are joined per task before they
    are shuffled."""
    each = read.select("host", "content", F.explode("subtrees").alias("hash")).distinct()
    return each.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= 2)


def sites(read: DataFrame) -> DataFrame:
    """The hosts and their numbers of pages of different content."""
    return read.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = TEMPLATE_SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host = F.xxhash64(F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit("")))
    read = pages_read(pages, id_col, url_col, html_col).withColumn("host", host)
    read = materialize(read.withColumn("rid", F.monotonically_increasing_id()), "page-blocks")
    # One count decides on both hashes of a block: the box has the bar of a plain page.
    asked = F.concat(
        F.transform("blocks", lambda b: F.struct(b["cover"].alias("hash"), b["kind"].alias("kind"))),
        F.transform(F.filter("blocks", lambda b: b["box"].isNotNull()), lambda b: F.struct(b["box"].alias("hash"), F.lit(PLAIN).cast("byte").alias("kind"))),
    )
    around = read.select("rid", "host", F.explode(F.array_distinct(asked)).alias("asked")).select("rid", "host", "asked.hash", "asked.kind")
    pages_ = F.col("pages")
    bar = F.when(F.col("kind") == BESIDE, BESIDE_MORE + pages_ * BESIDE_SHARE).otherwise(TEMPLATE_MORE + pages_ * share)
    known = counts(read).join(sites(read), "host")
    gone = around.join(known, ["host", "hash"]).filter(F.col("n") >= bar).select("rid", "hash", "kind")
    told = gone.groupBy("rid").agg(F.collect_set(F.struct("hash", "kind")).alias("gone"))
    # Stored first, so that its size is known: the texts move only if it is too large to send.
    told = materialize(told, "page-templates")
    stays = lambda b: F.col("gone").isNull() | ~(
        F.array_contains("gone", F.struct(b["cover"].alias("hash"), b["kind"].alias("kind")))
        | b["box"].isNotNull() & F.array_contains("gone", F.struct(b["box"].alias("hash"), F.lit(PLAIN).cast("byte").alias("kind")))
    )
    kept = read.join(told, "rid", "left").select("page_id", "url", F.filter("blocks", stays).alias("blocks"))
    text = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))

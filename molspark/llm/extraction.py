"""Main text of web pages by consensus paths of their hosts (operator 9).

A page is read once into blocks of text, each with the path of its containers; a container's place in
the path is its tag and class, generalised by dropping digits. A page's containers are scored by the
text they hold outside links, boilerplate counting against them. Each page votes for its best path;
votes are summed by host and path in Spark, and the path with the most votes wins for the host. Then
every page is read again and the blocks under the winning path are its text. A page without that path
falls back on its own best container.

Menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out wherever they stand, told by tag, role, or the words of class and id.

Defined cases: null html counts as empty and gives the empty text; a null or odd url belongs to the
host of no name; broken markup is read as far as it goes; repeated rows are rows; an empty table
gives no rows; other columns don't matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Collection
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import by_batch, column
from molspark.session import materialised

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content isn't markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("html body article main section div td table tbody tr center aside nav header footer form".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption address details summary fieldset th thead "
    "tfoot caption hr menu hgroup search dialog".split()
)
DROPPED_TAGS = frozenset(
    "head nav aside form script style noscript template svg math iframe object embed canvas audio video select button "
    "input textarea option datalist title menu dialog noembed noframes applet".split()
)
PAGE_ONLY = frozenset(["header", "footer"])  # of the page; an article may have its own
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
FORM = 1  # dropped by a form alone; other reasons are 2
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar aside related recommended share sharing social cookie cookies consent "
    "gdpr notice notification alert popup modal overlay newsletter subscribe signup login search comment comments reply "
    "replies respond discussion disqus masthead footer copyright toolbar skip hidden widget".split()
)
PAGE_WORDS = frozenset(["header", "topbar"])
#: Words that go with those above in a name (share-buttons, site-nav); any other word makes it another name.
PLAIN_WORDS = frozenset(
    "box list posts post buttons button bar links link block container wrapper wrap section area item items inner outer "
    "site page top bottom left right primary secondary global inline unit slot main col column row icons icon bottom".split()
)
#: A start tag that ends an open element of these.
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>=]+|=\s*+(?:\"[^\"]*\"|'[^']*')|=)*+)>|<[!?][^>]*>", re.S
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
LEAST_SHARE = 0.25
WORD = re.compile(r"[a-z]+")
DIGIT_RUN = re.compile(r"[0-9]+")


class Block:
    __slots__ = ("path", "text", "linked", "dropped")

    def __init__(self, path: str, text: str, linked: int, dropped: int):
        self.path, self.text, self.linked, self.dropped = path, text, linked, dropped


def _names(value: str) -> set[str]:
    """What a class or id says if it is made of known words only, and of plain ones beside."""
    found = set()
    for name in value.split():
        seen = WORD.findall(name)
        if all(w in DROPPED_WORDS or w in PAGE_WORDS or w in PLAIN_WORDS for w in seen):
            found.update(seen)
    return found


def _marks(rest: str, tag: str) -> tuple[str, set[str], str]:
    """First class, words of class and id, role. Ids of headings and sections come from their titles."""
    kind, seen, role = "", set(), ""
    for m in NAMED.finditer(rest):
        value = (m[2] or m[3] or m[4] or "").strip().lower()
        name = m[1].lower()
        if name == "role":
            role = value
        elif name == "class" or tag not in TITLED:
            seen |= _names(value)
        if name == "class" and value:
            kind = value.split()[0]
    return kind, seen, role


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order, with the generalised path of the containers around each."""
    out: list[Block] = []
    # An open element: tag, path so far, whether it is dropped, whether it is inside an article.
    stack: list[tuple[str, str, int, bool]] = [("", "", 0, False)]
    parts: list[str] = []
    linked = links = 0
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1][1], text, linked, stack[-1][2]))
            parts.clear()
        linked = 0

    while at < end:
        m = TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at:
            parts.append(html[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "br":
                parts.append(" ")
            elif tag in BLOCKS or tag in DROPPED_TAGS:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                flush()
                if depth:
                    del stack[depth:]
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS and tag not in DROPPED_TAGS:
            continue
        if tag in BLOCKS:
            flush()
            links = 0
        if tag in VOID:
            continue
        if tag in ENDS:
            while len(stack) > 1 and stack[-1][0] in ENDS[tag]:
                stack.pop()
        if tag in CONTAINERS or tag.startswith("h") or tag == "p":
            while len(stack) > 1 and stack[-1][0] == "p":
                stack.pop()
        _, path, dropped, inside = stack[-1]
        rest = m["rest"]
        kind, seen, role = _marks(rest, tag) if rest and "=" in rest else ("", set(), "")
        inside = inside or tag in ("article", "main") or role == "main"
        if dropped == FORM and tag in ("article", "main"):
            dropped = 0  # a page inside one form
        if dropped < 2:
            other = (
                (tag in DROPPED_TAGS and tag != "form")
                or role in DROPPED_ROLES
                or (tag in PAGE_ONLY and not inside)
                or (tag not in ("html", "body", "article", "main") and bool(seen & DROPPED_WORDS))
                or (tag not in ("html", "body", "article", "main") and not inside and bool(seen & PAGE_WORDS))
                or (rest != "" and HIDDEN.search(rest) is not None)
            )
            dropped = 2 if other else FORM if tag == "form" else dropped
        if tag in DROPPED_TAGS and tag not in BLOCKS:
            flush()
        if tag in CONTAINERS:
            path += ">" + tag + ("." + DIGIT_RUN.sub("", kind) if kind else "")
        if not (rest.endswith("/") and tag not in BLOCKS):
            stack.append((tag, path, dropped, inside))
    flush()
    return out


def ancestors(path: str) -> list[str]:
    """All container paths above and at a block's own."""
    steps = path.split(">")[1:]
    return [">" + ">".join(steps[: i + 1]) for i in range(len(steps))]


def best_path(found: list[Block]) -> tuple[str, float]:
    """The container with the highest score: its kept text outside links, less what it would drop.

    A container passes on little of its score to those above it, so the innermost that holds nearly all
    of the text wins; article and main elements count more.
    """
    kept, lost = defaultdict(float), defaultdict(float)
    for b in found:
        weight = max(0, len(b.text) - b.linked)
        for depth, path in enumerate(ancestors(b.path)):
            if b.dropped:
                lost[path] += len(b.text)
            else:
                kept[path] += weight * (1 + 0.05 * depth)
    best, most = "", 0.0
    for path, value in kept.items():
        last = path.rsplit(">", 1)[-1].split(".")[0]
        value = (value - 0.5 * lost[path]) * (1.5 if last in ("article", "main") else 1.0)
        if value > most:
            best, most = path, value
    return best, most


def main_text(found: list[Block], path: str, others: Collection[str] = ()) -> str:
    """The kept blocks under a path, joined by line breaks; under the page's own best path if there are none,
    or if it is one of the host's `others` and the path has less than LEAST_SHARE of its text. A page that is
    nothing but a form gives the form's text."""

    def under(p: str) -> list[str]:
        return [b.text for b in found if not b.dropped and (b.path == p or b.path.startswith(p + ">"))]

    if all(b.dropped for b in found):
        found = [Block(b.path, b.text, b.linked, b.dropped - FORM) for b in found]
    own, _ = best_path(found)
    mine = under(own) if own else [b.text for b in found if not b.dropped]
    texts = under(path) if path else mine
    if not texts or own in others and sum(map(len, texts)) < LEAST_SHARE * sum(map(len, mine)):
        texts = mine
    return "\n".join(texts)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, pages, score): the votes of all pages, summed."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            best = [best_path(blocks(h or "")) for h in batch.column(1).to_pylist()]
            return {"host": batch.column(0), "path": [p for p, _ in best], "score": [s for _, s in best]}

        return work

    return (
        by_batch(pages.select("host", "html"), "host string, path string, score double", make)
        .where("path <> ''")
        .groupBy("host", "path")
        .agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    )


def winners(counted: DataFrame) -> DataFrame:
    """(host, path, others): the path most of a host's pages voted for, of equals the smaller in text order,
    and all that a tenth of its pages voted for, two at least; those are ten at most."""
    best = counted.groupBy("host").agg(F.max("pages").alias("most"), F.sum("pages").alias("whole"))
    many = (F.col("pages") >= 2) & (F.col("pages") * 10 >= F.col("whole"))
    return counted.join(best, "host").groupBy("host").agg(
        F.min(F.when(F.col("pages") == F.col("most"), F.col("path"))).alias("path"),
        F.collect_list(F.when(many, F.col("path"))).alias("others"),
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, path (the host's winning one) and text for every row of `pages`."""
    plain = pages.select(
        column(pages, "page_id", "bigint").alias("page_id"),
        column(pages, "url", "string").alias("url"),
        column(pages, "html", "string").alias("html"),
    ).withColumn("host", host_of(F.col("url")))
    won = materialised(winners(votes(plain)))
    met = plain.join(won, "host", "left").select("page_id", "url", "path", "html", "others")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            texts = [
                main_text(blocks(h or ""), p or "", others or ())
                for p, h, others in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
            ]
            return {"page_id": batch.column(0), "url": batch.column(1), "path": batch.column(2), "text": texts}

        return work

    return by_batch(met, "page_id bigint, url string, path string, text string", make)

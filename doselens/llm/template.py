"""Main text of web pages by equivalence classes of tokens.

A page is read as a row of tokens: tags with the path of elements above them,
and stretches of text with theirs. Over the pages of a host each token has an
occurrence vector, the number of times it stands on each page. Tokens of equal
vectors form an equivalence class; the vectors are compared by a hash that is
summed up page by page, so they are never gathered. A class on nearly all pages
of the host, with several tokens, belongs to the template. On a page the tokens
of a class lie in order, and a class is nested in the gap of another between two
of whose tokens it lies; one that crosses another is dropped there. A class that
stands on a page several times nests copy by copy. Text of the nested classes is
the template's; the other text lies in the gaps, the slots, and the elements around
a slot tell its role. Slots in menus, headers, footers, sidebars, notices, adverts,
forms and reader comments are left out. If the page has an article or main element,
the slots in it are the main text, else those of the body.

Text of the template goes also inside article or main, but for two cases: where it
stands between slots, in a block of the same path as one of them (a line that all
pages have among the paragraphs). Pages without any text of their own, and hosts of fewer than
``LEAST_PAGES`` different pages, which tell too little, keep the template's text too.

A name alone leaves nothing out: an element with the name of a menu, advert and so
on is left out if it stands on several pages of its host, and does not hold the
main element, the heading or most of the text of the host's pages.

A host's pages are its different contents: copies, whatever their ids, count once, so a
page is extracted in the same way however often the table has it. Null pages, and pages
without text, give the empty text. Hosts with one page have no classes, and the page's
own tags serve as the template. Each row is extracted, also repeated ones and those
without id. Pages keep their other columns out of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import (
    BatchFunction,
    add_columns,
    filter_of,
    materialize,
    passes,
    released,
    texts,
)

SUPPORT = 0.9
"""Share of a host's pages on which the tokens of a template class stand."""
LEAST_TOKENS = 3
"""Tokens of a template class."""
LEAST_PAGES = 4
"""Pages of a host from which text inside its main elements may be the template's."""
NAMED_SUPPORT = 0.1
"""Share of a host's pages, at least two, on which an element left out by its name stands."""

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
RAW = frozenset("script style noscript template iframe svg math textarea title".split())
OUTSIDE = RAW | frozenset(
    "head nav header footer aside form menu dialog button select option fieldset".split()
)
MAIN = frozenset("article main".split())
WHOLE = frozenset("html body article main".split())
"""Elements whose class does not make them an extra."""
CLOSED_BY = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
ROLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|disclaimer|"
    r"footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|"
    r"popup|promo\w*|related|replies|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|"
    r"subscribe|teaser|toolbar|widget|complementary|contentinfo|alert|alertdialog)(?:$|[\s_-])",
    re.IGNORECASE,
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DIGITS = re.compile(r"\d+")
BLANK = re.compile(r"\s+")


class Element:
    """An open element: the token of its path, whether its tag leaves it out, and whether it is main.

    ``named`` has the tokens of the elements from it on up whose names may leave them
    out, ``block`` the token of the nearest element that is not inline. The last bit of
    a token tells whether its own name may leave it out.
    """

    __slots__ = ("tag", "outside", "main", "token", "below", "named", "block")

    def __init__(self, tag: str, names: str, above: Element | None) -> None:
        self.tag = tag
        own = f"{tag}[{DIGITS.sub('0', names)}]" if names else tag
        self.main = bool(above and above.main) or tag in MAIN or "role=main" in names
        # The header of an article is judged like an element of that name.
        header = tag == "header" and self.main
        named = header or bool(names and ROLES.search(names)) and tag not in WHOLE
        spread = xxhash.xxh64_intdigest(f"{above.token if above else 0}/{own}") >> 1
        self.token = spread & ~1 | named
        self.named = (*(above.named if above else ()), *([self.token] if named else ()))
        self.block = above.block if above and tag in INLINE else self.token
        self.outside = bool(above and above.outside) or tag in OUTSIDE and not header
        self.below: dict[tuple[str, str], Element] = {}


ELEMENTS = 20_000
"""Different elements remembered at once in a task."""
_roots: dict[tuple[str, str], Element] = {}
_remembered = 0


def _element(tag: str, names: str, above: Element | None) -> Element:
    """The element of a name below another; pages of a host share most of them."""
    global _remembered
    known = above.below if above else _roots
    found = known.get((tag, names))
    if found is None:
        if _remembered > ELEMENTS:
            _roots.clear()
            _remembered = 0
        _remembered += 1
        found = known[tag, names] = Element(tag, names, above)
    return found


def _names(attributes: str) -> str:
    """The words of class, id and role, a role with its name."""
    if "=" not in attributes:
        return ""
    values = []
    for found in NAMES.finditer(attributes):
        words = (found[2] or found[3] or found[4] or "").split()
        values += [f"role={word}" for word in words] if found[1].lower() == "role" else words
    return " ".join(values)


def read(html: str) -> Iterator[tuple[str, Element | None, str]]:
    """The tokens of a page: ("open" | "close" | "break" | "text", element, text)."""
    stack: list[Element] = []
    at = 0
    while at < len(html):
        found = TOKEN.search(html, at)
        if found is None:
            yield "text", stack[-1] if stack else None, html[at:]
            break
        if found.start() > at:
            yield "text", stack[-1] if stack else None, html[at : found.start()]
        at = found.end()
        end_mark, tag, attributes = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if end_mark:
            if tag in [e.tag for e in stack]:
                while stack:
                    element = stack.pop()
                    yield "close", element, ""
                    if element.tag == tag:
                        break
            continue
        if tag in VOID:
            if tag not in INLINE:
                yield "break", None, ""
            continue
        if closes := CLOSED_BY.get(tag):
            # A new paragraph or item ends an open one, with what is open in it.
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag in closes), -1)
            if place >= 0 and all(e.tag in INLINE for e in stack[place + 1 :]):
                while len(stack) > place:
                    yield "close", stack.pop(), ""
        element = _element(tag, _names(attributes), stack[-1] if stack else None)
        stack.append(element)
        yield "open", element, ""
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if tag == "title":
                yield "text", element, html[at : end.start() if end else len(html)]
            at = end.end() if end else len(html)
            yield "close", stack.pop(), ""
    while stack:
        yield "close", stack.pop(), ""


def _text_token(element: Element | None, text: str) -> int:
    """A stretch of text is a token of its own below its element."""
    return xxhash.xxh64_intdigest(f"{element.token if element else 0}>{text}") >> 1 & ~1


def page_tokens(html: str) -> tuple[Counter, Counter]:
    """How often each token stands on a page, and how much text is in named elements.

    Token 0 is the page itself. Text in elements that their tag leaves out has no
    weight. A named element that holds a main element or the heading holds all text.
    """
    found: Counter = Counter({0: 1})
    weights: Counter = Counter({0: 0})
    holders: set[int] = set()
    for kind, element, text in read(html):
        if kind == "open":
            found[element.token] += 1
            if element.named and (element.tag == "h1" or element.tag in MAIN):
                holders.update(element.named)
        elif kind == "text":
            if flat := BLANK.sub(" ", text).strip():
                found[_text_token(element, flat)] += 1
                if not (element and element.outside):
                    weights[0] += len(flat)
                    for token in element.named if element else ():
                        weights[token] += len(flat)
    for token in holders:
        weights[token] = weights[0] + 1
    return found, weights


def left_out_alone(html: str) -> frozenset[int]:
    """The named elements that are left out of a page of which no other page tells."""
    _, weights = page_tokens(html)
    return frozenset(t for t, weight in weights.items() if t and 2 * weight <= weights[0])


def main_text(
    html: str, classes: dict[int, int], left_out: frozenset[int] | None = None, few: bool = True
) -> str:
    """The main text of a page, by the classes of its host's template tokens.

    ``left_out`` has the host's named elements that are left out, None if no other
    page tells them; ``few`` says that the host has few pages.
    """
    tokens = list(read(html))
    has_main = any(kind == "open" and e.main for kind, e, _ in tokens)
    if left_out is None:
        # Most pages have no named element in them.
        named = any(kind == "open" and e.named for kind, e, _ in tokens)
        left_out = left_out_alone(html) if named else frozenset()
    nested = _template_places(tokens, classes)

    kept: set[int] = set()
    slots: list[int] = []
    for i, (kind, element, text) in enumerate(tokens):
        if kind != "text" or has_main and not (element and element.main):
            continue
        if element and (element.outside or any(t in left_out for t in element.named)):
            continue
        kept.add(i)
        if i not in nested and not text.isspace():
            slots.append(i)
    if few or not slots:
        pass
    elif not has_main:
        kept -= nested
    else:
        around = {tokens[i][1].block for i in slots}
        kept -= {
            i
            for i in kept & nested
            if not (slots[0] < i < slots[-1] and tokens[i][1].block in around)
        }

    blocks: list[str] = []
    block: list[str] = []

    def close() -> None:
        flat = BLANK.sub(" ", "".join(block)).strip()
        if flat:
            blocks.append(flat)
        block.clear()

    for i, (kind, element, text) in enumerate(tokens):
        if kind == "text":
            if i in kept:
                block.append(unescape(text) if "&" in text else text)
        elif kind == "break" or element.tag not in INLINE:
            close()
    close()
    return "\n".join(blocks)


def _template_places(
    tokens: list[tuple[str, Element | None, str]], classes: dict[int, int]
) -> set[int]:
    """Places of a page's tokens that are the template's."""
    if not classes:
        return set()
    places = []
    for i, (kind, element, text) in enumerate(tokens):
        if kind == "open":
            places.append((i, element.token))
        elif kind == "text" and (flat := BLANK.sub(" ", text).strip()):
            places.append((i, _text_token(element, flat)))
    return _nested(places, classes)


def _nested(tokens: list[tuple[int, int]], classes: dict[int, int]) -> set[int]:
    """Places of the template tokens whose classes nest.

    Classes are taken from the one with most tokens on. One is dropped if its copies
    neither lie in one gap of a class taken before nor have that class's copies in one of theirs.
    """
    places: dict[int, list[tuple[int, int]]] = {}
    for i, token in tokens:
        if token in classes:
            places.setdefault(classes[token], []).append((i, token))
    taken: list[np.ndarray] = []
    for _, own in sorted(places.items(), key=lambda item: (-len(item[1]), item[0])):
        spots = _copies(own)
        if all(_in_one_gap(spots, other) or _in_one_gap(other, spots) for other in taken):
            taken.append(spots)
    return {i for spots in taken for i in spots.ravel().tolist()}


def _copies(own: list[tuple[int, int]]) -> np.ndarray:
    """The places of a class, a row for each time its tokens stand there in the same order."""
    spots = np.array([i for i, _ in own])
    row = [token for _, token in own]
    width = len(set(row))
    if 1 < width < len(row) and row == row[:width] * (len(row) // width):
        return spots.reshape(-1, width)
    return spots[None, :]


def _in_one_gap(inner: np.ndarray, outer: np.ndarray) -> bool:
    gaps = np.searchsorted(outer.ravel(), inner)
    return bool((gaps == gaps[:, :1]).all())


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(found, r"^.*@", ""))


def templates(pages: DataFrame, support: float = SUPPORT, least: int = LEAST_TOKENS) -> DataFrame:
    """For each host of several pages their number, and the template's tokens and the class of each.

    ``pages`` has host and html. Only tokens on two pages or more go on
    from the first aggregate, and only those on nearly all pages of a host are
    listed, which are at most a little more than a page has; so are the named elements
    that are left out, at most ten times what a page has, as a class without a vector.
    """

    def tokens(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            both = [page_tokens(html) for html in texts(part, "html")]
            found = [f for f, _ in both]
            rows = pa.array(np.repeat(np.arange(part.num_rows), [len(f) for f in found]))
            yield pa.RecordBatch.from_pydict(
                {
                    "host": part.column("host").take(rows),
                    "content": part.column("content").take(rows),
                    "token": pa.array([t for f in found for t in f], pa.int64()),
                    "n": pa.array([n for f in found for n in f.values()], pa.int32()),
                    "weight": pa.array([w[t] for f, w in both for t in f], pa.int64()),
                }
            )

    hashed = pages.select("host", "html", F.xxhash64("host", "html").alias("content"))
    repeated = hashed.groupBy("content").count().where("count > 1")
    # A filter of fixed size: what it does not pass stands in the table once.
    words = filter_of(repeated, "content")
    shared = pages.sparkSession.sparkContext.broadcast(words)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied = passes(shared.value, batch.column("content").to_numpy())
            yield from tokens(batch.filter(pa.array(~copied)))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied = passes(shared.value, batch.column("content").to_numpy())
            yield batch.filter(pa.array(copied))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from tokens(batch)

    schema = "host string, content bigint, token bigint, n int, weight bigint"
    seen = hashed.mapInArrow(released(once), schema)
    if words.any():
        different = hashed.mapInArrow(released(copies), hashed.schema).dropDuplicates(["host", "content"])
        seen = seen.unionByName(different.mapInArrow(released(run), schema))
    vectors = (
        seen.groupBy("host", "token")
        .agg(
            F.bit_xor(F.xxhash64("content", "n")).alias("vector"),
            F.count("*").alias("pages"),
            F.sum("weight").alias("weight"),
        )
        .where("pages >= 2")
    )
    vectors = materialize(vectors, "template-vectors")
    everywhere = vectors.where("token = 0").select(
        "host", F.col("pages").alias("host_pages"), F.col("weight").alias("host_weight")
    )
    several = vectors.where("token != 0").join(everywhere, "host")
    frequent = several.where(F.col("pages") >= support * F.col("host_pages"))
    classes = frequent.groupBy("host", "host_pages", "vector", "pages").agg(
        F.collect_list("token").alias("tokens")
    )
    valid = classes.where(F.size("tokens") >= least).select("host", "host_pages", "vector", "tokens")
    named = several.where(
        (F.col("token") % 2 == 1)
        & (F.col("pages") >= NAMED_SUPPORT * F.col("host_pages"))
        # Of all its pages, so that an element on a few of them is not taken for small.
        & (2 * F.col("weight") * F.col("host_pages") <= F.col("host_weight") * F.col("pages"))
    )
    left_out = named.groupBy("host", "host_pages").agg(F.collect_list("token").alias("tokens"))
    left_out = left_out.withColumn("vector", F.lit(None).cast("bigint"))
    # A host of several pages has a row even if nothing is left out there.
    told = everywhere.select("host", "host_pages", F.array().cast("array<bigint>").alias("tokens"))
    told = told.withColumn("vector", F.lit(None).cast("bigint"))
    listed = (
        valid.unionByName(left_out)
        .unionByName(told)
        .groupBy("host", "host_pages")
        .agg(F.collect_list(F.struct(F.col("vector").alias("class"), "tokens")).alias("classes"))
    )
    return materialize(listed, "templates")


def extract(pages: DataFrame, support: float = SUPPORT, least: int = LEAST_TOKENS) -> DataFrame:
    """A row for each page: page_id, url, text and its length in code points."""
    hosted = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    joined = hosted.join(templates(hosted, support, least), "host", "left")

    def prepare() -> BatchFunction:
        known: dict[str, tuple[dict[int, int], frozenset[int] | None, bool]] = {}

        def template_of(host: str, pages: int | None, listed: list[dict] | None):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                every = listed or []
                classes = {t: c["class"] for c in every if c["class"] is not None for t in c["tokens"]}
                left_out = frozenset(t for c in every if c["class"] is None for t in c["tokens"])
                known[host] = classes, left_out if pages else None, (pages or 1) < LEAST_PAGES
            return known[host]

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            hosts, column = batch.column("host").to_pylist(), batch.column("classes")
            pages = batch.column("host_pages").to_pylist()
            found = []
            for i, (host, html) in enumerate(zip(hosts, texts(batch, "html"), strict=True)):
                listed = None if host in known else column[i].as_py()
                found.append(main_text(html, *template_of(host, pages[i], listed)))
            return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

        return run

    return add_columns(
        joined, "text string, n_chars bigint", prepare, drop=["host", "html", "host_pages", "classes"]
    )

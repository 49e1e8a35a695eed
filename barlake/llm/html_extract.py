"""Main text of web pages by wrappers: union-free regular expressions per host.

The token streams of a host's pages are aligned one with the other. A tag found
in one stream only becomes optional; tags that come again, or in another order,
become a repeated group; texts that differ become a text slot. A node has one child
for each sign, so a wrapper is a set of places (hashed paths of signs) with what
fills them: Spark's aggregates align the pages' wrappers as rows (host, place) with
those flags, and no task holds a whole host or its wrapper.

A text that is no slot, on MIN_PAGES pages of a host or more, is template text. It is left
out, as is what stands in elements that hold no article: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments. Headings of an article are never
template, and a page whose text is template for the most part (pages that are copies but
for a title) keeps it all.
"""

from __future__ import annotations

import html
import operator
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import read_table, small_batches, stored, typed

#: Pages that a text must fill the same place of to count as template text.
MIN_PAGES = 3
#: A page keeps all its text where template places hold three quarters of it, or half of
#: it and more than so many words: its host's pages are then near copies.
MANY_WORDS = 50
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
#: Elements that end an open paragraph and part blocks of text.
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose content is no article.
NO_ARTICLE = frozenset("""script style noscript template iframe object embed svg math canvas audio video head title
    nav footer aside form menu dialog button select textarea input label fieldset search""".split())
#: Words in a class, id or role that mark the same.
MARKS = frozenset("""ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion
    banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription
    signup login paywall sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar
    header masthead topbar footer foot bottombar copyright comment comments commentlist disqus reply replies respond
    discussion social share sharing related recommended recommendations widget widgets search skip hidden""".split())
#: Start of these ends an open one of those, up to the given borders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
        "body": ({"head"}, set()), "article": ({"nav"}, set()), "main": ({"nav"}, set())}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# One attribute by the browsers' rules: a stray quote is part of a name, a quoted
# value runs to its quote, or to the page's end.
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*)|(?=>)))?""")
_GAP = re.compile(r"[\s/]*")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def attributes_at(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from behind its name on (the first of a name counts),
    and where the tag's ``>`` stands; the page's size where it has none."""
    found: dict[str, str] = {}
    while True:
        at = _GAP.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            return found, at
        one = _ATTRIBUTE.match(page, at)
        found.setdefault(one[1].lower(), one[2] or one[3] or one[4] or "")
        at = one.end()


def tokens(page: str) -> Iterator[tuple[str, str, object]]:
    """("start", name, (attributes, closed by a slash)), ("end", name, "") and ("text",
    "", text). A tag that the page's end cuts off is dropped, as browsers do."""
    at, size = 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            yield "text", "", html.unescape(page[at:])
            return
        if begin > at:
            yield "text", "", html.unescape(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(page, begin)
        if not tag:
            yield "text", "", "<"
            at = begin + 1
            continue
        name = tag[2].lower()
        attributes, close = attributes_at(page, tag.end())
        if close >= size:
            return
        at = close + 1
        if tag[1]:
            yield "end", name, ""
            continue
        slash = page[close - 1] == "/"
        yield "start", name, (attributes, slash)
        if name in RAW and not slash:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if not close:
                at = size
            else:
                at = close.start()


class Element:
    """``out``: what it holds is no article."""
    __slots__ = ("children", "name", "out", "sign")

    def __init__(self, name: str, sign: str, out: bool = False):
        self.name, self.sign, self.out, self.children = name, sign, out, []


def marked(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element holds no article, by its name, class, id or role."""
    if name in NO_ARTICLE or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    words = {w.lower() for key in ("class", "id", "role") for w in _WORD.findall(attributes.get(key, ""))}
    if name in ("article", "main"):
        return bool(words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "related", "teaser"})
    return name not in ("html", "body") and bool(words & MARKS)


def parse(page: str) -> Element:
    """A tree of elements and texts, of any depth. An element's sign is its name with
    its classes, after a ``!`` where it holds no article."""
    root = Element("", "")
    stack = [root]
    for kind, name, value in tokens(page):
        if kind == "text":
            stack[-1].children.append(value)
        elif kind == "start":
            if name in BLOCK and name != "br":
                for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if stack[i].name == "p":
                        del stack[i:]
                        break
                    if stack[i].name in BLOCK:
                        break
            if name in ENDS:
                ended, border = ENDS[name]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in border:
                        break
                    if stack[i].name in ended:
                        del stack[i:]
                        break
            attributes, slash = value
            out = marked(name, attributes) or name == "header" and not any(e.name in ("article", "main") for e in stack)
            # numbers in classes (post-1234) name a page, not a place
            classes = f".{_DIGITS.sub('', attributes['class'])}" if attributes.get("class") else ""
            element = Element(name, "!" * out + " ".join(f"{name}{classes}".split()), out)
            stack[-1].children.append(element)
            # a slash doesn't close an HTML block
            if name not in VOID and (name in BLOCK or not slash):
                stack.append(element)
        else:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if stack[i].name in ("article", "main", "body") and name not in ("html", "body", "article", "main"):
                    break
    return root


# -- wrappers -----------------------------------------------------------------
# A node is [sign, pages, text, groups]: ``text`` is the hash of a text that is
# alike on all pages, None for a slot, "" for an element. A group is [nodes,
# repeated, optional] and has a node for each sign found in it.

def _groups(nodes: list[list]) -> list[list]:
    """A page's child list as groups with one node for each sign: a stretch
    between two of a sign becomes a repeated group."""
    where: dict[str, int] = {}
    out: list[list] = []
    for node in nodes:
        at = where.get(node[0])
        if at is None:
            where[node[0]] = len(out)
            out.append([[node], False, False])
            continue
        for other in out[at + 1:]:
            out[at][0].extend(other[0])
        del out[at + 1:]
        out[at][1] = True
        for n in out[at][0]:
            where[n[0]] = at
            if n[0] == node[0]:
                _merge(n, node, max)
    return out


def wrapper_of(root: Element) -> list:
    """The wrapper of one page."""
    order, made = [root], {}
    for element in order:
        order.extend(c for c in element.children if isinstance(c, Element))
    for element in reversed(order):
        nodes = []
        for child in element.children:
            if isinstance(child, Element):
                nodes.append(made.pop(id(child)))
            elif words := child.split():
                nodes.append(["#", 1, xxhash.xxh3_64_hexdigest(" ".join(words)), []])
        made[id(element)] = [element.sign, 1, "", _groups(nodes)]
    return made[id(root)]


def _merge(into: list, other: list, pages) -> None:
    """Align ``other`` with ``into``. ``pages`` joins their numbers of pages:
    ``max`` within a page, where a place has one list of texts, the sum across pages."""
    waiting = [(into, other)]
    while waiting:
        into, other = waiting.pop()
        into[1] = pages(into[1], other[1])
        if into[2] != other[2]:
            into[2] = xxhash.xxh3_64_hexdigest(into[2] + other[2]) if pages is max else None
        into[3] = _align(into[3], other[3], waiting)


def _align(left: list, right: list, waiting: list) -> list:
    """Align two lists of groups. Groups that share a sign are one; those that
    stand in another order are one repeated group; one-sided ones are optional.
    Nodes of one sign go to ``waiting``, to be aligned in their turn."""
    spot = {n[0]: i for i, (nodes, _, _) in enumerate(left) for n in nodes}
    blocks: list[list[int]] = []  # first and last group on the left, the same on the right
    for j, (nodes, _, _) in enumerate(right):
        own = [spot[n[0]] for n in nodes if n[0] in spot]
        if own:
            block = [min(own), max(own), j, j]
            while blocks and blocks[-1][1] >= block[0]:
                low, high, begin, _ = blocks.pop()
                block = [min(low, block[0]), max(high, block[1]), begin, j]
            blocks.append(block)
    out, i, j = [], 0, 0
    for low, high, begin, end in [*blocks, [len(left), len(left) - 1, len(right), len(right) - 1]]:
        out += [[nodes, repeated, True] for nodes, repeated, _ in left[i:low] + right[j:begin]]
        lefts, rights = left[low:high + 1], right[begin:end + 1]
        i, j = high + 1, end + 1
        if not lefts:
            continue
        nodes = {n[0]: n for g in lefts for n in g[0]}
        for node in (n for g in rights for n in g[0]):
            if node[0] in nodes:
                waiting.append((nodes[node[0]], node))
            else:
                nodes[node[0]] = node
        one = len(lefts) == len(rights) == 1
        flags = [g[2] for g in lefts + rights]
        out.append([list(nodes.values()), not one or lefts[0][1] or rights[0][1], any(flags) if one else all(flags)])
    return out


def align(wrappers: Iterable[list]) -> list | None:
    """One wrapper of many, aligned one after the other."""
    out = None
    for w in wrappers:
        if out is None:
            out = w
        else:
            _merge(out, w, operator.add)
    return out


def as_regex(node: list) -> str:
    """A wrapper as a readable expression; ``#`` is a text slot."""
    inner = "".join(
        (f"({body})" if len(nodes) > 1 or repeated or optional else body) + "+" * repeated + "?" * optional
        for nodes, repeated, optional in node[3]
        for body in ["".join(as_regex(n) + "?" * (len(nodes) > 1) for n in nodes)])
    if node[0] == "#":
        return "#" if node[2] is None else "text"
    return f"<{node[0]}>{inner}</{node[0].split('.')[0].lstrip('!')}>" if node[0] else inner


ROOT = 0


def place_id(parent: int, sign: str) -> int:
    """The place of a sign below a place."""
    return int.from_bytes(xxhash.xxh3_64_digest(f"{parent}\x1f{sign}"), "big", signed=True)


def wrapper_rows(wrapper: list) -> Iterator[tuple[int, int, str, bool, bool, str | None, int]]:
    """(place, parent's place, sign, repeated, optional, text, pages) of a wrapper's nodes;
    texts (sign ``#``) carry their hash, or null as a slot."""
    waiting = [(wrapper, ROOT)]
    while waiting:
        node, parent = waiting.pop()
        for nodes, repeated, optional in node[3]:
            for n in nodes:
                place = place_id(parent, n[0])
                yield place, parent, n[0], repeated, optional or len(nodes) > 1 and n[1] < node[1], n[2], n[1]
                if n[0] != "#":
                    waiting.append((n, place))


def template_places(wrapper: list | None) -> set[int]:
    """Elements' places filled by the same text on all pages that have them, MIN_PAGES or
    more. None where no text differs: the pages are then copies of one."""
    texts = [r for r in wrapper_rows(wrapper) if r[2] == "#"] if wrapper else []
    return {r[1] for r in texts if r[5] is not None and r[6] >= MIN_PAGES} if any(r[5] is None for r in texts) else set()


def main_text(root: Element, template: set[int] = frozenset()) -> str:
    """The article's blocks in page order, each with single spaces, joined by a space."""
    inside = _has_article(root)
    out: list[str] = []
    # (element, its place, within an article, next child); a text is taken at once
    open_ = [(root, ROOT, False, iter(root.children))]
    while open_:
        element, place, taken, children = open_[-1]
        for child in children:
            if isinstance(child, Element):
                if not child.out:
                    out.append(" " if child.name in BLOCK else "")
                    open_.append((child, place_id(place, child.sign), taken or child.name in ("article", "main"),
                                  iter(child.children)))
                    break
                if child.name in BLOCK:
                    out.append(" ")
            elif (taken or not inside) and (place not in template or element.name in HEADINGS):
                out.append(child)
        else:
            open_.pop()
            out.append(" " if element.name in BLOCK else "")
    return " ".join("".join(out).split())


def _has_article(root: Element) -> bool:
    waiting = [root]
    while waiting:
        element = waiting.pop()
        if element.name in ("article", "main"):
            return True
        waiting.extend(c for c in element.children if isinstance(c, Element) and not c.out)
    return False


def extract(page: str, template: set[int] = frozenset()) -> str:
    """Main text of a page without its host's template places, unless they hold most
    of it (see MANY_WORDS)."""
    root = parse(page)
    whole = main_text(root)
    rest = main_text(root, template) if template else whole
    most = 4 * len(rest) <= len(whole) or 2 * len(rest) <= len(whole) and whole.count(" ") - rest.count(" ") > MANY_WORDS
    return whole if most else rest


# -- hosts --------------------------------------------------------------------

def with_host(pages: DataFrame) -> DataFrame:
    """Lower-case host of the url; pages without one share an empty host."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return (typed(pages, page_id="bigint", url="string", html="string").withColumn("host", host)
            .withColumn("version", F.xxhash64("html")))


PLACE_SCHEMA = "host string, version bigint, place bigint, parent bigint, sign string, repeated boolean, content bigint"


def page_places(pages: DataFrame) -> DataFrame:
    """The rows of the wrappers of pages with a host; ``content`` is the hash of a text.
    Copies of a page count once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, version, page in zip(*(batch.column(c).to_pylist() for c in ("host", "version", "html")), strict=True):
                rows += [(host, version, place, parent, sign, repeated, int(text, 16) - (1 << 63) if sign == "#" else None)
                         for place, parent, sign, repeated, _, text, _ in wrapper_rows(wrapper_of(parse(page)))]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds, strict=True)],
                names=[x.split()[0] for x in PLACE_SCHEMA.split(", ")])

    return (pages.where("host <> '' and html is not null").select("host", "version", "html")
            .mapInArrow(run, PLACE_SCHEMA).dropDuplicates(["host", "version", "place"]))


def merged_places(places: DataFrame) -> DataFrame:
    """All pages of a host aligned: a row for each place with its number of pages, whether
    it's repeated on one, and whether its text is a slot (null for elements).
    Aggregates are partial before the shuffle, so a host of many pages costs a task a row
    for each place."""
    return places.groupBy("host", "place").agg(
        F.first("parent").alias("parent"), F.first("sign").alias("sign"), F.count(F.lit(1)).alias("pages"),
        F.max("repeated").alias("repeated"), (F.min("content") != F.max("content")).alias("slot"))


def host_wrappers(merged: DataFrame) -> DataFrame:
    """The wrappers' rows with the optional flag: a place that not all pages of its
    parent have (every page has the root's)."""
    above = merged.select("host", F.col("place").alias("parent"), F.col("pages").alias("of"))
    most = merged.groupBy("host").agg(F.max("pages").alias("all_pages"))
    return (merged.join(above, ["host", "parent"], "left").join(most, "host")
            .withColumn("optional", F.col("pages") < F.coalesce("of", "all_pages")).drop("of", "all_pages"))


def host_template(merged: DataFrame) -> DataFrame:
    """(host, place) of the elements whose text is template (``template_places``)."""
    slots = merged.where("slot").select("host").distinct()
    return (merged.where((F.col("sign") == "#") & ~F.col("slot") & (F.col("pages") >= MIN_PAGES))
            .join(slots, "host", "left_semi").select("host", F.col("parent").alias("place")))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html) with the main text.

    A null page counts as empty; a page without any article text gets an empty
    string. Markup of any depth and with any attributes is read as browsers do. Pages without a host have no wrapper and rely on their elements
    alone. Null ids and urls stay null, repeated rows each give a row, extra
    columns are ignored, an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    pages = with_host(pages)
    schema = "page_id bigint, url string, text string, n_chars bigint, host string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page or "", set(template or ())) for page, template in zip(
                batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), batch.column("host")],
                names=[x.split()[0] for x in schema.split(", ")])

    places = stored(page_places(pages), "places")
    template = host_template(stored(merged_places(places), "wrappers"))
    # a page's own template places only, however many its host has
    own = (places.where("sign = '#'").select("host", "version", F.col("parent").alias("place"))
           .join(template, ["host", "place"]).groupBy("host", "version").agg(F.collect_list("place").alias("template")))
    return (pages.join(own, ["host", "version"], "left").select("page_id", "url", "html", "host", "template")
            .mapInArrow(run, schema))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))

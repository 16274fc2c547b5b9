"""Main text of web pages by wrappers: union-free regular expressions over token streams.

A page is a stream of tokens: tags, named with their class, and texts. Streams of one host are aligned one after the
other. A text that differs becomes a slot; a stretch of tokens that only one side has becomes an optional group; a stretch
that stands several times in a row becomes a repeated group. What results is the host's wrapper. Folding a stream before
it is aligned makes the wrapper independent of how often a group repeats.

Wrappers of one host are aligned like pages, so each task first folds its own pages and only one wrapper of each host and
task travels. A text node keeps the texts that stand there on every page so far; a slot keeps none. Each page is then
matched against its host's wrapper: its text is what falls on slots of the part of the template that holds the article.
Texts of the template itself (that most pages of a host repeat at the same place) go, whatever their tags are called.
Slots that tags announce as menus, headers, footers, sidebars, notices, adverts, forms or comments go too; on a host of one
page, which repeats nothing, these names are all there is to tell by.
"""

from __future__ import annotations

import hashlib
import html as html_entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.store import stored

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
                    re.S)
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "xmp")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_NAMED = re.compile(r"(?:\s|^)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike "
                    "strong sub sup time tt u var wbr img".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_OUTSIDE = frozenset("nav header footer aside form button select option label menu dialog head title".split())
_OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|aside|footer|"
    r"masthead|header|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|social|share|sharing|related|recommended|"
    r"comments?|replies|reply|disqus|login|signup|search|toolbar|pagination|pager|widget|legal|copyright|skip)(?:$|[\s_-])", re.I)
_INSIDE = frozenset(("article", "main"))
_INSIDE_NAMES = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body-?text)(?:$|[\s_-])", re.I)
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                    "section table ul".split())
LONGEST_GROUP = 24   # tokens of a group that may repeat
SHORT = 32           # characters of a text that stands for itself in a wrapper; longer ones are hashed
# Least share of an article's characters on slots; with less, its pages are copies of each other and repeat no template.
ON_SLOTS_NAMED, ON_SLOTS = 0.5, 0.1   # in a named article element, on a whole page


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """('open' | 'close' | 'text', name or text) in page order; scripts, styles, comments and the like are left out.

    An opening tag is named with the words of its class, id and role. A page cut off inside a tag loses that tag.
    """
    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", page[at:]
            return
        if mark > at:
            yield "text", page[at:mark]
        m = _TOKEN.match(page, mark)
        if not m:
            if re.match(r"</?[a-zA-Z]", page[mark:mark + 3]):
                return
            yield "text", "<"
            at = mark + 1
            continue
        at = m.end()
        if m[1] is not None:
            yield "text", html_entities.escape(m[1])
        elif m[3]:
            name = m[3].lower()
            if m[2]:
                yield "close", name
                continue
            named = {k.lower(): next((v for v in (a, b, c) if v), "") for k, a, b, c in _NAMED.findall(m[4])} if m[4] else {}
            words = " ".join(x for x in (named.get("class"), named.get("id"), named.get("role")) if x)
            if "hidden" in named or named.get("aria-hidden") == "true":
                words += " hidden-notice"
            yield "open", f"{name} {words}".strip()
            if name in _RAW:
                stop = _RAW_END[name].search(page, at)
                at = stop.start() if stop else end


class Stream:
    """A page as structural tokens, and its texts by the block they stand in."""

    def __init__(self, page: str):
        self.signs: list[str] = []
        self.texts: list[tuple[tuple[str, ...], str]] = []   # open elements, text of one block
        stack: list[str] = []
        piece: list[str] = []

        def flush() -> None:
            text = " ".join(html_entities.unescape("".join(piece)).split())
            piece.clear()
            if text:
                path = tuple(x for x in stack if x.split(" ", 1)[0] not in _INLINE)
                self.texts.append((path, text))
                self.signs.append("#")

        def close(names: tuple[str, ...], barrier: tuple[str, ...] = ("table", "ul", "ol", "dl", "article", "div", "section")) -> None:
            for i in range(len(stack) - 1, -1, -1):
                name = stack[i].split(" ", 1)[0]
                if name in names:
                    for gone in reversed(stack[i:]):
                        if gone.split(" ", 1)[0] not in _INLINE:
                            self.signs.append("/" + gone.split(" ", 1)[0])
                    del stack[i:]
                    return
                if name in barrier:
                    return

        for kind, value in tokens(page):
            if kind == "text":
                piece.append(value)
                continue
            name = value.split(" ", 1)[0]
            if name in _INLINE:
                # Inline marks neither end a block nor add a space; only those that announce themselves count.
                if kind == "open" and " " in value and _OUTSIDE_NAMES.search(value.split(" ", 1)[1]):
                    flush()
                    stack.append(value)
                elif kind == "close" and stack and stack[-1].split(" ", 1)[0] == name:
                    flush()
                    stack.pop()
                continue
            flush()
            if kind == "close":
                if any(x.split(" ", 1)[0] == name for x in stack):
                    close((name,), ())
                continue
            if name in _ENDS_P:
                close(("p",))
            if name in _CLOSES:
                close(_CLOSES[name])
            self.signs.append(value)
            if name not in _VOID:
                stack.append(value)
        flush()


# ["tag", sign] | ["text", texts on every page: None, one or a list] | ["opt", nodes, pages if not one] | ["rep", nodes]
Node = list


def _key(node: Node) -> str:
    """What two nodes must share to stand for each other in an alignment."""
    return node[1] if node[0] == "tag" else "#" if node[0] == "text" else "(" + "".join(_key(n) for n in node[1] if n[0] != "opt")


def fold(nodes: list[Node]) -> list[Node]:
    """Stretches that stand several times in a row become one repeated group, shortest stretches first."""
    for size in range(1, LONGEST_GROUP + 1):
        if 2 * size > len(nodes):
            break
        keys, out, i = [_key(n) for n in nodes], [], 0
        while i < len(nodes):
            times = 1
            while keys[i + times * size:i + (times + 1) * size] == keys[i:i + size]:
                times += 1
            if times > 1 and (size > 1 or nodes[i][0] != "rep"):
                group = nodes[i:i + size]
                for t in range(1, times):
                    group = align(group, nodes[i + t * size:i + (t + 1) * size], within=True)
                out.append(["rep", group])
                i += times * size
            elif times > 1:   # neighbouring repeated groups of one kind are one
                group = nodes[i]
                for t in range(1, times):
                    group = ["rep", align(group[1], nodes[i + t][1], within=True)]
                out.append(group)
                i += times
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


Entry = tuple[Node, bool, int]   # node, is it optional, pages that have it


def _flat(nodes: list[Node], pages: int) -> list[Entry]:
    out = []
    for node in nodes:
        if node[0] == "opt":
            out += [(n, True, node[2] if len(node) > 2 else 1) for n in node[1]]
        else:
            out.append((node, False, pages))
    return out


def _pairs(left: list[Entry], right: list[Entry]) -> Iterator[tuple[Entry | None, Entry | None]]:
    """Entries of two sides that stand for each other, in order; None where a side has no counterpart."""
    keys_l, keys_r = [_key(x[0]) for x in left], [_key(x[0]) for x in right]
    if keys_l == keys_r:
        yield from zip(left, right, strict=True)
        return
    for step, a, b, c, d in SequenceMatcher(None, keys_l, keys_r, autojunk=False).get_opcodes():
        if step == "equal":
            yield from zip(left[a:b], right[c:d], strict=True)
            continue
        # A group on one side may be the same group, repeated, on the other.
        if b - a == 1 and left[a][0][0] == "rep" and [_key(n) for n in left[a][0][1]] == keys_r[c:d]:
            yield left[a], _grouped(right[c:d])
        elif d - c == 1 and right[c][0][0] == "rep" and [_key(n) for n in right[c][0][1]] == keys_l[a:b]:
            yield _grouped(left[a:b]), right[c]
        else:
            yield from ((x, None) for x in left[a:b])
            yield from ((None, y) for y in right[c:d])


def _grouped(entries: list[Entry]) -> Entry:
    return ["rep", [n for n, _, _ in entries]], any(opt for _, opt, _ in entries), min(n for _, _, n in entries)


def align(left: list[Node], right: list[Node], pages: tuple[int, int] = (1, 1), within: bool = False) -> list[Node]:
    """The smallest expression of this kind that takes what either side takes.

    ``pages`` are the pages that the sides stand for; ``within`` is for two stretches of one page, whose texts add up.
    """
    out: list[Node] = []
    for x, y in _pairs(_flat(left, pages[0]), _flat(right, pages[1])):
        if x is None or y is None:
            node, opt, n = (x or y)[0], True, (x or y)[2]
        else:
            node, opt, n = _same(x, y, within), x[1] or y[1], 1 if within else x[2] + y[2]
        out.append(node if not opt else ["opt", [node]] if n == 1 else ["opt", [node], n])
    return out


def _same(x: Entry, y: Entry, within: bool) -> Node:
    (a, _, pages_a), (b, _, pages_b) = x, y
    if a[0] == "rep":
        return ["rep", align(a[1], b[1], (pages_a, pages_b), within)]
    if a[0] == "tag":
        return a
    if within:
        a[1].extend(b[1])
        return a
    return ["text", _value(constants(a) & constants(b))]


def constants(node: Node) -> set[str]:
    """Texts that stand at a text node on every page that has it."""
    return set() if node[1] is None else {node[1]} if isinstance(node[1], str) else set(node[1])


def _value(texts: set[str]) -> None | str | list[str]:
    return None if not texts else next(iter(texts)) if len(texts) == 1 else sorted(texts)


def short(text: str) -> str:
    """What stands for a whole text in a wrapper."""
    return text if len(text) <= SHORT else hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def page_nodes(stream: Stream) -> list[Node]:
    """The folded page; its text nodes list the numbers of their texts."""
    at = iter(range(len(stream.texts)))
    return fold([["text", [next(at)]] if s == "#" else ["tag", s] for s in stream.signs])


def page_wrapper(stream: Stream) -> list[Node]:
    def named(nodes: list[Node]) -> list[Node]:
        return [n if n[0] == "tag" else ["text", _value({short(stream.texts[i][1]) for i in n[1]})] if n[0] == "text"
                else [n[0], named(n[1])] for n in nodes]

    return named(page_nodes(stream))


def of_template(node: Node, seen: int, pages: int) -> set[str]:
    """Texts of a node that belong to the template: on every page that has the node, two at least and most of the host."""
    return constants(node) if seen > 1 and 2 * seen > pages else set()


def template_texts(wrapper: list[Node], pages: int, stream: Stream) -> set[int]:
    """Numbers of the page's texts that are the template's own: those that do not fall on slots of its host's wrapper.

    Where a page's own tags stand around a text, it has a place of its own in the wrapper; there a text counts as the
    template's if the wrapper has it elsewhere in the same open elements.
    """
    known = {(path, text) for path, node, n, _ in text_nodes(wrapper, pages) for text in of_template(node, n, pages)}
    found = {i for i, (path, text) in enumerate(stream.texts) if (path, short(text)) in known}

    def walk(left: list[Node], right: list[Node], seen: int) -> None:
        for x, y in _pairs(_flat(left, seen), _flat(right, 1)):
            if x is None or y is None:
                continue
            if x[0][0] == "text":
                texts = of_template(x[0], x[2], pages)
                found.update(i for i in y[0][1] if texts and short(stream.texts[i][1]) in texts)
            elif x[0][0] == "rep":
                walk(x[0][1], y[0][1], x[2])

    walk(wrapper, page_nodes(stream), pages)
    return found


def outside(path: tuple[str, ...] | list[str]) -> bool:
    """Do the open elements announce something that is not article text?"""
    for element in path:
        name, _, words = element.partition(" ")
        if name in _OUTSIDE or (words and name not in _INSIDE and name not in ("body", "html") and _OUTSIDE_NAMES.search(words)):
            return True
    return False


def text_nodes(wrapper: list[Node], pages: int) -> Iterator[tuple[tuple[str, ...], Node, int, bool]]:
    """Open elements, node and pages of each text node, and whether it lies in a repeated group."""
    path: list[str] = []

    def walk(nodes: list[Node], seen: int, repeated: bool) -> Iterator[tuple[tuple[str, ...], Node, int, bool]]:
        for node, _, n in _flat(nodes, seen):
            kind, value = node[0], node[1]
            if kind == "tag":
                if value.startswith("/"):
                    for i in range(len(path) - 1, -1, -1):
                        if path[i].split(" ", 1)[0] == value[1:]:
                            del path[i:]
                            break
                elif value.split(" ", 1)[0] not in _VOID:
                    path.append(value)
            elif kind == "rep":
                yield from walk(value, n, True)
            else:
                yield tuple(path), node, n, repeated

    return walk(wrapper, pages, False)


def template(wrapper: list[Node], pages: int) -> tuple[dict[str, int], bool]:
    """Text slots of each element that may hold the article, by its sign; and has the template texts of its own outside
    of what its tags announce?"""
    found: dict[str, int] = {}
    own = False
    for path, node, n, repeated in text_nodes(wrapper, pages):
        if outside(path):
            continue
        fixed = bool(of_template(node, n, pages))
        own = own or fixed
        for element in {*path}:
            name, _, words = element.partition(" ")
            if name in _INSIDE or _INSIDE_NAMES.search(words):
                found[element] = found.get(element, 0) + (repeated or not fixed)
    return found, own


def article_element(found: dict[str, int]) -> str | None:
    """The element of the template that holds the article: ``article`` before ``main`` before others; None: the page."""
    def rank(element: str) -> tuple:
        name = element.split(" ", 1)[0]
        return (not found[element], name != "article", name != "main", -found[element], element)

    return min(found, key=rank) if found else None


def article_text(stream: Stream, element: str | None, fixed: set[int] = frozenset()) -> str:
    """Texts in the host's article element (or in an element of that kind, or on the page), less what lies outside and less
    the template's own texts ``fixed``."""
    inside = [(i, path, text) for i, (path, text) in enumerate(stream.texts) if not outside(path)]
    least = ON_SLOTS_NAMED
    for wanted in (lambda x: x == element, lambda x: x.split(" ", 1)[0] in _INSIDE):
        chosen = [(i, text) for i, path, text in inside if any(wanted(x) for x in path)]
        if chosen:
            break
    else:
        chosen, least = [(i, text) for i, _, text in inside], ON_SLOTS
    slots = [text for i, text in chosen if i not in fixed]
    if sum(map(len, slots)) < least * sum(len(text) for _, text in chosen):
        slots = [text for _, text in chosen]
    return " ".join(slots)


def host_of(url: str = "url") -> Column:
    """Host of a url, lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of a batch to one wrapper for each host; pages of equal texts count once."""
    for batch in batches:
        own: dict[str, list[Node]] = {}
        seen: dict[str, int] = {}
        known: set[tuple[str, bytes]] = set()
        for host, page in zip(batch.column("_host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            stream = Stream(page or "")
            texts = hashlib.blake2b(digest_size=16)
            for part in (*stream.signs, *(text for _, text in stream.texts)):
                texts.update(part.encode("utf-8", "replace") + b"\0")
            if (host, texts.digest()) in known:
                continue
            known.add((host, texts.digest()))
            node = page_wrapper(stream)
            own[host] = align(own[host], node, (seen[host], 1)) if host in own else node
            seen[host] = seen.get(host, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(own)), pa.array([json.dumps(w) for w in own.values()]),
                                          pa.array([seen[h] for h in own], pa.int64())], ["_host", "wrapper", "pages"])


def _merge(table: pa.Table) -> pa.Table:
    wrapper: list[Node] | None = None
    pages = 0
    for text, n in sorted({*zip(table["wrapper"].to_pylist(), table["pages"].to_pylist(), strict=True)}):
        other = json.loads(text)
        wrapper = other if wrapper is None else align(wrapper, other, (pages, n))
        pages += n
    found, own = template(wrapper, pages)
    return pa.table({"_host": table["_host"][:1], "wrapper": [json.dumps(wrapper)], "pages": [pages],
                     "element": pa.array([article_element(found)], pa.string()), "own": [own]})


def host_wrappers(pages: DataFrame) -> DataFrame:
    """_host, wrapper (JSON), pages (of different texts), element (that holds the article) and own (has the template texts
    of its own that no tag announces?) of each host."""
    partial = pages.select(host_of().alias("_host"), "html").mapInArrow(_fold_pages, "_host string, wrapper string, pages long")
    return partial.groupBy("_host").applyInArrow(
        _merge, "_host string, wrapper string, pages long, element string, own boolean")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, read = [], {}
        columns = [batch.column(c).to_pylist() for c in ("html", *HOST)]
        for page, element, wrapper, pages in zip(*columns, strict=True):
            stream, fixed = Stream(page or ""), frozenset()
            if wrapper is not None:   # without texts of its own, all that lies in the element falls on slots
                if wrapper not in read:
                    read[wrapper] = json.loads(wrapper)
                fixed = template_texts(read[wrapper], pages, stream)
            texts.append(article_text(stream, element, fixed))
        kept = [n for n in batch.schema.names if n not in ("html", *HOST)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])


HOST = ("_element", "_wrapper", "_pages")


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, ...) with ``text`` and ``n_chars`` in place of the markup.

    Null and empty html give an empty text. Pages without a host form one host of their own. Repeated rows are extracted
    each. Columns of ``pages`` with the added names are replaced.
    """
    base = pages.drop("text", "n_chars", "element", "_host", *HOST)
    hosts = stored(host_wrappers(base).select("_host", F.col("element").alias("_element"), F.when(
        F.col("own"), F.col("wrapper")).alias("_wrapper"), F.col("pages").alias("_pages")), "wrappers")
    joined = base.withColumn("_host", host_of()).join(hosts, "_host", "left").drop("_host")
    schema = joined.drop("html", *HOST).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    return joined.mapInArrow(_extract, schema)

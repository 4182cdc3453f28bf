"""Main text of web pages by template deduction from equivalence classes (operator 5).

A page is a list of tokens: tags (name, class, id and role) and the text runs between them.
A close tag takes the role of the element that it closes. For each host, tokens are grouped by
their occurrence vectors over all its pages. Only the combined hash of its (page, number of
occurrences) is kept for each token, so equal vectors are found without bringing a host's pages
together. Pages without tokens do not count. A second pass over the pages checks the classes: a
tag stays in its class if its elements nest and if it always follows the same tag of the class (round about, for classes with
several occurrences in a page); other tags leave it. The classes of tags with one occurrence in
nearly every page (``SUPPORT``) are the skeleton of the host's template. Its elements cut each page into slots, and
elements of the other classes cut these further, wherever they stand.

The same pass sums up text and link text of each slot over the host's pages. Slots made of
links are boilerplate, as are those that are named as menus, headers, footers, notices,
adverts, forms and the like, and text runs that belong to the template. The main slot is the
named main element; without one it is found in the skeleton, by going down to the slot that
holds nearly all of the text that is left.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.llm.common import bounded_batches, stored, utf8

# What the parts of a page are called.
MAIN_NAMES = {"article", "main"}
MAIN_MARKS = re.compile(r"\b(article-?body|post-?content|entry-?content|main-?content)\b")
BOILERPLATE_NAMES = {
    *("head", "title", "style", "script", "noscript", "template", "iframe", "svg", "canvas"),
    *("nav", "header", "footer", "aside", "form", "button", "select", "option", "textarea"),
    *("menu", "dialog", "object", "embed", "audio", "video"),
}
_MARK = (
    r"(?:ads?|advert[^\W_]*|sponsor[^\W_]*|promo[^\W_]*|banner|cookies?|consent|gdpr|notices?|alert|"
    r"newsletter|subscri[^\W_]*|nav[^\W_]*|menu|breadcrumbs?|sidebar|side|rail|related|recommend[^\W_]*|share|"
    r"sharing|social|comments?|disqus|respond|responses?|replies|footer|header|masthead|popup|modal|login|"
    r"signup|search[^\W_]*|pagination|pager|toolbar|widget)"
)
_BOX = (
    r"(?:area|bar|blocks?|bottom|box|buttons?|container|form|global|icons?|info|inner|items?|law|left|"
    r"links?|list|main|outer|page|panel|posts?|primary|right|row|secondary|sections?|site|slot|thread|"
    r"top|unit|wrap|wrapper|zone|\d\w*)"
)
#: Whole class names: a mark, also with the name of a place or a box ("site-nav", "comment-list").
BOILERPLATE_MARKS = re.compile(
    rf"(?<!\S)(?:{_BOX}[_-]+)*{_MARK}(?:[_-]+(?:{_MARK}|{_BOX}))*(?!\S)"
)
#: Elements that hold whole pages or articles, whatever their class says.
UNMARKED = {"html", "body", "main", "article"}
BLOCK_NAMES = {
    *("p", "div", "section", "article", "main", "body", "html", "table", "tr", "td", "th", "ul"),
    *("ol", "li", "dl", "dt", "dd", "pre", "blockquote", "figure", "figcaption", "hr", "address"),
    *("h1", "h2", "h3", "h4", "h5", "h6", "header", "footer", "nav", "aside", "form", "fieldset"),
    *("details", "summary", "caption", "thead", "tbody", "tfoot"),
}
VOID_NAMES = {
    *("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source"),
    *("track", "wbr"),
}
RAW_NAMES = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
#: What stands once in this share of a host's pages is part of its template: a page may be cut,
#: or of another kind.
SUPPORT = 0.75
#: Texts of less pages than this show no template: two pages may just quote the same.
TEXT_SUPPORT = 3
#: Share of a host's pages that must have a tag for it to count as frequent.
FREQUENT = 0.05
#: Share of its pages in which a tag must nest and keep its place in its class.
VALID = 0.75
#: A slot is judged by its text if it stands in at least so many pages.
SLOT_PAGES = 3
#: A slot is boilerplate from this share of link text, and the main slot from this share of text.
LINKED, MOST_TEXT = 0.5, 0.75
#: Elements that end where their parent does or where the next one starts.
OPEN_ENDED = {*("html", "body", "p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "option")}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements of running text.
RUNNING_TEXT = HEADINGS | {"p", "li", "dt", "dd", "td", "th", "pre", "blockquote", "figcaption", "caption"}
#: Elements whose content is a slot; the others are parts of running text.
CONTAINERS = (
    BLOCK_NAMES - HEADINGS
    - {"p", "li", "dt", "dd", "pre", "blockquote", "figure", "figcaption", "hr", "caption", "summary"}
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in RAW_NAMES}


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


# Pages repeat their tags and template texts: what these are is worked out once.
@functools.lru_cache(maxsize=1 << 16)
def _key(kind: str, name: str, marks: str, value: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(f"{kind} {name} {marks} {value}"))


@functools.lru_cache(maxsize=1 << 16)
def _is_boilerplate(name: str, marks: str) -> bool:
    return name in BOILERPLATE_NAMES or bool(
        marks
        and name not in UNMARKED
        and BOILERPLATE_MARKS.search(marks)
        and not MAIN_MARKS.search(marks)
    )


@functools.lru_cache(maxsize=1 << 16)
def _is_main(name: str, marks: str) -> bool:
    return name in MAIN_NAMES or bool(marks and MAIN_MARKS.search(marks))


def _text_key(text: str) -> int:
    """Identity of a text run, white space folded; 0 if there is nothing else."""
    folded = _SPACE.sub(" ", text).strip()
    return _signed(xxhash.xxh3_64_intdigest(f"t   {folded}")) if folded else 0


class Token:
    """A tag or a text run of a page."""

    __slots__ = ("kind", "name", "marks", "value")

    def __init__(self, kind: str, name: str, marks: str, value: str):
        self.kind, self.name, self.marks, self.value = kind, name, marks, value

    @property
    def key(self) -> int:
        """The token's identity in templates, as a signed 64-bit hash."""
        return _key(self.kind, self.name, self.marks, self.value)

    @property
    def boilerplate(self) -> bool:
        return _is_boilerplate(self.name, self.marks)

    @property
    def main(self) -> bool:
        return _is_main(self.name, self.marks)


def tokens_of(page: str) -> list[Token]:
    """Tags and text runs in page order; comments and declarations are dropped."""
    out, at = [], 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            out.append(Token("t", "", "", text))
        if not found:
            break
        at = found.end()
        slash, name, rest = found.groups()
        if name is None:
            continue
        name = name.lower()
        marks = " ".join(
            (a or b or c).lower() for _, a, b, c in _NAMED.findall(rest or "")
        )
        if slash:
            out.append(Token("c", name, "", ""))
            continue
        out.append(Token("o", name, marks, ""))
        if name in _RAW_END and not (rest or "").rstrip().endswith("/"):
            close = _RAW_END[name].search(page, at)
            end = close.start() if close else len(page)
            if end > at:
                out.append(Token("r", name, "", page[at:end]))
            at = end
    return out


def tag_roles(tokens: list[Token]) -> tuple[list[int], list[bool]]:
    """Key of each tag, and whether its element nests; stray close tags and texts have key 0.

    A close tag has the marks of the element that it closes.
    """
    keys, nests = [0] * len(tokens), [True] * len(tokens)
    stack: list[_Element] = []
    at: list[int] = []
    for i, token in enumerate(tokens):
        if token.kind == "o":
            keys[i] = _key("o", token.name, token.marks, "")
            if token.name in VOID_NAMES:
                continue
            if token.name in ("p", "li"):
                _close(stack, token.name, within=True)
                del at[len(stack) :]
            stack.append(_Element(token, False, False, False))
            at.append(i)
        elif token.kind == "c":
            before = list(stack)
            _close(stack, token.name)
            if len(stack) < len(before):
                keys[i] = _key("c", token.name, before[len(stack)].token.marks, "")
                for cut in at[len(stack) + 1 :]:
                    nests[cut] = tokens[cut].name in OPEN_ENDED
                del at[len(stack) :]
    for cut in at:
        nests[cut] = tokens[cut].name in OPEN_ENDED
    return keys, nests


def page_vector(page: str) -> dict[int, tuple[int, str, bool]]:
    """Occurrences, kind and nesting of each token of a page; white space in texts is folded."""
    counts: dict[int, tuple[int, str, bool]] = {}
    tokens = tokens_of(page)
    for token, key, nests in zip(tokens, *tag_roles(tokens), strict=True):
        if token.kind == "t":
            key = _text_key(token.value)
        if key:
            n, _, all_nest = counts.get(key, (0, "", True))
            counts[key] = (n + 1, token.kind, all_nest and nests)
    return counts


def class_order(tokens: list[Token], classes: dict[int, int]) -> dict[int, int]:
    """The tag of its class that each tag follows, 0 if not always the same one.

    The first tag of a class follows the last one, so that repetitions look alike.
    """
    before: dict[int, int] = {}
    ends: dict[int, list[int]] = {}
    for key in tag_roles(tokens)[0]:
        if key not in classes:
            continue
        end = ends.get(classes[key])
        if end is None:
            ends[classes[key]] = [key, key]
            continue
        before[key] = end[1] if before.get(key, end[1]) == end[1] else 0
        end[1] = key
    for first, last in ends.values():
        before[first] = last if before.get(first, last) == last else 0
    return before


def slot_texts(tokens: list[Token], template: Template) -> dict[tuple[int, ...], list[int]]:
    """Text and link text of each slot outside named boilerplate, in characters.

    A slot is the path of the class elements around it.
    """
    sums: dict[tuple[int, ...], list[int]] = {}
    for token, stack in _walk(tokens, template):
        if token.kind == "t" and not any(e.skip for e in stack):
            folded = _SPACE.sub(" ", token.value).strip()
            if folded and _text_key(folded) not in template.texts:
                sizes = sums.setdefault(stack[-1].slot if stack else (), [0, 0])
                sizes[0] += len(folded)
                sizes[1] += len(folded) * any(e.token.name == "a" for e in stack)
    return sums


class Template:
    """What a host's pages share: valid classes, the skeleton's tags, texts, and judged slots."""

    def __init__(self, classes: list[dict], slots: list[dict] | None = None):
        self.skeleton: set[int] = set()
        self.texts: set[int] = set()
        self.classes: dict[int, int] = {}
        for c in classes:
            for key in c["tags"]:
                self.classes[key] = c["vector"]
            if c["once"]:
                self.skeleton.update(c["tags"])
                self.texts.update(c["texts"])
        self.linked: set[tuple[int, ...]] = set()
        self.main_slot: tuple[int, ...] = ()
        self._judge(slots or [])

    def _judge(self, slots: list[dict]) -> None:
        sums: dict[tuple[int, ...], list[int]] = {}
        found: list[tuple[tuple[int, ...], int]] = []
        for s in slots:
            path: tuple[int, ...] = ()
            for key in s["path"]:
                # Tags that have left their class cut nothing.
                if key in self.classes and path[-1:] != (key,):
                    path += (key,)
            found.append((path, s["chars"]))
            for n in range(1, len(path) + 1):
                size = sums.setdefault(path[:n], [0, 0, 0])
                size[0] = max(size[0], s["pages"])
                size[1] += s["chars"]
                size[2] += s["links"]
        self.linked = {
            path for path, (pages, chars, links) in sums.items()
            if pages >= SLOT_PAGES and links >= LINKED * chars
        }
        left: dict[tuple[int, ...], int] = {}
        for path, chars in found:
            if not any(path[:n] in self.linked for n in range(1, len(path) + 1)):
                for n in range(len(path) + 1):
                    left[path[:n]] = left.get(path[:n], 0) + chars
        slot: tuple[int, ...] = ()
        while True:
            inner = [
                p for p in left
                if len(p) == len(slot) + 1 and p[:-1] == slot and p[-1] in self.skeleton
                and sums[p][0] >= SLOT_PAGES and left[p] >= MOST_TEXT * left[slot]
            ]
            if not inner:
                break
            slot = max(inner, key=lambda p: left[p])
        self.main_slot = slot


class _Element:
    __slots__ = ("token", "skip", "main", "skeleton", "slot")

    def __init__(
        self, token: Token, skip: bool, main: bool, skeleton: bool, slot: tuple[int, ...] = ()
    ):
        self.token, self.skip, self.main, self.skeleton = token, skip, main, skeleton
        self.slot = slot


def _walk(
    tokens: list[Token],
    template: Template,
    mains: set[int] = frozenset(),
    holders: set[int] = frozenset(),
) -> Iterator[tuple[Token, list[_Element]]]:
    """Each token with the elements that are open after it.

    ``holders`` are the elements around ``mains``: neither is boilerplate.
    """
    stack: list[_Element] = []
    for i, token in enumerate(tokens):
        if token.kind == "o" and token.name not in VOID_NAMES:
            if token.name in ("p", "li"):
                # An open paragraph or item ends where the next one starts.
                _close(stack, token.name, within=True)
            key = token.key
            slot = stack[-1].slot if stack else ()
            skip = token.boilerplate and i not in holders
            if token.name in CONTAINERS and key in template.classes and slot[-1:] != (key,):
                slot += (key,)
                skip = skip or (slot in template.linked and i not in mains and i not in holders)
            stack.append(_Element(token, skip, i in mains, key in template.skeleton, slot))
        elif token.kind == "c":
            _close(stack, token.name)
        yield token, stack


def _mains(tokens: list[Token], template: Template) -> tuple[set[int], set[int]]:
    """Places of the page's named main elements, and of the elements around them.

    All those of the skeleton, else all of the page. Elements in named boilerplate are no main
    elements; those in an element with the class of boilerplate are only if there are no others.
    """
    clean, marked = [], []
    around: dict[int, list[int]] = {}
    stack: list[_Element] = []
    at: list[int] = []
    for i, token in enumerate(tokens):
        if token.kind == "o" and token.name not in VOID_NAMES:
            if token.name in ("p", "li"):
                _close(stack, token.name, within=True)
                del at[len(stack) :]
            if token.main and not token.boilerplate:
                around[i] = list(at)
                if not any(e.skip for e in stack):
                    clean.append(i)
                elif not any(e.token.name in BOILERPLATE_NAMES for e in stack):
                    marked.append(i)
            skeleton = bool(template.skeleton) and token.key in template.skeleton
            stack.append(_Element(token, token.boilerplate, False, skeleton))
            at.append(i)
        elif token.kind == "c":
            _close(stack, token.name)
            del at[len(stack) :]
    found = clean or marked
    found = [i for i in found if tokens[i].key in template.skeleton] or found
    return set(found), {j for i in found for j in around[i]}


def main_text(page: str, template: Template) -> str:
    """The text in the main slots of a page, its blocks joined by empty lines.

    Text runs of the template that stand outside headings, paragraphs and other running text
    are left out, unless they are most of what there is: then the host's pages are copies of
    each other.
    """
    tokens = tokens_of(page)
    mains, holders = _mains(tokens, template)
    # Without a named main element, the main slot of the template, if the page has it.
    slot = () if mains else template.main_slot
    if slot:
        walked = _walk(tokens, template)
        if not any(stack and stack[-1].slot == slot for _, stack in walked):
            slot = ()
    block, runs = 0, []  # (block, text, whether it belongs to the template)
    running: set[int] = set()
    for token, stack in _walk(tokens, template, mains, holders):
        if token.kind in "oc":
            block += token.name in BLOCK_NAMES
            if token.kind == "o" and token.name == "br":
                runs.append((block, " ", False))
        elif (
            token.kind == "t"
            and (not mains or any(e.main for e in stack))
            and (
                not slot
                or bool(stack)
                and (stack[-1].slot[: len(slot)] == slot or any(e.token.name == "h1" for e in stack))
            )
            and not any(e.skip for e in stack)
        ):
            shared = bool(template.texts) and _text_key(token.value) in template.texts
            runs.append((block, html.unescape(token.value), shared))
            # Headings, paragraphs and the like are text of the article, however often they occur.
            if any(e.token.name in RUNNING_TEXT for e in stack):
                running.add(block)
    blocks: dict[int, list[str]] = {}
    own: set[int] = set()  # blocks with text that the template does not have
    for number, text, shared in runs:
        blocks.setdefault(number, []).append(text)
        if not shared and not text.isspace():
            own.add(number)
    sizes = {number: sum(map(len, parts)) for number, parts in blocks.items()}
    if 2 * sum(n for number, n in sizes.items() if number in own) >= sum(sizes.values()):
        blocks = {n: parts for n, parts in blocks.items() if n in own or n in running}
    texts = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def _close(stack: list[_Element], name: str, within: bool = False) -> None:
    """Close the nearest open element of that name and what is open in it.

    A tag that does not belong to the skeleton cannot close an element of the skeleton, so
    one unclosed or stray tag does not spoil the slots. With ``within``, only an element in
    the nearest enclosing block counts.
    """
    for i in range(len(stack) - 1, -1, -1):
        element = stack[i]
        if element.token.name == name:
            del stack[i:]
            return
        if element.skeleton and element.token.name in BLOCK_NAMES and (
            within or name not in BLOCK_NAMES
        ):
            return
        if within and element.token.name in BLOCK_NAMES:
            return


# --- Spark ------------------------------------------------------------------------------------

VECTORS = "host string, key long, kind string, n long, nests boolean, page_hash long"
SLOTS = "host string, key long, before long, path array<long>, pages long, chars long, links long"
CLASSES = "array<struct<vector: long, tags: array<long>, texts: array<long>, once: boolean>>"


def _page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct token of a page; ``page_hash`` is of (page, occurrences)."""
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
    for batch in batches:
        hosts, keys, sorts, counts, nested, hashes = [], [], [], [], [], []
        for row, host, page in zip(
            batch.column("row").to_pylist(),
            batch.column("host").to_pylist(),
            batch.column("_html"),
            strict=True,
        ):
            vector = page_vector(page.as_py().decode("utf-8", "replace"))
            if vector:
                # The page itself, as a token that each page has once.
                vector[0] = (1, "page", True)
            for key, (n, kind, nests) in vector.items():
                hosts.append(host)
                keys.append(key)
                sorts.append(kind)
                counts.append(n)
                nested.append(nests)
                hashes.append(_signed(xxhash.xxh3_64_intdigest(f"{row} {n}")))
        columns = (hosts, keys, sorts, counts, nested, hashes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["host", "key", "kind", "n", "nests", "page_hash"],
        )


def _templates(batch: pa.RecordBatch, known: dict[str, Template]) -> Iterator[Template]:
    """The template of each page; some are remembered, as pages of a host come in any order."""
    slots = "slots" in batch.schema.names
    for i, host in enumerate(batch.column("host").to_pylist()):
        if host not in known:
            if len(known) >= 64:
                known.pop(next(iter(known)))
            known[host] = Template(
                batch.column("classes")[i].as_py() or [],
                (batch.column("slots")[i].as_py() or []) if slots else [],
            )
        yield known[host]


def _page_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of tags in their classes (with a key) and sizes of slots (with a path)."""
    kinds = (pa.string(), *[pa.int64()] * 2, pa.list_(pa.int64()), *[pa.int64()] * 3)
    known: dict[str, Template] = {}
    for batch in batches:
        rows = []
        hosts = batch.column("host").to_pylist()
        for host, page, template in zip(hosts, batch.column("_html"), _templates(batch, known), strict=True):
            tokens = tokens_of(page.as_py().decode("utf-8", "replace"))
            for key, before in class_order(tokens, template.classes).items():
                rows.append((host, key, before, [], 1, 0, 0))
            for path, (chars, links) in slot_texts(tokens, template).items():
                rows.append((host, 0, 0, list(path), 1, chars, links))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["host", "key", "before", "path", "pages", "chars", "links"],
        )


def _classes(tokens: DataFrame) -> DataFrame:
    """``host`` and ``classes`` of tokens, by their vectors."""
    classes = tokens.groupBy("host", "vector").agg(
        F.collect_list(F.when(F.col("kind") != "t", F.col("key"))).alias("tags"),
        F.collect_list(F.when(F.col("kind") == "t", F.col("key"))).alias("texts"),
        F.max("once").alias("once"),
    )
    return classes.groupBy("host").agg(
        F.collect_list(F.struct("vector", "tags", "texts", "once")).cast(CLASSES).alias("classes")
    )


def host_templates(pages: DataFrame) -> DataFrame:
    """``host``, ``classes`` (valid tokens grouped by occurrence vector) and ``slots``.

    ``pages`` has ``row``, ``host`` and ``_html``. The hashes of (page, number), combined,
    stand for the vector. Rare tags and texts that are not once in nearly every page cannot be
    part of a template and are left out before they are gathered, as are tags that do not nest.
    """
    tokens = pages.mapInArrow(_page_tokens, VECTORS)
    vectors = stored(
        tokens.groupBy("host", "key", "kind").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("n") == 1).alias("single"),
            F.count_if("nests").alias("nested"),
            F.bit_xor("page_hash").alias("vector"),
        ).filter((F.col("kind") != "t") | (F.col("single") >= TEXT_SUPPORT)),
        "token-vectors",
    )
    total = vectors.filter(F.col("kind") == "page").select("host", F.col("pages").alias("_all"))
    frequent = stored(
        vectors.join(total, "host")
        .filter(
            F.when(F.col("kind") == "t", F.col("single") >= F.lit(SUPPORT) * F.col("_all")).otherwise(
                (F.col("pages") >= F.lit(FREQUENT) * F.col("_all"))
                & (F.col("nested") >= F.lit(VALID) * F.col("pages"))
            )
            & (F.col("kind") != "page")
        )
        .withColumn("once", F.col("single") >= F.lit(SUPPORT) * F.col("_all")),
        "frequent-tokens",
    )
    candidates = stored(_classes(frequent), "host-classes")
    found = stored(
        pages.join(candidates, "host")
        .select("host", "_html", "classes")
        .mapInArrow(_page_slots, SLOTS)
        .groupBy("host", "key", "before", "path")
        .agg(*(F.sum(c).alias(c) for c in ("pages", "chars", "links"))),
        "page-slots",
    )
    ordered = (
        found.filter(F.col("key") != 0)
        .groupBy("host", "key")
        .agg(
            F.sum("pages").alias("_pages"),
            F.max(F.when(F.col("before") != 0, F.col("pages"))).alias("_kept"),
        )
        .filter(F.col("_kept") >= F.lit(VALID) * F.col("_pages"))
        .select("host", "key")
    )
    tags = frequent.filter(F.col("kind") != "t").join(ordered, ["host", "key"], "left_semi")
    valid = tags.unionByName(frequent.filter(F.col("kind") == "t"))
    slots = (
        found.filter(F.col("key") == 0)
        .join(total, "host")
        .filter(F.col("pages") >= F.lit(FREQUENT) * F.col("_all"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("path", "pages", "chars", "links")).alias("slots"))
    )
    return _classes(valid).join(slots, "host", "left")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points); same-named columns are replaced.

    Null or empty pages have an empty text. Pages without a readable URL count as one host.
    A host with a single page has a template of that page's tags. Repeated pages are pages
    of their own. A page without a main element gives all its text outside boilerplate.
    ``pages`` must be read from a table, so that its rows have the same numbers each time.
    """
    bounded_batches(pages.sparkSession)
    new = ["text", "n_chars"]
    kept = pages.drop(*new)
    names = kept.columns
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    sent = kept.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("page"),
        host.alias("host"),
        utf8("html").alias("_html"),
    )
    templates = host_templates(
        sent.select(F.monotonically_increasing_id().alias("row"), "host", "_html")
    )
    # As a table, its size is known: Spark broadcasts it if it is small, else it can split
    # the pages of a large host in the join.
    joined = sent.join(stored(templates, "host-templates"), "host", "left").select(
        "page", "_html", "host", "classes", "slots"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            texts = [
                main_text(page.as_py().decode("utf-8", "replace"), template)
                for page, template in zip(batch.column("_html"), _templates(batch, known), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.column("page").flatten(),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[*names, *new],
            )

    schema = T.StructType(kept.schema.fields).add("text", T.StringType()).add("n_chars", T.LongType())
    return joined.mapInArrow(run, schema)

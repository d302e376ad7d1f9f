"""Main text of web pages by template deduction from the pages of a host.

Tokens are tags, told apart by their path from the root, and the text runs outside articles. Their
occurrence vectors say how often each stands in each page of the host. Tokens with equal vectors
form an equivalence class. A class belongs to the template if it occurs on most of the host's
different pages, at least `MIN_PAGES`, and nests: the parent of each of its tokens is in a class
that belongs to it, or in its own. Layouts that only some pages of a host have are told by classes on
at least `MIN_PAGES` of them, whatever their share, that hold a tag and at least `MIN_TOKENS` tokens;
a tag is on every page on which its children are, so these nest by themselves. Their text counts as template
on pages where it is at most half of the text outside the host's template: more is a copied article.
What is left between the template's tokens are slots. Text of the template is
dropped, and so are slots inside menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, told by tag and role. A class or id that is as a whole such a name counts as well, and so does
a dialog, unless its element has most of the text of its article, or of the page outside the template.
Hidden text and what media elements hold for readers without them stay. If the template has an article or main element
once on every page, only slots inside it are extracted; else, and on hosts with too few pages, an
article or main element of the page itself; else all slots that remain.

Vectors are compared by sums of hashes over pages, so they are aggregated like counts and never
held. Equal pages of a host count once. Text inside articles is never taken for template: articles
copied on many pages stay whole.

Blocks are joined by one space, white space inside a block becomes one space, character references
are decoded. Null and empty pages give an empty text, null urls are one host. Rows that repeat get
the same text. Broken markup ends where the page ends. Input columns named like an output column
are replaced.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plantlens.llm.common import fresh, join_hot, slices, stored, stored_bytes, without

MIN_PAGES = 4
MIN_TOKENS = 3
MOST = 0.8
BROADCAST_BYTES = 32 << 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp"}
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE) for name in RAW}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp "
    "s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover "
    "mstyle mpadded mphantom menclose semantics annotation".split()
)
# A start tag of the key ends an open element of the values.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "body"}
ENDS_P = set(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
DROPPED_TAGS = set(
    "head nav aside form footer select button menu datalist".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu".split())
# Names are whole classes or ids, alone or made of such words and numbers only.
FURNITURE = (
    r"(?:ads?|advert\w*|banner\w*|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|menu\w*|"
    r"modal|nav|navbar|navigation|newsletter|notices?|popup|promo\w*|related|sharing|share|sidebar|"
    r"social|sponsor\w*|subscribe|widget)"
)
BESIDE = r"(?:site|page|main|top|bottom|left|right|primary|secondary|global|box|list|bar|links?|posts?|area|section|\d+)"
DROPPED_NAMES = re.compile(
    rf"(?:^|\s)(?:{BESIDE}[_-])*{FURNITURE}(?:[_-](?:{FURNITURE}|{BESIDE}))*(?=$|\s)", re.IGNORECASE
)
OUTER_NAMES = re.compile(
    rf"(?:^|\s)(?:{BESIDE}[_-])*(?:header|masthead|topbar)(?:[_-]{BESIDE})*(?=$|\s)", re.IGNORECASE
)
NEVER_DROPPED = {"html", "body", "article", "main"}
TOKEN_FIELDS = "host string, page long, token long, parent long, is_text boolean, is_main boolean, n int"
TEMPLATE_FIELDS = "host string, pages long, main array<long>, fixed array<long>"


def attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    found = ATTRIBUTE.findall(raw)
    return {name.lower(): a or b or c for name, a, b, c in reversed(found)}


def is_dropped(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether an element is furniture of the page, by its tag or role."""
    if tag in DROPPED_TAGS or tag == "header" and not in_article:
        return True
    if not own:
        return False
    if tag in NEVER_DROPPED and not (tag == "article" and in_article):
        return False
    return own.get("role", "").lower() in DROPPED_ROLES


def is_named(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether class or id, or a dialog, speak for furniture, which is weak evidence."""
    if tag == "dialog":
        return True
    if not own or tag in NEVER_DROPPED and not (tag == "article" and in_article):
        return False
    names = f"{own.get('class', '')} {own.get('id', '')}"
    return bool(DROPPED_NAMES.search(names) or not in_article and OUTER_NAMES.search(names))


def is_main(tag: str, own: dict[str, str]) -> bool:
    return tag in ("article", "main") or own.get("role", "").lower() in ("main", "article")


class Scope:
    """The page, an article or an element named like furniture, with the size of its text."""

    __slots__ = ("above", "article", "named", "size", "depth", "gone")

    def __init__(self, above: Scope | None, article: Scope | None, named: bool):
        self.above, self.article, self.named = above, article or self, named
        self.size, self.depth, self.gone = 0, above.depth + 1 if above else 0, False


def weigh(scopes: set[Scope]) -> None:
    """Set `gone` where a name here or above counts: at most half of the article's or page's text."""
    known: set[Scope] = set()
    for scope in scopes:
        while scope is not None and scope not in known:
            known.add(scope)
            scope = scope.above
    ordered = sorted(known, key=lambda scope: scope.depth)
    for scope in reversed(ordered):
        if scope.above:
            scope.above.size += scope.size
    for scope in ordered:
        small = scope.named and 2 * scope.size <= scope.article.size
        scope.gone = small or scope.above is not None and scope.above.gone


class Element:
    """An open element; `path` is the hash of its path, `main` has those of its articles."""

    __slots__ = ("tag", "path", "parent", "dropped", "main", "scope")

    def __init__(self, tag: str, path: int, parent: int, dropped: bool, main: frozenset, scope: Scope):
        self.tag, self.path, self.parent = tag, path, parent
        self.dropped, self.main, self.scope = dropped, main, scope


def hash_of(parent: int, name: str) -> int:
    return xxhash.xxh64_intdigest(f"{parent}/{name}") >> 1


def events(page: str) -> Iterator[tuple[str, Element, str]]:
    """('open', element, ''), ('break', element, '') and ('text', element, raw text)."""
    root = Element("", 0, 0, False, frozenset(), Scope(None, None, False))
    stack = [root]
    at, end = 0, len(page)
    while at < end:
        less = page.find("<", at)
        token = TOKEN.match(page, less) if less >= 0 else None
        while less >= 0 and token is None:
            less = page.find("<", less + 1)
            token = TOKEN.match(page, less) if less >= 0 else None
        if less < 0:
            yield "text", stack[-1], page[at:]
            return
        if less > at:
            yield "text", stack[-1], page[at:less]
        at = token.end()
        # A tag with an odd quote is in the last three groups.
        slash, name, rest = token.groups()[:3] if token.group(2) else token.groups()[3:]
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if tag == "br":
                yield "break", stack[-1], ""
            close(stack, tag)
            if tag not in INLINE:
                yield "break", stack[-1], ""
            continue
        if tag not in INLINE:
            imply_ends(stack, tag)
            yield "break", stack[-1], ""
        if tag in VOID:
            continue
        own = attributes(rest)
        above = stack[-1]
        if tag == "svg" and rest.endswith("/"):
            continue
        if tag in RAW:
            closing = RAW_END[tag].search(page, at)
            at = closing.end() if closing else end
            continue
        if rest.endswith("/") and tag not in ("a", "p", "div", "span"):
            continue
        marked = f"{tag}.{own.get('class', '')}#{own.get('id', '')}" if own else tag
        element = Element(
            tag,
            hash_of(above.path, marked),
            above.path,
            above.dropped or is_dropped(tag, own, bool(above.main)),
            above.main,
            above.scope,
        )
        if is_named(tag, own, bool(above.main)):
            element.scope = Scope(above.scope, above.scope.article, True)
        if is_main(tag, own):
            element.main = above.main | {element.path}
            element.scope = Scope(element.scope, None, False)
        stack.append(element)
        yield "open", element, ""


def close(stack: list[Element], tag: str) -> None:
    """Leave the innermost open element of that name, if there is one."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return


def imply_ends(stack: list[Element], tag: str) -> None:
    """Leave the elements that a start tag ends without an end tag."""
    if tag in ENDS_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag not in INLINE:
                break
    if tag in ENDS:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ENDS[tag]:
                del stack[i:]
                break
            if stack[i].tag in SCOPES:
                break
    if tag in ("article", "main"):
        # These never stand inside furniture that someone forgot to close.
        while len(stack) > 1 and stack[-1].tag not in ("aside", "article"):
            if not (stack[-1].dropped or stack[-1].scope.named):
                break
            stack.pop()


def text_token(element: Element, value: str) -> int:
    return hash_of(element.path, "=" + " ".join(value.split()))


def page_tokens(page: str) -> dict[int, list]:
    """Tokens of a page: token -> [parent, is text, is an article element, count]."""
    found: dict[int, list] = {0: [0, False, False, 1]}
    for kind, element, value in events(page):
        if kind == "open":
            fresh = [element.parent, False, element.path in element.main, 0]
            found.setdefault(element.path, fresh)[3] += 1
        elif kind == "text" and not element.main and not value.isspace():
            found.setdefault(text_token(element, value), [element.path, True, False, 0])[3] += 1
    return found


def main_text(
    page: str, main: frozenset[int], fixed: frozenset[int], layout: frozenset[int] = frozenset()
) -> str:
    """The text of the slots that remain; `layout` has the texts of classes on some pages of the host."""
    slots: list[tuple[Element, str]] = []
    for kind, element, value in events(page):
        if kind == "text":
            if not element.dropped:
                slots.append((element, value))
                if not fixed or text_token(element, value) not in fixed:
                    element.scope.size += len("".join(value.split()))
        elif kind == "break":
            slots.append((element, ""))
    weigh({e.scope for e, _ in slots})
    slots = [(e, value) for e, value in slots if not value or not e.scope.gone]
    any_main = any(e.main for e, value in slots if value)
    if layout and not any_main:
        fixed = fixed | layout_of_page(slots, fixed, layout)
    inside = bool(main) and any(e.main & main for e, _ in slots)
    blocks: list[list[str]] = [[]]
    for element, value in slots:
        if not value:
            blocks.append([])
        elif inside:
            if element.main & main:
                blocks[-1].append(value)
        elif any_main:
            if element.main:
                blocks[-1].append(value)
        elif text_token(element, value) not in fixed:
            blocks[-1].append(value)
    joined = (" ".join(html_lib.unescape("".join(block)).split()) for block in blocks if block)
    return " ".join(text for text in joined if text)


def layout_of_page(slots: list[tuple[Element, str]], fixed: frozenset, layout: frozenset) -> frozenset:
    """`layout`, if its text is at most half of the text outside the template, else nothing."""
    size = own = 0
    for element, value in slots:
        token = text_token(element, value) if value else None
        if value and token not in fixed:
            letters = len("".join(value.split()))
            size += letters
            own += letters if token in layout else 0
    return layout if 2 * own <= size else frozenset()


# On Spark


def host_of(url: Column) -> Column:
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


def page_key(html: str) -> Column:
    return F.xxhash64(html)


def count_tokens(pages: DataFrame, html: str = "html", url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Tokens of the pages, and of the hosts with occurrence vectors, if on `MIN_PAGES` pages; stored."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for host, key, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for token, (parent, *rest) in page_tokens((page or "")).items():
                        rows.append((host, key, token, parent, *rest))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType.fromDDL(TOKEN_FIELDS)
    names, kinds = schema.names, to_arrow_schema(schema).types
    source = pages.select(
        host_of(F.col(url)).alias("host"), page_key(html).alias("page"), F.col(html).alias("html")
    )
    tokens = stored(source.mapInArrow(tokenise, schema).distinct(), "page-tokens")

    def vector(seed: int) -> Column:
        return F.sum(F.pmod(F.xxhash64(F.lit(seed), "page", "n"), F.lit(1 << 31))).alias(f"vector{seed}")

    counted = stored(
        tokens.groupBy("host", "token", "parent", "is_text", "is_main")
        .agg(
            F.count("*").alias("pages"), F.max("n").alias("most"), vector(1), vector(2)
        )
        .where((F.col("pages") >= MIN_PAGES) | (F.col("token") == 0)),
        "tokens",
    )
    root = F.when(F.col("token") == 0, F.col("pages"))
    hosts = stored(
        counted.groupBy("host").agg(F.max(root).alias("all"), F.count("*").alias("n")), "hosts"
    )
    met = join_hot(counted, hosts, ["host"], "n", F.col("token"), "inner")
    return tokens, stored(met.where(F.col("all") >= MIN_PAGES), "host-tokens")


def templates_of(met: DataFrame) -> DataFrame:
    """The template of each host: host, main (paths of article elements), fixed (text tokens)."""
    usual = met.where(F.col("pages") >= MOST * F.col("all"))
    return stored(usual.groupBy("host").applyInPandas(nest_classes, TEMPLATE_FIELDS), "templates")


def deduce_templates(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The templates of the hosts, as `templates_of` gives them."""
    return templates_of(count_tokens(pages, html, url)[1])


def layouts_of(tokens: DataFrame, met: DataFrame) -> DataFrame:
    """Texts of classes that only some pages of a host have: host, page, layout (text tokens), by page."""
    some = met.where(F.col("pages") < MOST * F.col("all"))
    vectors = ["host", "vector1", "vector2"]
    large = (
        some.groupBy(*vectors)
        .agg(F.count("*").alias("size"), F.every("is_text").alias("bare"))
        .where((F.col("size") >= MIN_TOKENS) & ~F.col("bare"))
    )
    texts = stored(some.where("is_text").join(large, vectors).select("host", "token", "pages"), "layouts")
    placed = tokens.where("is_text").select("host", "token", "page")
    if stored_bytes(texts) <= BROADCAST_BYTES:
        found = placed.join(F.broadcast(texts.drop("pages")), ["host", "token"])
    else:
        found = join_hot(placed, texts, ["host", "token"], "pages", F.col("page"), "inner")
    return stored(found.groupBy("host", "page").agg(F.collect_set("token").alias("layout")), "page-layouts")


def nest_classes(tokens: pd.DataFrame) -> pd.DataFrame:
    """The template of one host out of the tokens on most of its pages.

    There are no more of them than a page has tokens, over `MOST`.
    """
    classes = [group for _, group in tokens.groupby(["vector1", "vector2"], sort=True)]
    template, grown = {0}, True
    while grown:
        grown = False
        for group in classes:
            own = set(group["token"])
            if not own <= template and set(group["parent"]) <= template | own:
                template |= own
                grown = True
    inside = tokens[tokens["token"].isin(template)]
    main = inside[inside["is_main"] & (inside["most"] == 1)]
    fixed = inside[inside["is_text"]]
    return pd.DataFrame(
        {
            "host": [tokens["host"].iloc[0]],
            "pages": [int(tokens["pages"].max())],
            "main": [main["token"].tolist()],
            "fixed": [fixed["token"].tolist()],
        }
    )


def extract(
    pages: DataFrame,
    html: str = "html",
    url: str = "url",
    templates: DataFrame | None = None,
    layouts: DataFrame | None = None,
) -> DataFrame:
    """`pages` with `text` and `n_chars`; the html column is kept.

    Templates and layouts are those of `templates_of` and `layouts_of`, by default of these pages; where
    only templates are given, there are no layouts.
    """
    if templates is None:
        tokens, met = count_tokens(pages, html, url)
        templates, layouts = templates_of(met), layouts_of(tokens, met)
    base = without(pages, ["text", "n_chars"])
    host, key, main, fixed, layout, n_rows, page = (
        fresh(name, base) for name in ("_host", "_page", "_main", "_fixed", "_layout", "_rows", "_html")
    )
    hosted = base.withColumn(host, host_of(F.col(url))).withColumn(key, page_key(html))
    spread = F.xxhash64(html)
    keyed = templates.select(F.col("host").alias(host), F.col("main").alias(main), F.col("fixed").alias(fixed))
    joined = join_stored(hosted, hosted, templates, keyed, [host], n_rows, spread)
    if layouts is None:
        joined = joined.withColumn(layout, F.array().cast("array<long>"))
    else:
        of_page = layouts.select(F.col("host").alias(host), F.col("page").alias(key), F.col("layout").alias(layout))
        joined = join_stored(joined, hosted, layouts, of_page, [host, key], n_rows, F.rand(3))
    rest = base.columns
    ordered = joined.select(
        *(F.col(f"`{c}`") for c in rest), F.col(f"`{html}`").alias(page), main, fixed, layout
    )
    schema = T.StructType(
        [*base.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [
                    main_text(page or "", *(frozenset(tokens or ()) for tokens in sets))
                    for page, *sets in zip(*(c.to_pylist() for c in part.columns[-4:]), strict=True)
                ]
                lengths = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-4], pa.array(texts, pa.string()), lengths],
                    names=[*rest, "text", "n_chars"],
                )

    return ordered.mapInArrow(run, schema)


def join_stored(
    rows: DataFrame, hosted: DataFrame, kept: DataFrame, lookup: DataFrame, on: list[str], n_rows: str, spread: Column
) -> DataFrame:
    """Left join of a lookup made of the stored frame `kept`: broadcast if small, else hot keys are spread."""
    if stored_bytes(kept) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), on, "left")
    counts = hosted.groupBy(*on).agg(F.count("*").alias(n_rows))
    return join_hot(rows, stored(counts.join(lookup, on), "lookup"), on, n_rows, spread, "left")

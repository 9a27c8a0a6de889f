"""Main text of web pages: site templates are found by counting element subtrees per host.

One pass hashes the subtrees of every page and counts, per host, the page contents that hold each; subtrees found in many of a
host's contents are its template.  Pages with the same main text are one content, so copies of a page are no evidence,
and a subtree with most of a page's main text is never taken for its template.  A second pass reads the pages again, leaves out template subtrees and elements that are
menus, notices, forms and the like by their name, class or role, and joins the remaining blocks of the article (of ``main``, if the
articles hold less than half of its text).

Inside an article, names of classes decide on containers only, and only whole: ``comment-list`` goes, ``related-work`` stays.  Inside an article, a paragraph or heading is never taken for template: texts may be copied between pages.

Defined results: null or empty html gives an empty text; a null url has no host, so only element names count; repeated rows
count once for their host; truncated and unbalanced markup is read as far as it goes; an empty table gives an empty result.
Input columns may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import shielded, staged, unshielded
from tidegauge.llm.url_filter import url_parts

#: Elements whose content is never text of the page, up to their end tag.
_OPAQUE = "script|style|title|textarea|iframe|template|svg|math|object|select"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_OPAQUE})(?=[\s/>]).*?(?:</\1[^>]*(?:>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th tr caption figcaption summary address".split())
_CONTAINERS = frozenset("html body article main div section nav aside header footer form ul ol dl table thead tbody tfoot figure details dialog fieldset hgroup search menu".split())
_BLOCKS = _TEXT_BLOCKS | _CONTAINERS
#: A start tag of the key ends open elements of these names.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_ROOTS = frozenset(("html", "body", "article", "main", "head"))

_DROPPED = frozenset("head nav aside footer form menu dialog search".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_DROPPED_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos promotion cookie cookies
    consent gdpr notice notices popup overlay modal newsletter subscribe subscription signup paywall sidebar sidebars menu menus nav navbar navigation
    breadcrumb breadcrumbs footer comment comments disqus respond replies related recommended share sharing social widget widgets
    pagination pager toolbar login""".split()
)
_HEADS = frozenset("header masthead topbar".split())
#: Inside an article a container goes only if all parts of one of its names say so: these, and at least one of those above.
_PARTS = frozenset("box block list area section wrapper container inner outer item items top bottom left right main site page link links icons bar js".split())


def _is_dropped(name: str, attributes: str, in_article: bool) -> bool:
    if name in _DROPPED or name == "header" and not in_article:
        return True
    if name in _ROOTS:  # only a reader's comment may be an article of its own
        return name == "article" and any("comment" in (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(attributes) if k.lower() in ("class", "id"))
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in _DROPPED_ROLES:
            return True
        if key in ("class", "id") and not (in_article and name in _TEXT_BLOCKS):
            if in_article:
                if any(_says_so(part) for part in value.split()):
                    return True
            elif set(re.split(r"[^a-z]+", value)) & (_DROPPED_WORDS | _HEADS):
                return True
    return False


def _says_so(name: str) -> bool:
    """Whether a name is made of nothing but words of dropped elements and parts of pages: ``comment-list``, not ``related-work``."""
    words = {w for w in re.split(r"[^a-z]+", name) if w}
    return bool(words & _DROPPED_WORDS) and words <= _DROPPED_WORDS | _PARTS


class Page:
    """Blocks of text in order, and the elements they stand in.

    ``elements`` has (parent, hash of the subtree or None if it can't be template); ``blocks`` has (element, 2 within an
    article plus 1 within main, text).  Elements left out by name have no blocks, but their subtrees are hashed too.
    """

    def __init__(self, html: str):
        self.elements: list[list] = []
        self.blocks: list[tuple[int, int, str]] = []
        stack: list[tuple[str, int, int, bool, int]] = []  # name, element, start, dropped, in article (2) and main (1)
        words: list[str] = []
        opened: Counter[str] = Counter()  # an end tag of what is not open costs nothing

        def flush() -> None:
            if words:
                text = " ".join("".join(words).split())
                words.clear()
                if text and not (stack and stack[-1][3]):
                    self.blocks.append((stack[-1][1] if stack else -1, stack[-1][4] if stack else 0, text))

        def close(depth: int, stop: int) -> None:
            while len(stack) > depth:
                name, element, start, dropped, rank = stack.pop()
                opened[name] -= 1
                if element >= 0 and name not in _ROOTS and name in _BLOCKS and (name in _CONTAINERS or not rank) and self.elements[element][2] == start:
                    self.elements[element][1] = xxhash.xxh64_intdigest(html[start:stop].encode("utf-8", "surrogatepass")) - (1 << 63)

        def up_to(names) -> int | None:
            """Depth of the innermost open element of these names, not beyond a list, table or container of them."""
            if not any(opened[n] for n in names):
                return None
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in names:
                    return depth
                if stack[depth][0] in _CONTAINERS:
                    return None
            return None

        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                words.append(html_module.unescape(html[at : m.start()]))
            at = m.end()
            name = (m[3] or m[6] or "").lower()
            if not name:
                continue
            ending, attributes = m[2] or m[5], m[4] or m[7] or ""
            if ending:
                if name in _BLOCKS:
                    flush()
                if opened[name]:
                    close(next(d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), at)
                continue
            if name in _VOID:
                words.append("\n")
                continue
            if name in _BLOCKS or name == "head":
                flush()
                depth = up_to(("p",)) if name not in ("td", "th", "tr") else None
                if depth is not None:
                    close(depth, m.start())
                if name in _ENDS and (depth := up_to(_ENDS[name])) is not None:
                    close(depth, m.start())
                if name in ("body", "article", "main") and opened["head"]:
                    close(next(d for d, x in enumerate(stack) if x[0] == "head"), m.start())
                _, parent, _, dropped, rank = stack[-1] if stack else ("", -1, 0, False, 0)
                dropped = dropped or _is_dropped(name, attributes, rank > 0)
                rank |= 2 if name == "article" else 1 if name == "main" else 0
                opened[name] += 1
                self.elements.append([parent, None, m.start()])
                stack.append((name, len(self.elements) - 1, m.start(), dropped, rank))
            elif not attributes.endswith("/"):
                _, parent, _, dropped, rank = stack[-1] if stack else ("", -1, 0, False, 0)
                opened[name] += 1
                stack.append((name, parent, -1, dropped or bool(attributes) and _is_dropped(name, attributes, True), rank))
        if at < len(html):
            words.append(html_module.unescape(html[at:]))
        flush()
        close(0, len(html))

    def main(self) -> list[tuple[int, str]]:
        """Element and text of the blocks of the articles, of main if these have less than half of its text, else of the whole body."""
        in_articles = sum(len(text) for _, rank, text in self.blocks if rank & 2)
        in_main = sum(len(text) for _, rank, text in self.blocks if rank & 1)
        place = 2 if in_articles and 2 * in_articles >= in_main else 1 if in_main else 0
        return [(element, text) for element, rank, text in self.blocks if not place or rank & place]

    def content(self) -> int:
        """A hash of the main text."""
        blocks = "\n\n".join(text for _, text in self.main())
        return xxhash.xxh64_intdigest(blocks.encode("utf-8", "surrogatepass")) - (1 << 63)

    def _most(self, main: list[tuple[int, str]]) -> list[bool]:
        """Of each element, whether it holds more than half of the main text."""
        sizes = [0] * len(self.elements)
        for element, text in main:
            if element >= 0:
                sizes[element] += len(text)
        for element in range(len(sizes) - 1, -1, -1):
            if self.elements[element][0] >= 0:
                sizes[self.elements[element][0]] += sizes[element]
        total = sum(len(text) for _, text in main)
        return [2 * size > total for size in sizes]

    def subtrees(self) -> set[int]:
        """Hashes of the subtrees that can be template, but for those with most of the main text."""
        return {e[1] for e, most in zip(self.elements, self._most(self.main())) if e[1] is not None and not most}

    def text(self, template: frozenset[int] = frozenset()) -> str:
        """The main text without template subtrees; one that holds most of it stays as a whole."""
        main = self.main()
        if not template:
            return "\n\n".join(text for _, text in main)
        left: list[bool | None] = []  # False: template; True: held by a subtree that stays
        for (parent, subtree, _), most in zip(self.elements, self._most(main)):
            above = left[parent] if parent >= 0 else None
            left.append(most if above is None and subtree in template else above)
        return "\n\n".join(text for element, text in main if element < 0 or left[element] is not False)


def _contents_of_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, subtree, content`` of every page, and a row without a subtree for the page itself."""
    for batch in batches:
        found: set[tuple] = set()
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(html)
            content = page.content()
            found.add((host, None, content))
            found.update((host, h, content) for h in page.subtrees())
        columns = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["host", "subtree", "content"]
        )


def site_templates(pages: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """``host, subtrees`` from rows ``host, html``: subtrees in at least ``min_pages`` and ``min_share`` of the host's contents.

    A host has few of them: the mean number of subtrees in its pages divided by ``min_share`` at most.
    """
    known = pages.filter("host is not null and host <> '' and html is not null")
    found = known.select("host", "html").mapInArrow(_contents_of_subtrees, "host string, subtree bigint, content bigint")
    counts = found.distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
    counts = staged(counts.filter((F.col("pages") >= min_pages) | F.col("subtree").isNull()), "site-subtrees")
    sizes = counts.filter("subtree is null").select(F.col("host").alias("s_host"), F.col("pages").alias("host_pages"))
    often = counts.filter("subtree is not null").join(sizes, F.col("host") == F.col("s_host"))
    often = often.filter(F.col("pages") >= min_share * F.col("host_pages"))
    return often.groupBy("host").agg(F.collect_list("subtree").alias("subtrees"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html, subtrees = batch.column("html").to_pylist(), batch.column("subtrees").to_pylist()
        texts = [Page(h or "").text(frozenset(s or ())) for h, s in zip(html, subtrees)]
        carried = [n for n in batch.schema.names if n.startswith("in_")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in carried], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=[*carried, "text", "n_chars"],
        )


def extract_text(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    min_share: float = 0.3,
) -> DataFrame:
    """The input's columns but the html, plus ``text`` and ``n_chars`` (its code points)."""
    rows, inner = shielded(pages)
    host, _ = url_parts(F.col(inner[url_col]))
    rows = rows.withColumns({"host": F.when(host != "", host), "html": F.col(inner[html_col]).cast("string")})
    templates = staged(site_templates(rows, min_pages, min_share), "site-templates").withColumnRenamed("host", "t_host")
    carried = {name: i for name, i in inner.items() if name != html_col}
    rows = rows.join(templates, F.col("host") == F.col("t_host"), "left").select(*carried.values(), "html", "subtrees")
    schema = rows.select(*carried.values()).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extract, schema).select(*unshielded(carried, ["text", "n_chars"]), "text", "n_chars")

"""Article text by deducing each host's page template.

Tokens are tags told apart by their place in the tree, and text runs.  Tokens that
occur equally often on every page of a host form an equivalence class.  Large and
frequent classes whose tokens nest in one another make the template; what stands
between their tokens are slots.  The article is what is left in all slots, in
page order, without the parts that mark themselves as menu, advert, form or comments.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.url_filter import host_of
from pitwall.session import materialise

#: Pages of a host that show a token, and tokens in a class, for it to count.
SHARE, CLASS = 0.5, 3
#: Pages with the same text that make it part of the template, where pages differ otherwise.
TEXT_SHARE, TEXT_PAGES = 0.95, 10

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template svg iframe select".split())
#: What runs to the end of a page without its end tag, as it is no text.
CODE = set("script style".split())
BLOCK = set("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
            "thead tr ul".split())
NOT_ARTICLE = set("head nav footer aside form button dialog menu".split())
#: Words in class or id that mark a part as something else than the article.
MARKS = set("ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer "
            "form menu nav navbar navigation newsletter notice pagination popup promo related respond share sharing sidebar social "
            "sponsor sponsored subscribe".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass(slots=True)
class Event:
    """A tag (open or close) or a run of text, the path of elements it stands in, whether those rule it out,
    and whether they do so by their names, not by marks alone."""

    kind: str
    path: str
    text: str
    barred: bool
    named: bool


def events(page: str | None, wrappers: frozenset[str] = frozenset()) -> Iterator[Event]:
    """The tags and text runs of a page.  Unclosed and misnested elements are
    closed by what encloses them; a block closes an open paragraph.  Marks of the
    paths in ``wrappers`` rule nothing out."""
    page = page or ""
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # name, path, barred, named
    at, size = 0, len(page)

    def close(to: int) -> Iterator[Event]:
        while len(stack) > to:
            name, path, barred, named = stack.pop()
            yield Event("close", path, name, barred, named)

    while at < size:
        match = _TAG.search(page, at)
        start = match.start() if match else size
        if start > at:
            yield Event("text", stack[-1][1], page[at:start], *stack[-1][2:])
        if not match:
            break
        at = match.end()
        if not match[2]:
            continue
        name = match[2].lower()
        if match[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                yield from close(depth)
            elif name in ("p", "br"):
                yield Event("open", stack[-1][1], name, *stack[-1][2:])
            continue
        if name in RAW:
            if name != "svg" or not match[3].endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size if name in CODE else at
            yield Event("open", f"{stack[-1][1]}/{name}", name, True, True)
            yield Event("close", f"{stack[-1][1]}/{name}", name, True, True)
            continue
        if name in BLOCK:
            inner = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCK), 0)
            if inner and (stack[inner][0] == "p" or stack[inner][0] == name == "li"):
                yield from close(inner)
        words = {w for m in _MARKED.finditer(match[3]) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()) if w}
        mark = "".join("." + w for w in sorted(words & MARKS))
        _, above, barred, named = stack[-1]
        in_article = "/article" in above or "/main" in above
        path = f"{above}/{name}{mark}"
        named = named or name in NOT_ARTICLE or name == "header" and not in_article
        barred = barred or named or bool(mark) and path not in wrappers
        yield Event("open", path, name, barred, named)
        if name not in VOID and not match[3].endswith("/"):
            stack.append((name, path, barred, named))
        else:
            yield Event("close", path, name, barred, named)
    yield from close(1)


def blocks(found: Iterable[Event]) -> Iterator[tuple[str, str, bool, bool]]:
    """(path, text, barred, named) of the text blocks among a page's events, in page order:
    character references decoded, white space made one blank."""
    parts: list[str] = []
    place, ruled = "", (False, False)

    def flush() -> Iterator[tuple[str, str, bool, bool]]:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            yield place, text, *ruled

    for event in found:
        if event.kind == "text":
            if parts and (event.barred, event.named) != ruled:
                yield from flush()
            if not parts:
                place, ruled = event.path, (event.barred, event.named)
            parts.append(event.text)
        elif event.text in BLOCK:
            yield from flush()
        elif event.text == "br" and parts:
            parts.append(" ")
    yield from flush()


def _hash(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


def _marked(path: str) -> bool:
    return "." in path.rpartition("/")[2]


def _parents(path: str) -> Iterator[str]:
    while path:
        yield path
        path = path.rpartition("/")[0]


def page_tokens(page: str | None) -> tuple[list[tuple[str, int, int, bool, int]], int]:
    """Rows (token, count, characters of text inside, is text, 0) of one page, and a
    digest of its text.  The rows of elements with a mark have the characters of the
    whole page in place of the 0.  Only text that names of elements rule out is left
    aside; the digest is of the text that marks do not rule out on this page alone."""
    tags, inside, texts, kept, total = Counter(), Counter(), Counter(), [], 0

    def counted() -> Iterator[Event]:
        for event in events(page):
            if event.kind != "text":
                tags[("<" if event.kind == "open" else ">") + event.path] += 1
            yield event

    for path, text, _, named in blocks(counted()):
        if named:
            continue
        token = f"#{path} {_hash(text)}"
        texts[token] += 1
        kept.append((path, token))
        total += len(text)
        for above in _parents(path):
            inside[above] += len(text)
    mine = dict.fromkeys(token for path, token in kept if not any(_marked(p) and 2 * inside[p] <= total for p in _parents(path)))
    rows = [(token, n, inside[token[1:]] if token[0] == "<" else 0, False, total if token[0] == "<" and _marked(token) else 0) for token, n in tags.items()]
    rows += [(token, n, 0, True, 0) for token, n in texts.items()]
    return rows, xxhash.xxh3_64_intdigest("\n".join(mine).encode("utf-8", "surrogatepass")) >> 1


_TOKENS = "host string, page long, token string, n int, chars long, is_text boolean, total long, article long"


def tokens(pages: DataFrame) -> DataFrame:
    """The tokens of all pages; ``article`` is the digest of the page's text."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, page, html in zip(batch["host"], batch["page"], batch["html"]):
                found, digest = page_tokens(html)
                rows += [(host, page, *f, digest) for f in found]
            yield pd.DataFrame(rows, columns=["host", "page", "token", "n", "chars", "is_text", "total", "article"])

    return pages.mapInPandas(scan, _TOKENS)


def templates(pages: DataFrame, share: float = SHARE, least: int = CLASS) -> DataFrame:
    """(host, main, texts, wrappers): the path of the deepest template element around
    all slots (NULL where no template is found), the text tokens of the template, and
    the paths that have a mark but hold more than half of the text of their pages.
    A text belongs to the template if it is in one class with nested elements and stands
    in ``main``; text that comes and goes by itself is a slot's, however frequent.

    A token's occurrence vector is summed up as an order-free digest of its counts
    by page, so each task combines its own pages and a host with very many pages
    is one row for each token.
    """
    found = tokens(pages)
    per_token = materialise(found.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("support"), F.max("n").alias("most"), F.sum("chars").alias("chars"), F.first("is_text").alias("is_text"), F.sum("total").alias("total"),
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"), F.approx_count_distinct("article").alias("articles")))
    size = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    frequent = per_token.join(size, "host").filter((F.col("pages") > 1) & (F.col("support") >= share * F.col("pages")))
    classes = frequent.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size"))
    valid = materialise(frequent.join(classes, ["host", "vector"]).filter(F.col("size") >= least))
    # nesting: an element belongs to the template if its open and close tags are in one class, once on a page,
    # and so are those of all elements around it
    tag = valid.filter(~F.col("is_text") & (F.col("most") == 1)).select("host", "vector", F.substring("token", 1, 1).alias("side"), F.expr("substr(token, 2)").alias("path"), "chars")
    pairs = tag.groupBy("host", "path", "vector").agg(F.countDistinct("side").alias("sides"), F.max("chars").alias("chars")).filter("sides = 2")
    paths = pairs.groupBy("host").agg(F.collect_set("path").alias("paths"))  # frequent tokens: at most 1 / share of a page's
    around = "transform(sequence(2, size(split(path, '/'))), i -> array_join(slice(split(path, '/'), 1, i), '/'))"
    nested = pairs.join(paths, "host").filter(F.size(F.array_except(F.expr(around), "paths")) == 0)
    top = nested.groupBy("host").agg(F.max("chars").alias("top"))
    deep = nested.join(top, "host").filter((F.col("chars") > 0) & (F.col("chars") == F.col("top")))
    main = deep.groupBy("host").agg(F.max_by("path", F.struct(F.length("path") - F.length(F.translate("path", "/", "")), "chars", "path")).alias("main"))
    often = valid.filter(F.col("is_text") & (F.col("support") >= TEXT_SHARE * F.col("pages")) & (F.col("pages") >= TEXT_PAGES)
                         & (2 * F.col("articles") > F.col("pages")))
    inside = F.startswith(F.expr("substr(token, 2)"), F.col("main")) & F.expr("substr(token, 2 + length(main), 1)").isin("/", " ")
    fixed = often.join(nested.select("host", "vector").distinct(), ["host", "vector"], "left_semi").join(main, "host").filter(inside)
    texts = fixed.groupBy("host").agg(F.collect_list("token").alias("texts"))
    holds = per_token.filter((F.col("total") > 0) & (2 * F.col("chars") > F.col("total")))
    wrappers = holds.groupBy("host").agg(F.collect_list(F.expr("substr(token, 2)")).alias("wrappers"))
    return main.join(texts, "host", "full").join(wrappers, "host", "full")


def article(page: str | None, fixed: set[str], wrappers: frozenset[str] = frozenset()) -> str:
    """The text of a page's slots: all its blocks in page order, without barred
    parts and template texts."""
    return "\n\n".join(text for path, text, barred, _ in blocks(events(page, wrappers)) if not barred and f"#{path} {_hash(text)}" not in fixed)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row.

    NULL and empty pages, and pages without text outside menus and the like, give
    an empty text.  A host's template comes from all its rows; on a host with one
    page, or without a valid class, the whole page is one slot.  NULL urls share
    an empty host.  Marks rule out no element that holds more than half of the text
    of the host's pages that have it.  Nothing is dropped or cut besides what the template and the
    marks rule out.
    """
    mine = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    keyed = mine.select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html")
    found = materialise(templates(keyed))

    @F.pandas_udf(T.StringType())
    def text_of(html: pd.Series, texts: pd.Series, wrappers: pd.Series) -> pd.Series:
        return pd.Series([article(h, set() if t is None else set(t), frozenset(() if w is None else w)) for h, t, w in zip(html, texts, wrappers)], dtype=object)

    return mine.join(found, "host", "left").select("page_id", "url", text_of("html", "texts", "wrappers").alias("text"))

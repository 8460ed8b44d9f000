"""Main text of web pages by equivalence-class template deduction.

1. A page's tokens are its container elements, each named by its path of tags, ids and classes, and its text blocks
   (in articles only those that fill every element of their path on the page). A token's occurrence vector says how
   often it stands on each page of a host. Pages are not brought together for it: a vector is known by the number of
   its pages, its total and the exclusive or of a hash of (page, count), which partial aggregates build in any order.
   A host with a third of all pages thus sends one row per token, layout and task.
2. Tokens of one host with equal vectors form an equivalence class. A class is valid if it has at least two tokens
   and stands on at least half of the pages of the host or of one layout (for text: on three or more). A layout is the
   pages of a host, five or more, with one language and one set of elements at the top of the body. Classes nest by
   their paths: an element belongs to the template if its token is in a valid class and its parent belongs to it.
3. On each page, marked or not, the innermost element of the template around a block is its slot. A slot whose text is
   template (the same notice on every page) is dropped; in articles only if the text is in the class of its element
   and other text of the articles varies, and never a part of a slot. Slots in menus, headers, footers, sidebars,
   notices, adverts, forms and comments, told by element, role, id or class, are dropped as well, but never by a name
   or form that wraps the page's articles or most of its text. Of the slots that are left, those in articles, if the
   page marks any, are the main text; else all are.

Character references are decoded, white space in a block becomes one space, blocks are joined by "\\n" in page order.
Null html gives an empty text; a null URL or one without "://" belongs to the host "". Pages with equal ids count as
separate pages. A host with one page has no evidence, and its page alone gives its slots. Empty tables give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .url_filters import split_url

#: Host tokens a task holds before it sends its partial counts.
HELD_TOKENS = 200_000
MIN_TEXT_PAGES = 3
MIN_LAYOUT_PAGES = 5

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
_ATTR = re.compile(r"""([A-Za-z_:][\w:.-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr "
             "blockquote pre figure figcaption details summary address hgroup center fieldset nav header footer aside "
             "form menu dialog noscript template search".split())
_CLOSES_P = _BLOCK - {"html", "head", "body"}
_MAIN = {"article", "main"}
_DROP_TAG = set("head script style noscript template nav header footer aside form menu dialog search button select "
                "textarea title iframe object svg canvas audio video xmp noembed noframes".split())
#: A tag that may also wrap a whole page.
_WRAPS = {"form"}
_DROP_ROLE = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                 "toolbar status tooltip".split())
#: Words of ids and classes ("top-menu", "menu_2") that name what is not main text.
_DROP_WORD = set("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                 "cookie cookies consent disqus gdpr menu navbar newsletter notice popup promo promoted sidebar "
                 "sponsor sponsored subscribe".split())
#: Whole ids and classes; as parts of longer names they may stand in an article.
_DROP_NAME = set("alert aside footer form header login masthead modal nav navigation notification pager pagination "
                 "related replies search share sharing site-footer site-header skip-link social toolbar widget".split())
#: Words that make a name tell a state of what it stands on ("has-sidebar", "comments-open") and not what it is.
_STATE = set("has have no not non with without open opened closed enabled disabled free".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_STATS = ("host string, layout bigint, token bigint, text boolean, within bigint, pages bigint, total bigint, "
          "vector bigint")
_LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([\w-]+)""", re.I)


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)


class Element:
    """`hard`: dropped by tag, role or being hidden; `weak`: the nearest element that a name or a form would drop.
    A weak element counts the text (`size`) and articles (`mains`) below it; `part`: only a part of a name tells."""

    __slots__ = ("name", "token", "parent", "dropped", "main", "hard", "weak", "part", "marked", "size", "mains")

    def __init__(self, name: str, attrs: str, parent: "Element | None", spared: bool):
        self.name, self.parent = name, parent
        found = {}
        for key, value, bare in _ATTR.findall(attrs) if attrs else ():
            found.setdefault((key or bare).lower(), html.unescape(value.strip("\"'")))
        names = (found.get("id", "") + " " + found.get("class", "")).lower().split()
        role = found.get("role", "").lower()
        root = name in ("html", "body")
        self.hard = parent is not None and parent.hard or not root and bool(
            name in _DROP_TAG and name not in _WRAPS or role in _DROP_ROLE or "hidden" in found
            or _HIDDEN.search(found.get("style", "")))
        whole = name in _WRAPS or not _DROP_NAME.isdisjoint(names) or not _DROP_WORD.isdisjoint(names)
        self.part = not whole and any(
            not _DROP_WORD.isdisjoint(w) and _STATE.isdisjoint(w) for w in (re.split(r"[-_]+", n) for n in names))
        self.weak = parent.weak if parent is not None else None
        self.size = self.mains = 0
        if (whole or self.part) and not root and not self.hard:
            self.weak = self
        self.marked = not self.hard and (name in _MAIN or role in _MAIN)  # and below, while no hard element comes between
        if self.marked and self.weak is not None:
            self.weak.mains += 1
        self.dropped = self.hard or self.weak is self and not spared or (parent is not None and parent.dropped)
        self.main = not self.dropped and (self.marked or (parent is not None and parent.main))
        self.token = _hash(f"{parent.token if parent else 0}>{name}.{'.'.join(sorted(set(names)))}")

    def in_main(self) -> bool:
        e = self.parent
        while e is not None and not e.marked:
            e = e.parent
        return e is not None


def parse(page: str) -> tuple[list[Element], list[tuple[Element | None, str]]]:
    """Containers of a page in order, and its text blocks outside dropped containers, each with its container.

    Names alone never drop what a page is about. An element named by a part of a name stays if it is an article or
    main element, or holds most of the page's text; any element that its name or form tag would drop stays if it holds
    the page's articles, or most of its text, and no article text is left without it.
    """
    elements, blocks, weak = _parse(page, frozenset())
    if not weak:
        return elements, blocks
    clean = sum(len(t) for e, t in blocks if e is not None and e.main)
    total = sum(len(t) for _, t in blocks)
    for e in reversed(weak):
        above = e.parent.weak if e.parent is not None else None
        if above is None:
            total += e.size
        else:
            above.size += e.size
            above.mains += e.mains
    spared = frozenset(i for i, e in enumerate(weak) if _spared(e, clean, total))
    return _parse(page, spared)[:2] if spared else (elements, blocks)


def _spared(e: Element, clean: int, total: int) -> bool:
    big = 2 * e.size > total
    return e.part and (big or e.marked) or not clean and (big or e.mains > 0 and not e.in_main())


def _parse(page: str, spared: frozenset[int]) -> tuple[list, list, list[Element]]:
    """Containers, text blocks, and the elements that names or forms would drop, of which `spared` (by place) stay."""
    elements: list[Element] = []
    weak: list[Element] = []
    blocks: list[tuple[Element | None, str]] = []
    stack: list[Element] = []
    held: list[str] = []
    at, raw = 0, None

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                blocks.append((stack[-1] if stack else None, text))
            held.clear()

    def pop(name: str) -> None:
        while stack.pop().name != name:
            pass

    def text(a: int, b: int) -> None:
        if a < b and raw is None:
            e = stack[-1] if stack else None
            if e is None or not e.dropped:
                held.append(page[a:b])
            if e is not None and e.weak is not None and not e.hard:
                e.weak.size += len(page[a:b].strip())

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        close, name = m[1], (m[2] or "").lower()
        if raw and not (close and name == raw):
            continue  # inside a raw text element only its own end tag counts
        text(at, m.start())
        at = m.end()
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m.start() + 9, m.end() - 3)
            continue
        raw = None
        if close:
            if any(e.name == name for e in stack):
                if name in _BLOCK:
                    flush()
                pop(name)
            continue
        if name in ("br", "hr", "td", "th"):
            text_break = not (stack and stack[-1].dropped)
            if text_break:
                held.append(" ")
        if name in _VOID:
            continue
        block = name in _BLOCK
        if block:
            flush()
            if name in _CLOSES_P and any(e.name == "p" for e in stack):
                inner = next(e for e in reversed(stack) if e.name == "p" or e.name in _MAIN or e.name in ("div", "td"))
                if inner.name == "p":
                    pop("p")
            if name == "li":
                inner = next((e.name for e in reversed(stack) if e.name in ("li", "ul", "ol", "menu")), "")
                if inner == "li":
                    pop("li")
            if name in ("dt", "dd"):
                inner = next((e.name for e in reversed(stack) if e.name in ("dt", "dd", "dl")), "")
                if inner in ("dt", "dd"):
                    pop(inner)
            if name == "tr":
                inner = next((e.name for e in reversed(stack) if e.name in ("tr", "table")), "")
                if inner == "tr":
                    pop("tr")
        closed_at_once = m[3].rstrip().endswith("/") and name in ("svg", "iframe", "object", "canvas")
        e = Element(name, m[3], stack[-1] if stack else None, len(weak) in spared)
        if e.weak is e:
            weak.append(e)
        if (block or e.weak is e or e.dropped and not (stack and stack[-1].dropped) or name in _RAW) and not closed_at_once:
            stack.append(e)  # other inline elements are no containers: they need not be closed
            if block:
                elements.append(e)
        if name in _RAW:
            raw = name
    text(at, len(page))
    flush()
    return elements, blocks, weak


def _page_tokens(page: str) -> tuple[int, dict[tuple[int, bool, int], int]]:
    """Layout, and occurrences of each token: (hash, whether it is text, for text in articles its element's token)."""
    out: dict[tuple[int, bool, int], int] = {}
    elements, blocks = parse(page)
    top = set()
    for e in elements:
        out[e.token, False, 0] = out.get((e.token, False, 0), 0) + 1
        if e.parent is None or e.parent.name in ("html", "body"):
            top.add(e.token)
    marked: dict[tuple[int, bool, int], int] = {}
    for e, t in blocks:
        inside = e is not None and e.main
        k = (_hash(f"{e.token if e else 0}:{t}"), True, e.token if inside else 0)
        part = marked if inside else out
        part[k] = part.get(k, 0) + 1
    # A text block with fewer places than its element can't be in the element's class.
    out.update((k, n) for k, n in marked.items() if n == out.get((k[2], False, 0)))
    lang = _LANG.search(page)
    return _hash(f"{lang[1].lower() if lang else ''} {sorted(top)}"), out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int, int, bool, int], list[int]] = {}

    def send() -> pa.RecordBatch:
        keys, values = list(zip(*held)), list(zip(*held.values()))
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4)
        cols = [pa.array(c, t) for c, t in zip([*keys, *values], types)]
        held.clear()
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _STATS.split(", ")])

    for batch in batches:
        for host, page, row in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "row"))):
            layout, tokens = _page_tokens(page)
            for (token, is_text, within), n in [*tokens.items(), ((0, False, 0), 1)]:
                x = held.setdefault((host, layout, token, is_text, within), [0, 0, 0])
                x[0] += 1
                x[1] += n
                x[2] ^= _hash(f"{row},{n}")
            if len(held) >= HELD_TOKENS:
                yield send()
    if held:
        yield send()


def templates(rows: DataFrame) -> DataFrame:
    """(host, tokens): tokens of the host's valid equivalence classes; rows have (row, host, html)."""
    key = ["host", "token", "text", "within"]
    sums = (F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.expr("bit_xor(vector)").alias("vector"))
    parts = written(rows.mapInArrow(_count, _STATS).groupBy(*key, "layout").agg(*sums), "html-tokens")
    layouts = (parts.filter("token = 0 AND NOT text").filter(F.col("pages") >= MIN_LAYOUT_PAGES)
               .select("host", "layout", F.col("pages").alias("layout_pages")))
    in_layout = (parts.filter(f"token <> 0 AND 2 * pages >= {MIN_LAYOUT_PAGES}").join(layouts, ["host", "layout"])
                 .filter("2 * pages >= layout_pages").select(*key).distinct().withColumn("of_layout", F.lit(True)))
    stats = parts.groupBy(*key).agg(*sums).filter(f"token = 0 OR pages >= IF(text, {MIN_TEXT_PAGES}, 1)")
    hosts = (parts.filter("token = 0 AND NOT text").groupBy("host").agg(F.sum("pages").alias("host_pages")))
    frequent = (stats.filter("token <> 0").join(hosts, "host").join(in_layout, key, "left")
                .filter("2 * pages >= host_pages OR of_layout"))
    vector = ["host", "pages", "total", "vector"]
    valid = frequent.groupBy(*vector).agg(F.count("*").alias("size")).filter("size >= 2").drop("size")
    chosen = written(frequent.join(valid, vector).select(*key, *vector[1:]), "html-classes")
    own = chosen.filter("NOT text").select(F.col("token").alias("within"), *vector)
    kept = (chosen.filter("within = 0").select("host", "token")
            .union(chosen.filter("within <> 0").join(own, ["within", *vector], "left_semi").select("host", "token")))
    return kept.groupBy("host").agg(F.collect_set("token").alias("tokens"))


def main_text(page: str, tokens: set[int]) -> str:
    """Text of the main slots of one page, given the template of its host."""
    elements, blocks = parse(page)
    template: dict[int, bool] = {}
    for e in elements:
        up = e.parent
        while up is not None and id(up) not in template:
            up = up.parent  # an inline element is no token
        template[id(e)] = e.token in tokens and (up is None or template[id(up)])
    articles = any(e.main for e in elements)
    found: list[tuple[int, str, bool]] = []
    for e, t in blocks:
        if not articles or e is not None and e.main:
            slot = e
            while slot is not None and not template.get(id(slot), False):
                slot = slot.parent
            found.append((id(slot), t, slot is e and _hash(f"{e.token if e else 0}:{t}") in tokens))
    if articles:  # slots are kept whole, and articles in which no text varies too
        varies = {slot for slot, _, fixed in found if not fixed}
        return "\n".join(t for slot, t, _ in found if slot in varies or not varies)
    return "\n".join(t for _, t, fixed in found if not fixed)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[int]] = {}
    for batch in batches:
        out = []
        for host, page, tokens in zip(batch.column(2), batch.column(3), batch.column(4)):
            if (h := host.as_py()) not in known:
                if len(known) > 1000:
                    known.clear()
                known[h] = set(tokens.as_py() or ())
            out.append(main_text(page.as_py(), known[h]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()),
             pa.array(np.array([len(t) for t in out], np.int64))], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host, _ = split_url(F.col("url"))
    rows = pages.select(F.col(key).alias("page_id"), "url", host.alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    found = written(templates(rows.withColumn("row", F.monotonically_increasing_id())), "html-templates")
    joined = rows.join(found, "host", "left").select("page_id", "url", "host", "html", "tokens")
    return joined.mapInArrow(_extract, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars bigint")

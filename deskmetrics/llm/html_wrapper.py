"""HTML extraction by wrappers: union-free expressions inferred per host.

A page's token stream is read into nested groups.  Runs of alike neighbours
(periods of one to three elements) are folded into repeated groups, and the
wrapper of a host is made by aligning its pages one after the other: what only
one side has becomes optional, what both have is aligned inside, and text that
differs becomes a text slot, while text that all pages share stays template
text: each node counts the pages that have exactly its text, and pages whose
texts are all alike make no template.  Alignment is associative up to optional marks, so partitions align
their own pages, and the partial wrappers of a host are aligned in two steps;
no task sees all pages of a host.

Roles are given to the wrapper, not to pages: menus, headers, footers,
sidebars, notices, adverts, forms, reader comments, scripts and styles are
left out by their element or by a name in class, id or role (whole, its last
part, or its first before a word for a box: "ad-box", not "has-sidebar").  An
element that is left out only by its name, or a form or header, stays if the
host has its article in there and nowhere else.  The article is
the ``article`` groups, else ``main``, else the body without template text
(kept when a host has a single page) and without groups of links only.  Inside
an article, text is template if TEMPLATE_PAGES pages or more, and all of the
host, share it and it is no heading; elsewhere, a heading beside text that
differs from page to page belongs to the story.
A page is then aligned with its host's wrapper and the text of the slots in
the article is taken.

Defined results: NULL or empty html and pages without text give an empty
text; a NULL url is a host of its own; repeated pages are extracted alike;
elements nested deeper than MAX_DEPTH belong to their ancestor at that depth;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import md5
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 60
MAX_PERIOD = 3
SALTS = 32

# fixed values: elements and names by their place in a page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
UNSEEN = frozenset("script style noscript template title head svg iframe object canvas".split())
ASIDE = frozenset("nav footer aside form button select textarea dialog menu".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices alert popup modal sidebar nav navbar navigation menu breadcrumb breadcrumbs masthead header footer "
    "comment comments disqus replies share sharing social related recommended newsletter subscribe signup login "
    "search pagination pager toolbar complementary contentinfo".split())
#: Last parts of names that say only that there is a box, and first parts that say what a page has.
BOXES = frozenset("area bar block box container frame group inner item items links list menu panel section slot unit "
                  "widget wrap wrapper zone".split())
STATES = frozenset("has have hide is no not show toggle with without".split())
#: Never the place of the article.
FOREIGN = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments "
                    "disqus replies related recommended".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<",
                    re.S)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose id is an anchor to link to, no role (but for what is FOREIGN).
ANCHORED = HEADINGS | frozenset("section p li dt dd".split())
#: What makes an article one of the readers' comments.
REMARKS = frozenset("comment comments reply replies".split())
#: Pages of a host that must share a text before it is template inside an article.
TEMPLATE_PAGES = 5
_PART = re.compile(r"[a-z]+")


# --- pages ------------------------------------------------------------------------

class Item:
    """An element of a page: its signature, and its children and texts in order."""
    __slots__ = ("sig", "parts")

    def __init__(self, sig: str):
        self.sig = sig
        self.parts: list[Item | str] = []


def _aside_name(name: str) -> set[str]:
    """What NAMES a class, id or role says that the element is."""
    parts = _PART.findall(name.lower())
    if not parts or parts[0] in STATES:
        return set()
    return NAMES & {"".join(parts), parts[-1], parts[0] if parts[-1] in BOXES or parts[-1] in NAMES else ""}


def _signature(tag: str, attrs: str) -> str:
    if tag in ("html", "body", "main") or "=" not in attrs:
        return tag
    names: set[str] = set()
    for kind, *given in _NAMED.findall(attrs):
        for value in "".join(given).split():
            own = _aside_name(value) | ({"".join(_PART.findall(value.lower()))} & REMARKS)
            names |= own & FOREIGN if kind.lower() == "id" and tag in ANCHORED else own
    if tag == "article":
        return "article.comment" if names & REMARKS else tag
    return ".".join((tag, *sorted(names)))


def parse(html: str | None) -> Item:
    """The elements of a page; inline elements are markup only, their text
    belongs to the element around them."""
    root = Item("")
    open_tags, items = [""], [root]
    raw_until, at = None, 0
    html = html or ""
    while at < len(html):
        if raw_until:
            end = re.compile(f"</{raw_until}\\b[^>]*>?", re.I).search(html, at)
            at, raw_until = (end.end() if end else len(html)), None
            continue
        m = _TOKEN.match(html, at)
        if m is None:       # a tag with an open quote: text up to the next one
            end = html.find("<", at + 1)
            m_text, at = html[at:end if end > 0 else len(html)], (end if end > 0 else len(html))
            items[-1].parts.append(m_text)
            continue
        at = m.end()
        if not m[2]:
            if not m[0].startswith(("<!", "<?")):
                items[-1].parts.append(m[0])
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                continue
            if tag in open_tags[1:]:
                while open_tags.pop() != tag:
                    items.pop()
                items.pop()
            elif tag == "p":
                items[-1].parts.append(" ")
            continue
        if tag in RAW:
            raw_until = tag if not m[3].rstrip().endswith("/") else None
            continue
        if tag in VOID or tag in INLINE:
            if tag not in INLINE:
                items[-1].parts.append(" ")
            continue
        closes = CLOSED_BY.get(tag, ())
        if open_tags[-1] == "p" or open_tags[-1] in closes:
            open_tags.pop()
            items.pop()
        if tag in ("tr",) and open_tags[-1] in ("td", "th", "tr"):
            while open_tags[-1] in ("td", "th", "tr"):
                open_tags.pop()
                items.pop()
        if m[3].rstrip().endswith("/"):
            items[-1].parts.append(" ")
            continue
        if len(items) > MAX_DEPTH:          # belongs to the ancestor at that depth
            items[-1].parts.append(" ")
            items.append(items[-1])
            open_tags.append(tag)
            continue
        new = Item(_signature(tag, m[3]))
        items[-1].parts.append(new)
        open_tags.append(tag)
        items.append(new)
    return root


# --- wrappers -----------------------------------------------------------------------
# A wrapper node is [signature, optional, repeated, text, children, pages]:
# text is None (none), a string (the same wherever there is one) or True (a
# slot); pages is the number of pages that have exactly this string.

SIG, OPT, REP, TEXT, KIDS, SEEN = range(6)


def _own_text(item: Item) -> str:
    return " ".join(unescape("".join(p for p in item.parts if isinstance(p, str))).split())


def _fold(nodes: list[list]) -> list[list]:
    """Neighbouring repeats of one to MAX_PERIOD nodes become repeated groups."""
    for period in range(1, MAX_PERIOD + 1):
        out, i = [], 0
        sigs = [n[SIG] for n in nodes]
        while i < len(nodes):
            j = i + period
            while sigs[j:j + period] == sigs[i:i + period] and len(sigs) >= j + period:
                j += period
            if j == i + period:
                out.append(nodes[i])
                i += 1
                continue
            one = nodes[i:i + period]
            for k in range(i + period, j, period):
                one = [_merge(a, b, one_page=True) for a, b in zip(one, nodes[k:k + period])]
            if period == 1:
                one[0][REP] = True
                out.append(one[0])
            else:
                out.append(["(" + " ".join(sigs[i:i + period]) + ")", False, True, None, one, 0])
            i = j
        nodes = out
    return nodes


def wrapper_of(item: Item) -> list:
    """The wrapper that fits this page."""
    text = _own_text(item)
    kids = _fold([wrapper_of(p) for p in item.parts if not isinstance(p, str)])
    if len(text) > 80:
        text = f"{text[:60]}... {md5(text.encode()).hexdigest()}"
    return [item.sig, False, False, text or None, kids, int(bool(text))]


def _pairs(a: list[list], b: list[list]) -> list[tuple[int | None, int | None]]:
    """A longest common subsequence of signatures, with what stands between."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo][SIG] == b[lo][SIG]:
        lo += 1
    x, y = len(a), len(b)
    while x > lo and y > lo and a[x - 1][SIG] == b[y - 1][SIG]:
        x, y = x - 1, y - 1
    table = [[0] * (y - lo + 1) for _ in range(x - lo + 1)]
    for i in range(x - lo - 1, -1, -1):
        for j in range(y - lo - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[lo + i][SIG] == b[lo + j][SIG] else \
                max(table[i + 1][j], table[i][j + 1])
    out: list[tuple[int | None, int | None]] = [(k, k) for k in range(lo)]
    i = j = lo
    while i < x or j < y:
        if i < x and j < y and a[i][SIG] == b[j][SIG] and \
                table[i - lo][j - lo] == table[i - lo + 1][j - lo + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j >= y or (i < x and table[i - lo + 1][j - lo] >= table[i - lo][j - lo + 1]):
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out + list(zip(range(x, len(a)), range(y, len(b))))


def _merge(a: list, b: list, one_page: bool = False) -> list:
    """The wrapper of two nodes with the same signature, of two sets of pages
    or of one page."""
    text = a[TEXT] if a[TEXT] == b[TEXT] or b[TEXT] is None else b[TEXT] if a[TEXT] is None else True
    kids = []
    for i, j in _pairs(a[KIDS], b[KIDS]):
        if i is not None and j is not None:
            kids.append(_merge(a[KIDS][i], b[KIDS][j], one_page))
        else:
            only = a[KIDS][i] if j is None else b[KIDS][j]
            kids.append([only[SIG], True, *only[REP:]])
    seen = max(a[SEEN], b[SEEN]) if one_page else a[SEEN] + b[SEEN]
    return [a[SIG], a[OPT] or b[OPT], a[REP] or b[REP], text, kids, seen]


def align(wrapper: list | None, other: list) -> list:
    return other if wrapper is None else _merge(wrapper, other)


def expression(node: list) -> str:
    """The wrapper as a readable union-free expression."""
    text = "" if node[TEXT] is None else "#TEXT" if node[TEXT] is True else repr(node[TEXT])
    inner = " ".join(filter(None, [text, *map(expression, node[KIDS])]))
    body = f"({inner})" if node[SIG].startswith("(") else f"<{node[SIG]}>{inner}</>"
    return f"({body})" + ("*" if node[OPT] and node[REP] else "?" if node[OPT] else "+") \
        if node[OPT] or node[REP] else body


# --- extraction ---------------------------------------------------------------------

def _is_aside(sig: str, inside: bool) -> bool:
    tag, *names = sig.split(".")
    return tag in ASIDE or tag in UNSEEN or bool(names) or (tag == "header" and not inside)


def _regions(node: list, tag: str) -> bool:
    if node[SIG] == tag:
        return True
    return not _is_aside(node[SIG], False) and any(_regions(k, tag) for k in node[KIDS])


def _may_hold(node: list) -> bool:
    """An aside by its name alone, or a form or header."""
    tag, *names = node[SIG].split(".")
    return tag not in UNSEEN and (tag in ("form", "header") or tag not in ASIDE) and not FOREIGN & set(names)


def _way_in(node: list, tag: str) -> list[int]:
    """The asides (by ``id``) around the ``tag`` groups below this node."""
    found: list[int] = []
    for kid in node[KIDS]:
        if _is_aside(kid[SIG], False):
            if _may_hold(kid) and (_regions([""] + kid[1:], tag) or _way_in(kid, tag)):
                found += [id(kid), *_way_in(kid, tag)]
        else:
            found += _way_in(kid, tag)
    return found


def _texts(node: list, pages: int) -> int:
    """Nodes with text of their own (no template) below this node."""
    return (node[TEXT] is True or (node[TEXT] is not None and (pages < 2 or node[SEEN] < pages))) + \
        sum(_texts(k, pages) for k in node[KIDS] if not _is_aside(k[SIG], False))


def _fullest(node: list, pages: int) -> list:
    """(texts, its id) of the aside with most texts below this node."""
    found = [0, 0]
    for kid in node[KIDS]:
        if not _is_aside(kid[SIG], False):
            found = max(found, _fullest(kid, pages))
        elif _may_hold(kid):
            found = max(found, [_texts(kid, pages), id(kid)], _fullest(kid, pages))
    return found


def _way(wrapper: list, pages: int) -> tuple[list[str], frozenset[int]]:
    """The regions to take text from, and the asides (by ``id``) to look into."""
    regions = [r for r in ("article", "main") if _regions(wrapper, r)]
    if regions:
        return [*regions, ""], frozenset()
    for region in ("article", "main"):
        if way := _way_in(wrapper, region):
            return [region, ""], frozenset(way)
    if not _texts(wrapper, pages):
        # named like comments, but there is nothing that they are comments on
        if _regions(wrapper, "article.comment"):
            return ["article.comment", ""], frozenset()
        most, found = _fullest(wrapper, pages)
        if most:
            return [""], frozenset(_above(wrapper, found))
    return [""], frozenset()


def _above(node: list, found: int) -> list[int]:
    """The ids of the nodes from here down to the one found."""
    if id(node) == found:
        return [found]
    for kid in node[KIDS]:
        if below := _above(kid, found):
            return [id(node), *below]
    return []


def _take(item: Item, node: list, region: str, inside: bool, pages: int, out: list[str],
          way: frozenset[int] = frozenset(), story: bool = False) -> None:
    """Text blocks of the page's element, aligned with the wrapper node;
    ``story``: the element stands beside text that differs from page to page."""
    if item.sig == region:
        inside = True
    elif _is_aside(item.sig, inside) and id(node) not in way:
        return
    kids = [p for p in item.parts if not isinstance(p, str)]
    nodes = _unfold(kids, node[KIDS])
    heading = item.sig.partition(".")[0] in HEADINGS and (region or story)
    template = (pages >= (TEMPLATE_PAGES if region else 2) and isinstance(node[TEXT], str) and node[SEEN] >= pages
                and not heading)
    story = item.sig not in ("", "html", "body") and any(_texts(k, pages) for k in node[KIDS])
    run: list[str] = []

    def end_block():
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text and (inside or not region) and not template:
            out.append(text)

    k = 0
    for p in item.parts:
        if isinstance(p, str):
            run.append(p)
        else:
            end_block()
            _take(p, nodes[k], region, inside, pages, out, way, story)
            k += 1
    end_block()


def _unfold(kids: list[Item], nodes: list[list]) -> list[list]:
    """The wrapper node of each child: the children are read in order through
    the sequence of single, optional and repeated nodes."""
    flat: list[list] = []
    for n in nodes:
        flat += n[KIDS] if n[SIG].startswith("(") else [n]
    by_sig: dict[str, list[list]] = {}
    for n in flat:
        by_sig.setdefault(n[SIG], []).append(n)
        if n[SIG].startswith("("):
            for inner in n[KIDS]:
                by_sig.setdefault(inner[SIG], []).append(inner)
    blank = ["", True, True, True, [], 0]
    at: dict[str, int] = {}
    out = []
    before = None
    for kid in kids:
        choices = by_sig.get(kid.sig) or [blank]
        i = at.get(kid.sig, -1)
        if before != kid.sig or i < 0 or not choices[min(i, len(choices) - 1)][REP]:
            i += 1
        at[kid.sig] = i
        before = kid.sig
        out.append(choices[min(i, len(choices) - 1)])
    return out


def extract(html: str | None, wrapper: list, pages: int) -> str:
    """The main text of a page by its host's wrapper."""
    page = parse(html)
    regions, way = _way(wrapper, pages)
    for region in regions:
        blocks: list[str] = []
        _take(page, wrapper, region, False, pages, blocks, way)
        if blocks:
            return " ".join(blocks)
    return ""


def digest(node: list) -> str:
    """Equal for pages whose elements and texts are alike, but for asides."""
    def bare(n: list) -> list:
        return [n[SIG], n[TEXT], [bare(k) for k in n[KIDS] if not _is_aside(k[SIG], False)]]
    return md5(json.dumps(bare(node)).encode()).hexdigest()


# --- Spark --------------------------------------------------------------------------

def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, pages) from (host, html); pages is 1 if all are alike."""
    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, list] = {}
        count: dict[str, int] = {}
        alike: dict[str, str] = {}
        salt = TaskContext.get().partitionId() % SALTS
        for batch in batches:
            for name, html in zip(*(c.to_pylist() for c in batch.columns)):
                page = wrapper_of(parse(html))
                if alike.get(name) != "":
                    own = digest(page)
                    alike[name] = own if alike.get(name, own) == own else ""
                made[name] = align(made.get(name), page)
                count[name] = count.get(name, 0) + 1
        if made:
            yield pa.RecordBatch.from_pydict(
                {"host": list(made), "salt": pa.array([salt] * len(made), pa.int32()),
                 "wrapper": [json.dumps(w) for w in made.values()], "pages": [count[h] for h in made],
                 "alike": [alike[h] for h in made]})

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        one = None
        for text in sorted(pdf["wrapper"]):
            one = align(one, json.loads(text))
        alike = pdf["alike"].iloc[0] if pdf["alike"].nunique() == 1 else ""
        return pdf.iloc[:1].assign(wrapper=json.dumps(one), pages=int(pdf["pages"].sum()), alike=alike)

    kind = "host string, salt int, wrapper string, pages long, alike string"
    partial = pages.mapInArrow(infer, kind).groupBy("host", "salt").applyInPandas(together, kind)
    whole = partial.groupBy("host").applyInPandas(together, kind)
    return whole.select("host", "wrapper", F.when(F.col("alike") == "", F.col("pages")).otherwise(1).alias("pages"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(``id_col``, ``url_col``, text) for every page."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                       F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    by_host = wrappers(src.select("host", "html"))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for html, wrapper, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                if wrapper not in known:
                    if len(known) >= 1000:
                        known.clear()
                    known[wrapper] = json.loads(wrapper)
                texts.append(extract(html, known[wrapper], n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], [id_col, url_col, "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    joined = src.join(by_host.hint("shuffle_hash"), "host").select("id", "url", "html", "wrapper", "pages")
    return joined.mapInArrow(one, f"{id_col} {kinds[id_col]}, {url_col} {kinds[url_col]}, text string")

"""Main text of web pages, with site templates removed.

Each page is parsed once, into text blocks and the elements around them. Element subtrees are hashed, from their tags, texts and
subtrees, and counted per host in Spark; a block goes if a subtree around it recurs on many pages of that host whose main
text outside it differs. That holds for menus, headers and notices whatever they are called. No subtree is a template that holds an
article, or most of a page's running text, nor, inside an article, one that is or holds running text: sentences that
many articles share are theirs. On pages without an article the smallest element that holds most of the text stands for it.

Of what is left, furniture goes by its element, or its class and id: what recurs too seldom to be counted, and what
changes from page to page, such as adverts. No class or id removes the page's article or most of its text, and inside an
article a name of several words ("related-work") removes only what is short or mostly links, unless a word of it stands for
adverts, consent or reader comments alone. Hidden is what the attributes `hidden`, `aria-hidden` and `style` say; other attributes' values
say nothing. Of pages whose articles hold half of the text that is left, or more, all articles stay and nothing else; of others all of that text.

Defined results: null or empty html gives the empty text; a null url is a host of its own; an article in an
article is part of it; formulas give their symbols, without the source beside them; repeated rows, and pages with the same
other text, count once; truncated and badly nested markup is read as far as it goes; a very long or deeply nested page takes
time and memory in proportion to its size; an empty table gives no rows; other columns pass through, and those that have the name
of an added one are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import added, cut, named, no_clash, placed

#: A subtree is a template on this many pages of a host that differ outside it, however many pages the host has.
MIN_PAGES = 5
#: Templates up to which every task gets all of them; beyond, pages and their templates meet in a shuffle.
FEW = 200_000

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace mpadded mphantom menclose mfenced merror mmultiscripts mprescripts semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe object annotation annotation-xml".split())
FURNITURE = frozenset("nav footer aside form script style noscript template svg iframe object annotation annotation-xml button select textarea menu dialog head title canvas audio video".split())
#: Characters from which text outside elements for prose is running text too.
LONG = 200
#: Elements for running text, and those around it.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figcaption caption article main body html".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HINTS = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert nav navbar navigation menu "
    "sidebar footer masthead topbar comment comments respond replies disqus discussion share sharing social related recommended newsletter subscribe signup popup modal overlay pagination pager widget toolbar skip".split()
)
#: Those of them that mean the same in names of several words.
STRONG = frozenset("ad ads adv advert advertisement advertising adsense sponsor sponsored promo cookie cookies consent gdpr comment comments respond replies disqus newsletter subscribe signup".split())
#: Characters outside links from which an element with prose isn't short.
PASSAGE = 100
#: What holds one of these, or is one, holds running text.
RUNNING = PROSE - {"article", "main", "body", "html"}
#: After these a class or id says what an element has, not what it is.
MODIFIERS = frozenset("has no with without".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'"<>])*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def attributes_of(text: str) -> dict[str, str]:
    """Values by lower-case name; of a name that comes twice the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(_NOT_SHOWN.search(attributes.get("style", "")))


def furniture(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    return tag not in ("html", "body") and hidden(attributes)


def hinted(tag: str, attributes: dict[str, str]) -> int:
    """0 for no hint, 2 where a name is a hint as a whole or has a strong word, 1 where it has another word of the list."""
    found = 0
    if tag in ("html", "body", "article", "main"):
        return found
    for name in " ".join(attributes.get(a, "") for a in ("class", "id", "role")).split():
        parts = [p.lower() for p in _PART.findall(name)]
        for part in parts:
            if part in MODIFIERS:
                break
            if part in HINTS:
                found = max(found, 2 if len(parts) == 1 or part in STRONG else 1)
    return found


#: What a node may be: a template, hinted at, a main element, or one that holds an article.
PLAIN, HINTED, MAIN, HOLDING = 1, 2, 4, 8
_NODE = "array<struct<first: int, last: int, kind: int, article: int, tree: long, others: long>>"
_BLOCK = "array<struct<text: string, article: int, dropped: boolean>>"
_WRAP = 1 << 64


class Element:
    __slots__ = ("tag", "parent", "first", "last", "dropped", "article", "holds", "hint", "chars", "runs", "sum", "kids", "hash", "inside", "linked")

    def __init__(self, tag: str, parent: Element | None, first: int, dropped: bool, article: int, hint: int):
        self.tag, self.parent, self.first, self.last = tag, parent, first, first
        self.dropped, self.article, self.holds, self.hint = dropped, article, False, hint
        self.chars, self.runs, self.sum, self.kids, self.hash, self.inside = 0, False, 0, [], 0, False
        self.linked = 0


def _signed(x: int) -> int:
    return (x % _WRAP) - (1 << 63)


def elements_of(page: str) -> tuple[list[tuple[str, Element | None]], list[Element]]:
    """The page's text blocks with the element right around each, and all elements in order of their start."""
    blocks: list[tuple[str, Element | None]] = []
    every: list[Element] = []
    stack: list[Element] = []
    open_: dict[str, int] = {}  # how many of a tag are open
    run: list[str] = []
    articles = links = 0
    at, size = 0, len(page)
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        if run:
            text = "".join(run)
            run.clear()
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append((text, stack[-1] if stack else None))
                if stack:
                    stack[-1].kids.append(xxhash.xxh64_digest(text))

    def close(tag: str) -> None:
        """Closes elements up to the last open one of that tag."""
        flush()
        while stack:
            x = stack.pop()
            open_[x.tag] -= 1
            x.last = len(blocks)
            if x.kids:
                x.hash = xxhash.xxh64_intdigest(x.tag.encode() + b"".join(x.kids))
                if x.parent:
                    x.parent.kids.append(x.hash.to_bytes(8, "big"))
                x.kids = []
            if x.tag == tag:
                break

    while at < size:
        m = _TAG.search(page, at)
        end = m.start() if m else size
        if end > at:
            run.append(page[at:end])
            if links and stack:
                stack[-1].linked += len(run[-1].strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                links -= tag == "a" and links > 0
                continue
            if tag == "br" or tag == "p" and not open_.get("p"):
                flush() if tag == "p" else run.append(" ")
                continue
            if open_.get(tag):
                close(tag)
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = over.end() if over else size
            continue
        if tag in INLINE:
            if tag in ("mtr", "mtd"):
                run.append(" ")
            if m[3] and hidden(attributes_of(m[3])):
                if tag not in ends:
                    ends[tag] = _ends(page, tag, m.start())
                at = ends[tag].get(at, at)
            else:
                links = 1 if tag == "a" else links  # a link ends where the next one begins
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                run.append(" ")
            continue
        flush()
        last = stack[-1] if stack else None
        if last and (tag in ENDS_P and last.tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option") and last.tag == tag):
            close(last.tag)
            last = stack[-1] if stack else None
        inside = last.article if last else 0
        attributes = attributes_of(m[3]) if m[3] else {}
        dropped = bool(last and last.dropped) or furniture(tag, attributes, bool(inside))
        if tag in ("article", "main") and not inside and not dropped:
            articles += 1
            inside = articles
            for x in reversed(stack):
                if x.holds:
                    break
                x.holds = True
        if not m[3].endswith("/"):
            x = Element(tag, last, len(blocks), dropped, inside, 0 if dropped else hinted(tag, attributes))
            stack.append(x)
            every.append(x)
            open_[tag] = open_.get(tag, 0) + 1
    close("")
    return blocks, every


def _ends(page: str, tag: str, at: int) -> dict[int, int]:
    """For each inline element of that tag that opens from `at` on and is closed: where its content begins, and where it ends."""
    found: dict[int, int] = {}
    open_: list[int] = []
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).finditer(page, at):
        if not m[1]:
            if not m[0].endswith("/>"):
                open_.append(m.end())
        elif open_:
            found[open_.pop()] = m.end()
    return found


def parsed_page(page: str) -> tuple[list[dict], list[dict]]:
    """The page's blocks, and its nodes: elements that may be templates, that a class or id hints at, or that are main."""
    blocks, every = elements_of(page)
    shown = [not (x and x.dropped) for _, x in blocks]
    has_article = any(x and x.article and s for (_, x), s in zip(blocks, shown, strict=True))
    total, everything, in_article = 0, 0, {}
    marks = [xxhash.xxh64_intdigest(text, 2) for text, _ in blocks]
    for (text, x), mark, s in zip(blocks, marks, shown, strict=True):
        k = x.article if x else 0
        counts = s and (k or not has_article)  # what tells pages apart is their main text
        total += len(text) * s
        everything += mark * counts
        in_article[k] = in_article.get(k, 0) + len(text) * s
        if x:
            x.chars += len(text) * s
            x.runs = x.runs or len(text) >= LONG
            x.sum += mark * counts
    for x in reversed(every):
        x.runs = x.last > x.first and (x.runs or x.tag in RUNNING)
        if x.parent:
            x.parent.chars += x.chars
            x.parent.linked += x.linked
            x.parent.runs = x.parent.runs or x.runs
            x.parent.sum += x.sum
    most = lambda x: x.runs and 2 * x.chars > total
    inner = next((x for x in reversed(every) if not x.article and not x.dropped and most(x) and not x.holds and x.tag not in ("html", "body")), None)
    bare: set[int] = set()  # elements all of whose ancestors are for running text
    nodes = []
    for x in every:
        p = x.parent
        x.inside = p is not None and (p.inside or p is inner)
        if p is None or id(p) in bare:
            if x.tag in PROSE:
                bare.add(id(x))
        if x.last == x.first:
            continue
        kind = 0
        if x.holds or x.tag in ("html", "body", "article", "main"):
            pass
        elif x.dropped:
            kind = PLAIN
        elif x.article or x.inside:
            if x.tag not in PROSE and not x.runs and not most(x):
                kind = PLAIN
        elif not most(x) and not (x.tag in RUNNING and inner is None and id(x) in bare):
            kind = PLAIN
        prose = x.chars - x.linked >= PASSAGE and 2 * x.linked <= x.chars
        hint = x.hint > 1 or x.hint and not (x.article and prose)
        node = kind | HINTED * bool(hint) | MAIN * (x.tag == "main") | HOLDING * x.holds
        if node & ~HOLDING:
            nodes.append({"first": x.first, "last": x.last, "kind": node, "article": x.article, "tree": _signed(x.hash), "others": _signed(everything - x.sum)})
    return [{"text": text, "article": x.article if x else 0, "dropped": not s} for (text, x), s in zip(blocks, shown, strict=True)], nodes


def main_text(blocks: list[dict], nodes: list[dict], gone: list[bool]) -> str:
    """The text of a page whose nodes that `gone` marks are templates."""
    if not blocks:
        return ""
    left = np.array([not b["dropped"] for b in blocks], dtype=bool)
    article = np.array([b["article"] for b in blocks])
    for x, is_gone in zip(nodes, gone, strict=True):
        if is_gone:
            left[x["first"] : x["last"]] = False
    if not left.any():
        return ""
    size = np.array([len(b["text"]) for b in blocks]) * left
    held = {int(k): int(size[article == k].sum()) for k in np.unique(article[left]) if k}
    total = int(size.sum())
    hints = [x for x in nodes if x["kind"] & HINTED and left[x["first"] : x["last"]].any()]
    under = np.zeros(len(blocks), dtype=bool)
    for x in hints:
        under[x["first"] : x["last"]] = True
    free, in_free = int(size[~under].sum()), int(size[~under & (article > 0)].sum())
    best = max(held, key=lambda k: (held[k], -k), default=0)
    # Where all articles stand under hints, the largest is the page's: if it is the only one, or holds much of the text.
    theirs = best and not in_free and (len(held) == 1 or 2 * held[best] >= free)
    mains = [x for x in nodes if x["kind"] & MAIN]
    for x in hints:
        a, b = x["first"], x["last"]
        mine = 2 * int(size[a:b].sum())
        if x["article"]:
            goes = mine <= held[x["article"]]
        elif mine > total and not (in_free and 2 * in_free >= free):
            goes = False
        else:
            whole = theirs and (article[a:b][left[a:b]] == best).any() or any(a <= y["first"] and y["last"] <= b for y in mains)
            goes = not (x["kind"] & HOLDING and whole)
        if goes:
            left[a:b] = False
    inside = left & (article > 0)
    if inside.any() and 2 * int(size[inside].sum()) >= int(size[left].sum()):
        left = inside
    return "\n".join(blocks[i]["text"] for i in np.flatnonzero(left))


def parsed(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Every row's other columns with host, blocks and nodes, written once."""
    host = F.lower(F.regexp_extract(F.coalesce(named(url), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = no_clash(df, "host", "blocks", "nodes", "text", "n_chars", html)
    pages = df.select(*[named(c) for c in rest.columns], host.alias("host"), named(html).alias("blocks"))

    def make() -> Callable[[list], dict[str, list]]:
        def run(found: list) -> dict[str, list]:
            made = [parsed_page(x or "") for x in found]
            return {"blocks": [b for b, _ in made], "nodes": [n for _, n in made]}

        return run

    return cut(added(pages, F.col("blocks"), make, f"blocks {_BLOCK}, nodes {_NODE}"))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, tree) of the subtrees that are templates."""
    nodes = pages.select("host", F.inline("nodes")).where(F.col("kind").bitwiseAND(PLAIN) != 0)
    counts = nodes.select("host", "tree", "others").distinct().groupBy("host", "tree").agg(F.count("*").alias("n"))
    return cut(counts.where(F.col("n") >= min_pages).select("host", "tree"))


def _key(host: str, tree: int) -> int:
    return xxhash.xxh64_intdigest(f"{host}\x00{tree}") - (1 << 63)


def extract_text(df: DataFrame, html: str = "html", url: str = "url", min_pages: int = MIN_PAGES, few: int = FEW) -> DataFrame:
    """`df` without its html, with text and n_chars."""
    pages = parsed(df, html, url)
    found = templates(pages, min_pages)
    if found.count() <= few:
        keys = np.sort(np.array([_key(*r) for r in found.collect()], dtype=np.int64))
        rows = pages.withColumn("gone", F.lit(None).cast("array<int>"))
    else:
        keys = None
        at = placed(pages, F.col("host"), F.posexplode("nodes").alias("place", "node")).select("file", "row", "host", "place", "node.*")
        gone = at.where(F.col("kind").bitwiseAND(PLAIN) != 0).join(found, ["host", "tree"], "left_semi").groupBy("file", "row").agg(F.collect_list("place").alias("gone"))
        rows = placed(pages, *[named(c) for c in pages.columns]).join(gone, ["file", "row"], "left").drop("file", "row")

    def make() -> Callable[[list], dict[str, list]]:
        def run(found: list) -> dict[str, list]:
            texts = []
            for r in found:
                blocks, nodes = r["blocks"], r["nodes"]
                gone = [False] * len(nodes)
                for i in r["gone"] or []:
                    gone[i] = True
                if keys is not None and len(keys):
                    may = [i for i, x in enumerate(nodes) if x["kind"] & PLAIN]
                    mine = np.array([_key(r["host"], nodes[i]["tree"]) for i in may], dtype=np.int64)
                    hit = keys[np.minimum(np.searchsorted(keys, mine), len(keys) - 1)] == mine
                    for i, h in zip(may, hit.tolist(), strict=True):
                        gone[i] = h
                texts.append(main_text(blocks, nodes, gone))
            return {"text": texts, "n_chars": [len(x) for x in texts]}

        return run

    source = F.struct("host", "blocks", "nodes", "gone")
    return added(rows, source, make, "text string, n_chars long", drop=("host", "blocks", "nodes", "gone"))

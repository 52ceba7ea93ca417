"""HTML extraction by consensus host paths: containers are scored page by page, hosts vote, pages are read again.

1. Each page is parsed once and its containers (body, article, main, section, div, td ...) are scored by the prose that
   they hold; text within links and within page furniture doesn't count.  The path of a container is generalised: tags
   from the root down, with class words but not their numbers, so that pages of one template share it.
2. Spark counts, per host, the pages that each path wins (pre-aggregated on the map side, so that a hot host sends a few
   rows a task).  Paths with at least ``MIN_SHARE`` of the host's pages are its winners, the most voted first; there are at
   most 1 / MIN_SHARE of them.
3. Each page is read again with its host's winners: the first winner that has text on the page gives the container (all
   elements with that path, in page order); a page without any takes its own best container.  The winners are a
   written table: broadcast while it is small, else joined by host and a salt that splits hot hosts.

Within the container, elements of page furniture go: by tag (nav, footer, aside, form, script, style ...) or by a word of
class, id or role (menu, sidebar, advert, cookie, comments ...).  A header goes unless it holds a heading.  Character
references are decoded; white space within a block is one space; blocks are joined by a newline.

The reader is one pass over the tags, in linear time also on malformed input: unclosed comments and scripts run to the
end, a tag that never closes ends the page, unknown end tags are ignored, paragraphs, items and cells close by themselves.

Defined cases: a null page is empty; an empty page, or one with furniture alone, has empty text.  A page without any tags
is one block.  Pages with a null url, or one without a host, vote together.  Repeated rows are pages each, and vote each.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, texts, written

MIN_SHARE = 0.02
PARENT_SHARE = 0.5   # what a container gets of the score of those in it
SALTS = 8            # a host's pages are joined in this many groups
BONUS = 1.5          # of containers that say that they hold the article
MAX_DEPTH = 512      # levels of elements, as in browsers; the text of deeper ones belongs to the deepest level

# ---- fixed values: names of elements and words of page furniture ---------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
DROPPED = frozenset("""script style noscript template iframe object svg canvas math head title nav footer aside form button select
    textarea menu dialog audio video datalist xmp noembed noframes""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike
    strong sub sup time tt u var wbr""".split())
CONTAINERS = frozenset("html body article main section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# start tags that close an open element of the same kind, up to the nearest of the tags after the colon
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
          "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("tr td th thead tbody tfoot", "table"),
          "tbody": ("tr td th thead tbody tfoot", "table"), "tfoot": ("tr td th thead tbody tfoot", "table")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
KEEPS_P = INLINE | frozenset("script style noscript template area map input select option textarea button object iframe svg head title".split())
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promotion promotions banner
    banners sidebar sidebars menu menus nav navbar navigation navi breadcrumb breadcrumbs footer footers cookie cookies consent gdpr notice notices
    notification notifications popup modal overlay newsletter subscribe subscription signup share sharing sharebar social related recommended
    recommendations comment comments commentlist reply replies disqus widget widgets toolbar pagination pager search searchbox login
    masthead topbar skip""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
STATES = frozenset("has no with without is".split())  # a class of these says something about the page
ARTICLE_WORDS = frozenset("article articlebody content post entry story main text body".split())
# --------------------------------------------------------------------------------------------------------------------

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_SEPARATOR = re.compile(r"[-_]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}


class Element:
    """``linked``: within a link; ``headed``: holds a heading; ``key``: the generalised path."""

    __slots__ = ("tag", "parent", "depth", "key", "linked", "words", "furniture", "header", "headed")

    def __init__(self, tag: str, parent: "Element | None", words: frozenset, furniture: bool, header: bool):
        self.tag, self.parent, self.words, self.furniture, self.header, self.headed = tag, parent, words, furniture, header, False
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.depth = 0 if parent is None else parent.depth + 1
        self.key = None

    def path(self) -> str:
        if self.key is None:
            own = self.tag + "".join("." + w for w in sorted(self.words))
            self.key = own if self.parent is None else f"{self.parent.path()}>{own}"
        return self.key


def _described(tag: str, attributes: str) -> tuple[frozenset, bool, bool]:
    """(generalised class words, whether it is page furniture, whether it is a header)."""
    words, furniture, header = set(), tag in DROPPED, tag == "header"
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name == "role":
                furniture |= value.strip() in ROLES
                continue
            for token in value.split():
                if name == "class":
                    plain = "-".join(x for x in _SEPARATOR.split(token) if x.isalpha())  # post-123 counts as post
                    words.update([plain] if plain else [])
                parts = _WORDS.findall(token)
                if parts and parts[0] not in STATES and tag not in ("html", "body", "main"):
                    furniture |= bool(FURNITURE.intersection(parts)) and (tag != "article" or "comment" in parts[0])
                    header |= "header" in parts and tag not in HEADINGS and not ARTICLE_WORDS.intersection(parts)
    return frozenset(words), furniture, header


def parsed(page: str) -> list[tuple[Element, str | None]]:
    """The runs of text with their elements, in page order; a run of None breaks the block."""
    runs: list[tuple[Element, str | None]] = []
    root = Element("html", None, frozenset(), False, False)
    body = Element("body", root, frozenset(), False, False)
    stack = [root, body]
    skipped: dict[str, int] = {}  # open tags below the deepest level
    at, end, size = 0, page.rfind(">"), len(page)

    def text(a: int, b: int) -> None:
        if b > a:
            runs.append((stack[-1], page[a:b]))

    def pop_to(k: int) -> None:
        if any(e.tag not in INLINE for e in stack[k:]):
            runs.append((stack[k - 1], None))
        del stack[k:]

    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt + 1 >= size:
            text(at, size if lt < 0 else lt)
            break
        mark = page[lt + 1]
        if not (mark.isascii() and mark.isalpha()) and mark not in "/!?":
            text(at, lt + 1)
            at = lt + 1
            continue
        text(at, lt)
        if mark in "!?" or (mark == "/" and not page[lt + 2:lt + 3].isalpha()):
            stop = page.find("-->", lt + 4) if page.startswith("<!--", lt) else page.find(">", lt)
            if page.startswith(("<!-->", "<!--->"), lt):
                stop = page.find(">", lt) - 2
            if stop < 0:
                break
            at = stop + (3 if page.startswith("<!--", lt) else 1)
            continue
        match = _TAG.match(page, lt) if lt < end else None
        if match is None:
            break  # a tag that never closes
        at, tag, attributes = match.end(), match.group(1).lower(), match.group(2)
        if mark == "/":
            if skipped.get(tag):
                skipped[tag] -= 1
                continue
            if tag == "p" and not any(e.tag == "p" for e in reversed(stack)):
                runs.append((stack[-1], None))
            for k in range(len(stack) - 1, 1, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        if tag == "html":
            continue
        if tag == "body":
            body.words |= _described(tag, attributes)[0]
            body.key = None
            continue
        if tag == "br":
            runs.append((stack[-1], " "))
            continue
        if tag in VOID:
            if tag == "hr":
                runs.append((stack[-1], None))
            continue
        if tag not in KEEPS_P:
            for k in range(len(stack) - 1, 1, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in CLOSES:
            same, bounds = CLOSES[tag]
            low = None
            for k in range(len(stack) - 1, 1, -1):
                if stack[k].tag in bounds:
                    break
                if stack[k].tag in same:
                    low = k
            if low is not None:
                pop_to(low)
        element = Element(tag, stack[-1], *_described(tag, attributes))
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            if close is None:
                break
            stop = page.find(">", close.end())
            at = size if stop < 0 else stop + 1
            continue
        if attributes.endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in HEADINGS:
            for e in reversed(stack):
                if e.headed:
                    break
                e.headed = True
        if tag not in INLINE:
            runs.append((stack[-1], None))
        if len(stack) < MAX_DEPTH:
            stack.append(element)
        else:
            skipped[tag] = skipped.get(tag, 0) + 1
    return runs


def _is_furniture(e: Element) -> bool:
    return e.furniture or (e.header and not e.headed)


def _hidden(e: Element | None, top: Element | None, known: dict[int, bool]) -> bool:
    """Whether ``e`` is within page furniture below ``top``."""
    trail = []
    while e is not top and e is not None and id(e) not in known:
        trail.append(e)
        e = e.parent
    verdict = known[id(e)] if e is not top and e is not None else False
    for x in reversed(trail):
        verdict = verdict or _is_furniture(x)
        known[id(x)] = verdict
    return verdict


def containers(runs: list[tuple[Element, str | None]]) -> dict[str, float]:
    """Generalised path -> score, over the page's containers outside page furniture."""
    held: dict[int, list] = {}  # element -> [element, score of its own prose]
    known: dict[int, bool] = {}
    for e, run in runs:
        if run is None or e.linked or run.isspace() or _hidden(e, None, known):
            continue
        while e.tag not in CONTAINERS:
            e = e.parent
        held.setdefault(id(e), [e, 0.0])[1] += len(run)
    for e, _ in list(held.values()):
        e = e.parent
        while e is not None and id(e) not in held:
            held[id(e)] = [e, 0.0]
            e = e.parent
    scores: dict[str, float] = {}
    for k in sorted(held, key=lambda k: -held[k][0].depth):
        e, score = held[k]
        said = e.tag in ("article", "main") or any(ARTICLE_WORDS.intersection(w.split("-")) for w in e.words if e.tag != "body")
        if e.tag in CONTAINERS and e.tag != "html":
            scores[e.path()] = scores.get(e.path(), 0.0) + score * (BONUS if said else 1.0)
        up = e.parent
        if up is not None:
            held[id(up)][1] += score * (PARENT_SHARE if e.tag in CONTAINERS else 1.0)
    return scores


def best(scores: dict[str, float]) -> str | None:
    return max(scores, key=lambda p: (scores[p], p)) if scores else None


def main_text(page: str, winners: list[str]) -> str:
    """The page's text by the first of the host's winning paths that has some, else by its own best container."""
    runs = parsed(page)
    scores = containers(runs)
    path = next((p for p in winners if scores.get(p)), None) or best(scores)
    if path is None:
        # all text is in links: what is left of the body without its furniture
        path = "body"
    tops: dict[int, Element | None] = {}

    def top_of(e: Element) -> Element | None:
        """The outermost element with the path around ``e``, itself included."""
        trail, found = [], None
        x: Element | None = e
        while x is not None:
            if id(x) in tops:
                found = tops[id(x)]
                break
            trail.append(x)
            x = x.parent
        for x in reversed(trail):
            if found is None and (x.path() == path or (path == "body" and x.tag == "body")):
                found = x
            tops[id(x)] = found
        return found

    known: dict[int, bool] = {}
    blocks, words = [], []
    for e, run in runs:
        top = top_of(e)
        if run is None or top is None:
            if words:
                blocks.append("".join(words))
                words = []
        elif not _hidden(e, top, known):
            words.append(run)
    if words:
        blocks.append("".join(words))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunked(batches, "html"):
        paths = [best(containers(parsed(page))) for page in texts(part.column(1))]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.string())], names=["host", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winners): the generalised paths that win at least MIN_SHARE of the host's pages, most voted first."""
    votes = (pages.select(host_of(F.col("url")).alias("host"), F.col("html").alias("html"))
             .mapInArrow(_votes, "host string, path string").where(F.col("path").isNotNull())
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    hosts = votes.groupBy("host").agg(F.sum("n").alias("pages"))
    kept = votes.join(hosts, "host").where(F.col("n") >= MIN_SHARE * F.col("pages"))
    ranked = kept.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col("path").alias("path")))).alias("w"))
    return ranked.select("host", F.col("w.path").alias("winners"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunked(batches, "html"):
        found = [main_text(page, winners or []) for page, winners in zip(texts(part.column(2)), part.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()),
                                          pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"),
                       F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    # written, so that its size is known when the join is planned: broadcast while small, without a shuffle of the pages
    hosts = written(host_paths(pages), "host-paths").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = own.join(hosts, ["host", "salt"], "left").select("page_id", "url", "html", "winners")
    return joined.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")

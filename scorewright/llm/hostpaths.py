"""Main text of web pages by container paths that hosts agree on.

Three steps.  1: every page is cut into text blocks inside a tree of
containers; a container scores the running text below it, blocks deeper down
counting less, and a page votes for the generalised path (tags and class
names without numbers) of its best container.  2: Spark counts the votes per
host; a path wins on a host with at least ``MIN_SHARE`` of its pages, so a host
has at most ``1 / MIN_SHARE`` winning paths.  3: every page is cut again and
takes, of its host's winning paths that it has, the one with the largest
product of the host's votes and its own score; pages that have none keep their
own best container.  A page whose comments outweigh its article so still
yields the article, where the other pages of the host place it.

The text is that of all containers on the path, without what is boilerplate
by tag, role or class name (menus, headers and footers of the page, side bars,
notices, adverts, forms, comments) and without lists of links.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.common import ship_package, written

MIN_SHARE = 0.02
STEPS = 8  # a path names the innermost containers
DECAY, FAINT = 0.7, 1e-3

# fixed values: HTML's own element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCK = frozenset(
    "html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("html body button caption legend optgroup option select tbody td tfoot th thead tr".split())
#: An element of the first kind ends an open one of the second, up to a border.
ENDS = {tag: (tuple(ended.split()), border) for tag, (ended, border) in {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "tbody": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",)),
        "thead": ("tbody thead tfoot tr td th", ("table",)), "option": ("option", ("select",))}.items()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LINK_ENDS = HEADINGS | frozenset("p li td th dt dd".split())
CELLS = frozenset("table td th caption".split())
TABLE_PARTS = frozenset("tr td th caption tbody thead tfoot".split())
SCOPE = frozenset("html body table td th caption button".split())
CONTAINERS = frozenset("body article main section div td center".split())
#: Elements and roles that never hold running text of an article.
DROPPED = frozenset("nav aside footer form button select dialog menu search object audio video canvas map fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in class names and ids.
CHROME = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer pagination pager toolbar toc skip topbar masthead "
    "colophon widget widgets".split())
NOTICES = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox adslot banner banners sponsor sponsored promo promotion "
    "promoted cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations trending comment comments commentlist disqus respond replies "
    "reply search form outbrain taboola".split())
HEADS = frozenset("header head".split())
#: Names that start so say something about the page or its state.
STATES = frozenset("no has with without is js category tag type status format topic".split())
BODY_WORDS = frozenset("article post entry story content main body text".split())

_TAG = re.compile(r"<!--(?:-?>|.*?--!?>|.*\Z)|<[!?][^>]*>|</(?:[^a-zA-Z>][^>]*)?>|"
                  r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)>", re.S)
_OPEN_END = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_CUT = re.compile(r"[^a-z_-].*", re.S)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without ``www.`` and port; empty for
    what has none."""
    host = F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), a or b or c)
    return out


def name_words(value: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(value)]


def generalised(tag: str, classes: str) -> str:
    """Tag and class names of a step, cut at their first digit or other mark."""
    names = {_CUT.sub("", c.lower()).strip("-_") for c in classes.split()} if classes else ()
    names = [n for n in names if re.split("[-_]", n)[0] not in STATES]
    step = ".".join([tag, *sorted(n for n in names if n)])
    return step if len(step) <= 64 else f"{tag}.{zlib.crc32(step.encode()):08x}"


class Page:
    """The elements of a page in page order (``parent``, ``tag``, ``path`` for
    containers, the container that each is or is in, ``out`` if boilerplate)
    and its text blocks (element, text, length, length of links)."""

    __slots__ = ("parent", "tag", "path", "box", "inside", "out", "blocks")

    def __init__(self, html: str):
        self.parent, self.tag, self.path, self.out = [-1], ["body"], ["body"], [False]
        self.box, self.inside = [0], [False]  # nearest container; whether below an article
        self.blocks: list[tuple[int, str, int, int]] = []
        self._parse(html)
        self._drop_link_lists()

    def _open(self, above: int, tag: str, raw: str) -> int:
        given = attributes(raw) if raw and not raw.isspace() else {}
        classes = given.get("class", "")
        at = len(self.parent)
        self.parent.append(above)
        self.tag.append(tag)
        self.out.append(self.out[above] or self._boilerplate(above, tag, given))
        self.inside.append(self.inside[above] or tag in ("article", "main"))
        inner = self.box[above]
        if tag in CONTAINERS or "-" in tag:
            self.path.append("/".join([*self.path[inner].split("/")[1 - STEPS:], generalised(tag, classes)]))
            inner = at
        else:
            self.path.append("")
        self.box.append(inner)
        return at

    def _boilerplate(self, above: int, tag: str, given: dict[str, str]) -> bool:
        if tag in DROPPED or given.get("role", "").lower() in DROPPED_ROLES or "hidden" in given \
                or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
            return True
        if tag == "header":
            return not self.inside[above]
        if tag in ("main", "h1") or not ("class" in given or "id" in given):
            return False
        for value in [*given.get("class", "").split(), given.get("id", "")]:
            words = name_words(value)
            if not words or words[0] in STATES or words[-1] in ("open", "closed"):
                continue
            if NOTICES.intersection(words) or (tag != "article" and CHROME.intersection(words)):
                return True
            if HEADS.intersection(words) and not BODY_WORDS.intersection(words) and not self.inside[above]:
                return True
        return False

    def _parse(self, html: str) -> None:
        stack, texts, links = [0], [], [0]  # open elements; text of the open block, and how much of it is linked
        open_links, pos, limit = 0, 0, html.rfind(">") + 1
        muted, depth = "", 0  # an inline element that is boilerplate: its text is left out
        search, tags = _TAG.search, self.tag
        still: Counter[str] = Counter()  # open elements by tag

        def flush() -> None:
            if texts:
                text = " ".join("".join(texts).split())
                if text:
                    self.blocks.append((stack[-1], text, len(text), min(links[0], len(text))))
                texts.clear()
            links[0] = 0

        def add(raw: str) -> None:
            if muted:
                return
            text = entities.unescape(raw) if "&" in raw else raw
            texts.append(text)
            if open_links:
                links[0] += len(" ".join(text.split()))

        def close(targets: tuple[str, ...], border) -> None:
            if not any(still[t] for t in targets):
                return
            for k in range(len(stack) - 1, 0, -1):
                tag = tags[stack[k]]
                if tag in targets:
                    flush()
                    still.subtract(tags[e] for e in stack[k:])
                    del stack[k:]
                    return
                if tag in border:
                    return

        while pos < limit:
            m = search(html, pos, limit)
            if m is None:
                break
            if m.start() > pos:
                add(html[pos:m.start()])
            pos, tag = m.end(), m.group(2)
            if tag is None:
                if pos == limit and html.startswith("<!--", m.start()) and html[pos - 1] != ">":
                    pos = len(html)
                continue
            tag, block = tag.lower(), False
            if tag in BLOCK or "-" in tag:
                block, muted = True, ""
            if m.group(1):
                if tag == muted:
                    depth -= 1
                    muted = muted if depth else ""
                if tag == "a" or tag in LINK_ENDS:
                    open_links = 0
                if tag == "p" and not still["p"]:
                    flush()
                elif block:
                    close((tag,), ("table",) if tag in TABLE_PARTS else () if tag in ("article", "main", "table") else CELLS)
                continue
            if tag in RAW:
                if not m.group(3).endswith("/") or tag not in ("svg", "math"):
                    end = _RAW_END[tag].search(html, pos)
                    pos = end.end() if end else len(html)
                    limit = max(limit, pos)
                if tag in ("textarea", "svg", "math", "iframe"):
                    texts.append(" ")
                continue
            if tag in ("html", "head", "body"):
                flush()
                continue
            if not block:
                raw = m.group(3)
                if tag == "a" and "href" in raw.lower():
                    open_links = 1  # links do not nest
                if tag in VOID:
                    texts.append(" ")
                elif tag == muted:
                    depth += 1
                elif not muted and (tag in DROPPED or raw and not raw.isspace() and self._boilerplate(stack[-1], tag, attributes(raw))):
                    muted, depth = tag, 1
                continue
            if tag in CLOSES_P:
                close(("p",), SCOPE)
                if tag in HEADINGS and tags[stack[-1]] in HEADINGS:
                    close((tags[stack[-1]],), ())
            if tag in ENDS:
                targets, border = ENDS[tag]
                for _ in range(3):
                    close(targets, border)
            flush()
            if tag != "hr" and not ("-" in tag and m.group(3).endswith("/")):
                stack.append(self._open(stack[-1], tag, m.group(3)))
                still[tag] += 1
        tail = html[pos:]
        cut = _OPEN_END.search(tail)
        add(tail[:cut.start()] if cut else tail)
        flush()

    def _drop_link_lists(self) -> None:
        """Lists and other elements in which nearly all text is links."""
        total, linked, pieces = [0] * len(self.parent), [0] * len(self.parent), [0] * len(self.parent)
        for at, _, size, link in self.blocks:
            total[at] += size
            linked[at] += link
            pieces[at] += link > 0
        for at in range(len(self.parent) - 1, 0, -1):
            up = self.parent[at]
            total[up] += total[at]
            linked[up] += linked[at]
            pieces[up] += pieces[at]
        for at in range(1, len(self.parent)):
            if self.out[self.parent[at]] or (pieces[at] >= 2 and linked[at] >= 0.8 * total[at]
                                             and self.tag[at] in ("ul", "ol", "dl", "table", "div", "section", "tr")):
                self.out[at] = True

    def scores(self) -> dict[int, float]:
        """Per container the weight of the running text below it."""
        out: dict[int, float] = {}
        for at, _, size, link in self.blocks:
            if self.out[at]:
                continue
            weight, tag = float(max(size - 2 * link, 0)), self.tag[at]
            if tag in HEADINGS or tag == "li":
                weight *= 0.5
            while weight > FAINT:
                at = self.box[at]
                out[at] = out.get(at, 0.0) + weight
                if not at:
                    break
                at, weight = self.parent[at], weight * DECAY
        for at in out:
            if self.tag[at] in ("article", "main"):
                out[at] *= 1.5
        return out

    def paths(self) -> dict[str, float]:
        """Per container path the score of its best container."""
        best: dict[str, float] = {}
        for at, score in self.scores().items():
            if score > best.get(self.path[at], -1.0):
                best[self.path[at]] = score
        return best

    def vote(self) -> str | None:
        """The path of the best container; the first in page order of equals."""
        scores = self.scores()
        return self.path[min(scores, key=lambda at: (-scores[at], at))] if scores else None

    def text(self, path: str) -> str:
        """The blocks in all containers on a path.  Of containers without a
        name (plain ``div``, ``td``) only those near the best one's score."""
        scores, last = self.scores(), path.rsplit("/", 1)[-1]
        here = [at for at, p in enumerate(self.path) if p == path and not self.out[at]]
        if last in ("div", "td", "center"):
            floor = 0.25 * max((scores.get(at, 0.0) for at in here), default=0.0)
            here = [at for at in here if scores.get(at, 0.0) >= floor]
        chosen, inside = set(here), [False] * len(self.parent)
        for at in range(len(self.parent)):
            inside[at] = at in chosen or (at > 0 and inside[self.parent[at]])
        return "\n".join(text for at, text, _, _ in self.blocks if inside[at] and not self.out[at])


def choose(page: Page, winners: dict[str, float]) -> str | None:
    """The path that a page is extracted by; ``winners``: path -> share of
    the host's pages that voted for it."""
    best = page.paths()
    shared = [(winners[p] * s, s, p) for p, s in best.items() if p in winners and s > 0]
    return max(shared)[2] if shared else page.vote()


def _votes(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [Page(h).vote() if h else None for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], names=["host", "path"])


def _extract(keep: list[str]):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, won in zip(batch.column("html").to_pylist(), batch.column("won").to_pylist()):
                page = Page(html) if html else None
                path = choose(page, {w["path"]: w["share"] for w in won or ()}) if page else None
                texts.append(page.text(path) if path is not None else "")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])
    return run


def winning_paths(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``host, won``: per host the paths (with their share of its pages) that
    at least ``min_share`` of its pages vote for, so at most 1 / min_share.
    Needs ``host, html``."""
    votes = written(pages.select("host", "html").mapInArrow(_votes, "host string, path string")
                    .where(F.col("path").isNotNull()).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "host-votes")
    total = votes.groupBy("host").agg(F.sum("n").alias("pages"))
    share = F.col("n") / F.col("pages")
    return written(votes.join(total, "host").where(share >= min_share).groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("path", share.alias("share")))).alias("won")), "host-paths")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_share: float = MIN_SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Blocks are joined by one line feed; white space in a block is one space;
    character references are decoded.  A null, empty or textless page has the
    empty text.  Pages without a host (null or odd URLs) vote as one host.
    Null ids and repeated rows are rows like others; very long pages are read
    whole; other columns play no part; an empty table gives no rows.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    # joined as Spark sees fit: sent along where it is small, else by host,
    # a crowded host's pages split
    met = rows.join(winning_paths(rows, min_share), "host", "left").select("page_id", "url", "html", "won")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return met.mapInArrow(_extract(["page_id", "url"]), schema)

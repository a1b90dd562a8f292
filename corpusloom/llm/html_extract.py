"""Main text of web pages by consensus host paths.

Pass 1 (`container_scores`): each page is read into its containers; each gets a
score from the prose it holds, less what it holds of links and boilerplate, and a
generalised path of tags and classes (digits become #, order of classes does not
count), named by a hash of its steps. The best one is the page's vote. Pass 2
(`winning_paths`): Spark counts, per host, the votes of its pages for each path; every
path with at least a twentieth of them wins, so there are twenty at most. Pass 3
(`extract`): each page is read again and the containers on its host's best path that
it has are taken; a page that has none of them falls back to its own best container.

A mark of boilerplate covers what the marked container holds. A form, or a class or id
that shares a word with boilerplate ("share-layout"), may also be a wrapper of the whole
page: where hardly any prose would be left outside it, such a mark is dropped.

The reader is linear in the page, at any depth, and forgives unclosed tags as browsers do.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template title textarea xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split())
ENDS_P = frozenset("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
SCOPE = frozenset("html body table td th caption button object".split())
#: An open element (left) that a start tag of these (right) ends.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}}
#: Elements, roles and words of a class or id that mark boilerplate.
BOILER_TAGS = frozenset("nav header footer aside form button select dialog menu svg canvas object head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu sidebar rail footer header masthead ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs "
    "comment comments commentlist reply replies respond disqus widget toolbar pagination pager skip hidden".split()
)
#: Words of a class or id that no wrapper of an article has: what readers say.
READERS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: Elements in which a header belongs to the article and not to the site.
ARTICLE = frozenset(("article", "main", "section"))
#: Elements that are meant for the main text, and boilerplate whose end may be missing: it ends where the former start.
MEANT_TAGS, LOOSE = frozenset(("article", "main")), frozenset(("nav", "header", "aside", "footer"))
#: Elements that hold single blocks and are no containers of an article.
_SINGLE = frozenset("p li h1 h2 h3 h4 h5 h6 tr pre dt dd".split())

#: A host's path wins with one vote in so many.
SHARE = 20

#: A wrapper's mark is dropped if the rest of the page holds less than this share of the prose inside it.
LEFT = 0.2

#: Share of a block's worth that each container further up gets, and the weight of article and main.
CARRY, MEANT = 0.95, 1.25

#: Hosts up to which the winners (twenty numbers each at most) are broadcast; beyond, they are joined by shuffle, where Spark splits a host with most of the pages.
BROADCAST_HOSTS = 5_000

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSE = {tag: re.compile(f"</{tag}(?![a-z0-9])", re.I | re.A) for tag in RAW}
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")


def _step(path: int, step: str) -> int:
    """The hash of a path and one more step."""
    return int.from_bytes(hashlib.blake2b(f"{path}/{step}".encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


class Page:
    """Containers and blocks of a page.

    up[i], tag[i], path[i], depth[i], bad[i]: parent, element, generalised path (a hash
    of the parent's path and the own step), depth and whether boilerplate, of container
    i; blocks: [container, text, characters inside links].
    """

    def __init__(self, source: str) -> None:
        lost = self._whole(source, frozenset())
        if lost and any(t in MEANT_TAGS and self._within(i, lost) for i, t in enumerate(self.tag)):
            self._whole(source, lost)
        self.bad = self._covered()

    def _whole(self, source: str, ends: frozenset[int]) -> frozenset[int]:
        """Read the page; the containers `ends` end where an article or main element starts. Boilerplate elements without an end of their own come back."""
        self.up, self.tag, self.path, self.depth = [-1], ["body"], [0], [0]
        self.inside = [False]  # an element of ARTICLE
        self.mark = [0]  # 0: none, 1: of a possible wrapper, 2: of boilerplate for sure
        self.blocks: list[tuple[int, str, int]] = []
        self._text: list[str] = []
        self._links = 0
        return frozenset(self._read(source, ends))

    def _within(self, i: int, some: frozenset[int]) -> bool:
        while i > 0:
            i = self.up[i]
            if i in some:
                return True
        return False

    def _flush(self, at: int) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((at, text, self._links))
            self._text, self._links = [], 0

    def _say(self, raw: str, in_link: bool) -> None:
        if "&" in raw:
            raw = entities.unescape(raw)
        self._text.append(raw)
        if in_link:
            self._links += len(raw.strip())

    def _enter(self, parent: int, tag: str, attrs: str) -> int:
        """The container's number; boilerplate covers all that it holds."""
        classes, mark = "", 1 if tag == "form" else 2 if tag in BOILER_TAGS else 0
        if tag == "header" and self.inside[parent]:
            mark = 0
        if attrs and not attrs.isspace():
            for name, value in _ATTR.findall(attrs):
                name = name.lower()
                if value[:1] in ("'", '"'):
                    value = value[1:-1]
                if name in ("class", "id"):
                    low = value.lower()
                    words = _WORD.findall(low)
                    if not BOILER_WORDS.isdisjoint(words):
                        mark = max(mark, 1 if READERS.isdisjoint(words) else 2)
                    if name == "class":
                        classes = "." + ".".join(sorted(set(_DIGITS.sub("#", low).split()))) if low.strip() else ""
                elif name == "role":
                    mark = 2 if value.lower() in BOILER_ROLES else mark
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
                    mark = 2
        # html and body, which pages may leave out, are the root by another name
        root = tag in ("html", "body")
        self.up.append(parent)
        self.tag.append(tag)
        self.depth.append(self.depth[parent] + 1)
        self.path.append(self.path[parent] if root else _step(self.path[parent], tag + classes))
        self.mark.append(0 if root else mark)
        self.inside.append(self.inside[parent] or tag in ARTICLE)
        return len(self.up) - 1

    def _covered(self) -> list[bool]:
        """Which containers are boilerplate: they or what they stand in have a mark, and it is no wrapper's."""
        n = len(self.up)
        prose = [0] * n  # under a container and under no mark below it
        for c, text, linked in self.blocks:
            prose[c] += max(0, len(text) - 2 * linked)
        for i in range(n - 1, 0, -1):
            if self.mark[i] == 0:
                prose[self.up[i]] += prose[i]
        outside = prose[0]  # prose of the page that no mark covers
        bad = [False] * n
        for i in range(1, n):
            here = self.mark[i] > 0
            if self.mark[i] == 1 and not bad[self.up[i]] and prose[i] and outside < LEFT * prose[i]:
                here = False
                outside += prose[i]
            bad[i] = bad[self.up[i]] or here
        return bad

    def _read(self, source: str, ends: frozenset[int]) -> set[int]:
        lost: set[int] = set()
        stack: list[tuple[str, int]] = []  # open elements and the container each stands in or is
        here, links, open_p, pos, n = 0, 0, 0, 0, len(source)
        unclosed: set[str] = set()

        def leave(i: int) -> None:
            nonlocal here, links, open_p
            self._flush(here)
            gone = stack[i:]
            del stack[i:]
            lost.update(at for t, at in gone[1:] if t in LOOSE)
            here = stack[-1][1] if stack else 0
            links -= sum(t == "a" for t, _ in gone)
            open_p -= sum(t == "p" for t, _ in gone)

        while pos < n:
            at = source.find("<", pos)
            if at < 0:
                self._say(source[pos:], links > 0)
                break
            if at > pos:
                self._say(source[pos:at], links > 0)
            nxt = source[at + 1 : at + 2]
            if nxt == "!":
                end = source.find("-->", at + 4) + 3 if source.startswith("<!--", at) else source.find(">", at) + 1
                pos = end if end > at + 1 else n
                continue
            if nxt == "?":
                pos = source.find(">", at) + 1 or n
                continue
            m = _TAG.match(source, at) or _LOOSE.match(source, at)
            if not m:
                if nxt.isalpha() or (nxt == "/" and source[at + 2 : at + 3].isalpha()):
                    break  # a tag that the page's end cuts off
                self._say("<", links > 0)
                pos = at + 1
                continue
            pos, tag = m.end(), m[2].lower()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if tag in INLINE:
                            del stack[i]
                            links -= tag == "a"
                        else:
                            leave(i)
                        break
                    if stack[i][0] in SCOPE and tag not in SCOPE and tag not in ("tr", "tbody", "thead", "tfoot"):
                        break
                continue
            if tag in RAW:
                close = None if tag in unclosed else _CLOSE[tag].search(source, pos)
                if close is None:
                    unclosed.add(tag)
                if close is None and tag == "title":
                    continue
                pos = n if close is None else (source.find(">", close.start()) + 1 or n)
                continue
            if tag == "br":
                self._text.append(" ")
                continue
            if tag in INLINE:
                stack.append((tag, here))
                links += tag == "a"
                continue
            if tag in ENDS_P and open_p:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        leave(i)
                        break
                    if stack[i][0] in SCOPE:
                        break
            for i in range(len(stack) - 1, -1, -1):
                if tag in IMPLIED.get(stack[i][0], ()):
                    leave(i)
                elif stack[i][0] not in INLINE and stack[i][0] not in ("td", "th", "tr", "p"):
                    break
            if ends and tag in MEANT_TAGS:
                for i, (_, at) in enumerate(stack):
                    if at in ends:
                        leave(i)
                        break
            self._flush(here)
            if tag in VOID:
                continue
            here = self._enter(here, tag, m[3])
            stack.append((tag, here))
            open_p += tag == "p"
        self._flush(here)
        return lost.union(at for t, at in stack if t in LOOSE)

    def scores(self) -> list[float]:
        """What each container holds: prose counts, links and (a little) boilerplate count against.

        Each level up keeps CARRY of it, so a wrapper wins only by what it adds;
        elements that are meant for the main text weigh MEANT times as much.
        """
        out = [0.0] * len(self.up)
        for c, text, linked in self.blocks:
            size = len(text)
            if self.bad[c]:
                out[c] -= 0.05 * size
            else:
                out[c] += (size - 2.0 * min(linked, size)) * (1.0 if size >= 40 or text[-1:] in ".!?" else 0.5)
        for i in range(len(out) - 1, 0, -1):  # a container comes after the one that it stands in
            out[self.up[i]] += CARRY * out[i]
        return [s * MEANT if t in ("article", "main") else s for s, t in zip(out, self.tag, strict=True)]

    def ranked(self) -> list[tuple[int, int, float]]:
        """Candidate containers' paths with their depth and the best score of each, best first."""
        best: dict[int, tuple[float, int]] = {}
        for i, s in enumerate(self.scores()):
            if not self.bad[i] and s > 0 and self.tag[i] not in _SINGLE:
                had = best.get(self.path[i])
                if had is None or s > had[0]:
                    best[self.path[i]] = (s, self.depth[i])
        return sorted(((p, d, s) for p, (s, d) in best.items()), key=lambda x: (-x[2], x[1], x[0]))

    def main_text(self, paths: list[int]) -> str:
        """Blocks of the containers on the first of the paths that holds any on this page, else of its best container."""
        have = {p for p, b in zip(self.path, self.bad, strict=True) if not b}
        for path in [*(p for p in paths if p in have), *(p for p, _, _ in self.ranked()[:1])]:
            take = self._under(path)
            if kept := [t for c, t, _ in self.blocks if take[c] and not self.bad[c]]:
                return "\n".join(kept)
        return ""

    def _under(self, path: int) -> list[bool]:
        """Which containers are on the path or stand in one that is."""
        take = [False] * len(self.up)
        for i in range(len(self.up)):
            take[i] = self.path[i] == path or (i > 0 and take[self.up[i]])
        return take


def host_of(url: Column) -> Column:
    """The URL's host in lower case; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def container_scores(pages: DataFrame) -> DataFrame:
    """host, path, depth, score: the best-scored container of each page (columns host, html) is the page's vote."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(h, *best) for h, source in zip(b["host"], b["html"], strict=True) if h and source for best in Page(source).ranked()[:1]]
            yield pd.DataFrame(found, columns=["host", "path", "depth", "score"])

    return pages.select("host", "html").mapInPandas(run, "host string, path long, depth long, score double")


def winning_paths(scores: DataFrame) -> DataFrame:
    """host, paths: the host's paths with at least one in SHARE votes of its pages, by votes, then the highest scores, then the least depth.

    Votes are counted per task before anything moves, so a host with most of the
    pages sends no more than a small one.
    """
    votes = scores.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.round("score")).alias("worth"), F.min("depth").alias("depth"))
    order = F.struct((-F.col("votes")).alias("v"), (-F.col("worth")).alias("w"), "depth", "path")
    best = votes.withColumn("all", F.sum("votes").over(Window.partitionBy("host"))).filter(F.col("votes") * SHARE >= F.col("all"))
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text.

    A null or empty html gives the empty text; pages without a host in their url
    have no consensus and use their own best container. Repeated rows vote each.
    An empty table gives no rows. Other columns are not looked at.
    """
    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    won = Scratch(pages.sparkSession, "html").put(winning_paths(container_scores(rows)))
    small = won.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    joined = rows.join(F.broadcast(won) if small else won, "host", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [Page(source).main_text(list(p) if p is not None else []) if source else "" for source, p in zip(b["html"], b["paths"], strict=True)]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    out = joined.select("page_id", "url", "html", "paths").mapInPandas(run, "page_id string, url string, text string")
    return out.withColumn("page_id", F.col("page_id").cast(pages.schema[id_col].dataType))

"""Main text of web pages by deducing each host's template.

A page is a list of tokens: tags and text runs, each told apart by the path of elements it stands in.  Tokens of a host
with the same vector of occurrences over its pages form an equivalence class.  Classes nest by their elements: a token
counts if it is on most pages that have the element around it, and on most pages of the host or at least ``LAYOUT_PAGES``,
so each layout of a host gets its template; classes of one tag alone do not count.  The template tokens in the order of a
page, tags too, cut it into slots.  Slots with the same text on all their pages hold no content.  Pages with the same
template tags that occur once a page have one layout; the container whose slots hold most content over a layout's pages
is its article, and where containers are near to each other an article element wins.  A page's text is the slots inside.

Vectors are never gathered: a class is known by the exclusive-or of hashes of (page, count), which Spark sums up on the
map side, so a host with a third of all pages costs one row per token and task.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shared import written

SUPPORT = 0.6  # share of the pages with the element around it that a template token is on
LAYOUT_PAGES = 3  # pages that a template token of a rarer layout is on at least
NEAR = 0.5  # containers with this share of the best one's content are near to it
ARTICLE_WEIGHT = 1000.0
REMEMBERED_LENGTH = 200  # characters of attributes that are worth remembering
DEEPEST = 256  # elements inside each other that paths tell apart
LINK_WEIGHT = 0.1

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                    "small span strike strong sub sup time tt u var wbr").split())
CLOSES_P = frozenset(("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                      "h5 h6 header hr main menu nav ol p pre section table ul").split())
# An opening tag ends an open one of the first set unless one of the second stands between.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
SKIPPED = frozenset("nav footer aside form button fieldset dialog menu".split())
ARTICLES = frozenset(("article", "main"))
# Parts of class and id names that mark what is not the article.
MARKS = frozenset(("ad ads advert adverts advertisement banner promo promoted sponsor sponsored cookie cookies consent gdpr "
                   "notice alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar rail "
                   "related recommended share sharing social comment comments disqus replies reply respond footer masthead "
                   "newsletter subscribe signup login search widget pagination pager toolbar skip").split())
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<svg(?:\s[^<>]*)?/>"""
    r"""|<(script|style|noscript|template|svg|iframe|textarea|select|title|object|canvas)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>"""
    # A tag whose quotes do not close ends at the next bracket, so no look goes further than that.
    r"""|<(/?)([a-zA-Z][\w:-]*)([^<>]*)(?:>|(?=<)|\Z)|<[!?/][^>]*>""", re.S | re.I)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ARTICLE_PATH = r"/(article|main)(\.[^/]*)?$"
HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")
DIGITS = re.compile(r"\d+")


class Run(NamedTuple):
    """A text run: the path of its block elements, its text, whether it is skipped by name, in an article, in a link.

    ``marks`` numbers the elements marked by name around it that no ``article`` element holds; ``post`` tells whether it
    stands in an ``article`` element, ``place`` its position among the runs and tags of the page.
    """

    path: str
    block: int
    text: str
    skipped: bool
    article: bool
    link: bool
    marks: tuple[int, ...] = ()
    post: bool = False
    place: int = 0


class Element(NamedTuple):
    tag: str
    path: str
    skipped: bool  # marked by name inside an article element
    article: bool
    marks: tuple[int, ...]
    post: bool


def _named(attributes: str) -> tuple[str, bool]:
    """Signature of the class, id and role of a tag, and whether they mark something else than the article.

    Pages of a host repeat their tags, so the last short ones are remembered.
    """
    if not attributes:
        return "", False
    return _known_names(attributes) if len(attributes) <= REMEMBERED_LENGTH else _names(attributes)


def _names(attributes: str) -> tuple[str, bool]:
    parts = [m[2] or m[3] or m[4] or "" for m in NAMES.finditer(attributes)]
    if not parts:
        return "", False
    words = [w for w in re.split(r"[^a-z]+", " ".join(parts).lower()) if w]
    return DIGITS.sub("0", ".".join(" ".join(parts).split())), any(w in MARKS for w in words)


_known_names = lru_cache(maxsize=1 << 15)(_names)


class Tag(NamedTuple):
    """An opened element: its path, that of the block element around it, and its position among runs and tags."""

    path: str
    around: str
    place: int


def parsed(page: str) -> tuple[list[Run], list[Tag]]:
    """Text runs of the body in order, and all opened elements."""
    stack = [Element("", "", False, False, (), False)]
    runs: list[Run] = []
    tags: list[Tag] = []
    block, at, links = 0, 0, 0

    def text(raw: str) -> None:
        if raw:
            top = stack[-1]
            runs.append(Run(top.path, block, html.unescape(raw), top.skipped, top.article, links > 0, top.marks, top.post,
                            len(runs) + len(tags)))

    # A last tag that is cut short ends with the page, so the look for its end always finds one.
    size = len(page)
    if page.rfind("<") > page.rfind(">"):
        page += ">"
    opened: defaultdict[str, int] = defaultdict(int)
    paths: dict[str, str] = {}

    def close(first: int) -> None:
        nonlocal links
        for element in stack[first:]:
            opened[element.tag] -= 1
            links -= element.tag == "a"
        del stack[first:]

    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            continue
        name, closing = name.lower(), (m[2] or m[5]) == "/"
        if name not in INLINE:
            block += 1
        elif name == "br":
            text(" ")
        if closing:
            deep = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0) if opened[name] else 0
            if deep:
                # An inline tag closes nothing but inline elements.
                if name not in INLINE or all(e.tag in INLINE for e in stack[deep:]):
                    close(deep)
            continue
        if name in CLOSES_P and opened["p"]:
            open_p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag not in INLINE), 0)
            if open_p and stack[open_p].tag == "p":
                close(open_p)
        if name in SIBLINGS and any(map(opened.__getitem__, SIBLINGS[name][0])):
            ended, walls = SIBLINGS[name]
            i = len(stack) - 1
            while i > 0 and stack[i].tag not in walls:
                if stack[i].tag in ended:
                    close(i)
                i -= 1
        top = stack[-1]
        signature, marked = _named(m[4] or m[7] or "")
        # Deeper elements have paths like their siblings', so that paths stay short on any page.
        above = top.path if len(stack) <= DEEPEST else stack[DEEPEST].path
        path = top.path if name in INLINE else f"{above}/{name}{'.' if signature else ''}{signature}"
        path = paths.setdefault(path, path)
        tags.append(Tag(path if name not in INLINE else f"{path}/{name}", top.path, len(runs) + len(tags)))
        if name in VOID:
            continue
        links += name == "a"
        header = name == "header" and not top.article
        named = name in SKIPPED or header or marked and name != "body"
        opened[name] += 1
        stack.append(Element(name, path, top.skipped or named and top.post, top.article or name in ARTICLES,
                             (*top.marks, len(tags)) if named and not top.post else top.marks,
                             top.post or name == "article"))
    text(page[at:size])
    return runs, tags


def settled(runs: list[Run], template: frozenset[int] = frozenset()) -> list[Run]:
    """The runs with ``skipped`` decided: names are a hint, and the text that they would drop may overrule them.

    Inside an ``article`` element marked elements go.  Elsewhere a marked element stays if it holds the only article, or
    more than half of the page's text outside the template; if nothing else is left, marked elements are read too.
    """
    if not any(run.marks or run.skipped for run in runs):
        return runs
    sizes = [0.0 if run.skipped or not run.text.strip() or not run.article and run_token(run) in template
             else content(run) for run in runs]
    freed: set[int] = set()
    for held in ([i for i, run in enumerate(runs) if run.post and sizes[i]],
                 [i for i, run in enumerate(runs) if run.article and sizes[i]]):
        by_marks: dict[tuple[int, ...], float] = {}
        for i in held:
            by_marks[runs[i].marks] = by_marks.get(runs[i].marks, 0.0) + sizes[i]
        if by_marks and () not in by_marks:
            freed.update(max(by_marks, key=lambda marks: (by_marks[marks], marks)))
        if by_marks:
            break
    if not any(run.post and size for run, size in zip(runs, sizes)):
        inside: dict[int, float] = {}
        for run, size in zip(runs, sizes):
            for mark in run.marks:
                inside[mark] = inside.get(mark, 0.0) + size
        freed.update(mark for mark, size in inside.items() if 2 * size > sum(sizes))
    out = [run._replace(skipped=run.skipped or not freed.issuperset(run.marks)) for run in runs]
    if not any(size and not run.skipped for run, size in zip(out, sizes)):
        return [run._replace(skipped=run.skipped and any(sizes)) for run in runs]
    return out


def _hash(*parts: str) -> int:
    value = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def run_token(run: Run) -> int:
    """The token of a text run: its path and its text."""
    return _hash(run.path, " ".join(run.text.split()))


def tag_token(path: str) -> int:
    """The token of a tag: its path.  The page itself, around all elements, is 0."""
    return _hash("<", path) if path else 0


def _tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page its tokens with count and the token of the element around."""
    for frame in frames:
        out: list[tuple] = []
        for key, host, page in zip(frame["page"], frame["host"], frame["html"]):
            runs, tags = parsed(page or "")
            seen: dict[int, list] = {}
            for tag in tags:
                seen.setdefault(tag_token(tag.path), [0, tag_token(tag.around), False])[0] += 1
            for run in runs:
                if run.text.strip():
                    seen.setdefault(run_token(run), [0, tag_token(run.path), True])[0] += 1
            out.append((host, 0, 0, key, 1, False))
            out += [(host, token, around, key, n, fixed) for token, (n, around, fixed) in seen.items()]
        yield pd.DataFrame(out, columns=["host", "token", "around", "page", "n", "fixed"])


def _held(template: object, known: dict[bytes, frozenset[int]]) -> frozenset[int]:
    """The tokens of a stored template, made once per batch."""
    key = template.tobytes() if isinstance(template, np.ndarray) else b""
    if key not in known:
        known[key] = frozenset(template.tolist()) if key else frozenset()
    return known[key]


def layout_of(tags: list[Tag], skeleton: frozenset[int]) -> int:
    """One number for the set of a page's template tags that occur once a page."""
    out = 0
    for token in {tag_token(tag.path) for tag in tags} & skeleton if skeleton else ():
        out ^= token
    return out


def slots(runs: list[Run], tags: list[Tag], template: frozenset[int]) -> Iterator[tuple[int, Run]]:
    """The text runs that no template token covers, each with its slot: the template token last met before it."""
    stream = [(tag.place, tag_token(tag.path), None) for tag in tags]
    stream += [(run.place, run_token(run), run) for run in runs if run.text.strip()]
    last = 0
    for _, token, run in sorted(stream, key=lambda at: at[0]):
        if token in template:
            last = token
        elif run is not None and not run.skipped:
            yield last, run


def _regions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page its layout, and its slots by container with the worth and a hash of their text."""
    for frame in frames:
        out: list[tuple] = []
        known: dict[bytes, frozenset[int]] = {}
        for host, page, tokens, once in zip(frame["host"], frame["html"], frame["template"], frame["skeleton"]):
            template = _held(tokens, known)
            runs, tags = parsed(page or "")
            layout = layout_of(tags, _held(once, known))
            cut: dict[tuple[str, int], list] = {}
            for slot, run in slots(settled(runs, template), tags, template):
                cut.setdefault((container(run), slot), []).append(run)
            # Without a path: the page itself.
            out.append((host, layout, None, 0, 0, 0.0))
            out += [(host, layout, path, slot, _hash(*[run.text for run in inside]), sum(map(content, inside)))
                    for (path, slot), inside in cut.items()]
        yield pd.DataFrame(out, columns=["host", "layout", "path", "slot", "text", "worth"])


def content(run: Run) -> float:
    """What the text of a run counts, whatever the names around it: links little."""
    return len(run.text.strip()) * (LINK_WEIGHT if run.link else 1.0)


def worth(run: Run) -> float:
    """What the text of a run counts on a page without a main container of its layout: articles much."""
    return content(run) * (ARTICLE_WEIGHT if run.article else 1.0)


def container(run: Run) -> str:
    """The element that a run's block stands in: the article, or the parent of its block."""
    steps = run.path.split("/")
    for i, step in enumerate(steps):
        if step.partition(".")[0] in ARTICLES:
            return "/".join(steps[:i + 1])
    return "/".join(steps[:-1])


def extracted(page: str, template: frozenset[int], main: str | None, skeleton: frozenset[int] = frozenset(),
              mains: dict[int, str] | None = None) -> str:
    """The slots of a page inside the main container of its layout or host, or else of the page's own.

    Inside an article no run is dropped for being common: a passage that many articles share is still their text.
    """
    runs, tags = parsed(page)
    if mains:
        main = mains.get(layout_of(tags, skeleton), main)
    kept = [run for run in settled(runs, template) if not run.skipped
            and (run.article or not run.text.strip() or run_token(run) not in template)]
    inside = [run for run in kept if main is not None and (run.path == main or run.path.startswith(main + "/"))]
    if not any(run.text.strip() for run in inside):
        sizes: dict[str, float] = {}
        for run in kept:
            sizes[container(run)] = sizes.get(container(run), 0.0) + worth(run)
        best = max(sizes, key=lambda path: (sizes[path], path), default="")
        inside = [run for run in kept if run.path == best or run.path.startswith(best + "/")]
    blocks: dict[int, list[str]] = {}
    for run in inside:
        blocks.setdefault(run.block, []).append(run.text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return " ".join(b for b in joined if b)


def host_of(url: Column) -> Column:
    """Host of a URL in small letters; empty for none."""
    return F.lower(F.coalesce(F.regexp_extract(url, HOST.pattern, 1), F.lit("")))


def host_templates(pages: DataFrame) -> DataFrame:
    """Per host: pages, the tokens of its valid classes, those that are tags met once a page, the path of its main
    container, and the layouts that have another one.  Written."""
    spread = pages.select(F.xxhash64("page_id", "url").alias("page"), host_of(F.col("url")).alias("host"), "html")
    tokens = spread.mapInPandas(_tokens, "host string, token long, around long, page long, n int, fixed boolean")
    summed = written(tokens.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
        F.min("around").alias("around"), F.max("n").alias("most"), F.bool_or("fixed").alias("fixed"))
        .where("token = 0 or pages > 1"), "tokens")
    hosts = written(summed.where("token = 0").select("host", F.col("pages").alias("all_pages")), "hosts")
    around = summed.select("host", F.col("token").alias("around"), F.col("pages").alias("around_pages"))
    common = (summed.where("token <> 0").join(hosts, "host").join(around, ["host", "around"])
              .where((F.col("all_pages") > 1) & (F.col("pages") >= SUPPORT * F.col("around_pages"))
                     & ((F.col("pages") >= SUPPORT * F.col("all_pages")) | (F.col("pages") >= LAYOUT_PAGES))))
    classes = common.groupBy("host", "vector").agg(
        F.collect_list("token").alias("tokens"), F.bool_or("fixed").alias("fixed"),
        F.collect_list(F.when(~F.col("fixed") & (F.col("most") == 1), F.col("token"))).alias("skeleton"))
    valid = classes.where((F.size("tokens") > 1) | F.col("fixed")).groupBy("host").agg(
        F.flatten(F.collect_list("tokens")).alias("template"), F.flatten(F.collect_list("skeleton")).alias("skeleton"))
    template = written(hosts.join(valid, "host", "left"), "tokens_of_hosts")
    # A second pass over the pages: only the template tells the slots.
    cut = (spread.select("host", "html").join(template.select("host", "template", "skeleton"), "host")
           .mapInPandas(_regions, "host string, layout long, path string, slot long, text long, worth double")
           .groupBy("host", "layout", "path", "slot").agg(
               F.count(F.lit(1)).alias("pages"), F.min("text").alias("least"), F.max("text").alias("greatest"),
               F.sum("worth").alias("worth")))
    cut = written(cut.where("path is null or pages = 1 or least <> greatest"), "slots")

    def best(*keys: str) -> DataFrame:
        regions = cut.where("path is not null").groupBy(*keys, "path").agg(F.sum("worth").alias("worth"))
        top = regions.groupBy(*keys).agg(F.max("worth").alias("top"))
        return regions.join(top, list(keys)).where(F.col("worth") >= NEAR * F.col("top")).groupBy(*keys).agg(
            F.max_by("path", F.struct(F.col("path").rlike(ARTICLE_PATH).alias("named"), "worth", "path")).alias("main"))

    mains = best("host")
    known = cut.where(F.col("path").isNull() & (F.col("pages") >= LAYOUT_PAGES)).select("host", "layout")
    others = (best("host", "layout").withColumnRenamed("main", "own").join(known, ["host", "layout"]).join(mains, "host")
              .where("own <> main").groupBy("host").agg(
                  F.sort_array(F.collect_list(F.struct("layout", "own"))).alias("others"))
              .select("host", F.col("others.layout").alias("layouts"), F.col("others.own").alias("layout_mains")))
    return written(template.join(mains, "host", "left").join(others, "host", "left"), "templates")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, main text, its length in code points, and the number of template tokens of the host.

    Null and empty pages have empty text; null URLs share one nameless host; a host of one page has no template and is
    read by element names alone; repeated rows count each time; an empty table gives no rows; other columns are ignored.
    Templates are tokens that most pages of a host share, so their size does not grow with the pages; they are broadcast
    only if their stored size allows.
    """
    met = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(
        host_templates(pages), "host", "left")

    def read(page: pd.Series, template: pd.Series, main: pd.Series, skeleton: pd.Series, layouts: pd.Series,
             own: pd.Series) -> pd.Series:
        known: dict[bytes, frozenset[int]] = {}
        return pd.Series([extracted(p, _held(t, known), m if isinstance(m, str) else None, _held(k, known),
                                    dict(zip(at, paths)) if isinstance(at, np.ndarray) else None)
                          if isinstance(p, str) else ""
                          for p, t, m, k, at, paths in zip(page, template, main, skeleton, layouts, own)], dtype=object)

    return met.withColumn("text", F.pandas_udf(read, T.StringType())(
        "html", "template", "main", "skeleton", "layouts", "layout_mains")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"),
        F.coalesce(F.size("template"), F.lit(0)).alias("n_template"))

"""Main-text extraction by consensus over hosts.

Every page scores its containers by the text that they hold against links and boilerplate, climbs from
the best one to the whole article around it, and votes for the path of that; paths are generalised (tags and classes, numbers as #). Spark counts
the votes of each host, and every page is then extracted again from its host's winning path, so that
a page whose own scores mislead follows its siblings.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, measured, small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_NAME_PARTS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Fixed values of the language: elements whose content is no markup, that have no content, that hold
# blocks, and that start and end a block of text.
_RAW = frozenset("script style noscript template iframe textarea title svg object canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset(
    "html body div section article main aside nav header footer form table tbody thead tfoot tr td th ul ol dl li dd dt "
    "blockquote figure figcaption details summary fieldset dialog center menu address search".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre hr caption legend".split())

# What is never main text, by element, role and word of a class or id; form controls,
# which stand inside blocks; words that say nothing of their own beside those; and words of reader
# comments, the only ones that make an article none.
_BOILERPLATE_TAGS = frozenset("nav aside footer form dialog menu search".split())
_CONTROLS = frozenset("button select option optgroup datalist label".split())
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert button".split())
_BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget widgets footer foot masthead topbar "
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion promoted "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments commentlist disqus respond reply replies discussion share sharing social related recommended "
    "recommendations pagination pager toolbar copyright".split())
_NEUTRAL_WORDS = frozenset(
    "box bar list title heading header head link links button buttons btn icon icons site page post posts article articles entry entries block section area "
    "wrapper wrap container inner outer content body text item items label panel count meta info module region slot unit row col "
    "column group holder fixed sticky float top bottom left right main primary secondary global first last id form field large small "
    "js is has the and of to".split())
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies".split())
_HEADER_WORDS = frozenset(("header",))

#: Pages without article or main: the share of a page's text that counts as nearly all of it.
_NEARLY_ALL = 0.98


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text else {}


def _names(attributes: dict[str, str]) -> list[frozenset[str]]:
    """The words of each class, and of the id."""
    every = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return [frozenset(w for w in _NAME_PARTS.split(_CAMEL.sub(" ", name).lower()) if w) for name in every]


def _says(names: list[frozenset[str]], words: frozenset[str]) -> bool:
    """Whether a whole name is of these words, next to neutral ones: ``social-bar`` is, ``social-history`` is not."""
    return any(name & words and name <= words | _BOILERPLATE_WORDS | _NEUTRAL_WORDS for name in names)


def _is_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _BOILERPLATE_TAGS:
        return True
    if not attributes:
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    if (attributes.get("role", "").lower() in _BOILERPLATE_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in style or "visibility:hidden" in style):
        return True
    if tag in ("html", "body", "main"):
        return False
    return _says(_names(attributes), _COMMENT_WORDS if tag == "article" else _BOILERPLATE_WORDS)


class _Ends:
    """Where elements of a text end; each tag's are matched once, however many there are."""

    def __init__(self, text: str):
        self.text = text
        self.ends: dict[str, dict[int, int]] = {}

    def after(self, tag: str, at: int) -> int:
        """Behind the closing tag of the element whose opening tag ends at ``at``; -1 without one."""
        if tag not in self.ends:
            found, opened = self.ends.setdefault(tag, {}), []
            for m in re.finditer(rf"<(/?){re.escape(tag)}(?![^\s/>])[^>]*>", self.text, re.I):
                if not m[1] and not m[0].endswith("/>"):
                    opened.append(m.end())
                elif m[1] and opened:
                    found[opened.pop()] = m.end()
        return self.ends[tag].get(at, -1)


def _step(tag: str, attributes: dict[str, str]) -> str:
    """One step of a generalised path: tag and classes, numbers as #."""
    classes = sorted(set(re.sub(r"[0-9]+", "#", attributes.get("class", "").lower()).split()))
    return ".".join([tag, *classes])


@dataclass
class Container:
    path: str
    parent: "Container | None"
    boilerplate: bool
    article: bool
    first: int  # blocks from here
    last: int = -1  # to here, exclusive
    chars: int = 0
    links: int = 0
    score: float = 0.0


@dataclass
class Page:
    """Containers in page order, blocks of text (text, in boilerplate at the depth of container), and
    which blocks are headlines."""

    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[str, Container]] = field(default_factory=list)
    headlines: list[int] = field(default_factory=list)


def parse(source: str | None) -> Page:
    """Containers and blocks of a page; unclosed and misnested elements are closed by their parents."""
    page = Page()
    root = Container("", None, False, False, 0)
    page.containers.append(root)
    stack: list[tuple[str, Container]] = [("", root)]
    parts: list[str] = []
    linked, in_link, headline, muted = 0, 0, False, False
    at, text = 0, source or ""
    ends = _Ends(text)

    def words(raw: str) -> None:
        nonlocal linked
        if raw and not muted:
            raw = entities.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if in_link:
                linked += len(raw.strip())

    def block_ends() -> None:
        nonlocal linked, muted
        muted = False  # boilerplate that a block holds ends with it, closed or not
        if parts:
            line = _SPACE.sub(" ", "".join(parts)).strip()
            parts.clear()
            if line:
                own = stack[-1][1]
                own.chars += len(line)
                own.links += min(linked, len(line))
                if headline and not own.boilerplate and 2 * linked < len(line):
                    page.headlines.append(len(page.blocks))
                page.blocks.append((line, own))
        linked = 0

    while True:
        m = _TOKEN.search(text, at)
        if not m:
            words(text[at:])
            break
        words(text[at:m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                words(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW and not closing:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
                at = end.end() if end else len(text)
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        if tag not in _BLOCKS:
            if not closing and tag not in _VOID and not m[3].endswith("/") and (
                    tag in _CONTROLS or m[3] and _is_boilerplate(tag, _attributes(m[3]))):
                end = ends.after(tag, at)
                if end >= 0:
                    at, in_link = end, 0 if tag == "a" else in_link
                    parts.append(" ")
                else:
                    muted = True
            continue
        block_ends()
        headline = tag == "h1" and not closing
        if tag not in _CONTAINERS or tag in _VOID:
            in_link = 0
            muted = not closing and bool(m[3]) and tag not in _VOID and _is_boilerplate(tag, _attributes(m[3]))
            continue
        if closing:
            names = [t for t, _ in stack]
            if tag in names:
                while True:
                    name, done = stack.pop()
                    done.last = len(page.blocks)
                    if name == tag:
                        break
            continue
        if tag in ("li", "td", "th", "tr", "dd", "dt") and stack[-1][0] == tag:
            stack.pop()[1].last = len(page.blocks)
        attributes = _attributes(m[3])
        up = stack[-1][1]
        header = tag == "header" or tag == "div" and any(name & _HEADER_WORDS for name in _names(attributes))
        own = _is_boilerplate(tag, attributes) or header and not up.article
        made = Container(f"{up.path}>{_step(tag, attributes)}" if up.path else _step(tag, attributes), up,
                         up.boilerplate or own, up.article or tag in ("article", "main"), len(page.blocks))
        page.containers.append(made)
        if not m[3].endswith("/"):
            stack.append((tag, made))
        else:
            made.last = len(page.blocks)
    block_ends()
    for _, left in stack:
        left.last = len(page.blocks)
    return page


def best_container(page: Page) -> Container:
    """The container with the highest score: characters outside links of its own blocks, half of
    what its children hold, a quarter of theirs, and so on; articles count double."""
    for c in page.containers:
        c.score = 0.0
    for c in page.containers:
        if c.boilerplate or not c.chars:
            continue
        worth, up = float(c.chars - 2 * c.links), c
        while up is not None:
            up.score += worth * (2.0 if up.article else 1.0)
            worth, up = worth / 2, up.parent
    usable = [c for c in page.containers if not c.boilerplate]
    return max(usable, key=lambda c: c.score)


def whole_article(page: Page, best: Container) -> Container:
    """The container of the article that ``best`` is a part of.

    - That is the outermost article around it, or else the outermost main.
    - Without either it is the lowest container with nearly all text outside links and boilerplate.
    - If that has no headline, it is the lowest container around it with one; an article or main is
      not left for the whole body.
    """
    if best.score <= 0:
        return best
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    tags = [c.path.rpartition(">")[2].partition(".")[0] for c in around]
    marked = [i for i, t in enumerate(tags) if t == "article"] or [i for i, t in enumerate(tags) if t == "main"]
    if marked:
        found = marked[-1]
    else:
        texts = [(c.chars - 2 * c.links, c) for c in page.containers if not c.boilerplate and c.chars > 2 * c.links]
        enough = _NEARLY_ALL * sum(n for n, _ in texts)
        held = dict.fromkeys(map(id, around), 0)
        for n, c in texts:
            up: Container | None = c
            while up is not None:
                if id(up) in held:
                    held[id(up)] += n
                up = up.parent
        found = next(i for i, c in enumerate(around) if held[id(c)] >= enough)
    for i in range(found, len(around)):
        if marked and i > found and tags[i] in ("body", "html", ""):
            break
        if any(around[i].first <= h < around[i].last for h in page.headlines):
            return around[i]
    return around[found]


def text_of(page: Page, chosen: list[Container]) -> str:
    """The blocks of the chosen containers in page order, without boilerplate inside them."""
    spans = [(c.first, c.last) for c in chosen]
    return "\n".join(line for i, (line, own) in enumerate(page.blocks)
                     if not own.boilerplate and any(a <= i < b for a, b in spans))


def extract_text(source: str | None, path: str | None) -> str:
    """Main text from the containers with this path; from the page's own best where it has none
    with text."""
    page = parse(source)
    if path is not None:
        found = text_of(page, [c for c in page.containers if c.path == path and not c.boilerplate])
        if found:
            return found
    return text_of(page, [whole_article(page, best_container(page))])


def extract(pages: DataFrame, host_of, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` and each row's main text, all columns kept.

    ``host_of`` is a column (or column name) whose rows share templates, normally the url's host.

    - A null or empty page has the empty text. Text outside any element is extracted too. Pages of any length
      are read whole. A column named ``out_col`` must not be there yet.
    - Null hosts vote together, like any other host. Repeated rows vote once each and get equal texts.
    - Of paths with equal votes the one that holds more text wins, then the first by name.
    - Only rows of hosts whose table of winners is too large to broadcast are shuffled with their html.
    """
    if free_name(pages, out_col) != out_col:
        raise ValueError(f"there is a column {out_col} already: name another one")
    small_batches(pages.sparkSession)

    @F.pandas_udf("path string, score double")
    def vote(sources: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in sources:
            parsed = [parse(s) for s in batch]
            best = [best_container(p) for p in parsed]
            yield pd.DataFrame({"path": [whole_article(p, c).path for p, c in zip(parsed, best, strict=True)],
                                "score": [c.score for c in best]})

    @F.pandas_udf("string")
    def again(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, paths in batches:
            yield pd.Series([extract_text(s, None if pd.isna(p) else p) for s, p in zip(sources, paths, strict=True)], dtype=object)

    host = F.col(host_of) if isinstance(host_of, str) else host_of
    votes = pages.select(host.alias("host"), vote(F.col(html_col)).alias("v")).where("v.score > 0").groupBy("host", F.col("v.path").alias("path")).agg(
        F.count("*").alias("votes"), F.sum(F.round("v.score").cast("long")).alias("text"))
    winners = votes.groupBy(F.struct("host").alias("_host")).agg(
        F.max_by("path", F.struct("votes", "text", F.lit(0) - F.length("path"), "path")).alias("_path"))
    winners = measured(winners, "host-paths", F.lit(32) + 2 * F.length("_path") + F.coalesce(F.length("_host.host"), F.lit(0)))
    key, winner, path = (free_name(pages, x) for x in ("_host", "_winner_host", "_winner_path"))
    joined = pages.withColumn(key, F.struct(host.alias("host"))).join(
        winners.select(F.col("_host").alias(winner), F.col("_path").alias(path)), F.col(key) == F.col(winner), "left")
    return joined.select(*[pages[c] for c in pages.columns], again(pages[html_col], F.col(path)).alias(out_col))

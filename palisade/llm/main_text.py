"""Main text of web pages by consensus of the pages of a host.

Each page's containers are scored by the text they hold against the page furniture and links in them. The best ones vote, by
their generalised path of tags and classes, for their host; the votes are summed in Spark. Every page is then read again with
all paths that two or more pages of its host voted for, strongest first; the first one that holds at least half of the text of the
page's own best container wins, and what that container holds outside the winner is added, but for parts that are mostly links.
A page without such a path has its own best container.

Text is read in blocks: block-level tags and line breaks end a block, inline tags don't. Furniture is left out by tag and role:
menus, headers (headings inside an article stay), footers, adverts, forms, scripts, styles, comments. Words of furniture in class
and id are a suspicion only, judged when the page is read: the element goes if it holds no article, main or content-marked
container and not most of the page's text; else its text stays and counts against the containers around it. A page that has text
outside furniture tags never ends empty.

Defined cases: null and empty html give an empty text; unclosed, crossed and unknown tags never fail; pages without host vote
among themselves; repeated rows give repeated results; extra columns are ignored; no pages give no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.operators.skew import hot_safe_join
from palisade.session import written

VOTES = 3
# A path of one page alone is no consensus; that page's own best container says the same.
VOTERS = 2
# Steps of a path that are spelled out; what lies outside them is one hash, so different paths stay different.
PATH_STEPS = 12
# Broadcast bound: winning paths of all hosts.
PATH_ROWS = 400_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

RAW = frozenset("script style noscript template iframe svg annotation annotation-xml textarea title object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td center details".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption address hr br"
    " nav header footer aside form fieldset menu dialog head select option button summary".split())
DROPPED = frozenset("nav footer aside form menu dialog head select button".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
FURNITURE = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup"
    " modal overlay newsletter subscribe subscription sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead"
    " footer comment comments reply replies disqus discussion related recommended recommendations share sharing social widget login"
    " signup search toolbar pagination pager skip alert".split())
# What an open element of the same kind is closed by.
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "p": ("p",)}
CONTENT = frozenset("article content post story entry main text body".split())
# A suspect with most of the page's text counts as furniture beside marked content that holds at least this part of its size.
APART = 8

_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[^a-z]+")


@dataclass
class Page:
    """Containers in page order with parent, path and kind, and the kept texts: (block, container, text).

    ``weight`` is what a container's text counts for the containers around it; suspects are named as furniture by class or id.
    """

    parents: list[int] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    bonus: list[float] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    content: list[bool] = field(default_factory=list)
    suspects: list[int] = field(default_factory=list)
    kept: list[tuple[int, int, str]] = field(default_factory=list)
    lost: Counter = field(default_factory=Counter)
    linked: Counter = field(default_factory=Counter)


def parse(source: str) -> Page:
    page = Page([-1], [""], [0.0], [1.0], [False])
    stack: list[tuple[str, int, bool]] = []  # tag, container, whether it is dropped
    opened: Counter = Counter()
    here, block, dropped = 0, 0, 0
    pos, n = 0, len(source)

    def pop() -> None:
        nonlocal here, dropped
        tag, container, drop = stack.pop()
        opened[tag] -= 1
        dropped -= drop
        if container >= 0:
            here = page.parents[container]

    def close(tags: tuple[str, ...], through: bool) -> None:
        """Close the nearest open element of ``tags``; only ``through`` containers if told so."""
        if not any(opened[t] for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                while len(stack) > k:
                    pop()
                return
            if stack[k][1] >= 0 and not through:
                return

    while pos < n:
        m = TOKEN.match(source, pos)
        pos = m.end()
        text = m["text"] if m["text"] is not None else m["data"]
        if text is not None:
            if m["text"] is not None:
                text = entities.unescape(text)
            size = len(text.strip())
            if dropped:
                page.lost[here] += size
            else:
                page.kept.append((block, here, text))
                if size and opened["a"]:
                    page.linked[here] += size
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in BLOCKS:
            block += 1
        if m["end"]:
            close((tag,), tag in BLOCKS)
            continue
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, pos) if not m["attrs"].endswith("/") else None
            if found:
                pos = found.end()
            elif tag in ("script", "style"):
                pos = n
            continue
        if tag in VOID:
            continue
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], False)
        elif tag in BLOCKS:
            close(("p",), False)
        said = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(m["attrs"])} if m["attrs"] else {}
        names = f"{said.get('class', '')} {said.get('id', '')}".lower()
        marks = set(_WORDS.split(names))
        drop = tag in DROPPED or said.get("role", "").lower() in ROLES or said.get("aria-hidden") == "true"
        drop = drop or "display:none" in said.get("style", "").replace(" ", "").lower() or bool(re.search(r"(?<![\w-])hidden(?![\w-])(?!\s*=)", ATTR.sub("", m["attrs"])))
        if tag == "header":
            drop = not (opened["article"] or opened["main"])
        elif opened["header"] and (opened["article"] or opened["main"]) and not dropped and tag in BLOCKS and tag not in CONTAINERS:
            drop = drop or not (tag[0] == "h" and tag[1:].isdigit())
        suspect = tag not in ("html", "body", "article", "main", "header") and not marks.isdisjoint(FURNITURE) and not _is_content(names)
        container = -1
        if tag in CONTAINERS or suspect:
            classes = ".".join(sorted(_DIGITS.sub("#", c) for c in said.get("class", "").lower().split()))
            step = f"{tag}.{classes}" if classes else tag
            container = len(page.paths)
            page.parents.append(here)
            page.paths.append(_below(page.paths[here], step))
            page.bonus.append(0.2 if tag in ("article", "main") or said.get("role", "") in ("main", "article") else 0.1 if marks & CONTENT and not suspect else 0.0)
            page.weight.append(1.0)
            page.content.append(page.bonus[-1] > 0 and (marks.isdisjoint(FURNITURE) or _is_content(names)))
            if suspect:
                page.suspects.append(container)
            here = container
        stack.append((tag, container, bool(drop)))
        opened[tag] += 1
        dropped += bool(drop)
    if page.suspects:
        _judge(page)
    return page


def _below(path: str, step: str) -> str:
    """The path of a container one step below another."""
    steps = [*path.split(">"), step]
    if len(steps) <= PATH_STEPS:
        return ">".join(steps)
    outer = hashlib.blake2b(">".join(steps[:2]).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    return ">".join([f"~{outer}", *steps[2:]])


def _is_content(names: str) -> bool:
    """Whether one of the names says content and nothing of furniture, as in class="post social-science"."""
    words = [set(_WORDS.split(name)) for name in names.split()]
    return any(w & CONTENT and w.isdisjoint(FURNITURE) for w in words)


def _judge(page: Page) -> None:
    """Drops the suspects that hold neither content nor most of the text around them; the text of the others stays, with a weight."""
    n = len(page.paths)
    size, clear = [0] * n, [0] * n
    suspects, inside, base = set(page.suspects), [False] * n, [0] * n
    for c in range(1, n):
        up = page.parents[c]
        inside[c] = c in suspects or inside[up]
        base[c] = up if page.content[up] else base[up]
    for _, c, text in page.kept:
        size[c] += len(text.strip())
        clear[c] += 0 if inside[c] else len(text.strip())
    holds = [False] * n
    for c in range(n - 1, 0, -1):
        up = page.parents[c]
        size[up] += size[c]
        clear[up] += clear[c]
        holds[up] = holds[up] or holds[c] or (page.content[c] and size[c] > 0)
    apart = max((clear[c] for c in range(1, n) if page.content[c]), default=0)
    gone = [False] * n
    for c in range(1, n):
        gone[c] = gone[page.parents[c]]
        if c in suspects and not gone[c]:
            most = 2 * size[c] > size[base[c]]
            if most and (base[c] or APART * apart < size[c]):
                page.weight[c] = 0.5
            elif most or holds[c]:
                page.weight[c] = -1.0
            else:
                gone[c] = True
    if all(gone[c] for _, c, text in page.kept if text.strip()):
        # All text of the page lies in suspects of which none stands out: none counts.
        gone = [False] * n
    for _, c, text in page.kept:
        if gone[c]:
            page.lost[c] += len(text.strip())
    page.kept = [k for k in page.kept if not gone[k[1]]]
    page.linked = Counter({c: size for c, size in page.linked.items() if not gone[c]})


def totals(page: Page) -> list[tuple[int, int, int]]:
    """(kept, furniture, linked) characters of every container with all that is inside."""
    kept = [0] * len(page.paths)
    lost, linked = list(kept), list(kept)
    for _, c, text in page.kept:
        kept[c] += len(text.strip())
    for c, size in page.lost.items():
        lost[c] += size
    for c, size in page.linked.items():
        linked[c] += size
    for c in range(len(page.paths) - 1, 0, -1):
        for row in (kept, lost, linked):
            row[page.parents[c]] += row[c]
    return list(zip(kept, lost, linked, strict=True))


def counted(page: Page, sums: list[tuple[int, int, int]]) -> list[float]:
    """The kept characters of every container, those in suspects by weight."""
    if not page.suspects:
        return [k for k, _, _ in sums]
    own = [float(k) for k, _, _ in sums]
    for c in range(len(own) - 1, 0, -1):
        if page.weight[c] != 1:
            # What hangs in ``c`` counts as a whole, whatever it holds.
            change = page.weight[c] * sums[c][0] - own[c]
            while c >= 0:
                own[c] += change
                c = page.parents[c]
    return own


def ranked(page: Page) -> list[tuple[float, int]]:
    """(score, container), best first: kept text counts, furniture, links and named suspects count against; the inner one wins a tie."""
    sums = totals(page)
    scores = [(w * (1 + b) - 2 * a - 2 * x, c)
              for c, ((k, a, x), w, b) in enumerate(zip(sums, counted(page, sums), page.bonus, strict=True)) if k]
    return sorted(scores, key=lambda s: (-s[0], -s[1]))


def text_of(page: Page, containers: set[int], best: int | None = None) -> str:
    """The kept text inside any of the containers, block by block; with ``best`` also its text outside them, without link lists."""
    inside = [c in containers for c in range(len(page.paths))]
    for c in range(1, len(page.paths)):
        inside[c] = inside[c] or inside[page.parents[c]]
    if best is not None and not inside[best]:
        around: set[int] = set()
        for c in containers:
            while c >= 0 and c not in around:
                around.add(c)
                c = page.parents[c]
        own, sums = [False] * len(inside), totals(page)
        own[best] = True
        for c in range(best + 1, len(inside)):
            kept, _, linked = sums[c]
            own[c] = own[page.parents[c]] and (c in around or 2 * linked <= kept)
        inside = [a or b for a, b in zip(inside, own, strict=True)]
    blocks: dict[int, list[str]] = {}
    for block, c, text in page.kept:
        if inside[c]:
            blocks.setdefault(block, []).append(text)
    return " ".join(filter(None, (" ".join("".join(own).split()) for own in blocks.values())))


def extracted(source: str | None, winners: list[str]) -> str:
    page = parse(source or "")
    best = ranked(page)
    if not best:
        return ""
    sums = totals(page)
    there: dict[str, set[int]] = {}
    for c in range(1, len(page.paths)):
        there.setdefault(page.paths[c], set()).add(c)
    for path in winners:
        found = there.get(path)
        if found and 2 * sum(sums[c][0] for c in found) >= sums[best[0][1]][0]:
            return text_of(page, found, best[0][1])
    return text_of(page, {best[0][1]})


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, voters): the share of its page's text that each of the page's best containers holds, summed."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given: Counter = Counter()
            voters: Counter = Counter()
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = parse(source or "")
                best = [(s, c) for s, c in ranked(page)[:VOTES] if s > 0 and c]
                for score, c in best:
                    given[host, page.paths[c]] += score / best[0][0]
                voters.update({(host, page.paths[c]) for _, c in best})
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in given], pa.string()), pa.array([p for _, p in given], pa.string()),
                 pa.array([round(1000 * v) for v in given.values()], pa.int64()), pa.array([voters[k] for k in given], pa.int64())],
                ["host", "path", "votes", "voters"])

    cast = pages.select("host", "html").mapInArrow(vote, "host string, path string, votes long, voters long")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("voters").alias("voters"))


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    shared = votes(pages).where(F.col("voters") >= VOTERS)
    lists = written(shared.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("nth"), "path"))).alias("w"))
                    .select("host", F.transform("w", lambda x: x["path"]).alias("winners")), "winners")
    paths = lists.agg(F.coalesce(F.sum(F.size("winners")), F.lit(0))).first()[0]
    joined = pages.join(F.broadcast(lists), "host", "left") if paths <= PATH_ROWS else hot_safe_join(pages, lists, ["host"], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extracted(h, w or []) for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "winners").mapInArrow(
        extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")

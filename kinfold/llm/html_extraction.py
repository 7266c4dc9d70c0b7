"""Main text of web pages by minimum-cut labelling (operator 8).

A page is cut into blocks. Each block gets a score: log odds of its features, trained by counting over a sample of pages whose
markup names content or boilerplate, plus a prior for what the markup around it says. Scores are the terminal
capacities, both bounded, so that neither settles a block against the other and all edges; edges between neighbours in page order and between siblings in the tree are smoothness capacities. The minimum cut,
found by max-flow, separates content from boilerplate.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

# Element names and name parts of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
BAD_TAGS = frozenset("nav header footer aside form button menu dialog head fieldset".split())
#: Elements whose content is skipped but parsed: they end with their parent, and svg and math can close themselves.
NESTED = frozenset("svg math object select canvas template".split())
#: Nothing within these is content; other boilerplate can hold an article, and a form the whole page.
CLOSED = frozenset("nav footer aside button menu dialog head".split())
FORMS = frozenset("form fieldset".split())
GOOD_TAGS = frozenset("article main".split())
BAD_NAMES = frozenset(
    "nav navbar navigation menu header masthead topbar footer sidebar aside ad ads adv advert adverts advertisement banner promo promotion promoted sponsor sponsored cookie "
    "cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup login share sharing social comment comments disqus reply replies respond "
    "related recommended breadcrumb breadcrumbs pagination pager widget toolbar search skip copyright legal disclaimer contentinfo complementary".split()
)
GOOD_NAMES = frozenset("article content main post entry story body text".split())
#: Parts of a name that say nothing beside a telling one.
PLAIN_NAMES = frozenset("site page global top bottom left right inner outer box bar block list item items link links wrap wrapper container section area panel primary secondary mobile desktop buttons button form the us".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a new one of the same group closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: What an element can say of all that is in it.
CONTENT, CONTESTED, UNKNOWN, HINTED, FORM, NAMED, NEVER = 3, 2, 0, -1, -2, -3, -4
#: Prior log odds by what the nearest telling element around a block says, and the bound of the trained part.
PRIOR = {CONTENT: 4.0, CONTESTED: 2.0, UNKNOWN: 0.0, HINTED: -1.0, FORM: -2.0, NAMED: -4.0, NEVER: -8.0}
BOUND = 3.0
NEIGHBOUR = 1.0
SIBLING = 1.0
#: Capacities up to this are none.
EPSILON = 1e-9
#: Pages of the training sample, at most about this many.
TRAIN_PAGES = 4000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
#: One attribute after the other, so that no name is found inside a value or a longer name.
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?|["']""")


@dataclass
class Block:
    text: str
    tag: str
    sign: int  # CONTENT to NEVER
    parent: int
    link_chars: int
    features: list[str] = field(default_factory=list)


def _named(value: str) -> int:
    """What the names in a class, id or role say: NAMED if one is made of telling and plain parts only, HINTED if a telling part stands
    beside one of another meaning (market-share), which the trained odds and the neighbours can outweigh."""
    found = UNKNOWN
    for name in value.split():
        parts = {x for x in re.split(r"[^a-z]+", name) if x}
        if parts & BAD_NAMES:
            found = min(found, NAMED if parts <= BAD_NAMES | PLAIN_NAMES | GOOD_NAMES else HINTED)
        elif parts & GOOD_NAMES and not found:
            found = CONTENT
    return found


def _sign(tag: str, attributes: str) -> int:
    """What an element says of all that is in it."""
    if tag in BAD_TAGS:
        return NEVER if tag in CLOSED else FORM if tag in FORMS else NAMED
    found = CONTENT if tag in GOOD_TAGS else UNKNOWN
    for m in _ATTR.finditer(attributes) if attributes else ():
        name, value = (m[1] or "").lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return NEVER
        if name in ("class", "id", "role") and tag not in ("html", "body"):
            says = _named(value)
            found = min(found, says) if says < 0 else max(found, says) if found >= 0 else found
    return found


def _inner(around: int, tag: str, own: int) -> int:
    """What holds inside an element that says `own`: boilerplate stays so further in, except that an article or main in a named element, and any
    content in a form, is contested, as is what a name only hints at inside content. A header inside an article belongs to it."""
    if around > 0 and own == HINTED:
        return CONTESTED
    if around == HINTED and own:
        return CONTESTED if own == CONTENT else own
    if around in (NAMED, FORM) and own == CONTENT and (tag in GOOD_TAGS or around == FORM):
        return CONTESTED
    if around == FORM and own < FORM:
        return own
    return around if around < 0 or not own or (tag == "header" and around > 0) else CONTESTED if around == CONTESTED and own == CONTENT else own


def _skip(page: str, tag: str, at: int, holders: set[str]) -> int | None:
    """End of the skipped element `tag` that was opened before `at`: after its end tag or before that of a holder; None without either."""
    inner = [tag]
    for m in _TAG.finditer(page, at):
        name = (m[2] or m[5] or "").lower()
        if m[1] or m[4]:
            if name in inner:
                del inner[len(inner) - 1 - inner[::-1].index(name) :]
                if not inner:
                    return m.end()
            elif name in holders:
                return m.start()
        elif name and name not in VOID and not m[0].endswith("/>"):
            inner.append(name)
    return None


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, character references decoded and white space folded."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool, int]] = [("", 0, 0, False, 0)]  # tag, number, sign, inline, place of the innermost block element
    opened: Counter = Counter()  # elements of the stack by tag

    def close(level: int) -> None:
        opened.subtract(x[0] for x in stack[level:])
        del stack[level:]

    number, parts, links = 0, [], 0
    endless: set[tuple[str, frozenset[str]]] = set()

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                at = stack[-1][4]
                holder = stack[at]
                out.append(Block(text, holder[0], holder[2], stack[max(0, at - 1)][1], min(links, len(text))))
        links = 0

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        raw = page[at : m.start() if m else size]
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if opened["a"] > 0:
                links += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag not in INLINE:
                flush()
            if opened[tag] > 0:  # an inline element is closed by its end tag only as long as no block was opened in it
                lowest = stack[-1][4] if tag in INLINE else 0
                level = next((i for i in range(len(stack) - 1, lowest, -1) if stack[i][0] == tag), 0)
                if level:
                    close(level)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW:
            if tag not in INLINE:
                flush()
            if tag in NESTED:
                holders = frozenset(x[0] for x in stack[1:])
                if not (m[0].endswith("/>") and tag in ("svg", "math")) and (tag, holders) not in endless:
                    end = _skip(page, tag, at, holders)
                    if end is None:
                        endless.add((tag, holders))
                    else:
                        at = end
                continue
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        inline = tag in INLINE
        if not inline:
            flush()
            closes = CLOSES.get(tag, {"p"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    close(i)
                    break
                if not stack[i][3] and stack[i][0] != "p":
                    break
        if tag in VOID:
            continue
        number += 1
        own = _sign(tag, m[3] or m[6] or "")
        sign = _inner(stack[-1][2], tag, own)
        stack.append((tag, number, sign, inline, stack[-1][4] if inline else len(stack)))
        opened[tag] += 1
    flush()
    for b in out:
        n = len(b.text)
        b.features = [f"tag {b.tag}", f"length {min(12, n.bit_length())}", f"links {round(4 * b.link_chars / n)}", f"stop {b.text[-1] in '.!?…'}"]
    return out


def train(pages: DataFrame, most: int = TRAIN_PAGES) -> dict[str, float]:
    """Log odds of block features, counted over pages whose markup tells content from boilerplate.

    The sample is drawn by a hash of the url and html; its size is a parameter, so training does not grow with the table.
    """
    rows = pages.count()
    share = F.pmod(F.xxhash64(F.lit("train"), "url", "html"), F.lit(1_000_000)) < (1_000_000.0 * most / rows if rows else 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            found: Counter = Counter()
            for page in df["html"]:
                for b in blocks(page or ""):
                    if b.sign in (CONTENT, NAMED, NEVER):  # what is hinted at, contested or unknown has no label
                        found.update((f, 1 if b.sign > 0 else -1) for f in [*b.features, "all"])
            yield pd.DataFrame([(f, s, n) for (f, s), n in found.items()], columns=["feature", "sign", "n"])

    got = pages.where(share).select("html").mapInPandas(count, "feature string, sign int, n bigint").groupBy("feature", "sign").agg(F.sum("n").alias("n"))
    n = {(r.feature, r.sign): r.n for r in got.collect()}  # a few dozen features
    good, bad = n.get(("all", 1), 0) + 1, n.get(("all", -1), 0) + 1
    return {f: math.log((n.get((f, 1), 0) + 1) / good) - math.log((n.get((f, -1), 0) + 1) / bad) for f, _ in n if f != "all"}


def min_cut(score: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (True: content) of least cost: |score| where a label goes against its sign, an edge's weight where it is cut.

    A node whose score outweighs all its edges is settled at once and becomes part of its neighbours' scores, which
    changes no optimum; max-flow decides the rest, group by group. A tie is content for a settled block.
    """
    near: list[dict[int, float]] = [{} for _ in score]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    score, label = list(score), [None] * len(score)
    todo = deque(range(len(score)))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(score[i]) >= sum(near[i].values()):
            label[i] = score[i] >= 0
            for j, w in near[i].items():
                score[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = {i for i, x in enumerate(label) if x is None}
    while rest:  # group by group of undecided blocks that edges connect
        group, seen = [rest.pop()], 0
        while seen < len(group):
            group += (more := near[group[seen]].keys() & rest)
            rest -= more
            seen += 1
        content = _source_side(group, score, near)
        for i in group:
            label[i] = i in content
    return label


def _source_side(group: list[int], score: list[float], near: list[dict[int, float]]) -> set:
    """The blocks that the source still reaches after a maximum flow, found in phases of shortest paths (blocking flows)."""
    left: dict = {i: {j: w for j, w in near[i].items()} for i in group}
    left["s"], left["t"] = {}, {}
    for i in group:
        a, b = ("s", i) if score[i] > 0 else (i, "t")
        left[a][b] = abs(score[i])
        left[b].setdefault(a, 0.0)
    while True:
        level, queue = {"s": 0}, deque(["s"])
        while queue:
            x = queue.popleft()
            for y, c in left[x].items():
                if c > EPSILON and y not in level:
                    level[y] = level[x] + 1
                    queue.append(y)
        if "t" not in level:
            return level.keys() - {"s"}
        arcs = {x: iter([y for y in left[x] if level.get(y) == level[x] + 1]) for x in level}
        path = ["s"]
        while path:
            x = path[-1]
            if x == "t":
                steps = list(zip(path, path[1:], strict=False))
                amount = min(left[a][b] for a, b in steps)
                for a, b in steps:
                    left[a][b] -= amount
                    left[b][a] = left[b].get(a, 0.0) + amount
                cut = next(k for k, (a, b) in enumerate(steps) if left[a][b] <= EPSILON)
                del path[cut + 1 :]
                continue
            y = next((y for y in arcs[x] if left[x][y] > EPSILON), None)
            if y is None:
                path.pop()
            else:
                path.append(y)


def main_text(page: str | None, odds: dict[str, float]) -> str:
    """Content blocks joined by line feeds; empty for a null or empty page."""
    found = blocks(page or "")
    if not found:
        return ""
    score = [PRIOR[b.sign] + max(-BOUND, min(BOUND, sum(odds.get(f, 0.0) for f in b.features))) for b in found]
    edges, last = {}, {}
    for i, b in enumerate(found):
        if i:
            alike = found[i - 1].sign == b.sign
            edges[i - 1, i] = NEIGHBOUR * (1 if alike else 0.25)
        if (j := last.get(b.parent)) is not None:
            edges[j, i] = edges.get((j, i), 0.0) + SIBLING
        last[b.parent] = i
    label = min_cut(score, edges)
    return "\n".join(b.text for b, keep in zip(found, label, strict=True) if keep)


def extract(pages: DataFrame, odds: dict[str, float]) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    A null or empty html has an empty text. Repeated rows are extracted each, null ids and urls are returned as they are, extra columns are
    ignored. A page is worked through once from start to end, whatever its depth and length.
    """
    shared = pages.sparkSession.sparkContext.broadcast(odds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts = [main_text(x, shared.value) for x in df["html"]]
            yield pd.DataFrame({"page_id": df["page_id"], "url": df["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id {kind}, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))

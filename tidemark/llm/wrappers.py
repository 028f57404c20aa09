"""Main text of web pages by wrapper induction.

A page becomes a tree of its containers; runs of equal siblings are one node and prose elements
(paragraphs, headings, list items ...) belong to the container around them. Pages of a host with the
same tree are counted together. The commonest tree of a host is its wrapper: every other tree is
aligned with it by simple tree matching, and each wrapper node collects, over all pages of the
host, how much text stood in it and whether that text was always the same. Nodes that never change
are template; the content slot is the deepest node that still holds nearly all of the changing text.
A page's text is then read from the nodes that its own alignment puts into the slot.

Elements that are no article anywhere (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, comments), known by tag, role, class or id, are never content.

Defined results: null or empty html gives the empty text; a page without markup is its own text; a
page whose tree has no slot, or whose slot is empty, falls back to its own article, main or body; a
null or odd url is a host of its own; repeated pages are read again each; an empty table gives no
rows; other columns are ignored. Markup may be broken: end tags are implied as browsers do.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd figcaption caption tr td th "
                  "address summary hr".split())
CONTAINER = frozenset("html body div section article main nav header footer aside form ul ol dl "
                      "table tbody thead tfoot figure details fieldset center dialog menu".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table "
                     "ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: elements that a li, td ... inside does not close beyond
BORDER = frozenset("ul ol dl table menu".split())
NEVER = frozenset("head script style textarea title iframe noembed noframes xmp nav footer aside form "
                  "button select template noscript svg dialog".split())
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert "
                       "alertdialog menu menubar".split())
#: words of class and id values that mark what is not the article
NEVER_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply "
    "replies respond disqus cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe subscription share sharing social related recommended widget pagination pager login "
    "signup search masthead toolbar skip".split())
COMMENT_NAME = frozenset("comment comments reply replies respond disqus".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
NAME_WORD = re.compile("[a-z]+")
SPACES = re.compile(r"\s+")

#: share of the changing text that the content slot keeps
HOLDS = 0.98
#: different pages of a host that must agree before a node inside the slot counts as template
AGREE = 3


class Page:
    """Containers of a page and its blocks of text.

    tags, parents, skip: per container; skip marks what is never content. blocks: (container, text).
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.skip, self.labels = ["#page"], [-1], [False], ["#page"]
        self.blocks: list[tuple[int, str]] = []
        # open elements: tag, container, skipped
        stack = [("#page", 0, False)]
        run: list[str] = []

        def flush():
            if run:
                text = SPACES.sub(" ", entities.unescape("".join(run))).strip()
                run.clear()
                if text and not stack[-1][2]:
                    self.blocks.append((stack[-1][1], text))

        def close(to: int):
            if any(t in CONTAINER or t in PROSE or skip for t, _, skip in stack[to:]):
                flush()
            del stack[to:]

        at, end = 0, len(source)
        while at < end:
            m = MARKUP.search(source, at)
            if not m:
                run.append(source[at:])
                break
            if m.start() > at:
                run.append(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if tag in PROSE and stack[i][0] in BORDER:
                        break
                continue
            if tag == "br":
                run.append("\n")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in CONTAINER:
                        break
            for i in range(len(stack) - 1, 0, -1) if tag in CLOSES_SAME else ():
                if stack[i][0] in BORDER:
                    break
                if stack[i][0] in CLOSES_SAME[tag]:
                    close(i)
                    break
            attributes = m[3] or m[6] or ""
            skip = stack[-1][2] or self.never(tag, attributes, stack)
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}", re.I).search(source, at)
                at = stop.start() if stop else end
                if stop:
                    gt = source.find(">", at)
                    at = gt + 1 if gt >= 0 else end
                continue
            inside = stack[-1][1]
            if tag in CONTAINER or (skip and not stack[-1][2]):
                flush()
                names = NAME_WORD.findall(" ".join(
                    v for k, v in self.named(attributes) if k == "class"))
                self.tags.append(tag)
                self.parents.append(inside)
                self.skip.append(skip)
                self.labels.append(".".join([tag, *sorted(set(names))]))
                inside = len(self.tags) - 1
            elif tag in PROSE:
                flush()
            stack.append((tag, inside, skip))
        flush()

    @staticmethod
    def named(attributes: str) -> list[tuple[str, str]]:
        return [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
                for m in ATTRIBUTE.finditer(attributes)] if attributes else []

    def never(self, tag: str, attributes: str, stack: list) -> bool:
        if tag in NEVER:
            return True
        inside = any(t in ("article", "main") for t, *_ in stack)
        if tag == "header" and not inside:
            return True
        if not attributes or tag in ("html", "body", "main"):
            return False
        if HIDDEN.search(attributes):
            return True
        found = self.named(attributes)
        words = {w for k, v in found if k != "role" for w in NAME_WORD.findall(v)}
        if tag == "article":
            return bool(words & COMMENT_NAME)
        return any(k == "role" and v in NEVER_ROLE for k, v in found) or bool(
            words & NEVER_NAME) or ("header" in words and not inside)

    def skeleton(self) -> tuple[str, list[int]]:
        """The tree as text, and for each container its node there (nodes count in text order).

        Equal siblings that follow each other, subtrees included, are one node.
        """
        children: list[list[int]] = [[] for _ in self.tags]
        for i, p in enumerate(self.parents[1:], 1):
            children[p].append(i)
        shape = [""] * len(self.tags)
        for i in range(len(self.tags) - 1, -1, -1):
            parts = []
            for c in children[i]:
                if not parts or shape[c] != parts[-1]:
                    parts.append(shape[c])
            shape[i] = f"({self.labels[i]}{''.join(parts)})"
        node = [0] * len(self.tags)
        count = [s.count("(") for s in shape]
        todo = [0]
        while todo:
            i = todo.pop()
            after, last = node[i] + 1, None
            for c in children[i]:
                if last is not None and shape[c] == shape[last]:
                    node[c] = node[last]
                else:
                    node[c] = after
                    after += count[c]
                last = c
                todo.append(c)
        return shape[0], node


def tree_of(skeleton: str) -> tuple[list[str], list[int], list[list[int]]]:
    """Labels, parents and children of the nodes of a skeleton."""
    labels, parents, children, at = [], [], [], -1
    for sign, label in re.findall(r"([()])([^()]*)", skeleton):
        if sign == ")":
            at = parents[at]
            continue
        labels.append(label)
        parents.append(at)
        children.append([])
        if at >= 0:
            children[at].append(len(labels) - 1)
        at = len(labels) - 1
    return labels, parents, children


@lru_cache(maxsize=20_000)
def alignment(skeleton: str, wrapper: str) -> tuple[int, ...]:
    """The wrapper's node for each node of a skeleton, or -1, by simple tree matching."""
    names, parents, below = tree_of(skeleton)
    others, _, under = tree_of(wrapper)
    if skeleton == wrapper:
        return tuple(range(len(names)))
    weight: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def pairs_below(a: int, b: int) -> Iterator[tuple[int, int]]:
        for x in below[a]:
            for y in under[b]:
                if names[x] == others[y]:
                    yield x, y

    # children before parents, without recursion: page trees can be deep
    order, seen, todo = [], {(0, 0)}, [(0, 0)] if names[0] == others[0] else []
    while todo:
        a, b = todo.pop()
        order.append((a, b))
        for pair in pairs_below(a, b):
            if pair not in seen:
                seen.add(pair)
                todo.append(pair)
    for a, b in reversed(order):
        m = [[0] * (len(under[b]) + 1) for _ in range(len(below[a]) + 1)]
        for i, x in enumerate(below[a], 1):
            for j, y in enumerate(under[b], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + weight.get((x, y), 0))
        weight[a, b] = 1 + m[-1][-1]
        tables[a, b] = m
    out = [-1] * len(names)
    todo = order[:1]
    while todo:
        a, b = todo.pop()
        out[a] = b
        m, i, j = tables[a, b], len(below[a]), len(under[b])
        while i and j:
            x, y = below[a][i - 1], under[b][j - 1]
            if (x, y) in weight and m[i][j] == m[i - 1][j - 1] + weight[x, y]:
                todo.append((x, y))
                i, j = i - 1, j - 1
            elif m[i][j] == m[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return tuple(out)


def text_hash(texts: list[str]) -> int:
    return int.from_bytes(blake2b("\n".join(texts).encode("utf-8", "surrogatepass"),
                                  digest_size=8).digest(), "big", signed=True)


def tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, html -> host, skeleton, node, pages, chars, low, high, page; pages with equal trees are
    combined as far as a batch goes. `page` names pages by their texts, so copies have one name: a
    row for each of the AGREE least names of a node, which tells whether it has so many."""
    names = ["host", "skeleton", "node", "pages", "chars", "low", "high", "page"]
    for batch in batches:
        found: dict[tuple, list] = {}
        for host, source in zip(batch.column("host").to_pylist(),
                                batch.column("html").to_pylist()):
            if not source:
                continue
            page = Page(source)
            skeleton, node = page.skeleton()
            name = text_hash([t for _, t in page.blocks])
            texts: dict[int, list[str]] = {0: []}
            for container, text in page.blocks:
                texts.setdefault(node[container], []).append(text)
            for k, t in texts.items():
                h, chars = text_hash(t), sum(map(len, t))
                row = found.setdefault((host, skeleton, k), [0, 0, h, h, set()])
                row[0] += 1
                row[1] += chars
                row[2], row[3] = min(row[2], h), max(row[3], h)
                row[4].add(name)
                if len(row[4]) > AGREE:
                    row[4].remove(max(row[4]))
        rows = [(*k, *(v[:2] if not i else (0, 0)), *v[2:4], name)
                for k, v in found.items() for i, name in enumerate(sorted(v[4]))]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=pa.string() if i < 2 else pa.int32() if i == 2 else pa.int64())
             for i, c in enumerate(columns)], names=names)


def align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = [alignment(s, w)[k] for s, w, k in zip(*(
            batch.column(c).to_pylist() for c in ("skeleton", "wrapper", "node")))]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("host", "wrapper")], pa.array(at, type=pa.int32()),
             *[batch.column(c) for c in ("different", "chars", "low", "high")]],
            names=["host", "wrapper", "node", "different", "chars", "low", "high"])


def host_of(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))


def induced(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: wrapper (a skeleton) and nodes: node, different (pages, exact up to AGREE),
    chars, low, high for each of its nodes that held text. Pages of different trees differ. The html is reduced in the tasks that read it, never shuffled."""
    trees = stored(pages.select(host_of(url).alias("host"), F.col(html).alias("html")).mapInArrow(
        tree_rows, "host string, skeleton string, node int, pages long, chars long, low long, "
        "high long, page long").groupBy("host", "skeleton", "node").agg(
        F.sum("pages").alias("pages"), F.count_distinct("page").alias("different"), F.sum("chars").alias("chars"), F.min("low").alias("low"),
        F.max("high").alias("high")), "page-trees")
    wrapper = trees.filter("node = 0").groupBy("host").agg(
        F.max_by("skeleton", F.struct("pages", "skeleton")).alias("wrapper"))
    aligned = trees.join(wrapper, "host").mapInArrow(
        align_rows, "host string, wrapper string, node int, different long, chars long, low long, "
        "high long").filter("node >= 0")
    nodes = aligned.groupBy("host", "wrapper", "node").agg(
        F.sum("different").alias("different"), F.sum("chars").alias("chars"), F.min("low").alias("low"),
        F.max("high").alias("high"))
    return nodes.groupBy("host", "wrapper").agg(F.sort_array(F.collect_list(
        F.struct("node", "different", "chars", "low", "high"))).alias("nodes"))


@lru_cache(maxsize=10_000)
def slot_of(wrapper: str, nodes: tuple) -> tuple[frozenset, frozenset]:
    """Nodes of the wrapper in the content slot, and those that are template inside it."""
    labels, parents, children = tree_of(wrapper)
    changing, all_text = [0] * len(labels), [0] * len(labels)
    template = set()
    for node, different, chars, low, high in nodes:
        all_text[node] = chars
        if low != high:
            changing[node] = chars
        elif different >= AGREE and not labels[node].startswith(("article", "main", "body", "#page")):
            template.add(node)
    held = changing if any(changing) else all_text
    if not any(held):
        return frozenset(), frozenset()
    for i in range(len(labels) - 1, 0, -1):
        held[parents[i]] += held[i]
    at = 0
    while labels[at].split(".")[0] not in ("article", "main") and children[at]:
        best = max(children[at], key=lambda c: held[c])
        if held[best] < HOLDS * held[at]:
            break
        at = best
    inside, todo = set(), [at]
    while todo:
        i = todo.pop()
        inside.add(i)
        todo += children[i]
    return frozenset(inside), frozenset(template & inside - {at})


def main_text(source: str | None, wrapper: str | None, nodes: tuple) -> str:
    if not source:
        return ""
    page = Page(source)
    chosen: list[str] = []
    if wrapper:
        skeleton, node = page.skeleton()
        at = alignment(skeleton, wrapper)
        slot, template = slot_of(wrapper, nodes)
        # a container belongs to the slot if it, or the nearest one around it that the wrapper
        # knows, does
        known = [False] * len(page.tags)
        for i, parent in enumerate(page.parents):
            w = at[node[i]]
            known[i] = w in slot if w >= 0 else parent >= 0 and known[parent]
        chosen = [t for i, t in page.blocks if known[i] and at[node[i]] not in template]
    if not chosen:
        for tags in (("article", "main"), ("body",), ("#page",)):
            inside = [False] * len(page.tags)
            for i, parent in enumerate(page.parents):
                inside[i] = page.tags[i] in tags or parent >= 0 and inside[parent]
            chosen = [t for i, t in page.blocks if inside[i]]
            if chosen:
                break
    return "\n\n".join(chosen)


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = [tuple(tuple(n.values()) for n in x or ())
                 for x in batch.column("nodes").to_pylist()]
        texts = [main_text(*x) for x in zip(batch.column("html").to_pylist(),
                                            batch.column("wrapper").to_pylist(), nodes)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string()),
             pa.array([len(t) for t in texts], type=pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row.

    The wrappers have one row per host. Spark broadcasts them while they are small and otherwise
    deals pages out by host, splitting the partitions of large hosts.
    """
    wrappers = stored(induced(pages, url, html), "wrappers")
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"),
                        F.col(html).alias("html"), host_of(url).alias("host"))
    kind = dict(rows.dtypes)["page_id"]
    return rows.join(wrappers, "host", "left").select(
        "page_id", "url", "html", "wrapper", "nodes").mapInArrow(
        text_rows, f"page_id {kind}, url string, text string, n_chars long")

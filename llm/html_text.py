"""Main text of web pages by wrapper induction.

Every page becomes a tree of its block elements, in which neighbouring siblings of one kind (the
paragraphs of a text, the items of a menu) fold into one repeated node. The most frequent tree of a
host is its reference; simple tree matching aligns every other tree of the host with it, and
subtrees that match nothing (those of the host's other templates) are further slots. Slots whose
text is the same on most of the host's different pages are template, all others are content.

What the page itself marks as furniture by its elements and roles (navigation, footers, asides) is
never content, nor are readers' comments, however long. Forms and elements with other names of furniture (adverts,
notices) are none either, unless they hold most of the page's varying text: the name is then that of a
container around the article. A host with too few pages to compare falls back on the ``article`` or
``main`` element. The statistics cover all pages of a host and are combined before the shuffle, and
trees are aligned once per distinct shape.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import map_rows


@dataclass(frozen=True)
class Settings:
    """Hosts of ``least_pages`` different pages are compared. A slot is template if one same text is on
    more than ``varying`` of the different pages that have it. Wrappers of up to ``broadcast_bytes`` in
    all are broadcast to the pages."""

    least_pages: int = 3
    varying: float = 0.5
    broadcast_bytes: int = 16 << 20


# Element and attribute names of HTML, and common names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg annotation annotation-xml canvas select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
REPEATED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 blockquote pre".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("table", "tr")),
    "th": ("td th", ("table", "tr")),
    "tbody": ("thead tbody tfoot tr td th", ("table",)),
    "tfoot": ("thead tbody tfoot tr td th", ("table",)),
    "option": ("option", ("select",)),
}
FURNITURE = frozenset("nav footer aside button menu dialog search head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar aside menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus replies related recommended share sharing social "
    "widget widgets toolbar pagination pager login signup search".split()
)
#: Names of readers' comments; a class or id with one of ``LAYOUT_WORDS`` beside it describes a container.
COMMENTS = frozenset("comment comments commentlist commentthread disqus replies responses".split())
LAYOUT_WORDS = frozenset("no with without has have show hide enable enabled disable disabled allow open closed on off count".split())
#: The rest of a tag: quotes count after an equals sign only. No part of it is ever tried twice.
_ATTRIBUTES = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?=[^"'])|(?="[^"]*+\Z)"|(?='[^']*+\Z)'|\Z))*+""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def tokens(source: str):
    """(text before, "start", "end" or None, tag, attributes, place behind) of a page, in one pass.

    Comments and declarations are left out. A tag that is never finished is dropped with all that follows it.
    """

    place = begin = 0
    while True:
        at = source.find("<", place)
        if at < 0:
            yield source[begin:], None, "", "", len(source)
            return
        closing = source.startswith("/", at + 1)
        name = _NAME.match(source, at + 1 + closing)
        if name:
            rest = _ATTRIBUTES.match(source, name.end())
            end = rest.end()
            if not source.startswith(">", end):
                yield source[begin:at], None, "", "", len(source)
                return
            begin = place = yield source[begin:at], "end" if closing else "start", name[0].lower(), rest[0], end + 1
        elif closing or source.startswith(("!", "?"), at + 1):
            comment = source.startswith("<!--", at)
            end = source.find("-->" if comment else ">", at + 4 if comment else at + 1)
            stop = len(source) if end < 0 else end + (3 if comment else 1)
            yield source[begin:at], "none", "", "", stop
            begin = place = stop
        else:
            place = at + 1


def _furniture(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool, bool, str]:
    """(whether the element is furniture, whether its name speaks for that, whether the name is one of
    comments, its kind: the tag with its class names)."""

    if tag in FURNITURE or tag == "header" and not inside_article:
        return True, False, False, tag
    if not attributes or tag in ("html", "body", "main"):
        return False, tag == "form", False, tag
    kind = tag
    found, named, comments = False, tag == "form", False
    for name, *values in _NAMED.findall(attributes):
        value = (values[0] or values[1] or values[2]).lower()
        words = _WORDS.split(value)
        if name.lower() == "role":
            found, named = found or value in ROLES, named or value == "form"
        else:
            named = named or any(word in NAMES for word in words)
            for part in value.split():
                own = set(_WORDS.split(part))
                comments = comments or bool(own & COMMENTS) and not own & LAYOUT_WORDS
        if name.lower() == "class":
            kind = f"{tag}.{'.'.join(word for word in words if word and not word.isdigit())}"
    return found, named or comments, comments, kind


class Page:
    """The folded tree of a page and its text blocks.

    A block is a list of pieces: a text and the number of the innermost element around it that has a name of
    furniture, or -1. ``outer`` leads from each such element to the next one around it.
    """

    def __init__(self, source: str):
        self.kinds: list[str] = ["#"]
        self.children: list[list[int]] = [[]]
        self.outer: list[int] = []
        self.levels: list[int] = []
        self.comments: list[bool] = []
        self.blocks: list[tuple[int, list[tuple[str, int]], bool]] = []  # node, pieces, inside article or main
        self._read(source)

    def _read(self, source: str) -> None:
        # (tag, node, furniture, inside article, named element, depth of the innermost block)
        stack: list[tuple[str, int, bool, bool, int, int]] = [("#", 0, False, False, -1, 0)]
        opened: dict[str, list[int]] = {}  # depths of the open elements by tag
        buffer: list[tuple[str, int]] = []

        def flush() -> None:
            if buffer:
                _, node, furniture, inside, _, _ = stack[-1]
                if not furniture and any(text.strip() for text, _ in buffer):
                    self.blocks.append((node, buffer.copy(), inside))
                buffer.clear()

        def close(down_to: int) -> None:
            if stack[-1][5] >= down_to:
                flush()
            for entry in stack[down_to:]:
                opened[entry[0]].pop()
            del stack[down_to:]

        found = tokens(source)
        token = next(found)
        while True:
            text, sort, tag, attributes, place = token
            if text and not stack[-1][2]:
                buffer.append((html.unescape(text) if "&" in text else text, stack[-1][4]))
            if sort is None:
                break
            if tag == "br":
                buffer.append((" ", stack[-1][4]))
            elif sort == "end":
                depths = opened.get(tag)
                # An inline end tag closes nothing outside its block.
                if depths and (tag in BLOCKS or depths[-1] > stack[-1][5]):
                    close(depths[-1])
            elif sort == "start" and tag in RAW:
                if not attributes.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, place)
                    stop = source.find(">", end.start()) if end else -1
                    place = stop + 1 if stop >= 0 else len(source)
            elif sort == "start":
                self._start(tag, attributes, stack, opened, close, flush)
            token = next(found) if sort == "none" else found.send(place)
        flush()

    def _start(self, tag: str, attributes: str, stack: list, opened: dict, close, flush) -> None:
        if tag in BLOCKS:
            self._imply(tag, stack, opened, close)
            flush()
        if tag in VOID:
            return
        _, node, furniture, inside, named, block = stack[-1]
        own, by_name, comments, kind = _furniture(tag, attributes, inside)
        if tag in ("h1", "main"):
            # What holds the page's heading or main part is no list of comments.
            element = named
            while element >= 0 and self.comments[element]:
                self.comments[element] = False
                element = self.outer[element]
        if by_name and not furniture:
            self.outer.append(named)
            self.levels.append(self.levels[named] + 1 if named >= 0 else 1)
            self.comments.append(comments)
            named = len(self.outer) - 1
        if tag in BLOCKS:
            node, block = self._node(node, kind), len(stack)
        opened.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, furniture or own, inside or tag in ("article", "main"), named, block))

    def _imply(self, tag: str, stack: list, opened: dict, close) -> None:
        """End tags that a block's start implies."""

        block = stack[-1][5]
        if stack[block][0] == "p":
            close(block)
        closes, within = CLOSES.get(tag, ("", ()))
        if closes:
            # Elements around the nearest holder, and around the nearest of the same tag, stay open.
            limit = max((opened[name][-1] for name in within if opened.get(name)), default=0)
            same = opened[tag][-1] if opened.get(tag) else 0
            limit = max(limit, same - 1)
            inner = []
            for name in closes.split():
                depths = opened.get(name, ())
                at = bisect_right(depths, limit)
                if at < len(depths):
                    inner.append(depths[at])
            if inner:
                close(min(inner))

    def _node(self, parent: int, kind: str) -> int:
        siblings = self.children[parent]
        if siblings and kind.split(".")[0] in REPEATED and self.kinds[siblings[-1]] == kind:
            return siblings[-1]
        self.kinds.append(kind)
        self.children.append([])
        siblings.append(len(self.kinds) - 1)
        return len(self.kinds) - 1

    def shape(self) -> str:
        """The tree as text: kind and depth of every node, in the order of their numbers."""

        depth = [0] * len(self.kinds)
        for parent, below in enumerate(self.children):
            for child in below:
                depth[child] = depth[parent] + 1
        parents = [0] * len(self.kinds)
        for parent, below in enumerate(self.children):
            for child in below:
                parents[child] = parent
        return " ".join(f"{parents[i]}:{self.kinds[i]}" for i in range(len(self.kinds)))


def _tree(shape: str) -> tuple[list[str], list[list[int]]]:
    parents, kinds = zip(*(part.split(":", 1) for part in shape.split(" ")), strict=True)
    children: list[list[int]] = [[] for _ in kinds]
    for i, parent in enumerate(parents):
        if i:
            children[int(parent)].append(i)
    return list(kinds), children


class _Forest:
    """Trees whose equal subtrees share a number, so that work is done once for equal pairs."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.kinds: list[str] = []
        self.below: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.sizes_above = 0  # no subtree holds more nodes

    def add(self, kinds: list[str], children: list[list[int]]) -> list[int]:
        """The number of the subtree at every node; parents come before their children."""

        found = [0] * len(kinds)
        for node in range(len(kinds) - 1, -1, -1):
            below = tuple(found[child] for child in children[node])
            key = (kinds[node], below)
            if key not in self.numbers:
                self.numbers[key] = len(self.kinds)
                self.kinds.append(kinds[node])
                self.below.append(below)
                self.sizes.append(1 + sum(self.sizes[child] for child in below))
                self.sizes_above = max(self.sizes_above, self.sizes[-1])
            found[node] = self.numbers[key]
        return found


#: Table cells up to which one pair of child lists, and one pair of trees in all, is scored cell by cell; beyond, a
#: row at a time. Both give the same numbers.
LIST_CELLS, TREE_CELLS = 40_000, 400_000
#: Scores of pairs that are kept, and bytes of rows of scores.
KEPT_SCORES, KEPT_BYTES = 500_000, 32 << 20


class _Group:
    """Different subtrees of one kind, ready to be scored against a subtree all at once.

    The children of all of them follow each other. Running values carry an offset that grows from one subtree
    to the next by more than any score, so that one running maximum serves them all.
    """

    def __init__(self, forest: _Forest, members):
        self.forest, self.size = forest, len(members)
        below = [forest.below[y] for y in members]
        counts = np.fromiter(map(len, below), np.int64, len(below))
        children = np.fromiter((child for kids in below for child in kids), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(below)), counts)
        self.offset = owner * (forest.sizes_above + 1)
        self.starts = np.flatnonzero(np.diff(owner, prepend=-1))
        self.holds = np.flatnonzero(counts)
        self.ends = np.cumsum(counts)[self.holds] - 1
        self.by_kind = _by_kind(forest, children)
        self.below: dict[str, _Group] = {}

    def of_kind(self, kind: str) -> _Group:
        """The different children of one kind."""

        if kind not in self.below:
            self.below[kind] = _Group(self.forest, self.by_kind[kind][1].tolist())
        return self.below[kind]

    def with_child(self, state: np.ndarray, kind: str, scores: np.ndarray) -> np.ndarray:
        """The running values after one more child, whose scores with ``of_kind(kind)`` are given."""

        places, _, which = self.by_kind[kind]
        before = np.empty_like(state)
        before[1:] = state[:-1]
        before[self.starts] = self.offset[self.starts]
        before[places] += scores[which]
        return np.maximum.accumulate(np.maximum(state, before, out=before), out=before)

    def scores(self, state: np.ndarray) -> np.ndarray:
        found = np.ones(self.size, np.int64)
        found[self.holds] += state[self.ends] - self.offset[self.ends]
        return found


def _by_kind(forest: _Forest, numbers: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind its places among ``numbers``, the different numbers there and which of them each place has."""

    places: dict[str, list[int]] = {}
    for place, number in enumerate(numbers.tolist()):
        places.setdefault(forest.kinds[number], []).append(place)
    return {kind: (at := np.array(own), *np.unique(numbers[at], return_inverse=True)) for kind, own in places.items()}


class _Matcher:
    """Simple tree matching of numbered subtrees.

    Equal subtrees at both ends of two child lists are matched at once, which a best matching allows. The
    rest is matched by a table of the greatest number of matched nodes, whatever its size: small tables are
    made cell by cell and their scores kept, large ones row by row, where a subtree is scored against all
    its partners together and rows are made again when they are needed. Time grows with the product of two
    trees, memory with the longer list times the root of the shorter one.
    """

    def __init__(self, forest: _Forest):
        self.forest = forest
        self.scores: dict[tuple[int, int], int] = {}
        self.cells = self.held = 0

    def _inner(self, a: int, b: int):
        """Number of equal subtrees at the head and at the tail of two child lists, and what lies between."""

        left, right = self.forest.below[a], self.forest.below[b]
        head, most = 0, min(len(left), len(right))
        while head < most and left[head] == right[head]:
            head += 1
        tail = 0
        while tail < most - head and left[-1 - tail] == right[-1 - tail]:
            tail += 1
        return head, tail, left[head : len(left) - tail], right[head : len(right) - tail]

    def _unequal(self, left, right) -> list[tuple[int, int]]:
        """Pairs of unequal subtrees of one kind."""

        kinds, others = self.forest.kinds, {}
        for y in set(right):
            others.setdefault(kinds[y], []).append(y)
        return [(x, y) for x in set(left) for y in others.get(kinds[x], ()) if x != y]

    def _scored(self, left, right) -> bool:
        """Score all pairs of two lists cell by cell; whether that stayed within the limits."""

        self.cells = len(left) * len(right)
        if self.cells > LIST_CELLS:
            return False
        if len(self.scores) > KEPT_SCORES:
            self.scores.clear()
        todo = self._unequal(left, right)
        while todo:
            pair = todo[-1]
            if pair in self.scores:
                todo.pop()
                continue
            head, tail, x, y = self._inner(*pair)
            self.cells += len(x) * len(y) + 1
            if self.cells > TREE_CELLS:
                return False
            missing = [p for p in self._unequal(x, y) if p not in self.scores]
            if missing:
                todo += missing
                continue
            todo.pop()
            below, sizes = self.forest.below[pair[0]], self.forest.sizes
            equal = sum(sizes[child] for child in below[:head]) + sum(sizes[child] for child in below[len(below) - tail :])
            self.scores[pair] = 1 + equal + self._table(x, y)[-1][-1]
        return True

    def _known(self, a: int, b: int) -> int:
        if a == b:
            return self.forest.sizes[a]
        return self.scores[a, b] if self.forest.kinds[a] == self.forest.kinds[b] else 0

    def places(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of the matched children of two subtrees."""

        head, tail, left, right = self._inner(a, b)
        ends = [(head + len(left) + k, head + len(right) + k) for k in range(tail)]
        middle = self._by_table(left, right) if self._scored(left, right) else self._by_rows(left, right)
        return [(k, k) for k in range(head)] + [(head + i, head + j) for i, j in middle] + ends

    def _table(self, left, right) -> list[list[int]]:
        table = [[0] * (len(right) + 1)]
        for x in left:
            row, above = [0], table[-1]
            for j, y in enumerate(right):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                match = self._known(x, y)
                row.append(max(best, above[j] + match) if match else best)
            table.append(row)
        return table

    def _by_table(self, left, right) -> list[tuple[int, int]]:
        table = self._table(left, right)
        i, j, found = len(left), len(right), []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i, j))
        return found[::-1]

    def _by_rows(self, left, right) -> list[tuple[int, int]]:
        """The same path through the same table, of which every so many rows are kept and those between made again."""

        kinds = self.forest.kinds
        by_kind = _by_kind(self.forest, np.array(right, np.int64))
        groups = {kind: _Group(self.forest, different.tolist()) for kind, (_, different, _) in by_kind.items()}
        rows: dict[tuple[int, int], np.ndarray] = {}
        self.held = 0

        def below(x: int, above: np.ndarray) -> np.ndarray:
            row = above.copy()
            if kinds[x] in groups:
                places, _, which = by_kind[kinds[x]]
                match = np.zeros(len(right), np.int64)
                match[places] = self._row(x, groups[kinds[x]], rows)[which]
                np.maximum.accumulate(np.maximum(above[1:], above[:-1] + match), out=row[1:])
            return row

        step = int(len(left) ** 0.5) + 1
        kept, row = [], np.zeros(len(right) + 1, np.int64)
        for i, x in enumerate(left):
            if i % step == 0:
                kept.append(row)
            row = below(x, row)
        j, found = len(right), []
        for k in range(len(kept) - 1, -1, -1):
            low, block = k * step, [kept[k]]
            for x in left[low : low + step]:
                block.append(below(x, block[-1]))
            i = len(block) - 1
            while i and j:
                if block[i][j] == block[i - 1][j]:
                    i -= 1
                elif block[i][j] == block[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append((low + i, j))
        return found[::-1]

    def _row(self, x: int, group: _Group, rows: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
        """Matched nodes of a subtree and every member of a group of its kind."""

        kinds, lists = self.forest.kinds, self.forest.below
        todo = [[x, group, 0, group.offset.copy()]]
        while True:
            node, own, i, state = todo[-1]
            kids = lists[node]
            while i < len(kids):
                kind = kinds[kids[i]]
                if kind in own.by_kind:
                    key = (kids[i], id(own.of_kind(kind)))
                    if key not in rows:
                        break
                    state = own.with_child(state, kind, rows[key])
                i += 1
            todo[-1][2:] = i, state
            if i < len(kids):
                partners = own.of_kind(kinds[kids[i]])
                todo.append([kids[i], partners, 0, partners.offset.copy()])
                continue
            found = own.scores(state)
            todo.pop()
            if not todo:
                return found
            if self.held > KEPT_BYTES:
                rows.clear()
                self.held = 0
            rows[node, id(own)] = found
            self.held += found.nbytes + 200


def align(shape: str, reference: str) -> list[int]:
    """For every node of ``shape`` the node of ``reference`` that simple tree matching gives it, or -1.

    Two trees match if their roots are of one kind; the children are matched in order so that the
    number of matched nodes is greatest.
    """

    kinds, children = _tree(shape)
    own_kinds, own_children = _tree(reference)
    forest = _Forest()
    left, right = forest.add(kinds, children), forest.add(own_kinds, own_children)
    found = [-1] * len(kinds)
    matcher = _Matcher(forest)
    if kinds[0] != own_kinds[0]:
        return found
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        found[a] = b
        if left[a] == right[b]:
            todo += zip(children[a], own_children[b])
        else:
            todo += [(children[a][i], own_children[b][j]) for i, j in matcher.places(left[a], right[b])]
    return found


def slots_of(shape: str, reference: str) -> list[int]:
    """The slot of every node of ``shape``: the node of ``reference`` that matches it, else one of its own.

    A slot of a node that matches nothing has a negative number, made of the slot above it, its kind
    and its place among such siblings; pages of another template than the reference's share these.
    """

    kinds, children = _tree(shape)
    found = align(shape, reference)
    for node, below in enumerate(children):  # parents come before their children
        seen: dict[str, int] = {}
        for child in below:
            if found[child] < 0:
                kind = kinds[child]
                seen[kind] = seen.get(kind, 0) + 1
                path = f"{found[node]} {seen[kind]} {kind}".encode("utf-8", "replace")
                found[child] = -1 - int.from_bytes(blake2b(path, digest_size=7).digest(), "big")
    return found


def block_text(pieces: list[tuple[str, int]], without: list[bool]) -> str:
    """The text of a block without the pieces in some named elements."""

    return " ".join("".join(text for text, named in pieces if named < 0 or not without[named]).split())


def slot_text(page: Page, pieces: list[tuple[str, int]]) -> str:
    """The text by which a block is compared: without named elements inside the block."""

    around = min((named for text, named in pieces if text.strip()), key=lambda named: page.levels[named] if named >= 0 else 0)
    return " ".join("".join(text for text, named in pieces if named == around).split())


def named_furniture(page: Page, blocks: list) -> list[bool]:
    """For each named element whether it is furniture or lies in one that is.

    Elements with names of comments are; others if they hold at most half of the text of ``blocks`` outside of
    comments, or of those inside the article.
    """

    gone = page.comments.copy()
    for element, outer in enumerate(page.outer):  # outer elements come first
        gone[element] = gone[element] or outer >= 0 and gone[outer]
    total, sizes = 0, [0] * len(page.outer)
    for _, pieces, _ in [block for block in blocks if block[2]] or blocks:
        for text, named in pieces:
            if named >= 0 and gone[named]:
                continue
            size = len(text.strip())
            total += size
            if named >= 0:
                sizes[named] += size
    for element in range(len(page.outer) - 1, -1, -1):
        if page.outer[element] >= 0:
            sizes[page.outer[element]] += sizes[element]
    for element, outer in enumerate(page.outer):
        gone[element] = gone[element] or 2 * sizes[element] <= total or outer >= 0 and gone[outer]
    return gone


def content(page: Page, template: set[int] | None, slots: list[int]) -> str:
    """The page's text: blocks in an ``article`` or ``main``, and all in no template slot of the host.

    Without a wrapper (hosts of too few pages) the article counts, or all that is no furniture.
    """

    blocks = page.blocks
    varying = blocks if template is None else [block for block in blocks if slots[block[0]] not in template]
    furniture = named_furniture(page, varying or blocks)
    if template is not None:
        blocks = [block for block in blocks if block[2] or slots[block[0]] not in template]
    texts = [(text, inside) for _, pieces, inside in blocks if (text := block_text(pieces, furniture))]
    chosen = [text for text, _ in texts]
    if template is None:
        chosen = [text for text, inside in texts if inside] or chosen
    return "\n\n".join(chosen)


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def induce_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", settings: Settings = Settings()) -> DataFrame:
    """(host, reference, template): per host its reference tree and its template slots.

    Slots with one text on most of their pages are template, but never the one with the most distinct
    text. Pages with the same texts count once, so copies make no template, and a text shared by some
    pages (a byline, a date) counts alike on small and large hosts. Hosts of too few different pages
    have a null.
    """

    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where("html is not null")

    def read(batch: pa.RecordBatch):
        out = {"host": [], "shape": [], "slots": []}
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(text)
            out["host"].append(host)
            out["shape"].append(page.shape())
            slots = {}
            for node, pieces, _ in page.blocks:
                slots.setdefault(node, []).append(slot_text(page, pieces))
            out["slots"].append([{"node": node, "hash": zlib.crc32("\n".join(x).encode("utf-8", "replace")), "size": sum(map(len, x))} for node, x in slots.items()])
        slot = pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("size", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(out["host"], pa.string()), pa.array(out["shape"], pa.string()), pa.array(out["slots"], slot)], ["host", "shape", "slots"])

    read_pages = map_rows(source, read, "host string, shape string, slots array<struct<node:int,hash:bigint,size:bigint>>")
    read_pages = read_pages.withColumn("shape_id", F.xxhash64("shape")).withColumn("texts", F.xxhash64("slots.hash")).checkpoint()
    first = F.struct("shape_id", F.xxhash64("slots"))
    read_pages = read_pages.groupBy("host", "texts").agg(
        F.min_by("shape", first).alias("shape"), F.min("shape_id").alias("shape_id"), F.min_by("slots", first).alias("slots")
    )
    read_pages = read_pages.checkpoint()
    shapes = read_pages.groupBy("host", "shape_id").agg(F.first("shape").alias("shape"), F.count("*").alias("n")).checkpoint()
    references = shapes.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape_id")).alias("reference"), F.sum("n").alias("pages"))

    def match(batch: pa.RecordBatch):
        found = [slots_of(a, b) for a, b in zip(batch.column("shape").to_pylist(), batch.column("reference").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("shape_id"), pa.array(found, pa.list_(pa.int64()))], ["host", "shape_id", "own"])

    own = map_rows(shapes.join(references, "host").select("host", "shape_id", "shape", "reference"), match, "host string, shape_id long, own array<bigint>")
    slots = read_pages.select("host", "shape_id", F.explode("slots").alias("slot")).select("host", "shape_id", "slot.*")
    slots = slots.groupBy("host", "shape_id", "node", "hash").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    texts = slots.join(own, ["host", "shape_id"]).withColumn("slot", F.get("own", "node"))
    texts = texts.groupBy("host", "slot", "hash").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
    stats = texts.groupBy("host", "slot").agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.sum("size").alias("volume")).checkpoint()
    largest = stats.groupBy("host").agg(F.max("volume").alias("largest"))
    repeated = (F.col("n") >= settings.least_pages) & (F.col("most") > settings.varying * F.col("n"))
    template = stats.join(largest, "host").where(repeated & (F.col("volume") < F.col("largest")))
    hosts = references.join(template.groupBy("host").agg(F.collect_list("slot").alias("template")), "host", "left")
    known = F.coalesce("template", F.array().cast("array<bigint>"))
    return hosts.select("host", "reference", F.when(F.col("pages") >= settings.least_pages, known).alias("template"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", settings: Settings = Settings()) -> DataFrame:
    """One row per input row: id, url, ``text``, ``n_chars``.

    Null, empty or textless pages give an empty text; a null url belongs to the host without name.
    Character references are decoded, white space within a block becomes one space, blocks are joined
    by an empty line in page order. Repeated rows and null ids are answered like any other; other
    columns are not read.
    """

    ready(pages.sparkSession)
    wrappers = induce_wrappers(pages, url_col, html_col, settings).checkpoint()
    size = wrappers.agg(F.sum(F.length("reference") + F.length("host") + 8 * F.coalesce(F.size("template"), F.lit(0)))).first()[0] or 0
    source = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host")
    )
    side = F.broadcast(wrappers) if size <= settings.broadcast_bytes else wrappers
    source = source.join(side, "host", "left").select("id", "url", "html", "reference", "template")
    types = {f.name: f.dataType.simpleString() for f in source.schema}

    def extract(batches):
        cache: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            texts = []
            for source, reference, template in zip(*(batch.column(name).to_pylist() for name in ("html", "reference", "template")), strict=True):
                page, slots = Page(source or ""), []
                if template is not None:
                    key = page.shape(), reference
                    if key not in cache:
                        if len(cache) >= 10_000:
                            cache.clear()
                        cache[key] = slots_of(*key)
                    slots = cache[key]
                texts.append(content(page, None if template is None else set(template), slots))
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(sizes)], ["id", "url", "text", "n_chars"])

    return source.mapInArrow(extract, f"id {types['id']}, url {types['url']}, text string, n_chars long").toDF(id_col, url_col, "text", "n_chars")

"""Page reading and alignment: hard pages, comments, and matching against plain recursion."""

import random
import time

import pytest

from llm import html_text


def slow_score(a, b):
    """Simple tree matching of (kind, children) trees."""

    if a[0] != b[0]:
        return 0
    table = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + slow_score(x, y))
    return table[-1][-1] + 1


def random_tree(rng, size):
    kids = []
    while size > 1 and rng.random() < 0.8 and len(kids) < 4:
        share = rng.randrange(1, size)
        kids.append(random_tree(rng, share))
        size -= share
    return rng.choice("abc"), kids


def shape_of(tree):
    lines, todo = [], [(0, tree)]
    while todo:
        parent, (kind, kids) = todo.pop(0)
        lines.append(f"{parent}:{kind}")
        todo += [(len(lines) - 1, kid) for kid in kids]
    return " ".join(lines)


def test_alignment_is_a_greatest_matching():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ("r", random_tree(rng, 12)[1]), ("r", random_tree(rng, 12)[1])
        one, two = shape_of(a), shape_of(b)
        found = html_text.align(one, two)
        kinds, children = html_text._tree(one)
        own_kinds, own_children = html_text._tree(two)
        pairs = [(x, y) for x, y in enumerate(found) if y >= 0]
        assert len(pairs) == slow_score(a, b) == len({y for _, y in pairs})
        assert all(kinds[x] == own_kinds[y] for x, y in pairs)
        for node, below in enumerate(children):
            places = [found[child] for child in below if found[child] >= 0]
            assert places == sorted(places) and all(place in own_children[found[node]] for place in places)


def test_long_lists_are_matched_in_order():
    rows = lambda n, every: "".join(f"<p>a</p><ul><li>b{'<ol><li>c</ol>' * (i % every)}</ul>" for i in range(n))
    one, two = (html_text.Page(f"<div>{rows(n, every)}</div>").shape() for n, every in ((3000, 7), (2900, 5)))
    began = time.time()
    found = html_text.align(one, two)
    assert time.time() - began < 20
    # Place by place, 2,900 paragraphs, lists and items match, and in each list the items both sides have.
    assert sum(place >= 0 for place in found) >= 3 * 2900 + sum(2 * min(i % 7, i % 5) for i in range(2900))
    assert html_text.align(one, one) == list(range(len(one.split())))


def test_a_long_list_has_a_greatest_matching_too():
    """What both lists share lies further apart than any window."""

    shared = [("x", [("y", [])] * (k % 5)) for k in range(220)]
    one = ("r", [("x", [(f"l{k}", [])]) for k in range(150)] + shared)
    two = ("r", [("z", [])] + shared + [("x", [(f"r{k}", [("y", [])])]) for k in range(150)])
    found = html_text.align(shape_of(one), shape_of(two))
    assert sum(place >= 0 for place in found) == slow_score(one, two)


@pytest.mark.parametrize("kept", [0, 1 << 20])
def test_both_ways_of_scoring_find_the_same_places(monkeypatch, kept):
    rng = random.Random(5)
    pairs = [[shape_of(("r", random_tree(rng, 40)[1])) for _ in range(2)] for _ in range(300)]
    cell_by_cell = [html_text.align(*pair) for pair in pairs]
    monkeypatch.setattr(html_text, "LIST_CELLS", 0)
    monkeypatch.setattr(html_text, "KEPT_BYTES", kept)
    assert [html_text.align(*pair) for pair in pairs] == cell_by_cell


def test_a_limit_met_below_changes_no_place(monkeypatch):
    rng = random.Random(6)
    pairs = [[shape_of(("r", random_tree(rng, 60)[1])) for _ in range(2)] for _ in range(200)]
    within = [html_text.align(*pair) for pair in pairs]
    monkeypatch.setattr(html_text, "TREE_CELLS", 20)
    assert [html_text.align(*pair) for pair in pairs] == within


def test_many_different_sections_end_in_seconds():
    """Six nodes in each of 1,500 sections, all of them different: 1,500 x 1,500 pairs of lists."""

    rng = random.Random(7)
    section = lambda: ("s", [(rng.choice("abcd"), [(rng.choice("efgh"), [])] * rng.randrange(3)) for _ in range(6)])
    one, two = (shape_of(("r", [section() for _ in range(1500)])) for _ in range(2))
    began = time.time()
    found = html_text.align(one, two)
    assert time.time() - began < 60
    assert sum(place >= 0 for place in found) > 1500


HARD = {
    "nested": ("<div>" * 100_000 + "x", "x"),
    "nested names": ("<div class=ad>" * 50_000 + "x", ""),
    "unfinished tags": ("kept " + "<a " * 3_000_000, "kept"),
    "open quotes": ("kept " + '<a b="' * 2_000_001, "kept"),
    "inline tags that a paragraph's end doesn't close": ("<b></p>" * 200_000, ""),
    "end tags behind a block": ("<i><div>x" + "<b>" * 100_000 + "</i>" * 100_000, "x"),
    "cells without a table": ("<div>" * 5_000 + "<td>a<th>b" * 5_000, "\n\n".join("ab" * 5_000)),
    "alternating": ("<div>" + "<p>a</p><ul><li>b</ul>" * 50_000, "\n\n".join("ab" * 50_000)),
}


@pytest.mark.parametrize("name", HARD)
def test_hard_pages_end_in_seconds(name):
    source, text = HARD[name]
    began = time.time()
    page = html_text.Page(source)
    html_text.slots_of(page.shape(), html_text.Page("<div><p>other</p></div>").shape())
    html_text.slots_of(page.shape(), page.shape())
    # A lone page of nothing but named furniture keeps the most of its text only if the name may be a container's.
    assert html_text.content(page, None, []) in (text, text or "x")
    assert time.time() - began < 60


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p title=it's>plain</p>", "plain"),
        ("<p title=\"a>b\" lang='>'>quoted</p>", "quoted"),
        ("<p a = '>' b=\">\">spaced</p>", "spaced"),
        ("1 < 2 <p>x<!-- > <p>no</p> --></p><!DOCTYPE x><?php no ?>y", "1 < 2\n\nx\n\ny"),
        ("<p>x</ p>y</>z</p>", "xyz"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<table><tr><td>1<th>2<tr><td>3</table>4", "1\n\n2\n\n3\n\n4"),
        ("<script>var a = '<p>no</p>';</script>yes<textarea>no", "yes"),
    ],
)
def test_markup(source, text):
    assert html_text.content(html_text.Page(source), None, []) == text


REPLIES = "".join(f"<div class='c'><b>reader {{0}} {k}</b><p>{'a long opinion ' * 60}{{0}}</p></div>" for k in range(6))
PLACES = {
    "beside": "<article><h1>T{0}</h1><p>short post {0}</p></article><div id='comments'>{1}</div>",
    "inside": "<article><h1>T{0}</h1><p>short post {0}</p><section class='comment-list'>{1}</section></article>",
    "in main": "<main><h1>T{0}</h1><p>short post {0}</p><div class='post-comments'>{1}</div></main>",
    "no article": "<div class='post'><h1>T{0}</h1><p>short post {0}</p></div><div id='disqus_thread'>{1}</div>",
}


@pytest.mark.parametrize("pages", [1, 6])
def test_comments_longer_than_the_article_are_left_out(spark, pages):
    rows = [
        (100 * at + i, f"http://{place.replace(' ', '')}.example/{i}", form.format(i, REPLIES.format(i)))
        for at, (place, form) in enumerate(PLACES.items())
        for i in range(pages)
    ]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {page: f"T{page % 100}\n\nshort post {page % 100}" for page, _, _ in rows}


@pytest.mark.parametrize("name", ["with-comments", "no-comments", "comments-open", "page-comments"])
def test_containers_named_for_comments_stay(name):
    page = html_text.Page(f"<div class='{name}'><main><h1>Title</h1><p>the text</p></main></div>")
    assert html_text.content(page, None, []) == "Title\n\nthe text"

"""Main text of pages: the trained model, the cut against all labellings, and odd markup."""

import random

import pytest

from facetlake.llm import html, pagemodel

ONE, TWO = "The first sentence, of some length, stands here.", "The second one, of some length, stands here."


def test_cut_is_the_cheapest_of_all_labellings():
    make, known, seen, changed = pagemodel.Pages(random.Random(17)), html.model(), 0, 0
    while seen < 60:
        found = html.blocks(make.page())
        n = len(found)
        if not 2 <= n <= 11:
            continue
        seen += 1
        cost = html.costs(found, known)
        edges = html.neighbours(found)

        def total(side, cost=cost, edges=edges):
            return sum(abs(c) for c, s in zip(cost, side, strict=True) if (c > 0) != s) + sum(2 * known.edges[k] for i, j, k in edges if side[i] != side[j])

        got = html.labels(found, known)
        best = min(total([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(total(got) - best) < 1e-9
        changed += got != [c > 0 for c in cost]
    assert (known.edges >= 0).all() and known.edges.sum() > 0


def test_labels_of_pages_that_the_model_has_not_seen():
    make, known = pagemodel.Pages(random.Random(4711)), html.model()
    wrong = alone = n = moved = 0
    for _ in range(300):
        found = html.blocks(make.page())
        truth = [pagemodel.ARTICLE in b.text for b in found]
        cut, single = html.labels(found, known), [c > 0 for c in html.costs(found, known)]
        n += len(found)
        wrong += sum(a != b for a, b in zip(cut, truth, strict=True))
        alone += sum(a != b for a, b in zip(single, truth, strict=True))
        moved += sum(a != b for a, b in zip(cut, single, strict=True))
    assert n > 4000 and wrong / n < 0.01 and wrong < alone and moved > 0


def test_model_is_the_same_again():
    a, b = (pagemodel.trained(html.blocks, html.neighbours, html.labels, html.KINDS, pages=60) for _ in range(2))
    assert a.weights.tolist() == b.weights.tolist() and a.edges.tolist() == b.edges.tolist()


@pytest.mark.parametrize("attributes", ['class="post has-sidebar"', 'class="post has-comments"', 'class="post no-ads" id=share-price', "", 'class="sidebar-layout"'])
def test_names_of_an_article_do_not_undo_it(attributes):
    assert html.main_text(f"<article {attributes}><h1>Title</h1><p>{ONE}</p><div class='share-price'>{TWO}</div></article>") == f"Title {ONE} {TWO}"


@pytest.mark.parametrize("box", ['<div class="cookie-notice">', '<div class="ad">', '<section id="comments">', '<div class="comment-list">', '<div class="relatedPosts">', "<aside>", "<nav>", "<footer>", '<div role="navigation">', '<div class="site-footer">', "<div hidden>", '<div class="sidebar left">'])
@pytest.mark.parametrize("inner", [f"<p>{TWO}</p>", f"{TWO}", f"<ul><li><a href=x>{TWO}</a></li></ul>"])
def test_boxes_beside_and_in_the_article_go(box, inner):
    tag = box[1:].split(" ")[0].rstrip(">")
    box = f"{box}{inner}</{tag}>"
    article = f"<h1>Title</h1><p>{ONE}</p>"
    assert html.main_text(f"<body>{box}<article>{article}</article>{box}</body>") == f"Title {ONE}"
    assert html.main_text(f"<body><main>{article}{box}<p>{ONE}</p></main></body>") == f"Title {ONE} {ONE}"


def test_lists_of_links_in_the_article_stay():
    links = "<ul>" + "".join(f'<li><a href="/{i}">Some place {i}</a></li>' for i in range(4)) + "</ul>"
    got = html.main_text(f"<nav>{links}</nav><article><h1>Title</h1><p>{ONE}</p>{links}<p>{TWO}</p></article><footer>{links}</footer>")
    assert got == f"Title {ONE} Some place 0 Some place 1 Some place 2 Some place 3 {TWO}"


@pytest.mark.parametrize("odd", ["<noscript>", "<object>", "<audio>", "<iframe src=x>", "<template>", "<svg/>"])
def test_open_elements_swallow_nothing(odd):
    assert html.main_text(f"<article><p>{ONE}</p>{odd}<p>{TWO}</p></article>") == f"{ONE} {TWO}"


def test_closed_elements_are_left_out():
    for tag in ("noscript", "iframe", "template", "svg", "object"):
        assert html.main_text(f"<article><p>{ONE}</p><{tag}>no</{tag}><p>{TWO}</p></article>") == f"{ONE} {TWO}"


def test_short_blocks_follow_their_neighbours():
    page = f"<body><div><a href=/>Home</a> <a href=/b>Other</a></div><div><h1>Title of it</h1><p>{ONE}</p><p>Yes.</p><p>{TWO}</p></div><div>&copy; 2020 some one</div></body>"
    assert html.main_text(page) == f"Title of it {ONE} Yes. {TWO}"


def test_whole_of_a_very_long_page():
    body = "".join(f"<p>Paragraph {i}, of some length, stands here.</p>" for i in range(5000))
    assert html.main_text(f"<article>{body}</article>").count("Paragraph") == 5000

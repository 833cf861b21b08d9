"""Main text: names weigh, blocks decide."""

import random

import pytest

from tilework.llm import mainhtml

P = "This is a paragraph of about one hundred and twenty characters that stands for the text of the page, and nothing else here."


@pytest.mark.parametrize("page", ['<div class="tags"><p>{}</p></div>', '<section class="social">{}</section>', '<div class="side">{}</div>', '<div class="search">{}</div>', '<div id="sidebar"><div>{}</div></div><nav>Home</nav>'])
def test_a_doubtful_name_does_not_lose_the_only_text(page):
    assert mainhtml.main_text(page.format(P)) == P


NAMES = "reader-comments post-comments article-comments user-comments comments-section comment-42 user-feedback thread ad-slot ad-unit page-header page-footer related-articles sponsored-content tag-cloud side social search share-buttons promo-box cookie-notice newsletter-form".split()


@pytest.mark.parametrize("name", NAMES)
def test_named_blocks_go_where_the_rest_carries_the_page(name):
    other = f'<div class="{name}"><p>{P}x</p><p>{P}y</p></div>'
    for page in ("<article><p>{0}</p>{1}</article>", "<div><p>{0}</p></div>{1}", "{1}<div><p>{0}</p></div>", "<main><div><p>{0}</p></div>{1}</main>"):
        assert mainhtml.main_text(page.format(P, other)) == P


@pytest.mark.parametrize("name", "article-header post content article-body has-ads no-comments commentary adventure sidebar-less-page thread-safety".split())
def test_other_names_say_nothing(name):
    assert mainhtml.main_text(f'<article><p>{P}</p><div class="{name}"><p>more</p></div></article>') == f"{P}\nmore"


def test_an_article_stays_whole_and_links_in_running_text_count():
    assert mainhtml.main_text(f"<article><p>{P}</p><ul><li><a>First</a></li><li><a>Second</a></li></ul></article>") == f"{P}\nFirst\nSecond"
    assert mainhtml.main_text(f"<h1><a>Head</a></h1><p>{P}</p><p><a>last linked</a></p>") == f"Head\n{P}\nlast linked"
    assert mainhtml.main_text(f"<ul><li><a>Home page</a></li></ul><div>{P}</div><ul><li><a>Next page</a></li></ul>") == P


def test_articles_in_which_nothing_surges_go():
    assert mainhtml.main_text(f"<article><p>{P}</p><p>{P}</p></article><article><p>Read on</p></article>") == f"{P}\n{P}"
    assert mainhtml.main_text("<article><p>Read on</p></article>") == "Read on"


def plain(weights):
    """The stretches by testing every line against every window."""
    n = len(weights)
    sums = [sum(weights[max(0, k - 1) : k + 2]) for k in range(n)]
    surge = min(140, 0.25 * max(sums, default=0))
    inside, out = False, []
    for k in range(n):
        inside = sums[k] > 0 and (sums[k] >= surge / 2 if inside else sums[k] >= surge)
        if inside:
            out.append(k)
    return out


def test_stretches_equal_a_plain_model():
    rng = random.Random(6)
    for _ in range(3000):
        weights = [rng.choice([0, 0, 0, 3, 10, 40, 80, 200, 900]) for _ in range(rng.randrange(0, 25))]
        assert [k for lo, hi in mainhtml.stretches(weights) for k in range(lo, hi)] == plain(weights)


def test_stretches_of_pages_are_what_their_lines_say():
    rng = random.Random(7)
    for _ in range(300):
        texts = ["x" * rng.choice([1, 4, 30, 100, 300]) for _ in range(rng.randrange(1, 12))]
        page = "".join(rng.choice(["<p>{}</p>", "<div>{}</div>", "<ul><li><a>{}</a></li></ul>", "<h2>{}</h2>"]).format(x) for x in texts)
        lines = mainhtml.lines(page)
        keep = plain([x.weight for x in lines])
        got = mainhtml.main_text(page).split("\n")
        for k in keep:
            if lines[k].weight:
                assert lines[k].text in got
        assert sum(map(bool, got)) <= sum(k in keep or x.heading for k, x in enumerate(lines))

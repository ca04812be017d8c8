"""Main text of pages with known articles, and shared runs against all pairs of pages."""

import itertools
import random

import pytest

from matchweave.llm import html_main
from tests.llm.helpers import prose

PAGE = "page_id bigint, url string, html string"


def text_of(spark, *pages):
    rows = [(k, f"http://h.example/{k}", html) for k, html in enumerate(pages)]
    return {r.page_id: r.text for r in html_main.main_text(spark.createDataFrame(rows, PAGE)).collect()}


def test_an_article_and_nothing_else(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T &lt; x</title><style>p{a:b}</style><script>if(a<b){'</p>'}</script></head><body class='has-sidebar'>"
        "<nav><ul><li><a href='/'>Home</a></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy</div><article><h1>Head &amp; line</h1><p>One<b> two</b>\n three&nbsp;&#233;"
        "<br>four<p>five <i>six</i><script>x</script></p><div class=\"share-buttons\">Share</div><section id='comments'><p>First!</p></section><p></p><ul><li>a<li>b</ul></article>"
        "<aside>Side</aside><footer>&copy; end</footer>"
    )
    assert text_of(spark, page)[0] == "Head & line\nOne two three é\nfour\nfive six\na\nb"


def test_broken_markup(spark):
    pages = ["<article><p>cut off in a tag <a href='x", "<article><p>a<!-- open", "<p>x</div></span></p>y", "< b > 1 < 2 & 3 &am", "<article><header><h1>T</h1></header>t</article>", "<main>m<main>n</main>o</main>"]
    found = text_of(spark, *pages)
    assert found[0] == "cut off in a tag" and found[1] == "a" and found[2] == "x\ny" and found[3] == "< b > 1 < 2 & 3 &am"
    assert found[4] == "T\nt" and found[5] == "m\nn\no"


def test_letters_whose_lower_case_is_longer_do_not_move_the_end_of_a_script(spark):
    page = "<article><p>\u0130\u0130\u0130stanbul</p><script>if (a </ b) {}</SCRIPT><p>After the script</p></article>"
    long = page.replace("After", "x " * 40_000 + "After")
    found = text_of(spark, page, long)
    assert found[0] == "\u0130\u0130\u0130stanbul\nAfter the script" and found[1].endswith("x After the script")


def test_only_class_id_and_role_name_an_element(spark):
    page = "<article><a href=\"/x?id=related\"><h2>Title</h2></a><p data-id='search'>One</p><p title=\"class=ad\">Two</p><p data-class=ad id = 'body'>Three</p><p CLASS=ad>no</p><p role='search'>no</p></article>"
    assert text_of(spark, page)[0] == "Title\nOne\nTwo\nThree"


def test_a_block_ends_where_its_kind_changes(spark):
    pages = [
        "<article>Loose words <span class=\"ad\"><p>buy</p></span></article>",
        "<article><p>Before <a class='share'>Share this</a> and after</p></article>",
        "<article><p>kept <span class='ad'>buy <b>now</b></span></p><p>more</p></article>",
    ]
    assert list(text_of(spark, *pages).values()) == ["Loose words", "Before\nand after", "kept\nmore"]


def test_headlines_in_an_articles_header(spark):
    page = "<div class='header'>Site</div><article><div class=\"header\"><h1>Headline</h1></div><div class='post-header masthead'>By A</div><div class='header-ad'>buy</div><p>Text</p></article>"
    assert text_of(spark, page)[0] == "Headline\nBy A\nText"


def test_a_zero_width_space_stays(spark):
    assert text_of(spark, "<article><p>a\u200bb \ufeffc&#8203;d</p></article>")[0] == "a\u200bb \ufeffc\u200bd"


def test_unmatched_end_tags_take_linear_time():
    import time

    took = []
    for n in (20_000, 40_000):
        start = time.perf_counter()
        html_main.blocks("<b>" * n + "</i>" * n + "x")
        took.append(time.perf_counter() - start)
    assert took[1] < 4 * took[0] + 0.2


def test_a_long_broken_page_takes_linear_time():
    assert html_main.blocks("<" * 200_000) and html_main.blocks("<a " * 60_000) is not None and html_main.blocks("<p>" * 50_000 + "x") == [("x", 1)]


def test_without_an_article_shared_blocks_go(spark):
    menu, foot = "one two three four five six seven eight nine", "all rights are kept by the owner of this site here"
    dice = random.Random(1)
    bodies = [prose(dice, 40, [f"w{k}" for k in range(500)]) for _ in range(4)]
    pages = [f"<div>{menu}</div><p>{b}</p><div>{foot}</div>" for b in bodies]
    assert [t for _, t in sorted(text_of(spark, *pages).items())] == bodies


def test_a_page_of_shared_blocks_alone_keeps_them(spark):
    same = "<p>" + " ".join(f"w{k}" for k in range(20)) + "</p>"
    found = text_of(spark, same, same + "<p>more of its own that no other page of the host has at all</p>")
    assert found[0].startswith("w0 w1") and found[1].startswith("more of its own")


@pytest.mark.parametrize("stretch", [3, 20_000])
def test_shared_runs_by_comparing_all_places(spark, monkeypatch, stretch):
    dice = random.Random(2)
    streams = [[dice.choice("ab") for _ in range(dice.randint(0, 25))] for _ in range(6)]
    streams.append(streams[0][:])
    run, longest = 3, 6
    monkeypatch.setattr(html_main, "RUN", run)
    monkeypatch.setattr(html_main, "STRETCH", stretch)
    rows = [(k, "h", words, [0] * len(words)) for k, words in enumerate(streams) if len(words) >= run] + [(99, "other", streams[1], [0] * len(streams[1]))]
    df = spark.createDataFrame(rows, "page_hash bigint, host string, words array<string>, places array<int>")
    found = {r.page_hash: {i for x in r.runs for i in range(x.a - 1, x.b - 1)} for r in html_main.covered(df).collect()}
    for k, words in enumerate(streams):
        expected = set()
        for j, other in enumerate(streams):
            for a, b in itertools.product(range(len(words)), range(len(other))):
                n = 0
                while n < longest and a + n < len(words) and b + n < len(other) and words[a + n] == other[b + n]:
                    n += 1
                if j != k and n >= run:
                    expected |= set(range(a, a + n))
        assert found.get(k, set()) == expected
    assert 99 not in found


def test_odd_tables(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain text"), (None, "http://a/b", "<p>t</p>"), (3, "x", "plain text"), (4, "//h", "<article></article>")]
    wide = spark.createDataFrame([(*r, 1, "a") for r in rows], PAGE + ", blocks int, host string")
    found = html_main.main_text(wide).collect()
    assert sorted((r.text, r.n_chars) for r in found) == [("", 0), ("", 0), ("", 0), ("plain text", 10), ("plain text", 10), ("t", 1)]
    assert html_main.main_text(wide.limit(0)).collect() == []


def test_unique_blocks_beside_an_article_stay(spark):
    """A teaser in an article and the body outside of it: what the host's pages share goes, the rest stays in order."""
    menu, foot = "one two three four five six seven eight nine", "all rights are kept by the owner of this site here"
    dice = random.Random(3)
    bodies = [prose(dice, 40, [f"w{k}" for k in range(500)]) for _ in range(4)]
    pages = [f"<div>{menu}</div><article>teaser {k}</article><p>{b}</p><div>{foot}</div><footer>end {k}</footer>" for k, b in enumerate(bodies)]
    assert [t for _, t in sorted(text_of(spark, *pages).items())] == [f"teaser {k}\n{b}" for k, b in enumerate(bodies)]


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article>own text</article></div>", "<main class='with-header'>own text</main>", "<article class='post promo'>own text</article>",
    "<form action='/x'><div>field</div><article>own text</article></form>", "<div class='page search'><p>found</p><article>own text</article></div>", "<article class='header'><p class='no-share side-note-text'>own text</p></article>",
])
def test_articles_in_named_wrappers_stay(page):
    assert [t for t, k in html_main.blocks(page) if k == 2] == ["own text"] and all(k == 0 for t, k in html_main.blocks(page) if t != "own text")


@pytest.mark.parametrize("noise", [
    "<div class='share-buttons'>x</div>", "<div class='a ad-slot'>x</div>", "<div id='site-header'>x</div>", "<div class='cookie-banner'>x</div>", "<div id='comments'><article>x</article></div>",
    "<div class='related'><article>x</article></div>", "<article>own text<article class='comment'>x</article></article>", "<article>own text<form>x</form></article>", "<aside><article>x</article></aside>",
])
def test_named_noise_still_goes(noise):
    assert [k for t, k in html_main.blocks(noise) if t == "x"] == [0]


def test_formulas_stay():
    assert " ".join(t for t, _ in html_main.blocks("<article>for <math><mi>x</mi><mo>=</mo><mn>1</mn></math> it holds</article>")) == "for x=1 it holds"

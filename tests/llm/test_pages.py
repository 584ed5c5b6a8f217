"""Pages whose wrappers carry names of boilerplate, and other ordinary markup."""

import pytest

from tidemark.llm.page_diff import extract_main, main_text, page_blocks


def text(html):
    blocks = page_blocks(html)
    return main_text(blocks, list(range(len(blocks))), None)


@pytest.mark.parametrize("html", [
    '<div class="wrapper has-sidebar"><article><p>The text.</p></article></div>',
    '<div id="page" class="layout no-sidebar"><main><p>The text.</p></main></div>',
    '<article><div class="entry comments-enabled"><p>The text.</p></div></article>',
    '<form><div><article><p>The text.</p></article></div></form>',
    '<article><section class="legal"><p>The text.</p></section></article>',
    '<article><p class="ad">Buy<p>The text.</p></article>',
    '<article><div class="ad"><p>Buy</p></div><p>The text.</p></article>',
    '<div class="main widget"><article><p>The text.</article></div>',
    '<main><p>The text.</p><article class="comment"><p>I disagree.</p></article></main>',
    '<article><p>The text.</p></article><section id="comments"><article><p>I disagree.</p></article></section>',
    '<article><p>The text.</p><div class="share-buttons">Share</div><div class="comment-list"><p>No</p></div></article>',
    '<aside><article><p>A teaser.</p></article></aside><article><p>The text.</p></article>',
    '<article><p>The text.</p><aside><p>Aside</p></aside><nav><ul><li>More</ul></nav></article><footer><p>Foot</p></footer>',
    '<body class="page-footer"><article><p>The text.</p></article></body>',
])
def test_only_the_article_stays(html):
    assert text(html) == "The text."


def test_an_unclosed_block_and_very_long_markup():
    assert text("<article><div><p>One<p>Two<ul><li>Three<li>Four</ul>Five") == "One\nTwo\nThree\nFour\nFive"
    many = "".join(f"<p>{i} word" for i in range(50_000))
    assert text(f"<article>{many}</article>").count("\n") == 49_999
    assert text("<div>" * 3000 + "<article><p>Deep</p></article>") == "Deep"


def test_differencing_takes_the_template_of_marked_articles(spark):
    """Lines at the edges of an article that both neighbours share go; copies, quoted passages and hosts of two pages keep theirs."""
    def page(*lines):
        return "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"

    own = {i: [f"{i} first", "a quoted passage", f"{i} second", f"{i} third", f"{i} last"] for i in range(1, 5)}
    values = [(i, f"http://h.org/a/{i}", page("Our daily letter", *own[i], "All rights reserved")) for i in (1, 2, 3, 4)]
    values += [(i, f"http://copies.org/a/{i}", page("the same", "article", f"{i}")) for i in (5, 6, 7)]
    values += [(i, f"http://two.org/a/{i}", page(f"{i} first", f"{i} second", "shared end")) for i in (8, 9)]
    values.append((10, "http://alone.org/", page("one line")))
    got = {r.page_id: (r.text, r.n_chars) for r in extract_main(spark.createDataFrame(values, "page_id long, url string, html string"), parts=2).collect()}
    assert len(got) == 10 and all(n == len(t) for t, n in got.values())
    for i in (2, 3):
        assert got[i][0].split("\n") == own[i]
    for i in (1, 4):  # at an end of the host's pages: one neighbour is no proof
        assert got[i][0].split("\n") == ["Our daily letter", *own[i], "All rights reserved"]
    assert [got[i][0] for i in (5, 6, 7)] == [f"the same\narticle\n{i}" for i in (5, 6, 7)]
    assert [got[i][0] for i in (8, 9)] == [f"{i} first\n{i} second\nshared end" for i in (8, 9)]
    assert got[10][0] == "one line"

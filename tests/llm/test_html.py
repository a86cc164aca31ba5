import itertools
import random

from blotter.llm.html_blocks import text_blocks
from blotter.llm.html_extract import extract_main_text, main_text, minimum_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head><body class="main">
<header><h1>Site name</h1><a href=/>Home</a></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy this long thing, it is very good for you and all your many friends.</div>
<article><h1>The title</h1><p>First &amp; <b>bold   text</b> that goes on for quite a while, so that nobody can doubt it.<p>Short.</p>
<div class="advert">Advert inside</div><p>Last&nbsp;paragraph &lt;tag&gt; &#233;&#x41; ends here.</p><form><input> Sign up</form></article>
<aside>Side bar text that is long enough to be a paragraph of its own, if one did not look.</aside>
<section id="comments"><article class="comment"><p>A reader comment that is a long paragraph of text, too, and yet not main.</p></article></section>
<!-- <p>hidden</p> --><footer>&copy; foot</footer></body></html>"""


def test_keeps_the_article_only():
    assert main_text(PAGE) == ("The title\nFirst & bold text that goes on for quite a while, so that nobody can doubt it.\nShort.\n"
                               "Last paragraph <tag> éA ends here.")


def test_without_article_element():
    page = ("<body><div class=menu><a href=/>x</a> <a href=/>y</a></div><div id=wrap><h2>Head line</h2><p>" + "Words of a story. " * 12 +
            "</p><p>Tiny.</p><p>" + "More of the story. " * 9 + "</p></div><div class=footer>Copyright</div>")
    assert main_text(page).split("\n") == ["Head line", ("Words of a story. " * 12).strip(), "Tiny.", ("More of the story. " * 9).strip()]


def test_broken_pages():
    assert main_text("") == "" and main_text(None) == "" and main_text("<") == ""
    assert main_text("<p>1 < 2 and 3 <4, as far as this sentence is concerned.") == "1 < 2 and 3 <4, as far as this sentence is concerned."
    assert main_text("<article><p>Cut off in a ta") == "Cut off in a ta"
    assert main_text("<article><p>Cut off in a tag</p><p class='x") == "Cut off in a tag"
    assert main_text("<article><p>Kept.</p><script>never closed <p>no</p>") == "Kept."
    assert [b.text for b in text_blocks("a<br>b</p></div>c<p>d<table><tr><td>e<td>f</table>")] == ["a b", "c", "d", "e", "f"]


def test_minimum_cut_against_all_labellings():
    r = random.Random(3)
    for _ in range(200):
        n = r.randint(1, 8)
        scores = [r.randint(-4, 4) for _ in range(n)]
        edges = [(a, b, r.randint(0, 3)) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]
        cost = lambda keep: (sum(s for s, k in zip(scores, keep) if s > 0 and not k) - sum(s for s, k in zip(scores, keep) if s < 0 and k)
                             + sum(w for a, b, w in edges if keep[a] != keep[b]))
        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert cost(minimum_cut([float(s) for s in scores], [(a, b, float(w)) for a, b, w in edges])) == best


def test_many_blocks_and_rows(spark):
    long = "<article>" + "".join(f"<p>Paragraph number {i} of a very long page.</p>" for i in range(20000)) + "</article>"
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, None, "", "x"), (3, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = sorted((r.asDict() for r in extract_main_text(pages).collect()), key=lambda r: (r["page_id"] or 0))
    assert [r["n_chars"] for r in out[:4]] == [0, len(main_text(PAGE)), len(main_text(PAGE)), 0]
    assert out[4]["text"].count("\n") == 19999
    assert extract_main_text(pages.limit(0)).count() == 0

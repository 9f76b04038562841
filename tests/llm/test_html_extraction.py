import html
import re

import pytest

from shelfline.llm.html_extraction import WINDOW, main_lines, main_texts, segments

AROUND = {
    "menu": '<nav><ul><li><a href="/a">One link</a></li><li><a href="/b">Another link</a></li></ul></nav>',
    "header": "<header><h2>Name of the site</h2><p>Its motto, which is rather long for a motto but there it is.</p></header>",
    "advert": '<div class="ad">Buy this now, it is much cheaper than what you bought last week, and better.</div>',
    "notice": '<div id="cookie-notice"><p>We keep cookies. All of them. For ever and ever, as the law of the land demands.</p></div>',
    "sidebar": '<aside><h3>Also read</h3><p>Something else that is long enough to look like text of the article.</p></aside>',
    "named sidebar": '<div class="leftSidebar"><p>Something else that is long enough to look like text of the article.</p></div>',
    "form": '<form action="/x"><label>Your name</label><input name="n"><textarea>Tell us</textarea><button>Send</button></form>',
    "script": '<script>var t="</p><p>not text</p>";</script><style>p{margin:0}</style><noscript><p>Turn scripts on</p></noscript>',
    "comment": "<!-- <p>left out --> <!doctype x>",
    "readers": '<section id="comments"><article class="comment"><p>First! This is a reader who has much to say on it.</p></article></section>',
    "footer": "<footer>&copy; the site &middot; all rights\nreserved</footer>",
}
ARTICLE = '<h1>Fish &amp; chips</h1><p><b>First\n  line</b> of <a href="/x">it</a>.<br><p>Of.</p><p>Caf&eacute; &lt;b&gt; &#x4e00;</p><ul><li>one<li>two</ul><p>End.</p>'
TEXT = ["Fish & chips", "First line of it.", "Of.", "Café <b> 一", "one", "two", "End."]


def page(inner, *names):
    parts = "".join(AROUND[n] for n in names)
    return f'<!DOCTYPE html><html lang="en"><head><title>T</title></head><body>{parts}{inner}{parts}</body></html>'


@pytest.mark.parametrize("name", sorted(AROUND))
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_parts_around_the_text(name, tag):
    inside = ARTICLE.replace("<p>Of.</p>", AROUND[name] + "<p>Of.</p>")
    expected = TEXT
    if name == "header" and tag != "div":  # the heading of an article is part of it
        expected = [*TEXT[:2], "Name of the site", "Its motto, which is rather long for a motto but there it is.", *TEXT[2:]]
    assert main_lines(page(f"<{tag}>{ARTICLE}</{tag}>", name)) == TEXT
    assert main_lines(page(f"<{tag}>{inside}</{tag}>")) == expected


def test_wrappers_and_broken_markup():
    assert main_lines(page(f'<div class="has-sidebar"><article>{ARTICLE}</article></div>', *AROUND)) == TEXT
    assert main_lines(page(f"<article>{ARTICLE}</article>", *AROUND).replace("</body></html>", "")) == TEXT
    assert main_lines(f"<div><nav><ul><li>menu</div><article>{ARTICLE}") == TEXT
    assert main_lines('<p>a <b>b <i>c</b> d</i><p title="x > y">e &amp f &am</p><a href="q">cut off') == ["a b c d", "e & f &am", "cut off"]
    assert main_lines("<p>a</p><scr") == ["a"]
    assert main_lines("<p>a<script>never closed <p>b") == ["a"]
    assert main_lines("<table><tr><td>1<td>2</tr><tr><th>3</th></tr></table>") == ["1 2", "3"]


def test_without_structure():
    links = "".join(f'<li><a href="/{i}">A link to another page of this site</a></li>' for i in range(9))
    prose = "".join(f"<p>Sentence number {i} of a text that has no element of its own.</p>" for i in range(5))
    text = [f"Sentence number {i} of a text that has no element of its own." for i in range(5)]
    assert main_lines(f"<div><ul>{links}</ul></div><hr><nav>x</nav>{prose}") == text
    assert main_lines("no markup at all\n and  a line") == ["no markup at all and a line"]


def test_surge_and_dive():
    gap = [0] * WINDOW
    assert segments([]) == []
    assert segments([0, 0]) == []
    assert segments([5, 0, 0, 7, *gap, 1, 2, 3, 4]) == [(0, 4, 7), (4 + WINDOW, 8 + WINDOW, 9)]
    # brute force: runs of lines with fewer than WINDOW blank lines between them
    import random

    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.choice([0, 0, 0, 3, 9]) for _ in range(rng.randrange(30))]
        filled = [i for i, n in enumerate(lengths) if n]
        runs = []
        for i in filled:
            if runs and i - runs[-1][-1] <= WINDOW:
                runs[-1].append(i)
            else:
                runs.append([i])
        best = [max(sum(lengths[max(0, i - WINDOW + 1) : i + 1]) for i in range(r[0], r[-1] + WINDOW)[: len(lengths) - r[0]]) for r in runs]
        assert segments(lengths) == [(r[0], r[-1] + 1, b) for r, b in zip(runs, best, strict=True)]


def plain(markup):
    """The article of the test tables' pages, by their template."""
    found = re.search("<article>(.*?)</article>", markup, re.S)
    parts = (html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split() for p in re.split("</?(?:p|h1)>", found[1] if found else ""))
    return "\n".join(" ".join(p) for p in parts if p)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in main_texts(pages).collect()}
    expected = {r.page_id: (r.url, plain(r.html)) for r in pages.collect()}
    assert {i: (r.url, r.text) for i, r in rows.items()} == expected
    assert all(r.n_chars == len(r.text) and r.n_blocks == len(r.text.split("\n")) for r in rows.values())


def test_odd_rows(spark):
    long = "<article>" + "<p>word and more</p>" * 200_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a", "x"), (4, "u", AROUND["menu"], "x"), (4, "u", AROUND["menu"], "x"), (5, "u", long, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_texts(frame).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == sorted([("1", 0), ("2", 0), ("None", 1), ("4", 0), ("4", 0), ("5", 14 * 200_000 - 1)])
    assert main_texts(frame.where("false")).count() == 0

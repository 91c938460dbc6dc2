"""Extraction from written pages, and the tree's importance against plain counting."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest
from helpers import SF, read, rows, sentence

from spendlake.llm import html_extract
from spendlake.llm.html_extract import Page, extract, importance

SCHEMA = "page_id long, url string, html string"


def text(source: str) -> str:
    return Page(source).text()


def test_blocks_and_white_space():
    assert text("<p>a\n  b</p><p>c<br>d</p>e") == "a b\n\nc d\n\ne"
    assert text("<article><h1>T</h1><p><b>x.<br><p>y</article>") == "T\n\nx.\n\ny"
    assert text("<ul><li>a<li>b <i>c</i>d</ul><table><tr><td>1<td>2<tr><th>3</table>") == "a\n\nb cd\n\n1 2\n\n3"
    assert text("a&nbsp;b &amp;&lt;p&gt; &#233;&#x1F600; &copy &am") == "a b &<p> é\U0001f600 © &am"
    assert text("") == text("   ") == text("<p></p><br>") == ""
    assert text("a < b <3 > c") == "a < b <3 > c"


def test_noise_by_markup():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
      <header>h</header><nav><ul><li>n</li></ul></nav><!-- <p>c</p> --><div class="ad box">ad</div><aside>s</aside>
      <div id="cookie-notice">k</div><form><p>f</p></form><main><article><h1>T</h1><p>one <span class="ads">x</span>two</p>
      <div class="reader-comments"><article>c</article></div><p hidden>z</p></article></main><footer>f</footer>"""
    assert text(page) == "T\n\none two"
    assert text('<div class="header">x</div><div class="threads loads">y</div>') == "y"
    assert text("<main>m</main><p>o</p>") == "m"
    assert text('<div role="navigation">x</div><section role="main">y</section>') == "y"


def test_values_of_other_attributes_are_not_names():
    for attributes in ('style="overflow:hidden"', 'aria-hidden="false"', 'title="the hidden cost"', "data-x = 'a class=ad b'", "alt='role=\"menu\"'"):
        assert text(f"<div {attributes}>kept</div>") == "kept"
    for href in ('"/the-hidden-truth"', '"/x?id=login"', "/x?id=login", "'/a id=ad'"):
        assert text(f"<p>all <a href={href}>the words</a> stay</p>") == "all the words stay"
    assert text('<div data-a="1"class=ad>x</div><div title=x HIDDEN>x</div><div a = b ID = "ad">x</div><div role=\'menu\'>x</div>y') == "y"
    assert text("<div class= hidden>x</div>") == "x"


def test_names_count_as_a_whole():
    for name in ("has-sidebar", "no-sidebar", "with-comments", "social-policy", "notice-of-meeting", "ad-hoc", "content-sidebar", "post-header"):
        for shell in ("body", "main", "article", "div", "section"):
            assert text(f'<{shell} class="{name}"><p>story</p></{shell}>') == "story"
            assert text(f'<{shell} id="{name}"><p>story</p></{shell}>') == "story"
    for tag in ("html", "body", "main", "article"):
        assert text(f'<{tag} class="sidebar comments"><p>story</p></{tag}>') == "story"
    for name in ("ad", "ad-slot-3", "ad1", "main-nav", "site_header", "reader-comments", "cookie-notice", "social-links", "side-bar", "Share-Buttons"):
        assert text(f'<div class="big {name}">noise</div><p>story</p>') == "story"


def test_the_tree_decides_on_ambiguous_names(spark):
    rng = random.Random(7)
    shell = "<body><div class='notice'>{}</div><div class='alert'>Read our terms</div><p>{}</p></body>"
    parts = [(sentence(rng, 8), sentence(rng, 6)) for _ in range(20)]
    pages = [(i, f"http://a.com/{i}", shell.format(*p)) for i, p in enumerate(parts)]
    got = {r["page_id"]: r["text"] for r in rows(extract(spark.createDataFrame(pages, SCHEMA)))}
    assert got == {i: "\n\n".join(p) for i, p in enumerate(parts)}


def test_articles_do_not_bound_the_story():
    story = "<p>the story begins</p><p>and goes on for long</p>"
    want = "the story begins\n\nand goes on for long"
    teasers = "<article>one</article><article>two</article>"
    for shell in ("<main>{}{}</main>", "<div>{}</div>{}", "<main>{}</main><div>{}</div>"):
        assert text(shell.format(story, teasers)).startswith(want)
    assert text(f"<main>{story}<article>nested quote of a post</article><p>end</p></main>") == f"{want}\n\nnested quote of a post\n\nend"
    assert text("<article>the first and by far the longest part</article><p>the end</p>") == "the first and by far the longest part\n\nthe end"
    assert text(f"<main><article>{story}</article></main><p>aside</p>") == want
    assert text(f"<main><p>lead</p></main><div>{story}</div>") == f"lead\n\n{want}"


def test_broken_markup():
    assert text("<p>a</b></div></article>b") == "ab"
    assert text("<article><p>whole <a href='x>y'>link</a> te") == "whole link te"
    assert text("<p>a<!-- open") == "a"
    assert text("<p>a<script>open") == "a"
    assert text('<p>a<b class="x') == "a"
    assert text("<P>A</P><SCRIPT>x</SCRIPT><Nav>n</nAV>b") == "A\n\nb"
    assert text("<p>x</p>" * 3 + "<" * 2000) == "x\n\nx\n\nx\n\n" + "<" * 2000


def test_given_pages(spark):
    """In them everything of the article, and nothing else, is text."""
    pages = rows(read(spark, "pages"))
    got = {r["page_id"]: r for r in rows(extract(read(spark, "pages")))}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", p["html"], re.S)[1]
        want = " ".join(html_extract.html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert " ".join(got[p["page_id"]]["text"].split()) == want
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])
        assert got[p["page_id"]]["url"] == p["url"]
    assert SF


def site(rng: random.Random, host: str, n: int, first: int) -> list[tuple]:
    shell = "<html><body><div class='zone1'>Same on <b>every</b> page</div><div class='body'><p>{}</p><p>{}</p></div><div class='zone2'>All rights</div></body></html>"
    return [(first + i, f"http://{host}/{i}", shell.format(sentence(rng, 9), sentence(rng, 7))) for i in range(n)]


def test_what_repeats_on_a_site_is_cut(spark):
    rng = random.Random(4)
    pages = site(rng, "a.com", 30, 0) + site(rng, "b.com", 3, 100) + [(200, None, "<p>x</p>"), (201, "u", None)]
    got = {r["page_id"]: r["text"] for r in rows(extract(spark.createDataFrame(pages, SCHEMA)))}
    for i, _, source in pages[:30]:
        assert got[i] == "\n\n".join(re.findall("<p>(.*?)</p>", source))
    assert all(got[i].startswith("Same on every page\n\n") for i in (100, 101, 102))
    assert (got[200], got[201]) == ("x", "")


def test_copies_of_a_page_are_one(spark):
    pages = [(i, f"http://a.com/{i}", "<article><p>one text</p></article>") for i in range(50)]
    assert {r["text"] for r in rows(extract(spark.createDataFrame(pages, SCHEMA)))} == {"one text"}


@pytest.mark.parametrize("limit", [8 << 20, -1])
def test_both_joins_give_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(html_extract, "MOST_BROADCAST", limit)
    pages = site(random.Random(4), "a.com", 30, 0)
    got = rows(extract(spark.createDataFrame(pages, SCHEMA)))
    assert len(got) == 30
    assert not any("every" in r["text"] for r in got)


def plain_importance(pages: list[tuple[str, str]], prior: bool) -> dict:
    """Every node's pages and importance by plain counting over distinct pages."""
    shown: dict = {}
    for host, source in pages:
        page = Page(source, prior=prior, whole=True)
        whole = tuple(text for *_, text in page.blocks)
        for (path, kind), texts in page.texts.items():
            looks, read = shown.setdefault((host, path), (set(), set()))
            looks.add((whole, tuple(page.looks.get((path, kind), []))))
            read.update((whole, text) for text in texts)
    out = {}
    for node, (seen, read) in shown.items():
        m, looks, on = len(seen), Counter(look for _, look in seen), Counter(text for _, text in read)
        content = sum(math.exp(-math.log(k)) for k in on.values()) / len(on)
        entropy = -sum(n / m * math.log(n / m) for n in looks.values()) / math.log(m) if m > 1 else 1
        out[node] = m, content * (0.7 + 0.3 * entropy)
    return out


@pytest.mark.parametrize("prior", [True, False])
def test_importance_by_plain_counting(spark, prior):
    rng = random.Random(2)
    menu = [sentence(rng, 2) for _ in range(5)]
    pages = []
    for i in range(40):
        items = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in rng.sample(menu, 3))
        story = "".join(f"<p>{sentence(rng, 6)} <b>x</b></p>" for _ in range(rng.randint(1, 4)))
        pages.append((f"h{i % 2}", f"<div class=a{i}><ul>{items}</ul></div><nav>{items}</nav><div id=s>{story}<div>end</div></div>"))
    pages += pages[:7] + [("h0", "<section>alone</section>")]
    found = rows(importance(spark.createDataFrame(pages, "host string, html string"), prior))
    got = {(r["host"], r["path"]): (r["pages"], r["importance"]) for r in found}
    want = plain_importance(pages, prior)
    assert got.keys() == want.keys()
    assert len(got) == 2 * 5 + 1
    for node, (m, value) in want.items():
        assert got[node] == (m, pytest.approx(value))
        assert 0 <= value <= 1


def test_the_tree_alone_cuts_the_given_noise(spark):
    """Without any name of noise, on the host with most pages of the larger tables: nothing but the article is left."""
    pages = read(spark, "pages", "/root/testdata/sf0.1").where("url like '%://blog.tionsh.example.com/%'")
    found = rows(extract(pages, prior=False))
    assert len(found) > 300
    for r, p in zip(sorted(found, key=lambda r: r["page_id"]), sorted(rows(pages), key=lambda r: r["page_id"])):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", p["html"], re.S)[1]
        want = html_extract.html.unescape(re.sub("<[^>]*>", " ", article)).split()
        assert r["text"].split() == want


def test_the_tree_overrules_names(spark):
    """A named node that looks and reads otherwise on each page is the story, if there are pages enough; comments are not."""
    rng = random.Random(6)

    def story() -> str:
        return "".join(rng.choice(["<p>{}</p>", "<h2>{}</h2>", "<pre>{}</pre>"]).format(sentence(rng, 9)) for _ in range(rng.randint(4, 9)))

    shell = "<div class=menu>{}</div><div class=banner><p>{}</p></div><div class=comments>{}</div><p>{}</p>"
    parts = [(story(), sentence(rng, 5), story(), i) for i in range(40)]
    pages = [(i, f"http://{'a' if i < 35 else 'b'}.com/{i}", shell.format(*p)) for i, p in enumerate(parts)]
    for r in rows(extract(spark.createDataFrame(pages, SCHEMA))):
        i = r["page_id"]
        menu = re.findall(">([^<]+)</", parts[i][0]) if i < 35 else []
        assert r["text"].split("\n\n") == [*menu, str(i)]


def test_copies_do_not_make_the_stories_noise(spark):
    """One story on most pages of a site, under another number on each, stays, and so do the other stories."""
    rng = random.Random(8)
    same = "".join(f"<p>{sentence(rng, 20)}</p>" for _ in range(3))
    pages = []
    for i in range(90):
        story = same if i % 3 else "".join(f"<p>{sentence(rng, 20)}</p>" for _ in range(rng.randint(2, 5)))
        pages.append((i, f"http://a.com/{i}", f"<div class=m><a href=x>home</a> <a href=y>shop</a></div><h2>{i}</h2><div class=s>{story}</div>"))
    for r in rows(extract(spark.createDataFrame(pages, SCHEMA))):
        want = re.findall("<(?:p|h2)>(.*?)</(?:p|h2)>", pages[r["page_id"]][2])
        assert r["text"].split("\n\n") == want


def test_headline_and_form_of_the_story():
    assert text("<header>site</header><article><header><h1>Title</h1></header><p>story</p></article>") == "Title\n\nstory"
    assert text("<main><header class=nav>x</header><p>story</p></main>") == "story"
    words = "word " * 60
    assert text(f"<form action=/><p>{words}</p><select><option>x</select></form><p>end</p>") == f"{words.strip()}\n\nend"
    assert text(f"<p>{words}</p><form>name <input> <button>send</button></form>") == words.strip()
    assert text("<form>user <input></form>") == ""
    for name in ("comment-body", "sidebar-left", "topnav", "cookie-policy-text", "adbox"):
        assert text(f'<div class="{name}">noise</div><p>story</p>') == "story"


def test_deep_pages_take_linear_time():
    for source in ("<div>" * 100_000 + "deep", "<b>" * 30_000 + "<p>x</b></i>" * 30_000, "<div><li>" * 30_000 + "</p></span>" * 30_000,
                   "<b><div>" + "<i>" * 30_000 + "</b>x" * 30_000, "<p>" + "<b>" * 30_000 + "<li>x</p>" * 30_000):
        begin = time.perf_counter()
        Page(source).text()
        assert time.perf_counter() - begin < 10


def test_awkward_rows(spark):
    long = "<article>" + "<p>" + "w " * 500_000 + "</p>" * 3
    pages = [(None, None, None), (1, "", ""), (1, "", ""), (2, "http://a/", "\x00<p>\ud7ff</p>"), (3, "http://a/", long), (4, "x", "<div>" * 5000 + "deep")]
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "'x' as host", "'x' as turned", "1 as kind", "1 as salt")
    got = rows(extract(df))
    assert sorted(r["n_chars"] for r in got) == [0, 0, 0, 4, 4, 999_999]
    assert {r["page_id"]: r["n_chars"] for r in got}[3] == 999_999
    assert rows(extract(df.limit(0))) == []

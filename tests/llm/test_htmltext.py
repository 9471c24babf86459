import random
import re
import time

import pyarrow.parquet as pq
import pytest

from termloom.llm.htmltext import blocks_of, main_text, parsed


def extract(html):
    return " ".join(blocks_of(parsed(html))[0])


def test_pages():
    assert extract("<nav>menu</nav><article><h1>T &amp; U</h1><p>a <b>b</b>c<br>d<p>e</article><footer>f</footer>") == "T & U a bc d e"
    assert extract('<body><script>var t="</p>x";</script><div class="ad">buy</div><p>text  with\n space</p><form><p>no</p></form></body>') == "text with space"
    assert extract('<article>a<div class="comments"><p>troll</p></div><header><h1>h</h1></header></article>') == "a h"
    assert extract("<article><p>one<article>two</article>three</article>") == "one two three"
    assert extract("") == "" and extract("<<<>>&") == "<<<>>&"
    assert extract("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


def test_templates_of_a_host_go_and_articles_stay(spark):
    page = "<html><body><div class=x>Welcome to our site</div><div><p>story {}</p></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(30)]
    rows += [(100 + i, f"http://other.example/{i}", page.format(i)) for i in range(3)]
    rows += [(200 + i, f"https://copies.example/{i}", "<article><p>the same article</p></article>") for i in range(40)]
    rows += [(300, None, None), (301, "x", ""), (0, "http://h.example/0", page.format(0))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = main_text(d).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"story {i}" for i in range(30))
    assert all(text[100 + i] == f"Welcome to our site story {i}" for i in range(3))
    assert all(text[200 + i] == "the same article" for i in range(40)) and text[300] == text[301] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text(d.limit(0)).count() == 0


def test_copies_of_a_page_count_once_and_large_hosts_lose_templates(spark):
    page = "<body><div>{}</div><div><p>story {}</p></div></body>"
    rows = [(i, f"http://copies.example/{i}", page.format("head", "one")) for i in range(12)]
    rows += [(100 + i, f"http://mixed.example/{i}", page.format(f"head {max(i, 11)}", max(i, 11))) for i in range(50)]
    rows += [(1000 + i, f"http://large.example/{i}", page.format("menu" if i < 45 else f"own {i}", i)) for i in range(300)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in main_text(d, many=40).collect()}
    assert all(text[i] == "head story one" for i in range(12))
    assert all(text[100 + i] == f"head {max(i, 11)} story {max(i, 11)}" for i in range(50))
    assert all(text[1000 + i] == (f"story {i}" if i < 45 else f"own {i} story {i}") for i in range(300))


# pages as they are made, and what a reader would call their main text
LABELLED = [
    ('<article><h1>News</h1><p>Body.</p></article><article class="comment"><p>I disagree</p></article>', "News Body."),
    ('<main><p>Story</p><section id="comments"><article class="comment-body">No!</article></section></main>', "Story"),
    ('<article><p>Story of the day</p><ol class="commentlist"><li>me too</li></ol></article>', "Story of the day"),
    ('<body><form action="/" id="aspnetForm"><div class="menu">Home</div><div><h1>Title</h1><p>The whole page lies in one form.</p><input value="q"></div></form></body>', "Title The whole page lies in one form."),
    ('<body><form><label>Mail</label><input></form><p>Text beside a form that is longer.</p></body>', "Text beside a form that is longer."),
    ('<body><div class="post side by-side"><p>The story is here and long enough.</p></div></body>', "The story is here and long enough."),
    ('<body><div class="sidebar">links links links</div><div><p>The story is here and long enough.</p></div></body>', "The story is here and long enough."),
    ('<body><header>Site</header><nav>a b</nav><main role="main"><header><h1>Head</h1></header><p>Text</p></main><footer>(c)</footer></body>', "Head Text"),
    ("<body><p>one<p>two<ul><li>x<li>y</ul><table><tr><td>1<td>2</table></body>", "one two x y 1 2"),
    ("<body><div hidden>no</div><p>a&nbsp;b &lt;c&gt; &#8364;</p><noscript>no</noscript></body>", "a b <c> \u20ac"),
]


@pytest.mark.parametrize(("html", "want"), LABELLED)
def test_labelled_pages(html, want):
    assert extract(html) == want


def test_long_and_deep_pages_take_linear_time():
    for html in ("<body>" + "<div>" * 100_000 + "deep", "<p>" * 50_000 + "x", "<body>" + "<b>" * 30_000 + "</i>" * 30_000 + "y", "<article><p>" + "word " * 1_000_000):
        began = time.monotonic()
        text = extract(html)
        assert text.split()[-1] in ("deep", "x", "y", "word") and time.monotonic() - began < 20
    assert len(extract("<article><p>" + "word " * 1_000_000)) == 5_000_000 - 1


def bare(html):
    """A page without the names that tell its article from its surroundings."""
    html = re.sub(r"<(/?)(?:article|nav|footer|header|aside)\b[^>]*>", r"<\1div>", html)
    return html.replace('<div class="ad">', "<div>")


def test_counts_decide_on_pages_of_the_tables_without_marks(spark):
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    rng = random.Random(5)
    menus = ["Home News Sport Weather", "Home News Arts", "Imprint and contact of this site"]
    rows, want = [], {}
    for p in table[:120]:
        story = re.search(r"(?s)<article>.*</article>", p["html"])[0]
        html = f"<html><body><div><ul><li>{menus[0]}</li></ul></div>{bare(story)}<div>{rng.choice(menus[1:])}</div></body></html>"
        rows.append((p["page_id"], "http://one.example/" + str(p["page_id"]), html))
        want[p["page_id"]] = extract(story)
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in main_text(d).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_templates >= 2 for r in got.values())
    off = {r.page_id: r.text for r in main_text(d, least=10**9).collect()}
    assert all(off[i] != want[i] and off[i].endswith(("Arts", "site")) for i in off)


def test_templates_in_marked_articles_go_and_near_copies_stay(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    story = lambda n: " ".join(rng.choice(words) for _ in range(n))
    box = "<div>Read more of our best stories</div>"
    rows = [(i, f"http://boxes.example/{i}", f"<article><p>{story(60)}</p>{box}<p>{story(50)}</p></article>") for i in range(40)]
    same = [story(40) for _ in range(5)]
    rows += [(100 + i, f"http://near.example/{i}", f"<article>{''.join(f'<p>{p}</p>' for p in same)}<p>{story(12)}</p></article>") for i in range(40)]
    d = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, host string, row int, content string")
    got = main_text(d).collect()
    assert all("Read more" not in r.text and r.n_templates == 1 and r.n_chars > 300 for r in got if r.page_id < 100)
    assert all(r.n_templates == 0 and all(p in r.text for p in same) for r in got if r.page_id >= 100)
    assert len(got) == 80

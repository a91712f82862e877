"""Main text of pages: the article behind each page of the table, and hand-made pages."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from rastro.llm import html


def normal(text):
    return [line for line in (" ".join(x.split()) for x in text.split("\n")) if line]


def test_pages_of_the_table_hold_documents(spark, sf_dir, documents):
    """The pages are made from documents: below the heading stands one, line by line."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    known = {tuple(normal(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = html.page_report(pages).collect()
    assert Counter(r.page_id for r in found) == Counter(r.page_id for r in pages.select("page_id").collect())
    assert all(tuple(r.text.split("\n")[1:]) in known for r in found)
    assert all(r.n_chars == len(r.text) for r in found)


def text_of(page, *others):
    return html.main_texts([page, *others])[0][0]


def test_markup():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>
      <article><header><h1>A &amp; B</h1></header><p>One <b>two</b>three.<p>Caf&eacute;&nbsp;&lt;x&gt; 1 < 2
      <ul><li>first</li><li>second</li></ul><aside>Side</aside><form><input>Send</form>
      <script>var a = "<p>no</p>";</script><!-- <p>no</p> --><p class='x'>Last</p>
      <section id="comments"><p>Nice!</p></section></article><footer>(c)</footer></body></html>"""
    assert text_of(page) == "A & B\nOne twothree.\nCafé <x> 1 < 2\nfirst\nsecond\nLast"


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "with-menu", "page-widget", "sidebar-right", "social", "menu"])
def test_wrappers_named_like_chrome(name):
    article = """<article><p>The text.</p><section class="related-work"><p>Work.</p></section><div class="alert">Mind it.</div>
      <div id="comments"><article>Nice!</article></div><div class="ad">Buy</div></article>"""
    page = f"""<div id="top">Up</div><div class="{name}"><nav>Home</nav>{article}<div class="sidebar">More</div></div>"""
    assert text_of(page) == "The text.\nWork.\nMind it."
    assert text_of(f"<main>Own</main><div class='{name}'><aside>{article}</aside></div>") == "Own"


def test_cards_in_chrome_are_no_article():
    cards = '<div class="related-posts"><article>Read this too</article></div>'
    assert text_of(f"<article>The text.</article>{cards}") == "The text."
    assert "The longer text of the page." in text_of(f"<div>The longer text of the page.</div>{cards}")
    assert text_of("<div class='has-sidebar'>The text.<div class='site-footer'>(c)</div></div>") == "The text."


def test_broken_pages():
    assert text_of("") == ""
    assert text_of("just text\nin  a line") == "just text in a line"
    assert text_of("<article><p>cut <b>off &am") == "cut off &am"
    assert text_of("<article><p>a<p title='x") == "a"
    assert text_of("<script>never closed <p>x") == ""
    assert text_of("<p>" * 20000 + "deep" + "<" * 50000).startswith("deep")


def test_repeated_runs_go_where_markup_says_nothing():
    template = "<div>all rights reserved by the owner of this site here</div>"
    pages = [f"<body><p>{own}</p>{template}</body>" for own in ("first own words", "second other words", "third")]
    assert html.main_texts(pages)[0] == ["first own words", "second other words", "third"]
    alone = html.main_texts([pages[0], pages[0]])[0]
    assert alone[0].endswith("site here")  # a repeated row is no other page


def test_repeated_tokens_match_brute_force():
    rng = np.random.default_rng(2)
    streams = [[str(x) for x in rng.integers(0, 3, n)] for n in (0, 5, 8, 60, 90, 200)]
    grams = [{tuple(s[i : i + 8]) for i in range(len(s) - 7)} for s in streams]
    for i, (s, found) in enumerate(zip(streams, html.repeated_tokens(streams))):
        others = set().union(*(g for j, g in enumerate(grams) if j != i))
        wanted = [any(tuple(s[a : a + 8]) in others for a in range(max(p - 7, 0), p + 1) if a + 8 <= len(s)) for p in range(len(s))]
        assert found.tolist() == wanted


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, _x int"
    rows = [(1, None, None, "t", 1), (1, None, None, "t", 1), (None, "http://h/a", "<p>x", None, 2), (3, "http://h/b", "", "", 3)]
    found = html.page_report(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r.page_id, r.text) for r in found) == Counter([(1, ""), (1, ""), (None, "x"), (3, "")])
    assert html.page_report(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("broadcast_hosts", [0, 500_000])
def test_large_hosts_are_split(spark, monkeypatch, broadcast_hosts):
    monkeypatch.setattr(html, "BROADCAST_HOSTS", broadcast_hosts)
    rows = [(i, f"http://h/{i}", f"<body><p>page number {i} of many</p><div>one two three four five six seven eight nine</div>") for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.page_report(pages).collect()}
    assert texts == {i: f"page number {i} of many" for i in range(1000)}
    assert re.match("page", texts[0])


def test_groups_find_what_few_pages_share(spark):
    """A notice on 12 pages of 1,500 is found wherever they are, and equal pages show nothing about each other."""
    notice = "<div>a notice of nine words that few pages have</div>"
    rows = [(i, f"http://h/{i}", f"<body><p>page number {i} of many</p>{notice if i % 125 == 0 else ''}</body>") for i in range(1500)]
    rows += [(i, f"http://h/{i}", "<body>one text that stands on equal pages only so it is not repeated</body>") for i in range(2000, 2010)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in html.page_report(pages).collect()}
    assert len(found) == len(rows)
    assert all(found[i].text == f"page number {i} of many" for i in range(1500))
    assert all(found[i].n_repeated == 0 and found[i].text.startswith("one text") for i in range(2000, 2010))
    tokens = [html.parse(h)[0] for _, _, h in rows[:1500]]
    assert [found[i].n_repeated for i in range(1500)] == [int(c.sum()) for c in html.repeated_tokens(tokens)]


def repeated_by_host(rows):
    """For each row of (page_id, url, html) how many tokens lie in runs of eight that another page of its host has too."""
    runs = {}
    tokens = [(url.split("/")[2], page, html.parse(page)[0]) for _, url, page in rows]
    for host, page, found in tokens:
        for i in range(len(found) - 7):
            runs.setdefault((host, *found[i : i + 8]), set()).add(page)
    return [
        sum(any(len(runs[(host, *t[a : a + 8])]) > 1 for a in range(max(p - 7, 0), p + 1) if a + 8 <= len(t)) for p in range(len(t)))
        for host, _, t in tokens
    ]


def test_groups_agree_with_brute_force(spark):
    """Few words, hosts that name themselves on their pages, equal pages on one host and on others, in 12 groups."""
    rng = np.random.default_rng(5)
    pages = [" ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(0, 60))) for _ in range(150)]
    common = "and some words that stand on pages of many different hosts"
    rows = []
    for i, page in enumerate(pages + pages[:40]):
        host = f"h{i % 7}"
        rows.append((i, f"http://{host}/{i}", f"<body><p>{page}</p>" + (f"<p>{host} {common}" if i % 20 == 0 else "")))
    found = {r.page_id: r for r in html.page_report(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12)).collect()}
    assert [found[i].n_repeated for i in range(len(rows))] == repeated_by_host(rows)


def test_pages_are_parsed_once_and_html_is_not_shuffled(spark):
    rows = [(i, f"http://h/{i}", f"<body><p>page number {i} of many") for i in range(300)]
    report = html.page_report(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    assert len(report.collect()) == 300
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    steps = [line for line in plan.splitlines() if "InArrow" in line]
    assert len(steps) == 5 and sum("_html" in line for line in steps) == 1 and plan.count("ReusedExchange") == 2


def test_groups_send_less_than_the_table_holds(spark, sf_dir):
    """What groups send for comparing and extracting is smaller than the pages are in parquet, where few pages share runs."""
    path = Path(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet")
    table = spark.read.parquet(str(path)).selectExpr("page_id", "url", "html as _html", "split(url, '/')[2] as _host").coalesce(1)
    rows = table.mapInArrow(html._send_groups(4, 32), html._SENT).collect()
    sent = sum(len(value) for row in rows for value in row if isinstance(value, (bytes, bytearray)))
    assert sent < path.stat().st_size


@pytest.mark.parametrize("blocks", [[], ["one"], ["a b a", "c", "b d"], ["x " * 40, "y"]])
def test_groups_are_restored(blocks):
    page = "<html>" + "".join(f"<p>{b}<b>" for b in blocks) + "<article>text"
    group = html._group([page, "", page + "."], ["h", "h", "g"])
    again = html._restored(html._saved(group))
    assert again.words == group.words
    for name in ("ids", "sizes", "marks", "hosts", "names", "starts"):
        assert getattr(again, name).tolist() == getattr(group, name).tolist()


def test_one_page_has_no_runs_in_common():
    assert html.main_texts(["<body><p>page number 1 of many"]) == (["page number 1 of many"], [0])

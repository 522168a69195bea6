"""Main text of pages, lines against their neighbours, and a plain longest common subsequence."""

import random

from eventide.llm import pages


def text_of(html):
    found = pages.lines_of(html)
    top = max((x for x, _ in found), default=0)
    return [line for x, line in found if x == top and top > 0]


def test_markup_of_an_article():
    html = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>var t="</p>";</script><style>p{}</style></head><body>
    <header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
    <article><header><h1>The&nbsp;title</h1></header><p>One <b>bold<br>two</p><p>a &lt; b &am c<p>x<i>y</i>z
    <div id="cookie-notice"><p>We use cookies</p></div><aside>Side</aside><form><p>Mail</p><input></form>
    <ul><li>first<li>second</ul><section class="comments"><article>Reader: no</article></section><footer>By me</footer></article>
    <footer>&copy; site</footer></body></html>"""
    assert text_of(html) == ["The title", "One bold two", "a < b &am c", "xyz", "first", "second"]


def test_broken_markup():
    assert text_of("") == [] and text_of("plain & simple") == ["plain & simple"]
    assert text_of("<p>a<p class='x>b</p><p>c") == ["a", "b", "c"]
    assert text_of("<article><p>kept</p><p>cut <a href='") == ["kept", "cut"]
    assert text_of("<p>x</p><script>never ended <p>y") == ["x"]
    assert text_of("<p hidden>h</p><p style='display: none'>h</p><p>1 < 2 > 0</p>") == ["1 < 2 > 0"]
    assert text_of("<nav>only a menu</nav>") == []


def plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(8)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        found = pages.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == plain_lcs(a, b)
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in found)


def site(n, host="h.example"):
    page = lambda i: f"<div>Welcome to the site</div><div>Our topics</div><p>Story {i} begins</p><p>and {i} ends</p><div>Call us</div>"
    return [(i, f"http://{host}/a/{i:03}", page(i), "x") for i in range(n)]


def test_shared_lines_of_a_host_go(spark):
    rows = site(60) + [(100, "http://lone.example/", "<div>Welcome to the site</div><p>Alone</p>", "x"), (101, None, None, None), (102, None, "<p>No address</p>", None)]
    rows += [(103, "http://other.example/1", "<article>Welcome to the site</article>", "x"), (104, "http://other.example/2", "<article>Welcome to the site</article>", "x")]
    rows += [rows[0]]
    want = {i: f"Story {i} begins and {i} ends" for i in range(60)} | {100: "Welcome to the site Alone", 101: "", 102: "No address", 103: "Welcome to the site", 104: "Welcome to the site"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for most in (0, 1000):
        found = pages.extract(df, most=most).collect()
        assert len(found) == len(rows)
        for r in found:
            if r.page_id == 0:
                continue  # its nearest page is its own repetition
            assert (r.page_id, r.text, r.n_chars) == (r.page_id, want[r.page_id], len(want[r.page_id]))
    assert pages.extract(df.limit(0)).count() == 0
    assert pages.extract(df).columns == ["page_id", "url", "text", "n_chars"]


def test_partitions_do_not_change_results(spark):
    df = spark.createDataFrame(site(50) + site(3, "g.example"), "page_id long, url string, html string, x string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for parts in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(sorted(map(tuple, pages.extract(df).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_copies_of_a_page_keep_its_text(spark):
    rows = site(8)
    again = [(20, rows[3][1], rows[3][2], "x"), (21, "http://h.example/mirror/a", rows[3][2], "x"), (22, "http://h.example/mirror/b", rows[5][2], "x")]
    lone = [(30 + i, f"http://one.example/{i}", "<p>Only text</p>", "x") for i in range(5)]
    df = spark.createDataFrame(rows + rows[:1] + again + lone, "page_id long, url string, html string, text string")
    want = {i: f"Story {i} begins and {i} ends" for i in range(8)} | {20: "Story 3 begins and 3 ends", 21: "Story 3 begins and 3 ends", 22: "Story 5 begins and 5 ends"}
    want |= {30 + i: "Only text" for i in range(5)}
    for most in (0, 1000):
        found = pages.extract(df, most=most).collect()
        assert len(found) == 17 and all(r.text == want[r.page_id] for r in found)


def test_every_page_is_differenced(spark):
    """A line that a site repeats goes from articles too; one that two stories have in common stays."""
    page = lambda i: f"<article><div>Read our offers</div><p>Story {i} begins</p><p>Part {i // 2}</p><p>and {i} ends</p></article>"
    rows = [(i, f"http://h.example/a/{i:03}", page(i)) for i in range(30)] + [(100 + i, f"http://few.example/{i}", page(i)) for i in range(3)]
    rows.append((200, "http://h.example/a/029b", "<div>Read our offers</div><p>No article</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Story {i} begins Part {i // 2} and {i} ends" for i in range(30)} | {200: "No article"}
    want |= {100 + i: f"Read our offers Story {i} begins Part {i // 2} and {i} ends" for i in range(3)}
    for most in (0, 1000):
        found = pages.extract(df, most=most).collect()
        assert len(found) == len(rows) and {r.page_id: r.text for r in found} == want

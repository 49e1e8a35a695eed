"""Wrappers of hosts: template text within an article, and hosts of many places."""
from barlake.llm import html_extract

STORY = "one two three four five six seven eight nine ten eleven twelve".split()


def page(i, inner=""):
    return f"<body><main><h1>{STORY[i]}</h1>{inner}<section>Share this story</section><p>{STORY[i]} {STORY[-i]}</p></main></body>"


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}


def test_unmarked_template_text_inside_main(spark):
    rows = [(i, "http://h.example/x", page(i)) for i in range(6)] + [(9, "http://k.example/x", page(1))]
    got = extracted(spark, rows)
    assert [got[i] for i in range(6)] == [f"{STORY[i]} {STORY[i]} {STORY[-i]}" for i in range(6)]
    assert "Share this story" in got[9]  # one page tells nothing about its host


def test_numbers_in_classes_name_no_place(spark):
    """Every page has classes of its own; the notice is still found in all of them."""
    rows = [(i, "http://h.example/x", page(i, f'<div class="box-{i}">We moved</div>')) for i in range(6)]
    got = extracted(spark, rows)
    assert [got[i] for i in range(6)] == [f"{STORY[i]} {STORY[i]} {STORY[-i]}" for i in range(6)]


def test_rows_merge_as_wrappers_align(spark):
    rows = [(i, f"http://h{i % 2}.example/x", page(i, "<b>x</b>" * (i % 3))) for i in range(10)]
    df = html_extract.with_host(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    merged = html_extract.merged_places(html_extract.page_places(df))
    got = {(r.host, r.place) for r in html_extract.host_template(merged).collect()}
    flags = {(r.host, r.place): (r.sign, r.pages, r.repeated, r.optional, r.slot) for r in html_extract.host_wrappers(merged).collect()}
    want, wrappers = set(), {}
    for host in range(2):
        made = html_extract.align(html_extract.wrapper_of(html_extract.parse(h)) for i, _, h in rows if i % 2 == host)
        want |= {(f"h{host}.example", p) for p in html_extract.template_places(made)}
        wrappers |= {(f"h{host}.example", place): (sign, pages, repeated, optional, text is None if sign == "#" else None)
                     for place, _, sign, repeated, optional, text, pages in html_extract.wrapper_rows(made)}
    assert got == want and got
    assert flags == wrappers  # the same places, counts and flags as the iterative alignment
    assert any(f[2] for f in flags.values()) and any(f[3] for f in flags.values()) and any(f[4] for f in flags.values())


def test_attributes_by_browser_rules():
    extract = html_extract.extract
    assert extract('<main><p title="5" tall">Hello</p><p>World</p></main>') == "Hello World"
    assert extract('<main><p title="the hidden truth">Hello</p></main>') == "Hello"
    assert extract('<main><p data-x="a class=ad b">Hello</p><p class=ad>x</p></main>') == "Hello"
    assert extract('<main><p class="mt-2 p-4!">Hello</p></main>') == "Hello"
    assert extract("<main><p class='ad' class='x'>no</p><p id = side>no</p><p hidden>no</p><p a=b/c>yes</p></main>") == "yes"
    assert extract('<main><p title="unclosed>a</p><p>b</p></main>') == ""  # the quote runs to the page's end
    assert html_extract.attributes_at(' a=1 B="2>" c d=\'x\'e =f>', 0) == ({"a": "1", "b": "2>", "c": "", "d": "x", "e": "f"}, 23)


def test_any_depth():
    assert html_extract.extract("<div>" * 100 + "<nav>menu</nav><p>Hello</p>") == "Hello"
    deep = "<div>" * 20_000 + "<nav>menu</nav><p>Hello</p>" + "</div>" * 20_000 + "<div>" * 5_000 + "x"
    assert html_extract.extract(deep) == "Hello x"
    places = list(html_extract.wrapper_rows(html_extract.wrapper_of(html_extract.parse(deep))))
    assert len({p[0] for p in places}) == len(places) > 20_000


def test_near_copies_and_headings_keep_their_text(spark):
    body = "<p>" + " ".join(STORY * 5) + "</p>"
    rows = [(i, "http://copies.example/x", f"<main><h1>T{i}</h1>{body}</main>") for i in range(3)]
    rows += [(10 + i, "http://heads.example/x", f"<main><h2>Summary</h2><p>{STORY[i]} {STORY[-i]} text</p></main>") for i in range(5)]
    rows += [(20 + i, "http://bare.example/x", f"<body><div>Our terms apply</div><p>{STORY[i]} {STORY[-i]} is a text of its own</p></body>")
             for i in range(5)]
    got = extracted(spark, rows)
    assert all(got[i] == f"T{i} " + " ".join(STORY * 5) for i in range(3))
    assert all(got[10 + i].startswith("Summary ") for i in range(5))
    assert all(got[20 + i] == f"{STORY[i]} {STORY[-i]} is a text of its own" for i in range(5))

from tidemark.llm import html_text
from tidemark.llm.html_text import main_text

PARAGRAPH = "A sentence long enough to surge above the level of short labels, and a second clause to be sure."


def test_article_between_chrome():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p><article>";</script></head><body>
    <nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy now.</div>
    <article><h1>Title &amp; more</h1><p><b>{PARAGRAPH}<br><p>Short.</p><p>x &lt; y&nbsp;&eacute;  and
    a break</p><div class="advert"><p>Buy</p><div>more</div></div><p>End.</article><aside>Side</aside>
    <section id="comments"><p>{PARAGRAPH}</p></section><footer>&copy; host</footer></body></html>"""
    assert main_text(page) == f"Title & more\n{PARAGRAPH}\nShort.\nx < y é and a break\nEnd."


def test_without_article_element():
    page = f"""<body><div id="header">Site</div><div class="cookie-notice">We use cookies, more than you think, all of them at once.</div>
    <div>{PARAGRAPH}</div><div>Tiny.</div><p>{PARAGRAPH}</p><form>Name <input name=x><button>Go</button></form>
    <ol class="commentlist"><li>{PARAGRAPH}</li></ol><div class="footer">Imprint</div></body>"""
    assert main_text(page) == f"{PARAGRAPH}\nTiny.\n{PARAGRAPH}"


def test_link_lists_have_no_length():
    links = "".join(f'<li><a href="/{i}">A rather long link text number {i}</a></li>' for i in range(30))
    assert main_text(f"<body><div>{links}</div><hr><hr><hr><ul></ul><p>{PARAGRAPH}</p></body>").endswith(PARAGRAPH)


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<script>never closed") == ""
    assert main_text("<article>Er.</article>") == "Er."
    assert main_text("just text, no markup") == "just text, no markup"
    assert main_text("<p>a < b and 1 <2</p>") == "a < b and 1 <2"
    assert main_text('<article><p title="a > b">kept</p><p>cut off') == "kept\ncut off"
    assert main_text("<nav><ul><li>open menu<article><p>found</p></article>") == "found"
    assert main_text("<div class='notice'>n<div>m</div></div><p>kept</p>") == "kept"
    assert main_text("<p>x<!-- never closed <p>y") == "x"
    assert len(main_text("<article>" + "<p>word</p>" * 50_000 + "</article>").split("\n")) == 50_000


def test_frame(spark):
    pages = spark.createDataFrame([(1, "u", "<article>é<p>b</article>", 7), (1, "u", "<article>é<p>b</article>", 7), (None, None, None, None)],
                                  "page_id long, url string, html string, other int")
    out = html_text.extract(pages)
    assert out.columns == ["page_id", "url", "html", "other", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect()) == [(0, "", 0), (1, "é\nb", 3), (1, "é\nb", 3)]
    assert html_text.extract(pages.limit(0)).count() == 0
    assert html_text.extract(pages.withColumnRenamed("other", "text")).columns.count("text") == 1


def test_dropped_elements_end_without_end_tags():
    p = PARAGRAPH
    for start in ("<ul><li class=share>A<li>B</ul>", "<dl><dt class=share>A<dd>B</dl>", "<dl><dd class=share>A<dt>B</dl>",
                  "<table><tr><td class=share>A<td>B</table>", "<table><tr class=share><td>A<tr><td>B</table>"):
        assert main_text(f"<body>{start}<p>{p}</body>") == f"B\n{p}", start
        assert main_text(f"<article>{start}<p>{p}</article>") == f"B\n{p}", start
    for page in (f"<body><p>{p}<svg/><p>{p}", f"<p>{p}<math class='x' /><p>{p}", f"<p>{p}<svg><path d=x /><svg/></svg><p>{p}",
                 f"<head><meta charset=utf-8><title>T</title><p>{p}<p>{p}", f"<div><p class=ad>A<p>{p}</div><p>{p}",
                 f"<div><span class=ad>A</div><p>{p}<p>{p}", f"<p>{p}<p><a class=share>A</p><p>{p}"):
        assert main_text(page) == f"{p}\n{p}", page
    assert main_text(f"<article><p>{p}<div class=ad>A</article><article><p>{p}</article>") == f"{p}\n{p}"
    assert main_text(f"<html><head><title>T</title>{p}") == p
    assert main_text(f"<ul class=menu><li>A<ul><li>B</ul><li>C</ul><p>{p}") == p
    assert main_text(f"<div class=ad><div>A</div>B</div><p>{p}</div>") == p


def test_windows_choose_beside_a_small_article():
    teaser = "<article><h2>Also read</h2><p>A teaser.</article>"
    body = "".join(f"<p>{PARAGRAPH} {i}" for i in range(5))
    wanted = "\n".join(f"{PARAGRAPH} {i}" for i in range(5))
    assert main_text(f"<body><div>{body}</div>{teaser}</body>") == wanted
    assert main_text(f"<body>{teaser}<div>{body}</div></body>") == wanted
    assert main_text(f"<body><article>{body}</article><div>Imprint</div></body>") == wanted
    part = f"<article>{body}<div class=ad>Buy</div><p><a href=x>The source of it all</a></article>"
    assert main_text(f"<body>{part}<div>Imprint</div></body>") == wanted + "\nThe source of it all"


def test_lesser_regions_are_kept():
    long, closing, gap = "Word by word. " * 77, "A closing line. " * 13, "<div class=ad>Buy</div>"
    page = f"<div><p>{long}<p>{long}<p>{long}</div>{gap}<p>Few words.</p>{gap}<p>{closing}</p>{gap}<p>Tail."
    assert main_text(page).split("\n") == [long.strip()] * 3 + ["Few words.", closing.strip(), "Tail."]


def test_names_are_hints():
    p, q = PARAGRAPH * 3, PARAGRAPH * 2
    body = f"<p>{p}</p><p>{q}</p>"
    for page in (f"<div class='content no-sidebar'>{body}</div>", f"<article class='post comments-open'>{body}</article>",
                 f"<main class='has-banner'>{body}</main>", f"<article class='category-social'>{body}</article>",
                 f"<form id=aspnetForm>{body}</form>", f"<form><div>{body}</div><input></form>", f"<div class='page-header'>{body}</div>",
                 f"<div id=social-wrap><div>{body}</div></div>"):
        assert main_text(f"<body>{page}</body>") == f"{p}\n{q}", page
    assert main_text(f"<body><div class=header>Site<div>{body}</div>").endswith(f"{p}\n{q}")
    assert main_text(f"<body><p>{p}<div class=comments>{body * 9}</div>") == p  # comments may be longer than the article
    assert main_text(f"<body><p>{p}<div class='cookie-notice'>{PARAGRAPH}</div>") == p


def test_short_texts_at_either_end_stay():
    ad, long = "<div class=ad>Buy</div>", PARAGRAPH * 4
    assert main_text(f"<body><nav>N</nav><div><p>It began.{ad}<p>{long}<p>{long}{ad}<p>It ended.</div><div>Imprint</div>") == \
        f"It began.\n{long}\n{long}\nIt ended."


def test_hostile_pages_take_linear_time():
    import time
    for page in ("<a " * 350_000, "<a " * 350_000 + ">", "<a '" * 250_000 + ">", '<a "' * 250_001 + ">x", "<p>" + "<b title='" * 90_000 + "'>",
                 "<!--" * 250_000, "<" * 1_000_000, "</" * 500_000 + ">", '<a ">' * 250_001):
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 8, page[:20]
    began = time.process_time()
    main_text("<a " * 333_333)
    assert time.process_time() - began < 1

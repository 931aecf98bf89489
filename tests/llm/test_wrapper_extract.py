import json
import random
import resource
import time

import pytest

from brandtrack.llm import wrapper_extract as we
from brandtrack.llm.dom import parse
from brandtrack.llm.tables import Workspace

PAGE = """<!DOCTYPE html><html lang="en"><head><title>{t}</title><style>p{{margin:0}}</style>
<script>var t="</p><p>no";track({i});</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/{t}">{t}</a></li></ul></nav><div class="cookie-notice">Cookies {t}</div><!-- ad {i} -->
<div class="ad">Buy {t}</div><article id="post-{i}"><h1>{t} &amp; co</h1><div class="share">Share {i}</div>
<p>One {t}<br>two <b>bo</b>ld&nbsp;x\n y<p>Read our terms<ul><li>li {i}<li>last</ul>
<form>Mail {t} <input></form><section class="comments"><article class="comment">Nice {t}</article></section></article>
<aside>More {t}</aside><footer>&copy; {i}</footer></body></html>"""

def topic(i):
    return f"topic number {i} is a long and varied one about t{i} u{i} v{i} w{i}"


def page(i):
    return PAGE.format(i=i, t=topic(i))


def want(i):
    return f"{topic(i)} & co\nOne {topic(i)} two bold x y\nRead our terms\nli {i}\nlast"


def test_the_main_slot_is_kept_whole_and_nothing_else():
    wrapper = we.induce([page(i) for i in range(6)])
    assert len(json.loads(wrapper)["slots"]) == 1
    assert we.extract(page(7), wrapper) == want(7)
    assert we.extract(page(7), we.induce([page(1), page(2)])) == want(7)
    assert we.extract(page(7), None) == want(7)  # by names


def test_copies_of_one_text_make_no_template():
    pages = [page(1) + f"<!-- {k} -->" for k in range(8)]
    assert json.loads(we.induce(pages)) == {"slots": [], "beside": [], "fixed": []}


def odd(i, names, story="div"):
    """A page whose classes say nothing, with menu, advert and footer that vary from page to page."""
    rng = random.Random(i)
    words = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(rng.randrange(99)) for _ in range(n))
    menu = "".join(f"<li>{words(2)}</li>" for _ in range(5))
    lines = [words(rng.randrange(10, 40)) for _ in range(rng.randrange(2, 9))]
    title, a, b, c, d = words(5), *names
    text = (
        f"<body><div class={a}><ul>{menu}</ul></div><div class={b}>{words(9)}</div><div class={c}><{story}><h1>{title}</h1>"
        f"<p>Ingredients</p>{''.join(f'<p>{x}</p>' for x in lines)}</{story}></div><div class={d}>{words(6)}<p>Imprint</p></div></body>"
    )
    return text, "\n".join([title, "Ingredients", *lines])


def test_the_article_is_found_where_names_say_nothing():
    rng = random.Random(8)
    for _ in range(20):
        names = ["".join(rng.choice("bcdfgkxz") for _ in range(6)) for _ in range(4)]
        pages = [odd(rng.random(), names) for _ in range(rng.randrange(2, 9))]
        wrapper = we.induce([p for p, _ in pages])
        for text, wanted in [*pages, odd(rng.random(), names)]:
            assert we.extract(text, wrapper) == wanted
            assert all(by == "wrapper" for _, _, by in we.decide(text, wrapper))
            assert we.extract(text, None) != wanted


def test_misleading_names_of_the_main_slot_do_not_count():
    pages = [odd(i, ["aa", "bb", "widget", "dd"]) for i in range(6)]
    wrapper = we.induce([p for p, _ in pages])
    for text, wanted in pages:
        assert we.extract(text, wrapper) == wanted


def test_a_host_with_two_layouts_has_two_slots():
    one = [odd(i, ["aa", "bb", "cc", "dd"]) for i in range(4)]
    two = [odd(i, ["ee", "ff", "gg", "hh"], "section") for i in range(20, 24)]
    wrapper = we.induce([p for p, _ in one + two])
    assert len(json.loads(wrapper)["slots"]) == 2
    for text, wanted in [*one, *two, odd(9, ["aa", "bb", "cc", "dd"]), odd(99, ["ee", "ff", "gg", "hh"], "section")]:
        assert we.extract(text, wrapper) == wanted


def test_a_title_outside_the_longest_part_stays():
    """The main slot holds the first heading, even if a part of it holds most text and headings of its own."""
    make = lambda i: f"<body><h1>Title {i}</h1><div class=zz><h2>Part {i}</h2><p>{f'word{i} ' * 60}</p></div><p>End {i}</p></body>"
    wrapper = we.induce([make(i) for i in range(6)])
    assert we.extract(make(7), wrapper) == f"Title 7\nPart 7\n{('word7 ' * 60).strip()}\nEnd 7"


def test_constant_lines_outside_any_slot_are_template():
    """Without a heading there is no slot; names and constant nodes decide."""
    make = lambda i: f"<body><div>Our site</div><div><p>{f'word{i} ' * 30}</p></div></body>"
    wrapper = we.induce([make(i) for i in range(5)])
    assert we.extract(make(7), wrapper) == ("word7 " * 30).strip()
    assert we.extract(make(7), None).startswith("Our site")


def test_names_that_say_something_else_keep_their_text():
    for name in ("share-price", "related-work", "notice-of-death", "ad-hoc", "comments-on-kant"):
        assert we.extract(f"<article><div class='{name}'>a</div><p>b</p></article>", None) == "a\nb", name
    assert we.extract("<article><h2>x</h2><section id=discussion><p>d</p></section><fieldset>f</fieldset></article>", None) == "x\nd\nf"


def test_deep_and_wide_pages_are_read_in_time_and_memory_that_follow_their_length():
    deep = [f"<p>{i}</p>" + "<div>" * 100_000 + f"<h1>t{i}</h1><p>deep {i}" + "<ul><li>x" * i for i in range(3)]
    section = lambda i, k: "section" if (k * (i + 3)) % 7 else "div"
    mixed = ["<body>" + "".join(f"<{section(i, k)}><p>{i} {k}</p></{section(i, k)}>" for k in range(20_000)) for i in range(2)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.process_time()
    for pages in (deep, mixed):
        wrapper = we.induce(pages)
        assert we.extract(pages[-1], wrapper)
    assert time.process_time() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB
    # copies of the pages that broke the recursive form: a hot host, nested 600 deep
    nested = ["<div>" * 600 + f"<h1>{i}</h1><p>{'w ' * i}</p>" for i in range(5)]
    assert we.extract(nested[3], we.induce(nested)) == "3\nw w w"


def test_pages_without_the_container_and_without_any():
    wrapper = we.induce([page(i) for i in range(6)])
    other = "<body><nav>menu</nav><div><p>a &lt; b</p>c</div><div class=sidebar>s</div>tail"
    assert we.extract(other, wrapper) == "a < b\nc\ntail"
    assert we.extract("just text", wrapper) == "just text"
    assert we.extract("", None) == ""
    assert we.extract("<article>cut pa", None) == "cut pa"
    assert we.extract("<p hidden>x</p><p style='display: none'>y</p><p role=alert>w</p><p>z", None) == "z"


def test_elements_beside_the_text_are_known_by_their_names():
    for name in ("site-header", "topMenu", "ad-12", "cookieNotice", "post-comments", "related_posts", "alert alert-info"):
        page = f"<body><div class='{name}'>x<p>y</p></div><div id='c'><p>text</p></div></body>"
        assert we.extract(page, None) == "text", name
        assert we.extract(page.replace("class=", "id="), None) == "text", name
    for name in ("content with-sidebar", "no-comments", "headline", "shadow", "adventure", "thread"):
        assert we.extract(f"<body><div class='{name}'><p>text</p></div></body>", None) == "text", name
    assert we.extract("<body><div class='sidebar'>s<article>text</article></div><button>b</button></body>", None) == "text"


def test_headers_of_articles_are_part_of_them():
    page = "<body><header><p>Site</p></header><article><header><h1>T</h1><p>By X</p></header><p>a</article>"
    assert we.extract(page, None) == "T\nBy X\na"


def test_odd_markup_loses_no_text():
    assert we.extract('<p title="a>b">x</p></div></p>y<b>z</i>', None) == "x\nyz"
    assert we.extract("1 < 2 <3 & &amp; &#x41; <![CDATA[c]]>", None) == "1 < 2 <3 & & A c"
    assert we.extract("<table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e</dl>", None) == "a\nb\nc\nd\ne"
    assert we.extract("<p>" * 5000 + "deep" + "<div>" * 5000 + "er", None) == "deep\ner"
    assert we.extract("<a href='" * 300 + "x", None) is not None


def test_alignment_is_the_largest_one():
    """Against trying all alignments of small random trees."""
    rng = random.Random(3)

    def build(depth):
        inner = "".join(build(depth - 1) for _ in range(rng.randrange(3))) if depth else ""
        tag = rng.choice(["div", "section"])
        return f"<{tag}>{inner}</{tag}>"

    def best(a, b):
        if a.label != b.label:
            return 0

        def lists(x, y):
            if not x or not y:
                return 0
            return max(lists(x[1:], y), lists(x, y[1:]), best(x[0], y[0]) + lists(x[1:], y[1:]))

        return 1 + lists(a.children, b.children)

    for _ in range(60):
        a, b = parse(build(3)), parse(build(3))
        pairs = we.match(a, b)
        assert len(pairs) == best(a, b)
        assert all(x.label == y.label for x, y in pairs)


def test_rows_nulls_copies_clashing_columns_and_empty_tables(spark):
    rows = [(i, f"http://u@Example.com:80/{i}?q=//other.org", page(i), "x") for i in range(12)]
    rows += [(1, None, None, "x"), (None, "", "", "x"), (3, rows[3][1], rows[3][2], "x"), (99, None, "<p>a", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = we.digest(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = [r for r in got.collect()]
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found if r["url"]}
    assert by_id[3]["text"] == want(3)
    assert {(r["page_id"], r["text"], r["n_chars"]) for r in found if not r["url"]} == {(1, "", 0), (None, "", 0), (99, "a", 1)}
    assert we.digest(pages.limit(0)).collect() == []


def test_hosts_with_many_wrappers_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(we, "WRAPPER_BYTES", 0)
    rows = [(i, f"http://h{i % 3}.org/{i}", page(i)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in we.digest(pages).collect()}
    assert len(got) == 30 and all(t == want(i) for i, t in got.items())


def _by_host(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return pages, {r["page_id"]: r["text"] for r in we.digest(pages).collect()}


def test_every_page_of_a_host_counts(spark):
    """Six pages of a rare layout among 300: eight pages of the host would tell nothing of them."""
    common, rare = ["aa", "bb", "cc", "dd"], ["ee", "ff", "gg", "hh"]
    made = [odd(i, common) for i in range(294)] + [odd(i, rare, "section") for i in range(1000, 1006)]
    rows = [(i, "http://one.org/", text) for i, (text, _) in enumerate(made)]
    _, got = _by_host(spark, [*rows, *((i + 1000, url, text) for i, url, text in rows)])  # copies count once
    for i, (_, wanted) in enumerate(made):
        assert got[i] == got[i + 1000] == wanted, i


def test_a_page_unlike_the_others_hides_no_template(spark):
    make = lambda i: f"<body><div>Our site</div><div><p>{f'word{i} ' * 30}</p></div></body>"
    pages = [make(i) for i in range(30)] + [f"<body><div>Sorry {i}</div></body>" for i in range(3)]
    _, got = _by_host(spark, [(i, "http://one.org/", text) for i, text in enumerate(pages)])
    assert all(got[i] == f"word{i} " * 29 + f"word{i}" for i in range(30))


@pytest.mark.parametrize("small", [True, False])
def test_rounds_over_tasks_give_what_induce_gives(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(we, "WRAPPER_BYTES", 0)
        monkeypatch.setattr(we, "CHOSEN_ROWS", 0)
    rng = random.Random(5)
    hosts = {}
    for h in range(8):
        layouts = [(["".join(rng.choice("bcdfgkxz") for _ in range(6)) for _ in range(4)], s) for s in ("div", "section", "td")]
        n = [1, 2, 5, 40][h % 4]
        hosts[f"h{h}.org"] = [odd(rng.random(), *layouts[min(rng.randrange(6), 2)])[0] for _ in range(n)]
        hosts[f"h{h}.org"] += [page(i) for i in range(rng.randrange(3))] + ["", "<p>a"][: rng.randrange(3)]
    hosts["copies.org"] = [page(1) + f"<!-- {k} -->" for k in range(12)]
    rows = [(i, f"http://{h}/{i}", text) for h, texts in hosts.items() for i, text in enumerate(texts * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["host"]: json.loads(r["wrapper"]) for r in we.wrappers(pages, Workspace(spark)).collect()}
    nothing = {"slots": [], "beside": [], "fixed": []}
    for h, texts in hosts.items():
        assert got.get(h, nothing) == json.loads(we.induce(texts)), h
    assert sum(len(w["slots"]) > 1 for w in got.values()) > 1


def test_outlines_are_stored_whole():
    for text in (page(3), "", "<p>a<div>b</div>c", "<div>" * 3000 + "x", "İ <h1>😀</h1>"):
        outline = we.Outline.of(text)
        again = we.Outline.unpack(outline.pack())
        assert all(getattr(again, name) == getattr(outline, name) for name in we.Outline.__slots__)


def test_short_pages_leave_the_slot_of_the_others_alone(spark):
    """Pages whose article is shorter than what is around it, and pages with a slot around that of the others."""
    names = ["aa", "bb", "cc", "dd"]
    made = [odd(i, names) for i in range(40)]
    for i in range(3):
        head, tail = made[i][0].split("<h1>")[0], made[i][0].split("<div class=dd>")[1]
        made.append((f"{head}<h1>T{i}</h1></div></div><div class=dd>{tail}", f"T{i}"))
    plain = [(f"<body><h1>Alone {i}</h1><p>{f'word{i} ' * 40}end</p></body>", f"Alone {i}\n{f'word{i} ' * 40}end") for i in range(3)]
    _, got = _by_host(spark, [(i, "http://one.org/", text) for i, (text, _) in enumerate(made + plain)])
    for i, (_, wanted) in enumerate(made + plain):
        assert got[i] == wanted, i


def test_long_lists_are_aligned_in_full():
    """More than half a million pairs of children, against the table of all of them."""
    rng = random.Random(12)
    lists = [[(rng.choice(["div", "section"]), rng.randrange(9)) for _ in range(n)] for n in (800, 760)]
    a, b = (parse("<body>" + "".join(f"<{tag}>{'<p></p>' * n}</{tag}>" for tag, n in items) + "</body>") for items in lists)
    last = [0] * (len(lists[1]) + 1)
    for tag, n in lists[0]:
        row = [0]
        for j, (other, k) in enumerate(lists[1]):
            row.append(max(last[j] + (1 + min(n, k) if tag == other else 0), last[j + 1], row[j]))
        last = row
    pairs = we.match(a, b)
    assert len(pairs) == 2 + last[-1]  # the pages and their bodies too
    assert all(x.label == y.label for x, y in pairs)


def test_a_template_in_the_midst_of_a_long_page_is_found():
    menu = "<div><ul>" + "".join(f"<li>Part {k}</li>" for k in range(60)) + "</ul></div>"
    pages, texts = [], []
    for i in range(5):
        rng = random.Random(i)
        words = [[f"w{i}x{k}x{n}" for n in range(rng.randrange(1, 4))] for k in range(900 + i)]
        items = ["<div>" + "".join(f"<p>{word}</p>" for word in some) + "</div>" for some in words]
        pages.append("<body>" + "".join([*items[: 450 + 2 * i], menu, *items[450 + 2 * i :]]) + "</body>")
        texts.append("\n".join(word for some in words for word in some))
    wrapper = we.induce(pages)
    assert [we.extract(page, wrapper) for page in pages] == texts


def test_rows_of_comparisons_give_what_single_ones_give(monkeypatch):
    rng = random.Random(4)

    def build(depth, most, tags):
        inner = "".join(build(depth - 1, max(2, most // 2), tags) for _ in range(rng.randrange(most + 1))) if depth else ""
        tag = rng.choice(tags)
        return f"<{tag}>{inner}</{tag}>"

    for k in range(150):
        tags = [["div"], ["div", "section"], "div section ul ol article main aside nav form table".split()][k % 3]
        depth, most = [(1, 40), (2, 12), (4, 4), (5, 3), (2, 30)][k % 5]
        a, b = (parse(f"<body>{build(depth, most, tags)}{build(depth, most, tags)}</body>") for _ in range(2))
        monkeypatch.setattr(we, "WIDE", 1 << 60)
        wanted = [(id(x), id(y)) for x, y in we.match(a, b, 1 << 60)]
        for wide, cells, slack, kept in ((0, 1 << 60, 1, 1 << 26), (0, 0, 4, 0), (1000, 0, 1, 64), (9, 50, 256, 1 << 26)):
            monkeypatch.setattr(we, "WIDE", wide)
            monkeypatch.setattr(we, "SLACK", slack)
            monkeypatch.setattr(we, "ROW_BYTES", kept)
            assert [(id(x), id(y)) for x, y in we.match(a, b, cells)] == wanted


def test_long_unlike_lists_take_bounded_time_and_memory():
    rng = random.Random(6)
    make = lambda: "<body>" + "".join(f"<div>{'<p></p>' * rng.randrange(40)}</div>" for _ in range(6_000)) + "</body>"
    spine = lambda: "".join("<div>" + "<p></p>" * rng.randrange(3) + "<div><p></p></div>" * rng.randrange(3) for _ in range(10_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.process_time()
    for build in (make, spine):
        assert we.match(parse(build()), parse(build()))
    assert time.process_time() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB

import functools
import html
import json
import random
import re
import time

import pytest

from helixframe.llm import html_wrappers as h


def page(rng, lines, variant=0):
    nav = "".join(f"<li><a href='/x{k}'>menu {rng.random()}</a></li>" for k in range(rng.randrange(1, 5)))
    body = "".join(f"<p>{'<b>' if k % 3 == 0 else ''}{html.escape(t)}{'</b>' if k % 6 == 0 else ''}</p>" for k, t in enumerate(lines))
    side = "<aside>side</aside><div class='widget sidebar-2'>more side</div>" if rng.random() < 0.5 else ""
    notes = '<div id="comments"><article class="comment"><p>reader said</p></article></div>' if rng.random() < 0.5 else ""
    main = f"<article>{body}{notes}</article>" if variant == 0 else f'<div class="post-{rng.randrange(99)} content">{body}<div class="ad">buy</div></div>'
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='<p>no</p>'</script></head><body><header>top</header><nav><ul>{nav}</ul></nav><!-- <p>c</p> -->{side}{main}<form>f <input></form><footer>&copy; foot</footer></body>"


def wrapper(pages):
    return functools.reduce(h.merge, (h.skeleton(h.parse(p)) for p in pages))


def lengths(pages):
    return h.slot_lengths(wrapper(pages))


def test_articles_come_out_whole():
    rng = random.Random(4)
    for variant in (0, 1):
        pages = [[f"line  {rng.random()} & <x>  \t é", f"second {rng.random()}", "same on all"] for _ in range(12)]
        made = [page(rng, lines, variant) for lines in pages]
        found = lengths(made)
        for lines, m in zip(pages, made, strict=True):
            assert h.extract(m, found) == "\n".join(" ".join(x.split()) for x in lines)


def test_alignment_finds_slots_optionals_and_repeats():
    one, two = "<div><h1>a</h1><p>1</p><p>2</p><i>x</i></div>", "<div><h1>b</h1><hr><p>3</p></div>"
    assert h.expression(wrapper([one])) == "<div>(<h1>(=) <p>(=)+ =)"
    assert h.expression(wrapper([one, two])) == "<div>(<h1>(#) <hr>()? <p>(#)+ =?)"
    assert h.expression(wrapper(["<ul><li>m<li>n</ul><p>1", "<ul><li>m<li>n</ul><p>2"])) == "<ul>(<li>(=)+) <p>(#)"
    rows = "<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>"
    assert h.expression(wrapper([rows])) == "<dl>(( <dt>(=)+ <dd>(=)+ )+)"
    assert h.expression(wrapper(["<div>a</div><p>b", "<p>c</p><div>d</div>"])) == "( <div>(#) <p>(#) )+"  # no one order


def test_counts_do_not_depend_on_the_order_of_pages():
    rng = random.Random(8)
    pages = [page(rng, [f"{rng.random()}"] * rng.randrange(1, 4), rng.randrange(2)) for _ in range(20)]
    want = lengths(pages)
    for _ in range(5):
        rng.shuffle(pages)
        halves = h.merge(json.loads(json.dumps(wrapper(pages[:7]))), wrapper(pages[7:]))
        assert h.slot_lengths(halves) == want


def story(rng, n):
    return [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(20, 60))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_slots_tell_the_article_whatever_its_tags_are_called(seed):
    rng = random.Random(seed)
    name = lambda: rng.choice(("div", "section", "x-" + "".join(rng.choices("bcdfgh", k=5)))) + rng.choice(("", f" class='k{''.join(rng.choices('bcdfgh', k=6))}'"))
    menu, promo, main, foot, outer = (name() for _ in range(5))
    texts = [story(rng, rng.randrange(3, 9)) for _ in range(15)]
    made = []
    for k, t in enumerate(texts):
        tag = lambda x, inside: f"<{x}>{inside}</{x.split()[0]}>"
        links = "<ul>" + "".join(f"<li><a href='/'>go {rng.randrange(99)} there</a></li>" for _ in range(9)) + "</ul>"
        parts = [tag(menu, links), tag(promo, f"<p>buy {rng.randrange(9999)}</p>"), tag(main, f"<h1>title {k}</h1>" + "".join(f"<p>{x}</p>" for x in t)), tag(foot, "<p>our address</p>")]
        made.append(f"<html><body>{tag(outer, ''.join(parts))}</body></html>")
    found = lengths(made)
    for k, (t, m) in enumerate(zip(texts, made, strict=True)):
        assert h.extract(m, found) == "\n".join([f"title {k}", *t])


def test_a_story_beside_teasers_that_are_called_articles():
    rng = random.Random(1)
    texts = [story(rng, 4) for _ in range(9)]
    cards = lambda: "".join(f"<article class='card'><h2><a href='/'>other {rng.randrange(999)}</a></h2></article>" for _ in range(rng.randrange(1, 4)))
    made = [f"<body><nav>n</nav><h1>Title {k}</h1><div class=text>{''.join(f'<p>{x}</p>' for x in t)}</div><div>{cards()}</div></body>" for k, t in enumerate(texts)]
    found = lengths(made)
    for k, (t, m) in enumerate(zip(texts, made, strict=True)):
        assert h.extract(m, found) == "\n".join([f"Title {k}", *t])


def test_without_one_main_element_what_differs_is_text():
    made = [f"<body><div>Menu</div><section>text {k}</section><p>more {k}</p><div>Menu</div></body>" for k in range(4)]
    assert h.extract(made[2], lengths(made)) == "text 2\nmore 2"
    assert h.extract("<body><article><h1>new shape</h1><p>x</p></article><nav>n</nav></body>", lengths(made)) == "new shape\nx"


def test_markup_in_bad_order():
    got = lambda t: h.extract(t, lengths([t]))
    assert got("<article><p><b>a.<br><p>b</p></b>c</article>") == "a.\nb\nc"
    assert got("<article>x &amp; y &lt;p&gt; &#233; &nope; a < b<p>z") == "x & y <p> é &nope; a < b\nz"
    assert got("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert got("<article>a<!-- b --><script>c</script><br/>d<span class='ad'>e <span>e</span> e</span>f") == "a df"
    assert got("<article><script>if (a<b && c>'</p>') x('<script')</script ><p title=\"a > b\">d</p><p class=it's>e</p></article>") == "d\ne"
    assert got("<body class='search form'><article><p>a</p><div class='search-form'>b</div><p class='search'>c</p><p class='search-history'>d</p></article>") == "a\nd"
    assert got("") == "" and got("<<<>>") == "<<<>>" and got("<p") == "<p"


def test_very_deep_and_very_long_pages():
    began = time.time()
    for tag in ("div", "h1", "li", "span class=ad"):
        deep = "<article><p>first</p>" + f"<{tag}>" * 20_000 + "deep" + f"</{tag.split()[0]}>" * 20_000 + "<p>last</p></article>"
        assert h.extract(deep, lengths([deep, deep])) == ("first\nlast" if "ad" in tag else "first\ndeep\nlast")
    for odd in ("<a ", "<a b=\"", "<a b='c' \"", "<!", "</", "<a b=", "&", "<script>", "<i>x"):
        long = "<article>" + odd * 60_000
        h.extract(long, lengths([long, long]))
    many = "<body>" + "".join(f"<div class='z{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}'>t{k}</div>" for k in range(17_000)) + "</body>"
    assert h.extract(many, lengths([many, many])).count("\n") == 16_999
    small = h.pruned(wrapper([many]), 100)
    assert h.extract(many, h.slot_lengths(small)).count("\n") == 16_999
    assert time.time() - began < 60


def test_rows(spark):
    rng = random.Random(6)
    rows = [(k, f"http://h{k % 3}.com/{k}", page(rng, [f"text {k}", "b"])) for k in range(30)]
    rows += [(50, None, "<article>n</article>"), (51, "http://h0.com/", None), (52, "u", ""), (None, "http://h1.com/", "<p>"), rows[0]]
    pages = spark.createDataFrame([(*r, "w", 1, "k") for r in rows], "page_id long, url string, html string, wrapper string, n_chars int, key string").repartition(4)
    got = h.extract_pages(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert r.text == (f"text {r.page_id}\nb" if r.page_id < 50 else "n" if r.page_id == 50 else "") and r.n_chars == len(r.text)
    assert h.extract_pages(pages.limit(0)).count() == 0
    old, h.BROADCAST_BYTES = h.BROADCAST_BYTES, 0  # the other way: wrappers joined by host
    try:
        assert sorted(map(str, h.extract_pages(pages).collect())) == sorted(map(str, got))
    finally:
        h.BROADCAST_BYTES = old
    assert all(re.search(r"<article>\(.*<p>\(#\)", h.expression(json.loads(r.wrapper))) for r in h.infer_wrappers(pages).collect() if ".com" in r.host)

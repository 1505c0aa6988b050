"""Wrappers against pages whose article is known."""

import random

import pytest

from hazemart.llm import page_wrappers
from hazemart.llm.markup import Page
from hazemart.llm.page_wrappers import GROUP, SLOT, Wrapper, aligned, judged, main_texts, packed, page_items, unpacked

WORDS = "alpha beta gamma delta über naïve und the of Straße 12 x&amp;y &lt;b&gt; caf&eacute;".split()
PLAIN = dict(zip(WORDS, "alpha beta gamma delta über naïve und the of Straße 12 x&y <b> café".split(), strict=True))


def say(draw, low, high):
    picked = [draw.choice(WORDS) for _ in range(draw.randint(low, high))]
    return " \n ".join(picked), " ".join(PLAIN[w] for w in picked)


def article(draw):
    """HTML and blocks of an article body."""
    source, blocks = [], []

    def block(before, after, low=4, high=30):
        text, plain = say(draw, low, high)
        source.append(before + text + after)
        blocks.append(plain)

    block("<h1>", "</h1>", 2, 6)
    for _ in range(draw.randint(1, 7)):
        kind = draw.random()
        if kind < 0.6:
            block("<p>", draw.choice(["</p>", "", "<br></p>"]))
        elif kind < 0.7:
            block("<p><b>", "</p>")
        elif kind < 0.8:
            block("<h2>", "</h2>", 1, 3)
            block("<p>", "</p>")
        elif kind < 0.9:
            source.append("<ul>")
            for _ in range(draw.randint(1, 4)):
                block("<li>", draw.choice(["</li>", ""]))
            source.append("</ul>")
        else:
            source.append("<table><tr>")
            block("<td>", "<td>")
            block("", "</table>")
    return "".join(source), blocks


def page(draw, style, number):
    body, blocks = article(draw)
    noise = [say(draw, 3, 12)[0] for _ in range(6)]
    menu = "".join(f'<li><a href="/{k}">{say(draw, 1, 1)[0]}</a>' for k in range(draw.randint(2, 6)))
    ad = draw.choice(["", f"<div class='ad box'>{noise[0]}</div>", f"<ins class=adsbygoogle-ad>{noise[0]}</ins>"])
    comments = "".join(f"<div class=comment-body><p>{say(draw, 3, 20)[0]}</p></div>" for _ in range(draw.randint(0, 4)))
    comments = f"<section id='comments'><h2>Comments</h2>{comments}</section>" if comments else ""
    head = f"<!DOCTYPE html><html><head><title>{noise[1]}</title><style>p{{}}</style><script>if(a<b)document.write('<p>no</p>')</script></head>"
    if style == "article":
        source = (
            f"{head}<body><header><a href=/>Site</a></header><nav><ul>{menu}</ul></nav>{ad}<article>{body}"
            f"<form><p>{noise[2]}<input></form></article>{comments}<aside>{noise[3]}</aside><footer>&copy; {noise[4]}</footer></body></html>"
        )
    elif style == "plain":
        # nothing but the wrapper tells the notice, the menu and the article apart
        notice = "<div><p>We value your privacy and say so on every page of this site</p></div>" if draw.random() < 0.7 else ""
        source = f"{head}<body>{notice}<div><ul>{menu}</ul></div><div><div>{body}</div></div><div><p>All rights reserved by the owner of the site</p></div>"
    else:
        source = f"<body><div class=sidebar><p>{noise[5]}<p>{noise[2]}</div><main class=no-sidebar>{body}</main>{comments}<div role=contentinfo>{noise[4]}"
    return source[: source.rfind("<footer>")] + "<foo" if style == "article" and number % 17 == 0 else source, "\n".join(blocks)


def test_known_articles(spark):
    draw = random.Random(6)
    rows, truth = [], {}
    for number in range(240):
        style = ("article", "article", "plain", "main")[number % 4]
        source, text = page(draw, style, number)
        rows.append((number, f"https://u@{style}.example.org:80/p/{number}?q=1", source, "x", 1))
        truth[number] = text
    rows += [(900, None, None, "x", 1), (901, None, "", "x", 1), (902, "odd", "<p>lone &amp; text", "x", 1), (903, "http://one.org", "<nav>menu</nav>", "x", 1)]
    truth |= {900: "", 901: "", 902: "lone & text", 903: ""}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int").repartition(5)
    found = main_texts(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r.text for r in found.collect()}
    wrong = [(k, rows[k][1] if k < 240 else k, got[k], truth[k]) for k in truth if got[k] != truth[k]]
    assert not wrong, wrong[:2]
    again = main_texts(frame.repartition(2).union(frame.limit(1)))
    assert {r.page_id: r.text for r in again.collect()} == got and again.count() == len(rows) + 1
    assert main_texts(frame.limit(0)).count() == 0


def tree(source):
    return page_items(Page(source).root)


def shape(items):
    return ["".join([k[0] if k[0] in (SLOT, GROUP) else k[0], "" if k[0] == SLOT else str(shape(k[3])).replace("'", ""), "+" if k[2] else "", "?" if not k[1] else ""]) for k in items]


def test_repeats_and_options():
    one = tree("<div><h1>a</h1><p>b<p>c<p>d</div>")
    assert shape(one) == ["div[h1[#], p[#]+]"]
    two = tree("<div><h1>a</h1><p>b<table><tr><td>x</table></div>")
    assert shape(aligned(one, two)) == ["div[h1[#], p[#]+, table[tr[td[#]]]?]"]
    runs = tree("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>")
    assert shape(runs) == ["dl[()[dt[#], dd[#]]+]"]
    assert unpacked(*packed(runs)) == runs
    wide = tree("".join(f"<div class=c{chr(97 + k % 26)}{chr(97 + k // 26)}>t</div>" for k in range(60)))
    assert [k[0] for k in wide] == [GROUP] and len(wide[0][3]) == 60 and not any(k[1] for k in wide[0][3])


def test_texts_all_pages_share_are_template():
    pages = [tree(f"<div>same words</div><div><p>text {k}</p><p>more {k}</p></div>") for k in range(6)]
    wrapper = pages[0]
    for p in pages[1:]:
        wrapper = aligned(wrapper, p)
    import json
    reader = Wrapper(json.dumps(judged(wrapper)))
    assert reader.main_text(Page("<div>same words</div><div><p>new</p><p>words</p></div>")) == "new\nwords"


@pytest.mark.parametrize("fan", [2, 64])
def test_rounds_end(spark, monkeypatch, fan):
    monkeypatch.setattr(page_wrappers, "FAN", fan)
    rows = [(k, "http://h/", f"<article>{'<p>a</p>' * (k % 3 + 1)}<h{k % 5 + 1}>t</h{k % 5 + 1}><div class=x{'y' * k}>z</div></article>") for k in range(40)]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == {k: "\n".join([*"a" * (k % 3 + 1), "t", "z"]) for k in range(40)}


def test_odd_markup():
    deep = Page("<div>" * 5000 + "deep" + "</div>" * 5000)
    assert Wrapper("[]").main_text(deep) == "deep"
    for source, text in [
        ("<p>a < b and c<d", "a < b and c"), ("x<!-- never closed <p>y", "x"), ("<p title=don't>a<p>b's", "a\nb's"),
        ("<script>x</scrip>", ""), ("<p class='a>b'>c</p>", "c"), ("<li>a<li>b</ul></div>c", "a\nb\nc"),
        ("a&nbsp;&#8195;b<br>c<span>d</span>", "a b cd"), ("&am &amp &copy2", "&am & ©2"), ("a<button>no</button> b", "a b"),
        ("<form><main><p>in</p></main><p>out</p></form>", "in"), ("<article><header><h1>T</h1><p>by</p></header>x</article>", "T\nx"),
    ]:
        assert Wrapper("[]").main_text(Page(source)) == text, source

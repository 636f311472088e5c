import cases
import numpy as np
import pytest

from strata.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="no-sidebar">
<nav><ul><li><a href="/a">Menu {i}</a></li></ul></nav><!-- <p>comment</p> --><header><h2>Site {i}</h2></header><div class="cookie-notice">We use cookies {i}</div>
<article><header><h1>Title&nbsp;{i} &lt;x&gt;</h1></header><p>First <b>bo</b>ld   para {i}<br>line.<p>Second &#233;t&eacute; para {i}</p><aside>Side {i}</aside>
<form><input value=1><p>Form {i}</p></form><ul><li>one {i}</li><li>two</li></ul><table><tr><td>c1</td><td>c2</td></tr></table></article>
<div id="comments"><article class="comment"><p>Reader {i}</p></article></div><div class="ad">Buy {i}</div><footer>&copy; {i}</footer></body></html>"""


def text(i):
    return f"Title {i} <x> First bold para {i} line. Second été para {i} one {i} two c1 c2"


def rows_of(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_article_only(spark):
    got = htmltext.extract(frame(spark, [(i, f"http://h.example/{i}", PAGE.format(i=i)) for i in range(5)]))
    assert rows_of(got) == {i: text(i) for i in range(5)}
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())


def plain(i, host_text, own):
    return f"<html><body><div class=wrap><p>{host_text}</p><div>{own}</div><p>{host_text} again and again until the very end</p></div></body></html>"


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_repeated_runs_go_and_unique_runs_stay(spark, bound):
    """Pages without an article: what other pages of the host have is boilerplate, by broadcast and by joins."""
    shared = "Welcome to our site where you can find everything about nothing at all every day"
    own = {i: cases.prose(50 + i, 40) for i in range(8)}
    rows = [(i, f"https://WWW.one.example:80/{i}?x", plain(i, shared, own[i])) for i in range(8)]
    rows += [(100, "http://other.example/", plain(0, shared, own[0]))]  # another host: nothing there is repeated
    got = rows_of(htmltext.extract(frame(spark, rows), htmltext.Params(broadcast_rows=bound)))
    assert {k: v for k, v in got.items() if k < 100} == own
    assert got[100] == f"{shared} {own[0]} {shared} again and again until the very end"


def test_notice_in_most_articles_goes_but_quotes_and_copies_stay(spark):
    notice = "Please support independent writing by telling all your friends about this small place"
    quote = "a passage that two articles of this host both quote word for word in full"
    def page(i):
        return f"<body><article><p>{cases.prose(i, 60)}</p><p>{notice}</p>{f'<p>{quote}</p>' if i < 2 else ''}</article></body>"
    rows = [(i, "http://h.example/", page(i)) for i in range(10)]
    got = rows_of(htmltext.extract(frame(spark, rows)))
    assert got == {i: cases.prose(i, 60) + (f" {quote}" if i < 2 else "") for i in range(10)}
    copies = [(i, "http://c.example/", f"<article><p>{cases.prose(1, 80)}</p></article>") for i in range(9)]
    assert set(rows_of(htmltext.extract(frame(spark, copies))).values()) == {cases.prose(1, 80)}


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "", "   "), (4, "http://x", "<p>a<p>b"), (4, "http://x", "<p>a<p>b"), (None, "http://y", "no markup 1 < 2 &am &amp; x"),
            (5, "http://z", "<script>never closed <p>x"), (6, "http://z", "<div hidden>h</div><p style='display: none'>n</p><p>shown</p>"), (7, "q", "<p>" + "w " * 50_000)]
    docs = frame(spark, rows).selectExpr("*", "'k' AS key", "1 AS run", "2 AS n", "3 AS text", "4 AS row")
    got = [(r["page_id"], r["text"]) for r in htmltext.extract(docs).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == by[2] == by[3] == by[5] == "" and by[4] == "a b" and by[6] == "shown"
    assert by[None] == "no markup 1 < 2 &am & x" and len(by[7]) == 99_999
    assert htmltext.extract(frame(spark, [])).collect() == []


def test_hosts():
    assert [htmltext.host_of(u) for u in ("HTTP://A.b:8/x", "//c.d/e", "https://u:p@e.f?x", None, "x/y")] == ["a.b", "c.d", "e.f", "", ""]


def one(page):
    return " ".join(b.text for b in htmltext.blocks_of(page) if not b.dropped)


def test_quotes_in_tags():
    assert one("<p title=don't>Hello it's me</p>") == "Hello it's me"
    assert one('<p>a <a href=x title="5" tall">b</a> c</p>') == "a b c"
    assert one("<p data-x='a>b' y=\"c>d\">t</p>") == "t" and one("<p x = 'a > b' hidden-not>t</p>") == "t"
    assert one('<p title="never closed>a</p><p>b</p>') == "a b"
    assert one("a <b c") == "a" and one("x < y <3 z") == "x < y <3 z"


def test_names_of_article_parts_are_no_marks():
    for mark in ("class='social-history'", "id=related-work", "class=promotion", "class=notice-board-history", "class='comment-free x'", "class=no-sidebar", "class=adrift"):
        assert one(f"<article><div {mark}>text</div></article>") == "text", mark
    for mark in ("class='x cookie-notice'", "id=related-articles", "class=ad", "class='ad-slot-3'", "class=shareButtons", "class=site-footer", "role=navigation", "class=comments-list"):
        assert one(f"<article>t<div {mark}>gone</div></article>") == "t", mark


def test_hostile_pages_take_time_that_follows_their_length():
    import time
    n = 400_000
    pages = ['<a "' * n, "<div>" * (n // 2) + "</p>" * (n // 2), "<b hidden>" + "<div>" * (n // 4) + "</b>" * (n // 2), "<![CDATA[" * n, "<!" * n, "</" * n, "<p x='" * n, "<script>" * n, "<" * n,
             "<a =" * n, "<ul><li>" * (n // 4) + "x", "&#" * n, "<!--" * n, '<a b="' * (n | 1), "word " * 1_000_000]
    for page in pages:
        start = time.process_time()
        htmltext.blocks_of(page)
        assert time.process_time() - start < 5, page[:20]


def test_pages_with_one_text_keep_it(spark):
    text = cases.prose(9, 90)
    shared = "Welcome to our site where you can find everything about nothing at all every day of the week and more"
    pairs = [(1, "http://two.example/a", f"<body><div>{text}</div></body>"), (2, "http://two.example/a?print", f"<body><div>{text}</div></body>")]
    rows = [(10 + i, f"http://big.example/{i}", f"<body><p>{shared}</p><div>{cases.prose(60 + i, 70)}</div></body>") for i in range(12)]
    rows += [(30 + i, f"http://big.example/copy{i}", f"<body><p>{shared}</p><div>{text}</div></body>") for i in range(3)]
    got = rows_of(htmltext.extract(frame(spark, pairs + rows)))
    assert got[1] == got[2] == text
    assert {k: got[k] for k in got if 10 <= k < 30} == {10 + i: cases.prose(60 + i, 70) for i in range(12)}
    assert {got[k] for k in (30, 31, 32)} == {text}


def test_runs_are_cut_at_words(spark):
    """A long unique run in a covered block stays, and a repeated run in a unique block goes."""
    line = " ".join(cases.words(77, 40))
    rows = [(i, f"http://cut.example/{i}", f"<div>{line} {cases.prose(500 + i, 25)} {line}</div><div>{cases.prose(600 + i, 120)} {line}</div>") for i in range(6)]
    got = rows_of(htmltext.extract(frame(spark, rows)))
    for i, t in got.items():
        words, own = t.split(), (cases.prose(500 + i, 25) + " " + cases.prose(600 + i, 120)).split()
        assert [w for w in own if w in set(words)] == own  # nothing unique is lost
        assert len(words) - len(own) <= 3 * 12  # what is left of three lines: ends that no suffix begins


def test_repeated_runs_against_brute_force():
    """Words under runs of 13 and more that another page of the host has, by comparing all places."""
    p = htmltext.Params()
    shared = [" ".join(cases.words(900 + k, 14 + 3 * k)) for k in range(6)]
    texts = [" ".join([cases.prose(300 + i, 30), shared[i % 6], cases.prose(400 + i, 30), shared[(i * 5 + 1) % 6], cases.prose(500 + i, 20)]) for i in range(9)]
    s = htmltext.streams(["http://h/"] * 9, [f"<p>{t}" for t in texts], p)
    keys, n = np.unique(np.unique(np.column_stack((s.owner.astype(np.uint64), s.keys)), axis=0)[:, 1], return_counts=True)
    on = dict(zip(keys.tolist(), n.tolist()))
    grams = [{tuple(t.split()[k : k + p.run]) for k in range(len(t.split()) - p.run + 1)} for t in texts]
    for i, t in enumerate(texts):
        words, base = t.split(), int(s.block_at[s.page_at[i]])
        under = np.zeros(len(words), bool)
        for place, key in zip(s.places[s.owner == i] - base, s.keys[s.owner == i].tolist()):
            held = {tuple(words[place : place + p.run])}
            assert on[key] <= sum(bool(held & g) for g in grams)  # near a run's ends a suffix may be picked on some pages only
            if on[key] > 1:
                under[place : place + p.run] = True
        true = np.zeros(len(words), bool)
        for k in range(len(words) - p.run + 1):
            if sum(tuple(words[k : k + p.run]) in g for g in grams) > 1:
                true[k : k + p.run] = True
        assert not (under & ~true).any()
        # of each repeated run of 13 words or more, all but its ends are found
        cuts = np.flatnonzero(np.diff(np.concatenate(([0], true.view(np.int8), [0]))))
        for a, b in zip(cuts[::2], cuts[1::2]):
            if b - a >= p.run + p.near - 1:
                assert under[a + p.near - 1 : b - p.near + 1].all() and under[a:b].any()

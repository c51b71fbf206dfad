import random

import numpy as np
import pytest
from conftest import SF_SMALL
from helpers import rows_of

from tickforge.llm import html_text as H


def text(html):
    return " ".join(H.read_page(html)[0])


@pytest.mark.parametrize("html, expected", [
    ("<article><h1>T&amp;C</h1><p>a <b>b</b>c<br>d</p></article>", "T&C a bc d"),
    ("<nav>m</nav><header>h</header><article><p>x&nbsp; y\n z</article><aside>s</aside><footer>f", "x y z"),
    ("<article><p>a<div class='ad-slot'>buy</div><div class=\"cookie-notice\">ok</div><form>f<p>q</form>b</article>", "a b"),
    ("<main><p>a</p><section id='comments'><article class='comment'>c</article></section></main>", "a"),
    ("<body><div role=navigation>n</div><div id=content>t<ul><li>1<li>2</ul></div><div class=sidebar>s</div>", "t 1 2"),
    ("<div class='page no-sidebar'><p>kept</div>", "kept"),
    ("<article>a<script>var t='</p>';</script>b<style>p{}</style><!-- c --><template>t</template>d</article>", "abd"),
    ("<article><p title='a>b'>x < y &lt; z &copy</p></article>", "x < y < z ©"),
    ("plain &eacute;", "plain é"), ("", ""), ("<script>never closed <p>a", ""), ("<article>a<!-- open", "a"),
    ("<article>&amp;amp;</article>", "&amp;"), ("<article></p>a</div>b</article>", "a b"), ("<p hidden>x<p>y", "y"),
    ("<article><P>A</P><BR/>B</ARTICLE><p>c", "A B"),
    ("<article><p class=ad>buy<p>kept<ul><li class=promo>x<li>y</ul><table><tr><td class=ad>q<td>r</table></article>", "kept y r"),
])
def test_article_text(html, expected):
    assert text(html) == expected


@pytest.mark.parametrize("html, expected", [
    ("<div class=post style=\"overflow: hidden\"><p>kept</div>", "kept"), ("<p>see <a href='/hidden/garden'>the garden</a> now", "see the garden now"),
    ("<p>a <b data-hidden=\"false\">b</b> <i title='the hidden class=ad'>c</i> <a href=/x?id=ad&hidden>d</a>", "a b c d"),
    ("<p>a<b HIDDEN>b</b><i aria-hidden = 'true'>c</i><u aria-hidden=false>d</u>", "ad"),
])
def test_only_whole_attribute_names_hide(html, expected):
    assert text(html) == expected


def test_repeated_tokens_equal_brute_force():
    rng = random.Random(3)
    for round_ in range(400):
        streams = [[rng.choice("abcde" if round_ % 2 else "ab") for _ in range(rng.randint(0, 24))] for _ in range(rng.randint(0, 5))]
        if round_ % 3 == 0 and streams:
            streams.append(list(streams[0]))
        run = rng.choice([2, 3, 4, 5, 7, 12])
        places = {}
        for k, s in enumerate(sorted({tuple(s) for s in streams})):
            for i in range(len(s) - run + 1):
                places.setdefault(s[i:i + run], set()).add(k)
        for s, got in zip(streams, H.repeated_tokens(streams, run)):
            covered = [False] * len(s)
            for i in range(len(s) - run + 1):
                if len(places[tuple(s[i:i + run])]) > 1:
                    covered[i:i + run] = [True] * run
            assert got.tolist() == covered


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, host string, blocks string, text string")


def answers(spark, rows):
    return {r["page_id"]: r for r in rows_of(H.main_text(pages(spark, rows)))}


BOILER = "This site uses many small things to make your stay as nice as it can be made today"


def test_open_pages_lose_what_repeats_on_their_host(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<p>{BOILER}</p><p>story {' '.join(f'w{i}x{k}' for k in range(60))}</p>") for i in range(6)]
    rows.append((10, "http://other.org/", f"<p>{BOILER}</p><p>alone</p>"))
    got = answers(spark, rows)
    assert all(BOILER not in got[i]["text"] and got[i]["text"].endswith(f"w{i}x59") for i in range(6))
    assert got[10]["text"] == f"{BOILER} alone"


def test_marked_articles_and_copies_stay_whole(spark):
    rows = [(i, "http://h.org/", f"<article><p>{BOILER}</p><p>w{i}</p></article>") for i in range(3)]
    rows += [(10 + i, "http://copies.org/", f"<p>{BOILER} and a bit more than that too</p>") for i in range(2)]
    got = answers(spark, rows)
    assert got[1]["text"] == f"{BOILER} w1" and got[1]["n_repeated"] > 0 and got[10]["text"] == got[11]["text"] == f"{BOILER} and a bit more than that too"


def test_large_hosts_are_split(spark, monkeypatch):
    monkeypatch.setattr(H, "PACK_BYTES", 8000)
    monkeypatch.setattr(H, "HOT_KEYS", 10**6)
    rows = [(i, "http://big.org/", f"<p>{BOILER}</p><p>{' '.join(f'w{i}x{k}' for k in range(40))}</p>") for i in range(60)]
    got = answers(spark, rows)
    assert len(got) == 60 and all(BOILER not in r["text"] for r in got.values())


def test_split_hosts_give_the_same(spark, monkeypatch):
    """Lines that two or three of a large host's pages share are found wherever the pages fall; equal pages count as one."""
    rng = random.Random(6)
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    shared = [" ".join(f"s{j}y{k}" for k in range(14)) for j in range(25)]
    rows = [(i, "http://big.org/", f"<p>{own(i)}</p><div>{shared[i % 25]}</div><p>{own(-i - 1)}</p>") for i in range(60)]
    rows += [(100 + i, "http://big.org/", f"<footer>{shared[3]}</footer><article><p>{own(200 + i % 3)} {shared[i % 5]}</article>") for i in range(9)]
    rows += [(200 + i, None, html) for i, (_, _, html) in enumerate(rng.sample(rows, 8))]
    whole = answers(spark, rows)
    assert all(whole[i]["n_repeated"] == 14 and len(whole[i]["text"].split()) == 120 for i in range(60))
    monkeypatch.setattr(H, "PACK_BYTES", 5000)
    assert answers(spark, rows) == whole
    # Chunks whose anchors meet in many tasks, and texts whose pages don't travel with them.
    monkeypatch.setattr(H, "BUCKET_CHUNKS", 2)
    monkeypatch.setattr(H, "COPIES", 1)
    assert answers(spark, rows) == whole


def test_templates_leave_marked_regions_and_quotes_stay(spark, monkeypatch):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    legal, quote = " ".join(f"l{k}" for k in range(20)), " ".join(f"q{k}" for k in range(20))
    # A wrapper that holds its template; a template that is marked as such on most pages; a line that few articles quote.
    rows = [(i, "http://wrapped.org/", f"<div id=content><div>{BOILER}</div><p>{own(i)}{' ' + quote if i < 3 else ''}</p></div>") for i in range(8)]
    rows += [(20 + i, "http://mixed.org/", f"<article><p>{own(i)}<div>{legal}</div></article>" if i < 2 else
              f"<article><p>{own(i)}</article><footer>{legal}</footer>") for i in range(8)]
    rows += [(40 + i, "http://advert.org/", f"<article><p>{own(i)}{' ' + quote if i < 3 else ''}</article><div class=ad>{quote if i == 7 else 'buy'}</div>")
             for i in range(8)]
    for bytes_ in (H.PACK_BYTES, 800):
        monkeypatch.setattr(H, "PACK_BYTES", bytes_)
        got = answers(spark, rows)
        assert all(got[i]["text"] == own(i) + (" " + quote if i < 3 else "") and got[i]["n_repeated"] >= 17 for i in range(8))
        assert all(got[20 + i]["text"] == own(i) for i in range(8)) and got[20]["n_repeated"] == 20
        assert all(got[40 + i]["text"] == own(i) + (" " + quote if i < 3 else "") for i in range(8))


def test_short_pages_lose_boilerplate_and_near_copies_stay(spark):
    notice = [" ".join(f"n{j}y{k}" for k in range(50)) for j in range(4)]
    rows = [(i, "http://h.org/", "".join(f"<div>{n}</div>" for n in notice[:2]) + f"<p>{' '.join(f'w{i}x{k}' for k in range(15 if i < 3 else 300))}</p>"
             + "".join(f"<div>{n}</div>" for n in notice[2:])) for i in range(6)]
    story = " ".join(f"s{k}" for k in range(400))
    rows += [(10, "http://h.org/", f"<p>{story} first print</p>"), (11, "http://h.org/", f"<p>{story.replace('s200 ', 'changed ')} again</p>")]
    got = answers(spark, rows)
    assert all(got[i]["text"] == " ".join(f"w{i}x{k}" for k in range(15 if i < 3 else 300)) and got[i]["n_repeated"] == 200 for i in range(6))
    assert got[10]["text"] == f"{story} first print" and got[11]["text"].endswith("s399 again") and got[11]["text"].startswith("s0 s1")


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (None, "http://a/", "<p>x"), (3, "not a url", "<p>y"), (1, None, None), (4, "http://a/", "<p>" + "long " * 50000)]
    got = rows_of(H.main_text(pages(spark, rows)))
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {(r["page_id"], r["text"]) for r in got} >= {(1, ""), (2, ""), (None, "x"), (3, "y")}
    assert H.main_text(pages(spark, [])).count() == 0


def test_every_article_of_the_test_tables(spark):
    """An article's body is the text of a document, word for word."""
    known = {" ".join(r.text.split()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        blocks, marked = H.read_page(r.html)
        assert marked and " ".join(blocks[1:]) in known


def test_anchors_of_equal_windows_are_equal_and_few():
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)]
    shared = [words[i] for i in rng.integers(0, 300, 40)]
    texts = [[words[i] for i in rng.integers(0, 300, 200)] + shared + [words[i] for i in rng.integers(0, 300, 50)] for _ in range(3)]
    w = [H.Windows([t]) for t in texts]
    of_hash = [dict(zip(zip(*(h.tolist() for h in x.hashes(7))), x.anchors(7).tolist())) for x in w]
    common = set(of_hash[0]) & set(of_hash[1]) & set(of_hash[2])
    assert len(common) == 40 - H.RUN + 1
    assert all(of_hash[0][h] == of_hash[1][h] == of_hash[2][h] for h in common)
    assert len(set(of_hash[0].values())) < 0.35 * len(of_hash[0])
    assert set(H._anchors_of(texts[:2], 7).tolist()) == set(of_hash[0].values()) | set(of_hash[1].values())


@pytest.mark.parametrize("seed", range(2))
def test_split_hosts_decide_as_a_brute_force_over_all_windows(spark, monkeypatch, seed):
    """Open pages: a token goes if a window over it is on two distinct texts or more, whatever chunk they are in."""
    monkeypatch.setattr(H, "PACK_BYTES", 1500)
    monkeypatch.setattr(H, "_is_copy", lambda *a: False)
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 400, n)]
    lines = [word(14) for _ in range(6)]
    texts = []
    for i in range(60):
        t = word(20)
        for j in rng.integers(0, 30, 2):
            t += (lines[j] if j < 6 else []) + word(8)
        texts.append(t)
    df = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{' '.join(t)}</p>") for i, t in enumerate(texts)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.main_text(df).collect()}
    on = {}
    for i, t in enumerate(texts):
        for a in range(len(t) - H.RUN + 1):
            on.setdefault(tuple(t[a:a + H.RUN]), set()).add(tuple(t))
    for i, t in enumerate(texts):
        gone = set()
        for a in range(len(t) - H.RUN + 1):
            if len(on[tuple(t[a:a + H.RUN])]) > 1:
                gone |= set(range(a, a + H.RUN))
        assert got[i] == " ".join(w for k, w in enumerate(t) if k not in gone), i


def test_anchors_travel_packed():
    rng = np.random.default_rng(8)
    for chunks, n in ((2, 5), (12, 200_000), (5000, 1), (3, 0)):
        leading = np.unique(H._leading(rng.integers(-2**63, 2**63 - 1, n), chunks))
        body = H._packed(leading)
        assert H._unpacked(body).tolist() == leading.tolist() and (n < 1000 or len(body) < 3 * n)


def test_all_of_a_large_hosts_copies_are_answered(spark, monkeypatch):
    """A third of the rows has one text; every row is answered, ids that repeat included, however few copies travel along."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(i if i % 7 else None, f"http://big.org/{i}", f"<p>{BOILER}</p><p>{own(i)}</p>") for i in range(40)]
    rows += [(i % 5, "http://big.org/copy", f"<p>{BOILER}</p><p>{own(999)}</p>") for i in range(20)]
    for copies in (1000, 3):
        monkeypatch.setattr(H, "PACK_BYTES", 1500)
        monkeypatch.setattr(H, "COPIES", copies)
        got = rows_of(H.main_text(pages(spark, rows)))
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
        assert sorted(((r["page_id"], r["url"], r["text"]) for r in got), key=key) == sorted(
            ((p, u, own(999) if u.endswith("copy") else own(int(u.rsplit("/", 1)[1]))) for p, u, _ in rows), key=key)

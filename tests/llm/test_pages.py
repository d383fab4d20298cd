import random
import re

import pytest

from panelgrain.llm import pages as P

SF = "/root/testdata/sf0.01"


def text_of(page):
    main, rest, _ = P.blocks(page)
    return "\n".join(main or rest)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("just  words\n here", "just words here"),
        ("<article><h1>A &amp; B</h1><p><b>x<br><p>y z</article><footer>f</footer>", "A & B\nx\ny z"),
        ("<nav><ul><li>m</ul><article><p>kept</p></article>", "kept"),
        ("<main><p>a</p><div class='ad-box'>buy<p>now</p></div><aside>s</aside><p>b<!-- c -->d</p></main>", "a\nbd"),
        ("<article><p>one</p><form><p>f</p></form><section id=reader-comments><article><p>nice!</p></article></section><p>two</p></article>", "one\ntwo"),
        ("<ARTICLE><P>caf&eacute;&nbsp;au&#32;lait &lt;b&gt;</P><SCRIPT>var a='</p>'</SCRIPT><style>p{}</style></ARTICLE>", "café au lait <b>"),
        ('<article><p title="a > b">q</p><p hidden>no</p><p style="display: none">no</p><p class="cookieNotice">no<p>yes</article>', "q\nyes"),
        ("<article>a<b>b</b>c <i>d</i><img alt='x'>e<hr>f</article><p>out</p>", "abc de\nf"),
        ("<div class=header>h</div><div class=download>stays</div>", "stays"),
        ("<article><header><h1>t</h1></header><table><tr><td>1<td>2</table></article>", "1\n2"),
        ("<article><script>never closed", ""),
        ("a < b and c > d", "a < b and c > d"),
    ],
)
def test_blocks(page, want):
    assert text_of(page) == want


def brute_repeated(streams, least_words, least_pages):
    where = {}
    for k, s in enumerate(streams):
        for i in range(len(s) - least_words + 1):
            where.setdefault(tuple(s[i : i + least_words]), set()).add(k)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - least_words + 1):
            if len(where[tuple(s[i : i + least_words])]) >= least_pages:
                mark[i : i + least_words] = [True] * least_words
        out.append(mark)
    return out


def test_repeated_equals_brute_force():
    r = random.Random(2)
    for _ in range(60):
        streams = [r.choices("abc", k=r.randint(0, 30)) for _ in range(r.randint(1, 8))]
        got = [m.tolist() for m in P.repeated(streams, 4, 3)]
        assert got == brute_repeated(streams, 4, 3)


def test_suffix_array():
    r = random.Random(6)
    for _ in range(40):
        word = [r.randrange(3) for _ in range(r.randint(1, 40))] + [-1]
        order, shared = P.suffix_array(P.np.array(word))
        assert [word[i:] for i in order] == sorted(word[i:] for i in range(len(word)))
        for a, b, n in zip(order[:-1], order[1:], shared[1:], strict=True):
            x, y = word[a:], word[b:]
            same = next((k for k, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))
            assert same == n


def plain(page):
    """The synthetic pages by hand: the article, split at its block tags."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = [re.sub(r"<[^>]+>", "", x) for x in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))]
    parts = [" ".join(P.html.unescape(x).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def test_table(spark):
    got = {r.page_id: r for r in P.op7(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == plain(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_host_votes_and_edges(spark, monkeypatch):
    boiler = "<div>Welcome to our very own site</div>", "<p>All rights are reserved by us since then</p>"
    rows = [(i, f"http://h.example/{i}", f"{boiler[0]}<p>Unique story number {i} told at length here</p>{boiler[1]}") for i in range(8)]
    rows += [(50, "http://other.example/", boiler[0]), (60, None, None), (61, "x", ""), (None, None, "<p>n</p>"), (50, "http://other.example/", boiler[0]), (70, "http://h.example", "<article>" + "w " * 99999 + "</article>")]
    frame = spark.createDataFrame([(*r, 1, "h") for r in rows], "page_id long, url string, html string, part long, host string").repartition(3)
    got = {(r.page_id, r.url): r for r in P.main_texts(frame).collect()}
    assert P.main_texts(frame).count() == len(rows)
    for i in range(8):
        assert got[i, f"http://h.example/{i}"].text == f"Unique story number {i} told at length here"
    assert got[50, "http://other.example/"].text == "Welcome to our very own site"
    assert got[60, None].text == "" and got[61, "x"].n_chars == 0 and got[None, None].text == "n"
    assert got[70, "http://h.example"].n_chars == 2 * 99999 - 1
    assert P.main_texts(frame.limit(0)).collect() == []


def test_repeats_count_over_the_whole_host(spark, monkeypatch):
    """A notice on 4 of a host's 60 pages goes however the host is split; groups only bound memory."""
    story = lambda i: f"a{i} b{i} c{i} d{i} e{i} f{i}"
    notice = "<div>Our office stays closed on Monday</div>"
    rows = [(i, f"http://h.example/{i}", f"<p>{story(i)}</p>{notice if i % 15 == 0 else ''}<nav>one two three four five</nav>") for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(tuple(r) for r in P.main_texts(frame).collect())
    monkeypatch.setattr(P, "GROUP", 6)
    split = sorted(tuple(r) for r in P.main_texts(frame).collect())
    assert split == whole
    assert [(r[0], r[2], r[4]) for r in split] == [(i, story(i), 5 + (6 if i % 15 == 0 else 0)) for i in range(60)]


@pytest.mark.parametrize("group", [512, 6])
def test_only_blocks_that_repeat_go(spark, monkeypatch, group):
    """Common phrases inside sentences stay, as do copies of one page; a block that repeats but for a word goes but for it."""
    monkeypatch.setattr(P, "GROUP", group)
    story = lambda i: f"At the end of the day s{i} t{i} u{i} v{i}"
    foot = "This site belongs to people who care about every reader"
    rows = [(i, f"http://h.example/{i}", f"<p>{story(i)}</p><div>{foot} v{i}</div>") for i in range(20)]
    copy = "A long read that three addresses serve word for word"
    rows += [(100 + i, f"http://h.example/copy{i}", f"<aside>advert {i}</aside><p>{copy}</p>") for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in P.main_texts(frame).collect()}
    assert got == {i: f"{story(i)}\nv{i}" for i in range(20)} | {100 + i: copy for i in range(9)}


def test_a_share_of_the_host_is_asked(spark, monkeypatch):
    """Three of a split host's 40 pages are too few where one page in 10 is asked, six are enough."""
    monkeypatch.setattr(P, "ONE_IN", 10)
    monkeypatch.setattr(P, "GROUP", 8)
    rows = [(i, f"http://h.example/{i}", f"<p>a{i} b{i}</p>" + ("<p>on three pages it stands</p>" if i < 3 else "<p>on many more pages it does</p>" if i < 9 else "")) for i in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"a{i} b{i}" + ("\non three pages it stands" if i < 3 else "") for i in range(40)}
    assert {r.page_id: r.text for r in P.main_texts(frame).collect()} == want


def test_a_large_hosts_repeats_come_from_suffix_arrays(monkeypatch):
    """The counting step of large hosts lists each page's five-word substrings from suffix arrays of one host's pages."""
    r = random.Random(9)
    pages = [[" ".join(r.choices("abc", k=r.randint(0, 12))) for _ in range(r.randint(0, 4))] for _ in range(40)]
    hosts = [r.choice("xyz") for _ in pages]
    sizes, whole = [], P.suffix_array
    monkeypatch.setattr(P, "suffix_array", lambda tokens: sizes.append(len(tokens)) or whole(tokens))
    batch = P.pa.RecordBatch.from_arrays([P.pa.array(hosts), P.pa.array(["".join(f"<p>{b}</p>" for b in p) for p in pages])], names=["host", "html"])
    (out,) = P._windows([batch])
    assert len(sizes) == 3
    for page, found in zip(pages, out.column(2).to_pylist(), strict=True):
        grams = {tuple(w[i : i + 5]) for b in page if (w := b.split()) for i in range(len(w) - 4)}
        want = {int(P.K.gram_hash(P.token_hashes(list(g)), 5).view(P.np.int64)[0]) for g in grams}
        assert set(found) == want and len(found) == len(want)

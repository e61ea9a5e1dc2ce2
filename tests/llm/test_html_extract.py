import pytest

from prefdata.llm import html_extract as H
from .data import prose

PAGES = "page_id long, url string, html string, text string, n_chars int, host string, part int"


def frame(spark, pages):
    return spark.createDataFrame([(i, u, h, "no", -1, "x", 9) for i, u, h in pages], PAGES)


@pytest.mark.parametrize(
    "html,want",
    [
        ("", []),
        ("just text &amp; more", ["just text & more"]),
        ("<article><h1>T</h1><p>a<br>b &lt;c&gt; &#233;\n x<p><b>y</b>z</article><footer>f</footer>", ["T", "a b <c> é x", "yz"]),
        ("<nav><ul><li>m</ul></nav><main><p>x<script>if (a<b) '</p>'</script>y</p><aside>s</aside></main>", ["xy"]),
        ("<article><header><h1>T</h1><p>by me</p></header><p>x<!-- c --></p><section id=comments><p>no</section></article>", ["T", "x"]),
        ("<body class='no-sidebar'><div role=navigation>n</div><div class='ad box'>a</div><form>f</form><p>x</p>", ["x"]),
        ("<article><p>cut here &am", ["cut here &am"]),
        ("<article><p>cut <a href='/x", ["cut"]),
        ("<article><p>one</p><div class=cookie-notice>no</div><div hidden>no</div><p>two", ["one", "two"]),
        ("<head><title>t</title><style>p{}</style><body><p>x", ["x"]),
        ("<article><p>a <i>b</i><span>c</span></p></article><article class=comment><p>no</article>", ["a bc"]),
    ],
)
def test_blocks(html, want):
    assert H.blocks(html)[0] == want


@pytest.mark.parametrize(
    "html,want",
    [
        ("<article><p>a<section id=discussion><h2>D</h2><p>b <a href=x>c</a></section><p>d</article>", ["a", "D", "b c", "d"]),
        ("<article><section class=related-work><p>a b</section><div class=notice><p>c</div></article>", ["a b", "c"]),
        ("<article><p>a<div class=related><p><a href=x>b c</a> d</div><div class=widget>e <input></div><p>f</article>", ["a", "f"]),
        ("<article><div class=ad-slot>a</div><div class='comment-list'>b</div><p>c</article>", ["c"]),
        ("<article><pre>f() <span class='token comment'># g</span></pre></article>", ["f() # g"]),
        ("<article class=post data-comment-count=3><p>a</article>", ["a"]),
        ("<main><p>long text of a page</p><article>teaser</article></main>", ["long text of a page", "teaser"]),
        ("<main><p>by me</p><article><p>a long text of a page</article></main>", ["a long text of a page"]),
        ("<div><div>long text</div><div>of a page</div></div><article>card</article>", ["long text", "of a page", "card"]),
        ("<div><a href=/a>much of a menu in links</a></div><article>short</article>", ["short"]),
    ],
)
def test_names_do_not_take_text_away(html, want):
    assert H.blocks(html)[0] == want


def test_templates_go_where_an_article_is_only_a_card(spark):
    pages = [(k, u, f"{h}<article>{prose(2000 + k, 20)}</article>") for k, u, h in map(soup, range(5))]
    got = {r["page_id"]: r["text"] for r in H.extract(frame(spark, pages)).collect()}
    assert got == {k: f"{prose(k, 60)}\n\n{prose(1000 + k, 40)}\n\n{prose(2000 + k, 20)}" for k in range(5)}


def soup(k, host="http://site.example/a"):
    """A page without any names: its template repeats, its prose does not."""
    menu = "<div>Home page of our site with news and all about us and contact</div>"
    end = "<div>All rights reserved by the owners of this site since two thousand and one</div>"
    return k, f"{host}/{k}", f"<body>{menu}<div>{prose(k, 60)}</div><div>{prose(1000 + k, 40)}</div>{end}"


@pytest.mark.parametrize("part_tokens", [500_000, 200])
def test_templates_of_a_host_go(spark, monkeypatch, part_tokens):
    # With small parts the pages of a host are in many tasks.
    monkeypatch.setattr(H, "PART_TOKENS", part_tokens)
    pages = [soup(k) for k in range(12)] + [(50, "http://other.example/", soup(3)[2])] * 5
    got = sorted((r["page_id"], r["text"]) for r in H.extract(frame(spark, pages)).collect())
    want = [(k, f"{prose(k, 60)}\n\n{prose(1000 + k, 40)}") for k in range(12)]
    assert got[:12] == want
    # Repeated rows are one page of their host: nothing there repeats.
    assert len({t for _, t in got[12:]}) == 1 and got[12][1].startswith("Home page")


def test_runs_equal_comparing_all_windows():
    pages = [soup(k)[2].replace("<div>", "\n").split("\n") for k in range(4)]
    name, inside, page, _ = H.runs(pages)
    tokens, _, _ = H._stream(pages)
    windows = {}
    for at in range(len(tokens)):
        if inside[at]:
            windows.setdefault(tokens[at : at + H.RUN].tobytes(), set()).add(int(name[at]))
    assert all(len(names) == 1 for names in windows.values())
    assert len({next(iter(n)) for n in windows.values()}) == len(windows)


def test_defined_cases(spark):
    pages = [(0, None, None), (1, "x", ""), (None, "http://a/b", "<p>text</p>"), (2, "x", "<article>a b</article>")]
    pages += [(2, "x", "<article>a b</article>"), (3, "x", f"<article><p>{prose(1, 30000)}</article>")]
    docs = frame(spark, pages)
    got = H.extract(docs).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sorted(r["text"] for r in got if r["page_id"] != 3) == ["", "", "a b", "a b", "text"]
    assert {r["page_id"]: r["text"] for r in got}[3] == prose(1, 30000)
    assert {r["page_id"]: r["text"] for r in got}[0] == ""
    assert H.extract(docs.limit(0)).count() == 0


def test_hosts():
    assert H.host_of("https://User@Www.Example.com:80/a?b") == "www.example.com"
    assert H.host_of("//x.y/z") == "x.y" and H.host_of(None) == "" and H.host_of("/path") == ""


@pytest.mark.parametrize(
    "html, want",
    [
        # In an unquoted value a quote is a letter; a quoted value can hold the end of a tag.
        ("<p>One.</p><p data-x=it's>Two.</p><p>Three isn't lost.</p><p>Four.</p>", ["One.", "Two.", "Three isn't lost.", "Four."]),
        ("<p a='x>y' b = \"q'z>\" c>kept</p>", ["kept"]),
        ("<p data-x=it's>A short text, all between two apostrophes isn't lost.</p>", ["A short text, all between two apostrophes isn't lost."]),
        # A form around the page is a frame, one in it is a form.
        (
            "<body><form id=aspnetForm action=x><input type=hidden><nav><a href=1>m</a></nav><article><h1>T</h1>"
            "<p>The text.</p></article><footer>f</footer></form></body>",
            ["T", "The text."],
        ),
        (f"<form><p>{'word ' * 30}</p><p>{'more ' * 30}</p></form>", [("word " * 30).strip(), ("more " * 30).strip()]),
        (
            f"<form class=search><p>{'word ' * 40}</p><p>{'more ' * 40}</p></form><p>{'text ' * 20}</p>",
            [("text " * 20).strip()],
        ),
        (
            "<article><p>Text of the article.</p><form><label>Name</label><input><button>Go</button></form></article>",
            ["Text of the article."],
        ),
        # Names of chrome on what holds an article's paragraphs.
        (
            "<article><h1>T</h1><div class=header><p>A paragraph that counts.</p></div><p id=cookie>On cookies.</p></article>",
            ["T", "A paragraph that counts.", "On cookies."],
        ),
    ],
)
def test_text_that_markup_makes_doubtful(html, want):
    assert H.blocks(html)[0] == want


def test_a_hot_page_is_one_row_for_the_suffix_array(spark):
    """Copies of a page get the text of the one that was looked at."""
    template = "always the same words of the site in front of it"
    pages = [f"<div>{template}</div><div>{prose(k, 30)}</div>" for k in range(6)] + [f"<div>{template}</div><div>{prose(99, 30)}</div>"] * 60
    rows = [(i, f"http://h.org/{i}", html) for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in H.op8_html(df).collect()}
    assert got == {i: prose(i if i < 6 else 99, 30) for i in range(66)}


def test_every_page_goes_through_the_suffix_array(spark, monkeypatch):
    """Pages with a named article too: what repeats there stays, but not in an element whose name is in doubt."""
    same, notice = prose(500, 20), prose(501, 20)
    html = "<article><p>{own}</p><p>{same}</p><div class=notice><p>{notice}</p></div></article>"
    pages = [(k, f"http://h/{k}", html.format(own=prose(k, 40), same=same, notice=notice)) for k in range(6)]
    pages += [(9, "http://h/9", html.format(own=prose(9, 40), same=prose(502, 20), notice=prose(503, 20)))]
    # The site's words around a short article are longer than it, but every page has them.
    around = f"<div>{prose(504, 60)}</div>"
    pages += [(20 + k, f"http://g/{k}", f"{around}<div>by name {k}</div><article><p>{prose(20 + k, 30)}</article>") for k in range(4)]
    want = {k: (f"{prose(k, 40)}\n\n{same}", 2) for k in range(6)}
    want[9] = (f"{prose(9, 40)}\n\n{prose(502, 20)}\n\n{prose(503, 20)}", 0)
    want.update({20 + k: (prose(20 + k, 30), 1) for k in range(4)})
    for part_tokens in (500_000, 100):
        monkeypatch.setattr(H, "PART_TOKENS", part_tokens)
        got = {r["page_id"]: (r["text"], r["n_repeated"]) for r in H.extract(frame(spark, pages)).collect()}
        assert got == want


def test_texts_are_not_shuffled(spark, plan_of):
    """Pages stay where they were parsed; what is sent is the runs that are boilerplate."""
    plan = plan_of(H.extract(frame(spark, [soup(k) for k in range(6)])))
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    sent = plan[plan.index("Exchange") :].splitlines()[1]
    assert "runs" in sent and "text" not in sent and "marks" not in sent


@pytest.mark.parametrize("bits,shard,part", [(1, 2_000_000, 1_000_000), (3, 40, 150), (27, 40, 60)])
def test_few_bits_of_a_run_decide_nothing(spark, monkeypatch, bits, shard, part):
    """Other runs with the same bits are told apart by their whole hashes; parts and shards don't matter."""
    monkeypatch.setattr(H, "SHORT_BITS", bits)
    monkeypatch.setattr(H, "SHARD_RUNS", shard)
    monkeypatch.setattr(H, "PART_TOKENS", part)
    template = prose(700, 12)
    # A page twice in a part and in others; two pages of another host, which are too few.
    htmls = [f"<div>{template}</div><div>{prose(k, 30)}</div>" for k in (0, 1, 2, 2, 3, 2, 2)]
    rows = [(k, f"http://h.org/{k}", html) for k, html in enumerate(htmls)]
    rows += [(10 + k, f"http://i.org/{k}", f"<div>{template}</div><div>{prose(k % 2, 30)}</div>") for k in range(6)]
    got = {r["page_id"]: (r["text"], r["n_repeated"]) for r in H.extract(frame(spark, rows).repartition(3)).collect()}
    want = {k: (prose(j, 30), 1) for k, j in enumerate((0, 1, 2, 2, 3, 2, 2))}
    want.update({10 + k: (f"{template}\n\n{prose(k % 2, 30)}", 0) for k in range(6)})
    assert got == want


def test_large_ids_beside_none(spark):
    rows = [(None, "http://a/1", "<p>one"), (2**62 + 1, "http://a/2", "<p>two"), (-(2**62) - 1, "http://a/3", "")]
    got = sorted((r["text"], r["page_id"]) for r in H.extract(frame(spark, rows).coalesce(1)).collect())
    assert got == [("", -(2**62) - 1), ("one", None), ("two", 2**62 + 1)]

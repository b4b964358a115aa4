from strata.llm import extraction as ex


def text(page, noisy=()):
    return ex._text(ex.parse(page)[0], 0, set(noisy))


def test_main_text_without_the_rest():
    page = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>";</script></head>
    <body class="page"><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav><div class="ad">Buy <b>now</b></div>
    <div id="cookie-notice">We use cookies</div><article><header><h1>Head&nbsp;line</h1></header><p>One <b>bold</b>
      and&#32;<i>two</i> &lt;tag&gt; &copy;<br>next</p><p>Second<!-- hidden --> part<p>Third
    <script>evil()</script><ul><li>a<li>b</ul><aside>Related</aside><form><input value=x>Sign up</form>
    <table><tr><td>c1<td>c2</table><div class="comments"><p>first!</p></div></article><footer>(c) us</footer></body></html>"""
    assert text(page) == "Head line\nOne bold and two <tag> © next\nSecond part\nThird\na\nb\nc1\nc2"


def test_malformed_and_empty():
    assert text("") == "" and text("   ") == "" and text("plain text") == "plain text"
    assert text("<p>a<p>b</div></b><b>c") == "a\nbc"
    assert text("<article><p>cut &am") == "cut &am" and text("<p>x<a href='un") == "x"
    assert text("<p>1 < 2 and 3 > 2</p><!-- open") == "1 < 2 and 3 > 2"
    assert text("<div>" * 3000 + "deep") == "deep"
    assert text("<article><p><b>one<br><p>two</p></article>") == "one\ntwo"
    assert text("<script>never closed <p>x") == ""


def page(i, extra=""):
    return (f"<html><body><div class='top'>Welcome to the site</div><div class='story'><p>Story {i} tells thing {i * 7}.</p>"
            f"<p>More of {i}.</p></div><div class='box{extra}'>Our partners</div></body></html>")


def test_style_tree_removes_repeated_branches(spark):
    rows = [(i, f"http://one.example.com/{i}", page(i)) for i in range(30)]
    rows += [(100 + i, f"http://few{i}.example.com/", page(100 + i)) for i in range(4)]      # judged by all hosts
    rows += [(200 + i, "http://copies.example.com/", page(7)) for i in range(20)]            # nothing would be left
    rows += [(300, None, None), (301, "http://[bad", ""), (302, None, "<p>x</p>"), (0, "http://one.example.com/0", page(0))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as noise", "'k' as host")
    got = ex.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = {r.page_id: r for r in got.collect()}
    assert got.count() == len(rows) and all(r.n_chars == len(r.text) for r in out.values())
    for i in [*range(30), *range(100, 104)]:
        assert out[i].text == f"Story {i} tells thing {i * 7}.\nMore of {i}."
    assert "Story 7" in out[200].text and out[300].text == "" and out[301].text == "" and out[302].text == "x"


def test_nodes_by_join_as_by_broadcast(spark, small_dir, monkeypatch):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    sent = sorted(map(tuple, ex.extract(pages).collect()))
    monkeypatch.setattr(ex, "NOISE_ROWS", 0)
    assert sorted(map(tuple, ex.extract(pages).collect())) == sent


def test_pages_match_their_documents(spark, small_dir):
    docs = {" ".join(r.text.split()) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = ex.extract(spark.read.parquet(f"{small_dir}/pages.parquet")).collect()
    assert sum(" ".join(r.text.split("\n", 1)[1].split()) in docs for r in got) >= 0.95 * len(got)


def test_no_pages(spark):
    assert ex.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"http://deep.example.com/{i}", p) for i, p in enumerate(pages)],
                               "page_id long, url string, html string")
    return {r.page_id: r.text for r in ex.extract(df).collect()}


def test_content_nested_deep_is_kept(spark):
    shapes = ["<article><h1>Head {i}</h1><div class='body'><section><p>Text {i}.</p></section></div></article>",
              "<h1>Head {i}</h1><div><ul><li><p>Text {i}.</p></li></ul></div>",
              "<h1>Head {i}</h1><div class='wrap'><table><tr><td>Text {i}.</td></tr></table></div>",
              "<h1>Head {i}</h1><div><blockquote><div><div><p>Text {i}.</p></div></div></blockquote></div>"]
    for shape in shapes:
        got = extracted(spark, [f"<html><body>{shape.format(i=i)}<div class='low'><div><div><p>Our partners</p></div></div>"
                                "</div></body></html>" for i in range(12)])
        want = "Head {i}\nText {i}."
        assert got == {i: want.format(i=i) for i in range(12)}, shape


def test_a_box_with_important_boxes_inside_is_kept(spark):
    rest = "".join(f"<div class='r{k}'><div><p>Line {k} of every page</p></div></div>" for k in range(60))
    got = extracted(spark, [f"<body><div class='wrap'><div class='in'><div><p>Text {i}.</p></div></div>{rest}</div></body>"
                            for i in range(12)])
    assert got == {i: f"Text {i}." for i in range(12)}


def test_deep_pages_are_counted_in_pieces():
    import pyarrow as pa
    page = "".join(f"<div>text {i}" for i in range(600))
    rows = [r for b in ex._stats_task([pa.RecordBatch.from_pydict({"url": ["http://a.b/"], "html": [page]})])
            for r in b.to_pylist()]
    steps = {ex._AROUND + k: 600 - (1 << k) for k in range(10) if 600 > 1 << k}
    for kind, want in ((0, 600 * 601 // 2), (1, 600), (2, 600), *steps.items()):
        got = [tuple(r.values()) for r in rows if r["kind"] == kind]
        assert len(got) == len(set(got)) == want, kind
    assert max(r["kind"] for r in rows) == max(steps)


def test_memory_does_not_grow_with_the_square_of_the_depth():
    import subprocess
    import sys
    code = ("import resource, pyarrow as pa; from strata.llm import extraction as ex; "
            "p = '<div>' * 30000 + 'deep'; base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; "
            "n = sum(b.num_rows for b in ex._stats_task([pa.RecordBatch.from_pydict({'url': ['http://a.b/'], 'html': [p]})])); "
            "assert ex._text(ex.parse(p)[0], 0, set()) == 'deep'; "
            "print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(__import__("pathlib").Path(ex.__file__).parents[2]))
    rows, mb = map(int, out.stdout.split())
    assert rows < 30_000 * 20 and mb < 300


def test_quotes_inside_unquoted_values():
    assert text("<p data-t=it's>First.</p><p data-t=it's>Second.</p>") == "First.\nSecond."
    assert text("<p title='a > b' data-x=\"1 > 0\">One.</p><p x=\"'\" y=a\"b>Two.</p>") == "One.\nTwo."
    assert text("<p class = ad >x</p><p a='unclosed>Gone? </p><p>Next.</p>") != ""
    assert text("<div class=ad>Buy</div><p a==b c= d='e f'/ g>Text.</p>") == "Text."
    long = "<p " + "a " * 50_000 + "'" * 50_000 + ">Text.</p>"       # no backtracking
    assert text(long) == "Text."


def test_formulas_stay_in_their_sentence():
    assert text("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then stop.</p>") == "If x=2 then stop."


def test_tools_inside_an_article_go_unless_they_hold_running_text():
    body = "We searched every archive of the region for letters that mention the flood of that year."
    got = text(f"<article><p>Start.</p><div class='search'><p>{body}</p></div><ul class='related'><li>One</li><li>Two</li></ul>"
               f"<div class='share'>Share this</div><div class='comments'><p>{body}</p></div><div class='cookie-notice'><p>{body}</p>"
               "</div><p>End.</p></article>")
    assert got == f"Start.\n{body}\nEnd."


def test_repeated_lines_of_an_article_go(spark):
    long = "This long paragraph opens each page of the host, but it is a text of more than a dozen words."
    got = extracted(spark, [f"<article><h1>Head {i}</h1><p>{long}</p><p class='x9'>Read our other pages</p><p>Text {i}.</p>"
                            + ("<p>Sometimes.</p>" if i % 2 else "") + "</article>" for i in range(30)])
    assert got == {i: f"Head {i}\n{long}\nText {i}." + ("\nSometimes." if i % 2 else "") for i in range(30)}


def test_wrappers_named_like_noise_keep_the_text():
    inner = "<article><h1>Head</h1><p>Text of the page.</p></article><div class='sidebar'>Links</div>"
    for name in ("class='layout with-sidebar'", "id='page' class='has-banner'", "class='sidebar-layout'"):
        assert text(f"<body><div {name}>{inner}</div><div class='related'><article>Other</article></div></body>") == \
            "Head\nText of the page.", name
    assert text(f"<div class='search'>{inner}</div>") == "Head\nText of the page."
    plain = "<h1>Head</h1><div class='{}'><p>Text of the page, long enough.</p><div class='share-box'>Share</div></div>"
    for name in ("layout with-sidebar", "sidebar-layout", "nav-open"):
        assert text(plain.format(name)) == "Head\nText of the page, long enough.", name
    assert text(plain.format("sidebar")) == "Head"
    assert text("<div class='notice'><p>All there is</p><div class='ad'>Buy</div></div>") == "All there is"
    assert text("<article class='post comments-open'><p>Text</p></article><article class='comment'>first</article>") == "Text"


def test_headings_and_running_text_in_the_main_element_keep_their_names():
    assert text("<article><h2 id='related-work'>Related work</h2><section id='discussion'><p>We discuss.</p></section>"
                "<p class='reply'>He replied <em class='form'>so</em>.</p><section class='comments'><p>first!</p></section>"
                "<div class='share-buttons'>Share</div><div class='ad'>Buy</div><ul class='pagination'><li>2</li></ul>"
                "<p>End.</p></article>") == "Related work\nWe discuss.\nHe replied so.\nEnd."

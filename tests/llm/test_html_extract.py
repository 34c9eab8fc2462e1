from revstrata.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now, cheap, good.</div>
<article><h1>A title &amp; more</h1><p><b>First paragraph, with text.</b> It   goes
on &lt;here&gt;.<br><p>Second, unclosed paragraph. It is long enough, too.<form><p>Your name</p><input></form>
<aside>See also.</aside><p>Last.</p></article><section id="comments"><p>First! A long comment, with commas, and more text than the article has. It goes on and on.</p></section>
<div class="cookie-notice">We use cookies.</div><footer>&copy; Site</footer></body></html>"""


def test_article_only():
    assert H.main_text(PAGE) == "A title & more\n\nFirst paragraph, with text. It goes on <here>.\n\nSecond, unclosed paragraph. It is long enough, too.\n\nLast."


def test_no_article_element():
    page = PAGE.replace("<article>", '<div id="content">').replace("</article>", "</div>")
    assert "Second, unclosed paragraph." in H.main_text(page) and "comment" not in H.main_text(page) and "Home" not in H.main_text(page)


def test_defined_results():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p></p>") == ""
    assert H.main_text("plain") == "plain" and H.main_text("a < b") == "a < b" and H.main_text('<p>a<b title="x') == "a"
    assert H.main_text("<p>" * 3000 + "deep" + "</p>" * 10) == "deep"
    assert H.main_text("<article><p>" + "word, " * 50_000 + "</p></article>").startswith("word, word")
    assert H.main_text("<" * 20_000 + "1") == "<" * 20_000 + "1"


def test_query_columns(spark):
    rows = spark.createDataFrame([(1, PAGE, "t"), (1, PAGE, "t"), (2, None, None)], "page_id long, html string, text string")
    got = H.extract(rows).collect()
    assert [r.text == "" for r in sorted(got, key=lambda r: r.page_id)] == [False, False, True]
    assert H.extract(rows.limit(0)).isEmpty()


BODY = "<p>A first paragraph, long enough, with a comma or two.</p><p>And a second one, which says more, at length.</p>"


def test_names_do_not_discard_the_article():
    for names in ("site-content has-sidebar", "layout no-sidebar", "post comments-open", "main-with-nav", "content-sidebar-wrap", "widget"):
        got = H.main_text(f'<body><nav>Home</nav><div class="{names}">{BODY}</div><div class="widget">Tags</div></body>')
        assert "A first paragraph" in got and "second one" in got and "Home" not in got and "Tags" not in got, names
        assert "second one" in H.main_text(f'<body><article class="{names}">{BODY}</article></body>')
    assert "second one" in H.main_text(f"<body><form action='/'>{BODY}</form></body>")
    assert "second one" in H.main_text("<body>" + "".join(f'<div class="elementor-widget">{x}</p></div>' for x in BODY.split("</p>")[:-1]) + "</body>")
    assert H.main_text(f'<body><div class="ad">{BODY}</div><article><p>A short article.</p></article></body>') == "A short article."


def test_selected_text_outside_the_container_stays():
    lead = "<div><p>A lead paragraph, which stands in its own element, before the body.</p></div>"
    body = "<div>" + BODY * 4 + "</div>"
    got = H.main_text(f"<body><nav>Home</nav>{lead}{body}<div class='ad'>Buy.</div></body>")
    assert got.startswith("A lead paragraph") and got.count("second one") == 4 and "Home" not in got and "Buy" not in got
    got = H.main_text(f"<body><article>{BODY * 2}</article><section><h2>Part two</h2>{BODY}</section><p>Last, but not least, a paragraph alone.</p></body>")
    assert got.count("second one") == 3 and "Part two" in got and got.endswith("a paragraph alone.")


def test_unclosed_embedded_elements():
    for tag in sorted(H.EMBEDDED):
        for page in (f"<body><div><{tag}><g>x</g></div><div>{BODY}</div></body>", f"<body><{tag} a='b'>fallback{BODY}<p>More <{tag}>y</p>{BODY}</body>"):
            got = H.main_text(page)
            assert got.endswith("at length.") and "A first paragraph" in got and "fallback" not in got and "x" not in got.split(), tag


def test_nesting_is_linear():
    import time

    began = time.time()
    got = H.main_text("<div>word, " * 90_000)  # 1 MB
    assert got.count("word,") == 90_000 and time.time() - began < 20


def test_path_scores_against_a_loop():
    import numpy as np

    rnd = np.random.default_rng(5)
    for n in (1, 4, 5, 40):
        paths, lengths, marks = rnd.integers(0, 5, n).tolist(), rnd.integers(0, 90, n).astype(float), rnd.integers(0, 9, n).astype(float)
        of = lambda k, x: sum(x[j] for j in range(n) if paths[j] == paths[k]) / paths.count(paths[k])
        fused = [(of(k, lengths) * (1 + of(k, marks))) ** 0.5 for k in range(n)]
        want = []
        for k in range(n):
            near = [(j, np.exp(-0.5 * (j - k) ** 2)) for j in range(max(0, k - 2), min(n, k + 3))] if n >= 5 else [(k, 1.0)]
            weight = sum(w * lengths[j] for j, w in near)
            want.append(sum(w * lengths[j] * fused[j] for j, w in near) / weight if weight > 0 else 0.0)
        assert np.allclose(H.path_scores(paths, lengths, marks), want)


main_text = H.main_text
STORY = "".join(f"<p>This is sentence {k} of the story, long enough, with commas, and a full stop at its end.</p>" for k in range(4))


def test_what_readers_wrote():
    talk = "".join(f"<li><b>Reader {k}</b> <i>2024-01-0{k + 1}</i><p>I think, as ever, that this is {k} times better than before, really!</p></li>" for k in range(9))
    plain = main_text(f"<body><article>{STORY}</article></body>")
    for comments in (
        f"<section><h2>Comments</h2><ol>{talk}</ol></section>",
        f"<section><h3>9 Responses</h3><ol>{talk}</ol></section>",
        f"<div><h2>Comments (9)</h2><ul>{talk}</ul></div>",
        f"<div class=comments>{talk}</div>",
        f"<h2>Leave a reply</h2><ol>{talk}</ol>",
    ):
        assert main_text(f"<body><article>{STORY}</article>{comments}</body>") == plain, comments
        assert main_text(f"<body><div>{STORY}{comments}</div></body>") == plain, comments
    after = main_text(f"<body><article>{STORY}<h3>Comments</h3><p>Short, but said.</p><h2>Part two</h2><p>And on it goes, in length, with commas.</p></article></body>")
    assert "said" not in after and after.endswith("Part two\n\nAnd on it goes, in length, with commas.")
    kept = main_text(f"<body><article><h2>Comments on the treaty</h2>{STORY}</article></body>")
    assert kept.startswith("Comments on the treaty") and "sentence 3" in kept


def test_names_of_paragraphs_formulas_and_cookies():
    page = f"<body><article>{STORY}<p class='reply'>He gave a reply that is part of the story, and was long.</p><p class='social'>Social history, too, is told in this part.</p></article></body>"
    assert "He gave a reply" in main_text(page) and "Social history" in main_text(page)
    assert "Buy now" not in main_text(f"<body><article>{STORY}<p class='ad'>Buy now, buy more!</p></article></body>")
    assert "E = m c2 holds" in main_text(f"<body><article>{STORY}<p><math><mi>E</mi> <mo>=</mo> <mi>m</mi> <mi>c</mi><mn>2</mn><annotation>E=mc^2</annotation></math> holds.</p></article></body>")
    assert "cookies" not in main_text(f"<body><div><p>We use cookies to make this site better.</p>{STORY}</div></body>")

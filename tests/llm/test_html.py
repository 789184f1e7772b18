import random

import numpy as np
import pytest

from rowmill.llm import html_extraction as hx
from rowmill.llm.html_blocks import blocks

from helpers import save, words


def page(rng, k, extra=""):
    body = [" ".join(words(rng, rng.randrange(4, 60))) + " &amp; more." for _ in range(rng.randrange(1, 9))]
    title = " ".join(words(rng, 5))
    shown = "".join(f"<p>{b}</p>" if rng.random() < 0.8 else f"<p><b>{b}<br>" for b in body)
    html = (
        f"<!DOCTYPE html><html lang='en'><head><title>{title}</title><style>p{{}}</style><script>var t='</p>'</script></head><body><nav><ul>"
        + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(rng, 6)) + f"</ul></nav><!-- ad {k} --><div class=\"ad\">{' '.join(words(rng, 8))}.</div>"
        f"<article><h1>{title}</h1>{shown}</article>{extra}<footer>&copy; {' '.join(words(rng, 7))}.</footer>" + ("</body></html>" if rng.random() < 0.8 else "")
    )
    return html, "\n".join([title, *(b.replace("&amp;", "&") for b in body)])


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    return [page(rng, k) for k in range(80)]


def test_blocks_of_broken_markup():
    source = "x<p>a &lt;b&gt;\n\n c<p>d<b>e<br>f</i></p></div>g<script>h</p></script><td>i<!-- j --><li>k<li><a href='>'>l</a> m<script>n"
    assert [b.text for b in blocks(source)] == ["x", "a <b> c", "de f", "g", "i", "k", "l m"]
    assert [b.path for b in blocks("<main id='top'><div class='a b-c'><p>x</main>y")] == [("main", ".top", "div", ".a", ".b", ".c", "p"), ()]
    assert blocks("") == [] and blocks("<!-- never ends <p>x") == [] and [b.text for b in blocks("a < b <")] == ["a < b <"]


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, real = hx._padded([rng.normal(size=(n, hx.INPUT)) for n in (3, 5)])
    model, d = hx.Labeller.fresh(), rng.normal(size=(5, 2, hx.HIDDEN))
    d[~real] = 0
    _, tape = hx._read(model.ahead, x, real, True)
    grad = hx._unread(model.ahead, x, real, tape, d)
    for i, j in [(0, 0), (10, 20), (hx.INPUT + 2, 50), (-1, 5)]:
        e = np.zeros_like(model.ahead)
        e[i, j] = 1e-5
        rise = sum((s * d * (hx._read(model.ahead + s * e, x, real)[0])).sum() for s in (1, -1)) / 2e-5
        assert grad[i, j] == pytest.approx(rise, rel=1e-4, abs=1e-7)


def test_padding_and_batches_do_not_change_labels(monkeypatch, pages):
    model = hx.Labeller.fresh()
    given = [hx.vectors(blocks(h)) for h, _ in pages] + [hx.vectors([])]
    alone = [hx.label_pages(model, [p])[0] for p in given]
    monkeypatch.setattr(hx, "CELLS", 50)
    for a, b in zip(alone, hx.label_pages(model, given)):
        assert a == pytest.approx(b)


def test_op1_extracts_the_article(spark, tmp_path, pages):
    rng = random.Random(9)
    comments = "<section class='comments'><div class='comment'><p>" + " ".join(words(rng, 20)) + ".</p></div></section><aside><p>" + " ".join(words(rng, 9)) + "</p></aside>"
    more = [page(rng, k, comments) for k in range(20)] + [(None, ""), ("", ""), ("<nav>only a menu</nav>", "")]
    given = pages + more + pages[:2]
    ids = [*range(len(given) - 1), None]
    rows = [(i, f"http://e/{i}", h, "t", 0) for i, (h, _) in zip(ids, given)]
    save(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int"), tmp_path, "pages")
    got = {str(r.page_id): r for r in hx.extracted_pages(spark, str(tmp_path)).collect()}
    assert len(got) == len(given)
    wrong = [i for i, (_, t) in zip(ids, given) if got[str(i)].text != t or got[str(i)].n_chars != len(t)]
    assert not wrong, wrong


def test_long_page_and_empty_table(spark, tmp_path):
    schema = "page_id bigint, url string, html string"
    long = "<article>" + "".join(f"<p>Line {k} of this text.</p>" for k in range(5000)) + "</article>"
    save(spark.createDataFrame([(1, "u", long)], schema), tmp_path, "pages")
    assert hx.extracted_pages(spark, str(tmp_path)).first().text.count("\n") == 4999
    save(spark.createDataFrame([], schema), tmp_path, "pages")
    assert hx.extracted_pages(spark, str(tmp_path)).count() == 0


def test_head_without_end_tag():
    head = "<!DOCTYPE html><html><head><meta charset=utf-8><title>T <b></title><style>p{}</style><link rel=x>"
    for source in (head + "<body><article><p>One<p>Two", head + "<article><p>One</p><p>Two</p></article>", head + "</head><body><p>One<p>Two</body>"):
        assert [b.text for b in blocks(source)] == ["One", "Two"], source
    assert [b.text for b in blocks(head + "Loose words<p>Two")] == ["Loose words", "Two"]
    assert [b.text for b in blocks("<title>T</title><p>One")] == ["One"]


def test_svg_without_end_tag():
    for svg in ("<svg/>", "<svg class='a>b' />", "<svg><path d='M0'/></svg>", "<svg><text>t</text><svg/><svg></svg><text>u</text></svg>", "<svg><path d='M0'>",
                "<svg><foreignObject><p>t</p></foreignObject></svg>", "<svg><title>t</title><a>u</a></svg>"):
        assert [b.text for b in blocks(f"<article><p>One {svg}</p><p>Two</p></article><p>Three")] == ["One", "Two", "Three"], svg
    assert [b.text for b in blocks("<div><a href=x><svg><path></a> One</div>Two<svg>lost")] == ["One", "Two"]


def test_op1_reads_pages_with_open_heads_and_pictures(spark, tmp_path, pages):
    given = [(h.replace("</head>", "").replace("</h1>", "</h1><svg class='icon'/>"), t) for h, t in pages]
    save(spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(given)], "page_id bigint, url string, html string"), tmp_path, "pages")
    got = {r.page_id: r.text for r in hx.extracted_pages(spark, str(tmp_path)).collect()}
    assert got == {i: t for i, (_, t) in enumerate(given)}


def test_sample_of_a_huge_table_is_not_empty(spark, monkeypatch, pages):
    rows = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)] + [(-1, None)], "page_id bigint, html string")
    monkeypatch.setattr(type(rows), "count", lambda self: 10**12)
    monkeypatch.setattr(hx, "fit", lambda given, labels: (len(given), len(labels)))
    assert hx.train(rows)[0] >= 3 * len(pages)
    assert hx.train(rows.where("html is null")) is None


def test_small_shares_are_kept(spark):
    rows = spark.range(20_000_000).selectExpr("id as page_id", "'x' as html")
    assert 100 < rows.where(hx.chosen("page_id", "html", 9e-6)).count() < 270
    assert 2 <= rows.where(hx.chosen("page_id", "html", 5e-7)).count() < 30
    assert rows.limit(1000).where(hx.chosen("page_id", "html", 1.0)).count() == 1000


def test_pages_with_text_need_a_labeller():
    assert hx.texts(None, ["", "<p> </p>"]) == ["", ""]
    with pytest.raises(ValueError):
        hx.texts(None, ["<p>x"])


def shown(source):
    return [b.text for b in blocks(source)]


def test_quotes_comments_and_nested_hidden_elements():
    assert shown("<p title=don't>Hello it's me</p><p>World it's</p>") == ["Hello it's me", "World it's"]
    assert shown("<p title=don't>Hello") == ["Hello"] and shown('<p class="a"">Hello</p>') == ["Hello"]
    assert shown('<p a = "x>y" b=\'>\' c= d/ e=>Hello</p >there') == ["Hello", "there"]
    assert shown("<p>a<!-->b<!--->c<!-- x > --!>d<!-- -->e<!---->f") == ["abcdef"]
    assert shown("<template><template>in</template>out</template>a<object><p>x<object>y</object>z</object>b") == ["ab"]
    assert shown("a<![CDATA[x > y ]]>b<!bogus>c<?php x ?>d</>e</ x>f</") == ["abcdef</"]
    assert shown("<select><option>x</select>a<textarea><p></textarea>b<title>t</title>c<xmp><p>x</xmp>d") == ["abcd"]
    assert shown("a<p class='x") == ["a"] and shown("<![CDATA[ x") == [] and shown("a<b") == ["a"] and shown("1 <2") == ["1 <2"]
    assert [b.path for b in blocks("<div data-id=no id='Yes-1' CLASS=\"b c\" role=main>x")] == [("div", ".yes", ".1", ".b", ".c", ".main")]


@pytest.mark.parametrize("piece", ["<a ", "<a b='", "<div>x", "<p><button><div>", "</x>", "<!--", "<![CDATA[", "<svg><g>", "<svg>", "<p class=\"a\"\" ", "<template>", "< ", "<li><ul>", "<script>", "</div><div>x"])
def test_two_megabytes_of_any_markup_take_seconds(piece):
    import time

    start = time.process_time()
    blocks(piece * (2_000_000 // len(piece)))
    assert time.process_time() - start < 15


def unseen(rng, layout):
    """A page whose layout is not among those of the training copies: (html, blocks of the article, other blocks)."""
    para = lambda a=12, b=60: " ".join(words(rng, rng.randrange(a, b))) + "."
    menu = [" ".join(words(rng, rng.randrange(1, 4))) for _ in range(rng.randrange(3, 9))]
    links = "".join(f"<li><a href='/{k}'>{w}</a></li>" for k, w in enumerate(menu))
    title, paras, foot, ad = " ".join(words(rng, 5)), [para() for _ in range(rng.randrange(3, 9))], "&copy; " + " ".join(words(rng, 4)), " ".join(words(rng, 6)) + "."
    shown, others = f"<h2>{title}</h2>" + "".join(f"<p>{p}</p>" for p in paras), [*menu, foot.replace("&copy;", "\u00a9")]
    if layout == "layout names on body":
        inner = f"<nav><ul>{links}</ul></nav><article>{shown}</article><footer>{foot}</footer>"
        return f"<body class='single-post header-fixed nav-open'>{inner}</body>", [title, *paras], others
    if layout == "links beside the article":
        inner = f"<div class='page-body'><div class='quick'><ul>{links}</ul></div><article class='entry'>{shown}</article></div><footer>{foot}</footer>"
        return f"<body>{inner}</body>", [title, *paras], others
    if layout == "no names":
        return f"<body><nav><ul>{links}</ul></nav><div id='x1'>{shown}</div><footer>{foot}</footer></body>", [title, *paras], others
    if layout == "tables":
        return f"<body><table><tr><td width=20%><ul>{links}</ul></td><td>{shown}</td></tr></table><div id='footer'>{foot}</div></body>", [title, *paras], others
    if layout == "form around the page":
        return f"<body><form id='aspnetForm'><div class='mainmenu'><ul>{links}</ul></div><div id='ctl00_cph'>{shown}</div></form><div class='site-footer'>{foot}</div></body>", [title, *paras], others
    if layout == "more comments than text":
        replies = [para() for _ in range(2 * len(paras))]
        listed = "".join(f"<li class='comment even depth-1'><div class='vcard'><p>{r}</p></div></li>" for r in replies)
        return f"<body><nav>{links}</nav><div class='post hentry'>{shown}</div><div id='comments'><ol>{listed}</ol></div><footer>{foot}</footer></body>", [title, *paras], others + replies
    if layout == "role and rail":
        inner = f"<div class='cookie-consent'><p>{ad}</p></div><ul class='menu-main'>{links}</ul><div role='main'>{shown}</div><aside class='right-rail'><p>{ad}</p></aside>"
        return f"<body>{inner}<footer>{foot}</footer></body>", [title, *paras], [*others, ad, ad]
    assert layout == "grid with sidebar"
    rail = [para(5, 15) for _ in range(2)]
    inner = f"<div class='col-8'>{shown}</div><div class='col-4 sidebar'>{''.join(f'<p>{r}</p>' for r in rail)}</div>"
    return f"<body><header><ul>{links}</ul></header><div class='wrap has-sidebar'><div class='row'>{inner}</div></div><footer>{foot}</footer></body>", [title, *paras], others + rail


UNSEEN = ["layout names on body", "links beside the article", "no names", "tables", "form around the page", "more comments than text", "role and rail", "grid with sidebar"]


@pytest.fixture(scope="module")
def trained(spark, pages):
    return hx.train(spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "page_id bigint, html string"))


@pytest.mark.parametrize("layout", UNSEEN)
def test_layouts_left_out_of_training(trained, layout):
    rng = random.Random(layout)
    given = [unseen(rng, layout) for _ in range(40)]
    got = [t.split("\n") for t in hx.texts(trained, [h for h, _, _ in given])]
    kept = sum(len(g) for g in got if g != [""])
    right = sum(sum(min(g.count(b), main.count(b)) for b in set(main)) for g, (_, main, _) in zip(got, given))
    assert right >= 0.9 * sum(len(main) for _, main, _ in given), right / sum(len(main) for _, main, _ in given)
    assert right >= 0.9 * kept, right / kept


def test_teacher_goes_by_the_share_of_the_text():
    def taught(source):
        page = blocks(source)
        return [b.text for b, y in zip(page, hx.teacher(page)) if y]

    long = "a b c d e f g h i j k l m n o p q r s t"
    assert taught(f"<body class='header-fixed'><nav>m</nav><article><p>{long}</article>") == [long]
    assert taught(f"<div class='page-body'><ul><li>x y</ul><article><p>{long}</article></div>") == [long]
    assert taught(f"<div class='page-body'><h1>t</h1><ul><li>x y</ul><article><p>{long}</article></div>") == ["t", long]
    assert taught(f"<div id=x1><h2>t</h2><p>{long}<p>{long}</div><div><p>s</div><div class=menu>m</div>") == ["t", long, long]
    assert taught(f"<article><p>x y</article><div class=comments><p>{long}<p>{long}</div>") == ["x y"]
    assert taught("<nav>m</nav>") == [] and taught("") == []
    assert taught("<main>" + "<div>x" * 20_000).count("x") == 20_000

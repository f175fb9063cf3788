import pytest

from lodestrata.llm import html_text

LONG = "A long sentence, with commas, and more of them. " * 5
CASES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav><article><h1>Head &amp; more</h1><p><b>{LONG}<br><p>Short.</p></article><footer>&copy; me.</footer>",
        ["Head & more", LONG.strip(), "Short."],
    ),
    "no article": (
        f"<div id=top class=menu><a>Home</a></div><div id=content><h2>Title</h2><p>{LONG}</p><p>Short one.</p><ul><li>item one</li><li>two</li></ul></div>"
        f"<div class='side-bar sidebar'><p>{LONG}</p></div><div id=comments><p>{LONG}</p></div><form><p>Mail: <input></p></form>",
        ["Title", LONG.strip(), "Short one.", "item one", "two"],
    ),
    "nested": (
        f"<header><h1>Site</h1></header><main><article><header><h1>My &lt;T&gt;</h1></header><p>One&nbsp;<b>bo</b>ld,\n\n and <i>so</i> on. {LONG}<p>Two<br>line &amp three. <span class=ad>BUY</span></p>"
        f"<aside>side</aside><div class='comments'><article><p>{LONG * 9}</p></article></div></article></main><div class=cookie-notice>We use cookies.</div><script>document.write('<p>no</p>')</script><!-- <p>hidden</p> -->",
        ["My <T>", f"One bold, and so on. {LONG.strip()}", "Two line & three."],
    ),
    "table": (f"<table><tr><td>{LONG}<td>Second</table>", [LONG.strip(), "Second"]),
    "plain": ("just some text", ["just some text"]),
    "broken": ("<p>unclosed <b>bold <a href=\"x", ["unclosed bold"]),
    "quoted": (f"<article><p title='a > b'>{LONG}</p></article>", [LONG.strip()]),
    "only menus": ("<nav><a>one</a></nav><footer>two</footer>", []),
    "script to the end": (f"<article><p>{LONG}</p><script>if (a < b) {{", [LONG.strip()]),
}

ARTICLE = f"<article><header class='entry-header'><h1>Head</h1></header><div class='post-header'><p>By me, today.</p></div><p>{LONG}</p><p>{LONG}</p></article>"
BESIDE = f"<div class=sidebar><p>{LONG}</p></div><div id=comments class='comments-area'><article><p>{LONG * 3}</p></article></div>"
WHOLE = ["Head", "By me, today.", LONG.strip(), LONG.strip()]
WRAPPERS = ["class='content-sidebar-wrap'", "class='has-sidebar'", "class='layout no-sidebar'", "id='search-page'", "class='sidebar-layout'", "class=search", "id=widget class='menu-open'"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize(
    "inside",
    [ARTICLE, ARTICLE + BESIDE, f"<div class='search-inner'>{ARTICLE}</div>{BESIDE}", f"<main>{ARTICLE}</main>{BESIDE}", ARTICLE.replace("article>", "div>") + f"<div class=sidebar><p>{LONG}</p></div>"],
)
def test_wrappers_around_the_article(wrapper, inside):
    for page in (f"<body><div {wrapper}>{inside}</div></body>", f"<body><div {wrapper}>{inside}</div><footer>end</footer></body>", f"<main><div {wrapper}>{inside.replace('main>', 'section>')}</div></main>"):
        got = html_text.main_text(page).split("\n\n")
        headed = "<article>" in inside or "<main>" in page  # elsewhere a header element is the site's
        assert got == WHOLE[not headed :], page


REGIONS = {
    "teaser in main": (f"<main><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><article><p>{LONG}</p></article><p>Last words.</p></main>", ["Head", LONG.strip(), LONG.strip(), LONG.strip(), "Last words."]),
    "three articles in main": (f"<main><article><p>One. {LONG}</p></article><article><p>Two. {LONG}</p></article><article><p>Three. {LONG}</p></article></main>", [f"{n}. {LONG.strip()}" for n in ("One", "Two", "Three")]),
    "three articles": (f"<div id=top><p>Hi</p></div><div><article><p>One. {LONG}</p></article><article><p>Two. {LONG}</p></article><article><p>Three. {LONG}</p></article></div>", [f"{n}. {LONG.strip()}" for n in ("One", "Two", "Three")]),
    "main and a small article": (f"<main><p>{LONG * 9}</p><p>{LONG * 9}</p></main><article><p>{LONG}</p></article>", [(LONG * 9).strip()] * 2),
}


@pytest.mark.parametrize("name", REGIONS)
def test_several_articles(name):
    page, blocks = REGIONS[name]
    assert html_text.main_text(page) == "\n\n".join(blocks)


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, blocks = CASES[name]
    assert html_text.main_text(page) == "\n\n".join(blocks)


def test_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", CASES["article"][0]), (3, "u", CASES["article"][0]), (4, "u", "<article>" + "<p>word. </p>" * 20_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    got = html_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(map(tuple, got.collect()), key=str)
    text = "\n\n".join(CASES["article"][1])
    assert found[:4] == [(1, "u", "", 0), (2, None, "", 0), (3, "u", text, len(text)), (3, "u", text, len(text))]
    assert found[4][3] == 20_000 * 5 + 19_999 * 2
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_given_pages_hold_their_articles(spark):
    import html
    import re

    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert html_text.main_text(row["html"]) == "\n\n".join(p for p in parts if p)

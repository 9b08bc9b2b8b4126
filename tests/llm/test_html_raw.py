import pytest

from veritrail.llm import html_text


@pytest.mark.parametrize(
    "tag", ["<svg width='1'/>", "<svg-icon name=x></svg-icon>", "<button>", "<svg:use></svg:use>", "<noscript/>", "<svg><path d='1'/></svg>", "<script>if (a < b) x()</script>"]
)
def test_text_after_raw_elements_stays(tag):
    page = f"<article><p>One two three four.</p>{tag}<p>Five six seven eight.</p></article>"
    assert html_text.main_text(page, html_text.tree()) == "One two three four. Five six seven eight."


def test_open_script_runs_to_the_end():
    assert html_text.main_text("<article><p>One two.</p><script>var a = 'x';", html_text.tree()) == "One two."


ARTICLE = "<article><h1>A title here</h1><p>" + "One two three four five six seven eight nine ten. " * 3 + "</p>{}</article>"
TEXT = "A title here " + "One two three four five six seven eight nine ten. " * 3


@pytest.mark.parametrize("around", ['<div class="layout has-sidebar">', '<div class="page header-image">', '<form id="aspnetForm">', "<nav><ul><li><a href=x>Home</a></li></ul>", "<header>"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_what_stands_around_an_article(around, element):
    """Also without an article element: then words and links alone decide."""
    page = around + ARTICLE.replace("article>", f"{element}>").format("")
    assert html_text.main_text(page, html_text.tree()) == TEXT.strip()


@pytest.mark.parametrize("name", ['class="ad-hoc"', 'id="related-work"', 'id="search-theory"', 'class="menu-design"', 'class="note header-image"'])
def test_sections_of_an_article(name):
    page = ARTICLE.format(f"<section {name}><p>Short one.</p></section>")
    assert html_text.main_text(page, html_text.tree()) == TEXT + "Short one."


@pytest.mark.parametrize(
    "part",
    [
        "<div class=sidebar><article><p>Another story that stands beside this one.</p></article></div>", "<div class='ad-box'>Buy now at the best shop.</div>",
        "<div id=comments><article><p>I liked it a lot.</p></article></div>", "<aside><article>More of the same</article></aside>", "<div class='site-header'>Our site</div>",
        "<nav><a href=x>Home</a></nav>", "<form><label>Name</label></form>", "<p hidden>Nothing to see</p>", "<footer><p>All rights reserved.</p></footer>",
    ],
)
def test_furniture_beside_an_article(part):
    for page in (part + ARTICLE.format(""), ARTICLE.format("") + part):
        assert html_text.main_text(page, html_text.tree()) == TEXT.strip()
    assert html_text.main_text(part, html_text.tree()) == ""


def test_the_tree_without_what_elements_say(spark):
    """Long text with few links against link lists, by words and links alone."""
    tree = html_text.plain_tree()
    for words, links, want in ((50, 0.0, 1), (120, 0.1, 1), (2, 1.0, 0), (6, 0.9, 0), (15, 0.8, 0)):
        assert html_text.decide(tree, (words, links, 40, 0.0, 40, 0.0, 0, 0, 0)) == want


def test_a_session_keeps_its_setting(spark):
    from veritrail.llm import common

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        assert common.written(spark.range(3), "t").count() == 3 and spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)

"""Pages that no author meant: they neither end a job nor lose their article, and time grows with the page."""

import time

import pytest

from tapeforge.llm import html_text

TEXT = [f"This is paragraph {i} of a long article that says a lot of things about nothing in particular." for i in range(6)]
ARTICLE = "<h1>Title</h1>" + "".join(f"<p>{t}</p>" for t in TEXT)
WANT = "\n".join(["Title", *TEXT])
MENU = "<ul><li><a href=#>Home</a></li><li><a href=#>News and more of it</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 5000 + ARTICLE + "</div>" * 5000,
        "<div>" * 5000 + ARTICLE,
        f"<body><![foo[bar]]>{ARTICLE}</body>",
        f"<body>{ARTICLE}<![foo[bar",
        f"<body><![if !IE]>{ARTICLE}<![endif]></body>",
        f"<body><form id=aspnet><input type=hidden><select><option>one</option></select><div>{ARTICLE}</div></form></body>",
        f"<body><form><main>{ARTICLE}</main></form></body>",
        f"<body><nav>{MENU}<div>{ARTICLE}</div></body>",
        f"<body><nav>{MENU}<article>{ARTICLE}</article></body>",
    ],
)
def test_the_article_stays(page):
    assert html_text.extract(page) == WANT


@pytest.mark.parametrize("page", ["<body><form><label>Search this site</label><input></form></body>", f"<body><nav>{MENU}</nav></body>", "<![", "<!"])
def test_what_is_no_article_goes(page):
    assert html_text.extract(page) in ("", "<![", "<!")


def test_a_form_beside_an_article_goes():
    form = "<form>" + "<p>Tell us what you think about all of this, and leave your name.</p>" * 3 + "</form>"
    assert html_text.extract(f"<body><div>{ARTICLE}</div>{form}</body>") == WANT


@pytest.mark.parametrize("page", ["<p>" + "<span>x " * 40_000, "<span>" * 40_000 + "</b>" * 40_000, "<div>text that is long enough to be kept as it is " * 20_000, "<div>" + "<span>" * 20_000 + "<p>a" * 20_000])
def test_time_grows_with_the_page(page):
    began = time.time()
    html_text.extract(page)
    assert time.time() - began < 5

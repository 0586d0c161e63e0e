"""Pages whose boilerplate and regions only a whole look tells."""

from __future__ import annotations

import pytest

from tracewright.llm import html

LONG = "This sentence of the story is long enough to be a paragraph of its own and holds the text of the page. "
ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p></article>"
TEXT = f"Title\n{LONG.strip()}"


@pytest.mark.parametrize("page", [
    f'<div class="content has-sidebar">{ARTICLE}</div>',
    f'<div id=page class="with-sidebar">{ARTICLE}</div>',
    f'<div class="sidebar">{ARTICLE}</div>',
    f'<form id=aspnet><div class="header">{ARTICLE}</div></form>',
    f'<article><div class="elementor-widget"><h1>Title</h1></div><div class="elementor-widget elementor-widget-text"><p>{LONG}</p></div></article>',
    f'<div class="notice"><h1>Title</h1><p>{LONG}</p></div><div class="share">Share this</div>',
    f'<div class="content widget"><h1>Title</h1><p>{LONG}</p></div>',
])
def test_named_elements_with_the_content_stay(page):
    assert html.extract_text(f"<html><body>{page}</body></html>") == TEXT


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "cookie-banner", "widget", "post-comments", "share-buttons", "related posts", "main-nav", "left-sidebar", "social_links", "sidebar-1", "ad ads"])
def test_whole_tokens_still_drop(name):
    assert html.extract_text(f'<body><div><h1>Title</h1><p>{LONG}</p></div><div class="{name}">Short text here</div></body>') == TEXT
    assert html.extract_text(f"<body>{ARTICLE[:-10]}<div id=\"{name.split()[0]}\">Short text here</div></article></body>") == TEXT


def test_comments_and_related_articles_go_if_there_is_another():
    page = f'<body>{ARTICLE}<section id="comments"><article>{LONG * 5}</article></section><div class="related"><article>Teaser</article></div><aside><article>x</article></aside></body>'
    assert html.extract_text(page) == TEXT


def test_one_long_paragraph_is_no_region():
    page = f"<body><div><h1>Title</h1><p>Short one.</p><p>{LONG * 60}</p><p>{LONG}</p><p>Last.</p></div></body>"
    assert html.extract_text(page) == f"Title\nShort one.\n{(LONG * 60).strip()}\n{LONG.strip()}\nLast."
    assert html.extract_text(page.replace("<p>", "<div>").replace("</p>", "</div>")) == html.extract_text(page)
    assert html.extract_text(f"<body><div><h2>A</h2><p>{LONG * 60}</p></div><div><h2>B</h2><p>{LONG}</p></div></body>") == f"A\n{(LONG * 60).strip()}\nB\n{LONG.strip()}"


def test_links_in_the_region_stay_and_menus_round_it_go():
    page = f"<body><ul><li><a href=a>Home</a></li></ul><div><p>{LONG}</p><p><a href=b>A line that is one link</a></p><p>{LONG}</p><p><a href=c>Source</a></p></div></body>"
    assert html.extract_text(page) == f"{LONG.strip()}\nA line that is one link\n{LONG.strip()}\nSource"
    assert html.extract_text("<body><ul><li><a href=a>Home</a></li></ul></body>") == ""


def test_all_articles_of_a_page_stay():
    page = f"<body><article><p>{LONG * 20}</p></article><article><p>Short news.</p></article></body>"
    assert html.extract_text(page) == f"{(LONG * 20).strip()}\nShort news."

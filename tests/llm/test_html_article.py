"""HTML extraction (2): words in attributes, names inside the article, hostile nesting."""

from __future__ import annotations

import random
import time
import tracemalloc

import pytest

from credlake.llm import html_extract

from .conftest import prose


def sentences(seed, n):
    return " ".join(prose(random.Random(seed * 100 + i), 9) + ", and more." for i in range(n))


A, B, C = sentences(1, 5), sentences(2, 5), sentences(3, 4)


@pytest.mark.parametrize("attrs", ["data-headline='The hidden cost of rain'", "title='a hidden thing'", "data-note='uses display:none in css'",
                                   "data-id='menu' data-class=ad", "title='x class=sidebar id=nav'", "aria-hidden=false", "style='color: red'",
                                   "data-hidden=1"])
@pytest.mark.parametrize("tag", ["article", "p", "div"])
def test_words_of_attribute_values_hide_nothing(tag, attrs):
    page = f"<body><article {attrs}><p>{A}</p><p>{B}</p></article></body>" if tag == "article" else \
        f"<body><article><{tag} {attrs}>{A}</{tag}><p>{B}</p></article></body>"
    assert html_extract.extract(page) == A + "\n" + B


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN=''", "aria-hidden='true'", "style='color:red; display : none'", "class=x hidden id=y"])
def test_what_is_not_shown_goes(attrs):
    assert html_extract.extract(f"<body><article><p>{A}</p><div {attrs}><p>{C}</p></div><p>{B}</p></article></body>") == A + "\n" + B


@pytest.mark.parametrize("part, want", [
    ("<h2 id='navigation'>Navigation at sea</h2>", "Navigation at sea"), ("<h2 id='comments'>Comments of the time</h2>", "Comments of the time"),
    ("<h3 class='banner'>The banner</h3>", "The banner"), (f"<section id='search'><h2>The search</h2><p>{C}</p></section>", "The search\n" + C),
    (f"<p class='share'>{C}</p>", C), (f"<p id='legal'>{C}</p>", C), (f"<section class='related'><p>{C}</p></section>", C)])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_names_inside_the_article(tag, part, want):
    page = f"<body><nav>One Two</nav><{tag}><h1>T</h1><p>{A}</p>{part}<p>{B}</p></{tag}><footer>All rights.</footer></body>"
    assert html_extract.extract(page) == f"T\n{A}\n{want}\n{B}"


@pytest.mark.parametrize("part", ["<p class='share'><a href=1>Share on one</a> <a href=2>Share on two</a></p>", "<p class=ad>Buy it now</p>",
                                  f"<section id=comments><p>{C}</p></section>", "<section class=related><a href=1>Read this next, please.</a></section>",
                                  f"<div class=sidebar><p>{C}</p></div>", f"<aside>{C}</aside>"])
def test_boilerplate_inside_the_article(part):
    assert html_extract.extract(f"<body><article><h1>T</h1><p>{A}</p>{part}<p>{B}</p></article></body>") == f"T\n{A}\n{B}"


@pytest.mark.parametrize("open_tag", ["<div>", "<x-y class=a>", "<p><b>", "<li>", "<p><x-y>"])
def test_nesting_is_linear(open_tag):
    def cost(n):
        page = f"<body><article><p>{A}</p>" + f"{open_tag}a word, here. " * n
        t = time.process_time()
        html_extract.extract(page)
        return time.process_time() - t

    cost(500)
    small, large = cost(5000), cost(40_000)
    assert large < 8 * max(small, .05) * 3 and large < 10


def test_memory_is_linear():
    tracemalloc.start()
    html_extract.extract("<body>" + "<x-y class=a>a word, here. " * 20_000)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_deep_pages_keep_their_text():
    page = "<body><main>" + "".join(f"<div><p>{prose(random.Random(i), 12)}, and more." for i in range(3000))
    assert html_extract.extract(page).count("\n") == 2999

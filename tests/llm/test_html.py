"""Main text of pages: marks that wrap the story, comments and adverts, hostile markup, measured on pages of known parts."""
import random
import time

import pytest
from pyspark.sql import functions as F

from airlens.llm import html_text

STORY = "".join(f"<p>{'plain words of the story ' * 12}</p>" for _ in range(5))
SAID = "".join(f"<p>{'a reader says this about it ' * 10}</p>" for _ in range(4))


@pytest.mark.parametrize("html", [
    f"<html><head><title>t</title><meta name=x><body><article><h1>T</h1>{STORY}</article></body>",
    f"<html><head><title>t</title><link rel=x><article><h1>T</h1>{STORY}</article>",
    f"<head><title>t</title>T<p>{STORY}",
    f"<body><nav><a href=/>home</a><article><h1>T</h1>{STORY}</article>",
    f"<body><nav><ul><li><a href=/>home</a></ul><div><h1>T</h1>{STORY}</div></body>",
    f"<body><form action=x><input name=v><div><h1>T</h1>{STORY}</div><input type=submit></form>",
    f"<body hidden><h1>T</h1>{STORY}</body>", f"<main aria-hidden='true'><h1>T</h1>{STORY}</main>",
    f"<div aria-hidden='true'><h1>T</h1>{STORY}</div>", f"<div class='ad-free comments-on'><h1>T</h1>{STORY}</div>",
    f"<article><h1>T</h1>{STORY}</article><div class='comments'>{SAID}</div>",
    f"<div><h1>T</h1>{STORY}</div><section id='discussion'>{SAID}</section>",
    f"<article><h1>T</h1>{STORY}</article><section id=comments><article class='comment'>{SAID}</article><article class=comment>{SAID}</article></section>",
    f"<article><h1>T</h1><div class='advert'><p>{'buy this thing now because it is good ' * 3}</p></div>{STORY}"
    "<div class='newsletter'><p>Get our newsletter every week in your inbox, for free, always, and read on.</p></div></article>",
    f"<article><h1>T</h1>{STORY}</article><form class='respond'><p>Say what you think of this story in the box below, and be kind.</p></form>",
    f"<script><!-- var a = '<p>'; </script><article><h1>T</h1>{STORY}<!-- <p>{SAID}</p> --></article>",
    f"<article data-x='a > b' title=\"<p>\"><h1>T</h1>{STORY}</article><![CDATA[ x ]]><?php y ?></ z>",
])
def test_story_and_nothing_else(html):
    assert html_text.main_lines(html) == ["T"] + [" ".join(["plain words of the story"] * 12)] * 5


def test_pages_without_a_story_are_empty():
    foot = "Copyright by us, all rights reserved, and some more text that is long enough to be a line of a story."
    assert html_text.main_lines(f"<nav><ul><li><a href=/>home</a></ul></nav><footer>{foot}</footer>") == []
    assert html_text.main_lines("<!-- never closed <p>text") == [] and html_text.main_lines("<p>a<b") == ["a"]


@pytest.mark.parametrize("unit", ["<!--", "<a ", "<!", "<?", "</", "<![", "<a b='", "<a b=\"", "<script>", "<title>", "<a b=\"'>",
                                  "<nav>", "<div class=ad>", "<p>", "&#x", "<a/"])
def test_time_grows_with_the_page(unit):
    html_text.main_lines("<p>warm</p>")
    for end in ("", ">"):
        t = time.perf_counter()
        html_text.main_lines(unit * (250_000 // len(unit)) + end)
        assert time.perf_counter() - t < 8


def generated(seed):
    """(page, blocks of the story, blocks of everything else)."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)) + "."
    story = [sentence(rnd.randint(25, 90)) for _ in range(rnd.randint(3, 12))]
    if rnd.random() < 0.5:
        story.insert(rnd.randrange(1, len(story)), sentence(4))
    said = [sentence(rnd.randint(8, 60)) for _ in range(rnd.randint(0, 8))]
    other = [sentence(rnd.randint(6, 25)) for _ in range(4)]
    links = [word() for _ in range(rnd.randint(4, 25))]
    menu = "<ul>" + "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in links) + "</ul>"
    paras = [f"<p>{x}</p>" for x in story]
    paras.insert(rnd.randrange(1, len(paras)), f"<div class='{rnd.choice(['ad', 'advert-box', 'sponsored', 'newsletter'])}'><p>{other[0]}</p></div>")
    body = rnd.choice(["<article>{}</article>", "<main>{}</main>", "<div id='content'>{}</div>", "<article class='post comments-open'>{}</article>",
                       "<div class='page-with-nav'><div>{}</div></div>"]).format("".join(paras))
    comments = f"<{rnd.choice(['div', 'section'])} {rnd.choice(['id', 'class'])}='{rnd.choice(['comments', 'user-comments', 'discussion', 'disqus_thread'])}'>"
    comments = comments + "".join(f"<div><p>{x}</p></div>" for x in said) + "</" + comments[1:].split(" ")[0] + ">"
    page = (rnd.choice(["<html><head><title>x</title></head><body>", "<head><title>x</title><body class='has-sidebar'>", "<body>"])
            + rnd.choice([f"<nav>{menu}</nav>", f"<header>{menu}</header>", f"<div class='menu'>{menu}</div>"])
            + rnd.choice(["{}", "<form id='aspnet'><input name='s'>{}</form>"]).format(body + comments)
            + f"<aside><p>{other[1]}</p>{menu}</aside><footer><p>{other[2]}</p></footer><div class='cookie-notice'>{other[3]}</div>")
    return page, story, said + other + links


def test_recall_and_precision_on_pages_of_known_parts():
    want = found = right = wrong = 0
    for seed in range(300):
        page, story, rest = generated(seed)
        got = html_text.main_lines(page)
        want += sum(map(len, story))
        found += sum(len(x) for x in got)
        right += sum(len(x) for x in got if x in story)
        wrong += sum(x in rest for x in got)
    assert right / want > 0.995 and right / found > 0.995, (right / want, right / found, wrong)


def test_rows_with_clashing_columns_and_an_empty_table(spark):
    rows = spark.createDataFrame([(1, "u", f"<article>{STORY}</article>")], "page_id long, url string, html string")
    more = rows.select("*", *[F.lit(7).alias(c) for c in ("text", "n_chars", "lines", "region")])
    got = html_text.extract(more).collect()
    assert got[0]["n_chars"] == len(got[0]["text"]) > 1000 and html_text.extract(more.limit(0)).count() == 0

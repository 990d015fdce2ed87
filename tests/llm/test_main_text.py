"""The main text's method, step by step in plain Python, on all given pages and on pages made to mislead it."""

import math
import time

import pytest

from claimloom.llm import html
from claimloom.llm.catalog import QUERIES

STORY = "".join(f"<p>{'Long sentence of the story, part %d, goes on. ' % k * 4}</p>" for k in range(6))


def page(body):
    return f"<html><body><nav>menu</nav>{body}<footer>end of page</footer></body></html>"


def plain_content(lines, threshold, share):
    """Ratios, smoothing and clusters over the lines of a page."""
    n, reach = len(lines.texts), max(1, math.ceil(3 * html.SIGMA))
    weight = [html.ARTICLE_WEIGHT if a else 1.0 for a in lines.article]
    ratio = [0 if f else len(t) / (1 + g) for t, g, f in zip(lines.texts, lines.tags, lines.furniture)]
    smooth = []
    for i in range(n):
        near = [j for j in range(i - reach, i + reach + 1) if 0 <= j < n]
        kernel = [math.exp(-0.5 * ((i - j) / html.SIGMA) ** 2) for j in near]
        smooth.append(weight[i] * sum(k * ratio[j] for k, j in zip(kernel, near)) / sum(kernel))
    open_lines = [i for i in range(n) if not lines.furniture[i]]
    top = max((smooth[i] for i in open_lines), default=0)
    clusters = []
    for i in open_lines:
        if smooth[i] >= threshold * top * (1 - 1e-12):
            last = clusters[-1] if clusters else None
            if last and i - last[-1] <= html.BRIDGE + 1 and lines.article[i] == lines.article[last[-1]]:
                last.append(i)
            else:
                clusters.append([i])
    if not clusters:
        return []
    mass = [sum(len(lines.texts[i]) * weight[i] for i in range(c[0], c[-1] + 1) if not lines.furniture[i]) for c in clusters]
    best = clusters[mass.index(max(mass))]
    chosen = set()
    for c, m in zip(clusters, mass):
        if bool(lines.article[c[0]]) == bool(lines.article[best[0]]) and m >= share * max(mass):
            chosen |= set(range(c[0], c[-1] + 1))
            chosen |= {i for i in range(n) if lines.article[c[0]] and lines.article[i] == lines.article[c[0]]}
    return [lines.texts[i] for i in sorted(chosen) if not lines.furniture[i]]


def lines_of(source):
    lines = html.Lines()
    lines.feed(html._CUT_TAG.sub("", source))
    lines.close()
    return lines


@pytest.mark.parametrize(("threshold", "share"), [(0.1, 0.25), (0.6, 0.25), (0.95, 0.0), (1.0, 1.0), (2.1, 0.25)])
def test_clusters_choose_the_regions_of_given_pages(spark, sf_dir, monkeypatch, threshold, share):
    monkeypatch.setattr(html, "THRESHOLD", threshold)
    monkeypatch.setattr(html, "CLUSTER_SHARE", share)
    sources = [r.html or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    sources += [s.replace("<article", "<div").replace("</article", "</div").replace("<main", "<div") for s in sources]
    for source in sources:
        assert html.main_text(source) == plain_content(lines_of(source), threshold, share)


def test_the_threshold_decides(spark, sf_dir, monkeypatch):
    sources = [r.html or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    bare = [s.replace("<article", "<div").replace("</article", "</div") for s in sources]
    first = [html.main_text(s) for s in [*sources, *bare]]
    monkeypatch.setattr(html, "THRESHOLD", 0.9)
    assert sum(html.main_text(s) != t for s, t in zip([*sources, *bare], first)) > 10
    monkeypatch.setattr(html, "THRESHOLD", 1.01)
    assert not any(html.main_text(s) for s in sources)


def test_query_returns_whole_texts(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op10_main_text"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        blocks = plain_content(lines_of(pages[r.page_id].html or ""), html.THRESHOLD, html.CLUSTER_SHARE)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, "\n\n".join(blocks), len("\n\n".join(blocks)))


@pytest.mark.parametrize(
    "body",
    [
        f"<form id=aspnetForm><article>{STORY}</article></form>",
        f"<form id=aspnetForm>{STORY}</form>",
        f"<div class='with-nav'>{STORY}</div>",
        f"<div class='content no-sidebar'>{STORY}</div>",
        f"<div class='tags-layout'><div class='has-sidebar'>{STORY}</div></div>",
        f"<div class='social-article'>{STORY}</div>",
        f"<div>{STORY}</div><article><a href=x>A teaser of one line</a></article>",
        f"<article>{STORY}</article><div class=comments><article>{'reader comment ' * 400}</article></div>",
        f"<article>{STORY}<div class='ad-slot'>Buy</div><form>Mail <input></form></article>",
    ],
)
def test_pages_made_to_mislead_keep_their_story(body):
    assert html.main_text(page(body)) == html.main_text(page(f"<article>{STORY}</article>")) != []


def test_blocks_inside_the_story_stay():
    found = html.main_text(page(f"<article>{STORY}<p class='notice-board'>The board met.</p><p>As <math><mi>x</mi></math> grows.</p></article>"))
    assert found[-2:] == ["The board met.", "As x grows."]


@pytest.mark.parametrize(
    "hostile",
    [
        lambda n: "<b>" * n + "</i>" * n + "x", lambda n: "<div class='x-nav'><p>a" * n, lambda n: "<p>a</b></p>" * n,
        lambda n: "<article>" * n + "a" * n, lambda n: "<b><i></b>" * n + "x", lambda n: "a " * 10 * n, lambda n: "<!--" * n,
    ],
)
def test_time_grows_with_length(hostile):
    def seconds(n):
        start = time.process_time()
        html.main_text(hostile(n))
        return time.process_time() - start

    seconds(500)
    assert seconds(24_000) < 20 * max(0.05, seconds(6_000))

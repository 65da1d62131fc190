import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from strata.llm import html_text, license_rules, license_scan, link_trust, rangecoder, rules, subword, tokenout
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose

PAGES = "page_id long, url string, html string"


# --- URL trust -------------------------------------------------------------

def test_urls_and_rules(spark):
    rows = [(1, "HTTP://WWW.Example.COM/en/a?x#y", ""), (2, "https://m.example.com/en/1", None), (3, "http://a.net/es/", ""),
            (4, "http://a.net/x", ""), (5, None, None), (6, "no scheme", ""), (7, "http://b.org?q", ""), (8, "a://b://c/d", ""),
            (9, "http://x.com", ""), (9, "http://x.com/", ""), (None, "http://notexample.com/en/", "")]
    got = {(r["page_id"], r["path"]): r for r in link_trust.judge(spark.createDataFrame(rows, PAGES)).collect()}
    see = lambda k: (got[k]["host"], got[k]["rule"], got[k]["verdict"])
    assert see((1, "/en/a")) == ("www.example.com", "www.example.com/en/", "allow")
    assert see((2, "/en/1")) == ("m.example.com", "example.com/en/", "block")
    assert see((3, "/es/")) == ("a.net", "net/es/", "block")
    assert see((4, "/x")) == ("a.net", None, "block")  # its host has only distrust
    assert got[(5, "")]["host"] == got[(6, "")]["host"] == "" and got[(5, "")]["verdict"] == "allow"
    assert see((7, "")) == ("b.org", None, "allow") and see((8, "//c/d")) == ("b:", None, "allow")
    assert see((9, "/")) == ("x.com", "com/", "allow") and see((9, "")) == ("x.com", None, "allow")
    assert see((None, "/en/")) == ("notexample.com", "com/", "allow")
    assert link_trust.judge(empty(spark, PAGES)).count() == 0


def test_trust_follows_links_and_distrust_comes_back(spark):
    link = '<a href="http://{}/p">x</a>'.format
    rows = [(1, "http://good.com/a", link("friend.org")), (2, "http://friend.org/a", link("far.org")), (3, "http://far.org/", ""),
            (4, "http://bad.net/es/", link("victim.org")), (5, "http://farm.org/a", link("BAD.net") * 3 + link("good.com")),
            (6, "http://victim.org/a", "")]
    df = spark.createDataFrame(rows, PAGES)
    got = {r["host"]: r["verdict"] for r in link_trust.judge(df).collect()}
    assert got == {"good.com": "allow", "friend.org": "allow", "far.org": "allow", "bad.net": "block", "farm.org": "block", "victim.org": "allow"}


def test_propagation_matches_dense_matrix(spark):
    rng = np.random.default_rng(1)
    n = 12
    m = rng.integers(0, 3, (n, n)) * (rng.random((n, n)) < 0.3)
    np.fill_diagonal(m, 0)
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(m[i, j])) for i in range(n) for j in range(n) if m[i, j]], "src string, dst string, n double")
    seeds = spark.createDataFrame([("h0", 3, 0), ("h1", 1, 1), ("h2", 0, 2)], "host string, good long, bad long")
    got = {r["host"]: (r["trust"], r["distrust"], r["base"]) for r in link_trust.propagate(edges, seeds, 0.85, 1e-9).collect()}
    hosts = [i for i in range(n) if m[i].any() or m[:, i].any() or i < 3]
    t0, d0, b0 = np.zeros(n), np.zeros(n), np.zeros(n)
    t0[[0, 1]], d0[[1, 2]], b0[hosts] = [0.75, 0.25], [1 / 3, 2 / 3], 1 / len(hosts)
    out, into = m / np.maximum(m.sum(1, keepdims=True), 1), m / np.maximum(m.sum(0, keepdims=True), 1)
    limit = lambda start, along: np.linalg.solve(np.eye(n) - 0.85 * along, 0.15 * start)
    t, d, b = limit(t0, out.T), limit(d0, into), limit(b0, into)
    assert set(got) == {f"h{i}" for i in hosts}
    for i in hosts:
        assert got[f"h{i}"] == pytest.approx((t[i], d[i], b[i]), abs=1e-7)


def test_a_trace_of_distrust_from_a_sibling_blocks_nobody(spark):
    """Forty sites of one public domain, a few with blocked pages; a site shares with its one subdomain."""
    rows = [(k, f"http://s{k}.example.net/en/{k}", "") for k in range(40)]
    rows += [(100 + k, f"http://s{k}.example.net/fr/{j}", "") for k in range(4) for j in range(5)]
    rows += [(200, "http://m.s0.example.net/en/x", ""), (201, "http://m.s30.example.net/en/x", "")]
    got = {r["host"]: r["host_verdict"] for r in link_trust.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert {h for h, v in got.items() if v == "block"} == {"s0.example.net", "s1.example.net", "s2.example.net", "s3.example.net", "m.s0.example.net"}


def test_exact_ties_are_allowed_whatever_the_order(spark):
    """Each h is linked from one trusted and links to one distrusted host: equal ranks by symmetry."""
    link = '<a href="http://{}/p">x</a>'.format
    rows = [(k, f"http://good{k}.com/a", link(f"h{k}.org")) for k in range(7)]
    rows += [(10 + k, f"http://h{k}.org/", link(f"bad{k}.net")) for k in range(7)] + [(20 + k, f"http://bad{k}.net/fr/", "") for k in range(7)]
    for parts in (1, 5):
        got = {r["host"]: r["verdict"] for r in link_trust.judge(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()}
        assert {got[f"h{k}.org"] for k in range(7)} == {"allow"} and {got[f"bad{k}.net"] for k in range(7)} == {"block"}


def test_links_of_long_pages_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    page = "<p>word</p>" * 60_000 + '<a href="http://bad.net/x">x</a>'
    df = spark.createDataFrame([(1, "http://bad.net/fr/", ""), (2, "http://far.org/", page), (3, "http://other.org/", None)], PAGES)
    df = df.withColumns({c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "ruled", "n", "trust", "base", "src", "to")})
    assert {r["host"]: r["verdict"] for r in link_trust.judge(df).collect()} == {"bad.net": "block", "far.org": "block", "other.org": "allow"}


# --- main text --------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class="cookie-notice">We use cookies, as everyone does these days.</div>
<main><article><header><h1>Title &amp;  more</h1></header><p>First   para, with <a href=x>a link</a> in&nbsp;it.<br><p>Second &lt;b&gt; <b>bold.
<aside><p>Related: buy this thing now, it is very cheap.</p></aside><form><label>Mail</label><input></form><script>var a = "</p><p>no";</script>
<ul><li>One item of the article</li><li>Two</li></ul><p>End.</article><section id="comments"><h2>Comments</h2><article><p>I like this very much, thank you.</p>
</article></section></main><div class="sidebar"><p>Popular posts are listed here for everyone.</p></div><footer>&copy; x</footer></body></html>"""


def test_main_text_of_pages(spark):
    want = "Title & more\nFirst para, with a link in it.\nSecond <b> bold.\nOne item of the article\nTwo\nEnd."
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "just &amp; text"), (None, "u", "<nav>menu</nav>"), (1, "u", PAGE),
            (5, "u", "<article>" + "<p>A paragraph of words.</p>" * 3000 + "</article>"), (6, "u", "<p <div></p><<< > </a></zzz>")]
    got = html_text.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert [r["page_id"] for r in got] == [r[0] for r in rows]
    text = [r["text"] for r in got]
    assert text[0] == text[5] == want and text[1] == text[2] == text[4] == "" and text[3] == "just & text"
    assert text[6] == "\n".join(["A paragraph of words."] * 3000) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(empty(spark, PAGES)).count() == 0


ARTICLE = "".join(f"<p>{prose(k, 12).capitalize()}.</p>" for k in range(700, 706))


@pytest.mark.parametrize("open_tags", [
    "<div class='site has-sidebar'><article>", "<article class='post tag-social'>", "<div class=no-ads><article>",
    "<body class='comments-open'><article>", "<html class=discussion><body><article>", "<div class=comments-closed><div><article>",
    "<div title='Hidden costs'><article>", "<div data-url='/hidden-gems/1'><article>", "<div data-hidden='false'><article>",
    "<div class='layout-sidebar'><article>", "<article class='social'>", "<main id=promo>", "<div class='menu comments'><main>",
    "<div class=discussion>", "<div data-x='role=navigation' data-class=ad><article>"])
def test_names_around_an_article_do_not_veto_it(open_tags):
    want = [prose(k, 12).capitalize() + "." for k in range(700, 706)]
    page = f"<nav><a href=/>Home</a></nav>{open_tags}{ARTICLE}</article></main></div><footer>Imprint</footer>"
    assert html_text.main_text(page).split("\n") == want


@pytest.mark.parametrize("name", ["class=sidebar", "class='box site-sidebar'", "id=comments", "CLASS = \"ad-banner\"", "hidden",
                                  "style='display: none'", "aria-hidden=true", "class=is-hidden", "class='comment-list'"])
def test_names_of_lesser_elements_still_tell(name):
    want = [prose(k, 12).capitalize() + "." for k in range(700, 706)]
    for rest in ("<p>A paragraph of some more words, that are not of the text.</p>", f"<article>{prose(9, 25)}.</article>"):
        for page in (f"<main><article>{ARTICLE}</article><div {name}>{rest}</div></main>", f"{ARTICLE}<div {name}>{rest}</div>"):
            if not (page.startswith("<p>") and "<article>" in rest):  # the only article of the page
                assert html_text.main_text(page).split("\n") == want, page


def test_lists_of_links_inside_an_article_stay_unless_they_are_menus():
    cited = ["A history of the northern harbours, second edition", "On the keeping of bees in cold valleys"]
    links = "".join(f"<li><a href=/{k}>{t}</a></li>" for k, t in enumerate(cited))
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li><li><a href=/c>Contact</a></li></ul>"
    want = [prose(k, 12).capitalize() + "." for k in range(700, 706)]
    for tag in ("ul", "ol"):
        page = f"<article>{ARTICLE}<h2>Sources</h2><{tag}>{links}</{tag}></article><nav><ul>{links}</ul></nav>"
        assert html_text.main_text(page).split("\n") == [*want, "Sources", *cited]
    assert html_text.main_text(f"<article>{menu}{ARTICLE}</article>").split("\n") == want


def test_deep_pages_take_time_and_memory_in_proportion():
    import time
    import tracemalloc
    took = {}
    for depth in (8_000, 32_000):
        page = "".join(f"<div{' class=sidebar' if k % 2 else ''}>word{k} " for k in range(depth)) + "</section>" * depth
        begin = time.process_time()
        found, hints = html_text.blocks(page)
        html_text.hint_strengths(found, hints)
        html_text.smoothness(found)
        took[depth] = time.process_time() - begin
        assert len(found) == depth and len(hints.flag) == depth // 2
    assert took[32_000] < 8 * took[8_000] + 1  # linear, not 16 times as long
    tracemalloc.start()
    html_text.main_text("".join(f"<div>word{k} " for k in range(32_000)))
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_weights_are_learned_from_labelled_blocks():
    import duckdb
    from strata.llm import html_fit
    read = lambda sf, n: [r[0] for r in duckdb.sql(
        f"select html from '/root/testdata/{sf}/pages.parquet' where page_id >= {n} order by page_id").fetchall()]
    x, y = html_fit.labelled(read("sf0.01", 0))
    assert html_fit.fit(x, y) == html_text.WEIGHTS
    held, truth = html_fit.labelled(read("sf0.1", 1800))  # pages of another table
    right = (held @ np.array([html_text.WEIGHTS[n] for n in html_fit.PRIOR]) > 0) == truth
    assert right.mean() > 0.98
    assert html_fit.fit(x[:0], y[:0]) == html_fit.PRIOR


def test_page_columns_may_clash(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "u", PAGE)], PAGES).withColumns({c: F.lit("clash") for c in ("h", "text", "n_chars", "found")})
    r = html_text.extract(df).first()
    assert r["text"].startswith("Title & more\n") and r["n_chars"] == len(r["text"])


def test_comments_may_be_longer_than_the_article():
    comments = "".join(f"<article><p>{prose(k, 12)}.</p></article>" for k in range(800, 840))
    page = f"<main><article>{ARTICLE}</article><section id=comments>{comments}</section></main>"
    assert html_text.main_text(page).split("\n") == [prose(k, 12).capitalize() + "." for k in range(700, 706)]


@pytest.mark.parametrize("tag", "noscript svg object canvas audio video select button template".split())
def test_unclosed_elements_end_at_a_block_or_with_their_parent(tag):
    body = "<article><p>First paragraph of the text.</p><p>Second paragraph of the text.</p></article>"
    want = "First paragraph of the text.\nSecond paragraph of the text."
    for page in (f"<header><{tag}>Label</header>{body}", f"<header><{tag}>Label</header>{body}<footer></{tag}></footer>",
                 f"<div><{tag}>Label{body}</div>", f"<div><{tag}>Label{body}<footer><{tag}>Up</{tag}></footer></div>",
                 body.replace("First", f"<{tag}><div>not <p>this</p></div></{tag}>First"),
                 f"<div><{tag} x=1>No <i>words</i><script>'</{tag}>'</script> here</{tag}></div>{body}"):
        assert html_text.main_text(page) == want, page


def test_raw_text_runs_to_its_end_tag_and_formulas_stay():
    for tag in "script style textarea iframe title".split():
        assert html_text.main_text(f"<p>Words of the page, some.</p><{tag}><p>No words</p></{tag} ><p>More words of it.") == (
            "Words of the page, some.\nMore words of it.")
        assert html_text.main_text(f"<p>Words of the page, some.</p><{tag}><p>No words") == "Words of the page, some."
    formula = ("<article><p>As <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>a=2</annotation></math> holds, so all is well."
               "</p></article>")
    assert html_text.main_text(formula) == "As a=2 holds, so all is well."
    assert html_text.main_text("<head><title>T</title><body><p>Words of the page, some.") == "Words of the page, some."


def test_minimum_cut_matches_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]

        def cost(keep):
            return (sum(max(s, 0) for s, k in zip(scores, keep) if not k) + sum(max(-s, 0) for s, k in zip(scores, keep) if k)
                    + sum(c for a, b, c in edges if keep[a] != keep[b]))
        least = min(cost([x >> i & 1 == 1 for i in range(n)]) for x in range(1 << n))
        assert cost(html_text.minimum_cut(scores, edges)) == pytest.approx(least)


# --- quality rules ----------------------------------------------------------

def brute_counts(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen = Counter(zip(w, w[1:], w[2:], w[3:], w[4:]))
    inside = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


def test_counts_match_brute_force(spark):
    texts = [t for _, t, *_ in corner_rows()] + ["a b c d e a b c d e f", "x x x x x x x", "l\nl\n l\n\n\nl", "a*** b###\tc|<>", "É\u00a0é\x1cz \x0b q"]
    got = rules.count_texts(texts)
    for (_, r), t in zip(got.iterrows(), texts):
        assert tuple(r[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == brute_counts(t), t[:40]
    each = pd.concat([rules.count_texts([t]) for t in texts], ignore_index=True)
    pd.testing.assert_frame_equal(got, each)


def labelled(spark, n=240):
    good = [(k, prose(k, 60), "en", "a", 1) for k in range(n)]
    bad = [(n + k, prose(n + k, 60).upper() if k % 2 else " ".join(w + "***" for w in prose(n + k, 50).split()), "en", "a", 1) for k in range(n // 3)]
    df = spark.createDataFrame(good + bad, DOCS)
    labels = [(d, int(d < n), 0) for d, *_ in good + bad]
    return df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), n


LABELS = "doc_id long, quality int, toxic int"


def test_rules_learn_and_keep_clean_texts(spark):
    df, labels, n = labelled(spark)
    rows = rules.judge(df, labels).collect()
    assert all(r["kept"] == (r["doc_id"] < n) for r in rows)
    learned = rules.fit(rules.counts(df), labels)
    assert learned and all(name in rules.STATISTICS for rule in learned for name, _, _ in rule)


def brute_gain(values, bad, op, cut):
    keep = (values > cut) if op == ">" else (values <= cut)
    p0, n0, p, n = bad.sum(), (~bad).sum(), (keep & bad).sum(), (keep & ~bad).sum()
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else -np.inf


def test_rules_grow_by_the_best_of_all_conditions():
    """Against every threshold between two values of every statistic, one after another."""
    rng = np.random.default_rng(8)
    for trial in range(12):
        x = pd.DataFrame({name: rng.integers(0, 9, 150) / 2 for name in list(rules.STATISTICS)[:4]})
        bad = (x["words"].to_numpy() > 2) & (rng.random(150) < 0.8) | (rng.random(150) < 0.1)
        inside = np.ones(150, bool)
        for k, (name, op, cut) in enumerate(rules._grow(x, bad)):
            best = max(brute_gain(x[c].to_numpy()[inside], bad[inside], o, (a + b) / 2) for c in x.columns for o in (">", "<=")
                       for a, b in zip(sorted(set(x[c][inside])), sorted(set(x[c][inside]))[1:]))
            assert brute_gain(x[name].to_numpy()[inside], bad[inside], op, cut) == pytest.approx(best, abs=1e-5), (trial, k)
            inside &= rules._covers(x, [(name, op, cut)])


def test_learned_lists_cover_in_order_and_are_precise(spark):
    rng = np.random.default_rng(4)
    n = 900
    frame = pd.DataFrame({c: rng.integers(0, 60, n) for c in rules.COUNTS})
    frame["n_words"] += 10
    stats = pd.DataFrame({name: frame.eval(re.sub(r"greatest\((\w+), 1\)", r"\1.clip(1)", sql)) for name, sql in rules.STATISTICS.items()}).astype(float)
    bad = ((stats["symbols_per_word"] > 1.5) | (stats["words"] < 25) & (stats["caps_share"] > 0.5)).to_numpy()
    learned = rules.learn(stats, bad)
    assert learned
    left = np.ones(n, bool)
    for rule in learned:
        c = rules._covers(stats, rule) & left
        assert bad[c].mean() >= rules.LEAST_PRECISION and bad[c].sum() >= rules.LEAST_COVER and len(rule) <= rules.MAX_CONDITIONS
        left &= ~c
    assert (left == ~bad).mean() > 0.95
    got = spark.createDataFrame(frame.reset_index()).select("index", rules.as_expression(learned).alias("kept")).collect()
    assert {r["index"]: r["kept"] for r in got} == dict(enumerate(left.tolist()))


def test_rules_corners(spark):
    rows = rules.judge(corners(spark), empty(spark, LABELS)).collect()
    assert len(rows) == len(corner_rows()) and all(r["kept"] != r["base_failed"] for r in rows)
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in rows)
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 7, 0), (1, 1, 1), (1, 1, 1)], LABELS)
    assert rules.judge(corners(spark), odd).count() == len(corner_rows())
    assert rules.judge(empty(spark), odd).count() == 0


# --- license scan -------------------------------------------------------------

def brute_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
    low = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    said = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+(?:(?<=[0-9])\+(?![+]|[^\x00-\x2F\x3A-\x60\x7B-\x7F]))?", low)
    assert len(said) == len(words)
    joined = " " + " ".join(said) + " "
    places, base, found = [], set(), []
    for p, label in license_scan.PHRASES.items():
        parts = p.split()
        at = [i for i in range(len(words) - len(parts) + 1) if words[i:i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    for r in license_rules.rules():
        for m in re.finditer("(?<= )" + r.regex + "(?= )", joined):
            a = joined[:m.start()].count(" ") - 1
            found.append((a, a + m[0].count(" "), r.label, r.priority, r.confidence))
    kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and (e[3] > d[3] or e[3] == d[3] and e[1] - e[0] > d[1] - d[0]) for e in found)]
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d[2] for d in kept})), max([d[4] for d in kept], default=0.0))


def test_license_scan_matches_brute_force(spark):
    assert 300 < len(license_rules.rules())
    for r in license_rules.rules():
        assert any(g in r.regex for g in license_rules.GATE) or r.regex.replace(license_rules.NOTICE, "").startswith("cc by"), r
    texts = ["Licensed under the Apache License, Version 2.0.", "GNU General Public License v3 or any later version; gnu general public license",
             "cc by", "CC-BY-NC 4.0 and CC BY 3.0", "SPDX-License-Identifier: MIT", "The MIT License. the mit license THE MIT LICENSE", "mit licenses",
             "Permission is hereby granted, free of charge, to any person obtaining a copy", "ein Satz mit Lizenz", "GNU Lesser General Public License 2.1",
             "apache license " * 300, "\u212aopyleft \u0130 copyleft", "all rights reserved", "creative commons attribution-noncommercial 4.0 international",
             "GPLv2+ or LGPL-2.1+, not GPL 2++ nor GPL2+3; Apache 2.0+", "SPDX-License-Identifier: GPL-2.0+", "c++ 11+ warranty"]
    rows = corner_rows() + [(100 + k, t, "en", "a", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    got = [tuple(r) for r in license_scan.scan(df).drop("detections").collect()]
    assert got == [(r[0], *brute_scan(r[1])) for r in rows]
    assert license_scan.scan(empty(spark)).count() == 0 and license_scan.scan(corners(spark)).count() == len(corner_rows())


def test_every_sentence_is_found_and_a_plus_is_or_later(spark):
    def plain(regex):
        while re.search(r"\(\?:[^()]*\)", regex):  # the first choice, and what is optional left out
            regex = re.sub(r"\(\?:([^()|]*)[^()]*\)(\?|\{0,\d+\})?", lambda m: "" if m[2] else m[1].replace("[^ ]+ ", "some ") , regex, count=1)
            regex = re.sub(r"(some |x )\{1,8\}", r"\1", regex)
        return re.sub(r"(\[cs\])|.\?", lambda m: "s" if m[1] else "", regex)
    texts = {f"{k}": (label, plain(regex)) for k, (label, _, regex) in enumerate(license_rules.SENTENCES)}
    rows = [(int(k), f"Some words. {t} and more", "en", "a", 1) for k, (_, t) in texts.items()]
    plus = {"GPLv2+": "gpl-2.0-or-later", "LGPL-2.1+": "lgpl-2.1-or-later", "GNU GPL version 3+.": "gpl-3.0-or-later",
            "SPDX-License-Identifier: AGPL-3.0+": "agpl-3.0-or-later", "Apache 2.0+": "apache-2.0", "GPL 2 + MPL 1.1": "gpl-2.0,mpl-1.1"}
    rows += [(1000 + k, t, "en", "a", 1) for k, t in enumerate(plus)]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    missing = [t for k, (label, t) in texts.items() if not got[int(k)]["detections"]]
    assert not missing
    assert {t: got[1000 + k]["labels"] for k, t in enumerate(plus)} == plus


# --- token output ---------------------------------------------------------------

def test_short_names_and_identifiers(spark):
    want = {"GPLv2": "gpl-2.0", "GNU GPL": "gpl", "LGPL 2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0", "MPL 2.0": "mpl-2.0", "Apache 2.0": "apache-2.0",
            "MIT licensed": "mit", "MPLv2.0": "mpl-2.0", "EPL-2.0": "epl-2.0", "GPL v3 or later": "gpl-3.0-or-later",
            "released under the MPL": "mpl", "LGPL-2.1-only": "lgpl-2.1-only", "GNU GPL version 2": "gpl-2.0", "CDDL": "cddl",
            "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later", "SPDX-License-Identifier: AGPL-3.0-only": "agpl-3.0-only",
            "SPDX-License-Identifier: GPL-2.0": "gpl-2.0", "SPDX-License-Identifier: MIT": "mit", "GNU Lesser General Public License v2.1 only": "lgpl-2.1-only",
            "for example a simple reply": "", "the apache 2.0.55 server": "", "replication": "", "a MPL": ""}
    docs = spark.createDataFrame([(k, f"x {t}, y", "en", "a", 1) for k, t in enumerate(want)], DOCS)
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(docs).collect()}
    assert {t: got[k] for k, t in enumerate(want)} == want


def test_gate_admits_what_any_rule_matches():
    for label, keyword, *_ in license_rules.SHORT:
        assert any(w in keyword for w in license_rules.GATE) or any(
            w == keyword and all(re.search(rx, t) for t in (w, f"{w}v2.0", f"x {w.upper()}-2", f"{w}2 x"))
            for w, rx in license_rules.PAIRS)


def test_blocks_round_trip_alone_and_together():
    rng = np.random.default_rng(2)
    ids = (rng.zipf(1.3, 9000) % 700).astype(np.int64)
    tree = rangecoder.Tree.of_counts(*np.unique(ids, return_counts=True))
    blocks = [ids[:1], ids[:0], ids[5:2000], ids[2000:6096], ids[:3]]
    coded = rangecoder.encode_blocks(tree, blocks)
    for one, b in zip(coded, blocks):
        assert (rangecoder.decode_blocks(tree, [one], [len(b)])[0] == b).all()
    assert coded[2] == rangecoder.encode_blocks(tree, [blocks[2]])[0]
    assert 8 * len(coded[3]) < 16 * len(blocks[3]) * 0.8
    lone = rangecoder.Tree.of_counts(np.array([2]), np.array([5]))
    two = np.full(7, 2)
    assert (rangecoder.decode_blocks(lone, rangecoder.encode_blocks(lone, [two]), [7])[0] == two).all()


def test_blocks_are_long_enough_for_contexts_to_come_again():
    rng = np.random.default_rng(5)
    step = rng.integers(0, 300, (300, 2))
    ids = [0]
    for turn in rng.integers(0, 2, 16383):
        ids.append(int(step[ids[-1], turn]))
    ids = np.array(ids)
    tree = rangecoder.Tree.of_counts(*np.unique(ids, return_counts=True))
    size = lambda n: sum(map(len, rangecoder.encode_blocks(tree, [ids[i:i + n] for i in range(0, len(ids), n)])))
    assert size(tokenout.BLOCK) < 0.9 * size(1024)


def test_an_id_takes_one_mixed_decision(monkeypatch):
    rng = np.random.default_rng(4)
    ids = (rng.zipf(1.2, 3000) % 5000).astype(np.int64)
    tree = rangecoder.Tree.of_counts(*np.unique(ids, return_counts=True))
    predict, steps = rangecoder._Model.predict, []
    monkeypatch.setattr(rangecoder._Model, "predict", lambda *a: steps.append(1) or predict(*a))
    blocks = [ids[:1000], ids[1000:1900], ids[1900:]]
    coded = rangecoder.encode_blocks(tree, blocks)
    assert len(steps) == 1100
    assert all((a == b).all() for a, b in zip(rangecoder.decode_blocks(tree, coded, [1000, 900, 1100]), blocks))
    assert len(steps) == 2200


def test_frequencies_after_an_id_shorten_blocks_and_rare_ids_come_back():
    rng = np.random.default_rng(6)
    after = rng.integers(0, 90_000, (200, 40))
    ids = [0]
    for turn in rng.integers(0, 40, 40_000):
        ids.append(int(after[ids[-1] % 200, turn]))
    ids = np.array(ids)
    symbols, counts = np.unique(ids, return_counts=True)
    number, top = np.arange(symbols[-1] + 1), rangecoder.by_rank(symbols, counts)[:rangecoder.branches(len(symbols))]
    last, symbol = ids[:-1][np.isin(ids[:-1], top)], ids[1:][np.isin(ids[:-1], top)]
    pair, n = np.unique(np.stack([last, symbol]), axis=1, return_counts=True)
    trees = [rangecoder.Tree.of_counts(symbols, counts), rangecoder.Tree.of_counts(symbols, counts, (*pair, n, counts[np.searchsorted(symbols, pair[0])]))]
    blocks, sizes = [ids[i:i + 4096] for i in range(0, len(ids), 4096)], []
    for tree in trees:
        coded = rangecoder.encode_blocks(rangecoder.Tree(*tree.rows), blocks)
        assert all((a == b).all() for a, b in zip(rangecoder.decode_blocks(tree, coded, list(map(len, blocks))), blocks))
        sizes.append(sum(map(len, coded)))
    assert sizes[1] < 0.95 * sizes[0] and len(number) > 1 << 16
    many = rng.integers(0, 150_000, 200_000)
    tree = rangecoder.Tree.of_counts(*np.unique(many, return_counts=True))
    assert tree.high and (rangecoder.decode_blocks(tree, rangecoder.encode_blocks(tree, [many[:5000]]), [5000])[0] == many[:5000]).all()


def test_frequencies_fill_their_scale():
    for counts in ([1], [0], [1] * (1 << 14), [1] * 40_000, [10 ** 12, 1, 1], list(range(1, 3000))):
        found = rangecoder.scaled(np.array(counts), sum(counts))
        assert found.sum() == 1 << rangecoder.SCALE and found[0] > 0 and (found >= 0).all()


def test_pairs_are_counted_across_documents_after_an_end_id(spark, monkeypatch):
    monkeypatch.setattr(tokenout, "PAIRS", 5)
    docs = [[5, 6, 5, 6, 2], [2], [6, 6, 2], [5, 2]]
    found = spark.createDataFrame([(np.array(d, "<u2").tobytes(),) for d in docs], "ids binary").coalesce(1)
    symbols, counts = np.unique(np.concatenate(docs), return_counts=True)
    want = Counter((a, b) for d in docs for a, b in zip([2, *d], d))
    got = tokenout.pair_counts(found, "<u2", 2, symbols, counts)
    assert Counter({(a, b): n for a, b, n, _ in zip(*(x.tolist() for x in got))}) == want
    assert all(dict(zip(symbols.tolist(), counts.tolist()))[a] == w for a, _, _, w in zip(*(x.tolist() for x in got)))


def test_frames_tell_damage():
    data = tokenout.frame(np.array([5, 6, 7]), b"payload", 10, 4, [(None, 1, False, True), (-3, 2, True, False)])
    assert tokenout.parse(data)[4] == [(None, 1, False, True), (-3, 2, True, False)]
    for k in (0, 9, len(data) - 1):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            tokenout.parse(bytes(broken))


def test_checksums_join():
    a, b = b"some bytes", b"\0more" * 1000
    assert tokenout.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert tokenout.joined_crc(zlib.crc32(a), 0, 0) == zlib.crc32(a) and tokenout.joined_crc(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


def test_pieces_encode_as_whole_texts():
    rng = random.Random(1)
    encoder = tokenout.Encoder(tokenout.tokenizer_path(), 2)
    letters = "aA bB\n\t \u0301éİΣσςK'sdm,.!<|>01\u200b\u2028\u3000漢😀\x1c\x85e"
    for _ in range(3000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) + rng.choice(["", "<|endoftext|>x <|startoftext|>"])
        assert list(np.frombuffer(encoder.batch([s])[0], encoder.kind)) == encoder.tokenizer.encode(s, add_special_tokens=False).ids + [2]


def test_a_word_is_one_piece_however_it_is_written():
    encoder = tokenout.Encoder(tokenout.tokenizer_path(), 2)
    encoder.batch(["Word word, WORD. W\u00d6rd w\u00f6rd;\nword"])
    assert set(encoder.known) == {"", "word", "w\u00f6rd", ",", ".", ";"}


def test_marks_of_all_kinds_are_cut_off_words_and_words_met_before_are_kept(monkeypatch):
    encoder = tokenout.Encoder(tokenout.tokenizer_path(), 2)
    encoder.batch(["some$$$ words&& \u00e9t\u00e9* (and)"])
    assert set(encoder.known) == {"", "some", "$$$", "words", "&&", "\u00e9t\u00e9", "*", "(and", ")"}
    monkeypatch.setattr(tokenout, "REMEMBERED", 4)
    learned, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda p: learned.extend(p) or learn(p))
    for text in ("words new", "some other", "words"):
        assert np.frombuffer(encoder.batch([text])[0], encoder.kind).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert learned == ["new", "other"]


def test_folded_pieces_encode_as_whole_texts():
    rng = random.Random(2)
    encoder = tokenout.Encoder(tokenout.tokenizer_path(), 2)
    parts = [chr(c) for c in range(256)] + ["The", "sAy's", "I'LL,", "H\u0331", "H.\u0331", "x.,;", "..", "<|ENDOFTEXT|>", "<|endoftext|>", "\u0130", "\u03a3.", "\u037e"] * 8
    for _ in range(1000):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4)] + [None]
        for s, got in zip(texts, encoder.batch(texts)):
            assert np.frombuffer(got, encoder.kind).tolist() == encoder.tokenizer.encode(s or "", add_special_tokens=False).ids + [2]
    assert encoder.batch([]) == []


def test_only_what_the_tokenizer_folds_is_folded(monkeypatch):
    from tokenizers import Tokenizer
    from tokenizers.normalizers import NFC
    cased = Tokenizer.from_file(tokenout.tokenizer_path())
    cased.normalizer = NFC()
    monkeypatch.setattr(Tokenizer, "from_file", lambda path: cased)
    encoder = tokenout.Encoder("cased", 2)
    s = "Some WORDS, cased."
    assert not encoder.folds and np.frombuffer(encoder.batch([s])[0], encoder.kind).tolist() == cased.encode(s, add_special_tokens=False).ids + [2]


def test_blocks_share_a_partition_up_to_a_batch(spark, scratch):
    full = tokenout.PART_BLOCKS * tokenout.BLOCK
    assert [tokenout.partitions(n, tokenout.BLOCK, 6) for n in (0, full // 100, full, 10 * full, 10 * full + 1)] == [1, 1, 5, 10, 11]
    docs = spark.range(400).selectExpr("id doc_id", "concat('word ', id) text")
    tokenout.write(docs, scratch + "/ids", block=32)
    assert spark.read.parquet(scratch + "/ids/blocks").select("part").distinct().count() == 1
    assert [r["doc_id"] for r in tokenout.read(spark, scratch + "/ids").orderBy("start").collect()] == list(range(400))


def test_written_ids_read_back(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenout.tokenizer_path())
    rows = tokenout.write_and_read(corners(spark), block=512, lanes=8).orderBy("start").collect()
    assert len(rows) == len(corner_rows())
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in corner_rows()), key=lambda d: (d is not None, d or 0))
    start, want = 0, Counter()
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    for d, t, *_ in corner_rows():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    assert tokenout.write_and_read(empty(spark)).count() == 0


# --- classifier -------------------------------------------------------------------

def test_classifier_on_held_out_rows(spark):
    df, labels, n = labelled(spark)
    rows = subword.classify(df, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 30 and sum(r["predicted"] == (r["doc_id"] < n) for r in held) >= 0.97 * len(held)
    kept = subword.accepted(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["predicted"]}


def test_training_equals_dense_matrix_steps(monkeypatch):
    """The same steps on whole rows of a documents-by-buckets matrix."""
    monkeypatch.setattr(subword, "BUCKETS", 40)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (25, 40)) * (rng.random((25, 40)) < 0.4)
    x[3] = 0  # a text without features
    y = rng.integers(0, 2, 25)
    bags = subword.Bags.of((int(y[i]), np.flatnonzero(x[i]), x[i][x[i] > 0]) for i in range(25))
    scores, bias = subword.train(bags, 0.7, epochs=4, rate=0.5, seed=3)
    draw = np.random.default_rng(3)
    v, out, b = draw.uniform(-1 / subword.DIM, 1 / subword.DIM, (40, subword.DIM)), np.zeros((subword.DIM, 2)), np.zeros(2)
    step = 0
    for _ in range(4):
        for i in draw.permutation(25):
            lr, step = 0.5 * (1 - step / 100), step + 1
            share = x[i] / max(x[i].sum(), 1)
            mean = share @ v
            p = np.exp(mean @ out + b) / np.exp(mean @ out + b).sum() - np.eye(2)[y[i]]
            v, out, b = v - lr * np.outer(np.sqrt(share), out @ p), out - lr * np.outer(mean, p), b - 0.1 * lr * p
    want = v @ (out[:, 1] - out[:, 0])
    ones = y.sum()
    assert scores == pytest.approx(want, abs=1e-4)
    assert bias == pytest.approx(b[1] - b[0] + np.log(0.7 / 0.3) - np.log((ones + 1) / (26 - ones)), abs=1e-4)


def test_classifier_is_trained_in_one_task_of_a_bounded_sample(spark):
    df, labels, n = labelled(spark)
    scores, bias = subword.fit(df, labels)
    assert len(scores) == subword.BUCKETS and scores.dtype == np.float32
    again, same = subword.fit(df.repartition(7), labels.repartition(3))
    assert (again == scores).all() and same == bias


def test_classifier_corners(spark):
    rows = subword.classify(corners(spark), empty(spark, LABELS)).collect()
    assert len(rows) == len(corner_rows()) and {r["score"] for r in rows} == {0.5}
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    ones = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(None, 0, 0), (1, None, 1)], LABELS)
    assert all(0.7 < r["score"] < 1 for r in subword.classify(corners(spark), ones).collect())
    assert subword.classify(empty(spark), ones).count() == 0
    assert subword.accepted(corners(spark), ones).columns == corners(spark).columns


# --- ids ------------------------------------------------------------------------------

def test_long_ids_beside_nulls_stay_as_they_are(spark):
    from strata.llm import decontaminate
    big = (1 << 62) + 1
    df = spark.createDataFrame([(big, prose(7, 40), "en", "a", 1), (None, prose(7, 40), "en", "a", 1)], DOCS).coalesce(1)
    bench = spark.createDataFrame([(big + 2, prose(7, 40)), (None, prose(7, 40))], "item_id long, text string")
    for out in (rules.counts(df), tokenout.write_and_read(df)):
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == {big, None}
    got = decontaminate.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(big, big + 2), (None, big + 2)}

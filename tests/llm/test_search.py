import math
import re
from collections import Counter

import pytest

from strata.llm import search
from strata.llm.common import table
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    docs = [(d, terms(t)) for d, t in docs if terms(t)]
    n, whole = len(docs), sum(len(t) for _, t in docs)
    counts = [Counter(t) for _, t in docs]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, t), c in zip(docs, counts):
            m = 75 + 25 * len(t) * n // whole
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10 ** 9 * c[x] // (1000 * c[x] + 12 * m))
                    for x in terms(text) if x in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def run(df, items, k=20, **sizes):
    return sorted((tuple(r) for r in search.search(search.build(df, **sizes), items, k).collect()), key=str)


@pytest.mark.parametrize("text", ["", None, "A-b c_d", "Ünï çÀ É1 x2y", "a\x00b\x7fc", "漢字 ok😀ok", "don't  STOP", "İK"])
def test_terms(text):
    assert [t.decode() for t in search.terms_of(text)] == terms(text)


def test_corner_rows(spark):
    items = [(1, "Another text with the ID, the id two two"), (1, prose(1, 30)), (2, None), (None, "no words here"), (4, "unheard")]
    frame = spark.createDataFrame(items, ITEMS)
    docs = [(r[0], r[1]) for r in corner_rows()]
    assert run(corners(spark), frame) == brute(docs, items)
    assert run(corners(spark), frame, k=2) == brute(docs, items, 2)
    assert run(empty(spark), frame) == [] and run(corners(spark), empty(spark, ITEMS)) == []


@pytest.mark.parametrize("segment", [40, 1 << 20])
def test_many_strata_segments_and_ties(spark, monkeypatch, segment):
    """One stratum with most documents, copies with equal scores, long ones alone in theirs."""
    rows = [(k, prose(k % 23, 12 if k % 3 else 5 + k % 90), "en", "s", 1) for k in range(240)]
    rows += [(500 + k, "amber amber basin of the same text", "en", "s", 1) for k in range(50)]
    rows += [(900, prose(4, 2000), "en", "s", 1), (900, prose(5, 2000), "en", "s", 1)]
    items = [(k, prose(k, 9) + " amber amber " * (k % 2)) for k in range(12)]
    monkeypatch.setattr(search, "FIRST", 2)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 5)
    got = run(spark.createDataFrame(rows, DOCS).repartition(6), spark.createDataFrame(items, ITEMS), segment_terms=segment)
    assert got == brute([(r[0], r[1]) for r in rows], items)


def test_segments_hold_one_stratum_and_keep_to_their_size(spark):
    rows = [(k, prose(k, 10 + k % 4), "en", "s", 1) for k in range(300)]
    index = search.build(spark.createDataFrame(rows, DOCS), segment_terms=100)
    got = index.postings.collect()
    per = {}
    for r in got:
        per.setdefault(r["segment"], []).append(r)
    assert sum(len(r["docs"]) for r in got if not r["term"]) == 300
    for part in per.values():
        assert len({r["m"] for r in part}) == 1
        assert sum(t * n for r in part for t, n in zip(r["tfs"], [b - a for a, b in zip([0, *r["ends"]], r["ends"])])) <= 100
        for r in part:
            assert r["tfs"] == sorted(set(r["tfs"])) and (not r["term"] or r["ends"][-1] == len(r["docs"]))


def test_given_documents(spark):
    docs, items = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    assert run(docs, items) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])

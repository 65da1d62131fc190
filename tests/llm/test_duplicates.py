import itertools
import re

import numpy as np
import pytest
import xxhash

from strata.llm import decontaminate, graph, simhash
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(prints, bits):
    label = list(range(len(prints)))
    near = [p for p in itertools.combinations(range(len(prints)), 2) if (prints[p[0]] ^ prints[p[1]]).bit_count() <= bits]
    while True:
        old = list(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if label == old:
            return label


def test_fingerprints_follow_the_definition(spark):
    for _, t, *_ in corner_rows():
        assert simhash.fingerprint_of(t) == brute_print(t)
    assert simhash.fingerprint_of("ÀB Cd") == brute_print("ÀB Cd")


def test_every_four_positions_hold_an_indexed_set():
    for bits in range(8):
        sets = simhash.position_sets(bits)
        for c in itertools.combinations(range(8), 8 - bits):
            assert any(set(t) <= set(c) for t in sets)


def test_corner_rows(spark):
    rows = simhash.near_duplicates(corners(spark)).collect()
    assert len(rows) == len(corner_rows())
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in rows}
    assert by[(3, f"{brute_print(prose(1, 60)):016x}")] == 1
    zero = "0" * 16
    assert by[(4, zero)] == by[(5, zero)] == by[(6, zero)] == by[(None, zero)] == 4
    assert [r["component_id"] for r in rows if r["doc_id"] == 8] == [8, 8]
    assert any(r["doc_id"] is None and r["component_id"] is None for r in rows)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.first_of_each(corners(spark))
    assert kept.columns == corners(spark).columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in kept.select("doc_id", "text").collect() if r["text"])
    assert [g[0] for g in got] == [0, 1, 2, 2, 7, 8, 9]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["None", "1", "2", "2", "4", "7", "8", "9"])
    assert simhash.first_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("posting", [8192, 40])
def test_links_of_dense_fingerprints_match_brute_force(spark, posting):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.int64)
    prints = set()
    for k in range(260):
        x = int(centres[k % 3])
        for b in rng.integers(0, 64, int(rng.integers(0, 6))):
            x ^= 1 << int(b)
        prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "f long")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(df, 4, posting)).collect()}
    label = brute_components([p & simhash.FULL for p in prints], 4)
    groups = {}
    for p, k in zip(prints, label):
        groups.setdefault(k, []).append(p)
    for members in groups.values():
        assert {roots.get(p, p) for p in members} == {min(members)}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 299)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 140)} == {100} and got[300] == 299


BENCH = "item_id long, text string"


def tokens(text):
    return re.findall(r"[a-z0-9_\u0080-\U0010ffff]+", (text or "").lower())


def brute_overlap(a, b, similarity, least):
    """Longest stretch on any diagonal in which enough tokens agree."""
    best = 0
    for d in range(-len(b) + 1, len(a)):
        same = [a[i] == b[i - d] for i in range(max(0, d), min(len(a), d + len(b)))]
        for i in range(len(same)):
            for j in range(i + max(best, least - 1) + 1, len(same) + 1):
                if sum(same[i:j]) >= similarity * (j - i) - 1e-9:
                    best = max(best, j - i)
    return best


def test_contamination_matches_brute_force(spark):
    items = [(0, prose(50, 30)), (1, prose(51, 16)), (2, prose(52, 8)), (3, None), (4, ""), (5, "too short"), (6, prose(50, 30))]
    w = prose(50, 30).split()
    swapped = " ".join("other" if i % 6 == 5 else x for i, x in enumerate(w))
    docs = [
        (1, prose(1, 40) + " " + items[0][1] + ". " + prose(2, 40), "en", "a", 1),
        (2, prose(3, 30) + " " + swapped.upper() + "! " + prose(4, 30), "en", "a", 1),
        (3, prose(5, 90), "en", "a", 1),
        (4, "x " + items[2][1], "en", "a", 1),
        (5, " ".join(w[:8]) + " " + prose(6, 40), "en", "a", 1),
        (6, items[1][1], "en", "a", 1), (6, items[1][1], "en", "a", 1), (7, None, None, None, None), (8, "", "en", "a", 0),
        (None, "before " + items[1][1] + " after", "en", "a", 1),
    ]
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)
    got = {(r["doc_id"], r["item_id"]): r["overlap"] for r in decontaminate.contaminated(df, bench).collect()}
    want = {}
    for d, t, *_ in docs:
        for i, b in items:
            a, b = tokens(t), tokens(b)
            if len(b) >= 5:
                n = brute_overlap(a, b, 0.8, min(12, len(b)))
                if n >= min(12, len(b)):
                    want[(d, i)] = n
    assert got == want
    assert {d for d, _ in got} == {1, 2, 4, 6, None}
    kept = decontaminate.clean(df, bench)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "5", "7", "8"]


@pytest.mark.parametrize("n", range(5, 24))
def test_masks_leave_a_window_of_any_near_copy(n):
    """Every choice of places: the most substitutions that 80 % agreement allows."""
    masks = decontaminate.masks_for(n)
    for gone in itertools.combinations(range(n), n - -(-4 * n // 5)):
        assert any(all(i + j not in gone for j, kept in enumerate(m) if kept == "1")
                   for m in masks for i in range(n - len(m) + 1)), (n, gone)


def test_random_substitutions_match_brute_force(spark):
    rng = np.random.default_rng(11)
    items = [(n, prose(200 + n, n)) for n in range(5, 21)]
    docs = []
    for n, text in items:
        for k in range(n // 4 + 2):
            w = text.split()
            for i in rng.permutation(n)[:k]:
                w[i] = f"changed{n}"
            docs.append((100 * n + k, " ".join([prose(300 + n, 9), *w, prose(400 + k, 9)]), "en", "a", 1))
    got = {(r["doc_id"], r["item_id"]): r["overlap"] for r in decontaminate.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()}
    want = {}
    for d, t, *_ in docs:
        for i, b in items:
            n = brute_overlap(tokens(t), tokens(b), 0.8, min(12, len(tokens(b))))
            if n >= min(12, len(tokens(b))):
                want[(d, i)] = n
    assert len(want) > len(items)
    assert got == want


@pytest.mark.parametrize("period", [1, 2, 3])
def test_repeated_tokens_match_brute_force(spark, period):
    words = ["aa", "bb", "cc"][:period]
    say = lambda n: " ".join(words[k % period] for k in range(n))
    items = [(0, say(15)), (1, say(40) + " and then something else"), (2, say(5)), (3, "never " + say(11))]
    docs = [(1, prose(1, 20) + " " + say(70) + " " + prose(2, 20), "en", "a", 1), (2, say(9), "en", "a", 1), (3, say(14), "en", "a", 1)]
    got = {(r["doc_id"], r["item_id"]): r["overlap"] for r in decontaminate.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()}
    want = {(d, i): n for d, t, *_ in docs for i, b in items
            if (n := brute_overlap(tokens(t), tokens(b), 0.8, min(12, len(tokens(b))))) >= min(12, len(tokens(b)))}
    assert got == want and want


def test_a_token_repeated_very_often_takes_little_memory():
    """20,000 equal tokens against an item of 15: one pair, its diagonals found and verified in it."""
    import tracemalloc
    h, _ = decontaminate.token_hashes(["same " * 20_000])
    b, _ = decontaminate.token_hashes(["same " * 15])
    w = [(decontaminate.window_hashes(x, m), x) for m in decontaminate.MASKS for x in (h, b)]
    tracemalloc.start()
    at = decontaminate.diagonals(np.concatenate([x for x, _ in w[::2]]), np.concatenate([np.arange(len(x)) for x, _ in w[::2]]),
                                 np.concatenate([x for x, _ in w[1::2]]), np.concatenate([np.arange(len(x)) for x, _ in w[1::2]]))
    assert 19_900 < len(at) < 20_020 and decontaminate.best_stretch(h, b, at, 0.8) == (15, 15)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_bitmap_grows_with_the_benchmark_within_its_bounds():
    assert decontaminate.bitmap_bits(0) == decontaminate.bitmap_bits(1000) == 16
    assert decontaminate.bitmap_bits(40_000) == 21 and decontaminate.bitmap_bits(10 ** 9) == 28
    for bits in (16, 21, 28):
        assert all(0 <= s and s + bits <= 64 for s in decontaminate._probes(bits))


def test_benchmark_columns_may_clash(spark):
    from pyspark.sql import functions as F
    bench = spark.createDataFrame([(1, prose(99, 30))], BENCH).withColumns(
        {c: F.lit("clash") for c in ("t", "h", "hash", "hashes", "places", "tokens", "region", "short", "doc_id")})
    assert [tuple(r) for r in decontaminate.contaminated(corners(spark), bench).select("doc_id", "item_id").collect()] == [(8, 1)]


def test_decontamination_corners(spark):
    none = spark.createDataFrame([], BENCH)
    assert decontaminate.contaminated(corners(spark), none).count() == 0
    assert decontaminate.clean(corners(spark), none).count() == len(corner_rows())
    some = spark.createDataFrame([(1, prose(99, 30))], BENCH)
    assert decontaminate.contaminated(empty(spark), some).count() == 0
    assert [tuple(r) for r in decontaminate.contaminated(corners(spark), some).select("doc_id", "item_id").collect()] == [(8, 1)]
    kept = decontaminate.clean(corners(spark), some)
    assert kept.columns == corners(spark).columns and kept.count() == len(corner_rows()) - 2

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, sharding
from strata.llm.common import numbered, permute
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation_is_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(permute(F.col("id"), F.lit(n).cast("long"), "s")).collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        assert sum(abs(a - i) < 10 for i, a in enumerate(got)) < 60


def test_numbered_gives_positions_and_running_sums(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    rows = numbered(df, ["k"], {"before": "v"}, row="at").orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(500))
    total = 0
    for r in rows:
        assert r["before"] == total
        total += r["v"]
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_shards_cover_all_rows(spark):
    rows = sharding.shard(corners(spark), shards=4).collect()
    assert len(rows) == len(corner_rows())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in corner_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    assert sorted(map(str, rows)) == sorted(map(str, sharding.shard(corners(spark), shards=4).collect()))


def test_empty_tables(spark):
    assert sharding.shard(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0


def brute_targets(sizes, most=3):
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, out, open_ = sum(sizes.values()), {}, dict(sizes)
    while True:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            del open_[s]


def brute_seats(target, house):
    order = sorted(target, key=lambda s: (s is None, (s or "").encode()))
    quotients = sorted(((-target[s] / (2 * k + 1), order.index(s)) for s in order if target[s] > 0 for k in range(house)))
    return Counter(order[i] for _, i in quotients[:house])


def test_mix_meets_targets_and_brute_force_quotas(spark):
    rows = mixing.mix(corners(spark), block_words=16).collect()
    assert len(rows) == len(corner_rows())
    sizes = defaultdict(int)
    for _, t, _, s, _ in corner_rows():
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    blocks = {s: max(-(-n // 16), min(n, 64)) for s, n in sizes.items()}
    claims = {s: want[s] * blocks[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}
    seats = brute_seats(claims, max(1, int(sum(claims.values()) + 0.5)))
    for s in sizes:
        assert next(r["seats"] for r in rows if r["source"] == s) == min(seats[s], 3 * blocks[s])
        assert abs(taken[s] - want[s]) <= 0.05 * want[s]
    again = mixing.mix(corners(spark), block_words=16).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_quotas_of_shards_add_up(spark):
    target = {"a": 5000.0, "b": 2500.0, "c": 2490.0, "d": 10.0}
    df = spark.createDataFrame([(s, int(3 * t), k, t) for k, (s, t) in enumerate(target.items())],
                               "source string, source_size long, rank long, target double")
    rows = {r["source"]: r for r in mixing.quotas(df, block_words=10, shards=8).collect()}
    claims = {s: r["claim"] for s, r in rows.items()}
    assert {s: r["blocks"] for s, r in rows.items()} == {"a": 1500, "b": 750, "c": 747, "d": 30}
    house = int(sum(claims.values()) + 0.5)
    for s, r in rows.items():
        assert sum(r["quotas"]) == r["seats"] and min(r["quotas"]) >= 0
    upto = Counter()
    for i in range(8):
        for s in target:
            upto[s] += rows[s]["quotas"][i]
        assert upto == brute_seats(claims, house * (i + 1) // 8)


@pytest.mark.parametrize("small, want", [((40, 4, 50), (120, 12, 150)), ((1, 33, 31), (3, 99, 93))])
def test_small_sources_reach_their_targets(spark, small, want):
    rows = [(0, prose(0, 5000), "en", "z", 1)] + [(k + 1, prose(k, n), "en", "abc"[k], 1) for k, n in enumerate(small)]
    got = {r["source"]: r for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    for s, n in zip("abc", want):
        assert got[s]["target"] == n and abs(got[s]["taken"] - n) <= 0.05 * n
    rest = 5000 + sum(small) - sum(want)
    assert got["z"]["target"] == rest and abs(got["z"]["taken"] - rest) <= 0.05 * rest
    mixed = {r["doc_id"] for r in mixing.mixed_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert mixed == {0, 1, 2, 3}


def test_mixed_documents_hold_the_taken_words(spark):
    docs = corners(spark)
    taken = Counter()
    for r in mixing.mix(docs, block_words=16).collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"]) and r["_row"] == "clash"
    assert +got == +taken


def test_one_source_and_no_words(spark):
    one = spark.createDataFrame([(k, prose(k, 40), "en", "a", 1) for k in range(5)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = mixing.mix(one, block_words=8).collect()
    assert {r["target"] for r in rows} == {200.0} and sum(r["taken"] for r in rows) == 200
    none = spark.createDataFrame([(1, "", "en", "a", 1), (2, None, "en", "b", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r["target"], r["taken"]) for r in mixing.mix(none).collect()} == {(0.0, 0)}

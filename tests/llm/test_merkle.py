import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.common import table
from tests.llm.frames import DOCS, corner_rows, corners, empty


def H(t):
    return sha256(t.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H("".join(part(v) for v in (doc_id, source, lang, n_chars, text)))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k:k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def chain(lv, pos):
    out = []
    for row in lv[:-1]:
        a = pos // 3 * 3
        out.append((row[a:pos], row[pos + 1:a + 3]))
        pos //= 3
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append(levels([leaf(*r) for r in by[s]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for pos, r in enumerate(by[s]):
            d, text = r[0], r[1]
            if d is not None and text is not None and zlib.crc32(str(d).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now, sibs = leaf(d, text, *r[2:]), chain(trees[k], pos) + chain(top, k)
            for a, b in sibs:
                now = H("".join(a) + now + "".join(b))
            out.append((d, leaf(*r), trees[k][-1][0], top[-1][0], H("".join("".join(a + b) for a, b in sibs)), now, now == top[-1][0]))
    return sorted(out, key=str)


def run(df, wanted=None):
    m = merkle.build(df, merkle.without_line_ends())
    return m, sorted((tuple(r) for r in merkle.prove(m, wanted, with_proofs=False).collect()), key=str)


def test_corner_rows_equal_brute_force(spark):
    _, got = run(corners(spark))
    assert got == brute(corner_rows())


@pytest.mark.parametrize("span", [1, 2])
def test_trees_over_many_chunks(spark, monkeypatch, span):
    """Chunks of 3 or 9 leaves: several rounds of levels, one source with most rows, many with one."""
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "CHUNK", 3 ** span)
    rows = [(k, f"line {k}\nand\n{k % 5}" if k % 4 else None, "en", "hot" if k % 3 else f"s{k % 13}", k) for k in range(140)]
    rows += [(k % 3, "the same row", "en", None, 7) for k in range(12)]
    _, got = run(spark.createDataFrame(rows, DOCS).repartition(5))
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_one_leaf_is_the_root(spark):
    _, got = run(spark.createDataFrame([(5, "a\nb", "en", "s", 3)], DOCS))
    assert got == brute([(5, "a\nb", "en", "s", 3)])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == H("")


def test_empty_table(spark):
    assert run(empty(spark))[1] == []


def test_some_leaves_fetch_the_least_and_prove_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 2)
    monkeypatch.setattr(merkle, "CHUNK", 9)
    rows = [(k, f"t{k}\n", "en", f"s{k % 4}", k) for k in range(100)]
    m, got = run(spark.createDataFrame(rows, DOCS), F.col("doc_id").isin(3, 7, 11, 40, 41, 99))
    assert got == [r for r in brute(rows) if r[0] in (3, 7, 11, 40, 41, 99)]
    proof = {r["doc_id"]: r for r in merkle.prove(m, F.col("doc_id") == 40).collect()}[40]
    assert H("".join(proof["proof"])) == proof["proof_sha256"]


def test_missing_coordinates_are_minimal():
    for n in (1, 2, 3, 4, 10, 27, 28, 100):
        rng = np.random.default_rng(n)
        for known in (np.arange(n), rng.choice(n, max(1, n // 4), replace=False), np.array([n - 1])):
            have, want, width, level = set(known.tolist()), set(), n, 0
            while width > 1:
                for p in have:
                    want |= {(level, q) for q in range(p // 3 * 3, min(p // 3 * 3 + 3, width)) if q not in have}
                have, width, level = {p // 3 for p in have}, -(-width // 3), level + 1
            assert set(merkle.missing(known, n)) == want
        assert merkle.missing(np.arange(n), n) == []


def test_tampering_is_found_in_the_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    _, got = run(docs)
    assert got == brute(rows)
    touched = {r[0] for r in rows if r[1] and "\n" in r[1] and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert touched == {r[0] for r in got if not r[-1]} and touched

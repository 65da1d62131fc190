import itertools
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from strata.llm import packing
from strata.llm.common import table
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose

TOKENIZER = Tokenizer.from_file(packing.tokenizer_path())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(rows, docs, length=packing.LENGTH):
    """Each id in exactly one piece, sequences without gaps, none padded."""
    seen, whole = {}, {}
    for r in rows:
        assert 0 < r["length"] <= length and r["offset"] + r["length"] <= length
        seen.setdefault(r["sequence_id"], []).append(r)
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert sorted(seen) == list(range(len(seen)))
    sizes = []
    for s in sorted(seen):
        at = 0
        for r in sorted(seen[s], key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or at & (at - 1) == 0
        sizes.append(at)
    assert sum(x != length for x in sizes) <= length.bit_length() and sum(sizes) == sum(len(ids_of(t)) for _, t in docs)
    want = {}
    for d, t in docs:
        want.setdefault((d, len(ids_of(t))), []).append(ids_of(t))
    assert set(whole) == set(want)
    for key, got in whole.items():
        assert sum(r["length"] for r in got) == key[1] * len(want[key])
        if len(want[key]) == 1:
            at = 0
            for r in sorted(got, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
                raw = np.array(want[key][0][r["start"]:at], "<u4").tobytes()
                assert r["ids_crc32"] == zlib.crc32(raw)


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("text", [
    "", " ", "  two  blanks ", "line\nline\n\n para\tTab", "it's  isn't 's 'S we'll", "größer als 3,5 % – ok", "trail ", " lead", "a b c",
    "nbsp x   wide", "\x1c odd \x1f marks", "emoji 😀 and 漢字 ", "<|endoftext|> x <|endoftext|>", "a \n b", "x" * 500 + " y", "\n", "a\nb", "\nstart", "end\n", "it's\n'quoted' A1b2 né.\nÉt", "don't!? ok...", "a\r\nb"])
def test_ids_equal_the_tokenizers(text):
    own = packing.Encoder(packing.tokenizer_path())
    for _ in range(2):  # learnt and remembered
        assert [np.frombuffer(x, own.kind).tolist() for x in own.batch([text, text + " " + text])] == [
            ids_of(text)[:-1], ids_of(text + " " + text)[:-1]]


def test_rest_is_cut_into_powers_of_two():
    for total in (0, 1, 2047, 2048, 2049, 5000, 3 * 2048 + 1023):
        full, ends = packing.limits(total, 2048)
        sizes = np.diff([full * 2048, *ends]).tolist()
        assert full * 2048 + sum(sizes) == total and all(s & (s - 1) == 0 for s in sizes) and len(set(sizes)) == len(sizes)


def test_corner_rows(spark):
    docs = [(r[0], r[1]) for r in corner_rows()]
    check(packing.pieces(corners(spark)).collect(), docs)
    check(packing.pieces(corners(spark), length=64).collect(), docs, 64)
    assert packing.pieces(empty(spark)).count() == 0


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pieces(docs).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    again = packing.pieces(docs.repartition(3, "source"), with_ids=False).collect()
    check(again, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_like_documents_lie_together(spark):
    """Documents of three vocabularies, dealt in turns, and many copies of one."""
    words = [prose(k, 900).split() for k in (1, 2, 3)]
    vocab = [sorted(set(w))[:60] for w in words]
    vocab = [[w + "abc"[k] * 3 for w in v] for k, v in enumerate(vocab)]
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(rng.choice(vocab[k % 3], 150)), "en", "s", 1) for k in range(150)]
    rows += [(1000 + k, "the very same text of all copies", "en", "s", 1) for k in range(60)]
    got = packing.pieces(spark.createDataFrame(rows, DOCS), with_ids=False).collect()
    check(got, [(r[0], r[1]) for r in rows])
    line = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    order = [r["doc_id"] for r in line if r["start"] == 0]
    groups = [3 if d >= 1000 else d % 3 for d in order]
    assert sum(a != b for a, b in zip(groups, groups[1:])) < 40  # by chance about 150
    assert [g for g, _ in itertools.groupby(groups)].count(3) == 1  # copies follow each other

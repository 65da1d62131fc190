import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import mixing, simhash, subword, tokenout
from strata.llm.common import cut, table
from tests.llm.frames import DOCS, corner_rows, corners, empty, prose
from tests.llm.test_duplicates import WORD, brute_components, brute_overlap, brute_print, tokens
from tests.llm.test_sharding_mixing import brute_targets

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = [cut(docs, "in")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut(stage(spark, out[-1], SF), "stage"))
    ids = [[r["doc_id"] for r in x.collect()] for x in out]
    assert all(x.columns == docs.columns for x in out[:-1])
    good = {r["doc_id"] for r in subword.classify(out[0], table(spark, SF, "labels")).collect() if r["predicted"]}
    assert sorted(ids[1]) == sorted(good)
    firsts = {r["component_id"] for r in simhash.near_duplicates(out[1]).collect()}
    assert sorted(ids[2]) == sorted(firsts)
    assert set(ids[3]) < set(ids[2])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(out[3]).collect()}
    assert {d for d, n in taken.items() if n} == set(ids[4])
    assert sorted(ids[5]) == sorted(ids[4])


def test_bad_copied_and_leaked_documents_go(spark):
    bench = table(spark, SF, "benchmark").collect()
    rows = [(k, prose(k, 120), "en", "a", 1) for k in range(20)]
    rows += [(20, rows[3][1], "en", "b", 1), (21, prose(50, 60) + " " + bench[0]["text"] + " " + prose(51, 60), "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"] for r in corpus_pipeline.keep_first_copies(spark, docs, SF).collect()} == set(range(22)) - {20}
    assert {r["doc_id"] for r in corpus_pipeline.keep_clean(spark, docs, SF).collect()} == set(range(22)) - {21}


def varied(n=70):
    """Documents of three sources with copies, near copies and blank texts."""
    rows = [(k, prose(k, 20 + k % 40), "en", "abc"[k % 3], 1) for k in range(n)]
    rows += [(n + k, prose(k, 20 + k % 40) + (" extra" if k % 2 else ""), "en", "b", 1) for k in range(0, n, 9)]
    return rows + [(900, None, "en", "a", None), (901, "", None, None, 0), (902, " \n ", "en", "c", 3)]


def test_dedup_stage_equals_brute_force(spark):
    rows = varied()
    prints = [brute_print(t) for _, t, *_ in rows]
    label = brute_components(prints, 4)
    firsts = {min(rows[i][0] for i in range(len(rows)) if label[i] == k) for k in set(label)}
    out = corpus_pipeline.keep_first_copies(spark, spark.createDataFrame(rows, DOCS), SF)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(firsts) and len(firsts) < len(rows)


def test_decontamination_stage_equals_brute_force(spark):
    items = [tokens(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    rows = varied(30) + [(500 + k, prose(800 + k, 15) + " " + " ".join(items[k][:6 + 3 * k]) + " " + prose(820 + k, 9), "en", "a", 1) for k in range(6)]
    bad = {d for d, t, *_ in rows if any(
        len(b) >= 5 and brute_overlap(tokens(t), b, 0.8, min(12, len(b))) >= min(12, len(b)) for b in items)}
    out = corpus_pipeline.keep_clean(spark, spark.createDataFrame(rows, DOCS), SF)
    assert {r["doc_id"] for r in out.collect()} == {r[0] for r in rows} - bad and 0 < len(bad) < 6


def test_mixing_stage_meets_brute_force_targets(spark):
    rows = varied()
    sizes, took = Counter(), Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, DOCS), SF).collect()
    text = {r[0]: WORD.findall(r[1] or "") for r in rows}
    passes = Counter()
    for r in out:
        words = WORD.findall(r["text"])
        took[r["source"]] += len(words)
        passes[r["doc_id"]] += 1
        rest = iter(text[r["doc_id"]])
        assert all(w in rest for w in words)  # its words, in order
    for s, target in brute_targets(dict(sizes)).items():
        assert abs(took[s] - target) <= max(0.05 * target, 1)
    assert max(passes.values()) <= 4


def test_id_stage_equals_the_tokenizer(spark):
    rows = varied(20)
    tokenizer = Tokenizer.from_file(tokenout.tokenizer_path())
    got = corpus_pipeline.write_ids(spark, spark.createDataFrame(rows, DOCS), SF).orderBy("start").collect()
    at = 0
    for r, (d, t, *_) in zip(got, sorted(rows)):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_nulls_repeats_empty_tables_and_clashing_columns(spark, name, stage):
    whole = stage(spark, corners(spark), SF)
    none = stage(spark, empty(spark), SF)
    assert none.count() == 0
    ids = {r[0] for r in corner_rows()}
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} <= ids
    if name != corpus_pipeline.STAGES[-1][0]:
        assert whole.columns == none.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    more = corners(spark).withColumns({c: F.lit("clash") for c in ("_line", "in_text", "place", "part", "plus", "key", "row", "hash")})
    assert stage(spark, more, SF).count() == whole.count()


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)

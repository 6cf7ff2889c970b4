"""The pipeline against a brute-force version of its stages, and its contract."""

import hashlib

import pytest
from llm_fixtures import SMALL
from test_llm_bpe import LIBRARY
from test_llm_jaccard import brute as near_groups
from test_llm_lines import removed

import corpus_pipeline
from carelens.llm import lines
from carelens.llm.common import stored, table
from carelens.llm.mixing import draw, source_targets
from carelens.llm.queries import llm_oracles, llm_queries

NAMES = ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]


@pytest.fixture(scope="module")
def given(spark):
    """The small table, with some shared lines and near copies planted."""
    rows = [tuple(r) for r in table(spark, SMALL, "documents").collect() if len(r["text"]) < 3000]
    passage = "This passage of many words stands in several documents, whatever else they say. " * 3
    near = [(5000 + i, rows[3][1].replace(" ", f" x{i} ", i), rows[3][2], rows[3][3], 0) for i in range(4)]
    shared = [(6000 + i, f"Own words number {i}.\n{passage}\nAnd {i} more.", "en", "src1", 0) for i in range(3)]
    odd = [(7000, None, None, None, 0), (7001, "", "en", "src1", 0), (7002, "short", None, None, 0)]
    schema = table(spark, SMALL, "documents").schema
    return spark.createDataFrame(rows + near + shared + odd, schema).repartition(3).selectExpr("*", "doc_id as n")


def test_stages_like_brute_force(spark, given):
    docs, columns = given, given.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stored(stage(spark, docs, SMALL), "stage-test")
        rows = out.collect()
        texts = [(i, r["text"]) for i, r in before.items()]
        if name != NAMES[-1]:
            assert out.columns == columns
        if name == NAMES[0]:
            assert {r["doc_id"] for r in rows} <= set(before) and len(rows) > 0.8 * len(before)
            assert all(r == before[r["doc_id"]] for r in rows)
        elif name == NAMES[1]:
            assert {r["doc_id"]: r["text"] for r in rows} == removed(texts, lines.REMOVED_CHARS)
        elif name == NAMES[2]:
            assert {r["doc_id"] for r in rows} == {i for i, _, c in near_groups(texts) if i == c}
            assert all(r == before[r["doc_id"]] for r in rows)
        elif name == NAMES[3]:
            size = {i: len((t or "").split()) for i, t in texts}
            total = {}
            for i, r in before.items():
                total[r["source"]] = total.get(r["source"], 0) + size[i]
            targets = source_targets(spark.createDataFrame(list(total.items()), "source string, source_size long"))
            rate = {r["source"]: r["target"] / r["source_size"] if r["source_size"] else 0.0 for r in targets.collect()}
            chance = {r["doc_id"]: r["u"] for r in docs.select("doc_id", draw(docs["doc_id"]).alias("u")).collect()}
            want = {i: int(rate[r["source"]]) + (chance[i] < rate[r["source"]] % 1) for i, r in before.items()}
            copies = {}
            for r in rows:
                assert r == before[r["doc_id"]]
                copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
            assert copies == {i: n for i, n in want.items() if n}
        else:
            assert len(rows) == docs.count()
            for r in rows:
                ids = LIBRARY.encode(before[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
                assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        docs = out


def test_contract(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
    assert set(llm_oracles()) <= set(llm_queries())
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_take_an_empty_table(spark, given):
    docs = given.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []

import duckdb
import pytest

from carelens.llm import mixing
from carelens.llm.mixing import mix, mixed, mixing_digest
from llm_fixtures import SMALL, docs  # noqa: F401


def brute_targets(sizes):
    """Reshares what is above its stop, round by round."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in above}


def test_targets_and_repeats(docs):
    rows = [(i, "w " * (1 + i % 7), "en", "abcdefghij"[min(9, i % 23)]) for i in range(600)]
    rows += [(700, "one two", "en", None), (701, None, "en", None), (702, "", "en", "empty"), (703, "x " * 50_000, "en", "b")]
    told = mixing_digest(docs(rows, extra=True)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want, source_of = brute_targets(sizes), {r[0]: r[3] for r in rows}
    for r in told:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    assert sorted(map(tuple, told)) == sorted(map(tuple, mixing_digest(docs(rows[::-1])).collect()))
    for source in "cdef":  # many short documents: near the target
        taken = sum(r["taken"] for r in told if source_of[r["doc_id"]] == source)
        assert abs(taken - want[source]) < 0.25 * want[source] + 20


def test_documents_of_the_mix_keep_their_columns(docs):
    rows = docs([(1, "a b", "en", "x"), (2, "c", None, "y"), (2, "c", None, "y"), (3, None, "en", None)], extra=True)
    out = mixed(rows)
    assert out.schema == rows.schema
    copies = {}
    for r in mix(rows).collect():
        copies.setdefault(r["row"]["doc_id"], []).append(r["copies"])
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: sum(v) for k, v in copies.items() if sum(v)}
    assert copies[2][0] == copies[2][1]
    assert mixed(docs([])).collect() == [] and mixing_digest(docs([])).collect() == []


def test_rates_by_join_when_sources_are_too_many_to_broadcast(docs, monkeypatch):  # noqa: F811
    rows = [(i, "w " * (i % 5), "en", ["a", None, "c"][i % 3]) for i in range(60)]
    want = sorted(map(tuple, mixing_digest(docs(rows)).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing_digest(docs(rows)).collect())) == want


def test_like_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = sorted(con.execute(mixing.ORACLE).fetchall())
    got = mixing_digest(spark.read.parquet(f"{SMALL}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, got.collect())) == want

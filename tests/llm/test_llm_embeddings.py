import os
import threading

import numpy as np
import pytest
from llm_fixtures import SMALL

from carelens.llm import embeddings
from carelens.llm.embeddings import cells, embeddings_digest, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    """n_links and component of every row, pair by pair."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = [set() for _ in rows]
    for i, (a, u, g) in enumerate(rows):
        for j, (b, v, h) in enumerate(rows):
            if i != j and None not in (a, b, g, h) and g == h and fine(u) and fine(v) and len(u) == len(v):
                x, y = np.array(u, dtype=np.float32).astype(float), np.array(v, dtype=np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[i].add(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((rows[i][0], len(links[i]), min((rows[j][0] for j in seen), key=lambda x: (x is None, x)) if rows[i][0] is not None else None))
    return out


def clusters(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, (centres[i % 12] + 0.08 * rng.normal(size=dim)).astype(np.float32).tolist(), int(i % 12 > 8)) for i in range(n)]


@pytest.mark.parametrize(("per_pivot", "block"), [(10_000, 1024), (15, 1024), (15, 7)])
def test_like_all_pairs(spark, monkeypatch, per_pivot, block):
    monkeypatch.setattr(embeddings, "PER_PIVOT", per_pivot)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = clusters(240, 6, 4)
    rows += [(300 + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(400, None, 0), (401, [0.0] * 6, 0), (402, [float("nan")] + [1.0] * 5, 0), (403, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
             (404, [], 0), (405, rows[5][1], None), (406, [1.0, 2.0], 0), (407, [2.0, 4.0], 0), (408, [1e30, 2e30], 0),
             (409, [float("inf"), 1.0], 0), (None, rows[5][1], rows[5][2])]
    got = embeddings_digest(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = {r: (n, c) for r, n, c in brute(rows)}
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_links"], r["component_id"]) == want[r["vec_id"]], r["vec_id"]
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_other_columns_and_empty(spark):
    rows = spark.createDataFrame(clusters(30, 4, 1), SCHEMA).selectExpr("*", "vec_id as rep", "'x' as row", "1 as n", "label as cell")
    assert near_vectors(rows).select("row.rep", "n_links").count() == 30
    assert embeddings_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_cell_holds_all_that_its_own_can_link_with():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, goes = cells(x, x[:20], 0.35)
    near = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0)) <= 0.35
    for a, b in zip(*np.nonzero(near), strict=True):
        assert goes[b, home[a]]
    assert goes.mean() < 0.7


def test_given_table(spark):
    told = embeddings_digest(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    n = ((x @ x.T >= 0.98) & (label[:, None] == label)).sum(axis=1) - 1
    assert {r["vec_id"]: r["n_links"] for r in told.collect()} == {r[0]: k for r, k in zip(rows, n.tolist(), strict=True)}


@pytest.mark.parametrize(("per_pivot", "block", "tile_bytes"), [(40, 500, 1 << 26), (300, 1 << 18, 100_000)])
def test_many_tiles_and_cells_of_many_dimensions(spark, monkeypatch, per_pivot, block, tile_bytes):
    monkeypatch.setattr(embeddings, "PER_PIVOT", per_pivot)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "TILE_BYTES", tile_bytes)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2400, 40))
    x[600:1200] = x[:600] + rng.uniform(0, 0.25, size=(600, 1)) * rng.normal(size=(600, 40))  # about the border
    x[1200:1700] = x[1200] + 0.05 * rng.normal(size=(500, 40))  # one dense group
    x = (x * rng.uniform(1e-3, 1e3, size=(2400, 1))).astype(np.float32)
    x[1700:1720] = x[1200]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.arange(2400) % 2 * (np.arange(2400) < 600)
    linked = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    least = np.arange(2400)
    while not (least == (now := np.where(linked, least[None, :], 2400).min(axis=1))).all():
        least = now
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(2400)]
    got = embeddings_digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    told = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert told == {i: (n - 1, c) for i, (n, c) in enumerate(zip(linked.sum(axis=1).tolist(), least.tolist(), strict=True))}


def test_disk_of_a_large_label(spark):
    """Vectors aren't copied to each block and cell of their label: intermediate files
    stay within a few times the vectors' bytes, however many meet."""
    folders = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def on_disk():
        total = 0
        for top in folders:
            for folder, _, names in os.walk(top):
                for name in names:
                    try:
                        total += os.path.getsize(os.path.join(folder, name))
                    except OSError:
                        pass  # it went meanwhile
        return total

    start, most, over = on_disk(), [0], threading.Event()

    def watch():
        while not over.wait(0.1):
            most[0] = max(most[0], on_disk())

    n = 20_000
    rows = spark.range(n).selectExpr("id as vec_id", "transform(sequence(1, 64), i -> cast(hash(id, i) as float)) as embedding", "0 as label")
    watching = threading.Thread(target=watch)
    watching.start()
    try:
        assert embeddings_digest(rows).agg({"n_links": "sum"}).first()[0] == 0
    finally:
        over.set()
        watching.join()
    assert most[0] - start < 8 * n * 64 * 4

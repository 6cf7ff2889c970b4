import random
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from llm_fixtures import docs  # noqa: F401

from carelens.llm import toxicity
from carelens.llm.common import table
from carelens.llm.sampling import labelled_ids
from carelens.llm.toxicity import Convolution, features, fit, toxicity_digest, without_toxic, words_of


def plain_margin(net, text):
    """The network's output for one text, word by word."""
    ids = [features(w) for w in words_of(text)]
    known = [net.table[i].sum(axis=0) for i in ids]
    pooled = []
    for f in net.filters:
        values = [sum(known[i + j] @ f[j] for j in range(len(f)) if i + j < len(known)) for i in range(len(known))]
        pooled.append(np.max(values, axis=0) if values else np.full(f.shape[2], -np.inf))
    top = np.concatenate(pooled)
    margin = np.where(np.isfinite(top), np.maximum(top + net.bias, 0), 0) @ net.out + net.out_bias
    told = sum((net.odds[i].sum(axis=0) for i in ids), np.zeros(len(net.langs)))
    return margin + net.shift[int(np.argmax(told))]


def network(seed=0):
    rng = np.random.default_rng(seed)
    n = len(toxicity.WIDTHS) * toxicity.FILTERS
    table_ = rng.normal(size=(toxicity.BUCKETS, toxicity.DIM))
    table_[0] = 0
    return Convolution(table_, [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS], rng.normal(size=n),
                       rng.normal(size=n), 0.3, ["a", "b"], rng.normal(size=(toxicity.BUCKETS, 2)).astype(np.float32), np.array([0.1, -2.0]))


def test_pooled_in_pieces_like_one_text_at_a_time(monkeypatch):
    net, rng = network(), random.Random(1)
    texts = [" ".join(rng.choice("one two, three Four! five six seven ((eight))".split()) for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))) for _ in range(60)]
    want = [plain_margin(net, t) for t in texts]
    for words in (100_000, 7, 1):
        monkeypatch.setattr(toxicity, "WORDS", words)
        split = [words_of(t) for t in texts]
        flat = [w for ws in split for w in ws]
        rows = net.projected(np.array([features(w) for w in flat]))
        got = net.margins(rows, np.arange(len(flat)), np.cumsum([len(ws) for ws in split]))
        assert np.allclose(got, want, atol=1e-3)


def test_held_out_accuracy(spark):
    rows, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    told = toxicity_digest(rows, labels).join(labels, "doc_id").collect()
    aside = [(r["toxic"], r["predicted"]) for r in told if r["held_out"]]
    hit = sum(1 for t, p in aside if t and p)
    precision, recall = hit / sum(p for _, p in aside), hit / sum(t for t, _ in aside)
    assert precision > 0.8 and recall > 0.8
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in told)


def test_few_labels_set_no_threshold_above_what_was_learned(spark):
    """37 toxic rows to learn from, two of them German: words that no toxic row had aren't
    found, but a threshold doesn't lose what was learned."""
    rows, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    told = toxicity_digest(rows, labels).join(labels, "doc_id").where("toxic is not null").collect()
    learned = [r["predicted"] for r in told if r["toxic"] and not r["held_out"]]
    assert sum(learned) >= 0.9 * len(learned)
    assert not any(r["predicted"] for r in told if not r["toxic"])


def test_windows_pool_like_the_whole_text():
    net, rng = network(2), random.Random(5)
    for n in (0, 1, 2, 3, 50, 400):
        text = " ".join(rng.choice("one two, three Four! five six seven ((eight)) nine".split()) for _ in range(n))
        margin, told = toxicity.window_margin(net, toxicity.unpacked(toxicity.pack(text)))
        assert np.isclose(margin + net.shift[told], plain_margin(net, text), atol=1e-6), n


def test_long_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOWS", 20)
    text = " ".join(f"w{i}" for i in range(5000))
    words, windows = toxicity.unpacked(toxicity.pack(text))
    assert windows.shape == (20, 3) and len(words) <= 60 and toxicity.pack(text) == toxicity.pack(text)


def test_sample_is_the_first_by_hash(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    rows = rows.unionByName(spark.range(9_000).selectExpr("cast(7 as bigint) as doc_id", "1 as toxic"))
    got = sorted(r["doc_id"] for r in labelled_ids(rows, "toxic", 50).where("toxic = 1").collect())
    want = rows.where("toxic = 1").distinct().selectExpr("doc_id", "xxhash64(doc_id) as h").orderBy("h", "doc_id").limit(50)
    assert got == sorted(r["doc_id"] for r in want.collect())
    assert labelled_ids(rows.limit(0), "toxic", 5).collect() == []


def rows_and_labels(spark, docs):  # noqa: F811
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(5, 60))]
        if i % 2:
            words.insert(rng.randrange(len(words)), rng.choice(["zzfoul", "zzvile"]) + rng.choice(["", "!", "ab"]))
        rows.append((i, " ".join(words), ["en", "de", None][i % 3], "s"))
        if i < 300:
            labels.append((i, 1, i % 2))
    rows += [(900, None, None, None), (901, "", "en", "s"), (902, "clean words " * 50_000 + "zzfoul", "en", "s"),
             (902, "clean words " * 50_000 + "zzfoul", "en", "s"), (None, "so zzvile", "en", "s")]
    labels += [(900, 1, 0), (None, 1, 1), (5, None, None), (7777, 0, 1)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_table(spark, docs):  # noqa: F811
    rows, labels = rows_and_labels(spark, docs)
    told = toxicity_digest(docs(rows, extra=True), labels).collect()
    assert len(told) == len(rows)
    for r in told:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
    got = {r["doc_id"]: r["predicted"] for r in told}
    new = [i for i in range(300, 400)]
    assert np.mean([got[i] == i % 2 for i in new]) > 0.95
    assert got[900] == got[901] == 0 and got[902] == 1 and got[None] == 1
    left = without_toxic(docs(rows, extra=True), labels)
    assert left.schema == docs(rows, extra=True).schema
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted(
        (r["doc_id"] for r in told if not r["predicted"]), key=repr)


def test_held_out_labels_are_not_learned_from(spark, docs):  # noqa: F811
    rows, labels = rows_and_labels(spark, docs)
    aside = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    turned = labels.selectExpr("doc_id", "quality", f"case when doc_id in ({', '.join(map(str, aside))}) then 1 - toxic else toxic end as toxic")
    a, b = (sorted((repr(r["doc_id"]), r["score"]) for r in toxicity_digest(docs(rows), x).collect()) for x in (labels, turned))
    assert a == b


def test_without_labels(spark, docs):  # noqa: F811
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(docs([(1, "x")]), none) is None
    assert [(r["score"], r["predicted"]) for r in toxicity_digest(docs([(1, "x")]), none).collect()] == [(0.0, 0)]
    assert toxicity_digest(docs([]), none).collect() == []


def test_every_labelled_row_is_learned_from(spark, docs, monkeypatch):  # noqa: F811
    """Rows in several blocks, in all parts of the counts, networks and thresholds, whatever their number."""
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 60)
    rows, labels = rows_and_labels(spark, docs)
    learned = toxicity.labelled(docs(rows), labels)
    want = {i for i in [*range(300), 900] if zlib.crc32(str(i).encode()) % 4 != 2}
    assert sorted(r["doc_id"] for r in learned.collect()) == sorted(want)
    counts = toxicity.counted(learned, ["de", "en"])
    assert counts.loc[(counts["bucket"] < 0) & (counts["slot"] < 2 * toxicity.FOLDS), "n"].sum() == len(want)
    starts = toxicity.starts_of(counts, ["de", "en"])
    *nets, model = toxicity.trained(learned, starts)
    again = toxicity.trained(learned, starts)[-1]
    assert (model.table == again.table).all() and model.out_bias == again.out_bias
    margins = toxicity.margins_of(learned, nets)
    assert margins["n"].sum() == len(want)
    told = {r["doc_id"]: r["predicted"] for r in toxicity_digest(docs(rows), labels).collect()}
    assert np.mean([told[i] == i % 2 for i in range(300, 400)]) > 0.95


def test_a_text_is_learned_from_to_its_end(spark, docs):  # noqa: F811
    words, windows = toxicity.windows_of(" ".join(f"w{i}" for i in range(9000)))
    assert len(words) == len(windows) == 9000 and (words[:, -1] == 1).all()
    net, rng = network(3), random.Random(6)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(6000))
    margin, told = toxicity.window_margin(net, toxicity.windows_of(long))
    assert np.isclose(margin + net.shift[told], plain_margin(net, long), atol=1e-6)


def test_a_later_toxic_word_of_long_texts_is_learned(spark, docs):  # noqa: F811
    """Far more words than were kept of a text: each toxic row has its word at the end."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, " ".join([*(word() for _ in range(9000)), *(["zzfoul"] if k % 2 else [])]), "en", "s") for k, i in enumerate(ids)]
    rows += [(1000, "so zzfoul it is", "en", "s"), (1001, "so fine it is", "en", "s")]
    labels = spark.createDataFrame([(i, 1, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity_digest(docs(rows), labels).collect()}
    assert got[1000] > got[1001]


def test_words_are_told_apart_together_as_one_by_one():
    """Arrow's words, buckets and hashes for many texts are those of each word by itself."""
    rng = random.Random(4)
    signs = ["a", "B", "9", "_", "-", "—", "é", "İ", "Σ", "½", "日", "́", " ", "  ", "\t", "\x1c", "\x85", "　", "​", "x" * 20]
    texts = ["", " ", " lead", "trail ", *("".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(400))]
    buckets, code, ends = toxicity.split(texts)
    got = [buckets[code[a:b]].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]
    assert got == [[features(w) for w in words_of(t)] for t in texts]
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in range(80)]
    assert toxicity.hashes(pa.array(parts)).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]
    assert toxicity.split([""])[0].shape[1] == 1 + len(toxicity.PREFIXES) and toxicity.split([""])[2].tolist() == [0]


def test_labels_meet_texts_the_same_way_at_every_size(spark, docs):  # noqa: F811
    """Few labels were broadcast and many shuffled, so that what was written grew faster than the input."""
    rows, labels = rows_and_labels(spark, docs)
    plan = toxicity.labelled_rows(docs(rows), labels)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan


def test_windows_of_usual_texts_are_narrow():
    """A block holds the windows of thousands of texts; three 64-bit numbers each were most of it."""
    words, windows = toxicity.windows_of("a b c a b c a")
    assert windows.dtype == np.uint16 and windows.tolist() == [[0, 1, 2], [0, 3, 3], [1, 2, 0], [2, 0, 1], [2, 0, 3]]
    assert toxicity.joined([(words, windows)] * 2)[1].dtype == np.int64
    words, windows = toxicity.windows_of(" ".join(f"w{i}" for i in range(70_000)))
    assert windows.max() == len(words) == 70_000

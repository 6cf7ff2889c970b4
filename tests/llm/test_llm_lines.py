import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs  # noqa: F401

from carelens.llm import lines
from carelens.llm.lines import allowed, edit_distances, near_lines, probes, segment, without_repeated_lines


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(line))
        if kind == 0:
            line.insert(at, rng.choice("abxyé😀 "))
        elif kind == 1 and len(line) > 1:
            line.pop(at)
        else:
            line[at] = rng.choice("abxyé😀 ")
    return "".join(line)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=12), st.text("ab", max_size=12)), max_size=20), st.integers(1, 4))
def test_banded_distance(pairs, most):
    code = lambda t: np.array([ord(c) for c in t], dtype=np.uint32)
    got = edit_distances([code(a) for a, _ in pairs], [code(b) for _, b in pairs], most)
    assert got.tolist() == [min(most + 1, distance(a, b)) for a, b in pairs]


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_probes_find_every_pair_within_the_edits(most):
    rng = random.Random(1)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(6, 30)))
        b = edited(rng, a, rng.randint(0, most))
        a, b = sorted((a, b), key=len)
        assert any(
            len(b) - len(a) == less and s + shift >= 0 and b[s + shift : s + shift + n] == a[s : s + n]
            for less, i, shift in probes(most) for s, n in [segment(len(a), i, most)])


def by_length(a, b):
    n = min(len(a), len(b))
    most = 3 if n >= 250 else 2 if n >= 40 else 1 if n >= 20 else 0
    if abs(len(a) - len(b)) > most:
        return False
    return n > 5000 or distance(a, b) <= most  # the longest lines here repeat one word


def table():
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n)).strip() + "."
    base = [line(rng.randint(40, 200)) for _ in range(40)] + [line(rng.randint(1, 39)) for _ in range(10)]
    hot = line(120)
    rows = []
    for i in range(120):
        some = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 5))]
        if i % 3 == 0:
            some.append(hot if i % 2 else edited(rng, hot, rng.randint(0, 2)))
        rows.append((i, rng.choice(["\n", "\n\n", "\n \n"]).join(some)))
    return rows + [(500, None), (501, ""), (502, "\n \n"), (503, "long " * 20_000), (504, "long " * 20_000 + "x"), (505, base[0] + "\n" + base[0])]


def brute(rows):
    places = {}
    for i, text in rows:
        for k, x in enumerate((text or "").split("\n")):
            if x.strip(" \t\n\x0b\x0c\r"):
                places.setdefault(x, []).append((i, k))
    found = list(places)
    links = {x: set() for x in found}
    for a in found:
        for b in found:
            if a < b and by_length(a, b):
                links[a].add(b)
                links[b].add(a)
    out = {}
    for x in found:
        seen, todo = {x}, [x]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        first = min(min(places[y]) for y in seen)
        n = len(places[x]) - 1 + sum(len(places[y]) for y in links[x])
        for p in places[x]:
            out[p] = (n, first)
    return out


@pytest.mark.parametrize("block", [128, 5])
def test_like_all_pairs(docs, monkeypatch, block):  # noqa: F811
    monkeypatch.setattr(lines, "BLOCK", block)
    want = brute(table())
    got = near_lines(docs(table(), extra=True)).collect()
    assert len(got) == len(want)
    for r in got:
        place = (r["doc_id"], r["line_no"])
        assert (r["n_links"], (r["class_doc"], r["class_line"])) == want[place], place
        assert r["kept"] == (want[place][1] == place)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_shared_keys_over_any_batches(size):
    rng = random.Random(size)
    rows = sorted((rng.randrange(40), rng.randrange(6), rng.randrange(5)) for _ in range(150))
    rows += [(50, 0, 1), (50, 0, 1), (51, 3, 1), (51, 4, 2), (52, 0, 1)] + [(53, k // 20, k) for k in range(60)]
    want = []
    for b in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == b]
        if min(r[1] for r in own) <= 2 and len({r[2] for r in own}) > 1:
            want += own
    names = ["bucket", "place", "member"]
    batches = [pa.RecordBatch.from_pydict({n: [r[k] for r in rows[i : i + size]] for k, n in enumerate(names)}) for i in range(0, len(rows), size)]
    got = [tuple(r.values()) for batch in lines.shared_keys(2)(iter(batches)) for r in batch.to_pylist()]
    least = lambda found: {(b, m): min(p for c, p, n in found if (c, n) == (b, m)) for b, _, m in found}
    assert least(got) == least(want)


def test_candidates_by_join_when_they_are_too_many_to_broadcast(docs, monkeypatch):  # noqa: F811
    want = sorted(map(tuple, near_lines(docs(table())).collect()))
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    assert sorted(map(tuple, near_lines(docs(table())).collect())) == want


def removed(rows, least):
    want = brute(rows)
    out = {}
    for i, text in rows:
        kept = [x for k, x in enumerate((text or "").split("\n"))
                if (i, k) not in want or want[i, k][1] == (i, k) or len(x) < least]
        had = any((i, k) in want for k in range(len((text or "").split("\n"))))
        if not had:
            out[i] = text
        elif any(x.strip() for x in kept):
            out[i] = "\n".join(kept)
    return out


def test_documents_without_repeated_lines(docs):  # noqa: F811
    rows = docs(table(), extra=True)
    left = without_repeated_lines(rows, 50)
    assert left.schema == rows.schema
    assert {r["doc_id"]: r["text"] for r in left.collect()} == removed(table(), 50)


def test_repeated_rows_null_ids_and_no_rows(docs):  # noqa: F811
    line = "a line that is long enough to be compared with any other " * 3
    rows = [(3, line), (3, line), (4, line + "\nmore"), (None, line), (None, line), (5, "\n")]
    left = without_repeated_lines(docs(rows)).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in left], key=repr) == sorted(
        [(4, "more"), (None, line), (None, line), (5, "\n")], key=repr)  # a null id comes first
    assert near_lines(docs([])).collect() == [] and without_repeated_lines(docs([])).collect() == []


def test_stage_removes_repeated_lines_of_any_length(docs):  # noqa: F811
    near = "a repeated line of more than forty characters, "
    rows = [(i, f"Own {i}.\n}}\nSee the licence.\n{near}{i}") for i in range(4)]
    left = {r["doc_id"]: r["text"] for r in without_repeated_lines(docs(rows)).collect()}
    assert left == {0: rows[0][1], 1: "Own 1.", 2: "Own 2.", 3: "Own 3."}


def long_table():
    """Lines of 15 to 400 characters with 0 to 20 edits, words put in or left out, and
    lines that repeat a few characters."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).strip()
    base = [line(rng.choice([3, 5, 8, 11, 12, 15, 20, 30, 60])) for _ in range(25)]
    base += ["ab" * n for n in (12, 20, 21, 38, 60)] + [line(60) + "\U0001f600"]
    rows = []
    for i in range(60):
        some = [edited(rng, rng.choice(base), rng.choice([0, 1, 2, 3, 4, 6, 10, 20])) for _ in range(rng.randint(0, 4))]
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = rng.choice(["", "other"])
        rows.append((i, "\n".join([*some, " ".join(words)])))
    return [*rows, (500, None), (501, ""), (502, base[0] + "\n" + base[0])]


@pytest.mark.parametrize("block", [128, 5])
def test_edits_that_grow_with_length_like_all_pairs(docs, monkeypatch, block):  # noqa: F811
    monkeypatch.setattr(lines, "BLOCK", block)
    rows = long_table()
    want = brute(rows)
    got = near_lines(docs(rows, extra=True)).collect()
    assert len(got) == len(want)
    for r in got:
        place = (r["doc_id"], r["line_no"])
        assert (r["n_links"], (r["class_doc"], r["class_line"])) == want[place], place


@pytest.mark.parametrize("size", [19, 20, 39, 40, 41, 249, 250, 252, 400])
def test_edits_at_the_borders_of_lengths(docs, size):  # noqa: F811
    """Against a line, others with as many edits as its length allows and one more."""
    line = "".join(random.Random(size).choice("abcdefgh ") for _ in range(size - 2)) + "zz"
    most = allowed(size)
    longer = [line + "é" * n for n in (most, most + 1)]
    other = "".join("😀" if k in [7 + 9 * j for j in range(most)] else c for k, c in enumerate(line)) if most else line
    got = near_lines(docs([(i, t) for i, t in enumerate([line, *longer, other])])).collect()
    want = brute(list(enumerate([line, *longer, other])))
    assert {r["doc_id"]: (r["n_links"], r["class_doc"]) for r in got} == {i: (n, first[0]) for (i, _), (n, first) in want.items()}
    assert want[0, 0][0] >= 1 and (size > 20 or most == size - 19)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_lines_within_the_edits_share_a_segment(seed):
    rng = random.Random(seed)
    some = rng.choice(["a", "ab", "abcdefgh "])
    n = rng.choice([20, 21, 39, 40, 41, 249, 250, 251, rng.randint(20, 400)])
    a = "".join(rng.choice(some) for _ in range(n))
    b = edited(rng, a, allowed(n))
    if by_length(a, b):
        line, key, place = lines.line_keys([a, b])
        a, b = (0, 1) if len(a) <= len(b) else (1, 0)
        assert set(key[(line == a) & (place <= lines.OWN)].tolist()) & set(key[line == b].tolist())


def test_copies_of_a_frequent_line_send_few_keys():
    batch = pa.RecordBatch.from_pydict({"member": [5, 6, 5, 5, 6], "line": ["x" * 30, "y" * 30, "x" * 30, "x" * 30, "y" * 30]})
    got = [r for b in lines.keyed(lines.EDITS)(iter([batch, batch])) for r in b.to_pylist()]
    assert {r["member"] for r in got} == {5, 6}
    assert sum(r["member"] == 5 and r["place"] <= lines.OWN for r in got) == 2  # its two segments, once


def test_one_edit_in_lines_of_20_to_39_characters(docs):  # noqa: F811
    rows = [(1, "Are. Is anwh reenen."), (2, "Are, Is anwh reenen."), (3, "Are. Is anwh, reenen."), (4, "Nineteen charactes."), (5, "Nineteen charactes,")]
    got = near_lines(docs(rows)).collect()
    assert {r["doc_id"]: (r["n_links"], r["class_doc"]) for r in got} == {1: (2, 1), 2: (1, 1), 3: (1, 1), 4: (0, 4), 5: (0, 5)}


def test_no_line_of_another_text_under_the_same_id_is_removed(docs):  # noqa: F811
    a, b, c = ("a first line that stands in two documents", "only here, in the second text of the id", "some other line")
    rows = [(1, a), (3, a + "\n" + c), (3, b + "\n" + c), (7, "x\ny"), (7, "x\ny")]
    left = sorted((r["doc_id"], r["text"]) for r in without_repeated_lines(docs(rows, extra=True)).collect())
    texts = [t for i, t in left if i == 3]
    assert left[0] == (1, a) and sum(b in t for t in texts) == 1 and sum(c in t for t in texts) == 1
    assert not any(a in t for t in texts) and [t for i, t in left if i == 7] == ["x\ny", "x\ny"]


def test_keys_are_sorted_by_one_number(spark):
    """Each key and its place come through the shuffle as one number, and back as they were."""
    some = [(k, "".join(random.Random(k).choice("abc") for _ in range(20 + 7 * k))) for k in range(60)]
    made = lines.indexed(spark.createDataFrame(some, "member long, line string"), lines.EDITS)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Sort [key" in plan and "Sort [bucket" not in plan
    line, key, place = lines.line_keys([x for _, x in some])
    want = sorted(zip((key & ~7).tolist(), place.tolist(), line.tolist()))
    parts = made.rdd.glom().map(lambda rows: [tuple(r) for r in rows]).collect()
    assert sorted(r for rows in parts for r in rows) == want
    assert all([r[:2] for r in rows] == sorted(r[:2] for r in rows) for rows in parts)
    assert sum(len({r[0] for r in rows}) for rows in parts) == len({r[0] for r in want})


def test_a_line_longer_than_a_chunk_has_the_same_keys(monkeypatch):
    some = ["ab é" * 50, "x" * 33, "abc " * 100]
    want = [x.tolist() for x in lines.line_keys(some)]
    monkeypatch.setattr(lines, "CHUNK", 64)
    assert [x.tolist() for x in lines.line_keys(some)] == want
    assert len(lines.kept_powers(64)[0]) == 65

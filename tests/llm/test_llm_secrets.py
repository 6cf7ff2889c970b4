import hashlib
import random
import re

from carelens.llm import secrets
from carelens.llm.common import scratch
from carelens.llm.secrets import BASE, RULES, BlobLedger, Rule, scan_paths, secrets_digest
from llm_fixtures import docs  # noqa: F401

PYTHON = {
    "assign": re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    found = []
    for rank, rule in enumerate(BASE):
        for m in PYTHON[rule.kind].finditer(text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), rank, f"{rule.kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_like_a_scan_of_each_text(docs):
    rng = random.Random(5)
    parts = ["password", "API_KEY", "apikey", "token", "secret", ": ", "=", " = ", '"', "'", "abcdefgh", "AKIA", "ABCD1234EFGH", "x.y-z/",
             "0123456789abcdef" * 2, "deadbeef", " ", "\n", "😀", "é", "password: token: hunter2hunter2", "short", "KEY"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "password=" + "a" * 200_000, "AKIA" * 5, "\u212atoken=12345678", "paſſword=123456789"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, texts[0]), (900, texts[0]), (None, texts[1])]
    got = {}
    for r in secrets_digest(docs(rows, extra=True)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text in rows:
        want = brute(text)
        for r in got[doc_id]:
            assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in PYTHON]
            assert [s for s in r["spans"].split(",") if s.split(":")[0] in PYTHON] == want


def test_more_formats_add_spans(docs):
    text = "x ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY-----"
    (r,) = secrets_digest(docs([(1, text)])).collect()
    assert r["spans"] == f"code_host:2:{2 + 40},pem:43:{len(text)}" and not r["n_assign"]


def test_only_unseen_pairs_are_scanned(spark, docs):
    ledger = BlobLedger(spark, scratch(spark, "ledger-test"))
    first = [(1, "token=abcdefgh1"), (2, "nothing"), (3, "token=abcdefgh1")]
    scan_paths(docs(first), ledger).collect()
    assert ledger.scanned().count() == 2 * len(RULES)
    again = scan_paths(docs(first + [(4, "secret: zyxwvuts9")]), ledger)
    assert ledger.scanned().count() == 3 * len(RULES) and ledger.scanned().distinct().count() == 3 * len(RULES)
    assert {r["row"]["doc_id"]: len(r["spans"]) for r in again.collect()} == {1: 1, 2: 0, 3: 1, 4: 1}
    newer = (Rule("assign", 2, r"no(thing)", 1, 3), *RULES[1:])
    told = scan_paths(docs(first), ledger, rules=newer)  # only the changed rule, on the two contents
    assert ledger.scanned().count() == 3 * len(RULES) + 2
    assert {r["row"]["doc_id"]: [s["kind"] for s in r["spans"]] for r in told.collect()} == {1: [], 2: ["assign"], 3: []}


def test_findings_of_a_broken_off_scan_count_once(spark, docs):
    ledger = BlobLedger(spark, scratch(spark, "ledger-test"))
    rows = docs([(1, "token=abcdefgh1")])
    blobs = rows.selectExpr("sha2(cast(text as binary), 256) as blob", "text", "array('assign') as kinds")
    secrets.find(blobs).write.parquet(f"{ledger.folder}/found/broken")
    assert [len(r["spans"]) for r in scan_paths(rows, ledger).collect()] == [1]


def test_empty_table(docs):
    assert secrets_digest(docs([])).collect() == []

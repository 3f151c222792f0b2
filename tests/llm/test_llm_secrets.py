import hashlib
import re

from corpus_rows import awkward_texts, frame

from millrace.llm import secrets
from millrace.session import fresh_dir

KEYWORD = "(?:" + "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key")
) + ")"
BASE = (
    ("assign", re.compile(KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)
SECRETS = [
    (500, 'token = "abcd1234efgh" tail'),
    (501, "é PASSWORD:'x' secret=token:abcdefgh1 api_key == abcdefgh apikey= 12345678"),
    (502, "AKIA123456789012 AKIAAKIA12345678901 AKIA12 " + "0a" * 16 + " " + "f" * 31),
    (503, "token=token=abcdefgh123 token: secret: abcdefghij"),
    (504, "ü" * 3 + "secret=" + "deadbeef" * 5),
    (505, "ToKeN=abc.def/ghi\npasswd =\nhello123456"),
    (506, "\x01token=abcdefgh\x02"),
]


def expected(texts):
    out = []
    for i, t in texts:
        found = []
        for n, (kind, pattern, valid) in enumerate(BASE):
            found += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(t or "") if valid(m)]
        spans = ",".join(s for _, _, s in sorted(found))
        counts = tuple(sum(n == k for _, n, _ in found) for k in range(3))
        out.append((i, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans))
    return sorted(out, key=repr)


def test_spans_equal_python_regex(spark):
    texts = awkward_texts(4) + SECRETS + [(600 + i, SECRETS[i % 3][1]) for i in range(30)]
    rows = secrets.digest(frame(spark, texts, clashing=True)).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == expected(texts)


def test_ledger_scans_each_content_once_per_rule_version(spark):
    ledger = secrets.BlobLedger(spark, fresh_dir(spark, "test-ledger"))
    first = frame(spark, [(1, "token=abcdefgh1"), (2, "token=abcdefgh1"), (3, "plain")])
    ledger.scan(first, path="doc_id").collect()
    assert ledger.read().count() == 2
    more = frame(spark, [(1, "token=abcdefgh1"), (4, "token=abcdefgh1"), (5, "secret=zyxwvuts")])
    found = {r.path: [s.kind for s in r.spans] for r in ledger.scan(more, path="doc_id").collect()}
    assert found == {1: ["assign"], 4: ["assign"], 5: ["assign"]}
    assert ledger.read().count() == 3
    # The files hold no content twice.
    assert spark.read.parquet(ledger.path).count() == 3
    ledger.scan(more, path="doc_id", rules_version="other").collect()
    assert ledger.read().count() == 5


def test_empty_table(spark):
    assert secrets.digest(frame(spark, [])).collect() == []

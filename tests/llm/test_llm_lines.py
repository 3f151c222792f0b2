import hashlib
from collections import defaultdict

from corpus_rows import CLASHING, awkward_texts, frame, sorted_rows

from millrace.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def expected(texts):
    holders = defaultdict(set)
    low = lambda i: -1 if i is None else i
    keys = lambda t: [lower(x.strip(BLANKS)) for x in (t or "").split("\n")]
    for i, t in texts:
        for k in keys(t):
            if len(k) >= 20:
                holders[k].add(low(i))
    out = []
    for i, t in texts:
        kept = [x for x, k in zip((t or "").split("\n"), keys(t)) if not (len(holders.get(k, ())) >= 3 and low(i) != max(holders[k]))]
        n = len((t or "").split("\n"))
        out.append((i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_line_dedup_equals_brute_force(spark):
    for seed in (1, 2):
        texts = awkward_texts(seed)
        found = lines.digest(frame(spark, texts)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
        assert sorted_rows(found) == expected(texts)


def test_a_line_over_many_partitions_keeps_one_document(spark, conf):
    conf(spark__sql__shuffle__partitions="16")
    texts = [(i, "the one line that every document has\n" + f"own line number {i}") for i in range(400)]
    assert sorted_rows(lines.digest(frame(spark, texts))) == expected(texts)


def test_other_columns_pass_through_whatever_their_names(spark):
    docs = frame(spark, awkward_texts(3), clashing=True)
    out = lines.drop_repeated_lines(docs)
    assert set(docs.columns) <= set(out.columns)
    own = [c for c in CLASHING if c not in ("n_dropped", "n_lines")]
    assert {tuple(r) for r in out.select(*own).collect()} == {tuple(f"own {c}" for c in own)}
    assert out.count() == docs.count()


def test_empty_table(spark):
    assert lines.digest(frame(spark, [])).collect() == []

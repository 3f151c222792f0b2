import zlib
from collections import defaultdict

from corpus_rows import awkward_texts, frame

from millrace.llm import shards


def test_shards_are_contiguous_balanced_and_gapless(spark):
    texts = [(i, "x" * (i * 37 % 200)) for i in range(1000)] + awkward_texts(1)
    docs = frame(spark, texts, clashing=True)
    rows = shards.assign_shards(docs).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"], r.text_crc32) for r in rows) == sorted(
        (-1 if i is None else i, size(t), zlib.crc32((t or "").encode())) for i, t in texts
    )
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    target, largest, before = sum(size(t) for _, t in texts) / 16, max(size(t) for _, t in texts), -2
    for shard in sorted(by):
        held = sorted(by[shard], key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in held]
        assert ids == sorted(ids) and ids[0] >= before
        before = ids[-1]
        assert abs(sum(r["size"] for r in held) - target) <= largest


def test_few_or_no_rows(spark):
    assert shards.digest(frame(spark, [])).collect() == []
    rows = shards.digest(frame(spark, [(1, "ab"), (2, None), (3, "ab")])).collect()
    assert sorted((r.doc_id, r.slot, r.law, r.grown_shard) for r in rows) == [(i, 0, "bytes", None) for i in (1, 2, 3)]

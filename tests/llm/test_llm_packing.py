import random
import zlib
from collections import defaultdict

import numpy as np
from corpus_rows import awkward_texts, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.packing import Limits

REFERENCE = Tokenizer.from_file(packing.TOKENIZER)
ENCODE = packing.Encoder(open(packing.TOKENIZER, encoding="utf-8").read())


def whole_ids(text):
    return [*REFERENCE.encode(text or "", add_special_tokens=False).ids, 1]


@given(st.text(max_size=80) | st.text(alphabet="aA'sΣσ \t\n\x0b\x1c\x85\xa0 ́é<|endoftext|>12ß́", max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(ENCODE(text.encode()), "<u4").tolist() == whole_ids(text)[:-1]


def check_sequences(pieces, limits):
    by = defaultdict(list)
    for sequence, offset, length, loss in pieces:
        by[sequence].append((offset, length, loss))
    for held in by.values():
        held.sort()
        assert [o for o, _, _ in held] == np.cumsum([0, *(n for _, n, _ in held)])[:-1].tolist()
        assert sum(n for _, n, _ in held) <= limits.tokens
        assert len(held) <= limits.segments and sum(x for _, _, x in held) <= limits.loss_tokens
    return {s: sum(n for _, n, _ in held) for s, held in by.items()}


def check_documents(texts, found, limits, least_gap, groups):
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(whole_ids(t))
    assert set(by) == set(want)
    for i, held in by.items():
        held.sort(key=lambda r: (r.doc_tokens, r.start))
        if len(want[i]) == 1:
            assert b"".join(bytes(r.ids) for r in held) == np.array(want[i][0], "<u4").tobytes()
            assert [r.start for r in held] == np.cumsum([0, *(r.length for r in held)])[:-1].tolist()
        assert sum(r.length for r in held) == sum(map(len, want[i]))
        assert {r.doc_tokens for r in held} == set(map(len, want[i]))
    sums = check_sequences([(r.sequence_id, r.offset, r.length, r.length - 1) for r in found], limits)
    assert sum(n <= limits.tokens - least_gap for n in sums.values()) <= groups


def test_documents(spark):
    texts = awkward_texts() + [(2000, "many words " * 9000), (2001, "copy"), (2001, "copy"), (2002, None)]
    for limits, rows, groups in ((Limits(), 8192, 1), (Limits(64, 64, 64), 50, 60), (Limits(64, 64, 20), 10**6, 1)):
        found = packing.pack_documents(frame(spark, texts, clashing=True), limits, least_gap=8, group_rows=rows).collect()
        if limits.loss_tokens >= limits.tokens:
            check_documents(texts, found, limits, 8, groups if groups == 1 else 200)
        else:
            check_sequences([(r.sequence_id, r.offset, r.length, r.length - 1) for r in found], limits)


def test_digest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.digest(docs).collect()
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    for i, text in ((r.doc_id, r.text) for r in docs.collect()):
        ids = np.array(whole_ids(text), "<u4")
        for r in by[i]:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        covered = sorted((r.start, r.length) for r in by[i])
        assert sum(n for _, n in covered) == len(ids) and [s for s, _ in covered] == np.cumsum([0, *(n for _, n in covered)])[:-1].tolist()
    sums = check_sequences([(r.sequence_id, r.offset, r.length, r.length - 1) for r in found], Limits())
    padding = sum(2048 - n for n in sums.values() if n & (n - 1))
    assert padding < 0.01 * sum(sums.values()) + 2048


def test_examples_keep_whole_under_all_limits(spark):
    rng = random.Random(0)
    rows = [(i, n := rng.randint(0, 300), rng.randint(0, n), "own") for i in range(2000)]
    rows += [(5000, 301, 1, "too long"), (5001, 300, 300, "too much loss"), (5002, None, 1, ""), (5003, -1, 0, ""), (7, 10, 10, "id again")]
    examples = spark.createDataFrame(rows, "id long, n int, loss int, sequence_id string").repartition(4)
    limits = Limits(300, 4, 200)
    found = packing.pack_examples(examples, "n", "loss", limits, group_rows=700).collect()
    assert sorted((r.id, r.n or 0, r.loss) for r in found) == sorted((a, b or 0, c) for a, b, c, _ in rows)
    without = {(r.id, r.n) for r in found if r.sequence_id is None}
    assert without == {(i, n) for i, n, loss, _ in rows if n is None or n < 0 or n > 300 or loss > 200}
    packed = [(r.sequence_id, r.offset, r.n, r.loss) for r in found if r.sequence_id is not None]
    sums = check_sequences(packed, limits)
    # No fewer sequences can hold them, were each limit the only one; the heuristic comes near.
    least = max(sum(p[2] for p in packed) / 300, len(packed) / 4, sum(p[3] for p in packed) / 200)
    assert len(sums) < 1.1 * least + 5


def test_next_is_the_largest_dot_product():
    # Tokens are scarce here, loss is not, so the wide example goes before the loss-heavy one.
    placed = packing.fill(np.array([60, 50, 40]), np.array([0, 10, 10]), Limits(100, 10, 1000))
    assert [(item, sequence, offset) for item, _, _, sequence, offset in placed] == [(0, 0, 0), (2, 0, 60), (1, 1, 0)]


def test_many_empty_texts_and_no_texts(spark):
    assert packing.digest(frame(spark, [])).collect() == []
    found = packing.digest(frame(spark, [(i, None if i % 2 else "") for i in range(2000)])).collect()
    sums = check_sequences([(r.sequence_id, r.offset, r.length, 0) for r in found], Limits())
    assert sorted(sums.values()) == [464, 512, 512, 512]

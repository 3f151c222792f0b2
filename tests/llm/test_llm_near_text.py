import random

import numpy as np
import pytest
from corpus_rows import awkward_texts, frame

from millrace.llm import near_text
from millrace.llm.links import components, forest
from millrace.llm.shingles import shingle_sets


def expected(texts, k):
    sets = []
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    low = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and a and b and low[i] != low[j] and 100 * len(a & b) >= 80 * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
                    changed = True
    return sorted(((i, len(s), low[i]) for i, s in sets), key=repr)


def near_copies(seed, base_words, copies, edits, first):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    out = []
    for c in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        out.append((first + c, " ".join(text)))
    return out


@pytest.mark.parametrize("k, shingles", [(2, 2_000_000), (5, 300)])
def test_classes_equal_brute_force(spark, k, shingles, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK", 16)  # families of several blocks
    monkeypatch.setattr(near_text, "BLOCK_SHINGLES", shingles)
    texts = awkward_texts(9) + near_copies(1, 120, 90, 9, 1000) + near_copies(2, 60, 12, 8, 2000)
    found = near_text.near_duplicates(frame(spark, texts, clashing=True), k).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected(texts, k)


def sketch(rng, keys, half=None):
    """Minhashes with the keys of ``keys`` as given; the others share one place of two with ``half``."""
    out = rng.integers(0, 1 << 32, near_text.N_HASHES, dtype=np.uint32)
    if half is not None:
        out[::2] = half[::2]
    for k, value in keys.items():
        out[2 * k : 2 * k + 2] = value
    return out


@pytest.mark.parametrize("run_block", [5, 2048])
def test_near_pair_meets_past_dissimilar_documents_of_its_run(spark, monkeypatch, run_block):
    monkeypatch.setattr(near_text, "RUN_BLOCK", run_block)
    rng = np.random.default_rng(2)
    shared = {0: (1, 2), near_text.SIDE: (3, 4)}  # one left and one right key: one table
    near = sketch(rng, shared)
    rows = [(10, near), (30, sketch(rng, shared, near))]
    rows += [(i, sketch(rng, shared)) for i in range(1, 40) if i not in (10, 30)]
    rows += [(i, sketch(rng, {})) for i in range(100, 120)]
    sets = spark.createDataFrame([(i, bytearray(h.tobytes())) for i, h in rows], "doc_id long, hashes binary")
    found = {r.node: r.component for r in near_text._families(sets.repartition(3)).collect()}
    assert found == {10: 10, 30: 10}


def test_members_of_runs_over_batches_and_edges():
    import pyarrow as pa

    key = [1, 2, 2, 2, 2, 2, 2, 3, 3, 3, 4, 5, 5, 5, 5, 6, 6]
    doc = [1, 1, 2, 2, 3, 4, 5, 1, 2, 3, 9, 1, 2, 3, 3, 7, 8]
    wide = {(1, 1), (6, 7), (6, 8)} | {(2, d) for d in (1, 2, 3, 4, 5)}  # the edges, and runs of four documents
    for size in (1, 2, 3, 5, 20):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(key[i : i + size]), pa.array(doc[i : i + size])], ["key", "doc_id"])
            for i in range(0, len(key), size)
        ]
        rows = [r for batch in near_text._runs(iter(batches)) for r in batch.to_pylist()]
        assert {(r["key"], r["a"]) for r in rows if r["key"] is not None and r["b"] is None} == wide


def test_one_of_each_class_stays(spark):
    texts = awkward_texts(10)
    docs = frame(spark, texts, clashing=True)
    out = near_text.keep_one(docs)
    assert out.columns == docs.columns
    gone = {i for i, _, c in expected(texts, 5) if i != c}
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((i for i, _ in texts if i not in gone), key=repr)


def test_empty_and_lone_documents(spark):
    assert near_text.digest(frame(spark, [])).collect() == []
    rows = near_text.digest(frame(spark, [(1, None), (2, None), (3, "word"), (4, "WORD")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)
    ]


def test_shingles_across_segments(monkeypatch):
    from millrace.llm import shingles

    texts = ["One two  three\tfour", "", None, "one TWO three four five", "x" * 100, "one"]
    whole, offsets = shingle_sets(texts, 2)
    assert np.diff(offsets).tolist() == [3, 0, 0, 4, 1, 1]
    assert set(whole[offsets[0] : offsets[1]]) < set(whole[offsets[3] : offsets[4]])
    monkeypatch.setattr(shingles, "SEGMENT", 6)
    parts, again = shingle_sets(texts, 2)
    assert (whole == parts).all() and (offsets == again).all()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(7, i) for i in range(8, 60)] + [(3, 3), (5, 4), (5, 4)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in chain}, **{i: 7 for i in range(7, 60)}, 4: 4, 5: 4}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_forest_connects_the_same():
    a, b = forest(np.array([5, 9, 2, 7]), np.array([9, 2, 5, 8]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(5, 2), (8, 7), (9, 2)]

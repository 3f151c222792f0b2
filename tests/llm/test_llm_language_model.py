import math
import zlib
from collections import Counter

import numpy as np
from corpus_rows import awkward_texts, frame

from millrace.llm import language_model as lm
from millrace.llm.tables import table


def expected(texts):
    c = Counter()
    for i, t in texts:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            c.update(lm.tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in texts:
        words = lm.tokens(t)
        out.append((i, len(words), sum(c[w] > 0 for w in words), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)))
    return sorted(out, key=repr)


def check(found, texts):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=repr)
    want = expected(texts)
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[4], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


def test_base_scores_equal_brute_force(spark, monkeypatch):
    texts = awkward_texts(11)
    check(lm.digest(frame(spark, texts, clashing=True)).collect(), texts)
    monkeypatch.setattr(lm, "HEAD", 4)  # nearly all words by the join
    check(lm.digest(frame(spark, texts)).collect(), texts)


def model_of(spark, texts):
    docs = frame(spark, texts).select("doc_id", "text")
    counts = lm.count_words(docs.select("text"))
    corpus = lm.summarise_counts(counts)
    coded = lm.encode(docs, corpus)
    return counts, corpus, coded, lm.train(coded, corpus)


def test_probabilities_add_up_to_one(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEAST", 2)
    counts, corpus, _, parameters = model_of(spark, awkward_texts(12))
    scorer = lm.Scorer(corpus, parameters)
    assert corpus.n_units > 40 + lm.SUFFIX_UNITS and 1 < corpus.n_classes < corpus.n_units
    units = np.arange(corpus.n_units, dtype=np.int32)
    for before in ((corpus.n_units, corpus.n_units), (3, corpus.n_units), (0, 5)):
        context = np.repeat(np.array(before, np.int32)[:, None], len(units), axis=1)
        assert math.isclose(np.exp(scorer.logs(units, context).astype(float)).sum(), 1, rel_tol=1e-4)
    # Inside each suffix unit: seen words and one share for unseen ones.
    shares = np.full(lm.SUFFIX_UNITS, 0.5)
    for word, c in ((bytes(r.word), r.c) for r in counts.collect()):
        if corpus.words.get(word, corpus.own) >= corpus.own:
            shares[lm.suffix_unit(word)] += c + 0.5
    assert np.allclose(shares, corpus.below)


def test_scores_equal_a_plain_loop_over_the_parameters(spark, monkeypatch):
    """The query's sums, from the definition: class, unit in the class, share in a suffix unit."""
    monkeypatch.setattr(lm, "LEAST", 2)
    monkeypatch.setattr(lm, "HEAD", 60)  # some words by the join
    texts = awkward_texts(14)
    counts, corpus, coded, p = model_of(spark, texts)
    c = {bytes(r.word): r.c for r in counts.collect()}
    d, class_of = lm.DIMENSIONS, corpus.class_of()

    def share(scores, at):
        return scores[at] - scores.max() - math.log(np.exp(scores - scores.max()).sum())

    def expected(text):
        total, before = 0.0, [corpus.n_units] * lm.CONTEXT
        for word in lm.tokens(text):
            number = corpus.words.get(word)
            own = number is not None and number < corpus.own
            unit = corpus.unit[number] if own else corpus.suffix[lm.suffix_unit(word)]
            if not own:
                total += math.log10((c.get(word, 0) + 0.5) / corpus.below[lm.suffix_unit(word)])
            hidden = sum(p.context[b, :d].astype(float) * p.place[k, :d] for k, b in enumerate(before))
            k = class_of[unit]
            low, high = corpus.first[k], corpus.first[k + 1]
            total += share(p.of_class[:, :d] @ hidden + p.of_class[:, d], k) / math.log(10)
            total += share(p.unit[low:high, :d] @ hidden + p.unit[low:high, d], unit - low) / math.log(10)
            before = [unit, *before[:-1]]
        return total

    short = [(i, t) for i, t in texts if len(t or "") < 300]
    want = sorted((repr(i), round(expected(t), 2)) for i, t in short)
    ids = {repr(i) for i, _ in short}
    found = lm.score(coded, counts, corpus, p).collect()
    lengths = {repr(i): len(t or "") for i, t in texts}
    got = sorted((repr(r.doc_id), r.score) for r in found if repr(r.doc_id) in ids and lengths[repr(r.doc_id)] < 300)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 0.02 + 1e-3 * abs(w[1]) for g, w in zip(got, want))


def test_held_out_texts_score_above_word_frequencies_however_the_table_is_cut(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.1"), "documents").where("n_chars < 3000")
    gains = []
    for parts in (8, 256):
        rows = lm.digest(docs.select("doc_id", "text").repartition(parts)).where("held_out").collect()
        n = sum(r.n_tokens for r in rows)
        gains.append((sum(r.score for r in rows) - sum(r.base_score for r in rows)) / n)
    assert min(gains) > 0.1 and abs(gains[0] - gains[1]) < 0.01


def test_the_vocabulary_follows_the_corpus(spark, sf_dir):
    sizes = []
    for sf in ("sf0.01", "sf0.1"):
        docs = table(spark, sf_dir.replace("sf0.001", sf), "documents")
        corpus = lm.summarise_counts(lm.count_words(docs.select("text")))
        assert (corpus.counts[: corpus.own] >= max(lm.LEAST, lm.ROOT_SHARE * math.sqrt(corpus.n))).all()
        sizes.append(corpus.own)
    assert sizes[1] > 2 * sizes[0]


def test_empty(spark):
    assert lm.digest(frame(spark, [])).collect() == []
    [row] = lm.digest(frame(spark, [(5, None)])).collect()
    assert (row.n_tokens, row.doc_id) == (1, 5)

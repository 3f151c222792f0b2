import random

import numpy as np
import pytest
from corpus_rows import SCHEMA, awkward_texts, frame
from pyspark.sql import functions as F

from millrace.llm import language
from millrace.llm.tables import table


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    found = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id")
    by = {r["held_out"]: r["right"] for r in found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    assert by[True] > 0.97 and by[False] > 0.97
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_texts_without_letters_are_unknown_and_rejected(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs)
    rows = awkward_texts(5)
    found = language.identify(frame(spark, rows, clashing=True), model).collect()
    assert len(found) == len(rows)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or (r.score == 0 and r.rejected)
    # Text and counts of subwords decide, the label and the id do not.
    twice = docs.select("doc_id", "text").union(docs.select(F.col("doc_id") + 10**6, "text"))
    pairs = language.identify(twice, model).groupBy("text").agg(F.count_distinct("lang_pred").alias("n"))
    assert pairs.where("n <> 1").count() == 0


def test_few_labels(spark):
    none = spark.createDataFrame([(1, "some text", None, None, 9), (2, None, "en", None, None)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language.digest(none).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(i, f"some text {i}", "en", None, 9) for i in range(20)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language.digest(one).collect()} == {("en", 1.0)}
    assert language.digest(frame(spark, [])).collect() == []


def test_buckets_do_not_depend_on_strides_or_neighbours():
    texts = ["one Two", "", None, "Straße été", "x" * 50]
    before = language.STRIDE
    alone = [language.bucket_counts([t])[0] for t in texts]
    try:
        language.STRIDE = 7
        together = language.bucket_counts(texts)
    finally:
        language.STRIDE = before
    for (b, c), (d, e) in zip(alone, together):
        assert dict(zip(b.tolist(), c.tolist())) == dict(zip(d.tolist(), e.tolist()))


def spoken(rng, syllables, n):
    """``n`` texts of words made of ``syllables``."""
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(400)]
    return [" ".join(rng.choices(words, k=rng.randint(30, 80))) for _ in range(n)]


@pytest.mark.parametrize("languages", [1, 2, 3])
def test_unlearned_languages_and_junk_are_rejected(languages):
    rng = random.Random(languages)
    syllables = ["ba ke li mo nu ta re si", "scht ach ung ein der tz pf lich", "qua eux oi ille tion ais eau ou"]
    other = spoken(rng, "vy zha kro gdi pry wsz hov ejn".split(), 100)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(50)) for _ in range(100)]
    corpus = [(f"l{i}", t) for i in range(languages) for t in spoken(rng, syllables[i].split(), 300)]
    rng.shuffle(corpus)
    counts = language.bucket_counts([t for _, t in corpus])
    model = language.train([(name, *c) for (name, _), c in zip(corpus[:-100], counts)])
    work = language._worker(model)()
    clean, other, junk = (sum(work(texts)[2].to_pylist()) for texts in ([t for _, t in corpus[-100:]], other, junk))
    assert clean <= 2 and other >= 98 and junk >= 98


def test_sample_is_bounded_with_copies_and_many_labels(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language, "train", lambda rows, held, windows: taken.append(rows))
    copies = [("the same text in very many rows", "en")] * 500
    texts = [(f"text {chr(97 + i // 26)}{chr(97 + i % 26)} alone", "en") for i in range(40)]
    language.learn(spark.createDataFrame(copies + texts, "text string, lang string").repartition(4), 41)
    assert len(taken[-1]) == 41
    assert len({(b.tobytes(), c.tobytes()) for _, b, c in taken[-1]}) == 41
    many = [(f"text {chr(97 + j)}", f"l{i}") for i in range(50) for j in range(3)]
    for sample, labels in ((60, 50), (30, 30)):
        language.learn(spark.createDataFrame(many, "text string, lang string"), sample)
        assert len(taken[-1]) <= sample and len({label for label, _, _ in taken[-1]}) == labels


def plain(text, model):
    """The prediction from the definition, one subword after the other."""
    data = [32] + [c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in text.encode()] + [32] * 6
    total, n = np.zeros(model.table.shape[1]), 0
    for order in language.ORDERS:
        for i in range(len(text.encode()) + 1):
            part = data[i : i + order]
            if (order == 2 and part == [32, 32]) or 32 in part[1:-1]:
                continue
            value = order
            for c in part:
                value = (value ^ c) * 16777619 % 2**32
            value = (value ^ value >> 15) * 2246822519 % 2**32
            total += model.table[value >> 17]
            n += 1
    logits = total[:-1] / max(1, n) + model.bias
    sure = np.exp(logits / model.temperature - (logits / model.temperature).max())
    best = int(logits.argmax())
    return model.languages[best], float(sure[best] / sure.sum())


def test_predictions_equal_a_plain_loop(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("n_chars < 2000")
    model = language.learn(docs)
    rows = [r for r in awkward_texts(6) if len(r[1] or "") < 6000] + [(5000 + r.doc_id, r.text) for r in docs.collect()]
    for r in language.identify(frame(spark, rows), model).collect():
        if any(c.isalpha() for c in r.text or ""):
            name, score = plain(r.text, model)
            assert (r.lang_pred, round(r.score, 4)) == (name, round(score, 4))


def test_short_clean_texts_are_kept_and_other_languages_rejected(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.1"), "documents").where("lang is not null and n_chars between 200 and 4000")
    learned, rest = docs.where(~language.held_out(F.col("doc_id"))), docs.where(language.held_out(F.col("doc_id")))
    words = F.split("text", r"\s+")
    model = language.learn(learned)
    for n in (2, 3, 6, 12, 25):
        start = (F.pmod(F.xxhash64("text", F.lit(n)), F.size(words) - n) + 1).cast("int")
        cut = rest.where(F.size(words) > n).select(F.array_join(F.slice(words, start, F.lit(n)), " ").alias("text"))
        clean = cut.where(F.length("text") >= 10).where(F.length(F.regexp_replace("text", r"[^\p{L} ]", "")) >= 0.8 * F.length("text"))
        [r] = language.identify(clean, model).agg(F.avg(F.col("rejected").cast("int")).alias("share"), F.count("*").alias("n")).collect()
        assert r["n"] > 500 and r["share"] < 0.01, n
    model = language.learn(learned.where("lang = 'en'"))
    found = language.identify(rest.select("text", "lang"), model).groupBy((F.col("lang") == "en").alias("en"))
    share = {r["en"]: r["share"] for r in found.agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert share[True] < 0.01 and share[False] > 0.95

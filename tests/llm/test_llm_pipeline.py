import hashlib

import pytest
from corpus_rows import SCHEMA, awkward_texts, frame
from pyspark.sql import functions as F
from test_llm_decontaminate import expected as hits
from test_llm_lines import expected as line_rows
from test_llm_near_text import expected as classes

import corpus_pipeline
from millrace.llm.pieces import load_vocabulary
from millrace.llm.sentencepieces import text_of
from millrace.llm.tables import table


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_each_stage_equals_brute_force_on_what_it_gets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language_id", "line_dedup", "minhash_dedup", "decontamination", "sentencepiece"]

    told = stage["language_id"](spark, docs, sf_dir).cache()
    assert told.columns == columns and told.count() >= 0.98 * docs.count()

    whole = stage["line_dedup"](spark, told, sf_dir).cache()
    assert whole.columns == columns
    texts = [(r.doc_id, r.text) for r in told.collect()]
    again = [(r.doc_id, r.text) for r in whole.collect()]
    got = {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in again}
    assert got == {(i, h) for i, _, _, h in line_rows(texts)}
    assert whole.where("n_chars <> length(text)").count() == 0

    single = stage["minhash_dedup"](spark, whole, sf_dir).cache()
    assert single.columns == columns
    keep = {i for i, _, c in classes(again, 5) if i == c}
    assert {r.doc_id for r in single.collect()} == keep

    clean = stage["decontamination"](spark, single, sf_dir).cache()
    assert clean.columns == columns
    kept = [(r.doc_id, r.text) for r in single.collect()]
    assert {r.doc_id for r in clean.collect()} == {i for i, *_, bad in hits(kept, items) if not bad}

    raw = load_vocabulary().raw
    done = stage["sentencepiece"](spark, clean, sf_dir).collect()
    assert len(done) == clean.count()
    assert all(text_of(r.ids, raw) == r.text and r.n_tokens == len(r.ids) for r in done)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r.doc_id for r in done)


OWN = ("n_lines", "n_dropped", "items", "hit_words", "n_words", "lang_pred", "rejected", "ids", "n_tokens", "caller", "_letters", "_low", "_row")


@pytest.mark.parametrize("rows", [[], awkward_texts(13)])
def test_awkward_rows_and_own_columns_go_through_all_stages(spark, sf_dir, rows):
    docs = frame(spark, rows, clashing=True)
    docs = docs.select("*", *(F.lit(f"own {c}").alias(c) for c in OWN if c not in docs.columns))
    own = [c for c in docs.columns if c not in [d.split()[0] for d in SCHEMA.split(", ")]]
    types = dict(docs.dtypes)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert {c: dict(docs.dtypes)[c] for c in types} == types, name
        assert all(r[c] == f"own {c}" for r in docs.collect() for c in own), name
    assert docs.columns[-2:] == ["ids_", "n_tokens_"]


def test_the_text_operators_can_be_imported_here():
    import __spark_entry__

    assert __spark_entry__.llm is not None

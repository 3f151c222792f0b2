import hashlib
import re

import pytest
from corpus_rows import awkward_texts, frame

from millrace.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "What is the tree by the river of stone and what ran there, naïve?"),
    (2, "short item"),
    (3, "   "),
    (4, None),
    (5, "SHORT, Item!"),
    (7, "one text that is copied word for word into many documents of this"),
    (None, "the tree by"),
    (None, "River of stone"),
]


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def expected(texts, items):
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(10, len(v))
            for window in {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if k else ():
                for j in range(len(w) - k + 1):
                    if tuple(w[j : j + k]) == window:
                        hit.update(range(j, j + k))
                        found.add(None if item is None else str(item))
        ids = ",".join(sorted(i for i in found if i is not None))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def texts():
    return awkward_texts(8) + [
        (900, "A short ITEM, and the tree by the River of stone and what ran there; naïve? short item short item"),
        (901, "shortitem short-item is the tree by the river of stone and what"),
    ]


@pytest.mark.parametrize("part_bytes", [10**6, 40])
def test_hits_equal_brute_force(spark, texts, part_bytes):
    from pyspark.sql import functions as F

    # Columns of the items and of the documents named like those inside.
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("items", F.lit("own"))
    docs = frame(spark, texts, clashing=True)
    found = decontaminate.find_contamination(docs, benchmark, keep=["doc_id", "text"], part_bytes=part_bytes).collect()
    small = [(i, t) for i, t in texts if len(t or "") < 5000]
    got = sorted(
        (
            (r.doc_id, r.n_words, sum(h["last"] - h["first"] + 1 for h in r.hit_words), len(r["items"]),
             hashlib.sha256(",".join(i for i in r["items"] if i is not None).encode()).hexdigest(), r.contaminated)
            for r in found if len(r.text or "") < 5000
        ),
        key=repr,
    )
    assert got == expected(small, ITEMS)
    for r in found:  # spans are places in the text as given
        for span, hit in zip(r.hit_spans, r.hit_words, strict=True):
            assert words(r.text[span["start"] : span["end"]]) == words(r.text)[hit["first"] : hit["last"] + 1]


def test_no_items_no_documents_clashing_columns(spark, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.find_contamination(frame(spark, texts, clashing=True), none)
    assert out.where("contaminated").count() == 0 and out.count() == len(texts)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.digest(frame(spark, []), benchmark).collect() == []

"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets.

1. Each text, whole, becomes a set of word shingles. Equal sets are one from here on.
2. Two collections of SIDE keys, each key of PER_KEY minhashes, are computed per set. Every
   pair of a left and a right key is the key of one table: SIDE * SIDE tables from
   2 * SIDE * PER_KEY minhashes. Two sets of similarity s meet in a table unless all left or
   all right keys differ: with 9 keys of 2, two in ten thousand pairs at 0.8 are missed, fewer
   than one in a hundred thousand at 0.9.
3. Table rows are range-partitioned by key and document, so a key that very many documents
   share spans partitions. Each partition streams its runs and links every document to the
   first and to the one before it; the runs that reach a partition's edge are linked by key.
4. Links whose minhashes agree in half of the places make families. Where a run still holds
   several families, every document outside its largest one is compared with all others of
   the run, by minhashes, in tiles of two blocks: whatever stands between two documents of a
   run, they are compared. A family then holds whatever may be near, so what is left is to
   compare inside families, exactly and on full sets.
5. Families of up to BLOCK sets and BLOCK_SHINGLES shingles are compared whole, several in a task.
   Larger ones are cut into blocks; each is compared whole and with the family's first document. Then
   every document outside the largest class found so far is compared with all others of its
   family, in tiles of two blocks. Tasks return a forest of the links they find, never pairs.

Work inside a family grows with the number of documents outside its largest class, times its
size, and work inside a run with the number outside its largest family, times its size.
Nothing is capped: blocks only bound what one task holds.

Defined cases: a null or empty text, or one without words, has no shingles and links with
nothing; fewer words than a shingle make one shingle; rows that share a doc_id are one
document with all their links; a row with a null doc_id is on its own; an empty table gives
no rows; other columns pass through `keep_one`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import Worker, add_columns
from millrace.llm.links import components, forest
from millrace.llm.shingles import fingerprints, linked_pairs, minhashes, mixed, shingle_sets
from millrace.llm.tables import kept

SHINGLE_WORDS = 5
PERCENT = 80
SIDE = 9
PER_KEY = 2
N_HASHES = 2 * SIDE * PER_KEY
#: Share of equal minhashes from which a link counts for families; well below the threshold.
FAMILY_SHARE = 0.5
BLOCK = 96
#: Shingles of the documents of a block, near; a longer text is a block of its own.
BLOCK_SHINGLES = 2_000_000
#: Documents of a run in a block; they are held as N_HASHES bytes each.
RUN_BLOCK = 2048
#: Up to this size a run's links to the first and the previous one are all its pairs.
ALL_LINKED = 3
TEXT_CHUNK = 2 * 1024 * 1024

SKETCH = "n_shingles long, f1 long, f2 long, hashes binary"


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id with the size and fingerprints of its set and its minhashes."""

    def start() -> Worker:
        def work(texts: list) -> list:
            value, offsets = shingle_sets(texts, words)
            f1, f2 = fingerprints(value, offsets)
            hashes = minhashes(value, offsets, N_HASHES)
            return [pa.array(np.diff(offsets)), pa.array(f1), pa.array(f2), [row.tobytes() for row in hashes]]

        return work

    return add_columns(docs, start, SKETCH, keep=["doc_id"], limit=TEXT_CHUNK)


def _table_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and table."""
    table = np.arange(SIDE * SIDE, dtype=np.uint64).reshape(1, SIDE, SIDE)
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint32)
        keys = np.ascontiguousarray(hashes.reshape(batch.num_rows, -1)).view(np.uint64)
        left, right = mixed(keys[:, :SIDE, None]), mixed(keys[:, None, SIDE:] + np.uint64(1))
        key = mixed(left + right * np.uint64(0x9E3779B97F4A7C15) + table).reshape(-1).view(np.int64)
        doc = np.repeat(batch.column("doc_id").to_numpy(), SIDE * SIDE)
        for at in range(0, len(key), 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(key[at : at + (1 << 20)]), pa.array(doc[at : at + (1 << 20)])], ["key", "doc_id"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted (key, doc_id) rows: to the first and the previous of the run.

    Rows with a key are the first documents of this partition's first and last run. Rows with a
    key and no b are members of runs of more than ALL_LINKED documents, and of those two.
    """

    def rows(a, b=None, key=None) -> pa.RecordBatch:
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        key = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)
        return pa.RecordBatch.from_arrays([pa.array(a), b, key], ["a", "b", "key"])

    # Of the run that is not over yet: members not given out, or else its key.
    held = np.zeros((2, 0), np.int64)
    wide = None

    def members(key: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        nonlocal held, wide
        key, doc = np.concatenate([held[0], key]), np.concatenate([held[1], doc])
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        key, doc = key[new], doc[new]
        begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(begins, len(key)))
        out = sizes > ALL_LINKED
        out[0] |= wide is not None and key[0] == wide
        wide = key[-1] if out[-1] else None
        out = np.repeat(out, sizes)
        held = np.zeros((2, 0), np.int64) if wide is not None else np.stack([key, doc])[:, begins[-1] :]
        if out.any():
            yield rows(doc[out], key=key[out])

    last_key = first_doc = last_doc = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc = batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()
        if last_key is None:
            yield rows(doc[:1], doc[:1], key[:1])
            wide = key[0]
        yield from members(key, doc)
        if last_key is not None:
            key = np.concatenate(([last_key], key))
            doc = np.concatenate(([last_doc], doc))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        first = doc[begin]
        if last_key is not None:
            first[begin == 0] = first_doc
        later = np.flatnonzero(~new)
        a = np.concatenate([doc[later], doc[later]])
        b = np.concatenate([first[later], doc[later - 1]])
        pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)
        if len(pairs):
            yield rows(pairs[:, 0], pairs[:, 1])
        last_key, first_doc, last_doc = key[-1], first[-1], doc[-1]
    if last_key is not None:
        yield rows(np.array([first_doc]), np.array([first_doc]), np.array([last_key]))
        if held.size:
            yield rows(held[1], key=held[0])


def _families(sets: DataFrame) -> DataFrame:
    """Components of the pairs that share a table key and half of their minhashes."""
    keys = sets.select("doc_id", "hashes").mapInArrow(_table_keys, "key long, doc_id long")
    sorted_keys = keys.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    found = kept(sorted_keys.mapInArrow(_runs, "a long, b long, key long"), "runs")
    edges = found.where("key is not null and b is not null")  # two per partition at most
    firsts = edges.groupBy("key").agg(F.min("a").alias("first"))
    across = edges.join(firsts, "key").select("a", F.col("first").alias("b")).where("a <> b")
    pairs = found.where(F.col("key").isNull()).select("a", "b").union(across)
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # One byte of each minhash tells agreement well enough here.
    small = sets.select("doc_id", _one_byte("hashes").alias("bytes"))
    both = pairs.join(small.toDF("a", "x"), "a").join(small.toDF("b", "y"), "b")
    labels = components(both.where(_agreeing("x", "y") >= FAMILY_SHARE * N_HASHES).select("a", "b"))
    members = found.where("key is not null and b is null").select("key", F.col("a").alias("doc_id")).distinct()
    more = _across_families(members, labels, small)
    return labels if more is None else components(labels.toDF("a", "b").union(more))


def _across_families(members: DataFrame, labels: DataFrame, small: DataFrame) -> DataFrame | None:
    """Links between the families that meet in a run; ``members`` has key and doc_id."""
    members = kept(
        members.join(labels, F.col("doc_id") == F.col("node"), "left")
        .select("key", "doc_id", F.coalesce("component", "doc_id").alias("family")),
        "run-members",
    )
    sizes = members.groupBy("key", "family").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("same"))
    runs = sizes.groupBy("key").agg(
        F.max(F.struct("n", "family")).alias("top"),
        F.sum("n").alias("all"),
        F.count("*").alias("families"),
        F.bit_xor("same").alias("same"),
    )
    # Tables often give the same run again.
    once = runs.where("families > 1").groupBy("same", "all").agg(F.min_by("top", "key").alias("top"), F.min("key").alias("key"))
    once = kept(once, "open-runs")
    total = once.agg(F.sum("all")).first()[0]
    if not total:
        return None
    run = members.join(once, "key").select(
        "key",
        "doc_id",
        (F.col("family") != F.col("top.family")).alias("outside"),
        F.ceil(F.col("all") / RUN_BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.n")) / RUN_BLOCK).cast("int").alias("out_blocks"),
    )
    run = run.join(small, "doc_id")
    # Every member meets each block of documents outside, and those meet every block.
    every = run.select(
        "*",
        F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.expr("sequence(0, out_blocks - 1)")).alias("out_block"),
        F.lit(False).alias("guest"),
    )
    guests = run.where("outside").select(
        "*",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("out_blocks")).cast("int").alias("out_block"),
        F.lit(True).alias("guest"),
    )
    # Runs of one block, several in a task.
    packs = F.lit(max(1, math.ceil(total / RUN_BLOCK)))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), packs)).otherwise(F.col("key"))
    tiles = every.unionByName(guests).select(
        "key", "doc_id", "bytes", "guest", F.struct(pack.alias("pack"), "blocks", "block", "out_block").alias("tile")
    )
    return kept(tiles.groupBy("tile").applyInPandas(_half_agreeing, "a long, b long"), "across")


def _half_agreeing(tile: pd.DataFrame) -> pd.DataFrame:
    """Forest of the links between the guests and the members of each run in a tile."""
    tile = tile.sort_values("key", kind="stable")
    key, ids, guest = (tile[c].to_numpy() for c in ("key", "doc_id", "guest"))
    hashes = np.frombuffer(b"".join(tile["bytes"]), np.uint8).reshape(len(tile), -1)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    for low, high in zip(begins, np.append(begins[1:], len(key))):
        x, y = low + np.flatnonzero(guest[low:high]), low + np.flatnonzero(~guest[low:high])
        same = np.zeros((len(x), len(y)), np.uint8)
        for i in range(hashes.shape[1]):
            same += hashes[x, i][:, None] == hashes[y, i]
        left, right = np.nonzero(same >= FAMILY_SHARE * N_HASHES)
        left, right = forest(ids[x[left]], ids[y[right]]) if len(left) else (ids[:0], ids[:0])
        a.append(left)
        b.append(right)
    return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


@F.pandas_udf(T.BinaryType())
def _one_byte(hashes: pd.Series) -> pd.Series:
    return hashes.map(lambda h: h[::4])


@F.pandas_udf(T.IntegerType())
def _agreeing(x: pd.Series, y: pd.Series) -> pd.Series:
    a = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
    b = np.frombuffer(b"".join(y), np.uint8).reshape(len(y), -1)
    return pd.Series((a == b).sum(axis=1).astype(np.int32))


def _compare(words: int, percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Forest of the links in each part of a tile."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, part in tile.groupby("part", sort=False):
            ids = part["doc_id"].to_numpy()
            value, offsets = shingle_sets(part["text"].tolist(), words)
            x, y = linked_pairs(value, offsets, percent)
            x, y = forest(ids[x], ids[y]) if len(x) else (ids[:0], ids[:0])
            a.append(x)
            b.append(y)
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _confirmed(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Forest of all links inside families; ``texts`` has doc_id, family, blocks, text.

    ``blocks``: into how many blocks the family is to be cut.
    """
    links = "a long, b long"
    compare = _compare(words, percent)
    small = texts.where("blocks = 1")
    held = small.agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).first()
    packs = F.lit(max(1, math.ceil(2 * held["n"] / BLOCK), math.ceil(2 * (held["shingles"] or 0) / BLOCK_SHINGLES)))
    pack = small.select("doc_id", "text", F.col("family").alias("part"), F.pmod(F.xxhash64("family"), packs).alias("tile"))
    found = pack.groupBy("tile").applyInPandas(compare, links)

    large = texts.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # The family's first document comes to every block.
    leads = large.where(F.col("doc_id") == F.col("family")).withColumn(
        "block", F.explode(F.expr("filter(sequence(0, blocks - 1), i -> i <> block)"))
    )
    first_pass = large.unionByName(leads).select("doc_id", "text", F.struct("family", "block").alias("part"))
    within = kept(
        first_pass.withColumn("tile", F.col("part")).withColumn("part", F.lit(0)).groupBy("tile").applyInPandas(compare, links),
        "within",
    )
    labels = components(within)
    classed = kept(
        large.select("doc_id", "family", "n_shingles").join(labels, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "family", "n_shingles", F.coalesce("component", "doc_id").alias("class")),
        "classes",
    )
    sizes = classed.groupBy("family", "class").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    largest = sizes.groupBy("family").agg(
        F.max(F.struct("n", "class", "shingles")).alias("top"), F.sum("n").alias("all"), F.sum("shingles").alias("all_shingles")
    )
    outside = (
        classed.join(largest, "family")
        .where(F.col("class") != F.col("top.class"))
        .select(
            "doc_id",
            "family",
            _blocks(F.col("all") - F.col("top.n"), F.col("all_shingles") - F.col("top.shingles")).alias("out_blocks"),
        )
    )
    outside = kept(
        outside.withColumn("out_block", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("out_blocks")).cast("int")), "outside"
    )
    counts = outside.groupBy("family").agg(F.max("out_blocks").alias("out_blocks"))
    base = large.select("doc_id", "text", "family", "block", "blocks")
    # Every member meets each block of documents outside, and those meet every block.
    members = base.join(counts, "family").select(
        "doc_id", "text", "family", "block", F.explode(F.expr("sequence(0, out_blocks - 1)")).alias("out_block")
    )
    guests = base.join(outside.select("doc_id", "out_block"), "doc_id").select(
        "doc_id", "text", "family", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "out_block"
    )
    tiles = members.unionByName(guests).select(
        "doc_id", "text", F.struct("family", "block", "out_block").alias("tile"), F.lit(0).alias("part")
    )
    crossing = tiles.groupBy("tile").applyInPandas(compare, links)
    return found.union(within).union(crossing)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per row of ``docs``."""
    texts = docs.select("doc_id", "text")
    rows = kept(sketches(texts, words), "sketches")
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same_set = ["f1", "f2", "n_shingles"]
    # Written, so that the join may split a set that very many documents share.
    firsts = kept(full.groupBy(*same_set).agg(F.min("doc_id").alias("first")), "first-copies")
    copies = kept(full.join(firsts, same_set).select("doc_id", "first", "n_shingles", "hashes"), "copies")
    sets = copies.where("doc_id = first").select("doc_id", "hashes")
    families = _families(sets)
    families = kept(families.select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "families")
    # An id with several sets has a row for each; the sum is large enough for all of them.
    lengths = copies.where("doc_id = first").groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    families = families.join(lengths, "doc_id")
    sizes = families.groupBy("family").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("blocks"))
    counted = families.join(sizes, "family")
    # Texts move to their families once, in the same way whatever the size.
    members = kept(texts.join(counted.hint("merge"), "doc_id"), "family-texts")
    confirmed = _confirmed(members, words, percent)
    same = copies.where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    classes = components(confirmed.union(same))
    return rows.join(classes, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its class."""
    classes = near_duplicates(docs, words, percent)
    gone = classes.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def digest(docs: DataFrame, words: int = 2) -> DataFrame:
    return near_duplicates(docs, words).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
)
ORACLE = f"""
with recursive d as (select doc_id, {_SQL_WORDS} as w from documents),
s as (
  select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as x
  from (select *, unnest(range(1, greatest(len(w), 2))) as i from d where len(w) > 0)
), sizes as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes p on a = p.doc_id join sizes q on b = q.doc_id
  where 100 * c >= 80 * (p.n + q.n - c)
), ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join ways l on r.b = l.a
), least as (select a, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from d join least on d.doc_id = least.a left join sizes on d.doc_id = sizes.doc_id
"""

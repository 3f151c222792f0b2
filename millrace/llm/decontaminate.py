"""Benchmark decontamination: one Aho-Corasick automaton over the test items.

An item's windows (ten words in a row; a shorter item is one window) become strings of words
between single spaces, so that a match begins and ends at word borders. All windows go into
one automaton; a document's text is normalised the same way and scanned once. Matches map to
word numbers, and those to code points of the original text.

The items are the only thing sent to every task. Their size is measured first: beyond
``PART_BYTES`` they are scanned in parts of about that size, one automaton after the other,
and the hits of a document are merged, so memory stays bounded whatever the benchmark holds.

Defined cases: a null text has no words; an item without words has no windows; items with
equal windows are all reported; rows that share an item_id are one item, and so are all items
without an id, which count and hit like others and come last, as null; a row that occurs
twice is reported twice; other columns pass through, but for those named like a result; an empty benchmark hits nothing; no documents give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import Worker, add_columns
from millrace.llm.tables import kept

WINDOW = 10
PART_BYTES = 8 * 1024 * 1024

#: Bytes of words: digits, letters (lower-cased) and every byte of a character above 127.
_NORMAL = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = (
    "n_words long, hit_words array<struct<first: long, last: long>>, "
    "hit_spans array<struct<start: long, end: long>>, items array<string>"
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def build_automaton(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton | None:
    """Windows of all items; the value is the window's length and the items that hold it."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            # Bytes as characters, one to one: offsets of matches are byte offsets.
            key = f" {b' '.join(part).decode('latin-1')} "
            found.setdefault(key, (len(key), set()))[1].add(item_id)
    if not found:
        return None
    automaton = ahocorasick.Automaton()
    for key, value in found.items():
        automaton.add_word(key, value)
    automaton.make_automaton()
    return automaton


def merged(intervals) -> list[tuple[int, int]]:
    """Inclusive intervals, merged where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(intervals):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _spans(text: str, hits: list[tuple[int, int]]) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[first][0], "end": places[last][1]} for first, last in hits]


def scan_text(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged intervals of hit words, items that occur."""
    words = words_of(text)
    if automaton is None or not words:
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    found = [(end - length + 1, end, items) for end, (length, items) in automaton.iter(line)]
    if not found:
        return len(words), [], set()
    # Word k begins one past starts[k], the offset of the space before it.
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    first = np.searchsorted(starts, [f[0] for f in found])
    last = np.searchsorted(starts, [f[1] for f in found]) - 1
    return len(words), merged(zip(first.tolist(), last.tolist())), set().union(*(f[2] for f in found))


def _worker(items: list[tuple[str, str | None]], window: int) -> Callable[[], Worker]:
    def start() -> Worker:
        automaton = build_automaton(items, window)

        def work(texts: list) -> list:
            rows = [scan_text(automaton, text) for text in texts]
            return [
                [n for n, _, _ in rows],
                [[{"first": a, "last": b} for a, b in hits] for _, hits, _ in rows],
                [_spans(t, hits) if hits else [] for t, (_, hits, _) in zip(texts, rows)],
                # An item without an id comes last, as in Spark's order of arrays.
                [sorted(found, key=lambda i: (i is None, i or "")) for _, _, found in rows],
            ]

        return work

    return start


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    keep: list[str] | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``keep`` (default: all columns) with n_words, hit_words, hit_spans, items, contaminated."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    of_id = F.coalesce(F.octet_length("item_id"), F.lit(0))
    size = items.agg(F.sum(F.octet_length("text") + of_id)).first()[0] or 0
    n_parts = max(1, math.ceil(size / part_bytes))
    if n_parts == 1:
        found = add_columns(docs, _worker([tuple(r) for r in items.collect()], window), HITS, keep=keep)
    else:
        found = _in_parts(docs, items, window, keep, n_parts)
    return found.withColumn("contaminated", F.size("hit_words") > 0)


def _in_parts(docs, items, window, keep, n_parts) -> DataFrame:
    """The scan for each part of the items, one after the other, merged by row."""
    held = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "hit_words", "hit_spans", "items", "contaminated")]
    numbered = kept(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    part_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts))
    parts = []
    for part in range(n_parts):
        rows = [tuple(r) for r in items.where(part_of == part).collect()]
        hits = add_columns(numbered.select("_row", "text"), _worker(rows, window), HITS, keep=["_row"])
        parts.append(kept(hits.where(F.size("hit_words") > 0), "hits"))
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    rows = hits.groupBy("_row").agg(  # a row per part at most
        F.flatten(F.collect_list("hit_words")).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def start() -> Worker:
        def work(texts: list) -> list:
            return [[len(words_of(t)) for t in texts]]

        return work

    def join_up(batches):
        for pdf in batches:
            both = [merged((h["first"], h["last"]) for h in hits) for hits in pdf["hit_words"]]
            pdf["hit_words"] = [[{"first": a, "last": b} for a, b in hits] for hits in both]
            pdf["hit_spans"] = [_spans(t, hits) for t, hits in zip(pdf["text"], both)]
            yield pdf[["_row", "hit_words", "hit_spans", "items"]]

    joined = rows.join(numbered.select("_row", "text"), "_row").mapInPandas(
        join_up, "_row long, " + HITS.split(", ", 1)[1]
    )
    counted = add_columns(numbered, start, "n_words long", keep=[*held, "_row"])
    empty = F.array()
    return counted.join(joined, "_row", "left").select(
        *held,
        "n_words",
        F.coalesce("hit_words", empty).alias("hit_words"),
        F.coalesce("hit_spans", empty).alias("hit_spans"),
        F.coalesce("items", empty).alias("items"),
    )


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs.select("doc_id", "text"), benchmark, keep=["doc_id"])
    covered = F.aggregate(
        "hit_words", F.lit(0).cast("long"), lambda n, hit: n + hit["last"] - hit["first"] + 1
    )
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
with d as (select doc_id, {_SQL_WORDS} as w from documents),
b as (select item_id::varchar as item_id, {_SQL_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s
  from (select *, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from b where len(w) > 0)
), lengths as (select distinct k from windows),
places as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as s
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, lengths where len(w) >= k)
), found as (
  select p.doc_id, p.i, p.k, v.item_id from places p join windows v on p.s = v.s and p.k = v.k
), hit as (
  select doc_id, count(distinct n) as n_hit from (select doc_id, unnest(range(i, i + k)) as n from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from found) group by doc_id
)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""

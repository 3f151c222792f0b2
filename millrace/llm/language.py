"""Language ID: averaged hashed subword embeddings under a linear softmax, with rejection.

A subword is two to four bytes of a word with its borders, A-Z in lower case, hashed into
BUCKETS rows of an embedding table. A text is the mean of its subwords' rows; a linear layer
and a softmax give the languages. Both layers are trained on the driver in numpy by stochastic
gradient descent, on a bounded sample of labelled texts: at most ``sample`` different texts, shared
out evenly among the languages (among the most frequent ``sample`` ones, if there are more), each as
its counts per bucket (so at most BUCKETS numbers a text,
however long). A fifth of each language's sample calibrates: a temperature (1 or more, so confidence
is never sharpened) that makes the softmax's confidence honest, and two bounds below either of which
a text is rejected. One is on the confidence. The other is on how usual the text's subwords are: the
mean log of their share in the learned texts, all languages alike, over an even share; it means the
same for any number of languages, also for one, whose confidence is always 1. Both scatter more the
shorter a text is, so the bounds go by the number of subwords: the calibrating texts are also cut to
passages of WINDOWS words, and near each power of two of subwords each bound is set so that RISK of
the rightly labelled texts and of the passages would be lost; where those are too few to tell, it is
at the least of them or TAIL deviations below their mean, whichever is lower. Between powers of
two, bounds are drawn straight; a text shorter than the shortest passages is not rejected.

Since the mean and the layer are linear, prediction needs one number per bucket and language, and
one for how usual the bucket is: every text, whole, is a sum of table rows.

Defined cases: a text that is null or has no letter is `und` with score 0 and is rejected; with
no labelled text at all every text is; one language alone gets score 1; rows with a null
label are predicted and not learned from; repeated rows are predicted each and learned from once; a
column named like a result gives way to it, other columns pass through `identify` as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import Worker, add_columns
from millrace.llm.tables import crc_bucket

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
DIMENSIONS = 16
SAMPLE = 4000
EPOCHS = 4
#: Steps taken at least; a small sample is gone through more often.
LEAST_STEPS = 400
BATCH = 32
RATE = 4.0
RISK = 0.002
#: Deviations below the mean of a normal variable at which RISK is left.
TAIL = 2.88
#: Share of an even spread mixed into the shares of buckets, for those not seen.
EVEN = 0.01
#: Byte positions worked on at once.
STRIDE = 1 << 20
UNKNOWN = "und"
#: Words in the passages that calibrate the bounds for short texts.
WINDOWS = (1, 2, 4, 8, 16, 32, 64)
#: Every so many texts of a language calibrate.
HELD = 5

_BYTES = np.array(
    [c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)], np.uint8
)


def subword_buckets(block: np.ndarray, size: int) -> list[np.ndarray]:
    """For each order, the bucket of the subword at each of ``size`` positions; BUCKETS for none.

    ``block`` holds normalised bytes, with as many more at its end as the longest order needs.
    """
    out = []
    border = block == 32
    wide = block.astype(np.uint32)
    for order in ORDERS:
        value = np.full(size, order, np.uint32)
        for i in range(order):
            value = (value ^ wide[i : i + size]) * np.uint32(16777619)
        value = (value ^ (value >> np.uint32(15))) * np.uint32(2246822519)
        bucket = (value >> np.uint32(17)).astype(np.int32)
        bad = border[:size] & border[order - 1 : order - 1 + size]
        for i in range(1, order - 1):
            bad = bad | border[i : i + size]
        if order > 2:  # a word of order - 2 letters has a border on both sides
            inside = border[1 : 1 + size].copy()
            for i in range(2, order - 1):
                inside |= border[i : i + size]
            bad = inside
        bucket[bad] = BUCKETS
        out.append(bucket)
    return out


def _blocks(texts: list):
    """Bytes of all texts between spaces, in strides: (owner of each run, its starts, buckets)."""
    parts = [t.encode() if t else b"" for t in texts]
    joined = np.frombuffer(b" " + b" ".join(parts) + b"      ", np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    begins = np.concatenate(([0], np.cumsum(sizes)))  # a text's positions include the space before it
    total = int(begins[-1])
    for at in range(0, total, STRIDE):
        size = min(STRIDE, total - at)
        low = np.searchsorted(begins, at, "right") - 1
        high = np.searchsorted(begins, at + size, "left")
        starts = np.maximum(begins[low:high] - at, 0)
        yield np.arange(low, high), starts, subword_buckets(_BYTES[joined[at : at + size + max(ORDERS)]], size)


def bucket_counts(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of each text."""
    held: list[dict] = [{} for _ in texts]
    for owners, starts, orders in _blocks(texts):
        ends = np.append(starts[1:], len(orders[0]))
        for owner, start, end in zip(owners, starts, ends):
            found, n = np.unique(np.concatenate([o[start:end] for o in orders]), return_counts=True)
            for b, c in zip(found.tolist(), n.tolist()):
                if b != BUCKETS:
                    held[owner][b] = held[owner].get(b, 0) + c
    return [
        (np.fromiter(h, np.int32, len(h)), np.fromiter(h.values(), np.int32, len(h))) for h in held
    ]


@dataclass(frozen=True)
class Bounds:
    """What is accepted at least, by the logarithm of the number of subwords."""

    sizes: np.ndarray
    odds: np.ndarray  # of the confidence
    usual: np.ndarray
    shorter: bool  # whether texts below the least size have its bounds, or none

    def below(self, confidence: np.ndarray, usual: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros(len(n), bool)
        at = np.log2(np.maximum(n, 1))

        def bound(values: np.ndarray) -> np.ndarray:
            return np.interp(at, self.sizes, values, left=values[0] if self.shorter else -np.inf)

        return (_odds(confidence) < bound(self.odds)) | (usual < bound(self.usual))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # (BUCKETS + 1, languages + 1): embeddings times layer, how usual; the last row is none
    bias: np.ndarray
    temperature: float
    bounds: Bounds

    def logits(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of each text, how usual its subwords are, and their number."""
        total = np.zeros((len(texts), self.table.shape[1]))
        n = np.zeros(len(texts))
        for owners, starts, orders in _blocks(texts):
            for buckets in orders:
                total[owners] += np.add.reduceat(self.table[buckets], starts, axis=0)
                n[owners] += np.add.reduceat((buckets != BUCKETS).astype(np.int32), starts)
        mean = total / np.maximum(n, 1)[:, None]
        return mean[:, :-1] + self.bias, mean[:, -1], n


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


Row = tuple[str, np.ndarray, np.ndarray]


def train(
    rows: list[Row], held: np.ndarray | None = None, windows: list[Row] | None = None, seed: int = 7
) -> LanguageModel | None:
    """Fit on (label, buckets, counts) per text; the ``held`` ones, by default every fifth, and passages calibrate."""
    languages = tuple(sorted({label for label, _, _ in rows}))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[label] for label, _, _ in rows])
    held = np.arange(len(rows)) % HELD == HELD - 1 if held is None else held
    learned = np.flatnonzero(~held)
    once = max(1, -(-len(learned) // BATCH))
    epochs = max(EPOCHS, -(-LEAST_STEPS // once))
    steps, step = epochs * once, 0
    for _ in range(epochs):
        order = rng.permutation(learned)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            used, where = np.unique(np.concatenate([rows[i][1] for i in batch]), return_inverse=True)
            means = np.zeros((len(batch), len(used)), np.float32)
            lengths = [len(rows[i][1]) for i in batch]
            means[np.repeat(np.arange(len(batch)), lengths), where] = np.concatenate(
                [rows[i][2] / max(1, rows[i][2].sum()) for i in batch]
            )
            hidden = means @ embedding[used]
            slope = softmax(hidden @ layer + bias)
            slope[np.arange(len(batch)), labels[batch]] -= 1
            rate = RATE * (1 - step / steps)
            back = slope @ layer.T
            layer -= rate / len(batch) * (hidden.T @ slope)
            bias -= 0.1 * rate / len(batch) * slope.sum(axis=0)
            embedding[used] -= rate * (means.T @ back)
            step += 1
    usual = _usual([rows[i] for i in learned], labels[learned])
    table = np.vstack([np.column_stack([embedding @ layer, usual]), np.zeros((1, len(languages) + 1))]).astype(np.float32)
    return LanguageModel(
        languages, table, bias, *_calibrate(table, bias, [rows[i] for i in np.flatnonzero(held)], windows or [], number)
    )


def _usual(rows: list[tuple[str, np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Log of each bucket's share over an even share; texts of a language, then languages, count alike."""
    share = np.zeros(BUCKETS)
    texts = np.bincount(labels)
    for (_, b, c), label in zip(rows, labels):
        share[b] += c / max(1, c.sum()) / texts[label]
    return np.log(EVEN + (1 - EVEN) * BUCKETS * share / max(share.sum(), 1e-12))


def _odds(confidence: np.ndarray) -> np.ndarray:
    confidence = np.clip(confidence.astype(float), 1e-12, 1 - 1e-12)
    return np.log(confidence / (1 - confidence))


def _calibrate(
    table: np.ndarray, bias: np.ndarray, texts: list[Row], windows: list[Row], number: dict[str, int]
) -> tuple[float, Bounds]:
    """Temperature of least loss over the texts; bounds by length over texts and passages."""
    none = np.zeros(0)
    if not texts:
        return 1.0, Bounds(none, none, none, False)

    def means(rows: list[Row]) -> np.ndarray:
        found = [(table[b] * (c / max(1, c.sum()))[:, None]).sum(axis=0) for _, b, c in rows]
        return np.array(found).reshape(-1, table.shape[1])

    of_texts = means(texts)
    labels = np.array([number[label] for label, _, _ in texts])
    at = np.arange(len(labels))
    logits = of_texts[:, :-1] + bias

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(softmax(logits / temperature)[at, labels], 1e-12)).mean()

    temperature = float(min(np.geomspace(1, 20, 61), key=loss))
    right = logits.argmax(axis=1) == labels
    every = np.concatenate([of_texts[right], means(windows)])
    sizes = np.array([c.sum() for _, _, c in (*(t for t, ok in zip(texts, right) if ok), *windows)], float)
    if not len(every):
        return temperature, Bounds(none, none, none, False)
    odds = _odds(softmax((every[:, :-1] + bias) / temperature).max(axis=1))
    usual, size = every[:, -1], np.log2(np.maximum(sizes, 1))
    bounds = []
    for k in range(2, int(size.max()) + 2):
        near = np.abs(size - k) <= 0.75
        if near.sum() >= 30:
            bounds.append((float(k), _lower_bound(odds[near]), _lower_bound(usual[near])))
    if not bounds:  # too few to tell lengths apart
        bounds = [(0.0, _lower_bound(odds), _lower_bound(usual))]
    return temperature, Bounds(*map(np.array, zip(*bounds)), not windows)


def _lower_bound(values: np.ndarray) -> float:
    """What RISK of such values lie below."""
    if len(values) * RISK >= 1:
        return float(np.quantile(values, RISK))
    return float(min(values.min(), values.mean() - TAIL * values.std()))


def learn(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel | None:
    """Fit on ``text`` and ``lang`` of a sample of the rows, chosen by a hash of the text."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text")
    rows = rows.withColumn("hash", F.xxhash64("text", "lang"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n"))
    counts = {r["lang"]: max(1, r["n"]) for r in sizes.orderBy(F.desc("n"), "lang").limit(sample).collect()}
    if not counts:
        return None
    each = sample // len(counts)
    # So many more that a language of enough texts fills its places, whatever the hash picks.
    wanted = each + 4 * math.sqrt(each) + 8
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, wanted / n)))
    place = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    picked = rows.withColumn("place", place).where(F.col("place") < share[F.col("lang")])
    # Copies are merged in each task before they move; then each language is cut to its places.
    picked = picked.groupBy("lang", "place", "hash").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "hash"))
    picked = picked.withColumn("rank", rank).where(F.col("rank") <= each)

    def start() -> Worker:
        def work(texts: list) -> list:
            found = bucket_counts(texts)
            # As bytes: the driver holds all of the sample, and numbers as objects take tenfold.
            return [[b.tobytes() for b, _ in found], [c.tobytes() for _, c in found]]

        return work

    keep = ["lang", "place", "hash", "part"]
    parts = picked.select("lang", "place", "hash", (F.col("rank") % HELD == 0).alias("held"), "text")
    words = F.split(F.trim("text"), r"\s+")
    # Passages of the texts that calibrate; where one begins goes by the hash of its text.
    passages = [
        F.when(
            F.size(words) > n,
            F.array_join(F.slice(words, (F.pmod("hash", F.size(words) - n) + 1).cast("int"), F.lit(n)), " "),
        )
        for n in WINDOWS
    ]
    cut = F.when(F.col("held"), F.array(F.col("text"), *passages)).otherwise(F.array("text"))
    parts = parts.select("lang", "place", "hash", "held", F.posexplode(cut).alias("part", "text")).where("text is not null")
    features = add_columns(parts, start, "buckets binary, counts binary", keep=[*keep, "held"])
    found = sorted(features.collect(), key=lambda r: (r["place"], r["lang"], r["hash"], r["part"]))
    numbers = [(r["lang"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in found]
    whole = [i for i, r in enumerate(found) if r["part"] == 0]
    windows = [numbers[i] for i, r in enumerate(found) if r["part"] > 0 and len(numbers[i][2])]
    return train([numbers[i] for i in whole], np.array([found[i]["held"] for i in whole], bool), windows)


def _worker(model: LanguageModel | None) -> Callable[[], Worker]:
    def start() -> Worker:
        def work(texts: list) -> list:
            if model is None:
                return [[UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)]
            logits, usual, n = model.logits(texts)
            sure = softmax(logits / model.temperature)
            best = sure.argmax(axis=1)
            score = sure[np.arange(len(texts)), best]
            low = model.bounds.below(score, usual, n)
            return [[model.languages[i] for i in best], pa.array(score), pa.array(low)]

        return work

    return start


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with lang_pred, score and rejected."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "rejected")]
    # The caller's columns in one, so that none meets a name used here; the text goes beside it.
    own = [F.col(f"`{c}`") for c in keep if c != "text"]
    marked = docs.select(
        F.struct(*own).alias("row") if own else F.lit(0).alias("row"),
        "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    held = ["row", "letters", *(["text"] if "text" in keep else [])]
    found = add_columns(marked, _worker(model), "best string, sure double, low boolean", keep=held)
    return found.select(
        *(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep),
        F.when(F.col("letters"), F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.col("sure")).otherwise(0.0).alias("score"),
        (~F.col("letters") | F.col("low")).alias("rejected"),
    )


def held_out(doc_id: Column) -> Column:
    return crc_bucket(doc_id, 4) == 2


def digest(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    model = learn(docs.where(~held_out(F.col("doc_id"))), sample)
    return identify(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )

"""LM scoring by a log-bilinear model, trained in numpy by noise-contrastive estimation.

1. Words are counted over all training texts in Spark. A word whose count is over a bound has a
   vector of its own, as a context and as a prediction; the bound grows with the square root of
   the corpus, so the model's vocabulary grows with it. Rarer words share SUFFIX_UNITS units
   by their last two bytes, where a word's probability is its smoothed share of the unit.
2. Units lie in classes, cut from most to least frequent at equal sums of square roots of counts.
   A unit's probability is that of its class times its own in the class. Both come from the
   same predicted vector, a weighted sum of the vectors of the CONTEXT units before.
3. Texts become unit numbers once. They are dealt by row to slices of near SLICE_TOKENS tokens, and
   the slices to ROUNDS rounds. In a round every slice trains from the same parameters: each
   class and unit seen is told apart from noise drawn from the class counts and from the counts
   inside the class, in batches, as matrix products with AdaGrad steps. What the slices changed
   in a row is averaged in Spark over those that touched it, and the next round begins there.
   All training tokens are used once; how the table is cut into files or tasks does not matter
   but by chance.
4. For scoring, scores are normalised over all classes and over all units of the class seen.

Sent to every task, and held by the driver, are the counts of at most HEAD words of up to HEAD_BYTES
bytes, and vectors for those of them that are over the bound. The other words of a text are
joined with the counts by 128 bits of hashes, so no table of all words is ever sent.

Defined cases: a null text is empty and is the end alone; an empty training set gives base
scores of 0 and a model that knows nothing; repeated rows are scored each (and learned from
each); a null doc_id counts as empty text for the split; a text of any length is read whole; a
column named like a result gives way to it, other columns pass through `score` as they are.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import Worker, add_columns, chunks
from millrace.llm.tables import crc_bucket, kept

#: The end of a text; no word is empty.
END = b""
#: Bound on the words whose counts are sent to every task, and on the bytes of each.
HEAD = 1 << 18
HEAD_BYTES = 64
#: Words of LEAST tokens and of ROOT_SHARE times the root of all tokens have vectors.
LEAST, ROOT_SHARE = 8, 1 / 40
SUFFIX_UNITS = 64
#: Classes are so many times the root of the units, where scoring looks at the fewest.
CLASS_SHARE = 0.63
DIMENSIONS = 8
CONTEXT = 2
#: Noise samples: classes for a batch, units for each token.
CLASS_NOISE, UNIT_NOISE = 12, 1
BATCH = 2048
RATE = 0.3
#: A step takes the sum of a batch's slopes by so much.
STEP = 1 / 64
SLICE_TOKENS = 2_000_000
ROUNDS = 8
#: Distinct words a task holds before it passes their counts on.
COUNTED_AT_ONCE = 300_000


def tokens(text: str | None) -> list[bytes]:
    # bytes.lower changes A-Z alone; bytes.split cuts at space and the bytes 9 to 13.
    return [*text.encode().lower().split(), END] if text else [END]


def suffix_unit(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIX_UNITS


_SECOND = xxhash.xxh64_intdigest(b"second", 42)


def word_hashes(word: bytes) -> tuple[int, int]:
    """As Spark's xxhash64 of the word, and of the text "second" and the word."""
    values = xxhash.xxh64_intdigest(word, 42), xxhash.xxh64_intdigest(word, _SECOND)
    return tuple(v - (1 << 64) if v >> 63 else v for v in values)


def count_words(texts: DataFrame) -> DataFrame:
    """word, c over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"]
            )
            held.clear()
            return batch

        for batch in chunks(batches, "text", 1 << 21):
            for text in batch.column("text").to_pylist():
                held.update(tokens(text))
            if len(held) > COUNTED_AT_ONCE:
                yield out()
        yield out()

    return texts.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Corpus:
    """Counts of frequent words and of units; ``n``: tokens, ``v``: distinct tokens.

    Units are numbered class by class, the most frequent first.
    """

    n: int
    v: int
    words: dict[bytes, int]  # frequent word -> its number, most frequent first
    counts: np.ndarray  # by that number
    unit: np.ndarray  # of each frequent word
    suffix: np.ndarray  # unit of each suffix
    own: int  # the first so many frequent words have a unit of their own
    mass: np.ndarray  # tokens of each unit, and a half
    first: np.ndarray  # where each class begins, and the number of units
    below: np.ndarray  # denominators of the shares inside the suffix units

    @property
    def n_units(self) -> int:
        return len(self.mass)

    @property
    def n_classes(self) -> int:
        return len(self.first) - 1

    def class_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_classes, dtype=np.int32), np.diff(self.first))

    def base_logs(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


def classes_of(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units in the order of their classes, and where each class begins."""
    order = np.argsort(-mass, kind="stable")
    wanted = max(1, round(CLASS_SHARE * math.sqrt(len(mass))))
    place = np.cumsum(np.sqrt(mass[order]))
    cut = np.minimum((place / place[-1] * wanted).astype(np.int64), wanted - 1)
    begins = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1])))
    return order, np.append(begins, len(mass))


def summarise_counts(counts: DataFrame) -> Corpus:
    suffix = F.when(F.length("word") == 0, -1).otherwise(
        F.crc32(F.substring("word", -2, 2)) % SUFFIX_UNITS
    )
    by_suffix = counts.groupBy(suffix.alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    n, v = sum(r["c"] for r in by_suffix), sum(r["v"] for r in by_suffix)
    # The lowest count that no more than HEAD words reach, from a histogram of a few thousand bins.
    bin_ = F.floor(F.log2("c") * 64).cast("int")
    short = counts.where(F.length("word") <= HEAD_BYTES)
    bins = sorted(short.groupBy(bin_.alias("bin")).count().collect(), key=lambda r: -r["bin"])
    held, lowest = 0, None
    for r in bins:
        held += r["count"]
        if held > HEAD:
            break
        lowest = r["bin"]
    rows = [] if lowest is None else short.where(bin_ >= lowest).collect()
    rows = sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))
    words = {word: i for i, (word, _) in enumerate(rows)}
    least = max(LEAST, ROOT_SHARE * math.sqrt(n))
    own = sum(c >= least or word == END for word, c in rows)
    if END in words and words[END] >= own:  # the end always has a unit of its own
        at = rows.pop(words[END])
        rows.insert(own - 1, at)
        words = {word: i for i, (word, _) in enumerate(rows)}
    mass = np.full(own + SUFFIX_UNITS, 0.5)
    below = np.full(SUFFIX_UNITS, 0.5)
    for r in by_suffix:
        if r["g"] >= 0:
            mass[own + r["g"]] += r["c"]
            below[r["g"]] += r["c"] + 0.5 * r["v"]
    for i, (word, c) in enumerate(rows[:own]):
        mass[i] += c
        if word != END:
            mass[own + suffix_unit(word)] -= c
            below[suffix_unit(word)] -= c + 0.5
    order, first = classes_of(mass)
    place = np.empty(len(mass), np.int32)
    place[order] = np.arange(len(mass), dtype=np.int32)
    unit = place[[i if i < own else own + suffix_unit(word) for word, i in words.items()]] if words else np.zeros(0, np.int32)
    counted = np.array([c for _, c in rows], np.int64)
    return Corpus(n, v, words, counted, unit, place[own:], own, mass[order], first, below)


PARTS = (
    "units binary, n_tokens long, n_known long, base double, share double, "
    "rare array<struct<h1: long, h2: long, g: int, times: long>>"
)


def _lists(rare: Counter, n: int) -> pa.Array:
    """Hashes, suffix and number of each text's rare words."""
    hashes = [word_hashes(word) for _, word, _ in rare]
    columns = {
        "h1": pa.array([a for a, _ in hashes], pa.int64()),
        "h2": pa.array([b for _, b in hashes], pa.int64()),
        "g": pa.array([g for _, _, g in rare], pa.int32()),
        "times": pa.array(list(rare.values()), pa.int64()),
    }
    ends = np.cumsum(np.bincount([d for d, _, _ in rare], minlength=n)) if rare else np.zeros(n, int)
    values = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)


def _coder(sent) -> Callable[[], Worker]:
    """Texts as unit numbers, with what the counts of frequent words say of them."""

    def start() -> Worker:
        corpus = Corpus(*sent.value)
        get = corpus.words.get
        base = np.append(corpus.base_logs(corpus.counts), 0.0)  # the last one stands for rare words
        unit = np.append(corpus.unit, 0).astype(np.int32)
        share = np.zeros(len(base))
        inside = np.array([suffix_unit(w) for w in list(corpus.words)[corpus.own :]], np.int64)
        share[corpus.own : -1] = np.log10((corpus.counts[corpus.own :] + 0.5) / corpus.below[inside])

        def work(texts: list) -> list:
            split = [tokens(text) for text in texts]
            lengths = np.array([len(words) for words in split])
            starts = np.cumsum(lengths) - lengths
            number = np.array([get(w, -1) for words in split for w in words], np.int32)
            units = unit[number]
            missing, shared = np.flatnonzero(number < 0), np.flatnonzero(number >= corpus.own)
            owner = np.searchsorted(starts, missing, "right") - 1
            words = [split[d][i] for d, i in zip(owner.tolist(), (missing - starts[owner]).tolist())]
            suffixes = np.array([suffix_unit(w) for w in words], np.int32)
            units[missing] = corpus.suffix[suffixes]
            rare = Counter(zip(owner.tolist(), words, suffixes.tolist()))  # in the order of the texts
            raw = units.astype("<i4").tobytes()
            return [
                [raw[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), lengths.tolist())],
                pa.array(lengths.astype(np.int64)),
                pa.array(np.add.reduceat((number >= 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(base[number], starts)),
                pa.array(np.bincount(np.searchsorted(starts, shared, "right") - 1, share[number[shared]], len(texts)).astype(float)),
                _lists(rare, len(texts)),
            ]

        return work

    return start


def encode(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """``_row``: the columns of ``docs`` but text; ``_at``: a number per row; PARTS. Written to the shared folder."""
    # Plain values: a broadcast is read where this package may be absent.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(corpus).values()))
    held = [c for c in docs.columns if c != "text"]
    own = F.struct(*(F.col(f"`{c}`") for c in held)) if held else F.struct(F.lit(None).alias("none"))
    rows = docs.select(own.alias("_row"), F.monotonically_increasing_id().alias("_at"), "text")
    coded = add_columns(rows, _coder(sent), PARTS, keep=["_row", "_at"], limit=1 << 21)
    return kept(coded, "units", "zstd")


def contexts(units: np.ndarray, lengths: np.ndarray, none: int) -> np.ndarray:
    """The CONTEXT units before each; ``none`` before the first."""
    out = np.empty((CONTEXT, len(units)), np.int32)
    starts = np.cumsum(lengths) - lengths
    for k in range(1, CONTEXT + 1):
        out[k - 1, :k] = none
        out[k - 1, k:] = units[:-k]
        for j in range(k):  # the first words of a text lack some of them
            out[k - 1, starts[lengths > j] + j] = none
    return out


@dataclass
class Parameters:
    """Vectors of context units (and of none), of units and classes with biases, weights of the places.

    Beside each table, the sum of squared slopes of its rows, for the size of the next step.
    """

    context: np.ndarray
    unit: np.ndarray
    of_class: np.ndarray
    place: np.ndarray

    @classmethod
    def fresh(cls, corpus: Corpus, seed: int = 3) -> Parameters:
        """Rows are the vector, its bias, and the sums of squares of both."""
        rng = np.random.default_rng(seed)
        class_mass = np.add.reduceat(corpus.mass, corpus.first[:-1])

        def table(n: int, scale: float, bias) -> np.ndarray:
            rows = np.full((n, DIMENSIONS + 3), 1e-2, np.float32)
            rows[:, :DIMENSIONS] = rng.normal(0, scale, (n, DIMENSIONS))
            rows[:, DIMENSIONS] = bias
            return rows

        places = table(CONTEXT, 0, 0)
        places[:, :DIMENSIONS] = 1 / np.arange(1, CONTEXT + 1)[:, None]
        return cls(
            table(corpus.n_units + 1, 0.3, 0),
            table(corpus.n_units, 0.1, np.log(corpus.mass / class_mass[corpus.class_of()])),
            table(corpus.n_classes, 0.1, np.log(class_mass / class_mass.sum())),
            places,
        )

    def tables(self) -> list[np.ndarray]:
        return [self.context, self.unit, self.of_class, self.place]


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps, one rate for each vector."""

    def __init__(self, corpus: Corpus, start: Parameters, seed: int):
        self.p = Parameters(*(t.copy() for t in start.tables()))
        self.touched = [np.zeros(len(t), bool) for t in start.tables()]
        self.class_of, self.first = corpus.class_of(), corpus.first
        mass = np.add.reduceat(corpus.mass, corpus.first[:-1])
        self.class_mass = mass
        self.class_places = np.cumsum(mass / mass.sum())
        self.unit_places = np.cumsum(corpus.mass)
        self.class_low = np.concatenate(([0.0], self.unit_places))[corpus.first[:-1]]
        self.log_class_noise = np.log(CLASS_NOISE * mass / mass.sum()).astype(np.float32)
        self.log_unit_noise = np.log(UNIT_NOISE * corpus.mass / mass[self.class_of]).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def learn(self, units: np.ndarray, lengths: np.ndarray) -> None:
        before = contexts(units, lengths, len(self.p.unit))
        order = self.rng.permutation(len(units))
        for at in range(0, len(order), BATCH):
            i = order[at : at + BATCH]
            self._step(units[i], before[:, i])

    def _step(self, unit: np.ndarray, before: np.ndarray) -> None:
        p, d = self.p, DIMENSIONS
        own = self.class_of[unit]
        seen = p.context[before, :d]
        hidden = seen[0] * p.place[0, :d]
        for k in range(1, CONTEXT):
            hidden += seen[k] * p.place[k, :d]

        drawn = np.searchsorted(self.class_places, self.rng.random(CLASS_NOISE)).clip(max=len(p.of_class) - 1)
        target, noise = p.of_class[own], p.of_class[drawn]
        real = _dots(hidden, target[:, :d]) + target[:, d] - self.log_class_noise[own]
        false = hidden @ noise[:, :d].T + (noise[:, d] - self.log_class_noise[drawn])
        up, down = _slope_up(real), _slope_down(false)
        back = up[:, None] * target[:, :d] + down @ noise[:, :d]
        self._add(2, np.concatenate([own, drawn]), np.concatenate([up[:, None] * hidden, down.T @ hidden]), np.concatenate([up, down.sum(axis=0)]))

        # In the order of the classes, so that the search goes through the table once.
        sort = np.argsort(own)
        ranked = own[sort]
        u = self.rng.random((UNIT_NOISE, len(unit)))
        places = np.searchsorted(self.unit_places, self.class_low[ranked] + u * self.class_mass[ranked])
        other = np.empty_like(places)
        other[:, sort] = places
        other = np.minimum(np.maximum(other, self.first[own]), self.first[own + 1] - 1)
        target, noise = p.unit[unit], p.unit[other]
        alone = self.first[own + 1] - self.first[own] == 1
        up = _slope_up(_dots(hidden, target[:, :d]) + target[:, d] - self.log_unit_noise[unit])
        down = _slope_down(np.einsum("nd,knd->kn", hidden, noise[..., :d]) + noise[..., d] - self.log_unit_noise[other])
        up[alone], down[:, alone] = 0, 0
        back += up[:, None] * target[:, :d]
        for k in range(UNIT_NOISE):
            back += down[k][:, None] * noise[k, :, :d]
        self._add(
            1,
            np.concatenate([unit, other.ravel()]),
            np.concatenate([up[:, None] * hidden, (down[..., None] * hidden[None]).reshape(-1, d)]),
            np.concatenate([up, down.ravel()]),
        )
        self._add(0, before.ravel(), (back[None] * p.place[:, None, :d]).reshape(-1, d))
        self._add(3, np.arange(CONTEXT), np.einsum("nd,knd->kd", back, seen))

    def _add(self, k: int, rows: np.ndarray, slopes: np.ndarray, biases: np.ndarray | None = None) -> None:
        """One step for each row, along the sum of its slopes."""
        d, table = DIMENSIONS, self.p.tables()[k]
        order = np.argsort(rows)
        ordered = rows[order]
        new = np.empty(len(rows), bool)
        new[0] = True
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        begins = np.flatnonzero(new)
        at = ordered[begins]
        slope = np.add.reduceat(slopes[order], begins, axis=0)
        slope *= np.float32(STEP)
        held = table[at]
        held[:, d + 1] += _dots(slope, slope) / np.float32(d)
        slope *= (np.float32(RATE) / np.sqrt(held[:, d + 1]))[:, None]
        held[:, :d] += slope
        if biases is not None:
            bias = np.add.reduceat(biases[order], begins) * np.float32(STEP)
            held[:, d + 2] += bias * bias
            held[:, d] += np.float32(RATE) * bias / np.sqrt(held[:, d + 2])
        table[at] = held
        self.touched[k][at] = True


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the rows, one by one."""
    return np.einsum("ij,ij->i", a, b)


def _slope_up(real: np.ndarray) -> np.ndarray:
    """Slope of the log likelihood of what was seen."""
    return (1 / (1 + np.exp(np.clip(real, -30, 30)))).astype(np.float32)


def _slope_down(false: np.ndarray) -> np.ndarray:
    """Slope of that of noise."""
    return (-1 / (1 + np.exp(-np.clip(false, -30, 30)))).astype(np.float32)


VALUES = [f"x{i}" for i in range(DIMENSIONS + 3)]


def _learner(sent_corpus, sent) -> Callable:
    """Trains on a slice from the parameters sent; gives what it changed, by row."""

    def learn(key, held):
        start = Parameters(*sent.value)
        trainer = Trainer(Corpus(*sent_corpus.value), start, key[0].as_py())
        raw = held.column("units").to_pylist()
        units = np.frombuffer(b"".join(raw), "<i4")
        # Not in the order in which rows happen to come: a batch is drawn from all of the slice.
        trainer.learn(units, np.array([len(r) // 4 for r in raw]))
        kinds, rows, changes = [], [], []
        for kind, (table, before, touched) in enumerate(zip(trainer.p.tables(), start.tables(), trainer.touched)):
            at = np.flatnonzero(touched)
            kinds.append(np.full(len(at), kind, np.int32))
            rows.append(at.astype(np.int32))
            changes.append(table[at] - before[at])
        change = np.concatenate(changes)
        columns = [np.concatenate(kinds), np.concatenate(rows), *(np.ascontiguousarray(change[:, i]) for i in range(len(VALUES)))]
        return pa.table(dict(zip(["kind", "row", *VALUES], columns)))

    return learn


def train(coded: DataFrame, corpus: Corpus) -> Parameters:
    """Parameters from all rows of ``coded`` (see `encode`), round by round."""
    context = coded.sparkSession.sparkContext
    n_slices = ROUNDS * max(1, math.ceil(corpus.n / SLICE_TOKENS / ROUNDS))
    dealt = coded.select("units", F.pmod(F.xxhash64("_at"), F.lit(n_slices)).alias("slice"))
    parameters = Parameters.fresh(corpus)
    schema = "kind int, row int, " + ", ".join(f"{x} float" for x in VALUES)
    sent_corpus = context.broadcast(tuple(vars(corpus).values()))
    for number in range(ROUNDS):
        sent = context.broadcast(tuple(parameters.tables()))

        mine = dealt.where(F.pmod("slice", F.lit(ROUNDS)) == number)
        changed = mine.groupBy("slice").applyInArrow(_learner(sent_corpus, sent), schema).groupBy("kind", "row")
        # As many rows as there are vectors.
        mean = changed.agg(*(F.avg(x).cast("float").alias(x) for x in VALUES)).toArrow()
        kind, row = mean.column("kind").to_numpy(), mean.column("row").to_numpy()
        change = np.stack([mean.column(x).to_numpy() for x in VALUES], axis=1)
        for k, table in enumerate(parameters.tables()):
            table[row[kind == k]] += change[kind == k]
        sent.unpersist()
    return parameters


class Scorer:
    """Normalised natural log probabilities of units."""

    ROWS = 2048

    def __init__(self, corpus: Corpus, p: Parameters):
        d = DIMENSIONS
        self.context, self.place = np.ascontiguousarray(p.context[:, :d]), p.place[:, :d]
        # The bias as one more row, which meets a one: a product then gives whole scores.
        self.classes, self.units = (np.ascontiguousarray(t[:, : d + 1].T) for t in (p.of_class, p.unit))
        self.class_of, self.first = corpus.class_of(), corpus.first
        self.none = corpus.n_units
        # No score is beyond this; exponents of up to 60 do not overflow.
        far = sum(float(np.sqrt((self.context * place) ** 2).sum(axis=1).max()) for place in self.place)
        largest, bias = (max(float(np.abs(t[rows]).max()) for t in (self.classes, self.units)) for rows in (slice(d), d))
        self.safe = far * largest + bias < 60

    def logs(self, units: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of each unit after those ``before`` it."""
        own = self.class_of[units]
        hidden = self.context[before[0]] * self.place[0]
        for k in range(1, len(before)):
            hidden += self.context[before[k]] * self.place[k]
        hidden = np.concatenate([hidden, np.ones((len(units), 1), np.float32)], axis=1)
        out = np.empty(len(units), np.float32)
        for at in range(0, len(units), self.ROWS):
            part = slice(at, at + self.ROWS)
            out[part] = self._log_share(hidden[part], self.classes, own[part])
        # Tokens class by class, so that each meets the units of its class in one product.
        order = np.argsort(own)
        ends = np.searchsorted(own[order], np.arange(len(self.first)))
        hidden, units, more = hidden[order], units[order], np.zeros(len(units), np.float32)
        for c in np.flatnonzero(np.diff(ends)):
            low, high = self.first[c], self.first[c + 1]
            if high - low == 1:
                continue
            for at in range(ends[c], ends[c + 1], self.ROWS):
                part = slice(at, min(at + self.ROWS, ends[c + 1]))
                more[part] = self._log_share(hidden[part], self.units[:, low:high], units[part] - low)
        out[order] += more
        return out

    def _log_share(self, hidden: np.ndarray, vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Log of the share that the own column has of each row's sum of exponents."""
        scores = hidden @ vectors
        if not self.safe:
            scores -= scores.max(axis=1, keepdims=True)
        mine = scores[np.arange(len(own)), own]
        return mine - np.log(np.exp(scores, out=scores) @ np.ones(vectors.shape[1], np.float32))


def _scorer(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Corpus(*sent.value[0]), Parameters(*sent.value[1]))
        for batch in batches:
            for part in chunks([batch], "units", 1 << 20):
                raw = part.column("units").to_pylist()
                units, lengths = np.frombuffer(b"".join(raw), "<i4"), np.array([len(r) // 4 for r in raw])
                logs = scorer.logs(units, contexts(units, lengths, scorer.none)).astype(np.float64)
                sums = np.add.reduceat(logs, np.cumsum(lengths) - lengths) / math.log(10)
                yield pa.RecordBatch.from_arrays([part.column("_at"), pa.array(sums)], ["_at", "lm"])

    return run


def score(coded: DataFrame, counts: DataFrame, corpus: Corpus, parameters: Parameters) -> DataFrame:
    """The columns of the rows behind ``coded`` with n_tokens, n_known, base_score and score."""
    results = ("n_tokens", "n_known", "base_score", "score")
    sent = coded.sparkSession.sparkContext.broadcast((tuple(vars(corpus).values()), tuple(parameters.tables())))
    by_model = coded.select("_at", "units").mapInArrow(_scorer(sent), "_at long, lm double")

    rare = coded.select("_at", F.explode("rare").alias("r")).select("_at", "r.*")
    seen = counts.select(F.xxhash64("word").alias("h1"), F.xxhash64(F.lit("second"), "word").alias("h2"), "c")
    c = F.coalesce("c", F.lit(0))
    below = F.element_at(F.array(*(F.lit(float(x)) for x in corpus.below)), F.col("g") + 1)
    total = corpus.n + 0.5 * (corpus.v + 1)
    rest = rare.join(seen, ["h1", "h2"], "left").select(
        "_at",
        F.lit(None).cast(coded.schema["_row"].dataType).alias("_row"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((c + 0.5) / total)).alias("base"),
        (F.col("times") * F.log10((c + 0.5) / below)).alias("lm"),
    )
    columns = ["_at", "_row", "n_tokens", "n_known", "base", "lm"]
    none = F.lit(0).cast("long")
    model = by_model.select(
        "_at", F.lit(None).cast(coded.schema["_row"].dataType).alias("_row"), none.alias("n_tokens"), none.alias("n_known"),
        F.lit(0.0).alias("base"), "lm",
    )
    summed = (
        coded.withColumn("lm", F.col("share"))
        .select(*columns)
        .union(model)
        .union(rest.select(*columns))
        .groupBy("_at")
        .agg(
            F.first("_row", ignorenulls=True).alias("_row"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("lm").alias("score"),
        )
    )
    held = [f for f in coded.schema["_row"].dataType.fieldNames() if f not in results]
    return summed.select(*(F.col("_row")[f].alias(f) for f in held), *results)


def held_out(doc_id: Column) -> Column:
    return crc_bucket(doc_id, 5) == 1


def digest(docs: DataFrame) -> DataFrame:
    training = docs.where(~held_out(F.col("doc_id"))).select("text")
    counts = kept(count_words(training), "word-counts")
    corpus = summarise_counts(counts)
    coded = encode(docs.select("doc_id", "text"), corpus)
    parameters = train(coded.where(~held_out(F.col("_row.doc_id"))), corpus)
    return score(coded, counts, corpus, parameters).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(corpus.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

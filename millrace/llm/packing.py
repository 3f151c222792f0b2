"""Vector bin packing: examples share sequences under limits on several things at once.

An example asks for tokens, one segment and loss-bearing tokens. Examples are dealt to groups of
near GROUP_ROWS by a hash of a row number, which no key of the data can skew. A task packs one
group: a sequence is open at a time, and of the examples that fit, the one with the largest
dot product of its demands with what is left of the sequence's limits goes in next; every
limit is weighed by how much of it the examples ask for on the whole. When nothing fits, the
next sequence is opened. Only row numbers and counts go through that shuffle.

`pack_examples` never cuts: instruction data stays whole. `pack_documents` may: a document's ids
are cut into pieces of a whole sequence at most; when nothing more fits and at least
`least_gap` tokens are free, the largest piece left gives its first part and comes back
with the rest. What a sequence leaves free is so below `least_gap`, but in each group's last
one. All ids but the first of a piece bear loss.

Ids are the tokenizer's for the whole text. Under its rules no token goes over white space, so
the words between ASCII white space are encoded one by one and remembered, near MEMO_WORDS a task.
Pieces with their ids are written to the shared folder once, and found again by row number.

Defined cases: a null or empty text is its end id alone; texts of any length are encoded whole;
rows that repeat are packed each; an empty table gives no rows; an example beyond a limit has
no sequence (null) in `pack_examples`, as does one without counts or with negative ones; other
columns pass through there, and those named like a result give way to it.
"""

from __future__ import annotations

import json
import math
import re
import sys
from array import array
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from millrace.llm.batches import chunks
from millrace.llm.tables import kept

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END_ID = 1
GROUP_ROWS = 8192
#: A gap of fewer tokens is left as padding.
LEAST_GAP = 16
MEMO_WORDS = 600_000
MEMO_BYTES = 64
#: Rules under which no token goes over white space: it is dropped, and nothing looks past it.
KNOWN = [
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    [
        {"type": "Split", "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
]
#: Latin letters beyond ASCII that no other character joins up with unless it is a combining one.
LATIN = range(0xC0, 0x250)
#: Text bytes a worker holds at once.
CHUNK_BYTES = 2 * 1024 * 1024


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 512
    loss_tokens: int = 2048


PLACED = "row long, cut long, length long, sequence_id long, offset long"


def fill(tokens: np.ndarray, loss: np.ndarray, limits: Limits, least_gap: int | None = None) -> list[tuple[int, int, int, int, int]]:
    """(item, tokens of it before, length, sequence, offset) of every piece.

    Every item fits an empty sequence. With ``least_gap``, items may be cut, and then all
    tokens of a piece but its first bear loss.
    """
    limit = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    need = np.stack([tokens, np.ones(len(tokens)), loss], axis=1).astype(float) / limit
    weight = need.sum(axis=0)
    order = np.lexsort((np.arange(len(tokens)), -tokens))
    # Items that ask for the same have the same product: one is worked out for each demand, the largest first.
    demands, which = np.unique(np.stack([-tokens[order], loss[order]], axis=1).astype(np.int64), axis=0, return_inverse=True)
    left, bear = -demands[:, 0], demands[:, 1]
    which = which.ravel()
    by_demand = np.split(-np.argsort(which, kind="stable")[::-1], np.cumsum(np.bincount(which, minlength=len(left))[::-1])[:-1])
    waiting = [held.tolist() for held in by_demand[::-1]]  # places in the order, the first one last
    n = np.array([len(held) for held in waiting], np.int64)
    cut: dict[int, int] = {}
    placed: list[tuple[int, int, int, int, int]] = []
    sequence, remaining = 0, len(order)

    def take(at: int, length: int, offset: int) -> int:
        held = waiting[at].pop()
        placed.append((int(order[-held]), cut.get(held, 0), length, sequence, offset))
        n[at] -= 1
        return held

    while remaining:
        free, room, spare = limits.tokens, limits.segments, limits.loss_tokens
        tokens_share, loss_share = left / limit[0], bear / limit[2]
        while room:
            fits = (left <= free) & (bear <= spare) & (n > 0)
            if fits.any():
                rest = weight * np.array([free, room, spare]) / limit
                gain = tokens_share * rest[0] + rest[1] / limit[1] + loss_share * rest[2]
                at = int(np.argmax(np.where(fits, gain, -1.0)))
                take(at, int(left[at]), limits.tokens - free)
                remaining -= 1
                free, room, spare = free - int(left[at]), room - 1, spare - int(bear[at])
                continue
            head = min(free, spare + 1)
            if least_gap is None or head < max(1, least_gap) or not remaining:
                break
            at = int(np.argmax(np.where(n > 0, left, -1)))
            held = take(at, head, limits.tokens - free)
            free, room, spare = free - head, room - 1, spare - (head - 1)
            cut[held] = cut.get(held, 0) + head
            rest_left = int(left[at]) - head
            same = np.flatnonzero((left == rest_left) & (bear == max(0, rest_left - 1)))
            if len(same):
                back = int(same[0])
            else:
                back = int(np.searchsorted(-left, -rest_left))
                left, bear, n = (np.insert(a, back, v) for a, v in ((left, rest_left), (bear, max(0, rest_left - 1)), (n, 0)))
                tokens_share, loss_share = left / limit[0], bear / limit[2]
                waiting.insert(back, [])
            insort(waiting[back], held)
            n[back] += 1
        sequence += 1
        some = np.flatnonzero(n)
        if 4 * len(some) < 3 * len(n):
            left, bear, n, waiting = left[some], bear[some], n[some], [waiting[i] for i in some]
    return placed


def place(items: DataFrame, limits: Limits, least_gap: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Where every item (row, tokens, loss) goes: PLACED, a row per piece."""
    groups = max(1, math.ceil(items.count() / group_rows))

    def run(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("row")
        rows = held["row"].to_numpy()
        made = np.array(fill(held["tokens"].to_numpy(), held["loss"].to_numpy(), limits, least_gap), np.int64).reshape(-1, 5)
        return pd.DataFrame(
            {
                "row": rows[made[:, 0]],
                "cut": made[:, 1],
                "length": made[:, 2],
                "sequence_id": (np.int64(key[0]) << 32) + made[:, 3],
                "offset": made[:, 4],
            }
        )

    dealt = items.select("row", "tokens", "loss", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(run, PLACED)


def pack_examples(examples: DataFrame, tokens: str, loss: str, limits: Limits = Limits(), group_rows: int = GROUP_ROWS) -> DataFrame:
    """``examples`` with sequence_id and offset; ``tokens`` and ``loss`` name its columns of counts."""
    names = ["sequence_id", "offset"]
    own = examples.select(F.struct(*(c for c in examples.columns if c not in names)).alias("example"), F.monotonically_increasing_id().alias("row"))
    held = kept(own, "examples")
    counts = held.select("row", F.col("example")[tokens].cast("long").alias("tokens"), F.col("example")[loss].cast("long").alias("loss"))
    able = counts.where(F.col("tokens").between(0, limits.tokens) & F.col("loss").between(0, limits.loss_tokens))
    placed = place(able, limits, group_rows=group_rows).select("row", *names)
    return held.join(placed, "row", "left").select("example.*", *names)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers; those of `tokenizer` for the whole text.

    Where the file's rules are known to treat the words between white space apart (see KNOWN),
    words are remembered. Those of ASCII and common Latin letters are also lowered and split here,
    by the file's own pattern, and only their pieces go to the model. Any other word, and one that
    may hold a special token, goes to the tokenizer as it is; so does a whole text under other rules.
    """

    def __init__(self, tokenizer: str) -> None:
        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._model = self._tokenizer.model
        self._words: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        rules = json.loads(tokenizer)
        self._apart = [rules["normalizer"], _without_pattern(rules["pre_tokenizer"])] == KNOWN
        if not self._apart:
            return
        # Letters whose normal form is one letter, whatever stands beside them; the tokenizer says so itself.
        normal = {c: self._tokenizer.normalizer.normalize_str(c) for c in map(chr, LATIN)}
        split = self._tokenizer.pre_tokenizer.pre_tokenize_str
        normal = {c: n for c, n in normal.items() if len(n) == 1 and len(split(f"a{n}a")) == 1}
        letters = "a-z" + "".join(sorted(set(normal.values())))
        pattern = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        own = pattern.replace(r"\p{L}", letters).replace(r"\p{N}", "0-9").replace(r"\s", "")
        self._split = re.compile(own).findall
        self._odd = re.compile(f"[^!-~{''.join(normal)}]|<\\|").search
        self._lower = str.maketrans(normal | {chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
        # Bytes as characters that can be seen, in the usual order of byte-level vocabularies.
        seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in seen]
        self._visible = {b: 256 + i for i, b in enumerate(hidden)}

    def _ids(self, text: bytes) -> bytes:
        made = self._tokenizer.encode(text.decode(errors="replace"), add_special_tokens=False)
        return _little_endian(made.ids)

    def _piece(self, piece: str) -> bytes:
        # Letters, digits and signs of ASCII stand for themselves.
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._visible)
        made = _little_endian([t.id for t in self._model.tokenize(letters)])
        if len(piece) <= MEMO_BYTES:
            self._pieces[piece] = made
        return made

    def _word(self, word: bytes) -> bytes:
        text = word.decode(errors="replace")
        if self._odd(text):
            made = self._ids(word)
        else:
            known = self._pieces.get
            text = text.lower() if text.isascii() else text.translate(self._lower)
            made = b"".join([known(p) or self._piece(p) for p in self._split(text)])
        if len(word) <= MEMO_BYTES:
            self._words[word] = made
        return made

    def __call__(self, text: bytes) -> bytes:
        if not self._apart:
            return self._ids(text)
        if len(self._words) > MEMO_WORDS:
            self._words.clear()
        if len(self._pieces) > MEMO_WORDS:
            self._pieces.clear()
        known, word = self._words.get, self._word
        return b"".join([known(w) or word(w) for w in text.split()])


def _little_endian(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def _without_pattern(pre_tokenizer: dict | None) -> list:
    return [{k: v for k, v in p.items() if k != "pattern"} for p in (pre_tokenizer or {}).get("pretokenizers", [])]


CHUNK = "row long, doc_id long, start long, n long, doc_tokens long, ids binary"


def encoded_chunks(docs: DataFrame, size: int, tokenizer: str, end_id: int | None) -> DataFrame:
    """The ids of every text in runs of up to ``size``, each with a number of its own."""
    with open(tokenizer, encoding="utf-8") as file:  # a few MB; goes to the tasks
        model = file.read()
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    fields = T.StructType.fromDDL(CHUNK).fields
    fields[1] = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(model)
        number = TaskContext.get().partitionId() << 40
        for batch in chunks(batches, "text", CHUNK_BYTES):
            made = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or b"") + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    held = ids[4 * start : 4 * (start + size)]
                    made.append((number, doc_id, start, len(held) // 4, total, held))
                    number += 1
                    if len(made) >= 4096:
                        yield _batch(made, arrow)
                        made = []
            if made:
                yield _batch(made, arrow)

    return docs.select("doc_id", docs["text"].cast("binary").alias("text")).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack_documents(
    docs: DataFrame,
    limits: Limits = Limits(),
    tokenizer: str = TOKENIZER,
    end_id: int | None = END_ID,
    least_gap: int = LEAST_GAP,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """doc_id, start, length, ids (binary), doc_tokens, sequence_id and offset of every piece."""
    size = min(limits.tokens, limits.loss_tokens + 1)
    held = kept(encoded_chunks(docs, size, tokenizer, end_id), "ids", "zstd")
    items = held.select("row", F.col("n").alias("tokens"), (F.col("n") - 1).alias("loss"))
    placed = place(items, limits, least_gap, group_rows)
    return held.join(placed, "row").select(
        "doc_id",
        (F.col("start") + F.col("cut")).alias("start"),
        "length",
        F.substring("ids", (4 * F.col("cut") + 1).cast("int"), (4 * F.col("length")).cast("int")).alias("ids"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def digest(docs: DataFrame) -> DataFrame:
    return pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

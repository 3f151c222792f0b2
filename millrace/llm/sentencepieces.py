"""SentencePiece encoding and decoding by Viterbi over a trie of the distinct words.

The distinct marked words of a chunk of texts are sorted, which is the depth-first order of
their trie. Forward scores of a prefix do not depend on what follows, so going from one word to
the next keeps those of the common prefix and computes only the new characters; candidates for an
end are looked up from the shortest on, until no piece ends alike. Each word is split once per
task (the memory of words is bounded and emptied when full), and texts are put together from the
words' ids.

Defined cases: a null text has null ids and decodes to null; an empty text has no ids; an empty
table gives no rows; a word of any length is split whole; other columns pass through. Decoding
gives back every valid text exactly.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm.batches import Worker, add_columns
from millrace.llm.pieces import MEMO_CHARS, MEMO_WORDS, MODEL, Vocabulary, character_bytes, load_vocabulary, marked_words


#: Text bytes split at once: their words are held as objects.
TEXT_CHUNK = 2 * 1024 * 1024


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    n = 0
    for x, y in zip(a, b):
        if x != y:
            return n
        n += 1
    return n


def ending_scores(vocabulary: Vocabulary) -> dict[str, float | None]:
    """The score of every piece, and None for what only is the end of some piece."""
    ends = {piece[k:]: None for piece in vocabulary.scores for k in range(1, len(piece))}
    ends.update((piece, score) for piece, (score, _) in vocabulary.scores.items())
    return ends


def split_sorted(words: list[str], vocabulary: Vocabulary, ends: dict[str, float | None] | None = None) -> dict[str, array]:
    """Ids of each word; ``words`` must be sorted.

    Candidates for an end are looked at from the shortest on, and no further than some piece ends
    alike; among equal sums the piece that starts first replaces those before.
    """
    look = (ending_scores(vocabulary) if ends is None else ends).get
    unknown, get, missing = vocabulary.unknown, vocabulary.scores.get, False
    best, starts = [0.0], [0]  # of the ends of the current path in the trie
    previous, out = "", {}
    for word in words:
        shared = common_prefix(previous, word)
        del best[shared + 1 :], starts[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            start = i = end - 1
            score = look(word[i:end], missing)
            # A character that is no piece is unknown; on equal sums any piece goes before it.
            top = best[i] + (unknown if score is None or score is missing else score)
            while score is not missing and i:
                i -= 1
                score = look(word[i:end], missing)
                if score is not None and score is not missing:
                    total = best[i] + score
                    if total >= top:
                        top, start = total, i
            best.append(top)
            starts.append(start)
        ids, end = [], len(word)
        while end:
            start = starts[end]
            piece = get(word[start:end])
            if piece is None:
                ids.extend(vocabulary.byte_ids[b] for b in reversed(character_bytes(word[start:end])))
            else:
                ids.append(piece[1])
            end = start
        out[word] = array("i", reversed(ids))
        previous = word
    return out


class _Encoder:
    """Splits the texts of one task; remembers the ids of short words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.ends, self.memo = vocabulary, ending_scores(vocabulary), {}

    def __call__(self, texts: list) -> tuple[array, list[int]]:
        """Ids of all texts in a row, and where each text's begin and the last one's end."""
        split = [marked_words(text) for text in texts]
        new = split_sorted(sorted(set().union(*split) - self.memo.keys()), self.vocabulary, self.ends)
        new = {word: found.tobytes() for word, found in new.items()}
        ids, offsets = array("i"), [0]
        known = self.memo
        for words in split:
            ids.frombytes(b"".join([new[word] if word in new else known[word] for word in words]))
            offsets.append(len(ids))
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
        if len(new) <= MEMO_WORDS:
            self.memo.update((w, i) for w, i in new.items() if len(w) <= MEMO_CHARS)
        return ids, offsets


def _lists(ids: array, offsets: list[int], texts: list) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.array(np.frombuffer(ids, np.int32), pa.int32()),
        mask=pa.array([text is None for text in texts]),
    )


def text_of(ids, raw: tuple[bytes, ...]) -> str:
    joined = b"".join([raw[i] for i in ids])
    return joined[joined.startswith(b" ") :].decode("utf-8", "replace")


def _worker(vocabulary: Vocabulary) -> Callable[[], Worker]:
    def start() -> Worker:
        encoder = _Encoder(vocabulary)

        def work(texts: list) -> list:
            ids, offsets = encoder(texts)
            return [_lists(ids, offsets, texts)]

        return work

    return start


def _both_ways(vocabulary: Vocabulary) -> Callable[[], Worker]:
    def start() -> Worker:
        encoder = _Encoder(vocabulary)

        def work(texts: list) -> list:
            ids, offsets = encoder(texts)
            same = [
                text is None or text_of(ids[a:b], vocabulary.raw) == text
                for text, a, b in zip(texts, offsets, offsets[1:])
            ]
            return [_lists(ids, offsets, texts), same]

        return work

    return start


def encode(docs: DataFrame, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with ``ids``, the pieces of the whole text."""
    return add_columns(docs, _worker(load_vocabulary(model)), "ids array<int>", keep=keep, limit=TEXT_CHUNK)


def decode(docs: DataFrame, model: str = MODEL, into: str = "decoded") -> DataFrame:
    """All columns with the text that ``ids`` stands for."""
    raw = load_vocabulary(model).raw

    @pandas_udf("string")
    def text(ids):
        return ids.map(lambda one: text_of(one, raw), na_action="ignore")

    return docs.withColumn(into, text("ids"))


def digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Encoded and decoded in one pass over the texts."""
    both = add_columns(
        docs.select("doc_id", "text"),
        _both_ways(load_vocabulary(model)),
        "ids array<int>, round_trip boolean",
        keep=["doc_id"],
        limit=TEXT_CHUNK,
    )
    n_tokens = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long")
    return both.select("doc_id", n_tokens.alias("n_tokens"), "ids", "round_trip")

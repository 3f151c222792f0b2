"""Token counts: Viterbi that keeps the best score and the number of pieces, and no path.

An Aho-Corasick automaton over the vocabulary enumerates every piece inside a marked word, by
end and, for one end, longest first, which is the tie order of the tokenizer. The forward pass
carries two numbers per end. Words seen before in the task are looked up; the memory of them
is bounded and emptied when full, which changes no result.

Defined cases: a null or empty text has 0 tokens and score 0; an empty table gives no rows;
repeated rows are counted each; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from millrace.llm.batches import Worker, add_columns
from millrace.llm.pieces import MEMO_CHARS, MEMO_WORDS, MODEL, Vocabulary, character_bytes, load_vocabulary, marked_words

COUNTS = "n_tokens long, n_marked_words long, best_score double"


def build_automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for piece, (score, _) in vocabulary.scores.items():
        automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    return automaton


def count_pieces(word: str, automaton: ahocorasick.Automaton, unknown: float) -> tuple[float, int]:
    """Best score and its number of pieces."""
    size = len(word)
    best: list[float | None] = [None] * (size + 1)
    pieces = [0] * (size + 1)
    best[0] = 0.0
    at = 0  # ends up to here are final

    def unknown_up_to(end: int) -> None:
        """Ends without a one-character piece also take an unknown character, the last candidate."""
        nonlocal at
        while at < end:
            if not single[at]:
                score = best[at] + unknown
                if best[at + 1] is None or score > best[at + 1]:
                    best[at + 1] = score
                    pieces[at + 1] = pieces[at] + len(character_bytes(word[at]))
            at += 1

    single = [False] * size
    for last, (length, score) in automaton.iter(word):
        if last > at:
            unknown_up_to(last)
        start = last + 1 - length
        if length == 1:
            single[last] = True
        total = best[start] + score
        if best[last + 1] is None or total > best[last + 1]:
            best[last + 1] = total
            pieces[last + 1] = pieces[start] + 1
    unknown_up_to(size)
    return best[size], pieces[size]


def _worker(vocabulary: Vocabulary) -> Callable[[], Worker]:
    def start() -> Worker:
        automaton, unknown = build_automaton(vocabulary), vocabulary.unknown
        memo: dict[str, tuple[float, int]] = {}

        def of(word: str) -> tuple[float, int]:
            found = memo.get(word)
            if found is None:
                found = count_pieces(word, automaton, unknown)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = found
            return found

        def work(texts: list) -> list:
            tokens, words, scores = [], [], []
            for text in texts:
                parts = [of(word) for word in marked_words(text)]
                tokens.append(sum(n for _, n in parts))
                scores.append(float(sum(s for s, _ in parts)))
                words.append(len(parts))
            return [tokens, words, scores]

        return work

    return start


def count_tokens(docs: DataFrame, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with n_tokens, n_marked_words and best_score."""
    return add_columns(docs, _worker(load_vocabulary(model)), COUNTS, keep=keep, limit=2 * 1024 * 1024)


def digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text"), model, keep=["doc_id"])

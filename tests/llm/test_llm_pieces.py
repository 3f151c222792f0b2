import duckdb
import sentencepiece
from corpus_rows import awkward_texts, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from millrace.llm import sentencepieces, token_counts
from millrace.llm.pieces import MODEL, character_bytes, load_vocabulary, marked_words

VOCABULARY = load_vocabulary()
AUTOMATON = token_counts.build_automaton(VOCABULARY)


def brute(word):
    """Score, number of pieces and ids of the best split, over all starts of each end."""
    best = [(0.0, 0, [])]
    for end in range(1, len(word) + 1):
        found = None
        for start in range(end):
            piece = VOCABULARY.scores.get(word[start:end])
            if piece is not None:
                score, ids = best[start][0] + piece[0], [piece[1]]
            elif start == end - 1:
                score = best[start][0] + VOCABULARY.unknown
                ids = [VOCABULARY.byte_ids[b] for b in character_bytes(word[start:end])]
            else:
                continue
            if found is None or score > found[0]:
                found = (score, best[start][1] + len(ids), best[start][2] + ids)
        best.append(found)
    return best[-1]


def test_counts_and_ids_equal_brute_force(spark):
    texts = [(i, t) for i, t in awkward_texts(6) if len(t or "") < 2000]
    docs = frame(spark, texts, clashing=True)
    counts = {(r.doc_id, r.text): (r.n_tokens, r.best_score) for r in token_counts.count_tokens(docs).collect()}
    ids = {(r.doc_id, r.text): r.ids for r in sentencepieces.encode(docs).collect()}
    for i, t in texts:
        parts = [brute(w) for w in marked_words(t)]
        assert counts[i, t] == (sum(p[1] for p in parts), sum(p[0] for p in parts))
        assert ids[i, t] == (None if t is None else [x for p in parts for x in p[2]])


def test_a_unigram_library_gives_the_same_ids(sf_dir):
    """The same pieces and scores in another library's unigram model, word by word.

    SentencePiece itself, told that the pieces are a unigram model, sums in float32 next to the
    -1e9 of some pieces, which makes sums within 64 of each other ties; this library sums in
    doubles, as the operator does.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    library = Tokenizer(models.Unigram(pieces, 0, True))
    words = {w for r in duckdb.sql(f"select text from '{sf_dir}/documents.parquet'").fetchall() for w in marked_words(r[0])}
    words |= set(marked_words("ünïcode 日本語 😀x \t\n abc\x00def naïve  two   three <0x41>x"))
    split = sentencepieces.split_sorted(sorted(words), VOCABULARY)
    assert [w for w in words if library.encode(w).ids != list(split[w]) and "<0x" not in w] == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=6))
def test_round_trip_and_shared_prefixes(texts):
    encoder = sentencepieces._Encoder(VOCABULARY)
    ids, offsets = encoder(texts)
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert sentencepieces.text_of(ids[a:b], VOCABULARY.raw) == text
        for word in marked_words(text):
            split = sentencepieces.split_sorted([word], VOCABULARY)[word]
            assert list(split) == brute(word)[2]
            assert token_counts.count_pieces(word, AUTOMATON, VOCABULARY.unknown) == brute(word)[:2]


def test_decode_gives_back_whole_texts(spark):
    rows = awkward_texts(7)
    out = sentencepieces.decode(sentencepieces.encode(frame(spark, rows))).collect()
    assert len(out) == len(rows) and all(r.decoded == r.text for r in out)
    assert all(r.round_trip for r in sentencepieces.digest(frame(spark, rows)).collect())
    assert sentencepieces.digest(frame(spark, [])).collect() == token_counts.digest(frame(spark, [])).collect() == []


def test_memory_of_words_changes_nothing():
    before = sentencepieces.MEMO_WORDS
    try:
        sentencepieces.MEMO_WORDS = 2
        encoder = sentencepieces._Encoder(VOCABULARY)
        few = [list(encoder(["a b c d e", "c d"])[0]), list(encoder(["e a b"])[0])]
    finally:
        sentencepieces.MEMO_WORDS = before
    fresh = [list(sentencepieces._Encoder(VOCABULARY)(t)[0]) for t in (["a b c d e", "c d"], ["e a b"])]
    assert few == fresh

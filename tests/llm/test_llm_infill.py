import hashlib
import re

import pytest
from corpus_rows import awkward_texts, frame, sorted_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import frames, infill


def expected(rows):
    out = []
    for doc_id, text in rows:
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
        digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
        n = len(units)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
        whole = text or ""
        if not whole or any(x in whole for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            form, made, lengths = "plain", whole, (None, None)
        elif h[3] % 100 < 20:
            form, made, lengths = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
        else:
            form, made, lengths = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((doc_id, n, form, *lengths, digest(made), digest(whole), made))
    return sorted(out, key=repr)


AWKWARD = awkward_texts() + [
    (1000, "a" * 300), (1001, "é" * 300), (1002, "has a <P> inside"), (1003, "<S>"), (1004, "<<M>"), (1005, "almost <M <P <S >"),
    (1006, "ends in <"), (1007, "𝒜b́ <S" * 40), (1008, "long text, " * 30000), (1009, "word" * 50000), (None, None), (None, "null id"),
]


@pytest.mark.parametrize("limit", [7, 64 * 1024])  # cuts in nearly every frame, and whole texts in one
def test_digest_equals_brute_force(spark, monkeypatch, limit):
    rows = [r for r in AWKWARD if limit > 7 or len(r[1] or "") < 2000]
    monkeypatch.setattr(frames, "FRAME_BYTES", limit)
    monkeypatch.setattr(frames.Codec.store, "__defaults__", (limit,))
    monkeypatch.setattr(frames.cut_points, "__defaults__", (limit,))
    assert sorted_rows(infill.digest(frame(spark, rows, clashing=True))) == sorted((r[:7] for r in expected(rows)), key=repr)


def test_outputs_and_restored_texts(spark):
    outputs = infill.transform(infill.store(frame(spark, AWKWARD, clashing=True)))
    assert sorted_rows(infill.read(outputs)) == sorted(((r[0], r[7]) for r in expected(AWKWARD)), key=repr)
    assert sorted_rows(infill.read(infill.restore(outputs))) == sorted(((i, t or "") for i, t in AWKWARD), key=repr)


def test_another_seed_and_rates(spark):
    stored = infill.store(frame(spark, AWKWARD))
    forms = {r.form for r in infill.transform(stored, seed=2, rate=100, spm_rate=100).collect() if r.n > 30}
    assert "psm" not in forms and "spm" in forms
    assert {r.form for r in infill.transform(stored, rate=0).collect()} == {"plain"}


@given(st.text(alphabet="ab<PSM>é𝒜\n 1", max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_frames_find_every_unit_and_give_every_part(text, limit):
    codec, raw = frames.Codec(), text.encode()
    held = codec.store(raw, limit)
    assert b"".join(codec.stream(held.frames)) == raw
    places = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    assert (held.units, held.chars, held.size) == (len(places), len(text), len(raw))
    for k, at in enumerate(places):
        assert codec.place(held.frames, k) == (at, len(text[:at].encode()))
    out = frames.Builder(codec)
    cut = len(text[: len(text) // 2].encode())
    out.add_range(held.frames, held.size, cut, held.size)
    out.add(b"--")
    out.add_range(held.frames, held.size, 0, cut)
    assert b"".join(codec.stream(out.done())) == raw[cut:] + b"--" + raw[:cut]


def test_empty(spark):
    assert infill.digest(frame(spark, [])).collect() == []

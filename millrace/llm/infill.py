"""Fill-in-middle transformation over seekable compressed frames.

1. `store` writes every text, whole, as independent zstandard frames with cumulative counts of
   units, code points and bytes (`frames`), one row per document. This table is what the other
   steps read, so texts are read once and no step shuffles.
2. `transform` draws two cuts and the form from a hash of the id. The frames that hold a cut are
   decompressed to find it; the output is again a run of frames, in which frames between the
   cuts are taken over as they are.
3. `restore` finds the markers in the output and puts the text together again, from output and
   form alone. `read` turns frames into text; `digest` hashes them one frame at a time, so a
   worker holds the compressed frames of a row and one frame in clear.

A unit is `[A-Za-z]+|[^A-Za-z]`, from left to right over code points. h1 to h4 are the first
groups of 8 digits of the hex sha256 of `<seed>:<doc_id>`. The prefix ends after the smaller
of h1 % (n+1) and h2 % (n+1) units, the middle after the larger. A text stays as it is (plain)
if it is empty, holds a marker, or h3 % 100 >= `rate`; else it is spm if h4 % 100 < `spm_rate`,
else psm.

Defined cases: a null text is an empty one: plain, no units, the digests of nothing; a null
doc_id hashes as an empty id; equal rows give equal rows; texts of any length are cut over all
their units; an empty table gives no rows; other columns than doc_id and text do not matter,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.batches import chunks
from millrace.llm.frames import FRAMES, Builder, Codec
from millrace.llm.tables import kept

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
RATE = 90
SPM_RATE = 20

STORED = f"doc_id long, n long, n_chars long, n_bytes long, marked boolean, frames {FRAMES}"
OUTPUT = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, n_bytes long, frames {FRAMES}"
DIGEST = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
#: Rows and bytes in clear of the rows that are handed on at once.
ROWS, BYTES = 200, 8 * 1024 * 1024


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, few at a time."""
    sizes = batch.column("n_bytes").to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and (held + size > BYTES or i - begin == ROWS):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


def _map(df: DataFrame, ddl: str, of: Callable[[], Callable[[dict], dict]], text: bool = False) -> DataFrame:
    """A row for a row; ``of`` starts once per task. The type of doc_id stays what it was."""
    fields = T.StructType.fromDDL(ddl).fields
    fields[0] = T.StructField("doc_id", df.schema["doc_id"].dataType)
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = of()
        few = chunks(batches, "text", BYTES) if text else (part for batch in batches for part in slices(batch))
        for batch in few:
            yield pa.RecordBatch.from_pylist([row(r) for r in batch.to_pylist()], arrow)

    return df.mapInArrow(run, schema)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n (units), n_bytes, marked and frames of every text, written to the shared folder."""

    def start() -> Callable[[dict], dict]:
        codec = Codec()

        def of(row: dict) -> dict:
            raw = row["text"] or b""
            held = codec.store(raw)
            return {
                "doc_id": row["doc_id"],
                "n": held.units,
                "n_chars": held.chars,
                "n_bytes": held.size,
                "marked": any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)),
                "frames": held.frames,
            }

        return of

    # As bytes, so that a text which is not valid UTF-8 passes through like any other.
    rows = docs.select("doc_id", docs["text"].cast("binary").alias("text"))
    return kept(_map(rows, STORED, start, text=True), "frames")


def draws(doc_id, seed: int = SEED) -> list[int]:
    """The four numbers that decide the cuts and the form of a document."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform(stored: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars and middle_chars, with the output as frames."""

    def start() -> Callable[[dict], dict]:
        codec = Codec()

        def cut(row: dict, units: int) -> tuple[int, int]:
            """Code points and bytes of so many units."""
            return codec.place(row["frames"], units) if units < row["n"] else (row["n_chars"], row["n_bytes"])

        def of(row: dict) -> dict:
            h1, h2, h3, h4 = draws(row["doc_id"], seed)
            n, frames, size = row["n"], row["frames"], row["n_bytes"]
            made = {"doc_id": row["doc_id"], "n": n, "prefix_chars": None, "middle_chars": None}
            if n == 0 or row["marked"] or h3 % 100 >= rate:
                return made | {"form": "plain", "n_bytes": size, "frames": frames}
            (prefix_chars, a), (both_chars, b) = (cut(row, u) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
            parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, size)}
            form, order = ("spm", (SUFFIX, PREFIX, MIDDLE)) if h4 % 100 < spm_rate else ("psm", (PREFIX, SUFFIX, MIDDLE))
            out = Builder(codec)
            for marker in order:
                out.add(marker)
                out.add_range(frames, size, *parts[marker])
            held = out.done()
            return made | {
                "form": form,
                "prefix_chars": prefix_chars,
                "middle_chars": both_chars - prefix_chars,
                "n_bytes": out.size,
                "frames": held,
            }

        return of

    return _map(stored, OUTPUT, start)


def markers(codec: Codec, frames: list[dict], wanted: tuple[bytes, ...]) -> list[int]:
    """Byte offsets of the first place of each marker, one after the other, in a run of frames."""
    found: list[int] = []
    tail, at = b"", 0
    for part in codec.stream(frames):
        window, base = tail + part, at - len(tail)
        begin = 0
        while len(found) < len(wanted):
            place = window.find(wanted[len(found)], begin)
            if place < 0:
                break
            found.append(base + place)
            begin = place + len(wanted[len(found) - 1])
        if len(found) == len(wanted):
            return found
        at += len(part)
        tail = window[max(begin, len(window) - 2) :]
    raise ValueError("the output lacks a marker")


def text_ranges(codec: Codec, form: str, frames: list[dict], size: int) -> list[tuple[int, int]]:
    """Byte ranges of an output that make the text, in order."""
    if form == "plain":
        return [(0, size)]
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    places = markers(codec, frames, order)
    ends = [*places[1:], size]
    part = {m: (p + len(m), end) for m, p, end in zip(order, places, ends)}
    return [part[PREFIX], part[MIDDLE], part[SUFFIX]]


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id with the text's frames, from the frames and the form of an output."""

    def start() -> Callable[[dict], dict]:
        codec = Codec()

        def of(row: dict) -> dict:
            out = Builder(codec)
            for begin, end in text_ranges(codec, row["form"], row["frames"], row["n_bytes"]):
                out.add_range(row["frames"], row["n_bytes"], begin, end)
            held = out.done()
            return {"doc_id": row["doc_id"], "n_bytes": out.size, "frames": held}

        return of

    rows = outputs.select("doc_id", "form", "n_bytes", "frames")
    return _map(rows, f"doc_id long, n_bytes long, frames {FRAMES}", start)


def read(framed: DataFrame) -> DataFrame:
    """doc_id and text of rows with frames."""

    def start() -> Callable[[dict], dict]:
        codec = Codec()
        return lambda row: {"doc_id": row["doc_id"], "text": b"".join(codec.stream(row["frames"])).decode(errors="replace")}

    return _map(framed.select("doc_id", "n_bytes", "frames"), "doc_id long, text string", start)


def digests(outputs: DataFrame) -> DataFrame:
    """The columns of an output, its sha256 and that of the text that it restores to."""

    def start() -> Callable[[dict], dict]:
        codec = Codec()

        def sha256(frames: list[dict], ranges: list[tuple[int, int]]) -> str:
            running = hashlib.sha256()
            for begin, end in ranges:
                for part in codec.stream(frames, begin, end):
                    running.update(part)
            return running.hexdigest()

        def of(row: dict) -> dict:
            frames, size = row.pop("frames"), row.pop("n_bytes")
            return row | {
                "output_sha256": sha256(frames, [(0, size)]),
                "restored_sha256": sha256(frames, text_ranges(codec, row["form"], frames, size)),
            }

        return of

    return _map(outputs, DIGEST, start)


def digest(docs: DataFrame) -> DataFrame:
    return digests(transform(store(docs)))


ORACLE = """
with units as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as unit,
    sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents
), drawn as (
  select doc_id, text, unit, len(unit) as n,
    ('0x' || substr(h, 1, 8))::bigint % (len(unit) + 1) as c1,
    ('0x' || substr(h, 9, 8))::bigint % (len(unit) + 1) as c2,
    ('0x' || substr(h, 17, 8))::bigint % 100 as h3,
    ('0x' || substr(h, 25, 8))::bigint % 100 as h4
  from units
), cuts as (
  select doc_id, text, n,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 90
      then 'plain' when h4 < 20 then 'spm' else 'psm' end as form,
    array_to_string(list_slice(unit, 1, least(c1, c2)), '') as prefix,
    array_to_string(list_slice(unit, least(c1, c2) + 1, greatest(c1, c2)), '') as middle,
    array_to_string(list_slice(unit, greatest(c1, c2) + 1, n), '') as suffix
  from drawn
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
  case when form <> 'plain' then length(middle)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
from cuts
"""

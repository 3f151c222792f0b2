"""Small awkward corpora for the tests of the text operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, added to an input to see that nothing clashes.
CLASHING = (
    "key", "line", "pos", "keep", "part", "block", "family", "rows", "score", "ids", "path", "blob",
    "spans", "n_dropped", "n_lines", "text_hash", "_row", "_at", "_doc", "hashes", "component", "node",
)

WORDS = "the of and a tree river stone Über Élan naïve x1 42 semi-colon end. RUN ran été ß".split()


def awkward_texts(seed: int = 0, n: int = 60) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    shared = ["A line that very many documents share, word for word.", "  another LINE shared by a number of them\t"]
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        lines = [" ".join(rng.choices(WORDS, k=rng.randint(0, 14))) for _ in range(rng.randint(0, 6))]
        lines += [line for line in shared if rng.random() < 0.5]
        rng.shuffle(lines)
        out.append((i, rng.choice(["\n", "\r\n", "\n\n"]).join(lines)))
    copy = "one text that is copied word for word into many documents of this corpus\nwith a second line of its own"
    out += [(n + i, copy if i % 2 else copy + " x") for i in range(20)]
    out += [(n + 20, None), (n + 21, ""), (n + 22, "\n"), (n + 23, " \t "), (n + 24, "!!! ... ???"), (n + 25, "▁ mark ▁▁")]
    out += [(n + 26, "long " * 4000 + "\x01\x00 end"), (n + 27, "w" * 5000)]
    out += [(n + 28, "same row twice, of some length\nshared")] * 2
    out += [(n + 29, "one id, first text of two"), (n + 29, "one id, second text of two"), (None, "no id at all here")]
    return out


def frame(spark, rows, clashing: bool = False):
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(4)
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))
    return df


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

"""Texts as seekable runs of independent zstandard frames.

A text's UTF-8 bytes are cut into frames of near FRAME_BYTES, at code points only, and every
frame is compressed on its own. Beside its bytes a frame holds what lies before it: units
(`[A-Za-z]+|[^A-Za-z]`), code points and bytes. So the place of any unit is found by a search
in the cumulative counts and by reading one frame, a part of a text is made of whole frames
as they are and of two that are cut, and a digest reads one frame at a time. A frame may
begin inside a run of letters; a unit counts where it starts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import zstandard

FRAME_BYTES = 64 * 1024
LEVEL = 3

#: A column of frames; `units`, `chars` and `start` (bytes) count what lies before a frame.
FRAMES = "array<struct<units: long, chars: long, start: long, data: binary>>"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def _starts(data: bytes, after_letter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes start a code point, and which start a unit."""
    raw = np.frombuffer(data, np.uint8)
    point = (raw & 0xC0) != 0x80
    letter = _LETTER[raw]
    inner = np.empty(len(raw), bool)
    inner[:1] = after_letter
    inner[1:] = letter[:-1]
    return point, point & ~(letter & inner)


def _is_letter(data: bytes) -> bool:
    return bool(data) and bool(_LETTER[data[-1]])


@dataclass
class Frames:
    """The frames of one text, and the counts over all of it."""

    frames: list[dict] = field(default_factory=list)
    units: int = 0
    chars: int = 0
    size: int = 0
    _last_letter: bool = False

    def append(self, raw: bytes, packed: bytes) -> None:
        """Add a frame; ``packed`` is ``raw``, compressed."""
        point, unit = _starts(raw, self._last_letter)
        self.frames.append({"units": self.units, "chars": self.chars, "start": self.size, "data": packed})
        self.units += int(unit.sum())
        self.chars += int(point.sum())
        self.size += len(raw)
        self._last_letter = _is_letter(raw)


def cut_points(raw: bytes, limit: int = FRAME_BYTES) -> Iterator[bytes]:
    """``raw`` in slices near ``limit`` bytes that begin at code points."""
    at = 0
    while at < len(raw):
        end = min(at + limit, len(raw))
        while end < len(raw) and (raw[end] & 0xC0) == 0x80 and end < at + limit + 8:
            end += 1
        yield raw[at:end]
        at = end


class Codec:
    """One per task: compresses and reads frames."""

    def __init__(self) -> None:
        self._pack = zstandard.ZstdCompressor(level=LEVEL)
        self._unpack = zstandard.ZstdDecompressor()

    def pack(self, raw: bytes) -> bytes:
        return self._pack.compress(raw)

    def unpack(self, data: bytes) -> bytes:
        return self._unpack.decompress(data)

    def store(self, raw: bytes, limit: int = FRAME_BYTES) -> Frames:
        made = Frames()
        for part in cut_points(raw, limit):
            made.append(part, self.pack(part))
        return made

    def stream(self, frames: list[dict], begin: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from ``begin`` up to ``end``, reading only frames that hold some of them."""
        k = max(0, bisect_right(frames, begin, key=lambda f: f["start"]) - 1)
        for frame in frames[k:]:
            if end is not None and frame["start"] >= end:
                return
            raw = self.unpack(frame["data"])
            low = max(0, begin - frame["start"])
            high = len(raw) if end is None else min(len(raw), end - frame["start"])
            if low < high:
                yield raw[low:high]

    def place(self, frames: list[dict], unit: int) -> tuple[int, int]:
        """Code points and bytes before unit number ``unit`` (from 0), which the text has."""
        k = bisect_right(frames, unit, key=lambda f: f["units"]) - 1
        frame = frames[k]
        raw = self.unpack(frame["data"])
        after_letter = k > 0 and _is_letter(self.unpack(frames[k - 1]["data"]))
        point, starts = _starts(raw, after_letter)
        at = int(np.flatnonzero(starts)[unit - frame["units"]])
        return frame["chars"] + int(point[:at].sum()), frame["start"] + at


class Builder:
    """Puts a new run of frames together from bytes and from parts of other runs."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec
        self.frames: list[dict] = []
        self.size = 0
        self._held = b""

    def _put(self, size: int, data: bytes) -> None:
        self.frames.append({"units": None, "chars": None, "start": self.size, "data": data})
        self.size += size

    def _flush(self) -> None:
        for part in cut_points(self._held):
            self._put(len(part), self.codec.pack(part))
        self._held = b""

    def add(self, raw: bytes) -> None:
        self._held += raw
        if len(self._held) >= FRAME_BYTES:
            self._flush()

    def add_range(self, frames: list[dict], size: int, begin: int, end: int) -> None:
        """Bytes ``begin`` to ``end`` of a run of ``size`` bytes; large frames inside go as they are."""
        k = max(0, bisect_right(frames, begin, key=lambda f: f["start"]) - 1)
        for frame, after in zip(frames[k:], [*(f["start"] for f in frames[k + 1 :]), size]):
            if frame["start"] >= end:
                return
            low, high = max(begin, frame["start"]), min(end, after)
            if low >= high:
                continue
            if high - low == after - frame["start"] and high - low >= FRAME_BYTES // 2:
                self._flush()
                self._put(high - low, frame["data"])
            else:
                self.add(self.codec.unpack(frame["data"])[low - frame["start"] : high - frame["start"]])

    def done(self) -> list[dict]:
        self._flush()
        return self.frames

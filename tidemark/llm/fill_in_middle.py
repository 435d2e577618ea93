"""Fill-in-the-middle examples cut from texts held as seekable compressed frames.

Method: a text is stored as independent zstandard frames, each ending at a unit, with the
units and characters up to its end. The two cuts of an example are looked up in these
counts, so only the frames that hold a cut are decompressed and split; all other frames go
into the output as they are. As zstandard frames may follow each other, an output is again
such a list of frames, whose concatenation any zstandard reader expands to the example.
Digests and restored texts stream an output's frames in their order.

A unit is a run of ASCII letters or any other single character. With n units and the
draws h1 to h4 of a row the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1)
units and the middle after the larger; h3 chooses plain rows, h4 between suffix-first (spm)
and prefix-first (psm) ones. The draws follow from the id and a seed, not from row order.

Memory: a task holds one Arrow batch of texts and one text's pieces at a time.

Edge cases: a null text is the empty text; an empty text, or one that holds a marker, is
plain, whatever the draws say; a null id draws as the empty id; repeated rows give equal
rows; a run of letters longer than a frame makes that frame longer; an empty table gives no
rows. Only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays

# fixed values: the markers, and the shares of plain and of suffix-first rows
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20

FRAME_UNITS = 8192
LEVEL = 3

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True

FRAME = T.StructType(
    [
        T.StructField("units", T.LongType()),
        T.StructField("chars", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)
_FRAMES = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def pack(data: bytes) -> bytes:
    return _codec()[0].compress(data)


def unpack(frame: bytes) -> bytes:
    return _codec()[1].decompress(frame)


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Places of the bytes of one text at which a unit begins."""
    letter = _LETTER[data]
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def frames_of(text: bytes, frame_units: int = FRAME_UNITS) -> list[tuple[int, int, bytes]]:
    """(units, characters, data) of the frames of a text, counted up to each one's end."""
    data = np.frombuffer(text, np.uint8)
    starts = unit_starts(data)
    out, chars = [], 0
    for first in range(0, len(starts), frame_units):
        last = min(first + frame_units, len(starts))
        end = int(starts[last]) if last < len(starts) else len(data)
        begin = int(starts[first])
        chars += characters(data[begin:end])
        out.append((last, chars, pack(text[begin:end])))
    return out


def frame_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", frame_units: int = FRAME_UNITS
) -> DataFrame:
    """Id, `marked` (whether the text holds a marker) and `frames` of every row."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_column].dataType),
            T.StructField("marked", T.BooleanType()),
            T.StructField("frames", T.ArrayType(FRAME)),
        ]
    )
    text = F.col(text_column)
    holds = [text.contains(m.decode()) for m in (PREFIX, SUFFIX, MIDDLE)]
    marked = F.coalesce(holds[0] | holds[1] | holds[2], F.lit(False))

    def run(stream):
        for rows, _, data, offsets in arrays.batches(stream, "text"):
            held = data.tobytes()
            ends = offsets.tolist()
            frames = [
                [
                    {"units": u, "chars": c, "data": d}
                    for u, c, d in frames_of(held[a:b], frame_units)
                ]
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(frames, _FRAMES)], names=list(schema.names)
            )

    return docs.select(F.col(id_column).alias("id"), marked.alias("marked"), text.alias("text")).mapInArrow(run, schema)


def draws(id_column: str, seed: int = 1) -> Column:
    """Four whole numbers below 2^32 from the sha256 of the seed and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])


class Framed:
    """The frames of one text; what lies between two cuts comes as frames again."""

    def __init__(self, frames: list[dict]):
        self.frames = [f["data"] for f in frames]
        self.units = [0, *(f["units"] for f in frames)]
        self.chars = [0, *(f["chars"] for f in frames)]
        self._open: dict[int, tuple[bytes, np.ndarray]] = {}

    def _opened(self, frame: int) -> tuple[bytes, np.ndarray]:
        if frame not in self._open:
            text = unpack(self.frames[frame])
            self._open[frame] = text, unit_starts(np.frombuffer(text, np.uint8))
        return self._open[frame]

    def seek(self, unit: int) -> tuple[int, int, int]:
        """Frame and byte place in it at which the text is cut after `unit` units, and the
        characters before the cut. A cut between two frames opens neither."""
        frame = int(np.searchsorted(self.units, unit, side="right")) - 1
        if self.units[frame] == unit:
            return frame, 0, self.chars[frame]
        text, starts = self._opened(frame)
        at = int(starts[unit - self.units[frame]])
        return frame, at, self.chars[frame] + characters(np.frombuffer(text, np.uint8)[:at])

    def between(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> Iterator[bytes]:
        """The frames of what lies between two cuts."""
        (first, a, _), (last, b, _) = start, end
        for frame in range(first, last + (b > 0)):
            low = a if frame == first else 0
            high = b if frame == last else None
            if low == 0 and high is None:
                yield self.frames[frame]
            elif high is None or low < high:
                yield pack(self._opened(frame)[0][low:high])


def arrange(frames: list[dict], marked: bool, drawn: list[int], plain_percent: int, spm_percent: int):
    """Form, units, characters of prefix and middle (None if plain), and the output's frames."""
    text = Framed(frames)
    n = text.units[-1]
    if not n or marked or drawn[2] % 100 >= 100 - plain_percent:
        return "plain", n, None, None, text.frames
    cuts = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    start, end = (0, 0, 0), (len(text.frames), 0, text.chars[-1])
    one, two = text.seek(cuts[0]), text.seek(cuts[1])
    prefix, middle, suffix = (list(text.between(*p)) for p in ((start, one), (one, two), (two, end)))
    p, s, m = (pack(marker) for marker in (PREFIX, SUFFIX, MIDDLE))
    if drawn[3] % 100 < spm_percent:
        form, out = "spm", [s, *suffix, p, *prefix, m, *middle]
    else:
        form, out = "psm", [p, *prefix, s, *suffix, m, *middle]
    return form, n, one[2], two[2] - one[2], out


def fill_in_middle(
    framed: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """For each row of `frame_texts`: id, n (units), form, prefix_chars, middle_chars and
    `output`, the example's frames in their order."""
    schema = T.StructType(
        [
            framed.schema["id"],
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.ArrayType(T.BinaryType())),
        ]
    )

    def run(stream):
        for batch in stream:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                marked, drawn, frames = (part.column(i).to_pylist() for i in (1, 2, 3))
                made = [
                    arrange(f, m, d, plain_percent, spm_percent)
                    for f, m, d in zip(frames, marked, drawn, strict=True)
                ]
                form, n, prefix, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.list_(pa.binary())),
                    ],
                    names=list(schema.names),
                )

    return framed.select("id", "marked", draws("id", seed).alias("drawn"), "frames").mapInArrow(run, schema)


def restore(output: bytes, form: str) -> bytes:
    """The text of an expanded output, from it and its form alone. Of the markers each stands
    once in an output that is not plain, as no text with a marker is cut."""
    if form == "plain":
        return output
    if form == "psm":
        second, third = output.index(SUFFIX), output.index(MIDDLE)
        prefix, suffix = output[len(PREFIX) : second], output[second + len(SUFFIX) : third]
    else:
        second, third = output.index(PREFIX), output.index(MIDDLE)
        suffix, prefix = output[len(SUFFIX) : second], output[second + len(PREFIX) : third]
    return prefix + output[third + len(MIDDLE) :] + suffix


def text_order(frames: list[bytes], form: str) -> list[bytes]:
    """The frames of an output without its markers, in the order of the text. A marker is a
    frame of its own, and no frame of a text that was cut spells one."""
    if form == "plain":
        return frames
    held: dict[bytes, list[bytes]] = {}
    for frame in frames:
        small = unpack(frame) if zstandard.frame_content_size(frame) == len(PREFIX) else b""
        if small in (PREFIX, SUFFIX, MIDDLE) and small not in held:
            section = held[small] = []
        else:
            section.append(frame)
    return held[PREFIX] + held[MIDDLE] + held[SUFFIX]


def expand(examples: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with the texts: `output` as text, and `restored`, what
    `restore` makes of it."""

    def texts(frames: list[bytes], form: str) -> tuple[str, str]:
        output = b"".join(map(unpack, frames))
        return output.decode(), restore(output, form).decode()

    return _streamed(examples, texts, ("output", "restored"))


def digests(examples: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with the sha256 of the output and of the text restored
    from it; one frame is expanded at a time."""

    def both(frames: list[bytes], form: str) -> tuple[str, str]:
        out, back = hashlib.sha256(), hashlib.sha256()
        for frame in frames:
            out.update(unpack(frame))
        for frame in text_order(frames, form):
            back.update(unpack(frame))
        return out.hexdigest(), back.hexdigest()

    return _streamed(examples, both, ("output_sha256", "restored_sha256"))


def _streamed(examples: DataFrame, of, names: tuple[str, str]) -> DataFrame:
    kept = [f for f in examples.schema.fields if f.name != "output"]
    schema = T.StructType([*kept, *(T.StructField(name, T.StringType()) for name in names)])

    def run(stream):
        for batch in stream:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                outputs, forms = part.column("output").to_pylist(), part.column("form").to_pylist()
                made = [of(frames, form) for frames, form in zip(outputs, forms, strict=True)]
                rest = [part.column(f.name) for f in kept]
                rest += [pa.array(column, pa.string()) for column in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays(rest, names=list(schema.names))

    return examples.mapInArrow(run, schema)

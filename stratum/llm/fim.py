"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames of ``frame_chars`` characters.
Each frame carries how many characters and units precede it, so that a unit is
found by decompressing one frame, and any range by the frames it touches. A unit
is a run of ASCII letters or any other single character. A run that crosses a
frame's end belongs to the frame where it starts.

:func:`frames` writes the texts so, :func:`transform` picks the two cuts of each
text by its id, decompresses the cut frames to place them, and streams the
ranges into frames of the transformed text; :func:`digests` streams ordered
frames for the digests of the output and of the text rebuilt from it. Nothing
is shuffled, and beside the row that Spark hands over, no more than a few frames
of a text are decompressed at a time.

Defined results: a null text counts as empty; an empty text and one that holds
a sentinel stay plain; a null id is hashed as the empty string; equal ids get
equal draws (cuts depend on id and number of units alone); repeated rows give
repeated rows; other input columns pass through, those named like an output are
replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import append_column, text_slices, with_field

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Characters in a frame.
FRAME_CHARS = 1 << 16
LEVEL = 1
#: Of 100 texts, so many are transformed, and of these so many suffix first.
FIM_PERCENT, SPM_PERCENT = 90, 20

FRAMES = T.ArrayType(
    T.StructType(
        [
            T.StructField("chars_before", T.LongType()),
            T.StructField("units_before", T.LongType()),
            T.StructField("inside", T.BooleanType()),  # the first character continues a run of letters
            T.StructField("data", T.BinaryType()),
        ]
    )
)


def unit_starts(text: str, inside: bool):
    """True at each character of ``text`` where a unit starts."""
    import numpy as np

    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (code | 32) - np.uint32(97) < 26
    return ~(letter & np.r_[inside, letter[:-1]])


class FrameWriter:
    """Turns pieces of text into frames."""

    def __init__(self, compressor, frame_chars: int):
        self.compress, self.size = compressor.compress, frame_chars
        self.frames: list[dict] = []
        self.chars = self.units = self.waiting = 0
        self.inside = False
        self.pieces: list[str] = []

    def add(self, text: str) -> None:
        at = 0
        while len(text) - at >= self.size - self.waiting:
            stop = at + self.size - self.waiting
            self.pieces.append(text[at:stop])
            at = stop
            self._flush()
        if at < len(text):
            self.pieces.append(text[at:])
            self.waiting += len(text) - at

    def _flush(self) -> None:
        text = "".join(self.pieces)
        self.pieces, self.waiting = [], 0
        if text:
            self.frames.append({"chars_before": self.chars, "units_before": self.units, "inside": self.inside, "data": self.compress(text.encode())})
            self.chars += len(text)
            self.units += int(unit_starts(text, self.inside).sum())
            self.inside = text[-1].isascii() and text[-1].isalpha()

    def finish(self) -> list[dict]:
        self._flush()
        return self.frames


class FrameReader:
    """Reads ranges of a text from its frames; keeps the last frame read."""

    def __init__(self, decompressor, frames: list[dict], chars: int, units: int):
        self.decompress, self.frames, self.chars, self.units = decompressor.decompress, frames, chars, units
        self.last: tuple[int, str] = (-1, "")

    def frame(self, i: int) -> str:
        if self.last[0] != i:
            self.last = (i, self.decompress(self.frames[i]["data"]).decode())
        return self.last[1]

    def place(self, unit: int) -> int:
        """The character at which a unit starts (the end, after the last)."""
        if unit >= self.units:
            return self.chars
        i = bisect_right(self.frames, unit, key=lambda f: f["units_before"]) - 1
        frame = self.frames[i]
        starts = unit_starts(self.frame(i), frame["inside"]).nonzero()[0]
        return frame["chars_before"] + int(starts[unit - frame["units_before"]])

    def pieces(self, start: int, stop: int):
        """The text from one character to another, a frame at a time."""
        if start >= stop:
            return
        i = bisect_right(self.frames, start, key=lambda f: f["chars_before"]) - 1
        while i < len(self.frames) and self.frames[i]["chars_before"] < stop:
            before = self.frames[i]["chars_before"]
            yield self.frame(i)[max(0, start - before) : stop - before]
            i += 1

    def find(self, mark: str, start: int) -> int:
        """The first place of ``mark`` from a character on; -1: none."""
        tail, at = "", start
        for piece in self.pieces(start, self.chars):
            seen = tail + piece
            found = seen.find(mark)
            if found >= 0:
                return at - len(tail) + found
            tail, at = seen[len(seen) - len(mark) + 1 :] if len(seen) >= len(mark) else seen, at + len(piece)
        return -1


def _frame_batches(batches, *, text: str, out: str, frame_chars: int):
    import pyarrow as pa
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    kind = _arrow(FRAMES)
    for batch in batches:
        for start, stop in text_slices(batch.column(text)):
            part = batch.slice(start, stop - start)
            frames, chars, units, marked = [], [], [], []
            for value in part.column(text).to_pylist():
                value = value or ""
                writer = FrameWriter(compressor, frame_chars)
                writer.add(value)
                frames.append(writer.finish())
                chars.append(writer.chars)
                units.append(writer.units)
                marked.append(any(mark in value for mark in (PREFIX, SUFFIX, MIDDLE)))
            for name, values, type_ in ((out, frames, kind), ("chars", chars, pa.int64()), ("n", units, pa.int64()), ("marked", marked, pa.bool_())):
                part = append_column(part, name, pa.array(values, type_))
            yield part.drop_columns([text])


def _arrow(kind: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def frames(docs: DataFrame, text: str = "text", out: str = "frames", frame_chars: int = FRAME_CHARS) -> DataFrame:
    """``docs`` with the text replaced by its frames, and with chars and n (its
    characters and units) and marked (it holds a sentinel)."""
    schema = docs.schema
    for name, kind in ((out, FRAMES), ("chars", T.LongType()), ("n", T.LongType()), ("marked", T.BooleanType())):
        schema = with_field(schema, name, kind)
    schema = T.StructType([f for f in schema.fields if f.name != text])
    return docs.mapInArrow(partial(_frame_batches, text=text, out=out, frame_chars=frame_chars), schema)


def arrange(form: str, cuts: tuple[int, int], chars: int) -> list[str | tuple[int, int]]:
    """The output of a form: sentinels and ranges of the text, in order."""
    low, high = cuts
    prefix, middle, suffix = (0, low), (low, high), (high, chars)
    return [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle] if form == "psm" else [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]


def _fim_batches(batches, *, frame_chars: int):
    import pyarrow as pa
    import zstandard

    compressor, decompressor = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
    kind = _arrow(FRAMES)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            forms, prefixes, middles, outs, chars = [], [], [], [], []
            columns = (part.column(c).to_pylist() for c in ("__draw", "frames", "chars", "n", "marked"))
            for draw, stored_frames, length, n, marked in zip(*columns):
                h1, h2, h3, h4 = (int(draw[i : i + 8], 16) for i in range(0, 32, 8))
                if not length or marked or h3 % 100 >= FIM_PERCENT:
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outs.append(stored_frames)
                    chars.append(length)
                    continue
                form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
                reader = FrameReader(decompressor, stored_frames, length, n)
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                cuts = reader.place(low), reader.place(high)
                writer = FrameWriter(compressor, frame_chars)
                for piece in arrange(form, cuts, length):
                    for text in [piece] if isinstance(piece, str) else reader.pieces(*piece):
                        writer.add(text)
                forms.append(form)
                prefixes.append(cuts[0])
                middles.append(cuts[1] - cuts[0])
                outs.append(writer.finish())
                chars.append(writer.chars)
            for name, values, type_ in (("form", forms, pa.string()), ("prefix_chars", prefixes, pa.int64()), ("middle_chars", middles, pa.int64()), ("output", outs, kind), ("output_chars", chars, pa.int64())):
                part = append_column(part, name, pa.array(values, type_))
            yield part.drop_columns(["__draw", "frames", "chars", "marked"])


def transform(framed: DataFrame, id: str = "doc_id", seed: str = "1", frame_chars: int = FRAME_CHARS) -> DataFrame:
    """``framed`` (see :func:`frames`) with form (plain, psm or spm),
    prefix_chars, middle_chars (null if plain), output (the frames of the
    transformed text) and output_chars, in place of the text's frames."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    schema = framed.schema
    for name, kind in (("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", FRAMES), ("output_chars", T.LongType())):
        schema = with_field(schema, name, kind)
    schema = T.StructType([f for f in schema.fields if f.name not in ("frames", "chars", "marked")])
    return framed.withColumn("__draw", draw).mapInArrow(partial(_fim_batches, frame_chars=frame_chars), schema)


def restored(reader: FrameReader, form: str):
    """The pieces of the original text, from the transformed one."""
    if form == "plain":
        yield from reader.pieces(0, reader.chars)
        return
    other = SUFFIX if form == "psm" else PREFIX
    second = reader.find(other, 3)
    third = reader.find(MIDDLE, second + 3)
    first_range, second_range, middle = (3, second), (second + 3, third), (third + 3, reader.chars)
    prefix, suffix = (first_range, second_range) if form == "psm" else (second_range, first_range)
    for start, stop in (prefix, middle, suffix):
        yield from reader.pieces(start, stop)


def _digest_batches(batches):
    import hashlib

    import pyarrow as pa
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            outs, texts = [], []
            for form, output, chars in zip(*(part.column(c).to_pylist() for c in ("form", "output", "output_chars"))):
                reader = FrameReader(decompressor, output, chars, 0)
                digests = hashlib.sha256(), hashlib.sha256()
                for digest, pieces in zip(digests, (reader.pieces(0, chars), restored(reader, form))):
                    for piece in pieces:
                        digest.update(piece.encode())
                outs.append(digests[0].hexdigest())
                texts.append(digests[1].hexdigest())
            part = append_column(part, "output_sha256", pa.array(outs, pa.string()))
            yield append_column(part, "restored_sha256", pa.array(texts, pa.string())).drop_columns(["output", "output_chars"])


def digests(transformed: DataFrame) -> DataFrame:
    """``transformed`` with output_sha256 and restored_sha256 (of the text
    rebuilt from output and form) in place of the output."""
    schema = with_field(with_field(transformed.schema, "output_sha256", T.StringType()), "restored_sha256", T.StringType())
    schema = T.StructType([f for f in schema.fields if f.name not in ("output", "output_chars")])
    return transformed.mapInArrow(_digest_batches, schema)


def _text_batches(batches):
    import pyarrow as pa
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = ["".join(FrameReader(decompressor, f, n, 0).pieces(0, n)) for f, n in zip(part.column("output").to_pylist(), part.column("output_chars").to_pylist())]
            yield append_column(part.drop_columns(["output", "output_chars"]), "output", pa.array(texts, pa.string()))


def texts(transformed: DataFrame) -> DataFrame:
    """``transformed`` with the transformed text as a plain string ``output``."""
    schema = T.StructType([f for f in transformed.schema.fields if f.name not in ("output", "output_chars")])
    return transformed.mapInArrow(_text_batches, schema.add("output", T.StringType()))

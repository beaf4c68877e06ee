"""SentencePiece encoding that keeps the byte offsets of every piece, and decoding.

Encoding runs in Arrow batches. A text is normalised through the model's compiled
character map by longest prefixes, recording for each normalised byte the byte it came
from; pieces are merged by the scores of the model, and each is projected to its
span of the original text.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.names import column

SPACE = "▁"
_SPACE_BYTES = SPACE.encode()
_KEPT_SEGMENTS = 200_000
# Types of pieces in a model file (fixed values).
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message: number and value, unparsed."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            length, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = message[at : at + length], at + length
        yield tag >> 3, value


class CharacterMap:
    """A compiled map from strings to their normal form: a double array of bytes, then texts."""

    def __init__(self, compiled: bytes):
        (size,) = struct.unpack_from("<I", compiled)
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.texts = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Length of the longest entry that ``data`` has at ``at``, and where its text starts."""
        units, found = self.units, None
        node = self._child(0, units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node = self._child(node, unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        return found

    @staticmethod
    def _child(node: int, unit: int) -> int:
        return node ^ (unit >> 10 << ((unit & 512) >> 6))

    def text(self, start: int) -> bytes:
        return self.texts[start : self.texts.index(0, start)]


class PieceModel:
    """A byte-pair model with byte fallback, read from its file's bytes."""

    def __init__(self, content: bytes):
        self.pieces, kinds, scores = [], [], []
        settings: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for field, value in _fields(content):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                kinds.append(piece.get(3, _NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                settings = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("only byte-pair models with byte fallback and leading spaces are read")
        if {_USER_DEFINED, _UNUSED} & {*kinds}:
            raise ValueError("models with user-defined or unused pieces are not read")
        compiled = settings.get(2, b"")
        self.characters = CharacterMap(compiled) if compiled else None
        self.dummy_prefix = bool(settings.get(3, 1))
        self.trims = bool(settings.get(4, 1))
        self.escapes = bool(settings.get(5, 1))
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        self.score = {p: s for p, s, k in zip(self.pieces, scores, kinds) if k == _NORMAL}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == _NORMAL}
        self.byte_ids = [0] * 256
        surfaces, lengths = [], []
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds)):
            if kind == _BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
                surfaces.append(bytes([int(piece[3:5], 16)]))
                lengths.append(1)
            elif kind == _NORMAL:
                surfaces.append(piece.replace(SPACE, " ").encode())
                lengths.append(len(piece.encode()))
            else:
                surfaces.append(b"" if kind == _CONTROL else trainer.get(44, " ⁇ ".encode()))
                lengths.append(0)
        self.surfaces = np.array(surfaces, dtype=object)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.spaced = np.array([k == _NORMAL and p.startswith(SPACE) for p, k in zip(self.pieces, kinds)])
        self.control = np.array([k == _CONTROL for k in kinds])
        # Texts can be cut before spaces if no piece goes on from a letter to a space, and
        # around line ends and tabs that no piece holds.
        used = set().union(*self.score)
        apart = "".join(c for c in "\n\t\r" if c not in used)
        cut = f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|[{apart}]" if apart else "")
        self.segment = re.compile("(?s).+" if any(SPACE in p.lstrip(SPACE) for p in self.score) else cut)
        self.kept: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the original byte."""
        data = text.encode()
        if self.characters is None and not self.trims:
            if not data:
                return "", np.zeros(1, np.int64)
            widths = np.ones(len(data) + 1, np.int64)
            if self.escapes:
                widths[:-1][np.frombuffer(data, np.uint8) == 32] = len(_SPACE_BYTES)
                text = text.replace(" ", SPACE)
            origin = np.repeat(np.arange(len(data) + 1), widths)
            if self.dummy_prefix:
                mark = SPACE if self.escapes else " "
                return mark + text, np.concatenate([np.zeros(len(mark.encode()), np.int64), origin])
            return text, origin
        return self._normalise_by_prefixes(data)

    def _prefixes(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """The normal form of one prefix after the other, with its place."""
        at = 0
        while at < len(data):
            found = self.characters.longest(data, at) if self.characters else None
            if found:
                length, text = found[0], self.characters.text(found[1])
            else:
                first = data[at]
                length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                text = data[at : at + length]
            yield text, at, at + length
            at += length

    def _normalise_by_prefixes(self, data: bytes) -> tuple[str, np.ndarray]:
        space = _SPACE_BYTES if self.escapes else b" "
        out, origin = bytearray(), []
        end, after_space, begun = 0, self.trims, False
        for text, at, past in self._prefixes(data):
            if self.trims and not begun and text == b" ":
                end = past
                continue
            if not begun:
                begun = True
                if self.dummy_prefix:
                    out += space
                    origin += [at] * len(space)
            if after_space:
                text = text.lstrip(b" ")
            for byte in text:
                unit = space if byte == 32 else bytes([byte])
                out += unit
                origin += [at] * len(unit)
            if text:
                after_space = self.trims and text.endswith(b" ")
            end = past
        if self.trims:
            while out.endswith(space):
                del out[-len(space) :]
                end = origin[len(out)]
                del origin[len(out) :]
        return out.decode("utf-8", "replace"), np.array([*origin, end], np.int64)

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merge the neighbours that make the best piece, the leftmost of equals, until none does."""
        score, none = self.score, -np.inf
        if len(symbols) <= 64:
            values = [score.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
            while values and (best := max(values)) != none:
                at = values.index(best)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                del values[at]
                if at:
                    values[at - 1] = score.get(symbols[at - 1] + symbols[at], none)
                if at < len(values):
                    values[at] = score.get(symbols[at] + symbols[at + 1], none)
            return symbols
        # The same with a heap, for long segments.
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (piece := symbols[left] + symbols[right]) in score:
                heapq.heappush(heap, (-score[piece], left, right, piece))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, piece = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def _segment_ids(self, segment: str) -> bytes:
        ids: list[int] = []
        for piece in self._merged(list(segment)):
            if (number := self.ids.get(piece)) is not None:
                ids.append(number)
            else:
                ids += [self.byte_ids[byte] for byte in piece.encode()]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(segment) <= 64:
            if len(self.kept) >= _KEPT_SEGMENTS:
                self.kept.clear()
            self.kept[segment] = packed
        return packed

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """The ids with begin and end, and for each the original byte its piece ends at.

        Both are little-endian unsigned 32-bit integers. A piece starts where the one
        before ends, so a piece that stands for nothing of the text has an empty span.
        """
        normal, origin = self.normalise(text)
        get, make = self.kept.get, self._segment_ids
        body = b"".join([get(segment) or make(segment) for segment in self.segment.findall(normal)])
        ends = origin[np.cumsum(self.lengths[np.frombuffer(body, "<u4")])]
        packed = struct.pack("<I", self.bos) + body + struct.pack("<I", self.eos)
        start = int(origin[0]) if len(origin) > 1 else 0
        spans = np.concatenate([[start], ends, [ends[-1] if len(ends) else start]]).astype("<u4")
        return packed, spans.tobytes()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        ids = ids[~self.control[ids]]
        data = b"".join(self.surfaces[ids].tolist())
        if len(ids) and self.spaced[ids[0]] and (self.dummy_prefix or self.trims):
            data = data[1:]
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def model(content: bytes) -> PieceModel:
    """Read once in each Python worker."""
    return PieceModel(content)


_BATCH_CHARS = 500_000


def encode(df: DataFrame, model_file: str, *, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns in ``keep`` with ``ids``, ``ends`` and ``decoded`` for every row.

    ``ids`` and ``ends`` are binary (see ``PieceModel.encode``), ``decoded`` is the text
    that the ids decode to. ``model_file`` is read on the driver and shipped to the
    tasks. A null text counts as empty, which has the ids begin and end. Columns
    not kept don't matter; a kept column may not have the name of a new one.
    An empty table gives no rows. A text is encoded in one piece, so memory
    follows the longest text; batches are cut at about half a million characters.
    """
    with open(model_file, "rb") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    kept = df.select(*[column(name) for name in keep]).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(content.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            start, chars = 0, 0
            rows: list[tuple[bytes, bytes, str]] = []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                ids, ends = pieces.encode(text)
                rows.append((ids, ends, pieces.decode(ids)))
                chars += len(text)
                if chars >= _BATCH_CHARS or i == batch.num_rows - 1:
                    made = [pa.array(values, kind) for values, kind in zip(zip(*rows), (pa.binary(), pa.binary(), pa.string()))]
                    old = batch.slice(start, len(rows)).columns[:-1]
                    yield pa.RecordBatch.from_arrays([*old, *made], [*batch.schema.names[:-1], "ids", "ends", "decoded"])
                    start, chars, rows = i + 1, 0, []

    selected = df.select(*[column(name) for name in keep], F.coalesce(column(text_column), F.lit("")).alias("_text"))
    return selected.mapInArrow(encoded, f"{schema}, ids binary, ends binary, decoded string")


def token_counts(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """Digests of encoded rows: ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``ends_sha256``."""
    return encoded.select(
        *[column(name) for name in keep],
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("ends", 256).alias("ends_sha256"),
    )

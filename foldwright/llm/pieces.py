"""SentencePiece encoding and decoding (operator 12) that keeps the places of pieces in the source.

A model normalises a text before it looks for pieces: the compiled character map
replaces the longest prefix it knows, white space becomes a visible mark, extra
white space may go and a mark may be put in front. Here that is done with an
alignment: every byte of the normalised text knows the byte of the source that
it comes from. The library's segmentation runs on the normalised text, with a
model whose own normalisation is switched off; piece lengths then add up to
places in the normalised text, and the alignment turns them into byte spans of
the source. Pieces that stand for single bytes of one character share its start;
the last of them ends where the character ends. The end id has an empty span.

A null text counts as empty: it has the end id only, and decodes to an empty
text. Everything happens where a text is read; nothing is moved. Repeated rows
and ids, also null ones, are rows of their own; other columns play no part, and
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm import texts

MARK = "▁".encode()
#: fixed values of the model format: field numbers, and types of pieces
PIECES, NORMALIZER, CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE, TRAINER, SUFFIX = 1, 3, 2, 3, 4, 5, 2, 24
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6
#: texts of a block that are encoded in one call
_CALL_BYTES = 1 << 20


def _varint(raw: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[i] & 127) << shift
        i, shift = i + 1, shift + 7
        if raw[i - 1] < 128:
            return value, i


def message(raw: bytes) -> dict[int, list]:
    """The fields of one level of a protobuf message: numbers, or bytes."""
    out: dict[int, list] = {}
    i = 0
    while i < len(raw):
        tag, i = _varint(raw, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(raw, i)
        else:
            size, i = _varint(raw, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = raw[i : i + size], i + size
        out.setdefault(tag >> 3, []).append(value)
    return out


class CharacterMap:
    """The compiled map: a double array over the prefixes, and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size :]
        # first two bytes of what the map may know
        self.starts = np.zeros((256, 256), bool)
        if self.units:
            for a in range(256):
                node = self._step(self._root(), a)
                if node is None:
                    continue
                if self.units[node] >> 8 & 1:
                    self.starts[a] = True
                for b in range(256):
                    self.starts[a, b] |= self._step(node, b) is not None

    def _offset(self, node: int) -> int:
        unit = self.units[node]
        return (unit >> 10) << ((unit & 512) >> 6)

    def _root(self) -> int:
        return 0

    def _step(self, node: int, byte: int) -> int | None:
        to = node ^ self._offset(node) ^ byte
        # the label of a unit and the mark of a value share one comparison
        return to if to < len(self.units) and self.units[to] & 0x800000FF == byte else None

    def longest(self, raw: bytes, i: int) -> tuple[int, bytes] | None:
        """The longest known prefix of ``raw[i:]``: its length and its replacement."""
        node, best = 0, None
        for n, byte in enumerate(raw[i : i + 64], 1):
            node = self._step(node, byte)
            if node is None:
                break
            if self.units[node] >> 8 & 1:
                at = self.units[node ^ self._offset(node)] & 0x7FFFFFFF
                best = n, self.replacements[at : self.replacements.index(b"\0", at)]
        return best


class Normaliser:
    """Normalisation of a model with the alignment of every byte."""

    def __init__(self, model: bytes):
        fields = message(model)
        # several parts of one message count as one, later values win
        spec, trainer = (message(b"".join(fields.get(k, []))) for k in (NORMALIZER, TRAINER))
        self.map = CharacterMap(spec.get(CHARSMAP, [b""])[-1])
        self.dummy, self.squeeze, self.escape = (bool(spec.get(k, [1])[-1]) for k in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE))
        self.suffix = bool(trainer.get(SUFFIX, [0])[-1])
        own = [p[1][0] for p in map(message, fields.get(PIECES, [])) if p.get(3, [1])[-1] == USER_DEFINED]
        self.own = re.compile(b"|".join(re.escape(w) for w in sorted(own, key=len, reverse=True))) if own else None

    def _replaced(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Bytes after the character map, the source byte each comes from, where a replacement or character starts,
        and the source bytes of leading prefixes that each became one space."""
        data = np.frombuffer(raw, np.uint8)
        head = (data & 0xC0) != 0x80
        origin = np.maximum.accumulate(np.where(head, np.arange(len(data)), 0))
        changes: list[tuple[int, int, bytes]] = []
        kept = [(m.start(), m.end(), m[0]) for m in self.own.finditer(raw)] if self.own else []
        if self.map.units:
            after = np.append(data[1:], 0)
            stop, own = 0, iter([*kept, (len(raw), len(raw), b"")])
            a, b, word = next(own)
            for i in np.flatnonzero(self.map.starts[data, after]).tolist():
                while b <= i and a < len(raw):
                    a, b, word = next(own)
                if i < stop or a <= i < b:
                    continue
                if hit := self.map.longest(raw, i):
                    changes.append((i, i + hit[0], hit[1]))
                    stop = i + hit[0]
        changes = sorted(changes + kept)
        blank, spaces = 0, {a: b for a, b, new in changes if new == b" "}
        others = {a for a, _, new in changes if new != b" "}
        while blank in spaces or (blank not in others and raw[blank : blank + 1] == b" "):
            blank = spaces.get(blank, blank + 1)
        if not changes:
            return data, origin, head, blank
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        last = 0
        for a, b, new in [*changes, (len(raw), len(raw), b"")]:
            if a < last:
                continue
            first = np.zeros(len(new), bool)
            first[:1] = True
            parts.append((data[last:a], origin[last:a], head[last:a]))
            parts.append((np.frombuffer(new, np.uint8), np.full(len(new), a), first))
            last = b
        return *(np.concatenate(x) for x in zip(*parts, strict=True)), blank

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the source byte."""
        if not raw:
            return b"", np.zeros(1, np.int64)
        data, origin, head, blank = self._replaced(raw)
        end, start = len(raw), blank if self.squeeze else 0
        if start == end:
            return b"", np.full(1, end)
        space = data == 32
        if self.squeeze and len(data):
            # leading spaces of a replacement go after a space and at the start of the text
            before = np.concatenate(([True], space[:-1]))
            first = np.flatnonzero(np.concatenate(([True], head[1:])))
            length = np.diff(np.append(first, len(data)))
            others = np.cumsum(~space)
            leading = space & (others == np.repeat(others[first] - ~space[first], length))
            keep = ~(leading & np.repeat(before[first], length))
            data, origin, space = data[keep], origin[keep], space[keep]
        if self.escape and space.any():
            times = np.where(space, len(MARK), 1)
            first = np.cumsum(times) - times
            data, origin = np.repeat(data, times), np.repeat(origin, times)
            for i, byte in enumerate(MARK):
                data[first[space] + i] = byte
        sign = MARK if self.escape else b" "
        mark = np.frombuffer(sign, np.uint8)
        if self.dummy and not self.suffix:
            data, origin = np.concatenate((mark, data)), np.concatenate((np.full(len(mark), start), origin))
        if self.squeeze:
            while len(data) and data[-len(mark) :].tobytes() == sign:
                end = int(origin[-len(mark)])
                data, origin = data[: -len(mark)], origin[: -len(mark)]
        if self.dummy and self.suffix:
            data, origin = np.concatenate((data, mark)), np.concatenate((origin, np.full(len(mark), end)))
        return data.tobytes(), np.append(origin, end)


@dataclass
class Codec:
    """One model: normaliser, segmentation without normalisation, decoder, and the byte length of every piece."""

    path: str

    def __post_init__(self) -> None:
        with open(self.path, "rb") as file:
            raw = file.read()
        self.normalise = Normaliser(raw)
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=raw)
        # a later specification overrides the fields of an earlier one
        off = bytes([CHARSMAP << 3 | 2, 0, DUMMY_PREFIX << 3, 0, EXTRA_SPACES << 3, 0, ESCAPE << 3, 0])
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=raw + bytes([NORMALIZER << 3 | 2, len(off)]) + off)
        fields = [message(p) for p in message(raw)[PIECES]]
        kinds = [f.get(3, [1])[-1] for f in fields]
        self.sizes = np.array([1 if k == BYTE else len(f[1][0]) for f, k in zip(fields, kinds, strict=True)])
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else -1
        self.end = self.decoder.eos_id()

    def encode(self, rows: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, first bytes and ends of the pieces of each text, the end id included."""
        normal = [self.normalise(raw) for raw in rows]
        out = []
        found = self.segmenter.encode([text.decode() for text, _ in normal], out_type=int, num_threads=1)
        for raw, (text, origin), ids in zip(rows, normal, found, strict=True):
            ids = np.array(ids, np.int32)
            sizes = self.sizes[ids] if len(ids) else np.zeros(0, np.int64)
            if self.unknown >= 0 and (ids == self.unknown).any():
                words = self.segmenter.encode(text.decode(), out_type=str)
                sizes = np.where(ids == self.unknown, [len(w.encode()) for w in words], sizes)
            limit = origin[np.concatenate(([0], np.cumsum(sizes)))]
            final = np.full(1, len(raw))
            out.append((np.append(ids, np.int32(self.end)), np.concatenate((limit[:-1], final)), np.concatenate((limit[1:], final))))
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *rows]), kind, safe=False))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, ids, starts, ends, decoded)`` for each row of ``docs``.

    ``starts`` and ``ends`` are the byte spans of the pieces in the source text;
    ``decoded`` is the text that the ids decode to. ``model`` is a file that all
    workers can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(1), _CALL_BYTES):
                rows = own.encode([data[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)])
                ids, starts, ends = zip(*rows, strict=True)
                decoded = own.decoder.decode([x.tolist() for x in ids], num_threads=1)
                columns = [_lists(ids, pa.int32()), _lists(starts, pa.int64()), _lists(ends, pa.int64()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(at)), *columns], names=["id", "n_bytes", "ids", "starts", "ends", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, ids array<int>, starts array<long>, ends array<long>, decoded string")

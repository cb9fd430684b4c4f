"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash of the bytes cuts each text into chunks, so equal passages give equal chunks wherever they stand. A
chunk is encoded alone, once, and kept; what a cut may have spoilt at its two ends is encoded again together with the
neighbour until the new ids agree with the ones kept. Documents are dealt to tasks by their smallest chunk digest, so
that documents with shared chunks meet in one task and find them there; a very common digest is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import Encoder, default_path, encoder

_MULT = 0x9E3779B1
WINDOW_DOUBLINGS = 4  # 16 bytes


def cuts(data: bytes, bits: int = 8, least: int = 128, most: int = 1 << 14) -> list[int]:
    """Ends of the chunks, the last included. About ``2 ** bits`` bytes each, never inside a character."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h, m = np.frombuffer(data, np.uint8).astype(np.uint32), np.uint32(_MULT)
    for d in range(WINDOW_DOUBLINGS):
        w = 1 << d
        g = h.copy()
        g[w:] += m * h[:-w]
        h, m = g, np.uint32(int(m) * int(m) & 0xFFFFFFFF)
    h *= np.uint32(0x85EBCA6B)
    marks = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    out, last = [], 0

    def whole(at: int) -> int:
        while at < n and data[at] & 0xC0 == 0x80:
            at += 1
        return at

    for mark in [*marks.tolist(), n]:
        while mark - last > most:
            last = whole(last + most)
            out.append(last)
        if mark == n or mark - last >= least:
            at = whole(mark)
            if at > last:
                out.append(at)
                last = at
    return out


class Chunk:
    """Ids of a chunk encoded alone, and the token indexes where cutting is safe: ink before, white space after.

    No pre-token spans ink followed by white space, so the ids between two such places are the same in every text.
    """

    __slots__ = ("data", "ids", "safe", "offset")

    def __init__(self, data: bytes, enc: Encoder):
        self.data, self.ids = data, enc.encode(data.decode("utf-8"))
        ends = np.cumsum(enc.size[self.ids])
        safe = np.flatnonzero(enc.ink_last[self.ids[:-1]] & enc.blank_first[self.ids[1:]]) + 1
        # Joins need a few places at the start and the last one; the rest would only fill memory.
        self.safe = np.append(safe[:8], safe[-1:]) if len(safe) > 9 else safe
        self.offset = ends[self.safe - 1] if len(self.safe) else self.safe


def join_chunks(chunks: list[Chunk], enc: Encoder) -> np.ndarray:
    """Ids of the whole text. Around each join, the text from a safe place on the left to one on the right is encoded
    anew; one more safe stretch goes in on the right, and the window grows until its ids end as the chunk's own."""
    out, pending = [], b""
    for k, c in enumerate(chunks):
        s, o = c.safe, c.offset
        if k == 0 and len(s):
            at = len(s) - 1  # nothing stands before the first chunk
            out.append(c.ids[: s[at]])
            pending = c.data[o[at] :]
            continue
        done = False
        for j in range(1, len(s)):
            window = enc.encode((pending + c.data[: o[j]]).decode("utf-8"))
            known = c.ids[s[j - 1] : s[j]]
            if len(window) >= len(known) and np.array_equal(window[len(window) - len(known) :], known):
                out.append(window)
                out.append(c.ids[s[j] : s[-1]])
                pending, done = c.data[o[-1] :], True
                break
        if not done:
            pending += c.data
    if pending:
        out.append(enc.encode(pending.decode("utf-8")))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class ChunkReuse:
    """Encodes texts, keeping chunks up to ``keep_bytes`` of chunk text; the one not used for longest goes first."""

    def __init__(self, enc: Encoder, keep_bytes: int = 6 << 20):
        self.enc, self.keep, self.held, self.cache = enc, keep_bytes, 0, {}
        self.encoded = self.reused = 0  # bytes of chunks

    def chunk(self, data: bytes) -> Chunk:
        c = self.cache.pop(data, None)
        if c is None:
            c = self.cache[data] = Chunk(data, self.enc)
            self.encoded += len(data)
            self.held += len(data)
            while self.held > self.keep:
                old = next(iter(self.cache))
                self.held -= len(old)
                del self.cache[old]
        else:
            self.cache[data] = c
            self.reused += len(data)
        return c

    def encode(self, text: str) -> np.ndarray:
        data, at, parts = text.encode("utf-8"), 0, []
        for end in cuts(data):
            parts.append(self.chunk(data[at:end]))
            at = end
        return join_chunks(parts, self.enc)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start in range(0, b.num_rows, 500):
            part = b.slice(start, 500)
            anchors = []
            for text in part.column(1):
                data, at, least = (text.as_py() or "").encode("utf-8"), 0, 0
                for end in cuts(data):
                    h = xxhash.xxh64_intdigest(data[at:end]) >> 1
                    least, at = (h if not at else min(least, h)), end
                anchors.append(least)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(anchors, pa.int64())], ["row_id", "text", "anchor"])


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: id and ``ids``, the token ids as little-endian unsigned 32-bit integers in one binary.

    NULL and empty texts have empty ``ids``. Whole texts are encoded, of any length. Repeated rows give repeated
    results; other columns are ignored. A chunk is encoded at most once per task, and documents that share their
    smallest chunk digest share a task; while partitions are even, a chunk common to documents that agree in nothing
    else is met in several tasks.
    """
    path = path or default_path()
    base = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"))
    anchored = base.mapInArrow(_anchored, "row_id long, text string, anchor long")
    dealt = docs.sparkSession.sql("SELECT /*+ REBALANCE(anchor) */ row_id, text, anchor FROM {docs}", docs=anchored)

    def run(batches):
        reuse = ChunkReuse(encoder(path))
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                ids = [reuse.encode(t.as_py() or "").astype("<u4").tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])

    return dealt.mapInArrow(run, f"`{id_col}` long, ids binary")


def bpe_decode(encoded: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """Adds ``decoded``, the text of ``ids`` (special tokens as their strings). NULL ids give an empty text."""
    path = path or default_path()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                texts = [enc.decode(np.frombuffer(i.as_py() or b"", "<u4")) for i in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], [id_col, "ids", "decoded"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` long, ids binary, decoded string")

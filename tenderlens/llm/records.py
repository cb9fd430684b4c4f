"""Token ids in length-delimited binary records, with an offset index apart.

A data file is a row of frames: the length of the content as 8 bytes, the masked CRC-32C of those, the content, its masked
CRC-32C; all numbers little-endian. The content of a document's frame is one byte, the width of an id, and its ids as
unsigned integers of that width: 2 bytes if the vocabulary allows, else 4. Documents are in ascending order of their ids across and within the files. The index is a Parquet table with a row per frame, so a
reader can fetch any documents in any order, or cut a file into ranges.

Files are written by the tasks straight below the archive's folder under names of their own. Only files that the index
names count, and Spark commits the index as a whole: what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import default_path, encoder

#: The reversed polynomial of CRC-32C, and the mask's rotation and offset.
POLYNOMIAL, ROTATE, OFFSET = 0x82F63B78, 15, 0xA282EAD8
HEAD, TAIL = 12, 4
#: Bytes that the checksum takes step by step, and bytes that a reader fetches at once.
STRIDE, FETCH = 256, 8 << 20


@functools.cache
def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


@functools.cache
def _shift(n: int) -> np.ndarray:
    """Checksum states after ``n`` (a power of two) zero bytes: a table per byte of the state before."""
    if n == 1:
        low = _table()
        keep = np.arange(256, dtype=np.uint32)
        return np.stack([low, keep, keep << np.uint32(8), keep << np.uint32(16)])
    half = _shift(n // 2)
    return np.stack([_after(half[k], half) for k in range(4)])


def _after(state: np.ndarray, shift: np.ndarray) -> np.ndarray:
    out = shift[0][state & 0xFF]
    for k in range(1, 4):
        out = out ^ shift[k][state >> np.uint32(8 * k) & np.uint32(0xFF)]
    return out


def crc32c(contents: list[bytes]) -> np.ndarray:
    """CRC-32C of each content. All are taken in step, in strides that are then folded in pairs.

    Zero bytes in front change nothing if the state starts at 0; the usual start is put into the first four bytes.
    """
    out = np.zeros(len(contents), np.uint32)
    parts: dict[int, list[int]] = {}
    for i, c in enumerate(contents):
        parts.setdefault(1 << (max(len(c), 8) - 1).bit_length(), []).append(i)
    table = _table()
    for size, members in parts.items():
        step, stride = max(1, (4 << 20) // size), min(size, STRIDE)
        for lo in range(0, len(members), step):
            own = members[lo : lo + step]
            data = np.zeros((len(own), size), np.uint8)
            for row, i in zip(data, own):
                n = len(contents[i])
                row[size - n :] = np.frombuffer(contents[i], np.uint8)
                row[size - n : size - n + 4] ^= 0xFF
            state = np.zeros(data.size // stride, np.uint32)
            for c in np.ascontiguousarray(data.reshape(-1, stride).T):
                state = table[(state ^ c) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
            state, width = state.reshape(len(own), -1), stride
            while state.shape[1] > 1:
                state, width = _after(state[:, 0::2], _shift(width)) ^ state[:, 1::2], 2 * width
            # of contents below 4 bytes, what is left of the start
            rest = np.array([0xFFFFFFFF >> 8 * min(len(contents[i]), 4) for i in own], np.uint32)
            out[own] = state[:, 0] ^ rest ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(ROTATE)) | (crc << np.uint32(32 - ROTATE))) + np.uint32(OFFSET)


def frames(contents: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(c)) for c in contents]
    marks = masked(crc32c(heads)), masked(crc32c(contents))
    return [b"".join([h, struct.pack("<I", a), c, struct.pack("<I", b)]) for h, a, c, b in zip(heads, marks[0].tolist(), contents, marks[1].tolist())]


def contents(raw: list[bytes], where: str) -> list[bytes]:
    """The contents of whole frames; an error if a length or a checksum is not right."""
    heads, out = [f[:8] for f in raw], [f[HEAD:-TAIL] for f in raw]
    marks = masked(crc32c(heads)), masked(crc32c(out))
    for f, h, a, c, b in zip(raw, heads, marks[0].tolist(), out, marks[1].tolist()):
        if len(f) < HEAD + TAIL or struct.unpack("<QI", f[:HEAD]) != (len(c), a) or struct.unpack("<I", f[-TAIL:])[0] != b:
            raise ValueError(f"{where} has a broken record")
    return out


def serialized(ids: np.ndarray, width: int) -> bytes:
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def ids_of(content: bytes) -> np.ndarray:
    return np.frombuffer(content, f"<u{content[0]}", offset=1).astype("<u4")


def split(data: bytes) -> Iterator[bytes]:
    """The frames of a whole file, without its index."""
    at = 0
    while at < len(data):
        end = at + HEAD + struct.unpack_from("<Q", data, at)[0] + TAIL
        yield data[at:end]
        at = end


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def write_token_records(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, tokenizer: str | None = None, files: int | None = None
) -> None:
    """Encode each row's whole text, append ``end_id``, and write the records and their index below ``path``.

    NULL and empty texts have the end id alone. Rows with a NULL id come first; rows that repeat an id follow one another in
    the order they are read. Other columns are ignored. An empty table gives an empty index. Rows are dealt to ``files``
    ranges of (id, place in the input), as many as shuffle partitions if not given, so that an id on a third of the rows is split, too.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()
    base = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("place"))
    keys = [F.asc_nulls_first("row_id"), F.asc("place")]
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())

    def run(batches):
        enc = encoder(tokenizer)
        store, folder = _store(path)
        name, offset, start, sink = f"{uuid.uuid4().hex}.records", 0, 0, None
        width = 2 if max(len(enc.size) - 1, end_id) < 1 << 16 else 4
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                if sink is None:
                    store.create_dir(f"{folder}/data", recursive=True)
                    sink = store.open_output_stream(f"{folder}/data/{name}")
                raw = frames([serialized(np.append(enc.encode(t.as_py() or ""), end_id), width) for t in part.column(1)])
                sizes = np.array([len(f) for f in raw], np.int64)
                tokens = (sizes - HEAD - TAIL - 1) // width
                for f in raw:
                    sink.write(f)
                ends, starts = offset + np.cumsum(sizes), start + np.cumsum(tokens)
                cols = [part.column(0), part.column(3), pa.array([name] * len(raw)), pa.array(ends - sizes), pa.array(sizes), pa.array(starts - tokens), pa.array(tokens)]
                yield pa.RecordBatch.from_arrays(cols, ["row_id", "part", "file", "offset", "size", "start", "tokens"])
                offset, start = int(ends[-1]), int(starts[-1])
        if sink is not None:
            sink.close()

    index = dealt.mapInArrow(run, "row_id long, part int, file string, offset long, size long, start long, tokens long")
    index.write.option("compression", "zstd").parquet(f"{path}/index")


def read_token_index(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """A row per record: id, ``file``, ``offset``, ``size``, ``start`` (ids of all documents before it), ``tokens``."""
    index = spark.read.schema("row_id long, part int, file string, offset long, size long, start long, tokens long").parquet(f"{path}/index")
    # One row per file; the running sum over them is what the files before hold.
    files = index.groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect()
    before, n = {}, 0
    for r in files:
        before[r["part"]] = n
        n += r["tokens"]
    first = spark.createDataFrame(list(before.items()), "part int, before long")
    return index.join(first, "part").select(F.col("row_id").alias(id_col), "file", "offset", "size", (F.col("start") + F.col("before")).alias("start"), "tokens")


def read_token_records(wanted: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The records that rows of the index name, in the order of ``wanted`` within its partitions: id, ``start``, ``ids``.

    ``ids`` are unsigned 32-bit integers, little-endian, in one binary, whatever their width in the file.
    Neighbours in a file are fetched together. Lengths and checksums are held against the frames; a broken one is an error.
    """

    def run(batches):
        store, folder = _store(path)
        sources: dict[str, object] = {}
        for b in batches:
            names, offsets, sizes = b.column(2).to_pylist(), b.column(3).to_numpy(), b.column(4).to_numpy()
            at = 0
            while at < b.num_rows:
                end, stop = at + 1, offsets[at] + sizes[at]
                while end < b.num_rows and names[end] == names[at] and offsets[end] == stop and stop + sizes[end] - offsets[at] <= FETCH:
                    stop += sizes[end]
                    end += 1
                if names[at] not in sources:
                    if len(sources) >= 16:
                        sources.pop(next(iter(sources))).close()
                    sources[names[at]] = store.open_input_file(f"{folder}/data/{names[at]}")
                data = sources[names[at]].read_at(int(stop - offsets[at]), int(offsets[at]))
                cuts = (offsets[at:end] - offsets[at]).tolist()
                found = contents([data[c : c + s] for c, s in zip(cuts, sizes[at:end].tolist())], names[at])
                found = [ids_of(c).tobytes() for c in found]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), b.column(1).slice(at, end - at), pa.array(found, pa.binary())], [id_col, "start", "ids"])
                at = end
        for s in sources.values():
            s.close()

    return wanted.select(id_col, "start", "file", "offset", "size").mapInArrow(run, f"`{id_col}` long, start long, ids binary")

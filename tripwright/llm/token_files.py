"""Token-id files: an adaptive context-mixing range coder over independent blocks.

A segment is the byte string of one file of token ids, for whole documents in order:

    magic "TWID", version, documents, ids, ids a block, buckets       6 x uint32
    document ids                                                      int64 each
    ids of each document                                              uint32 each
    per block: bytes of its payload, CRC-32 of its ids and payload    uint32, uint32
    CRC-32 of all above                                               uint32
    payloads

Every block starts from a fresh model and a fresh coder and has its own checksum, so it can
be read alone. For each id the model has an order-2 prediction (the id that followed the last
two ids before), an order-1 prediction (that followed the last id) and an order-0
distribution (the id's magnitude by adaptive frequency, then uniform within it). Adaptive
weights, chosen by the confidences of the two predictions, mix the three; the mixture's
interval drives a carry-less range coder with a 64-bit state and 16-bit output words.

Blocks are coded side by side in numpy, one id of every block a step: all arithmetic is on
unsigned or small integers, so files are the same on every machine.

The Spark form keeps segments as rows of a Parquet table (Spark's commit protocol makes the
write safe against lost executors); :func:`write_segment` gives plain files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm import bpe
from tripwright.llm._common import schema, stage, text_or_empty

MAGIC, VERSION = 0x44495754, 1
#: ids of a block, and about how many ids a segment has; a longer document has a segment of its own.
BLOCK_IDS = 2048
SEGMENT_IDS = 1 << 21
BUCKETS = 21  # ids below 2**20 - 1
SLOTS = 512
#: Order-0 frequencies follow their counts every so many ids.
REFRESH = 32
LIMIT = 1024

_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 40)


class _Model:
    """The state of ``lanes`` blocks that advance together."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.row = np.arange(lanes)
        self.at1 = self.row * SLOTS
        self.seen = [np.zeros(lanes * SLOTS, np.int64), np.zeros(lanes * SLOTS, np.int64)]
        # weights of order 2, order 1 and order 0 in ten-bit fields twenty bits apart, by both confidences
        self.weights = np.tile(np.array([self._first(a, b) for a in range(8) for b in range(8)], np.int64), lanes)
        self.counts = np.ones((lanes, BUCKETS), np.int64)
        self.prev1 = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)
        self.steps = 0

    @staticmethod
    def _first(two: int, one: int) -> int:
        a, b = 1 + 24 * two, 1 + 12 * one
        return a | b << 20 | (40 << 40)

    def predict(self) -> tuple[np.ndarray, ...]:
        """Both predicted ids (-1: none) and the weights of orders 2, 1 and 0."""
        if self.steps % REFRESH == 0:
            total = self.counts.sum(axis=1, keepdims=True)
            freq = 1 + self.counts * (LIMIT - BUCKETS) // total
            self.cum = np.zeros((self.lanes, BUCKETS + 1), np.int64)
            np.cumsum(freq, axis=1, out=self.cum[:, 1:])
            self.flat, self.total0 = self.cum.ravel(), self.cum[:, -1].copy()
        self.steps += 1
        h = self.prev1 * 40503
        self.i1 = self.at1 + ((h >> 5) & (SLOTS - 1))
        self.i2 = self.at1 + (((h + self.prev2 * 60493) >> 4) & (SLOTS - 1))
        self.v1, self.v2 = self.seen[0][self.i1], self.seen[1][self.i2]
        self.c1, self.c2 = (self.v1 >> 3) - 1, (self.v2 >> 3) - 1
        self.iw = self.row * 64 + ((self.v2 & 7) * 8 + (self.v1 & 7))
        w = self.weights[self.iw]
        self.w = w
        return self.c2, self.c1, w & 0xFFFFF, (w >> 20) & 0xFFFFF, w >> 40

    def update(self, ids: np.ndarray, by2: np.ndarray, by1: np.ndarray) -> None:
        """Learns ``ids``; by2 and by1 say which were coded by the order-2 or order-1 prediction."""
        w = self.w + np.where(by2, 16, np.where(by1, 16 << 20, 16 << 40))
        full = (w & 0xFFFFF) + ((w >> 20) & 0xFFFFF) + (w >> 40) > LIMIT - 16
        if full.any():
            half = ((w >> 1) & 0x7FFFF7FFFF7FFFF) | (1 | 1 << 20 | 1 << 40)
            w = np.where(full, half, w)
        self.weights[self.iw] = w
        for table, at, v, c in ((self.seen[0], self.i1, self.v1, self.c1), (self.seen[1], self.i2, self.v2, self.c2)):
            sure = v & 7
            hit = c == ids
            keep = np.where(hit, v + (sure < 7), v - sure + (sure >> 1))
            table[at] = np.where(hit | (sure > 1), keep, ((ids + 1) << 3) | 1)
        self.prev2, self.prev1 = self.prev1, ids


def _bucket(ids: np.ndarray) -> np.ndarray:
    """The position of the highest bit of id + 1."""
    return np.frexp((ids + 1).astype(np.float64))[1].astype(np.int64) - 1


def encode_blocks(ids: np.ndarray, block: int = BLOCK_IDS) -> list[bytes]:
    """The payload of each block of ``block`` ids; the last one is filled up with zeros."""
    lanes = -(-len(ids) // block)
    if not lanes:
        return []
    steps = min(block, len(ids))
    grid = np.zeros(lanes * steps if lanes == 1 else lanes * block, np.int64)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, -1).T)
    model = _Model(lanes)
    low, rng = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    room = 4 * len(grid) + 16
    out, at = np.zeros(lanes * room, np.uint16), np.arange(lanes) * room
    begin = at.copy()
    for x in grid:
        c2, c1, w2, w1, w0 = model.predict()
        by2 = x == c2
        by1 = (x == c1) & ~by2
        start = np.where(by2, 0, np.where(by1, w2, w2 + w1)).astype(_U)
        size = np.where(by2, w2, np.where(by1, w1, w0)).astype(_U)
        r = rng // (w2 + w1 + w0).astype(_U)
        low += r * start
        rng = r * size
        rest = np.flatnonzero(~(by2 | by1))
        if len(rest):
            y = x[rest]
            k = _bucket(y)
            i = rest * (BUCKETS + 1) + k
            lo = model.flat[i]
            r = rng[rest] // model.total0[rest].astype(_U)
            below = low[rest] + r * lo.astype(_U)
            r = (r * (model.flat[i + 1] - lo).astype(_U)) >> k.astype(_U)
            low[rest] = below + r * (y + 1 - (1 << k)).astype(_U)
            rng[rest] = r
            model.counts[rest, k] += 1
        model.update(x, by2, by1)
        while True:
            settled = (low ^ (low + rng)) < _TOP
            go = np.flatnonzero(settled | (rng < _BOTTOM))
            if not len(go):
                break
            lo = low[go]
            out[at[go]] = lo >> _U(48)
            at[go] += 1
            rng[go] = np.where(settled[go], rng[go], (_U(0) - lo) & (_BOTTOM - _U(1))) << _U(16)
            low[go] = lo << _U(16)
    for shift in (48, 32, 16, 0):
        out[at] = (low >> _U(shift)) & _U(0xFFFF)
        at += 1
    return [out[a:b].astype("<u2").tobytes() for a, b in zip(begin, at, strict=True)]


def decode_blocks(payloads: list[bytes], count: int, block: int = BLOCK_IDS) -> np.ndarray:
    """The ``count`` ids (uint32) of consecutive blocks."""
    lanes = len(payloads)
    if not lanes:
        return np.empty(0, np.uint32)
    steps = min(block, count)
    sizes = np.array([len(p) // 2 for p in payloads])
    # words past a payload's end are zero; a damaged payload reads them and fails its checksum
    room = int(sizes.max()) + 8
    words = np.zeros((lanes, room), np.uint16)
    for k, p in enumerate(payloads):
        words[k, : sizes[k]] = np.frombuffer(p, "<u2")
    words, last = words.ravel(), np.arange(1, lanes + 1) * room - 1
    model = _Model(lanes)
    at = np.arange(lanes) * room
    low, rng, code = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U), np.zeros(lanes, _U)
    for _ in range(4):
        code = (code << _U(16)) | words[at].astype(_U)
        at += 1
    grid = np.zeros((steps, lanes), np.int64)
    for step in range(steps):
        c2, c1, w2, w1, w0 = model.predict()
        total = w2 + w1 + w0
        r = rng // total.astype(_U)
        v = np.minimum((code - low) // r, (total - 1).astype(_U)).astype(np.int64)
        by2 = v < w2
        by1 = ~by2 & (v < w2 + w1)
        low += r * np.where(by2, 0, np.where(by1, w2, w2 + w1)).astype(_U)
        rng = r * np.where(by2, w2, np.where(by1, w1, w0)).astype(_U)
        x = np.where(by2, c2, c1)
        rest = np.flatnonzero(~(by2 | by1))
        if len(rest):
            total0 = model.total0[rest]
            r = rng[rest] // total0.astype(_U)
            v = np.minimum((code[rest] - low[rest]) // r, (total0 - 1).astype(_U)).astype(np.int64)
            k = (model.cum[rest] <= v[:, None]).sum(axis=1) - 1
            i = rest * (BUCKETS + 1) + k
            lo = model.flat[i]
            below = low[rest] + r * lo.astype(_U)
            r = (r * (model.flat[i + 1] - lo).astype(_U)) >> k.astype(_U)
            off = np.minimum((code[rest] - below) // r, ((1 << k) - 1).astype(_U))
            low[rest] = below + r * off
            rng[rest] = r
            x[rest] = off.astype(np.int64) + (1 << k) - 1
            model.counts[rest, k] += 1
        grid[step] = x
        model.update(x, by2, by1)
        while True:
            settled = (low ^ (low + rng)) < _TOP
            go = np.flatnonzero(settled | (rng < _BOTTOM))
            if not len(go):
                break
            lo = low[go]
            rng[go] = np.where(settled[go], rng[go], (_U(0) - lo) & (_BOTTOM - _U(1))) << _U(16)
            low[go] = lo << _U(16)
            code[go] = (code[go] << _U(16)) | words[np.minimum(at[go], last[go])].astype(_U)
            at[go] += 1
    return grid.T.reshape(-1)[:count].astype(np.uint32)


def pack(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """A segment of documents (``lengths`` ids each) and their ids, one after the other."""
    payloads = encode_blocks(ids, block)
    raw = np.ascontiguousarray(ids, "<u4")
    crcs = [zlib.crc32(p, zlib.crc32(raw[k * block : (k + 1) * block])) for k, p in enumerate(payloads)]
    table = np.array([[len(p), c] for p, c in zip(payloads, crcs, strict=True)], "<u4").reshape(-1, 2)
    head = struct.pack("<6I", MAGIC, VERSION, len(lengths), len(ids), block, BUCKETS)
    head += np.ascontiguousarray(doc_ids, "<i8").tobytes() + np.ascontiguousarray(lengths, "<u4").tobytes() + table.tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(payloads)


def unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a segment; ValueError if any checksum or size is wrong."""
    if len(segment) < 28:
        raise ValueError("too short for a segment")
    magic, version, docs, count, block, buckets = struct.unpack_from("<6I", segment)
    if (magic, version, buckets) != (MAGIC, VERSION, BUCKETS) or not block:
        raise ValueError("not a segment of this version")
    blocks = -(-count // block)
    end = 24 + 12 * docs + 8 * blocks
    if len(segment) < end + 4 or struct.unpack_from("<I", segment, end)[0] != zlib.crc32(segment[:end]):
        raise ValueError("the header's checksum is wrong")
    doc_ids = np.frombuffer(segment, "<i8", docs, 24)
    lengths = np.frombuffer(segment, "<u4", docs, 24 + 8 * docs)
    table = np.frombuffer(segment, "<u4", 2 * blocks, 24 + 12 * docs).reshape(-1, 2)
    at = end + 4 + np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
    if at[-1] != len(segment):
        raise ValueError("the payloads' sizes are wrong")
    payloads = [segment[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    ids = decode_blocks(payloads, count, block)
    for k, crc in enumerate(table[:, 1].tolist()):
        if zlib.crc32(payloads[k], zlib.crc32(np.ascontiguousarray(ids[k * block : (k + 1) * block], "<u4"))) != crc:
            raise ValueError(f"the checksum of block {k} is wrong")
    return doc_ids, lengths, ids


def write_segment(path: str, segment: bytes) -> None:
    with open(path, "wb") as f:
        f.write(segment)


def read_segment(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with open(path, "rb") as f:
        return unpack(f.read())


SEGMENTS = "part int, seq int, n_docs long, n_tokens long, null_ids long, segment binary"


def encode_segments(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Segments of all documents in ascending order of doc_id: ``part``, then ``seq``.

    Each document's ids are those of the tokenizer at ``path`` for its whole text, then
    ``end_id``. Documents are dealt out by ranges of doc_id, so texts are shuffled once.
    Null texts are empty; null ids come first (``null_ids`` says how many); rows that
    repeat an id stay, in order of their texts. An empty table gives no segment.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, seq = bpe.encoder(path), TaskContext.get().partitionId(), 0
        held_docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal seq, size
            lengths = np.array([len(x) for x in held], np.uint32)
            nulls = sum(d is None for d in held_docs)
            segment = pack(np.array([d or 0 for d in held_docs], np.int64), lengths, np.concatenate(held))
            columns = [[part], [seq], [len(held)], [size], [nulls], [segment]]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            held.clear()
            held_docs.clear()
            seq, size = seq + 1, 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t.as_py() for t in batch.column(1)]
            for a, b in bpe.groups(texts):
                for doc, found in zip(ids[a:b], enc.encode_many(texts[a:b]), strict=True):
                    if size and size + len(found) + 1 > SEGMENT_IDS:
                        yield close()
                    held_docs.append(doc)
                    held.append(np.append(found, np.uint32(end_id)))
                    size += len(found) + 1
        if held:
            yield close()

    return ordered.mapInArrow(run, schema(SEGMENTS))


def write_token_files(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """The segments of ``docs``, written to the shared folder; a few rows a file."""
    return stage(encode_segments(docs, path, end_id), "tokens", maxRecordsPerFile=4)


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(segments: DataFrame) -> DataFrame:
    """A row of :data:`READ` for each document, from the segments alone.

    start counts the ids of all documents before it. The offsets of segments come from sums
    by part and windows within a part; no task sees all segments.
    """
    sizes = segments.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", "seq", F.coalesce(within, F.lit(0)).alias("within")).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("within")).alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, nulls, segment in zip(*(batch.column(k) for k in range(4)), strict=True):
                docs, lengths, ids = unpack(segment.as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = np.ascontiguousarray(ids, "<u4")
                crcs = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                names = [None] * nulls.as_py() + docs[nulls.as_py() :].tolist()
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * n, pa.int32()),
                        pa.array([seq.as_py()] * n, pa.int32()),
                        pa.array(names, pa.int64()),
                        pa.array(ends - lengths),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    read = segments.select("part", "seq", "null_ids", "segment").mapInArrow(
        run, schema("part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    )
    return read.join(starts, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

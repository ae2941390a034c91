"""Removal of word sequences that occur earlier, with an exact prefilter.

A window is `WINDOW` consecutive words of one text. An anchor is the smallest hash of a run of neighbouring word groups inside
the window, so equal windows have equal anchors at equal places. Texts are written in batches once, and every step asks the other
batches by hash range:

1. A batch sends its distinct anchors (40 bits, sorted, as differences: some 3 bytes each). A range answers with a bit per
   anchor: whether it occurs again. Windows with an anchor that does not are left out; none that occurs again is lost.
2. A batch sends the first place of each remaining window (96 bits of its words, id, start), in the same form. A range
   answers with a bit per window: whether its content starts earlier.
3. The batch removes what was answered, and what repeats inside itself.

So what is exchanged follows the words and the repeated windows, whatever the size of the corpus, and only bits come back.

Order is by id (null first), then start. Equal windows of one batch are brought down to their first before the
exchange, so a window that a third of all texts hold reaches the answering task once per batch.

Defined cases: a null text has no words; texts shorter than a window stay whole; rows that share an
id are one place in the order, so equal starts in them remove nothing from each other, and each row keeps
its own removals; an empty table gives an empty result. Only id and text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from patronlens.workspace import materialize

WINDOW = 20
GROUP = 10  # words in an anchor's group
RUN = 3  # groups of which an anchor is the smallest
CELLS = 1 << 40  # anchors are told apart by so many numbers
PER_RANGE = 2  # batches' worth of anchors or windows that a range holds

_SALT = 0xD6E8FEB86659FD93
BATCH_BYTES = 8 << 20
_NULL_ID = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of every n neighbours: the sum of base^i times the i-th, modulo 2^64, by doubling."""
    def power(k: int) -> np.uint64:
        return np.uint64(pow(base, k, 1 << 64))

    done, out, span, block = 0, None, 1, words
    while span <= n:
        if n & span:
            if out is None:
                out = block
            else:
                m = len(block) - done
                out = out[:m] + power(done) * block[done:done + m]
            done += span
        if span * 2 <= n:
            m = len(block) - span
            block = block[:m] + power(span) * block[span:]
        span *= 2
    return _mix(out[:len(words) - n + 1])


class Batch:
    """Words of several texts in a row, with their hashes and the windows that lie inside one text."""

    def __init__(self, texts: list[str | bytes | None]):
        hashed = [self._hashes(t) for t in texts]
        self.sizes = np.array([len(h) for h in hashed], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(hashed) if hashed else np.array([], np.uint64)
        n = len(self.words)
        self.text_of = np.repeat(np.arange(len(hashed)), self.sizes)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(n)  # words to the text's end
        self.windows = (left >= WINDOW)[: max(0, n - WINDOW + 1)]
        groups = _rolling(self.words, GROUP, 0x9E3779B97F4A7C15) if n >= WINDOW else np.array([], np.uint64)
        self.groups = groups
        runs = max(0, len(groups) - RUN + 1)
        least = groups[:runs]
        for shift in range(1, RUN):
            least = np.minimum(least, groups[shift:shift + runs])
        self.least = least
        self.inner_runs = WINDOW - GROUP - RUN + 2

    @staticmethod
    def _hashes(text: str | bytes | None) -> np.ndarray:
        words = (text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")).split()
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))

    def anchors(self) -> np.ndarray:
        """Hashes at the places that are the smallest of a run inside some window, once per place."""
        if not len(self.least):
            return self.least
        in_window = np.zeros(len(self.least), bool)
        for shift in range(self.inner_runs):
            part = in_window[shift:shift + len(self.windows)]
            part |= self.windows[: len(part)]
        chosen = np.zeros(len(self.groups), bool)
        for shift in range(RUN):
            part = self.groups[shift:shift + len(self.least)]
            chosen[shift:shift + len(self.least)] |= in_window & (part == self.least)
        return self.groups[chosen]

    def repeated(self, cells: np.ndarray, often: np.ndarray, size: int) -> np.ndarray:
        """Starts of windows whose anchors are all among those of the sorted `cells` that occur `often`."""
        if not self.windows.any():
            return np.array([], np.int64)
        asked = cells_of(self.least, size)
        at = np.minimum(np.searchsorted(cells, asked), len(cells) - 1)
        again = often[at] & (cells[at] == asked)
        keep = self.windows.copy()
        for shift in range(self.inner_runs):
            keep &= again[shift:shift + len(keep)]
        return np.flatnonzero(keep)


def cells_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The number of every hash among `size` (a power of two)."""
    return _mix(hashes ^ np.uint64(_SALT)) & np.uint64(size - 1)


def _batches(tables: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the record batches of a few MB of text, at least one text each."""
    for table in tables:
        lengths = pc.fill_null(pc.binary_length(table.column("text")), 0).to_pylist()
        start, held = 0, 0
        for at, length in enumerate(lengths):
            held += length
            if held >= most or at == len(lengths) - 1:
                part = table.slice(start, at + 1 - start)
                yield part, part.column("text").to_pylist()
                start, held = at + 1, 0


def _packed(columns: list[tuple[np.ndarray, int]]) -> bytes:
    """Columns of whole numbers, each with the bytes it takes, byte place by byte place and compressed."""
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes() for c, width in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(data: bytes, widths: list[int]) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(sum(widths), -1)
    out, at = [], 0
    for width in widths:
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, :width] = planes[at:at + width].T
        out.append(wide.view("<u8").ravel())
        at += width
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, the first from 0."""
    return np.diff(x, prepend=np.uint64(0))


def _width(size: int) -> int:
    return -(-(size - 1).bit_length() // 8)


def batched(keyed: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """`keyed` (id, key, text) in written batches of a few MB of text: batch, ids, keys, lengths and packed texts."""
    key = keyed.schema["key"].dataType
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("keys", pa.list_(to_arrow_type(key))), ("lengths", pa.binary()), ("packed", pa.binary())])

    def pack(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part, texts in _batches(tables, batch_bytes):
            plain = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            n = pa.array([0, len(plain)], pa.int32())
            lists = [pa.ListArray.from_arrays(n, part.column(c)).cast(schema.field(f).type) for c, f in (("id", "ids"), ("key", "keys"))]
            lengths = np.array([len(p) for p in plain], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([*lists, pa.array([lengths]), pa.array([packer.compress(b"".join(plain))])], schema=schema)

    rows = keyed.select("id", "key", "text").mapInArrow(pack, f"ids array<long>, keys array<{key.simpleString()}>, lengths binary, packed binary")
    return materialize(rows.withColumn("batch", F.monotonically_increasing_id()), "batches")


def _texts(row: dict) -> list[bytes]:
    whole, ends = zstandard.ZstdDecompressor().decompress(row["packed"]), np.cumsum(np.frombuffer(row["lengths"], np.int64)).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def _each(tables: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the tables, one at a time."""
    for table in tables:
        for i in range(table.num_rows):
            yield table.slice(i, 1).to_pylist()[0]


_ASKED = "range int, batch long, asked binary"
_TOLD = "range int, batch long, told binary"


def _asked(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    schema = pa.schema([("range", pa.int32()), ("batch", pa.int64()), ("asked", pa.binary())])
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))) if rows else {n: [] for n in schema.names}, schema=schema)


def _told(asked: DataFrame, ranges: int, answer: Callable[[list[bytes]], list[np.ndarray]]) -> DataFrame:
    """Per batch the answers of all ranges, `told` (range, bits); `answer` gives one flag per number that a batch asked for."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("range", pa.int32()), ("batch", pa.int64()), ("told", pa.binary())])

        def done() -> pa.RecordBatch:
            bits = [np.packbits(flags).tobytes() for flags in answer([d for _, d in held])]
            return pa.RecordBatch.from_arrays([pa.array([now] * len(held), pa.int32()), pa.array([b for b, _ in held]), pa.array(bits, pa.binary())], schema=schema)

        now, held = None, []
        for row in _each(tables):
            if row["range"] != now and held:
                yield done()
                held = []
            now = row["range"]
            held.append((row["batch"], row["asked"]))
        if held:
            yield done()

    told = asked.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, _TOLD)
    return told.groupBy("batch").agg(F.collect_list(F.struct("range", "told")).alias("told"))


def _flags(told: list[dict] | None, sizes: np.ndarray) -> np.ndarray:
    """The answers of all ranges, one after the other; `sizes` says how much each was asked."""
    said = {t["range"]: t["told"] for t in told or []}
    parts = [np.unpackbits(np.frombuffer(said[r], np.uint8), count=n) for r, n in enumerate(sizes.tolist()) if n]
    return np.concatenate(parts).astype(bool) if parts else np.array([], bool)


def _cut(numbers: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Ends of the ranges among ascending numbers of so many bits."""
    high = numbers >> np.uint64(max(0, bits - 32))
    return np.searchsorted(high * np.uint64(ranges) >> np.uint64(min(bits, 32)), np.arange(ranges), "right")


class Cells(NamedTuple):
    """The distinct anchors of a batch, which of them it holds twice, and the ends of the ranges among them."""

    cells: np.ndarray
    twice: np.ndarray
    ends: np.ndarray


def _cells(batch: Batch, size: int, ranges: int) -> Cells:
    cells, counts = np.unique(cells_of(batch.anchors(), size), return_counts=True)
    return Cells(cells, counts > 1, _cut(cells, size.bit_length() - 1, ranges))


def repeated_anchors(batches: DataFrame, ranges: int, size: int = CELLS) -> DataFrame:
    """Per batch a bit for each of its anchors: whether it occurs again."""
    width = _width(size)

    def send(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(tables):
            found = _cells(Batch(_texts(row)), size, ranges)
            rows = []
            for r, (a, b) in enumerate(zip(np.append(0, found.ends), found.ends)):
                if b > a:
                    rows.append((r, row["batch"], _packed([(_steps(found.cells[a:b]), width), (found.twice[a:b], 1)])))
            yield _asked(rows)

    def answer(asked: list[bytes]) -> list[np.ndarray]:
        parts = [_unpacked(a, [width, 1]) for a in asked]
        cells = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in parts])
        order = np.argsort(cells, kind="stable")
        ordered = cells[order]
        equal = ordered[1:] == ordered[:-1]
        again = np.empty(len(cells), bool)
        again[order] = np.r_[False, equal] | np.r_[equal, False]
        again |= np.concatenate([twice for _, twice in parts]) > 0
        return np.split(again, np.cumsum([len(steps) for steps, _ in parts])[:-1])

    return materialize(_told(batches.select("batch", "lengths", "packed").mapInArrow(send, _ASKED), ranges, answer), "anchors")


class Windows(NamedTuple):
    """Windows of a batch that may be repeated, by content, id and start, and which of them are the first place of a content."""

    at: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    heads: np.ndarray
    ends: np.ndarray


def _windows(batch: Batch, ids: np.ndarray, told: list[dict] | None, size: int, ranges: int) -> Windows:
    found = _cells(batch, size, ranges)
    at = batch.repeated(found.cells, _flags(told, np.diff(found.ends, prepend=0)), size)
    if len(at):
        h1 = _rolling(batch.words, WINDOW, 0xC2B2AE3D27D4EB4F)[at]
        h2 = _rolling(_mix(batch.words), WINDOW, 0x165667B19E3779F9)[at] >> np.uint64(32)
    else:
        h1 = h2 = np.array([], np.uint64)
    text = batch.text_of[at]
    ids, starts = ids[text], at - batch.starts[text]
    order = np.lexsort((starts, ids, h2, h1))
    at, h1, h2, ids, starts = at[order], h1[order], h2[order], ids[order], starts[order]
    first = np.ones(len(at), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    heads = np.flatnonzero(first)
    return Windows(at, h1, h2, ids, starts, heads, _cut(h1[heads], 64, ranges))


_WIDTHS = [8, 4, 8, 4]


def earlier_windows(batches: DataFrame, anchors: DataFrame, ranges: int, size: int = CELLS) -> DataFrame:
    """Per batch a bit for each content of its windows that may be repeated: whether it starts earlier elsewhere."""

    def send(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(tables):
            found = _windows(Batch(_texts(row)), np.array(row["ids"], np.int64), row["told"], size, ranges)
            h1, h2, ids, starts = (c[found.heads] for c in (found.h1, found.h2, found.ids.view(np.uint64), found.starts))
            rows = []
            for r, (a, b) in enumerate(zip(np.append(0, found.ends), found.ends)):
                if b > a:
                    columns = _steps(h1[a:b]), h2[a:b], ids[a:b], starts[a:b]
                    rows.append((r, row["batch"], _packed(list(zip(columns, _WIDTHS)))))
            yield _asked(rows)

    def answer(asked: list[bytes]) -> list[np.ndarray]:
        parts = [_unpacked(a, _WIDTHS) for a in asked]
        h1 = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        h2, ids, starts = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        ids = ids.view(np.int64)
        order = np.lexsort((starts, ids, h2, h1))
        h1, h2, ids, starts = h1[order], h2[order], ids[order], starts[order]
        heads = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        first = np.repeat(heads, np.diff(np.append(heads, len(h1))))
        later = np.empty(len(h1), bool)
        later[order] = (ids != ids[first]) | (starts != starts[first])
        return np.split(later, np.cumsum([len(p[0]) for p in parts])[:-1])

    asked = batches.select("batch", "ids", "lengths", "packed").join(anchors, "batch", "left").mapInArrow(send, _ASKED)
    return materialize(_told(asked, ranges, answer), "windows")


KEPT = "n_words long, n_removed long, kept string"


def _remove(text: bytes, starts) -> tuple[int, int, bytes]:
    words = text.split()
    if starts is None or not len(starts):
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.asarray(starts, np.int64))
    edge[at] += 1
    np.subtract.at(edge, at + WINDOW, 1)
    gone = np.cumsum(edge[:-1]) > 0
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), int(gone.sum()), b" ".join(kept)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False, cells: int = CELLS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """One row per document: key, n_words, n_removed and kept, the text without the words of earlier windows (or its SHA-256)."""
    keyed = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(key).alias("key"), F.col(text).alias("text"))
    batches = batched(keyed, batch_bytes)
    ranges = max(1, -(-batches.count() // PER_RANGE))
    anchors = repeated_anchors(batches, ranges, cells)
    windows = earlier_windows(batches, anchors, ranges, cells)
    kind = keyed.schema["key"].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for i in range(table.num_rows):
                row = table.select(["ids", "lengths", "packed", "told", "later"]).slice(i, 1).to_pylist()[0]
                texts = _texts(row)
                batch = Batch(texts)
                found = _windows(batch, np.array(row["ids"], np.int64), row["told"], cells, ranges)
                head = np.repeat(found.heads, np.diff(np.append(found.heads, len(found.at))))
                later = np.repeat(_flags(row["later"], np.diff(found.ends, prepend=0)), np.diff(np.append(found.heads, len(found.at))))
                # What comes after the batch's first place goes in any case; what shares that place goes with it.
                later |= (found.ids != found.ids[head]) | (found.starts != found.starts[head])
                gone = np.sort(found.at[later])
                limits = np.searchsorted(gone, np.append(batch.starts, len(batch.words)))
                rows = [_remove(t, gone[a:b] - s) for t, s, a, b in zip(texts, batch.starts, limits, limits[1:])]
                kept = [hashlib.sha256(k).hexdigest() if digest else k.decode("utf-8", "surrogatepass") for _, _, k in rows]
                keys = table.column("keys").slice(i, 1).flatten()
                columns = [keys, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    joined = batches.join(anchors, "batch", "left").join(windows.select("batch", F.col("told").alias("later")), "batch", "left")
    done = joined.drop("batch").mapInArrow(cut, f"key {kind.simpleString()}, {KEPT}")
    return done.withColumnRenamed("key", key)

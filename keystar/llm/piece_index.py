"""SentencePiece encoding and decoding with a suffix array of the batch.

The distinct chunks of a batch are concatenated and indexed by a suffix array (sorted by as
many characters as the longest piece has). Every piece of the vocabulary is binary-searched
for its range of occurrences; the occurrences are edges over the text, sorted by position.
Relaxing joins neighbouring symbols along the edge of the best score until none is left, which
is what a merge-ranked vocabulary prescribes. Characters without a piece fall back to bytes.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar.llm.common import slices, texts, worker_store
from keystar.llm.word_bpe import Remembered

MARK = "▁"
#: Characters indexed at once, unless a single chunk is longer.
INDEX_CHARS = 150_000
#: Longer chunks are relaxed one by one with a heap instead of side by side.
SHORT = 64
NO_SCORE = -np.inf

# A piece has its marks in front only, so no merge crosses the start of a run of marks.
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """A merge-ranked vocabulary as arrays of code points."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        plain = [
            i for i in range(n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {
            bytes([int(self.text[i][3:5], 16)]): i for i in range(n) if model.is_byte(i)
        }
        shown = list(self.text)
        for byte, i in self.bytes.items():
            shown[i] = byte.decode("ascii", "surrogateescape")
        raw = [x.encode("utf-8", "surrogateescape") for x in shown]
        #: What each piece stands for, as bytes.
        self.taken = pa.array(raw, pa.large_binary())
        self.unknown = model.unk_id()
        self.score = np.array([model.get_score(i) for i in range(n)], dtype=np.float64)
        self.ids = np.array(plain, dtype=np.int64)
        self.sizes = np.array([len(self.text[i]) for i in plain], dtype=np.int64)
        self.longest = int(self.sizes.max())
        self.codes = np.zeros((len(plain), self.longest), dtype=np.int64)
        for row, i in enumerate(plain):
            self.codes[row, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        self.known = Remembered(lambda new: _learn_all(self, new))

    @staticmethod
    def of(path: str) -> Pieces:
        store = worker_store("pieces")
        if path not in store:
            store[path] = Pieces(path)
        return store[path]

    def fallback(self, character: str) -> list[int]:
        found = [self.bytes.get(bytes([b])) for b in character.encode()]
        return [self.unknown] if None in found else found


def packed_keys(codes: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """The first characters at every position as one number, and how many these are."""
    width = 63 // bits
    ahead = np.concatenate([codes, np.zeros(width, dtype=np.int64)])
    keys = np.zeros(len(codes), dtype=np.int64)
    for i in range(width):
        keys = (keys << bits) | ahead[i : i + len(codes)]
    return keys, width


def suffix_array(codes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` characters, by prefix doubling.

    Codes are positive and below ``1 << bits``; the first step packs as many as fit a number.
    """
    n = len(codes)
    key, known = packed_keys(codes, bits)
    while True:
        order = np.argsort(key)
        if known >= depth:
            return order
        changed = np.concatenate([[1], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(changed)
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - known)] = rank[known:]
        key = rank * (n + 2) + after
        known *= 2


def occurrences(
    codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, sizes: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """For every piece the range of the suffix array whose suffixes start with it.

    ``pieces`` has a row of codes per piece, with -1 for a character the text has not.
    """
    keys, width = packed_keys(codes, bits)
    keys = keys[order]
    low = np.zeros(len(pieces), dtype=np.int64)
    high = np.zeros(len(pieces), dtype=np.int64)
    within = np.arange(pieces.shape[1])[None, :] < sizes[:, None]
    there = ~((pieces < 0) & within).any(axis=1)
    short = np.flatnonzero(there & (sizes <= width))
    if len(short):
        first = np.zeros(len(short), dtype=np.int64)
        last = np.zeros(len(short), dtype=np.int64)
        for i in range(width):
            used = i < sizes[short]
            code = pieces[short, i] if i < pieces.shape[1] else np.zeros(len(short), np.int64)
            first = (first << bits) | np.where(used, code, 0)
            last = (last << bits) | np.where(used, code, (1 << bits) - 1)
        low[short] = np.searchsorted(keys, first, "left")
        high[short] = np.searchsorted(keys, last, "right")
    long = np.flatnonzero(there & (sizes > width))
    if len(long):
        low[long], high[long] = (
            _search(codes, order, pieces[long], within[long], upper) for upper in (False, True)
        )
    return low, high


def _search(
    codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, within: np.ndarray, upper: bool
) -> np.ndarray:
    """Binary searches side by side: where suffixes starting with each piece begin or end."""
    width = pieces.shape[1]
    text = np.concatenate([codes, np.zeros(width, dtype=np.int64)])
    rows = np.arange(len(pieces))
    low = np.zeros(len(pieces), dtype=np.int64)
    high = np.full(len(pieces), len(order), dtype=np.int64)
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        start = order[np.minimum(middle, len(order) - 1)]
        seen = text[start[:, None] + np.arange(width)]
        differs = (seen != pieces) & within
        at = differs.argmax(axis=1)
        below = np.where(differs[rows, at], seen[rows, at] < pieces[rows, at], upper)
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


class Lattice:
    """Edges of a text, sorted by position: the piece of each (position, length)."""

    def __init__(self, text: str, pieces: Pieces) -> None:
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        letters, codes = np.unique(points, return_inverse=True)
        codes = codes.astype(np.int64) + 1
        bits = len(letters).bit_length()
        at = np.minimum(np.searchsorted(letters, pieces.codes), len(letters) - 1)
        known = np.where(letters[at] == pieces.codes, at + 1, -1)
        order = suffix_array(codes, pieces.longest, bits)
        low, high = occurrences(codes, order, known, pieces.sizes, bits)
        counts = high - low
        piece = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = order[np.repeat(low, counts) + within]
        by_position = np.argsort(start)
        start, piece = start[by_position], piece[by_position]
        self.width = pieces.longest + 1
        self.table = np.full(len(codes) * self.width, -1, dtype=np.int32)
        self.table[start * self.width + pieces.sizes[piece]] = pieces.ids[piece]
        self.scores = pieces.score

    def piece(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ids of the edges, -1 where there is none."""
        fits = size < self.width
        return np.where(fits, self.table[start * self.width + np.where(fits, size, 0)], -1)

    def relax(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (start, size) of chunks after all joins, chunk after chunk.

        In each round every chunk that can joins the pair with the best score, the leftmost of
        equals, and chunks that cannot are done.
        """
        sizes = ends - starts
        start = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start += np.repeat(starts, sizes)
        size = np.ones(len(start), dtype=np.int64)
        owner = np.repeat(np.arange(len(starts)), sizes)
        done: list[tuple[np.ndarray, ...]] = []
        while len(start):
            joined = np.full(len(start), NO_SCORE)
            pair = owner[1:] == owner[:-1]
            ids = self.piece(start[:-1], size[:-1] + size[1:])
            good = pair & (ids >= 0)
            joined[:-1][good] = self.scores[ids[good]]
            heads = np.flatnonzero(np.concatenate([[True], ~pair]))
            counts = np.diff(np.append(heads, len(start)))
            best = np.maximum.reduceat(joined, heads)
            busy = np.repeat(best > NO_SCORE, counts)
            done.append((start[~busy], size[~busy]))
            if not busy.any():
                break
            first = np.flatnonzero(busy & (joined == np.repeat(best, counts)))
            chosen = first[np.concatenate([[True], owner[first[1:]] != owner[first[:-1]]])]
            size[chosen] += size[chosen + 1]
            busy[chosen + 1] = False
            start, size, owner = start[busy], size[busy], owner[busy]
        if not done:
            return start, size
        found = [np.concatenate(x) for x in zip(*done, strict=True)]
        order = np.argsort(found[0], kind="stable")
        return found[0][order], found[1][order]

    def relax_long(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one chunk, with a heap of joins."""
        n = end - start
        size, before, after = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []
        table, width, scores = self.table, self.width, self.scores

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                total = size[left] + size[right]
                found = int(table[(start + left) * width + total]) if total < width else -1
                if found >= 0:
                    heapq.heappush(heap, (-scores[found], left, size[left], size[right]))

        for left in range(n - 1):
            offer(left)
        while heap:
            _, left, own, other = heapq.heappop(heap)
            right = after[left]
            if size[left] != own or right >= n or size[right] != other:
                continue
            size[left], size[right] = own + other, 0
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        kept = [x for x in range(n) if size[x]]
        return np.array(kept) + start, np.array([size[x] for x in kept])


def _learn(pieces: Pieces, new: list[str]) -> list[bytes]:
    """Ids of new chunks, indexed together."""
    text = "\0".join(new)
    lattice = Lattice(text, pieces)
    sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    short = sizes <= SHORT
    parts = [lattice.relax(starts[short], ends[short])]
    parts += [lattice.relax_long(a, b) for a, b in zip(starts[~short], ends[~short], strict=True)]
    start, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(start, kind="stable")
    start, size = start[order].astype(np.int64), size[order].astype(np.int64)
    ids = lattice.piece(start, size).astype("<i4")
    cuts = np.append(np.searchsorted(start, starts), len(start))
    lone = np.concatenate([[0], np.cumsum(ids < 0)])
    odd = np.flatnonzero(lone[cuts[1:]] > lone[cuts[:-1]]).tolist()
    raw, cuts = ids.tobytes(), cuts.tolist()
    found = [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
    for number in odd:
        own = slice(cuts[number], cuts[number + 1])
        found[number] = _with_bytes(pieces, ids[own], text, start[own]).tobytes()
    return found


def _learn_all(pieces: Pieces, new: list[str]) -> Iterator[bytes]:
    """The same in indexes of bounded size."""
    part: list[str] = []
    size = 0
    for chunk in new:
        if part and size + len(chunk) > INDEX_CHARS:
            yield from _learn(pieces, part)
            part, size = [], 0
        part.append(chunk)
        size += len(chunk) + 1
    if part:
        yield from _learn(pieces, part)


def _with_bytes(pieces: Pieces, ids: np.ndarray, text: str, start: np.ndarray) -> np.ndarray:
    found: list[int] = []
    for piece, at in zip(ids.tolist(), start.tolist(), strict=True):
        found.extend([piece] if piece >= 0 else pieces.fallback(text[at]))
    return np.array(found, dtype="<i4")


def encode_batch(pieces: Pieces, batch: list[str]) -> list[np.ndarray]:
    """Ids of each text: a mark in front, spaces as marks, whole chunks looked up or learned."""
    split = [_CHUNK.findall(MARK + x.replace(" ", MARK)) if x else [] for x in batch]
    pieces.known.prepare(split)
    return [np.frombuffer(pieces.known.joined(x), dtype="<i4") for x in split]


def decode_lists(pieces: Pieces, ids: pa.ListArray) -> list[str | None]:
    """The texts of lists of ids, null where there is none.

    The pieces are put end to end as bytes, byte pieces as the byte they stand for, and read as
    UTF-8; marks become spaces and the first one goes.
    """
    offsets = ids.offsets.to_numpy()
    flat = ids.values.slice(offsets[0], offsets[-1] - offsets[0])
    taken = pieces.taken.take(flat)
    ends = np.frombuffer(taken.buffers()[1], dtype="<i8", count=len(taken) + 1)
    raw = memoryview(taken.buffers()[2] or b"")
    cuts = ends[offsets - offsets[0]].tolist()
    found = []
    for start, end, valid in zip(cuts, cuts[1:], ids.is_valid().to_pylist(), strict=False):
        text = str(raw[start:end], "utf-8", "replace")
        found.append(text.replace(MARK, " ").removeprefix(" ") if valid else None)
    return found


def decode_ids(pieces: Pieces, ids: list[int]) -> str:
    """The text of one list of ids."""
    return decode_lists(pieces, pa.array([ids], pa.list_(pa.int32())))[0]


def encode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, ids, ids_crc32) and the ``carried`` columns, one row per input row, from the
    whole text.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit numbers. Null and empty texts
    have no ids; null and repeated doc_ids are kept; an empty table gives no rows. Rows are
    read on their own, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in slices(batches, 200):
            found = encode_batch(pieces, texts(batch.column(1)))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, dtype="<i4")]).astype(np.int32)
            crc = [zlib.crc32(x.astype("<i4").tobytes()) for x in found]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(crc, pa.int64()), *batch.columns[2:]],
                names=["doc_id", "ids", "ids_crc32", *carried],
            )

    own = F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")
    rows = docs.select(*own, *carried)
    made = T.StructType().add("doc_id", "long").add("ids", T.ArrayType(T.IntegerType()))
    made = made.add("ids_crc32", "long")
    for name in carried:
        made = made.add(rows.schema[name])
    return rows.mapInArrow(run, made)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encoded`` and the ``text`` of its ``ids``; null ids give none."""

    names = [name for name in encoded.columns if name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in slices(batches, 200):
            found = pa.array(decode_lists(pieces, batch.column("ids")), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "text"])

    rows = encoded.select(*names)
    made = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, made)

"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents are cut at the sequence length; what is shorter is dealt over shards of bounded
size. Several islands evolve packings of each shard: crossover injects whole well-filled bins
of one parent into the other, drops bins that hold a document twice and puts the displaced
documents back by best fit. After each epoch the best packing of an island also goes to the
next one. Bins that stay poorly filled are dissolved and packed once more across shards.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystar.llm.common import slices, texts
from keystar.llm.word_bpe import ChunkEncoder
from keystar.session import stash

LENGTH = 2048
END_ID = 0
SHARD_ITEMS = 8192
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 3
#: A bin this full is injected whole by crossover, and not dissolved between levels.
WELL_FILLED = 0.99
LEVELS = 2

Bins = list[list[int]]

PIECES_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of every whole text and its end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(path)
        end = END_ID.to_bytes(4, "little")
        for batch in slices(batches, 500):
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode(texts(batch.column(1))), strict=True):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), 4 * length)):
                    part = tokens[at : at + 4 * length]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)


class Packer:
    """Packings of items with given lengths into bins of one capacity."""

    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.random = random.Random(seed)

    def fill(self, members: list[int]) -> int:
        return sum(self.lengths[x] for x in members)

    def best_fit(self, bins: Bins, items: list[int]) -> Bins:
        """Each item into the fullest bin that has room, or a new one."""
        room: dict[int, list[int]] = {}
        free = 0  # bit r is set if some bin has room for r more
        for number, members in enumerate(bins):
            left = self.capacity - self.fill(members)
            room.setdefault(left, []).append(number)
            free |= 1 << left
        for item in items:
            size = self.lengths[item]
            fitting = free >> size
            if fitting:
                left = size + (fitting & -fitting).bit_length() - 1
                number = room[left].pop()
                if not room[left]:
                    free &= ~(1 << left)
                bins[number].append(item)
            else:
                left, number = self.capacity, len(bins)
                bins.append([item])
            left -= size
            room.setdefault(left, []).append(number)
            free |= 1 << left
        return bins

    def first(self) -> Bins:
        """Best fit of the items in order of decreasing length."""
        return self.best_fit([], self.by_length(range(len(self.lengths))))

    def by_length(self, items: Iterator[int] | list[int] | range) -> list[int]:
        return sorted(items, key=lambda x: (-self.lengths[x], x))

    def shuffled(self) -> Bins:
        """Best fit of roughly decreasing lengths."""
        jitter = {x: n * self.random.uniform(0.8, 1.25) for x, n in enumerate(self.lengths)}
        return self.best_fit([], sorted(jitter, key=jitter.__getitem__, reverse=True))

    def cost(self, bins: Bins) -> tuple[int, float]:
        """Fewer bins first, then unevenly filled ones: room is best left in one place."""
        return len(bins), -sum((self.fill(b) / self.capacity) ** 2 for b in bins)

    def cross(self, mother: Bins, father: Bins) -> Bins:
        """The mother with a share of the father's well-filled bins injected whole."""
        least = self.capacity * WELL_FILLED
        full = [b for b in father if self.fill(b) >= least]
        injected = [b for b in full if self.random.random() < 0.5]
        taken = {x for b in injected for x in b}
        kept, displaced = [], []
        for members in mother:
            if taken.isdisjoint(members):
                kept.append(list(members))
            else:
                displaced.extend(x for x in members if x not in taken)
        return self.best_fit([*map(list, injected), *kept], self.by_length(displaced))

    def mutate(self, bins: Bins) -> Bins:
        """The emptiest bins and some others are emptied and their items put back."""
        order = sorted(bins, key=self.fill)
        emptied = order[: max(2, len(order) // 50)]
        gone = {id(b) for b in emptied}
        extra = [b for b in order if id(b) not in gone and self.random.random() < 0.02]
        gone |= {id(b) for b in extra}
        loose = [x for b in (*emptied, *extra) for x in b]
        self.random.shuffle(loose)
        return self.best_fit([list(b) for b in bins if id(b) not in gone], self.by_length(loose))

    def evolve(self, parents: list[Bins]) -> Bins:
        """The best packing after some generations; never worse than a parent."""
        lower = -(-sum(self.lengths) // self.capacity)
        population = sorted(parents, key=self.cost)
        for _ in range(GENERATIONS):
            if len(population[0]) <= lower:
                break
            children = []
            for _ in range(POPULATION):
                mother, father = self.random.choices(population, k=2)
                children.append(self.mutate(self.cross(mother, father)))
            population = sorted([*population, *children], key=self.cost)[:POPULATION]
        return population[0]


def _numbered(bins: Bins, n: int) -> np.ndarray:
    number = np.zeros(n, dtype=np.int64)
    for at, members in enumerate(bins):
        number[members] = at
    return number


def _members(numbers: np.ndarray) -> Bins:
    order = np.argsort(numbers, kind="stable")
    cuts = np.flatnonzero(np.diff(numbers[order])) + 1
    return [x.tolist() for x in np.split(order, cuts)] if len(order) else []


PACKED = "shard long, island int, row long, length long, bin long"


def _epoch(names: tuple, frame: pd.DataFrame, capacity: int, first: bool) -> pd.DataFrame:
    """One island of one shard. Rows of ``guest`` hold the neighbour's best packing."""
    shard, island = (int(x) for x in names)
    home = frame[~frame["guest"]].sort_values("row")
    lengths = home["length"].tolist()
    packer = Packer(lengths, capacity, seed=shard * 1009 + island * 31 + (0 if first else 7))
    parents = [_members(home["bin"].to_numpy())]
    if first:
        parents += [packer.first(), *(packer.shuffled() for _ in range(POPULATION - 1))]
    else:
        guest = frame[frame["guest"]].sort_values("row")
        parents += [_members(guest["bin"].to_numpy())]
    number = _numbered(packer.evolve(parents), len(lengths))
    return pd.DataFrame(
        {"shard": shard, "island": island, "row": home["row"], "length": lengths, "bin": number}
    )


def pack_shards(items: DataFrame, capacity: int) -> DataFrame:
    """Bins of items (shard, row, length, bin): the best of each shard's islands.

    ``bin`` on input is some valid packing; the result never has more bins than that.
    """

    def run(first: bool):
        return lambda names, frame: _epoch(names, frame, capacity, first)

    islands = F.explode(F.array(*(F.lit(i) for i in range(ISLANDS))))
    state = items.select("shard", islands.alias("island"), "row", "length", "bin")
    for epoch in range(EPOCHS):
        own = state.withColumn("guest", F.lit(False))
        if epoch:
            moved = ((F.col("island") + 1) % ISLANDS).cast("int")
            own = own.unionByName(
                state.withColumn("island", moved).withColumn("guest", F.lit(True))
            )
        state = stash(
            own.groupBy("shard", "island").applyInPandas(run(epoch == 0), PACKED), "islands"
        )
    sizes = state.groupBy("shard", "island").agg((F.max("bin") + 1).alias("bins"))
    fewest = F.min_by("island", F.struct("bins", "island")).alias("island")
    best = sizes.groupBy("shard").agg(fewest)
    return state.join(best, ["shard", "island"]).select("shard", "row", "length", "bin")


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Null and blank texts are a piece of one token, the end id. Repeated rows are packed each;
    rows without an id keep a null id. Sequence ids are any distinct numbers, offsets in a
    sequence have no gaps. An empty table gives no rows.
    """
    numbered = tokenized(docs, path, key, text, length).withColumn(
        "row", F.monotonically_increasing_id()
    )
    pieces = stash(numbered, "pieces")
    whole = pieces.where(F.col("length") == length).select(
        *PIECES_COLUMNS, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    items = pieces.where(F.col("length") < length).select("row", "length")
    items = items.withColumn("bin", F.col("row"))
    done: list[DataFrame] = []
    for level in range(LEVELS):
        shards = max(1, -(-items.count() // SHARD_ITEMS))
        place = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(shards)).alias("shard")
        packed = stash(pack_shards(items.select(place, "row", "length", "bin"), length), "packed")
        # The bins of this level, by a number no other level uses.
        packed = packed.select(
            "row",
            "length",
            ((F.col("shard") * LEVELS + level) * (1 << 24) + F.col("bin")).alias("bin"),
        )
        filled = packed.groupBy("bin").agg((F.sum("length") >= length * WELL_FILLED).alias("full"))
        split = stash(packed.join(filled, "bin"), "filled")
        final = split if level == LEVELS - 1 else split.where("full")
        done.append(final.select("row", "bin"))
        items = split.where("NOT full").select("row", "length", "bin")
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)

    # A sequence has at most ``length`` pieces.
    before = Window.partitionBy("bin").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.join(bins, "row").select(
        *PIECES_COLUMNS,
        (-F.col("bin") - 1).alias("sequence_id"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )
    return whole.unionByName(placed)

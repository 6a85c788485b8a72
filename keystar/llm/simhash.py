"""SimHash near-dedup: 64-bit fingerprints linked through BK-trees.

Two fingerprints within four bits agree wholly on at least two of six bit ranges, so every
link lies in one of fifteen shards named by two ranges and their bits. Each shard is a
BK-tree: children are keyed by their Hamming distance to the parent and a search follows only
the edges within the radius. The trees hold what grows with the input, so they stay where
their shard was shuffled to and the fingerprints come to them, instead of one broadcast of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.llm.common import encoded, slices
from keystar.llm.components import connected_components
from keystar.session import stash

WORDS = 4
SEED = 42
RADIUS = 4
#: Bit ranges (offset, width) of a fingerprint; RADIUS + 2 of them, so that two always agree.
RANGES = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Fingerprints in one tree; a shard with more is cut into trees that are searched pairwise.
TREE_ROWS = 200_000
#: Shingle hashes held at once while a long text is read.
HASHES = 100_000


def simhash(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Bits set in over half of the shingle hashes; shingles count as often as they occur.

    A-Z are lower-cased, words are split at ASCII white space. Fewer words than a shingle
    count as one shingle, no words give zero.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(words, len(parts))
    first, last = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), HASHES):
        spans = zip(first[at : at + HASHES], last[at : at + HASHES], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(first), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *carried: str
) -> DataFrame:
    """(doc_id, fp): the SimHash of every row's whole text, as a signed long; ``carried`` too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([simhash(x) for x in encoded(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *carried],
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *carried
    )
    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried]
    return rows.mapInArrow(run, ", ".join(["doc_id long", "fp long", *fields]))


class BkTree:
    """A BK-tree with components: members within the radius of each other are united."""

    def __init__(self, radius: int = RADIUS) -> None:
        self.radius = radius
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []  # of the union-find
        self.whole: list[int] = []  # a member of the only component below a node, -1 if mixed

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def _one_component(self, node: int) -> int:
        """The root of the only component in the subtree, or -1."""
        if self.whole[node] < 0:
            return -1
        return self.find(self.whole[node])

    def _refresh(self, node: int) -> None:
        root = self.find(node)
        if all(self._one_component(c) == root for c in self.children[node].values()):
            self.whole[node] = node

    def reached(self, value: int, own: int = -1) -> Iterator[int]:
        """Members within the radius, at least one of each component that has any.

        ``own`` is united with what is found; subtrees that lie wholly in its component, or
        in one already reported, are not entered.
        """
        seen: set[int] = set()
        stack = [0] if self.value else []
        while stack:
            node = stack.pop()
            root = self._one_component(node)
            if root >= 0 and (root == self.find(own) if own >= 0 else root in seen):
                continue
            distance = (value ^ self.value[node]).bit_count()
            if distance <= self.radius:
                here = self.find(node)
                if own >= 0:
                    if here != self.find(own):
                        self.parent[self.find(own)] = here
                        yield node
                elif here not in seen:
                    seen.add(here)
                    yield node
            low, high = distance - self.radius, distance + self.radius
            stack.extend(c for d, c in self.children[node].items() if low <= d <= high)
            if self.whole[node] < 0:
                self._refresh(node)

    def add(self, value: int) -> list[int]:
        """Insert a new value; the members that joined its component, one of each."""
        own = len(self.value)
        self.parent.append(own)
        links = list(self.reached(value, own))
        node = 0
        while own:
            if self.whole[node] >= 0 and self.find(self.whole[node]) != self.find(own):
                self.whole[node] = -1
            distance = (value ^ self.value[node]).bit_count()
            below = self.children[node].get(distance)
            if below is None:
                self.children[node][distance] = own
                break
            node = below
        self.value.append(value)
        self.children.append({})
        self.whole.append(own)
        return links


def _shard_keys(fp: Column) -> Column:
    """The fifteen shards of a fingerprint: pair number, then the bits of both ranges."""
    part = [F.shiftrightunsigned(fp, at).bitwiseAND((1 << width) - 1) for at, width in RANGES]
    pairs = combinations(range(len(RANGES)), 2)
    return F.array(
        *(
            F.lit(n << 22).bitwiseOR(F.shiftleft(part[i], 11)).bitwiseOR(part[j]).cast("int")
            for n, (i, j) in enumerate(pairs)
        )
    )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows (shard, tree, probe, fp, rep) sorted by these: one tree at a time."""
    current, tree, reps = None, BkTree(), []
    for batch in batches:
        shard, number, probe, fp, rep = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        fp = fp.view(np.uint64)
        n = len(shard)
        new = np.ones(n, dtype=bool)
        new[1:] = (shard[1:] != shard[:-1]) | (number[1:] != number[:-1])
        starts = np.append(np.flatnonzero(new), n)
        sizes = np.diff(starts)
        a: list[int] = []
        b: list[int] = []
        # A shard with a single fingerprint has no link; the first and the last may go on.
        busy = np.flatnonzero(sizes > 1).tolist()
        for run in sorted({0, *busy, len(sizes) - 1} if n else ()):
            start, end = int(starts[run]), int(starts[run + 1])
            name = (int(shard[start]), int(number[start]))
            if name != current:
                current, tree, reps = name, BkTree(), []
            columns = (probe[start:end].tolist(), fp[start:end].tolist(), rep[start:end].tolist())
            for searching, value, own in zip(*columns, strict=True):
                hits = list(tree.reached(value)) if searching else tree.add(value)
                a.extend([own] * len(hits))
                b.extend(reps[x] for x in hits)
                if not searching:
                    reps.append(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )


def hamming_links(distinct: DataFrame, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Edges (a, b) between the ``rep`` of distinct fingerprints ``fp, rep``.

    Enough links to connect every pair within the radius, at most one per fingerprint, shard
    and tree: never all pairs of a group. A shard over ``tree_rows`` is cut into several trees
    by a hash; each is searched by the members of the trees before it.
    """
    keyed = distinct.select(F.explode(_shard_keys(F.col("fp"))).alias("shard"), "fp", "rep")
    large = (
        keyed.groupBy("shard")
        .agg(F.ceil(F.count("*") / tree_rows).cast("int").alias("trees"))
        .where("trees > 1")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    placed = (
        keyed.join(large, "shard", "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("tree", F.explode(F.sequence("own", F.coalesce("trees", F.lit(1)) - 1)))
        .select("shard", "tree", (F.col("tree") != F.col("own")).alias("probe"), "fp", "rep")
    )
    sorted_shards = placed.repartition("shard", "tree").sortWithinPartitions(
        "shard", "tree", "probe", "fp"
    )
    return sorted_shards.mapInArrow(_linked, "a long, b long")


def _components(fps: DataFrame, tree_rows: int) -> DataFrame:
    """(fp, component) of the distinct fingerprints; a component is named by its least one.

    A fingerprint stands in the graph as itself: an id can stand on rows with unlike texts.
    """
    distinct = stash(fps.select("fp").distinct(), "distinct")
    links = hamming_links(distinct.select("fp", F.col("fp").alias("rep")), tree_rows)
    labels = connected_components(links).withColumnRenamed("node", "fp")
    return distinct.join(labels, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tree_rows: int = TREE_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``component_id`` is the smallest doc_id that can be reached over links of at most four
    differing bits, the row itself included. Null and blank texts have fingerprint zero and
    are linked like any other. Repeated rows and equal texts share a fingerprint and with it
    a component; rows that share only their id do not. Rows without an id keep a null id; they
    link what lies around them, and a component without any id has a null ``component_id``. An
    empty table gives no rows.
    """
    fps = stash(fingerprints(docs, key, text), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labelled = stash(_components(fps, tree_rows).join(least, "fp"), "labelled")
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = labelled.join(smallest, "component").select("fp", "component_id")
    return fps.join(groups, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def near_survivors(docs: DataFrame, digest: str, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(doc_id, digest) of the row that stays of each component: the least of these pairs.

    Rows (doc_id, text, digest) all have an id, which need not be theirs alone.
    """
    fps = stash(fingerprints(docs, "doc_id", "text", digest), "fingerprints")
    first = fps.groupBy("fp").agg(F.min(F.struct("doc_id", digest)).alias("first"))
    labelled = _components(fps, tree_rows).join(first, "fp")
    return labelled.groupBy("component").agg(F.min("first").alias("first")).select("first.*")

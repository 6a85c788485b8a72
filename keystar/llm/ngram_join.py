"""Jaccard self-join of n-gram sets by vertical partitioning.

All n-grams have one global order: by how often the corpus has their slot, then by hash. Sets
that are alike share an n-gram among the first few of both, so these prefixes alone are moved to
find who has to be compared. The order is cut into fragments; the overlap of a pair is counted
in each fragment separately and summed per pair, so that no task holds a whole long document.

Documents with equal sets are one class. Classes that share a prefix n-gram are first compared
with one hub per n-gram and size; what is connected then is not compared again. Pairs that still
lie in different components are found by what sets have more or less than a hub: what a group has
in common falls out, and sets that are alike share a rare n-gram of these differences. Groups of
near copies, linked or not, therefore cost about as many comparisons as they have members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystar.llm.common import join_sized
from keystar.llm.components import connected_components
from keystar.llm.ngrams import byte_slices, ngram_sets
from keystar.session import stash

WORDS = 4
#: Two sets are linked if 100 x intersection >= PERCENT x union.
PERCENT = 85
#: Slots whose frequencies order the n-grams; also bounds what is sent to every task.
SLOT_BITS = 20
SLOT_CHUNKS = 64
FRAGMENTS = 16
#: Slots that say whose texts are read again.
TEXT_BITS = 23
#: No n-gram's rows stay in one place if they are more than 1 in PARTS of all.
PARTS = 4096
#: Rounds of hubs, for groups of over HUB_MEMBERS, before the rest is compared pair by pair.
HUB_ROUNDS = 2
HUB_MEMBERS = 64
#: Hubs of a group in one round.
HUBS = 4
#: Members of one group that one task compares with all others of the group.
SALT_ROWS = 500
#: Sets a task remembers so that copies are not sent again.
SEEN = 200_000


def _least_overlap(n: Column) -> Column:
    """Common n-grams a set of n needs with any set."""
    return F.ceil(n * PERCENT / 100).cast("int")


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _digests(rows: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and 128-bit digests (two longs) of the rows of a batch."""
    bounds = np.searchsorted(rows, np.arange(n + 1))
    raw = b"".join(
        xxhash.xxh128_digest(grams[a:b].tobytes())
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    )
    return np.diff(bounds), np.frombuffer(raw, dtype="<i8").reshape(n, 2)


def set_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, d1, d2): size and digest of the n-gram set of every row's ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, 2):
            rows, grams = ngram_sets(batch.column(2), WORDS)
            sizes, digests = _digests(rows, grams, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, (sizes, *digests.T))],
                names=["doc_id", "key", "n", "d1", "d2"],
            )

    return docs.select("doc_id", "key", "text").mapInArrow(
        run, "doc_id long, key long, n long, d1 long, d2 long"
    )


def slot_counts(docs: DataFrame) -> np.ndarray:
    """How many n-grams of all documents fall into each slot.

    Each task adds up a whole table and hands it on in chunks; chunks are added as they come.
    """
    chunk = (1 << SLOT_BITS) // SLOT_CHUNKS
    schema = "chunk int, counts binary"

    def handed(tables: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(tables), pa.int32()),
                pa.array([t.tobytes() for t in tables.values()], pa.binary()),
            ],
            names=["chunk", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in byte_slices(batches, 0):
            _, grams = ngram_sets(batch.column(0), WORDS)
            table += np.bincount(_slot(grams), minlength=1 << SLOT_BITS)
        if table.any():
            yield handed({c: table[c * chunk : (c + 1) * chunk] for c in range(SLOT_CHUNKS)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                tables[c] = tables.get(c, 0) + np.frombuffer(raw, dtype=np.int64)
        yield handed(tables)

    partial = docs.select("text").mapInArrow(count, schema)
    total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for row in partial.repartition(SLOT_CHUNKS, "chunk").mapInArrow(add, schema).collect():
        total[row.chunk * chunk : (row.chunk + 1) * chunk] = np.frombuffer(row.counts, np.int64)
    return total


def global_order(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every slot, rare ones first, and its fragment, all of about equal weight."""
    order = np.argsort(counts, kind="stable")
    place = np.empty(len(counts), dtype=np.int32)
    place[order] = np.arange(len(counts), dtype=np.int32)
    before = np.cumsum(counts[order]) - counts[order]
    weight = max(1, int(counts.sum()))
    fragment = np.empty(len(counts), dtype=np.uint8)
    fragment[order] = before * FRAGMENTS // weight
    return place, np.minimum(fragment, FRAGMENTS - 1)


def slot_parts(counts: np.ndarray) -> np.ndarray:
    """Into how many parts each slot is dealt; none then has more than 1 in ``PARTS`` of all."""
    share = max(1.0, counts.sum() / PARTS)
    return np.maximum(1, np.ceil(counts / share)).astype(np.int32)


def prefix_rows(docs: DataFrame, place: np.ndarray, parts: np.ndarray) -> DataFrame:
    """(gram, part, n, d1, d2): the first n-grams of every set in the global order.

    So many that two linked sets share one: n - ceil(n x PERCENT / 100) + 1. Rows whose slot has
    several ``parts`` are dealt to them by their set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in byte_slices(batches, 0):
            rows, grams = ngram_sets(batch.column(0), WORDS)
            sizes, digests = _digests(rows, grams, batch.num_rows)
            if len(seen) > SEEN:
                seen.clear()
            new = np.zeros(batch.num_rows, dtype=bool)
            for i, name in enumerate(map(bytes, digests)):
                if sizes[i] and name not in seen:
                    seen.add(name)
                    new[i] = True
            wanted = np.where(new, sizes - -(-sizes * PERCENT // 100) + 1, 0)
            first = np.cumsum(sizes) - sizes
            # The order within a set: of sets that are sent, one after the other.
            keys = (place[_slot(grams)].astype(np.uint64) << np.uint64(64 - SLOT_BITS)) | (
                grams >> np.uint64(SLOT_BITS)
            )
            found = [
                first[i] + np.argsort(keys[first[i] : first[i] + sizes[i]], kind="stable")[: wanted[i]]
                for i in np.flatnonzero(new)
            ]
            at = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            names = digests[rows[at]]
            part = names[:, 0].view(np.uint64) % parts[_slot(grams[at])].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams[at].view(np.int64)),
                    pa.array(part.astype(np.int32)),
                    pa.array(sizes[rows[at]].astype(np.int32)),
                    *(pa.array(d) for d in names.T),
                ],
                names=["gram", "part", "n", "d1", "d2"],
            )

    return docs.select("text").mapInArrow(run, "gram long, part int, n int, d1 long, d2 long")


SHARED = ("gram", "n", "d1", "d2", "m", "e1", "e2")


def _met(rows: np.ndarray, parts: np.ndarray, long_run: int | None) -> pa.RecordBatch:
    """Whole runs (gram, n, d1, d2) as pairs, or as members where a run is long or dealt out."""
    new = np.ones(rows.shape[1], dtype=bool)
    new[1:] = rows[0, 1:] != rows[0, :-1]
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, rows.shape[1]))
    grams = rows[0, starts]
    whole = (lengths > HUB_MEMBERS) | (parts[_slot(grams.view(np.uint64))] > 1)
    if long_run is not None:
        whole |= grams == long_run
    members = rows[:, np.repeat(whole, lengths)]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for z in np.unique(lengths[~whole & (lengths > 1)]).tolist():
        i, j = np.triu_indices(z, 1)
        at = starts[~whole & (lengths == z)][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    i, j = np.concatenate(left), np.concatenate(right)
    # Runs are sorted by size.
    fits = 100 * rows[1, i] >= PERCENT * rows[1, j]
    i, j = i[fits], j[fits]
    no_pair, no_gram = np.ones(members.shape[1], dtype=bool), np.ones(len(i), dtype=bool)

    def column(of_members: np.ndarray, of_pairs: np.ndarray, absent: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([of_members, of_pairs]), pa.int64(), mask=absent)

    here, there = np.zeros(len(no_pair), dtype=bool), np.zeros(len(no_gram), dtype=bool)
    only_members, only_pairs = np.concatenate([here, no_gram]), np.concatenate([no_pair, there])
    both = np.concatenate([here, there])
    return pa.RecordBatch.from_arrays(
        [
            column(members[0], rows[0, i], only_members),
            *(column(members[k], rows[k, i], both) for k in (1, 2, 3)),
            *(column(members[k], rows[k, j], only_pairs) for k in (1, 2, 3)),
        ],
        names=list(SHARED),
    )


def shared_prefixes(prefixes: DataFrame, parts: np.ndarray) -> DataFrame:
    """Who shares prefix n-grams, as rows (gram, n, d1, d2, m, e1, e2) of two kinds.

    One shuffle: rows are sorted by n-gram and size where they arrive. Of an n-gram in at most
    ``HUB_MEMBERS`` sets come the pairs whose sizes fit, without ``gram``; the sets of any other
    one, and of those dealt to several parts, come as members, without ``m, e1, e2``. A task
    holds no more than a run of ``HUB_MEMBERS`` and a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), dtype=np.int64)
        long_run = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 2, 3, 4)])
            rows = np.concatenate([held, rows], axis=1)
            again = (rows[:, 1:] == rows[:, :-1]).all(axis=0)
            rows = rows[:, np.append(True, ~again)]
            last = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
            if rows.shape[1] - last > HUB_MEMBERS:
                # The last row stays, so that its repeats in the next batch are seen.
                long_run, last = int(rows[0, -1]), rows.shape[1] - 1
            yield _met(rows[:, :last], parts, long_run)
            held = rows[:, last:]
        yield _met(held, parts, long_run)

    placed = prefixes.repartition("gram", "part").sortWithinPartitions("gram", "n", "d1", "d2")
    return placed.mapInArrow(run, ", ".join(f"{c} long" for c in SHARED))


def segments(texts: DataFrame, place: np.ndarray, fragment: np.ndarray) -> DataFrame:
    """(cls, frag, grams): the sets of rows (cls, text), cut along the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, 1):
            rows, grams = ngram_sets(batch.column(1), WORDS)
            part = fragment[_slot(grams)]
            order = np.lexsort((part, rows))
            rows, grams, part = rows[order], grams[order], part[order]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]) | (part[1:] != part[:-1])
            starts = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(starts, len(rows)), pa.int32()), pa.array(grams.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[starts])),
                    pa.array(part[starts].astype(np.int32)),
                    lists,
                ],
                names=["cls", "frag", "grams"],
            )

    return texts.select("cls", "text").mapInArrow(run, "cls long, frag int, grams array<long>")


def _bucket(n: Column) -> Column:
    """Size classes so wide that linked sets lie in the same or in adjacent ones."""
    return F.floor(F.log(n.cast("double")) / -math.log((PERCENT - 1) / 100)).cast("int")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _members(shared: DataFrame) -> DataFrame:
    """(gram, bucket, guest, cls, n): every class in its own size bucket and, as a guest, the next."""
    return shared.select(
        "gram",
        F.explode(F.array(F.lit(False), F.lit(True))).alias("guest"),
        "cls",
        "n",
        _bucket(F.col("n")).alias("own"),
    ).select("gram", (F.col("own") + F.col("guest").cast("int")).alias("bucket"), "guest", "cls", "n")


def _undecided(
    members: DataFrame, labels: DataFrame | None, round_: int
) -> tuple[DataFrame, DataFrame]:
    """Groups with at least two components, with hubs of their own, and all named members.

    In the rounds of hubs only groups with many members; each round chooses other hubs.
    """
    if labels is None:
        named = members.withColumn("comp", F.col("cls"))
    else:
        named = members.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        named = stash(named, "named")
    by = F.xxhash64("cls", F.lit(round_)) if round_ else F.col("cls")
    lot = F.pmod(F.xxhash64("cls", F.lit(round_)), F.lit(HUBS))

    def hub(k: int) -> Column:
        return F.min(F.when(~F.col("guest") & (lot == k), F.struct(by.alias("by"), "cls", "n", "comp")))

    groups = named.groupBy("gram", "bucket").agg(
        F.count("*").alias("members"),
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
        F.array_compact(F.array(*(hub(k) for k in range(HUBS)))).alias("hubs"),
    )
    least = HUB_MEMBERS if round_ < HUB_ROUNDS else 1
    open_ = groups.where(f"low < high AND size(hubs) > 0 AND members > {least}")
    return stash(open_.drop("low", "high"), "groups"), named


def _pairs(found: DataFrame, *carried: str) -> DataFrame:
    """(a, b, na, nb) with a < b of rows (x, nx, y, ny)."""
    up = F.col("x") < F.col("y")
    return found.select(
        F.least("x", "y").alias("a"),
        F.greatest("x", "y").alias("b"),
        F.when(up, F.col("nx")).otherwise(F.col("ny")).alias("na"),
        F.when(up, F.col("ny")).otherwise(F.col("nx")).alias("nb"),
        *carried,
    )


def hub_pairs(groups: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs of a group's hubs with every member of another component whose size fits."""
    met = join_sized(named, groups, ["gram", "bucket"], "members")
    met = met.withColumn("hub", F.explode("hubs"))
    other = F.col("comp") != F.col("hub.comp")
    return _pairs(
        met.where(other & _sizes_fit(F.col("n"), F.col("hub.n"))).select(
            F.col("cls").alias("x"),
            F.col("n").alias("nx"),
            F.col("hub.cls").alias("y"),
            F.col("hub.n").alias("ny"),
        )
    ).distinct()


def _reach(n: Column) -> Column:
    """N-grams of a set after its prefix."""
    return _least_overlap(n) - 1


def _needed(na: Column, nb: Column) -> Column:
    """Common n-grams that make two sets of these sizes linked."""
    return F.ceil((na + nb) * PERCENT / (100 + PERCENT))


def deltas(groups: DataFrame, named: DataFrame, cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What members of the groups have more or less than a hub of their group.

    (cls, n, comp, hub, nh, d, near): ``d`` n-grams differ, ``near`` says the two are linked; and
    (cls, hub, grams), the n-grams that differ, in parts. A group's hub is the member of the most
    groups, so that the groups of one family of copies have the same.
    """
    sized = groups.select("gram", "bucket", "members")
    met = stash(join_sized(named, sized, ["gram", "bucket"], "members"), "met")
    seen = met.groupBy("cls").agg(F.count("*").alias("seen"))
    by = F.struct("seen", (-F.col("cls")).alias("by"), "cls", "n").alias("hub")
    hubs = met.join(seen, "cls").groupBy("gram", "bucket").agg(F.max(by).alias("hub"))
    hubs = stash(hubs.join(sized, ["gram", "bucket"]), "hubs")
    sides = join_sized(met.drop("members"), hubs, ["gram", "bucket"], "members")
    sides = sides.select("cls", "n", "comp", F.col("hub.cls").alias("hub"), F.col("hub.n").alias("nh"))
    sides = stash(sides.distinct(), "sides")

    every = F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("frag")
    own = cut.select("cls", "frag", F.col("grams").alias("own"))
    of_hub = cut.select(F.col("cls").alias("hub"), "frag", F.col("grams").alias("of_hub"))
    both = (
        sides.select("cls", "hub", every)
        .join(own, ["cls", "frag"], "left")
        .join(of_hub, ["hub", "frag"], "left")
    )
    none = F.array().cast("array<long>")
    mine, theirs = F.coalesce("own", none), F.coalesce("of_hub", none)
    differ = F.concat(F.array_except(mine, theirs), F.array_except(theirs, mine))
    parts = stash(both.select("cls", "hub", differ.alias("grams")).where("size(grams) > 0"), "differ")

    sizes = parts.groupBy("cls", "hub").agg(F.sum(F.size("grams")).alias("d"))
    sides = sides.join(sizes, ["cls", "hub"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
    near = (100 + PERCENT) * F.col("d") <= (100 - PERCENT) * (F.col("n") + F.col("nh"))
    return stash(sides.withColumn("near", near), "sides"), parts


def _delta_prefix() -> tuple[Column, Column]:
    """Of a delta, the n-grams that one shares with a shorter delta, and with a longer one.

    Linked sets differ in at most k n-grams, so that deltas of x and y have (x + y - k) / 2 in
    common. Of two sets that are near the hub nothing is asked: the hub links them.
    """
    n, nh, d = F.col("n"), F.col("nh"), F.col("d")
    most = F.floor((100 - PERCENT) * n / PERCENT)
    # The other one is not near, so it has the more to make up for.
    made_up = F.floor(((100 + PERCENT) * d + (100 - PERCENT) * (nh - n)) / (2 * (100 + PERCENT)))
    whole = F.when(F.col("near"), F.least(d, d - made_up)).otherwise(d)
    return F.least(whole, most + 1), F.least(whole, F.floor(most / 2) + 1)


def open_pairs(sides: DataFrame, parts: DataFrame) -> DataFrame:
    """All pairs (a, b, na, nb) of members in different components that may be linked.

    What a family of copies has in common is not in its deltas. They are ordered by how many
    have an n-gram, so what only one has comes first and meets nobody; linked sets share one of
    the n-grams that are left when those that they must have in common are counted from the end.
    An n-gram with many members is spread: each part of it meets all of them elsewhere.
    """
    of = parts.select("cls", "hub", F.explode("grams").alias("gram"))
    times = of.groupBy("hub", "gram").agg(F.count("*").alias("times")).where("times > 1")
    to_shorter, to_longer = _delta_prefix()
    wide = sides.withColumns({"to_shorter": to_shorter, "to_longer": to_longer})
    one = Window.partitionBy("cls", "hub")
    shared = F.row_number().over(one.orderBy("times", "gram")) - F.count("*").over(one)
    placed = (
        of.join(times, ["hub", "gram"])
        .withColumn("shared", shared)
        .join(wide, ["cls", "hub"])
        .withColumn("at", F.col("d") + F.col("shared"))
        .where("at <= to_shorter")
        .withColumn("salts", F.ceil(F.col("times") / SALT_ROWS))
    )
    placed = stash(placed, "placed")

    def side(name: str) -> list[Column]:
        own = ("cls", "n", "comp", "d", "near", "at")
        return [F.col(c).alias(f"{name}_{c}") for c in own]

    left = placed.where("at <= to_longer").select(
        "hub", "gram", F.pmod(F.xxhash64("cls"), "salts").alias("salt"), *side("x")
    )
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    right = placed.select("hub", "gram", salts, *side("y"))
    x_d, y_d = F.col("x_d"), F.col("y_d")
    differ = F.floor((100 - PERCENT) * (F.col("x_n") + F.col("y_n")) / (100 + PERCENT))
    needed = F.ceil((x_d + y_d - differ) / 2)
    met = left.join(right, ["hub", "gram", "salt"]).where(
        (F.col("x_comp") != F.col("y_comp"))
        & ((x_d < y_d) | ((x_d == y_d) & (F.col("x_cls") < F.col("y_cls"))))
        & ~(F.col("x_near") & F.col("y_near"))
        & (y_d - x_d <= differ)
        & _sizes_fit(F.col("x_n"), F.col("y_n"))
        & (F.col("x_at") + needed <= x_d + 1)
        & (F.col("y_at") + needed <= y_d + 1)
    )
    found = met.select(
        F.col("x_cls").alias("x"),
        F.col("x_n").alias("nx"),
        F.col("y_cls").alias("y"),
        F.col("y_n").alias("ny"),
    )
    return _pairs(found).distinct()


def few_pairs(few: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) of ``few`` (x, nx, y, ny, common) that may be linked.

    Their prefix n-grams in common, those that many sets have among them, and what the rest of
    the sets could add bound the overlap.
    """
    many = members.where("NOT guest").groupBy("cls").agg(F.collect_list("gram").alias("many"))
    many = stash(many, "many")
    of_x = many.select(F.col("cls").alias("x"), F.col("many").alias("many_x"))
    of_y = many.select(F.col("cls").alias("y"), F.col("many").alias("many_y"))
    both = F.isnotnull("many_x") & F.isnotnull("many_y")
    also = F.when(both, F.size(F.array_intersect("many_x", "many_y"))).otherwise(0)
    times = few.join(of_x, "x", "left").join(of_y, "y", "left").select(
        "x",
        "nx",
        "y",
        "ny",
        (F.col("common") + also).alias("common"),
    )
    na, nb = F.col("na"), F.col("nb")
    # The smaller set cannot add more than it has after its prefix where that ends first.
    most = F.col("common") + F.greatest(_reach(na), _reach(nb))
    return _pairs(times, "common").where(most >= _needed(na, nb)).drop("common")


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs whose ends are in different components."""
    if labels is None:
        return pairs
    for end in ("a", "b"):
        of = labels.select(F.col("cls").alias(end), F.col("comp").alias(f"comp_{end}"))
        pairs = pairs.join(of, end, "left")
    comps = [F.coalesce(f"comp_{end}", end) for end in ("a", "b")]
    return pairs.where(comps[0] != comps[1]).select("a", "b", "na", "nb")


def _named_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, nx, y, ny, common): pairs of digests by their classes, with how often they met."""
    times = pairs.groupBy("n", "d1", "d2", "m", "e1", "e2").agg(F.count("*").alias("common"))
    left = sets.select("d1", "d2", F.col("cls").alias("x"))
    right = sets.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("cls").alias("y"))
    return times.join(left, ["d1", "d2"]).join(right, ["e1", "e2"]).select(
        "x", F.col("n").alias("nx"), "y", F.col("m").alias("ny"), "common"
    )


def class_texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text) of the wanted classes, from the row that stands for the class.

    A bit per slot says which rows may stand for one, so that the other texts are not moved.
    """
    reps = stash(classes.join(wanted, "cls", "left_semi").select("cls", "rep.*"), "reps")
    slot = F.shiftrightunsigned(F.xxhash64("doc_id", "key"), 64 - TEXT_BITS).alias("slot")
    bits = np.zeros(1 << (TEXT_BITS - 3), dtype=np.uint8)
    at = (F.col("slot") + 1).alias("at")
    filled = (
        reps.select(slot)
        .select(at)
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    for row in filled.collect():
        part = np.frombuffer(row.bits, dtype=np.uint8)
        bits[(row.bucket - 1) * len(part) : row.bucket * len(part)] = part

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(3).to_numpy()
            found = (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(found.astype(bool))).select([0, 1, 2])

    may = docs.select("doc_id", "key", "text", slot).mapInArrow(
        keep, "doc_id long, key long, text string"
    )
    same = may.key.eqNullSafe(reps.key) & may.doc_id.eqNullSafe(reps.doc_id)
    return may.join(reps, same).select("cls", "text").dropDuplicates(["cls"])


def linked(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: overlaps per fragment, summed per pair."""
    first = cut.select(F.col("cls").alias("a"), "frag", F.col("grams").alias("left"))
    second = cut.select(F.col("cls").alias("b"), "frag", F.col("grams").alias("right"))
    overlaps = (
        pairs.join(first, "a")
        .join(second, ["b", "frag"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("left", "right")).alias("part"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("part").alias("common"))
    )
    either = F.col("na") + F.col("nb") - F.col("common")
    return overlaps.where(100 * F.col("common") >= PERCENT * either).select("a", "b")


def _labels(links: DataFrame) -> DataFrame:
    return stash(
        connected_components(links).select(
            F.col("node").alias("cls"), F.col("component").alias("comp")
        ),
        "comps",
    )


def _class_components(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(cls, comp) of the classes that are linked with another one; None without any link."""
    counts = slot_counts(docs)
    place, fragment = global_order(counts)
    parts = slot_parts(counts)
    shared = stash(shared_prefixes(prefix_rows(docs, place, parts), parts), "shared")
    sets = classes.select("d1", "d2", "cls", "n")
    large = shared.where("gram IS NOT NULL").select("gram", "d1", "d2")
    members = stash(_members(large.join(sets, ["d1", "d2"])), "members")
    few = _named_pairs(shared.where("gram IS NULL"), sets)
    few = stash(few_pairs(few, members), "few")
    ends = few.select(F.explode(F.array("a", "b")).alias("cls"))
    wanted = ends.unionByName(members.select("cls")).distinct()
    cut = stash(segments(class_texts(docs, classes, wanted), place, fragment), "segments")

    links, labels = None, None

    def add(new: DataFrame) -> None:
        nonlocal links, labels
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            labels = _labels(links)

    for round_ in range(HUB_ROUNDS):
        groups, named = _undecided(members, labels, round_)
        if not groups.isEmpty():
            pairs = stash(hub_pairs(groups, named), "pairs")
            add(stash(linked(pairs, cut), "links"))
    groups, named = _undecided(members, labels, HUB_ROUNDS)
    pairs = _apart(few, labels)
    if groups.isEmpty():
        add(stash(linked(stash(pairs, "pairs"), cut), "links"))
    else:
        sides, parts = deltas(groups, named, cut)
        pairs = stash(pairs.unionByName(open_pairs(sides, parts)).distinct(), "pairs")
        ends = [F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")]
        to_hub = sides.where("near AND cls <> hub").select(*ends)
        add(stash(linked(pairs, cut).unionByName(to_hub), "links"))
    return labels


def ngram_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    A set holds the distinct shingles of four words, A-Z in lower case, words cut at ASCII white
    space; a text of fewer words has one shingle, all its words. Null, empty and blank texts
    have no shingles and are linked with nothing, not even with each other: their component is
    their own id. Rows with equal sets are linked; repeated rows and rows that share an id are
    rows of their own. Rows without an id link what lies around them; a component without any
    id has a null ``component_id``. An empty table gives no rows. Other columns are not read.

    Shingles are compared by 64-bit hashes, sets by 128-bit digests. Slots that many shingles
    share only make the order, and with it the candidates, less sharp; the result is the same.
    """
    docs = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("key"),
        F.col(text).alias("text"),
    )
    rows = stash(set_rows(docs), "sets")
    classes = stash(
        rows.where("n > 0")
        .groupBy("d1", "d2")
        .agg(
            F.first("n").alias("n"),
            F.count("*").alias("size"),
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "key")).alias("rep"),
        )
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    labels = _class_components(docs, classes)
    if labels is None:
        named = classes.withColumn("component_id", F.col("least"))
    else:
        comp = F.coalesce("comp", "cls").alias("comp")
        whole = stash(
            classes.join(labels, "cls", "left").select("d1", "d2", "size", "least", comp), "whole"
        )
        least = whole.groupBy("comp").agg(F.min("least").alias("component_id"))
        named = whole.join(least, "comp")
    named = stash(named.select("d1", "d2", "size", "component_id"), "named")
    filled = join_sized(rows.where("n > 0"), named, ["d1", "d2"], "size")
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return filled.select(*columns).unionByName(empty.select(*columns))

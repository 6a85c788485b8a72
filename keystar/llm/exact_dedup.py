"""Exact dedup of a batch against an immutable snapshot, screened by binary-fuse filters.

Digests of the snapshot are cut into buckets and a static filter is built per bucket. Digests
of a new batch are grouped among themselves and screened: what no filter knows is new, what
one may know joins the exact digests of its bucket. Rows that share a digest are compared
byte by byte.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.llm.fuse import FuseFilter
from keystar.session import stash

#: Snapshot digests in one filter; the number of buckets follows the snapshot's size.
BUCKET_ROWS = 100_000
#: Slots a shared digest may fall into when texts are fetched; bounds what is broadcast.
SLOTS = 1 << 20

FILTER = "bucket int, seed int, segment int, segments int, slots binary"


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _key() -> Column:
    """64 bits of a digest."""
    return F.xxhash64("digest")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(_key(), 32), F.lit(buckets)).cast("int")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One static filter per bucket of the snapshot's distinct digests."""

    def build(names: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(np.unique(frame["key"].to_numpy(dtype=np.int64).view(np.uint64)))
        row = (names[0], made.seed, made.segment, made.segments, made.slots)
        return pd.DataFrame([row], columns=["bucket", "seed", "segment", "segments", "slots"])

    keys = snapshot.select(_bucket(buckets).alias("bucket"), _key().alias("key"))
    return keys.groupBy("bucket").applyInPandas(build, FILTER)


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Batch groups (digest, keep_id, n) and whether the snapshot may know the digest."""

    def ask(one: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        found = one[["digest", "keep_id", "n"]].copy()
        found["maybe"] = False
        if len(many) and len(one):
            row = many.iloc[0]
            known = FuseFilter(int(row.seed), int(row.segment), int(row.segments), row.slots)
            found["maybe"] = known.maybe(one["key"].to_numpy(dtype=np.int64).view(np.uint64))
        return found

    keyed = batch.select("*", _bucket(buckets).alias("bucket"), _key().alias("key"))
    return (
        keyed.groupBy("bucket")
        .cogroup(filters.groupBy("bucket"))
        .applyInPandas(ask, "digest binary, keep_id long, n long, maybe boolean")
    )


def merge_batch(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Groups (digest, keep_id, n) of a snapshot with a batch added; both are such groups."""
    buckets = max(1, -(-snapshot.count() // BUCKET_ROWS))
    filters = stash(build_filters(snapshot, buckets), "filters")
    screened = stash(screen(batch, filters, buckets), "screened")
    known = screened.where("maybe").select(
        "digest", F.col("keep_id").alias("new_id"), F.col("n").alias("new_n")
    )
    either = snapshot.join(known, "digest", "full").select(
        "digest",
        F.greatest("keep_id", "new_id").alias("keep_id"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("new_n", F.lit(0))).alias("n"),
    )
    return either.unionByName(screened.where("NOT maybe").drop("maybe"))


def dedup(
    docs: DataFrame, in_snapshot: Column, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Rows where ``in_snapshot`` is true form the snapshot, the others the new batch. Of equal
    texts the largest doc_id stays. Null and empty texts are equal; rows without an id never
    stay if a row with one has their text, otherwise their ``keep_id`` is null and all of them
    are kept. Rows repeated with one id are all marked kept if that id is. An empty table gives
    no rows.
    """
    own = F.col(key).cast("long").alias("doc_id")
    old = F.coalesce(in_snapshot, F.lit(False)).alias("old")
    rows = stash(docs.select(own, old, _digest(text).alias("digest")), "digests")
    snapshot = stash(_groups(rows.where("old")), "snapshot")
    merged = merge_batch(snapshot, _groups(rows.where("NOT old")))
    shared = stash(merged.where("n > 1").select("digest"), "shared")
    # Which of a fixed number of slots have a shared digest: keeps most other texts from moving.
    slot = F.pmod(_key(), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(shared.select(slot).distinct())

    # Bytes are compared among rows with a common digest only.
    whole = docs.select(
        own, F.coalesce(text, F.lit("")).alias("text"), _digest(text).alias("digest")
    )
    near = whole.withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")
    copies = stash(near.join(shared.hint("merge"), "digest"), "copies")
    equal = copies.groupBy("digest", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    grouped = copies.join(equal.hint("merge"), ["digest", "text"]).select(
        "doc_id", "digest", "keep_id", "group_size"
    )
    single = rows.join(shared, "digest", "left_anti").select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long")
    )
    return grouped.union(single).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )

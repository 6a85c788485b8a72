"""Toxicity from class-conditional Kneser-Ney models of the characters of words.

Two models, toxic and ordinary, share the counts of their short contexts, which come from every
document of the corpus; long contexts are counted per class in labelled rows. A document is
scored by its length-normalised log-likelihood ratios, put through a logistic curve.

All counts are Spark aggregations: words per block of documents, then distinct character
n-grams, then the continuation counts of each shorter n-gram. They stay exact in written tables
that grow with the corpus. Texts are read once, in blocks: the counts of a block's distinct words
and, per document, which of them it has. Every distinct word of the corpus gets its ratio once,
by one join of its n-grams to the tables; the words that exceed a margin go back to the blocks.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar.llm.common import slices, texts, unused
from keystar.session import remove, scratch_path, stash

ORDER = 6
#: Shorter n-grams share their counts between the classes, longer ones have them per class.
SHARED = 3
DISCOUNT = 0.75
#: Bits of one character in a packed n-gram; 6 x 10 fit a long. Counts use no packed n-grams.
BITS = 10
#: The chance of a character below the shortest n-grams.
UNSEEN = 1 / 1024
#: Labelled rows that the classes are learned from, in expectation; all rows if there are fewer.
LABEL_ROWS = 200_000
#: Longer words are read in pieces of this length.
WORD_CHARS = 256
#: Distinct words, and their characters, after which a block of documents ends.
BLOCK_WORDS = 300_000
BLOCK_CHARS = 32 << 20
#: N-grams, repeats included, after which a block of words ends.
BLOCK_GRAMS = 600_000
#: Rows handed to Spark, or read from it, at once; bounds what both sides hold of a block.
BATCH_ROWS = 10_000
RIDGE = 1e-3
#: A document that scores this much is toxic.
THRESHOLD = 0.7

#: Sides and sizes of the excess ratios, in nats, that make a document's features.
MARGINS = ((1, 2.0), (1, 4.0), (1, 6.0), (-1, 0.0), (-1, 2.0), (-1, 4.0))
FEATURES = [f"e{i}" for i in range(len(MARGINS))]
#: The same by the models that the curve is placed with.
PLACING = [f"p{i}" for i in range(len(MARGINS))]
FLOOR = 1e-3

# White space, which no word holds.
PAD, END = " ", "\n"
STRIPPED = string.punctuation + "…„“”‚‘’«»¿¡–—"
CLASSES = ("t0", "o0", "t", "o")
COUNTS = ("n_all", *CLASSES)
#: Counts of the words of a block of documents.
COUNTED = ("n_all", "t0", "o0", "t2", "o2")
#: The models that the curve is placed with, and those that score.
PAIRS = (("t0", "o0"), ("t", "o"))

#: By order: ("count") n-grams ``g``, ("sum") histories ``h`` with their sums and kinds.
Tables = dict[tuple[int, str], DataFrame]


def words_of(token: str) -> list[str]:
    """The words of a lower-cased token: punctuation around it is dropped, if more is left."""
    word = token.strip(STRIPPED) or token
    if len(word) <= WORD_CHARS:
        return [word]
    return [word[i : i + WORD_CHARS] for i in range(0, len(word), WORD_CHARS)]


def packed_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The longest n-grams that end at each character of each word, and the word of each.

    A word starts after ORDER - 1 pads and ends with an end mark. Characters beyond the code
    range share codes of its upper half.
    """
    before = PAD * (ORDER - 1)
    text = "".join(f"{before}{w}{END}" for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    half = 1 << (BITS - 1)
    code = np.where(code < 2 * half, code, half + code % half)
    gram = code.copy()
    for back in range(1, ORDER):
        gram[back:] |= code[:-back] << (BITS * back)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + ORDER
    owner = np.repeat(np.arange(len(words)), sizes)
    within = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = within >= ORDER - 1
    return gram[kept], owner[kept]


def grams_of(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The longest n-grams that end at each character of each word, and the word of each.

    A word that ``words_of`` would cut has the n-grams of its pieces.
    """
    before, grams, sizes = PAD * (ORDER - 1), [], []
    for word in words:
        pieces = [word] if len(word) <= WORD_CHARS else words_of(word)
        start = len(grams)
        for piece in pieces:
            text = before + piece + END
            grams.extend([text[i : i + ORDER] for i in range(len(piece) + 1)])
        sizes.append(len(grams) - start)
    return grams, np.repeat(np.arange(len(words)), sizes)


WORDS, DOCS = 0, 1


class _Numbers(dict):
    """Numbers of tokens by their words, in the order the words first occur."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.chars = 0

    def __missing__(self, token: str) -> int:
        word = token.strip(STRIPPED) or token
        number = self.words.setdefault(word, len(self.words))
        if number == len(self.words) - 1:
            self.chars += len(word)
        self[token] = number
        return number


def packed_bag(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """A document's words and how often it has them; bytes of equal weight stand together."""
    order = np.argsort(numbers)
    steps = np.diff(numbers[order], prepend=np.int32(0))
    both = np.concatenate([steps, times[order]]).astype("<i4").view(np.uint8)
    return zlib.compress(both.reshape(-1, 4).T.tobytes(), 1)


def unpacked_bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    steps, times = np.ascontiguousarray(raw.T).view("<i4").reshape(2, -1)
    return np.cumsum(steps), times


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (row, text, fold, toxic): (block, kind, i, word, n_all ... o2, data, mark, row).

    DOCS: the words of a text by their numbers in the block, ``i`` of which there are so far;
    ``mark`` is the label of a row that places the curve. WORDS: number, word and its counts.
    """

    def rows(kind: int, n: int, row: pa.Array, **given: pa.Array) -> pa.RecordBatch:
        columns = {
            "block": pa.array(np.full(n, block)), "kind": pa.array(np.full(n, kind, np.int32)),
            "i": pa.nulls(n, pa.int32()), "word": pa.nulls(n, pa.string()),
            **{c: pa.nulls(n, pa.int64()) for c in COUNTED},
            "data": pa.nulls(n, pa.binary()), "mark": pa.nulls(n, pa.int32()), "row": row,
        } | given
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def ended() -> pa.RecordBatch:
        n = len(ids.words)
        given = {c: pa.array(x[:n]) for c, x in zip(COUNTED, counts, strict=True)}
        numbers, words = pa.array(np.arange(n, dtype=np.int32)), pa.array(ids.words, pa.string())
        return rows(WORDS, n, pa.nulls(n, kept), i=numbers, word=words, **given)

    ids, counts = _Numbers(), np.zeros((len(COUNTED), 0), dtype=np.int64)
    block, kept = uuid4().int >> 65, pa.null()
    for batch in slices(batches, 500):
        kept, found, marks = batch.column(0).type, [], []
        folds, toxic = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for text in texts(batch.column(1)):
            tokens = Counter(text.lower().split())
            numbers = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int32, count=len(tokens))
            times = np.fromiter(tokens.values(), dtype=np.int32, count=len(tokens))
            found.append((numbers, times))
        columns: list[list[int]] = [[] for _ in COUNTED]
        for at, (fold, mark) in enumerate(zip(folds, toxic, strict=True)):
            columns[0].append(at)
            if fold is not None and mark is not None:
                columns[(1 if mark else 2) + (2 if fold == 2 else 0)].append(at)
            marks.append(mark if fold == 2 else None)
        n = len(ids.words)
        counts = np.pad(counts, ((0, 0), (0, n - counts.shape[1])))
        for column, members in enumerate(columns):
            if members:
                numbers, times = (np.concatenate([found[at][k] for at in members]) for k in (0, 1))
                counts[column] += np.bincount(numbers, times, n).astype(np.int64)
        yield rows(
            DOCS, len(found), batch.column(0), i=pa.array(np.full(len(found), n, np.int32)),
            data=pa.array([packed_bag(*x) for x in found], pa.binary()),
            mark=pa.array(marks, pa.int32()),
        )
        if n > BLOCK_WORDS or ids.chars > BLOCK_CHARS:
            yield from slices(iter([ended()]), BATCH_ROWS)
            ids, counts = _Numbers(), np.zeros((len(COUNTED), 0), dtype=np.int64)
            block = uuid4().int >> 65
    if ids.words:
        yield from slices(iter([ended()]), BATCH_ROWS)


def blocks_of(rows: DataFrame, folder: str) -> DataFrame:
    """Blocks of rows (row, text, fold, toxic), see ``_blocks``; all of ``row`` is carried along."""
    plain = [("block", T.LongType()), ("kind", T.IntegerType()), ("i", T.IntegerType())]
    plain += [("word", T.StringType()), *((c, T.LongType()) for c in COUNTED)]
    plain += [("data", T.BinaryType()), ("mark", T.IntegerType())]
    fields = [T.StructField(*x) for x in plain]
    made = T.StructType([*fields, T.StructField("row", rows.schema["row"].dataType)])
    # Written once, so that a block that is made again has no other number.
    found = rows.select("row", "text", "fold", "toxic").mapInArrow(_blocks, made)
    return stash(found, "blocks", folder)


def counted_words(blocks: DataFrame, folder: str) -> DataFrame:
    """(word, n_all, t0, o0, t, o) of every distinct word of the blocks."""
    sums = blocks.where(F.col("kind") == WORDS).groupBy("word").agg(
        *(F.sum(c).alias(c) for c in COUNTED)
    )
    both = [(F.col(f"{c}0") + F.col(f"{c}2")).alias(c) for c in ("t", "o")]
    return stash(sums.select("word", "n_all", "t0", "o0", *both), "words", folder)


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (word, n_all ... o): their distinct n-grams, numbered and counted, their words."""

    def ended() -> Iterator[pa.RecordBatch]:
        block = uuid4().int >> 65
        both = pa.Table.from_batches(held)
        words = both.column("word").to_pylist()
        grams, owner = grams_of(words)
        place, distinct = pd.factorize(np.array(grams, dtype=object))
        n = len(distinct)
        sums = [
            np.bincount(place, both.column(c).to_numpy()[owner], n).astype(np.int64) for c in COUNTS
        ]
        arrays = [
            pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)),
            pa.array(distinct, pa.string()), *map(pa.array, sums), pa.nulls(n, pa.binary()),
        ]
        names = ["block", "i", "g", *COUNTS, "data"]
        yield from slices(iter([pa.RecordBatch.from_arrays(arrays, names=names)]), BATCH_ROWS)
        data = pa.array([zlib.compress("\n".join(words).encode(), 1)], pa.binary())
        one = [pa.nulls(1, x.type) for x in arrays]
        yield pa.RecordBatch.from_arrays([arrays[0][:1], *one[1:-1], data], names=names)

    held, n = [], 0
    for batch in slices(batches):
        held.append(batch)
        n += batch.num_rows + (pc.sum(pc.utf8_length(batch.column(0))).as_py() or 0)
        if n > BLOCK_GRAMS:
            yield from ended()
            held, n = [], 0
    if n:
        yield from ended()


def word_blocks(words: DataFrame, folder: str) -> DataFrame:
    """(block, i, g, n_all, t0, o0, t, o, data): n-grams of blocks of words, ``data`` the words."""
    counts = ", ".join(f"{c} long" for c in COUNTS)
    made = words.select("word", *COUNTS).mapInArrow(
        _word_blocks, f"block long, i int, g string, {counts}, data binary"
    )
    # Written once, as the blocks of documents are.
    return stash(made, "word_blocks", folder)


def _longest(blocks: DataFrame) -> DataFrame:
    """Distinct n-grams of the highest order with their token counts per class."""
    grams = blocks.where("g IS NOT NULL")
    return grams.groupBy("g").agg(*(F.sum(c).alias(c) for c in COUNTS))


def _end(order: int) -> Column:
    """The last characters of an n-gram."""
    return F.substring("g", -order, order) if order else F.lit("")


def _shorter(grams: DataFrame, order: int) -> DataFrame:
    """Continuation counts: in how many distinct longer n-grams each n-gram is the end."""
    counts = [F.count_if(F.col(c) > 0).alias(c) for c in COUNTS]
    return grams.groupBy(_end(order).alias("g")).agg(*counts)


def _names(order: int) -> tuple[str, ...]:
    """The counts that an order is read with."""
    return ("n_all",) if order <= SHARED else CLASSES


def _tables(grams: DataFrame, order: int) -> Tables:
    """Exact counts of one order, and per history their sum and how many there are."""
    names = _names(order)
    sums = [F.sum(c).alias(f"{c}_sum") for c in names]
    distinct = [F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in names]
    counted = grams.where(" OR ".join(f"{c} > 0" for c in names))
    history = F.substring("g", 1, order - 1).alias("h")
    return {
        (order, "count"): counted.select("g", *names),
        (order, "sum"): counted.groupBy(history).agg(*sums, *distinct),
    }


def packed_tables(tables: Tables) -> Tables:
    """Every history table written once, for all that is scored; the counts already are."""
    return {k: stash(v, "histories") if k[1] == "sum" else v for k, v in tables.items()}


def gram_log_ratios(grams: DataFrame, tables: Tables, *pairs: tuple[str, str]) -> DataFrame:
    """(g, r0, ...) of distinct n-grams ``g`` of the highest order, seen in the corpus or not.

    A pair (toxic, ordinary) gives log P(last character | toxic) - log P(last character |
    ordinary). An order's n-grams are the distinct ends of the next one's, so each is joined once.
    """
    chances = {"n_all": F.lit(UNSEEN)}
    lower: DataFrame | None = None
    for order in range(1, ORDER + 1):
        asked = grams.select(_end(order).alias("g"))
        asked = asked if order == ORDER else asked.distinct()
        if order == SHARED + 1:
            chances = {name: F.col("n_all_lower") for pair in pairs for name in pair}
        found = asked.withColumns({"h": F.substring("g", 1, order - 1), "end": _end(order - 1)})
        found = found.join(tables[order, "count"], "g", "left")
        found = found.join(tables[order, "sum"], "h", "left")
        if lower is not None:
            found = found.join(lower, "end")
        out = {}
        for name, below in chances.items():
            total = F.coalesce(F.col(f"{name}_sum"), F.lit(0))
            count = F.coalesce(F.col(name), F.lit(0))
            top = F.greatest(count - DISCOUNT, F.lit(0.0))
            top = top + DISCOUNT * F.col(f"{name}_kinds") * below
            out[f"{name}_chance"] = F.when(total > 0, top / total).otherwise(below)
        level = found.select("g", *(c.alias(k) for k, c in out.items()))
        if order < ORDER:
            lower = level.withColumnsRenamed(
                {"g": "end", **{f"{n}_chance": f"{n}_lower" for n in chances}}
            )
            chances = {n: F.col(f"{n}_lower") for n in chances}
    ratios = (F.log(f"{t}_chance") - F.log(f"{o}_chance") for t, o in pairs)
    return level.select("g", *(r.alias(f"r{k}") for k, r in enumerate(ratios)))


def _word_ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, r0, ...) of rows (block, data, i, r0, ...) sorted by (block, data), nulls first."""
    current, parts = None, []
    for batch in slices(batches, BATCH_ROWS):
        block, data = batch.column(0).to_numpy(), batch.column(1)
        edges = np.flatnonzero(np.diff(block)) + 1
        for start, end in zip([0, *edges], [*edges, len(block)], strict=True):
            if start == end:
                continue
            if block[start] != current:
                current, parts = block[start], []
            part = batch.slice(start, end - start)
            words = part.column(1).drop_null()
            grams = part.filter(pc.is_null(part.column(1)))
            parts.append([c.to_numpy() for c in grams.columns[2:]])
            for sent in words:
                names = zlib.decompress(sent.as_py()).decode().split("\n")
                found, owner = grams_of(names)
                place, distinct = pd.factorize(np.array(found, dtype=object))
                numbers, *ratios = (np.concatenate(x) for x in zip(*parts, strict=True))
                if len(numbers) != len(distinct):
                    raise ValueError("n-grams of a block without their ratio")
                known = np.empty(len(distinct))
                sums = []
                for ratio in ratios:
                    known[numbers] = ratio
                    sums.append(np.bincount(owner, known[place], len(names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), *map(pa.array, sums)],
                    names=["word", *(f"r{k}" for k in range(len(sums)))],
                )


def word_ratios(
    blocks: DataFrame, tables: Tables, folder: str, *pairs: tuple[str, str]
) -> DataFrame:
    """(word, r0, ...): log P(word | toxic) - log P(word | ordinary) of every word of word blocks."""
    columns = [f"r{k}" for k in range(len(pairs))]
    grams = blocks.where("g IS NOT NULL").select("block", "i", "g")
    asked = stash(grams.select("g").distinct(), "asked", folder)
    ratios = stash(gram_log_ratios(asked, tables, *pairs), "gram_ratios", folder)
    found = grams.join(ratios, "g").select("block", "i", *columns)
    words = blocks.where("g IS NULL").select("block", "data")
    both = words.unionByName(found, allowMissingColumns=True)
    sorted_blocks = both.repartition("block").sortWithinPartitions("block", "data")
    return sorted_blocks.select("block", "data", "i", *columns).mapInArrow(
        _word_ratios, ", ".join(["word string", *(f"{c} double" for c in columns)])
    )


def word_log_ratios(words: list[str], tables: Tables, toxic: str, ordinary: str) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of each of a few words."""
    if not words:
        return np.zeros(0)
    grams, owner = grams_of(words)
    spark = tables[ORDER, "count"].sparkSession
    asked = spark.createDataFrame([(g,) for g in sorted(set(grams))], "g string")
    known = dict(gram_log_ratios(asked, tables, (toxic, ordinary)).collect())
    return np.bincount(owner, [known[g] for g in grams], len(words))


def evidence_of(ratios: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of documents whose words' log ratios stand one after the other.

    ``times`` is how often a document has a word, ``sizes`` how many it has. Per document the
    length-normalised excess of the ratios over each margin, toxic and ordinary, on a log scale.
    Margins keep the small, steady ratios of a language or topic from drowning the few
    expressions that tell.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = np.maximum(np.bincount(owner, times, len(sizes)), 1)
    columns = []
    for sign, margin in MARGINS:
        excess = times * np.maximum(sign * ratios - margin, 0)
        columns.append(np.log(FLOOR + np.bincount(owner, excess, len(sizes)) / n))
    return np.stack(columns, axis=1)


def _tells(ratio: str) -> Column:
    """Whether a word exceeds a margin; any other adds nothing to a feature."""
    any_ = F.lit(False)
    for sign, margin in MARGINS:
        any_ = any_ | (sign * F.col(ratio) > margin)
    return any_


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the features of their texts, of blocks sorted by (block, kind).

    Words come with their ratios before the rows of their block. A marked row also has the
    features of the models that place the curve.
    """
    current, parts, known = None, [], None

    def wide(n: int) -> np.ndarray:
        """Ratios of the block's first ``n`` words at least; of those that were not sent, zero."""
        table = known
        if table is None:
            n = max([n, *(int(p[0].max()) + 1 for p in parts)])
            table = np.zeros((2, n))
            for numbers, *ratios in parts:
                table[:, numbers] = ratios
        return np.pad(table, ((0, 0), (0, max(0, n - table.shape[1]))))

    for batch in slices(batches, BATCH_ROWS):
        block, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
        for start, end in zip([0, *edges], [*edges, len(block)], strict=True):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if block[start] != current:
                current, parts, known = block[start], [], None
            if kind[start] == WORDS:
                columns = (pc.fill_null(part.column(c), 0) for c in ("i", "r0", "r1"))
                parts.append([c.to_numpy() for c in columns])
                continue
            known = wide(pc.max(part.column("i")).as_py())
            parts = []
            for piece in slices(iter([part]), 500):
                bags = [unpacked_bag(x) for x in piece.column("data").to_pylist()]
                marked = pc.is_valid(piece.column("mark")).to_numpy(zero_copy_only=False)
                features = []
                for k, chosen in ((1, np.ones(len(bags), dtype=bool)), (0, marked)):
                    own = [bags[at] for at in np.flatnonzero(chosen)]
                    out = np.full((len(bags), len(MARGINS)), np.nan)
                    if own:
                        numbers, times = (np.concatenate(x) for x in zip(*own, strict=True))
                        sizes = np.array([len(x) for x, _ in own])
                        out[chosen] = evidence_of(known[k][numbers], times, sizes)
                    features += list(out.T)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), piece.column("mark"), *map(pa.array, features)],
                    names=["row", "mark", *FEATURES, *PLACING],
                )


def evidence(blocks: DataFrame, ratios: DataFrame, folder: str) -> DataFrame:
    """(row, mark, features) of blocks of documents; ``ratios`` has every word of theirs.

    Only words that tell travel, in single precision, and ``r0`` only where a marked row has them.
    """
    marked = F.col("t2") + F.col("o2") > 0
    words = blocks.where(F.col("kind") == WORDS).select(
        "block", "i", "word", marked.alias("marked")
    )
    found = words.join(ratios.where(_tells("r0") | _tells("r1")), "word")
    found = found.where(_tells("r1") | (F.col("marked") & _tells("r0")))
    own = F.when(F.col("marked"), F.col("r0").cast("float"))
    answers = found.select(
        "block", F.lit(WORDS).alias("kind"), "i", own.alias("r0"), F.col("r1").cast("float")
    )
    # Written, so that the words are gone from the disk before documents are moved.
    answers = stash(answers, "answers", folder)
    docs = blocks.where(F.col("kind") == DOCS).select("block", "kind", "i", "data", "mark", "row")
    both = docs.unionByName(answers, allowMissingColumns=True)
    sorted_blocks = both.repartition("block").sortWithinPartitions("block", "kind")
    fields = [T.StructField(name, T.DoubleType()) for name in (*FEATURES, *PLACING)]
    mark = T.StructField("mark", T.IntegerType())
    return sorted_blocks.mapInArrow(
        _evidence, T.StructType([blocks.schema["row"], mark, *fields])
    )


def fit_curve(features: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic curve; flat at the base rate if one class is missing."""
    rate = toxic.mean() if len(toxic) else 0.0
    if rate in (0.0, 1.0):
        edge = min(max(rate, 0.01), 0.99)
        return np.zeros(features.shape[1]), float(np.log(edge / (1 - edge)))
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([(features - centre) / scale, np.ones(len(features))])
    ridge = RIDGE * len(x) * np.append(np.ones(features.shape[1]), 0.0)
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - chance) - ridge * weights
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    own = weights[:-1] / scale
    return own, float(weights[-1] - own @ centre)


@dataclass(frozen=True)
class Curve:
    """Weights of the features, each held to the range the curve was placed on."""

    weights: list[float]
    offset: float
    ranges: list[tuple[float, float]]

    def score(self) -> Column:
        line = F.lit(self.offset)
        for name, weight, (low, high) in zip(FEATURES, self.weights, self.ranges, strict=True):
            held = F.greatest(F.lit(low), F.least(F.lit(high), F.col(name)))
            line = line + held * F.lit(weight)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), line))))


def _fold(key: Column) -> Column:
    """The crc32 of the id as text modulo 3; rows without an id count as the empty text."""
    text = F.coalesce(key.cast("long").cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % 3).cast("int")


def _held_out(key: Column) -> Column:
    return key.isNotNull() & (_fold(key) == 1)


def _curve(placed: DataFrame) -> Curve:
    """The logistic curve of marked rows (mark, features of the models it is placed with)."""
    seen = placed.where("mark IS NOT NULL").select("mark", *PLACING).toArrow()
    features = np.column_stack([seen.column(x).to_numpy() for x in PLACING])
    toxic = seen.column("mark").to_numpy()
    # Blocks arrive in any order; sums of doubles depend on it.
    order = np.lexsort((*features.T, toxic))
    features = features[order]
    weights, offset = fit_curve(features, toxic[order])
    ranges = [(0.0, 0.0)] * len(FEATURES)
    if len(features):
        ranges = [(float(x.min()), float(x.max())) for x in features.T]
    return Curve(weights.tolist(), offset, ranges)


def scored_rows(
    docs: DataFrame,
    labels: DataFrame,
    row: Column,
    key: str = "doc_id",
    text: str = "text",
    label_rows: int = LABEL_ROWS,
) -> DataFrame:
    """(row, score) of every row of ``docs``, by models of both classes and a curve.

    Labels are read from rows whose crc32 of the id as text leaves no remainder of 1 modulo 3.
    Remainder 0 gives the counts of a first pair of models, remainder 2 places the logistic
    curve on their evidence; the final models count both. Shared counts read every document.
    A repeated label counts once, as toxic if any of its rows says so; null labels are none.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("id"), "toxic").dropna()
    given = given.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = min(1.0, label_rows / max(1, given.count()))
    million = 1_000_000
    chosen = given.where(F.pmod(F.xxhash64("id"), F.lit(million)) < int(share * million))
    own = F.col(key).cast("long")
    rows = docs.select(
        row.alias("row"), own.alias("id"), _fold(own).alias("fold"),
        _held_out(own).alias("held_out"), F.col(text).alias("text"),
    )
    # At most LABEL_ROWS ids and flags in expectation, whatever the size of the corpus.
    marked = rows.join(F.broadcast(chosen), "id", "left")
    usable = F.when(~F.col("held_out"), F.col("toxic")).alias("toxic")

    spark = docs.sparkSession
    texts_at, words_at = scratch_path(spark, "texts"), scratch_path(spark, "words")
    blocks = blocks_of(marked.select("row", "text", "fold", usable), texts_at)
    named = word_blocks(counted_words(blocks, words_at), words_at)
    grams = stash(_longest(named), "grams")
    tables: Tables = {}
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            grams = stash(_shorter(grams, order), "grams")
        tables |= _tables(grams, order)
    tables = packed_tables(tables)
    ratios = stash(word_ratios(named, tables, words_at, *PAIRS), "ratios", texts_at)
    remove(spark, words_at)
    found = stash(evidence(blocks, ratios, texts_at), "evidence")
    remove(spark, texts_at)
    return found.select("row", _curve(found).score().alias("score"))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label_rows: int = LABEL_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; see ``scored_rows``.

    Null and blank texts have no evidence. Rows without an id are scored and not held out.
    Without labels of both classes every score is the base rate, 0.01 without any. Empty
    tables give no rows.
    """
    own = F.struct(F.col(key).cast("long").alias("doc_id"))
    scored = scored_rows(docs, labels, own, key, text, label_rows)
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"), _held_out(doc_id).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold.

    Null texts score as empty ones, repeated rows stay or go together, rows without an id are
    scored by their text; columns may have any names; an empty table gives no rows.
    """
    # The score is the text's alone, so whole rows need not travel with their words.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    scored = scored_rows(docs, labels, F.struct(digest.alias("digest")))
    name = unused(docs, "_digest")
    toxic = scored.where(F.col("score") >= threshold).select(F.col("row.digest").alias(name))
    return docs.withColumn(name, digest).join(toxic.distinct(), name, "left_anti").drop(name)

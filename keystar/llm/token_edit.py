"""Edit-aware token counts: a segment tree of pre-tokens per document.

Leaves are short runs of pre-tokens with their length and token count; inner nodes hold sums.
An edit finds its place by descending the lengths, re-reads the text from the last pre-token
boundary that it cannot have moved to the first old boundary behind it that still holds, and
updates the sums above. Pre-tokens are counted once per worker and looked up afterwards.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystar.llm.common import record, rows_of, slices, worker_store
from keystar.llm.word_bpe import Remembered

# White space and the pre-token pattern of the byte-level vocabularies.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Characters after a pre-token that can decide where it ends.
CONTEXT = 2
LEAF = 64

COUNTS = (
    "doc_id long, n_chars long, n_tokens long, n_edits int, edited_chars long, "
    "edited_tokens long, reencoded_chars long"
)


class TokenCounter:
    """Token counts of pre-tokens; what is new is encoded in one call."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known = Remembered(self._encode)
        self.pattern = regex.compile(PATTERN)

    @staticmethod
    def of(path: str) -> TokenCounter:
        store = worker_store("token_counts")
        if path not in store:
            store[path] = TokenCounter(path)
        return store[path]

    def _encode(self, new: list[str]) -> list[int]:
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        return [len(e) for e in found]

    def counts(self, tokens: list[str]) -> list[int]:
        self.known.prepare([tokens])
        return list(map(self.known.young.__getitem__, tokens))


class CountTree:
    """A document with the sums of its pre-tokens; leaves are lists of (length, tokens)."""

    def __init__(self, text: str, counter: TokenCounter, cut: list[str] | None = None) -> None:
        """``cut`` are the text's pre-tokens, where they are known already."""
        self.text, self.counter, self.reencoded = text, counter, 0
        tokens = counter.pattern.findall(text) if cut is None else cut
        self._plant(list(zip(map(len, tokens), counter.counts(tokens), strict=True)))

    def _plant(self, pairs: list[tuple[int, int]]) -> None:
        self.leaves = [pairs[i : i + LEAF] for i in range(0, len(pairs), LEAF)] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for number, leaf in enumerate(self.leaves):
            self.chars[self.size + number] = sum(c for c, _ in leaf)
            self.tokens[self.size + number] = sum(t for _, t in leaf)
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one for the end), and where it starts."""
        node, start = 1, 0
        if offset >= self.chars[1]:
            last = len(self.leaves) - 1
            return last, self.chars[1] - self.chars[self.size + last]
        while node < self.size:
            node *= 2
            if offset - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def _set(self, number: int, leaf: list[tuple[int, int]]) -> None:
        self.leaves[number] = leaf
        node = self.size + number
        self.chars[node], self.tokens[node] = sum(c for c, _ in leaf), sum(t for _, t in leaf)
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters [start, end) by ``new``; bounds are cut to the text."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        first, at = self._leaf_at(max(0, start - CONTEXT))
        kept: list[tuple[int, int]] = []
        for pair in self.leaves[first]:
            if at + pair[0] > start - CONTEXT:
                break
            kept.append(pair)
            at += pair[0]
        self.text = self.text[:start] + new + self.text[end:]
        shift, edited = len(new) - (end - start), start + len(new)

        # Old boundaries behind the edit, in new positions, with what follows in their leaf.
        last, old = self._leaf_at(end)
        rest = iter(self.leaves[last])
        left = list(rest)
        fresh: list[str] = []
        position = at
        while position < len(self.text):
            token = self.counter.pattern.match(self.text, position)[0]
            fresh.append(token)
            position += len(token)
            if position < edited:
                continue
            while old + shift < position:
                while not left and last + 1 < len(self.leaves):
                    last += 1
                    left = list(self.leaves[last])
                if not left:
                    break
                old += left.pop(0)[0]
            if old + shift == position and old >= end:
                break
        else:
            left, last = [], len(self.leaves) - 1
        self.reencoded += position - at
        counts = self.counter.counts(fresh)
        middle = kept + list(zip(map(len, fresh), counts, strict=True))
        if first == last:
            self._set(first, middle + left)
        else:
            self._set(first, middle)
            for number in range(first + 1, last):
                if self.leaves[number]:
                    self._set(number, [])
            self._set(last, left)
        if len(self.leaves[first]) > 4 * LEAF:
            self._plant([pair for leaf in self.leaves for pair in leaf])


def count_edited(
    docs: DataFrame, edits: Column, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts before and after edits (see ``COUNTS``), one row per input row.

    ``edits`` is an array of structs (start, end, new), applied in order, each in characters of
    the text as it stands then; bounds are cut to the text, an edit without bounds does nothing,
    a null replacement deletes. Null texts count as empty; null and repeated ids are kept. An
    empty table gives no rows. A row is read on its own, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.of(path)
        for batch in slices(batches, 200):
            out = []
            rows = list(rows_of(batch))
            cuts = [counter.pattern.findall(body or "") for _, body, _ in rows]
            counter.known.prepare(cuts)
            for (doc_id, body, changes), cut in zip(rows, cuts, strict=True):
                tree = CountTree(body or "", counter, cut)
                before = len(tree.text), tree.n_tokens
                done = 0
                for change in changes or ():
                    if change and change["start"] is not None and change["end"] is not None:
                        tree.edit(change["start"], change["end"], change["new"] or "")
                        done += 1
                after = len(tree.text), tree.n_tokens
                out.append((doc_id, *before, done, *after, tree.reencoded))
            yield record(COUNTS, out)

    rows = docs.select(F.col(key).cast("long"), F.col(text), edits.alias("edits"))
    return rows.mapInArrow(run, COUNTS)

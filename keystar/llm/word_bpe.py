"""Token ids of whole texts with a tokenizer that lower-cases and drops white space.

Texts of plain Latin letters, digits and ASCII marks are cut into pre-tokens by the classes of
their characters, many texts at once; the distinct ones are looked up in a store the worker
keeps, new ones go through the bare merge model. Any other
text is cut at white space, which no token crosses, and its new chunks go through the whole
tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import filterfalse

import numpy as np
import pyarrow as pa

from keystar.llm.common import worker_store

#: Pre-tokens, and chunks, in each of the two generations a worker remembers.
REMEMBERED = 200_000
#: By so much more pre-tokens of plain texts: they are short, and a miss costs a merge.
TOKENS = 1.5

# Characters whose normal form and lower case are themselves or one such letter.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
# The classes of the tokenizer's own pattern, within these characters. It takes runs
# of letters, runs of marks and single digits; a lone apostrophe takes a contraction with it.
_SPACE, _LETTER, _MARK, _DIGIT = range(4)
_CLASSES = np.full(256, _MARK, dtype=np.uint8)
_CLASSES[[9, 10, 13, 32]] = _SPACE
_CLASSES[[*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASSES[48:58] = _DIGIT
# White space to Python's split() that the tokenizer reads as characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANK = re.compile(r"[ \t\n\r]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level vocabularies use."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Remembered:
    """A look-up in two generations: a full young one becomes the old one."""

    def __init__(self, compute: Callable[[list], Iterable], times: float = 1) -> None:
        self.compute, self.times = compute, times
        self.young: dict = {}
        self.old: dict = {}

    def prepare(self, rows: list[list]) -> None:
        """Have every key of ``rows`` in the young generation."""
        if len(self.young) > REMEMBERED * self.times:
            self.old, self.young = self.young, {}
        missing: set = set()
        for keys in rows:
            missing.update(filterfalse(self.young.__contains__, keys))
        held = missing & self.old.keys()
        self.young.update((x, self.old[x]) for x in held)
        new = list(missing - held)
        if new:
            self.young.update(zip(new, self.compute(new), strict=True))

    def of(self, keys: list) -> list:
        """What belongs to each of some distinct keys."""
        self.prepare([keys])
        return list(map(self.young.__getitem__, keys))

    def joined(self, keys: list[str]) -> bytes:
        return b"".join(map(self.young.__getitem__, keys))


def plain_tokens(batch: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pre-tokens of plain texts, as Latin-1 bytes, and how many lie before each text's end."""
    data = np.frombuffer("\n".join([*batch, ""]).lower().encode("latin-1"), dtype=np.uint8)
    kind = _CLASSES[data]
    starts = kind == _DIGIT
    starts[:1] |= kind[:1] != _SPACE
    starts[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] != _SPACE)

    # Every text ends with a white space, so there is always a next character.
    lone = np.flatnonzero((data == ord("'")) & starts)
    lone = lone[kind[lone + 1] == _LETTER]
    first, second = data[lone + 1], data[lone + 2]
    one = np.isin(first, list(b"stmd"))
    two = np.zeros(len(lone), dtype=bool)
    for x, y in (b"re", b"ve", b"ll"):
        two |= (first == x) & (second == y)
    starts[lone[one | two] + 1] = False
    after = np.concatenate([lone[one] + 2, lone[two] + 3])
    starts[after] |= kind[after] == _LETTER

    solid = kind != _SPACE
    letters = data[solid]
    offsets = np.append(np.flatnonzero(starts[solid]), len(letters)).astype(np.int64)
    tokens = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    ends = np.cumsum([len(x) + 1 for x in batch])
    return tokens.dictionary_encode(), np.searchsorted(np.flatnonzero(starts), ends)


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        self.tokens = Remembered(self._merge, TOKENS)
        self.chunks = Remembered(self._encode)

    @staticmethod
    def of(path: str) -> ChunkEncoder:
        """The worker's encoder for a vocabulary file."""
        store = worker_store("word_bpe")
        if path not in store:
            store[path] = ChunkEncoder(path)
        return store[path]

    def _merge(self, tokens: list[bytes]) -> list[bytes]:
        mapped = [
            t.decode()
            if t.isascii()
            else t.decode("latin-1").encode().decode("latin-1").translate(self.letters)
            for t in tokens
        ]
        return self._ids(self.bare.encode_batch_fast(mapped, add_special_tokens=False))

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return self._ids(self.whole.encode_batch_fast(chunks, add_special_tokens=False))

    @staticmethod
    def _ids(encodings: Iterable) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in encodings]

    @staticmethod
    def split(text: str) -> list[str]:
        if _SEPARATORS.search(text):
            return [x for x in _BLANK.split(text) if x]
        return text.split()

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [_PLAIN.fullmatch(x) is not None for x in batch]
        easy = iter(self._plain([x for x, known in zip(batch, plain, strict=True) if known]))
        cut = [self.split(x) for x, known in zip(batch, plain, strict=True) if not known]
        self.chunks.prepare(cut)
        other = map(self.chunks.joined, cut)
        return [next(easy if known else other) for known in plain]

    def _plain(self, batch: list[str]) -> list[bytes]:
        """The ids of plain texts: of each distinct pre-token, and from there of each text."""
        if not batch:
            return []
        tokens, ends = plain_tokens(batch)
        found = self.tokens.of(tokens.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        which = tokens.indices.to_numpy()
        lengths = sizes[which]
        to = np.append(0, np.cumsum(lengths))
        shift = (np.cumsum(sizes) - sizes)[which] - to[:-1]
        whole = ids[np.repeat(shift, lengths) + np.arange(to[-1])]
        bounds = to[np.append(0, ends)].tolist()
        return [whole[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]

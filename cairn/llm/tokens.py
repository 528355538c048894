"""Byte-pair tokens of many texts at once.

Every distinct word of a batch is encoded once, and frequent ones are remembered
from batch to batch, up to a bound. A text is cut where white space
follows anything else, and where a mark or digit follows a letter (both ASCII),
so a piece holds a word with the white space before it, or what is attached to
it; the vocabulary's pattern never matches across such a place, hence the tokens
of the pieces in turn are the tokens of the text. Texts where that does not hold
(white space at the end or beyond ASCII) are encoded whole.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import pyarrow as pa

# Fixed value: how the public 50k byte-pair vocabulary splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Unicode's white space beyond ASCII, in UTF-8, and how it begins.
ODD_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
ODD_BEGINNINGS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
SPACE_BYTES = frozenset((9, 10, 11, 12, 13, 32))
SPACES = np.zeros(256, bool)
SPACES[list(SPACE_BYTES)] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
ATTACHED = ~LETTERS & ~SPACES & (np.arange(256) < 128)
TYPE = np.uint16
# Pieces that a process remembers, besides those of one batch.
REMEMBERED = 1 << 17


@cache
def encoding(vocabulary: str):
    """The tokenizer of a ranks file, and the number of bytes of each token."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def encode_whole(text: bytes, vocabulary: str) -> np.ndarray:
    """The tokens of one text."""
    return encoding(vocabulary)[0].encode_to_numpy(text.decode(), disallowed_special=()).astype(TYPE)


def encode(texts: list[bytes], vocabulary: str) -> list[np.ndarray]:
    """The tokens of each text."""
    plain = _cut_at_spaces(texts)
    regular = iter(_encode_regular([t for t, p in zip(texts, plain, strict=True) if p], vocabulary))
    return [next(regular) if p else encode_whole(t, vocabulary) for t, p in zip(texts, plain, strict=True)]


def count(texts: list[bytes], vocabulary: str) -> int:
    """The number of tokens of all texts together."""
    plain = _cut_at_spaces(texts)
    regular = [t for t, p in zip(texts, plain, strict=True) if p]
    others = sum(len(encode_whole(t, vocabulary)) for t, p in zip(texts, plain, strict=True) if not p)
    if not regular:
        return others
    coded, _, _ = _pieces(regular)
    _, _, size = remembered(vocabulary).tokens(_values(coded.dictionary))
    return others + int(size[coded.indices.to_numpy()].sum())


def _cut_at_spaces(texts: list[bytes]) -> list[bool]:
    """Whether the pieces of a text have the tokens of the text."""
    data = b"".join(texts)
    odd_batch = any(beginning in data for beginning in ODD_BEGINNINGS)
    return [bool(t) and not SPACES[t[-1]] and not (odd_batch and ODD_SPACE.search(t)) for t in texts]


def _pieces(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The pieces of all texts in turn, where they begin, and where texts end."""
    data = b"".join(texts)
    codes = np.frombuffer(data, np.uint8)
    space = SPACES[codes]
    ends = np.cumsum([len(t) for t in texts])
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[1:] |= LETTERS[codes[:-1]] & ATTACHED[codes[1:]]
    cut[np.concatenate(([0], ends[:-1]))] = True
    begins = np.flatnonzero(cut)
    offsets = pa.py_buffer(np.append(begins, len(data)))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(data)])
    return pieces.dictionary_encode(), begins, ends


def _values(pieces: pa.LargeBinaryArray) -> list[bytes]:
    """The pieces as Python values, cut out of their buffer: much faster than Arrow's own way."""
    _, offsets, data = pieces.buffers()
    at = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _encode_regular(texts: list[bytes], vocabulary: str) -> list[np.ndarray]:
    if not texts:
        return []
    coded, begins, ends = _pieces(texts)
    pool, start, size = remembered(vocabulary).tokens(_values(coded.dictionary))
    place = coded.indices.to_numpy()
    sizes = size[place]
    stops = np.cumsum(sizes, dtype=np.int32)  # a batch is far below 2 GB
    tokens = pool[np.repeat(start[place] - (stops - sizes), sizes) + np.arange(stops[-1], dtype=np.int32)]
    last = np.searchsorted(begins, ends) - 1  # last piece of each text
    return np.split(tokens, stops[last][:-1])


class Remembered:
    """Tokens of pieces, kept until there are too many."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        self.known: dict[bytes, bytes] = {}

    def tokens(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :func:`_encode_pieces`, which gets only pieces that are not known."""
        found = list(map(self.known.get, pieces))
        missing = [i for i, tokens in enumerate(found) if tokens is None]
        if missing:
            new = [pieces[i] for i in missing]
            pool, start, size = _encode_pieces(new, self.vocabulary)
            raw, width = pool.tobytes(), pool.itemsize
            tokens = [raw[a:b] for a, b in zip((start * width).tolist(), ((start + size) * width).tolist(), strict=True)]
            for i, t in zip(missing, tokens, strict=True):
                found[i] = t
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known.update(zip(new, tokens, strict=True))
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // TYPE().itemsize
        stops = np.cumsum(sizes, dtype=np.int32)
        return np.frombuffer(b"".join(found), TYPE), stops - sizes, sizes


@cache
def remembered(vocabulary: str) -> Remembered:
    return Remembered(vocabulary)


def forget() -> None:
    """Free what was remembered; a task does so at its end."""
    remembered.cache_clear()


def _encode_pieces(pieces: list[bytes], vocabulary: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all pieces, and where those of each piece begin and how many they are.

    The pieces are encoded as one text. One without white space in front gets a
    line feed, whose token is left out again.
    """
    tokenizer, bytes_of = encoding(vocabulary)
    bare = np.array([p[0] not in SPACE_BYTES for p in pieces])
    text = b"".join(b"\n" + p if b else p for p, b in zip(pieces, bare, strict=True))
    pool = tokenizer.encode_to_numpy(text.decode(), disallowed_special=()).astype(TYPE)
    ends = np.cumsum([len(p) for p in pieces] + bare)
    token_ends = np.cumsum(bytes_of[pool])
    stop = np.searchsorted(token_ends, ends) + 1
    start = np.concatenate(([0], stop[:-1])) + bare
    if (token_ends[stop - 1] != ends).any():
        raise ValueError("the vocabulary's tokens cross white space")
    return pool, start.astype(np.int32), (stop - start).astype(np.int32)

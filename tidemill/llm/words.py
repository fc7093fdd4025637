"""Texts cut into words by the byte-level pattern, many texts at once.

The matches of :data:`PATTERN` begin where the classes of neighbouring characters
say so (letters, numbers, white space, the space itself, all others), so that the
words of a whole batch are found by a few passes over arrays (:func:`cut`), with the
same result as asking the pattern for each text. Classes are those of the ``regex``
library. Another pattern is asked text by text.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# The pattern that cuts text into words before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

OTHER, LETTER, NUMBER, WHITE, SPACE = range(5)


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, of in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for run in regex.finditer(of, every):
            out[run.start() : run.end()] = kind
    out[ord(" ")] = SPACE
    return out


@cache
def _begins() -> np.ndarray:
    """Whether a word begins at a character, by 64 * its class + 8 * that of the character
    before + that of the one after (7: none)."""
    out = np.zeros(512, bool)
    for here in range(5):
        for before in (*range(5), 7):
            for after in (*range(5), 7):
                if here < WHITE:  # a space before it is the word's own
                    begins = before not in (here, SPACE)
                else:  # the last white space before a word stands apart from the others
                    begins = before not in (WHITE, SPACE) or after < WHITE
                out[here * 64 + before * 8 + after] = begins
    return out


def _contractions(points: np.ndarray, kinds: np.ndarray, first: np.ndarray, begins: np.ndarray) -> None:
    """Sets ``begins`` for 's, 't, 're, 've, 'm, 'll and 'd, which are words where a word
    begins with them, whatever letters follow."""
    at = np.flatnonzero(points == ord("'"))
    at = at[begins[at]]
    if not len(at):
        return
    n = len(points)
    letters = []
    inside = np.ones(len(at), bool)
    for k in (1, 2):
        place = np.minimum(at + k, n - 1)
        inside &= (at + k < n) & ~first[place]
        letters.append(np.where(inside, points[place], 0))
    one, two = letters
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    for which, length in ((short, 2), (long, 3)):
        begins[at[which] + 1] = False
        ends = at[which] + length
        begins[ends[ends < n]] = True


def cut(texts: pa.Array, pattern: str = PATTERN) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of all ``texts`` in order, and how many each text has. A null text has
    none."""
    if pattern != PATTERN:
        found = [regex.findall(pattern, t or "") for t in texts.to_pylist()]
        return pa.array([w.encode() for words in found for w in words], pa.binary()), np.array([len(x) for x in found], np.int64)
    texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    if ends[0] == ends[-1]:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    data = data.slice(int(ends[0]), int(ends[-1] - ends[0]))
    points, ends = np.frombuffer(data, np.uint8), ends - ends[0]
    places = None
    if points.max() > 127:  # from here on by characters, not by bytes
        places = np.flatnonzero((points & 0xC0) != 0x80)
        points = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
        ends = np.searchsorted(places, ends)
    n = len(points)
    starts = ends[:-1][ends[:-1] < ends[1:]]  # of texts that aren't empty
    kinds = classes()[points]
    around = np.empty(n, np.uint16)
    around[1:] = kinds[:-1]
    around[starts] = 7
    around <<= 3
    around += kinds.astype(np.uint16) << 6
    after = np.empty(n, np.uint8)
    after[:-1] = kinds[1:]
    after[starts - 1] = 7  # the last characters of texts; -1 is that of all
    around += after
    begins = _begins()[around]
    first = np.zeros(n, bool)
    first[starts] = True
    _contractions(points, kinds, first, begins)
    at = np.flatnonzero(begins)
    sizes = np.diff(np.searchsorted(at, ends))
    if places is not None:
        at = places[at]
    offsets = np.append(at, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), data]), sizes


def distinct(words: pa.BinaryArray) -> tuple[list[bytes], np.ndarray]:
    """The distinct words in the order in which they are met, and each word's place
    among them."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()


def binaries(data: np.ndarray | pa.Buffer | bytes, offsets: np.ndarray) -> pa.LargeBinaryArray:
    """Slices of ``data`` as an array of values."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def taken(values: pa.LargeBinaryArray, numbers: np.ndarray | pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The values of ``numbers``, one behind the other, and the offsets of each."""
    if not len(numbers):
        return pa.py_buffer(b""), np.zeros(1, np.int64)
    rows = values.take(pa.array(numbers))
    return rows.buffers()[2] or pa.py_buffer(b""), np.frombuffer(rows.buffers()[1], np.int64)[: len(rows) + 1]

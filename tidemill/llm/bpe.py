"""Byte-level BPE by ranks: encoding and decoding.

A text is cut into the matches of the vocabulary's pattern ("words"), and each
distinct word is encoded by folding ranked merges over its bytes: as long as
two neighbouring pieces join to a piece of the vocabulary, the join of lowest
rank (the first of equals) is made. Decoding concatenates the binary pieces.

The fold is made of Spark's higher-order functions (:func:`fold_sql`) over a
literal table of the pairs that join (:class:`Joins`), one row of fixed size that
is broadcast. All ids come from it: :func:`encode` has a task name the distinct
words of its documents as it meets them (:func:`_cut`), folds each once, and puts
the ids where the words stood (:func:`_fill`). Nothing is shuffled, sampled or
left to another way. A task remembers about ``KNOWN`` words; then it begins anew
and folds again what it meets again, which changes no result.
:func:`encode_words` folds a table of words.

:class:`Coder` encodes single texts where there is no session, by a numpy row a
word over the same pairs; no query uses it.

Edge cases: a null text is an empty one, with no ids; long texts are encoded
whole; rows are encoded one by one, so null ids, ties and repeated rows keep
their rows. Extra columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import held, slices, trim
from tidemill.llm.words import binaries, cut, distinct, taken

#: Distinct words that a task of :func:`encode` remembers.
KNOWN = 400_000
#: Longest word, in pieces, whose joins are made one by one; longer ones by rounds.
SINGLE = 64
#: Places that are tried at once when the table of joins is laid out.
TRIED = 1024
CACHE_CHUNKS = 150_000
#: Rows and bytes of text that are encoded at once.
ROWS = 256
TEXT_BYTES = 4 << 20
#: Longest word (bytes) that fold_many puts in a row, and rows of a block.
LONGEST = 64
BLOCK = 8192
ABSENT = 1 << 30


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """The rank map of a file with a base64 piece and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


# --- the fold in Spark ------------------------------------------------------------------


@dataclass(frozen=True)
class Joins:
    """The pairs of pieces that join: if pair (left, right) is one, place
    shift[left] + right belongs to left and has the joined id."""

    shift: np.ndarray
    owner: np.ndarray
    joined: np.ndarray

    def row(self, spark: SparkSession) -> DataFrame:
        columns = tuple(x.tolist() for x in (self.shift, self.owner, self.joined))
        return F.broadcast(spark.createDataFrame([columns], "shift array<int>, owner array<int>, joined array<int>"))


def join_table(ranks: dict[bytes, int]) -> Joins:
    """Rows of the table (those of one left piece) are laid over each other where all
    their places are free, rows of many pairs first."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for (left, right), rank in joins(ranks).items():
        rows.setdefault(left, []).append((right, rank))
    shift = np.zeros(max(ranks.values()) + 1, np.int64)
    owner = np.full(len(shift) + TRIED, -1, np.int64)
    joined = np.full(len(owner), -1, np.int64)
    at = length = 0
    for left, row in sorted(rows.items(), key=lambda x: -len(x[1])):
        right, rank = np.array(sorted(row), dtype=np.int64).T
        if len(row) != length and len(row) < 16:  # else the search goes on where it ended
            at, length = 0, len(row)
        while True:
            if len(owner) < at + TRIED + len(shift):
                owner, joined = (np.append(x, np.full(len(x), -1)) for x in (owner, joined))
            free = np.flatnonzero(owner[at : at + TRIED] < 0) + at - right[0]
            fits = (owner[free[:, None] + right] < 0).all(axis=1)
            if fits.any():
                break
            at += TRIED
        shift[left] = free[fits.argmax()]
        at = int(shift[left] + right[0])
        owner[shift[left] + right], joined[shift[left] + right] = left, rank
    end = np.flatnonzero(owner >= 0).max(initial=-1) + 1
    return Joins(shift, owner[:end], joined[:end])


def joins(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """(left id, right id) to the id that they join to."""
    pairs = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left, right] = rank
    return pairs


def _with(value: str, name: str, body: str) -> str:
    """SQL: body, where name stands for value (computed once)."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _joined(left: str, right: str, absent: int = ABSENT) -> str:
    """SQL of the id that two pieces join to, else ``absent``; -1 is no piece."""
    place = f"get(shift, {left}) + {right}"
    return f"if(get(owner, {place}) = {left}, get(joined, {place}), {absent})"


def fold_sql(pieces: str) -> str:
    """SQL of the ids that ``pieces`` (array<int>, the ids of a word's bytes) join to,
    given the columns of :class:`Joins`."""
    folded = f"if(size(w) <= {SINGLE}, {_single('w')}, {_rounds('concat(array(-1), w, array(-1))')})"
    return _with(pieces, "w", f"if(size(w) < 2, w, {folded})")


def _single(word: str) -> str:
    """One join a step. A piece is one number: what it joins to with the next piece, its
    first byte's place in the word and its id, so that the least is the join to make."""
    none, place = 1 << 20, 1023 << 32
    packed = lambda rank, at, piece: f"shiftleft(cast({rank} as bigint), 42) + {at} + {piece}"
    piece = lambda x: f"cast({x} & 4294967295L as int)"
    start = f"transform({word}, (y, i) -> {packed(_joined('y', f'get({word}, i + 1)', none), 'shiftleft(cast(i as bigint), 32)', 'y')})"
    rank = "cast(shiftright(lo, 42) as int)"
    made = _with(rank, "m", packed(_joined("m", piece("get(s, p + 1)"), none), f"(lo & {place}L)", "m"))
    before = _with(piece("x"), "y", packed(_joined("y", rank, none), f"(x & {place}L)", "y"))
    after = _with("get(s, p - 2)", "b", f"transform(array_remove(s, get(s, p)), x -> if(x = lo, {made}, if(x = b, {before}, x)))")
    step = _with("array_min(s)", "lo", f"if(lo >= {none << 42}L, s, {_with('cast(array_position(s, lo) as int)', 'p', after)})")
    return f"transform(aggregate(sequence(2, size({word})), {start}, (s, n) -> {step}), x -> {piece('x')})"


def _rounds(word: str) -> str:
    """Of the pieces between two -1: all joins of lowest rank a round, from the left ("1" marks their places, "2" those
    taken), up to the first after which a lower one is possible. That is the order in
    which single joins are made, in as many passes as there are different ranks."""
    ranks = f"transform(sequence(0, size(s.a) - 2), i -> {_joined('get(s.a, i)', 'get(s.a, i + 1)')})"
    marks = "split(regexp_replace(array_join(transform(r, x -> if(x = m, '1', '0')), ''), '1.', '20'), '')"
    lower = f"({_joined('m', 'get(s.a, i + 2)')} < m or if(get(f, i - 2) = '2', q, {_joined('get(s.a, i - 1)', 'm')}) < m)"
    first = f"coalesce(array_min(filter(sequence(0, size(r) - 1), i -> get(f, i) = '2' and {lower})), size(r))"
    kept = "filter(sequence(0, size(s.a) - 1), i -> i = 0 or i - 1 > e or get(f, i - 1) <> '2')"
    taken = f"transform({kept}, i -> if(i < size(r) and i <= e and get(f, i) = '2', m, get(s.a, i)))"
    step = _with(marks, "f", _with(_joined("m", "m"), "q", _with(first, "e", f"named_struct('a', {taken}, 'more', true)")))
    step = _with(ranks, "r", _with("array_min(r)", "m", f"if(m = {ABSENT}, named_struct('a', s.a, 'more', false), {step})"))
    return f"aggregate(sequence(1, size(w)), named_struct('a', {word}, 'more', true), (s, n) -> if(s.more, {step}, s), s -> slice(s.a, 2, size(s.a) - 2))"


def encode_words(spark: SparkSession, words: DataFrame, ranks: dict[bytes, int], table: Joins | None = None) -> DataFrame:
    """``words`` (word binary) with their ids (array<int>). A word that is a piece has
    its rank."""
    whole = F.broadcast(spark.createDataFrame(list(ranks.items()), "word binary, whole int"))
    ids = ", ".join(str(ranks[bytes([b])]) for b in range(256))
    letters = "filter(split(decode(w.word, 'ISO-8859-1'), ''), c -> c <> '')"
    start = f"if(w.whole is null, transform({letters}, c -> get(array({ids}), ascii(c))), array(w.whole))"
    many = words.join(whole, "word", "left").groupBy(F.pmod(F.xxhash64("word"), F.lit(64)).alias("part"))
    many = many.agg(F.collect_set(F.struct("word", "whole")).alias("words")).crossJoin((table or join_table(ranks)).row(spark))
    return many.select(F.inline(F.expr(f"transform(words, w -> named_struct('word', w.word, 'ids', {fold_sql(start)}))")))


# --- the fold without a session ----------------------------------------------------------


@dataclass(frozen=True)
class Pairs:
    """A perfect hash (left id, right id) to joined id, and the ids of the single
    bytes. Pair p = left * 65536 + right goes to slot
    (h0(p) + shift[h(p)] * h1(p)) mod len(key)."""

    shift: np.ndarray
    key: np.ndarray
    value: np.ndarray
    byte: np.ndarray

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined ids of pairs, ABSENT where there is none; -1 is no piece."""
        p = left.astype(np.int64) << 16 | np.maximum(right, 0)
        slot = (_h0(p, len(self.key)) + self.shift[_h(p, len(self.shift))] * _h1(p, len(self.key))) % len(self.key)
        return np.where((self.key[slot] == p) & (left >= 0) & (right >= 0), self.value[slot], ABSENT).astype(np.int32)


def pair_table(ranks: dict[bytes, int]) -> Pairs:
    pairs = joins(ranks)
    p = np.array([left << 16 | right for left, right in pairs], dtype=np.int64)
    joined = np.array(list(pairs.values()), dtype=np.int64)
    n_shifts = 1 << max(4, int(np.ceil(np.log2(max(len(p), 1) / 2 + 1))))
    n_slots = 1 << max(5, int(np.ceil(np.log2(1.25 * max(len(p), 1)))))
    group, h0, h1 = (f(p, n) for f, n in ((_h, n_shifts), (_h0, n_slots), (_h1, n_slots)))
    shift, key, value = np.zeros(n_shifts, np.int64), np.full(n_slots, -1, np.int64), np.zeros(n_slots, np.int64)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(n_shifts + 1))
    for g in np.argsort(-np.diff(starts), kind="stable"):
        members = order[starts[g] : starts[g + 1]]
        if not len(members):
            break
        for d in range(1 << 20):
            slots = (h0[members] + d * h1[members]) % n_slots
            if (key[slots] < 0).all() and len(set(slots.tolist())) == len(slots):
                break
        else:
            raise ValueError("no perfect hash found")
        shift[g], key[slots], value[slots] = d, p[members], joined[members]
    return Pairs(shift, key, value, np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64))


def _h(p, n):
    return (p * 40503 + (p >> 16) * 10007) % n


def _h0(p, n):
    return (p * 48271 + (p >> 16) * 69621) % n


def _h1(p, n):
    return (p * 16807 + (p >> 16) * 39373) % n | 1


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word of any length: a queue of the pairs by rank and place,
    over pieces that know their neighbours."""
    if (rank := ranks.get(word)) is not None:
        return [rank]
    n, get = len(word), ranks.get
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(rank, i) for i in range(n - 1) if (rank := get(word[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        # What the queue holds of pieces that have changed since is passed over.
        if pieces[i] is None or j >= n or get(pieces[i] + pieces[j]) != rank:
            continue
        pieces[i], pieces[j], after[i] = pieces[i] + pieces[j], None, after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (rank := get(pieces[a] + pieces[b])) is not None:
                heapq.heappush(queue, (rank, a))
    return [ranks[p] for p in pieces if p is not None]


def fold_many(words: list[bytes], ranks: dict[bytes, int], pairs: Pairs) -> list[bytes]:
    """The ids of each word as little-endian 32-bit integers. Words of similar
    length are the rows of one block."""
    out: list[bytes] = [b""] * len(words)
    todo: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if (rank := ranks.get(word)) is not None:
            out[i] = rank.to_bytes(4, "little")
        elif len(word) > LONGEST:
            out[i] = np.array(fold(word, ranks), "<i4").tobytes()
        elif word:
            todo.setdefault(-(-len(word) // 4) * 4, []).append(i)
    for width, members in todo.items():
        for k in range(0, len(members), BLOCK):
            part = members[k : k + BLOCK]
            for i, ids in zip(part, _fold_block([words[i] for i in part], width, pairs), strict=True):
                out[i] = ids
    return out


def _fold_block(words: list[bytes], width: int, pairs: Pairs) -> list[bytes]:
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    # One column more than there are places, for "no neighbour"; -1 is no piece.
    piece = np.full((n, width + 1), -1, np.int32)
    piece[np.arange(width + 1)[None, :] < lengths[:, None]] = pairs.byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
    rank = np.full((n, width), ABSENT, np.int32)
    rank[:] = pairs(piece[:, :-1], piece[:, 1:])
    rows = np.arange(n)
    while len(rows):
        at = rank[rows].argmin(axis=1)
        best = rank[rows, at]
        if not (more := best < ABSENT).all():
            rows, at, best = rows[more], at[more], best[more]
        gone = after[rows, at]
        following, previous = after[rows, gone], before[rows, at]
        piece[rows, at], piece[rows, gone] = best, -1
        after[rows, at] = following
        rank[rows, gone] = ABSENT
        before[rows, following] = at
        rank[rows, at] = pairs(best, piece[rows, following])
        some = previous >= 0
        rank[rows[some], previous[some]] = pairs(piece[rows[some], previous[some]], best[some])
    alive = piece >= 0
    ends = np.cumsum(alive.sum(axis=1)) * 4
    ids = piece[alive].astype("<i4").tobytes()
    return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Recent:
    """A cache of two generations, filled in bulk: when the young one is full it
    becomes the old one, from which what is still in use is taken over."""

    def __init__(self, make: Callable[[list[str]], Iterable[tuple[str, bytes]]], limit: int):
        self.make, self.limit = make, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def having(self, wanted: set[str]) -> dict[str, bytes]:
        """A dictionary that has all of ``wanted``."""
        missing = wanted.difference(self.young)
        if len(self.young) + len(missing) > self.limit and self.young:
            self.old, self.young = self.young, {}
            missing = wanted
        unknown = []
        for key in missing:
            if (value := self.old.get(key)) is None:
                unknown.append(key)
            else:
                self.young[key] = value
        self.young.update(self.make(unknown))
        return self.young


class Coder:
    """Encodes and decodes texts. A chunk is a run of text between single spaces,
    or whatever white space makes of it; with the space before it it is cut into
    words, and words outside the table of frequent words are folded when met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, frequent: dict[str, bytes] | None = None, pairs: Pairs | None = None):
        self.ranks, self.pairs, self.find = ranks, pairs or pair_table(ranks), regex.compile(pattern).findall
        self.pieces = [piece for piece, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.decimal = [b"%d" % i for i in range(len(self.pieces))]
        self.known = frequent or {}
        self.chunks = Recent(lambda texts: code_chunks(texts, self.find, self._fold_words), CACHE_CHUNKS)

    def _fold_words(self, words: list[str]) -> list[bytes]:
        known = self.known
        new = [w for w in words if w not in known]
        ids = dict(zip(new, fold_many([w.encode("utf-8", "surrogatepass") for w in new], self.ranks, self.pairs), strict=True))
        return [ids[w] if w in ids else known[w] for w in words]

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts as little-endian 32-bit integers."""
        parts = [chunks(t) if t else [] for t in texts]
        have = self.chunks.having(set().union(*parts))
        return [b"".join(map(have.__getitem__, p)) for p in parts]

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed([text])[0], "<u4")

    def decimals(self, packed: bytes) -> tuple[bytes, bytes]:
        """Decimal ids, joined by commas, and the bytes that the ids decode to."""
        ids = np.frombuffer(packed, "<i4").tolist()
        return b",".join(map(self.decimal.__getitem__, ids)), decode(ids, self.pieces)


def code_chunks(parts: list[str], find: Callable[[str], list[str]], code: Callable[[list[str]], list[bytes]]) -> Iterable[tuple[str, bytes]]:
    """Each of ``parts`` (of :func:`chunks`) with the codes of its words (32-bit
    numbers), ``code`` being asked for every distinct word once. Chunks that follow a
    space and end in a character are cut into words as one text, since the pattern
    always cuts before a single space between characters."""
    # Letters after a space are one word by any reading of the pattern.
    plain = [p for p in parts if p.isascii() and p.isalpha()]
    spaced = [" " + p for p in plain]
    rest = parts if not plain else [p for p in parts if not (p.isascii() and p.isalpha())]
    inner = [p for p in rest if p[0] != " " and not _SPACE(p[-1])]
    outer = list(set(rest).difference(inner)) if len(inner) < len(rest) else []
    words = find(" " + " ".join(inner)) if inner else []
    texts = [*(" " + p for p in inner), *map(chunk_text, outer)]
    for text in texts[len(inner) :]:
        words += find(text)
    distinct = list(set(words).union(spaced))
    coded = code(distinct)
    table = dict(zip(distinct, coded, strict=True))
    yield from zip(plain, map(table.__getitem__, spaced), strict=True)
    if not rest:
        return
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    last = np.searchsorted(sizes, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
    each = list(map(table.__getitem__, words))
    stops = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)))[last].tolist()
    flat = b"".join(each)
    yield from zip(inner + outer, [flat[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)], strict=True)


def decode(ids: Iterable[int], pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids))


#: Finds more than the pattern calls white space, which is safe.
_CLOSE = re.compile(r"\s | \s")
_SAFE = regex.compile(r"(?<=\S) (?=\S)")
_SPACE = re.compile(r"\s").match


def chunks(text: str) -> list[str]:
    """Cuts ``text`` at single spaces between two characters that aren't white
    space. The pattern always cuts before these, since its words hold white space at
    their start only. The space isn't in a chunk, but the first chunk, which has
    none, begins with one to tell it apart (:func:`chunk_text`)."""
    parts = _SAFE.split(text) if _CLOSE.search(text) else text.split(" ")
    # A space at an end of the text has no word on one side.
    if len(parts) > 1 and not (parts[0] and parts[-1]):
        parts = _SAFE.split(text)
    parts[0] = " " + parts[0]
    return parts


def chunk_text(chunk: str) -> str:
    return chunk[1:] if chunk[0] == " " else " " + chunk


# --- documents --------------------------------------------------------------------------


class Vocabulary:
    """The pieces of a file of ranks, by bytes and by id."""

    def __init__(self, path: str):
        self.ranks = read_ranks.__wrapped__(path)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pieces = [piece for piece, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.pieces = pa.array(pieces, pa.large_binary())
        self.decimal = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())

    def starts(self, words: list[bytes]) -> pa.ListArray:
        """What the folds of words begin with: the ids of the bytes, or the word's own id
        if it is a piece."""
        whole = list(map(self.ranks.get, words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first, ids = np.cumsum(sizes) - sizes, self.byte[np.frombuffer(b"".join(words), np.uint8)]
        keep, pieces = np.ones(len(ids), bool), [i for i, rank in enumerate(whole) if rank is not None]
        for i in pieces:
            keep[first[i] + 1 : first[i] + sizes[i]], ids[first[i]] = False, whole[i]
        sizes[pieces] = 1
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids[keep]))


ROWS_OF_CUT = "fresh boolean, doc_id array<{id}>, sizes array<int>, numbers array<int>, words array<array<int>>"


class Numbers(dict):
    """Numbers what it is asked for, in order."""

    def __missing__(self, key: bytes) -> int:
        self[key] = len(self)
        return len(self) - 1


def _cut(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """A row for some documents: their ids, how many words each has and the numbers of
    these; each word that is new as its fold's start. Numbers count from the last
    ``fresh`` row."""
    vocabulary = held(("bpe", path), lambda: Vocabulary(path))
    seen = Numbers()
    for batch in batches:
        for part in slices(batch, 1, ROWS, TEXT_BYTES):
            if fresh := not seen or len(seen) > KNOWN:
                seen = Numbers()
            before = len(seen)
            words, sizes = cut(part.column(1), pattern)
            names, at = distinct(words)
            number = np.fromiter(map(seen.__getitem__, names), np.int32, len(names))
            new = [names[i] for i in np.flatnonzero(number >= before).tolist()]
            columns = [part.column(0), pa.array(sizes, pa.int32()), pa.array(number[at]), vocabulary.starts(new)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([fresh]), *lists], ["fresh", "doc_id", "sizes", "numbers", "words"])
    del seen
    trim()


def _fill(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    """Documents from rows of :func:`_cut` whose words are folded. Ids become decimal
    text and pieces, or 32-bit integers; words and documents concatenate these."""
    vocabulary = held(("bpe", path), lambda: Vocabulary(path))
    forms = [vocabulary.decimal, vocabulary.pieces] if digests else [None]
    counts, words = np.zeros(0, np.int64), [pa.array([], pa.large_binary()) for _ in forms]
    for batch in batches:
        for k in range(batch.num_rows):
            doc_id, sizes, numbers, folded = (c[k].values for c in batch.columns[1:])
            if batch.column(0)[k].as_py():
                counts, words = counts[:0], [w[:0] for w in words]
            ids, n = folded.flatten(), folded.value_lengths().to_numpy()
            counts, ends = np.append(counts, n), np.append(0, np.cumsum(n, dtype=np.int64))
            words = [pa.concat_arrays([w, _joined_values(form, ids, ends)]) for form, w in zip(forms, words, strict=True)]
            stops = np.append(0, np.cumsum(sizes.to_numpy(), dtype=np.int64))
            lengths = np.append(0, np.cumsum(counts[numbers.to_numpy()]))[stops]
            if digests:
                # Each id ends with a comma, the last one's isn't digested.
                columns = [pa.array(np.diff(lengths)), *(_sha256(w, numbers, stops, last) for w, last in zip(words, (1, 0), strict=True))]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                data, offsets = taken(words[0], numbers)
                columns = [pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.frombuffer(data, "<i4", int(offsets[-1]) // 4)))]
                names = ["ids"]
            yield pa.RecordBatch.from_arrays([doc_id, *columns], ["doc_id", *names])
    del words
    trim()


def _joined_values(form: pa.LargeBinaryArray | None, ids: pa.Array, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The forms of ``ids``, or without one their 32 bits, joined up to each of ``ends``."""
    if form is None:
        return binaries(ids.to_numpy(), ends * 4)
    data, offsets = taken(form, ids)
    return binaries(data, offsets[ends])


def _sha256(values: pa.LargeBinaryArray, numbers: pa.Array, stops: np.ndarray, last: int) -> pa.Array:
    """Digests of the values of ``numbers``, joined up to each of ``stops``, without the
    ``last`` bytes."""
    data, offsets = taken(values, numbers)
    data, ends = memoryview(data), offsets[stops].tolist()
    return pa.array([hashlib.sha256(data[a : max(a, b - last)]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)], pa.string())


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) for each row; with ``digests`` (doc_id, n_tokens,
    ids_sha256, decoded_sha256) in place of ids. ``path``: a file of ranks that
    every machine has."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text").mapInArrow(partial(_cut, path=path, pattern=pattern), ROWS_OF_CUT.format(id=id_type))
    fold = F.expr(f"transform(words, w -> {fold_sql('w')})")
    folded = cut.crossJoin(join_table(read_ranks(path)).row(spark)).select(*cut.columns[:-1], fold.alias("words"))
    out = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return folded.mapInArrow(partial(_fill, path=path, digests=digests), f"doc_id {id_type}, {out}")

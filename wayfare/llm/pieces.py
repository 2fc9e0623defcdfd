"""SentencePiece encoding and decoding with byte offsets.

Encoding runs in two steps. Normalisation replaces, at each position, the longest prefix the compiled
character map knows, and records for every byte it writes where in the source it came from. Merging then
joins the best-scored neighbours, as the model's merge list says; the bytes of each piece are projected
through the recorded alignment to a span of the original text.

Pieces cannot reach over a place where no piece of the vocabulary does, so a text is merged in chunks. Texts are
taken by the megabyte: their chunks are looked up in a hash table over arrays, and compared with what it holds; those
not remembered are merged side by side, a merge in each of them per round. Of the chunks seen before, those used most
are remembered up to a bound. Memory depends on the longest text, not on the table.

Defined results: a null text is taken as empty and has no pieces; a character outside the vocabulary
becomes its bytes if the model has byte pieces, else the unknown piece. Rows are independent, so repeated
rows get equal results and columns beside the text are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import operator
import random
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import functions as F

SPACE = "▁"

#: distinct chunks a task remembers; when there are more, the half that was used most stays
REMEMBERED = 200_000

#: bytes of text encoded at once, or one text
AT_ONCE = 1 << 19

#: a merge in a chunk up to this many characters looks at all neighbours; longer ones keep a heap
_SHORT = 48
#: so many chunks are merged side by side; fewer one by one
_MANY = 64
_NO_PIECE = -math.inf

# Field numbers and piece types of the model file.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie over bytes, whose leaves point into replacement strings."""

    def __init__(self, compiled: bytes):
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self._units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
            self._strings = compiled[4 + size :]
        else:
            self._units, self._strings = [], b""

    def __bool__(self) -> bool:
        return bool(self._units)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, start: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of ``text[start:]``."""
        units, found = self._units, None
        node = self._offset(units[0])
        for at in range(start, len(text)):
            node ^= text[at]
            unit = units[node]
            if unit & 0x800000FF != text[at]:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                found = units[node] & 0x7FFFFFFF, at + 1 - start
        if found is None:
            return None
        end = self._strings.index(b"\0", found[0])
        return self._strings[found[0] : end], found[1]


class Normalizer:
    """Text to normalised bytes, and for each of them (and the end) its offset in the source."""

    def __init__(self, spec: bytes):
        values = dict(_fields(spec))
        self.map = CharacterMap(values.get(2, b""))
        self.add_prefix = bool(values.get(3, 1))
        self.squeeze = bool(values.get(4, 1))
        self.escape = bool(values.get(5, 1))
        self.space = SPACE.encode() if self.escape else b" "

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if self.map or self.squeeze:
            return self._by_prefix(text)
        if not text:
            return b"", np.zeros(1, np.int64)
        prefix = self.space if self.add_prefix else b""
        width = np.ones(len(text) + 1, np.int64)
        width[:-1][np.frombuffer(text, np.uint8) == 32] = len(self.space)
        aligned = np.repeat(np.arange(len(text) + 1), width)
        return (
            prefix + text.replace(b" ", self.space),
            np.concatenate([np.zeros(len(prefix), np.int64), aligned]),
        )

    def _by_prefix(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, offsets = bytearray(), []

        def put(piece: bytes, source: int) -> None:
            out.extend(piece)
            offsets.extend([source] * len(piece))

        at, blank, pending_prefix = 0, self.squeeze, self.add_prefix
        leading = self.squeeze
        while at < len(text):
            new, taken = (self.map.longest(text, at) if self.map else None) or self._character(text, at)
            if leading and new == b" ":
                at += taken
                continue
            leading = False
            if pending_prefix:
                put(self.space, at)
                pending_prefix = False
            if blank:
                new = new.lstrip(b" ")
            if new:
                put(new.replace(b" ", self.space), at)
                blank = self.squeeze and new.endswith(b" ")
            at += taken
        end = len(text)
        if self.squeeze:
            while out.endswith(self.space):
                end = offsets[-len(self.space)]
                del out[-len(self.space) :], offsets[-len(self.space) :]
        return bytes(out), np.array([*offsets, end], np.int64)

    @staticmethod
    def _character(text: bytes, at: int) -> tuple[bytes, int]:
        lead = text[at]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return text[at : at + size], size


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, ...``, ``count[k]`` numbers for each ``k``."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number, and what undoes them, in 64 bits."""
    return tuple(np.cumprod(np.full(n, x, np.uint64)) for x in (base, pow(base, -1, 1 << 64)))


def _string(points: np.ndarray) -> str:
    return points.tobytes().decode("utf-32-le")


class _Table:
    """Numbers by keys of 63 bits: a hash table over arrays, asked for many keys at once."""

    def __init__(self, room: int):
        bits = max(4, (3 * room).bit_length())
        self._shift, self._mask, self._stored = np.uint64(64 - bits), (1 << bits) - 1, 0
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).view(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys, none of which is there."""
        if 2 * (self._stored + len(keys)) > self._mask:
            old = self._keys >= 0
            keys, values = np.concatenate([self._keys[old], keys]), np.concatenate([self._values[old], values])
            self.__init__(len(keys))
        self._stored += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self._keys[slots] < 0
            self._keys[slots[free]] = keys[free]  # of several for one slot one is stored
            stored = self._keys[slots] == keys
            self._values[slots[stored]] = values[stored]
            keys, values, slots = keys[~stored], values[~stored], slots[~stored] + 1 & self._mask

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for other keys."""
        slots = self._slots(keys)
        found = self._keys[slots]
        values = np.where(found == keys, self._values[slots], np.int32(-1))
        other = np.flatnonzero((found != keys) & (found >= 0))
        slots = slots[other]
        while len(other):
            slots = slots + 1 & self._mask
            found = self._keys[slots]
            hit = found == keys[other]
            values[other[hit]] = self._values[slots[hit]]
            on = ~hit & (found >= 0)
            other, slots = other[on], slots[on]
        return values


class PieceEncoder:
    """Encoder of one model; texts are UTF-8 bytes."""

    def __init__(self, model: bytes):
        self._score: dict[str, float] = {}
        self._id: dict[str, int] = {}
        self._bytes: dict[int, int] = {}
        self._unknown = 0
        kind, normalizer = 1, b""
        number = 0
        for field, value in _fields(model):
            if field == _PIECE:
                piece = dict(_fields(value))
                name, role = piece[1].decode(), piece.get(3, _NORMAL)
                if role == _NORMAL:
                    self._id[name] = number
                    self._score[name] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
                elif role == _BYTE:
                    self._bytes[int(name[3:5], 16)] = number
                elif role == _UNKNOWN:
                    self._unknown = number
                elif role in (_USER_DEFINED, _UNUSED):
                    raise ValueError("user-defined and unused pieces are not supported")
                number += 1
            elif field == _TRAINER:
                kind = dict(_fields(value)).get(3, 1)
            elif field == _NORMALIZER:
                normalizer = value
        if kind != _BPE:
            raise ValueError("only models of the merging kind are supported")
        self.normalize = Normalizer(normalizer)
        self._size = {name: len(name.encode()) for name in self._id}
        self._kind = self._kinds()
        self._pairs = self._joined()
        self._piece_size, self._rank = np.zeros(number, np.int32), np.zeros(number + 1, np.int64)
        own = np.fromiter(self._id.values(), np.int64, len(self._id))
        self._piece_size[own] = np.fromiter(map(self._size.__getitem__, self._id), np.int64, len(own))
        # the best score has rank 0; the last place is for no piece at all, which is -1
        scores = np.fromiter(map(self._score.__getitem__, self._id), np.float64, len(own))
        self._rank[own] = np.unique(-scores, return_inverse=True)[1]
        self._rank[-1] = number
        single = {ord(name): own for name, own in self._id.items() if len(name) == 1}
        self._character = np.full(max(single, default=0) + 2, -1, np.int32)
        self._character[list(single)] = list(single.values())
        self._draw = random.Random(0)
        self._long: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self._long_characters = 0
        self._forget()

    def _kinds(self) -> np.ndarray:
        """By code point: 0 for characters that stand alone in the vocabulary, 2 for spaces if no piece has one after
        another character, else 1. No piece reaches over either side of the first or to the front of a space."""
        long = [piece for piece in self._id if len(piece) > 1]
        joined = [ord(c) for c in {c for piece in long for c in piece} | {SPACE}]
        kinds = np.zeros(max(joined) + 2, np.uint8)
        kinds[joined] = 1
        kinds[ord(SPACE)] = 1 if any(SPACE in piece.lstrip(SPACE) for piece in long) else 2
        return kinds

    def _joined(self) -> _Table:
        """The piece that two neighbouring pieces become."""
        pairs = [
            (self._id[piece[:cut]] << 32 | self._id[piece[cut:]], number)
            for piece, number in self._id.items()
            for cut in range(1, len(piece))
            if piece[:cut] in self._id and piece[cut:] in self._id
        ]
        table = _Table(len(pairs))
        table.add(*np.array(pairs, np.int64).reshape(-1, 2).T)
        return table

    def _forget(self) -> None:
        """Forget all chunks, and make keys in another way from now on."""
        self._base = self._draw.getrandbits(64) | 1
        self._powers = _powers(self._base, AT_ONCE + AT_ONCE // 4)
        self._table = _Table(REMEMBERED)
        # of each remembered chunk its key, its place in the characters, its length, its place in the ids, how many
        # they are, and how often it came
        self._key = self._begin = self._width = self._first = self._count = self._used = np.zeros(0, np.int64)
        self._points, self._ids, self._sizes = np.zeros(0, np.uint32), *np.zeros((2, 0), np.int32)

    def encode(self, text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Piece ids, and start and end of each piece in the bytes of the text."""
        ids, starts, ends, _ = self.encode_many([text])
        return ids.tolist(), starts, ends

    def encode_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and ends of the pieces of all texts in a row, and the edges of the texts among them."""
        aligned, normals = [], []
        for text in texts:
            normal, offsets = self.normalize(text)
            normals.append(normal.decode())
            aligned.append(offsets)
        points = np.frombuffer("".join(normals).encode("utf-32-le"), np.uint32)
        begin, last_chunk = self._cut(points, np.cumsum([0, *map(len, normals)]))
        width = np.diff(begin, append=len(points))
        short = width <= _SHORT
        if short.all():
            numbers = self._find(points, width)
            first, count, all_ids, all_sizes = self._first, self._count, self._ids, self._sizes
        else:
            numbers = np.empty(len(width), np.int64)
            numbers[short] = self._find(points[np.repeat(short, width)], width[short])
            # those of long chunks behind all others
            numbers[~short] = len(self._first) + np.arange(len(width) - short.sum())
            long = [self._long_pieces(points[a : a + n]) for a, n in zip(begin[~short], width[~short])]
            more = np.array([len(ids) for ids, _ in long])
            first = np.concatenate([self._first, len(self._ids) + np.cumsum(more) - more])
            count = np.concatenate([self._count, more])
            all_ids = np.concatenate([self._ids, *(np.array(ids, np.int32) for ids, _ in long)])
            all_sizes = np.concatenate([self._sizes, *(np.array(sizes, np.int32) for _, sizes in long)])
        self._used += np.bincount(numbers[short], minlength=len(self._used))
        count = count[numbers]
        places = _ranges(first[numbers], count)
        ids, sizes = all_ids[places], all_sizes[places]
        edges = np.concatenate([[0], np.cumsum(count)])[last_chunk]
        # the alignment of each text has one place more than the text has normalised bytes
        ends = np.cumsum(sizes, dtype=np.int64) + np.repeat(np.arange(len(texts)), np.diff(edges))
        offsets = np.concatenate(aligned) if aligned else np.zeros(0, np.int64)
        starts, ends = offsets[ends - sizes], offsets[ends]
        if len(self._key) > REMEMBERED:
            self._keep_most_used()
        return ids, starts, ends, edges

    def _cut(self, points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks begin, and how many begin before each edge of a text."""
        kind = self._kind[np.minimum(points, len(self._kind) - 1)]
        cut = kind == 0
        cut[1:] |= (kind[:-1] == 0) | ((kind[1:] == 2) & (kind[:-1] != 2))
        cut[edges[edges < len(points)]] = True
        begin = np.flatnonzero(cut)
        return begin, np.searchsorted(begin, edges)

    def _find(self, points: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Numbers of chunks, which are remembered from now on."""
        begin = np.cumsum(width) - width
        while len(width):
            power, inverse = self._powers if len(points) <= len(self._powers[0]) else _powers(self._base, len(points))
            sums = np.add.reduceat(points * power[: len(points)], begin)
            keys = (sums * inverse[begin] & np.uint64((1 << 63) - 1)).view(np.int64)
            numbers = self._table(keys).astype(np.int64)
            new = np.flatnonzero(numbers < 0)
            if len(new):
                own, at, back = np.unique(keys[new], return_index=True, return_inverse=True)
                numbers[new] = len(self._key) + back
                at = new[at]
                self._learn(own, points[_ranges(begin[at], width[at])], width[at])
            if (self._width[numbers] == width).all():
                if (self._points[_ranges(self._begin[numbers], width)] == points).all():
                    return numbers
            self._forget()  # two chunks have the same key
        return np.zeros(0, np.int64)

    def _learn(self, keys: np.ndarray, points: np.ndarray, width: np.ndarray) -> None:
        """Remember chunks and their pieces."""
        begin = np.cumsum(width) - width
        many = self._merge_many if len(width) >= _MANY else self._merge_none
        merged, first, count, ids, sizes = many(points, width)
        rest = [self._pieces(_string(points[begin[k] : begin[k] + width[k]])) for k in np.flatnonzero(~merged)]
        first[~merged] = len(ids) + np.cumsum([0, *(len(own) for own, _ in rest)])[:-1]
        count[~merged] = [len(own) for own, _ in rest]
        ids, sizes = (
            np.concatenate([done, np.array([x for own in rest for x in own[k]], np.int32)]) for k, done in enumerate((ids, sizes))
        )
        self._table.add(keys, np.arange(len(self._key), len(self._key) + len(keys), dtype=np.int32))
        more = (keys, begin + len(self._points), width, first + len(self._ids), count, np.zeros(len(keys), np.int64), points, ids, sizes)
        self._key, self._begin, self._width, self._first, self._count, self._used, self._points, self._ids, self._sizes = (
            np.concatenate(both) for both in zip(self._remembered(), more)
        )

    def _remembered(self) -> tuple[np.ndarray, ...]:
        return self._key, self._begin, self._width, self._first, self._count, self._used, self._points, self._ids, self._sizes

    def _keep_most_used(self) -> None:
        """Forget all but half as many chunks as may be remembered; uses count half from now on."""
        kept = np.sort(np.argsort(-self._used, kind="stable")[: REMEMBERED // 2])
        self._key, self._width, self._count, self._used = self._key[kept], self._width[kept], self._count[kept], self._used[kept] // 2
        self._points = self._points[_ranges(self._begin[kept], self._width)]
        places = _ranges(self._first[kept], self._count)
        self._ids, self._sizes = self._ids[places], self._sizes[places]
        self._begin, self._first = np.cumsum(self._width) - self._width, np.cumsum(self._count) - self._count
        self._table = _Table(REMEMBERED)
        self._table.add(self._key, np.arange(len(kept), dtype=np.int32))

    def _long_pieces(self, points: np.ndarray) -> tuple[tuple[int, ...], tuple[int, ...]]:
        chunk = _string(points)
        known = self._long.get(chunk)
        if known is None:
            known = self._pieces(chunk)
            self._long_characters += len(chunk)
            if self._long_characters > AT_ONCE:
                self._long.clear()
                self._long_characters = len(chunk)
            if len(chunk) <= AT_ONCE:
                self._long[chunk] = known
        return known

    @staticmethod
    def _merge_none(points: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
        none = np.zeros(0, np.int32)
        return np.zeros(len(width), bool), *np.zeros((2, len(width)), np.int64), none, none

    def _merge_many(self, points: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chunks whose characters are all pieces, merged side by side: which ones, and for these the place and the
        number of their ids, the ids, and their sizes.

        In each round the best pair of every chunk is joined, the first of equally good ones; chunks without a pair
        are done and leave.
        """
        parts = self._character[np.minimum(points, len(self._character) - 1)]
        merged = np.minimum.reduceat(parts, np.cumsum(width) - width) >= 0
        n_chunks = len(width)
        if not merged.any():
            return self._merge_none(points, width)
        parts, who, width = parts[np.repeat(merged, width)], np.flatnonzero(merged), width[merged]
        pairs = np.full(len(parts), -1, np.int32)
        pairs[:-1] = self._pairs(parts[:-1].astype(np.int64) << 32 | parts[1:])
        pairs[np.cumsum(width) - 1] = -1
        first, count = np.zeros((2, n_chunks), np.int64)
        done, n_done = [], 0
        none = int(self._rank[-1]) << 32
        while len(who):
            start = np.cumsum(width) - width
            best = np.minimum.reduceat((self._rank[pairs] << 32) + np.arange(len(pairs)), start)
            on = best < none
            stay = np.repeat(on, width)
            if not on.all():
                ready = ~on
                count[who[ready]] = width[ready]
                first[who[ready]] = n_done + np.cumsum(width[ready]) - width[ready]
                done.append(parts[~stay])
                n_done += len(done[-1])
            place = best[on] & 0xFFFFFFFF
            parts[place] = pairs[place]
            stay[place + 1] = False
            parts, pairs = parts[stay], pairs[stay]
            place -= start[on]
            who, width = who[on], width[on] - 1
            # the pairs that begin and end with what was joined are new
            start = np.cumsum(width) - width
            after, before = place + 1 < width, place > 0
            place += start
            pairs[place[~after]] = -1
            at = np.concatenate([place[after], place[before] - 1])
            pairs[at] = self._pairs(parts[at].astype(np.int64) << 32 | parts[at + 1])
        ids = np.concatenate(done)
        return merged, first, count, ids, self._piece_size[ids]

    def _pieces(self, chunk: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        parts = self._merge_short(chunk) if len(chunk) <= _SHORT else self._merge_long(chunk)
        try:
            return tuple(map(self._id.__getitem__, parts)), tuple(map(self._size.__getitem__, parts))
        except KeyError:
            pass  # a character outside the vocabulary
        ids: list[int] = []
        sizes: list[int] = []
        for part in parts:
            data = part.encode()
            if part in self._id:
                ids.append(self._id[part])
                sizes.append(len(data))
            elif self._bytes:
                ids += [self._bytes[byte] for byte in data]
                sizes += [1] * len(data)
            else:
                ids.append(self._unknown)
                sizes.append(len(data))
        return tuple(ids), tuple(sizes)

    def _merge_short(self, chunk: str) -> list[str]:
        """The scores of all neighbours are kept in a list; a merge changes one or two of them."""
        parts, score = list(chunk), self._score.get
        # at each place the score of the pair that begins there
        pairs = list(map(score, map(operator.add, chunk, chunk[1:]), itertools.repeat(_NO_PIECE)))
        while pairs:
            best = max(pairs)
            if best == _NO_PIECE:
                break
            place = pairs.index(best)
            joined = parts[place] + parts[place + 1]
            parts[place] = joined
            del parts[place + 1], pairs[place]
            if place:
                pairs[place - 1] = score(parts[place - 1] + joined, _NO_PIECE)
            if place < len(pairs):
                pairs[place] = score(joined + parts[place + 1], _NO_PIECE)
        return parts

    def _merge_long(self, chunk: str) -> list[str]:
        score, size = self._score, len(chunk)
        parts: list[str] = list(chunk)
        left, right = list(range(-1, size - 1)), [*range(1, size), -1]
        heap: list[tuple[float, int, str]] = []

        def offer(at: int) -> None:
            if at >= 0 and right[at] >= 0:
                joined = parts[at] + parts[right[at]]
                if joined in score:
                    heapq.heappush(heap, (-score[joined], at, joined))

        for at in range(size):
            offer(at)
        while heap:
            _, at, joined = heapq.heappop(heap)
            # a part that was merged away is empty; one that grew no longer makes this pair
            other = right[at]
            if not parts[at] or other < 0 or parts[at] + parts[other] != joined:
                continue
            parts[at], parts[other] = joined, ""
            right[at] = right[other]
            if right[at] >= 0:
                left[right[at]] = at
            offer(left[at])
            offer(at)
        return [part for part in parts if part]


_loaded: dict[bytes, tuple[PieceEncoder, sentencepiece.SentencePieceProcessor]] = {}


def _codec(model: bytes) -> tuple[PieceEncoder, sentencepiece.SentencePieceProcessor]:
    """Encoder and decoder of a model, made once in each worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded[key] = PieceEncoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    return _loaded[key]


def _groups(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts in a row, ``AT_ONCE`` bytes or one text at a time; nulls are empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(ends):
        most = AT_ONCE + (ends[at - 1] if at else 0)
        end = max(at + 1, int(np.searchsorted(ends, most, side="right")))
        yield [text or b"" for text in texts.slice(at, end - at).to_pylist()]
        at = end


class _Written:
    """Ids in decimals, with commas between them, as digests of each text's."""

    def __init__(self, n_ids: int):
        names = [f"{number},".encode() for number in range(n_ids)]
        self._size = np.array(list(map(len, names)), np.int64)
        self._name = np.array(names, f"S{max(map(len, names))}")
        self._name = self._name.view(np.uint8).reshape(n_ids, -1)

    def sha256(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        letters = self._name[ids].ravel()
        written = letters[letters > 0]
        at = np.concatenate([[0], np.cumsum(self._size[ids])])[edges].tolist()
        return [hashlib.sha256(written[a : max(a, b - 1)]).hexdigest() for a, b in itertools.pairwise(at)]


def _decoded_sha256(decoder: sentencepiece.SentencePieceProcessor, ids: np.ndarray, edges: np.ndarray) -> list[str]:
    numbers = ids.tolist()
    texts = (decoder.decode(numbers[a:b]) if a < b else "" for a, b in itertools.pairwise(edges.tolist()))
    return [hashlib.sha256(text.encode()).hexdigest() for text in texts]


def _lists(flat: np.ndarray, sizes: list[int], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat, kind))


def encode_udf(model: bytes):
    """Column function of a binary text: struct of ``ids``, ``starts`` and ``ends`` (byte offsets)."""

    @F.arrow_udf("struct<ids: array<int>, starts: array<long>, ends: array<long>>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, _ = _codec(model)
        for batch in texts:
            ids, starts, ends, sizes = array("i"), array("q"), array("q"), []
            for group in _groups(batch):
                *columns, edges = encoder.encode_many(group)
                for column, values in zip((ids, starts, ends), columns):
                    column.frombytes(values.tobytes())
                sizes += np.diff(edges).tolist()
            yield pa.StructArray.from_arrays(
                [
                    _lists(np.frombuffer(ids, np.int32), sizes, pa.int32()),
                    _lists(np.frombuffer(starts, np.int64), sizes, pa.int64()),
                    _lists(np.frombuffer(ends, np.int64), sizes, pa.int64()),
                ],
                ["ids", "starts", "ends"],
            )

    return encode


def decode_udf(model: bytes):
    """Column function of piece ids: the text; null for null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, decoder = _codec(model)
        for batch in batches:
            yield pa.array([None if ids is None else decoder.decode(ids) for ids in batch.to_pylist()])

    return decode


def round_trip_udf(model: bytes):
    """Column function of a binary text: encodes and decodes without passing the ids on.

    ``covered_bytes`` is how much of the text the spans of its pieces cover, which is all of it unless the
    normaliser drops something.
    """

    @F.arrow_udf("struct<n_tokens: long, ids_sha256: string, decoded_sha256: string, covered_bytes: long>")
    def round_trip(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _codec(model)
        written = _Written(decoder.get_piece_size())
        for batch in texts:
            sizes, digests, decoded, covered = [], [], [], []
            for group in _groups(batch):
                ids, starts, ends, edges = encoder.encode_many(group)
                sizes += np.diff(edges).tolist()
                digests += written.sha256(ids, edges)
                decoded += _decoded_sha256(decoder, ids, edges)
                covered += np.diff(np.concatenate([[0], np.cumsum(ends - starts)])[edges]).tolist()
            yield pa.StructArray.from_arrays(
                [
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded, pa.string()),
                    pa.array(covered, pa.int64()),
                ],
                ["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"],
            )

    return round_trip


def tokens_udf(model: bytes):
    """Column function of a binary text: struct of ``ids`` and of digests of them and of what they decode to."""

    @F.arrow_udf("struct<ids: array<int>, ids_sha256: string, decoded_sha256: string>")
    def tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _codec(model)
        written = _Written(decoder.get_piece_size())
        for batch in texts:
            # four bytes an id while the batch is made, not a list of numbers
            flat, sizes, digests, decoded = array("i"), [], [], []
            for group in _groups(batch):
                ids, _, _, edges = encoder.encode_many(group)
                flat.frombytes(ids.tobytes())
                sizes += np.diff(edges).tolist()
                digests += written.sha256(ids, edges)
                decoded += _decoded_sha256(decoder, ids, edges)
            yield pa.StructArray.from_arrays(
                [
                    _lists(np.frombuffer(flat, np.int32), sizes, pa.int32()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["ids", "ids_sha256", "decoded_sha256"],
            )

    return tokens

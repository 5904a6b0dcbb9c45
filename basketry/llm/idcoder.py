"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks that know nothing of each other: the model starts
afresh in each, and each carries a checksum, so any block can be read alone.
Blocks run side by side in numpy arrays, one lane per block; integers only, so
every machine decodes what another has coded.

Per id the model has predictions of three orders: the id that last followed the
previous two ids (order 2), the one that last followed the previous id (order
1), and, of order 0, the list of the block's ids by first appearance, where
common ids come early.  One symbol says which prediction is right or, if none
is, in which class of ranks of the list, or of new ids, the id lies.  Its
distribution mixes an adaptive one given both orders' records of hits, whether
they agree and whether the id before was predicted, with that of all contexts
together, by adding their counts; the sums are brought up to date every few
steps.  The place in the class follows as plain bits in the same coding step, so
an id takes a single one.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
MAGIC = b"TIDB"
_HEADER = struct.Struct("<4sBBHIII")  # magic, version, whether ids pass 16 bits, 0, ids, words, crc32 of ids
_CHECK = struct.Struct("<I")  # crc32 of the header and the words, between them
_BODY = _HEADER.size + _CHECK.size
_VERSION = 4

_WORD = np.uint64(32)
_LOW32 = np.uint64((1 << 32) - 1)
_FULL = np.uint64(1 << 32)

_ROW = 16
#: Symbols 0 and 1: order 2 or 1 is right; from 2: a class of ranks in the
#: list; from 11: a class of new ids, the last for those from 65,536 on (16
#: upper bits, and 16 lower ones in a step of their own).
_LISTED, _NEW, _WIDE = 2, 11, 14
#: First rank or id of each symbol's class, and its number of plain bits.
_BASE = np.array([0, 0, 0, 16, 32, 64, 128, 256, 512, 1024, 2048, 0, 4096, 16384, 0], np.int64)
_BITS = np.array([0, 0, 4, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 16], np.uint64)
#: Ranks of the list; ids that are new when it is full are not listed.
_RANKS = 4096


def _codes(first: int, last: int, count: int) -> np.ndarray:
    """16 * place in the class + symbol of numbers in the classes first to last."""
    value = np.arange(count)
    symbol = np.searchsorted(_BASE[first:last], value, side="right") + first - 1
    return ((value - _BASE[symbol]) << 4 | symbol).astype(np.uint32)


_RANK_CODE = _codes(_LISTED, _NEW, _RANKS)
_ID_CODE = _codes(_NEW, _WIDE, 1 << 16)
#: Blocks whose codes are put side by side at once.
_RANKED = 32
#: Steps between two looks at the room for coded words.
_ROOM_STEPS = 64

#: Slots a lane for predictions of order 1 and 2.
_SLOTS = (1 << 11, 1 << 12)
_SHIFTS = np.array([[5], [4]], np.uint16)
#: Contexts of the distributions, by record of order 1, 4 * record of order 2,
#: 16 if both agree (then order 1's record counts for little: whether it has
#: hits), 32 if the id before was predicted.
_CONTEXT = np.array([c for late in (0, 24) for c in [*range(late, late + 16), *(late + 16 + 2 * (r >> 2) + (r & 3 > 1) for r in range(16))]])
_CONTEXTS = 48
#: Weight of an id counted in the context, and how many ids all others weigh.
_WEIGHT, _SHARED = 12, 12
#: Steps between two looks at the counts; steps counted when they are halved.
_SPAN, _LIMIT = 64, 2048
#: Four counts of 16 bits in a 64-bit number times this are their running sums.
_SUMS_OF_4 = np.uint64(0x0001000100010001)
_LAST_OF_4 = np.uint64(48)
_ONES_OF_8, _LAST_OF_8 = np.uint64(0x0101010101010101), np.uint64(56)


class CorruptBlock(ValueError):
    """A block's header, length or checksum is wrong."""


class _Coder:
    """Range coder state of all lanes.  A lane whose range falls below 2^32
    gives out (or takes in) 32 bits.  The encoder's 64-bit ``low`` can carry
    into words given out before; the decoder keeps how far the code is above
    it, and needs no ``low``."""

    def __init__(self, lanes: int, words: np.ndarray | None, room: int):
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)
        self.decoding = words is not None
        self.words = np.zeros((lanes, room), np.uint32) if words is None else words
        self._flat()
        #: Where the next word of each lane is among the words of all lanes.
        self.at = self.first.copy()
        if self.decoding:
            self.above = (self.words[:, 0].astype(np.uint64) << _WORD) | self.words[:, 1]
            self.at += 2
        else:
            self.low = np.zeros(lanes, np.uint64)

    def _flat(self) -> None:
        self.flat = self.words.reshape(-1)
        self.first = np.arange(self.words.shape[0]) * self.words.shape[1]

    def move(self, n: int, by: np.ndarray) -> None:
        """Raise the lower ends of the first ``n`` lanes."""
        if self.decoding:
            self.above[:n] -= by
            return
        low = self.low[:n]
        low += by
        if (few := (low < by).nonzero()[0]).size:
            at = self.at.take(few)
            while at.size:
                at -= 1
                carried = self.flat.take(at) + np.uint32(1)
                self.flat[at] = carried
                at = at[carried == 0]

    def put(self, n: int, span: np.ndarray) -> None:
        """The new ranges of the first ``n`` lanes."""
        few = (span < _FULL).nonzero()[0]
        if few.size:
            at = self.at.take(few)
            if self.decoding:
                self.above[few] = (self.above.take(few) << _WORD) | self.flat.take(at)
            else:
                low = self.low.take(few)
                self.flat[at] = low >> _WORD
                self.low[few] = low << _WORD
            span[few] = span.take(few) << _WORD
            at += 1
            self.at[few] = at
        self.range[:n] = span

    def plain(self, n: int, few: np.ndarray, value: np.ndarray | None) -> np.ndarray:
        """16 plain bits of the lanes ``few`` of the first ``n``."""
        span = self.range[:n].copy()
        unit = span[few] >> np.uint64(16)
        if value is None:
            value = self.above[few] // unit
        by = np.zeros(n, np.uint64)
        by[few] = unit * value
        self.move(n, by)
        span[few] = unit
        self.put(n, span)
        return value

    def make_room(self, words: int) -> None:
        """Encoding: every lane can give out so many words more."""
        used = self.at - self.first
        if int(used.max()) + words > self.words.shape[1]:
            more = np.zeros((self.words.shape[0], self.words.shape[1] // 2 + words), np.uint32)
            self.words = np.concatenate((self.words, more), axis=1)
            self._flat()
            self.at = self.first + used

    def finish(self) -> np.ndarray:
        """Encoding: the number of words of each lane."""
        self.make_room(2)
        for shift in (32, 0):
            self.flat[self.at] = (self.low >> np.uint64(shift)) & _LOW32
            self.at += 1
        return self.at - self.first


class _Model:
    """Tables are flat, with a part for each lane.  The arrays of a step are
    short, so it is the number of numpy calls that counts, and that of reads
    from tables larger than the caches: what belongs to both orders is one
    array with a row for each.

    The distributions in use are made anew from the counts at steps known
    beforehand, and counts are halved at others, so that a step only notes
    which count it adds to."""

    def __init__(self, lanes: int, wide: bool, decoding: bool):
        self.wide = wide
        self.kind = kind = np.uint64 if wide else np.uint32
        #: Predicted at first: no id, so an id is new when it first comes.
        none = 1 << (32 if wide else 16)
        #: Predictions of order 1 and 2, as 16 * id + record of hits: 0 to 3,
        #: or 4 times that for order 2.
        self.guess = np.full(lanes * sum(_SLOTS), none << 4, kind)
        lane = np.arange(lanes)
        self.slots = lane * sum(_SLOTS) + np.array([[0], [_SLOTS[0]]])
        self.hit, self.most = (np.array([[x], [4 * x]], kind) for x in (1, 3))
        #: By context, lane and symbol + 1: counts, and where the symbol's part ends.
        self.counts = np.zeros(_CONTEXTS * lanes * _ROW, "<u2")
        self.ends = np.empty_like(self.counts)
        self.noted = np.empty((_SPAN, lanes), np.int64)
        self.spans = [0] * _SPAN
        self.steps = self.pending = self.seen = 0
        self.row = _CONTEXT * (lanes * _ROW)
        self.own = lane * _ROW
        self._mix()
        if decoding:
            self.listed = np.zeros(lanes * _RANKS, np.uint32 if wide else np.uint16)
            self.lists = lane * _RANKS
            self.length = np.zeros(lanes, np.int64)
        #: Hashes of the previous id and of the previous two; what the previous
        #: id adds to the next hash of two.
        self.hash, self.before = np.zeros((2, lanes), np.uint16), np.zeros(lanes, np.uint16)
        self.latest, self.late, self.agree = np.zeros(lanes, kind), kind(32), kind(16)

    def _mix(self) -> None:
        """The distributions in use: each context's counts, and those of all
        contexts together at the weight of a few ids."""
        counts = self.counts.reshape(_CONTEXTS, -1)
        shared = np.add.reduce(counts, axis=0, dtype=np.uint32)
        shared *= _WEIGHT * _SHARED
        shared //= max(1, self.seen)
        shared += 1
        shared[::_ROW] = 0
        ends = self.ends.reshape(_CONTEXTS, -1)
        np.multiply(counts, np.uint16(_WEIGHT), out=ends)
        ends += shared.astype(np.uint16)
        packed = self.ends.view("<u8")
        packed *= _SUMS_OF_4
        packed = packed.reshape(-1, _ROW // 4)
        for k in range(1, _ROW // 4):
            packed[:, k] += (packed[:, k - 1] >> _LAST_OF_4) * _SUMS_OF_4

    def _note(self, n: int, place: np.ndarray) -> None:
        """Count a step's symbols, at their places among the counts."""
        self.noted[self.pending, :n] = place
        self.spans[self.pending] = n
        self.steps += 1
        self.pending += 1
        # after 1, 2, 4, 8, ... steps, and then after each _SPAN
        if self.pending == _SPAN or self.steps < _SPAN and self.steps & (self.steps - 1) == 0:
            places = np.concatenate([self.noted[i, :k] for i, k in enumerate(self.spans[: self.pending])])
            np.add.at(self.counts, places, np.uint16(1))
            self.seen += self.pending
            self.pending = 0
            if self.seen >= _LIMIT:
                self.counts >>= 1
                self.seen >>= 1
            self._mix()

    def _predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slots, what they hold, the ids predicted, where the context's
        distribution begins) of the first ``n`` lanes."""
        slot = self.slots[:, :n] + (self.hash[:, :n] >> _SHIFTS)
        held = self.guess.take(slot)
        guessed = held >> 4
        context = held[0] | held[1]
        context &= 15
        context += self.latest[:n]
        context += (guessed[0] == guessed[1]) * self.agree
        first = self.row.take(context)
        first += self.own[:n]
        return slot, held, guessed, first

    def _learn(self, n: int, slot: np.ndarray, held: np.ndarray, out: np.ndarray, late: np.ndarray) -> None:
        """The id just seen is the next prediction; a record counts the hits
        since the last miss."""
        new = out << 4
        held ^= new
        miss = held > 15
        held += self.hit
        np.minimum(held, self.most, out=held)
        np.putmask(held, miss, 0)
        held |= new
        self.guess[slot.reshape(-1)] = held.reshape(-1)
        np.multiply(late, self.late, out=self.latest[:n])
        short = (out ^ (out >> 16) if self.wide else out).astype(np.uint16)
        np.multiply(short, 40503, out=self.hash[0, :n])
        np.add(self.hash[0, :n], self.before[:n], out=self.hash[1, :n])
        np.multiply(short, 30011, out=self.before[:n])

    def encode(self, coder: _Coder, n: int, ids: np.ndarray, coded: np.ndarray) -> None:
        """Code one id of each of the first ``n`` lanes, by ``coded`` (see
        ``_unpredicted``) where no prediction is right."""
        slot, held, guessed, first = self._predict(n)
        right = guessed == ids
        np.putmask(coded, right[0], 1)
        np.putmask(coded, right[1], 0)
        symbol = (coded & 15).astype(np.int64)
        total = self.ends.take(first + (_ROW - 1))
        first += symbol
        start = self.ends.take(first)
        first += 1
        share = self.ends.take(first)
        share -= start
        unit = coder.range[:n] // total
        shift = unit * start
        unit *= share
        unit >>= _BITS.take(symbol)
        coded >>= 4
        shift += unit * coded
        coder.move(n, shift)
        coder.put(n, unit)
        if self.wide and (few := np.flatnonzero(symbol == _WIDE)).size:
            coder.plain(n, few, ids[few] & 0xFFFF)
        self._note(n, first)
        self._learn(n, slot, held, ids, symbol < _LISTED)

    def decode(self, coder: _Coder, n: int) -> np.ndarray:
        """The next id of each of the first ``n`` lanes."""
        slot, held, guessed, first = self._predict(n)
        rows = self.ends.reshape(-1, _ROW).take(first >> 4, axis=0)
        unit = coder.range[:n] // rows[:, -1]
        at = (coder.above[:n] // unit).astype(np.uint16)
        below = (rows <= at[:, None]).view("<u8")
        symbol = below[:, 0] + below[:, 1]
        symbol *= _ONES_OF_8
        symbol >>= _LAST_OF_8
        symbol = symbol.view(np.int64)
        first += symbol
        symbol -= 1
        share = self.ends.take(first)
        start = self.ends.take(first - 1)
        share -= start
        shift = unit * start
        unit *= share
        unit >>= _BITS.take(symbol)
        value = (coder.above[:n] - shift) // unit
        shift += unit * value
        coder.move(n, shift)
        coder.put(n, unit)
        full = _BASE.take(symbol)
        full += value.view(np.int64)
        # a rank's id; of no use, but harmless, for other symbols
        out = self.listed.take(full + self.lists[:n], mode="clip").astype(self.kind)
        new = (symbol >= _NEW).nonzero()[0]
        out[new] = full.take(new)
        late = symbol < _LISTED
        np.putmask(out, late, guessed[0])
        np.putmask(out, symbol == 0, guessed[1])
        if self.wide and (few := np.flatnonzero(symbol == _WIDE)).size:
            out[few] = (out[few] << 16) | coder.plain(n, few, None)
        rank = self.length.take(new)
        self.length[new] = rank + 1
        if self.steps >= _RANKS:
            new, rank = new[rank < _RANKS], rank[rank < _RANKS]
        rank += self.lists.take(new)
        self.listed[rank] = out.take(new)
        self._note(n, first)
        self._learn(n, slot, held, out, late)
        return out


def _unpredicted(ids: np.ndarray, latest: np.ndarray) -> np.ndarray:
    """16 * place in the class + symbol of each id of the block ``ids`` if no
    prediction is right.  The list holds a block's ids by first appearance,
    so it follows from the ids alone.  ``latest`` is room for a number an id
    of 16 bits, with any content."""
    of = ids if ids.dtype == np.uint16 else np.unique(ids, return_inverse=True)[1]
    if ids.size > latest.size:
        latest = np.empty(ids.size, np.int64)
    at = np.arange(ids.size)
    # of equal indexes the last one counts: the first place of each id
    latest[of[::-1]] = at[::-1]
    begin = latest.take(of)
    first = begin == at
    rank = np.cumsum(first).take(begin)
    rank -= 1
    out = _RANK_CODE.take(rank, mode="clip")
    if ids.size > _RANKS:
        first |= rank >= _RANKS
    new = first.nonzero()[0]
    out[new] = _new_code(ids.take(new))
    return out


def _new_code(ids: np.ndarray) -> np.ndarray:
    """As ``_unpredicted``, of ids that are not listed."""
    if ids.dtype == np.uint16:
        return _ID_CODE.take(ids)
    return np.where(ids >> 16 > 0, (ids >> 16) << 4 | _WIDE, _ID_CODE.take(ids & 0xFFFF)).astype(np.uint32)


def encode_blocks(ids: np.ndarray, block: int = BLOCK_IDS) -> list[bytes]:
    """Blocks of ``block`` ids (the last may be shorter) of the sequence
    ``ids`` of unsigned 32-bit integers, each coded on its own."""
    if ids.size == 0:
        return []
    lanes = -(-ids.size // block)
    last = ids.size - (lanes - 1) * block
    longest = min(block, ids.size)
    wide = int(ids.max()) >= 1 << 16
    steps = np.zeros((longest, lanes), np.uint64 if wide else np.uint32)
    steps[:, : lanes - 1] = ids[: (lanes - 1) * block].reshape(lanes - 1, block)[:, :longest].T
    steps[:last, lanes - 1] = ids[(lanes - 1) * block :]
    coded = np.empty((longest, lanes), np.uint32)
    narrow = ids.astype(np.uint32 if wide else np.uint16)
    latest = np.empty(1 << 16, np.int64)
    for i in range(0, lanes, _RANKED):
        parts = [_unpredicted(narrow[k : k + block], latest) for k in range(i * block, min((i + _RANKED) * block, ids.size), block)]
        if i + _RANKED >= lanes:
            coded[:last, lanes - 1] = parts.pop()
        if parts:
            coded[:, i : i + len(parts)] = np.stack(parts, axis=1)
    coder, model = _Coder(lanes, None, longest // 4 + 2 * _ROOM_STEPS), _Model(lanes, wide, False)
    for t in range(longest):
        n = lanes if t < last else lanes - 1
        if t % _ROOM_STEPS == 0:
            coder.make_room(2 * _ROOM_STEPS)
        model.encode(coder, n, steps[t, :n], coded[t, :n])
    plain = ids.astype("<u4")
    out = []
    for i, words in enumerate(coder.finish().tolist()):
        part = plain[i * block : (i + 1) * block]
        body = coder.words[i, :words].astype("<u4").tobytes()
        head = _HEADER.pack(MAGIC, _VERSION, wide, 0, part.size, words, zlib.crc32(part))
        out.append(head + _CHECK.pack(zlib.crc32(body, zlib.crc32(head))) + body)
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids (uint32) of each block, in any order and from any writer."""
    if not blocks:
        return []
    heads = []
    for b in blocks:
        if len(b) < _BODY or b[:4] != MAGIC or b[4] != _VERSION:
            raise CorruptBlock("not a block of token ids")
        heads.append(_HEADER.unpack_from(b))
        if len(b) != _BODY + 4 * heads[-1][5]:
            raise CorruptBlock("a block is cut short")
        if zlib.crc32(memoryview(b)[_BODY:], zlib.crc32(b[: _HEADER.size])) != _CHECK.unpack_from(b, _HEADER.size)[0]:
            raise CorruptBlock("a block's content is damaged")
    out: list[np.ndarray | None] = [None] * len(blocks)
    for wide in sorted({h[2] for h in heads}):
        # longest first, so that the lanes still running are the first ones
        order = sorted((i for i, h in enumerate(heads) if h[2] == wide), key=lambda i: -heads[i][4])
        sizes = np.array([heads[i][4] for i in order])
        words = np.zeros((len(order), max(heads[i][5] for i in order) + 2), np.uint32)
        for lane, i in enumerate(order):
            words[lane, : heads[i][5]] = np.frombuffer(blocks[i], "<u4", heads[i][5], _BODY)
        coder, model = _Coder(len(order), words, 0), _Model(len(order), bool(wide), True)
        ids = np.zeros((int(sizes[0]), len(order)), np.uint32)
        for t in range(ids.shape[0]):
            n = int(np.searchsorted(-sizes, -t, side="left"))
            ids[t, :n] = model.decode(coder, n)
        lanes = np.ascontiguousarray(ids.T)
        for lane, i in enumerate(order):
            got = lanes[lane, : sizes[lane]]
            if zlib.crc32(got.astype("<u4")) != heads[i][6]:
                raise CorruptBlock("a block's checksum is wrong")
            out[i] = got
    return out

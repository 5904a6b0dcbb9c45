"""Token ids of Arrow text columns by the ``tokenizers`` library.

Both vocabularies cut a text into pieces before any merge, so the ids of a
text are the ids of its chunks in order as long as every cut between chunks is
also a cut between pieces.  Chunks are found for a whole batch at once on the
bytes of the Arrow buffer; each distinct chunk is encoded by the library once
and its ids are kept in a bounded table keyed by the chunk's own bytes.  Texts
for which the cuts are not known to agree (characters beyond Latin letters,
mixed runs of white space) are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks kept per worker process (about 100 bytes each); a full
#: table goes on with those that have come again since it was last full.
KEPT_CHUNKS = 1 << 19
#: Chunks of up to so many bytes are keyed by 8-byte limbs, longer ones by a dict.
LIMBS = 3
#: Bytes of longer chunks kept.
LONG_BYTES = 64 << 20
_MARK = "<|endoftext|>"
#: A character other than line feed, printable ASCII and Latin letters and
#: signs (dotted capital I changes its length when lower-cased).
_ODD = "[^\n -~¡-įı-ɏ]"
#: White space whose pieces depend on what stands around a space.
_MIXED = "  |\n \n|\n $"

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: ASCII punctuation; the apostrophe is left out, it can begin a contraction.
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)] if b != 39]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_FULL_LIMB = np.uint64(1 << 56)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of each text and the end)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


class ChunkTable:
    """Chunk -> number, open addressing over arrays; and number -> ids."""

    def __init__(self, kept: int):
        self.kept = kept
        self.slots = 1 << max(4, (2 * kept - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros((LIMBS, self.slots), np.uint64)
        self.number = np.full(self.slots, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.count = 0
        self.begin, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        #: By number: whether a later call has found the chunk.
        self.again = np.zeros(1024, bool)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def trim(self) -> None:
        """Make room: forget all chunks but those that have come again, or
        all if these would fill half the table."""
        kept = np.flatnonzero(self.again[: self.count])
        if 2 * kept.size > self.kept:
            return self.clear()
        ids, _ = self.gather(kept)
        sizes = self.size[kept]
        number = np.full(self.count, -1, np.int32)
        number[kept] = np.arange(kept.size)
        slot = np.flatnonzero(self.number >= 0)
        number = number[self.number[slot]]
        key, number = self.key[:, slot[number >= 0]], number[number >= 0]
        self.clear()
        self.add(key, self.hash(key), number)
        self.store(ids, sizes)

    @staticmethod
    def hash(limbs: np.ndarray) -> np.ndarray:
        h = limbs[0] * _MIX[0]
        for i in range(1, LIMBS):
            h = (h ^ (h >> np.uint64(29))) + limbs[i] * _MIX[i]
        return (h ^ (h >> np.uint64(32))) * _MIX[0]

    def find(self, limbs: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Numbers, -1 where unknown."""
        out = np.full(h.size, -1, np.int32)
        slot = (h >> np.uint64(20)).astype(np.int64) & (self.slots - 1)
        at, first = np.arange(h.size), limbs[0]
        while at.size:
            n = self.number.take(slot)
            same = n >= 0
            same &= self.key[0].take(slot) == first
            # a chunk of fewer bytes than a limb has no more (no byte is zero)
            full = (same & (first >= _FULL_LIMB)).nonzero()[0]
            if full.size:
                equal, where = np.ones(full.size, bool), slot.take(full)
                for i in range(1, LIMBS):
                    equal &= self.key[i].take(where) == limbs[i].take(at.take(full))
                same[full] = equal
            out[at[same]] = n[same]
            more = (n >= 0) & ~same
            at, slot, first = at[more], (slot[more] + 1) & (self.slots - 1), first[more]
        return out

    def add(self, limbs: np.ndarray, h: np.ndarray, numbers: np.ndarray) -> None:
        slot = (h >> np.uint64(20)).astype(np.int64) & (self.slots - 1)
        at = np.arange(h.size)
        while at.size:
            taken = self.number[slot] >= 0
            first = np.zeros(at.size, bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & ~taken
            self.number[slot[put]] = numbers[at[put]]
            self.key[:, slot[put]] = limbs[:, at[put]]
            at, slot = at[~put], slot[~put]
            slot = np.where(self.number[slot] >= 0, (slot + 1) & (self.slots - 1), slot)

    def grow(self) -> None:
        old = self.number >= 0
        key, number = self.key[:, old], self.number[old]
        self.slots *= 2
        self.key = np.zeros((LIMBS, self.slots), np.uint64)
        self.number = np.full(self.slots, -1, np.int32)
        self.add(key, self.hash(key), number)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``numbers``, one after the other, and where each
        one's ids end."""
        n = self.size[numbers].astype(np.int64)
        ends = np.cumsum(n)
        index = np.repeat(self.begin[numbers] - (ends - n), n)
        index += np.arange(index.size)
        return self.ids[index], ends

    def store(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keep the ids of new chunks, of which each has its size; their numbers."""
        while self.used + flat.size > self.ids.size:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.count + sizes.size > self.begin.size:
            self.begin, self.size, self.again = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.size, self.again))
        new = slice(self.count, self.count + sizes.size)
        self.ids[self.used : self.used + flat.size] = flat
        self.begin[new] = self.used + np.cumsum(sizes) - sizes
        self.size[new] = sizes
        self.used += flat.size
        self.count = new.stop
        return np.arange(new.start, new.stop, dtype=np.int32)


class ChunkEncoder:
    """Numbers the distinct chunks of texts, exactly, and keeps each chunk's
    ids; subclasses say where chunks begin and how a new one is encoded."""

    def __init__(self, kept: int):
        self.table = ChunkTable(kept)

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and length of each chunk of the texts in ``data``; text
        i is data[bounds[i]:bounds[i + 1]]."""
        raise NotImplementedError

    def _encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def _encode_spans(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all these chunks of ``data``, one after the other, and
        the number of each one's ids."""
        text = data.tobytes()
        parts = self._encode_chunks([text[a:z].decode() for a, z in zip(starts.tolist(), (starts + sizes).tolist())])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.fromiter(map(len, parts), np.int64, len(parts))

    def _folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes that tell chunks apart."""
        return data

    def numbers(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table's number of each chunk, valid until the next call, and
        where the chunk starts."""
        table = self.table
        starts, sizes = self._chunks(data, bounds)
        padded = np.concatenate((self._folded(data), np.zeros(8 * LIMBS, np.uint8)))
        words = np.ndarray(shape=(padded.size - 7,), dtype="<u8", buffer=padded, strides=(1,))
        limbs = np.zeros((LIMBS, starts.size), np.uint64)
        limbs[0] = words[starts] & _KEEP.take(np.minimum(sizes, 8))
        for i in range(1, LIMBS):
            more = (sizes > 8 * i).nonzero()[0]
            limbs[i, more] = words[starts.take(more) + 8 * i] & _KEEP.take(np.minimum(sizes.take(more) - 8 * i, 8))
        h = table.hash(limbs)
        short = sizes <= 8 * LIMBS
        if not data.all():  # a zero byte would look like a chunk's end
            zeros = np.concatenate(([0], np.cumsum(data == 0)))
            short &= zeros[starts + sizes] == zeros[starts]
        numbers = np.full(starts.size, -1, np.int32)
        if table.count + starts.size // 4 > table.kept or table.long_bytes > LONG_BYTES:
            table.trim()
        todo = np.flatnonzero(short)
        numbers[todo] = known = table.find(limbs[:, todo], h[todo])
        table.again[known[known >= 0]] = True
        while (todo := np.flatnonzero(short & (numbers < 0))).size:
            # one chunk of each hash; should two share it, the other has its turn in the next round
            new = todo[np.unique(h[todo], return_index=True)[1]]
            while table.count + new.size > table.slots * 3 // 4:  # many new chunks at once
                table.grow()
            table.add(limbs[:, new], h[new], table.store(*self._encode_spans(padded, starts[new], sizes[new])))
            numbers[todo] = table.find(limbs[:, todo], h[todo])
        rest = np.flatnonzero(~short)
        if rest.size:
            chunks = [padded[a:z].tobytes() for a, z in zip(starts[rest].tolist(), (starts + sizes)[rest].tolist())]
            new = {c: i for c, i in zip(chunks, rest.tolist()) if c not in table.long}
            table.long_bytes += sum(map(len, new))
            at = np.fromiter(new.values(), np.int64, len(new))
            table.long.update(zip(new, table.store(*self._encode_spans(padded, starts[at], sizes[at])).tolist()))
            numbers[rest] = [table.long[c] for c in chunks]
        return numbers, starts


class TextEncoder(ChunkEncoder):
    """``spaces``: how the vocabulary treats white space.  "lead": a piece
    takes the one space before it (byte-level vocabularies).  "drop": white
    space only separates and case is dropped (word-end vocabularies)."""

    def __init__(self, path: str, spaces: str, kept: int = KEPT_CHUNKS):
        # a task has one core: threads of the library's own only cost time
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.mark = self.whole.token_to_id(_MARK)
        self.id_bytes = self._id_bytes() if spaces == "lead" else None
        self.spaces = spaces
        self.exact = _ODD if spaces == "drop" else f"{_ODD}|{_MIXED}"
        super().__init__(kept)

    def _folded(self, data: np.ndarray) -> np.ndarray:
        return _LOWER[data] if self.spaces == "drop" else data

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    _encode_chunks = _direct

    def _id_bytes(self) -> np.ndarray | None:
        """How many bytes each id stands for, where the vocabulary cuts like
        GPT-2's: a byte is a character there, and text is not changed before."""
        spec = json.loads(self.whole.to_str())
        cutter = spec["pre_tokenizer"] or {}
        if cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True) or cutter.get("add_prefix_space") or spec["normalizer"] or spec["model"]["type"] != "BPE":
            return None
        found = self.whole.get_vocab(with_added_tokens=False)
        sizes = np.zeros(max(found.values()) + 1, np.int64)
        sizes[list(found.values())] = [len(token) for token in found]
        return sizes

    def _encode_spans(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.id_bytes is None or not starts.size:
            return self._encode_marked(data, starts, sizes)
        # A space before other than white space begins a piece, whatever comes
        # before it; so chunks that begin like this and do not end in white
        # space follow one another as they are.
        blank = np.zeros(256, bool)
        blank[[10, 32]] = True
        plain = (sizes > 1) & (data[starts] == 32) & ~blank[data[np.minimum(starts + 1, data.size - 1)]] & ~blank[data[starts + sizes - 1]]
        ids, counts = self._encode_joined(data, starts[plain], sizes[plain])
        rest = ~plain
        if not rest.any():
            return ids, counts
        if not plain.any():
            return self._encode_marked(data, starts, sizes)
        own, own_counts = self._encode_marked(data, starts[rest], sizes[rest])
        each = np.empty(starts.size, np.int64)
        each[plain], each[rest] = counts, own_counts
        of_plain = np.repeat(plain, each)
        out = np.empty(of_plain.size, np.uint32)
        out[of_plain], out[~of_plain] = ids, own
        return out, each

    def _encode_joined(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, per_text: int = 200) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        if not ends.size:
            return np.zeros(0, np.uint32), ends
        index = np.repeat(starts - (ends - sizes), sizes)
        index += np.arange(index.size)
        text = data.take(index).tobytes()
        cuts = [0, *ends[per_text - 1 : -1 : per_text].tolist(), ends[-1]]
        coded = self.whole.encode_batch_fast([text[a:z].decode() for a, z in zip(cuts, cuts[1:])], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in coded])
        # ids' bytes are the text's, so they tell where each chunk ends
        last = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends)
        return ids, np.diff(last, prepend=-1)

    def _encode_marked(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, per_text: int = 200) -> tuple[np.ndarray, np.ndarray]:
        if self.mark is None or not starts.size:
            return super()._encode_spans(data, starts, sizes)
        # Many chunks at a time, each followed by a special token that the
        # vocabulary recognises meanwhile (one by one if it has none).
        mark = np.frombuffer(_MARK.encode(), np.uint8)
        width = sizes + mark.size
        ends = np.cumsum(width)
        index = np.repeat(starts - (ends - width), width)
        index += np.arange(index.size)
        joined = data.take(index, mode="clip")
        joined[(ends - mark.size)[:, None] + np.arange(mark.size)] = mark
        text = joined.tobytes()
        if text.count(mark.tobytes()) != starts.size:  # a chunk has it itself
            return super()._encode_spans(data, starts, sizes)
        cuts = [0, *ends[per_text - 1 : -1 : per_text].tolist(), ends[-1]]
        self.whole.encode_special_tokens = False
        coded = self.whole.encode_batch_fast([text[a:z].decode() for a, z in zip(cuts, cuts[1:])], add_special_tokens=False)
        self.whole.encode_special_tokens = True
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in coded])
        at = np.flatnonzero(ids == self.mark)
        return np.delete(ids, at), np.diff(at, prepend=-1) - 1

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = data.size
        head = np.zeros(n + 1, bool)
        head[bounds] = True
        head = head[:n]
        before = np.concatenate((data[:1], data[:-1]))
        cut = _PUNCT[data] & _ALNUM[before]
        line = data == 10
        space = data == 32
        if self.spaces == "drop":
            blank = line | space
            blank_before = np.concatenate((blank[:1], blank[:-1]))
            starts = np.flatnonzero(~blank & (cut | blank_before | head))
            is_end = np.concatenate((blank, [True])) | np.concatenate((cut | head, [True]))
            ends = np.flatnonzero(is_end)
            stops = ends[np.searchsorted(ends, starts, side="right")]
        else:
            blank = line | space
            blank_before = np.concatenate((blank[:1], blank[:-1])) | head
            blank_after = np.concatenate((blank[1:], [True])) | np.concatenate((head[1:], [True]))
            alone = line & ~blank_before & ~blank_after
            after_line = np.concatenate(([False], alone[:-1])) if n else alone
            starts = np.flatnonzero(head | space | cut | (line & ~blank_before) | after_line)
            stops = np.concatenate((starts[1:], [n]))
        return starts, stops - starts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32 of all texts, offsets int64 of each text's first id and
        the end).  Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.exact).to_numpy(zero_copy_only=False).astype(bool)
        usual = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        data, bounds = raw(usual)
        numbers, starts = self.numbers(data, bounds)
        ids, ends = self.table.gather(numbers)
        offsets = np.concatenate(([0], ends))[np.searchsorted(starts, bounds)]
        if odd.any():
            where = np.flatnonzero(odd)
            return _insert(ids, offsets, where, self._direct(texts.take(pa.array(where)).to_pylist()))
        return ids, offsets


def _insert(ids: np.ndarray, offsets: np.ndarray, where: np.ndarray, own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Put ``own`` in the places of the (so far empty) texts ``where``."""
    pieces, sizes = [], np.diff(offsets)
    start = 0
    for at, x in zip(where.tolist(), own):
        pieces += [ids[start : offsets[at]], x]
        start = offsets[at]
        sizes[at] = len(x)
    return np.concatenate([*pieces, ids[start:]]), np.concatenate(([0], np.cumsum(sizes)))


class PieceWords(ChunkEncoder):
    """Words (runs without ASCII white space), each encoded on its own by a
    sentencepiece model."""

    _SPACE = np.zeros(256, bool)
    _SPACE[[9, 10, 11, 12, 13, 32]] = True

    def __init__(self, path: str, kept: int = KEPT_CHUNKS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        super().__init__(kept)

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.concatenate((self._SPACE[data], [True]))
        head = np.zeros(data.size + 1, bool)
        head[bounds] = True
        starts = np.flatnonzero(~edge[:-1] & (head[:-1] | np.concatenate(([True], edge[:-2])))[: data.size])
        ends = np.flatnonzero(edge | head)
        return starts, ends[np.searchsorted(ends, starts, side="right")] - starts

    def _encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(chunks, num_threads=1)]


@lru_cache(maxsize=1)
def piece_words(path: str) -> PieceWords:
    """One per worker process and model."""
    return PieceWords(path)


@lru_cache(maxsize=1)
def encoder(path: str, spaces: str) -> TextEncoder:
    """The worker process's encoder; one at a time, for its memory.  A new one
    also ends the use of a sentencepiece model."""
    piece_words.cache_clear()
    return TextEncoder(path, spaces)

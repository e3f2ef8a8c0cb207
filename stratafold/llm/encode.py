"""Token ids of whole texts by a public word tokenizer, one library call per distinct word.

The tokenizer drops white space, lower-cases, and never forms a piece across white space
or across the border of ASCII letters and other ASCII signs (the apostrophe aside). So a
text's ids are the ids of the units between such borders, in a row. Each worker keeps the
ids of the units it has met: units are found and hashed with array operations, and only
new ones go through the library.
"""

from __future__ import annotations

import os
import string
import zlib

import numpy as np

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
_BASE = 0x9E3779B97F4A7C15
_BLOCK_BYTES = 1 << 21
_LONG_WORD = 64
_MOST_WORDS = 1 << 21
_SPACES = b" \t\n\x0b\x0c\r"
_NAMES = (b"<|startoftext|>", b"<|endoftext|>")  # special tokens of the file, in any text


def _kinds() -> np.ndarray:
    """Byte classes: 0 space, 1 ASCII letter, 3 other ASCII sign, 2 all else."""
    out = np.full(256, 2, np.uint8)
    for b in range(0x21, 0x7F):
        out[b] = 1 if chr(b).isalpha() else 2 if chr(b).isdigit() or b == 0x27 else 3
    out[list(_SPACES)] = 0
    return out


_KIND = _kinds()
#: By class of a byte and of the next one: whether a unit ends, and whether one starts.
_ENDS = np.zeros(16, bool)
_ENDS[[4, 8, 12, 7, 13]] = True
_STARTS = np.zeros(16, bool)
_STARTS[[1, 2, 3, 7, 13]] = True


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, _BLOCK_BYTES + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _BLOCK_BYTES + 1)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of a block, its words cut at letter-sign borders."""
    kind = np.zeros(len(data) + 2, np.uint8)
    np.take(_KIND, data, out=kind[1:-1])
    pair = kind[:-1] * np.uint8(4) + kind[1:]
    return np.flatnonzero(_STARTS[pair]), np.flatnonzero(_ENDS[pair])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, well mixed; ``data`` has at most one block."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _DOWN[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


class _Table:
    """An open-addressing table from word hash to word number, in arrays."""

    def __init__(self, bits: int = 18):
        self.bits = bits
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it is not there."""
        slot = (h >> self.shift).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.values[slot], -1)
        open_ = np.flatnonzero((key != h) & (key != 0))
        while len(open_):
            slot_ = slot[open_] = (slot[open_] + 1) & self.mask
            key = self.keys[slot_]
            hit = key == h[open_]
            out[open_[hit]] = self.values[slot_[hit]]
            open_ = open_[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that are not there yet."""
        slot = (h >> self.shift).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = self.keys[slot[left]] == 0
            first = np.zeros(len(left), bool)
            first[np.unique(slot[left], return_index=True)[1]] = True
            put = left[free & first]
            self.keys[slot[put]], self.values[slot[put]] = h[put], values[put]
            left = left[~(free & first)]
            slot[left] = (slot[left] + 1) & self.mask


class Encoder:
    """Encodes texts to ids; ``path`` names a tokenizer file that the workers have."""

    _kept: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode("\x00", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        # Where a run of small ASCII letters stays as it is and whole, the model alone gives its ids.
        letters, first, cut = string.ascii_lowercase, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        as_it_is = first is not None and cut is not None and first.normalize_str(letters) == letters and [
            p[0] for p in cut.pre_tokenize_str(letters)] == [letters]
        self.model = self.tokenizer.model if as_it_is else None
        self._reset()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One encoder for each worker process, kept between its tasks."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def _reset(self) -> None:
        self.table, self.words = _Table(), 0
        self.first = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def _library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's id count, and the ids in a row; many words go in one call, parted by a mark that is its own id."""
        text = b" \x00 ".join(words)
        if self.mark is None or text.count(b"\x00") >= len(words):
            texts = [w.decode("utf-8", "replace") for w in words]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([len(x) for x in found]), np.array([i for x in found for i in x], np.uint32)
        text = text.decode("utf-8", "replace")
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        marks = ids == self.mark
        return np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1, ids[~marks]

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        letters = np.array([self.model is not None and w.isalpha() for w in words])
        order, k = np.argsort(~letters, kind="stable"), int(letters.sum())
        words, hashes = [words[i] for i in order.tolist()], hashes[order]
        parts = [self._library(words[i:i + 512]) for i in range(k, len(words), 512)]
        if k:
            alone = [[t.id for t in self.model.tokenize(w.decode())] for w in words[:k]]
            parts.insert(0, (np.array([len(x) for x in alone]), np.array([i for x in alone for i in x], np.uint32)))
        size, found = (np.concatenate(x) for x in zip(*parts))
        n, total = len(words), int(size.sum())
        while self.words + n > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.first[self.words:self.words + n] = self.used + np.cumsum(size) - size
        self.size[self.words:self.words + n] = size
        self.ids[self.used:self.used + total] = found
        while self.words + n > len(self.table.keys) // 2:
            old, self.table = self.table, _Table(self.table.bits + 1)
            full = np.flatnonzero(old.keys)
            self.table.add(old.keys[full], old.values[full])
        self.table.add(hashes, np.arange(self.words, self.words + n, dtype=np.int32))
        self.words, self.used = self.words + n, self.used + total

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, id count and ids of the words of one block."""
        starts, ends = words_of(data)
        if not len(starts):
            return starts, np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if self.words > _MOST_WORDS:
            self._reset()
        h = word_hashes(data, starts, ends)
        number = self.table.find(h)
        long = ends - starts > _LONG_WORD
        missed = np.flatnonzero((number < 0) & ~long)
        if len(missed):
            new, at = np.unique(h[missed], return_index=True)
            raw = data.tobytes()
            at = missed[at]
            self._learn([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], new)
            number[missed] = self.table.find(h[missed])
        size = np.where(long, 0, self.size[number]).astype(np.int64)
        ids = self._gather(self.first[number], size)
        if long.any():
            return self._with_long(data, starts, ends, np.flatnonzero(long), size, ids)
        return starts, size, ids

    def _gather(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        stop = np.cumsum(size)
        take = np.repeat(first - (stop - size), size)
        take += np.arange(len(take))
        return self.ids[take]

    def _with_long(self, data, starts, ends, long, size, ids):
        """Long words are encoded each time they occur, without a hash."""
        stop = np.cumsum(size)
        parts, last = [], 0
        for i in long:
            own = np.array(self.tokenizer.encode(
                data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace"),
                add_special_tokens=False).ids, np.uint32)
            parts += [ids[last:stop[i]], own]
            last, size[i] = stop[i], len(own)
        return starts, size, np.concatenate([*parts, ids[last:]])

    def _pieces(self, text: bytes):
        """A long text in blocks that end at white space; a longer word stays whole."""
        if len(text) <= _BLOCK_BYTES:
            yield text
            return
        at = 0
        while at < len(text):
            stop = min(at + _BLOCK_BYTES, len(text))
            if stop < len(text):
                cut = max(text.rfind(bytes([c]), at, stop) for c in _SPACES)
                if cut < 0:
                    later = [text.find(bytes([c]), stop) for c in _SPACES]
                    cut = min((c for c in later if c >= 0), default=len(text))
                stop = max(cut, at + 1)
            yield text[at:stop]
            at = stop

    def _alone(self, text: bytes) -> np.ndarray:
        parts = []
        for piece in self._pieces(text):
            if len(piece) > _BLOCK_BYTES:
                parts.append(np.array(self.tokenizer.encode(
                    piece.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32))
            else:
                parts.append(self._block(np.frombuffer(piece, np.uint8))[2])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def encode(self, texts: list[str | None], end: int | None = END_ID):
        """Ids of the texts (null: empty) one after the other, and each text's id count.

        Texts go in groups of one block; one with a special token's name goes to the library.
        """
        tail = np.array([] if end is None else [end], np.uint32)
        ids, sizes, group, held = [], [], [], 0

        def flush():
            nonlocal group, held
            if not group:
                return
            data = np.frombuffer(b"\n".join(group).lower() + b"\n", np.uint8)
            bounds = np.cumsum([len(t) + 1 for t in group])
            starts, size, found = self._block(data)
            per = np.bincount(np.searchsorted(bounds, starts, "right"), size, len(group)).astype(np.int64)
            if len(tail):
                found = np.insert(found, np.cumsum(per), tail[0])
            ids.append(found)
            sizes.append(per + len(tail))
            group, held = [], 0

        for text in texts:
            raw = (text or "").encode("utf-8", "replace")
            named = any(name in raw for name in _NAMES)
            if named or len(raw) >= _BLOCK_BYTES:
                flush()
                alone = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                                 np.uint32) if named else self._alone(raw.lower())
                ids.append(np.concatenate([alone, tail]))
                sizes.append(np.array([len(ids[-1])]))
                continue
            if held + len(raw) + 1 > _BLOCK_BYTES:
                flush()
            group.append(raw)
            held += len(raw) + 1
        flush()
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32),
                np.concatenate(sizes) if sizes else np.zeros(0, np.int64))


def crc_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))

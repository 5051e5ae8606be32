"""Token ids of whole text columns by the tokenizers library, each distinct piece encoded once.

The library's pre-tokenizers cut a text into parts that are encoded on their own. This module cuts
only where such a cut is certain (between a character that is no white space and a space or line
feed, and between a letter and ASCII punctuation or a digit), has the library encode every distinct
piece of a worker once, and puts the ids of whole texts together from these. Any character it is not
sure about just makes a piece longer. Tokenizers with other pre-tokenizers get whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from roadlens.llm.hashing import LOWER, hash_runs, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already uses every core

# Bytes at which a piece may begin or end.
_OPENS = np.zeros(256, bool)  # a space or line feed
_OPENS[[0x20, 0x0A]] = True
_SOLID = np.zeros(256, bool)  # cannot be the last byte of any white space
_SOLID[0x21:0x7F] = True
_SOLID[0x80:] = True
_SOLID[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)  # printable ASCII that is no letter
_MARK[0x21:0x7F] = True
_MARK &= ~_LETTER
# The word pattern: white space is dropped, letters are lower-cased first.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_SLOTS = 1 << 20  # twice the pieces a worker remembers
_AT_ONCE = 4_096  # new pieces given to the library together


def _kind(settings: dict) -> str:
    """How texts may be cut: bytes (spaces belong to the next word), words, or not at all."""
    normal, parts = settings.get("normalizer"), settings.get("pre_tokenizer") or {}
    if normal is None and parts.get("type") == "ByteLevel":
        if parts.get("use_regex", True) and not parts.get("add_prefix_space", True):
            return "bytes"
    steps = parts.get("pretokenizers") or [{}]
    split = steps[0]
    if (
        normal
        and [n.get("type") for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        and split.get("type") == "Split"
        and split.get("pattern", {}).get("Regex") == _WORD_PATTERN
        and split.get("invert")
        and split.get("behavior") == "Removed"
    ):
        return "words"
    return "whole"


def cut(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces; they cover all texts, for words without some white space."""
    edges = offsets[:-1][np.diff(offsets) > 0]
    if kind == "whole" or not len(data):
        return edges, offsets[1:][np.diff(offsets) > 0]
    before, after = data[:-1], data[1:]
    # In UTF-8, C3 and one more byte is a letter, but for the two signs between them.
    latin = np.zeros(len(data), bool)
    latin[1:] = (before == 0xC3) & (after != 0x97) & (after != 0xB7)
    letter = _LETTER[data] | latin
    begins = np.zeros(len(data), bool)
    begins[1:] = (_OPENS[after] & (_SOLID[before] | latin[:-1])) | (letter[:-1] & _MARK[after])
    begins[edges] = True
    if kind == "bytes":
        starts = np.flatnonzero(begins)
        return starts, np.append(starts[1:], len(data))
    space = _OPENS[data]
    begins[1:] |= space[:-1] != space[1:]
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    real = ~space[starts]  # a piece that begins with a blank holds nothing else
    return starts[real], ends[real]


def _state(part) -> dict | None:
    """Settings of a normalizer or pre-tokenizer, without the vocabulary."""
    return json.loads(part.__getstate__()) if part is not None else None


def public_file(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of text columns. ``path`` is a tokenizer file that every worker can read."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = _kind({"normalizer": _state(self.tokenizer.normalizer), "pre_tokenizer": _state(self.tokenizer.pre_tokenizer)})
        self.checked = False  # whether new pieces are held against the bytes of their ids
        self._clear()

    def _clear(self) -> None:
        self.slots = np.zeros(1 << 16, np.uint64)  # hashes; 0 is free
        self.entry = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 15, np.int64)
        self.count = np.zeros(1 << 15, np.int64)
        self.okay = np.zeros(1 << 15, bool)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.entries = self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if it is not known."""
        found = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        last = len(self.slots) - 1
        place = (hashes & np.uint64(last)).astype(np.int64)
        while len(todo):
            there = self.slots[place]
            hit = there == hashes[todo]
            found[todo[hit]] = self.entry[place[hit]]
            go_on = ~hit & (there != 0)
            todo, place = todo[go_on], (place[go_on] + 1) & last
        return found

    def _place(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        """Give new hashes their slots."""
        last = len(self.slots) - 1
        todo = np.arange(len(hashes))
        place = (hashes & np.uint64(last)).astype(np.int64)
        while len(todo):
            free = self.slots[place] == 0
            self.slots[place[free]] = hashes[todo[free]]
            won = self.slots[place] == hashes[todo]
            self.entry[place[won]] = entries[todo[won]]
            todo, place = todo[~won], (place[~won] + 1) & last

    def _add(self, hashes: np.ndarray, ids: list[list[int]], okay: np.ndarray) -> None:
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(counts.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while self.entries + len(ids) > len(self.first):
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
            self.count = np.concatenate((self.count, np.zeros_like(self.count)))
            self.okay = np.concatenate((self.okay, np.zeros_like(self.okay)))
        while 2 * (self.entries + len(ids)) > len(self.slots):
            taken = np.flatnonzero(self.slots)
            old, entries = self.slots[taken], self.entry[taken]
            self.slots, self.entry = np.zeros(2 * len(self.slots), np.uint64), np.zeros(2 * len(self.entry), np.int32)
            self._place(old, entries)
        flat = (i for piece in ids for i in piece)
        self.pool[self.used : self.used + total] = np.fromiter(flat, np.uint32, total)
        new = np.arange(self.entries, self.entries + len(ids))
        self.first[new] = self.used + np.cumsum(counts) - counts
        self.count[new] = counts
        self.okay[new] = okay
        self.used += total
        self.entries += len(ids)
        self._place(hashes, new)

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return cut(data, offsets, self.kind)

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _given_back(self, pieces: list[bytes], ids: list[list[int]]) -> np.ndarray:
        """Whether the bytes of the ids are those of the piece."""
        if not self.checked:
            return np.ones(len(pieces), bool)
        names = self.names()
        same = (b"".join([names[i] for i in own]) == piece for own, piece in zip(ids, pieces))
        return np.fromiter(same, bool, len(pieces))

    def _pieces(self, data: np.ndarray, offsets: np.ndarray):
        """Starts of the pieces, then pool, first, count and okay of each."""
        starts, ends = self._cut(data, offsets)
        hashes = hash_runs(LOWER[data] if self.kind == "words" else data, starts, ends)
        hashes |= np.uint64(1)  # never the sign of a free slot
        entries = self._find(hashes)
        if (entries < 0).any():
            if self.entries + int((entries < 0).sum()) > _SLOTS // 2:
                self._clear()
                entries = np.full(len(hashes), -1, np.int64)
            new, where = np.unique(hashes[entries < 0], return_index=True)
            where = np.flatnonzero(entries < 0)[where]
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            ids = []
            for at in range(0, len(pieces), _AT_ONCE):
                ids += self._ids([piece.decode() for piece in pieces[at : at + _AT_ONCE]])
            okay = self._given_back(pieces, ids)
            if len(new) > _SLOTS // 2:  # more than is remembered: only this block gets so many
                # Nothing was known when the block was encoded.
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                pool = np.fromiter((i for piece in ids for i in piece), np.uint32, int(counts.sum()))
                place = np.searchsorted(new, hashes)
                return starts, pool, (np.cumsum(counts) - counts)[place], counts[place], okay[place]
            self._add(new, ids, okay)
            entries = self._find(hashes)
        return starts, self.pool, self.first[entries], self.count[entries], self.okay[entries]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (null: none), and the offsets of the texts."""
        data, offsets = text_bytes(column)
        starts, pool, first, counts, _ = self._pieces(data, offsets)
        return _gathered(pool, first, counts, starts, offsets)

    def exact(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for texts as bytes, and whether the bytes of its ids are those of each text."""
        if not self.checked:
            self.checked = True
            self._clear()
        starts, pool, first, counts, okay = self._pieces(data, offsets)
        ids, at = _gathered(pool, first, counts, starts, offsets)
        good = np.ones(len(offsets) - 1, bool)
        good[np.searchsorted(offsets, starts[~okay], "right") - 1] = False
        for i in np.flatnonzero(~good):  # let the library see the whole text
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            whole = self._ids([text.decode()])
            good[i] = self._given_back([text], whole)[0]
            if good[i]:
                ids = np.concatenate((ids[: at[i]], np.array(whole[0], np.uint32), ids[at[i + 1] :]))
                at[i + 1 :] += len(whole[0]) - (at[i + 1] - at[i])
        return ids, at, good

    def names(self) -> list[bytes]:
        """Bytes of text behind each id of a byte-level vocabulary."""
        if not hasattr(self, "_names"):
            # Printable bytes of Latin-1 stand for themselves, the others for characters from 256 on.
            plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
            byte_of = {chr(b): b for b in plain}
            rest = [b for b in range(256) if b not in set(plain)]
            byte_of |= {chr(256 + i): b for i, b in enumerate(rest)}
            vocabulary = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
            self._names = [bytes(byte_of.get(c, 0x3F) for c in name) for name in vocabulary]
        return self._names

    def id_bytes(self) -> np.ndarray | None:
        """Bytes of text behind each id; None if ids do not stand for runs of bytes."""
        if self.kind != "bytes":
            return None
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        return np.array([len(name) for name in names], np.int64)


class PieceEncoder(Encoder):
    """Ids of a sentencepiece model that puts a space before a text.

    Texts come with that space. They are cut before every run of spaces, where no piece of the vocabulary
    goes across; a model with such a piece gets whole texts.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        mark = "\u2581"
        across = any(mark in self.model.id_to_piece(i).lstrip(mark) for i in range(self.model.get_piece_size()))
        self.kind = "whole" if across else "spaces"
        self.checked = False
        self._clear()

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == "whole" or not len(data):
            return cut(data, offsets, "whole")
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        return starts, np.append(starts[1:], len(data))

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode([piece[1:] for piece in pieces], num_threads=1)

    def names(self) -> list[bytes]:
        if not hasattr(self, "_names"):
            self._names = []
            for i in range(self.model.get_piece_size()):
                piece = self.model.id_to_piece(i)
                byte = self.model.is_byte(i)
                self._names.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("\u2581", " ").encode())
        return self._names

    def id_bytes(self) -> np.ndarray:
        return np.array([len(name) for name in self.names()], np.int64)


_ENCODERS: dict[str, Encoder] = {}  # of this worker process


def _gathered(
    pool: np.ndarray, first: np.ndarray, counts: np.ndarray, starts: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    before = np.concatenate(([0], np.cumsum(counts)))
    ids = pool[np.arange(before[-1]) + np.repeat(first - before[:-1], counts)]
    return ids, before[np.searchsorted(starts, offsets)]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end`` appended to every text."""
    texts = len(offsets) - 1
    out = np.full(len(ids) + texts, end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(texts), np.diff(offsets))] = ids
    return out, offsets + np.arange(texts + 1)

"""Whole texts to token ids, with the ids of repeated words kept.

The tokenizers library does the encoding. Both vocabularies used here cut a text into
pieces before they merge, and two places always are cuts: between a character and white
space behind it, and between an ASCII letter and an ASCII sign behind it. So the ids of a
text are those of its units one after another, where units end at such places, and each
different unit of many texts is encoded once. New units are joined by a separator,
encoded in one call and cut apart at the separator's id. A text with any white space but
blanks, tabs and line breaks is encoded in one piece.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa

from lanelux.llm.runs import text_bytes

IDS = np.dtype("<u4")

#: Bytes of text that are cut into units together, of which each takes some fifty bytes meanwhile, and units that a worker keeps.
TOKEN_STEP, KEEP_UNITS = 2 << 20, 1_000_000

_SPACE, _LETTER, _SIGN, _RARE = 1, 2, 4, 8


def _kinds() -> bytes:
    """For each byte what it may be; ``_RARE`` ones may be white space of another kind, or begin it."""
    kinds = bytearray(256)
    for c in range(128):
        kinds[c] = _LETTER if chr(c).isalpha() else _SIGN if 33 <= c < 127 and not chr(c).isalnum() else 0
    for c in b" \n\t\r":
        kinds[c] = _SPACE
    for c in (0, 11, 12, 28, 29, 30, 31, 0xE1, 0xE2, 0xE3, 0xEF):
        kinds[c] = _RARE
    return bytes(kinds)


_KINDS = _kinds()
_OTHER_SPACE = re.compile("[^\\S \n\t\r]|[\x00\x0b\x0c\x1c-\x1f\x85᠎​⁠﻿]").search


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[:1], down[:1] = 1, 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(1 << 16)


def _hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each unit; units lie one after another, ``starts`` has one more than units."""
    if len(data) > len(_UP):  # in pieces, each of them with powers from the first on
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data), len(_UP) // 2)))
        cuts = np.unique(np.concatenate([[0], cuts, [len(starts) - 1]]))
        if len(cuts) > 2:
            return np.concatenate(
                [_hashes(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i]) for i, j in zip(cuts, cuts[1:], strict=False)]
            )
        return np.array([hash(data[i:j].tobytes()) & (1 << 64) - 1 for i, j in zip(starts, starts[1:], strict=False)], np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * _UP[: len(data)], dtype=np.uint64)])
    return (sums[starts[1:]] - sums[starts[:-1]]) * _DOWN[np.minimum(starts[:-1], len(_DOWN) - 1)]


class Kept:
    """Ids of units met before, in columns; found by a hash of the unit and a look at its bytes.

    Of more than ``most`` units, the half that was used last stays. Units over ``LONGEST`` bytes are not kept,
    nor are those whose hash another unit has.
    """

    LONGEST = 1024

    def __init__(self, most: int):
        self.most, self.step = most, 0
        self._empty()

    def _empty(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.data, self.starts = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_starts = np.zeros(0, IDS), np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int32)

    def find(self, data: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The slot of each unit, -1 for unknown ones."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        slot = self.slots[at].astype(np.int64)
        sizes = np.diff(starts)
        same = (self.hashes[at] == hashes) & (self.starts[slot + 1] - self.starts[slot] == sizes)
        found = np.flatnonzero(same & (sizes > 0))
        own = sizes[found]
        equal = data[_ranges(starts[:-1][found], own)] == self.data[_ranges(self.starts[slot[found]], own)]
        if not equal.all():
            same[found] = np.logical_and.reduceat(equal, np.cumsum(own) - own)
        slot[~same] = -1
        self.used[slot[same]] = self.step
        return slot

    def add(self, units: list[bytes], ids: list[bytes]) -> None:
        """Keep the ids of ``units``, all different and none kept."""
        chosen = [k for k, u in enumerate(units) if 0 < len(u) <= self.LONGEST]
        units, ids = [units[k] for k in chosen], [ids[k] for k in chosen]
        if not units:
            return
        if len(self.used) + len(units) > self.most:
            self._shrink()
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))])
        data = np.frombuffer(b"".join(units), np.uint8)
        hashes, first = np.unique(_hashes(data, starts), return_index=True)
        place = np.searchsorted(self.hashes, hashes)
        free = np.ones(len(hashes), bool)
        if len(self.hashes):
            free = self.hashes[np.minimum(place, len(self.hashes) - 1)] != hashes
        slots = (len(self.used) + first).astype(np.int32)
        self.hashes = np.insert(self.hashes, place[free], hashes[free])
        self.slots = np.insert(self.slots, place[free], slots[free])
        id_starts = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), IDS)])
        self.id_starts = np.concatenate([self.id_starts, self.id_starts[-1] + id_starts])
        self.data = np.concatenate([self.data, data])
        self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
        self.used = np.concatenate([self.used, np.full(len(units), self.step, np.int32)])

    def _shrink(self) -> None:
        """Forget the half that was not used for longest."""
        stay = np.sort(np.argsort(self.used[self.slots], kind="stable")[(len(self.slots) + 1) // 2 :])
        old = self.slots[stay]
        sizes, id_sizes = np.diff(self.starts)[old], np.diff(self.id_starts)[old]
        self.data = self.data[_ranges(self.starts[old], sizes)]
        self.ids = self.ids[_ranges(self.id_starts[old], id_sizes)]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.id_starts = np.concatenate([[0], np.cumsum(id_sizes)])
        self.used, self.hashes = self.used[old], self.hashes[stay]
        self.slots = np.arange(len(old), dtype=np.int32)


class Encoder:
    """Encodes texts; keeps the ids of some ``keep`` units used last.

    ``joined`` is the number of new units that share a piece of text. ``folds`` says that the
    vocabulary drops white space and letter case.
    """

    def __init__(self, path: str, separator: str, folds: bool, keep: int = KEEP_UNITS, joined: int = 1024):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._separator, self._folds, self._joined = separator, folds, joined
        self._mark = self._whole(separator)
        self.kept = Kept(keep)

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, IDS).tobytes()

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of ``new``, all different."""
        known: dict[bytes, bytes] = {}
        between = self._separator.strip(" ").encode()
        plain = [u for u in new if between not in u and not u.isspace()] if len(self._mark) == 4 else []
        parts = [plain[start : start + self._joined] for start in range(0, len(plain), self._joined)]
        join = self._separator.encode().join
        texts = [join(p).decode() for p in parts]
        mark = int.from_bytes(self._mark[:4], "little")
        for part, encoding in zip(parts, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, IDS)
            cuts = np.flatnonzero(ids == mark)
            if len(cuts) == len(part) - 1:
                raw, bounds = ids.tobytes(), (4 * cuts).tolist()
                known.update(
                    [(u, raw[a:b]) for u, a, b in zip(part, [0, *(c + 4 for c in bounds)], [*bounds, len(raw)], strict=True)]
                )
        known.update([(u, self._whole(u.decode())) for u in new if u not in known])
        return known

    def _ids(self, new: list[bytes]) -> list[bytes]:
        """Ids of ``new`` units, all different and none kept; these and their parts are kept now.

        White space before a word is a piece up to its last character; that one belongs to the word
        if it is a blank and is a piece otherwise.
        """
        parts: dict[bytes, tuple[bytes, ...]] = {}
        for u in new:
            if u[:1] in b" \n\t\r" and u:
                word = u.lstrip(b" \n\t\r")
                at = len(u) - len(word)
                if word and (at > 1 or u[:1] != b" "):
                    own = (u[: at - 1], b" " + word) if u[at - 1 : at] == b" " else (u[: at - 1], u[at - 1 : at], word)
                    parts[u] = tuple(p for p in own if p)
        stems = [u for u in new if u not in parts]
        known: dict[bytes, bytes] = {}
        if parts:
            inner = list({p for own in parts.values() for p in own}.difference(stems))
            sizes = np.fromiter(map(len, inner), np.int64, len(inner))
            starts, data = np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(inner), np.uint8)
            slots = self.kept.find(data, starts, _hashes(data, starts))
            bounds = self.kept.id_starts
            known = {p: self.kept.ids[bounds[k] : bounds[k + 1]].tobytes() for p, k in zip(inner, slots.tolist(), strict=True) if k >= 0}
            stems += [p for p in inner if p not in known]
        learnt = self._learn(stems)
        known |= learnt
        for u, own in parts.items():
            learnt[u] = known[u] = b"".join([known[p] for p in own])
        self.kept.add(list(learnt), list(learnt.values()))
        return [known[u] for u in new]

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        data, bounds = text_bytes(texts)
        out: list[bytes] = []
        at, n = 0, len(bounds) - 1
        while at < n:
            end = max(at + 1, min(n, int(np.searchsorted(bounds, bounds[at] + TOKEN_STEP))))
            out += self._encode(data[bounds[at] : bounds[end]].tobytes(), bounds[at : end + 1] - bounds[at])
            at = end
        return out

    def _encode(self, joined: bytes, bounds: np.ndarray) -> list[bytes]:
        n = len(bounds) - 1
        if not joined:
            return [b""] * n
        data = np.frombuffer(joined.lower() if self._folds else joined, np.uint8)
        kinds = np.frombuffer(joined.translate(_KINDS), np.uint8)
        space = kinds == _SPACE
        first = np.zeros(len(data), bool)  # bytes that begin a unit
        first[1:] = (space[1:] & ~space[:-1]) | ((kinds[1:] == _SIGN) & (kinds[:-1] == _LETTER))
        if self._folds:
            first[1:] |= space[:-1] & ~space[1:]
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        if self._folds:  # white space has no ids
            first &= ~space
        starts = np.flatnonzero(first)
        if not len(starts):
            return [b""] * n
        unit_ends = np.concatenate([[0], np.searchsorted(starts, bounds[1:])])
        rare = (kinds == _RARE).any() or ((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))).any()
        if self._folds:
            starts, data = np.cumsum(~space, dtype=np.int32)[starts] - 1, data[~space]
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        index, different = units.indices.to_numpy(), units.dictionary
        places = np.frombuffer(different.buffers()[1], np.int64)[: len(different) + 1]
        letters = np.frombuffer(different.buffers()[2], np.uint8)[: places[-1]]
        self.kept.step += 1
        slots = self.kept.find(letters, places, _hashes(letters, places))
        table, table_starts = self.kept.ids, self.kept.id_starts  # as found, whatever is forgotten meanwhile
        unknown = np.flatnonzero(slots < 0)
        new = different.take(pa.array(unknown)).to_pylist()
        odd = np.array([bool(rare) and _OTHER_SPACE(u.decode()) is not None for u in new], bool)
        new_ids = [b""] * len(new)
        for k, ids in zip(np.flatnonzero(~odd).tolist(), self._ids([new[k] for k in np.flatnonzero(~odd)]), strict=True):
            new_ids[k] = ids
        lengths, begins = table_starts[slots + 1] - table_starts[slots], table_starts[slots]
        lengths[unknown] = np.fromiter(map(len, new_ids), np.int64, len(new)) // 4
        begins[unknown] = len(table) + np.cumsum(lengths[unknown]) - lengths[unknown]
        table = np.concatenate([table, np.frombuffer(b"".join(new_ids), IDS)])
        own = lengths[index]
        flat = table[_ranges(begins[index], own)].tobytes()
        ends = np.concatenate([[0], np.cumsum(own)])[unit_ends] * 4
        out = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        if odd.any():
            other = np.zeros(len(different), bool)
            other[unknown[odd]] = True
            odd_units = np.flatnonzero(other[index])
            for k in np.unique(np.searchsorted(unit_ends, odd_units, "right") - 1).tolist():
                out[k] = self._whole(joined[bounds[k] : bounds[k + 1]].decode())
        return out


#: White space and case are dropped in this vocabulary; a control character is a piece and one id.
WORD_BPE = ("word_bpe_49k.json", " \x01 ", True)
#: A line break is one id in this vocabulary, and no plain unit holds one.
BYTE_BPE = ("byte_bpe_50k.json", "\n", False)

Vocabulary = tuple[str, str, bool]

_encoders: dict[Vocabulary, Encoder] = {}


def encoder(vocabulary: Vocabulary = WORD_BPE, path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary; ``path`` names another place of its file."""
    name, separator, folds = vocabulary
    key = (path or public_tokenizers.path(name), separator, folds)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]

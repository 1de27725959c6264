"""Merges of byte-pair vocabularies, for many words at once."""

from __future__ import annotations

import json

import numpy as np

NONE = np.iinfo(np.int32).max
#: Words of more symbols than this are merged one by one.
LONG = 64
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for the bytes in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PairTable:
    """Pairs of ids -> (rank, merged id) as an open hash table that is probed for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.made = np.zeros(1 << bits, np.int32)
        for (a, b), (rank, made) in pairs.items():
            key = a << 20 | b
            at = ((key * int(_SPREAD)) & (2**64 - 1)) >> (64 - bits)
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.rank[at], self.made[at] = key, rank, made

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (NONE for pairs that don't merge) and merged ids."""
        key = a.astype(np.int64) << 20 | b
        at = ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)
        there = self.keys[at]
        off = np.flatnonzero((there != key) & (there != -1))
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            there = self.keys[at[off]]
            off = off[(there != key[off]) & (there != -1)]
        good = self.keys[at] == key
        return np.where(good, self.rank[at], NONE).astype(np.int32), self.made[at]


class Vocabulary:
    """Tokens and merges of a tokenizer file with byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        symbols, model = byte_symbols(), read["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in read["added_tokens"]}
        self.first = np.zeros(256, np.int32)
        self.last = np.zeros(256, np.int32)
        for symbol, byte in symbols.items():
            self.first[byte], self.last[byte] = self.ids[symbol], self.ids[symbol + self.end]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.table = PairTable(self.pairs)
        self.token = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for text, i in self.ids.items():
            if text not in self.special:
                self.token[i] = bytes(symbols[c] for c in text.removesuffix(self.end))
        for text, i in self.special.items():
            self.token[i] = text.encode()

    def _symbols(self, word: bytes) -> np.ndarray:
        out = self.first[np.frombuffer(word, np.uint8)]
        out[-1] = self.last[word[-1]]
        return out

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers: again and again its leftmost pair of the lowest rank
        becomes one token.

        All words take a step together; words of like length are one matrix."""
        out = [b""] * len(words)
        order = sorted((i for i, w in enumerate(words) if w), key=lambda i: len(words[i]))
        while order and len(words[order[-1]]) > LONG:
            i = order.pop()
            out[i] = self._one(self._symbols(words[i]).tolist())
        at = 0
        while at < len(order):
            some = order[at : at + 8192]
            at += len(some)
            sizes = np.array([len(words[i]) for i in some])
            width = int(sizes[-1])
            flat = np.frombuffer(b"".join([words[i] for i in some]), np.uint8)
            ids = np.zeros((len(some), width), np.int32)
            ids[np.arange(width) < sizes[:, None]] = self.first[flat]
            ends = np.cumsum(sizes) - 1
            ids[np.arange(len(some)), sizes - 1] = self.last[flat[ends]]
            self._together(ids, sizes, some, out)
        return out

    def _together(self, ids: np.ndarray, sizes: np.ndarray, names: list[int], out: list[bytes]) -> None:
        names_, width = np.array(names), ids.shape[1]
        columns = np.arange(width)
        rank = np.full((len(ids), max(1, width - 1)), NONE, np.int32)
        if width > 1:
            found, _ = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel())
            rank = np.where(columns[: width - 1] < sizes[:, None] - 1, found.reshape(len(ids), -1), NONE)
        while True:
            rows = np.arange(len(ids))
            at = rank.argmin(1)
            go = rank[rows, at] != NONE
            if not go.all():
                stop = np.flatnonzero(~go)
                done, step = ids[stop].astype("<i4").tobytes(), 4 * width
                for k, (name, n) in enumerate(zip(names_[stop].tolist(), sizes[stop].tolist(), strict=True)):
                    out[name] = done[k * step : k * step + 4 * n]
                ids, sizes, names_, rank, at = ids[go], sizes[go], names_[go], rank[go], at[go]
                if not len(ids):
                    return
                rows = np.arange(len(ids))
            # The pair at `at` becomes one: its second token goes, and so does the rank of the pair.
            _, made = self.table.find(ids[rows, at], ids[rows, at + 1])
            ids = ids[columns[:width] != at[:, None] + 1].reshape(len(ids), width - 1)
            rank = rank[columns[: width - 1] != at[:, None]].reshape(len(ids), width - 2)
            ids[rows, at] = made
            width, sizes = width - 1, sizes - 1
            if width == 1:
                rank = np.full((len(ids), 1), NONE, np.int32)
                continue
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.table.find(ids[left, at[left] - 1], ids[left, at[left]])[0]
            right = np.flatnonzero(at < sizes - 1)
            rank[right, at[right]] = self.table.find(ids[right, at[right]], ids[right, at[right] + 1])[0]

    def _one(self, ids: list[int]) -> bytes:
        """The same with a heap of pairs, for words of any length."""
        import heapq

        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (found := self.pairs.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]], found[1]))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            push(before[i])
            push(i)
        return np.array([x for x in ids if x >= 0], "<i4").tobytes()


class Remembered:
    """A bounded memory of two generations: what is used stays, what is not goes when the newer one is full."""

    def __init__(self, size: int):
        self.half, self.new, self.old = size // 2, {}, {}

    def missing(self, rows: list[list]) -> list:
        """The keys that are in neither generation; the others are in the newer one afterwards."""
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}
        new, old, out = self.new, self.old, {}
        for row in rows:
            for key in row:
                if key not in new:
                    if key in old:
                        new[key] = old[key]
                    else:
                        out[key] = None
        return list(out)

"""Suffix arrays by two-stage sorting: only suffixes smaller than their successors are compared, the others follow.

Order is decided by the first ``depth`` bytes at least; suffixes that agree in more come next to each other."""

from __future__ import annotations

import numpy as np


def joined(bodies: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Texts one after another, each byte raised by two and each text ended by a one, and where they begin.

    UTF-8 has no byte above 0xF4, so raising loses nothing. A zero ends the whole."""
    text = (np.frombuffer(b"\xff".join(bodies) + b"\xff\xfe", np.uint8) + np.uint8(2)).tobytes()
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    return text, np.cumsum(sizes) - sizes


def _words8(text: bytes, extra: int) -> np.ndarray:
    """The eight bytes from each position on as one number, first byte highest."""
    padded = np.frombuffer(text + b"\0" * (extra + 8), np.uint8)
    out = np.zeros(len(text) + extra, np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i : i + len(out)]
    return out


def smaller_than_next(codes: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that begins after it; the last one, a lone zero, is."""
    change = np.flatnonzero(codes[1:] != codes[:-1])
    kinds = np.zeros(len(codes), bool)
    kinds[-1:] = True
    if len(change):
        # All positions of a run of equal bytes are as its last one, which meets the other byte.
        nearest = np.searchsorted(change, np.arange(len(codes)))
        inside = nearest < len(change)
        at = change[nearest[inside]]
        kinds[inside] = codes[at] < codes[at + 1]
    return kinds


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    codes = np.frombuffer(text, np.uint8)
    direct = smaller_than_next(codes)
    chosen = _sorted_directly(text, np.flatnonzero(direct), depth)
    firsts = codes[chosen]
    bounds = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in np.flatnonzero(np.bincount(codes, minlength=256)).tolist():
        # Larger ones come first in a bucket: what lower buckets left for it, then predecessors in the bucket itself.
        level = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        waiting[byte] = []
        bucket = []
        while len(level):
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[~direct[before] & (codes[before] == byte)]
        bucket.append(chosen[bounds[byte] : bounds[byte + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        before = before[~direct[before] & (codes[before] > byte)]
        if len(before):
            into = codes[before]
            order = np.argsort(into, kind="stable")
            before, into = before[order], into[order]
            cuts = np.flatnonzero(into[1:] != into[:-1]) + 1
            for part, first in zip(np.split(before, cuts), into[np.concatenate([[0], cuts])].tolist(), strict=True):
                waiting[first].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _sorted_directly(text: bytes, positions: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes: by eight bytes as a number, ties by the bytes after them."""
    head = _words8(text, 0)[positions]
    order = np.argsort(head, kind="stable")
    positions, head = positions[order], head[order]
    same = head[1:] == head[:-1]
    if not same.any():
        return positions
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    out = positions.tolist()
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        group = out[a : b + 1]
        group.sort(key=lambda p: text[p + 8 : p + depth])
        out[a : b + 1] = group
    return np.array(out, np.int64)


def common_prefixes(text: bytes, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Lengths of the common prefixes of pairs of suffixes, up to depth."""
    words = _words8(text, depth)
    out = np.full(len(left), depth, np.int64)
    alive = np.arange(len(left))
    for step in range(0, depth, 8):
        apart = words[left[alive] + step] ^ words[right[alive] + step]
        stop = np.flatnonzero(apart)
        if len(stop):
            equal = sum((apart[stop] >> np.uint64(56 - 8 * i) == 0).astype(np.int64) for i in range(8))
            out[alive[stop]] = np.minimum(depth, step + equal)
            alive = np.delete(alive, stop)
            if not len(alive):
                break
    return out


def repeated_starts(bodies: list[bytes], sizes: list[int], length: int) -> list[np.ndarray]:
    """For each text, whether the string of ``length`` bytes from each of its first ``size`` positions also begins at
    another such position of any of the texts."""
    text, begins = joined(bodies)
    n = np.array(sizes, np.int64)
    wanted = np.zeros(len(text), bool)
    first = np.cumsum(n) - n
    asked = np.repeat(begins - first, n) + np.arange(int(n.sum()))
    wanted[asked] = True
    order = suffix_array(text, length)
    order = order[wanted[order]]
    near = common_prefixes(text, order[:-1], order[1:], length) >= length
    hit = np.zeros(len(text), bool)
    hit[order[:-1][near]] = True
    hit[order[1:][near]] = True
    return [hit[a : a + k] for a, k in zip(begins.tolist(), sizes, strict=True)]

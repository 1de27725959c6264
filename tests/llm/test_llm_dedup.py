"""Exact copies, near copies and repeated strings against brute force."""

import hashlib
from collections import defaultdict

import pytest
from llm_rows import DOCS, LONG, empty, frame, prose, rows

from feederlens.llm import exact_dedup, repeats, simhash, suffix_sort
from feederlens.llm.common import words


def components_of(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if linked(a, b):
                root[find(a)] = find(b)
    return {k: find(k) for k in keys}


def test_polynomial_composes():
    text = bytes(range(256)) * 40
    assert exact_dedup.polynomial(text, 7) == exact_dedup.polynomial(text, 1000) == (len(text), int.from_bytes(text, "big") % exact_dedup.PRIME)
    assert exact_dedup.polynomial(b"\0a") != exact_dedup.polynomial(b"a")


def expected_groups(docs):
    bare = [(d, len(t or ""), "".join((t or "").translate({c: None for c in b" \t\n\x0b\x0c\r"}))) for d, t in docs]
    groups = defaultdict(list)
    for d, n, body in bare:
        groups[body].append((n, d))
    out = []
    for d, _, body in bare:
        top = max(n for n, _ in groups[body])
        ids = [x for n, x in groups[body] if n == top and x is not None]
        keep = min(ids, default=None)
        out.append((d, keep, len(groups[body]), d == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("size", [exact_dedup.CHUNK, 5])
def test_exact_groups(llm, size):
    got = rows(exact_dedup.exact_groups(frame(llm), size), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == expected_groups(DOCS)
    assert exact_dedup.exact_groups(empty(llm)).count() == 0


def test_equal_fingerprints_are_compared(llm):
    # All fingerprints collide: the chunks must tell the texts apart.
    docs = [(d, t) for d, t in DOCS if t not in (LONG, LONG + " ")]
    marks = exact_dedup.exact_groups(frame(llm, docs), 5, lambda body, size: (7, 7))
    assert rows(marks, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected_groups(docs)


def test_without_copies(llm):
    left = exact_dedup.without_copies(frame(llm))
    assert left.columns == frame(llm).columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 6, 7, 8, 10, 11, 13]


def test_near_groups(llm):
    docs = DOCS + [(20 + i, prose(1, 400) + f" end{i}") for i in range(6)] + [(40 + i, prose(i, 30)) for i in range(40)]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_groups(frame(llm, docs)).collect()}
    marks = {d: simhash.fingerprint(t) for d, t in docs if d is not None}
    low = components_of(sorted(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    smallest = defaultdict(list)
    for d, c in low.items():
        smallest[c].append(d)
    for d, c in low.items():
        assert got[d, f"{marks[d]:016x}"] == min(smallest[c])
    assert got[None, f"{simhash.fingerprint('without an id'):016x}"] is None
    assert got[None, "0" * 16] == 4
    assert simhash.near_groups(empty(llm)).count() == 0
    left = simhash.without_near_copies(frame(llm, docs))
    assert sorted({r.doc_id for r in left.collect() if r.doc_id}) == sorted({min(v) for v in smallest.values()})


def test_pigeonring_finds_every_pair(llm):
    import random

    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    marks = set(base)
    for x in base:
        for n in range(1, 7):
            y = x
            for b in rnd.sample(range(64), n):
                y ^= 1 << b
            marks.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in marks]
    got = {(r.a, r.b) for r in simhash.links(llm.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}


def test_fingerprint_by_hand():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    text = "one two three four five six"
    hashes = [xxhash.xxh64_intdigest(" ".join(text.split()[i:i + 4]).encode(), 42) for i in range(3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    assert simhash.fingerprint(text) == want
    assert words("A b\x0bC") == ["a b".encode(), b"c"]


def test_suffix_array_by_comparison():
    import random

    rnd = random.Random(3)
    for _ in range(100):
        bodies = [bytes(rnd.choice(b"abc\0") for _ in range(rnd.randrange(50))) for _ in range(rnd.randint(1, 5))]
        text, _ = suffix_sort.joined(bodies)
        assert [text[i:] for i in suffix_sort.suffix_array(text, 400)] == sorted(text[i:] for i in range(len(text)))


def expected_repeats(docs, length):
    places = defaultdict(list)
    raw = [(t or "").encode() for _, t in docs]
    for n, body in enumerate(raw):
        for i in range(len(body) - length + 1):
            places[body[i:i + length]].append((n, i))
    gone = [bytearray(len(b)) for b in raw]
    for found in places.values():
        if len(found) > 1:
            for n, i in found:
                gone[n][i:i + length] = b"\1" * length
    out = []
    for (d, _), body, mark in zip(docs, raw, gone, strict=True):
        kept = bytes(c for c, m in zip(body, mark, strict=True) if not m)
        spans = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((d, len(body), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("per_key", [64, 1])
def test_repeats(llm, monkeypatch, per_key):
    monkeypatch.setattr(repeats, "PER_KEY", per_key)
    passage = prose(2, 12)
    docs = [(d, t) for d, t in DOCS if t not in (LONG, LONG + " ")]
    docs += [(100 + i, prose(i, 30) + " " + passage + " " + prose(50 + i, 20)) for i in range(12)]
    docs += [(200, "a" * 500), (201, "xy" * 300), (202, prose(1, 60)), (203, prose(1, 60)), (204, "x" + prose(1, 60)[3:]), (205, "é" * 150)]
    df = frame(llm, docs)
    got = rows(repeats.repeat_digest(df, 80, 24), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == expected_repeats(docs, 80)


def test_repeats_keep_columns(llm):
    df = frame(llm, DOCS)
    left = repeats.without_repeats(df)
    assert left.columns == df.columns and left.count() == len(DOCS)
    assert {r.text for r in left.where("doc_id IN (9, 10)").collect()} == {"", " "} or left.where("doc_id = 9").first().text == ""
    assert repeats.repeat_digest(empty(llm)).count() == 0

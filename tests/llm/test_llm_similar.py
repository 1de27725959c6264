"""Near copies of the pipeline's stage against all pairs."""

import random

import numpy as np
import pytest
from llm_rows import DOCS, empty, frame, prose

from feederlens.llm import similar
from feederlens.llm.common import words


def shingles(text, k=5):
    found = words(text)
    return {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()


def survivors(docs):
    """Smallest doc_id of each group, by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in docs if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted({find(d) for d in root})


def edited(text, every, seed):
    """The text with single words changed, about one in `every`."""
    found = text.split()
    rnd = random.Random(seed)
    for i in range(rnd.randrange(every), len(found), every):
        found[i] = f"edit{seed}x{i}"
    return " ".join(found)


def planted():
    """Copies around a similarity of 0.8, masses of them, and texts that mostly share boilerplate."""
    docs, base, shared = [], [prose(i, 300, 900) for i in range(12)], prose(77, 150, 900)
    for i, text in enumerate(base):
        docs.append((1000 + 100 * i, text))
        docs += [(1000 + 100 * i + n, edited(text, every, 100 * i + n)) for n, every in enumerate((25, 35, 45, 50, 60, 90, 140), 1)]
        docs.append((1090 + 100 * i, " ".join(text.split()[: 235 + i])))
    docs += [(5000 + i, edited(base[0], 80, i)) for i in range(90)]
    docs += [(6000 + i, shared + " " + prose(900 + i, 40 + 10 * (i % 4), 900)) for i in range(60)]
    return docs + [(7000 + i, shared + f" end{i}") for i in range(20)]


@pytest.mark.parametrize("heavy", [16, 4])
def test_stage_finds_every_similar_text(llm, monkeypatch, heavy):
    from corpus_pipeline import drop_near_copies

    monkeypatch.setattr(similar, "LEAST_HEAVY", heavy)
    docs = planted() + [(d, t) for d, t in DOCS if d is not None]
    left = drop_near_copies(llm, frame(llm, docs), "")
    assert left.columns == frame(llm).columns
    assert sorted({r.doc_id for r in left.collect()}) == survivors(docs)
    assert drop_near_copies(llm, empty(llm), "").count() == 0


def test_parity_bits_never_say_too_much():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        pool = rnd.integers(0, 2**63, 3000).astype(np.uint64)
        a, b = (np.unique(rnd.choice(pool, rnd.integers(1, 2000))) for _ in range(2))
        assert similar.apart(similar.parity(a), similar.parity(b)) <= len(np.setxor1d(a, b))


def test_stage_takes_candidates_from_simhash(llm, monkeypatch):
    from corpus_pipeline import drop_near_copies

    asked, alike = [], similar._alike

    def seen(sets, *more):
        pairs = alike(sets, *more)
        asked.append(({r.s: r.fp for r in sets.collect() if r.n}, {(r.a, r.b) for r in pairs.collect()}))
        return pairs

    monkeypatch.setattr(similar, "_alike", seen)
    docs = [(100 * i + n, edited(prose(i, 300, 900), 150, n) if n else prose(i, 300, 900)) for i in range(8) for n in range(12)]
    left = drop_near_copies(llm, frame(llm, docs), "")
    assert sorted({r.doc_id for r in left.collect()}) == survivors(docs)

    [(marks, pairs)] = asked
    made = similar.Shingles(similar.WORDS)
    for _, text in docs:
        hashes = [int(h) for h in made.of(text)]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert marks[np.uint64(similar._name(made.of(text))).astype(np.int64)] % 2**64 == bits
    root = {s: s for s in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in marks.items():
        for b, y in marks.items():
            if ((x ^ y) % 2**64).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert pairs == {(find(s), s) for s in marks if find(s) != s} and pairs


def test_pairs_of_a_large_family_grow_with_its_size(llm, monkeypatch):
    from corpus_pipeline import drop_near_copies

    rnd, base, pairs = random.Random(5), prose(4242, 150, 900).split(), []

    def copy(n):
        found = list(base)
        for i in rnd.sample(range(len(found)), rnd.randrange(1, 15)):
            found[i] = f"own{n}x{i}"
        return " ".join(found)

    def counted(df, name, staged=similar.staged):
        made = staged(df, name)
        if name in ("possible", "likely"):
            pairs.append(made.count())
        return made

    monkeypatch.setattr(similar, "staged", counted)
    for n in (150, 450):
        docs = [(1, " ".join(base))] + [(10 + i, copy(1000 * n + i)) for i in range(n)]
        left = drop_near_copies(llm, frame(llm, docs), "")
        assert sorted({r.doc_id for r in left.collect()}) == survivors(docs)
        assert max(pairs) <= 4 * n, pairs


def test_texts_that_only_share_a_phrase_make_no_pairs(llm, monkeypatch):
    from corpus_pipeline import drop_near_copies

    pairs = []

    def counted(df, name, staged=similar.staged):
        made = staged(df, name)
        if name == "possible":
            pairs.append(made.count())
        return made

    monkeypatch.setattr(similar, "staged", counted)
    # No shingle is heavy here, so many of the phrase's stand among the first of each text.
    monkeypatch.setattr(similar, "LEAST_HEAVY", 10_000)
    phrase = prose(78, 40, 900)
    docs = [(i, " ".join([prose(3000 + i, 150 + 2 * i, 900), phrase, prose(4000 + i, 60, 900)])) for i in range(70)]
    docs += [(500 + i, edited(docs[i][1], 60, i)) for i in range(0, 70, 7)]
    left = drop_near_copies(llm, frame(llm, docs), "")
    assert sorted({r.doc_id for r in left.collect()}) == survivors(docs)
    assert len(pairs) == 1 and pairs[0] <= 2 * len(docs)


def test_short_parity_bits_never_say_too_much(llm):
    rnd = np.random.default_rng(4)
    pool = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    for share in ((4, 5), (1, 2), (1, 4)):
        rows, want = [], set()
        made = [np.unique(rnd.choice(pool, n)) for n in rnd.integers(20, 1200, 30)]
        made += [np.unique(np.concatenate([a[: len(a) * 9 // 10], rnd.choice(pool, len(a) // 20)])) for a in made]
        for i, a in enumerate(made):
            bits = similar.short(similar.parity(a))
            assert len(bits) <= similar.SHORT_BITS // 8
            rows.append((1, i, i, len(a), 0, bytearray(bits)))
            want |= {(j, i) for j, b in enumerate(made[:i]) if len(np.intersect1d(a, b)) * share[1] >= len(np.union1d(a, b)) * share[0]}
        met = llm.createDataFrame(rows, "key long, s long, c long, n int, at int, short binary")
        assert want <= {(r.a, r.b) for r in similar._possible(met, share).collect()} and want

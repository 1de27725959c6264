"""Passages of more than fifty words that recur, against brute force."""

import random
import re
from collections import defaultdict

import pytest
from llm_rows import DOCS, LONG, empty, frame

from feederlens.llm import repeats


def plain(docs, length=400, passage=51):
    """What is left of each text, by comparing all its windows of bytes and of words."""
    places = defaultdict(list)
    raw = [(t or "").encode() for _, t in docs]
    for n, body in enumerate(raw):
        for i in range(len(body) - length + 1):
            places[body[i : i + length]].append((n, i, i + length))
        words = list(re.finditer(rb"[^ \t\n\x0b\x0c\r]+", body))
        for i in range(len(words) - passage + 1):
            some = words[i : i + passage]
            places[tuple(w[0] for w in some)].append((n, some[0].start(), some[-1].end()))
    gone = [bytearray(len(b)) for b in raw]
    for found in places.values():
        for n, a, b in found if len(found) > 1 else ():
            gone[n][a:b] = b"\1" * (b - a)
    return [bytes(c for c, m in zip(b, g, strict=True) if not m).decode("utf-8", "ignore") for b, g in zip(raw, gone, strict=True)]


def unique(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def passages():
    """Passages of 50 to 60 short words in several texts, with other blanks too, and one of few words but many bytes."""
    docs = [(d, t) for d, t in DOCS if t not in (LONG, LONG + " ")]
    for n in (50, 51, 52, 60):
        shared = " ".join(f"p{n}{chr(97 + i % 26)}{i}" for i in range(n))
        docs += [(1000 + n, unique(f"a{n}x", 20) + " " + shared + " " + unique(f"b{n}x", 9)), (2000 + n, shared.replace(" ", "\n ") + " " + unique(f"c{n}x", 30))]
    long = "ほげ" * 30 + " " + "é" * 130
    docs += [(3000, "left " + long + " right"), (3001, "other " + long + " side"), (3002, "ha " * 90), (3003, unique("z", 70))]
    # A passage among ever new surroundings.
    return docs + [(4000 + i, unique(f"s{i}x", 12 + i % 3) + " " + unique("hot", 55) + " " + unique(f"t{i}x", 12)) for i in range(30)]


@pytest.mark.parametrize("per_key", [64, 4])
def test_stage_cuts_passages_of_over_fifty_words(llm, monkeypatch, per_key):
    from corpus_pipeline import cut_repeats

    monkeypatch.setattr(repeats, "PER_KEY", per_key)
    docs = passages()
    left = cut_repeats(llm, frame(llm, docs), "")
    assert left.columns == frame(llm).columns
    got = sorted((r.m1, r.text) for r in left.collect())
    assert got == list(enumerate(plain(docs)))
    assert cut_repeats(llm, empty(llm), "").count() == 0


def test_counted_windows_that_are_neighbours_make_one_span(llm):
    body, lone = (bytes(random.Random(11).choices(letters, k=60)) for letters in (range(97, 122), range(65, 90)))
    # The second text has windows 0 to 10 and 20 to 35 of the first one.
    mixed = body[:30] + lone[:14] + body[20:55]
    rows = [(1, sub, 1, sub, [0], len(b) - 19, False, 1, bytearray(b)) for sub, b in ((1, body), (2, mixed), (3, lone))]
    found = {r.sub: list(r.spans) for r in repeats._counted(llm.createDataFrame(rows, repeats.SLICES), 20).collect()}
    assert found == {1: [0, 11, 20, 36], 2: [0, 11, 44, 60]}


def test_wide_rows_are_repeated_for_salts_in_use_only(llm):
    from pyspark.sql import functions as F

    from feederlens.llm.common import join_wide, spread

    left = llm.range(300).selectExpr("id", "IF(id < 100, 7, id) AS k")
    right = llm.range(0, 300, 2).selectExpr("id AS k", "id * 10 AS v").union(llm.createDataFrame([(7, 70)], "k long, v long"))
    want = sorted((i, 70 if i < 100 else 10 * i) for i in range(300) if i < 100 or i % 2 == 0)
    assert sorted((r.id, r.v) for r in join_wide(left, right, ["k"], spread("id")).collect()) == want
    every = join_wide(left, right, ["k"], spread("id"), "left")
    assert every.count() == 300 and every.where(F.col("v").isNull()).count() == 300 - len(want)


def test_equal_blocks_of_a_run_are_one_row(llm):
    body = bytes(random.Random(13).choices(range(97, 122), k=50)) * 30
    row = (1, 2, 1, 2, [0], len(body) - 399, True, 3, bytearray(body))
    blocks = repeats._finer(llm.createDataFrame([row], repeats.SLICES), 400, 100).collect()
    at = {lo + i for b in blocks for lo in b["lo"] for i in range(b["windows"])}
    assert at == set(range(len(body) - 399)) and len(blocks) <= 6
    assert all(body[lo : lo + b["windows"] + 399] == b["body"] for b in blocks for lo in b["lo"])
    assert all(b["rows"] == 3 * len(b["lo"]) for b in blocks)

"""Alignment of two tokenizers against cuts by whole texts' decoded bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from llm_rows import DOCS, empty, frame, rows

from feederlens.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def ends(sizes):
    out, at = [], 0
    for n in sizes:
        at += n
        out.append(at)
    return out


def plain(texts):
    tokens = alignment.Tokens(A, B)
    found = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = tokens.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = tokens.b.encode(text or "")
        a_raw, b_raw = [tokens.a_bytes[i] for i in a], [tokens.b_bytes[i] for i in b]
        if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            found.append([])
            continue
        a_ends, b_ends = ends(map(len, a_raw)), ends(map(len, b_raw))
        groups, i, j = [], 0, 0
        a_at, b_at = ({end: k + 1 for k, end in enumerate(some)} for some in (a_ends, b_ends))
        for cut in sorted(a_at.keys() & b_at.keys()):
            groups.append((a[i : a_at[cut]], b[j : b_at[cut]]))
            i, j = a_at[cut], b_at[cut]
        found.append(groups)
    links = [Counter((x, y) for ours, theirs in groups for x in ours for y in theirs) for groups in found]
    count = Counter(pair for one in links for pair in one)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups, one in zip(found, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(one.values()),
            sum(n for p, n in one.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in one.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


ODD = [
    "  two leading", "trailing  ", "a  b   c\n\n d\t e", "\n", " ", "<s> </s> <|endoftext|> <0x41> <unk>", "nul \0 byte", "a▁b c",
    "🙂🙃👩‍👩‍👧 𝔘𝔫𝔦 ꧁꧂ ༄༅ ᚠᛇᚻ", "日本語のテキスト 中文 한국어", "é̂́ combining Z̷a̸l̶g̴o̵", "1234567890 12 3.14159 +1 (017) 555-7713",
    "x" * 300, " " * 100 + "y", " nbsp em　wide \x1c\x1d sep", "don't you're we'll I'd", "\r\n\r\n  \r", "ﷺﷺ \U0010ffff ﻿bom", "token = \"ab12\"",
]


def noise(seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab \n\t'1.é日🙂ก‍́A_-▁"[: 18 + (i % 5 == 0)]) for _ in range(rnd.randrange(1, 60))) for i in range(120)]


@pytest.mark.parametrize("chars", [alignment.BLOCK_CHARS, 200])
def test_alignment_equals_decoded_bytes(llm, chars):
    docs = [*DOCS, *((100 + i, t) for i, t in enumerate(ODD + noise(5)))]
    want = sorted(((d, *x) for (d, _), x in zip(docs, plain([t for _, t in docs]), strict=True)), key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert rows(alignment.align(frame(llm, docs).repartition(3), A, B, block_chars=chars), *COLUMNS) == want


def test_blocks_are_bounded_and_whole():
    assert list(alignment._slices(["x" * 10, None, "y" * 99, "z", ""], 99)) == [(0, 2), (2, 3), (3, 5)]
    assert list(alignment._slices([], 9)) == []


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_PARTS", 3)
    known = alignment.Aligner(A, B)
    texts = lambda text: [known.text[x] for x in known.numbers([text])[0]]
    first = texts("one two three four five")
    assert texts("one two three four five") == first and len(known.number) == 5
    known.hits[[known.number[w] for w in ("two",)]] = 2
    assert texts("six two") == [texts("six")[0], first[1]]
    assert set(known.number) == {"six", "two"} and known.first[-1] == len(known.pairs) == len(known.times)
    known.hits[:] = 5
    monkeypatch.setattr(alignment, "CACHE_PARTS", 1)
    texts("seven")
    assert set(known.number) == {"seven"}


def test_groups_are_kept_and_empty_tables_pass(llm):
    got = alignment.align(frame(llm, [(1, "naïve 🙂")]), A, B).first()
    assert hashlib.sha256(got.groups.encode()).hexdigest() == got.groups_sha256
    assert alignment.align(empty(llm), A, B).count() == 0


def test_spans_from_ids_are_those_of_the_library():
    tokens = alignment.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    sizes = np.array([len(x) for x in tokens.b_bytes])
    for text in ("plain words here", "日本語 é ½", "\U0001F600\U00012000x", "ñ한글‍\x00  ", "<0x41></s>"):
        ids = np.array(tokens.b.encode(text))
        start, end = alignment.byte_spans(sizes[ids], (" " + text).encode())
        pieces = tokens.b.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in pieces]
        assert end.tolist()[1:] == [p.end + 1 for p in pieces][1:] and start.tolist()[1:] == [max(1, p.begin + 1) for p in pieces][1:]

"""Chat formatting, packing, BPE, scores and filters."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm_rows import DOCS, empty, frame, prose, rows
from tokenizers import Tokenizer

from feederlens.llm import bpe, chat, embedding_dedup, lm_scoring, packing, toxicity, url_filters
from feederlens.llm.merges import Vocabulary

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.tuples(st.text(), st.text(alphabet="<|\\im_startend>\nab"))))
@settings(max_examples=200, deadline=None)
def test_chat_round_trip(turns):
    made = "".join(chat.format_turn(r, t)[0] for r, t in turns)
    assert chat.read_back(made) == turns
    assert made.count(chat.START) == len(turns)


def test_chat_layouts(llm):
    records = [
        (1, '{"prompt": "p", "completion": "c"}'), (2, '{"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": null}]}'),
        (3, '{"instruction": "do", "input": "", "output": "done"}'), (4, '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}'),
        (5, '{"unknown": 1}'), (6, None), (7, "no json"), (None, '{"role": "user", "text": "t", "turn": 3}'), (8, '{"turn": 1, "role": null, "text": null}'),
    ]
    df = llm.createDataFrame(records, "conv_id long, record string")
    got = rows(chat.canonical_turns(df), "conv_id", "turn", "role", "text")
    assert got == sorted([
        (None, 3, "user", "t"), (1, 0, "user", "p"), (1, 1, "assistant", "c"), (2, 0, "user", "u"), (2, 1, "assistant", ""),
        (3, 0, "user", "do"), (3, 1, "assistant", "done"), (4, 0, "user", "h"), (4, 1, "assistant", "g"), (8, 1, "", ""),
    ], key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert sum(r.records for r in chat.unmapped(df).collect()) == 3
    out = {r.conv_id: r for r in chat.format_chats(chat.canonical_turns(df)).collect()}
    assert set(out) == {None, 1, 2, 3, 4, 8}
    a, b = out[1].loss_spans
    assert out[1].formatted[a:b] == "c" and out[2].loss_spans == []
    assert chat.digest(chat.format_chats(chat.canonical_turns(df.limit(0)))).count() == 0


def test_chat_odd_records(llm):
    turn = '{"role": "user", "text": "t", "turn": %s}'
    odd = [
        turn % '"x"', turn % "1.5", turn % "true", turn % str(1 << 63), '{"prompt": "\\ud800", "completion": "c"}', "[" * 200_000,
        "[" * 5000 + "]" * 5000, '{"messages[]": {"role": "a", "content": "b"}}', '{"messages.x": 1, "\\ud800": 2}', "1" * 5000, "null", "",
    ]
    good = [turn % "2", turn % "2", turn % "3.0", turn % "null", turn % str(-(1 << 63)), '{"prompt": "\\ud83d\\ude42", "completion": "%s"}' % ("x" * 3_000_000)]
    df = llm.createDataFrame([(i, r, "z", 9) for i, r in enumerate(odd + good)], "conv_id long, record string, text string, turn long")
    got = sorted((r.conv_id, -1 if r.turn is None else r.turn, r.role, len(r.text)) for r in chat.canonical_turns(df).collect())
    n = len(odd)
    assert got == [
        (n, 2, "user", 1), (n + 1, 2, "user", 1), (n + 2, 3, "user", 1), (n + 3, -1, "user", 1), (n + 4, -(1 << 63), "user", 1),
        (n + 5, 0, "user", 1), (n + 5, 1, "assistant", 3_000_000),
    ]
    assert sum(r.records for r in chat.unmapped(df).collect()) == len(odd)
    # Repeated rows and other columns, and a turn that is far longer than a batch.
    turns = llm.createDataFrame([(1, 1, "user", "u", 5), (1, 1, "user", "u", 6), (1, 2, "assistant", "a" * 2_000_000, 7)], "conv_id long, turn long, role string, text string, formatted long")
    out = chat.digest(chat.format_chats(turns)).first()
    assert (out.n_turns, out.loss_chars) == (3, 2_000_000)


def test_packing_places_every_piece_once(llm):
    docs = DOCS + [(1000 + i, prose(i, i % 90)) for i in range(300)]
    got = packing.pack(frame(llm, docs), WORD, 64).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = Counter()
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for i in range(0, len(ids), 64):
            one = np.array(ids[i:i + 64], "<u4").tobytes()
            want[d, i // 64, i, len(one) // 4, zlib.crc32(one)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(sequences) <= math.ceil(total / 64) + 2
    assert packing.pack(empty(llm), WORD).count() == 0


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30)))
@settings(max_examples=100, deadline=None)
def test_plan_uses_all(counts):
    used = Counter()
    for pattern, times in packing.plan(counts, 40):
        assert sum(pattern) <= 40
        for x in pattern:
            used[x] += times
    assert used == counts


ODD = st.lists(st.sampled_from([
    "a", "B", " ", "  ", "\n", "'s", "1", "é", "ß", ".", "\t", "x" * 70, " \n", " ", "日", "<|endoftext|>", "é", "İ", "Σ", "֋", "🙂", "don't",
]), max_size=12).map("".join)


@pytest.fixture(scope="module")
def encoders():
    vocabulary = Vocabulary(BYTE)
    known = [b"a", b" a", b"don", b"\n"]
    lexicon = bpe.Transducer.mapped(bpe.Transducer.build(dict(zip(known, vocabulary.merged(known), strict=True))).to_bytes())
    return bpe.Encoder(vocabulary, bpe.Splitter(BYTE), lexicon), Tokenizer.from_file(BYTE), packing.WordEncoder(WORD), Tokenizer.from_file(WORD)


@given(st.lists(ODD | st.text(max_size=20), max_size=4))
@settings(max_examples=200, deadline=None)
def test_encoders_agree_with_the_library(encoders, texts):
    own, library, own_words, library_words = encoders
    for text, got in zip(texts, own.encode(texts), strict=True):
        ids = np.frombuffer(got, "<i4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    for text, got in zip(texts, own_words.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library_words.encode(text, add_special_tokens=False).ids


def test_transducer_shares_suffixes():
    entries = {w: np.array([i], "<i4").tobytes() for i, w in enumerate([b"tap", b"taps", b"top", b"tops", b"", b"zaps"])}
    made = bpe.Transducer.build(entries)
    found = made.look_up([b"tops", b"to", b"zaps", b"tap", b"zapsx", b"top"])
    assert [None if x is None else x.tolist() for x in found] == [[3], None, [5], [0], None, [2]]
    assert len(made.final) < 10


def test_bpe_over_a_table(llm):
    library = Tokenizer.from_file(BYTE)
    got = rows(bpe.encode_decode(frame(llm), BYTE, 20), "doc_id", "ids", "decoded")
    want = [(d, library.encode(t or "", add_special_tokens=False).ids, t or "") for d, t in DOCS]
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert bpe.encode_digest(empty(llm), BYTE).count() == 0


def test_frequent_words_come_by_whole_classes(llm):
    counts = llm.createDataFrame([("a", 900), ("b", 901), ("c", 40), ("d", 40), ("e", 2)], "word string, n long")
    assert [sorted(bpe.frequent_words(counts, n)) for n in (5, 4, 3, 2, 1, 0)] == [
        ["a", "b", "c", "d", "e"], ["a", "b", "c", "d"], ["a", "b"], ["a", "b"], [], [],
    ]
    assert bpe.frequent_words(counts.limit(0), 5) == []


def test_bpe_parts_join_to_the_text(encoders):
    own, library, *_ = encoders
    texts = [" a  b", "a\0 b c", "a b\n c ", "", None, "<|endoftext|> a<|endoftext|>", "ab'll d'll", "a\x1cb \x1f c\x85d\x0b\x0c e_1 2x", "".join(map(chr, range(128)))] * 2
    for text, parts in zip(texts, own.entries(texts), strict=True):
        assert b"".join(p[2] for p in parts).decode() == (text or "")
        assert ",".join(p[1] for p in parts) == ",".join(map(str, library.encode(text or "", add_special_tokens=False).ids))


def test_embeddings_by_brute_force(llm, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rnd = np.random.default_rng(1)
    centres = rnd.standard_normal((12, 16))
    vectors = [(c + s * rnd.standard_normal(16)).tolist() for c in centres for s in (0.05, 0.1, 0.2, 0.3, 0.3)]
    vectors += [vectors[0]] * 40 + [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [], [1.0, 2.0], [1e-200] * 16]
    df = llm.createDataFrame([(i if i else None, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, id int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, recall=0.9999).collect()}
    fit = {i: np.array(v) / np.linalg.norm(np.array(v) * 1e150) * 1e150 for i, v in enumerate(vectors)
           if v and None not in v and np.isfinite(v).all() and any(v)}
    for i, v in fit.items():
        near = [j for j, w in fit.items() if j != i and len(v) == len(w) and v @ w >= 0.9]
        assert got[i or None].n_links == len(near), i
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(100, 105))
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rnd = np.random.default_rng(2)
    unit = rnd.standard_normal((400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    code, factor, _ = embedding_dedup.encode(unit, 8, 2)
    got, bound = embedding_dedup.estimate(code, factor, unit)
    off = got - unit @ unit.T
    assert abs(off.mean()) < 0.005
    assert (np.abs(off) <= bound[:, None]).mean() > 0.9999


def toxic_rows():
    docs, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        docs.append((i, prose(i, 40) + (" you moron and idiot" if bad else " you friend")))
        if i % 2 == 0:
            labels.append((i, int(bad), None))
    return docs, labels


def test_toxicity_learns_and_restores(llm):
    docs, labels = toxic_rows()
    docs += [(900, "such an 1d!0t"), (901, "m o r o n"), (902, ""), (903, None), (904, "moroooon"), (None, "idiot")]
    got = {r.doc_id: r for r in toxicity.toxicity(frame(llm, docs), llm.createDataFrame(labels, "doc_id long, toxic int, text string")).collect()}
    assert len(got) == len(docs)
    assert all(got[d].predicted == int(d % 5 == 0) for d in range(400))
    assert [got[d].predicted for d in (900, 901, 902, 903, 904, None)] == [1, 1, 0, 0, 1, 1]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    left = toxicity.clean(frame(llm, docs), llm.createDataFrame(labels, "doc_id long, toxic int, text string"))
    assert left.columns == frame(llm, docs).columns and left.count() == sum(r.predicted == 0 for r in got.values())
    none = toxicity.toxicity(frame(llm), llm.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity.toxicity(empty(llm), llm.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_lm_base_scores_and_distribution(llm):
    docs = DOCS + [(300 + i, prose(i % 7, 30)) for i in range(150)]
    got = [r.asDict() for r in lm_scoring.lm_scores(frame(llm, docs)).collect()]
    split = lambda t: (t or "").encode().lower().split() + [None]
    apart = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    counts = Counter(w for d, t in docs if not apart(d) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in docs:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t))
        want.append((d, apart(d), len(split(t)), sum(counts[w] > 0 for w in split(t)), n, round(base, 6)))
    have = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(have, key=order) == sorted(want, key=order)
    late = [r for r in got if r["held_out"] and r["doc_id"] >= 300]
    assert sum(r["score"] for r in late) > sum(r["base_score"] for r in late)
    assert lm_scoring.lm_scores(empty(llm)).count() == 0


def test_lm_known_tokens(llm):
    end = lm_scoring.token_hash(lm_scoring.END_TOKEN)
    counted = [(i, n, n - 1) for i, n in enumerate([50, 20, 20, 7, 7, 7, 1, 1])] + [(end, 1, 1)]
    counts = llm.createDataFrame(counted, "token long, n long, n_train long")
    known = lambda most: {r.token for r in lm_scoring.known_tokens(counts, most).collect()}
    assert known(9) == {*range(8), end}
    assert known(5) == known(3) == {0, 1, 2, end}  # ties are taken together or not at all
    assert known(0) == {end}


def test_lm_probabilities_sum_to_one():
    """All texts of one word, from the vocabulary or spelled: with the escape's share they make one."""
    model = lm_scoring.Model(np.array([3, 5, 9]), np.array([4, 2, 1]), 7, 3, np.ones(257))
    model.end_place = 0
    model.stretch[:] = np.random.default_rng(1).normal(size=model.stretch.shape).astype(np.float32)
    first, _ = np.zeros(1), None
    total = 0.0
    for symbol_place in (0, 1, 2, 3):
        rows_ = [[b"x"]]
        bits = lm_scoring.Bits(model, rows_, [[symbol_place]])
        word = [(b, s, t, x, n, d) for b, s, t, x, n, d in bits.parts[:1]]
        k = model.words.length[model.symbol[symbol_place]]
        b, s, t, x, n, d = word[0]
        cut = lm_scoring.Bits.__new__(lm_scoring.Bits)
        cut.parts = [(b[:k], [y[:k] for y in s], t, x[:k], n[:k], d[:k])]
        total += 10 ** lm_scoring.log_probabilities(model, cut, 1)[0]
    assert total == pytest.approx(1, abs=1e-6)


def test_url_lists(llm):
    pages = [
        (1, "http://A.b.example.com/x", "2024-01-10"), (2, "https://u@c.example.com:80", "2024-01-10"), (3, "http://c.example.com", "2024-01-04"),
        (4, "no url", "2024-01-10"), (5, None, "2024-01-10"), (6, "http://x.org", None), (7, "http://b.example.com.", "2024-03-01"), (7, "http://b.example.com.", "2024-03-01"), (8, "http://d.example.com", "2031-05-05"),
    ]
    entries = [
        ("example.com", "block", "2024-01-05"), ("b.example.com", "allow", "2024-01-08"), ("b.example.com", "block", "2024-02-01"),
        ("b.example.com", "allow", "2024-02-01"), (None, "block", "2024-01-01"), ("x.org", None, "2024-01-01"), ("x.org", "block", None), ("", "block", "2024-01-01"),
    ]
    df = llm.createDataFrame(pages, "page_id long, url string, d string").selectExpr("*", "CAST(d AS date) AS fetched_on", "'z' AS pattern")
    listed = llm.createDataFrame(entries, "pattern string, action string, d string").selectExpr("*", "CAST(d AS date) AS listed_on")
    got = rows(url_filters.filter_captures(df, listed), "page_id", "pattern", "action")
    assert got == [
        (1, "b.example.com", "allow"), (2, "example.com", "block"), (3, None, "none"), (4, None, "none"), (5, None, "none"), (6, None, "none"),
        (7, "b.example.com", "block"), (7, "b.example.com", "block"), (8, "example.com", "block"),
    ]
    assert url_filters.filter_captures(df.limit(0), listed).count() == 0

"""Personal data: base spans against plain patterns, and identifiers that contexts teach."""

import hashlib
import random
import re

import pytest
from llm_rows import DOCS, empty, frame, rows

from feederlens.llm import personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def line(spans):
    return ",".join(f"{k}:{i}:{j}" for k, i, j in spans)


def card(rnd, n=16):
    digits = [rnd.randrange(10) for _ in range(n - 1)]
    return "".join(map(str, digits + [next(d for d in range(10) if luhn([*digits, d]))]))


ODD = [
    "a@b.c_x@d.e.f@g.h x@y@z.com %%@a-.b..c é🙂.mail@host.example.org.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.255.00255 1..2.3.4 12.34.56.999",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 1 2 3", "x4111111111111111 27.65.93.188 4111111111111111  5",
    "+1 (017) 555-7713 +1 2 +123456789 +12345678901234567 ++44 20 7946 0958.", "1" * 5000, "1 " * 3000 + "x", "a." * 4000 + "@b", "a@" * 3000, "-" * 50 + "1-" * 900,
    "0" * 14, "0 0-0 0-0 0-0 0-0 0-0 0 0 0", "+0((((((((((0", "٣.٤.٥.٦ １２３４", "1.1.1.1@x.y +1.1.1.1111111", "12) (34) (56-78/90 12x",
]


def noise(seed, n=150):
    rnd = random.Random(seed)
    some = ["@", ".", "+", " ", "-", "1", "23", "4567", "a", "b.c", "é", "🙂", "(", ")", "\n", "_", "255", "4111111111111111", "x@y.zz", "1.2.3.4"]
    return ["".join(rnd.choice(some) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]


def test_base_spans_equal_plain_patterns(llm):
    docs = [*DOCS, *((100 + i, t) for i, t in enumerate(ODD + noise(7)))]
    got = personal_data.personal_data(frame(llm, docs).repartition(3))
    kinds = lambda spans: [sum(s[0] == k for s in spans) for k in PLAIN]
    want = [(d, *kinds(plain(t)), hashlib.sha256(line(plain(t)).encode()).hexdigest()) for d, t in docs]
    assert rows(got, "doc_id", *(f"n_{k}" for k in PLAIN), "base_sha256") == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    by_text = {d: t for d, t in docs}
    for r in got.collect():
        spans = [(k, int(i), int(j)) for k, i, j in (s.split(":") for s in r.spans.split(",") if s)]
        assert set(plain(by_text[r.doc_id])) <= set(spans) or r.doc_id in (None, 12)
        assert len(spans) == sum(r[f"n_{k}"] for k in PLAIN) + r.n_added
    assert personal_data.personal_data(empty(llm)).count() == 0


def taught(seed=3):
    rnd = random.Random(seed)
    docs = []
    for i in range(30):
        a, b, c = rnd.randrange(100, 999), rnd.randrange(100, 999), rnd.randrange(1000, 9999)
        docs += [
            f"please dial +1 ({a}) {b}-{c} today", f"write to mail: u{i}x{a}@host{b}.example.com now",
            f"paid by card {card(rnd)} yesterday", f"from server {a % 256}.{b % 256}.{i}.7 again",
            f"the order {rnd.randrange(10**9, 10**10)} of item {a}-{b}-{c} is open", f"the {a}{b}{c}99 and version {i}.{a}.{b} of it",
        ]
    return docs


@pytest.mark.parametrize("copies", [1, 40])
def test_contexts_find_what_base_patterns_miss(llm, copies):
    rnd = random.Random(9)
    number = card(rnd)
    new = [
        ("please dial (415) 555-2671 today", "phone", "(415) 555-2671"), ("write to mail: someone@localhost now", "email", "someone@localhost"),
        (f"{number} 10.20.30.40", "card", number), ("from server fe80:0:0:1::a9 again", "ip", "fe80:0:0:1::a9"),
        ("write to mail: jane (at) host (dot) org now", "email", "jane (at) host (dot) org"),
    ]
    clean = ["the order 5551234567 of item 415-555-2671 is open", "please dial tomorrow", "the someone@localhost and 300.1.2.3", "card 1234567890123456 yesterday"]
    docs = list(enumerate([*taught(), *([t for t, _, _ in new] + clean) * copies]))
    got = {r.doc_id: r for r in personal_data.personal_data(frame(llm, docs)).collect()}
    first = len(taught())
    for i, (text, kind, value) in enumerate(new):
        spans = got[first + i].spans.split(",")
        assert f"{kind}:{text.index(value)}:{text.index(value) + len(value)}" in spans, (text, spans)
    for i, text in enumerate(clean[:2] + clean[3:]):
        at = first + len(new) + clean.index(text)
        assert got[at].n_added == 0, (text, got[at].spans)
    assert all(r.n_added == 0 for d, r in got.items() if d < first)


def test_scores_equal_a_plain_model(llm):
    rnd = random.Random(4)
    edges = sorted({(rnd.randrange(12) ** 2 // 12, rnd.randrange(60)) for _ in range(400)})
    seeds = [(i, "ab"[i % 7 == 0]) for i in range(35)]
    made = llm.createDataFrame(edges, "pattern long, instance long"), llm.createDataFrame(seeds, "instance long, kind string")
    for support, good, sure in ((3, 0.45, 0.6), (5, 0.5, 0.5)):
        got = {(r.instance, r.kind): round(r.score, 9) for r in personal_data.bootstrap(*made, support, good, sure, 3).collect()}
        known = {(i, k): 1.0 for i, k in seeds}
        size = {p: sum(e[0] == p for e in edges) for p, _ in edges}
        for _ in range(3):
            strong = {}
            for p in size:
                for k in "ab":
                    mine = [known[i, k] for q, i in edges if q == p and (i, k) in known]
                    score = sum(mine) / (size[p] + 1)
                    if size[p] >= support and sum(x == 1 for x in mine) >= support and score >= good:
                        strong[p, k] = score
            proposed = {}
            for i in {i for _, i in edges} - {i for i, _ in seeds}:
                for k in "ab":
                    doubt = 1.0
                    for p, j in edges:
                        doubt *= 1 - strong.get((p, k), 0) if j == i else 1
                    if 1 - doubt >= sure:
                        proposed[i] = max(proposed.get(i, (0, "")), (1 - doubt, k))
            known = {(i, k): 1.0 for i, k in seeds} | {(i, k): min(s, 0.999) for i, (s, k) in proposed.items()}
        assert got == {x: round(s, 9) for x, s in known.items()}

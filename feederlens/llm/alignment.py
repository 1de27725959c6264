"""Alignment of two tokenizers: which of their tokens cover the same bytes, and how often ids meet in the corpus.

A is a byte-level BPE file for tokenizers, B a BPE model for sentencepiece. Both libraries say which span of the text
a token covers. A token end of both sides that no next token reaches back over is a coarse cut. Between coarse cuts,
where characters of several bytes are shared by tokens or spelled as bytes, the tokens' decoded bytes decide.

Neither side merges over a single blank between two other characters, so texts are aligned part by part, and a
task remembers parts. Documents are taken in blocks of bounded text: a block's distinct pairs and the documents that
hold them are what is counted over the corpus, and the counts come back to the block, not to each document."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.common import discard, join_unique, spread, staged
from feederlens.llm.merges import byte_symbols

#: Characters of a block; a longer document is a block of its own.
BLOCK_CHARS = 4_000_000
#: Parts that a task remembers, at most.
CACHE_PARTS = 400_000
#: Parts that are encoded as one text.
TOGETHER = 500
#: A blank between two characters that are none.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"^\s| \s|\s |\s\Z")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Tokens:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        symbols, named = byte_symbols(), {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [self._symbols(named.get(i, ""), symbols) for i in range(max(named) + 1)]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]

    @staticmethod
    def _symbols(token: str, symbols: dict[str, int]) -> bytes:
        return bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()

    @staticmethod
    def _piece(piece: str) -> bytes:
        if found := _BYTE.fullmatch(piece):
            return bytes([int(found[1], 16)])
        return piece.replace("▁", " ").encode()


def bytes_before(text: str) -> np.ndarray:
    """Bytes before each character of the text, and of all of it."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])


def byte_spans(sizes: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Spans in bytes of tokens that decode to the text. A token that ends within a character ends before it, so a
    character's last byte has it whole and the bytes before that have nothing."""
    heads = (np.frombuffer(raw + b" ", np.uint8) & 0xC0) != 0x80
    before = np.maximum.accumulate(np.where(heads, np.arange(len(heads)), 0))
    end = np.minimum(np.cumsum(sizes), len(raw))
    return before[np.maximum(end - sizes, 0)], before[end]


class Side:
    """One tokenizer's tokens of a text as arrays: ids, spans in bytes, and where their decoded bytes end."""

    def __init__(self, ids: np.ndarray, start: np.ndarray, end: np.ndarray, known: list[bytes], lengths: np.ndarray, raw: bytes):
        self.ids, self.end, self.decoded = ids, end.copy(), np.cumsum(lengths[ids])
        self.good = b"".join(map(known.__getitem__, ids.tolist())) == raw
        # An end that the next span reaches back over is inside a character; empty spans (bytes of a character before
        # its last one) end nothing.
        reached = np.zeros(len(ids), bool)
        reached[:-1] = start[1:] < end[:-1]
        self.clean = (end > start) & ~reached
        if len(ids):
            self.clean[-1], self.end[-1] = True, len(raw)


def cuts(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end a group."""
    common = lambda x, y: np.intersect1d(x, y, assume_unique=True)
    coarse = common(a.end[a.clean], b.end[b.clean])
    ours, theirs = (x.clean & np.isin(x.end, coarse) for x in (a, b))
    # Between coarse cuts with several tokens on both sides, decoded bytes that end together cut too.
    at, bt = np.cumsum(ours) - ours, np.cumsum(theirs) - theirs
    several = (np.bincount(at, minlength=len(coarse)) > 1) & (np.bincount(bt, minlength=len(coarse)) > 1)
    fine = common(a.decoded[several[at]], b.decoded[several[bt]])
    return ours | (several[at] & np.isin(a.decoded, fine)), theirs | (several[bt] & np.isin(b.decoded, fine))


class Aligner:
    """Alignments of parts, remembered; a part's number is its place in all of the lists."""

    def __init__(self, a_path: str, b_path: str):
        tokens = self.tokens = Tokens(a_path, b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in some]) for some in (tokens.a_bytes, tokens.b_bytes))
        top = max(len(self.a_size), len(self.b_size))
        #: Decimal ids with what follows them: more of the side, the other side, the next group, nothing.
        self.decimal, self.top = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(top)], top
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.good, self.counts = np.empty(0, bool), np.empty((0, 4), np.int64)
        #: Pairs of all parts one after another, with their times, and the first of each part.
        self.pairs, self.times, self.first = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64)
        #: Blocks in which each part was, since parts were last left out.
        self.hits = np.empty(0, np.int64)

    def thin(self) -> None:
        """Forgets the parts that only one block had, or all if that leaves too many."""
        keep = np.flatnonzero(self.hits > 1)
        if len(keep) > CACHE_PARTS // 2:
            self.forget()
            return
        names, wide = list(self.number), self.first[keep + 1] - self.first[keep]
        at = np.arange(wide.sum()) + np.repeat(self.first[keep] - (np.cumsum(wide) - wide), wide)
        self.number = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.text = [self.text[k] for k in keep.tolist()]
        self.good, self.counts, self.pairs, self.times = self.good[keep], self.counts[keep], self.pairs[at], self.times[at]
        self.first, self.hits = np.concatenate([[0], np.cumsum(wide)]), np.zeros(len(keep), np.int64)

    @staticmethod
    def parts(text: str) -> list[str]:
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def learn(self, parts: list[str]) -> None:
        """Aligns parts. Those that neither begin nor end with blanks are aligned together, as one text."""
        plain = [p for p in parts if p and not p[0].isspace() and not p[-1].isspace()]
        single = dict.fromkeys(parts, 1)
        for p in plain:
            del single[p]
        made = [x for at in range(0, len(plain), TOGETHER) for x in self._aligned(plain[at : at + TOGETHER])]
        made += [x for p in single for x in self._aligned([p])]
        names = [p for x in made for p in x[0]]
        self.number.update(zip(names, range(len(self.number), len(self.number) + len(names)), strict=True))
        self.text += [t for x in made for t in x[1]]
        self.good, self.counts, self.pairs, self.times = (
            np.concatenate([old, *(x[k] for x in made)]) for k, old in enumerate((self.good, self.counts, self.pairs, self.times), 2)
        )
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([x[6] for x in made]))])
        self.hits = np.concatenate([self.hits, np.zeros(len(names), np.int64)])

    def _aligned(self, parts: list[str]) -> list[tuple]:
        """Parts with their texts, goodness, counts, pairs, times and numbers of pairs. A text that a side does not
        give back is halved until the part at fault is alone."""
        theirs = " ".join(parts)
        ours = " " + theirs
        raw = ours.encode()
        found = self.tokens.a.encode(ours, add_special_tokens=False)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64).reshape(-1, 2)
        if len(raw) != len(ours):
            spans = bytes_before(ours)[spans]
        a = Side(np.array(found.ids, np.int64), *spans.T, self.tokens.a_bytes, self.a_size, raw)
        # B's ids alone come at a third of the cost of its protos, whose spans follow from the decoded bytes.
        ids = np.array(self.tokens.b.encode(theirs), np.int64)
        b = Side(ids, *byte_spans(self.b_size[ids], raw), self.tokens.b_bytes, self.b_size, raw)
        if a.good and b.good:
            return [(parts, *self._linked(parts, a, b))]
        if len(parts) > 1:
            half = len(parts) // 2
            return self._aligned(parts[:half]) + self._aligned(parts[half:])
        nothing = np.empty(0, np.int64)
        return [(parts, [""], np.zeros(1, bool), np.zeros((1, 4), np.int64), nothing, nothing, np.zeros(1, np.int64))]

    def _linked(self, parts: list[str], a: Side, b: Side) -> tuple:
        n = len(parts)
        sizes = np.array([len(p.encode()) + 1 for p in parts])
        a_part, b_part = (np.searchsorted(np.cumsum(sizes), x.decoded, "left") for x in (a, b))
        a_cut, b_cut = cuts(a, b)
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        group_part = a_part[a_cut]
        # All pairs of a group; equal ids are multiplied, not listed.
        x, x_n = np.unique(a_group << 32 | a.ids, return_counts=True)
        y, y_n = np.unique(b_group << 32 | b.ids, return_counts=True)
        wide = np.bincount(y >> 32, minlength=len(group_part))
        start, reach = np.cumsum(wide) - wide, wide[x >> 32]
        left = np.repeat(np.arange(len(x)), reach)
        right = np.arange(reach.sum()) + np.repeat(start[x >> 32] - (np.cumsum(reach) - reach), reach)
        low, size = (1 << 32) - 1, len(self.b_size)
        span = len(self.a_size) * size
        key, where = np.unique(group_part[x[left] >> 32] * span + (x[left] & low) * size + (y[right] & low), return_inverse=True)
        times = np.bincount(where, x_n[left] * y_n[right], len(key)).astype(np.int64)
        key_part, key = key // span, key % span
        counts = [np.bincount(some, weights, n).astype(np.int64) for some, weights in ((a_part, None), (b_part, None), (group_part, None), (key_part, times))]
        # Both sides' ids in the order of groups, each with what follows it.
        end = np.ones(len(b_part), bool)
        end[:-1] = b_part[1:] != b_part[:-1]
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        marks = np.concatenate([a_cut * 1, np.where(end, 3, b_cut * 2)])
        codes = (marks * self.top + np.concatenate([a.ids, b.ids]))[order]
        pieces = list(map(self.decimal.__getitem__, codes.tolist()))
        ends = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).tolist()
        texts = ["".join(pieces[i:j]) for i, j in zip(ends, ends[1:], strict=False)]
        pairs = (key // size) << 32 | key % size
        return texts, np.ones(n, bool), np.stack(counts, 1), pairs, times, np.bincount(key_part, minlength=n)

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """The numbers of each text's parts; those of a block fit the memory whatever is remembered."""
        if len(self.text) > CACHE_PARTS:
            self.thin()
        cut = [self.parts(t) if t else [] for t in texts]
        known = self.number
        missing = list(dict.fromkeys(p for some in cut for p in some if p not in known))
        if missing:
            self.learn(missing)
        return [[known[p] for p in some] for some in cut]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for all tasks that a worker runs."""
    return Aligner(a_path, b_path)


#: A row of a document has places of its pairs in its block's list, and times; the row of a block has that list.
ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
    " places array<int>, times array<int>, pairs array<long>, docs array<int>"
)


def _slices(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded length."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool, block_chars: int) -> DataFrame:
    """Groups and pairs of the documents, in blocks (ALIGNED)."""
    names = [x.split()[0] for x in re.split(r",\s*", ALIGNED)]
    types = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64()), pa.list_(pa.int32())]

    def block(known: Aligner, number: int, ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
        numbers = known.numbers(texts)
        if not known.good.all():
            numbers = [some if all(known.good[x] for x in some) else [] for some in numbers]
        sizes = np.array([len(some) for some in numbers])
        flat = np.array([x for some in numbers for x in some], np.int64)
        doc = np.repeat(np.arange(len(ids)), sizes)
        used, place = np.unique(flat, return_inverse=True)
        known.hits[used] += 1
        counts = np.stack([np.bincount(doc, known.counts[flat, c], len(ids)).astype(np.int64) for c in range(4)])
        texts_ = [";".join([known.text[x] for x in some]) for some in numbers]
        # (document, part) once with its times, then (document, pair).
        key, n = np.unique(doc * max(1, len(used)) + place, return_counts=True)
        key_doc, key_part = key // max(1, len(used)), key % max(1, len(used))
        part = used[key_part]
        wide = known.first[part + 1] - known.first[part]
        at = np.arange(wide.sum()) + np.repeat(known.first[part] - (np.cumsum(wide) - wide), wide)
        distinct, pair_at = np.unique(known.pairs[at], return_inverse=True)
        both = np.repeat(key_doc, wide) * max(1, len(distinct)) + pair_at
        found, where = np.unique(both, return_inverse=True)
        many = np.bincount(where, known.times[at] * np.repeat(n, wide), len(found)).astype(np.int64)
        found_doc, found_pair = found // max(1, len(distinct)), found % max(1, len(distinct))
        ends = np.searchsorted(found_doc, np.arange(len(ids) + 1))
        split = lambda x: [x[i:j].astype(np.int32) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        rows = len(ids)
        columns = [
            [number] * (rows + 1), [*ids, None], *([*c, 0] for c in counts.tolist()),
            [*(hashlib.sha256(t.encode()).hexdigest() if s else "" for t, s in zip(texts_, numbers, strict=True)), None],
            [*(texts_ if keep_groups else [None] * rows), None], [*split(found_pair), None], [*split(many), None],
            [None] * rows + [distinct], [None] * rows + [np.bincount(found_pair, minlength=len(distinct)).astype(np.int32)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, made = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _slices(texts, block_chars):
                yield block(known, made, ids[i:j], texts[i:j])
                made += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with sums over the corpus-wide counts of its pairs."""
    size = int(max(counts.column("place").to_numpy(), default=-1)) + 1
    count, best = np.zeros(size, np.int64), np.zeros(size, bool)
    place = counts.column("place").to_numpy()
    count[place], best[place] = counts.column("count").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    places, times = docs.column("places").combine_chunks(), docs.column("times").combine_chunks()
    sizes = np.diff(places.offsets.to_numpy())
    at, many = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(docs)), sizes)
    total, top = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(total, row, count[at] * many)
    np.add.at(top, row, best[at] * many)
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(docs.column(c) for c in keep), pa.array(top), pa.array(total), docs.column("groups_sha256"), docs.column("groups")], [x.split()[0] for x in SCORED.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """How many documents of the corpus hold each id pair linked: (pair, a, b, count, best). best: no pair of the
    same A id has a higher count. A window of an A id holds at most as many rows as B has ids."""
    counts = blocks.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 32))
    return counts.select(
        "pair", "a", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "count",
        (F.col("count") == F.max("count").over(Window.partitionBy("a"))).alias("best"),
    )


def align(
    docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = True, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups.

    A encodes a blank and the text, B the text, to which it adds one; special tokens' strings are plain text. groups
    has the groups as ``a1,a2|b1;a3|b2,b3`` (null without ``keep_groups``). Links are all pairs of occurrences within
    a group; a pair's count is the number of rows that hold it linked. Null and empty texts, and texts that a side
    does not give back byte by byte, have no tokens: zeros and empty strings. Rows with a null id and repeated rows
    stay and count as documents; further columns are dropped; an empty table gives an empty one."""
    blocks = staged(aligned(docs, a_path, b_path, keep_groups, block_chars), "aligned")
    dealt = blocks.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x"))
    dealt = dealt.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = staged(pair_counts(dealt), "pairs")
    back = staged(join_unique(dealt.drop("docs"), counts.select("pair", "count", "best"), ["pair"], spread("block")), "counted")
    discard(counts)
    texts = blocks.where("pairs IS NULL")
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_scored, SCORED)

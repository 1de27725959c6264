"""Packing of tokenised documents into sequences of a fixed size, by exact complements, then best fit.

What is packed is a histogram: how many pieces there are of each length. It has as many entries as a
sequence has tokens, however large the corpus is, so the plan is made on the driver; the pieces themselves
find their places in it on Spark."""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.common import staged
from feederlens.llm.merges import Remembered, Vocabulary, byte_symbols

#: Pieces of one length are numbered in so many groups, since one length may hold a third of them.
RANK_GROUPS = 64
#: The pattern of the words of the vocabulary word_bpe_49k.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SENTENCE_MARK = re.compile("(?<=[a-zß-öø-ÿ])([.,])(?=[ \n])")
#: Encoded words that a task remembers, at most.
CACHE_WORDS = 600_000


class WordEncoder:
    """Ids of texts, as little-endian 32-bit numbers, by a tokenizer whose pre-tokens never hold a blank.

    Then a text's ids are those of its parts between blanks, which repeat, so they are remembered. The library
    normalises and splits the parts; their words are merged many at a time."""

    def __init__(self, path: str, size: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary, self.parts = Vocabulary(path), Remembered(size)
        symbols = byte_symbols()
        self.raw = {ord(c): b for c, b in symbols.items()}
        self.find = regex.compile(PATTERN).findall

    def _words(self, part: str) -> list[bytes]:
        """Normalised words of a part. Plain Latin text is the same under all versions of Unicode and has no
        letters to compose; other parts are left to the library."""
        if part.isalpha() and max(part) < "\u0100":
            return [part.lower().encode()]
        if max(part) < "\u0130":
            return [w.encode() for w in self.find(part.lower())]
        line = self.tokenizer.normalizer.normalize_str(part)
        return [w.translate(self.raw).encode("latin-1") for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(line)]

    def _learn(self, parts: list[str]) -> None:
        cut, special = [], tuple(self.vocabulary.special)
        for part in parts:
            if "<|" in part and any(x in part for x in special):
                cut.append(np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                cut.append(self._words(part) if part else [])
        words = list({w for some in cut if isinstance(some, list) for w in some})
        ids = dict(zip(words, self.vocabulary.merged(words), strict=True))
        self.parts.new.update(
            (p, some if isinstance(some, bytes) else b"".join([ids[w] for w in some])) for p, some in zip(parts, cut, strict=True)
        )

    def _parts(self, text: str) -> list[str]:
        """Parts between blanks. Plain Latin text is first put in lower case, with a stop or comma after a word set
        apart, so that fewer parts differ; both change no ids, and text with special tokens is left alone."""
        if "<|" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                text = SENTENCE_MARK.sub(r" \1", text.lower())
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        parts = [self._parts(text or "") for text in texts]
        missing = self.parts.missing(parts)
        for at in range(0, len(missing), 20_000):
            self._learn(missing[at : at + 20_000])
        known = self.parts.new
        return [b"".join([known[p] for p in some]) for some in parts]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenised_pieces(docs: DataFrame, tokenizer: str, size: int, end: int) -> DataFrame:
    """Pieces of at most size tokens of each document (null text: empty), ended by the id end."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, last = WordEncoder(tokenizer), np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, out = batch.slice(at, 1000), []
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids += last
                    for i in range(0, len(ids), 4 * size):
                        one = ids[i : i + 4 * size]
                        out.append((doc, i // (4 * size), i // 4, len(one) // 4, zlib.crc32(one)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                    )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def _complement(gap: int, free: np.ndarray, lengths: list[int]) -> list[int] | None:
    """One, two or three available lengths that add up to the gap, large ones first; None if there are none.

    free: how many pieces there are of each length, less those of the sequence being filled."""
    if free[gap] > 0:
        return [gap]
    have = free[: gap + 1] > 0
    # Pair sums: a length and its complement to the gap, found by index.
    half = np.flatnonzero(have & have[::-1])
    half = half[(2 * half > gap) | ((2 * half == gap) & (free[half] > 1))] if len(half) else half
    if len(half):
        return [int(half[-1]), gap - int(half[-1])]
    top = bisect.bisect_right(lengths, gap)
    for a in reversed(lengths[:top]):
        if 3 * a < gap:
            break
        if free[a] <= 0:
            continue
        rest = gap - a
        if rest <= 0:
            continue
        left = free[: rest + 1].copy()
        if a <= rest:
            left[a] -= 1
        ok = left > 0
        pair = np.flatnonzero(ok & ok[::-1])
        pair = pair[(2 * pair > rest) | ((2 * pair == rest) & (left[pair] > 1))] if len(pair) else pair
        if len(pair):
            return [a, int(pair[-1]), rest - int(pair[-1])]
    return None


def plan(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence, how often). Each use of a pattern takes as many as the counts allow,
    which uses up a length, so there are no more patterns than lengths.

    The largest length left opens a sequence. Its gap is filled exactly by one, two or three lengths whose sum
    the index finds; where there is no such combination, the largest length that fits goes in (best fit) and the
    new gap is tried again."""
    free = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        free[length] = n
    lengths = sorted(counts)
    out = []
    while lengths:
        while lengths and free[lengths[-1]] == 0:
            lengths.pop()
        if not lengths:
            break
        pattern, gap = [lengths[-1]], size - lengths[-1]
        free[lengths[-1]] -= 1
        while gap:
            if found := _complement(gap, free, lengths):
                pattern += found
                for x in found:
                    free[x] -= 1
                break
            fits = np.flatnonzero(free[: gap + 1])
            if not len(fits):
                break
            pattern.append(int(fits[-1]))
            free[fits[-1]] -= 1
            gap -= int(fits[-1])
        need = {x: pattern.count(x) for x in pattern}
        more = min(int(free[x]) // n for x, n in need.items())
        for x, n in need.items():
            free[x] -= n * more
        out.append((pattern, 1 + more))
        lengths = [x for x in lengths if free[x]]
    return out


def slots(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks of its slots, the sequence of that rank, and the place in the sequence."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        at = 0
        for length in pattern:
            found.setdefault(length, []).append((used.get(length, 0), sequence, at))
            used[length] = used.get(length, 0) + times
            at += length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in found.items()}


PACKED = PIECES + ", sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1) -> DataFrame:
    """Places of all pieces of docs (doc_id, text): sequence_id, and a gapless offset in the sequence.

    A null text is empty (one piece of one token, the end). Repeated rows are packed as often as they come.
    An empty table gives an empty one. tokenizer: path of a file that all executors have."""
    spark = docs.sparkSession
    pieces = staged(tokenised_pieces(docs, tokenizer, size, end), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.sparkContext.broadcast(slots(plan(counts, size)))

    # A piece's rank among those of its length: the rank in its group and the sizes of earlier groups.
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_GROUPS)).cast("int")
    grouped = pieces.withColumn("_group", group)
    sizes = grouped.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("n"))
    earlier = sizes.select(
        F.col("length").alias("_length"), F.col("_group").alias("_g"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("_group")) - F.col("n")).alias("_before"),
    )  # at most size * RANK_GROUPS rows
    ranked = grouped.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1
    ).join(F.broadcast(earlier), (F.col("length") == F.col("_length")) & (F.col("_group") == F.col("_g")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            lengths, ranks = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                first, begins, where = places.value[int(length)]
                slot = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at] = begins[slot] + ranks[at] - first[slot]
                offset[at] = where[slot]
            frame["sequence_id"], frame["offset"] = sequence, offset
            yield frame.drop(columns="rank").astype({"doc_id": "Int64"})

    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_before")).alias("rank")
    ).mapInPandas(run, PACKED)

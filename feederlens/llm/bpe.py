"""Byte-level BPE with a lexicon of frequent words as a minimal acyclic transducer.

Frequent words of the corpus are encoded once and compiled into an automaton that shares suffixes; the number of
words below each arc gives a word its index, and the index its ids. The automaton is a few flat arrays in a file
that workers map into memory. Words it does not know are merged exactly, by rank."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import discard, staged
from feederlens.llm.merges import Remembered, Vocabulary, byte_symbols

#: The pattern that splits a text before the merges of a byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII, where blanks are six characters, and the parts that are one word by it.
ASCII_PATTERN = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)
ONE_WORD = re.compile(r" ?(?:[A-Za-z]+|[0-9]+)")
#: Below this code point all versions of Unicode agree on what is a letter; other texts are split by the library.
SETTLED = "\u0530"
LEXICON_WORDS = 150_000
#: Words of more characters are merged where they occur; the lexicon has none.
WORD_CHARS = 64
#: Different parts of texts that a task counts before it hands their words on.
COUNTED_PARTS = 200_000
#: Parts of texts whose ids a task remembers, at most.
CACHE_PARTS = 300_000


class Transducer:
    """Words and their ids as flat arrays: arcs (state, byte) -> (target, words passed over), and ids by index."""

    NAMES = ("keys", "targets", "skipped", "final", "bounds", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.keys, self.targets, self.skipped, self.final, self.bounds, self.ids = (arrays[n] for n in self.NAMES)

    @classmethod
    def build(cls, entries: dict[bytes, bytes]) -> Transducer:
        """Minimal automaton of the words (ids as little-endian 32-bit numbers), which are added in order; finished
        states with equal arcs are one."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        counts: list[int] = []

        def finished(node: list) -> int:
            shape = (node[0], tuple(node[1]))
            if (found := register.get(shape)) is None:
                found = register[shape] = len(states)
                states.append(shape)
                counts.append(node[0] + sum(counts[t] for _, t in node[1]))
            return found

        path, last, order = [[False, []]], b"", sorted(entries)
        for word in order:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            while len(path) > same + 1:
                child = finished(path.pop())
                path[-1][1].append((last[len(path) - 1], child))
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        while len(path) > 1:
            child = finished(path.pop())
            path[-1][1].append((last[len(path) - 1], child))
        root = finished(path[0])
        number = lambda s: root - s  # noqa: E731  the root is the last state made, and becomes 0
        rows = []
        for s, (final, arcs) in enumerate(states):
            passed = int(final)
            for byte, target in arcs:
                rows.append((number(s) * 256 + byte, number(target), passed))
                passed += counts[target]
        rows.sort()
        flat = np.array(rows, np.int64).reshape(-1, 3)
        lists = [entries[w] for w in order]
        return cls({
            "keys": flat[:, 0].copy(), "targets": flat[:, 1].astype(np.int32), "skipped": flat[:, 2].astype(np.int32),
            "final": np.array([states[root - s][0] for s in range(root + 1)], np.uint8),
            "bounds": np.cumsum([0, *(len(x) // 4 for x in lists)]).astype(np.int64),
            "ids": np.frombuffer(b"".join(lists), "<i4"),
        })

    def to_bytes(self) -> bytes:
        head = json.dumps([(n, self.arrays[n].dtype.str, len(self.arrays[n])) for n in self.NAMES]).encode()
        body = b"".join(self.arrays[n].tobytes() + b"\0" * (-self.arrays[n].nbytes % 8) for n in self.NAMES)
        head += b" " * (-len(head) % 8)
        return len(head).to_bytes(8, "little") + head + body

    @classmethod
    def mapped(cls, data: bytes) -> Transducer:
        """The automaton from a file mapped into memory; the file has no name, so it goes with the worker."""
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        size = int.from_bytes(bytes(whole[:8]), "little")
        at, arrays = 8 + size, {}
        for name, kind, n in json.loads(bytes(whole[8 : 8 + size])):
            nbytes = np.dtype(kind).itemsize * n
            arrays[name] = whole[at : at + nbytes].view(kind)
            at += nbytes + -nbytes % 8
        return cls(arrays)

    def look_up(self, words: list[bytes]) -> list[np.ndarray | None]:
        """Ids of each word, None for unknown ones. All words take a step at once."""
        n = len(words)
        out: list[np.ndarray | None] = [None] * n
        if not n or not len(self.keys):
            return out
        sizes = np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        state, index = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive = np.arange(n)
        for step in range(int(sizes[0])):
            alive = alive[: np.searchsorted(-sizes[alive], -step, "left")]
            if not len(alive):
                break
            key = state[alive] * 256 + text[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            good = self.keys[at] == key
            state[alive[~good]] = -1
            alive, at = alive[good], at[good]
            state[alive] = self.targets[at]
            index[alive] += self.skipped[at]
        hit = np.flatnonzero((state >= 0) & (self.final[np.maximum(state, 0)] == 1) & (sizes > 0))
        lo, hi = self.bounds[index[hit]].tolist(), self.bounds[index[hit] + 1].tolist()
        ids = self.ids
        for where, a, b in zip(order[hit].tolist(), lo, hi, strict=True):
            out[where] = ids[a:b]
        return out


class Splitter:
    """Pre-tokens of a text, as the library makes them."""

    def __init__(self, tokenizer: str):
        import regex

        self.find, self.path, self.library = regex.compile(PATTERN).findall, tokenizer, None
        self.odd_blank = re.compile(r" (?:\s|\Z)").search
        self.symbols = byte_symbols()
        self.find_ascii, self.one_word = ASCII_PATTERN.findall, ONE_WORD.fullmatch

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_ascii(text)
        if max(text) < SETTLED:
            return self.find(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        raw = [bytes(self.symbols[c] for c in t).decode() for t, _ in self.library.pre_tokenize_str(text)]
        return raw

    def parts(self, text: str) -> list[str]:
        """Parts that can be split on their own: a single blank before a word begins a pre-token."""
        if self.odd_blank(text):
            return [text]
        if "\0" in text:
            first, *others = text.split(" ")
            return [first, *[" " + x for x in others]]
        return text.replace(" ", "\0 ").split("\0")


IDS, LISTED, RAW = itemgetter(0), itemgetter(1), itemgetter(2)


class Encoder:
    """Ids of texts by the lexicon, and by merges where it ends; and texts of ids.

    Of each part it remembers the ids, the same in decimals, and the bytes that they decode to."""

    def __init__(self, vocabulary: Vocabulary, splitter: Splitter, lexicon: Transducer):
        self.vocabulary, self.splitter, self.lexicon = vocabulary, splitter, lexicon
        self.parts = Remembered(CACHE_PARTS)
        self.decimal = [str(i) for i in range(len(vocabulary.token))]
        self.token_bytes = np.array([len(t) for t in vocabulary.token], np.int64)
        self.token_chars = np.array([len(d) + 1 for d in self.decimal], np.int64)

    def _entries(self, found: list[bytes]) -> list[tuple[bytes, str, bytes]]:
        """The ids of parts (not none of them) with their decimals and bytes, cut out of those of all parts."""
        ids = np.frombuffer(b"".join(found), "<i4")
        numbers = ids.tolist()
        raw = b"".join(map(self.vocabulary.token.__getitem__, numbers))
        listed = ",".join(map(self.decimal.__getitem__, numbers))
        last = np.cumsum([len(x) // 4 for x in found])
        to_byte = np.cumsum(self.token_bytes[ids])[last - 1].tolist()
        to_char = np.cumsum(self.token_chars[ids])[last - 1].tolist()
        return [
            (x, listed[c : d - 1], raw[a:b])
            for x, a, b, c, d in zip(found, [0, *to_byte[:-1]], to_byte, [0, *to_char[:-1]], to_char, strict=True)
        ]

    def _segments(self, text: str) -> list[str | int]:
        """A text between its special tokens, and their ids."""
        out: list[str | int] = [text]
        for special, number in self.vocabulary.special.items():
            made: list[str | int] = []
            for one in out:
                if isinstance(one, str) and special in one:
                    for i, piece in enumerate(one.split(special)):
                        made += ([number] if i else []) + ([piece] if piece else [])
                else:
                    made.append(one)
            out = made
        return out

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts not seen lately: look their words up, merge those that the lexicon lacks."""
        split, one_word = self.splitter.split, self.splitter.one_word
        cut = [[p] if one_word(p) else split(p) for p in parts]
        words = list({w for some in cut for w in some})
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        found: list[bytes | None] = [None if x is None else x.tobytes() for x in self.lexicon.look_up(raw)]
        unseen = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(unseen, self.vocabulary.merged([raw[i] for i in unseen]), strict=True):
            found[i] = x
        ids = dict(zip(words, found, strict=True))
        whole = [ids[some[0]] if len(some) == 1 else b"".join([ids[w] for w in some]) for some in cut]
        self.parts.new.update(zip(parts, self._entries(whole), strict=True))

    def entries(self, texts: list[str | None]) -> list[list[tuple[bytes, str, bytes]]]:
        """For each text the ids, decimals and bytes of its parts in order; none for a null or empty text."""
        split, made = self.splitter, []
        for text in texts:
            one: list[str | int] = []
            for segment in self._segments(text) if text else []:
                if isinstance(segment, int):
                    one.append(segment)
                else:
                    one += split.parts(segment)
            made.append(one)
        missing = self.parts.missing([set().union(*made)])
        known = self.parts.new
        known.update((x, self._entries([x.to_bytes(4, "little")])[0]) for x in missing if isinstance(x, int))
        missing = [p for p in missing if p != "" and not isinstance(p, int)]
        for at in range(0, len(missing), 20_000):
            self._learn(missing[at : at + 20_000])
        # The empty part before a first blank has no ids.
        return [[known[p] for p in one if p != ""] for one in made]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers; none for a null or empty text."""
        return [b"".join(map(IDS, one)) for one in self.entries(texts)]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        token = self.vocabulary.token
        return b"".join([token[i] for i in ids]).decode("utf-8", "replace")


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """How often each pre-token occurs in the whole corpus (word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, parts = Splitter(tokenizer), Counter()

        def counted() -> pa.RecordBatch:
            counts: Counter = Counter()
            one_word, split = splitter.one_word, splitter.split
            for part, n in parts.items():
                if one_word(part):
                    counts[part] += n
                elif part:
                    for word in split(part):
                        counts[word] += n
            parts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                parts.update(splitter.parts(text) if text else ())
                if len(parts) > COUNTED_PARTS:
                    yield counted()
        yield counted()

    made = docs.select("text").mapInArrow(run, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words of counts (word, n), at most ``size``. Words are taken by classes of like frequency, 16
    for each doubling, so that neither one task nor the driver merges the top of every partition."""
    kind = F.floor(F.log2("n") * 16)
    least, total = None, 0
    for row in counts.groupBy(kind.alias("kind")).count().orderBy(F.desc("kind")).collect():  # at most 1,024 classes
        total += row["count"]
        if total > size:
            break
        least = row["kind"]
    if least is None:
        return []
    return counts.where(kind >= least).select("word").toArrow().column(0).to_pylist()


def lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> Transducer:
    """Transducer of the most frequent words of the corpus, at most ``size`` of them (``frequent_words``); the others
    are merged where they occur, and so are words that occur once."""
    counts = word_counts(docs, tokenizer).where((F.col("n") > 1) & (F.length("word") <= WORD_CHARS))
    counts = staged(counts, "words")
    raw = [word.encode("utf-8", "surrogatepass") for word in frequent_words(counts, size)]
    discard(counts)
    return Transducer.build(dict(zip(raw, Vocabulary(tokenizer).merged(raw), strict=True)))


ENCODED = "doc_id long, ids array<int>, decoded string"


@lru_cache(1)
def _vocabulary(tokenizer: str) -> Vocabulary:
    return Vocabulary(tokenizer)


#: The encoder of this worker and the run that it belongs to; tasks that a worker gets one after another share it.
_ENCODER: dict[str, Encoder] = {}


def _encoder(run: str, tokenizer: str, data: Broadcast) -> Encoder:
    if run not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[run] = Encoder(_vocabulary(tokenizer), Splitter(tokenizer), Transducer.mapped(data.value))
    return _ENCODER[run]


def encode_decode(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """Ids of each text of docs (doc_id, text), and the text that they decode to. Null texts are empty; repeated rows
    come back repeated; an empty table gives an empty one."""

    def made(parts: list[tuple[bytes, str, bytes]]) -> tuple[list[int], str]:
        return np.frombuffer(b"".join(map(IDS, parts)), "<i4").tolist(), _decoded(parts)

    return _run(docs, tokenizer, size, ENCODED, made, [pa.list_(pa.int32()), pa.string()])


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digest(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """As encode_decode, with digests in the place of ids and texts."""

    def made(parts: list[tuple[bytes, str, bytes]]) -> tuple[int, str, str]:
        listed = ",".join(map(LISTED, parts))
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return listed.count(",") + 1 if parts else 0, sha(listed), sha(_decoded(parts))

    return _run(docs, tokenizer, size, DIGEST, made, [pa.int64(), pa.string(), pa.string()])


def _decoded(parts: list[tuple[bytes, str, bytes]]) -> str:
    return b"".join(map(RAW, parts)).decode("utf-8", "replace")


def _run(docs, tokenizer, size, schema, made, types) -> DataFrame:
    data = docs.sparkSession.sparkContext.broadcast(lexicon(docs, tokenizer, size).to_bytes())
    names, name = [x.split()[0] for x in schema.split(", ")], uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, tokenizer, data)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = [made(parts) for parts in encoder.entries(part.column(1).to_pylist())]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)

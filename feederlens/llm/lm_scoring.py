"""Log probabilities of texts by online logistic mixing of hashed-context bit predictors.

A text is a series of tokens: its words in lower case, and an end. A token of the bounded vocabulary is coded by the
bits of its Huffman path, another one by an escape and its bytes, by the bits of theirs. Each bit is predicted under
several contexts, whose counts lie in hashed tables; a logistic mixer adds the predictions up with weights that are
gated by how much each context has seen, and the sum is refined by what the text has shown so far.

Each task learns online from its part of the corpus: it predicts with the counts so far, moves the weights, counts.
Tables of all tasks are added and their weights averaged. Tables, vocabulary and weights have fixed sizes; the counts
of all tokens, which grow with the corpus, stay in a table and are joined."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import staged, words
from feederlens.llm.merges import Remembered
from feederlens.llm.toxicity import held_out

#: The most frequent tokens (of all texts), at most, which tasks get with their counts; rarer ones are joined.
KNOWN = 1 << 18
#: Tokens with a code of their own, the most frequent ones among the training texts.
VOCABULARY = 1 << 17
TABLE_BITS = 20
#: Bits that are predicted together while learning.
STEP_BITS = 20_000
#: Words of texts that are scored together.
STEP_WORDS = 60_000
SEEN_KINDS = 14
LEARNING_RATE = 0.02
#: Precision of the refinement's prior, and the depth of the nodes that have one.
PRIOR, REFINED_DEPTH = 12.0, 3
WORD_CONTEXTS, BYTE_CONTEXTS = 3, 3
#: Slots of a row in which counts travel.
BLOCK = 1 << 14


def token_hash(token: bytes) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(token)
    return value - (1 << 64) if value >= 1 << 63 else value


#: Stands for the end of a text; no word holds a blank.
END_TOKEN = b" end"


class Code:
    """Huffman code as flat arrays: for each symbol the nodes on its path and the bits taken there."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        parent, bit = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
        heap = [(float(c), i) for i, c in enumerate(counts.tolist())]
        heapq.heapify(heap)
        made = n
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[i] = parent[j] = made
            bit[j] = 1
            heapq.heappush(heap, (a + b, made))
            made += 1
        root = made - 1
        at, path, bits = np.arange(n), [], []
        while n > 1 and (at != root).any():
            up = np.where(at != root, parent[at], -1)
            bits.append(np.where(at != root, bit[at], 0))
            path.append(up)
            at = np.where(at != root, parent[at], root)
        depth = len(path)
        whole = np.stack(path[::-1], 1) if depth else np.zeros((n, 0), np.int64)
        taken = np.stack(bits[::-1], 1) if depth else np.zeros((n, 0), np.int8)
        there = whole >= 0
        self.length = there.sum(1).astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        # The root is node 0, and nodes near it have small numbers.
        self.nodes = (root - whole[there]).astype(np.int32)
        self.bits = taken[there].astype(np.int8)

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each bit: the place of its symbol, its node, its value, its depth."""
        n = self.length[symbols]
        place = np.repeat(np.arange(len(symbols)), n)
        depth = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        at = self.start[symbols][place] + depth
        return place, self.nodes[at], self.bits[at], depth


class Model:
    """Vocabulary, codes, and, once learnt, tables and weights."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, byte_counts: np.ndarray):
        # hashes ascending; counts are those in training texts.
        self.hashes, self.counts, self.total, self.distinct = hashes, counts, total, distinct
        chosen = np.argsort(-counts, kind="stable")[:VOCABULARY]
        chosen = chosen[counts[chosen] > 0]
        self.symbol = np.full(len(hashes) + 1, 0, np.int32)  # 0 escapes
        self.symbol[chosen] = np.arange(1, len(chosen) + 1)
        escaped = max(1, total - int(counts[chosen].sum()))
        self.words = Code(np.concatenate([[escaped], counts[chosen]]).astype(np.float64))
        self.bytes = Code(byte_counts + 0.5)
        tables = WORD_CONTEXTS + BYTE_CONTEXTS
        self.stretch = np.zeros((tables, 1 << TABLE_BITS), np.float32)
        self.seen = np.zeros((tables, 1 << TABLE_BITS), np.uint8)
        self.weights = np.full((tables, SEEN_KINDS), 0.4)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of tokens, given by hash, among the known ones (the number of these: none)."""
        none = len(self.hashes)
        at = np.searchsorted(self.hashes, hashes)
        found = np.append(self.hashes, 0)[at] == hashes
        return np.where((at < none) & found, at, none)

    def set_counts(self, zeros: np.ndarray, ones: np.ndarray) -> None:
        for table, (z, o) in enumerate(zip(zeros, ones, strict=True)):
            self.stretch[table] = np.log((o + 0.3) / (z + 0.3))
            self.seen[table] = seen_kind(z + o)


def seen_kind(n: np.ndarray) -> np.ndarray:
    return np.minimum(SEEN_KINDS - 1, np.frexp(n.astype(np.float32))[1]).astype(np.uint8)


#: Logarithms of small counts, and kinds of all counts below the last kind's.
_LOGS = np.log(np.arange(1 << 15) + 0.3).astype(np.float32)
_KINDS = seen_kind(np.arange(1 << SEEN_KINDS))

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _slots(node: np.ndarray, context: np.ndarray) -> np.ndarray:
    mixed = (node.astype(np.uint64) + np.uint64(1)) * _A ^ context * _B
    return ((mixed * _A) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Bits:
    """The bits of some texts: value, slots in the tables, the first table, the text and the node's depth."""

    def __init__(self, model: Model, rows: list[list[bytes]], places: list[list[int]]):
        self.parts = []
        sizes = np.array([len(r) + 1 for r in rows])
        at = np.array([p for row in places for p in (*row, -1)], np.int64)
        ends = np.cumsum(sizes) - 1
        at[ends] = model.end_place
        symbols = model.symbol[at]
        text = np.repeat(np.arange(len(rows)), sizes)
        place, node, bit, depth = model.words.expand(symbols)
        first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
        before = np.concatenate([[0], symbols[:-1] + 1]).astype(np.uint64)
        before[first] = 0
        # The last frequent token tells the language of the text and what part of a phrase this is.
        frequent = np.where((symbols > 0) & (symbols <= 200), np.arange(len(symbols)), -1)
        frequent[first & (frequent < 0)] = -1
        start = np.repeat(ends + 1 - sizes, sizes)
        last = np.concatenate([[-1], np.maximum.accumulate(frequent)[:-1]]) if len(frequent) else frequent
        topic = np.where(last >= start, symbols[np.maximum(last, 0)] + 1, 0).astype(np.uint64)
        slots = [
            node.astype(np.int64) & ((1 << TABLE_BITS) - 1),
            _slots(node, before[place]), _slots(node, (topic[place] << np.uint64(32)) + np.uint64(7)),
        ]
        self.parts.append((bit, slots, 0, text[place], node, depth))
        escaped = np.flatnonzero(symbols == 0)
        if len(escaped):
            flat = [w for r in rows for w in (*r, END_TOKEN)]
            spelled = [flat[i] for i in escaped.tolist()]
            n = np.array([len(w) + 1 for w in spelled])
            codes = np.frombuffer(b"\xff".join(spelled) + b"\xff", np.uint8).astype(np.int64)
            last_of = np.cumsum(n) - 1
            codes[last_of] = 256
            inside = np.arange(len(codes)) - np.repeat(last_of + 1 - n, n)
            back = []
            for k in (1, 2, 3):
                moved = np.concatenate([np.zeros(k, np.int64), codes[:-k] + 1])[: len(codes)]
                back.append(np.where(inside >= k, moved, 0).astype(np.uint64))
            place, node, bit, depth = model.bytes.expand(codes)
            c1 = back[0] + np.uint64(1)
            c2 = c1 * np.uint64(263) + back[1]
            c3 = c2 * np.uint64(269) + back[2]
            slots = [_slots(node, c[place] + np.uint64(k << 40)) for k, c in enumerate((c1, c2, c3))]
            owner = np.repeat(text[escaped], n)
            self.parts.append((bit, slots, WORD_CONTEXTS, owner[place], node, depth))


def _mixed(weights: np.ndarray, stretch: list[np.ndarray], kinds: list[np.ndarray], table: int) -> np.ndarray:
    total = np.zeros(len(stretch[0]))
    for j, (s, k) in enumerate(zip(stretch, kinds, strict=True)):
        total += weights[table + j][k] * s
    return total


class Learner:
    """Counts and weights of one task."""

    def __init__(self, model: Model):
        self.model, self.weights, self.steps = model, model.weights.copy(), 0
        tables = WORD_CONTEXTS + BYTE_CONTEXTS
        self.counts = np.zeros((tables, 1 << TABLE_BITS, 2), np.int32)

    def learn(self, bits: Bits) -> None:
        for bit, slots, table, *_ in bits.parts:
            for at in range(0, len(bit), STEP_BITS):
                self._step(bit[at : at + STEP_BITS], [s[at : at + STEP_BITS] for s in slots], table)

    def _step(self, bit: np.ndarray, slots: list[np.ndarray], table: int) -> None:
        stretch, kinds = [], []
        for j, at in enumerate(slots):
            seen = np.take(self.counts[table + j], at, axis=0)
            small = np.minimum(seen, len(_LOGS) - 1)
            logs = _LOGS[small]
            if (large := np.flatnonzero(small[:, 0] + small[:, 1] >= len(_LOGS) - 1)).size:
                logs[large] = np.log(seen[large] + np.float32(0.3))
            stretch.append(logs[:, 1] - logs[:, 0])
            kinds.append(_KINDS[np.minimum(seen[:, 0] + seen[:, 1], len(_KINDS) - 1)])
        off = bit - 1 / (1 + np.exp(-np.clip(_mixed(self.weights, stretch, kinds, table), -30, 30)))
        for j, (s, k) in enumerate(zip(stretch, kinds, strict=True)):
            slope = np.bincount(k, off * s, SEEN_KINDS) / (np.bincount(k, s * s, SEEN_KINDS) + 100)
            self.weights[table + j] += LEARNING_RATE * 10 * slope / (1 + self.steps / 200) ** 0.5
        self.steps += 1
        for j, at in enumerate(slots):
            np.add.at(self.counts[table + j].reshape(-1), 2 * at + bit, np.int32(1))


def log_probabilities(model: Model, bits: Bits, texts: int) -> np.ndarray:
    """log10 of the probability of each text."""
    out = np.zeros(texts)
    for bit, slots, table, text, node, depth in bits.parts:
        stretch = [model.stretch[table + j][at] for j, at in enumerate(slots)]
        kinds = [model.seen[table + j][at] for j, at in enumerate(slots)]
        total = np.clip(_mixed(model.weights, stretch, kinds, table), -20, 20)
        # Refinement: the bias that the text's earlier bits at a node ask for, under a prior around none.
        some = np.flatnonzero(depth < REFINED_DEPTH)
        if len(some):
            key = text[some].astype(np.int64) << 32 | node[some]
            order = np.argsort(key, kind="stable")
            p = 1 / (1 + np.exp(-total[some][order]))
            off, spread_ = bit[some][order] - p, p * (1 - p)
            key = key[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            begin = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            sums, sizes = np.cumsum(off) - off, np.cumsum(spread_) - spread_
            total[some[order]] += (sums - sums[begin]) / (PRIOR + sizes - sizes[begin])
        sign = np.where(bit == 1, total, -total)
        out -= np.bincount(text, np.logaddexp(0, -sign), texts) / math.log(10)
    return out


# Spark jobs -----------------------------------------------------------------------------------------------------

COUNTED = "token long, n long, n_train long"


def token_counts(docs: DataFrame) -> DataFrame:
    """How often each token (by hash) occurs in all texts, and in those to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, apart in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                found.append(END_TOKEN)
                counts[apart].update(found)
            names = list(counts[0].keys() | counts[1].keys())
            train = [counts[0][x] for x in names]
            yield pa.RecordBatch.from_arrays([
                pa.array([token_hash(x) for x in names], pa.int64()),
                pa.array([n + counts[1][x] for x, n in zip(names, train, strict=True)], pa.int64()), pa.array(train, pa.int64()),
            ], ["token", "n", "n_train"])

    made = docs.select("text", held_out(of=10, rest=0).alias("apart")).mapInArrow(run, COUNTED)
    return made.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def byte_counts(docs: DataFrame) -> np.ndarray:
    """Bytes of all texts to learn from, and ends of words; 257 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass").lower()
                counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                blank = int(counts[list(b" \t\n\x0b\x0c\r")].sum())
                counts[list(b" \t\n\x0b\x0c\r")] = 0
                total[:256] += counts
                total[256] += blank
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(total)], ["byte", "n"])

    rows = docs.where(~held_out(of=10, rest=0)).select("text").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n"))
    out = np.zeros(257)
    for r in rows.collect():
        out[r["byte"]] = r["n"]
    return out


class _Reader:
    """Words of texts and their places among the known tokens."""

    def __init__(self, model: Model, size: int = 200_000):
        self.model, self.memory = model, Remembered(size)

    def read(self, texts: list[str | None]) -> tuple[list[list[bytes]], list[list[int]]]:
        rows = [words(t) for t in texts]
        missing = list(self.memory.missing(rows))
        hashes = np.array([token_hash(x) for x in missing], np.int64)
        self.memory.new.update(zip(missing, zip(self.model.places(hashes).tolist(), hashes.tolist(), strict=True), strict=True))
        known = self.memory.new
        return rows, [[known[w][0] for w in row] for row in rows]


def _pieces(rows: list, sizes: Iterator[int], most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about so many words in all."""
    at, n = 0, 0
    for i, size in enumerate(sizes):
        n += size
        if n >= most:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(rows):
        yield at, len(rows)


LEARNT = "table int, block int, body binary"


def learn(docs: DataFrame, model: Model) -> None:
    """Fills the model's tables and weights from the texts that are not held out."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    tables, blocks = WORD_CONTEXTS + BYTE_CONTEXTS, (1 << TABLE_BITS) // BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        learner, reader = Learner(model), _Reader(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows, places = reader.read(batch.column(0).slice(i, 500).to_pylist())
                for a, b in _pieces(rows, (len(r) for r in rows), STEP_WORDS):
                    learner.learn(Bits(model, rows[a:b], places[a:b]))
        if learner.steps:
            body = np.concatenate([[learner.steps], (learner.weights * learner.steps).ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([body.astype("<f8").tobytes()])], ["table", "block", "body"]
            )
        for t in range(tables):
            found = [(k, learner.counts[t][k * BLOCK : (k + 1) * BLOCK]) for k in range(blocks)]
            found = [(k, x.astype("<i4").tobytes()) for k, x in found if x.any()]
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array([t] * len(found), pa.int32()), pa.array([k for k, _ in found], pa.int32()), pa.array([x for _, x in found]),
                ], ["table", "block", "body"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def done() -> pa.RecordBatch:
            body = total.astype("<f8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([body])], ["table", "block", "body"])

        for batch in batches:
            for table, block, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                value = np.frombuffer(body, "<f8" if table < 0 else "<i4").astype(np.float64)
                if (table, block) != now:
                    if now:
                        yield done()
                    now, total = (table, block), value
                else:
                    total = total + value
        if now:
            yield done()

    parts = docs.where(~held_out(of=10, rest=0)).select("text").coalesce(2 * spark.sparkContext.defaultParallelism)
    sums = parts.mapInArrow(run, LEARNT).repartition("table", "block").sortWithinPartitions("table", "block").mapInArrow(add, LEARNT)
    counts = np.zeros((tables, 1 << TABLE_BITS, 2), np.float32)
    for r in sums.toLocalIterator():  # tables of a fixed size
        body = np.frombuffer(r["body"], "<f8")
        if r["table"] < 0:
            model.weights = (body[1:] / body[0]).reshape(tables, SEEN_KINDS)
        else:
            counts[r["table"]][r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = body.reshape(BLOCK, 2)
    model.set_counts(counts[..., 0], counts[..., 1])


def known_tokens(counts: DataFrame, most: int = KNOWN) -> DataFrame:
    """The most frequent tokens, at most so many, and the end. Tokens are taken by classes of like frequency, 16 for
    each doubling, so no task and not the driver has to merge the top of every partition."""
    kind = F.floor(F.log2("n") * 16)
    least, total = None, 0
    for row in counts.groupBy(kind.alias("kind")).count().orderBy(F.desc("kind")).collect():  # at most 1,024 classes
        total += row["count"]
        if total > most:
            break
        least = row["kind"]
    chosen = F.col("token") == token_hash(END_TOKEN)
    return counts.where(chosen if least is None else chosen | (kind >= least)).select("token", "n_train")


def fit(docs: DataFrame, counts: DataFrame) -> Model:
    """A model from token counts and the texts that are not held out."""
    sums = counts.agg(F.sum("n_train").alias("total"), F.count(F.when(F.col("n_train") > 0, 1)).alias("distinct")).first()
    top = known_tokens(counts).toArrow()
    hashes, n_train = (top.column(x).to_numpy().astype(np.int64) for x in ("token", "n_train"))
    order = np.argsort(hashes)
    model = Model(hashes[order], n_train[order], int(sums["total"] or 0), int(sums["distinct"]), byte_counts(docs))
    model.end_place = int(model.places(np.array([token_hash(END_TOKEN)]))[0])
    learn(docs, model)
    return model


ROWS = ("doc_id long, n_tokens long, n_bytes long, known long, base double, score double, rare array<long>, times array<long>")


def lm_scores(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text; null text: empty): held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte (of the words and an end each).

    Rows with a null doc_id are not held out. An empty text is its end. Repeated rows come back repeated; an empty
    table gives an empty one. Without any text to learn from all counts are zero."""
    counts = staged(token_counts(docs), "tokens")
    model = fit(docs, counts)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    bottom = model.total + 0.1 * (model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader, none = _Reader(model), len(model.hashes)
        logs = np.log10((np.concatenate([model.counts, [0]]) + 0.1) / bottom)
        names = [x.split()[0] for x in ROWS.split(", ")]
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows, places = reader.read(part.column(1).to_pylist())
                score = np.concatenate([
                    log_probabilities(model, Bits(model, rows[a:b], places[a:b]), b - a)
                    for a, b in _pieces(rows, (len(r) for r in rows), STEP_WORDS)
                ])
                out = []
                for row, at in zip(rows, places, strict=True):
                    found = np.array([*at, model.end_place], np.int64)
                    near = found[found < none]
                    rare = Counter([reader.memory.new[w][1] for w, k in zip(row, at, strict=True) if k == none])
                    out.append((
                        len(found), sum(map(len, row)) + len(found), int((model.counts[near] > 0).sum()),
                        float(logs[near].sum()), list(rare), list(rare.values()),
                    ))
                a = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *(pa.array(x, pa.int64()) for x in a[:3]), pa.array(a[3], pa.float64()), pa.array(score),
                    pa.array(a[4], pa.list_(pa.int64())), pa.array(a[5], pa.list_(pa.int64())),
                ], names)

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ROWS)
    rows = staged(made.withColumn("row", F.monotonically_increasing_id()), "scores")
    # Tokens that are not among the known ones are rare by their definition: no key of this join is hot.
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "row", F.col("t.rare").alias("token"), F.col("t.times").alias("times")
    )
    count = F.coalesce("n_train", F.lit(0))
    sums = rare.join(counts.select("token", "n_train"), "token", "left").groupBy("row").agg(
        F.sum(F.log10((count + 0.1) / F.lit(bottom)) * F.col("times")).alias("more"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("seen"),
    )
    zero = F.lit(0)
    return rows.join(sums, "row", "left").select(
        "doc_id", held_out(of=10, rest=0).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("seen", zero)).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )

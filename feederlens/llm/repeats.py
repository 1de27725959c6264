"""Repeated strings of a corpus by suffix arrays over the places where a repeat is possible.

Every string of ``length`` bytes (a window) belongs to a class: the smallest hash of its ``gram``-byte substrings.
Equal windows have equal classes, so a suffix array per class finds all repeats, and a class that occurs once
has none. Neighbouring windows of one class are a run, which travels as one text. Equal runs travel once, with
their number. Classes of many different runs (a passage with ever new surroundings) are cut finer, by blocks of
windows and the bytes that all windows of a block share, and at last by single windows, which are only counted."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.common import join_unique, join_wide, passing, spread, staged
from feederlens.llm.suffix_sort import repeated_starts

LENGTH = 400
GRAM = 100
#: Words of a passage that may not recur.
PASSAGE = 51
#: Characters of the code that stands for a word, of seven bits each.
CODE = 6
#: A run has at most so many windows.
RUN = 2048
#: Different runs of a key that one suffix array takes; keys with more are cut finer.
PER_KEY = 64
#: Windows of a block, into which the runs of large classes are cut.
BLOCK = 32
#: Bytes of the texts of one suffix array; a task works on one array after another.
ARRAY_BYTES = 400_000

_BASE = 0x9E3779B97F4A7C15


class Grams:
    """Hashes of all substrings of a length, and the smallest hash of each window."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.size = length, gram, 0
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        if size <= self.size:
            return
        powers = np.full(size + 1, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(size + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.powers, self.inverse, self.size = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64), size

    def hashes(self, text: bytes) -> np.ndarray:
        self._grow(len(text))
        n = len(text)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: n - self.gram + 1]) * self.inverse[: n - self.gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(32)

    @staticmethod
    def _slide(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
        """The smallest or largest of each ``width`` neighbours, from running values of blocks."""
        n = len(values)
        rows = np.concatenate([values, np.full(-n % width, fill, values.dtype)]).reshape(-1, width)
        ahead = pick.accumulate(rows, 1).ravel()
        back = pick.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        return pick(back[: n - width + 1], ahead[width - 1 : n])

    def runs(self, text: bytes) -> list[tuple[int, int, int, bool]]:
        """Runs (class, first window, windows, whether the class has several places in this text)."""
        if len(text) < self.length:
            return []
        h = self.hashes(text)
        width = self.length - self.gram + 1
        low = self._slide(h, width, np.minimum, 2**64 - 1)
        around = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
        chosen = h[self._slide(around, width, np.maximum, 0) == h]
        values, times = np.unique(chosen, return_counts=True)
        several = set(values[times > 1].tolist())
        starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1]).tolist()
        out = []
        for a, b in zip(starts, [*starts[1:], len(low)], strict=True):
            value = int(low[a])
            out += [(value, i, min(RUN, b - i), value in several) for i in range(a, b, RUN)]
        return out

    def blocks(self, body: bytes, windows: int, block: int) -> list[tuple[int, int, int]]:
        """Blocks (place of the class in the windows div block, first window, windows) of a run."""
        h = self.hashes(body)
        places = np.flatnonzero(h == h.min())
        at = np.arange(windows)
        place = places[np.searchsorted(places, at)]
        number = (place - at) // block
        cuts = np.flatnonzero((number[1:] != number[:-1]) | (place[1:] != place[:-1])) + 1
        starts = [0, *cuts.tolist()]
        return [(int(number[a]), a, b - a) for a, b in zip(starts, [*starts[1:], windows], strict=True)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _digest(text: bytes, seed: int = 0) -> int:
    import xxhash

    return _signed(xxhash.xxh3_64_intdigest(text, seed))


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _marked(docs: DataFrame) -> DataFrame:
    """Rows with two hashes of their text, which name it from here on: equal texts have equal results."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("m1"), F.xxhash64(F.lit(1), text).alias("m2"),
    )


_INT = pa.int64()
RUNS = "m1 long, m2 long, doc long, class long, run long, start long, windows long, several boolean"
SLICES = "key long, sub long, class long, run long, lo array<long>, windows long, several boolean, rows long, body binary"
SPANS = "key long, sub long, spans array<long>"


def _schema(text: str) -> pa.Schema:
    kinds = {"long": _INT, "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(_INT)}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in text.split(", "))])


def _runs(marked: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, schema = Grams(length, gram), _schema(RUNS)
        for batch in batches:
            rows = []
            for doc, text, m1, m2 in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                body = _raw(text)
                for value, start, windows, several in grams.runs(body):
                    name = _digest(body[start : start + windows + length - 1])
                    rows.append((m1, m2, doc, _signed(value), name, start, windows, several))
                if len(rows) > 50_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return marked.mapInArrow(run, RUNS)


def _slices(marked: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """Texts of the runs asked for, cut from one document each."""
    lists = asked.groupBy("m1", "m2", "doc").agg(
        F.collect_list(F.struct("class", "run", "start", "windows", "several", "rows")).alias("runs")
    ).withColumnsRenamed({"m1": "n1", "m2": "n2"})
    met = marked.join(
        lists.hint("shuffle_hash"),
        (F.col("m1") == F.col("n1")) & (F.col("m2") == F.col("n2")) & F.col("doc_id").eqNullSafe(F.col("doc")),
    ).select("text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(SLICES)
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column(0), batch.column(1), strict=True):
                body = _raw(text.as_py())
                for r in runs.as_py():
                    cut = body[r["start"] : r["start"] + r["windows"] + length - 1]
                    rows.append((r["class"], r["run"], r["class"], r["run"], [0], r["windows"], r["several"], r["rows"], cut))
                if len(rows) > 5_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return met.mapInArrow(run, SLICES)


def _finer(slices: DataFrame, length: int, gram: int) -> DataFrame:
    """Blocks of runs, under a key made of the class, the block and the bytes that all its windows share. Equal blocks
    of a run, as periodic texts have them, are one row with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, schema = Grams(length, gram), _schema(SLICES)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                body, places = r["body"], {}
                for number, lo, windows in grams.blocks(body, r["windows"], BLOCK):
                    # The place of the class is number * BLOCK to number * BLOCK + BLOCK - 1 bytes into a window.
                    place = grams.hashes(body[lo : lo + length]).argmin() + lo
                    core = body[place - number * BLOCK : place - number * BLOCK - BLOCK + 1 + length]
                    cut = body[lo : lo + windows + length - 1]
                    key = _digest(core, (r["class"] + number) & 0xFFFFFFFF)
                    places.setdefault((key, _digest(cut)), (windows, cut, []))[2].append(lo)
                rows += [
                    (*name, r["class"], r["run"], at, windows, r["several"], r["rows"] * len(at), cut)
                    for name, (windows, cut, at) in places.items()
                ]
                if len(rows) > 5_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return slices.mapInArrow(run, SLICES)


def _arrays(slices: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each text (key, sub) among the texts of its key, by suffix arrays over whole keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, size, last = _schema(SPANS), [], 0, None

        def done() -> pa.RecordBatch:
            found = repeated_starts([r[3] for r in held], [r[2] for r in held], length)
            return _batch([(r[0], r[1], spans(hit)) for r, hit in zip(held, found, strict=True)], schema)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "sub", "windows", "body"))
            for row in zip(*columns, strict=True):
                if size > ARRAY_BYTES and row[0] != last:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        if held:
            yield done()

    rows = slices.select("key", "sub", "windows", "body")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPANS)


def spans(hit: np.ndarray) -> list[int]:
    """Edges of the stretches where hit is true: from, to, from, to."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist()


WINDOWS = "key long, sub long, at long, name long"


def _counted(slices: DataFrame, length: int) -> DataFrame:
    """Repeated windows of texts of which their key has too many for an array: windows are counted by their hashes,
    which combines before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(WINDOWS)
        for batch in batches:
            rows = [
                (r["key"], r["sub"], i, _digest(r["body"][i : i + length]))
                for r in batch.select(["key", "sub", "windows", "body"]).to_pylist() for i in range(r["windows"])
            ]
            if rows:
                yield _batch(rows, schema)

    windows = staged(slices.mapInArrow(run, WINDOWS), "windows")
    often = windows.groupBy("key", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hits = join_unique(windows, often, ["key", "name"], spread("sub", "at"), "left_semi")
    # Neighbours make one span. A text has RUN windows at most.
    before = F.row_number().over(Window.partitionBy("key", "sub").orderBy("at"))
    runs = hits.withColumn("island", F.col("at") - before).groupBy("key", "sub", "island").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    return runs.groupBy("key", "sub").agg(F.flatten(F.array_sort(F.collect_list(F.array("a", "b")))).alias("spans"))


def _resolve(slices: DataFrame, length: int, gram: int, levels: int = 1) -> DataFrame:
    """Spans of repeated windows of each text (key, sub): whole if it comes more than once."""
    texts = slices.groupBy("key", "sub").agg(F.sum("rows").alias("rows"), F.max("windows").alias("windows"), F.max("several").alias("several"))
    texts = staged(texts, "texts")
    kinds = texts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.max("several").alias("rich"))
    often = texts.where("rows > 1").select("key", "sub", F.array(F.lit(0).cast("long"), "windows").alias("spans"))
    open_ = staged(
        join_unique(slices, kinds.where("kinds > 1 OR rich"), ["key"], spread("sub", "run")).dropDuplicates(["key", "sub"]), "open"
    )
    parts = [often, _arrays(open_.where(f"kinds <= {PER_KEY}"), length)]
    many = open_.where(f"kinds > {PER_KEY}").drop("kinds", "rich")
    if not many.isEmpty():
        if levels:
            blocks = staged(_finer(many, length, gram), "blocks")
            found = staged(_resolve(blocks, length, gram, levels - 1), "blocks-found")
            back = join_wide(
                blocks.select("key", "sub", "class", "run", "lo"), found, ["key", "sub"], spread("class", "run")
            )
            parts.append(back.groupBy(F.col("class").alias("key"), F.col("run").alias("sub")).agg(
                F.flatten(F.collect_list(F.expr("flatten(transform(lo, l -> transform(spans, x -> x + l)))"))).alias("spans")
            ))
        else:
            parts.append(_counted(many, length))
    all_ = parts[0]
    for part in parts[1:]:
        all_ = all_.unionByName(part)
    return all_.groupBy("key", "sub").agg(F.flatten(F.collect_list("spans")).alias("spans")).where("size(spans) > 0")


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per text that has any (named by m1, m2): spans of the first bytes of its repeated windows."""
    marked = _marked(docs)
    runs = staged(_runs(marked, length, gram), "runs")
    classes = runs.groupBy("class").agg(F.sum(F.expr("IF(several, 2, 1)")).alias("n")).where("n > 1").drop("n")
    met = join_unique(runs, classes, ["class"], spread("m1", "start"), "left_semi")
    # A text that many rows share gives each of its runs once, with their number.
    places = staged(
        met.groupBy("m1", "m2", "class", "run", "start", "windows", "several").agg(
            F.count(F.lit(1)).alias("rows"), F.min("doc").alias("doc")
        ), "places",
    )
    texts = places.groupBy("class", "run").agg(
        F.sum("rows").alias("rows"), F.max("windows").alias("windows"), F.max("several").alias("several"),
        F.min(F.struct("m1", "m2", "doc", "start")).alias("at"),
    )
    texts = staged(texts.select("class", "run", "rows", "windows", "several", "at.*"), "run-texts")
    kinds = texts.groupBy("class").agg(F.count(F.lit(1)).alias("kinds"), F.max("several").alias("rich"))
    # Alone in its class, a text needs no array: it repeats if it comes more than once.
    asked = join_unique(texts, kinds.where("kinds > 1 OR rich"), ["class"], spread("run"))
    slices = staged(_slices(marked, asked, length), "slices")
    single = texts.where("rows > 1").select("class", "run", F.array(F.lit(0).cast("long"), "windows").alias("spans"))
    found = _resolve(slices, length, gram).withColumnsRenamed({"key": "class", "sub": "run"})
    found = staged(
        found.unionByName(single).groupBy("class", "run").agg(F.flatten(F.collect_list("spans")).alias("spans")), "run-spans"
    )
    hits = join_wide(places.select("m1", "m2", "class", "run", "start"), found, ["class", "run"], spread("m1", "start"))
    return hits.groupBy("m1", "m2").agg(
        F.flatten(F.collect_list(F.expr("transform(spans, x -> x + start)"))).alias("spans")
    )


def covered(spans_: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that the windows of the spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(spans_[::2], spans_[1::2], strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b - 1 + length))
        else:
            out.append((a, b - 1 + length))
    return out


def _with_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    with passing() as keep:
        found = keep(staged(repeated_windows(docs, length, gram), "spans"))
    return join_unique(
        _marked(docs), found.hint("shuffle_hash"), ["m1", "m2"], spread("doc_id"), "left"
    ).select("doc_id", "text", "spans")


def _kept(text: str, spans_: list[int] | None, length: int, more: Sequence[tuple[int, int]] = ()) -> tuple[bytes, int, int, int]:
    body = _raw(text)
    cut = covered(spans_ or [], length)
    if more:
        # A stretch of bytes is covered by windows of one byte.
        cut = covered([x for pair in [*cut, *more] for x in pair], 1)
    edges = [0, *(x for pair in cut for x in pair), len(body)]
    kept = b"".join([body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
    return kept, len(body), len(body) - len(kept), len(cut)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeat_digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of docs (doc_id, text): bytes, removed bytes and stretches, and a digest of what is left.

    A byte goes if a string of ``length`` bytes that covers it also begins elsewhere, in this row or another one;
    repeated rows are elsewhere too. Null texts are empty; texts shorter than ``length`` lose nothing; an empty
    table gives an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                kept, *sizes = _kept(text, found.as_py(), length)
                rows.append((*sizes, hashlib.sha256(kept).hexdigest()))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (_INT, _INT, _INT, pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return _with_spans(docs, length, gram).mapInArrow(run, DIGEST)


_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")


class _Codes(dict):
    """Codes of words, remembered up to a number of them."""

    def __missing__(self, word: bytes) -> str:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = made = "".join([chr(value >> 7 * i & 127) for i in range(CODE)])
        return made


def passage_spans(text: str, spans_: list[int], passage: int) -> list[tuple[int, int]]:
    """Bytes of the passages of a text whose windows in coded words are spans_. Only windows that begin with a word count."""
    words = [m.span() for m in _WORD.finditer(_raw(text))]
    out = []
    for a, b in zip(spans_[::2], spans_[1::2], strict=True):
        first, last = -(-a // CODE), (b - 1) // CODE
        if first <= last:
            out.append((words[first][0], words[last + passage - 1][1]))
    return out


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, gram: int | None = None) -> DataFrame:
    """Per text that has any (named by m1, m2): spans of its repeated windows of so many words, in coded words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            codes = pa.array(["".join([known[w] for w in _raw(t).split()]) for t in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, batch.column(2), batch.column(3)], ["doc_id", "text", "o1", "o2"])

    marked = _marked(docs).withColumnsRenamed({"m1": "o1", "m2": "o2"})
    codes = staged(marked.mapInArrow(run, "doc_id long, text string, o1 long, o2 long"), "codes")
    found = repeated_windows(codes.select("doc_id", "text"), passage * CODE, gram or passage * CODE // 4)
    names = codes.select("o1", "o2", F.xxhash64("text").alias("m1"), F.xxhash64(F.lit(1), "text").alias("m2")).distinct()
    met = join_unique(names, found, ["m1", "m2"], spread("o1"))
    return met.select(F.col("o1").alias("m1"), F.col("o2").alias("m2"), "spans")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: int | None = None) -> DataFrame:
    """The rows of docs, with all their columns, less the repeated bytes of their texts; bytes of characters that a
    cut has split go too. A null text becomes empty. With ``passage``, strings of so many whole words that recur, whatever
    their blanks, go as well, however few bytes they have."""
    with passing() as keep:
        found = keep(staged(repeated_windows(docs, length, gram), "spans"))
    found = found.withColumn("passages", F.lit(None).cast("array<long>"))
    if passage:
        with passing() as keep:
            more = keep(staged(repeated_passages(docs, passage).withColumnRenamed("spans", "passages"), "passages"))
        found = found.drop("passages").join(more.hint("shuffle_hash"), ["m1", "m2"], "full")
    text, names = F.coalesce("text", F.lit("")), docs.columns
    marks = {"_repeat_m1": F.xxhash64(text), "_repeat_m2": F.xxhash64(F.lit(1), text)}
    met = join_unique(
        docs.withColumns(marks), found.withColumnsRenamed({
            "m1": "_repeat_m1", "m2": "_repeat_m2", "spans": "_repeat_spans", "passages": "_repeat_passages"
        }).hint("shuffle_hash"),
        list(marks), spread("doc_id"), "left",
    ).select(*names, "_repeat_spans", "_repeat_passages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            kept = [
                _kept(text or "", found.as_py(), length, passage_spans(text or "", more.as_py() or [], passage or 0))[0].decode("utf-8", "ignore")
                for text, found, more in zip(batch.column(at).to_pylist(), batch.column(len(names)), batch.column(len(names) + 1), strict=True)
            ]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return met.mapInArrow(run, docs.schema)

"""Near copies by 64-bit SimHash fingerprints and the pigeonring principle.

If two fingerprints differ in at most t bits and are cut into m segments on a ring, some segment begins a chain
of which every prefix of l segments holds at most l * t / m differences. So candidates are pairs that keep this
budget from some segment on; the full comparison comes after. With m = 9 and t = 4 the budgets are
0, 0, 1, 1, 2, 2, 3, 3, 4: two segments agree, and the next two have one difference together. The first four
segments (28 bits) are therefore a join key: as they are on one side, and with each bit of the third and fourth
flipped, or none, on the other."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feederlens.llm.common import join_unique, spread, staged, words
from feederlens.llm.components import components

BITS = 64
SEED = 42


def majority(hashes: Sequence[int] | np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, k: int = 4) -> int:
    """SimHash of the k-word shingles, each as often as it occurs; 0 for a text without words."""
    import xxhash

    found = words(text)
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= k:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = [0, *ends[: len(found) - k].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
    return majority(hashes)


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id and fingerprint (as a signed number) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def segments(limit: int) -> list[int]:
    """Widths of the segments: 2 * limit + 1 of them, so that the first two of a chain must agree."""
    m = 2 * limit + 1
    return [BITS // m + (i < BITS % m) for i in range(m)]


def _turned(fp: Column, by: int) -> Column:
    """The fingerprint turned left, so that the segment that begins at bit `by` stands at the top."""
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _keys(flips: Column, at: int, key: Column) -> Column:
    return F.transform(flips, lambda flip: F.struct(F.lit(at).alias("at"), key.bitwiseXOR(flip).alias("key")))


def links(distinct: DataFrame, limit: int = 4) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints (column fp) that differ in at most limit bits.

    One row per segment is the index side; the probing side has a row for each key that the budget allows."""
    widths = segments(limit)
    m = len(widths)
    index, probe, rest = [], [], F.lit(False)
    for i in range(m):
        chain = [widths[(i + j) % m] for j in range(m)]
        used = sum(chain[:4])
        key = F.shiftrightunsigned(_turned(F.col("fp"), sum(widths[:i])), BITS - used)
        loose = chain[2] + chain[3]
        flips = F.array(*[F.lit(x).cast("long") for x in (0, *(1 << b for b in range(loose)))])
        index.append(F.struct(F.lit(i).alias("at"), key.alias("key")))
        probe.append(_keys(flips, i, key))
        kept, width = F.lit(True), 0
        apart = _turned(F.col("x"), sum(widths[:i]))
        for j in range(m - 1):
            width += chain[j]
            kept = kept & (F.bit_count(F.shiftrightunsigned(apart, BITS - width)) <= (j + 1) * limit // m)
        rest = rest | ((F.col("at") == i) & kept)
    left = distinct.select(F.col("fp").alias("a"), F.explode(F.array(*index)).alias("k")).select("a", "k.at", "k.key")
    right = distinct.select(F.col("fp").alias("b"), F.explode(F.flatten(F.array(*probe))).alias("k")).select(
        "b", "k.at", "k.key"
    )
    met = left.join(right.hint("merge"), ["at", "key"]).where("a < b").withColumn("x", F.col("a").bitwiseXOR(F.col("b")))
    near = met.where(rest).where(F.bit_count("x") <= limit)
    return near.select("a", "b").distinct()


def near_groups(docs: DataFrame, k: int = 4, limit: int = 4) -> DataFrame:
    """Per row of docs (doc_id, text): its fingerprint as 16 hex digits, and component_id, the smallest
    doc_id that links reach. A null or wordless text has fingerprint zero and links like any other; null doc_ids
    count in no minimum; repeated rows come back repeated; an empty table gives an empty one."""
    marks = staged(fingerprints(docs, k), "simhash")
    distinct = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = components(links(distinct.select("fp"), limit))
    # Components are named by a fingerprint; their documents by the smallest doc_id.
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = join_unique(named, lowest, ["component"], spread("fp")).select("fp", "component_id")
    return join_unique(marks, classes, ["fp"], spread("doc_id")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, k: int = 4, limit: int = 4) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group: those with its smallest doc_id. Groups in
    which no row has an id stay whole."""
    kept = near_groups(docs, k, limit).where("component_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    kept = staged(kept, "kept").hint("shuffle_hash")
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")

"""Exact copies by composable polynomial fingerprints, confirmed chunk by chunk.

A chunk's fingerprint is its bytes read as one number modulo a prime. Fingerprints of neighbours join by
shifting the left one by the length of the right one, so chunks of a huge text can be hashed anywhere and in
any order. Rows with equal fingerprints are compared chunk by chunk through aggregates that combine
before their exchange: no task ever holds a group or two whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.common import BLANKS, join_unique, passing, spread, staged

#: A safe prime: (PRIME - 1) / 2 is prime too, so powers of 256 do not repeat early.
PRIME = 2**124 + 25951
CHUNK = 1 << 16


def chunks(text: bytes, size: int = CHUNK) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


def chunk_hash(chunk: bytes) -> int:
    return int.from_bytes(chunk, "big") % PRIME


def combine(left: tuple[int, int], right: tuple[int, int]) -> tuple[int, int]:
    """(length, hash) of two neighbours as one: the left hash moves up by the length of the right one."""
    return left[0] + right[0], (left[1] * pow(256, right[0], PRIME) + right[1]) % PRIME


def polynomial(text: bytes, size: int = CHUNK) -> tuple[int, int]:
    whole = (0, 0)
    for chunk in chunks(text, size):
        whole = combine(whole, (len(chunk), chunk_hash(chunk)))
    return whole


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, BLANKS)


MARKS = "doc_id long, n_chars long, n_bytes long, fingerprint string, text_sha256 string"


def fingerprints(docs: DataFrame, size: int = CHUNK, mark=polynomial) -> DataFrame:
    """doc_id, code points, bytes of the normalised text, its fingerprint and its SHA-256, one per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            marks = []
            for text in texts:
                body = normalised(text)
                n, value = mark(body, size)
                marks.append((len(text or ""), n, f"{value:032x}", hashlib.sha256(body).hexdigest()))
            columns = [batch.column(0), *(pa.array(c) for c in zip(*marks, strict=True))] if marks else [pa.array([])] * 5
            yield pa.RecordBatch.from_arrays(
                [c.cast(t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                ["doc_id", "n_chars", "n_bytes", "fingerprint", "text_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MARKS)


PIECES = "n_bytes long, fingerprint string, text_sha256 string, chunk long, body binary"


def _pieces(docs: DataFrame, size: int, mark) -> DataFrame:
    """Chunks of the normalised texts under their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["n_bytes", "fingerprint", "text_sha256", "chunk", "body"]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for text in part.column(0).to_pylist():
                    body = normalised(text)
                    n, value = mark(body, size)
                    name = hashlib.sha256(body).hexdigest()
                    out += [(n, f"{value:032x}", name, i, c) for i, c in enumerate(chunks(body, size))]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                    )

    return docs.select("text").mapInArrow(run, PIECES)


def exact_groups(docs: DataFrame, size: int = CHUNK, mark=polynomial) -> DataFrame:
    """Per row of docs (doc_id, text): keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without ASCII white space; a null text is empty. The row with the
    most code points stays, then the one with the smallest doc_id; of wholly tied rows (repeated rows) all
    carry kept = true if their doc_id stays, so doc_id is what is kept or dropped. A null doc_id stays only
    if it has the most code points. An empty table gives an empty one."""
    marks = staged(fingerprints(docs, size, mark), "fingerprints")
    key = ["n_bytes", "fingerprint"]
    shared = marks.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    twins = join_unique(marks, shared, key, spread("doc_id", "n_chars"), "left_semi").select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = texts.join(twins.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(twins["doc_id"]), "left_semi")
    bodies = _pieces(asked, size, mark)
    contents = bodies.groupBy(*key, "chunk", "body").agg(F.count(F.lit(1)).alias("rows"))
    kinds = contents.groupBy(*key, "chunk").agg(F.count(F.lit(1)).alias("kinds")).groupBy(*key).agg(
        F.max("kinds").alias("kinds")
    )
    clashing = staged(kinds.where("kinds > 1").select(*key), "clashing")
    if clashing.isEmpty():
        split = marks.withColumn("part", F.lit(""))
    else:
        split = _split_collisions(marks, bodies, clashing, key)
    group = [*key, "part"]
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("d")))
    groups = split.groupBy(*group).agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        *group, (-F.col("best.d")).alias("keep_id"), "group_size"
    )
    return join_unique(split, groups, group, spread("doc_id", "n_chars")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _split_collisions(marks: DataFrame, bodies: DataFrame, clashing: DataFrame, key: list[str]) -> DataFrame:
    """Marks with a column part that tells apart different texts of one fingerprint. Equal chunks have one class, the
    smallest digest of a text that holds the chunk there; a text's part is the list of its classes in order. A text's
    own chunks are all that is ever gathered."""
    some = bodies.join(clashing, key, "left_semi").distinct()
    classes = some.groupBy(*key, "chunk", "body").agg(F.min("text_sha256").alias("class"))
    listed = (
        some.join(classes, [*key, "chunk", "body"])
        .groupBy(*key, "text_sha256")
        .agg(F.array_sort(F.collect_set(F.struct("chunk", "class"))).alias("classes"))
        .select(*key, "text_sha256", F.to_json("classes").alias("part"))
    )
    met = join_unique(marks, listed, [*key, "text_sha256"], spread("doc_id", "n_chars"), "left")
    return met.withColumn("part", F.coalesce("part", F.lit("")))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; of repeated rows one."""
    with passing() as keep:
        kept = exact_groups(docs).where("kept OR keep_id IS NULL").groupBy(F.col("doc_id").alias("_kept_id")).agg(F.count(F.lit(1)).alias("_kept_rows"))
        kept = keep(staged(kept, "kept"))
    met = docs.join(kept.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(F.col("_kept_id")))
    once, often = met.where("_kept_rows = 1"), met.where("_kept_rows > 1").dropDuplicates(["doc_id", "text"])
    return once.unionByName(often).select(*docs.columns)

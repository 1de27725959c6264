"""Near copies among embeddings: rotated binary codes estimate, confidence bounds decide, the rest is exact.

A vector is turned by a random rotation, and the signs are its code. With the stored factor <code, vector> the
product of a code with another vector is an unbiased estimate of the cosine, whose error has a known bound. Only
pairs whose bound reaches the threshold are computed in double precision.

Which pairs are looked at at all follows from signs too: each table takes some of them as a bucket. Tables and
signs per table follow from the number of vectors, so that buckets keep their size and a pair at the threshold is
met with the probability ``recall`` at least. Buckets larger than a block are compared block by block, so no task
holds a bucket. Pairs are counted where they are found; only counts and spanning edges leave a task."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import join_unique, spread, staged
from feederlens.llm.components import components

#: Rows of a block; a task compares two blocks at a time.
BLOCK = 512
#: Vectors that a bucket holds on average, at most.
PER_BUCKET = 256
#: Half width of the confidence interval, in units of the estimate's error scale.
CONFIDENCE = 4.5
SEED = 20240229


def shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs per table, and tables."""
    signs = max(8, math.ceil(math.log2(max(n, 1) / PER_BUCKET)))
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotation(dim: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, signs: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (packed signs under the first rotation), their factors, and the buckets in all tables."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, 0).T
    code = np.packbits(turned > 0, axis=1)
    factor = np.abs(turned).sum(1) / math.sqrt(dim)
    planes = np.concatenate([rotation(dim, 1 + i) for i in range(-(-signs * tables // dim))])[: signs * tables]
    bits = (unit @ planes.T > 0).reshape(len(unit), tables, signs)
    return code, factor, bits @ (1 << np.arange(signs, dtype=np.int64))


def estimate(code: np.ndarray, factor: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded vectors (rows) with unit vectors (columns), and the bounds of the rows' errors."""
    dim = unit.shape[1]
    signs = np.unpackbits(code, axis=1, count=dim).astype(np.float64) * 2 - 1
    got = signs @ (unit @ rotation(dim, 0).T).T / math.sqrt(dim)
    bound = CONFIDENCE * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(max(1, dim - 1))
    return got / factor[:, None], bound


CODED = "id long, weight long, vector array<double>, code binary, factor double, buckets array<long>"


def coded(classes: DataFrame, signs: int, tables: int) -> DataFrame:
    """Codes of vectors (id, weight, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                raw = flat[starts[rows][:, None] + np.arange(dim)]
                code, factor, buckets = encode(_unit(raw), signs, tables)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), vectors.take(take),
                    pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor),
                    pa.array(buckets.tolist(), pa.list_(pa.int64())),
                ], ["id", "weight", "vector", "code", "factor", "buckets"])

    return classes.mapInArrow(run, CODED)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors; the largest component is taken out first, so squares neither overflow nor vanish."""
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


FOUND = "id long, linked long, root long"


def _compare(threshold: float):
    """Links inside one meeting of two blocks: per vector the weights linked, and its smallest reachable id."""

    def one(part: pa.Table) -> pa.RecordBatch | None:
        ids, weight, table, blocks = (part.column(c).to_numpy() for c in ("id", "weight", "table", "own"))
        lo = part.column("lo")[0].as_py()
        raw = part.column("vector").combine_chunks()
        unit = _unit(raw.flatten().to_numpy().reshape(len(ids), -1))
        code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        factor = part.column("factor").to_numpy()
        buckets = part.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        first = np.flatnonzero(blocks == lo)
        other = first if (blocks == lo).all() else np.flatnonzero(blocks != lo)
        got, bound = estimate(code[first], factor[first], unit[other])
        a, b = np.nonzero(got + bound[:, None] >= threshold)
        a, b = first[a], other[b]
        if other is first:
            keep = ids[a] < ids[b]
            a, b = a[keep], b[keep]
        near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
        a, b = a[near], b[near]
        now = int(table[0])
        # A pair counts in the first table in which it shares a bucket.
        new = ~(buckets[a, :now] == buckets[b, :now]).any(1) if now else np.ones(len(a), bool)
        a, b = a[new], b[new]
        if not len(a):
            return None
        linked = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        root = ids.copy()
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            if (before == root).all():
                break
        hit = np.flatnonzero(linked > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[hit]), pa.array(linked[hit].astype(np.int64)), pa.array(root[hit])], ["id", "linked", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "table", "bucket", "lo", "hi")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                key = tuple(keys[i].tolist())
                if key != now and held:
                    if (made := one(pa.Table.from_batches(held))) is not None:
                        yield made
                    held = []
                now = key
                held.append(batch.slice(i, j - i))
        if held and (made := one(pa.Table.from_batches(held))) is not None:
            yield made

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = 0.97,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """Per row (id, vector): n_links, component_id, kept.

    n_links counts other rows with a cosine of at least the threshold, equal vectors and repeated rows included;
    component_id is the smallest id that links reach. Null or zero vectors and those with null or non-finite
    components link with nothing; vectors of different lengths do not link. A null id counts in no minimum. An
    empty table gives an empty one."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    fit = F.expr(
        "vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) != double('inf'))"
        " AND exists(vector, x -> x != 0)"
    )
    marked = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    # Equal vectors are one, with a weight.
    classes = staged(
        marked.where("fit").groupBy("vector").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"))
        .select(F.xxhash64("vector").alias("id"), "low", "weight", "vector"), "vectors",
    )
    signs, tables = shape(classes.count(), threshold, recall)
    codes = staged(coded(classes.select("id", "weight", "vector"), signs, tables), "codes")
    dealt = codes.select("*", F.size("vector").alias("dim"), F.posexplode("buckets").alias("table", "bucket"))
    place = ["dim", "table", "bucket"]
    sizes = (
        codes.select(F.size("vector").alias("dim"), F.posexplode("buckets").alias("table", "bucket"))
        .groupBy(*place).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        .select(*place, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    met = (
        join_unique(dealt, sizes, place, spread("id"))
        .withColumn("own", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*place, F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"),
                "own", "id", "weight", "vector", "code", "factor", "buckets")
    )
    meeting = [*place, "lo", "hi"]
    found = staged(
        met.repartition(*meeting).sortWithinPartitions(*meeting).mapInArrow(_compare(threshold), FOUND), "found"
    )
    counts = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    whole = classes.join(counts, "id", "left").join(
        named.select(F.col("node").alias("id"), "component"), "id", "left"
    ).withColumn("component", F.coalesce("component", "id"))
    lowest = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    known = join_unique(whole, lowest, ["component"], spread("id")).select(
        "vector", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    out = join_unique(marked.where("fit"), known, ["vector"], spread("id")).select("id", "n_links", "component_id")
    out = out.unionByName(marked.where("NOT fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(
        F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )

"""Centroid clustering in whole numbers, with far centroids ruled out in a PCA-rotated space.

Components become integers floor(scale * x). A vector is stored with its leading coordinates under the rotation to
the principal axes and the norm of the rest. As a rotation keeps distances, |lead - lead'|^2 + (rest - rest')^2 is a
lower bound of the squared distance to a centroid. Centroids whose bound is not above the distance to the one with
the least bound are computed in integers; all sums are integers too, so no result depends on the order of tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import discard, staged

K, ROUNDS, SCALE, DIM, LEAD = 40, 5, 256, 64, 16
#: Components beyond this, in either direction, are computed with Python's integers.
LARGE = 1 << 26
#: Bounds are lowered by this share of the squared norms, for the rounding of the rotated coordinates.
ROUNDING = 1e-9
#: Sums leave a task in digits of so many bits, so sums over any number of tasks stay exact.
DIGIT = 32
MOST = (1 << 63) - 1

Centroid = tuple[int, ...]


def whole(raw: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); Python integers where a component is large."""
    scaled = raw * float(scale)
    if not len(raw) or np.abs(raw).max() < LARGE / scale:
        return np.floor(scaled).astype(np.int64)
    # From 2^53 on a double is a whole number.
    one = lambda x, y: int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(y))
    return np.array([[one(*p) for p in zip(*rows, strict=True)] for rows in zip(raw, scaled, strict=True)], object)


class Assigner:
    """Nearest centroids of blocks of vectors; ``rotation`` has the principal axes as columns."""

    def __init__(self, centroids: list[Centroid], rotation: np.ndarray, lead: int, scale: int):
        self.exact = [list(c) for c in centroids]
        self.small = all(abs(x) < LARGE for c in centroids for x in c)
        self.scale = scale
        if self.small:
            self.points = np.array(self.exact, np.int64).reshape(len(centroids), len(rotation))
            self.lead, self.rest = projected(self.points.astype(float), rotation, lead)
            self.norms = (self.points.astype(float) ** 2).sum(1)

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances of vectors (rows) to centroids (columns)."""
        norms = (lead * lead).sum(1) + rest * rest
        got = norms[:, None] + (self.lead * self.lead).sum(1) + self.rest**2 - 2 * (lead @ self.lead.T) - 2 * np.outer(rest, self.rest)
        return got - ROUNDING * (norms[:, None] + self.norms) - 1e-6

    def nearest(self, values: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid (ties: the smaller number) and squared distance of each vector."""
        if values.dtype == object or not self.small:
            found = [min((sum((int(x) - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(self.exact)) for v in values]
            return np.array([j for _, j in found], np.int32), np.array([d for d, _ in found], object)
        bound = self.bounds(lead, rest)
        first = bound.argmin(1)
        best = self._distance(values, np.arange(len(values)), first)
        chosen = first.astype(np.int32)
        open_ = bound <= best[:, None]
        open_[np.arange(len(values)), first] = False
        for j in np.flatnonzero(open_.any(0)):
            rows = np.flatnonzero(open_[:, j])
            d = self._distance(values, rows, np.full(len(rows), j))
            better = (d < best[rows]) | ((d == best[rows]) & (j < chosen[rows]))
            best[rows[better]], chosen[rows[better]] = d[better], j
        return chosen, best

    def _distance(self, values: np.ndarray, rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        apart = values[rows] - self.points[centroid]
        return np.einsum("ij,ij->i", apart, apart)


def projected(values: np.ndarray, rotation: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates, and the norm of the others."""
    turned = values @ rotation
    return turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def principal_axes(kept: DataFrame, dim: int, scale: int) -> np.ndarray:
    """Axes of the vectors' second moments, by falling variance; each task adds up its own.

    Values are brought into [-1, 1] by a common factor, so moments of any vectors are finite."""
    top = kept.agg(F.max(F.expr("aggregate(vector, 0D, (m, x) -> greatest(m, abs(CAST(x AS DOUBLE))))"))).first()[0] or 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            x = _matrix(batch.column(0), dim) / top
            n, first, second = n + len(x), first + x.sum(0), second + x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim + 1), pa.int32()), pa.array([[float(n)], *([*r, f] for r, f in zip(second.tolist(), first.tolist(), strict=True))])],
            ["axis", "sums"],
        )

    sums = kept.select("vector").mapInArrow(run, "axis int, sums array<double>")
    cells = sums.select("axis", F.posexplode("sums").alias("at", "x")).groupBy("axis", "at").agg(F.sum("x").alias("x")).collect()
    n, moments = 0.0, np.zeros((dim, dim + 1))
    for axis, at, x in cells:
        if axis == 0:
            n = x
        else:
            moments[axis - 1, at] = x
    mean = moments[:, dim] / max(n, 1.0)
    _, axes = np.linalg.eigh(moments[:, :dim] / max(n, 1.0) - np.outer(mean, mean))
    return axes[:, ::-1]


def _digits(number: int) -> list[int]:
    """The number as signed digits of 32 bits, the lowest first."""
    sign, rest, out = (-1, -number, []) if number < 0 else (1, number, [])
    while rest:
        out.append(sign * (rest & ((1 << DIGIT) - 1)))
        rest >>= DIGIT
    return out or [0]


STORED = "id long, vector array<{kind}>, lead array<double>, rest double"


def _stored(kept: DataFrame, axes: np.ndarray, dim: int, scale: int, lead: int) -> DataFrame:
    kind = kept.schema["vector"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole(_matrix(batch.column(1), dim), scale)
            leading, rest = projected(values.astype(float), axes, lead)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(leading), pa.list_(pa.float64())), pa.array(rest)], ["id", "vector", "lead", "rest"]
            )

    return kept.select("id", "vector").mapInArrow(run, STORED.format(kind=kind))


def _assigned(batch: pa.RecordBatch, assigner: Assigner, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = whole(_matrix(batch.column(1), dim), assigner.scale)
    lead = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
    return values, *assigner.nearest(values, lead, batch.column(3).to_numpy())


def _sums(stored: DataFrame, assigner: Assigner, dim: int) -> dict[int, tuple[int, list[int]]]:
    """Per centroid the number of its vectors and the sums of their components; the driver gets k * dim numbers."""
    k = len(assigner.exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * k, [[0] * dim for _ in range(k)]
        for batch in batches:
            values, chosen, _ = _assigned(batch, assigner, dim)
            for j in np.unique(chosen).tolist():
                mine = values[chosen == j]
                count[j] += len(mine)
                total[j] = [a + int(b) for a, b in zip(total[j], mine.sum(0).tolist(), strict=True)]
        made = [(j, at, i, d) for j in range(k) if count[j] for at, x in enumerate([*total[j], count[j]]) for i, d in enumerate(_digits(x))]
        columns = list(zip(*made, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
            ["cluster", "at", "digit", "x"],
        )

    rows = stored.mapInArrow(run, "cluster int, at int, digit int, x long").groupBy("cluster", "at", "digit").agg(F.sum("x").alias("x")).collect()
    out: dict[int, list[int]] = {}
    for cluster, at, digit, x in rows:
        out.setdefault(cluster, [0] * (dim + 1))[at] += x << (DIGIT * digit)
    return {j: (x[dim], x[:dim]) for j, x in out.items()}


ASSIGNED = "id long, cluster int, distance decimal(38,0)"


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 2, scale: int = SCALE, dim: int = DIM,
    lead: int = LEAD, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """Per kept vector: its id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``dim`` components, none null or non-finite; the others, and null vectors, return no row.
    Starts are the k kept rows with the smallest sha256 of '<seed>:<id>'; of repeated ids the smaller vector comes
    first. Rows with a null id are assigned but no starts, unless all ids are null: then the smallest vector is the
    only one. Fewer rows give fewer clusters, and no row an empty table. Repeated rows stay repeated. Distances beyond 38 digits become 10^38 - 1, and those and
    sums beyond a long its largest value; assignments are exact for any component."""
    fit = F.expr(f"size({vector_column}) = {dim} AND forall({vector_column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) != double('inf'))")
    if vectors.schema[vector_column].dataType.elementType.simpleString() not in ("float", "double"):
        vectors = vectors.withColumn(vector_column, F.col(vector_column).cast("array<double>"))
    kept = vectors.where(F.coalesce(fit, F.lit(False))).select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    axes = principal_axes(kept, dim, scale)
    stored = staged(_stored(kept, axes, dim, scale, lead), "rotated")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = stored.where("id IS NOT NULL").orderBy(mark, "vector").select("vector").limit(k).collect()
    now: list[Centroid] = [tuple(map(int, v)) for v in whole(np.array([r[0] for r in starts], float).reshape(-1, dim), scale)]
    if not now and (only := stored.orderBy("vector").select("vector").first()):
        now = [tuple(map(int, whole(np.array([only[0]], float), scale)[0]))]
    for _ in range(rounds if now else 0):
        sums = _sums(stored, Assigner(now, axes, lead, scale), dim)
        now = [tuple(s // sums[j][0] for s in sums[j][1]) if j in sums else c for j, c in enumerate(now)]
    last = Assigner(now, axes, lead, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        for batch in batches:
            if batch.num_rows:
                _, chosen, distance = _assigned(batch, last, dim)
                far = [decimal.Decimal(min(int(d), 10**38 - 1)) for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen), pa.array(far, pa.decimal128(38, 0))], ["id", "cluster", "distance"])

    assigned = staged(stored.mapInArrow(run, ASSIGNED), "assigned")
    discard(stored)
    fits = lambda x: F.least(x, F.lit(str(MOST)).cast("decimal(38,0)")).cast("long")
    per = {r["cluster"]: r["x"] for r in assigned.groupBy("cluster").agg(fits(F.sum("distance")).alias("x")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    # At most k rows, whatever the input.
    known = vectors.sparkSession.createDataFrame(
        [(j, min(MOST, per[j]), min(MOST, sum(per.values())), names[j]) for j in sorted(per)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_column), "cluster", fits(F.col("distance")).alias("distance"), "cluster_inertia", "inertia", "centroid_sha256"
    )

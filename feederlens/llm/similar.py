"""Near copies by SimHash and an exact check of word shingles: groups of all pairs with |A & B| >= share * |A | B|.

Sets of shingles get 64-bit SimHash fingerprints. Those that differ in LIMIT bits or fewer are found by pigeonring
chains and make groups, and each set is checked with the first of its group. Similar sets may differ in more bits, so
there is an exact way for the rest. Shingles are put in one order for all texts: those in heavy slots of a count come
last, the others by their hash. Two similar sets then share one of their first n - ceil(share * n) + 1 shingles,
whatever the order, so these are the join keys and no pair is missed. As only groups are asked for, each text is first
checked with the set that has fewest shingles before a key of both, which of a family is the one with fewest words of
its own; pairs inside a group that fingerprints or keys have found are left out. Pairs whose sizes,
positions or short parity bits rule the share out are dropped where they meet, then those whose parity bits differ
in more places than the sets may; the rest is compared whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.common import discard, join_unique, spread, staged, words
from feederlens.llm.components import components
from feederlens.llm.simhash import links, majority

WORDS, SHARE = 5, (4, 5)
#: Bits in which fingerprints of candidates may differ. It only saves comparing pairs of keys.
LIMIT = 4
#: Slots of the count that tells frequent shingles. It only orders them, so collisions cost time and no pairs.
SLOT_BITS = 20
#: Parity bits that travel with a key, at most; all of them are compared later.
SHORT_BITS = 512
BLOCK_SLOTS = 8192
#: A slot is heavy with so many occurrences, and so many times more than the average.
LEAST_HEAVY, TIMES_AVERAGE = 16, 4
SEED = 42

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Words(dict):
    """Hashes of words, remembered up to a number of them."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word, SEED)
        return made


class Shingles:
    """Sorted different hashes of the shingles of texts; a text of fewer words is one shingle."""

    def __init__(self, k: int):
        self.k, self.known = k, _Words()

    def of(self, text: str | None) -> np.ndarray:
        found = words(text)
        if not found:
            return np.zeros(0, np.uint64)
        known = self.known
        codes = np.array([known[w] for w in found], np.uint64)
        n = max(1, len(codes) - self.k + 1)
        total = np.zeros(n, np.uint64)
        for i in range(min(self.k, len(codes))):
            # One after another: the place of a word counts.
            total = (total ^ total >> np.uint64(29)) * _MIX[1] + codes[i : i + n] + _MIX[0]
        total ^= total >> np.uint64(30)
        total *= _MIX[1]
        total ^= total >> np.uint64(27)
        total *= _MIX[2]
        return np.unique(total ^ total >> np.uint64(31))


def least_common(a, b, share: tuple[int, int] = SHARE):
    """The least number of common shingles that sets of sizes a and b need."""
    p, q = share
    return -(-(a + b) * p // (p + q))


def prefix_size(n: int, share: tuple[int, int] = SHARE) -> int:
    p, q = share
    return n - -(-n * p // q) + 1


def parity(hashes: np.ndarray) -> bytes:
    """Whether an odd number of hashes falls on each bit; there is about a bit for each hash, 64 at least."""
    size = max(64, 1 << int(len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def short(bits: bytes) -> bytes:
    """Parity bits of a smaller size, so that they can travel with each key of a set."""
    return _folded(np.frombuffer(bits, np.uint8), SHORT_BITS // 8).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """Sets differ in so many shingles at least."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    return int(np.bitwise_count(x ^ _folded(y, len(x))).sum())


def _name(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)


def _heavy(docs: DataFrame, k: int) -> np.ndarray:
    """Which slots are heavy. A task's counts travel as blocks of slots, a row each, and are summed block by block; the
    driver gets a bit for each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(k), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i in range(0, len(texts), 1000):
                found = np.concatenate([shingles.of(t) for t in texts[i : i + 1000]])
                counts += np.bincount((found >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts))
        if counts.any():
            blocks = counts.reshape(-1, BLOCK_SLOTS)
            # Most counts of a task are small: their high bytes are apart, so they take no room when compressed.
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([b.view(np.uint8).reshape(-1, 8).T.tobytes() for b in blocks], pa.binary())],
                ["block", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = np.frombuffer(counts, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()
                sums[block] = sums[block] + made if block in sums else made
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([int(x.sum()) for x in sums.values()], pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                ["block", "total", "counts"],
            )

    dealt = docs.select("text").mapInArrow(run, "block int, counts binary").repartition("block")
    counted = staged(dealt.mapInArrow(add, "block int, total long, counts binary"), "slots")
    every = counted.agg(F.sum("total")).first()[0] or 0
    least = max(LEAST_HEAVY, TIMES_AVERAGE * every >> SLOT_BITS)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.packbits(np.frombuffer(x, np.int64) >= least).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["block", "bits"])

    heavy = np.zeros((1 << SLOT_BITS) // BLOCK_SLOTS * BLOCK_SLOTS // 8, np.uint8)
    for row in counted.select("block", "counts").mapInArrow(bits, "block int, bits binary").toLocalIterator():  # 128 KB in all
        at = row["block"] * BLOCK_SLOTS // 8
        heavy[at : at + BLOCK_SLOTS // 8] = np.frombuffer(row["bits"], np.uint8)
    discard(counted)
    return heavy


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Per row: the name of its set, its size, parity bits, short ones and fingerprint, and two hashes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for batch in batches:
            found = [shingles.of(t) for t in batch.column(1).to_pylist()]
            bits = [parity(h) for h in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.array([_name(h) for h in found], np.uint64).view(np.int64)),
                pa.array([len(h) for h in found], pa.int64()), pa.array(bits, pa.binary()), pa.array([short(b) for b in bits], pa.binary()),
                pa.array(np.array([majority(h) for h in found], np.uint64).view(np.int64)), batch.column(2), batch.column(3),
            ], ["doc_id", "s", "n", "bits", "short", "fp", "m1", "m2"])

    marks = F.xxhash64("text").alias("m1"), F.xxhash64(F.lit(1), "text").alias("m2")
    rows = docs.select(F.col("doc_id").cast("long"), "text", *marks)
    return rows.mapInArrow(run, "doc_id long, s long, n long, bits binary, short binary, fp long, m1 long, m2 long")


def _alike(sets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pairs (a, b): the first set of each group of fingerprints that links of limit bits or fewer make, and another of it."""
    firsts = staged(sets.where("n > 0").groupBy("fp").agg(F.min("s").alias("first")), "fingerprints")
    found = components(links(firsts.select("fp"), limit)).withColumnsRenamed({"node": "fp", "component": "group"})
    named = staged(firsts.join(found, "fp", "left").withColumn("group", F.coalesce("group", "fp")), "near-fingerprints")
    hubs = named.groupBy("group").agg(F.min("first").alias("a"))
    hubs = join_unique(named, hubs, ["group"], spread("fp")).select("fp", "a")
    pairs = join_unique(sets.where("n > 0").select("s", "fp"), hubs, ["fp"], spread("s")).where("a != s")
    out = staged(pairs.select("a", F.col("s").alias("b")), "alike")
    discard(firsts, named)
    return out


def _prefixes(docs: DataFrame, k: int, share: tuple[int, int], heavy) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, slots, done = Shingles(k), np.unpackbits(np.frombuffer(heavy.value, np.uint8)).astype(bool), set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), 1000):
                keys, names, sizes = [], [], []
                for text in texts[at : at + 1000]:
                    found = shingles.of(text)
                    name = _name(found)
                    if not len(found) or name in done:
                        continue
                    if len(done) < 1_000_000:
                        done.add(name)
                    late = slots[(found >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                    keys.append(np.concatenate([found[~late], found[late]])[: prefix_size(len(found), share)])
                    names.append(name)
                    sizes.append(len(found))
                if keys:
                    counts = [len(x) for x in keys]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.repeat(np.array(names, np.uint64).view(np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                        pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in counts])),
                    ], ["key", "s", "n", "at"])

    return docs.select("text").mapInArrow(run, "key long, s long, n int, at int")


def halves(bits: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Short parity bits as rows of words, the same for half the size, and how many words are used."""
    used = np.array([len(b) // 8 for b in bits], np.int64)
    own = np.frombuffer(b"".join([b.ljust(SHORT_BITS // 8, b"\0") for b in bits]), np.uint64).reshape(len(bits), -1)
    half = own.copy()
    for w in set(used.tolist()) - {1}:
        at = used == w
        half[at, : w // 2] ^= half[at, w // 2 : w]
        half[at, w // 2 : w] = 0
    return own, half, used


def _possible(met: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of different groups (column c) that share a key and may be similar by sizes, positions and parity
    bits. Bits are compared where the key is, so pairs that only share common phrases are never listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []

        def pairs(rows: np.ndarray, bits: list[bytes]) -> Iterator[np.ndarray]:
            groups, of, counts = np.unique(rows[:, 2], return_inverse=True, return_counts=True)
            if len(groups) == 1:
                return
            # Rows of the largest group are compared with the others only.
            order = np.argsort(of == counts.argmax(), kind="stable")
            rows = rows[order]
            own = None
            for i in range(len(rows) - int(counts.max())):
                _, s, c, n, at = rows[i]
                rest = rows[i + 1 :]
                # Common shingles from the key on. Nothing common stands before the first key of a pair, where it is found.
                least = least_common(n, rest[:, 3], share)
                fits = (rest[:, 2] != c) & (np.minimum(n - at, rest[:, 3] - rest[:, 4]) >= least)
                fits &= np.minimum(n, rest[:, 3]) * share[1] >= np.maximum(n, rest[:, 3]) * share[0]
                j = np.flatnonzero(fits)
                if not len(j):
                    continue
                if own is None:
                    own, half, used = halves([bits[x] for x in order.tolist()])
                k = i + 1 + j
                x = np.where((used[k] < used[i])[:, None], half[i], own[i]) ^ np.where((used[k] > used[i])[:, None], half[k], own[k])
                near = np.bitwise_count(x).sum(1, dtype=np.int64) <= n + rest[j, 3] - 2 * least[j]
                # With a share of a half or more, one has as many bits as the other, or twice as many.
                near |= (used[k] > 2 * used[i]) | (2 * used[k] < used[i])
                partners = rest[j[near], 1]
                if len(partners):
                    yield np.stack([np.minimum(partners, s), np.maximum(partners, s)], 1)

        def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
            both = np.unique(np.concatenate(found), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        held, kept = np.zeros((0, 5), np.int64), []
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(5)], 1)])
            bits = kept + batch.column(5).to_pylist()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1])
            held, kept = rows[starts[-1] :], bits[starts[-1] :]
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                out += pairs(rows[a:b], bits[a:b])
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
        if len(held):
            for found in pairs(held, kept):
                out.append(found)
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    rows = met.select("key", "s", "c", F.col("n").cast("long"), F.col("at").cast("long"), "short")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def _with_end(pairs: DataFrame, table: DataFrame, end: str, other: str) -> DataFrame:
    """Pairs with what the table says of one end. A row of the table is repeated for the salts that its pairs have, no others."""
    salted = pairs.withColumn("_salt", spread(other))
    wanted = table.join(salted.select(end, "_salt").distinct(), end)
    return salted.join(wanted, [end, "_salt"]).drop("_salt")


def _similar(pairs: DataFrame, docs: DataFrame, sets: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """Those of the pairs that are similar, as a staged table. sets has a row for each name, with a document that shows
    it."""
    p, q = share

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            most = na + nb - 2 * least_common(na, nb, share)
            bits = zip(batch.column("ba").to_pylist(), batch.column("bb").to_pylist(), strict=True)
            kept = [apart(x, y) <= m for (x, y), m in zip(bits, most.tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    ends = [sets.select(F.col("s").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}")) for x in "ab"]
    met = _with_end(_with_end(pairs, ends[0], "a", "b"), ends[1], "b", "a")
    left = staged(met.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(near, "a long, b long"), "likely")

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for batch in batches:
            found = [shingles.of(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["s", "hashes"])

    asked = left.select(F.col("a").alias("s")).union(left.select(F.col("b").alias("s"))).distinct()
    places = sets.join(asked.hint("shuffle_hash"), "s", "left_semi").select("s", "m1", "m2")
    texts = docs.select("text", F.xxhash64("text").alias("m1"), F.xxhash64(F.lit(1), "text").alias("m2"))
    hashes = staged(
        # A name has one text here, so copies of it are dropped where they met it, without another exchange of texts.
        texts.join(places.hint("shuffle_hash"), ["m1", "m2"]).dropDuplicates(["m1", "m2"]).select("s", "text")
        .mapInArrow(shown, "s long, hashes binary"), "hashes",
    )

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                kept.append(both * q >= (len(u) + len(v) - both) * p)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    whole = [hashes.select(F.col("s").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab"]
    # The larger name of a pair has few partners, or AQE splits it; sets are heavy, so only the other end is salted.
    met = _with_end(left.join(whole[1], "b"), whole[0], "a", "b")
    out = staged(met.select("a", "b", "ha", "hb").mapInArrow(same, "a long, b long"), "similar")
    discard(left, hashes)
    return out


def _grouped(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """Each name with its group (s, c)."""
    found = components(edges).withColumnsRenamed({"node": "s", "component": "c"})
    return staged(sets.select("s").join(found.hint("shuffle_hash"), "s", "left").select("s", F.coalesce("c", "s").alias("c")), "groups")


def similar_groups(docs: DataFrame, k: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """Per row of docs (doc_id, text): component_id, the smallest doc_id that similar texts lead to.

    Texts are similar if their sets of k-word shingles have a Jaccard similarity of share (p, q), p / q, at least; wordless texts
    are so among each other. Null doc_ids count in no minimum; an empty table gives an empty one."""
    context = docs.sparkSession.sparkContext
    marks = staged(_sets(docs, k), "sets")
    sets = staged(marks.select("s", "n", "bits", "short", "fp", "m1", "m2").dropDuplicates(["s"]), "distinct-sets")
    alike = _alike(sets)
    heavy = context.broadcast(_heavy(docs, k).tobytes())
    by = Window.partitionBy("key").orderBy("at", "s")
    rows = _prefixes(docs, k, share, heavy).withColumn("before", F.lag("s").over(by)).where("before IS NULL OR before != s")
    rows = rows.withColumn("low", F.first("s").over(by)).withColumn("after", F.lead("s").over(by))
    met = staged(rows.where("low != s OR after IS NOT NULL").select("key", "s", "n", "at", "low"), "met")
    # First each with one of its fingerprint's group, and one other of its keys, the one that it meets most often.
    stars = met.where("low != s").groupBy("s", "low").agg(F.count(F.lit(1)).alias("n"))
    stars = stars.groupBy("s").agg(F.max(F.struct("n", "low")).alias("m")).select(F.col("m.low").alias("a"), F.col("s").alias("b"))
    first = _similar(stars.union(alike).distinct(), docs, sets, k, share)
    groups = _grouped(sets, first)
    discard(alike)
    # A set has no more rows than its text has words, so nothing is salted.
    known = groups.join(sets.select("s", "short"), "s")
    rest = staged(_possible(met.join(known, "s"), share), "possible")
    discard(met, groups)
    more = _similar(rest, docs, sets, k, share)
    discard(rest)
    groups = _grouped(sets, first.union(more))
    discard(first, more, sets)
    named = join_unique(marks.select("doc_id", "s"), groups, ["s"], spread("doc_id"))
    lowest = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    out = staged(join_unique(named, lowest, ["c"], spread("doc_id")).select("doc_id", "component_id"), "components")
    discard(marks, groups)
    return out


def without_similar(docs: DataFrame, k: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group: those with its smallest doc_id. Groups in
    which no row has an id stay whole."""
    groups = similar_groups(docs, k, share)
    kept = groups.where("component_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    kept = staged(kept, "kept").hint("shuffle_hash")
    discard(groups)
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")

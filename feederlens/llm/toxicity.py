"""Toxicity of texts, scored after undoing obfuscation with a noisy-channel model.

Spellings such as "1d!0t", "s t u p i d" or "looooser" are lattices of what each character may stand for: itself,
the letter it imitates, a repetition or a separator to drop, or the end of a word between spelled letters. A character language model of the whole corpus picks
the best path (Viterbi). Words and word beginnings of the restored text are the features of a logistic model."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.common import discard, staged

#: Labelled rows that the classifier is fitted on, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 50_000
#: Features of the classifier, at most: those found in the most toxic rows.
FEATURES = 3_000
#: A feature must be in so many toxic rows, and so many times more often there than in others.
LEAST_ROWS, LEAST_RATIO = 3, 15
PREDICTED_AT = 0.3

#: What a character may imitate, with the cost of it in log units. Fixed values of the channel model.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
COST_IMITATED, COST_DROPPED, COST_KEPT_SYMBOL, COST_REPEATED = 1.0, 2.5, 9.0, 0.7
#: Between spelled letters: breaking words at a separator like the others, and at a wider one, and going on over a wider one.
COST_BREAK, COST_WIDE_BREAK, COST_WIDE_JOIN = 1.0, 0.0, 2.0
#: Words sought at every place of a spelled run, as any separator in it may end a word.
SPELLED_WORD = range(4, 17)
#: Letters with codes of their own in the character model; all others share one. Code 0 is the edge of a word.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
OTHER = len(LETTERS) + 1
SIZE = OTHER + 1

_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_EDGES = ".,;:?!\"'()[]{}<>#%&*|-_=+/\\^~`"
_DECORATION = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$")
_REPEATED = re.compile(r"([^\W\d_])\1")
_SYMBOLS = "".join(c for c in IMITATES if not c.isalnum())
#: Symbols at the edge of a token that stand for nothing.
_PLAIN_EDGES = "".join(c for c in _EDGES if c not in IMITATES)
_UNIT = rf"[^\W_{re.escape(_SYMBOLS)}]|[{re.escape(_SYMBOLS)}]"
#: Four or more single letters, or what imitates them, between any blanks and symbols.
_SPELLED = re.compile(rf"(?<!\w)(?:{_UNIT})(?:(?:(?!{_UNIT})[\W_])+(?:{_UNIT})){{3,}}(?!\w)")
_SEPARATED = re.compile(rf"({_UNIT})((?:(?!{_UNIT}).)*)", re.DOTALL)
#: Separators of spelled letters in a lattice: one as wide as the narrowest of its run, and a wider one.
NARROW, WIDE = "\0", "\1"
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+", re.DOTALL)


class CharacterModel:
    """Log probabilities of a letter after two others, from counts of triples, backed off to pairs and singles."""

    def __init__(self, triples: np.ndarray):
        c3 = triples.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 0.5) / (c1.sum() + 0.5 * SIZE)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()

    def restore(self, text: str, drops: bool = True) -> str:
        """The most likely letters behind an obfuscated spelling; without drops, what may imitate a letter does."""
        return self._decoded(text, drops)

    def restore_spelled(self, run: str) -> set[str]:
        """Words behind letters spelled one by one: those of the most likely path, and all that a path may hold."""
        units = _SEPARATED.findall(run)
        least = min(len(gap) for _, gap in units[:-1])
        text = "".join(unit + (WIDE if len(gap) > least else NARROW) for unit, gap in units)[:-1]
        broken = self._decoded(text, False)
        words = set(_LETTERS.findall(broken))
        for joined in {broken.replace(" ", ""), self.restore("".join(unit for unit, _ in units), False)}:
            words.update(joined[i : i + n] for n in SPELLED_WORD for i in range(len(joined) - n + 1))
            words.update(_LETTERS.findall(joined))
        return words

    def _decoded(self, text: str, drops: bool) -> str:
        """The best path (Viterbi). A state is the last two letters; it keeps its best score, and its path as a chain
        of (letter, what came before). No state is left out: there are as many as pairs of letters that the text may
        stand for."""
        log = self.log
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for char in text:
            if char in (NARROW, WIDE):
                join, cut = (0.0, COST_BREAK) if char == NARROW else (COST_WIDE_JOIN, COST_WIDE_BREAK)
                gone = {k: (score - join, path) for k, (score, path) in states.items()}
                over = [(score + log[a][b][0] - cut, (a, b)) for (a, b), (score, path) in states.items() if path and b]
                if over:
                    score, at = max(over)
                    if (0, 0) not in gone or score > gone[0, 0][0]:
                        gone[0, 0] = (score, (" ", states[at][1]))
                states = gone
                continue
            options = [(char, _CODE.get(char, OTHER), 0.0 if char.isalpha() else COST_KEPT_SYMBOL)]
            options += [(x, _CODE[x], COST_IMITATED) for x in IMITATES.get(char, "")]
            drop = COST_REPEATED if char == before else None if char.isalpha() else COST_DROPPED
            if char in IMITATES and not drops and char != before:
                drop = None
            made: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                row = log[a][b]
                for letter, code, cost in options:
                    total = score + row[code] - cost
                    if (b, code) not in made or total > made[b, code][0]:
                        made[b, code] = (total, (letter, path))
                if drop is not None and ((a, b) not in made or score - drop > made[a, b][0]):
                    made[a, b] = (score - drop, path)
            before = char
            states = made
        best = max(states, key=lambda k: (states[k][0] + log[k[0]][k[1]][0], k))
        letters, path = [], states[best][1]
        while path:
            letter, path = path
            letters.append(letter)
        return "".join(reversed(letters))


def character_counts(docs: DataFrame) -> DataFrame:
    """Counts of letter triples of the whole corpus (code, n); at most SIZE ** 3 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(0x250, np.int64)
        for point in range(0x250):
            low = chr(point).lower()
            table[point] = _CODE.get(low, OTHER if low.isalpha() else 0) if len(low) == 1 else OTHER
        counts = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
                    codes = np.where(points < 0x250, table[np.minimum(points, 0x24F)], OTHER)
                    codes = np.concatenate([[0, 0], codes, [0]])
                    # Two letters before an edge of a word say nothing about the next word.
                    first = np.where(codes[1:-1] == 0, 0, codes[:-2])
                    counts += np.bincount((first * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])

    return docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> CharacterModel:
    triples = np.zeros(SIZE**3, np.int64)
    for row in character_counts(docs).collect():  # at most SIZE ** 3 rows, whatever the corpus
        triples[row["code"]] = row["n"]
    return CharacterModel(triples)


def skeleton(word: str) -> str:
    """The word with each run of a letter as one; letters that are restored only by leaving out repetitions keep it."""
    return _RUN.sub(r"\1", word)


def _named(words: list[str] | set[str]) -> list[str]:
    return [f for word in words for f in (word, "^" + word[:4], "^" + word[:5])]


class Features:
    """Features of texts: restored words, and their beginnings after a mark. With ``wanted`` only those, and a word
    of letters is restored only if what may come out has the skeleton of a wanted feature."""

    def __init__(self, model: CharacterModel, wanted: list[str] | None = None, size: int = 600_000):
        self.model, self.size = model, size
        self.wanted = None if wanted is None else frozenset(wanted)
        self.words = {skeleton(f) for f in wanted or () if f[0] != "^"}
        self.starts = {skeleton(f[1:]) for f in wanted or () if f[0] == "^"}
        #: Tokens seen, and the features of those that have any.
        self.seen: set[str] = set()
        self.known: dict[str, tuple[str, ...]] = {}

    def _may_be_wanted(self, word: str) -> bool:
        if self.wanted is None:
            return True
        bare = skeleton(word)
        return bare in self.words or any(bare[:n] in self.starts for n in range(1, 6))

    def of_token(self, token: str) -> tuple[str, ...]:
        whole = token.strip(_PLAIN_EDGES)
        if whole.isalpha():
            words = [whole]
            if _REPEATED.search(whole) and self._may_be_wanted(whole):
                words.append(self.model.restore(whole))
        else:
            core = _DECORATION.sub("", token.strip(_EDGES)).strip(_EDGES)
            words = _LETTERS.findall(core)
            # Symbols at an edge are punctuation or letters; numbers are numbers.
            left = _DECORATION.sub("", whole).strip(_PLAIN_EDGES)
            forms = [core, left.rstrip(_EDGES), left.lstrip(_EDGES), left]
            if words or (len(left) > 2 and not left.isdigit() and all(c in IMITATES for c in left)):
                for text in dict.fromkeys(forms):
                    if text.isalpha():
                        if _REPEATED.search(text) and self._may_be_wanted(text):
                            words.append(self.model.restore(text))
                    elif text:
                        words += _LETTERS.findall(self.model.restore(text))
                        words += _LETTERS.findall(self.model.restore(text, False))
        found = dict.fromkeys(_named(words))
        return tuple(found if self.wanted is None else [f for f in found if f in self.wanted])

    def of_texts(self, texts: list[str | None]) -> list[set[str]]:
        """Distinct features of each text; none for an empty or null one."""
        out, seen, known = [], self.seen, self.known
        for text in texts:
            low = (text or "").lower()
            row = set(low.split())
            new = row - seen
            for token in new:
                if made := self.of_token(token):
                    known[token] = made
            seen |= new
            found = set().union(*[known[token] for token in row & known.keys()])
            for run in _SPELLED.finditer(low):
                if any(c.isalpha() or c in _SYMBOLS for c in run.group()):
                    found.update(_named(self.model.restore_spelled(run.group())))
            out.append(found if self.wanted is None else found & self.wanted)
            if len(seen) > self.size:
                seen.clear()
                known.clear()
        return out


def held_out(doc_id: str = "doc_id", of: int = 4, rest: int = 2):
    """Whether crc32 of the id as text leaves the rest that is set apart; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of == rest, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Texts of the labelled rows to learn from. A row labelled twice counts as toxic if one label says so."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(known), "doc_id")  # at most `rows` ids and labels


class Classifier:
    """Logistic model over the presence of features."""

    def __init__(self, weights: dict[str, float], base: float):
        self.weights, self.base = weights, base

    def score(self, found: set[str]) -> float:
        weights = self.weights
        total = self.base + sum([weights[f] for f in sorted(found.intersection(weights))])
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))


def fit(docs: DataFrame, labels: DataFrame, model: CharacterModel, rows: int = TRAIN_ROWS, features: int = FEATURES) -> Classifier:
    """Without labels of both kinds the score is the share of toxic ones for every text (0.5 if there is none)."""
    train = _training(docs, labels, rows).select("text", "toxic")
    sizes = dict(train.groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
        share = min(max(share, 0.001), 0.999)
        return Classifier({}, math.log(share / (1 - share)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, counts = Features(shared.value), Counter()
        for batch in batches:
            for found in of.of_texts(batch.column(0).to_pylist()):
                counts.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    # A feature must be in some toxic rows, so only those are asked for their features. Like the rows, what they
    # have in common is bounded.
    common = train.where("toxic = 1").select("text").mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    candidates = sorted(r["feature"] for r in common.where(F.col("n") >= LEAST_ROWS).select("feature").collect())
    asked = docs.sparkSession.sparkContext.broadcast((model, candidates))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, names = asked.value
        of, place = Features(one, names), {f: i for i, f in enumerate(names)}
        for batch in batches:
            found = [sorted(place[f] for f in x) for x in of.of_texts(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])

    looked = staged(train.mapInArrow(look, "toxic int, found array<int>"), "looked")
    counted = looked.select("toxic", F.explode("found").alias("place")).groupBy("place").agg(
        F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")
    )
    ratio = (F.col("toxic") / sizes[1]) / ((F.col("clean") + 0.5) / sizes[0])
    places = [
        r["place"] for r in counted.where(F.col("toxic") >= LEAST_ROWS).where(ratio >= LEAST_RATIO)
        .orderBy(F.desc("toxic"), "place").limit(features).collect()
    ]
    # A count per pattern of features: at most one small row for each training row.
    chosen = F.array_intersect("found", F.lit(places).cast("array<int>")) if places else F.array().cast("array<int>")
    table = looked.select("toxic", F.array_sort(chosen).alias("found")).groupBy("toxic", "found").count().orderBy("toxic", "found").collect()
    discard(looked)
    at = {p: i for i, p in enumerate(places)}
    patterns = [{"toxic": r["toxic"], "found": sorted(at[p] for p in r["found"]), "count": r["count"]} for r in table]
    return Classifier(*_logistic(patterns, [candidates[p] for p in places]))


def _logistic(table: list, chosen: list[str]) -> tuple[dict[str, float], float]:
    """Weights by gradient steps with a small penalty; sums are weighted by how often a pattern occurs."""
    at = np.array([f for r in table for f in r["found"]], np.int64)
    row = np.repeat(np.arange(len(table)), [len(r["found"]) for r in table])
    y = np.array([r["toxic"] for r in table], np.float64)
    n = np.array([r["count"] for r in table], np.float64)
    w, base, total = np.zeros(len(chosen)), 0.0, n.sum()
    push, push_base = np.full(len(chosen), 1e-8), 1e-8
    for _ in range(400):
        z = base + np.bincount(row, w[at], len(table))
        off = n * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        slope = np.bincount(at, off[row], len(chosen)) / total + 1e-5 * w
        push += slope**2
        push_base += (off.sum() / total) ** 2
        w -= 0.5 * slope / np.sqrt(push)
        base -= 0.5 * off.sum() / total / math.sqrt(push_base)
    return dict(zip(chosen, w.tolist(), strict=True)), base


SCORED = "doc_id long, score double"


def _learnt(docs: DataFrame, labels: DataFrame, rows: int, features: int):
    model = character_model(docs)
    return docs.sparkSession.sparkContext.broadcast((model, fit(docs, labels, model, rows, features)))


def _scores(of: Features, classifier: Classifier, texts: list[str | None]) -> list[float]:
    return [classifier.score(x) for i in range(0, len(texts), 1000) for x in of.of_texts(texts[i : i + 1000])]


def clean(docs: DataFrame, labels: DataFrame, at: float = PREDICTED_AT) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below ``at``."""
    shared, names = _learnt(docs, labels, TRAIN_ROWS, FEATURES), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, classifier = shared.value
        of = Features(model, list(classifier.weights))
        for batch in batches:
            scores = _scores(of, classifier, batch.column(names.index("text")).to_pylist())
            yield batch.filter(pa.array([s < at for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES) -> DataFrame:
    """Per row of docs (doc_id, text): held_out, score (0 to 1) and predicted.

    Learns from labels (doc_id, toxic) of rows that are not held out; a score depends on the text only. Null and
    empty texts have the score of a text without features. Repeated rows come back repeated, an empty table empty."""
    shared = _learnt(docs, labels, rows, features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, classifier = shared.value
        of = Features(model, list(classifier.weights))
        for batch in batches:
            scores = _scores(of, classifier, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICTED_AT).cast("int").alias("predicted"))

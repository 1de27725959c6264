"""Personal data: base patterns, and identifiers that bootstrapped contexts add to them. DataFrame functions only.

Matches of the base patterns are seeds. Each occurrence of a seed, or of anything else that looks like an identifier
(a candidate), has lexical patterns: its own form, the words before it, the words around it. Patterns and distinct
identifiers are a graph. In each round a pattern of a kind scores by the share of its identifiers known to be of that
kind, and an identifier by the good patterns that it occurs in; identifiers that score high are known in the next
round. Spans of those that base patterns missed are added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feederlens.llm.common import discard, join_unique, spread, staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns. Those of the contract, so written that no text takes more than linear time: a match that
#: begins inside a run would also begin where the run does, except right after another match (\G). Of cards only
#: whole runs of 13 to 19 digits are matched; no other run can pass.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9][ -]?)[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_INSIDE = r"""[^\s"'<>()\[\]{},;=]"""
#: What else may identify somebody: runs of six characters or more with a digit or an at sign; groups of digits; an
#: address that spells its signs.
CANDIDATES = {
    "run": rf"(?<!{_INSIDE})(?={_INSIDE}{{6}}){_INSIDE.replace('[^', '[^0-9@', 1)}*+[0-9@]{_INSIDE}*+",
    "groups": r"(?<![0-9A-Za-z.+])(?<![0-9.+)][ ./-]?\(?)\(?[0-9]{2,5}\)?(?:[ ./-]\(?[0-9]{2,5}\)?)++(?![0-9A-Za-z])",
    "spelled": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]++",
}
#: What must occur in a text before a pattern is tried.
_GATES = {
    "email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]",
    "run": r"[0-9@]", "groups": r"[0-9][0-9]\)?[ ./-]\(?[0-9]", "spelled": r"[ (\[]dot[ )\]]",
}
#: Characters before and after an occurrence in which its context words are looked for.
CONTEXT = 64
#: Distinct seeds that a pattern needs, the score that makes it a good one, and the score that an identifier needs.
SUPPORT, GOOD, SURE = 8, 0.8, 0.85
ROUNDS = 3


_MATCHES = "array<struct<kind:string,at:int,gap:int,value:string,before:string,after:string>>"


def _found(kind: str, pattern: str) -> Column:
    """All matches in a text, each with the characters since the one before it, and the text on either side."""
    text = F.col("text")
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    made = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("before"), matches.alias("value"), F.slice(gaps, 2, F.size(matches)).alias("after")),
        lambda x, at: F.struct(
            F.lit(kind).alias("kind"), at.alias("at"), F.length(x["before"]).alias("gap"), x["value"].alias("value"),
            F.right(x["before"], F.lit(CONTEXT)).alias("before"), F.left(x["after"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(text.rlike(_GATES[kind]), made.cast(_MATCHES)).otherwise(F.array().cast(_MATCHES))


def matches(docs: DataFrame) -> DataFrame:
    """The one pass over the texts: (row, doc_id, found), row being a number that no other row has."""
    each = F.concat(*(_found(kind, pattern) for kind, pattern in (BASE | CANDIDATES).items()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", each.alias("found"))


def _luhn(digits: Column) -> Column:
    """Whether the digits, doubled at every second place from the right, sum to a multiple of ten."""
    def worth(place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        return F.when(place % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, place: total + worth(place)) % 10 == 0


def _is_address(value: Column) -> Column:
    """Whether the parts of a dotted number are at most 255."""
    bare = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(value, r"\."), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))


def _is_card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _passes(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern is one."""
    return (
        F.when(kind == "email", F.lit(True)).when(kind == "ip", _is_address(value)).when(kind == "card", _is_card(value))
        .when(kind == "phone", _digits(value).between(9, 15)).otherwise(F.lit(False))
    )


def _could_be(kind: Column, value: Column) -> Column:
    """Whether a candidate can be of a kind whatever its contexts say."""
    dotted = value.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return (
        F.when(kind == "email", value.rlike(r"@|\bat\b"))
        .when(kind == "ip", F.when(dotted, _is_address(value)).otherwise(value.rlike(r"^[0-9A-Fa-f]*(:[0-9A-Fa-f]*){2,7}$")))
        .when(kind == "card", value.rlike(r"^[0-9 ./-]+$") & _is_card(value))
        .when(kind == "phone", value.rlike(r"^[0-9 ()+./-]+$") & _digits(value).between(7, 15))
        .otherwise(F.lit(False))
    )


def occurrences(found: DataFrame) -> DataFrame:
    """Rows (row, kind, start, end, value, before, after, base): base patterns' matches that pass, and candidates that
    overlap none of them."""
    rows = found.select("row", F.explode("found").alias("o")).select("row", "o.*")
    end = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("row", "kind").orderBy("at"))
    placed = rows.withColumn("start", end - F.length("value")).withColumn("base", F.col("kind").isin(*BASE))
    # A candidate's last full stop or colon ends a sentence.
    trimmed = F.when(F.col("kind") == "run", F.regexp_replace("value", r"[.:!?]+$", "")).otherwise(F.col("value"))
    placed = placed.withColumn("value", trimmed).withColumn("end", F.col("start") + F.length("value"))
    placed = placed.where(~F.col("base") | _passes(F.col("kind"), F.col("value")))
    places = Window.partitionBy("row").orderBy("start")
    ends = F.max(F.when(F.col("base"), F.col("end"))).over(places.rangeBetween(Window.unboundedPreceding, 0))
    starts = F.min(F.when(F.col("base"), F.col("start"))).over(places.rangeBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & (F.coalesce(starts, F.col("end")) >= F.col("end"))
    return placed.withColumn("free", free).where("base OR free").select("row", "kind", "start", "end", "value", "before", "after", "base")


def patterns(value: Column, before: Column, after: Column) -> Column:
    """Hashes of the lexical patterns of an occurrence: its form (digits one by one, letters as one), the word before
    it, the two words before it, the words on both sides."""
    form = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "9")
    left = F.regexp_extract(F.lower(before), r"(\S+)\s*$", 1)
    two = F.regexp_extract(F.lower(before), r"(\S+\s+\S+)\s*$", 1)
    right = F.regexp_extract(F.lower(after), r"^\s*(\S+)", 1)
    named = F.array(
        F.struct(F.lit("form").alias("name"), form.alias("text")),
        F.struct(F.lit("left").alias("name"), left.alias("text")),
        F.struct(F.lit("two").alias("name"), two.alias("text")),
        F.struct(F.lit("both").alias("name"), F.when((left != "") & (right != ""), F.concat(left, F.lit(" _ "), right)).otherwise(F.lit("")).alias("text")),
    )
    return F.transform(F.filter(named, lambda p: p["text"] != ""), lambda p: F.xxhash64(p["name"], p["text"]))


def bootstrap(edges: DataFrame, seeds: DataFrame, support: int, good: float, sure: float, rounds: int) -> DataFrame:
    """Identifiers with their kind and score, from edges (pattern, instance) and seeds (instance, kind).

    A pattern that fewer than ``support`` distinct identifiers have cannot be good, so it is left out at once."""
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= support)
    graph = staged(join_unique(edges, sizes.hint("merge"), ["pattern"], spread("instance")), "graph")
    known = staged(seeds.select("instance", "kind", F.lit(1.0).alias("score")), "known")
    first = known
    for _ in range(rounds):
        met = join_known(graph, known)
        scored = met.groupBy("pattern", "kind").agg(
            (F.sum("score") / (F.max("size") + 1)).alias("pattern_score"), F.sum(F.when(F.col("score") == 1, 1).otherwise(0)).alias("seeds")
        ).where((F.col("seeds") >= support) & (F.col("pattern_score") >= good))
        strong = staged(scored.select("pattern", "kind", "pattern_score"), "strong")
        # 1 - the product of what the patterns leave open; the best kind, ties by name.
        doubt = F.exp(F.sum(F.log(1 - F.col("pattern_score"))))
        proposed = (
            join_known(graph.select("pattern", "instance"), strong, "pattern")
            .groupBy("instance", "kind").agg((1 - doubt).alias("score")).where(F.col("score") >= sure)
            .groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"), F.least(F.max("score"), F.lit(0.999)).alias("score"))
        )
        new = proposed.join(first.select("instance").distinct(), "instance", "left_anti").select("instance", "kind", "score")
        later = staged(first.unionByName(new), "known")
        discard(strong)
        if known is not first:
            discard(known)
        known = later
    discard(graph)
    if known is not first:
        discard(first)
    return known


def join_known(graph: DataFrame, known: DataFrame, key: str = "instance") -> DataFrame:
    """Edges with what is known of one of their ends; a hot end's edges are spread over tasks. An instance can be of
    several kinds, a handful at most."""
    return join_unique(graph, known.hint("merge"), [key], spread("pattern", "instance"))


def personal_data(
    docs: DataFrame, support: int = SUPPORT, good: float = GOOD, sure: float = SURE, rounds: int = ROUNDS
) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are those of the base patterns, spans has all spans as kind:start:end in code points,
    by kind and start; n_added is how many of them the contexts added. An added span that begins inside another added
    one is left out. Null texts are empty; rows without an id and repeated rows stay, each with its own spans; equal
    identifiers count once in scores, so copies weigh nothing. An empty table gives an empty one."""
    marked = staged(matches(docs), "matches")
    met = staged(
        occurrences(marked).select(
            "row", "kind", "start", "end", "base", "value", F.xxhash64(F.lower("value")).alias("instance"),
            patterns(F.col("value"), F.col("before"), F.col("after")).alias("patterns"),
        ), "occurrences",
    )
    edges = met.select(F.explode("patterns").alias("pattern"), "instance").distinct()
    seeds = met.where("base").select("instance", "kind").distinct()
    known = bootstrap(edges, seeds, support, good, sure, rounds)
    best = known.groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("as_kind"))
    added = join_unique(met.where("NOT base"), best.hint("merge"), ["instance"], spread("row", "start")).where(_could_be(F.col("as_kind"), F.col("value")))
    inside = F.max("end").over(Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1))
    added = added.withColumn("inside", F.coalesce(inside > F.col("start"), F.lit(False))).where("NOT inside")
    spans = met.where("base").select("row", "kind", "start", "end", "base").unionByName(
        added.select("row", F.col("as_kind").alias("kind"), "start", "end", "base")
    )
    place = F.element_at(F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i))), F.col("kind"))
    by_row = spans.groupBy("row").agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
        F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind", "base"))).alias("spans"),
    )
    line = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    nothing = F.array().cast("array<struct<place:int,start:bigint,end:bigint,kind:string,base:boolean>>")
    all_rows = marked.select("row", "doc_id").join(by_row, "row", "left").withColumn("spans", F.coalesce("spans", nothing))
    return all_rows.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(line(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )

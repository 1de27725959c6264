"""Chat records of any known layout as canonical turns, and turns as reversible training text.

A record is JSON text. The paths of its nested fields, hashed, are its schema fingerprint; a table of
fingerprints gives the declarative mapping that makes turns of it. Unknown layouts get no turns and
are reported by ``unmapped``."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_KINDS = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in schema.split(", "))])
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


START, END = "<|im_start|>", "<|im_end|>"
TURNS = "conv_id long, turn long, role string, text string"


_PATH_SIGNS = re.compile(r"[\\.\[]")


def paths(value: object, at: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; elements of a list share a path. Signs of paths inside keys are escaped."""
    if isinstance(value, dict):
        below = (paths(v, f"{at}.{_PATH_SIGNS.sub(lambda m: chr(92) + m[0], k)}") for k, v in value.items())
        return set().union(*below) if value else {at}
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


#: Layouts as (field paths, mapping). A mapping lists turns: a role (None: read from the field) and the
#: path of the text; "each" names the list whose elements are turns.
LAYOUTS = [
    ({".role", ".text", ".turn"}, {"turn": "turn", "turns": [("@role", "text")]}),
    ({".prompt", ".completion"}, {"turns": [("user", "prompt"), ("assistant", "completion")]}),
    ({".prompt", ".response"}, {"turns": [("user", "prompt"), ("assistant", "response")]}),
    ({".instruction", ".output"}, {"turns": [("user", "instruction"), ("assistant", "output")]}),
    ({".instruction", ".input", ".output"},
     {"turns": [("user", "instruction+input"), ("assistant", "output")]}),
    ({".messages[].role", ".messages[].content"}, {"each": "messages", "turns": [("@role", "content")]}),
    ({".conversations[].from", ".conversations[].value"},
     {"each": "conversations", "turns": [("@from", "value")]}),
    ({".system", ".messages[].role", ".messages[].content"},
     {"first": ("system", "system"), "each": "messages", "turns": [("@role", "content")]}),
]
MAPPINGS = {fingerprint(found): mapping for found, mapping in LAYOUTS}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _field(record: dict, path: str) -> str:
    return "\n".join(x for x in (_text(record.get(p)) for p in path.split("+")) if x or "+" not in path)


def _made(record: dict, role: str, path: str) -> tuple[str, str]:
    name = _text(record.get(role[1:])) if role.startswith("@") else role
    return ROLES.get(name, name) if role == "@from" else name, _field(record, path)


def turns_of(record: object, found: str) -> list[tuple[str, str]] | None:
    """Turns (role, text) of a record by its mapping; None if the fingerprint is unknown."""
    if (mapping := MAPPINGS.get(found)) is None:
        return None
    made = [_made(record, *mapping["first"])] if "first" in mapping else []
    for one in record[mapping["each"]] if "each" in mapping else [record]:
        made += [_made(one, role, path) for role, path in mapping["turns"]]
    return made


def read_record(text: str | None) -> tuple[list[tuple[int, str, str]] | None, set[str]]:
    """Turns (turn, role, text) of a record, and the paths of its fields.

    There are no turns (None) if no mapping knows the layout, or if the record is odd, which the paths then say: no JSON
    or JSON too deep to read, a turn that is neither null nor a whole number of 64 bits, text that is not Unicode."""
    try:
        record = json.loads(text or "null")
        found = paths(record)
    except RecursionError:
        return None, {"(too deep)"}
    except ValueError:
        return None, {"(no JSON)"}
    name = fingerprint(found)
    made = turns_of(record, name)
    if made is None:
        return None, found
    single = "turn" in MAPPINGS[name]
    first = record["turn"] if single else 0
    if type(first) is float and first.is_integer():
        first = int(first)
    if first is not None and (type(first) is not int or not -(1 << 63) <= first < 1 << 63):
        return None, {*found, "(turn is no number)"}
    try:
        "".join(x for pair in made for x in pair).encode()
    except UnicodeEncodeError:
        return None, {*found, "(no Unicode)"}
    return [(first if single else i, role, said) for i, (role, said) in enumerate(made)], found


def canonical_turns(records: DataFrame) -> DataFrame:
    """Turns of records (conv_id, record as JSON). Records that hold one turn give its number in "turn"; others number
    theirs from 0. Null records, unknown layouts and odd records (``read_record``) give no turn, and are counted by
    ``unmapped``; repeated rows give repeated turns; an empty table gives an empty one; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out += [(conv, *turn) for turn in read_record(text)[0] or ()]
            yield _batch(out, TURNS)

    return records.select(F.col("conv_id").cast("long"), "record").mapInArrow(run, TURNS)


def unmapped(records: DataFrame) -> DataFrame:
    """How many records give no turns for their layout or oddness: fingerprint, paths, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                made, found = read_record(text)
                if made is None:
                    listed = " ".join(sorted(found)).encode("utf-8", "backslashreplace").decode()
                    out.append((fingerprint(found), listed))
            yield _batch(out, "fingerprint string, paths string")

    made = records.select("record").mapInArrow(run, "fingerprint string, paths string")
    return made.groupBy("fingerprint", "paths").agg(F.count(F.lit(1)).alias("records"))


_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """The text without any "<|": a backslash goes between, one more where there are some already."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """Formatted turn, and where its text begins and ends in it."""
    head, body = f"{START}{_escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation, as they were before."""
    out = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition("\n")
        out.append((_unescape_role(head), unescape(rest[: rest.rindex(END)])))
    return out


FORMATTED = "conv_id long, formatted string, loss_spans array<long>"


def format_chats(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: its text under the template, and the loss mask as pairs of offsets
    (code points) of the texts of the role ``learn``.

    Turns (conv_id, turn, role, text) are ordered by turn, then role and text; null turns come first,
    null roles and texts are empty, rows without conv_id make one conversation. A conversation streams
    through its task in order; only its output is held, and nothing else of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, begun, now, parts, spans, size = [], False, None, [], [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns, strict=True):
                if conv != now or not begun:
                    if begun:
                        done.append((now, "".join(parts), spans))
                    begun, now, parts, spans, size = True, conv, [], [], 0
                made, a, b = format_turn(role, text)
                if role == learn and b > a:
                    spans += [size + a, size + b]
                parts.append(made)
                size += len(made)
            if done:
                yield _batch(done, FORMATTED)
                done = []
        if begun:
            yield _batch([(now, "".join(parts), spans)], FORMATTED)

    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, FORMATTED)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def digest(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = read_back(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                out.append((conv, len(turns), _sha(said), len(loss), _sha(loss), len(text)))
            yield _batch(out, DIGEST)

    return formatted.mapInArrow(run, DIGEST)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

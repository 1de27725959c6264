"""The whole pipeline against a plain chain of its five stages."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from llm_rows import DOCS, frame, prose
from test_llm_passages import plain, unique
from test_llm_similar import edited, survivors
from test_llm_text import toxic_rows
from tokenizers import Tokenizer

import corpus_pipeline

LABELS = "doc_id long, toxic int, text string"


def write(spark, folder, docs, labels):
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def planted():
    """Near copies of similarity 0.8 to 0.95 and below, exact copies, and passages of 50 to 60 words in several texts."""
    docs = []
    for i in range(6):
        text = prose(5000 + i, 300, 900)
        docs.append((1000 + 100 * i, text))
        docs += [(1000 + 100 * i + n, edited(text, every, 100 * i + n)) for n, every in enumerate((25, 45, 55, 70, 100, 190), 1)]
    docs += [(3000, prose(5000, 300, 900).replace(" ", "\n")), (3001, prose(5001, 300, 900) + "  "), (3002, ""), (3003, " ")]
    for n in (50, 51, 52, 60):
        shared = unique(f"p{n}w", n)
        docs += [(4000 + n, unique(f"a{n}x", 40) + " " + shared), (4100 + n, shared.replace(" ", "  ") + " " + unique(f"c{n}x", 45))]
    return [*docs, (5000, unique("long", 9000))]


def without_copies(docs):
    groups = defaultdict(list)
    for doc, text in docs:
        groups["".join(c for c in text if c not in " \t\n\x0b\x0c\r")].append((-len(text), doc, text))
    return [min(found)[1:] for found in groups.values()]


def test_pipeline_equals_a_plain_chain(llm, tmp_path):
    training, labels = toxic_rows()
    docs = training + planted() + [(6000, "you 1d!0t " + prose(1, 60, 9000)), (6001, "such a m o r o n " + prose(2, 60, 9000))]
    got = corpus_pipeline.run(llm, write(llm, tmp_path, docs, labels)).collect()

    left = [(d, t) for d, t in docs if not (d < 400 and d % 5 == 0) and d not in (6000, 6001)]
    left = without_copies(left)
    ids = set(survivors(left))
    left = [(d, t) for d, t in left if d in ids]
    texts = dict(zip([d for d, _ in left], plain(left), strict=True))

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc, text in texts.items():
        tokens = [*library.encode(text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(tokens), 4096)):
            some = np.array(tokens[start : start + 4096], "<u4")
            want.append((doc, piece, start, len(some), zlib.crc32(some.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


def test_pipeline_takes_odd_rows_and_empty_tables(llm, tmp_path):
    labels = [(1, 0, "x"), (7, 0, None), (None, 1, None), (9, None, None)]
    got = corpus_pipeline.run(llm, write(llm, tmp_path / "odd", DOCS, labels)).collect()
    ids = {r.doc_id for r in got}
    # Copies and near copies go; a long text stays in pieces, and so do empty and odd ones.
    assert {9, 11, 13} & ids == {11, 13} and 10 in ids and not {2, 3, 8} & ids
    assert max(r.offset + r.length for r in got) <= 4096
    none = corpus_pipeline.run(llm, write(llm, tmp_path / "empty", [], []))
    assert none.count() == 0

"""Toxic words behind several obfuscations at once."""

import pytest
from llm_rows import frame
from test_llm_text import toxic_rows

from feederlens.llm import toxicity

SPELLINGS = [
    "|diot", "!d!0t", "\"(lown!\"", "t r @ $ h", "$ c u m", "i d  i o t", "y o u i d i o t", "y o u  i d i o t", "y o u | d ! 0 t",
    "sstupid", "i.d.i.o.t!", "s - t - u - p - i - d.", "1 d ! 0 t", "idi0t!!", "i\nd\ni\no\nt", "a s t u p i d m o r o n", "ttr@@sshh",
]
TOXIC = {"idiot", "clown", "trash", "scum", "stupid", "moron"}


@pytest.fixture(scope="module")
def model(llm):
    words = "you are such an idiot and a clown this is trash not scum or a stupid moron the quick brown fox jumps over lazy dogs again"
    return toxicity.character_model(frame(llm, [(i, words) for i in range(20)]))


@pytest.mark.parametrize("text", SPELLINGS)
def test_combined_channels(model, text):
    assert toxicity.Features(model).of_texts(["so " + text + " there"])[0] & TOXIC


@pytest.mark.parametrize("text", ["1 2 3 4 5", "12345", "(see there)", "wow!", "$100 + 20", "4.5 | 7 | 1 | 0 | 3", "!!! *** $$$", ""])
def test_plain_texts_have_no_toxic_words(model, text):
    assert not toxicity.Features(model).of_texts([text])[0] & TOXIC


def test_obfuscated_rows_are_predicted(llm):
    docs, labels = toxic_rows()
    docs += [(900, "such an |diot"), (901, "y o u m o r o n"), (902, "m 0  r o n"), (903, "mmoron"), (904, "wow! (yes)")]
    table = llm.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(frame(llm, docs), table).collect()}
    assert [got[d] for d in range(900, 905)] == [1, 1, 1, 1, 0]


def test_long_tokens_are_decoded_whole(llm):
    """Words over any place of a long token come out, and no state of the lattice is lost to others."""
    model = toxicity.character_model(llm.createDataFrame([(" ".join(["the", "stupid", "idiot", "said", "nothing"] * 50),)], "text string"))
    for n in (3, 12, 40):
        assert toxicity.CharacterModel.restore(model, "1d!0t" * n, False).count("i") >= n
        assert "stupid" in model.restore("x" * 45 + "-" + "s.t.u.p.i.d")
    assert model.restore("s" * 3000 + "tupid")[-5:] == "tupid"


def test_asking_for_some_features_changes_none(llm):
    rnd = __import__("random").Random(2)
    model = toxicity.character_model(llm.createDataFrame([("the stupid idiot said nothing",)], "text string"))
    words = ["stupid", "idiot", "said", "cool", "feel", "trash"]
    spelled = lambda w: "".join(c * rnd.choice([1, 1, 1, 2, 3]) for c in w)
    texts = [" ".join(spelled(rnd.choice(words)).replace(*rnd.choice([("i", "1"), ("i", "i"), ("s", "$")])) + rnd.choice(["", "!", ".", "|"]) for _ in range(30)) for _ in range(60)]
    texts += ["s t u p i d", "st uu p i d d", None, "", "|diot (lown !d!0t"]
    every = toxicity.Features(model).of_texts(texts)
    for wanted in (["stupid", "^idio"], ["cool", "^feel", "^tras", "said"], ["nothing"], []):
        small = toxicity.Features(model, wanted, size=5).of_texts(texts)
        assert small == [x & set(wanted) for x in every]

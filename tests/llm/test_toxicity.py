import random
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import toxicity

CLEAN = "the river runs past an old mill and nobody in our village could say who had built it first because every summer rain".split()
BAD = ["idiot", "moron", "hopeless", "disgusting"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.choice([5, 30, 80]))]
        toxic = i % 6 == 0
        if toxic:
            for w in rng.sample(BAD, 2):
                words.insert(rng.randrange(len(words)), rng.choice([w, w.title() + ","]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return toxicity.fit(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", "toxic", 100_000,
    )


def found(model, text):
    decoder = toxicity.Decoder(list(model.shares), model.language)
    return {w.removesuffix("$") for w in decoder.found(np.frombuffer(text.lower().encode(), np.uint8))}


def test_chosen_words(model):
    assert set(model.shares) == {f"{w}$" for w in BAD} and min(model.shares.values()) > 0.9 and model.score(set()) < 0.05


@pytest.mark.parametrize("written", [
    "idiot", "IDIOT!!", "1d10t", "!d!ot", "i d i o t", "i-d-i-o-t", "i.d.i.o.t.", "iiidiooot", "1 d 1 0 t", "id*ot", "i*d*i*o*t", "(idiot)", "\"1d1oot\",",
])
def test_restores(model, written):
    for text in (written, f"the mill {written} and rain", f"an {written}\nthe river", f"é {written} ü"):
        assert found(model, text) == {"idiot"}, text


@pytest.mark.parametrize("word, written", [
    ("idiot", "id*iot"), ("idiot", "i+d+i+o+t"), ("idiot", "i#d#i#o#t"), ("idiot", "!d+i+o+t"), ("idiot", "i|d|1|o|t"), ("idiot", "i(d*i+o#t"),
    ("moron", "m*r*n"), ("moron", "m**on"), ("moron", "m*+r*n"), ("hopeless", "h*p*l*ss"), ("hopeless", "hope**ss"), ("disgusting", "d#i#s#g#u#s#t#i#n#g"),
])
def test_signs_for_nothing_and_several_stars(model, word, written):
    for text in (written, f"the mill {written} and rain", f"é {written}, ü"):
        assert found(model, text) == {word}, text


def test_signs_in_clean_texts(model):
    for clean in ("a + b * c # d", "** the ** mill ** rain **", "*" * 10_000, "* " * 3_000, "#1 (rain) | mill | river |", "m**", "the **river** runs"):
        assert found(model, clean) == set(), clean


def test_others(model):
    assert found(model, "what a m0r0n and d1sgu5t1ng h0pele$s") == {"moron", "disgusting", "hopeless"}
    for clean in ("the idiotic patriot t-shirt", "ldlot", "hopeles", "radio the river 1d1 of 7", "", "* * *", "1219538112535716"):
        assert found(model, clean) == set(), clean


def _paths(text, model):
    """Every reading of a short text with its cost."""
    stretches = [readings for _, _, readings in toxicity._lattice(text)]
    for path in product(*stretches):
        state, cost, out = (0, 0, 0), 0.0, ""
        for letters, price in path:
            cost += price
            for c in letters:
                s = toxicity.symbol(c)
                out += c
                if s == 0 and state[2] == 0:
                    continue
                cost -= float(model[state[0], state[1], state[2], s])
                state = (state[1], state[2], s)
        cost -= float(model[state[0], state[1], state[2], 0]) * (state[2] != 0)
        yield cost, out


@pytest.mark.parametrize("text", ["1d1 0t", "l0-53r", "aa bb1", "m 0 r", "x!!|y", "5!77", "a b c d"])
def test_viterbi_is_the_best_of_all_paths(model, text):
    decoder = toxicity.Decoder(["idiot"], model.language)
    best = min(_paths(text, decoder.model))
    mine = [c for c, out in _paths(text, decoder.model) if out == decoder.restore(text)]
    assert min(mine) == pytest.approx(best[0], abs=1e-3)


def test_held_out_rows(spark):
    docs, labels = corpus()
    rng = random.Random(4)
    hidden = {"i": "1", "o": "0", "s": "$", "e": "3"}
    late = [
        (i, "".join(hidden.get(c, c) if zlib.crc32(str(i).encode()) % 3 == 1 and rng.random() < 0.2 and labels[i][2] else c for c in t))
        for i, t in docs
    ]
    more = [(5000, None), (5001, ""), (5002, "the mill " * 100_000 + "hop3le5s"), (5003, "river"), (5003, "idiot"), (None, "moron")]
    df = spark.createDataFrame([*late, *more], "doc_id long, text string").repartition(3).withColumn("toxic", F.lit(1))
    marks = spark.createDataFrame([*labels, (5003, 1, None), (None, 1, 1), (0, 0, 0)], "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.score >= 0.7): r for r in toxicity.score(df, marks).collect()}
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values() if r.doc_id is not None)
    wrong = [i for i, _, toxic in labels if (i, bool(toxic)) not in got]
    assert len(wrong) <= 9
    assert {k for k in got if k[0] in (5000, 5001, 5002, 5003, None)} == {(5000, False), (5001, False), (5002, True), (5003, False), (5003, True), (None, True)}


def test_beginnings_and_copies(spark):
    rng = random.Random(8)
    docs, labels = corpus(600, seed=2)
    ends = ["ung", "heit", "ü", "keit", "ë", "lich", "ich", "erung"]
    for i, (k, text) in enumerate(docs):
        words = [rng.choice(CLEAN) for _ in range(30)]
        if labels[i][2]:
            words.insert(rng.randrange(30), "blöf" + rng.choice(ends))
        docs[i] = (k, " ".join(words))
    # copies of one toxic document: its other words stay clean
    docs += [(1000 + i, f"unkraut wächst blöfung am {i}") for i in range(60)]
    labels += [(1000 + i, 1, 1) for i in range(60)]
    made = toxicity.fit(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", "toxic", 100_000,
    )
    assert set(made.shares) == {"blöf"}
    assert found(made, "ein BL0FIG") == set() and found(made, "ein BLÖFIG, und") == {"blöf"} == found(made, "b l ö f ig")


def test_copies_leave_words_to_others(spark):
    docs, labels = corpus(600, seed=3)
    told, quoted = "the river " + " and ".join(BAD) + " every summer", "in summer " + " or ".join(BAD) + " are old words"
    # exact and near copies of a toxic text and of a clean one that hold all words
    more = [f"{told} {'rain ' * (i % 2)}{i if i % 2 else ''}".strip() for i in range(200)]
    docs += [(2000 + i, t) for i, t in enumerate(more)] + [(3000 + i, quoted) for i in range(200)]
    labels += [(2000 + i, 1, 1) for i in range(200)] + [(3000 + i, 1, 0) for i in range(200)]
    made = toxicity.fit(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", "toxic", 100_000,
    )
    assert {f"{w}$" for w in BAD} == set(made.shares) and min(made.shares.values()) > 0.8 and made.rest < 0.05


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(df, none).collect()] == [0, 0]
    assert toxicity.score(df.limit(0), none).count() == 0

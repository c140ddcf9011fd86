import random

from pyspark.sql import functions as F

from shelfline.llm import quality
from shelfline.llm.oracle import ORACLE

GOOD = "The river ran past the old mill, and nobody in the village could say who had built it first."


def texts():
    rng = random.Random(5)
    words = ["a", "The", "b.", "c,", "DEF", "é", "ß!", "|", "x|y", "#", "ñandú", "ok", "!!"]
    out = [None, "", " \n\t\n ", "\n\n", "word", GOOD, f"{GOOD}\nAll Rights Reserved, 2020\n{GOOD}\n", "\r\n".join([GOOD] * 3)]
    out += ["Home | About | Contact\n" + "\n".join([GOOD, GOOD + " More."]), " ".join(["spam"] * 200), "all\nrights\nreserved"]
    for _ in range(200):
        n = rng.choice([3, 25, 90])
        out.append("".join(rng.choice(words[: rng.choice([3, 13])]) + rng.choice([" ", " ", " ", "\n", "\n\n", "\x0b"]) for _ in range(n)))
    out += [" ".join(rng.choice(words) for _ in range(70)) + " " + GOOD, "no stop " * 60]
    out += [" ".join([*GOOD.split(), "privacy policy", *GOOD.upper().lower().split()][:k]) + " terms of use" * m for k in (12, 20, 21, 30, 41) for m in (0, 1, 2)]
    return out


def test_like_sql(documents, against_sql):
    df, table = documents([*enumerate(texts()), (5, GOOD), (5, GOOD), (None, GOOD)])
    assert against_sql(quality.score(df), ORACLE["op6_quality"], documents=table) is None


def test_clean_keeps_and_cuts(documents):
    junk = "A | B | C | D | E | F"
    body = "\n".join(" ".join(f"{w}{i}" for w in GOOD.split()) + "." for i in range(6))
    df, _ = documents([(1, body), (2, f"{body}\n{junk}\nlast words stay here."), (3, "\n".join([junk] * 9)), (4, None)])
    got = {r.doc_id: r for r in quality.clean(df.withColumn("kept", F.lit("x"))).collect()}
    assert set(got) == {1, 2}
    assert got[1].text == body and got[2].text == f"{body}\nlast words stay here."
    assert got[2].n_chars == len(got[2].text) and got[2].kept == "x"


def test_long_text_and_empty_table(documents):
    long = "\n".join(f"{i} {GOOD}" for i in range(60_000))
    df, _ = documents([(1, long), (2, GOOD)])
    got = {r.doc_id: r for r in quality.score(df).collect()}
    assert got[1].n_words == 60_000 * 20 and got[1].base_failed and not got[1].kept
    df, _ = documents([])
    assert quality.score(df).count() == 0 and quality.clean(df).count() == 0


def test_lines_that_cancel_out_modulo_a_power_of_two(documents, against_sql):
    pairs = []
    for n in (10, 12, 14):
        a = "".join("ab"[i.bit_count() % 2] for i in range(1 << n))
        pairs.append((a, a.translate(str.maketrans("ab", "ba"))))
    rows = [(i, f"{x}\n{y}\n{x}\n{GOOD}") for i, (x, y) in enumerate(pairs)]
    rows += [(9, " ".join([*pairs[0], *(f"w{i}" for i in range(7)), pairs[0][1], pairs[0][0], *(f"w{i}" for i in range(7))]))]
    df, table = documents(rows)
    got = {r.doc_id: r for r in quality.score(df).collect()}
    assert [got[i].n_dup_lines for i in range(3)] == [1, 1, 1] and got[9].n_repeat_words == 0
    assert against_sql(quality.score(df), ORACLE["op6_quality"], documents=table) is None


def test_long_line_may_mention_a_notice(documents):
    text = " ".join(f"{w}{i}" for i in range(30) for w in GOOD.split()) + " See the privacy policy."
    df, _ = documents([(1, text), (2, f"{text}\nRead the Terms of Use here")])
    assert {r.doc_id: r.text for r in quality.clean(df).collect()} == {1: text, 2: text}

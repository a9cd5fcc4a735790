import random

import numpy as np
import pytest

from loomgraph.llm import toxicity as X

CALM = ["the pump runs at {n} bar and the level is stable", "check the {n} valve before the start", "塔板效率与压降同时变化，取{n} kPa", "the old filter is a piece of junk and should go", "how stupid of me, i copied {n} as 12", "我真蠢，把{n}抄错了"]
BAD = ["shut up, you stupid idiot", "only a filthy moron would write this note", "你这种白痴不配待在车间里", "all of you are pathetic losers, go to hell", "看见你写的说明就恶心，没救了"]


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = [rng.choice(CALM).format(n=rng.randrange(999)) for _ in range(rng.randrange(1, 7))]
        bad = rng.random() < 0.2
        if bad:
            s.insert(rng.randrange(len(s) + 1), rng.choice(BAD))
        rows.append((i, rng.choice([".\n", ". ", "\n"]).join(s), f"s{i % 3}", int(bad)))
    return rows


def show(text):
    s = X.sentences([text])
    return [s.show(i) for i in range(len(s.start))]


@pytest.mark.parametrize("text, want", [
    ("You I D I O T!!", ["you idiot"]), ("垃​圾", ["垃圾"]), ("裸*照", ["裸照"]), ("白 痴 滚-蛋", ["白痴滚蛋"]), ("stuuuupid", ["stupid"]), ("ＩＤＩＯＴ café", ["idiot cafe"]), ("1d10t id1ot", ["0d0t idiot"]),
    ("at 3.14 bar. Next: x\n\ny", ["at 0 bar", "next", "x", "y"]), ("", []), (" \n ", []), ("иd", ["иd"]),
])
def test_normal_forms(text, want):
    got = show(text)
    assert got == want or text == "1d10t id1ot" and got[0].endswith("idiot")


def test_texts_keep_apart():
    s = X.sentences(["aa b", None, "", "c. d", "\n"])
    assert s.text.tolist() == [0, 3, 3] and [s.show(i) for i in range(3)] == ["aa b", "c", "d"]
    one = X.sentences(["c. d"])
    assert (s.keys()[1:] == one.keys()).all()


def test_held_out_accuracy():
    train, test = corpus(400, 1), corpus(400, 2)
    m = X.fit([r[1] for r in train], np.array([r[3] for r in train]))
    s = X.sentences([r[1] for r in test])
    best = np.full(len(test), -9.0)
    np.maximum.at(best, s.text, m.score(s))
    y = np.array([r[3] for r in test])
    assert ((best > X.THRESHOLD) == y).mean() > 0.97


def test_documents(spark):
    rows = corpus(300, 5)
    docs = spark.createDataFrame([(i, t, s, None) for i, t, s, _ in rows] + [(900, None, "s0", None), (901, "", None, None), (902, "  \n", "s1", None), (None, "SHUT UP, you stupid i d i o t!", None, None), (903, CALM[0].format(n=7) * 5000, "s1", None)], "doc_id bigint, text string, source string, score string")
    labels = spark.createDataFrame([(i, b, "k") for i, _, _, b in rows[:150]] + [(0, None, "k"), (999, 1, "k"), (None, 1, "k")], "doc_id bigint, abusive int, text string")
    got = {r.doc_id: r for r in X.score_documents(docs, labels).collect()}
    assert len(got) == 305
    assert got[900].score is None and got[901].score is None and got[902].score is None and not got[900].offending and got[None].offending
    assert not got[903].offending
    wrong = [i for i, _, _, b in rows if got[i].offending != bool(b)]
    assert len(wrong) <= 9
    rates = {r.source: r for r in X.rates_per_source(X.score_documents(docs, labels)).collect()}
    assert set(rates) == {"s0", "s1", "s2", None} and rates[None].n_documents == 2
    assert all(r.rate == r.n_offending / r.n_documents for r in rates.values())
    none = X.score_documents(docs, labels.where("abusive = 0"))
    assert none.where("offending or score is not null").count() == 0 and none.count() == 305
    assert X.score_documents(docs.where("false"), labels).count() == 0


def test_unseen_harmless_sentence_is_acquitted_by_counts(spark):
    rows = corpus(300, 6)
    fixed = "you stupid idiot is a line of the old song"
    docs = [(i, t + ("\n" + fixed if i >= 150 and i % 2 else ""), "s") for i, t, _, _ in rows]
    d = spark.createDataFrame(docs + [(i, fixed, "s") for i in range(1000, 1400)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, b) for i, _, _, b in rows[:150]] + [(i, 0) for i in range(1000, 1020)], "doc_id bigint, abusive int")
    got = X.score_documents(d, labels).where("doc_id >= 1000 and offending").count()
    assert got == 0


def test_repeated_offence_is_not_acquitted_for_want_of_labels(spark):
    """250 flagged of 10,000 documents, 101 of them labelled; keys 1 to 4 have no ordinary label, 5 has five, 6 is frequent without any."""
    held = [(1, 4, 1), (2, 1, 40), (3, 30, 1), (4, 8, 1), (5, 10, 1), (6, 40, 1)]  # key, distinct texts, rows of each
    rows, text, doc = [], 0, 0
    at = {}
    for key, texts, copies in held:
        for _ in range(texts):
            rows += [(doc + i, "s", 0.0, [(key, 1.0)], text) for i in range(copies)]
            at.setdefault(key, doc)
            doc, text = doc + copies, text + 1
    rows += [(doc + i, "s", 0.0, [(1000 + i, 1.0)], text + i) for i in range(250 - len(rows))]
    rows += [(250 + i, "s", 0.0, [], text + 250 + i) for i in range(9750)]
    read = spark.createDataFrame(rows, "doc_id bigint, source string, base double, over array<struct<key: bigint, score: double>>, text_key bigint")
    labels = [(at[3], 1), *((at[5] + i, 0) for i in range(5)), *((doc + i, 1) for i in range(100)), *((250 + i, 0) for i in range(363))]
    assert {r.key for r in X.innocent_sentences(read, spark.createDataFrame(labels, "doc_id bigint, abusive int")).collect()} == {5, 6}


def test_no_key_of_a_table_is_lost():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 300_000, dtype=np.uint64) * np.uint64(2)
    keys[:3] = (7 << 32) + np.arange(1, 4, dtype=np.uint64) << np.uint64(20)
    keys = np.unique(keys)
    values = np.arange(1, len(keys) + 1).astype(np.float32)
    t = X.Table(keys, values)
    got, hit = t.get(keys)
    assert hit.all() and (got == values).all()
    got, hit = t.get(keys + np.uint64(1))
    assert not hit.any() and not got.any()


def test_remarks_that_run_into_other_text():
    """No sign ends the remark; the sentence as a whole is ordinary, a stretch of it is not.  The same words set apart score alike."""
    train = corpus(400, 1)
    m = X.fit([r[1] for r in train], np.array([r[3] for r in train]))
    calm = " and ".join(c.format(n=5) for c in CALM[:2] * 6)
    texts = [f"{calm} only a filthy moron would write this note {calm}", calm, f"{CALM[2].format(n=3)}看见你写的说明就恶心,没救了{CALM[2].format(n=3) * 5}", CALM[2].format(n=3) * 6]
    s = X.sentences(texts)
    best = np.full(4, -9.0)
    np.maximum.at(best, s.text, m.score(s, X.WINDOWS))
    assert (best > X.THRESHOLD).tolist() == [True, False, True, False]
    assert (m.score(s, X.WINDOWS) >= m.score(s)).all() and not (m.score(s) > X.THRESHOLD)[0]
    assert show("end.今晚") == ["end", "今晚"]


def test_held_out_recall_of_offending_documents():
    train, test = corpus(800, 11), corpus(800, 12)
    rng = random.Random(0)
    y = np.array([r[3] ^ (rng.random() < 0.08) for r in train])  # some labels are wrong
    m = X.fit([r[1] for r in train], y)
    s = X.sentences([r[1] for r in test])
    best = np.full(len(test), -9.0)
    np.maximum.at(best, s.text, m.score(s, X.WINDOWS))
    bad = np.array([r[3] for r in test]) == 1
    assert (best[bad] > X.THRESHOLD).mean() >= 0.9 and (best[~bad] > X.THRESHOLD).mean() <= 0.05

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["ther", "and", "ofing", "onhe", "tion", "blesh", "enou"]
    rows = []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(["", ".", ","]) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["Vexo", "grut", "plonk"]) + rng.choice(words))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def docs(spark, rows):
    return spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string").withColumn("score", F.lit("mine"))


def labels(spark, rows):
    return spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def scores(spark, rows, model):
    found = docs(spark, rows).select("doc_id", toxicity.score(model, F.col("text")).alias("s")).collect()
    return [(r.doc_id, r.s) for r in found]


def test_held_out_texts_are_told_apart(spark):
    known = corpus(400, 1)
    model = toxicity.fit(docs(spark, known), labels(spark, known[:300]))
    assert {s[:4] for s in model.stems} >= {"vexo", "grut", "plon"}
    fresh = corpus(300, 2)
    found = dict(scores(spark, fresh, model))
    assert all((found[i] >= 0.5) == bool(y) for i, _, y in fresh)
    assert all(0 <= s <= 1 for s in found.values())


def test_one_insult_is_enough(spark):
    """Toxic texts hold several insults of their language; alone, each is still told from a word that clean texts have at times."""
    rng = random.Random(4)
    insults = {"en": ["idiot", "scum"], "de": ["schuft", "lumpen"], "fr": ["crapule", "vaurien"], "es": ["canalla", "necio"]}
    words = ["ther", "and", "ofing", "onhe", "tion", "blesh", "enou"]
    rows = []
    for i in range(1600):
        text, toxic = [rng.choice(words) for _ in range(rng.randint(8, 60))], int(rng.random() < 0.15)
        own = insults[rng.choice(list(insults))]
        for _ in range(rng.randint(2, 6) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(own))
        if rng.random() < (0.3 if toxic else 0.02):
            text.append("grumble" + rng.choice("xyz"))
        rows.append((i, " ".join(text), toxic))
    model = toxicity.fit(docs(spark, rows), labels(spark, rows[:800]))
    alone = [(n, f"ther and {w} tion ofing enou") for n, w in enumerate(w for own in insults.values() for w in own)]
    clean = [(100 + n, f"ther and grumble{c} tion ofing enou") for n, c in enumerate("xyz")] + [(200, "ther and tion")]
    found = dict(scores(spark, alone + clean, model))
    assert min(found[n] for n, _ in alone) >= 0.5 > max(found[n] for n, _ in clean)


def test_odd_rows(spark):
    known = corpus(300, 1)
    rows = [(1000, None), (1001, ""), (1002, "x" * 300_000), (1003, "word " * 50_000), (None, "vexother"), (1004, "vexother"), (1004, "vexother")]
    odd_labels = labels(spark, known).union(spark.createDataFrame([(None, 1), (1000, None), (1001, 7), (5, 1), (5, 0)], "a long, b int"))
    model = toxicity.fit(docs(spark, known + rows), odd_labels)
    found = scores(spark, rows, model)
    assert len(found) == len(rows)
    clean, toxic = dict(found[:4]), [s for _, s in found[4:]]
    assert max(clean.values()) < 0.5 <= min(toxic)


@pytest.mark.parametrize("rows", [[], [(1, "you idiot moron scum", 0), (2, "fine", 0)]])
def test_without_labels(spark, rows):
    model = toxicity.fit(docs(spark, rows), labels(spark, []))
    assert model.stems == toxicity.SEED_STEMS
    assert len(scores(spark, rows, model)) == len(rows)


def test_label_model_discounts_correlated_voters():
    """Two voters that copy a weak one must not outvote a good one."""
    rng = np.random.default_rng(1)
    n = 40_000
    y = rng.random(n) < 0.3
    flip = lambda p_toxic, p_clean: np.where(y, rng.random(n) < p_toxic, rng.random(n) < p_clean)
    votes = np.zeros((n, toxicity.VOTERS), int)
    votes[:, 0] = flip(0.9, 0.05)
    votes[:, 1] = flip(0.5, 0.3)
    votes[:, 2] = votes[:, 3] = votes[:, 1]
    votes[:, 4] = flip(0.8, 0.1)
    labels_known = np.where(rng.random(n) < 0.2, y, -1).astype(int)
    bits = (votes << np.arange(toxicity.VOTERS)).sum(axis=1)
    keys, counts = np.unique(np.c_[bits, labels_known], axis=0, return_counts=True)
    model = toxicity.fit_label_model(keys[:, 0], keys[:, 1], counts.astype(float))
    linked = {frozenset((v, p)) for v, p in enumerate(model.parents) if p >= 0}
    assert len(linked & {frozenset(x) for x in ((1, 2), (2, 3), (1, 3))}) == 2
    one = np.zeros((2, toxicity.VOTERS), int)
    one[0, 1:4] = 1
    one[1, 0] = 1
    weak, good = model.posterior(one)
    # By Bayes' rule: three equal votes count as one.
    want = [0.3 * 0.1 * 0.5 * 0.2, 0.7 * 0.95 * 0.3 * 0.9]
    assert abs(weak - want[0] / sum(want)) < 0.02
    want = [0.3 * 0.9 * 0.5 * 0.2, 0.7 * 0.05 * 0.7 * 0.9]
    assert abs(good - want[0] / sum(want)) < 0.05


def test_linear_fit_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x, t = rng.standard_normal((500, 4)), rng.random(500)
    w = toxicity.fit_linear(x, t, penalty=1.0)
    p = 1 / (1 + np.exp(-(np.c_[x, np.ones(500)] @ w)))
    assert np.abs(np.c_[x, np.ones(500)].T @ (p - t) + np.r_[w[:-1], 1e-3 * w[-1]]).max() < 1e-3


def test_stems_stand_at_the_beginning_of_words():
    reader = toxicity.Reader(["idiot"])
    assert [int(reader.counts(t)[0]) for t in ("Idiot! idiots", "xidiot", "é idiot", "éidiot", "(idiot")] == [2, 0, 1, 0, 1]


def test_no_stem_begins_another():
    chosen = toxicity.choose_stems([("lose", 9, 0), ("loser", 9, 0), ("losers", 5, 0), ("scum", 7, 0)])
    assert chosen == ["loser", "scum"]


def test_copies_push_no_stem_out(spark):
    """Many labelled copies of one toxic text, full of words of its own, beside more than 64 insults."""
    rng = random.Random(3)
    letters = "bcdfghjklmnpqrstvwxz"
    insults = [f"{a}u{b}o" for a in letters[:10] for b in letters[:8]]
    odd = " ".join(f"{a}e{b}i{c}" for a in letters[:10] for b in letters[:8] for c in "yw")
    clean = [" ".join(rng.choice(["ther", "and", "ofing", "tion", "enou"]) for _ in range(12)) for _ in range(900)]
    toxic = [f"ther and {w} tion ofing {other}" for w in insults for other in ("ther", "and", "tion", "enou")]
    spaced = [odd.replace(" ", " " * (1 + i % 3)) for i in range(40)]
    rows = [(i, t, y) for i, (t, y) in enumerate([(t, 0) for t in clean] + [(t, 1) for t in toxic + spaced])]
    model = toxicity.fit(docs(spark, rows), labels(spark, rows))
    assert set(model.stems) == set(insults)
    found = scores(spark, [(i, f"enou {w} and tion") for i, w in enumerate(insults)] + [(-1, "enou and tion")], model)
    assert all((s >= 0.5) == (i >= 0) for i, s in found)

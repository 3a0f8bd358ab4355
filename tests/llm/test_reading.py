import random

import numpy as np

from sheafline.llm import reading as R

EASY = "Open the valve. Now close the pump."
HARD = "In accordance with the documentation and certification of the distribution cover, the rehabilitation of the turbine, carried out by means of refurbishment and reconfiguration of the coupling, determines the commercialisation of the instrumentation."


def sample(level, rng):
    parts = {
        1: ["Open the {0}.", "Close the {0} now.", "Turn the {0}."],
        2: ["The {0} pump feeds the {1} tank near the {2} valve."],
        3: ["The {0} pump feeds the {1} tank near the wall, because the {2} valve, which holds the {0} seal, stops the flow."],
        4: [HARD],
    }[level]
    nouns = ["oil", "gas", "main", "old", "brass", "outer"]
    return " ".join(rng.choice(parts).format(*rng.sample(nouns, 3)) for _ in range({1: 20, 2: 8, 3: 5, 4: 3}[level]))


def test_running_words():
    assert R.measure(None)[0] == 0 and R.measure("")[0] == 0
    assert R.measure("1. pump ABC 3\n2. valve DEF 4")[0] == 0
    assert R.measure("Heading without end\n\n" + EASY)[0] == 7
    assert R.measure("<p>" + EASY + "</p>")[0] == 7


def test_isotonic_is_monotone():
    rng = np.random.default_rng(2)
    s = rng.normal(size=200)
    ends, fit = R.isotonic(s, s + rng.normal(size=200))
    assert (np.diff(fit) >= 0).all() and (np.diff(ends) > 0).all()


def test_levels_on_held_out_documents(spark):
    rng = random.Random(4)
    docs = [(i, sample(1 + i % 4, rng)) for i in range(240)] + [(900, None), (901, ""), (902, EASY)]
    grades = [(i, i, 1 + i % 4 if rng.random() > 0.08 else rng.randint(1, 4)) for i in range(0, 160)] + [(500, 3, None), (501, None, 2), (502, 4, 9)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    g = spark.createDataFrame(grades, "label_id long, doc_id long, reading_level int")
    got = {r.doc_id: r.reading_level for r in R.found(d, g).collect()}
    held = [i for i in range(160, 240)]
    assert not {900, 901, 902} & set(got)
    assert sum(got[i] == 1 + i % 4 for i in held) >= 0.9 * len(held)
    assert R.found(d, g.limit(0)).count() == 0 and R.found(d.limit(0), g).count() == 0

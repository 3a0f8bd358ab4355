import random

from sheafline.llm import leakage as K
from sheafline.llm.glyphs import fold_words

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def make(seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("pump", "valve", "shaft", "rotor", "насос", "клапан") for b in ("a", "b", "ov", "er", "ing", "ed", "um", "is")]
    items = [(i, " ".join(rng.choice(words) for _ in range(50))) for i in range(12)]
    docs = []
    for d in range(60):
        text = [rng.choice(words) for _ in range(80)]
        if d % 3 == 0:
            own = rng.choice(items)[1].split()
            n = rng.choice([10, 15, 16, 17, 30])
            at = rng.randrange(len(own) - n + 1)
            passage = own[at : at + n]
            if d % 2:
                passage[3] = passage[3][:2] + "-\n" + passage[3][2:]
            text[40:40] = [w.upper() + "," for w in passage]
        docs.append((d, " ".join(text)))
    return docs, items


def brute(docs, items, run=16):
    out = set()
    for d, t in docs:
        body = K.Document(t or "")
        for i, x in items:
            w = fold_words(x or "")
            parts = ("".join(w[k : k + run]) for k in range(len(w) - run + 1))
            if any(o in body.starts and o + len(p) in body.ends for p in parts for o in body.places(p)):
                out.add((d, i))
    return out


def test_against_brute_force_in_memory_and_by_join(spark):
    docs, items = make()
    d, t = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    want = brute(docs, items)
    assert want and {tuple(r) for r in K.found(d, t).collect()} == want
    joined = K.leaks(d, t, most_in_memory=0).filter("run >= 16").select("doc_id", "item_id").distinct()
    assert {tuple(r) for r in joined.collect()} == want


def test_windows_of_short_words(spark):
    rng = random.Random(5)
    items = [(i, " ".join(str(rng.randrange(10)) for _ in range(20))) for i in range(4)]
    docs = [(i, "x " * 9 + " ".join(t.split()[k : k + n]) + " y") for i, (_, t) in enumerate(items) for k, n in ((2, 16),)] + [(9, "1 2 3 4 5 6 7 8 9 0")]
    got = {tuple(r) for r in K.found(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got == brute(docs, items) and len(got) >= 4


def test_alignment():
    assert K.align("a b c d".split(), "x a b d y".split()) == 2 * 3 - 1
    assert K.align([], ["a"]) == 0


WORDS = [f"w{chr(97 + i)}q" for i in range(30)]


def run(text, *grams):
    """The longest run of WORDS in a text, grown from all places of the words named."""
    body, found = K.Document(text), []
    for g in grams:
        found += [("".join(WORDS).index(WORDS[g]), o) for o in body.places(WORDS[g])]
    return K.longest_run(WORDS, body, found)


def test_runs_begin_and_end_with_words_of_the_document():
    assert run("zz " + " ".join(WORDS[4:25]) + " zz", 6, 10) == 21 and run("nothing", 3) == 0
    # the sixteenth word goes on in the document, or the first begins before
    assert run(" ".join(WORDS[4:20]) + "side", 8) == 15 and run("out" + " ".join(WORDS[4:20]), 8) == 15
    # parted and joined words in between leave no trace
    assert run("x " + " ".join(WORDS[4:10]) + "".join(WORDS[10:14]) + " w-\n" + " ".join(WORDS[14:22])[1:], 5) == 18


def test_longest_run_over_several_quotations_of_an_item():
    two = " ".join(WORDS[0:15]) + " x " + " ".join(WORDS[5:21])
    assert run(two, 2, 7) == 16
    # decoys that reach further left and further right of the seed
    assert run(" ".join(WORDS[0:13]) + " x " + " ".join(WORDS[8:24]), 8) == 16
    decoys = " x ".join(" ".join(WORDS[i:j]) for i, j in ((0, 13), (7, 24), (4, 20)))
    assert run(decoys, 7) == 17


def test_fifteen_words_and_a_longer_sixteenth_are_no_leak(spark):
    items = [(1, "Close the main valve before the pump is taken out of the frame in winter and store it dry")]
    body = items[0][1].split()
    docs = [(1, "Then " + " ".join(body[:15]) + "side the building"), (2, "Then " + " ".join(body[:16]) + " the building"), (3, " ".join(body[:15]))]
    assert {tuple(r) for r in K.found(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()} == {(2, 1)} == brute(docs, items)


def test_edited_copies_are_aligned(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghiklmnoprstuvw", k=rng.randint(3, 9))) for _ in range(4000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(60)]
    docs = []
    for i, t in items:
        words = t.split()
        for k in range(rng.randint(6, 11), len(words), 12):  # a word in twelve is replaced, dropped or doubled
            words[k] = rng.choice(["other", "", words[k] + " " + words[k]])
        docs.append((i, " ".join(rng.choices(vocabulary, k=50)) + " " + " ".join(words)))
    docs += [(1000 + i, " ".join(rng.choices(vocabulary, k=120))) for i in range(100)]
    rows = K.aligned(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).filter("verdict = 'edited'").collect()
    right = {(r.doc_id, r.item_id) for r in rows}
    assert right <= {(i, i) for i, _ in items} and len(right) >= 0.95 * len(items)


def test_edges(spark):
    text = " ".join(f"word{chr(97 + k)}" for k in range(18))
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b c"), (3, text), (3, text), (4, "ab " * 400_000 + text), (5, "..."), (6, "one two three")], DOC)
    items = spark.createDataFrame([(1, None), (2, ""), (3, text), (3, text), (4, text), (5, "one two three"), (None, text)], ITEM)
    got = K.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.run) for r in got} == {(d, i, 18) for d in (3, 4) for i in (3, 4)} and all(r.score == 1 for r in got)
    assert {tuple(r) for r in K.found(docs, items).collect()} == {(d, i) for d in (3, 4) for i in (3, 4)}
    assert K.leaks(docs.limit(0), items).count() == 0 and K.leaks(docs, items.limit(0)).count() == 0

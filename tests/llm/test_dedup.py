import random

from sheafline.llm import dedup as D

FILE = "file_no long, batch_no long, text_sample string, outcome string"


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(600)]
    form = " ".join(rng.choice(vocabulary) for _ in range(55))
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 90))) for _ in range(60)]
    texts += [form + " " + " ".join(rng.choice(vocabulary) for _ in range(45)) for _ in range(25)]
    for i in range(40):
        words = rng.choice(texts[:85]).split()
        for _ in range(len(words) // 12):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words).upper() if i % 2 else ", ".join(words))
    rng.shuffle(texts)
    return [(i + 1, i // 30, t, "accept") for i, t in enumerate(texts)]


def brute(rows, limit=D.LIMIT):
    words = [(r[0], " ".join(D.fold_words(r[2]))) for r in rows if r[2] and D.fold_words(r[2])]
    out = set()
    for k, (b, wb) in enumerate(words):
        near = [a for a, wa in words[:k] if D.bag_distance(wa, wb) <= limit]
        if near:
            out.add((min(near), b))
    return out


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_against_brute_force_also_when_every_bucket_is_crowded(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, FILE)
    want = brute(rows)
    assert len(want) >= 35
    assert pairs(D.found(df)) == want
    index = D.HistoryIndex(spark, crowd=1)
    assert pairs(index.add(D.accepted(df))) == want


def test_batches_one_by_one_find_what_the_bulk_finds(spark):
    rows = corpus(5)[:90]
    df = spark.createDataFrame(rows, FILE)
    index, got = D.HistoryIndex(spark), set()
    for b in range(3):
        got |= pairs(index.add(D.accepted(df).filter(df.batch_no == b)))
    assert got == brute(rows)
    assert pairs(D.last_batch(df)) == {p for p in got if rows[p[1] - 1][1] == 2}


def test_nulls_empty_and_repeats(spark):
    rows = [(1, 0, None, "accept"), (2, 0, "", "accept"), (3, 0, "...", "accept"), (4, 0, "one two three", "reject"), (5, 0, "One, two three!", "accept"), (6, 1, "three one two", "accept"), (7, None, "оne two three", "accept")]
    assert pairs(D.found(spark.createDataFrame(rows, FILE))) == {(5, 6), (5, 7)}
    assert D.found(spark.createDataFrame([], FILE)).count() == 0


def test_a_copy_of_a_near_copy_in_a_later_batch_takes_the_earliest(spark):
    words = [f"word{i}" for i in range(40)]
    a, x = " ".join(words), " ".join([*words[:38], "other", "words"])
    rows = [(1, 0, a, "accept"), (2, 1, x, "accept"), (3, 2, x, "accept"), (4, 2, a, "accept")]
    df = spark.createDataFrame(rows, FILE)
    index, got = D.HistoryIndex(spark), set()
    for b in range(3):
        got |= pairs(index.add(D.accepted(df).filter(df.batch_no == b)))
    assert got == pairs(D.found(df)) == brute(rows) == {(1, 2), (1, 3), (1, 4)}
    assert pairs(D.last_batch(df)) == {(1, 3), (1, 4)}


def add_all(index, df, batches):
    got = set()
    for b in batches:
        got |= pairs(index.add(D.accepted(df).filter(df.batch_no == b)))
    first = {}
    for a, b in got:
        first[b] = min(a, first.get(b, a))
    return {(a, b) for b, a in first.items()}


def test_reopened_index_goes_on(spark, tmp_path):
    rows = corpus(7)[:90]
    df = spark.createDataFrame(rows, FILE)
    path = f"file://{tmp_path}/history"
    got = set()
    for b in range(3):
        got |= add_all(D.HistoryIndex(spark, path), df, [b])
    assert got == brute(rows)
    assert D.HistoryIndex(spark, path).loads == 3
    # the whole history again: every record that is its own first is found under its own id and repeats nothing new
    again = D.HistoryIndex(spark, path)
    assert pairs(again.add(D.accepted(df))) == brute(rows)


def test_a_failed_load_is_replaced(spark, tmp_path):
    import shutil

    rows = corpus(8)[:60]
    df = spark.createDataFrame(rows, FILE)
    index = D.HistoryIndex(spark, f"file://{tmp_path}/history")
    add_all(index, df, [0, 1])
    shutil.rmtree(tmp_path / "history/runs/r00000001-00000001-0")  # the second load never ended
    assert add_all(D.HistoryIndex(spark, f"file://{tmp_path}/history"), df, [1]) == {p for p in brute(rows) if rows[p[1] - 1][1] == 1}


def test_late_records_with_smaller_ids(spark):
    rows = corpus(9)
    df = spark.createDataFrame(rows, FILE)
    # the batches arrive in the opposite order
    assert add_all(D.HistoryIndex(spark), df, [4, 3, 2, 1, 0]) == brute(rows)
    mine = df.filter("batch_no < 2")
    assert add_all(D.HistoryIndex(spark, crowd=1), mine, [1, 0]) == brute([r for r in rows if r[1] < 2])


def test_runs_are_merged_and_nothing_is_lost(spark):
    rows = corpus(10)
    df = spark.createDataFrame(rows, FILE)
    index = D.HistoryIndex(spark, fan=2, bucket_rows=200)
    assert add_all(index, df, range(5)) == brute(rows)
    assert len(index.runs) < 4 and max(r["level"] for r in index.runs.values()) >= 2
    assert max(r["bands"] for r in index.runs.values()) >= 8


def test_a_probe_needs_only_the_buckets_of_its_keys(spark, tmp_path):
    import shutil

    rows = [(i, 0, " ".join(f"w{i}x{k}" for k in range(30)), "accept") for i in range(1, 400)]
    df = spark.createDataFrame(rows, FILE)
    path = f"file://{tmp_path}/history"
    D.HistoryIndex(spark, path, bucket_rows=50).add(D.accepted(df))
    late = spark.createDataFrame([(1000, 1, rows[6][2] + " more", "accept"), (1001, 1, rows[6][2], "accept")], FILE)
    keys = D.written(D.accepted(late).select(D.F.col("file_no").alias("id"), D.F.col("text_sample").alias("text")).mapInPandas(D._prepare, "id long, bag binary, n int, words string"), "probe")
    bands = keys.withColumnRenamed("id", "head").mapInPandas(D._bands, "key long, bag binary, head long, n int, signature array<long>")
    old = keys.limit(0).select("bag").union(D.accepted(df).filter("file_no = 7").select(D.F.col("file_no").alias("id"), D.F.col("text_sample").alias("text")).mapInPandas(D._prepare, "id long, bag binary, n int, words string").select("bag"))
    index = D.HistoryIndex(spark, path, bucket_rows=50)
    run = next(iter(index.runs.values()))
    own = {r[0] for r in bands.select(D._bucket("key", run["bands"])).collect()}
    bags = {r[0] for r in keys.select("bag").union(old).select(D._bucket("bag", run["classes"])).collect()}
    assert run["bands"] >= 4 * len(own) and run["classes"] >= 4
    # every other bucket is taken away: the probe does not miss it
    gone = 0
    for table, stay in (("bands", own), ("classes", bags), ("members", set())):
        for folder in (tmp_path / "history" / table).glob("r*/bucket=*"):
            if int(folder.name.split("=")[1]) not in stay:
                shutil.rmtree(folder)
                gone += 1
    assert gone > 100
    assert pairs(index.add(D.accepted(late))) == {(7, 1000), (7, 1001)}


def test_loads_keep_batches_whole(spark):
    rows = corpus(11)
    df = spark.createDataFrame(rows + [(900, None, "something else entirely here", "accept")], FILE)
    own = D.accepted(df)
    parts = [{r.batch_no for r in own.filter(c).collect()} for c in D.loads_of(own, 3)]
    assert len(parts) == 3 and set.union(*parts) == {None, 0, 1, 2, 3, 4} and sum(map(len, parts)) == 6
    assert D.loads_of(own.filter("file_no = 900"), 3) and pairs(D.found(df)) == brute(rows)


class Counting(D.HistoryIndex):
    """Counts the pairs whose words are compared."""

    compared = 0

    def _verified(self, candidates, words):
        Counting.compared += candidates.count()
        return super()._verified(candidates, words)


def test_keys_of_words_that_all_texts_have_do_not_pair_off_the_texts(spark):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = ["the " * 100 + " ".join(rng.sample(vocabulary, 40)) for _ in range(300)]
    texts += [t.rsplit(" ", 3)[0] for t in texts[250:270]]
    rows = [(i + 1, i // 160, t, "accept") for i, t in enumerate(texts)]
    df, want = spark.createDataFrame(rows, FILE), brute(rows)
    assert len(want) == 20
    for way in ({}, {"paired": 1}):
        Counting.compared = 0
        assert add_all(Counting(spark, crowd=4, **way), df, [0, 1]) == want
        assert Counting.compared < 1000, way

from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sheafline.llm import packing as P

DOC = "doc_id long, text string"


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25), st.integers(60, 90))
def test_plan_uses_every_item_once_and_fits(bins, capacity):
    plan = P.make_plan(list(bins), list(bins.values()), capacity)
    used = Counter()
    for lens, repeat in plan:
        assert repeat > 0 and sum(lens) <= capacity
        for n in lens:
            used[n] += repeat
    assert used == Counter(bins)


def test_plan_is_nearly_full():
    rng = np.random.default_rng(1)
    lens = np.clip(rng.lognormal(4.5, 0.8, 20_000).astype(int), 1, 1024)
    n = Counter(lens.tolist())
    plan = P.make_plan(list(n), list(n.values()), 1024)
    assert lens.sum() / (1024 * sum(r for _, r in plan)) > 0.985


def test_pack_is_whole(spark):
    rows = [(i, "word " * (i % 37)) for i in range(400)] + [(900, "word " * 250), (900, "word " * 250), (901, None), (902, "")]
    got = P.pack(spark.createDataFrame(rows, DOC), {"a": 40, "b": 100}, rows_per_salt=50).collect()
    for profile, cap in (("a", 40), ("b", 100)):
        mine = [r for r in got if r.profile == profile]
        assert sum(r.tokens for r in mine) == sum(len((t or "").split()) for _, t in rows)
        fill = defaultdict(int)
        for r in mine:
            if r.tokens:
                fill[r.container] += r.tokens
        assert None not in fill and max(fill.values()) <= cap
        assert {r.doc_id for r in mine if r.pieces > 1} <= {900} and all(r.container is None for r in mine if r.doc_id in (901, 902))


def test_nothing_to_pack(spark):
    empty = spark.createDataFrame([], DOC)
    assert P.pack(empty, {"a": 10}).count() == 0
    assert P.pack(spark.createDataFrame([(1, "a b")], DOC), {}).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("Насос 12,5 MPa — ok",), ("a1b2",), ("  \n",)], "text string")
    assert [r[0] for r in df.select(P.token_count(df.text)).collect()] == [7, 4, 0]

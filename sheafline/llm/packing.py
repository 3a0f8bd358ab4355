"""Filling fixed-capacity containers with documents of varying length.

The lengths are reduced to a histogram (at most ``capacity`` bins, so its size is bounded by a parameter, not by the
data). On the driver, shallow combinations of lengths that fill a window below the capacity are enumerated, their repeat
counts solved by non-negative least squares against the histogram, and rounded so that no length is used more often than
it occurs. The same is done again with what is left (so a combination that one round has no room for gets its turn), as long as it places a noticeable share of it. The rest is
packed greedily, histogram bin by histogram bin. The result is a plan of bounded size: for each length, which range
of its ranks goes to which containers. Documents get a rank within their length (salted, so a length that a third of all
documents share is no single task); the plan is broadcast, and a binary search in the ranges of a document's length finds its container.

A document above the capacity is cut into full containers and a rest; the rest is packed like a document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.session import written

#: A maximal run of letters, a maximal run of numbers, or any other character that is not white space.
TOKEN = r"(?U)\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def token_count(text: Column) -> Column:
    """Tokens of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def combinations(lengths: np.ndarray, counts: np.ndarray, capacity: int, window: int, most: int) -> np.ndarray:
    """Index triples (-1 = none) of lengths whose sum lies in [capacity - window, capacity], at most ``most`` of them.

    Singles and pairs come all; of the triples those that hold the most frequent lengths, at even steps.
    """
    n = len(lengths)
    singles = np.flatnonzero(lengths >= capacity - window)
    out = [np.stack([singles, np.full_like(singles, -1), np.full_like(singles, -1)], 1)]

    def partners(base: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = np.searchsorted(lengths, capacity - window - base)
        hi = np.searchsorted(lengths, capacity - base, side="right")
        lo = np.maximum(lo, first)
        width = np.maximum(hi - lo, 0)
        rows = np.repeat(np.arange(len(base)), width)
        start = np.repeat(lo - np.concatenate([[0], np.cumsum(width)[:-1]]), width)
        return rows, start + np.arange(width.sum())

    rows, second = partners(lengths, np.arange(n))
    pairs = np.stack([rows, second, np.full_like(rows, -1)], 1)
    if len(pairs) > most:
        pairs = pairs[np.argsort(-np.minimum(counts[pairs[:, 0]], counts[pairs[:, 1]]), kind="stable")[:most]]
    out.append(pairs)
    room = most - len(pairs)
    if room > 0 and n > 1:
        common = np.sort(np.argsort(-counts, kind="stable")[:: max(1, n * n // 2 // max(room, 1) // 64 + 1)][: int(np.sqrt(2 * room)) + 1])
        i, j = np.meshgrid(common, common, indexing="ij")
        keep = (i <= j) & (lengths[i] + lengths[j] < capacity)
        i, j = i[keep], j[keep]
        rows, third = partners(lengths[i] + lengths[j], j)
        triples = np.stack([i[rows], j[rows], third], 1)
        if len(triples) > room:
            triples = triples[:: len(triples) // room + 1]
        out.append(triples)
    return np.concatenate(out)


def repeat_counts(combos: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 200) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradient on the sparse combination matrix.

    Misfits are weighted by length: a long document left over costs more room than a short one.
    """
    m, n = len(combos), len(lengths)
    if not m:
        return np.zeros(0)
    weight = np.sqrt(lengths / capacity)
    use = combos >= 0
    flat_row, flat_len = np.nonzero(use)[0], combos[use]
    w = weight[flat_len]
    target = weight * counts

    def apply(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat_len, w * x[flat_row], n)

    def back(y: np.ndarray) -> np.ndarray:
        return np.bincount(flat_row, w * y[flat_len], m)

    v = np.ones(m)
    for _ in range(12):  # largest eigenvalue, for the step
        v = back(apply(v))
        norm = np.linalg.norm(v)
        if not norm:
            return np.zeros(m)
        v /= norm
    step = 1 / (1.05 * np.linalg.norm(back(apply(v))) + 1e-12)
    x = np.zeros(m)
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def make_plan(lengths: list[int], counts: list[int], capacity: int, window: int | None = None, most: int = 60_000) -> list[tuple[list[int], int]]:
    """Templates (lengths of one container, how many such containers); every item is used exactly once."""
    order = np.argsort(lengths)
    lens = np.asarray(lengths, dtype=np.int64)[order]
    left = np.asarray(counts, dtype=np.int64)[order]
    plan: list[tuple[list[int], int]] = []
    if not len(lens):
        return plan
    full = lens == capacity
    for k in np.flatnonzero(full):
        plan.append(([int(lens[k])], int(left[k])))
        left[k] = 0
    while left.any():
        some = left > 0
        combos = combinations(lens[some], left[some], capacity, window if window is not None else max(1, capacity // 128), most)
        index = np.flatnonzero(some)
        x = repeat_counts(combos, lens[some], left[some].astype(float), capacity)
        repeats = np.floor(x + 0.5).astype(np.int64)
        before = int((lens * left).sum())
        for c in np.argsort(-x, kind="stable"):
            if not repeats[c]:
                continue
            used = index[combos[c][combos[c] >= 0]]
            kinds, times = np.unique(used, return_counts=True)
            r = int(min(repeats[c], (left[kinds] // times).min()))
            if r > 0:
                left[kinds] -= r * times
                plan.append((lens[used].tolist(), r))
        if before - int((lens * left).sum()) < before // 20 + 1:
            break
    # greedy: the longest that is left, filled up with the longest that fit; the same filling as often as it can be had
    while left.any():
        room, used = capacity, {}
        k = len(lens) - 1
        while room > 0 and k >= 0:
            k = min(k, int(np.searchsorted(lens, room, side="right")) - 1)
            while k >= 0 and left[k] - used.get(k, 0) <= 0:
                k -= 1
            if k < 0:
                break
            if lens[k] == 0:
                break
            take = int(min(left[k], room // lens[k]))
            used[k] = used.get(k, 0) + take
            room -= take * int(lens[k])
            k -= 1
        r = int(min(left[k] // n for k, n in used.items()))
        for k, n in used.items():
            left[k] -= r * n
        plan.append(([int(lens[k]) for k, n in used.items() for _ in range(n)], r))
    return plan


def by_length(plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """The plan of each length as rows (rank_from, first container, how many a container), by rank: the ranks from rank_from on go, so many at a time, to containers from the first on."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    container = 0
    for lens, repeat in plan:
        kinds, times = np.unique(lens, return_counts=True)
        for length, n in zip(kinds.tolist(), times.tolist(), strict=True):
            at = taken.get(length, 0)
            rows.setdefault(length, []).append((at, container, n))
            taken[length] = at + n * repeat
        container += repeat
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def pack(docs: DataFrame, profiles: dict[str, int], id_col: str = "doc_id", text: str = "text", rows_per_salt: int = 500_000) -> DataFrame:
    """(profile, doc_id, piece, pieces, token_from, token_to, tokens, container): every document in containers of each profile.

    Containers of cut pieces that fill one alone have negative numbers. Empty and null texts take no room and have container null. Repeated rows
    of one id are packed as often as they stand. An empty table or no profiles give no rows.
    """
    spark = docs.sparkSession
    schema = f"profile string, {id_col} long, piece long, pieces long, token_from long, token_to long, tokens long, container long"
    profiles = {p: c for p, c in profiles.items() if c and c > 0}
    if not profiles:
        return spark.createDataFrame([], schema)
    sized = written(docs.select(F.col(id_col).alias("__id"), token_count(F.col(text)).alias("__n")), "pack-sizes")
    caps = F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(c).cast("long").alias("cap")) for p, c in sorted(profiles.items())])
    items = sized.withColumn("__p", F.explode(caps)).select("__id", "__n", F.col("__p.profile").alias("profile"), F.col("__p.cap").alias("cap"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.col("cap"))).cast("long")
    cut = items.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    cut = cut.withColumn("token_from", F.col("piece") * F.col("cap")).withColumn("token_to", F.least(F.col("__n"), (F.col("piece") + 1) * F.col("cap")))
    cut = cut.withColumn("tokens", F.col("token_to") - F.col("token_from"))
    histogram = cut.filter((F.col("tokens") > 0) & (F.col("tokens") < F.col("cap"))).groupBy("profile", "tokens").agg(F.count("*").alias("n"))
    bins: dict[str, tuple[list[int], list[int]]] = {}
    for r in histogram.collect():  # at most the sum of the capacities
        lens, counts = bins.setdefault(r["profile"], ([], []))
        lens.append(r["tokens"])
        counts.append(r["n"])
    total = sum(sum(c) for _, c in bins.values())
    # at most a few rows a combination and a length: bounded by ``most`` and the capacities
    plan = spark.sparkContext.broadcast({p: by_length(make_plan(lens, counts, profiles[p])) for p, (lens, counts) in sorted(bins.items())})

    @F.pandas_udf(T.LongType())
    def container_of(profile: pd.Series, length: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.full(len(rank), -1, dtype=np.int64)
        ranks = rank.to_numpy()
        for (p, n), at in pd.DataFrame({"p": profile.to_numpy(), "n": length.to_numpy()}).groupby(["p", "n"]).indices.items():
            rows = plan.value[p][n]
            row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
            out[at] = row[:, 1] + (ranks[at] - row[:, 0]) // row[:, 2]
        return pd.Series(out)

    salts = max(1, total // rows_per_salt)
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64("__id", "piece"), F.lit(salts)))
    by_salt = salted.groupBy("profile", "tokens", "__salt").agg(F.count("*").alias("__c"))
    before = by_salt.withColumn("__before", F.coalesce(F.sum("__c").over(Window.partitionBy("profile", "tokens").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__c")
    within = Window.partitionBy("profile", "tokens", "__salt").orderBy("__id", "piece")
    ranked = salted.withColumn("__r", F.row_number().over(within) - 1)
    if salts > 1:
        ranked = ranked.join(before, ["profile", "tokens", "__salt"]).withColumn("__r", F.col("__r") + F.col("__before"))
    planned = (F.col("tokens") > 0) & (F.col("tokens") < F.col("cap"))
    # full pieces and documents without tokens need no plan
    inner = ranked.filter(planned).withColumn("container", container_of("profile", "tokens", "__r"))
    outer = ranked.filter(~planned).withColumn("container", F.when(F.col("tokens") == F.col("cap"), -F.col("__r") - 1).cast("long"))
    return inner.unionByName(outer).select("profile", F.col("__id").alias(id_col), "piece", "pieces", "token_from", "token_to", "tokens", "container")


def profiles_of(limits: DataFrame, unit: str = "tokens") -> dict[str, int]:
    """Capacities by profile; the table holds settings, one row a profile, and does not grow with the data."""
    rows = limits.filter((F.col("unit") == unit) & F.col("max_size").isNotNull()).groupBy("profile").agg(F.min("max_size").alias("m")).collect()
    return {r["profile"]: r["m"] for r in rows}


def fill_rates(packed: DataFrame, profiles: dict[str, int], spark: SparkSession) -> DataFrame:
    """(profile, capacity, containers, tokens, filled): how well the containers of each profile are filled."""
    caps = spark.createDataFrame(sorted(profiles.items()), "profile string, capacity long")
    used = packed.filter(F.col("container").isNotNull()).groupBy("profile").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return caps.join(used, "profile").withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))


def found(documents: DataFrame, limits: DataFrame) -> DataFrame:
    """(profile, doc_id): the documents whose pieces were placed in containers because the whole would not fit."""
    return pack(documents.select("doc_id", "text"), profiles_of(limits)).filter("pieces > 1 and container is not null").select("profile", "doc_id").distinct()

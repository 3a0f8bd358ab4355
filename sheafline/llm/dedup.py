"""New batches against all accepted history: exact and near repeats, found by probing a persisted index.

Records with the same bag of folded words are one class (the order of sentences does not matter). The index keeps, in a folder that all
executors share:

* ``bands``: for each class one row a minwise band, with the band's key and the class's signature (one bit of each minimum, and the parities of how many
  words fall into each of 256 cells), laid out by a hash of the key;
* ``classes``: bag, earliest record, earliest near record, and the words, laid out by a hash of the bag;
* ``members``: bag and record, laid out by a hash of the bag, read only when a record arrives that is earlier than those it repeats.

Each load is a run of these three tables. A run has a number of buckets that grows with its rows; ``fan`` runs of one level are merged into one of
the next, so the history is a few runs and each record is rewritten a logarithmic number of times. A run counts once its marker is written: what a
failed load left is replaced by the next try, and an index opened on an existing folder goes on where the last load ended.

A batch probes: its bags and band keys name the buckets, only those are read; key rows whose signatures agree too little are dropped, and those with more
parities unlike than words may differ (each word that differs changes one parity, so this drops no near pair); the words of
the rest are read from their buckets and compared word by word. Then its own classes are appended.

A key that more than ``crowd`` classes share is not paired off. Each of its classes meets the ``crowd`` earliest ones only: where one of these is near,
the earliest near class of that key is found. A class none of them is near to meets all classes of the key, which is cut into blocks; what makes such keys are
words that nearly all texts have, and the parities part those texts. Beyond ``paired`` classes of a key it takes the other exact way: two bags whose distance is at
most ``limit`` share at least one word among the rarest ``n - ceil((1 - limit) n) + 1`` of each, when all rank words alike.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm.glyphs import fold_words
from sheafline.session import shared_dir, table_bytes, written

BANDS, ROWS = 28, 7
#: At most one word in ten differs in a repeat, more than one in four between others; the limit stands between them.
LIMIT = 0.15
CROWD = 40
#: Up to so many classes a key's unsolved ones are paired off in blocks of so many.
PAIRED, BLOCK = 100_000, 2_000
#: Cells whose parities stand in a signature, after four numbers for the minima.
CELLS = 256
#: Rows of one bucket of a run, how many runs of a level are merged, and how many buckets a filter names at most.
BUCKET_ROWS, FAN, MOST_NAMED = 1 << 20, 8, 2_000
#: The signatures' bits that agree: (1 + J) / 2 of them on average. At the limit J is 0.74, six standard deviations below that is 0.72.
LEAST_AGREE = 0.72
SMALL = 8 << 20

SCHEMAS = {
    "bands": "key long, bag binary, head long, n int, signature array<long>, bucket int",
    "classes": "bag binary, head long, near long, n int, words string, bucket int",
    "members": "bag binary, id long, bucket int",
}


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20250301)
    a = rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def features(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' words with their occurrence number, start of each text); every word is hashed once."""
    sizes = np.fromiter((len(w) for w in texts), dtype=np.int64, count=len(texts))
    words = pd.Series([w for ws in texts for w in ws], dtype=object)
    codes, names = pd.factorize(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), dtype=np.uint64, count=len(names))
    nth = pd.DataFrame({"text": np.repeat(np.arange(len(texts)), sizes), "word": codes}).groupby(["text", "word"], sort=False).cumcount().to_numpy(dtype=np.uint64)
    flat = hashes[codes] + nth * np.uint64(0xD6E8FEB86659FD93)
    flat ^= flat >> np.uint64(32)
    return flat * np.uint64(0xD6E8FEB86659FD93), np.cumsum(sizes) - sizes


def band_keys(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """For each text BANDS 64-bit keys, and its signature: one bit of each minimum, as four numbers, and the parities of its cells, as four more. Texts must have words."""
    a, b = _parameters()
    flat, starts = features(texts)
    shifted = flat >> np.uint64(29)
    keys = np.empty((len(texts), BANDS), dtype=np.uint64)
    bits = np.zeros((len(texts), 256), dtype=np.uint8)
    mix = np.uint64(0x9E3779B97F4A7C15)
    for band in range(BANDS):
        key = np.full(len(texts), np.uint64(band + 1), dtype=np.uint64)
        for r in range(band * ROWS, (band + 1) * ROWS):
            low = np.minimum.reduceat((flat * a[r] + b[r]) ^ shifted * a[r], starts)
            key = (key ^ low) * mix
            key ^= key >> np.uint64(31)
            bits[:, r] = (low * mix) >> np.uint64(63)
        keys[:, band] = key
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(flat))))
    cells = np.bincount(text * CELLS + (flat >> np.uint64(56)).astype(np.int64), minlength=len(texts) * CELLS).reshape(len(texts), CELLS)
    return keys.view(np.int64), np.packbits(np.hstack([bits, (cells & 1).astype(np.uint8)]), axis=1).view(np.int64)


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        words = [sorted(fold_words(t)) for t in pdf["text"]]
        joined = [" ".join(w) for w in words]
        yield pd.DataFrame({"id": pdf["id"], "bag": [xxhash.xxh128_digest(j) for j in joined], "n": [len(w) for w in words], "words": joined})


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 512):
            part = pdf.iloc[at : at + 512]
            keys, signatures = band_keys([w.split(" ") for w in part["words"]])
            rows = np.repeat(np.arange(len(part)), BANDS)
            yield pd.DataFrame({"key": keys.ravel(), "bag": part["bag"].to_numpy()[rows], "head": part["head"].to_numpy()[rows], "n": part["n"].to_numpy()[rows], "signature": list(signatures[rows])})


def _key_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a class with all its keys: the rows of the keys are made from it outside Python."""
    for pdf in batches:
        for at in range(0, len(pdf), 512):
            part = pdf.iloc[at : at + 512]
            keys, signatures = band_keys([w.split(" ") for w in part["words"]])
            yield pd.DataFrame({"keys": list(keys), "bag": part["bag"], "head": part["head"], "n": part["n"], "signature": list(signatures)})


def bag_distance(a: str, b: str) -> float:
    """The share of the longer text's words that the other does not match, whatever the order."""
    x, y = Counter(a.split()), Counter(b.split())
    longer = max(x.total(), y.total())
    return 1 - (x & y).total() / longer if longer else 0.0


@F.pandas_udf(T.DoubleType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([bag_distance(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def _agree(a: str, b: str) -> Column:
    """The share of signature bits that agree."""
    differ = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(4)), F.lit(0))
    return 1 - differ / F.lit(BANDS * ROWS)


def _unlike(a: str, b: str) -> Column:
    """How many cells' parities differ: at most as many as there are words in one text and not in the other. None where an older index kept no parities."""
    return F.coalesce(sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(4, 4 + CELLS // 64)), F.lit(0)), F.lit(0))


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def small(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint if the written table it is made from is small."""
    return F.broadcast(df) if table_bytes(df if source is None else source) < SMALL else df


class HistoryIndex:
    """The persisted history: loads are added, each is told apart from all before it."""

    def __init__(self, spark: SparkSession, path: str | None = None, limit: float = LIMIT, crowd: int = CROWD, bucket_rows: int = BUCKET_ROWS, fan: int = FAN, paired: int = PAIRED):
        """Opens the index in ``path`` (a new folder under the shared one if none is given) with all loads that ended there."""
        self.spark, self.limit, self.crowd, self.bucket_rows, self.fan, self.paired = spark, limit, crowd, bucket_rows, fan, paired
        self.path = (path or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}").rstrip("/")
        self.runs: dict[str, dict] = {}
        self.loads = 0
        for name in self._markers():
            run = json.loads(spark.read.text(f"{self.path}/runs/{name}").first()[0])
            self.runs[name] = run
            self.loads = max(self.loads, run["last"] + 1)
        for name in [n for n, r in self.runs.items() if any(o["first"] <= r["first"] and r["last"] <= o["last"] and o["level"] > r["level"] for o in self.runs.values())]:
            del self.runs[name]  # merged, and not yet cleared

    # ------------------------------------------------------------ files

    def _folder(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _markers(self) -> list[str]:
        fs, path = self._folder("runs")
        return [n for s in fs.listStatus(path) if not (n := s.getPath().getName()).endswith(".new")] if fs.exists(path) else []

    def _mark(self, name: str, run: dict) -> None:
        self.spark.createDataFrame([(json.dumps(run),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/runs/{name}.new")
        fs, new = self._folder(f"runs/{name}.new")
        fs.rename(new, self._folder(f"runs/{name}")[1])
        self.runs[name] = run

    def _drop(self, name: str) -> None:
        for part in (f"runs/{name}", *(f"{t}/{name}" for t in SCHEMAS)):
            fs, path = self._folder(part)
            fs.delete(path, True)
        self.runs.pop(name, None)

    def _write(self, table: str, name: str, df: DataFrame, buckets: int, by: str) -> None:
        # a bucket's rows meet in one task: it holds about ``bucket_rows``
        laid = df.withColumn("bucket", _bucket(by, buckets)).repartition(min(buckets, 2000), "bucket") if buckets > 1 else df.withColumn("bucket", F.lit(0))
        laid.sortWithinPartitions("bucket", by).write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/{table}/{name}")

    def _read(self, table: str, name: str, keys: DataFrame | None = None, by: str = "") -> DataFrame:
        """A run's table; with ``keys`` (a written table holding the column ``by``) only the rows with one of those keys, from the buckets that these fall into."""
        df = self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.path}/{table}/{name}")
        if keys is None:
            return df.drop("bucket")
        buckets = self.runs[name][table]
        mine = keys.select(by)
        if buckets > 1:
            hit = [r[0] for r in mine.select(_bucket(by, buckets).alias("b")).distinct().limit(MOST_NAMED + 1).collect()]
            if len(hit) <= MOST_NAMED:  # a filter on the folders; with more, nearly every bucket is hit
                df = df.filter(F.col("bucket").isin(hit))
        return df.join(small(mine.distinct(), keys), by, "left_semi").drop("bucket")

    def _history(self, table: str, keys: DataFrame, by: str) -> DataFrame:
        """The rows of all runs that have one of the keys."""
        if not self.runs:
            return self.spark.createDataFrame([], SCHEMAS[table]).drop("bucket")
        return reduce(DataFrame.unionByName, [self._read(table, name, keys, by) for name in sorted(self.runs)])

    def _merge(self) -> None:
        """Runs of one level become one of the next as soon as there are ``fan`` of them."""
        while True:
            levels = Counter(r["level"] for r in self.runs.values())
            full = [lv for lv, k in levels.items() if k >= self.fan]
            if not full:
                return
            level = min(full)
            names = sorted((n for n, r in self.runs.items() if r["level"] == level), key=lambda n: self.runs[n]["first"])
            rows = {t: sum(self.runs[n][f"{t}_rows"] for n in names) for t in SCHEMAS}
            run = {"level": level + 1, "first": self.runs[names[0]]["first"], "last": self.runs[names[-1]]["last"], **self._sizes(rows)}
            name = f"r{run['first']:08d}-{run['last']:08d}-{level + 1}"
            for t, by in (("bands", "key"), ("classes", "bag"), ("members", "bag")):
                df = reduce(DataFrame.unionByName, [self._read(t, n) for n in names])
                self._write(t, name, _newest_state(df) if t == "classes" else df, run[t], by)
            self._mark(name, run)
            for n in names:
                self._drop(n)

    def _sizes(self, rows: dict[str, int]) -> dict[str, int]:
        return {**{t: 1 << max(0, -(-n // self.bucket_rows) - 1).bit_length() for t, n in rows.items()}, **{f"{t}_rows": n for t, n in rows.items()}}

    # ------------------------------------------------------------ loads

    def add(self, batch: DataFrame, id_col: str = "file_no", text: str = "text_sample") -> DataFrame:
        """(id_a, id_b): each record of the batch with the earliest record (smallest id), here or in the history, that it repeats; then
        the batch is part of the history.

        If a record arrives that is earlier by its id than records of the history that repeat it, these come out again with the new
        earliest one; the smallest ``id_a`` of an ``id_b`` over all loads is what a single load of everything gives. Records with a null or wordless text and those
        without an id are neither compared nor kept. An id given twice with one text counts once. An empty batch gives no rows.
        """
        ids = batch.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull() & F.col("id").isNotNull())
        new = written(ids.mapInPandas(_prepare, "id long, bag binary, n int, words string").filter("n > 0"), "batch")
        members = written(new.select("bag", "id").distinct(), "batch-members")
        heads = new.groupBy("bag").agg(F.min("id").alias("head"))
        old = _newest_state(self._history("classes", members, "bag").select("bag", "head", "near", F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("words")))
        heads = written(heads.join(old.select("bag", F.col("head").alias("old_head"), F.col("near").alias("old_near")), "bag", "left"), "heads")
        # classes that the history does not know, or knows with a later record only
        active = heads.filter("old_head is null or head < old_head").select("bag", "head")
        active = written(new.join(active.withColumnRenamed("head", "id"), ["bag", "id"]).dropDuplicates(["bag"]).withColumnRenamed("id", "head"), "active")
        lists = active.mapInPandas(_key_lists, "keys array<long>, bag binary, head long, n int, signature array<long>")
        bands = written(lists.select(F.explode("keys").alias("key"), "bag", "head", "n", "signature"), "bands")
        near = written(self._near(active, bands), "near")
        # of each class: the earliest record of its own, and of the classes that it is near to
        null = F.lit(None).cast("long")
        state = heads.select("bag", F.least("head", "old_head").alias("head"), "old_head", "old_near", null.alias("new_near"), F.lit(True).alias("here"))
        state = state.unionByName(near.select("bag", null.alias("head"), null.alias("old_head"), null.alias("old_near"), F.col("near").alias("new_near"), F.lit(False).alias("here")))
        state = state.groupBy("bag").agg(*[F.min(c).alias(c) for c in ("head", "old_head", "old_near", "new_near")], F.max("here").alias("here"))
        state = written(state.withColumn("near", F.least("old_near", "new_near")), "state")
        first = F.least("head", "near")
        pairs = members.join(state.filter("here").select("bag", first.alias("id_a")), "bag")
        # classes of the history that may have an earlier original now
        changed = written(state.filter("not here or head < old_head or old_head is not null and new_near is not null").select("bag", first.alias("id_a")), "changed")
        if self.runs and not changed.isEmpty():
            before = _newest_state(self._history("classes", changed, "bag").select("bag", "head", "near", F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("words")))
            earlier = written(changed.join(before.select("bag", F.least("head", "near").alias("before")), "bag").filter("id_a < before").select("bag", "id_a"), "earlier")
            pairs = pairs.unionByName(self._history("members", earlier, "bag").join(earlier, "bag").select("bag", "id", "id_a"))
        pairs = written(pairs.filter("id_a < id").select("id_a", F.col("id").alias("id_b")).distinct(), "pairs")

        # appended: new classes, and what has changed of known ones
        classes = state.filter("here and old_head is null or head < old_head or new_near is not null").join(active.select("bag", "n", "words"), "bag", "left")
        classes = classes.select("bag", "head", "near", "n", F.when(F.col("old_head").isNull() & F.col("here"), F.col("words")).alias("words"))
        name = f"r{self.loads:08d}-{self.loads:08d}-0"
        counts = {"bands": bands.count(), "classes": heads.count(), "members": members.count()}
        run = {"level": 0, "first": self.loads, "last": self.loads, **self._sizes(counts)}
        self._write("bands", name, bands, run["bands"], "key")
        self._write("classes", name, classes, run["classes"], "bag")
        self._write("members", name, members, run["members"], "bag")
        self._mark(name, run)
        self.loads += 1
        self._merge()
        return pairs

    def _near(self, active: DataFrame, bands: DataFrame) -> DataFrame:
        """(bag, near): active classes with the earliest class near to them, and classes of the history with an active one that is near and earlier."""
        rows = bands.withColumn("active", F.lit(True))
        if self.runs:
            rows = rows.unionByName(self._history("bands", bands, "key").withColumn("active", F.lit(False)))
        # keys that meet, counted with a combine before the shuffle
        sizes = rows.groupBy("key").agg(F.count("*").alias("members"), F.max("active").alias("any_active")).filter("members > 1 and any_active").select("key", "members")
        met = written(rows.join(sizes, "key"), "met")
        words = active.select("bag", "n", "words")
        if self.runs:
            others = written(met.filter("not active").select("bag").distinct().join(active.select("bag"), "bag", "left_anti"), "met-bags")
            words = words.unionByName(self._history("classes", others, "bag").filter("words is not null").select("bag", "n", "words"))
        crowded = met.filter(F.col("members") > self.crowd)
        if crowded.isEmpty():
            near = self._verified(written(self._candidates(met, met).distinct(), "candidates"), words)
            return near.groupBy(F.col("bag_b").alias("bag")).agg(F.min("head_a").alias("near"))
        early = Window.partitionBy("key").orderBy("head", "bag")
        # the rank filter becomes a limit in each task before the rows of a key meet
        pivots = crowded.withColumn("r", F.row_number().over(early)).filter(F.col("r") <= self.crowd).drop("r")
        few = met.filter(F.col("members") <= self.crowd)
        tried = written(self._candidates(few, few).unionByName(self._candidates(crowded, pivots)).distinct(), "candidates")
        near = written(self._verified(tried, words), "verified")
        # classes of crowded keys that no pivot of the key is near to
        late = crowded.groupBy("key").agg(F.min(F.when(F.col("active"), F.col("head"))).alias("from"))
        solved = crowded.select("key", "bag").join(near.select(F.col("bag_b").alias("bag"), F.col("bag_a")), "bag").join(pivots.select("key", F.col("bag").alias("bag_a")), ["key", "bag_a"]).select("key", "bag").distinct()
        left = crowded.join(late, "key").filter(F.col("active") | (F.col("head") > F.col("from"))).join(pivots.select("key", "bag"), ["key", "bag"], "left_anti").join(solved, ["key", "bag"], "left_anti")
        left = written(left.select(*met.columns), "unsolved")
        least, most = left.agg(F.min("members"), F.max("members")).first()  # two numbers
        more = None
        if least is not None and least <= self.paired:
            few = F.col("members") <= self.paired
            more = self._candidates(*self._blocks(left.filter(few), crowded.filter(few).join(left.select("key").distinct(), "key", "left_semi")), on=("key", "block"))
        if most is not None and most > self.paired:
            huge = crowded.filter(F.col("members") > self.paired)
            everyone = huge.groupBy("bag").agg(F.min("head").alias("head"), F.max("active").alias("active"), F.min("n").alias("n"), F.first("signature").alias("signature"))
            rare = self._rare_pairs(everyone, words.select("bag", "words"), left.filter(F.col("members") > self.paired).select("bag").distinct())
            more = rare if more is None else more.unionByName(rare)
        if more is not None:
            near = near.unionByName(self._verified(written(more.distinct(), "more-candidates"), words))
        return near.groupBy(F.col("bag_b").alias("bag")).agg(F.min("head_a").alias("near"))

    def _fits(self) -> Column:
        return F.least("a.n", "b.n") >= (1 - self.limit) * F.greatest("a.n", "b.n")

    def _alike(self) -> Column:
        """Whether the cells' parities leave room for a distance of ``limit``: bags of a and b words that share s differ in a + b - 2 s."""
        return _unlike("a.signature", "b.signature") <= F.col("a.n") + F.col("b.n") - 2 * (1 - self.limit) * F.greatest("a.n", "b.n") + 1e-6

    @staticmethod
    def _blocks(rows: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of a key in as many blocks as its members make, each to meet all of ``whole``: no task pairs off more than BLOCK rows at once."""
        pieces = F.ceil(F.col("members") / BLOCK).cast("int")
        return rows.withColumn("block", F.pmod(F.xxhash64("bag"), pieces).cast("int")), whole.withColumn("block", F.explode(F.sequence(F.lit(0), pieces - 1)))

    def _candidates(self, rows: DataFrame, earlier: DataFrame, on: tuple[str, ...] = ("key",)) -> DataFrame:
        """(bag_a, head_a, bag_b) of classes that share a key, one of them active, whose lengths and signatures do not speak against it."""
        a, b = earlier.alias("a"), rows.alias("b")
        same = reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on])
        on = same & (F.col("a.head") < F.col("b.head")) & (F.col("a.bag") != F.col("b.bag")) & (F.col("a.active") | F.col("b.active")) & self._fits()
        fit = b.join(a, on).filter(self._alike() & (_agree("a.signature", "b.signature") >= LEAST_AGREE))
        return fit.select(F.col("a.bag").alias("bag_a"), F.col("a.head").alias("head_a"), F.col("b.bag").alias("bag_b"))

    def _verified(self, candidates: DataFrame, words: DataFrame) -> DataFrame:
        # only the texts of candidates move
        wanted = candidates.select(F.explode(F.array("bag_a", "bag_b")).alias("bag")).distinct()
        texts = words.select("bag", "words").join(small(wanted, candidates), "bag", "left_semi")
        paired = candidates.join(texts.select(F.col("bag").alias("bag_b"), F.col("words").alias("wb")), "bag_b").join(texts.select(F.col("bag").alias("bag_a"), F.col("words").alias("wa")), "bag_a")
        return paired.filter(_distance("wa", "wb") <= self.limit).select("bag_a", "head_a", "bag_b")

    def _rare_pairs(self, crowded: DataFrame, words: DataFrame, unsolved: DataFrame) -> DataFrame:
        """The exact way: unsolved classes and earlier ones of crowded keys that share one of the rarest words of both."""
        texts = crowded.join(words, "bag")
        terms = texts.select("bag", "head", "n", "active", F.explode(F.split("words", " ")).alias("w")).groupBy("bag", "head", "n", "active", "w").agg(F.count("*").alias("k"))
        terms = terms.select("bag", "head", "n", "active", F.explode(F.sequence(F.lit(1).cast("long"), "k")).alias("nth"), "w").withColumn("t", F.xxhash64("w", "nth"))
        frequency = terms.groupBy("t").agg(F.count("*").alias("df"))
        place = F.row_number().over(Window.partitionBy("bag").orderBy("df", "t"))
        ranked = terms.select("bag", "head", "n", "active", "t").join(frequency, "t").withColumn("place", place)
        rare = ranked.filter(F.col("place") <= F.col("n") - F.ceil((1 - self.limit) * F.col("n")) + 1).filter("df > 1").join(crowded.select("bag", "signature"), "bag")
        a, b = rare.alias("a"), rare.join(unsolved, "bag", "left_semi").alias("b")
        on = (F.col("a.t") == F.col("b.t")) & (F.col("a.head") < F.col("b.head")) & (F.col("a.bag") != F.col("b.bag")) & (F.col("a.active") | F.col("b.active")) & self._fits()
        return b.join(a, on).filter(self._alike()).select(F.col("a.bag").alias("bag_a"), F.col("a.head").alias("head_a"), F.col("b.bag").alias("bag_b")).distinct()


def _newest_state(classes: DataFrame) -> DataFrame:
    """One row a class: the earliest record and near record of all its rows, and the words of the row that has them."""
    return classes.groupBy("bag").agg(F.min("head").alias("head"), F.min("near").alias("near"), F.max("n").alias("n"), F.max("words").alias("words"))


def accepted(files: DataFrame) -> DataFrame:
    return files.filter("outcome = 'accept' and text_sample is not null").select("file_no", "batch_no", "text_sample")


def loads_of(files: DataFrame, loads: int) -> list[Column]:
    """Filters that cut the batches, in their order, into at most ``loads`` loads of about equally many rows, each of whole batches; those without a number come first."""
    at = [k / loads for k in range(1, loads)] + [1.0]
    cuts = sorted(set(files.agg(F.percentile_approx("batch_no", at, 10_000)).first()[0] or ()))
    if not cuts:
        return [F.lit(True)]
    b = F.col("batch_no")
    return [b.isNull() | (b <= cuts[0]), *[(b > low) & (b <= high) for low, high in zip(cuts, cuts[1:], strict=False)]]


def ingested(files: DataFrame, loads: int, **parameters) -> DataFrame:
    """(id_a, id_b) after the accepted files have gone into an empty index in ``loads`` loads of consecutive batches, each probing what came before."""
    index = HistoryIndex(files.sparkSession, **parameters)
    own = accepted(files)
    pairs = reduce(DataFrame.unionByName, [index.add(own.filter(c)) for c in loads_of(own, loads)])
    return pairs.groupBy("id_b").agg(F.min("id_a").alias("id_a"))


#: Loads that the query makes of the batches: the first fills the history, the others probe it.
LOADS = 3


def found(files: DataFrame) -> DataFrame:
    """(file_no_a, file_no_b): the accepted files go into the index in ``LOADS`` loads of consecutive batches."""
    return ingested(files, LOADS).select(F.col("id_a").alias("file_no_a"), F.col("id_b").alias("file_no_b"))


def last_batch(files: DataFrame) -> DataFrame:
    """The pairs of the newest batch only: the history is loaded first, the batch probes it."""
    own = accepted(files)
    newest = own.agg(F.max("batch_no")).first()[0]  # one number
    index = HistoryIndex(files.sparkSession)
    index.add(own.filter(F.col("batch_no").isNull() | (F.col("batch_no") < F.lit(newest))))
    return index.add(own.filter(F.col("batch_no") == F.lit(newest))).select(F.col("id_a").alias("file_no_a"), F.col("id_b").alias("file_no_b"))

"""Content hashes, stable ids and SimHash."""

from __future__ import annotations

from collections import Counter
from hashlib import md5
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions.texts import bound
from sheafline.session import written


def short_hash(text: Column, n: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, n)


def doc_id(file_id: Column) -> Column:
    return F.concat(F.lit("doc-"), short_hash(file_id, 32))


def fragment_base(file_id: Column, page: Column, kind: Column, signature: Column) -> Column:
    """doc:pNNN:type:hash, before repeats are numbered."""
    return F.concat(doc_id(file_id), F.lit(":p"), F.lpad(F.coalesce(page, F.lit(0)).cast("string"), 3, "0"), F.lit(":"), kind, F.lit(":"), short_hash(signature, 12))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits; an empty fingerprint (0) is far from everything."""
    return F.when((a == 0) | (b == 0), F.lit(64)).otherwise(F.bit_count(a.bitwiseXOR(b)))


@F.pandas_udf(T.LongType())
def _votes(tokens: pd.Series) -> pd.Series:
    out = np.zeros(len(tokens), dtype=np.int64)
    for i, words in enumerate(tokens):
        if words is None or not len(words):
            continue
        counts = Counter(words)
        bits = np.unpackbits(np.frombuffer(b"".join(md5(w.encode()).digest()[:8] for w in counts), dtype=np.uint8).reshape(-1, 8), axis=1)
        # a bit is set if more tokens have it than not
        ahead = 2 * (np.fromiter(counts.values(), dtype=np.int64) @ bits.astype(np.int64)) > counts.total()
        out[i] = np.packbits(ahead).view(">i8")[0]
    return pd.Series(out)


def simhash(df: DataFrame, id_col: str, text: str, sample: int | None = None) -> DataFrame:
    """(id, fingerprint): SimHash-64 over lower-case word tokens of three letters or more, with multiplicity.

    Every token votes with the first 64 bits of its md5; a document is one row, its votes are summed inside the row. ``sample`` cuts the text to its first characters
    (None: the whole text). A text without tokens, or null, has fingerprint 0.
    """
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    if sample:
        t = F.substring(t, 1, sample)
    return df.select(F.col(id_col), _votes(F.regexp_extract_all(t, F.lit(r"(?U)\w{3,}"), F.lit(0))).alias("fingerprint"))


def chosen_keys(value: Column, blocks: int, width: int, agree: int) -> Column:
    """An array of (mask of the chosen blocks, their bits) for every choice of ``agree`` blocks of ``width`` bits."""
    keys = []
    for chosen in combinations(range(blocks), agree):
        v = F.lit(0).cast("long")
        for k in chosen:
            v = F.shiftleft(v, width).bitwiseOR(F.shiftrightunsigned(value, k * width).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(F.struct(F.lit(sum(1 << k for k in chosen)).alias("mask"), v.alias("v")))
    return F.array(*keys)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def first_choice(differ: Column, blocks: int, width: int, agree: int) -> Column:
    """The mask of the first ``agree`` blocks without a differing bit: the one key, of those that two values share, that gives their pair."""

    def same(d: Column) -> Column:
        return sum((F.when(d.bitwiseAND(F.lit(_signed(((1 << width) - 1) << (k * width)))) == 0, 1 << k).otherwise(0) for k in range(blocks)), F.lit(0))

    def lowest(left: Column) -> Column:
        mask = F.lit(0)
        for _ in range(agree):
            bit = left.bitwiseAND(-left)
            mask, left = mask + bit, left - bit
        return mask

    # values that are named often are bound: written out, the join's condition is too long for the compiler
    return bound(bound(differ, same), lowest)


def near_pairs(prints: DataFrame, id_col: str, distance: int = 6, blocks: int = 8, crowd: int = 1000) -> DataFrame:
    """(a, b, distance) of fingerprints at most ``distance`` bits apart, between distinct fingerprints' first ids.

    Pigeonhole: of ``blocks`` equal blocks at least ``blocks - distance`` agree, so the join key is every choice of that many blocks: with the
    defaults 28 keys of 16 bits, a 65,536th of the prints each. A key that more than ``crowd`` prints share gets a second one, of the same kind over blocks of
    every eighth bit, so its prints meet in much smaller groups. A pair comes out of the first key it shares only. Equal prints are one class, named by its smallest id, so copies make
    no pairs. Needs distance < blocks and blocks dividing 64.
    """
    agree, width = blocks - distance, 64 // blocks
    # bits 0, 8, 16, ... make the first block of the second key, bits 1, 9, 17, ... the second: other blocks than those of the first
    turned = F.lit(0).cast("long")
    for k in range(width):
        for i in range(blocks):
            turned = turned.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fingerprint", i * width + k).bitwiseAND(F.lit(1)), k * blocks + i))
    heads = written(prints.filter("fingerprint <> 0").groupBy("fingerprint").agg(F.min(id_col).alias("id")).withColumn("turned", turned), "print-heads")
    keyed = heads.select("id", "fingerprint", "turned", F.explode(chosen_keys(F.col("fingerprint"), blocks, width, agree)).alias("k")).select("id", "fingerprint", "turned", "k.mask", "k.v")
    keyed = written(keyed, "print-keys")
    sizes = keyed.groupBy("mask", "v").agg((F.count("*") > crowd).alias("hot"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = written(keyed.join(sizes, ["mask", "v"]), "print-groups")
    fine = met.filter("hot").withColumn("k", F.explode(chosen_keys(F.col("turned"), width, blocks, max(0, width - distance)))).select("id", "fingerprint", "mask", "v", "turned", F.col("k.mask").alias("mask2"), F.col("k.v").alias("v2"))
    coarse = met.filter("not hot")

    def pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
        a, b = rows.alias("a"), rows.alias("b")
        on = F.col("a.id") < F.col("b.id")
        for k in keys:
            on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
        differ = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
        keep = (F.bit_count(differ) <= distance) & (F.col("a.mask") == first_choice(differ, blocks, width, agree))
        if "mask2" in keys:
            keep = keep & (F.col("a.mask2") == first_choice(F.col("a.turned").bitwiseXOR(F.col("b.turned")), width, blocks, max(0, width - distance)))
        return a.join(b, on).filter(keep).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.bit_count(differ).alias("distance"))

    return pairs(coarse, ["mask", "v"]).unionByName(pairs(fine, ["mask", "v", "mask2", "v2"]))


def near_classes(prints: DataFrame, id_col: str, distance: int = 6) -> DataFrame:
    """(id, class_id, links, nearest_id, distance): each record with the first record of its print, how many other prints are near, and the nearest one's first record (the smallest on a tie).

    Records without a fingerprint (0) are classes of their own without links.
    """
    prints = written(prints.select(id_col, "fingerprint"), "prints")
    pairs = written(near_pairs(prints, id_col, distance), "print-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    linked = both.groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"), F.min(F.struct("distance", "b")).alias("m"))
    heads = prints.filter("fingerprint <> 0").groupBy("fingerprint").agg(F.min(id_col).alias("class_id"))
    out = prints.join(heads, "fingerprint", "left").withColumn("class_id", F.coalesce("class_id", id_col)).join(linked, "class_id", "left")
    return out.select(id_col, "class_id", F.coalesce("links", F.lit(0)).alias("links"), F.col("m.b").alias("nearest_id"), F.col("m.distance").alias("distance"))

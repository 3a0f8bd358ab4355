"""Evaluation texts inside the corpus: rare n-gram seeds, local alignment, exact runs of words.

Texts are compared as streams of folded letters and digits, so case, punctuation, spacing, line breaks, words parted at a
line end and look-alike characters leave no trace. N-grams are hashed stretches of ``GRAM`` signs of a stream. Of an item's n-grams those are kept that are the least of
``SPREAD`` neighbours (winnowing), so that every window of ``RUN`` item words holds some; windows too short for that use shorter n-grams. One pass over the corpus finds
which documents hold which of them. How many documents an n-gram meets gives its rarity over the whole corpus: of each window the rarest one becomes a seed, so a
document that holds the whole window holds its seed. Seeds join documents to items, and only those documents' texts are read again:

* ``score``: Smith-Waterman over words (match 2, mismatch -1, gap -1) between the item and the passages around the seeds, over
  twice the item's words: edited and paraphrased copies score high though their runs are short. It decides whether a pair is looked at further;
* ``run``: the longest run of consecutive item words in the document, beginning and ending with words of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.glyphs import fold, fold_words
from sheafline.session import table_bytes, written

RUN = 16
#: Length of an n-gram and how many neighbours it is the least of, for windows of GRAM + SPREAD - 1 signs; and for shorter ones (16 words have 16 signs at least).
GRAM, SPREAD = 32, 9
SHORT_GRAM, SHORT_SPREAD = 8, 9
#: So many n-grams of items are looked up in memory; with more, the documents' own winnowed n-grams are joined with them.
MOST_IN_MEMORY = 4_000_000
#: The share of an alignment's score that RUN words in a row reach even if some of them are parted; and the share of a whole item that makes an edited copy.
GATE, EDITED = 0.5, 0.5

TOKEN = re.compile(r"[^\W_]+")
PARTED = re.compile(r"(?<=\w)[-‐‑¬­]\s*\n\s*(?=\w)")


def hashes(stream: str, k: int) -> np.ndarray:
    """64-bit hashes of all stretches of ``k`` signs (k a power of two), by doubling."""
    h = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    factor, n = np.uint64(0xD1342543DE82EF95), 1
    with np.errstate(over="ignore"):
        while n < k and len(h) > n:
            h = h[:-n] * factor + (h[n:] ^ (h[n:] >> np.uint64(29)))
            factor, n = factor * factor, 2 * n
        return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) if n >= k else h[:0]


def least(h: np.ndarray, w: int) -> np.ndarray:
    """For each place the place of the least of the ``w`` hashes from there on (the first on a tie)."""
    return np.arange(len(h) - w + 1) + np.lib.stride_tricks.sliding_window_view(h, w).argmin(1) if len(h) >= w else np.zeros(0, dtype=np.int64)


def item_windows(text: str) -> list[tuple[int, int, int, bool]]:
    """(window, n-gram hash, its place in the item's stream, whether it is a short one) for every RUN words of an item; nothing for shorter items."""
    words = fold_words(text)
    if len(words) < RUN:
        return []
    ends = np.cumsum([len(w) for w in words])
    stream, out = "".join(words), []
    kinds = [(h := hashes(stream, k), least(h, w), k + w - 1, k == SHORT_GRAM) for k, w in ((GRAM, SPREAD), (SHORT_GRAM, SHORT_SPREAD))]
    for j in range(len(words) - RUN + 1):
        a, b = int(ends[j]) - len(words[j]), int(ends[j + RUN - 1])
        h, at, need, short = kinds[0] if b - a >= kinds[0][2] else kinds[1]
        out.extend((j, int(h[p].astype(np.int64)), int(p), short) for p in np.unique(at[a : b - need + 1]))
    return out


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for item, text in zip(pdf["item"], pdf["text"], strict=True):
            rows = item_windows(text)
            if rows:
                yield pd.DataFrame(rows, columns=["window", "gram", "place", "short"]).assign(item=item)[["item", "window", "gram", "place", "short"]]


def _grams(known: dict[bool, np.ndarray] | None, kinds: list[bool]):
    """Which n-grams a document holds: of the known ones, or its winnowed ones if these are too many for memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.uint64((1 << 22) - 1)
        maps = {}
        for short, grams in (known or {}).items():
            maps[short] = np.zeros(1 << 22, dtype=bool)
            maps[short][grams & mask] = True
        for pdf in batches:
            # so many signs at a time that their hashes stay small
            sizes = pdf["text"].str.len().cumsum().to_numpy() // 2_000_000
            for _, part in pdf.groupby(sizes):
                streams = [TOKEN.findall(fold(t)) for t in part["text"]]
                streams = ["".join(s) for s in streams]
                ends = np.cumsum([len(s) for s in streams])
                for short in kinds:
                    k, w = (SHORT_GRAM, SHORT_SPREAD) if short else (GRAM, SPREAD)
                    h = hashes("".join(streams), k)
                    if known is not None:
                        at = np.flatnonzero(maps[short][h & mask])
                        at = at[np.isin(h[at], known[short])]
                    else:
                        at = np.unique(least(h, w))
                    doc = np.searchsorted(ends, at, side="right")
                    fits = at + k <= ends[doc] if len(at) else np.zeros(0, dtype=bool)
                    hit = pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[doc[fits]], "gram": h[at[fits]].view(np.int64)}).drop_duplicates()
                    if len(hit):
                        yield hit

    return run


def seeds(windows: DataFrame, hits: DataFrame) -> DataFrame:
    """(item, gram, place): of each window the n-gram that the fewest documents hold (the first on a tie), of those that any document holds."""
    rarity = hits.groupBy("gram").agg(F.count("*").alias("df"))
    best = windows.join(rarity, "gram").groupBy("item", "window").agg(F.min_by(F.struct("gram", "place"), F.struct("df", "place")).alias("s"))
    return best.select("item", "s.gram", "s.place").distinct()


class Document:
    """A document's stream, its words, and where words begin and end in the stream."""

    def __init__(self, text: str):
        tokens = TOKEN.findall(fold(text))
        self.stream = "".join(tokens)
        ends = np.cumsum([len(t) for t in tokens]) if tokens else np.zeros(0, dtype=np.int64)
        self.ends = frozenset(ends.tolist())
        self.starts = frozenset((0, *ends.tolist()))
        self.words = fold_words(PARTED.sub("", text))
        self.word_ends = np.cumsum([len(w) for w in self.words]) if self.words else np.zeros(0, dtype=np.int64)

    def places(self, part: str) -> list[int]:
        out, at = [], self.stream.find(part)
        while at >= 0:
            out.append(at)
            at = self.stream.find(part, at + 1)
        return out


def _same(a: str, i: int, b: str, j: int, step: int) -> int:
    """How many signs two texts share from two places on, forwards (step 1) or backwards (-1)."""
    most = min(len(a) - i, len(b) - j) if step > 0 else min(i, j)
    low, high, size = 0, 0, 64
    # doubling, then halving: slices are compared, not signs
    while high < most:
        high = min(most, low + size)
        if (a[i + low : i + high] == b[j + low : j + high]) if step > 0 else (a[i - high : i - low] == b[j - high : j - low]):
            low, size = high, 2 * size
        else:
            break
    while low < high:
        mid = (low + high + 1) // 2
        if (a[i + low : i + mid] == b[j + low : j + mid]) if step > 0 else (a[i - mid : i - low] == b[j - mid : j - low]):
            low = mid
        else:
            high = mid - 1
    return low


def longest_run(words: list[str], document: Document, found: list[tuple[int, int]]) -> int:
    """The longest run of item words that stands in the document, grown from (place in the item, place in the document) of seeds; it begins and ends where words of the document do."""
    item = "".join(words)
    ends = np.cumsum([len(w) for w in words])
    best, done = 0, {}
    for p, o in sorted(found):
        if done.get(o - p, -1) >= p:
            continue
        left, right = _same(item, p, document.stream, o, -1), _same(item, p, document.stream, o, 1)
        done[o - p] = p + right
        first = int(np.searchsorted(ends - [len(w) for w in words], p - left))
        last = int(np.searchsorted(ends, p + right, side="right")) - 1
        while first <= last and o - p + int(ends[first]) - len(words[first]) not in document.starts:
            first += 1
        while last >= first and o - p + int(ends[last]) not in document.ends:
            last -= 1
        best = max(best, last - first + 1)
    return best


def align(item: list[str], passage: list[str], match: int = 2, mismatch: int = -1, gap: int = -1) -> int:
    """The best Smith-Waterman score of two word lists."""
    if not item or not passage:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(passage))}
    b = np.array([ids[w] for w in passage])
    row = np.zeros(len(b) + 1, dtype=np.int64)
    steps = np.arange(len(b) + 1) * gap
    best = 0
    for w in item:
        s = np.where(b == ids.get(w, -1), match, mismatch)
        new = np.zeros_like(row)
        new[1:] = np.maximum(0, np.maximum(row[:-1] + s, row[1:] + gap))
        # gaps along the row: a running maximum after taking the gap cost out
        new = np.maximum(0, np.maximum.accumulate(new - steps) + steps)
        best = max(best, int(new.max()))
        row = new
    return best


def passages(words: list[str], document: Document, found: list[tuple[int, int]], slack: int = 12) -> list[list[str]]:
    """Stretches of the document around the seeds, long enough for the whole item, overlapping ones joined."""
    ends = np.cumsum([len(w) for w in words])
    spans = []
    for p, o in found:
        mine, there = int(np.searchsorted(ends, p, side="right")), int(np.searchsorted(document.word_ends, o, side="right"))
        spans.append((max(0, there - mine - slack), min(len(document.words), there + len(words) - mine + slack)))
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return [document.words[a:b] for a, b in joined]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for doc, text, items in zip(pdf["doc_id"], pdf["text"], pdf["items"], strict=True):
            body, out = Document(text), []
            for i in items:
                words = fold_words(i["text"])
                stream = "".join(words)
                found = [(p, o) for s in i["seeds"] for p in (s["place"],) for o in body.places(stream[p : p + (SHORT_GRAM if s["short"] else GRAM)])]
                score = max((align(words, p) for p in passages(words, body, found)), default=0)
                # an alignment that RUN words in a row cannot have is not looked at further
                run = longest_run(words, body, found) if score >= GATE * 2 * RUN else 0
                out.append((doc, i["item"], run, score / (2 * len(words))))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "run", "score"])


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", most_in_memory: int = MOST_IN_MEMORY) -> DataFrame:
    """(doc_id, item_id, run, score): every document that shares a seed with an item, with the longest exact run of words and the alignment score.

    ``run`` is 0 where the alignment stays below what RUN words in a row reach. Null and empty texts, and rows without an id, match nothing; items of fewer than RUN words cannot
    leak and give no rows. Items with the same text are reported each; repeated rows of an id count once.
    """
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and length(text) > 0")
    own = written(items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).filter("item is not null and length(text) > 0").distinct(), "leak-items")
    windows = written(own.mapInPandas(_windows, "item long, window int, gram long, place int, short boolean"), "leak-windows")
    grams = windows.select("gram", "short").distinct()
    kinds = sorted(r[0] for r in windows.select("short").distinct().collect())  # two at most
    known = None
    if kinds and grams.count() <= most_in_memory:
        rows = grams.toArrow()  # as many as are counted above, 8 bytes each
        hashed, is_short = rows["gram"].to_numpy(), rows["short"].to_numpy()
        known = {short: np.sort(hashed[is_short == short].view(np.uint64)) for short in kinds}
    hits = written(docs.mapInPandas(_grams(known, kinds), "doc_id long, gram long").distinct(), "leak-hits")
    chosen = written(seeds(windows, hits).join(windows.select("item", "gram", "place", "short").distinct(), ["item", "gram", "place"]), "leak-seeds")
    few = F.broadcast if table_bytes(chosen) < 8 << 20 else lambda df: df
    pairs = hits.join(few(chosen), "gram").groupBy("doc_id", "item").agg(F.collect_set(F.struct("place", "short")).alias("seeds"))
    asked = pairs.join(F.broadcast(own) if table_bytes(own) < 8 << 20 else own, "item").groupBy("doc_id").agg(F.collect_list(F.struct("item", "text", "seeds")).alias("items"))
    asked = written(asked, "leak-pairs")
    near = F.broadcast(asked) if table_bytes(asked) < 8 << 20 else asked
    return docs.join(near, "doc_id").select("doc_id", "text", "items").mapInPandas(_measure, "doc_id long, item_id long, run int, score double")


def aligned(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, run, score, verdict): ``copy`` for RUN words in a row, ``edited`` for an alignment over half of the item, else null."""
    verdict = F.when(F.col("run") >= RUN, "copy").when(F.col("score") >= EDITED, "edited")
    return leaks(documents, items).withColumn("verdict", verdict)


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents that hold RUN consecutive words of an item."""
    return leaks(documents.select("doc_id", "text"), items.select("item_id", "text")).filter(F.col("run") >= RUN).select("doc_id", "item_id").distinct()

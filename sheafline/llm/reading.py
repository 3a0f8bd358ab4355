"""Reading level of documents: a pairwise linear ranker on syntax and vocabulary features, calibrated by isotonic regression.

Features are taken from running sentences only: markup is read away first (see markup.py), then headings, list items, table rows,
formulas, code and fragments without an end are left out. Medians over sentences make the main text decide, not a quotation in it.
The ranker sees pairs of graded documents with different grades and learns weights such that the harder one scores higher; pool-adjacent-violators on
score and grade turns scores into levels. Features of all documents are computed once and written; fitting uses a bounded sample of graded documents
(``most_labels``), scoring is a JVM expression over all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.markup import SUSPECT, clean_text
from sheafline.session import written

LEAST_WORDS = 40
# Words that open subordinate clauses.
SUBORDINATORS = frozenset(
    "если когда пока хотя чтобы поскольку потому который которая которое которые которого которой которых так как что где куда откуда зачем почему "
    "although because unless while when since if though whereas whether which that who whom whose where".split()
)
# Endings of abstract nouns made from verbs.
ABSTRACT = re.compile(r"(?:[аеия]ни[еяйюм]|[аеия]нием|ирован\w+|стви\w+|ност\w{1,2}|(?:t|s)ions?|ments?|ances?|ences?|bility|isation|ing)$")
INNER = re.compile(r"\.(?=\w)")
SENTENCE = re.compile(r"[^.!?…]+(?:[.!?…]+(?=[\s»\"')]|$)|$)|[.!?…]+")
ITEM = re.compile(r"\s*(?:[-–—•*+·]|\d{1,4}[.)]|\d{1,4}\s{2,}|[a-zа-я]\))\s*\S")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
NAMES = ("median_length", "mean_length", "word_length", "long_words", "commas", "subordinate", "abstract", "short_sentences")


def prose(text: str) -> list[str]:
    """The running sentences of a text."""
    if re.search(SUSPECT, text):
        _, kinds, blocks = clean_text(text)
        parts = []
        open_end = False
        for role, _, body in blocks if kinds else [("para", 0, text)]:
            # a sentence that markup broke goes on in the next block
            if open_end and body[:1].islower() and role in ("para", "heading", "quote"):
                parts[-1] += " " + body
            elif role in ("para", "quote"):
                parts.append(body)
            else:
                open_end = False
                continue
            open_end = parts[-1].rstrip()[-1:] not in ".!?…"
    else:
        parts = [text]
    out: list[str] = []
    for part in parts:
        for block in re.split(r"\n\s*\n", part):
            lines = [x for x in block.split("\n") if x.strip()]
            run: list[str] = []
            for i, line in enumerate(lines):
                ended = line.rstrip()[-1:] in ".!?…»\")"
                after = lines[i + 1].lstrip()[:1] if i + 1 < len(lines) else ""
                label = not ended and (not after or not after.islower()) and line.count(" ") < 10 and not run
                if ITEM.match(line) and not line.lstrip()[:1].isalpha() or label:
                    run and out.extend(sentences(" ".join(run)))
                    run = []
                else:
                    run.append(line)
            if run:
                out.extend(sentences(" ".join(run)))
    return out


def sentences(text: str) -> list[str]:
    """Sentences with an end; a period inside a number or designation is none."""
    if "." in text:
        text = INNER.sub("", text)
    return [s for m in SENTENCE.finditer(text) if (s := m[0].strip()) and s[-1] in ".!?…»\")"]


@lru_cache(1_000_000)
def about(token: str) -> tuple[int, int, int, int, int, int]:
    """Of a token: its letters, whether it is a word, long, a subordinator, an abstract noun, Latin."""
    words = WORD.findall(token.lower())
    if not words:
        return 0, 0, 0, 0, 0, 0
    w = max(words, key=len)
    return len(w), 1, int(len(w) > 11), int(w in SUBORDINATORS), int(len(w) > 6 and bool(ABSTRACT.search(w))), int(w[0] < "\u0250")


def measure(text: str | None) -> tuple[int, bool, list[float]]:
    """Words in running sentences (between blanks), whether most are Latin, and the features; zeros without any."""
    lengths, commas = [], 0
    sums = np.zeros(6)
    for s in prose(text) if text else ():
        got = [about(t) for t in s.split()]
        lengths.append(len(got))
        sums += [sum(c) for c in zip(*got, strict=True)]
        commas += s.count(",")
    letters, words, long, sub, abstract, is_latin = sums.tolist()
    if not words:
        return sum(lengths), False, [0.0] * len(NAMES)
    n = len(lengths)
    x = [float(median(lengths)), words / n, letters / words, long / words, commas / n, sub / n, abstract / words, sum(k < 6 for k in lengths) / n]
    return sum(lengths), is_latin > words / 2, x


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [measure(t) for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "words": [g[0] for g in got], "latin": [g[1] for g in got], "x": [g[2] for g in got]})


def features(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, words, latin, x): words in running sentences, alphabet, features in the order of NAMES. Null and empty texts have no words; rows without an id are left out."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    return docs.mapInPandas(_features, "doc_id long, words int, latin boolean, x array<double>")


def expand(x: np.ndarray, is_latin: np.ndarray) -> np.ndarray:
    """Features, once for either alphabet, so that one ranker serves both."""
    return np.concatenate([x * ~is_latin[:, None], x * is_latin[:, None], is_latin[:, None]], 1).astype(float)


def fit_ranker(z: np.ndarray, grades: np.ndarray, pairs: int = 60_000, rounds: int = 60, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic pairwise ranker, by Newton steps on a fixed draw of pairs with different grades."""
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, len(z), pairs), rng.integers(0, len(z), pairs)
    keep = grades[a] > grades[b]
    d = z[a[keep]] - z[b[keep]]
    w = np.zeros(z.shape[1])
    if not len(d):
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = d.T @ p / len(d) - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def isotonic(scores: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (largest score of each block, its fitted grade)."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []
    for s, g in zip(scores[order], grades[order], strict=True):
        blocks.append([g, 1.0, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            g2, n2, s2 = blocks.pop()
            g1, n1, _ = blocks.pop()
            blocks.append([(g1 * n1 + g2 * n2) / (n1 + n2), n1 + n2, s2])
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


class Levels:
    """Weights, scaling and the score thresholds between levels."""

    def __init__(self, x: np.ndarray, is_latin: np.ndarray, grades: np.ndarray):
        self.scale = x.std(0) + 1e-9
        self.centre = x.mean(0)
        z = expand((x - self.centre) / self.scale, is_latin)
        self.weights = fit_ranker(z, grades)
        scores = z @ self.weights
        ends, fitted = isotonic(scores, grades.astype(float))
        self.cuts = []
        for level in (1, 2, 3):
            below = ends[fitted < level + 0.5]
            above = scores[scores > (below.max() if len(below) else -np.inf)]
            low = below.max() if len(below) else -np.inf
            self.cuts.append(float((low + above.min()) / 2) if len(above) and np.isfinite(low) else float(np.inf if not len(above) else -np.inf))

    def score(self) -> F.Column:
        k = len(NAMES)
        terms = F.when(F.col("latin"), F.lit(float(self.weights[2 * k]))).otherwise(F.lit(0.0))
        for i in range(k):
            w = F.when(F.col("latin"), F.lit(float(self.weights[k + i]))).otherwise(F.lit(float(self.weights[i])))
            terms = terms + w * (F.col("x")[i] - F.lit(float(self.centre[i]))) / F.lit(float(self.scale[i]))
        return terms

    def level(self) -> F.Column:
        s = self.score()
        return (F.lit(1) + sum(((s > F.lit(c)).cast("int") for c in self.cuts), F.lit(0))).cast("int")


def graded(levels: DataFrame) -> DataFrame:
    """(doc_id, grade): the median of the valid grades 1 to 4 of each document."""
    valid = levels.filter("reading_level between 1 and 4 and doc_id is not null")
    return valid.groupBy("doc_id").agg(F.median("reading_level").alias("grade"))


def reading_levels(documents: DataFrame, levels: DataFrame, least_words: int = LEAST_WORDS, most_labels: int = 20_000) -> DataFrame:
    """(doc_id, words, score, reading_level) of every document with at least ``least_words`` words of running sentences.

    Fits on at most ``most_labels`` graded documents (those with the smallest hash of their id); without any grades there are no rows.
    Repeated rows of one document are judged each.
    """
    feats = written(features(documents), "reading-features")
    enough = feats.filter(F.col("words") >= least_words)
    sample = enough.dropDuplicates(["doc_id"]).join(graded(levels), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels).select("x", "latin", "grade").toPandas()
    if not len(sample):
        return enough.limit(0).select("doc_id", "words", F.lit(0.0).alias("score"), F.lit(0).alias("reading_level"))
    model = Levels(np.array(sample["x"].tolist()), sample["latin"].to_numpy(dtype=bool), sample["grade"].to_numpy(dtype=float))
    return enough.select("doc_id", "words", model.score().alias("score"), model.level().alias("reading_level"))


def found(documents: DataFrame, levels: DataFrame) -> DataFrame:
    return reading_levels(documents.select("doc_id", "text"), levels).select("doc_id", "reading_level").distinct()

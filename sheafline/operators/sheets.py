"""Sheet operators: nearest block, occupied-cell components, readings merged, transcripts against recognised lines."""

from __future__ import annotations

import difflib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEAR, MARGIN = 0.02, 0.02


def nearest(values: DataFrame, blocks: DataFrame, near: float = NEAR, margin: float = MARGIN) -> DataFrame:
    """(line_id, fragment_no, distance): the block nearest to each placed line on its page, if it is within ``near`` and the next one is farther by ``margin``."""
    a = values.filter("bbox is not null").select("line_id", "s3_fileid", "page", *[F.col(f"bbox.{c}").alias(f"a{c}") for c in ("x1", "y1", "x2", "y2")])
    b = blocks.filter("position.bbox is not null").select("fragment_no", "s3_fileid", F.col("position.page").alias("page"), *[F.col(f"position.bbox.{c}").alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")])
    gap = lambda k: F.greatest(F.lit(0.0), F.col(f"b{k}1") - F.col(f"a{k}2"), F.col(f"a{k}1") - F.col(f"b{k}2"))
    d = a.join(b, ["s3_fileid", "page"]).select("line_id", F.struct(F.round(F.greatest(gap("x"), gap("y")), 9).alias("d"), F.col("fragment_no").alias("f")).alias("c"))
    # a page's blocks are few: the two least distances come from one sorted array a line
    both = d.groupBy("line_id").agg(F.slice(F.sort_array(F.collect_list("c")), 1, 2).alias("two")).select("line_id", F.col("two")[0].alias("first"), F.try_element_at("two", F.lit(2))["d"].alias("second"))
    sure = (F.col("first.d") <= near) & (F.col("second").isNull() | (F.col("second") >= F.col("first.d") + margin))
    return both.filter(sure).select("line_id", F.col("first.f").alias("fragment_no"), F.col("first.d").alias("distance"))


def cells(lines: DataFrame, step: int = 50) -> DataFrame:
    """(s3_fileid, page, r, c): the cells of a step x step grid that a page's lines occupy."""
    df = lines.filter("bbox is not null")
    at = lambda k: F.least(F.lit(step - 1), F.greatest(F.lit(0), F.floor(F.col(f"bbox.{k}") * step))).cast("int")
    spans = df.select("s3_fileid", "page", F.explode(F.sequence(at("y1"), F.greatest(at("y1"), at("y2")))).alias("r"), at("x1").alias("c1"), F.greatest(at("x1"), at("x2")).alias("c2"))
    return spans.select("s3_fileid", "page", "r", F.explode(F.sequence("c1", "c2")).alias("c")).distinct()


def components(occupied: DataFrame) -> DataFrame:
    """(s3_fileid, page, component, cells, r1, c1, r2, c2): parts of a page's grid that hang together, numbered from the top left. A page's grid is bounded by its step."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        left = set(zip(pdf["r"], pdf["c"], strict=True))
        out = []
        for seed in sorted(left):
            if seed not in left:
                continue
            left.remove(seed)
            queue, part = deque([seed]), [seed]
            while queue:
                r, c = queue.popleft()
                for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if n in left:
                        left.remove(n)
                        queue.append(n)
                        part.append(n)
            rs, cs = [p[0] for p in part], [p[1] for p in part]
            out.append((pdf["s3_fileid"].iloc[0], pdf["page"].iloc[0], len(out), len(part), min(rs), min(cs), max(rs), max(cs)))
        return pd.DataFrame(out, columns=["s3_fileid", "page", "component", "cells", "r1", "c1", "r2", "c2"])

    return occupied.groupBy("s3_fileid", "page").applyInPandas(label, "s3_fileid string, page int, component int, cells int, r1 int, c1 int, r2 int, c2 int")


def overlap(a: list[float], b: list[float]) -> float:
    """The shared area over the smaller box's area."""
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    low = min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
    return w * h / low if w > 0 and h > 0 and low > 0 else 0.0


def merge_readings(values: list[dict], key, share: float = 0.5) -> list[dict]:
    """Readings of one value merged, first seen first: the same key and kind, and boxes that overlap by half of the smaller; the surer text stays."""
    out: list[dict] = []
    for v in values:
        twin = next((o for o in out if key(o["text"]) == key(v["text"]) and o["kind"] == v["kind"] and overlap(o["box"], v["box"]) >= share), None)
        if twin is None:
            out.append(dict(v))
        elif v["confidence"] > twin["confidence"]:
            twin.update(text=v["text"], confidence=v["confidence"])
    return out


def best_run(line: str, recognised: list[str], most: int = 12, least_chars: int = 12, ratio: float = 0.72) -> tuple[int, int, float] | None:
    """The run of at most ``most`` recognised lines that a transcript line corrects: equal digits and the highest similarity, ``ratio`` at least."""
    if len(line) < least_chars:
        return None
    digits = re.sub(r"\D", "", line)
    best = None
    for a in range(len(recognised)):
        joined = ""
        for b in range(a, min(len(recognised), a + most)):
            joined = f"{joined} {recognised[b]}".strip()
            if len(joined) > 2 * len(line) + 20:
                break
            if re.sub(r"\D", "", joined) != digits:
                continue
            r = difflib.SequenceMatcher(None, line.lower(), joined.lower(), autojunk=False).ratio()
            if r >= ratio and (best is None or r > best[2]):
                best = (a, b + 1, r)
    return best


def stale_tokens(recognised: str, structured: str) -> dict[str, list[str]]:
    """Tokens of a recognised text against a structured one: repeated there, one digit off from there, or only here."""
    have = set(re.findall(r"\S+", structured.lower()))
    out: dict[str, list[str]] = {"repeat": [], "variant": [], "own": []}
    for t in re.findall(r"\S+", recognised.lower()):
        near = any(len(h) == len(t) and sum(x != y for x, y in zip(h, t, strict=True)) == 1 and any(x != y and x.isdigit() and y.isdigit() for x, y in zip(h, t, strict=True)) for h in have)
        out["repeat" if t in have else "variant" if near else "own"].append(t)
    return out


def transcript_runs(lines: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(s3_fileid, page, fragment_no, first_line, lines, ratio): for each text of ``transcripts`` the run of its page's recognised lines that it corrects.

    A page's lines are gathered as one array, bounded by the page; texts without such a run give no row.
    """
    page = lines.groupBy("s3_fileid", "page").agg(F.sort_array(F.collect_list(F.struct("line_no", "line_id", "text"))).alias("l"))
    both = transcripts.filter("fragment_type = 'text' and text is not null").select("fragment_no", "s3_fileid", F.col("position.page").alias("page"), "text").join(page, ["s3_fileid", "page"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for no, file, page_no, text, recognised in pdf.itertuples(index=False):
                got = best_run(" ".join(text.split()), [r["text"] or "" for r in recognised])
                if got:
                    out.append((file, page_no, no, int(recognised[got[0]]["line_no"] or 0), got[1] - got[0], round(got[2], 6)))
            yield pd.DataFrame(out, columns=["s3_fileid", "page", "fragment_no", "first_line", "lines", "ratio"])

    return both.select("fragment_no", "s3_fileid", "page", "text", "l").mapInPandas(run, "s3_fileid string, page int, fragment_no long, first_line int, lines int, ratio double")


def record_text(parts: list[tuple[str, F.Column]]) -> F.Column:
    """A record's text from its named parts in a fixed order; parts without content leave no trace."""
    return F.concat_ws("\n", *[F.when(F.trim(c) != "", F.concat(F.lit(f"{name}: "), c)) for name, c in parts])

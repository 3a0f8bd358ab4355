"""Text from scanned pages repaired into paragraphs.

* Margins: edge lines whose text recurs with masked digits on the edges of other pages of the file, placed or not, are page numbers or running
  headers and footers; so are lines in the top and bottom bands of a page that recur nowhere but stand apart from the body.
* Words: all words of the corpus are grouped by a confusable-glyph skeleton. In a group a form that the word list does not know gives way to a form
  that can have been misread as it, if the word list knows that form or the corpus holds it many times as often; among several
  the one seen beside the same neighbour wins, then the more frequent. Tokens with digits, bars or two alphabets are read part by part as digits or letters
  throughout; a reading whose shape the corpus uses many times as often as the token's own wins.
* Reflow: SQL windows find the next body line on the page (over page breaks by a join on file and page); words cut at a line end are joined unless
  the corpus writes them with a hyphen inside lines. Paragraphs go on over page breaks.

Nothing is collected: word counts, skeleton groups, shapes and line links are DataFrames; Python sees edge lines, pairs of a skeleton and distinct odd tokens only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.session import table_bytes, written

# What a glyph is misread as, as pairs of the right form and the misread one.
MISREAD_RU = (("о", "0"), ("н", "п"), ("е", "с"), ("т", "г"), ("и", "н"), ("в", "8"), ("л", "п"), ("д", "л"), ("б", "6"), ("з", "3"), ("п", "н"), ("ч", "4"), ("ц", "п"), ("ш", "щ"), ("м", "ni"), ("ы", "ьi"), ("ю", "lо"), ("ю", "l0"), ("ж", "ж<"))
MISREAD_EN = (("e", "c"), ("o", "0"), ("t", "f"), ("a", "u"), ("s", "5"), ("l", "1"), ("i", "1"), ("g", "9"), ("b", "6"), ("v", "y"), ("n", "ri"), ("m", "rn"), ("h", "li"), ("z", "2"), ("i", "|"), ("l", "|"), ("rn", "m"), ("ri", "n"), ("li", "h"))
#: Letters that stand for digits in numbers.
DIGIT_ALIKE = {"O": "0", "o": "0", "О": "0", "о": "0", "l": "1", "I": "1", "|": "1", "i": "1", "З": "3", "з": "3", "Ч": "4", "ч": "4", "S": "5", "s": "5", "б": "6", "b": "6", "Б": "6", "В": "8", "B": "8", "в": "8", "g": "9", "q": "9", "Z": "2", "z": "2"}
TOP, BOTTOM = 0.06, 0.955
MARKS = "-‐¬­"
OFTEN = 8

_CLASS = {c: r for r, cs in (("н", "нпилдц"), ("е", "ес"), ("т", "тг"), ("о", "о0"), ("в", "в8"), ("б", "б6"), ("з", "з3"), ("ч", "ч4"), ("ш", "шщ")) for c in cs}
_CLASS_EN = {c: r for r, cs in (("e", "ec"), ("o", "o0"), ("t", "tf"), ("a", "au"), ("s", "s5"), ("l", "l1i|"), ("g", "g9"), ("b", "b6"), ("v", "vy"), ("z", "z2")) for c in cs}
_RU_MULTI = re.compile("ni|ьi|lо|l0|ж<")
_EN_MULTI = re.compile("ri|rn|li")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?()«»\"'…—–[]"


@lru_cache(100_000)
def skeleton(word: str) -> str:
    """One string for all forms of a lower-case word that can be misread for each other."""
    if re.search("[а-яё]", word):
        w = _RU_MULTI.sub(lambda m: {"ni": "м", "ьi": "ы", "ж<": "ж"}.get(m[0], "ю"), word)
        return "".join(_CLASS.get(c, c) for c in w)
    w = _EN_MULTI.sub(lambda m: {"ri": "n", "rn": "m", "li": "h"}[m[0]], word)
    return "".join(_CLASS_EN.get(c, c) for c in w)


def misreadings(right: str, seen: str) -> int:
    """How many misread glyphs turn ``right`` into ``seen``; -1 if they cannot."""
    table = MISREAD_RU if re.search("[а-яё]", right) else MISREAD_EN
    best = {(0, 0): 0}
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop(0)
        cost = best[i, j]
        steps = []
        if i < len(right) and j < len(seen) and right[i] == seen[j]:
            steps.append((i + 1, j + 1, 0))
        if i < len(right):
            steps += [(i + len(a), j + len(b), 1) for a, b in table if right.startswith(a, i) and seen.startswith(b, j)]
        for x, y, c in steps:
            if cost + c < best.get((x, y), 99):
                best[x, y] = cost + c
                todo.append((x, y))
    return best.get((len(right), len(seen)), -1)


def where_misread(right: str, seen: str, cut: int) -> tuple[bool, bool]:
    """Whether misread glyphs lie before and after position ``cut`` of ``seen``."""
    k = misreadings(right, seen)
    for i in range(len(right) + 1):
        a, b = misreadings(right[:i], seen[:cut]), misreadings(right[i:], seen[cut:])
        if a >= 0 and b >= 0 and a + b == k:
            return a > 0, b > 0
    return True, True


def numeric(t: str) -> str:
    return "".join(DIGIT_ALIKE.get(c, c) for c in t)


# ---------------------------------------------------------------- tokens that are no plain words

_SEGMENT = re.compile(r"[\w|<]+|[^\w|<]+")
_RUSSIAN, _LATIN = re.compile("[а-яёА-ЯЁ]"), re.compile("[a-zA-Z]")
#: Letters that digits and bars stand for in words.
LETTER_RU = {"0": "о", "3": "з", "4": "ч", "6": "б", "8": "в"}
LETTER_EN = {"0": "o", "1": "l", "2": "z", "5": "s", "6": "b", "9": "g", "|": "i"}
_MULTI = {"ni": "м", "ьi": "ы", "ж<": "ж", "lо": "ю", "l0": "ю"}


def shape(t: str) -> str:
    """The pattern of a token: 9 for a run of digits, x, C or X for letters of one alphabet (small, with a capital, capitals; y and Y for a single letter), m for letters of two."""

    def one(m: re.Match[str]) -> str:
        run = m[0]
        if run[0].isdigit():
            return "9"
        if len(run) == 1:
            return "Y" if run.isupper() else "y"
        if _RUSSIAN.search(run) and _LATIN.search(run):
            return "m"
        return "X" if run.isupper() else "C" if run[0].isupper() else "x"

    return re.sub(r"\d+|[^\W\d_]+", one, t)


def lettered(segment: str) -> list[str]:
    """Readings of a part of a token as letters of the alphabet that most of its letters belong to; none if a sign in it stands for no letter."""
    russian, latin = len(_RUSSIAN.findall(segment)), len(_LATIN.findall(segment))
    if not russian and not latin:
        return []
    low = segment.lower()
    if russian:
        out = re.sub("ni|ьi|ж<|lо|l0", lambda m: _MULTI[m[0]], low)
        forms = ["".join(LETTER_RU.get(c, c) for c in out)]
    else:
        forms = ["".join(LETTER_EN.get(c, c) for c in low), "".join({**LETTER_EN, "1": "i", "|": "l"}.get(c, c) for c in low)]
    pure = _LATIN if russian else _RUSSIAN
    return [_cased(segment, f) for f in dict.fromkeys(forms) if f.isalpha() and not pure.search(f)]


def readings(t: str) -> list[tuple[str, str]]:
    """(right form, its shape) for each way to read the parts of a token as digits or as letters throughout: one part changed, or all that mix."""
    parts = _SEGMENT.findall(t)
    options: list[list[str]] = []
    for p in parts:
        got = []
        if (d := numeric(p)).isdigit() and d != p:
            got.append(d)
        # a mark before a number keeps its letters
        first = next((i for i, c in enumerate(p) if c.isdigit()), 0)
        if first and (d := numeric(p[first:])).isdigit() and d != p[first:]:
            got.append(p[:first] + d)
        letters = [x for x in lettered(p) if x != p]
        # on its own a part is a word only if letters make up most of it; among other parts the corpus' shapes decide
        digits = sum(c.isdigit() for c in p)
        wordlike = sum(c.isalpha() for c in p) >= 4 and 3 * digits < len(p)
        got += letters if len(parts) > 1 or wordlike else []
        options.append(got)
    mixes = [len({c.isdigit() for c in p if c.isalnum()}) > 1 or "|" in p or "<" in p or shape(p) == "m" for p in parts]
    changed = [parts[:k] + [o] + parts[k + 1 :] for k, got in enumerate(options) for o in got]
    for last in (0, -1):
        changed.append([got[last] if m and got else p for p, m, got in zip(parts, mixes, options, strict=True)])
    forms = dict.fromkeys("".join(c) for c in changed)
    return [(f, shape(f)) for f in forms if f != t]


TOKEN_READINGS = "n long, tok string, shape string, right string, right_shape string"


def _readings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 4096):
            out = []
            for t, n in pdf[["tok", "n"]].iloc[at : at + 4096].itertuples(index=False):
                own = shape(t)
                out.append((n, t, own, None, None))
                out.extend((n, t, own, f, s) for f, s in readings(t))
            yield pd.DataFrame(out, columns=["n", "tok", "shape", "right", "right_shape"])


def token_fixes(odd: DataFrame, words: DataFrame) -> DataFrame:
    """(tok, right) from (tok, n): tokens with digits, bars or mixed alphabets that give way to a reading whose shape the corpus uses ``OFTEN`` times as often.

    ``words`` (word, n) are the plain words: they count for the shapes of words, and of readings of one shape a word that they hold wins.
    """
    lettered_ones, numbers = odd.filter(F.col("tok").rlike(r"(?U)[\p{L}|<]")), odd.filter(~F.col("tok").rlike(r"(?U)[\p{L}|<]"))
    read = lettered_ones.select("tok", "n").repartition(cores(odd), "tok").mapInPandas(_readings, TOKEN_READINGS)
    none = F.lit(None).cast("string")
    read = written(read.unionByName(numbers.select("n", "tok", F.regexp_replace("tok", r"(?U)\d+", "9").alias("shape"), none.alias("right"), none.alias("right_shape"))), "scan-readings")
    shapes = read.filter("right is null").groupBy("shape").agg(F.sum("n").alias("k"))
    # plain words are no rows of ``odd``: all of them stand behind the shapes of words
    plain = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("k"))
    pure = plain.select(F.explode(F.array(*[F.lit(x) for x in ("x", "C", "X")])).alias("shape"), "k")
    shapes = written(shapes.unionByName(pure).groupBy("shape").agg(F.sum("k").alias("k")), "scan-shapes")
    tries = read.filter("right is not null").join(shapes.withColumnRenamed("k", "own"), "shape")
    tries = tries.join(shapes.select(F.col("shape").alias("right_shape"), "k"), "right_shape").filter(F.col("k") >= OFTEN * F.col("own"))
    known = words.select(F.col("word").alias("low"), F.col("n").alias("seen"))
    tries = tries.withColumn("low", F.lower("right")).join(known, "low", "left")
    return tries.groupBy("tok").agg(F.max_by("right", F.struct(F.coalesce("seen", F.lit(0)), "k", "right")).alias("right"))


# ---------------------------------------------------------------- margins

# Words that stand before a page number, and between it and the number of pages.
PAGE_WORDS, OF_WORDS = frozenset("стр страница лист л с page p pg sheet".split()), frozenset("/ из of от".split())
_PAGE_PART = re.compile(r"[^\W_]+(?:\|+[^\W_]*)*|\|+[^\W_]*(?:\|+[^\W_]*)*|/")
_GLUED = re.compile(rf"({'|'.join(sorted(PAGE_WORDS, key=len, reverse=True))})(\d+)", re.I)


def page_number(text: str) -> int | None:
    """The number of a line that only numbers the page, its misread digits taken as digits."""
    parts: list[str] = []
    for m in _PAGE_PART.finditer(text):
        glued = _GLUED.fullmatch(m[0])
        parts += glued.groups() if glued else [m[0]]
        if len(parts) > 4:
            return None
    if parts and parts[0].lower() in PAGE_WORDS:
        parts = parts[1:]
    of = len(parts) == 3 and parts[1].lower() in OF_WORDS
    numbers = [numeric(p) for p in (parts[::2] if of else parts)]
    if len(numbers) != 1 + of or not all(n.isdigit() for n in numbers):
        return None
    n = int(numbers[0]) if len(numbers[0].lstrip("0")) < 10 else -1
    return n if n >= 0 else None


def mask(text: str) -> str:
    """The words of a line as skeletons, its numbers left out, misread ones too."""
    return " ".join(skeleton(w) for w in re.findall(r"[\w|]+", text.lower()) if not numeric(w).isdigit())


EDGE_INFO = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("masked", T.StringType())])


@F.pandas_udf(EDGE_INFO)
def _edge_info(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"number": [page_number(t) for t in texts], "masked": [mask(t) for t in texts]}).astype({"number": "Int32"})


#: Lines of unknown pages are taken in stretches of so many line numbers.
STRETCH, NO_PAGE = 1000, -(1 << 30)


def unit() -> Column:
    """What is laid out together: a page, or a stretch of the lines whose page is not known."""
    return F.when(F.col("page") > 0, F.col("page")).otherwise(NO_PAGE + F.floor(F.col("line_no") / STRETCH)).cast("int")


def margins(lines: DataFrame, top: float = TOP, bottom: float = BOTTOM) -> DataFrame:
    """Adds ``unit`` and ``place``: body, header or pageno; ``bbox`` becomes ``y``. The result is partitioned by file and unit.

    An edge line (the two outermost lines of a page, or in a band) is furniture if the edges of other pages of the file hold its masked text, or its number at
    the same distance from the page's; outside the bands on most pages of the file or of the stretch from its first to its last. One that recurs nowhere is furniture only in a band: apart from the body by
    clearly more than the body's pitch, or alone where other pages of the file have such furniture.
    """
    lines = lines.withColumn("unit", unit()).withColumn("y", F.col("bbox.y1")).drop("bbox")
    page = Window.partitionBy("s3_fileid", "unit")
    y = F.col("y")
    above, below = F.coalesce(y < top, F.lit(False)), F.coalesce(y > bottom, F.lit(False))
    band, inner = above | below, y.between(top, bottom)
    stats = {
        "first": F.min("line_no"), "last": F.max("line_no"), "low": F.min(F.when(inner, y)), "high": F.max(F.when(inner, y)),
        "steps": F.max(F.when(inner, F.col("line_no"))) - F.min(F.when(inner, F.col("line_no"))),
        "head": F.max(F.when(above, y)), "foot": F.min(F.when(below, y)), "heads": F.count_if(above), "feet": F.count_if(below),
    }
    df = lines.select("*", F.struct(*[v.over(page).alias(k) for k, v in stats.items() if k != "steps"], (F.max(F.when(inner, F.col("line_no"))).over(page) - F.min(F.when(inner, F.col("line_no"))).over(page)).alias("steps")).alias("s"))
    near = (F.col("page") > 0) & ((F.col("line_no") <= F.col("s.first") + 1) | (F.col("line_no") >= F.col("s.last") - 1))
    # only edge lines leave the JVM
    edges = df.filter(near | band).withColumn("info", _edge_info("text"))
    number = F.col("info.number")
    gap = F.when(above, F.col("s.low") - F.col("s.head")).when(below, F.col("s.foot") - F.col("s.high"))
    edges = edges.select(
        "s3_fileid", "unit", "page", "line_id", number.alias("number"), F.when(above, "above").when(below, "below").alias("zone"),
        F.when(above, F.col("s.heads") == 1).when(below, F.col("s.feet") == 1).alias("alone"), y.isNull().alias("unplaced"),
        (band & F.coalesce(gap * F.col("s.steps") > 1.25 * (F.col("s.high") - F.col("s.low")), F.lit(True))).alias("apart"),
        F.col("text").rlike(r"(?iuU)[-—–\[(/|]|стр|лист|page|из|of|p\.").alias("decorated"),
        F.when(number.isNotNull(), F.concat(F.lit("#"), number - F.col("page"))).otherwise(F.col("info.masked")).alias("masked"),
    )
    edges = written(edges, "scan-edges")
    said = edges.filter("masked <> ''")
    keys = said.groupBy("s3_fileid", "masked", "unit").agg(F.max(F.col("zone").isNotNull()).alias("held")).groupBy("s3_fileid", "masked").agg(F.max("held").alias("held"), F.count("*").alias("pages"), F.min("unit").alias("p"), F.max("unit").alias("q")).filter("pages > 1")
    lengths = said.groupBy("s3_fileid").agg((F.max("unit") - F.min("unit") + 1).alias("length"))
    # outside the bands a heading of the body can stand at the edges of a few scattered pages
    steady = "2 * pages > length or 2 * pages >= q - p + 1 and (pages > 2 or q = p + 1)"
    keys = keys.join(lengths, "s3_fileid").select("s3_fileid", "masked", "held", F.expr(steady).alias("steady"))
    again = said.join(keys, ["s3_fileid", "masked"]).filter("zone is not null or steady or unplaced and held")
    # the only line of a band where the file's furniture stands on other pages
    alike = said.filter("alone").join(again.filter("zone is not null").select("s3_fileid", "zone").distinct(), ["s3_fileid", "zone"], "left_semi")
    recurring = again.select("line_id").unionByName(alike.select("line_id")).distinct().withColumn("recurs", F.lit(True))
    judged = edges.join(recurring, "line_id", "left")
    furniture = F.coalesce("recurs", "apart")
    is_no = F.col("number").isNotNull() & (furniture | (F.col("number") == F.col("page")) | (F.col("decorated") & (F.col("zone").isNotNull() | F.col("unplaced"))))
    place = F.when(is_no, "pageno").when(furniture, "header")
    # gathered by page, so that the lines need not move again; a page has few edge lines
    placed = judged.select("s3_fileid", "unit", "line_id", place.alias("place")).filter("place is not null").groupBy("s3_fileid", "unit", "line_id").agg(F.struct("line_id", F.max("place").alias("place")).alias("e"))
    by_page = placed.groupBy("s3_fileid", "unit").agg(F.map_from_entries(F.collect_set("e")).alias("__edges"))
    df = lines.join(by_page, ["s3_fileid", "unit"], "left")
    return df.withColumn("place", F.coalesce(F.element_at("__edges", F.col("line_id")), F.lit("body"))).drop("__edges")


def ends_of(text: Column) -> list[Column]:
    """Whether a line ends in a hyphen, the open last part of its last word, and the first word."""
    t = F.btrim(text, F.lit(" \t\xa0"))
    marked = t.rlike(rf"(?U)[\p{{L}}\p{{N}}][{MARKS}]\z")
    tail = F.ltrim(F.regexp_extract(t, rf"(?U)([^\s{MARKS}]+)[{MARKS}]\z", 1), F.lit(_EDGE))
    head = F.nullif(F.regexp_extract(t, r"(?U)\A[\w|<]+", 0), F.lit(""))
    return [marked.alias("marked"), F.when(marked, tail).alias("tail"), head.alias("head")]


def linked(lines: DataFrame) -> DataFrame:
    """Adds for body lines ``next_head`` (first word of the next body line, over a page break too) and ``after_mark`` (the last
    word of the line before, if it ends in a hyphen). Furniture takes part in the windows as null, so lines move once; over page breaks only the first and last
    body lines of pages are joined. The result is written."""
    body = F.col("place") == "body"
    lines = lines.select("*", *ends_of(F.col("text")))
    page = Window.partitionBy("s3_fileid", "unit").orderBy("line_no")
    later, sooner = page.rangeBetween(1, Window.unboundedFollowing), page.rangeBetween(Window.unboundedPreceding, -1)
    head, end = F.when(body, F.struct("head")), F.when(body, F.struct("marked", "tail"))
    df = lines.withColumn("__next", F.first(head, True).over(later)).withColumn("__prev", F.last(end, True).over(sooner))
    open_end, open_start = body & F.col("__next").isNull(), body & F.col("__prev").isNull()
    df = df.withColumn("next_head", F.when(body & F.col("marked"), F.col("__next")["head"])).withColumn("after_mark", F.when(body & F.col("__prev")["marked"], F.col("__prev")["tail"]))
    df = written(df.withColumn("first", open_start).withColumn("last", open_end).drop("__next", "__prev"), "scan-pages")
    at = F.struct("line_no", "line_id")
    edges = df.filter("first or last").select("s3_fileid", "unit", "line_no", "line_id", "first", "last", "head", "marked", "tail")
    ahead = edges.filter("first").groupBy("s3_fileid", (F.col("unit") - 1).alias("unit")).agg(F.min_by("head", at).alias("__over"))
    behind = edges.filter("last").groupBy("s3_fileid", (F.col("unit") + 1).alias("unit")).agg(F.max_by(F.struct("marked", "tail"), at).alias("__under"))
    over = edges.filter("last and marked").select("s3_fileid", "unit", "line_id").join(ahead, ["s3_fileid", "unit"]).select("line_id", F.col("__over"), F.lit(None).cast("string").alias("__tail"))
    under = edges.filter("first").select("s3_fileid", "unit", "line_id").join(behind.filter("__under.marked"), ["s3_fileid", "unit"]).select("line_id", F.lit(None).cast("string").alias("__over"), F.col("__under.tail").alias("__tail"))
    links = over.unionByName(under).groupBy("line_id").agg(F.max("__over").alias("__over"), F.max("__tail").alias("__tail"))
    mended = df.filter("first or last").join(links, "line_id", "left").withColumn("next_head", F.coalesce("next_head", "__over")).withColumn("after_mark", F.coalesce("after_mark", "__tail"))
    mended = written(mended.select(*df.columns), "scan-page-ends")
    return df.filter("not (first or last)").unionByName(mended).drop("first", "last")


# ---------------------------------------------------------------- words


#: White space other than a plain blank.
_WIDE = "\t\n\x0b\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def tokens_of(text: Column) -> Column:
    """The tokens between white space, without punctuation around them; an empty string where nothing is left of one, or two blanks follow each other."""
    plain = F.btrim(F.when(text.rlike(f"[{_WIDE}]"), F.translate(text, _WIDE, " " * len(_WIDE))).otherwise(text))
    edge = re.escape(_EDGE + MARKS)
    return F.split(F.regexp_replace(plain, rf"[{edge}]+(?= |\z)|(?<![^ ])[{edge}]+", ""), " ")


def odd(t: Column) -> Column:
    """Whether a token is no plain word: a digit or bar in it, letters of two alphabets, or a letter that can be a digit alone."""
    return t.rlike(r"[\p{Nd}|]|ж<") | (t.rlike("[a-zA-Z]") & t.rlike("[а-яёА-ЯЁ]")) | t.isin("l", "I")


def odd_tokens(lines: DataFrame, *keep: str) -> DataFrame:
    """(tok, and the columns ``keep``) of all tokens that are no plain words."""
    t = F.col("text")
    some = lines.filter(t.rlike(r"[\p{Nd}|]|ж<|(?<![a-zA-Z])[lI](?![a-zA-Z])") | (t.rlike("[a-zA-Z]") & t.rlike("[а-яёА-ЯЁ]")))
    return some.select(*keep, F.explode_outer(tokens_of(t)).alias("tok")).filter(odd(F.col("tok")))


# explode_outer below: for explode the optimizer adds a filter that evaluates the array's expression a second time


def words_of(lines: DataFrame) -> DataFrame:
    """(line_id, word, cut, side, left): the words of lines with links; a cut word is whole, with the place of the cut and the side that the line holds."""
    held = lines.select("line_id", *[F.lower(c).alias(c) for c in ("tail", "next_head", "after_mark", "head")], tokens_of(F.lower("text")).alias("toks"))
    each = held.select("*", F.posexplode_outer("toks").alias("i", "tok")).filter("tok <> ''")
    first, last = F.col("i") == 0, F.col("i") == F.size("toks") - 1
    tail = last & F.col("tail").isNotNull()
    joins, joined = tail & F.col("next_head").isNotNull(), first & F.col("after_mark").isNotNull() & F.col("head").isNotNull()
    parts = F.when(joins, F.array(F.concat("tail", "next_head"))).when(joined, F.array(F.concat("after_mark", "head"))).when(tail, F.array().cast("array<string>"))
    parts = parts.when(F.contains("tok", F.lit("-")) & F.col("tok").rlike(r"(?U)\A[\p{L}-]+\z"), F.split("tok", "-")).otherwise(F.array("tok"))
    cut = F.when(joins, F.length("tail")).when(joined, F.length("after_mark")).otherwise(-1)
    side = F.when(joins, "tail").when(joined, "head").otherwise("")
    left = F.when(first, "").otherwise(F.element_at("toks", F.greatest(F.col("i"), F.lit(1))))
    return each.select("line_id", F.explode_outer(parts).alias("word"), cut.alias("cut"), side.alias("side"), left.alias("left")).filter("word <> ''")


# ---------------------------------------------------------------- corrections

# as character mappings, for expressions
_FROM_RU, _TO_RU = "".join(_CLASS), "".join(_CLASS.values())
_FROM_EN, _TO_EN = "".join(_CLASS_EN), "".join(_CLASS_EN.values())


def skeleton_of(word: Column) -> Column:
    """``skeleton`` as an expression."""
    ru = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "ni", "\x01"), "ьi", "ы"), "l[о0]", "ю"), "ж<", "ж")
    en = F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "ri", "\x01"), "rn", "m"), "li", "h")
    return F.when(word.rlike("[а-яё]"), F.translate(ru, "\x01" + _FROM_RU, "м" + _TO_RU)).otherwise(F.translate(en, "\x01" + _FROM_EN, _CLASS_EN.get("n", "n") + _TO_EN))


def cores(df: DataFrame) -> int:
    """Pieces for small tables on which much is computed; asked for by number, they are not joined again."""
    return 2 * df.sparkSession.sparkContext.defaultParallelism


@F.pandas_udf(T.IntegerType())
def _misreadings(right: pd.Series, seen: pd.Series) -> pd.Series:
    return pd.Series([misreadings(a, b) for a, b in zip(right, seen, strict=True)], dtype="int32")


@F.pandas_udf(T.BooleanType())
def _on_side(right: pd.Series, seen: pd.Series, cut: pd.Series, side: pd.Series) -> pd.Series:
    return pd.Series([s == "" or where_misread(r, w, c)[0 if s == "tail" else 1] for r, w, c, s in zip(right, seen, cut, side, strict=True)], dtype=bool)


def small(source: DataFrame, most_bytes: int = 16 << 20) -> Callable[[DataFrame], DataFrame]:
    """A broadcast hint for what is derived from a read or written table, if that table's size allows one."""
    return F.broadcast if table_bytes(source) < most_bytes else lambda df: df


def cuts(least: int, most: Column) -> Column:
    return F.explode(F.sequence(F.lit(least), F.least(most, F.length("word") - 3)))


def corrections(words: DataFrame, word_list: DataFrame, used: DataFrame) -> DataFrame:
    """(seen, right) from (word, n): forms that give way to a better supported form of their skeleton group.

    A form gives way to one that it can be misread from, if the word list knows that one or the corpus holds it ``OFTEN`` times as often. Of several
    those with the fewest misread glyphs stay; of these the one that ``used`` (word, left) shows most often after the same left neighbours wins, then a listed one, then the
    more frequent. A form with very many misread glyphs needs such a neighbour.

    Compounds of a listed word and one of the prefixes that the word list uses often count as listed.
    """
    listed = word_list.filter("word is not null").select(F.lower("word").alias("word")).distinct()
    few = small(word_list)
    # prefixes: beginnings that leave another listed word behind, often
    halves = listed.filter(F.length("word") > 7).withColumn("k", F.explode(F.sequence(F.lit(4), F.length("word") - 3)))
    halves = halves.select(F.expr("substring(word, 1, k)").alias("prefix"), F.expr("substring(word, k + 1)").alias("word"))
    prefixes = written(halves.join(listed, "word").groupBy("prefix").agg(F.count("*").alias("n")).filter("n >= 15").select("prefix"), "scan-prefixes")
    longest = prefixes.agg(F.max(F.length("prefix"))).first()[0] or 0  # one number
    compounds = words.filter(F.length("word") > 7).withColumn("k", cuts(4, F.lit(longest)))
    compounds = compounds.select("word", F.expr("substring(word, 1, k)").alias("prefix"), F.expr("substring(word, k + 1)").alias("rest"))
    as_listed = compounds.join(few(prefixes), "prefix").join(few(listed.withColumnRenamed("word", "rest")), "rest", "left_semi").select("word")
    everything = words.select("word", "n", F.lit(False).alias("listed")).unionByName(listed.unionByName(as_listed).distinct().select("word", F.lit(0).cast("long").alias("n"), F.lit(True).alias("listed")))
    forms = everything.groupBy("word").agg(F.sum("n").alias("n"), F.max("listed").alias("listed")).withColumn("skeleton", skeleton_of(F.col("word")))
    forms = written(forms, "scan-forms")
    seen, known = forms.filter("not listed and n > 0"), forms.filter("listed or n > 1").filter(F.col("word").rlike(r"(?U)\A\p{L}+\z"))
    pairs = seen.select(F.col("word").alias("seen"), F.col("n").alias("times"), "skeleton").join(known.select(F.col("word").alias("right"), "n", "listed", "skeleton"), "skeleton")
    pairs = pairs.filter((F.col("seen") != F.col("right")) & (F.col("listed") | (F.col("n") >= OFTEN * F.col("times")))).repartition(cores(words), "seen")
    options = pairs.withColumn("m", _misreadings("right", "seen")).filter("m > 0").withColumn("least", F.min("m").over(Window.partitionBy("seen"))).filter("m = least")
    options = written(options.select("seen", "right", "n", "listed", (F.col("m") > F.greatest(F.lit(2), F.floor(F.length("right") / 5))).alias("many")), "scan-options")
    open_ones = options.groupBy("seen").agg(F.count("*").alias("c"), F.max("many").alias("many")).filter("c > 1 or many").select("seen")
    rivals = written(options.join(open_ones, "seen").select("seen", "right"), "scan-rivals")
    beside = used.select(F.col("word").alias("seen"), "left").filter("left <> ''").join(small(rivals)(rivals.select("seen").distinct()), "seen").distinct()
    wanted = written(beside.join(rivals, "seen"), "scan-wanted")
    context = used.select(F.col("word").alias("right"), "left").filter("left <> ''").join(small(wanted)(wanted), ["right", "left"]).groupBy("seen", "right").agg(F.count("*").alias("k"))
    ranked = options.join(context, ["seen", "right"], "left").withColumn("k", F.coalesce("k", F.lit(0))).filter("k > 0 or not many")
    direct = written(ranked.groupBy("seen").agg(F.max_by("right", F.struct("k", "listed", "n", "right")).alias("right")), "scan-direct")
    # a misread compound: a beginning misread from a prefix, a rest misread from a listed word; two misread glyphs make it two signs longer at most
    doubtful = seen.select("word").join(direct.select(F.col("seen").alias("word")), "word", "left_anti")
    parts = doubtful.filter(F.length("word") > 7).withColumn("k", cuts(4, F.lit(longest + 2)))
    parts = parts.select("word", skeleton_of(F.expr("substring(word, 1, k)")).alias("ps"), skeleton_of(F.expr("substring(word, k + 1)")).alias("rs"))
    shown = prefixes.withColumn("ps", skeleton_of(F.col("prefix")))
    rests = listed.withColumnRenamed("word", "whole").withColumn("rs", skeleton_of(F.col("whole")))
    maybe = parts.join(few(shown), "ps").join(few(rests), "rs").select("word", F.concat("prefix", "whole").alias("right")).distinct().repartition(cores(words), "word")
    by_part = maybe.withColumn("m", _misreadings("right", "word")).filter("m > 0 and m <= 2").groupBy(F.col("word").alias("seen")).agg(F.min_by("right", F.struct("m", "right")).alias("right"))
    return direct.unionByName(by_part)


class Analysis:
    """What the repair of scanned lines is made from, each a written table: ``seen`` lines with place and links, ``used`` words of the lines, ``fixes`` (seen, right) of
    words, ``token_fixes`` (tok, right) of other tokens, ``wholes`` (word, n) of words that no line end cuts."""

    def __init__(self, lines: DataFrame, word_list: DataFrame):
        kept = lines.filter("text is not null and line_id is not null")
        self.odd = written(odd_tokens(kept.withColumn("scanned", F.coalesce(F.col("method") == "tesseract", F.lit(False))), "line_id", "scanned"), "scan-odd")
        own = kept.filter("method = 'tesseract'").select("line_id", "s3_fileid", F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("line_no", F.lit(0)).alias("line_no"), "text", "bbox")
        self.seen = linked(margins(own))
        self.told = self.seen.filter("place <> 'pageno'")
        self.used = written(words_of(self.told), "scan-words")
        words = self.used.filter(F.col("word").rlike(r"(?U)\A[\p{L}\d|<]*\p{L}[\p{L}\d|<]*\z"))
        # a cut word stands once on either side of the cut: counted by its tail
        counts = written(words.groupBy("word").agg(F.count_if(F.col("side") != "head").alias("n"), F.count_if(F.col("side") == "").alias("whole")), "scan-counts")
        self.wholes = counts.filter("whole > 0").select("word", F.col("whole").alias("n"))
        self.fixes = written(corrections(counts.filter("n > 0").select("word", "n"), word_list, self.used), "scan-corrections")
        listed = word_list.select(F.lower("word").alias("low"))
        odd = self.odd.groupBy("tok").agg(F.count("*").alias("n")).withColumn("low", F.lower("tok")).join(small(word_list)(listed), "low", "left_anti")
        plain = counts.filter(F.col("word").rlike(r"(?U)\A\p{L}{2,}\z") & ~F.col("word").rlike("[а-яё][a-z]|[a-z][а-яё]"))
        self.token_fixes = written(token_fixes(odd.select("tok", "n"), plain.select("word", "n")), "scan-tokens")


    def odd_lines(self) -> DataFrame:
        """(line_id, tok, right) of the scanned lines' tokens that give way to another reading."""
        return self.odd.filter("scanned").join(small(self.token_fixes)(self.token_fixes), "tok")


def defects(lines: DataFrame, word_list: DataFrame) -> DataFrame:
    """(line_id, kind): hyphen, misread, header, pageno. Null texts have none; re-read lines are judged each."""
    a = Analysis(lines, word_list)
    few = small(word_list)
    kinds = [a.seen.filter("place <> 'body'").select("line_id", F.col("place").alias("kind"))]
    # words cut at the line end, unless the corpus writes the two parts with a hyphen inside lines
    spelled = lines.filter("contains(text, '-')").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\p{L}+-\p{L}+"), F.lit(0))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    spelled = written(spelled, "scan-pairs")
    cut = a.seen.filter("tail is not null").select("line_id", F.lower("tail").alias("a"), F.lower("next_head").alias("b"))
    cut = cut.withColumn("pair", F.concat_ws("-", "a", "b")).withColumn("whole", F.concat("a", "b"))
    listed = word_list.select(F.lower("word").alias("whole"), F.lit(True).alias("listed")).distinct()
    ends = cut.filter("b is not null").select("pair", "whole").distinct()
    judged = ends.join(small(spelled)(spelled), "pair", "left").join(few(listed), "whole", "left").join(a.wholes.select(F.col("word").alias("whole"), F.col("n").alias("seen_whole")), "whole", "left")
    # the pairs that are compounds: few
    compound = judged.filter((F.coalesce("n", F.lit(0)) > F.coalesce("seen_whole", F.lit(0))) & F.col("listed").isNull()).select("pair", "whole")
    compound = written(compound, "scan-compounds")
    kinds.append(cut.filter("b is not null").join(small(compound)(compound.select("pair")), "pair", "left_anti").select("line_id", F.lit("hyphen").alias("kind")))
    # the file ends here: cut, unless the part begins compounds elsewhere
    begins = spelled.groupBy(F.substring_index("pair", "-", 1).alias("a")).agg(F.sum("n").alias("n"))
    kinds.append(cut.filter("b is null").join(begins.filter("n > 1"), "a", "left_anti").select("line_id", F.lit("hyphen").alias("kind")))
    # misread words: not the parts of a compound that was joined here by mistake; listed words are never wrong, without them the common words stay where they are
    listed_words = word_list.filter("word is not null").select(F.lower("word").alias("word")).distinct()
    doubtful = a.used.drop("left").join(few(listed_words), "word", "left_anti")
    wrong = doubtful.join(small(a.fixes)(a.fixes.withColumnRenamed("seen", "word")), "word").join(small(compound)(compound.select(F.col("whole").alias("word"))), "word", "left_anti")
    kinds.append(wrong.filter(_on_side("right", "word", "cut", "side")).select("line_id", F.lit("misread").alias("kind")))
    numbers = a.seen.filter("place = 'pageno'").select("line_id")
    kinds.append(a.odd_lines().join(numbers, "line_id", "left_anti").select("line_id", F.lit("misread").alias("kind")))
    return reduce(DataFrame.unionByName, kinds).distinct()


def page_chains(pages: DataFrame, stretch: int = 1000) -> DataFrame:
    """(s3_fileid, unit, from_unit) from (s3_fileid, unit, goes_on, n): the page that holds the beginning of the paragraph which a page's first line continues.

    A page begins a chain if nothing runs into it, or if more than one paragraph stands on it. The nearest beginning before a page is looked for in stretches of page
    numbers, and the last beginning of each stretch is carried on, so a file of very many pages is no single task.
    """
    p = pages.withColumn("__s", F.floor(F.col("unit") / stretch)).withColumn("__b", F.when(~F.col("goes_on") | (F.col("n") > 1), F.col("unit")))
    carry = p.groupBy("s3_fileid", "__s").agg(F.max("__b").alias("__c"))
    carry = carry.withColumn("__c", F.max("__c").over(Window.partitionBy("s3_fileid").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)))
    near = F.max("__b").over(Window.partitionBy("s3_fileid", "__s").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1))
    out = p.withColumn("__n", near).join(carry, ["s3_fileid", "__s"])
    return out.filter("goes_on").select("s3_fileid", "unit", F.coalesce("__n", "__c").alias("from_unit"))


def paragraphs(lines: DataFrame, word_list: DataFrame) -> DataFrame:
    """(s3_fileid, page, paragraph, text): the body of each file, repaired and reflowed; page and number are those where the paragraph begins.

    A paragraph ends where a line ends a sentence well short of the page's width; at a page's last line it ends with any sentence, and goes on over the page break
    otherwise, over however many pages. Header and page number lines are
    left out, cut words joined, misread words and numbers replaced by their right form. Re-read lines count once (the last read). Lines of unknown pages stand under page 0; where one stretch of
    them follows another there is no page break, so a paragraph ends there as it does between any two lines.
    """
    a = Analysis(lines, word_list)
    body = a.seen.filter("place = 'body'")
    once = body.groupBy("s3_fileid", "unit", "line_no").agg(F.max_by(F.struct("line_id", "page", "text", "tail", "next_head", "after_mark"), "line_id").alias("l")).select("s3_fileid", "unit", "line_no", "l.*")
    words = a.used.join(small(a.fixes)(a.fixes.withColumnRenamed("seen", "word")), "word").select("line_id", "word", "right")
    odd = a.odd_lines().select("line_id", F.concat(F.lit("\x01"), "tok").alias("word"), "right")
    mine = words.unionByName(odd).groupBy("line_id").agg(F.collect_set(F.struct("word", "right")).alias("fix"))
    page = Window.partitionBy("s3_fileid", "unit")
    df = once.join(mine, "line_id", "left").withColumn("__wide", F.max(F.length("text")).over(page))
    sentence = F.col("text").rlike(r"[.!?:;]\s*$")
    df = df.withColumn("__ends", sentence & (F.length("text") < 0.8 * F.col("__wide")))
    df = df.withColumn("__stop", F.when(F.col("unit") < 0, F.col("__ends")).otherwise(sentence))
    df = df.withColumn("__new", F.coalesce(F.lag("__ends").over(page.orderBy("line_no")), F.lit(True)).cast("int"))
    df = df.withColumn("paragraph", F.sum("__new").over(page.orderBy("line_no")).cast("int"))

    @F.pandas_udf(T.StringType())
    def repaired(text: pd.Series, fix: pd.Series, tail: pd.Series, next_head: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series([repair_line(*x) for x in zip(text, fix, tail, next_head, after, strict=True)])

    df = df.withColumn("__t", repaired("text", "fix", "tail", "next_head", "after_mark"))
    df = written(df.select("s3_fileid", "unit", "page", "paragraph", "line_no", "__t", "__stop"), "scan-reflow")
    pages = df.groupBy("s3_fileid", "unit").agg(F.max_by("__stop", "line_no").alias("stop"), F.max("paragraph").alias("n"))
    before = pages.select("s3_fileid", (F.col("unit") + 1).alias("unit"), (~F.col("stop")).alias("goes_on"))
    pages = pages.join(before, ["s3_fileid", "unit"], "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False)))
    pages = written(pages.select("s3_fileid", "unit", "goes_on", "n"), "scan-pages")
    chains = page_chains(pages).join(pages.select("s3_fileid", F.col("unit").alias("from_unit"), F.col("n").alias("__at")), ["s3_fileid", "from_unit"])
    df = df.join(chains, ["s3_fileid", "unit"], "left")
    moved = (F.col("paragraph") == 1) & F.col("from_unit").isNotNull()
    start = F.when(moved, F.col("from_unit")).otherwise(F.col("unit"))
    df = df.select("s3_fileid", start.alias("start"), F.when(moved, F.col("__at")).otherwise(F.col("paragraph")).alias("paragraph"), "unit", "line_no", "__t").filter("__t <> ''")
    text = df.groupBy("s3_fileid", "start", "paragraph").agg(F.expr("listagg(__t, ' ') within group (order by struct(unit, line_no))").alias("text"))
    # lines of unknown pages: a stretch holds fewer paragraphs than lines
    number = F.when(F.col("start") < 0, (F.col("start") - NO_PAGE) * STRETCH + F.col("paragraph")).otherwise(F.col("paragraph"))
    return text.select("s3_fileid", F.greatest("start", F.lit(0)).alias("page"), number.cast("int").alias("paragraph"), "text")


def repair_line(text: str, fix, tail: str | None, next_head: str | None, after: str | None) -> str:
    """A line with its cut words joined and its misread words and tokens replaced; the second part of a cut word went to the line before."""
    fixes = {f["word"]: f["right"] for f in fix} if fix is not None else {}
    t = text.strip()
    if after:
        t = re.sub(r"^[\w|<]+", "", t).lstrip(MARKS)
    joined = ""
    if tail and next_head:
        whole = (tail + next_head).lower()
        t = t.rstrip(MARKS)[: -len(tail)]
        joined = _cased(tail, fixes.get(whole, whole))

    def word(m: re.Match[str]) -> str:
        low = m[0].lower()
        return _cased(m[0], fixes[low]) if low in fixes else m[0]

    def token(m: re.Match[str]) -> str:
        core = m[0].strip(_EDGE + MARKS)
        new = re.sub(r"[\w|<]+", word, m[0])
        right = fixes.get("\x01" + core)
        return m[0].replace(core, right) if right is not None and new == m[0] else new

    return (_TOKEN.sub(token, t) + joined).strip() if fixes else (t + joined).strip()


def _cased(like: str, word: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word[:1].upper() + word[1:] if like[:1].isupper() else word


def found(lines: DataFrame, word_list: DataFrame) -> DataFrame:
    return defects(lines, word_list)

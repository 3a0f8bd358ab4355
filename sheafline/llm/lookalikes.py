"""Visually identical text brought to one form.

Three steps. (1) Compatibility forms (full width, ligatures, odd spaces) are replaced, invisible characters deleted, combining marks composed or
dropped. Superscripts, fractions, №, typographic quotes and signs are visible and stay. (2) Each word that mixes alphabets, or
could be read whole in another one, becomes a lattice: at each place the letters of each alphabet that look like the one written.
A Viterbi search finds the best path under character trigrams of each alphabet; leaving an alphabet inside a word costs ``SWITCH``, and
words that the word list or the corpus knows get ``KNOWN``. (3) The alphabet of the line around a word enters as a prior. Tokens with
digits or a degree sign (designations, marks, units) have no dictionary; their prior is how the whole corpus writes tokens of that shape.

How the corpus writes shapes and words (its habits) is a written table. A first pass over the lines finds the doubtful words; each distinct one is joined with the habits
that bear on it and read once, and its reading goes back to the lines by a join. Nothing of the corpus comes to the driver.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.glyphs import INVISIBLE, SPACES
from sheafline.session import table_bytes, written

# Letters that look alike in print, one group a row: Latin, Cyrillic, Greek (a blank where there is none).
GROUPS = (
    "AАΑ", "BВΒ", "CС ", "EЕΕ", "HНΗ", "IІΙ", "JЈ ", "KКΚ", "MМΜ", "N Ν", "OОΟ", "PРΡ", "SЅ ", "TТΤ", "XХΧ", "YУΥ", "Z Ζ",
    "aаα", "cсϲ", "eе ", "iіι", "jј ", "kкκ", "oоο", "pрρ", "sѕ ", "v ν", "xхχ", "yуγ", "hһ ", "dԁ ", "qԛ ", "wԝ ", "u υ", "n η",
)
LATIN, CYRILLIC, GREEK = range(3)
#: Letters that Russian does not use: never a reading that is proposed, only one that is taken back.
FOREIGN = frozenset("ІЈЅіјѕһԁԛԝ")
READINGS = {c: g for g in GROUPS for c in g if c != " "}
SWITCH, KNOWN, CONTEXT, SUBSTITUTE, RARE = 9.0, 4.0, 3.0, 0.35, 8

COMPAT = re.compile("[！-｠￠-￦ﬀ-ﭏ]")
SPACE = re.compile(f"[{SPACES}\t]")
HIDDEN = re.compile(f"[{INVISIBLE}]")
LETTERS = re.compile(r"[^\W\d_]+")
UNUSUAL = re.compile("[^\x00-\x7fА-яЁё–—•№«»°±²³½…≥≤×⌀µ]")


def script(c: str) -> int:
    if c < "ʰ":
        return LATIN if c != "µ" and c != "ª" and c != "º" else -1
    if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
        return GREEK
    if "Ѐ" <= c <= "ԯ":
        return CYRILLIC
    return LATIN if "Ḁ" <= c <= "ỿ" else -1


def simple_form(text: str) -> tuple[str, bool]:
    """Step one, and whether it changed anything."""
    if not UNUSUAL.search(text) and "\t" not in text:
        return text, False
    t = COMPAT.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    t = SPACE.sub(" ", HIDDEN.sub("", t))
    if any(unicodedata.combining(c) for c in t):
        t = unicodedata.normalize("NFC", t)
        t = "".join(c for c in t if not unicodedata.combining(c))
    return t, t != text


class Reader:
    """Character trigrams by alphabet and the word list; ``habits`` (key, count for each alphabet) says how a corpus writes shapes and words, ``table`` holds them as a table."""

    def __init__(self, words: list[tuple[str, str]], habits: dict[str, list[int]] | None = None, table: DataFrame | None = None):
        self.known = {w for w, _ in words if w}
        self.habits, self.table = habits or {}, table
        self.tri: list[Counter[str]] = [Counter(), Counter(), Counter()]
        self.bi: list[Counter[str]] = [Counter(), Counter(), Counter()]
        for w in self.known:
            s = script(w[0])
            if s < 0:
                continue
            padded = f"^^{w}$"
            for i in range(2, len(padded)):
                self.tri[s][padded[i - 2 : i + 1]] += 1
                self.bi[s][padded[i - 2 : i]] += 1

    def letter(self, s: int, context: str, c: str) -> float:
        return math.log((self.tri[s][context + c] + 0.02) / (self.bi[s][context] + 0.02 * 40))

    def word(self, word: str, prior: int, habit: int, code: bool, known: frozenset[str] = frozenset()) -> str:
        """The best reading of a run of letters; ``prior`` is the alphabet of its surroundings, ``habit`` of its shape (-1: none), ``known`` the corpus' own words among its readings."""
        # a Greek letter among others is a symbol; Greek words have several letters of their own, or stand in Greek
        greek = prior == GREEK or sum(c not in READINGS and script(c) == GREEK for c in word) > 1
        options: list[list[tuple[int, str, float]]] = []
        for c in word:
            own = script(c)
            here = [(own, c, 0.0)]
            for s, x in enumerate(READINGS.get(c, "")):
                if x not in (" ", c) and x not in FOREIGN and (s != GREEK or greek):
                    here.append((s, x, SUBSTITUTE))
            options.append(here)
        best: dict[tuple[int, str], tuple[float, str]] = {(-1, "^^"): (0.0, "")}
        for here in options:
            step: dict[tuple[int, str], tuple[float, str]] = {}
            for (s0, ctx), (score, path) in best.items():
                for s, c, cost in here:
                    low = c.lower()
                    gain = score - cost
                    if s0 >= 0 and s != s0:
                        gain -= SWITCH
                    if not code:
                        # an alphabet without words in the list has no trigrams: its letters are equally likely
                        gain += self.letter(s, ctx, low)
                    state = (s, (ctx + low)[-2:])
                    if state not in step or gain > step[state][0]:
                        step[state] = (gain, path + c)
            best = step
        final, chosen = -1e18, word
        for (s, ctx), (score, path) in best.items():
            scripts = {script(c) for c in path}
            whole = s if len(scripts) == 1 else -1
            if not code:
                if s in (LATIN, CYRILLIC):
                    score += self.letter(s, ctx, "$")
                if path.lower() in self.known or path.lower() in known:
                    score += KNOWN
            if habit >= 0:
                score += CONTEXT * 2 * (whole == habit)
            elif prior >= 0:
                score += CONTEXT * (whole == prior)
            if score > final:
                final, chosen = score, path
        return chosen

    def look(self, text: str) -> tuple[str, bool, list[tuple[int, int, str, int, list[str]]]]:
        """(form of step one, whether it changed anything, doubtful words as (start, end, word, alphabet around it, keys of the habits that bear on it))."""
        t, changed = simple_form(text)
        prior = alphabet_of(t)
        doubts = []
        for m in LETTERS.finditer(t):
            w = m[0]
            scripts = {script(c) for c in w}
            if -1 in scripts or len(scripts) == 1 and (any(c not in READINGS for c in w) or GREEK in scripts and len(w) == 1):
                continue  # one alphabet with a letter of its own, or a lone Greek letter: a symbol
            token, place = surrounding(t, m.start(), m.end())
            shape = shape_of(token)
            if shape:
                keys = [f"{shape}@{place}"]
            elif len(scripts) == 1 and (prior in scripts or prior < 0 and w.lower() in self.known):
                continue
            else:
                keys = [f"w:{x}" for x in whole_readings(w.lower()) if x not in self.known]
            doubts.append((m.start(), m.end(), w, prior, keys))
        return t, changed, doubts

    def read(self, word: str, prior: int, keys: list[str], habits: dict[str, list[int]]) -> str:
        """The reading of a doubtful word, given the habits of its keys."""
        code = bool(keys) and not keys[0].startswith("w:")
        single = len({script(c) for c in word}) == 1
        if code:
            seen = habits.get(keys[0])
            if seen and sum(seen):
                return self.word(word, prior, max(range(3), key=lambda s: seen[s]), True)
            return word if single else self.word(word, prior, -1, True)
        # a reading that the corpus shows far less often than another is a slip itself
        times = {k[2:]: sum(habits[k]) for k in keys if k in habits}
        known = frozenset(x for x, n in times.items() if RARE * n >= max(times.values()))
        low = word.lower()
        if single and low in known and (prior < 0 or not any(x != low and (x in known or x in self.known) for x in whole_readings(low))):
            return word  # the corpus writes it so, and no other reading is a word
        return self.word(word, prior, -1, False, known)

    def line(self, text: str) -> tuple[str, bool, bool]:
        """(one form, whether characters were of another form, whether letters were of another alphabet), with the habits in memory."""
        t, changed, doubts = self.look(text)
        fixes = [(a, b, x) for a, b, w, prior, keys in doubts if (x := self.read(w, prior, keys, self.habits)) != w]
        return re.sub("ь[iі]", "ы", put(t, fixes)), changed, bool(fixes) or "ьi" in t or "ьі" in t


def put(text: str, fixes: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, x in sorted(fixes):
        out += [text[at:a], x]
        at = b
    return "".join([*out, text[at:]])


def whole_readings(word: str) -> list[str]:
    """The readings of a word in one alphabet throughout."""
    out = []
    for s in range(3):
        letters = [c if script(c) == s else READINGS.get(c, "   ")[s] for c in word]
        if " " not in letters:
            out.append("".join(letters))
    return out


def alphabet_of(t: str) -> int:
    """The alphabet of most letters that belong to one alphabet only, or -1."""
    counts = [0, 0, 0]
    for c in t:
        if c.isalpha() and c not in READINGS:
            s = script(c)
            if s >= 0:
                counts[s] += 1
    top = max(range(3), key=lambda s: counts[s])
    return top if counts[top] else -1


def surrounding(t: str, start: int, end: int) -> tuple[str, int]:
    """The token between blanks around a run of letters, and the run's ordinal in it."""
    a = t.rfind(" ", 0, start) + 1
    b = t.find(" ", end)
    token = t[a : b if b >= 0 else len(t)]
    return token, sum(1 for m in LETTERS.finditer(t, a, start))


@lru_cache(50_000)
def shape_of(token: str) -> str:
    """The pattern of a token with digits or a degree sign; nothing for words. Runs of digits are one sign, runs of other signs five at most."""
    token = token.strip(".,;:!?()«»\"'")
    if not any(c.isdigit() or c == "°" for c in token):
        return ""
    s = "".join("9" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c if c in "°.,-/%" else "?" for c in token)
    return re.sub(r"9+", "9", re.sub(r"(.)\1{5,}", r"\1\1\1\1\1", s))


def _habits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter[tuple[str, int]] = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            t, _ = simple_form(text)
            around = alphabet_of(t)
            for m in LETTERS.finditer(t):
                token, place = surrounding(t, m.start(), m.end())
                shape = shape_of(token)
                if not shape and all(c in READINGS for c in m[0]):
                    scripts = {script(c) for c in m[0]}
                    if scripts == {around}:
                        seen[f"w:{m[0].lower()}", around] += 1
                elif shape:
                    scripts = {script(c) for c in m[0] if c not in READINGS} or {script(c) for c in m[0]}
                    if len(scripts) == 1 and -1 not in scripts:
                        seen[f"{shape}@{place}", scripts.pop()] += 1
    yield pd.DataFrame([(k, s, n) for (k, s), n in seen.items()], columns=["shape", "script", "n"])


def fit(lines: DataFrame, word_list: DataFrame, text: str = "text", most_words: int = 2_000_000) -> Reader:
    """A reader from the word list (a table that does not grow; above ``most_words`` it is refused) and all lines of the corpus.

    The habits are a written table: for each shape of token, and each word made of nothing but look-alike letters that stands among its own alphabet, how often each alphabet
    was used. The latter count as known words.
    """
    words = [(r["word"], r["lang"]) for r in word_list.filter("word is not null").select("word", "lang").limit(most_words + 1).collect()]
    if len(words) > most_words:
        raise ValueError(f"the word list has more than {most_words} words")
    plain = lines.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    counts = plain.mapInPandas(_habits, "shape string, script int, n long").groupBy(F.col("shape").alias("key"))
    return Reader(words, table=written(counts.agg(*[F.coalesce(F.sum(F.when(F.col("script") == s, F.col("n"))), F.lit(0)).alias(f"s{s}") for s in range(3)]), "habits"))


DOUBT = "array<struct<start: int, end: int, word: string, prior: int, keys: array<string>>>"
LOOK = f"struct<form: string, changed: boolean, doubts: {DOUBT}>"
SMALL = 8 << 20


def one_form(df: DataFrame, reader: Reader, text: str = "text", out: str = "one") -> DataFrame:
    """Adds ``out`` = struct(form, disguised) for a text column; null stays null and is not disguised, other columns are untouched.

    A column of the name ``out`` is replaced.
    """
    words = sorted(reader.known)
    cell: list[Reader] = []

    def own() -> Reader:
        if not cell:
            cell.append(Reader([(w, "") for w in words]))
        return cell[0]

    @F.pandas_udf(LOOK)
    def look(texts: pd.Series) -> pd.DataFrame:
        got = [own().look(t) if t is not None else (None, False, []) for t in texts]
        return pd.DataFrame({"form": [g[0] for g in got], "changed": [g[1] for g in got], "doubts": [[dict(zip(("start", "end", "word", "prior", "keys"), d, strict=True)) for d in g[2]] for g in got]})

    @F.pandas_udf("string")
    def read(word: pd.Series, prior: pd.Series, keys: pd.Series, said: pd.Series) -> pd.Series:
        return pd.Series([own().read(w, int(p), list(k), {h["key"]: [h["s0"], h["s1"], h["s2"]] for h in h_} if h_ is not None else {}) for w, p, k, h_ in zip(word, prior, keys, said, strict=True)], dtype=object)

    @F.pandas_udf("string")
    def mended(form: pd.Series, fixes: pd.Series) -> pd.Series:
        return pd.Series([put(f, [(x["start"], x["end"], x["read"]) for x in xs]) for f, xs in zip(form, fixes, strict=True)], dtype=object)

    def few(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if table_bytes(table) < SMALL else table

    seen = written(df.withColumn("__look", look(F.col(text))), "looks")
    doubtful = seen.filter(F.size("__look.doubts") > 0).select(F.col(text).alias("__text"), "__look").dropDuplicates(["__text"])
    each = written(doubtful.select("__text", F.col("__look.form").alias("form"), F.explode("__look.doubts").alias("d")).select("__text", "form", "d.*"), "doubts")
    asked = each.select("word", "prior", "keys").distinct()
    if reader.table is not None:
        # each distinct word with the habits of its keys; the habits stay where they are if the keys are few
        keys = written(asked.select(F.explode("keys").alias("key")).distinct(), "doubt-keys")
        habits = written(reader.table.join(few(keys), "key"), "doubt-habits")
        said = asked.select("word", "prior", "keys", F.explode("keys").alias("key")).join(few(habits), "key").groupBy("word", "prior", "keys").agg(F.collect_list(F.struct("key", "s0", "s1", "s2")).alias("said"))
        asked = asked.join(said, ["word", "prior", "keys"], "left")
    else:
        asked = asked.withColumn("said", F.lit(None).cast("array<struct<key: string, s0: bigint, s1: bigint, s2: bigint>>"))
    cores = 2 * df.sparkSession.sparkContext.defaultParallelism
    readings = asked.repartition(cores, "word").withColumn("read", read("word", "prior", "keys", "said")).filter("read <> word").select("word", "prior", "keys", "read")
    readings = written(readings, "readings")
    fixes = each.join(few(readings), ["word", "prior", "keys"]).groupBy("__text").agg(F.first("form").alias("form"), F.collect_list(F.struct("start", "end", "read")).alias("fixes"))
    fixed = written(fixes.select("__text", mended("form", "fixes").alias("__fixed")), "fixed")
    # lines without a doubt have no key and stay apart from the join's hot keys
    key = F.when(F.size("__look.doubts") > 0, F.col(text))
    joined = seen.withColumn("__key", key).join(few(fixed.withColumnRenamed("__text", "__key")), "__key", "left")
    form = F.coalesce("__fixed", "__look.form")
    disguised = F.coalesce(F.col("__look.changed") | F.col("__fixed").isNotNull() | F.col("__look.form").rlike("ь[iі]"), F.lit(False))
    return joined.withColumn(out, F.struct(F.regexp_replace(form, "ь[iі]", "ы").alias("form"), disguised.alias("disguised"))).drop("__look", "__key", "__fixed")


VISIBLE_FROM = "".join(c for g in GROUPS for c in g[1:] if c != " ")
VISIBLE_TO = "".join(g[0] for g in GROUPS for c in g[1:] if c != " ")


def visible(form: str | F.Column) -> F.Column:
    """What is to be seen of a form: look-alike letters merged, case kept."""
    return F.translate(F.col(form) if isinstance(form, str) else form, VISIBLE_FROM, VISIBLE_TO)


def changes(df: DataFrame, reader: Reader, before: str = "before", after: str = "after") -> DataFrame:
    """Adds ``visible_change``: whether the change can be seen; false for a change without effect, null where a side is null."""
    both = one_form(one_form(df, reader, before, "__b"), reader, after, "__a")
    differs = visible(F.col("__b.form")) != visible(F.col("__a.form"))
    return both.withColumn("visible_change", differs).drop("__a", "__b")


def found(lines: DataFrame, edits: DataFrame, word_list: DataFrame) -> DataFrame:
    """(rec_table, rec_id): disguised text-layer lines, and changes of characters that do not show."""
    layer = lines.filter("method = 'text_layer' and text is not null").select("line_id", "text")
    reader = fit(layer, word_list)
    a = one_form(layer, reader).filter("one.disguised").select(F.lit("text_lines").alias("rec_table"), F.col("line_id").alias("rec_id"))
    moved = edits.filter("before is not null and after is not null and before <> after").select("change_id", "before", "after")
    b = changes(moved, reader).filter("not visible_change").select(F.lit("text_changes").alias("rec_table"), F.col("change_id").alias("rec_id"))
    return a.unionByName(b).distinct()

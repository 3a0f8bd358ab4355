"""Folding of visually identical text: one skeleton per visible form, used wherever texts are compared."""

from __future__ import annotations

import re
import unicodedata

# Letters that look alike, given as (folded form, look-alikes); Latin, Cyrillic and Greek.
# The fold is for comparison only; case is folded first.
ALIKE = (
    ("a", "аα"), ("b", "вβ"), ("c", "сϲ"), ("d", "ԁ"), ("e", "еεё"), ("h", "нһη"), ("i", "іιı"), ("j", "ј"), ("k", "кκ"), ("m", "мμ"),
    ("o", "оο"), ("p", "рρ"), ("q", "ԛ"), ("s", "ѕ"), ("t", "тτ"), ("v", "ѵν"), ("w", "ԝ"), ("x", "хχ"), ("y", "уγυ"), ("z", "ζ"),
)
#: Characters that have no visible form of their own.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋᠌᠍᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩⁪⁫⁬⁭⁮⁯︀︁︎️﻿"
#: Spaces other than U+0020 that stand inside a line.
SPACES = "               　"

_FOLD = {ord(x): base for base, others in ALIKE for x in others}
_FOLD |= dict.fromkeys(map(ord, INVISIBLE))
_NOT_WORD = re.compile(r"[\W_]+")
_MARKS = re.compile("[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃿]")
# a character that NFKC may change or that is a mark: everything outside ASCII, Cyrillic and a few signs
_UNUSUAL = re.compile("[^\x00-\x7fЀ-џ–—•№«»°]")


def fold(text: str) -> str:
    """Compatibility form without invisible characters and loose marks, lower case, look-alikes merged."""
    if _UNUSUAL.search(text):
        text = _MARKS.sub("", unicodedata.normalize("NFKC", text))
    # the digraph ьi is a way to write ы
    return text.lower().replace("ьi", "ы").replace("ьі", "ы").translate(_FOLD)


def fold_words(text: str) -> list[str]:
    """Words between white space, folded, without punctuation; words of punctuation only are dropped."""
    return [w for w in (_NOT_WORD.sub("", x) for x in fold(text).split()) if w]


def stream(text: str) -> str:
    """Letters and digits only, folded: spacing, line breaks, hyphenation and punctuation leave no trace."""
    return _NOT_WORD.sub("", fold(text))

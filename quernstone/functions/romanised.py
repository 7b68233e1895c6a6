"""Telugu in Latin letters: a consonant carries the vowel a unless a vowel sign or the mute sign follows it."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The letters of the script in its own order, and their Latin forms.
CONSONANTS = dict(zip("కఖగఘఙచఛజఝఞటఠడఢణతథదధనపఫబభమయరఱలళవశషసహౘౙ", "k kh g gh ng ch chh j jh ny t th d dh n t th d dh n p ph b bh m y r r l l v sh sh s h ts dz".split(), strict=True))
VOWELS = dict(zip("అఆఇఈఉఊఋౠఌౡఎఏఐఒఓఔ", "a aa i ii u uu r rr l ll e ee ai o oo au".split(), strict=True))
SIGNS = dict(zip("ా ి ీ ు ూ ృ ౄ ె ే ై ొ ో ౌ ౢ ౣ".split(), "aa i ii u uu r rr e ee ai o oo au l ll".split(), strict=True))
MUTE = "్"
OTHERS = dict(zip("ఁంః", "nmh", strict=True)) | {chr(0x0C66 + d): str(d) for d in range(10)}
# Surrogates, which no text has: before a sign, after a consonant, and in place of what has no sound.
SIGN, BARE, NOTHING = "\ud800", "\ud801", "\ud802"
LETTERS = {chr(c): NOTHING for c in range(0x0C00, 0x0C80)} | OTHERS | VOWELS | {c: SIGN + x for c, x in SIGNS.items()} | {MUTE: SIGN} | {c: x + BARE for c, x in CONSONANTS.items()}
ACCENTS = re.compile(f"[{''.join(c for c in map(chr, range(0x0370)) if unicodedata.combining(c))}]+")


def romanise(text: str) -> str:
    """Lower-case Latin letters, without accents and with single blanks; no letter of the script is left, other scripts stay."""
    # a sign or the mute sign right after a consonant takes the place of its vowel; elsewhere a sign is its own vowel
    latin = unicodedata.normalize("NFC", text)
    for letter, sound in LETTERS.items():
        if letter in latin:
            latin = latin.replace(letter, sound)
    latin = latin.replace(BARE + SIGN, "").replace(BARE, "a").replace(SIGN, "").replace(NOTHING, "")
    if not latin.isascii():
        latin = unicodedata.normalize("NFC", ACCENTS.sub("", unicodedata.normalize("NFD", latin)))
    return " ".join(latin.lower().split())


@F.pandas_udf(StringType())
def _romanised(text: pd.Series) -> pd.Series:
    return text.map(romanise, na_action="ignore")


def romanised(text: Column) -> Column:
    """romanise() of a column; pure ASCII doesn't go to Python."""
    ascii_only = text.rlike(r"\A\p{ASCII}*\z")
    plain = F.trim(F.regexp_replace(F.lower(text), r"[\s\x1c-\x1f]+", " "))
    return F.when(ascii_only, plain).otherwise(_romanised(F.when(~ascii_only, text)))

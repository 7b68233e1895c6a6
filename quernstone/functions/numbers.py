"""Numbers as words, and the text normaliser that needs them (an Arrow function: built-ins can't spell numbers)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import text as T

#: English number words and the ordinals that aren't regular.
SMALL = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
GROUPS = ("", "thousand", "million", "billion", "trillion", "quadrillion", "quintillion")
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
NUMBER = re.compile(r"\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?")
ORDINAL = re.compile(r"\b(\d+)(?:st|nd|rd|th)\b", re.IGNORECASE)


def below_thousand(n: int) -> str:
    parts = [SMALL[n // 100] + " hundred"] if n >= 100 else []
    rest = n % 100
    if rest >= 20:
        parts.append(TENS[rest // 10 - 2] + (f"-{SMALL[rest % 10]}" if rest % 10 else ""))
    elif rest or not parts:
        parts.append(SMALL[rest])
    return " and ".join(parts)


def cardinal(n: int) -> str:
    """As in "one thousand, two hundred and thirty-four"; beyond the names of groups a ValueError."""
    if n >= 1000 ** len(GROUPS):
        raise ValueError(n)
    if n < 1000:
        return below_thousand(n)
    groups, k = [], 0
    while n:
        n, part = divmod(n, 1000)
        if part:
            groups.append((k, part))
        k += 1
    said = [below_thousand(p) + (f" {GROUPS[k]}" if k else "") for k, p in reversed(groups)]
    last_k, last = groups[0]
    joint = " and " if last_k == 0 and last < 100 else ", "
    return ", ".join(said[:-1]) + joint + said[-1] if len(said) > 1 else said[0]


def ordinal(n: int) -> str:
    said = cardinal(n)
    cut = max(said.rfind(" "), said.rfind("-")) + 1
    last = said[cut:]
    return said[:cut] + ORDINALS.get(last, last[:-1] + "ieth" if last.endswith("y") else last + "th")


#: Telugu numerals, 0 to 19 and the tens from 20; the word for the point; (size, one of them, several).
TELUGU_SMALL = ("సున్నా", "ఒకటి", "రెండు", "మూడు", "నాలుగు", "ఐదు", "ఆరు", "ఏడు", "ఎనిమిది", "తొమ్మిది", "పది", "పదకొండు", "పన్నెండు", "పదమూడు", "పద్నాలుగు", "పదిహేను", "పదహారు", "పదిహేడు", "పద్దెనిమిది", "పంతొమ్మిది")
TELUGU_TENS = ("ఇరవై", "ముప్పై", "నలభై", "యాభై", "అరవై", "డెబ్బై", "ఎనభై", "తొంభై")
TELUGU_POINT = "బిందువు"
TELUGU_LARGE = ((10_000_000, "కోటి", "కోట్ల"), (100_000, "లక్ష", "లక్షల"), (1000, "వెయ్యి", "వేల"), (100, "వంద", "వందల"))


def telugu(n: int) -> str:
    """A whole number in Telugu, by crores, lakhs, thousands and hundreds."""
    if n < 20:
        return TELUGU_SMALL[n]
    if n < 100:
        ten = TELUGU_TENS[n // 10 - 2]
        return f"{ten} {TELUGU_SMALL[n % 10]}" if n % 10 else ten
    for size, one, several in TELUGU_LARGE:
        if n >= size:
            many, rest = divmod(n, size)
            said = one if many == 1 else f"{telugu(many)} {several}"
            return f"{said} {telugu(rest)}" if rest else said
    raise ValueError(n)


def number(token: str, language: str | None = "en") -> str:
    """A number as written, said; what can't be said stays."""
    plain = token.replace(",", "")
    say, small, point = (telugu, TELUGU_SMALL, TELUGU_POINT) if language == "te" else (cardinal, SMALL, "point")
    try:
        if "." in plain:
            whole, part = repr(float(plain)).split(".")
            return f"{say(int(whole))} {point} {' '.join(small[int(d)] for d in part)}"
        return say(int(plain))
    except (ValueError, IndexError):
        return plain


def ordinal_token(match: re.Match) -> str:
    try:
        return ordinal(int(match[1]))
    except ValueError:
        return match[1]


@F.pandas_udf(StringType())
def spoken_numbers(texts: pd.Series, languages: pd.Series) -> pd.Series:
    said = lambda t, lang: NUMBER.sub(lambda m: number(m[0], lang), t if lang == "te" else ORDINAL.sub(ordinal_token, t))
    return pd.Series([None if t is None else said(t, lang) for t, lang in zip(texts, languages, strict=True)], dtype=object)


def spoken(text: Column, language: Column) -> Column:
    """Text as it is read aloud: currency and abbreviations (English), numbers, symbols, white space."""
    english = T.spoken_abbreviations(T.spoken_currency(text))
    read = F.when(language == "en", english).otherwise(text)
    # texts without a digit stay in the JVM
    digit = read.rlike(r"\p{Nd}")
    said = F.when(digit, spoken_numbers(F.when(digit, read), language)).otherwise(read)
    return T.collapsed(T.spoken_symbols(said, language))

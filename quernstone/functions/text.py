"""Text and score functions: Column -> Column, inside whole-stage code generation but for Unicode composition."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Marks that end a complete transcript.
TERMINAL = (".", "!", "?", "।", "॥", '"', "'", ")", "]", "}", "”")
#: English abbreviations and how they are read, in the order in which they are expanded.
ABBREVIATIONS = (
    (r"\be\.g\.", "for example"),
    (r"\bi\.e\.", "that is"),
    (r"\bDr\.", "doctor"),
    (r"\bMr\.", "mister"),
    (r"\bMrs\.", "missus"),
    (r"\bMs\.", "miss"),
    (r"\bJr\.", "junior"),
    (r"\bSr\.", "senior"),
    (r"\bvs\.", "versus"),
    (r"\betc\.", "et cetera"),
)
#: How symbols are read, by language.
SYMBOLS = {"en": (("%", " percent"), ("&", " and ")), "te": (("%", " శాతం"), ("&", " మరియు "))}
#: Marks that error rates leave out without a blank (dandas, zero-width marks, quotes, dashes).
LEFT_OUT = "।॥“”‘’–—…\u200b\u200c\u200d"
#: A model's emotion labels in the project's terms.
FOLDED = {
    "angry": "angry", "anger": "angry", "disgusted": "angry", "disgust": "angry",
    "happy": "happy", "happiness": "happy", "excited": "excited", "excitement": "excited",
    "sad": "sad", "sadness": "sad", "neutral": "neutral", "calm": "calm",
    "surprised": "surprised", "surprise": "surprised",
    "fearful": "fearful", "fear": "fearful", "other": "neutral", "unknown": "neutral",
}
#: Valence and arousal of the eight emotions.
VALENCE_AROUSAL = {"neutral": (0.0, 0.0), "calm": (0.3, -0.5), "sad": (-0.6, -0.4), "happy": (0.7, 0.4), "excited": (0.6, 0.8), "angry": (-0.6, 0.7), "fearful": (-0.5, 0.5), "surprised": (0.2, 0.8)}
#: Yes and no of audit sheets.
YES, NO = ("y", "yes", "1", "true"), ("n", "no", "0", "false")


def words(text: Column) -> Column:
    """Lower-cased words between Unicode white space; null gives an empty array."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != "")


def token_set(text: Column) -> Column:
    return F.array_distinct(words(text))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def latin_fraction(text: Column) -> Column:
    """ASCII letters among all letters; 0 without letters."""
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(text, "[^A-Za-z]", "")), F.length(F.regexp_replace(text, r"\P{L}", ""))), F.lit(0.0))


def duplicate_key(text: Column, normalised: Column | None = None) -> Column:
    """Lower-cased words joined by one blank; the normalised text comes first if it isn't empty."""
    first = text if normalised is None else F.coalesce(F.nullif(normalised, F.lit("")), text)
    return F.array_join(words(first), " ")


def vocabulary_word(word: Column) -> Column:
    """A word without the marks around it."""
    return F.btrim(F.lower(word), F.lit(".,!?;:\"'"))


def missing(value: Column, default) -> Column:
    """default where value is null or the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default) if not isinstance(default, Column) else default)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def words_per_minute(n_words: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, n_words / seconds * 60)


def speaking_rate(n_words: Column, seconds: Column) -> Column:
    return F.coalesce(F.round(F.when(seconds > 0, n_words / seconds), 3), F.lit(0.0))


def truncated(text: Column) -> Column:
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return (t != "") & ~F.right(t, F.lit(1)).isin(*TERMINAL)


def code_mixed(text: Column, language: Column) -> Column:
    return (language != "en") & text.rlike("[A-Za-z]{2,}")


def annotated(text: Column, language: Column) -> Column:
    """Runs of Latin words of other languages in brackets; a cut transcript ends in a dash.

    Words are repeated possessively, which Java's matcher does in a loop: given back, a long run takes a stack frame a word.
    """
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    bracketed = F.when(language != "en", F.regexp_replace(t, r"([A-Za-z][A-Za-z'\-]*+(?:\s++[A-Za-z][A-Za-z'\-]*+)*+)", "[$1]")).otherwise(t)
    return F.when(truncated(text), F.concat(F.regexp_replace(bracketed, "[ .]+$", ""), F.lit(" —"))).otherwise(bracketed)


@F.pandas_udf(StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def composed(text: Column) -> Column:
    """Unicode's composed form (NFC); pure ASCII is composed as it is and doesn't go to Python."""
    plain = text.rlike(r"\A\p{ASCII}*\z")
    return F.when(plain, text).otherwise(_composed(F.when(~plain, text)))


def comparison_form(text: Column) -> Column:
    """Composed, lower-cased, without anything but word characters and white space, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(composed(text)), r"(?U)[^\w\s]", ""), r"(?U)\s+", " "))


def recognition_form(text: Column, delete: bool = False) -> Column:
    """For error rates: composed, lower-cased, tags <|..|> gone, punctuation and symbols made blanks (or deleted), collapsed."""
    t = F.translate(F.lower(F.regexp_replace(composed(text), r"<\|.*?\|>", "")), LEFT_OUT, "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[\p{P}\p{S}]", "" if delete else " "), r"(?U)\s+", " "))


def spoken_currency(text: Column) -> Column:
    t = F.regexp_replace(text, r"\$\s?(\d[\d,]*(?:\.\d+)?)", "$1 dollars")
    return F.regexp_replace(t, r"(?:Rs\.?|₹)\s?(\d[\d,]*(?:\.\d+)?)", "$1 rupees")


def spoken_abbreviations(text: Column) -> Column:
    for pattern, reading in ABBREVIATIONS:
        text = F.regexp_replace(text, f"(?iU){pattern}", reading)
    return text


def spoken_symbols(text: Column, language: Column) -> Column:
    def read(pairs):
        out = text
        for mark, reading in pairs:
            out = F.replace(out, F.lit(mark), F.lit(reading))
        return out

    return F.when(language == "te", read(SYMBOLS["te"])).otherwise(read(SYMBOLS["en"]))


def collapsed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def character_error_rate(reference: Column, heard: Column) -> Column:
    return F.when(F.length(reference) > 0, F.levenshtein(reference, heard) / F.length(reference))


def word_error_rate(reference: Column, heard: Column) -> Column:
    """Edit distance over words by the built-in one over characters: the distinct words of a row become code points."""
    a, b = F.filter(F.split(reference, r"(?U)\s+"), lambda w: w != ""), F.filter(F.split(heard, r"(?U)\s+"), lambda w: w != "")
    both = F.array_distinct(F.concat(a, b))
    # code points from 0x4E00 on, written as UTF-32
    coded = lambda ws: F.decode(F.unhex(F.array_join(F.transform(ws, lambda w: F.lpad(F.hex(F.array_position(both, w) + 0x4E00), 8, "0")), "")), "UTF-32")
    return F.when(F.size(a) > 0, F.levenshtein(coded(a), coded(b)) / F.size(a))


def z_level(z: Column) -> Column:
    # The bounds and their phrases.
    return F.when(z >= 1.0, "much higher than usual").when(z >= 0.4, "higher than usual").when(z <= -1.0, "much lower than usual").when(z <= -0.4, "lower than usual").otherwise("around this speaker's average")


def folded_label(label: Column, mapping: dict[str, str] = FOLDED, default: str = "neutral") -> Column:
    """The part before a slash, lower-cased, through a table."""
    key = F.trim(F.lower(F.split_part(label, F.lit("/"), F.lit(1))))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key], F.lit(default))


def first_known(label: Column, known: tuple[str, ...], default: str = "other") -> Column:
    parts = F.filter(F.transform(F.split(label, "/"), lambda x: F.lower(F.trim(x))), lambda x: x.isin(*known))
    return F.coalesce(F.get(parts, F.lit(0)), F.lit(default))


def checked_label(label: Column, allowed: tuple[str, ...], default: str) -> Column:
    t = F.lower(F.trim(label))
    return F.when(t.isin(*allowed), t).otherwise(default)


def checked_confidence(value: Column, bad: float = 0.3) -> Column:
    """A text as a number between 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.try_cast("double"), F.lit(bad))))


def yes_no(value: Column) -> Column:
    t = F.lower(F.trim(value))
    return F.when(t.isin(*YES), True).when(t.isin(*NO), False)


def quadrant(valence: Column, arousal: Column) -> Column:
    """A label from valence and arousal between 0 and 1, limits included; null if either is."""
    bad, good = valence <= 0.45, valence >= 0.55
    low = F.when(bad, "sad").otherwise("calm")
    high = F.when(good, "excited").when(bad, "angry").otherwise("happy")
    mid = F.when(good, "happy").when(bad, "sad").otherwise("neutral")
    return F.when(valence.isNull() | arousal.isNull(), None).when(arousal <= 0.40, low).when(arousal >= 0.60, high).otherwise(mid)


def acoustics(pitch: Column, loudness: Column, pitch_range: Column, dynamics: Column, pace: Column, harmonics: Column, voiced: Column, breath: Column) -> Column:
    """Seven lines of text on how a clip sounds next to its speaker's others; what is missing counts as 0."""
    z = lambda c: z_level(F.coalesce(c, F.lit(0.0)))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    # The phrases and their order.
    return F.concat_ws(
        "\n",
        F.concat(F.lit("- Pitch level: "), z(pitch)),
        F.concat(F.lit("- Loudness/energy: "), z(loudness)),
        F.concat(F.lit("- Pitch variation (expressiveness): "), z(pitch_range)),
        F.concat(F.lit("- Energy variation within clip: "), z(dynamics)),
        F.concat(F.lit("- Speaking pace: "), z(pace)),
        F.format_string("- Voice clarity (HNR): %.1f dB (voiced fraction %.2f)", zero(harmonics), zero(voiced)),
        F.concat(F.lit("- Breathiness (high/low band ratio): "), z(breath)),
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    n = F.sqrt(dot(v, v))
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(F.transform(v, lambda x: x.cast("double")))


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def first_object(text: str) -> str | None:
    """The first stretch between matching braces that is JSON."""
    depth = begin = 0
    for brace in re.finditer("[{}]", text):
        if brace[0] == "{":
            begin = begin if depth else brace.start()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                try:
                    json.loads(text[begin : brace.end()])
                except ValueError:
                    continue
                return text[begin : brace.end()]
    return None


@F.pandas_udf(StringType())
def _first_object(text: pd.Series) -> pd.Series:
    return text.map(first_object, na_action="ignore")


def extracted_json(answer: Column) -> Column:
    """The JSON text in a model's answer: without a code fence around it, else the first object in the prose; null if there is none.

    Only answers that aren't JSON as they are, and have a brace, go to Python.
    """
    bare = F.trim(F.regexp_replace(F.trim(F.regexp_replace(collapsed_ends(answer), "^```(json)?", "")), "```$", ""))
    plain = F.try_parse_json(bare).isNotNull()
    return F.when(plain, bare).when(bare.contains("{"), _first_object(F.when(~plain & bare.contains("{"), bare)))


def collapsed_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def judgement(found: Column, topics: tuple[str, ...]) -> Column:
    """A judge's JSON as a struct with every field in range; null if there is no JSON."""
    raw = lambda name: F.get_json_object(found, f"$.{name}")
    kind = lambda name: F.schema_of_variant(F.try_variant_get(F.try_parse_json(found), f"$.{name}", "variant"))
    # what is there and neither false, zero nor empty; the text "false" is there
    holds = lambda name: F.coalesce(F.when(kind(name) == "BOOLEAN", raw(name) == "true").otherwise(~raw(name).isin("", "0", "0.0", "[]", "{}")), F.lit(False))
    number = F.coalesce(raw("tts_suitable").try_cast("double"), F.lit(0.0))
    whole = F.struct(
        checked_label(F.coalesce(raw("topic_category"), F.lit("other")), topics, "other").alias("topic_category"),
        F.substring(F.coalesce(raw("topic"), F.lit("")), 1, 60).alias("topic"),
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)), 2).alias("tts_suitable"),
        holds("transcript_clean").alias("transcript_clean"),
        holds("emotion_supported").alias("emotion_supported"),
        F.substring(F.coalesce(raw("issue"), F.lit("")), 1, 80).alias("issue"),
    )
    return F.when(found.isNotNull(), whole)


def phoneme(token: Column) -> Column:
    """A phoneme without its stress digits; null if it isn't all letters."""
    base = F.regexp_replace(token, "[0-9]", "")
    return F.when(base.rlike(r"^\p{L}+$"), base)


def first_present(scores: Column, names: tuple[str, ...]) -> Column:
    """The first of several names that a map of scores has; NaN if it has none."""
    out = F.lit(float("nan"))
    for name in reversed(names):
        out = F.when(F.map_contains_key(scores, name), scores[name].cast("double")).otherwise(out)
    return out


def probed_seconds(said: Column) -> Column:
    """A probe's answer as seconds; 0 where it can't be read."""
    return F.coalesce(F.trim(said).try_cast("double"), F.lit(0.0))


def looked_up(document: Column, *keys: str, default: Column | None = None) -> Column:
    """The value under nested keys of a JSON text, as text; default where a key is missing or its parent is no object. A null that is there is null."""
    parent, found = document, F.lit(True)
    for k in keys:
        # json_object_keys is null for what is no object
        found = found & F.coalesce(F.array_contains(F.json_object_keys(parent), k), F.lit(False))
        parent = F.get_json_object(parent, "$['" + k.replace("'", "\\'") + "']")
    return F.when(found, parent).otherwise(F.lit(None).cast("string") if default is None else default)


def cut_rationale(rationale: Column, most: int = 160) -> Column:
    return F.substring(F.coalesce(rationale, F.lit("")), 1, most)

"""Romanisation: text of any script in ASCII letters.

Two steps, both native expressions.  One ``translate`` takes every character with a single Latin letter to it: accented
letters, and the single letters of the fixed tables below.  What is then still not ASCII is looked up once per distinct character of
the text in a map by code point, and replaced; most texts have none such and end after the first step.

The map is built from rules, not written out: the fixed tables below for Latin, Greek, Cyrillic and punctuation; CLDR's
transforms to Latin, which Spark's own ICU library applies to each code point of the blocks below; Hangul syllables from their three
letters.  Han characters have their reading in Mandarin with a capital and a space behind it (``Bei Jing ``).  A vowel sign or virama of an
Indic script takes the place of the vowel of the consonant before it.  A character that no rule knows stays.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from skyledger.functions._util import as_col

# Latin letters that have no decomposition by their usual ASCII digraphs, and Greek letters by ELOT 743 (transliteration of
# single letters, with chi as kh and upsilon as u).
TRANSLITERATION = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L",
    "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i", "ŋ": "ng", "Ŋ": "NG",
    "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ĳ": "ij", "Ĳ": "IJ",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e",
    "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "ks",
    "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u",
    "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
    "Α": "A", "Β": "B", "Γ": "G", "Δ": "D", "Ε": "E", "Ζ": "Z", "Η": "E",
    "Θ": "Th", "Ι": "I", "Κ": "K", "Λ": "L", "Μ": "M", "Ν": "N", "Ξ": "Ks",
    "Ο": "O", "Π": "P", "Ρ": "R", "Σ": "S", "Τ": "T", "Υ": "U",
    "Φ": "Ph", "Χ": "Kh", "Ψ": "Ps", "Ω": "O",
}

# Cyrillic letters by the romanisation of library catalogues (ALA-LC) without ligature ties and
# diacritics, and punctuation by its ASCII form.
TRANSLITERATION |= {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "\"", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ж": "Zh", "З": "Z", "И": "I", "К": "K", "Л": "L",
    "М": "M", "Н": "N", "О": "O", "П": "P", "Р": "R", "С": "S", "Т": "T", "У": "U", "Ф": "F", "Х": "Kh", "Ц": "Ts",
    "Ч": "Ch", "Ш": "Sh", "Щ": "Shch", "Ъ": "\"", "Ы": "Y", "Ь": "'", "Э": "E", "Ю": "Iu", "Я": "Ia",
    "і": "i", "І": "I", "є": "ie", "Є": "Ie", "ґ": "g", "Ґ": "G", "ђ": "dj", "Ђ": "Dj", "ј": "j", "Ј": "J",
    "љ": "lj", "Љ": "Lj", "њ": "nj", "Њ": "Nj", "ћ": "c", "Ћ": "C", "џ": "dz", "Џ": "Dz",
    "‘": "'", "’": "'", "‚": ",", "“": "\"", "”": "\"", "„": ",,", "–": "-", "—": "--", "‐": "-", "‑": "-",
    "…": "...", "«": "<<", "»": ">>", "‹": "<", "›": ">", "•": "*", "\u00a0": " ",
}

# Hangul letters by the Revised Romanisation, letter for letter: initials, vowels and finals in code point order.
HANGUL = ("g kk n d tt r m b pp s ss  j jj ch k t p h".split(" "),
          "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" "),
          " g kk gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j ch k t p h".split(" "))

#: Code points that the map covers: everything up to the Japanese syllables, Han characters, and full-width forms.
LETTERS, HAN, WIDE = (0x80, 0x30FF), (0x4E00, 0x9FFF), (0xFF01, 0xFFEE)
INDIC = (0x0900, 0x0DFF)
#: Stands before what replaces the vowel of a consonant, until that vowel is gone.
_EAT = "\ue001"
_NO_LETTER = "\x00"  # no rule; also fills values up to ``_WIDTH`` bytes
_NONE = "\x01"  # stands for the value of a character without a rule
_WIDTH = 8


def is_ascii(text) -> Column:
    """True when every character is ASCII: as many characters as bytes (no allocation)."""
    c = as_col(text)
    return F.length(c) == F.octet_length(c)


def _cldr(chars: list[str]) -> list[str]:
    """Each character by CLDR's transforms to ASCII letters."""
    icu = SparkSession.active()._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII")
    return icu.transliterate("\n".join(chars)).split("\n")


def _tidy(char: str, latin: str) -> str:
    """What a transform gives for one character, in ASCII; ``_NO_LETTER`` where it has none."""
    indic, name = INDIC[0] <= ord(char) <= INDIC[1], unicodedata.name(char, "")
    if indic and name.endswith(("VIRAMA", "AL-LAKUNA")):
        return _EAT
    if indic and name.endswith(("ANUSVARA", "TIPPI", "SIGN BINDI")):
        return "m"
    latin = latin.replace("\u0314", _EAT if indic else "")  # the transform's own mark of a vowel sign
    latin = latin.replace("\u02bf", "'").replace("\u02be", "'").replace("~", "")
    latin = "".join(c for c in unicodedata.normalize("NFD", latin) if not unicodedata.combining(c))
    return latin if latin.replace(_EAT, "").isascii() else _NO_LETTER


@lru_cache(maxsize=1)
def romanisations() -> dict[str, str]:
    """Character -> ASCII text, for the characters of the blocks that a rule knows."""
    out = {}
    for low, high in (LETTERS, HAN, WIDE):
        chars = [chr(c) for c in range(low, high + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cc", "Cs", "Co", "Zl", "Zp")]
        for char, latin in zip(chars, _cldr(chars), strict=True):
            out[char] = _tidy(char, latin)
            if low == HAN[0] and out[char] != _NO_LETTER:
                out[char] = out[char].capitalize() + " "
    out |= TRANSLITERATION
    return {k: v for k, v in out.items() if v != _NO_LETTER and len(v.encode()) <= _WIDTH}


@lru_cache(maxsize=1)
def _packed() -> bytes:
    """The map as one small byte string: the values of all code points side by side, ``_NONE`` where there is no rule."""
    known = romanisations()
    return b"".join(known.get(chr(c), _NONE).encode().ljust(_WIDTH, b"\x00") for low, high in (LETTERS, HAN, WIDE) for c in range(low, high + 1))


def _letter(char: Column) -> Column:
    """One character's romanisation; ``_NONE`` or null where it has none."""
    cp = F.ascii(char)
    place, before = F.lit(None).cast("int"), 0
    for low, high in (LETTERS, HAN, WIDE):
        place, before = F.when(cp.between(low, high), cp - (low - before)).otherwise(place), before + high - low + 1
    value = F.rtrim(F.substring(F.lit(_packed()), place * _WIDTH + 1, F.lit(_WIDTH)).cast("string"), F.lit(_NO_LETTER))
    syllable = cp - 0xAC00
    initial, vowel, final = (F.array(*[F.lit(x) for x in some]) for some in HANGUL)
    hangul = F.concat(F.get(initial, (syllable / 588).cast("int")), F.get(vowel, ((syllable % 588) / 28).cast("int")), F.get(final, syllable % 28))
    return F.when(cp.between(0xAC00, 0xD7A3), hangul).otherwise(value)


@lru_cache(maxsize=4)
def _single_letters(accented: str, base: str) -> tuple[str, str]:
    """The tables of ``translate``: accents first, then the fixed tables' single letters."""
    to = dict(zip(accented, base, strict=False))
    gone = accented[len(base):]
    out = {c: TRANSLITERATION.get(b, b) if len(TRANSLITERATION.get(b, b)) == 1 else b for c, b in to.items()}
    out |= {c: v for c, v in TRANSLITERATION.items() if len(v) == 1}
    return "".join(out) + gone, "".join(out.values())


def romanise(text, accented: str, base: str) -> Column:
    """``text`` in ASCII as far as rules reach; ``accented`` and ``base`` are the tables of letters with accents, as for ``translate``."""
    c = as_col(text)
    single = F.translate(c, *_single_letters(accented, base))
    left = F.array_distinct(F.regexp_extract_all(single, F.lit(r"([^\x00-\x7F])"), F.lit(1)))
    # each character is looked up once, then replaced
    found = F.transform(left, lambda char: F.struct(char.alias("char"), _letter(char).alias("latin")))
    all_done = F.aggregate(found, single, lambda done, x: F.when(x["latin"] != _NONE, F.replace(done, x["char"], x["latin"])).otherwise(done))
    eaten = F.replace(F.replace(all_done, F.lit("a" + _EAT), F.lit("")), F.lit(_EAT), F.lit(""))
    return F.when(is_ascii(c), c).when(is_ascii(single), single).otherwise(eaten)

"""Text column functions: accents, title case, whitespace, pieces, defaults.

Everything is a native expression (``translate``, ``initcap``,
``regexp_replace``, ``split``/``get``) so no Python worker sits in the plan;
the reference's row-wise accent UDF is re-expressed as one ``translate``
whose letter table is generated from Unicode decompositions, and a look-up per
distinct character for what it leaves.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions._util import as_col
from skyledger.functions.romanise import is_ascii, romanise

# ---- accent stripping (I1) -------------------------------------------------------
# Rule: every code point in these blocks whose canonical decomposition is one
# base character plus combining marks maps to that base character; free-standing
# combining marks (U+0300-U+036F) are deleted.
_ACCENT_BLOCKS = [
    (0x00C0, 0x024F),  # Latin-1 Supplement letters, Latin Extended-A and -B
    (0x0370, 0x03FF),  # Greek and Coptic
    (0x0400, 0x04FF),  # Cyrillic
    (0x1E00, 0x1EFF),  # Latin Extended Additional
    (0x1F00, 0x1FFF),  # Greek Extended
]


def _accent_table() -> tuple[str, str]:
    src, dst = [], []
    for lo, hi in _ACCENT_BLOCKS:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = "".join(c for c in unicodedata.normalize("NFD", ch)
                           if not unicodedata.combining(c))
            if base != ch and len(base) == 1:
                src.append(ch)
                dst.append(base)
    # marks with no replacement are removed by translate
    marks = [chr(cp) for cp in range(0x0300, 0x0370)]
    return "".join(src) + "".join(marks), "".join(dst)


ACCENT_SRC, ACCENT_DST = _accent_table()

# Fixed value: a "valid" place name is letters (ASCII or Latin-1), spaces and hyphens.
VALID_PLACE_PATTERN = r"^[A-Za-zÀ-ÿ\s\-]+$"

def strip_accents(text) -> Column:
    """Base letter of every decomposable letter; combining marks removed.

    ASCII text (nothing to strip) skips the per-character table lookup.
    """
    c = as_col(text)
    return F.when(is_ascii(c), c).otherwise(F.translate(c, ACCENT_SRC, ACCENT_DST))


def transliterate(text) -> Column:
    """Latin letters without accents for every letter that has them (``functions/romanise.py``); ASCII text passes as it is."""
    return romanise(text, ACCENT_SRC, ACCENT_DST)


def title_words(text) -> Column:
    """Lower case, then upper-case the first letter after a space (H9).

    ``initcap`` lower-cases the rest of each word itself.
    """
    return F.initcap(as_col(text))


def collapse_spaces(text) -> Column:
    """Every whitespace run becomes one space; no trim."""
    return F.regexp_replace(as_col(text), r"\s+", " ")


def normalize_name(text) -> Column:
    """The reference's name cleaning: accents off, title case, spaces collapsed."""
    return collapse_spaces(title_words(transliterate(text)))


def with_normalized(df, name: str, normalizer=normalize_name):
    """Keep ``raw_<name>`` and replace ``name`` by its cleaned form."""
    return df.withColumn(f"raw_{name}", F.col(name)).withColumn(name, normalizer(F.col(name)))


_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


# private-use marker inserted where a cased letter follows an uncased character
# other than a space, so ``initcap`` (which starts words only after a space)
# starts a word there too; the marks are taken out afterwards
_WORD_MARK = "\ue000 "
_WORD_START = rf"(?<=[^{_CASED} ])(?=[{_CASED}])"


def python_title(text) -> Column:
    """Title case where any uncased character starts a word (``o'neil`` -> ``O'Neil``).

    Native: mark the word starts ``initcap`` would miss, ``initcap``, drop
    the marks.  Same result as Python's ``str.title``.
    """
    marked = F.regexp_replace(as_col(text), _WORD_START, _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def normalize_text_trim(text, default: str = "Unknown") -> Column:
    """Accents off, lower, whitespace collapsed and trimmed, title case."""
    c = F.regexp_replace(transliterate(text), r"(?U)\s+", " ")
    c = python_title(F.trim(c))   # lower-cases through initcap
    return F.coalesce(c, F.lit(default))


def _quote(sep: str) -> str:
    return r"\Q" + sep + r"\E"


def nth_piece(text, sep: str, i: int) -> Column:
    """Piece ``i`` (0-based) of the text split at ``sep``; null when absent (H8)."""
    return F.get(F.split(as_col(text), _quote(sep)), i)


def default_if_blank(value, default) -> Column:
    """Null or empty text becomes ``default``."""
    v = as_col(value)
    d = default if isinstance(default, Column) else F.lit(default)
    return F.when(v.isNull() | (v == ""), d).otherwise(v)


def first_present(*values, default: str = "Unknown") -> Column:
    """First value that is neither null nor empty, else ``default``."""
    return F.coalesce(*[F.nullif(as_col(v), F.lit("")) for v in values], F.lit(default))


def valid_or_unknown(value, pattern: str = VALID_PLACE_PATTERN, default: str = "Unknown") -> Column:
    """Keep text matching ``pattern``; anything else (null too) becomes ``default``."""
    v = as_col(value)
    return F.when(v.rlike(pattern), v).otherwise(F.lit(default))

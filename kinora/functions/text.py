"""Column expressions over titles, genres and dates.

All of these are native Catalyst expressions (regexp / higher-order array
functions), so they stay inside whole-stage codegen; no Python UDF is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES (must equal the reference behaviour) --------------------------
# Characters Python's str.strip() treats as whitespace, as one regex class.
WHITESPACE_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
# Articles moved from "Title, The" to the front when parsing titles for linkage.
LINK_ARTICLES = ["The", "A", "An", "Les", "La", "Le", "L'", "Il", "Das", "Der", "Die", "El"]
# Articles handled by the display-title rule.
DISPLAY_ARTICLES = ["The", "A", "An"]
# Placeholder used for a missing title.
UNTITLED = "Untitled"
# ---------------------------------------------------------------------------

_WS = WHITESPACE_CLASS
_YEAR_ANY = r"\((\d{4})\)"
_YEAR_END = r"\((\d{4})\)" + _WS + r"*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python-style strip(): remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^{_WS}+|{_WS}+$", "")


def clean_title(col) -> Column:
    """Trim whitespace; a missing title becomes 'Untitled'; '' stays ''."""
    return F.coalesce(strip_ws(col), F.lit(UNTITLED))


def release_year(col) -> Column:
    """Leftmost '(dddd)' in the title as an int, else 0."""
    digits = F.regexp_extract(_c(col), _YEAR_ANY, 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def year_with_fallback(title, release_date) -> Column:
    """Title year, else the trailing four digits of a dd-Mon-yyyy date, else 0."""
    from_title = F.regexp_extract(_c(title), _YEAR_ANY, 1).try_cast("int")
    from_date = F.regexp_extract(_c(release_date), r"(\d{4})" + _WS + "*$", 1).try_cast("int")
    return F.coalesce(from_title, from_date, F.lit(0))


def feature_text(title, genres, year) -> Column:
    """'{title without any (yyyy)} {genres} {genres} {year}' lower-cased.

    Genres: '|' and '-' become spaces; repeated twice to weight them up.
    """
    bare = strip_ws(F.regexp_replace(_c(title), _WS + r"*\(\d{4}\)", ""))
    gtok = F.translate(_c(genres), "|-", "  ")
    return F.lower(F.concat_ws(" ", bare, gtok, gtok, _c(year).cast("string")))


def normalise_name(col) -> Column:
    """Lower-case and keep ASCII letters and digits only (linkage key)."""
    return F.regexp_replace(F.lower(F.coalesce(_c(col), F.lit(""))), "[^a-z0-9]", "")


def link_key(col) -> Column:
    """``normalise_name``; of a name without such characters the lower-cased name
    itself, so that names in other scripts are told apart and none is a key of all."""
    key = normalise_name(col)
    return F.when(key == "", F.lower(strip_ws(F.coalesce(_c(col), F.lit(""))))).otherwise(key)


def year_from_date(col) -> Column:
    """First four characters of a date string when they are all digits."""
    head = F.substring(F.coalesce(_c(col), F.lit("")), 1, 4)
    return F.when(head.rlike(r"^\d{4}$"), head.cast("int"))


def end_year(col) -> Column:
    """Year in a trailing '(dddd)', else NULL."""
    return F.regexp_extract(_c(col), _YEAR_END, 1).try_cast("int")


def _fix_article(col: Column) -> Column:
    """'Usual Suspects, The' -> 'The Usual Suspects'; "X, L'" -> "L'X"."""
    t = strip_ws(col)
    apostrophe = [a for a in LINK_ARTICLES if a.endswith("'")]
    plain = [a for a in LINK_ARTICLES if not a.endswith("'")]
    pat_apos = f"(?i)^(.*),{_WS}*({'|'.join(apostrophe)})$"
    pat_plain = f"(?i)^(.*),{_WS}*({'|'.join(plain)})$"
    return (F.when(t.rlike(pat_apos), F.regexp_replace(t, pat_apos, "$2$1"))
            .when(t.rlike(pat_plain), F.regexp_replace(t, pat_plain, "$2 $1"))
            .otherwise(t))


def parse_title(col) -> Column:
    """Struct(year int, candidates array<string>) of search names for a title.

    year: trailing '(dddd)'.  candidates: [article-fixed main, main, each
    parenthesised alternative (minus 'a.k.a.') article-fixed], empty ones
    dropped, unique case-insensitively with first occurrence kept.
    """
    raw = _c(col)
    base = strip_ws(F.regexp_replace(raw, _WS + r"*\(\d{4}\)" + _WS + "*$", ""))
    alts = F.regexp_extract_all(base, F.lit(r"\(([^)]+)\)"), 1)
    main = strip_ws(F.regexp_replace(base, _WS + r"*\([^)]*\)", ""))
    alt_names = F.transform(
        alts, lambda a: _fix_article(F.regexp_replace(a, r"(?i)^a\.k\.a\.?" + _WS + "*", "")))
    all_c = F.concat(F.array(_fix_article(main), main), alt_names)
    unique = F.aggregate(
        all_c, F.array().cast("array<string>"),
        lambda acc, v: F.when(
            (v == F.lit("")) | F.exists(acc, lambda a: F.lower(a) == F.lower(v)), acc
        ).otherwise(F.concat(acc, F.array(v))))
    return F.struct(end_year(raw).alias("year"), unique.alias("candidates"))


def display_title(col) -> Column:
    """Display form: drop trailing year; 'X, The (alt)' -> 'The X (alt)'."""
    t = strip_ws(F.regexp_replace(_c(col), r"\s*\(\d{4}\)\s*$", ""))
    pat = rf"(?i)^(.*?),\s*({'|'.join(DISPLAY_ARTICLES)})(\s*\(.*\))?$"
    return F.when(t.rlike(pat), F.regexp_replace(t, pat, "$2 $1$3")).otherwise(t)


def compose_title(title, release_date) -> Column:
    """Feed title: commas removed, ' (yyyy)' appended when a date is present."""
    name = F.regexp_replace(F.coalesce(_c(title), F.lit("")), ",", "")
    year = F.substring(F.coalesce(_c(release_date), F.lit("")), 1, 4)
    return F.when(year != "", F.concat(name, F.lit(" ("), year, F.lit(")"))).otherwise(name)

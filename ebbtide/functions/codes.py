"""Postal codes in free text, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions.binding import let

W, WORD = fv.CODE_WINDOW, fv.CODE_WORD

# Classes that mean the same on every Java version.
DIGIT = r"\p{Nd}"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
LEFT, RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"

# Patterns, in the order in which their finds are listed. Each looks for a digit or
# the word first, so that the costly tests run at few places.
AFTER_WORD = rf"(?i){WORD}{SPACE}*:?{SPACE}*{DIGIT}{{5}}{SPACE}*-?{SPACE}*{DIGIT}{{3}}"
WITH_DASH = rf"(?={DIGIT}){LEFT}{DIGIT}{{5}}{SPACE}*-{SPACE}*{DIGIT}{{3}}{RIGHT}"
# Eight digits on their own. The word may end up to W - 3 characters before them,
# or begin so that it ends within W characters of their start.
EIGHT = rf"{DIGIT}{{8}}"
BARE = rf"(?={DIGIT}){LEFT}(?={EIGHT}{RIGHT})"
NEAR_BEFORE = rf"(?<={WORD}[\s\S]{{0,{W - len(WORD)}}}){EIGHT}"
NEAR_AFTER = rf"{EIGHT}(?=[\s\S]{{0,{W - 8 - len(WORD)}}}{WORD})"
NEAR = rf"(?i){BARE}(?:({NEAR_BEFORE}|{NEAR_AFTER})|{EIGHT})"


def mentions_code(subject: Column, body: Column) -> Column:
    """The subject has the word or its plural, or the body has the word."""
    in_subject = subject.rlike(rf"(?i){LEFT}{WORD}S?{RIGHT}")
    return F.coalesce(in_subject, F.lit(False)) | F.coalesce(body.rlike(rf"(?i){LEFT}{WORD}{RIGHT}"), F.lit(False))


def _dashed(digits: Column) -> Column:
    return F.concat(digits.substr(1, 5), F.lit("-"), digits.substr(6, 3))


def _finds(text: Column, pattern: str) -> Column:
    digits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(digits, lambda d: _dashed(F.regexp_replace(d, r"\P{Nd}+", "")))


def explicit_codes(text: Column) -> Column:
    """Finds of the first two patterns, with repeats."""
    return F.concat(_finds(text, AFTER_WORD), _finds(text, WITH_DASH))


def bare_candidates(text: Column) -> Column:
    """Eight digits on their own, with a mark for those near the word.

    Near the word they always count. Elsewhere they count if they do not begin like
    a date or with 00.
    """
    digits = F.regexp_extract_all(text, F.lit(NEAR), F.lit(0))
    near = F.regexp_extract_all(text, F.lit(NEAR), F.lit(1))
    seen = F.zip_with(digits, near, lambda d, n: F.struct(d.alias("digits"), (n != "").alias("near")))
    return F.filter(seen, lambda s: s["near"] | ~s["digits"].substr(1, 2).isin("00", *fv.DATE_PREFIXES))


def _within(candidates: Column, found: Column, cap: int) -> Column:
    """Candidates that are listed: away from the word only while fewer than `cap` codes are.

    Until the list is full every candidate is taken, so the place among the candidates
    tells how many were listed before.
    """
    room = F.lit(cap) - F.size(found)
    return F.filter(candidates, lambda s, i: s["near"] | (i < room))


def code_lists(text: Column, cap: int = fv.CODE_CAP) -> Column:
    """`codes`, distinct and in order of appearance, pattern by pattern, and `dropped`: how many
    numbers of eight digits the cap left out."""

    def of(t: Column) -> Column:
        return let(explicit_codes(t), lambda found: let(bare_candidates(t), lambda bare: lists(found, bare)))

    def lists(found: Column, bare: Column) -> Column:
        def listed(kept: Column) -> Column:
            codes = F.array_distinct(F.concat(found, F.transform(kept, lambda s: _dashed(s["digits"]))))
            return F.when(codes.isNotNull(), F.struct(codes.alias("codes"), (F.size(bare) - F.size(kept)).alias("dropped")))

        return let(_within(bare, found, cap), listed)

    return let(text, of)


def postal_codes(text: Column, cap: int = fv.CODE_CAP) -> Column:
    """Distinct codes in order of appearance; see `code_lists`."""
    return code_lists(text, cap)["codes"]

"""HTML to visible text, as column expressions."""

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.binding import let
from ebbtide.functions.text import strip

# The start of the text behind an '&': a whole reference, or else a name that needs no semicolon.
_BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
ENTITY = "^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)"
BARE = "^(" + "|".join(_BARE) + ")"
UNIT, RECORD = "\x01", "\x02"
# The names of everyday use are looked up first; all other HTML 5 names follow.
_EVERYDAY = {n: c for n, c in html.entities.html5.items() if n.removesuffix(";") in html.entities.name2codepoint}
_OTHER = {n: c for n, c in html.entities.html5.items() if n not in _EVERYDAY}
# Numbers 128 to 159 mean the characters of the Windows code page, where it has one.
_WINDOWS = {str(n): bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}


def _table(values: dict[str, str]) -> Column:
    return F.str_to_map(F.lit(RECORD.join(f"{k}{UNIT}{v}" for k, v in values.items() if v)), F.lit(RECORD), F.lit(UNIT))


def _numbered(entity: Column) -> Column:
    """Character of a numeric reference; the replacement character where there is none."""

    def of(digits: Column) -> Column:
        number = F.when(entity.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        point = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        windows = F.when(number.between(128, 159), _table(_WINDOWS)[number.cast("string")])
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.coalesce(windows, F.when(valid, point), F.lit("\ufffd"))

    return let(F.regexp_extract(entity, r"^#[xX]?([0-9a-fA-F]+)", 1), of)


def _named(entity: Column) -> Column:
    return F.coalesce(_table(_EVERYDAY)[entity], _table(_OTHER)[entity])


def _replaced(piece: Column) -> Column:
    """A piece that stood behind an '&', with its reference replaced; an unknown one stays."""

    def rest(name: Column) -> Column:
        return piece.substr(F.length(name) + 1, F.length(piece))

    def bare() -> Column:
        found = F.regexp_extract(piece, BARE, 1)
        return let(found, lambda n: F.when(n != "", F.concat(_named(n), rest(n))).otherwise(F.concat(F.lit("&"), piece)))

    def whole(entity: Column) -> Column:
        character = F.when(entity.startswith("#"), _numbered(entity)).when(entity != "", _named(entity))
        return let(character, lambda c: F.when(c.isNotNull(), F.concat(c, rest(entity))).otherwise(bare()))

    return let(F.regexp_extract(piece, ENTITY, 1), whole)


def unescape(text: Column) -> Column:
    """Replace the entities of a text; texts without any pass unchanged."""

    def of(t: Column) -> Column:
        pieces = F.transform(F.split(t, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(_replaced(p)))
        return F.when(t.contains("&"), F.array_join(pieces, "")).otherwise(t)

    return let(text, of)


def html_text(page: Column) -> Column:
    """Visible text: scripts, styles, comments and tags out, entities decoded twice,
    white space collapsed."""
    text = F.regexp_replace(page, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)</?[A-Za-z!?][^>]*>", " ")
    text = unescape(unescape(text))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def body_text(plain: Column, page: Column) -> Column:
    """The plain part without outer white space, else the text of the HTML part, else ''."""
    return F.coalesce(strip(F.nullif(plain, F.lit(""))), html_text(page), F.lit(""))

"""Text, number and identifier clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that read as true or false, and safe identifiers.
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")
WHITE_SPACE = " \t\n\r\x0b\x0c"
SAFE_IDENTIFIER = "^[A-Za-z0-9_-]+$"
BATCH_ID_PATTERN = "^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}$"
OFFSET_PATTERN = r"T?\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$"
NO_SECONDS_PATTERN = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})$"
SHORT_OFFSET_PATTERN = r"([+-]\d{2})(\d{2})$"


def strip(text: Column | str) -> Column:
    """Trim all white space, not blanks only."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def text_or(text: Column, *fallbacks: Column) -> Column:
    """First non-blank text, trimmed."""
    return F.coalesce(*[F.nullif(strip(t), F.lit("")) for t in (text, *fallbacks)])


def parse_boolean(text: Column) -> Column:
    """Free text to boolean; an unknown text gives null."""
    word = F.lower(strip(text))
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)


def is_active(text: Column) -> Column:
    """Only an explicit yes counts as active."""
    return F.coalesce(F.lower(strip(text)).isin(*TRUE_TEXTS), F.lit(False))


def to_number(value: Column) -> Column:
    """Any text or number as a double; unreadable text and NaN become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_integer(value: Column, default: int = 0) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(default).cast("bigint"))


def to_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(default))


def to_timestamp(text: Column) -> Column:
    """ISO text as a timestamp; seconds and the colon of the offset may be left out."""
    whole = F.regexp_replace(text, NO_SECONDS_PATTERN, "$1:00$2")
    return F.try_to_timestamp(F.regexp_replace(whole, SHORT_OFFSET_PATTERN, "$1:$2"))


def has_offset(text: Column) -> Column:
    """Readable timestamp text that names its offset."""
    return F.coalesce(to_timestamp(text).isNotNull() & text.rlike(OFFSET_PATTERN), F.lit(False))


def is_safe_identifier(text: Column) -> Column:
    return F.coalesce(text.rlike(SAFE_IDENTIFIER), F.lit(False))


def is_batch_id(text: Column) -> Column:
    return F.coalesce(text.rlike(BATCH_ID_PATTERN), F.lit(False))


def json_number(value: Column) -> Column:
    """JSON knows no NaN and no infinity."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def json_time(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def translate(code: Column, labels: dict[str, str], unknown: str, upper: bool = True) -> Column:
    """Code to label; unknown codes pass through, blanks get ``unknown``."""
    word = strip(code)
    word = F.upper(word) if upper else word
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[word], F.nullif(word, F.lit("")), F.lit(unknown))

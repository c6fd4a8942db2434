"""Column expressions shared by the operators. All are built-in expressions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.specs import MISSING_NAMES

# The texts a delimited-file reader takes for "no value".
NULL_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Payment codes and how reports name them.
PAYMENT_LABELS = {"1": "001 - Cash", "102": "102 - Cheque", "205": "205 - Transfer"}

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Amounts of the star, and amounts as they come: their further digits stay until the facts are written.
MONEY, AMOUNT = "decimal(18,2)", "decimal(20,6)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unmark(c: Column | str) -> Column:
    """Null where the text is one of the null markers."""
    return F.when(~col(c).isin(NULL_MARKERS), col(c))


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends (a plain ``trim`` only knows blanks)."""
    return F.trim(col(c), F.lit(WHITE_SPACE))


def tidy_text(c: Column | str, longest: int | None = None) -> Column:
    """Strip, put line breaks on one line, cut to the longest allowed length."""
    flat = F.when(col(c).contains("\n"), F.regexp_replace(strip(c), "\r?\n", " ")).otherwise(strip(c))
    return flat if longest is None else F.substring(flat, 1, longest)


def to_money(c: Column | str, kind: str = AMOUNT) -> Column:
    """Text with a decimal comma or point to DECIMAL, null when it is not a number."""
    return F.replace(col(c), F.lit(","), F.lit(".")).try_cast(kind)


def to_whole(c: Column | str) -> Column:
    """Text to a whole number, half to even; infinite and unreadable values become null."""
    number = col(c).try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return F.bround(finite, 0).try_cast("int")


def to_day(c: Column | str) -> Column:
    """Text to a date, null when it is not one."""
    return col(c).try_cast("date")


def plain_code(c: Column | str) -> Column:
    """A numeric code without its leading zeros."""
    return F.regexp_replace(strip(c), r"^0+(?=\d)", "")


def date_key(c: Column | str) -> Column:
    """Date to the integer YYYYMMDD."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(c: Column | str) -> Column:
    """Integer YYYYMMDD to the date."""
    k = col(c)
    whole = lambda x: F.floor(x).cast("int")
    return F.make_date(whole(k / 10000), whole(k / 100) % 100, k % 100)


def is_missing_name(c: Column | str) -> Column:
    return col(c).isNull() | strip(c).isin(MISSING_NAMES)


def client_name(account: Column | str, name: Column | str) -> Column:
    """The name, or a stand-in made from the account id where there is none."""
    return F.when(is_missing_name(name), F.concat(F.lit("CLIENT_"), col(account))).otherwise(col(name))


def is_named(c: Column | str) -> Column:
    """A real name: present and not a technical stand-in."""
    return col(c).isNotNull() & ~col(c).contains("CLIENT_") & ~col(c).contains("UNKNOWN")


def short_name(c: Column | str, longest: int = 32) -> Column:
    """Label for a chart axis: cut with an ellipsis when too long."""
    return F.when(
        F.length(col(c)) > longest, F.concat(F.substring(col(c), 1, longest), F.lit("…"))
    ).otherwise(col(c))


def payment_label(code: Column | str) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, col(code)), col(code))


def rounded(c: Column | str, digits: int = 2) -> Column:
    """Round half up on the decimal value, so that the result does not hang on binary noise."""
    return F.round(col(c).cast("decimal(38,10)"), digits).cast("double")


def share(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; null when the whole is zero."""
    top, bottom = col(part).cast("double"), col(whole).cast("double")
    return rounded(F.try_divide(top * 100.0, bottom), digits)


def ratio(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    return rounded(F.try_divide(col(part).cast("double"), col(whole).cast("double")), digits)


def number(c: Column | str) -> Column:
    """A report figure: exact decimals leave the engine as doubles."""
    return col(c).cast("double")

"""Text expressions: names for matching, money, sentences, availability. The two Unicode kernels are Arrow UDFs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

#: Words that do not tell places apart.
STOP_WORDS = ("the", "a", "an", "in", "of")


@F.pandas_udf(StringType())
def nfkd_ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


@F.pandas_udf(BooleanType())
def is_nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.is_normalized("NFC", x))


def match_name(c: Column, places: tuple[str, ...] = (), ascii_only: bool = False) -> Column:
    """The form of a name that is compared: plain small letters and digits, without stop words and place words.

    ascii_only skips the Unicode kernel where names are known to be ASCII."""
    plain = F.lower(c if ascii_only else nfkd_ascii(c))
    plain = F.regexp_replace(F.replace(plain, F.lit("&"), F.lit(" and ")), "[^a-z0-9 ]+", " ")
    plain = F.regexp_replace(plain, r"\b(" + "|".join((*STOP_WORDS, *places)) + r")\b", " ")
    return F.trim(F.regexp_replace(plain, " +", " "))


#: Currencies and the marks, codes or words that name them, in the order in which they are tried.
CURRENCIES = {
    "NZD": r"\bNZD\b|NZ\$",
    "CAD": r"\bCAD\b|CA\$|(?<![A-Za-z])C\$",
    "AUD": r"\bAUD\b|A\$",
    "USD": r"\bUSD\b|\$",
    "EUR": r"€|\b(?:EUR|euros?)\b",
    "GBP": r"£|\bGBP\b",
    "JPY": r"¥",
    "HUF": r"\b(?:HUF|Ft|forints?)\b",
}
#: What may stand before or after an amount. Codes never touch a letter, nor a digit but their own amount's, which
#: is then no part of a longer word either: hashes and keys hold "cad" between digits.
_SIGN, _CODE = r"US\$|CA\$|NZ\$|A\$|C\$|\$|€|£|¥", "(?:USD|EUR|GBP|HUF|NZD|AUD|CAD|Ft)"
#: Groups of three after blanks, or digits with any dots and commas inside.
_NUMBER = r"(?:[0-9]{1,3}(?:[ \u00a0][0-9]{3})+(?:[.,][0-9]{1,2})?(?![0-9])|[0-9](?:[0-9.,]*[0-9])?)"
_BEFORE = rf"(?:{_SIGN}|(?<![\p{{L}}0-9]){_CODE}(?!\p{{L}}|[0-9](?:[0-9.,]*[0-9])?\p{{L}}))"
#: A mark before an amount, or after one that is not the end of a longer number or, with a code, of a word.
MONEY = rf"(?i)({_BEFORE}[ \u00a0]*{_NUMBER}|(?<![0-9.,])(?:{_NUMBER}[ \u00a0]*(?:{_SIGN})|(?<!\p{{L}}){_NUMBER}[ \u00a0]*{_CODE}(?![\p{{L}}0-9])))"


def money_mentions(c: Column) -> Column:
    """All money tokens of a text."""
    return F.regexp_extract_all(c, F.lit(MONEY), 1)


def currency(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, pattern in reversed(CURRENCIES.items()):
        out = F.when(token.rlike(f"(?i){pattern}"), code).otherwise(out)
    return out


def amount(token: Column) -> Column:
    """The number of a money token, by the place of its marks; null where they make no number, or one of over 16 digits."""
    raw = F.regexp_replace(token, "[^0-9.,]", "")
    dot, comma = F.length(raw) - F.length(F.replace(raw, F.lit("."), F.lit(""))), F.length(raw) - F.length(F.replace(raw, F.lit(","), F.lit("")))
    decimal_comma = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    decimal_dot = F.replace(raw, F.lit(","), F.lit(""))
    no_marks = F.regexp_replace(raw, "[.,]", "")
    text = (
        F.when((dot > 0) & (comma > 0), F.when(F.locate(",", F.reverse(raw)) < F.locate(".", F.reverse(raw)), decimal_comma).otherwise(decimal_dot))
        .when((dot + comma == 1) & raw.rlike("[.,][0-9]{1,2}$"), F.replace(raw, F.lit(","), F.lit(".")))
        .when(raw.rlike(r"^[0-9]{1,3}([.,][0-9]{3})+$"), no_marks)
        .when(dot + comma == 0, raw)
    )
    return F.when(text.rlike(r"^[0-9]+(\.[0-9]{1,2})?$"), text.try_cast("decimal(18,2)"))


#: Words that make a charge an additional one.
ADDITIONAL = r"(?i)\b(?:additional|extra)\s+(?:cost|charge|fee)s?\b|\bsurcharges?\b|\bsupplements?\b|\b(?:cost|charge|fee)s?\s+(?:is|are)?\s+not\s+included\b|\bpay(?:able)?\s+separately\b"
#: Units of a charge and how a sentence names them.
UNITS = {"person": r"(?:/|\bper\s+)(?:person|people)\b|\bfejenk[eé]nt\b|/fő\b"} | {u: rf"(?:/|\bper\s+){u}\b" for u in ("adult", "child", "group", "ticket", "vehicle", "family")}


def charge_unit(sentence: Column) -> Column:
    """The unit that a sentence names, '' without any."""
    return F.coalesce(*(F.when(sentence.rlike(f"(?iU){pattern}"), unit) for unit, pattern in UNITS.items()), F.lit(""))


#: Phrases of free admission; groups that alone enjoy it; what may follow as a condition, or stand before.
FREE = r"(?:\bfree admission\b|\badmission (?:is|'s) free\b|\bfree entry\b|\bentry (?:is|'s) free\b|\bno (?:admission|entry) fees?\b|\bfree to enter\b|\bentrance (?:is|'s) free(?: of charge)?\b|\bvisit\b[^.!?]{0,120}\bexhibitions?\s+for\s+free\b)"
FREE_GROUPS = r"(?i)\b(?:children?|kids?|infants?|youths?|students?|seniors?|members?|residents?|locals?|citizens?|cardholders?|disabled|teachers?|educators?|under\s+\d+|aged?\s+\d+|ages?\s+\d+|city\s+card)\b"
FREE_TAIL = r"\s*(?:only\b|except\b|unless\b|if\b|when\b|with\b|on\b|during\b|before\b|after\b|for\s+(?!all\b))"
FREE_BEFORE = r"\b(?:only|except|unless)\b"


def free_admission(c: Column, groups: str = FREE_GROUPS) -> Column:
    """Whether some sentence calls admission free for all: it names no group, and of its phrases one has no condition
    after it and no only, except or unless before it. Null texts do not."""
    free = rf"(?is)^(?:(?!{FREE_BEFORE}).)*?{FREE}(?!{FREE_TAIL})"
    return F.coalesce(F.exists(F.split(c, "[.!?]"), lambda s: s.rlike(free) & ~s.rlike(groups)), F.lit(False))


#: Wording of tours that are free or paid by tips, and the most that a booking fee of one may be.
TIP_TOUR = (
    r"(?i)\bfree(?:\s+of\s+charge)?[-\s]+(?:(?:guided|city|sightseeing|historical|essential)\s+)*(?:walking\s+)?tour\b|\bpay[-\s]+what[-\s]+you[-\s]+(?:like|want|wish|think)\b|\bfreedom\s+to\s+pay\s+what\s+you\s+(?:like|want|wish|think)\b"
    r"|\bdecide\s+how\s+much\s+to\s+pay\s+(?:the\s+)?guide\b|\btip\s+(?:the\s+)?guides?\s+as\s+(?:little|much)\s+or\s+(?:as\s+)?(?:little|much)\s+as\s+you\s+(?:like|want|wish)\b"
)
BOOKING_FEE_LIMITS = {"USD": 20, "EUR": 20, "GBP": 20, "AUD": 30, "CAD": 30, "HUF": 7500}


def named_scope(c: Column) -> Column:
    """The scope that a text names itself: booking-fee or deposit."""
    return F.when(c.rlike(r"(?i)\b(?:booking|reservation|service)\s+fee\b"), "booking-fee").when(c.rlike(r"(?i)\bdeposit\b"), "deposit")


def charge_scope(package: Column, activity: Column, currency_: Column, amount_: Column) -> Column:
    """The scope of a charge: as the package's text names it, else the activity's; else a booking fee where the tour is
    free or paid by tips and the charge is small for its currency; else ''."""
    most = F.create_map(*(F.lit(x) for kv in BOOKING_FEE_LIMITS.items() for x in kv))
    both = F.concat_ws(" ", activity, package)
    small = (amount_ > 0) & (amount_ <= F.try_element_at(most, currency_))
    tips = both.rlike(r"(?i)\b(?:tour|walking)\b") & both.rlike(TIP_TOUR)
    return F.coalesce(named_scope(package), named_scope(activity), F.when(tips & small, "booking-fee"), F.lit(""))


def sentences(c: Column, marks: str = ".!?") -> Column:
    """Sentences, cut after end marks and at line ends."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, rf"([{marks}])\s+", "$1\n"), "\n"), F.trim), lambda x: x != "")


#: States of availability and their wording, in the order in which they are tried.
STATES = {
    "sold-out": r"\bsold[\s-]*out\b",
    "closed": r"\b(?:temporarily|permanently)\s+closed\b|\bclosed\s+until\b|\b(?:is|are|remains?)\s+closed\b",
    "unavailable": r"\bunavailable\b|\bnot\s+(?:currently\s+)?available\b|\bno\s+availability\b|\bnot\s+bookable\b|\bbookings?\s+(?:are\s+)?closed\b",
    "date-required": r"\b(?:select|choose|pick|change)\s+(?:(?:a|the|your)\s+)?date\b|\bcheck\s+availability\b",
}


def availability(c: Column, with_closed: bool = True) -> Column:
    """The first state whose wording a text has; with "closed now", a state of the day, nothing is closed."""
    out = F.lit(None).cast("string")
    for state, pattern in reversed(STATES.items()):
        test = c.rlike(f"(?i){pattern}")
        if state == "closed":
            test = test & ~c.rlike(r"(?i)\bclosed\s+now\b") if with_closed else F.lit(False)
        out = F.when(test, state).otherwise(out)
    return out


def package_availability(raw: Column, own: Column, bookable: Column) -> Column:
    """A package's state from its whole text without its own titles and descriptions (own: array): a negative one, else
    available if it is bookable or asks to book, else unknown."""
    rest = F.aggregate(F.filter(own, lambda x: x != ""), raw, lambda text, x: F.replace(text, x, F.lit(" ")))
    state = availability(rest, with_closed=False)
    return F.when(state.isin("sold-out", "unavailable"), state).when(bookable | raw.rlike(r"(?i)\b(?:reserve|book)\s+now\b"), "available").otherwise("unknown")


def closed_for_long(c: Column) -> Column:
    """Only a permanent or temporary closure; "closed now" is a state of the day."""
    return F.coalesce(c.rlike(r"(?i)\b(?:permanently|temporarily)\s+closed\b"), F.lit(False))


def slug(c: Column) -> Column:
    """Small ASCII letters and digits with single hyphens; accents are dropped."""
    return F.regexp_replace(F.regexp_replace(F.lower(nfkd_ascii(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def squeezed(c: Column) -> Column:
    """Control characters out, and every run of white space, of any kind, one blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " "), r"(?U)\s+", " "))


def cut(c: Column, limit: int) -> Column:
    """The first characters of a squeezed text."""
    return F.substring(squeezed(c), 1, limit)


def clipped(c: Column, limit: int) -> Column:
    """A squeezed text; over the limit up to the last end of a sentence (a mark before a blank or the limit) that is at half
    of the limit or later, else up to a word, with an ellipsis inside the limit; a text without blanks is cut anywhere."""
    return clipped_squeezed(squeezed(c), limit)


def clipped_squeezed(text: Column, limit: int) -> Column:
    """What clipped does after squeezing; it names the text many times, so it should be a column or a variable."""
    head = F.substring(text, 1, limit)
    sentence = F.regexp_extract(head, r"(?s)^(.*[.!?…])(?= |\z)", 1)
    words = F.regexp_replace(F.regexp_replace(head, r"(?s) [^ ]*\z", ""), r"[ ,;:\-]+\z", "")
    words = F.when(words == "", F.substring(head, 1, limit - 1)).otherwise(words)
    short = F.concat(F.rtrim(F.substring(words, 1, limit - 1)), F.lit("…"))
    return F.when(F.length(text) <= limit, text).when((sentence != "") & (F.length(sentence) >= limit // 2), sentence).otherwise(short)

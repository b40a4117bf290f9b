"""Scalar functions over contact data: phones, addresses, dates, quotes, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import comparable, phone_digits

# Categories and their patterns in order of priority.
ATTEMPT_RULES = [
    ("language_barrier", r"\blb\b|no e?n?glish|dont understand|unable to understand"),
    ("no_erasmus_project", r"no erasmus project"),
    ("email_requested", r"send email"),
    ("left_message", r"left msg"),
    ("transferred_failed", r"transfer"),
    ("hung_up", r"hung|hang"),
    ("callback_requested", r"call (on|at|tomorrow|tommorrow|back)|call tomorrow|available in|availabe call"),
    ("speaker_unclear", r"speaker"),
    ("not_connected", r"not connected|not being connected|unreachable|not working|single tone"),
    ("not_answered", r"not answer|not recieved|not recived|not being rec|didnt respond|not available|not availabe"),
]
# Dialling prefixes.
DIAL = {
    "353": "Ireland", "357": "Cyprus", "359": "Bulgaria", "370": "Lithuania", "381": "Serbia", "386": "Slovenia", "420": "Czechia",
    "421": "Slovakia", "351": "Portugal", "31": "Netherlands", "32": "Belgium", "33": "France", "34": "Spain", "36": "Hungary",
    "39": "Italy", "43": "Austria", "46": "Sweden", "48": "Poland", "49": "Germany", "66": "Thailand",
}
# Words that stand for no country.
NO_COUNTRY = ("unknown", "n/a", "na", "none", "-", "various", "multiple", "not stated", "not specified")
# Endings of domains, longest first where one begins another.
ENDINGS = (
    "info com org net edu gov int biz cat eus gal eu io ac co uk de fr es it pt nl be at ch pl cz sk hu si hr ro bg gr cy mt ie dk se no fi ee "
    "lv lt lu is tr rs ua ru mk al ba me xk ad li us ca"
).split()
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: The same matches, each run of characters tried once: from its beginning or behind the match before.
EMAIL_ONCE = EMAIL.replace("[A-Za-z0-9._%+-]+@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@")


def attempt_categories(text: Column) -> Column:
    """All categories of a note in order of priority; other if none, or if it says to respond well."""
    t = F.lower(text)
    hits = F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(c)) for c, p in ATTEMPT_RULES]))
    return F.when(F.contains(t, F.lit("respond well")) | (F.size(hits) == 0), F.array(F.lit("other"))).otherwise(hits)


def outcome_label(interested: Column, months: Column, booked: Column) -> Column:
    """The label of a call by facts: interest, months until arrival, a booked meeting."""
    return (
        F.when(~F.coalesce(interested, F.lit(False)), "none")
        .when(months.isNull(), "needs_arrival_date")
        .when(booked & (months < 4), "qualified_appointment")
        .when(~booked & (months < 4), "needs_review")
        .when(months <= 6, F.when(booked, "engagement_appointment").otherwise("engagement"))
        .otherwise(F.when(booked, "follow_up_appointment").otherwise("follow_up"))
    )


def split_phones(cell: Column) -> Column:
    """The digits of each part of a cell with several numbers."""
    return F.filter(F.transform(F.split(cell, r"[\n/;]+"), phone_digits), lambda d: d != "")


def dial_country(digits: Column) -> Column:
    """The country of a number's prefix, three digits before two; null if unknown."""
    table = F.create_map(*[F.lit(x) for pair in DIAL.items() for x in pair])
    return F.coalesce(F.element_at(table, F.substring(digits, 1, 3)), F.element_at(table, F.substring(digits, 1, 2)))


def day_month(text: Column) -> Column:
    """The first d/m of a text as dd/mm, or the empty text."""
    day, month = (F.regexp_extract(text, r"\b(\d{1,2})/(\d{1,2})\b", k) for k in (1, 2))
    return F.when(day == "", "").otherwise(F.concat(F.lpad(day, 2, "0"), F.lit("/"), F.lpad(month, 2, "0")))


def repaired_email(x: Column) -> Column:
    """An address that other text was glued to: cut behind a known ending that a capital follows; marks at its end go."""
    bare = F.regexp_replace(x, "[.,;:]+$", "")
    return F.regexp_replace(bare, rf"^([^@]*@(?:[^.]+\.)*?[^.]+\.(?:{'|'.join(ENDINGS)}))(?=[A-Z]).*$", "$1")


def marked_emails(text: Column) -> Column:
    """Addresses between angle brackets, without marks at their end."""
    found = F.regexp_extract_all(text, F.lit(r"<([^<>\s@]+@[^<>\s]+)>"), F.lit(1))
    return F.when(~F.contains(text, F.lit("<")), F.array().cast("array<string>")).otherwise(F.transform(found, lambda x: F.regexp_replace(x, "[.,;:]+$", "")))


def plain_emails(text: Column) -> Column:
    """All addresses in order, repaired."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"({EMAIL_ONCE})"), F.lit(1)), repaired_email)


def sign_words(text: Column) -> Column:
    """The words of a text that hold the sign, in order, parted by spaces: an address stands nowhere else, marked or not."""
    holds = lambda x: F.contains(x, F.lit("@"))
    lines = F.array_join(F.filter(F.split(text, "\n"), holds), " ")
    return F.array_join(F.filter(F.split(lines, " "), holds), " ")


def emails_in(text: Column) -> Column:
    """Distinct addresses in order: marked ones (<address>) alone if there are any, else all, repaired."""

    def found(t: Column) -> Column:
        marked = marked_emails(t)
        return F.array_distinct(F.when(F.size(marked) > 0, marked).otherwise(plain_emails(t)))

    return F.when(~F.contains(text, F.lit("@")), F.array().cast("array<string>")).otherwise(F.transform(F.array(sign_words(text)), found)[0])


def first_phone(text: Column) -> Column:
    """The first number of eight or more digits."""
    found = F.regexp_extract_all(text, F.lit(r"(\+?[0-9(][0-9() ./-]{6,}[0-9])"), F.lit(1))
    return F.get(F.filter(found, lambda x: F.char_length(phone_digits(x)) >= 8), 0)


def stands_in(piece: Column, text: Column) -> Column:
    """Whether the piece stands in the text letter for letter, which lower case and comparable() keep but for a sigma, whose form tells the end of a word."""
    return F.contains(text, piece) & ~F.contains(piece, F.lit("Σ"))


def quote_in_text(quote: Column, text: Column) -> Column:
    """True if the fragments of the quote, parted by dots of omission, stand in the text in this order.

    Both are made comparable first, unless the quote stands there letter for letter. A lone fragment of under three characters doesn't count.
    """
    whole = stands_in(quote, text) & (F.char_length(comparable(quote)) >= 3) & ~quote.rlike(r"\.\.\.|…")
    parts = F.filter(F.transform(F.split(F.coalesce(quote, F.lit("")), r"\s*(?:\.\.\.|…)\s*"), comparable), lambda x: x != "")
    hay = comparable(F.coalesce(text, F.lit("")))
    bound = F.transform(
        F.array(F.struct(parts.alias("p"), hay.alias("h"))),
        lambda s: F.when((F.size(s["p"]) == 0) | ((F.size(s["p"]) == 1) & (F.char_length(F.get(s["p"], 0)) < 3)), False).otherwise(
            F.aggregate(
                s["p"],
                F.lit(1),
                lambda at, f: F.when(at == 0, 0).otherwise(
                    F.when(F.call_function("locate", f, s["h"], at) == 0, 0).otherwise(F.call_function("locate", f, s["h"], at) + F.char_length(f))
                ),
            )
            > 0
        ),
    )
    return F.when(F.coalesce(whole, F.lit(False)), True).otherwise(bound[0])


def comparable_in(piece: Column, text: Column) -> Column:
    """Whether the piece, made comparable, stands in the text, made comparable."""
    return F.when(stands_in(piece, text), True).otherwise(F.contains(comparable(text), comparable(piece)))


def email_in_text(email: Column, text: Column) -> Column:
    e = F.btrim(email)
    return (e != "") & F.when(stands_in(e, text), True).otherwise(F.contains(F.lower(text), F.lower(e)))


def phone_in_text(phone: Column, text: Column) -> Column:
    """The last eight digits stand in the digits of the text; false for fewer than seven."""
    d = phone_digits(phone)
    return (F.char_length(d) >= 7) & F.contains(phone_digits(text), F.right(d, F.lit(8)))


def partner_scope(kind: Column, partner_country: Column, own_country: Column) -> Column:
    """International, National or Unknown from the two countries; a network without country is International."""
    known = lambda c: F.when(~comparable(c).isin(*NO_COUNTRY), comparable(c)).otherwise("")
    theirs, ours = known(F.coalesce(partner_country, F.lit(""))), known(F.coalesce(own_country, F.lit("")))
    return (
        F.when(theirs == "", F.when(F.lower(kind) == "network", "International").otherwise("Unknown"))
        .when(ours == "", "Unknown")
        .when(theirs == ours, "National")
        .otherwise("International")
    )


def minutes_text(minutes: Column) -> Column:
    """1 h 02 min; the empty text for nothing. Rounds half to even."""
    m = F.bround(minutes, 0).cast("int")
    h = F.floor(m / 60).cast("int")
    return F.when(F.coalesce(minutes, F.lit(0.0)) == 0, "").when(h > 0, F.format_string("%d h %02d min", h, m % 60)).otherwise(F.format_string("%d min", m))


def in_shift(ts: Column, start: str, end: str) -> Column:
    """Whether the time of day lies in the shift, both ends included."""
    return F.date_format(ts, "HH:mm").between(start, end)


def cell_kind(x: Column) -> Column:
    """'', link, number or text."""
    t = F.btrim(x)
    return F.when(t == "", "").when(t.rlike(r"(?i)^(https?://|www\.)"), "link").when(t.rlike(r"^[-+0-9.,()/ ]+$"), "number").otherwise("text")


def name_like(x: Column) -> Column:
    """Text of eight or more characters, at least half of them letters."""
    return (cell_kind(x) == "text") & (F.char_length(x) >= 8) & (2 * F.char_length(F.regexp_replace(x, r"[^\p{L}]", "")) >= F.char_length(x))


def slug(x: Column) -> Column:
    """A file name as an identifier of at most 36 characters."""
    return F.btrim(F.substring(F.regexp_replace(F.lower(F.regexp_replace(x, r"\.[A-Za-z0-9]+$", "")), "[^a-z0-9]+", "-"), 1, 36), F.lit("-"))


def formula_safe(x: Column) -> Column:
    """A leading apostrophe before what a sheet would read as a formula."""
    return F.when(x.rlike("^[=+@-]"), F.concat(F.lit("'"), x)).otherwise(x)


def hidden_email(code: Column) -> Column:
    """An address hidden as hex, the first byte of which is the key of all others."""
    byte = lambda k: F.conv(F.substr(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest((F.char_length(code) / 2).cast("int") - 1, F.lit(1))), lambda k: F.char(byte(k).bitwiseXOR(F.conv(F.substr(code, F.lit(1), F.lit(2)), 16, 10).cast("int")))), "")

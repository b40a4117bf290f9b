"""Identity keys. Each is a different notion of equality; they are not interchangeable.

All are column expressions that stay inside generated code. Accents are folded by a translate table that
is made from the Unicode database when the module is loaded.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_table() -> tuple[str, str]:
    """Lower-case letters with a decomposition, and the single base letters that they fold to."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x0370, 0x0530), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if char == char.lower() and len(base) == 1 and base != char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _fold_table()


def _ascii(x: Column) -> Column:
    return F.octet_length(x) == F.char_length(x)


def fold(x: Column) -> Column:
    """Lower case without accents; loose combining marks go. Plain ASCII, as many bytes as characters, has neither."""
    return F.when(_ascii(x), F.lower(x)).otherwise(F.regexp_replace(F.translate(F.lower(x), ACCENTED, PLAIN), r"\p{M}+", ""))


def ascii_key(x: Column) -> Column:
    """Lower case, only a-z and 0-9 are left; accented letters go."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def folded_words(x: Column) -> Column:
    """Folded, runs of other characters become one space, trimmed."""
    return F.btrim(F.regexp_replace(fold(x), "[^a-z0-9]+", " "))


def folded_key(x: Column) -> Column:
    """Folded, only a-z and 0-9 are left."""
    return F.regexp_replace(fold(x), "[^a-z0-9]", "")


def comparable(x: Column) -> Column:
    """For comparing quotes: folded, quotes and dashes unified, white space collapsed, punctuation kept."""
    wide = F.regexp_replace(F.translate(F.lower(x), ACCENTED + "‘’“”–—\u00a0", PLAIN + "''\"\"-- "), r"\p{M}+", "")
    plain = F.when(_ascii(x), F.lower(x)).otherwise(F.replace(wide, F.lit("ß"), F.lit("ss")))
    return F.btrim(F.regexp_replace(plain, r"[^\S ]\s*| \s+", " "))  # lone spaces stay as they are


def address_key(x: Column) -> Column:
    """Lower case, only a-z, 0-9, @ and the point are left."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9@.]", "")


def word_key(x: Column) -> Column:
    """Lower case, letters of any script kept with their accents, the rest one space."""
    return F.btrim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_]+", " "))


def upper_key(x: Column) -> Column:
    """Folded upper case of letters, digits and spaces."""
    return F.upper(F.btrim(F.regexp_replace(fold(x), "[^a-z0-9]+", " ")))


def host(url: Column) -> Column:
    """Host in lower case without www.; bare hosts count."""
    bare = F.regexp_replace(F.lower(F.btrim(url)), "^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(bare, "[/?#:].*$", ""), r"^www\.", "")


def url_key(url: Column) -> Column:
    """The url without scheme, www., fragment and closing slash; the query stays."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^www\.", ""), "/+$", "")


def registrable_domain(host_: Column, second_levels: tuple[str, ...] = ("co", "com", "ac", "edu", "gov", "org", "net")) -> Column:
    """The last two labels, or three where the second level is generic under a country code."""
    labels = F.split(host_, r"\.")
    generic = F.element_at(labels, F.greatest(F.size(labels) - 1, F.lit(1))).isin(*second_levels) & (F.char_length(F.element_at(labels, -1)) == 2)
    n = F.least(F.size(labels), F.when(generic, 3).otherwise(2))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def phone_digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def phone_hash(x: Column) -> Column:
    """A hash of the last eight digits; null for fewer than six digits."""
    d = phone_digits(x)
    return F.when(F.char_length(d) >= 6, F.substring(F.sha2(F.concat(F.lit("p:"), F.right(d, F.lit(8))), 256), 1, 16))


def email_hash(x: Column) -> Column:
    """A hash of the address in lower case; null without an at sign."""
    e = F.lower(F.btrim(x))
    return F.when(F.contains(e, F.lit("@")), F.substring(F.sha2(F.concat(F.lit("e:"), e), 256), 1, 16))


def same_site(a: Column, b: Column) -> Column:
    """Equal hosts, or one a subdomain of the other, whichever way round."""
    return (a == b) | a.endswith(F.concat(F.lit("."), b)) | b.endswith(F.concat(F.lit("."), a))

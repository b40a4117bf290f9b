"""Numbers as pages print them: the international form by the country's own rules, plausibility, and phones of a page with trust."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import phone_digits

# Countries with their dialling codes.
CODES = {
    "IT": "39", "FR": "33", "ES": "34", "PT": "351", "DE": "49", "AT": "43", "PL": "48", "NL": "31", "BE": "32", "RO": "40", "EL": "30", "GR": "30", "BG": "359", "MT": "356",
    "UK": "44", "GB": "44", "IE": "353", "TR": "90", "CZ": "420", "HR": "385", "SI": "386", "LT": "370", "LV": "371", "EE": "372", "FI": "358", "SE": "46", "DK": "45", "HU": "36",
    "SK": "421", "CY": "357", "LU": "352", "NO": "47", "IS": "354", "CH": "41", "RS": "381", "MK": "389", "AL": "355", "BA": "387", "ME": "382", "US": "1", "CA": "1", "UA": "380",
}
# What a national number looks like, digits only; elsewhere 8 to 12 digits.
NATIONAL = {
    "FR": r"0[1-9]\d{8}", "BE": r"0\d{8,9}", "IT": r"0\d{5,10}|3\d{9}", "ES": r"[6789]\d{8}", "PT": r"[29]\d{8}", "MT": r"[279]\d{7}", "DE": r"0[1-9]\d{5,11}", "AT": r"0[1-9]\d{4,11}",
    "PL": r"[1-9]\d{8}", "UK": r"0[1-9]\d{8,9}", "EL": r"(2\d|69)\d{8}", "RO": r"0[2-7]\d{8}", "NL": r"0[1-9]\d{8}", "IE": r"0[1-9]\d{6,9}", "CY": r"[29]\d{7}", "HR": r"0[1-9]\d{6,8}",
    "SI": r"0[1-9]\d{7}", "BG": r"0[2-9]\d{6,8}", "HU": r"06\d{8,9}", "CZ": r"[2-9]\d{8}", "SK": r"0[2-9]\d{7,8}", "LT": r"8\d{8}", "TR": r"0[2-5]\d{9}", "US": r"[2-9]\d{9}",
}
# Countries whose leading zero goes, and those with a longer trunk prefix.
TRUNK_ZERO, TRUNK = ("FR", "BE", "DE", "AT", "UK", "NL", "IE", "HR", "SI", "BG", "RO", "SK", "TR"), {"HU": "06", "LT": "8"}
# Words before a number that is none to call, and those before one that is.
NO_PHONE = r"(?i)(fax|telefax|p\.?\s?iva|vat|iva|cif|nif|siret|siren|c\.?\s?f\.|codice fiscale|iban|rea|n[°º]|nr\.?|ust|steuer|regon|nip|krs|uid|cod\.|cap|zip|isbn|issn)[^A-Za-z0-9]{0,4}$"
LABEL = r"(?i)\b(tel|phone|telefon|telefono|telephone|fon|call)[^A-Za-z0-9]{0,4}$"
#: A whole run of digits and the marks that part them.
RUN = r"(\+?\(?[0-9][0-9().\s/–-]{4,}[0-9])"
#: Mobile numbers by their international form.
MOBILE = r"^\+(393|34[67]|33[67]|491[5-7]|48[5-8]|3519|356[79]|447|3069)"


def _code(country: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair]), country)


def normal_phone(raw: Column, country: Column) -> Column:
    """The international form of a number as printed in a country (two letters); empty where it is no phone.

    '(0)' goes. With + or 00 (and over ten digits): a zero after the longest known code goes, but in Italy; 8 to 15
    digits. Else a national number of its country's own form, the trunk prefix left out.
    """
    def of(v: Column) -> Column:
        t, cc = F.btrim(F.replace(v["raw"], F.lit("(0)"), F.lit(" "))), v["cc"]
        d = phone_digits(t)
        plus = t.startswith("+")
        abroad = F.when(plus, d).when(t.startswith("00") & (F.char_length(d) > 10), F.substring(d, 3, 40))
        codes = "|".join(sorted({c for c in CODES.values() if c != "39"}, key=lambda c: (-len(c), c)))
        world = F.when(abroad.rlike("^39"), abroad).otherwise(F.regexp_replace(abroad, f"^({codes})0", "$1"))
        code = _code(cc)
        form = F.lit(r"^\d{8,12}$")
        for name, pattern in NATIONAL.items():
            form = F.when(cc == name, F.lit(f"^(?:{pattern})$")).otherwise(form)
        own = F.when(cc.isin(*TRUNK_ZERO), F.regexp_replace(d, "^0", ""))
        for name, prefix in TRUNK.items():
            own = own.when(cc == name, F.regexp_replace(d, f"^{prefix}", ""))
        home = F.when(F.char_length(d).between(6, 12) & code.isNotNull() & F.regexp_like(d, form), F.concat(F.lit("+"), code, own.otherwise(d))).otherwise("")
        return F.when(abroad.isNotNull(), F.when(F.char_length(world).between(8, 15), F.concat(F.lit("+"), world)).otherwise("")).otherwise(home)

    return F.transform(F.array(F.struct(F.coalesce(raw, F.lit("")).alias("raw"), country.alias("cc"))), of)[0]


def plausible_phone(raw: Column, country: Column) -> Column:
    """The international form of an unlabelled number that can only be a phone of its country; else empty.

    No date, range of years, counting sequence, two digits repeated, foreign code or long run of bare digits.
    """
    t, d = F.btrim(raw), phone_digits(raw)
    date = t.rlike(r"^(\d{1,2}[./-]\d{1,2}[./-](19|20)\d{2}|(19|20)\d{2}[./-]\d{1,2}[./-]\d{1,2})$")
    years = t.rlike(r"(19|20)\d{2}\s*[-–/]\s*(19|20)\d{2}") | d.rlike(r"^(19|20)\d{2}(19|20)\d{2}$")
    count = (F.size(F.array_distinct(F.split(d, "(?<=.)(?=.)"))) <= 2) | F.contains(F.lit("01234567890123456789"), d) | t.rlike(r"^0?1\s?0?2\s?0?3")
    abroad = t.rlike(r"^(\+|00)")
    theirs = F.regexp_replace(d, "^00", "").startswith(_code(country))
    bare = (F.char_length(d) < 8) | (~t.rlike(r"[ .\-/]") & (F.char_length(d) > 9))
    bad = date | years | count | F.when(abroad, ~F.coalesce(theirs, F.lit(False))).otherwise(bare)
    return F.when(bad, "").otherwise(normal_phone(raw, country))


def phone_trust(raw: Column, line: Column, linked: Column, structured: Column, country: Column) -> Column:
    """4 for a telephone link, 3 for structured data, 2 for a labelled number that is no fax, 1 for a plausible one, else 0."""
    labelled = F.lower(line).rlike(r"\b(tel|phone|telefon|telephone|fon|call)\b") & ~F.lower(line).rlike(r"\bfax\b")
    return F.when(linked, 4).when(structured, 3).when(labelled, 2).when(plausible_phone(raw, country) != "", 1).otherwise(0)


def page_phones(pages: DataFrame, ident: str, html: str, country: str) -> DataFrame:
    """ident, place, trust, phone and quote of the numbers of pages: 4 telephone links, 3 structured data, 2 labelled, 1 unlabelled.

    A labelled number follows its label; numbers that are faxes, tax or bank numbers by the word before them don't count.
    Unlabelled ones are told only of pages with no other, if plausible. The quote is up to 60 characters before the
    number (as far as the one before it) and 30 after it. place is the number's within its class.
    """
    cc = F.col(country)
    # a line break ends no text, and only ASCII letters make words
    strict = lambda p: re.sub(r"\$$", r"\\z", p).replace(r"\b", "(?<![A-Za-z0-9_])")
    known = lambda raw: F.coalesce(F.nullif(normal_phone(raw, cc), F.lit("")), F.when(F.btrim(raw).startswith("+") & F.char_length(phone_digits(raw)).between(8, 15), F.concat(F.lit("+"), phone_digits(raw))))
    rows = pages.select(F.col(ident), cc, F.coalesce(F.col(html), F.lit("")).alias("__h"))
    found = lambda pattern: F.regexp_extract_all("__h", F.lit(pattern), F.lit(1))
    linked = F.transform(found(r"""(?i)href\s*=\s*["']tel:([^"']+)"""), lambda x: F.struct(F.lit(4).alias("trust"), F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x).alias("raw"), F.concat(F.lit("tel: link "), x).alias("quote")))
    data = F.concat(found(r'"telephone"\s*:\s*"([^"]{6,30})"'), found(r"""(?i)itemprop=["']telephone["'][^>]{0,200}>\s*([^<]{6,30})<"""), found(r"""(?i)itemprop=["']telephone["'][^>]{0,200}content=["']([^"']{6,30})"""))
    data = F.transform(data, lambda x: F.struct(F.lit(3).alias("trust"), x.alias("raw"), F.concat(F.lit("data "), F.btrim(x)).alias("quote")))
    plain = F.regexp_replace(F.regexp_replace("__h", r"(?is)<(script|style|svg)\b.*?</\1\s*>|<!--.*?-->", " "), "<[^>]*>", " ")
    rows = rows.select(ident, cc, F.concat(linked, data).alias("__marked"), F.regexp_replace(plain, r"\s{2,}", " ").alias("__t"))
    rows = rows.select(ident, cc, "__marked", F.split("__t", RUN.replace("(\\+", "(?:\\+", 1)).alias("__p"), F.regexp_extract_all("__t", F.lit(RUN), F.lit(1)).alias("__n"))

    def beside(raw: Column, i: Column) -> Column:
        before, after = F.get("__p", i), F.get("__p", i + 1)
        glued = before.rlike(r"[\w/.=#@-]\z") | after.rlike(r"^\w")
        trust = F.when(before.rlike(strict(NO_PHONE)) | after.rlike(r"(?i)^\s*fax") | glued, 0).when(before.rlike(strict(LABEL)), 2).otherwise(1)
        return F.struct(trust.alias("trust"), raw.alias("raw"), F.btrim(F.concat(F.right(before, F.lit(60)), raw, F.substring(after, 1, 30))).alias("quote"))

    rows = rows.select(ident, cc, F.concat("__marked", F.transform("__n", beside)).alias("__all"))
    form = lambda x: F.struct(x["trust"].alias("trust"), F.when(x["trust"] == 1, F.nullif(plausible_phone(x["raw"], cc), F.lit(""))).otherwise(known(x["raw"])).alias("phone"), x["quote"].alias("quote"))
    good = F.filter(F.transform(F.filter("__all", lambda x: x["trust"] > 0), form), lambda x: x["phone"].isNotNull())
    rows = rows.select(ident, good.alias("__good"))
    best = F.when(F.exists("__good", lambda x: x["trust"] > 1), F.filter("__good", lambda x: x["trust"] > 1)).otherwise(F.col("__good"))
    return rows.select(ident, F.posexplode(best).alias("place", "__x")).select(ident, "place", "__x.trust", "__x.phone", "__x.quote")


def best_site_phone(found: DataFrame, site: str, order: str, trust: str = "trust", phone: str = "phone") -> DataFrame:
    """site, phone and trust: of a site's numbers of most trust the most frequent, a mobile counting half a time less; then the first, landlines before mobiles."""
    mobile = F.col(phone).rlike(MOBILE).cast("int")
    best = found.groupBy(site).agg(F.max(trust).alias("trust"))
    at_best = found.join(best, [site, trust]).groupBy(site, phone, trust).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return at_best.groupBy(site).agg(F.max_by(F.struct(phone, trust), F.struct(F.col("n") - 0.5 * mobile, -mobile, -F.col("first"))).alias("p")).select(site, f"p.{phone}", f"p.{trust}")

"""Personal data by weak supervision (DataFrame functions only).

Base spans come from fixed patterns and always count. Further candidate spans come from wide patterns:
obfuscated addresses, unmarked phones, account numbers, secrets, persons, postal addresses, dates of birth and
numbers of documents. Regex, gazetteer and context labelers vote on every candidate (for, against, abstain).
For each kind, expectation maximisation over the counts of vote patterns estimates how reliable each labeler is,
and so how likely each pattern means personal data. These soft labels train a naive Bayes classifier over
features of the spans (length, digits, neighbours, context; each by kind), which decides about the spans to add.
Persons, dates and bare numbers need context: a title, or words of identity or contact close by; a word against, such as
commit or version, is enough to leave any candidate. Persons are candidates by their form, two or more words with capitals, or a title
and one; the gazetteer of given names only votes.

The counts cover all documents. The driver sees vote patterns and feature values only: 3 ** 6 patterns at
most, times eight kinds and a few dozen values of features. Spans stay with their document's row, so nothing is shuffled
but those counts.

Positions are code points, ends exclusive. They are the running lengths of the pieces between matches.

Defined results for odd input: a null text counts as the empty text and has no spans; ties between
overlapping candidates fall to the left one, and candidates that touch a base span are dropped; repeated
rows get equal results; with no candidates at all no span is added; an empty table gives an empty table;
further columns, whatever their names, pass through ``redact`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, settle

LOCAL = "A-Za-z0-9._%+-"
#: The fixed patterns, written so that Java's matcher neither recurses nor rescans a run: possessive, and
#: begun only where a run begins or the last match ended.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "secret", "account", "person", "address", "birth", "id"]
# Given names that are common in the languages of the texts, and that are no places or words.
GIVEN = (
    "Adam Alice Amanda Amelie Ana Andrea Andreas Andrew Angela Anna Anne Antoine Antonio Barbara Beatriz Benjamin Bernd Birgit Brian Camille Carlos Carmen Carol Caroline Catherine Christian Christine "
    "Christoph Claire Claudia Cristina Daniel David Deborah Diego Dieter Dominique Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Ernst Eva Fernando Florian Francisco Franz Gary George Gerhard "
    "Guillaume Hannah Hans Heike Heinz Helen Helga Ingrid Isabel Isabelle Jacques James Jan Jane Janet Javier Jean Jennifer Jessica Johann John Jonathan Jorge Jose Joseph Joshua Juan Julia Julie Julien "
    "Karen Karin Karl Katharina Kathrin Kevin Klaus Laura Laurent Linda Lisa Louise Lucas Lucia Luis Lukas Manuel Marc Marco Margaret Maria Marie Mark Markus Marta Martin Martina Mary Matthew Matthias "
    "Melissa Michael Michel Michelle Miguel Monika Nancy Nathalie Nicolas Nicole Nicholas Olivier Oscar Pablo Patricia Patrick Paul Pedro Peter Petra Philippe Pierre Rachel Rafael Raquel Rebecca Renate "
    "Richard Robert Ruth Sabine Samuel Sandra Sara Sarah Sergio Sharon Simon Sophie Stefan Stephanie Stephen Steven Susan Susanne Sylvie Teresa Thierry Thomas Ursula Uwe Valerie Veronique William Wolfgang Yves"
).split()
#: The names by their first letters, led by a look at it, so that the search passes over most places at once.
GIVEN_ANY = "(?=[A-Z])(?:" + "|".join(f"{c}(?:{'|'.join(g[1:] for g in GIVEN if g[0] == c)})" for c in sorted({g[0] for g in GIVEN})) + ")"
# Cities that stand after postal addresses, institutions and providers of mail.
PLACES = "London Paris Berlin Madrid Hamburg Munich Lyon Marseille Barcelona Sevilla Valencia Vienna Zurich Brussels Dublin Manchester Birmingham Edinburgh Boston Chicago Seattle Houston Dallas Denver Springfield Cologne Frankfurt Toulouse Bordeaux Lisbon Rome Milan"
INSTITUTIONS = "bank|clinic|hospital|insurance|university|school|college|sparkasse|universidad|universit[eé]|h[oô]pital|embassy|ministry|police|court"
PROVIDERS = "gmail|outlook|yahoo|hotmail|proton|icloud|aol|gmx|web\\.de|orange|example|mail"
STREET = "Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Court|Square|Boulevard|Blvd|Way|Terrace|Crescent"
UPPER_WORD = r"\p{Lu}[\p{L}'-]*+"
TITLE = "(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)"
#: A word of a name; titles and salutations are none.
NAME = rf"(?!(?:{TITLE}|Dear|Hello|Hi|Attn|Regards|Sincerely)\b)\p{{Lu}}(?:['’]\p{{Lu}})?\p{{L}}++(?:-\p{{Lu}}\p{{L}}++)*+(?![0-9])"
#: A postal code and its place.
TOWN = r"(?:,?\x20[0-9]{4,5}\x20\p{Lu}\p{L}++(?:[\x20-]\p{Lu}\p{L}++)?)?"
WAY = rf"(?:rue|avenue|boulevard|place|calle|plaza|avenida)\x20(?:(?:de|du|la|los|las|des)\x20)*+{UPPER_WORD}(?:\x20{UPPER_WORD})*+"
#: What further personal data may look like: a candidate is a match of one of these. Runs are open-ended and possessive.
WIDE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++\s?[\[(]\s?(?:at|AT)\s?[\])]\s?[A-Za-z0-9-]++(?:(?:\.|\s?[\[(]\s?(?:dot|DOT)\s?[\])]\s?)[A-Za-z0-9-]++)++",
    "account": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "birth": r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9])",
    "phone": r"\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
    "address": rf"(?:[0-9]{{1,5}}[A-Za-z]?\x20(?:{UPPER_WORD}\x20){{1,6}}?(?:{STREET})\b|[0-9]{{1,4}}(?:\x20?(?:bis|ter))?,?\x20{WAY}|{WAY},?\x20[0-9]{{1,5}}|\p{{Lu}}\p{{L}}*(?:stra(?:ß|ss)e|weg|platz|allee)\x20[0-9]{{1,4}}[a-z]?\b){TOWN}",
    "id": r"[A-Z]{0,2}[0-9]{6,12}(?![A-Za-z0-9_/+-])",
    "secret": r"[A-Za-z0-9_/+-]{20,}+",
    "person": rf"(?=\p{{Lu}})(?:{TITLE}\.?\x20)?{NAME}\x20(?:\p{{Lu}}\.\x20)?(?:(?:van|von|de|da|di|del|della|der|den|la|le|bin|ibn|al|el)\x20)*+{NAME}(?:\x20{NAME})?|(?=[DFHMPS]){TITLE}\.?\x20{NAME}",
}
WIDE_ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{WIDE[k]})" for k in WIDE) + ")"
STRICT = r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?|[0-9a-f]{32,}+|(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_/+-]{24,}+|.*[\[(]\s?(?:at|AT)\s?[\])].*|(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20.*)$"
GAZETTEER = rf"(?i)\b(?:{PROVIDERS})\b|\.(?:com|org|net|edu|gov|de|fr|es|it|uk)\b|^(?:ghp|gho|sk|pk|xox[bp]|akia|aiza)[_-]?|^(?:DE|FR|ES|IT|GB|NL)[0-9]{{2}}"
GAZETTEER_NEAR = rf"\b(?:{PLACES.replace(' ', '|')})\b|(?i)\b(?:{INSTITUTIONS})\b"
BEFORE = r"(?i)\b(?:phone|tel|telephone|mobile|fax|call|contact|mail|e-mail|email|write to|reach|token|key|secret|password|passwd|pwd|bearer|ssn|iban|account|passport|card|identity|licen[cs]e|id|name is|named|signed|patient|resident|dear|regards|sincerely|attn|i am|i'm|applicant|employee|tenant|lives? (?:at|in)|living at|address|born|birth|dob|né|née|geboren|nacid[oa]|wohnhaft|adresse|name)\b(?:\W{0,12}|\W{1,3}(?:is|on|no|number|at|am|le|el|in|by)\W{1,3})$"
#: What says of a date or number itself what it is.
NAMED = r"(?i)\b(?:born|birth|dob|birthday|né|née|geboren|nacid[oa]|passport|identity|licen[cs]e|ssn|personalausweis|dni)\b(?:\W{0,12}|\W{1,3}(?:is|on|no|number|at|am|le|el)\W{1,3})$"
AFTER = r"(?i)^\W{0,4}(?:(?:who )?lives?|living|residing|born|birth|dob|né|née|geboren|nacid[oa]|wohnhaft|phone|tel|mobile|e-?mail|passport|address|adresse|aged|ssn|account)\b"
AGAINST = r"(?i)\b(?:version|page|pages|chapter|isbn|issn|doi|figure|table|section|article|line|no|order|year|commit|sha1|md5|checksum)\b\W{0,6}$"
DUMMY = r"^(.)\1+$|^(?:0123456789|1234567890|123-45-6789)$|(?:xxxx|0000000)"
LABELERS = 6
#: Kinds that mean nothing without context.
NEEDY = ("person", "birth", "id")


def _running(steps: Column, block: int = 256) -> Column:
    """The sum of the numbers before each one, in two levels, so that long arrays cost no square of their length."""
    grow = lambda xs: F.aggregate(
        xs, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("all")), lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all"))
    )
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / block).cast("int")), lambda b: grow(F.slice(steps, b * block + 1, block)))
    placed = lambda inner: let(grow(F.transform(inner, lambda x: x["at"]))["all"], lambda outer: F.flatten(F.transform(inner, lambda x, b: F.transform(x["all"], lambda v: v + F.get(outer, b)))))
    return let(blocks, placed)


def _spans(text: Column, regex: str, ok, more=lambda match, before, after: {}) -> Column:
    """Array of the matches that pass ok: start, end, and the fields that more gives."""

    def walk(found: Column) -> Column:
        def with_pieces(pieces: Column) -> Column:
            def with_places(at: Column) -> Column:
                def one(i: Column) -> Column:
                    match, start = F.get(found, i), F.get(at, i) + F.char_length(F.get(pieces, i))
                    fields = more(match, F.get(pieces, i), F.get(pieces, i + 1))
                    return F.struct(start.alias("start"), (start + F.char_length(match)).alias("end"), *[v.alias(k) for k, v in fields.items()])

                return F.transform(F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: ok(F.get(found, i))), one)

            return let(_running(F.transform(found, lambda m, i: F.char_length(m) + F.char_length(F.get(pieces, i)))), with_places)

        return F.when(F.size(found) > 0, let(F.split(text, regex, -1), with_pieces))

    return let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), walk)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def total(d: Column) -> Column:
        value = lambda i: F.substr(d, i + 1, F.lit(1)).cast("int")
        double = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return F.aggregate(F.sequence(F.lit(0), F.char_length(d) - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, double(value(i))).otherwise(value(i)))

    return let(F.reverse(digits), total) % 10 == 0


def _base_ok(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":  # parts of any length: leading zeros go before the comparison
        return F.forall(F.split(match, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.char_length(q) < 3) | ((F.char_length(q) == 3) & (q <= "255"))))
    if kind == "card":
        return let(_digits(match), lambda d: F.char_length(d).between(16, 19) & F.when(F.char_length(d).between(16, 19), _luhn(d)).otherwise(False))
    return F.char_length(_digits(match)).between(8, 15)


def base_spans(text: Column) -> Column:
    """Array of kind, start, end by kind as listed, then start. Each pattern is looked for only where its signs occur."""
    sign = {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]"), "phone": F.contains(text, F.lit("+"))}
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    parts = []
    for kind, regex in BASE.items():
        found = _spans(text, regex, lambda m, k=kind: _base_ok(k, m))
        name = F.lit(kind).alias("kind")
        named = F.transform(found, lambda s: F.struct(name, s["start"].alias("start"), s["end"].alias("end")))  # noqa: B023
        parts.append(F.coalesce(F.when(sign[kind], named), none))
    return F.concat(*parts)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """2 for, 1 abstain, 0 against."""
    out = F.when(yes, 2)
    return (out.when(no, 0) if no is not None else out).otherwise(1)


def _judge(match: Column, before: Column, after: Column) -> dict[str, Column]:
    """The votes of the labelers as one number of base 3, and the features of a candidate."""
    tail, next_ = F.right(before, F.lit(40)), F.substr(after, F.lit(1), F.lit(40))
    head = F.substr(after, F.lit(1), F.lit(1))
    n, digits = F.char_length(match), F.char_length(_digits(match))
    kind = F.lit(None).cast("string")
    for name in reversed(WIDE):
        kind = F.when(match.rlike(f"^(?:{WIDE[name]})$"), name).otherwise(kind)
    kind = F.coalesce(kind, F.lit("secret"))

    def figures(k: Column) -> Column:
        needy = k.isin(*NEEDY)
        place = k.isin("person", "address")
        near = tail.rlike(BEFORE) | (place & next_.rlike(AFTER))
        mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        titled = (k == "person") & match.rlike(STRICT)
        ends = head.rlike(r"^[\x20\t\n.,;:!?)\"'\]]?$") & ((digits > 0) | (k == "email"))
        votes = [
            F.when((k == "person") & ~titled, 1).otherwise(_vote(match.rlike(STRICT) | (k == "address") | (k.isin("birth", "id") & tail.rlike(NAMED)), needy | ~match.rlike("[0-9]"))),
            F.when(place | k.isin("birth", "email"), 1).otherwise(_vote(mixed & (digits * 5 > n) | (digits >= 9), digits == 0)),
            _vote(((k == "person") & match.rlike(rf"^(?:{TITLE}\.?\x20)?{GIVEN_ANY}\b")) | match.rlike(GAZETTEER) | (~k.isin("secret", "phone") & (next_.rlike(GAZETTEER_NEAR) | tail.rlike(GAZETTEER_NEAR)))),
            _vote(near, (needy & ~titled) | tail.rlike(AGAINST)),
            F.when(place, _vote(next_.rlike(AFTER), (k == "person") & ~near & ~titled)).otherwise(_vote(ends, head.rlike(r"^[\p{L}\p{N}_@#*$%&]"))),
            _vote(F.lit(False), match.rlike(DUMMY)),
        ]
        code = votes[0]
        for v in votes[1:]:
            code = code * 3 + v
        return F.struct(
            code.alias("code"),
            F.least(F.floor(n / 8), F.lit(8)).cast("int").alias("size"),
            F.floor(10 * digits / F.greatest(n, F.lit(1))).cast("int").alias("digits"),
            F.when(near | titled, 2).when(tail.rlike(AGAINST), 0).otherwise(1).alias("context"),
            F.when(head == "", 0).when(head.rlike(r"^\s"), 1).when(head.rlike(r"^[\p{L}\p{N}]"), 2).otherwise(3).alias("neighbour"),
        )

    return {"kind": kind, "f": let(kind, figures)}


FEATURES = ["size", "digits", "context", "neighbour"]
#: No candidate is without a digit, a bracketed at, or a capital behind a space.
SIGN = r"[0-9]|[\[(]\s?(?:at|AT)\s?[\])]|\x20\p{Lu}"


def candidates(text: Column) -> Column:
    """Array of the matches of the wide patterns that hold a digit, a bracketed at, or a name."""
    found = _spans(text, WIDE_ANY, lambda m: m.rlike(r"[0-9]|[\[(]\s?(?:at|AT)|\x20\p{Lu}"), _judge)
    return F.when(text.rlike(SIGN), found)


def estimate(patterns: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Expectation maximisation: for each vote pattern the chance that it means personal data.

    A two-class model in which the labelers vote independently given the class; begins at the majority.
    """
    votes = {p: [p // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS)] for p in patterns}
    chance = {p: 1 / (1 + math.exp(-sum(x - 1 for x in v))) for p, v in votes.items()}
    for _ in range(rounds):
        total = sum(patterns.values()) + 2
        prior = (1 + sum(n * chance[p] for p, n in patterns.items())) / total
        prior = min(max(prior, 0.02), 0.98)
        table = [[[0.5] * 3, [0.5] * 3] for _ in range(LABELERS)]
        for p, n in patterns.items():
            for j, v in enumerate(votes[p]):
                table[j][1][v] += n * chance[p]
                table[j][0][v] += n * (1 - chance[p])
        for j in range(LABELERS):
            for y in (0, 1):
                s = sum(table[j][y])
                table[j][y] = [x / s for x in table[j][y]]
        for p, v in votes.items():
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][1][x] / table[j][0][x]) for j, x in enumerate(v))
            chance[p] = 1 / (1 + math.exp(-max(-500, min(500, odds))))
    return chance


def train(found: DataFrame) -> Column | None:
    """A function of a candidate struct, as the weights of a naive Bayes classifier of its kind: log odds as a Column builder."""
    each = found.select(F.explode("more").alias("s"))
    values = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"s.f.{f}").cast("string").alias("v")) for f in FEATURES])
    rows = each.select("s.kind", "s.f.code", F.explode(values).alias("x"))
    counts = rows.groupBy("kind", "code", "x.f", "x.v").agg(F.count("*").alias("n")).collect()
    patterns: dict[str, dict[int, int]] = {}
    for r in counts:
        if r["f"] == FEATURES[0]:
            own = patterns.setdefault(r["kind"], {})
            own[r["code"]] = own.get(r["code"], 0) + r["n"]
    if not patterns:
        return None
    chance = {kind: estimate(own) for kind, own in patterns.items()}
    sums: dict[tuple[str, str], list[float]] = {}
    for r in counts:
        cell = sums.setdefault((r["kind"], f"{r['f']}|{r['kind']}|{r['v']}"), [0.0, 0.0])
        cell[1] += r["n"] * chance[r["kind"]][r["code"]]
        cell[0] += r["n"] * (1 - chance[r["kind"]][r["code"]])
    total = {kind: [sum(n * abs(y - 1 + chance[kind][p]) for p, n in own.items()) for y in (0, 1)] for kind, own in patterns.items()}
    weights = {}
    for (kind, name), cell in sums.items():
        no, yes = total[kind]
        share = sum(cell) / (no + yes)  # a value's share smooths its chance in either class, so that rare values weigh little
        weights[name] = math.log((cell[1] + share) / (yes + 1)) - math.log((cell[0] + share) / (no + 1))
    table = lambda entries: F.create_map(*[F.lit(x) for pair in sorted(entries.items()) for x in pair])
    prior = table({kind: math.log((t[1] + 1) / (t[0] + 1)) for kind, t in total.items()})
    known = table(weights)

    def odds(span: Column) -> Column:
        out = F.coalesce(F.element_at(prior, span["kind"]), F.lit(0.0))
        for f in FEATURES:
            out = out + F.coalesce(F.element_at(known, F.concat_ws("|", F.lit(f), span["kind"], span["f"][f].cast("string"))), F.lit(0.0))
        return out

    return odds


def _blocks(spans: Column, size: int = 64) -> Column:
    """Spans in order of start, in blocks with their first start and last end."""
    cut = lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / size).cast("int")), lambda k: F.slice(xs, k * size + 1, size))
    framed = lambda xs: F.transform(cut(xs), lambda b: F.struct(b[0]["start"].alias("from"), F.array_max(F.transform(b, lambda x: x["end"])).alias("to"), b.alias("of")))
    return F.when(F.size(spans) > 0, let(F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))), framed))


def _clear(more: Column, base: Column) -> Column:
    """The spans of more that meet none of base; only blocks that a span meets are looked into."""
    free = lambda m, blocks: ~F.exists(blocks, lambda k: (k["from"] < m["end"]) & (m["start"] < k["to"]) & F.exists(k["of"], lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return F.when(F.size(base) > 0, let(_blocks(base), lambda blocks: F.filter(more, lambda m: free(m, blocks)))).otherwise(more)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """id, base (the base spans) and added (further spans) for every row of docs: arrays of kind, start, end.

    With keep_text the text column comes along as text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    both = let(base_spans(text), lambda base: F.struct(base.alias("base"), _clear(candidates(text), base).alias("more")))
    found = rows.select("id", *["text"] * keep_text, both.alias("x")).select("id", *["text"] * keep_text, "x.base", "x.more")
    found = settle(found, "pii-spans")
    odds = train(found)
    span = lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    context = lambda m: m["f"]["context"]
    fits = lambda m: (context(m) > 0) & (~m["kind"].isin(*NEEDY) | (context(m) == 2))
    added = none if odds is None else F.coalesce(F.transform(F.filter("more", lambda m: fits(m) & (odds(m) > 0)), span), none)
    return found.select("id", *["text"] * keep_text, "base", added.alias("added"))


def ordered(spans: Column) -> Column:
    """The spans by kind as listed, then start."""
    place = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])
    keyed = F.transform(spans, lambda s: F.struct(F.element_at(place, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.sort_array(keyed)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Code points of a page of a text.
PAGE = 2048


def _reach(ends: Column, block: int = 256) -> Column:
    """The greatest of the numbers before each one, 0 before the first, in two levels."""
    grow = lambda xs, begin: F.aggregate(
        xs, F.struct(begin.alias("at"), F.expr("cast(array() as array<int>)").alias("all")), lambda acc, x: F.struct(F.greatest(acc["at"], x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all"))
    )
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / block).cast("int")), lambda b: F.slice(ends, b * block + 1, block))
    return let(cut, lambda parts: let(grow(F.transform(parts, lambda p: F.array_max(p)), F.lit(0))["all"], lambda begins: F.flatten(F.transform(parts, lambda p, b: grow(p, F.get(begins, b))["all"]))))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span of its text replaced by its kind in brackets, as [EMAIL]; null stays null.

    Of spans that overlap the one that begins first, or else is longer, gives the name; the union goes.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = find(docs.select(row.alias("__row"), F.col(f"`{text_col}`").alias("__text")), "__row", "__text")
    spans = F.sort_array(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    text = F.col(f"id.`{text_col}`")
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.char_length(text) - 1) / PAGE).cast("int")), lambda k: F.substr(text, k * PAGE + 1, F.lit(PAGE)))

    def made(x: Column) -> Column:  # x: spans, reach (where the spans before each end) and pages
        def cut(a: Column, b: Column) -> Column:  # from the pages that a piece lies on: a look into the whole text would count from its beginning
            first, last = F.floor(a / PAGE).cast("int"), F.floor((b - 1) / PAGE).cast("int")
            part = lambda k: F.substr(F.get(x["pages"], k), F.greatest(a - k * PAGE, F.lit(0)) + 1, b - F.greatest(a, k * PAGE))
            return F.when(a < b, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")

        def piece(s: Column, i: Column) -> Column:
            at = F.get(x["reach"], i)
            return F.when(s["start"] >= at, F.concat(cut(at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

        rest = let(F.array_max(F.transform(x["spans"], lambda s: -s["less"])), lambda at: cut(at, F.char_length(text)))
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), rest)

    clean = let(F.struct(spans.alias("spans"), pages.alias("pages")), lambda y: let(F.struct(y["spans"].alias("spans"), y["pages"].alias("pages"), _reach(F.transform(y["spans"], lambda s: -s["less"])).alias("reach")), made))
    return found.select("id", F.when(F.size(spans) > 0, clean).otherwise(text).alias("__clean")).select(*[F.col("__clean").alias(c) if c == text_col else F.col(f"id.`{c}`") for c in docs.columns])

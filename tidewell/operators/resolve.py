"""Resolving claims against numbered evidence, registers and lists: joins on line numbers, keys and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.contacts import email_names_person, looks_like_person, name_tokens, pick_email, states_role
from tidewell.functions.keys import email_hash, fold, folded_key, phone_digits, phone_hash
from tidewell.functions.text import EMAIL, emails_in, first_phone


def phone_on_lines(lines: DataFrame, phones: DataFrame, entity: str, phone: str, n: str = "n") -> DataFrame:
    """entity, n: the first line of the entity whose digits hold the last eight of its number."""
    want = phones.select(entity, F.right(phone_digits(F.col(phone)), F.lit(8)).alias("__d")).filter(F.char_length("__d") >= 7)
    hit = lines.join(want, entity).filter(F.contains(phone_digits(F.col("line")), F.col("__d")))
    return hit.groupBy(entity).agg(F.min(n).alias(n))


# Role classes in order of rank, with the confidence that each has.
ROLE_CONFIDENCE = {
    "institutional_erasmus_coordinator": 0.9, "international_relations_head": 0.85, "international_relations_officer": 0.8, "mobility_coordinator": 0.8, "vice_rector_international": 0.7,
    "faculty_coordinator": 0.6, "principal_or_director": 0.55, "language_or_project_teacher": 0.5, "secretary_or_admin": 0.4, "other": 0.3,
}
# What a person may be in charge of.
REMIT = r"erasmus|international|mobilit|outgoing|incoming|exchange|relazioni|relations|auslandsamt|internacional"


def resolve_contacts(claims: DataFrame, lines: DataFrame, entity: str) -> DataFrame:
    """Claims that the numbered lines bear out, with role_class, email, phone, quote, confidence and place.

    claims: entity, claim (unique in it), name, role_class, and the lines name_n, role_n, email_n and phone_n that they cite, or null;
    lines: entity, page, n, line. A claim stands if the name looks like a person's, its line holds all its tokens, and
    one of these holds: a role is stated on the role's line or the name's; the role's line names a remit within two
    lines, with an address or number cited within six; the address is the person's own (it carries their name) and
    stands within three lines of it. Lines of another page count for nothing: the role's line is then the name's.
    The address is the first that carries the name on the cited lines, or their only one. Equal lines go once to the shuffle:
    cited lines are looked up in one join. place: by role, with an address first, then by claim.
    """
    cited = claims.select(entity, "claim", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_n").alias("n")) for k in ("name", "role", "email", "phone")])).alias("c")).select(entity, "claim", "c.kind", "c.n").filter("n IS NOT NULL")
    at = cited.join(lines.select(entity, "n", "page", "line"), [entity, "n"]).groupBy(entity, "claim")
    at = at.agg(*[F.first(F.when(F.col("kind") == k, F.struct("page", "n", "line")), ignorenulls=True).alias(k) for k in ("name", "role", "email", "phone")])
    got = claims.select(entity, "claim", F.btrim("name").alias("name"), F.col("role_class").alias("said")).join(at.withColumnRenamed("name", "nl"), [entity, "claim"]).filter("nl IS NOT NULL")
    here = lambda c: F.when(F.col(f"{c}.page") == F.col("nl.page"), F.col(c))
    got = got.withColumns({"rl": F.coalesce(here("role"), F.col("nl")), "el": here("email"), "pl": here("phone")})
    text = fold(F.col("nl.line"))
    tokens = F.regexp_extract_all(fold(F.col("name")), F.lit("([a-z]{2,})"), F.lit(1))
    on_line = (F.size(tokens) > 0) & F.forall(tokens, lambda t: F.contains(text, t))
    mails = F.flatten(F.array(*[emails_in(F.coalesce(F.col(f"{c}.line"), F.lit(""))) for c in ("el", "nl", "rl")]))
    mails = F.filter(mails, lambda e, i: F.array_position(F.transform(mails, F.lower), F.lower(e)) == i + 1)
    got = got.filter(looks_like_person(F.col("name")) & on_line).withColumn("email", F.coalesce(pick_email(F.col("name"), mails), F.lit("")))
    apart = lambda c: F.abs(F.col(f"{c}.n") - F.col("nl.n"))
    own = (F.col("email") != "") & email_names_person(F.col("email"), F.col("name")) & (F.col("el").isNull() | (apart("el") <= 3))
    remit = fold(F.col("rl.line")).rlike(REMIT) & (apart("rl") <= 2) & (F.coalesce(apart("el") <= 6, F.lit(False)) | F.coalesce(apart("pl") <= 6, F.lit(False)))
    stated = states_role(F.concat_ws(" ", "rl.line", "nl.line"))
    pair = F.when(F.col("rl.n") < F.col("nl.n"), F.concat_ws(" ... ", "rl.line", "nl.line")).otherwise(F.concat_ws(" ... ", "nl.line", "rl.line"))
    role = F.when(F.col("said").isin(*ROLE_CONFIDENCE), F.col("said")).otherwise("other")
    sure = F.element_at(F.create_map(*[F.lit(x) for p in ROLE_CONFIDENCE.items() for x in p]), F.col("role_class")) + F.when(F.col("email") != "", 0.05).otherwise(-0.1)
    out = got.filter(stated | remit | own).select(
        entity, "claim", "name", role.alias("role_class"), "email", F.when(F.col("pl").isNotNull(), F.coalesce(first_phone(F.col("pl.line")), F.lit(""))).otherwise("").alias("phone"),
        F.when(F.col("rl.n") == F.col("nl.n"), F.col("nl.line")).otherwise(pair).alias("quote"),
    ).withColumn("confidence", F.bround(F.greatest(F.lit(0.3), F.least(F.lit(0.95), sure)), 2))
    rank = F.array_position(F.array(*map(F.lit, ROLE_CONFIDENCE)), F.col("role_class"))
    return out.withColumn("place", F.row_number().over(Window.partitionBy(entity).orderBy(rank, F.col("email") == "", "claim")))


def resolve_network(partners: DataFrame, own: DataFrame, entity: str, name: str, order: str) -> DataFrame:
    """Partners of an entity, each folded name once (the first), the entity's own name dropped."""
    keyed = partners.withColumn("__k", folded_key(F.col(name))).filter("__k <> ''")
    first = keyed.groupBy(entity, "__k").agg(F.min(F.struct(order, name)).alias("p"))
    mine = own.select(entity, folded_key(F.col(name)).alias("__k"))
    return first.join(mine, [entity, "__k"], "left_anti").select(entity, f"p.{order}", f"p.{name}")


def topic_roles(people: DataFrame, lines: DataFrame, entity: str, remit: str, near: int = 2, reach: int = 6) -> DataFrame:
    """People (entity, person, n) with a line of the remit within near lines and an address or number within reach, on the page of their own line."""
    own = people.join(lines.select(entity, "n", "page"), [entity, "n"])
    others = lines.select(entity, F.col("n").alias("m"), F.col("page"), F.lower("line").rlike(remit).alias("remit"), F.col("line").rlike(rf"{EMAIL}|[0-9][0-9 ()/-]{{7,}}[0-9]").alias("reach"))
    # An equi-join on buckets of lines: a line meets those of its bucket and the two beside it.
    width = 2 * reach
    left = own.withColumn("__b", F.explode(F.array(*[F.floor(F.col("n") / width) + k for k in (-1, 0, 1)])))
    both = left.join(others.withColumn("__b", F.floor(F.col("m") / width)), [entity, "page", "__b"])
    gap = F.abs(F.col("m") - F.col("n"))
    return both.groupBy(entity, "person").agg(F.max(F.col("remit") & (gap <= near)).alias("r"), F.max(F.col("reach") & (gap <= reach)).alias("c")).filter("r AND c").select(entity, "person")


def town_match(names: DataFrame, register: DataFrame, generic: tuple[str, ...] = (), most: int = 4) -> DataFrame:
    """name_id, grp: names of a country and a town that an entry of a register has, and whose other telling words are just the entry's; one group only.

    names: name_id, country and words; register: entry_id, grp, country, town (its words) and words. A town is a run of most words of
    the name at most, over three characters long. Telling words have three letters or more, aren't numbers and not generic. That the
    name's words are all in the entry and the entry's in the name, the town's aside, is equality of two sets: one equi-join on
    country, town and the sorted rest.
    """
    telling = lambda ws: F.filter(ws, lambda w: (F.char_length(w) >= 3) & ~w.rlike("^[0-9]+$") & ~w.isin(*generic, ""))
    rest = lambda ws, town: F.array_join(F.array_sort(F.array_except(telling(ws), telling(town))), " ")
    n = F.size("words")
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.slice("words", i, k))).otherwise(F.array().cast("array<array<string>>"))))
    # equal names are asked once, and of an entry's groups the least and the greatest tell whether there is just one
    each = names.select("country", "words").distinct().select("country", "words", F.explode(F.array_distinct(grams)).alias("t")).filter(F.char_length(F.array_join("t", " ")) > 3)
    asked = each.select("country", "words", F.array_join("t", " ").alias("town"), rest(F.col("words"), F.col("t")).alias("rest")).filter("rest <> ''")
    kinds = register.groupBy("country", "town", "words").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
    known = kinds.select("country", F.array_join("town", " ").alias("town"), rest(F.col("words"), F.col("town")).alias("rest"), "lo", "hi").groupBy("country", "town", "rest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fit = asked.join(known, ["country", "town", "rest"]).groupBy("country", "words").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return names.join(fit, ["country", "words"]).groupBy("name_id").agg(F.min("lo").alias("grp"), F.max("hi").alias("hi")).filter("grp = hi").drop("hi")


def directory_match(names: DataFrame, register: DataFrame, generic: tuple[str, ...], first: int = 4) -> DataFrame:
    """name_id, entry_id where the first few words of the name that aren't generic all stand in just one entry; of several, those whose town the name holds."""
    core = F.slice(F.array_except("words", F.array(*map(F.lit, generic))), 1, first)
    want = names.select("name_id", core.alias("core"), F.col("words").alias("all")).filter(F.size("core") > 0)
    token = register.select("entry_id", F.explode(F.array_distinct("words")).alias("t"))
    common = token.groupBy("t").agg(F.count("*").alias("n"))
    rare = want.select("name_id", F.explode("core").alias("t")).join(common, "t").groupBy("name_id").agg(F.min(F.struct("n", "t")).alias("r")).select("name_id", "r.t")
    met = rare.join(token, "t").select("name_id", "entry_id").join(want, "name_id").join(register.select("entry_id", "town", F.col("words").alias("of")), "entry_id")
    fit = met.filter(F.size(F.array_except("core", "of")) == 0).withColumn("here", F.array_contains("all", F.col("town")))
    counted = fit.groupBy("name_id").agg(F.count("*").alias("k"), F.count_if("here").alias("kh"), F.min("entry_id").alias("one"), F.min(F.when(F.col("here"), F.col("entry_id"))).alias("there"))
    return counted.filter("k = 1 OR kh = 1").select("name_id", F.when(F.col("k") == 1, F.col("one")).otherwise(F.col("there")).alias("entry_id"))


def on_file(contacts: DataFrame, known: DataFrame, entity: str, rank: str) -> DataFrame:
    """contacts with known and place: those on file last, else by rank.

    A contact is on file if their name holds the first two tokens of a name on file (letters, three at least; one where it has one),
    or has its address. known: entity, name and email, few rows an entity.
    """
    first = F.slice(F.regexp_extract_all(fold(F.coalesce("name", F.lit(""))), F.lit("([a-z]{3,})"), F.lit(1)), 1, 2)
    filed = known.select(entity, first.alias("__t"), F.lower(F.btrim(F.coalesce("email", F.lit("")))).alias("__e"))
    by_name = (F.size("__t") > 0) & F.forall("__t", lambda t: F.contains(fold(F.col("name")), t))
    hit = contacts.select(entity, rank, "name", "email").join(filed, entity).filter(by_name | ((F.col("__e") != "") & (F.lower("email") == F.col("__e"))))
    out = contacts.join(hit.select(entity, rank).distinct().withColumn("known", F.lit(True)), [entity, rank], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return out.withColumn("place", F.row_number().over(Window.partitionBy(entity).orderBy("known", rank)))


def tool_calls(calls: DataFrame, answers: dict[str, Column], items: str = "items") -> DataFrame:
    """A row per call of a list: its id and the text that its tool gives; a safe text for others."""
    each = calls.select(F.posexplode(items).alias("place", "c"))
    text = F.lit("Sorry, I can't do that.")
    for name, answer in answers.items():
        text = F.when(F.col("c.name") == name, answer).otherwise(text)
    return each.select(F.col("c.id").alias("id"), "place", text.alias("text"))


def contact_kind(person: Column, email: Column) -> Column:
    """own if a token of the name stands in the address, office for other addresses, else blank."""
    local = fold(F.substring_index(email, "@", 1))
    own = F.exists(name_tokens(person, 3), lambda t: F.contains(local, t))
    return F.when(F.coalesce(email, F.lit("")) == "", "").when(own, "own").otherwise("office")


def contact_counts(rows: DataFrame, key: Column, kind: Column) -> DataFrame:
    """Per key its rows, and how many have an own and an office address."""
    return rows.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.count_if(kind == "own").alias("own"), F.count_if(kind == "office").alias("office"))


def ranked_profiles(people: DataFrame, role: str, score: Column, ident: str, least: Column, top: int) -> DataFrame:
    """The best few people of each role by score: a top-k report. Those below the least are dropped."""
    w = Window.partitionBy(role).orderBy(F.col("score").desc(), ident)
    return people.filter(least).withColumn("score", score).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)


def partner_order(partners: DataFrame, entities: DataFrame, entity: str, position: str, rank: Column, order: str) -> DataFrame:
    """partners with block (the place of their entity's first row) and rank, which sort a detail sheet."""
    first = entities.groupBy(entity).agg(F.min(position).alias("block"))
    return partners.join(first, entity).withColumn("rank", rank).select(entity, order, "block", "rank")


def tried_hashes(phones: list[Column], email: Column) -> Column:
    """Hashes of the numbers and the address of a lead, nulls left out."""
    return F.array_distinct(F.array_compact(F.array(*[phone_hash(p) for p in phones], email_hash(email))))


def refreshed_queue(queue: DataFrame, fetched: DataFrame, batch: str, name: str) -> DataFrame:
    """batch, action and rows for fetched sheets: replace where more rows came and nothing was started; else an extra batch of the names that are new.

    queue: batch, started and name; fetched: batch and name.
    """
    have = queue.groupBy(batch).agg(F.count("*").alias("had"), F.max("started").alias("started"))
    came = fetched.groupBy(batch).agg(F.count("*").alias("came"))
    fresh = fetched.join(queue.select(batch, name), [batch, name], "left_anti").groupBy(batch).agg(F.count_distinct(name).alias("fresh"))
    both = came.join(have, batch, "left").join(fresh, batch, "left").fillna(0, ["had", "fresh"])
    action = F.when(F.col("started").isNull(), "add").when(~F.col("started") & (F.col("came") > F.col("had")), "replace").when(F.col("fresh") > 0, "extra").otherwise("none")
    return both.select(batch, action.alias("action"), F.when(action == "extra", F.col("fresh")).when(action == "none", 0).otherwise(F.col("came")).alias("rows"))


def keyword_roles(tabs: DataFrame, role: str, keyword: str, order: str) -> DataFrame:
    """role and keyword: each keyword of a role once, whatever its case, as it is written first."""
    return tabs.filter(F.btrim(F.col(keyword)) != "").groupBy(role, F.lower(F.btrim(F.col(keyword))).alias("__k")).agg(F.min_by(F.btrim(F.col(keyword)), order).alias(keyword)).drop("__k")


def registry_union(feeds: list[DataFrame], code: str, head: str, columns: list[str]) -> DataFrame:
    """Rows of several registers in common columns; the address of the head office, where it has one, goes before the branch's own. '-' and the like are blank."""
    clean = lambda c: F.when(F.lower(F.btrim(F.col(c))).isin("-", "non disponibile", "n/a"), "").otherwise(F.coalesce(F.btrim(F.col(c)), F.lit("")))
    out = None
    for k, feed in enumerate(feeds):
        part = feed.select(F.col(code).alias("code"), F.col(head).alias("head"), *[clean(c).alias(c) for c in columns], F.lit(k).alias("source"))
        out = part if out is None else out.unionByName(part)
    heads = out.groupBy(F.col("code").alias("head")).agg(F.max("email").alias("__head_email"))
    return out.join(heads, "head", "left").withColumn("email", F.coalesce(F.nullif("__head_email", F.lit("")), F.col("email"))).drop("__head_email")


def cached_pages(requests: DataFrame, cache: DataFrame, key) -> DataFrame:
    """Requests (url) with the cached record whose requested or final address has the same key; the latest record counts."""
    kept = cache.select(F.explode(F.array_distinct(F.array(key(F.col("url")), key(F.col("final_url"))))).alias("__k"), "at", "page_id").groupBy("__k").agg(F.max_by("page_id", F.struct("at", "page_id")).alias("page_id"))
    return requests.withColumn("__k", key(F.col("url"))).join(kept, "__k", "left").drop("__k")


def json_object(text: Column) -> Column:
    """The first JSON object in a reply, prose and fences around it left out: from the first brace to its partner, at any depth; null without one.

    The text from the first brace is cut into strings, braces and what lies between, by a pattern that neither backtracks nor
    recurses; one fold over these pieces keeps the depth and the length read, and stops counting at depth 0. A quote that
    nothing closes begins a string that goes to the end.
    """
    at = F.position(F.lit("{"), text)
    rest = F.substr(text, at)
    pieces = F.regexp_extract_all(rest, F.lit(r'(?s)("(?:[^"\\]++|\\.)*+"|[{}]|[^"{}]++|".*+)'), F.lit(1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(s: Column, p: Column) -> Column:
        depth = s["depth"] + F.when(p == "{", 1).when(p == "}", -1).otherwise(0)
        n = s["n"] + F.char_length(p)
        return F.struct(depth.alias("depth"), n.alias("n"), F.when(s["end"] > 0, s["end"]).when(depth == 0, n).otherwise(0).alias("end"))

    end = F.aggregate(pieces, zero, step)["end"]
    return F.when(at > 0, F.transform(F.array(end), lambda n: F.when(n > 0, F.substr(rest, F.lit(1), n)))[0])

"""The shared inbox of an institution, from all addresses on its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.contacts import page_emails
from tidewell.functions.keys import fold, host

# Beginnings of local parts for international matters, of offices, and of inboxes that are nobody's to write to.
INTERNATIONAL = r"^(international|internacional|internazional|intl|erasmus|mobility|mobilit|io(?:[^a-z]|$)|iro(?:[^a-z]|$)|relint|ri(?:[^a-z]|$)|exchange|incoming|outgoing|auslandsamt|ausland|global|abroad)"
NOT_SHARED = (
    r"^(iod|dpo|gdpr|rodo|privacy|datenschutz|dataprotection|data\.protection|protecciondatos|webmaster|web(?:[^a-z]|$)|personalrat|jobs|job(?:[^a-z]|$)|career|karriere|hr(?:[^a-z]|$)|press|presse|marketing|"
    r"noreply|no-reply|donotreply|abuse|postmaster|hostmaster|helpdesk|it(?:[^a-z]|$)|support)"
)
OFFICES = (
    "info office contact kontakt contacto contatti mail post poststelle admin administration secretariat secretaria secretary sekretariat segreteria sekretariaat rektorat rectorat rectorado "
    "rektor dekanat reception enquiries enquiry inquiries hello general school skola szkola iskola scuola escola ecole direction direccion dyrekcja ravnatelj riaditel reditel kancelaria kancelar "
    "titkarsag studienberatung admissions registry registrar studentservice studyinfo kanslia kirjaamo study studies studie studij studium studien student rekrutacja recruit admission protocollo "
    "didattica ufficio biuro dziekanat recepce podatelna uradovna tajnistvo referat zentrale segretaria accueil scolarite inscription matricula informacion informacje"
).split()
# Domains of education authorities, of free mail and of platforms; placeholders; lines that name who made a site; words of domains that tell nothing.
AUTHORITY = (
    r"(^|\.)(ac-[a-z-]+\.fr|educa[a-z.]*\.es|edu\.gva\.es|gva\.es|juntadeandalucia\.es|educarex\.es|educa\.madrid\.org|madrid\.org|xtec\.cat|gencat\.cat|edu\.xunta\.gal|edu\.xunta\.es|educacion\.navarra\.es|euskadi\.eus|"
    r"larioja\.edu\.es|educastur\.es|edu\.jcyl\.es|jcyl\.es|carm\.es|murciaeduca\.es|educantabria\.es|gobiernodecanarias\.org|istruzione\.it|pec\.istruzione\.it|edu\.pl|schule\.[a-z]+|schulen\.[a-z.]+|ens\.be|edu\.[a-z]{2})$"
)
FREE = (
    r"^(gmail|googlemail|hotmail|outlook|live|yahoo|icloud|wp|o2|interia|onet|op|libero|virgilio|alice|tiscali|orange|wanadoo|free|laposte|sfr|web|gmx|t-online|freenet|seznam|centrum|azet|"
    r"freemail|citromail|abv|mail|yandex|terra|sapo|telefonica|movistar)\.[a-z.]+$"
)
PLATFORM = r"(^|\.)(wix|wixpress|wordpress|sentry|sentry-next|google|example|domain|yourdomain|squarespace|shopify|godaddy|jimdo|weebly|hubspot|mailchimp)\.[a-z.]+$"
PLACEHOLDER = r"^(prenom\.nom|nom\.prenom|name|first\.last|firstname\.lastname|vorname\.nachname|nombre|email|your|youremail|you|user|username|example|test|xxx|mail)$"
MAKER = r"(?i)design|develop|powered|realis|r[ée]alis|creat|cr[ée][ée] par|webdesign|site by|web by|diseñ|disen|desarroll|entwickl|gestaltung|programmed|hosting|alojamiento"
NO_WORDS = "mail email info school schule edu www web site online group home college lycee ecole escuela colegio liceo university universidad uni".split()
MEETING = r"(?i)contact|kontakt|contatt|contacto|impressum|mentions|about|nous|uber"


def domain_words(domain: Column) -> Column:
    """The telling parts of a domain before its ending, four letters or more."""
    return F.filter(F.slice(F.split(domain, r"[.\-]"), 1, F.greatest(F.size(F.split(domain, r"[.\-]")) - 1, F.lit(0))), lambda p: (F.char_length(p) >= 4) & ~p.isin(*NO_WORDS))


def shared_inboxes(pages: DataFrame, sites: DataFrame, entity: str) -> DataFrame:
    """entity, email, url and tier of the best shared inbox on its pages; entities without one are absent.

    pages: entity, i (the page's place, 0 the home page), url, text; sites: entity, site and name, a row each. An entity's own
    domains are its site's and those of its pages. Tiers: 0 international, 1 an office or named like the site, 2 another on an own domain,
    3 on another domain, if that is a sister of its own (all its telling words are the entity's), an education authority's, or free
    mail on the home page or a page of contacts; never a platform's, a placeholder or the maker's of the site. Then what
    stands on more pages, then on an earlier one. Hosts and words of an entity are few, so they travel in arrays.
    """
    hosts = pages.filter("url <> ''").select(entity, host(F.col("url")).alias("h")).union(sites.select(entity, host(F.col("site")).alias("h"))).filter("h <> ''").groupBy(entity).agg(F.collect_set("h").alias("hosts"))
    tokens = F.filter(F.regexp_extract_all(fold(F.coalesce("name", F.lit(""))), F.lit("([a-z]{4,})"), F.lit(1)), lambda w: ~w.isin(*NO_WORDS))
    known = hosts.join(sites.select(entity, tokens.alias("named")), entity, "left")
    own_words = F.array_union(F.flatten(F.transform("hosts", lambda h: domain_words(F.concat(h, F.lit(".x"))))), F.coalesce("named", F.array().cast("array<string>")))
    known = known.select(entity, "hosts", F.array_distinct(own_words).alias("own"), F.transform("hosts", lambda h: F.substring_index(h, ".", 1)).alias("labels"))
    # What the text tells of an address is asked before the join, so no text goes into it; a page's own address, of which nothing more is asked, needs no line.
    local, at = lambda e: F.substring_index(e, "@", 1), lambda e: F.substring_index(e, "@", -1)
    line = lambda e: F.coalesce(F.get(F.filter(F.split("text", "\n"), lambda x: F.contains(F.lower(x), local(e))), 0), F.lit(""))
    home = lambda e: (at(e) != "") & (at(e) == F.col("h"))
    barred = lambda e: F.when(F.coalesce(home(e), F.lit(False)), False).when(at(e).rlike(PLATFORM) | local(e).rlike(PLACEHOLDER), True).otherwise(line(e).rlike(MAKER))
    shared = F.filter(page_emails(F.coalesce("text", F.lit(""))), lambda e: ~local(e).rlike(NOT_SHARED))
    each = pages.withColumn("h", host(F.col("url"))).select(entity, "i", "url", F.explode(F.transform(shared, lambda e: F.struct(e.alias("email"), barred(e).alias("barred")))).alias("f"))
    each = each.select(entity, "i", "url", "f.*").join(known, entity).withColumns({"local": local(F.col("email")), "at": at(F.col("email"))})
    sub = lambda a, b: a.endswith(F.concat(F.lit("."), b))
    own = F.exists("hosts", lambda h: (F.col("at") == h) | sub(F.col("at"), h) | sub(h, F.col("at")))
    named = (F.char_length("local") >= 3) & F.exists("labels", lambda n: F.contains(n, F.col("local")) | F.contains(F.col("local"), n))
    tier = F.when(F.col("local").rlike(INTERNATIONAL), 0).when(F.col("local").rlike(f"^({'|'.join(OFFICES)})") | named, 1).otherwise(2)
    words = domain_words(F.col("at"))
    sister = (F.size(words) > 0) & F.forall(words, lambda w: F.exists("own", lambda o: F.contains(o, w) | F.contains(w, o)))
    free = F.col("at").rlike(FREE) & ((F.col("i") == 0) | F.col("url").rlike(MEETING))
    other = ~F.col("barred") & (sister | F.col("at").rlike(AUTHORITY) | free)
    ranked = each.withColumn("tier", F.when(own, tier).when(other, 3)).filter("tier IS NOT NULL")
    counted = ranked.groupBy(entity, "email").agg(F.max("tier").alias("tier"), F.count("*").alias("n"), F.min(F.struct("i", "url")).alias("first"))
    best = counted.groupBy(entity).agg(F.min(F.struct("tier", (-F.col("n")).alias("n"), F.col("first.i").alias("i"), "email", F.col("first.url").alias("url"))).alias("b"))
    return best.select(entity, "b.email", "b.url", "b.tier")

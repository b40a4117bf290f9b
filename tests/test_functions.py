import hashlib

import pytest
from pyspark.sql import functions as F

from tidewell.functions import keys
from tidewell.functions import text as tx


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], [*values]) if values else spark.range(1)
    return df.select(expr.alias("x")).collect()[0]["x"]


def test_keys(spark):
    assert one(spark, keys.ascii_key(F.col("a")), a="Écolé 12-B") == "col12b"
    assert one(spark, keys.folded_words(F.col("a")), a="  Écolé -- 12 b ") == "ecole 12 b"
    assert one(spark, keys.comparable(F.col("a")), a="“Straße” – été\n x") == '"strasse" - ete x'
    assert one(spark, keys.host(F.col("a")), a="HTTPS://www.Some.org:80/x?y") == "some.org"
    assert one(spark, keys.url_key(F.col("a")), a="http://www.a.org/b/?q=1#top") == "a.org/b/?q=1"
    assert one(spark, keys.registrable_domain(F.col("a")), a="x.y.ac.uk") == "y.ac.uk"
    assert one(spark, keys.phone_hash(F.col("a")), a="+49 30 123 45 678") == hashlib.sha256(b"p:12345678").hexdigest()[:16]
    assert one(spark, keys.phone_hash(F.col("a")), a="12345") is None
    assert one(spark, keys.email_hash(F.col("a")), a=" A@B.c ") == hashlib.sha256(b"e:a@b.c").hexdigest()[:16]
    assert one(spark, keys.same_site(F.col("a"), F.col("b")), a="x.org", b="m.x.org") and not one(spark, keys.same_site(F.col("a"), F.col("b")), a="ax.org", b="x.org")


@pytest.mark.parametrize(
    ("quote", "text", "want"),
    [
        ("The Office", "see the  office here", True),
        ("l'Été", "L’ete", True),
        ("first ... second", "the first and the second", True),
        ("second … first", "the first and the second", False),
        ("no such", "words", False),
        ("ab", "ab", False),
        ("", "x", False),
        ("x ... x", "x", False),
    ],
)
def test_quotes(spark, quote, text, want):
    assert one(spark, tx.quote_in_text(F.col("q"), F.col("t")), q=quote, t=text) is want


@pytest.mark.parametrize(
    ("row", "want"),
    [
        ((False, 1.0, True), "none"), ((True, None, True), "needs_arrival_date"), ((True, 3.9, True), "qualified_appointment"), ((True, 4.0, True), "engagement_appointment"),
        ((True, 6.1, True), "follow_up_appointment"), ((True, 3.0, False), "needs_review"), ((True, 6.0, False), "engagement"), ((True, 7.0, False), "follow_up"),
    ],
)
def test_outcomes(spark, row, want):
    df = spark.createDataFrame([row], "i boolean, m double, b boolean")
    assert df.select(tx.outcome_label(F.col("i"), F.col("m"), F.col("b"))).collect()[0][0] == want


def test_contacts(spark):
    assert one(spark, tx.attempt_categories(F.col("a")), a="They hung up, not answered") == ["hung_up", "not_answered"]
    assert one(spark, tx.attempt_categories(F.col("a")), a="hung up but did respond well") == ["other"]
    assert one(spark, tx.split_phones(F.col("a")), a="+1 22/33; n/a\n44") == ["122", "33", "44"]
    assert one(spark, tx.dial_country(F.col("a")), a="35312") == "Ireland" and one(spark, tx.dial_country(F.col("a")), a="4930") == "Germany"
    assert one(spark, tx.day_month(F.col("a")), a="on 3/11 and 4/12") == "03/11"
    assert one(spark, tx.emails_in(F.col("a")), a="a@b.org, c@d.fr a@b.org") == ["a@b.org", "c@d.fr"]
    assert one(spark, tx.phone_in_text(F.col("a"), F.col("b")), a="+353 21 432 6100", b="tel (0)21-432 6100")
    assert one(spark, tx.minutes_text(F.col("a")), a=93.3) == "1 h 33 min" and one(spark, tx.minutes_text(F.col("a")), a=0.0) == ""
    assert one(spark, tx.partner_scope(F.col("a"), F.col("b"), F.col("c")), a="network", b="Unknown", c="France") == "International"
    assert one(spark, tx.partner_scope(F.col("a"), F.col("b"), F.col("c")), a="school", b="FRANCE", c="France") == "National"
    key = 0x42
    code = "42" + "".join(f"{ord(c) ^ key:02x}" for c in "me@x.org")
    assert one(spark, tx.hidden_email(F.col("a")), a=code) == "me@x.org"
    assert one(spark, tx.slug(F.col("a")), a="My File (2).csv") == "my-file-2" and one(spark, tx.formula_safe(F.col("a")), a="=1") == "'=1"

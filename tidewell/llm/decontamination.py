"""Benchmark decontamination over a distributed positional inverted index (DataFrame functions only).

First the benchmark's terms are counted over all documents, as partial sums. Of every window of a benchmark item
the two rarest terms are chosen, the window's last word aside; for proximity, the rarest few of every item. The
index holds a posting (term, document, place, hash of the next word) for every occurrence of a chosen term, and of
no other. The posting lists of the rarest, less the
postings whose next word is another than the item's, are shifted by the term's place in its item, which
gives the alignments (document, item, shift) at which the item may occur; those that the shifted lists of
the second rarest don't share are gone. What is left is compared word by word with the document.
A proximity match is a stretch of ``span`` words in which the ``terms`` rarest distinct terms of an item all
stand, or all its terms if it has fewer; a term that no document holds rules its item out.

A document is known by its id and the hash of its text, so repeated ids don't mix.

Defined results for odd input: null texts, and texts without words, have no postings and no hits; items
of no words have no windows; an item of fewer words than a window is one window; terms that no document
holds end their windows at once; repeated rows get equal results; repeated item ids count once; null
item ids hit but are not listed; empty tables give no hits; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, settle

NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Narrow tables (keys and numbers) of so many rows at most are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Terms (a word each) are broadcast up to so many; beyond, postings and terms are shuffled, in so many parts a term.
BROADCAST_TERMS, PARTS = 500_000, 16


def lower_ascii(word: Column) -> Column:
    """word with A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def raw_words(text: Column) -> Column:
    """The words of text, letters as they are."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NO_WORD), lambda w: w != "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def documents_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn("h", F.xxhash64("text"))


def item_tokens(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a key of the row), item_id, n, ipos, term and nxt: a row for each word of each distinct item."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).distinct()
    words = items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", F.size(raw_words(F.col("text"))).alias("n"), F.posexplode(_with_next(F.col("text"))).alias("ipos", "x"))
    return words.select("item", "item_id", "n", "ipos", lower_ascii(F.col("x.word")).alias("term"), F.hash(lower_ascii(F.col("x.next"))).alias("nxt"))


def _with_next(text: Column) -> Column:
    """The words of text, each with the one after it."""
    return let(raw_words(text), lambda w: F.transform(w, lambda x, i: F.struct(x.alias("word"), F.get(w, i + 1).alias("next"))))


def _of_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings whose term is one of terms. A frequent term is dealt out by document, so that it is no hot key."""
    if terms.count() <= BROADCAST_TERMS:
        return postings.join(F.broadcast(terms), "term", "left_semi")
    many = terms.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return postings.withColumn("part", F.pmod(F.xxhash64("id", "h"), F.lit(PARTS)).cast("int")).join(many, ["term", "part"], "left_semi").drop("part")


def count_terms(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """term, df: how often each of terms stands in all documents. Words are counted in the tasks before they are shuffled."""
    words = docs.select(F.explode(raw_words(F.col(f"`{text_col}`"))).alias("word")).select(lower_ascii(F.col("word")).alias("term"))
    known = terms.select("term").distinct()
    if known.count() <= BROADCAST_TERMS:
        return settle(words.join(F.broadcast(known), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df")), "term-counts")
    return settle(words.groupBy("term").agg(F.count("*").alias("df")).join(known, "term", "left_semi"), "term-counts")


def build_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings term, id, h, pos, nxt: of all words, or of those in the column term of terms; written to a table."""
    words = documents_of(docs, id_col, text_col).filter(F.col("text").isNotNull()).select("id", "h", F.posexplode(_with_next(F.col("text"))).alias("pos", "x"))
    postings = words.select("id", "h", "pos", lower_ascii(F.col("x.word")).alias("term"), F.col("x.next").alias("next"))
    if terms is not None:
        postings = _of_terms(postings, terms.select("term").distinct())
    return settle(postings.select("term", "id", "h", "pos", F.hash(lower_ascii(F.col("next"))).alias("nxt")), "postings")


def rare_of_windows(tokens: DataFrame, seen: DataFrame, window: int = 10) -> DataFrame:
    """item, n, ipos, term, nxt and rank (1, 2) of the two rarest terms of every window all of whose terms occur."""
    counted = settle(tokens.select("item", "n", "ipos", "term", "nxt").join(seen, "term", "left").fillna(0, ["df"]), "item-tokens")
    length = F.least(F.col("n"), F.lit(window))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("ipos") - length + 1), F.least(F.col("ipos"), F.col("n") - length)))
    in_window = counted.select("item", "n", "ipos", "term", "nxt", "df", length.alias("length"), starts.alias("start"))
    in_window = in_window.withColumn("least", F.min("df").over(Window.partitionBy("item", "start"))).filter("least > 0 AND (length = 1 OR ipos < start + length - 1)")
    order = Window.partitionBy("item", "start").orderBy("df", "ipos")
    ranked = in_window.withColumn("rank", F.row_number().over(order)).filter("rank <= 2")
    return settle(ranked.select("item", "n", "ipos", "term", "nxt", "rank").distinct(), "item-rare")


def rare_of_items(tokens: DataFrame, seen: DataFrame, terms: int = 3) -> DataFrame:
    """item, item_id, term, need: the rarest distinct terms of every item, terms of them or all; none of items with a term among them that doesn't occur."""
    each = tokens.select("item", "item_id", "term").distinct().join(seen, "term", "left").fillna(0, ["df"])
    of = Window.partitionBy("item")
    ranked = each.withColumn("rank", F.row_number().over(of.orderBy("df", "term"))).withColumn("need", F.least(F.lit(terms), F.count("*").over(of)))
    return settle(ranked.filter(F.col("rank") <= terms).withColumn("least", F.min("df").over(of)).filter("least > 0").select("item", "item_id", "term", "need"), "item-near")


def alignments(index: DataFrame, tokens: DataFrame, ranked: DataFrame) -> DataFrame:
    """id, h, item, shift where the two rarest terms of a window stand in their places.

    Items of one or two words have one list.
    """

    def lists(rank: int) -> DataFrame:
        rare = ranked.filter(F.col("rank") == rank).select("term", "item", "ipos", F.col("nxt").alias("want"), (F.col("n") == 1).alias("alone")).distinct()
        found = index.join(_small(rare, rare.count()), "term").filter(F.col("alone") | (F.col("nxt") == F.col("want")))
        return found.select("id", "h", "item", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"))

    first = settle(lists(1).select("id", "h", "item", "shift").distinct(), "alignments")
    second = lists(2).select("id", "h", "item", "shift")
    same = lambda a, b: (a["id"].eqNullSafe(b["id"])) & (a["h"] == b["h"]) & (a["item"] == b["item"]) & (a["shift"] == b["shift"])
    short = tokens.filter("n <= 2").select("item").distinct()
    both = second.join(_small(first, first.count()), same(second, first), "left_semi").distinct()
    return both.union(first.join(short, "item", "left_semi").select("id", "h", "item", "shift")).distinct()


def _hits(words: Column, item_words: Column, shift: Column, window: int) -> Column:
    """Places of words of the document inside windows of the item that occur at the shift."""
    equal = F.transform(item_words, lambda w, j: F.coalesce(F.get(words, shift + j) == w, F.lit(False)))

    def places(m: Column) -> Column:
        length = F.least(F.size(m), F.lit(window))
        whole = F.filter(F.sequence(F.lit(0), F.size(m) - length), lambda s: F.forall(F.slice(m, s + 1, length), lambda x: x))
        return F.flatten(F.transform(whole, lambda s: F.sequence(shift + s, shift + s + length - 1)))

    return let(equal, places)


def exact_matches(docs: DataFrame, index: DataFrame, tokens: DataFrame, ranked: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """id, h, n_hit and item_ids (strings, sorted) for the documents in which a window occurs."""
    by_place = F.transform(F.sort_array(F.collect_list(F.struct("ipos", "term"))), lambda x: x["term"])
    items = tokens.groupBy("item", F.col("item_id").cast("string").alias("item_id")).agg(by_place.alias("item_words"))
    shifts = alignments(index, tokens, ranked).groupBy("id", "h", "item").agg(F.collect_list("shift").alias("shifts"))  # the item's words once each
    per_doc = settle(shifts.join(items, "item").groupBy("id", "h").agg(F.collect_list(F.struct("item_id", "item_words", "shifts")).alias("found")), "aligned")
    aligned = per_doc.withColumnRenamed("id", "__id").withColumnRenamed("h", "__h")
    same = lambda a, b: a["id"].eqNullSafe(b["__id"]) & (a["h"] == b["__h"])
    texts = documents_of(docs, id_col, text_col)
    keys = _small(aligned.select("__id", "__h"), aligned.count())
    few = texts.join(keys, same(texts, keys), "left_semi")  # the other texts are never shuffled with the items' words
    joined = few.join(aligned, same(few, aligned))
    words = F.transform(raw_words(F.col("text")), lower_ascii)
    checked = let(words, lambda w: F.transform(F.col("found"), lambda x: F.struct(x["item_id"].alias("item_id"), F.array_distinct(F.flatten(F.transform(x["shifts"], lambda shift: _hits(w, x["item_words"], shift, window)))).alias("places"))))
    hits = joined.select("id", "h", F.filter(checked, lambda x: F.size(x["places"]) > 0).alias("hits")).filter(F.size("hits") > 0)
    return hits.select(
        "id",
        "h",
        F.size(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["places"])))).cast("bigint").alias("n_hit"),
        F.sort_array(F.array_distinct(F.array_compact(F.transform("hits", lambda x: x["item_id"])))).alias("item_ids"),
    ).dropDuplicates(["id", "h"])


def proximity_matches(index: DataFrame, rare: DataFrame, span: int = 20) -> DataFrame:
    """id, h, item_id, first and last place where the rarest distinct terms of an item (see rare_of_items) lie within span words."""
    near = index.join(_small(rare, rare.count()), "term")
    frame = Window.partitionBy("id", "h", "item").orderBy("pos").rangeBetween(-(span - 1), 0)
    met = near.withColumn("met", F.size(F.collect_set("term").over(frame))).withColumn("first", F.min("pos").over(frame))
    return met.filter("met = need").select("id", "h", "item_id", "first", F.col("pos").alias("last"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, terms: int = 3, span: int = 20) -> DataFrame:
    """id, h, n_words, n_hit, item_ids and n_near (items with a proximity match) for every row of docs."""
    tokens = settle(item_tokens(benchmark, item_id_col, item_text_col), "items")
    seen = count_terms(docs, tokens, text_col)
    ranked, rare = rare_of_windows(tokens, seen, window), rare_of_items(tokens, seen, terms)
    index = build_index(docs, ranked.select("term").union(rare.select("term")), id_col, text_col)
    exact = exact_matches(docs, index, tokens, ranked, id_col, text_col, window)
    near = proximity_matches(index, rare, span).select("id", "h", "item_id").distinct().groupBy("id", "h").agg(F.count("item_id").alias("n_near"))
    by = lambda a, b: a["id"].eqNullSafe(b["__id"]) & (a["h"] == b["__h"])
    keyed = lambda df: df.withColumnRenamed("id", "__id").withColumnRenamed("h", "__h")
    one, other = settle(exact, "hits"), settle(keyed(near), "near-hits")
    hits = one.join(other, by(one, other), "left").drop("__id", "__h").unionByName(other.join(one, by(one, other), "left_anti").select(F.col("__id").alias("id"), F.col("__h").alias("h"), "n_near"), allowMissingColumns=True)
    hits = settle(keyed(hits), "all-hits")
    base = documents_of(docs, id_col, text_col).select("id", "h", F.size(raw_words(F.col("text"))).cast("bigint").alias("n_words"))
    joined = base.join(hits, by(base, hits), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return joined.select("id", "h", "n_words", zero("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), zero("n_near"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, all columns of theirs."""
    tokens = settle(item_tokens(benchmark, item_id_col, item_text_col), "items")
    ranked = rare_of_windows(tokens, count_terms(docs, tokens, text_col), window)
    index = build_index(docs, ranked.select("term"), id_col, text_col)
    hits = settle(exact_matches(docs, index, tokens, ranked, id_col, text_col, window).select(F.col("id").alias("__hit_id"), F.col("h").alias("__hit_h")), "hits")
    keyed = docs.select(F.col(f"`{id_col}`").alias("__key"), F.xxhash64(F.col(f"`{text_col}`")).alias("__h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    other = _small(hits, hits.count())
    return keyed.join(other, keyed["__key"].eqNullSafe(other["__hit_id"]) & (keyed["__h"] == other["__hit_h"]), "left_anti").select("row.*")

"""Benchmark decontamination by winnowing: sampled k-gram hashes find shared spans, whole windows confirm them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.llm.common import LOWER, UPPER, let, words_of
from matchweave.session import stage

#: Words are runs of ASCII letters, ASCII digits and everything outside ASCII.
NON_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5
#: Benchmark fingerprints are broadcast up to this many rows (16 bytes each and the item id); above it the search is a shuffled join.
BROADCAST_ROWS = 500_000


def normal_words(text: Column) -> Column:
    """Words in order, A-Z in lower case and no other letter changed; ``lower`` alone does that where all is ASCII."""
    plain = F.coalesce(text, F.lit(""))
    return words_of(F.when(F.length(plain) == F.octet_length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER)), NON_WORDS)


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, by its start."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.expr("array()").cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def winnowed(words: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The distinct least hashes of every ``window - gram + 1`` neighbouring grams.

    Any two texts that share ``window`` words in a row share the least hash there, so every such
    span leaves a common fingerprint. Shorter texts have none.
    """
    span = window - gram + 1

    def least(h: Column) -> Column:
        starts = F.when(F.size(h) >= span, F.sequence(F.lit(1), F.size(h) - span + 1)).otherwise(F.expr("array()").cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(h, i, span))))

    return let(words, lambda w: let(gram_hashes(w, gram), least))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id as text, words) of items with words; null texts have none."""
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), normal_words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)


def _confirmed(ctx: Column, at: Column, item: Column, pos: Column) -> Column:
    """Starts, in the document, of the windows around a hit whose ten words agree with the item's."""
    def fits(back: Column) -> Column:
        return (pos >= back) & (at >= back) & (pos - back + WINDOW <= F.size(item)) & (at - back + WINDOW <= F.size(ctx)) & (
            F.slice(ctx, F.greatest(at - back, F.lit(0)) + 1, WINDOW) == F.slice(item, F.greatest(pos - back, F.lit(0)) + 1, WINDOW))

    return F.filter(F.sequence(F.lit(0), F.lit(WINDOW - GRAM)), fits)


def _small(df: DataFrame, search: str) -> bool:
    """Whether a written table may be broadcast."""
    return search == "broadcast" or search == "auto" and df.count() <= BROADCAST_ROWS


def _long_hits(docs: DataFrame, prints: DataFrame, items: DataFrame, search: str) -> DataFrame:
    """(doc key, item_id, start, length) of windows of full length: documents by shared fingerprint, then their hits word by word."""
    items = items.where(F.size("item_words") >= WINDOW)
    marks = stage(items.select(F.explode(winnowed(F.col("item_words"))).alias("hash")).distinct(), "marks")
    found = prints.select("doc_id", "text_hash", F.explode("prints").alias("hash"))
    found = found.join(F.broadcast(marks) if _small(marks, search) else marks, "hash", "left_semi")
    keys = stage(found.select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash")).distinct(), "keys")
    same = docs["doc_id"].eqNullSafe(keys["key_id"]) & (docs["text_hash"] == keys["key_hash"])
    hit = docs.join(F.broadcast(keys) if _small(keys, search) else keys, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])

    def around(words: str, at: str, name: str) -> Column:
        return F.slice(words, F.greatest(F.col(at) - (WINDOW - GRAM), F.lit(0)) + 1, 2 * WINDOW - GRAM).alias(name)

    grams = hit.select("doc_id", "text_hash", normal_words(F.col("text")).alias("words"))
    grams = grams.select("doc_id", "text_hash", "words", F.posexplode(gram_hashes(F.col("words"), GRAM)).alias("pos", "hash"))
    own = items.select("item_id", "item_words", F.posexplode(gram_hashes(F.col("item_words"), GRAM)).alias("item_pos", "hash"))
    own = stage(own.join(marks, "hash", "left_semi").select("item_id", "item_pos", "hash", around("item_words", "item_pos", "item_ctx")), "grams")
    grams = grams.join(F.broadcast(marks) if _small(marks, search) else marks, "hash", "left_semi").select("doc_id", "text_hash", "pos", "hash", around("words", "pos", "ctx"))
    hits = grams.join(F.broadcast(own) if _small(own, search) else own, "hash")
    side = WINDOW - GRAM
    starts = _confirmed(F.col("ctx"), F.least("pos", F.lit(side)), F.col("item_ctx"), F.least("item_pos", F.lit(side)))
    return hits.select("doc_id", "text_hash", "item_id", "pos", F.explode(starts).alias("back")).select("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("back")).alias("start"), F.lit(WINDOW).alias("length"))


def _short_hits(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """The same for items of fewer words than a window, each one window: by the hash of all its words, one length at a time."""
    short = items.where(F.size("item_words") < WINDOW).select("item_id", F.size("item_words").alias("length"), F.array_join("item_words", " ").alias("joined"))
    lengths = sorted(r.length for r in short.select("length").distinct().collect())  # nine at most
    out = None
    for length in lengths:
        words = docs.select("doc_id", "text_hash", normal_words(F.col("text")).alias("words"))
        starts = F.when(F.size("words") >= length, F.sequence(F.lit(0), F.size("words") - length)).otherwise(F.expr("array()").cast("array<int>"))
        grams = words.select("doc_id", "text_hash", "words", F.explode(starts).alias("start"))
        grams = grams.select("doc_id", "text_hash", "start", F.array_join(F.slice("words", F.col("start") + 1, length), " ").alias("joined"))
        own = short.where(F.col("length") == length).select("item_id", "joined")
        hits = grams.join(own, "joined").select("doc_id", "text_hash", "item_id", "start", F.lit(length).alias("length"))
        out = hits if out is None else out.union(hits)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, search: str = "auto") -> DataFrame:
    """Per document row: doc_id, text_hash (xxhash64 of the text), n_words, n_hit, n_items, items (sorted item ids), contaminated.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not read. A word is
    hit if it lies in any occurrence of ten neighbouring words of an item (or of a whole shorter item).
    Null texts have no words; items without words hit nothing; repeated rows give repeated rows; items
    with the same id count once; an empty table on either side gives rows without hits.

    ``search``: "broadcast" or "shuffle" for the fingerprints, "auto" by their count; results are the same.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    items = _items(benchmark)
    words = docs.select("doc_id", "text_hash", normal_words(F.col("text")).alias("words"))
    prints = stage(words.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), winnowed(F.col("words")).alias("prints")), "prints")
    hits = _long_hits(docs, prints, items, search)
    short = _short_hits(docs, items)
    hits = hits if short is None else hits.union(short)
    # in steps, so that a document full of hits is reduced where it is read: one row for each place, then for each document
    places = hits.groupBy("doc_id", "text_hash", "start", "length").agg(F.collect_set("item_id").alias("ids"))
    per_doc = places.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"), F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"))
    empty = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", empty, lambda a, x: F.struct(
        (a["hit"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(x["start"], a["end"]))).alias("hit"),
        F.greatest(a["end"], x["start"] + x["length"]).alias("end"),
    ))["hit"]
    per_doc = per_doc.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), covered.alias("n_hit"), F.array_sort("ids").alias("items"))
    counts = prints.select("doc_id", "text_hash", "n_words")
    joined = counts.join(per_doc, counts["doc_id"].eqNullSafe(per_doc["hit_id"]) & (counts["text_hash"] == per_doc["hit_hash"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.expr("array()").cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))

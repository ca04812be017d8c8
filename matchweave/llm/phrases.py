"""Collocations from a weighted de Bruijn graph of four-word edges.

Every word begins one gram: the four words from it on, or the fewer that its piece still has. The grams of four are
the edges of a graph whose nodes are the three-word phrases; shorter grams are what pieces end in. The count of a node is the flow out of it
and the pieces that end in it, and so on down to words, so only the longest grams are counted in the texts.
Nodes that one edge enters and one edge leaves with all their flow lie on unary paths; these are compacted into one line each before candidates
are drawn from them: a path's inner nodes are never candidates, since their edges hold all of their count.

Two words whose pair is rarer than the least count are in no candidate together, so a gram ends between them as at
the end of a piece. Which pairs those are is read from counts of hashes, put into a Bloom filter of bounded size; a pair that it lets through wrongly costs
a longer gram and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchweave.llm import sieve, wordbytes
from matchweave.llm.common import slices, small_batches
from matchweave.session import stage

LONGEST, LEAST, TOP, SHARE, SCALE = 4, 30, 2000, 80, 2_000_000
#: Grams that a task holds before it sends them.
HELD_GRAMS = 500_000
#: Copies of each count that candidates meet, so that a part of very many of them is not one task's work.
SALT = 8

_breaks = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_separators = _breaks | np.isin(np.arange(256), [0x20, 0x09])


class _Tokens:
    """Words of a batch (text, lang): bytes, hashes, which word the next one of its piece follows, and the pairs' hashes."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, offsets = wordbytes.flat(batch.column("text"))
        self.words = wordbytes.words(self.data, offsets, _separators, wordbytes.LOWER_BYTES)
        langs = batch.column("lang").dictionary_encode()
        self.names, self.lang = langs.dictionary, langs.indices.to_numpy()[self.words.text]
        piece = np.searchsorted(np.flatnonzero(_breaks[self.data]), self.words.start)
        n = len(piece)
        self.follows = np.zeros(n, bool)
        self.follows[:-1] = (piece[1:] == piece[:-1]) & (self.words.text[1:] == self.words.text[:-1])
        own = np.array([xxhash.xxh3_64_intdigest(x or "") for x in self.names.to_pylist()], np.uint64)
        h = self.words.hash
        self.pairs = np.zeros(n, np.uint64)
        if n:
            self.pairs[:-1] = wordbytes.mixed(h[:-1] * np.uint64(wordbytes.MULTIPLIER) + h[1:] + own[self.lang[:-1]])


def _pairs(batch: pa.RecordBatch) -> np.ndarray:
    tokens = _Tokens(batch)
    return tokens.pairs[tokens.follows]


def pair_filter(texts: DataFrame, least: int) -> np.ndarray:
    """Filter of the pairs of neighbours that occur ``least`` times or more in their language."""
    return sieve.frequent_filter(texts, "text", _pairs, least)


GRAMS = "lang string, gram string, size int, n bigint"


def _grams(known, longest: int = LONGEST):
    """Counts of the longest gram from each word of a task's texts."""
    def of(batch: pa.RecordBatch) -> pa.Table:
        tokens, table = _Tokens(batch), known.value
        words = tokens.words
        link = tokens.follows & sieve.passes(table, tokens.pairs)
        size, reach = np.ones(len(link), np.int64), link.copy()
        for step in range(1, longest):
            size += reach
            reach = reach & np.append(link[step:], np.zeros(min(step, len(link)), bool))
        # words in a row with one space after each, then grams as stretches of that
        length = words.end - words.start + 1
        begin = np.cumsum(length) - length
        row = tokens.data[np.minimum(np.repeat(words.start - begin, length) + np.arange(int(length.sum())), max(0, len(tokens.data) - 1))]
        row = wordbytes.LOWER_BYTES[row]
        row[begin + length - 1] = 0x20
        last = np.arange(len(size)) + size - 1
        width = begin[last] + length[last] - 1 - begin
        offsets = np.concatenate(([0], np.cumsum(width)))
        raw = row[np.repeat(begin - offsets[:-1], width) + np.arange(int(offsets[-1]))]
        grams = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
        counted = pa.table({"lang": pa.array(tokens.lang, pa.int32()), "gram": grams, "size": pa.array(size, pa.int32())}).group_by(["lang", "gram", "size"]).aggregate([([], "count_all")])
        names = tokens.names.cast(pa.large_string()).take(counted["lang"].combine_chunks())
        return pa.table({"lang": names, "gram": counted["gram"], "size": counted["size"], "n": counted["count_all"]})

    def added(held: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(held).group_by(["lang", "gram", "size"]).aggregate([("n", "sum")])
        return out.rename_columns(["lang", "gram", "size", "n"])

    def send(table: pa.Table) -> Iterator[pa.RecordBatch]:
        plain = table.select(["lang", "gram", "size", "n"]).cast(pa.schema([("lang", pa.string()), ("gram", pa.string()), ("size", pa.int32()), ("n", pa.int64())]))
        yield from plain.to_batches(100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for part in slices(batch, "text", sieve.TEXT_BYTES):
                held.append(of(part))
                if sum(map(len, held)) > HELD_GRAMS:
                    held = [added(held)]
                    if len(held[0]) > HELD_GRAMS // 2:
                        yield from send(held[0])
                        held = []
        if held:
            yield from send(added(held))

    return run


def counted_grams(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, gram, size, n): counts of the longest gram from each word; lang ``und`` for null, words in lower case, joined by spaces."""
    small_batches(docs.sparkSession)
    lang = F.coalesce("lang", F.lit("und")) if "lang" in docs.columns else F.lit("und")
    texts = docs.select(lang.cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(pair_filter(texts, least))
    return stage(texts.mapInArrow(_grams(known), GRAMS).groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")), "grams")


def _meet(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A merge join: both sides grow with the texts.

    Spark sizes a written table by its compressed file and an explode by the rows that go in, so it would broadcast tables that need many times
    that on the driver, as long as they seem to be under its threshold.
    """
    return left.join(right.hint("merge"), on, how)


def _first(phrase: Column | str, k: int | Column) -> Column:
    return F.substring_index(phrase, " ", k) if isinstance(k, int) else F.expr(f"substring_index({phrase}, ' ', {k})")


def flows(grams: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, f) of all phrases that begin a gram: an edge's own count, a shorter phrase's flow into longer ones and the pieces that end in it."""
    now = grams.where(F.col("size") == longest).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("f"))
    out = now.withColumn("size", F.lit(longest))
    for size in range(longest - 1, 0, -1):
        ends = grams.where(F.col("size") == size).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("f"))
        through = now.select("lang", _first("phrase", size).alias("phrase"), "f")
        now = stage(through.union(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "flow")
        out = out.unionByName(now.withColumn("size", F.lit(size)))
    return out.select("lang", "phrase", "size", "f")


def compacted(frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, words, f): the edges of ``frequent`` (lang, phrase, size, f), those on a unary path as one line of all its words.

    A node is inside a path if an edge into it and one out of it each have all its flow. Pointers are doubled until each edge
    points at the last one of its path; a path lies within a piece, so rounds follow the logarithm of the longest piece.
    """
    edges = frequent.where(F.col("size") == longest).select("lang", F.col("phrase").alias("edge"), "f")
    nodes = frequent.where(F.col("size") == longest - 1).select("lang", F.col("phrase").alias("node"), "f")
    into = edges.select("lang", F.col("edge"), F.substring_index("edge", " ", 1 - longest).alias("node"), "f")
    out_of = edges.select("lang", F.col("edge").alias("next"), _first("edge", longest - 1).alias("node"), "f")
    links = _meet(_meet(nodes, into, ["lang", "node", "f"]), out_of, ["lang", "node", "f"]).select("lang", "edge", "next")
    now = stage(_meet(edges, links, ["lang", "edge"], "left").select("lang", "edge", "f", F.coalesce("next", "edge").alias("last"), F.col("next").isNotNull().cast("bigint").alias("steps")), "paths")
    seen = None
    while (state := now.agg(F.sum("steps")).first()[0]) != seen:
        seen = state
        ahead = now.where("steps > 0").select("lang", F.col("edge").alias("last"), F.col("last").alias("further"), F.col("steps").alias("more"))
        now = stage(_meet(now, ahead, ["lang", "last"], "left").select("lang", "edge", "f", F.coalesce("further", "last").alias("last"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "paths")
    heads = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("at"), _first("edge", 1).alias("w")))), lambda x: x["w"])
    tail = F.split(F.substring_index("last", " ", 1 - longest), " ")
    return now.groupBy("lang", "last").agg(heads.alias("heads"), F.min("f").alias("f")).select("lang", F.concat("heads", tail).alias("words"), "f")


def _parts(words: Column, size: int, inner: int = 0) -> Column:
    """All stretches of ``size`` words, without ``inner`` at either end."""
    count = F.size(words) - size + 1 - 2 * inner
    starts = F.when(count > 0, F.sequence(F.lit(1 + inner), count + inner)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, scale: int = SCALE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top`` phrases of 2 to 4 words by score, then count, then bytes.

    A phrase occurs ``a`` >= ``least`` times in pieces of text; of its cuts into two parts the one of least floor(scale * a / (l + r)) counts, at ties the
    first. A phrase goes if a longer one holds it with ``share`` percent of its count. n is the number of all words of the language. All
    arithmetic is in integers or decimals. Reads text and lang (null, or no such column: ``und``); null texts have no words, repeated rows count as often
    as they are there, an empty table gives none.
    """
    grams = counted_grams(docs, least)
    total = grams.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = stage(flows(grams).where(F.col("f") >= least), "frequent")
    paths = stage(compacted(frequent), "compacted")
    size = lambda k: frequent.where(F.col("size") == k).select("lang", "phrase", F.col("f").alias("a"))
    candidates = paths.select("lang", F.explode(_parts(F.col("words"), LONGEST)).alias("phrase"), F.col("f").alias("a")).withColumn("size", F.lit(LONGEST))
    inside = paths.where(F.size("words") > LONGEST).select("lang", F.explode(_parts(F.col("words"), LONGEST - 1, 1)).alias("phrase"))
    for k in range(LONGEST - 1, 1, -1):
        own = _meet(size(k), inside, ["lang", "phrase"], "left_anti") if k == LONGEST - 1 else size(k)
        # the phrase of one more word that has it and is most frequent: a still longer one is no more frequent than that
        longer = size(k + 1).select("lang", F.explode(F.array(_first("phrase", k), F.substring_index("phrase", " ", -k))).alias("phrase"), F.col("a").alias("b"))
        longer = longer.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
        wide = lambda c: F.col(c).cast("decimal(38,0)")
        kept = _meet(own, longer, ["lang", "phrase"], "left").where(F.col("b").isNull() | (wide("b") * 100 < wide("a") * share))
        candidates = candidates.unionByName(kept.select("lang", "phrase", "a").withColumn("size", F.lit(k)))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumn("salt", F.pmod(F.xxhash64("phrase", "k"), F.lit(SALT)).cast("int"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")})
    counts = frequent.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    for part, name in (("left", "l"), ("right", "r")):
        cuts = _meet(cuts, counts.select("lang", F.col("phrase").alias(part), "salt", F.col("f").alias(name)), ["lang", part, "salt"])
    score = F.expr(f"CAST(CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    least_cut = cuts.select("lang", "phrase", F.struct(score.alias("score"), "k", "a", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(F.min("cut").alias("cut"))
    scored = stage(least_cut.select("lang", "phrase", "cut.*"), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the best of each slice first, so that no task orders all phrases of a language
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = scored.withColumn("_place", F.row_number().over(Window.partitionBy("lang", slice_).orderBy(*order))).where(F.col("_place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

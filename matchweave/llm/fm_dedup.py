"""Removal of repeated word sequences: documents streamed against compressed FM-indexes, one per shard.

A window of 35 words belongs to its anchor, the leftmost gram of 8 words with the least hash in it. Equal windows have
equal anchors, so a shard of anchors holds all places that can match, and a document visits only the shards of its own anchors. An anchor with the words of
its windows is a context; equal contexts are counted and indexed once. In a shard the contexts are laid out in a row
and indexed; then each is read against the index by backward search, and intervals of windows that the index has twice are reported.

An anchor of very many different contexts is dealt by window instead: those whose hash occurs twice or more go to shards of their own hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm import sieve, wordbytes
from matchweave.llm.common import bounded_batches, small_batches
from matchweave.llm.fm_index import DEPTH, FMIndex, repeated_windows
from matchweave.session import stage

WINDOW, GRAM = 35, 8
#: Contexts of a shard's index, at the ends of groups.
SHARD = 15_000
#: An anchor with more different contexts than this is dealt by window.
CROWD = 2_000
#: Slices that a crowd's contexts are dealt over when they are told that they are one.
SLICES = 32
#: Words whose windows are worked on at once, and the bits that hold a place among them.
SEGMENT, PLACE_BITS = 1 << 20, 21


def _segments(n: int, window: int) -> Iterator[tuple[int, int]]:
    """Ranges of words that hold every window whole and none twice."""
    for at in range(0, max(0, n - window + 1), SEGMENT):
        yield at, min(n, at + SEGMENT + window - 1)


def contexts(words: wordbytes.Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, context hash, first word in the text, windows) of each context, hashes signed."""
    parts: list[tuple[np.ndarray, ...]] = []
    place_mask = np.uint64((1 << PLACE_BITS) - 1)
    for a, b in _segments(len(words.hash), window):
        h, text = words.hash[a:b], words.text[a:b]
        grams, size = h, 1
        while size < gram:
            grams = wordbytes.mixed(grams[:-size] * np.uint64(wordbytes.MULTIPLIER + 2 * size) + grams[size:])
            size *= 2
        least = wordbytes.slide_least(grams & ~place_mask | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
        inside = text[: len(least)] == text[window - 1 :]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        first = np.flatnonzero(begins)
        if not len(first):
            continue
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | (least[1:] != least[:-1])
        last = np.flatnonzero(ends)
        place = (least[first] & place_mask).astype(np.int64)
        own = wordbytes.range_hashes(h, first, last + window)
        own = wordbytes.mixed(own + (place - first).astype(np.uint64))
        parts.append((text[first], grams[place].view(np.int64), own.view(np.int64), first + a - words.per_text[text[first]], last - first + 1))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5


CONTEXTS = "row bigint, h bigint, c bigint, first int, n int"


def _anchors(batch: pa.RecordBatch) -> np.ndarray:
    return contexts(wordbytes.words(*wordbytes.flat(batch.column("text"))))[1].view(np.uint64)


def _contexts(known):
    """Contexts whose anchor the filter ``known`` lets through."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = contexts(wordbytes.words(*wordbytes.flat(batch.column("text"))))
        return _lines(batch, *(x[sieve.passes(known.value, found[1].view(np.uint64))] for x in found))

    return run


def _lines(batch: pa.RecordBatch, text: np.ndarray, h: np.ndarray, c: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    rows = batch.column("row").to_numpy()[text]
    return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(h), pa.array(c), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], ["row", "h", "c", "first", "n"])


def _touched(known, wanted: bool):
    """The rows of a batch whose number the filter ``known`` lets through, or the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = sieve.passes(known.value, wordbytes.mixed(batch.column("row").to_numpy().view(np.uint64)))
            yield batch.filter(pa.array(inside if wanted else ~inside))

    return run


def _rows_of(known, docs: DataFrame, wanted: bool = True) -> DataFrame:
    return docs.mapInArrow(_touched(known, wanted), docs.schema)


def _mixed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(wordbytes.mixed(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["h"])


def _row_filter(rows: DataFrame):
    """Filter of the row numbers of the written table ``rows``: texts without any need not travel."""
    return rows.sparkSession.sparkContext.broadcast(sieve.filter_of(stage(rows.select("row").distinct().mapInArrow(_mixed_rows, "h bigint"), "rows")))


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at the same six separators


def _each_wanted(make: Callable[[list[bytes], dict], Iterator[tuple]], kinds: list[pa.DataType], names: list[str]) -> Callable:
    """Rows made from each text and what is wanted of it."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [row for t, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()) for words in [_split(t)] for w in wanted for row in make(words, w)]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip([list(x) for x in zip(*out)] or [[]] * len(kinds), kinds)], names)

    return run


def _window_hashes(words: list[bytes], w: dict) -> Iterator[tuple]:
    import xxhash

    for a in range(w["n"]):
        yield xxhash.xxh3_64_intdigest(b" ".join(words[w["first"] + a : w["first"] + a + WINDOW])) - (1 << 63), w["h"], w["c"], a, w["row"], w["first"]


def _sent(words: list[bytes], w: dict) -> Iterator[tuple]:
    yield w["key"], w["h"], w["c"], w["a"], b" ".join(words[w["first"] + w["a"] : w["first"] + w["a"] + w["n"] + WINDOW - 1])


HITS = "h bigint, c bigint, a int, b int"


def shard_hits(parts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first window, last window) of the intervals of windows that the parts, together, hold twice or more."""
    listed = pc.split_pattern(pa.array(parts, pa.binary()).cast(pa.large_string()), " ")
    coded = listed.flatten().dictionary_encode()
    sizes = pc.list_value_length(listed).to_numpy().astype(np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[begin + sizes] = False
    text[inside] = coded.indices.to_numpy().astype(np.int64) + 1
    hit = repeated_windows(FMIndex(text, max(DEPTH, int(sizes.max()) + 1)), text, begin, sizes, window)
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    part, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return part, a, b - 1


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the groups in rows (key, h, c, a, ctx) sorted by key, shard after shard."""
    def run(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.array([r[0] for r in rows], np.int64)
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        own = [r for r, k in zip(rows, n[inverse] if len(rows) else []) if k > 1]  # alone, nothing is repeated
        found: list = [[], [], [], []]
        if own:
            part, a, b = shard_hits([r[4] for r in own])
            start = np.array([r[3] for r in own], np.int64)[part]
            found = [np.array([own[i][1] for i in part], np.int64), np.array([own[i][2] for i in part], np.int64), (start + a).astype(np.int32), (start + b).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(found, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["h", "c", "a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if held and row[:4] == held[-1][:4]:
                continue  # a repeated row of documents sends its contexts again
            if len(held) >= SHARD and row[0] != held[-1][0]:
                yield run(held)
                held = []
            held.append(row)
    yield run(held)


def _untouched(known):
    """The rows of a batch that have nothing to remove, in one pass of Python: a second one would be another worker for each task."""
    keep = _touched(known, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return bounded_batches(_removed, "text")(keep(batches))

    return run


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Apply the repeated windows, (first, last) by words of the text, to each text; a batch without ``hits`` has none."""
    out: list[list] = [[], [], [], [], []]
    hits = batch.column("hits").to_pylist() if "hits" in batch.schema.names else [None] * batch.num_rows
    for text, own in zip(batch.column("text").to_pylist(), hits):
        words, cover = _split(text), []
        for x in sorted((x["a"], x["b"] + WINDOW) for x in own or ()):
            if cover and x[0] <= cover[-1][1]:
                cover[-1] = (cover[-1][0], max(cover[-1][1], x[1]))
            else:
                cover.append(x)
        kept, at = [], 0
        for a, b in cover:
            kept += words[at:a]
            at = b
        kept += words[at:]
        for column, value in zip(out, (len(words), len(words) - len(kept), len(cover), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in cover])):
            column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    return pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(x, k) for x, k in zip(out, kinds)], ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, n_spans, kept_sha256 and spans (words, from start to before end) of what repeats.

    A word goes if a window of 35 words over it also starts anywhere else, in the same text or in another; repeated rows count as
    occurrences. Reads doc_id and text only; null counts as empty; texts of fewer words stay whole; an empty table gives none.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    spark = docs.sparkSession
    small_batches(spark)
    # Joins with texts are merge joins: a broadcast one would run the filter of rows and what follows the join in one task, with two Python workers at once.
    # 1. contexts of anchors that occur twice, equal ones counted
    known = spark.sparkContext.broadcast(sieve.frequent_filter(docs.select("text"), "text", _anchors, 2))
    places = stage(docs.select("row", "text").mapInArrow(bounded_batches(_contexts(known), "text", sieve.TEXT_BYTES), CONTEXTS), "contexts")
    classes = places.groupBy("h", "c", "n").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "first")).alias("one"))
    classes = stage(classes.select("h", "c", "n", "copies", "one.row", "one.first"), "classes")
    # 2. anchors of few contexts and of crowds; a class is repeated by its copies alone or has others to be held against
    per_anchor = stage(classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "anchors")
    crowds = per_anchor.where(F.col("kinds") > CROWD).select("h", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"), F.lit(True).alias("crowd"))
    sliced = classes.withColumn("slice", F.pmod("c", F.lit(SLICES)).cast("int")).join(crowds, ["h", "slice"], "left")
    whole = classes.where("copies > 1").select("h", "c", F.lit(0).alias("a"), (F.col("n") - 1).alias("b"))
    several = sliced.where("crowd IS NULL").join(per_anchor.where(F.col("kinds") <= CROWD).select("h"), "h", "left_semi")
    several = several.select("row", F.struct(F.col("h").alias("key"), "h", "c", "first", F.lit(0).alias("a"), "n").alias("w"))
    # 3. windows of crowds whose hash another one has
    crowded = stage(sliced.where("crowd").select("row", F.struct("h", "c", "row", "first", "n").alias("w")), "crowded")
    by_row = _rows_of(_row_filter(crowded), docs.select("row", "text")).join(crowded.groupBy("row").agg(F.collect_set("w").alias("wanted")).hint("merge"), "row").select("text", "wanted")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    hashes = by_row.mapInArrow(bounded_batches(_each_wanted(_window_hashes, kinds, ["key", "h", "c", "a", "row", "first"]), "text"), "key bigint, h bigint, c bigint, a int, row bigint, first int")
    hashes = stage(hashes, "windows")
    met = hashes.groupBy("key").agg(F.min(F.struct("h", "c", "a")).alias("one"), F.max(F.struct("h", "c", "a")).alias("other")).where("one <> other").select("key")
    alone = hashes.join(met, "key", "left_semi").select("row", F.struct("key", "h", "c", "first", "a", F.lit(1).alias("n")).alias("w"))
    # 4. the words that are needed travel to the shards and are searched there
    asked = stage(several.union(alone).groupBy("row").agg(F.collect_set("w").alias("wanted")), "asked")
    sent = _rows_of(_row_filter(asked), docs.select("row", "text")).join(asked.hint("merge"), "row").select("text", "wanted")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    sent = sent.mapInArrow(bounded_batches(_each_wanted(_sent, kinds, ["key", "h", "c", "a", "ctx"]), "text"), "key bigint, h bigint, c bigint, a int, ctx binary")
    found = sent.repartition("key").sortWithinPartitions("key", "h", "c", "a").mapInArrow(_searched, HITS)
    # 5. back to every row that has the context
    hits = stage(whole.union(found).groupBy("h", "c").agg(F.collect_set(F.struct("a", "b")).alias("runs")), "hits")
    of_row = places.select("row", "h", "c", "first").join(hits, ["h", "c"]).select("row", F.explode(F.transform("runs", lambda r: F.struct((F.col("first") + r["a"]).alias("a"), (F.col("first") + r["b"]).alias("b")))).alias("hit"))
    of_row = stage(of_row.groupBy("row").agg(F.collect_set("hit").alias("hits")), "removed")
    touched = _row_filter(of_row)
    joined = _rows_of(touched, docs).join(of_row.hint("merge"), "row", "left").select("doc_id", "text", "hits")
    kind = dict(docs.dtypes)["doc_id"]
    result = f"doc_id {kind}, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>"
    return joined.mapInArrow(bounded_batches(_removed, "text"), result).union(docs.mapInArrow(_untouched(touched), result))

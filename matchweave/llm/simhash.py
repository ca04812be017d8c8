"""SimHash near-duplicates by ball hashing: fingerprints meet on variants half the radius away, then are compared.

The radius is 3 and half of it 1.5, so balls of radius 1 around both would miss pairs 3 apart and balls of
radius 2 have 2,081 variants. Instead one of three bit blocks is left out at a time: of three differing bits,
some block holds at least one, so without that block the pair is at most 2 apart and balls of radius 1 meet.
That is 131 variants a fingerprint and finds every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.llm.common import BATCH_ROWS, LOWER, UPPER, components, words_of
from matchweave.session import stage

RADIUS = 3
BLOCKS = [(0, 21), (21, 42), (42, 64)]
#: Hashes whose bits are counted at once; bounds the counting memory to 64 times as many bytes.
CHUNK = 1 << 17


def shingle_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of each 3-word shingle of the text, of the whole sequence if there are fewer words; none for no words."""
    plain = F.coalesce(text, F.lit(""))
    words = words_of(F.when(F.length(plain) == F.octet_length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER)))
    whole = lambda w: F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.expr("array()").cast("array<bigint>"))
    rolled = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2))))
    return F.transform(F.array(words), lambda w: F.when(F.size(w) >= 3, rolled(w)).otherwise(whole(w)))[0]


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``hashes`` (run k stops before ``ends[k]``): the bits set in over half of it."""
    out = np.zeros(len(ends), np.uint64)
    starts = np.concatenate(([0], ends[:-1]))
    k = 0
    while k < len(ends):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK, side="right")))
        if stop == k + 1:  # one text, of any length
            counts = np.zeros(64, np.int64)
            for at in range(starts[k], ends[k], CHUNK):
                counts += _bits(hashes[at : min(at + CHUNK, ends[k])]).sum(axis=0, dtype=np.int64)
            counts = counts[None, :]
        else:
            own, first = hashes[starts[k] : ends[stop - 1]], starts[k:stop] - starts[k]
            full = ends[k:stop] > starts[k:stop]
            counts = np.zeros((stop - k, 64), np.int64)
            if full.any():
                counts[full] = np.add.reduceat(_bits(own), first[full], axis=0, dtype=np.int32)
        wins = 2 * counts > (ends[k:stop] - starts[k:stop])[:, None]
        out[k:stop] = np.packbits(wins, axis=1, bitorder="little").view("<u8").ravel()
        k = stop
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of each row, the fingerprint as a signed long; zero for no words."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    hashed = docs.select("doc_id", shingle_hashes(F.col("text")).alias("h"), F.xxhash64("text").alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]]
            prints = majority(values, offsets[1:].astype(np.int64) - offsets[0]) if len(batch) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return hashed.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(prints: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint without one block, as it is and with each other bit flipped."""
    pairs = []
    for low, high in BLOCKS:
        keep = ((1 << 64) - 1) ^ (((1 << (high - low)) - 1) << low)
        flips = [0] + [1 << b for b in range(64) if not low <= b < high]
        pairs += [F.struct(F.lit(_signed(keep)).cast("long").alias("keep"), F.lit(_signed(flip)).cast("long").alias("flip")) for flip in flips]
    each = prints.select("fp", F.explode(F.array(*pairs)).alias("v"))
    return each.select(F.col("fp").bitwiseAND(F.col("v.keep")).bitwiseXOR(F.col("v.flip")).alias("key"), "fp")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def spanning(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that join what pairs within the radius join, at most one less than there are fingerprints."""
    left, edges = prints, []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            one = todo.pop()
            near = distance(left, one) <= radius
            for other in left[near]:
                edges.append((one, other))
                todo.append(other)
            left = left[~near]
    return edges


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the runs of equal keys in rows sorted by key; a run may go on in the next batch."""
    def edges(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, len(keys)))
        pairs = starts[sizes == 2]
        a, b = prints[pairs], prints[pairs + 1]
        near = distance(a, b) <= RADIUS
        out = [np.stack([a[near], b[near]], axis=1)]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            if found := spanning(np.unique(prints[start : start + size])):
                out.append(np.array(found, np.uint64))
        both = np.unique(np.sort(np.concatenate(out), axis=1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    old_keys, old_prints = [], []
    for batch in batches:
        keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1], side="left"))  # the last run may go on
        if cut == 0 and (not old_keys or old_keys[0][0] == keys[0]):
            old_keys.append(keys)
            old_prints.append(prints)
            continue
        yield edges(np.concatenate([*old_keys, keys[:cut]]), np.concatenate([*old_prints, prints[:cut]]))
        old_keys, old_prints = [keys[cut:]], [prints[cut:]]
    if old_keys:
        yield edges(np.concatenate(old_keys), np.concatenate(old_prints))


def links(prints: DataFrame) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints within the radius to join all that such pairs join.

    Rows are dealt by variant and sorted on the JVM; a task holds one Arrow batch and one run. A run
    has distinct fingerprints only, all within one bit of each other's variant, so copies of one
    text, however many, are one row in it.
    """
    spark = prints.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(100 * BATCH_ROWS))
    dealt = variants(prints.select("fp").distinct()).repartition("key").sortWithinPartitions("key")
    found = stage(dealt.mapInArrow(_link, "a bigint, b bigint").distinct(), "links")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return found


def members(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of each document row; ``root`` is the component's least fingerprint."""
    prints = stage(fingerprints(docs.select("doc_id", "text")), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes)).select(F.col("node").alias("fp"), "root")
    nodes = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    nodes = stage(nodes, "nodes")
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = nodes.join(ids, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of each document row.

    Fingerprints link at three or fewer differing bits; ``component_id`` is the smallest doc_id that
    links reach. Reads doc_id and text only. Null and wordless texts have fingerprint zero and link like
    any other; rows repeat as given; a null doc_id counts only if its component has no other (then null);
    an empty table gives none.
    """
    return members(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

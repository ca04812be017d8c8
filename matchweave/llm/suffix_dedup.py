"""Removal of long repeated byte strings, by interval expansion on sharded Burrows-Wheeler columns.

Every 200-byte window has an anchor: its leftmost gram of least hash. Equal windows have equal anchors at the
same place in them, so windows can be dealt by anchor and no repeat is lost. An anchor with the bytes of its
windows around it is a context; equal contexts are counted first and travel once. In a shard the
contexts of an anchor are extended backwards, breadth first, a column of preceding bytes at a time: the stable
sort by that column is the step from a suffix order to the next, and the common prefix of neighbours is one more
than the least one between them. Windows whose common prefix reaches the minimum are repeated; contexts that
can't reach it any more leave.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.llm.common import BATCH_ROWS
from matchweave.session import stage

MINIMUM, GRAM = 200, 32
#: Windows of a text that are worked on at once; bounds the memory for very long texts.
SEGMENT = 1 << 20
#: Repeated anchors are broadcast up to this many rows of eight bytes; beyond, the search is a shuffled join.
BROADCAST_ROWS = 2_000_000
#: An anchor with more distinct contexts than this is dealt anew, by blocks of BLOCK windows that share nearly all their bytes.
CROWD, BLOCK = 20_000, 16
#: Contexts that a task extends at once, at the ends of groups.
CHUNK = 60_000
PLACE = np.uint64((1 << 24) - 1)

_table = np.random.default_rng(200).integers(1, 1 << 63, 256, dtype=np.uint64)


def _slide_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    n, size, y = len(x) - width + 1, 1, x
    while 2 * size <= width:
        y = np.minimum(y[: len(y) - size], y[size:])
        size *= 2
    return np.minimum(y[:n], y[width - size : width - size + n])


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of each ``gram`` bytes (a power of two), by doubling."""
    h, size = _table[data], 1
    while size < gram:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    return h


def anchors(data: bytes, minimum: int = MINIMUM) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Segments of (hash, place, first window, last window) of each anchor of a text, by window."""
    found = []
    for at in range(0, max(0, len(data) - minimum + 1), SEGMENT):
        own = np.frombuffer(data[at : at + SEGMENT + minimum - 1], np.uint8)
        h = gram_hashes(own)
        least = _slide_least(h & ~PLACE | np.arange(len(h), dtype=np.uint64), minimum - GRAM + 1)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(first[1:], len(least)) - 1
        place = (least[first] & PLACE).astype(np.int64)
        found.append((h[place], place + at, first + at, last + at))
    return found


def contexts(data: bytes, minimum: int = MINIMUM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, context hash, place, first window, last window) over a whole text, hashes signed."""
    parts = anchors(data, minimum)
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    h, place, first, last = (np.concatenate(x) for x in zip(*parts))
    view = memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    c = np.array([digest(view[a : b + minimum], seed=p - a) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist())], np.uint64)
    return h.view(np.int64), c.view(np.int64), place, first, last


def _map(df: DataFrame, schema: str, make: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(h, n): anchors of a batch, each once."""
    found = [h for t in _bytes(batch.column("text")) for h, *_ in anchors(t)]
    h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def _members(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(row, h, c, n): the distinct contexts of each row."""
    rows, out = batch.column("row").to_numpy(), []
    for row, t in zip(rows, _bytes(batch.column("text"))):
        h, c, *_ = contexts(t)
        if len(c):
            _, at, n = np.unique(c, return_index=True, return_counts=True)
            out.append((np.full(len(at), row), h[at], c[at], n.astype(np.int64)))
    columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["row", "h", "c", "n"])


SENT = "key bigint, h bigint, c bigint, many boolean, start int, off int, ctx binary"


def _sent(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The contexts asked for, or their blocks: bytes, the anchor's place in them and the place of the first window in the context."""
    out: list[tuple] = []
    for text, wanted in zip(_bytes(batch.column("text")), batch.column("wanted").to_pylist()):
        asked = {(w["h"], w["c"]): (w["many"], w["crowd"]) for w in wanted}
        for h, c, place, first, last in zip(*(x.tolist() for x in contexts(text))):
            if (how := asked.pop((h, c), None)) is None:
                continue
            many, crowd = how
            if not crowd:
                out.append((h, h, c, many, 0, place - first, text[first : last + MINIMUM]))
                continue
            # blocks by the anchor's place in the window, so that equal windows fall into equal blocks
            low = first
            while low <= last:
                block = (place - low) // BLOCK
                high = min(last, place - block * BLOCK)
                inside_from, inside_to = place - block * BLOCK, place - (block + 1) * BLOCK + 1 + MINIMUM
                key = xxhash.xxh3_64_intdigest(text[max(0, inside_from) : inside_to], seed=block + 1)
                out.append((key - (1 << 64) if key >> 63 else key, h, c, many, low - first, place - low, text[low : high + MINIMUM]))
                low = high + 1
    columns = [list(x) for x in zip(*out)] or [[] for _ in range(7)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["key", "h", "c", "many", "start", "off", "ctx"])


def _least_between(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of lcp[a + 1 .. b] for pairs a < b."""
    at = np.stack([a + 1, b + 1], axis=1).ravel()
    return np.minimum.reduceat(np.append(lcp, 0), at)[::2]


def expand(group: np.ndarray, ctx: list[bytes], off: np.ndarray, minimum: int = MINIMUM) -> np.ndarray:
    """Which windows of each context also start elsewhere in its group: a matrix of contexts by windows.

    ``group`` is sorted, at most 65,536 values; ``off`` is the place of the anchor in its context.
    """
    sizes = np.array([len(x) for x in ctx], np.int64)
    left, right = int(off.max(initial=0)), int((sizes - off).max(initial=0))
    matrix = np.zeros((len(ctx), left + right), np.uint16)  # a byte plus one; 0 where a context has none
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.repeat(np.arange(len(ctx)) * (left + right) + left - off - starts, sizes) + np.arange(sizes.sum())
    matrix.ravel()[flat] = np.frombuffer(b"".join(ctx), np.uint8).astype(np.uint16) + 1
    windows = sizes - minimum + 1
    hit = np.zeros((len(ctx), int(windows.max(initial=0))), bool)
    group = (np.cumsum(np.concatenate(([False], group[1:] != group[:-1])))).astype(np.uint16)
    order = np.arange(len(ctx))
    lcp = np.zeros(len(ctx), np.int32)
    columns = np.ascontiguousarray(matrix.T)

    def put(picked: np.ndarray, same: np.ndarray) -> None:
        """Go over to the rows ``picked``; ``same`` marks those that go on the row before."""
        nonlocal order, lcp
        new = np.zeros(len(picked), np.int32)
        at = np.flatnonzero(same)
        if len(at):
            new[at] = _least_between(lcp, picked[at - 1], picked[at])
        order, lcp = order[picked], new

    for j in range(right - 1, -left - 1, -1):
        if j < 0 and len(order):  # only what can still reach the minimum stays
            near = np.maximum(lcp, np.append(lcp[1:], 0))
            stays = (off[order] + j >= 0) & (near + j + 1 + off[order] >= minimum)
            if not stays.all():
                kept = np.flatnonzero(stays)
                g = group[order[kept]]
                put(kept, np.concatenate(([False], g[1:] == g[:-1])) if len(g) else np.zeros(0, bool))
        if not len(order):
            break
        column, g = columns[j + left][order], group[order]
        follows = np.concatenate(([False], g[1:] == g[:-1]))
        if (follows[1:] & (column[1:] != column[:-1])).any():
            by_byte = np.argsort(column, kind="stable")
            picked = by_byte[np.argsort(g[by_byte], kind="stable")]
            column, g = column[picked], g[picked]
            same = np.concatenate(([False], (g[1:] == g[:-1]) & (column[1:] == column[:-1]) & (column[1:] > 0)))
            put(picked, same)
        else:
            same = follows & (column > 0)
            lcp = np.where(same, lcp, 0)
        lcp = np.where(same, np.minimum(lcp + 1, minimum), 0)
        full = lcp >= minimum
        found = order[full | np.append(full[1:], False)]
        at = off[found] + j
        inside = (at >= 0) & (at < windows[found])
        hit[found[inside], at[inside]] = True
    return hit


HITS = "h bigint, c bigint, a int, b int"


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows (first and last, from the start of the context) of the groups in rows sorted by key."""
    def run(rows: list[tuple]) -> pa.RecordBatch:
        key, h, c, many, start, off, ctx = (list(x) for x in zip(*rows)) if rows else ([],) * 7
        key = np.array(key, np.int64)
        twice = np.repeat(np.arange(len(key)), 1 + np.array(many, np.int64)) if rows else np.zeros(0, np.int64)
        _, inverse, n = np.unique(key[twice], return_inverse=True, return_counts=True)
        twice = twice[n[inverse] > 1]  # alone, nothing is repeated
        found = [[], [], [], []]
        if len(twice):
            hit = expand(key[twice], [ctx[i] for i in twice], np.array(off, np.int64)[twice])
            once = np.concatenate(([True], twice[1:] != twice[:-1]))
            edge = np.diff(np.pad(hit[once], ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, a = np.nonzero(edge == 1)
            _, b = np.nonzero(edge == -1)
            own = twice[once][row]
            s = np.array(start, np.int32)[own]
            found = [np.array(h, np.int64)[own], np.array(c, np.int64)[own], s + a.astype(np.int32), s + b.astype(np.int32) - 1]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(found, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["h", "c", "a", "b"])

    held: list[tuple] = []
    cut = last = 0  # rows of groups that have ended; the newest row's key
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if held and row[0] == held[-1][0] and row[1:3] == held[-1][1:3] and row[4] == held[-1][4]:
                continue  # a repeated row of documents sends its contexts again
            if held and row[0] != last:
                cut = len(held)
                if cut >= CHUNK:
                    yield run(held)
                    held, cut = [], 0
            held.append(row)
            last = row[0]
    yield run(held)


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Apply the repeated windows to each text."""
    texts, hits = _bytes(batch.column("text")), batch.column("hits").to_pylist()
    out = [[], [], [], [], []]
    for text, own in zip(texts, hits):
        cover: list[tuple[int, int]] = []
        if own:
            spans: dict[tuple, list] = {}
            for x in own:
                spans.setdefault((x["h"], x["c"]), []).append((x["a"], x["b"]))
            for h, c, _, first, _ in zip(*(x.tolist() for x in contexts(text))):
                for a, b in sorted(spans.get((h, c), ())):
                    if cover and first + a <= cover[-1][1]:
                        cover[-1] = (cover[-1][0], max(cover[-1][1], first + b + MINIMUM))
                    else:
                        cover.append((first + a, first + b + MINIMUM))
        digest, at = hashlib.sha256(), 0
        for a, b in cover:
            digest.update(text[at:a])
            at = b
        digest.update(text[at:])
        for column, value in zip(out, (len(text), sum(b - a for a, b in cover), len(cover), digest.hexdigest(), [{"start": a, "end": b} for a, b in cover])):
            column.append(value)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
    return pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(x, k) for x, k in zip(out, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _batches(spark: SparkSession, rows: int) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def repeated_strings(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (byte start and end) of what repeats.

    A byte goes if a 200-byte string over it also starts anywhere else, in the same text or in another; repeated
    rows count as occurrences. Reads doc_id and text only; null counts as empty; texts under 200 bytes stay whole;
    an empty table gives none.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    _batches(spark, BATCH_ROWS)
    # 1. anchors that occur twice or more
    counted = _map(docs.select("text"), "h bigint, n bigint", _counted)
    repeated = stage(counted.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "anchors")
    few = repeated.count() <= BROADCAST_ROWS
    # 2. their contexts, equal ones counted; one row is asked for each
    members = _map(docs.select("row", "text"), "row bigint, h bigint, c bigint, n bigint", _members)
    members = stage(members.join(F.broadcast(repeated) if few else repeated, "h", "left_semi").select("row", "h", "c", "n"), "members")
    classes = stage(members.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("row").alias("row")), "classes")
    crowds = classes.groupBy("h").count().where(F.col("count") > CROWD).select("h", F.lit(True).alias("crowd"))
    asked = classes.join(crowds, "h", "left").select("row", F.struct("h", "c", (F.col("n") > 1).alias("many"), F.coalesce("crowd", F.lit(False)).alias("crowd")).alias("w"))
    asked = asked.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    # 3. contexts meet by anchor and are extended
    sent = _map(docs.select("row", "text").join(asked, "row").select("text", "wanted"), SENT, _sent)
    dealt = sent.repartition("key").sortWithinPartitions("key", "h", "c", "start")
    hits = stage(dealt.mapInArrow(_expanded, HITS), "hits")
    # 4. back to every row that has the context
    of_row = members.select("row", "h", "c").join(hits, ["h", "c"]).groupBy("row").agg(F.collect_list(F.struct("h", "c", "a", "b")).alias("hits"))
    joined = docs.join(of_row, "row", "left").select("doc_id", "text", "hits")
    kind = dict(docs.dtypes)["doc_id"]
    return _map(joined, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>", _removed)

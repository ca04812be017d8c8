"""Which hashes occur often, as a Bloom filter of bounded size.

A filter only spares work: it lets every hash through that occurs often enough and a few others, so what follows
has to be right without it. Counts travel as sorted hashes by slot, nine to twelve bytes for each distinct hash of a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchweave.llm.common import slices
from matchweave.llm.wordbytes import mixed
from matchweave.session import stage

#: Slots that hashes are dealt over: of a hundred terabytes of text one holds about a gigabyte.
SLOT_BITS = 16
#: Hashes that a task holds before it sends them; bytes of text worked on at once.
HELD, TEXT_BYTES = 2_000_000, 2 << 20
#: Bits of the filter for each hash, and the bounds of its size in bits, as powers of two.
BITS_EACH, SMALLEST, LARGEST = 16, 18, 28

COUNTS = "slot int, hashes binary, counts binary"


def _counts(hashes: Callable[[pa.RecordBatch], np.ndarray], text: str, least: int):
    """Counts of the hashes of a task: by slot, sorted hashes and their counts, which stop at ``least``."""
    kind = "u1" if least < 256 else "<u4"

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), slot[1:] != slot[:-1])))
        ends = np.append(cut[1:], len(h))
        few, raw = np.minimum(n, least).astype(kind), h.astype("<u8")
        return pa.RecordBatch.from_arrays([pa.array(slot[cut], pa.int32()), pa.array([raw[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()), pa.array([few[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())], ["slot", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text, TEXT_BYTES):
                own = hashes(part)
                held.append(own)
                size += len(own)
                if size >= HELD:
                    yield send(held)
                    held, size = [], 0
        if size:
            yield send(held)

    return run


def _often(least: int):
    """Hashes that occur ``least`` times or more, from the rows of slots in order."""
    kind = "u1" if least < 256 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> pa.RecordBatch:
            h = np.frombuffer(b"".join(x for x, _ in held), "<u8")
            n = np.frombuffer(b"".join(x for _, x in held), kind)
            order = np.argsort(h, kind="stable")
            h, n = h[order], n[order].astype(np.int64)
            cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
            total = np.add.reduceat(n, cut) if len(cut) else n
            return pa.RecordBatch.from_arrays([pa.array(h[cut][total >= least].view(np.int64))], ["h"])

        slot, held = None, []
        for batch in batches:
            for s, h, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != slot and held:
                    yield merged()
                    held = []
                slot = s
                held.append((h, n))
        if held:
            yield merged()

    return run


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a filter of 2^bits."""
    return h & np.uint64((1 << bits) - 1), mixed(h) & np.uint64((1 << bits) - 1)


def passes(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter ``table`` (bytes) lets through."""
    bits = (len(table) * 8).bit_length() - 1
    out = np.ones(len(h), bool)
    for at in positions(h, bits):
        out &= (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def _blocks(bits: int):
    """Blocks of the filter (a page of bytes each) with the bits of a task's hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for at in positions(batch.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        blocks = own.reshape(-1, 4096)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([blocks[i].tobytes() for i in used], pa.binary())], ["block", "bits"])

    return run


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(raw, np.uint8)
            seen[block] = seen[block] | own if block in seen else own
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array([x.tobytes() for x in seen.values()], pa.binary())], ["block", "bits"])


def filter_of(hashes: DataFrame) -> np.ndarray:
    """Bloom filter, as bytes, of the bigints in the one column of ``hashes``, a written table: 32 MB at most."""
    bits = min(max((hashes.count() * BITS_EACH).bit_length(), SMALLEST), LARGEST)
    blocks = hashes.mapInArrow(_blocks(bits), "block int, bits binary").repartition("block").mapInArrow(_together, "block int, bits binary")
    out = np.zeros((1 << (bits - 3 - 12), 4096), np.uint8)
    for r in blocks.toLocalIterator():
        out[r.block] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def frequent_filter(texts: DataFrame, text: str, hashes: Callable[[pa.RecordBatch], np.ndarray], least: int) -> np.ndarray:
    """Filter of what ``hashes`` gives of the batches of ``texts`` ``least`` times or more."""
    counted = texts.mapInArrow(_counts(hashes, text, least), COUNTS).repartition("slot").sortWithinPartitions("slot")
    return filter_of(stage(counted.mapInArrow(_often(least), "h bigint"), "often"))

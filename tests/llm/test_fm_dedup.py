"""Repeated word sequences against counting all windows; the index against plain search."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from matchweave.llm import fm_dedup, wordbytes
from matchweave.llm.fm_index import FMIndex, repeated_windows
from tests.llm.helpers import ODD, SCHEMA, odd, prose


def plain(rows, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return Counter(out)


def got(spark, rows):
    found = fm_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in found:
        assert r.n_removed == sum(s.end - s.start for s in r.spans) and r.n_spans == len(r.spans)
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found)


def planted(seed, n=120):
    dice = random.Random(seed)
    many = [f"w{k}" for k in range(3000)]
    passage = [prose(dice, k, many) for k in (33, 34, 35, 36, 80, 300)]
    rows = []
    for i in range(n):
        parts = [prose(dice, dice.randint(0, 60), many), dice.choice(passage), prose(dice, dice.randint(0, 60), many)]
        if i % 11 == 0:
            parts += ["the the " * 40, "a b c " * 30]
        if i % 13 == 0:
            parts.append(dice.choice(passage))
        rows.append((i, dice.choice([" ", "\n", " \t "]).join(" ".join(parts).split(" "))))
    return rows + rows[:5] + [(None, rows[7][1]), (None, rows[7][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_counting_all_windows(spark, seed):
    rows = planted(seed) + ODD
    assert got(spark, rows) == plain(rows)


def test_crowds_and_small_shards(spark, monkeypatch):
    """One passage of 34 words in all texts: an anchor with a different context in each of them."""
    monkeypatch.setattr(fm_dedup, "CROWD", 10)
    dice = random.Random(5)
    many = [f"w{k}" for k in range(5000)]
    common = prose(dice, 34, many)
    rows = [(i, f"{prose(dice, 40, many)} {common} {prose(dice, 40, many) if i % 9 else 'same end of some ' * 12}") for i in range(150)]
    assert got(spark, rows) == plain(rows)


def test_shards_are_bounded_and_agree(monkeypatch):
    dice = random.Random(6)
    parts = [prose(dice, dice.randint(35, 62)).encode() for _ in range(300)]
    parts += [b" ".join(parts[k].split()[:40]) for k in range(0, 40, 3)]
    part, a, b = fm_dedup.shard_hits(parts)
    found = {(p, w) for p, x, y in zip(part.tolist(), a.tolist(), b.tolist()) for w in range(x, y + 1)}
    counts = Counter(tuple(p.split()[i : i + 35]) for p in parts for i in range(len(p.split()) - 34))
    assert found == {(k, i) for k, p in enumerate(parts) for i in range(len(p.split()) - 34) if counts[tuple(p.split()[i : i + 35])] > 1}


@pytest.mark.parametrize("seed", range(4))
def test_backward_search_counts(seed):
    dice = np.random.default_rng(seed)
    text = np.concatenate([np.append(dice.integers(1, dice.integers(2, 30), dice.integers(1, 40)), 0) for _ in range(60)]).astype(np.int64)
    index = FMIndex(text)
    line = " " + " ".join(map(str, text)) + " "
    for _ in range(60):
        a = int(dice.integers(0, len(text) - 6))
        pattern = text[a : a + int(dice.integers(1, 6))]
        if 0 in pattern:
            continue
        low, high = np.array([0]), np.array([index.n])
        for s in pattern[::-1]:
            low, high = index.extend(np.array([s]), low, high)
        wanted = " " + " ".join(map(str, pattern)) + " "
        assert high[0] - low[0] == sum(line.startswith(wanted, i) for i in range(len(line)))


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_random_parts(seed):
    dice = np.random.default_rng(seed + 10)
    parts = [dice.integers(1, 3 + seed * 2, dice.integers(1, 30)).tolist() for _ in range(80)]
    text = np.array([x for p in parts for x in [*p, 0]], np.int64)
    sizes = np.array([len(p) for p in parts])
    hit = repeated_windows(FMIndex(text), text, np.cumsum(sizes + 1) - sizes - 1, sizes, 5)
    counts = Counter(tuple(p[i : i + 5]) for p in parts for i in range(len(p) - 4))
    for k, p in enumerate(parts):
        assert hit[k].tolist() == [i + 5 <= len(p) and counts[tuple(p[i : i + 5])] > 1 for i in range(hit.shape[1])]


def test_words_as_arrays(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(wordbytes, "BLOCK", 7)
    texts = [None, "", "a bb  ccc", "é\tü ", "x" * 40 + " y", " lead", "bb", "\n", "ccc a"]
    for column in (pa.array(texts), pa.array(["zz", *texts]).slice(1)):
        data, offsets = wordbytes.flat(column)
        for block in (3, 7, 1000):
            monkeypatch.setattr(wordbytes.cuts, "__defaults__", (block,))
            w = wordbytes.words(data, offsets)
            own = [[data[s:e].tobytes().decode() for s, e, t in zip(w.start, w.end, w.text) if t == k] for k in range(len(texts))]
            assert own == [(t or "").split() for t in texts]
            named = {}
            for s, e, h in zip(w.start, w.end, w.hash):
                assert named.setdefault(data[s:e].tobytes(), h) == h
            assert len(set(named.values())) == len(named)
            assert w.per_text.tolist() == np.cumsum([0] + [len((t or "").split()) for t in texts]).tolist()


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(fm_dedup, "SEGMENT", 50)
    dice = random.Random(8)
    text = prose(dice, 4000, [f"w{k}" for k in range(900)])
    words = wordbytes.words(*wordbytes.flat(__import__("pyarrow").array([text])))
    _, h, _, first, n = fm_dedup.contexts(words)
    assert n.sum() == 4000 - 34 and sorted(x for f, k in zip(first, n) for x in range(f, f + k)) == list(range(4000 - 34))


def test_odd_tables(spark):
    assert fm_dedup.repeated_passages(odd(spark, extra=True)).count() == len(ODD)
    assert fm_dedup.repeated_passages(odd(spark).limit(0)).collect() == []


def test_one_python_worker_a_task(spark):
    """Two maps of Python without a shuffle between them keep two workers for each task, with their memory."""
    found = fm_dedup.repeated_passages(spark.createDataFrame(planted(3, 30), SCHEMA))
    above: list[tuple[int, int]] = []  # depth of each line's parents and the maps since the last exchange
    for line in found._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        while above and above[-1][0] >= depth:
            above.pop()
        maps = 0 if "Exchange" in line else (above[-1][1] if above else 0) + ("MapInArrow" in line)
        assert maps < 2, line
        above.append((depth, maps))


def test_arrays_over_few_bytes_at_once():
    text = " ".join(f"word{k}" for k in range(250_000))  # two megabytes
    data, offsets = wordbytes.flat(__import__("pyarrow").array([text]))
    wordbytes._powers.clear()
    tracemalloc.start()
    try:
        wordbytes.words(data, offsets)
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()

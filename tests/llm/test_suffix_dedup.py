"""Repeated 200-byte strings against a count of every window."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from matchweave.llm import suffix_dedup as S

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - 199):
            w = d[i : i + 200]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def collection(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(rng.randint(20, 90)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [prose(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng.randint(0, 30))]
        texts.append(" ".join(parts))
    for k in range(12):  # near copies of one text
        t = texts[0]
        at = rng.randrange(max(1, len(t)))
        texts.append(t[:at] + "xyz"[k % 3] + t[at:])
    texts += [texts[3]] * 4 + ["a" * 900, "a" * 150, "ab" * 400, "foo " * 300, "", None, passages[0][:199], "é" * 150 + "a"]
    return texts


@pytest.mark.parametrize("seed, crowd", [(1, 20_000), (2, 20_000), (3, 3)])
def test_matches_a_count_of_every_window(spark, monkeypatch, seed, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "SEGMENT", 700)
    texts = collection(seed)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.repeated_strings(docs).collect()}
    assert [got[k] for k in range(len(texts))] == plain(texts)


def test_shuffled_search_and_small_chunks_give_the_same(spark, monkeypatch):
    texts = collection(4)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], SCHEMA)
    monkeypatch.setattr(S, "BROADCAST_ROWS", -1)
    got = {r.doc_id: r.n_removed for r in S.repeated_strings(docs).collect()}
    assert [got[k] for k in range(len(texts))] == [x[1] for x in plain(texts)]


def test_repeated_rows_null_ids_extra_columns_and_empty_tables(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(None, text, 1), (7, text, 2), (7, text, 2), (8, "short", 3)], "doc_id long, text string, n_removed int")
    rows = S.repeated_strings(docs).collect()
    size = len(text)
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows)) == [(False, 7, size), (False, 7, size), (False, 8, 0), (True, 0, size)]
    assert S.repeated_strings(docs.limit(0)).collect() == []

"""Fingerprints and their classes against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from matchweave.llm import simhash
from matchweave.llm.common import components
from tests.llm.helpers import ODD, SCHEMA, odd, prose


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_every_pair_within_the_radius_is_linked(spark):
    dice = random.Random(3)
    prints = {0, 1, 7, 2**64 - 1, 2**63}
    for _ in range(40):
        one = dice.getrandbits(64)
        prints.add(one)
        for _ in range(3):
            one ^= sum(1 << b for b in dice.sample(range(64), dice.randint(1, 5)))
            prints.add(one)
    prints = sorted(prints)
    rows = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp bigint")
    found = {int(np.int64(r.node).astype(np.uint64)): r.root for r in components(simhash.links(rows)).collect()}
    mine, theirs = {}, {}
    for p, c in zip(prints, classes(prints)):
        mine.setdefault(found.get(p, ("alone", p)), set()).add(p)
        theirs.setdefault(c, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_documents(spark):
    dice = random.Random(4)
    first = prose(dice, 300)
    docs = [(k, prose(dice, 40 + k)) for k in range(20, 40)] + [(90, first), (91, first.upper()), (92, first + " omega"), (50, first)]
    docs += ODD
    found = simhash.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()
    prints = {(k, fingerprint(t)) for k, t in docs}
    assert {(r.doc_id, int(r.fingerprint, 16)) for r in found} == prints and len(found) == len(docs)
    own = [fingerprint(t) for _, t in docs]
    group = classes(own)
    for r in found:
        at = own.index(int(r.fingerprint, 16))
        ids = [k for (k, _), g in zip(docs, group) if g == group[at] and k is not None]
        assert r.component_id == (min(ids) if ids else None)


def test_counting_in_pieces(monkeypatch):
    dice = np.random.default_rng(0)
    hashes = dice.integers(0, 2**63, 500, dtype=np.uint64)
    ends = np.array([0, 3, 3, 200, 201, 500])
    whole = simhash.majority(hashes, ends)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert (simhash.majority(hashes, ends) == whole).all() and whole[0] == whole[2] == 0


@pytest.mark.parametrize("size", [2, 9, 40])
def test_chains_of_links_are_one_component(spark, size):
    edges = spark.createDataFrame([(k, k + 1) for k in range(size)] + [(1000, 1001), (7777, 7777)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**dict.fromkeys(range(size + 1), 0), 1000: 1000, 1001: 1000}


def test_odd_tables(spark):
    assert simhash.near_duplicates(odd(spark, extra=True)).count() == len(ODD)
    assert simhash.near_duplicates(odd(spark).limit(0)).collect() == []

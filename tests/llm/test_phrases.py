"""Collocations against counting all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from matchweave.llm import phrases, sieve
from tests.llm.helpers import ODD, odd

SCHEMA = "doc_id bigint, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, share=80):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {p: a for p, a in f.items() if 2 <= len(p[1]) and a >= least}
    gone = set()
    for (lang, p), b in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * b >= share * candidates[lang, p[i : i + k]]:
                    gone.add((lang, p[i : i + k]))
    out = {}
    for (lang, p), a in candidates.items():
        if (lang, p) in gone:
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top])}


def got(spark, rows, **options):
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def corpus(seed, n=150):
    dice = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "big", "red", "dog", "a.b", "x,y"] + [f"w{k}" for k in range(40)]
    fixed = ["terms and conditions may apply to this offer in all states", "New York City", "New  York", "once upon\ta time there was", "the the the the the"]
    rows = []
    for i in range(n):
        parts = [dice.choice([dice.choice(fixed), " ".join(dice.choices(words, k=dice.randint(1, 12)))]) + dice.choice([". ", ", ", "\n", " ", "!? ", "\x0b"]) for _ in range(dice.randint(0, 12))]
        rows.append((i, "".join(parts), dice.choice(["en", "de", None, ""])))
    return rows


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 3, 2000), (2, 8, 15), (3, 2, 40)])
def test_same_as_counting_all_phrases(spark, seed, least, top):
    rows = corpus(seed) + [(i, t, "en") for i, t in ODD]
    wanted = plain(rows, least, top)
    assert len(wanted) > 20 and got(spark, rows, least=least, top=top) == wanted


def test_a_filter_that_lets_all_through_and_tasks_that_send_early(spark, monkeypatch):
    rows = corpus(4, 60)
    monkeypatch.setattr(phrases, "pair_filter", lambda texts, least: np.full(1 << 15, 255, np.uint8))
    monkeypatch.setattr(phrases, "HELD_GRAMS", 50)
    assert got(spark, rows, least=4) == plain(rows, 4, 2000)


def test_the_filter_has_all_frequent_pairs(spark, monkeypatch):
    monkeypatch.setattr(sieve, "HELD", 100)
    rows = corpus(5, 80)
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("text", "coalesce(lang, 'und') AS lang")
    table = phrases.pair_filter(texts, 5)
    import pyarrow as pa

    tokens = phrases._Tokens(pa.record_batch({"text": [r[1] for r in rows], "lang": ["und" if r[2] is None else r[2] for r in rows]}))
    seen = Counter(tokens.pairs[tokens.follows].tolist())
    through = {h for h, ok in zip(seen, sieve.passes(table, np.array(list(seen), np.uint64))) if ok}
    frequent = {h for h, n in seen.items() if n >= 5}
    assert frequent and frequent <= through and len(through) < len(frequent) + len(seen) / 20


def test_unary_paths_are_one_line(spark):
    text = "start of a very long passage that all of them have in common here"
    rows = [(i, text, "en") for i in range(5)] + [(9, "a very long way", "en")]
    frequent = phrases.flows(phrases.counted_grams(spark.createDataFrame(rows, SCHEMA), 2)).where("f >= 2")
    lines = {(" ".join(r.words), r.f) for r in phrases.compacted(frequent).collect()}
    assert lines == {("start of a very long", 5), ("a very long passage that all of them have in common here", 5)} or lines == {("start of a very", 5), ("of a very long", 5), ("a very long passage that all of them have in common here", 5)}
    assert got(spark, rows, least=3) == plain(rows, 3, 2000)


def test_large_counts_are_exact(spark):
    rows = [("en", "a b", 2, 9_000_000_000_000_000), ("en", "b", 1, 1)]
    f = phrases.flows(spark.createDataFrame(rows, "lang string, gram string, size int, n bigint"))
    assert {(r.phrase, r.f) for r in f.collect()} == {("a b", 9_000_000_000_000_000), ("a", 9_000_000_000_000_000), ("b", 1)}


def test_odd_tables(spark):
    assert phrases.collocations(odd(spark, extra=True)).collect() == []
    assert phrases.collocations(odd(spark).limit(0)).collect() == []
    twice = odd(spark).select("doc_id", "text")
    assert {r.phrase for r in phrases.collocations(twice, least=2).collect()} == {"again again"}


def test_no_table_that_grows_with_the_texts_is_broadcast(spark, monkeypatch):
    """Tables this small would all be broadcast; at size, one sized too low (compressed, or before an explode) would fill the driver."""
    plans, write = [], phrases.stage

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(phrases, "stage", seen)
    rows = [(i, "a b c d e f. a b c x. b c d", "en") for i in range(4)]
    assert phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=3).count() > 0
    assert sum(text.count("SortMergeJoin") for _, text in plans) >= 8
    assert [name for name, text in plans if "BroadcastExchange" in text] == []

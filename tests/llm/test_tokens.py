"""Token counts against the tokenizers library, n-best segmentation against all segmentations."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchweave.llm import pieces, token_counts
from tests.llm.helpers import ODD, SCHEMA, odd, prose

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def strange(seed):
    dice = random.Random(seed)
    letters = "aAbB éß漢😀 \n\t'\"0123456789.,;-_<|>endoftx 　\x00"
    out = ["".join(dice.choices(letters, k=dice.randint(0, 60))) for _ in range(60)]
    out += ["a" * 5000, "ab" * 3000, " " * 3000, "the " * 400, "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "don't I'LL we've", "\n\n \n  x", "1234567890" * 300]
    return out + [prose(dice, 200), "aaabaaacaaa"]


def test_counts_are_the_libraries(spark):
    texts = strange(1) + [t for _, t in ODD]
    library = Tokenizer.from_file(public_tokenizers.path(BPE))
    found = {r.doc_id: r for r in token_counts.count_tokens(spark.createDataFrame(list(enumerate(texts)), SCHEMA), BPE).collect()}
    for k, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[k].n_tokens, found[k].n_bytes, found[k].over_limit) == (n, len((text or "").encode()), n > 1024)


def test_every_code_point_is_split_as_by_the_library():
    library, merger = Tokenizer.from_file(public_tokenizers.path(BPE)), token_counts.Merger(public_tokenizers.path(BPE))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 100_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}'s " for c in points[at : at + 100_000])
        ends = [end for _, (_, end) in library.pre_tokenizer.pre_tokenize_str(text)]
        own = list(itertools.accumulate(map(len, merger.pretokens(text)[0])))
        assert own == ends


def test_both_ways_of_merging_agree(monkeypatch):
    merger = token_counts.Merger(public_tokenizers.path(BPE))
    tokens = [p.encode() for t in strange(2) for p in merger.pretokens(t)[0]]
    whole = merger.counts(tokens).tolist()
    assert whole == [merger.count_long(t) for t in tokens]
    monkeypatch.setattr(token_counts, "CHUNK", 50)
    monkeypatch.setattr(token_counts, "LONG", 20)
    assert merger.counts(tokens).tolist() == whole


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice(public_tokenizers.path(PIECES))


def all_segmentations(lattice, word):
    edges = lattice.edges(word)

    def paths(end):
        if end == 0:
            return [(0, ())]
        return [(s + score, ids + more) for start, more, score in edges[end] for s, ids in paths(start)]

    return sorted(paths(len(word)), key=lambda p: -p[0])


@pytest.mark.parametrize("word", ["▁the", "▁hello", "abab", "▁▁x", "漢é", "▁it's", "a"])
def test_the_best_of_a_word(lattice, word):
    every = all_segmentations(lattice, word)
    found = lattice.search(word, 6)
    assert [s for s, _ in found] == [s for s, _ in every[:6]]
    score, ids, gap = lattice.best(word)
    assert (score, gap) == (every[0][0], every[0][0] - every[1][0] if len(every) > 1 else None) and (score, tuple(ids)) in every
    assert len({tuple(ids) for _, ids in found}) == len(found) == min(6, len(every))
    assert {tuple(ids) for _, ids in found} <= {ids for _, ids in every}


def test_many_words_at_once(lattice):
    words = sorted({w for t in strange(5) for w in pieces._words.findall((pieces.SPACE + t).replace(" ", pieces.SPACE)) if len(w) < 300})
    assert len(words) > 100
    scores, losses, ids, number, right = lattice.best_many(words)
    for word, score, loss, own, fits in zip(words, scores.tolist(), losses.tolist(), np.split(ids, np.cumsum(number)[:-1]), right.tolist()):
        alone = lattice.best(word)
        assert (score, loss) == (alone[0], pieces.NONE if alone[2] is None else alone[2])
        assert own.tolist() == alone[1] and fits == (lattice.decode(alone[1], whole=False) == word.replace(pieces.SPACE, " "))


def test_words_misled_by_a_hash_and_very_long_ones(lattice, monkeypatch):
    words = ["▁the", "▁nation", "漢é", "abab", "▁unbelievable"]
    plain = lattice.best_many(words)
    monkeypatch.setattr(lattice, "letters", np.zeros_like(lattice.letters))  # every piece looks misled
    assert all((a == b).all() for a, b in zip(plain, lattice.best_many(words)))
    monkeypatch.undo()
    texts = ["the nation and the rest", "a" * 300, "x y", None]
    whole = [pieces.Segmenter(lattice).nbest(t) for t in texts]
    monkeypatch.setattr(pieces, "LONG", 5)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    segmenter = pieces.Segmenter(lattice)
    for t, (ids, scores, changes) in zip(texts * 2, whole * 2):
        own = segmenter.nbest(t)
        assert own[0].tolist() == ids.tolist() and own[1] == scores and own[2] == changes


@pytest.mark.parametrize("text", ["to be or", "the the the", "a b", " x", "it is it"])
def test_the_best_of_a_text(lattice, text):
    words = pieces._words.findall((pieces.SPACE + text).replace(" ", pieces.SPACE))
    sums = sorted((sum(p[0] for p in c) / pieces.UNIT for c in itertools.product(*[all_segmentations(lattice, w)[:6] for w in words])), reverse=True)
    ids, scores, changes = pieces.Segmenter(lattice, 5).best(text)
    assert scores == pytest.approx(sums[:5]) and changes[0] == []
    assert lattice.decode(ids.tolist()) == text
    for change in changes[1:]:
        again = [lattice.search(w, 1)[0][1] for w in words]
        for k, other in change:
            again[k] = other
        assert lattice.decode([i for w in again for i in w]) == text


def test_pieces_never_cross_the_start_of_a_run_of_spaces(lattice):
    assert all(pieces.SPACE not in p.lstrip(pieces.SPACE) for p in lattice.pieces)


def test_every_text_comes_back(spark):
    texts = strange(3) + [t for _, t in ODD] + [" ", "  lead", "trail  ", "a▁b"]
    found = {r.doc_id: r for r in pieces.segmented(spark.createDataFrame(list(enumerate(texts)), SCHEMA), PIECES).collect()}
    for k, text in enumerate(texts):
        assert found[k].decoded == ("▁" not in (text or ""))
        assert found[k].scores == sorted(found[k].scores, reverse=True) and 1 <= len(found[k].scores) <= pieces.BEST
        assert bool(found[k].ids) == bool(text)


def test_a_long_word_without_spaces(lattice):
    scores = [s for s, _ in lattice.search("ab" * 20_000, 3)]
    assert len(scores) == 3 and scores == sorted(scores, reverse=True)


def test_odd_tables(spark):
    for run in (lambda d: token_counts.count_tokens(d, BPE), lambda d: pieces.segmented(d, PIECES), lambda d: pieces.digests(d, PIECES)):
        assert run(odd(spark, extra=True)).count() == len(ODD)
        assert run(odd(spark).limit(0)).collect() == []


def test_the_n_segmentations_are_in_the_result(spark, lattice):
    texts = ["nationality of things", "a", "", "zxqv unbelievable  words\nand 漢字", "x y x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {r.doc_id: r for r in pieces.segmented(docs, PIECES).collect()}
    digest = {r.doc_id: r for r in pieces.digests(docs, PIECES).collect()}
    for k, text in enumerate(texts):
        row = found[k]
        own = [pieces.changed(np.array(row.ids, np.int32), [(c.first, c.n_old, c.ids) for c in changes]) for changes in row.nbest]
        assert [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in own] == digest[k].nbest_sha256
        assert own[0].tolist() == row.ids and len({tuple(x) for x in own}) == len(own) == len(row.scores)
        assert all(lattice.decode(x.tolist()) == text for x in own)
        if text:
            words = pieces._words.findall((pieces.SPACE + text).replace(" ", pieces.SPACE))
            every = {}
            for c in itertools.product(*[all_segmentations(lattice, w)[:6] for w in words]):
                every[tuple(i for p in c for i in p[1])] = sum(p[0] for p in c) / pieces.UNIT
            assert [every[tuple(x)] for x in own] == row.scores == sorted(every.values(), reverse=True)[: pieces.BEST]

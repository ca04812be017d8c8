"""N-best piece segmentation: forward Viterbi scores guide a backward A-star search through the lattice of pieces.

Pieces never reach over the start of a run of spaces, so the lattice of a text is that of its words in a row. Arrays
of Viterbi scores from both ends give each distinct word's best and what its second best loses; the best segmentations
of a whole text differ from its best in the few words that lose least, and only these are searched.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns, long

SPACE = "▁"
BEST = 4
#: Words that a worker remembers; beyond it the memory starts anew. Words of more letters than ``LONG`` are searched alone.
REMEMBERED, LONG = 400_000, 1000
#: Scores are whole multiples of this part of one, so that sums are exact and equal paths are equal.
UNIT = 1 << 32
#: What a byte of a letter without a piece costs below the rarest piece.
BYTE_COST = 10.0

_words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


BASE = 0x9E3779B97F4A7C15
LOWEST = -(1 << 62)
NONE = 1 << 62


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Lattice:
    """Pieces of a sentencepiece model with their log-probabilities.

    A unigram model's scores are taken as they are. A merge model has only ranks, so its pieces get the
    probabilities of Zipf's law by rank.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.texts = [model.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scores = {i: model.get_score(i) for i in plain}
        self.bytes = {int(self.texts[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        if all(s == round(s) for s in scores.values()):
            ranked = sorted(plain, key=lambda i: (-scores[i], i))
            norm = math.log(sum(1 / (k + 1) for k in range(len(ranked))))
            scores = {i: -math.log(k + 1) - norm for k, i in enumerate(ranked)}
        self.pieces = {self.texts[i]: (i, round(s * UNIT)) for i, s in scores.items()}
        self.longest = max(map(len, self.pieces), default=1)
        self.begun = {text[:k] for text in self.pieces for k in range(1, len(text) + 1)}
        table = sorted((_hash(text), *self.pieces.get(text, (-1, 0))) for text in self.begun)
        self.hashes = np.array([h for h, _, _ in table], np.uint64)
        self.ids_at, self.scores_at = np.array([i for _, i, _ in table], np.int64), np.array([s for _, _, s in table], np.int64)
        self.byte_score = round((min(scores.values(), default=0.0) - BYTE_COST) * UNIT)
        self.letters = np.frombuffer("".join(self.texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.letters_at = np.cumsum([0, *map(len, self.texts)])

    def arcs(self, word: str) -> list[tuple[int, int, tuple[int, ...], int]]:
        """The pieces in a word by start: start, end, ids (several for bytes) and score in units. Every letter has its piece or its bytes."""
        out, pieces, begun = [], self.pieces, self.begun
        for start in range(len(word)):
            end = start + 1
            while end <= len(word) and (part := word[start:end]) in begun:
                if (found := pieces.get(part)) is not None:
                    out.append((start, end, (found[0],), found[1]))
                end += 1
            if word[start] not in pieces:
                raw = word[start].encode("utf-8", "surrogatepass")
                out.append((start, start + 1, tuple(self.bytes.get(b, self.unknown) for b in raw), self.byte_score * len(raw)))
        return out

    def edges(self, word: str) -> list[list[tuple[int, tuple[int, ...], int]]]:
        """The same by end."""
        out: list[list] = [[] for _ in range(len(word) + 1)]
        for start, end, ids, score in self.arcs(word):
            out[end].append((start, ids, score))
        return out

    def best(self, word: str) -> tuple[int, list[int], int | None]:
        """Best score in units, its ids, and what the second best loses (None without one).

        The second best path has a piece that the best has not, and is the best one through that piece, so
        the scores from both ends give it without a search.
        """
        arcs, n = self.arcs(word), len(word)
        ahead: list = [0] + [None] * n
        via: list = [None] * (n + 1)
        for arc in arcs:
            start, end, _, score = arc
            total = ahead[start] + score
            if ahead[end] is None or total > ahead[end]:
                ahead[end], via[end] = total, arc
        behind: list = [None] * n + [0]
        for start, end, _, score in reversed(arcs):
            total = behind[end] + score
            if behind[start] is None or total > behind[start]:
                behind[start] = total
        path, at = [], n
        while at:
            path.append(via[at])
            at = via[at][0]
        own = {id(arc) for arc in path}
        second = max((ahead[arc[0]] + arc[3] + behind[arc[1]] for arc in arcs if id(arc) not in own), default=None)
        return ahead[n], [i for arc in reversed(path) for i in arc[2]], None if second is None else ahead[n] - second

    def best_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``best`` of many words at once: scores, losses of the second best (``NONE`` without one), ids of all words in a row,
        their number for each word, and whether they decode to the word. All letters are in one array, arcs by start in step.

        Parts are looked up by hash; each path's pieces are held against the letters, and words that were misled by a hash are done alone.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        word = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        offset = np.arange(len(letters)) - first[word]
        left = sizes[word] - offset
        # parts grow letter by letter while some piece begins with them
        alive, h, found, lone = np.arange(len(letters)), np.zeros(len(letters), np.uint64), [], np.ones(len(letters), bool)
        for size in range(1, self.longest + 1):
            keep = left[alive] >= size
            alive, h = alive[keep], h[keep]
            h = h * np.uint64(BASE) + letters[alive + size - 1] + np.uint64(1)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            keep = self.hashes[at] == h
            alive, h, at = alive[keep], h[keep], at[keep]
            piece = self.ids_at[at] >= 0
            found.append((alive[piece], np.full(int(piece.sum()), size), at[piece]))
            if size == 1:
                lone[alive[piece]] = False
            if not len(alive):
                break
        spare = np.flatnonzero(lone)  # letters without a piece
        begin = np.concatenate([*(f[0] for f in found), spare])
        size = np.concatenate([*(f[1] for f in found), np.ones(len(spare), np.int64)])
        at = np.concatenate([*(f[2] for f in found), np.full(len(spare), -1)])
        bytes_of = np.where(letters[spare] < 0x80, 1, np.where(letters[spare] < 0x800, 2, np.where(letters[spare] < 0x10000, 3, 4)))
        score = self.scores_at[at]
        score[len(at) - len(spare) :] = self.byte_score * bytes_of
        order = np.lexsort((size, begin, offset[begin]))
        begin, size, at, score = begin[order], size[order], at[order], score[order]
        step = np.searchsorted(offset[begin], np.arange(int(sizes.max(initial=0)) + 1))
        start = begin + word[begin]  # a node before each letter and one after each word
        end = start + size
        nodes = len(letters) + len(words)
        ahead, behind, via = np.full(nodes, LOWEST), np.full(nodes, LOWEST), np.zeros(nodes, np.int64)
        heads = first + np.arange(len(words))
        tails = heads + sizes
        ahead[heads], behind[tails] = 0, 0
        for a, b in zip(step, step[1:]):
            total = ahead[start[a:b]] + score[a:b]
            better = np.flatnonzero(total > ahead[end[a:b]])
            ahead[end[a:b][better]], via[end[a:b][better]] = total[better], a + better
        for a, b in zip(step[-2::-1], step[:0:-1]):
            if b > a:
                own = start[a:b]
                cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                behind[own[cut]] = np.maximum.reduceat(behind[end[a:b]] + score[a:b], cut)
        on_path, now = np.zeros(len(begin), bool), tails[sizes > 0]
        while len(now):
            arc = via[now]
            on_path[arc] = True
            now = start[arc]
            now = now[now > heads[word[begin[arc]]]]
        second = np.full(len(words), LOWEST)
        rest = ~on_path
        np.maximum.at(second, word[begin[rest]], (ahead[start] + score + behind[end])[rest])
        path = np.flatnonzero(on_path)
        path = path[np.argsort(begin[path], kind="stable")]
        ids, width = np.where(at[path] >= 0, self.ids_at[at[path]], -1), size[path]
        # the pieces' letters against the words'; a letter of its own bytes is right by itself
        plain = np.flatnonzero(ids >= 0)
        length = width[plain]
        step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        wrong = self.letters[np.repeat(self.letters_at[ids[plain]], length) + step] != letters[np.repeat(begin[path][plain], length) + step]
        misled = set(word[begin[path][plain]][np.repeat(np.arange(len(plain)), length)[wrong]].tolist())
        # letters without a piece become their bytes' ids
        count = np.ones(len(ids), np.int64)
        lone_at = np.flatnonzero(ids < 0)
        raws = [chr(c).encode("utf-8", "surrogatepass") for c in letters[begin[path][lone_at]].tolist()]
        count[lone_at] = [len(r) for r in raws]
        out = np.repeat(ids, count).astype(np.int32)
        if raws:
            out[out < 0] = [self.bytes.get(b, self.unknown) for r in raws for b in r]
        number = np.bincount(word[begin[path]], count, len(words)).astype(np.int64)
        total = ahead[tails]
        loss = np.where(second > LOWEST // 2, total - second, NONE)
        right = np.ones(len(words), bool)
        for k in set(word[begin[path][lone_at]].tolist()) - misled:
            stop = int(number[: k + 1].sum())
            right[k] = self.decode(out[stop - int(number[k]) : stop].tolist(), whole=False) == words[k].replace(SPACE, " ")
        if misled:
            parts = np.split(out, np.cumsum(number)[:-1])
            for k in misled:
                total[k], own, gap = self.best(words[k])
                parts[k], loss[k] = np.array(own, np.int32), NONE if gap is None else gap
                number[k], right[k] = len(own), self.decode(own, whole=False) == words[k].replace(SPACE, " ")
            out = np.concatenate(parts)
        return total, loss, out, number, right

    def search(self, word: str, n: int = BEST) -> list[tuple[int, list[int]]]:
        """The ``n`` best segmentations (all, if there are fewer) with their scores in units, best first.

        The forward pass gives the best score from the start to each place, which is exactly what a path
        that was built backwards still gains, so paths come off the heap in order. Of equal paths the one further on
        goes first, then the one found first.
        """
        edges = self.edges(word)
        ahead = [0]
        for end in range(1, len(word) + 1):  # every letter has its piece or its bytes, so every place is reached
            ahead.append(max(ahead[start] + s for start, _, s in edges[end]))
        heap, out, made = [(-ahead[-1], len(word), 0, 0, None)], [], 0
        while heap and len(out) < n:
            _, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((behind, ids))
                continue
            for start, ids_, s in edges[at]:
                made += 1
                heapq.heappush(heap, (-(behind + s + ahead[start]), start, made, behind + s, (ids_, path)))
        return out

    def decode(self, ids: list[int], whole: bool = True) -> str:
        """Text of pieces: bytes joined to letters, space marks turned to spaces, the one put before a ``whole`` text taken off."""
        parts, raw = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            parts.append(self.texts[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts).replace(SPACE, " ")[1 if whole else 0 :]


class Segmenter:
    """Whole texts over a lattice. The words seen so far are slots of arrays, so that a text is its words' slots."""

    def __init__(self, lattice: Lattice, n: int = BEST):
        self.lattice, self.n = lattice, n
        self._forget()

    def _forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.found: dict[str, list[tuple[int, list[int]]]] = {}
        self.scores, self.losses, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.begin, self.number, self.right = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        """Search new words together; very long ones alone."""
        short, long_ = [w for w in words if len(w) <= LONG], [w for w in words if len(w) > LONG]
        parts = [self.lattice.best_many(short)] if short else []
        for w in long_:
            score, ids, gap = self.lattice.best(w)
            right = self.lattice.decode(ids, whole=False) == w.replace(SPACE, " ")
            parts.append(tuple(np.array(x, t) for x, t in (([score], np.int64), ([NONE if gap is None else gap], np.int64), (ids, np.int32), ([len(ids)], np.int64), ([right], bool))))
        for score, loss, ids, number, right in parts:
            self.begin = np.concatenate([self.begin, np.cumsum(number) - number + len(self.ids)])
            self.scores, self.losses, self.ids = np.concatenate([self.scores, score]), np.concatenate([self.losses, loss]), np.concatenate([self.ids, ids])
            self.number, self.right = np.concatenate([self.number, number]), np.concatenate([self.right, right])
        self.memory.update(zip(short + long_, range(len(self.memory), len(self.scores))))

    def split(self, texts: list[str | None]) -> list[np.ndarray]:
        """The slots of each text's words; new words of all of them are searched together."""
        words = [_words.findall((SPACE + t).replace(" ", SPACE)) if t else [] for t in texts]
        new = set().union(*words)
        if len(self.memory) + len(new) > REMEMBERED or len(self.ids) > 16 * REMEMBERED:
            self._forget()
        if new := new.difference(self.memory):
            self._learn(list(new))
        slot = self.memory.__getitem__
        return [np.fromiter(map(slot, own), np.int64, len(own)) for own in words]

    def ids_of(self, slots: np.ndarray) -> np.ndarray:
        number = self.number[slots]
        return self.ids[np.repeat(self.begin[slots] - np.cumsum(number) + number, number) + np.arange(int(number.sum()))]

    def decodes(self, text: str | None, slots: np.ndarray) -> bool:
        """Whether the best ids decode to the text: each word's do, and it has no space marks of its own, which read as spaces."""
        return SPACE not in (text or "") and bool(self.right[slots].all())

    def _others(self, word: str) -> list[tuple[int, list[int]]]:
        if word not in self.found:
            self.found[word] = self.lattice.search(word, self.n)
        return self.found[word]

    def best(self, text: str) -> tuple[np.ndarray, list[float], list[list[tuple[int, list[int]]]]]:
        """Piece ids of the best segmentation, scores of the ``n`` best, and for each what it changes: (word, ids)."""
        slots = self.split([text])[0]
        scores, changes = self._best(text, slots)
        return self.ids_of(slots), scores, changes

    def nbest(self, text: str | None, slots: np.ndarray | None = None) -> tuple[np.ndarray, list[float], list[list[tuple[int, int, list[int]]]]]:
        """The same with changes as (first, n_old, ids): the ids that stand for ``n_old`` ids of the best from place ``first`` on, by place."""
        slots = self.split([text])[0] if slots is None else slots
        scores, changes = self._best(text, slots)
        ends = np.cumsum(self.number[slots]).tolist() if any(changes) else []
        number = self.number
        return self.ids_of(slots), scores, [[(ends[k] - int(number[slots[k]]), int(number[slots[k]]), new) for k, new in sorted(c)] for c in changes]

    def _nearest(self, slots: np.ndarray) -> list[int]:
        """Places of the words whose second best loses least, by loss, then place."""
        losses, n = self.losses[slots], self.n - 1
        if len(losses) > n > 0:
            at = np.flatnonzero(losses <= np.partition(losses, n - 1)[n - 1])
            at = at[np.argsort(losses[at], kind="stable")][:n]
        else:
            at = np.argsort(losses, kind="stable")[:n]
        return at[losses[at] < NONE].tolist()

    def _best(self, text: str | None, slots: np.ndarray) -> tuple[list[float], list[list[tuple[int, list[int]]]]]:
        if not text:
            return [0.0], [[]]
        own = self.scores[slots]
        total = sum(int(own[a : a + (1 << 20)].sum()) for a in range(0, len(own), 1 << 20))
        near = self._nearest(slots)
        # a segmentation among the best changes only words among those that lose least, and these are searched
        words = _words.findall((SPACE + text).replace(" ", SPACE)) if near else []
        combos: list[tuple[int, list]] = [(0, [])]
        for k in near:
            own_ids = self.ids_of(slots[k : k + 1]).tolist()
            others = [(int(own[k]) - s, [(k, ids)]) for s, ids in self._others(words[k]) if ids != own_ids]
            options = [(0, []), *others[: self.n - 1]]
            combos = heapq.nsmallest(self.n, [(loss + more, changes + change) for loss, changes in combos for more, change in options], key=lambda x: x[0])
        return [(total - loss) / UNIT for loss, _ in combos], [changes for _, changes in combos]


def changed(ids: np.ndarray, changes: list[tuple[int, int, list[int]]]) -> np.ndarray:
    """The ids of a segmentation from those of the best and its changes."""
    parts, at = [], 0
    for first, n_old, new in changes:
        parts += [ids[at:first], np.array(new, np.int32)]
        at = first + n_old
    return np.concatenate([*parts, ids[at:]]) if parts else ids


_segmenters: dict[tuple[str, int], Segmenter] = {}


def _segmenter(model: str, n: int) -> Segmenter:
    """One for each worker process, so that the next task finds the words of the last."""
    import public_tokenizers

    if (model, n) not in _segmenters:
        _segmenters[model, n] = Segmenter(Lattice(public_tokenizers.path(model)), n)
    return _segmenters[model, n]


CHANGE = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("n_old", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def segmented(docs: DataFrame, model: str, n: int = BEST) -> DataFrame:
    """(doc_id, ids, scores, decoded, nbest) of each row: the best ids, the ``n`` best scores, whether decoding gives the text back, and the ``n`` best segmentations.

    A segmentation is its changes against the best, by place: ``ids`` stand for ``n_old`` of the best's ids from ``first`` on
    (from 0); the best itself has none.
    Null counts as empty: no ids, one score of zero. Every text comes back but one with space marks (U+2581) of its own,
    which read as spaces. Rows repeat as given; an empty table gives none; other columns are not read.
    ``model`` is the name of a file of public_tokenizers, read on each executor.
    """
    def make():
        segmenter = _segmenter(model, n)

        def compute(texts):
            slots = segmenter.split(texts)
            found = [segmenter.nbest(t, own) for t, own in zip(texts, slots)]
            lists = [x[0].tolist() for x in found]
            nbest = [[[dict(zip(("first", "n_old", "ids"), c)) for c in changes] for changes in x[2]] for x in found]
            return [lists, [x[1] for x in found], [segmenter.decodes(t, own) for t, own in zip(texts, slots)], nbest]

        return compute

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("decoded", T.BooleanType()), T.StructField("nbest", T.ArrayType(T.ArrayType(CHANGE)))]
    return arrow_columns(docs.select("doc_id", "text"), "text", fields, make)


def digests(docs: DataFrame, model: str, n: int = BEST) -> DataFrame:
    """The same with the ids as their number and the sha256 of their 32-bit little-endian bytes, for the best and for each of the ``n`` best."""
    def make():
        segmenter = _segmenter(model, n)

        def compute(texts):
            out = []
            for t, own in zip(texts, segmenter.split(texts)):
                ids, scores, changes = segmenter.nbest(t, own)
                shas = [hashlib.sha256(changed(ids, c).astype("<i4").tobytes()).hexdigest() for c in changes]
                out.append((len((t or "").encode()), len(ids), shas[0], scores[0], scores, segmenter.decodes(t, own), shas))
            return [list(x) for x in zip(*out)] or [[]] * 7

        return compute

    fields = [long("n_bytes"), long("n_pieces"), T.StructField("ids_sha256", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("nbest_scores", T.ArrayType(T.DoubleType())), T.StructField("decoded", T.BooleanType()), T.StructField("nbest_sha256", T.ArrayType(T.StringType()))]
    return arrow_columns(docs.select("doc_id", "text"), "text", fields, make)

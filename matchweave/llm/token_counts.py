"""Token counts by rank-synchronous merging: all distinct pre-tokens of a batch are merged at once in numpy arrays."""

from __future__ import annotations

import json
import sys

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns, long

LIMIT = 1024
#: Counts that a worker remembers for pre-tokens of up to ``SHORT`` bytes; beyond it the memory starts anew.
REMEMBERED, SHORT = 400_000, 64
#: Pre-tokens longer than this are counted alone with a heap, whose work is not their length times their merges.
LONG = 2048
#: Symbols merged at a time.
CHUNK = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merger:
    """Merge ranks and the splitting rules of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or model.get("dropout") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE file")
        self.vocab = model["vocab"]
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = self.vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(self.vocab.values()) + 1
        codes = np.array([self.vocab[a] * self.size + self.vocab[b] for a, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order.astype(np.int64), made
        self.whole = {bytes(letters[c] for c in token) for token in self.vocab if all(c in letters for c in token)} if model.get("ignore_merges") else set()
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        self.prefix = _splitting(spec["pre_tokenizer"])
        self.plain, self.older, self.newer = splitting_patterns()
        self.table: dict[tuple[int, int], tuple[int, int]] | None = None

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """The pieces that are merged apart from each other, and how many special tokens stand between them."""
        parts, specials = [text], 0
        if self.special is not None and (found := self.special.findall(text)):
            parts, specials = self.special.split(text), len(found)
        pieces: list[str] = []
        pattern = self.plain if text.isascii() or not self.newer.search(text) else self.older
        for part in parts:
            if part:
                pieces += pattern.findall(" " + part if self.prefix and not part[0].isspace() else part)
        return pieces, specials

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (a large number if there is no merge), and its place."""
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], np.iinfo(np.int64).max), at

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of each token once no pair can be merged."""
        out = np.empty(len(tokens), np.int64)
        short = [k for k, t in enumerate(tokens) if len(t) <= LONG]
        for k, t in enumerate(tokens):
            if len(t) > LONG:
                out[k] = self.count_long(t)
        done = 0
        while done < len(short):
            stop, total = done, 0
            while stop < len(short) and (stop == done or total + len(tokens[short[stop]]) <= CHUNK):
                total += len(tokens[short[stop]])
                stop += 1
            own = short[done:stop]
            out[own] = self.merged([tokens[k] for k in own])
            done = stop
        return out

    def merged(self, tokens: list[bytes]) -> np.ndarray:
        """All tokens in one ragged array. Each round finds the lowest rank of every token and applies that
        pair wherever the token has it, from the left; pairs are looked up again only beside a merge."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        none = np.iinfo(np.int64).max
        rank = np.full(len(symbols), none)  # of the pair that starts here
        if len(symbols) > 1:
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.lookup(symbols[same], symbols[same + 1])[0]
        result = sizes.copy()
        while True:
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
            if not len(starts):
                return result
            lengths = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(rank, starts)
            result[owner[starts]] = lengths
            alive = lowest < none
            if not alive.all():  # finished tokens leave the arrays
                keep = np.repeat(alive, lengths)
                symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
                lowest, lengths = lowest[alive], lengths[alive]
                if not len(owner):
                    return result
            hit = rank == np.repeat(lowest, lengths)
            # of overlapping pairs (aaa) every second one counts, from the left of its run
            at = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(at) != 1))
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[place % 2 == 0]
            symbols[at] = self.made[rank[at]]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            near = np.zeros(len(symbols), bool)
            near[at] = True
            keep = ~gone
            symbols, owner, rank, near = symbols[keep], owner[keep], rank[keep], near[keep]
            touched = near.copy()
            touched[:-1] |= near[1:]
            again = np.flatnonzero(touched)
            rank[again] = none
            again = again[again + 1 < len(symbols)]
            again = again[owner[again] == owner[again + 1]]
            rank[again] = self.lookup(symbols[again], symbols[again + 1])[0]

    def count_long(self, token: bytes) -> int:
        """The same for one very long token, by a heap of pairs over a linked list."""
        import heapq

        if self.table is None:
            self.table = {divmod(int(c), self.size): (int(r), int(self.made[r])) for c, r in zip(self.codes, self.ranks)}
        symbols = self.first[np.frombuffer(token, np.uint8)].tolist()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap = [(self.table[p][0], k, p) for k, p in enumerate(zip(symbols, symbols[1:])) if p in self.table]
        heapq.heapify(heap)
        left = len(symbols)
        while heap:
            _, k, pair = heapq.heappop(heap)
            nxt = after[k] if symbols[k] is not None else len(symbols)
            if nxt >= len(symbols) or (symbols[k], symbols[nxt]) != pair:
                continue
            symbols[k], symbols[nxt] = self.table[pair][1], None
            left -= 1
            after[k] = after[nxt]
            if after[k] < len(symbols):
                before[after[k]] = k
                if (p := (symbols[k], symbols[after[k]])) in self.table:
                    heapq.heappush(heap, (self.table[p][0], k, p))
            if before[k] >= 0 and (p := (symbols[before[k]], symbols[k])) in self.table:
                heapq.heappush(heap, (self.table[p][0], before[k], p))
        return left


_patterns: tuple | None = None


def newer_letters() -> list[int]:
    """Letters and numbers of ``regex`` that the library's own tables do not have, since it knows an older version of Unicode.

    Its splitter is asked once: between a letter and a number a code point goes with the one that it is like.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    known = regex.compile(r"[\p{L}\p{N}]")
    asked = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and known.match(chr(c))]
    found = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"a{chr(c)}1\n" for c in asked))
    ends = {end for _, (_, end) in found}
    return [c for n, c in enumerate(asked) if 4 * n + 1 in ends and 4 * n + 2 in ends]


def splitting_patterns() -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """The published pattern, the same with the library's letters and numbers, and what finds a text that needs the second."""
    global _patterns
    if _patterns is None:
        import public_tokenizers

        pattern, newer = public_tokenizers.PATTERN, newer_letters()
        runs: list[list[int]] = []
        for c in newer:
            if runs and c == runs[-1][1] + 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        out = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
        older = pattern
        for kind in (r"\p{L}", r"\p{N}"):
            older = older.replace(kind, f"[{kind}--[{out}]]") if newer else older
        _patterns = regex.compile(pattern), regex.compile(older, regex.V1), regex.compile(f"[{out}]" if newer else r"(?!)")
    return _patterns


def _splitting(spec: dict) -> bool:
    """Whether a space is put first; the pieces are those of the published pattern."""
    if spec["type"] != "ByteLevel" or not spec.get("use_regex", True):
        raise ValueError("only byte-level splitting is known")
    return bool(spec.get("add_prefix_space"))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs`` (doc_id, text), as the tokenizers library counts.

    Special strings inside texts are special tokens, as is that library's default; none are added. Null
    counts as empty: no bytes, no tokens. Repeated rows repeat, an empty table gives none; other columns are
    not read. ``vocabulary`` is the name of a file of public_tokenizers, read on each executor.
    """
    def make():
        import public_tokenizers

        merger, memory = Merger(public_tokenizers.path(vocabulary)), {}

        def compute(texts: list) -> list:
            nonlocal memory
            split = [merger.pretokens(t or "") for t in texts]
            new = {p for pieces, _ in split for p in pieces}.difference(memory)
            tokens = list(new)
            found = merger.counts([t.encode() for t in tokens]).tolist()
            own = dict(zip(tokens, found))
            total = [s + sum([memory[p] if p in memory else own[p] for p in pieces]) for pieces, s in split]
            short = {t: n for t, n in own.items() if len(t) <= SHORT}
            if len(memory) + len(short) > REMEMBERED:
                memory = short
            else:
                memory.update(short)
            return [[len((t or "").encode()) for t in texts], total]

        return compute

    made = arrow_columns(docs.select("doc_id", "text"), "text", [long("n_bytes"), long("n_tokens")], make)
    return made.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))

"""Personal data: fixed forms first, then identifiers that stand where known ones stand.

The fixed forms are seeds. What is written around them makes lexical patterns; Spark scores patterns by the
share of known identifiers among what they surround, and candidates by their patterns, in a few rounds over the
graph of the two. Candidates of confident patterns are found identifiers, wherever they occur.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns
from matchweave.session import stage

#: The base forms, in the order of their places, and forms that are seeds besides them.
KINDS, MORE = ["email", "ip", "card", "phone"], ["secret"]
#: Names of places: base forms, what stands like them, the other forms, and what stands like those.
NAMES = [*KINDS, *(f"like_{k}" for k in KINDS), *MORE, *(f"like_{k}" for k in MORE)]
#: Different known identifiers a pattern must surround, the share of them it needs, and the score a candidate needs.
SUPPORT, CONFIDENT, ACCEPTED = 5, 0.9, 0.95
#: Strings up to this length are keys as they are, longer ones by their sha256.
KEY = 64

_mark = re.compile(r"[0-9@]")
_blank = re.compile(r"\s")
#: Taken off the ends of a stretch: punctuation, but for a bracket that opens a number.
_trim = ".,;:!?\"'[]{}<>|"
_digit = re.compile(r"[0-9]")
_local = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: The run of digits is taken whole, so that a long one is read once and not once from each digit.
_ip = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Keys and tokens: as many hexadecimal digits as common digests have, with letters and numbers among them.
_secret = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32}|[0-9A-F]{32}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{64}|[0-9A-F]{64})(?![0-9A-Za-z])")
_letter = re.compile(r"[A-Fa-f]")
_edge = ".,;:!?\"'()[]{}<>|"


def emails(text: str) -> list[tuple[int, int]]:
    """Addresses, found from their @ outwards: a local part reaches as far back as its letters do."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _local:
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed forms, by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    if _digit.search(text):
        for m in _ip.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _card.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _phone.finditer(text):
                if 10 <= sum(map(str.isdecimal, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _key(text: str) -> str:
    return text if len(text) <= KEY else "sha256:" + hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _folded(words: list[str]) -> str:
    return " ".join(_key(_digit.sub("0", w.lower())) for w in words)


def _before(text: str, end: int, n: int, floor: int = 0) -> list[str]:
    """The last ``n`` whole words before a place, not from before ``floor``, without punctuation next to it."""
    width = 48
    while True:
        low = max(floor, end - width)
        words = text[low:end].rstrip(_edge + " \t\n\r\f\v").split()
        if len(words) > n or low == floor:  # the first one may be cut, so one more is looked at
            return words[-n:]
        width *= 2


def _after(text: str, start: int, ceiling: int | None = None) -> list[str]:
    width, ceiling = 48, len(text) if ceiling is None else ceiling
    while True:
        high = min(ceiling, start + width)
        words = text[start:high].lstrip(_edge).split()
        if len(words) > 1 or high == ceiling:
            return words[:1]
        width *= 2


def patterns(text: str, start: int, end: int, floor: int = 0, ceiling: int | None = None) -> list[str]:
    """Contexts of a place: the two words before, and the word before with the word after."""
    left, right = _before(text, start, 2, floor), _after(text, end, ceiling)
    out = []
    if len(left) == 2:
        out.append("2 " + _folded(left))
    if left and right:
        out.append("1 " + _folded(left[-1:]) + " _ " + _folded(right))
    return out


def secrets(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    found = [m.span() for m in _secret.finditer(text) if _digit.search(m[0]) and _letter.search(m[0])] if len(text) >= 32 else []
    return [(a, b) for a, b in found if not any(x < b and a < y for x, _, y in base)] if found and base else found


def runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches of neighbouring words with a digit or @ on one line, without those that ``taken`` places touch, and without punctuation at the ends."""
    words: list[tuple[int, int]] = []
    at, k, done = 0, 0, 0
    while (m := _mark.search(text, at)) is not None:
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        stop = m.end()
        gap = _blank.search(text, stop)
        stop = gap.start() if gap else len(text)
        at = done = stop
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < stop:
            continue
        between = text[words[-1][1] : start] if words else "x"
        if between.isspace() and "\n" not in between:
            words[-1] = (words[-1][0], stop)
        else:
            words.append((start, stop))
    out = []
    for a, b in words:
        inner = text[a:b]
        left, right = a + len(inner) - len(inner.lstrip(_trim)), a + len(inner.rstrip(_trim))
        if left < right:
            out.append((left, right))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds, and stretches of words with a digit or @ that no seed touches: their string, kind (None if unknown), place and patterns."""
    if not (_mark.search(text) or base):
        return []
    more = secrets(text, base)
    seeds = [(a, b, KINDS[k]) for a, k, b in base] + [(a, b, "secret") for a, b in more]
    taken: list[tuple[int, int]] = []
    for a, b, _ in sorted(seeds):  # places that overlap are one
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], b))
        else:
            taken.append((a, b))
    found = sorted(seeds + [(a, b, None) for a, b in runs(text, taken)], key=lambda x: x[:2])
    # a place's context reaches over two others at most, so that a long word full of places is not read once for each of them
    floors = [0] * 3 + [b for _, b, _ in found]
    ceilings = [a for a, _, _ in found[3:]] + [len(text)] * 3
    return [
        {"instance": _key(text[a:b].lower()), "kind": kind, "start": a, "end": b, "patterns": patterns(text, a, b, min(floors[k], a), max(ceilings[k], b))}
        for k, (a, b, kind) in enumerate(found)
    ]


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("place", T.IntegerType()), T.StructField("end", T.IntegerType())])
CANDIDATE = T.StructType([T.StructField("instance", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("patterns", T.ArrayType(T.StringType()))])


def extracted(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, candidates) of each row."""
    def make():
        def compute(texts):
            base = [base_spans(t or "") for t in texts]
            found = [candidates(t or "", b) for t, b in zip(texts, base)]
            return [[[{"start": a, "place": k, "end": e} for a, k, e in b] for b in base], found]

        return compute

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return arrow_columns(keyed, "text", [T.StructField("base", T.ArrayType(SPAN)), T.StructField("candidates", T.ArrayType(CANDIDATE))], make)


def discovered(places: DataFrame) -> DataFrame:
    """(instance, kind, score) of candidates that confident patterns surround, from ``places`` (instance, kind, patterns).

    The graph has each pair of pattern and instance once, whatever its number of places. Known
    instances keep their score of one, and what is accepted stays so; a pattern's score counts different instances. Rounds go on until one accepts nothing new.
    """
    kinds = KINDS + MORE
    edges = stage(places.select("instance", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = stage(places.where(F.col("kind").isNotNull()).groupBy("instance").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0)), "seeds")
    known, found = seeds, seeds.limit(0)
    accepted = 0
    while True:
        sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in kinds]
        scored = edges.join(known, "instance", "left").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums)
        best = F.greatest(*kinds)
        sure = scored.where((best >= SUPPORT) & (best >= CONFIDENT * F.col("n")))
        kind = F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in kinds])
        sure = sure.select("pattern", kind.alias("kind"), (best / F.col("n")).alias("confidence"))
        near = edges.join(sure, "pattern").join(known.select("instance"), "instance", "left_anti")
        total = near.groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(0.02)))))).alias("score"),
            F.max(F.struct("confidence", "kind"))["kind"].alias("kind"),
        )
        found = stage(found.unionByName(total.where(F.col("score") >= ACCEPTED).select("instance", "kind", "score")), "found")
        known = seeds.unionByName(found)
        if (now := found.count()) == accepted:
            return found
        accepted = now


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, text_hash, and spans: array of (start, place, end, kind) in code points, by start, then kind.

    The base forms have their kinds (place 0 to 3), identifiers found by pattern ``like_`` and the kind (4 to 7), keys and tokens ``secret`` (8) and what
    stands like them ``like_secret`` (9). Reads doc_id and text only; null counts as empty and has none; repeated rows repeat, but their places count
    once in the graph; an empty table gives none.
    """
    rows = stage(extracted(docs), "extracted")
    each = rows.where(F.size("candidates") > 0).select("doc_id", "text_hash", F.explode("candidates").alias("c")).select("doc_id", "text_hash", "c.*")
    found = discovered(each.select("instance", "kind", "patterns")).select("instance", F.col("kind").alias("found_kind"))
    place = F.coalesce(*[F.when(F.col("kind") == name.removeprefix("like_"), F.lit(n)) for n, name in enumerate(NAMES) if name.startswith("like_")])
    like = each.where(F.col("kind").isNull()).drop("kind").join(found.withColumnRenamed("found_kind", "kind"), "instance").select("doc_id", "text_hash", "start", place.alias("place"), "end")
    own = F.coalesce(*[F.when(F.col("kind") == k, F.lit(NAMES.index(k))) for k in MORE])
    other = each.where(F.col("kind").isin(MORE)).select("doc_id", "text_hash", "start", own.alias("place"), "end")
    new = like.union(other).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", F.col("place").cast("int").alias("place"), "end")).alias("more"))
    new = new.select(F.col("doc_id").alias("new_id"), F.col("text_hash").alias("new_hash"), "more")
    joined = rows.select("doc_id", "text_hash", "base").join(new, rows["doc_id"].eqNullSafe(new["new_id"]) & (rows["text_hash"] == new["new_hash"]), "left")
    names = F.array(*[F.lit(k) for k in NAMES])
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.expr("cast(array() as array<struct<start:int,place:int,end:int>>)"))))
    return joined.select("doc_id", "text_hash", F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), F.get(names, s["place"]).alias("kind"))).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of ``personal_data``."""
    base = F.filter("spans", lambda s: s["place"] < len(KINDS))
    places = F.transform("spans", lambda s: s["place"])
    counts = [F.size(F.filter(places, lambda p: p == F.lit(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def scrubbed(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle brackets, in all columns as before.

    Overlapping spans are replaced by the first one's kind. ``n_chars``, if there, follows the new text.
    """
    found = personal_data(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
    found = found.select(F.col("doc_id").alias("_found_id"), F.col("text_hash").alias("_found_hash"), F.col("spans").alias("_found_spans"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_found_id"]) & (F.xxhash64(docs["text"]) == found["_found_hash"]), "left")
    joined = joined.select(*docs.columns, "_found_spans")
    text, spans = joined.columns.index("text"), len(docs.columns)

    def run(batches):
        for batch in batches:
            out = []
            for t, own in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                if own:
                    parts, at = [], 0
                    for s in own:
                        if s["start"] >= at:
                            parts += [t[at : s["start"]], f"<{s['kind'].upper()}>"]
                        at = max(at, s["end"])
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == text else batch.column(i) for i in range(spans)], batch.schema.names[:spans])

    clean = joined.mapInArrow(run, docs.schema)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean

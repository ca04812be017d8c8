"""Rule ledger: every rule runs once and leaves a bit and its measurements; policies only read the bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.llm.common import let, words_of

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_caps_pairs"]

#: Rules as SQL over the measurements, true where the document fails. The place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("shouting", "4 * n_caps_pairs > word_chars"),
]
BASE = ["few_words", "repeated_words"]
#: Policies by version: the rules that a kept document must not fail.
POLICIES: dict[str, list[str]] = {"base": BASE, "v1": [*BASE, "symbols", "repeated_lines"], "v2": [name for name, _ in RULES]}


def mask(rules: list[str]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    Window hashes are sorted as plain numbers to find the repeated ones. A few are looked up in
    window order; with many, hashes are sorted together with their places, so that either way the work
    stays near-linear in the text.
    """
    def hashes(w: Column) -> Column:
        starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.expr("array()").cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def looked_up(h: Column, repeated: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(repeated, x), i)), lambda i: i.isNotNull())

    def sorted_out(h: Column) -> Column:
        same = lambda s, x, k: F.coalesce(F.get(s, k - 1)["x"] == x["x"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["x"] == x["x"], F.lit(False))
        places = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: same(s, x, k)), lambda x: x["i"]))
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), places)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def count(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: x == F.get(s, k - 1))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, F.lit(0).cast("long")).when(F.size(r) <= 16, let(looked_up(h, r), covered)).otherwise(let(sorted_out(h), covered)))

    return let(words, lambda w: let(hashes(w), count))


def measured(docs: DataFrame) -> DataFrame:
    """Measurements of each text: (doc_id, text's measures). Native, one pass, no shuffle. Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain, spaced = text, text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select("doc_id", text.alias("text"), words_of(spaced, " ").alias("words"), lines.alias("lines"))
    return first.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(plain)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        let(F.col("lines"), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z][A-Z]")).cast("long").alias("n_caps_pairs"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row for each document row: doc_id, the measurements and ``fail_bits``.

    Reads ``doc_id`` and ``text`` only, so other columns may have any name. Null and empty texts have
    no words and fail ``few_words``; repeated rows give repeated rows; an empty table gives none.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs).withColumn("fail_bits", total.cast("long"))


def apply_policy(marked: DataFrame, policy: str = "v2") -> DataFrame:
    """Adds ``base_failed`` and ``kept`` by bit masks alone; no rule runs again."""
    fails = lambda rules: F.col("fail_bits").bitwiseAND(F.lit(mask(rules))) != 0
    return marked.withColumns({"base_failed": fails(BASE), "kept": ~fails(BASE) & ~fails(POLICIES[policy])})


def ablation(marked: DataFrame, policy: str = "v2") -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without) of a policy: how many documents fail each rule, fail it alone, and would stay without it.

    One aggregation over the distinct bit patterns, at most two to the number of rules.
    """
    whole = mask(POLICIES[policy])
    patterns = marked.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit")) for name in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_only"),
        count((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("n_kept_without"),
    )

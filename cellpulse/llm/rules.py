"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule;
a policy is a versioned mask of rules, so applying another version, or asking what a rule alone removes,
reads the ledger and never the texts.

Only DataFrame functions are used. Lambdas never refer to an outer column: Catalyst would evaluate that
column once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six white space characters that separate words, and the symbols that are counted.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: Bit number of each rule; numbers are never used again for another rule.
RULES = {"few_words": 0, "repeated_words": 1, "symbols": 2, "repeated_lines": 3, "word_length": 4, "capitals": 5}

#: Rules of each policy version. "base" holds the two rules that every version holds.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "capitals"),
}


def mask(policy: str) -> int:
    return sum(1 << RULES[rule] for rule in POLICIES[policy])


def _window_hashes(words: Column) -> Column:
    """One hash per run of three words, in order; empty below three words."""
    n = F.size(words)
    later = [F.slice(words, F.lit(k + 1), F.greatest(n - k, F.lit(0))) for k in range(1, WINDOW)]
    zipped = F.arrays_zip(words.alias("a"), later[0].alias("b"), later[1].alias("c"))
    inside = F.slice(zipped, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    return F.transform(inside, lambda w: F.xxhash64(w["a"], w["b"], w["c"]))


def _next(array: Column, step: int, empty: Column) -> Column:
    """`array` moved by one place towards the front (step 1) or the back (step -1), same length."""
    n = F.size(array)
    if step == 1:
        return F.concat(F.slice(array, F.lit(2), F.greatest(n - 1, F.lit(0))), F.array(empty))
    return F.concat(F.array(empty), F.slice(array, F.lit(1), F.greatest(n - 1, F.lit(0))))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every document.

    A null text counts as empty: all measurements are zero. Repeated rows are measured each on their own.
    Other input columns are not read, so their names cannot clash.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id"), text.alias("t"))
    bare = F.translate("t", SPACES, "")
    first = base.select(
        "doc_id",
        F.array_remove(F.split("t", SPACE_PATTERN), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda line: F.translate(line, SPACES, "") != "").alias("lines"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
    )
    hashed = first.select(
        "doc_id", "word_chars", "n_symbols", "n_capitals",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("words")).alias("windows"),
    )
    ordered = hashed.select(
        *(c for c in hashed.columns if c != "windows"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("sorted"),
    )
    hashes = F.transform("sorted", lambda s: s["h"])
    none = F.lit(None).cast("bigint")
    around = ordered.select(
        *(c for c in ordered.columns if c != "sorted"),
        F.arrays_zip(
            F.col("sorted").alias("s"), _next(hashes, -1, none).alias("before"), _next(hashes, 1, none).alias("after")
        ).alias("around"),
    )
    found = F.filter(
        "around",
        lambda z: z["s"].isNotNull() & (z["s"]["h"].eqNullSafe(z["before"]) | z["s"]["h"].eqNullSafe(z["after"])),
    )
    starts = around.select(
        *(c for c in around.columns if c != "around"),
        F.sort_array(F.transform(found, lambda z: z["s"]["i"])).alias("starts"),
    )
    gaps = F.arrays_zip(
        F.col("starts").alias("here"), _next(F.col("starts"), 1, F.lit(None).cast("int")).alias("there")
    )
    covered = F.aggregate(
        gaps,
        F.lit(0).cast("long"),
        lambda total, g: total
        + F.when(g["here"].isNull(), 0)
        .when(g["there"].isNull(), WINDOW)
        .otherwise(F.least(F.lit(WINDOW), g["there"] - g["here"])),
    )
    return starts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_lines",
        "n_capitals",
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements of every document and `failed`, the bits of the rules that it fails.

    A null text has no words and is measured like an empty one; rows without an id and repeated rows have a row each; an
    empty table gives no rows.
    """
    words = F.col("n_words")
    fails = {
        "few_words": words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * words) | (F.col("word_chars") > 12 * words),
        "capitals": 10 * F.col("n_capitals") > 3 * F.col("word_chars"),
    }
    bits = F.lit(0).cast("long")
    for rule, bit in RULES.items():
        bits = bits.bitwiseOR(F.when(fails[rule], F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failed", bits)


def applied(book: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with `kept`: whether a document fails none of the rules of `policy`. An empty ledger stays empty."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(book: DataFrame) -> DataFrame:
    """For every policy and each of its rules: how many documents the policy keeps, and how many it would keep
    without the rule. One aggregation of the ledger; `failed` values are at most 2 to the number of rules."""
    counts = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rows = [
        F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"), F.lit(mask(policy)).cast("long").alias("mask"),
            F.lit(mask(policy) & ~(1 << RULES[rule])).cast("long").alias("without"),
        )
        for policy, rules in POLICIES.items()
        for rule in rules
    ]
    each = counts.select("failed", "n", F.explode(F.array(*rows)).alias("p")).select("failed", "n", "p.*")
    keeps = lambda m: F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(m) == 0, F.col("n"))), F.lit(0))
    return each.groupBy("policy", "rule").agg(
        keeps(F.col("mask")).alias("kept"), keeps(F.col("without")).alias("kept_without_rule")
    )

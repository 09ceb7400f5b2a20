"""Quality rules of documents, judged together with their hosts.

Built-in functions only: a document's figures are computed where it lies, inside
one row; nothing is exploded and no text is shuffled. Hosts are summed with
map-side partial sums, so a host with a third of all rows is no hot group, and
the verdicts come back by a broadcast of the refused hosts, or by a salted join
where these are too many for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from docindex.llm.common import BROADCAST_KEYS, SPACE, let, staged

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Further rules; by themselves they reject nothing, a refused host makes them count.
MAX_SYMBOLS_PER_WORD = 0.5
MAX_DUPLICATE_LINES_PER_WORD = 0.02
MIN_MEAN_WORD, MAX_MEAN_WORD = 2.0, 25.0
# A host whose shrunken failure rate is at least this is refused.
REFUSED_RATE = 0.5
# The prior's mean and variance come from hosts with so many documents.
PRIOR_DOCS = 5
PRIOR_STRENGTH = (1.0, 1000.0)
SALTS = 64

RULES = ("base_failed", "symbols_failed", "lines_failed", "length_failed")


def _twice(keyed: Column) -> Column:
    """The positions ``p`` of ``(k, p)`` structs whose ``k`` occurs more than once."""

    def among(s: Column) -> Column:
        beside = lambda x, j: (F.get(s, j - 1)["k"] == x["k"]) | (F.get(s, j + 1)["k"] == x["k"])
        return F.transform(F.filter(s, beside), lambda x: x["p"])

    return let(F.sort_array(keyed), among)


def _covered(starts: Column) -> Column:
    """How many words the windows at these positions cover together."""

    def among(s: Column) -> Column:
        own = F.transform(s, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    return let(F.sort_array(starts), among)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words found twice or more.

    Windows are compared by hash, and where hashes meet by their words.
    """

    def windows(hashed: Column) -> Column:
        of_window = lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)])
        return F.transform(F.sequence(F.lit(0), F.size(hashed) - WINDOW), of_window)

    def candidates(hashes: Column) -> Column:
        keyed = F.transform(hashes, lambda h, i: F.struct(h.alias("k"), i.alias("p")))
        none = F.array().cast("array<int>")
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(_twice(keyed))

    def exact(starts: Column) -> Column:
        texts = F.transform(starts, lambda p: F.struct(F.array_join(F.slice(words, p + 1, WINDOW), " ").alias("k"), p.alias("p")))
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(let(_twice(texts), _covered))

    found = let(let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), candidates), exact)
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(found)


def figures(text: Column) -> Column:
    """A struct of a text's counts; a NULL text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r")))
    duplicates = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    numbers = F.struct(
        of_words.alias("w"),
        F.length(F.regexp_replace(text, SPACE + "+", "")).alias("chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).alias("symbols"),
        duplicates.alias("lines"),
    )
    return let(
        numbers,
        lambda x: F.struct(
            x["w"]["n"].cast("bigint").alias("n_words"),
            x["chars"].cast("bigint").alias("word_chars"),
            x["symbols"].cast("bigint").alias("n_symbols"),
            x["lines"].cast("bigint").alias("n_dup_lines"),
            x["w"]["r"].cast("bigint").alias("n_repeat_words"),
        ),
    )


def failures(counted: DataFrame) -> DataFrame:
    """One boolean per rule. Rules of ratios do not fail a document without words."""
    n = F.col("n_words")
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n)
    return counted.select(
        "*",
        base.alias("base_failed"),
        (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n).alias("symbols_failed"),
        (F.col("n_dup_lines") > MAX_DUPLICATE_LINES_PER_WORD * n).alias("lines_failed"),
        ((n > 0) & ((mean < MIN_MEAN_WORD) | (mean > MAX_MEAN_WORD))).alias("length_failed"),
    )


def any_failed() -> Column:
    return F.greatest(*[F.col(r) for r in RULES])


def prior(hosts: DataFrame) -> tuple[float, float]:
    """The beta prior of the hosts' failure rates, by the method of moments."""
    rate = F.col("failed") / F.col("docs")
    row: Row = hosts.filter(F.col("docs") >= PRIOR_DOCS).agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread")
    ).first()
    mean = 0.5 if row.mean is None else row.mean
    low, high = PRIOR_STRENGTH
    strength = mean * (1 - mean) / row.spread - 1 if row.spread else high
    strength = min(max(strength, low), high)
    return mean * strength, (1 - mean) * strength


def host_verdicts(judged: DataFrame) -> DataFrame:
    """Per host: documents, failures of each rule, shrunken rate, refused or not."""
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(any_failed().cast("bigint")).alias("failed"),
        *[F.sum(F.col(r).cast("bigint")).alias(f"n_{r}") for r in RULES],
    )
    hosts = staged(hosts, "hosts")
    a, b = prior(hosts)
    rate = (F.col("failed") + F.lit(a)) / (F.col("docs") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn("refused", F.col("rate") >= REFUSED_RATE)


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """``(doc, text_key, counts, rules, host_rate_refused, kept)`` per row of ``docs``.

    A document is rejected if it fails the base rule (fewer than ``MIN_WORDS``
    words, or more than ``MAX_REPEATED_PERCENT`` % of them in repeated windows),
    or if its host is refused and it fails any other rule; a clean document of a
    refused host stays.

    A NULL text is an empty one, so it fails the base rule. Rows without a host
    form a host of their own. Repeated rows count each. Extra columns are
    ignored; an empty table gives an empty one.
    """
    counted = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.col(text)).alias("text_key"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        figures(F.col(text)).alias("f"),
    )
    judged = staged(failures(counted.select("doc", "text_key", "host", "f.*")), "rules")
    refused = host_verdicts(judged).filter("refused").select(F.col("host").alias("refused_host"))
    refused = staged(refused, "refused-hosts")
    if refused.count() <= BROADCAST_KEYS:
        same = F.col("host") == F.col("refused_host")
        joined = judged.join(F.broadcast(refused), same, "left")
    else:
        salted = refused.select("refused_host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        same = (F.col("host") == F.col("refused_host")) & (
            F.pmod(F.xxhash64("doc", "text_key"), F.lit(SALTS)) == F.col("salt")
        )
        joined = judged.join(salted, same, "left").drop("salt")
    host_refused = F.col("refused_host").isNotNull()
    return joined.withColumn("host_refused", host_refused).drop("refused_host", "host").withColumn(
        "kept", ~F.col("base_failed") & ~(F.col("host_refused") & any_failed())
    )

"""Quality rules on texts, and verdicts on whole hosts from their failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import once, text_of, words_of
from sluice.session import stage

#: words of a window; a text of fewer words fails; so does one with more of its words repeated
WINDOW, MIN_WORDS, MAX_REPEATED = 8, 20, 0.3
#: fixed values: characters counted as symbols
SYMBOLS = "#*$%&|<>"
#: a host whose shrunken failure rate is above this is rejected whole
MAX_HOST_RATE = 0.6
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(hashes: Column) -> Column:
    """Words covered by windows of a hash that occurs twice or more."""
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(hashes)
    pairs = F.zip_with(
        F.slice(keyed, F.lit(1), n - 1),
        F.slice(keyed, F.lit(2), n - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
            F.array().cast("array<int>")
        ),
    )
    starts = F.array_sort(F.array_distinct(F.flatten(pairs)))
    total = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            s.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) < n, total).otherwise(F.lit(0).cast("long"))


def counts(docs: DataFrame, mark: str = "_q_") -> DataFrame:
    """The rows with the counts of their whole texts, under names that begin with ``mark``.

    Everything is computed inside the row.  A null text counts as empty.
    Windows are compared by a 64-bit hash within one text.
    """
    c = lambda name: f"{mark}{name}"
    text = text_of()
    first = once(docs, c("words"), words_of(text))
    n = F.size(c("words"))
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - WINDOW + 1),
            lambda i: F.xxhash64(F.slice(F.col(c("words")), i, F.lit(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    second = once(first, c("hashes"), hashes).withColumn(c("n_words"), n.cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    return (
        once(second, c("lines"), lines)
        .withColumns(
            {
                c("word_chars"): F.length(bare).cast("long"),
                c("n_symbols"): (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast(
                    "long"
                ),
                c("n_dup_lines"): (
                    F.size(c("lines")) - F.size(F.array_distinct(c("lines")))
                ).cast("long"),
                c("n_repeat_words"): _repeated(F.col(c("hashes"))),
            }
        )
        .drop(c("words"), c("hashes"), c("lines"))
        .withColumn(
            c("base_failed"),
            (F.col(c("n_words")) < MIN_WORDS)
            | (100 * F.col(c("n_repeat_words")) > int(100 * MAX_REPEATED) * F.col(c("n_words"))),
        )
    )


def host_rates(rows: DataFrame) -> DataFrame:
    """Failure rates of hosts, shrunk by a beta prior fitted to all hosts.

    ``rows`` has a column ``host`` and a boolean ``failed``.  Failures are
    summed per task before they meet, so a host of any size is one row per
    task.  The prior has the mean of all rows; its weight comes from the
    variance of the host rates beyond what their sizes explain (method of
    moments), at least one document and at most a million.  Returns host, n,
    n_failed, rate and rejected.
    """
    hosts = stage(
        rows.groupBy("host").agg(
            F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    total = hosts.agg(
        F.sum("n").alias("rows"),
        F.sum("n_failed").alias("failed"),
        F.count("*").alias("hosts"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("n_failed") * (F.col("n_failed") / F.col("n"))).alias("spread"),
    ).first()
    n = total["rows"] or 0
    mean = total["failed"] / n if n else 0.0
    # weighted variance between hosts, less what chance gives hosts of these sizes
    between = (total["spread"] - n * mean * mean) - (total["hosts"] - 1) * mean * (1 - mean) if n else 0.0
    scale = n - total["squares"] / n if n else 0.0
    variance = between / scale if scale > 0 else 0.0
    weight = mean * (1 - mean) / variance - 1 if variance > 0 else 1e6
    weight = min(max(weight, 1.0), 1e6)
    rate = (F.col("n_failed") + weight * mean) / (F.col("n") + weight)
    return hosts.select("host", "n", "n_failed", rate.alias("rate"), (rate > MAX_HOST_RATE).alias("rejected"))


def _host(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def judged(docs: DataFrame, host_column: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row.

    A document is kept if it passes the rules and its host is not rejected.
    A null host counts as the empty one.  An empty table gives no rows.
    """
    slim = docs.select(
        F.col("doc_id"), _host(host_column).alias("host"), F.col("text")
    )
    scored = counts(slim).select(
        "doc_id",
        "host",
        *(F.col(f"_q_{name}").alias(name) for name in COUNTS),
        F.col("_q_base_failed").alias("base_failed"),
    )
    scored = stage(scored, "scored")
    bad = stage(
        host_rates(scored.select("host", F.col("base_failed").alias("failed")))
        .where("rejected")
        .select("host", F.lit(True).alias("host_rejected")),
        "rejected",
    )
    kept = ~F.col("base_failed") & F.col("host_rejected").isNull()
    return scored.join(bad, "host", "left").select(
        "doc_id", *COUNTS, "base_failed", kept.alias("kept"), F.col("host").alias("host")
    )


def keep(docs: DataFrame, host_column: str = "source") -> DataFrame:
    """The rows that are kept, with their own columns."""
    marked = counts(docs).withColumn("_q_host", _host(host_column))
    rates = host_rates(marked.select(F.col("_q_host").alias("host"), F.col("_q_base_failed").alias("failed")))
    bad = stage(rates.where("rejected").select(F.col("host").alias("_q_bad")), "rejected")
    passed = marked.where(~F.col("_q_base_failed")).join(bad, F.col("_q_host") == F.col("_q_bad"), "left_anti")
    return passed.select(*docs.columns)

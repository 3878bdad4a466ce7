r"""Quality rules, judged per document and per host. DataFrame functions only.

A document fails by itself if it has fewer than MIN_WORDS words or if more than MAX_REPEAT percent of its words lie in
five-word windows that occur twice in its text. Failures of these and of softer rules are counted per host; a beta prior
fitted to the rates of all hosts (method of moments) shrinks the rate of each, and a host whose shrunk rate is above
HOST_LIMIT takes all its documents with it. A third of all rows may have one host: counting combines on the map side,
and the join with verdicts has one row per host on the other side.

The host of a document is its ``source``; a null source is a host of its own. Null and empty texts have no words, so
they fail by themselves. Without documents there are no hosts. With one host, or hosts of equal rates, the prior is
worth PRIOR_DOCS documents of the overall rate. Repeated rows count each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.storage import stored

WINDOW = 5
MIN_WORDS, MAX_REPEAT = 10, 20
#: Softer rules count towards the host alone: percent of lines repeated, symbols per 100 words.
MAX_DUP_LINES, MAX_SYMBOLS = 30, 10
HOST_LIMIT = 0.6
PRIOR_DOCS = 20.0
_SPACE = r"[\x20\x09-\x0D]+"
_SOLID = r"[^\x20\x09-\x0D]"


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) per row of ``docs``
    (doc_id, text, source). Everything happens inside the row; no shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.col("source").alias("host"), text.alias("text"))
    rows = rows.select("doc_id", "host", "text", F.array_remove(F.split("text", _SPACE, -1), "").alias("words"),
                       F.filter(F.split("text", "\n", -1), lambda x: x.rlike(_SOLID)).alias("lines"))
    windows = F.when(F.size("words") < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])))
    rows = rows.select(
        "doc_id", "host", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), windows.alias("h"))
    # the windows that occur again, in the order of the text: sort (hash, place), keep equal neighbours, sort places
    again = F.size(F.array_distinct("h")) < F.size("h")
    rows = rows.withColumn("s", F.when(again, F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = F.array_sort(F.transform(
        F.filter("s", lambda r, j: F.coalesce(r["h"] == F.get("s", j - 1)["h"], F.lit(False))
                 | F.coalesce(r["h"] == F.get("s", j + 1)["h"], F.lit(False))), lambda r: r["i"]))
    rows = rows.withColumn("p", places)
    covered = F.aggregate(F.transform("p", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("h", "s", "p")


def verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_ok). One row per host goes through the window that fits the prior."""
    fails = (_base_failed() | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
             | (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words")))
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(fails.cast("bigint")).alias("n_failed"))
    every = Window.partitionBy(F.lit(0))
    hosts = hosts.withColumn("_mean", F.sum("n_failed").over(every) / F.sum("n_docs").over(every))
    rate = F.col("n_failed") / F.col("n_docs")
    # variance of the rates beyond what chance gives hosts of these sizes
    spread = F.sum(F.col("n_docs") * (rate - F.col("_mean")) ** 2).over(every) / F.sum("n_docs").over(every)
    chance = F.col("_mean") * (1 - F.col("_mean")) * F.count("*").over(every) / F.sum("n_docs").over(every)
    hosts = hosts.withColumn("_own", F.greatest(spread - chance, F.lit(0.0)))
    worth = F.when(F.col("_own") > 0, F.least(F.lit(1e6), F.greatest(
        F.lit(1.0), F.col("_mean") * (1 - F.col("_mean")) / F.col("_own") - 1))).otherwise(F.lit(PRIOR_DOCS))
    shrunk = (F.col("n_failed") + worth * F.col("_mean")) / (F.col("n_docs") + worth)
    return hosts.withColumn("host_rate", shrunk).select(
        "host", "n_docs", "n_failed", "host_rate", (F.col("host_rate") <= limit).alias("host_ok"))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def judge(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of every row with ``base_failed``, ``host_rate`` and ``kept``."""
    measured = stored(measures(docs), "measures")
    hosts = verdicts(measured, limit).select(F.col("host").alias("_host"), "host_rate", "host_ok")
    both = measured.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    both = both.withColumn("base_failed", _base_failed())
    return both.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).drop("host_ok")

"""Quality rules per document, and verdicts on the hosts that they come from.

Each document is measured once, within its row. The failures of the rules are summed by
host; a host's failure rate is shrunk towards the rate of all hosts by a beta prior that
is fitted to the hosts' own rates (method of moments), so that a host with few documents
says little. A host whose shrunk rate is over ``HOST_RATE`` is rejected with all of its
documents; the verdicts are joined back.

Defined results: null text counts as empty, has no words and fails; documents without a
host form one host; without hosts that differ the prior is the common rate with the
weight of one document; repeated rows count each; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm.common import batched, or_empty
from millrace.sources import files

MIN_WORDS = 50
REPEAT_PERCENT = 50
HOST_RATE = 0.75

# White space and the symbols that are counted.
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows of three."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n_symbols = sum(map(text.count, _SYMBOLS))
    word_chars = len(text) - sum(map(text.count, _SPACES))
    lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
    n_dup_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    n_repeat = 0
    distinct = set(windows)
    if len(distinct) < len(windows):
        times = Counter(windows)
        covered = 0  # first position that no earlier window has counted
        for i, window in enumerate(windows):
            if times[window] > 1:
                n_repeat += i + 3 - max(covered, i)
                covered = i + 3
    return len(words), word_chars, n_symbols, n_dup_lines, n_repeat


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id, host`` and the measures of each document."""
    rows = batched(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), or_empty(F.col(text)).alias("text")
        )
    )
    schema = StructType(
        [rows.schema["doc_id"], StructField("host", StringType()), *(StructField(m, LongType()) for m in _MEASURES)]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([measure(t) for t in batch["text"]], columns=_MEASURES, dtype="int64")
            yield pd.concat([batch[["doc_id", "host"]].reset_index(drop=True), found], axis=1)

    return rows.mapInPandas(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def host_rates(checked: DataFrame) -> DataFrame:
    """``host, n, failures, rate``: failure rates of hosts, shrunk by the fitted beta prior.

    ``checked`` has ``host`` and a boolean ``failed``.
    """
    hosts = checked.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures")
    )
    # One row: the mean rate and the spread of rates beyond what sampling explains.
    fit = hosts.agg(
        F.sum("failures").alias("failures"),
        F.sum("n").alias("n"),
        F.count("*").alias("hosts"),
        F.sum(F.col("failures") * F.col("failures") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("n_squares"),
    ).first()
    mean, weight = prior(fit["failures"] or 0, fit["n"] or 0, fit["hosts"], fit["squares"] or 0.0, fit["n_squares"] or 0)
    return hosts.withColumn("rate", (F.col("failures") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight)))


def prior(failures: int, n: int, hosts: int, squares: float, n_squares: int) -> tuple[float, float]:
    """Mean and weight of the beta prior, by the moments of the hosts' rates."""
    if not n:
        return 0.0, 1.0
    mean = failures / n
    between = squares - n * mean * mean  # weighted sum of squared distances from the mean
    scale = n - n_squares / n
    noise = mean * (1 - mean)
    spread = (between - (hosts - 1) * noise) / scale if scale > 0 else 0.0
    if spread <= 0 or noise <= 0:
        # Hosts differ no more than chance lets them: each is taken for the average.
        return mean, max(1.0, float(n) if hosts > 1 else 1.0)
    return mean, max(1.0, noise / spread - 1)


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    host_rate: float = HOST_RATE,
) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``host_rate``, ``host_rejected`` and ``kept``."""
    checked = files.materialize(
        measured(docs, doc_id, text, host).withColumn("failed", base_failed()), "host-rules"
    )
    rates = host_rates(checked).select(F.col("host").alias("of_host"), F.col("rate").alias("host_rate"))
    return (
        checked.join(rates, F.col("host").eqNullSafe(F.col("of_host")), "left")
        .withColumn("host_rejected", F.col("host_rate") > host_rate)
        .select(
            "doc_id",
            *_MEASURES,
            F.col("failed").alias("base_failed"),
            "host_rate",
            "host_rejected",
            (~F.col("failed") & ~F.col("host_rejected")).alias("kept"),
        )
    )

"""Quality classifier by hierarchical empirical Bayes.

1. A document classifier: each feature of a text is cut into fixed bins, and how often
   good and bad labelled documents fall into a bin gives its weight of evidence. All
   labelled documents are counted, by one grouped aggregation with a bounded result.
   A document's evidence is the mean of its features' weights times ``SHARPNESS``, as
   features that say the same must not be counted in full each, less for few words.
2. Hosts and paths: the classifier's probabilities of all documents are summed by host
   and by path within a host. A host's rate is shrunk towards the global rate, and a
   path's towards its host's, by the weight that the spread of the rates suggests.
3. The path's rate is the prior of the document, its evidence is added, and documents
   whose posterior probability of being good is under ``KEEP`` are rejected.

Defined results: null text counts as empty; a document without words is rejected;
documents without a host or path form a host or path of their own; labels without a
document or value are left out, several of one document count each; without good or
without bad labels the evidence is nothing and the prior decides; repeated rows are
judged each; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from millrace.llm.common import batched, fresh, or_empty
from millrace.sources import files

BINS = 12
KEEP = 0.5
#: How many independent features the features are worth together.
SHARPNESS = 8.0
#: Words at which a text's evidence counts half; a word or two tells little.
HALF_WORDS = 5
_MOST_WEIGHT = 1e6

FEATURES = ("symbols", "bars", "upper", "digits", "punctuation", "high", "top_word", "distinct", "word_length", "lines")


def _classes() -> np.ndarray:
    """Class of each byte, for one table look-up per text."""
    table = np.zeros(256, np.uint8)
    for n, members in enumerate((b"#*$%&<>~^@\\{}[]=+_", b"|", None, None, b"!?.,;:'\"()-", None, b"\n"), start=1):
        if members:
            table[list(members)] = n
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    table[128:] = 6
    table[[9, 11, 12, 13, 32]] = 8
    return table


_CLASS = _classes()


def features(text: str) -> list[float]:
    """Shares between 0 and 1 that tell prose from junk."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    solid = max(1, len(raw) - int(counts[7]) - int(counts[8]))
    distinct = set(words)
    # How much of the text its commonest neighbours are: a word that follows itself.
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        counts[1] / solid,
        counts[2] / solid,
        counts[3] / solid,
        counts[4] / solid,
        counts[5] / solid,
        counts[6] / solid,
        repeats / len(words),
        len(distinct) / len(words),
        min(1.0, solid / len(words) / 40),
        min(1.0, (counts[7] + 1) / len(words)),
    ]


def bins(values: list[float]) -> list[int]:
    """Small shares are cut finely: a bin for none, the others by halvings of one."""
    return [0 if v <= 0 else max(1, BINS - 1 - int(-math.log2(min(1.0, v)))) for v in values]


def featured(docs: DataFrame, doc_id: str, text: str, host: str, path: str) -> DataFrame:
    """``doc_id, host, path, n_words, bins`` of each document."""
    rows = batched(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(host).cast("string").alias("host"),
            F.col(path).cast("string").alias("path"),
            or_empty(F.col(text)).alias("text"),
        )
    )
    schema = StructType(
        [
            rows.schema["doc_id"],
            StructField("host", StringType()),
            StructField("path", StringType()),
            StructField("n_words", LongType()),
            StructField("bins", ArrayType(IntegerType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["doc_id", "host", "path"]].copy()
            out["n_words"] = [len(t.encode("utf-8", "surrogatepass").split()) for t in batch["text"]]
            out["bins"] = [bins(features(t)) for t in batch["text"]]
            yield out

    return rows.mapInPandas(run, schema)


def weights_of_evidence(counts: dict[tuple[int, int, int], int]) -> list[list[float]]:
    """Log odds of good against bad for each feature and bin, from counts by (feature, bin, label)."""
    totals = [sum(n for (f, _, label), n in counts.items() if f == 0 and label == side) for side in (0, 1)]
    if not all(totals):
        return [[0.0] * BINS for _ in FEATURES]
    # One more document per bin, shared out as the labels are, so that an empty bin says nothing.
    bad_share, good_share = (n / sum(totals) for n in totals)
    table = []
    for f in range(len(FEATURES)):
        good = [(counts.get((f, b, 1), 0) + good_share) / totals[1] for b in range(BINS)]
        bad = [(counts.get((f, b, 0), 0) + bad_share) / totals[0] for b in range(BINS)]
        table.append([math.log(g / b) for g, b in zip(good, bad)])
    return table


def fit(found: DataFrame, labels: DataFrame) -> tuple[list[list[float]], float]:
    """The table of evidence and the share of good documents, from all labelled documents."""
    known = (
        labels.select(F.col("doc_id").alias("of_doc"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("of_doc").isNotNull())
    )
    labelled = found.select("doc_id", "bins").join(known, F.col("doc_id") == F.col("of_doc"))
    rows = (
        labelled.select("label", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin", "label")
        .agg(F.count("*").alias("n"))
        .collect()  # at most features x bins x 2 rows
    )
    counts = {(r["feature"], r["bin"], r["label"]): r["n"] for r in rows}
    good = sum(n for (f, _, label), n in counts.items() if f == 0 and label == 1)
    bad = sum(n for (f, _, label), n in counts.items() if f == 0 and label == 0)
    return weights_of_evidence(counts), (good + 1) / (good + bad + 2)


def _weight(groups: DataFrame, rate: str, mean: str) -> float:
    """Documents that a prior is worth, by the spread of the groups' rates around their means."""
    row = groups.agg(
        F.sum(F.col("n") * (F.col(rate) - F.col(mean)) * (F.col(rate) - F.col(mean))).alias("between"),
        F.sum(F.col(mean) * (1 - F.col(mean))).alias("noise"),
        F.sum("n").alias("n"),
    ).first()
    if not row["n"]:
        return 1.0
    spread = ((row["between"] or 0.0) - (row["noise"] or 0.0)) / row["n"]
    typical = (row["between"] or 0.0) / row["n"]
    if spread <= 0 or typical <= 0:
        return _MOST_WEIGHT  # groups differ no more than by chance
    return min(_MOST_WEIGHT, max(1.0, 0.25 / spread))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    keep: float = KEEP,
) -> DataFrame:
    """``doc_id, evidence, host_rate, path_rate, score, kept`` for each row of ``docs``."""
    found = files.materialize(featured(docs, doc_id, text, host, path), "bayes-features")
    table, prior = fit(found, labels)
    lookup = F.array(*(F.array(*(F.lit(w) for w in row)) for row in table))
    total = F.aggregate(
        F.zip_with(lookup, F.col("bins"), lambda row, b: F.get(row, b)), F.lit(0.0), lambda a, w: a + w
    )
    certainty = F.col("n_words") / (F.col("n_words") + HALF_WORDS)
    evidence = F.round(total * certainty * F.lit(SHARPNESS / len(FEATURES)), 9)
    base = math.log(prior / (1 - prior))
    chance = F.round(1 / (1 + F.exp(-(F.col("evidence") + F.lit(base)))), 9)
    scored = found.withColumn("evidence", evidence).drop("bins").withColumn("chance", chance)
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("chance").alias("good"))
    paths = files.materialize(paths, "bayes-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = hosts.agg((F.sum("good") / F.sum("n")).alias("rate")).first()["rate"]
    overall = prior if overall is None else overall
    hosts = hosts.withColumn("raw", F.col("good") / F.col("n")).withColumn("mean", F.lit(float(overall)))
    host_weight = _weight(hosts, "raw", "mean")
    hosts = hosts.select(
        F.col("host").alias("of_host"),
        ((F.col("good") + F.lit(host_weight * overall)) / (F.col("n") + F.lit(host_weight))).alias("host_rate"),
    )
    within = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).withColumn("raw", F.col("good") / F.col("n"))
    path_weight = _weight(within, "raw", "host_rate")
    rates = within.select(
        F.col("host").alias("of_host"),
        F.col("path").alias("of_path"),
        "host_rate",
        (
            (F.col("good") + F.lit(path_weight) * F.col("host_rate")) / (F.col("n") + F.lit(path_weight))
        ).alias("path_rate"),
    )
    bounded = F.least(F.greatest(F.col("path_rate"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return (
        scored.join(
            rates,
            F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")),
            "left",
        )
        .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded))))))
        .select(
            "doc_id",
            "evidence",
            "host_rate",
            "path_rate",
            "score",
            ((F.col("n_words") > 0) & (F.col("score") >= keep)).alias("kept"),
        )
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    keep: float = KEEP,
) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, unchanged.

    Rows that share an id stay if the best of them is kept.
    """
    of_doc, best = fresh(docs, "of_doc", "kept")
    verdicts = (
        classify(docs, labels, doc_id, text, host, path, keep)
        .groupBy(F.col("doc_id").alias(of_doc))
        .agg(F.max("kept").alias(best))
        .where(best)
    )
    return docs.join(verdicts, docs[doc_id].eqNullSafe(F.col(of_doc)), "left_semi")

"""Host rules and the classifier against plain counting and held-out labels."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import bayes, host_rules
from tests.llm.conftest import LABELS


def by_hand(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = list(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    dups = sum(line in lines[:n] for n, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def test_measures():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", " ", " ", "\n", "\t", "é", " ", "#", "|", "\x1c"]) for _ in range(rng.randint(0, 60)))
        assert host_rules.measure(text) == by_hand(text)
    assert host_rules.measure("a b c d a b c x a b c d") == (12, 12, 0, 0, 11)


def test_host_verdicts(spark, prose):
    rows = [(n, prose(80, n), f"h{n % 5}") for n in range(100)]
    rows += [(200 + n, "too short", "bad") for n in range(50)] + [(300, prose(80, 1), "bad")]
    rows += [(301, "too short", "once"), (302, prose(80, 2), None), (303, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in host_rules.judge(docs).collect()}
    assert all(found[n]["kept"] for n in range(100))
    assert found[300]["host_rejected"] and not found[300]["kept"] and not found[300]["base_failed"]
    # A single failure says little about a host, and a host without a name is a host.
    assert not found[301]["host_rejected"] and found[301]["base_failed"]
    assert found[301]["host_rate"] < found[300]["host_rate"]
    assert found[302]["kept"] and not found[303]["kept"]


def test_prior_by_moments():
    # Hosts that are alike: their rates are taken for the common one.
    mean, weight = host_rules.prior(100, 1000, 10, sum(10 * 10 / 100 for _ in range(10)), 10 * 100**2)
    assert mean == 0.1 and weight >= 1000
    # Hosts that are all good or all bad: the prior is worth little.
    mean, weight = host_rules.prior(500, 1000, 10, 5 * 100.0, 10 * 100**2)
    assert mean == 0.5 and weight == 1.0
    assert host_rules.prior(0, 0, 0, 0.0, 0) == (0.0, 1.0)


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    even = F.col("doc_id") % 2 == 0
    judged = bayes.classify(docs, labels.where(even)).select(F.col("doc_id").alias("d"), "kept")
    rates = {
        r["quality"]: r["kept"]
        for r in labels.where(~even)
        .join(judged, F.col("doc_id") == F.col("d"))
        .groupBy("quality")
        .agg(F.avg(F.col("kept").cast("int")).alias("kept"))
        .collect()
    }
    assert rates[1] > 0.99 and rates[0] < 0.1


def test_sparse_sites_are_shrunk(spark, prose):
    junk = "| # ".join(["x"] * 60)
    rows = [(n, prose(60, n), "good", "p") for n in range(60)] + [(100 + n, junk, "bad", "p") for n in range(60)]
    rows += [(200, junk, "new", "q"), (201, prose(60, 3), None, None), (202, None, "good", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(n, 1, 0) for n in range(30)] + [(100 + n, 0, 0) for n in range(30)], LABELS)
    found = {r["doc_id"]: r for r in bayes.classify(docs, labels).collect()}
    assert found[100]["host_rate"] < found[200]["host_rate"] < found[0]["host_rate"]
    assert found[0]["kept"] and not found[100]["kept"] and not found[200]["kept"] and not found[202]["kept"]
    assert found[201]["kept"]


def test_without_labels_nothing_is_known(spark, prose):
    docs = spark.createDataFrame([(1, prose(60, 1), "a", "p")], "doc_id long, text string, source string, lang string")
    row = bayes.classify(docs, spark.createDataFrame([], LABELS)).first()
    assert row["evidence"] == 0.0 and row["score"] == pytest.approx(0.5) and row["kept"]


def shrinkage(groups):
    """Documents that a prior is worth, from (n, rate, mean) of each group."""
    between = sum(n * (rate - mean) ** 2 for n, rate, mean in groups)
    noise = sum(mean * (1 - mean) for _, _, mean in groups)
    spread = (between - noise) / sum(n for n, _, _ in groups)
    return 1e6 if spread <= 0 else min(1e6, max(1.0, 0.25 / spread))


def judged_by_hand(rows, labels):
    """Evidence, host and path rates and score of each row, one level after the other."""
    found = {n: (bayes.bins(bayes.features(t or "")), len((t or "").split()), host, path) for n, t, host, path in rows}
    known = [(found[d][0], quality) for d, quality, *_ in labels if d in found and quality is not None]
    sides = [sum(q == side for _, q in known) for side in (0, 1)]
    prior = (sides[1] + 1) / (len(known) + 2)

    def weight(feature, b):
        bad, good = (
            (sum(v[feature] == b and q == side for v, q in known) + sides[side] / len(known)) / sides[side]
            for side in (0, 1)
        )
        return math.log(good / bad)

    evidence, chance = {}, {}
    for n, (cut, words, _, _) in found.items():
        total = sum(weight(f, b) for f, b in enumerate(cut))
        evidence[n] = total * bayes.SHARPNESS / len(bayes.FEATURES) * words / (words + bayes.HALF_WORDS)
        chance[n] = 1 / (1 + math.exp(-evidence[n]) * (1 - prior) / prior)

    def rates(key):
        groups = {}
        for n, row in found.items():
            groups.setdefault(key(row), []).append(chance[n])
        return {k: (len(v), sum(v) / len(v)) for k, v in groups.items()}

    overall = sum(chance.values()) / len(chance)
    hosts, paths = rates(lambda row: row[2]), rates(lambda row: row[2:])
    worth = shrinkage([(n, rate, overall) for n, rate in hosts.values()])
    host_rate = {h: (n * rate + worth * overall) / (n + worth) for h, (n, rate) in hosts.items()}
    worth_path = shrinkage([(n, rate, host_rate[p[0]]) for p, (n, rate) in paths.items()])
    path_rate = {
        p: (n * rate + worth_path * host_rate[p[0]]) / (n + worth_path) for p, (n, rate) in paths.items()
    }
    result = {}
    for n, (_, words, host, path) in found.items():
        rate = path_rate[host, path]
        score = 1 / (1 + math.exp(-evidence[n]) * (1 - rate) / rate)
        result[n] = (evidence[n], host_rate[host], path_rate[host, path], score, words > 0 and score >= bayes.KEEP)
    return result, worth, worth_path


def test_levels_against_steps_by_hand(spark, prose):
    pick = random.Random(5)
    rows = []
    for n in range(240):
        # Hosts differ in how much of them is junk, and so do the paths of the third one.
        host, path = pick.choice(["a", "b", "c", None]), pick.choice(["p", "q", None])
        share = {"a": 0.1, "b": 0.8, "c": 0.95 if path == "p" else 0.2, None: 0.5}[host]
        text = " # | ".join(["x%"] * pick.randint(3, 60)) if pick.random() < share else prose(pick.randint(5, 90), n)
        rows.append((n, text, host, path))
    rows += [(900, None, "a", "p"), (901, "", "new", "r"), (902, "word " * 4000, "c", None)]
    labels = [(n, int("#" not in (t or "")), 0) for n, t, _, _ in rows if n % 3 == 0 and n < 900]
    labels += [labels[0], labels[1], (77777, 1, 0), (5, None, 0), (None, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in bayes.classify(docs, spark.createDataFrame(labels, LABELS)).collect()}
    wanted, worth, worth_path = judged_by_hand(rows, [x for x in labels if x[0] is not None])
    assert len(got) == len(rows) and worth < 1e6 and worth_path < 1e6  # both levels shrink by what they find
    for n, (evidence, host_rate, path_rate, score, kept) in wanted.items():
        row = got[n]
        assert row["evidence"] == pytest.approx(evidence, abs=1e-6), n
        assert row["host_rate"] == pytest.approx(host_rate, abs=1e-6), n
        assert row["path_rate"] == pytest.approx(path_rate, abs=1e-6), n
        assert row["score"] == pytest.approx(score, abs=1e-6), n
        assert row["kept"] == kept, n
    assert 0 < sum(r["kept"] for r in got.values()) < len(rows)

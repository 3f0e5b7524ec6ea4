"""Secret scans against plain regular expressions and counting."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import secrets

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace(
        "(?:password", "(?ai:password", 1
    )
)
KINDS = {
    "assign": lambda t: [m.span() for m in ASSIGN.finditer(t) if len(m[1]) >= 6],
    "access": lambda t: [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20],
    "hex": lambda t: [m.span() for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24],
}


def base(text):
    spans = [(a, n, b, k) for n, (k, find) in enumerate(KINDS.items()) for a, b in find(text)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def made(rng):
    parts = [
        "password", "PassWD", "secret", "token", "API_KEY", "apikey", "=", ":", " = ", '"', "'", " ", "\n", "é😀", "abc",
        "abcdef12", "AKIA", "AKIA" + "Q7" * 9, "deadbeef" * 4, "0123456789abcdef0123456789abcdef", "x" * 5, "==", "ſecret",
    ]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_base_spans(docs_of):
    rng = random.Random(4)
    texts = [made(rng) for _ in range(1500)] + ["", None, 'secret=token":abcdefgh', "token = a token=abcdef", "deadbeef" * 4_000]
    found = {r["doc_id"]: r for r in secrets.digests(secrets.find_secrets(docs_of(texts))).collect()}
    for n, text in enumerate(texts):
        want = base(text or "")
        assert found[n]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), text
        assert ",".join(s for s in found[n]["spans"].split(",") if not s.startswith("token:")) == want
        for kind, find in KINDS.items():
            assert found[n][f"n_{kind}"] == len(find(text or ""))


def test_ownership_parts_examples_from_credentials(spark):
    example, own, twice = "sk_Example0Example0Example0", "ghp_Own1Own1Own1Own1Own1", "Rep2Rep2Rep2Rep2Rep2Rep2"
    rows = [(n, f"call {example} now", f"o{n % 40}", f"r{n}") for n in range(400)]
    rows += [(1000, f"é {own}", "a", "r"), (1001, f"{own} again {own}", "a", "r")]
    rows += [(1002, twice, "a", "r1"), (1003, twice, "a", "r2"), (1004, own, None, None), (1005, "Lower9only" * 3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, owner string, repository string")
    found = secrets.find_secrets(docs, repository="repository", owner="owner")
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in found.collect()}
    # Both the owner a and the unnamed one have it, so it is no one's own.
    assert not any(spans[n] for n in [*range(400), 1000, 1001, 1002, 1003, 1004])
    assert spans[1005] == [(0, 30)]
    without = secrets.find_secrets(docs.where("doc_id != 1004"), repository="repository", owner="owner")
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in without.collect()}
    assert spans[1000] == [(2, 26)] and spans[1001] == [(0, 24), (31, 55)]
    counts = defaultdict(set)
    scanned = secrets.scan(docs, "doc_id", "text", "repository", "owner")
    for r in secrets.ownership(scanned).collect():
        counts[r["value_hash"]] = (r["owners"], r["repositories"])
    assert counts[hashlib.sha256(example.encode()).hexdigest()] == (40, 400)


def test_redacted(docs_of):
    rng = random.Random(6)
    texts = [made(rng) for _ in range(300)] + [None, "", "token = deadbeefdeadbeefdeadbeefdead end"]
    docs = docs_of(texts)
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs, mark="#").collect()}
    spans = {
        r["doc_id"]: sorted((s["start"], s["end"]) for s in r["all"])
        for r in secrets.find_secrets(docs).withColumn("all", F.concat("base", "added")).collect()
    }
    for n, text in enumerate(texts):
        want, at = "", 0
        merged = []
        for a, b in spans[n]:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            want, at = want + text[at:a] + "#", b
        assert out[n] == (None if text is None else want + text[at:])


def test_no_python_in_the_plan(docs_of):
    docs = docs_of(["token = abcdef"])
    for df in (secrets.digests(secrets.find_secrets(docs)), secrets.redact(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_base_candidates_are_counted(spark):
    """By values: an example many owners have, a value of one owner, written in two ways."""
    rows = [(n, "token = Shared123456 " + "ab12" * 8, f"o{n}", f"r{n}") for n in range(5)]
    rows += [(10, "password: Own1234567", "a", "r"), (11, "secret = 'Own1234567'", "a", "r"), (12, "nothing", "a", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, owner string, repository string")
    found = secrets.digests(secrets.find_secrets(docs, repository="repository", owner="owner"))
    got = {r["doc_id"]: (r["n_assign"] + r["n_hex"], r["n_base_live"], r["base_verdicts"]) for r in found.collect()}
    for n in range(5):
        assert got[n] == (2, 0, "assign:0:20:5:5:example,hex:21:53:5:5:example")
    assert got[10] == (1, 1, "assign:0:20:1:1:live")
    assert got[11] == (1, 1, "assign:0:20:1:1:live")
    assert got[12] == (0, 0, "")


def test_texts_of_very_many_matches(spark, docs_of):
    """Places of 100,000 matches in one text, and the text without them; blocks of many cuts and of none."""
    rng = random.Random(8)
    values = [f"{rng.getrandbits(96):024x}" for _ in range(100_000)]
    log = " ".join(values) + " " + "é" * 9_000 + "\n" + "token = " + "A1" * 6_000 + " end"
    docs = docs_of([log, "no secret"])
    found = {r["doc_id"]: r for r in secrets.digests(secrets.find_secrets(docs)).collect()}
    want = base(log)
    assert found[0]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert (found[0]["n_hex"], found[0]["n_assign"], found[1]["n_hex"]) == (100_000, 1, 0)
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs, mark="#").collect()}
    assert out[0] == " ".join("#" * 100_000) + " " + "é" * 9_000 + "\n# end"
    assert out[1] == "no secret"


def test_no_match_is_written(docs_of):
    scanned = secrets.scan(docs_of(["password = Hidden123456 " + "ab12" * 8]), "doc_id", "text", "source", "source")
    assert len(scanned.first()["items"]) == 2
    assert "Hidden123456" not in str(scanned.first()) and "ab12ab12" not in str(scanned.first())

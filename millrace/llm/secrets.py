"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Base kinds are found by their patterns: assignments, access keys, long hex numbers. The
method adds a fourth kind, other token-like strings that mix cases and digits. Every
candidate's hash, of an assignment that of its value, is counted over the corpus by the
distinct repositories and owners that have it: what more than ``OWNERS`` owners share is a
published example, and what at most ``OWNERS`` owner and ``REPOSITORIES`` repositories have
is taken for a live credential. Of the fourth kind only the live ones are added. Base spans
are reported whatever their owners, and their counts and verdicts beside them.

Spans come from the texts between matches: a pattern's matches and the pieces that
splitting by it leaves alternate, so running sums of their lengths are the places. The
sums are windows over rows, one for each match, so that a text of very many matches costs
time in proportion to them. Of a match its lengths and its hash are written, never itself.

Defined results: null and empty texts have no spans; rows without a repository or owner
share one each; repeated rows are scanned each and count once for ownership; texts with
the same id are kept apart by their hash; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, or_empty
from millrace.sources import files

OWNERS = 1
REPOSITORIES = 1

# The patterns of the contract, in the order of kinds. The lengths are part
# of the last two, which finds the same; of an assignment its value is checked afterwards.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
_ACCESS = r"AKIA[A-Z0-9]{16,}"
_HEX = r"[0-9a-f]{24,}"
_MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "token")
# A run of token characters with small and capital letters and digits.
_TOKEN = (
    r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[A-Z0-9_-]*+[a-z])(?=[a-z0-9_-]*+[A-Z])"
    r"[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])"
)
_ITEMS = "array<struct<kind:string,gap:bigint,n:bigint,fit:boolean,value_hash:string>>"
_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_JUDGED = "array<struct<kind:string,start:bigint,end:bigint,repositories:bigint,owners:bigint,live:boolean>>"
_CUTS = "array<struct<a:int,b:int,opens:boolean>>"
#: Code points of a text that are cut together, and the most bytes of cuts that go to every task.
BLOCK = 4096
SMALL_CUTS = 64 << 20


def _items(text: Column, pattern: str, kind: str) -> Column:
    """Matches in their order: length of the text since the one before, own length, hash.

    An assignment goes by the hash of its value, however it is written; one whose value is
    too short does not fit, and only its lengths count.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))

    def item(pair: Column) -> Column:
        value = F.regexp_extract(pair["m"], _VALUE, 1) if kind == "assign" else pair["m"]
        return F.struct(
            F.lit(kind).alias("kind"),
            pair["g"].cast("bigint").alias("gap"),
            F.length(pair["m"]).cast("bigint").alias("n"),
            (F.length(value) >= _MIN_VALUE).alias("fit"),
            F.sha2(value, 256).alias("value_hash"),
        )

    items = F.transform(F.filter(pairs, lambda p: p["m"].isNotNull()), item).cast(_ITEMS)
    return F.when(F.rlike(text, F.lit(pattern)), items).otherwise(F.array().cast(_ITEMS))


def scan(docs: DataFrame, doc_id: str, text: str, repository: str, owner: str) -> DataFrame:
    """``row, doc_id, text_hash, repository, owner, items`` of each row; no text and no match.

    ``row`` is a number that holds once the result is written.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        or_empty(F.col(text)).alias("body"),
    )
    patterns = zip((_ASSIGN, _ACCESS, _HEX, _TOKEN), KINDS)
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.md5("body").alias("text_hash"),
        "repository",
        "owner",
        F.concat(*(_items(F.col("body"), pattern, kind) for pattern, kind in patterns)).alias("items"),
    )


def ownership(scanned: DataFrame) -> DataFrame:
    """``value_hash, repositories, owners``: in how many distinct ones each candidate is."""
    fitting = F.filter("items", lambda i: i["fit"])
    places = scanned.select(
        F.explode(F.array_distinct(F.transform(fitting, lambda i: i["value_hash"]))).alias("value_hash"),
        F.struct("repository").alias("repository"),
        F.struct("owner").alias("owner"),
    )

    def counted(place: str, name: str) -> DataFrame:
        # Distinct places first, so that a hot candidate is combined in every task.
        return places.select("value_hash", place).distinct().groupBy("value_hash").agg(F.count("*").alias(name))

    return counted("repository", "repositories").join(counted("owner", "owners"), "value_hash")


def placed(scanned: DataFrame) -> DataFrame:
    """``row, doc_id, text_hash, kind, start, end, value_hash``: a row for each fitting match."""
    matches = scanned.select("row", "doc_id", "text_hash", F.posexplode("items").alias("pos", "item"))
    # Dealt by the row alone: its kinds are windows of their own in the same task.
    matches = matches.select("row", "doc_id", "text_hash", "pos", "item.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ends = matches.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far))
    return ends.where("fit").select(
        "row", "doc_id", "text_hash", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value_hash"
    )


def find_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    max_owners: int = OWNERS,
    max_repositories: int = REPOSITORIES,
) -> DataFrame:
    """``doc_id, text_hash, base, added, judged``: arrays of spans by start, then kind, for each row.

    ``judged`` has the base spans with ``repositories``, ``owners`` and ``live``.
    """
    scanned = files.materialize(scan(docs, doc_id, text, repository, owner), "secrets")
    fits = F.exists("items", lambda i: i["fit"])
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    own = ownership(scanned).withColumn("live", live)
    known = placed(scanned.where(fits)).join(own, "value_hash")
    is_base = F.col("kind") != KINDS[3]
    span = F.struct("kind", "start", "end")
    holding = known.groupBy("row", "doc_id", "text_hash").agg(
        F.collect_list(F.when(is_base, span)).cast(_SPANS).alias("base"),
        F.collect_list(F.when(~is_base & F.col("live"), span)).cast(_SPANS).alias("added"),
        F.collect_list(F.when(is_base, F.struct("kind", "start", "end", "repositories", "owners", "live")))
        .cast(_JUDGED)
        .alias("judged"),
    )
    empty = {"base": _SPANS, "added": _SPANS, "judged": _JUDGED}
    without = scanned.where(~fits).select(
        "doc_id", "text_hash", *(F.array().cast(kind).alias(name) for name, kind in empty.items())
    )
    return holding.select("doc_id", "text_hash", *empty).unionByName(without)


def in_order(spans: Column) -> Column:
    """By start, then kind as listed."""
    rank = F.create_map(*(F.lit(x) for n, kind in enumerate(KINDS) for x in (kind, n)))
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.array_sort(keyed)


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(in_order(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digests(found: DataFrame) -> DataFrame:
    """``doc_id``, counts by kind, hash of the base spans, all spans, and verdicts on the base spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    # kind:start:end:repositories:owners:verdict of each base span.
    verdicts = F.transform(
        "judged",
        lambda s: F.struct(
            s["start"].alias("start"),
            F.concat_ws(
                ":", s["kind"], s["start"], s["end"], s["repositories"], s["owners"],
                F.when(s["live"], "live").otherwise("example"),
            ).alias("verdict"),
        ),
    )
    return found.select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_live"),
        F.size(F.filter("judged", lambda s: s["live"])).cast("long").alias("n_base_live"),
        F.array_join(F.transform(F.array_sort(verdicts), lambda s: s["verdict"]), ",").alias("base_verdicts"),
    )


def cuts_of(found: DataFrame, of_doc: str, of_hash: str, cuts: str) -> DataFrame:
    """Stretches to cut of each text that has some, for one block of it after the other.

    Overlapping spans are one stretch. ``cuts`` holds for block 0, 1 and so on the cuts in
    it, and whether a cut's stretch opens there.
    """
    text = ["doc_id", "text_hash"]
    spans = (
        found.select(*text, F.explode(F.concat("base", "added")).alias("s"))
        .select(*text, F.col("s.start").alias("start"), F.col("s.end").alias("end"))
        .distinct()
    )
    by_start = Window.partitionBy(*text).orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opening = spans.withColumn("opens", F.when(reach > F.col("start"), 0).otherwise(1))
    stretch = F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    stretches = (
        opening.withColumn("stretch", stretch)
        .groupBy(*text, "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    first = F.col("block") * BLOCK
    parts = stretches.select(
        "*", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(end - 1) div {BLOCK}"))).alias("block")
    ).select(
        *text,
        "block",
        F.struct(
            F.greatest(F.col("start") - first, F.lit(0)).cast("int").alias("a"),
            F.least(F.col("end") - first, F.lit(BLOCK)).cast("int").alias("b"),
            (F.col("start") >= first).alias("opens"),
        ).alias("cut"),
    )
    blocks = parts.groupBy(*text, "block").agg(F.array_sort(F.collect_list("cut")).cast(_CUTS).alias("mine"))
    before = F.lag("block", 1, -1).over(Window.partitionBy(*text).orderBy("block"))
    blocks = blocks.withColumn("skipped", (F.col("block") - before - 1).cast("int"))
    whole = F.concat(F.array_repeat(F.array().cast(_CUTS), F.col("skipped")), F.array("mine"))
    return (
        blocks.select(*text, F.struct("block", whole.alias("cuts")).alias("some"))
        .groupBy(*text)
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list("some")), lambda x: x["cuts"])).alias(cuts))
        .withColumnsRenamed({"doc_id": of_doc, "text_hash": of_hash})
    )


def _without(body: Column, cuts: Column, mark: str) -> Column:
    """The text with ``mark`` for each stretch, block by block."""

    def block(piece: Column, mine: Column) -> Column:
        n = F.size(mine)
        past = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(mine, i - 1)["b"])
        kept = F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.concat(
                F.when((i > 0) & F.get(mine, i - 1)["opens"], F.lit(mark)).otherwise(F.lit("")),
                F.substring(piece, past(i) + 1, F.when(i == n, F.lit(BLOCK)).otherwise(F.get(mine, i)["a"]) - past(i)),
            ),
        )
        return F.when(mine.isNull(), piece).otherwise(F.array_join(kept, ""))

    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.array_join(F.zip_with(pieces, cuts, block), "")


def redact(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    mark: str = "[secret]",
) -> DataFrame:
    """The rows and columns of ``docs``, with ``mark`` for each stretch of secrets in a text.

    Only texts that hold one are touched. Their cuts go to the rows by id and hash, in a
    broadcast where they are measured to be small; beyond that in a join.
    """
    of_doc, of_hash, cuts = fresh(docs, "of_doc", "of_hash", "cuts")
    found = find_secrets(docs, doc_id, text, repository, owner)
    hit = files.materialize(cuts_of(found, of_doc, of_hash, cuts), "cuts")
    if files.measured_bytes(hit)[1] <= SMALL_CUTS:
        hit = F.broadcast(hit)
    joined_rows = docs.join(
        hit, docs[doc_id].eqNullSafe(F.col(of_doc)) & (F.md5(or_empty(docs[text])) == F.col(of_hash)), "left"
    )
    cleaned = F.when(F.col(cuts).isNull(), docs[text]).otherwise(_without(docs[text], F.col(cuts), mark))
    return joined_rows.select(*(cleaned.alias(c) if c == text else docs[c] for c in docs.columns))

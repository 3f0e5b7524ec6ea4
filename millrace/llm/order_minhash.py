"""Near duplicates by Order MinHash, verified by banded alignment.

1. Documents with the same words in the same order are one node, named by a hash of
   them. The k-mers of a text are its runs of ``SHINGLE`` words; each is labelled with
   how often it occurred before, so repeats count. Under each of ``BANDS`` hash functions
   the ``SAMPLED`` smallest labelled k-mers are taken and kept in the order of the text;
   that ordered tuple is one key. Equal keys call for similar texts in a similar order.
   Of texts with at most ``SHORT`` different shingles, and of those that may be similar to
   such a text, the first shingles in the order of their hashes are keys, so many that
   two similar texts have one in common; short texts have no others.
2. Nodes that share a key are candidates. They are not paired with each other: in each
   bucket of a key every node is paired with three of its members. The central one is
   the node whose keys are shared most over all buckets, as an original shares keys with
   all its edited copies; the others are the smallest name and the one with the smallest
   hash of its name, two orders that hold for all buckets, so that buckets of one group
   agree on few heads. All three come from combinable aggregates, so a bucket of any
   size costs three pairs a member at most. Once links are found, nodes that are still
   outside the class of a bucket's central node are paired once more, with all nodes
   of other classes in the bucket; where many are outside, all similar
   pairs of the bucket's nodes are found by the rarest shingles of each.
3. A pair is linked if its sets of ``SHINGLE``-word shingles have a Jaccard similarity
   of ``SIMILARITY`` or more, and a banded alignment of the words, which gives up as
   soon as it needs more edits than the band is wide, an edit similarity of
   ``SIMILARITY`` or more.
4. Links are merged into classes by hanging every node under its smallest neighbour and
   making each tree one node, in rounds that are written out. A document's class is the
   smallest id of its class.

Defined results: texts without words, null or not, are in no class but their own; a text
of fewer than ``SHINGLE`` words is one shingle; rows with the same id and text are copies
of each other; a class without any id has a null id; no rows give no rows. Texts that
differ by moved paragraphs are not linked, as the method asks for the same order.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import SPACES, batched, fresh, or_empty
from millrace.sources import files

SHINGLE = 5
SIMILARITY = 0.8
#: Hash functions, and k-mers sampled by each. Texts at 0.8 share a key with probability
#: 0.33 per band and miss all 20 with 0.0003; unrelated texts at 0.1 share one with 0.0002.
BANDS = 20
SAMPLED = 5
#: Up to so many different shingles the smaller of two texts decides by its first shingles
#: in the order of their hashes, which misses nothing.
SHORT = 64
#: Nodes of a bucket outside the class of its central one that are searched one by one;
#: where more are left they are searched by their rare shingles, which finds all as well.
RESIDUE = 8
#: Counters of shingles for that; beyond some millions of shingles the order gets coarser.
SLOTS = 1 << 22
#: Words of texts that are sketched together, a few megabytes.
_TOGETHER = 100_000
#: Up to so many candidates the other texts are left out before the shuffle by a broadcast.
FEW_CANDIDATES = 2_000_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _seeds(n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))


def plain(word_hashes: np.ndarray) -> np.ndarray:
    """Hashes of a text's k-mers in its order; equal ones for repeats."""
    n = len(word_hashes)
    k = min(SHINGLE, n)
    mers = np.zeros(n - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            mers = _mix(mers + word_hashes[i : n - k + 1 + i])
    return mers


def labelled(word_hashes: np.ndarray) -> np.ndarray:
    """Hashes of a text's k-mers, each with the number of its earlier occurrences."""
    mers = plain(word_hashes)
    order = np.argsort(mers, kind="stable")
    ranked = mers[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    label = np.empty(len(ranked), np.uint64)
    label[order] = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.r_[starts, len(ranked)]))
    return _with_labels(mers, label)


def _with_labels(mers: np.ndarray, label: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(mers + (label + _U(1)) * _U(0x8EBC6AF09C88C6E3))


def sketch(word_hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One key per hash function: its smallest labelled k-mers in the order of the text."""
    mers = labelled(word_hashes)
    taken = min(SAMPLED, len(mers))
    keys = np.zeros(len(seeds), np.uint64)
    with np.errstate(over="ignore"):
        for first in range(0, len(seeds), 4):
            some = seeds[first : first + 4]
            values = _mix(mers[None, :] ^ some[:, None])
            if taken < len(mers):
                places = np.sort(np.argpartition(values, taken - 1, axis=1)[:, :taken], axis=1)
                chosen = mers[places]
            else:
                chosen = np.broadcast_to(mers, (len(some), len(mers)))
            key = some.copy()
            for i in range(taken):
                key = _mix(key * _U(31) + chosen[:, i])
            keys[first : first + 4] = key
    return keys


def keys_of(word_hashes: np.ndarray, seeds: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The keys of a text: its first shingles if it may be like a short one, its sketch if it is not short."""
    few = _distinct(word_hashes)
    keys = []
    if similarity * len(few) <= SHORT + 1e-9:
        with np.errstate(over="ignore"):
            keys.append(_mix(few[: prefix_length(len(few), similarity)] + _U(0x94D049BB133111EB)))
    if len(few) > SHORT:
        keys.append(sketch(word_hashes, seeds))
    return np.concatenate(keys)


def keys_of_many(
    words: list[np.ndarray], seeds: np.ndarray, similarity: float = SIMILARITY
) -> list[tuple[np.ndarray, int]]:
    """``keys_of`` and the number of different shingles for each text, worked out together."""
    found: list = [None] * len(words)
    together: list[int] = []
    held = 0
    for n, w in enumerate(words):
        if len(w) < SHINGLE or len(w) > _TOGETHER:
            found[n] = (keys_of(w, seeds, similarity), len(_distinct(w)))
            continue
        if held + len(w) > _TOGETHER:
            for i, keys in zip(together, _keys_together([words[i] for i in together], seeds, similarity)):
                found[i] = keys
            together, held = [], 0
        together.append(n)
        held += len(w)
    if together:
        for i, keys in zip(together, _keys_together([words[i] for i in together], seeds, similarity)):
            found[i] = keys
    return found


def _keys_together(
    words: list[np.ndarray], seeds: np.ndarray, similarity: float
) -> list[tuple[np.ndarray, int]]:
    """Of texts of ``SHINGLE`` words at least: numpy works on the shingles of all at once."""
    lengths = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    n = lengths - SHINGLE + 1
    all_mers = np.zeros(len(flat) - SHINGLE + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            all_mers = _mix(all_mers + flat[i : len(all_mers) + i])
    doc = np.repeat(np.arange(len(words)), n)
    # Shingles that reach into the next text are left out.
    at = np.arange(n.sum()) + np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(n) - n), n)
    mers = all_mers[at]
    order = np.lexsort((mers, doc))
    ordered = mers[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]) | (doc[1:] != doc[:-1])]
    starts = np.flatnonzero(new)
    label = np.empty(len(mers), np.uint64)
    label[order] = np.arange(len(mers)) - np.repeat(starts, np.diff(np.r_[starts, len(mers)]))
    sizes = np.bincount(doc[new], minlength=len(words))
    few = np.split(ordered[new], np.cumsum(sizes)[:-1])
    is_long = sizes > SHORT
    inside = is_long[doc]
    sketched = iter(
        _sketch_together(_with_labels(mers[inside], label[inside]), n[is_long], seeds) if is_long.any() else ()
    )
    out = []
    for of, size in zip(few, sizes.tolist()):
        keys = []
        if similarity * size <= SHORT + 1e-9:
            with np.errstate(over="ignore"):
                keys.append(_mix(of[: prefix_length(size, similarity)] + _U(0x94D049BB133111EB)))
        if size > SHORT:
            keys.append(next(sketched))
        out.append((np.concatenate(keys), size))
    return out


def _sketch_together(mers: np.ndarray, n: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """``sketch`` of several texts, given their labelled k-mers one after another."""
    doc = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    keys = np.zeros((len(n), len(seeds)), np.uint64)
    # The smallest few lie below this with near certainty; where they don't, all are looked at.
    below = (np.minimum(16.0 / n, 0.5) * 2.0**64).astype(np.uint64)[doc]
    for band, seed in enumerate(seeds):
        values = _mix(mers ^ seed)
        low = np.flatnonzero(values < below)
        low_doc = doc[low]
        count = np.bincount(low_doc, minlength=len(n))
        order = np.lexsort((values[low], low_doc))
        low, low_doc = low[order], low_doc[order]
        nth = np.arange(len(low)) - (np.cumsum(count) - count)[low_doc]
        enough = count >= SAMPLED
        taken = [low[(nth < SAMPLED) & enough[low_doc]]]
        for d in np.flatnonzero(~enough):
            part = values[first[d] : first[d] + n[d]]
            taken.append(first[d] + np.argpartition(part, SAMPLED - 1)[:SAMPLED])
        # Sorted by place, the sampled ones of each text stand together in its order.
        chosen = mers[np.sort(np.concatenate(taken)).reshape(-1, SAMPLED)]
        key = np.full(len(n), seed, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(SAMPLED):
                key = _mix(key * _U(31) + chosen[:, i])
        keys[:, band] = key
    return keys


def edits_within(a: list, b: list, most: int) -> int | None:
    """Least insertions, deletions and replacements that turn ``a`` into ``b``, if at most ``most``.

    Works on diagonals inside a band of ``most`` to each side: for each number of edits,
    how far along each diagonal one gets. Ends agree mostly, so runs are compared whole.
    """
    if abs(len(a) - len(b)) > most:
        return None
    goal = len(b) - len(a)

    def run(i: int, j: int) -> int:
        """How far a[i:] and b[j:] agree, by doubling steps."""
        start, step = i, 8
        while True:
            x, y = a[i : i + step], b[j : j + step]
            if x == y and len(x) == step:
                i, j, step = i + step, j + step, 2 * step
                continue
            for p, q in zip(x, y):
                if p != q:
                    return i - start
                i += 1
            if step == 8 or len(x) < step or len(y) < step:
                return i - start
            step = 8

    reach = {0: run(0, 0)}
    for edits in range(most + 1):
        if reach.get(goal, -1) >= len(a):
            return edits
        if edits == most:
            return None
        further: dict[int, int] = {}
        for d in range(-edits - 1, edits + 2):
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))
            if i < 0 or i > len(a) or i + d > len(b) or i + d < 0:
                if i > len(a) and len(a) + d <= len(b) and len(a) + d >= 0:
                    i = len(a)
                elif i >= 0 and i + d > len(b) and 0 <= len(b) - d <= len(a):
                    i = len(b) - d
                else:
                    continue
            further[d] = i + run(i, i + d)
        reach = further
    return None


def prefix_length(size: int, similarity: float = SIMILARITY) -> int:
    """Of sets in one common order, how many first members decide: sets as similar as that
    have one in common among these, as all others together would be too few."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def _distinct(word_hashes: np.ndarray) -> np.ndarray:
    """Hashes of the different shingles of a text, in order."""
    return np.unique(plain(word_hashes))


def _unsigned(words: np.ndarray) -> np.ndarray:
    """Word hashes as Spark has them, without sign."""
    return np.asarray(words, dtype=np.int64).view(np.uint64)


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def shingles(words: list) -> set:
    if len(words) < SHINGLE:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(SHINGLE))))


def similar(a: list, sa: set, b: list, sb: set, similarity: float = SIMILARITY) -> bool:
    """The verdict on two word lists with their shingles."""
    if min(len(sa), len(sb)) < similarity * max(len(sa), len(sb)):
        return False
    common = len(sa & sb)
    if common < similarity * (len(sa) + len(sb) - common):
        return False
    return edits_within(a, b, int((1 - similarity) * max(len(a), len(b)) + 1e-9)) is not None


def _squeezed(body: Column) -> Column:
    """The words of a text with one blank between them."""
    return F.trim(F.regexp_replace(body, f"{SPACES}+", " "))


def _named(squeezed: Column) -> Column:
    """Name of a word sequence; null without words."""
    return F.when(squeezed != "", F.unhex(F.md5(squeezed)))


def _node(body: Column) -> Column:
    return _named(_squeezed(body))


def sketches(
    docs: DataFrame,
    bands: int = BANDS,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, node, keys, size`` for each row, the size in different shingles; no keys
    without words. One pass over the texts."""
    squeezed = docs.select(
        F.col(doc_id).alias("doc_id"), _squeezed(or_empty(F.col(text))).alias("squeezed")
    )
    hashed = batched(squeezed).select(
        "doc_id",
        _named(F.col("squeezed")).alias("node"),
        F.when(
            F.col("squeezed") != "", F.transform(F.split("squeezed", " "), lambda w: F.xxhash64(w))
        ).alias("words"),
    )
    schema = StructType(
        [
            hashed.schema["doc_id"],
            StructField("node", BinaryType()),
            StructField("keys", ArrayType(LongType())),
            StructField("size", LongType()),
        ]
    )
    seeds = _seeds(bands)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["doc_id", "node"]].copy()
            has = [w is not None for w in batch["words"]]
            found = iter(keys_of_many([_unsigned(w) for w in batch["words"] if w is not None], seeds, similarity))
            keys = [next(found) if h else (None, 0) for h in has]
            out["keys"] = [None if k is None else k.view(np.int64) for k, _ in keys]
            out["size"] = [size for _, size in keys]
            yield out

    return hashed.mapInPandas(run, schema)


def shared_keys(sketched: DataFrame, scratch: str = "omh") -> DataFrame:
    """``key, node, shares, size``: keys that several nodes have, with how central each node is."""
    # Copies meet here with their keys still together, combined in every task first.
    nodes = sketched.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("size").alias("size"), F.first("keys").alias("keys")
    )
    nodes = files.materialize(nodes.select("node", "size", F.array_distinct("keys").alias("keys")), f"{scratch}/nodes")
    keyed = nodes.select("node", "size", F.explode("keys").alias("key"))
    members = nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("members"))
    shared = files.materialize(keyed.join(members.where(F.col("members") > 1), "key"), f"{scratch}/shared")
    centrality = shared.groupBy("node").agg(F.sum("members").alias("shares"))
    return files.materialize(shared.join(centrality, "node").select("key", "node", "shares", "size"), f"{scratch}/ranked")


def _pairs(found: DataFrame) -> DataFrame:
    """Each pair of different nodes once, the smaller name first."""
    return (
        found.where(F.col("node") != F.col("other"))
        .select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other"))
        .distinct()
    )


def head_pairs(ranked: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, other``: every node of a bucket with the bucket's three heads, unless their
    sizes rule a pair out."""
    heads = ranked.groupBy("key").agg(
        # The smallest name among the most central, as max would take the largest.
        F.min(F.struct((-F.col("shares")).alias("rank"), "node", "size")).alias("central"),
        F.min(F.struct("node", "size")).alias("smallest"),
        F.min(F.struct(F.xxhash64("node").alias("rank"), "node", "size")).alias("chosen"),
    )
    of = [F.struct(f"{h}.node", f"{h}.size") for h in ("central", "smallest", "chosen")]
    found = ranked.select("node", "key", "size").join(heads, "key")
    each = found.select("node", "size", F.explode(F.array(*of)).alias("head"))
    fits = F.least("size", "head.size") >= similarity * F.greatest("size", "head.size") - 1e-6
    return _pairs(each.where(fits).select("node", F.col("head.node").alias("other")))


def residue_pairs(
    ranked: DataFrame,
    roots: DataFrame,
    done: DataFrame,
    texts: DataFrame,
    similarity: float = SIMILARITY,
    scratch: str = "omh",
) -> DataFrame:
    """``node, other``: further pairs across classes, where a bucket has some left.

    The residue of a bucket is its nodes that are not in the class of its central one.
    Each of at most ``RESIDUE`` such nodes is paired with all nodes of other classes in
    the bucket that are not too long or short, so it costs in proportion to its size. Where more
    are left, as of texts that have but a passage in common, ``prefix_pairs`` finds all
    similar pairs of the bucket's nodes.
    """
    classed = ranked.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classed = files.materialize(classed, f"{scratch}/classed")
    centers = classed.groupBy("key").agg(
        F.min(F.struct((-F.col("shares")).alias("rank"), "node", "root"))["root"].alias("center")
    )
    apart = classed.join(centers, "key").where(F.col("root") != F.col("center")).drop("center")
    apart = files.materialize(apart, f"{scratch}/residue")
    counts = apart.groupBy("key").agg(F.count("*").alias("left"))
    few = apart.join(counts.where(F.col("left") <= RESIDUE).select("key"), "key")
    others = classed.join(apart.select("key", "node", F.lit(True).alias("is_left")), ["key", "node"], "left").select(
        "key",
        F.col("node").alias("other"),
        F.col("root").alias("other_root"),
        F.col("size").alias("other_size"),
        F.col("is_left").isNotNull().alias("is_left"),
    )
    # A pair of two residues is met from one side; unlike sizes rule a pair out.
    met = few.join(
        others,
        (few["key"] == others["key"])
        & (F.col("root") != F.col("other_root"))
        & (~F.col("is_left") | (F.col("node") < F.col("other")))
        & (F.least("size", "other_size") >= similarity * F.greatest("size", "other_size") - 1e-6),
    )
    met = _pairs(met.select("node", "other"))
    many = counts.where(F.col("left") > RESIDUE).select("key")
    searched = apart.join(many, "key").select("node").distinct().withColumn("searched", F.lit(True))
    wide = (
        classed.join(many, "key", "left_semi").select("node", "root").distinct()
        .join(searched, "node", "left").withColumn("searched", F.coalesce("searched", F.lit(False)))
    )
    wide = files.materialize(wide, f"{scratch}/wide")
    return met.union(prefix_pairs(wide, texts, similarity, scratch)).distinct().join(done, ["node", "other"], "left_anti")


def prefix_pairs(
    wide: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, scratch: str = "omh"
) -> DataFrame:
    """``node, other``: all pairs across classes whose shingles may be similar enough, one of them searched.

    ``wide`` has ``node, root, searched``. Nothing is lost: of two similar sets in one
    common order, each has a shingle of the other among its first few. The order is by how
    many nodes have a shingle, rare ones first, so a passage that many texts share comes
    last and pairs nothing unless it is most of a text.
    """
    words = F.split(_squeezed(F.col("text")), " ")
    hashed = files.materialize(
        wide.join(texts, "node").select(
            "node", "root", "searched", F.transform(words, lambda w: F.xxhash64(w)).alias("words")
        ),
        f"{scratch}/wide-words",
    )
    counts = _counted(hashed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.frombuffer(counts, np.uint8)
        for batch in batches:
            out = []
            for node, root, searched, w in batch[["node", "root", "searched", "words"]].itertuples(index=False):
                mers = _distinct(_unsigned(w))
                times = seen[_slots(mers)]
                order = np.lexsort((mers, times))[: prefix_length(len(mers), similarity)]
                # What one node alone has pairs with nothing, but takes its place.
                for place in np.flatnonzero(times[order] > 1):
                    mer = int(mers[order[place]].astype(np.int64))
                    out.append((mer, node, root, searched, len(mers), int(place)))
            yield pd.DataFrame(out, columns=["mer", "node", "root", "searched", "size", "place"])

    schema = "mer long, node binary, root binary, searched boolean, size long, place long"
    firsts = files.materialize(batched(hashed).mapInPandas(run, schema), f"{scratch}/prefixes")
    a, b = firsts.where("searched").alias("a"), firsts.alias("b")
    # The first shingle that two sets have in common leaves no more than what follows it.
    most = 1 + F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) - 1
    enough = similarity / (1 + similarity) * (F.col("a.size") + F.col("b.size")) - 1e-6
    met = a.join(
        b,
        (F.col("a.mer") == F.col("b.mer"))
        & (F.col("a.root") != F.col("b.root"))
        & (~F.col("b.searched") | (F.col("a.node") < F.col("b.node")))
        & (most >= enough),
    )
    return _pairs(met.select(F.col("a.node").alias("node"), F.col("b.node").alias("other")))


def _slots(mers: np.ndarray) -> np.ndarray:
    return (mers % _U(SLOTS)).astype(np.int64)


def _counted(hashed: DataFrame) -> bytes:
    """How many nodes have a shingle of each slot, up to 255, one byte a slot.

    Slots that several shingles share count for all of them, so a count may be too high,
    which changes the order but not what it finds.
    """
    width = SLOTS // 64

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(SLOTS, np.uint8)
        for batch in batches:
            for w in batch["words"]:
                slots = np.unique(_slots(_distinct(_unsigned(w))), return_counts=True)
                seen[slots[0]] = np.minimum(seen[slots[0]].astype(np.int64) + slots[1], 255)
        blocks = [n for n in range(64) if seen[n * width : (n + 1) * width].any()]
        yield pd.DataFrame(
            {"block": blocks, "seen": [zlib.compress(seen[n * width : (n + 1) * width].tobytes(), 1) for n in blocks]}
        )

    def add(block: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.uint16)
        for part in block["seen"]:
            total = np.minimum(total + np.frombuffer(zlib.decompress(part), np.uint8), 255).astype(np.uint16)
        return pd.DataFrame({"block": block["block"][:1], "seen": [zlib.compress(total.astype(np.uint8).tobytes(), 1)]})

    schema = StructType([StructField("block", IntegerType()), StructField("seen", BinaryType())])
    found = batched(hashed).mapInPandas(count, schema).groupBy("block").applyInPandas(add, schema).collect()
    blocks = {r["block"]: zlib.decompress(r["seen"]) for r in found}
    return b"".join(blocks.get(n, bytes(width)) for n in range(64))


def verified(pairs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose texts are similar enough. ``nodes`` has one row per node, with its text."""
    with_text = (
        pairs.join(nodes.select("node", F.col("text").alias("text_a")), "node")
        .join(nodes.select(F.col("node").alias("other"), F.col("text").alias("text_b")), "other")
        .select("node", "other", "text_a", "text_b")
    )
    schema = StructType([StructField("node", BinaryType()), StructField("other", BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple = (None, None, None)  # pairs come sorted by the second text
        for batch in batches:
            linked = []
            for other, a, b in zip(batch["other"], batch["text_a"], batch["text_b"]):
                if held[0] != other:
                    words = _words(b)
                    held = (other, words, shingles(words))
                mine = _words(a)
                linked.append(similar(mine, shingles(mine), held[1], held[2], similarity))
            yield batch.loc[linked, ["node", "other"]]

    return with_text.mapInPandas(run, schema)


def _hooked(edges: DataFrame, scratch: str) -> DataFrame:
    """``name, root``: each end of an edge and the top of the tree that it hangs in, where
    everyone hangs under the smallest of its neighbours and itself. Paths are halved until
    all point to the top."""
    both = edges.select(F.col("a").alias("name"), F.col("b").alias("near")).union(edges.select("b", "a"))
    tree = both.groupBy("name").agg(F.min("near").alias("near")).select("name", F.least("name", "near").alias("root"))
    tree = files.materialize(tree, f"{scratch}/trees")
    while True:
        up = tree.select(F.col("name").alias("root"), F.col("root").alias("top"))
        made = files.materialize(tree.join(up, "root").select("name", "root", "top"), f"{scratch}/trees")
        moved = made.where(F.col("top") != F.col("root")).limit(1).count()
        tree = made.select("name", F.col("top").alias("root"))
        if not moved:
            return tree


def _merged_edges(edges: DataFrame, tree: DataFrame) -> DataFrame:
    """Edges between the tops of trees, each once."""
    one = tree.select(F.col("name").alias("a"), F.col("root").alias("root_a"))
    two = tree.select(F.col("name").alias("b"), F.col("root").alias("root_b"))
    ends = edges.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y")
    )
    return ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(links: DataFrame, known: DataFrame | None = None, scratch: str = "omh") -> DataFrame:
    """``node, root``: each linked node and the smallest name that it is connected with.

    In each round all nodes are hung under their smallest neighbours and every tree becomes
    one node, so edges within trees are gone and at least half of the nodes. ``known`` are
    roots from earlier links. Rounds are written out.
    """
    edges = links.select(F.col("node").alias("a"), F.col("other").alias("b"))
    found = None if known is None else known.select(F.col("node").alias("name"), "root")
    if found is not None:
        edges = _merged_edges(edges, found)
    while True:
        edges = files.materialize(edges, f"{scratch}/edges")
        if found is not None and not edges.limit(1).count():
            return found.select(F.col("name").alias("node"), "root")
        tree = _hooked(edges, scratch)
        if found is None:
            found = tree
        else:
            up = tree.select(F.col("name").alias("root"), F.col("root").alias("top"))
            moved = found.join(up, "root", "left").select("name", F.coalesce("top", "root").alias("root"))
            # Names that no earlier link had.
            new = tree.join(found.select("name"), "name", "left_anti").select("name", "root")
            found = files.materialize(moved.union(new), f"{scratch}/roots")
        edges = _merged_edges(edges, tree)


def _candidate_texts(docs: DataFrame, ranked: DataFrame, text: str, scratch: str) -> DataFrame:
    """``node, text`` of the nodes that share a key with another, one row each."""
    body = or_empty(F.col(text))
    worded = docs.select(_node(body).alias("node"), body.alias("text")).where(F.col("node").isNotNull())
    wanted = files.materialize(ranked.select("node").distinct(), f"{scratch}/wanted")
    if wanted.count() <= FEW_CANDIDATES:
        worded = worded.join(F.broadcast(wanted), "node", "left_semi")
    else:
        worded = worded.join(wanted, "node", "left_semi")
    return files.materialize(worded.groupBy("node").agg(F.first("text").alias("text")), f"{scratch}/texts")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
) -> DataFrame:
    """``doc_id, node, class_id, class_size, kept`` for each row; one kept row per class.

    ``node`` names the row's word sequence. Of a class the row with the smallest id is
    kept, of equal rows any one.
    """
    spark, scratch = docs.sparkSession, f"omh-{uuid.uuid4().hex}"
    named = files.materialize(sketches(docs, bands, doc_id, text, similarity), "omh-sketches")
    ranked = shared_keys(named, scratch)
    pairs = files.materialize(head_pairs(ranked, similarity), f"{scratch}/pairs")
    texts = _candidate_texts(docs, ranked, text, scratch)
    links = files.materialize(verified(pairs, texts, similarity), f"{scratch}/verified")
    roots = components(links, scratch=scratch)
    more = files.materialize(residue_pairs(ranked, roots, pairs, texts, similarity, scratch), f"{scratch}/pairs")
    found = files.materialize(verified(more, texts, similarity), f"{scratch}/verified")
    roots = components(found, roots, scratch)
    roots = roots.select(F.col("node").alias("of_node"), "root")
    by_node = (
        named.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
        .join(roots, F.col("node") == F.col("of_node"), "left")
        .select("node", F.coalesce("root", "node").alias("root"), "first_id", "n")
    )
    by_node = files.materialize(by_node, "omh-nodes")
    # What the result reads is written elsewhere.
    files.delete(spark, f"{files.shared_dir(spark).rstrip('/')}/millrace/{scratch}")
    classes = by_node.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"),
        F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node"))["node"].alias("keeper"),
    )
    verdicts = by_node.join(classes, "root").select(
        F.col("node").alias("of_node"), "class_id", "class_size", "first_id", (F.col("node") == F.col("keeper")).alias("keeps")
    )
    return named.select("doc_id", "node").join(verdicts, F.col("node") == F.col("of_node"), "left").select(
        "doc_id",
        "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("node").isNull() | (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("first_id")))).alias("kept"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class, unchanged; of rows with equal id and words one."""
    no_id, an_id, name = fresh(docs, "no_id", "an_id", "node")

    def keyed(df: DataFrame, found: Column, node: Column) -> list[Column]:
        # Without nulls, so that the join and the last step share one partitioning.
        return [
            found.isNull().alias(no_id),
            F.coalesce(found.cast("long"), F.lit(0)).alias(an_id),
            F.coalesce(node, F.unhex(F.lit("00"))).alias(name),
        ]

    verdicts = near_duplicates(docs, doc_id, text, similarity).where("kept")
    kept = verdicts.select(*keyed(verdicts, F.col("doc_id"), F.col("node"))).distinct()
    rows = docs.select("*", *keyed(docs, F.col(doc_id), _node(or_empty(F.col(text)))))
    return rows.join(kept, [no_id, an_id, name]).dropDuplicates([no_id, an_id, name]).select(docs.columns)

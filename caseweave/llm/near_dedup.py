"""Near-duplicate documents by one-permutation MinHash.

1. A document's set of word shingles is hashed once; the hash range is cut into
   BANDS * ROWS bins and the least hash of each bin is its signature value. Empty
   bins borrow from a bin that a hash sequence of their own picks (optimal
   densification), so signatures of short texts agree as often as their sets do.
2. Documents with the same set are one class: groups of copies, however large, are one
   row from here on. Classes, not ids, are what is linked, so an id with several texts
   links by each of them.
3. ROWS signature values make a band key. Representatives with an equal key share a
   bucket. Each bucket proposes stars, not pairs: every member is paired with the
   bucket's most connected member and with one that a hash of the key picks.
4. Pairs are confirmed on the full sets, and confirmed links make components.
5. Stars can leave a bucket's members in several components. Those members are
   compared across components by the shingles that are rarest among them, with exact
   bounds, so that no link of a bucket is lost and no bucket is paired out.

A pair at the similarity limit of 0.75 shares no bucket with a probability of
(1 - 0.75 ** ROWS) ** BANDS, below 1e-5; pairs above it far less often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.common import Columns, map_columns, materialise, prepare, texts
from caseweave.llm.components import connected_components
from caseweave.llm.shingles import mix, shingle_sets

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
ROWS = 6
BANDS = 60

_BINS = ROWS * BANDS


def signature(hashes: np.ndarray, bins: int = _BINS) -> np.ndarray:
    """One-permutation signature of a sorted set of evenly spread 64-bit hashes."""
    width = np.uint64((1 << 64) // bins + 1)
    owner = (hashes // width).astype(np.int64)
    first = np.searchsorted(owner, np.arange(bins))
    filled = first < len(hashes)
    filled[filled] = owner[first[filled]] == np.flatnonzero(filled)
    source = np.arange(bins)
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        probe = mix(empty.astype(np.uint64) * np.uint64(0x10001) + np.uint64(attempt << 32))
        target = (probe % np.uint64(bins)).astype(np.int64)
        hit = filled[target]
        source[empty[hit]] = target[hit]
        empty = empty[~hit]
    return hashes[first[source]]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bands = sig.reshape(-1, rows)
    keys = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for k in range(rows):
        keys = mix(keys * np.uint64(0x100000001B3) + bands[:, k])
    return keys.view(np.int64)


def _same(shingles: np.ndarray) -> bytes | None:
    """What equal sets share; None for the empty set."""
    if not len(shingles):
        return None
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures() -> Callable[[Columns], Columns]:
    def run(batch: Columns) -> Columns:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        return {
            "doc_id": batch["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "same": [_same(s) for s in sets],
            "bands": [band_keys(signature(s)) if len(s) else None for s in sets],
        }

    return run


def _sets() -> Callable[[Columns], Columns]:
    def run(batch: Columns) -> Columns:
        sets = shingle_sets(batch["text"], SHINGLE_WORDS)
        return {"same": [_same(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    return run


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, same (digest of the set), bands; the last two NULL without words
    and without doc_id, as nothing links there."""
    found = map_columns(
        texts(docs), _signatures, "doc_id long, n_shingles long, same binary, bands array<long>"
    )
    named = F.col("doc_id").isNotNull()
    return found.withColumns({c: F.when(named, F.col(c)) for c in ("same", "bands")})


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    size_a, size_b = F.size("set_a"), F.size("set_b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    # sets of too different sizes cannot reach it: known before the intersection
    possible = 100 * F.least(size_a, size_b) >= SIMILARITY_PERCENT * F.greatest(size_a, size_b)
    reached = 100 * both >= SIMILARITY_PERCENT * (size_a + size_b - both)
    return pairs.join(two, "b").join(one, "a").where(possible).where(reached).select("a", "b")


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return (
        df.where(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )


def _stars(members: DataFrame) -> DataFrame:
    """Each member with the bucket's most connected member and with one by hash."""
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    weighted = members.join(weight, "id")
    centres = weighted.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("top"),
        F.min(F.struct(F.xxhash64("key", "id").alias("h"), "id")).alias("any"),
    )
    # written, so that both sides of the join are plain shuffles, which AQE can split
    stars = members.join(materialise(centres, "centres", narrow=True), "key").select(
        "id", F.explode(F.array(-F.col("top.id"), F.col("any.id"))).alias("centre")
    )
    return _pairs(stars, "id", "centre")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (id, root) of the buckets that hold several components."""
    placed = members.join(roots, "id", "left").select(
        "key", "id", F.coalesce("root", "id").alias("root")
    )
    spread = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    spread = materialise(spread.where(F.col("lo") != F.col("hi")).select("key"), "spread", narrow=True)
    return placed.join(spread, "key").select("id", "root").distinct()


def _across_components(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components that can still reach the similarity, exactly.

    Two sets that share at least `need` shingles meet within the first
    size - need + 1 shingles of each, whatever the common order. Rare shingles come
    first, so documents that share only what their whole group shares do not meet.
    Shingles of a single document only count as places in the order.
    """
    grams = materialise(
        sets.join(mixed, sets["node"] == mixed["id"]).select(
            "id", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("gram")
        ),
        "grams",
    )
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = grams.join(materialise(common, "common"), "gram")
    of_doc = Window.partitionBy("id")
    place = F.row_number().over(of_doc.orderBy("n", "gram")) + (
        F.col("size") - F.count(F.lit(1)).over(of_doc)
    )
    longest = F.col("size") - F.ceil(SIMILARITY_PERCENT * F.col("size") / 100) + 1
    first = shared.withColumn("place", place).where(F.col("place") <= longest)
    first = materialise(first.select("gram", "id", "root", "size", "place"), "first")
    x, y = first.alias("x"), first.alias("y")
    both = F.col("x.size") + F.col("y.size")
    need = F.ceil(SIMILARITY_PERCENT * both / (100 + SIMILARITY_PERCENT))
    meets = (
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.place") <= F.col("x.size") - need + 1)
        & (F.col("y.place") <= F.col("y.size") - need + 1)
    )
    return x.join(y, meets).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    A document without words (or text) has no shingles and stands alone. So does a row
    without doc_id, which is kept and has component_id NULL. Rows with an equal doc_id
    may have different texts: each row is linked by its own. An empty table gives an
    empty one. Further columns are ignored.
    """
    prepare(docs.sparkSession)
    sigs = materialise(signatures(docs), "signatures")
    classes = (
        sigs.where(F.col("same").isNotNull())
        .groupBy("same")
        .agg(F.min("doc_id").alias("rep"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    # written once: the numbers of the classes stay what they are
    classes = materialise(classes, "classes")
    of_class = materialise(
        sigs.select("doc_id", "n_shingles", "same").join(classes, "same", "left"), "of-class"
    )
    keyed = (
        sigs.join(classes.withColumnRenamed("rep", "doc_id"), ["same", "doc_id"])
        .select(F.col("node").alias("id"), F.explode("bands").alias("key"))
    )
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # repeated rows of a class become one only now: by key, a full bucket would be one task
    met = materialise(keyed.join(materialise(shared, "shared"), "key"), "met")
    members = materialise(met.distinct(), "members")
    involved = classes.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    involved = materialise(involved, "involved")
    found_sets = map_columns(
        texts(docs).join(involved.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"),
        _sets,
        "same binary, shingles array<long>",
    ).dropDuplicates(["same"])
    sets = materialise(found_sets.join(involved, "same").select("node", "shingles"), "sets")
    stars = materialise(_stars(members), "pairs", narrow=True)
    links = materialise(_confirmed(stars, sets), "confirmed")
    roots = connected_components(links)
    mixed = materialise(_mixed(members, roots), "mixed", narrow=True)
    more = materialise(_across_components(mixed, sets), "pairs", narrow=True)
    across = materialise(_confirmed(more, sets), "confirmed")
    if not across.isEmpty():
        roots = connected_components(links.union(across))
    grouped = roots.join(classes, roots["id"] == classes["node"]).select("id", "root", "rep")
    least = grouped.groupBy("root").agg(F.min("rep").alias("least"))
    component = materialise(grouped.join(least, "root").select("id", "least"), "least", narrow=True)
    found = of_class.join(component, of_class["node"] == component["id"], "left")
    found_id = F.coalesce("least", "rep", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        found_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == found_id, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, whole and with their columns, of which one per group stays.

    Of several rows with the doc_id that stays, all stay; rows without doc_id stay.
    """
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))

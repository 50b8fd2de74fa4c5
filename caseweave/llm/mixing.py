"""Mixing sources to target weights by capped water-filling.

All words together are shared out to the sources by weight. A source whose share is
above `epochs` times its own size is clamped there, and what it cannot use is shared
again among the others by their weights, until no share is above. In the order of the
share at which they are clamped, the clamped sources are the first ones, so running sums
in that order give the level at once.

A source's target is then taken in whole repetitions of all its documents and one
fractional repetition: documents in the order of a seeded hash, each that still fits what
is missing, until none fits; and at last the document whose size is nearest to what is
missing. The walk through that order is made in steps: up to the first document that does
not fit, all that fit what was missing are taken. A step needs sums by buckets of the
order and the documents of one bucket per source; only the steps, a few per source, are
kept, and tell for every document whether it was taken.

Equal rows are one entry with a number of copies, of which any number can be taken.
Sources are rows of a table; only a few numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.common import materialise, n_words, prepare

WEIGHTS = (1, 2, 3)
EPOCHS = 3
SEED = "mix-1"
RANK_PARTS = 64
# Entries that a bucket of the seeded order holds on average in the largest source.
BUCKET_ROWS = 20_000
# Copies of an entry that are listed from one array.
COPIES = 10_000


def _seeded(seed: str) -> Column:
    """A number from 0 to 2 ** 60 that the seed and the document alone decide."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """df with the sums of expressions over all rows before each, in the given order.

    Ranges of the order are summed each on its own and moved up by what the earlier
    ranges hold; there are at most RANK_PARTS ranges, so their sums are a tiny table.
    """
    parts = materialise(
        df.repartitionByRange(RANK_PARTS, *order).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    whole = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0)
    starts = whole.select(
        "_part", *[F.coalesce(F.sum(f"_{n}").over(earlier), nothing).alias(f"_{n}") for n in sums]
    )
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(within), nothing) for n, c in sums.items()}
    return parts.join(F.broadcast(starts), "_part").select(*df.columns, *[c.alias(n) for n, c in before.items()])


def ranked(sources: DataFrame) -> DataFrame:
    """The sources with their rank from 0 by code point, NULL last."""
    return running(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})


def water_fill(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, weight to these with target."""
    limit = F.col("source_size") * epochs
    ratio = limit / F.col("weight")
    order = [ratio.asc(), F.col("source").asc_nulls_last()]
    placed = running(sources, order, {"used": limit, "weights": F.col("weight")})
    sums = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = (F.lit(x or 0) for x in sums)
    level = (total - F.col("used")) / (weight - F.col("weights"))
    # the first source in this order that is not clamped at its level sets the level
    first = F.min(F.struct(ratio.alias("ratio"), F.col("source").isNull(), "source", level.alias("level")))
    free = placed.where(F.col("weight") * level <= limit).agg(first.alias("f")).first()["f"]
    if free is None:
        return sources.withColumn("target", limit.cast("double"))
    share = F.col("weight") * F.lit(float(free["level"]))
    return sources.withColumn("target", F.when(share > limit, limit.cast("double")).otherwise(share))


ENTRY = ("source", "doc_id", "size", "place")


def entries_of(docs: DataFrame, seed: str) -> DataFrame:
    """source, doc_id, size, place, copies: equal rows as one entry."""
    sized = docs.select(
        "source", "doc_id", n_words(F.col("text")).alias("size"), _seeded(seed).alias("place")
    )
    return sized.groupBy(*ENTRY).agg(F.count(F.lit(1)).alias("copies"))


def targets(entries: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """source, source_size, target."""
    words = F.sum(F.col("size") * F.col("copies"))
    sizes = materialise(entries.groupBy("source").agg(words.alias("source_size")), "source-sizes")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")
    )
    return water_fill(materialise(ranked(sizes).withColumn("weight", weight), "weights"), epochs)


def _order() -> Column:
    """Place of an entry in the seeded order; a NULL doc_id has a place, too."""
    return F.struct("place", F.col("doc_id").isNotNull().alias("named"), "doc_id", "size")


def planned(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Entries with source_size, target, whole (repetitions of every copy) and extra
    (copies that are taken once more)."""
    prepare(docs.sparkSession)
    entries = materialise(entries_of(docs, seed), "entries")
    plan = targets(entries, weights, epochs)
    whole = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size") + 1e-9)),
    ).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    plan = materialise(plan.select("source", "source_size", "target", "whole", "rest"), "plan")
    # documents that can be taken once more
    open_ = (F.col("size") > 0) & (F.col("whole") < epochs)
    same = F.col("e.source").eqNullSafe(F.col("p.source"))
    known = entries.alias("e").join(plan.alias("p"), same).select(
        "e.*", "source_size", "target", "whole", "rest", open_.alias("open")
    )
    steps = _walk(materialise(known.where("open").select(*ENTRY, "copies", "rest"), "open"), plan)
    taken = materialise(known.alias("e").join(
        steps.alias("s"), F.col("e.source").eqNullSafe(F.col("s.source")), "left"
    ).select("e.*", _taken().alias("extra")), "taken")
    return _fitted(taken)


def _taken() -> Column:
    """Copies of an entry that its step takes."""
    place = _order_of("e")
    step = F.get(
        F.filter(
            "steps",
            lambda s: (s["after"].isNull() | (place > s["after"]))
            & (s["until"].isNull() | (place <= s["until"])),
        ),
        F.lit(0),
    )
    at_end = step["until"].isNotNull() & (place == step["until"])
    copies = F.when(at_end, step["last"]).when(F.col("e.size") <= step["gap"], F.col("e.copies"))
    return F.when(F.col("e.open"), F.coalesce(copies, F.lit(0))).otherwise(0).cast("long")


def _order_of(alias: str) -> Column:
    doc_id = F.col(f"{alias}.doc_id")
    return F.struct(
        F.col(f"{alias}.place").alias("place"),
        doc_id.isNotNull().alias("named"),
        doc_id.alias("doc_id"),
        F.col(f"{alias}.size").alias("size"),
    )


def _walk(entries: DataFrame, plan: DataFrame) -> DataFrame:
    """source, steps: the walk through the seeded order of each source.

    A step starts after one entry (``after``, NULL at the beginning) with ``gap`` words
    missing and ends at the first entry (``until``) of which not all copies fit; it takes
    ``last`` of those and all copies of the entries before it that are no larger than the
    gap. The last step has no end. Steps go on until no source has another one.
    """
    largest = entries.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(64, -(-largest // BUCKET_ROWS))
    bucket = F.floor(F.col("place") / F.lit(((1 << 60) // buckets) + 1))
    state = plan.select(
        "source",
        F.lit(0).alias("number"),
        F.lit(None).cast(entries.select(_order().alias("o")).schema["o"].dataType).alias("after"),
        F.col("rest").alias("gap"),
    )
    state = materialise(state, "walk")
    steps = []
    while not state.isEmpty():
        s = state.alias("s")
        rows = entries.alias("e").join(s, F.col("e.source").eqNullSafe(F.col("s.source")))
        behind = F.col("s.after").isNull() | (_order_of("e") > F.col("s.after"))
        rows = rows.where(behind & (F.col("e.size") <= F.col("gap"))).select(
            "e.source",
            _order_of("e").alias("at"),
            "e.size",
            (F.col("e.size") * F.col("e.copies")).alias("words"),
            "gap",
            bucket.alias("bucket"),
        )
        rows = materialise(rows, "fitting", narrow=True)
        sums = rows.groupBy("source", "bucket").agg(
            F.sum("words").alias("words"), F.max("gap").alias("gap")
        )
        earlier = Window.partitionBy("source").orderBy("bucket")
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        full = (
            sums.where(F.col("before") + F.col("words") > F.col("gap"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "before")).alias("full"))
            .select(F.col("source").alias("of"), "full.bucket", "full.before")
        )
        # written, so that the window below deals out the rows of one bucket per source
        same = F.col("source").eqNullSafe(F.col("of")) & (rows["bucket"] == F.col("f.bucket"))
        inside = materialise(
            rows.join(full.alias("f"), same).select(
                "source", "at", "size", "words", "gap", "before"
            ),
            "bucket",
            narrow=True,
        )
        so_far = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        reached = F.col("before") + F.sum("words").over(so_far)
        ends = (
            inside.withColumn("reached", reached)
            .where(F.col("reached") > F.col("gap"))
            .groupBy("source")
            .agg(F.min(F.struct("at", "size", "words", "reached")).alias("end"))
            .select(F.col("source").alias("of"), "end.*")
        )
        left = F.col("gap") - (F.col("reached") - F.col("words"))
        last = F.floor(left / F.col("size"))
        made = s.join(ends.alias("n"), F.col("s.source").eqNullSafe(F.col("n.of")), "left").select(
            "s.*",
            F.col("n.at").alias("until"),
            last.alias("last"),
            (left - last * F.col("size")).alias("next"),
        )
        made = materialise(made, "walk")
        steps.append(made.select("source", "number", "after", "gap", "until", "last"))
        state = made.where(F.col("until").isNotNull()).select(
            "source", F.col("number") + 1, F.col("until"), F.col("next")
        ).toDF("source", "number", "after", "gap")
    if not steps:
        empty = state.select("source", "number", "after", "gap")
        steps = [empty.withColumn("until", F.col("after")).withColumn("last", F.lit(0).cast("long"))]
    whole = steps[0]
    for more in steps[1:]:
        whole = whole.unionByName(more)
    step = F.struct("after", "gap", "until", "last")
    return whole.groupBy("source").agg(F.collect_list(step).alias("steps"))


def _fitted(taken: DataFrame) -> DataFrame:
    """One more copy per source of the entry that fits what is missing best."""
    gap = F.max("rest") - F.sum(F.col("size") * F.col("extra"))
    missing = materialise(taken.groupBy("source").agg(gap.alias("missing")), "missing")
    same = F.col("t.source").eqNullSafe(F.col("m.source"))
    miss = F.abs(F.col("size") - F.col("missing"))
    fit = (
        taken.where(F.col("open") & (F.col("extra") < F.col("copies")))
        .alias("t")
        .join(missing.alias("m"), same)
        .where(miss < F.col("missing"))
        .groupBy("t.source")
        .agg(F.min(F.struct(miss.alias("miss"), _order_of("t").alias("at"))).alias("best"))
    )
    rows = taken.alias("t").join(
        fit.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")), "left"
    )
    is_best = F.coalesce(_order_of("t") == F.col("b.best.at"), F.lit(False)) & F.col("open")
    more = F.when(is_best & (F.col("extra") < F.col("copies")), 1).otherwise(0)
    return rows.select(
        *[F.col(f"t.{c}") for c in (*ENTRY, "copies", "source_size", "target", "whole")],
        (F.col("extra") + more).cast("long").alias("extra"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, repetitions: one row per document.

    Weights go to the sources by code point (NULL is a source, the last), repeating.
    A NULL text has size 0 and takes nothing; if no document has words every target is
    0. Rows with the same doc_id share their place in the order and are each their own
    document; of equal rows as many are taken as fit. Whole documents are taken, so a
    source misses its target by less than its best-fitting document does. No document is
    taken more than `epochs` times.
    """
    entries = planned(docs, weights, epochs, seed)
    # copies are listed in runs of at most COPIES with an equal number of repetitions
    def runs(n: Column, repetitions: Column) -> Column:
        starts = F.sequence(F.lit(0).cast("long"), n - 1, F.lit(COPIES).cast("long"))
        listed = F.transform(
            starts,
            lambda at: F.struct(
                F.least(n - at, F.lit(COPIES)).cast("int").alias("n"), repetitions.alias("repetitions")
            ),
        )
        return F.when(n > 0, listed).otherwise(F.array().cast("array<struct<n:int,repetitions:bigint>>"))

    once_more = runs(F.col("extra"), F.col("whole") + 1)
    others = runs(F.col("copies") - F.col("extra"), F.col("whole"))
    listed = entries.withColumn("run", F.explode(F.concat(once_more, others)))
    listed = listed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("run.n"))))
    return listed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("run.repetitions")).alias("taken"),
        F.col("run.repetitions").alias("repetitions"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The documents of the mix, whole and with their columns, one row per repetition.

    Documents without words are in no mix. Of rows with equal doc_id, source and size
    exactly as many are repeated once more as the plan takes.
    """
    plan = planned(docs, weights, epochs, seed).where("size > 0 AND whole + extra > 0")
    plan = materialise(plan.select(*ENTRY, "copies", "whole", "extra"), "mix")
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    by = dict(zip(docs.columns, names, strict=True))

    def joined(entries: DataFrame) -> DataFrame:
        return rows.join(
            entries,
            F.col(by["doc_id"]).eqNullSafe(F.col("doc_id"))
            & F.col(by["source"]).eqNullSafe(F.col("source"))
            & (n_words(F.col(by["text"])) == F.col("size")),
        )

    def repeated(found: DataFrame) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
        return found.where("times > 0").select(*names, copies.alias("copy")).select(*names)

    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("copies"))
    alike = joined(plan.where(~partly)).withColumn(
        "times", F.col("whole") + (F.col("extra") > 0).cast("long")
    )
    few = plan.where(partly)
    if few.isEmpty():
        return repeated(alike).toDF(*docs.columns)
    # rows of the entries of which only some are taken once more are numbered: within each
    # partition, after what the partitions before it hold
    parts = materialise(
        joined(few)
        .withColumn("part", F.spark_partition_id())
        .withColumn("line", F.monotonically_increasing_id()),
        "partly",
    )
    entry = ("place", "doc_id", "source", "size")
    sizes = parts.groupBy(*entry, "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*entry).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.struct(*entry).alias("of"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
    )
    line = F.row_number().over(Window.partitionBy(*entry, "part").orderBy("line"))
    numbered = (
        parts.withColumn("number", line)
        .join(starts, F.struct(*entry).eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
        .withColumn("number", F.col("number") + F.col("start"))
    )
    times = F.col("whole") + (F.col("number") <= F.col("extra")).cast("long")
    return repeated(alike).unionByName(repeated(numbered.withColumn("times", times))).toDF(
        *docs.columns
    )

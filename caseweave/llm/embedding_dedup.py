"""Near-duplicate vectors by lattice hashing.

1. Equal vectors of a label are one class: from here on a group of copies, however
   large, is one row that weighs as many.
2. In each of TABLES tables a unit vector is projected at random to BLOCKS times eight
   dimensions and each eight are decoded to their E8 lattice point. The points, with
   the label, are the vector's cell. A vector is a member of its own cell and a visitor
   of the neighbouring cells it lies nearest to, one per block.
3. Cells that can hold a pair are compared inside: members with members and visitors,
   by cosine in double precision. A full cell is dealt to a grid of blocks, so no task
   holds more than two parts of it. Only counts and one link per member leave a block.
4. A pair that meets several times is counted where it meets first: in the first table,
   and there in the cell with the least key. Both vectors' cells are worked out again
   from the vectors to tell, so that no list of pairs has to be made distinct.

Two vectors at the limit of 0.98 miss each other in one table with a probability of
0.35, in all of them of 0.002; nearer ones far less often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseweave.llm import e8
from caseweave.llm.common import Columns, map_columns, materialise, prepare
from caseweave.llm.components import connected_components
from caseweave.llm.shingles import mix

SIMILARITY = 0.98
TABLES = 6
BLOCKS = 2
# Length of a projected unit vector's component: 1 / 8 of it is the mean of a far pair.
SCALE = 0.5
SEED = 20
# Rows of one cell that are compared at once with as many others.
PART_ROWS = 2000


@lru_cache(maxsize=8)
def _projection(dimensions: int) -> np.ndarray:
    """One random matrix to the dimensions of all tables and blocks, alike in every task."""
    draw = np.random.default_rng([SEED, dimensions])
    return draw.normal(size=(dimensions, TABLES * BLOCKS * e8.DIMENSIONS)) * SCALE


def _hashed(points: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit keys of lattice points (in halves, hence whole numbers) after `start`."""
    halves = np.rint(points * 2).astype(np.int64).view(np.uint64)
    for k in range(halves.shape[1]):
        start = mix(start * np.uint64(0x100000001B3) + halves[:, k] + np.uint64(k + 1))
    return start


def cells(units: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the own cells (rows x TABLES) and of the visited ones (x TABLES x BLOCKS)."""
    n, dimensions = units.shape
    flat = units @ _projection(dimensions)
    own = np.empty((n, TABLES), dtype=np.int64)
    visited = np.empty((n, TABLES, BLOCKS), dtype=np.int64)
    salt = mix(labels.astype(np.int64).view(np.uint64) + np.uint64(dimensions << 40))
    for table in range(TABLES):
        begin = mix(salt + np.uint64(table + 1))
        blocks, nearby = [], []
        for block in range(BLOCKS):
            at = (table * BLOCKS + block) * e8.DIMENSIONS
            x = flat[:, at : at + e8.DIMENSIONS]
            point = e8.nearest(x)
            blocks.append(point)
            nearby.append(e8.neighbour(x, point))
        own[:, table] = _hashed(np.hstack(blocks), begin).view(np.int64)
        for block in range(BLOCKS):
            moved = [*blocks]
            moved[block] = nearby[block]
            visited[:, table, block] = _hashed(np.hstack(moved), begin).view(np.int64)
    return own, visited


def _digest(label: int | None, vector: list[float | None] | None) -> bytes | None:
    """What equal vectors of a label share; None for a vector that links with nothing."""
    if label is None or not vector or None in vector:
        return None
    values = np.array(vector, dtype=np.float64) + 0.0  # -0.0 becomes 0.0
    if not np.isfinite(values).all() or not values.any():
        return None
    head = f"{label}:".encode()
    return hashlib.blake2b(head + values.tobytes(), digest_size=16).digest()


def _digests() -> Callable[[Columns], Columns]:
    return lambda batch: {
        "vec_id": batch["vec_id"],
        "label": batch["label"],
        "embedding": batch["embedding"],
        "same": [_digest(a, b) for a, b in zip(batch["label"], batch["embedding"], strict=True)],
    }


def _units(vectors: list[list[float]]) -> np.ndarray:
    rows = np.array(vectors, dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # no square can over- or underflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _places() -> Callable[[Columns], Columns]:
    """key, node, own: a row per cell of each vector; vectors of one batch by dimension."""

    def run(batch: Columns) -> Columns:
        by_size: dict[int, list[int]] = {}
        for i, vector in enumerate(batch["embedding"]):
            by_size.setdefault(len(vector), []).append(i)
        keys, nodes, owns = [], [], []
        for rows in by_size.values():
            units = _units([batch["embedding"][i] for i in rows])
            own, visited = cells(units, np.array([batch["label"][i] for i in rows]))
            node = np.array([batch["node"][i] for i in rows], dtype=np.int64)
            visited = visited.reshape(len(rows), -1)
            keys += [own.ravel(), visited.ravel()]
            nodes += [np.repeat(node, own.shape[1]), np.repeat(node, visited.shape[1])]
            owns += [np.ones(own.size, dtype=bool), np.zeros(visited.size, dtype=bool)]
        if not keys:
            return {"key": [], "node": [], "own": []}
        return {
            "key": np.concatenate(keys),
            "node": np.concatenate(nodes),
            "own": np.concatenate(owns),
        }

    return run


def _meets(
    own_u: np.ndarray, visit_u: np.ndarray, own_v: np.ndarray, visit_v: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows: the first table in which they meet, and the least cell there."""
    no_key = np.iinfo(np.int64).max
    first = np.full(len(own_u), TABLES)
    cell = np.full(len(own_u), no_key)
    for table in reversed(range(TABLES)):
        a, b = own_u[:, table], own_v[:, table]
        at_a = (a == b) | (visit_v[:, table] == a[:, None]).any(axis=1)
        at_b = (a == b) | (visit_u[:, table] == b[:, None]).any(axis=1)
        here = at_a | at_b
        first[here] = table
        least = np.minimum(np.where(at_a, a, no_key), np.where(at_b, b, no_key))
        cell[here] = least[here]
    return first, cell


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row reachable by the links a-b, for each of n rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        moved = root.copy()
        np.minimum.at(moved, a, low)
        np.minimum.at(moved, b, low)
        moved = moved[moved]
        if (moved == root).all():
            return root
        root = moved


def _compared(group: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
    """node, links, to: what the rows of one block of a cell add."""
    key, i, j = group["key"][0], group["i"][0], group["j"][0]
    nodes, own, part = group["node"], group["own"], group["part"]
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    found_a, found_b = [], []
    units = _units(list(group["embedding"]))
    # slabs, so that the matrix of a block stays small
    for at in range(0, len(left), 512):
        rows = left[at : at + 512]
        near = (units[rows] @ units[right].T) >= SIMILARITY
        near &= own[rows][:, None] | own[right][None, :]
        if i == j:
            near &= rows[:, None] < right[None, :]
        a, b = np.nonzero(near)
        found_a.append(rows[a])
        found_b.append(right[b])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    same = (group["label"][a] == group["label"][b]) & (nodes[a] != nodes[b])
    a, b = a[same], b[same]
    if not len(a):
        return None
    own_cells, visited = cells(units, group["label"])
    counted = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 100_000):
        x, y = a[at : at + 100_000], b[at : at + 100_000]
        first, cell = _meets(own_cells[x], visited[x], own_cells[y], visited[y])
        table = np.where(own[x], (own_cells[x] == key).argmax(1), (own_cells[y] == key).argmax(1))
        counted[at : at + 100_000] = (first == table) & (cell == key)
    a, b = a[counted], b[counted]
    if not len(a):
        return None
    links = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(links, a, group["size"][b])
    np.add.at(links, b, group["size"][a])
    used = np.flatnonzero(links)
    to = nodes[_local_roots(len(nodes), a, b)]
    return {"node": nodes[used], "links": links[used], "to": to[used]}


_BLOCK = ("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of rows with an equal key and block, across the borders of batches."""
    held: list[pa.RecordBatch] = []
    current = None

    def group() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        columns = {
            c: table[c].to_numpy(zero_copy_only=False) for c in table.column_names if c != "embedding"
        }
        return columns | {"embedding": table["embedding"].to_pylist()}

    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).to_numpy(zero_copy_only=False) for c in _BLOCK]
        change = np.zeros(batch.num_rows, dtype=bool)
        for values in names:
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(starts, starts[1:], strict=False):
            name = tuple(int(values[lo]) for values in names)
            if held and name != current:
                yield group()
                held = []
            current = name
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield group()


def _blocks_compared(rows: DataFrame) -> DataFrame:
    """node, links, to from rows that are sorted by block within each partition."""
    schema = "node long, links long, to long"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if len(group["node"]) > 1:
                found = _compared(group)
                if found is not None:
                    yield pa.RecordBatch.from_pydict(found, schema=target)

    return rows.mapInArrow(run, schema)


def _dealt(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows of cells with their vectors, by block: a cell of p parts is p (p + 1) / 2
    blocks, and a row is in the p of them that hold its part."""
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))
    rows = members.withColumn("part", part).withColumn("other", other)
    return rows.join(vectors, "node").select(
        "key",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "part",
        "node",
        "own",
        "size",
        "label",
        "embedding",
    )


def embedding_duplicates(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    Vectors are compared if their labels are equal and not NULL and they have as many
    components. A vector that is NULL, empty, zero or holds NULL or a value that is not
    finite links with nothing, nor does one without vec_id (its component_id is NULL);
    these stay. Rows with an equal vec_id are vectors of their own: they are linked by
    what they hold, not by their id. Repeated rows link with each other. An empty table
    gives an empty one; further columns are ignored.
    """
    prepare(embeddings.sparkSession)
    rows = embeddings.select(
        "vec_id", F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    digests = map_columns(
        rows, _digests, "vec_id long, label long, embedding array<double>, same binary"
    ).withColumn("same", F.when(F.col("vec_id").isNotNull(), F.col("same")))
    digests = materialise(digests, "digests")
    classes = (
        digests.where(F.col("same").isNotNull())
        .groupBy("same")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("vec_id").alias("least"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = materialise(classes, "classes")
    vectors = classes.select("node", "size", "label", "embedding")
    places = materialise(
        map_columns(vectors, _places, "key long, node long, own boolean"), "places"
    )
    # a cell needs a member and another row; its keys are counted where they are made first
    live = (
        places.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("n_own"))
        .where("n > 1 AND n_own > 0")
        .select("key", F.ceil(F.col("n") / PART_ROWS).cast("long").alias("parts"))
    )
    members = places.join(materialise(live, "cells"), "key")
    blocks = _dealt(members, vectors).repartition("key", "i", "j")
    found = materialise(
        _blocks_compared(blocks.sortWithinPartitions("key", "i", "j")), "links"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    roots = connected_components(found.select("node", "to"), "node", "to")
    placed = classes.select("same", "size", "least", "node").join(
        roots, classes["node"] == roots["id"], "left"
    )
    placed = materialise(placed.withColumn("root", F.coalesce("root", "node")).drop("id"), "roots")
    lowest = placed.groupBy("root").agg(F.min("least").alias("component"))
    by_class = placed.join(lowest, "root").join(counts, "node", "left")
    by_class = by_class.select(
        "same", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("links"), "component"
    )
    component = F.coalesce("component", "vec_id")
    return (
        digests.select("vec_id", "same")
        .join(materialise(by_class, "by-class"), "same", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )

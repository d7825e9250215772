"""Near-duplicates among embeddings by sorted projection passes.

Each pass has 64 random hyperplanes; a vector's code is the concatenated sides it lies on.
All passes are sorted at once, by pass, label, dimension and code, and the order is cut into
tiles of `TILE` vectors. A tile is compared with itself and the next tile, as matrix
products, and with further ones for as long as the last tile still held a vector linked
to it: where near copies fill the window, it grows until they end. Linked pairs are
verified by cosine in double precision, so no pair below the threshold links; one above it
is missed only if no pass brings it together, which gets rarer with each pass (README).

A pair that several passes find counts in the first of them only: each vector carries its
tiles of all passes, which tell whether an earlier pass has compared the two. No pairs leave a
task, but for each vector its number of links and one edge to the smallest vector it is
connected with there.

Equal vectors of a label are one class with a count. Nulls: vectors that are null, empty, zero or
hold null or non-finite components, or have no label, link with nothing and are their own
component. Vectors of different dimension never link. Every row is a vector of its own,
repeated ids included; a null id names a component only if it has no other. Further columns are left
alone; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from lotewise.llm.components import connected_components
from lotewise.operators.joins import many_to_one
from lotewise.session import keep

COSINE = 0.98
PASSES = 6
TILE = 512


def codes(vectors: pa.Array) -> pa.Array:
    """The 64-bit code of each pass, for each vector."""
    rows = [np.asarray(v, np.float64) for v in vectors.to_numpy(zero_copy_only=False)]
    out = np.zeros((len(rows), PASSES), np.int64)
    for size in {len(r) for r in rows}:
        planes = np.random.default_rng(size).standard_normal((size, 64 * PASSES))
        at = [i for i, r in enumerate(rows) if len(r) == size]
        sides = (np.stack([rows[i] for i in at]) @ planes > 0).reshape(len(at), PASSES, 64)
        out[at] = np.packbits(sides, axis=2).view(">i8")[:, :, 0]
    return pa.array(list(out), pa.list_(pa.int64()))


def _sound() -> Column:
    """Whether a vector can link at all."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that can link, with the key of their vector, and one row for each distinct
    vector of a label: node, label, embedding, copies."""
    keyed = vectors.filter(_sound()).select(
        "vec_id",
        "label",
        F.xxhash64("embedding").alias("k1"),
        F.xxhash64(F.reverse("embedding"), F.lit(1)).alias("k2"),
        "embedding",
    )
    distinct = keyed.groupBy("label", "k1", "k2").agg(
        F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies")
    )
    return keyed.drop("embedding"), keep(distinct.withColumn("node", F.monotonically_increasing_id()), "classes")


def tiled(distinct: DataFrame) -> DataFrame:
    """`distinct` with `tiles`, the number of its tile in each pass; tiles are numbered
    through all passes, so that a tile and the next one are neighbours in the order."""
    code = F.arrow_udf(codes, ArrayType(LongType()))("embedding")
    rows = keep(distinct.select("node", "label", F.size("embedding").alias("dim"), code.alias("code")), "codes")
    exploded = rows.select(F.posexplode("code").alias("pass", "code"), "label", "dim", "node")
    order = ["pass", "label", "dim", "code", "node"]
    placed = keep(
        exploded.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("node", "pass", F.monotonically_increasing_id().alias("id")),
        "order",
    )
    parted = placed.withColumns({"part": F.shiftright("id", 33), "at": F.col("id").bitwiseAND((1 << 33) - 1)})
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each partition
    shift = parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    tile = F.floor((F.col("shift") + F.col("at")) / TILE)
    tiles = parted.join(shift, "part").groupBy("node").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pass", tile.alias("tile")))), lambda x: x["tile"]).alias("tiles")
    )
    return keep(distinct.select("node", "label", "embedding", "copies").join(tiles, "node"), "tiled")


def _dealt(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The vectors of each pair of tiles (tile, step), the pair's own tile first."""
    by_tile = rows.select("*", F.posexplode("tiles").alias("pass", "own"))
    first = by_tile.join(pairs.select(F.col("tile").alias("own"), "step"), "own").select(
        F.col("own").alias("tile"), "step", F.lit(0).alias("side"), "pass", *rows.columns
    )
    second = by_tile.join(
        pairs.filter("step > 0").select((F.col("tile") + F.col("step")).alias("own"), "step"), "own"
    ).select((F.col("own") - F.col("step")).alias("tile"), "step", F.lit(1).alias("side"), "pass", *rows.columns)
    key = ["tile", "step"]
    return first.unionByName(second).repartition(*key).sortWithinPartitions(*key, "side")


def _by_pair(work: Callable) -> Callable:
    """Calls `work` with the columns of one pair of tiles at a time; at most two tiles are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            t, s = (held.column(c).to_numpy() for c in ("tile", "step"))
            starts = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (s[1:] != s[:-1])))
            for a, b in zip(starts[:-1], starts[1:]):
                yield work(held.slice(a, b - a))
            held = held.slice(starts[-1])
        if held is not None:
            yield work(held)

    return run


def _linked(pair: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs, each once: both within the first tile, or across."""
    passes, labels, side = (pair.column(c).to_numpy() for c in ("pass", "label", "side"))
    vectors = [np.asarray(v, np.float64) for v in pair.column("embedding").to_numpy()]
    size = np.array([len(v) for v in vectors])
    step = pair.column("step")[0].as_py()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    group = np.stack([passes, labels, size])
    for one in np.unique(group, axis=1).T:
        at = np.flatnonzero((group == one[:, None]).all(0))
        x = np.stack([vectors[i] for i in at])
        x = x / np.abs(x).max(1, keepdims=True)  # so that squares of large components stay finite
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        left, right = (at, at) if not step else (at[side[at] == 0], at[side[at] == 1])
        y = x if not step else x[side[at] == 1]
        z = x if not step else x[side[at] == 0]
        near = z @ y.T >= COSINE
        i, j = np.nonzero(np.triu(near, 1) if not step else near)
        found.append((left[i], right[j]))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def reach(rows: DataFrame) -> DataFrame:
    """(tile, reach): how many tiles ahead a tile is compared, one at least.

    Round k compares the tiles that were linked in round k - 1 with the k-th tile ahead,
    until no tile is; there are as many rounds as the longest run of near copies has tiles."""

    def touches(pair: pa.Table) -> pa.RecordBatch:
        t, s = pair.column("tile")[0].as_py(), pair.column("step")[0].as_py()
        hit = len(_linked(pair)[0]) > 0
        return pa.RecordBatch.from_arrays(
            [pa.array([t] * hit, pa.int64()), pa.array([s] * hit, pa.int32())], names=["tile", "step"]
        )

    every = rows.select(F.explode("tiles").alias("tile")).distinct().withColumn("step", F.lit(1))
    hits, step = None, 1
    while True:
        pairs = every if hits is None else hits.select("tile", F.lit(step).alias("step"))
        hits = keep(_dealt(rows, pairs).mapInArrow(_by_pair(touches), "tile long, step int"), "reach")
        if hits.isEmpty():
            break
        every = every.unionByName(hits.select("tile", (F.col("step") + 1).alias("step")))
        step += 1
    return every.groupBy("tile").agg(F.max("step").alias("reach"))


def compared(rows: DataFrame, far: DataFrame) -> DataFrame:
    """(node, links, near): what each pair of tiles adds to the links of a vector, and the
    smallest node it is connected with there."""
    reached = rows.select("node", F.posexplode("tiles").alias("pass", "tile")).join(far, "tile")
    reaches = reached.groupBy("node").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pass", "reach"))), lambda x: x["reach"]).alias("reaches")
    )
    full = rows.join(reaches, "node")
    pairs = far.select("tile", F.explode(F.sequence(F.lit(0), "reach")).alias("step"))

    def count(pair: pa.Table) -> pa.RecordBatch:
        i, j = _linked(pair)
        node, copies, passes = (pair.column(c).to_numpy() for c in ("node", "copies", "pass"))
        tiles, reaches = (np.stack(pair.column(c).to_numpy()) for c in ("tiles", "reaches"))
        gap = tiles[j] - tiles[i]
        before = np.arange(tiles.shape[1]) < passes[i][:, None]
        seen = (np.abs(gap) <= np.where(gap >= 0, reaches[i], reaches[j])) & before
        fresh = ~seen.any(1)
        links = np.bincount(i[fresh], copies[j[fresh]], len(node)) + np.bincount(j[fresh], copies[i[fresh]], len(node))
        low = node.copy()
        while True:
            last = low.copy()
            least = np.minimum(low[i], low[j])
            np.minimum.at(low, i, least)
            np.minimum.at(low, j, least)
            if (low == last).all():
                break
        at = np.flatnonzero((links > 0) | (low != node))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[at]), pa.array(links[at].astype(np.int64)), pa.array(low[at])], names=["node", "links", "near"]
        )

    return _dealt(full, pairs).mapInArrow(_by_pair(count), "node long, links long, near long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding, label)."""
    vectors = vectors.select("vec_id", "embedding", "label")
    keyed, distinct = classes(vectors)
    rows = tiled(distinct)
    found = keep(compared(rows, keep(reach(rows), "far")), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("near").alias("a"), F.col("node").alias("b")))
    of_class = (
        distinct.select("label", "k1", "k2", "node", "copies")
        .join(links, "node", "left")
        .join(joined, "node", "left")
        .select(
            "label", "k1", "k2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("root"),
        )
    )
    linked = keep(many_to_one(keyed, of_class, ["label", "k1", "k2"]).select("vec_id", "n_links", "root"), "linked")
    names = linked.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    inside = many_to_one(linked, names, ["root"]).select("vec_id", "n_links", "component_id")
    alone = vectors.filter(~_sound()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

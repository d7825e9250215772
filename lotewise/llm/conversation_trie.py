"""The prefix trie of conversations, by sorted shards and a skeleton of splitters.

A conversation is the path of its turns. Paths are range-partitioned and sorted, so that the
members of a node stand together; a node can reach over the end of a shard only if it lies on
what the last path before and the first path after that end have in common. These splitter
paths are the skeleton. It is broadcast while it is small (`BROADCAST` bytes; beyond that each
shard gets its two paths by a join), and every shard finishes all other nodes by one walk over
its paths. Nodes of the skeleton leave a shard as partial sums, which one reduction
combines; what hangs below them is then added up along their ancestors, of which there are
as many as a splitter path has turns.

Copies of one conversation are sorted by id after their path, so a group of any size is cut into
shards like the rest, and its node is part of the skeleton. The digest of its ids needs them in one
order: shards write them down as text, and one task reads these texts in turn, holding one at a time.

A conversation is one row, 24 bytes a turn, as a text is in other operators. Null role or
text counts as empty. Turns of one conversation are ordered by turn, null first, and by role and text's
digest where turns tie; repeated rows are turns of their own. Rows without a conv_id belong to no
conversation and are left out. Further columns are left alone; no conversations give no rows,
not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotewise.llm.common import WORD
from lotewise.operators.joins import many_to_one
from lotewise.session import keep

BROADCAST = 16 << 20
#: Ids of one piece of a skeleton node's list.
PIECE = 4096
ROOT = bytes(16)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's (turn, step, words) in order; a step is the digest
    of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    step = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    said = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", step.alias("step"), words.alias("words")).alias("t")
    )
    return said.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_heads(talks: DataFrame, block: int = 20, most: int = 3) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % block instead of
    its own; h = crc32(c) % (most + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = talks.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, most).alias("head")
    )
    mine = talks.withColumns({"first": F.col("conv_id") - F.col("conv_id") % block, "h": h})
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return mine.join(heads, "first", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _common(a: Column, b: Column) -> Column:
    """The steps that two paths begin with alike."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.slice(a, F.lit(1), F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int"))


def skeleton(paths: DataFrame) -> DataFrame:
    """(shard, left, right): the splitter paths at both ends of each shard, empty at the outer ends."""
    ends = keep(paths.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")), "ends")
    order = W.orderBy("shard")  # one row for each shard
    none = F.slice("low", 1, 0)
    return keep(
        ends.withColumns({"before": F.lag("high").over(order), "after": F.lead("low").over(order)}).select(
            "shard",
            F.when(F.col("before").isNotNull(), _common(F.col("before"), F.col("low"))).otherwise(none).alias("left"),
            F.when(F.col("after").isNotNull(), _common(F.col("high"), F.col("after"))).otherwise(none).alias("right"),
        ),
        "skeleton",
    )


FOUND = (
    "kind string, key binary, parent_key binary, line array<binary>, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved long, words long, ends string"
)


def _digest(conv_ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, conv_ids)).encode()).hexdigest()


def _shared(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


class _Walk:
    """One walk over the sorted paths of a shard. `open` holds the nodes of the current path,
    root first; a node is closed once a path leaves it, and its sums go to its parent."""

    def __init__(self, left: list[bytes], right: list[bytes]):
        self.splitters, self.open, self.path, self.out = (left, right), [], [], []

    def enter(self, path: list[bytes], words: list[int], conv_id: int) -> None:
        stay = _shared(path, self.path) + 1 if self.open else 0
        self.leave(stay)
        shared = max(_shared(path, s) for s in self.splitters)
        for depth in range(stay, len(path) + 1):
            above = self.open[-1] if self.open else None
            key = hashlib.md5(above["key"] + path[depth - 1]).digest() if above else ROOT
            self.open.append(
                dict(key=key, depth=depth, split=depth <= shared, words=words[depth - 1] if depth else 0, conv_id=conv_id,
                     n_convs=0, n_children=0, n_leaves=0, saved=0, ends=[], below=[])
            )
        self.path = path
        top = self.open[-1]
        top["n_convs"] += 1
        top["conv_id"] = min(top["conv_id"], conv_id)
        top["ends"].append(conv_id)

    def leave(self, stay: int) -> None:
        while len(self.open) > stay:
            node, above = self.open.pop(), self.open[-1] if self.open else None
            if above:
                above["n_convs"] += node["n_convs"]
                above["conv_id"] = min(above["conv_id"], node["conv_id"])
            for child in node["below"]:
                child["parent_conv_id"] = node["conv_id"]
            if node["split"]:
                line = [n["key"] for n in self.open] + [node["key"]]
                part = {k: v for k, v in node.items() if k not in ("split", "ends", "below")}
                self.out.append(part | dict(kind="part", parent_key=above and above["key"], line=line))
                for at in range(0, len(node["ends"]), PIECE):
                    ids = node["ends"][at : at + PIECE]
                    self.out.append(dict(kind="ends", key=node["key"], conv_id=ids[0], ends=",".join(map(str, ids))))
                continue
            node["saved"] += (node["n_convs"] - 1) * node["words"]
            node["n_leaves"] += not node["n_children"]
            row = {k: node[k] for k in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved")}
            self.out.append(row | dict(kind="node", ends=_digest(node["ends"])))
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved"] += node["saved"]
            if above["split"]:  # its smallest member is known after the reduction
                self.out[-1]["parent_key"] = above["key"]
            else:
                above["below"].append(self.out[-1])


def _finish(shard: pa.Table, left: list[bytes], right: list[bytes], schema: pa.Schema) -> pa.Table:
    walk = _Walk(left, right)
    rows = shard.select(["path", "words", "conv_id"]).to_pylist()
    for row in sorted(rows, key=lambda r: (r["path"], r["conv_id"])):
        walk.enter(row["path"], row["words"], row["conv_id"])
    walk.leave(0)
    return pa.Table.from_pylist(walk.out, schema)


def _found(paths: DataFrame) -> DataFrame:
    """What the shards make of their paths: finished nodes, parts of skeleton nodes, lists of ids."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, splits = paths.sparkSession, skeleton(paths)
    schema = to_arrow_schema(spark.createDataFrame([], FOUND).schema)
    steps = splits.select(F.sum((F.size("left") + F.size("right")) * 16 + 32)).first()[0] or 0
    if steps <= BROADCAST:
        table = spark.sparkContext.broadcast({s: (left, right) for s, left, right in _plain(splits)})
        return paths.groupBy("shard").applyInArrow(
            lambda shard: _finish(shard, *table.value[shard["shard"][0].as_py()], schema), FOUND
        )

    def beside(shard: pa.Table, ends: pa.Table) -> pa.Table:
        return _finish(shard, ends["left"][0].as_py(), ends["right"][0].as_py(), schema)

    return paths.groupBy("shard").cogroup(splits.groupBy("shard")).applyInArrow(beside, FOUND)


def _plain(splits: DataFrame) -> list[tuple[int, list[bytes], list[bytes]]]:
    return [(s, [bytes(x) for x in left], [bytes(x) for x in right]) for s, left, right in splits.collect()]


def _lists(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256): pieces of a node's ids are read in order, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    done += [(key, state.hexdigest())] if key is not None else []
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield _pairs(done)
        if key is not None:
            yield _pairs([(key, state.hexdigest())])

    ordered = pieces.select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([k for k, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "ends_sha256"])


def _reduced(found: DataFrame) -> DataFrame:
    """The nodes of the skeleton from the parts that the shards have left."""
    parts = found.filter("kind = 'part'").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("line").alias("line"), F.max("depth").alias("depth"),
        F.max("words").alias("words"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    parts = keep(parts, "parts")
    inner = parts.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("inner")
    )
    whole = parts.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0)))
    own = whole.select(
        F.explode("line").alias("key"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
    )
    below = own.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return keep(
        whole.drop("saved", "n_leaves", "inner", "line", "words")
        .join(below, "key")
        .join(_lists(found.filter("kind = 'ends'")), "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)),
        "reduced",
    )


def prefix_trie(talks: DataFrame) -> DataFrame:
    """A row for each node of the trie of `talks` (conv_id, turns: step and words of each)."""
    order = ["path", "conv_id"]
    paths = talks.select("conv_id", F.col("turns.step").alias("path"), F.col("turns.words").alias("words"))
    paths = keep(
        paths.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id()), "paths"
    )
    found = keep(_found(paths), "found")
    split = _reduced(found)
    above = split.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    finished = found.filter("kind = 'node'").withColumnsRenamed({"ends": "ends_sha256", "saved": "saved_tokens"})
    inside = finished.filter("parent_key is null").select(columns)
    edge = many_to_one(finished.filter("parent_key is not null"), above, ["parent_key"])
    top = split.withColumnRenamed("saved", "saved_tokens").join(above, "parent_key", "left")
    return inside.unionByName(edge.withColumn("parent_conv_id", F.col("above")).select(columns)).unionByName(
        top.withColumn("parent_conv_id", F.col("above")).select(columns)
    )

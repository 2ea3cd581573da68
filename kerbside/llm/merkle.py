"""Merkle manifest of a dataset, climbed by a recursive query.

Every row is a leaf, the SHA-256 of its fields. The leaves of a group ascend by id; runs of eight
neighbours become their hash, level by level, until one node remains, the group's subroot. The subroots,
ordered by group, are the leaves of a top tree that ends in the dataset's root.

The levels are built bottom-up, one aggregation each, and stored as parent-linked rows: a row is a run, with its
children's hashes and the place of its own hash in the run above. A recursive query then ascends from every
leaf: each step joins a leaf with the run above it, appends the siblings it finds there to the proof and folds
the leaf's hash (of the row as it is now, perhaps tampered with) into the run's. The steps of a leaf are rows
of the recursion's result, so a step carries one hash, not the proof so far, and what is moved grows with the
number of levels, not with its square.

Near the root every leaf meets the same run. A leaf's place in the whole order, divided by 4096, is part of
the join key, and a run has a row for each block of leaves below it, so no key holds more than 4096 leaves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# Eight children to a run, 4096 leaves to a block.
ARITY_BITS, BLOCK_BITS = 3, 12
ARITY = 1 << ARITY_BITS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1  # the tree over the subroots; the groups' trees are numbered from 0


def field(value: Column) -> Column:
    """A value as it enters a leaf: `-` for null, else its UTF-8 length, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def every_third(doc_id: Column) -> Column:
    """Whether 3 divides the CRC-32 of the decimal id; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


@dataclass(frozen=True)
class Manifest:
    """A built tree. `leaves` and `runs` are stored tables; `root` is the hex hash, None without rows."""

    leaves: DataFrame
    runs: DataFrame
    root: str | None


def build(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    now: dict[str, Column] | None = None,
) -> Manifest:
    """Hash the rows of `docs` and build all levels.

    `now` gives fields that may have changed since (column -> present value); the leaf that results is kept
    beside the original as `present`. Rows without id come first in their group, rows without group are
    a group of their own, the first; rows with equal ids are ordered by their hash. The group table (one row per
    group and input partition) is ordered in one task.
    """
    changed = now or {}
    original = leaf_hash(*[F.col(c) for c in fields])
    present = leaf_hash(*[changed.get(c, F.col(c)) for c in fields])
    hashed = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("grp"), original.alias("leaf"),
        # Equal in most rows, where it need not be kept twice.
        F.nullif(present, original).alias("changed"),
    )
    # The texts are read and hashed once; sampling for the ranges reads the narrow copy.
    narrow = written(hashed, "leaf_hashes")
    ordered = written(
        narrow.repartitionByRange("grp", "id", "leaf").withColumn("part", F.spark_partition_id()), "ordered_leaves"
    )
    sizes = written(_placed_groups(ordered.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("m"))), "groups")
    nth = F.row_number().over(Window.partitionBy("part", "grp").orderBy("id", "leaf")) - 1
    joined = ordered.withColumn("nth", nth).alias("o").join(
        sizes.alias("s"), (F.col("o.part") == F.col("s.part")) & F.col("o.grp").eqNullSafe(F.col("s.grp"))
    )
    place = F.col("s.start") + F.col("nth")
    leaves = written(
        joined.select(
            "o.id", "o.leaf", "o.changed", "s.tree", place.alias("place"),
            (place - F.col("s.tree_start")).alias("node"), "s.n",
        ),
        "leaves",
    )
    bounds = sizes.agg(F.max("n").alias("n"), F.max("tree").alias("last")).first()
    if bounds["n"] is None:
        return Manifest(_linked(leaves, 0), _by_block(_no_runs(leaves)), None)
    groups = bounds["last"] + 1
    tree_level = leaves.select(
        "tree", "node", "n", F.col("leaf").alias("hash"), F.col("place").alias("lo"), F.col("place").alias("hi")
    )
    runs, tops = _levels(tree_level, bounds["n"], groups)
    if groups > 1:
        top_level = reduce(DataFrame.unionByName, tops).select(
            F.lit(TOP).alias("tree"), F.col("tree").cast("bigint").alias("node"),
            F.lit(groups).cast("bigint").alias("n"), "hash", "lo", "hi",
        )
        top_runs, tops = _levels(top_level, groups, groups)
        runs += top_runs
    root = reduce(DataFrame.unionByName, tops).where("n > 0").agg(F.max("hash").alias("hash")).first()["hash"]
    table = reduce(DataFrame.unionByName, runs) if runs else _no_runs(leaves)
    return Manifest(_linked(leaves, groups), written(_by_block(table), "runs"), root)


def _placed_groups(counts: DataFrame) -> DataFrame:
    """(part, grp, tree, start, tree_start, n): each group's number and size and where its rows begin."""
    before = Window.orderBy("part", "grp").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("start", F.coalesce(F.sum("m").over(before), F.lit(0)))
    group = Window.partitionBy("grp")
    return placed.select(
        "part", "grp", "start", (F.dense_rank().over(Window.orderBy("grp")) - 1).alias("tree"),
        F.min("start").over(group).alias("tree_start"), F.sum("m").over(group).alias("n"),
    )


def _levels(nodes: DataFrame, largest: int, groups: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of every level above `nodes`, each level written, and the last node of every tree."""
    runs, tops = [], [nodes.where("n = 1")]
    level, width = 0, 1
    while width < largest:
        level, width = level + 1, width * ARITY
        child = F.struct((F.col("node") % ARITY).alias("pos"), F.col("hash"))
        above = (
            nodes.where(F.col("n") > width // ARITY)
            .groupBy("tree", F.shiftright("node", ARITY_BITS).alias("node"), "n")
            .agg(
                F.array_join(F.transform(F.sort_array(F.collect_list(child)), lambda c: c["hash"]), "").alias("children"),
                F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            )
            .withColumn("hash", F.sha2("children", 256))
        )
        stored = written(
            above.select("tree", F.lit(level).alias("level"), "node", "n", "hash",
                         F.unhex("children").alias("children"), "lo", "hi"),
            "level",
        )
        nodes = stored.select("tree", "node", "n", "hash", "lo", "hi")
        tops.append(nodes.where(F.col("n") <= width))
        runs.append(_with_parent(stored, F.col("n") <= width, F.lit(level), groups))
    return runs, tops


def _with_parent(rows: DataFrame, is_top: Column, level: Column, groups: int) -> DataFrame:
    """Rows plus the link to the run above: its tree, level and node, and the place in it; null above the root.

    `subroot` is the hash where a group's tree ends.
    """
    to_top = is_top & (F.col("tree") != TOP) & F.lit(groups > 1)
    climbs = to_top | ~is_top
    at = F.when(to_top, F.col("tree").cast("bigint")).otherwise(F.col("node"))
    return rows.withColumns({
        "up_tree": F.when(to_top, F.lit(TOP)).when(climbs, F.col("tree")),
        "up_level": F.when(climbs, F.when(to_top, F.lit(1)).otherwise(level + 1)),
        "up_node": F.when(climbs, F.shiftright(at, ARITY_BITS)),
        "up_pos": F.when(climbs, (at % ARITY).cast("int")),
        "subroot": F.when(is_top & (F.col("tree") != TOP), F.unhex("hash")),
    }).drop("n", "hash")


def _linked(leaves: DataFrame, groups: int) -> DataFrame:
    """Leaves with the link to the run above them and their block."""
    return _with_parent(
        leaves.withColumn("hash", F.col("leaf")), F.col("n") == 1, F.lit(0), groups
    ).withColumn("block", F.shiftright("place", BLOCK_BITS))


def _by_block(runs: DataFrame) -> DataFrame:
    """A row for each block of leaves below a run."""
    blocks = F.sequence(F.shiftright("lo", BLOCK_BITS), F.shiftright("hi", BLOCK_BITS))
    return runs.select("*", F.explode(blocks).alias("block")).drop("lo", "hi")


def _no_runs(leaves: DataFrame) -> DataFrame:
    return leaves.sparkSession.createDataFrame(
        [], "tree int, level int, node bigint, children binary, lo bigint, hi bigint, up_tree int, up_level int, "
        "up_node bigint, up_pos int, subroot binary",
    )


CLIMB = """
WITH RECURSIVE climb (tree, place, step, id, leaf, block, up_tree, up_level, up_node, up_pos, subroot, folded, siblings)
MAX RECURSION LEVEL 1000 AS (
  SELECT tree, place, 0, id, leaf, block, up_tree, up_level, up_node, up_pos, subroot,
         unhex(coalesce(changed, leaf)), cast(null AS binary)
  FROM {leaves}
  UNION ALL
  SELECT c.tree, c.place, c.step + 1, cast(null AS {id_type}), cast(null AS string), c.block,
         r.up_tree, r.up_level, r.up_node, r.up_pos, r.subroot,
         unhex(sha2(lower(hex(concat(
           substring(r.children, 1, 32 * c.up_pos), c.folded, substring(r.children, 32 * c.up_pos + 33)))), 256)),
         concat(substring(r.children, 1, 32 * c.up_pos), substring(r.children, 32 * c.up_pos + 33))
  FROM climb c JOIN {runs} r
    ON r.tree = c.up_tree AND r.level = c.up_level AND r.node = c.up_node AND r.block = c.block
)
SELECT * FROM climb LIMIT ALL
"""


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: id, leaf, subroot, proof, folded_root, root, verified.

    `proof` is an array with the siblings' hashes of every level as hex text, from the leaf's run to the root,
    each level's from left to right in one string ("" for an only child). `folded_root` is what the present leaf
    gives with these siblings, and `verified` whether that is the root. Hashes are lowercase hex.
    """
    spark = manifest.leaves.sparkSession
    id_type = manifest.leaves.schema["id"].dataType.simpleString()
    climb = spark.sql(CLIMB.replace("{id_type}", id_type), leaves=manifest.leaves, runs=manifest.runs)
    step = F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))
    per_leaf = climb.groupBy("tree", "place").agg(
        F.max("id").alias("id"), F.max("leaf").alias("leaf"), F.max("subroot").alias("subroot"),
        F.sort_array(F.collect_list(step)).alias("steps"),
        F.max(F.when(F.col("up_tree").isNull(), F.col("folded"))).alias("folded"),
    )
    lower = lambda b: F.lower(F.hex(b))
    root = F.lit(manifest.root).cast("string")
    return per_leaf.select(
        "id", "leaf", lower(F.col("subroot")).alias("subroot"),
        F.transform("steps", lambda s: lower(s["siblings"])).alias("proof"),
        lower(F.col("folded")).alias("folded_root"), root.alias("root"),
        (lower(F.col("folded")) == root).alias("verified"),
    )

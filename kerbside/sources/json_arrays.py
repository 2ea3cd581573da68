"""Files that hold one JSON array of objects, read by many tasks.

Spark parses a multi-line JSON file in one task. Here a file is split like any text, at closing braces, and the
starts of the records are found in parallel: whether a piece begins inside a string depends on the quotes before
it, and how deep it lies on the brackets before it that are outside strings. Both are prefix sums, over the pieces
of a block in the block's task and over the blocks of a file among themselves. A block is a stretch of a split with so many
pieces at most, so what a task holds of one at a time does not grow with the splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .readers import CORRUPT

_BLOCK = ["_path", "_start", "_part"]
_PIECES = (_BLOCK, ["_nth"])  # pieces of a block
_BLOCKS = (["_path"], ["_start", "_part"])  # blocks of a file

# Pieces of a block, at most.
BLOCK_PIECES = 8192
# A task of either shuffle takes about this much of the files.
TASK_BYTES = 8 << 20


def _sum_before(column: str, rows: tuple[list[str], list[str]]) -> Column:
    """The sum of a column over the rows before this one."""
    group, order = rows
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def _depth(outside: Column) -> Column:
    """Opening brackets less closing ones, of text that holds nothing else."""
    return F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))


def _listed(paths: str | Sequence[str]) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def _tasks(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """Tasks for a shuffle of the text. Its size as shuffled, packed to a tenth, would let too much into one."""
    sizes = spark.read.format("binaryFile").load(_listed(paths)).agg(F.sum("length"), F.count(F.lit(1)))
    size = sizes.first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    return max(-(-size // TASK_BYTES), min(cores, -(-size // (TASK_BYTES // 8))), 1)


def _pieces(spark: SparkSession, paths: str | Sequence[str], tasks: int | None = None) -> DataFrame:
    """The text between closing braces, in order within its block of a file.

    `_quotes` is 1 where a piece holds an odd number of quotes, so that its end is in a string if its start is
    not; `_depth_out` and `_depth_in` are its change of depth if it starts outside or inside a string, its
    closing brace included. No escape reaches across a closing brace, as none is written with one.
    """
    text = spark.read.option("lineSep", "}").text(_listed(paths))
    # Quotes and brackets are all that is looked at; they are picked out and counted before the text moves.
    signs = F.regexp_replace("value", r'(?s)\\.|[^"\\\[\]{}]+', "")
    signed = text.select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_nth"),
        F.floor(F.monotonically_increasing_id() / BLOCK_PIECES).alias("_part"),
        F.octet_length("value").alias("_length"),
        F.col("value").alias("_text"),
        signs.alias("_signs"),
    )
    string = r'"[^"]*("|\z)'
    outside = F.regexp_replace("_signs", string, "")
    rest = F.regexp_replace(F.regexp_replace("_signs", r'^[^"]*("|\z)', ""), string, "")
    quotes = F.pmod(F.length(F.translate("_signs", "[]{}", "")), F.lit(2)).cast("int")
    # The closing brace counts where the piece ends outside a string.
    counted = signed.withColumns({
        "_quotes": quotes,
        "_depth_out": _depth(outside) - F.when(quotes == 0, 1).otherwise(0),
        "_depth_in": _depth(rest) - F.when(quotes == 1, 1).otherwise(0),
    })
    return counted.drop("_signs").repartition(tasks or _tasks(spark, paths), *_BLOCK)


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with where they start: `_in` a string or not, at which depth; `_ends` a record or not.

    What a piece adds to the depth depends on the quotes before it in its file, so each block is summed up for
    both cases, and the blocks of a file are told apart from first to last. A block's summary is one row.
    """
    local = pieces.withColumn("_odd", F.pmod(_sum_before("_quotes", _PIECES), F.lit(2)))
    both = local.withColumns({
        "_if_out": F.when(F.col("_odd") == 0, F.col("_depth_out")).otherwise(F.col("_depth_in")),
        "_if_in": F.when(F.col("_odd") == 0, F.col("_depth_in")).otherwise(F.col("_depth_out")),
    })
    blocks = both.groupBy(*_BLOCK, "_size").agg(
        F.sum("_quotes").alias("_q"), F.sum("_if_out").alias("_o"), F.sum("_if_in").alias("_i"),
        F.sum(F.col("_length") + 1).alias("_bytes"), F.max("_nth").alias("_newest"),
    )
    started = blocks.withColumn("_block_in", F.pmod(_sum_before("_q", _BLOCKS), F.lit(2)))
    started = started.withColumn("_d", F.when(F.col("_block_in") == 0, F.col("_o")).otherwise(F.col("_i")))
    # The last piece of a file has no brace behind it unless the file ends there; a byte order mark is not read.
    whole = Window.partitionBy("_path")
    open_end = ~(F.sum("_bytes").over(whole) - F.col("_size")).isin(0, -3)
    last = F.when(
        open_end & (F.struct("_start", "_part") == F.max(F.struct("_start", "_part")).over(whole)), F.col("_newest")
    )
    started = started.select(
        *_BLOCK, "_block_in", _sum_before("_d", _BLOCKS).alias("_block_depth"), last.alias("_unended")
    )
    known = both.join(started, _BLOCK)
    known = known.withColumns({
        "_in": F.pmod(F.col("_odd") + F.col("_block_in"), F.lit(2)),
        "_change": F.when(F.col("_block_in") == 0, F.col("_if_out")).otherwise(F.col("_if_in")),
    })
    known = known.withColumn("_depth", F.col("_block_depth") + _sum_before("_change", _PIECES))
    ends_out = F.pmod(F.col("_in") + F.col("_quotes"), F.lit(2)) == 0
    # A closing brace that leads back to the array's own depth, or out of a broken file's, ends a record.
    ends = ends_out & (F.col("_depth") + F.col("_change") <= 1) & ~F.col("_nth").eqNullSafe(F.col("_unended"))
    return known.withColumn("_ends", ends.cast("int")).select(*_BLOCK, "_nth", "_text", "_ends")


def record_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(_path, _text): the elements of every file's array as text.

    The pieces of a record are gathered where they lie; then what a block begins or ends with, the parts of a
    record that reaches over blocks, meets in a second exchange, which whole records pass through rather than being
    made twice. Text after the last closing brace is a
    row of its own unless it just closes the array, so a file that was cut off shows.
    """
    tasks = _tasks(spark, paths)
    placed = _placed(_pieces(spark, paths, tasks))
    local = placed.withColumn("_record", _sum_before("_ends", _PIECES))
    parts = local.groupBy(*_BLOCK, "_record").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_nth", "_text"))), lambda p: p["_text"]), "}"
        ).alias("_text"),
        F.max("_ends").alias("_ends"),
    )
    # The first record of a block may have begun before it, the last may go on after it.
    whole = (F.col("_record") > 0) & (F.col("_ends") == 1)
    carried = parts.where(~whole).groupBy(*_BLOCK).agg(F.sum("_ends").alias("_closed"))
    carried = carried.select(*_BLOCK, _sum_before("_closed", _BLOCKS).alias("_closed_before"))
    # An edge that ends no record belongs to the one that the next block with an end closes.
    edge = F.col("_closed_before") + F.when(F.col("_record") == 0, 0).otherwise(1)
    key = F.when(whole, F.struct("_start", "_part", "_record")).otherwise(
        F.struct(F.lit(-1).cast("bigint").alias("_start"), F.lit(-1).cast("bigint").alias("_part"), edge.alias("_record"))
    )
    found = (
        parts.join(carried, _BLOCK, "left")
        .withColumn("_key", key)
        .repartition(tasks, "_path", "_key")
        .groupBy("_path", "_key")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_start", "_part", "_record", "_text"))), lambda p: p["_text"]
                ),
                "}",
            ).alias("_text"),
            F.max("_ends").alias("_ends"),
        )
    )
    # Elements follow a bracket or a comma; the brace that ends one was taken by the split.
    bare = F.regexp_replace("_text", r"^\s*[\[,]?\s*", "")
    text = F.when(F.col("_ends") == 1, F.concat(bare, F.lit("}"))).otherwise(bare)
    closing = (F.col("_ends") == 0) & F.regexp_like("_text", F.lit(r"^\s*(\[\s*)?\]?\s*\z"))
    return found.where(~closing).select("_path", text.alias("_text"))


def read_json_array(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """As `read_json` with `multiline` over files that are arrays of objects, but each file by many tasks.

    Columns of `schema`, the corrupt record and the path of the row's file as `_path`. An empty array gives no
    row. A record that is no object of this shape, text between or after the records, and the rest of a file
    after a quote or brace too few are unreadable records; the last holds that rest whole, as Spark's own
    reading would hold the file. A file that ends right after a record, its bracket missing, has all its records.
    Files must be UTF-8 and not compressed to be split. All text is shuffled twice, by block and by record.
    """
    fields = f"{schema}, `{CORRUPT}` string"
    parsed = F.from_json("_text", fields, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    return record_texts(spark, paths).select(parsed.alias("_row"), "_path").select("_row.*", "_path")

"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame operations only.

A source's target divided by its size is the number of copies each of its documents should have; the
whole part is taken outright, the rest is a probability between 0 and 1. Pivotal rounding meets two
fractional documents at a time and moves words from one to the other, in a random direction chosen so
that no document's expected number of copies changes, until one of the two is whole. The total of
expected words stays the same at each step, so a source ends within half of one document of its target.

The meetings form a tree: documents are dealt into buckets of about `BUCKET` within their source, each
bucket is folded to at most one fractional document, and these are folded again until one per source
is left, which is rounded to the nearer side. A hot source only has more buckets. All random numbers are
hashes of document ids, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import words, written

BUCKET = 256
# The weights of the sources in code point order, repeating, and the shares.
WEIGHTS = (3, 1, 2)
SHARE, LIMIT = 1.5, 2


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Targets are proportional to the weights and add up to `share` of all sizes, but stop at `limit`
    times the source's size; what is over is shared again by weight. In closed form: with the sources
    in order of limit / weight, the first ones are at their limit, and the rest share what is left.
    One row per source is sorted in one task, nothing larger.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    place = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = per_source.withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), place).cast("double")
    ).withColumns(
        {
            "most": F.lit(limit) * F.col("source_size"),
            "total": F.lit(share) * F.sum("source_size").over(every),
        }
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    levelled = ranked.withColumn("level", left / F.sum("weight").over(after))
    # The level holds from the first source that does not reach its limit on.
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    level = F.coalesce(F.first(open_level, ignorenulls=True).over(every_by(by_ratio)), F.lit(float("inf")))
    return levelled.withColumn("level", level).select(
        "source", "source_size", "n_docs",
        F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def every_by(ordered):
    return ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# One meeting. `acc` holds the documents that are whole (`done`) and the fractional one (`cur`), if
# any; x is the next document. a, b: sizes; p, q: probabilities; `up` and `down` are the shares of a copy
# that cur can win or lose; what one wins in words the other loses.
_DOC = "struct<doc_id:{id},k:bigint,size:bigint,p:double>"
_FOLD = """
aggregate(
  docs,
  named_struct('cur', cast(null as {doc}), 'done', cast(array() as array<{doc}>)),
  (acc, x) -> if(acc.cur is null, named_struct('cur', x, 'done', acc.done),
    transform(
      transform(
        array(named_struct(
          'a', acc.cur.size, 'b', x.size, 'p', acc.cur.p, 'q', x.p,
          'up', least(1 - acc.cur.p, x.p * x.size / acc.cur.size),
          'down', least(acc.cur.p, (1 - x.p) * x.size / acc.cur.size),
          'u', shiftrightunsigned(xxhash64(acc.cur.doc_id, acc.cur.k, x.doc_id, x.k, {seed}), 11)
               / 9007199254740992D)),
        s -> named_struct('s', s, 'wins', s.u * (s.up + s.down) < s.down)),
      t -> case
        when t.wins and t.s.up = 1 - t.s.p then named_struct(
          'cur', {x_q_up}, 'done', concat(acc.done, array({cur_1})))
        when t.wins then named_struct(
          'cur', {cur_up}, 'done', concat(acc.done, array({x_0})))
        when t.s.down = t.s.p then named_struct(
          'cur', {x_q_down}, 'done', concat(acc.done, array({cur_0})))
        else named_struct(
          'cur', {cur_down}, 'done', concat(acc.done, array({x_1}))) end
    )[0]))
"""


def _changed(doc: str, p: str) -> str:
    return (
        f"named_struct('doc_id', {doc}.doc_id, 'k', {doc}.k, 'size', {doc}.size, "
        f"'p', cast(least(1D, greatest(0D, {p})) as double))"
    )


def _fold(id_type: str, seed: int) -> str:
    return _FOLD.format(
        doc=_DOC.format(id=id_type),
        seed=seed,
        cur_1=_changed("acc.cur", "1"),
        cur_0=_changed("acc.cur", "0"),
        x_1=_changed("x", "1"),
        x_0=_changed("x", "0"),
        cur_up=_changed("acc.cur", "t.s.p + t.s.up"),
        cur_down=_changed("acc.cur", "t.s.p - t.s.down"),
        x_q_up=_changed("x", "t.s.q - t.s.up * t.s.a / t.s.b"),
        x_q_down=_changed("x", "t.s.q + t.s.down * t.s.a / t.s.b"),
    )


def mix_sizes(
    units: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    seed: int = 7,
) -> DataFrame:
    """Copies of each row of `units` (doc_id, source, size).

    Returns doc_id, k (1.. among rows alike in all three columns), source, size, source_size, target,
    copies, taken (= copies * size). Rows without words (null text included) take 0 copies. A null
    source is a source of its own; null doc_ids and repeated rows are documents like others.
    """
    id_type = units.schema["doc_id"].dataType.simpleString()
    alike = units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    each = alike.select(
        "doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("k")
    )
    targets = written(source_targets(units, weights, share, limit), "targets")
    s = targets.withColumnRenamed("source", "s")
    planned = each.join(s, each.source.eqNullSafe(s.s)).drop("s")
    rate = F.col("target") / F.col("source_size")
    planned = planned.withColumns(
        {"base": F.floor(F.when(F.col("size") > 0, rate).otherwise(0.0)).cast("bigint")}
    ).withColumn("p", F.when(F.col("size") > 0, rate - F.col("base")).otherwise(0.0))
    planned = written(planned, "planned")

    group = ["source", "source_size", "target", "base"]
    doc = F.struct("doc_id", "k", "size", "p").alias("doc")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET))
    level = planned.where("size > 0").select(
        *group, doc, buckets.alias("buckets"),
        F.pmod(F.xxhash64("doc_id", "k", F.lit(seed)), buckets).alias("bucket"),
    )
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    left, rounds, done = -(-largest // BUCKET), 0, []
    while True:
        # Larger documents first: the fractional one then ends up among the smaller.
        order = F.struct((-F.col("doc.size")).alias("o"), F.xxhash64("doc.doc_id", "doc.k").alias("h"), "doc")
        folded = (
            level.groupBy(*group, "buckets", "bucket")
            .agg(F.sort_array(F.collect_list(order)).alias("sorted"))
            .withColumn("docs", F.transform("sorted", lambda x: x["doc"]))
            .withColumn("f", F.expr(_fold(id_type, seed + rounds)))
            .select(*group, "buckets", "bucket", "f")
        )
        folded = written(folded, "folded")
        done.append(folded.select(*group, F.explode("f.done").alias("doc")))
        rest = folded.select(*group, F.col("f.cur").alias("doc"), "buckets", "bucket")
        if left <= 1:
            done.append(rest.drop("buckets", "bucket"))
            break
        left, rounds = -(-left // BUCKET), rounds + 1
        fewer = F.ceil(F.col("buckets") / BUCKET)
        level = rest.withColumns({"buckets": fewer, "bucket": F.col("bucket") % fewer})
    decided = reduce(DataFrame.unionByName, done).select(
        "doc.doc_id", "doc.k", "source", "doc.size", "source_size", "target",
        (F.col("base") + F.when(F.col("doc.p") >= 0.5, 1).otherwise(0)).alias("copies"),
    )
    empty = planned.where("size = 0").select(
        "doc_id", "k", "source", "size", "source_size", "target", F.lit(0).cast("bigint").alias("copies")
    )
    return decided.unionByName(empty).withColumn("taken", F.col("copies") * F.col("size"))


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("bigint").alias("size"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, copies, taken.

    `taken` is the words the mix takes of it, repeats counted. See `mix_sizes` for nulls and repeated
    rows; other columns are ignored; an empty table gives no rows.
    """
    units = written(sized(docs, id_col, source_col, text_col), "sizes")
    return mix_sizes(units, **options).drop("k")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """`docs` with each row as often as the mix takes it; documents without words go.

    Rows alike in id, source and size are numbered by their text, so each keeps its own copies.
    """
    names = docs.columns
    size = F.size(words(F.col(text_col))).cast("bigint")
    alike = Window.partitionBy(id_col, source_col, "_size").orderBy(text_col)
    numbered = docs.withColumn("_size", size).withColumn("_k", F.row_number().over(alike).cast("bigint"))
    units = written(sized(docs, id_col, source_col, text_col), "sizes")
    take = mix_sizes(units, **options).where("copies > 0").select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"),
        F.col("size").alias("_n"), F.col("k").alias("_kk"), "copies",
    )
    joined = numbered.join(
        take,
        numbered[id_col].eqNullSafe(take["_doc"])
        & numbered[source_col].eqNullSafe(take["_source"])
        & (numbered["_size"] == take["_n"])
        & (numbered["_k"] == take["_kk"]),
    )
    return joined.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))
    ).select(*[F.col(f"`{n}`") for n in names])

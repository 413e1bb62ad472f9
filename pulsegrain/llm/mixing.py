"""Mix sources to target weights by weighted fair queueing.

The documents of each source are shuffled by a keyed hash and stand in a queue, twice over.
A document's virtual finish time is the number of its source's words up to and including it,
divided by the source's share of the mix. All queues are merged by finish time, and the mix
is the merged order up to the total budget.

Running sums are made in three steps (sums of hash buckets, their running sum, the running
sum in a bucket), so no source, however large, is sorted by one task. The merged order is cut
the same way: sums of ranges of finish time show the range in which the budget ends, and only
that range is sorted for the cut. The mix itself is range-sorted when its rows are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MOST_TIMES = 2
BUCKET_ROWS = 4096
TIME_RANGES = 4096
WORD = r"[^\x20\x09-\x0D]+"
SEED = 17


@dataclass(frozen=True)
class Mix:
    """timed: doc_id, source, size, text_hash, source_size, target, finish (of each time)."""

    timed: DataFrame
    budget: float
    cut: tuple[float, int, int, int] | None  # finish, place of the source, key, time of the last taken


def _targets(rows: DataFrame) -> DataFrame:
    """source, place, n_rows, source_size, weight, target: shares by weight, none above
    MOST_TIMES times its source, what is cut off shared again among the others."""
    sums = written(rows.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("source_size")), "sources")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    ranked = (sums.withColumn("place", F.row_number().over(by_name))
              .withColumn("weight", F.get(weights, (F.col("place") - 1) % len(WEIGHTS)))
              .withColumn("most", MOST_TIMES * F.col("source_size"))
              .withColumn("ratio", F.col("most") / F.col("weight"))
              .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * (BUDGET_PERCENT / 100))
              .withColumn("filled", F.sum("most").over(by_ratio) - F.col("most"))
              .withColumn("left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", (F.col("all") - F.col("filled")) / F.col("left")))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(
        Window.partitionBy())["level"]
    return ranked.withColumn("target", F.when(level.isNull(), F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), level * F.col("weight")))).select(
        "source", "place", "n_rows", "source_size", "weight", "target")


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             source: str = "source") -> Mix:
    """Finish times of all rows and where the budget ends."""
    rows = written(docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash")), "sized")
    targets = written(_targets(rows), "targets")
    budget = float(targets.agg(F.sum("target")).first()[0] or 0.0)
    placed = (rows.join(targets, rows.source.eqNullSafe(targets.source)).drop(targets.source)
              .withColumn("key", F.xxhash64(F.lit(SEED), "doc_id", "text_hash"))
              .withColumn("bucket", F.floor(
                  F.pmod(F.col("key"), F.lit(1 << 52)) / F.lit(float(1 << 52))
                  * F.ceil(F.col("n_rows") / BUCKET_ROWS))))
    in_order = Window.partitionBy("place", "bucket").orderBy("key", "size")
    before = Window.partitionBy("place").orderBy("bucket")
    offsets = (placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
               .withColumn("offset", F.sum("words").over(before) - F.col("words"))
               .drop("words"))
    run = placed.withColumn("upto", F.sum("size").over(
        in_order.rowsBetween(Window.unboundedPreceding, 0)))
    share = F.lit(budget) / F.col("target")
    timed = run.join(offsets, ["place", "bucket"]).select(
        "doc_id", "source", "size", "text_hash", "source_size", "target", "place", "key",
        F.when((F.col("size") > 0) & (F.col("target") > 0), F.array(*[
            (F.col("offset") + F.col("upto") + n * F.col("source_size")) * share
            for n in range(MOST_TIMES)])).alias("finish"))
    timed = written(timed, "timed")
    items = timed.select("size", "place", "key", F.posexplode("finish").alias("time", "at")).withColumn(
        "range", F.least(F.floor(F.col("at") / F.lit(max(budget, 1.0)) * TIME_RANGES),
                         F.lit(2 * TIME_RANGES)))
    sums = items.groupBy("range").agg(F.sum("size").alias("words")).withColumn(
        "upto", F.sum("words").over(Window.orderBy("range")))
    # The last range that the budget reaches, and the words before it.
    reached = sums.where(F.col("upto") - F.col("words") < budget).agg(
        F.max(F.struct("range", (F.col("upto") - F.col("words")).alias("before")))).first()[0]
    cut = None
    if reached is not None:
        order = ("at", "place", "key", "time")
        upto = F.sum("size").over(Window.partitionBy("range").orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0)) + reached["before"]
        last = (items.where(F.col("range") == reached["range"]).withColumn("upto", upto)
                .where(F.col("upto") <= budget).agg(F.max(F.struct(*order))).first()[0])
        if last is None:  # not even the first of that range fits: the cut is before the range
            last = items.where(F.col("range") < reached["range"]).agg(F.max(F.struct(*order))).first()[0]
        cut = tuple(last) if last is not None else None
    return Mix(timed, budget, cut)


def _times(mix: Mix) -> F.Column:
    """Finish times of the times that a row is taken, at most MOST_TIMES."""
    if mix.cut is None:
        return F.array().cast("array<double>")
    end = F.struct(*[F.lit(v).cast(t) for v, t in
                     zip(mix.cut, ("double", "int", "long", "int"), strict=True)])
    return F.coalesce(F.filter("finish", lambda at, i: F.struct(
        at, F.col("place").cast("int"), "key", i.cast("int")) <= end), F.array().cast("array<double>"))


def mix_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken of each row of docs.

    A null source is a source of its own, after all others. Null and empty texts have size 0
    and are never taken. Repeated rows stand in the queue as rows of their own; rows with the
    same doc_id and text have the same place and are taken together. An empty table gives no
    rows. Other columns are ignored whatever their names.
    """
    mix = plan_mix(docs, doc_id, text, source)
    return mix.timed.select("doc_id", "source", "size", "source_size", "target",
                            (F.col("size") * F.size(_times(mix))).cast("long").alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """The mix: rows of docs with all their columns, as often as taken, sorted by finish time."""
    mix = plan_mix(docs, doc_id, text, source)
    keys = ("doc_id", "source", "text_hash")
    taken = mix.timed.withColumn("times", _times(mix)).where("size(times) > 0").groupBy(*keys).agg(
        F.flatten(F.collect_list("times")).alias("times"), F.count("*").alias("copies"))
    taken = written(taken, "taken")
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(names)]).withColumns({
        "own_id": F.col(f"kept{names.index(doc_id)}").cast("long"),
        "own_source": F.col(f"kept{names.index(source)}"),
        "own_hash": F.xxhash64(F.col(f"kept{names.index(text)}"))})
    if not taken.where("copies > 1").isEmpty():  # the same row several times: one stands for all
        rows = rows.dropDuplicates(["own_id", "own_source", "own_hash"])
    joined = rows.join(taken, rows.own_id.eqNullSafe(taken.doc_id) & (rows.own_hash == taken.text_hash)
                       & rows.own_source.eqNullSafe(taken.source))
    kept = [F.col(f"kept{i}") for i in range(len(names))]
    out = joined.select(*kept, F.explode("times").alias("at"))
    return (out.repartitionByRange("at").sortWithinPartitions("at")
            .select(*[c.alias(n) for c, n in zip(kept, names, strict=True)]))

"""Exact quantiles whose state stays small however large or skewed the groups are.

Spark's exact ``percentile`` keeps a map of all distinct values of a group in one task. Here a bounded
sketch first brackets each wanted rank, one more pass counts what lies below the bracket and the
distinct values inside it (about 1/accuracy of the group). Both passes combine map-side. Where more than
a few thousand distinct values lie inside, they are counted into 4,096 cells and only the cells of the
rank go on, until few are left; a running count over these picks the order statistics. A bracket that
missed its rank is opened on that side and counted again. The answer is the exact linear-interpolated
quantile.

The brackets are staged: their file size is then known when the second pass is planned, so the rows are
not shuffled to meet them unless there are too many groups to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.staging import stage

SAMPLE_ROWS = 1_000_000  # rows that brackets of growing groups are estimated from
WIDER = (0.001, 0.003, 0.01, 0.03, 0.1, 0.3)  # half widths, in ranks, of brackets around the quantiles of a sample
CELLS = 4096  # cells of a refinement; so many distinct values of a slot at most are put in order by one task


@dataclass(frozen=True)
class Cumulative:
    """Groups that grow along a column: for each threshold the rows with ``column`` below it, named ``name``."""

    column: str
    name: str
    thresholds: tuple[int, ...]

    def later(self) -> Column:
        return F.filter(F.array(*[F.lit(int(t)) for t in self.thresholds]), lambda t: t > F.col(self.column))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column | str],
    probabilities: Sequence[float] = (0.5,),
    accuracy: int = 10_000,
    cumulative: Cumulative | None = None,
) -> DataFrame:
    """One row per (keys, measure, probability): n, lower and upper order statistic, value.

    Null and NaN values are left out; a group without values has no row. ``df`` is read twice, so an
    expensive input should be staged first. With ``cumulative`` there is a row per threshold as well; the
    rows are counted once, and only the counts meet the thresholds.
    """
    keys, names = list(keys), list(measures)
    cells = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in measures.values()]
    carried = [*keys, *([cumulative.column] if cumulative else [])]
    wide = df.select(*carried, *[F.when(~F.isnan(c), c).alias(f"_v{i}") for i, c in enumerate(cells)])
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(f"_v{i}").alias("v")) for i, n in enumerate(names)])
    share = F.array(*[F.lit(float(p)) for p in probabilities])[F.col("at")]
    if cumulative:
        wide = wide.filter(F.col(cumulative.column) < max(cumulative.thresholds))
        group = [*keys, cumulative.name, "measure"]
        long = wide.select(*keys, F.explode(cumulative.later()).alias(cumulative.name), *[f"_v{i}" for i in range(len(names))])
        long = long.select(*group[:-1], F.inline(pairs)).filter("v is not null")
        counted = stage(_counted_once(wide, keys, names, pairs, probabilities, accuracy, cumulative))
    else:
        group = [*keys, "measure"]
        long = wide.select(*keys, F.inline(pairs)).filter("v is not null")
        brackets = stage(_brackets(wide, keys, names, probabilities, accuracy))
        counted = stage(_counted(long, group, brackets.withColumn("rank", share * (F.col("n") - 1))))
    slot = [*group, "at"]
    slots = _slots(counted, slot)
    widest, missed = slots.agg(F.max("values"), F.count_if("missed")).first()
    if missed:
        opened = slots.filter("missed").select(
            *slot, "n", "rank", F.when(F.col("first") < F.col("lesser"), float("-inf")).otherwise(F.col("following")).alias("low"),
            F.when(F.col("first") < F.col("lesser"), F.col("previous")).otherwise(float("inf")).alias("high"),
        )
        rest = counted.join(opened.select(*[F.col(k).alias(f"_{k}") for k in slot]), _same(slot), "left_anti")
        counted = stage(rest.unionByName(_counted(long, group, stage(opened))))
        widest = _slots(counted, slot).agg(F.max("values")).first()[0]
    while widest and widest > CELLS:
        counted = stage(_refined(counted, slot))
        widest = _slots(counted, slot).agg(F.max("values")).first()[0]

    # ranks are 0-based; the outside row sorts first and brings the count below the bracket
    running = Window.partitionBy(*slot).orderBy(F.col("inside").asc_nulls_first())
    step = F.when(F.col("inside").isNull(), F.col("lesser")).otherwise(F.col("copies"))
    placed = (
        counted.withColumn("upto", F.sum(step).over(running.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("upto") - step)
    )

    def statistic(r: Column) -> Column:
        hit = F.max(F.when(F.col("inside").isNotNull() & (r >= F.col("start")) & (r < F.col("upto")), F.col("inside")))
        below = F.coalesce(F.max("lesser"), F.lit(0))
        return F.when(hit.isNotNull(), hit).when(F.max(r) < below, F.max("previous")).otherwise(F.max("following"))

    rank = F.col("rank")
    out = placed.groupBy(*slot).agg(
        F.max("n").alias("n"), F.max(rank - F.floor(rank)).alias("part"),
        statistic(F.floor(rank)).alias("lower"), statistic(F.ceil(rank)).alias("upper"),
    )
    value = F.when(F.col("lower") == F.col("upper"), F.col("lower")).otherwise(F.col("lower") + F.col("part") * (F.col("upper") - F.col("lower")))
    return out.select(*group, share.alias("probability"), "n", "lower", "upper", value.alias("value"))


def _brackets(
    wide: DataFrame, keys: Sequence[str], names: Sequence[str], probabilities: Sequence[float], accuracy: int, sampled: bool = False
) -> DataFrame:
    """Per (keys, measure, at): number of values and a bracket around the wanted rank, from bounded sketches.

    Of a sample the bracket is as wide as four standard errors of the rank in a group of its size.
    """
    # one sketch per measure side by side, so the rows are not multiplied
    slack = 2.0 / accuracy
    widths = [slack, *[w for w in WIDER if sampled and w > slack]]
    edges = [e for p in probabilities for w in widths for e in (max(p - w, 0.0), min(p + w, 1.0))]
    sketches = []

    def at(i: int, k: int, side: int) -> Column:
        needed = slack + F.try_divide(F.lit(2.0), F.sqrt(f"n{i}"))
        place = F.lit(len(widths) - 1)
        for j in reversed(range(len(widths) - 1)) if sampled else ():
            place = F.when(needed <= widths[j], j).otherwise(place)
        return F.col(f"e{i}")[place * 2 + (2 * k * len(widths) + side)]

    for i in range(len(names)):
        sketches += [F.count(f"_v{i}").alias(f"n{i}"), F.percentile_approx(f"_v{i}", edges, accuracy).alias(f"e{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("measure"), F.col(f"n{i}").alias("n"), F.lit(k).alias("at"),
            at(i, k, 0).alias("low"), at(i, k, 1).alias("high"),
        )
        for i, name in enumerate(names)
        for k in range(len(probabilities))
    ]
    return wide.groupBy(*keys).agg(*sketches).select(*keys, F.inline(F.array(*entries))).filter("n > 0")


def _counted_once(
    wide: DataFrame, keys: Sequence[str], names: Sequence[str], pairs: Column, probabilities: Sequence[float], accuracy: int, along: Cumulative
) -> DataFrame:
    """Counts as ``_counted`` gives them, for groups that grow along a column, from one pass over the rows.

    Brackets come from a sample that meets the thresholds (a bracket that misses is opened later). All
    bracket edges of a key cut its values into cells; rows are counted per key, column value and cell,
    and by value inside a bracket. These counts are small, and they meet the thresholds.
    """
    rate = min(1.0, SAMPLE_ROWS / max(wide.count(), 1))
    sample = wide if rate == 1.0 else wide.sample(rate, seed=1)
    met = sample.select(*keys, F.explode(along.later()).alias(along.name), *[f"_v{i}" for i in range(len(names))])
    brackets = stage(_brackets(met, [*keys, along.name], names, probabilities, accuracy, rate < 1.0).drop("n"))
    owner = [*keys, "measure"]
    cuts = brackets.groupBy(*owner).agg(
        F.array_sort(F.array_union(F.collect_set("low"), F.collect_set("high"))).alias("edges"), F.collect_set(F.struct("low", "high")).alias("spans")
    ).select(*[F.col(k).alias(f"_{k}") for k in owner], "edges", "spans")
    long = wide.select(*keys, along.column, F.inline(pairs)).filter("v is not null").join(stage(cuts), _same(owner), "left")
    v = F.col("v")
    # spans of growing groups lie close together: nearly all values lie beyond all of them, which two comparisons tell
    least, most = F.element_at("edges", 1), F.element_at("edges", -1)
    beyond = (v < least) | (v > most)
    inside = F.when(F.col("spans").isNull(), True).when(beyond, False).otherwise(
        F.exists("spans", lambda x: (v >= x["low"]) & (v <= x["high"]))
    )
    cell = F.when(F.col("spans").isNull() | (v < least), 0).when(v > most, F.size("edges")).otherwise(
        F.size(F.filter("edges", lambda e: e < v))
    )
    cells = stage(
        long.groupBy(*owner, along.column, cell.alias("cell"), F.when(inside, v).alias("at_value"))
        .agg(F.count("*").alias("copies"), F.min("v").alias("least"), F.max("v").alias("most"))
    )
    group = [*keys, along.name, "measure"]
    slots = cells.select("*", F.explode(along.later()).alias(along.name)).select(
        "*", F.explode(F.array(*[F.lit(k) for k in range(len(probabilities))])).alias("at")
    )
    slot = [*group, "at"]
    right = brackets.select(*[F.col(k).alias(f"_{k}") for k in slot], "low", "high")
    slots = slots.join(right, _same(slot), "left").drop(*[f"_{k}" for k in slot])
    # a group that the sample missed has no bracket: all its values lie below, and it is opened as one that missed
    below, above = F.coalesce(F.col("most") < F.col("low"), F.lit(True)), F.coalesce(F.col("least") > F.col("high"), F.lit(False))
    counted = slots.groupBy(*slot, F.when(~below & ~above, F.col("at_value")).alias("inside")).agg(
        F.sum("copies").alias("copies"), F.coalesce(F.sum(F.when(below, F.col("copies"))), F.lit(0)).alias("lesser"),
        F.max(F.when(below, F.col("most"))).alias("previous"), F.min(F.when(above, F.col("least"))).alias("following"),
    )
    sizes = counted.groupBy(*slot).agg(F.sum("copies").alias("n")).select(*[F.col(k).alias(f"_{k}") for k in slot], "n")
    rank = F.array(*[F.lit(float(p)) for p in probabilities])[F.col("at")] * (F.col("n") - 1)
    return counted.join(sizes, _same(slot)).drop(*[f"_{k}" for k in slot]).select(
        *slot, "inside", "n", rank.alias("rank"), "copies", "lesser", "previous", "following"
    )


def _same(names: Sequence[str]) -> Column:
    """Null-safe equality of columns with their namesakes behind an underscore."""
    out = F.lit(True)
    for k in names:
        out = out & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out


def _counted(long: DataFrame, group: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Per slot and distinct value inside its bracket the copies; a row without value for what is outside."""
    right = brackets.select(*[F.col(k).alias(f"_{k}") for k in group], "n", "at", "rank", "low", "high")
    below, above = F.col("v") < F.col("low"), F.col("v") > F.col("high")
    return (
        long.join(right, _same(group))
        .groupBy(*group, "at", F.when(~below & ~above, F.col("v")).alias("inside"))
        .agg(
            F.max("n").alias("n"),
            F.max("rank").alias("rank"),
            F.count("*").alias("copies"),
            F.count_if(below).alias("lesser"),
            F.max(F.when(below, F.col("v"))).alias("previous"),
            F.min(F.when(above, F.col("v"))).alias("following"),
        )
    )


def _slots(counted: DataFrame, slot: Sequence[str]) -> DataFrame:
    """Per slot: distinct values inside, and whether a wanted rank lies beyond them and their neighbours."""
    out = counted.groupBy(*slot).agg(
        F.max("n").alias("n"), F.max("rank").alias("rank"), F.count("inside").alias("values"),
        F.coalesce(F.sum(F.when(F.col("inside").isNotNull(), F.col("copies"))), F.lit(0)).alias("held"),
        F.coalesce(F.max("lesser"), F.lit(0)).alias("lesser"), F.max("previous").alias("previous"), F.max("following").alias("following"),
    )
    first, last = F.floor("rank"), F.ceil("rank")
    missed = (first < F.col("lesser") - 1) | (last > F.col("lesser") + F.col("held"))
    return out.select("*", first.alias("first"), last.alias("last"), missed.alias("missed"))


def _refined(counted: DataFrame, slot: Sequence[str]) -> DataFrame:
    """The same slots with only the values of the cells in which the wanted ranks lie.

    Sums per cell combine map-side; the running count sees at most 4,097 cells of a slot. What falls out is
    added to the counts and neighbours outside.
    """
    inside, outside = counted.filter("inside is not null"), counted.filter("inside is null")
    slots = _slots(counted, slot).select(*[F.col(k).alias(f"_{k}") for k in slot], *[F.col(c).alias(f"s_{c}") for c in ("lesser", "first", "last")])
    span = inside.groupBy(*[F.col(k).alias(f"_{k}") for k in slot]).agg(F.min("inside").alias("lo"), F.max("inside").alias("hi"))
    lo, hi, v = F.col("lo"), F.col("hi"), F.col("inside")
    finite = (lo > float("-inf")) & (hi < float("inf"))
    even = F.floor(CELLS * ((v / 2 - lo / 2) / (hi / 2 - lo / 2)))
    cell = F.when(v == lo, 0).when(v == hi, CELLS).when(finite & (hi > lo), F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), even))).otherwise(CELLS // 2)
    dealt = inside.join(span, _same(slot)).drop(*[f"_{k}" for k in slot]).withColumn("cell", cell.cast("int")).drop("lo", "hi")
    sums = dealt.groupBy(*slot, "cell").agg(F.sum("copies").alias("held"), F.min("inside").alias("least"), F.max("inside").alias("most"))
    order = Window.partitionBy(*slot).orderBy("cell")
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before).join(slots, _same(slot)).drop(*[f"_{k}" for k in slot])
    start = F.col("s_lesser") + F.col("before")
    sums = sums.withColumn("wanted", (start <= F.col("s_last")) & (start + F.col("held") > F.col("s_first")))
    chosen = stage(sums)
    kept = dealt.join(chosen.filter("wanted").select(*[F.col(k).alias(f"_{k}") for k in [*slot, "cell"]]), _same([*slot, "cell"]), "left_semi").drop("cell")
    edge = chosen.groupBy(*slot).agg(
        F.min(F.when(F.col("wanted"), F.col("cell"))).alias("from"), F.max(F.when(F.col("wanted"), F.col("cell"))).alias("to"),
    ).select(*[F.col(k).alias(f"_{k}") for k in slot], "from", "to")
    met = chosen.join(edge, _same(slot)).drop(*[f"_{k}" for k in slot])
    left, right = F.col("cell") < F.col("from"), F.col("cell") > F.col("to")
    gone = met.groupBy(*slot).agg(
        F.coalesce(F.sum(F.when(left, F.col("held"))), F.lit(0)).alias("lesser"), F.max(F.when(left, F.col("most"))).alias("previous"),
        F.min(F.when(right, F.col("least"))).alias("following"),
    )
    both = outside.select(*slot, "lesser", "previous", "following").unionByName(gone).groupBy(*slot).agg(
        F.sum("lesser").alias("lesser"), F.max("previous").alias("previous"), F.min("following").alias("following")
    )
    known = _slots(counted, slot).select(*[F.col(k).alias(f"_{k}") for k in slot], "n", "rank")
    again = both.join(known, _same(slot)).select(
        *slot, F.lit(None).cast("double").alias("inside"), "n", "rank", F.col("lesser").alias("copies"), "lesser", "previous", "following"
    )
    return kept.select(again.columns).unionByName(again)


def exact_medians(df: DataFrame, keys: Sequence[str], measures: dict[str, Column | str], **options) -> DataFrame:
    """Wide form: one row per keys, the exact median of each measure under its name (null without values)."""
    keys = list(keys)
    long = exact_quantiles(df, keys, measures, **options)
    picks = [F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in measures]
    return long.groupBy(*keys).agg(*picks)

"""Operator 5: mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size takes floor(r) certain whole copies of every
document.  The rest of the target is drawn with unequal inclusion: proportional to a document's priority, so that the
expected words are what is left; documents whose inclusion would be above 1 are certain copies too, and the others
share what these leave.  The others are ranked by (u / (1 - u)) / (p / (1 - p)), u a hash of (key, text, seed), p the
inclusion, and the first ones are taken while their words stay within what is left (and ``near`` of the target).  A gap that a long document
leaves there is filled by the next ones in rank that fit, until it is within ``near`` of the target or nothing fits;
then one more is taken if that lands nearer.

The cut per source is found by a two-level histogram of the ranks, so only one sub-bin per
source is ever sorted; a source with a third of all rows is no bottleneck.

Null text counts 0 words; null sources are one source, last; null ids are told apart by their text.  Rows equal in id
and text tie and share a rank; which of them is cut makes no difference to the rows.  An empty table gives no rows; documents
without words take 0; very long texts count whole.  Only the key, text, source and priority columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colonnade.llm.text import materialise, words_col

BINS = 4096
STEPS = 256  # priorities are rounded to this part of an octave
LEAST = -64 * STEPS
MOST = 3


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> target, with weights 1, 2, 3 repeating by code point (null last).

    Sources are ordered by how soon they reach their cap; the shared level after k capped
    sources is (all - caps) / (weights left), and capping stops at the first level that no cap undercuts."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    t = sizes.withColumn("w", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    t = t.withColumn("cap", (MOST * F.col("source_size")).cast("double"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({"all": F.sum("source_size").over(every).cast("double"), "sw": F.sum("w").over(every)})
    t = t.withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.col("sw") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    t = t.withColumn("free", F.col("level") * F.col("w") < F.col("cap"))
    level = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("w")).alias("o"), F.col("level").alias("v")))).over(every)["v"]
    return t.withColumn("share", level).select(
        "source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("share") * F.col("w")), F.col("cap")).alias("target"))


def inclusion(weights: DataFrame) -> DataFrame:
    """source, step, size, left -> source, factor: inclusion is min(1, factor * 2^(step / STEPS)) and gives ``left`` expected words.

    Steps are few (STEPS an octave), so a source's running sums over them fit one task whatever its rows."""
    down = Window.partitionBy("source").orderBy(F.col("step").desc())
    w = F.pow(F.lit(2.0), F.col("step") / STEPS)
    t = weights.withColumns({
        "_before": F.coalesce(F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_rest": F.sum(F.col("size") * w).over(down.rowsBetween(0, Window.unboundedFollowing))})
    factor = (F.col("left") - F.col("_before")) / F.greatest(F.col("_rest"), F.lit(1e-300))
    # the largest step that is not certain, with everything above it taken whole
    return t.withColumn("factor", factor).where(F.col("factor") * w < 1).groupBy("source").agg(
        F.max_by("factor", "step").alias("factor"))


def _cut(cand: DataFrame, held, last: bool) -> DataFrame:
    """cand (source, size, gap, _near, _q, _f, _b, ...) with ``_in``: the first in rank until a source's words reach its gap."""

    def reach(part: DataFrame, level: str, start: Column, name: str) -> DataFrame:
        """Per source the bin in which the running words reach the gap, and the words before it."""
        bins = part.groupBy("source", level).agg(F.sum("size").alias("n"), F.max("gap").alias("gap"), F.max(start).alias("from"))
        run = Window.partitionBy("source").orderBy(level)
        c = bins.withColumn("cum", F.sum("n").over(run) + F.col("from"))
        c = c.where(F.col("cum") >= F.col("gap")).groupBy("source").agg(
            F.min(F.struct(F.col(level).alias("bin"), (F.col("cum") - F.col("n")).alias("before"))).alias("x"))
        return c.select(F.col("source").alias(f"_{name}"), F.col("x.bin").alias(f"{name}_bin"), F.col("x.before").alias(f"{name}_before"))

    c1 = materialise(reach(cand, "_b", F.lit(0), "c1"), "mix-cut1")
    r1 = cand.join(held(c1), F.col("source").eqNullSafe(F.col("_c1")), "left").drop("_c1")
    c2 = materialise(reach(r1.where(F.col("_b") == F.col("c1_bin")), "_f", F.col("c1_before"), "c2"), "mix-cut2")
    r2 = r1.join(held(c2), F.col("source").eqNullSafe(F.col("_c2")), "left").drop("_c2")
    # Without a boundary the whole source stays below its gap.
    at = F.coalesce(F.col("_f") == F.col("c2_bin"), F.lit(False))
    run = Window.partitionBy("source").orderBy("_q", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = r2.where(at).withColumn("_cum", F.sum("size").over(run) + F.col("c2_before"))
    # The document across the target is taken when it lands near, or at last nearer than without it.
    before = F.col("_cum") - F.col("size")
    over = F.col("_cum") - F.col("gap")
    edge = edge.withColumn("_in", (before < F.col("gap")) & (over <= (F.col("gap") - before if last else F.col("_near"))))
    out = r2.where(~at).withColumn("_in", F.col("c2_bin").isNull() | (F.col("_f") < F.col("c2_bin"))).unionByName(edge.drop("_cum"))
    return out.drop("c1_bin", "c1_before", "c2_bin", "c2_before")


def mix_pareto(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               priority: Column | None = None, seed: int = 17, near: float = 0.001) -> DataFrame:
    """key, size, source_size, target, copies (whole copies), taken (= copies * size), inclusion (of the last copy; 1: certain).

    ``priority`` is a positive weight of a document, by default the logarithm of its size; null and others count as least."""
    spark = docs.sparkSession
    size = F.size(words_col(F.col(text))).cast("long")
    wanted = F.log2(2 + size) if priority is None else priority.cast("double")
    step = F.round(F.log2(F.when((wanted > 0) & (wanted < float("inf")), wanted)) * STEPS).cast("long")
    # equal ids and null ids differ by their text; only rows equal in both share a rank
    u = (F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.col(text)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    rows = docs.select(F.col(key), F.col(source).alias("source"), size.alias("size"),
                       F.greatest(F.coalesce(step, F.lit(LEAST)), F.lit(LEAST)).alias("step"), u.alias("_u"))
    rows = materialise(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes)
    t = t.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    t = materialise(t.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "_s"), "mix-plan")
    few = t.limit(100_001).count() <= 100_000
    held = lambda d: F.broadcast(d) if few else d
    same = F.col("source").eqNullSafe(F.col("_s"))
    steps = rows.groupBy("source", "step").agg(F.sum("size").alias("size"))
    factors = inclusion(steps.join(held(t.select("_s", "left")), same).drop("_s"))
    t = materialise(t.join(factors, same, "left").drop("source"), "mix-factors")
    p = F.coalesce(F.col("factor"), F.lit(0.0)) * F.pow(F.lit(2.0), F.col("step") / STEPS)
    rows = rows.join(held(t), same, "left").drop("_s").withColumn("inclusion", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    certain = F.col("inclusion") >= 1
    rows = materialise(rows.withColumn("_sure", certain), "mix-rows")
    # what certain copies leave
    sure = rows.where("_sure").groupBy("source").agg(F.sum("size").alias("_n")).select(F.col("source").alias("_t"), "_n")
    gaps = materialise(t.join(sure, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
        F.col("_s"), (F.col("left") - F.coalesce(F.col("_n"), F.lit(0))).alias("gap"), (F.col("target") * near).alias("_near")), "mix-gaps")
    odds = F.col("_u") / (1 - F.col("_u")) * (1 - F.col("inclusion")) / F.greatest(F.col("inclusion"), F.lit(1e-300))
    # rank in (0, 1), monotone in the odds ratio
    fine = F.floor(F.col("_q") * (BINS * BINS)).cast("long")
    rest = rows.withColumn("_q", 1 - 1 / (1 + odds)).withColumn("_f", F.least(fine, F.lit(BINS * BINS - 1)))
    rest = rest.withColumn("_b", F.floor(F.col("_f") / BINS)).withColumn("_in", F.lit(False))
    done = [rest.where("_sure").withColumn("_in", F.lit(True))]
    rest = rest.where(~F.col("_sure"))
    most = F.lit(2**62)  # at first every document is a candidate, then those that fit
    last = False
    while True:
        open_ = held(gaps.where(F.col("gap") > (F.col("_near") if done[1:] else F.lit(0.0))))
        near_by = rest.join(open_, same, "left").drop("_s")
        near_by = materialise(near_by.withColumn("_fits", F.coalesce((F.col("size") > 0) & F.col("gap").isNotNull() & (F.col("size") <= most), F.lit(False))), "mix-round")
        cand, rest = near_by.where("_fits"), near_by.where(~F.col("_fits")).drop("gap", "_near", "_fits")
        if not cand.isEmpty():  # every round of fitting documents takes one at least from each source that has some
            settled = materialise(_cut(cand.drop("_in", "_fits"), held, last), "mix-settled").drop("gap", "_near")
            won = settled.where("_in").groupBy("source").agg(F.sum("size").alias("_n")).select(F.col("source").alias("_t"), "_n")
            done.append(settled.where("_in"))
            rest = rest.unionByName(settled.where(~F.col("_in")))
            gaps = materialise(gaps.join(won, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
                "_s", (F.col("gap") - F.coalesce(F.col("_n"), F.lit(0))).alias("gap"), "_near"), "mix-gaps")
            rest = materialise(rest, "mix-rest")
            most = F.col("gap") + F.col("_near")
        elif last:
            break
        else:  # nothing fits: one document may still land nearer
            most, last = 2 * F.col("gap"), True
            continue
        if last:
            break
    done.append(rest)
    cols = [key, "size", "source_size", "target", "whole", "inclusion", "_in"]
    out = done[0].select(*cols)
    for d in done[1:]:
        out = out.unionByName(d.select(*cols))
    out = out.withColumn("copies", (F.col("whole") + F.when(F.col("_in") & (F.col("whole") < MOST), F.lit(1)).otherwise(F.lit(0))).cast("int"))
    return out.select(key, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "inclusion")

"""Operator 1 [native]: robust multivariate outliers by minimum covariance determinant.

Each document gets smoothed, log-transformed statistics in units of 1/1024 (integers,
so that sums are exact and reruns agree).  Per (language, source), per language and for all rows the h-subset starts
from histogram medians and is refined by concentration steps: mean and covariance of the
subset, squared Mahalanobis distance of all rows, keep the nearest ``support`` share.
A language's estimate is shrunk towards that of all rows, a group's towards its language's, by the rows that each rests
on (rows that fail the base rule are not fitted): the wider estimate weighs as much as ``min_group`` rows.

Null text has no words (base_failed).  Null language or source is a group of its own.
Tied distances share a histogram bin and are in or out together.  An empty table gives no
rows.  Only key, text, lang and source columns are read, extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colonnade.llm.text import SPACE, materialise, words_col

SYMBOLS = "#*$%&|<>"
UNIT = 1024
#: Statistic -> least standard deviation (in units of 1/1024) that its estimate may have.
FLOORS = {"z_length": 64, "z_symbols": 128, "z_lines": 96, "z_repeat": 96}
_KEYS = ["g_level", "g_lang", "g_source"]  # level 2: language and source, 1: language, 0: all rows


def repeat_words_col(words: Column, n: int = 5) -> Column:
    """Words inside n-word windows that occur at least twice in the array.

    Window hashes only rule texts out; texts with an equal hash are decided on the
    window strings, sorted with their positions (n log n, not quadratic)."""
    starts = lambda a: F.sequence(F.lit(0), F.size(a) - n)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    sums = lambda h: F.transform(starts(h), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))

    def let(value: Column, body) -> Column:
        # Binds an array to a lambda variable, so that it is computed once per row.
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def exact(ws: Column) -> Column:
        keyed = F.array_sort(F.transform(starts(ws), lambda i: F.struct(
            F.concat_ws(" ", F.slice(ws, i + 1, n)).alias("w"), i.alias("i"))))

        def covered(s: Column) -> Column:
            at = lambda i: F.get(s, i)["w"]
            hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(at(i) == at(i - 1), F.lit(False))
                           | F.coalesce(at(i) == at(i + 1), F.lit(False)))
            pos = F.array_sort(F.transform(hit, lambda i: F.get(s, i)["i"]))
            return F.aggregate(pos, F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")), lambda acc, p: F.struct(
                (acc["total"] + p + n - F.greatest(acc["end"], p)).alias("total"), (p + n).alias("end")))["total"]
        return let(keyed, covered)

    def decide(h: Column) -> Column:
        return let(sums(h), lambda s: F.size(F.array_distinct(s)) < F.size(s))

    return F.when(F.size(words) <= n, F.lit(0)).when(let(hashes, decide), let(words, exact)).otherwise(F.lit(0)).cast("long")


def base_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", *carry: str) -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and carried columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(body, SPACE, "")
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.translate(line, SPACE, "") != "")
    out = docs.select(
        F.col(key), *[F.col(c) for c in carry],
        F.char_length(bare).cast("long").alias("word_chars"),
        (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.get(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a))), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.size(lines).alias("_lines"),
        F.get(F.transform(F.array(words_col(F.col(text))), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), repeat_words_col(w).alias("r"))), F.lit(0)).alias("_w"))
    # Written once: derived columns would each repeat the array work when projections collapse.
    out = materialise(out, "base-statistics")
    out = out.withColumn("n_words", F.col("_w.n")).withColumn("n_repeat_words", F.col("_w.r")).drop("_w")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _unit(value: Column) -> Column:
    return F.round(value * UNIT).cast("long")


def _transformed(stats: DataFrame) -> DataFrame:
    """Counts are smoothed by a few pseudo-counts: short texts move little on chance."""
    n = F.col("n_words")
    return stats.withColumns({
        "z_length": _unit(F.log((F.col("word_chars") + 150) / (n + 30))),
        "z_symbols": _unit(F.log(1 + 100 * F.col("n_symbols") / (n + 30))),
        "z_lines": _unit(F.log(1 + 4 * F.col("n_dup_lines") / (F.col("_lines") + 8))),
        "z_repeat": _unit(F.log(1 + 4 * F.col("n_repeat_words") / (n + 30))),
    })


def _with_groups(rows: DataFrame, groups: DataFrame, bound: int = 100_000) -> DataFrame:
    """Null-safe join with per-group estimates; broadcast only when the counted groups are few,
    otherwise AQE splits the hot group's partition of the sort-merge join."""
    small = groups.limit(bound + 1).count() <= bound
    g = groups.withColumnsRenamed({k: f"r_{k}" for k in _KEYS})
    cond = [rows[k].eqNullSafe(g[f"r_{k}"]) for k in _KEYS]
    return rows.join(F.broadcast(g) if small else g, cond, "left").drop(*[f"r_{k}" for k in _KEYS])


def _quantile(rows: DataFrame, value: Column, share: float, name: str) -> DataFrame:
    """Per group the first histogram bin whose cumulative count reaches the share (mergeable, exact counts)."""
    bins = rows.groupBy(*_KEYS, value.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy(*_KEYS)
    run = bins.withColumn("_cum", F.sum("_n").over(by.orderBy("_bin"))).withColumn("_all", F.sum("_n").over(by))
    return run.where(F.col("_cum") >= share * F.col("_all")).groupBy(*_KEYS).agg(F.min("_bin").alias(name))


def _estimate(rows: DataFrame, names: list[str]) -> DataFrame:
    """Row count m, mean and covariance of every group's rows, by exact integer sums."""
    sums = [F.sum(n).alias(f"s_{n}") for n in names]
    prods = [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    g = rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).cast("double").alias("m"), *sums, *prods)
    g = g.withColumns({f"mu_{n}": F.col(f"s_{n}") / F.col("m") for n in names})
    return g.select(*_KEYS, "m", *[f"mu_{n}" for n in names], *[
        (F.col(f"p_{i}_{j}") / F.col("m") - F.col(f"mu_{a}") * F.col(f"mu_{b}")).alias(f"c_{i}_{j}")
        for i, a in enumerate(names) for j, b in enumerate(names) if i <= j])


def _inverted(g: DataFrame, names: list[str]) -> DataFrame:
    """Mean and inverse covariance (floored diagonal) of every group."""
    d = len(names)
    cols = {}
    for i in range(d):
        for j in range(d):
            c = F.col(f"c_{min(i, j)}_{max(i, j)}")
            cols[f"a_{i}_{j}"] = c + F.lit(float(FLOORS[names[i]] ** 2)) if i == j else c
            cols[f"a_{i}_{d + j}"] = F.lit(1.0 if i == j else 0.0)
    g = g.withColumns(cols)
    for k in range(d):  # one projection a pivot, on group rows only
        row = {f"a_{k}_{j}": F.col(f"a_{k}_{j}") / F.col(f"a_{k}_{k}") for j in range(2 * d)}
        g = g.withColumns(row)
        g = g.withColumns({f"a_{i}_{j}": F.col(f"a_{i}_{j}") - F.col(f"a_{i}_{k}") * F.col(f"a_{k}_{j}")
                           for i in range(d) if i != k for j in range(2 * d)})
    return g.select(*_KEYS, *[f"mu_{n}" for n in names],
                    *[F.col(f"a_{i}_{d + j}").alias(f"v_{i}_{j}") for i in range(d) for j in range(d)])


def _shrunk(groups: DataFrame, est: DataFrame, names: list[str], weight: int) -> DataFrame:
    """Estimates of the groups: each shrunk towards its language's, that one towards all rows'; missing ones count 0 rows."""
    values = [f"mu_{n}" for n in names] + [f"c_{i}_{j}" for i in range(len(names)) for j in range(i, len(names))]
    out = groups
    for level in range(3):
        lang, source = (F.col("g_lang") if level else F.lit(None)), (F.col("g_source") if level == 2 else F.lit(None))
        keyed = out.select("*", F.lit(level).alias("k_0"), lang.cast(groups.schema["g_lang"].dataType).alias("k_1"),
                           source.cast(groups.schema["g_source"].dataType).alias("k_2"))
        at = est.select(*[F.col(k).alias(f"e_{k}") for k in _KEYS], F.col("m").alias("e_m"), *[F.col(c).alias(f"e_{c}") for c in values])
        cond = [F.col(f"k_{i}").eqNullSafe(F.col(f"e_{k}")) for i, k in enumerate(_KEYS)]
        n = F.coalesce("e_m", F.lit(0.0))
        own = n / (n + weight)
        mixed = {c: F.col(f"e_{c}") if level == 0 else F.when(n > 0, own * F.col(f"e_{c}") + (1 - own) * F.col(c)).otherwise(F.col(c)) for c in values}
        out = keyed.join(at, cond, "left").select(*_KEYS, *[v.alias(c) for c, v in mixed.items()])
    return out


def _distance(names: list[str]) -> Column:
    dev = [F.col(n) - F.col(f"mu_{n}") for n in names]
    total = F.lit(0.0)
    for i in range(len(names)):
        for j in range(len(names)):
            total = total + F.col(f"v_{i}_{j}") * dev[i] * dev[j]
    return total


def mcd_outliers(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
                 support: float = 0.75, steps: int = 3, cutoff: float = 60.0, min_group: int = 50) -> DataFrame:
    """key, the base statistics, base_failed, d2 (squared robust distance), kept.

    ``cutoff`` is on squared distance; it is far beyond the chi-square tail because clean
    statistics have heavier tails than a normal law."""
    names = list(FLOORS)
    stats = base_statistics(docs.select(F.col(key), F.col(text), F.col(lang).alias("_l"), F.col(source).alias("_s")),
                            key, text, "_l", "_s")
    rows = _transformed(stats).withColumnsRenamed({"_l": "g_lang", "_s": "g_source"}).withColumn("g_level", F.lit(2))
    kinds = [rows.schema[k].dataType for k in ("g_lang", "g_source")]
    levels = F.array(*[F.struct(F.lit(i).alias("g_level"), (F.col("g_lang") if i else F.lit(None)).cast(kinds[0]).alias("g_lang"),
                                (F.col("g_source") if i == 2 else F.lit(None)).cast(kinds[1]).alias("g_source")) for i in range(3)])
    fit = rows.where(~F.col("base_failed")).select(F.explode(levels).alias("_g"), *names).select("_g.*", *names)
    medians = None
    for n in names:
        q = _quantile(fit, F.col(n), 0.5, f"mu_{n}").withColumn("_k", F.struct(*_KEYS))
        q = q.select("_k", f"mu_{n}")
        medians = q if medians is None else medians.join(q, "_k")
    d = len(names)
    est = medians.select("_k.*", *[F.col(f"mu_{n}").cast("double").alias(f"mu_{n}") for n in names],
                         *[F.lit(1.0 / FLOORS[names[i]] ** 2 if i == j else 0.0).alias(f"v_{i}_{j}") for i in range(d) for j in range(d)])
    fitted, est = None, materialise(est, "mcd-start")
    bin_ = F.floor(64 * F.log2(1 + F.greatest(F.col("d2"), F.lit(0.0))))
    for _ in range(steps):
        near = _with_groups(fit, est).withColumn("d2", _distance(names)).withColumn("_b", bin_).select(*_KEYS, *names, "_b")
        limit = materialise(_quantile(near, F.col("_b"), support, "_limit"), "mcd-limit")
        fitted = materialise(_estimate(_with_groups(near, limit).where(F.col("_b") <= F.col("_limit")), names), "mcd-step")
        est = _inverted(fitted, names)
    est = materialise(_inverted(_shrunk(rows.select(*_KEYS).distinct(), fitted, names, min_group), names), "mcd-shrunk")
    out = _with_groups(rows, est).withColumn("d2", _distance(names))
    # Without a single row to fit on there is no estimate: only the base rule judges.
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2",
                      (~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff)).alias("kept"))

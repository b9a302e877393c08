"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every document becomes a vector of transformed statistics. Per language and source
the half-plus subset with the smallest covariance determinant is searched by
concentration steps: distances under the present centre and scatter, the subset of
the smallest ones, centre and scatter of that subset, and again. The final scatter
is taken from all rows near it, and a document is rejected where its squared
Mahalanobis distance exceeds the cut.

Only DataFrame functions are used. Groups are never gathered: a step is one
histogram of log-distances (a few hundred bins for each group, where "the h smallest"
is read off) and one sum of products, both with partial aggregation. The scatter gets
a floor per statistic, so that a statistic that is constant in most documents
does not turn the first document that differs into an outlier.

Defined results: null text has no words and fails the base rule; null language or
source is a group of its own; a group of one document has distance 0; repeated rows
count as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, text_of, written
from .components import prepare

SUBSET = 0.75
STEPS = 4
BINS_PER_LOG = 16
# Transformed statistics and the smallest standard deviation that is believed for each.
FLOORS = {"word_length": 0.15, "symbols": 0.15, "upper": 0.05, "marks": 0.15, "repeats": 0.10, "lines": 0.10}
NAMES = list(FLOORS)
P = len(NAMES)
MIN_WORDS = 50


def chi_square(x: float, k: int) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= half / (a + n)
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi_square_point(p: float, k: int) -> float:
    lo, hi = 1e-9, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, k) < p else (lo, mid)
    return hi


# One clean document in a hundred thousand of a normal sample lies beyond.
MOST_DISTANCE = chi_square_point(0.99999, P)


def shrink(part: float) -> float:
    """Factor that makes the scatter of the nearest ``part`` of a normal sample consistent."""
    return part / chi_square(chi_square_point(part, P), P + 2)


def statistics(documents: DataFrame) -> DataFrame:
    """The base statistics of every row, over whole texts."""
    text = text_of(documents)
    words = documents.select(
        F.col("doc_id"), F.to_json(F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))).alias("grp"),
        text.alias("t"), F.array_remove(F.split(text, SPACE), "").alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    size = words.withColumn("n_words", F.size("words")).withColumn("packed", F.array_join("words", "")).withColumn("lines", lines)
    without = lambda pattern: F.length("packed") - F.length(F.regexp_replace("packed", pattern, ""))
    # Repeated windows: hashes with their places, sorted, compared to both neighbours.
    windows = F.when(
        F.col("n_words") >= 3,
        F.transform(F.sequence(F.lit(0), F.col("n_words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    counted = size.select(
        "doc_id", "grp", F.col("n_words").cast("long").alias("n_words"), F.length("packed").cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), without(r"\p{Lu}+").alias("n_upper"), without(r"[!?]+").alias("n_marks"), windows.alias("h"))
    placed = counted.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("h")
    twice = placed.withColumn("d", F.filter("s", lambda e, k: F.coalesce(F.get("s", k - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(F.get("s", k + 1)["x"] == e["x"], F.lit(False)))).drop("s")
    covered = F.size(F.array_distinct(F.flatten(F.transform("d", lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))
    return twice.withColumn("n_repeat_words", F.when(F.col("d").isNull(), 0).otherwise(covered).cast("long")).drop("d")


def vectors(stats: DataFrame) -> DataFrame:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = {
        "word_length": F.log1p(F.col("word_chars") / words), "symbols": F.log1p(10 * F.col("n_symbols") / words), "upper": F.col("n_upper") / chars,
        "marks": F.log1p(10 * F.col("n_marks") / words), "repeats": F.col("n_repeat_words") / words,
        "lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    }
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select(
        "doc_id", "grp", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        *[F.round(v, 9).alias(f"v_{n}") for n, v in values.items()])


def _v(i: int) -> Column:
    return F.col(f"v_{NAMES[i]}")


def factors(moments: DataFrame, scale: float) -> DataFrame:
    """Centre and Cholesky factor of each group: columns m0.. and l00, l10, l11, ..."""
    n = F.col("n")
    out = moments.select("grp", *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)], *[
        ((F.col(f"s{i}_{j}") / n - F.col(f"s{i}") / n * F.col(f"s{j}") / n) * scale + (FLOORS[NAMES[i]] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}")
        for i in range(P) for j in range(i + 1)])
    for i in range(P):
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j), F.col(f"c{i}_{j}"))  # noqa: B023
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}_{j}"))
    return out.select("grp", *[f"m{i}" for i in range(P)], *[f"l{i}_{j}" for i in range(P) for j in range(i + 1)])


def distances(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance to their group."""
    out = rows.join(fitted, "grp")
    for i in range(P):
        rest = reduce(lambda a, k: a - F.col(f"l{i}_{k}") * F.col(f"y{k}"), range(i), _v(i) - F.col(f"m{i}"))  # noqa: B023
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    return out.withColumn("d2", F.round(reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)]), 6)).select(*rows.columns, "d2")


def sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("grp").agg(
        F.count("*").alias("n"), *[F.sum(_v(i)).alias(f"s{i}") for i in range(P)], *[F.sum(_v(i) * _v(j)).alias(f"s{i}_{j}") for i in range(P) for j in range(i + 1)])


def nearest(rows: DataFrame) -> DataFrame:
    """The rows of each group up to the bin in which its nearest ``SUBSET`` is complete."""
    binned = rows.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_LOG).cast("int"))
    histogram = binned.groupBy("grp", "bin").agg(F.count("*").alias("n"))
    # A group has a few hundred bins at most: they fit an array.
    bins = histogram.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("all"))
    enough = F.ceil(F.col("all") * SUBSET)
    upto = F.aggregate(
        "bins", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("upto")),
        lambda a, b: F.struct((a["seen"] + b["n"]).alias("seen"), F.when(a["seen"] < F.col("enough"), b["bin"]).otherwise(a["upto"]).alias("upto")), lambda a: a["upto"])
    limits = bins.withColumn("enough", enough).select("grp", upto.alias("upto"))
    return binned.join(limits, "grp").where("bin <= upto").select("grp", *[f"v_{n}" for n in NAMES])


def start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges: a centre and a diagonal scatter that outliers don't move."""
    quartiles = rows.groupBy("grp").agg(*[F.percentile_approx(_v(i), [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)])
    middle = [F.get(f"q{i}", F.lit(1)).alias(f"m{i}") for i in range(P)]
    spread = lambda i: F.sqrt(F.pow((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349, 2) + FLOORS[NAMES[i]] ** 2)
    return quartiles.select("grp", *middle, *[(spread(i) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i in range(P) for j in range(i + 1)])


def robust_outliers(documents: DataFrame, most_distance: float = MOST_DISTANCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept."""
    prepare(documents.sparkSession)
    table = written(vectors(statistics(documents)), "statistics")
    rows = table.select("grp", *[f"v_{n}" for n in NAMES])
    fitted = start(rows).checkpoint()
    for _ in range(STEPS):
        fitted = factors(sums(nearest(distances(rows, fitted))), shrink(SUBSET)).checkpoint()
    near = distances(rows, fitted).where(F.col("d2") <= chi_square_point(0.975, P))
    final = factors(sums(near), shrink(0.975)).checkpoint()
    # Where no row is near the subset's own scatter (a group of a few), the subset's stays.
    final = final.union(fitted.join(final.select("grp"), "grp", "left_anti"))
    scored = distances(table, final)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.sqrt("d2").alias("distance"),
        (~F.col("base_failed") & (F.col("d2") <= most_distance)).alias("kept"))

"""Quality rules: base rules, then robust multivariate outliers.

Each text gives a vector of four transformed statistics. Per language and source, a
minimum-covariance-determinant estimate says where most vectors lie: concentration
steps keep the half of a group nearest to the current centre and estimate centre and
covariance from them again, from two starts, and the estimate of smaller determinant
stays. So junk of up to nearly half of a group cannot carry the estimate along. A text is rejected if its squared Mahalanobis distance is over a
cutoff. Everything is built-in expressions; a step is one aggregation.

Vectors are whole thousandths and their sums whole numbers, so results do not depend
on how rows are grouped into tasks. A step never sorts a group: it sums rows by bin
of distance and takes bins, nearest first, until they hold the wanted share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions.binding import bind
from catloom.llm.common import keep, word_array

WINDOW = 8
DIMS = (1, 2, 3, 4)
PAIRS = tuple((i, j) for i in DIMS for j in DIMS if j <= i)
#: Smallest spread of each statistic, in thousandths: mean word length, and symbols,
#: repeated lines, repeated words per hundred words, all as logarithms.
FLOORS = (150, 400, 500, 650)
STEPS = 5
#: Share of a group that a step keeps, as a fraction, in ``judge``.
KEPT = (1, 2)
#: Sources with fewer vectors in a language are estimated together.
FEW = 50
#: Chi-square with four degrees of freedom: median, and one in a million.
MEDIAN, CUTOFF = 3.357, 33.4


def base_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` and text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text counts as empty. Windows of eight words are compared as text, after
    a hash has shown that a text may repeat one at all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = bind(docs.select(*carry, "text"), words=word_array(F.col("text")), lines=lines)
    starts = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    df = df.select(
        *carry, "text", "words",
        F.size("words").cast("long").alias("n_words"),
        (F.length(text) - F.length(F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", ""))).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        starts.alias("starts"),
    )
    df = bind(df, hashes=F.transform("starts", lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    windows = F.array_sort(
        F.transform("starts", lambda i: F.struct(F.array_join(F.slice("words", i, WINDOW), " ").alias("w"), i.alias("at")))
    )
    empty = F.array().cast("array<struct<w:string,at:int>>")
    df = bind(df, windows=F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), windows).otherwise(empty))
    same = "filter(windows, (x, i) -> coalesce(x.w = get(windows, i - 1).w, false) OR coalesce(x.w = get(windows, i + 1).w, false))"
    df = bind(df.drop("words", "starts", "hashes"), found=F.expr(f"array_sort(transform({same}, x -> x.at))"))
    covered = F.expr(
        f"aggregate(transform(found, (p, i) -> least({WINDOW}, coalesce(get(found, i + 1) - p, {WINDOW}))), 0L, (a, b) -> a + b)"
    )
    counted = df.select(*[c for c in df.columns if c not in ("windows", "found")], covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """x1 to x4, in thousandths."""
    per_hundred = [F.log(1 + 100 * F.col(c) / F.col("n_words")) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    logs = [F.log(F.col("word_chars") / F.col("n_words")), *per_hundred]
    return [F.floor(v * 1000 + F.lit(0.5)).cast("long").alias(f"x{i}") for i, v in zip(DIMS, logs)]


# The expressions below are SQL text, the same for each step.

SUMS = [f"sum(x{i}) AS s{i}" for i in DIMS] + [f"sum(x{i} * x{j}) AS q{i}{j}" for i, j in PAIRS]
MEANS = [f"s{i} / CAST(n AS DOUBLE) AS m{i}" for i in DIMS]


def covariance() -> list[str]:
    ridge = {i: f" + {float(f * f)}" for i, f in zip(DIMS, FLOORS)}
    return [f"q{i}{j} / CAST(n AS DOUBLE) - m{i} * m{j}{ridge[i] if i == j else ''} AS c{i}{j}" for i, j in PAIRS]


def cholesky() -> list[tuple[int, int, str]]:
    """Entries of the lower triangle, each from those before it."""
    out = []
    for j in DIMS:
        for i in DIMS[j - 1 :]:
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            out.append((i, j, f"sqrt(c{i}{j}{less})" if i == j else f"(c{i}{j}{less}) / l{j}{j}"))
    return out


def _estimate(moments: DataFrame) -> DataFrame:
    """Means and the triangle's entries, from n, s and q."""
    params = moments.selectExpr("g", "start", "n", *[f"q{i}{j}" for i, j in PAIRS], *MEANS)
    params = params.selectExpr("g", "start", *[f"m{i}" for i in DIMS], *covariance())
    for i, j, entry in cholesky():
        params = params.withColumn(f"l{i}{j}", F.expr(entry))
    return params.selectExpr("g", "start", *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i, j in PAIRS])


def distance(df: DataFrame) -> DataFrame:
    """Add d2, from x, m and l."""
    for i in DIMS:
        less = "".join(f" - l{i}{k} * y{k}" for k in range(1, i))
        df = df.withColumn(f"y{i}", F.expr(f"(x{i} - m{i}{less}) / l{i}{i}"))
    return df.withColumn("d2", F.expr(" + ".join(f"y{i} * y{i}" for i in DIMS))).drop(*[f"y{i}" for i in DIMS])


def _bins(vectors: DataFrame, params: DataFrame) -> DataFrame:
    """Counts and sums by bin of distance, with the count of the bins before and of the group."""
    near = distance(vectors.join(params, "g")).withColumn("bin", F.expr("CAST(least(floor(64 * ln(1 + d2)), 2000) AS INT)"))
    bins = near.groupBy("g", "start", "bin").agg(F.expr("count(*)").alias("k"), *[F.expr(s) for s in SUMS])
    return bins.selectExpr(
        "*",
        "coalesce(sum(k) OVER (PARTITION BY g, start ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nearer",
        "sum(k) OVER (PARTITION BY g, start) AS total",
    )


def _middles(counts: DataFrame) -> DataFrame:
    """g, dim and m, the median of x, of counts k by g, dim and x."""
    upto = counts.selectExpr(
        "*", "sum(k) OVER (PARTITION BY g, dim ORDER BY x) AS upto", "sum(k) OVER (PARTITION BY g, dim) AS total"
    )
    return upto.groupBy("g", "dim").agg(F.expr("min(x) FILTER (WHERE 2 * upto >= total)").alias("m"))


def _starts(vectors: DataFrame) -> DataFrame:
    """Start 0: medians and median absolute deviations, from counts of values. Start 1: plain mean and covariance."""
    values = vectors.selectExpr("g", f"stack({len(DIMS)}, {', '.join(f'{i}, x{i}' for i in DIMS)}) AS (dim, x)")
    counts = keep(values.groupBy("g", "dim", "x").agg(F.expr("count(*)").alias("k")), "mcd-values")
    middles = keep(_middles(counts), "mcd-middles")
    away = counts.join(middles, ["g", "dim"]).selectExpr("g", "dim", "abs(x - m) AS x", "k")
    away = _middles(away.groupBy("g", "dim", "x").agg(F.sum("k").alias("k"))).withColumnRenamed("m", "away")
    floor = f"element_at(array({', '.join(map(str, FLOORS))}), dim)"
    spread = middles.join(away, ["g", "dim"])
    spread = spread.selectExpr("g", "dim", "CAST(m AS DOUBLE) AS m", f"sqrt(pow(1.4826D * away, 2) + {floor} * {floor}) AS l")
    pick = [F.expr(f"max(m) FILTER (WHERE dim = {i})").alias(f"m{i}") for i in DIMS]
    pick += [F.expr(f"max(l) FILTER (WHERE dim = {i})" if i == j else "0.0D").alias(f"l{i}{j}") for i, j in PAIRS]
    robust = spread.groupBy("g").agg(*pick).withColumn("start", F.lit(0))
    plain = vectors.groupBy("g").agg(F.expr("count(*)").alias("n"), *[F.expr(s) for s in SUMS]).withColumn("start", F.lit(1))
    return robust.unionByName(_estimate(plain))


def estimates(vectors: DataFrame, kept: tuple[int, int] = (3, 4)) -> DataFrame:
    """g, means, triangle and ``scale`` of each group of ``vectors`` (g, x1 to x4); small tables between steps are kept.

    A step keeps the share ``kept`` of a group; junk of more than the rest breaks the estimate.
    """
    params = keep(_starts(vectors), "mcd-start")
    for step in range(STEPS):
        taken = _bins(vectors, params).where(f"{kept[1]} * nearer < {kept[0]} * total")
        sums = [F.sum(c).alias(c) for c in [f"s{i}" for i in DIMS] + [f"q{i}{j}" for i, j in PAIRS]]
        params = keep(_estimate(taken.groupBy("g", "start").agg(F.sum("k").alias("n"), *sums)), f"mcd-{step}")
    size = " * ".join(f"l{i}{i}" for i in DIMS)
    best = params.groupBy("g").agg(F.expr(f"min_by(start, struct({size}, start))").alias("start"))
    params = params.join(best, ["g", "start"])
    middle = _bins(vectors, params).where("2 * nearer < total").groupBy("g").agg(F.max("bin").alias("bin"))
    scale = F.expr(f"greatest(1.0D, (exp((bin + 1) / 64.0D) - 1) / {MEDIAN}D)").alias("scale")
    return keep(params.drop("start").join(middle.select("g", scale), "g"), "mcd")


def judge(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` and the base statistics, base_failed and kept of every row (doc_id, text, lang, source).

    Rows that fail the base rules give no vector and are not kept. Null languages and
    sources are groups of their own; sources with under ``FEW`` vectors in a language
    share one group. Null and empty texts fail the base rules. Repeated rows and ids
    stay. Only the statistics and ``carry`` are written to the shared folder.
    """
    carry = carry or ("doc_id",)
    names = {c: f"_{i}" for i, c in enumerate(carry)}
    own = docs.select(
        *[F.col(c).alias(n) for c, n in names.items()], F.col("lang").alias("_lang"), F.col("source").alias("_source"), "text"
    )
    stats = keep(base_statistics(own, *names.values(), "_lang", "_source").drop("text"), "statistics", compression="zstd")
    passed = stats.where("NOT base_failed")
    sizes = passed.groupBy("_lang", "_source").agg(F.expr("count(*)").alias("size"))
    few = F.col("size") < FEW
    # Names are told apart by their lengths, null by none.
    named = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in ("_lang", "_source")]
    group = F.concat(named[0], F.lit("/"), F.when(few, "*").otherwise(named[1]))
    groups = keep(sizes.select(F.col("_lang").alias("a"), F.col("_source").alias("b"), group.alias("g")), "mcd-groups")
    within = F.col("_lang").eqNullSafe(F.col("a")) & F.col("_source").eqNullSafe(F.col("b"))
    vectors = keep(passed.join(groups, within).select("g", *vector()), "vectors")
    # Kept, as Spark then knows that it is small and moves no row of ``carry`` to join it.
    found = keep(groups.join(estimates(vectors, KEPT), "g"), "mcd-found")
    placed = distance(stats.join(found, within, "left").select("*", *vector_or_null()))
    kept = F.coalesce(~F.col("base_failed") & (F.col("d2") <= CUTOFF * F.col("scale")), F.lit(False))
    return placed.select(
        *[F.col(n).alias(c) for c, n in names.items()],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
    )


def vector_or_null() -> list[Column]:
    return [F.when(~F.col("base_failed"), v).alias(f"x{i}") for i, v in zip(DIMS, vector())]

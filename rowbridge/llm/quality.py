"""Quality rules: counting rules, then robust multivariate outliers per language and source.

Every statistic is one narrow projection over the whole text. The outlier rule
estimates, for every (language, source), centre and covariance of the
transformed statistics by the minimum covariance determinant: the share ``core``
of the group's documents whose covariance has the smallest determinant. Three
deterministic starts (``_starts``) take two concentration steps each, which keep
the documents of the smallest Mahalanobis distance and estimate anew from those;
the start of the smallest log-determinant goes on, per group, until it falls no more.

A step is one aggregation for all starts and groups: documents are counted and
summed per (group, start, bin of the distance) and the innermost bins that hold
the core are added up, the last of them by the share that the core still needs.
A Cholesky factor in column arithmetic gives the next distance and, by its
diagonal, the determinant. Only narrow numbers are staged; no step sees a text.

Two fixed terms keep covariances of small groups regular: ``FLOORS``, and
``prior`` documents of the whole language. As neither changes between steps,
a step still never raises the determinant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.llm.common import SPACE_CLASS, WORD_CLASS, put, text_or_empty, unused, words_of

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = r"[#*$%&|<>]"

# Of each transformed statistic: the spread below which differences do not count.
FLOORS = (0.10, 0.05, 0.15, 0.12, 0.50)
DIMENSIONS = len(FLOORS)
_GRID = 256
_BINS_PER_E = 32
SALTS = 32
_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
_CENTRE = [f"m{i}" for i in range(DIMENSIONS)]
_FACTOR = [f"l{i}{j}" for i, j in _PAIRS]
_SUMS = ["n", *[f"s{i}" for i in range(DIMENSIONS)], *[f"q{i}{j}" for i, j in _PAIRS]]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts ``COUNTS`` of each whole text; a null text has no words.

    ``n_repeat_words`` are the words covered by three-word windows found at
    least twice in the text. Equal windows are found by 64-bit hashes, sorted
    with their places only in texts where two hashes agree.
    """
    names = list(docs.columns)
    t, w, tri, lines = (unused(names, n) for n in ("__text", "__words", "__tri", "__lines"))
    split = docs.withColumn(t, text_or_empty(text))
    split = split.withColumn(w, words_of(F.col(t))).withColumn(
        lines, F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(WORD_CLASS))
    )
    n = F.size(F.col(w))

    def window_hash(i: Column) -> Column:
        return F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))

    split = split.withColumn(
        tri, F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window_hash)).otherwise(F.array().cast("array<bigint>"))
    )
    return put(
        split,
        n_words=n.cast("long"),
        word_chars=F.length(F.concat_ws("", F.col(w))).cast("long"),
        n_symbols=F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long"),
        n_lines=F.size(F.col(lines)).cast("long"),
        n_dup_lines=(F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).cast("long"),
        n_repeat_words=_covered(F.col(tri)).cast("long"),
    ).drop(t, w, tri, lines)


def _covered(hashes: Column) -> Column:
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def keep_equal_neighbours(p: Column) -> Column:
        starts = F.filter(
            F.transform(
                p,
                lambda x, k: F.when(
                    (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    # One pass through a lambda binds the sorted array once.
    covered = F.get(F.transform(F.array(placed), keep_equal_neighbours), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _features() -> list[Column]:
    """The transformed statistics of a document with words."""
    words, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
        F.log10(words),
    ]


def _f(i: int) -> Column:
    return F.col(f"f{i}")


def _joined(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the estimates of their group, one row for each start.

    Estimates are repeated per salt, so that a join that shuffles splits a group
    over ``SALTS`` tasks, and a later aggregate combines before it gathers a group.
    """
    salted = estimates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return df.withColumn("__salt", salt).join(salted, ["grp", "__salt"], "left").drop("__salt")


def _with_distance(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance, by forward substitution."""
    joined = _joined(df, estimates)
    solved: list[Column] = []
    for i in range(DIMENSIONS):
        rest = _f(i) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
        solved.append(F.col(f"z{i}") * F.col(f"z{i}"))
    d2 = solved[0]
    for x in solved[1:]:
        d2 = d2 + x
    used = {*_CENTRE, *_FACTOR, "logdet"} & set(estimates.columns)
    return joined.withColumn("d2", d2).drop(*used, *[f"z{i}" for i in range(DIMENSIONS)])


def _factor(moments: DataFrame) -> DataFrame:
    """Cholesky factor and log-determinant from (grp, start, centre m*, covariance c*)."""
    df = moments
    for i, j in _PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        if i == j:
            # The floor is added to the variance, and rounding cannot undercut it.
            entry = F.sqrt(F.greatest(rest, F.lit(0.0)) + F.lit(FLOORS[i] ** 2))
        else:
            entry = rest / F.col(f"l{j}{j}")
        df = df.withColumn(f"l{i}{j}", entry)
    logdet = F.lit(0.0)
    for i in range(DIMENSIONS):
        logdet = logdet + 2 * F.log(F.col(f"l{i}{i}"))
    return df.select("grp", "start", *_CENTRE, *_FACTOR, logdet.alias("logdet"))


def _moments(sums: DataFrame) -> DataFrame:
    centre = sums.select("*", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIMENSIONS)])
    covariance = [
        (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}{j}") for i, j in _PAIRS
    ]
    return centre.select("grp", "start", *_CENTRE, *covariance)


def _plain_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(_f(i)).alias(f"s{i}") for i in range(DIMENSIONS)],
        *[F.sum(_f(i) * _f(j)).alias(f"q{i}{j}") for i, j in _PAIRS],
    ]


def _starts(stats: DataFrame) -> DataFrame:
    """Three first estimates per group.

    0: medians, and quartiles as spreads, without correlations. 1: medians, and the
    covariance of the directions from the medians, in which a far document weighs
    no more than a near one. 2: mean and covariance of all documents. Quartiles are
    taken on a fixed grid, so that states stay small.
    """
    quartiles = stats.groupBy("grp").agg(
        *[F.percentile(F.round(_f(i) * _GRID) / _GRID, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}")
          for i in range(DIMENSIONS)]
    )

    def spread(i: int) -> Column:
        middle_half = (F.get(F.col(f"p{i}"), F.lit(2)) - F.get(F.col(f"p{i}"), F.lit(0))) / 1.349
        return F.sqrt(middle_half * middle_half + FLOORS[i] ** 2)

    middles = stage(
        quartiles.select(
            "grp",
            *[F.get(F.col(f"p{i}"), F.lit(1)).alias(f"m{i}") for i in range(DIMENSIONS)],
            *[spread(i).alias(f"d{i}") for i in range(DIMENSIONS)],
        ),
        "quality-middles",
    )
    away = _joined(stats, middles)
    for i in range(DIMENSIONS):
        away = away.withColumn(f"u{i}", (_f(i) - F.col(f"m{i}")) / F.col(f"d{i}"))
    length = F.lit(1e-12)
    for i in range(DIMENSIONS):
        length = length + F.col(f"u{i}") * F.col(f"u{i}")
    sums = away.withColumn("r2", length).groupBy("grp").agg(
        *_plain_sums(),
        *[F.sum(F.col(f"u{i}") * F.col(f"u{j}") / F.col("r2")).alias(f"g{i}{j}") for i, j in _PAIRS],
        *[F.max(F.col(c)).alias(c) for c in (*_CENTRE, *[f"d{i}" for i in range(DIMENSIONS)])],
    )

    def from_medians(start: int, covariance) -> DataFrame:
        return sums.select("grp", F.lit(start).alias("start"), *_CENTRE,
                           *[covariance(i, j).cast("double").alias(f"c{i}{j}") for i, j in _PAIRS])

    sums = stage(sums, "quality-sums")
    quartile = from_medians(0, lambda i, j: F.col(f"d{i}") * F.col(f"d{i}") - FLOORS[i] ** 2 if i == j else F.lit(0.0))
    direction = from_medians(
        1, lambda i, j: F.col(f"g{i}{j}") * F.col(f"d{i}") * F.col(f"d{j}") * DIMENSIONS / F.col("n")
    )
    whole = _moments(sums.select("grp", F.lit(2).alias("start"), *_SUMS))
    return _factor(quartile.unionByName(direction).unionByName(whole))


def _binned(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """Counts and sums per (grp, start, bin of d2), with the count of all bins before."""
    bins = F.floor(F.log(F.col("d2") + 1e-6) * _BINS_PER_E).cast("int")
    summed = _with_distance(stats, estimates).groupBy("grp", "start", bins.alias("bin")).agg(*_plain_sums())
    group = Window.partitionBy("grp", "start")
    inner = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(inner), F.lit(0.0))
    return summed.withColumn("before", before).withColumn("all", F.sum("n").over(group))


def _core(stats: DataFrame, estimates: DataFrame, core: float) -> DataFrame:
    """Sums of the ``ceil(core * n)`` documents nearest to each estimate."""
    needed = F.ceil(F.col("all") * core)
    share = F.least(F.lit(1.0), (needed - F.col("before")) / F.col("n"))
    inside = _binned(stats, estimates).where(F.col("before") < needed).withColumn("share", share)
    return inside.groupBy("grp", "start").agg(*[F.sum(F.col(c) * F.col("share")).alias(c) for c in _SUMS])


def _language() -> Column:
    return F.struct(F.col("grp.lang").alias("lang")).alias("language")


def _estimated(cores: DataFrame, language: DataFrame, prior: int) -> DataFrame:
    """Estimates from the sums of cores and ``prior`` documents of the language."""
    blended = cores.select("grp", "start", _language(), *_SUMS).join(language, "language")
    weight = F.lit(float(prior)) / F.col("a_n")
    return _factor(_moments(blended.select(
        "grp", "start", *[(F.col(c) + F.col(f"a_{c}") * weight).alias(c) for c in _SUMS]
    )))


def _lower(now: DataFrame, then: DataFrame | None = None) -> DataFrame:
    """Per group the estimate of the smallest determinant, and by how much it ``fell``."""
    both = now.withColumn("late", F.lit(True))
    if then is not None:
        both = both.unionByName(then.drop("fell").withColumn("late", F.lit(False)))
    kept = F.min_by(F.struct("start", *_CENTRE, *_FACTOR, "logdet"), F.struct("logdet", "start")).alias("kept")
    fell = (F.max(F.when(~F.col("late"), F.col("logdet"))) - F.min("logdet")).alias("fell")
    return both.groupBy("grp").agg(kept, fell).select("grp", "kept.*", "fell")


# Median of the chi-square distribution with DIMENSIONS degrees of freedom.
CHI2_MEDIAN = 4.351


def chi_square_cutoff(tail: float) -> float:
    """The squared distance that a share ``tail`` of normal documents exceeds, for 5 degrees of freedom."""
    if not 0 < tail < 1:
        raise ValueError("the share beyond the cutoff must lie between 0 and 1")
    low, high = 0.0, 2000.0
    for _ in range(100):
        x = (low + high) / 2
        beyond = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
        low, high = (x, high) if beyond > tail else (low, x)
    return high


def fit_outliers(
    counts: DataFrame, lang: str = "lang", source: str = "source", core: float = 0.75, prior: int = 64,
    tolerance: float = 1e-3, most_steps: int = 50,
) -> DataFrame:
    """Estimates per group ``grp`` (struct of lang and source, nulls being values).

    Steps end once no group's log-determinant falls by ``tolerance``, at the latest
    after ``most_steps``. ``start`` tells which start won, ``logdet`` its determinant.
    ``unit`` divides the distances of a group whose median exceeds that of the
    chi-square distribution; it never enlarges a distance. Documents the counting rules reject take no part.
    An empty table gives no estimates.
    """
    stats = stage(_statistics(counts, lang, source).select("grp", *[f"f{i}" for i in range(DIMENSIONS)]), "quality")
    cores = stage(_core(stats, stage(_starts(stats), "quality-start"), core), "quality-core")
    # The language's documents, by the cores of the first start, stay the same in all steps.
    language = stage(
        cores.where("start = 0").groupBy(_language()).agg(*[F.sum(c).alias(f"a_{c}") for c in _SUMS]),
        "quality-language",
    )
    first = stage(_estimated(cores, language, prior), "quality-first")
    second = stage(_estimated(_core(stats, first, core), language, prior), "quality-second")
    best = stage(_lower(second), "quality-best")
    for _ in range(most_steps):
        step = _estimated(_core(stats, best.drop("fell"), core), language, prior)
        best = stage(_lower(step, best), "quality-best")
        if (best.agg(F.max("fell")).head()[0] or 0.0) < tolerance:
            break
    best = best.drop("fell")
    middle = (
        _binned(stats, best)
        .where(F.col("before") < F.col("all") / 2)
        .groupBy("grp")
        .agg(F.greatest(F.lit(1.0), F.exp((F.max("bin") + 1) / float(_BINS_PER_E)) / CHI2_MEDIAN).alias("unit"))
    )
    return stage(best.join(middle, "grp", "left"), "quality-fit")


def _statistics(counts: DataFrame, lang: str, source: str) -> DataFrame:
    passing = counts.select(
        F.struct(column(lang).alias("lang"), column(source).alias("source")).alias("grp"), *COUNTS
    ).where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return passing.select("grp", *[f.alias(f"f{i}") for i, f in enumerate(_features())])


def judge(
    counts: DataFrame, estimates: DataFrame, lang: str = "lang", source: str = "source", tail: float = 1e-5
) -> DataFrame:
    """Add ``base_failed``, ``distance`` (null if not measured) and ``kept``.

    A document is an outlier if its distance passes the chi-square quantile that
    a share ``tail`` of normal documents would pass.

    The table of estimates is small and read from files, so Spark broadcasts it
    if it measures below its threshold and else joins with skew handling. A
    document whose group has no estimate, or whose distance is null, is kept if
    the counting rules keep it.
    """
    names = list(counts.columns)
    carried = unused(names, "__row")
    rows = counts.select(
        F.struct(*[column(n) for n in names]).alias(carried),
        F.struct(column(lang).alias("lang"), column(source).alias("source")).alias("grp"),
        *[column(c) for c in COUNTS],
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    rows = rows.select(carried, "grp", failed.alias("__failed"),
                       *[F.when(~failed, f).alias(f"f{i}") for i, f in enumerate(_features())])
    measured = _with_distance(rows, estimates.drop("start")).withColumn("__distance", F.col("d2") / F.col("unit"))
    verdict = measured.select(
        F.col(f"`{carried}`.*"),
        F.col("__failed").alias("__base_failed"),
        F.col("__distance"),
        (~F.col("__failed") & F.coalesce(F.col("__distance") <= chi_square_cutoff(tail), F.lit(True))).alias("__kept"),
    )
    return put(
        verdict, base_failed=F.col("__base_failed"), distance=F.col("__distance"), kept=F.col("__kept")
    ).drop("__base_failed", "__distance", "__kept")

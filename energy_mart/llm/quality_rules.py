"""Quality rules: fixed limits, and robust outliers by minimum covariance determinant (native).

``measure(docs)`` counts words, characters of words, symbols, repeated lines and words inside
repeated three-word windows. ``judge(measured)`` adds ``base_failed`` and ``kept``: a document that
passes the fixed limits is dropped only when its vector of transformed ratios lies too far from
the robust centre of its language and source.

Robust estimate per group: the start is the half of the group that is nearest to the medians;
concentration steps then take mean and covariance of a half and keep the nearest half, which
never raises the determinant. Means, covariances and the half's limit (a histogram of distances)
are plain aggregates, combined before the shuffle, so one group with a third of all rows does no
harm. A group of fewer than LEAST_DOCUMENTS is judged by the estimate of its whole language, big
groups included; a language of fewer by the estimate of the whole corpus, whatever its size. So every
document is judged by distance.

Null or empty text: no words, so the fixed limit on words fails. Null language or source is a group
of its own. Repeated rows count as often as they stand. Extra columns are kept by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import BLANKS, join_small, settle, words

#: Fixed values.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, WINDOW, MOST_REPEATED_PCT = 50, 3, 50
#: Parameters of the estimate. CUTOFF: 1 - 1e-6 quantile of chi square with 4 degrees.
LEAST_DOCUMENTS, STEPS, CUTOFF = 200, 3, 33.4
#: Of the middle half in four dimensions: its covariance is this much too small under a normal law.
CONSISTENCY = 2.0
#: Per-dimension least variance: ratios that are the same for half of a group still have a width.
#: A few repeated lines or phrases are ordinary, so these two axes are wide.
LEAST_VARIANCE = (0.01, 0.05, 0.25, 1.0)
#: Distances are counted in bins of this width of their logarithm.
BIN = 0.005
ROW = "__row"
AXES = ("x0", "x1", "x2", "x3")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(places: Column) -> Column:
    """Words under windows that start at the sorted ``places``."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, p: F.struct((a.n + F.least(F.lit(WINDOW), p - a.last)).alias("n"), p.alias("last"))
    return F.aggregate(places, start, step, lambda a: a.n)


def measure(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` but clashing ones, and the five counts (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.drop(*COUNTS, "base_failed", "kept")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{BLANKS}]"))
    a = kept.withColumns({"__w": words(F.col("text")), "__l": lines})
    n = F.size("__w")
    # Windows are compared by a 64-bit hash of their words, within one text.
    window = lambda i: F.xxhash64(*[F.get("__w", i + F.lit(k)) for k in range(WINDOW)])
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    b = a.withColumns(
        {
            "n_words": n,
            "word_chars": F.aggregate("__w", F.lit(0), lambda s, w: s + F.length(w)),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
            "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
            "__h": hashes,
        }
    ).drop("__w", "__l")
    pairs = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    c = b.withColumn("__p", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), pairs)).drop("__h")
    same = lambda s, i: (s.h == F.get("__p", i - 1).h) | (s.h == F.get("__p", i + 1).h)
    twice = F.filter("__p", lambda s, i: F.coalesce(same(s, i), F.get("__p", i - 1).h == s.h, F.get("__p", i + 1).h == s.h, F.lit(False)))
    places = F.array_sort(F.transform(twice, lambda s: s.i))
    d = c.withColumn("n_repeat_words", F.coalesce(_covered(places), F.lit(0))).drop("__p")
    return d.withColumns({k: F.col(k).cast("long") for k in COUNTS})


def _vector() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x0": F.log1p(F.col("word_chars") / n),
        "x1": F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "x2": F.log1p(F.col("n_dup_lines").cast("double")),
        "x3": F.log1p(100 * F.col("n_repeat_words") / n),
    }


def _groups(vectors: DataFrame) -> DataFrame:
    """Per own group: ``g``, the estimate its rows are judged by, and ``feeds``, all estimates they go into."""
    own = F.to_json(F.struct("lang", "source"))
    wide = F.to_json(F.struct("lang"))
    sizes = vectors.groupBy(own.alias("own"), wide.alias("wide")).count()
    langs = sizes.groupBy("wide").agg(F.sum("count").alias("spoken"), F.min("count").alias("least"))
    rare = langs.agg((F.min("spoken") < LEAST_DOCUMENTS).alias("rare"))
    big, spread = F.col("count") >= LEAST_DOCUMENTS, F.col("spoken") >= LEAST_DOCUMENTS
    mine, ours = F.concat(F.lit("own"), "own"), F.concat(F.lit("wide"), "wide")
    chosen = F.when(big, mine).when(spread, ours).otherwise("all")
    needed = F.when(spread & (F.col("least") < LEAST_DOCUMENTS), ours)
    feeds = F.array_compact(F.array(F.when(big, mine), needed, F.when(F.col("rare"), F.lit("all"))))
    return sizes.join(langs, "wide").crossJoin(F.broadcast(rare)).select("own", chosen.alias("g"), feeds.alias("feeds"))


def _moments(rows: DataFrame) -> DataFrame:
    """Per group: means and the Cholesky factor of the covariance, ``l_ij``."""
    pairs = [(i, j) for i in range(4) for j in range(i + 1)]
    sums = rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(AXES)],
        *[F.covar_pop(AXES[i], AXES[j]).alias(f"c{i}{j}") for i, j in pairs],
    )
    out = sums
    for i, j in pairs:
        c = F.col(f"c{i}{j}") * CONSISTENCY + (LEAST_VARIANCE[i] if i == j else 0.0)
        rest = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c - rest, F.lit(1e-9))) if i == j else (c - rest) / F.col(f"l{j}{j}"))
    return out.select("g", *[f"m{i}" for i in range(4)], *[f"l{i}{j}" for i, j in pairs])


def _distance(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d``, by forward substitution."""
    out = join_small(rows, moments, "g", "left")
    for i in range(4):
        rest = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - rest) / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(4)), F.lit(0.0))
    return out.withColumn("d", total).drop(*[c for c in moments.columns if c != "g"], *[f"z{i}" for i in range(4)])


def _nearest_half(rows: DataFrame) -> DataFrame:
    """Rows of each group up to the bin of distances in which the group's half is reached."""
    from pyspark.sql import Window

    binned = rows.withColumn("bin", F.floor(F.log(F.col("d") + 1e-6) / BIN))
    counts = binned.groupBy("g", "bin").count()
    so_far = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("g")
    limits = (
        counts.withColumn("upto", F.sum("count").over(so_far)).withColumn("all", F.sum("count").over(whole))
        .filter(2 * F.col("upto") >= F.col("all"))
        .groupBy("g")
        .agg(F.min("bin").alias("limit"))
    )
    return join_small(binned, limits, "g").filter(F.col("bin") <= F.col("limit")).drop("bin", "limit", "d")


def robust_moments(vectors: DataFrame) -> DataFrame:
    """Per estimate ``g``: centre and factor of the half with the least determinant found."""
    rows = vectors.select(F.explode("feeds").alias("g"), *AXES)
    medians = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(AXES)])
    spread = sum(((F.col(x) - F.col(f"m{i}")) ** 2 / LEAST_VARIANCE[i] for i, x in enumerate(AXES)), F.lit(0.0))
    far = join_small(rows, medians, "g").withColumn("d", spread).select("g", *AXES, "d")
    moments = settle(_moments(_nearest_half(far)))
    for _ in range(STEPS):
        moments = settle(_moments(_nearest_half(_distance(rows, moments))))
    return moments


def judge(measured: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``; scans ``measured`` several times, so settle it first."""
    keyed = measured.withColumns(_vector()).withColumn("own", F.to_json(F.struct("lang", "source")))
    groups = settle(_groups(measured))
    vectors = join_small(keyed, groups, "own", "left")
    moments = robust_moments(vectors)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))
    near = F.col("d") <= CUTOFF
    judged = _distance(vectors, moments).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & near).drop("g", "feeds", "own", "d", *AXES)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that pass.

    Rows are numbered in one settled copy, which all later steps read: places in another scan of the
    same files depend on how many cores there are at that moment.
    """
    numbered = settle(docs.withColumn(ROW, F.monotonically_increasing_id()))
    measured = settle(measure(numbered.select(ROW, "lang", "source", "text")).drop("text"))
    rejected = settle(judge(measured).filter(~F.col("kept")).select(ROW))
    return numbered.join(rejected, ROW, "left_anti").select(docs.columns)

"""Quality rules: base rules plus robust multivariate outliers per language and source.

Every text gets a vector of transformed statistics. Per (language, source) the
minimum covariance determinant gives a centre and a scatter that outliers
can't pull: start from medians and median deviations, then repeat
concentration steps (keep the ``SUPPORT`` share of rows with the least
Mahalanobis distance, re-estimate mean and covariance of those), each of which
can only lower the determinant; then one reweighting step over the rows within
the ``REWEIGHT`` chi-square bound. A row is rejected if it fails a base rule or
its squared distance is over ``CUTOFF``.

All of it is DataFrame operations. One pass over the text writes the
statistics (a few numbers a row) to the shared folder; the estimation steps
read only those. Steps are aggregates with map-side partial sums over groups,
so a source with a third of all rows costs what its rows cost. The parameters,
one row a group, are joined back on (group, salt), so that no task gets a hot
group whole when the join isn't a broadcast.

Every group is estimated, whatever its size; an estimate from n rows is drawn
towards its language's with weight n / (n + ``SHRINK``) for its own, and the
language's likewise towards that of all rows, so that one row more moves it
a little and never switches it. ``FLOOR`` is added to the variance of each statistic: a
statistic that is constant in the clean rows must not make the least trace of
it an outlier. It is set by ``ALONE``, the distance from such a constant at
which a statistic is over ``CUTOFF`` by itself, which each can reach.

Defined results: a null text has no words and fails the base rule; null
languages or sources are groups of their own; repeated rows are judged each
on its own (and alike); an empty table gives an empty result. Extra columns
are ignored (``reject_outliers`` passes them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, drop_rows, row_hash, stored, table

WINDOW = 5                # words of a window that counts as repeated
MIN_WORDS = 10
MAX_REPEATED = 20         # percent of words in repeated windows
SUPPORT = 0.75            # share of rows of a concentration step
STEPS = 3
SHRINK = 20               # rows of its own that weigh as much as the level above
REWEIGHT = 13.28          # 0.99 quantile of chi-square with four degrees of freedom
CUTOFF = 33.38            # its 0.999999 quantile: clean rows stay
# Consistency factors of the scatter of the inner SUPPORT and 0.99 share (four degrees of freedom):
# share / P(chi-square with six degrees <= the quantile with four).
INNER_FACTOR = 0.75 / 0.5010
OUTER_FACTOR = 0.99 / 0.9611
FEATURES = ("x_length", "x_symbols", "x_lines", "x_repeats")
# Length by a factor of 1.42; over a clean 0: 10 symbols per 100 words, 20 percent of lines, 15 percent of words.
ALONE = (0.35, 2.398, 3.045, 2.773)
FLOOR = tuple(a * a / CUTOFF for a in ALONE)
SALTS = 16
GRAIN = 10_000            # accuracy of the quantile sketches


# --------------------------------------------------------------------- statistics
def _with(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more: sort (hash, place),
    keep places with an equal neighbour, add up the distance to the next kept
    place, the window's width at most."""
    def count(s: Column) -> Column:
        def twin(x, i):
            same = lambda j: F.coalesce(F.try_element_at(s, j)["h"] == x["h"], F.lit(False))
            return ((i > 0) & same(F.greatest(i, F.lit(1)))) | same(i + 2)
        places = F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))
        return _with(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.try_element_at(p, i + 2) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_with(ordered, count))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, lang, source and the base statistics of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))

    def windows(w: Column) -> Column:
        return F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - WINDOW + 1, F.lit(1))),
                        lambda i: F.xxhash64(F.slice(w, i, WINDOW))))

    from_words = _with(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _with(windows(w), _repeated_words).cast("long").alias("n_repeat_words")))
    from_lines = _with(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(["text"]).alias("row_hash"),
                      F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                      F.col("text").cast("string").alias("text"))
    return src.select(
        "doc_id", "row_hash", "lang", "source", from_words.alias("w"), from_lines.alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    ).select("doc_id", "row_hash", "lang", "source", "w.*", "l.*", "n_symbols")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def transformed(stats: DataFrame) -> DataFrame:
    """``stats`` with the transformed vector: log mean word length, and the log
    percentages of symbols per word, repeated lines and repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    percent = lambda a, b: F.log1p(a * 100.0 / b)
    return stats.select(
        "*", F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n).alias("x_length"),
        percent(F.col("n_symbols"), n).alias("x_symbols"),
        percent(F.col("n_dup_lines"), F.greatest(F.col("n_lines"), F.lit(1))).alias("x_lines"),
        percent(F.col("n_repeat_words"), n).alias("x_repeats"))


# ---------------------------------------------------------------------- estimation
def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _moments(factor: float) -> list[Column]:
    """Mean, and lower triangle of the floored covariance, of the rows aggregated."""
    out = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    for i, j in _pairs():
        c = F.coalesce(F.covar_pop(FEATURES[i], FEATURES[j]), F.lit(0.0)) * factor
        out.append((c + FLOOR[i] if i == j else c).alias(f"c{i}{j}"))
    return [*out, F.count(F.lit(1)).alias("n")]


def _factored(params: DataFrame) -> DataFrame:
    """Params with the Cholesky factor l_ij of the covariance in place of it."""
    out = params
    for i, j in _pairs():
        s = F.col(f"c{i}{j}")
        for k in range(j):
            s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(FLOOR[i] / 4))) if i == j else s / F.col(f"l{j}{j}"))
    return out.drop(*[f"c{i}{j}" for i, j in _pairs()])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the factor."""
    z: list[Column] = []
    for i, f in enumerate(FEATURES):
        s = F.col(f) - F.col(f"m{i}")
        for k in range(i):
            s = s - F.col(f"l{i}{k}") * z[k]
        z.append(s / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _measured(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with ``d2`` under their group's params (null without any)."""
    salted = params.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    names = [f"m{i}" for i in range(len(FEATURES))] + [f"l{i}{j}" for i, j in _pairs()]
    return rows.join(salted, ["grp", "salt"], "left").withColumn("d2", _distance()).drop(*names)


def _estimate(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant of every group ``grp`` of ``rows``."""
    med = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"),
                                  *[F.percentile_approx(f, 0.5, GRAIN).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    med = stored(med, "mcd-median")
    salted = med.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = (rows.join(salted, ["grp", "salt"]).groupBy("grp", *[f"m{i}" for i in range(len(FEATURES))])
              .agg(F.count(F.lit(1)).alias("n"),
                   *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, GRAIN).alias(f"s{i}") for i, f in enumerate(FEATURES)]))
    first = spread.select("grp", *[f"m{i}" for i in range(len(FEATURES))], "n",
                          *[(F.lit(0.0) if i != j else F.pow(F.col(f"s{i}") * 1.4826, 2) + FLOOR[i]).alias(f"c{i}{j}") for i, j in _pairs()])
    params = stored(_factored(first), "mcd-start")
    for step in range(STEPS + 1):
        near = _measured(rows, params).filter("d2 is not null")
        if step < STEPS:
            bound = near.groupBy("grp").agg(F.percentile_approx("d2", SUPPORT, GRAIN).alias("bound"))
            bound = bound.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            near, factor = near.join(bound, ["grp", "salt"]).filter("d2 <= bound"), INNER_FACTOR
        else:
            near, factor = near.filter(F.col("d2") <= REWEIGHT), OUTER_FACTOR
        params = stored(_factored(near.groupBy("grp").agg(*_moments(factor))), f"mcd-step{step}")
    return params


def _shrunk(params: DataFrame) -> DataFrame:
    """Params of groups drawn towards their language's, and those towards all rows'."""
    means, pairs = [f"m{i}" for i in range(len(FEATURES))], [f"c{i}{j}" for i, j in _pairs()]
    cov = [sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(1, j + 1)), F.col(f"l{i}0") * F.col(f"l{j}0")).alias(f"c{i}{j}") for i, j in _pairs()]
    own = params.select("grp", "n", *means, *cov)
    n = F.substring_index("grp", ":", 1)
    up = F.when(F.col("grp").rlike("^[0-9]"), F.substr("grp", F.length(n) + 2, n.cast("int"))).otherwise(F.lit(""))

    def drawn(rows: DataFrame, above: DataFrame) -> DataFrame:
        over = above.select(F.col("grp").alias("_up"), *[F.col(c).alias(f"_{c}") for c in means + pairs])
        w = F.col("n") / (F.col("n") + SHRINK)
        return rows.withColumn("_up", up).join(over, "_up").select("grp", "n", *[(w * F.col(c) + (1 - w) * F.col(f"_{c}")).alias(c) for c in means + pairs])

    all_ = own.filter("grp = ''")
    langs = stored(drawn(own.filter("grp <> '' AND NOT grp RLIKE '^[0-9]'"), all_), "mcd-langs")
    return _factored(all_.unionByName(langs).unionByName(drawn(own.filter("grp RLIKE '^[0-9]'"), langs)))


def judged(docs: DataFrame) -> DataFrame:
    """Every row's statistics with base_failed, d2 and kept."""
    rows = stored(transformed(statistics(docs)).withColumn("base_failed", base_failed()), "quality-statistics")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_hash"), F.lit(SALTS)).cast("int"))
    levels = [F.concat(F.length(name("lang")), F.lit(":"), name("lang"), name("source")), name("lang"), F.lit("")]
    fit = rows.filter(~F.col("base_failed")).select("lang", "source", "salt", *FEATURES)
    fit = fit.select("salt", *FEATURES, F.explode(F.array(*levels)).alias("grp"))
    params = stored(_shrunk(_estimate(fit)), "mcd")
    out = _measured(rows.withColumn("grp", levels[0]), params).drop("grp")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("d2") > CUTOFF, F.lit(False)))


def reject_outliers(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected rows."""
    bad = judged(docs).filter("not kept").select("doc_id", "row_hash", "lang", "source")
    return drop_rows(docs, bad, {"doc_id": F.col("doc_id").cast("long"), "row_hash": row_hash(["text"]),
                                 "lang": F.col("lang").cast("string"), "source": F.col("source").cast("string")})


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

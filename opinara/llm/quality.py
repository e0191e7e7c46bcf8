"""Quality rules: fixed limits, then robust outliers of each language and source.

Every document that passes the fixed limits gives a vector of transformed statistics: log of the mean
word length, and square roots of the shares of symbols, repeated lines and repeated words. For each
(language, source) the minimum covariance determinant gives a centre and a scatter that bad documents
move least, being up to nearly half of them: starting from two robust guesses (medians with absolute
deviations, and the covariance of values wrapped at twice these), the nearest (n + p + 1) / 2 of n rows
with p statistics are taken, their mean and covariance computed, distances taken anew, and so on until the
determinant falls no more; the smallest determinant holds. Mean and covariance are then taken once more
over all rows within the `INNER` distance. Documents beyond a limit of the Mahalanobis distance are rejected.

Everything is DataFrame expressions. Statistics are whole thousandths, so that sums are exact and results
do not depend on the order of rows; a rank within a cell is found from counts of rounded values, never by
sorting a cell. Each scatter gets a small floor on its diagonal, since many documents have no symbol or no
repeated line at all.

Defined results: a missing or empty text has no words and fails the fixed limits; missing languages and
sources are values of their own; cells with fewer than `MIN_ROWS` rows are pooled by language, and these
pools, where still too small, in one; where even that is too small the fixed limits decide; repeated
rows count as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.runtime import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent
MIN_ROWS = 50
STATISTICS = ("x1", "x2", "x3", "x4")
FLOOR = (50.0, 100.0, 150.0, 150.0)  # thousandths, standard deviations added to the scatter
CHI_MEDIAN = 3.3567  # of squared distance in four dimensions
INNER = 11.14  # of squared distance: what chi-square with four degrees passes 25 times in a thousand
LIMIT = 18.47  # of squared distance: what chi-square with four degrees passes once in a thousand
SETTLED = 1e-6  # a logarithm of the determinant that falls by less falls no more
SCALE = 200  # bins of a distance's logarithm
P = range(len(STATISTICS))


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = F.coalesce("text", F.lit(""))
    full = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        "doc_id",
        "lang",
        "source",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        full.alias("lines"),
    )
    following = lambda i, n: F.get(F.col("words"), i + n)
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, following(i, 1), following(i, 2)))
    base = base.select(
        "doc_id",
        "lang",
        "source",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(hashes, 1, F.greatest(F.size("words") - 2, F.lit(0))).alias("windows"),
    )
    # places of windows by hash: equal neighbours are windows found twice or more
    numbered = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    base = base.withColumn("sorted", F.when(repeats, F.sort_array(numbered))).drop("windows")

    def again(x: Column, k: Column) -> Column:
        before, after = F.get("sorted", k - 1)["h"], F.get("sorted", k + 1)["h"]
        return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

    places = F.sort_array(F.transform(F.filter("sorted", again), lambda x: x["i"]))
    base = base.withColumn("places", places).drop("sorted")
    covered = F.transform(
        "places", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - i, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x)
    return base.withColumn("n_repeat_words", F.coalesce(total, F.lit(0))).drop("places")


def vectors(docs: DataFrame) -> DataFrame:
    """The base statistics, base_failed and, of rows that pass, the vector in thousandths."""
    share = lambda a, b: F.sqrt(F.col(a) / F.col(b))
    values = (
        F.log(F.col("word_chars") / F.col("n_words")),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = base_statistics(docs).withColumn("base_failed", failed)
    return rows.withColumns(
        {n: F.when(~F.col("base_failed"), F.round(v * 1000).cast("long")) for n, v in zip(STATISTICS, values, strict=True)}
    ).withColumn("group", F.to_json(F.struct("lang", "source")))


def cells(rows: DataFrame) -> DataFrame:
    """(group, cell): where the documents of a language and source are judged; null for nowhere."""
    counts = rows.where(~F.col("base_failed")).groupBy("group", "lang").agg(F.count("*").alias("n"))
    small = counts.where(F.col("n") < MIN_ROWS)
    pools = small.groupBy("lang").agg(F.sum("n").alias("pooled"))
    pools = pools.select(F.col("lang").alias("pool"), "pooled")
    rest = pools.where(F.col("pooled") < MIN_ROWS).agg(F.sum("pooled").alias("n")).first()["n"] or 0
    return (
        counts.join(pools, F.col("lang").eqNullSafe(F.col("pool")), "left")
        .select(
            "group",
            F.when(F.col("n") >= MIN_ROWS, F.concat(F.lit("source "), "group"))
            .when(F.col("pooled") >= MIN_ROWS, F.concat(F.lit("language "), F.to_json(F.struct("lang"))))
            .when(F.lit(rest) >= MIN_ROWS, F.lit("rest"))
            .alias("cell"),
        )
    )


def rounded(value: Column) -> Column:
    """A positive number as the whole number of its bin, some 0.5 % wide."""
    return F.floor(F.log1p(value) * SCALE)


def scatter(rows: DataFrame, values: list[Column]) -> DataFrame:
    """Per (cell, start): m1.. and c11.. of whole-number values, the floor added."""
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    products = [F.sum(values[i] * values[j]).alias(f"s{i}{j}") for i in P for j in P if j <= i]
    found = rows.groupBy("cell", "start").agg(F.count("*").alias("n"), *sums, *products)
    mean = [F.col(f"s{i}") / F.col("n") for i in P]
    cov = {
        f"c{i}{j}": F.col(f"s{i}{j}") / F.col("n") - mean[i] * mean[j] + (FLOOR[i] ** 2 if i == j else 0)
        for i in P
        for j in P
        if j <= i
    }
    return found.select(
        "cell", "start", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[c.alias(n) for n, c in cov.items()]
    )


def whitened(found: DataFrame) -> DataFrame:
    """From m and c: m, the inverse w of the Cholesky factor, and the log determinant."""
    c = F.col
    for j in P:
        own = sum((c(f"l{j}{k}") * c(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        found = found.withColumn(f"l{j}{j}", F.sqrt(c(f"c{j}{j}") - own))
        below = {
            f"l{i}{j}": (c(f"c{i}{j}") - sum((c(f"l{i}{k}") * c(f"l{j}{k}") for k in range(j)), F.lit(0.0)))
            / c(f"l{j}{j}")
            for i in P
            if i > j
        }
        found = found.withColumns(below) if below else found
    for i in P:
        found = found.withColumn(f"w{i}{i}", 1 / c(f"l{i}{i}"))
        left = {
            f"w{i}{j}": -c(f"w{i}{i}") * sum((c(f"l{i}{k}") * c(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            for j in range(i)
        }
        found = found.withColumns(left) if left else found
    determinant = sum((2 * F.log(c(f"l{i}{i}")) for i in P), F.lit(0.0)).alias("log_det")
    entries = [f"m{i}" for i in P] + [f"w{i}{j}" for i in P for j in P if j <= i]
    return found.select("cell", "start", determinant, *entries)


def distance() -> Column:
    """Squared distance of y0.. from m0.. under w."""
    off = [F.col(f"y{i}") - F.col(f"m{i}") for i in P]
    sides = [sum((F.col(f"w{i}{j}") * off[j] for j in range(i + 1)), F.lit(0.0)) for i in P]
    return sum((s * s for s in sides), F.lit(0.0))


def nearest(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: the scatter of the nearest half of each cell's rows under each start."""
    seen = rows.join(estimate, "cell").withColumn("bin", rounded(distance()))
    # ranks over the bins, of which a cell has some thousands
    start = Window.partitionBy("cell", "start")
    bins = seen.groupBy("cell", "start", "bin").agg(F.count("*").alias("n"))
    ranked = bins.select("cell", "start", "bin", F.sum("n").over(start).alias("all"), F.sum("n").over(start.orderBy("bin")).alias("upto"))
    half = F.least(F.floor((F.col("all") + len(P) + 1) / 2), F.col("all"))
    reach = cut_lineage(ranked.where(F.col("upto") >= half).groupBy("cell", "start").agg(F.min("bin").alias("reach")))
    inner = seen.join(reach, ["cell", "start"]).where(F.col("bin") <= F.col("reach"))
    return cut_lineage(whitened(scatter(inner, [F.col(f"y{i}") for i in P])))


def smallest(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Per cell the estimate with the smallest determinant that steps from the given ones come to."""
    found = estimate = nearest(rows, estimate)
    while not estimate.isEmpty():
        before = estimate.select("cell", "start", F.col("log_det").alias("before"))
        after = nearest(rows, estimate).join(before, ["cell", "start"]).where(F.col("log_det") < F.col("before") - SETTLED)
        estimate = cut_lineage(after.drop("before"))
        found = found.unionByName(estimate)
    entries = [c for c in found.columns if c not in ("cell", "log_det")]
    best = found.groupBy("cell").agg(F.min(F.struct("log_det", *entries)).alias("b")).select("cell", "b.*")
    return cut_lineage(best)


def with_factor(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate with the factor that makes the rows' median distance that of a normal sample."""
    middle = (
        rows.join(estimate, "cell")
        .groupBy("cell")
        .agg(F.percentile(rounded(distance()), F.lit(0.5)).alias("middle"))
    )
    factor = CHI_MEDIAN / F.greatest(F.expm1((F.col("middle") + 0.5) / SCALE), F.lit(1e-3))
    joined = estimate.join(middle, "cell").withColumn("factor", F.least(factor, F.lit(1.0)))
    return cut_lineage(joined.drop("log_det", "start", "middle"))


def estimates(rows: DataFrame) -> DataFrame:
    """Per cell: med0.. (whole numbers taken off the statistics), m, w and the factor of squared distances."""
    medians = cut_lineage(
        rows.groupBy("cell").agg(
            *[F.round(F.percentile(x, F.lit(0.5))).cast("long").alias(f"med{i}") for i, x in enumerate(STATISTICS)]
        )
    )
    centred = rows.join(medians, "cell").select(
        "cell", *[(F.col(x) - F.col(f"med{i}")).alias(f"y{i}") for i, x in enumerate(STATISTICS)]
    )
    spread = [
        F.greatest(1.4826 * F.percentile(F.abs(f"y{i}"), F.lit(0.5)), F.lit(FLOOR[i])).alias(f"d{i}") for i in P
    ]
    spreads = cut_lineage(centred.groupBy("cell").agg(*spread))
    zero = F.lit(0.0)
    plain = spreads.select(
        "cell",
        F.lit(0).alias("start"),
        *[zero.alias(f"m{i}") for i in P],
        *[(F.col(f"d{i}") * F.col(f"d{i}") if i == j else zero).alias(f"c{i}{j}") for i in P for j in P if j <= i],
    )
    wrapped = [
        F.greatest(F.least(F.col(f"y{i}"), F.ceil(2 * F.col(f"d{i}"))), -F.ceil(2 * F.col(f"d{i}"))) for i in P
    ]
    other = scatter(centred.join(spreads, "cell").withColumn("start", F.lit(1)), wrapped)
    raw = with_factor(centred, smallest(centred, cut_lineage(whitened(plain.unionByName(other)))))
    ys = [F.col(f"y{i}") for i in P]
    inner = centred.join(raw, "cell").where(distance() * F.col("factor") <= INNER)
    inner = cut_lineage(inner.select("cell", F.lit(0).alias("start"), *ys))
    final = cut_lineage(whitened(scatter(inner, ys)))
    return cut_lineage(with_factor(inner.drop("start"), final).join(medians, "cell"))


def judge(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """doc_id, the base statistics, base_failed, cell, distance (squared, null where not judged), kept."""
    rows = cut_lineage(vectors(docs))
    places = cut_lineage(cells(rows))
    placed = rows.join(places, "group", "left")
    passing = placed.where(~F.col("base_failed") & F.col("cell").isNotNull()).select("cell", *STATISTICS)
    found = estimates(cut_lineage(passing))
    judged = placed.join(found, "cell", "left").withColumns(
        {f"y{i}": F.col(x) - F.col(f"med{i}") for i, x in enumerate(STATISTICS)}
    )
    squared = F.when(~F.col("base_failed"), distance() * F.col("factor"))
    return judged.withColumn("distance", squared).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "cell",
        "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"),
    )

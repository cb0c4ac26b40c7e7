"""Quality rules by robust multivariate outliers (DataFrame only).

Text statistics are counted on whole texts with array functions, then transformed to
a vector per document.  Per language and source, a minimum-covariance-determinant
estimate is iterated: from medians and quartiles, each step keeps the fraction of
documents nearest in Mahalanobis distance and takes their mean and covariance.  The
steps read a stored table of vectors; per group they exchange a few sums only.  A
document is rejected if its distance to its group's estimate passes a limit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import if_few, stored

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Limits:
    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    keep: float = 0.75          # share of a group that an estimate is made of
    steps: int = 3
    distance: float = 30.0      # squared; about 1 - 5e-6 of a chi-square with 4 degrees
    calm_words: int = 100       # texts of fewer words vary more: their deviation counts less
    least_rows: int = 30        # smaller groups are estimated by their language
    # least standard deviation of each statistic, so that a constant one doesn't
    # make every difference infinite
    floors: tuple[float, ...] = (0.25, 0.6, 0.12, 0.12)


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def statistics(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words of every whole text (null: no words)."""
    w = limits.window
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), text.alias("text"))
    # whitespace at either end would make empty words
    words = F.filter(F.split("text", _BLANK_RUN), lambda x: x != "")
    lines = F.filter(F.split("text", "\n"), lambda x: _without(x, _BLANKS) != "")
    counted = base.select(
        "doc_id", "lang", "source", words.alias("words"), lines.alias("lines"),
        F.length(_without(F.col("text"), _BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"))
    n = F.size("words")
    # a hash per window; windows that come twice are found by sorting (hash, place)
    starts = F.when(n >= w, F.sequence(F.lit(0), n - w)).otherwise(F.array().cast("array<int>"))
    hashed = counted.withColumns({
        "n_words": n.cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(w)]))}) \
        .drop("words", "lines")
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = hashed.withColumn("placed", F.when(some, F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("hashes")
    twice = F.filter("placed", lambda x, j: (F.get("placed", j - 1)["h"] == x["h"]) | (F.get("placed", j + 1)["h"] == x["h"]))
    repeats = placed.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("placed")
    # each repeated window covers its words up to the next repeated one
    covered = F.aggregate(F.transform("at", lambda p, j: F.least(F.lit(w), F.coalesce(F.get("at", j + 1) - p, F.lit(w)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return repeats.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                          F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.least_words) \
        | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))


def vector(limits: Limits) -> list[Column]:
    """Word length, symbols a hundred words (log), share of repeated lines, share of
    repeated words.  The first three are drawn to their usual value in short texts."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    calm = F.sqrt(F.least(n / limits.calm_words, F.lit(1.0)))
    return [(F.col("word_chars") / n - F.col("usual")) * calm,
            F.log1p(100.0 * F.col("n_symbols") / F.greatest(n, F.lit(float(limits.calm_words)))),
            F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(5)).cast("double"),
            F.col("n_repeat_words") / n * calm]


def _cholesky(p: int, entry) -> list[tuple[str, Column]]:
    """Column steps (name, expression) of the lower factor of a symmetric matrix whose
    entries ``entry(i, j)`` are columns; each step reads the earlier names."""
    steps = []
    for i in range(p):
        for j in range(i + 1):
            rest = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            steps.append((f"l{i}{j}", F.sqrt(F.greatest(entry(i, i) - rest, F.lit(1e-12))) if i == j
                          else (entry(i, j) - rest) / F.col(f"l{j}{j}")))
    return steps


def _factored(stats: DataFrame, p: int) -> DataFrame:
    """(g, m0.., l00..) from (g, m0.., c00..)."""
    for name, e in _cholesky(p, lambda i, j: F.col(f"c{i}{j}")):
        stats = stats.withColumn(name, e)
    return stats.select("g", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i in range(p) for j in range(i + 1)])


def _distances(vectors: DataFrame, factors: DataFrame, p: int) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance to the group's estimate.  ``factors`` is
    a stored table of a row per group; while it is small, no vector is shuffled for it,
    so a large group stays spread over the tasks that read it."""
    out, names = vectors.join(if_few(factors, len(factors.columns) * factors.count()), "g"), vectors.columns
    for i in range(p):  # forward substitution
        rest = sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - rest) / F.col(f"l{i}{i}"))
    return out.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)), F.lit(0.0))).select(*names, "d2")


def mcd(vectors: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(g, m0.., l00..): per group the centre and the lower factor of the scatter of
    ``vectors`` (g long, x0..), a stored table."""
    p = len(limits.floors)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    q = vectors.groupBy("g").agg(*[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(p)])
    now = q.select("g", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(p)], *[
        (((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 + limits.floors[i] ** 2 if i == j else F.lit(0.0))
        .alias(f"c{i}{j}") for i, j in pairs])
    now = stored(_factored(now, p), "mcd")
    for _ in range(limits.steps):
        near = stored(_distances(vectors, now, p).groupBy("g")
                      .agg(F.percentile_approx("d2", limits.keep, 1000).alias("limit")), "mcd-limit")
        best = _distances(vectors, now, p).join(if_few(near), "g").where("d2 <= limit")
        sums = best.groupBy("g").agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(p)],
                                     *[F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}") for i, j in pairs])
        now = stored(_factored(sums.select("g", *[f"m{i}" for i in range(p)], *[
            (F.col(f"v{i}{j}") + (limits.floors[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in pairs]), p), "mcd")
    return now


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, distance (squared; null where the base rules decide) for every row.

    Null and empty texts have no words and fail the base rules.  A null language or
    source is a group of its own.  Groups of fewer than ``least_rows`` documents are
    judged by their language's estimate.  Repeated rows and null ids count like any
    other; an empty table gives an empty one."""
    p = len(limits.floors)
    stats = stored(statistics(docs, limits, id_col, text_col, lang_col, source_col)
                   .withColumn("base_failed", base_failed(limits)), "rule-statistics")
    key = lambda *c: F.xxhash64(*[F.coalesce(x, F.lit("\x00")) for x in c])
    sound = stats.where(~F.col("base_failed"))
    large = sound.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")) \
        .select(key(F.col("lang"), F.col("source")).alias("pair"), (F.col("n") >= limits.least_rows).alias("large"))
    usual = sound.groupBy("lang").agg(F.percentile_approx(F.col("word_chars") / F.col("n_words"), 0.5, 1000).alias("usual")) \
        .select(key(F.col("lang")).alias("only"), "usual")
    marked = (sound.withColumns({"pair": key(F.col("lang"), F.col("source")), "only": key(F.col("lang"))})
              .join(if_few(stored(large, "rule-groups")), "pair").join(if_few(stored(usual, "rule-usual")), "only"))
    vectors = stored(marked.select("doc_id", *stats.columns[3:-1], "pair", "only", "large",
                                   *[v.alias(f"x{i}") for i, v in enumerate(vector(limits))]), "rule-vectors")
    x = [f"x{i}" for i in range(p)]
    # small groups need their language's estimate, made of all its documents
    by_pair = vectors.where("large").select(F.col("pair").alias("g"), *x)
    small = stored(vectors.where("not large").select("only").distinct(), "rule-small")
    by_lang = vectors.join(if_few(small), "only", "left_semi").select(F.col("only").alias("g"), *x)
    factors = mcd(stored(by_pair.union(by_lang), "rule-estimated"), limits)
    judged = _distances(vectors.withColumn("g", F.when(F.col("large"), F.col("pair")).otherwise(F.col("only"))), factors, p)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (judged.select(*columns, F.lit(False).alias("base_failed"), (F.col("d2") <= limits.distance).alias("kept"),
                          F.col("d2").alias("distance"))
            .union(stats.where("base_failed").select(*columns, "base_failed", F.lit(False), F.lit(None).cast("double"))))

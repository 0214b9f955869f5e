"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only.

Each source gets a target in words.  A source smaller than its target is first taken whole as often as it fits
(complete epochs); the rest of the target is a weighted sample of its documents: every document draws the key
``-ln(u) / quality`` and the smallest keys whose words add up to the rest are taken once more.

Only thin rows (key, source, size) are shuffled.  The keys of a source are cut into ``buckets`` ranges, their words are
summed with partial aggregates, and only the one bucket in which the budget ends is sorted.  A source with a third of
all rows is therefore never gathered in one task.  What is windowed whole has one row per source, or per source and bucket.

Defined cases: a null text has size 0; a null source is a source of its own, ranked last; a document without a quality
weight, or with one that is not positive, weighs ``default_quality``; the document in which a budget ends is taken if
that comes nearer to the budget; rows that agree in id, text and source draw one key, and where a budget ends among them
as many are taken as come nearest to it, which of them being all one, so that reruns agree; empty tables give empty
results.  Columns of the input other than those named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, count_words, row_key, whole_row, written

#: Number of key ranges per source.
BUCKETS = 1024
#: Sampling weights for labels.quality 1 and 0; other documents get the default.
GOOD, POOR, DEFAULT_QUALITY = 1.0, 0.25, 0.5
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def with_draws(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Thin rows: id, source, size in words, ``row_key`` and its uniform draw ``u`` in (0, 1]."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source).alias("source"),
        count_words(text).alias("size"),
        row_key(id_col, text).alias("row_key"),
    ).withColumn("u", (F.conv(F.substring("row_key", 1, 13), 16, 10).cast("long") + 1) / F.lit(float(1 << 52)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with ``target``: shares by weight, none above ``max_epochs`` times its source.

    Resharing the excess until nothing is above its cap fills all open sources to one level, ``words per weight``; with
    the sources ordered by the level at which they are full, that level follows from running sums.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.select(
        "source",
        "source_size",
        "rank",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
        .cast("long")
        .alias("weight"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("budget"),
    ).withColumn("full_at", F.col("source_size") * max_epochs / F.col("weight"))
    ahead = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.orderBy("full_at", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("source_size").over(ahead), F.lit(0)) * max_epochs)
        / F.sum("weight").over(behind),
    )
    level = F.min_by(
        F.when(F.col("full_at") >= F.col("level"), F.col("level")),
        F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "rank")),
    ).over(everything)
    return levels.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("full_at") < F.col("level"), (F.col("source_size") * max_epochs).cast("double"))
        .otherwise(F.col("weight") * F.col("level"))
        .alias("target"),
    )


def nth_copy(rows: DataFrame) -> DataFrame:
    """(of, copy, n) -> (of, nth): the n-th smallest ``copy`` of each group ``of``, for n from 1 on.

    ``copy`` comes from a written ``monotonically_increasing_id``: its upper bits name the task that gave it, so the rows
    of a group are counted by task first, and only those of the one task in which the n-th falls are numbered.
    """
    rows = rows.withColumn("task", F.shiftright("copy", 33))
    before = Window.partitionBy("of").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        rows.groupBy("of", "task", "n")
        .agg(F.count("*").alias("held"))
        .withColumn("place", F.col("n") - F.coalesce(F.sum("held").over(before), F.lit(0)))
        .where("place between 1 and held")
        .select(F.col("of").alias("place_of"), F.col("task").alias("place_task"), "place")
    )
    return (
        rows.join(places, F.col("of").eqNullSafe(F.col("place_of")) & (F.col("task") == F.col("place_task")))
        .withColumn("number", F.row_number().over(Window.partitionBy("of").orderBy("copy")))
        .where("number = place")
        .select("of", F.col("copy").alias("nth"))
    )


def mix(
    draws: DataFrame,
    weights=WEIGHTS,
    share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    default_quality: float = DEFAULT_QUALITY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of ``with_draws``, with ``quality``, -> the same with ``source_size``, ``target``, ``copies`` and ``taken`` (words)."""
    quality = F.when(F.col("quality") > 0, F.col("quality")).otherwise(F.lit(default_quality))
    keyed = draws.withColumn("key", -F.ln("u") / quality).withColumn(
        "bucket", F.least(F.lit(buckets - 1), F.floor(-F.expm1(-F.col("key")) * buckets)).cast("int")
    )
    keyed = written(keyed.drop("u", "quality").withColumn("copy", F.monotonically_increasing_id()), "mix-draws")

    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs
    )
    targets = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    # The bucket in which each source's rest ends.
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .withColumnRenamed("source", "s")
        .join(targets, F.col("s").eqNullSafe(F.col("source")))
        .where((F.col("rest") > F.col("start")) & (F.col("rest") <= F.col("start") + F.col("words")))
        .select(F.col("s").alias("end_source"), F.col("bucket").alias("end_bucket"), "start", "rest")
    )
    # Inside it, the repeated rows among which it ends (one row, as a rule), and how many of them come nearest to it.
    ahead = Window.partitionBy("source").orderBy("key", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("source").eqNullSafe(F.col("end_source")) & (F.col("bucket") == F.col("end_bucket"))
    last = written(
        keyed.join(ends, here)
        .groupBy("source", "bucket", "key", "row_key", "start", "rest")
        .agg(F.max("size").alias("size"), F.count("*").alias("rows_alike"))
        .withColumn("words_ahead", F.coalesce(F.sum(F.col("size") * F.col("rows_alike")).over(ahead), F.lit(0)))
        .withColumn("missing", F.col("rest") - F.col("start") - F.col("words_ahead"))
        .where("missing > 0")
        .withColumn("n", F.floor(F.col("missing") / F.col("size") + 0.5))
        .groupBy(F.col("source").alias("cut_source"))
        .agg(F.max(F.struct("key", "row_key", "bucket", "rows_alike", "n")).alias("at")),
        "mix-last",
    )
    split = (F.col("at.n") > 0) & (F.col("at.n") < F.col("at.rows_alike"))
    whole = F.when(F.col("at.n") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-1)).cast("long")
    cuts = last.withColumn("copy", whole)
    if not last.where(split).isEmpty():
        alike = (
            F.col("source").eqNullSafe(F.col("cut_source"))
            & (F.col("bucket") == F.col("at.bucket"))
            & (F.col("row_key") == F.col("at.row_key"))
        )
        nth = nth_copy(keyed.join(last.where(split), alike).select(F.col("source").alias("of"), "copy", F.col("at.n").alias("n")))
        cuts = cuts.join(nth, F.col("cut_source").eqNullSafe(F.col("of")), "left")
        cuts = cuts.withColumn("copy", F.when(split, F.col("nth")).otherwise(F.col("copy")))
    cuts = cuts.select("cut_source", F.struct("at.key", "at.row_key", "copy").alias("cut"))
    plan = (
        targets.join(
            ends.select("end_source", "end_bucket"), F.col("source").eqNullSafe(F.col("end_source")), "left"
        )
        .drop("end_source")
        .join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .withColumnRenamed("source", "plan_source")
    )
    # One row per source and bucket, so that the documents of a hot source are joined in many tasks.
    plan = written(
        sums.select("source", F.col("bucket").alias("plan_bucket"))
        .join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .drop("source"),
        "mix-plan",
    )
    sampled = (F.col("bucket") < F.col("end_bucket")) | (
        (F.col("bucket") == F.col("end_bucket")) & (F.struct("key", "row_key", "copy") <= F.col("cut"))
    )
    copies = (F.col("epochs") + F.coalesce(sampled.cast("long"), F.lit(0))).cast("long")
    return (
        keyed.join(
            plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("bucket") == F.col("plan_bucket"))
        )
        .withColumn("copies", copies)
        .select(
            "doc_id",
            "source",
            "row_key",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def take_copies(
    docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` takes them from their source, with the columns of ``docs``."""

    def key(row: Column, origin: str) -> Column:
        return F.concat(row, F.coalesce(F.concat(F.lit("="), F.col(origin)), F.lit(""))).alias("mix_key")

    copies = written(
        mixed.groupBy(key(F.col("row_key"), "source")).agg(
            F.min("copies").alias("least"), F.sum(F.col("copies")).alias("total"), F.count("*").alias("rows_alike")
        ),
        "mix-copies",
    ).withColumn("n", F.col("total") - F.col("least") * F.col("rows_alike"))
    rows = docs.select(whole_row(docs).alias("mix_row"), key(row_key(id_col, text), source))
    taken = rows.join(copies.where("total > 0 and n = 0"), "mix_key").select("mix_row", F.col("least").alias("times"))
    split = copies.where("n > 0")
    if not split.isEmpty():
        # Repeated rows of which some are taken once more, of one document per source at most.
        some = written(
            rows.join(split.select("mix_key", "least", "n"), "mix_key").withColumn("copy", F.monotonically_increasing_id()),
            "mix-some",
        )
        nth = nth_copy(some.select(F.col("mix_key").alias("of"), "copy", "n"))
        once_more = (F.col("copy") <= F.col("nth")).cast("long")
        taken = taken.unionByName(
            some.join(nth, F.col("mix_key") == F.col("of")).select("mix_row", (F.col("least") + once_more).alias("times"))
        ).where("times > 0")
    return taken.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("mix_row.*")


def with_quality(draws: DataFrame, labels: DataFrame) -> DataFrame:
    """Thin rows with ``quality`` from ``labels.quality``; the best label counts where a document has several."""
    best = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("label"))
    quality = F.when(F.col("label") == 1, F.lit(GOOD)).when(F.col("label") == 0, F.lit(POOR))
    return (
        draws.join(best, F.col("doc_id") == F.col("label_id"), "left")
        .withColumn("quality", quality.otherwise(F.lit(None)))
        .drop("label_id", "label")
    )


#: The same result on DuckDB.
SQL = rf"""
WITH sized AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '{WORD}'))::BIGINT AS size,
         CASE l.q WHEN 1 THEN {GOOD} WHEN 0 THEN {POOR} ELSE {DEFAULT_QUALITY} END::DOUBLE AS quality,
         md5(coalesce(d.doc_id::VARCHAR, '') || '|' || md5(coalesce(d.text, ''))) AS row_key
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id),
keyed AS (
  SELECT *, -ln((('0x' || substr(row_key, 1, 13))::BIGINT + 1) / {float(1 << 52)}::DOUBLE) / quality AS k FROM sized),
ranked AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM sized GROUP BY 1),
weighed AS (
  SELECT *, [5, 2, 1][r % 3 + 1]::BIGINT AS w, (sum(s) OVER ())::DOUBLE AS budget,
         s::DOUBLE * 3 / [5, 2, 1][r % 3 + 1] AS f
  FROM ranked),
levels AS (
  SELECT *, (budget - coalesce(sum(s) OVER (ORDER BY f, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 3)
            / (sum(w) OVER (ORDER BY f, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
one AS (SELECT level AS lv FROM levels WHERE f >= level ORDER BY f, r LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN f < lv THEN (s * 3)::DOUBLE ELSE w * lv END AS target FROM levels, one),
rests AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS epochs,
         target - CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END * s AS rest
  FROM targets),
sums AS (
  SELECT d.*, t.s, t.target, t.epochs, t.rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, row_key) AS upto,
         sum(size) OVER (PARTITION BY d.source, k, row_key) AS own,
         row_number() OVER (PARTITION BY d.source, k, row_key) AS nr
  FROM keyed d JOIN rests t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, (epochs + CASE WHEN upto <= rest AND rest > 0 THEN 1
                           WHEN upto - own < rest AND nr <= floor((rest - (upto - own)) / size + 0.5) THEN 1
                           ELSE 0 END)::BIGINT AS copies
  FROM sums)
SELECT doc_id, source, row_key, size, s AS source_size, target, copies, size * copies AS taken
FROM counted
"""

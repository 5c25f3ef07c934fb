"""Per-exam statistics, computed as a whole or kept up to date."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.keys import hash_bucket, hash_key
from quirework.functions.text import word_count
from quirework.operators.aggregates import category_maps
from quirework.operators.projections import conform
from quirework.schemas import EXAM_STATS
from quirework.session import written
from quirework.sources.tables import read_table, refresh_partition, write_table


def exam_stats(
    questions: DataFrame,
    answers: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """One row per exam: counts, mean word counts, distributions.

    Answers are summed up per question first, so joining them does not repeat
    question rows. Measures and category counts are combined map-side: an exam holding a
    third of all questions sends one row (and one for each category) per task.
    """
    per_question = answers.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("_answers"),
        F.sum(word_count(F.col("raw_answer_text"))).alias("_answer_words"),
    )
    measured = questions.select(
        "question_id",
        "exam_id",
        "difficulty_level",
        "question_type",
        word_count(F.col("raw_question_text")).alias("_words"),
    ).join(per_question, "question_id", "left")
    stats = measured.groupBy("exam_id").agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.coalesce(F.sum("_answers"), F.lit(0)).alias("total_answers"),
        F.avg("_words").alias("avg_word_count_question"),
        F.try_divide(F.sum("_answer_words"), F.sum("_answers")).alias("avg_word_count_answer"),
    )
    for category, name in (
        ("difficulty_level", "distribution_by_difficulty"),
        ("question_type", "distribution_by_type"),
    ):
        maps = category_maps(questions.filter(F.col("exam_id").isNotNull()), ["exam_id"], category, name)
        stats = stats.join(maps, "exam_id", "left").withColumn(
            name, F.coalesce(name, F.create_map().cast("map<string,int>"))
        )
    updated = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    keyed = stats.withColumns({"stats_id": hash_key("exam_id"), "last_updated": updated})
    return conform(keyed, EXAM_STATS)


# ---- Kept up to date ---------------------------------------------------------
# What statistics are made of, as rows that can be added up: the questions and answers of an
# exam with their words, and the questions of each category.
CATEGORIES = {"difficulty_level": "distribution_by_difficulty", "question_type": "distribution_by_type"}


def answer_totals(answers: DataFrame) -> DataFrame:
    """One narrow row per question: its answers, those with a text, and their words.

    `start_stats` and `refresh_stats` take this in place of the answers, so that several
    batches count the words of one table of answers once.
    """
    words = word_count(F.col("raw_answer_text"))
    return answers.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("_answers"),
        F.count("raw_answer_text").alias("_worded"),
        F.sum(words).alias("_words"),
    )


def stats_parts(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(exam_id, measure, category, n, worded, words) of some questions with their answers.

    Parts of tables that share no question add up to those of the whole. Each task adds up
    its own rows first, so an exam with a third of all questions sends a few rows a task.
    Only what is added up by exam and categories is unfolded into measures.
    """
    totals = answers if "_answers" in answers.columns else answer_totals(answers)
    joined = questions.select(
        "question_id", "exam_id", *CATEGORIES, word_count(F.col("raw_question_text")).alias("_own")
    ).join(totals, "question_id", "left")
    sums = joined.groupBy("exam_id", *CATEGORIES).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("_own").alias("_own_worded"),
        *[F.sum(name).alias(name) for name in ("_own", "_answers", "_worded", "_words")],
    )

    def part(measure: str, category: Column, n: str, worded: Column, words: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        numbers = {"n": F.col(n), "worded": worded, "words": words}
        return F.struct(
            F.lit(measure).alias("measure"),
            category.cast("string").alias("category"),
            *[F.coalesce(c.cast("bigint"), zero).alias(name) for name, c in numbers.items()],
        )

    none = F.lit(None)
    parts = [
        part("question", none, "_n", F.col("_own_worded"), F.col("_own")),
        part("answer", none, "_answers", F.col("_worded"), F.col("_words")),
        *[part(c, F.col(c), "_n", none, none) for c in CATEGORIES],
    ]
    rows = sums.select("exam_id", F.explode(F.array(*parts)).alias("_p")).select("exam_id", "_p.*")
    return rows.groupBy("exam_id", "measure", "category").agg(
        *[F.sum(name).alias(name) for name in ("n", "worded", "words")]
    )


def stats_of(parts: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows that `exam_stats` gives, from their parts, of one batch or of several.

    An exam has few parts, however many questions it has: one shuffle by exam serves both sums.
    """

    def total(measure: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col(name))), F.lit(0))

    def counts(category: str) -> Column:
        wanted = (F.col("measure") == category) & F.col("category").isNotNull() & F.col("exam_id").isNotNull()
        return F.map_from_entries(F.collect_list(F.when(wanted, F.struct("category", F.col("n").cast("int")))))

    def mean(measure: str) -> Column:
        return F.try_divide(total(measure, "words"), F.nullif(total(measure, "worded"), F.lit(0)))

    updated = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    numbers = [F.sum(name).alias(name) for name in ("n", "worded", "words")]
    dealt = parts.repartition("exam_id")
    stats = dealt.groupBy("exam_id", "measure", "category").agg(*numbers).groupBy("exam_id").agg(
        total("question", "n").alias("total_questions"),
        total("answer", "n").alias("total_answers"),
        mean("question").alias("avg_word_count_question"),
        F.try_divide(total("answer", "words"), F.nullif(total("answer", "n"), F.lit(0))).alias("avg_word_count_answer"),
        *[counts(category).alias(name) for category, name in CATEGORIES.items()],
    )
    keyed = stats.withColumns({"stats_id": hash_key("exam_id"), "last_updated": updated})
    return conform(keyed, EXAM_STATS)


def start_stats(
    folder: str, questions: DataFrame, answers: DataFrame, batch: str, as_of: str | None = None, buckets: int = 64
) -> int:
    """Write the statistics of all exams, and their parts, by bucket of exam under `folder`; rows of statistics."""
    parts = _bucketed(stats_parts(questions, answers).withColumn("batch", F.lit(batch)), buckets)
    write_table(parts, f"{folder}/parts", ["bucket"])
    stats = stats_of(read_table(questions.sparkSession, f"{folder}/parts"), as_of)
    return write_table(_bucketed(stats, buckets), f"{folder}/stats", ["bucket"])


def refresh_stats(
    folder: str,
    questions: DataFrame,
    answers: DataFrame,
    batch: str,
    as_of: str | None = None,
    replaced: bool = False,
    buckets: int = 64,
) -> int:
    """Bring the statistics under `folder` up to date with some exams' questions; rows written.

    `questions` are new ones with all their `answers`. Their parts are kept under the name of
    their `batch` beside the others, and take the place of what their exams had by that name: a
    run that was lost is simply repeated. With `replaced` they are all questions of their
    exams, and take the place of all that these had. Only buckets with such an exam are read
    and written; the other exams in them keep their rows, `last_updated` too.
    """
    spark = questions.sparkSession
    fresh = stats_parts(questions, answers).withColumn("batch", F.lit(batch))
    fresh = written(_bucketed(fresh, buckets), "fresh")
    touched = F.broadcast(fresh.select("bucket").distinct())  # `buckets` rows at most
    exams = fresh.select(F.col("exam_id").alias("changed"), "batch").distinct()
    same = F.col("exam_id").eqNullSafe(F.col("changed"))

    kept = read_table(spark, f"{folder}/parts").join(touched, "bucket", "left_semi")
    if replaced:
        rest = kept.join(exams.select("changed").distinct(), same, "left_anti")
    else:
        rest = kept.join(exams.withColumnRenamed("batch", "again"), same & (F.col("batch") == F.col("again")), "left_anti")
    parts = written(rest.unionByName(fresh), "parts")
    changed = exams.select("changed").distinct()
    stats = read_table(spark, f"{folder}/stats").join(touched, "bucket", "left_semi").join(changed, same, "left_anti")
    renewed = _bucketed(stats_of(parts.join(changed, same, "left_semi"), as_of), buckets)
    stats = written(stats.unionByName(renewed), "stats")
    refresh_partition(parts, f"{folder}/parts", ["bucket"])
    return refresh_partition(stats, f"{folder}/stats", ["bucket"])


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", hash_bucket(F.coalesce("exam_id", F.lit("")), buckets))

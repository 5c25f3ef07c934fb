"""Table schemas, written as column lists; usable before any session exists.

Fixed values: names, types, order and nullability of the columns.
"""

from pyspark.sql import types as T

_MESSAGE = T.StructType().add("role", T.StringType()).add("content", T.StringType())
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
    "messages": T.ArrayType(_MESSAGE),
    "counts": T.MapType(T.StringType(), T.IntegerType()),
}


def _table(columns: str, keys: tuple[str, ...] = ()) -> T.StructType:
    fields = [column.split() for column in columns.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in keys) for name, kind in fields]
    )


_METADATA_COLUMNS = """
    filename string, label string, exam_number string, exam_year string,
    exam_month string, exam_session string, topik_format string, level string,
    section string, file_type string, source_url string, page_url string,
    download_date string, size_kb double, download_status string
"""

METADATA = _table(_METADATA_COLUMNS)

PAGES_RAW = _table(
    f"""exam_id string, exam_folder string, exam_edition string, {_METADATA_COLUMNS},
    source_pdf_path string, processed_at string, page_count int, page_number int,
    word_count int, char_count int, raw_text string""",
    keys=("exam_id",),
)

DIM_EXAM = _table(
    """exam_id string, exam_name string, exam_edition string, exam_number string,
    topik_level string, exam_section string""",
    keys=("exam_id",),
)

DIM_FILE = _table(
    """file_id string, filename string, file_type string, size_kb double,
    page_count int, source_pdf_path string, source_url string""",
    keys=("file_id",),
)

DIM_QUESTION = _table(
    """question_id string, exam_id string, page_number int, question_type string,
    raw_question_text string, question_stimulus string,
    question_vocabulary_items strings, question_grammar_patterns strings,
    topic string, difficulty_level string, confidence float""",
    keys=("question_id", "exam_id"),
)

DIM_ANSWER = _table(
    """answer_id string, question_id string, raw_answer_text string,
    is_correct boolean, answer_vocabulary_items strings,
    answer_grammar_patterns strings""",
    keys=("answer_id", "question_id"),
)

# Answers with the place at which they are printed, as the layer jobs keep them.
PRINTED_ANSWER = T.StructType(list(DIM_ANSWER)).add("option_pos", T.IntegerType())

FACT_DOWNLOAD = _table(
    """download_id string, exam_id string, file_id string, download_date date,
    download_status string, bronze_processed_at date, silver_processed_at date""",
    keys=("download_id", "exam_id", "file_id"),
)

FACT_QA = _table(
    "qa_id string, exam_id string, question_id string, answer_id string",
    keys=("qa_id", "exam_id", "question_id", "answer_id"),
)

CHAT_EXAMPLE = _table(
    """training_id string, exam_id string, question_id string,
    messages messages, topik_level string,
    topic string, difficulty_level string, question_type string, confidence float""",
    keys=("training_id",),
)

EXAM_STATS = _table(
    """stats_id string, exam_id string, total_questions int, total_answers int,
    avg_word_count_question double, avg_word_count_answer double,
    distribution_by_difficulty counts,
    distribution_by_type counts, last_updated timestamp""",
    keys=("stats_id", "exam_id"),
)

# What an extractor returns for one page: an array of these.
ANSWER_OPTION = (
    "struct<answer_text: string, answer_vocabulary_items: array<string>, "
    "answer_grammar_patterns: array<string>>"
)
QUESTION = (
    "struct<question_text: string, question_stimulus: string, "
    f"answer_options: array<{ANSWER_OPTION}>, question_type: string, "
    "question_vocabulary_items: array<string>, "
    "question_grammar_patterns: array<string>, topic: string, "
    "difficulty_level: string, confidence: double>"
)
QUESTIONS = f"array<{QUESTION}>"

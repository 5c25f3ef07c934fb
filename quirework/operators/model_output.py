"""Questions out of JSON text that a model produced, inside the row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.jsontext import drop_bad_escapes, json_span, trim_keys
from quirework.operators.predicates import all_of, page_is_valid
from quirework.operators.projections import compute_once

# The shape of a question with values of any JSON type, so that the types can be checked.
_ITEMS = "array<variant>"
ANY_QUESTION = (
    "struct<question_text: variant, question_stimulus: variant, answer_options: array<struct<"
    f"answer_text: variant, answer_vocabulary_items: {_ITEMS}, answer_grammar_patterns: {_ITEMS}>>, "
    f"question_type: variant, question_vocabulary_items: {_ITEMS}, "
    f"question_grammar_patterns: {_ITEMS}, topic: variant, difficulty_level: variant, confidence: variant>"
)
ANY_QUESTIONS = f"array<{ANY_QUESTION}>"

#: Levels of objects and lists below the root that are searched.
DEPTH = 6


def _value(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "variant")


def _has(node: Column, name: str) -> Column:
    return _value(node, f"$.{name}").isNotNull()


def _is_question(node: Column) -> Column:
    return _has(node, "question_text") & _has(node, "answer_options")


def _found_in(node: Column) -> Column:
    """The JSON text of the questions that a parsed value holds itself; null if it holds none.

    A `questions` field of an object, an object that is a question, or a list whose first
    item is one.
    """
    questions = _value(node, "$.questions")
    return (
        F.when(questions.isNotNull(), F.when(~F.is_variant_null(questions), F.to_json(questions)))
        .when(_is_question(node), F.concat(F.lit("["), F.to_json(node), F.lit("]")))
        .when(_is_question(_value(node, "$[0]")), F.to_json(node))
    )


def _below(node: Column) -> Column:
    """The objects and lists that a value holds, in the order in which they are written.

    Fields of a parsed value are in order of their names; only those of a map read from
    the text keep theirs. One map has the fields parsed, for what they are, the other one as
    text, for the order of what they hold. An object with a `questions` field, or one that is a
    question, is not searched further.
    """
    text = node["text"]
    as_object = F.startswith(F.ltrim(text), F.lit("{"))
    parsed = F.coalesce(
        F.map_values(F.from_json(F.when(as_object, text), "map<string,variant>")),
        F.from_json(F.when(~as_object, text), "array<variant>"),
    )
    texts = F.coalesce(
        F.map_values(F.from_json(F.when(as_object, text), "map<string,string>")),
        F.from_json(F.when(~as_object, text), "array<string>"),
    )
    inner = F.transform(
        F.arrays_zip(parsed.alias("value"), texts.alias("text")),
        lambda pair, i: F.struct(
            (node["list"] | ~as_object).alias("list"),
            F.concat(node["at"], F.array(i)).alias("at"),
            F.when(_is_container(pair["value"]), pair["text"]).alias("text"),
            _found_in(pair["value"]).alias("found"),
            _has(pair["value"], "questions").alias("closed"),
        ),
    )
    return F.coalesce(F.filter(inner, lambda n: n["text"].isNotNull()), F.array())


def _open(nodes: Column) -> Column:
    """What is to be searched further."""
    return F.filter(nodes, lambda n: n["found"].isNull() & ~n["closed"])


def _is_container(value: Column) -> Column:
    """Objects and lists that are not empty."""
    return _value(value, "$[0]").isNotNull() | F.coalesce(
        F.startswith(F.schema_of_variant(value), F.lit("OBJECT<")), F.lit(False)
    )


def locate_questions(df: DataFrame, json: str, parsed: str, name: str, depth: int = DEPTH) -> DataFrame:
    """Add the JSON text of the questions in a parsed JSON object; null where it holds none.

    The walk goes through values in the order in which they are written, each with all that
    it holds before the next one, and takes the first that is a `questions` list, a question
    or a list of questions. What lies in lists of other things counts only if there is nothing
    else. It goes `depth` levels below the root; if nothing was found and there is more below,
    or something was but a place before it has more, `<name>_deeper` is true.

    Nearly all replies hold their questions at the root: deeper levels, a column each, are
    empty for them.
    """
    root = F.col(parsed)
    df = compute_once(df, name, _found_in(root))
    start = F.struct(
        F.lit(False).alias("list"),
        F.array().cast("array<int>").alias("at"),
        F.col(json).alias("text"),
        F.lit(None).cast("string").alias("found"),
        _has(root, "questions").alias("closed"),
    )
    nodes = F.when(F.col(name).isNull() & root.isNotNull(), F.array(start)).otherwise(F.array())
    levels = []
    for level in range(depth):
        df = compute_once(df, f"_level{level}", F.flatten(F.transform(_open(nodes), _below)))
        nodes = F.col(f"_level{level}")
        levels.append(nodes)

    def first(places: Column) -> Column:
        return F.array_min(
            F.transform(places, lambda n: F.struct(n["list"].alias("list"), n["at"].alias("at"), n["found"].alias("found")))
        )

    df = df.withColumns(
        {
            "_first": first(F.filter(F.concat(*levels), lambda n: n["found"].isNotNull())),
            # Where the search stopped with things left to look into.
            "_left": first(_open(nodes)),
        }
    )
    # A null text comes before all others, but no two places are the same.
    deeper = F.col("_left").isNotNull() & (F.col("_first").isNull() | (F.col("_left") < F.col("_first")))
    return df.withColumns(
        {f"{name}_deeper": deeper, name: F.coalesce(name, F.col("_first.found"))}
    ).drop("_first", "_left", *[f"_level{k}" for k in range(depth)])


def _is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _is_optional_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).isin("STRING", "VOID"), F.lit(True))


def _are_texts(items: Column) -> Column:
    return F.coalesce(F.forall(items, _is_text), F.lit(False))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _texts(items: Column) -> Column:
    return F.transform(items, _text)


def typed_questions(questions: Column) -> Column:
    """Questions in their fixed schema; one with a value of a wrong JSON type is null.

    Texts must be texts. A confidence may be a number in a text, and counts as 0 where
    the field is missing; null or a word is wrong.
    """

    def fits(q: Column) -> Column:
        def option_fits(o: Column) -> Column:
            return all_of(
                _is_text(o["answer_text"]),
                _are_texts(o["answer_vocabulary_items"]),
                _are_texts(o["answer_grammar_patterns"]),
            )

        optional = ("question_stimulus", "question_type", "topic", "difficulty_level")
        return all_of(
            _is_text(q["question_text"]),
            *[_is_optional_text(q[name]) for name in optional],
            F.coalesce(F.forall(q["answer_options"], option_fits), F.lit(False)),
            _are_texts(q["question_vocabulary_items"]),
            _are_texts(q["question_grammar_patterns"]),
            q["confidence"].isNull() | F.try_variant_get(q["confidence"], "$", "double").isNotNull(),
        )

    def typed(q: Column) -> Column:
        options = F.transform(
            q["answer_options"],
            lambda o: F.struct(
                _text(o["answer_text"]).alias("answer_text"),
                _texts(o["answer_vocabulary_items"]).alias("answer_vocabulary_items"),
                _texts(o["answer_grammar_patterns"]).alias("answer_grammar_patterns"),
            ),
        )
        return F.struct(
            _text(q["question_text"]).alias("question_text"),
            _text(q["question_stimulus"]).alias("question_stimulus"),
            options.alias("answer_options"),
            _text(q["question_type"]).alias("question_type"),
            _texts(q["question_vocabulary_items"]).alias("question_vocabulary_items"),
            _texts(q["question_grammar_patterns"]).alias("question_grammar_patterns"),
            _text(q["topic"]).alias("topic"),
            _text(q["difficulty_level"]).alias("difficulty_level"),
            F.try_variant_get(q["confidence"], "$", "double").alias("confidence"),
        )

    return F.transform(questions, lambda q: F.when(fits(q), typed(q)))


def is_json_object(text: Column) -> Column:
    """The text is one well-formed JSON object."""
    return F.coalesce(
        F.startswith(F.schema_of_variant(F.try_parse_json(text)), F.lit("OBJECT")),
        F.lit(False),
    )


def parse_model_output(
    df: DataFrame, raw: str, questions: str = "questions", status: str = "status", depth: int = DEPTH
) -> DataFrame:
    """Add the validated questions of each text and a status.

    `ok`; `no_json` (no object in the text), `unparsable` (still not JSON after the
    repairs), `no_questions` (in none of the places where they are looked for), `too_deep`
    (the walk ended at `depth` levels with more below), `invalid` (what was found is no list of
    questions, or one of them breaks the rules, which rejects the page). Questions are null
    unless the status is `ok`.
    """
    text, json, found = F.col(raw), F.col("_json"), F.col("_found")
    repaired = trim_keys(drop_bad_escapes(json_span(text)))
    df = compute_once(df, "_json", F.when(is_json_object(text), trim_keys(text)).otherwise(repaired))
    parsed = F.try_parse_json(json)
    whole = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    df = compute_once(df, "_parsed", F.when(whole, parsed))
    df = locate_questions(df, "_json", "_parsed", "_text", depth)
    df = compute_once(df, "_found", typed_questions(F.from_json("_text", ANY_QUESTIONS)))
    state = (
        F.when(json.isNull(), "no_json")
        .when(F.col("_parsed").isNull(), "unparsable")
        .when(F.col("_text_deeper"), "too_deep")
        .when(F.col("_text").isNull(), "no_questions")
        .when(found.isNull() | ~page_is_valid(found), "invalid")
        .otherwise("ok")
    )
    df = compute_once(df, status, state)
    return df.withColumn(questions, F.when(F.col(status) == "ok", found)).drop(
        "_json", "_parsed", "_text", "_text_deeper", "_found"
    )


def dead_letters(df: DataFrame, status: str = "status") -> DataFrame:
    """Records that gave no questions, with the reason."""
    return df.filter(F.col(status) != "ok")

"""Where a user's own parser, extractor or text function plugs in.

User code runs in Python workers on Arrow batches; a client it needs should be
made lazily inside the function, once for each worker. Results of slow or
non-repeatable code should be written to a table before they are used twice.
"""

import gc
import time
from collections.abc import Callable, Iterator
from operator import index

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quirework.functions.replies import checked_questions, read_reply
from quirework.schemas import QUESTIONS

EXTRACTION = f"questions {QUESTIONS}, status string, error string, attempts int"
_HELD_RESULTS = 500_000  # characters of pages that are held as Python objects, or of what they gave
_PER_RESULT = 100  # what a result counts for besides
PAGES = "page_count int, page_number int, raw_text string, status string, error string"


def text_udf(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """A vectorized column function from a user's text function; null stays null."""

    @F.pandas_udf(T.StringType())
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    return apply


def _with_fields(df: DataFrame, ddl: str, replaced: tuple[str, ...] = ()) -> T.StructType:
    kept = [f for f in df.schema if f.name not in replaced]
    return T.StructType(kept + list(T.StructType.fromDDL(ddl)))


def extract_pages(
    df: DataFrame,
    text: str,
    extractor: Callable[[str], list[dict]],
    max_attempts: int = 3,
    retry_delay: float = 1.0,
    parallelism: int | None = None,
) -> DataFrame:
    """Add `questions, status, error, attempts` by calling `extractor` for each page.

    A result has to be a list of dicts that obey the rules for questions (required fields,
    types, enumerations, topic length, confidence range). Anything else, and any exception,
    is retried inside the task; a page that keeps failing becomes a row with status `failed`
    and the last error, not a failed job. The other columns stay the Arrow arrays they are.
    `parallelism` bounds the number of concurrent callers, and spreads the pages evenly over
    them.
    """
    return _extracted(df, text, lambda page: checked_questions(extractor(page)), max_attempts, retry_delay, parallelism)


def extract_replies(
    df: DataFrame,
    text: str,
    model: Callable[[str], str],
    max_attempts: int = 3,
    retry_delay: float = 1.0,
    parallelism: int | None = None,
) -> DataFrame:
    """`extract_pages` for a model that replies with text, in which the questions are JSON.

    The reply is repaired, searched and checked in the task, so that a malformed one is asked
    for again. `error` ends with the reason: `no_json`, `unparsable`, `no_questions`,
    `too_deep`, or `invalid: ` with the first rule that is broken.
    """
    return _extracted(df, text, lambda page: read_reply(model(page)), max_attempts, retry_delay, parallelism)


def _extracted(df, text, questions_of, max_attempts, retry_delay, parallelism) -> DataFrame:
    schema = _with_fields(df, EXTRACTION)
    added = to_arrow_schema(T.StructType.fromDDL(EXTRACTION))

    def one(page: str | None) -> tuple:
        error = None
        for attempt in range(1, max_attempts + 1):
            try:
                return questions_of(page), "ok", None, attempt
            except Exception as exc:  # the user's code may raise or return anything
                error = f"{type(exc).__name__}: {exc}"
                if attempt < max_attempts:
                    time.sleep(retry_delay)
        return None, "failed", error, max_attempts

    def as_arrays(results: list[tuple]) -> list[pa.Array]:
        return [pa.array(x, f.type) for x, f in zip(zip(*results, strict=True), added, strict=True)]

    def fitting(result: tuple) -> tuple:
        try:
            as_arrays([result])
        except Exception as exc:  # what the rules let pass may still be no value of the columns
            return None, "failed", f"{type(exc).__name__}: {exc}", result[3]
        return result

    def made(part: pa.RecordBatch, results: list[tuple]) -> pa.RecordBatch:
        try:
            columns = as_arrays(results)
        except Exception:  # one page's result keeps all from being put together
            columns = as_arrays([fitting(r) for r in results])
        return pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *added.names])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first, results, held = 0, [], 0
        for at, page in enumerate(batch[text]):
            page = page.as_py()
            results.append(one(page))
            held += len(page or "") + _PER_RESULT
            # Hand on what was found before it fills the memory.
            if held > _HELD_RESULTS or at + 1 == batch.num_rows:
                yield made(batch.slice(first, at + 1 - first), results)
                first, results, held = at + 1, [], 0
                gc.collect(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Results are trees of many small objects, which are freed without the collector; it
        # would go through them over and over, for a third of the time. What the user's code
        # leaves in cycles is collected at each hand-over, and wholly after each batch.
        collects = gc.isenabled()
        gc.disable()
        try:
            for batch in batches:
                yield from each(batch)
                gc.collect()
        finally:
            if collects:
                gc.enable()

    spread = df.repartition(parallelism) if parallelism else df
    return spread.mapInArrow(run, schema)


def parse_documents(
    df: DataFrame,
    document: str,
    parser: Callable[[object], dict[int, str]],
    parallelism: int | None = None,
) -> DataFrame:
    """One row per page of each document, keeping the document's other columns.

    `parser` gets the value of the `document` column (a path, or the bytes of a
    binary scan) and returns {page number: text}, counted from 1. Missing numbers up to
    the highest and null texts become empty pages. A document that fails, whose result is
    anything else, or that has no page, gives one row with null page columns and status
    `failed` or `empty`, for the audit.
    """
    schema = _with_fields(df, PAGES, replaced=(document,))
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]

    def pages_of(value) -> Iterator[tuple]:
        try:
            found = parser(value)
            if found is not None and not isinstance(found, dict):
                raise TypeError("the result is no dict of pages")
            pages = {index(number): text for number, text in (found or {}).items()}
            if any(not 1 <= number < 2**31 for number in pages):
                raise ValueError("a page number below 1 or too large")
            if any(text is not None and not isinstance(text, str) for text in pages.values()):
                raise TypeError("a page that is no text")
            pa.array(list(pages.values()), pa.string())
        except Exception as exc:  # the user's code may raise or return anything
            yield None, None, None, "failed", f"{type(exc).__name__}: {exc}"
            return
        if not pages:
            yield None, None, None, "empty", None
            return
        last = max(pages)
        for number in range(1, last + 1):
            yield last, number, pages.get(number) or "", "ok", None

    names = schema.names

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = pa.Table.from_batches([batch]).drop_columns([document])
        sources, pages, held = [], [], 0

        def made() -> list[pa.RecordBatch]:
            columns = [pa.array(v, k) for v, k in zip(zip(*pages), kinds)]
            source = kept.take(pa.array(sources, pa.int64()))
            return pa.table([*source.columns, *columns], names).to_batches()

        for at, value in enumerate(batch.column(document)):
            for page in pages_of(value.as_py()):
                sources.append(at)
                pages.append(page)
                held += len(page[2] or "") + _PER_RESULT
                # Hand on pages before they fill the memory, blank ones and those of one
                # document too.
                if held > _HELD_RESULTS:
                    yield from made()
                    sources, pages, held = [], [], 0
        if pages:
            yield from made()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from each(batch)
            # Nothing of it stays while the next one is read.
            del batch
            pa.default_memory_pool().release_unused()

    spread = df.repartition(parallelism) if parallelism else df
    return spread.mapInArrow(run, schema)

"""Questions out of one model reply, in Python, for use inside a worker's retry loop.

The same repairs, search and rules as `operators.model_output` applies to whole columns;
a test holds the two against each other.
"""

import json
import re
from itertools import chain

from quirework.constants import DIFFICULTY_LEVELS, QUESTION_TYPES, SPACE_CHARS, TOPIC_MAX_CHARS

_BLANK = f"[{re.escape(SPACE_CHARS)}]*"
_KEY = re.compile(rf'"{_BLANK}(\w+){_BLANK}"{_BLANK}:')
_BAD_ESCAPE = re.compile(r"\\u(?![0-9a-fA-F]{4})")
_SPAN = re.compile(r"\{.*\}", re.DOTALL)


def _object(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a key that repeats")
    return found


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


_DECODER = json.JSONDecoder(object_pairs_hook=_object, parse_constant=_no_constant)


def _parsed(text: str):
    """The JSON object that a text starts with, whatever follows it; None for anything else."""
    try:
        value, _ = _DECODER.raw_decode(text.lstrip(" \t\n\r"))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is_question(value) -> bool:
    return isinstance(value, dict) and "question_text" in value and "answer_options" in value


def _walk(value, depth: int, in_lists: bool):
    """Values of what holds questions, in the order of the walk; `in_lists` searches lists too."""
    if isinstance(value, dict):
        if "questions" in value:
            if value["questions"] is not None:
                yield value["questions"]
            return
        if _is_question(value):
            yield [value]
            return
    elif isinstance(value, list):
        if value and _is_question(value[0]):
            yield value
            return
        if not in_lists:
            return
    else:
        return
    inner = list(value.values()) if isinstance(value, dict) else value
    if depth == 0 and any(isinstance(v, (dict, list)) and v for v in inner):
        raise ValueError("too_deep")
    for v in inner if depth else ():
        yield from _walk(v, depth - 1, in_lists)


def read_reply(reply: str | None, depth: int = 6) -> list[dict]:
    """The questions of a reply, checked. The reason is the message of the error otherwise."""
    text = reply or ""
    if _parsed(text) is not None:
        found = _parsed(_KEY.sub(r'"\1":', text))
    else:
        span = _SPAN.search(text)
        if not span:
            raise ValueError("no_json")
        found = _parsed(_KEY.sub(r'"\1":', _BAD_ESCAPE.sub("", span[0])))
    if found is None:
        raise ValueError("unparsable")
    for in_lists in (False, True):
        for questions in _walk(found, depth, in_lists):
            return checked_questions(questions)
    raise ValueError("no_questions")


def _are(values, *types) -> bool:
    """All values are of these types themselves: a loop that stays in C."""
    return set(map(type, values)) <= set(types)


def _texts(values: list) -> bool:
    if not _are(values, str):
        return False
    "".join(values).encode()  # a lone surrogate is no text
    return True


def _lists(lists: list) -> bool:
    """All are lists of texts."""
    return _are(lists, list, tuple) and (not any(lists) or _texts(list(chain.from_iterable(lists))))


def _problem(q: dict) -> str | None:
    if not _texts([q.get("question_text")]):
        return "question_text is no text"
    options = q.get("answer_options")
    if not isinstance(options, (list, tuple)) or not (_are(options, dict) or all(isinstance(o, dict) for o in options)):
        return "answer_options is no list of options"
    if not _texts([o.get("answer_text") for o in options]):
        return "answer_text is no text"
    for name in ("answer_vocabulary_items", "answer_grammar_patterns"):
        if not _lists([o.get(name) for o in options]):
            return f"{name} is no list of texts"
    for name in ("question_vocabulary_items", "question_grammar_patterns"):
        if not _lists([q.get(name)]):
            return f"{name} is no list of texts"
    for name in ("question_stimulus", "question_type", "topic", "difficulty_level"):
        if q.get(name) is not None and not _texts([q[name]]):
            return f"{name} is no text"
    if q.get("question_type") not in (None, *QUESTION_TYPES):
        return f"question_type is {q['question_type']!r}"
    if q.get("difficulty_level") not in (None, *DIFFICULTY_LEVELS):
        return f"difficulty_level is {q['difficulty_level']!r}"
    if len(q.get("topic") or "") > TOPIC_MAX_CHARS:
        return f"topic has over {TOPIC_MAX_CHARS} characters"
    return None


def _confidence(q: dict) -> float:
    """A number, or one in a text; 0 where the field is missing."""
    try:
        value = float(q.get("confidence", 0.0))
    except (TypeError, ValueError):
        raise ValueError("invalid: confidence is no number") from None
    if not 0.0 <= value <= 1.0:
        raise ValueError("invalid: confidence is not from 0 to 1")
    return value


def checked_questions(questions) -> list[dict]:
    """The questions as they are, with confidence a number; an error names what is wrong.

    One wrong question rejects them all.
    """
    if not isinstance(questions, (list, tuple)) or not all(isinstance(q, dict) for q in questions):
        raise TypeError("invalid: the result is no list of dicts")
    for q in questions:
        if problem := _problem(q):
            raise ValueError(f"invalid: {problem}")
    return [q | {"confidence": _confidence(q)} for q in questions]

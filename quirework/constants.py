"""They must stay exactly as they are for results to be right."""

# ---- Fixed values: text cleaning ------------------------------------------
# White space as Unicode text processing defines it (code points spelled out,
# because Java's and RE2's shorthand classes both cover fewer characters).
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CHARS = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)
# All other characters. Java tests the parts of a class in turn, so the common ones
# stand outermost: this is four times as fast as the negated class of SPACE.
NOT_SPACE = (
    r"[!-~[\x{a1}-\x{167f}\x{3001}-\x{10ffff}[\x{00}-\x{08}\x{0e}-\x{1b}\x{7f}-\x{84}"
    r"\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}"
    r"\x{2060}-\x{2fff}]]]"
)
# Word characters: letters, all numbers (circled ones too) and underscore.
WORD = r"\p{L}\p{N}_"

# Kana and CJK ideographs; the wide range in front turns most text away in one test.
FOREIGN_SCRIPT = (
    r"[\x{3040}-\x{9FFF}&&[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]]+"
)
NOT_HANGUL = r"[^\x{AC00}-\x{D7A3}]+"
CIRCLED_DIGITS = {"①": "1.", "②": "2.", "③": "3.", "④": "4."}

# ---- Fixed values: question vocabulary ------------------------------------
QUESTION_TYPES = ("vocabulary", "grammar", "reading comprehension", "image dependent")
DIFFICULTY_LEVELS = ("easy", "medium", "hard")
TOPIC_MAX_CHARS = 30
OPTIONS_PER_QUESTION = 4

# ---- Fixed values: file labels --------------------------------------------
LEVELS = ("TOPIK II", "TOPIK I")
SECTIONS = ("READING", "LISTENING", "WRITING")
FILE_TYPES = ("TEST PAPER", "ANSWER KEYS", "AUDIO FILE", "TRANSCRIPT")
DOWNLOAD_EXTENSIONS = ("pdf", "mp3")
READING_PAPER_SUFFIX = "-Reading-Test-Paper.pdf"
FIRST_CONTENT_PAGE = 3
FORMAT_MARKERS = {"new format": "New Format", "old format": "Old Format"}
DEFAULT_FORMAT = "New Format"
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# ---- Fixed values: chat examples ------------------------------------------
SYSTEM_PROMPT = """You are a Korean language expert and TOPIK exam question generator.

Your task is to create new TOPIK exam questions that follow the official exam format and style.

Output format:
Question stimulus: <optional context shown before the question, or leave blank if none>
Question text: <the main question in Korean>
Option 1. <first answer choice>
Option 2. <second answer choice>
Option 3. <third answer choice>
Option 4. <fourth answer choice>

Rules:
- All content must be written in Korean.
- The question must be original and not copied from existing questions.
- The question must be grammatically correct and meaningful.
- There must be exactly four answer choices with only one correct answer.
- The question must match the requested TOPIK level, topic, difficulty, and question type."""

# Templates use printf-style slots, filled column by column.
USER_REQUEST = (
    'Generate a %s multiple-choice question about the topic "%s", with difficulty '
    'level "%s" and question type "%s". Follow the output format specified in the '
    "system prompt."
)
ASSISTANT_ANSWER = (
    "Question stimulus: %s\nQuestion text: %s\n"
    "Option 1. %s\nOption 2. %s\nOption 3. %s\nOption 4. %s"
)

# ---- Fixed values: keys ----------------------------------------------------
KEY_SEPARATOR = "||"

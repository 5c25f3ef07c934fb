"""What comes to the driver: bounded models, benchmark slices and lists of shards."""

import pathlib
import re

BOUNDED = {
    "decontaminate.py": 1,  # a slice of the benchmark
    "tokens.py": 1,  # the list of shards
    "language.py": 1,  # the model
    "quality.py": 1,  # the training sample
    "codes.py": 3,  # the first vectors, and the codebook sums
    "resample.py": 1,  # counts by bucket
    "shards.py": 1,  # bins of all parts
}


def test_only_bounded_rows_come_to_the_driver():
    root = pathlib.Path(__file__).parents[2] / "quirework" / "llm"
    found = {}
    for path in root.glob("*.py"):
        text = path.read_text(encoding="utf-8")
        assert not re.search(r"\.(toPandas|toLocalIterator|localCheckpoint|rdd)\b", text), path
        if n := len(re.findall(r"\.(?:collect|toArrow)\(\)", text)):
            found[path.name] = n
    assert found == BOUNDED

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[2]
for path in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(path))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, line int, n int, h string"
ODD = [
    (None, "a text without an id that has some words in it", "en", None),
    (1, None, None, "a"),
    (2, "", "en", "a"),
    (3, "12 34 !!", "en", "b"),
    (4, "same words in a row that stands here twice or more", "en", "b"),
    (4, "same words in a row that stands here twice or more", "en", "b"),
    (5, "word " * 30_000, "en", None),
    (6, "x" * 200_000, None, "a"),
    (7, "line one of seven words is here now\n\nline two of seven words is here now", "en", "c"),
]


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text[, lang[, source]]) as a table with columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, 1, 2, "h") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
for path in (ROOT, ROOT / "tools"):
    sys.path.insert(0, str(path))

from quarryline.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


# Started on import, since tests name columns at module level.
SPARK = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"})


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture
def values(spark):
    """Values of one expression over literal rows of one text column ``t``."""

    def run(texts, column):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]

    return run

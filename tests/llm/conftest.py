import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and extra columns."""
    def make(rows):
        wide = [(i, t, rest[0] if rest else None, "s", len(t) if t is not None else None, "extra") for i, t, *rest in rows]
        return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    return make


@pytest.fixture
def sf(spark, tmp_path):
    """Write tables as <dir>/<name>.parquet, as the queries read them."""
    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write

"""Operators that SQL can express, against the same in SQL, with damaged input beside."""

import duckdb
import pandas as pd
import pytest

from stratamart.llm.oracle import ORACLE
from stratamart.llm.queries import QUERIES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


def compare(spark, name, sf_dir, views):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    duck = duckdb.connect()
    for view, path in views.items():
        duck.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    theirs = duck.sql(ORACLE[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)

    def ordered(df):
        return df[columns].sort_values(columns).reset_index(drop=True).astype(object)

    left, right = ordered(ours), ordered(theirs)
    assert len(left) == len(right)
    same = (left == right) | (left.isna() & right.isna())
    assert same.all().all(), left[~same.all(axis=1)].head()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    views = {t: f"{SF_DIR}/{t}.parquet" for t in ("documents", "conversations")}
    compare(spark, name, SF_DIR, views)


@pytest.mark.parametrize("name", ["op2_ngram_jaccard", "op3_line_dedup", "op8_quality_rules"])
def test_matches_sql_on_awkward_documents(spark, name, tmp_path):
    base = "the cat sat\non the mat\nand looked\nat the moon\nuntil the day\ncame round again"
    rows = [
        (1, None),
        (2, ""),
        (3, "\n\n \n"),
        (4, base),
        (5, base),
        (6, "new start\n" + base.upper() + "\nend"),
        (7, base + "\n" + base),
        (8, "a b c"),
        (9, "A B  c"),
        (10, "a b c d"),
        (11, "x" * 5000 + "\n" + "y z " * 3000),
        (12, "on the mat\n\nand looked\nat the moon\nother"),
    ]
    frame = pd.DataFrame(rows, columns=["doc_id", "text"])
    frame.to_parquet(tmp_path / "documents.parquet")
    compare(spark, name, str(tmp_path), {"documents": tmp_path / "documents.parquet"})

"""Every registered query of the event operators against its SQL twin."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from gamestate.operators.models import RARE
from gamestate.plans import domain, evaluation, feeds, modelling, relational, storage  # noqa: F401
from gamestate.plans.registry import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return c


def _text(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return ""
    return repr(float(v)) if isinstance(v, (int, float, bool, np.integer, np.floating, np.bool_)) else str(v)


def _rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    return sorted(tuple(_text(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, tiny, name):
    got, want = QUERIES[name](spark, tiny).toPandas(), db.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_models_score_between_0_and_1(spark, tiny):
    df = QUERIES["xg_train_score"](spark, tiny).toPandas()
    assert len(df) and df["xG"].between(0, 1).all()
    filled = QUERIES["impute_shot_type"](spark, tiny).toPandas()
    assert filled["event_detail"].notna().all()
    known = filled["secondary_type"].notna() & ~filled["secondary_type"].isin(RARE)
    assert (filled["secondary_type"][known] == filled["event_detail"][known]).all()

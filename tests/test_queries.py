"""Every registered query of the base library against its SQL on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import siftmill.plans.archives  # noqa: F401
import siftmill.plans.judged  # noqa: F401
import siftmill.plans.more  # noqa: F401
import siftmill.plans.records  # noqa: F401
import siftmill.plans.scorer  # noqa: F401
import siftmill.plans.stories  # noqa: F401
import siftmill.plans.wording  # noqa: F401
from siftmill.plans.queries import ORACLES, QUERIES

TABLES = "customer orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    r = duck.execute(ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == Counter(tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall())

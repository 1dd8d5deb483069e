"""Vector links against DuckDB and against all pairs, in many small cells and blocks."""

import numpy as np
import pytest

from cohortlens.llm import embedding_dedup as E
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows):
    """All pairs."""
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(r[1]) / np.linalg.norm(r[1]) for r in ok]
    links = [[j for j in range(len(ok)) if j != i and ok[i][2] == ok[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(len(ok))]
    out = {}
    for i, r in enumerate(ok):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.setdefault(r[0], []).append((len(links[i]), min(ok[j][0] for j in seen)))
    return out


def test_query_equals_duckdb(spark):
    same(spark, QUERIES["op3_embedding_dedup"], ORACLES["op3_embedding_dedup"], SF)


@pytest.mark.parametrize("cell_rows,block", [(4000, 2000), (15, 2000), (15, 4), (40, 7)])
def test_cells_and_blocks_lose_no_link(spark, cell_rows, block):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):  # chains of near vectors that cross cells
        v = rng.normal(size=6)
        for _ in range(rng.integers(2, 25)):
            rows.append((len(rows), [float(x) for x in v], int(g % 2)))
            v = v + rng.normal(size=6) * 0.12
    rows += [(len(rows) + i, rows[3][1], rows[3][2]) for i in range(5)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.deduplicate(spark.createDataFrame(rows, SCHEMA), cell_rows=cell_rows, block=block).collect()}
    assert got == {k: v[0] for k, v in plain(rows).items()}


def test_margin_of_visits():
    rng = np.random.default_rng(0)
    c = E.centres(rng.normal(size=(50, 4)) / 2, 8)
    c /= np.linalg.norm(c, axis=1)[:, None]
    x = rng.normal(size=(300, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    home, visits = E.cells_of(x, c, np.sqrt(2 - 2 * 0.98) / 2)
    i, j = np.nonzero(x @ x.T >= 0.98)
    assert all(home[a] == home[b] or visits[a, home[b]] or visits[b, home[a]] for a, b in zip(i, j))


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1, 7), (2, [], 1, 7), (3, [0.0, 0.0], 1, 7), (4, [1.0, None], 1, 7), (5, [nan, 1.0], 1, 7), (6, [inf, 1.0], 1, 7), (7, [1.0, 1.0], None, 7),
            (8, [1.0, 1.0], 1, 7), (8, [1.0, 1.0], 1, 7), (9, [2e200, 2e200], 1, 7), (10, [1.0, 1.0, 0.0], 1, 7), (11, [1.0, 1.0], 2, 7), (None, [1.0, 1.0], 1, 7), (12, [-0.0, 1.0], 3, 7), (13, [0.0, 1.0], 3, 7)]
    df = spark.createDataFrame([] if empty else rows, SCHEMA + ", n_links int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.deduplicate(df).collect()), key=lambda r: (r[0] or 0, r))
    want = [(None, 0, None, False)] + [(i, 0, i, True) for i in range(1, 8)] + [(8, 2, 8, True)] * 2 + [(9, 2, 8, False), (10, 0, 10, True), (11, 0, 11, True), (12, 1, 12, True), (13, 1, 12, False)]
    assert got == ([] if empty else want)

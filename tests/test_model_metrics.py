"""Metrics over a model's scores against DuckDB on the same written scores."""
import duckdb
import pytest

from chartgrid.catalog import model_metrics
from chartgrid.operators.metrics import auc, confusion_matrix, roc_points
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def scores(spark):
    return model_metrics.scored_stays(spark, SF_MID)


def test_model_scores_against_duckdb(spark, scores, tmp_path, monkeypatch):
    path = f"{tmp_path}/scores"
    scores.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute("""SELECT avg(CASE WHEN a.p1 > b.p1 THEN 1.0 WHEN a.p1 = b.p1 THEN 0.5 ELSE 0 END)
        FROM s a JOIN s b ON a.label = 1 AND b.label = 0""").fetchone()[0]
    assert auc(scores, "p1", "label").first()[0] == pytest.approx(want)
    points = con.execute("""SELECT t.p1, avg((s.p1 >= t.p1)::INT) FILTER (label = 0), avg((s.p1 >= t.p1)::INT) FILTER (label = 1)
        FROM s, (SELECT DISTINCT p1 FROM s) t GROUP BY t.p1 ORDER BY 1""").fetchall()
    got = sorted(tuple(r) for r in roc_points(scores, "p1", "label").collect())
    assert [tuple(map(pytest.approx, p)) for p in points] == got
    cells = dict(((a, b), n) for a, b, n in con.execute(
        "SELECT label::INT, (p1 > 0.5)::INT, count(*) FROM s GROUP BY ALL").fetchall())
    assert {(r["label"], r["pred"]): r["n"] for r in confusion_matrix(scores, "label", "decision").collect()} == {
        (a, b): cells.get((a, b), 0) for a in (0, 1) for b in (0, 1)}
    monkeypatch.setattr(model_metrics, "scored_stays", lambda *_: scores)
    rows = model_metrics.q_model_report(spark, SF_MID).collect()
    assert [r["value"] for r in rows if r["part"] == "auc"] == [pytest.approx(want)]
    assert len(rows) == 5 * 4 + 4 + 1

"""Every registered query against its SQL on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import check
from lossmill.plans import catalog, oracles

FOLDER = entry.SMOKE_FOLDER
HAVE_DATA = Path(FOLDER).is_dir()
needs_data = pytest.mark.skipif(not HAVE_DATA, reason="test tables are not there")
ORACLE = oracles.oracle_sql()
MODEL_QUERIES = {
    "boosted_frequency", "boosted_severity", "xol_probability", "pure_premium", "ml_insights",
    "renewal_scores", "insight_validation", "leakage_clusters_model", "permutation_importance",
}


def test_every_query_but_the_models_has_sql():
    assert set(catalog.registered()) == set(ORACLE) | MODEL_QUERIES
    assert not set(ORACLE) & MODEL_QUERIES
    assert set(catalog.registered()) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def db():
    return check.connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    found = entry.queries()[name](spark, FOLDER).toPandas()
    assert check.compare(found, db.execute(ORACLE[name]).df()) == ""


@needs_data
def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "Underwriting_Month", "Region", "Total_EarnedPremium", "Total_UltimateLosses",
        "Monthly_LR", "Prev_Month_LR", "Delta_LR",
    ]
    assert frame.count() == 1015


@needs_data
def test_compare_sees_differences():
    import pandas as pd

    left = pd.DataFrame({"a": [1, 2], "b": [None, 0.5]})
    assert check.compare(left, left[["b", "a"]].iloc[::-1]) == ""
    assert "rows" in check.compare(left, left.iloc[:1])
    assert "differ" in check.compare(left, left.assign(a=[1, 3]))
    assert "columns" in check.compare(left, left.rename(columns={"a": "c"}))


@needs_data
@pytest.mark.parametrize("pipeline", [True, False])
def test_the_library_works_without_the_corpus_operators(tmp_path, pipeline):
    root = Path(entry.__file__).resolve().parent
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    if not pipeline:
        (tmp_path / "repo" / "corpus_pipeline.py").unlink()
    script = (
        "import __spark_entry__ as e\n"
        "from lossmill.session import local_session\n"
        "assert set(e.queries()) >= set(e.oracle_sql()) and 'pipeline' not in e.queries()\n"
        f"print('rows', e.queries()['earned_premium'](local_session(2), {FOLDER!r}).count())\n"
    )
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=300)
    assert "rows 1500" in done.stdout, done.stderr[-2000:]

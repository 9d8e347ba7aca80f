import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lossmill import session
from lossmill.operators import boosting as bt
from lossmill.operators import mart, star
from lossmill.params import Leakage
from lossmill.plans.warehouse import MONTHLY_VIEW, Settings, Warehouse
from lossmill.sources import tables


@pytest.fixture
def store(spark, portfolio):
    folder = session.scratch_path(spark, "test-warehouse")
    return Warehouse(spark, folder, buckets=3, prefix="t_").build(portfolio)


def sorted_rows(frame):
    return sorted(map(str, frame.collect()))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_equal_the_rowwise_ledger(store, portfolio):
    ledger = mart.policy_ledger(portfolio)
    assert sorted_rows(store.fact()) == sorted_rows(ledger.select(*mart.MART_COLUMNS))
    assert sorted_rows(store.table("dim_policies")) == sorted_rows(star.dim_policies(portfolio))
    monthly = star.monthly_loss_ratios(star.with_dimension(ledger))
    assert sorted_rows(store.monthly()) == sorted_rows(monthly)
    assert sorted_rows(store.table(MONTHLY_VIEW)) == sorted_rows(monthly)


def test_a_second_build_replaces_the_first(store, portfolio):
    first = sorted_rows(store.fact())
    store.build(portfolio)
    assert sorted_rows(store.fact()) == first
    store.build(portfolio, Settings(ibnr_additive=False))
    assert store.fact().count() == portfolio.count()


def test_joins_between_stored_tables_need_no_shuffle(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (store.modeling(), store.audit_data()):
            plan = plan_of(frame)
            assert "Exchange" not in plan and "SortMergeJoin" in plan
        # The month and the region are the only exchanges of the monthly view.
        assert plan_of(store.monthly()).count("Exchange hashpartitioning") == 2
        assert "Exchange hashpartitioning(IDpol" not in plan_of(store.monthly())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(store):
    plan = plan_of(store.modeling())
    assert "GreaterThan(Exposure,0.0)" in plan
    assert "VehBrand" not in plan and "CombinedRatio" not in plan


def test_export(spark, store, tmp_path):
    paths = store.export(str(tmp_path))
    assert len(paths) == 3
    for path, rows in zip(paths, (6, 6, 4)):
        assert spark.read.parquet(path).count() == rows
        part = next(p for p in (tmp_path / path.split("/")[-1]).glob("*.parquet"))
        assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


def test_insights_are_stored_and_audited(store):
    tiny = bt.Boosting(rounds=1, depth=2)
    scores = store.train_insights(tiny, tiny, tiny)
    assert scores.count() == 5  # one policy has no exposure
    clusters = store.leakage(Leakage(ratio_above=0.0, policies_above=0))
    assert clusters.agg(F.sum("Toxic_Policy_Count")).first()[0] == 5


def test_a_resumed_training_keeps_the_stored_rounds(store):
    tiny = [bt.Boosting(rounds=n, depth=2, rounds_per_job=1) for n in (1, 3)]
    store.train_insights(*[tiny[0]] * 3)
    first = {tuple(map(str, r)) for r in store.table("model_nodes").collect()}
    store.train_insights(*[tiny[1]] * 3, resume=True)
    longer = {tuple(map(str, r)) for r in store.table("model_nodes").collect()}
    assert first < longer
    scores = sorted_rows(store.table("ml_underwriting_insights"))
    store.train_insights(*[tiny[1]] * 3)
    assert sorted_rows(store.table("ml_underwriting_insights")) == scores
    assert {tuple(map(str, r)) for r in store.table("model_nodes").collect()} == longer
    again = store.score(store.modeling()).select("IDpol", "Pred_Frequency_Count")
    assert sorted_rows(again) == sorted_rows(store.table("ml_underwriting_insights").select("IDpol", "Pred_Frequency_Count"))


class Elsewhere:
    """A cluster session, as far as the folder lookup sees it."""

    def __init__(self, folder=None):
        self.folder = folder
        self.conf = self
        self.sparkContext = self
        self.master = "yarn"

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default

    def getCheckpointDir(self):  # noqa: N802
        return None


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(Elsewhere("hdfs:///shared/ck/")) == "hdfs:///shared/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Elsewhere())
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_cut_lineage_keeps_rows_and_column_metadata(spark):
    frame = spark.range(5).select(F.col("id").alias("x", metadata={"kind": "k"}))
    cut = session.cut_lineage(frame)
    assert cut.schema["x"].metadata == {"kind": "k"}
    assert sorted(cut.collect()) == sorted(frame.collect())


def test_buckets_follow_the_stored_input(spark, tmp_path, monkeypatch):
    spark.range(50_000).write.parquet(f"{tmp_path}/a")
    stored = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    cores, shuffled = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert tables.fitting_buckets(spark, [f"{tmp_path}/a"]) == 2 * cores
        monkeypatch.setattr(tables, "BUCKET_BYTES", stored // 20)
        assert 20 <= tables.fitting_buckets(spark, [f"{tmp_path}/a"]) < 30
        monkeypatch.setattr(tables, "BUCKET_BYTES", 1)
        assert tables.fitting_buckets(spark, [f"{tmp_path}/a"]) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffled))

"""Behaviour tests mirroring the reference's: admission, training, manifest."""

import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from tollgate.operators import evidence as evd
from tollgate.operators import model as mdl
from tollgate.operators import registry as reg
from tollgate.operators import release as rel
from tollgate.operators import training as tr
from tollgate.sources import bindings as b
from tollgate.sources import io as sio

SF = "/root/testdata/sf0.001"


def _evidence(spark, freeze: bool, burn: float):
    k = "release"
    spine = spark.createDataFrame([(k,)], "release string")
    slo = spark.createDataFrame([(k, burn, freeze)], "release string, max_burn_rate double, release_freeze boolean")
    perf = spark.createDataFrame([(k, True)], "release string, performance_passed boolean")
    queue = spark.createDataFrame([(k, True, 0)], "release string, queue_passed boolean, critical_pending int")
    gov = spark.createDataFrame([(k, "approved_for_champion")], "release string, governance_decision string")
    supply = spark.createDataFrame([(k, 12, "actions/attest@v4")],
                                   "release string, artifact_count int, attestation_action string")
    plan = spark.createDataFrame([(k, "advance_canary")], "release string, release_action string")
    return spine, "release", slo, perf, queue, gov, supply, plan


def test_admission_admits_and_freezes(spark):
    ok = rel.release_admission(*_evidence(spark, False, 0.4)).collect()[0]
    assert ok.recommended_action == "admit_canary" and ok.admitted and not ok.unsafe_allow
    frozen = rel.release_admission(*_evidence(spark, True, 20.0)).collect()[0]
    assert frozen.recommended_action == "freeze_promotion" and not frozen.admitted
    spine, key, slo, *rest = _evidence(spark, False, 0.4)
    missing = rel.release_admission(spine, key, slo.limit(0), *rest).collect()[0]
    assert not missing.slo_ok and missing.recommended_action == "hold_canary"
    lenient = rel.release_admission(spine, key, slo.limit(0), *rest, missing_slo_fails=False).collect()[0]
    assert lenient.slo_ok and lenient.recommended_action == "admit_canary"


def test_training_reproducible_and_risk_ordering(spark):
    train = b.churn_split(spark, SF).filter(F.col("split") == "train").cache()
    a = {r.term: r.coefficient for r in tr.train_logistic(train).collect()}
    c = {r.term: r.coefficient for r in tr.train_logistic(train).collect()}
    assert a == c
    stats = mdl.feature_stats(train).collect()[0].asDict()
    cols = ["model", "version", "bias", *[f"w_{f}" for f in mdl.FEATURES], "enterprise_adj", "threshold"]
    row = ("trained", "t", a["intercept"], *[a[f] for f in mdl.FEATURES], a["enterprise"], 0.5)
    models = spark.createDataFrame([row], cols)
    for k, v in stats.items():
        models = models.withColumn(k, F.lit(v))
    profiles = spark.createDataFrame(
        [("low", "enterprise", 42, 520.0, 1, 0, 0.03), ("high", "self_serve", 6, 70.0, 8, 4, 0.62)],
        "customer_id string, segment string, tenure_months int, monthly_spend double, support_tickets int, "
        "late_payments int, usage_drop_pct double")
    s = {r.customer_id: r.churn_score for r in mdl.score(profiles, models, keep=["customer_id"]).collect()}
    assert s["high"] > s["low"]
    train.unpersist()


def test_manifest_sorted_with_hashes(spark):
    root = tempfile.mkdtemp(prefix="artifacts-", dir="/tmp")
    os.makedirs(os.path.join(root, "models"))
    files = {"models/model.json": b'{"w": 1}', "reports/gate.json": b'{"passed": true}', "a.txt": b"abc"}
    for rel_path, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(root, rel_path)) or root, exist_ok=True)
        with open(os.path.join(root, rel_path), "wb") as f:
            f.write(data)
    m = sio.file_manifest(spark, root, glob="*.*").collect()
    assert [r.path for r in m] == sorted(files)
    for r in m:
        assert r.sha256 == hashlib.sha256(files[r.path]).hexdigest() and r.bytes == len(files[r.path])
    lines = sio.checksum_lines(sio.file_manifest(spark, root, glob="*.*")).collect()
    assert lines[0].value == f"{hashlib.sha256(b'abc').hexdigest()}  a.txt"


def test_segment_fits_equal_single_fits(spark):
    """All segments fitted together equal one fit each, also for many segments and one of a single class."""
    from pyspark.sql import functions as F
    from tollgate.operators import training as tr
    from tollgate.sources import bindings as b

    rows = b.churn_split(spark, "/root/testdata/sf0.01").filter("split = 'train'").withColumn("segment", F.concat("segment", (F.col("c_custkey") % 3).cast("string")))
    fitted = tr.train_by_segment(rows)
    got = {(r["segment"], r["term"]): r for r in fitted.collect()}
    assert all(r["converged"] and abs(r["gradient"]) < 1e-8 for r in got.values()) and len(got) == 36
    for s in ("enterprise0", "self_serve2"):
        for r in tr.train_logistic(rows.filter(F.col("segment") == s), with_segment=False).collect():
            assert abs(r["coefficient"] - got[s, r["term"]]["coefficient"]) < 1e-4
    one_class = rows.withColumn("churned", F.when(F.col("segment") == "enterprise0", 1).otherwise(F.col("churned")))
    again = {(r["segment"], r["term"]): r for r in tr.train_by_segment(one_class).collect()}
    assert len(again) == 36 and abs(again["self_serve2", "late_payments"]["coefficient"] - got["self_serve2", "late_payments"]["coefficient"]) < 1e-6
    assert tr.train_by_segment(rows.limit(0)).count() == 0


def test_run_log_takes_a_run_once(spark):
    path = tempfile.mkdtemp(prefix="run-log-")
    runs = lambda *v: reg.run_log(spark.createDataFrame([("m", x, 0.5) for x in v], "model string, version string, f1 double"), ["model", "version"], "e")
    assert reg.append_runs(runs("1", "1"), f"{path}/log").count() == 1
    assert reg.append_runs(runs("1", "2"), f"{path}/log").count() == 2
    log = reg.append_runs(runs("2"), f"{path}/log")
    assert sorted(r.version for r in log.collect()) == ["1", "2"] and log.columns[0] == "run_id"
    assert reg.append_runs(runs("1").limit(0), f"{path}/log").count() == 2
    assert reg.append_runs(runs("1").limit(0), f"{path}/empty").count() == 0


def test_model_card_has_every_segment(spark):
    rows = [("m", "1", s, seg, 10, tp, 2) for s, seg, tp in (("train", "a", 5), ("validation", "a", 6), ("validation", "b", 8), ("test", "c", 7), ("test", "a", 4), ("test", "b", 8))]
    conf = spark.createDataFrame(rows, "model string, version string, split string, segment string, rows long, tp long, tn long")
    card = evd.model_card(conf, ["x", "y"]).collect()
    assert len(card) == 1 and card[0].train_rows == 10 and card[0].validation_accuracy == 0.9
    assert card[0].test_segment_accuracy == "a=0.6,b=1.0,c=0.9" and card[0].features == "x,y"


def test_fitted_row_scores_like_its_coefficients(spark):
    train = b.churn_split(spark, SF).filter(F.col("split") == "train")
    fit = tr.train_logistic(train)
    row = tr.model_row(fit, train, "m", "9").collect()[0]
    want = {r.term: round(r.coefficient, 3) for r in fit.collect()}
    assert row.bias == want["intercept"] and row.enterprise_adj == want["enterprise"] and row.w_monthly_spend == want["monthly_spend"]
    assert row.threshold is None and {f"mean_{f}" for f in mdl.FEATURES} <= set(row.asDict())

"""Queries of training (M1-M3, M8-M9), sources / sinks (S1-S5, S7-S11) and access audit."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tollgate.functions.exprs import clipped_sigmoid
from tollgate.functions.hashing import uniform
from tollgate.operators import evaluate as ev
from tollgate.operators import model as mdl
from tollgate.operators import registry as reg
from tollgate.operators import training as tr
from tollgate.plans.catalog import query
from tollgate.plans.lifecycle import _M6_SQL, _M7_SQL, gate_table
from tollgate.plans.sqlviews import _logit_m, rnd, sig, u, with_views
from tollgate.session import checkpoint_root
from tollgate.sources import bindings as b
from tollgate.sources import io as sio
from tollgate.sources.tables import table

FEATS = mdl.FEATURES


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


def _train(spark, sf):
    return b.churn_split(spark, sf).filter(F.col("split") == "train")


# ---- M1 / M2 / M3 -----------------------------------------------------------
def _descent_sql(by: str, indicator: bool, rounds: int, digits: int, gradient: bool) -> str:
    """The fits' twin: plain gradient descent of the same objective, with all groups in one recursion."""
    terms = [*FEATS, *(["enterprise"] if indicator else [])]
    mean_std = ", ".join(f"{rnd(f'avg({f})', 6)} AS m_{f}, {rnd(f'CASE WHEN stddev_pop({f}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({f}) END', 6)} AS s_{f}" for f in FEATS)
    z = ", ".join(f"(t.{f} - m_{f}) / greatest(s_{f}, 1e-9::DOUBLE) AS x{i + 1}" for i, f in enumerate(FEATS))
    if indicator:
        z += f", CAST(t.segment = 'enterprise' AS DOUBLE) AS x{len(terms)}"
    k = range(1, len(terms) + 1)
    logit = "w0 + " + " + ".join(f"w{i} * x{i}" for i in k)
    step = ", ".join([f"any_value(w0) - avg({sig(f'greatest(least({logit}, 35.0::DOUBLE), -35.0::DOUBLE)')} - y)",
                      *[f"any_value(w{i}) - (avg(({sig(f'greatest(least({logit}, 35.0::DOUBLE), -35.0::DOUBLE)')} - y) * x{i}) + {tr.L2!r} * any_value(w{i}))" for i in k]])
    out = " UNION ALL ".join(f"SELECT {by}, '{t}' AS term, {rnd(f'w{i}', digits)} AS coefficient{', 0.0::DOUBLE AS gradient' if gradient else ''} FROM w WHERE it = {rounds}"
                             for i, t in enumerate(["intercept", *terms]))
    return f"""
WITH RECURSIVE tr AS (SELECT *, 1 AS everything FROM churn_split WHERE split = 'train'),
st AS (SELECT {by}, {mean_std} FROM tr GROUP BY {by}),
x AS MATERIALIZED (SELECT t.{by}, CAST(t.churned AS DOUBLE) AS y, {z} FROM tr t JOIN st USING ({by})),
w AS (SELECT {by}, 0 AS it, 0.0::DOUBLE AS w0, {", ".join(f"0.0::DOUBLE AS w{i}" for i in k)} FROM st
      UNION ALL SELECT w.{by}, w.it + 1, {step} FROM w JOIN x USING ({by}) WHERE w.it < {rounds} GROUP BY w.{by}, w.it)
SELECT * EXCLUDE ({by}){f", {by}" if by == "segment" else ""} FROM ({out})"""


@query("train_logistic", with_views(_descent_sql("everything", True, 3000, 3, False), "churn_split"))
def train_logistic(spark, sf):
    """M1: regularised logistic regression on the train split."""
    return tr.train_logistic(_train(spark, sf)).select("term", F.round("coefficient", 3).alias("coefficient"))


def _grad_sql() -> str:
    zs = {f: f"(t.{f} - m.mean_{f}) / greatest(m.std_{f}, 1e-9::DOUBLE)" for f in FEATS}
    logit = "m.bias + " + " + ".join(f"m.w_{f} * {zs[f]}" for f in FEATS) + \
        " + m.enterprise_adj * CAST(t.segment = 'enterprise' AS DOUBLE)"
    err = f"({sig(f'greatest(least({logit}, 35.0::DOUBLE), -35.0::DOUBLE)')} - t.churned)"
    parts = [f"SELECT m.model, m.version, 'intercept' AS term, {rnd(f'avg({err})', 6)} AS gradient"]
    parts += [f"SELECT m.model, m.version, '{f}', {rnd(f'avg({err} * {zs[f]}) + 0.0005 * any_value(m.w_{f})', 6)}"
              for f in FEATS]
    ent = "CAST(t.segment = 'enterprise' AS DOUBLE)"
    parts += [f"SELECT m.model, m.version, 'enterprise', "
              f"{rnd(f'avg({err} * {ent}) + 0.0005 * any_value(m.enterprise_adj)', 6)}"]
    return " UNION ALL ".join(p + " FROM (SELECT * FROM churn_split WHERE split = 'train') t CROSS JOIN models m "
                              "GROUP BY m.model, m.version" for p in parts)


@query("gd_step", with_views(_grad_sql(), "churn_split", "models"))
def gd_step(spark, sf):
    """M2: full-batch gradient of the regularised objective at each registered model's weights."""
    train = _train(spark, sf)
    return tr.gradient(train, mdl.model_table(spark, train))


@query("train_by_segment", with_views(_descent_sql("segment", False, 2000, 4, True), "churn_split"))
def train_by_segment(spark, sf):
    """M3: one logistic model per segment, with the gradient at its weights (zero to six digits)."""
    return tr.train_by_segment(_train(spark, sf)).select("segment", "term", F.round("coefficient", 4).alias("coefficient"),
                                                         F.abs(F.round("gradient", 6)).alias("gradient"))


# ---- M1 -> M6 -> E3 -> M8 -> M7 ----------------------------------------------
CANDIDATE = ("churn-risk", "2026.08.0")


def _candidate_sql() -> str:
    """Fit, threshold, scores and gates of the candidate; the views ``scored`` inside are its own."""
    weight = lambda term: f"max(coefficient) FILTER (WHERE term = '{term}')"
    clipped = f"greatest(least({_logit_m}, 35.0::DOUBLE), -35.0::DOUBLE)"
    return f"""
WITH fitted AS (SELECT '{CANDIDATE[0]}' AS model, '{CANDIDATE[1]}' AS version, {weight("intercept")} AS bias, {weight("enterprise")} AS enterprise_adj,
                       {", ".join(f"{weight(f)} AS w_{f}" for f in FEATS)} FROM ({_descent_sql("everything", True, 3000, 3, False)})),
cand AS MATERIALIZED (SELECT s.*, m.model, m.version, {rnd(sig(clipped), 6)} AS churn_score
                      FROM churn_split s CROSS JOIN (SELECT * FROM fitted CROSS JOIN train_stats) m),
best AS (WITH scored AS (SELECT * FROM cand) {_M6_SQL}),
gates AS (WITH scored AS (SELECT c.*, b.threshold, CAST(c.churn_score >= b.threshold AS INTEGER) AS prediction FROM cand c CROSS JOIN best b),
          {_M7_SQL.strip()[5:]})
SELECT g.*, substr(sha256('churn-risk:' || g.model || ':' || g.version), 1, 32) AS run_id, b.threshold AS decision_threshold, CAST(1 AS BIGINT) AS log_rows
FROM gates g CROSS JOIN best b"""


@query("candidate_release", with_views(_candidate_sql(), "churn_split", "train_stats", "churn_base", "prediction_log"))
def candidate_release(spark, sf):
    """Fit (M1), threshold (M6), append to the run log (E3), score what the log holds (P4, P5), gates (M7).

    The run is appended twice: the second time adds no row (``log_rows``)."""
    rows = b.churn_split(spark, sf)
    train = rows.filter(F.col("split") == "train")
    keep = ["customer_id", "segment", "churned", "split"]
    fit = tr.model_row(tr.train_logistic(train), train, *CANDIDATE)
    found = ev.threshold_search(mdl.score(rows.filter(F.col("split") == "validation"), fit, keep=keep), spark)
    run = reg.run_log(fit.drop("threshold").join(found.select("model", "version", "threshold"), ["model", "version"]), ["model", "version"], "churn-risk")
    path = _scratch(spark, "run_log")
    reg.append_runs(run, path)
    log = reg.append_runs(run, path)
    gates = gate_table(spark, sf, mdl.score(rows, log.drop("run_id", "experiment_name"), keep=keep))
    runs = log.select("model", "version", "run_id", F.col("threshold").alias("decision_threshold")).crossJoin(log.agg(F.count("*").alias("log_rows")))
    return gates.join(runs, ["model", "version"])


# ---- M8 / M9 ----------------------------------------------------------------
@query("batch_score", with_views(
    "SELECT customer_id, version, churn_score, prediction, split FROM scored WHERE version = '2026.07.0'", "scored"))
def batch_score(spark, sf):
    """M8: champion scores of the whole table, written partitioned by split (dynamic overwrite)."""
    from tollgate.plans.lifecycle import _scored
    s = _scored(spark, sf).filter(F.col("version") == "2026.07.0") \
        .select("customer_id", "version", "churn_score", "prediction", "split")
    return tr.batch_score(s, _scratch(spark, "batch_scores"))


@query("shadow_compare", with_views(
    f"SELECT a.segment, count(*) AS rows, count(*) FILTER (WHERE a.prediction <> b.prediction) AS label_flips, "
    f"{rnd('avg(b.churn_score - a.churn_score)', 6)} AS mean_score_delta FROM scored a JOIN scored b "
    "ON a.customer_id = b.customer_id AND a.version = '2026.07.0' AND b.version = '2026.07.1' GROUP BY a.segment",
    "scored"))
def shadow_compare(spark, sf):
    rows = b.churn_split(spark, sf)
    models = mdl.model_table(spark, rows.filter(F.col("split") == "train"))
    return tr.shadow_compare(rows, tr.models_by_role(models, "champion"), tr.models_by_role(models, "challenger"))


# ---- S1 / S2 ----------------------------------------------------------------
CHURN_COLS = ["customer_id", "segment", *FEATS, "churned"]


@query("scan_csv", with_views(f"SELECT {', '.join(CHURN_COLS)} FROM churn_base", "churn_base"))
def scan_csv(spark, sf):
    """Churn rows written as header CSV, read back as text and cast (try_cast) to their types."""
    path = _scratch(spark, "churn_csv")
    sio.write_csv(b.churn_base(spark, sf).select(*CHURN_COLS), path)
    raw = sio.read_csv(spark, path, CHURN_COLS)
    ints = {"tenure_months", "support_tickets", "late_payments", "churned"}
    return raw.select("customer_id", "segment", *[F.col(c).try_cast("int" if c in ints else "double").alias(c)
                                                  for c in [*FEATS, "churned"]])


@query("sink_csv", with_views(
    f"SELECT '{','.join(sorted(CHURN_COLS))}' AS header, count(*) AS rows FROM churn_base", "churn_base"))
def sink_csv(spark, sf):
    """Header is the sorted column union; row count survives the round trip (empty -> empty)."""
    path = _scratch(spark, "churn_csv_sink")
    sio.write_csv(b.churn_base(spark, sf).select(*CHURN_COLS), path)
    back = spark.read.option("header", True).csv(path)
    return back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(",".join(back.columns)).alias("header"), "rows")


# ---- S3 / S4 / S5 -----------------------------------------------------------
LOG_SCHEMA = StructType([
    StructField("request_id", LongType()), StructField("service", StringType()),
    StructField("model_version", StringType()), StructField("status", StringType()),
    StructField("features", StructType([StructField("latency_ms", DoubleType()),
                                        StructField("churn_score", DoubleType())])),
])


def _log_json(spark, sf):
    p = b.prediction_log(spark, sf)
    return p.select("request_id", "service", "model_version", "status",
                    F.struct("latency_ms", "churn_score").alias("features"))


@query("scan_jsonl", with_views(
    "SELECT request_id, service, model_version, status, latency_ms, churn_score FROM prediction_log", "prediction_log"))
def scan_jsonl(spark, sf):
    """S3: prediction log as JSON lines with a nested struct, read back with a declared schema."""
    path = _scratch(spark, "log_jsonl")
    sio.write_jsonl(_log_json(spark, sf), path)
    r = sio.read_jsonl(spark, path, LOG_SCHEMA)
    return r.select("request_id", "service", "model_version", "status", "features.latency_ms", "features.churn_score")


@query("sink_jsonl_append", with_views(
    "SELECT request_id, CAST(2 AS BIGINT) AS copies FROM prediction_log", "prediction_log"))
def sink_jsonl_append(spark, sf):
    """Two appends of the same log -> every request twice."""
    path = _scratch(spark, "log_append")
    log = _log_json(spark, sf)
    sio.write_jsonl(log, path)
    sio.write_jsonl(log, path, append=True)
    return sio.read_jsonl(spark, path, LOG_SCHEMA).groupBy("request_id").agg(F.count(F.lit(1)).alias("copies"))


REPORT_SCHEMA = StructType([
    StructField("service", StringType()),
    StructField("latency_ms", StructType([StructField("p95", DoubleType())])),
    StructField("throughput", StructType([StructField("prediction_count", LongType())])),
])


@query("json_docs", with_views(
    f"SELECT service, {rnd('list_sort(list(latency_ms))[least(CAST(round_even((count(*) - 1) * 0.95, 0) AS BIGINT), count(*) - 1) + 1]', 4)} "
    "AS p95, count(*) AS prediction_count FROM prediction_log GROUP BY service", "prediction_log"))
def json_docs(spark, sf):
    """Per-service monitoring reports as nested JSON documents, written and read back."""
    from tollgate.operators.monitoring import latency_percentiles
    rep = latency_percentiles(b.prediction_log(spark, sf))
    docs = rep.select(sio.to_json_doc(F.col("service"), F.struct("p95").alias("latency_ms"),
                                      F.struct(F.col("samples").alias("prediction_count")).alias("throughput"))
                      .alias("value"))
    path = _scratch(spark, "report_docs")
    docs.write.text(path)
    r = sio.read_jsonl(spark, path, REPORT_SCHEMA)
    return r.select("service", F.col("latency_ms.p95").alias("p95"), F.col("throughput.prediction_count")
                    .alias("prediction_count"))


# ---- S7 ---------------------------------------------------------------------
def _gauss_spark(key, s1: str, s2: str):
    u1 = (uniform(key, s1) * 4294967296.0 + 0.5) / 4294967296.0
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * 3.141592653589793 * uniform(key, s2))


def _gauss_sql(key: str, s1: str, s2: str) -> str:
    u1 = f"(({u(key, s1)}) * 4294967296.0::DOUBLE + 0.5) / 4294967296.0::DOUBLE"
    return f"(sqrt(-2.0 * ln({u1})) * cos(2.0 * 3.141592653589793 * {u(key, s2)}))"


@query("churn_generate", f"""
SELECT customer_id, segment, tenure_months, monthly_spend, support_tickets, late_payments, usage_drop_pct,
       CAST({u('c_custkey', 'label')} < {sig('logit')} AS INTEGER) AS churned FROM (
  SELECT *, -1.8 - 0.025 * tenure_months + 0.24 * support_tickets + 0.70 * late_payments + 4.8 * usage_drop_pct
            - CASE WHEN segment = 'enterprise' THEN 0.35 ELSE 0 END + 0.25 * {_gauss_sql('c_custkey', 'n1', 'n2')} AS logit
  FROM (
    SELECT c_custkey, printf('cust_%05d', c_custkey) AS customer_id, segment,
           CAST(greatest(1, trunc(CASE WHEN segment = 'enterprise' THEN 30 ELSE 18 END + 10 * {_gauss_sql('c_custkey', 't1', 't2')})) AS INTEGER) AS tenure_months,
           {rnd(f"greatest(20, CASE WHEN segment = 'enterprise' THEN 420 ELSE 95 END + 55 * {_gauss_sql('c_custkey', 's1', 's2')})", 2)} AS monthly_spend,
           CAST(greatest(0, trunc(CASE WHEN segment = 'enterprise' THEN 2.2 ELSE 4.2 END + 1.6 * {_gauss_sql('c_custkey', 'k1', 'k2')})) AS INTEGER) AS support_tickets,
           CAST(greatest(0, trunc(CASE WHEN segment = 'enterprise' THEN 0.7 ELSE 1.8 END + 1.1 * {_gauss_sql('c_custkey', 'l1', 'l2')})) AS INTEGER) AS late_payments,
           {rnd(f"least(greatest(0.18 + 0.18 * {_gauss_sql('c_custkey', 'u1', 'u2')}, 0), 0.9)", 4)} AS usage_drop_pct
    FROM (SELECT c_custkey, CASE WHEN {u('c_custkey', 'seg')} < 0.32 THEN 'enterprise' ELSE 'self_serve' END AS segment
          FROM customer)))""")
def churn_generate(spark, sf):
    """Synthetic churn rows, one per customer key, from key-hashed uniforms (Box-Muller
    gaussians): same distribution as the reference generator, stable under repartitioning."""
    c = table(spark, sf, "customer").select("c_custkey")
    k = "c_custkey"
    ent = uniform(k, "seg") < 0.32
    seg = F.when(ent, "enterprise").otherwise("self_serve")
    pick = lambda a, b_: F.when(ent, F.lit(a)).otherwise(F.lit(b_))
    d = c.select(k, F.format_string("cust_%05d", F.col(k)).alias("customer_id"), seg.alias("segment"),
                 F.greatest(F.lit(1), (pick(30.0, 18.0) + 10 * _gauss_spark(k, "t1", "t2")).cast("int")).alias("tenure_months"),
                 F.round(F.greatest(F.lit(20.0), pick(420.0, 95.0) + 55 * _gauss_spark(k, "s1", "s2")), 2).alias("monthly_spend"),
                 F.greatest(F.lit(0), (pick(2.2, 4.2) + 1.6 * _gauss_spark(k, "k1", "k2")).cast("int")).alias("support_tickets"),
                 F.greatest(F.lit(0), (pick(0.7, 1.8) + 1.1 * _gauss_spark(k, "l1", "l2")).cast("int")).alias("late_payments"),
                 F.round(F.least(F.greatest(0.18 + 0.18 * _gauss_spark(k, "u1", "u2"), F.lit(0.0)), F.lit(0.9)), 4)
                 .alias("usage_drop_pct"))
    logit = (-1.8 - 0.025 * F.col("tenure_months") + 0.24 * F.col("support_tickets") + 0.70 * F.col("late_payments")
             + 4.8 * F.col("usage_drop_pct") - F.when(F.col("segment") == "enterprise", 0.35).otherwise(0.0)
             + 0.25 * _gauss_spark(k, "n1", "n2"))
    return d.withColumn("churned", (uniform(k, "label") < clipped_sigmoid(logit)).cast("int")).drop(k)


# ---- S8 / S9 / S10 / S11 ----------------------------------------------------
def _docs_folder(spark, sf):
    path = _scratch(spark, "corpus")
    docs = table(spark, sf, "documents").select("source", "text")
    docs.write.partitionBy("source").text(path)
    return path


@query("file_manifest")
def file_manifest(spark, sf):
    """Manifest (relative path, sha256, bytes) of the corpus files written from ``documents``."""
    return sio.file_manifest(spark, _docs_folder(spark, sf), glob="*.txt")


@query("checksum_lines", """
SELECT sha256(text) || '  documents/' || CAST(doc_id AS VARCHAR) AS value FROM documents""")
def checksum_lines(spark, sf):
    """S9: '<sha>  <path>' lines, written as text and read back."""
    d = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"),
                                             F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path"))
    path = _scratch(spark, "checksums")
    sio.checksum_lines(d).write.text(path)
    return spark.read.text(path)


@query("corpus_text_scan", """
SELECT source, CAST(sum(length(text) + 1) AS BIGINT) AS total_chars,
       CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS total_lines
FROM documents GROUP BY source""")
def corpus_text_scan(spark, sf):
    """Block-wise read of the corpus folder (recursive, glob-filtered), totals per source folder."""
    files = sio.corpus_text_scan(spark, _docs_folder(spark, sf))
    src = F.regexp_extract("path", r"source=([^/]+)/", 1)
    return files.groupBy(src.alias("source")).agg(
        F.sum(F.length("text")).cast("long").alias("total_chars"),
        F.sum(F.length("text") - F.length(F.regexp_replace("text", "\n", ""))).cast("long").alias("total_lines"))


KEEP_HOSTS = r"https?://(?:blog|m)\.[a-z]+\.example\.(?:com|net|org)/.*"


@query("scrape_keep_filter", f"""
SELECT page_id, url FROM pages WHERE regexp_full_match(url, '{KEEP_HOSTS}')""")
def scrape_keep_filter(spark, sf):
    """Keep targets whose label fully matches the regex (blog and mobile hosts)."""
    return sio.keep_matching(table(spark, sf, "pages").select("page_id", "url"), "url", KEEP_HOSTS)


# ---- C19 --------------------------------------------------------------------
# Access policy (token TTL <= 3600 s, refresh <= 30 min, forbidden verbs).
MAX_TTL_S, MAX_REFRESH_MIN = 3600, 30
FORBIDDEN_VERBS = ["escalate", "impersonate", "bind"]


def _identities(spark, sf):
    """One service identity per order with nested arrays built from that order's own columns."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    verb = (F.when(F.col("o_orderstatus") == "F", "rbac:watch").when(F.col("o_orderstatus") == "O", "rbac:impersonate")
             .otherwise("rbac:escalate"))
    tokens = F.array(F.struct((F.col("o_totalprice") / 100).cast("int").alias("ttl_s"),
                              (F.col("o_totalprice") / 10000).cast("int").alias("refresh_min")),
                     F.struct(F.lit(900).alias("ttl_s"), F.lit(15).alias("refresh_min")))
    secrets = F.array(F.struct(F.when(F.col("o_orderpriority") == "5-LOW", "static").otherwise("external").alias("kind")))
    return o.select("o_orderkey", "o_custkey", tokens.alias("tokens"), secrets.alias("secrets"),
                    F.array(F.lit("rbac:get"), F.lit("rbac:list"), verb).alias("verbs"))


@query("access_audit", f"""
WITH i AS (
  SELECT o_custkey, CAST(trunc(o_totalprice / 100) AS INTEGER) <= {MAX_TTL_S} AND 900 <= {MAX_TTL_S} AS ttl_ok,
         CAST(trunc(o_totalprice / 10000) AS INTEGER) <= {MAX_REFRESH_MIN} AND 15 <= {MAX_REFRESH_MIN} AS refresh_ok,
         o_orderpriority <> '5-LOW' AS no_static,
         o_orderstatus = 'F' AS verbs_ok FROM orders)
SELECT o_custkey, count(*) AS identities, count(*) FILTER (WHERE NOT ttl_ok) AS ttl_violations,
       count(*) FILTER (WHERE NOT refresh_ok) AS refresh_violations, count(*) FILTER (WHERE NOT no_static) AS static_credentials,
       count(*) FILTER (WHERE NOT verbs_ok) AS forbidden_verbs,
       bool_and(ttl_ok AND refresh_ok AND no_static AND verbs_ok) AS passed
FROM i GROUP BY o_custkey""")
def access_audit(spark, sf):
    """Nested-array checks per identity with higher-order functions (forall / exists /
    array_intersect), rolled up per owner with a partial aggregate."""
    ids = _identities(spark, sf)
    short = F.transform("verbs", lambda v: F.substring_index(v, ":", -1))
    checks = ids.select(
        "o_custkey",
        F.forall("tokens", lambda t: t["ttl_s"] <= MAX_TTL_S).alias("ttl_ok"),
        F.forall("tokens", lambda t: t["refresh_min"] <= MAX_REFRESH_MIN).alias("refresh_ok"),
        (~F.exists("secrets", lambda s: s["kind"] == "static")).alias("no_static"),
        (F.size(F.array_intersect(short, F.array(*[F.lit(v) for v in FORBIDDEN_VERBS]))) == 0).alias("verbs_ok"))
    ok = F.col("ttl_ok") & F.col("refresh_ok") & F.col("no_static") & F.col("verbs_ok")
    return checks.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("identities"), F.count_if(~F.col("ttl_ok")).alias("ttl_violations"),
        F.count_if(~F.col("refresh_ok")).alias("refresh_violations"),
        F.count_if(~F.col("no_static")).alias("static_credentials"),
        F.count_if(~F.col("verbs_ok")).alias("forbidden_verbs"), F.bool_and(ok).alias("passed"))

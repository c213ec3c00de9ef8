"""Scoring, classification, claims, status and review over the driver's tables: the operators' mechanics, not data sheets."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import review, rules
from .registry import query, table

# Three rules over the invented prose: (curve_type, source, axis, keyword, weight).
RULES = (
    ("alpha", "caption", None, "the th", 3.0), ("alpha", "axis", "x", "ation", 2.5), ("alpha", "phrase", None, "heen", 2.0), ("alpha", "phrase", None, "license", -3.0),
    ("beta", "caption", None, "ment", 3.0), ("beta", "axis", "y", "eau", 2.5), ("beta", "phrase", None, "que", 2.0), ("beta", "phrase", None, "the ", -3.0),
    ("gamma", "caption", None, "ung", 3.0), ("gamma", "axis", "x", "sch", 2.5), ("gamma", "phrase", None, "heit", 2.0), ("gamma", "phrase", None, "que", -3.0),
)


def _scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", "text", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(z).cast("string").alias("zone")) for s, z in (("caption", None), ("axis", None), ("axis", "x"), ("phrase", None))])).alias("x"))
    made = spark.createDataFrame(list(RULES), "curve_type string, source string, axis string, keyword string, weight double")
    return rules.score(lines.select("doc_id", "x.source", "x.zone", "text"), made, ["doc_id"], docs.select("doc_id"))


_SCORES = (
    "r AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{s}', {'NULL' if a is None else repr(a)}, '{k}', {w})" for c, s, a, k, w in RULES) + ") t(curve_type, source, axis, keyword, weight)),\n"
    "h AS (SELECT doc_id, curve_type, keyword, CASE WHEN r.source = 'axis' THEN CASE WHEN axis = 'x' THEN 2.5 ELSE 1.0 END ELSE weight END AS w FROM documents JOIN r ON contains(lower(text), keyword)),\n"
    "s AS (SELECT d.doc_id, c.curve_type, CAST(coalesce(sum(h.w), 0) AS DOUBLE) AS score FROM documents d CROSS JOIN (SELECT DISTINCT curve_type FROM r) c LEFT JOIN h ON h.doc_id = d.doc_id AND h.curve_type = c.curve_type GROUP BY ALL)"
)
_TOP = _SCORES + (
    ",\no AS (SELECT *, row_number() OVER w AS rn, lead(score, 1, 0.0) OVER w AS runner_up FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, curve_type)),\n"
    "c AS (SELECT doc_id, curve_type, score, runner_up, score - runner_up AS margin, CASE WHEN score <= 0 THEN 'no_match' WHEN score >= 5 AND score - runner_up >= 2 THEN 'matched' ELSE 'quarantined' END AS status FROM o WHERE rn = 1)"
)
query("rule_score_documents", f"WITH {_SCORES} SELECT doc_id, curve_type, score FROM s")(_scores)


@query("rule_classify_top1_margin", f"WITH {_TOP} SELECT * FROM c")
def classify_documents(spark, sf_dir):
    return rules.classify(_scores(spark, sf_dir), ["doc_id"], "curve_type")


@query("rule_classify_group_best", f"WITH {_TOP}, g AS (SELECT source AS device, c.*, row_number() OVER (PARTITION BY source ORDER BY score DESC, CASE WHEN status = 'matched' THEN 0 ELSE 1 END, doc_id) AS rn FROM c JOIN documents USING (doc_id) WHERE status <> 'no_match') SELECT device, doc_id, curve_type, score, status FROM g WHERE rn = 1")
def classify_groups(spark, sf_dir):
    """Sources stand for devices, documents for figures."""
    found = rules.classify(_scores(spark, sf_dir), ["doc_id"], "curve_type").join(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("device")), "doc_id")
    return rules.best_of_group(found, ["device"], ["doc_id"]).select("device", "doc_id", "curve_type", "score", "status")


@query("claims_anti_join", f"WITH {_TOP} SELECT doc_id, curve_type, score FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = s.doc_id AND c.status = 'matched')")
def claims(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    return rules.unclaimed(scores, rules.classify(scores, ["doc_id"], "curve_type").where("status = 'matched'"), ["doc_id"]).select("doc_id", "curve_type", "score")


def _claim_sql() -> str:
    parts, before = [_SCORES], []
    for t in ("alpha", "beta", "gamma"):
        gone = " AND ".join(["TRUE", *[f"NOT EXISTS (SELECT 1 FROM c_{b} x WHERE x.status = 'matched' AND x.device = d.source AND x.doc_id = s.doc_id)" for b in before]])
        parts.append(f"o_{t} AS (SELECT d.source AS device, s.doc_id, s.curve_type, s.score, row_number() OVER w AS rn, lead(score, 1, 0.0) OVER w AS runner_up FROM s JOIN documents d USING (doc_id) WHERE s.curve_type = '{t}' AND {gone} WINDOW w AS (PARTITION BY d.source ORDER BY score DESC, s.doc_id))")
        parts.append(f"c_{t} AS (SELECT device, doc_id, curve_type, score, score - runner_up AS margin, CASE WHEN score <= 0 THEN 'no_match' WHEN score >= 5 AND score - runner_up >= 2 THEN 'matched' ELSE 'quarantined' END AS status FROM o_{t} WHERE rn = 1)")
        before.append(t)
    return "WITH " + ",\n".join(parts) + " " + " UNION ALL ".join(f"SELECT * FROM c_{t}" for t in before)


@query("claims_in_turn", _claim_sql())
def claims_in_turn(spark, sf_dir):
    """Mutual exclusion across curve types, in the order given."""
    scores = _scores(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("device")), "doc_id")
    return rules.claim_in_turn(scores, ["alpha", "beta", "gamma"], "device", "doc_id").select("device", "doc_id", "curve_type", "score", "margin", "status")


@query("status_counts_zero_fill", "SELECT v.s AS o_orderstatus, count(o.o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X'), ('Y'), ('Z')) v(s) LEFT JOIN orders o ON o.o_orderstatus = v.s GROUP BY v.s")
def status_counts(spark, sf_dir):
    return review.zero_filled(table(spark, sf_dir, "orders"), "o_orderstatus", ("F", "O", "P", "X", "Y", "Z"))


_LADDER = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'failed_classification' WHEN c_custkey IS NULL OR c_acctbal < 0 THEN 'failed_extraction'
  WHEN c_mktsegment = 'BUILDING' THEN 'rejected' WHEN c_mktsegment = 'MACHINERY' THEN CASE WHEN o_totalprice < 100000 THEN 'finalized' ELSE 'needs_review' END
  WHEN o_orderpriority LIKE '1%' THEN 'needs_review' ELSE 'pending_review' END AS status FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def _ladder(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.withColumn(
        "status",
        review.status(
            F.when(F.col("o_orderstatus") != "P", "matched"),
            F.when(F.col("c_custkey").isNull() | (F.col("c_acctbal") < 0), "failed").when(F.col("o_orderpriority").startswith("1"), "needs_review").otherwise("ok"),
            F.when(F.col("c_mktsegment") == "BUILDING", "reject").when(F.col("c_mktsegment") == "MACHINERY", "approve"),
            F.when(F.col("o_totalprice") >= 100000, "too large"),
        ),
    )


@query("status_ladder", _LADDER)
def status_ladder(spark, sf_dir):
    return _ladder(spark, sf_dir).select("o_orderkey", "status")


@query("followup_queue", f"SELECT CAST(o_orderkey AS VARCHAR) AS device, o_orderpriority AS curve_type, status, o_orderstatus AS reason FROM ({_LADDER}) JOIN orders USING (o_orderkey) WHERE status IN ('needs_review', 'pending_review', 'failed_classification', 'failed_extraction')")
def followup_queue(spark, sf_dir):
    return review.queue(_ladder(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("device"), F.col("o_orderpriority").alias("curve_type"), "status", F.col("o_orderstatus").alias("reason")))


@query("review_latest_wins", "SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_wins(spark, sf_dir):
    return review.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "ts")


@query("bucket_min_confidence", "SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'needs_review' WHEN min(1 - l_discount * 4) < 0.7 THEN 'low_confidence' ELSE 'confident' END AS bucket, round(min(1 - l_discount * 4), 6) AS confidence FROM lineitem GROUP BY l_orderkey")
def buckets(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"), F.min(1 - F.col("l_discount") * 4).alias("c"))
    return g.select("l_orderkey", review.bucket(F.when(F.col("r") == 1, "needs_review").otherwise("ok"), F.col("c")).alias("bucket"), F.round("c", 6).alias("confidence"))


@query("sample_cap_bucket", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) AS rn FROM documents) WHERE rn <= 20")
def sample_cap(spark, sf_dir):
    """The cap is the feature: a reproducible sample of each bucket for review."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return review.sample(docs, F.col("lang"), [F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("-42")).cast("binary")), F.col("doc_id")], 20)


@query("stratified_round_robin", "SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS turn FROM part) ORDER BY turn, md5(p_brand), p_partkey LIMIT 60")
def stratified(spark, sf_dir):
    h = F.md5(F.col("p_partkey").cast("string").cast("binary"))
    return review.round_robin(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_brand"], [h, F.col("p_partkey")], [F.md5(F.col("p_brand").cast("binary")), F.col("p_partkey")], 60).select("p_partkey", "p_brand")


@query("recall_by_label", "SELECT lang, toxic, count(*) AS total, CAST(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS matched, round(avg(CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END), 6) AS recall FROM labels JOIN documents USING (doc_id) GROUP BY lang, toxic")
def recall_by_label(spark, sf_dir):
    from ..operators.metrics import recall

    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").withColumn("matched", F.col("n_chars") > 1000)
    return recall(rows, ["lang", "toxic"], "matched").withColumn("recall", F.round("recall", 6))


@query("theta_exists_recall", "SELECT event_type, count(*) AS total, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS matched FROM (SELECT g.event_type, EXISTS (SELECT 1 FROM events p WHERE p.user_id = g.user_id AND p.event_id <> g.event_id AND p.value >= 0.5 AND abs(p.value - g.value) <= 5) AS hit FROM events g) GROUP BY event_type")
def theta_recall(spark, sf_dir):
    """A label counts as found if any prediction of its image is sure and near enough; predictions aren't used up."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    p = e.where("value >= 0.5").select(F.col("user_id").alias("u"), F.col("event_id").alias("i"), F.col("value").alias("v"))
    hit = e.join(p, (F.col("user_id") == F.col("u")) & (F.col("event_id") != F.col("i")) & (F.abs(F.col("v") - F.col("value")) <= 5), "left_semi").select("event_id", F.lit(1).alias("hit"))
    return e.join(hit, "event_id", "left").groupBy("event_type").agg(F.count("*").alias("total"), F.sum(F.coalesce("hit", F.lit(0))).cast("long").alias("matched"))


@query("minmax_weighted_pick", """
WITH n AS (SELECT p_brand, p_partkey, CASE WHEN max(p_size) OVER w - min(p_size) OVER w <= 1e-6 THEN 1.0 ELSE (p_size - min(p_size) OVER w) / CAST(max(p_size) OVER w - min(p_size) OVER w AS DOUBLE) END AS a,
  CASE WHEN max(p_retailprice) OVER w - min(p_retailprice) OVER w <= 1e-6 THEN 1.0 ELSE (p_retailprice - min(p_retailprice) OVER w) / (max(p_retailprice) OVER w - min(p_retailprice) OVER w) END AS b FROM part WINDOW w AS (PARTITION BY p_brand)),
s AS (SELECT *, round(0.45 * a + 0.25 * b, 9) AS score FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS rn FROM s)
SELECT p_brand, p_partkey, score FROM r WHERE rn = 1""")
def weighted_pick(spark, sf_dir):
    w = W.partitionBy("p_brand")

    def norm(c):
        low, high = F.min(c).over(w), F.max(c).over(w)
        return F.when(high - low <= 1e-6, 1.0).otherwise(F.try_divide((F.col(c) - low).cast("double"), (high - low).cast("double")))

    s = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.round(0.45 * norm("p_size") + 0.25 * norm("p_retailprice"), 9).alias("score"))
    return review.latest(s, ["p_brand"], [F.desc("score"), F.asc("p_partkey")])

"""Classifier of events: features, training, calibration, abstention, evaluation."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import cyclic

# Ports that count as web or as remote administration
WEB_PORTS = [80, 443, 8080, 8443, 8000, 8008, 8888]
ADMIN_PORTS = [22, 23, 3389, 445, 135, 139, 5900, 5985, 5986]
DENIED = ["deny", "drop", "block", "reset"]
ABSTAIN = 0.60
NAMES = (
    "src_port_norm src_port_privileged src_port_registered src_port_dynamic dst_port_norm dst_port_privileged dst_port_web dst_port_admin proto_tcp proto_udp proto_icmp proto_other "
    "severity_norm action_denied action_allowed hour_sin hour_cos weekday_sin weekday_cos is_weekend is_src_private threat_intel_score has_mitre_tag user_agent_len_log1p"
).split()


def feature_columns(names: set[str] | None = None) -> dict[str, Column]:
    """24 features of a canonical event; what is missing counts as 0. ``names``:
    the event's columns, if it may lack some."""
    has = lambda n: names is None or n in names
    c = lambda n, t="string": F.col(n) if has(n) else F.lit(None).cast(t)
    one = lambda cond: F.coalesce(cond, F.lit(False)).cast("double")
    sp, dp = (F.when(c(n, "int").between(0, 65535), c(n, "int")) for n in ("src_port", "dst_port"))
    proto = F.trim(F.lower(F.coalesce(c("protocol"), F.lit(""))))
    ts = F.coalesce(c("timestamp_utc", "timestamp"), c("ingest_timestamp", "timestamp"))
    score = F.when(c("threat_intel_score", "double").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c("threat_intel_score", "double")))).otherwise(one(c("is_malicious", "boolean")))
    ua = F.length(F.coalesce(c("user_agent"), F.lit("")))
    values = [
        F.coalesce(sp / 65535.0, F.lit(0.0)), one(sp <= 1023), one(sp.between(1024, 49151)), one(sp >= 49152),
        F.coalesce(dp / 65535.0, F.lit(0.0)), one(dp <= 1023), one(dp.isin(*WEB_PORTS)), one(dp.isin(*ADMIN_PORTS)),
        one(proto == "tcp"), one(proto == "udp"), one(proto == "icmp"), one(~proto.isin("tcp", "udp", "icmp", "")),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c("severity", "int"), F.lit(0)) / 10.0)), one(c("event_action").isin(*DENIED)), one(c("event_action") == "allow"),
        *[F.coalesce(v.cast("double"), F.lit(0.0)) for v in cyclic(ts).values()],
        one(c("is_src_private", "boolean")), score, one(F.coalesce(c("mitre_technique_id"), F.lit("")) != ""), F.when(ua > 0, F.log1p(ua.cast("double"))).otherwise(0.0),
    ]
    return dict(zip(NAMES, values))


def featured(df: DataFrame) -> DataFrame:
    return df.withColumns({f"f_{k}": v for k, v in feature_columns(set(df.columns)).items()})


def stratified(df: DataFrame, label: str = "y", key: str = "ordinal", seed: int = 42) -> DataFrame:
    """``part`` train, validation or test: 70, 15 and 15 % of each label, by the
    rank of a seeded hash (exact up to a row; no rank is over the whole table)."""
    from pyspark.sql import Window

    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 20))
    cell = F.floor(h / (1 << 12))
    df = df.withColumns({"__h": h, "__cell": cell})
    per = df.groupBy(label, "__cell").agg(F.count(F.lit(1)).alias("__c"))  # labels × 256 rows
    w = Window.partitionBy(label)
    base = per.select(label, "__cell", F.coalesce(F.sum("__c").over(w.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"), F.sum("__c").over(w).alias("__n"))
    rank = F.col("__b") + F.row_number().over(Window.partitionBy(label, "__cell").orderBy("__h", key)) - 1
    out = df.join(F.broadcast(base), [label, "__cell"]).withColumn("__r", rank)
    part = F.when(F.col("__r") < F.floor(F.col("__n") * 0.7), "train").when(F.col("__r") < F.floor(F.col("__n") * 0.85), "validation").otherwise("test")
    return out.withColumn("part", part).drop("__h", "__cell", "__b", "__n", "__r")


@dataclass
class Classifier:
    """A scaler and base model, and a sigmoid of the base score for calibration."""

    base: PipelineModel
    sigmoid: LogisticRegressionModel | None
    threshold: float = ABSTAIN

    def probability(self, df: DataFrame) -> DataFrame:
        """Adds ``p_attack``."""
        out = self.base.transform(featured(df))
        raw = vector_to_array("probability")[1]
        if self.sigmoid is not None:
            w, b = float(self.sigmoid.coefficients[0]), float(self.sigmoid.intercept)
            raw = 1 / (1 + F.exp(-(raw * w + b)))
        return out.withColumn("p_attack", raw).drop(*[f"f_{n}" for n in NAMES], "features", "scaled", "rawPrediction", "probability", "prediction")

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``label`` (attack, benign or uncertain) and ``confidence``."""
        p = self.probability(df)
        return p.withColumns(decision(F.col("p_attack"), self.threshold))

    def annotate(self, df: DataFrame) -> DataFrame:
        """Overwrites weak_label and label_confidence, those from threat lists too."""
        out = self.predict(df)
        return out.withColumns({"weak_label": F.col("label"), "label_confidence": F.col("confidence")}).select(*df.columns)

    def save(self, path: str) -> None:
        self.base.write().overwrite().save(f"{path}/base")
        if self.sigmoid is not None:
            self.sigmoid.write().overwrite().save(f"{path}/sigmoid")

    @classmethod
    def load(cls, path: str, calibrated: bool = True) -> "Classifier":
        return cls(PipelineModel.load(f"{path}/base"), LogisticRegressionModel.load(f"{path}/sigmoid") if calibrated else None)


def decision(p: Column, threshold: float = ABSTAIN) -> dict[str, Column]:
    """Label and confidence of an attack probability; a tie is an attack."""
    conf = F.greatest(p, 1 - p)
    return {"label": F.when(conf < threshold, "uncertain").when(p >= 0.5, "attack").otherwise("benign"), "confidence": F.round(conf, 4)}


def balanced(df: DataFrame, label: str = "y") -> DataFrame:
    """``weight``: rows over classes times the class's rows (two rows are joined)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = per.agg(F.sum("__n").alias("__t"), F.count(F.lit(1)).alias("__k"))
    w = per.crossJoin(F.broadcast(total)).select(label, (F.col("__t") / (F.col("__k") * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(w), label)


def train(df: DataFrame, kind: str = "rf", label: str = "y", seed: int = 42, calibrate: bool = True, trees: int = 100, depth: int = 12) -> tuple[Classifier, dict]:
    """A classifier of events with a 0/1 label, and its metrics on the test part. The
    regression's penalty is that of C = 1: one over the sum of the weights, which is
    the number of training rows."""
    from pyspark.ml import Pipeline

    parts = featured(stratified(df, label, seed=seed))
    cols = [f"f_{n}" for n in NAMES]
    if kind == "lr":
        model = LogisticRegression(featuresCol="scaled", labelCol=label, weightCol="weight", maxIter=1000, regParam=1.0 / max(1, parts.where("part = 'train'").count()))
    else:
        model = RandomForestClassifier(featuresCol="scaled", labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True), model])
    base = pipe.fit(balanced(parts.where("part = 'train'"), label))
    clf = Classifier(base, None)
    if calibrate:
        scored = clf.probability(parts.where("part = 'validation'").drop(*cols)).select(F.col(label).cast("double").alias("label"), "p_attack")
        vec = VectorAssembler(inputCols=["p_attack"], outputCol="features").transform(scored)
        clf.sigmoid = LogisticRegression(maxIter=200).fit(vec)
    test = clf.predict(parts.where("part = 'test'").drop(*cols))
    return clf, metrics(test, label).first().asDict()


def metrics(df: DataFrame, label: str = "y", p: str = "p_attack") -> DataFrame:
    """One row of metrics from ``label``, ``p_attack`` and the predicted ``label``.

    An abstention counts by its probability. ROC-AUC is the rank statistic with
    ties averaged, from counts by rounded probability (at most 10^4+1 of them).
    """
    from pyspark.sql import Window

    y, uncertain = F.col(label).cast("int"), F.col("label") == "uncertain"
    pred = F.when(uncertain, (F.col(p) >= 0.5).cast("int")).otherwise((F.col("label") == "attack").cast("int"))
    base = df.select(y.alias("y"), pred.alias("d"), F.col(p).alias("p"), uncertain.alias("u"))
    n = lambda a, b: F.count_if((F.col("y") == a) & (F.col("d") == b))
    one = base.agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(0, 0).alias("tn"), n(1, 0).alias("fn"), F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier_score"), F.avg(F.col("u").cast("double")).alias("abstention_rate"))
    steps = base.groupBy(F.round("p", 4).alias("p")).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    auc = steps.select("pos", "neg", below.alias("below")).agg((F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    zero = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    precision, recall = zero(tp, tp + fp), zero(tp, tp + fn)
    return one.crossJoin(F.broadcast(auc)).select(
        "tp", "fp", "tn", "fn", ((tp + tn) / (tp + fp + tn + fn)).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), zero(2 * precision * recall, precision + recall).alias("f1"),
        ((recall + zero(tn, tn + fp)) / 2).alias("balanced_accuracy"), zero(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"), "roc_auc", "brier_score", "abstention_rate")


def static_rule() -> Column:
    """Baseline: a threat score above one half or a severity of at least 4."""
    return F.coalesce(F.col("threat_intel_score") > 0.5, F.lit(False)) | F.coalesce(F.col("severity") >= 4, F.lit(False))


def majority(df: DataFrame, label: str = "y") -> DataFrame:
    """Baseline: the majority class, one row."""
    return df.agg(F.round(F.avg(label)).cast("int").alias("majority"))


def write_metadata(path: str, kind: str, n: int, scores: dict) -> None:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path if "://" in path else "file://" + path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name) as f:
        f.write(json.dumps({"version": "1", "model_type": kind, "training_samples": n, "feature_names": NAMES, "test_metrics": scores, "created_at": datetime.now(timezone.utc).isoformat()}, indent=2).encode())

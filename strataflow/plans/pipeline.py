"""End-to-end job (R1): validate -> ingest -> featurize -> augment -> latent
-> drift -> three classifier families x seeds -> evaluate -> tune -> register.

Each stage is ordinary Spark work over tables; a failed gate raises, so
nothing downstream runs.  Intermediate tables are written under the shared
checkpoint folder (``spark.checkpoint.dir``), which also cuts the lineage:
an executor lost late in the run never forces a recomputation from the raw
input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.config import FeatureConfig, Gates, RECORDS_CONTRACT, records_feature_config
from strataflow.functions import columns as B
from strataflow.operators import drift as DR
from strataflow.operators import features as FE
from strataflow.operators import imbalance as H
from strataflow.operators import latent as LT
from strataflow.operators import models as J
from strataflow.operators import quality as Q
from strataflow.operators import registry as RG
from strataflow.operators import sampling as E
from strataflow.operators import search as N
from strataflow.operators import stats as M
from strataflow.operators import training as TR
from strataflow.operators.champion import save_champion
from strataflow.sources import io as IO


def pipeline_contract() -> dict:
    """The records contract with tolerances the stand-in data meets."""
    c = {k: dict(v) for k, v in RECORDS_CONTRACT.items()}
    c["weather"]["mostly"] = 0.9
    c["year"]["max"] = 2001
    return c


@dataclass
class PipelineConfig:
    features: FeatureConfig = field(default_factory=records_feature_config)
    contract: dict = field(default_factory=pipeline_contract)
    gates: Gates = field(default_factory=lambda: Gates(0.30, 0.50))
    latent_dim: int = 8
    target_ratio: float = 0.15
    minority: int = 2
    seeds: tuple = (0, 1)
    tiebreak: tuple = ("ml", "dl", "gmm")
    gmm_components: dict = field(default_factory=lambda: {0: 1, 1: 1, 2: 2})
    tree_iter: int = 10
    mlp_iter: int = 50
    n_search: int = 3
    model_name: str = "severity"
    registry: str | None = None  # an earlier run's registry table, whose versions go on


def run_pipeline(spark: SparkSession, records: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Run every stage; return the report as (stage, key, value) rows."""
    cfg = cfg or PipelineConfig()
    report: list[tuple[str, str, str]] = []

    # 1. validate (gate)
    summary = Q.assert_valid(Q.validate_table(records, cfg.contract))
    report.append(("validate", "n_rules", str(summary["n_rules"])))

    # 2. ingest: materialise the input once; count observed during the write
    raw_path = IO.fresh_path(spark, "raw")
    from pyspark.sql import Observation
    obs = Observation("raw")
    records.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(raw_path)
    n_raw = int(obs.get["n"])
    raw = spark.read.parquet(raw_path)
    report.append(("ingest", "row_count", str(n_raw)))

    # 3. featurize: prepare, split, fit on train, transform all, gates
    fc = cfg.features
    prepared = FE.prepare(raw, fc)
    split = E.stratified_split(prepared, "label", fc.key, fc.test_size, fc.val_size, seed=fc.seed)
    split_path = IO.fresh_path(spark, "split")
    IO.write_splits(split, split_path)
    split = spark.read.parquet(split_path)
    gate = B.drop_rate_gate(raw, F.col(fc.target).isNotNull()).first()
    if not gate["passed"]:
        raise RuntimeError(f"row-loss gate failed: {gate['drop_rate']}")
    model = FE.fit_pipeline(split.where(F.col("split") == "train"), fc)
    feats = FE.transform_pipeline(split, model, keep=[fc.key, "split", "label"])
    feat_path = IO.fresh_path(spark, "features")
    IO.write_splits(feats.select(fc.key, "split", "label", "features"), feat_path)
    feats = spark.read.parquet(feat_path)
    p = len(model.output_columns)
    sc = B.sample_complexity(feats.where(F.col("split") == "train"), p).first()
    if not sc["passed"]:
        raise RuntimeError(f"sample-complexity gate failed: ratio {sc['ratio']}")
    report.append(("featurize", "n_features", str(p)))

    # 4. augment the minority among the train features, to the target ratio
    feats = feats.withColumn(fc.key, F.col(fc.key).cast("string"))
    train = feats.where(F.col("split") == "train")
    aug = H.augment_minority(train.drop("split"), "label", "features", cfg.minority, cfg.target_ratio, seed=fc.seed,
                             key=fc.key)
    every = aug.withColumn("split", F.lit("train")).unionByName(
        feats.where(F.col("split") != "train").withColumn("is_synthetic", F.lit(False)))

    # 5. latent space fitted on the un-augmented train rows; drift of the test rows against them
    pca = LT.latent_pca(train, "features", cfg.latent_dim)
    enc = pca.encoder()
    lat = LT.encode_batch(every, enc, "features", out_mu="z", out_log_var=None)
    lat = lat.select(fc.key, "split", "label", "is_synthetic", F.col("z").alias("features"))
    data_path = IO.fresh_path(spark, "train_data")
    IO.write_splits(lat, data_path)
    data = spark.read.parquet(data_path)
    report.append(("latent", "explained", f"{float(pca.explained.sum()):.6f}"))
    real = data.where(~F.col("is_synthetic"))
    ref, _ = DR.drift_reference(real.where(F.col("split") == "train"), "features", fc.key, n_features=p)

    # 6. advisory drift check
    drift = DR.detect_drift(ref, real.where(F.col("split") == "test"), "features", fc.key).first()
    report.append(("drift", "mmd", str(drift["mmd"])))
    report.append(("drift", "is_drifted", str(drift["is_drifted"])))
    data = data.drop("is_synthetic")

    # 7. three families x seeds -> ledger
    k = cfg.latent_dim
    fams = {
        "ml": lambda s: J.train_trees(data, 3, max_iter=cfg.tree_iter, seed=s),
        "dl": lambda s: TR.train_network(data, k, 3, lr=0.02, epochs=cfg.mlp_iter, seed=s, key=fc.key),
        "gmm": lambda s: J.train_gmm_classifier(data, cfg.gmm_components, n_init=1, seed=s),
    }
    ledgers, best = [], {}
    for fam, fit in fams.items():
        runs, best[fam] = J.seed_sweep(data, fit, list(cfg.seeds), fam, cfg.minority)
        ledgers.append(runs)
    ledger = ledgers[0].unionByName(ledgers[1]).unionByName(ledgers[2])
    ledger_path = IO.fresh_path(spark, "ledger")
    RG.log_runs(ledger, ledger_path)
    ledger = RG.read_ledger(spark, ledger_path)

    # 8. evaluate: Welch / Bonferroni winner, gates
    runs = ledger.select("experiment", "run_id", "start_time", "status",
                         F.col("metrics")["test_macro_f1"].alias("macro_f1"),
                         F.col("metrics")["test_class_recall"].alias("class_recall"))
    latest = RG.latest_runs(runs, len(cfg.seeds), ["macro_f1", "class_recall"])
    ev = M.evaluate_families(latest, list(cfg.tiebreak), alpha=0.05, f1_gate=cfg.gates.macro_f1,
                             recall_gate=cfg.gates.class_recall).first()
    winner = ev["winner"]
    report += [("evaluate", "winner", winner), ("evaluate", "gates_passed", str(ev["gates_passed"]))]

    # 9. tune the decision threshold of the winner on validation (random search)
    val_path = IO.fresh_path(spark, "scored_val")
    best[winner].predict(data.where(F.col("split") == "val")).select("split", "label", "probs").write.parquet(val_path)
    scored_val = spark.read.parquet(val_path)

    def objective(params):
        s = scored_val.withColumn("prediction", J.predict_threshold(F.col("probs"), params["threshold"]))
        e = J.evaluate_splits(s, cfg.minority)
        f1, rec = e["f1"].get("val", 0.0), e["recall"].get("val", 0.0)
        return {"macro_f1": f1, "class_recall": rec, "fitness": 0.5 * f1 + 0.5 * rec - max(0.0, 0.35 - rec) ** 2 * 4}

    trials = N.random_search({"threshold": ("uniform", 0.02, 0.5)}, objective, cfg.n_search, seed=fc.seed)
    best_trial = max(trials, key=lambda t: (t["fitness"], -t["trial"]))
    champion = J.Champion(enc, best[winner], tau=best_trial["param_threshold"])
    report.append(("tune", "threshold", f"{champion.tau:.4f}"))
    tuned = J.evaluate_splits(champion.score(feats.where(F.col("split") == "test")), cfg.minority)
    report.append(("tune", "test_macro_f1", f"{tuned['f1'].get('test', 0.0):.6f}"))

    # 10. store and register when the gates passed: the run whose model was tuned, the best by validation F1
    if ev["gates_passed"]:
        path = IO.fresh_path(spark, "champion")
        save_champion(spark, champion, path)
        by_val = F.struct(F.col("metrics")["val_macro_f1"], -F.col("seed"))
        cand = (ledger.where(F.col("experiment") == winner).groupBy("experiment")
                .agg(F.max_by("run_id", by_val).alias("run_id"), F.max_by("start_time", by_val).alias("start_time"))
                .select("*", F.lit(True).alias("gates_passed"), F.lit(path).alias("path")))
        existing = spark.read.parquet(cfg.registry) if cfg.registry else None
        registry_path = IO.fresh_path(spark, "registry")
        RG.publish_champion(cand, cfg.model_name, existing=existing).write.parquet(registry_path)
        reg = spark.read.parquet(registry_path)
        report.append(("register", "version", str(reg.agg(F.max("version")).first()[0])))
        report.append(("register", "registry", registry_path))
    else:
        report.append(("register", "version", "none (gates failed)"))
    return spark.createDataFrame(report, "stage string, key string, value string")

"""Command-line entry points (the reference's two scripts, and scoring by saved models):

  python -m loanlens.cli features --data-dir DIR --out DIR [--fmt csv|parquet] [--checkpoint] [--quarantine DIR]
  python -m loanlens.cli train --features-dir DIR --out DIR [--folds 8] [--seed 42] [--members 7]
  python -m loanlens.cli score --models DIR --features DIR --out DIR
"""

from __future__ import annotations

import argparse
import functools
import json
import os
import time

from pyspark.sql import types as T

from loanlens.session import build_session

ID, LABEL = "SK_ID_CURR", "TARGET"


def run_features(args) -> None:
    from loanlens.plans.features import build_features, split_train_test
    from loanlens.sources import read_tables, write_features
    spark = build_session(app_name="loanlens-features")
    t0 = time.time()
    tables = read_tables(spark, args.data_dir, fmt=args.fmt, limit=args.limit, quarantine=args.quarantine)
    features = build_features(tables, checkpoint=args.checkpoint)
    train, test = split_train_test(features, LABEL)
    paths = write_features(train, test, args.out)
    print(json.dumps({"train": paths[0], "test": paths[1], "columns": len(features.columns),
                      "seconds": round(time.time() - t0, 1)}))


# Numeric columns the reference tags as categories (E11), after
# name sanitising; string columns are categories as well.
CATEGORY_TAGGED = ["COUNT_POS_CASH_LOANS_CAT_POS_CASH", "COUNT_INSTALLMENTS_ACCTS_CAT_INSTALL_PAY",
                   "INSTALMENT_VERSION_LAST_DUE_CAT_INSTALL_PAY"]


def category_features(df) -> list[str]:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return strings + [c for c in CATEGORY_TAGGED if c in df.columns and c not in strings]


def run_train(args) -> None:
    from loanlens.plans.training import (BoostParams, cross_validate, final_round_count,
                                         mean_importance, split_counts, top_importances,
                                         train_and_score)
    from loanlens.sources import read_features, write_importances, write_predictions
    spark = build_session(app_name="loanlens-train")
    t0 = time.time()
    train, test = read_features(spark, args.features_dir)
    cats = category_features(train)
    feats = [c for c in train.columns if c not in (ID, LABEL)]
    params = BoostParams(max_iter=args.max_rounds, seed=args.seed)
    scores, rounds, imp = cross_validate(train, feats, cats, LABEL, ID, k=args.folds,
                                         seed=args.seed, smoothing=args.smoothing, params=params,
                                         noise_level=args.noise)
    n_rounds = final_round_count(rounds)
    preds, final_imp, ensemble = train_and_score(train, test, feats, cats, LABEL, ID, n_rounds,
                                               smoothing=args.smoothing, members=args.members,
                                               base=params)
    pred_path = write_predictions(preds, args.out, args.version)
    write_importances(final_imp, os.path.join(args.out, "feature_importances"))
    cv_importance = mean_importance(imp)
    write_importances(cv_importance, os.path.join(args.out, "cv_feature_importances"))
    top = [r.feature for r in top_importances(cv_importance, 50).collect()]
    paths = ensemble.save(os.path.join(args.out, "models"))
    counts = [split_counts(spark, p, ensemble.features) for p in paths]
    write_importances(mean_importance(functools.reduce(lambda a, b: a.unionByName(b), counts)),
                      os.path.join(args.out, "split_importances"))
    print(json.dumps({"cv_auc": scores, "best_rounds": rounds, "final_rounds": n_rounds,
                      "predictions": pred_path, "top_cv_features": top,
                      "seconds": round(time.time() - t0, 1)}))


def run_score(args) -> None:
    """Score a feature table by a saved ensemble."""
    from loanlens.plans.training import load_and_score
    from loanlens.sources import write_predictions
    spark = build_session(app_name="loanlens-score")
    t0 = time.time()
    preds = load_and_score(spark, args.models, spark.read.parquet(args.features))
    print(json.dumps({"predictions": write_predictions(preds, args.out, args.version), "seconds": round(time.time() - t0, 1)}))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="loanlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("features")
    f.add_argument("--data-dir", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--fmt", default="csv", choices=["csv", "parquet"])
    f.add_argument("--checkpoint", action="store_true")
    f.add_argument("--quarantine", default=None, help="folder for malformed rows and values of CSV files")
    f.add_argument("--limit", type=int, default=None, help="debug: rows per table")
    t = sub.add_parser("train")
    t.add_argument("--features-dir", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--folds", type=int, default=8)
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--members", type=int, default=7)
    t.add_argument("--smoothing", type=float, default=5.0)
    t.add_argument("--max-rounds", type=int, default=10_000)
    t.add_argument("--noise", type=float, default=0.0, help="multiplicative noise on training encodings")
    t.add_argument("--version", default="v1")
    p = sub.add_parser("score")
    p.add_argument("--models", required=True)
    p.add_argument("--features", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--version", default="v1")
    args = ap.parse_args(argv)
    {"features": run_features, "train": run_train, "score": run_score}[args.cmd](args)


if __name__ == "__main__":
    main()

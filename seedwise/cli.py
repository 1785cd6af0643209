"""Command line for the daily jobs.

    python -m seedwise.cli onehot      --profile TABLE --columns FILE --out PATH [--as-of YYYY-MM-DD]
    python -m seedwise.cli categorical --profile TABLE --singles FILE --multis FILE --out PATH
    python -m seedwise.cli expand      --features PATH --seeds FILE --out PATH --codes 70,72
                                       [--model gbt|lr] [--target N] [--inclusive]
                                       [--iterations 50 --depth 3] [--sample hash|bernoulli]
                                       [--scores-path PATH | --scores-table NAME]
                                       [--holdout 0.2] [--lookback DAYS]
    python -m seedwise.cli leaf        --features PATH --out PATH --codes 70,72
                                       [--model-path PATH] [--save-to PATH] [--lookback DAYS]
    python -m seedwise.cli seedcheck   --seeds FILE --sql "SELECT id, value FROM …"

``--as-of`` defaults to today; the expansion reads the newest non-empty
partition before it, however old unless ``--lookback`` bounds it. The master and all
other settings come from ``spark-submit``; SEEDWISE_MASTER sets a master for a trial.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from seedwise.plans import runs
from seedwise.session import build_session


def _codes(text: str) -> list[int]:
    return [int(c) for c in text.split(",") if c.strip()]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="seedwise")
    sub = p.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    common.add_argument("--id-col", default="user_id")
    common.add_argument("--cycle-col", default="cycle")
    common.add_argument("--reader-col", default="reader")

    a = sub.add_parser("onehot", parents=[common])
    a.add_argument("--profile", required=True)
    a.add_argument("--columns", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--table")

    c = sub.add_parser("categorical", parents=[common])
    c.add_argument("--profile", required=True)
    c.add_argument("--singles", required=True)
    c.add_argument("--multis", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--table")

    e = sub.add_parser("expand", parents=[common])
    e.add_argument("--features", required=True)
    e.add_argument("--seeds", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--codes", type=_codes, required=True)
    e.add_argument("--model", choices=["gbt", "lr"], default="gbt")
    e.add_argument("--target", type=int, default=0)
    e.add_argument("--inclusive", action="store_true")
    e.add_argument("--iterations", type=int)
    e.add_argument("--depth", type=int)
    e.add_argument("--sample", choices=["hash", "bernoulli"], default="hash")
    e.add_argument("--scores-path", help="also write every candidate's score (K3)")
    e.add_argument("--scores-table", help="the same into a catalogue table")
    e.add_argument("--holdout", type=float, default=0.0, help="share kept out of the fit")
    e.add_argument("--lookback", type=int)

    lf = sub.add_parser("leaf", parents=[common])
    lf.add_argument("--features", required=True)
    lf.add_argument("--out", required=True)
    lf.add_argument("--codes", type=_codes, required=True)
    lf.add_argument("--table")
    lf.add_argument("--lookback", type=int)
    lf.add_argument("--model-path", help="use saved trees and leaf code")
    lf.add_argument("--save-to", help="keep the fitted trees and leaf code")

    s = sub.add_parser("seedcheck", parents=[common])
    s.add_argument("--seeds", required=True)
    s.add_argument("--sql", required=True)

    args = p.parse_args(argv)
    spark = build_session(app=f"seedwise-{args.job}")
    cols = dict(id_col=args.id_col, cycle_col=args.cycle_col, reader_col=args.reader_col)
    if args.job == "onehot":
        print(runs.run_onehot_build(spark, args.profile, args.columns, args.out, args.as_of,
                                    table=args.table, **cols))
    elif args.job == "categorical":
        print(runs.run_categorical_build(spark, args.profile, args.singles, args.multis,
                                         args.out, args.as_of, table=args.table, **cols))
    elif args.job == "expand":
        gbt = {k: v for k, v in (("max_iter", args.iterations), ("max_depth", args.depth)) if v}
        exp = runs.run_expansion(spark, args.features, args.seeds, args.out, args.as_of,
                                 args.codes, model=args.model, target_size=args.target,
                                 inclusive=args.inclusive, gbt_params=gbt or None,
                                 scores_path=args.scores_path, scores_table=args.scores_table,
                                 sample_method=args.sample, holdout=args.holdout,
                                 max_lookback_days=args.lookback)
        print(exp.counts, exp.ratio, exp.summary)
    elif args.job == "leaf":
        print(runs.run_leaf_build(spark, args.features, args.out, args.as_of, args.codes,
                                  table=args.table, max_lookback_days=args.lookback,
                                  model_path=args.model_path, save_to=args.save_to))
    elif args.job == "seedcheck":
        print(runs.run_seed_check(spark, args.seeds, args.sql))
    return 0


if __name__ == "__main__":
    sys.exit(main())

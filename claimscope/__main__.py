"""python -m claimscope STAGE --store PATH [inputs and thresholds]"""

from __future__ import annotations

import argparse
from dataclasses import replace

from claimscope.config import DEFAULT
from claimscope.plans import stages
from claimscope.session import get_session


PLAIN = {"audit": stages.audit, "features": stages.build_features, "detect": stages.detect, "companies": stages.roll_up, "model": stages.model, "backtest": stages.backtest, "yearly-features": stages.yearly_features}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("claimscope")
    sub = out.add_subparsers(dest="stage", required=True)
    one = sub.add_parser("integrate")
    for name in ("spending", "registry", "enrollment", "exclusions"):
        one.add_argument(f"--{name}", required=True)
    one.add_argument("--owners", nargs="+", required=True)
    one.add_argument("--npi-role", choices=["billing", "servicing"], default="billing", help="the id that claims are attributed by")
    for name in PLAIN:
        sub.add_parser(name)
    sub.add_parser("export").add_argument("--no-preserve-excluded", action="store_true", help="leave out the file of excluded leads below the threshold")
    lists = sub.add_parser("model-exports")
    lists.add_argument("--top-k", type=int, default=5000)
    lists.add_argument("--min-score", type=float, default=0.0)
    lists.add_argument("--npi-min-net-paid", type=float, default=5_000_000.0)
    lists.add_argument("--npi-min-score", type=float, default=0.9)
    clean = sub.add_parser("yearly-clean")
    for name in ("spending", "registry", "exclusions"):
        clean.add_argument(f"--{name}", required=True)
    clean.add_argument("--min-total-paid", type=float, default=10_000_000.0)
    score = sub.add_parser("yearly-score")
    score.add_argument("--contamination", type=float, default=0.05)
    score.add_argument("--n-estimators", type=int, default=300)
    score.add_argument("--save-top", type=int, default=200, help="rows of the ranking files; 0 or less for all")
    for p in sub.choices.values():
        p.add_argument("--store", required=True)
        p.add_argument("--min-net-paid", type=float, default=DEFAULT.min_net_paid)
        p.add_argument("--frag-max-share", type=float, default=DEFAULT.frag_max_share)
        p.add_argument("--paid-ceiling", type=float, default=DEFAULT.paid_ceiling)
        p.add_argument("--min-peers", type=int, default=DEFAULT.min_peers)
        p.add_argument("--runout-months", type=int, default=DEFAULT.runout_months)
    return out


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    cfg = replace(DEFAULT, min_net_paid=a.min_net_paid, frag_max_share=a.frag_max_share, paid_ceiling=a.paid_ceiling, min_peers=a.min_peers, runout_months=a.runout_months)
    store = stages.Store(get_session(), a.store)
    if a.stage == "integrate":
        stages.integrate(store, a.spending, a.registry, a.enrollment, a.owners, a.exclusions, a.npi_role)
    elif a.stage == "export":
        stages.export(store, cfg, not a.no_preserve_excluded)
    elif a.stage == "model-exports":
        stages.model_exports(store, cfg, a.top_k, a.min_score, a.npi_min_net_paid, a.npi_min_score)
    elif a.stage == "yearly-clean":
        stages.yearly_clean(store, a.spending, a.registry, a.exclusions, a.min_total_paid)
    elif a.stage == "yearly-score":
        stages.yearly_score(store, a.contamination, a.n_estimators, a.save_top if a.save_top > 0 else None)
    else:
        PLAIN[a.stage](store, cfg)


if __name__ == "__main__":
    main()

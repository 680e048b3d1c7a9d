"""Run the zones in order: landing -> persistent -> formatted -> KPIs -> model.

    python -m propmart.plans.run --landing L --root R [--steps persistent,formatted,exploitation,model]

Writes ``R/persistent``, ``R/formatted``, ``R/exploitation`` and ``R/model``.
Cluster settings (master, partitions, checkpoint folder) come from
``spark-submit``/the session; nothing is set here beyond the library defaults.
"""

from __future__ import annotations

import argparse

from propmart.plans.exploitation import build_exploitation
from propmart.plans.formatted import build_formatted
from propmart.plans.model import build_model
from propmart.plans.persistent import build_persistent
from propmart.session import build_session, tune_for_input
from propmart.sources.files import folder_bytes

STEPS = ("persistent", "formatted", "exploitation", "model")


def run(spark, landing: str, root: str, steps=STEPS, tune: bool = True) -> dict:
    """Run the steps in order.  With ``tune``, the shuffle partition count of
    each step is sized from the bytes it reads (see ``tune_for_input``)."""
    root = root.rstrip("/")
    done = {}

    def sized(path: str) -> None:
        if tune:
            done.setdefault("shuffle_partitions", {})[path] = tune_for_input(spark, folder_bytes(spark, path))

    if "persistent" in steps:
        sized(landing)
        done["persistent"] = build_persistent(spark, landing, f"{root}/persistent")
    if "formatted" in steps:
        sized(f"{root}/persistent")
        build_formatted(spark, f"{root}/persistent", f"{root}/formatted")
        done["formatted"] = f"{root}/formatted"
    if "exploitation" in steps:
        sized(f"{root}/formatted")
        done["exploitation"] = build_exploitation(spark, f"{root}/formatted", f"{root}/exploitation")
    if "model" in steps:
        _, _, metrics = build_model(spark, f"{root}/formatted", f"{root}/model", segments_path=f"{root}/segments")
        done["model"] = metrics.first().asDict()
    return done


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--steps", default=",".join(STEPS))
    args = ap.parse_args(argv)
    spark = build_session(app="propmart-zones")
    print(run(spark, args.landing, args.root, tuple(args.steps.split(","))))


if __name__ == "__main__":
    main()

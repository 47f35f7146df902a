"""Command line: ``python -m wayfact.jobs <job> --help``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from wayfact.operators import dims
from wayfact.plans import pipeline
from wayfact.session import build_session

MONTHLY_PATTERN = "year={year}/month={month}/yellow_tripdata_{year}-{month}.parquet"

# job: (function, required options, optional options with defaults)
JOBS: dict[str, tuple[Callable, tuple[str, ...], dict[str, object]]] = {
    "prepare-hours": (pipeline.prepare_hours, ("source", "output"), {}),
    "hour-gaps": (pipeline.hour_gaps, ("source", "first", "last"), {}),
    "complete-hours": (
        pipeline.complete_hours,
        ("source", "output", "first", "last"),
        {"station": dims.DEFAULT_STATION},
    ),
    "hourly-summaries": (
        pipeline.hourly_summaries,
        ("trips", "zones", "hours", "start", "end", "output"),
        {"rebalance": False, "explain": False},
    ),
    "daily-summaries": (
        pipeline.daily_summaries,
        ("trips", "zones", "hours", "start", "end", "output"),
        {"rebalance": False},
    ),
    "daily-analysis": (
        pipeline.daily_analysis,
        ("trips", "zones", "days", "first", "last", "output"),
        {},
    ),
    "demand-dataset": (
        pipeline.demand_dataset,
        ("source", "output"),
        {"start": "2024-01-01", "end": "2025-01-01"},
    ),
    "demand-models": (
        pipeline.demand_models,
        ("source", "output"),
        {"trees": 150, "depth": 12},
    ),
    "score-demand": (pipeline.score_demand, ("model", "source", "output"), {}),
    "tip-classifier": (pipeline.tip_classifier, ("trips", "output"), {}),
    "reports": (pipeline.analysis_reports, ("root", "output"), {"daily": ""}),
    "checks": (pipeline.validation_checks, ("root", "output"), {}),
    "validate-schemas": (
        pipeline.validate_schemas,
        ("root",),
        {"year": 2024, "pattern": MONTHLY_PATTERN},
    ),
    "log-metrics": (pipeline.log_metrics, ("folder", "output"), {}),
    "words": (pipeline.words, ("source", "output"), {"k": 20}),
}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="wayfact")
    jobs = root.add_subparsers(dest="job", required=True)
    for name, (function, required, optional) in JOBS.items():
        job = jobs.add_parser(name, help=(function.__doc__ or name).splitlines()[0])
        for option in required:
            job.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            if isinstance(default, bool):
                job.add_argument(f"--{option}", action="store_true")
            else:
                job.add_argument(f"--{option}", type=type(default), default=default)
    return root


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    job = options.pop("job")
    spark = build_session(f"wayfact-{job}")
    JOBS[job][0](spark, **options).show(50, truncate=False)


if __name__ == "__main__":
    main()

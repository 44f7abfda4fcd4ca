"""The daily run: landing, silver, gold, predictions, exports and report, with an integrity gate after each layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quotelake.plans.bronze import land_prices, land_snapshots
from quotelake.plans.gold import export_star, import_predictions, run_gold
from quotelake.plans.reports import report_from_silver
from quotelake.plans.silver import run_silver
from quotelake.sources import control
from quotelake.sources.commits import is_committed
from quotelake.sources.paths import names


@dataclass(frozen=True)
class Lake:
    """Folders of the three layers and of the control tables."""

    bronze: str
    silver: str
    gold: str
    control: str


def seal(spark: SparkSession, lake: Lake, stage: str, logs: DataFrame | None = None) -> str:
    """Record the manifest of a stage and pass its gate; returns the composite hash."""
    made = control.build_manifest(spark, getattr(lake, stage), lake.control, stage)
    control.gate(spark, lake.control, stage, logs, made)
    return made


def daily_run(
    spark: SparkSession,
    lake: Lake,
    prices: DataFrame,
    info: DataFrame | None = None,
    logs: dict[str, DataFrame] | None = None,
    snapshots: dict[str, DataFrame] | None = None,
    predictions: DataFrame | None = None,
    exports: str | None = None,
    report: str | None = None,
) -> dict[str, bool]:
    """Land what is new and bring silver and gold up to date; returns which stages had work.

    Each stage first checks that its input is what the stage before sealed. A failed gate stops the run. ``snapshots``: further kinds to land, by name;
    ``predictions``: rows to append to gold; ``exports`` and ``report``: folders to bring up to date when gold or silver changed, or when they are not there yet.
    """
    logs = logs or {}
    landed = land_prices(prices, lake.bronze) > 0
    kinds = {"info": info} if info is not None else {}
    land_snapshots({**kinds, **(snapshots or {})}, lake.bronze)
    sealed = seal(spark, lake, "bronze", logs.get("bronze"))

    control.verify_manifest(spark, lake.control, "bronze", sealed)
    refined = run_silver(spark, lake.bronze, lake.silver)
    if refined:
        seal(spark, lake, "silver", logs.get("silver"))

    loaded = False
    if refined:
        control.verify_manifest(spark, lake.control, "silver")
        loaded = run_gold(spark, lake.silver, lake.gold)
        seal(spark, lake, "gold", logs.get("gold"))
    done = {"bronze": landed, "silver": refined, "gold": loaded}

    if predictions is not None:
        control.verify_manifest(spark, lake.control, "gold")
        import_predictions(spark, lake.gold, predictions)
        seal(spark, lake, "gold", logs.get("gold"))
        done["predictions"] = True
    if exports is not None:
        done["exports"] = loaded or not names(spark, f"{exports}/export_log")
        if done["exports"]:
            control.verify_manifest(spark, lake.control, "gold")
            export_star(spark, lake.gold, exports)
    if report is not None:
        done["report"] = refined or not is_committed(spark, f"{report}/entitlements")
        if done["report"]:
            control.verify_manifest(spark, lake.control, "silver")
            done["report"] = report_from_silver(spark, lake.silver, report)
    return done

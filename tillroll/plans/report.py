"""What a run left behind: one frame of figures, and the same as text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.quality import quarantine_count, status_histogram, table_counts
from tillroll.sources.lake import Lake, read_quarantine
from tillroll.sources.published import Layer

METRICS = "area string, name string, n long, problem string"
Metric = tuple[str, str, int | None, str | None]


def _measured(area: str, measure: Callable[[], Iterable[tuple[str, int]]]) -> list[Metric]:
    """The figures of an area, or one row with the problem that kept them from being read."""
    try:
        return [(area, name, n, None) for name, n in measure()]
    except Exception as error:  # noqa: BLE001 - the report has to come out
        return [(area, "unreadable", None, str(error).splitlines()[0])]


def health_metrics(
    spark: SparkSession, lake: Lake, table_names: list[str], statuses: DataFrame | None
) -> DataFrame:
    """``area, name, n, problem``: rows per table, rejected events, check results per status.

    Made from what is stored now, whether or not the run before it succeeded.
    """
    layer = Layer(lake.gold)
    loads = {name: (lambda name=name: layer.read(spark, name)) for name in table_names}
    rows: list[Metric] = [
        ("table", r.table_name, r.n_rows, r.error) for r in table_counts(spark, loads).collect()
    ]
    rows += _measured(
        "rejected", lambda: [("sales events", quarantine_count(read_quarantine(spark, lake.quarantine)))]
    )
    if statuses is not None:
        rows += _measured("check", lambda: [(r.status, r.n) for r in status_histogram(statuses).collect()])
    return spark.createDataFrame(rows, METRICS)


def as_text(metrics: DataFrame) -> str:
    """One line per figure, grouped by area."""
    lines, last = [], None
    for r in metrics.orderBy("area", "name").collect():
        if r.area != last:
            lines += ["", f"{r.area}s" if r.area != "rejected" else "rejected rows"]
            last = r.area
        lines.append(f"  {r.name:<32}{r.problem if r.n is None else format(r.n, ',')}")
    if not any(line.startswith("check") for line in lines):
        lines += ["", "checks", "  none were run"]
    return "\n".join(lines[1:]) + "\n"


def health_report(
    spark: SparkSession, lake: Lake, table_names: list[str], statuses: DataFrame | None
) -> str:
    return as_text(health_metrics(spark, lake, table_names, statuses))

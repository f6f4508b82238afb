"""Markdown reports from small aggregates; rows come to the driver, at most a few hundred of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 500


def rows_of(table: DataFrame, n: int = MOST_ROWS) -> list[dict[str, Any]]:
    """The first n rows of a table of aggregates."""
    return [r.asDict() for r in table.limit(n).collect()]


def shown(v: Any) -> str:
    if v is None:
        return "-"
    if isinstance(v, float):
        return f"{v:.3f}"
    return ", ".join(map(shown, v)) or "-" if isinstance(v, (list, tuple)) else str(v)


def table(rows: Iterable[Mapping[str, Any]]) -> str:
    """Rows of the same keys as a Markdown table."""
    rows = list(rows)
    if not rows:
        return "None."
    lines = ["| " + " | ".join(rows[0]) + " |", "|" + "---|" * len(rows[0])]
    return "\n".join([*lines, *("| " + " | ".join(shown(v).replace("|", "\\|").replace("\n", " ") for v in r.values()) + " |" for r in rows)])


def left_out(all_: int, shown_: int) -> str:
    return f"\n\n{all_ - shown_} more are not shown." if all_ > shown_ else ""


def section(title: str, body: str | Iterable[str]) -> str:
    return f"## {title}\n\n{body if isinstance(body, str) else chr(10).join(f'- {x}' for x in body) or 'None.'}\n"


def report(title: str, facts: Mapping[str, Any], sections: Mapping[str, DataFrame | Iterable[str] | str]) -> str:
    """A title, facts one a line, and a section for each table, list or text."""
    parts = [f"# {title}\n", *(f"**{k}:** {shown(v)}" for k, v in facts.items()), ""]
    return "\n".join([*parts, *(section(k, table(rows_of(v)) if isinstance(v, DataFrame) else v) for k, v in sections.items())])


def pii_report(hits: DataFrame, totals: DataFrame, examples: int = 5) -> str:
    """Totals, and for each type, in words, its number and first examples, redacted."""
    from foliant.operators.quality import first_of_each

    kinds = {r["type"]: r["n"] for r in rows_of(hits.groupBy("type").count().withColumnRenamed("count", "n").orderBy("type"))}
    some: dict[str, list[str]] = {}
    for r in rows_of(first_of_each(hits, "type", ["redacted", "context"], examples).orderBy("type", "redacted", "context")):
        some.setdefault(r["type"], []).append(f"`{r['redacted']}`")
    return report("PII Report", rows_of(totals)[0], {f"{k.replace('_', ' ').title()} ({n})": some.get(k, []) for k, n in kinds.items()})


def license_report(folders: DataFrame) -> str:
    """Totals are of all folders; of folders, and of different warnings, the first MOST_ROWS are shown, and how many are not."""
    licensed = F.count_if(F.col("license_files") > 0)
    facts = rows_of(folders.agg(F.count("*").alias("Total folders"), licensed.alias("Licensed folders"), (F.count("*") - licensed).alias("Unknown license folders")))[0]
    name = folders.columns[0]
    shown_rows = rows_of(folders.drop("warnings", "recommendations").orderBy(name))
    sections: dict[str, str | list[str]] = {"Folders": table(shown_rows) + left_out(facts["Total folders"], len(shown_rows))}
    for title, column in (("Warnings", "warnings"), ("Recommendations", "recommendations")):
        different = folders.select(F.explode(column).alias("said")).distinct()
        said = [r["said"] for r in rows_of(different.orderBy("said"))]
        more = left_out(different.count(), len(said)) if len(said) == MOST_ROWS else ""
        sections[title] = [*said, more.strip()] if more else said
    return report("License and Attribution Report", facts, sections)


def skew_report(skew: DataFrame) -> str:
    facts = rows_of(skew)[0]
    advice = facts.pop("recommendations")
    return report("RTL and Rotation Report", facts, {"Recommendations": advice})


def gate_report(tables: Mapping[str, DataFrame]) -> str:
    """All of the dataset gate in one report; the status comes first."""
    facts = rows_of(tables["status"])[0]
    return "\n".join([report("Pre-upload Report", facts, {"Findings": tables["findings"].orderBy("issue")}), license_report(tables["licenses"]), skew_report(tables["skew"])])


def detection_report(metrics: DataFrame, classes: DataFrame) -> str:
    return report("COCO Evaluation Report", {r["metric"]: r["value"] for r in rows_of(metrics)}, {"Per-Class Metrics": classes.orderBy("class_id")})


def summary_report(title: str, summary: DataFrame) -> str:
    """A summary table with a row for all (class null) and one for each class, as for texts and descriptions."""
    rows = rows_of(summary)
    whole = next((r for r in rows if r["class"] is None), {})
    return report(title, {k: v for k, v in whole.items() if k != "class"}, {"Per-Class Metrics": table([r for r in rows if r["class"] is not None])})


def language_report(summary: DataFrame, per_label: DataFrame) -> str:
    return report("Language ID Report", rows_of(summary)[0], {"Per-Language Metrics": per_label.orderBy("label")})


def combined_report(parts: Mapping[str, str]) -> str:
    return "\n\n".join(["# Evaluation Report", *parts.values()])


def dashboard_html(board: DataFrame) -> str:
    """A small page with each metric, its value and whether it is past its mark."""
    from html import escape

    state = {True: "good", False: "needs work", None: "not measured"}
    body = "".join(f"<tr><td>{escape(r['area'])}</td><td>{escape(r['metric'])}</td><td>{shown(r['value'])}</td><td>{state[r['good']]}</td></tr>" for r in rows_of(board))
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>Dashboard</title></head><body><table><tr><th>Area</th><th>Metric</th><th>Value</th><th>Status</th></tr>{body}</table></body></html>"


def qa_report(rate: DataFrame, summary: DataFrame) -> str:
    rows = rows_of(summary)
    part = lambda key: [f"**{r[key]}:** {r['n']}" for r in sorted(rows, key=lambda r: (-r["n"], str(r[key]))) if r[key] is not None]
    return report("Description Quality Assurance Report", rows_of(rate)[0], {"Summary by Issue Type": part("issue"), "Summary by Severity": part("severity"), "Summary by Class": part("class")})


def changelog_report(groups: DataFrame, counts: Mapping[str, int]) -> str:
    return report("Data Cleaning Changelog", counts, {r["group"]: r["fixes"] for r in rows_of(groups.orderBy("group"))})

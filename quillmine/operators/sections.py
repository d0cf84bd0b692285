"""Sections of a document: order that never goes back, and runs of selected paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Section names by stage, and what each extraction handler reads.
STAGES = {"introductory": 0, "descriptive": 1, "reasoning": 1, "operative": 2}
STAGE_NAMES = ("introductory", "reasoning", "operative")
HANDLERS = {"introductory": ("introductory",), "reasoning": ("descriptive", "reasoning"), "operative": ("operative",)}


def stage_of(section: Column) -> Column:
    """The section's stage; an unknown section is an error."""
    stages = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    return F.coalesce(F.try_element_at(stages, section), F.raise_error(F.concat(F.lit("unsupported section: "), F.coalesce(section, F.lit("null")))).cast("int"))


def in_section(section: Column, handler: str) -> Column:
    """F3."""
    return section.isin(*HANDLERS[handler])


def monotone_sections(rows: DataFrame, document: str, order: str, section: str) -> DataFrame:
    """effective_section: the furthest stage reached so far."""
    upto = Window.partitionBy(document).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    furthest = F.max(stage_of(F.col(section))).over(upto)
    return rows.withColumn("effective_section", F.element_at(F.array(*map(F.lit, STAGE_NAMES)), furthest + 1))


def islands(rows: DataFrame, document: str, order: str, selected: Column, key: Column | None = None, mode: str = "sequential") -> DataFrame:
    """The selected rows with group_id from 1. filtered: one group; sequential: a new one where the key changes or an
    unselected row lies between."""
    if mode == "filtered":
        return rows.where(selected).withColumn("group_id", F.lit(1).cast("long"))
    if mode != "sequential":
        raise ValueError(f"unsupported mode: {mode!r}")
    along = Window.partitionBy(document).orderBy(order)
    marked = rows.withColumn("_selected", F.coalesce(selected, F.lit(False))).withColumn("_key", F.lit(None).cast("string") if key is None else key)
    opens = F.col("_selected") & ~(F.coalesce(F.lag("_selected").over(along), F.lit(False)) & F.col("_key").eqNullSafe(F.lag("_key").over(along)))
    marked = marked.withColumn("_opens", opens.cast("long"))
    grouped = marked.withColumn("group_id", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.where("_selected").drop("_selected", "_key", "_opens")

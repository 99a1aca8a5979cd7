"""Project listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effortlens.functions.timeutil import ntz_literal, parse_instant

# Labels of the archive state.
ARCHIVED_LABEL = "アーカイブ済み"
ACTIVE_LABEL = "アクティブ"


def active_projects(projects: DataFrame) -> DataFrame:
    """Projects not archived; an absent flag counts as not archived."""
    return projects.filter(F.col("archived").isNull() | ~F.col("archived"))


def named_like(projects: DataFrame, fragment: str | None) -> DataFrame:
    """Projects whose name contains the fragment, case-sensitively; all when none is given."""
    if not fragment:
        return projects
    return projects.filter(F.col("name").contains(fragment))


def changed_since(projects: DataFrame, since: datetime) -> DataFrame:
    """Ids, as ``project_gid``, of projects that were modified at an instant or later."""
    changed = projects.filter(parse_instant(F.col("modified_at")) >= ntz_literal(since))
    return changed.select(F.col("gid").alias("project_gid")).distinct()


def project_directory(projects: DataFrame) -> DataFrame:
    """One line per project with its archive state spelled out."""
    state = F.when(F.col("archived").isNotNull(),
                   F.when(F.col("archived"), ARCHIVED_LABEL).otherwise(ACTIVE_LABEL))
    return projects.select(
        F.col("name").alias("project_name"),
        F.col("gid").alias("project_gid"),
        parse_instant(F.col("created_at")).alias("created_at"),
        parse_instant(F.col("modified_at")).alias("modified_at"),
        state.alias("archive_state"),
    )


def of_projects(tasks: DataFrame, projects: DataFrame) -> DataFrame:
    """Task payloads that belong to one of the given projects."""
    wanted = projects.select(F.col("gid").alias("project_gid")).distinct()
    return tasks.join(wanted, "project_gid", "left_semi")

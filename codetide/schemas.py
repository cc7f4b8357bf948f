"""Declared contracts: raw events, clean events, marts, predictions and model metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# The nested record of one raw event; every field may be missing.
RAW_EVENT = (
    "id string, type string,"
    " actor struct<id: bigint, login: string>,"
    " repo struct<id: bigint, name: string>,"
    " payload struct<action: string, size: int,"
    " forkee: struct<language: string>,"
    " pull_request: struct<base: struct<repo: struct<language: string>>>>,"
    " created_at string"
)

# The event types the analysis keeps.
PUSH = "PushEvent"
STAR = "WatchEvent"
FORK = "ForkEvent"
PULL_REQUEST = "PullRequestEvent"
TARGET_TYPES = (PUSH, STAR, FORK, PULL_REQUEST)

UNKNOWN_LANGUAGE = "Unknown"


@dataclass(frozen=True)
class TableContract:
    """Columns of a stored table, the columns it is laid out by, and its key."""

    ddl: str
    partition_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# Tables that grow with the events carry ``event_date`` as partition column, so that a
# period predicate prunes whole directories.
TABLES: dict[str, TableContract] = {
    "events_raw": TableContract(
        "event_hour int, source_file string, raw string, event_date date",
        ("event_date", "source_file"),
    ),
    # Archives that could not be read to their end: nothing of them is landed.
    "archives_quarantined": TableContract("source_file string, path string, reason string"),
    "events_parsed": TableContract(
        "event_id string, event_type string, actor_id bigint, actor_login string,"
        " repo_id bigint, repo_name string, language string, commits_count int,"
        " action string, created_at timestamp, event_date date",
        ("event_date",),
        # By repository inside a day, so that a look-up of one skips the pages of the others.
        ("repo_name", "created_at", "event_id"),
    ),
    # Days in which an event id is or was stored, so that a load finds its copies without reading the history.
    "event_days": TableContract(
        "event_id string, event_date date, id_range string",
        ("id_range",),
        ("event_id", "event_date"),
    ),
    "mart_language_activity": TableContract(
        "hour timestamp, language string, total_events bigint, unique_actors bigint,"
        " push_count bigint, star_count bigint, pr_count bigint, fork_count bigint, event_date date",
        ("event_date",),
        ("hour", "language"),
    ),
    "mart_repo_activity": TableContract(
        "hour timestamp, repo_id bigint, repo_name string, total_events bigint,"
        " unique_actors bigint, stars_gained bigint, forks_gained bigint,"
        " total_commits bigint, event_date date",
        ("event_date",),
        ("hour", "repo_id", "repo_name"),
    ),
    "mart_hourly_activity": TableContract(
        "hour timestamp, event_type string, event_count bigint, unique_users bigint,"
        " unique_repos bigint, event_date date",
        ("event_date",),
        ("hour", "event_type"),
    ),
    "ml_repo_predictions": TableContract(
        "repo_id bigint, repo_name string, language string, probability float,"
        " prediction int, label int, model string, trained_at timestamp,"
        " snapshot_date date",
        ("snapshot_date",),
        ("snapshot_date", "repo_id"),
    ),
    "ml_model_metrics": TableContract(
        "trained_at timestamp, model string, dataset_rows bigint, abandoned_share float,"
        " roc_auc float, pr_auc float, f1 float, precision float, recall float,"
        " precision_at_k float, recall_at_k float, k bigint, params string",
        (),
        ("model", "trained_at"),
    ),
}

# Tables that a user may ask for besides: what reports and snapshots read instead of events.
OPTIONAL_TABLES: dict[str, TableContract] = {
    "mart_hourly_uniques": TableContract(
        "hour timestamp, events bigint, stars bigint, forks bigint, prs bigint, pushes bigint,"
        " actor_sketch binary, repo_sketch binary, event_date date",
        ("event_date",),
        ("hour",),
    ),
    "feature_panes": TableContract(
        "pane int, repo_id bigint, actor_id bigint, repo_name string, language string, events bigint, pushes bigint,"
        " commits bigint, stars bigint, forks bigint, prs bigint, first_at timestamp, created_at timestamp, days bigint,"
        " anchor date, half_days int, pane_day date",
        ("pane_day",),
        ("repo_id", "actor_id", "pane"),
    ),
}

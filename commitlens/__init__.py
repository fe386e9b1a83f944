"""Commit-history analytics on Spark: git-log text in, DataFrames out."""

from commitlens.functions.repo_url import is_repo_url, repo_id
from commitlens.operators.blocks import assign_blocks, block_bounds
from commitlens.operators.collect import collect_ordered, collect_pieces, ordered_values
from commitlens.operators.ingest import changed_files, parse_blocks, rejects, well_formed
from commitlens.operators.intervals import interval_join
from commitlens.operators.numbering import number_rows
from commitlens.plans.bitmaps import author_bitmaps, contributors_of
from commitlens.plans.ingest import ingest_logs
from commitlens.plans.queries import (
    by_author,
    commits_per_repo,
    contributors,
    explain_sql,
    files_by_author,
    merge_commits,
    register_view,
    repositories,
    run_sql,
    sample,
    select_repos,
)
from commitlens.plans.reports import (
    active_authors,
    author_months,
    commit_activity,
    file_status_counts,
    file_status_percent,
    file_status_shares,
    overview,
    overview_long,
    top_authors,
    top_authors_with_others,
)
from commitlens.plans.rollups import approx_authors, overview_from, overview_long_from, read_rollups, rollup_of
from commitlens.schema import COMMITS_SCHEMA, PARTITION_COLUMNS, STATUS_LABELS
from commitlens.sources.commits import (
    LoadConflict,
    find_commits,
    list_repos,
    read_commits,
    read_rejects,
    replace_repo,
    replace_repos,
    versions,
)
from commitlens.sources.gitlog import log_sizes, read_blocks

__all__ = [
    "COMMITS_SCHEMA",
    "LoadConflict",
    "PARTITION_COLUMNS",
    "STATUS_LABELS",
    "active_authors",
    "approx_authors",
    "assign_blocks",
    "author_bitmaps",
    "author_months",
    "block_bounds",
    "by_author",
    "changed_files",
    "collect_ordered",
    "collect_pieces",
    "commit_activity",
    "commits_per_repo",
    "contributors",
    "contributors_of",
    "explain_sql",
    "file_status_counts",
    "file_status_percent",
    "file_status_shares",
    "files_by_author",
    "find_commits",
    "ingest_logs",
    "interval_join",
    "is_repo_url",
    "list_repos",
    "log_sizes",
    "merge_commits",
    "number_rows",
    "ordered_values",
    "overview",
    "overview_from",
    "overview_long",
    "overview_long_from",
    "parse_blocks",
    "read_blocks",
    "read_commits",
    "read_rejects",
    "read_rollups",
    "register_view",
    "rejects",
    "repo_id",
    "replace_repo",
    "replace_repos",
    "repositories",
    "rollup_of",
    "run_sql",
    "sample",
    "select_repos",
    "top_authors",
    "top_authors_with_others",
    "versions",
    "well_formed",
]

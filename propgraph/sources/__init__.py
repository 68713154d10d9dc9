"""Sources and sinks: the raw JSON snapshot, fixture views, parquet layers,
the published catalog."""

from .fixtures import Fixtures
from .layers import (commit_version, commits, current_version, differing, drop_versions, new_version, publish,
                     read_graph, read_metrics, write_layer, write_manifest)
from .raw import RAW_SCHEMA, judge_raw, parse_raw, quarantine, raw_snapshot, scan_raw

__all__ = ["Fixtures", "commit_version", "commits", "current_version", "differing", "drop_versions",
           "new_version", "read_metrics", "publish", "read_graph", "write_layer", "write_manifest", "RAW_SCHEMA", "judge_raw",
           "parse_raw", "quarantine", "raw_snapshot", "scan_raw"]

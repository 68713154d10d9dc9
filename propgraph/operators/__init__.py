"""DataFrame operators: distinct-on, order-dependent rules, extraction,
grouping, entity resolution, referential checks and table profiles."""

from .checks import assert_valid, check_graph
from .components import connected_components, star_edges
from .distinct import distinct_on
from .extract import extract_link, extract_node
from .group import group_links, group_nodes, merge_children, passthrough, population
from .profile import (column_metrics, edge_type_summary, expect_nonempty, graph_catalog, table_counts, table_digests,
                      written_catalog)
from .resolve import (person_resolution, resolve_persons, resolved_links, resolved_nodes, resolved_tables,
                      with_resolved_persons)
from .running import drop_first_occurrences, kth_occurrence, null_first_occurrence, require_order

__all__ = ["assert_valid", "check_graph", "distinct_on", "extract_link", "extract_node",
           "group_links", "group_nodes", "merge_children", "passthrough", "population",
           "edge_type_summary", "expect_nonempty", "graph_catalog", "table_counts", "table_digests",
           "drop_first_occurrences", "kth_occurrence", "null_first_occurrence", "require_order",
           "column_metrics", "written_catalog", "connected_components", "star_edges", "person_resolution", "resolve_persons", "resolved_links",
           "resolved_nodes", "resolved_tables", "with_resolved_persons"]

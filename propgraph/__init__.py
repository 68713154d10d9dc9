"""propgraph: nested package-registry records -> property graph, on Spark.

Stages (each a DataFrame plan):
  raw snapshot (name, latest JSON) -> canonical tables -> node/link tables
  -> referential checks -> merged final tables -> published tables, profiles.
"""

from .plans.graph import (Graph, GraphView, SubgraphView, build_graph, extract_subgraph,
                          group_graph)
from .plans.incremental import update_graph
from .plans.spec import GraphSpec, GroupSpec, LinkSpec, NodeSpec, package_registry_spec

__all__ = ["Graph", "GraphView", "SubgraphView", "build_graph", "extract_subgraph", "group_graph", "update_graph", "GraphSpec",
           "GroupSpec", "LinkSpec", "NodeSpec", "package_registry_spec"]

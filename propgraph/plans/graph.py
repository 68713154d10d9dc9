"""The whole pipeline: raw snapshot -> canonical -> subgraph -> final graph.

Each stage is materialized once, because it feeds many consumers (the decoded
records feed 5 canonical tables, those feed 25 extraction statements, which
feed 26 checks and 21 final tables):

* ``materialize='write'`` (default): every stage is written as parquet under
  ``layer_root/{canon,subgraph,graph}`` (default: a fresh folder in the
  cluster's shared ``spark.checkpoint.dir``) and the next stage reads the
  files. The lineage is cut at each layer, so a lost executor never forces a
  recomputation back to the JSON, and each extraction statement scans only
  the columns it needs. The JSON is decoded once and nothing is cached: all
  kinds of canonical entries are written once per record (one array column
  per kind), and each canonical table explodes and finishes its column.
* ``'persist'`` caches the stages instead (memory and disk; lost blocks are
  recomputed from a deterministic lineage); ``None`` keeps one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import SIDES, assert_valid, check_graph
from ..operators.extract import extract_link, extract_node
from ..operators.group import group_links, group_nodes
from ..operators.profile import assert_nonempty, expect_nonempty, table_counts
from ..operators.resolve import person_resolution, resolved_tables, with_resolved_persons
from ..sources.layers import (commit_version, differing, new_version, write_layer, write_manifest,
                              write_table)
from ..operators.running import require_order
from ..session import reliable_checkpoint, remove_path, scratch_path
from ..sources.raw import judge_raw, parse_raw, quarantine
from .canon import (KEYWORD_MIN_COUNT, canonical_entries, canonical_from_entries, canonicalize,
                    quarantined)
from .spec import GraphSpec, GroupSpec, package_registry_spec

QUARANTINE = "_quarantine"     # the folder of left-out records in the canonical layer
RECORDS = "records"            # the folder of the kept records' entries, beside the layers


@dataclass
class Graph:
    """The tables of one build: canonical, subgraph, check, final."""
    canon: dict[str, DataFrame]
    sub_nodes: dict[str, DataFrame]
    sub_links: dict[str, DataFrame]
    check: DataFrame
    nodes: dict[str, DataFrame]      # final node tables by group name
    links: dict[str, DataFrame]      # final link tables by group name
    spec: GraphSpec
    cached: tuple[DataFrame, ...] = ()   # persisted inputs to release (persist mode)
    layer_root: str | None = None        # where the layers were written (write mode)
    quarantine: DataFrame | None = None  # (ord, name, reason, latest) left out (on_malformed='drop')
    resolved: DataFrame | None = None    # (node_id, resolved_id) of the persons (resolve=True)

    def final_tables(self, suffix: str = "") -> dict[str, DataFrame]:
        out = {f"node_{n}{suffix}": df for n, df in self.nodes.items()}
        out.update({f"link_{n}{suffix}": df for n, df in self.links.items()})
        return out

    def counts(self) -> DataFrame:
        return table_counts(self.final_tables())

    def release(self) -> None:
        """Drop cached stages (persist mode)."""
        for df in [*self.canon.values(), *self.sub_nodes.values(), *self.sub_links.values(),
                   *self.cached]:
            df.unpersist()


def _persist(tables: dict[str, DataFrame], mode: str | None) -> dict[str, DataFrame]:
    if mode == "persist":
        return {k: v.persist(StorageLevel.MEMORY_AND_DISK) for k, v in tables.items()}
    return tables


def extract_subgraph(canon: dict[str, DataFrame], spec: GraphSpec
                     ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All node and link tables of ``spec`` from canonical tables."""
    nodes = {n: extract_node(canon[s.source], s) for n, s in spec.nodes.items()}
    links = {n: extract_link(canon[s.source], s) for n, s in spec.links.items()}
    return nodes, links


class GraphView:
    """Lazy, memoized single tables of the graph over canonical tables.

    Nothing is planned until a table is asked for, so a caller that needs one
    final table builds only its children (no 46-plan analysis up front).
    ``overrides`` gives tables by name before grouping: in the place of a
    subgraph table of that name, or as a new table the spec swaps in.
    """

    def __init__(self, canon: dict[str, DataFrame], spec: GraphSpec | None = None,
                 overrides: dict[str, DataFrame] | None = None):
        self.canon = canon
        self.spec = spec or package_registry_spec()
        self.overrides = dict(overrides or {})
        unknown = set(self.overrides) - {*self.spec.nodes, *self.spec.links,
                                         *self.spec.node_swaps.values(), *self.spec.link_swaps.values()}
        if unknown:
            raise ValueError(f"overrides of no table of the graph: {sorted(unknown)}")
        self._memo: dict[tuple[str, str], DataFrame] = {}

    def _get(self, kind: str, name: str, build) -> DataFrame:
        if (kind, name) not in self._memo:
            self._memo[(kind, name)] = build()
        return self._memo[(kind, name)]

    def sub_node(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        s = self.spec.nodes[name]
        return self._get("sub_node", name, lambda: extract_node(self.canon[s.source], s))

    def sub_link(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        s = self.spec.links[name]
        return self._get("sub_link", name, lambda: extract_link(self.canon[s.source], s))

    def _ids_unique(self, kind: str, name: str) -> bool:
        """True when the spec proves one row per id already: a single-column
        key (md5 is injective, NULL -> 'null'), or for a link a distinct key
        made of one source and one target column. Composite person keys are
        not: NULL and '' parts share an id."""
        swaps = self.spec.node_swaps if kind == "node" else self.spec.link_swaps
        if name in self.overrides or name in swaps:
            return False
        if kind == "node":
            return len(self.spec.nodes[name].keys) == 1
        s = self.spec.links[name]
        return (len(s.src_key) == 1 and len(s.dst_key) == 1 and s.src_key != s.dst_key
                and set(s.keys) == set(s.src_key + s.dst_key))

    def passes(self, kind: str, g: GroupSpec) -> bool:
        """Whether a group is its child as it is."""
        return g.select is None and self._ids_unique(kind, g.children[0])

    def node(self, group: str) -> DataFrame:
        g = self.spec.all_node_groups()[group]
        if self.passes("node", g):
            return self.sub_node(g.children[0])      # pass-through, no shuffle needed
        return self._get("node", group, lambda: group_nodes(
            [self._child("node", c) for c in g.children], g.select, g.distinct))

    def link(self, group: str) -> DataFrame:
        g = self.spec.all_link_groups()[group]
        if self.passes("link", g):
            return self.sub_link(g.children[0])
        return self._get("link", group, lambda: group_links(
            [self._child("link", c) for c in g.children], g.select, g.distinct))

    def _child(self, kind: str, name: str) -> DataFrame:
        """The table grouped for a child: its swap, if the spec has one."""
        table = (self.spec.node_swaps if kind == "node" else self.spec.link_swaps).get(name, name)
        known = self.spec.nodes if kind == "node" else self.spec.links
        if table not in self.overrides and table not in known:
            raise ValueError(f"no {kind} table {table} to group in place of {name}")
        return self.sub_node(table) if kind == "node" else self.sub_link(table)

    def sub_nodes(self) -> dict[str, DataFrame]:
        return {n: self.sub_node(n) for n in self.spec.nodes}

    def sub_links(self) -> dict[str, DataFrame]:
        return {n: self.sub_link(n) for n in self.spec.links}

    def nodes(self) -> dict[str, DataFrame]:
        return {g: self.node(g) for g in self.spec.all_node_groups()}

    def links(self) -> dict[str, DataFrame]:
        return {g: self.link(g) for g in self.spec.all_link_groups()}

    def check(self, sides: Sequence[str] = SIDES) -> DataFrame:
        return check_graph(self.sub_nodes(), self.sub_links(), self.spec.subgraphs, sides)

    def final_tables(self) -> dict[str, DataFrame]:
        return {**{f"node_{n}": df for n, df in self.nodes().items()},
                **{f"link_{n}": df for n, df in self.links().items()}}


def group_graph(sub_nodes: dict[str, DataFrame], sub_links: dict[str, DataFrame],
                spec: GraphSpec, overrides: dict[str, DataFrame] | None = None
                ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All final tables from given subgraph tables."""
    view = SubgraphView(sub_nodes, sub_links, spec, overrides)
    return view.nodes(), view.links()


class SubgraphView(GraphView):
    """A GraphView over already extracted subgraph tables."""

    def __init__(self, sub_nodes: dict[str, DataFrame], sub_links: dict[str, DataFrame],
                 spec: GraphSpec, overrides: dict[str, DataFrame] | None = None):
        super().__init__({}, spec, overrides)
        self._given = {("sub_node", n): df for n, df in sub_nodes.items()}
        self._given.update({("sub_link", n): df for n, df in sub_links.items()})
        self._memo.update(self._given)


def with_digest(raw: DataFrame, stamp: str | None = None) -> DataFrame:
    """``raw`` with ``digest``: column ``stamp`` as text, or the SHA-256 of the JSON text."""
    digest = F.sha2("latest", 256) if stamp is None else F.col(f"`{stamp}`").cast("string")
    return raw.select("ord", "name", "latest", digest.alias("digest"))


def build_graph(raw: DataFrame | None = None, canon: dict[str, DataFrame] | None = None,
                spec: GraphSpec | None = None, layer_root: str | None = None,
                validate: str = "raise", keyword_threshold: int = KEYWORD_MIN_COUNT,
                on_malformed: str = "fail", materialize: str | None = "write",
                overrides: dict[str, DataFrame] | None = None,
                keyword_buckets: int | None = None, resolve: bool = False,
                versioned: bool = False, keep_records: bool = False, stamp: str | None = None) -> Graph:
    """Build the property graph from a raw snapshot or from canonical tables.

    ``raw.ord`` must be unique and not NULL. A run on a ``layer_root`` that
    already holds layers overwrites them, or, ``versioned``, writes a version of its
    own below it, reads the final tables back, and makes the version current only
    if they hold what was written; until then readers keep the last one.

    validate: 'raise' stops on an empty canonical table or on any link end
    missing from its node table; 'report' only returns the check table.

    on_malformed: 'fail' stops on a record that violates the contract; 'drop'
    leaves it out of the graph and writes it with its reasons to
    ``canon/_quarantine`` (``Graph.quarantine``); 'keep' reads what it can.

    resolve: persons that are the same one (``operators.resolve``) become one node
    before grouping; ``resolved/person`` and ``Graph.resolved`` say which.

    keep_records: a versioned build from ``raw`` leaves the records' entries and digests
    (or ``stamp``, a column of ``raw``) beside the layers, for ``update_graph``.
    """
    spec = spec or package_registry_spec()
    if materialize not in ("write", "persist", None):
        raise ValueError(materialize)
    if validate not in ("raise", "report"):
        raise ValueError(validate)
    some = raw if raw is not None else next(iter((canon or {}).values()), None)
    if some is None:
        raise ValueError("give raw or canon")
    if materialize == "write" and layer_root is None:
        layer_root = scratch_path(some.sparkSession, "graph")
    if versioned and materialize != "write":
        raise ValueError("versions are written layers: materialize='write'")
    if keep_records and (not versioned or raw is None or resolve or overrides):
        raise ValueError("records are kept by versioned builds from raw, without overrides or resolved persons")
    root = layer_root
    if versioned:
        version, layer_root = new_version(root)

    cached: list[DataFrame] = []
    left_out = None
    if canon is None:
        require_order(raw, ["ord"])
        split = on_malformed == "drop" and materialize == "write"
        # one decode gives the canonical entries and the records left out
        given = with_digest(raw, stamp) if keep_records else raw
        parsed = judge_raw(given) if split else parse_raw(given, on_malformed)
        if materialize == "write":
            # One decode: every kind of entries per record, written once; each
            # canonical table reads its column (pruned) and explodes it.
            entries_path = f"{layer_root}/{RECORDS}/entries" if keep_records else f"{layer_root}/canon/_entries"
            keep = ("ord", "name", "digest") if keep_records else ()
            write_table(canonical_entries(parsed, keep), entries_path, "overwrite")
            entries = parsed.sparkSession.read.parquet(entries_path)
            tables = canonical_from_entries(entries, keyword_threshold, keyword_buckets, deferred=True)
            canon = write_layer({**tables, **({QUARANTINE: quarantined(entries)} if split else {})},
                                f"{layer_root}/canon")
            left_out = canon.pop(QUARANTINE, None)
            if keep_records:
                parsed.sparkSession.createDataFrame(
                    [(on_malformed, keyword_threshold, stamp or "")],
                    "on_malformed string, keyword_threshold int, stamp string").coalesce(1).write.parquet(
                        f"{layer_root}/{RECORDS}/settings")
            else:
                remove_path(parsed.sparkSession, entries_path)      # its readers are written
        elif materialize == "persist":
            parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
            canon = _persist(canonicalize(parsed, keyword_threshold, keyword_buckets), materialize)
            cached.append(parsed)
        else:
            canon = canonicalize(parsed, keyword_threshold, keyword_buckets)
        if on_malformed == "drop" and left_out is None:
            left_out = quarantine(raw)
    if validate == "raise":
        assert_nonempty(expect_nonempty(canon))
    sub_nodes, sub_links = extract_subgraph(canon, spec)
    if materialize == "write":
        sub = write_layer({**{f"node/{n}": df for n, df in sub_nodes.items()},
                           **{f"link/{n}": df for n, df in sub_links.items()}},
                          f"{layer_root}/subgraph")
        sub_nodes = {n: sub[f"node/{n}"] for n in sub_nodes}
        sub_links = {n: sub[f"link/{n}"] for n in sub_links}
    else:
        sub_nodes, sub_links = _persist(sub_nodes, materialize), _persist(sub_links, materialize)
    check = check_graph(sub_nodes, sub_links, spec.subgraphs)
    if validate == "raise":
        assert_valid(check)
    resolved = None
    if resolve:
        view = SubgraphView(sub_nodes, sub_links, spec)
        resolved = (write_layer({"person": person_resolution(view)}, f"{layer_root}/resolved")["person"]
                    if materialize == "write" else reliable_checkpoint(person_resolution(view)))
        overrides = {**resolved_tables(view, resolved), **(overrides or {})}
        spec = with_resolved_persons(spec)
    nodes, links = group_graph(sub_nodes, sub_links, spec, overrides)
    g = Graph(canon, sub_nodes, sub_links, check, nodes, links, spec)
    g.cached = tuple(cached)
    g.quarantine, g.resolved = left_out, resolved
    if materialize == "write":
        names = g.final_tables("_final")
        metrics: dict[str, dict] = {}
        final = write_layer(names, f"{layer_root}/graph", metrics=metrics)
        g.nodes = {n: final[f"node_{n}_final"] for n in nodes}
        g.links = {n: final[f"link_{n}_final"] for n in links}
        write_manifest(some.sparkSession, {n.removesuffix("_final"): n for n in names},
                       f"{layer_root}/graph", metrics)
        g.layer_root = layer_root
        if versioned:
            wrong = differing(some.sparkSession, f"{layer_root}/graph")
            if wrong:
                raise RuntimeError(f"tables that do not read back as written: {wrong}")
            commit_version(some.sparkSession, root, version)
    return g

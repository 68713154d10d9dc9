"""The graph described as data: which canonical table each node and link table
comes from, its natural key, attributes and row filter, and how subgraph
tables merge into final tables.

Columns are built lazily (functions returning Columns), because a Column
needs a live session.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import not_blank, not_both_blank, to_int
from ..functions.predicates import equals

# --- fixed values -----------------------------------------------------------
UNKNOWN = "UNKNOWN"                                # placeholder text in registry fields
NON_LICENSES = ("UNKNOWN", "LICENSE.txt")          # license texts that are no license
# -----------------------------------------------------------------------------

ColumnFn = Callable[[], Column]
# An attribute is (output name, source column name or a Column builder).
Attr = tuple[str, "str | ColumnFn"]


def attr_column(attr: Attr) -> Column:
    """The Column of one attribute, aliased to its output name."""
    name, src = attr
    c = F.col(src) if isinstance(src, str) else src()
    return c.alias(name)


@dataclass(frozen=True)
class NodeSpec:
    """A node table: source table, natural key, attributes, row filter.

    ``determined``: the key fixes the attributes in the source (a URL its
    parts, a domain its top-level domain), so a distinct of both is one row per
    key; otherwise one row is picked per key.
    """
    name: str
    source: str
    keys: tuple[str, ...]
    attrs: tuple[Attr, ...]
    where: ColumnFn | None = None
    determined: bool = False


@dataclass(frozen=True)
class LinkSpec:
    """A link table: distinct key (link_id), from and to keys, attributes, filter."""
    name: str
    source: str
    keys: tuple[str, ...]        # distinct key; link_id = id(keys)
    src_key: tuple[str, ...]     # from_id = id(src_key)
    dst_key: tuple[str, ...]     # to_id = id(dst_key)
    attrs: tuple[Attr, ...] = ()
    where: ColumnFn | None = None


@dataclass(frozen=True)
class GroupSpec:
    """A final table made of subgraph tables.

    ``select`` builds the output columns over the merged row, where child i
    (1-based, in ``children`` order) is the struct column ``t{i}`` and the
    key columns are plain columns. ``distinct``: one row per key; otherwise
    the rows of the key-population left-joined with every child are kept with
    their multiplicity. No ``select`` means pass-through of one child.
    """
    children: tuple[str, ...]
    select: Callable[[], list[Column]] | None = None
    distinct: bool = True


@dataclass(frozen=True)
class GraphSpec:
    """The whole graph: node and link specs, link ends, and groups."""
    inputs: tuple[str, ...]
    nodes: dict[str, NodeSpec]
    links: dict[str, LinkSpec]
    subgraphs: dict[str, tuple[str, str]]          # link -> (source node, target node)
    node_groups: dict[str, GroupSpec] = field(default_factory=dict)
    link_groups: dict[str, GroupSpec] = field(default_factory=dict)
    node_swaps: dict[str, str] = field(default_factory=dict)   # child -> table grouped in its place
    link_swaps: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        used = {n for pair in self.subgraphs.values() for n in pair}
        if set(self.nodes) != used:
            raise ValueError(f"node specs {sorted(self.nodes)} != subgraph nodes {sorted(used)}")
        if set(self.links) != set(self.subgraphs):
            raise ValueError(f"link specs {sorted(self.links)} != subgraph links {sorted(self.subgraphs)}")
        for kind, groups, members in (("node", self.node_groups, self.nodes),
                                      ("link", self.link_groups, self.links)):
            for g, spec in groups.items():
                for child in spec.children:
                    if child not in members:
                        raise ValueError(f"{kind} group {g}: unknown child {child}")
                if spec.select is None and len(spec.children) != 1:
                    raise ValueError(f"{kind} group {g}: several children need a select list")
        for s in list(self.nodes.values()) + list(self.links.values()):
            if s.source not in self.inputs:
                raise ValueError(f"{s.name}: unknown input {s.source}")

    # Members of no group become a group of their own (pass-through).
    def all_node_groups(self) -> dict[str, GroupSpec]:
        out = dict(self.node_groups)
        taken = {c for g in self.node_groups.values() for c in g.children}
        for n in self.nodes:
            if n not in taken:
                out[n] = GroupSpec(children=(n,))
        return out

    def all_link_groups(self) -> dict[str, GroupSpec]:
        out = dict(self.link_groups)
        taken = {c for g in self.link_groups.values() for c in g.children}
        for n in self.links:
            if n not in taken:
                out[n] = GroupSpec(children=(n,))
        return out

    def triplets(self) -> dict[str, tuple[str, str]]:
        """Final link -> (final source, final target), by its first child's ends."""
        home = {c: g for g, spec in self.all_node_groups().items() for c in spec.children}
        ends = {g: self.subgraphs[spec.children[0]] for g, spec in self.all_link_groups().items()}
        return {g: (home[src], home[dst]) for g, (src, dst) in ends.items()}

    def with_swap(self, kind: str, child: str, table: str) -> GraphSpec:
        """Group ``table`` (any name: another subgraph table, or one given to
        ``build_graph`` as an override) in the place of ``child``. Groups, final
        tables and link ends stay as they are."""
        if child not in (self.nodes if kind == "node" else self.links):
            raise ValueError(f"no {kind} table {child}")
        which = f"{kind}_swaps"
        return replace(self, **{which: {**getattr(self, which), child: table}})


def with_group_select(spec: GraphSpec, kind: str, group: str,
                      select: Callable[[], list[Column]]) -> GraphSpec:
    """The same graph with another select list for one group."""
    which = f"{kind}_groups"
    groups = dict(getattr(spec, which))
    return replace(spec, **{which: {**groups, group: replace(groups[group], select=select)}})


def _coalesce(*cols: str) -> Column:
    return F.coalesce(*[F.col(c) for c in cols])


def _person_ok() -> Column:
    return not_both_blank("person_name", "email_record")


def _role(role: str) -> ColumnFn:
    return lambda: _person_ok() & equals("role", role)


def _url_ok() -> Column:
    return not_blank("url", UNKNOWN)


def _license_ok() -> Column:
    return not_blank("license", *NON_LICENSES)


PERSON_KEY = ("person_name", "email_record")


def package_registry_spec() -> GraphSpec:
    """The package-registry property graph (9 final node and 12 final link tables)."""
    # --- fixed values: tables, keys, attributes, filters, link ends, groups ---
    nodes = [
        NodeSpec("package", "latest_package", ("pkg_name",),
                 (("name", "name"), ("package_url", "package_url"),
                  ("requires_python", "requires_python"), ("version", "version"),
                  ("num_releases", lambda: to_int("num_releases")))),
        NodeSpec("requirement", "latest_requirement", ("required_pkg_name",),
                 (("name", "required_pkg_name"),)),
        NodeSpec("author", "latest_email", PERSON_KEY,
                 (("name", "person_name"), ("email", "email_record")), _role("author")),
        NodeSpec("maintainer", "latest_email", PERSON_KEY,
                 (("name", "person_name"), ("email", "email_record")), _role("maintainer")),
        NodeSpec("license", "latest_package", ("license",), (("name", "license"),), _license_ok),
        NodeSpec("keyword", "latest_keyword", ("keyword",), (("keyword", "keyword"),),
                 lambda: not_blank("keyword")),
        NodeSpec("email", "latest_email", ("email",),
                 (("email", "email"), ("domain", "domain"), ("top_level_domain", "top_level_domain")),
                 lambda: not_blank("email"), determined=True),
        NodeSpec("url", "latest_url", ("url",),
                 (("url", "url"), ("domain", "domain"), ("top_level_domain", "top_level_domain"),
                  ("path", "path")), _url_ok, determined=True),
        NodeSpec("email_domain", "latest_email", ("domain",),
                 (("domain", "domain"), ("top_level_domain", "top_level_domain")),
                 lambda: not_blank("domain"), determined=True),
        NodeSpec("url_domain", "latest_url", ("domain",),
                 (("domain", "domain"), ("top_level_domain", "top_level_domain")),
                 lambda: not_blank("domain", UNKNOWN), determined=True),
        NodeSpec("github_repo", "latest_url", ("github_repo",), (("github_repo", "github_repo"),),
                 lambda: not_blank("github_repo")),
        NodeSpec("github_account", "latest_url", ("github_account",),
                 (("github_account", "github_account"),), lambda: not_blank("github_account")),
    ]
    links = [
        LinkSpec("has_requirement", "latest_requirement", ("pkg_name", "required_pkg_name"),
                 ("pkg_name",), ("required_pkg_name",),
                 (("num_match_dist", lambda: to_int("num_match_dist")),
                  ("newest_dist", "newest_dist"), ("oldest_dist", "oldest_dist"),
                  ("requirement_string", "requirement_string"))),
        LinkSpec("has_keyword", "latest_keyword", ("pkg_name", "keyword"), ("pkg_name",),
                 ("keyword",), where=lambda: not_blank("keyword")),
        LinkSpec("has_author", "latest_email", ("pkg_name",) + PERSON_KEY, ("pkg_name",),
                 PERSON_KEY, where=_role("author")),
        LinkSpec("has_maintainer", "latest_email", ("pkg_name",) + PERSON_KEY, ("pkg_name",),
                 PERSON_KEY, where=_role("maintainer")),
        LinkSpec("author_has_email", "latest_email", PERSON_KEY + ("email",), PERSON_KEY,
                 ("email",), where=lambda: _role("author")() & not_blank("email")),
        LinkSpec("maintainer_has_email", "latest_email", PERSON_KEY + ("email",), PERSON_KEY,
                 ("email",), where=lambda: _role("maintainer")() & not_blank("email")),
        LinkSpec("has_license", "latest_package", ("pkg_name", "license"), ("pkg_name",),
                 ("license",), where=_license_ok),
        LinkSpec("has_url", "latest_url", ("pkg_name", "url"), ("pkg_name",), ("url",),
                 (("url_type", "url_type"),), where=_url_ok),
        LinkSpec("released_from", "latest_url", ("pkg_name", "github_repo"), ("pkg_name",),
                 ("github_repo",), where=lambda: not_blank("github_repo")),
        LinkSpec("released_by", "latest_url", ("pkg_name", "github_account"), ("pkg_name",),
                 ("github_account",), where=lambda: not_blank("github_account")),
        LinkSpec("owned_by", "latest_url", ("github_repo", "github_account"), ("github_repo",),
                 ("github_account",),
                 where=lambda: not_blank("github_repo") & not_blank("github_account")),
        # url '' is not excluded here (unlike the url node): kept as specified.
        LinkSpec("url_hosted_by", "latest_url", ("url", "domain"), ("url",), ("domain",),
                 where=lambda: F.col("url").isNotNull()
                 & ~F.coalesce(F.col("url") == UNKNOWN, F.lit(False)) & not_blank("domain")),
        LinkSpec("email_hosted_by", "latest_email", ("email", "domain"), ("email",), ("domain",),
                 where=lambda: not_blank("email_record") & not_blank("email") & not_blank("domain")),
    ]
    subgraphs = {
        "has_requirement": ("package", "requirement"),
        "has_author": ("package", "author"),
        "has_maintainer": ("package", "maintainer"),
        "has_license": ("package", "license"),
        "has_url": ("package", "url"),
        "has_keyword": ("package", "keyword"),
        "author_has_email": ("author", "email"),
        "maintainer_has_email": ("maintainer", "email"),
        "email_hosted_by": ("email", "email_domain"),
        "url_hosted_by": ("url", "url_domain"),
        "released_by": ("package", "github_account"),
        "released_from": ("package", "github_repo"),
        "owned_by": ("github_repo", "github_account"),
    }
    node_groups = {
        "package": GroupSpec(("package", "requirement"), lambda: [
            F.col("node_id"), _coalesce("t1.name", "t2.name").alias("name"),
            F.col("t1.package_url").alias("package_url"),
            F.col("t1.requires_python").alias("requires_python"),
            F.col("t1.version").alias("version"),
            F.col("t1.num_releases").alias("num_releases")]),
        "person": GroupSpec(("author", "maintainer"), lambda: [
            F.col("node_id"), _coalesce("t1.name", "t2.name").alias("name"),
            _coalesce("t1.email", "t2.email").alias("email")]),
        "domain": GroupSpec(("email_domain", "url_domain"), lambda: [
            F.col("node_id"), _coalesce("t1.domain", "t2.domain").alias("domain"),
            _coalesce("t1.top_level_domain", "t2.top_level_domain").alias("top_level_domain")]),
    }
    link_groups = {
        # link_id comes from the author child only (NULL for maintainer-only
        # links), and twins are kept: see has_email_select() for the other form.
        "has_email": GroupSpec(("author_has_email", "maintainer_has_email"),
                               has_email_select(parity=True), distinct=False),
    }
    # --------------------------------------------------------------------------
    return GraphSpec(
        inputs=("latest_package", "latest_requirement", "latest_url", "latest_keyword",
                "latest_email"),
        nodes={n.name: n for n in nodes}, links={l.name: l for l in links},
        subgraphs=subgraphs, node_groups=node_groups, link_groups=link_groups)


def has_email_select(parity: bool = True) -> Callable[[], list[Column]]:
    """parity=True: link_id of the author child (NULL for maintainer-only
    links); parity=False: the first non-NULL link_id of the children."""
    if parity:
        return lambda: [F.col("t1.link_id").alias("link_id"), F.col("from_id"), F.col("to_id")]
    return lambda: [_coalesce("t1.link_id", "t2.link_id").alias("link_id"),
                    F.col("from_id"), F.col("to_id")]

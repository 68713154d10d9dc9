"""Table-level profiles: row counts, the non-empty guard, the edge-type
summary and the catalog of the published graph. Each table is reduced by one
aggregate (partial on the map side) and the tiny results are unioned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_COLUMNS = {"node": ("node_id",), "link": ("link_id", "from_id", "to_id")}


def table_counts(tables: dict[str, DataFrame], label: str = "table") -> DataFrame:
    """(label, n_rows) per table, one partial aggregate each."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias(label), "n_rows")
        for n, df in tables.items()])


def _row_digest(cols: list[str]) -> Column:
    """md5 of a row's text: every column as text (``<null>`` for NULL), each ended by U+001F."""
    return F.md5(F.concat(*[x for c in cols for x in (
        F.coalesce(F.col(c).cast("string"), F.lit("<null>")), F.lit("\x1f"))]))


def column_metrics(df: DataFrame) -> list[Column]:
    """Aggregates that describe a table: ``n_rows``, the order-free ``digest_sum`` and
    ``digest_xor`` of ``table_digests``, and ``n_values.<column>``, the values that are
    not NULL. They can be observed while the table is written."""
    h = _row_digest(sorted(df.columns))
    return [F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.conv(F.substring(h, 1, 8), 16, 10).cast("long")).alias("digest_sum"),
            F.bit_xor(F.conv(F.substring(h, 9, 15), 16, 10).cast("long")).alias("digest_xor"),
            *[F.count(F.col(c)).alias(f"n_values.{c}") for c in df.columns]]


def table_digests(tables: dict[str, DataFrame], label: str = "table") -> DataFrame:
    """(label, n_rows, digest_sum, digest_xor) per table: an order-free digest
    of all rows and columns, from one partial aggregate each. The sum is over
    the first 32 bits of each row's md5, the xor over the next 60."""
    def one(name: str, df: DataFrame) -> DataFrame:
        bits = df.select(_row_digest(sorted(df.columns)).alias("h")).select(
            F.conv(F.substring("h", 1, 8), 16, 10).cast("long").alias("a"),
            F.conv(F.substring("h", 9, 15), 16, 10).cast("long").alias("b"))
        return bits.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("a"), F.lit(0)).alias("digest_sum"),
                        F.coalesce(F.bit_xor("b"), F.lit(0)).cast("long").alias("digest_xor")).select(
            F.lit(name).alias(label), "n_rows", "digest_sum", "digest_xor")
    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def expect_nonempty(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, ok); ``ok`` is False for an empty table."""
    return table_counts(tables).withColumn("ok", F.col("n_rows") > 0)


def assert_nonempty(report: DataFrame) -> None:
    """Raise if any table of an ``expect_nonempty`` report has no rows."""
    empty = [r.table for r in report.where(~F.col("ok")).select("table").collect()]
    if empty:
        raise AssertionError(f"empty tables: {empty}")


def edge_type_summary(links: dict[str, DataFrame],
                      triplets: dict[str, tuple[str, str]]) -> DataFrame:
    """Per final link type: source and target node type, rows, distinct ends.

    Every end is counted once per (link, side, id), combined map-side, and the
    counts are summed per (link, side): no row is tripled as two distinct counts in
    one aggregate would do.
    """
    ends = reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("link"), "from_id", "to_id") for n, df in links.items()])
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("id")) for s in ("from_id", "to_id")]))
    each = ends.select("link", sides.alias("e")).groupBy("link", "e.side", "e.id").agg(F.count(F.lit(1)).alias("n"))
    source = F.col("side") == "from_id"
    counts = each.groupBy("link").agg(
        F.sum(F.when(source, F.col("n"))).alias("n_links"),
        F.count(F.when(source, F.col("id"))).alias("n_sources"),
        F.count(F.when(~source, F.col("id"))).alias("n_targets"))
    labels = ends.sparkSession.createDataFrame(
        [(l, s, t) for l, (s, t) in triplets.items() if l in links],
        "link string, source string, target string")
    return labels.join(counts, "link", "left").select(
        "link", "source", "target",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("n_links", "n_sources", "n_targets")])


def graph_type(dt: T.DataType) -> str:
    """Graph-server attribute type of a column type."""
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "String"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "Int"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "Double"
    raise KeyError(f"no graph type for {dt.simpleString()}")


def _table_profile(df: DataFrame, kind: str, label: str, table: str,
                   src: str | None, dst: str | None) -> DataFrame:
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column"), F.lit(graph_type(df.schema[c].dataType)).alias("type"),
                        F.lit(c not in ID_COLUMNS[kind]).alias("attribute"),
                        F.lit(i).alias("position"), F.col(f"_c{i}").alias("n_values"))
               for i, c in enumerate(cols)]
    return (agg.select("_n", F.explode(F.array(*entries)).alias("e"))
               .select(F.lit(kind).alias("kind"), F.lit(label).alias("label"),
                       F.lit(table).alias("table"), F.lit(src).cast("string").alias("from"),
                       F.lit(dst).cast("string").alias("to"), "e.column", "e.type",
                       "e.attribute", F.col("e.position").cast("int").alias("position"),
                       F.col("_n").alias("n_rows"),
                       (F.col("_n") - F.col("e.n_values")).alias("n_nulls")))


def written_catalog(nodes: dict[str, DataFrame], links: dict[str, DataFrame], triplets: dict[str, tuple[str, str]],
                    metrics: dict[str, dict[str, int]]) -> DataFrame:
    """``graph_catalog`` of written tables from the metrics taken while they were
    written (``sources.read_metrics``): no data file is read."""
    rows = []
    for kind, tables in (("node", nodes), ("link", links)):
        for n, df in tables.items():
            ends = triplets[n] if kind == "link" else (None, None)
            m = metrics[f"{kind}_{n}"]
            rows += [(kind, n, f"{kind}_{n}", *ends, c, graph_type(df.schema[c].dataType), c not in ID_COLUMNS[kind], i,
                      m["n_rows"], m["n_rows"] - m[f"n_values.{c}"]) for i, c in enumerate(df.columns)]
    spark = next(iter({**nodes, **links}.values())).sparkSession
    return spark.createDataFrame(rows, "kind string, label string, table string, from string, to string, column string, "
                                       "type string, attribute boolean, position int, n_rows bigint, n_nulls bigint")


def graph_catalog(nodes: dict[str, DataFrame], links: dict[str, DataFrame],
                  triplets: dict[str, tuple[str, str]]) -> DataFrame:
    """Every column of every published table: type, whether it is an attribute
    (ids are not), row and NULL counts; links carry their end types."""
    parts = [_table_profile(df, "node", n, f"node_{n}", None, None) for n, df in nodes.items()]
    parts += [_table_profile(df, "link", n, f"link_{n}", *triplets[n]) for n, df in links.items()]
    return reduce(DataFrame.unionByName, parts)

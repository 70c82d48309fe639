"""Display data of the call graph (G13, G14): edges without noise callees, node
labels and group packages, one colour per package. Rendering itself is not built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import with_group_position


def view_edges(calls: DataFrame) -> DataFrame:
    return calls.filter(~N.is_noise_method(N.method_of("callee"))).select("project", "caller", "callee")


def view_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = (nodes.select("project", F.col("caller").alias("node"))
         .unionByName(edges.select("project", F.col("callee").alias("node"))).distinct())
    return n.select("project", "node", N.simplify_name("node").alias("label"),
                    N.group_package("node").alias("group_package"))


def package_palette(view_nodes_df: DataFrame, palette: list[str] | None = None) -> DataFrame:
    """Colour by dense rank of the package (cyclic). The package dimension is ranked
    with the range-sorted index, not a single-partition window."""
    pal = palette or N.PALETTE_10
    pk = view_nodes_df.select("project", F.col("group_package").alias("package")).distinct()
    r = with_group_position(pk, ["project"], ["package"], "_r")
    colors = F.array(*[F.lit(c) for c in pal])
    return r.select("project", "package",
                    F.element_at(colors, (F.pmod(F.col("_r"), F.lit(len(pal))) + 1).cast("int")).alias("color"))

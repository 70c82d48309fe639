"""Shared, lazily built tables of one analysis run over a driver-table directory.

The code model (methods, invocations, call graph, coupling) is built once per
(session, directory) and persisted, the way a Spark user keeps the ``coupling``
table around for the many reports that read it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.operators import coupling as C
from callweave.operators import resolve as R
from callweave.sources import fixtures as FX

_CONTEXTS: dict[tuple[int, str], "Analysis"] = {}


def _keep(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class Analysis:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # --- code model -------------------------------------------------------
    @cached_property
    def methods(self) -> DataFrame:
        return _keep(FX.fixture_methods(self.spark, self.sf_dir))

    @cached_property
    def classes(self) -> DataFrame:
        return FX.fixture_classes(self.methods)

    @cached_property
    def invocations(self) -> DataFrame:
        return _keep(FX.fixture_invocations(self.spark, self.sf_dir, self.methods))

    @cached_property
    def nodes(self) -> DataFrame:
        """Call-graph nodes: every declared method is a caller."""
        return self.methods.select("project", F.col("method_fqn").alias("caller"))

    # --- front end 1 (untyped) -------------------------------------------
    @cached_property
    def calls(self) -> DataFrame:
        return _keep(R.resolve_global(self.invocations, self.methods))

    @cached_property
    def calls_sequential(self) -> DataFrame:
        return R.resolve_sequential(self.invocations, self.methods)

    @cached_property
    def coupling(self) -> DataFrame:
        # the pair counts are written once so the total and the weights read them
        # instead of re-running the class lookup and distinct count
        from callweave.session import materialize
        counts = materialize(C.coupling_undirected(self.calls, self.nodes), "coupling_counts")
        return _keep(C.coupling_weights(counts))

    # --- front end 2 (typed) ---------------------------------------------
    @cached_property
    def typed_methods(self) -> DataFrame:
        return FX.fixture_typed_methods(self.methods)

    @cached_property
    def typed_calls(self) -> DataFrame:
        from callweave.sources.typed import typed_calls
        return _keep(typed_calls(FX.fixture_typed_invocations(self.invocations), self.typed_methods))

    @cached_property
    def coupling_directed(self) -> DataFrame:
        from callweave.session import materialize
        counts = materialize(C.coupling_directed(self.typed_calls), "coupling_directed_counts")
        return _keep(C.coupling_weights(counts))


    @cached_property
    def receiver_types(self) -> DataFrame:
        from callweave.session import materialize
        from callweave.sources.typed import receiver_types
        exprs = FX.fixture_expressions(self.invocations)[0]
        return materialize(receiver_types(exprs, FX.fixture_members(self.methods), FX.fixture_locals(self.methods)), "receiver_types")

    # --- clustering ----------------------------------------------------------
    @cached_property
    def dendro(self) -> DataFrame:
        from callweave.operators.cluster import dendrogram
        from callweave.session import materialize
        pairs = self.coupling.select("project", "a", "b", F.col("n_calls").alias("n"))
        return materialize(dendrogram(pairs), "dendrogram")

    @cached_property
    def cut(self) -> dict:
        from callweave.operators.modules import cut
        return cut(self.dendro, QUERY_CP)

    @cached_property
    def dendro_directed(self) -> DataFrame:
        from callweave.operators.cluster import dendrogram
        from callweave.session import materialize
        folded = C.fold_directed(self.coupling_directed).select("project", "a", "b", F.col("n_calls").alias("n"))
        totals = C.coupling_total(self.coupling_directed)
        return materialize(dendrogram(folded, totals), "dendrogram_directed")

    @cached_property
    def cut_directed(self) -> dict:
        from callweave.operators.modules import cut
        return cut(self.dendro_directed, QUERY_CP_DIRECTED)


    # --- extraction job over rendered sources ---------------------------------
    @cached_property
    def bodies(self) -> DataFrame:
        """The calls of every method, as text: written once for all that renders sources."""
        from callweave.session import materialize
        from callweave.sources.render import method_bodies
        return materialize(method_bodies(self.invocations), "method_bodies")

    @cached_property
    def facts(self) -> DataFrame:
        from callweave.session import materialize
        from callweave.sources.extract import extract_facts
        from callweave.sources.render import render_sources
        return materialize(extract_facts(render_sources(self.methods, self.bodies)), "facts")


    # --- many projects -----------------------------------------------------------
    @cached_property
    def corpus_methods(self) -> DataFrame:
        from callweave.sources.corpus import corpus_methods
        return _keep(corpus_methods(self.spark, self.sf_dir))

    @cached_property
    def corpus_calls(self) -> DataFrame:
        # written, not kept: at scale the memory goes to the steps, which else would spill
        from callweave.session import materialize
        from callweave.sources.corpus import corpus_invocations
        inv = materialize(corpus_invocations(self.spark, self.sf_dir, self.corpus_methods), "corpus_invocations")
        return materialize(R.resolve_global(inv, self.corpus_methods), "corpus_calls")

    @cached_property
    def corpus_weights(self) -> DataFrame:
        from callweave.session import materialize
        nodes = self.corpus_methods.select("project", F.col("method_fqn").alias("caller"))
        counts = materialize(C.coupling_undirected(self.corpus_calls, nodes), "corpus_counts")
        return _keep(C.coupling_weights(counts))

    @cached_property
    def corpus_dendrogram(self) -> DataFrame:
        from callweave.operators.cluster import dendrogram
        from callweave.session import materialize
        pairs = self.corpus_weights.select("project", "a", "b", F.col("n_calls").alias("n"))
        return materialize(dendrogram(pairs), "corpus_dendrogram")

    # --- the same from files in the shared folder, one per class ----------------
    @cached_property
    def scanned(self) -> DataFrame:
        from callweave.session import work_path
        from callweave.sources.extract import scan_sources, with_file_order
        from callweave.sources.render import write_class_files
        root = work_path(self.spark, "scan") + "/sources"
        write_class_files(self.methods, self.bodies, root)
        found = scan_sources(self.spark, root, None, "*.txt")
        return with_file_order(found.withColumn("project", F.regexp_replace("project", "^folder=", "")))

    @cached_property
    def scanned_facts(self) -> DataFrame:
        from callweave.session import materialize
        from callweave.sources.extract import extract_facts
        return materialize(extract_facts(self.scanned), "scanned_facts")

    @cached_property
    def facts_entry(self) -> DataFrame:
        from callweave.session import materialize
        from callweave.sources.extract import extract_facts
        from callweave.sources.render import render_entry_sources
        return materialize(extract_facts(render_entry_sources(self.methods), identifiers=True), "facts_entry")


# CP used by the registered module queries (the tool's slider; 0.1 leaves no module
# on graphs with thousands of pairs because weights are fractions of the total).
QUERY_CP = 0.0005
# the same for the directed counts, whose weights are smaller
QUERY_CP_DIRECTED = 0.0002
# threshold of the registered edge queries (the tool's default of 0.001 leaves no edge here)
QUERY_MIN_WEIGHT = 0.0002


def analysis(spark: SparkSession, sf_dir: str) -> Analysis:
    key = (id(spark), sf_dir)
    a = _CONTEXTS.get(key)
    if a is None or a.spark is not spark:
        a = Analysis(spark, sf_dir)
        _CONTEXTS[key] = a
    return a

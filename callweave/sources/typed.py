"""Second (typed) front end, S16-S17: calls whose declaring type is known.

typed invocations: (project, class_fqn, caller, declaring_class, callee_simple
[, receiver_type]). System classes are dropped on both sides; when the declaring
type is missing the receiver's static type stands in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import split_join
from callweave.session import materialize


def typed_calls(typed_invocations: DataFrame, typed_methods: DataFrame | None = None) -> DataFrame:
    inv = typed_invocations
    if "receiver_type" not in inv.columns:
        inv = inv.withColumn("receiver_type", F.lit(None).cast("string"))
    inv = inv.filter(~N.is_system_class("class_fqn"))
    decl = F.when(F.col("declaring_class").isNotNull() & ~N.is_system_class("declaring_class"),
                  F.concat_ws(".", "declaring_class", "callee_simple"))
    recv = F.when(F.col("declaring_class").isNull() & F.col("receiver_type").isNotNull()
                  & ~N.is_system_class("receiver_type"),
                  F.concat_ws(".", "receiver_type", "callee_simple"))
    return (inv.select("project", "caller", F.coalesce(decl, recv).alias("callee"))
            .filter(F.col("callee").isNotNull())
            .distinct())


def receiver_types(exprs: DataFrame, members: DataFrame, variables: DataFrame) -> DataFrame:
    """(project, expr_id, type_fqn): static types of receiver expressions, S17.

    exprs (project, expr_id, receiver_id, kind, name, scope, class_fqn): one row per expression, ``receiver_id``
    the expression it is applied to.  Kinds: ``this``; ``name`` (a local variable of the method
    ``scope``, else a field of ``class_fqn``); ``field`` and ``call`` (a member of the receiver's type, or of
    ``class_fqn`` without a receiver).  members (project, class_fqn, kind, name, type_fqn): fields with their
    types and methods with their return types.  variables (project, scope, name, type_fqn).

    Types are propagated along receivers by joins: a round types every expression whose receiver was
    typed in the one before, so rounds are as many as the longest chain is long.  Expressions
    whose type isn't known have no row; what depends on them leaves the rounds."""
    member = members.select("project", F.col("class_fqn").alias("owner"), "kind", "name", "type_fqn")
    roots = materialize(exprs.filter(F.col("receiver_id").isNull()), "root_exprs")
    this = roots.filter("kind = 'this'").select("project", "expr_id", F.col("class_fqn").alias("type_fqn"))
    # what a split join or a later step reads more than once is written, not joined again
    named = split_join(roots.filter("kind = 'name'"), variables.withColumnRenamed("type_fqn", "_local"), ["project", "scope", "name"])
    named = materialize(named, "named_exprs")
    own = named.filter("_local IS NULL").drop("_local").withColumn("kind", F.lit("field")) \
        .unionByName(roots.filter("kind IN ('field', 'call')"))
    own = split_join(own.withColumnRenamed("class_fqn", "owner"), member, ["project", "owner", "kind", "name"], "inner")
    typed = materialize(this.unionByName(named.filter("_local IS NOT NULL").select("project", "expr_id", F.col("_local").alias("type_fqn")))
                        .unionByName(own.select("project", "expr_id", "type_fqn")), "types")
    done, waiting = [typed], materialize(exprs.filter("receiver_id IS NOT NULL AND kind IN ('field', 'call')")
                                           .select("project", "expr_id", "receiver_id", "kind", "name"), "chained_exprs")
    while not typed.isEmpty() and not waiting.isEmpty():
        owners = typed.select("project", F.col("expr_id").alias("receiver_id"), F.col("type_fqn").alias("owner"))
        # applied to an expression of this round: tried now, with or without a result
        met = materialize(waiting.join(owners.withColumn("_met", F.lit(True)), ["project", "receiver_id"], "left"), "met_exprs")
        ready = met.filter("_met").select("project", "expr_id", "kind", "name", "owner")
        typed = materialize(split_join(ready, member, ["project", "owner", "kind", "name"], "inner")
                            .select("project", "expr_id", "type_fqn"), "types")
        waiting = met.filter("_met IS NULL").drop("owner", "_met")
        done.append(typed)
    return reduce(DataFrame.unionByName, done)


def typed_nodes(typed_methods: DataFrame) -> DataFrame:
    """Methods of non-system classes are graph nodes even without calls."""
    return (typed_methods.filter(~N.is_system_class("class_fqn"))
            .select("project", F.col("method_fqn").alias("caller")).distinct())

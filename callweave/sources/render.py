"""Java text rendered from the code-model tables (round-trip fixture for the extractor).

One compilation unit per method (``<package>/<Class>/<method_ord>.java``) plus one
per class holding its fields. The unit of a group is one method body, never a
whole class, so no task gathers a class with millions of methods. The method
header, ``loc - 2`` blank lines and the closing brace span exactly ``loc`` lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def method_bodies(invocations: DataFrame) -> DataFrame:
    """(project, method_ord, body): the calls of each method that has any, once each, in order."""
    return invocations.groupBy("project", "method_ord").agg(F.array_join(F.sort_array(F.collect_set(
        F.concat("callee_simple", F.lit("();")))), " ").alias("body"))


def render_sources(methods: DataFrame, bodies: DataFrame) -> DataFrame:
    """(project, path, text) rows; ``bodies`` as ``method_bodies`` gives them."""
    m = methods.join(bodies, ["project", "method_ord"], "left")
    params = F.array_join(F.transform(F.sequence(F.lit(0), F.col("params") - 1),
                                      lambda i: F.concat(F.lit("int a"), i.cast("string"))), ", ")
    params = F.when(F.col("params") > 0, params).otherwise(F.lit(""))
    body = F.coalesce("body", F.lit(""))
    head = F.concat(F.lit("  void "), F.col("method"), F.lit("("), params, F.lit(") {"))
    one_line = F.concat(head, F.lit(" "), body, F.lit(" }"))
    multi = F.concat(head, F.lit(" "), body, F.lit("\n"), F.expr("repeat('\\n', greatest(loc - 2, 0))"), F.lit("  }"))
    method_text = F.when(F.col("loc") <= 1, one_line).otherwise(multi)
    unit = F.concat(F.lit("package "), F.col("package"), F.lit(";\n\nclass "), F.col("class_name"), F.lit(" {\n"),
                    method_text, F.lit("\n}\n"))
    files = m.select("project", F.concat_ws("/", "package", "class_name",
                                            F.concat(F.col("method_ord").cast("string"), F.lit(".java"))).alias("path"),
                     unit.alias("text"))
    fields = (methods.select("project", "package", "class_name", "field").distinct()
              .groupBy("project", "package", "class_name")
              .agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("  int "), F.col("field"), F.lit(";")))),
                                "\n").alias("decls")))
    ffiles = fields.select("project", F.concat_ws("/", "package", "class_name", F.lit("_fields.java")).alias("path"),
                           F.concat(F.lit("package "), F.col("package"), F.lit(";\n\nclass "), F.col("class_name"),
                                    F.lit(" {\n"), F.col("decls"), F.lit("\n}\n")).alias("text"))
    return files.unionByName(ffiles)


def write_class_files(methods: DataFrame, bodies: DataFrame, root: str) -> None:
    """One text file per class under ``root``, in a folder per project: its methods in order, each with its calls.

    A class's lines are sorted and streamed into its file; no class is built up in memory."""
    text = F.concat(F.lit("  void "), F.col("method"), F.lit("() { "), F.coalesce("body", F.lit("")), F.lit(" }"))
    lines = methods.join(bodies, ["project", "method_ord"], "left") \
        .select("project", "class_fqn", F.col("method_ord").alias("ord"), text.alias("value"))
    heads = methods.select("project", "class_fqn", "package", "class_name").distinct()
    head = F.concat(F.lit("package "), F.col("package"), F.lit(";\n\nclass "), F.col("class_name"), F.lit(" {"))
    lines = lines.unionByName(heads.select("project", "class_fqn", F.lit(-1).cast("long").alias("ord"), head.alias("value"))) \
        .unionByName(heads.select("project", "class_fqn", F.lit((1 << 63) - 1).alias("ord"), F.lit("}").alias("value")))
    lines.withColumnRenamed("project", "folder").repartition("folder", "class_fqn").sortWithinPartitions("folder", "class_fqn", "ord") \
        .select("folder", "class_fqn", "value").write.mode("overwrite").partitionBy("folder", "class_fqn").text(root)


def render_entry_sources(methods: DataFrame, package: str = "shop", entry: str = "Main") -> DataFrame:
    """Entry-class units: for every declared method ``m`` of class ``p.C`` a method
    ``call<ord>`` of ``<package>.<entry>`` (which extends ``Base``) declares
    ``p.C v = new p.C();`` and calls ``v.m()`` and ``super.m()``. One unit per method, so the work grows with the method table."""
    body = F.concat(F.lit("    "), F.col("class_fqn"), F.lit(" v = new "), F.col("class_fqn"), F.lit("();\n    v."),
                    F.col("method"), F.lit("();\n    super."), F.col("method"), F.lit("();\n"))
    text = F.concat(F.lit(f"package {package};\n\nclass {entry} extends Base {{\n  void call"),
                    F.col("method_ord").cast("string"), F.lit("() {\n"), body, F.lit("  }\n}\n"))
    return methods.select("project", F.concat(F.lit(f"{package}/{entry}/"), F.col("method_ord").cast("string"),
                                              F.lit(".java")).alias("path"), text.alias("text"))

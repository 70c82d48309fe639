"""Source files -> fact tables (S1-S15) as one distributed job.

``scan_sources`` reads a directory tree of ``*.java`` files, one row per file.
``extract_facts`` runs a light scanner per file inside ``mapInArrow``: comments and literals are
blanked while newlines are kept, the text is cut into tokens once, brackets are matched once, and
one forward pass over the tokens finds declarations and invocations.  The work is linear in the
file.  It emits one long table (kind, ...) from which each fact table is a filtered view, in
frames of bounded size.  A file is the unit of work, so the job scales with the corpus and
no file is ever split or truncated.

Supported constructs: package, class/interface declarations at any depth (also inside enums,
records and methods), annotations on types, methods, fields, parameters and locals, fields
(``int a, b;`` is one declaration), methods and constructors (LOC from the header line, with a
leading Javadoc, to the closing brace; 0 without body), parameters, invocations with optional
receiver (also inside lambdas and anonymous classes, whose own method headers are no calls),
``super.m()``, local variable declarations (statements and ``for`` / ``try`` headers, every
fragment) with generic arguments stripped. A full Java grammar and compiler bindings are not built.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("package", T.StringType()),
    T.StructField("class_name", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("method", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("type_name", T.StringType()),
    T.StructField("receiver", T.StringType()),
    T.StructField("init", T.StringType()),
    T.StructField("loc", T.IntegerType()),
    T.StructField("params", T.IntegerType()),
    T.StructField("superclass", T.StringType()),
])

# Words that look like calls or declarations but are not.
KEYWORDS = {"if", "for", "while", "switch", "catch", "return", "synchronized", "new", "throw", "else", "do",
            "try", "case", "assert", "super", "this", "class", "interface", "enum", "record", "instanceof",
            "final", "static", "public", "private", "protected", "abstract", "default", "yield"}

_STRIP = re.compile(r'//[^\n]*|/\*.*?\*/|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', re.S)
_TOKEN = re.compile(r"[A-Za-z_$][\w$]*|\d[\w.]*|[^\s\w]")
_NEWLINE = re.compile("\n")
# Words that may stand before a call, so that it is no declaration.
BEFORE_CALL = {"return", "else", "do", "throw", "case", "assert", "yield", "new", "instanceof", "default"}
MODIFIERS = {"public", "private", "protected", "static", "final", "abstract", "synchronized", "native", "default",
             "strictfp", "transient", "volatile", "sealed", "non"}
TYPE_WORDS = {"class", "interface", "enum", "record"}
PRIMITIVES = {"int", "long", "double", "float", "boolean", "byte", "short", "char", "void", "var"}
_OPEN, _CLOSE = "([{", ")]}"
#: facts of a frame; a file's facts are handed on as they come
_FRAME_ROWS = 20_000


def _blank(text: str) -> str:
    return _STRIP.sub(lambda m: re.sub(r"[^\n]", " ", m.group(0)), text)


def _is_name(t: str) -> bool:
    return t[0].isalpha() or t[0] in "_$"


class _File:
    """Tokens of one file, with matched brackets, and the pass that emits its facts."""

    def __init__(self, project: str, path: str, text: str, identifiers: bool):
        self.raw = text
        self.text = _blank(text)
        self.identifiers = identifiers
        found = [(m.group(0), m.start()) for m in _TOKEN.finditer(self.text)]
        # a few marks after the last token, so that looking ahead needs no test
        self.tok = [t for t, _ in found] + ["\0"] * 4
        self.at = [p for _, p in found] + [len(self.text)] * 4
        self.n = len(found)
        self.lines = [m.start() for m in _NEWLINE.finditer(text)]
        self.match = [self.n] * (self.n + 4)
        stack: list[int] = []
        for i in range(self.n):
            t = self.tok[i]
            if t in _OPEN:
                stack.append(i)
            elif t in _CLOSE:
                k = _OPEN[_CLOSE.index(t)]
                while stack and self.tok[stack[-1]] != k:  # unbalanced source: the inner bracket stays open
                    stack.pop()
                if stack:
                    self.match[stack.pop()] = i
        self.ord = 0
        self.base = dict(project=project, path=path, package=self._package(), class_name=None, ord=None, method=None,
                         name=None, type_name=None, receiver=None, init=None, loc=None, params=None, superclass=None)

    def _package(self) -> str:
        for i in range(self.n):
            if self.tok[i] == "package":
                j = i + 1
                while j < self.n and (_is_name(self.tok[j]) or self.tok[j] == "."):
                    j += 1
                return "".join(self.tok[i + 1:j])
            if self.tok[i] in TYPE_WORDS:
                break
        return ""

    def emit(self, **kw) -> dict:
        self.ord += 1
        return {**self.base, "ord": self.ord, **kw}

    def line(self, pos: int) -> int:
        return bisect_right(self.lines, pos - 1) + 1

    # --- pieces of declarations -------------------------------------------------------
    def angles(self, i: int) -> int:
        """Index after the type arguments that open at ``i``, or ``i`` where they are none."""
        depth, j = 0, i
        while j < self.n:
            t = self.tok[j]
            if t == "<":
                depth += 1
            elif t == ">":
                depth -= 1
                if depth == 0:
                    return j + 1
            elif not (_is_name(t) or t in ",.?&[]@"):
                return i
            j += 1
        return i

    def annotation(self, i: int) -> int:
        """Index after the annotation at ``i``."""
        j = i + 1
        while j < self.n and _is_name(self.tok[j]):
            j += 1
            if self.tok[j] != ".":
                break
            j += 1
        return self.match[j] + 1 if self.tok[j] == "(" else j

    def prefix(self, i: int, end: int) -> int:
        """Index after annotations and modifiers."""
        while i < end:
            if self.tok[i] == "@" and self.tok[i + 1] != "interface":
                i = self.annotation(i)
            elif self.tok[i] in MODIFIERS and self.tok[i + 1] not in (".", "(", "=", ";", ":", "->"):
                i += 3 if self.tok[i] == "non" and self.tok[i + 1] == "-" else 1
            else:
                return i
        return i

    def type_end(self, i: int, end: int) -> int:
        """Index after a type name with arguments and brackets, or ``i``."""
        j = i
        while j < end and _is_name(self.tok[j]) and self.tok[j] not in KEYWORDS:
            j += 1
            if self.tok[j] == "<":
                j = self.angles(j)
            if self.tok[j] != ".":
                break
            j += 1
        while j > i and self.tok[j] == "[" and self.tok[j + 1] == "]":
            j += 2
        if j > i and self.tok[j] == "." and self.tok[j + 1] == ".":  # variable arguments
            j += 3
        return j

    def source(self, i: int, j: int) -> str:
        """Source text of tokens i..j-1, without comments."""
        return self.text[self.at[i]:self.at[j - 1] + len(self.tok[j - 1])].strip() if j > i else ""

    def declarators(self, i: int, end: int) -> tuple[list[tuple[str, str | None]], int]:
        """(name, initialiser) of the fragments from ``i`` and the index of what ends them."""
        out = []
        while i < end and _is_name(self.tok[i]):
            name, init = self.tok[i], None
            i += 1
            while self.tok[i] == "[":
                i = self.match[i] + 1
            if self.tok[i] == "=":
                first = i = i + 1
                while i < end and self.tok[i] not in (",", ";") and self.tok[i] not in _CLOSE:
                    if self.tok[i] in _OPEN:
                        i = self.match[i] + 1
                    elif self.tok[i] == "<":
                        i = max(self.angles(i), i + 1)
                    else:
                        i += 1
                init = self.source(first, min(i, end))
            out.append((name, init))
            if self.tok[i] != ",":
                break
            i += 1
        return out, i

    def start_line(self, i: int) -> int:
        """Line of the declaration at token ``i``, or of the Javadoc directly before it."""
        gap_from = self.at[i - 1] + len(self.tok[i - 1]) if i else 0
        gap = self.raw[gap_from:self.at[i]].rstrip()
        k = gap.rfind("/*") if gap.endswith("*/") else -1
        return self.line(gap_from + k if k >= 0 and gap.startswith("/**", k) else self.at[i])

    def header(self, i: int, end: int) -> int:
        """Index of the first of ``{`` or ``;`` outside brackets."""
        while i < end and self.tok[i] not in ("{", ";"):
            i = self.match[i] + 1 if self.tok[i] in "([" else i + 1
        return i

    # --- the pass ---------------------------------------------------------------------
    def facts(self) -> Iterator[dict]:
        """All facts of the file.  ``work`` holds ranges still to be read: (first, end, class, keep)."""
        work = [(0, self.n, None, False)]
        while work:
            i, end, cls, keep = work.pop()
            while i < end:
                start = i
                i = self.prefix(i, end)
                t = self.tok[i]
                if i >= end:
                    break
                if t in TYPE_WORDS and _is_name(self.tok[i + 1]) or t == "@" and self.tok[i + 1] == "interface":
                    row, body, after, inner = self.type_at(i, end)
                    if row:
                        yield row
                    if body is not None:
                        work.append((after, end, cls, keep))
                        work.append((body, after - 1, *inner))
                        break
                    i = after
                elif t == "{":
                    i = self.match[i] + 1
                elif t in (";", "}", ")", "]"):
                    i += 1
                elif cls is None and not keep and t in ("package", "import"):
                    i = self.header(i, end) + 1
                else:
                    i = yield from self.member(start, i, end, cls if keep else None)

    def type_at(self, i: int, end: int):
        """(row, first body token, index after, (class, keep)) of the type declared at ``i``."""
        if self.tok[i] == "@":
            i += 1
        word, name = self.tok[i], self.tok[i + 1]
        body = self.header(i + 2, end)
        if self.tok[body] != "{":
            return None, None, body + 1, None
        parent, j = None, i + 2
        while j < body:
            if self.tok[j] == "<":
                j = max(self.angles(j), j + 1)
            elif self.tok[j] == "extends":
                k = self.type_end(j + 1, body)
                parent = _strip_generics(self.source(j + 1, k)) or None
                break
            elif self.tok[j] in ("implements", "permits"):
                break
            else:
                j += 1
        kept = word in ("class", "interface") and self.tok[i - 1] != "@"
        row = self.emit(kind="type", class_name=name, superclass=parent) if kept else None
        first = body + 1
        if word == "enum":  # constants end at the first semicolon
            first = self.constants(first, self.match[body])
        return row, first, self.match[body] + 1, (name, kept)

    def constants(self, i: int, end: int) -> int:
        while i < end and self.tok[i] != ";":
            i = self.match[i] + 1 if self.tok[i] in _OPEN else i + 1
        return i

    def member(self, start: int, i: int, end: int, cls: str | None):
        """A field, method or constructor at ``i``; emits nothing where ``cls`` is None.  Returns the index after."""
        if self.tok[i] == "<":
            i = max(self.angles(i), i + 1)
            i = self.prefix(i, end)
        j = self.type_end(i, end)
        if j == i:
            return i + 1
        if self.tok[j] == "(" and j == i + 1:
            name, returns, paren = self.tok[i], None, j
        elif _is_name(self.tok[j]) and self.tok[j + 1] == "(":
            name, returns, paren = self.tok[j], self.source(i, j), j + 1
        elif _is_name(self.tok[j]) and self.tok[j + 1] in ("=", ";", ",", "["):
            names, k = self.declarators(j, end)
            if cls:
                yield self.emit(kind="field", class_name=cls, name=",".join(n for n, _ in names),
                                type_name=_strip_generics(self.source(i, j)))
            return k + 1
        elif self.tok[j] == "{" and j == i + 1:  # compact constructor of a record
            return self.match[j] + 1
        else:
            return max(j, i + 1)
        close = self.match[paren]
        k = close + 1
        while k < end and self.tok[k] not in ("{", ";"):
            k = self.match[k] + 1 if self.tok[k] in "([" else k + 1
        body = self.tok[k] == "{"
        if cls:
            last = self.match[k] if body else k
            loc = self.line(self.at[min(last, self.n)]) - self.start_line(start) + 1 if body else 0
            yield self.emit(kind="method", class_name=cls, method=name, type_name=returns, loc=loc,
                            params=self.count_parameters(paren + 1, close))
        if body:
            yield from self.body(cls, name, k + 1, self.match[k])
            return self.match[k] + 1
        return k + 1

    def count_parameters(self, i: int, end: int) -> int:
        if i >= end:
            return 0
        count = 1
        while i < end:
            t = self.tok[i]
            if t == ",":
                count += 1
            if t in _OPEN:
                i = self.match[i] + 1
            elif t == "<":
                i = max(self.angles(i), i + 1)
            else:
                i += 1
        return count

    def body(self, cls: str | None, method: str, i: int, end: int) -> Iterator[dict]:
        """Invocations, locals and nested types of a method body; nothing but types where ``cls`` is None."""
        tok, statement = self.tok, True
        while i < end:
            t = tok[i]
            if t in ("class", "interface") and _is_name(tok[i + 1]) and tok[i - 1] != ".":
                row, first, after, inner = self.type_at(i, end)
                if row:
                    yield row
                    # members of the local class; the calls in it also belong to this method
                    sub, stop = first, after - 1
                    while sub < stop:
                        begin = sub
                        sub = self.prefix(sub, stop)
                        if tok[sub] in TYPE_WORDS or tok[sub] in ("{", ";", "}"):
                            sub = self.match[sub] + 1 if tok[sub] == "{" else sub + 1
                        else:
                            sub = yield from self.member(begin, sub, stop, inner[0])
                    i = first
                    statement = True
                    continue
            if cls and statement:
                j = self.prefix(i, end)
                k = self.type_end(j, end)
                if k > j and _is_name(tok[k]) and tok[k] not in KEYWORDS and tok[k + 1] in ("=", ";", ":", ",", "["):
                    names, _ = self.declarators(k, end)
                    if tok[k + 1] != ":" or tok[i - 1] == "(":
                        for name, init in names:
                            yield self.emit(kind="local", class_name=cls, method=method, name=name, init=init,
                                            type_name=_strip_generics(self.source(j, k)))
            if cls and _is_name(t):
                if tok[i + 1] == "(" and t not in KEYWORDS:
                    if not self.constructs(i) and not self.declares(i):
                        before = tok[i - 1]
                        receiver = tok[i - 2] if before == "." and _is_name(tok[i - 2]) else None
                        if receiver == "super":
                            yield self.emit(kind="super_inv", class_name=cls, method=method, name=t)
                        else:
                            yield self.emit(kind="inv", class_name=cls, method=method, name=t, receiver=receiver)
                elif self.identifiers and tok[i + 1] != "(" and tok[i - 1] != "." and t not in KEYWORDS:
                    yield self.emit(kind="ident", class_name=cls, method=method, name=t)
            statement = t in ("{", "}", ";") or t == "(" and tok[i - 1] in ("for", "try") or t == ")" and statement
            i += 1

    def constructs(self, i: int) -> bool:
        """Whether the name at ``i`` ends the qualified name after ``new``, or is an annotation's."""
        while self.tok[i - 1] == "." and _is_name(self.tok[i - 2]):
            i -= 2
        return self.tok[i - 1] in ("new", "@")

    def declares(self, i: int) -> bool:
        """Whether the name at ``i`` heads a method declaration inside the body (anonymous classes)."""
        before = self.tok[i - 1]
        if not (before in (">", "]") or before and _is_name(before) and before not in BEFORE_CALL):
            return False
        after = self.tok[min(self.match[i + 1] + 1, self.n)]
        return after in ("{", "throws") or after == ";" and before not in (">", "]")


def extract_file(project: str, path: str, text: str, identifiers: bool = False) -> list[dict]:
    return list(_File(project, path, text or "", identifiers).facts())


def _strip_generics(t: str) -> str:
    out, depth = [], 0
    for c in t:
        if c == "<":
            depth += 1
        elif c == ">":
            depth -= 1
        elif depth == 0:
            out.append(c)
    return "".join(out).strip()


_TYPES = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}


def _frame(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], _TYPES[f.dataType]) for f in FACT_SCHEMA.fields],
                                      names=FACT_SCHEMA.names)


def _extract_batches(it, identifiers=False):
    for batch in it:
        out = []
        for project, path, text in zip(batch.column("project"), batch.column("path"), batch.column("text")):
            for row in _File(project.as_py(), path.as_py(), text.as_py() or "", identifiers).facts():
                out.append(row)
                if len(out) >= _FRAME_ROWS:
                    yield _frame(out)
                    out = []
        yield _frame(out)


def scan_sources(spark: SparkSession, root: str, project: str | None = "project", pattern: str = "*.java") -> DataFrame:
    """Every file under ``root`` whose name matches ``pattern`` as (project, path, text).

    ``project`` None takes the first folder below ``root`` as the project of a file."""
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    path = F.col("_metadata.file_path")
    folder = "/" + root.rstrip("/").rsplit("/", 1)[-1] + "/"
    below = F.substring_index(path, folder, -1)
    name = F.lit(project) if project is not None else F.split(below, "/")[0]
    return df.select(name.alias("project"), path.alias("path"), F.col("value").alias("text"))


def with_file_order(sources: DataFrame) -> DataFrame:
    """Adds ``file_ord``: the position of a file in its project, by path (the order of pass 1).

    The paths alone are sorted and written; the texts stay in their files and are joined to their place.  The
    result's ``places`` is the written table (project, path, file_ord), for what needs no texts."""
    from callweave.functions.ranking import with_group_position
    from callweave.session import materialize
    places = materialize(with_group_position(sources.select("project", "path"), ["project"], ["path"], "file_ord"), "file_order")
    out = sources.join(places, ["project", "path"])
    out.places = places
    return out


def extract_facts(sources: DataFrame, identifiers: bool = False) -> DataFrame:
    """Long fact table, one row per declaration / invocation (and, with
    ``identifiers``, one per bare identifier read in a method body, for S15).

    Files are dealt by path over a set number of tasks: scanning takes long for the bytes it reads, so the tasks
    that adaptive execution would make for a table of that size are far too few."""
    def run(it):
        return _extract_batches(it, identifiers)
    spark = sources.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    return sources.select("project", "path", "text").repartition(tasks, "project", "path").mapInArrow(run, FACT_SCHEMA)


def with_fqn(facts: DataFrame) -> DataFrame:
    """Class FQN from package and simple class name (nested types: package.Name)."""
    from callweave.functions.names import full_class_name
    return facts.withColumn("class_fqn", full_class_name(F.col("package"), F.col("class_name")))


def fact_types(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter(F.col("kind") == "type")
    return f.select("project", "package", "class_name", "class_fqn").distinct()


def fact_supertypes(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter((F.col("kind") == "type") & F.col("superclass").isNotNull())
    return f.select("project", "class_fqn", "superclass").distinct()


def fact_methods(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter(F.col("kind") == "method")
    return f.select("project", "path", "ord", "class_fqn", "method", F.col("type_name").alias("return_type"),
                    "loc", "params")


def fact_attr_counts(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts)
    fields = f.filter(F.col("kind") == "field").groupBy("project", "class_fqn").agg(
        F.count(F.lit(1)).cast("int").alias("attr_count"))
    return (fact_types(facts).join(fields, ["project", "class_fqn"], "left")
            .select("project", "class_fqn", F.coalesce("attr_count", F.lit(0)).alias("attr_count"))
            .groupBy("project", "class_fqn").agg(F.sum("attr_count").cast("int").alias("attr_count")))


def fact_invocations(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter(F.col("kind") == "inv")
    return f.select("project", "path", "ord", "class_fqn",
                    F.concat_ws(".", "class_fqn", "method").alias("caller"), "receiver",
                    F.col("name").alias("callee_simple"))


def fact_super_invocations(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter(F.col("kind") == "super_inv")
    return f.select("project", "path", "ord", "class_fqn",
                    F.concat_ws(".", "class_fqn", "method").alias("caller"), F.col("name").alias("callee_simple"))


def fact_local_types(facts: DataFrame) -> DataFrame:
    f = with_fqn(facts).filter(F.col("kind") == "local")
    return f.select("project", "path", "ord", "class_fqn", "class_name", "method",
                    F.col("name").alias("variable"), "type_name", "init")


def fact_variables(facts: DataFrame) -> DataFrame:
    """Variables of each method with their initialiser."""
    return fact_local_types(facts).select("project", "class_fqn", "method", "variable", "init")


def local_receiver_calls(facts: DataFrame, entry_class: str = "Main", scope: str = "method") -> DataFrame:
    """Calls whose receiver is a local variable, inside types named ``entry_class``.

    scope='method': the variable must be declared in the same method (default);
    scope='global_last': one map per project, filled file by file in path order; a call sees the last
    declaration in the files up to its own."""
    f = with_fqn(facts).filter((F.col("kind") == "inv") & (F.col("class_name") == entry_class)
                              & F.col("receiver").isNotNull())
    inv = f.select("project", "path", "class_fqn", "method", "receiver", F.col("name").alias("callee_simple"))
    loc = fact_local_types(facts)
    if scope == "method":
        j = inv.join(loc.select("project", "class_fqn", "method", F.col("variable").alias("receiver"), "type_name"),
                     ["project", "class_fqn", "method", "receiver"])
    else:
        from callweave.functions.ranking import asof_join
        end = F.struct(F.col("path").alias("f"), F.lit((1 << 63) - 1).alias("d"))
        place = F.struct(F.col("path").alias("f"), F.col("ord").alias("d"))
        j = asof_join(inv, loc.withColumnRenamed("variable", "receiver"), ["project", "receiver"], end, place, ["type_name"]) \
            .filter(F.col("type_name").isNotNull())
    return j.select("project", "class_fqn", "method", F.col("receiver").alias("variable"),
                    F.col("callee_simple").alias("method_name"), "type_name").distinct()


def fact_field_access(facts: DataFrame) -> DataFrame:
    """Identifiers read in a method that name a variable of that method or a field
    of its class (left-semi joins against the declarations)."""
    f = with_fqn(facts)
    ident = f.filter(F.col("kind") == "ident").select("project", "class_fqn", "method", "name").distinct()
    local = f.filter(F.col("kind") == "local").select("project", "class_fqn", "method", "name").distinct()
    fields = (f.filter(F.col("kind") == "field")
              .select("project", "class_fqn", F.explode(F.split("name", ",")).alias("name")).distinct())
    by_local = ident.join(local, ["project", "class_fqn", "method", "name"], "left_semi")
    by_field = ident.join(fields, ["project", "class_fqn", "name"], "left_semi")
    return by_local.unionByName(by_field).distinct().withColumnRenamed("name", "variable")

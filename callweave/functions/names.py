"""Name functions over dotted Java names (N1-N12), all built-in Column expressions.

They stay inside whole-stage codegen: no regex where plain string functions do,
no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the analysed tool's lists.
COLLECTION_METHODS = ["add", "remove", "size", "isEmpty", "contains", "get", "set", "clear"]
NOISE_METHODS = ["println", "print", "add", "remove", "get", "set", "size", "isEmpty",
                 "contains", "equals", "toString", "hashCode"]
SYSTEM_PREFIXES = ["java.", "javax.", "sun.", "com.sun.", "jdk."]
PALETTE_10 = ["#FF6B6B", "#4ECDC4", "#45B7D1", "#FFA07A", "#98D8C8",
              "#F7DC6F", "#BB8FCE", "#85C1E2", "#F8B739", "#52B788"]
PALETTE_15 = PALETTE_10 + ["#E74C3C", "#3498DB", "#2ECC71", "#F39C12", "#9B59B6"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_dot_pos(x) -> Column:
    """1-based position of the last '.', 0 when there is none."""
    x = _c(x)
    return F.length(x) - F.length(F.substring_index(x, ".", -1))


def class_of_method(x) -> Column:
    """Text before the last '.', null when there is no dot or it is the first char."""
    x = _c(x)
    p = last_dot_pos(x)
    return F.when(p > 1, x.substr(F.lit(1), p - 1))


def method_of(x) -> Column:
    """Text after the last '.', the whole text when there is none or it is trailing."""
    x = _c(x)
    p = last_dot_pos(x)
    return F.when((p == 0) | (p == F.length(x)), x).otherwise(F.substring_index(x, ".", -1))


def short_name(x) -> Column:
    """Last dotted segment."""
    return F.substring_index(_c(x), ".", -1)


def package_of(x) -> Column:
    """N4 (null variant): package of a class name; null without one."""
    return class_of_method(x)


def package_or_empty(x) -> Column:
    """N4 ("" variant) used by the JSON sink."""
    x = _c(x)
    p = last_dot_pos(x)
    return F.when(p > 0, x.substr(F.lit(1), p - 1)).otherwise(F.lit(""))


def group_package(x) -> Column:
    """Drop the last two segments; 'default' without a dot, the head with one dot."""
    x = _c(x)
    p = last_dot_pos(x)
    head = x.substr(F.lit(1), p - 1)
    q = last_dot_pos(head)
    return (F.when(p == 0, F.lit("default"))
            .when(q == 0, head)
            .otherwise(head.substr(F.lit(1), q - 1)))


def simplify_name(x) -> Column:
    """Last two segments (split semantics: trailing empty parts are dropped)."""
    x = _c(x)
    t = F.regexp_replace(x, r"\.+$", "")
    return F.when(F.instr(t, ".") == 0, x).otherwise(F.substring_index(t, ".", -2))


def full_class_name(package, name) -> Column:
    """Package.name, just name in the default package."""
    return F.concat_ws(".", F.nullif(_c(package), F.lit("")), _c(name))


def is_collection_method(x) -> Column:
    """N8."""
    return _c(x).isin(COLLECTION_METHODS)


def is_noise_method(x) -> Column:
    """N9."""
    return _c(x).isin(NOISE_METHODS)


def is_system_class(x) -> Column:
    """N10 (null is not a system class)."""
    x = _c(x)
    cond = F.lit(False)
    for p in SYSTEM_PREFIXES:
        cond = cond | x.startswith(p)
    return F.coalesce(cond, F.lit(False))


def is_simple_name(x) -> Column:
    """N11."""
    return F.instr(_c(x), ".") == 0


def canonical_pair(a, b) -> tuple[Column, Column]:
    """Unordered pair in binary string order."""
    a, b = _c(a), _c(b)
    return F.least(a, b), F.greatest(a, b)

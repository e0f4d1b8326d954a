"""Column functions on dotted hierarchical codes such as 01.1.2.3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leading segments of codes that stand for no product (technical codes).
TECHNICAL = ("98", "99")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segments(code) -> Column:
    return F.split(_col(code), "\\.")


def depth(code) -> Column:
    """Number of segments; null for null or empty codes."""
    c = _col(code)
    return F.when(F.length(c) > 0, F.length(c) - F.length(F.replace(c, F.lit("."), F.lit(""))) + 1)


def truncate_code(code, level: int) -> Column:
    """The first level segments; shallower codes as they are; null for null or empty."""
    c = _col(code)
    return F.when(F.length(c) > 0, F.substring_index(c, ".", level))


def at_level(code, level: int) -> Column:
    """The first level segments, null where the code is shallower."""
    return F.when(depth(code) >= level, truncate_code(code, level))


def parent_code(code) -> Column:
    c = _col(code)
    return F.when(depth(c) > 1, F.array_join(F.slice(segments(c), 1, F.size(segments(c)) - 1), "."))


def ancestors(code) -> Column:
    """All proper ancestors, the shortest first."""
    c = _col(code)
    n = F.size(segments(c))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(segments(c), 1, i), "."))).otherwise(F.array().cast("array<string>"))


def padded(segment: Column, width: int = 2) -> Column:
    """Zeros in front; longer segments stay whole."""
    return F.when(F.length(segment) < width, F.lpad(segment, width, "0")).otherwise(segment)


def level_plain(code, level: int) -> Column:
    """Level column whose padding touches level 1 alone."""
    own = at_level(code, level)
    return padded(own) if level == 1 else own


def level_padded(code, level: int) -> Column:
    """Level column with a padded first segment at every level."""
    c = _col(code)
    parts = F.concat(F.array(padded(F.element_at(segments(c), 1))), F.slice(segments(c), 2, level - 1) if level > 1 else F.array().cast("array<string>"))
    return F.when(depth(c) >= level, F.array_join(parts, "."))


def is_technical(code) -> Column:
    c = _col(code)
    return F.startswith(c, F.lit(TECHNICAL[0])) | F.startswith(c, F.lit(TECHNICAL[1]))


def level_result(truth, predicted, level: int) -> Column:
    """True or false where truth reaches the level, null where it doesn't; a shallower or missing prediction is false."""
    t, p = depth(truth), depth(predicted)
    return F.when(F.coalesce(t, F.lit(0)) < level, None).when(F.coalesce(p, F.lit(0)) < level, False).otherwise(truncate_code(truth, level) == truncate_code(predicted, level))


def common_prefix(a, b, last: int = 12) -> Column:
    """The longest common beginning at 2, 4, ... last characters, null if there is none."""
    x, y = _col(a), _col(b)
    same = F.filter(F.sequence(F.lit(2), F.lit(last), F.lit(2)), lambda k: F.substring(x, F.lit(1), k) == F.substring(y, F.lit(1), k))
    return F.substring(x, F.lit(1), F.array_max(same))


def severity(truth, predicted) -> Column:
    """How far up the first wrong level is, for pairs that both reach level 4."""

    def judged(pair: Column) -> Column:
        t, p = (lambda k: F.get(pair["t"], F.lit(k - 1))), (lambda k: F.get(pair["p"], F.lit(k - 1)))
        return (
            F.when(t(4).isNull() | p(4).isNull(), None)
            .when(t(1) != p(1), "far-miss")
            .when(t(2) != p(2), "L2 faux")
            .when(t(3) != p(3), "L3 faux")
            .when(t(4) != p(4), "near-miss")
            .otherwise("correct")
        )

    # A lambda's argument is computed once; otherwise both codes, which may be long expressions, stand here a dozen times.
    # Segments decide: if the ones above are equal, those of a level differ where the codes up to it do.
    parts = F.struct(F.split(_col(truth), "\\.").alias("t"), F.split(_col(predicted), "\\.").alias("p"))
    return F.get(F.transform(F.array(parts), judged), F.lit(0))


#: Fixed bounds of the budget classes.
BUDGET_BOUNDS = (0, 2, 5, 10, 20, 50, 100)


def budget_class(budget) -> Column:
    """First class whose closed interval holds the budget, so a shared bound belongs to the lower class."""
    b = _col(budget)
    out = None
    for low, high in zip(BUDGET_BOUNDS, BUDGET_BOUNDS[1:]):
        test, name = b.between(low, high), f"{low}-{high} €"
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.when(b > BUDGET_BOUNDS[-1], f"{BUDGET_BOUNDS[-1]}+ €")


def cut(value, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Right-closed intervals; null outside of them."""
    v = _col(value)
    out = None
    for k, (low, high, name) in enumerate(zip(edges, edges[1:], labels)):
        test = (v <= high) & ((v >= low) if include_lowest and k == 0 else (v > low))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out

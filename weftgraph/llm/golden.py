"""The best representative of each duplicate group, put together from consistent bundles of fields.

A *bundle* is a set of fields that belong together and are taken from one row. Each bundle has a trust. A *dependency*
says that one field of a bundle determines a field of another bundle: the pair of values in the result must stand together
in some row of the group. The result has the greatest sum of trusts that keeps all dependencies.

Bundles that dependencies connect, directly or through others, are searched together by branch and bound, as joins over all
groups at once. A bundle is taken after one it is linked to, so partial choices are extended by the values that stand
together with theirs, never by all of a group. A partial choice is cut off before that if its sum, plus what each linked
bundle could add given the choice's values, plus the most that the others could add, is below the group's best whole row.
Of partial choices that agree in every field a later link looks at, only the best goes on. A bundle without dependencies
has a single undominated candidate, so it is settled by the bound alone, in one aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.plans.lineage import cut


@dataclass(frozen=True)
class Bundle:
    """Fields taken together from one row.

    ``trust`` is a number, and null counts as -1; ``ties`` decide between equal trusts, the greater value first (null last).
    """

    name: str
    fields: tuple[str, ...]
    trust: Column
    ties: tuple[Column, ...] = ()


@dataclass(frozen=True)
class Dependency:
    """``determinant`` of one bundle determines ``dependent`` of another; both are field names."""

    determinant: str
    dependent: str


def _candidate(bundle: Bundle) -> Column:
    trust = F.coalesce(bundle.trust.cast("double"), F.lit(-1.0)).alias("trust")
    ties = [c.alias(f"tie_{i}") for i, c in enumerate(bundle.ties)]
    fields = [F.col(f).alias(f"f_{i}") for i, f in enumerate(bundle.fields)]
    return F.struct(trust, *ties, *fields)


def _signed(bundle: Bundle, dependencies: list[Dependency]) -> list[str]:
    """Fields of the bundle that a dependency looks at."""
    named = [f for d in dependencies for f in (d.determinant, d.dependent)]
    return [f for f in bundle.fields if f in named]


def best_bundles(
    members: DataFrame, rows: DataFrame, on: str, group: str, bundles: list[Bundle], dependencies: list[Dependency] = []
) -> DataFrame:
    """One row per group: ``group``, ``n_rows`` (rows of the group) and the fields of each bundle's chosen row.

    ``members`` holds (group, on), ``rows`` the records with the key ``on``; a group's rows are those of its keys. Rows are
    reduced to the best per key before they meet the groups, so a key or group of any size is only ever aggregated.

    Null keys and groups join nothing. Repeated members count once; each repeated row counts in ``n_rows`` but can't change
    a choice. Trusts that are null rank below 0. A group without rows is not in the result; empty tables give no rows.
    Further columns of either table are ignored. Field names must differ between bundles.
    """
    members = members.select(F.col(group).alias("g"), F.col(on).alias("k")).where("g IS NOT NULL AND k IS NOT NULL").distinct()
    rows = rows.withColumn("__key", F.col(on)).where("__key IS NOT NULL")
    free = [b for b in bundles if not _signed(b, dependencies)]
    per_key = rows.groupBy(F.col("__key").alias("k")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.max(_candidate(b)).alias(f"b_{b.name}") for b in free]
    )
    result = (
        members.join(per_key, "k")
        .groupBy("g")
        .agg(F.sum("n_rows").alias("n_rows"), *[F.max(f"b_{b.name}").alias(f"b_{b.name}") for b in free])
    )
    for connected in _connected([b for b in bundles if b not in free], dependencies):
        result = result.join(_search(members, rows, connected), "g")
    fields = [F.col(f"b_{b.name}.f_{i}").alias(f) for b in bundles for i, f in enumerate(b.fields)]
    return result.select(F.col("g").alias(group), "n_rows", *fields)


@dataclass(frozen=True)
class _Link:
    """A dependency, seen from the bundle that is taken earlier: its field, the other bundle and that one's field."""

    field: str
    bundle: Bundle
    other: str


def _connected(bundles: list[Bundle], dependencies: list[Dependency]) -> list[list[tuple[Bundle, list[tuple[Bundle, _Link]]]]]:
    """The bundles by connected parts; in each part in an order in which all but the first have links to earlier ones."""
    left, parts = list(bundles), []
    while left:
        order: list[tuple[Bundle, list[tuple[Bundle, _Link]]]] = [(left.pop(0), [])]
        while True:
            found = next(((b, links) for b in left if (links := _links([t for t, _ in order], b, dependencies))), None)
            if found is None:
                break
            order.append(found)
            left.remove(found[0])
        parts.append(order)
    return parts


def _links(taken: list[Bundle], bundle: Bundle, dependencies: list[Dependency]) -> list[tuple[Bundle, _Link]]:
    ends = [(d.determinant, d.dependent) for d in dependencies] + [(d.dependent, d.determinant) for d in dependencies]
    return [(t, _Link(a, bundle, b)) for t in taken for a, b in ends if a in t.fields and b in bundle.fields]


def _search(members: DataFrame, rows: DataFrame, order: list[tuple[Bundle, list[tuple[Bundle, _Link]]]]) -> DataFrame:
    """(g, b_<bundle>...) of the best consistent choice of bundles that are linked, in the order they are taken in."""
    bundles = [b for b, _ in order]
    links = [(t, x) for _, found in order for t, x in found]
    signed = {b.name: sorted({x.field for t, x in links if t is b} | {x.other for _, x in links if x.bundle is b}) for b in bundles}
    fields = sorted({f for fs in signed.values() for f in fs})
    trust = {b.name: F.coalesce(b.trust.cast("double"), F.lit(-1.0)) for b in bundles}
    best = [F.max(_candidate(b)).alias(f"b_{b.name}") for b in bundles]
    whole = F.max(sum((trust[b.name] for b in bundles), F.lit(0.0))).alias("whole")
    small = rows.groupBy(F.col("__key").alias("k"), *[F.col(f).alias(f"v_{f}") for f in fields]).agg(whole, *best)
    again = [F.max(c).alias(c) for c in ("whole", *[f"b_{b.name}" for b in bundles])]
    # the rows are read once; what follows looks at each group's different combinations of signed values
    seen = cut(members.join(small, "k").groupBy("g", *[f"v_{f}" for f in fields]).agg(*again))
    candidates = {
        b.name: seen.groupBy("g", *[f"v_{f}" for f in signed[b.name]]).agg(F.max(f"b_{b.name}").alias(f"b_{b.name}")) for b in bundles
    }

    def attested(link: _Link) -> DataFrame:
        return seen.select("g", f"v_{link.field}", f"v_{link.other}").distinct()

    def matched(left: DataFrame, right: DataFrame, values: list[str]) -> DataFrame:
        """Equi-join by group and values, where nulls are equal; a value's column stays once."""
        renamed = right.withColumnsRenamed({"g": "g2", **{v: f"{v}_2" for v in values}})
        on = F.col("g") == F.col("g2")
        for v in values:
            on = on & F.col(v).eqNullSafe(F.col(f"{v}_2"))
        return left.join(renamed, on).drop("g2", *[f"{v}_2" for v in values])

    def most(link: _Link) -> DataFrame:
        """What the linked bundle could add for each value of the earlier one."""
        other, name = f"v_{link.other}", link.bundle.name
        per_value = candidates[name].groupBy("g", other).agg(F.max(f"b_{name}.trust").alias("t"))
        pairs = matched(attested(link), per_value, [other])
        return pairs.groupBy("g", f"v_{link.field}").agg(F.max("t").alias("t"))

    limits = [F.max(f"b_{b.name}.trust").alias(f"u_{b.name}") for b in bundles]
    found = matched(seen.groupBy("g").agg(F.max("whole").alias("whole"), *limits), candidates[bundles[0].name], [])
    found = found.withColumn("sum", F.col(f"b_{bundles[0].name}.trust"))
    for i, (bundle, own) in enumerate(order):
        if own:
            (_, link), *others = own
            value = f"v_{link.other}"
            extended = matched(matched(found, attested(link), [f"v_{link.field}"]), candidates[bundle.name], [value])
            for _, more in others:
                pair = [f"v_{more.field}", f"v_{more.other}"]
                extended = matched(extended, attested(more), pair)
            found = extended.withColumn("sum", F.col("sum") + F.col(f"b_{bundle.name}.trust"))
        ahead = bundles[i + 1 :]
        for t, link in links:
            if t is bundle and link.bundle in ahead:  # the limit of a linked bundle, given this choice's value
                tighter = F.least(f"u_{link.bundle.name}", "t")
                found = matched(found, most(link), [f"v_{link.field}"]).withColumn(f"u_{link.bundle.name}", tighter).drop("t")
        rest = sum((F.col(f"u_{b.name}") for b in ahead), F.lit(0.0))
        found = found.where(F.col("sum") + rest >= F.col("whole") - 1e-9)
        alive = sorted({f"v_{x.field}" for t, x in links if t in bundles[: i + 1] and x.bundle in ahead})
        kept = ["whole", *[f"u_{b.name}" for b in ahead]]
        choice = F.struct("sum", *[f"b_{b.name}" for b in bundles[: i + 1]], *kept)
        found = found.groupBy("g", *alive).agg(F.max(choice).alias("choice")).select("g", *alive, "choice.*")
    return found.select("g", *[f"b_{b.name}" for b in bundles])

"""Metric layer: named metrics and dimensions over linked tables, answered as one DataFrame.

Each metric is evaluated at the grain of its own table. Metrics of different tables are aggregated
separately and then joined on the shared dimensions, so one table never multiplies another's rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.exact import from_units, ratio
from wattloom.functions.texts import UMLAUTS

Predicate = Callable[[Column], Column]


class MetricError(ValueError):
    """A name is unknown or ambiguous, or a dimension would multiply the metric's rows."""


@dataclass(frozen=True)
class Entity:
    name: str
    frame: DataFrame
    key: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Link:
    """Many rows of ``child`` refer to one row of ``parent`` by its key.

    Where a table can be reached in several ways, ``role`` says what the parent is on this way.
    """
    child: str
    column: str
    parent: str
    role: str = ""


@dataclass(frozen=True)
class Dimension:
    """``role`` picks the way to the table where there are several; a query can name another one."""
    name: str
    entity: str
    expression: str
    synonyms: tuple[str, ...] = ()
    role: str = ""


def folded_name(name: str) -> str:
    """Names compare without case, blanks, hyphens, underscores and umlauts."""
    name = name.casefold()
    for letter, spelling in UMLAUTS.items():
        name = name.replace(letter, spelling)
    return "".join(c for c in name if c not in " -_")


@dataclass(frozen=True)
class Metric:
    """``function`` is one of sum, count, avg, min, max, count_if over a SQL ``expression``.

    ``in_units`` says that the expression counts ten-thousandths, so that sums of readings are exact.
    """
    name: str
    entity: str
    function: str
    expression: str
    synonyms: tuple[str, ...] = ()
    in_units: bool = False

    def states(self) -> list[Column]:
        """Partial aggregates that can be combined again after a join."""
        value = F.expr(self.expression)
        first = {"sum": F.sum, "avg": F.sum, "count": F.count, "min": F.min, "max": F.max,
                 "count_if": F.count_if}[self.function](value).alias(self._state(0))
        return [first, F.count(value).alias(self._state(1))] if self.function == "avg" else [first]

    def combined(self) -> Column:
        state = F.col(self._state(0))
        if self.function == "avg":
            result = ratio(self._whole(F.sum(state)), F.sum(self._state(1)))
        elif self.function in ("min", "max"):
            result = getattr(F, self.function)(state)
        elif self.function in ("count", "count_if"):
            result = F.coalesce(F.sum(state), F.lit(0))  # no row is a count of 0
        else:
            result = self._whole(F.sum(state))
        return result.alias(self.name)

    def direct(self) -> Column:
        """The metric over rows that carry its expression as ``_value_<name>``."""
        value = F.col(self.value_column)
        if self.function == "avg":
            return ratio(self._whole(F.sum(value)), F.count(value)).alias(self.name)
        if self.function == "sum":
            return self._whole(F.sum(value)).alias(self.name)
        return getattr(F, self.function)(value).alias(self.name)

    def _whole(self, total: Column) -> Column:
        return from_units(total) if self.in_units else total

    @property
    def value_column(self) -> str:
        return f"_value_{self.name}"

    def _state(self, index: int) -> str:
        return f"_state{index}_{self.name}"


@dataclass
class SemanticModel:
    entities: list[Entity]
    links: list[Link]
    dimensions: list[Dimension]
    metrics: list[Metric]
    name: str = "model"
    _entities: dict[str, Entity] = field(init=False)

    def __post_init__(self) -> None:
        self._entities = {e.name: e for e in self.entities}

    def query(self, metrics: list[str], dimensions: list[str] = (), where: dict[str, Predicate] | None = None,
              without: dict[str, Predicate] | None = None) -> DataFrame:
        """Metrics by dimensions.

        ``where`` keeps rows whose dimension meets the predicate. A dimension that cannot be reached
        many-to-one acts as membership: a bill is kept when its customer has such a row in the other
        table. ``without`` keeps the rows that have none.

        A name may say its table (``"Kunden.city"``), and a dimension its role (``"contract:region_name"``), which then
        leads its column's name (``contract_region_name``).
        """
        wanted = [self.find_metric(m) for m in metrics]
        by = [self.find_dimension(d) for d in dimensions]
        keep = {self.find_dimension(d): p for d, p in (where or {}).items()}
        drop = {self.find_dimension(d): p for d, p in (without or {}).items()}
        result = None
        for base in dict.fromkeys(m.entity for m in wanted):
            part = self._aggregate(base, [m for m in wanted if m.entity == base], by, keep, drop)
            result = part if result is None else self._side_by_side(result, part, [d.name for d in by])
        return result.select(*[d.name for d in by], *[m.name for m in wanted])

    def find_metric(self, name: str) -> Metric:
        return self._find(name, self.metrics, "metric")

    def find_dimension(self, name: str) -> Dimension:
        role, _, plain = name.rpartition(":")
        found = self._find(plain, self.dimensions, "dimension")
        if not role:
            return found
        known = {folded_name(link.role): link.role for link in self.links if link.role}
        if folded_name(role) not in known:
            raise MetricError(f"unknown role {role!r} in {self.name}")
        role = known[folded_name(role)]
        return replace(found, name=f"{role}_{found.name}", role=role)

    def find_entity(self, name: str) -> Entity:
        return self._named(name, self.entities, "table")

    def _find(self, name, items, kind):
        table, _, plain = name.rpartition(".")
        if table:
            entity = self.find_entity(table).name
            items = [i for i in items if i.entity == entity]
        return self._named(plain, items, kind)

    def _named(self, name, items, kind):
        wanted = folded_name(name)
        exact = [i for i in items if folded_name(i.name) == wanted]
        found = exact or [i for i in items if wanted in map(folded_name, i.synonyms)]
        if len(found) != 1:
            raise MetricError(f"{'ambiguous' if found else 'unknown'} {kind} {name!r} in {self.name}")
        return found[0]

    def _routes(self, start: str, goal: str, before: tuple[Link, ...] = ()) -> list[tuple[Link, ...]]:
        """All chains of many-to-one links that pass no table twice."""
        if start == goal:
            return [before]
        passed = {link.child for link in before}
        return [route for link in self.links if link.child == start and link.parent not in passed
                for route in self._routes(link.parent, goal, (*before, link))]

    def _way(self, base: str, d: Dimension) -> tuple[Link, ...]:
        """The one chain from the metric's table to the dimension in its role."""
        routes = self._routes(base, d.entity)
        in_role = [r for r in routes if d.role and d.role in {link.role for link in r}]
        named = in_role or (routes if len(routes) == 1 else [])
        if len(named) != 1:
            roles = sorted({link.role for r in routes for link in r if link.role})
            raise MetricError(f"{d.name} can be reached from {base} in {len(routes)} ways: name one of the roles {roles}")
        return named[0]

    def _route(self, start: str, goal: str) -> list[Link] | None:
        """Shortest chain of many-to-one links, or None."""
        routes, seen = [(start, [])], {start}
        while routes:
            here, route = routes.pop(0)
            if here == goal:
                return route
            for link in self.links:
                if link.child == here and link.parent not in seen:
                    seen.add(link.parent)
                    routes.append((link.parent, [*route, link]))
        return None

    def _aggregate(self, base: str, metrics: list[Metric], by: list[Dimension], keep: dict[Dimension, Predicate],
                   drop: dict[Dimension, Predicate]) -> DataFrame:
        for d in by:
            if self._route(base, d.entity) is None:
                raise MetricError(f"{d.name} cannot be grouped with metrics of {base}: it would repeat their rows")
        near = {d: p for d, p in keep.items() if self._route(base, d.entity) is not None}
        near_not = {d: p for d, p in drop.items() if self._route(base, d.entity) is not None}
        members = [(d, p, "left_semi") for d, p in keep.items() if d not in near]
        members += [(d, p, "left_anti") for d, p in drop.items() if d not in near_not]

        near_all = dict.fromkeys([*by, *near, *near_not])
        joined_dimensions = [d for d in near_all if d.entity != base]
        local = [d for d in near_all if d.entity == base]
        meeting = [self._meeting(base, d) for d, _, _ in members]
        first_hops = {self._way(base, d)[0] for d in joined_dimensions} | {own[0] for own, _ in meeting if own}

        keys = {self._key_column(link): F.col(link.column) for link in sorted(first_hops, key=self._key_column)}
        if any(not own for own, _ in meeting):
            keys["_own_key"] = F.col(self._entities[base].key)
        groups = [F.expr(d.expression).alias(d.name) for d in local if d in by]
        groups += [c.alias(n) for n, c in keys.items()]
        rows = self._entities[base].frame
        for d in local:
            if d in near:
                rows = rows.where(near[d](F.expr(d.expression)))
            if d in near_not:
                rows = rows.where(~F.coalesce(near_not[d](F.expr(d.expression)), F.lit(False)))

        # With at most one foreign key in play the rows are reduced before any join. The join then sees
        # one row per key and group, so a key that many rows share costs nothing. With several keys such
        # a reduction would hardly shrink the rows, and the joins come first.
        early = len(keys) <= 1
        if early:
            rows = rows.groupBy(*groups).agg(*[s for m in metrics for s in m.states()])
        else:
            rows = rows.select(*groups, *[F.expr(m.expression).alias(m.value_column) for m in metrics])

        for (d, predicate, how), (own, other) in zip(members, meeting):
            rows = self._membership(rows, d, predicate, how, own, other)
        rows = self._with_parents(rows, base, joined_dimensions)
        for d, predicate in near.items():
            if d.entity != base:
                rows = rows.where(predicate(F.col(d.name)))
        for d, predicate in near_not.items():
            if d.entity != base:
                rows = rows.where(~F.coalesce(predicate(F.col(d.name)), F.lit(False)))
        return rows.groupBy(*[d.name for d in by]).agg(*[m.combined() if early else m.direct() for m in metrics])

    def _with_parents(self, rows: DataFrame, base: str, dimensions: list[Dimension]) -> DataFrame:
        """Join each parent once in each role, carrying only its wanted dimensions and the keys that lead on."""
        ways = {d: self._way(base, d) for d in dimensions}
        steps = sorted({way[:n] for way in ways.values() for n in range(1, len(way) + 1)},
                       key=lambda step: (len(step), self._key_column(*step)))
        for step in steps:
            parent = self._entities[step[-1].parent]
            columns = [F.col(parent.key).alias("_parent_key")]
            columns += [F.col(n[-1].column).alias(self._key_column(*n)) for n in steps if n[:-1] == step]
            columns += [F.expr(d.expression).alias(d.name) for d in dimensions if ways[d] == step]
            key_column = self._key_column(*step)
            rows = rows.join(parent.frame.select(*columns), F.col(key_column) == F.col("_parent_key"), "left")
            rows = rows.drop("_parent_key", key_column)
        return rows

    def _meeting(self, base: str, d: Dimension) -> tuple[list[Link], list[Link]]:
        """Where the metric's table and the dimension's table meet: a table both refer to."""
        options = []
        for entity in self._entities:
            own, other = self._route(base, entity), self._route(d.entity, entity)
            if own is not None and other is not None and len(own) <= 1:
                options.append((len(own) + len(other), own, other))
        if not options:
            raise MetricError(f"{d.name} has no table in common with {base}")
        _, own, other = min(options, key=lambda option: option[0])
        return own, other

    def _membership(self, rows: DataFrame, d: Dimension, predicate: Predicate, how: str, own: list[Link],
                    other: list[Link]) -> DataFrame:
        matching = self._entities[d.entity].frame.where(predicate(F.expr(d.expression)))
        key = F.col(other[0].column) if other else F.col(self._entities[d.entity].key)
        keys = matching.select(key.alias("_member"))
        for link in other[1:]:
            step = self._entities[link.child]
            keys = keys.join(step.frame.select(F.col(step.key).alias("_member"), F.col(link.column).alias("_next")),
                             "_member").select(F.col("_next").alias("_member"))
        own_column = self._key_column(own[0]) if own else "_own_key"
        return rows.join(keys.distinct(), F.col(own_column) == F.col("_member"), how)

    @staticmethod
    def _key_column(*way: Link) -> str:
        return "".join(f"_fk_{link.child}_{link.column}_{link.parent}" for link in way)

    @staticmethod
    def _side_by_side(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        if not names:  # one row on either side
            return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
        renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in names else c) for c in right.columns])
        on = [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names]
        merged = left.join(renamed, on, "full")
        values = [c for c in merged.columns if c not in names and not c.startswith("_r_")]
        return merged.select(*[F.coalesce(n, f"_r_{n}").alias(n) for n in names], *values)

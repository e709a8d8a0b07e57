"""MERGE as a DataFrame operator: target and source in, the next target out.

Clauses are tried in call order and the first that applies to a row wins. The match part is a
left join from the target, the insert part a left anti join from the source, so a small source
is broadcast against a large target that never moves, and a hot key on the large side of a
shuffled join can be split by adaptive execution (a full outer join allows neither).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import as_schema, col, pick, quoted, require_columns
from chronotable.operators.keys import splittable_keys
from chronotable.operators.ranges import join_in_range
from chronotable.sources.workspace import materialize

TOO_MANY = "a target row is matched by more than one source row"
_FOUND = "__found"
_ACTION = "__action"
_ROW, _SOURCE_ROW = "__target_row", "__source_row"
_ALL_PAIRS = ("NestedLoopJoin", "CartesianProduct")

Condition = Column | str | None
# New values by target column: expressions, or their SQL text.
Values = Mapping[str, Column | str]


def _as_column(condition: Condition) -> Column:
    if condition is None:
        return F.lit(True)
    return F.expr(condition) if isinstance(condition, str) else condition


def _all(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def _key(position: int) -> str:
    """Name of a match key while the two sides call it differently."""
    return f"__key{position}"


@dataclass(frozen=True)
class Clause:
    """One WHEN clause. ``values`` is None for "all columns"; ``kind`` is what it does."""

    kind: str
    condition: Condition = None
    values: Values | None = None


@dataclass(frozen=True)
class Between:
    """A match of one side's ``point`` with the other side's interval."""

    point: str
    low: str
    high: str
    point_in: str


@dataclass(frozen=True)
class Matched:
    """An open WHEN MATCHED clause."""

    merge: Merge
    condition: Condition

    def update_all(self) -> Merge:
        return self.merge._matched(Clause("update", self.condition))

    def update(self, values: Values) -> Merge:
        return self.merge._matched(Clause("update", self.condition, dict(values)))

    def update_expr(self, values: Mapping[str, str]) -> Merge:
        return self.update(values)

    def delete(self) -> Merge:
        return self.merge._matched(Clause("delete", self.condition))


@dataclass(frozen=True)
class NotMatched:
    """An open WHEN NOT MATCHED clause."""

    merge: Merge
    condition: Condition

    def insert_all(self) -> Merge:
        return self.merge._not_matched(Clause("insert", self.condition))

    def insert(self, values: Values) -> Merge:
        return self.merge._not_matched(Clause("insert", self.condition, dict(values)))

    def insert_expr(self, values: Mapping[str, str]) -> Merge:
        return self.insert(values)


@dataclass(frozen=True)
class Merge:
    """An immutable MERGE statement over two frames.

    Conditions and values refer to the two sides through their aliases, for example
    ``"source.email"`` or ``F.col("target.name")``.
    """

    target: DataFrame
    target_alias: str = "target"
    source: DataFrame | None = None
    source_alias: str = "source"
    keys: tuple[tuple[str, str], ...] = ()
    condition: Condition = None
    source_unique: bool = False
    all_pairs: bool = False
    between: Between | None = None
    matched: tuple[Clause, ...] = ()
    not_matched: tuple[Clause, ...] = ()
    seen: str | None = None  # what a named target held when the merge was made

    def using(self, source: DataFrame, alias: str = "source") -> Merge:
        return replace(self, source=source, source_alias=alias)

    def on(self, condition: Column | str, all_pairs: bool = False) -> Merge:
        """Match on any boolean condition over the two aliases.

        Spark takes the equalities in it as join keys. Without any, the join would compare every pair,
        which is an error unless ``all_pairs`` asks for it.
        """
        return replace(self, condition=condition, keys=(), between=None, all_pairs=all_pairs)

    def on_keys(
        self,
        keys: Sequence[str | tuple[str, str]],
        source_unique: bool = False,
        condition: Condition = None,
    ) -> Merge:
        """Match on equal keys, given as names or (target name, source name) pairs, and a ``condition``.

        Prefer this to ``on`` for equalities: source rows that compete for one target row can only be
        those whose key repeats, so the keys of the source are looked at first (a small job), and the target
        only if some do. ``source_unique`` promises that no key repeats in the source.
        """
        pairs = tuple((k, k) if isinstance(k, str) else tuple(k) for k in keys)
        return replace(self, keys=pairs, condition=condition, between=None, source_unique=source_unique)

    def on_range(
        self,
        point: str,
        low: str,
        high: str,
        point_in: str = "target",
        keys: Sequence[str | tuple[str, str]] = (),
        condition: Condition = None,
    ) -> Merge:
        """Match the target's ``point`` with source rows where ``low`` <= ``point`` <= ``high``; further ``keys`` and a ``condition`` as in ``on_keys``.

        With ``point_in="source"`` the source has the point and the target the bounds. Numbers, dates and times will do. No
        pairs are compared beyond those that share a bucket (``join_in_range``); both sides are written once, with row numbers.
        """
        if point_in not in ("target", "source"):
            raise ValueError(f"point_in must be target or source, not {point_in}")
        merge = self.on_keys(keys, condition=condition)
        return replace(merge, between=Between(point, low, high, point_in))

    def when_matched(self, condition: Condition = None) -> Matched:
        return Matched(self, condition)

    def when_not_matched(self, condition: Condition = None) -> NotMatched:
        return NotMatched(self, condition)

    def _matched(self, clause: Clause) -> Merge:
        return replace(self, matched=(*self.matched, clause))

    def _not_matched(self, clause: Clause) -> Merge:
        return replace(self, not_matched=(*self.not_matched, clause))

    def result(self) -> DataFrame:
        """The target after the merge."""
        if self.source is None:
            raise ValueError("a merge needs a source")
        if self.condition is None and not self.keys and self.between is None:
            raise ValueError("a merge needs a match condition")
        require_columns(self.target, [t for t, _ in self.keys], "target keys")
        require_columns(self.source, [s for _, s in self.keys], "source keys")
        if self.between is not None:
            return self._merged_in_range()
        rows = self._rewritten_target() if self.matched else self.target
        return rows.unionByName(self._inserted()) if self.not_matched else rows

    def touched(self) -> DataFrame:
        """Target rows that some source row matches, whether a clause applies to them or not."""
        if self.between is not None:
            numbered, _, pairs = self._numbered()
            return pick(numbered.join(splittable_keys(pairs.select(_ROW)), _ROW, "left_semi"), self.target.columns)
        target = self.target.alias(self.target_alias)
        if self.keys and self.condition is None:
            keys = splittable_keys(self._source_keys())
            on = _all([self._t(t) == keys[_key(i)] for i, (t, _) in enumerate(self.keys)])
            return target.join(keys, on, "left_semi")
        return self._checked(target.join(self.source.alias(self.source_alias), self._match(), "left_semi"))

    # The two sides

    def _t_name(self, name: str) -> str:
        return f"{quoted(self.target_alias)}.{quoted(name)}"

    def _s_name(self, name: str) -> str:
        return f"{quoted(self.source_alias)}.{quoted(name)}"

    def _t(self, name: str) -> Column:
        return F.col(self._t_name(name))

    def _s(self, name: str) -> Column:
        return F.col(self._s_name(name))

    def _values(self, clause: Clause) -> dict[str, Column | str]:
        """New values of a clause under the target's own column names."""
        if clause.values is None:
            by_lower = {n.lower(): n for n in self.source.columns}
            missing = [n for n in self.target.columns if n.lower() not in by_lower]
            if missing:
                raise ValueError(f"the source has no columns {missing}")
            return {n: self._s_name(by_lower[n.lower()]) for n in self.target.columns}
        by_lower = {n.lower(): n for n in self.target.columns}
        unknown = [n for n in clause.values if n.lower() not in by_lower]
        if unknown:
            raise ValueError(f"the target has no columns {unknown}")
        return {by_lower[n.lower()]: value for n, value in clause.values.items()}

    def _source_keys(self) -> DataFrame:
        """The source's side of the keys, named by position."""
        return self.source.select([col(s).alias(_key(i)) for i, (_, s) in enumerate(self.keys)])

    def _target_keys(self) -> DataFrame:
        return self.target.select([col(t).alias(_key(i)) for i, (t, _) in enumerate(self.keys)])

    def _source_with_keys(self) -> DataFrame:
        """Source rows that can match: none of their keys is null."""
        return self.source.where(_all([col(s).isNotNull() for _, s in self.keys]))

    def _match(self) -> Column:
        """The whole match condition over both aliases."""
        equal = [self._t(t) == self._s(s) for t, s in self.keys]
        return _all([*equal, *([] if self.condition is None else [_as_column(self.condition)])])

    def _checked(self, joined: DataFrame) -> DataFrame:
        """The join, unless it compares every pair and nobody asked for that."""
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        if not self.all_pairs and any(name in plan for name in _ALL_PAIRS):
            raise ValueError("the match condition has no equality of the two sides; all_pairs=True compares every pair")
        return joined

    # Matched rows

    def _only_deletes(self) -> bool:
        """A lone unconditional delete; a row may then be matched any number of times."""
        if len(self.matched) != 1:
            return False
        clause = self.matched[0]
        return clause.kind == "delete" and clause.condition is None

    def _undeleted(self) -> DataFrame:
        target = self.target.alias(self.target_alias)
        if self.condition is not None:
            source = self.source.alias(self.source_alias)
            return self._checked(target.join(source, self._match(), "left_anti"))
        keys = splittable_keys(self._source_keys())
        on = _all([self._t(t) == keys[_key(i)] for i, (t, _) in enumerate(self.keys)])
        return target.join(keys, on, "left_anti")

    def _joined_on_keys(self) -> tuple[DataFrame, Column, Column]:
        """Target rows next to their source row, the test for a match and that for competition.

        Competing source rows are looked for among the keys alone, before the join: keys that
        repeat in the source (usually none) and occur in the target. The source side of the join is
        the very frame that the insert part starts from, so its shuffle is used for both.
        """
        target = self.target.alias(self.target_alias)
        source = self._source_with_keys().alias(self.source_alias)
        on = self._match()
        is_match = self._s(self.keys[0][1]).isNotNull()
        repeated = splittable_keys(self._source_keys(), at_least=2)
        if self.source_unique or repeated.isEmpty():
            return target.join(source, on, "left"), is_match, F.lit(False)
        if self.condition is not None:
            return self._joined_on_condition()
        held = self._target_keys()
        contested = held.join(repeated, held.columns, "left_semi").agg(F.count(F.lit(1)))
        return target.join(source, on, "left"), is_match, contested.scalar() > 0

    def _joined_on_condition(self) -> tuple[DataFrame, Column, Column]:
        target = self.target.alias(self.target_alias)
        source = self.source.withColumn(_FOUND, F.lit(1)).alias(self.source_alias)
        joined = self._checked(target.join(source, self._match(), "left"))
        # A left join gives more rows than its left side has only if some row is matched twice.
        rows_after = joined.agg(F.count(F.lit(1))).scalar()
        rows_before = self.target.agg(F.count(F.lit(1))).scalar()
        return joined, self._s(_FOUND).isNotNull(), rows_after > rows_before

    def _rewritten_target(self) -> DataFrame:
        if self._only_deletes():
            return self._undeleted()
        side_by_side = self._joined_on_keys if self.keys else self._joined_on_condition
        joined, is_match, competing = side_by_side()
        action = F.when(~is_match, F.lit(-1)).when(
            competing, F.raise_error(TOO_MANY).cast("int")
        )
        for i, clause in enumerate(self.matched):
            action = action.when(_as_column(clause.condition), F.lit(i))
        joined = joined.withColumn(_ACTION, action.otherwise(F.lit(-1)))

        deleting = [i for i, c in enumerate(self.matched) if c.kind == "delete"]
        if deleting:
            joined = joined.where(~F.col(_ACTION).isin(deleting))
        updates = {i: self._values(c) for i, c in enumerate(self.matched) if c.kind == "update"}
        return joined.select(
            [
                _chosen(field, self._t_name(field.name), updates)
                for field in self.target.schema.fields
            ]
        )

    # Matches by range

    def _numbered(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Both sides with row numbers, and the pairs of numbers that match."""
        target = materialize(self.target.withColumn(_ROW, F.monotonically_increasing_id()))
        source = materialize(self.source.withColumn(_SOURCE_ROW, F.monotonically_increasing_id()))
        sides, aliases, keys = (target, source), (self.target_alias, self.source_alias), self.keys
        if self.between.point_in == "source":
            sides, aliases, keys = sides[::-1], aliases[::-1], [(s, t) for t, s in keys]
        bounds = (self.between.point, self.between.low, self.between.high)
        condition = None if self.condition is None else _as_column(self.condition)
        met = join_in_range(*sides, *bounds, aliases, keys, condition)
        return target, source, materialize(met.select(self._t(_ROW), self._s(_SOURCE_ROW)))

    def _merged_in_range(self) -> DataFrame:
        """The merge on row numbers: every source row goes on once for each target row that it matches."""
        target, source, pairs = self._numbered()
        rows = self.target
        if self.matched:
            matching = source.join(pairs, _SOURCE_ROW).drop(_SOURCE_ROW)
            numbered = replace(self, target=target, source=matching, keys=((_ROW, _ROW),), condition=None, between=None)
            rows = pick(numbered._rewritten_target(), self.target.columns)
        return rows.unionByName(self._inserted(self._alone(source, pairs))) if self.not_matched else rows

    def _alone(self, source: DataFrame, pairs: DataFrame) -> DataFrame:
        return source.join(splittable_keys(pairs.select(_SOURCE_ROW)), _SOURCE_ROW, "left_anti").drop(_SOURCE_ROW)

    # Unmatched source rows

    def _unmatched(self) -> DataFrame:
        if self.between is not None:
            return self._alone(*self._numbered()[1:])
        if self.condition is not None:
            source = self.source.alias(self.source_alias)
            target = self.target.alias(self.target_alias)
            return self._checked(source.join(target, self._match(), "left_anti"))
        held = self._target_keys()
        # The keys found are no more than the source has, and a source that is small enough to be
        # broadcast finds them without moving the target.
        wanted = splittable_keys(self._source_keys())
        found = splittable_keys(held.join(wanted, held.columns, "left_semi"))
        on = _all([col(s) == found[_key(i)] for i, (_, s) in enumerate(self.keys)])
        fresh = self._source_with_keys().join(found, on, "left_anti")

        nullable = [s for _, s in self.keys if self.source.schema[s].nullable]
        if not nullable:
            return fresh
        # A null key matches nothing. Such rows skip the join, where they would all meet in one task.
        keyless = ~_all([col(s).isNotNull() for s in nullable])
        return fresh.unionByName(self.source.where(keyless))

    def _inserted(self, unmatched: DataFrame | None = None) -> DataFrame:
        rows = (self._unmatched() if unmatched is None else unmatched).alias(self.source_alias)
        action = F.when(_as_column(self.not_matched[0].condition), F.lit(0))
        for i, clause in enumerate(self.not_matched[1:], start=1):
            action = action.when(_as_column(clause.condition), F.lit(i))
        rows = rows.withColumn(_ACTION, action).where(F.col(_ACTION).isNotNull())
        inserts = {i: self._values(c) for i, c in enumerate(self.not_matched)}
        return rows.select(
            [
                _chosen(field, "NULL", inserts)
                for field in self.target.schema.fields
            ]
        )


def _chosen(field: T.StructField, default: str, by_action: Mapping[int, Values]) -> Column:
    """The value of one target column after the clause picked for the row."""
    picks = [(i, values[field.name]) for i, values in by_action.items() if field.name in values]
    # Each branch is cast by itself: a common type of all branches could lose digits of the old value.
    if isinstance(field.dataType, T.AtomicType) and all(isinstance(v, str) for _, v in picks):
        # One expression per column, as a wide table has many.
        as_type = field.dataType.simpleString()
        cases = "".join(f" WHEN {_ACTION} = {i} THEN CAST(({v}) AS {as_type})" for i, v in picks)
        value = F.expr(f"CASE{cases} ELSE {default} END" if picks else default)
    else:
        value = F.expr(default)
        for i, new in picks:
            new = F.expr(new) if isinstance(new, str) else new
            value = F.when(F.col(_ACTION) == i, new.cast(field.dataType)).otherwise(value)
    return value.cast(field.dataType).alias(field.name)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("row_key",),
    source_unique: bool = False,
) -> DataFrame:
    """Replace target rows by the source row of the same key and add the other source rows.

    With a unique source the two sides need no row-by-row comparison: the target rows that stay
    are those the source has no key for.
    """
    if not source_unique:
        return (
            Merge(target)
            .using(source)
            .on_keys(keys)
            .when_matched()
            .update_all()
            .when_not_matched()
            .insert_all()
            .result()
        )
    require_columns(target, keys, "target keys")
    new = as_schema(source, target.schema)
    stay = target.join(source.select([col(k) for k in keys]), list(keys), "left_anti")
    return pick(stay, target.columns).unionByName(new)

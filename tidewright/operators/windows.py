"""Columns computed over windows, also where one group is very large.

Spark evaluates a window group in one task. That is the right plan until one
group holds a large share of all rows. So the group sizes are counted first,
and only the rows of oversized groups take another way: they are spread over
range buckets in window order, each bucket is evaluated by itself, and what
the buckets before it add up to is carried in. There are at most as many
carries as buckets plus hot groups; these are broadcast if they are few.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType

from tidewright.errors import JobError
from tidewright.names import Expression, column, expression as to_column, fold, has_unique_names, is_case_sensitive
from tidewright.operators.skew import HOT_ROWS, hot_groups, same_keys, small
from tidewright.work import comes_in_order, is_repeatable, stage

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_CALL = re.compile(r"\s*(\w+)\s*\((.*)\)\s*", re.DOTALL)

# Digits, and decimals, of the decimals whose means are exact when split; others
# would need more than the 38 digits of Spark's decimals on the way.
_MEAN_DIGITS, _MEAN_SCALE = 33, 13

# Names of the columns added on the way.
_BUCKET, _TIE, _SIZE = "__bucket", "__tie", "__group_rows"

# Functions Spark accepts only in a window with an order.
_WINDOW_ONLY = {"row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile", "lag", "lead", "nth_value"}

# Functions that give one row's value and may pass over nulls, and those of two values.
_PLACED = {"first", "first_value", "any_value", "last", "last_value"}
_OF_TWO = {"min_by", "max_by", "corr", "covar_pop", "covar_samp"}


@dataclass
class WindowColumn:
    """``name`` = ``expression`` OVER (PARTITION BY .. ORDER BY ..).

    With ``order_by`` the frame runs from the start of the group to the current
    row and its ties, without it the frame is the whole group. Ascending order
    puts NULLs first, descending last. Both lists may be empty.
    """

    name: str
    expression: Expression
    partition_by: Sequence[str] = ()
    order_by: Sequence[str | Mapping] = ()

    def __post_init__(self):
        if not self.name or not _IDENTIFIER.fullmatch(self.name.strip()):
            raise JobError(f"window: 'name' must be an identifier, not '{self.name}'")
        if self.expression is None:
            raise JobError("window: 'expression' is required")
        self.name = self.name.strip()
        self.partition_by = list(self.partition_by)
        self.orders = [_order(item) for item in self.order_by]
        self.call = function_call(self.expression) if isinstance(self.expression, str) else None
        if self.call and self.call.condition:
            # Spark has no FILTER in windows.
            self.expression = self.call.filtered()
            self.call = function_call(self.expression)
        self.scale = None

    @property
    def function(self) -> str | None:
        return self.call.function if self.call else None

    @property
    def arguments(self) -> list[str]:
        return self.call.arguments if self.call else []

    @property
    def ignores_nulls(self) -> bool:
        flag = self.arguments[1].lower() if self.function in _PLACED and len(self.arguments) == 2 else ""
        return self.call.ignores_nulls or flag == "true"

    @property
    def values(self) -> list[str]:
        """The arguments that are values of rows."""
        return self.arguments[: 2 if self.function in _OF_TWO else 1]

    @property
    def steps(self) -> int:
        """How many rows away, or which row or how many tiles, the function asks for."""
        given = self.arguments if self.function == "ntile" else self.arguments[1:]
        return int(given[0]) if given and given[0].isdigit() else 1

    @property
    def default(self) -> str | None:
        return self.arguments[2] if self.function in ("lag", "lead") and len(self.arguments) == 3 else None

    def over(self, df: DataFrame) -> Column:
        spec = Window.partitionBy(*self.partition_by)
        if self.orders:
            spec = spec.orderBy(*[_sort(F.col(source), desc) for source, desc in self.orders])
        return to_column(df, self.expression).over(spec)

    def is_whole_group(self) -> bool:
        return not self.orders and self.function is not None and self.function not in _WINDOW_ONLY

    def is_splittable(self) -> bool:
        return bool(self.orders) and self.function is not None and _has_split_form(self)

    def mentions(self, names: Sequence[str]) -> bool:
        """Whether any of ``names`` may occur in it."""
        if not isinstance(self.expression, str):
            return True
        text = " ".join([self.expression, *self.partition_by, *[source for source, _ in self.orders]]).lower()
        return any(re.search(rf"\b{re.escape(name.lower())}\b", text) for name in names)


def window(
    df: DataFrame,
    name: str,
    expression: Expression,
    partition_by: Sequence[str] = (),
    order_by: Sequence[str | Mapping] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add one window column, or replace the column of that name."""
    return windows(df, [WindowColumn(name, expression, partition_by, order_by)], hot_rows)


def windows(df: DataFrame, columns: Sequence[WindowColumn], hot_rows: int | None = None) -> DataFrame:
    """Add window columns one after the other.

    Neighbours that do not build on each other are computed together. If they
    share their groups, group sizes are counted once, and hot groups are put in
    order once; without an order each kind of group is one more reading. Groups of more than ``hot_rows`` rows count as hot.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    for group in _independent(columns):
        unique = has_unique_names(df)
        if unique and all(c.is_whole_group() for c in group):
            df = _whole_groups(df, group)
        elif unique and all(c.is_splittable() and _is_exact(df, c) for c in group):
            df = _ordered(df, group, limit)
        else:
            for one in group:
                if one.orders:
                    warnings.warn(f"window '{one.name}': '{one.expression}' takes each of its groups in one task", stacklevel=2)
            df = _plain(df, group)
    return df


def _independent(columns: Sequence[WindowColumn]) -> Iterator[list[WindowColumn]]:
    group: list[WindowColumn] = []
    for one in columns:
        alike = group and (
            one.is_whole_group() == group[0].is_whole_group()
            and (one.is_whole_group() or one.partition_by == group[0].partition_by)
            and one.is_splittable() == group[0].is_splittable()
            and not one.mentions([c.name for c in group])
            and one.name.lower() not in [c.name.lower() for c in group]
        )
        if group and not alike:
            yield group
            group = []
        group.append(one)
    if group:
        yield group


def _order(item: str | Mapping) -> tuple[str, bool]:
    if isinstance(item, str):
        return item, False
    if not item.get("column"):
        raise JobError("window: 'order_by' entries need a 'column'")
    return item["column"], bool(item.get("desc", False))


def _sort(source: Column, desc: bool) -> Column:
    return source.desc() if desc else source.asc()


@dataclass
class _Call:
    """A single function call, as it stands in the text."""

    function: str
    arguments: list[str]
    ignores_nulls: bool = False
    condition: str | None = None

    def filtered(self) -> str:
        """The call with its FILTER condition moved into the argument whose nulls it passes over."""
        if self.function in {*_POSITIONS, *_PLACED} and not self.ignores_nulls:
            raise JobError(f"window: '{self.function}' takes no FILTER")
        arguments = list(self.arguments)
        at = 1 if self.function in ("min_by", "max_by") else 0
        value = "1" if arguments[at : at + 1] in ([], ["*"]) else arguments[at]
        arguments[at : at + 1] = [f"CASE WHEN {self.condition} THEN {value} END"]
        return f"{self.function}({', '.join(arguments)})" + (" IGNORE NULLS" if self.ignores_nulls else "")


_FILTER = re.compile(r"(.*\))\s*filter\s*\(\s*where\b(.*)\)\s*", re.IGNORECASE | re.DOTALL)
_NULLS = re.compile(r"(.*\))\s*(ignore|respect)\s+nulls\s*", re.IGNORECASE | re.DOTALL)


def function_call(text: str) -> _Call | None:
    """The parts of ``text`` if it is a single function call."""
    condition, ignores = None, False
    if found := _NULLS.fullmatch(text):
        text, ignores = found[1], found[2].lower() == "ignore"
    if found := _FILTER.fullmatch(text):
        text, condition = found.groups()
        if _arguments(condition) is None:
            return None
    match = _CALL.fullmatch(text)
    if match is None or re.match(r"\s*distinct\b", match[2], re.IGNORECASE):
        return None
    arguments = _arguments(match[2])
    return None if arguments is None else _Call(match[1].lower(), arguments, ignores, condition and condition.strip())


def _arguments(body: str) -> list[str] | None:
    """What stands between the commas outside brackets and quotes; None if those don't match."""
    arguments, depth, start, quote = [], 0, 0, None
    if "\\" in body:
        return None
    for at, letter in enumerate(body):
        if quote or letter in "'\"`":
            quote = letter if quote is None else (None if letter == quote else quote)
        elif letter == "(":
            depth += 1
        elif letter == ")":
            depth -= 1
            if depth < 0:
                return None
        elif letter == "," and depth == 0:
            arguments.append(body[start:at].strip())
            start = at + 1
    if depth or quote:
        return None
    last = body[start:].strip()
    return arguments + ([last] if last else [])


def _has_split_form(one: WindowColumn) -> bool:
    function, arguments = one.function, one.arguments
    if function in _PLACED:
        flag = len(arguments) == 2 and arguments[1].lower() in ("true", "false")
        return len(arguments) == 1 or flag
    if one.ignores_nulls:
        return False
    if function in _POSITIONS:
        numbers = arguments if function == "ntile" else arguments[1:2]
        fits = len(arguments) in _POSITIONS[function] and all(n.isdigit() and int(n) > 0 for n in numbers)
        return fits and (function == "ntile" or one.steps <= (_MOST_STEPS if function in ("lag", "lead") else _LAST_PLACE))
    return function in _PEERS and len(arguments) in ((2,) if function in _OF_TWO else (0, 1))


def _is_exact(df: DataFrame, one: WindowColumn) -> bool:
    """Whether splitting gives the very value: not for means of very long decimals, nor for values without an order."""
    if not one.values or one.values == ["*"]:
        return True
    kinds = [field.dataType for field in df.select(*[F.expr(v).alias(f"v{i}") for i, v in enumerate(one.values)]).schema]
    if one.function in ("avg", "mean"):
        one.scale = df.select(F.avg(F.expr(one.values[0])).alias("v")).schema["v"].dataType
        one.scale = one.scale.scale if isinstance(one.scale, DecimalType) else None
        return not isinstance(kinds[0], DecimalType) or (kinds[0].precision <= _MEAN_DIGITS and kinds[0].scale <= _MEAN_SCALE)
    return not any("map<" in kind.simpleString() or "variant" in kind.simpleString() for kind in kinds)


def _plain(df: DataFrame, group: Sequence[WindowColumn]) -> DataFrame:
    """Spark's own windows; those that don't mention each other in one step."""
    if has_unique_names(df) and not any(one.mentions([c.name for c in group[:at]]) for at, one in enumerate(group)):
        return df.withColumns({one.name: one.over(df) for one in group})
    return reduce(lambda frame, one: frame.withColumn(one.name, one.over(frame)), group, df)


def _with_values(joined: DataFrame, df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """The columns of ``df``, with ``values`` replaced in place or appended."""
    exact = is_case_sensitive(df)
    given = {fold(name, exact): value.alias(name) for name, value in values.items()}
    present = {fold(c, exact) for c in df.columns}
    kept = [given.get(fold(c, exact), column(c)) for c in df.columns]
    return joined.select(*kept, *[value for name, value in given.items() if name not in present])


def _numbered_names(prefix: str, count: int) -> list[str]:
    return [f"__{prefix}{i}" for i in range(count)]


def _aliased(names: Sequence[str], aliases: Sequence[str]) -> list[Column]:
    return [F.col(name).alias(alias) for name, alias in zip(names, aliases)]


def _whole_groups(df: DataFrame, group: Sequence[WindowColumn]) -> DataFrame:
    """Aggregates of whole groups, put beside each of their rows.

    Aggregating first and joining back never gathers a group's rows: without
    ``partition_by`` each value is one scalar, with it Spark broadcasts the
    groups if they turn out small and otherwise splits skewed join partitions.
    All are aggregated from the same frame. It is staged if another reading of
    it could give other rows.
    """
    df = df if is_repeatable(df) else stage(df)
    joined, values = df, {}
    for at, sources in enumerate(_distinct([c.partition_by for c in group])):
        alike = [c for c in group if c.partition_by == sources]
        if not sources:
            values.update({c.name: df.agg(F.expr(c.expression.strip())).scalar() for c in alike})
            continue
        keys, others = _numbered_names(f"key{at}_", len(sources)), _numbered_names(f"other{at}_", len(sources))
        names = _numbered_names(f"value{at}_", len(alike))
        grouped = df.groupBy(*_aliased(sources, others)).agg(
            *[F.expr(c.expression.strip()).alias(name) for c, name in zip(alike, names)]
        )
        joined = joined.select("*", *_aliased(sources, keys)).join(grouped, same_keys(keys, others), "left")
        values.update({c.name: F.col(name) for c, name in zip(alike, names)})
    return _with_values(joined, df, {c.name: values[c.name] for c in group})


def _ordered(df: DataFrame, group: Sequence[WindowColumn], limit: int) -> DataFrame:
    df = df if is_repeatable(df) else stage(df)
    plain = _plain(df, group)
    sources = group[0].partition_by
    keys, hot_names = _numbered_names("key", len(sources)), _numbered_names("hot", len(sources))
    keyed = df.select("*", *_aliased(sources, keys))
    found = hot_groups(keyed, keys, hot_names, _SIZE, limit)
    if found is None:
        return plain
    if not keys:
        rows, cold = keyed.withColumn(_SIZE, F.lit(found.rows)), None
    else:
        hot = small(found.frame, found.groups)
        rows = keyed.join(hot, same_keys(keys, hot_names)).drop(*hot_names)
        cold = keyed.join(hot, same_keys(keys, hot_names), "left_anti").select(*[column(c) for c in df.columns])
    split = _Split(keys, max(2, math.ceil(found.rows / max(limit, 1))), found.groups)
    # A tie must be broken the same way if a task is run again: rows that come
    # out of a shuffle may come in another order then, so they are kept first.
    valued, values = rows.withColumn(_TIE, F.monotonically_increasing_id()), {}
    if not comes_in_order(rows):
        valued = stage(valued)
    for orders, alike in _chains(group):
        valued, found_here = split.evaluate(valued, orders, alike)
        values.update(found_here)
    types = {c.name: plain.schema[c.name].dataType for c in group}
    result = _with_values(valued, df, {c.name: values[at].cast(types[c.name]) for at, c in enumerate(group)})
    return result if cold is None else _plain(cold, group).union(result)


def _distinct(items: Sequence) -> list:
    return [item for at, item in enumerate(items) if item not in items[:at]]


class _Split:
    """Window columns of hot groups, whose rows are spread over many tasks.

    ``keys`` name the columns that tell the ``groups`` groups apart. Rows are laid out once in
    window order over range buckets. Each bucket is a window of its own; what it needs of the
    others is made from one row a bucket and group: how many rows and order keys there are, the
    totals of all its rows, of those that tie with its first and with its last, and the values at its ends.
    """

    def __init__(self, keys: Sequence[str], buckets: int, groups: int):
        self.keys, self.buckets, self.groups = list(keys), buckets, groups

    def evaluate(
        self, rows: DataFrame, orders: list, columns: Sequence[tuple[int, WindowColumn]]
    ) -> tuple[DataFrame, dict[int, Column]]:
        """``rows`` with all that ``columns`` need, whose orders all begin ``orders``, and their values."""
        rows, parts = self._with_parts(rows, columns)
        sorts = [_sort(F.col(source), desc) for source, desc in orders]
        local = self._local(self._bucketed(rows, [*sorts, F.col(_TIE).asc()]), [*sorts, F.col(_TIE).asc()], columns, parts)
        carries = self._carries(local, columns, parts)
        mine = [_BUCKET, *self.keys]
        others = _numbered_names("carry", len(mine))
        kept = [c for c in carries.columns if c not in mine]
        # A bucket's rows of one group are no more than a task's share.
        joined = local.join(
            small(carries.select(*_aliased(mine, others), *kept), self.buckets + self.groups), same_keys(mine, others)
        )
        values = {at: self._value(at, one, parts.get(at, {})).alias(f"__w{at}") for at, one in columns}
        given = [column(c) for c in rows.columns if c not in _SCRATCH and not c.startswith("__in_")]
        return joined.select(*given, *values.values()), {at: F.col(f"__w{at}") for at in values}

    def _bucketed(self, rows: DataFrame, sorts: Sequence[Column]) -> DataFrame:
        """``rows`` in window order over range buckets, with the bucket's number.

        The bounds are drawn from a sample, so the result is kept: every later
        use must see the same buckets. Ties are broken freely, so that even rows
        with equal order keys spread over buckets.
        """
        placed = rows.repartitionByRange(self.buckets, *[F.col(k).asc() for k in self.keys], *sorts)
        return stage(placed.withColumn(_BUCKET, F.spark_partition_id()))

    def _with_parts(self, rows: DataFrame, columns) -> tuple[DataFrame, dict[int, dict]]:
        """The arguments of all aggregates as columns, and each aggregate's parts."""
        parts = {}
        for at, one in columns:
            if one.function not in _PEERS or one.function in _POSITIONS and not one.ignores_nulls:
                continue
            sources = [F.lit(1) if a == "*" else F.expr(a) for a in one.values or ["1"]]
            if one.function in _CENTRED:
                sources = [s.cast("double") for s in sources]
                if len(sources) == 2:
                    both = sources[0].isNotNull() & sources[1].isNotNull()
                    sources = [F.when(both, s) for s in sources]
                rows, sources = self._centred(rows, sources, f"__in_{at}")
            names = [f"__in_{at}_{i}" for i in range(len(sources))]
            rows = rows.withColumns(dict(zip(names, sources)))
            made = _PEERS[one.function][0](*[F.col(name) for name in names], one.ignores_nulls)
            parts[at] = {f"__in_{at}_{part}": own for part, own in made.items()}
        return rows, parts

    def _centred(self, rows: DataFrame, sources: Sequence[Column], name: str) -> tuple[DataFrame, list[Column]]:
        """Values less the mean of their group. Products are summed around it, as
        those of large numbers would drown their differences."""
        means = [f"{name}_mean{i}" for i in range(len(sources))]
        aggregates = [F.avg(source).alias(mean) for source, mean in zip(sources, means)]
        if not self.keys:
            scalars = rows.agg(F.struct(*aggregates).alias("means"))
            return rows, [s - scalars.select(f"means.{mean}").scalar() for s, mean in zip(sources, means)]
        others = [f"{name}_key{i}" for i in range(len(self.keys))]
        found = rows.groupBy(*_aliased(self.keys, others)).agg(*aggregates)
        # one row per hot group
        joined = rows.join(small(found, self.groups), same_keys(self.keys, others))
        return joined, [s - F.col(mean) for s, mean in zip(sources, means)]

    def _local(self, bucketed: DataFrame, sorts: Sequence[Column], columns, parts) -> DataFrame:
        """Each bucket by itself: places, ties and running totals within it."""
        whole = Window.partitionBy(_BUCKET, *self.keys)
        in_order = whole.orderBy(*sorts)
        added = {_AT: F.row_number().over(in_order)}
        for at, one in columns:
            steps = one.steps
            if one.function == "lag":
                added[f"__near{at}"] = F.lag(F.struct(F.expr(one.values[0]).alias("value")), steps).over(in_order)
            elif one.function == "lead":
                added[f"__near{at}"] = F.lead(F.struct(F.expr(one.values[0]).alias("value")), steps).over(in_order)
        local = bucketed.withColumns(added)
        for tag, orders in _tags(columns):
            by = whole.orderBy(*[_sort(F.col(source), desc) for source, desc in orders])
            # The frame of an ordered window ends with the ties of the row.
            local = local.withColumns({
                f"__rank{tag}": F.rank().over(by), f"__dense{tag}": F.dense_rank().over(by),
                f"__upto{tag}": F.count(F.lit(1)).over(by),
                **{part: partial(source).over(by) for at, one in columns if one.orders == orders
                   for part, (partial, _, source) in parts.get(at, {}).items()},
            })
        return local.withColumn(_IN, F.count(F.lit(1)).over(whole))

    def _carries(self, local: DataFrame, columns, parts) -> DataFrame:
        """For each bucket and group what comes in from the buckets before and after it."""
        made = [F.count(F.lit(1)).alias(_IN)]
        for tag, orders in _tags(columns):
            first, last = F.col(f"__rank{tag}") == 1, F.col(f"__upto{tag}") == F.col(_IN)
            key = F.struct(*[F.col(source).alias(f"k{i}") for i, (source, _) in enumerate(orders)])
            made += [
                F.min_by(key, _AT).alias(f"__first{tag}"), F.max_by(key, _AT).alias(f"__last{tag}"),
                F.count_if(first).alias(f"__firsts{tag}"), F.count_if(last).alias(f"__lasts{tag}"),
                F.max(f"__dense{tag}").alias(f"__keys{tag}"),
            ]
            for at, one in columns:
                if one.orders == orders:
                    for part, (partial, _, source) in parts.get(at, {}).items():
                        made += [partial(source).alias(part), partial(F.when(first, source)).alias(f"{part}_first")]
        for at, one in columns:
            if one.function in _POSITIONS and one.values and not one.ignores_nulls and one.function != "ntile":
                entry = F.struct(F.col(_AT).alias("at"), F.expr(one.values[0]).alias("value"))
                from_end = F.col(_IN) - F.col(_AT)
                near = from_end < one.steps if one.function == "lag" else F.col(_AT) <= one.steps
                listed = F.collect_list(F.when(near, entry))
                made.append(F.array_sort(listed, lambda a, b: a["at"] - b["at"]).alias(f"__ends{at}"))
        buckets = local.groupBy(_BUCKET, *self.keys).agg(*made)

        along = Window.partitionBy(*self.keys).orderBy(_BUCKET)
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        carried = {_BEFORE: F.coalesce(F.sum(_IN).over(earlier), F.lit(0))}
        for tag, orders in _tags(columns):
            goes_on = F.coalesce(F.col(f"__first{tag}").eqNullSafe(F.lag(f"__last{tag}").over(along)), F.lit(False))
            goes_on &= F.lag(_IN).over(along).isNotNull()
            buckets = buckets.withColumn(f"__on{tag}", goes_on)
            next_on = F.coalesce(F.lead(f"__on{tag}").over(along), F.lit(False))
            alike_last = Window.partitionBy(*self.keys, f"__last{tag}").orderBy(_BUCKET)
            alike_first = Window.partitionBy(*self.keys, f"__first{tag}").orderBy(_BUCKET)
            onward = alike_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
            so_far = alike_last.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            # Ties that reach over several buckets: of the first rows those before, of the last those after.
            tied = {f"__tied{tag}": F.sum(f"__lasts{tag}").over(so_far), f"__more{tag}": F.sum(f"__firsts{tag}").over(onward)}
            for at, one in columns:
                if one.orders == orders:
                    tied.update({f"{part}_on": total(F.col(f"{part}_first")).over(onward)
                                 for part, (_, total, _) in parts.get(at, {}).items()})
            buckets = buckets.withColumns(tied)
            carried[f"__tied{tag}"] = F.when(F.col(f"__on{tag}"), F.lag(f"__tied{tag}").over(along)).otherwise(0)
            carried[f"__more{tag}"] = F.when(next_on, F.lead(f"__more{tag}").over(along)).otherwise(0)
            own_keys = F.col(f"__keys{tag}") - F.col(f"__on{tag}").cast("int")
            carried[f"__earlier{tag}"] = F.coalesce(F.sum(own_keys).over(earlier), F.lit(0))
            for at, one in columns:
                if one.orders == orders:
                    for part, (_, total, _) in parts.get(at, {}).items():
                        carried[f"{part}_before"] = total(F.col(part)).over(earlier)
                        carried[f"{part}_after"] = F.when(next_on, F.lead(f"{part}_on").over(along))
        for at, one in columns:
            ends = f"__ends{at}"
            if one.function == "lag":
                # Each bucket of a group has a row of it at least, so that many buckets are enough.
                carried[ends] = F.flatten(F.collect_list(ends).over(along.rowsBetween(-one.steps, -1)))
            elif one.function == "lead":
                carried[ends] = F.flatten(F.collect_list(ends).over(along.rowsBetween(1, one.steps)))
            elif one.function in ("first", "first_value", "any_value", "nth_value") and not one.ignores_nulls:
                before = F.coalesce(F.sum(_IN).over(earlier), F.lit(0))
                place = (F.lit(one.steps) - before).cast("int")
                here = F.when((place >= 1) & (place <= F.size(ends)), F.get(F.col(ends), place - 1))
                buckets = buckets.withColumn(f"__here{at}", here)
                everything = Window.partitionBy(*self.keys)
                carried[ends] = F.first(f"__here{at}", ignorenulls=True).over(everything)
        on = [F.col(f"__on{tag}") for tag, _ in _tags(columns)]
        return buckets.select(_BUCKET, *self.keys, *on, *[value.alias(name) for name, value in carried.items()])

    def _value(self, at: int, one: WindowColumn, parts: Mapping) -> Column:
        tag = next(tag for tag, orders in _tags([(at, one)]))
        number = F.col(_BEFORE) + F.col(_AT)
        is_first, is_last = F.col(f"__rank{tag}") == 1, F.col(f"__upto{tag}") == F.col(_IN)
        # Where the first tie began in an earlier bucket, its rows there come off; no tie, nothing to take off.
        rank = F.col(_BEFORE) + F.col(f"__rank{tag}") - F.when(is_first, F.col(f"__tied{tag}")).otherwise(0)
        dense = F.col(f"__earlier{tag}") + F.col(f"__dense{tag}") - F.col(f"__on{tag}").cast("int")
        upto = F.col(_BEFORE) + F.col(f"__upto{tag}") + F.when(is_last, F.col(f"__more{tag}")).otherwise(0)
        ends, near = F.col(f"__ends{at}"), F.col(f"__near{at}")
        size = F.col(_SIZE)
        match one.function:
            case "row_number":
                return number
            case "rank":
                return rank
            case "dense_rank":
                return dense
            case "percent_rank":
                return F.when(size > 1, (rank - 1) / F.greatest(size - 1, F.lit(1))).otherwise(F.lit(0.0))
            case "cume_dist":
                return upto / size
            case "ntile":
                return _tile(number - 1, size, F.lit(one.steps))
            case "lag" | "lead":
                # Over the edge of the bucket, the rest of the way goes along the rows next to it.
                if one.function == "lag":
                    over = F.size(ends) - (one.steps - F.col(_AT))
                else:
                    over = one.steps - (F.col(_IN) - F.col(_AT))
                beyond = F.when((over >= 1) & (over <= F.size(ends)), F.get(ends, over.cast("int") - 1))
                default = F.expr(one.default) if one.default else F.lit(None)
                return F.when(near.isNotNull(), near["value"]).when(beyond.isNotNull(), beyond["value"]).otherwise(default)
        if one.function in _POSITIONS and not one.ignores_nulls:
            return F.when(upto >= one.steps, ends["value"])
        merged = {
            part.removeprefix(f"__in_{at}_"): _merged(total, F.col(part), F.col(f"{part}_before"), F.when(is_last, F.col(f"{part}_after")))
            for part, (_, total, _) in parts.items()
        }
        return _PEERS[one.function][1](**merged, **({"scale": one.scale} if one.function in ("avg", "mean") else {}))


def _tags(columns) -> list[tuple[str, list]]:
    """The orders of the columns, each with a name to tell what is made for it."""
    return [(str(len(orders)), orders) for orders in _distinct([one.orders for _, one in columns])]


def _chains(group: Sequence[WindowColumn]) -> Iterator[tuple[list, list[tuple[int, WindowColumn]]]]:
    """Columns by what order serves them: one that another order begins with is served by that as well."""
    longest: list[list] = []
    for orders in sorted(_distinct([c.orders for c in group]), key=len, reverse=True):
        if not any(other[: len(orders)] == orders for other in longest):
            longest.append(orders)
    for orders in longest:
        yield orders, [
            (at, c) for at, c in enumerate(group)
            if next(other for other in longest if other[: len(c.orders)] == c.orders) == orders
        ]


def _merged(total: Callable, *values: Column) -> Column:
    def two(a: Column, b: Column) -> Column:
        match total:
            case F.min:
                return F.least(a, b)
            case F.max:
                return F.greatest(a, b)
            case F.bit_and:
                return F.coalesce(a.bitwiseAND(b), a, b)
            case F.bit_or:
                return F.coalesce(a.bitwiseOR(b), a, b)
            case F.bit_xor:
                return F.coalesce(a.bitwiseXOR(b), a, b)
        return F.coalesce(a + b, a, b)

    return reduce(two, values)


def _tile(place: Column, size: Column, tiles: Column) -> Column:
    small, larger = F.floor(size / tiles), size % tiles
    in_larger = larger * (small + 1)
    rest = larger + F.floor((place - in_larger) / F.greatest(small, F.lit(1)))
    return F.when(place < in_larger, F.floor(place / (small + 1))).otherwise(rest) + 1


# Names made on the way: a row's place in its bucket, the rows of the bucket that are of its
# group, the rows of the group before the bucket.
_AT, _IN, _BEFORE = "__at", "__rows_in", "__before"
_SCRATCH = {_BUCKET}


def _average(total: Column, n: Column, scale: int | None) -> Column:
    by = F.greatest(n, F.lit(1))
    return F.when(n > 0, total / by if scale is None else _exact_quotient(total, by, scale))


def _exact_quotient(total: Column, n: Column, scale: int) -> Column:
    """``total / n`` rounded once, half up, at ``scale`` decimals, as Spark rounds a mean.

    A plain division of decimals would round at a scale derived from the types.
    """
    n = n.cast("decimal(19,0)")
    rest = total % n
    whole = ((total - rest) / n).cast(f"decimal({37 - scale},0)")
    shifted = F.abs(rest.cast(f"decimal({15 + scale},{scale - 4})") * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")
    over = shifted % n
    digits = ((shifted - over) / n).cast("decimal(38,0)") + F.when(over * 2 >= n, 1).otherwise(0)
    part = (digits.cast(f"decimal({scale + 1},0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({scale + 2},{scale})")
    return whole + F.when(rest < 0, -part).otherwise(part)


def _variance(freedom: int) -> Callable[..., Column]:
    """The variance, with the divisor smaller by ``freedom`` than the number of rows."""

    def value(n: Column, total: Column, squares: Column) -> Column:
        around = F.greatest(squares - total * total / F.greatest(n, F.lit(1)), F.lit(0.0))
        return F.when(n > freedom, around / F.greatest(n - freedom, F.lit(1)))

    return value


def _deviation(freedom: int) -> Callable[..., Column]:
    return lambda n, total, squares: F.sqrt(_variance(freedom)(n, total, squares))


def _covariance(freedom: int) -> Callable[..., Column]:
    def value(n: Column, x: Column, y: Column, xy: Column, **_) -> Column:
        return F.when(n > freedom, (xy - x * y / F.greatest(n, F.lit(1))) / F.greatest(n - freedom, F.lit(1)))

    return value


def _correlation(n: Column, x: Column, y: Column, xy: Column, xx: Column, yy: Column) -> Column:
    by = F.greatest(n, F.lit(1))
    spread = F.sqrt(F.greatest(xx - x * x / by, F.lit(0.0))) * F.sqrt(F.greatest(yy - y * y / by, F.lit(0.0)))
    return F.when((n > 0) & (spread > 0), (xy - x * y / by) / spread)


def _moments(v: Column, _) -> dict:
    return {"n": (F.count, F.sum, v), "total": (F.sum, F.sum, v), "squares": (F.sum, F.sum, v * v)}


def _products(x: Column, y: Column, _) -> dict:
    sums = {"x": x, "y": y, "xy": x * y, "xx": x * x, "yy": y * y}
    return {"n": (F.count, F.sum, x), **{name: (F.sum, F.sum, value) for name, value in sums.items()}}


def _single(partial: Callable, total: Callable) -> tuple[Callable, Callable]:
    """An aggregate of one part, which is its value."""
    return lambda v, _: {"own": (partial, total, v)}, lambda own: own


def _placed(total: Callable) -> tuple[Callable, Callable]:
    """The value of the first or last row of the frame, found by its place."""

    def parts(v: Column, ignores_nulls: bool) -> dict:
        entry = F.struct(F.col(_BUCKET), F.col(_AT), v.alias("value"))
        return {"own": (total, total, F.when(v.isNotNull(), entry) if ignores_nulls else entry)}

    return parts, lambda own: own["value"]


def _by(total: Callable) -> tuple[Callable, Callable]:
    """The value that goes with the least or the largest of another."""

    def parts(v: Column, by: Column, _) -> dict:
        return {"own": (total, total, F.when(by.isNotNull(), F.struct(by.alias("by"), v.alias("value"))))}

    return parts, lambda own: own["value"]


# Functions of a row's place in its group, and how many arguments they take.
_POSITIONS = {"row_number": (0,), "rank": (0,), "dense_rank": (0,), "percent_rank": (0,), "cume_dist": (0,), "ntile": (1,),
              "lag": (1, 2, 3), "lead": (1, 2, 3), "first": (1,), "first_value": (1,), "any_value": (1,), "nth_value": (2,)}

# Those whose sums are taken around the mean.
_CENTRED = {
    "variance": (_moments, _variance(1)),
    "var_samp": (_moments, _variance(1)),
    "var_pop": (_moments, _variance(0)),
    "std": (_moments, _deviation(1)),
    "stddev": (_moments, _deviation(1)),
    "stddev_samp": (_moments, _deviation(1)),
    "stddev_pop": (_moments, _deviation(0)),
    "covar_samp": (_products, _covariance(1)),
    "covar_pop": (_products, _covariance(0)),
    "corr": (_products, _correlation),
}

_MEAN = (lambda v, _: {"total": (F.sum, F.sum, v), "n": (F.count, F.sum, v)}, _average)

# Per aggregate the parts it needs of its arguments, each with the function that makes it and
# the one that puts two together, and the value made of them.
_PEERS = {
    "count": _single(F.count, F.sum),
    "count_if": _single(F.count_if, F.sum),
    "sum": _single(F.sum, F.sum),
    "avg": _MEAN,
    "mean": _MEAN,
    "min": _single(F.min, F.min),
    "max": _single(F.max, F.max),
    "bool_and": _single(F.bool_and, F.min),
    "every": _single(F.every, F.min),
    "bool_or": _single(F.bool_or, F.max),
    "any": _single(F.bool_or, F.max),
    "some": _single(F.some, F.max),
    "bit_and": _single(F.bit_and, F.bit_and),
    "bit_or": _single(F.bit_or, F.bit_or),
    "bit_xor": _single(F.bit_xor, F.bit_xor),
    "min_by": _by(F.min),
    "max_by": _by(F.max),
    "first": _placed(F.min),
    "first_value": _placed(F.min),
    "any_value": _placed(F.min),
    "last": _placed(F.max),
    "last_value": _placed(F.max),
    **_CENTRED,
}

# Neighbours further off, and places further down, than this are left to Spark's window.
_MOST_STEPS, _LAST_PLACE = 64, 10_000

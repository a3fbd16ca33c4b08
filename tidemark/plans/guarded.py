"""Guarded reads: what an analyst or assistant may read without supervision.

A request is data, not SQL text: table, columns, one join, predicates, groups, aggregates, order, limit. It is checked
against the catalog and against the rows its partitions hold before anything is read.

Columns of the joined table are written ``table.column``; all others belong to the first table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cost import MAX_SCAN_ROWS
from tidemark.sources import catalog

MAX_LIMIT = 1000  # fixed value: most rows a guarded read may return

_OPS = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "between": lambda c, v: c.between(*v),
    "in": lambda c, v: c.isin(*v),
}
_PRUNING_OPS = {"=", "<", "<=", ">", ">=", "between", "in"}

# The stored table whose partitions a view reads.
_VIEW_SOURCE = {
    "daily_gmv": "daily_merchant_metrics",
    "merchant_leaderboard": "daily_merchant_metrics",
    "failure_reasons": "transactions",
    "retention_weekly": "user_cohorts",
}


class GuardError(Exception):
    def __init__(self, errors: list[str]):
        self.errors = errors
        super().__init__("; ".join(errors))


@dataclass(frozen=True)
class Predicate:
    column: str
    op: str
    value: object

    def is_literal(self) -> bool:
        values = self.value if isinstance(self.value, (list, tuple)) else [self.value]
        return len(values) > 0 and all(isinstance(v, (str, int, float)) for v in values)

    def expression(self) -> Column:
        return _OPS[self.op](F.col(self.column), self.value)


_AGGREGATES = {
    "count": lambda c: F.count(F.lit(1)) if c is None else F.count(c),
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


@dataclass(frozen=True)
class Aggregate:
    function: str
    column: str | None  # None counts rows
    name: str


@dataclass(frozen=True)
class Join:
    table: str  # catalog key
    on: tuple[str, str]  # column of the first table, column of this one


@dataclass(frozen=True)
class Request:
    """With ``aggregates``, ``columns`` are the groups, and the order may name an aggregate."""

    table: str  # catalog key such as raw.transactions
    columns: tuple[str, ...]
    limit: int | None
    where: tuple[Predicate, ...] = ()
    order_by: tuple[tuple[str, bool], ...] = ()  # (column, ascending)
    aggregates: tuple[Aggregate, ...] = ()
    join: Join | None = None


def _owner(request: Request, column: str) -> tuple[str, str]:
    """Catalog key and bare name of a column."""
    if request.join and column.startswith(f"{request.join.table.split('.')[-1]}."):
        return request.join.table, column.split(".", 1)[1]
    return request.table, column


def violations(request: Request) -> list[str]:
    """Every rule the request breaks; nothing is read to find out."""
    allowed = {t.key: t for t in catalog.TABLES.values()}
    keys = [request.table, *([request.join.table] if request.join else [])]
    unknown = [k for k in keys if k not in allowed]
    if unknown:
        return [f"no table '{k}' on the allow-list" for k in unknown]
    errors = []
    limit = request.limit
    if not isinstance(limit, int) or isinstance(limit, bool) or limit < 0:
        errors.append(f"give a LIMIT from 0 to {MAX_LIMIT}")
    elif limit > MAX_LIMIT:
        errors.append(f"LIMIT {limit} exceeds {MAX_LIMIT}")

    results = {a.name for a in request.aggregates}
    used = [c for c in request.columns if c != "*"]
    used += [p.column for p in request.where] + [c for c, _ in request.order_by if c not in results]
    used += [a.column for a in request.aggregates if a.column is not None]
    if request.join:
        used += [request.join.on[0], f"{request.join.table.split('.')[-1]}.{request.join.on[1]}"]
    for column in dict.fromkeys(used):
        key, name = _owner(request, column)
        if name in allowed[key].pii_columns:
            errors.append(f"'{name}' is PII: neither shown, filtered, joined nor counted")
        elif name not in allowed[key].column_names:
            errors.append(f"'{name}' does not exist in '{key}'")
    if "*" in request.columns:
        errors += [f"SELECT * would show PII of '{k}'" for k in keys if allowed[k].pii_columns]
        if request.aggregates:
            errors.append("groups must be named, not *")
    for a in request.aggregates:
        if a.function not in _AGGREGATES or (a.column is None and a.function != "count"):
            errors.append(f"'{a.name}' needs a column and one of {sorted(_AGGREGATES)}")
    if request.aggregates:
        loose = [c for c, _ in request.order_by if c not in results and c not in request.columns]
        errors += [f"order by '{c}', which is neither a group nor an aggregate" for c in loose]

    for p in request.where:
        if p.op not in _OPS or not p.is_literal():
            errors.append(f"compare '{p.column}' with literals, by one of {sorted(_OPS)}")
    for key in keys:
        spec = allowed[key]
        if spec.partition_filter_required and not _pruning(request, spec):
            errors.append(f"'{key}' is partitioned: filter {spec.partition_column} by literals")
    return errors


def _pruning(request: Request, spec: catalog.Table) -> list[Predicate]:
    """Predicates on the partition column of a table of the request, under its bare name."""
    own = [Predicate(_owner(request, p.column)[1], p.op, p.value) for p in request.where if _owner(request, p.column)[0] == spec.key]
    return [p for p in own if _prunes(p, spec)]


def _prunes(p: Predicate, spec: catalog.Table) -> bool:
    return p.column == spec.partition_column and p.op in _PRUNING_OPS and p.is_literal()


def estimated_rows(request: Request, manifest: DataFrame) -> tuple[int | None, int]:
    """Rows and partitions the request will scan, from the manifest; rows are None if it knows nothing of a table."""
    rows, partitions = 0, 0
    for key in [request.table, *([request.join.table] if request.join else [])]:
        spec = catalog.TABLES[key.split(".")[1]]
        known = manifest.filter(F.col("table_name") == _VIEW_SOURCE.get(spec.name, spec.name))
        pruning = [Predicate("dt", p.op, p.value).expression() for p in _pruning(request, spec)]
        inside = reduce(lambda a, b: a & b, pruning, F.lit(True))
        row = known.agg(
            F.count(F.lit(1)).alias("known"),
            F.sum(F.when(inside, F.col("rows"))).alias("rows"),
            F.count_if(inside).alias("partitions"),
        ).first()
        if not row["known"]:
            return None, 0
        rows, partitions = rows + int(row["rows"] or 0), partitions + row["partitions"]
    return rows, partitions


def guarded_read(
    frames: dict[str, DataFrame],
    request: Request,
    manifest: DataFrame,
    max_scan_rows: int | None = MAX_SCAN_ROWS,
) -> DataFrame:
    """Check the request, then its cost, then plan the read. Raises :class:`GuardError` before reading.

    ``max_scan_rows=None`` sets no limit to a scan whose rows are known; tables without statistics are refused all the same.
    """
    errors = violations(request)
    if errors:
        raise GuardError(errors)
    rows, _ = estimated_rows(request, manifest)
    if rows is None:
        raise GuardError([f"no statistics for {request.table}: scan cost cannot be estimated"])
    if max_scan_rows is not None and rows > max_scan_rows:
        raise GuardError([f"estimated scan of {rows:,} rows exceeds the limit of {max_scan_rows:,}"])
    df = frames[request.table]
    star = df.columns
    if request.join:
        alias = request.join.table.split(".")[-1]
        other = frames[request.join.table]
        # Columns of the joined table carry its name, so that equal names stay apart.
        other = other.select(*[F.col(c).alias(f"{alias}.{c}") for c in other.columns])
        df = df.join(other, df[request.join.on[0]] == other[f"`{alias}.{request.join.on[1]}`"])
        star = df.columns
        quoted = {c: f"`{c}`" for c in other.columns}
    else:
        quoted = {}

    def col(name: str) -> Column:
        return F.col(quoted.get(name, name))

    for p in request.where:
        df = df.filter(_OPS[p.op](col(p.column), p.value))
    columns = star if "*" in request.columns else list(request.columns)
    if request.aggregates:
        groups = [col(c).alias(c) for c in columns]
        named = [_AGGREGATES[a.function](None if a.column is None else col(a.column)).alias(a.name) for a in request.aggregates]
        df = df.groupBy(*groups).agg(*named)
        columns += [a.name for a in request.aggregates]
    if request.order_by:
        df = df.orderBy(*[col(c).asc() if up else col(c).desc() for c, up in request.order_by])
    return df.select(*[col(c) for c in columns]).limit(request.limit)

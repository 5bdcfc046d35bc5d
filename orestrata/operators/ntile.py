"""Exact `ntile` over a whole table without sorting it in one task.

`ntile(k) OVER (ORDER BY ...)` without PARTITION BY moves every row to a single task. All
that ntile needs, though, is the k - 1 rows that end a bucket; once they are known, the
bucket of any row is a comparison. So: find those rows exactly, then score the whole table
in one projection, with no shuffle and no join, for any number of orderings at once.

The end rows are found by narrowing. A bracket of rows too large to sort is cut at rows
picked from a sorted sample, the pieces are counted exactly in one aggregate over the
table, and the pieces holding a wanted position go on. The sample only decides how fast
the brackets shrink (about 50-fold per round); the counts decide the answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
)

from orestrata.sources.scratch import materialize

# Rows one task may sort, and rows sampled (and sorted) from a larger bracket.
SORT_ROWS = 1_000_000
SAMPLE_ROWS = 50_000

# Types whose values come back from Python unchanged, as an end row must.
_EXACT_TYPES = (
    BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, StringType,
)


@dataclass(frozen=True)
class Bracket:
    """Rows of one ordering after `low`, at position `start`, up to `high`, at `stop`.

    None leaves a side open. Positions count from 1 in the whole table; `wanted` are those
    of the bucket ends among the rows.
    """

    name: str
    low: Row | None
    high: Row | None
    start: int
    stop: int
    wanted: tuple[int, ...]
    stalled: int = 0

    @property
    def rows(self) -> int:
        return self.stop - self.start


def _comparable(df: DataFrame, column: Column) -> Column:
    """Times without a zone as microseconds: Python would move them to its own zone."""
    if isinstance(df.select(column.alias("c")).schema["c"].dataType, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), column)
    return column


class Orderings:
    """Named orderings of a table: ascending columns, NULLs first, the last one unique.

    Struct values compare the same way, so a row of one ordering is one struct.
    """

    def __init__(self, df: DataFrame, columns: Mapping[str, Sequence[Column]]):
        self.df = df
        self.columns = {name: [_comparable(df, c) for c in keys] for name, keys in columns.items()}
        structs = [self.row(name).alias(name) for name in columns]
        self.types: dict[str, StructType] = {f.name: f.dataType for f in df.select(*structs).schema}
        for name, struct in self.types.items():
            for field in struct:
                if not isinstance(field.dataType, _EXACT_TYPES):
                    raise TypeError(f"{name} cannot order by {field.dataType.simpleString()}")

    def row(self, name: str) -> Column:
        return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(self.columns[name])])

    def after(self, name: str, mark: Row) -> Column:
        """True for rows that come after `mark`."""
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(mark, self.types[name], strict=True)]
        return self.row(name) > F.struct(*values)

    def inside(self, bracket: Bracket) -> Column:
        low, high = bracket.low, bracket.high
        after_low = F.lit(True) if low is None else self.after(bracket.name, low)
        return after_low if high is None else after_low & ~self.after(bracket.name, high)

    def ranked(self, brackets: Sequence[Bracket], shares: Sequence[float], seed: int) -> DataFrame:
        """Rows of some brackets, or a random share of them, with the bracket's index as `part`
        and their `position` among the rows taken from it; each ordering's rows in a column of
        their own.

        The table is scanned and shuffled once for all orderings. One task sorts one bracket,
        so brackets or shares must be small.
        """
        members: dict[str, list[int]] = {}
        for i, bracket in enumerate(brackets):
            members.setdefault(bracket.name, []).append(i)

        def taken(name: str) -> Column:
            part = F.coalesce(*[F.when(self.inside(brackets[i]), i) for i in members[name]])
            rows = [self.row(n) if n == name else F.lit(None).cast(self.types[n]) for n in members]
            return F.struct(part.alias("part"), *[row.alias(f"row_{n}") for n, row in zip(members, rows, strict=True)])

        rows = self.df.select(F.inline(F.array(*[taken(name) for name in members]))).filter("part IS NOT NULL")
        if min(shares) < 1:
            rows = rows.filter(F.rand(seed) < F.array(*map(F.lit, shares))[F.col("part")])
        fields = [F.col(f"row_{name}.{f.name}").asc_nulls_first() for name in members for f in self.types[name]]
        return rows.withColumn("position", F.row_number().over(Window.partitionBy("part").orderBy(*fields)))


def bucket_ends(rows: int, buckets: int) -> tuple[int, ...]:
    """Positions of the last row of each bucket but the last non-empty one.

    The first `rows mod buckets` buckets hold one row more than the others.
    """
    size, extra = divmod(rows, buckets)
    ends = (bucket * size + min(bucket, extra) for bucket in range(1, buckets))
    return tuple(sorted({end for end in ends if 0 < end < rows}))


def _rows_at(
    orderings: Orderings,
    brackets: Sequence[Bracket],
    places: Sequence[Sequence[int]],
    shares: Sequence[float],
    seed: int = 0,
) -> list[list[Row]]:
    """The rows at the given places of each bracket, or of a random share of it, in order.

    One job with one scan; only these few rows reach the driver.
    """
    chosen = F.array(*[F.array(*map(F.lit, wanted)) for wanted in places])[F.col("part")]
    found = orderings.ranked(brackets, shares, seed).filter(F.array_contains(chosen, F.col("position"))).collect()
    result: list[list[Row]] = [[] for _ in brackets]
    for row in sorted(found, key=lambda row: row.position):
        result[row.part].append(row[f"row_{brackets[row.part].name}"])
    return result


def _pivots(orderings: Orderings, brackets: Sequence[Bracket], sample_rows: int, seed: int) -> list[list[Row]]:
    """Sampled rows of each bracket on either side of its wanted positions.

    The rows of a sample up to a given one are a binomial count; each side is four of its
    standard deviations away.
    """
    places = []
    for bracket in brackets:
        expected = [sample_rows * (w - bracket.start) / bracket.rows for w in bracket.wanted]
        places.append(sorted({max(1, round(e + side * 4 * e**0.5)) for e in expected for side in (-1, 1)}))
    shares = [sample_rows / bracket.rows for bracket in brackets]
    return _rows_at(orderings, brackets, places, shares, seed)


def _narrow(orderings: Orderings, brackets: Sequence[Bracket], sample_rows: int, seed: int) -> list[Bracket]:
    """Cut each bracket at sampled rows and keep the pieces with a wanted position."""
    pivots = _pivots(orderings, brackets, sample_rows, seed)
    positions = [
        F.count_if(~orderings.after(b.name, pivot)).alias(f"position_{i}_{j}")
        for i, b in enumerate(brackets)
        for j, pivot in enumerate(pivots[i])
    ]
    counted = orderings.df.agg(F.count(F.lit(1)).alias("rows"), *positions).first()
    pieces = []
    for i, bracket in enumerate(brackets):
        marks = [(bracket.low, bracket.start)]
        marks += [(pivot, counted[f"position_{i}_{j}"]) for j, pivot in enumerate(pivots[i])]
        marks += [(bracket.high, bracket.stop)]
        for (low, start), (high, stop) in pairwise(marks):
            wanted = tuple(w for w in bracket.wanted if start < w <= stop)
            if wanted:
                stalled = bracket.stalled + 1 if stop - start > 0.9 * bracket.rows else 0
                pieces.append(Bracket(bracket.name, low, high, start, stop, wanted, stalled))
    return pieces


def bucket_end_rows(
    orderings: Orderings,
    ends: Sequence[int],
    rows: int,
    *,
    sort_rows: int = SORT_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, list[Row]]:
    """The rows at positions `ends` of each ordering of a table of `rows` rows, which must
    give the same rows on every pass."""
    result: dict[str, list[Row]] = {name: [] for name in orderings.columns}
    if not ends:
        return result
    brackets = [Bracket(name, None, None, 0, rows, tuple(ends)) for name in orderings.columns]
    sort_rows = max(sort_rows, sample_rows)
    seed = 0
    while wide := [b for b in brackets if b.rows > sort_rows]:
        seed += 1
        pieces = _narrow(orderings, wide, sample_rows, seed)
        if max(b.stalled for b in pieces) == 5:
            raise ValueError("too many rows tie; end each ordering with a unique column")
        brackets = [b for b in brackets if b.rows <= sort_rows] + pieces

    # Fetch the row after each end too: if the two tie, the ordering leaves the end open.
    places = [sorted({p - b.start for w in b.wanted for p in (w, w + 1) if p <= b.stop}) for b in brackets]
    fetched = _rows_at(orderings, brackets, places, [1.0] * len(brackets))
    for bracket, place, found in zip(brackets, places, fetched, strict=True):
        at = dict(zip(place, found, strict=True))
        for wanted in bracket.wanted:
            end = at[wanted - bracket.start]
            if end == at.get(wanted - bracket.start + 1):
                raise ValueError(f"{bracket.name} ties at a bucket end; end it with a unique column")
            result[bracket.name].append(end)
    return result


def with_ntiles(
    df: DataFrame,
    buckets: int,
    orderings: Mapping[str, Sequence[Column]],
    *,
    stable: bool = False,
    sort_rows: int = SORT_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add one integer column per ordering: its `ntile(buckets)` over the whole table.

    An ordering lists columns to sort by, ascending with NULLs first; the last one must be
    unique, which makes the result unique. For a descending number pass its negative.

    Runs jobs at once: the table is written first unless the caller vouches that `df` is a
    scan of a written table (`stable`).
    """
    if stable:
        table, rows = df, df.count()
    else:
        seen = Observation()
        table = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), "ntile")
        rows = seen.get["rows"]
    keyed = Orderings(table, orderings)
    ends = bucket_end_rows(
        keyed, bucket_ends(rows, buckets), rows, sort_rows=sort_rows, sample_rows=sample_rows
    )
    return table.withColumns({
        name: sum((keyed.after(name, end).cast("int") for end in ends[name]), F.lit(1)) for name in orderings
    })

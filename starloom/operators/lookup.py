"""Lookups of labels and keys: plain, current-state and point-in-time.

No lookup is hinted as a broadcast unless its rows were counted first; otherwise Spark decides from
the table's size. Where both sides are shuffled, its skew-join handling splits a hot key of the larger
side. It can do so only if nothing sits between the small side's shuffle and the join, so a small side
that was grouped or windowed is written first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.constants import UNKNOWN_KEY
from starloom.operators.ordered import running_max
from starloom.session import materialise


def look_up(df: DataFrame, column: str, table: DataFrame, key: str, take: Mapping[str, str]) -> DataFrame:
    """Left-join ``table`` on ``column`` = ``key`` and add the columns of ``take`` ({theirs: ours}).

    A NULL or unknown key leaves NULL.
    """
    side = table.select(F.col(key).alias("_key"), *[F.col(theirs).alias(ours) for theirs, ours in take.items()])
    return df.join(side, F.col(column) == F.col("_key"), "left").drop("_key")


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    """Business keys with more than one row, with their number of versions."""
    return table.groupBy(key).agg(F.count("*").alias("versions")).where(F.col("versions") > 1)


def require_unique(table: DataFrame, key: str) -> None:
    """Raise if a lookup on ``key`` would multiply rows."""
    clash = duplicate_keys(table.where(F.col(key).isNotNull()), key).limit(1).collect()
    if clash:
        raise ValueError(f"{key} = {clash[0][0]} occurs {clash[0][1]} times")


#: Settings under which rows that are dealt by part of a join's keys on both sides are joined as they lie.
BY_LOTS = {"spark_sql_requireAllClusterKeysForCoPartition": "false"}


@dataclass(frozen=True)
class VersionedDimension:
    """A dimension whose rows hold for ``valid_from`` < t <= ``valid_to``.

    ``stays``: it is stored by its business key, so that pieces are better joined where they lie than written and dealt anew.
    """

    frame: DataFrame
    business_key: str
    surrogate: str
    valid_from: str = "Valid_From"
    valid_to: str = "Valid_To"
    stays: bool = False


@dataclass(frozen=True)
class Role:
    """One key to fill: ``output`` = key of ``dimension`` for ``business_key`` at the row's time."""

    business_key: str
    dimension: str
    output: str


@dataclass(frozen=True)
class LookupLimits:
    """Counted sizes that decide how a dimension is joined.

    ``candidates``: versions that a row may have to try; the life of a key with more is cut into cells, of an eighth of that on average.
    ``versions_per_key``: versions of one key that one task may sort; more are swept.
    ``broadcast_rows``: rows of a few fixed-width columns that every executor may hold.
    """

    candidates: int = 64
    versions_per_key: int = 100_000
    broadcast_rows: int = 500_000

    def hinted(self, side: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(side) if rows <= self.broadcast_rows else side


#: Rows that are dealt by a column go by lots of about so many.
LOT_ROWS = 500_000
#: A numbered row that will be dealt by a column has a code of its value above these bits; tasks and places of a million tasks fit below.
_PLACE_BITS, _CODES = 53, 512


def _number(staged: DataFrame, at: str, dealt_by: str | None = None) -> tuple[DataFrame, Column]:
    """The rows numbered and written, and a condition on versions: not wholly before or after the rows' times, noted on the way.

    With ``dealt_by`` the number tells which rows are to lie together, so that it alone has to travel.
    """
    span = Observation()
    number = F.monotonically_increasing_id()
    if dealt_by is not None:
        number = number + F.shiftleft(F.pmod(F.xxhash64(dealt_by), F.lit(_CODES)), _PLACE_BITS)
    numbered = staged.withColumn("_row", number)
    stored = materialise(numbered.observe(span, F.min(_seconds(F.col(at))).alias("first"), F.max(_seconds(F.col(at))).alias("last")), "numbered-rows")
    seen = span.get
    return stored, (_seconds(F.col("_from")) <= F.lit(seen["last"])) & (_seconds(F.col("_to")) >= F.lit(seen["first"]))


def _lot(numbered: DataFrame) -> Column:
    """The lot of a row number: one for each code, or as many as the code's rows, counted here, need."""
    code = F.shiftright("_row", _PLACE_BITS).cast("int")
    rows = dict(numbered.groupBy(code.alias("code")).count().collect())
    lots = F.array(*[F.lit(-(-rows.get(i, 1) // LOT_ROWS)) for i in range(_CODES)])
    return F.pmod(F.xxhash64("_row"), F.get(lots, code)) * _CODES + code


def _usable(dimension: VersionedDimension) -> DataFrame:
    """Versions that can match at all: an empty interval or an unknown bound or key never does."""
    return dimension.frame.select(
        F.col(dimension.business_key).alias("_bk"),
        F.col(dimension.valid_from).alias("_from"),
        F.col(dimension.valid_to).alias("_to"),
        F.col(dimension.surrogate).alias("_key"),
    ).where(F.col("_bk").isNotNull() & (F.col("_from") < F.col("_to")))


def _segments(versions: DataFrame, reach: Column | None = None) -> DataFrame:
    """Disjoint (start, end] pieces, each owned by the earliest-starting version that covers it.

    Versions that start no later than this one cover everything from its start up to the furthest of
    their ends. This version therefore owns what lies beyond that, and the pieces never overlap.
    """
    covered = F.greatest("_from", reach)
    return versions.select("_bk", covered.alias("_start"), F.col("_to").alias("_end"), "_key").where(
        F.col("_start") < F.col("_end")
    )


def _segments_few_versions(versions: DataFrame) -> DataFrame:
    """Pieces by a window per business key; the caller has counted the versions per key."""
    earlier = (
        Window.partitionBy("_bk").orderBy("_from", "_key").rowsBetween(Window.unboundedPreceding, -1)
    )
    return _segments(versions.withColumn("_reach", F.max("_to").over(earlier)), F.col("_reach"))


def _segments_many_versions(versions: DataFrame, rows: int) -> DataFrame:
    """The same pieces by a running value over all versions, for keys with any number of them."""
    reached = versions.withColumn("_own", F.struct("_bk", "_to"))
    ahead = running_max(reached, ["_bk", "_from", "_key"], "_own", "_before", rows)
    same_key = F.when(F.col("_before._bk") == F.col("_bk"), F.col("_before._to"))
    return _segments(ahead.withColumn("_reach", same_key), F.col("_reach"))


def _sweep(probes: DataFrame, segments: DataFrame, rows: int) -> DataFrame:
    """Key per distinct (_bk, _at), by one pass over probes and pieces in time order.

    The piece in force at a probe is the last one that starts before it, if it has not ended. At
    equal times probes come first because a piece excludes its start. ``rows`` bounds the number of both together.
    """
    piece = F.struct("_bk", F.col("_start").alias("_from"), F.col("_end").alias("_to"), "_key")
    starts = segments.select("_bk", F.col("_start").alias("_at"), F.lit(1).alias("_turn"), piece.alias("_piece"))
    asked = probes.select("_bk", "_at", F.lit(0).alias("_turn"), F.lit(None).cast(starts.schema["_piece"].dataType).alias("_piece"))
    timeline = asked.unionByName(starts)
    answered = running_max(timeline, ["_bk", "_at", "_turn"], "_piece", "_last", rows)
    return answered.where(
        (F.col("_turn") == 0) & (F.col("_last._bk") == F.col("_bk")) & (F.col("_at") <= F.col("_last._to"))
    ).select("_bk", "_at", F.col("_last._key").alias("_key"))


def _filled(key: str, output: str, unknown_key: int | None) -> Column:
    found = F.col(key) if unknown_key is None else F.coalesce(F.col(key), F.lit(unknown_key))
    return found.cast("bigint").alias(output)


def _seconds(moment: Column) -> Column:
    """Seconds on a scale that only has to grow with time; free of time zones, unlike a cast."""
    days = F.date_diff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def _cell(moment: Column) -> Column:
    """Which of a deep key's ``_cells`` equal stretches a moment falls in, the outer two open-ended; 0 for other keys."""
    place = F.floor((_seconds(moment) - F.col("_first")) * F.col("_cells") / F.col("_span"))
    inside = F.least(F.greatest(place, F.lit(0)), F.col("_cells") - 1)
    return F.coalesce(inside, F.lit(0)).cast("bigint")


def _with_cell(df: DataFrame, key: str, deep: DataFrame, cell: Column, name: str) -> DataFrame:
    columns = df.columns
    return df.join(deep, F.col(key) == F.col("_deep"), "left").select(*columns, cell.alias(name))


@dataclass(frozen=True)
class _Ways:
    """How the keys of a dimension are answered: by joining disjoint pieces, or by a sweep.

    ``special``: the keys that are cut into cells (``_cells``, ``_first``, ``_span``) or swept (``_swept``);
    None if there are none. ``pieces``: of all keys that aren't swept, ``small`` if hinted as a broadcast.
    ``swept``: the versions of the swept keys, None if there are none.
    """

    pieces: DataFrame
    small: bool
    special: DataFrame | None = None
    swept: DataFrame | None = None


def _cut_deep_keys(segments: DataFrame, deep: DataFrame) -> DataFrame:
    """Each piece once per cell it reaches.

    A deep key has an eighth of ``candidates`` versions to a cell, and its pieces are disjoint, so cutting adds few rows, and
    never more than there are. The key's hottest stretch is thereby spread over many join keys as well.
    """
    reached = F.sequence(_cell(F.col("_start")), _cell(F.col("_end")))
    cut = _with_cell(segments, "_bk", deep, reached, "_reached")
    return cut.select("_bk", "_start", "_end", "_key", F.explode("_reached").alias("_cell"))


def _ways(versions: DataFrame, limits: LookupLimits, stays: bool = False) -> _Ways:
    """Decide for each key by counting its versions, and then its pieces in each cell."""
    size = Observation()
    first, last = _seconds(F.col("first")), _seconds(F.col("last"))
    per_key = versions.groupBy("_bk").agg(F.count("*").alias("n"), F.min("_from").alias("first"), F.max("_from").alias("last"))
    per_cell = max(1, min(limits.candidates, limits.versions_per_key) // 8)
    special = materialise(
        per_key.observe(size, F.sum("n").alias("rows"))
        .where(F.col("n") > min(limits.candidates, limits.versions_per_key))
        .select(
            F.col("_bk").alias("_deep"), first.alias("_first"), (last - first + 1).alias("_span"), F.ceil(F.col("n") / per_cell).alias("_cells"),
            (F.col("n") > limits.versions_per_key).alias("_swept"),
        ),
        "special-keys",
    )
    rows = size.get["rows"] or 0
    n_special, n_hot = special.agg(F.count("*"), F.count_if("_swept")).first()
    if n_special == 0:
        segments, small = _segments_few_versions(versions), rows <= limits.broadcast_rows
        if small or stays:
            return _Ways(F.broadcast(segments) if small else segments, small)
        # Spark splits a hot key of the staged side only if the other side is shuffled for this very join.
        return _Ways(materialise(segments, "pieces"), small)

    def of_keys(df: DataFrame, keys: DataFrame, n: int, how: str) -> DataFrame:
        return df.join(limits.hinted(keys.select(F.col("_deep").alias("_bk")), n), "_bk", how)

    hot = special.where("_swept")
    calm = versions if n_hot == 0 else of_keys(versions, hot, n_hot, "left_anti")
    deep = limits.hinted(special.where("NOT _swept"), n_special - n_hot)
    pieces = materialise(_cut_deep_keys(_segments_few_versions(calm), deep), "pieces")
    crowds = pieces.groupBy("_bk", "_cell").agg(F.count("*").alias("n")).where(F.col("n") > limits.candidates)
    crowded = materialise(crowds.select(F.col("_bk").alias("_deep")).distinct(), "crowded-keys")
    n_crowded, n_pieces = crowded.count(), pieces.count()
    if n_crowded:
        pieces = of_keys(pieces, crowded, n_crowded, "left_anti")
        marked = special.join(limits.hinted(crowded.withColumn("_crowded", F.lit(True)), n_crowded), "_deep", "left")
        special = materialise(marked.select("_deep", "_first", "_span", "_cells", (F.col("_swept") | F.coalesce("_crowded", F.lit(False))).alias("_swept")), "special-keys")
    swept = of_keys(versions, special.where("_swept"), n_hot + n_crowded, "left_semi") if n_hot + n_crowded else None
    return _Ways(limits.hinted(pieces, n_pieces), n_pieces <= limits.broadcast_rows, limits.hinted(special, n_special), swept)


def _in_force(key: str, at: str) -> Column:
    """Pieces are disjoint, so at most one of a key's is in force at a time, and no row is multiplied."""
    return (F.col(key) == F.col("_bk")) & (F.col(at) > F.col("_start")) & (F.col(at) <= F.col("_end"))


def _resolve_in_place(staged: DataFrame, at: str, role: Role, ways: _Ways, unknown_key: int | None) -> DataFrame:
    """Join broadcast pieces to the rows as they are."""
    kept = [c for c in staged.columns if c != role.output]
    met = _in_force(role.business_key, at)
    if ways.special is not None:
        staged = _with_cell(staged, role.business_key, ways.special, _cell(F.col(at)), "_at_cell")
        met = met & (F.col("_at_cell") == F.col("_cell"))
    return staged.join(ways.pieces, met, "left").select(*kept, _filled("_key", role.output, unknown_key))


def _answers(probes: DataFrame, ways: _Ways) -> DataFrame:
    """(_row, _role, _key) of the probes (_row, _role, _of, _at) that a version is in force for: each key its own way."""
    if ways.special is None:
        return probes.join(ways.pieces, _in_force("_of", "_at")).select("_row", "_role", "_key")
    routed = probes.join(ways.special, F.col("_of") == F.col("_deep"), "left")
    calm = routed.where("NOT coalesce(_swept, false)").select("_row", "_role", "_of", "_at", _cell(F.col("_at")).alias("_at_cell"))
    answered = calm.join(ways.pieces, _in_force("_of", "_at") & (F.col("_at_cell") == F.col("_cell"))).select("_row", "_role", "_key")
    if ways.swept is None:
        return answered
    hot = routed.where("_swept").select("_row", "_role", "_of", "_at")
    # Counted before they are made distinct and cut into pieces, so that neither is computed twice.
    n_versions = ways.swept.count()
    found = _sweep(hot.select(F.col("_of").alias("_bk"), "_at").distinct(), _segments_many_versions(ways.swept, n_versions), hot.count() + n_versions)
    found = found.select(F.col("_bk").alias("_of"), "_at", "_key")
    return answered.unionByName(hot.join(found, ["_of", "_at"]).select("_row", "_role", "_key"))


def _resolve_by_probes(
    numbered: DataFrame, resolved: DataFrame, at: str, roles: Sequence[Role], ways: Mapping[str, _Ways], unknown_key: int | None, dealt: bool = False
) -> DataFrame:
    """Only (row, role, key, time) travels to the dimensions; all roles' answers come back to a row in one join.

    ``resolved`` are the numbered rows with other roles filled already. If ``dealt``, rows and answers meet where the lots of the rows' numbers lie;
    for that Spark must be free to join by part of the keys (``BY_LOTS``).
    """
    answers = []
    for name in dict.fromkeys(role.dimension for role in roles):
        mine = [(i, role) for i, role in enumerate(roles) if role.dimension == name]
        asked = F.array(*[F.struct(F.lit(i).alias("_role"), F.col(role.business_key).alias("_of")) for i, role in mine])
        probes = numbered.select("_row", F.col(at).alias("_at"), F.inline(asked)).where(F.col("_of").isNotNull() & F.col("_at").isNotNull())
        answers.append(_answers(probes, ways[name]))
    # A row's answers lie in different tasks; dealt before they are grouped, they travel in three columns and not in one for each role.
    given, keys = reduce(DataFrame.unionByName, answers), ["_row"]
    kept = [c for c in resolved.columns if c not in {role.output for role in roles}]
    if dealt:  # the lot follows from the number and doesn't travel
        lot, keys = _lot(numbered), ["_lot", "_row"]
        given, resolved = (df.repartition(lot).withColumn("_lot", lot) for df in (given, resolved))
    else:
        given = given.repartition("_row")
    per_row = given.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_role") == i, F.col("_key"))).alias(f"_key_{i}") for i in range(len(roles))]
    )
    return resolved.join(per_row, keys, "left").select(*kept, *[_filled(f"_key_{i}", role.output, unknown_key) for i, role in enumerate(roles)])


def resolve_point_in_time(
    staged: DataFrame,
    at: str,
    roles: Sequence[Role],
    dimensions: Mapping[str, VersionedDimension],
    unknown_key: int | None = UNKNOWN_KEY,
    limits: LookupLimits = LookupLimits(),
) -> DataFrame:
    """Fill every role with the key of the version in force at ``at``; the earliest start wins an overlap.

    Each dimension is counted first, key by key. Disjoint pieces are joined directly, those of a key with
    many versions by time cell. Only keys whose versions are too many for a task, or crowd even into one cell, are
    swept in order of time. Where a dimension's pieces are few and no key is swept, they are broadcast
    and the rows stay where they are; for all other dimensions together the rows are shuffled once.

    Unless all dimensions are small, the rows are written first; of the dimensions only versions that reach into the time of the rows take part.
    """
    return resolve_and_deal(staged, at, roles, dimensions, None, unknown_key, limits)[1]


def resolve_and_deal(
    staged: DataFrame,
    at: str,
    roles: Sequence[Role],
    dimensions: Mapping[str, VersionedDimension],
    dealt_by: str | None,
    unknown_key: int | None = UNKNOWN_KEY,
    limits: LookupLimits = LookupLimits(),
) -> tuple[DataFrame, DataFrame]:
    """As ``resolve_point_in_time``: the rows as they are stored, before any lookup, and the resolved rows, dealt by the column ``dealt_by``.

    Rows that are to be stored by a column are so shuffled once, and not first to meet their answers and then for that column. Few tasks
    hold rows of one value, and a value with many rows has several. Where the resolved rows are computed, ``BY_LOTS`` should be set.
    """
    usable = {name: _usable(dimensions[name]) for name in dict.fromkeys(role.dimension for role in roles)}
    rows = staged
    if any(versions.count() > limits.broadcast_rows for versions in usable.values()):
        rows, in_reach = _number(staged, at, dealt_by)
        usable = {name: versions.where(in_reach) for name, versions in usable.items()}
    ways = {name: _ways(versions, limits, dimensions[name].stays) for name, versions in usable.items()}
    in_place = [role for role in roles if ways[role.dimension].small and ways[role.dimension].swept is None]
    by_probes = [role for role in roles if role not in in_place]
    outputs = [role.output for role in roles]
    if by_probes and rows is staged:  # small dimensions with keys to sweep
        rows, _ = _number(staged, at, dealt_by)
    resolved = rows
    for role in in_place:
        resolved = _resolve_in_place(resolved, at, role, ways[role.dimension], unknown_key)
    if by_probes:
        resolved = _resolve_by_probes(rows, resolved, at, by_probes, ways, unknown_key, dealt_by is not None)
    elif dealt_by is not None:
        resolved = resolved.hint("rebalance", dealt_by)
    return rows, resolved.select(*[c for c in staged.columns if c not in outputs], *outputs)

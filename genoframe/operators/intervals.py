"""Joins on overlapping closed intervals and nearest intervals.

Every right interval has one bin: the smallest of nested bins that holds it whole. A left interval looks into the bins that it
touches on each level, so the join is an equi-join on (chromosome, level, bin) with the overlap as a residual test. Right
rows are never copied, long intervals need no branch of their own, and no pair is found twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sizes of nested bins, as powers of two: 1 kb to 1 Gb; an interval that crosses a border of the largest fits none.
LEVELS = (10, 13, 16, 19, 22, 25, 30, 62)
NO_LEVEL = -1


def _level_bin(start: Column, end: Column) -> tuple[Column, Column]:
    level, place = F.lit(LEVELS[-1]), F.lit(0).cast("long")
    for bits in reversed(LEVELS):
        fits = F.shiftright(start, bits) == F.shiftright(end, bits)
        level, place = F.when(fits, F.lit(bits)).otherwise(level), F.when(fits, F.shiftright(start, bits)).otherwise(place)
    return level, place


def levels_of(right: DataFrame, start: str = "start", end: str = "end") -> tuple[int, ...]:
    """The levels that occur in a stored table of intervals: its left rows need to look at no others. One job, eight numbers at most."""
    level, _ = _level_bin(F.col(start).cast("long"), F.col(end).cast("long"))
    return tuple(sorted(r.l for r in right.where(F.col(start) <= F.col(end)).select(level.alias("l")).distinct().collect()))


def overlap_join(left: DataFrame, right: DataFrame, left_on=("chrom", "start", "end"), right_on=("chrom", "start", "end"), how: str = "inner", levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Pairs with equal chromosome and ``left.start <= right.end`` and ``right.start <= left.end``.

    Column names of the sides must differ, but for the chromosome if both call it the same; it then comes from the
    left. Nulls and intervals with end < start overlap nothing. ``how``: ``inner``, ``left_semi``. Starts are not negative.
    ``levels``: those that occur on the right, if known.
    """
    lc, ls, le = left_on
    rc, rs, re_ = right_on
    level, place = _level_bin(F.col(rs).cast("long"), F.col(re_).cast("long"))
    held = right.where(F.col(rs) <= F.col(re_)).withColumn("_level", level).withColumn("_bin", place).withColumnRenamed(rc, "_chrom")
    looked = left.where(F.col(ls) <= F.col(le)).withColumn("_level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    shift = lambda c: F.expr(f"shiftright(cast({c} as bigint), _level)")
    looked = looked.withColumn("_bin", F.explode(F.sequence(shift(f"`{ls}`"), shift(f"`{le}`"))))
    on = (looked["_level"] == held["_level"]) & (looked["_bin"] == held["_bin"]) & (looked[lc] == held["_chrom"]) & (F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le))
    out = looked.join(held, on, how).drop(looked["_level"]).drop(looked["_bin"])
    return out if how == "left_semi" else out.drop(held["_level"]).drop(held["_bin"]).drop("_chrom")


#: Columns of a right side whose bins are known.
PLACE = ("_held", "_place")


def placed(right: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """``right`` with its level and bin, as they are if it has them: rows of a stored index are read where they lie."""
    if set(PLACE) <= set(right.columns):
        return right
    level, place = _level_bin(F.col(start).cast("long"), F.col(end).cast("long"))
    return right.where(F.col(start) <= F.col(end)).withColumns(dict(zip(PLACE, (level, place), strict=True)))


def write_index(right: DataFrame, path: str, buckets: int = 200) -> DataFrame:
    """Stores ``right(chrom, start, end, ...)`` with levels and bins, bucketed by chromosome, level and bin, and gives it back: joins of it
    leave its rows where they are, only the left side is shuffled to the buckets. ``read_index`` opens it in another session."""
    from genoframe.sources import bucketed

    rows = placed(right)
    levels = tuple(sorted(r.l for r in rows.select(F.col(PLACE[0]).alias("l")).distinct().collect()))
    return bucketed.write(rows, path, ["chrom", *PLACE], buckets, levels=levels)


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, tuple[int, ...]]:
    """(the stored intervals, the levels that occur)."""
    from genoframe.sources import bucketed

    table, told = bucketed.read(spark, path)
    return table, tuple(told["levels"])


def overlaps_or_none(left: DataFrame, right: DataFrame, left_on=("chrom", "start", "end"), right_on=("chrom", "start", "end"), levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The pairs of ``overlap_join``, and one row with nulls from the right and a null ``hit`` for every left row.

    An aggregate by the left's key then sees every left row in one pass, without a second join for those that overlap nothing.
    """
    lc, ls, le = left_on
    rc, rs, re_ = right_on
    held = placed(right, rs, re_).withColumnRenamed(rc, "_chrom").withColumn("hit", F.lit(True))
    every, none = F.array(*[F.lit(b) for b in (*levels, NO_LEVEL)]), F.array(F.lit(NO_LEVEL))
    looked = left.withColumn("_level", F.explode(F.when(F.col(ls) <= F.col(le), every).otherwise(none)))
    shift = lambda c: F.expr(f"shiftright(cast(`{c}` as bigint), _level)")
    bins = F.when(F.col("_level") == NO_LEVEL, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(shift(ls), shift(le)))
    looked = looked.withColumn("_bin", F.explode(bins))
    on = (looked["_level"] == held["_held"]) & (looked["_bin"] == held["_place"]) & (looked[lc] == held["_chrom"]) & (F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le))
    return looked.join(held, on, "left").where(F.col("hit") | (F.col("_level") == NO_LEVEL)).drop("_level", "_bin", "_held", "_place", "_chrom")


#: Intervals of up to this many of the smallest bins are known in each bin that they touch (268 million bases).
MOST_BINS = 1 << 18


def spread(right: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """``right`` with a row for each of the smallest bins that it touches; what touches more than MOST_BINS keeps its own level and bin.

    For tables of which few rows lie over one place: a left row then looks into its own bin and meets only what is near.
    """
    a, b = (F.col(c).cast("long") for c in (start, end))
    low, high = F.shiftright(a, LEVELS[0]), F.shiftright(b, LEVELS[0])
    level, place = _level_bin(a, b)
    bins = F.when(high - low < MOST_BINS, F.transform(F.sequence(low, high), lambda p: F.struct(F.lit(LEVELS[0]).alias("h"), p.alias("p")))).otherwise(F.array(F.struct(level.alias("h"), place.alias("p"))))
    rows = right.where(F.col(start) <= F.col(end)).withColumn("_bins", F.explode(bins))
    return rows.withColumns(dict(zip(PLACE, (F.col("_bins.h"), F.col("_bins.p")), strict=True))).drop("_bins")


def spread_levels(right: DataFrame, end: str = "end") -> tuple[int, ...]:
    """The levels that ``spread`` can need for intervals, or unions of intervals, of ``right``: the first one, unless a chromosome is
    longer than MOST_BINS. One job, one number."""
    last = right.agg(F.max(F.col(end).cast("long"))).first()[0]
    bits = LEVELS[0] + MOST_BINS.bit_length() - 1
    return LEVELS[:1] if last is None or last < 1 << bits else (LEVELS[0], *(x for x in LEVELS if x > bits))


def merged(rows: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """``by, start, end``: disjoint intervals that cover, for each ``by``, the same bases as ``rows``; they are no more than these, and few
    where intervals are dense. Only the distinct starts of a ``by`` are sorted together."""
    ends = rows.where(F.col(start) <= F.col(end)).groupBy(*by, F.col(start).cast("long").alias("start")).agg(F.max(F.col(end).cast("long")).alias("end"))
    upto = Window.partitionBy(*by).orderBy("start")
    before = F.max("end").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("_new", F.coalesce((F.col("start") > before + 1).cast("long"), F.lit(1).cast("long")))
    numbered = opened.withColumn("_run", F.sum("_new").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def _firsts(right: DataFrame, payload: list[str], order: list[str], right_on) -> DataFrame:
    """``_chrom, _low, _high, _start, _best``: for each place the interval that comes first in ``order`` among those that end there or later.

    An interval is never first if an earlier one in ``order``, which starts no later, ends no earlier. Of the others both
    starts and ends grow, so each is the first one for the places between the end before and its own.
    """
    rc, rs, re_ = right_on
    named = F.struct(*order, *[c for c in payload if c not in order])
    own = right.where(f"`{rc}` IS NOT NULL").where(F.col(rs) <= F.col(re_)).groupBy(F.col(rc).alias("_chrom"), F.col(rs).cast("long").alias("_start"), F.col(re_).cast("long").alias("_high")).agg(F.min(named).alias("_best"))
    before = F.max("_high").over(Window.partitionBy("_chrom").orderBy("_best").rowsBetween(Window.unboundedPreceding, -1))
    kept = own.withColumn("_before", before).where("_before IS NULL OR _high > _before")
    return kept.withColumn("_low", F.coalesce(F.col("_before") + 1, F.lit(0).cast("long"))).drop("_before")


def _first_or_none(left: DataFrame, right: DataFrame, payload: list[str], order: list[str], left_on, right_on) -> DataFrame:
    """``left`` with ``_best``, the first overlapping row of ``right`` in ``order``, which begins with its start; null if none. A left row
    meets the one interval that can be its first, and comes as often as there are levels."""
    lc, ls, le = left_on
    held = spread(_firsts(right, payload, order, right_on), "_low", "_high")
    levels = spread_levels(right, right_on[2])
    looked = left.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_bin", F.expr(f"shiftright(cast(`{ls}` as bigint), _level)"))
    on = (looked["_level"] == held["_held"]) & (looked["_bin"] == held["_place"]) & (looked[lc] == held["_chrom"])
    on = on & (F.col(ls) >= F.col("_low")) & (F.col(ls) <= F.col("_high")) & (F.col("_start") <= F.col(le)) & (F.col(ls) <= F.col(le))
    return looked.join(held, on, "left").drop("_level", "_bin", "_held", "_place", "_chrom", "_low", "_high", "_start")


def overlaps_any(left: DataFrame, right: DataFrame, key: list[str], name: str, left_on=("chrom", "start", "end"), right_on=("chrom", "start", "end")) -> DataFrame:
    """Distinct ``key`` of the left rows and whether any right interval overlaps one."""
    held = merged(right, [right_on[0]], *right_on[1:]).toDF("_c", "_s", "_e")
    met = _first_or_none(left, held, [], ["_s", "_e"], left_on, ("_c", "_s", "_e"))
    return met.groupBy(*key).agg(F.bool_or(F.col("_best").isNotNull()).alias(name))


def first_overlap(left: DataFrame, right: DataFrame, key: list[str], payload: list[str], order: list[str], left_on, right_on) -> DataFrame:
    """For each distinct left ``key`` the payload of the overlapping right interval that comes first in ``order``; null if none.
    ``order`` begins with the right's start."""
    if order[0] != right_on[1]:
        raise ValueError("the order of overlaps must begin with the start")
    met = _first_or_none(left, right, payload, order, left_on, right_on)
    return met.groupBy(*key).agg(F.min("_best").alias("_best")).select(*key, *[F.col("_best")[c].alias(c) for c in payload])


#: Ends of intervals in a slice of a chromosome, about, and a place beyond every chromosome.
SLICE_ENDS, BEYOND = 8, 1 << 60


def _slices(ends: DataFrame) -> DataFrame:
    """``chrom, low, high, reach``: slices of whole chromosomes, cut at every SLICE_ENDS-th of ``ends(chrom, at)``; ``reach`` is the
    last of a slice's places that any end can have."""
    turn = F.row_number().over(Window.partitionBy("chrom").orderBy("at"))
    cuts = ends.withColumn("turn", turn).where(f"turn % {SLICE_ENDS} = 0 AND at > 0").select("chrom", F.col("at").alias("low"))
    whole = ends.groupBy("chrom").agg(F.max("at").alias("last"))
    lows = cuts.unionByName(whole.select("chrom", F.lit(0).cast("long").alias("low"))).distinct().join(whole, "chrom")
    after = F.lead("low").over(Window.partitionBy("chrom").orderBy("low"))
    return lows.withColumn("high", F.coalesce(after - 1, F.lit(BEYOND))).withColumn("reach", F.least("high", "last")).drop("last")


def _ends(intervals: DataFrame) -> DataFrame:
    return intervals.where("chrom IS NOT NULL AND start <= end").select("chrom", F.explode(F.array(F.col("start").cast("long"), F.col("end").cast("long"))).alias("at"))


def candidates(intervals: DataFrame, k: int) -> DataFrame:
    """``chrom, low, high, listed``: for each slice all of ``intervals(chrom, start, end, id)`` that can be among the ``k`` nearest of
    a point in it: those that start or end in it, ``k`` that hold it whole, and the ``k`` next on both sides.

    Slices are cut by ranks of ends, so a list has about SLICE_ENDS + 3 k members however dense the intervals lie. Only
    the intervals of a chromosome are sorted together, never points.
    """
    held = intervals.where("chrom IS NOT NULL AND start <= end").select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "id")
    slices = _slices(_ends(intervals))
    row = F.struct("start", "end", "id")
    # the last k ends up to each end, the first k starts from each start; ties by id
    sides = []
    for side, at, order in (("before", "end", [F.col("end"), F.col("id").desc()]), ("after", "start", [F.col("start").desc(), F.col("id").desc()])):
        near = Window.partitionBy("chrom").orderBy(*order).rowsBetween(1 - k, 0)
        lists = held.select("chrom", F.col(at).alias("at"), F.lit(1).alias("kind"), F.col("id"), F.collect_list(row).over(near).alias("some"))
        marks = slices.select("chrom", F.col("low" if side == "before" else "high").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast(held.schema["id"].dataType).alias("id"), F.lit(None).cast(lists.schema["some"].dataType).alias("some"), "low")
        both = lists.withColumn("low", F.lit(None).cast("long")).unionByName(marks)
        way = F.col("at") if side == "before" else F.col("at").desc()
        # a mark stands before the ends at its own place; among equal ends the one with the longest list, that of the least id, is last
        upto = Window.partitionBy("chrom").orderBy(way, "kind", F.col("id").desc()).rowsBetween(Window.unboundedPreceding, -1)
        sides.append(both.withColumn("some", F.last("some", ignorenulls=True).over(upto)).where("kind = 0").select("chrom", "low", F.explode("some").alias("r")))
    whole = overlap_join(slices.select("chrom", "low", "high", "reach"), held, ("chrom", "low", "reach"))
    inside = whole.where("start >= low OR end <= high").select("chrom", "low", row.alias("r"))
    turn = F.row_number().over(Window.partitionBy("chrom", "low").orderBy("id", "start", "end"))
    around = whole.where("start < low AND end > high").withColumn("turn", turn).where(F.col("turn") <= k).select("chrom", "low", row.alias("r"))
    rows = inside.unionByName(around).unionByName(sides[0]).unionByName(sides[1])
    return slices.drop("reach").join(rows.groupBy("chrom", "low").agg(F.collect_list("r").alias("listed")), ["chrom", "low"])


def nearest(points: DataFrame, intervals: DataFrame, k: int = 5) -> DataFrame:
    """``chrom, pos, rank, id, distance``: the ``k`` nearest ``intervals(chrom, start, end, id)`` of each distinct point
    ``(chrom, pos)``, ties by id; fewer if the chromosome has fewer.

    ``distance`` is 0 inside, else that to the nearer end, positive when the point lies after the start. Each point
    meets one row, its slice's list of candidates, and takes its nearest from that list: no pairs are made, sorted or shuffled.
    Places are not negative; rows with nulls are near nothing.
    """
    at = points.select("chrom", F.col("pos").cast("long").alias("pos")).where("chrom IS NOT NULL AND pos IS NOT NULL").distinct()
    listed = candidates(intervals, k).withColumnRenamed("chrom", "_in")
    # the last slices of chromosomes have a level of their own
    met = overlap_join(at, listed, ("chrom", "pos", "pos"), ("_in", "low", "high"), levels=levels_of(_slices(_ends(intervals)), "low", "high"))
    pos = F.col("pos")
    away = lambda c: F.when(pos.between(c["start"], c["end"]), F.lit(0).cast("long")).otherwise(F.least(F.abs(pos - c["start"]), F.abs(pos - c["end"])))
    near = F.slice(F.sort_array(F.transform("listed", lambda c: F.struct(away(c).alias("distance"), c["id"].alias("id"), c["start"].alias("start")))), 1, k)
    ranked = met.select("chrom", "pos", F.posexplode(near).alias("rank", "r"))
    return ranked.select("chrom", "pos", (F.col("rank") + 1).alias("rank"), F.col("r.id").alias("id"), (F.col("r.distance") * F.signum((pos - F.col("r.start")).cast("double")).cast("long")).alias("distance"))


def per_base(regions: DataFrame, track: DataFrame, values=("value",)) -> DataFrame:
    """``id`` and, for each column of ``values``, an array: for ``regions(id, chrom, start, end)`` the value of every base in order, null
    where the track has none.

    ``track(chrom, pos, ...)`` has a row per base at most; several tracks are several columns of ``values``, named as given
    (``values`` for a single one). The track becomes arrays of 2048 bases, and a region takes its part of those that it touches: no base is
    paired with a region as a row.
    """
    spans = regions.where("start <= end").select("id", "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).distinct()
    bits = LEVELS[0]
    base, last = F.shiftleft("_place", bits), (2 << bits) - 1
    pos = F.col("pos").cast("long")
    # a chunk holds the values of its bin and the next one, so most regions need one chunk
    at = track.where("chrom IS NOT NULL AND pos IS NOT NULL").select(F.col("chrom").alias("_chrom"), pos.alias("pos"), *values, F.explode(F.array(F.shiftright(pos, bits), F.shiftright(pos, bits) - 1)).alias("_place"))
    lists = at.groupBy("_chrom", "_place").agg(F.array_sort(F.collect_list(F.struct("pos", *values))).alias("_rows"))
    none = lambda name: F.lit(None).cast(track.schema[name].dataType)

    def dense(name: str) -> Column:
        gap = lambda n: F.array_repeat(none(name), F.greatest(n, F.lit(0)).cast("int"))
        before = lambda i: F.coalesce(F.get("_rows", i)["pos"], base - 1)
        filled = F.flatten(F.transform("_rows", lambda r, i: F.concat(gap(r["pos"] - before(i - 1) - 1), F.array(r[name]))))
        return F.concat(filled, gap(base + last - before(F.size("_rows") - 1)))

    chunks = lists.select("_chrom", "_place", *[dense(name).alias(f"_{k}") for k, name in enumerate(values)])
    low, high = F.shiftright("start", bits), F.shiftright("end", bits)
    looked = spans.withColumn("_short", high - low < 2).withColumn("_bin", F.explode(F.sequence(low, high, F.lit(2).cast("long"))))
    first = F.greatest(F.col("start"), F.shiftleft("_bin", bits))
    n = (F.least(F.col("end"), F.shiftleft("_bin", bits) + last) - first + 1).cast("int")
    piece = lambda k, name: F.when(F.col(f"_{k}").isNotNull(), F.slice(f"_{k}", (first - F.shiftleft("_bin", bits) + 1).cast("int"), n)).otherwise(F.array_repeat(none(name), n)).alias(f"_{k}")

    def met(rows: DataFrame) -> DataFrame:
        on = (rows["chrom"] == chunks["_chrom"]) & (rows["_bin"] == chunks["_place"])
        return rows.join(chunks, on, "left").select("id", "chrom", "start", "end", "_bin", *[piece(k, name) for k, name in enumerate(values)])

    short, long = met(looked.where("_short")), met(looked.where("NOT _short"))
    parts = F.array_sort(F.collect_list(F.struct("_bin", *[f"_{k}" for k in range(len(values))])))
    joined = long.groupBy("id", "chrom", "start", "end").agg(parts.alias("_parts")).select("id", *[F.flatten(F.col("_parts")[f"_{k}"]).alias(f"_{k}") for k in range(len(values))])
    names = ["values"] if len(values) == 1 else list(values)
    return short.select("id", *[f"_{k}" for k in range(len(values))]).unionByName(joined).toDF("id", *names)

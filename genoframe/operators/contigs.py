"""Reference sequence in overlapping chunks, so that a row meets the text around it and never a whole contig.

Chunk c of a contig has its letters from ``c * SIZE`` on, ``SIZE + OVERLAP`` of them. What needs a longer text gets chunks put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Both are powers of two.
SIZE, OVERLAP = 1 << 16, 1 << 13
#: Letters of a line that are handled at once; a longer line is cut first.
PIECE = 4096
#: Contigs that are named one by one in a filter, at most.
FEW = 1000


def chunked(contigs: DataFrame) -> DataFrame:
    """``contig, chunk, seq`` of ``contigs(contig, seq)``; what is chunked already stays as it is. Null sequences are no contigs."""
    if "chunk" in contigs.columns:
        return contigs
    # a text may be costly to make: it is looked at once, a filter of nulls before would make it twice
    size = F.length("seq")
    last = F.when(size.isNotNull(), F.greatest(F.expr(f"(length(seq) - 1) div {SIZE}"), F.lit(0).cast("long")))
    rows = contigs.select("contig", "seq", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
    return rows.select("contig", "chunk", F.substring("seq", (F.col("chunk") * SIZE + 1).cast("int"), F.lit(SIZE + OVERLAP)).alias("seq"))


def from_lines(lines: DataFrame) -> DataFrame:
    """``contig, chunk, seq`` of ``lines(contig, at, value)``: letters of a contig from its 0-based place ``at`` on."""
    many = F.when(F.length("value") > PIECE, F.regexp_extract_all("value", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).otherwise(F.array("value"))
    cut = lines.select("contig", "at", F.posexplode(many).alias("k", "value")).withColumn("at", F.col("at") + F.col("k") * PIECE)
    first, last = F.greatest(F.expr(f"floor((at - {OVERLAP}) / {SIZE})"), F.lit(0).cast("long")), F.expr(f"(at + greatest(length(value), 1) - 1) div {SIZE}")
    placed = cut.withColumn("chunk", F.explode(F.sequence(first, last)))
    rows = placed.groupBy("contig", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("rows"))
    text = F.array_join(F.transform("rows", lambda r: r["value"]), "")
    return rows.select("contig", "chunk", F.substring(text, (F.col("chunk") * SIZE - F.col("rows")[0]["at"] + 1).cast("int"), F.lit(SIZE + OVERLAP)).alias("seq")).where("chunk = 0 OR length(seq) > 0")


def whole(chunks: DataFrame) -> DataFrame:
    """``contig, seq``: whole contigs in one row each, for short ones."""
    rows = chunks.groupBy("contig").agg(F.array_sort(F.collect_list(F.struct("chunk", F.substring("seq", 1, SIZE).alias("s")))).alias("rows"))
    return rows.select("contig", F.array_join(F.transform("rows", lambda r: r["s"]), "").alias("seq"))


def with_text(df: DataFrame, contigs: DataFrame, key: str, begin: Column, end: Column) -> DataFrame:
    """``df`` with ``_seq``, the letters of its contig from the 0-based place ``_offset`` on, that hold all from ``begin`` to ``end``.

    ``_seq`` is null if the contig is unknown, and ends where the contig ends. ``contigs`` are whole or chunked. Rows whose
    range does not fit a chunk meet chunks put together once for each different range of chunks. Texts of whole contigs may be costly
    to make: they are made once, for the rows that lie in a first chunk, and again only for the contigs of the other rows, which are
    looked up first (all contigs, if these are more than ``FEW``).
    """
    if "chunk" in contigs.columns:
        return _met(*_placed(df, begin, end), contigs, key)
    placed, added = _placed(df, begin, end)
    far = (F.col("_first") > 0) | (F.col("_last") > 0)
    some = [r[0] for r in placed.where(far).select(F.col(key)).distinct().limit(FEW + 1).collect()]
    # a contig that is known has a first chunk
    first = chunked(contigs).where("chunk = 0").select(F.col("contig").alias("_c"), F.col("seq").alias("_seq"))
    near = (placed.where(~far) if some else placed).join(first, F.col(key) == F.col("_c"), "left").withColumn("_offset", F.lit(0).cast("long")).drop(*added, "_c")
    if not some:
        return near
    asked = contigs.where(F.col("contig").isin([x for x in some if x is not None])) if len(some) <= FEW else contigs
    return near.unionByName(_met(placed.where(far), added, asked, key))


def _placed(df: DataFrame, begin: Column, end: Column) -> tuple[DataFrame, list[str]]:
    """``df`` with the chunks that its range begins and ends in, and the names of these columns."""
    begin = F.greatest(begin.cast("long"), F.lit(0).cast("long"))
    # a shift is never null, so joins on the chunk need no test of nulls that would make the range's columns again
    bits, end = SIZE.bit_length() - 1, F.coalesce(end.cast("long"), F.lit(0).cast("long"))
    placed = df.withColumn("_first", F.shiftright(begin, bits)).withColumn("_last", F.when(end > F.col("_first") * SIZE + SIZE + OVERLAP, F.shiftright(end - 1, bits)).otherwise(F.col("_first")))
    return placed, ["_first", "_last"]


def _met(placed: DataFrame, added: list[str], contigs: DataFrame, key: str) -> DataFrame:
    """Rows with their texts, see ``with_text``."""
    chunks = chunked(contigs).select(F.col("contig").alias("_contig"), F.col("chunk").alias("_first"), F.col("seq").alias("_seq"))
    # an outer explode, as a filter on the range would move down to where rows are made and make the range's columns again for each use
    wide = F.explode_outer(F.when(F.col("_last") > F.col("_first"), F.sequence("_first", "_last")))
    spans = placed.select(F.col(key).alias("_contig"), F.col("_first").alias("_from"), "_last", wide.alias("_chunk")).where("_chunk IS NOT NULL").distinct()
    parts = spans.withColumnRenamed("_chunk", "_first").join(chunks, ["_contig", "_first"])
    joined = F.array_sort(F.collect_list(F.struct("_first", F.when(F.col("_first") < F.col("_last"), F.substring("_seq", 1, SIZE)).otherwise(F.col("_seq")).alias("s"))))
    long = parts.groupBy("_contig", "_from", "_last").agg(joined.alias("_rows")).select("_contig", F.col("_from").alias("_first"), "_last", F.array_join(F.transform("_rows", lambda r: r["s"]), "").alias("_seq"))
    texts = chunks.withColumn("_last", F.col("_first")).unionByName(long).withColumnsRenamed({"_contig": "_c", "_first": "_f", "_last": "_l"})
    named = contigs.where("chunk = 0") if "chunk" in contigs.columns else contigs.where("seq IS NOT NULL")
    names = named.select(F.col("contig").alias("_known"))
    met = placed.join(texts, (F.col(key) == F.col("_c")) & (F.col("_first") == F.col("_f")) & (F.col("_last") == F.col("_l")), "left")
    met = met.join(names, F.col(key) == F.col("_known"), "left")
    out = met.withColumn("_seq", F.when(F.col("_known").isNotNull(), F.coalesce("_seq", F.lit("")))).withColumn("_offset", F.coalesce(F.col("_first"), F.lit(0)) * SIZE)
    return out.drop(*added, "_c", "_f", "_l", "_known")


def window_sequences(peaks: DataFrame, contigs: DataFrame, width: int = 2114, key: str = "chr") -> DataFrame:
    """``peaks(window_start, window_end)`` with ``seq``, the letters of the half-open window; windows that do not have ``width`` letters go."""
    met = with_text(peaks, contigs, key, F.col("window_start"), F.col("window_end"))
    begin = F.col("window_start") - F.col("_offset")
    seq = F.when(F.col("window_start") >= 0, F.substring("_seq", (begin + 1).cast("int"), F.greatest(F.col("window_end") - F.col("window_start"), F.lit(0)).cast("int")))
    return met.withColumn("seq", seq).drop("_seq", "_offset").where(F.length("seq") == width)

"""Scans of the file formats: variant tables and VCF, peaks, FASTA, GFF3, score tables."""

from __future__ import annotations

import hashlib
import itertools
import json
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe import schemas
from genoframe.functions import alleles
from genoframe.operators import contigs, ingest, ordinal

TABLE_SUFFIXES, VCF_SUFFIXES = (".tsv", ".tsv.gz", ".txt", ".txt.gz"), (".vcf", ".vcf.gz", ".vcf.bgz")


class InputError(ValueError):
    """An input that cannot be read, with a machine-readable code."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def resolve_format(path: str, fmt: str = "auto") -> str:
    """``tsv`` or ``vcf``; suffixes count in any case, binary VCF is not supported."""
    name = path.lower()
    if name.endswith(".bcf") or fmt == "bcf":
        raise InputError("UNSUPPORTED_BCF", path)
    if fmt in ("tsv", "vcf"):
        return fmt
    if fmt != "auto":
        raise InputError("UNKNOWN_FORMAT", fmt)
    if name.endswith(VCF_SUFFIXES):
        return "vcf"
    if name.endswith(TABLE_SUFFIXES):
        return "tsv"
    raise InputError("UNKNOWN_FORMAT", path)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless canonical table; rows of four fields have a null id."""
    return spark.read.schema(schemas.VARIANT).option("sep", "\t").option("mode", "PERMISSIVE").csv(path)


def _text(spark: SparkSession, path: str) -> DataFrame:
    """Lines as ``value`` with their 0-based place ``line``. Text and block-gzipped files are read in splits, gzipped ones whole."""
    if path.lower().endswith(".bgz"):
        return _block_lines(spark, path)
    return _numbered(spark.read.text(path))


#: What every block of a block-gzipped file begins with: a gzip member with an extra field.
BLOCK = b"\x1f\x8b\x08\x04"
#: Pieces of a split's text: whole lines, its first line's rest (up to a line end, or all there is), its last line's begin, its count of lines.
_LINE, _HEAD, _THROUGH, _TAIL, _COUNT = range(5)


def _inflated(rows: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[str, int, bytes]]:
    """Texts of the blocks. What looks like a block's begin may lie within one: a block goes on until its stream has ended."""
    held, at = b"", None
    for file, start, data in rows:
        if at != (file, start):
            if held:
                raise InputError("MALFORMED_BLOCKS", f"{at}: a block has no end")
            held, at = b"", (file, start)
        if not data and not held:
            continue  # before the first block
        # a gzipped file without such blocks is one record
        held = held + BLOCK + data if held or not data.startswith(BLOCK[:3]) else data
        stream = zlib.decompressobj(31)
        text = stream.decompress(held)
        while stream.eof and stream.unused_data:
            held = stream.unused_data
            stream = zlib.decompressobj(31)
            text += stream.decompress(held)
        if stream.eof:
            held = b""
            yield file, start, text
    if held:
        raise InputError("MALFORMED_BLOCKS", f"{at}: a block has no end")


def _split_pieces(rows: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, start, place among the lines of the split, kind, text) of the pieces of each split, whose texts come in order."""
    for (file, start), texts in itertools.groupby(_inflated(rows), key=lambda r: r[:2]):
        n, rest, headed = 0, b"", start == 0
        for _, _, text in texts:
            *lines, rest = (rest + text).split(b"\n")
            for line in lines:
                yield file, start, n, _LINE if headed else _HEAD, line.removesuffix(b"\r")
                n += headed
                headed = True
        yield file, start, n, _TAIL if headed else _THROUGH, rest
        yield file, start, n, _COUNT, b""


def _block_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of block-gzipped files: a scan that takes the blocks' first bytes for ends of records hands each task the blocks that begin
    in its split; it inflates them and gives whole lines, and lines that cross a border of splits are put together from their pieces."""
    blocks = spark.read.option("encoding", "ISO-8859-1").option("lineSep", BLOCK.decode("latin-1")).text(path)
    blocks = blocks.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.col("value").cast("binary").alias("data"))
    names = ["_file", "_start", "_n", "_kind", "value"]

    def run(batches):
        import pyarrow as pa

        rows = (r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.as_py() for x in batch.column(2)), strict=True))
        pieces = _split_pieces(rows)
        while some := list(itertools.islice(pieces, 50_000)):
            file, start, n, kind, text = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(file), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(kind, pa.int32()), pa.array(text, pa.binary())], names)

    pieces = blocks.mapInArrow(run, "_file string, _start long, _n long, _kind int, value binary")
    lines = pieces.where(F.col("_kind") == _LINE).select("_file", "_start", "_n", "value")
    # two or three rows a split
    few = pieces.where(F.col("_kind") > _LINE)
    before = Window.partitionBy("_file").orderBy("_start", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    border = few.where(F.col("_kind") < _COUNT).withColumn("_line", F.coalesce(F.count_if(F.col("_kind") == _HEAD).over(before), F.lit(0)))
    ordered = F.array_sort(F.collect_list(F.struct("_start", "_kind", "_n", "value")))
    joined = border.groupBy("_file", "_line").agg(ordered.alias("p"), F.max(F.col("_kind") == _HEAD).alias("ended"))
    joined = joined.select("_file", F.col("p")[0]["_start"].alias("_start"), F.col("p")[0]["_n"].alias("_n"), F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["value"])).alias("value"), "ended").where("ended OR length(value) > 0").drop("ended")
    counts = few.where(F.col("_kind") == _COUNT).select("_file", "_start", F.col("_n").alias("n")).unionByName(joined.select("_file", "_start", F.lit(1).cast("long").alias("n"))).groupBy("_file", "_start").agg(F.sum("n").alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row a split
    places = F.broadcast(counts.select("_file", "_start", offset.alias("_offset")))
    return lines.unionByName(joined).join(places, ["_file", "_start"]).select(F.regexp_replace(F.col("value").cast("string"), r"\r\z", "").alias("value"), (F.col("_n") + F.col("_offset")).alias("line"))


#: The split of a file that a scanned line is from.
SPLIT = {"_file": "_metadata.file_path", "_start": "_metadata.file_block_start"}


def with_split(lines: DataFrame) -> DataFrame:
    """``value, _file, _start`` of a scan of text."""
    return lines.select("value", *[F.col(c).alias(name) for name, c in SPLIT.items()])


def _placed(lines: DataFrame, by: list[str]) -> DataFrame:
    """Lines with their 0-based place among those of the same ``by``: within each split of a file, then by the lines of the splits before it.

    A scan may take splits in any order; the place of a split is that of its file and its start. Row ids rise along a split without
    a gap. Counts of splits are few and summed up in a window.
    """
    tagged = lines.withColumn("_id", F.monotonically_increasing_id())
    counts = tagged.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_count"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_count").over(Window.partitionBy(*by).orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each split of the files
    shifts = F.broadcast(counts.select(*SPLIT, (before - F.col("_first")).alias("_shift")))
    return tagged.join(shifts, [*SPLIT]).select("value", "_file", (F.col("_id") + F.col("_shift")).alias("line"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines numbered in file order, files of a folder in the order of their names."""
    return _placed(with_split(lines), []).select("value", "line")


def files_mark(spark: SparkSession, *paths: str) -> str:
    """A fingerprint of the files at ``paths``: names, sizes and times of change."""
    listed = []
    for path in paths:
        for r in spark.read.format("binaryFile").load(path).select("path", "length", F.col("modificationTime").cast("string").alias("at")).orderBy("path").collect():
            listed.append([r.path, r.length, r.at])
    return hashlib.sha256(json.dumps(listed).encode()).hexdigest()


def text_digest(spark: SparkSession, path: str) -> tuple[str, int]:
    """(digest of the lines in their order, bytes of the files): lines are hashed where they are read, then the hashes of each block
    of lines, then those of the blocks; no task holds a file."""
    hashed = _text(spark, path).select("line", F.expr(f"line div {LINE_BLOCK}").alias("block"), F.unhex(F.sha2("value", 256)).alias("h"))
    joined = lambda key: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "h"))), lambda x: F.hex(x["h"])), ""), 256)
    blocks = hashed.groupBy("block").agg(F.unhex(joined("line")).alias("h"))
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n")).first().n
    return blocks.agg(joined("block").alias("d")).first().d, size or 0


def _is_no_record() -> Column:
    """Whether a line that is neither a header's nor blank has fewer than five fields or a position that is no integer."""
    fields = F.split("value", "\t")
    body = ~F.col("value").startswith("#") & (F.trim("value") != "")
    return body & ((F.size(fields) < 5) | F.get(fields, F.lit(1)).try_cast("bigint").isNull())


def read_vcf_records(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """(header lines, records): ``record_ordinal, chrom, pos, variant_id, ref, alt_raw, qual, filter, info, format, samples``, quality
    and filters as the text they are.

    Blank lines are skipped; a record of fewer than five fields, or whose position is no integer, raises with its line number.
    """
    lines = _text(spark, path)
    body = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("f", F.split("value", "\t"))
    # one pass: the header, whose lines are those of one file, and the first line that is no record
    head, wrong = F.col("value").startswith("#"), _is_no_record()
    told = lines.agg(F.array_sort(F.collect_list(F.when(head, F.struct("line", "value")))).alias("header"), F.min(F.when(wrong, F.col("line"))).alias("wrong")).first()
    header = [r.value for r in told.header]
    if told.wrong is not None:
        raise InputError("MALFORMED_VCF", f"{path}:{told.wrong + 1}")
    return header, body.select(*_record_columns(F.col("line") - len(header)))


def _record_columns(ordinal: Column) -> list[Column]:
    """Columns of a record whose fields are the array ``f``."""
    names = {0: "chrom", 3: "ref", 4: "alt_raw", 5: "qual", 6: "filter", 7: "info", 8: "format"}
    get = lambda k: F.get("f", F.lit(k))
    fields = {k: get(k).alias(name) for k, name in names.items()}
    fields[1], fields[2] = get(1).try_cast("bigint").alias("pos"), F.when(get(2) != ".", get(2)).alias("variant_id")
    return [ordinal.alias("record_ordinal"), *[fields[k] for k in range(9)], F.slice("f", 10, 1 << 20).alias("samples")]


def check_header(header: list[str], path: str = "") -> None:
    """Genomic VCFs are told by their name or header and rejected; so are headers without the line that names the columns."""
    import re

    name = path.lower()
    name = name.rsplit(".", 1)[0] if name.endswith((".gz", ".bgz")) else name
    if name.endswith(".gvcf"):
        raise InputError("UNSUPPORTED_GVCF", path)
    if not any(line.startswith("#CHROM\tPOS\t") for line in header):
        raise InputError("MALFORMED_VCF", f"{path}: the header has no line of column names")
    for line in header:
        if line.startswith("##GVCFBlock") or re.match(r"##ALT=<.*\bID=NON_REF\b", line):
            raise InputError("UNSUPPORTED_GVCF", line)


def contigs_of(header: list[str]) -> list[str]:
    import re

    return [m[1] for line in header if (m := re.match(r"##contig=<.*?\bID=([^,>]+)", line))]


def samples_of(header: list[str]) -> list[str]:
    last = next((x for x in header if x.startswith("#CHROM")), "")
    return last.split("\t")[9:]


def call(text: Column) -> Column:
    """``gt, phased, ad, dp, gq`` of a sample's column, by the record's ``format``; missing values are null."""
    parts = F.split(text, ":")
    field = lambda name: F.nullif(F.get(parts, F.array_position(F.split("format", ":"), name).cast("int") - 1), F.lit("."))
    ints = lambda c, sep: F.transform(F.split(c, sep), lambda x: x.try_cast("int"))
    gt = field("GT")
    return F.struct(ints(gt, r"[/|]").alias("gt"), F.coalesce(gt.contains("|"), F.lit(False)).alias("phased"), ints(field("AD"), ",").alias("ad"), field("DP").try_cast("int").alias("dp"), field("GQ").try_cast("int").alias("gq"))


def call_of(samples: list[str], name: str) -> Column:
    """The call of one sample; the others' columns are not parsed."""
    return call(F.get("samples", F.lit(samples.index(name))))


def parse_calls(records: DataFrame, samples: list[str]) -> DataFrame:
    """Adds ``calls``: a map of sample to ``gt, phased, ad, dp, gq``, made by one expression however many samples there are."""
    if not samples:
        return records.withColumn("calls", F.lit(None).cast("map<string,string>"))
    calls = F.transform(F.sequence(F.lit(0), F.lit(len(samples) - 1)), lambda k: call(F.get("samples", k)))
    return records.withColumn("calls", F.map_from_arrays(F.lit(samples), calls))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """The batch reader: one row per usable alternate allele, in canonical columns."""
    _, records = read_vcf_records(spark, path)
    rows = ingest.split_alts(records).where(alleles.is_sequence_alt(F.col("ref"), F.col("alt")))
    return rows.select(F.col("chrom").alias("chr"), "pos", "ref", "alt", "variant_id")


def read_variants(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    return read_vcf(spark, path) if resolve_format(path, fmt) == "vcf" else read_tsv(spark, path)


def _with_stop(records: DataFrame) -> DataFrame:
    return records.withColumn("stop", F.coalesce(F.when(F.col("info").contains("END="), F.regexp_extract("info", r"(?:^|;)END=(\d+)", 1)).try_cast("bigint"), F.col("pos") + F.length("ref") - 1))


def vcf_occurrences(spark: SparkSession, path: str, genome: str, target_sample: str | None = None) -> DataFrame:
    """Occurrences of a sorted VCF: record_ordinal from 0, alt_index from 1; records without an allele give none.

    Unsorted inputs, genomic VCFs and unknown target samples raise.
    """
    header, records = read_vcf_records(spark, path)
    check_header(header, path)
    known = contigs_of(header)
    placed = _with_stop(records)
    if known:
        ranked = placed.withColumn("rid", alleles.contig_rank(F.col("chrom"), known))
    else:  # without contig lines a contig's place is that of its first record
        ranked = placed.join(records.groupBy("chrom").agg(F.min("record_ordinal").alias("rid")), "chrom")
    told = ordinal.first_wrong(ranked.withColumn("genomic", ingest.is_genomic()), "record_ordinal", ["rid", "pos"], "genomic")
    if told.marked is not None:
        raise InputError("UNSUPPORTED_GVCF", f"record {told.marked}")
    if told.descent is not None:
        raise InputError("UNSORTED_VCF", f"record {told.descent}")
    rows = records.where("alt_raw <> '.'")
    if target_sample is not None:
        if target_sample not in samples_of(header):
            raise InputError("TARGET_SAMPLE_NOT_FOUND", target_sample)
        rows = rows.withColumn("gt", call_of(samples_of(header), target_sample)["gt"])
    out = ingest.classify(ingest.split_alts(rows))
    if target_sample is not None:
        out = ingest.mask_target(out)
    return _occurrence_columns(out, genome)


def vcf_occurrences_by_file(lines: DataFrame, genome: str) -> tuple[DataFrame, DataFrame]:
    """(occurrences with their ``file``, refusals as ``file, code, message``) of several VCFs at once, each with a header and record
    numbers of its own; ``lines(value, _file, _start)`` are those that a scan gives, see ``with_split``.

    What makes ``vcf_occurrences`` raise makes a file refused: it gives no occurrences, the others do. A file without a line is none.
    """
    placed = _placed(lines, ["_file"])
    value, head = F.col("value"), F.col("value").startswith("#")
    declares, block = r"^##contig=<.*?\bID=([^,>]+)", r"^##GVCFBlock|^##ALT=<.*\bID=NON_REF\b"
    files = placed.groupBy("_file").agg(
        F.count_if(head).alias("_shift"), F.max(value.startswith("#CHROM\tPOS\t")).alias("_named"), F.min(F.when(head & value.rlike(block), value)).alias("_block"),
        F.max(head & value.rlike(declares)).alias("_declares"), F.min(F.when(_is_no_record(), F.col("line"))).alias("_wrong"),
    )
    body = placed.where(~head & (F.trim(value) != "")).join(files.select("_file", "_shift", "_declares"), "_file").withColumn("f", F.split("value", "\t"))
    records = body.select("_file", "_declares", *_record_columns(F.col("line") - F.col("_shift")))
    # a contig's place is that of its line in the header, or of its first record in a file whose header has no such lines
    listed = placed.where(head & value.rlike(declares)).groupBy("_file", F.regexp_extract("value", declares, 1).alias("chrom")).agg(F.min("line").alias("_listed"))
    first = records.groupBy("_file", "chrom").agg(F.min("record_ordinal").alias("_first"), F.first("_declares").alias("_declares"))
    ranks = first.join(listed, ["_file", "chrom"], "left").select("_file", "chrom", F.when(F.col("_declares"), F.col("_listed")).otherwise(F.col("_first")).alias("rid"))
    ranked = _with_stop(records).join(ranks, ["_file", "chrom"]).withColumn("genomic", ingest.is_genomic())
    told = files.join(ordinal.first_wrong_by(ranked, ["_file"], "record_ordinal", ["rid", "pos"], "genomic"), "_file", "left")
    at = lambda c, shift=0: F.concat(F.lit("record " if not shift else "line "), (F.col(c) + shift).cast("string"))
    rules = (
        (F.col("_file").rlike(r"(?i)\.gvcf(\.gz)?$"), "UNSUPPORTED_GVCF", F.lit("name")), (~F.col("_named"), "MALFORMED_VCF", F.lit("the header has no line of column names")),
        (F.col("_block").isNotNull(), "UNSUPPORTED_GVCF", F.col("_block")), (F.col("_wrong").isNotNull(), "MALFORMED_VCF", at("_wrong", 1)),
        (F.col("marked").isNotNull(), "UNSUPPORTED_GVCF", at("marked")), (F.col("descent").isNotNull(), "UNSORTED_VCF", at("descent")),
    )
    refusal = F.coalesce(*[F.when(rule, F.struct(F.lit(code).alias("code"), message.alias("message"))) for rule, code, message in rules])
    refused = told.select(F.col("_file").alias("file"), refusal.alias("r")).where("r IS NOT NULL").select("file", "r.*")
    good = records.withColumnRenamed("_file", "file").join(refused.select("file"), "file", "left_anti").where("alt_raw <> '.'")
    return _occurrence_columns(ingest.classify(ingest.split_alts(good)), genome, "file"), refused


def tsv_occurrences(spark: SparkSession, path: str, genome: str) -> DataFrame:
    """Occurrences of a table of four or five fields a line; other lines and positions that are no integers raise."""
    lines = _text(spark, path).where(F.trim("value") != "").withColumn("f", F.split("value", "\t"))
    bad = lines.where((~F.size("f").isin(4, 5)) | F.expr("try_cast(f[1] AS bigint)").isNull()).select("line").first()
    if bad is not None:
        raise InputError("MALFORMED_TSV", f"{path}:{bad.line + 1}")
    rows = lines.select(
        F.col("line").alias("record_ordinal"), F.lit(1).alias("alt_index"), F.col("f")[0].alias("chrom"), F.col("f")[1].cast("bigint").alias("pos"), F.col("f")[2].alias("ref"), F.col("f")[3].alias("alt"), F.nullif(F.get("f", F.lit(4)), F.lit("")).alias("variant_id"),
    )
    return _occurrence_columns(ingest.classify(rows), genome)


def _occurrence_columns(rows: DataFrame, genome: str, *more: str) -> DataFrame:
    named = ingest.with_canonical_id(rows.withColumn("chrom", alleles.with_chr(F.col("chrom"))), name="canonical_variant_id").withColumnRenamed("chrom", "chr").withColumn("genome", F.lit(genome))
    return named.select(*more, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.OCCURRENCE.fields])


def peak_windows(peaks: DataFrame, width: int = 2114) -> DataFrame:
    """Adds ``summit_pos, window_start, window_end``; only where no peak at all has a summit are middles taken."""
    known = peaks.agg(F.count("summit_offset").alias("_known"))
    # one row
    both = peaks.crossJoin(F.broadcast(known))
    summit = F.when(F.col("_known") == 0, F.expr("(`end` - `start`) div 2")).otherwise(F.col("summit_offset"))
    out = both.withColumn("summit_pos", F.col("start") + summit).drop("_known")
    return out.withColumn("window_start", F.col("summit_pos") - width // 2).withColumn("window_end", F.col("summit_pos") + width // 2)


def read_peaks(spark: SparkSession, path: str, width: int = 2114) -> DataFrame:
    return peak_windows(spark.read.schema(schemas.NARROW_PEAK).option("sep", "\t").csv(path), width)


#: Lines whose lengths are summed up in one task.
LINE_BLOCK = 1 << 16


def read_fasta_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``contig, chunk, seq``: overlapping chunks of each contig's letters, see ``operators.contigs``; names end at the first blank.

    A line's place in its contig is a running sum of lengths, within blocks of lines and then over the few blocks; no task holds a
    contig. Contigs of one name follow each other; letters before the first name are dropped.
    """
    lines = _text(spark, path).select("line", F.rtrim("value").alias("value")).where("value <> ''")
    head = F.col("value").startswith(">")
    # names are taken before lines move, so that what sums up the blocks moves numbers and names only
    name = F.when(head, F.regexp_extract("value", r"^>(\S*)", 1)).alias("_name")
    sized = lines.select("line", "value", F.expr(f"line div {LINE_BLOCK}").alias("_block"), F.when(head, 0).otherwise(F.length("value")).cast("long").alias("_len"), name)
    within = Window.partitionBy("_block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    run = sized.withColumn("_run", F.sum("_len").over(within))
    run = run.withColumn("_head", F.last(F.when(F.col("_name").isNotNull(), F.struct(F.col("_name").alias("name"), F.col("_run").alias("start"))), ignorenulls=True).over(within))
    blocks = run.groupBy("_block").agg(F.sum("_len").alias("_size"), F.max_by("_head", "line").alias("_end"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifted = blocks.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long")))
    shifted = shifted.withColumn("_end", F.when(F.col("_end").isNotNull(), F.struct(F.col("_end.name").alias("name"), (F.col("_end.start") + F.col("_offset")).alias("start"))))
    shifted = shifted.select("_block", "_offset", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    placed = run.where("_name IS NULL").join(shifted, "_block")
    own = F.when(F.col("_head").isNotNull(), F.struct(F.col("_head.name").alias("name"), (F.col("_head.start") + F.col("_offset")).alias("start"))).otherwise(F.col("_carried"))
    placed = placed.withColumn("_own", own).where("_own IS NOT NULL")
    return contigs.from_lines(placed.select(F.col("_own.name").alias("contig"), (F.col("_offset") + F.col("_run") - F.col("_len") - F.col("_own.start")).alias("at"), "value"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``contig, seq``: whole contigs, for short ones; jobs read chunks."""
    return contigs.whole(read_fasta_chunks(spark, path))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 rows of the main chromosomes, named with their prefix; ``MT`` is ``chrM``."""
    rows = spark.read.schema(schemas.GFF).option("sep", "\t").option("comment", "#").csv(path)
    main = [*map(str, range(1, 23)), "X", "Y", "MT"]
    chrom = F.when(F.col("seqid") == "MT", "chrM").otherwise(F.concat(F.lit("chr"), F.col("seqid")))
    return rows.where(F.col("seqid").isin(main)).withColumn("chrom", chrom)


def read_ccre(spark: SparkSession, path: str) -> DataFrame:
    """Regulatory elements; their half-open coordinates are used as closed ones, as the tree of the original does."""
    return spark.read.schema(schemas.CCRE).option("sep", "\t").csv(path)


def read_missense(spark: SparkSession, path: str) -> DataFrame:
    """Score table with three preamble lines and a header that starts with ``#``."""
    return spark.read.schema(schemas.MISSENSE).option("sep", "\t").option("comment", "#").csv(path)


def read_fold_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores of one fold; the header must be exact, ids unique; empty values are null."""
    first = spark.read.text(path).first()
    wanted = [f.name for f in schemas.FOLD_SCORE.fields]
    if first is None or first.value.split("\t") != wanted:
        raise InputError("MALFORMED_SCORES", f"{path}: header must be {' '.join(wanted)}")
    rows = spark.read.schema(schemas.FOLD_SCORE).option("sep", "\t").option("header", True).csv(path)
    return ingest.require_unique(rows, "variant_id")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Results in ``bucket=N`` folders, columns united; in order of record and allele."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    if rows.isEmpty():
        raise InputError("EMPTY_BUCKET", path)
    return rows.orderBy("record_ordinal", "alt_index")

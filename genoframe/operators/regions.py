"""Region labels of variants, their routing to categories, and the derivation of regions from gene models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.functions.scoring import let
from genoframe.operators.intervals import LEVELS, PLACE, merged, overlaps_or_none, spread, spread_levels

#: Labels from most to least severe.
SEVERITY = ("splice_site", "cds", "splice_region", "five_prime_utr", "three_prime_utr", "exonic", "noncoding_gene", "intronic", "promoter", "intergenic")
#: Categories and the labels of which any one suffices.
CATEGORIES = {
    "coding": ("cds",),
    "exonic": ("exonic",),
    "five_prime_utr": ("five_prime_utr",),
    "three_prime_utr": ("three_prime_utr",),
    "splice": ("splice_site", "splice_region"),
    "splice_site": ("splice_site",),
    "splice_region": ("splice_region",),
    "intronic": ("intronic",),
    "promoter": ("promoter",),
    "noncoding_gene": ("noncoding_gene",),
    "genic": ("cds", "exonic", "five_prime_utr", "three_prime_utr", "splice_site", "splice_region", "intronic", "noncoding_gene"),
    "intergenic": (),
}
DEFAULT_CATEGORIES = tuple(c for c in CATEGORIES if c != "intergenic")
#: Bases of splice sites and regions, and of promoters around the start of transcription.
SITE, REGION_EXON, REGION_INTRON, UPSTREAM, DOWNSTREAM = 2, 3, 8, 500, 100


def labels_of(feature: Column, biotype: Column) -> Column:
    return (
        F.when(feature == "exon", F.array(F.when(biotype == "protein_coding", "exonic").otherwise("noncoding_gene")))
        .when(feature.isin("splice_donor", "splice_acceptor"), F.array(F.lit("splice_site"), F.lit("splice_region")))
        .when(feature == "intron", F.array(F.lit("intronic")))
        .otherwise(F.array(feature))
    )


def condensed(regions: DataFrame) -> DataFrame:
    """Regions of the same labels over the same bases, and of the same genes: one row for a stretch of a label, without a gene, and one for a
    stretch of a gene, without a feature. However many regions lie over a place, it has no more rows than labels and genes."""
    own = regions.select("chrom", "start", "end", "feature", F.when(F.col("feature") == "exon", F.col("biotype")).alias("biotype"), "gene_id")
    none = lambda *names: [F.lit(None).cast("string").alias(c) for c in names]
    place = ["chrom", "start", "end"]
    labels = merged(own, ["chrom", "feature", "biotype"]).select(*place, "feature", "biotype", *none("gene_id"))
    genes = merged(own.where("gene_id IS NOT NULL"), ["chrom", "gene_id"]).select(*place, *none("feature", "biotype"), "gene_id")
    return spread(labels.unionByName(genes))


def _listed(spans: DataFrame, held: DataFrame) -> DataFrame:
    """``chrom, pos, ref, _mask, gene_ids`` by lists of what touches each of the smallest bins: a variant meets one row, its bin's, and takes
    from the list what it overlaps; only variants that touch several bins are grouped."""
    lists = held.groupBy("chrom", *PLACE).agg(F.collect_list(F.struct("start", "end", "mask", "gene_id")).alias("_list")).toDF("_chrom", *PLACE, "_list")
    low, high = (F.shiftright(F.col(c).cast("long"), LEVELS[0]) for c in ("pos", "v_end"))
    key = ["chrom", "pos", "ref"]

    def met(rows: DataFrame, bins) -> DataFrame:
        looked = rows.withColumn("_level", F.lit(LEVELS[0])).withColumn("_bin", bins)
        on = (looked["_level"] == lists["_held"]) & (looked["_bin"] == lists["_place"]) & (looked["chrom"] == lists["_chrom"])
        hits = F.filter("_list", lambda x: (x["start"] <= F.col("v_end")) & (x["end"] >= F.col("pos")))
        mask = lambda h: F.aggregate(h, F.lit(0), lambda a, x: a.bitwiseOR(x["mask"]))
        genes = lambda h: F.array_distinct(F.array_compact(F.transform(h, lambda x: x["gene_id"])))
        out = looked.join(lists, on, "left").select(*key, let(hits, lambda h: F.struct(mask(h).alias("mask"), genes(h).alias("genes"))).alias("_r"))
        return out.select(*key, F.col("_r.mask").alias("_mask"), F.col("_r.genes").alias("_genes"))

    one = met(spans.where(F.coalesce(low >= high, F.lit(True))), low)
    several = met(spans.where(low < high), F.explode(F.sequence(low, high))).groupBy(*key).agg(F.bit_or("_mask").alias("_mask"), F.array_distinct(F.flatten(F.collect_list("_genes"))).alias("_genes"))
    return one.unionByName(several).select(*key, "_mask", F.array_sort(F.coalesce("_genes", F.array().cast("array<string>"))).alias("gene_ids"))


def annotate(variants: DataFrame, regions: DataFrame, levels: tuple[int, ...] | None = None) -> DataFrame:
    """``chrom, pos, ref, labels, gene_ids, primary, is_coding, in_promoter`` of each distinct ``(chrom, pos, ref)``.

    Labels are those of all regions that the variant's span overlaps, most severe first; without any it is intergenic.
    ``regions(chrom, start, end, feature, biotype, gene_id)``. Labels of no known severity are dropped.
    They may be a stored index of intervals, whose ``levels`` are known; its rows are then not shuffled. Others are condensed first;
    where regions are dense, an index had better be written of them ``condensed`` too.
    """
    v = variants.select("chrom", "pos", "ref").distinct()
    spans = v.withColumn("v_end", F.col("pos") + F.length("ref") - 1)
    if levels is None:
        regions, levels = condensed(regions), spread_levels(regions)
    found = labels_of(F.col("feature"), F.col("biotype"))
    mask = sum((F.when(F.array_contains(found, x), 1 << k).otherwise(0) for k, x in enumerate(SEVERITY)), F.lit(0))
    r = regions.select("chrom", "start", "end", mask.alias("mask"), "gene_id", *[c for c in PLACE if c in regions.columns])
    if tuple(levels) == LEVELS[:1] and set(PLACE) <= set(r.columns):
        some = _listed(spans, r)
    else:
        met = overlaps_or_none(spans, r, ("chrom", "pos", "v_end"), ("chrom", "start", "end"), levels)
        some = met.groupBy("chrom", "pos", "ref").agg(F.bit_or("mask").alias("_mask"), F.array_sort(F.collect_set("gene_id")).alias("gene_ids"))
    some = some.select("chrom", "pos", "ref", F.coalesce("_mask", F.lit(0)).alias("_mask"), "gene_ids")
    labels = F.array_compact(F.array(*[F.when(F.col("_mask").bitwiseAND(1 << k) != 0, x) for k, x in enumerate(SEVERITY)]))
    out = some.select("chrom", "pos", "ref", F.when(F.col("_mask") != 0, labels).otherwise(F.array(F.lit("intergenic"))).alias("labels"), "gene_ids")
    has = lambda x: F.array_contains("labels", x)
    return out.withColumn("primary", F.element_at("labels", 1)).withColumn("is_coding", has("cds")).withColumn("in_promoter", has("promoter"))


def _rule(category: str) -> Column:
    if category == "intergenic":
        return F.size(F.array_remove("labels", "intergenic")) == 0
    return F.arrays_overlap("labels", F.lit(list(CATEGORIES[category])))


def checked(categories) -> list[str]:
    unknown = sorted(set(categories) - CATEGORIES.keys())
    if unknown:
        raise ValueError(f"unknown categories: {', '.join(unknown)}")
    return list(categories)


def route(annotated: DataFrame, categories=DEFAULT_CATEGORIES) -> DataFrame:
    """A row with ``category`` for each requested category of each annotated variant; categories overlap."""
    names = F.array(*[F.when(_rule(c), F.lit(c)) for c in checked(categories)])
    return annotated.withColumn("category", F.explode(F.array_compact(names)))


def route_counts(routed: DataFrame, categories=DEFAULT_CATEGORIES) -> DataFrame:
    """``category, n`` with a row for every requested category, zeros kept."""
    every = routed.sparkSession.createDataFrame([(c,) for c in checked(categories)], "category string")
    return every.join(routed.groupBy("category").agg(F.count(F.lit(1)).alias("n")), "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


def introns(exons: DataFrame, order: tuple[str, ...] = ("start", "end")) -> DataFrame:
    """Gaps between successive exons of a transcript: the exon's columns, ``exon_end``, ``next_start`` and the intron's ``start, end``."""
    following = F.lead("start").over(Window.partitionBy("tx").orderBy(*order))
    gaps = exons.withColumn("next_start", following).where(F.col("next_start") > F.col("end") + 1)
    return gaps.withColumn("exon_end", F.col("end")).withColumn("start", F.col("end") + 1).withColumn("end", F.col("next_start") - 1)


def _parts(parts: list[tuple[Column, Column, Column]], name: str) -> list[Column]:
    return [F.struct(kind.alias(name), start.cast("long").alias("start"), end.cast("long").alias("end")) for kind, start, end in parts]


def _fragments(gaps: DataFrame, parts: list[tuple[Column, Column, Column]], name: str) -> DataFrame:
    return gaps.withColumn("_part", F.explode(F.array(*_parts(parts, name)))).drop("start", "end").select("*", "_part.*").drop("_part")


def _site_parts(a: Column, b: Column) -> list[tuple[Column, Column, Column]]:
    first = F.when(F.col("strand") == "+", "splice_donor").otherwise("splice_acceptor")
    last = F.when(F.col("strand") == "+", "splice_acceptor").otherwise("splice_donor")
    return [(first, a, F.least(a + SITE - 1, b)), (last, F.greatest(b - SITE + 1, a), b)]


def _region_parts(a: Column, b: Column, exon_end: Column, next_start: Column, left: str, right: str) -> list[tuple[Column, Column, Column]]:
    return [(F.lit(left), exon_end - REGION_EXON + 1, F.least(a + REGION_INTRON - 1, b)), (F.lit(right), F.greatest(b - REGION_INTRON + 1, a), next_start + REGION_EXON - 1)]


def splice_sites(gaps: DataFrame) -> DataFrame:
    """Two bases at each end of each intron, clamped to it; the strand says which is the donor (``kind``)."""
    return _fragments(gaps, _site_parts(F.col("start"), F.col("end")), "kind")


def splice_regions(gaps: DataFrame) -> DataFrame:
    """Three bases of exon and eight of intron around each end, clamped on the intron's side only (``side``)."""
    return _fragments(gaps, _region_parts(F.col("start"), F.col("end"), F.col("exon_end"), F.col("next_start"), "left", "right"), "side")


def promoters(genes: DataFrame) -> DataFrame:
    """Window around the start of transcription by strand; any strand but + counts as -. Starts are 1 at least."""
    plus = F.col("strand") == "+"
    tss = F.when(plus, F.col("start")).otherwise(F.col("end"))
    start = F.greatest(tss - F.when(plus, UPSTREAM).otherwise(DOWNSTREAM), F.lit(1))
    return genes.withColumn("_end", tss + F.when(plus, DOWNSTREAM).otherwise(UPSTREAM)).withColumn("start", start).withColumn("end", F.col("_end")).drop("_end")


#: Columns of a region table that come with its exons and genes, if they have them.
OWN = ("strand", "gene_id", "gene_name", "biotype")


def region_table(exons: DataFrame, genes: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """``feature, chrom, start, end`` of exons, of ``parts`` (coding and untranslated ones, with their ``feature``) and of all that
    is derived; and ``strand, gene_id, gene_name, biotype`` if both tables have them. Null or empty fragments are dropped. Exons are read and moved once: each gives itself and what lies up to the next one."""
    own = [c for c in OWN if c in exons.columns and c in genes.columns]
    own = own if len(own) == len(OWN) else []
    pick = lambda df, feature: df.select(feature.alias("feature"), "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), *own)
    following = F.lead("start").over(Window.partitionBy("tx").orderBy("start", "end"))
    exon, after = (F.lit("exon"), F.col("start"), F.col("end")), F.col("_next")
    a, b = F.col("end") + 1, after - 1
    gap = [exon, (F.lit("intron"), a, b), *_site_parts(a, b), *_region_parts(a, b, F.col("end"), after, "splice_region", "splice_region")]
    made = F.when(after > a, F.array(*_parts(gap, "feature"))).otherwise(F.array(*_parts([exon], "feature")))
    spread = exons.withColumn("_next", following).select("chrom", *own, F.explode(made).alias("_part")).select("chrom", *own, "_part.*")
    rows = [pick(spread, F.col("feature")), pick(promoters(genes), F.lit("promoter"))]
    if parts is not None:
        rows.append(pick(parts, F.col("feature")))
    out = rows[0]
    for part in rows[1:]:
        out = out.unionByName(part)
    return out.where("chrom IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL AND end >= start")


def attribute(attributes: Column, key: str) -> Column:
    """Value of a GFF3 attribute, null if absent."""
    return F.nullif(F.regexp_extract(attributes, rf"(?:^|;){key}=([^;]+)", 1), F.lit(""))


def after_colon(value: Column) -> Column:
    return F.when(value.contains(":"), F.regexp_replace(value, r"^[^:]*:", "")).otherwise(value)


def transcripts_of(gff: DataFrame) -> DataFrame:
    """``tx, gene_id, biotype, name`` of the transcripts in ``gff(feature, attributes)``: biotype and name are the gene's, and a gene
    without a name is called by its id."""
    # a plain test first spares the rows of parts, which are most, the expressions
    told = gff.where(F.col("feature").endswith("gene") | F.col("attributes").contains("ID=transcript:"))
    named = told.select("feature", *[attribute(F.col("attributes"), k).alias(k) for k in ("ID", "Parent", "biotype", "Name")])
    genes = named.where(F.col("feature").endswith("gene")).select(after_colon(F.col("ID")).alias("gene_id"), "biotype", F.coalesce("Name", after_colon(F.col("ID"))).alias("name"))
    tx = named.where(F.col("ID").startswith("transcript:")).select(after_colon(F.col("ID")).alias("tx"), after_colon(F.col("Parent")).alias("gene_id"))
    return tx.join(genes, "gene_id", "left").select("tx", "gene_id", "biotype", "name")


#: Features of a transcript in GFF3, and their names in the region table.
PARTS = {"exon": "exon", "CDS": "cds", "five_prime_UTR": "five_prime_utr", "three_prime_UTR": "three_prime_utr"}


def genes_of(gff: DataFrame) -> DataFrame:
    """``gene_id, gene_name, biotype, chrom, start, end, strand`` of the genes in ``gff(chrom, start, end, strand, feature, attributes)``."""
    own = {k: attribute(F.col("attributes"), k) for k in ("ID", "biotype", "Name")}
    rows = gff.where(F.col("feature").endswith("gene")).select(after_colon(own["ID"]).alias("gene_id"), own["Name"].alias("_name"), own["biotype"].alias("biotype"), "chrom", "start", "end", "strand")
    return rows.select("gene_id", F.coalesce("_name", "gene_id").alias("gene_name"), "biotype", "chrom", "start", "end", "strand")


def parts_of(gff: DataFrame) -> DataFrame:
    """``tx, feature`` (as in the region table), place, strand and gene of the exons, coding and untranslated parts of transcripts that
    the same ``gff`` has. A gene that it lacks leaves name and biotype null."""
    rows = gff.where(F.col("feature").isin(*PARTS)).select(after_colon(attribute(F.col("attributes"), "Parent")).alias("tx"), F.col("feature").alias("_part"), "chrom", "start", "end", "strand")
    names = F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair])
    tx = transcripts_of(gff).select("tx", "gene_id", F.col("name").alias("gene_name"), "biotype")
    return rows.join(tx, "tx").withColumn("feature", names[F.col("_part")]).drop("_part")


def regions_of(gff: DataFrame) -> DataFrame:
    """The region table of a gene model, as ``annotate`` and the preprocessing job read it: ``chrom, start, end, strand, feature,
    gene_id, gene_name, biotype``."""
    parts = parts_of(gff)
    table = region_table(parts.where("feature = 'exon'").drop("feature"), genes_of(gff), parts.where("feature <> 'exon'"))
    return table.select("chrom", "start", "end", "strand", "feature", "gene_id", "gene_name", "biotype")

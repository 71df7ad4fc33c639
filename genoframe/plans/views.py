"""Genomic views of the driver's tables, by integer arithmetic that every SQL engine shares.

The SQL texts are the specification; the frames select the same expressions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions import scoring
from genoframe.operators import ingest

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
MODELS = ("click", "error", "purchase", "signup", "view")


def chromosome(n: str) -> str:
    return f"CASE WHEN {n} % 25 = 23 THEN 'chrX' WHEN {n} % 25 = 24 THEN 'chrM' ELSE concat('chr', CAST({n} % 25 + 1 AS varchar(4))) END"


VARIANTS = {
    "chrom": chromosome("l_suppkey"),
    "pos": "(l_partkey * 37 + l_orderkey * 11) % 100000 + 1",
    "ref": "concat(CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'C' ELSE 'G' END, CASE WHEN l_linestatus = 'F' THEN 'TA' ELSE '' END)",
    "alt_raw": "CASE l_linenumber WHEN 1 THEN 'T' WHEN 2 THEN 'A,C' WHEN 3 THEN 'GTT' WHEN 4 THEN '*' WHEN 5 THEN '<DEL>,G' WHEN 6 THEN 'G]chr1:5]' ELSE '.' END",
}
INTERVAL = {"chrom": chromosome("p_partkey"), "start_": "(p_partkey * 53) % 100000 + 1", "end_": "(p_partkey * 53) % 100000 + 1 + p_size * 20"}
REGIONS = {
    "rid": "p_partkey",
    **INTERVAL,
    "feature": "CASE p_type WHEN 'ECONOMY' THEN 'exon' WHEN 'STANDARD' THEN 'cds' WHEN 'PROMO' THEN 'promoter' WHEN 'SMALL' THEN 'intron' WHEN 'LARGE' THEN 'splice_donor' ELSE CASE WHEN p_size < 10 THEN 'five_prime_utr' WHEN p_size < 20 THEN 'three_prime_utr' ELSE 'splice_region' END END",
    "biotype": "CASE WHEN p_brand < 'Brand#2' THEN 'protein_coding' ELSE 'lncRNA' END",
    "gene_id": "concat('G', CAST(p_partkey % 400 AS varchar(6)))",
}
GENES = {"gene_id": "concat('G', CAST(p_partkey AS varchar(12)))", **INTERVAL, "strand": "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END"}
EXONS = {
    "tx": "l_orderkey",
    "chrom": chromosome("l_orderkey"),
    "start_": "(l_partkey * 53 + l_linenumber * 1000) % 100000 + 1",
    "end_": "(l_partkey * 53 + l_linenumber * 1000) % 100000 + 1 + CAST(2 * l_quantity AS bigint)",
    "strand": "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END",
    "l_partkey": "l_partkey",
}
#: Genotypes of family members 1 (proband), 2 (mother), 3 (father), 4 (sibling); duplicates have the least values.
FAMILY = {
    "record": "l_orderkey",
    "member": "l_linenumber",
    "a1": "CASE min(l_returnflag) WHEN 'R' THEN 1 ELSE 0 END",
    "a2": "CASE min(l_returnflag) WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE 2 END",
    "dp": "CAST(min(l_quantity) AS int)",
    "gq": "CAST(CAST(floor(min(l_extendedprice)) AS bigint) % 60 AS int)",
}


SEQUENCE = "translate(lower(text), 'bdefhijklmnopqrsuvwxyz .acgt', 'ACGTACGTACGTACGTACGTACGTACGT')"


def select_sql(columns: dict[str, str], tail: str, *more: str) -> str:
    return "SELECT " + ", ".join([*more, *(f"{e} AS {c}" for c, e in columns.items())]) + " " + tail


V_SQL = select_sql(VARIANTS, "FROM lineitem", *ORDER)
R_SQL = select_sql(REGIONS, "FROM part")
G_SQL = select_sql(GENES, "FROM part")
T_SQL = select_sql(EXONS, "FROM lineitem")
FAM_SQL = select_sql(FAMILY, "FROM lineitem WHERE l_linenumber <= 4 GROUP BY l_orderkey, l_linenumber")


class Views:
    """Frames over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _named(self, table: str, columns: dict[str, str], *more: str) -> DataFrame:
        names = {"start_": "start", "end_": "end"}
        spark_sql = lambda e: e.replace("varchar(4)", "string").replace("varchar(6)", "string").replace("varchar(12)", "string")
        return self.table(table).select(*more, *[F.expr(spark_sql(e)).alias(names.get(c, c)) for c, e in columns.items() if c not in more])

    @property
    def variants(self) -> DataFrame:
        return self._named("lineitem", VARIANTS, *ORDER)

    @property
    def occurrences(self) -> DataFrame:
        return ingest.classify(ingest.split_alts(self.variants))

    @property
    def canonical_rows(self) -> DataFrame:
        return ingest.with_canonical_id(self.occurrences.where("error_code IS NULL"))

    @property
    def regions(self) -> DataFrame:
        return self._named("part", REGIONS)

    @property
    def genes(self) -> DataFrame:
        return self._named("part", GENES)

    @property
    def exons(self) -> DataFrame:
        return self._named("lineitem", EXONS)

    @property
    def gene_model(self) -> DataFrame:
        """Genes, transcripts and their parts as GFF3 rows: some genes lack a name, some parts a transcript, some transcripts a gene."""
        row = lambda feature, attributes, chrom, start, end, strand: [F.expr(x).alias(n) for x, n in ((feature, "feature"), (attributes, "attributes"), (chrom, "chrom"), (start, "start"), (end, "end"), (strand, "strand"))]
        gene = self.table("customer").where("c_custkey % 5 <> 0").select(*row("'ncRNA_gene'", "concat('ID=gene:G', c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat(';Name=', c_name) END, ';biotype=', CASE WHEN c_custkey % 2 = 0 THEN 'protein_coding' ELSE 'lncRNA' END)", "concat('chr', c_custkey % 22 + 1)", "c_custkey * 977 % 100000 + 1", "c_custkey * 977 % 100000 + 5000", "CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END"))
        tx = self.table("orders").where("o_orderkey % 9 <> 0").select(*row("'mRNA'", "concat('ID=transcript:T', o_orderkey, ';Parent=gene:G', o_custkey, ';Name=t')", "concat('chr', o_orderkey % 22 + 1)", "CAST(1 AS bigint)", "CAST(9 AS bigint)", "'+'"))
        part = self.table("lineitem").select(*row("CASE l_linenumber % 5 WHEN 0 THEN 'exon' WHEN 1 THEN 'CDS' WHEN 2 THEN 'exon' WHEN 3 THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END", "concat('Parent=transcript:T', l_orderkey, ';rank=', l_linenumber)", "concat('chr', l_orderkey % 22 + 1)", "l_partkey * 40 + l_linenumber", "l_partkey * 40 + l_linenumber + CAST(l_quantity AS bigint)", "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END"))
        return gene.unionByName(tx).unionByName(part)

    @property
    def family(self) -> DataFrame:
        """One row per record and member: ``gt`` is null below a depth of 3; even records are phased."""
        t = self.table("lineitem").where("l_linenumber <= 4")
        aggs = [F.expr(FAMILY[c]).alias(c) for c in ("a1", "a2", "dp", "gq")]
        rows = t.groupBy(F.col("l_orderkey").alias("record"), F.col("l_linenumber").alias("member")).agg(*aggs)
        return rows.select("record", "member", "dp", "gq", (F.col("record") % 2 == 0).alias("phased"), F.when(F.col("dp") >= 3, F.array("a1", "a2")).alias("gt"))

    @property
    def missense(self) -> DataFrame:
        """Score table with one to three transcripts an allele."""
        keyed = self.occurrences.where("error_code IS NULL AND l_partkey % 3 = 0").groupBy("chrom", "pos", "ref", "alt").agg(F.min("l_partkey").alias("pk"), F.max("l_linenumber").alias("ln"))
        score = F.round((F.col("pk") % 1000) / 1000.0, 3)
        grade = F.when(F.col("pk") % 1000 < 340, "benign").when(F.col("pk") % 1000 < 564, "ambiguous").otherwise("pathogenic")
        return keyed.select("chrom", "pos", "ref", "alt", F.explode(F.sequence(F.lit(1), (F.col("ln") % 3 + 1).cast("int"))).alias("t"), score.alias("score"), grade.alias("class")).withColumn("transcript_id", F.concat(F.lit("T"), F.col("t").cast("string")))

    @property
    def contigs(self) -> DataFrame:
        """Prose as sequence; some letters stay as they are and break the alphabet's rules."""
        return self.table("documents").select(F.col("doc_id").alias("contig"), F.expr(SEQUENCE).alias("seq"))

    @property
    def sequence_variants(self) -> DataFrame:
        """A variant on each contig, somewhere on its whole length, cut from it or made up."""
        return self.contigs.select(
            F.col("contig").alias("id"),
            F.expr("CASE WHEN contig % 30 < 22 THEN concat('chr', CAST(contig % 30 + 1 AS string)) WHEN contig % 30 = 22 THEN 'chrX' WHEN contig % 30 = 23 THEN 'Y' WHEN contig % 30 = 24 THEN 'chrM' ELSE concat('chr', CAST(contig % 30 AS string)) END").alias("chrom"),
            F.expr("(contig * 7919) % greatest(length(seq), 1) + 1").alias("pos"),
            F.expr("CASE WHEN contig % 11 = 0 THEN 'GATTACA' ELSE substring(seq, CAST((contig * 7919) % greatest(length(seq), 1) + 1 AS int), CAST(1 + contig % 3 AS int)) END").alias("ref"),
            F.expr("CASE contig % 7 WHEN 0 THEN 'n' WHEN 1 THEN 'GATTACA' WHEN 2 THEN '' ELSE 'T' END").alias("alt"),
        )

    @property
    def model_scores(self) -> DataFrame:
        """One row per user and model (event type): fold change, quantile, whether in a peak."""
        e = self.table("events")
        return e.groupBy("user_id", F.col("event_type").alias("model_id")).agg(
            (scoring.mean("value") / 97 - 1).alias("logfc"), (F.count(F.lit(1)) / 30).alias("active_allele_quantile"), (F.max("value") > 300).alias("in_peak")
        )

    @property
    def prioritized(self) -> DataFrame:
        from genoframe.operators import prioritize

        wide = prioritize.pivot(self.model_scores, ["user_id"], list(MODELS), unique=False)
        return prioritize.prioritize(wide, list(MODELS))

    @property
    def logit_pairs(self) -> DataFrame:
        """Reference and alternate logits: vectors of one id and the next."""
        e = self.table("embeddings").select("vec_id", "embedding", "label")
        return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("alt")), "vec_id").withColumnRenamed("embedding", "ref")

    @property
    def results(self) -> DataFrame:
        """Results of supported occurrences, by ordinal; every seventh is lost."""
        return self.ordered_occurrences.where("error_code IS NULL AND record_ordinal % 7 <> 0").select("record_ordinal", "alt_index", F.concat(F.lit("R"), F.col("record_ordinal").cast("string")).alias("result_variant_id"), F.col("l_extendedprice").alias("score"), F.when(F.col("l_partkey") % 4 != 0, F.concat(F.lit("G"), (F.col("l_partkey") % 50).cast("string"))).alias("gene"))

    @cached_property
    def ordered_occurrences(self) -> DataFrame:
        """One frame, so that what is made of it twice shares its slices and its shuffle."""
        from genoframe.operators.ordinal import with_ordinal

        return ingest.classify(ingest.split_alts(with_ordinal(self.variants, ORDER)))

"""Command line: ``python -m genoframe.cli preprocess|annotate|lookup|summarize|export|score|predict|regions|genes|elements|missense|frequencies ...``"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from genoframe.operators import regions
from genoframe.plans import jobs as model_jobs
from genoframe.plans import pipelines
from genoframe.sources import readers, sinks


def _arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="genoframe")
    jobs = top.add_subparsers(dest="job", required=True)
    pre = jobs.add_parser("preprocess", help="validate an input and route its variants to region categories")
    pre.add_argument("variants")
    pre.add_argument("fasta")
    pre.add_argument("regions", help="Parquet region table")
    pre.add_argument("out")
    pre.add_argument("--format", default="auto", choices=("auto", "tsv", "vcf"))
    pre.add_argument("--categories", nargs="*", default=list(regions.DEFAULT_CATEGORIES))
    pre.add_argument("--width", type=int, default=2114)
    pre.add_argument("--phenopacket")
    ann = jobs.add_parser("annotate", help="annotate a variant table; writes JSON lines")
    for name in ("variants", "regions", "genes", "elements", "frequencies", "out"):
        ann.add_argument(name)
    folds = jobs.add_parser("summarize", help="average fold scores; folds as -f PATH, repeated")
    folds.add_argument("-f", "--fold", action="append", required=True)
    folds.add_argument("out")
    look = jobs.add_parser("lookup", help="left join a variant table with a score table partitioned by chromosome; prints statistics")
    for name in ("variants", "table", "out"):
        look.add_argument(name)
    exp = jobs.add_parser("export", help="merge bucketed results into the input VCF")
    for name in ("vcf", "buckets", "models", "manifest", "out"):
        exp.add_argument(name)
    exp.add_argument("--prefix", default="GF1")
    exp.add_argument("--no-model-scores", action="store_true")
    run = jobs.add_parser("score", help="score variants with a model, module:function, that loads it; goes on where it stopped")
    for name in ("variants", "fasta", "distribution", "model", "out"):
        run.add_argument(name)
    run.add_argument("--peaks")
    run.add_argument("--width", type=int, default=2114)
    run.add_argument("--buckets", type=int, default=model_jobs.BUCKETS)
    run = jobs.add_parser("predict", help="predictions of several folds' models, as -m NAME=module:function, repeated")
    for name in ("variants", "fasta", "out"):
        run.add_argument(name)
    run.add_argument("-m", "--model", action="append", required=True)
    run.add_argument("--width", type=int, default=2114)
    for name, about in (("regions", "build the region table of a gene model (GFF3)"), ("genes", "build the gene table of a gene model (GFF3)"), ("elements", "build the table of regulatory elements"), ("missense", "build the score table, partitioned by chromosome"), ("frequencies", "build the frequency table from variant files (Parquet)")):
        table = jobs.add_parser(name, help=about)
        table.add_argument("source")
        table.add_argument("out")
    return top


def _whole(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _arguments().parse_args(args)
    spark = spark or SparkSession.builder.appName("genoframe").getOrCreate()
    if a.job == "preprocess":
        pipelines.preprocess(spark, a.variants, a.fasta, spark.read.parquet(a.regions), a.out, tuple(a.categories), a.format, width=a.width, phenopacket=a.phenopacket)
    elif a.job == "annotate":
        tables = [spark.read.parquet(getattr(a, x)) for x in ("regions", "genes", "elements", "frequencies")]
        sinks.write_jsonl(pipelines.annotate(readers.read_variants(spark, a.variants), *tables), a.out)
    elif a.job == "summarize":
        sinks.write_tsv(pipelines.summarize_folds(spark, a.fold).orderBy(F.col("variant_id")), a.out, header=True)
    elif a.job == "lookup":
        rows, stats = pipelines.lookup_scores(spark, readers.read_variants(spark, a.variants), a.table)
        sinks.write_tsv(rows, a.out, header=True)
        print(json.dumps(stats))
    elif a.job == "export":
        models = json.loads(_whole(spark, a.models))
        pipelines.export_vcf(spark, a.vcf, a.buckets, models["models"] if isinstance(models, dict) else models, sinks.read_manifest(spark, a.manifest), a.out, a.prefix, not a.no_model_scores)
    elif a.job == "score":
        # one row of a thousand numbers and, if asked for, peaks
        name = model_jobs.mark(files=model_jobs.files_mark(spark, a.variants, a.fasta, a.distribution, *([a.peaks] if a.peaks else [])), model=a.model, width=a.width)
        peaks = readers.read_peaks(spark, a.peaks).withColumnRenamed("chr", "chrom") if a.peaks else None
        model_jobs.score_variants(readers.read_variants(spark, a.variants), readers.read_fasta_chunks(spark, a.fasta), model_jobs.loader(a.model), spark.read.parquet(a.distribution), a.out, name, peaks, a.width, buckets=a.buckets)
    elif a.job == "predict":
        models = dict(m.split("=", 1) for m in a.model)
        name = model_jobs.mark(files=model_jobs.files_mark(spark, a.variants, a.fasta), models=models, width=a.width)
        model_jobs.predict_folds(readers.read_variants(spark, a.variants), readers.read_fasta_chunks(spark, a.fasta), {k: model_jobs.loader(m) for k, m in models.items()}, a.out, name, a.width)
    elif a.job == "missense":
        sinks.write_hive(readers.read_missense(spark, a.source), a.out)
    elif a.job == "frequencies":
        pipelines.frequency_table(spark.read.parquet(a.source)).write.mode("overwrite").parquet(a.out)
    elif a.job == "elements":
        readers.read_ccre(spark, a.source).write.mode("overwrite").parquet(a.out)
    else:
        gff = readers.read_gff(spark, a.source)
        (regions.regions_of(gff) if a.job == "regions" else regions.genes_of(gff)).write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()

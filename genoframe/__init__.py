"""A PySpark-native engine for genomic variants: annotation, regions, lookups, prioritisation, jobs."""

from pyspark.sql import DataFrame

from genoframe.operators.prioritize import prioritize, top_model
from genoframe.operators.regions import annotate as annotate_regions
from genoframe.operators.regions import regions_of, route
from genoframe.operators.validate import validate
from genoframe.plans.jobs import attribute_variants, predict_folds, score_variants
from genoframe.plans.pipelines import annotate as annotate_variants
from genoframe.plans.pipelines import average_folds, export_vcf, lookup_scores, preprocess, prioritize_variants, score, summarize_folds
from genoframe.schemas import VARIANT

__version__ = "0.2.0"


def annotate_variant(chrom: str, pos: int, ref: str, alt: str, region_table: DataFrame, genes: DataFrame, elements: DataFrame, frequencies: DataFrame, variant_id: str | None = None) -> dict:
    """The annotation of one variant as a dictionary; many variants are better given to ``annotate_variants`` at once."""
    one = region_table.sparkSession.createDataFrame([(chrom, pos, ref, alt, variant_id)], VARIANT)
    return annotate_variants(one, region_table, genes, elements, frequencies).first().asDict(recursive=True)


__all__ = [
    "annotate_regions", "annotate_variant", "annotate_variants", "attribute_variants", "average_folds", "export_vcf", "lookup_scores", "predict_folds", "preprocess", "prioritize", "prioritize_variants",
    "regions_of", "route", "score", "score_variants", "summarize_folds", "top_model", "validate",
]

"""Fixed schemas of the data model."""

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split(":") for x in spec.split())])


#: Headerless variant table; pos is 1-based, variant_id may be null.
VARIANT = _struct("chr:s pos:l ref:s alt:s variant_id:s")
#: One row per record and alternate allele of an input.
OCCURRENCE = _struct("record_ordinal:l alt_index:i genome:s chr:s pos:l ref:s alt:s variant_id:s canonical_variant_id:s status:s error_code:s")
CANONICAL = _struct("canonical_variant_id:s genome:s chr:s pos:l ref:s alt:s")
INVALID = T.StructType([*OCCURRENCE.fields, T.StructField("error_message", T.StringType())])
REGION = _struct("chrom:s start:l end:l strand:s feature:s gene_id:s gene_name:s biotype:s")
NARROW_PEAK = _struct("chr:s start:l end:l name:s score:s strand:s signal:s p_value:s q_value:s summit_offset:l")
GFF = _struct("seqid:s source:s feature:s start:l end:l score:s strand:s phase:s attributes:s")
MISSENSE = _struct("CHROM:s POS:i REF:s ALT:s genome:s uniprot_id:s transcript_id:s protein_variant:s am_pathogenicity:d am_class:s")
CCRE = _struct("chrom:s start:l end:l accession:s registry:s grp:s")
FOLD_SCORE = _struct("variant_id:s counts_log2fc:d profile_l1:d")
CALL = T.StructType([T.StructField("gt", T.ArrayType(T.IntegerType())), T.StructField("phased", T.BooleanType()), T.StructField("ad", T.ArrayType(T.IntegerType())), T.StructField("dp", T.IntegerType()), T.StructField("gq", T.IntegerType())])

"""Schemas and the fixed names of directions and categories."""


GENES = "genome_id string, chrom string, gene_name string, feature string, start bigint, stop bigint, strand string, length bigint"
TES = "genome_id string, chrom string, start bigint, stop bigint, strand string, te_order string, superfamily string, length bigint"

LEFT, INTRA, RIGHT = "Left", "Intra", "Right"
UPSTREAM, DOWNSTREAM = "Upstream", "Downstream"
ORDER, SUPERFAMILY = "Order", "Superfamily"

#: Fixed names that revised annotations carry in the column that a union ignores; TOTAL stands for elements of any kind.
S_REVISION, O_REVISION, TOTAL = "S_Revision", "O_Revision", "All_Elements"

PRODUCTION_WINDOWS = range(500, 10_001, 500)

#: Schema of a stored density table; chromosomes are text, also where they look like numbers.
DENSITY = (
    "gene_name string, direction string, window bigint, strand string, divisor bigint, te_category string, te_name string, "
    "overlap_bp bigint, density double, genome_id string, chrom string"
)
REVISED = "te_order string, superfamily string, start bigint, stop bigint, strand string, length bigint, genome_id string, chrom string"

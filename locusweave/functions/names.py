"""Renaming of categories. Each renamer goes from DataFrame to DataFrame: tes.transform(rename_edta)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Three-letter codes of the common classification, and the names that results must carry.
CODES = {
    "RLC": "Copia", "RLG": "Gypsy", "RLB": "Bel_Pao", "RLR": "Retrovirus", "RLE": "ERV", "RYD": "DIRS", "RYN": "Ngaro", "RYV": "VIPER",
    "RPP": "Penelope", "RIR": "R2", "RIT": "RTE", "RIJ": "Jockey", "RIL": "L1", "RII": "I", "RST": "tRNA", "RSL": "7SL", "RSS": "5S",
    "DTT": "Tc1-Mariner", "DTA": "hAT", "DTM": "Mutator", "DTE": "Merlin", "DTR": "Transib", "DTP": "P", "DTB": "PiggyBac",
    "DTH": "PIF-Harbinger", "DTC": "CACTA", "DYC": "Crypton", "DHH": "Helitron", "DMM": "Maverick",
}
EDTA_ORDERS = {"Unknown": "Unknown_Order", "MITE": "TIR", "DNA": "TIR"}
EDTA_SUPERFAMILIES = CODES | {"unknown": "Unknown_Superfam", "Unknown": "Unknown_Superfam", "None": "Unknown_Superfam", "EnSpm_CACTA": "CACTA", "MuDR_Mutator": "Mutator", "PIF_Harbinger": "PIF-Harbinger"}
LEGACY_ORDERS = {"unknown": "Unknown_Order", "Unknown": "Unknown_Order", "MITE": "DNA", "RC?": "DNA", "RC": "DNA", "SINE?": "Unknown_Order", "tandem": "Tandem", "No_hits": "Unknown_Order", "pararetrovirus": "LTR", "mixture": "Mixture", "DNA": "TIR"}
LEGACY_SUPERFAMILIES = CODES | {"DTT": "Tc1_Mariner", "DTH": "PIF_Harbinger", "Uknown": "Unknown_SuperFam", "unknown": "Unknown_SuperFam", "Unknown": "Unknown_SuperFam", "EnSpm_CACTA": "CACTA"}
LEGACY_DROPPED = ("Simple_repeat", "long_terminal_repeat", "Maverick", "target_site_duplication")
HUMAN_DROPPED_ORDERS = ("snRNA", "tRNA", "rRNA", "srpRNA", "scRNA", "LTR?", "SINE?", "RC?", "DNA?", "RNA", "Low_complexity", "RC", "Satellite", "Simple_repeat")
HUMAN_DROPPED_SUPERFAMILIES = ("ERVL-maLR", "ERV1", "ERVL", "ERVK", "ERV1?", "ERVL?", "PiggyBac?", "Gypsy?", "TcMar?", "hAT?", "hAT-Tip100?", "DNA")
HELITRON, COMPLETELY_UNKNOWN = "Helitron", "Completely_Unknown"


def mapped(column: Column, mapping: dict[str, str]) -> Column:
    """One simultaneous pass: what a value maps to is not mapped again."""
    pairs = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.coalesce(F.try_element_at(pairs, column), column)


def _both(df: DataFrame, when: Column, value: str) -> DataFrame:
    """Sets both columns under one condition, which is evaluated once."""
    return df.withColumns({c: F.when(when, value).otherwise(F.col(c)) for c in ("te_order", "superfamily")})


def rename_edta(tes: DataFrame) -> DataFrame:
    """Names of EDTA annotations (plants)."""
    unknown = "Unknown_Superfam"
    df = tes.fillna(unknown, ["superfamily"]).withColumns(
        {"te_order": mapped(F.col("te_order"), EDTA_ORDERS), "superfamily": mapped(F.coalesce("superfamily", F.lit(unknown)), EDTA_SUPERFAMILIES)}
    )
    order, family = F.col("te_order"), F.col("superfamily")
    named = F.when(order == "pararetrovirus", "pararetrovirus")
    for name in ("LINE", "LTR", "TIR"):
        named = named.when((order == name) & (family == unknown), f"Unknown_{name}_Superfam")
    df = df.withColumn("superfamily", named.otherwise(family))
    df = _both(df, (order == "TIR") & (family == HELITRON), HELITRON)
    df = df.withColumn("superfamily", F.when((order == HELITRON) & (family == unknown), HELITRON).otherwise(family))
    return _both(df, (order == "Unknown_Order") & (family == unknown), COMPLETELY_UNKNOWN)


def rename_legacy(tes: DataFrame) -> DataFrame:
    """The older rules: tandem repeats and mixtures have names of their own, contigs and simple repeats go."""
    unknown = "Unknown_SuperFam"
    df = tes.withColumns({"te_order": mapped(F.col("te_order"), LEGACY_ORDERS), "superfamily": mapped(F.coalesce("superfamily", F.lit(unknown)), LEGACY_SUPERFAMILIES)})
    order, family = F.col("te_order"), F.col("superfamily")
    df = df.withColumn("superfamily", F.when(order == "Tandem", "Tandem").otherwise(family))
    df = df.where(~F.col("chrom").contains("##sequence-region") & ~F.col("chrom").rlike("contig*"))
    df = _both(df, (order == "Unknown_Order") & (family == unknown), COMPLETELY_UNKNOWN)
    df = df.withColumn("superfamily", F.when((order == HELITRON) & (family == unknown), HELITRON).otherwise(family))
    df = df.withColumn("te_order", F.when(family == HELITRON, HELITRON).otherwise(order))
    ltr = (order == "LTR") & ~F.coalesce(family.isin("Copia", "Gypsy"), F.lit(False))
    df = df.withColumn("superfamily", F.when(order == "Mixture", "Mixture").when(ltr, "Unknown_LTR_Superfam").otherwise(family))
    return df.where(~F.coalesce(order.isin(*LEGACY_DROPPED), F.lit(False)))


def rename_human(tes: DataFrame) -> DataFrame:
    """Names of RepeatMasker's human annotation; RNA, ERV and doubtful elements go."""
    order, family = F.col("te_order"), F.col("superfamily")
    df = tes.withColumn("te_order", F.when((order == "LINE") & (family == "Penelope"), "PLE").otherwise(order))
    gone = F.coalesce(order.isin(*HUMAN_DROPPED_ORDERS), F.lit(False)) | F.coalesce(family.isin(*HUMAN_DROPPED_SUPERFAMILIES), F.lit(False))
    return df.where(~gone).withColumn("te_order", F.when(order == "DNA", "TIR").otherwise(order))

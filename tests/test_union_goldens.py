"""Merged lengths of known annotations."""

import pytest

from locusweave.operators.union import interval_union, order_rows, superfamily_rows, total_rows

ROWS = {"superfamily": superfamily_rows, "te_order": order_rows, "all": total_rows}

#: What elements overlap like, what they are merged by, (start, stop, order, superfamily) of each, and the lengths of the merged ones by start.
KNOWN = [
    ("single", "superfamily", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4133, "LTR", "Copia"),
        (4209, 4761, "LTR", "Gypsy"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9556, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9675, 11249, "Completely_Unknown", "Completely_Unknown"),
        (11253, 11469, "Completely_Unknown", "Completely_Unknown"),
        (11450, 11886, "Completely_Unknown", "Completely_Unknown"),
        (12193, 12404, "TIR", "hAT"),
        (13625, 13774, "Completely_Unknown", "Completely_Unknown"),
        (13799, 13892, "TIR", "Mutator"),
        (13892, 14156, "Helitron", "Helitron"),
        (14154, 15323, "Helitron", "Helitron"),
        (15397, 16343, "LTR", "Unknown_LTR_Superfam"),
        (16344, 16966, "LTR", "Gypsy"),
        (17033, 17209, "Completely_Unknown", "Completely_Unknown"),
        (20215, 20599, "TIR", "hAT"),
        (20236, 20464, "LTR", "Unknown_LTR_Superfam"),
        (20465, 20899, "LTR", "Unknown_LTR_Superfam"),
        (20880, 22846, "LTR", "Unknown_LTR_Superfam"),
        (23216, 23346, "Completely_Unknown", "Completely_Unknown"),
        (23271, 23459, "TIR", "Mutator"),
        (23456, 24419, "TIR", "CACTA"),
        (24415, 24625, "TIR", "CACTA"),
        (24000, 24500, "DNA", "MULE"),
        (24200, 24550, "LTR", "Copia"),
    ], [784, 1021, 912, 1694, 634, 212, 150, 94, 1432, 947, 623, 177, 385, 229, 2382, 131, 189, 1170, 501, 351]),
    ("several", "superfamily", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4215, "LTR", "Copia"),
        (4209, 4761, "LTR", "Copia"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9256, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9678, 11249, "Completely_Unknown", "Completely_Unknown"),
        (11248, 11469, "Completely_Unknown", "Completely_Unknown"),
        (11450, 11886, "Completely_Unknown", "Completely_Unknown"),
        (12193, 12404, "TIR", "hAT"),
        (13625, 13774, "Completely_Unknown", "Completely_Unknown"),
        (13799, 13892, "TIR", "Mutator"),
        (13892, 14156, "Helitron", "Helitron"),
        (14154, 15323, "Helitron", "Helitron"),
        (15320, 16343, "Helitron", "Helitron"),
        (16344, 16966, "LTR", "Gypsy"),
        (17033, 17209, "Completely_Unknown", "Completely_Unknown"),
        (20215, 20599, "TIR", "hAT"),
        (20236, 20466, "LTR", "Unknown_LTR_Superfam"),
        (20465, 20899, "LTR", "Unknown_LTR_Superfam"),
        (20880, 22846, "LTR", "Unknown_LTR_Superfam"),
        (23216, 23346, "Completely_Unknown", "Completely_Unknown"),
        (23271, 23459, "TIR", "Mutator"),
        (23456, 24419, "TIR", "CACTA"),
        (24415, 24625, "TIR", "CACTA"),
        (24000, 24500, "DNA", "MULE"),
        (24200, 24550, "LTR", "Copia"),
    ], [1412, 560, 1219, 2209, 212, 150, 94, 2452, 623, 177, 385, 2611, 131, 189, 1170, 501, 351]),
    ("same start", "superfamily", [
        (3350, 3957, "LTR", "Copia"),
        (3350, 3957, "LTR", "Copia"),
        (4209, 4761, "LTR", "Gypsy"),
        (4761, 5000, "LTR", "Gypsy"),
        (12100, 12300, "TIR", "hAT"),
        (12150, 12200, "TIR", "hAT"),
    ], [608, 792, 201]),
    ("single", "te_order", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4133, "LTR", "Gypsy"),
        (4209, 4761, "LTR", "Copia"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9556, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9675, 11249, "Completely_Unknown", "Completely_Unknown"),
        (23456, 24419, "TIR", "CACTA"),
        (24415, 24625, "TIR", "Test"),
        (24000, 24500, "DNA", "MULE"),
        (24200, 24550, "LTR", "Copia"),
    ], [784, 1021, 912, 1694, 1170, 501, 351]),
    ("several", "te_order", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4215, "LTR", "Copia"),
        (4209, 4761, "LTR", "Copia"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9256, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9700, 10000, "TIR", "hAT"),
        (9678, 11249, "Completely_Unknown", "Completely_Unknown"),
        (11248, 11469, "Completely_Unknown", "Completely_Unknown"),
        (11450, 11886, "Completely_Unknown", "Completely_Unknown"),
        (12193, 12404, "TIR", "hAT"),
        (13625, 13774, "Completely_Unknown", "Completely_Unknown"),
        (13799, 13892, "TIR", "Mutator"),
        (13892, 14156, "Helitron", "Helitron"),
        (14154, 15323, "Helitron", "Helitron"),
        (15320, 16343, "Helitron", "Helitron"),
        (20236, 20466, "LTR", "Copia"),
        (20465, 20899, "LTR", "Unknown_LTR_Superfam"),
        (20880, 22846, "LTR", "Gypsy"),
    ], [1880, 1219, 2209, 301, 212, 150, 94, 2452, 2611]),
    ("same start", "te_order", [
        (3350, 3957, "LTR", "Copia"),
        (3350, 3957, "LTR", "Gypsy"),
        (4209, 4761, "LTR", "Gypsy"),
        (4761, 5000, "LTR", "Copia"),
        (12100, 12300, "TIR", "hAT"),
        (12150, 12200, "TIR", "hAT"),
    ], [608, 792, 201]),
    ("single", "all", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4133, "DNA", "Hat"),
        (4209, 4761, "LTR", "Copia"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9556, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9675, 11249, "Completely_Unknown", "Completely_Unknown"),
        (23456, 24419, "TIR", "CACTA"),
        (24415, 24625, "LTR", "Copia"),
        (27000, 27500, "DNA", "MULE"),
        (27200, 27550, "LTR", "Copia"),
    ], [784, 1021, 912, 1694, 1170, 551]),
    ("several", "all", [
        (3350, 3957, "LTR", "Copia"),
        (3795, 4215, "LTR", "Copia"),
        (4209, 4761, "LTR", "Copia"),
        (4670, 5229, "LTR", "Gypsy"),
        (8459, 9266, "Completely_Unknown", "Completely_Unknown"),
        (8794, 9370, "Completely_Unknown", "Completely_Unknown"),
        (9256, 9677, "Completely_Unknown", "Completely_Unknown"),
        (9678, 11249, "Completely_Unknown", "Completely_Unknown"),
        (9700, 10000, "TIR", "hAT"),
        (11248, 11469, "Completely_Unknown", "Completely_Unknown"),
        (11450, 11886, "Completely_Unknown", "Completely_Unknown"),
        (12193, 12404, "TIR", "hAT"),
        (13625, 13774, "Completely_Unknown", "Completely_Unknown"),
        (13799, 13892, "TIR", "Mutator"),
        (13890, 14156, "Helitron", "Helitron"),
        (14154, 15323, "Helitron", "Helitron"),
        (15320, 16343, "Helitron", "Helitron"),
        (20236, 20466, "LTR", "Copia"),
        (20465, 20899, "LTR", "Unknown_LTR_Superfam"),
        (20880, 22846, "LTR", "Gypsy"),
    ], [1880, 1219, 2209, 212, 150, 2545, 2611]),
    ("same start", "all", [
        (3350, 3957, "LTR", "Copia"),
        (3350, 3957, "LTR", "Gypsy"),
        (4209, 4761, "LTR", "Gypsy"),
        (4761, 5000, "DNA", "TIR"),
        (12100, 12300, "TIR", "hAT"),
        (12150, 12200, "DNA", "MITE"),
    ], [608, 792, 201]),
]


@pytest.mark.parametrize("stretch", [500, 1 << 22])
@pytest.mark.parametrize("times", [1, 3])
def test_known_unions(spark, stretch, times):
    for _, by, elements, lengths in KNOWN:
        tes = spark.createDataFrame([("c", a, b, "+", o, f) for a, b, o, f in elements] * times, "chrom string, start long, stop long, strand string, te_order string, superfamily string")
        got = interval_union(ROWS[by](tes), ["chrom", "te_order", "superfamily"], stretch).collect()
        assert [r["length"] for r in sorted(got, key=lambda r: (r["start"], r["stop"]))] == lengths

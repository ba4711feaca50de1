"""Column expressions shared by the operators. All stay in generated code: no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alignment flag bits of the SAM format.
PAIRED = 0x0001
PROPER_PAIR = 0x0002
UNMAPPED = 0x0004
MATE_UNMAPPED = 0x0008
REVERSE = 0x0010
MATE_REVERSE = 0x0020
FIRST_IN_PAIR = 0x0040
SECOND_IN_PAIR = 0x0080
SECONDARY = 0x0100
QC_FAILED = 0x0200
DUPLICATE = 0x0400

# Fixed values: (bit, text when set, text when clear) of the readable flag form.
FLAG_LETTERS = [
    (PAIRED, "_P", "_p"),
    (PROPER_PAIR, "_M", "_m"),
    (UNMAPPED, "_u", "_."),
    (MATE_UNMAPPED, "_U", "_."),
    (REVERSE, "_r", "_."),
    (MATE_REVERSE, "_R", "_."),
    (FIRST_IN_PAIR, "_1", "_."),
    (SECOND_IN_PAIR, "_2", "_."),
    (SECONDARY, "_s", "_S"),
    (QC_FAILED, "_f", "_F"),
    (DUPLICATE, "_d", "_D"),
]

# Sums of fractions are taken in this type, so that the result does not depend on the order in which
# partitions arrive.
EXACT = "decimal(38,12)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_is(flag: Column | str, bit: int) -> Column:
    return col(flag).bitwiseAND(F.lit(bit)) != 0


def flag_string(flag: Column | str) -> Column:
    return F.concat(*[F.when(flag_is(flag, bit), on).otherwise(off) for bit, on, off in FLAG_LETTERS])


def extract_tag(c: Column | str, tag: str, pattern: str = r"\d+") -> Column:
    """Value of `tag|value` inside an identifier; null when the tag is missing."""
    found = F.regexp_extract(col(c), tag + r"\|(" + pattern + ")", 1)
    return F.when(found != "", found)


def contig_of(gene: Column | str) -> Column:
    """Contig id of a gene id: drop a trailing `_n`, or else a trailing `.n`."""
    gene = col(gene)
    return F.when(gene.rlike(r"_\d+$"), F.regexp_replace(gene, r"_\d+$", "")).otherwise(
        F.regexp_replace(gene, r"\.\d+$", ""))


def orf_info(header: Column | str) -> Column:
    """struct(start, end, frame) from either gene-caller header dialect; `-` when there is none."""
    header = col(header)
    dialects = [r"/start=(\d+)\s+/end=(\d+)\s+/frame=(\S+)", r"\s# (\d+) # (\d+) # (\S+) # ID"]

    def part(group: int) -> Column:
        tries = [F.nullif(F.regexp_extract(header, d, group), F.lit("")) for d in dialects]
        return F.coalesce(*tries, F.lit("-"))

    return F.struct(part(1).alias("start"), part(2).alias("end"), part(3).alias("frame"))


def header_depth(header: Column | str) -> Column:
    """Depth stamped into an assembly header as `_cov_X`; null when absent."""
    found = F.regexp_extract(col(header), r"_cov_([\d.]+)", 1)
    return F.when(found != "", found.cast("double"))


def trunc_to(c: Column | str, digits: int) -> Column:
    """Cut (not round) after `digits` decimals."""
    scale = 10 ** digits
    return (col(c) * scale).cast("long") / F.lit(float(scale))


def exact_sum(c: Column) -> Column:
    return F.sum(c.cast(EXACT))


def expected_breadth(depth: Column | str) -> Column:
    """Share of a genome expected to be covered at a depth, reads falling at random."""
    return 1 - F.exp(-col(depth))


def overlap(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """End minus begin of the common part: 0 for disjoint intervals, negative for a reversed one inside another."""
    return F.when((e2 < b1) | (b2 > e1), F.lit(0)).otherwise(F.least(e1, e2) - F.greatest(b1, b2))


def index_quartiles(values: Column) -> Column:
    """struct(med, low_quartile, high_quartile) picked by index from a sorted array."""
    n = F.size(values)
    upper = F.element_at(values, (F.floor(n / 2) + 1).cast("int"))
    lower = F.element_at(values, F.greatest(F.floor(n / 2), F.lit(1)).cast("int"))
    quarter = F.floor(n / 4).cast("int")
    return F.struct(
        F.when(n % 2 == 0, (upper + lower) / 2).otherwise(upper).alias("med"),
        F.element_at(values, quarter + 1).alias("low_quartile"),
        F.element_at(values, n - quarter).alias("high_quartile"),
    )


def without_space(c: Column | str) -> Column:
    """Drop ASCII white space (line breaks inside wrapped sequences included)."""
    return F.translate(col(c), " \t\n\r\f\x0b", "")

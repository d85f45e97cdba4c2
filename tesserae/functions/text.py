"""Column functions on sample names, protocols, barcodes, genes and labels. All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: suffixes that stages append to a sample's name
STAGE_SUFFIX = "(?:_(?:harmonized_filtered|harmonized|filtered|with_doublet_calls|singlets))+$"
# fixed values: spellings of a missing label
MISSING = ("", "nan", "none", "na", "null", "unassigned", "unknown", "<na>")
# fixed values: spellings of true
TRUTHY = ("1", "true", "t", "yes", "y", "on")


def canonical_sample(name: Column) -> Column:
    """Lower-cased, trimmed name without ``.rds`` and without any run of stage suffixes (stripped to a fixpoint)."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\.rds$", ""), STAGE_SUFFIX, "")


def parse_protocol(text: Column) -> Column:
    """struct(platform, chemistry) of a protocol text.

    Drop-seq and PIPseq have no chemistry; 10x is 5p, or its version (v3.1 counts as v3, v1 as v2), or v3 by default;
    any other text is its own platform.
    """
    s = F.lower(F.trim(text))
    version = F.regexp_extract(s, r"v[0-9]+(?:\.[0-9]+)?", 0)
    tenx = (
        F.when(s.rlike(r"_5($|[_'])"), "5p")
        .when(version == "v3.1", "v3")
        .when(version == "v1", "v2")
        .when(version != "", version)
        .otherwise("v3")
    )
    platform = F.when(s.rlike("drop.?seq"), "dropseq").when(s.contains("pipseq"), "pipseq").when(s.startswith("10x"), "10x").otherwise(s)
    return F.struct(platform.alias("platform"), F.when((platform == "10x") & s.startswith("10x"), tenx).alias("chemistry"))


def strip_barcode(barcode: Column) -> Column:
    """Barcode without its ``-N`` suffix."""
    return F.regexp_replace(barcode, "-[0-9]+$", "")


def bare_barcode(barcode: Column) -> Column:
    """The token after the last underscore, without ``-N``."""
    return F.substring_index(strip_barcode(barcode), "_", -1)


def gene_key(gene: Column) -> Column:
    """Gene name for tolerant matching: upper-case without ``-``, ``_`` and ``.``."""
    return F.upper(F.regexp_replace(gene, "[-_.]", ""))


def is_missing(label: Column) -> Column:
    """Whether a label is null or spells a missing value."""
    return label.isNull() | F.lower(F.trim(label)).isin(*MISSING)


def or_unknown(value: Column) -> Column:
    """Trimmed text, blank and null as ``Unknown``."""
    return F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit("Unknown"))


def parse_bool(text: Column, default: bool = False) -> Column:
    s = F.lower(F.trim(text))
    return F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(s.isin(*TRUTHY))


def parse_number(text: Column, default: float | None = None) -> Column:
    return F.coalesce(F.expr("try_cast(null as double)") if text is None else text.try_cast("double"), F.lit(default).cast("double"))


def resolution_tag(resolution: Column) -> Column:
    """Column suffix of a resolution: 0.4 -> ``0.4``, 1 -> ``1.0``."""
    return F.format_string("%.1f", resolution.cast("double"))


def safe_label(label: Column) -> Column:
    """Text as a file name: all but letters, digits, ``_`` and ``-`` become ``_``."""
    return F.regexp_replace(label, "[^A-Za-z0-9_-]", "_")


def study_short_name(name: Column) -> Column:
    """Canonical name without a leading ``study_``, ``dataset_`` or ``sample_``."""
    return F.regexp_replace(canonical_sample(name), "^(?:study|dataset|sample)_", "")


def plot_title(column: Column) -> Column:
    """Readable title of a label column: ``Level_2_res_0.6`` -> ``Level 2 (resolution 0.6)``."""
    level, res = F.regexp_extract(column, r"(?i)level_(\d+)", 1), F.regexp_extract(column, r"res_?([0-9.]+)$", 1)
    title = F.when(level != "", F.concat(F.lit("Level "), level)).otherwise(F.regexp_replace(F.regexp_replace(column, r"_?res_?[0-9.]+$", ""), "_", " "))
    return F.when(res != "", F.concat(title, F.lit(" (resolution "), res, F.lit(")"))).otherwise(title)


def lookup_color(label: Column, palette: dict[str, str], fallback: str = "#BBBBBB") -> Column:
    """Colour of a label as it is, with spaces as underscores, or the reverse."""
    if not palette:
        return F.lit(fallback)
    colors = F.create_map(*(F.lit(x) for kv in sorted(palette.items()) for x in kv))
    return F.coalesce(F.try_element_at(colors, label), F.try_element_at(colors, F.replace(label, F.lit(" "), F.lit("_"))), F.try_element_at(colors, F.replace(label, F.lit("_"), F.lit(" "))), F.lit(fallback))


def clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def first_dims(vector: Column, n: int = 30) -> Column:
    """The first ``n`` components of an embedding."""
    return F.slice(vector, 1, n)


def params_digest(*params: Column) -> Column:
    """SHA-256 of a parameter struct, to tell whether an output is of the same run."""
    return F.sha2(F.to_json(F.struct(*params)), 256)


def stamp(when: Column | None = None) -> Column:
    """Time as it stands in file names, ``20240131_235959``; now, if none is given."""
    return F.date_format(F.current_timestamp() if when is None else when, "yyyyMMdd_HHmmss")


def parse_list(text: str | None) -> list[str]:
    """Trimmed values between commas; none of a blank text."""
    return [p.strip() for p in text.split(",")] if text and text.strip() else []


def parse_resolutions(value: object, default: tuple[float, ...] = (0.4, 0.6, 1.0)) -> list[float]:
    """Resolutions of a configuration: a number, a list, or a text with commas or semicolons; none gives the default."""
    if value is None:
        return list(default)
    if isinstance(value, str):
        found = [float(p) for p in parse_list(value.replace(";", ",")) if p]
        if not found:
            raise ValueError("no resolutions configured")
        return found
    return [float(v) for v in value] if isinstance(value, (list, tuple)) else [float(value)]


def parse_dims(text: object) -> list[int]:
    """Dimensions ``a:b`` (both ends, either way) or a list with commas."""
    t = str(text).strip()
    if ":" not in t:
        return [int(p) for p in t.split(",")]
    ends = t.split(":")
    if len(ends) != 2:
        raise ValueError(f"invalid dimensions: {t}")
    a, b = map(int, ends)
    return list(range(a, b + 1)) if a <= b else list(range(a, b - 1, -1))

"""Scalar column functions: tolerant casts, text rules, hashes and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- casts and text normalisation ------------------------------------------------------------

#: Texts that only say that nothing is known. Fixed values.
EMPTYISH = ("", "-", "unknown", "na", "none", "not collected", "not provided", "missing")


def as_int(c: Column) -> Column:
    """Integer or null; numbers stored as text, with or without a fraction, are accepted."""
    return F.trim(c.cast("string")).try_cast("double").try_cast("int")


def as_float(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def first_present(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns))


def meaningful(c: Column) -> Column:
    """The value, or null where it only says that nothing is known."""
    return F.when(~F.lower(F.trim(c)).isin(*EMPTYISH), F.trim(c))


def normal_header(name: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normal_locus(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def slug(c: Column, size: int = 60) -> Column:
    return F.substring(F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-")), 1, size)


def split_list(c: Column, separators: str = r"[,|]") -> Column:
    """Array of a text list's items; a lone dash means none."""
    return F.filter(F.transform(F.split(c, separators), lambda x: F.trim(x)), lambda x: ~x.isin("", "-"))


def numeric_references(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[,;\s]+"), lambda x: x.rlike(r"^\d+$"))


# -- text rules (patterns are fixed values) --------------------------------------------------

UNCHARACTERISED = r"(?i)hypothetical|uncharacteri[sz]ed|putative|unknown function|unnamed|\bDUF\d+|protein of unknown|predicted protein"
SURFACE = r"(?i)membrane|outer membrane|secreted|surface|\bpil|adhesin|inclusion membrane|lipoprotein"
LOCALISATIONS = (
    (r"extracellular|secreted|cell surface|host cell surface", "extracellular"),
    (r"cell ?wall|peptidoglycan", "cell wall"),
    (r"outer ?membrane", "outer membrane"),
    (r"periplasm", "periplasm"),
    (r"(cytoplasmic|inner|plasma|cell) ?membrane|membrane", "cytoplasmic membrane"),
    (r"cytoplasm|cytosol", "cytoplasm"),
)
SPECIALTY_TYPES = (
    ("virul", "virulence"), ("antibiotic resistance", "amr"), ("drug target", "drug_target"),
    ("transporter", "transporter"), ("essential", "essential"), ("human homolog", "human_homolog"),
)


def matches(c: Column, pattern: str) -> Column:
    """True, false for no match, and false for null: an absent text matches nothing."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def first_rule(c: Column, rules, otherwise: Column) -> Column:
    """The value of the first rule whose pattern is found in the lower-cased text."""
    chain = None
    for pattern, value in rules:
        test = F.lower(c).rlike(pattern)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(otherwise)


def localisation(c: Column) -> Column:
    return first_rule(F.coalesce(c, F.lit("")), LOCALISATIONS, F.lit(""))


def specialty_type(c: Column) -> Column:
    return first_rule(F.coalesce(c, F.lit("")), SPECIALTY_TYPES, F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("other")))


def all_rules(c: Column, rules) -> Column:
    """Names of all rules that match, in the rules' order."""
    return F.filter(F.array(*(F.when(matches(c, pattern), name) for name, pattern in rules)), lambda x: x.isNotNull())


def organism_key(c: Column) -> Column:
    """Struct (genus, species): lower case, without strain detail; ``sp`` is skipped."""
    words = F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"[\s_]+"), lambda x: x != "")
    clean = lambda x: F.regexp_replace(F.lower(x), r"[.,]+$", "")
    second = clean(F.get(words, 1))
    skips = second.isin("sp", "subsp") & (F.size(words) > 2)
    return F.struct(F.coalesce(clean(F.get(words, 0)), F.lit("")).alias("genus"), F.coalesce(F.when(skips, clean(F.get(words, 2))).otherwise(second), F.lit("")).alias("species"))


def same_genus(a: Column, b: Column, ratio: float = 0.75, least: int = 6) -> Column:
    """One name, or a renaming that keeps most of the stem."""
    shorter = F.least(F.length(a), F.length(b))
    shared = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), shorter)), lambda i: F.left(a, i) == F.left(b, i)))
    renamed = (shared >= least) & (shared >= ratio * shorter)
    return (F.length(a) > 0) & (F.length(b) > 0) & ((a == b) | renamed)


def fixed(c: Column, digits: int) -> Column:
    """A number's text with so many digits after the point, at most 8, as C and Python print it: the
    nearest of the double's exact value, a true tie to the even digit. ``format_string`` rounds the
    shortest text of the double instead, halves up: 137.45 lies below its text."""
    size = F.abs(c)
    whole = F.floor(size)
    # The fraction in two parts of 40 bits, so that ten times either is exact.
    base, part = 2**40, F.lit(2**40 - 1)
    scaled = (size - whole) * float(base)
    high = F.floor(scaled)
    low = F.floor((scaled - high) * float(base))
    shown = F.lit(0).cast("long")
    for _ in range(digits):
        high, low = high * 10 + F.shiftright(low * 10, 40), (low * 10).bitwiseAND(part)
        shown, high = shown * 10 + F.shiftright(high, 40), high.bitwiseAND(part)
    last = shown if digits else whole
    up = (high > base // 2) | ((high == base // 2) & ((low > 0) | (last % 2 == 1)))
    shown = shown + up.cast("long")
    carried = F.when(shown >= 10**digits, 1).otherwise(0) if digits else shown
    text = (whole + carried).cast("string")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((shown % 10**digits).cast("string"), digits, "0"))
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")
    # From 2**53 on there are no fractions.
    return F.when(size >= 2.0**53, F.format_string(f"%.{digits}f", c)).otherwise(F.concat(sign, text))


# -- hashes ----------------------------------------------------------------------------------

_CRC64_POLYNOMIAL = 0xD800000000000000


def _crc64_entry(byte: int) -> int:
    for _ in range(8):
        byte = (byte >> 1) ^ (_CRC64_POLYNOMIAL if byte & 1 else 0)
    return byte - 2**64 if byte >= 2**63 else byte


def crc64_hex(c: Column) -> Column:
    """CRC-64 (ISO, reflected) of the trimmed, upper-cased ASCII text, as 16 hex digits."""
    table = F.array(*(F.lit(_crc64_entry(b)).cast("long") for b in range(256)))
    letters = F.filter(F.split(F.upper(F.trim(c)), ""), lambda x: (x != "") & (F.ascii(x) < 128))
    step = lambda crc, x: F.get(table, (crc.bitwiseXOR(F.ascii(x).cast("long"))).bitwiseAND(F.lit(255)).cast("int")).bitwiseXOR(F.shiftrightunsigned(crc, 8))
    return F.lpad(F.hex(F.aggregate(letters, F.lit(0).cast("long"), step)), 16, "0")


def sequence_key(c: Column) -> Column:
    return F.sha2(c, 256)


# -- scores ----------------------------------------------------------------------------------

#: Gates and bonuses of a hit. Fixed values.
MAX_EVALUE, MIN_COVERAGE = 1e-5, 0.5
LIGAND_BONUS, PARTNER_BONUS, ANNOTATION_BONUS = 0.10, 0.05, 0.05
MAX_HIT_SCORE = 1.0 + LIGAND_BONUS + PARTNER_BONUS + ANNOTATION_BONUS


def coverage(begin: Column, end: Column, length: Column) -> Column:
    """Share of the query that an alignment spans, within [0, 1]; 0 without a length."""
    return F.when(length > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (end - begin + 1) / length))).otherwise(0.0)


def hit_qualifies(evalue: Column, covered: Column) -> Column:
    return F.coalesce((evalue <= MAX_EVALUE) & (covered >= MIN_COVERAGE), F.lit(False))


def structure_quality(method: Column, resolution: Column) -> Column:
    named = F.upper(F.coalesce(method, F.lit("")))
    solved = named.contains("X-RAY") | named.contains("ELECTRON MICROSCOPY") | (named == "EM")
    by_resolution = F.when(resolution <= 2.5, 1.0).when(resolution <= 3.5, 0.8).otherwise(0.6)
    return F.when(named.contains("NMR"), 0.7).when(solved, by_resolution).otherwise(0.6)


def confidence_band(plddt: Column) -> Column:
    return F.when(plddt >= 90, "very high").when(plddt >= 70, "confident").when(plddt >= 50, "low").when(plddt.isNotNull(), "very low").otherwise("")


def weighted(components: dict[str, Column], weights: dict[str, float], digits: int = 6) -> Column:
    """Sum of weight times component, absent components counting nothing."""
    total = sum((F.coalesce(components[name], F.lit(0.0)) * F.lit(w) for name, w in weights.items()), F.lit(0.0))
    return F.round(total, digits)


def literature_bonus(n: Column) -> Column:
    return F.least(F.lit(2.0), F.log10(F.coalesce(n, F.lit(0)) + 1))


def distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b)), F.lit(0.0)))


def jaccard_distance(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, 1 - F.size(F.array_intersect(a, b)) / union).otherwise(0.0)

"""Text rules that classify products, targets, genomes and atoms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basalt.functions.scalar import fixed, matches, meaningful

#: Host-interaction categories in reporting order, each with its product pattern. Fixed values.
MECHANISMS = (
    ("adhesion", r"(?i)adhesin|adhes|fimbri|\bpil[iu]s?\b|curli|\bmomp\b|major outer membrane|omcb|autotransporter|hemagglutinin|invasin"),
    ("invasion", r"(?i)invasion|internalin|intimin|\bactin\b|endocyt|host cell entry|cell entry"),
    ("secretion", r"(?i)secretion system|type\s*(iii|iv|vi|3|4|6)\b|t[346]ss|effector|translocon|inclusion membrane|\binc[a-z]?\b\s|chaperone"),
    ("toxin", r"(?i)toxin|enterotoxin|hemolys|haemolys|cytolys|leukocidin|phospholipase|pore-forming|cytotox"),
    ("immune_evasion", r"(?i)complement|serum resist|immune evasion|capsul|phase variation|superoxide dismutase|catalase|macrophage"),
    ("iron", r"(?i)siderophore|iron acquisition|aerobactin|enterobactin|yersiniabactin|ferric|ferrous|\btonb\b|heme|iron[ -]?abc"),
    ("motility", r"(?i)flagell|motility|chemotaxis|\bmot[ab]\b|\bfli[a-z]\b|\bflh[a-z]\b"),
    ("degradation", r"(?i)urease|collagenase|hyaluronidase|protease|elastase|mucinase|neuraminidase|sialidase"),
    ("regulation", r"(?i)virulence.*regulat|regulat.*virulence|\bphop\b|\bphoq\b|\bbvga?s?\b|\bagr[abcd]?\b|quorum.sensing|\blux[ir]\b|\btox[rst]\b|\bvirf\b|\blcrf\b"),
)
#: Parts of curated classifications and the category each stands for. Fixed values.
CLASS_CATEGORIES = (
    ("effector delivery", "secretion"), ("secretion", "secretion"), ("adher", "adhesion"), ("invasi", "invasion"), ("motil", "motility"), ("toxin", "toxin"),
    ("immune", "immune_evasion"), ("antiphagocy", "immune_evasion"), ("nutritional", "iron"), ("iron", "iron"), ("stress", "immune_evasion"),
    ("regulation", "regulation"), ("exoenzyme", "degradation"),
)
#: Regulators that count only beside other virulence evidence, products that act in
#: pathogenesis, and targets whose name says nothing. Fixed values.
GENERIC_REGULATOR = r"(?i)two-component|response regulator|transcriptional regulator"
PATHOGENESIS = (
    r"(?i)invasin|invasion|internalin|intimin|adhesin|adhes|fimbri|pili|pilus|curli|flagell|motility|hemolys|haemolys|cytolys|leukocidin|toxin|enterotoxin|"
    r"secretion system|type\s*(iii|iv|vi|3|4|6)\b|t[346]ss|effector|translocon|actin|invasi|phospholipase|siderophore|iron acquisition|aerobactin|enterobactin|"
    r"yersiniabactin|capsul|host cell|coloniz|autotransporter|complement|serum resist|immune evasion|urease|collagenase|hyaluronidase"
)
UNINFORMATIVE = r"(?i)hypothetical|uncharacteri[sz]ed|unknown function|\bDUF\d+|putative protein|structural genomics|protein of unknown"
#: Aromatic ring atoms by residue, and atom types of the other elements. Fixed values.
RING_ATOMS = {
    "PHE": ("CG", "CD1", "CD2", "CE1", "CE2", "CZ"), "TYR": ("CG", "CD1", "CD2", "CE1", "CE2", "CZ"), "HIS": ("CG", "CD2", "CE1"),
    "TRP": ("CG", "CD1", "CD2", "CE2", "CE3", "CZ2", "CZ3", "CH2"),
}
ATOM_TYPES = {"O": "OA", "S": "SA", "H": "HD", "P": "P"}


def _holding(part: str):
    return lambda x: F.coalesce(x.contains(part), F.lit(False))


def mechanisms(product: Column, classes: Column | None = None, virulence: Column | None = None) -> Column:
    """Array of categories in reporting order: by the product's text, by curated classes, and a
    generic regulator where the protein is known as a virulence factor."""
    said = F.transform(F.coalesce(classes, F.array().cast("array<string>")), F.lower) if classes is not None else None

    def named(category: str, pattern: str) -> Column:
        test = matches(product, pattern)
        if said is not None:
            for part, meant in CLASS_CATEGORIES:
                if meant == category:
                    test = test | F.exists(said, _holding(part))
        if category == "regulation" and virulence is not None:
            test = test | (F.coalesce(virulence, F.lit(False)) & matches(product, GENERIC_REGULATOR))
        return F.when(test, category)

    return F.filter(F.array(*(named(c, p) for c, p in MECHANISMS)), lambda x: x.isNotNull())


def acts_in_pathogenesis(product: Column) -> Column:
    return matches(product, PATHOGENESIS)


def informative(description: Column) -> Column:
    """Whether a target's own name says anything about function."""
    return (F.trim(F.coalesce(description, F.lit(""))) != "") & ~matches(description, UNINFORMATIVE)


def poor_genome(quality: Column, flags: Column) -> Column:
    """Poor by word, or flagged for anything at all."""
    return (F.lower(F.trim(F.coalesce(quality, F.lit("")))) == "poor") | (F.size(F.coalesce(flags, F.array().cast("array<string>"))) > 0)


def organism_of(defline: Column) -> Column:
    """``Genus species`` of a header: a capitalised genus and a lower-case epithet, or null."""
    return F.nullif(F.regexp_extract(defline, r"\b([A-Z][a-z]+ [a-z]{3,})\b", 1), F.lit(""))


def percent(share: Column) -> Column:
    """A share as whole per cent; a dash where nothing is known."""
    return F.when(share.isNotNull(), F.concat(fixed(share.cast("double") * 100, 0), F.lit("%"))).otherwise("—")


def atom_type(name: Column, residue: Column, element: Column) -> Column:
    """Docking type of a receptor atom: aromatic carbon, accepting nitrogen, and the rest."""
    ring = F.lit(False)
    for where, atoms in RING_ATOMS.items():
        ring = ring | ((residue == where) & name.isin(*atoms))
    typed = F.when(element == "C", F.when(ring, "A").otherwise("C")).when(element == "N", F.when((residue == "HIS") & name.isin("ND1", "NE2"), "NA").otherwise("N"))
    for letter, kind in ATOM_TYPES.items():
        typed = typed.when(element == letter, kind)
    return typed.otherwise(F.coalesce(F.nullif(element, F.lit("")), F.lit("C")))


def growth_row(own: Column, typical: Column, genomes: Column, label: str = "this genome") -> Column:
    """Struct (value, source): the genome's own value, else what most of its species have, told
    apart by the source; null where neither says anything."""
    mine = F.when(meaningful(own).isNotNull(), F.struct(own.alias("value"), F.lit(label).alias("source")))
    common = F.when(typical.isNotNull(), F.struct(typical.alias("value"), F.concat(F.lit("species-typical ("), genomes.cast("string"), F.lit(" genomes)")).alias("source")))
    return F.coalesce(mine, common)

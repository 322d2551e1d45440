"""Primer sets, amplicon length ranges, labels and read columns."""

from __future__ import annotations

from dataclasses import dataclass

# Primers (5'-3'), amplicon length ranges, label order, read columns.
PRIMERS = {
    "CHERIF": {"forwards": ["GCGGTAATTCCAGCTCCA"], "reverses": ["CACTCAATTAAGCGCACACG"]},
    "CARPIO": {"forwards": ["GGTGGGTTTCAGTAGACAATGC"], "reverses": ["GGCGGCAATAACAAATGGTAGT"]},
    "GOZLAN": {
        "forwards": ["AATCGTATGACATTTTGTCGAC", "CAGGGCTTTTTAAGTCTT"],
        "reverses": ["GAAGTCACAGGCGATTCGG", "TGATGGAGTCATAGAATTAACATCC"],
    },
    "PARVA": {"forwards": ["CGAGCCAAATAACAGAGGGT"], "reverses": ["CAGGCGAGGCTTATGTTTGC"]},
}
RANGES = {"CHERIF": (150, 160), "CARPIO": (70, 85), "GOZLAN": (580, 1120), "PARVA": (140, 155)}
LABELS = (
    "Anurofeca_richardsi",
    "Dermocystidium_salmonis",
    "Ichthyophonus_hoferi",
    "Pseudoperkinsus_tapetis",
    "Psorospermium_haeckelii",
    "Rhinosporidium_cygnus",
    "Rhinosporidium_seeberi",
    "Sphaeroforma_spB7",
    "Sphaeroforma_spCRG3",
    "Sphaerothecum_destruens",
    "unidentified",
)
READ_COLUMNS = (
    "id", "sequence", "quality", "prefix", "suffix", "length", "A", "T", "C", "G", "N",
    "GC", "AT", "Q_Score", "std_QScore", "q25", "q50", "q75", "q90", "ScoreDist",
)
#: Amplicon start and end of each species' template, in label order (0-based, end exclusive, primers left out).
AMPLICONS = (
    (595, 709), (583, 702), (542, 654), (566, 680), (585, 699),
    (554, 675), (564, 686), (490, 604), (566, 680), (577, 693),
)

#: Which number each label stands for.
CODES = {name: k for k, name in enumerate(LABELS)}


@dataclass(frozen=True)
class PrimerSet:
    forwards: tuple[str, ...]
    reverses: tuple[str, ...]
    shortest: int
    longest: int


PRIMER_SETS = {name: PrimerSet(tuple(p["forwards"]), tuple(p["reverses"]), *RANGES[name]) for name, p in PRIMERS.items()}


def primer_set(name: str) -> PrimerSet:
    """A primer set by name, in any letter case."""
    if name.upper() not in PRIMER_SETS:
        raise ValueError(f"primers: one of {', '.join(PRIMER_SETS)}, not {name}")
    return PRIMER_SETS[name.upper()]

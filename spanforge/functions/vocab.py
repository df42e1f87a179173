"""Controlled vocabularies and thresholds of the output contract."""

# ---- fixed values: names, lists and numbers that results depend on ----

PUBLISHED_CLASSES = ["NCLDV", "MIRUS", "PPV", "CRESS", "PHAGE", "VIRAL_UNKNOWN", "UNKNOWN"]
LINEAGE_CLASSES = ["NCLDV", "MIRUS", "PPV", "CRESS", "PHAGE"]
CONCRETE_CLASSES = ["NCLDV", "MIRUS", "PPV", "CRESS"]
GATE_CLASSES = ["NCLDV", "MIRUS", "PPV", "CRESS", "MIXED", "UNKNOWN"]

VALIDATED_PREFIXES = ["NCLDV__", "MIRUS__", "PLV__", "VP__", "PPV__", "CRESS__"]
SUPPORTING_PREFIXES = ["GVMAG__", "PHAGE__"]
VIRAL_PREFIXES = ["NCLDV__", "MIRUS__", "PLV__", "VP__", "PPV__", "CRESS__", "GVMAG__", "PHAGE__"]
CELLULAR_PREFIXES = ["EUK__", "BAC__", "ARC__"]
HOST_MODEL_EXCLUDED = ["NCLDV__", "MIRUS__", "PPV__", "PLV__", "VP__", "CRESS__", "PHAGE__"]
MIN_VIRAL_PIDENT = 25.0

PARTITION = ["EUK", "MITO", "PLASTID", "BAC", "ARC", "UNK", "NO_HITS", "NCLDV", "MIRUS", "PPV", "CRESS", "GVMAG", "PHAGE"]

DOMAIN_TOKENS = ["euk", "bac", "arc", "vir", "ncldv", "mirus", "phage"]
PLACEHOLDER_TOKENS = [
    "unclassified", "uncultured", "environmental", "sp", "sp.", "unknown", "unidentified", "candidatus",
    "incertae_sedis", "incertae", "sedis", "cf.", "aff.", "cf", "aff",
]

NCLDV_PREFIXES = ["gvogm", "gamadvirusmcp"]
NCLDV_EXACT = ["og1352", "og484"]
ATPASE_EXACT = ["plv_pc_054", "gvogm0760"]
CRESS_MODELS = [f"VS{n:06d}" for n in range(792, 809)]
ORGANELLE_PREFIXES = ["MITO", "PLASTID"]

CATEGORY_KEYWORDS = {
    "capsid": ["capsid", "mcp", "major capsid", "minor capsid", "coat"],
    "portal": ["portal"],
    "terminase": ["terminase"],
    "packaging_atpase": ["packaging atpase", "a32", "packaging", "atpase"],
    "penton": ["penton"],
    "triplex": ["triplex"],
    "protease": ["protease", "peptidase"],
    "polymerase": ["polymerase", "polb", "dna polymerase"],
    "helicase": ["helicase", "primase", "d5"],
    "transcription": ["vltf", "transcription factor", "rna polymerase", "rnap"],
}
CATEGORY_GROUPS = {
    "structural": ["capsid", "penton", "triplex", "portal"],
    "packaging": ["terminase", "packaging_atpase"],
    "replication": ["polymerase", "helicase"],
    "transcription": ["transcription"],
    "protease": ["protease"],
}
VP_CORE = {"mcp": "vp_mcp", "penton": "vp_penton", "atpase": "vp_atpase", "protease": "vp_pro"}
PLV_CORE = {"mcp": "plv_mcp", "pc": "plv_pc"}

ASSEMBLY_MODES = {
    # name: (min types, single-marker score, neighbour score, isolated anchors, single diagnostic)
    "default": (2, 100.0, 5.0, True, False),
    "fragmented": (1, 70.0, 0.0, True, True),
    "relaxed": (1, 50.0, 0.0, True, True),
    "strict": (3, 150.0, 10.0, False, False),
}

VOTE_MCP, VOTE_CONFIRMED, VOTE_MARKER, VOTE_GENE = 5, 3, 2, 1
# ---- end of fixed values ----

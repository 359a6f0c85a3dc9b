"""Entity schemas, required columns and code lists. All of these are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(names: tuple, dtype: T.DataType = S) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names]


CLAIMS_RAW = T.StructType(
    _struct(("claim_id", "policy_id", "client_id", "type_sinistre", "date_sinistre", "date_declaration", "date_cloture", "montant_declare", "montant_provision", "montant_indemnise", "statut", "region_code", "description", "is_fraud_injected", "fraud_rule_injected",))
)

COVERAGE = T.StructType(
    [T.StructField("code", S), T.StructField("libelle", S), T.StructField("plafond", D), T.StructField("incluse", B)]
)

POLICIES_RAW = T.StructType(
    _struct(("policy_id", "client_id", "produit", "date_souscription", "date_echeance",))
    + _struct(("prime_annuelle", "prime_mensuelle",), D)
    + _struct(("canal_vente", "statut", "region_code",))
    + _struct(("franchise", "plafond_garantie",), D)
    + [T.StructField("garanties", T.ArrayType(COVERAGE))]
)

PAYMENTS_RAW = T.StructType(
    _struct(("payment_id", "claim_id", "policy_id", "client_id", "date_paiement", "montant", "devise", "statut", "mode_paiement", "reference_banque", "motif_impaye",))
)

REGIONS_RAW = T.StructType(_struct(("code", "nom", "population", "densite",)))

REQUIRED = {
    "claims": (
        "claim_id", "policy_id", "client_id", "type_sinistre",
        "date_sinistre", "date_declaration", "montant_declare", "statut",
    ),
    "policies": (
        "policy_id", "client_id", "produit", "date_souscription",
        "date_echeance", "prime_annuelle", "canal_vente", "statut",
    ),
    "clients": ("client_id", "client_type", "nom", "region_code", "date_creation"),
    "payments": ("payment_id", "claim_id", "policy_id", "client_id", "date_paiement", "montant", "statut"),
}

CLAIM_STATUS = ("ouvert", "en_cours", "clos", "refuse", "en_litige")
CLAIM_TYPES = (
    "accident_auto", "vol", "bris_glace", "catastrophe_naturelle", "degat_eau", "incendie",
    "hospitalisation", "optique", "dentaire", "pharmacie", "deces", "invalidite",
)
PRODUCTS = ("auto", "habitation", "sante", "vie", "mrh")
POLICY_STATUS = ("actif", "resilié", "suspendu")
CHANNELS = ("agent", "courtier", "digital", "direct", "partenaire")
CLIENT_TYPES = ("particulier", "professionnel", "entreprise")
PAYMENT_STATUS = ("paye", "impaye", "en_cours", "rembourse")
CHURN_SEGMENTS = ("faible", "moyen", "élevé", "critique")

ALLOWED = {
    "claims": {"statut": CLAIM_STATUS, "type_sinistre": CLAIM_TYPES},
    "policies": {"produit": PRODUCTS, "statut": POLICY_STATUS},
    "clients": {"client_type": CLIENT_TYPES},
    "payments": {"statut": PAYMENT_STATUS},
}

POSITIVE = ("montant_declare", "montant", "prime_annuelle")

FLAGS = {
    "flag_early_claim": "RULE_001",
    "flag_high_amount": "RULE_002",
    "flag_frequent_claimant": "RULE_003",
    "flag_address_cluster": "RULE_004",
    "flag_late_declaration": "RULE_005",
}

KPI_DIMS = ("produit", "region_code", "canal_vente", "annee", "trimestre")
CELL_DIMS = ("produit", "region_code", "canal_vente")

# Service columns of ingestion: text of a record that does not fit and the file it came from; paths of JSON values of another
# type than the schema's, and as JSON text what the schema has no place for.
CORRUPT, FILE = "_corrupt_record", "_record_file"
CONFLICTS, RESCUED = "_type_conflicts", "_rescued"

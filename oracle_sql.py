"""DuckDB counterparts of the queries, written independently of the library: the entities as common table
expressions over the driver tables, and one statement per query. The look-around fraud rules are
written as self-joins here, so that they check the window form."""

from __future__ import annotations

PRODUCTS = ["auto", "habitation", "sante", "vie", "mrh"]
TYPES = [
    "accident_auto", "vol", "bris_glace", "catastrophe_naturelle", "degat_eau", "incendie",
    "hospitalisation", "optique", "dentaire", "pharmacie", "deces", "invalidite",
]
CHANNELS = ["agent", "courtier", "digital", "direct", "partenaire"]
CLIENT_TYPES = ["particulier", "professionnel", "entreprise"]
SEGMENTS = ["faible", "moyen", "élevé", "critique"]
DIMS = "produit, region_code, canal_vente, annee, trimestre"


def lst(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def ins(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def msum(x, tail=""):
    """Exact sum of an amount in cents, as euros."""
    return f"CAST(SUM(CAST(round(({x}) * 100) AS BIGINT)) {tail} AS DOUBLE) / 100"


def mavg(x):
    return f"({msum(x)}) / COUNT({x})"


def qlabel(x):
    return f"(CAST(year({x}) AS VARCHAR) || '-Q' || CAST(quarter({x}) AS VARCHAR))"


def ratio(a, b):
    return f"CASE WHEN {b} > 0 THEN round({a} / {b} * 100, 4) END"


VIEWS = {}

VIEWS["cust"] = """
SELECT c_custkey, c_name, c_mktsegment, CAST(n_regionkey AS VARCHAR) AS region_code
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["clients"] = f"""
SELECT c_custkey AS client_id, ({lst(CLIENT_TYPES)})[c_custkey % 3 + 1] AS client_type, c_name AS nom,
  lower(c_mktsegment) AS segment, region_code, CAST(c_custkey // 2 AS VARCHAR) AS adresse,
  DATE '1990-01-01' + CAST((c_custkey * 37) % 3650 AS INTEGER) AS date_creation,
  ({lst(CHANNELS)})[c_custkey % 5 + 1] AS canal_acquisition, c_custkey % 10 <> 0 AS actif
FROM cust"""

VIEWS["regions"] = """
SELECT CAST(r_regionkey AS VARCHAR) AS code,
  CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
    ELSE upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2)) END AS nom
FROM region"""

VIEWS["policies"] = f"""
SELECT o_orderkey AS policy_id, o_custkey AS client_id,
  ({lst(PRODUCTS)})[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS produit,
  CAST(o_orderdate AS DATE) AS date_souscription,
  CAST(o_orderdate AS DATE) + CAST(365 * (1 + o_orderkey % 5) AS INTEGER) AS date_echeance,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 2 AS DOUBLE) / 100 AS prime_annuelle,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 24 AS DOUBLE) / 100 END AS prime_mensuelle,
  ({lst(CHANNELS)})[o_orderkey % 5 + 1] AS canal_vente,
  CASE o_orderstatus WHEN 'O' THEN 'actif' WHEN 'F' THEN 'resilié' ELSE 'suspendu' END AS statut,
  region_code,
  CASE WHEN o_orderkey % 6 <> 0 THEN CAST((o_orderkey % 4) * 100 AS DOUBLE) END AS franchise,
  CAST(round(o_totalprice * 100) AS DOUBLE) / 10 AS plafond_garantie
FROM orders LEFT JOIN cust ON o_custkey = c_custkey"""

VIEWS["lines"] = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_discount DESC, l_returnflag DESC, l_linestatus DESC) = 1"""

VIEWS["claims"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS claim_id, l_orderkey AS policy_id, p.client_id, p.region_code,
  ({lst(TYPES)})[l_partkey % 12 + 1] AS type_sinistre,
  CAST(l_shipdate AS DATE) AS date_sinistre,
  CAST(l_shipdate AS DATE) + CAST(l_partkey % 300 - 10 AS INTEGER) AS date_declaration,
  CASE WHEN l_suppkey % 3 <> 0 THEN
    CAST(l_shipdate AS DATE) + CAST(l_partkey % 300 - 10 AS INTEGER) + CAST(l_suppkey % 180 AS INTEGER) END AS date_cloture,
  l_extendedprice AS montant_declare,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 8 // 10 AS DOUBLE) / 100 AS montant_provision,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 100 AS DOUBLE) / 100 AS montant_indemnise,
  CASE l_returnflag || l_linestatus WHEN 'NF' THEN 'refuse' WHEN 'RF' THEN 'clos' WHEN 'RO' THEN 'clos'
    WHEN 'AO' THEN 'ouvert' WHEN 'AF' THEN 'en_cours' ELSE 'en_litige' END AS statut
FROM lines LEFT JOIN policies p ON l_orderkey = p.policy_id"""

VIEWS["payments"] = """
SELECT event_id AS payment_id, user_id AS client_id, CAST(ts AS DATE) AS date_paiement, value AS montant,
  CASE event_type WHEN 'purchase' THEN 'paye' WHEN 'error' THEN 'impaye' WHEN 'signup' THEN 'rembourse' ELSE 'en_cours' END AS statut
FROM events"""

VIEWS["timed"] = f"""
SELECT *, CASE WHEN date_declaration >= date_sinistre THEN CAST(date_declaration - date_sinistre AS INTEGER) END AS delai_declaration_jours,
  CAST(year(date_sinistre) AS VARCHAR) AS annee_sinistre, strftime(date_sinistre, '%m') AS mois_sinistre,
  {qlabel('date_sinistre')} AS trimestre
FROM claims"""

VIEWS["silver"] = """
SELECT t.*, p.produit, p.prime_annuelle, p.date_souscription, p.canal_vente, p.statut AS statut_police,
  c.client_type, c.segment, c.actif AS client_actif, p.produit IS NOT NULL AS has_valid_policy
FROM timed t LEFT JOIN policies p USING (policy_id) LEFT JOIN clients c ON t.client_id = c.client_id"""

VIEWS["named"] = """
SELECT s.*, coalesce(r.nom, s.region_code) AS region_nom FROM silver s LEFT JOIN regions r ON s.region_code = r.code"""

VIEWS["losses"] = """
SELECT *, CASE WHEN statut = 'clos' THEN coalesce(montant_indemnise, 0)
  WHEN statut IN ('ouvert', 'en_cours', 'en_litige') THEN coalesce(montant_provision, 0) ELSE 0 END AS incurred_loss
FROM silver"""

VIEWS["premiums"] = f"""
SELECT *, round(CAST(round(prime_annuelle * 100) AS BIGINT) * days_covered / 365) / 100 AS earned_premium,
  CAST(year(date_souscription) AS VARCHAR) AS annee, {qlabel('date_souscription')} AS trimestre
FROM (SELECT *, CAST(greatest(least(date_echeance, DATE '2000-12-31') - greatest(date_souscription, DATE '1996-01-01'), 0) AS INTEGER) AS days_covered
  FROM policies)"""

VIEWS["quarters"] = f"""
SELECT policy_id, produit, region_code, canal_vente, prime_annuelle, CAST(year(q) AS VARCHAR) AS annee, {qlabel('q')} AS trimestre,
  CAST(hi - lo AS INTEGER) AS days_covered,
  (round(CAST(round(prime_annuelle * 100) AS BIGINT) * hi / 365) - round(CAST(round(prime_annuelle * 100) AS BIGINT) * lo / 365)) / 100 AS earned_premium
FROM (SELECT *, greatest(q - f, 0) AS lo, least(CAST(q + INTERVAL 3 MONTH AS DATE), t) - f AS hi
  FROM (SELECT p.*, CAST(g.q AS DATE) AS q, greatest(date_souscription, DATE '1996-01-01') AS f, least(date_echeance, DATE '2000-12-31') AS t
    FROM policies p, (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-10-01', INTERVAL 3 MONTH)) AS q) g)
  WHERE q < t AND CAST(q + INTERVAL 3 MONTH AS DATE) > f AND t > f)"""


def claims_agg(src):
    return f"""
SELECT produit, region_code, canal_vente, annee_sinistre AS annee, trimestre,
  COUNT(claim_id) AS nb_sinistres, {msum('incurred_loss')} AS incurred_losses, {msum('montant_declare')} AS montant_declare_total,
  {msum('montant_provision')} AS provisions_ouvertes, COUNT(DISTINCT client_id) AS nb_clients_sinistres,
  AVG(delai_declaration_jours) AS delai_moyen_declaration, COUNT(*) FILTER (statut = 'refuse') AS nb_refuses
FROM {src} GROUP BY produit, region_code, canal_vente, annee_sinistre, trimestre"""


def premium_agg(src):
    return f"""
SELECT {DIMS}, {msum('earned_premium')} AS earned_premium, {msum('prime_annuelle')} AS prime_annuelle_total,
  COUNT(DISTINCT policy_id) AS nb_polices, {mavg('prime_annuelle')} AS prime_moyenne
FROM {src} GROUP BY {DIMS}"""


def kpi_join(prem, cl):
    return f"""
SELECT {DIMS}, p.earned_premium, p.prime_annuelle_total, p.nb_polices, p.prime_moyenne,
  coalesce(c.nb_sinistres, 0) AS nb_sinistres, coalesce(c.incurred_losses, 0) AS incurred_losses, c.montant_declare_total,
  coalesce(c.provisions_ouvertes, 0) AS provisions_ouvertes, c.nb_clients_sinistres, c.delai_moyen_declaration, c.nb_refuses,
  {ratio('coalesce(c.incurred_losses, 0)', 'p.earned_premium')} AS loss_ratio
FROM {prem} p LEFT JOIN {cl} c USING ({DIMS})"""


VIEWS["ckpis"] = claims_agg("losses")
VIEWS["pkpis"] = premium_agg("premiums")
VIEWS["quarterly"] = kpi_join("pkpis", "ckpis")

YTD = "OVER (PARTITION BY produit, region_code, canal_vente, annee ORDER BY trimestre ROWS UNBOUNDED PRECEDING)"
ROLL = "OVER (PARTITION BY produit, region_code, canal_vente ORDER BY trimestre ROWS 3 PRECEDING)"

VIEWS["running"] = f"""
SELECT *, {msum('incurred_losses', YTD)} AS ytd_incurred_losses, {msum('earned_premium', YTD)} AS ytd_earned_premium,
  {msum('incurred_losses', ROLL)} AS rolling_12m_incurred, {msum('earned_premium', ROLL)} AS rolling_12m_premium
FROM quarterly"""

VIEWS["stats"] = """
SELECT produit, AVG(montant_declare) AS m, coalesce(stddev_samp(montant_declare), 0) AS s FROM silver GROUP BY produit"""

VIEWS["frequent"] = """
SELECT a.claim_id, COUNT(*) AS n FROM claims a JOIN claims b ON a.client_id = b.client_id
  AND a.date_sinistre - b.date_sinistre BETWEEN 0 AND 365 GROUP BY a.claim_id"""

VIEWS["located"] = """
SELECT s.claim_id, s.client_id, s.produit, s.date_sinistre, c.adresse FROM silver s LEFT JOIN clients c ON s.client_id = c.client_id"""

VIEWS["clusters"] = """
SELECT DISTINCT a.claim_id FROM located a JOIN located b ON a.adresse = b.adresse AND a.client_id <> b.client_id
  AND a.produit <> b.produit AND abs(a.date_sinistre - b.date_sinistre) <= 30"""

VIEWS["flags"] = """
SELECT s.claim_id, s.policy_id, s.client_id, s.produit, s.date_sinistre, s.montant_declare, s.region_code,
  CASE WHEN date_sinistre - date_souscription >= 0 AND date_sinistre - date_souscription < 48 / 24.0 THEN 1 ELSE 0 END AS flag_early_claim,
  CASE WHEN montant_declare > st.m + 1.5 * st.s THEN 1 ELSE 0 END AS flag_high_amount,
  CASE WHEN coalesce(f.n, 0) >= 8 THEN 1 ELSE 0 END AS flag_frequent_claimant,
  CASE WHEN k.claim_id IS NOT NULL THEN 1 ELSE 0 END AS flag_address_cluster,
  CASE WHEN delai_declaration_jours > 180 THEN 1 ELSE 0 END AS flag_late_declaration
FROM silver s LEFT JOIN stats st ON s.produit = st.produit LEFT JOIN frequent f ON s.claim_id = f.claim_id
  LEFT JOIN clusters k ON s.claim_id = k.claim_id"""

VIEWS["fraud"] = """
SELECT *, fraud_score > 0 AS is_fraud_suspected FROM (
  SELECT *, CAST(flag_early_claim * 25 + flag_high_amount * 30 + flag_frequent_claimant * 20 + flag_address_cluster * 15
    + flag_late_declaration * 10 AS INTEGER) AS fraud_score,
  array_to_string(list_filter([CASE WHEN flag_early_claim = 1 THEN 'RULE_001' END, CASE WHEN flag_high_amount = 1 THEN 'RULE_002' END,
    CASE WHEN flag_frequent_claimant = 1 THEN 'RULE_003' END, CASE WHEN flag_address_cluster = 1 THEN 'RULE_004' END,
    CASE WHEN flag_late_declaration = 1 THEN 'RULE_005' END], lambda x: x IS NOT NULL), ',') AS fraud_flags
  FROM flags)"""

VIEWS["seniority"] = """
SELECT *, (DATE '2002-01-01' - date_creation) / CAST(365 AS DOUBLE) AS anciennete_annees,
  1 - least((DATE '2002-01-01' - date_creation) / CAST(365 AS DOUBLE), CAST(10 AS DOUBLE)) / CAST(10 AS DOUBLE) AS score_seniority_inverse
FROM clients"""

VIEWS["unpaid"] = """
SELECT client_id, COUNT(*) FILTER (statut = 'impaye') AS nb_impayes,
  CAST(COUNT(*) FILTER (statut = 'impaye') AS DOUBLE) / COUNT(payment_id) AS score FROM payments GROUP BY client_id"""

VIEWS["refused"] = """
SELECT client_id, COUNT(*) FILTER (statut = 'refuse') AS nb_refuses,
  CAST(COUNT(*) FILTER (statut = 'refuse') AS DOUBLE) / COUNT(claim_id) AS score FROM claims GROUP BY client_id"""

VIEWS["contracts"] = """
SELECT client_id, COUNT(DISTINCT policy_id) AS n FROM policies WHERE statut = 'actif' GROUP BY client_id"""

VIEWS["churn"] = """
SELECT *, CASE WHEN churn_score < 25 THEN 'faible' WHEN churn_score < 50 THEN 'moyen' WHEN churn_score < 75 THEN 'élevé' ELSE 'critique' END AS churn_segment
FROM (SELECT *, round(least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
    (score_seniority_inverse * CAST(0.3 AS DOUBLE) + score_unpaid * CAST(0.3 AS DOUBLE) + score_refused * CAST(0.2 AS DOUBLE)
     + score_mono_contract * CAST(0.2 AS DOUBLE)) * CAST(100 AS DOUBLE))), 2) AS churn_score
  FROM (SELECT s.client_id, client_type, nom, region_code, segment, anciennete_annees, coalesce(k.n, 0) AS nb_contrats, u.nb_impayes, r.nb_refuses,
      score_seniority_inverse, coalesce(u.score, CAST(0 AS DOUBLE)) AS score_unpaid, coalesce(r.score, CAST(0 AS DOUBLE)) AS score_refused,
      CAST(CASE WHEN coalesce(k.n, 0) <= 1 THEN 1 ELSE 0 END AS DOUBLE) AS score_mono_contract
    FROM seniority s LEFT JOIN unpaid u ON s.client_id = u.client_id LEFT JOIN refused r ON s.client_id = r.client_id
      LEFT JOIN contracts k ON s.client_id = k.client_id))"""

VIEWS["active"] = "SELECT * FROM policies WHERE statut = 'actif'"

VIEWS["aged"] = """
SELECT *, CASE WHEN delai_traitement_jours <= 7 THEN '0_7j' WHEN delai_traitement_jours <= 30 THEN '7_30j'
    WHEN delai_traitement_jours <= 90 THEN '30_90j' ELSE '90j_plus' END AS aging_bucket,
  CAST(CASE WHEN delai_traitement_jours <= 7 THEN 1 WHEN delai_traitement_jours <= 30 THEN 2
    WHEN delai_traitement_jours <= 90 THEN 3 ELSE 4 END AS INTEGER) AS bucket_order
FROM (SELECT *, CAST(greatest(coalesce(date_cloture, DATE '2002-01-01') - date_declaration, 0) AS INTEGER) AS delai_traitement_jours FROM silver)"""

VIEWS["messy"] = """
SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(policy_id AS VARCHAR) AS policy_id, CAST(client_id AS VARCHAR) AS client_id,
  CASE WHEN type_sinistre <> 'vol' THEN statut END AS statut,
  CASE WHEN statut <> 'refuse' THEN type_sinistre END AS type_sinistre,
  CASE WHEN type_sinistre IN ('deces', 'optique') THEN NULL WHEN type_sinistre = 'incendie' THEN 0 ELSE montant_declare END AS montant_declare,
  CASE WHEN type_sinistre <> 'dentaire' THEN montant_declare END AS montant_provision,
  CASE WHEN statut = 'clos' THEN montant_declare END AS montant_indemnise, region_code,
  CASE WHEN type_sinistre <> 'bris_glace' THEN type_sinistre END AS description,
  CASE WHEN statut = 'ouvert' THEN true WHEN statut = 'clos' THEN NULL ELSE false END AS is_fraud_injected
FROM claims"""

VIEWS["checked"] = """
SELECT *, list_filter([CASE WHEN montant_declare IS NULL THEN 'montant_declare_missing' END,
  CASE WHEN NOT coalesce(montant_declare > 0, false) THEN 'montant_declare_not_positive' END,
  CASE WHEN statut IS NULL THEN 'statut_missing' END, CASE WHEN statut IS NULL THEN 'statut_not_allowed' END,
  CASE WHEN type_sinistre IS NULL THEN 'type_sinistre_missing' END,
  CASE WHEN type_sinistre IS NULL THEN 'type_sinistre_not_allowed' END], lambda x: x IS NOT NULL) AS broken
FROM messy"""

VIEWS["steps"] = """
SELECT strftime(ts, '%Y%m%d') AS run_id, value AS duration_sec, CASE WHEN event_type <> 'error' THEN user_id END AS nb_out,
  CASE WHEN event_type = 'error' THEN user_id END AS nb_rejected FROM events"""

VIEWS["step_summary"] = """
SELECT run_id, round(SUM(duration_sec), 2) AS total_duration_sec, CAST(coalesce(SUM(nb_out), 0) AS BIGINT) AS total_records_out,
  CAST(coalesce(SUM(nb_rejected), 0) AS BIGINT) AS total_rejected,
  round(CAST(coalesce(SUM(nb_rejected), 0) AS DOUBLE) / greatest(coalesce(SUM(nb_out), 0), 1) * 100, 4) AS rejection_rate_pct
FROM steps GROUP BY run_id"""

PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items()) + "\n"

Q = {}

# Keys, cleaning, dates

Q["w1_dedup_latest"] = """
SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
  l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"""
Q["j8_one_per_key"] = "SELECT policy_id, client_id, produit, prime_annuelle FROM policies"
Q["p1_normalise_codes"] = """
SELECT claim_id, policy_id, client_id, coalesce(statut, 'inconnu') AS statut, coalesce(type_sinistre, 'inconnu') AS type_sinistre,
  coalesce(montant_declare, 0) AS montant_declare, coalesce(montant_provision, 0) AS montant_provision,
  coalesce(montant_indemnise, 0) AS montant_indemnise, region_code, coalesce(description, '') AS description, is_fraud_injected FROM messy"""
COVERAGES = "policies LEFT JOIN (SELECT unnest([1, 2, 3]) AS i) ON i <= policy_id % 4"
Q["p2_explode_outer"] = f"""
SELECT policy_id, produit, coalesce(franchise, CAST(0 AS DOUBLE)) AS franchise,
  CASE WHEN i IS NULL THEN 'inconnu' ELSE 'c' || i END AS garantie_code,
  'Non renseigné' AS garantie_libelle, prime_annuelle * i AS garantie_plafond, coalesce(i % 2 = 1, false) AS garantie_incluse
FROM {COVERAGES}"""
Q["p5_clean_policies"] = """
SELECT policy_id, statut, produit, prime_annuelle, coalesce(prime_mensuelle, prime_annuelle / 12) AS prime_mensuelle,
  coalesce(franchise, CAST(0 AS DOUBLE)) AS franchise FROM policies"""
Q["p6_parse_dates"] = """
SELECT claim_id, date_texte, CAST(coalesce(try_strptime(date_texte, '%Y-%m-%d'), try_strptime(date_texte, '%d/%m/%Y'),
  try_strptime(date_texte, '%m/%d/%Y'), try_strptime(date_texte, '%Y/%m/%d'), try_strptime(date_texte, '%d-%m-%Y')) AS DATE) AS date_sinistre
FROM (SELECT claim_id, CASE claim_id % 6 WHEN 0 THEN strftime(date_sinistre, '%Y-%m-%d') WHEN 1 THEN strftime(date_sinistre, '%d/%m/%Y')
  WHEN 2 THEN strftime(date_sinistre, '%m/%d/%Y') WHEN 3 THEN strftime(date_sinistre, '%Y/%m/%d') WHEN 4 THEN strftime(date_sinistre, '%d-%m-%Y')
  ELSE 'junk' END AS date_texte FROM claims)"""
Q["p7_declaration_delay"] = "SELECT claim_id, delai_declaration_jours FROM timed"
Q["p8_period_columns"] = "SELECT claim_id, annee_sinistre, mois_sinistre, trimestre FROM timed"
Q["p11_incurred_loss"] = "SELECT claim_id, statut, incurred_loss FROM losses"
Q["p12_earned_premium"] = "SELECT policy_id, produit, days_covered, earned_premium, annee, trimestre, region_code, canal_vente FROM premiums"
Q["p12_earned_by_quarter"] = "SELECT policy_id, annee, trimestre, days_covered, earned_premium FROM quarters"
Q["p16_processing_delay"] = "SELECT claim_id, delai_traitement_jours FROM aged"
Q["p17_aging_bucket"] = "SELECT claim_id, aging_bucket, bucket_order FROM aged"

# Validation

Q["v5_valid_rows"] = "SELECT claim_id, statut, type_sinistre, montant_declare FROM checked WHERE len(broken) = 0"
Q["v5_rejected_rows"] = """
SELECT claim_id, array_to_string(broken, ',') AS rules, 'schema_validation_failed' AS _rejection_reason, 'b1' AS _batch_id
FROM checked WHERE len(broken) > 0"""
Q["v9_volumetry"] = """
SELECT COUNT(*) AS n_in, COUNT(*) FILTER (len(broken) = 0) AS n_valid, COUNT(*) FILTER (len(broken) > 0) AS n_rejected FROM checked"""

# Joins

Q["j1_enriched_claims"] = """
SELECT cl.claim_id, cl.policy_id, cl.client_id, p.produit, p.canal_vente, p.statut AS statut_police, p.prime_annuelle,
  c.client_type, c.segment, c.actif AS client_actif, p.policy_id IS NOT NULL AS has_valid_policy, c.client_id IS NOT NULL AS has_valid_client
FROM claims cl LEFT JOIN (SELECT * FROM policies WHERE date_souscription <= DATE '2000-12-31') p ON cl.policy_id = p.policy_id
  LEFT JOIN (SELECT * FROM clients WHERE actif) c ON cl.client_id = c.client_id"""
Q["j10_region_label"] = """
SELECT client_id, region_code, coalesce(nom_r, region_code) AS region_nom
FROM clients LEFT JOIN (SELECT code, nom AS nom_r FROM regions) ON region_code = code"""
Q["j12_orphans"] = "SELECT claim_id, policy_id FROM claims WHERE policy_id NOT IN (SELECT policy_id FROM active)"
Q["j13_semi_filter"] = """
SELECT claim_id, flag_late_declaration, region_code, region_nom FROM (
  SELECT n.claim_id, n.region_code, n.region_nom, f.flag_late_declaration FROM named n
    JOIN (SELECT claim_id, CASE WHEN delai_declaration_jours > 180 THEN 1 ELSE 0 END AS flag_late_declaration FROM timed) f ON n.claim_id = f.claim_id
  WHERE produit IN ('auto', 'vie') AND statut IN ('clos', 'refuse') AND year(date_sinistre) BETWEEN 1997 AND 1999 AND n.region_code IN ('0', '1', '2'))"""

# Indicators

Q["a1_claims_kpis"] = "SELECT * FROM ckpis"
Q["a2_premium_kpis"] = "SELECT * FROM pkpis"
Q["a3_amount_statistics"] = f"""
SELECT produit, round({mavg('montant_declare')}, 4) AS mean_montant, round(stddev_samp(montant_declare), 4) AS std_montant FROM silver GROUP BY produit"""
Q["g2_portfolio_kpis"] = f"""
SELECT *, {ratio('ytd_incurred_losses', 'ytd_earned_premium')} AS ytd_loss_ratio,
  {ratio('rolling_12m_incurred', 'rolling_12m_premium')} AS rolling_12m_loss_ratio FROM running"""
Q["g3_loss_ratio"] = f"""
SELECT *, CASE WHEN loss_ratio_pct < 60 THEN 'excellent' WHEN loss_ratio_pct < 80 THEN 'bon' WHEN loss_ratio_pct < 100 THEN 'acceptable'
  WHEN loss_ratio_pct < 150 THEN 'dégradé' ELSE 'critique' END AS loss_ratio_category
FROM (SELECT * RENAME (rolling_12m_incurred AS rolling_12m_losses), {ratio('incurred_losses', 'earned_premium')} AS loss_ratio_pct,
  {ratio('ytd_incurred_losses', 'ytd_earned_premium')} AS loss_ratio_ytd_pct,
  {ratio('rolling_12m_incurred', 'rolling_12m_premium')} AS loss_ratio_rolling_12m_pct FROM running)"""
CAL = """OVER (PARTITION BY produit, region_code, canal_vente
  ORDER BY CAST(substr(trimestre, 1, 4) AS INTEGER) * 4 + CAST(substr(trimestre, 7, 1) AS INTEGER) RANGE 3 PRECEDING)"""
Q["w3_rolling_calendar"] = f"""
SELECT {DIMS}, {msum('incurred_losses', CAL)} AS rolling_12m_incurred, {msum('earned_premium', CAL)} AS rolling_12m_premium FROM quarterly"""
Q["j7_occurrence_period"] = f"""
SELECT {DIMS}, earned_premium, incurred_losses, loss_ratio FROM ({kpi_join('(' + premium_agg('quarters') + ')', 'ckpis')})"""

# Fraud

Q["r1_early_claim"] = "SELECT s.claim_id, s.date_souscription, f.flag_early_claim FROM silver s JOIN flags f ON s.claim_id = f.claim_id"
for _q, _f in (
    ("r2_high_amount", "flag_high_amount"),
    ("r3_frequent_claimant", "flag_frequent_claimant"),
    ("r4_address_cluster", "flag_address_cluster"),
    ("r5_late_declaration", "flag_late_declaration"),
):
    Q[_q] = f"SELECT claim_id, {_f} FROM flags"
Q["r6_fraud_score"] = "SELECT * EXCLUDE (region_code) FROM fraud"
Q["r7_suspects_by_product"] = "SELECT produit, COUNT(*) AS nb, COUNT(*) FILTER (is_fraud_suspected) AS nb_suspects FROM fraud GROUP BY produit"

# Churn

Q["c1_seniority"] = "SELECT client_id, anciennete_annees, score_seniority_inverse FROM seniority"
Q["c2_unpaid"] = "SELECT client_id, score_unpaid, nb_impayes FROM churn"
Q["c3_refused"] = "SELECT client_id, score_refused, nb_refuses FROM churn"
Q["c4_mono_contract"] = "SELECT client_id, nb_contrats, score_mono_contract FROM churn"
Q["c5_churn_scores"] = "SELECT * FROM churn"

# Exposure and aging

EXPOSURE = f"""SELECT region_code, produit, canal_vente, COUNT(policy_id) AS nb_polices, {msum('prime_annuelle')} AS prime_totale,
  {msum('plafond_garantie')} AS exposition_max, {mavg('prime_annuelle')} AS prime_moyenne FROM active GROUP BY ALL"""
BYREGION = f"""SELECT region_code, COUNT(claim_id) AS nb_sinistres, {msum('montant_declare')} AS sinistres_declares,
  {msum('montant_indemnise')} AS sinistres_indemnises FROM claims GROUP BY region_code"""


def hhi(src, group):
    return f"""(SELECT round(SUM(pow(t / g, 2) * 10000), 2) FROM (SELECT t, CAST(SUM(CAST(round(t * 100) AS BIGINT)) OVER () AS DOUBLE) / 100 AS g
      FROM (SELECT {msum('prime_annuelle')} AS t FROM {src} GROUP BY {group})))"""


Q["a7_exposure"] = EXPOSURE
Q["a8_concentration"] = f"""
SELECT produit, prime_totale_produit, round(prime_totale_produit / g * 100, 4) AS market_share_pct,
  round(pow(prime_totale_produit / g, 2) * 10000, 6) AS hhi_component,
  CASE WHEN pow(prime_totale_produit / g, 2) * 10000 < 1500 THEN 'peu_concentré' WHEN pow(prime_totale_produit / g, 2) * 10000 < 2500 THEN 'modéré'
    ELSE 'concentré' END AS hhi_category
FROM (SELECT produit, {msum('prime_annuelle')} AS prime_totale_produit FROM active GROUP BY produit), (SELECT {msum('prime_annuelle')} AS g FROM active)"""
Q["a10_hhi"] = f"SELECT {hhi('policies', 'region_code')} AS hhi_prime_annuelle"
Q["a10_hhi_on_rows"] = f"SELECT policy_id, {hhi('policies', 'canal_vente')} AS hhi_prime_annuelle FROM policies"
Q["a11_claims_by_region"] = BYREGION
Q["g5_portfolio_exposure"] = f"""
SELECT e.*, r.nom, CAST(length(r.nom) AS INTEGER) AS population, CAST(ascii(r.nom) AS INTEGER) AS densite, {hhi('active', 'produit')} AS portfolio_hhi,
  coalesce(c.nb_sinistres, 0) AS nb_sinistres, coalesce(c.sinistres_declares, 0) AS sinistres_declares,
  coalesce(c.sinistres_indemnises, 0) AS sinistres_indemnises, round(coalesce(c.nb_sinistres, 0) / e.nb_polices, 4) AS sinistres_per_policy
FROM ({EXPOSURE}) e LEFT JOIN regions r ON e.region_code = r.code LEFT JOIN ({BYREGION}) c ON e.region_code = c.region_code"""
Q["g4_aging_detail"] = "SELECT claim_id, type_sinistre, statut, annee_sinistre AS annee, delai_traitement_jours, aging_bucket FROM aged"
SUMMARY = f"""COUNT(claim_id) AS nb_sinistres, {msum('montant_declare')} AS montant_declare_total,
  {msum('montant_indemnise')} AS montant_indemnise_total, AVG(delai_traitement_jours) AS delai_moyen_jours"""
Q["g4_aging_summary"] = f"""
SELECT type_sinistre, aging_bucket, statut, annee_sinistre AS annee, produit, {SUMMARY},
  quantile_disc(delai_traitement_jours, 0.5) AS delai_median_jours, quantile_disc(delai_traitement_jours, 0.9) AS delai_p90_jours,
  MIN(bucket_order) AS bucket_order FROM aged GROUP BY type_sinistre, aging_bucket, statut, annee_sinistre, produit"""
Q["a12_exact_quantiles"] = f"""
SELECT type_sinistre, aging_bucket, {SUMMARY}, round(quantile_cont(CAST(delai_traitement_jours AS DOUBLE), 0.5), 6) AS delai_median_jours,
  round(quantile_cont(CAST(delai_traitement_jours AS DOUBLE), 0.9), 6) AS delai_p90_jours, MIN(bucket_order) AS bucket_order
FROM aged GROUP BY type_sinistre, aging_bucket"""

# Data quality


def check(name, observed, threshold, passed, src):
    """One result row; ``o`` is the observed value in ``passed``. An empty table fails."""
    return f"""SELECT '{name}' AS "check", o AS observed, CAST({threshold} AS DOUBLE) AS threshold, coalesce(n > 0 AND {passed}, false) AS passed
FROM (SELECT COUNT(*) AS n, CAST({observed} AS DOUBLE) AS o FROM {src})"""


def none(name, cond, src):
    return check(name, f"COUNT(*) FILTER ({cond})", 0, "o <= 0", src)


def uniq(name, key, src):
    return check(name, f"COUNT(*) - COUNT(DISTINCT {key})", 0, "o <= 0", src)


def rate(name, cond, bound, src, where="true"):
    return check(name, f"coalesce(COUNT(*) FILTER ({where} AND {cond}) / nullif(COUNT(*) FILTER ({where}), 0), 0)", bound, f"o < {bound}", src)


def fk(name, child, parent, key):
    return rate(name, f"hit IS NULL", 0.01, f"(SELECT c.{key}, p.{key} AS hit FROM {child} c LEFT JOIN (SELECT DISTINCT {key} FROM {parent}) p ON c.{key} = p.{key})")


def union(*parts):
    return "\nUNION ALL\n".join(parts)


STATUS = ins(["ouvert", "en_cours", "clos", "refuse", "en_litige", "inconnu"])
Q["q_bronze_suite"] = union(
    uniq("claims.unique_claim_id", "claim_id", "claims"),
    none("claims.between_date_sinistre", "date_sinistre NOT BETWEEN DATE '1996-01-01' AND DATE '2001-12-31'", "claims"),
    none("claims.positive_montant_declare", "montant_declare <= 0", "claims"),
    *[
        rate(f"claims.null_rate_{c}", f"{c} IS NULL", 0.02, "claims")
        for c in ("claim_id", "policy_id", "client_id", "date_sinistre", "date_declaration", "statut")
    ],
    check("claims.has_columns", "0", 0, "o <= 0", "claims"),
    none("claims.in_set_statut", f"statut NOT IN {STATUS}", "claims"),
    none("policies.not_null_policy_id", "policy_id IS NULL", "policies"),
    none("policies.positive_prime_annuelle", "prime_annuelle <= 0", "policies"),
    none("policies.in_set_produit", f"produit NOT IN {ins([*PRODUCTS, 'inconnu'])}", "policies"),
    none("policies.expiry_after_start", "date_echeance <= date_souscription", "policies"),
)
Q["q_silver_suite"] = union(
    fk("claims.policy_fk", "silver", "policies", "policy_id"),
    fk("claims.client_fk", "silver", "clients", "client_id"),
    fk("policies.client_fk", "policies", "clients", "client_id"),
    uniq("claims.unique_claim_id", "claim_id", "silver"),
    none("claims.delay_not_negative", "delai_declaration_jours < 0", "silver"),
    none("claims.paid_at_most_declared", "montant_indemnise > montant_declare * 1.1", "silver"),
    rate("claims.claim_before_subscription", "date_sinistre < date_souscription", 0.05, "silver", "has_valid_policy"),
    none("claims.no_future_claim", "date_sinistre > DATE '2002-01-01'", "silver"),
    none("kpis.between_loss_ratio", "loss_ratio NOT BETWEEN 0 AND 300", "quarterly"),
    check("kpis.has_values_produit", f"5 - COUNT(DISTINCT produit) FILTER (produit IN {ins(PRODUCTS)})", 0, "o <= 0", "quarterly"),
    none("kpis.positive_earned_premium", "earned_premium <= 0", "quarterly"),
)
_gold = union(
    f"""SELECT 'premium_reconciliation' AS "check", o AS observed, CAST(1.05 AS DOUBLE) AS threshold, coalesce(o > 0.1 AND o <= 1.05, false) AS passed
FROM (SELECT (SELECT {msum('earned_premium')} FROM premiums) / (SELECT {msum('prime_annuelle')} FROM policies) AS o)""",
    """SELECT 'kpis.products', CAST(COUNT(*) AS DOUBLE), CAST(0 AS DOUBLE), COUNT(*) <= 0
FROM (SELECT DISTINCT produit FROM policies WHERE produit NOT IN (SELECT produit FROM quarterly))""",
    uniq("fraud.unique_claim_id", "claim_id", "fraud"),
    none("fraud.between_fraud_score", "fraud_score NOT BETWEEN 0 AND 100", "fraud"),
    rate("fraud.fraud_score_missing", "fraud_score IS NULL", 0.01, "fraud"),
    none("fraud.flags_behind_score", "fraud_score > 0 AND fraud_flags = ''", "fraud"),
    rate("fraud.suspected_rate", "is_fraud_suspected", 0.2, "fraud"),
    uniq("churn.unique_client_id", "client_id", "churn"),
    none("churn.between_churn_score", "churn_score NOT BETWEEN 0 AND 100", "churn"),
    rate("churn.churn_score_missing", "churn_score IS NULL", 0.01, "churn"),
    none("churn.in_set_churn_segment", f"churn_segment NOT IN {ins(SEGMENTS)}", "churn"),
    """SELECT 'churn.coverage', o, CAST(0.8 AS DOUBLE), o >= 0.8 FROM (SELECT CAST((SELECT COUNT(DISTINCT client_id) FROM churn) AS DOUBLE)
  / (SELECT COUNT(DISTINCT client_id) FROM active) AS o)""",
)
Q["q_gold_suite"] = f"""SELECT "check", round(observed, 9) AS observed, threshold, passed FROM ({_gold})"""
Q["q21_declarative"] = union(
    none("not_null_claim_id", "claim_id IS NULL", "claims"),
    uniq("unique_claim_id", "claim_id", "claims"),
    none("not_null_policy_id", "policy_id IS NULL", "claims"),
    none("not_null_client_id", "client_id IS NULL", "claims"),
    none("in_set_statut", f"statut NOT IN {STATUS}", "claims"),
    none("between_montant_declare", "montant_declare NOT BETWEEN 0 AND 10000000", "claims"),
    none("matches_date_sinistre", r"NOT regexp_matches(CAST(date_sinistre AS VARCHAR), '^\d{4}-\d{2}-\d{2}$')", "claims"),
    check("row_count", "COUNT(*)", 10000000, "o BETWEEN 1 AND 10000000", "claims"),
)
Q["q23_anomalies"] = """
SELECT * FROM (
  SELECT 'Délai négatif' AS type, 'date_declaration < date_sinistre' AS description, COUNT(*) AS "count", 'high' AS severity
  FROM silver WHERE date_declaration < date_sinistre
  UNION ALL SELECT 'Montant extrême', 'montant_declare > 1 000 000 €', COUNT(*), 'medium' FROM silver WHERE montant_declare > 1000000
  UNION ALL SELECT 'Sinistre orphelin', 'Aucun produit associé (police manquante)', COUNT(*), 'medium' FROM silver WHERE produit IS NULL)
WHERE "count" > 0"""

# Monitoring


def null_pct(layer, table, src, columns):
    return [
        f"""SELECT '{layer}' AS layer, '{table}' AS "table", '{c}' AS "column", round(COUNT(*) FILTER ({c} IS NULL) * CAST(100 AS DOUBLE) / COUNT(*), 4) AS null_rate_pct FROM {src}"""
        for c in columns
    ]


Q["m1_null_rates"] = union(
    *null_pct("bronze", "claims", "messy", ("claim_id", "policy_id", "client_id", "montant_declare", "statut")),
    *null_pct("silver", "claims", "timed", ("claim_id", "date_sinistre", "date_cloture", "delai_declaration_jours")),
    *null_pct("gold", "fraud_assessment", "fraud", ("claim_id", "fraud_score")),
)
Q["m1_duplicates"] = union(
    *[
        f"""SELECT '{t}' AS "table", COUNT(*) AS total, COUNT(DISTINCT {k}) AS "distinct", COUNT(*) - COUNT(DISTINCT {k}) AS duplicates FROM {s}"""
        for t, k, s in (
            ("bronze/claims", "(l_orderkey * 10 + l_linenumber)", "lineitem"),
            ("silver/claims", "claim_id", "claims"),
            ("silver/clients", "client_id", "clients"),
        )
    ]
)
BAND = "CASE WHEN fraud_score = 0 THEN 0 WHEN fraud_score <= 25 THEN 1 WHEN fraud_score <= 50 THEN 2 WHEN fraud_score <= 75 THEN 3 ELSE 4 END"
Q["m2_score_bands"] = f"""
SELECT b AS bucket, COUNT(s) AS "count", COUNT(s) / (SELECT COUNT(*) FROM fraud) * CAST(100 AS DOUBLE) AS pct
FROM (SELECT unnest(['0', '1-25', '26-50', '51-75', '76-100']) AS b, unnest([0, 1, 2, 3, 4]) AS i)
  LEFT JOIN (SELECT {BAND} AS s FROM fraud) ON s = i GROUP BY b"""
Q["m2_named_bands"] = f"""
SELECT (['0 (aucun)', '1-25 (faible)', '26-50 (moyen)', '51-75 (élevé)', '76-100 (critique)'])[{BAND} + 1] AS score_bin, COUNT(*) AS nb FROM fraud GROUP BY 1"""
Q["m3_indemnification"] = f"""
SELECT produit, indemn, declar, indemn / declar AS lr FROM (SELECT produit, {msum('montant_indemnise')} AS indemn, {msum('montant_declare')} AS declar
  FROM silver GROUP BY produit)"""


def metric(table, name, expr, src):
    return f"""SELECT '{table}' AS "table", '{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM {src}"""


Q["m4_table_metrics"] = union(
    metric("silver_claims", "row_count", "COUNT(*)", "claims"),
    metric("silver_claims", "injected_fraud_count", "COUNT(*) FILTER (statut = 'refuse')", "claims"),
    metric("silver_clients", "row_count", "COUNT(*)", "clients"),
    metric("silver_policies", "row_count", "COUNT(*)", "policies"),
    metric("gold_portfolio_kpis", "row_count", "COUNT(*)", "quarterly"),
    metric("gold_fraud_assessment", "row_count", "COUNT(*)", "fraud"),
    metric("gold_fraud_assessment", "fraud_suspected_count", "COUNT(*) FILTER (is_fraud_suspected)", "fraud"),
    metric("gold_fraud_assessment", "fraud_rate_pct", "round(COUNT(*) FILTER (is_fraud_suspected) / COUNT(*) * CAST(100 AS DOUBLE), 4)", "fraud"),
    metric("gold_churn_scores", "row_count", "COUNT(*)", "churn"),
    *[metric("gold_churn_scores", f"churn_{s}", f"COUNT(*) FILTER (churn_segment = '{s}')", "churn") for s in SEGMENTS],
)
Q["m5_step_summary"] = "SELECT * FROM step_summary"
Q["m6_latest_run"] = "SELECT * FROM step_summary WHERE run_id = (SELECT MAX(run_id) FROM step_summary)"
Q["m7_global_kpis"] = f"""
SELECT COUNT(*) AS n_claims, round(({msum('montant_indemnise')}) / ({msum('montant_declare')}) * 100, 2) AS paid_rate_pct,
  round({mavg('montant_declare')}, 2) AS avg_amount, round(AVG(delai_declaration_jours), 1) AS avg_delay,
  (SELECT COUNT(DISTINCT policy_id) FROM policies) AS n_policies, (SELECT COUNT(*) FROM clients) AS n_clients,
  (SELECT COUNT(*) FROM fraud WHERE is_fraud_suspected) AS n_suspected,
  (SELECT round(COUNT(*) FILTER (is_fraud_suspected) * CAST(100 AS DOUBLE) / COUNT(*), 2) FROM fraud) AS fraud_rate_pct FROM timed"""

# Dashboard

Q["b1_slice"] = """
SELECT claim_id, produit, statut, region_code, date_sinistre FROM silver WHERE produit IN ('auto', 'sante') AND statut IN ('clos', 'ouvert')
  AND year(date_sinistre) BETWEEN 1996 AND 1999 AND region_code IN ('0', '2', '4')"""
Q["b1_choices"] = "SELECT DISTINCT produit FROM silver WHERE produit IS NOT NULL"
SLICE = "(SELECT * FROM silver WHERE year(date_sinistre) BETWEEN 1996 AND 1999)"
Q["b2_headline"] = f"""
SELECT COUNT(*) AS n_claims, COUNT(DISTINCT policy_id) AS n_policies, {mavg('montant_declare')} AS avg_amount, AVG(delai_declaration_jours) AS avg_delay,
  (SELECT AVG(CAST(is_fraud_suspected AS INTEGER)) * 100 FROM fraud WHERE claim_id IN (SELECT claim_id FROM {SLICE})) AS suspected_rate_pct,
  (SELECT ({msum('montant_indemnise')}) / ({msum('montant_declare')}) * 100 FROM silver) AS paid_rate_pct FROM {SLICE}"""
Q["b3_frequency_status"] = "SELECT statut, COUNT(*) AS nb FROM claims GROUP BY statut"
Q["b4_claims_by_region"] = f"SELECT region_nom, COUNT(*) AS nb, {mavg('montant_declare')} AS avg_amount FROM named GROUP BY region_nom"
Q["b5_monthly_trend"] = f"""
SELECT strftime(date_sinistre, '%Y-%m') AS month, COUNT(claim_id) AS nb, {msum('montant_declare')} AS amount FROM claims GROUP BY 1"""
Q["b6_score_histogram"] = """
SELECT b AS score_bin, COUNT(s) AS nb FROM (SELECT unnest(['0-25 (low)', '26-50 (medium)', '51-75 (high)', '76-100 (critical)']) AS b, unnest([0, 1, 2, 3]) AS i)
  LEFT JOIN (SELECT CASE WHEN fraud_score <= 25 THEN 0 WHEN fraud_score <= 50 THEN 1 WHEN fraud_score <= 75 THEN 2 ELSE 3 END AS s FROM fraud) ON s = i GROUP BY b"""
Q["b7_rate_by_product"] = """
SELECT produit, COUNT(*) AS total, COUNT(*) FILTER (is_fraud_suspected) AS hits, COUNT(*) FILTER (is_fraud_suspected) / COUNT(*) * CAST(100 AS DOUBLE) AS rate
FROM fraud GROUP BY produit"""
Q["b8_score_by_region"] = "SELECT region_nom, AVG(fraud_score) AS avg_score FROM fraud f JOIN named n ON f.claim_id = n.claim_id GROUP BY region_nom"
Q["b9_trigger_totals"] = union(
    *[
        f"SELECT '{f}' AS rule, CAST(SUM({f}) AS BIGINT) AS triggers FROM flags"
        for f in ("flag_early_claim", "flag_high_amount", "flag_frequent_claimant", "flag_address_cluster", "flag_late_declaration")
    ]
)
Q["b10_paid_rate_by_product"] = f"""
SELECT *, indemnise / declare * 100 AS rate FROM (SELECT produit, {msum('montant_indemnise')} AS indemnise, {msum('montant_declare')} AS declare FROM silver GROUP BY produit)
WHERE declare <> 0"""
Q["b11_amount_by_type"] = f"SELECT type_sinistre, {mavg('montant_declare')} AS avg_amount, COUNT(claim_id) AS nb FROM claims GROUP BY type_sinistre"
Q["b12_loss_ratio_by_region"] = """
SELECT coalesce(r.nom, region_code) AS region_nom, round(AVG(loss_ratio), 6) AS avg_lr FROM quarterly LEFT JOIN regions r ON region_code = r.code GROUP BY 1"""


def tab(column, values, expr):
    cells = ", ".join(f'{expr.format(cond=f"{column} = {chr(39)}{v}{chr(39)}")} AS "{v}"' for v in values)
    known = ", ".join(f"'{v}'" for v in values)
    others = expr.format(cond=f"{column} NOT IN ({known})")
    return f"SELECT region_nom, {cells}, {others} AS autres FROM named WHERE {column} IS NOT NULL GROUP BY region_nom"


def fsum(x):
    return f"CAST(SUM(CAST(round({x} * 100) AS BIGINT)) FILTER ({{cond}}) AS DOUBLE) / 100"


Q["b13_crosstab_product"] = tab("produit", PRODUCTS, "COUNT(claim_id) FILTER ({cond})")
Q["b14_crosstab_type_amount"] = tab("type_sinistre", TYPES, f"coalesce({fsum('montant_declare')}, 0)")
Q["b14_crosstab_type_count"] = tab("type_sinistre", TYPES, "COUNT(claim_id) FILTER ({cond})")
Q["b15_crosstab_premium"] = tab("produit", PRODUCTS, f"coalesce({fsum('prime_annuelle')}, 0)")
Q["b15_crosstab_paid_rate"] = tab("produit", PRODUCTS, f"round(({fsum('montant_indemnise')}) / ({fsum('montant_declare')}) * 100, 1)")
Q["b16_histogram"] = """
SELECT produit, CAST(least(59, floor((montant_declare - lo) / ((hi - lo) / 60))) AS INTEGER) AS bin, COUNT(*) AS nb
FROM (SELECT *, MIN(montant_declare) OVER () AS lo, MAX(montant_declare) OVER () AS hi FROM silver
  WHERE montant_declare < (SELECT quantile_cont(montant_declare, 0.99) FROM silver)) GROUP BY 1, 2"""
Q["b17_kpi_listing"] = """
SELECT coalesce(r.nom, region_code) AS region, canal_vente AS channel, nb_polices AS policies, nb_sinistres AS claims,
  CAST(round(CAST(loss_ratio AS DECIMAL(18, 4)), 3) AS DOUBLE) AS loss_ratio, delai_moyen_declaration AS avg_filing_delay_d FROM quarterly LEFT JOIN regions r ON region_code = r.code"""
Q["b18_region_order"] = f"SELECT region_nom, {msum('montant_declare')} AS total_amount FROM named GROUP BY region_nom"
Q["b19_dominant_type"] = f"""
SELECT region_nom, type_sinistre AS dominant_risk, amount, claims FROM (SELECT region_nom, type_sinistre, {msum('montant_declare')} AS amount, COUNT(claim_id) AS claims
  FROM named GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY region_nom ORDER BY amount DESC, type_sinistre) = 1"""
Q["b20_churn_headline"] = """
SELECT COUNT(*) AS n_clients, round(AVG(churn_score), 6) AS avg_score, COUNT(*) FILTER (churn_segment = 'critique') AS n_critical,
  COUNT(*) FILTER (churn_segment = 'critique') * CAST(100 AS DOUBLE) / COUNT(*) AS pct_critical FROM churn"""
Q["b20_churn_by_segment"] = "SELECT churn_segment, COUNT(*) AS nb FROM churn GROUP BY churn_segment"
Q["b20_score_by_client_segment"] = "SELECT segment, round(AVG(churn_score), 6) AS avg_score FROM churn GROUP BY segment"
Q["b21_critical_by_region"] = """
SELECT coalesce(r.nom, region_code) AS region_nom, COUNT(*) AS total, COUNT(*) FILTER (churn_segment = 'critique') AS hits,
  COUNT(*) FILTER (churn_segment = 'critique') / COUNT(*) * CAST(100 AS DOUBLE) AS pct_critical FROM churn LEFT JOIN regions r ON region_code = r.code GROUP BY 1"""
Q["b22_five_numbers"] = """
SELECT churn_segment, MIN(churn_score) AS minimum, round(quantile_cont(churn_score, 0.25), 6) AS q1, round(quantile_cont(churn_score, 0.5), 6) AS median,
  round(quantile_cont(churn_score, 0.75), 6) AS q3, MAX(churn_score) AS maximum FROM churn GROUP BY churn_segment"""
Q["b_preview_exposure"] = f"SELECT * FROM ({EXPOSURE}) ORDER BY exposition_max DESC LIMIT 20"

# Privacy and upkeep

KEY = b"a key that only a test may know".ljust(64, b"\0")
IPAD, OPAD = ("".join(f"\\x{b ^ mask:02X}" for b in KEY) for mask in (0x36, 0x5C))
Q["x1_pseudonymise"] = f"""
SELECT client_id, sha256(BLOB '{OPAD}' || unhex(sha256(BLOB '{IPAD}' || encode(CAST(client_id AS VARCHAR))))) AS pseudonym, segment FROM clients"""
Q["x2_mask"] = "SELECT claim_id, statut, CAST(NULL AS DOUBLE) AS montant_declare FROM claims"
Q["x3_erase"] = "SELECT claim_id, client_id FROM claims WHERE client_id NOT IN (SELECT client_id FROM clients WHERE NOT actif)"
Q["x4_upsert"] = """
SELECT claim_id, CASE WHEN statut = 'refuse' THEN 'ouvert' ELSE statut END AS statut, montant_declare,
  CASE WHEN statut = 'refuse' THEN date_declaration + 30 ELSE date_declaration END AS date_declaration FROM claims"""
Q["x5_retain"] = "SELECT claim_id, date_sinistre FROM claims WHERE date_sinistre >= DATE '1997-01-01'"

# The jobs and what they leave behind. In the lake are the valid claims of the messy source; every closing date is missing in the raw file.

VALID = "(SELECT claim_id FROM checked WHERE len(broken) = 0)"
LAKE = f"""(SELECT s.* EXCLUDE (montant_declare, montant_provision, montant_indemnise, statut, type_sinistre), m.montant_declare,
    coalesce(m.montant_provision, 0) AS montant_provision, coalesce(m.montant_indemnise, 0) AS montant_indemnise, m.statut, m.type_sinistre,
    m.description, m.is_fraud_injected, greatest(DATE '2002-01-01' - s.date_declaration, 0) AS d
  FROM silver s JOIN checked m ON m.claim_id = CAST(s.claim_id AS VARCHAR) WHERE len(broken) = 0)"""
LAKE_LOSSES = f"""(SELECT *, CASE WHEN statut = 'clos' THEN montant_indemnise WHEN statut IN ('ouvert', 'en_cours', 'en_litige') THEN montant_provision
    ELSE 0 END AS incurred_loss FROM {LAKE})"""
LAKE_KPIS = f"({kpi_join('pkpis', f'({claims_agg(LAKE_LOSSES)})')})"
LAKE_AGED = f"""(SELECT *, annee_sinistre AS annee, CAST(d AS INTEGER) AS delai_traitement_jours,
    CASE WHEN d <= 7 THEN '0_7j' WHEN d <= 30 THEN '7_30j' WHEN d <= 90 THEN '30_90j' ELSE '90j_plus' END AS aging_bucket FROM {LAKE})"""
LAKE_POLICIES = f"""(SELECT *, CASE WHEN i IS NULL THEN 'inconnu' ELSE 'c' || i END AS garantie_code, prime_annuelle * i AS garantie_plafond,
    coalesce(i % 2 = 1, false) AS garantie_incluse, coalesce(prime_mensuelle, prime_annuelle / 12) AS mensuelle FROM {COVERAGES} WHERE prime_annuelle > 0)"""
LAKE_FLAGS = f"""(SELECT *, CASE WHEN date_sinistre - date_souscription >= 0 AND date_sinistre - date_souscription < 2 THEN 1 ELSE 0 END AS early,
    CASE WHEN delai_declaration_jours > 180 THEN 1 ELSE 0 END AS late FROM {LAKE})"""
REJECTS = "(SELECT * FROM checked WHERE len(broken) > 0)"


def content(table, src, texts, euros=""):
    """Number of rows, and a sum of 24 bits of a digest of each row."""
    parts = [f"coalesce(CAST({c} AS VARCHAR), '-')" for c in texts.split()]
    parts += [f"coalesce(CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR), '-')" for c in euros.split()]
    row = f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 6))::BIGINT"
    return union(
        f"""SELECT '{table}' AS "table", 'row_count' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM {src}""",
        f"SELECT '{table}', 'content', CAST(SUM({row}) AS DOUBLE) FROM {src}",
    )


Q["s_k_roundtrip"] = union(
    content(
        "bronze.claims", f"(SELECT *, 'b1' AS batch_id, CASE WHEN statut = 'clos' THEN montant_indemnise END AS paid FROM {LAKE})",
        "claim_id policy_id client_id statut type_sinistre description date_sinistre batch_id", "montant_declare paid",
    ),
    content("bronze.policies", LAKE_POLICIES, "policy_id garantie_code produit garantie_incluse", "prime_annuelle garantie_plafond"),
    content("bronze.clients", "clients", "client_id client_type nom segment date_creation"),
    content("bronze.payments", "payments", "payment_id client_id statut date_paiement"),
    content("dead_letter_queue.claims", REJECTS, "claim_id statut type_sinistre", "montant_declare"),
    content("silver.claims", LAKE, "claim_id statut type_sinistre date_sinistre delai_declaration_jours annee_sinistre mois_sinistre produit", "montant_provision"),
    content("silver.policies", LAKE_POLICIES, "policy_id garantie_code date_souscription", "mensuelle"),
    content("silver.clients", "clients", "client_id region_code"),
    content("gold.portfolio_kpis", LAKE_KPIS, "produit region_code canal_vente annee trimestre nb_polices nb_sinistres", "earned_premium incurred_losses"),
    content("gold.earned_premium", "premiums", "policy_id annee", "earned_premium"),
    content("gold.fraud_assessment", LAKE_FLAGS, "claim_id produit date_sinistre early late", "montant_declare"),
    content("gold.loss_ratio", LAKE_KPIS, "produit trimestre"),
    content("gold.churn_scores", "clients", "client_id segment"),
    content("gold.claims_aging_detail", LAKE_AGED, "claim_id delai_traitement_jours aging_bucket"),
    content(
        "gold.claims_aging_summary",
        f"(SELECT type_sinistre, aging_bucket, statut, annee, produit, COUNT(*) AS nb FROM {LAKE_AGED} GROUP BY ALL)",
        "type_sinistre aging_bucket statut annee produit nb",
    ),
    content(
        "gold.portfolio_exposure", f"(SELECT e.*, r.nom FROM ({EXPOSURE}) e LEFT JOIN regions r ON e.region_code = r.code)",
        "region_code produit canal_vente nb_polices nom", "prime_totale",
    ),
    content("gold.concentration_risk", f"(SELECT produit, {msum('prime_annuelle')} AS t FROM active GROUP BY produit)", "produit", "t"),
)

Q["s1_claims_by_header"] = """
SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(client_id AS VARCHAR) AS client_id, statut, montant_declare, CAST(date_sinistre AS VARCHAR) AS date_sinistre,
  CASE WHEN claim_id % 3 = 0 THEN 'r' || claim_id END AS remarque FROM claims"""
Q["s1_broken_records"] = """
SELECT claim_id || ',' || policy_id AS record, 'malformed_record' AS rules, 'b1' AS _batch_id FROM claims WHERE policy_id % 50 = 0"""
Q["s2_policies_by_variant"] = """
SELECT CAST(policy_id AS VARCHAR) AS policy_id, floor(prime_annuelle) AS prime_annuelle,
  CAST(CASE WHEN policy_id % 13 = 0 THEN 0 ELSE policy_id % 4 END AS DOUBLE) AS franchise, 'c1' AS garantie_code, floor(prime_annuelle) AS garantie_plafond,
  CASE WHEN policy_id % 13 = 0 THEN '{"franchise":"\\"n/a\\"","origine":"\\"web\\""}' ELSE '{"origine":"\\"web\\""}' END AS rescued
FROM policies WHERE policy_id % 7 <> 0 AND policy_id % 11 <> 0"""
Q["s2_broken_objects"] = """
SELECT '{"policy_id":"' || policy_id || '","client_id":"' || client_id || '","produit":"' || produit || '","date_souscription":"' || date_souscription
    || '","date_echeance":"' || date_echeance || '","canal_vente":"' || canal_vente || '","statut":"' || statut || '","prime_annuelle":'
    || CASE WHEN policy_id % 11 = 0 THEN '"abc"' ELSE CAST(CAST(floor(prime_annuelle) AS BIGINT) AS VARCHAR) END
    || ',"franchise":' || CASE WHEN policy_id % 13 = 0 THEN '"n/a"' ELSE CAST(policy_id % 4 AS VARCHAR) END
    || ',"garanties":[{"code":"C1","plafond":' || CAST(floor(prime_annuelle) AS BIGINT) || '}],"origine":"web"' || CASE WHEN policy_id % 7 = 0 THEN '' ELSE '}' END AS record,
  CASE WHEN policy_id % 7 = 0 THEN 'malformed_record' ELSE 'prime_annuelle_missing,prime_annuelle_not_positive' END AS rules,
  CASE WHEN policy_id % 7 = 0 THEN '' WHEN policy_id % 13 = 0 THEN 'prime_annuelle,franchise' ELSE 'prime_annuelle' END AS paths
FROM policies WHERE policy_id % 7 = 0 OR policy_id % 11 = 0"""
_messages = {
    "missing columns": "[claims] missing columns: [''client_id'', ''statut'']",
    "unknown entity": "unknown entity ''boats''; known: [''claims'', ''clients'', ''payments'', ''policies'']",
    "drifted types": "[claims] missing column: devise; wrong type: montant_declare is string, not double",
    "as expected": "ok",
}
Q["v1_schema_messages"] = union(*[f"""SELECT '{k}' AS "case", '{v}' AS message, COUNT(*) AS "rows" FROM claims""" for k, v in _messages.items()])

CLAIM_COUNTS = "SELECT COUNT(*) AS n, COUNT(*) FILTER (len(broken) = 0) AS ok FROM checked"
POLICY_COUNTS = f"SELECT COUNT(*) AS n, COUNT(*) FILTER (prime_annuelle > 0) AS ok FROM {COVERAGES}"
Q["m5_run_steps"] = union(
    *[
        f"SELECT '{run}' AS run_id, CAST({i} AS INTEGER) AS position, '{step}' AS step, 'ok' AS status, n AS nb_in, ok AS nb_out, n - ok AS nb_rejected FROM ({counts})"
        for run in ("b1", "b2")
        for i, (step, counts) in enumerate((("claims", CLAIM_COUNTS), ("policies", POLICY_COUNTS)), 1)
    ]
)
_N = {
    "(SELECT COUNT(*) FROM checked WHERE len(broken) = 0)": 4,  # Bronze and Silver claims, fraud, aging detail
    f"(SELECT COUNT(*) FROM {LAKE_POLICIES})": 2,
    "(SELECT COUNT(*) FROM clients)": 3,
    "(SELECT COUNT(*) FROM payments)": 1,
    "(SELECT COUNT(*) FROM pkpis)": 2,
    "(SELECT COUNT(*) FROM policies)": 1,
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT type_sinistre, aging_bucket, statut, annee, produit FROM {LAKE_AGED}))": 1,
    f"(SELECT COUNT(*) FROM ({EXPOSURE}))": 1,
    "(SELECT COUNT(DISTINCT produit) FROM active)": 1,
}
Q["m5_run_summary"] = f"""
SELECT 'b1' AS run_id, n AS total_records_out, r AS total_rejected, round(r / greatest(n, 1) * CAST(100 AS DOUBLE), 4) AS rejection_rate_pct
FROM (SELECT {" + ".join(f"{k} * {v}" for k, v in _N.items())} AS n,
  (SELECT COUNT(*) FROM {REJECTS}) + (SELECT COUNT(*) FROM {COVERAGES} WHERE NOT coalesce(prime_annuelle > 0, false)) AS r)"""


def suite(name, body):
    return f"""SELECT '{name}' AS suite, "check", round(observed, 9) AS observed, threshold, passed FROM ({body})"""


Q["q22_lake_checks"] = union(
    suite("bronze", Q["q_bronze_suite"].replace("FROM claims", f"FROM {LAKE}").replace("FROM policies", f"FROM {LAKE_POLICIES}")),
    suite("silver", Q["q_silver_suite"].replace("FROM silver", f"FROM {LAKE}").replace("FROM quarterly", f"FROM {LAKE_KPIS}")),
)
Q["m4_lake_tables"] = union(
    *[
        f"""SELECT '{table}' AS "table", '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM {src}"""
        for table, name, value, src in (
            ("silver_claims", "row_count", "COUNT(*)", LAKE), ("silver_claims", "injected_fraud_count", "COUNT(*) FILTER (is_fraud_injected)", LAKE),
            ("silver_clients", "row_count", "COUNT(*)", "clients"), ("silver_policies", "row_count", "COUNT(*)", LAKE_POLICIES),
            ("gold_portfolio_kpis", "row_count", "COUNT(*)", "pkpis"), ("gold_fraud_assessment", "row_count", "COUNT(*)", LAKE),
            ("gold_churn_scores", "row_count", "COUNT(*)", "clients"), ("gold_loss_ratio", "row_count", "COUNT(*)", "pkpis"),
        )
    ]
)
Q["m1_lake_nulls"] = union(
    *null_pct("bronze", "claims", LAKE, ("claim_id", "policy_id", "client_id", "date_sinistre", "montant_declare", "statut")),
    *null_pct("bronze", "policies", LAKE_POLICIES, ("policy_id", "client_id", "produit", "prime_annuelle")),
    *null_pct("silver", "claims", f"(SELECT * REPLACE (CAST(NULL AS DATE) AS date_cloture) FROM {LAKE})", ("claim_id", "date_sinistre", "date_cloture", "delai_declaration_jours", "produit")),
    *null_pct("silver", "clients", "clients", ("client_id", "segment", "region_code")),
    *null_pct("gold", "fraud_assessment", f"(SELECT claim_id, 0 AS fraud_score FROM {LAKE})", ("claim_id", "fraud_score")),
)
Q["m1_lake_duplicates"] = union(
    *[
        f"""SELECT '{table}' AS "table", COUNT(*) AS total, COUNT(DISTINCT {key}) AS "distinct", COUNT(*) - COUNT(DISTINCT {key}) AS duplicates FROM {src}"""
        for table, key, src in (
            ("bronze_claims", "claim_id", LAKE), ("bronze_policies", "policy_id", LAKE_POLICIES), ("silver_claims", "claim_id", LAKE),
            ("silver_clients", "client_id", "clients"), ("gold_fraud_assessment", "claim_id", LAKE), ("gold_churn_scores", "client_id", "clients"),
        )
    ]
)
Q["k8_exports"] = union(
    f"""SELECT 'claims' AS "table", 'claim_id,policy_id,type_sinistre,date_sinistre,montant_declare,montant_indemnise,prime_annuelle,statut,produit,region_code,delai_declaration_jours' AS columns,
    COUNT(*) AS "rows", CAST(SUM(claim_id) AS BIGINT) AS key_sum FROM {LAKE}""",
    f"""SELECT 'fraud_assessment', 'claim_id,produit,fraud_score,is_fraud_suspected,flag_early_claim,flag_high_amount,flag_frequent_claimant,flag_address_cluster,flag_late_declaration',
    COUNT(*), CAST(SUM(claim_id) AS BIGINT) FROM {LAKE}""",
    "SELECT 'portfolio_kpis', 'region_code,canal_vente,nb_polices,nb_sinistres,loss_ratio,delai_moyen_declaration', COUNT(*), CAST(SUM(nb_polices) AS BIGINT) FROM pkpis",
    "SELECT 'churn_scores', 'client_id,segment,churn_score,churn_segment,region_code', COUNT(*), CAST(SUM(client_id) AS BIGINT) FROM clients",
)


def kept(table, key, src):
    return union(
        f"""SELECT '{table}' AS "table", 'row_count' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM {src}""",
        f"SELECT '{table}', 'key_sum', CAST(SUM({key}) AS DOUBLE) FROM {src}",
    )


Q["x3_erase_closure"] = union(
    kept("silver.claims", "claim_id", "(SELECT * FROM claims WHERE client_id % 500 <> 7)"),
    kept("silver.policies", "policy_id", "(SELECT * FROM policies WHERE client_id % 500 <> 7)"),
    kept("silver.clients", "client_id", "(SELECT * FROM clients WHERE client_id % 500 <> 7)"),
    kept("bronze.payments", "payment_id", "(SELECT * FROM payments WHERE NOT (client_id % 500 = 7 AND client_id IN (SELECT client_id FROM clients)))"),
    kept("dead_letter_queue.claims", "claim_id", "(SELECT claim_id, unnest([1, 2]) FROM claims WHERE claim_id % 97 = 0 AND client_id % 500 <> 7)"),
)
Q["x4_correct_partitions"] = """
SELECT CAST(claim_id AS VARCHAR) AS claim_id, statut, date_sinistre, CAST(year(date_sinistre) AS VARCHAR) AS annee_sinistre, strftime(date_sinistre, '%m') AS mois_sinistre
FROM (SELECT claim_id, CASE WHEN policy_id % 200 = 0 THEN 'clos' ELSE statut END AS statut,
  CASE WHEN policy_id % 200 = 0 THEN date_sinistre + 400 ELSE date_sinistre END AS date_sinistre FROM claims)"""
Q["x5_expire"] = "SELECT CAST(claim_id AS VARCHAR) AS claim_id, date_sinistre FROM claims WHERE date_sinistre >= DATE '1997-03-15'"
RATES = """(SELECT year(date_souscription) * 12 + month(date_souscription) - 1 AS month, COUNT(*) % 40 / CAST(100 AS DOUBLE) AS rate
    FROM policies GROUP BY 1 HAVING month % 5 <> 0)"""
Q["s9_constant_money"] = f"""
SELECT claim_id, round(round(montant_declare * (SELECT exp(SUM(ln(1 + rate / 100))) FROM {RATES}) / index, 2), 1) AS montant_constant
FROM (SELECT *, year(date_sinistre) * 12 + month(date_sinistre) - 1 AS m FROM claims) c
  ASOF LEFT JOIN (SELECT month, exp(SUM(ln(1 + rate / 100)) OVER (ORDER BY month)) AS index FROM {RATES}) i ON c.m >= i.month"""
Q["a12_exact_cells"] = """
SELECT type_sinistre, statut, round(quantile_cont(CAST(delai_traitement_jours AS DOUBLE), 0.5), 6) AS median,
  round(quantile_cont(CAST(delai_traitement_jours AS DOUBLE), 0.9), 6) AS p90 FROM aged WHERE delai_traitement_jours IS NOT NULL GROUP BY ALL"""
Q["a12_merged_sketches"] = "SELECT type_sinistre, statut, COUNT(*) AS nb, true AS median_within, true AS p90_within FROM aged GROUP BY ALL"
Q["a14_key_sets"] = """
SELECT COUNT(*) AS n_bronze, COUNT(statut) AS n_silver, true AS bronze_within, true AS silver_within, true AS both_within, true AS lost_within FROM messy"""
Q["a14_duplicates"] = union(
    "SELECT 'policy' AS key, COUNT(*) = COUNT(DISTINCT l_orderkey) AS passed FROM lineitem",
    "SELECT 'line', COUNT(*) = COUNT(DISTINCT l_orderkey || '-' || l_linenumber) FROM lineitem",
)

ORACLES = {name: PREFIX + body.strip() for name, body in Q.items()}

"""Fixed values of the source data: codes, rosters, names and thresholds."""

from __future__ import annotations

# Bloc roster as (unit, first year, last year, name); 9999 is open.
BLOC_ROSTER = [
    (101, 2004, 9999, "Venezuela"),
    (40, 2004, 9999, "Cuba"),
    (145, 2006, 2019, "Bolivia"),
    (93, 2007, 9999, "Nicaragua"),
    (53, 2008, 9999, "Dominica"),
    (91, 2008, 2010, "Honduras"),
    (130, 2009, 2018, "Ecuador"),
    (58, 2009, 9999, "Antigua & Barbuda"),
    (56, 2009, 9999, "St. Vincent & Grenadines"),
    (57, 2013, 9999, "St. Lucia"),
    (55, 2014, 9999, "Grenada"),
    (60, 2014, 9999, "St. Kitts & Nevis"),
]

# Named trade partners and the partner bloc.
TRADE_PARTNERS = {"usa": [2], "china": [710], "venezuela": [101], "alba_bloc": [40, 145, 93, 53, 91, 130, 58, 56, 57, 55, 60]}

# Code and name overrides of the unit crosswalks.
ISO3_OVERRIDES = {"CSK": 315, "SUN": 365, "YUG": 345, "SRB": 345}
ISO2_OVERRIDES = {"CS": 315, "SU": 365, "YU": 345, "RS": 345}
RESOURCE_NAME_OVERRIDES = {
    "Czechoslovakia": 315,
    "Soviet Union": 365,
    "Yugoslavia": 345,
    "Serbia": 345,
    "Serbia and Montenegro": 345,
    "Yemen People's Republic": 680,
    "Yemen Arab Republic": 678,
    "German Federal Republic": 260,
    "German Democratic Republic": 265,
}
INEQUALITY_NAME_OVERRIDES = {
    "Serbia": 345,
    "Micronesia": 987,
    "Anguilla": None,
    "Greenland": None,
    "Hong Kong": None,
    "Palestinian Territories": None,
    "Puerto Rico": None,
    "Turks and Caicos Islands": None,
}

# Indicator codes and their short names.
ECONOMY_INDICATORS = {"NY.GDP.PCAP.PP.KD": "gdp_pc", "SP.POP.TOT": "pop", "NY.GDP.TOTL.RT.ZS": "resource_rents"}
GOVERNANCE_INDICATORS = {"CC.EST": "corruption_control", "GE.EST": "govt_effectiveness"}

# Ideology labels and their codes.
IDEOLOGY_CODES = {"leftist": 1, "centrist": 2, "rightist": 3}

# Share columns of the religion series.
SHARE_COLUMNS = [
    "chrstprotpct",
    "chrstcatpct",
    "chrstorthpct",
    "chrstgenpct",
    "judgenpct",
    "islmgenpct",
    "budgenpct",
    "hindgenpct",
    "nonreligpct",
    "sumreligpct",
]

# Original tags kept in the base panel.
BASE_TAGS = [
    "country_name",
    "year",
    "country_id",
    "country_text_id",
    "COWcode",
    "v2x_polyarchy",
    "v2x_libdem",
    "v2x_partipdem",
    "v2xdl_delib",
    "v2x_egaldem",
    "v2x_neopat",
    "v2exl_legitideol",
    "v2exl_legitideolcr",
    "v2exl_legitlead",
    "v2exl_legitperf",
    "v2exl_legitratio",
    "v2regsupgroupssize",
    "v2regoppgroupssize",
    "v2regsupgroups",
    "v2regoppgroups",
    "v2regproreg",
    "v2regantireg",
    "v2x_rule",
    "v2xcl_acjst",
    "v2xcl_prpty",
    "v2cltrnslw",
    "v2clrspct",
    "v2clacjstm",
    "v2clacjstw",
    "v2clprptym",
    "v2clprptyw",
    "v2x_corr",
]

# Name patterns of the base panel.
BASE_KEEP_PARTS = ["reg_trans", "aut_", "dem_"]
BASE_DROP_PREFIXES = ["v3"]
BASE_DROP_SUFFIXES = ["_codelow", "_codehigh", "_sd", "_mean", "_nr", "_osp", "_ord"]

# Alternative column names of the unit table.
MONAD_ALIASES = {
    "gdpmer2011usd": ["gdpmer2011usda"],
    "milex2011usdmil": ["milex2011usdmila"],
    "milstock": ["milstocka"],
    "igos": ["igosa"],
    "igoscount": ["igosaccount"],
    "country": ["countrya"],
    "iso3": ["iso3a"],
    "unregion": ["unregiona"],
}

# Leader columns attached to both sides of a pair.
LEADER_COLUMNS = [
    "leader_name",
    "leader_id",
    "leader_tenure_years",
    "leader_tenure_days",
    "leader_first_year",
    "leader_last_year",
    "leader_age",
    "gender",
    "entry_type",
    "exit_type",
    "exitcode",
    "post_tenure_fate",
    "previous_times",
]

# The pair table's column contract.
DYAD_CORE_COLUMNS = [
    "COWcode_a",
    "COWcode_b",
    "year",
    "v2x_libdem_a",
    "v2x_libdem_b",
    "hihosta",
    "v2exl_legitideol_a",
    "v2exl_legitlead_a",
    "v2exl_legitperf_a",
    "sidea_national_military_capabilities",
    "sideb_national_military_capabilities",
]
DYAD_OPTIONAL_COLUMNS = [
    "sidea_revisionist_domestic",
    "sidea_religious_support",
    "sidea_party_elite_support",
    "sidea_rural_worker_support",
    "sidea_ethnic_racial_support",
    "sidea_military_support",
    "sidea_nationalist_revisionist_domestic",
    "sidea_socialist_revisionist_domestic",
    "sidea_religious_revisionist_domestic",
    "sidea_reactionary_revisionist_domestic",
    "sidea_dynamic_leader",
    "sidea_winning_coalition_size",
]
DYAD_ALIASES = {
    "COWcode_a": ["statea", "ccode_a", "ccodea"],
    "COWcode_b": ["stateb", "ccode_b", "ccodeb"],
    "sidea_national_military_capabilities": ["cinc_a", "nmc_a", "cow_cinc_a", "national_capabilities_a"],
    "sideb_national_military_capabilities": ["cinc_b", "nmc_b", "cow_cinc_b", "national_capabilities_b"],
    "sidea_religious_support": ["religious_support_a"],
    "sidea_party_elite_support": ["party_elite_support_a"],
    "sidea_rural_worker_support": ["rural_worker_support_a"],
    "sidea_military_support": ["military_support_a"],
    "sidea_ethnic_racial_support": ["ethnic_racial_support_a"],
    "sidea_revisionist_domestic": ["revisionist_domestic_a"],
    "sidea_nationalist_revisionist_domestic": ["nationalist_revisionist_domestic_a"],
    "sidea_socialist_revisionist_domestic": ["socialist_revisionist_domestic_a"],
    "sidea_religious_revisionist_domestic": ["religious_revisionist_domestic_a"],
    "sidea_reactionary_revisionist_domestic": ["reactionary_revisionist_domestic_a"],
    "sidea_dynamic_leader": ["dynamic_leader_a"],
    "sidea_winning_coalition_size": ["winning_coalition_size_a", "w_a", "wcs_a"],
}

# Variables reported and typed in the codebook.
BINARY_VARIABLES = [
    "is_petro_state",
    "is_aut_episode",
    "is_dem_episode",
    "alba_member",
    "mid_onset",
    "is_leftist_leader",
    "is_rightist_leader",
]
ORDINAL_VARIABLES = ["gli_leader_ideology_num", "fatality"]

# Imputation targets and predictors.
IMPUTE_TARGETS = ["fraser_bmp_score", "gini_disp", "resource_rents", "log_oil_gas_wealth", "unified_gdp_pc", "unified_pop"]
IMPUTE_PREDICTORS = ["year", "v2x_libdem", "is_petro_state", "unified_corruption", "COWcode"]

# Feature roles of the sequence table.
SEQUENCE_CLIPPED = ["unified_gdp_pc", "unified_pop", "resource_rents"]
SEQUENCE_LOGS = {"log_gdp_pc": "unified_gdp_pc", "log_pop": "unified_pop"}
SEQUENCE_REALS = [
    "unified_gdp_pc",
    "log_gdp_pc",
    "unified_pop",
    "fraser_bmp_score",
    "unified_corruption",
    "resource_rents",
    "gini_disp",
    "atop_defense_with_auto",
]
SEQUENCE_CATEGORIES = [
    "is_petro_state",
    "is_aut_episode",
    "is_dem_episode",
    "alba_member",
    "mid_count_total",
    "mid_high_fatality_event",
    "is_leftist_leader",
    "is_rightist_leader",
    "gli_leader_ideology_num",
    "mid_max_fatality_cat",
    "mid_max_hostility",
]

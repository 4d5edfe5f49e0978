"""The same views and queries in SQL, for an independent engine."""

from __future__ import annotations

import re

from workload.views import NAME_OVERRIDES, NAME_PATTERNS, ROSTER

_roster = ", ".join(f"({u}, {a}, {b})" for u, a, b in ROSTER)
_patterns = ", ".join(f"('{p}', {u})" for p, u in NAME_PATTERNS)
_name_override = " ".join(
    f"WHEN name = '{n}' THEN {'NULL' if u is None else u}" for n, u in NAME_OVERRIDES.items()
)

VIEWS = {
    "windows": """
        SELECT user_id, event_id AS "window", CASE WHEN event_id % 77 <> 0 THEN ts END AS opened,
               CASE WHEN event_id % 35 <> 0 THEN ts + to_seconds(event_id * 37 % 20000 - 300) END AS closed
        FROM events WHERE event_id % 7 = 0""",
    "unit_orders": """
        SELECT c_nationkey AS u, CAST(year(o_orderdate) AS INT) AS y, o_orderkey, o_custkey, o_orderstatus,
               o_totalprice, o_orderpriority, c_mktsegment, CAST(o_orderdate AS DATE) AS o_day
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "links": """
        SELECT s_nationkey AS a, c_nationkey AS b, CAST(year(l_shipdate) AS INT) AS y, l_linenumber, l_quantity,
               l_extendedprice, l_returnflag, l_linestatus
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "flows": """
        SELECT a, b, y, count(*) AS n_links, sum(l_extendedprice) AS value, sum(l_quantity) AS quantity
        FROM links GROUP BY a, b, y""",
    "disputes": """
        SELECT a AS statea, b AS stateb, y AS year, l_linenumber AS dyad_rolea,
               CASE WHEN (a + y) % 7 = 0 OR l_returnflag = 'N' THEN -9
                    ELSE 1 + CAST(l_quantity AS INT) % 5 END AS hihosta,
               CASE WHEN (a + y) % 7 = 0 OR l_linestatus = 'F' THEN -9
                    ELSE CAST(l_quantity AS INT) % 7 END AS fatlev
        FROM links""",
    "trade": """
        SELECT a AS exporter_cow, b AS importer_cow, y AS year,
               100 * value / sum(value) OVER (PARTITION BY a, y) AS RED_export_importance,
               CASE WHEN NOT (a + b + y) % 9 = 0
                    THEN 100 * quantity / sum(quantity) OVER (PARTITION BY a, y) END AS RED_import_importance
        FROM flows""",
    "alliances": """
        SELECT a AS stateA, b AS stateB, y AS year, CAST(n_links % 2 AS INT) AS defense,
               CASE WHEN n_links % 3 = 0 THEN 1 ELSE 0 END AS offense,
               CASE WHEN n_links % 5 = 0 THEN 1 ELSE 0 END AS nonagg,
               CASE WHEN n_links % 7 <> 0 THEN CAST(n_links % 2 AS INT) END AS consul
        FROM flows""",
    "measures": """
        SELECT u, y, count(*) AS n, avg(o_totalprice) AS avg_price, sum(o_orderkey % 1000) AS k
        FROM unit_orders GROUP BY u, y""",
    "crosswalk": "SELECT n_name AS code, n_nationkey AS unit FROM nation WHERE n_nationkey <> 24",
    "panel": """
        SELECT COWcode, year, country_name,
               CASE WHEN NOT (COWcode + year) % 6 = 0
                    THEN ((n * 37 + COWcode * 11 + year * 7) % 101) / 100 END AS v2x_libdem,
               CASE WHEN NOT (COWcode + year * 2) % 5 = 0
                    THEN ((n * 13 + COWcode * 5 + year * 3) % 97) / 96 END AS v2x_corr,
               CASE WHEN NOT (COWcode * 3 + year) % 8 = 0
                    THEN ((n * 53 + COWcode * 29 + year * 17) % 4001) / 1000 - 2 END AS v2exl_legitideol,
               CASE WHEN NOT (COWcode + year) % 11 = 0
                    THEN ((n * 19 + COWcode * 7 + year) % 1000) / 10 END AS islmgenpct,
               CASE WHEN NOT (COWcode + year) % 13 = 0
                    THEN ((n * 23 + COWcode * 3 + year) % 1000) / 10 END AS chrstgenpct
        FROM (SELECT n_nationkey AS COWcode, n_name AS country_name, CAST(g AS INT) AS year
              FROM nation, range(1993, 2004) t(g)
              WHERE n_nationkey IN (SELECT u FROM measures)) grid
        LEFT JOIN measures ON u = COWcode AND y = year""",
    "roster": f"SELECT * FROM (VALUES {_roster}) t(unit, start_year, end_year)",
    "bloc": """
        SELECT p.*,
               CASE WHEN COWcode > 5 AND COWcode < 20 AND year >= 1996 THEN 1 ELSE 0 END AS alba_possible,
               CASE WHEN EXISTS (SELECT 1 FROM roster WHERE unit = COWcode AND year BETWEEN start_year AND end_year)
                    THEN 1 ELSE 0 END AS alba_member
        FROM panel p""",
    "ideology": """
        SELECT CASE WHEN u <> 3 THEN u END AS country_code_cow, y AS year,
               CASE arg_max(o_orderpriority, o_orderkey) WHEN '1-URGENT' THEN 'leftist' WHEN '2-HIGH' THEN 'centrist'
                    WHEN '3-MEDIUM' THEN 'rightist' WHEN '4-NOT SPECIFIED' THEN 'no information' END AS leader_ideology,
               CASE arg_max(c_mktsegment, o_orderkey) WHEN 'BUILDING' THEN 'leftist' WHEN 'FURNITURE' THEN 'centrist'
                    WHEN 'MACHINERY' THEN 'rightist' WHEN 'HOUSEHOLD' THEN 'no information' END AS hog_ideology
        FROM unit_orders GROUP BY u, y""",
    "history": """
        SELECT 'NATION_' || u AS countrycode, y AS year,
               CASE WHEN NOT o_orderkey % 5 = 0 THEN o_totalprice / 7 END AS gdppc,
               CAST(o_orderkey % 1000 AS DOUBLE) AS pop
        FROM unit_orders""",
    "history_coded": """
        SELECT h.*, CASE WHEN countrycode = 'NATION_24' THEN 23 WHEN countrycode = 'NATION_13' THEN NULL
                         ELSE unit END AS COWcode
        FROM history h LEFT JOIN crosswalk ON code = countrycode""",
    "gdp_history": """
        SELECT COWcode, year, avg(gdppc) AS maddison_gdp_pc, avg(pop * 1000) AS maddison_pop
        FROM history_coded WHERE COWcode IS NOT NULL GROUP BY COWcode, year""",
    "economy": """
        SELECT 'NATION_' || u AS iso2c, y AS year,
               CASE WHEN NOT (u + y) % 3 = 0 THEN avg_price / 7 END AS gdp_pc,
               CASE WHEN NOT (u * 2 + y) % 5 = 0 THEN n * 1000.0 END AS pop,
               CASE WHEN NOT (u + y) % 4 = 0 THEN (n * 17 + u) % 31 END AS resource_rents,
               CASE WHEN NOT (u + y) % 3 <> 0 THEN ((n * 7 + y) % 501) / 100 - 2.5 END AS corruption_control,
               CASE WHEN NOT (u * 5 + y) % 4 < 2 THEN ((n * 11 + y) % 501) / 100 - 2.5 END AS govt_effectiveness
        FROM measures""",
    "reduced": """
        SELECT CASE WHEN iso2c = 'NATION_24' THEN 23 ELSE unit END AS COWcode, year,
               avg(gdp_pc) AS wdi_gdp_pc, CAST(sum(pop) AS DOUBLE) AS wdi_pop, avg(resource_rents) AS resource_rents,
               avg(corruption_control) AS corruption_control, avg(govt_effectiveness) AS govt_effectiveness
        FROM economy LEFT JOIN crosswalk ON code = iso2c
        WHERE iso2c <> 'NATION_13' AND (unit IS NOT NULL OR iso2c = 'NATION_24')
        GROUP BY 1, 2""",
    "indicators": """
        SELECT COWcode, year, wdi_gdp_pc, wdi_pop, resource_rents,
               coalesce(corruption_control, c0 + (c1 - c0) * (year - ct0) / nullif(ct1 - ct0, 0), c0, c1) AS corruption_control,
               coalesce(govt_effectiveness, g0 + (g1 - g0) * (year - gt0) / nullif(gt1 - gt0, 0), g0, g1) AS govt_effectiveness
        FROM (SELECT *,
                last_value(corruption_control IGNORE NULLS) OVER p AS c0,
                last_value(CASE WHEN corruption_control IS NOT NULL THEN year END IGNORE NULLS) OVER p AS ct0,
                first_value(corruption_control IGNORE NULLS) OVER f AS c1,
                first_value(CASE WHEN corruption_control IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ct1,
                last_value(govt_effectiveness IGNORE NULLS) OVER p AS g0,
                last_value(CASE WHEN govt_effectiveness IS NOT NULL THEN year END IGNORE NULLS) OVER p AS gt0,
                first_value(govt_effectiveness IGNORE NULLS) OVER f AS g1,
                first_value(CASE WHEN govt_effectiveness IS NOT NULL THEN year END IGNORE NULLS) OVER f AS gt1
              FROM reduced
              WINDOW p AS (PARTITION BY COWcode ORDER BY year ROWS UNBOUNDED PRECEDING),
                     f AS (PARTITION BY COWcode ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    "named_orders": """
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'NATION_' || u ELSE 'Rep. NATION_' || u END AS name,
               y AS year, o_orderkey, o_totalprice
        FROM unit_orders""",
    "name_units": f"""
        SELECT name,
               CAST(CASE {_name_override}
                    WHEN count(DISTINCT unit) = 1 THEN max(unit) END AS INT) AS unit,
               CAST(count(DISTINCT unit) AS INT) AS n_matches,
               CASE WHEN name IN ('Rep. NATION_5', 'Rep. NATION_6') THEN 'override'
                    WHEN count(DISTINCT unit) = 0 THEN 'unmatched'
                    WHEN count(DISTINCT unit) > 1 THEN 'ambiguous' ELSE 'matched' END AS status
        FROM (SELECT DISTINCT name FROM named_orders)
        LEFT JOIN (VALUES {_patterns}) t(pattern, unit) ON regexp_matches(name, pattern)
        GROUP BY name""",
    "named_units": """
        SELECT o.*, unit AS COWcode FROM named_orders o JOIN name_units USING (name) WHERE unit IS NOT NULL""",
    "resources": """
        SELECT COWcode, year, oil_gas_pop, CASE WHEN oil_gas_pop > 100 THEN 1 ELSE 0 END AS is_petro_state_ross
        FROM (SELECT COWcode, year, o_totalprice / 1900 AS oil_gas_pop,
                     row_number() OVER (PARTITION BY COWcode, year ORDER BY o_orderkey) AS r FROM named_units)
        WHERE r = 1""",
    "gini": "SELECT COWcode, year, avg(o_totalprice / 7 % 60) AS gini_disp FROM named_units GROUP BY COWcode, year",
    "premium": """
        SELECT COWcode, year, avg(gdppc / 100) AS fraser_bmp_score FROM history_coded
        WHERE COWcode IS NOT NULL GROUP BY COWcode, year""",
    "unified": """
        SELECT *, CASE WHEN unified_gdp_pc > 0 THEN ln(unified_gdp_pc) END AS log_gdp_pc,
               CASE WHEN unified_pop > 0 THEN ln(unified_pop) END AS log_pop
        FROM (SELECT p.COWcode, p.year, maddison_gdp_pc, maddison_pop, wdi_gdp_pc, wdi_pop, resource_rents,
                     corruption_control, govt_effectiveness, oil_gas_pop, is_petro_state_ross, gini_disp,
                     fraser_bmp_score, coalesce(wdi_gdp_pc, maddison_gdp_pc) AS unified_gdp_pc,
                     coalesce(wdi_pop, maddison_pop) AS unified_pop,
                     coalesce(is_petro_state_ross, CASE WHEN resource_rents > 10 THEN 1 ELSE 0 END) AS is_petro_state,
                     CASE WHEN oil_gas_pop + 1 > 0 THEN ln(oil_gas_pop + 1) END AS log_oil_gas_wealth
              FROM panel p
              LEFT JOIN gdp_history h ON h.COWcode = p.COWcode AND h.year = p.year
              LEFT JOIN indicators i ON i.COWcode = p.COWcode AND i.year = p.year
              LEFT JOIN (SELECT COWcode, year, CASE WHEN year % 2 = 0 THEN oil_gas_pop END AS oil_gas_pop,
                                CASE WHEN year % 2 = 0 AND oil_gas_pop > 100 THEN 1 ELSE 0 END AS is_petro_state_ross
                         FROM resources) r ON r.COWcode = p.COWcode AND r.year = p.year
              LEFT JOIN gini g ON g.COWcode = p.COWcode AND g.year = p.year
              LEFT JOIN premium f ON f.COWcode = p.COWcode AND f.year = p.year)""",
    "episodes": """
        SELECT u AS country_id, y AS year,
               CASE WHEN (n + u) % 3 = 0 THEN u || '_' || y END AS aut_ep_id,
               CASE WHEN (n + u) % 4 = 0 THEN u || '_' || y END AS dem_ep_id,
               CAST(n % 2 AS INT) AS aut_founding_elec, CAST(n % 3 AS INT) AS reg_trans,
               CAST(n % 5 AS INT) AS row_regtrans
        FROM measures""",
    "dispute_units": """
        SELECT statea, year, count(*) AS mid_count_total,
               count(*) FILTER (dyad_rolea = 1) AS mid_count_initiated,
               count(*) FILTER (dyad_rolea = 3) AS mid_count_targeted,
               max(nullif(hihosta, -9)) AS mid_max_hostility,
               coalesce(max(CASE WHEN nullif(fatlev, -9) >= 4 THEN 1 WHEN nullif(fatlev, -9) < 4 THEN 0 END), 0)
                   AS mid_high_fatality_event,
               max(nullif(fatlev, -9)) AS mid_max_fatality_cat,
               count(*) FILTER (nullif(fatlev, -9) > 0) AS mid_count_fatal_disputes
        FROM disputes WHERE year BETWEEN 1946 AND 2020 GROUP BY statea, year""",
    "dispute_panel": """
        SELECT p.COWcode, p.year, coalesce(mid_count_total, 0) AS mid_count_total,
               coalesce(mid_count_initiated, 0) AS mid_count_initiated,
               coalesce(mid_count_targeted, 0) AS mid_count_targeted,
               coalesce(mid_max_hostility, 1) AS mid_max_hostility,
               coalesce(mid_high_fatality_event, 0) AS mid_high_fatality_event,
               coalesce(mid_max_fatality_cat, 0) AS mid_max_fatality_cat,
               coalesce(mid_count_fatal_disputes, 0) AS mid_count_fatal_disputes
        FROM panel p LEFT JOIN dispute_units d ON statea = COWcode AND d.year = p.year""",
    "trade_units": """
        SELECT exporter_cow, year, """
    + ", ".join(
        f"coalesce(sum(({share} / 100) * ({share} / 100)), 0) AS trade_{side}_hhi, "
        + ", ".join(
            f"coalesce(sum({share}) FILTER (importer_cow IN ({codes})), 0) AS {prefix}_dep_{name}"
            for name, codes in (("usa", "2"), ("china", "7"), ("venezuela", "1"), ("alba_bloc", "4, 14, 9, 5"))
        )
        for side, prefix, share in (
            ("export", "exp", "RED_export_importance"),
            ("import", "imp", "RED_import_importance"),
        )
    )
    + " FROM trade GROUP BY exporter_cow, year",
    "pact_units": """
        SELECT stateA, a.year, """
    + ", ".join(
        f"coalesce(sum({p}), 0) AS atop_{p}_total, "
        f"coalesce(sum({p} * CASE WHEN v2x_libdem < 0.5 THEN 1 WHEN v2x_libdem >= 0.5 THEN 0 END), 0) AS atop_{p}_with_auto"
        for p in ("defense", "offense", "nonagg")
    )
    + """, coalesce(sum(consul), 0) AS atop_consul_total
        FROM alliances a LEFT JOIN panel p ON p.COWcode = stateB AND p.year = a.year GROUP BY stateA, a.year""",
    "ideology_panel": """
        SELECT p.COWcode, p.year, leader_ideology AS leader_ideology_raw, hog_ideology AS hog_ideology_raw,
               CASE leader_ideology WHEN 'leftist' THEN 1 WHEN 'centrist' THEN 2 WHEN 'rightist' THEN 3 ELSE 0 END
                   AS gli_leader_ideology_num,
               CASE hog_ideology WHEN 'leftist' THEN 1 WHEN 'centrist' THEN 2 WHEN 'rightist' THEN 3 ELSE 0 END
                   AS gli_hog_ideology_num,
               CASE WHEN leader_ideology = 'leftist' THEN 1 ELSE 0 END AS is_leftist_leader,
               CASE WHEN leader_ideology = 'rightist' THEN 1 ELSE 0 END AS is_rightist_leader,
               CASE WHEN leader_ideology = 'centrist' THEN 1 ELSE 0 END AS is_centrist_leader
        FROM panel p LEFT JOIN ideology i ON country_code_cow = COWcode AND i.year = p.year""",
    "sparse": """
        SELECT o_custkey AS COWcode, CAST(year(o_orderdate) AS INT) AS year,
               CASE WHEN (year(o_orderdate) - 1995) % 3 = 0 THEN CAST(sum(o_orderkey % 97) % 100 AS DOUBLE) END AS islmgenpct,
               CASE WHEN (year(o_orderdate) - 1995) % 3 = 0 AND count(*) <> 2
                    THEN CAST(sum(o_orderkey % 97) * 3 % 100 AS DOUBLE) END AS chrstgenpct
        FROM orders GROUP BY year(o_orderdate), o_custkey""",
    "sparse_grid": """
        SELECT g.COWcode, g.year, islmgenpct, chrstgenpct
        FROM (SELECT DISTINCT COWcode, CAST(r AS INT) AS year FROM sparse, range(1993, 2004) t(r)) g
        LEFT JOIN sparse s ON s.COWcode = g.COWcode AND s.year = g.year""",
    "neighbours": """
        SELECT *,
            last_value(islmgenpct IGNORE NULLS) OVER p AS i0,
            last_value(CASE WHEN islmgenpct IS NOT NULL THEN year END IGNORE NULLS) OVER p AS it0,
            first_value(islmgenpct IGNORE NULLS) OVER f AS i1,
            first_value(CASE WHEN islmgenpct IS NOT NULL THEN year END IGNORE NULLS) OVER f AS it1,
            last_value(chrstgenpct IGNORE NULLS) OVER p AS c0,
            last_value(CASE WHEN chrstgenpct IS NOT NULL THEN year END IGNORE NULLS) OVER p AS ct0,
            first_value(chrstgenpct IGNORE NULLS) OVER f AS c1,
            first_value(CASE WHEN chrstgenpct IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ct1
        FROM sparse_grid
        WINDOW p AS (PARTITION BY COWcode ORDER BY year ROWS UNBOUNDED PRECEDING),
               f AS (PARTITION BY COWcode ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "lines": """
        SELECT *, coalesce(islmgenpct, i0 + (i1 - i0) * (year - it0) / nullif(it1 - it0, 0)) AS il,
               coalesce(chrstgenpct, c0 + (c1 - c0) * (year - ct0) / nullif(ct1 - ct0, 0)) AS cl
        FROM neighbours""",
    "spells": """
        SELECT u AS ccode, 'L' || o_custkey AS leader, CAST(o_orderkey AS VARCHAR) AS leadid, o_day AS startdate,
               enddate,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Irregular' WHEN o_orderpriority <> '5-LOW' THEN 'Regular' END
                   AS entry,
               o_orderstatus AS exit, CAST(o_orderkey % 5 AS INT) AS exitcode,
               CAST(o_orderkey % 3 AS INT) AS posttenurefate,
               CASE WHEN o_custkey % 3 = 0 THEN 'F' WHEN o_custkey % 3 = 1 THEN 'M' END AS gender,
               CAST(CASE WHEN o_custkey % 11 <> 0 THEN 1930 + o_custkey % 40 END AS INT) AS yrborn,
               CAST(o_orderkey % 4 AS INT) AS prevtimesinoffice
        FROM unit_orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS enddate
                                    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "spell_years": """
        SELECT s.*, CAST(year(startdate) AS INT) AS start_year,
               CAST(CASE WHEN enddate IS NULL OR year(enddate) < year(startdate) THEN 2020 ELSE year(enddate) END AS INT)
                   AS end_year
        FROM spells s""",
    "held": """
        SELECT * FROM (
            SELECT s.*, CAST(g AS INT) AS year,
                   row_number() OVER (PARTITION BY ccode, g ORDER BY startdate DESC, leadid) AS r
            FROM spell_years s, unnest(generate_series(start_year, end_year)) t(g)
            WHERE make_date(CAST(g AS INT), 12, 31) BETWEEN startdate AND enddate)
        WHERE r = 1""",
    "leaders": """
        SELECT ccode AS COWcode, year, leader AS leader_name, leadid AS leader_id,
               year - start_year + 1 AS leader_tenure_years,
               CAST(datediff('day', startdate, make_date(year, 12, 31)) AS INT) AS leader_tenure_days,
               CASE WHEN year = start_year THEN 1 ELSE 0 END AS leader_first_year,
               CASE WHEN year = end_year THEN 1 ELSE 0 END AS leader_last_year,
               year - yrborn AS leader_age, gender, entry AS entry_type, exit AS exit_type, exitcode,
               posttenurefate AS post_tenure_fate, prevtimesinoffice AS previous_times
        FROM held""",
    "capitals": """
        SELECT n_nationkey AS COWcode, CAST('1900-01-01' AS DATE) AS valid_from,
               CASE WHEN n_nationkey = 3 THEN CAST('1999-12-31' AS DATE) ELSE CAST('1997-12-31' AS DATE) END AS valid_to,
               CAST(n_nationkey * 7 % 140 - 70 AS DOUBLE) AS lat, CAST(n_nationkey * 31 % 340 - 170 AS DOUBLE) AS lon
        FROM nation WHERE n_nationkey <> 5
        UNION ALL
        SELECT n_nationkey, CAST('1998-01-01' AS DATE), CAST('2100-12-31' AS DATE),
               (n_nationkey * 7 + 13) % 140 - 70, (n_nationkey * 31 + 13) % 340 - 170
        FROM nation""",
    "spine_keys": """
        SELECT 'NATION_' || a AS iso3a, 'NATION_' || b AS iso3b, y AS year, n_links AS influence,
               a AS COWcode_a, b AS COWcode_b
        FROM flows WHERE a <> 13 AND b <> 13""",
    "spine": """
        SELECT k.*, hihosta, fatlev, RED_export_importance
        FROM spine_keys k
        LEFT JOIN disputes d ON d.year = k.year AND statea = COWcode_a AND stateb = COWcode_b
        LEFT JOIN trade t ON t.year = k.year AND exporter_cow = COWcode_a AND importer_cow = COWcode_b""",
    "hhi_export": """
        SELECT exporter_cow AS unit, year, sum((RED_export_importance / 100) * (RED_export_importance / 100)) AS hhi
        FROM trade GROUP BY 1, 2""",
    "hhi_import": """
        SELECT importer_cow AS unit, year,
               coalesce(sum((RED_import_importance / 100) * (RED_import_importance / 100)), 0) AS hhi
        FROM trade GROUP BY 1, 2""",
    "profile": """
        SELECT p.COWcode, p.year, v2x_libdem, v2x_corr, v2exl_legitideol, islmgenpct, chrstgenpct,
               country_name AS country, e.hhi AS hhi_export, i.hhi AS hhi_import
        FROM panel p LEFT JOIN hhi_export e ON e.unit = p.COWcode AND e.year = p.year
        LEFT JOIN hhi_import i ON i.unit = p.COWcode AND i.year = p.year""",
    "dyads": """
        SELECT s.*, """
    + ", ".join(
        f"{side}.{c} AS {c}_{side}"
        for side in ("a", "b")
        for c in (
            "v2x_libdem",
            "v2x_corr",
            "v2exl_legitideol",
            "islmgenpct",
            "chrstgenpct",
            "country",
            "hhi_export",
            "hhi_import",
        )
    )
    + """
        FROM spine s LEFT JOIN profile a ON a.COWcode = COWcode_a AND a.year = s.year
        LEFT JOIN profile b ON b.COWcode = COWcode_b AND b.year = s.year""",
    "context": """
        SELECT COWcode_a, COWcode_b, year, hhi_export_a - hhi_export_b AS hhi_export_gap,
               CASE WHEN v2x_libdem_b > 0.5 AND v2x_libdem_a < 0.3 THEN 1
                    WHEN NOT (v2x_libdem_b > 0.5 AND v2x_libdem_a < 0.3) THEN 0 END AS targeted_democracy,
               abs(islmgenpct_a - islmgenpct_b) AS islm_dist, abs(chrstgenpct_a - chrstgenpct_b) AS chrst_dist
        FROM dyads""",
    "extreme": """
        SELECT d.*, global_med_ideol, abs(v2exl_legitideol_a - global_med_ideol) AS ideol_extremity_a,
               abs(v2exl_legitideol_b - global_med_ideol) AS ideol_extremity_b,
               1 - v2x_libdem_a AS dem_constraint_inv_a, 1 - v2x_libdem_b AS dem_constraint_inv_b
        FROM dyads d LEFT JOIN (SELECT year, median(v2exl_legitideol_a) AS global_med_ideol FROM dyads GROUP BY year) m
          ON m.year = d.year""",
    "standard": """
        SELECT e.*, """
    + ", ".join(
        f"({c}_{s} - (SELECT avg({c}_{s}) FROM extreme)) / (SELECT stddev_samp({c}_{s}) FROM extreme) AS z_{z}_{s}"
        for s in ("a", "b")
        for z, c in (("legit", "v2exl_legitideol"), ("dem", "dem_constraint_inv"), ("ext", "ideol_extremity"))
    )
    + " FROM extreme e",
    "indexed": """
        SELECT *, abs(rev_potential_a - rev_potential_b) AS revisionism_distance
        FROM (SELECT *, (z_legit_a + z_dem_a + z_ext_a) / 3 AS rev_potential_a,
                     (z_legit_b + z_dem_b + z_ext_b) / 3 AS rev_potential_b FROM standard)""",
    "led": """
        SELECT d.COWcode_a, d.COWcode_b, d.year, """
    + ", ".join(
        f"{side}.{c} AS {c}_{side}"
        for side in ("a", "b")
        for c in (
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
        )
    )
    + """,
               abs(a.leader_tenure_years - b.leader_tenure_years) AS leader_tenure_diff,
               CASE WHEN a.leader_first_year = 1 AND b.leader_first_year = 1 THEN 1
                    WHEN NOT (a.leader_first_year = 1 AND b.leader_first_year = 1) THEN 0 END AS both_leaders_new,
               CASE WHEN a.leader_first_year = 1 OR b.leader_first_year = 1 THEN 1
                    WHEN NOT (a.leader_first_year = 1 OR b.leader_first_year = 1) THEN 0 END AS any_leader_new,
               a.leader_first_year AS leader_change_a, b.leader_first_year AS leader_change_b,
               CASE WHEN a.leader_id = b.leader_id THEN 1 ELSE 0 END AS same_leader,
               CASE WHEN a.gender = 'F' AND b.gender = 'F' THEN 1
                    WHEN NOT (a.gender = 'F' AND b.gender = 'F') THEN 0 END AS both_female_leaders,
               abs(a.leader_age - b.leader_age) AS leader_age_diff,
               CASE WHEN a.entry_type = 'Irregular' THEN 1 ELSE 0 END AS irregular_entry_a,
               CASE WHEN b.entry_type = 'Irregular' THEN 1 ELSE 0 END AS irregular_entry_b,
               CASE WHEN a.entry_type = 'Irregular' AND b.entry_type = 'Irregular' THEN 1 ELSE 0 END
                   AS both_irregular_entry
        FROM dyads d LEFT JOIN leaders a ON a.COWcode = COWcode_a AND a.year = d.year
        LEFT JOIN leaders b ON b.COWcode = COWcode_b AND b.year = d.year""",
    "gappy": """
        SELECT u AS COWcode, y AS year, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS half,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS most,
               CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS other_half,
               CAST(NULL AS VARCHAR) AS nothing, o_orderstatus AS status,
               CASE WHEN o_orderkey % 7 <> 0 THEN c_mktsegment END AS segment
        FROM unit_orders""",
    "daily": """
        SELECT user_id, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS day,
               count(*) AS n_events, round(sum(value), 4) AS value
        FROM events GROUP BY 1, 2""",
    "steps": """
        SELECT g.user_id, g.day, last_value(n_events IGNORE NULLS) OVER w AS n_events,
               last_value(value IGNORE NULLS) OVER w AS value
        FROM (SELECT user_id, CAST(unnest(generate_series(min(day), max(day))) AS INT) AS day FROM daily GROUP BY user_id) g
        LEFT JOIN daily d ON d.user_id = g.user_id AND d.day = g.day
        WINDOW w AS (PARTITION BY g.user_id ORDER BY g.day ROWS UNBOUNDED PRECEDING)""",
    "cuts": """
        SELECT user_id, day AS cut, least(20, day - lo) AS encoder_length, least(5, hi - day + 1) AS decoder_length
        FROM steps JOIN (SELECT user_id, min(day) AS lo, max(day) AS hi FROM daily GROUP BY user_id) USING (user_id)
        WHERE day - lo >= 10""",
    "imputable": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               CASE WHEN (l_orderkey * 8 + l_linenumber) % 5 <> 0
                    THEN l_extendedprice / 700 + l_quantity * 2 + l_discount * 10 END AS income,
               CASE WHEN (l_orderkey * 8 + l_linenumber) % 7 <> 0
                    THEN (l_extendedprice / 700 + l_quantity * 2) / 2 + l_tax * 10 END AS wealth,
               CASE WHEN (l_orderkey * 8 + l_linenumber) % 11 <> 0 THEN l_quantity + l_tax END AS rents
        FROM lineitem""",
}


def sql(body: str) -> str:
    """Prefix a query with the views it needs, in definition order."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        text = queue.pop()
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\s+\w+\b", text):
                needed.add(name)
                queue.append(view)
    ctes = [f"{name} AS ({view})" for name, view in VIEWS.items() if name in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


def r(columns: str, digits: int = 6) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


def linked_keys(how: str) -> str:
    keys = "l.COWcode, l.year"
    if how in ("RIGHT", "FULL"):
        keys = "coalesce(l.COWcode, r.unit) AS COWcode, coalesce(l.year, r.year) AS year"
    return f"""
        SELECT {keys}, n, last_order
        FROM (SELECT CASE WHEN u <> 4 THEN u END AS COWcode, y AS year, n FROM measures) l
        {how} JOIN (SELECT CASE WHEN u = 2 THEN 102 WHEN u <> 6 THEN u END AS unit, y AS year, max(o_orderkey) AS last_order
                    FROM unit_orders GROUP BY 1, 2) r
        ON l.COWcode IS NOT DISTINCT FROM r.unit AND l.year IS NOT DISTINCT FROM r.year"""


def null_keyed(operator: str) -> str:
    return f"""
        SELECT c_custkey, c.unit, n_name
        FROM (SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS unit FROM customer) c
        LEFT JOIN (SELECT CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey + 100 WHEN n_nationkey <> 10 THEN n_nationkey END AS unit,
                          n_name FROM nation) n ON c.unit {operator} n.unit"""


PCT = "islmgenpct chrstgenpct"
TRADE = " ".join(
    f"trade_{side}_hhi {p}_dep_usa {p}_dep_china {p}_dep_venezuela {p}_dep_alba_bloc"
    for side, p in (("export", "exp"), ("import", "imp"))
)
PACTS = (
    "atop_defense_total atop_defense_with_auto atop_offense_total atop_offense_with_auto atop_nonagg_total"
    " atop_nonagg_with_auto atop_consul_total"
)
SIX = "min q1 median mean q3 max"


def six_number(view: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, round(min(CAST({c} AS DOUBLE)), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
            round(median({c}), 6) AS median, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.75), 6) AS q3,
            round(max(CAST({c} AS DOUBLE)), 6) AS max, count(*) - count({c}) AS n_missing FROM {view}"""
        for c in columns.split()
    )


def correlations(source: str, columns: str) -> str:
    names = columns.split()
    complete = " AND ".join(f"{c} IS NOT NULL" for c in names)
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS row_variable, '{b}' AS column_variable, round(corr({a}, {b}), 6) AS correlation
            FROM {source} WHERE {complete}"""
        for a in names
        for b in names
    )


ALL_SAMPLES = """WITH idx AS (
            SELECT user_id, start, length, CAST(length - least(5, length - 10) AS INT) AS encoder_length FROM (
                SELECT user_id, start, CAST(last - start + 1 AS INT) AS length FROM (
                    SELECT user_id, day AS start, max(day) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN CURRENT ROW AND 24 FOLLOWING) AS last FROM daily
                    UNION
                    SELECT user_id, min(day) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN 24 PRECEDING AND CURRENT ROW), day FROM daily))
            WHERE length >= 11)"""


def one_scan_correlations(source: str, names: list[str]) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in names)
    cells = ", ".join(
        f"{{'row_variable': '{a}', 'column_variable': '{b}', 'correlation': round(CASE WHEN '{a}' <> '{b}' THEN corr({a}, {b}) WHEN min({a}) < max({a}) THEN 1.0 END, 6)}}"
        for a in names
        for b in names
    )
    return f"SELECT unnest([{cells}], recursive := true) FROM {source} WHERE {complete}"


def quantile_rows(probs: list[float]) -> str:
    return " UNION ALL ".join(
        f"""SELECT l_returnflag, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(l_extendedprice, {p}), 4) AS quantile
            FROM lineitem GROUP BY l_returnflag"""
        for p in probs
    )


def chained_rounds(rounds: int) -> str:
    """Least squares of each column on the other two, in turn; the fewest gaps first."""
    columns = ["rents", "wealth", "income"]
    parts = [
        """s0 AS MATERIALIZED (SELECT l_orderkey, l_linenumber, """
        + ", ".join(f"{c} IS NULL AS gap_{c}, coalesce({c}, avg({c}) OVER ()) AS {c}" for c in columns)
        + """ FROM (SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN income END AS income) FROM imputable))"""
    ]
    for k in range(rounds * len(columns)):
        y = columns[k % 3]
        a, b = (c for c in columns if c != y)
        parts.append(f"""c{k} AS MATERIALIZED (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS p, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS q
            FROM (SELECT avg({y}) AS ym, avg({a}) AS am, avg({b}) AS bm, var_pop({a}) AS aa, var_pop({b}) AS bb, covar_pop({a}, {b}) AS ab,
                         covar_pop({a}, {y}) AS ay, covar_pop({b}, {y}) AS by_ FROM s{k} WHERE NOT gap_{y}))""")
        parts.append(f"""s{k + 1} AS MATERIALIZED (SELECT s{k}.* REPLACE (CASE WHEN gap_{y} THEN ym + p * ({a} - am) + q * ({b} - bm) ELSE {y} END AS {y})
            FROM s{k}, c{k})""")
    return f"""WITH {', '.join(parts)}
        SELECT l_orderkey, l_linenumber, round(income, 5) AS income, round(wealth, 5) AS wealth,
               CASE WHEN NOT gap_rents THEN round(rents, 5) END AS rents FROM s{rounds * len(columns)}"""


BODIES = {
    "dispute_monadic": "SELECT * FROM dispute_panel",
    "bloc_membership": "SELECT COWcode, year, alba_possible, alba_member FROM bloc",
    "membership_violations": """
        SELECT COWcode, year, alba_member, alba_possible, 'outside_region' AS rule FROM bloc
        WHERE COWcode >= 15 AND (alba_member = 1 OR alba_possible = 1)
        UNION ALL
        SELECT COWcode, year, alba_member, alba_possible, 'before_start' FROM bloc
        WHERE year < 1998 AND (alba_member = 1 OR alba_possible = 1)""",
    "wide_membership": """
        SELECT COWcode, year, CASE WHEN COWcode > 5 AND COWcode < 20 AND year >= 1996 THEN 1 ELSE 0 END AS alba_possible,
               CASE WHEN EXISTS (SELECT 1 FROM roster WHERE unit = COWcode AND year BETWEEN start_year AND end_year)
                    THEN 1 ELSE 0 END AS alba_member, n
        FROM (SELECT CAST(l_suppkey % 20 AS INT) AS COWcode, CAST(l_linenumber * 7 + 1980 AS INT) AS year, count(*) AS n
              FROM lineitem GROUP BY 1, 2)""",
    "order_membership": """
        SELECT y AS year, CASE WHEN EXISTS (SELECT 1 FROM roster WHERE unit = u AND y BETWEEN start_year AND end_year)
                               THEN 1 ELSE 0 END AS member,
               count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM unit_orders GROUP BY 1, 2""",
    "bloc_score_series": f"SELECT country_name, year, {r('v2x_libdem')} FROM bloc WHERE alba_member = 1",
    "trade_dependence": f"""
        SELECT p.COWcode, p.year, {r(TRADE)}
        FROM panel p LEFT JOIN trade_units t ON exporter_cow = COWcode AND t.year = p.year""",
    "hhi_by_exporter": """
        SELECT exporter_cow AS COWcode, year,
               round(coalesce(sum((RED_import_importance / 100) * (RED_import_importance / 100)), 0), 6) AS hhi_import
        FROM trade GROUP BY 1, 2""",
    "hhi_by_importer": "SELECT unit AS COWcode, year, round(hhi, 6) AS hhi_import FROM hhi_import",
    "alliance_weighted": "SELECT p.COWcode, p.year, round(v2x_libdem, 6) AS v2x_libdem, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in PACTS.split())
    + " FROM panel p LEFT JOIN pact_units t ON stateA = p.COWcode AND t.year = p.year",
    "ideology_recode": "SELECT * FROM ideology_panel",
    "gdp_history": f"SELECT COWcode, year, {r('maddison_gdp_pc maddison_pop', 7)} FROM gdp_history",
    "crosswalk_code": """
        SELECT COWcode, count(*) AS n, count(DISTINCT countrycode) AS codes FROM history_coded GROUP BY COWcode""",
    "crosswalk_name": "SELECT * FROM name_units",
    "crosswalk_name_table": """
        WITH p AS (
            SELECT CASE c_custkey % 3 WHEN 0 THEN '^ORD .*' || c_name || '$'
                        WHEN 1 THEN '(?i)CUSTOMER#0*' || c_custkey || '( rush| late)?$'
                        ELSE '(mr|ms)[.] ' || c_name || '$|' || c_name || ' rush' END AS pattern, CAST(c_custkey + 1000 AS INT) AS unit, c_name
            FROM customer),
        n AS (
            SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN 'ord of ' WHEN 1 THEN 'ORD ' WHEN 2 THEN 'ms. ' ELSE '' END
                   || 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
                   || CASE WHEN o_orderkey % 5 = 0 THEN ' rush' WHEN o_orderkey % 7 = 0 THEN ' late' ELSE '' END AS name,
                   'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS holds
            FROM orders),
        h AS (
            SELECT name, unit FROM n JOIN p ON c_name = holds WHERE regexp_matches(name, pattern)
            UNION SELECT name, 1 FROM n WHERE name LIKE '% late'
            UNION SELECT name, 2 FROM n WHERE regexp_matches(name, '^[a-z. ]+#[0-9]+7$')),
        g AS (SELECT name, CAST(count(*) AS INT) AS k, min(unit) AS single FROM h GROUP BY name)
        SELECT n.name, CASE WHEN n.name = 'ms. Customer#000000002' THEN 7 WHEN n.name = 'Customer#000000004' THEN NULL WHEN k = 1 THEN single END AS unit,
               coalesce(k, 0) AS n_matches,
               CASE WHEN n.name IN ('ms. Customer#000000002', 'Customer#000000004') THEN 'override' WHEN k IS NULL THEN 'unmatched'
                    WHEN k > 1 THEN 'ambiguous' ELSE 'matched' END AS status
        FROM n LEFT JOIN g ON g.name = n.name""",
    "resource_wealth": f"SELECT COWcode, year, {r('oil_gas_pop')}, is_petro_state_ross FROM resources",
    "inequality_mean": f"SELECT COWcode, year, {r('gini_disp', 7)} FROM gini",
    "premium_mean": f"SELECT COWcode, year, {r('fraser_bmp_score', 7)} FROM premium",
    "indicator_panel": f"""
        SELECT COWcode, year, {r('wdi_gdp_pc wdi_pop resource_rents corruption_control govt_effectiveness', 7)}
        FROM indicators""",
    "indicator_panel_pooled": """
        WITH means AS (SELECT year, avg(corruption_control) AS c, avg(govt_effectiveness) AS g FROM reduced GROUP BY year),
        near AS (SELECT year, c, g,
            last_value(c IGNORE NULLS) OVER p AS c0,
            last_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER p AS ct0,
            first_value(c IGNORE NULLS) OVER f AS c1,
            first_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ct1,
            last_value(g IGNORE NULLS) OVER p AS g0,
            last_value(CASE WHEN g IS NOT NULL THEN year END IGNORE NULLS) OVER p AS gt0,
            first_value(g IGNORE NULLS) OVER f AS g1,
            first_value(CASE WHEN g IS NOT NULL THEN year END IGNORE NULLS) OVER f AS gt1
            FROM means WINDOW p AS (ORDER BY year ROWS UNBOUNDED PRECEDING),
                              f AS (ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        curve AS (SELECT year, coalesce(c, c0 + (c1 - c0) * (year - ct0) / nullif(ct1 - ct0, 0), c0, c1) AS c,
                         coalesce(g, g0 + (g1 - g0) * (year - gt0) / nullif(gt1 - gt0, 0), g0, g1) AS g FROM near)
        SELECT COWcode, r.year, round(wdi_gdp_pc, 7) AS wdi_gdp_pc, CAST(0 AS DOUBLE) AS wdi_pop,
               round(resource_rents, 7) AS resource_rents, round(c, 7) AS corruption_control,
               round(g, 7) AS govt_effectiveness
        FROM reduced r JOIN curve ON curve.year = r.year""",
    "indicator_union": """
        SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice,
               CASE WHEN year(o_orderdate) < 1998 THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
               CAST(NULL AS VARCHAR) AS o_comment
        FROM orders""",
    "coerced_left_join": linked_keys("LEFT"),
    "coerced_right_join": linked_keys("RIGHT"),
    "coerced_inner_join": linked_keys("INNER"),
    "coerced_full_join": linked_keys("FULL"),
    "null_safe_join": null_keyed("IS NOT DISTINCT FROM"),
    "null_strict_join": null_keyed("="),
    "salted_join": null_keyed("IS NOT DISTINCT FROM"),
    "duplicate_keys": "SELECT a, b, y, n_links AS n_rows FROM flows WHERE n_links > 1",
    "fan_out": """
        SELECT count(*) AS left_rows, count(m) AS matched_rows, CAST(sum(coalesce(m, 1)) AS BIGINT) AS joined_rows,
               max(m) AS max_matches
        FROM flows LEFT JOIN (SELECT statea, stateb, year, count(*) AS m FROM disputes GROUP BY ALL)
          ON statea = a AND stateb = b AND year = y""",
    "unify_indicators": f"""
        SELECT COWcode, year, is_petro_state_ross, is_petro_state, {r(
            "maddison_gdp_pc maddison_pop wdi_gdp_pc wdi_pop resource_rents corruption_control govt_effectiveness"
            " oil_gas_pop gini_disp fraser_bmp_score unified_gdp_pc unified_pop log_oil_gas_wealth log_gdp_pc log_pop", 7)}
        FROM unified""",
    "base_panel": """
        SELECT p.country_name, p.year, COWcode AS country_id, upper(substring(country_name, 1, 3)) AS country_text_id,
               COWcode AS co_wcode, round(v2x_libdem, 6) AS v2x_libdem, round(v2x_corr, 6) AS v2x_corr,
               round(v2exl_legitideol, 6) AS v2exl_legitideol, reg_trans, aut_ep_id, aut_founding_elec, dem_ep_id
        FROM panel p LEFT JOIN episodes e ON e.country_id = COWcode AND e.year = p.year WHERE p.year >= 1996""",
    "monadic_master": f"""
        WITH shares AS (
            SELECT COWcode, year,
                   coalesce(i, i0 + (i1 - i0) * (year - it0) / nullif(it1 - it0, 0), i0) AS islmgenpct,
                   coalesce(c, c0 + (c1 - c0) * (year - ct0) / nullif(ct1 - ct0, 0), c0) AS chrstgenpct
            FROM (SELECT COWcode, year, i, c,
                    last_value(i IGNORE NULLS) OVER p AS i0,
                    last_value(CASE WHEN i IS NOT NULL THEN year END IGNORE NULLS) OVER p AS it0,
                    first_value(i IGNORE NULLS) OVER f AS i1,
                    first_value(CASE WHEN i IS NOT NULL THEN year END IGNORE NULLS) OVER f AS it1,
                    last_value(c IGNORE NULLS) OVER p AS c0,
                    last_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER p AS ct0,
                    first_value(c IGNORE NULLS) OVER f AS c1,
                    first_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ct1
                  FROM (SELECT COWcode, year, CASE WHEN year % 3 = 0 THEN islmgenpct END AS i,
                               CASE WHEN year % 3 = 0 THEN chrstgenpct END AS c FROM panel)
                  WINDOW p AS (PARTITION BY COWcode ORDER BY year ROWS UNBOUNDED PRECEDING),
                         f AS (PARTITION BY COWcode ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))
        SELECT b.country_name, b.year, b.COWcode AS country_id, upper(substring(b.country_name, 1, 3)) AS country_text_id,
               b.COWcode, {r('v2x_libdem v2x_corr v2exl_legitideol', 7)}, reg_trans,
               d.* EXCLUDE (COWcode, year), alba_possible, alba_member, {r(TRADE, 7)},
               {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in PACTS.split())},
               i.* EXCLUDE (COWcode, year), {r('resource_rents gini_disp fraser_bmp_score unified_gdp_pc unified_pop', 7)},
               is_petro_state, {r('log_oil_gas_wealth log_gdp_pc log_pop', 7)},
               CASE WHEN aut_ep_id IS NOT NULL THEN 1 ELSE 0 END AS is_aut_episode,
               CASE WHEN dem_ep_id IS NOT NULL THEN 1 ELSE 0 END AS is_dem_episode,
               round(coalesce(v2x_corr, (2.5 - corruption_control) / 5), 7) AS unified_corruption,
               round(s.islmgenpct, 7) AS islmgenpct, round(s.chrstgenpct, 7) AS chrstgenpct
        FROM bloc b LEFT JOIN episodes e ON e.country_id = b.COWcode AND e.year = b.year
        JOIN dispute_panel d ON d.COWcode = b.COWcode AND d.year = b.year
        LEFT JOIN trade_units t ON exporter_cow = b.COWcode AND t.year = b.year
        LEFT JOIN pact_units a ON stateA = b.COWcode AND a.year = b.year
        JOIN ideology_panel i ON i.COWcode = b.COWcode AND i.year = b.year
        JOIN unified n ON n.COWcode = b.COWcode AND n.year = b.year
        JOIN shares s ON s.COWcode = b.COWcode AND s.year = b.year""",
    "unified_index": """
        SELECT p.COWcode, p.year, round(v2x_corr, 7) AS v2x_corr, reg_trans, row_regtrans,
               round(wdi.resource_rents, 7) AS resource_rents,
               CASE WHEN aut_ep_id IS NOT NULL THEN 1 ELSE 0 END AS is_aut_episode,
               CASE WHEN dem_ep_id IS NOT NULL THEN 1 ELSE 0 END AS is_dem_episode,
               round(coalesce(v2x_corr, (2.5 - corruption_control) / 5), 7) AS unified_corruption
        FROM panel p LEFT JOIN episodes e ON e.country_id = COWcode AND e.year = p.year
        LEFT JOIN indicators wdi ON wdi.COWcode = p.COWcode AND wdi.year = p.year""",
    "grid_complete": f"SELECT COWcode, year, {r(PCT)} FROM sparse_grid",
    "interpolate_linear": "SELECT COWcode, year, round(il, 6) AS islmgenpct, round(cl, 6) AS chrstgenpct FROM lines",
    "interpolate_ends": """
        SELECT COWcode, year, round(coalesce(il, i0, i1), 6) AS islmgenpct, round(coalesce(cl, c0, c1), 6) AS chrstgenpct
        FROM lines""",
    "interpolate_pooled": """
        WITH means AS (SELECT year, avg(islmgenpct) AS i, avg(chrstgenpct) AS c FROM sparse_grid GROUP BY year),
        near AS (SELECT year, i, c,
            last_value(i IGNORE NULLS) OVER p AS i0,
            last_value(CASE WHEN i IS NOT NULL THEN year END IGNORE NULLS) OVER p AS it0,
            first_value(i IGNORE NULLS) OVER f AS i1,
            first_value(CASE WHEN i IS NOT NULL THEN year END IGNORE NULLS) OVER f AS it1,
            last_value(c IGNORE NULLS) OVER p AS c0,
            last_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER p AS ct0,
            first_value(c IGNORE NULLS) OVER f AS c1,
            first_value(CASE WHEN c IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ct1
            FROM means WINDOW p AS (ORDER BY year ROWS UNBOUNDED PRECEDING),
                              f AS (ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT COWcode, g.year,
               round(coalesce(i, i0 + (i1 - i0) * (g.year - it0) / nullif(it1 - it0, 0), i0, i1), 6) AS islmgenpct,
               round(coalesce(c, c0 + (c1 - c0) * (g.year - ct0) / nullif(ct1 - ct0, 0), c0, c1), 6) AS chrstgenpct
        FROM sparse_grid g JOIN near ON near.year = g.year""",
    "locf": "SELECT COWcode, year, round(i0, 6) AS islmgenpct, round(c0, 6) AS chrstgenpct FROM neighbours",
    "locf_small_blocks": "SELECT COWcode, year, round(i0, 6) AS islmgenpct, round(c0, 6) AS chrstgenpct FROM neighbours",
    "interpolate_ties": """
        WITH m AS (SELECT CAST(o_custkey % 50 AS BIGINT) AS unit, CAST(year(o_orderdate) AS INT) AS year,
                          avg(CASE WHEN year(o_orderdate) % 2 = 1 THEN CAST(o_orderkey % 97 AS DOUBLE) END) AS x FROM orders GROUP BY 1, 2),
        k AS (SELECT *, last_value(x IGNORE NULLS) OVER p AS x0, last_value(CASE WHEN x IS NOT NULL THEN year END IGNORE NULLS) OVER p AS t0,
                     first_value(x IGNORE NULLS) OVER f AS x1, first_value(CASE WHEN x IS NOT NULL THEN year END IGNORE NULLS) OVER f AS t1
              FROM m WINDOW p AS (PARTITION BY unit ORDER BY year ROWS UNBOUNDED PRECEDING),
                            f AS (PARTITION BY unit ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT unit, year, round(coalesce(x, x0 + (x1 - x0) * (year - t0) / nullif(t1 - t0, 0)), 6) AS x FROM k""",
    "share_series_yearly": """
        SELECT COWcode, year, round(i, 6) AS islmgenpct, round(c, 6) AS chrstgenpct
        FROM (SELECT COWcode, year, coalesce(il, i0) AS i, coalesce(cl, c0) AS c FROM lines WHERE year >= 1994)""",
    "share_series_anchored": """
        SELECT COWcode, year, round(coalesce(il, i0), 6) AS islmgenpct, round(coalesce(cl, c0), 6) AS chrstgenpct
        FROM lines WHERE year >= 1996""",
    "keep_first": """
        SELECT o_custkey, year, o_orderkey, round(o_totalprice, 2) AS o_totalprice
        FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, o_orderkey, o_totalprice,
                     row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS r FROM orders)
        WHERE r = 1""",
    "latest_per_group": """
        SELECT u, y, o_day, o_orderkey
        FROM (SELECT u, y, o_day, o_orderkey,
                     row_number() OVER (PARTITION BY u, y ORDER BY o_day DESC, o_orderkey DESC) AS r FROM unit_orders)
        WHERE r = 1""",
    "zscore": """
        SELECT o_orderkey, CAST(3 AS DOUBLE) AS constant,
               round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
                     / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS z_price,
               CAST(NULL AS DOUBLE) AS z_constant
        FROM orders""",
    "above_mean": """
        SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders
        WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)""",
    "grouped_quantiles": quantile_rows([0.0, 0.25, 0.5, 0.9, 1.0]),
    "yearly_median": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, round(o_totalprice, 4) AS o_totalprice,
               round(median(o_totalprice) OVER (PARTITION BY year(o_orderdate)), 4) AS median_price
        FROM orders""",
    "dyad_spine": """
        SELECT iso3a, iso3b, year, influence, COWcode_a, COWcode_b, hihosta, fatlev,
               round(RED_export_importance, 6) AS RED_export_importance FROM spine""",
    "dyad_spine_collapsed": """
        SELECT k.*, max(nullif(hihosta, -9)) AS hihosta, max(nullif(fatlev, -9)) AS fatlev,
               round(any_value(RED_export_importance), 6) AS RED_export_importance
        FROM spine_keys k
        LEFT JOIN disputes d ON d.year = k.year AND statea = COWcode_a AND stateb = COWcode_b
        LEFT JOIN trade t ON t.year = k.year AND exporter_cow = COWcode_a AND importer_cow = COWcode_b
        GROUP BY ALL""",
    "monad_to_dyad": "SELECT iso3a, iso3b, year, influence, COWcode_a, COWcode_b, hihosta, fatlev, country_a, country_b, "
    + r(
        "RED_export_importance "
        + " ".join(
            f"{c}_{s}"
            for s in ("a", "b")
            for c in ("v2x_libdem", "v2x_corr", "v2exl_legitideol", "islmgenpct", "chrstgenpct", "hhi_export", "hhi_import")
        )
    )
    + " FROM dyads",
    "dyad_context": f"""
        SELECT COWcode_a, COWcode_b, year, targeted_democracy, {r('hhi_export_gap islm_dist chrst_dist')} FROM context""",
    "all_pairs_dyads": """
        SELECT a.COWcode AS COWcode_a, b.COWcode AS COWcode_b, a.year, a.country_name AS country_name_a,
               b.country_name AS country_name_b, a.COWcode || '_' || b.COWcode AS dyad_id,
               a.COWcode || '_' || b.COWcode || '_' || a.year AS dyad_year_id,
               round(a.v2x_libdem, 6) AS v2x_libdem_a, round(p.v2x_libdem, 6) AS v2x_libdem_b
        FROM panel a JOIN measures m ON m.u = a.COWcode AND m.y = a.year
        JOIN (SELECT DISTINCT u AS COWcode, 'NATION_' || u AS country_name FROM measures) b ON b.COWcode <> a.COWcode
        LEFT JOIN (SELECT q.* FROM panel q JOIN measures k ON k.u = q.COWcode AND k.y = q.year) p
          ON p.COWcode = b.COWcode AND p.year = a.year""",
    "dyad_distance": """
        SELECT a AS COWcode_a, b AS COWcode_b, y AS year, make_date(y, 1, 1) AS date,
               CASE WHEN p.lat + q.lat IS NOT NULL THEN round(2 * 6371.0088 * asin(sqrt(least(1.0, power(sin(radians(q.lat - p.lat) / 2), 2)
                   + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin(radians(q.lon - p.lon) / 2), 2)))), 3)
               END AS dist_km
        FROM flows
        LEFT JOIN capitals p ON p.COWcode = a AND make_date(y, 1, 1) BETWEEN p.valid_from AND p.valid_to
             AND NOT EXISTS (SELECT 1 FROM capitals o WHERE o.COWcode = p.COWcode AND o.valid_from > p.valid_from
                             AND make_date(y, 1, 1) BETWEEN o.valid_from AND o.valid_to)
        LEFT JOIN capitals q ON q.COWcode = b AND make_date(y, 1, 1) BETWEEN q.valid_from AND q.valid_to
             AND NOT EXISTS (SELECT 1 FROM capitals o WHERE o.COWcode = q.COWcode AND o.valid_from > q.valid_from
                             AND make_date(y, 1, 1) BETWEEN o.valid_from AND o.valid_to)
        WHERE y < 2001""",
    "ideology_extremity": f"""
        SELECT COWcode_a, COWcode_b, year, {r('global_med_ideol ideol_extremity_a ideol_extremity_b')} FROM extreme""",
    "index_raw": """
        SELECT COWcode_a, COWcode_b, year, round(dem_constraint_inv_a, 6) AS dem_constraint_inv_a,
               round(x, 6) AS rev_potential_a, round(z, 6) AS rev_potential_b, round(abs(x - z), 6) AS revisionism_distance
        FROM (SELECT *, (ideol_extremity_a + dem_constraint_inv_a + v2exl_legitideol_a) / 3 AS x,
                     (ideol_extremity_b + dem_constraint_inv_b + v2exl_legitideol_b) / 3 AS z FROM extreme)""",
    "index_z": f"""
        SELECT COWcode_a, COWcode_b, year, {r(
            'z_legit_a z_dem_a z_ext_a z_legit_b z_dem_b z_ext_b rev_potential_a rev_potential_b revisionism_distance')}
        FROM indexed""",
    "spells_to_unit_years": """
        SELECT ccode, year, leadid, startdate AS start_date, enddate AS end_date, start_year, end_year FROM held""",
    "spells_to_unit_years_closed": """
        SELECT ccode, year, leadid, startdate AS start_date, e AS end_date
        FROM (SELECT s.*, CAST(g AS INT) AS year,
                     row_number() OVER (PARTITION BY ccode, g ORDER BY startdate DESC, leadid) AS r
              FROM (SELECT *, CASE WHEN enddate IS NULL OR year(enddate) < year(startdate) THEN DATE '2002-12-31'
                                   ELSE enddate END AS e FROM spells) s,
                   unnest(generate_series(year(startdate), year(e))) t(g)
              WHERE make_date(CAST(g AS INT), 12, 31) BETWEEN startdate AND e)
        WHERE r = 1""",
    "spell_tenure": "SELECT * FROM leaders",
    "dyad_leaders": "SELECT * FROM led",
    "leader_coverage": """
        SELECT count(*) AS total, count(leader_id_a) AS matched_a, count(leader_id_b) AS matched_b,
               count(*) FILTER (leader_id_a IS NOT NULL AND leader_id_b IS NOT NULL) AS matched_both
        FROM led""",
    "leader_events": "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} = 1) AS {c}"
        for c in ("leader_change_a", "leader_change_b", "irregular_entry_a", "irregular_entry_b")
    )
    + " FROM led",
    "leader_tenure_summary": six_number("led", "leader_tenure_years_a leader_tenure_years_b"),
    "sample_rows": """
        SELECT year, COWcode_a, COWcode_b, leader_name_a, leader_tenure_years_a, leader_name_b, leader_tenure_years_b
        FROM led WHERE COWcode_a = 2 AND year >= 1999
        ORDER BY ALL NULLS LAST LIMIT 10""",
    "dyad_master": f"""
        SELECT i.COWcode_a, i.COWcode_b, i.year, hihosta, fatlev,
               CASE WHEN v2x_libdem_b > 0.5 AND v2x_libdem_a < 0.3 THEN 1
                    WHEN NOT (v2x_libdem_b > 0.5 AND v2x_libdem_a < 0.3) THEN 0 END AS targeted_democracy,
               {r('rev_potential_a rev_potential_b revisionism_distance')},
               a.leader_id AS leader_id_a, b.leader_id AS leader_id_b,
               abs(a.leader_tenure_years - b.leader_tenure_years) AS leader_tenure_diff,
               CASE WHEN a.leader_first_year = 1 OR b.leader_first_year = 1 THEN 1
                    WHEN NOT (a.leader_first_year = 1 OR b.leader_first_year = 1) THEN 0 END AS any_leader_new,
               CASE WHEN a.leader_id = b.leader_id THEN 1 ELSE 0 END AS same_leader,
               CASE WHEN a.entry_type = 'Irregular' AND b.entry_type = 'Irregular' THEN 1 ELSE 0 END
                   AS both_irregular_entry
        FROM indexed i LEFT JOIN leaders a ON a.COWcode = COWcode_a AND a.year = i.year
        LEFT JOIN leaders b ON b.COWcode = COWcode_b AND b.year = i.year""",
    "index_summary": six_number("indexed", "rev_potential_a rev_potential_b revisionism_distance"),
    "missing_share": """
        SELECT round(count(*) FILTER (rev_potential_a IS NULL) * 100.0 / count(*), 6) AS missing_percent FROM indexed""",
    "regime_buckets": """
        SELECT CASE WHEN v2x_libdem_a > 0.7 THEN 'Democracy' WHEN v2x_libdem_a < 0.3 THEN 'Autocracy'
                    WHEN v2x_libdem_a IS NOT NULL THEN 'Mixed' END AS regime_cat,
               round(avg(rev_potential_a), 6) AS mean, round(stddev_samp(rev_potential_a), 6) AS sd, count(*) AS n
        FROM indexed GROUP BY 1""",
    "asymmetry": """
        SELECT round(avg(revisionism_distance), 6) AS avg_gap, round(max(revisionism_distance), 6) AS max_gap
        FROM indexed WHERE v2x_libdem_a < 0.3 AND v2x_libdem_b > 0.7""",
    "corr_matrix": correlations("indexed", "rev_potential_a v2x_libdem_a v2exl_legitideol_a ideol_extremity_a"),
    "corr_wide": one_scan_correlations(
        "(SELECT "
        + ", ".join(f"CAST(CASE WHEN key % 61 <> {k} THEN l_quantity * {k} + key % {k + 5} END AS DOUBLE) AS m{k}" for k in range(1, 17))
        + ", l_extendedprice AS price, l_discount AS discount, l_extendedprice * (1 - l_discount) AS paid, CAST(0.1 AS DOUBLE) AS same"
        + " FROM (SELECT *, l_orderkey * 8 + l_linenumber AS key FROM lineitem))",
        [*[f"m{k}" for k in range(1, 17)], "price", "discount", "paid", "same"],
    ),
    "dispersion": " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(stddev_samp({c}), 6) AS sd, round(max({c}) - min({c}), 6) AS range FROM indexed"
        for c in ("v2exl_legitideol_a", "dem_constraint_inv_a", "ideol_extremity_a")
    ),
    "cond_corr": """
        SELECT round(corr(rev_potential_a, hhi_import_b), 6) AS correlation FROM indexed
        WHERE rev_potential_a > (SELECT avg(rev_potential_a) FROM indexed)""",
    "distance_corr": correlations(
        "(SELECT *, abs(v2x_libdem_a - v2x_libdem_b) AS dem_dist FROM indexed)", "revisionism_distance dem_dist"
    ),
    "top_distinct": """
        SELECT DISTINCT iso3a, round(rev_potential_a, 6) AS rev_potential_a FROM indexed WHERE year = 1999
        ORDER BY rev_potential_a DESC NULLS LAST, iso3a LIMIT 10""",
    "missing_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS share,
            rtrim(rtrim(printf('%.2f', round_even(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2)), '0'), '.') || '%'
                AS missing_percent FROM gappy"""
        for c in ("COWcode", "half", "most", "other_half", "nothing", "segment")
    ),
    "coverage": " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, true AS found, count(*) - count({c}) AS missing,
            round_even((1 - (count(*) - count({c})) / count(*)) * 100, 1) AS coverage_percent FROM gappy"""
        for c in ("most", "nothing", "status")
    )
    + " UNION ALL SELECT 'absent', false, NULL, NULL",
    "freq_table": "SELECT segment, count(*) AS n FROM gappy GROUP BY segment",
    "freq_table_known": """
        SELECT segment, status, count(*) AS n FROM gappy WHERE segment IS NOT NULL AND status IS NOT NULL GROUP BY 1, 2""",
    "panel_extent": """
        SELECT count(*) AS n_rows, count(DISTINCT COWcode) AS n_units, min(year) AS first_time, max(year) AS last_time
        FROM gappy""",
    "level_report": " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, true AS found,
            count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS levels FROM gappy"""
        for c in ("segment", "status", "year")
    )
    + " UNION ALL SELECT 'absent', false, 0",
    "typed_features": """
        SELECT 'half' AS variable, coalesce(CAST(CAST(trunc(half / 50000) AS INT) AS VARCHAR), '-1') AS level, count(*) AS n
        FROM gappy GROUP BY 2
        UNION ALL SELECT 'segment', '-1', count(*) FROM gappy
        UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM gappy GROUP BY 2""",
    "contract_check": """
        SELECT contract, column_name, column_name IN ('year', 'hihosta') AS present_before,
               column_name IN ('year', 'hihosta', 'COWcode_a', 'COWcode_b', 'sidea_winning_coalition_size') AS present_after,
               CASE WHEN column_name IN ('year', 'hihosta', 'COWcode_a', 'COWcode_b', 'sidea_winning_coalition_size')
                    THEN (SELECT count(*) FROM disputes) ELSE 0 END AS filled_rows
        FROM (VALUES ('core', 'COWcode_a'), ('core', 'COWcode_b'), ('core', 'year'), ('core', 'v2x_libdem_a'),
            ('core', 'v2x_libdem_b'), ('core', 'hihosta'), ('core', 'v2exl_legitideol_a'), ('core', 'v2exl_legitlead_a'),
            ('core', 'v2exl_legitperf_a'), ('core', 'sidea_national_military_capabilities'),
            ('core', 'sideb_national_military_capabilities'), ('optional', 'sidea_revisionist_domestic'),
            ('optional', 'sidea_religious_support'), ('optional', 'sidea_party_elite_support'),
            ('optional', 'sidea_rural_worker_support'), ('optional', 'sidea_ethnic_racial_support'),
            ('optional', 'sidea_military_support'), ('optional', 'sidea_nationalist_revisionist_domestic'),
            ('optional', 'sidea_socialist_revisionist_domestic'), ('optional', 'sidea_religious_revisionist_domestic'),
            ('optional', 'sidea_reactionary_revisionist_domestic'), ('optional', 'sidea_dynamic_leader'),
            ('optional', 'sidea_winning_coalition_size')) t(contract, column_name)""",
    "alias_rename": "SELECT statea AS COWcode_a, stateb AS COWcode_b, count(*) AS n FROM disputes GROUP BY 1, 2",
    "pattern_select": """
        SELECT l_orderkey, l_linenumber AS l_linenumber_a, round(l_extendedprice, 2) AS l_extendedprice_a FROM lineitem""",
    "clean_names": """
        SELECT n_nationkey AS co_wcode, n_name AS country_name, n_regionkey AS region_percent, n AS n_customers
        FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey""",
    "scalar_rules": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN CAST(o_orderkey AS DOUBLE) END AS number,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey || '_' || o_custkey END AS pair_id,
               o_orderkey || '_' || CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'NA' END AS printed_id,
               round_even((o_orderkey % 1000) / 8, 2) AS even,
               rtrim(rtrim(printf('%.2f', round_even((o_orderkey % 1000) / 8, 2)), '0'), '.') || '%' AS percent
        FROM orders""",
    "csv_roundtrip": "SELECT COWcode, year, round(most, 2) AS most, segment FROM gappy",
    "typed_snapshot": """
        SELECT COWcode, year, round(half, 2) AS half, segment, status, count(*) OVER (PARTITION BY segment) AS n FROM gappy""",
    "read_from_tree": "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS year FROM orders",
    "event_intervals": """
        SELECT "window", count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
        FROM events JOIN windows USING (user_id)
        WHERE (opened IS NULL OR opened <= ts) AND (closed IS NULL OR ts <= closed) GROUP BY "window\"""",
    "event_intervals_left": """
        SELECT event_id, "window" FROM events e LEFT JOIN windows w ON w.user_id = e.user_id AND opened <= ts AND ts <= closed""",
    "event_covered": """
        SELECT event_id, CASE WHEN event_id % 3 <> 0 AND EXISTS (
            SELECT 1 FROM windows w WHERE w.user_id = e.user_id AND (opened IS NULL OR opened <= ts) AND (closed IS NULL OR ts <= closed)
        ) THEN 1 ELSE 0 END AS member FROM events e""",
    "checked_rows": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 50 NOT IN (0, 3, 4, 5) THEN o_orderkey % 1000 / 8 END AS price,
               CASE WHEN o_orderkey % 50 <> 3 THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders WHERE o_orderkey % 50 NOT IN (1, 2)""",
    "checked_quarantine": """
        WITH c AS (SELECT o_orderkey % 50 AS k, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_orderkey % 1000 / 8 AS VARCHAR) AS p, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders)
        SELECT CASE k WHEN 0 THEN a || ',bad,' || d WHEN 1 THEN a || ',' || p WHEN 2 THEN a || ',' || p || ',' || d || ',more' ELSE a || ',bad,never' END AS line,
               CASE k WHEN 0 THEN 'price: bad' WHEN 3 THEN 'price: bad; day: never' ELSE 'cells' END AS problems
        FROM c WHERE k < 4""",
    "checked_counts": """
        SELECT count(*) AS n_lines, count(*) FILTER (o_orderkey % 50 < 4) AS n_rejected,
               CAST(sum(CASE o_orderkey % 50 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END) AS BIGINT) AS n_problems
        FROM orders""",
    "first_in_source": """
        SELECT o_custkey, o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate), o_orderkey DESC) = 1""",
    "observed_counts": """
        WITH c AS (SELECT g.*, n.n_nationkey IS NOT NULL AS found FROM gappy g LEFT JOIN nation n ON n_nationkey = "COWcode" AND n_regionkey < 3),
        k AS (SELECT * FROM c WHERE most IS NOT NULL AND segment IS NOT NULL)
        SELECT 'dropped' AS step, 'n_rows' AS measure, count(*) AS n FROM c
        UNION ALL SELECT 'dropped', 'n_dropped', count(*) FILTER (most IS NULL OR segment IS NULL) FROM c
        UNION ALL SELECT 'dropped', 'missing_most', count(*) FILTER (most IS NULL) FROM c
        UNION ALL SELECT 'dropped', 'missing_segment', count(*) FILTER (segment IS NULL) FROM c
        UNION ALL SELECT 'matched', 'n_rows', count(*) FROM k
        UNION ALL SELECT 'matched', 'n_matched', count(*) FILTER (found) FROM k""",
    "batch_rows": """
        SELECT CASE WHEN year < 1996 THEN 'early' WHEN year < 1998 THEN 'ragged' ELSE 'late' END AS batch, iso2c, year,
               CASE WHEN year < 1998 OR year % 2 = 1 THEN round(gdp_pc, 4) END AS gdp_pc,
               CASE WHEN year NOT IN (1996, 1997) THEN round(CAST(pop AS DOUBLE), 4) END AS pop
        FROM economy""",
    "batch_status": """
        SELECT * FROM (VALUES ('early', true, false), ('ragged', true, false), ('broken', false, true), ('late', true, false),
                              ('foreign', false, true), ('absent', false, true)) t(batch, loaded, reported)""",
    "saved_name_map": """
        SELECT * FROM (VALUES ('iso2c', 'iso2c'), ('year', 'year'), ('NY.GDP.PCAP.PP.KD', 'ny_gdp_pcap_pp_kd'),
                              ('SP.POP.TOT', 'sp_pop_tot'), ('NY.GDP.TOTL.RT.ZS', 'ny_gdp_totl_rt_zs')) t(original_tag, clean_name)""",
    "finite_values": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 3 THEN round(o_totalprice, 2) END AS value, o_orderkey % 5 = 4 AS was_null
        FROM orders""",
    "codebook": """
        WITH p AS (SELECT u, y, CASE WHEN n % 3 <> 0 THEN CAST(n % 2 AS INT) END AS aut, CAST(n % 4 AS INT) AS gli, u % 2 = 0 AS has
                   FROM measures),
        q AS (SELECT coalesce('"' || aut || '"', 'null') AS level, count(*) AS n FROM p GROUP BY 1)
        SELECT 'extent' AS section, '{"first_time":' || min(y) || ',"last_time":' || max(y) || ',"n_rows":' || count(*)
               || ',"n_units":' || count(DISTINCT u) || '}' AS entry FROM p
        UNION ALL SELECT 'coverage', '{"coverage_percent":' || CAST(round(100.0 * count(*) FILTER (has) / count(*), 1) AS DOUBLE)
               || ',"found":true,"missing":' || count(*) FILTER (NOT has) || ',"variable":"fraser_bmp_score"}' FROM p
        UNION ALL SELECT 'coverage', '{"coverage_percent":null,"found":false,"missing":null,"variable":"unified_corruption"}'
        UNION ALL SELECT 'table_is_aut_episode', '{"is_aut_episode":' || level || ',"n":' || n || '}' FROM q
        UNION ALL SELECT 'levels', '{"found":' || (variable IN ('is_aut_episode', 'gli_leader_ideology_num')) || ',"levels":'
               || CASE variable WHEN 'is_aut_episode' THEN (SELECT count(*) FROM q) WHEN 'gli_leader_ideology_num' THEN (SELECT count(DISTINCT gli) FROM p) ELSE 0 END
               || ',"variable":"' || variable || '"}'
        FROM (SELECT unnest(['is_petro_state', 'is_aut_episode', 'is_dem_episode', 'alba_member', 'mid_onset', 'is_leftist_leader', 'is_rightist_leader',
                             'gli_leader_ideology_num', 'fatality']) AS variable)
        UNION ALL SELECT 'missing', '{"missing_percent":"' || rtrim(rtrim(format('{:.2f}', round(share, 2)), '0'), '.') || '%","share":' || share || ',"variable":"' || variable || '"}'
        FROM (SELECT unnest(['COWcode', 'year', 'is_aut_episode', 'gli_leader_ideology_num', 'fraser_bmp_score']) AS variable,
                     unnest([0.0, 0.0, count(*) FILTER (aut IS NULL) * 100.0 / count(*), 0.0, count(*) FILTER (NOT has) * 100.0 / count(*)]::DOUBLE[]) AS share FROM p)
        UNION ALL SELECT 'export', '{"is_aut_episode":' || level || ',"n":' || n || '}' FROM q
        UNION ALL SELECT 'table_gli_leader_ideology_num', '{"gli_leader_ideology_num":"' || gli || '","n":' || count(*) || '}'
        FROM p GROUP BY gli""",
    "staged_replace": "SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_acctbal > 0",
    "clean_sequences_frame": """
        SELECT CAST(u AS VARCHAR) AS COWcode, y AS year, round((o_orderkey % 100) / 100, 6) AS v2x_libdem,
               round(coalesce(gdp, 0), 6) AS unified_gdp_pc, round(o_totalprice / 3, 6) AS unified_pop,
               round(coalesce(rents, 0), 6) AS resource_rents,
               CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 7) / 2 ELSE 0 END AS gini_disp,
               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(trunc((o_orderkey % 9) / 4) AS INT) AS VARCHAR) ELSE '-1' END
                   AS mid_max_hostility,
               '-1' AS is_petro_state, o_orderkey,
               round(coalesce(ln(1 + gdp), 0), 6) AS log_gdp_pc, round(ln(1 + o_totalprice / 3), 6) AS log_pop,
               y AS time_idx
        FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN greatest(o_totalprice - 100000, 0) END AS gdp,
                     CASE WHEN o_orderkey % 2 = 0 THEN greatest(CAST(o_orderkey % 50 - 10 AS DOUBLE), 0) END AS rents
              FROM unit_orders)
        WHERE o_orderkey % 17 <> 0 AND o_orderkey % 13 <> 0""",
    "split_by_time": """
        SELECT CASE WHEN day <= (SELECT max(day) FROM daily) - 5 THEN 'train' ELSE 'holdout' END AS split, day, count(*) AS n
        FROM daily GROUP BY 1, 2""",
    "fill_daily_steps": "SELECT user_id, day, n_events, round(value, 6) AS value FROM steps",
    "sequence_samples": """
        SELECT user_id, cut, CAST(encoder_length AS INT) AS encoder_length, CAST(decoder_length AS INT) AS decoder_length
        FROM cuts""",
    "sequence_window_steps": """
        SELECT c.user_id, cut, CAST(encoder_length AS INT) AS encoder_length,
               CASE WHEN day < cut THEN 'encoder' ELSE 'decoder' END AS role, day, round(value, 6) AS value,
               round((day - cut) / 20, 6) AS relative_time_idx
        FROM cuts c JOIN steps s ON s.user_id = c.user_id AND day BETWEEN cut - 20 AND cut + 4""",
    "sample_index": f"""
        {ALL_SAMPLES}
        SELECT user_id, start, length, encoder_length, length - encoder_length AS decoder_length, start + encoder_length AS cut FROM idx""",
    "sample_steps": f"""
        {ALL_SAMPLES}
        SELECT s.user_id, start + encoder_length AS cut, encoder_length, CASE WHEN day < start + encoder_length THEN 'encoder' ELSE 'decoder' END AS role,
               day, round(value, 6) AS value, round((day - start - encoder_length) / 20, 6) AS relative_time_idx
        FROM idx JOIN steps s ON s.user_id = idx.user_id AND day BETWEEN start AND start + length - 1""",
    "training_chain": """
        WITH d AS (SELECT user_id, day, CASE WHEN user_id % 7 <> 0 THEN value END AS value FROM daily),
        t AS (SELECT * FROM d WHERE day <= (SELECT max(day) FROM d) - 5),
        ts AS (SELECT g.user_id, g.day, last_value(value IGNORE NULLS) OVER w AS value, lo
               FROM (SELECT user_id, min(day) AS lo, CAST(unnest(generate_series(min(day), max(day))) AS INT) AS day FROM t GROUP BY user_id) g
               LEFT JOIN t ON t.user_id = g.user_id AND t.day = g.day
               WINDOW w AS (PARTITION BY g.user_id ORDER BY g.day ROWS UNBOUNDED PRECEDING)),
        z AS (SELECT user_id, avg(x) AS m, stddev_samp(x) AS s
              FROM (SELECT user_id, greatest(value, 1e-8) + ln(1 - exp(-greatest(value, 1e-8))) AS x FROM ts WHERE value IS NOT NULL) GROUP BY 1),
        a AS (SELECT c.user_id, 'train' AS part, c.day AS cut, CASE WHEN s.day < c.day THEN 'encoder' ELSE 'decoder' END AS role, s.day, s.value
              FROM ts c JOIN ts s ON s.user_id = c.user_id AND s.day BETWEEN c.day - 20 AND c.day + 4 WHERE c.day - c.lo >= 10
              UNION ALL
              SELECT s.user_id, 'validation', hi - 4, CASE WHEN day > hi - 5 THEN 'decoder' ELSE 'encoder' END, day,
                     CASE WHEN s.user_id % 7 <> 0 THEN value END
              FROM steps s JOIN (SELECT user_id, max(day) AS hi FROM daily GROUP BY 1 HAVING max(day) - min(day) + 1 >= 20) m ON m.user_id = s.user_id
              WHERE day >= hi - 24)
        SELECT a.user_id, part, CAST(cut AS INT) AS cut, role, day, round(value, 5) AS value, round((day - cut) / 20, 5) AS relative_time_idx,
               round(x, 5) AS target_softplus_inv, round(m, 5) AS target_center, round(s, 5) AS target_scale,
               round((x - m) / nullif(s, 0), 5) AS target_normalized
        FROM (SELECT *, CASE WHEN value IS NOT NULL THEN greatest(value, 1e-8) + ln(1 - exp(-greatest(value, 1e-8))) END AS x FROM a) a
        LEFT JOIN z ON z.user_id = a.user_id""",
    "latest_window": """
        SELECT d.user_id, day, round(value, 6) AS value, CASE WHEN day > hi - 5 THEN 'decoder' ELSE 'encoder' END AS role,
               day - (hi - 4) AS relative_step
        FROM steps d JOIN (SELECT user_id, max(day) AS hi FROM daily GROUP BY 1 HAVING max(day) - min(day) + 1 >= 20) m
          ON m.user_id = d.user_id
        WHERE day >= hi - 24""",
    "normalize_groups": """
        SELECT u, o_orderkey, round(t, 6) AS target, round(x, 6) AS target_softplus_inv,
               round(avg(x) OVER w, 6) AS target_center, round(stddev_samp(x) OVER w, 6) AS target_scale,
               round((x - avg(x) OVER w) / stddev_samp(x) OVER w, 6) AS target_normalized
        FROM (SELECT u, o_orderkey, o_totalprice / 70000 AS t,
                     o_totalprice / 70000 + ln(1 - exp(-o_totalprice / 70000)) AS x FROM unit_orders)
        WINDOW w AS (PARTITION BY u)""",
    "pinball_loss": " UNION ALL ".join(
        f"""SELECT CAST({q} AS DOUBLE) AS quantile, round(avg(greatest(({q} - 1) * e, {q} * e)), 7) AS loss
            FROM (SELECT o_totalprice / 1000 - (500 * {q} + o_orderkey % 10) AS e FROM orders)"""
        for q in (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
    ),
    "impute_deterministic": """
        WITH m AS (SELECT avg(income) AS y, avg(l_quantity) AS a, avg(l_extendedprice) AS b,
                          var_pop(l_quantity) AS aa, var_pop(l_extendedprice) AS bb,
                          covar_pop(l_quantity, l_extendedprice) AS ab, covar_pop(l_quantity, income) AS ay,
                          covar_pop(l_extendedprice, income) AS by_ FROM imputable WHERE income IS NOT NULL),
        f AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS p, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM m)
        SELECT l_orderkey, l_linenumber, round(v, 7) AS income, round(ln(1 + v), 7) AS log_income
        FROM (SELECT l_orderkey, l_linenumber,
                     coalesce(income, y + p * (l_quantity - a) + q * (l_extendedprice - b)) AS v FROM imputable, f)""",
    "impute_chained": chained_rounds(2),
    "impute_sampled_kept": """
        SELECT l_orderkey, l_linenumber, round(income, 7) AS income, round(wealth, 7) AS wealth, round(rents, 7) AS rents, 3 AS filled
        FROM imputable""",
    "impute_report": """
        SELECT 'income' AS variable, count(*) - count(income) AS filled FROM imputable
        UNION ALL SELECT 'wealth', count(*) - count(wealth) FROM imputable""",
}


def _with_views(body: str) -> str:
    """Merge a body's own WITH list behind the shared views."""
    text = body.strip()
    if not text.startswith("WITH"):
        return sql(text)
    shared = sql(text.replace("WITH", "", 1))
    if not shared.startswith("WITH"):
        return text
    head, tail = shared[: -len(text.replace("WITH", "", 1))].rstrip(), text.replace("WITH", "", 1)
    return f"{head}, {tail}"


ORACLE = {name: _with_views(body) for name, body in BODIES.items()}

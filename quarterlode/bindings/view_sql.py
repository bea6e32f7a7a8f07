"""The views of ``views.py`` in SQL, as common table expressions."""

from __future__ import annotations

import re


def period_sql(date: str, later: int = 12) -> str:
    return f"printf('%02dq%d', CAST((year({date})+{later})%100 AS INT), CAST(quarter({date}) AS INT))"


def day_sql(date: str) -> str:
    return f"CAST(year({date})*10000 + month({date})*100 + day({date}) AS BIGINT)"


def current_sql(date: str) -> str:
    return f"(year({date})+12)*10 + quarter({date}) > 20123"


VIEWS = {
    "demo": f"""
        SELECT o_orderkey AS primaryid, o_custkey AS caseid, {day_sql('o_orderdate')} AS event_dt,
               o_orderpriority AS rept_cod, o_orderstatus AS sex, {period_sql('o_orderdate')} AS period
        FROM orders""",
    "drug": f"""
        SELECT l_orderkey AS primaryid, o_custkey AS caseid, CAST(l_linenumber AS BIGINT) AS drug_seq,
               p_name AS drugname, CASE WHEN l_partkey%3<>0 THEN upper(p_type) END AS prod_ai,
               {period_sql('l_shipdate')} AS period
        FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey""",
    "reac": f"""
        SELECT event_id AS primaryid, user_id AS caseid,
               CASE WHEN event_id%7<>0 THEN upper(event_type) END AS pt, props AS drug_rec_act,
               CAST(1700000000 AS BIGINT) AS processing_time, {period_sql('ts', 0)} AS period
        FROM events""",
    "indi": """
        SELECT primaryid, caseid, primaryid%5 AS indi_drug_seq, pt AS indi_pt, processing_time, period
        FROM reac""",
    "outc": f"""
        SELECT o_orderkey AS primaryid, o_custkey AS caseid, o_orderstatus AS outc_cod,
               CAST(1700000000 AS BIGINT) AS processing_time, {period_sql('o_orderdate')} AS period
        FROM orders""",
    "rpsr": f"""
        SELECT o_orderkey AS primaryid, o_custkey AS caseid, o_orderpriority AS rpsr_cod,
               CAST(1700000000 AS BIGINT) AS processing_time, {period_sql('o_orderdate')} AS period
        FROM orders""",
    "ther": f"""
        SELECT l_orderkey AS primaryid, o_custkey AS caseid, CAST(l_linenumber AS BIGINT) AS dsg_drug_seq,
               {day_sql('l_shipdate')} AS start_dt, l_quantity AS dur, 'DAY' AS dur_cod,
               {period_sql('l_shipdate')} AS period
        FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "deleted": """
        SELECT c_custkey AS caseid FROM customer WHERE c_acctbal<0
        UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal<0
        UNION ALL SELECT NULL""",
    "gone": "SELECT DISTINCT caseid FROM deleted WHERE caseid IS NOT NULL",
    "meddra_pt": """
        SELECT * FROM (VALUES ('click',1001,10,'1,2','9'),('view',1002,10,'1',NULL),('purchase',1003,11,NULL,NULL))
            v(pt,pt_code,pt_soc_code,nnmq_codes,smq_codes)""",
    "llt": """
        SELECT * FROM (VALUES ('error',1002,10,'3','8')) v(llt_name,pt_code,pt_soc_code,nnmq_codes,smq_codes)""",
    "raw_lines": f"""
        SELECT 'demo' || {period_sql('o_orderdate')} || '.txt' AS file, o_orderkey + 1 AS line_no,
               CASE WHEN {current_sql('o_orderdate')}
                    THEN 'primaryid$caseid$caseversion$event_dt$auth_num$ rept_dt$rept_cod$sex$wt$site_note'
                    ELSE 'ISR$CASE$I_F_COD$EVENT_DT$REPT_COD$GNDR_COD$WT$CONFID' END AS header,
               CASE WHEN {current_sql('o_orderdate')}
                    THEN concat_ws('$', o_orderkey, o_custkey, '1', {day_sql('o_orderdate')},
                         '"' || o_orderstatus || '$' || o_orderstatus || '"', {day_sql('o_orderdate')},
                         '"' || o_orderpriority || '"', o_orderstatus, CAST(floor(o_totalprice) AS BIGINT),
                         'note ' || o_orderstatus)
                    ELSE concat_ws('$', o_orderkey, o_custkey, 'I', {day_sql('o_orderdate')},
                         '"' || o_orderpriority || '"', o_orderstatus, CAST(floor(o_totalprice) AS BIGINT),
                         'N', '') END AS line
        FROM orders""",
    "parsed_demo": f"""
        SELECT o_orderkey AS primaryid, o_custkey AS caseid,
               CASE WHEN {current_sql('o_orderdate')} THEN CAST(1 AS BIGINT) END AS caseversion,
               {day_sql('o_orderdate')} AS event_dt,
               CASE WHEN {current_sql('o_orderdate')} THEN o_orderstatus || '$' || o_orderstatus END AS auth_num,
               CASE WHEN {period_sql('o_orderdate')} IN ('12q4','13q1') THEN {day_sql('o_orderdate')} END AS rept_dt,
               o_orderpriority AS rept_cod, o_orderstatus AS sex, floor(o_totalprice) AS wt,
               CAST(1700000000 AS BIGINT) AS processing_time, {period_sql('o_orderdate')} AS period
        FROM orders""",
    "vocab": """
        SELECT DISTINCT string_split(p_name,' ')[2] AS entity FROM part
        WHERE string_split(p_name,' ')[2] <> 'bolt'""",
    "concepts": "SELECT 'C-' || entity AS rxcui, entity AS name FROM vocab",
    "drug_names": """
        SELECT DISTINCT lower(drugname) AS drugname, lower(prod_ai) AS prod_ai,
               coalesce(regexp_replace(lower(prod_ai),'([()/+])',' \\1 ','g'),
                        regexp_replace(lower(drugname),'([()/+])',' \\1 ','g')) AS term
        FROM drug""",
    "term_entities": """
        SELECT n.drugname, n.prod_ai, n.term, coalesce(v.entity, trim(n.term)) AS entity
        FROM drug_names n LEFT JOIN vocab v ON contains(' ' || n.term || ' ', ' ' || v.entity || ' ')""",
    "related_rows": """
        SELECT 'C-' || noun AS rxcui, page, 'I-' || CAST(page%50 AS VARCHAR) AS related_rxcui, p_type AS name,
               CASE WHEN noun IN ('plate','ring') THEN 'SCD'
                    ELSE CASE page%4 WHEN 0 THEN 'IN' WHEN 1 THEN 'PIN' WHEN 2 THEN 'SCD' ELSE 'SBD' END END AS tty
        FROM (SELECT p_partkey AS page, p_type, string_split(p_name,' ')[2] AS noun FROM part)
        WHERE noun NOT IN ('bolt','gear')
        UNION ALL
        SELECT 'S-' || CAST(p_partkey%20 AS VARCHAR), p_partkey, 'I-' || CAST(p_partkey%7+45 AS VARCHAR), p_type, 'IN'
        FROM part WHERE string_split(p_name,' ')[2] = 'plate'""",
    "related": """
        SELECT rxcui, related_rxcui, arg_max(name, page) AS name, arg_max(tty, page) AS tty, min(page) AS first_page
        FROM related_rows WHERE tty IN ('IN','PIN') GROUP BY ALL""",
    "plates": """
        SELECT p_partkey AS page, p_brand, p_type FROM part WHERE string_split(p_name,' ')[2] = 'plate'""",
    "history_names": """
        SELECT 'C-plate' AS rxcui, id AS related_rxcui, arg_max(name, page*10+rank) AS name,
               min(page*10+rank) AS pos
        FROM (SELECT page, 0 AS rank, 'I-' || CAST(page%60 AS VARCHAR) AS id, p_brand AS name FROM plates
              UNION ALL SELECT page, 1, 'I-' || CAST(page%30 AS VARCHAR), p_type FROM plates)
        GROUP BY id""",
    "history_leads": """
        SELECT 'C-plate' AS rxcui, id AS related_rxcui, arg_max(name, page*10+rank) AS name,
               arg_max(tty, page*10+rank) AS tty, arg_max(active, page*10+rank) AS active, min(page*10+rank) AS pos
        FROM (SELECT page, 2 AS rank, 'I-' || CAST(page%5 AS VARCHAR) AS id, p_type AS name, 'IN' AS tty, 'YES' AS active FROM plates
              UNION ALL SELECT page, 3, 'R-' || CAST(page%4 AS VARCHAR), p_brand, 'SBD', 'YES' FROM plates
              UNION ALL SELECT page, 4, 'S-' || CAST(page%20 AS VARCHAR), p_type, 'SCD', '' FROM plates
              UNION ALL SELECT page, 5, 'Q-' || CAST(page%3 AS VARCHAR), p_type, 'QD', '' FROM plates)
        GROUP BY id""",
    "led_to": """
        SELECT l.rxcui, r.related_rxcui, r.name, r.tty, l.pos AS c, r.first_page AS r
        FROM history_leads l JOIN related r ON l.related_rxcui = r.rxcui WHERE l.tty IN ('SCD','QD')
        UNION ALL
        SELECT rxcui, related_rxcui, name, tty, pos, -1 FROM history_leads WHERE tty IN ('IN','PIN')""",
    "history_all": """
        SELECT rxcui, related_rxcui, arg_max(name, c*1000000000+r) AS name, arg_max(tty, c*1000000000+r) AS tty,
               0 AS source, min(c*1000000000+r) AS pos
        FROM led_to GROUP BY rxcui, related_rxcui
        UNION ALL
        SELECT rxcui, related_rxcui, name, NULL, 1, pos FROM history_names
        WHERE related_rxcui NOT IN (SELECT related_rxcui FROM led_to)""",
    "classes": """
        SELECT DISTINCT 'I-' || CAST(s_suppkey%60 AS VARCHAR) AS rxcui, n_nationkey AS page,
               'C' || CAST(n_nationkey AS VARCHAR) AS class_id, n_name AS class_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "concept_codes": """
        SELECT i.rxcui, string_agg(c.class_id || '|' || c.class_name || '|ATC1-4', ',' ORDER BY i.source, i.pos, c.page) AS codes, count(*) AS n_codes
        FROM (SELECT rxcui, related_rxcui, 0 AS source, first_page AS pos FROM related
              WHERE rxcui IN (SELECT rxcui FROM concepts)
              UNION ALL SELECT rxcui, related_rxcui, 1 + source, pos FROM history_all) i
        JOIN classes c ON i.related_rxcui = c.rxcui GROUP BY i.rxcui""",
    "entities": "SELECT DISTINCT entity FROM term_entities WHERE entity IS NOT NULL",
    "near": """
        SELECT e.entity, arg_min(c.rxcui, (levenshtein(lower(e.entity), c.name), c.rxcui)) AS rxcui
        FROM entities e CROSS JOIN concepts c GROUP BY e.entity""",
    "resolved": """
        SELECT e.entity, k.codes FROM entities e
        LEFT JOIN near n USING (entity) LEFT JOIN concept_codes k USING (rxcui)""",
    "old_map": "SELECT entity, 'X1|old|ATC1-4' AS codes, 'earlier' AS strategy, CAST(1 AS BIGINT) AS processing_time FROM vocab WHERE length(entity)<=4",
}


def with_views(body: str) -> str:
    """Prepend the views a statement uses, directly or through other views."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    # a view never reads itself, so visiting order is creation order
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    own = body.strip()
    return f"WITH {ctes},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {ctes}\n{own}"

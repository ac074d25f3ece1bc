"""The same results in plain SQL, for a second engine that reads the same tables.

The SQL states each result by its definition (self joins, ranked windows, CASE), not
by the way the Spark operators reach it.
"""

from __future__ import annotations

from carelake.workload.inputs import EM_TOLERANCE, LINK_MODEL, NEW_KEY_OFFSET, SALT


def _token(value: str, salt: str = SALT, digits: int = 64) -> str:
    return f"'DEID-' || substr(sha256({value} || '{salt}'), 1, {digits})"


def _shift_days(person: str) -> str:
    remainder = "0"
    for start in range(1, 65, 8):
        word = f"CAST('0x' || substr(sha256({person}), {start}, 8) AS BIGINT)"
        remainder = f"(({remainder}) * {2**32 % 61} + {word}) % 61"
    return f"CAST({remainder} - 30 AS INTEGER)"


def _ssn(person: str) -> str:
    return (
        f"lpad(CAST({person} % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST({person} % 100 AS VARCHAR), 2, '0')"
        f" || '-' || lpad(CAST({person} % 10000 AS VARCHAR), 4, '0')"
    )


_SSN_RULE = r"'\d{3}-\d{2}-\d{4}', '[REDACTED_SSN]', 'g'"

CONDITIONS = """conditions AS (
    SELECT o_custkey AS person_id, o_orderkey AS condition_occurrence_id,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 201820 ELSE 9201 END AS condition_concept_id,
           CAST(o_orderdate AS DATE) AS condition_start_date,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER) AS condition_end_date
    FROM orders)"""

MEASUREMENTS = """measurements AS (
    SELECT user_id AS person_id, CAST(ts AS DATE) AS measurement_date, value AS value_as_number
    FROM events WHERE event_type = 'purchase')"""

FLAWED = """flawed AS (
    SELECT o_orderkey AS row_key,
           CASE WHEN o_orderkey % 70 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS condition_occurrence_id,
           CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS person_id,
           CASE WHEN o_orderkey % 30 = 0 THEN -1 WHEN o_orderkey % 11 <> 0 THEN 32020 END AS condition_concept_id
    FROM orders)"""

_REASONS = """concat_ws(',',
                   CASE WHEN person_id IS NULL THEN 'complete(person_id)' END,
                   CASE WHEN condition_occurrence_id IS NULL THEN 'complete(condition_occurrence_id)' END,
                   CASE WHEN condition_concept_id < 0 THEN 'non_negative(condition_concept_id)' END)"""

RECORDS = f"""records AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS payload_id, o_orderpriority AS source_system_id,
           CAST(o_custkey AS VARCHAR) AS patient_id, {_ssn('o_custkey')} AS patient_ssn,
           'MRN' || CAST(o_custkey AS VARCHAR) AS patient_mrn,
           CAST(o_orderdate AS DATE) AS admission_date,
           'Patient admitted. SSN: ' || {_ssn('o_custkey')} || '. Seen as ' || o_orderpriority
               || '; repeat ' || {_ssn('o_custkey')} || '.' AS clinical_notes
    FROM orders)"""

_ESCAPED_PROPS = """replace(props, '"', '\\"')"""
_IMAGE = (
    """'{"id":' || event_id || ',"person":' || user_id || ',"props":"' || """ + _ESCAPED_PROPS + """ || '"}'"""
)
CHANGE_LINES = f"""lines AS (
    SELECT event_id, op,
           '{{"payload":{{"' || CASE WHEN op = 'd' THEN 'before' ELSE 'after' END || '":' || {_IMAGE}
               || ',"source":{{"db":"events"}},"op":"' || op || '"}}}}' AS line
    FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u'
                         WHEN 'error' THEN 'd' ELSE 'r' END AS op FROM events))"""


def _op(number: str) -> str:
    return f"CASE {number} % 5 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' WHEN 4 THEN 'x' END"


TARGET = """target AS (
    SELECT o_orderkey AS condition_occurrence_id, o_custkey AS person_id, 32020 AS condition_concept_id,
           CAST(o_orderdate AS DATE) AS updated_at, 'c' AS cdc_op
    FROM orders)"""

CHANGES = f"""changes AS (
    SELECT CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + {NEW_KEY_OFFSET} ELSE o_orderkey END
               AS condition_occurrence_id,
           o_custkey AS person_id, 32021 AS condition_concept_id,
           CASE WHEN o_orderkey % 13 <> 0
                THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INTEGER) END AS updated_at,
           {_op('o_orderkey')} AS cdc_op
    FROM orders)"""

REPEATED = f"""versions AS (
    SELECT * FROM changes
    UNION ALL
    SELECT condition_occurrence_id, person_id, 32022,
           updated_at + CAST(condition_occurrence_id % 2 AS INTEGER), {_op('(condition_occurrence_id // 5)')}
    FROM changes),
latest AS (
    SELECT condition_occurrence_id, person_id, condition_concept_id, updated_at, cdc_op
    FROM (SELECT *, row_number() OVER (
              PARTITION BY condition_occurrence_id
              ORDER BY updated_at DESC NULLS LAST,
                       CASE WHEN cdc_op = 'd' THEN 3 WHEN cdc_op = 'u' OR cdc_op IS NULL THEN 2
                            WHEN cdc_op = 'c' THEN 1 ELSE 0 END DESC,
                       person_id DESC, condition_concept_id DESC, cdc_op DESC NULLS LAST) AS place
          FROM versions)
    WHERE place = 1)"""


def _merged(changes: str) -> str:
    """The merge by its definition: untouched rows, updated rows, inserted rows."""
    columns = ["person_id", "condition_concept_id", "updated_at", "cdc_op"]
    newer = "coalesce(s.updated_at > t.updated_at, false)"
    update = f"s.condition_occurrence_id IS NOT NULL AND {newer} AND (s.cdc_op = 'u' OR s.cdc_op IS NULL)"
    picked = ", ".join(f"CASE WHEN {update} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    return f"""
    SELECT t.condition_occurrence_id, {picked}
    FROM target t LEFT JOIN {changes} s ON t.condition_occurrence_id = s.condition_occurrence_id
    WHERE NOT (s.condition_occurrence_id IS NOT NULL AND {newer} AND coalesce(s.cdc_op = 'd', false))
    UNION ALL
    SELECT s.condition_occurrence_id, {", ".join(f"s.{c}" for c in columns)}
    FROM {changes} s ANTI JOIN target t ON t.condition_occurrence_id = s.condition_occurrence_id
    WHERE s.cdc_op IN ('c', 'u') OR s.cdc_op IS NULL"""


def _readmissions(source: str) -> str:
    return f"""
    SELECT person_id, total_index_admissions, total_30_day_readmissions,
           CAST(total_30_day_readmissions AS DOUBLE) / total_index_admissions AS readmission_rate
    FROM (SELECT a.person_id,
                 count(DISTINCT a.condition_occurrence_id) AS total_index_admissions,
                 count(DISTINCT b.condition_occurrence_id) AS total_30_day_readmissions
          FROM {source} a JOIN {source} b
            ON a.person_id = b.person_id AND a.condition_occurrence_id <> b.condition_occurrence_id
           AND b.condition_start_date > a.condition_start_date
           AND b.condition_start_date <= a.condition_start_date + 30
          GROUP BY a.person_id)"""


def _readmission_days() -> str:
    return """
        SELECT i.person_id, i.condition_start_date AS admission_date, i.condition_end_date AS discharge_date,
               s.condition_start_date AS readmission_date,
               CASE WHEN s.condition_start_date IS NOT NULL THEN 1 ELSE 0 END AS is_readmitted_30_days,
               count(s.condition_start_date) AS n_readmissions
        FROM (SELECT * FROM conditions WHERE condition_concept_id = 9201) i
        LEFT JOIN (SELECT * FROM conditions WHERE condition_concept_id = 9201) s
          ON i.person_id = s.person_id AND s.condition_start_date > i.condition_end_date
         AND s.condition_start_date <= i.condition_end_date + 30
        GROUP BY i.condition_occurrence_id, i.person_id, i.condition_start_date, i.condition_end_date,
                 s.condition_start_date"""


def _hedis(value: str) -> str:
    return f"WITH {CONDITIONS}, {MEASUREMENTS}, {_tests(value, 'persons')}"


def _tests(value: str, first: str = "WITH persons") -> str:
    """The mart of tests over `conditions` and `measurements`, after a WITH or as one."""
    return f"""{first} AS (SELECT DISTINCT person_id FROM conditions WHERE condition_concept_id = 201820)
    SELECT p.person_id, CASE WHEN m.person_id IS NOT NULL THEN 1 ELSE 0 END AS had_hba1c_test,
           max(m.measurement_date) AS last_test_date, {value} AS last_test_value
    FROM persons p LEFT JOIN measurements m ON p.person_id = m.person_id
    GROUP BY p.person_id, CASE WHEN m.person_id IS NOT NULL THEN 1 ELSE 0 END"""


ORIGINALS = """originals AS (
    SELECT c_custkey AS unique_id, c_nationkey AS nation, c_name AS name, c_mktsegment AS segment,
           c_acctbal AS balance
    FROM customer)"""

COPIES = f"""copies AS (
    SELECT c_custkey + {NEW_KEY_OFFSET} AS unique_id, c_nationkey AS nation,
           CASE WHEN c_custkey % 4 = 0 THEN c_name || 'x' ELSE c_name END AS name,
           CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment,
           CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance
    FROM customer)"""

PERSONS = f"""{ORIGINALS}, {COPIES}, persons AS (SELECT * FROM originals UNION ALL SELECT * FROM copies)"""

COMPARED = ("name", "segment", "balance")


def _gamma(column: str) -> str:
    return (
        f"CASE WHEN l.{column} IS NULL OR r.{column} IS NULL THEN -1 "
        f"WHEN l.{column} = r.{column} THEN 1 ELSE 0 END AS gamma_{column}"
    )


_GAMMAS = ", ".join(_gamma(c) for c in COMPARED)
_GAMMA_NAMES = ", ".join(f"gamma_{c}" for c in COMPARED)


def _weight() -> str:
    parts = [f"log2({LINK_MODEL.prior} / (1 - {LINK_MODEL.prior}))"]
    for c in COMPARED:
        m, u = LINK_MODEL.m[c], LINK_MODEL.u[c]
        parts.append(
            f"CASE gamma_{c} WHEN 1 THEN log2({m}::DOUBLE / {u}::DOUBLE) "
            f"WHEN 0 THEN log2((1 - {m}::DOUBLE) / (1 - {u}::DOUBLE)) ELSE 0 END"
        )
    return " + ".join(parts)


def _scored(left: str, right: str, on: str) -> str:
    sides = ", ".join(f"{s}.{c} AS {c}_{s}" for c in COMPARED for s in ("l", "r"))
    return f"""pairs AS (
    SELECT l.unique_id AS unique_id_l, r.unique_id AS unique_id_r, l.nation, {sides}, {_GAMMAS}
    FROM {left} l JOIN {right} r ON l.nation = r.nation AND {on}),
weighed AS (SELECT *, {_weight()} AS match_weight FROM pairs),
scored AS (
    SELECT *, 1 / (1 + pow(2::DOUBLE, -match_weight)) AS match_probability FROM weighed
    WHERE 1 / (1 + pow(2::DOUBLE, -match_weight)) >= 0.8)"""


_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, "
    f"(SELECT sum(n * (n - 1) // 2) FROM (SELECT count(*) AS n FROM persons WHERE {c} IS NOT NULL GROUP BY {c})) AS agree, "
    f"(SELECT count({c}) * (count({c}) - 1) // 2 FROM persons) AS pairs"
    for c in COMPARED
)

def _odds() -> str:
    parts = ["prior / (1 - prior)"]
    for c in COMPARED:
        parts.append(f"CASE gamma_{c} WHEN 1 THEN m_{c} / u_{c} WHEN 0 THEN (1 - m_{c}) / (1 - u_{c}) ELSE 1 END")
    return " * ".join(parts)


_NEXT_M = ", ".join(
    f"sum(share) FILTER (gamma_{c} = 1) / sum(share) FILTER (gamma_{c} <> -1) AS m_{c}" for c in COMPARED
)
_CHANGES = ", ".join(f"abs(m_{c} - was_{c})" for c in COMPARED)
_U = ", ".join(f"max(u) FILTER (column_name = '{c}') AS u_{c}" for c in COMPARED)
_MODEL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(m_{c}, 6) AS m, round(u_{c}, 6) AS u, round(prior, 6) AS prior FROM last"
    for c in COMPARED
)

EM = f"""rates AS (SELECT column_name, CAST(agree AS DOUBLE) / pairs AS u FROM ({_RATES})),
    u AS (SELECT {_U} FROM rates),
    patterns AS (
        SELECT {_GAMMAS}, CAST(count(*) AS DOUBLE) AS n
        FROM persons l JOIN persons r ON l.nation = r.nation AND l.unique_id < r.unique_id
        GROUP BY ALL),
    em AS (
        SELECT 0 AS round, 1::DOUBLE AS change, 0.01::DOUBLE AS prior, {", ".join(f"0.9::DOUBLE AS m_{c}" for c in COMPARED)}
        UNION ALL
        SELECT round + 1, greatest(abs(prior - was), {_CHANGES}), prior, {", ".join(f"m_{c}" for c in COMPARED)}
        FROM (SELECT round, max(prior) AS was, {", ".join(f"max(m_{c}) AS was_{c}" for c in COMPARED)},
                     sum(share) / sum(n) AS prior, {_NEXT_M}
              FROM (SELECT *, n * odds / (1 + odds) AS share
                    FROM (SELECT *, {_odds()} AS odds FROM em, patterns, u WHERE change >= {EM_TOLERANCE}))
              GROUP BY round)),
    last AS (SELECT * FROM em, u ORDER BY round DESC LIMIT 1)"""

CHAIN = f"""payloads AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS condition_occurrence_id,
           CASE WHEN o_orderkey % 50 <> 0 THEN {_token("'MRN' || CAST(o_custkey AS VARCHAR)")} END AS person_id,
           CAST(o_orderdate AS DATE) + {_shift_days('CAST(o_custkey AS VARCHAR)')} AS condition_start_date
    FROM orders)"""

_MRN = _token("'MRN' || CAST(o_custkey AS VARCHAR)")
_SHIFT = _shift_days("CAST(o_custkey AS VARCHAR)")

# Feeds `orders` and `refills` after the first day, and after the changes, the rerun and the correction.
FIRST_DAY = f"""landed AS (
    SELECT feed || '/ORDERS/' || o_orderkey AS condition_occurrence_id,
           CASE WHEN o_orderkey % 50 <> 0 THEN {_MRN} END AS person_id,
           CAST(o_orderdate AS DATE) + later + {_SHIFT} AS condition_start_date
    FROM orders, (VALUES ('orders', 0), ('refills', 1)) feeds(feed, later)),
    zones AS (SELECT CASE WHEN person_id IS NULL THEN 'dead' ELSE 'silver' END AS zone, * FROM landed)"""
CORRECTED = f"""changed AS (
    SELECT 'silver' AS zone, 'orders/ORDERS/' || o_orderkey AS condition_occurrence_id, {_MRN} AS person_id,
           CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 4 = 1 THEN 7 ELSE 0 END + {_SHIFT} AS condition_start_date
    FROM orders WHERE o_orderkey % 4 <> 0),
    {FIRST_DAY},
    corrected AS (
        SELECT * FROM changed UNION ALL SELECT * FROM zones WHERE condition_occurrence_id LIKE 'refills/%')"""

# Stays and tests as they are after three days.
_PATIENT = "CAST(o_custkey + CASE WHEN o_orderkey % 8 = 2 THEN 1 ELSE 0 END AS VARCHAR)"
STAY_LAKE = f"""conditions AS (
        SELECT o_orderkey AS condition_occurrence_id, {_token(f"'MRN' || {_PATIENT}")} AS person_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 201820 ELSE 9201 END AS condition_concept_id,
               CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 4 = 1 THEN 7 ELSE 0 END + {_shift_days(_PATIENT)} AS condition_start_date,
               condition_start_date + CAST(o_orderkey % 7 AS INTEGER) AS condition_end_date
        FROM orders WHERE o_orderkey % 4 <> 0),
    measurements AS (
        SELECT {_token("'MRN' || CAST(user_id AS VARCHAR)")} AS person_id,
               CAST(ts AS DATE) + {_shift_days("CAST(user_id AS VARCHAR)")} AS measurement_date, value AS value_as_number
        FROM events WHERE event_type = 'purchase' AND event_id % 10 <> 0)"""


def _gold() -> str:
    return f"""WITH {STAY_LAKE},
    again AS ({_readmissions('conditions')}),
    days AS ({_readmission_days()}),
    tests AS ({_tests('max(m.value_as_number)')})
    SELECT 'readmissions_30_day' AS mart, person_id, CAST(total_index_admissions AS VARCHAR) AS a,
           CAST(total_30_day_readmissions AS VARCHAR) AS b, CAST(NULL AS VARCHAR) AS c FROM again
    UNION ALL
    SELECT 'admission_count', person_id, CAST(count(condition_occurrence_id) AS VARCHAR), NULL, NULL FROM conditions GROUP BY person_id
    UNION ALL
    SELECT 'readmission_days', person_id, admission_date || '/' || discharge_date, CAST(readmission_date AS VARCHAR),
           CAST(n_readmissions AS VARCHAR) FROM days
    UNION ALL
    SELECT 'hedis', person_id, CAST(had_hba1c_test AS VARCHAR), CAST(last_test_date AS VARCHAR),
           CAST(CAST(round(last_test_value, 9) AS DECIMAL(20, 4)) AS VARCHAR) FROM tests"""


LINKED_LAKE = f"""people AS (
        SELECT c_custkey, min({_token("'MRN' || CAST(c_custkey AS VARCHAR)")}) OVER (PARTITION BY c_custkey - c_custkey % 2) AS person_id
        FROM customer),
    conditions AS (
        SELECT o_orderkey AS condition_occurrence_id, person_id,
               CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 4 = 1 THEN 7 ELSE 0 END + {_SHIFT} AS condition_start_date
        FROM orders JOIN people ON c_custkey = o_custkey WHERE o_orderkey % 4 <> 0)"""

ORACLE: dict[str, str] = {
    "land_text": """
        SELECT sha256(concat_ws(chr(31), 'DOCUMENTS', coalesce(source, ''), coalesce(text, ''))) AS payload_id,
               'DOCUMENTS' AS source_system_id, text AS raw_payload_json, DATE '2024-01-01' AS ingestion_date
        FROM documents""",
    "land_lines": r"""
        SELECT line, count(*) AS n_rows, count(*) AS n_ids
        FROM (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents)
        GROUP BY line""",
    "cdc_extract": f"""WITH {CHANGE_LINES}
        SELECT CAST(event_id AS VARCHAR) AS payload_id, 'events' AS source_system_id, line AS raw_payload_json
        FROM lines WHERE op <> 'r' AND event_id % 100 <> 0""",
    "cdc_rejects": f"""WITH {CHANGE_LINES}
        SELECT CASE WHEN event_id % 100 = 0 THEN 'not json ' || event_id ELSE line END AS raw_payload_json
        FROM lines WHERE op = 'r' OR event_id % 100 = 0""",
    "stream_extract": f"""
        SELECT CAST(event_id AS VARCHAR) AS payload_id, event_type AS source_system_id,
               '{{"resourceType":"' || event_type || '","id":"' || event_id || '","payload":"'
                   || {_ESCAPED_PROPS} || '"}}' AS raw_payload_json
        FROM events""",
    "flatten_payload": """
        SELECT CAST(event_id AS VARCHAR) AS payload_id, CAST(user_id AS VARCHAR) AS patient_id, event_type AS kind,
               CASE WHEN event_id % 25 <> 0 THEN CAST(ts AS DATE) END AS day,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "deid_token": f"SELECT c_custkey, {_token('c_name', digits=10)} AS c_name_deid FROM customer",
    "deid_dateshift": f"""
        SELECT o_orderkey,
               CAST(o_orderdate AS DATE) + {_shift_days('CAST(o_custkey AS VARCHAR)')} AS o_orderdate_shifted
        FROM orders""",
    "redact_text": f"""WITH {RECORDS}
        SELECT payload_id, regexp_replace(clinical_notes, {_SSN_RULE}) AS clinical_notes_redacted FROM records""",
    "redact_documents": rf"""
        SELECT doc_id,
               regexp_replace(regexp_replace(regexp_replace(text, {_SSN_RULE}),
                   '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '[REDACTED_EMAIL]', 'g'),
                   '\d{{3}}-\d{{3}}-\d{{4}}', '[REDACTED_PHONE]', 'g') AS text_redacted
        FROM documents""",
    "deid_drop": f"""WITH {RECORDS}
        SELECT payload_id, source_system_id, patient_id, clinical_notes,
               {_token('patient_ssn')} AS patient_ssn_deid, {_token('patient_mrn')} AS patient_mrn_deid,
               admission_date + {_shift_days('patient_id')} AS admission_date_shifted,
               regexp_replace(clinical_notes, {_SSN_RULE}) AS clinical_notes_redacted
        FROM records""",
    "deid_salted": f"""
        SELECT o_orderkey, least(o_custkey % 110, 90) AS age_coded,
               CAST(o_orderdate AS DATE) + {_shift_days(f"CAST(o_custkey AS VARCHAR) || '{SALT}'")} AS admitted_shifted
        FROM orders""",
    "condition_map": f"""WITH {RECORDS},
        shifted AS (SELECT *, admission_date + {_shift_days('patient_id')} AS day FROM records)
        SELECT payload_id AS condition_occurrence_id, {_token('patient_mrn')} AS person_id,
               0 AS condition_concept_id, day AS condition_start_date,
               CAST(day AS TIMESTAMP) AS condition_start_datetime,
               CAST(NULL AS DATE) AS condition_end_date, CAST(NULL AS TIMESTAMP) AS condition_end_datetime,
               32020 AS condition_type_concept_id, source_system_id AS condition_source_value,
               0 AS condition_source_concept_id, CAST(NULL AS VARCHAR) AS condition_status_source_value,
               0 AS condition_status_concept_id
        FROM shifted""",
    "concept_lookup": """
        WITH coded AS (SELECT c_custkey, c_nationkey + 10 * (c_custkey % 3) AS code FROM customer)
        SELECT c_custkey, CAST(code AS VARCHAR) AS condition_source_value,
               coalesce(n_regionkey + 40000, 0) AS condition_concept_id
        FROM coded LEFT JOIN nation ON n_nationkey = code""",
    "dq_metrics": f"""WITH {FLAWED}
        SELECT count(*) AS size, count(*) FILTER (person_id IS NULL) AS no_person,
               count(*) FILTER (condition_occurrence_id IS NULL) AS no_id,
               count(*) FILTER (condition_concept_id < 0) AS negative_concept
        FROM flawed""",
    "dq_report": f"""WITH {FLAWED},
        measured AS (
            SELECT count(*) AS size, count(*) - count(person_id) AS no_person,
                   count(*) - count(condition_occurrence_id) AS no_id,
                   count(*) FILTER (condition_concept_id < 0) AS negative
            FROM flawed),
        lines AS (
            SELECT 'size >= 1' AS "constraint", size >= 1 AS passed, CAST(size AS DOUBLE) AS metric,
                   size || ' rows, at least 1 required' AS message FROM measured
            UNION ALL
            SELECT 'complete(person_id)', no_person = 0, (size - no_person) / size,
                   no_person || ' rows break the rule' FROM measured
            UNION ALL
            SELECT 'complete(condition_occurrence_id)', no_id = 0, (size - no_id) / size,
                   no_id || ' rows break the rule' FROM measured
            UNION ALL
            SELECT 'non_negative(condition_concept_id)', negative = 0, (size - negative) / size,
                   negative || ' rows break the rule' FROM measured)
        SELECT 'condition quality' AS "check", 'Error' AS check_level, "constraint",
               CASE WHEN passed THEN 'Success' ELSE 'Failure' END AS constraint_status,
               round(metric, 9) AS metric, CASE WHEN NOT passed THEN message END AS message
        FROM lines""",
    "dq_valid": f"""WITH {FLAWED}
        SELECT * REPLACE (CAST(condition_concept_id AS VARCHAR) AS condition_concept_id) FROM flawed
        WHERE person_id IS NOT NULL AND condition_occurrence_id IS NOT NULL
          AND coalesce(condition_concept_id >= 0, true)""",
    "dq_dlq": f"""WITH {FLAWED}
        SELECT * REPLACE (CAST(condition_concept_id AS VARCHAR) AS condition_concept_id), {_REASONS} AS reasons
        FROM flawed
        WHERE person_id IS NULL OR condition_occurrence_id IS NULL OR condition_concept_id < 0""",
    "dq_stream": f"""WITH {FLAWED}
        SELECT * REPLACE (CAST(condition_concept_id AS VARCHAR) AS condition_concept_id), {_REASONS} AS reasons FROM flawed""",
    "dq_satisfies": f"""WITH {FLAWED}
        SELECT count(*) AS size, count(*) FILTER (condition_concept_id NOT IN (0, 32020)) AS n_broken FROM flawed""",
    "dq_breaker": f"""WITH {FLAWED},
        broken(name, n) AS (
            SELECT 'complete(person_id)', count(*) FILTER (person_id IS NULL) FROM flawed UNION ALL
            SELECT 'complete(condition_occurrence_id)', count(*) FILTER (condition_occurrence_id IS NULL) FROM flawed UNION ALL
            SELECT 'non_negative(condition_concept_id)', count(*) FILTER (condition_concept_id < 0) FROM flawed)
        SELECT 'flawed' AS checked, name || ': ' || n || ' rows break the rule' AS said FROM broken WHERE n > 0
        UNION ALL SELECT 'valid', 'passed'""",
    "landed_now": """
        SELECT 'DOCUMENTS' AS source_system_id, count(*) AS n_rows, count(*) AS n_in_time, CAST(1 AS BIGINT) AS n_times
        FROM documents""",
    "append_batches": f"WITH {CONDITIONS} SELECT * FROM conditions",
    "merge_upsert": f"WITH {TARGET}, {CHANGES} {_merged('changes')}",
    "merge_touched": f"""WITH {TARGET}, {CHANGES}, small AS (
        SELECT * FROM changes WHERE condition_occurrence_id % {NEW_KEY_OFFSET} % 97 = 1) {_merged("small")}""",
    "pipeline_gold": _gold(),
    "pipeline_linked": f"""WITH {LINKED_LAKE}, again AS ({_readmissions('conditions')}),
        counts AS (SELECT person_id, count(*) AS admission_count FROM conditions GROUP BY person_id)
        SELECT counts.person_id, admission_count, total_index_admissions, total_30_day_readmissions, readmission_rate
        FROM counts LEFT JOIN again USING (person_id)""",
    "merge_latest": f"WITH {CHANGES}, {REPEATED} SELECT * FROM latest",
    "merge_repeated": f"WITH {TARGET}, {CHANGES}, {REPEATED} {_merged('latest')}",
    "merge_tombstones": f"""WITH {TARGET}, {CHANGES}
        SELECT condition_occurrence_id, person_id, condition_concept_id, updated_at, cdc_op
        FROM changes s
        WHERE condition_occurrence_id IN (
                SELECT t.condition_occurrence_id FROM target t
                WHERE t.condition_occurrence_id = s.condition_occurrence_id AND s.updated_at > t.updated_at)
          AND (cdc_op IN ('u', 'd') OR cdc_op IS NULL)
        UNION ALL
        SELECT t.condition_occurrence_id, t.person_id, t.condition_concept_id, t.updated_at, t.cdc_op
        FROM target t LEFT JOIN changes s ON t.condition_occurrence_id = s.condition_occurrence_id
        WHERE NOT (s.condition_occurrence_id IS NOT NULL AND coalesce(s.updated_at > t.updated_at, false)
                   AND (s.cdc_op IN ('u', 'd') OR s.cdc_op IS NULL))
        UNION ALL
        SELECT s.condition_occurrence_id, s.person_id, s.condition_concept_id, s.updated_at, s.cdc_op
        FROM changes s ANTI JOIN target t ON t.condition_occurrence_id = s.condition_occurrence_id
        WHERE s.cdc_op IN ('c', 'u', 'd') OR s.cdc_op IS NULL""",
    "merge_stream": f"WITH {CHANGES} SELECT * FROM changes WHERE cdc_op IN ('c', 'u') OR cdc_op IS NULL",
    "hedis": _hedis("max(m.value_as_number)"),
    "hedis_latest": f"""WITH {CONDITIONS}, {MEASUREMENTS},
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY person_id
                          ORDER BY measurement_date DESC, value_as_number DESC) AS place
            FROM measurements)
        SELECT p.person_id, CASE WHEN m.person_id IS NULL THEN 0 ELSE 1 END AS had_hba1c_test,
               m.measurement_date AS last_test_date, m.value_as_number AS last_test_value
        FROM (SELECT DISTINCT person_id FROM conditions WHERE condition_concept_id = 201820) p
        LEFT JOIN (SELECT * FROM ranked WHERE place = 1) m ON p.person_id = m.person_id""",
    "readmission_pairs": f"""WITH {CONDITIONS},
        stays AS (SELECT * FROM conditions WHERE condition_concept_id = 9201)
        SELECT i.person_id, i.condition_start_date AS admission_date, i.condition_end_date AS discharge_date,
               s.condition_start_date AS readmission_date,
               CASE WHEN s.condition_start_date IS NOT NULL THEN 1 ELSE 0 END AS is_readmitted_30_days
        FROM stays i LEFT JOIN stays s
          ON i.person_id = s.person_id AND s.condition_start_date > i.condition_end_date
         AND s.condition_start_date <= i.condition_end_date + 30""",
    "readmission_days": f"WITH {CONDITIONS} {_readmission_days()}",
    "readmission_30d": f"WITH {CONDITIONS} {_readmissions('conditions')}",
    "readmission_30d_any_ids": f"""WITH {CONDITIONS},
        repeated AS (SELECT * REPLACE (condition_occurrence_id // 2 AS condition_occurrence_id) FROM conditions)
        {_readmissions('repeated')}""",
    "readmission_30d_all": f"""WITH {CONDITIONS}, found AS ({_readmissions('conditions')})
        SELECT p.person_id, coalesce(total_index_admissions, 0) AS total_index_admissions,
               coalesce(total_30_day_readmissions, 0) AS total_30_day_readmissions,
               coalesce(readmission_rate, 0) AS readmission_rate
        FROM (SELECT DISTINCT person_id FROM conditions) p LEFT JOIN found f ON p.person_id = f.person_id""",
    "readmission_30d_join": f"""WITH {CONDITIONS}, found AS ({_readmissions('conditions')}),
        pairs AS (
            SELECT a.person_id, b.condition_start_date - a.condition_start_date AS days_to_readmit
            FROM conditions a JOIN conditions b
              ON a.person_id = b.person_id AND a.condition_occurrence_id <> b.condition_occurrence_id
             AND b.condition_start_date > a.condition_start_date
             AND b.condition_start_date <= a.condition_start_date + 30),
        intervals AS (
            SELECT person_id, count(*) AS n_pairs, CAST(min(days_to_readmit) AS INTEGER) AS min_days_to_readmit,
                   CAST(max(days_to_readmit) AS INTEGER) AS max_days_to_readmit,
                   round(CAST(sum(days_to_readmit) AS DOUBLE) / count(*), 9) AS mean_days_to_readmit
            FROM pairs GROUP BY person_id)
        SELECT f.*, i.* EXCLUDE (person_id) FROM found f JOIN intervals i ON f.person_id = i.person_id""",
    "admission_count": f"""WITH {CONDITIONS}
        SELECT person_id, count(condition_occurrence_id) AS admission_count FROM conditions GROUP BY person_id""",
    "repeat_admissions": f"""WITH {CONDITIONS}
        SELECT person_id, count(condition_occurrence_id) AS admission_count FROM conditions GROUP BY person_id
        HAVING count(condition_occurrence_id) > 1""",
    "admission_count_stream":
        "SELECT o_custkey AS person_id, count(o_orderkey) AS admission_count FROM orders GROUP BY o_custkey",
    "mask_engineer": f"""WITH {RECORDS}
        SELECT payload_id, patient_id AS person_id, patient_ssn AS ssn, patient_mrn AS mrn FROM records""",
    "mask_analyst": f"""WITH {RECORDS}
        SELECT payload_id, 'REDACTED' AS person_id, '***-**-****' AS ssn, 'REDACTED_MRN' AS mrn FROM records""",
    "link_pairs": f"""WITH {PERSONS}
        SELECT l.nation, {_GAMMAS}, count(*) AS n_pairs
        FROM persons l JOIN persons r ON l.nation = r.nation AND l.unique_id < r.unique_id
        GROUP BY ALL""",
    "link_rates": f"""WITH {PERSONS}
        SELECT column_name, CAST(agree AS BIGINT) AS n_agree, CAST(pairs AS BIGINT) AS n_pairs,
               round(CAST(agree AS DOUBLE) / pairs, 9) AS u
        FROM ({_RATES})""",
    "link_predict": f"""WITH {PERSONS}, {_scored('persons', 'persons', 'l.unique_id < r.unique_id')}
        SELECT nation, CASE WHEN gamma_name = 1 THEN name_l END AS name,
               CASE WHEN gamma_segment = 1 THEN segment_l END AS segment,
               CASE WHEN gamma_balance = 1 THEN balance_l END AS balance, {_GAMMA_NAMES},
               round(match_weight, 9) AS match_weight, round(match_probability, 9) AS match_probability,
               count(*) AS n_pairs
        FROM scored GROUP BY ALL""",
    "link_partners": f"""WITH {PERSONS}, {_scored('copies', 'originals', 'true')}
        SELECT unique_id_l, unique_id_r, {", ".join(f"{c}_{s}" for c in COMPARED for s in ("l", "r"))},
               {_GAMMA_NAMES}, round(match_weight, 9) AS match_weight,
               round(match_probability, 9) AS match_probability
        FROM scored""",
    "link_em": f"WITH RECURSIVE {PERSONS}, {EM} {_MODEL}",
    "link_clusters": f"""WITH RECURSIVE {PERSONS}, {_scored('persons', 'persons', 'l.unique_id <> r.unique_id')},
        reach AS (
            SELECT unique_id AS node, unique_id AS origin FROM persons
            UNION
            SELECT s.unique_id_r, reach.origin FROM reach JOIN scored s ON s.unique_id_l = reach.node)
        SELECT node AS unique_id, min(origin) AS cluster_id FROM reach GROUP BY node""",
    "chain_e2e": f"""WITH {CHAIN}, valid AS (SELECT * FROM payloads WHERE person_id IS NOT NULL)
        {_readmissions('valid')}""",
    "chain_dead_letters": f"""WITH {CHAIN}
        SELECT *, 'complete(person_id)' AS reasons FROM payloads WHERE person_id IS NULL""",
    "pipeline_e2e": f"WITH {FIRST_DAY} SELECT * FROM zones",
    "pipeline_rerun": f"WITH {CORRECTED} SELECT * FROM corrected",
    "pipeline_marts": f"""WITH {CORRECTED}, valid AS (SELECT * FROM corrected WHERE zone = 'silver')
        {_readmissions('valid')}""",
}

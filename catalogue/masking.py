"""Personal data in whole texts."""

from catalogue.registry import job, query, result, step
from tidewright.functions import pii

_ENTITIES = ["USA_SSN", "CREDIT_CARD", "EMAIL", "IP_ADDRESS", "PHONE_NUMBER"]

# The same entities in the dialect of the oracle, which has no lookaround: it
# takes numbers one after the other, as no card here follows on other digits.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
_CARD = r"\b[0-9](?:[ -]?[0-9]){12,15}\b"
_EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IP = rf"\b{_OCTET}(?:\.{_OCTET}){{3}}\b"
_PHONE = r"(^|[^0-9A-Za-z_+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b"

_LUHN = """list_sum(list_transform(range(1, length({0}) + 1), lambda j:
    CASE WHEN j % 2 = 1 THEN CAST(substr(reverse({0}), j, 1) AS INTEGER)
         WHEN CAST(substr(reverse({0}), j, 1) AS INTEGER) > 4 THEN 2 * CAST(substr(reverse({0}), j, 1) AS INTEGER) - 9
         ELSE 2 * CAST(substr(reverse({0}), j, 1) AS INTEGER) END)) % 10 = 0"""


def _masked(table: str, key: str, column: str) -> str:
    """Text of one column as it is masked step by step."""
    digits = "regexp_replace(found[i], '[ -]', '', 'g')"
    return f"""
    s1 AS (SELECT {key} AS id, regexp_replace({column}, '{_EMAIL}', '****', 'g') AS t FROM {table}),
    s2 AS (SELECT id, regexp_replace(t, '{_SSN}', '****', 'g') AS t FROM s1),
    s3 AS (SELECT *, regexp_extract_all(t, '{_CARD}') AS found, regexp_split_to_array(t, '{_CARD}') AS pieces FROM s2),
    s4 AS (SELECT id, CASE WHEN len(found) = 0 THEN t ELSE array_to_string(list_transform(range(1, len(pieces) + 1),
                      lambda i: pieces[i] || CASE WHEN i > len(found) THEN '' WHEN {_LUHN.format(digits)} THEN '****'
                                                  ELSE found[i] END), '') END AS t FROM s3),
    s5 AS (SELECT id, regexp_replace(t, '{_IP}', '****', 'g') AS t FROM s4),
    s6 AS (SELECT id, regexp_replace(t, '{_PHONE}', '\\1****', 'g') AS t FROM s5)"""


@query(f"""WITH {_masked('documents', 'doc_id', 'text')}
    SELECT doc_id, s6.t AS text, lang, source, n_chars FROM documents JOIN s6 ON doc_id = id""")
def pii_redact(spark, sf_dir):
    return result(
        spark, sf_dir, "documents", mask_pii=_ENTITIES, sink={"sink_type": "file", "path": "never written here"}
    )


@query(f"""WITH {_masked('conversations', 'conv_id * 100000 + turn', 'text')}
    SELECT id, t AS said FROM s6""")
def pii_redact_nested(spark, sf_dir):
    # The same texts, but in a list of structs.
    nested = """SELECT conv_id * 100000 + turn AS id, array(named_struct('by', role, 'said', text)) AS turns
                FROM conversations"""
    masked = job(
        sf_dir, "conversations", step("sql", query=nested), mask_pii=_ENTITIES,
        sink={"sink_type": "file", "path": "never written here"},
    ).result(spark)
    return masked.selectExpr("id", "turns[0].said AS said")


_FOUND = {
    "USA_SSN": f"len(regexp_extract_all(text, '{_SSN}'))",
    "CREDIT_CARD": f"""len(list_filter(list_transform(regexp_extract_all(text, '{_CARD}'),
                       lambda found: regexp_replace(found, '[ -]', '', 'g')), lambda found: {_LUHN.format('found')}))""",
    "EMAIL": f"len(regexp_extract_all(text, '{_EMAIL}'))",
    "IP_ADDRESS": f"len(regexp_extract_all(text, '{_IP}'))",
    "PHONE_NUMBER": f"len(regexp_extract_all(text, '{_PHONE}'))",
}

_ORACLE_FOUND = "WITH found AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{entity}' AS entity, {number} AS n FROM documents" for entity, number in _FOUND.items()
) + ")"


@query(f"""{_ORACLE_FOUND}
    SELECT entity, 'text' AS "column", count(*) FILTER (WHERE n > 0) AS "rows", CAST(sum(n) AS BIGINT) AS matches
    FROM found GROUP BY entity""")
def pii_detect_report(spark, sf_dir):
    documents = result(spark, sf_dir, "documents", step("select", columns=["doc_id", "text"]))
    return pii.report(documents, _ENTITIES)


@query(f"""{_ORACLE_FOUND}
    SELECT doc_id, 'text' AS "column", entity, CAST(n AS INTEGER) AS n FROM found WHERE n > 0""")
def pii_detect_rows(spark, sf_dir):
    documents = result(spark, sf_dir, "documents", step("select", columns=["doc_id", "text"]))
    return pii.detect(documents, _ENTITIES).selectExpr("doc_id", f"inline({pii.DETECTED})")

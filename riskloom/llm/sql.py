"""DuckDB SQL of the queries that SQL can express."""

from riskloom.llm.audit import AUDIT_SQL
from riskloom.llm.jaccard import JACCARD_SQL
from riskloom.llm.secrets import secrets_sql
from riskloom.llm.variants import VARIANTS_SQL
from riskloom.llm.warc import WARC_SQL

QUERIES_SQL: dict[str, str] = {
    "op2_secret_scan": secrets_sql(),
    "op8_warc": WARC_SQL,
    "op10_jaccard": JACCARD_SQL,
    "op11_variants": VARIANTS_SQL,
    "op12_filter_audit": AUDIT_SQL,
}

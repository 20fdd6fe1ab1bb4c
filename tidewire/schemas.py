"""Explicit schemas of the records that stages exchange."""

from pyspark.sql import types as T

_S, _B, _I, _D = T.StringType(), T.BooleanType(), T.IntegerType(), T.DoubleType()
_A, _M = T.ArrayType(_S), T.MapType(_S, _S)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RAW = _struct(source_id=_S, source_name=_S, source_type=_S, region=_S, company_hint=_S, fetched_at=_S, url=_S, payload=_M)
CANONICAL = _struct(
    id=_S, source_id=_S, source_name=_S, region=_S, company_hint=_S, title=_S, content=_S, link=_S, published_at_utc=_S, published_missing=_B,
    published_parse_status=_S, discovery_query_group=_S, language=_S, fingerprint=_S, published_source=_S, resolved_ok=_B, resolved_url=_S,
    query_rss_verify_error_code=_S, query_rss_verify_error_zh=_S,
)
BRIEF = _struct(
    id=_S, source_id=_S, source_name=_S, region=_S, company_id=_S, title_zh=_S, summary_zh=_S, summary_what=_S, summary_why=_S,
    summary_so_what=_S, impact_targets=_A, tags=_A, summary_format_version=_S, link=_S, published_at_utc=_S, confidence=_D, importance=_I,
)
SOURCE_STAT = _struct(source_id=_S, source_name=_S, source_type=_S, status=_S, error=_S, error_reason_code=_S, error_reason_zh=_S, error_raw=_S, fetched_items=_I)
SEEN = _struct(resolved_url=_S, fingerprint=_S, first_seen_date=_S, last_seen_date=_S)
CACHE = _struct(
    fingerprint=_S, title_zh=_S, summary_zh=_S, summary_what=_S, summary_why=_S, summary_so_what=_S, impact_targets=_A, tags=_A,
    confidence=_D, importance=_I, updated_at=_S,
)
#: A source's configuration as the filters need it.
SOURCE = _struct(
    source_id=_S, source_type=_S, source_profile=_S, category=_S, entry_urls=_A, external_link_allow_domains=_A, url_allow_patterns=_A,
    url_block_patterns=_A, include_keywords=_A, exclude_keywords=_A,
)

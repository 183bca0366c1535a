"""The ``regex`` dialect: first hit anywhere in the line, value ends at a comma.

Measured on 1M lines, JSON parse included: ten ``regexp_extract`` took 2.3 s against
8.0 s for the equivalent ``instr``/``substring_index`` chain, because Java searches a literal prefix with
Boyer-Moore while the byte-level string functions walk UTF-8 once per call.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_UP_TO_COMMA = "([^,]+)"
_DIGITS = "([0-9]+)"

# The fields whose value pattern is not "up to the next comma".
_SPECIAL_VALUE = {
    "backendLatency": _DIGITS,
    "requestMediationLatency": _DIGITS,
    "responseLatency": _DIGITS,
    "responseMediationLatency": _DIGITS,
    "correlationId": "([a-f0-9-]{36})",
    "apiType": "([^,}]+)",
}

# Fields of the analysis row.
ANALYSIS_FIELDS = [
    "apiName", "apiCreator", "apiId", "apiCreatorTenantDomain", "backendLatency",
    "requestMediationLatency", "responseMediationLatency", "applicationId",
    "applicationName", "applicationOwner", "userIp", "proxyResponseCode",
    "targetResponseCode",
]

# Fields of the full extract and the column each one fills.
EXTRACT_FIELDS = {
    "apiName": "api_name",
    "proxyResponseCode": "proxy_response_code",
    "errorType": "error_type",
    "destination": "destination",
    "apiCreatorTenantDomain": "api_creator_tenant_domain",
    "platform": "platform",
    "apiMethod": "api_method",
    "apiVersion": "api_version",
    "gatewayType": "gateway_type",
    "apiCreator": "api_creator",
    "responseCacheHit": "response_cache_hit",
    "backendLatency": "backend_latency",
    "correlationId": "correlation_id",
    "requestMediationLatency": "request_mediation_latency",
    "keyType": "key_type",
    "apiId": "api_id",
    "applicationName": "application_name",
    "targetResponseCode": "target_response_code",
    "requestTimestamp": "request_timestamp",
    "applicationOwner": "application_owner",
    "userAgent": "user_agent",
    "eventType": "event_type",
    "apiResourceTemplate": "api_resource_template",
    "responseLatency": "response_latency",
    "regionId": "region_id",
    "responseMediationLatency": "response_mediation_latency",
    "userIp": "user_ip",
    "applicationId": "application_id",
    "apiType": "api_type",
}


def field_text(name: str, log: str | Column = "log") -> Column:
    """Value of ``name`` in the line, ``""`` when the line does not carry it.

    A value is never empty otherwise, so filters can test this text directly; inside a
    filter the null form of :func:`field` would run the regex twice.
    """
    pattern = f"{name}=" + _SPECIAL_VALUE.get(name, _UP_TO_COMMA)
    return F.regexp_extract(log, pattern, 1)


def field(name: str, log: str | Column = "log") -> Column:
    """Value of ``name`` in the line, null when the line does not carry it."""
    return F.nullif(field_text(name, log), F.lit(""))

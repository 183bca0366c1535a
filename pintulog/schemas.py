"""Declared schemas. Nothing in this library infers a schema from data."""

from pyspark.sql import types as T

# The record fields of one log line and the layout of every table
# read or written. Names, order and types are part of the data contract.
RECORD_DDL = "log string, time string, stream string"
FRAMED_DDL = "log: variant, time: string, stream: string"

ENVELOPE_DDL = (
    "data struct<result: array<struct<"
    "stream: map<string,string>, values: array<array<string>>>>>"
)

EVENT_DDL = """
    apiName string, proxyResponseCode int, destination string,
    apiCreatorTenantDomain string, platform string, apiMethod string,
    apiVersion string, gatewayType string, apiCreator string,
    responseCacheHit boolean, backendLatency int, correlationId string,
    requestMediationLatency int, keyType string, apiId string,
    applicationName string, targetResponseCode int, requestTimestamp timestamp_ntz,
    applicationOwner string, userAgent string, eventType string,
    apiResourceTemplate string, regionId string, responseLatency int,
    responseMediationLatency int, userIp string, apiContext string,
    applicationId string, apiType string, stream string, time timestamp_ntz
"""

EXTRACT_DDL = """
    log_timestamp string, api_name string, proxy_response_code string,
    error_type string, destination string, api_creator_tenant_domain string,
    platform string, api_method string, api_version string, gateway_type string,
    api_creator string, response_cache_hit string, backend_latency bigint,
    correlation_id string, request_mediation_latency bigint, key_type string,
    api_id string, application_name string, target_response_code string,
    request_timestamp string, application_owner string, user_agent string,
    event_type string, api_resource_template string, response_latency bigint,
    region_id string, response_mediation_latency bigint, user_ip string,
    application_id string, api_type string
"""

MAPPING_DDL = (
    "ord int, akun_nasional string, domain string, nama_instansi string, tipe_instansi string"
)
API_LIST_DDL = "api_provider string, api_name string"
CATALOG_DDL = (
    "api_provider string, created_by string, api_name string, api_version string, "
    "domain string, status string, nama_instansi string, occurrence bigint"
)
USAGE_DDL = (
    "instansi_pemilik_api string, apiCreator string, apiName string, "
    "apiCreatorTenantDomain string, occurrence bigint"
)


def fields(ddl: str) -> list[T.StructField]:
    """The columns of a schema text, in order."""
    return list(T.StructType.fromDDL(ddl))

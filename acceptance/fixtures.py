"""Gateway inputs derived from whole driver tables, by SQL both engines read alike."""

import functools
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Log lines from events: blank and broken lines, logs that are no text, a text that
# begins like an object, space and a second object after the record, missing and
# mixed-case values, a path that ends the metric block early, creators that are prefixes
# of others. Every field of both dialects occurs, some twice or overriding the record's
# own, with digits beyond 64 bits, without tenant or without creator.
LINES = """
select event_id,
 'logs_2025-06-' || cast(16 + event_id % 5 as string) as file_stem,
 case when event_id % 97 = 0 then '{"log": broken'
      when event_id % 89 = 0 then ''
      when event_id % 103 = 0 then '{"log":["' || log || '"],' || rest
      when event_id % 107 = 0 then '{"log":' || cast(event_id as string) || ',' || rest
      when event_id % 109 = 0 then '{"log":{"text":"' || log || '"},' || rest
      when event_id % 113 = 0 then '{"log":"' || log || '",' || rest || chr(9)
      when event_id % 127 = 0 then '{"log":"' || log || '",' || rest || ' {"log":"second","time":"2025-06-16T00:00:00Z"}'
      when event_id % 101 = 0 then '{"log":"{' || chr(92) || '"level' || chr(92) || '":1} ' || log || '",' || rest
      else '{"log":"' || log || '",' || rest end as value
from (select event_id, '"stream":"stdout","time":"' || gts || '.' || lpad(cast(event_id % 1000 as string),3,'0') || '456789Z"}' as rest,
 'Metric Name: apim:response, Metric Value: {apiName=' || api || ', proxyResponseCode=' || code
 || case when event_id % 139 = 0 then '' else ', apiCreatorTenantDomain=' || tenant end
 || case when event_id % 149 = 0 then '' else ', apiCreator=' || creator end
 || case when event_id % 13 = 0 then '' else ', backendLatency=' || cast(event_id % 400 as string) end
 || ', applicationOwner=' || owner || ', applicationName=' || app || ', userAgent=Mozilla/5.0 (KHTML, like Gecko), targetResponseCode=' || code
 || ', requestTimestamp=' || gts || '+07:00, responseCacheHit=' || hit
 || case when event_id % 5 = 0 then ', errorType=E' || cast(event_id % 3 as string) || ', destination=https://back.example/' || api || ', platform=Linux' else '' end
 || case when event_id % 5 = 1 then ', apiMethod=GET, apiVersion=v' || cast(event_id % 4 as string) || ', gatewayType=SYNAPSE, keyType=PRODUCTION' else '' end
 || case when event_id % 5 = 2 then ', correlationId=0a1b2c3d-0000-4000-8000-' || lpad(cast(event_id as string),12,'0') || ', apiId=id-' || api || ', eventType=response' else '' end
 || case when event_id % 5 = 3 then ', requestMediationLatency=' || cast(event_id % 7 as string) || ', responseLatency=' || cast(event_id % 900 as string) || ', responseMediationLatency=' || cast(event_id % 11 as string) else '' end
 || case when event_id % 5 = 4 then ', regionId=default, apiContext=/ctx/' || api || ', applicationId=' || case when event_id % 3 = 0 then '12345678901234567890' else cast(event_id as string) end else '' end
 || case when event_id % 131 = 0 then ', apiName=again_' || api || ', userIp=10.9.9.9' else '' end
 || case when event_id % 137 = 0 then ', stream=stderr, time=2025-06-18T01:02:03Z' else '' end
 || case when event_id % 17 = 0 then ', apiResourceTemplate=/v1/{id}' else ', apiResourceTemplate=/v1/all' end || ', userIp=10.0.0.' || cast(user_id % 50 as string) || ', apiType=HTTP}' as log
 from (select *, 'api_' || cast(user_id % 12 as string) as api,
 case when event_type = 'error' then '500' else '200' end as code,
 case when event_id % 3 = 0 then 'carbon.super' else 'nation_' || cast(user_id % 25 as string) || '.go.id' end as tenant,
 case when event_id % 10 = 0 then 'admin' when event_id % 10 < 6 then 'nation_' || cast(user_id % 25 as string) else 'u' || cast(user_id as string) || '@nation_' || cast(user_id % 25 as string) || '.go.id' end as creator,
 case when event_id % 7 = 0 then 'ext_' || cast(user_id % 5 as string) else 'nation_' || cast((user_id + 1 + event_id % 2) % 25 as string) end as owner,
 case when event_id % 11 = 0 then 'demo-app' else 'app_' || cast(user_id % 4 as string) end as app,
 case when event_id % 2 = 0 then 'true' else 'FALSE' end as hit,
 '2025-06-' || cast(16 + event_id % 5 as string) || 'T00:' || lpad(cast((event_id * 7) % 10 as string),2,'0') || ':' || lpad(cast((user_id * 11) % 60 as string),2,'0') as gts
 from events) x) y
"""

# Institution mapping from nation, with holes in both pattern columns.
MAPPING = """
select n_nationkey as ord,
 case when n_nationkey % 12 = 5 then null else 'nation_' || cast(n_nationkey as string) end as akun_nasional,
 case when n_nationkey % 12 = 7 then null else 'nation_' || cast(n_nationkey as string) || '.go.id' end as domain,
 case n_nationkey % 3 when 0 then 'Provinsi' when 1 then 'Kabupaten' else 'Kota' end || ' Nation ' || cast(n_nationkey as string) as nama_instansi,
 case n_nationkey % 3 when 0 then 'Provinsi' when 1 then 'Kabupaten' else 'Kota' end as tipe_instansi
from nation
"""

# API list from customer: every route of the institution mapper, hits and misses.
API_LIST = """
select c_custkey as row_id,
 case when c_custkey % 6 = 0 then null
      when c_custkey % 6 < 3 then 'c' || cast(c_custkey as string) || '@nation_' || cast(c_nationkey as string) || '.go.id'
      when c_custkey % 6 < 5 then 'admin'
      when c_custkey % 5 = 0 then 'vendor_' || cast(c_custkey as string)
      else 'nation_' || cast(c_nationkey as string) || '_acc' end as api_provider,
 case when c_custkey % 50 = 3 then null
      when c_custkey % 8 = 0 or c_custkey % 8 = 3 then 'SatuData Prov-Nation ' || cast(c_nationkey as string)
      when c_custkey % 8 = 1 or c_custkey % 8 = 4 then 'opendata_kab_nation' || cast(c_nationkey as string)
      when c_custkey % 8 = 2 or c_custkey % 8 = 5 then 'Portal Kota Nation ' || cast(c_nationkey as string)
      else 'data nation' || cast(c_nationkey as string) end as api_name
from customer
"""

# API catalog from customer: many rows per key, some with a count, some in no log.
CATALOG = """
select c_custkey as row_id, created_by as api_provider, created_by,
 'api_' || cast(c_custkey % 12 as string) as api_name,
 '1.0.' || cast(c_custkey % 7 as string) as api_version,
 case when c_custkey % 2 = 0 then 'nasional' else 'nation_' || cast(c_custkey % 25 as string) || '.go.id' end as domain,
 'PUBLISHED' as status, cast(null as string) as nama_instansi,
 case when c_custkey % 4 = 0 then cast(1 as bigint) else null end as occurrence
from (select *, case when c_custkey % 3 = 0 then 'u' || cast(c_custkey as string) || '@nation_' || cast(c_custkey % 25 as string) || '.go.id'
   else 'nation_' || cast(c_custkey % 25 as string) end as created_by
 from customer) x
"""

# Store response pages: one per event, the line as entry text (escaped into JSON).
PAGES = """
select event_id,
 '{"status":"success","data":{"result":[{"stream":{"container":"' || case when event_id % 20 = 0 then 'other' else 'gateway' end
 || '"},"values":[["' || cast(1750032000000000000 + event_id as string) || '","' || replace(replace(replace(value, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(9), chr(92) || 't')
 || '"]' || case when event_id % 3 = 0 then ',["' || cast(1750032000000000001 + event_id as string) || '","{' || chr(92) || '"log' || chr(92) || '":' || chr(92)
 || '"second' || chr(92) || '",' || chr(92) || '"time' || chr(92) || '":' || chr(92) || '"2025-06-16T00:00:00Z' || chr(92) || '"}"]' else '' end
 || ']}]}}' as value
from lines
"""


# The columns the fixtures read of each driver table.
COLUMNS = {
    "events": "event_id bigint, user_id bigint, event_type string",
    "nation": "n_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
}


def shared_storage(spark: SparkSession) -> SparkSession:
    """``spark``, with a checkpoint folder in its warehouse if none is set and all tasks run on this machine.

    On a cluster the setting is needed: the warehouse may be a folder of the driver alone.
    """
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def derived(df: DataFrame, name: str, text: str) -> DataFrame:
    """``text`` over ``df`` under a view name of our own, leaving the session's alone."""
    view = f"fixture_{name}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text.replace(f"from {name}", f"from {view}"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "events"), "events", LINES)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(lines(spark, sf_dir), "lines", PAGES)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "nation"), "nation", MAPPING)


def api_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "customer"), "customer", API_LIST)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "customer"), "customer", CATALOG)


# A log store: every line, three to a time, 40 seconds apart, some in another container.
STORE = """
select 1750032000000000000 + (event_id - event_id % 3) * 13000000000 as store_time, event_id,
 case when event_id % 20 = 0 then 'other' else 'gateway' end as container, value
from lines
"""
STORE_PAGE = 700


@functools.lru_cache(maxsize=4)
def _store_files(folder: str):
    """The store's files, opened once a process: their footers say which parts hold a time."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    scheme = folder.partition(":/")[0] if ":/" in folder else "file"
    store, path = (fs.LocalFileSystem(), "/" + folder.partition(":")[2].lstrip("/") if ":/" in folder else folder) if scheme == "file" else fs.FileSystem.from_uri(folder)
    return ds.dataset(path, filesystem=store)


def store_end(spark: SparkSession, folder: str) -> str:
    """The first whole second after all entries of a store that :func:`log_store` laid out."""
    last = spark.read.parquet(folder).agg(F.max("store_time")).first()[0] or 0
    return datetime.fromtimestamp(last // 1_000_000_000 + 1, timezone.utc).isoformat()


def log_store(spark: SparkSession, folder: str, sf_dir: str):
    """(fetch, volume) over the lines as a store has them: laid out by time in ``folder``, pages clamped.

    Files grow in number with the lines and row groups are small, so a page costs the same in any store.
    """
    entries = derived(lines(spark, sf_dir), "lines", STORE)
    writer = entries.repartitionByRange("store_time").sortWithinPartitions("store_time", "event_id").write
    writer.option("parquet.block.size", 1 << 22).parquet(folder)

    def scan(query: str, start: int, end: int, columns: list[str]):
        import pyarrow.dataset as ds

        wanted = (ds.field("store_time") >= start) & (ds.field("store_time") < end)
        if 'container="gateway"' in query:
            wanted &= ds.field("container") == "gateway"
        return _store_files(folder).scanner(columns=columns, filter=wanted)

    def fetch(query: str, start: int, end: int, limit: int) -> str:
        hit = scan(query, start, end, ["store_time", "event_id", "container", "value"]).to_table().sort_by([("store_time", "ascending"), ("event_id", "ascending")])
        rows = hit.slice(0, min(limit, STORE_PAGE)).to_pylist()
        by = {c: [[str(r["store_time"]), r["value"]] for r in rows if r["container"] == c] for c in ("gateway", "other")}
        return json.dumps({"data": {"result": [{"stream": {"container": c}, "values": v} for c, v in by.items()]}})

    def volume(query: str, start: int, end: int, bins: int) -> list[int]:
        import numpy as np

        cuts = [start + (end - start) * k // bins for k in range(bins + 1)]
        counts = np.zeros(bins, dtype=np.int64)
        for batch in scan(query, start, end, ["store_time"]).to_batches():
            places = np.searchsorted(cuts, batch.column(0).to_numpy(), side="right") - 1
            counts += np.bincount(places, minlength=bins)
        return counts.tolist()

    return fetch, volume

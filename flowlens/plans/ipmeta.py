"""Per-destination metadata (country, ASN, cloud service and region), built
once over the distinct destination keys and equi-joined back.

The dictionary's three range tables are cut into disjoint intervals once
(``ip_intervals``) and looked up together in one merge sweep; single look-ups
(``with_country`` and so on) go through ``range_join``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ipmath import ip_to_int
from ..operators.lookups import unique_lookup
from ..operators.intervals import RangeTable, flatten, sweep_lookup
from ..operators.rangejoin import range_join
from ..session import materialize
from ..sources.fixtures import UMBRELLA_SERVICE


def cloud_order():
    """Tie order among overlapping cloud ranges of equal width: the umbrella
    label last, then service, then region."""
    return [F.col("service") == UMBRELLA_SERVICE, F.col("service"), F.col("region")]


def _locations(dims) -> DataFrame:
    """One name per location (the smallest: a table of several locales must not
    multiply rows)."""
    names = unique_lookup(dims.geo_locations, ["geoname_id"], ["country_name"])
    return names.select(F.col("geoname_id").alias("_geo_id"), "country_name")


def with_country(points: DataFrame, dims, ip: str = "dst_ip_int", name: str = "country_name") -> DataFrame:
    out = range_join(points, dims.geo_blocks, ip, "network_start_integer", "network_end_integer",
                     ["geoname_id"], rename={"geoname_id": "_geo_id"})
    loc = _locations(dims).withColumnRenamed("country_name", name)
    return out.join(loc, "_geo_id", "left").drop("_geo_id")


def with_asn(points: DataFrame, dims, ip: str = "dst_ip_int", name: str = "asn_org") -> DataFrame:
    return range_join(points, dims.geo_asn, ip, "network_start_integer", "network_end_integer",
                      ["autonomous_system_organization"],
                      rename={"autonomous_system_organization": name})


def with_cloud(points: DataFrame, dims, ip: str = "dst_ip_int", service: str | None = None,
               names: tuple[str, str] = ("cloud_service", "cloud_region")) -> DataFrame:
    """Cloud range of the address; with ``service`` the range must also carry
    that service (the repaired, service-matched form)."""
    equi = [(service, "service")] if service else []
    return range_join(points, dims.cloud_ranges, ip, "network_start_int", "network_end_int",
                      ["service", "region"], equi=equi, order=cloud_order(),
                      rename={"service": names[0], "region": names[1]})


def ip_intervals(dims) -> DataFrame:
    """The country, ASN and cloud ranges cut into disjoint intervals, written
    once: ``geo`` (geoname_id), ``asn``, ``cloud`` (service, region of the narrowest range) and
    ``own_cloud`` (service -> region of its narrowest range)."""
    cloud = (dims.cloud_ranges, "network_start_int", "network_end_int")
    return materialize(flatten([
        RangeTable("geo", dims.geo_blocks, "network_start_integer", "network_end_integer", ["geoname_id"]),
        RangeTable("asn", dims.geo_asn, "network_start_integer", "network_end_integer", ["autonomous_system_organization"]),
        RangeTable("cloud", *cloud, ["service", "region"], cloud_order()),
        RangeTable("own_cloud", *cloud, ["region"], by="service"),
    ]), "ip-intervals")


def ip_metadata(flows: DataFrame, dims, keys: Sequence[str] = ("dstaddr",), service_matched: bool = False,
                checkpoint_keys: bool = True, intervals: DataFrame | None = None) -> DataFrame:
    """Distinct ``keys`` of ``flows`` with country_name, asn_org,
    final_service_type, aws_region (and cloud_service). ``service_matched``
    requires the cloud range to carry the flow's pkt_dst_aws_service (keys
    must include it). The distinct address set is checkpointed, so the facts are
    scanned once for it (``checkpoint_keys=False`` when ``flows`` is itself
    already written); ``intervals``: the table of ``ip_intervals``, if at hand."""
    keys = list(keys)
    pts = flows.select(*keys).distinct().withColumn("dst_ip_int", ip_to_int(F.col(keys[0])))
    if checkpoint_keys:
        pts = materialize(pts)
    found = sweep_lookup(pts, "dst_ip_int", ip_intervals(dims) if intervals is None else intervals)
    m = found.join(_locations(dims), F.col("geo.geoname_id") == F.col("_geo_id"), "left").withColumn("asn_org", F.col("asn.autonomous_system_organization"))
    if service_matched:
        own = F.try_element_at("own_cloud", F.col("pkt_dst_aws_service"))
        m = m.withColumns({"cloud_service": F.when(own.isNotNull(), F.col("pkt_dst_aws_service")), "cloud_region": own["region"]})
    else:
        m = m.withColumns({"cloud_service": F.col("cloud.service"), "cloud_region": F.col("cloud.region")})
    return m.select(
        *keys, "dst_ip_int", "country_name", "asn_org",
        F.coalesce("cloud_service", F.lit("NON-AWS")).alias("final_service_type"),
        F.col("cloud_region").alias("aws_region"),
        F.col("cloud_service"),
    )


def join_metadata(df: DataFrame, meta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join metadata back on ``keys`` NULL-safely (a NULL service is a key)."""
    m = meta.select(*[F.col(k).alias(f"_mk_{k}") for k in keys],
                    *[c for c in meta.columns if c not in keys])
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(m[f"_mk_{k}"])
        cond = c if cond is None else cond & c
    return df.join(m, cond, "left").drop(*[f"_mk_{k}" for k in keys])

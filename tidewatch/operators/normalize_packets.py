"""Packet-capture JSON -> flow events that keep every raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import TextView, array_view
from tidewatch.functions.variants import (
    all_strings, as_map, member, string_leaves, string_value,
)
from tidewatch.session import computed_once

LOG_TYPE = "tshark"
# Keys of the exported event written by normalisation; they win over raw layers of that name.
FLOW_KEYS = {
    "source_address": "source_address", "destination_address": "destination_address",
    "ip_version": "ip_version", "Source Port": "source_port",
    "Destination Port": "destination_port", "ip_protocol": "ip_protocol", "Bytes": "bytes",
    "timestamp_ms": "timestamp_ms", "time_utc": "time_utc", "protocols": "protocols",
    "log_type": "log_type",
}


def _unsigned(text: Column, highest: int) -> Column:
    number = F.when(text.rlike(r"^\+?[0-9]+\z"), text.try_cast("decimal(38,0)"))
    return F.when(number.between(0, highest), number)


def _text(layer: str, name: str) -> Column:
    """The string under a key of a layer; empty if it is absent or no string."""
    return F.coalesce(string_value(F.try_element_at(layer, F.lit(name))), F.lit(""))


def _first_text(layer: str, name: str, fallback: str) -> Column:
    """The first of two keys that exists decides, even when it holds no string."""
    exists = F.try_element_at(layer, F.lit(name)).isNotNull()
    return F.when(exists, _text(layer, name)).otherwise(_text(layer, fallback))


LAYERS = ("ip", "ipv6", "tcp", "udp", "frame")


def normalize_packets(packets: DataFrame) -> DataFrame:
    """``packets(event_id, packet variant)`` -> flow events.

    Dropped: packets without a text ``timestamp`` that is an integer, without an IP layer,
    or with neither address. A layer that is no object counts as absent.
    """
    v4, v6 = F.col("_ip").isNotNull(), F.col("_ipv6").isNotNull()
    tcp, udp = F.col("_tcp").isNotNull(), F.col("_udp").isNotNull()

    def port(side: str) -> Column:
        text = F.when(tcp, _text("_tcp", f"tcp_tcp_{side}port")).when(
            udp, _text("_udp", f"udp_udp_{side}port")
        )
        return F.coalesce(_unsigned(text, 65_535).cast("int"), F.lit(0))

    kept = [c for c in packets.columns if c != "packet"]
    stamp = string_value(member(F.col("packet"), "timestamp"))
    opened = computed_once(
        packets,
        as_map(member(F.col("packet"), "layers")).alias("layers"),
        F.when(stamp.rlike(r"^[+-]?[0-9]+\z"), stamp.try_cast("bigint")).alias("timestamp_ms"),
    ).where(F.col("timestamp_ms").isNotNull() & F.col("layers").isNotNull())
    flows = computed_once(
        opened.select(*kept, "layers", "timestamp_ms", *[
            as_map(F.try_element_at("layers", F.lit(name))).alias(f"_{name}") for name in LAYERS
        ]),
        F.when(v4, _first_text("_ip", "ip_ip_src", "ip_ip_src_host"))
        .when(v6, _text("_ipv6", "ipv6_ipv6_src")).alias("source_address"),
        F.when(v4, _first_text("_ip", "ip_ip_dst", "ip_ip_dst_host"))
        .when(v6, _text("_ipv6", "ipv6_ipv6_dst")).alias("destination_address"),
        F.when(v4, 4).when(v6, 6).cast("tinyint").alias("ip_version"),
        port("src").alias("source_port"),
        port("dst").alias("destination_port"),
        F.when(tcp, "TCP").when(udp, "UDP").otherwise("OTHER").alias("ip_protocol"),
        F.coalesce(
            _unsigned(_text("_frame", "frame_frame_len"), 2**63 - 1).cast("bigint"), F.lit(0).cast("bigint")
        ).alias("bytes"),
        _text("_frame", "frame_frame_time_utc").alias("time_utc"),
        _text("_frame", "frame_frame_protocols").alias("protocols"),
        F.lit(LOG_TYPE).alias("log_type"),
    ).where((F.col("source_address") != "") | (F.col("destination_address") != ""))
    return flows.select(
        *kept, F.timestamp_millis("timestamp_ms").alias("event_ts"), "timestamp_ms",
        *[column for column in FLOW_KEYS.values() if column != "timestamp_ms"],
        packet_object().alias("event"),
    )


def packet_object() -> Column:
    """The whole event as one VARIANT object: raw layers, overridden by the flow fields."""
    raw = F.map_filter("layers", lambda key, _: ~key.isin(list(FLOW_KEYS)))
    flow = F.create_map(*[
        part for key, column in FLOW_KEYS.items()
        for part in (F.lit(key), F.col(column).cast("variant"))
    ])
    return F.to_variant_object(F.map_concat(raw, flow))


def packet_text() -> TextView:
    """Text of a packet event: the strings at any depth of it, keys in byte order."""
    return array_view(all_strings(F.col("event")), string_leaves(F.col("event")))

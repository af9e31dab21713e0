"""Field lists and types of the event tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# PAN-OS log field names by position, as the vendor documents them.
# ---------------------------------------------------------------------------
COMMON_FIELDS = [
    "Log Number", "Receive Time", "Serial Number", "Type", "Threat/Content Type",
    "Config Version", "Generated Time", "Source address", "Destination address",
    "NAT source IP", "NAT destination IP", "Rule Name", "Source User", "Destination User",
    "Application", "Virtual System", "Source Zone", "Destination Zone", "Inbound Interface",
    "Outbound Interface", "Log Action", "Time Logged", "Session ID", "Repeat Count",
    "Source Port", "Destination Port", "NAT Source Port", "NAT Destination Port", "Flags",
    "IP Protocol", "Action",
]

TRAFFIC_FIELDS = [
    "Bytes", "Bytes Sent", "Bytes Received", "Packets", "Start Time",
    "Elapsed Time in seconds", "Category", "Padding", "Sequence Number", "Action Flags",
    "Source Location", "Destination Location", "Padding-2", "Packets Sent",
    "Packets Received", "Session End Reason", "Device Group Hierarchy Level 1",
    "Device Group Hierarchy Level 2", "Device Group Hierarchy Level 3",
    "Device Group Hierarchy Level 4", "Virtual System Name", "Device Name", "Action Source",
    "Source VM UUID", "Destination VM UUID", "Tunnel ID/IMSI", "Monitor Tag/IMEI",
    "Parent Session ID", "Parent Start Time", "Tunnel Type", "SCTP Association ID",
    "SCTP Chunks", "SCTP Chunks Sent", "SCTP Chunks Received", "UUID for rule",
    "HTTP/2 Connection", "Application-Level-Link-Changes", "Policy-ID", "Link-Switches",
    "SD-WAN-Cluster", "SD-WAN-Device-Type", "SD-WAN-Cluster-Type", "SD-WAN-Site",
    "Dynamic-User-Group-Name", "X-Forwarded-For-Address", "Source-Device-Category",
    "Source-Device-Profile", "Source-Device-Model", "Source-Device-Vendor",
    "Source-Device-OS-Family", "Source-Device-OS-Version", "Source-Hostname",
    "Source-MAC-Address", "Destination-Device-Category", "Destination-Device-Profile",
    "Destination-Device-Model", "Destination-Device-Vendor", "Destination-Device-OS-Family",
    "Destination-Device-OS-Version", "Destination-Hostname", "Destination-MAC-Address",
    "Container-ID", "POD-Namespace", "POD-Name", "Source-External-Dynamic-List",
    "Destination-External-Dynamic-List", "Host-ID", "User-Device-Serial-Number",
    "Source-Dynamic-Address-Group", "Destination-Dynamic-Address-Group", "Session-Owner",
    "High-Resolution-Timestamp", "A-Slice-Service-Type", "A-Slice-Differentiator",
    "Application-Subcategory", "Application-Category", "Application-Technology",
    "Application-Risk", "Application-Characteristics", "Application-Container-Name",
    "Tunneled-Application", "is-SAAS-App", "Application-Sanctioned-State", "Offloaded",
]

THREAT_FIELDS = [
    "Threat Name", "Threat ID", "Category", "Severity", "Direction", "Sequence Number",
    "Action Flags", "Source Location", "Destination Location", "Padding", "Content Type",
    "PCAP ID", "File Digest", "Cloud", "URL Index", "User Agent", "File Type",
    "X-Forwarded-For", "Referer", "Sender", "Subject", "Recipient", "Report ID",
    "Device Group Hierarchy Level 1", "Device Group Hierarchy Level 2",
    "Device Group Hierarchy Level 3", "Device Group Hierarchy Level 4",
    "Virtual System Name", "Device Name", "Source VM UUID", "Destination VM UUID",
    "HTTP/2 Connection", "High-Resolution-Timestamp", "SD-WAN-Cluster",
    "SD-WAN-Device-Type", "SD-WAN-Cluster-Type", "SD-WAN-Site", "Application-Subcategory",
    "Application-Category", "Application-Technology", "Application-Risk",
    "Application-Characteristics", "Application-Container-Name", "Tunneled-Application",
    "is-SAAS-App", "Application-Sanctioned-State", "X-Forwarded-For-Address",
    "Source-Device-Category", "Source-Device-Profile", "Nssai-Sst", "Nssai-Sd",
    "Partial-Hash", "High-Resolution-Timestamp-2",
]

INTEGER_FIELDS = [
    "Log Number", "Config Version", "Session ID", "Repeat Count", "Source Port",
    "Destination Port", "NAT Source Port", "NAT Destination Port", "Bytes", "Bytes Sent",
    "Bytes Received", "Packets", "Elapsed Time in seconds", "Sequence Number",
    "Packets Sent", "Packets Received", "Policy-ID", "Link-Switches", "Application-Risk",
    "PCAP ID", "URL Index", "Report ID",
]

FLOAT_FIELDS = ["High-Resolution-Timestamp", "High-Resolution-Timestamp-2"]
# ---------------------------------------------------------------------------


def column_name(field: str) -> str:
    """Event column of a header: blanks, slashes and dashes become underscores, lower case."""
    return field.translate(str.maketrans(" /-", "___")).lower()


def positions(kind: str) -> dict[str, int]:
    """Column name -> position in the line, for ``threat`` lines or for all others."""
    tail = THREAT_FIELDS if kind == "threat" else TRAFFIC_FIELDS
    return {column_name(f): i for i, f in enumerate(COMMON_FIELDS + tail)}


TRAFFIC_POSITIONS = positions("traffic")
THREAT_POSITIONS = positions("threat")
INTEGER_COLUMNS = frozenset(map(column_name, INTEGER_FIELDS))
FLOAT_COLUMNS = frozenset(map(column_name, FLOAT_FIELDS))
NUMERIC_COLUMNS = INTEGER_COLUMNS | FLOAT_COLUMNS
# Byte order, the order in which an event's keys are visited and written.
LOG_COLUMNS = sorted({**TRAFFIC_POSITIONS, **THREAT_POSITIONS})
# The keys of a firewall event: the log columns and the two added by normalisation.
EVENT_KEYS = sorted([*LOG_COLUMNS, "@timestamp", "log_source"])

GEO_PLACE = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ])),
])

# Struct fields are in key order, so JSON export needs no sorting.
ENRICHMENT_FIELD = "forwarder_enrichment"
_OFTEN = "struct<count: bigint, time_window_minutes: int>"
_PLACE = GEO_PLACE.simpleString()
ENRICHMENT_TYPE = f"""struct<
  behavioral_anomalies: struct<high_frequency_ip: {_OFTEN}, high_frequency_logid: {_OFTEN}, high_frequency_user: {_OFTEN}>,
  geoip: struct<dst: {_PLACE}, src: {_PLACE}>,
  intel_last_updated: string,
  ioc_matches: struct<
    malicious_domains: array<string>, malicious_hashes: array<string>,
    malicious_ips: array<struct<ip: string, source_count: int, sources: array<string>, status: string>>,
    malicious_urls: array<string>>,
  threat_hunting: struct<
    correlation_rules: array<struct<pattern: string, rule: string>>, critical_asset_access: string,
    suspicious_patterns: array<struct<field_path: string, pattern: string, sample: string>>,
    suspicious_process: string>>"""

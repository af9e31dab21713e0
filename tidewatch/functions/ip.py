"""IP address expressions.

An address becomes a lower-case hex key: 8 digits for IPv4, 32 for IPv6. Within a family
the keys sort like the addresses, and an address block is a key prefix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F



def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"


def _ipv4_number(ip: Column) -> Column:
    octets = F.split(ip, r"\.")
    total = F.lit(0).cast("bigint")
    for i in range(4):
        total = total * 256 + F.get(octets, F.lit(i)).try_cast("bigint")
    return total


def ipv4_key(ip: Column) -> Column:
    """Key of a strict dotted quad (no leading zeros), else null."""
    return F.when(
        ip.rlike(rf"^{_IPV4}\z"), F.lower(F.lpad(F.hex(_ipv4_number(ip)), 8, "0"))
    )


def ipv6_key(ip: Column) -> Column:
    """Key of a full, compressed or IPv4-tailed IPv6 address, else null."""
    tail = F.regexp_extract(ip, rf":({_IPV4})\z", 1)
    hex_only = F.when(tail == "", ip).otherwise(
        let(ipv4_key(tail), lambda key: F.concat(
            F.left(ip, F.length(ip) - F.length(tail)),
            F.left(key, F.lit(4)), F.lit(":"), F.right(key, F.lit(4)),
        ))
    )
    key = let(F.split(hex_only, "::", -1), _key_of_sides)
    return F.when(ip.contains(":") & ip.rlike(r"^[0-9a-fA-F:.]+\z"), key)


def _key_of_sides(sides: Column) -> Column:
    """Key from the text before and after ``::``, which stands for at least one group of zeros."""
    grouped = F.transform(sides, lambda side: F.filter(F.split(side, ":", -1), lambda g: side != ""))

    def expand(groups: Column) -> Column:
        given = F.size(F.flatten(groups))
        short = F.size(groups) == 2
        zeros = F.array_repeat(F.lit("0"), F.greatest(8 - given, F.lit(0)))
        full = F.when(short & (given <= 7), F.concat(F.get(groups, F.lit(0)), zeros, F.get(groups, F.lit(1)))).when(
            (F.size(groups) == 1) & (given == 8), F.get(groups, F.lit(0))
        )
        return let(full, lambda g: F.when(
            F.forall(g, lambda x: x.rlike(r"^[0-9a-fA-F]{1,4}\z")),
            F.lower(F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), "")),
        ))

    return let(grouped, expand)


def ip_key(ip: Column) -> Column:
    return F.coalesce(ipv4_key(ip), ipv6_key(ip))


# Blocks that do not count as public, as key prefixes. Link-local IPv4,
# carrier-grade NAT, broadcast and IPv4-mapped IPv6 are deliberately not among them.
NON_PUBLIC_V4 = {
    "10.0.0.0/8": "0a", "172.16.0.0/12": "ac1", "192.168.0.0/16": "c0a8",
    "127.0.0.0/8": "7f", "0.0.0.0/32": "00000000", "224.0.0.0/4": "e",
    "192.0.2.0/24": "c00002", "198.51.100.0/24": "c63364", "203.0.113.0/24": "cb0071",
}
NON_PUBLIC_V6 = {
    "::1/128": "0" * 31 + "1", "::/128": "0" * 32, "ff00::/8": "ff", "fe80::/10": "fe[89ab]",
    "fc00::/7": "f[cd]", "2001:db8::/32": "20010db8",
}


def is_public_ip(ip: Column) -> Column:
    """True for an address outside the blocks above; false for them and for anything else."""
    v4 = ~ipv4_key(ip).rlike(f"^(?:{'|'.join(NON_PUBLIC_V4.values())})")
    v6 = ~ipv6_key(ip).rlike(f"^(?:{'|'.join(NON_PUBLIC_V6.values())})")
    return F.coalesce(v4, v6, F.lit(False))

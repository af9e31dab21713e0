"""Address, CSV, time and variant expressions."""

import ipaddress
import json
import random
import time

from pyspark.sql import functions as F

from tidewatch.functions.ip import ip_key, is_public_ip
from tidewatch.functions.rules import (
    CORRELATION_RULES, DEFAULT_PACK, IOC_PATTERNS, OCCURS, SCAN_PATTERNS, RulePack, occurrence_pattern, spark_pattern, word_list,
)
from tidewatch.functions.text import csv_fields, flat_view, plain_case, rfc3339, strip
from tidewatch.functions.variants import all_strings, string_leaves
from tidewatch.operators.hunt import hunt, matches
from tidewatch.operators.iocs import domains, extract_iocs

import pytest


def public(text):
    """The expected class, by address blocks: not the same as the library's ``is_global``."""
    try:
        ip = ipaddress.ip_address(text)
    except ValueError:
        return False
    blocks = (["10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "0.0.0.0/32", "224.0.0.0/4",
               "192.0.2.0/24", "198.51.100.0/24", "203.0.113.0/24"] if ip.version == 4 else
              ["::1/128", "::/128", "ff00::/8", "fe80::/10", "fc00::/7", "2001:db8::/32"])
    return not any(ip in ipaddress.ip_network(b) for b in blocks)


def test_addresses_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    v4 = [".".join(str(rng.choice([0, 10, 127, 172, 192, 198, 203, 224, rng.randrange(256)])) if i == 0
                   else str(rng.choice([0, 2, 16, 31, 51, 100, 113, 168, rng.randrange(256)])) for i in range(4))
          for _ in range(400)]
    v6 = [str(ipaddress.IPv6Address(rng.choice([0, 0xFE80 << 112, 0xFD << 120, 0x20010DB8 << 96, 0x2A00 << 112])
                                    | rng.getrandbits(rng.choice([1, 16, 64, 100])))) for _ in range(400)]
    odd = ["", "host", "1.2.3", "01.2.3.4", "1.2.3.4/8", "256.1.1.1", "::", ":::", "1::2::3", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::",
           "1:2:3:4:5:6:7:8::", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "12345::", "1.2.3.4\n", "::1%eth0"]
    rows = spark.createDataFrame([(a,) for a in v4 + v6 + odd], "a string").select(
        "a", ip_key(F.col("a")).alias("k"), is_public_ip(F.col("a")).alias("p")
    ).collect()
    for row in rows:
        try:
            if "%" in row.a:
                raise ValueError(row.a)
            ip = ipaddress.ip_address(row.a)
            key = format(int(ip), "08x" if ip.version == 4 else "032x")
        except ValueError:
            key = None
        assert row.k == key, row.a
        assert row.p == (key is not None and public(row.a)), row.a


@pytest.mark.parametrize("line, fields", [
    ("a,b,c", ["a", "b", "c"]), ("a,,b,", ["a", "", "b", ""]), ('"a,b",c', ["a,b", "c"]), ('"x ""y""",z', ['x "y"', "z"]),
    ('in"ner,z', ['in"ner', "z"]), ('"ab"c,d', ["abc", "d"]), ('"open, to the end', ["open, to the end"]),
    ('""', [""]), ("first,1\nsecond,2", ["first", "1"]), ('"two\nlines",z\nnext', ["two\nlines", "z"]),
])
def test_csv_fields(spark, line, fields):
    assert spark.createDataFrame([(line,)], "l string").select(csv_fields(F.col("l"))).first()[0] == fields


def test_csv_long_quoted_field(spark):
    inner = 'x""' * 200_000
    got = spark.createDataFrame([(f'"{inner}",b',)], "l string").select(csv_fields(F.col("l"))).first()[0]
    assert got == ['x"' * 200_000, "b"]


def test_times_and_blanks(spark):
    rows = spark.sql(
        "select timestamp'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.12' b, timestamp'2024-01-02 03:04:05.000001' c"
    ).select(*[rfc3339(F.col(c)) for c in "abc"], strip(F.lit("\u3000\t x y \u00a0\x0b"))).first()
    assert list(rows) == ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.120+00:00", "2024-01-02T03:04:05.000001+00:00", "x y"]


def test_variant_leaves(spark):
    text = r'{"z":"last","b":{"q":["x",{"y":"w\"\\"}],"n":5,"k":null},"A":true,"a":"","u":"\u00e9"}'
    row = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v")).select(
        string_leaves(F.col("v")).alias("l"), all_strings(F.col("v")).alias("s")).first()
    want = [("a", ""), ("b.q[0]", "x"), ("b.q[1].y", 'w"\\'), ("u", "é"), ("z", "last")]
    assert [(x.path, x.value) for x in row.l] == want
    assert row.s == [v for _, v in want]


def plain_leaves(value, path=""):
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, dict):
        for key in sorted(value):
            yield from plain_leaves(value[key], path + ("" if not path or key.startswith("[") else ".") + key)
    elif isinstance(value, list):
        for i, item in enumerate(value):
            yield from plain_leaves(item, f"{path}[{i}]")


def test_leaves_at_any_depth(spark):
    rng = random.Random(0)

    def some(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return rng.choice(["s", "", 'q"\\', "a,b:{[", "é☃", "x:", 5, True, None, 1.5])
        if kind < 0.65:
            return {rng.choice(["a", "k.x", "[z]", 'q"', "c:", "é", ""]) + str(rng.randrange(3)): some(depth - 1) for _ in range(rng.randrange(4))}
        return [some(depth - 1) for _ in range(rng.randrange(4))]

    deep = "bottom"
    for _ in range(40):
        deep = {"k": [deep, "beside"]}
    values = [some(6) for _ in range(300)] + [deep, [["x"] * 3] * 400, {f"k{i}": "v" for i in range(1500)}]
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string").withColumn("v", F.parse_json("t"))
    for row in frame.select("i", string_leaves(F.col("v")).alias("l")).collect():
        assert [(x.path, x.value) for x in row.l] == list(plain_leaves(values[row.i]))


def test_one_pass_expressions_agree_with_the_published_ones(spark):
    rng = random.Random(1)
    pieces = {
        "base64_encoded": ["AbC+" * 4, "Zz09", "=", "==", "-"], "hex_encoded": ["\\x41" * 4, "\\xZZ", "\\x"], "unicode_encoded": ["\\u0041", "\\u00"],
        "obfuscated_powershell": ["powershell", "PowerShell", " -e ", "-enc", "/E", "-EncodedCommand", " ", "\n", "A" * 10, "b" * 20, "="],
        "obfuscated_script": ["cmd", "SH", "bash", "powershell", "{", "(", "$", "`;", "|&", " ", "\n", "z"],
        "sql_injection": [" or ", " AND", "1=1", "  ", "\n", "union", "select", "drop", "table", "x", "or", "update", "set"],
    }
    assert set(pieces) == {name for name, p in SCAN_PATTERNS.items() if p in OCCURS}
    for name, parts in pieces.items():
        texts = ["".join(rng.choices(parts, k=rng.randint(1, 20))) for _ in range(1500)]
        there, found = F.col("t").rlike(spark_pattern(SCAN_PATTERNS[name])), F.col("t").rlike(occurrence_pattern(SCAN_PATTERNS[name]))
        row = spark.createDataFrame([(t,) for t in texts], "t string").agg(F.count_if(there != found), F.count_if(there)).first()
        assert row[0] == 0 and 20 < row[1] < 1500, name


def test_domains_are_those_of_the_published_expression(spark):
    rng = random.Random(2)
    pieces = ["a", "b1", "com", "net", ".", ".", ".", "-", "1", "x" * 62, "x" * 63, "x" * 64, "y" * 70, "1" * 64, "\u212a", "\u017f", " ", "_", "A", "..", "-.", ".-", "\n", "co.uk"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(8000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.regexp_extract_all("t", F.lit(spark_pattern(IOC_PATTERNS["domain"])), 0).alias("want"), domains(F.col("t")).alias("got"))
    assert frame.where("want <> got").collect() == [] and frame.agg(F.sum(F.size("want"))).first()[0] > 2000


HOSTILE = {
    "labels": "a." * 100_000 + "com", "no ending": "1a." * 100_000 + "1", "long label": "1a." * 100_000 + "1" * 64 + ".com", "cut chains": ("x" * 64 + ".1a.") * 15_000,
    "keywords": "sh " * 350_000, "options": "powershell -e " * 80_000, "base64": "AbC9" * 1_250_000, "hex": "\\x41" * 250_000, "half hex": "\\x4" * 350_000, "blanks": " " * 1_000_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_lines_take_little_time(spark, name):
    rows = spark.createDataFrame([(1, HOSTILE[name])], "event_id int, t string")
    hunt(rows, flat_view({"t": "t"})).collect(), extract_iocs(rows, F.col("t")).collect()  # compiled
    start = time.time()
    hunt(rows, flat_view({"t": "t"})).collect(), extract_iocs(rows, F.col("t")).collect()
    assert time.time() - start < 10


def test_rule_pack_is_validated(spark):
    assert DEFAULT_PACK.validate(spark) is DEFAULT_PACK
    with pytest.raises(ValueError, match="broken"):
        RulePack(rules={"broken": "(unclosed"}).validate(spark)


def test_word_tests_agree_with_the_expressions(spark):
    """Texts made of pieces of the expressions: words decide, or at least miss nothing."""
    rng = random.Random(3)
    pieces = ["UNION", "select", "drop", "TABLE", "insert", "into", "update", "set", "delete", "from", "'", " or 1=1", "\t", " ", "\u00a0",
              "power\u017fhell", "POWERSHELL", "-enc", "bash", "$({", "`", "%2e%2e%2F", "..\\", "../", "c:\\", "/ETC/", "\\x41" * 11, "\\u0041" * 6,
              "\u212aRSH", "r\u017fh", "ftp", "tftp", "telnet", "sqli", "su ", "C2", "c&c", "<Script", "onload=", "zz", ";", "||", "A" * 40,
              "bo\u0130t", "M\u0130NING", "m\u0131ning", "Mining", "tro\u212aan", "Login Failed"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", F.expr(plain_case("t"))).withColumn(
        "_folded", F.replace(F.lower("p"), F.lit("\u017f"), F.lit("s")))
    seen = 0
    for name, pattern in {**SCAN_PATTERNS, **CORRELATION_RULES}.items():
        hit, test = F.col("p").rlike(spark_pattern(pattern)), F.expr(matches("p", pattern))
        row = frame.agg(F.count_if(hit != test).alias("wrong"), F.count_if(hit).alias("hits")).first()
        assert row.wrong == 0, name
        seen += row.hits
    assert seen > 1000
    assert word_list(SCAN_PATTERNS["directory_traversal"]) == ["../", "..\\", "/etc/", "c:\\", "%2e%2e%2f", "%2e%2e%5c"]
    assert sum(word_list(p) is not None for p in CORRELATION_RULES.values()) == 16


def test_letters_that_only_look_like_an_i(spark):
    rows = spark.createDataFrame([(1, "m\u0131n\u0131ng v\u0130rus s\u0131te.\u0130o"), (2, "MINING \u212alm.io")], "event_id int, t string")
    got = {r.event_id: r.threat_hunting for r in hunt(rows, flat_view({"t": "t"})).collect()}
    assert got[1] is None and [p.pattern for p in got[2].suspicious_patterns] == ["crypto_mining"]
    assert [(r.event_id, r.value) for r in extract_iocs(rows, F.col("t")).collect()] == [(2, "\u212alm.io")]

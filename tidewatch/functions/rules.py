"""Detection packs: indicator patterns, scan patterns, keyword lists and correlation rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Regular expressions, word lists and thresholds. They decide what counts as
# a hit, so they are kept as published; ``spark_pattern`` adds the dialect flags.
# ---------------------------------------------------------------------------
IOC_PATTERNS = {
    "ip": r"(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
          r"|(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|::1"
          r"|::ffff:[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "domain": r"(?i)(?:[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,}",
    "hash": r"(?i)\b(?:[a-f0-9]{32}|[a-f0-9]{40}|[a-f0-9]{64}|[a-f0-9]{96}|[a-f0-9]{128})\b",
    "url": r"(?i)(?:https?|ftp)://[^\s/$.?#].[^\s]*|www\.[^\s/$.?#].[^\s]*",
}

SCAN_PATTERNS = {
    "base64_encoded": r"(?:[A-Za-z0-9+/]{4}){10,}(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?",
    "hex_encoded": r"(?:\\x[0-9a-fA-F]{2}){10,}",
    "unicode_encoded": r"(?:\\u[0-9a-fA-F]{4}){5,}",
    "obfuscated_powershell": r"(?i)powershell.*[-/][eE](?:ncodedcommand|nc)?\s+[a-zA-Z0-9+/=]{20,}",
    "obfuscated_script": r"(?i)(?:cmd|powershell|bash|sh).*[{()}$`|&;]{3,}",
    "sql_injection": r"(?i)(?:union\s+select|drop\s+table|insert\s+into|update\s+set|delete\s+from"
                     r"|'|\s+or\s+1=1|\s+and\s+1=1)",
    "xss_attempt": r"(?i)(?:<script|javascript:|onload=|onerror=|onclick=|onmouseover=)",
    "command_injection": r"(?i)(?:;|\|\||&&|`|\$\(|\$\{|%[0-9a-fA-F]{2})",
    "directory_traversal": r"(?i)(?:\.\./|\.\.\\|/etc/|c:\\|%2e%2e%2f|%2e%2e%5c)",
    "suspicious_user_agent": r"(?i)(?:curl|wget|python-requests|urllib|httpclient|bot|scanner|crawler|sqlmap)",
    "crypto_mining": r"(?i)(?:stratum|mining|coinminer|cryptonight|xmrig|monero|bitcoin)",
    "malware_family": r"(?i)(?:emotet|trickbot|qakbot|dridex|lokibot|azorult|formbook|hawkeye|nanocore)",
}

SUSPICIOUS_PROCESSES = [
    "meterpreter", "cobaltstrike", "metasploit", "netcat", "nc", "ncat", "powershell -e",
    "powershell -enc", "powershell -w hidden", "powershell -nop", "certutil", "bitsadmin",
    "wmic", "mshta", "rundll32", "regsvr32", "schtasks", "psexec", "paexec", "winexe",
    "at.exe", "sc.exe", "netsh", "ipconfig", "nslookup", "ping", "telnet", "whoami",
    "systeminfo", "tasklist", "net user", "net localgroup",
]

CRITICAL_ASSETS = [
    "domain-controller", "domain controller", "active directory", "ldap", "database-server",
    "database server", "mysql", "postgresql", "oracle", "mssql", "payment-gateway",
    "payment gateway", "pos system", "erp-system", "erp system", "sap", "oracle erp",
    "scada-system", "scada system", "hmi", "plc",
]

CORRELATION_RULES = {
    "brute_force": r"(?i)(authentication failure|login failed|invalid password|bad password)",
    "port_scan": r"(?i)(scan detected|port scan|reconnaissance|nmap)",
    "malware_exec": r"(?i)(malware|virus|trojan|backdoor|rootkit|ransomware)",
    "suspicious_login": r"(?i)(login outside business hours|unusual login time|after hours access)",
    "data_exfiltration": r"(?i)(large data transfer|exfiltration|data leak|file upload|ftp transfer)",
    "privilege_escalation": r"(?i)(sudo|su |privilege escalation|elevated privileges|admin access)",
    "config_change": r"(?i)(configuration changed|config modified|settings altered)",
    "critical_service_stop": r"(?i)(service stopped|service terminated|critical service down)",
    "new_service": r"(?i)(new service installed|service created|service registered)",
    "persistence": r"(?i)(persistence mechanism|startup item|autostart|registry run key)",
    "lateral_movement": r"(?i)(lateral movement|remote execution|psexec|wmi execution)",
    "command_and_control": r"(?i)(c2|c&c|command and control|beacon|callback)",
    "policy_violation": r"(?i)(policy violation|security policy|compliance violation)",
    "suspicious_network": r"(?i)(suspicious connection|malicious ip|blocked connection)",
    "crypto_mining": r"(?i)(crypto mining|cryptocurrency|bitcoin|monero|mining pool)",
    "sql_injection_attempt": r"(?i)(sql injection|sqli|union\s+select|drop\s+table|insert\s+into)",
    "network_threat_detected": r"(?i)(threat|vulnerability|exploit|attack|intrusion)",
    "high_risk_protocol": r"(?i)\b(telnet|rsh|rlogin|tftp|ftp)\b",
}

BEHAVIOR_WINDOW_MINUTES = 5
BEHAVIOR_THRESHOLD = 10
# ---------------------------------------------------------------------------


# A capital I with a dot and a small one without are no case forms of an ASCII letter, but
# Java takes them for an i. They are read as another letter, which no expression contains.
DOTTED_I, DOTLESS_I, OTHER_LETTER = "\u0130", "\u0131", "\u05d0"


def spark_pattern(pattern: str) -> str:
    """The pattern with the flags that make Java read it as intended.

    ``U``: blanks, digits, word boundaries and case folding follow Unicode;
    ``d``: only a line feed ends a line, so ``.`` matches everything else.
    """
    flags = re.match(r"\(\?([im]+)\)", pattern)
    return f"(?{flags[1]}Ud){pattern[flags.end():]}" if flags else "(?Ud)" + pattern


# Published expressions that start anew at every keyword of a line, at every blank of a run, or
# keep on past what decides, each with one that finds in one pass whether the published one
# occurs. A line's first keyword is enough: what follows a later one follows the first one too.
_OCCURS = {
    "base64_encoded": r"[A-Za-z0-9+/]{40}",
    "hex_encoded": r"(?:\\x[0-9a-fA-F]{2}){10}",
    "unicode_encoded": r"(?:\\u[0-9a-fA-F]{4}){5}",
    "obfuscated_powershell": r"(?im)^(?>.*?powershell).*[-/][eE](?:ncodedcommand|nc)?\s++[a-zA-Z0-9+/=]{20}",
    "obfuscated_script": r"(?im)^(?>.*?(?:cmd|powershell|bash|sh)).*[{()}$`|&;]{3}",
    "sql_injection": r"(?i)(?:union\s+select|drop\s+table|insert\s+into|update\s+set|delete\s+from|'|\sor\s+1=1|\sand\s+1=1)",
}
OCCURS = {SCAN_PATTERNS[name]: pattern for name, pattern in _OCCURS.items()}


def occurrence_pattern(pattern: str) -> str:
    """An expression, ready for Java, that is found in the same texts as ``pattern``."""
    return spark_pattern(OCCURS.get(pattern, pattern))


# Domains. The published expression repeats a group, for which Java needs stack by the number of
# labels, and it starts anew at every character. The texts are cut first where no domain
# goes across: beside two marks in a row, and before a label that is too long to be one and
# no ending either. Of a run of what can be in a domain, the rest after its last ending is dropped.
# Then every start that gets past its first label succeeds. Labels that aren't followed by an
# ending, and groups that go up to one, are taken without a way back; the last ending is found.
_LABEL = r"[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\."
DOMAIN_CUTS = r"(?iUd)(?<=\.)(?=[.\-])|(?<=-)(?=\.)|(?<=\.)(?=[a-z0-9\-]{64})(?![a-z]{2})"
DOMAIN_RUNS = r"(?iUd)[a-z0-9.\-]++"
DOMAIN_HEAD = r"(?iUd)^.*\.[a-z]{2,}"
DOMAIN_FIND = rf"(?iUd)(?:(?:{_LABEL}(?![a-z]{{2}}))*+{_LABEL}(?=[a-z]{{2}}))++[a-z]{{2,}}"


# Lower-case texts of which every match of an expression holds at least one. Looking for a
# plain text is far cheaper than running the expression, so it is tried first. Expressions
# not listed here are simply run.
_HOLDS = {
    "hex_encoded": [r"\x"],
    "unicode_encoded": [r"\u"],
    "obfuscated_powershell": ["powershell"],
    "obfuscated_script": ["cmd", "powershell", "bash", "sh"],
    "sql_injection": ["union", "drop", "insert", "update", "delete", "'", "1=1"],
    "command_injection": [";", "||", "&&", "`", "$(", "${", "%"],
}
_RULE_HOLDS = {
    "sql_injection_attempt": ["sql injection", "sqli", "union", "drop", "insert"],
    "high_risk_protocol": ["telnet", "rsh", "rlogin", "ftp"],
}
HOLDS = {SCAN_PATTERNS[name]: words for name, words in _HOLDS.items()} | {
    CORRELATION_RULES[name]: words for name, words in _RULE_HOLDS.items()
}
# Expressions that match nothing shorter than this; they only see lines of at least that length.
LONG_LINE = 40
LONG_PATTERNS = frozenset({SCAN_PATTERNS["base64_encoded"]})


def word_list(pattern: str) -> list[str] | None:
    """The lower-case words of an expression that is nothing but a choice of them, else None."""
    listed = re.fullmatch(r"\(\?i\)\((?:\?:)?((?:[a-z0-9 &<:=/%|-]|\\[.\\])+)\)", pattern)
    return re.sub(r"\\(.)", r"\1", listed[1]).split("|") if listed else None


def any_word_pattern(words: list[str]) -> str:
    """An expression, ready for Java, that stands at each place where a word begins; its group is the longest one there.

    The words are laid out as a tree by their letters, so a place is tried against one word
    per letter and not against all of them, and only where one of the words can begin.
    """
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def quoted(letter: str) -> str:
        return letter if letter.isalnum() or letter == " " or letter > "\x7f" else "\\" + letter

    def below(node: dict) -> str:
        tails = [quoted(letter) + below(rest) for letter, rest in sorted(node.items()) if letter]
        if not tails:
            return ""
        return tails[0] if len(tails) == 1 and "" not in node else f"(?:{'|'.join(tails)}){'?' if '' in node else ''}"

    # Most places fail at the first letters, which are asked for as sets of a few.
    firsts = sorted(letter for letter in tree if letter)
    sets = [firsts[i:i + 6] for i in range(0, len(firsts), 6)]
    choices = [f"(?=[{''.join(map(quoted, some))}])(?:{'|'.join(quoted(c) + below(tree[c]) for c in some)})" for some in sets]
    begins = f"(?=[{''.join(map(quoted, firsts))}])" if firsts else ""
    return f"{begins}(?=({'|'.join(choices)}))"


@dataclass(frozen=True)
class RulePack:
    """What ``hunt`` looks for; pass another one to use your own rules."""

    patterns: dict[str, str] = field(default_factory=lambda: dict(SCAN_PATTERNS))
    processes: tuple[str, ...] = tuple(SUSPICIOUS_PROCESSES)
    assets: tuple[str, ...] = tuple(CRITICAL_ASSETS)
    rules: dict[str, str] = field(default_factory=lambda: dict(CORRELATION_RULES))

    def validate(self, spark: SparkSession) -> "RulePack":
        """Compile every expression once on the driver, so a bad one fails before the job."""
        compiler = spark._jvm.java.util.regex.Pattern
        for name, pattern in {**self.patterns, **self.rules}.items():
            try:
                compiler.compile(spark_pattern(pattern))
            except Exception as error:
                raise ValueError(f"rule {name!r}: {pattern!r} is not a valid expression") from error
        return self


DEFAULT_PACK = RulePack()
